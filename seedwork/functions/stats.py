"""Column builders for likelihoods, tails and robust statistics. Everything is a built-in expression: no Python per row."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(x: Column | float) -> Column:
    return x if isinstance(x, Column) else F.lit(float(x))


def logit(p: Column) -> Column:
    return F.log(p / (1 - p))


def sigmoid(z: Column) -> Column:
    """Two branches, so neither exponential overflows."""
    return F.when(z >= 0, 1 / (1 + F.exp(-z))).otherwise(F.exp(z) / (1 + F.exp(z)))


def clip(x: Column, low: float, high: float) -> Column:
    return F.least(F.greatest(x, F.lit(low)), F.lit(high))


def log_sum_exp(values: Column) -> Column:
    """log(sum(exp(v))) of an array of doubles, free of overflow."""
    top = F.array_max(values)
    return top + F.log(F.aggregate(values, F.lit(0.0), lambda s, v: s + F.exp(v - top)))


def binomial_log(a: Column, n: Column, p: Column, floor: float = 1e-9) -> Column:
    """Binomial log-likelihood without its coefficient, p clipped."""
    q = clip(p, floor, 1 - floor)
    return a * F.log(q) + (n - a) * F.log(1 - q)


def pooled_llr(n: str, a: str, eps: str | float, plants: int = 6) -> Column:
    """Log-likelihood ratio of a pool of ``plants`` backcross plants: j of 2 * plants haplotypes carry the allele, j ~ Bin(plants, 1/2), against
    error alone. ``n``, ``a`` and ``eps`` are column names (or a number for eps). The reads' binomial coefficient cancels; no reads give 0.

    There is no branch in it, so that code generation evaluates each of the repeated terms once; and it is one parsed text, since building it
    call by call takes longer than running it on small tables.
    """
    e = eps if isinstance(eps, str) else f"{eps!r}D"
    terms = []
    for j in range(plants + 1):
        weight = math.lgamma(plants + 1) - math.lgamma(j + 1) - math.lgamma(plants - j + 1) + plants * math.log(0.5)
        f = j / (2 * plants)
        p = f"({f!r}D * (1D - {e}) + {1 - f!r}D * {e})"
        terms.append(f"({weight!r}D + {a} * ln({p}) + ({n} - {a}) * log1p(-{p}))")
    top = f"greatest({', '.join(terms)})"
    total = " + ".join(f"exp({t} - {top})" for t in terms)
    return F.expr(f"({top} + ln({total}) - ({a} * ln({e}) + ({n} - {a}) * log1p(-{e}))) * cast({n} > 0 as int)")


def binomial_upper_tail(a: Column, n: Column, p: Column | float) -> Column:
    """P(X >= a) for X ~ Bin(n, p), by the ratio of neighbouring terms from the first term's logarithm, which cannot underflow."""
    q = clip(_col(p), 1e-12, 1 - 1e-12)
    start, size = a.cast("long"), n.cast("long")
    choose = F.aggregate(F.sequence(F.lit(1).cast("long"), F.greatest(size - start, F.lit(1).cast("long"))), F.lit(0.0), lambda s, i: s + F.when(size > start, F.log((start + i).cast("double") / i)).otherwise(0.0))
    first = choose + start * F.log(q) + (size - start) * F.log(1 - q)
    odds = q / (1 - q)
    zero = F.struct(F.lit(1.0).alias("t"), F.lit(0.0).alias("s"))
    run = F.aggregate(F.sequence(start, F.greatest(size, start)), zero, lambda acc, k: F.struct((acc["t"] * (size - k) / (k + 1) * odds).alias("t"), (acc["s"] + acc["t"]).alias("s")), lambda acc: acc["s"])
    return F.when(a <= 0, F.lit(1.0)).when(a > n, F.lit(0.0)).otherwise(F.least(F.lit(1.0), F.exp(first + F.log(run))))


def upper_median(values: Column | str) -> Column:
    """Aggregate: the element at place len // 2 of the sorted values (not the mean of the middle two).

    By a column's name it counts the different values map side; a column expression is collected, which suits groups of few rows.
    """
    if isinstance(values, str):
        return F.expr(f"percentile_disc(0.5) WITHIN GROUP (ORDER BY {values} DESC)")
    kept = F.array_sort(F.collect_list(values))
    return F.get(kept, F.floor(F.size(kept) / 2).cast("int"))


def chi_square_2(counts: Sequence[Column], expect: Sequence[float]) -> tuple[Column, Column]:
    """Chi-square of three counts against expected shares and its p-value (2 degrees of freedom); null without counts."""
    n = sum(counts[1:], counts[0])
    stat = sum(((c - n * p) * (c - n * p) / (n * p) for c, p in zip(counts[1:], expect[1:])), (counts[0] - n * expect[0]) * (counts[0] - n * expect[0]) / (n * expect[0]))
    stat = F.when(n > 0, stat)
    return stat, F.exp(-stat / 2)


def uniform(*parts: Column) -> Column:
    """A uniform number in [0, 1) from text, the same in every engine with md5, and independent of row order."""
    return F.conv(F.substring(F.md5(F.concat_ws(":", *parts)), 1, 8), 16, 10).cast("double") / 4294967296.0
