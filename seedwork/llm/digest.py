"""Percentiles of very large numeric columns with a stated and certified rank error, from digests that can be combined.

Method: merging centroid digests. Sorted values are clustered under a size function of the quantile (arcsine: small clusters at
both ends); digests are merged by clustering their centroids again; a second pass counts, for every estimate, the values
below it and up to it, which gives its true rank error.

Each centroid keeps its least and greatest value beside weight and mean, and equal values are one centroid however many they are, so
columns with heavy ties (counts) lose nothing: a centroid of one value answers exactly.

Plan
    1. Map side, vectorised: every task clusters its rows group by group (numpy over Arrow batches) and emits centroids. What is shuffled
       is at most a few hundred numbers a group and task, so a group with a third of all rows is no hot spot.
    2. Digests are stored per group, and any coarser grouping is merged from them in the JVM: equal centroids are added
       up map side, then a running weight gives each its cluster. Groups of very many digests are merged in rounds.
    3. Certification is a second pass over the rows: each meets the estimates of its group, which are broadcast after their groups are counted,
       and counts of values below and up to each estimate are added up map side. Its shuffle is groups x tasks x quantiles,
       for continuous columns as for counts. Beyond ``BROADCAST_GROUPS`` groups values are counted first and joined; the result is the same.
    Groups that miss the bound, if any, are answered exactly from value counts.

Defined results
    * nulls, negatives and not-a-numbers are left out (``floor`` sets the least value taken); a group without values has no row
    * a null group value is a group like any other; repeated rows count each time; an empty table gives no rows
    * the estimate for q answers rank q * n; rank_error is its distance from the ranks the estimate really holds, over n
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedwork.session import durable

QUANTILES = (0.05, 0.25, 0.5, 0.75, 0.95)
#: Compression (clusters about half as many) and the rank error that is certified. A cluster spans at most pi / DELTA of the ranks.
DELTA, BOUND, BUFFER_ROWS = 400, 0.01, 1 << 19
#: Digests merged in one go, and groups whose estimates are broadcast for counting (a few hundred bytes each).
FAN_IN, BROADCAST_GROUPS = 4096, 20_000

_CENTROID = "array<struct<lo:double,hi:double,mean:double,w:bigint>>"


def _clusters(code: np.ndarray, value: np.ndarray, delta: float) -> tuple[np.ndarray, ...]:
    """Cluster values group by group: (group, lo, hi, mean, weight) of each centroid, in order."""
    order = np.lexsort((value, code))
    code, value = code[order], value[order]
    new = np.concatenate([[True], (code[1:] != code[:-1]) | (value[1:] != value[:-1])])
    at = np.flatnonzero(new)
    w = np.diff(np.append(at, len(code)))
    g, v = code[at], value[at]
    first = np.concatenate([[True], g[1:] != g[:-1]])
    starts = np.flatnonzero(first)
    which = np.cumsum(first) - 1
    cum = np.cumsum(w)
    base = np.concatenate([[0], cum])[starts][which]
    total = np.add.reduceat(w, starts)[which]
    right = (cum - base) / total
    left = right - w / total
    scale = delta / (2 * math.pi)
    k0, k1 = scale * np.arcsin(np.clip(2 * left - 1, -1, 1)), scale * np.arcsin(np.clip(2 * right - 1, -1, 1))
    heavy = k1 - k0 >= 1
    bucket = np.floor((k0 + k1) / 2)
    edge = first | heavy | np.concatenate([[False], heavy[:-1]]) | np.concatenate([[True], bucket[1:] != bucket[:-1]])
    s = np.flatnonzero(edge)
    weight = np.add.reduceat(w, s)
    mean = np.add.reduceat(v * w, s) / weight
    e = np.append(s[1:], len(v)) - 1
    return g[s], v[s], v[e], mean, weight


def digests(df: DataFrame, group: Sequence[str], metrics: Sequence[str], delta: int = DELTA, floor: float | None = 0.0) -> DataFrame:
    """(group..., metric, n, centroids) per group: combine later, by any subset of ``group``, with :func:`merge`."""
    group, metrics = list(group), list(metrics)

    def flush(parts: list[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(parts).combine_chunks()
        code = np.zeros(len(table), dtype=np.int64)
        for i in range(len(group)):
            d = table.column(i).combine_chunks().dictionary_encode(null_encoding="encode")
            d = d.combine_chunks() if isinstance(d, pa.ChunkedArray) else d
            code = code * max(1, len(d.dictionary)) + d.indices.to_numpy(zero_copy_only=False)
            if i:
                code = np.unique(code, return_inverse=True)[1]
        uniq, head, code = np.unique(code, return_index=True, return_inverse=True)
        for m, name in enumerate(metrics):
            values = table.column(len(group) + m).combine_chunks().cast(pa.float64()).to_numpy(zero_copy_only=False)
            ok = ~np.isnan(values)
            if floor is not None:
                ok &= ~(values < floor)
            if not ok.any():
                continue
            g, lo, hi, mean, w = _clusters(code[ok], values[ok] + 0.0, delta)
            cut = np.flatnonzero(np.concatenate([[True], g[1:] != g[:-1]]))
            items = pa.StructArray.from_arrays([pa.array(lo), pa.array(hi), pa.array(mean), pa.array(w)], ["lo", "hi", "mean", "w"])
            lists = pa.ListArray.from_arrays(pa.array(np.append(cut, len(g)).astype(np.int32)), items)
            keys = [table.column(i).take(pa.array(head[g[cut]])).combine_chunks() for i in range(len(group))]
            n = np.add.reduceat(w, cut)
            yield pa.RecordBatch.from_arrays([*keys, pa.array([name] * len(cut)), pa.array(n), lists], names=[*[f"g{i}" for i in range(len(group))], "metric", "n", "centroids"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        rows = 0
        for batch in batches:
            held.append(batch)
            rows += len(batch)
            if rows >= BUFFER_ROWS:
                yield from flush(held)
                held, rows = [], 0
        if rows:
            yield from flush(held)

    narrow = df.select(*[F.col(c).alias(f"g{i}") for i, c in enumerate(group)], *[F.col(c).cast("double").alias(f"m{i}") for i, c in enumerate(metrics)])
    schema = ", ".join([f"g{i} {narrow.schema[f'g{i}'].dataType.simpleString()}" for i in range(len(group))] + ["metric string", "n bigint", f"centroids {_CENTROID}"])
    return narrow.mapInArrow(run, schema).select(*[F.col(f"g{i}").alias(c) for i, c in enumerate(group)], "metric", "n", "centroids")


def merge(parts: DataFrame, group: Sequence[str], delta: int = DELTA, fan_in: int = FAN_IN) -> DataFrame:
    """Digests of coarser groups: (group..., metric, n, centroids), from digests of any finer grouping or of separate loads.

    No merge takes more than about ``fan_in`` digests at once: larger groups are first merged in hashed shares, and these again.
    """
    by = [*group, "metric"]
    parts = parts.select(*by, "centroids")
    most = parts.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    while most > fan_in:
        most = -(-most // fan_in)
        parts = _merge(parts.withColumn("__share", F.pmod(F.xxhash64("centroids"), F.lit(most))), [*by, "__share"], delta)
    return _merge(parts, by, delta)


def _merge(parts: DataFrame, by: list[str], delta: int) -> DataFrame:
    flat = parts.select(*by, F.inline("centroids"))
    flat = flat.groupBy(*by, "lo", "hi", "mean").agg(F.sum("w").alias("w"))
    whole = Window.partitionBy(*by)
    line = whole.orderBy("mean", "lo", "hi")
    held = flat.withColumn("n", F.sum("w").over(whole)).withColumn("right", F.sum("w").over(line.rowsBetween(Window.unboundedPreceding, 0)))
    scale = delta / (2 * math.pi)

    def k(rank: Column) -> Column:
        return F.lit(scale) * F.asin(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), 2 * rank / F.col("n") - 1)))

    k0, k1 = k(F.col("right") - F.col("w")), k(F.col("right"))
    held = held.withColumn("heavy", F.when(k1 - k0 >= 1, F.col("right"))).withColumn("bucket", F.floor((k0 + k1) / 2))
    joined = held.groupBy(*by, "n", "heavy", "bucket").agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), (F.sum(F.col("mean") * F.col("w")) / F.sum("w")).alias("mean"), F.sum("w").alias("w"))
    return joined.groupBy(*by, "n").agg(F.array_sort(F.collect_list(F.struct("mean", "lo", "hi", "w"))).alias("c")).select(*by, "n", F.transform("c", lambda x: F.struct(x["lo"].alias("lo"), x["hi"].alias("hi"), x["mean"].alias("mean"), x["w"].alias("w"))).alias("centroids"))


def estimate(merged: DataFrame, quantiles: Sequence[float] = QUANTILES) -> DataFrame:
    """Adds ``q`` and ``estimate``, one row per quantile: the centroid that holds the rank, interpolated between its least and greatest value."""

    def at(q: float) -> Column:
        rank = F.greatest(F.lit(1.0), F.ceil(F.col("n") * q - 1e-9).cast("double"))
        start = F.struct(F.lit(0.0).alias("cum"), F.lit(None).cast("double").alias("x"))

        def step(acc: Column, c: Column) -> Column:
            inside = F.when(c["lo"] == c["hi"], c["lo"]).otherwise(c["lo"] + (c["hi"] - c["lo"]) * ((rank - acc["cum"] - 0.5) / c["w"]))
            x = F.when(acc["x"].isNull() & (acc["cum"] + c["w"] >= rank), inside).otherwise(acc["x"])
            return F.struct((acc["cum"] + c["w"]).alias("cum"), x.alias("x"))

        return F.aggregate("centroids", start, step, lambda acc: acc["x"])

    by = [c for c in merged.columns if c != "centroids"]
    return merged.select(*by, F.inline(F.array(*[F.struct(F.lit(float(q)).alias("q"), at(q).alias("estimate")) for q in quantiles])))


def value_counts(df: DataFrame, group: Sequence[str], metrics: Sequence[str], floor: float | None = 0.0) -> DataFrame:
    """(group..., metric, value, k): how often each value occurs, counted map side first."""
    pairs = F.inline(F.array(*[F.struct(F.lit(m).alias("metric"), F.col(m).cast("double").alias("value")) for m in metrics]))
    long = df.select(*group, pairs).where(F.col("value").isNotNull() & ~F.isnan("value"))
    long = long if floor is None else long.where(F.col("value") >= floor)
    return long.groupBy(*group, "metric", "value").agg(F.count(F.lit(1)).alias("k"))


def _ranks_broadcast(df: DataFrame, estimates: DataFrame, group: Sequence[str], metrics: Sequence[str], floor: float | None) -> DataFrame:
    """(group..., metric, n, q, estimate, below, upto), counted map side: a row of ``df`` meets the few estimates of its group and only counts are shuffled."""
    item = F.struct("q", "estimate", "n")
    wide = estimates.groupBy(*group).agg(*[F.sort_array(F.collect_list(F.when(F.col("metric") == m, item))).alias(f"__e{i}") for i, m in enumerate(metrics)])
    width = max([x or 0 for x in wide.agg(*[F.max(F.size(f"__e{i}")) for i in range(len(metrics))]).first()], default=0)
    places = [(i, k) for i in range(len(metrics)) for k in range(width)]
    if not places:
        return estimates.select("*", F.lit(0).cast("long").alias("below"), F.lit(0).cast("long").alias("upto"))
    same = lambda a, b: [F.col(f"{a}.{c}").eqNullSafe(F.col(f"{b}.{c}")) for c in group]
    # The rows meet plain numbers; which quantile each is comes back from the short table afterwards.
    flat = wide.select(*group, *[F.get(f"__e{i}", F.lit(k))["estimate"].alias(f"__e{i}_{k}") for i, k in places])
    rows = df.select(*group, *[F.col(m).cast("double").alias(f"__v{i}") for i, m in enumerate(metrics)])
    if floor is not None:
        rows = rows.withColumns({f"__v{i}": F.when(F.col(f"__v{i}") >= floor, F.col(f"__v{i}")) for i in range(len(metrics))})
    met = rows.alias("v").join(F.broadcast(flat).alias("w"), same("v", "w")).select(*[F.col(f"w.{c}").alias(c) for c in group], *[F.col(f"w.__e{i}_{k}") for i, k in places], *[F.col(f"v.__v{i}") for i in range(len(metrics))])
    counted = met.groupBy(*group).agg(*[f(F.col(f"__v{i}"), F.col(f"__e{i}_{k}")).alias(f"__{name}{i}_{k}") for i, k in places for name, f in (("b", lambda v, e: F.count_if(v < e)), ("u", lambda v, e: F.count_if(v <= e)))])
    held = counted.alias("c").join(wide.alias("w"), same("c", "w")).select("c.*", *[F.col(f"w.__e{i}") for i in range(len(metrics))])
    told = F.array_compact(F.array(*[F.when(F.size(f"__e{i}") > k, F.struct(F.lit(metrics[i]).alias("metric"), F.get(f"__e{i}", F.lit(k)).alias("e"), F.col(f"__b{i}_{k}").alias("below"), F.col(f"__u{i}_{k}").alias("upto"))) for i, k in places]))
    return held.select(*group, F.inline(told)).select(*group, "metric", "e.n", "e.q", "e.estimate", "below", "upto")


def _ranks_joined(counts: DataFrame, estimates: DataFrame, group: Sequence[str]) -> DataFrame:
    """The same for more groups than are broadcast: values are counted map side first, and a shuffled join brings them to the estimates."""
    by = [*group, "metric"]
    wide = estimates.groupBy(*by, "n").agg(F.sort_array(F.collect_list(F.struct("q", "estimate"))).alias("e"))
    on = [F.col(f"v.{c}").eqNullSafe(F.col(f"w.{c}")) for c in by]
    met = counts.alias("v").join(wide.alias("w"), on).select(*[F.col(f"w.{c}").alias(c) for c in by], "n", "value", "k", F.inline("e"))
    return met.groupBy(*by, "n", "q", "estimate").agg(F.sum(F.when(F.col("value") < F.col("estimate"), F.col("k")).otherwise(0)).alias("below"), F.sum(F.when(F.col("value") <= F.col("estimate"), F.col("k")).otherwise(0)).alias("upto"))


def certify(df: DataFrame, estimates: DataFrame, group: Sequence[str], metrics: Sequence[str], floor: float | None = 0.0, broadcast_groups: int = BROADCAST_GROUPS) -> DataFrame:
    """Adds ``rank_error`` to the estimates, from a second pass over the rows that counts those below and up to each."""
    few = estimates.select(*group).distinct().limit(broadcast_groups + 1).count() <= broadcast_groups
    ranks = _ranks_broadcast(df, estimates, group, metrics, floor) if few else _ranks_joined(value_counts(df, group, metrics, floor), estimates, group)
    aim = F.greatest(F.lit(1.0), F.ceil(F.col("n") * F.col("q") - 1e-9).cast("double"))
    # The estimate stands at ranks below + 1 .. max(upto, below + 1), or between two values at below + 0.5.
    off = F.greatest(F.lit(0.0), F.col("below") + F.when(F.col("upto") > F.col("below"), 1.0).otherwise(0.0) - aim, aim - F.greatest("upto", F.col("below") + F.when(F.col("upto") > F.col("below"), 1).otherwise(1)))
    return ranks.withColumn("rank_error", off / F.col("n")).drop("below", "upto")


def exact(counts: DataFrame, group: Sequence[str], quantiles: Sequence[float]) -> DataFrame:
    """Exact answers from value counts, in the form of :func:`certify`. The running sum streams, so memory is bounded."""
    by = [*group, "metric"]
    line = Window.partitionBy(*by).orderBy("value")
    held = counts.withColumn("upto", F.sum("k").over(line.rowsBetween(Window.unboundedPreceding, 0))).withColumn("below", F.col("upto") - F.col("k"))
    n = counts.groupBy(*by).agg(F.sum("k").alias("n"))
    on = [F.col(f"v.{c}").eqNullSafe(F.col(f"t.{c}")) for c in by]
    held = held.alias("v").join(n.alias("t"), on).select("v.*", "t.n")
    q = F.explode(F.array(*[F.lit(float(x)) for x in quantiles])).alias("q")
    aim = F.greatest(F.lit(1.0), F.ceil(F.col("n") * F.col("q") - 1e-9).cast("double"))
    return held.select("*", q).where((aim > F.col("below")) & (aim <= F.col("upto"))).select(*by, "n", "q", F.col("value").alias("estimate"), F.lit(0.0).alias("rank_error"))


def percentiles(df: DataFrame, parts: DataFrame, group: Sequence[str], metrics: Sequence[str], quantiles: Sequence[float] = QUANTILES, delta: int = DELTA, bound: float = BOUND, floor: float | None = 0.0) -> DataFrame:
    """Certified percentiles of ``df`` per group from the stored digests ``parts``: group..., metric, n, q, estimate, rank_error, error_bound."""
    by = [*group, "metric"]
    estimates = durable(estimate(merge(parts, group, delta), quantiles))  # read for its groups and for the counting
    checked = durable(certify(df, estimates, group, metrics, floor))
    missed = checked.where(F.col("rank_error") > bound).select(*by).distinct()
    if not missed.isEmpty():
        counts = value_counts(df, group, metrics, floor)
        on = [F.col(f"a.{c}").eqNullSafe(F.col(f"m.{c}")) for c in by]
        again = exact(counts.alias("a").join(missed.alias("m"), on, "left_semi"), group, quantiles)
        checked = checked.alias("a").join(missed.alias("m"), on, "left_anti").unionByName(again)
    return checked.withColumn("error_bound", F.lit(bound))
