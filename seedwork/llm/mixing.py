"""Mixing sources to target weights.

Method: entropy balancing. Each document gets a rate of use as close as possible, in relative entropy, to "once each", such that every
source's tokens come to its share of the total and no rate exceeds the source's cap. The solution is an exponential tilt in the document's
size, rate = min(cap, exp(lambda * tokens / mean)), with one multiplier a source; the multipliers solve a convex dual, by
Newton steps whose sums are computed by Spark. Rates are then rounded into copies.

Plan
    * Rates depend on a document only through source and size, so the sums run over the distinct (source, size) pairs with their
      counts, written once; each step sends back two numbers a source. Only sources with a target take part: they are at most
      ``max_sources`` (counted first), which bounds what is collected and broadcast, however many sources the corpus has.
    * Rounding is systematic: along sizes in order, a document gets floor(c) - floor(c - rate) copies, c being the running sum of
      rates. A source's documents are dealt by hash into parts of about ``part_rows``, known from the counts before any shuffle, so the one
      shuffle spreads a hot source or size; a part begins at a random place between two copies, so errors of parts do not add up.
    * Documents that cannot be used (no target, no tokens) skip that shuffle. ``tokens`` is read three times: hand in a written table.

Defined results
    * total size: ``total`` tokens, or by default the largest total at which every source that has documents can fill its share
      under its cap. The source that binds it is then used to its cap throughout (``at_cap`` in the report). Shares of sources without
      documents go to the others in proportion, and the report shows both
    * with a given ``total``, sources that cannot fill their share are used to the cap and fall short in the report
    * documents of null source, of a source without target and of no tokens (null and empty texts) get 0 copies
    * repeated rows of ``targets``: the largest share and the least cap of a source hold; null or negative shares count as 0
    * repeated ids are documents of their own; empty tables give no rows; input columns named rate or copies are replaced
    * a multiplier that has not met its constraint after ``steps`` steps is an error, never a silent result
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seedwork.session import durable


@dataclass(frozen=True)
class Tilt:
    """The solution for one source; ``residual`` is what is missing from the goal, over the goal."""

    source: str
    target_share: float
    share: float
    cap: int
    mean: float
    multiplier: float
    goal: float
    docs: int = 0
    at_cap: bool = False
    residual: float = 0.0


def _targets(targets: DataFrame, max_sources: int) -> dict[str, tuple[float, int]]:
    rows = targets.where(F.col("source").isNotNull()).groupBy("source").agg(F.max("target_share").alias("share"), F.min("max_repeats").alias("cap")).limit(max_sources + 1).collect()
    if len(rows) > max_sources:
        raise ValueError(f"more than {max_sources} sources have a target")
    return {r["source"]: (max(0.0, r["share"] or 0.0), max(0, r["cap"] if r["cap"] is not None else 1)) for r in rows}


def _table(df: DataFrame, values: dict[str, tuple]) -> DataFrame:
    """One row a source with a target, to be broadcast: (source, __cap, __mean, __at, __docs)."""
    return F.broadcast(df.sparkSession.createDataFrame([(s, *map(float, v)) for s, v in values.items()], "source string, __cap double, __mean double, __at double, __docs double"))


def _raw():
    return F.exp(F.least(F.lit(700.0), F.col("__at") * F.col("n_tokens") / F.col("__mean")))


def solve(sizes: DataFrame, targets: DataFrame, total: float | None = None, max_sources: int = 10_000, steps: int = 60, tolerance: float = 1e-9) -> list[Tilt]:
    """The multipliers. ``sizes``: (source, n_tokens, k)."""
    wanted = _targets(targets, max_sources)
    named = _table(sizes, {s: (cap, 1, 0, 0) for s, (_, cap) in wanted.items()})
    sums = sizes.join(named, "source", "left_semi").groupBy("source").agg(F.sum(F.col("n_tokens") * F.col("k")).cast("double").alias("t"), F.sum("k").cast("double").alias("k"))
    have = {r["source"]: (r["t"], r["k"]) for r in sums.collect()}
    live = {s: wanted[s] for s in have if wanted[s][0] > 0 and wanted[s][1] > 0}
    scale = sum(share for share, _ in live.values())
    share = {s: x[0] / scale for s, x in live.items()}
    if total is None and live:
        total = min(live[s][1] * have[s][0] / share[s] for s in live)
    most = {s: live[s][1] * have[s][0] for s in live}
    goal = {s: min(share[s] * total, most[s]) for s in live}
    mean = {s: have[s][0] / have[s][1] for s in live}
    full = {s for s in live if goal[s] >= most[s] * (1 - 1e-12)}
    low, high, at, left = {s: -700.0 for s in live}, {s: 700.0 for s in live}, {s: 0.0 for s in live}, {s: 0.0 for s in live}
    # A source that must be used to the cap has no finite multiplier; the largest one makes every rate the cap.
    at.update({s: 700.0 * max(1.0, mean[s]) for s in full})
    open_ = set(live) - full
    for _ in range(steps):
        if not open_:
            break
        here = sizes.join(_table(sizes, {s: (live[s][1], mean[s], at[s], 0) for s in open_}), "source")
        raw, used = _raw(), F.col("k") * F.col("n_tokens")
        slope = F.sum(F.when(raw < F.col("__cap"), used * F.col("n_tokens") / F.col("__mean") * raw).otherwise(0.0))
        for r in here.groupBy("source").agg(F.sum(used * F.least(F.col("__cap"), raw)).alias("g"), slope.alias("h")).collect():
            s, gap = r["source"], r["g"] - goal[r["source"]]
            left[s] = abs(gap) / max(1.0, goal[s])
            (high if gap > 0 else low)[s] = at[s]
            if left[s] <= tolerance or high[s] - low[s] < 1e-13 * max(1.0, abs(at[s])):
                open_.discard(s)
                continue
            step = at[s] - gap / r["h"] if r["h"] > 0 else math.inf
            at[s] = step if low[s] < step < high[s] else (low[s] + high[s]) / 2
    short = {s: left[s] for s in live if left[s] > 1e-6}
    if short:
        raise ValueError(f"no solution within {steps} steps for {short}")
    return [Tilt(s, wanted[s][0], share.get(s, 0.0), wanted[s][1], mean.get(s, 1.0), at.get(s, 0.0), goal.get(s, 0.0), int(have[s][1]) if s in have else 0, s in full, left.get(s, 0.0)) for s in sorted(wanted)]


def mix(tokens: DataFrame, targets: DataFrame, total: float | None = None, part_rows: int = 50_000, max_sources: int = 10_000) -> tuple[DataFrame, list[Tilt]]:
    """(key columns..., source, n_tokens, rate, copies) of every document, and the solution. ``tokens`` holds source and n_tokens."""
    sizes = durable(tokens.where(F.col("source").isNotNull() & (F.col("n_tokens") > 0)).groupBy("source", "n_tokens").agg(F.count(F.lit(1)).alias("k")))
    tilts = solve(sizes, targets, total, max_sources)
    rest = [c for c in tokens.columns if c not in ("source", "n_tokens", "rate", "copies")]
    held = tokens.select(*rest, "source", "n_tokens").join(_table(tokens, {t.source: (t.cap, t.mean, t.multiplier, t.docs) for t in tilts if t.goal > 0}), "source", "left")
    rate = F.when((F.col("n_tokens") > 0) & F.col("__cap").isNotNull(), F.least(F.col("__cap"), _raw()))
    held = held.withColumn("rate", F.coalesce(rate, F.lit(0.0)))
    idle = held.where(F.col("rate") <= 0).select(*rest, "source", "n_tokens", "rate", F.lit(0).alias("copies"))
    parts = F.ceil(F.col("__docs") / part_rows)
    live = held.where(F.col("rate") > 0).withColumn("__h", F.xxhash64(*rest, "n_tokens")).withColumn("__part", F.pmod("__h", parts))
    line = Window.partitionBy("source", "__part").orderBy("n_tokens", "__h")
    start = F.when(parts > 1, F.pmod(F.xxhash64("source", "__part"), F.lit(1 << 20)) / float(1 << 20)).otherwise(0.5)
    upto = F.sum("rate").over(line.rowsBetween(Window.unboundedPreceding, 0))
    before = F.coalesce(F.sum("rate").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0))
    copies = F.least(F.floor(start + upto) - F.floor(start + before), F.col("__cap"))
    return live.select(*rest, "source", "n_tokens", "rate", copies.cast("int").alias("copies")).unionByName(idle), tilts


def shares(mixed: DataFrame, tilts: list[Tilt]) -> DataFrame:
    """Per source: the target share, the share aimed at, what came out, how often documents are used, and whether all are used to the cap."""
    used = mixed.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.sum(F.col("copies") * F.col("n_tokens")).alias("tokens"), F.sum("copies").alias("copies"), F.max("copies").alias("most_copies"))
    aims = mixed.sparkSession.createDataFrame([(t.source, t.target_share, t.share, t.at_cap) for t in tilts], "source string, target_share double, aimed_share double, at_cap boolean")
    zero = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    out = used.join(F.broadcast(aims), "source", "full").select("source", "target_share", "aimed_share", zero("n_docs"), zero("tokens"), zero("copies"), zero("most_copies"), F.coalesce("at_cap", F.lit(False)).alias("at_cap"))
    total = mixed.agg(F.sum(F.col("copies") * F.col("n_tokens"))).scalar()
    return out.withColumn("actual_share", F.col("tokens") / total)
