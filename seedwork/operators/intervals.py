"""Intervals on a line: merging, clipping, lookups of points, breakpoints, and tables built from them.

Ends are inclusive. A point between intervals is *unknown* (null), which is not state 0.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedwork.operators.labels import GuardError
from seedwork.session import durable


#: Bases of one part of a group in windows along a line: a chromosome is no single task.
PART = 1 << 22


def _islands(df: DataFrame, by: Sequence[str], start: str, end: str, touch: int) -> DataFrame:
    w = Window.partitionBy(*by).orderBy(start, end)
    before = F.max(end).over(w.rowsBetween(Window.unboundedPreceding, -1))
    rows = df.withColumn("__new", F.when(before.isNull() | (F.col(start) > before + touch), 1).otherwise(0))
    rows = rows.withColumn("__run", F.sum("__new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return rows.groupBy(*by, "__run").agg(F.min(start).alias(start), F.max(end).alias(end)).drop("__run")


def merge_intervals(df: DataFrame, by: Sequence[str], start: str = "start", end: str = "end", touch: int = 0, part: int = PART) -> DataFrame:
    """Overlapping or touching intervals become one. ``touch`` is the distance still counted as touching (0 for half-open ends, 1 for
    inclusive integers). Running maximum of the ends, then islands.

    Intervals are merged first within parts of ``part`` bases by their start, which spreads a large group, then the islands of all parts; repeated
    intervals collapse before the shuffle. Null starts and ends form no interval.
    """
    rows = df.where(F.col(start).isNotNull() & F.col(end).isNotNull()).groupBy(*by, start, end).agg(F.first(F.lit(1)).alias("__one")).drop("__one")
    cut = rows.withColumn("__part", F.floor(F.col(start) / part))
    return _islands(_islands(cut, [*by, "__part"], start, end, touch).drop("__part"), by, start, end, touch)


def clip_intervals(df: DataFrame, low: int, high: int, start: str = "start", end: str = "end") -> DataFrame:
    """Half-open intervals cut to [low, high); empty ones go."""
    cut = df.withColumn(start, F.greatest(F.col(start), F.lit(low))).withColumn(end, F.least(F.col(end), F.lit(high)))
    return cut.where(F.col(start) < F.col(end))


def region_bed(df: DataFrame, by: Sequence[str], low: int, high: int, allow_empty: bool = True) -> DataFrame:
    """Ranges of a region: clipped, merged where they overlap or touch. An empty result is refused unless it is allowed."""
    got = merge_intervals(clip_intervals(df, low, high), by)
    if not allow_empty and got.isEmpty():
        raise GuardError(f"no range within {low}-{high}")
    return got


def one_based(ranges: DataFrame, chrom: str = "chrom") -> DataFrame:
    """Adds ``region``: half-open ranges as ``chrom:start-end``, counted from one, ends included."""
    return ranges.withColumn("region", F.concat(F.col(chrom).cast("string"), F.lit(":"), (F.col("start") + 1).cast("string"), F.lit("-"), F.col("end").cast("string")))


def state_at(points: DataFrame, segments: DataFrame, by: Sequence[str], position: str, start: str, end: str, state: str, out: str, bin_width: int | None = None) -> DataFrame:
    """State of the rightmost segment that starts at or before each point, null if it has ended.

    Both sides are stacked and carried forward in one window per group: one shuffle, no pairs. A group with very many points can be
    cut into bins of ``bin_width``: segments are then repeated in every bin they reach, which needs segments that do not overlap.
    """
    segs = segments.select(*by, F.col(start).alias("__p"), F.lit(0).alias("__k"), F.struct(F.col(start).alias("s"), F.col(end).alias("e"), F.col(state).alias("v")).alias("__s"))
    kind = segs.schema["__s"].dataType
    pts = points.withColumn("__p", F.col(position)).withColumn("__k", F.lit(1)).withColumn("__s", F.lit(None).cast(kind))
    keys = list(by)
    if bin_width:
        keys.append("__bin")
        pts = pts.withColumn("__bin", F.floor(F.col(position) / bin_width))
        reach = F.sequence(F.floor(F.col("__s.s") / bin_width), F.floor(F.greatest(F.col("__s.e"), F.col("__s.s")) / bin_width))
        segs = segs.withColumn("__bin", F.explode(reach))
    w = Window.partitionBy(*keys).orderBy("__p", "__k").rowsBetween(Window.unboundedPreceding, 0)
    both = pts.unionByName(segs, allowMissingColumns=True).withColumn("__l", F.last("__s", ignorenulls=True).over(w))
    return both.where(F.col("__k") == 1).select(*points.columns, F.when(F.col("__l.e") >= F.col(position), F.col("__l.v")).alias(out))


def segment_index(segments: DataFrame, by: Sequence[str], start: str = "start", end: str = "end", state: str = "state", cells: int = 256) -> DataFrame:
    """One row a group for :func:`state_in`: its segments in order, and for each of ``cells`` equal stretches of its span how many have begun before it."""
    held = segments.groupBy(*by).agg(F.array_sort(F.collect_list(F.struct(F.col(start).cast("long").alias("start"), F.col(end).cast("long").alias("end"), F.col(state).alias("state")))).alias("segs"))
    low, high = F.col("segs")[0]["start"], F.array_max(F.transform("segs", lambda s: s["start"]))
    held = held.withColumn("low", low).withColumn("width", F.floor((high - low) / cells) + 1)
    begun = F.transform(F.sequence(F.lit(0), F.lit(cells)), lambda b: F.size(F.filter("segs", lambda s: s["start"] < F.col("low") + b * F.col("width"))))
    return held.withColumn("begun", begun)


def state_in(index: str, position: Column) -> Column:
    """State at a position by the struct of :func:`segment_index` in the same row: that of the rightmost segment that has begun, null if it
    has ended. Only the segments that begin within the position's stretch, and the one before, are looked at."""
    x = F.col(index)
    cell = F.least(F.floor((position - x["low"]) / x["width"]), F.size(x["begun"]) - 2).cast("int")
    first = F.greatest(F.get(x["begun"], cell), F.lit(1))
    near = F.slice(x["segs"], first, F.greatest(F.get(x["begun"], cell + 1) - first + 1, F.lit(1)))
    last = F.try_element_at(F.filter(near, lambda s: s["start"] <= position), F.lit(-1))
    return F.when(position >= x["low"], F.when(last["end"] >= position, last["state"]))


def in_ranges(points: DataFrame, ranges: DataFrame, by: Sequence[str], position: str, start: str = "start", end: str = "end", bin_width: int = 1 << 16) -> DataFrame:
    """Points inside any range (semi-join). Ranges are repeated over bins of the line, so the join has an equality to spread by."""
    spread = ranges.select(*by, F.col(start).alias("__a"), F.col(end).alias("__b"), F.explode(F.sequence(F.floor(F.col(start) / bin_width), F.floor(F.col(end) / bin_width))).alias("__bin"))
    held = points.withColumn("__bin", F.floor(F.col(position) / bin_width))
    on = [F.col(f"p.{c}") == F.col(f"r.{c}") for c in (*by, "__bin")] + [F.col(f"p.{position}").between(F.col("r.__a"), F.col("r.__b"))]
    return held.alias("p").join(spread.alias("r"), on, "left_semi").drop("__bin")


def breakpoints(segments: DataFrame, line: str = "line", start: str = "start", end: str = "end", state: str = "state") -> DataFrame:
    """Midpoints between neighbouring segments whose states differ."""
    w = Window.partitionBy(line).orderBy(start)
    rows = segments.select(line, F.col(end).alias("__e"), F.col(state).alias("__v"), F.lead(start).over(w).alias("__s2"), F.lead(state).over(w).alias("__v2"))
    return rows.where(F.col("__v") != F.col("__v2")).select(line, ((F.col("__e") + F.col("__s2")) / 2.0).alias("breakpoint"))


def running_counts(points: DataFrame, items: DataFrame, by: Sequence[str], position: str, values: Sequence[str], include: bool, part: int = PART) -> DataFrame:
    """Adds to the points, for each of ``values``, its sum over the items of the group below each point (``include``: up to each point).

    ``items``: by..., ``position``, values. Groups are cut in parts along the line: parts' totals, summed up, give what lies before a part, and a
    window runs within each part only.
    """
    keys = list(by)
    at = lambda df: df.withColumn("__p", F.col(position).cast("double")).withColumn("__part", F.floor(F.col("__p") / part))
    held = at(items).groupBy(*keys, "__part", "__p").agg(*[F.sum(v).alias(f"__v_{v}") for v in values])
    totals = held.groupBy(*keys, "__part").agg(*[F.sum(f"__v_{v}").alias(f"__t_{v}") for v in values])
    # Totals of all parts that points or items lie in, and what lies before each.
    pts = at(points)
    every = pts.select(*keys, "__part").distinct().withColumn("__asked", F.lit(1)).unionByName(totals, allowMissingColumns=True)
    line = Window.partitionBy(*keys).orderBy("__part")
    per = every.groupBy(*keys, "__part").agg(*[F.coalesce(F.sum(f"__t_{v}"), F.lit(0)).alias(f"__t_{v}") for v in values], F.max("__asked").alias("__asked"))
    before = per.select(*keys, "__part", "__asked", *[F.coalesce(F.sum(f"__t_{v}").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias(f"__o_{v}") for v in values]).where("__asked = 1").drop("__asked")
    # Of equal positions the points come first, so a running sum counts what is strictly below; with ``include`` they come last.
    both = pts.withColumn("__k", F.lit(1 if include else -1)).unionByName(held.withColumn("__k", F.lit(0)), allowMissingColumns=True)
    w = Window.partitionBy(*keys, "__part").orderBy("__p", "__k").rowsBetween(Window.unboundedPreceding, 0)
    own = both.select("*", *[F.coalesce(F.sum(f"__v_{v}").over(w), F.lit(0)).alias(f"__s_{v}") for v in values]).where(F.col("__k") != 0)
    on = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in (*keys, "__part")]
    met = own.alias("a").join(before.alias("b"), on, "left")
    return met.select(*[F.col(f"a.{c}").alias(c) for c in points.columns], *[(F.col(f"a.__s_{v}") + F.coalesce(F.col(f"b.__o_{v}"), F.lit(0))).alias(v) for v in values])


def marker_ranks(points: DataFrame, markers: DataFrame, by: Sequence[str], position: str = "pos", part: int = PART) -> DataFrame:
    """Adds ``rank``: how many markers of the group lie strictly below each point."""
    return running_counts(points, markers.select(*by, position, F.lit(1).alias("rank")), by, position, ["rank"], False, part)


def breakpoint_density(segments: DataFrame, sites: DataFrame, window: int = 500) -> DataFrame:
    """Per line and in total (line null): breakpoints, gap sites within ``window`` markers of one and beyond, and the share decided by step 2.

    ``segments``: line, chrom, start, end, state. ``sites``: chrom, pos, is_marker (own sites), is_gap, is_step2. Around each line's
    breakpoints the near ranges of marker ranks are merged; a cumulative count of gaps by rank then gives the numbers, so lines and gaps
    are never multiplied.
    """
    line = segments.withColumn("__lc", F.struct("line", "chrom"))
    breaks = durable(breakpoints(line, "__lc").select("__lc.line", "__lc.chrom", F.col("breakpoint").alias("pos")))  # few, and read twice
    markers = sites.where("is_marker").select("chrom", "pos")
    ranges = marker_ranks(breaks, markers, ["chrom"]).select("line", "chrom", (F.col("rank") - window).alias("start"), (F.col("rank") + window).alias("end"))
    merged = merge_intervals(ranges, ["line", "chrom"], touch=1)
    gaps = durable(marker_ranks(sites.where("is_gap").select("chrom", "pos", "is_step2"), markers, ["chrom"]).groupBy("chrom", "rank").agg(F.count(F.lit(1)).alias("g"), F.count_if("is_step2").alias("g2")))  # one row a rank, read three times
    ends = F.explode(F.array(F.struct((F.col("start") - 1).alias("rank"), F.lit(-1).alias("sign")), F.struct(F.col("end").alias("rank"), F.lit(1).alias("sign")))).alias("e")
    asked = merged.select("line", "chrom", ends).select("line", "chrom", "e.rank", "e.sign")
    told = running_counts(asked, gaps.withColumnsRenamed({"g": "c", "g2": "c2"}), ["chrom"], "rank", ["c", "c2"], True)
    near = told.groupBy("line").agg(F.sum(F.col("sign") * F.col("c")).alias("near"), F.sum(F.col("sign") * F.col("c2")).alias("near_2"))
    whole = gaps.agg(F.struct(F.coalesce(F.sum("g"), F.lit(0)).alias("g"), F.coalesce(F.sum("g2"), F.lit(0)).alias("g2"))).scalar()
    nb = breaks.groupBy("line").agg(F.count(F.lit(1)).alias("n_breakpoints"))
    rows = segments.select("line").distinct().join(near, "line", "left").join(nb, "line", "left").fillna(0, ["near", "near_2", "n_breakpoints"])
    rows = rows.withColumn("far", whole["g"] - F.col("near")).withColumn("far_2", whole["g2"] - F.col("near_2"))
    total = rows.agg(*[F.sum(c).alias(c) for c in ("near", "near_2", "far", "far_2", "n_breakpoints")]).withColumn("line", F.lit(None).cast(rows.schema["line"].dataType))
    both = rows.unionByName(total.select(*rows.columns))
    share = lambda a, b: F.col(a) / F.when(F.col(b) != 0, F.col(b))
    return both.withColumn("share_near", share("near_2", "near")).withColumn("share_far", share("far_2", "far"))
