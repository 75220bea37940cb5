"""Splitting oversized items at natural boundaries: long marker tracks into pieces with overlap.

Method: the gaps between neighbouring positions become one letter each, by width, and the track a string. A regular expression
with bounded quantifiers cuts it: alternatives in the order of boundary strength consume up to the limit and end at the
last boundary of their strength, and the last alternative takes any character. The piece lengths give offsets, and lookback
offsets give each piece the last markers of the one before. All of it is SQL array and string functions.

Plan for skew
    1. Positions are collected as sets per (track, bin of ``bin_width`` bases): duplicates, repeated rows and spellings of a contig
       collapse before the shuffle, and no set can exceed the bin's width however many rows a track has. The bins are written once.
    2. A bin's inner gaps become letters where it lies. Along a track only these strings travel, one byte a marker, with the bins' ends, from
       which the letters between bins come. A track's string is cut as a whole, so its length changes nothing in the rule.
    3. A piece is a range of marker numbers; it goes to the one or few bins it reaches by an equality join, which gives it its positions. No
       row ever holds more positions than a bin, and no more than ``limit`` come together for a piece.

Defined results
    * rows with a null position are no markers; a null run, sample or contig is a value like any other
    * a leading ``chr`` of a contig, in any case, is dropped; nothing else of its spelling counts
    * repeated positions of a track count once; tracks of at most ``limit`` different positions give nothing
    * pieces of a track are numbered from 0
    * an empty table gives no rows; extra columns are not read
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedwork.session import durable

TRACK = ("run_id", "sample", "contig")


def contig_name(contig: Column) -> Column:
    return F.regexp_replace(contig, r"\A(?i)chr", "")


def cut_pattern(first: int, later: int, levels: int) -> str:
    """The cutting expression. Letters ``a``, ``b``, ... are gaps from the widest class down; the last letter is no boundary.

    A rest that fits is taken whole. ``first`` bounds a piece at the start of the string, ``later`` any other.
    """
    letters = [chr(ord("a") + i) for i in range(levels)]
    parts = []
    for head, most in ((r"\A", first), ("", later)) if first else (("", later),):
        parts.append(rf"{head}.{{1,{most}}}\z")
        parts += [rf"{head}.{{0,{most - 1}}}{c}" for c in letters]
        parts.append(rf"{head}.{{1,{most}}}")
    return "|".join(parts)


def _same(a: str, b: str, names: Sequence[str]) -> list[Column]:
    return [F.col(f"{a}.{n}").eqNullSafe(F.col(f"{b}.{n}")) for n in names]


def marker_bins(obs: DataFrame, bin_width: int = 1 << 22) -> DataFrame:
    """(run_id, sample, contig, bin, offs): the different positions of each bin of a track, as ordered offsets."""
    marks = obs.select("run_id", "sample", contig_name(F.col("contig")).alias("contig"), F.floor(F.col("position") / bin_width).alias("bin"), F.col("position")).where(F.col("position").isNotNull())
    marks = marks.withColumn("off", (F.col("position") - F.col("bin") * bin_width).cast("int")).drop("position")
    return marks.groupBy(*TRACK, "bin").agg(F.array_sort(F.collect_set("off")).alias("offs"))


def cut_tracks(bins: DataFrame, limit: int = 500, overlap: int = 20, gaps: Sequence[int] = (1_000_000, 100_000, 10_000), bin_width: int = 1 << 22) -> DataFrame:
    """Where the tracks with more than ``limit`` different positions are cut: run_id, sample, contig, piece, at, n (its own markers are
    numbers at .. at + n - 1 of the track), cut (``gap_1`` for the widest class, ..., ``limit`` or ``end``) and bins (bin, before) of the track."""
    if not 0 <= overlap < limit:
        raise ValueError("overlap must be at least 0 and under the limit")

    def letter(gap: Column) -> Column:
        got = F.lit("z")
        for i, width in reversed(list(enumerate(sorted(gaps, reverse=True)))):
            got = F.when(gap >= width, chr(ord("a") + i)).otherwise(got)
        return got

    inner = F.zip_with(F.slice("offs", F.lit(1), F.size("offs") - 1), F.slice("offs", F.lit(2), F.size("offs")), lambda a, b: letter(b - a))
    at = lambda i: F.col("bin") * bin_width + F.element_at("offs", i)
    light = bins.select(*TRACK, "bin", F.size("offs").cast("long").alias("n"), at(1).alias("first"), at(-1).alias("last"), F.array_join(inner, "").alias("inner"))
    track = Window.partitionBy(*TRACK)
    line = track.orderBy("bin")
    held = light.withColumn("total", F.sum("n").over(track)).withColumn("before", F.coalesce(F.sum("n").over(line.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).withColumn("gap", F.col("first") - F.lag("last").over(line))
    own = F.concat(F.when(F.col("gap").isNull(), "").otherwise(letter(F.col("gap"))), "inner")
    whole = held.where(F.col("total") > limit).groupBy(*TRACK).agg(F.array_sort(F.collect_list(F.struct("bin", "before", own.alias("own")))).alias("b"))
    text = F.concat(F.array_join(F.transform("b", lambda x: x["own"]), ""), F.lit("z"))
    pieces = whole.select(*TRACK, F.transform("b", lambda x: F.struct(x["bin"].alias("bin"), x["before"].alias("before"))).alias("bins"), F.posexplode(F.regexp_extract_all(text, F.lit(cut_pattern(limit, limit - overlap, len(gaps))), F.lit(0))).alias("piece", "p"))
    by_piece = Window.partitionBy(*TRACK).orderBy("piece")
    pieces = pieces.withColumn("n", F.length("p")).withColumn("at", F.coalesce(F.sum("n").over(by_piece.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    kind = F.lit("limit")
    for i in range(len(gaps)):
        kind = F.when(F.right("p", F.lit(1)) == chr(ord("a") + i), f"gap_{i + 1}").otherwise(kind)
    kind = F.when(F.lead("piece").over(by_piece).isNull(), "end").otherwise(kind)
    return pieces.select(*TRACK, F.col("piece").cast("long").alias("piece"), "at", "n", kind.alias("cut"), "bins")


def split_tracks(obs: DataFrame, limit: int = 500, overlap: int = 20, gaps: Sequence[int] = (1_000_000, 100_000, 10_000), bin_width: int = 1 << 22) -> DataFrame:
    """Pieces of the tracks with more than ``limit`` different positions.

    Columns: run_id, sample, contig, piece, n_markers (overlap included), n_overlap, first_position, last_position, cut, positions.
    """
    bins = durable(marker_bins(obs, bin_width))
    cuts = cut_tracks(bins, limit, overlap, gaps, bin_width)
    back = F.least(F.lit(overlap), F.col("at")).cast("int")
    cuts = cuts.withColumn("back", back).withColumn("from", F.col("at") - F.col("back")).withColumn("to", F.col("at") + F.col("n"))
    # The bins a piece reaches: those that begin before its end, from the last one on that begins at or before its start.
    begun = F.filter("bins", lambda b: b["before"] < F.col("to"))
    reached = F.slice(begun, F.greatest(F.size(F.filter(begun, lambda b: b["before"] <= F.col("from"))), F.lit(1)), F.size(begun))
    asked = cuts.select(*TRACK, "piece", "cut", "back", "from", "to", F.explode(reached).alias("b")).select(*TRACK, "piece", "cut", "back", "from", "to", "b.bin", "b.before")
    met = asked.alias("a").join(bins.alias("b"), _same("a", "b", [*TRACK, "bin"])).select("a.*", "b.offs")
    low = F.greatest(F.col("from") - F.col("before"), F.lit(0))
    part = F.transform(F.slice("offs", (low + 1).cast("int"), (F.least(F.col("to") - F.col("before"), F.size("offs").cast("long")) - low).cast("int")), lambda o: F.col("bin") * bin_width + o)
    got = met.select(*TRACK, "piece", "cut", "back", F.struct("bin", part.alias("ps")).alias("x")).groupBy(*TRACK, "piece", "cut", "back").agg(F.array_sort(F.collect_list("x")).alias("xs"))
    out = got.withColumn("positions", F.flatten(F.transform("xs", lambda x: x["ps"])))
    return out.select(*TRACK, "piece", F.size("positions").alias("n_markers"), F.col("back").alias("n_overlap"), F.element_at("positions", 1).alias("first_position"), F.element_at("positions", -1).alias("last_position"), "cut", "positions")
