"""Genotype raster and summaries of lines and sites."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwork.functions.stats import chi_square_2
from seedwork.operators.intervals import PART, segment_index, state_at, state_in
from seedwork.session import durable, sized

#: Expected shares of 0, 1 and 2 donor copies after backcrossing twice and selfing twice or three times. Fixed values.
EXPECT = {"bc2s2": (27 / 32, 1 / 16, 3 / 32), "bc2s3": (55 / 64, 1 / 32, 7 / 64)}


def raster(alleles: DataFrame, segments: DataFrame, failed: DataFrame | None = None, lines: DataFrame | None = None, bound: int = 1 << 26) -> DataFrame:
    """Every line x bi-allelic site: ancestry x, genotype gt and expected dosage.

    ``alleles``: chrom, pos, allele (ALT, REF or null), p_alt. ``segments``: line, chrom, start, end, state. Lines come from segments,
    ``failed`` and ``lines``; a failed line is unknown everywhere. The product of lines and sites is the result itself. gt = x at ALT, 0 at REF,
    0 where x is 0, else unknown; dosage = 0 where x is 0, else x * p_alt. Segments of up to ``bound`` bytes (by their count) are looked up within the row, more by a
    shuffled lookup with the same result. Sites of null chromosome have no segments, so their x is unknown.
    """
    if failed is not None:
        segments = segments.join(sized(failed.select("line").distinct()), "line", "left_anti")
    # A line's segments on a chromosome are few: they travel as one array with the line, and cells are never shuffled. They are read for their size and for the cells.
    held = durable(segment_index(segments, ["line", "chrom"]).select("line", "chrom", F.struct("segs", "low", "width", "begun").alias("__segs")))
    names = held.select("line").distinct()
    for more in (failed, lines):
        names = names if more is None else names.union(more.select("line")).distinct()
    size = held.agg(F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum(F.size("__segs.segs")), F.lit(0)).alias("segs")).first()
    if size["rows"] * 1_200 + size["segs"] * 32 <= bound:
        chroms = alleles.select("chrom").distinct()
        grid = names.crossJoin(sized(chroms)).join(held, ["line", "chrom"], "left").withColumnRenamed("chrom", "__chrom")
        cells = alleles.join(sized(grid), F.col("chrom").eqNullSafe(F.col("__chrom"))).withColumn("x", state_in("__segs", F.col("pos"))).drop("__segs", "__chrom")
    else:
        cells = state_at(alleles.crossJoin(sized(names)), segments, ["line", "chrom"], "pos", "start", "end", "state", "x", bin_width=PART)
    x = F.col("x")
    gt = F.when(F.col("allele") == "ALT", x).when(F.col("allele") == "REF", F.when(x.isNotNull(), 0)).when(x == 0, 0)
    return cells.withColumn("gt", gt).withColumn("dosage", F.when(x == 0, F.lit(0.0)).otherwise(x * F.col("p_alt")))


def matrix(cells: DataFrame, site: Sequence[str], lines: Sequence, value: str = "gt", prefix: str = "line_") -> DataFrame:
    """One row per site, one column per line; ``lines`` names the columns, so the plan needs no extra pass."""
    got = cells.groupBy(*site).agg(*[F.max(F.when(F.col("line") == n, F.col(value))).alias(f"{prefix}{n}") for n in lines])
    return got


def line_summary(segments: DataFrame, failed: DataFrame, expect: Sequence[float] = EXPECT["bc2s2"], cells: DataFrame | None = None) -> DataFrame:
    """Length in each state per line, and a total (line null) that leaves out failed lines. With ``cells`` (of :func:`raster`) also the
    sites of each genotype, sites without one and their share; lines come from both."""
    size = F.col("end") - F.col("start") + 1
    names = [f"length_x{v}" for v in (0, 1, 2)]
    rows = segments.groupBy("line").agg(*[F.sum(F.when(F.col("state") == v, size).otherwise(0)).alias(f"length_x{v}") for v in (0, 1, 2)])
    if cells is not None:
        counts = [*[F.count_if(F.col("gt") == v).alias(f"sites_gt{v}") for v in (0, 1, 2)], F.count_if(F.col("gt").isNull()).alias("sites_na")]
        names += ["sites_gt0", "sites_gt1", "sites_gt2", "sites_na"]
        rows = rows.join(cells.groupBy("line").agg(*counts), "line", "full").fillna(0, names)
    rows = rows.join(sized(failed.select("line").distinct().withColumn("excluded", F.lit(True))), "line", "left").withColumn("excluded", F.coalesce("excluded", F.lit(False)))
    total = rows.where(~F.col("excluded")).agg(*[F.sum(c).alias(c) for c in names]).withColumn("line", F.lit(None).cast(rows.schema["line"].dataType)).withColumn("excluded", F.lit(False))
    both = rows.unionByName(total.select(*rows.columns))
    both = both.withColumn("called", F.col("length_x0") + F.col("length_x1") + F.col("length_x2"))
    for v in (0, 1, 2):
        both = both.withColumn(f"share_x{v}", F.col(f"length_x{v}") / F.when(F.col("called") > 0, F.col("called"))).withColumn(f"expect_x{v}", F.lit(float(expect[v])))
    if cells is not None:
        both = both.withColumn("sites", sum((F.col(c) for c in names[4:]), F.col("sites_gt0")))
        both = both.withColumn("no_call_share", F.col("sites_na") / F.when(F.col("sites") > 0, F.col("sites")))
    return both


def single_locus(cells: DataFrame, site: Sequence[str], expect: Sequence[float] = EXPECT["bc2s2"]) -> DataFrame:
    """Per site: lines in each ancestry state, donor frequency, genotype frequency and chi-square against the expectation."""
    got = cells.groupBy(*site).agg(*[F.count_if(F.col("x") == v).alias(f"n_x{v}") for v in (0, 1, 2)], F.sum("gt").alias("gt_sum"), F.count("gt").alias("gt_n"))
    n = F.col("n_x0") + F.col("n_x1") + F.col("n_x2")
    stat, p = chi_square_2([F.col("n_x0"), F.col("n_x1"), F.col("n_x2")], expect)
    some = F.when(n > 0, n)
    return got.select(*site, "n_x0", "n_x1", "n_x2", n.alias("n_lines"), ((F.col("n_x1") + 2 * F.col("n_x2")) / (2 * some)).alias("donor_freq"), (F.col("gt_sum") / (2 * F.when(F.col("gt_n") > 0, F.col("gt_n")))).alias("allele_freq_gt"), (F.col("n_x1") / some).alias("het_freq"), stat.alias("chi2"), p.alias("p_chi2"))


def painting(segments: DataFrame, failed: DataFrame | None = None) -> DataFrame:
    """Rectangles of a chromosome painting: one per segment, one grey bar over the whole frame for each failed line."""
    frame = segments.agg(F.struct(F.min("start").alias("a"), F.max("end").alias("b"))).scalar()
    rects = segments.select("line", "start", "end", F.col("state").cast("string").alias("fill"))
    if failed is None:
        return rects
    out = failed.select("line").distinct()
    grey = out.select("line", frame["a"].alias("start"), frame["b"].alias("end"), F.lit("excluded").alias("fill"))
    return rects.join(sized(out), "line", "left_anti").unionByName(grey)


def family_regression(df: DataFrame, by: Sequence[str], x: str, y: str) -> DataFrame:
    """Additive regression of y on x per group: slope and LOD = n / 2 * log10(RSS0 / RSS1)."""
    got = df.groupBy(*by).agg(F.expr(f"regr_count({y}, {x})").alias("n"), F.expr(f"regr_sxx({y}, {x})").alias("sxx"), F.expr(f"regr_sxy({y}, {x})").alias("sxy"), F.expr(f"regr_syy({y}, {x})").alias("syy"))
    rest = F.col("syy") - F.col("sxy") * F.col("sxy") / F.when(F.col("sxx") > 0, F.col("sxx"))
    return got.select(*by, "n", (F.col("sxy") / F.when(F.col("sxx") > 0, F.col("sxx"))).alias("slope"), (F.col("n") / 2 * F.log10(F.col("syy") / F.when(rest > 0, rest))).alias("lod"))


def genomic_control(tests: DataFrame, chi2: str = "chi2") -> DataFrame:
    """Inflation: the median of one-degree chi-squares over its expectation."""
    return tests.agg((F.median(chi2) / 0.4549364231195724).alias("inflation"))


def permutation_threshold(tests: DataFrame, permutation: str, score: str, share: float = 0.05) -> DataFrame:
    """The (1 - share) quantile of the largest score of each permutation."""
    tops = tests.groupBy(permutation).agg(F.max(score).alias("top"))
    return tops.agg(F.percentile("top", F.lit(1 - share)).alias("threshold"))


def store_rollup(files: DataFrame) -> DataFrame:
    """Files, bytes and whether all are complete, per library."""
    return files.groupBy("library").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.bool_and("complete").alias("complete"))


def qq_points(tests: DataFrame, p: str, by: Sequence[str] = ()) -> DataFrame:
    """Observed and expected -log10 of p-values for a QQ plot; the expectation of rank i of n is (i - a) / (n + 1 - 2a), a = 3/8 up to ten values, else 1/2.

    Equal p-values share one row with their ranks' mean, so a hot value is no hot task; nulls are left out.
    """
    from pyspark.sql import Window

    counted = tests.where(F.col(p).isNotNull()).groupBy(*by, p).agg(F.count(F.lit(1)).alias("k"))
    group = Window.partitionBy(*by)
    n = F.sum("k").over(group)
    rank = F.sum("k").over(group.orderBy(p).rowsBetween(Window.unboundedPreceding, 0)) - (F.col("k") - 1) / 2
    a = F.when(F.col("n") <= 10, 0.375).otherwise(0.5)
    held = counted.withColumn("n", n).withColumn("rank", rank)
    return held.select(*by, p, "k", (-F.log10(F.when(F.col(p) > 0, F.col(p)))).alias("observed"), (-F.log10((F.col("rank") - a) / (F.col("n") + 1 - 2 * a))).alias("expected"))


def cleanup_report(files: DataFrame) -> DataFrame:
    """Per library: checkpoint files, their bytes, and those that may go: complete ones that nothing still needs. Nothing is deleted.

    ``files``: library, path, bytes, complete, in_use.
    """
    goes = F.coalesce(F.col("complete") & ~F.col("in_use"), F.lit(False))
    got = files.groupBy("library").agg(F.count(F.lit(1)).alias("files"), F.sum("bytes").alias("bytes"), F.count_if(goes).alias("removable"), F.coalesce(F.sum(F.when(goes, F.col("bytes"))), F.lit(0)).alias("removable_bytes"))
    return got.withColumn("all_removable", F.when(F.col("removable") == F.col("files"), "yes").otherwise("no"))


def cleanup_commands(files: DataFrame) -> DataFrame:
    """One shell line a file that may go, for a person to read and run; quotes in paths are escaped."""
    goes = F.coalesce(F.col("complete") & ~F.col("in_use"), F.lit(False))
    return files.where(goes).select("library", F.concat(F.lit("rm -- '"), F.replace("path", F.lit("'"), F.lit("'\\''")), F.lit("'")).alias("command"))
