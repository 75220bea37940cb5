"""Pooled scoring: likelihood ratios per donor and site, error rate from the zero class, flags, tiers and the tables beside them.

Input is one long table of pools: site columns, donor, pool, n (depth) and a (reads of the allele). All windows share the site's
partitioning, so scoring costs one shuffle of pool rows and no join.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedwork.functions.stats import binomial_upper_tail, pooled_llr


@dataclass(frozen=True)
class TierOptions:
    """Thresholds of scoring. ``called``: a filter on donors to report; all donors may join the zero class."""

    eps0: float = 0.005
    prior: float = 0.5
    plants: int = 6
    zero_llr: float = -3.0
    zero_reads: int = 20
    eps_floor: float = 0.001
    llr_a: float = 6.9
    llr_b: float = 4.6
    llr_c: float = 2.2
    llr_ref: float = -4.0
    ref_depth: int = 12
    ref_pools: int = 1
    pools_a: int = 2
    single_alt: int = 0
    single_pools: int = 2
    hidepth: float = 2.0
    half_p: float = 0.01
    half_depth: int = 4
    inconsistent_alt: int = 3
    inconsistent_depth: int = 10
    keep_zero_depth: bool = False


def _half(n: Column, a: Column, o: TierOptions) -> Column:
    return (n >= o.half_depth) & (2 * a > n) & (F.when((n >= o.half_depth) & (2 * a > n), binomial_upper_tail(a, n, 0.5)) < o.half_p)


def zero_class(pools: DataFrame, site: Sequence[str], o: TierOptions = TierOptions()) -> DataFrame:
    """Adds to the pool rows: total (depth of the site), llr0 (of the donor), in_zero, n0, a0, eps and no_zero_class."""
    here = Window.partitionBy(*site)
    donor = Window.partitionBy(*site, "donor")
    rows = pools.withColumn("__l", pooled_llr("n", "a", o.eps0, o.plants)).withColumn("total", F.sum("n").over(here)).withColumn("llr0", F.sum("__l").over(donor)).drop("__l")
    rows = rows.withColumn("in_zero", F.col("llr0") < o.zero_llr)
    rows = rows.withColumn("n0", F.sum(F.when(F.col("in_zero"), F.col("n")).otherwise(0)).over(here)).withColumn("a0", F.sum(F.when(F.col("in_zero"), F.col("a")).otherwise(0)).over(here))
    few = F.col("n0") < o.zero_reads
    eps = F.when(few, F.lit(o.eps0)).otherwise(F.greatest((F.col("a0") + 0.5) / (F.col("n0") + 1), F.lit(o.eps_floor)))
    return rows.withColumn("eps", eps).withColumn("no_zero_class", few)


def median_depth(pools: DataFrame, site: Sequence[str]) -> DataFrame:
    """One row: the median (averaged) of the sites' total depths."""
    return pools.groupBy(*site).agg(F.sum("n").alias("total")).agg(F.median("total").alias("median_total"))


def score(pools: DataFrame, site: Sequence[str], called: Column, o: TierOptions = TierOptions()) -> DataFrame:
    """One row per called donor and site: counts, eps, LLR, log-odds, posterior, flags (array) and tier."""
    middle = median_depth(pools, site).scalar()
    rows = zero_class(pools, site, o).where(called)
    n, a = F.col("n"), F.col("a")
    rows = rows.withColumn("pool_llr", pooled_llr("n", "a", "eps", o.plants))
    wide = rows.groupBy(*site, "donor").agg(
        F.sum("n").alias("n"), F.sum("a").alias("a"), F.count(F.lit(1)).alias("n_pools"), F.count_if(a > 0).alias("n_pools_alt"), F.count_if(n > 0).alias("n_pools_reads"),
        F.first("eps").alias("eps"), F.first("n0").alias("n0"), F.first("a0").alias("a0"), F.first("in_zero").alias("self_in_zero"), F.first("no_zero_class").alias("no_zero_class"), F.first("total").alias("total"),
        F.sum("pool_llr").alias("llr"), F.bool_or(a >= o.inconsistent_alt).alias("some_alt"), F.bool_or((n >= o.inconsistent_depth) & (a == 0)).alias("some_none"),
        F.sort_array(F.collect_list(F.struct("pool", "a", "n"))).alias("pool_counts"),
    )
    if not o.keep_zero_depth:
        wide = wide.where(F.col("n") > 0)
    flags = F.array_compact(F.array(
        F.when(F.col("total") > o.hidepth * middle, "hidepth"),
        F.when(_half(F.col("n"), F.col("a"), o), "af_gt_half"),
        F.when(F.col("n_pools") == 1, "single_sample").when(F.col("some_alt") & F.col("some_none"), "inconsistent"),
        F.when(F.col("no_zero_class"), "no_zero_class"),
    ))
    log_odds = F.col("llr") + math.log(o.prior / (1 - o.prior))
    held = wide.withColumn("flags", flags).withColumn("log_odds", log_odds).withColumn("posterior", F.when(log_odds > -700, 1 / (1 + F.exp(-log_odds))).otherwise(0.0))
    hard = F.arrays_overlap("flags", F.array(F.lit("hidepth"), F.lit("af_gt_half")))
    odd = F.array_contains("flags", "inconsistent")
    enough = F.col("n_pools_alt") >= o.pools_a
    if o.single_alt > 0:
        enough = enough | ((F.col("n_pools") <= o.single_pools) & (F.col("n_pools_alt") >= 1) & (F.col("a") >= o.single_alt))
    tier = (
        F.when((F.col("llr") >= o.llr_a) & enough & ~hard & ~odd, "A")
        .when((F.col("llr") >= o.llr_b) & ~hard, "B")
        .when(F.col("llr") >= o.llr_c, "C")
        .when((F.col("llr") <= o.llr_ref) & (F.col("n") >= o.ref_depth) & (F.col("n_pools_reads") >= o.ref_pools), "ref")
        .otherwise("-")
    )
    return held.withColumn("tier", tier).drop("some_alt", "some_none", "no_zero_class")


def pool_qc(pools: DataFrame, o: TierOptions = TierOptions()) -> DataFrame:
    """Per pool: sites with reads, ALT and REF reads, ALT share, and sites significantly above one half."""
    return pools.groupBy("pool").agg(F.count_if(F.col("n") > 0).alias("sites"), F.sum("a").alias("alt_reads"), F.sum(F.col("n") - F.col("a")).alias("ref_reads"), F.count_if(_half(F.col("n"), F.col("a"), o)).alias("above_half")).withColumn("alt_share", F.col("alt_reads") / F.greatest(F.col("alt_reads") + F.col("ref_reads"), F.lit(1)))


def tier_summary(scored: DataFrame, by: Sequence[str] = ("donor",)) -> DataFrame:
    """Sites tested and sites in each tier."""
    return scored.groupBy(*by).agg(F.count(F.lit(1)).alias("tested"), *[F.count_if(F.col("tier") == t).alias(f"tier_{name}") for t, name in (("A", "a"), ("B", "b"), ("C", "c"), ("ref", "ref"), ("-", "none"))])


def membership(df: DataFrame, site: Sequence[str], lists: dict[str, DataFrame]) -> DataFrame:
    """Adds a 0/1 column ``in_<name>`` for each annotation list. All lists go into one table, so there is one join however many there are."""
    stacked = None
    for name, rows in lists.items():
        part = rows.select(*site).distinct().withColumn("__name", F.lit(name))
        stacked = part if stacked is None else stacked.unionByName(part)
    if stacked is None:
        return df
    keyed = stacked.groupBy(*site).agg(F.collect_set("__name").alias("__names"))
    joined = df.join(keyed, list(site), "left")
    return joined.select(*df.columns, *[F.coalesce(F.array_contains("__names", n), F.lit(False)).cast("int").alias(f"in_{n}") for n in lists])


def lookup_counts(sites: DataFrame, counts: DataFrame, at: Sequence[str] = ("chrom", "pos")) -> DataFrame:
    """Depths of each site's alleles from a long count table (at..., ref, alts array, sample, ad array in REF, ALT order).

    n = AD[REF] + AD[ALT], a = AD[ALT]; an absent site, another REF or an unseen allele give 0, and ``ref_mismatch`` tells the second.
    """
    held = counts.select(*at, F.col("ref").alias("__ref"), "alts", "sample", "ad")
    joined = sites.join(held, list(at), "left")
    same = F.col("ref") == F.col("__ref")
    place = F.array_position("alts", F.col("alt"))
    alt = F.when(same & (place > 0), F.coalesce(F.get("ad", place.cast("int")), F.lit(0))).otherwise(0)
    ref = F.when(same & (place > 0), F.coalesce(F.get("ad", F.lit(0)), F.lit(0))).otherwise(0)
    return joined.select(*sites.columns, "sample", (ref + alt).cast("long").alias("n"), alt.cast("long").alias("a"), F.coalesce(~same, F.lit(False)).alias("ref_mismatch"))


def witness_veto(pools: DataFrame, site: Sequence[str], witness: Column, least: int = 1) -> DataFrame:
    """Sites whose witness pools together hold at least ``least`` ALT reads, with those reads."""
    return _witnessed(pools, site, witness).where(F.col("witness_alt") >= least)


def _witnessed(pools: DataFrame, site: Sequence[str], witness: Column) -> DataFrame:
    return pools.groupBy(*site).agg(F.sum(F.when(witness, F.col("a")).otherwise(0)).alias("witness_alt"), F.sum("n").alias("n"))


def kept_calls(pools: DataFrame, site: Sequence[str], witness: Column, least: int = 1) -> DataFrame:
    """The pool rows of the sites that the witness confirms. One window over the site, whose partitioning scoring uses again."""
    here = F.sum(F.when(witness, F.col("a")).otherwise(0)).over(Window.partitionBy(*site))
    return pools.withColumn("__w", here).where(F.col("__w") >= least).drop("__w")


def merge_pools(pools: DataFrame, site: Sequence[str], which: Column) -> DataFrame:
    """Several pools put together as one, such as the witness of all controls: n, a and how many pools had rows, per site."""
    return pools.where(which).groupBy(*site).agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.count(F.lit(1)).alias("n_pools"))


def witness_summary(pools: DataFrame, site: Sequence[str], witness: Column, least: int = 1) -> DataFrame:
    """One row: records in, kept and dropped, and the share kept (null without records)."""
    got = _witnessed(pools, site, witness).agg(F.count(F.lit(1)).alias("records_in"), F.count_if(F.col("witness_alt") >= least).alias("kept"))
    return got.select(F.lit(least).alias("min_alt_reads"), "records_in", "kept", (F.col("records_in") - F.col("kept")).alias("dropped"), (F.col("kept") / F.nullif(F.col("records_in"), F.lit(0))).alias("kept_share"))


#: Flags that keep a row out of the ancestry markers. Fixed values.
MARKER_FLAGS = ("hidepth", "af_gt_half", "inconsistent")


def _marker_reason(tier: str, blocked: Sequence[str]) -> Column:
    """Why a row is no marker: ``tier``, ``not_snv`` or ``flagged``; null if nothing speaks against it."""
    base = r"\A[ACGT]\z"
    snv = F.upper("ref").rlike(base) & F.upper("alt").rlike(base) & (F.upper("ref") != F.upper("alt"))
    flagged = F.coalesce(F.arrays_overlap("flags", F.array(*[F.lit(b) for b in blocked]).cast("array<string>")), F.lit(False))
    return F.when(~F.coalesce(F.col("tier") == tier, F.lit(False)), "tier").when(~F.coalesce(snv, F.lit(False)), "not_snv").when(flagged, "flagged")


def select_markers(scored: DataFrame, tier: str = "A", blocked: Sequence[str] = MARKER_FLAGS) -> DataFrame:
    """Ancestry markers: one tier, single ACGT bases, no blocked flag, then positions with one (ref, alt) only; repeats collapse."""
    kept = scored.where(_marker_reason(tier, blocked).isNull())
    return kept.groupBy("chrom", "pos").agg(F.collect_set(F.struct(F.upper("ref").alias("ref"), F.upper("alt").alias("alt"))).alias("pairs")).where(F.size("pairs") == 1).select("chrom", "pos", F.col("pairs")[0]["ref"].alias("ref"), F.col("pairs")[0]["alt"].alias("alt"))


def marker_counters(scored: DataFrame, tier: str = "A", blocked: Sequence[str] = MARKER_FLAGS) -> DataFrame:
    """One row: rows, rows of the tier, those dropped by reason, positions with several alleles, and markers."""
    why = scored.select("chrom", "pos", F.upper("ref").alias("ref"), F.upper("alt").alias("alt"), _marker_reason(tier, blocked).alias("why"))
    per = why.groupBy("chrom", "pos").agg(F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col("why") == w).alias(w) for w in ("tier", "not_snv", "flagged")], F.size(F.collect_set(F.when(F.col("why").isNull(), F.struct("ref", "alt")))).alias("alleles"))
    total = lambda c: F.coalesce(F.sum(c), F.lit(0)).alias(c)
    got = per.agg(total("rows"), total("tier"), total("not_snv"), total("flagged"), F.count_if(F.col("alleles") > 1).alias("multiallelic_positions"), F.count_if(F.col("alleles") == 1).alias("markers"))
    return got.select("rows", (F.col("rows") - F.col("tier")).alias("tier_rows"), "not_snv", "flagged", "multiallelic_positions", "markers")
