"""Marker union over donors, and the two steps that fill what a donor's own calls leave open.

Leave-one-out counts are totals over donors less the donor's own contribution: no join of donors with donors.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedwork.functions.stats import binomial_log, binomial_upper_tail, clip, log_sum_exp, logit, sigmoid, upper_median
from seedwork.operators.labels import enforce
from seedwork.session import sized

SITE = ("chrom", "pos", "ref", "alt")
_BASE = r"\A[ACGTN]\z"


def marker_union(scored: DataFrame, reference: Column) -> DataFrame:
    """One row per allele called tier A by any donor: sorted carriers, their kinds, whether its position has more such alleles, and the
    reference donors that call it ``ref``. ``reference`` says which donors are reference donors."""
    single = F.col("ref").rlike(_BASE) & F.col("alt").rlike(r"\A[ACGT]\z") & (F.col("ref") != F.col("alt"))
    called = scored.where(single & F.col("tier").isin("A", "ref"))
    is_a = F.col("tier") == "A"
    per = called.groupBy(*SITE).agg(
        F.array_sort(F.collect_set(F.when(is_a, F.struct(F.col("donor"), F.when(reference, "reference").otherwise("run").alias("kind"))))).alias("c"),
        F.array_sort(F.collect_set(F.when(~is_a & reference, F.col("donor")))).alias("ref_donors"),
    ).where(F.size("c") > 0)
    alts = F.size(F.collect_set("alt").over(Window.partitionBy("chrom", "pos")))
    out = per.withColumn("multiallelic", alts > 1)
    carriers = F.transform("c", lambda x: x["donor"])
    return out.select(*SITE, F.size("c").alias("n_donors"), carriers.alias("carriers"), F.transform("c", lambda x: x["kind"]).alias("kinds"), "multiallelic", F.array_except("ref_donors", carriers).alias("ref_donors"))


def union_per_donor(union: DataFrame) -> DataFrame:
    """Per carrier: alleles, shared and private ones, its multi-allelic ones, and the bi-allelic union alleles it lacks (total less own)."""
    whole = union.agg(F.count_if(~F.col("multiallelic")).alias("total")).scalar()
    rows = union.select(F.explode("carriers").alias("donor"), "n_donors", "multiallelic")
    got = rows.groupBy("donor").agg(F.count(F.lit(1)).alias("tier_a"), F.count_if(F.col("n_donors") > 1).alias("shared"), F.count_if(F.col("n_donors") == 1).alias("private"), F.count_if("multiallelic").alias("own_multiallelic"), F.count_if(~F.col("multiallelic")).alias("own"))
    return got.withColumn("gaps", whole - F.col("own")).drop("own")


@dataclass(frozen=True)
class GapOptions:
    """Step 1 and step 2.

    ``source`` of the prior: ``other_donors`` (their calls, weighed with the donor's own rate of sharing), ``mu_only`` (that rate) or
    ``fixed``. ``scope``: ``all`` donors or those of the ``same_taxon``.
    """

    posterior: float = 0.999
    weight: float = 2.0
    llr_ref: float = -4.0
    ref_depth: int = 12
    source: str = "other_donors"
    scope: str = "all"
    fixed: float = 0.5
    blocked: tuple[str, ...] = ("hidepth", "af_gt_half")
    alpha: float = 1.0
    beta: float = 200.0
    x0_p: float = 0.01
    x0_alt: int = 1
    ks_floor: float = 0.02

    def __post_init__(self) -> None:
        for name, value, known in (("source", self.source, ("other_donors", "mu_only", "fixed")), ("scope", self.scope, ("all", "same_taxon"))):
            if value not in known:
                raise ValueError(f"{name} is {value!r}, not one of {', '.join(known)}")
        for name in ("posterior", "fixed"):
            if not 0 < getattr(self, name) < 1:
                raise ValueError(f"{name} must be between 0 and 1, both excluded")
        if self.weight <= 0 or self.alpha <= 0 or self.beta <= self.alpha:
            raise ValueError("weight and alpha must be greater than 0, and beta greater than alpha")


def gap_rows(union: DataFrame, joint: DataFrame, donors: DataFrame) -> DataFrame:
    """Run donors x bi-allelic union alleles, with the joint scoring row where there is one, and whether the donor carries the allele.

    ``donors`` is the list of run donors (one small column), which multiplies every allele by design.
    """
    keys = union.where(~F.col("multiallelic")).select(*SITE, "carriers", "ref_donors")
    names = donors.select(F.collect_set("donor").alias("d"))
    pairs = keys.select("*", F.explode(names.scalar()).alias("donor"))
    rows = joint.select(*SITE, "donor", F.col("n").alias("j_n"), F.col("llr").alias("j_llr"), F.col("flags").alias("j_flags"), F.col("tier").alias("j_tier"), F.col("n0").alias("j_n0"), F.col("a0").alias("j_a0"))
    return pairs.join(rows, [*SITE, "donor"], "left").withColumn("own", F.array_contains("carriers", F.col("donor")))


def _ref_rule(o: GapOptions) -> Column:
    return F.coalesce((F.col("j_llr") <= o.llr_ref) & (F.col("j_n") >= o.ref_depth), F.lit(False))


def sharing_rates(rows: DataFrame, o: GapOptions = GapOptions()) -> DataFrame:
    """Per donor: A and REF calls among its gaps and mu = (A + 1/2) / (A + R + 1)."""
    gap = ~F.col("own")
    got = rows.groupBy("donor").agg(F.count_if(gap & (F.col("j_tier") == "A")).alias("gap_a"), F.count_if(gap & _ref_rule(o)).alias("gap_ref"))
    return got.withColumn("mu", (F.col("gap_a") + 0.5) / (F.col("gap_a") + F.col("gap_ref") + 1))


def leave_one_out(rows: DataFrame, o: GapOptions = GapOptions(), taxa: DataFrame | None = None) -> DataFrame:
    """Gaps with k (other donors that carry the allele), m (k and other donors that call REF) and the prior.

    A run donor calls REF by the rule on its joint row, a reference donor by the union's list. Own contributions are taken off the totals. With
    the scope ``same_taxon`` (``taxa``: donor, taxon) totals are by taxon; a donor without one has no prior donors, so its prior is its rate of sharing.
    """
    ref_call = (~F.col("own") & _ref_rule(o)).cast("int")
    if o.scope == "same_taxon":
        if taxa is None:
            raise ValueError("the scope same_taxon needs the taxa of the donors")
        kinds = taxa.select("donor", "taxon").where(F.col("taxon").isNotNull()).dropDuplicates(["donor"])
        named = F.explode(F.concat(F.transform("carriers", lambda d: F.struct(d.alias("d"), F.lit(1).alias("k"))), F.transform(F.array_except("ref_donors", "carriers"), lambda d: F.struct(d.alias("d"), F.lit(0).alias("k"))))).alias("c")
        told = rows.select(*SITE, "carriers", "ref_donors").distinct().select(*SITE, named).join(sized(kinds), F.col("c.d") == F.col("donor"))
        totals = told.groupBy(*SITE, "taxon").agg(F.sum("c.k").alias("__k"), F.count(F.lit(1)).alias("__m"))
        here = Window.partitionBy(*SITE, "taxon")
        held = rows.join(sized(kinds), "donor", "left").withColumn("__r", F.when(F.col("taxon").isNotNull(), F.sum(ref_call).over(here) - ref_call).otherwise(0))
        held = held.where(~F.col("own")).join(totals, [*SITE, "taxon"], "left").fillna(0, ["__k", "__m"])
        held = held.withColumn("k", F.col("__k").cast("long")).withColumn("m", (F.col("__m") + F.col("__r")).cast("long")).drop("__k", "__m", "__r")
    else:
        here = Window.partitionBy(*SITE)
        k = F.size("carriers") - F.col("own").cast("int")
        m = k + F.size(F.array_except("ref_donors", "carriers")) + F.sum(ref_call).over(here) - ref_call
        held = rows.withColumn("k", k.cast("long")).withColumn("m", m.cast("long")).where(~F.col("own"))
    held = held.join(sized(sharing_rates(rows, o).select("donor", "mu")), "donor")  # one row a donor
    if o.source == "fixed":
        pi: Column = F.lit(o.fixed)
    elif o.source == "mu_only":
        pi = clip(F.col("mu"), 1e-6, 1 - 1e-6)
    else:
        pi = clip((o.weight * F.col("mu") + F.col("k")) / (o.weight + F.col("m")), 1e-6, 1 - 1e-6)
    return held.withColumn("prior", pi)


def fill_step1(rows: DataFrame, o: GapOptions = GapOptions(), taxa: DataFrame | None = None) -> DataFrame:
    """State, reason and log-odds of every gap: absent, REF rule, blocked flag, posterior, below cut-off, in this order."""
    held = leave_one_out(rows, o, taxa)
    cut = math.log(o.posterior / (1 - o.posterior))
    odds = F.coalesce(F.col("j_llr"), F.lit(0.0)) + logit(F.col("prior"))
    blocked = F.coalesce(F.arrays_overlap("j_flags", F.array(*[F.lit(b) for b in o.blocked])), F.lit(False))
    reason = F.when(F.col("j_llr").isNull(), "absent").when(_ref_rule(o), "ref_rule").when(blocked, "blocked_flag").when(odds >= cut, "posterior").otherwise("below_cutoff")
    state = F.when(F.col("reason") == "ref_rule", "REF").when(F.col("reason") == "posterior", "ALT")
    return held.withColumn("log_odds", odds).withColumn("reason", reason).withColumn("state", state)


def step1_summary(union: DataFrame, rows: DataFrame, filled: DataFrame, o: GapOptions = GapOptions(), taxa: DataFrame | None = None) -> DataFrame:
    """One row a run donor: its taxon, sharing rate, prior donors and what became of its gaps, with how often the REF rule and the tier disagree.

    ``rows`` are those of :func:`gap_rows`, ``filled`` those of :func:`fill_step1`.
    """
    donors = rows.select("donor").distinct()
    taxon = taxa.select("donor", "taxon").dropDuplicates(["donor"]) if taxa is not None else donors.select("donor", F.lit(None).cast("string").alias("taxon"))
    runs = donors.select(F.col("donor").alias("other"), F.lit(0).alias("__kind"))
    named = union.select(F.explode(F.zip_with("carriers", "kinds", lambda d, k: F.struct(d.alias("d"), (k == "reference").alias("ref")))).alias("c")).where("c.ref").select(F.col("c.d").alias("other"))
    named = named.unionByName(union.select(F.explode("ref_donors").alias("other"))).distinct().join(runs, "other", "left_anti").withColumn("__kind", F.lit(1))
    others = runs.unionByName(named).join(taxon.select(F.col("donor").alias("other"), F.col("taxon").alias("__t")), "other", "left")
    # Donors with donors: two short lists of names.
    pairs = donors.join(taxon, "donor", "left").crossJoin(sized(others)).where(F.col("donor") != F.col("other"))
    inside = F.lit(True) if o.scope == "all" else F.coalesce(F.col("taxon") == F.col("__t"), F.lit(False))
    listed = lambda cond: F.transform(F.array_sort(F.collect_list(F.when(cond, F.struct("__kind", "other")))), lambda x: x["other"])
    prior = pairs.groupBy("donor").agg(listed(inside).alias("prior_donors"), listed(~inside).alias("prior_donors_other_taxon"))
    tally = rows.groupBy("donor").agg(F.count(F.lit(1)).alias("union_alleles"), F.count_if("own").alias("own"), F.count_if(~F.col("own")).alias("gaps"))
    reason = lambda r: F.count_if(F.col("reason") == r)
    odd = F.col("j_llr").isNotNull() & ((F.col("j_tier") == "ref") != F.coalesce(F.col("state") == "REF", F.lit(False)))
    calls = filled.groupBy("donor").agg(F.count_if(F.col("state") == "ALT").alias("alt"), F.count_if(F.col("state") == "REF").alias("ref"), F.count_if(F.col("state").isNull()).alias("na"), reason("absent").alias("na_absent"), reason("blocked_flag").alias("na_blocked_flag"), reason("below_cutoff").alias("na_below_cutoff"), F.count_if(odd).alias("ref_rule_vs_tier_disagree"))
    multi = union.agg(F.count_if("multiallelic")).scalar()
    out = donors.join(taxon, "donor", "left").join(sharing_rates(rows, o), "donor").join(prior, "donor", "left").join(tally, "donor").join(calls, "donor", "left")
    used = F.when((F.lit(o.source) == "other_donors") & (F.coalesce(F.size("prior_donors"), F.lit(0)) <= 0), "mu_only (no prior donors)").otherwise(o.source)
    zero = [c for c in calls.columns if c != "donor"]
    none = F.array().cast(prior.schema["prior_donors"].dataType)
    out = out.fillna(0, zero).withColumn("prior_donors", F.coalesce("prior_donors", none)).withColumn("prior_donors_other_taxon", F.coalesce("prior_donors_other_taxon", none))
    return out.select(
        "donor", "taxon", "mu", F.col("gap_a").alias("gap_tier_a"), "gap_ref", F.lit(o.source).alias("prior_source_requested"), used.alias("prior_source_used"), F.size("prior_donors").alias("n_prior_donors"),
        "prior_donors", "prior_donors_other_taxon", "union_alleles", multi.alias("multiallelic_skipped"), "own", "gaps", *zero,
    )


def line_depths(observed: DataFrame, candidates: DataFrame | None = None, by: Sequence[str] = ("key",)) -> DataFrame:
    """Per line: mean depth over its sites with no donor copy; null where there is none. ``observed``: by..., line, x, n (n 0 where uncovered).
    With ``candidates`` only their sites count."""
    if candidates is not None:
        observed = observed.join(candidates.select(*by).distinct(), list(by), "left_semi")
    return observed.groupBy("line").agg(F.avg(F.when(F.col("x") == 0, F.col("n"))).alias("lam"), F.count_if(F.col("x") == 0).alias("sites_x0"))


def fill_step2(candidates: DataFrame, observed: DataFrame, depths: DataFrame, grid: Sequence[tuple[float, float]], o: GapOptions = GapOptions(), by: Sequence[str] = ("key",)) -> DataFrame:
    """Step 2: candidates of step 1 (gaps it left open) decided by the donor's lines.

    ``candidates``: by..., prior, j_llr, j_n0, j_a0, blocked. ``observed``: by..., line, x (0, 1, 2; null = unknown), n, a. ``depths``: line, lam.
    ``grid``: (copy mappability, weight). Outcomes in order: blocked_flag, blocked_x0_lines, no_test, ALT, undecided; never REF.

    Lines enter only through sums per site and x: of n, a, lam, n * log(lam), and their number. So the table of observations is aggregated
    once, map side, and the grid is gone through on one row a site. The floor of means (1e-9) concerns x = 2 where no read can
    map (c = 0); elsewhere means stay above it, since lam is a mean depth over a line's sites and ks at least ``ks_floor``.
    """
    total = sum(w for _, w in grid)
    points = [(float(c), math.log(w / total)) for c, w in grid if w > 0]
    used = observed.join(sized(depths.where(F.col("lam") > 0).select("line", "lam")), "line").where(F.col("x").isNotNull())
    n, a, x, lam = F.col("n"), F.col("a"), F.col("x"), F.col("lam")
    sums, names = [], []
    for v in (0, 1, 2):
        here = x == v
        sums += [F.count_if(here).alias(f"c{v}"), *[F.sum(F.when(here, e).otherwise(z)).alias(f"{name}{v}") for name, e, z in (("n", n, 0), ("a", a, 0), ("l", lam, 0.0), ("t", n * F.log(lam), 0.0))]]
        names += [f"{name}{v}" for name in "cnalt"]
    site = candidates.join(used.groupBy(*by).agg(*sums), list(by), "left").fillna(0, names)
    col = F.col
    site = site.withColumns({"n_x0": col("n0"), "a_x0": col("a0"), "lam_x0": col("l0"), "lines_x0": col("c0"), "lines_donor": col("c1") + col("c2"), "n_donor": col("n1") + col("n2"), "a_donor": col("a1") + col("a2")})
    jn0, ja0 = F.coalesce("j_n0", F.lit(0)), F.coalesce("j_a0", F.lit(0))
    site = site.withColumn("eps0", (ja0 + o.alpha) / (jn0 + o.beta)).withColumn("eps_s", (ja0 + col("a_x0") + o.alpha) / (jn0 + col("n_x0") + o.beta))
    tail = F.when((col("a_x0") > 0) & (col("a_x0") >= o.x0_alt), binomial_upper_tail(col("a_x0"), col("n_x0"), col("eps0")))
    site = site.withColumn("p_x0", F.when(~col("blocked"), tail))
    site = site.withColumn("ks", F.when((col("lines_donor") > 0) & (col("lam_x0") > 0), F.greatest(col("n_x0") / col("lam_x0"), F.lit(o.ks_floor))))

    e, ks = col("eps_s"), col("ks")

    def values(g: Column) -> Column:
        depth, reads = g["lw"], F.lit(0.0)
        for v in (0, 1, 2):
            h = v / 2
            den = (1 - h) + h * g["c"]
            depth = depth + F.when(den > 0, col(f"n{v}") * F.log(ks * den) + col(f"t{v}") - ks * den * col(f"l{v}")).otherwise(col(f"n{v}") * math.log(1e-9) - col(f"c{v}") * 1e-9)
            rho = F.when(den > 1e-12, h * g["c"] / F.greatest(den, F.lit(1e-12))).otherwise(0.0)
            reads = reads + binomial_log(col(f"a{v}"), col(f"n{v}"), rho * (1 - e) + (1 - rho) * e)
        return F.struct(depth.alias("vd"), (depth + reads).alias("va"))

    tested = ~col("blocked") & ~F.coalesce(col("p_x0") < o.x0_p, F.lit(False)) & ks.isNotNull()
    grown = F.transform(F.array(*[F.struct(F.lit(c).alias("c"), F.lit(lw).alias("lw")) for c, lw in points]), values)
    none = sum((binomial_log(col(f"a{v}"), col(f"n{v}"), e) for v in (1, 2)), binomial_log(col("a0"), col("n0"), e))
    site = site.withColumn("__g", F.when(tested, grown)).withColumn("llr_lines", log_sum_exp(F.transform("__g", lambda z: z["va"])) - (log_sum_exp(F.transform("__g", lambda z: z["vd"])) + none))
    odds = F.coalesce(logit(col("prior")), F.lit(0.0)) + F.coalesce("j_llr", F.lit(0.0)) + col("llr_lines")
    x0 = F.coalesce(col("p_x0") < o.x0_p, F.lit(False))
    cut = math.log(o.posterior / (1 - o.posterior))
    call = F.when(col("blocked"), "blocked_flag").when(x0, "blocked_x0_lines").when(ks.isNull(), "no_test").when(odds >= cut, "ALT").otherwise("undecided")
    return site.withColumn("call", call).withColumn("log_odds", odds).drop("__g", *names)


def step2_summary(step2: DataFrame, lines: DataFrame, by: Sequence[str] = ("donor",)) -> DataFrame:
    """Per donor: candidates by outcome, lines by use, ALT reads at sites without donor copy, and the upper median of depths.

    ``lines``: by..., line, failed, has_segments, lam, one row a line of the count table.
    """
    call = lambda c: F.count_if(F.col("call") == c)
    rate = lambda c: (F.sum(F.when(F.col("call") == c, F.col("a_x0"))) / F.nullif(F.sum(F.when(F.col("call") == c, F.col("n_x0"))), F.lit(0)))
    calls = step2.groupBy(*by).agg(
        F.count(F.lit(1)).alias("candidates"), *[call(c).alias(c.lower()) for c in ("ALT", "undecided", "blocked_flag", "blocked_x0_lines", "no_test")],
        F.count_if((F.col("call") == "ALT") & (F.col("a_x0") > 0)).alias("alt_calls_with_x0_alt_reads"), rate("ALT").alias("x0_alt_rate_at_alt"), rate("undecided").alias("x0_alt_rate_at_undecided"),
    )
    usable = ~F.col("failed") & F.col("has_segments")
    told = lines.withColumn("__lam", F.when(usable & (F.col("lam") > 0), F.col("lam")))
    tally = told.groupBy(*by).agg(
        F.count(F.lit(1)).alias("lines_in_counts"), F.count("__lam").alias("lines_used"), F.count_if("failed").alias("lines_excluded_qc"), F.count_if(~F.col("failed") & ~F.col("has_segments")).alias("lines_without_segments"),
        F.count_if(usable & F.col("__lam").isNull()).alias("lines_without_x0_depth"), upper_median("__lam").alias("median_lambda"),
    )
    return tally.join(calls, list(by), "left").fillna(0, ["candidates", "alt", "undecided", "blocked_flag", "blocked_x0_lines", "no_test", "alt_calls_with_x0_alt_reads"])


STEPS = ("multiallelic", "own", "step1_ref", "step1_alt", "step2_alt", "missing")


def founder_calls(union: DataFrame, step1: DataFrame, step2: DataFrame, by: Sequence[str] = ("key",), strict: bool = True) -> DataFrame:
    """A donor's allele at every union site, first match: multi-allelic, own, REF and ALT of step 1, ALT of step 2, else missing.

    ``union``: by..., multiallelic. ``step1``: by..., own, state, log_odds. ``step2``: by..., call, log_odds. With ``strict`` a bi-allelic site without a row
    of step 1, and a row of step 2 at a site that step 1 has called, are refused: the tables come from different runs.
    """
    by = list(by)
    s1 = step1.select(*by, F.col("own").alias("own1"), F.col("state").alias("state1"), F.col("log_odds").alias("lo1"))
    s2 = step2.select(*by, F.col("call").alias("call2"), F.col("log_odds").alias("lo2"))
    held = union.join(s1, by, "left").join(s2, by, "left")
    if strict:
        bad = F.when(~F.col("multiallelic") & F.col("own1").isNull(), "no row of step 1").when(F.col("call2").isNotNull() & F.col("state1").isNotNull(), "step 2 at a site that step 1 has called")
        enforce(held.withColumn("problem", bad).where(F.col("problem").isNotNull()).select(*by, "problem"), "tables of different runs")
    step = (
        F.when(F.col("multiallelic"), "multiallelic").when(F.col("own1"), "own").when(F.col("state1") == "REF", "step1_ref")
        .when(F.col("state1") == "ALT", "step1_alt").when(F.col("call2") == "ALT", "step2_alt").otherwise("missing")
    )
    held = held.withColumn("call_step", step)
    lo = F.when(F.col("call_step").isin("step1_ref", "step1_alt"), F.col("lo1")).when(F.col("call_step").isin("step2_alt", "missing"), F.coalesce("lo2", "lo1"))
    allele = F.when(F.col("call_step").isin("own", "step1_alt", "step2_alt"), "ALT").when(F.col("call_step") == "step1_ref", "REF")
    return held.select(*by, allele.alias("allele"), "call_step", lo.alias("log_odds"), F.when(F.col("call_step") == "own", 1.0).otherwise(sigmoid(lo)).alias("p_alt"))


def founder_summary(calls: DataFrame, by: Sequence[str] = ("donor",)) -> DataFrame:
    """Per donor: union alleles, gaps, sites by step, and the shares of gaps that the steps decide."""
    got = calls.groupBy(*by).agg(F.count(F.lit(1)).alias("union_alleles"), *[F.count_if(F.col("call_step") == s).alias(s) for s in STEPS])
    got = got.withColumn("biallelic", F.col("union_alleles") - F.col("multiallelic")).withColumn("gaps", F.col("biallelic") - F.col("own"))
    over = lambda a, b: a / F.nullif(F.col(b), F.lit(0))
    return got.select(
        *by, "union_alleles", "biallelic", "gaps", *STEPS, over(F.col("step1_ref") + F.col("step1_alt"), "gaps").alias("step1_share_of_gaps"), over(F.col("step2_alt"), "gaps").alias("step2_share_of_gaps"),
        over(F.col("missing"), "gaps").alias("missing_share_of_gaps"), over(F.col("missing"), "biallelic").alias("missing_share_of_union"),
    )
