"""Queries of pooled scoring, marker union and gap filling over the assay view, with their SQL twins."""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwork.functions.stats import pooled_llr, upper_median
from seedwork.operators import gaps, pooled
from seedwork.operators.intervals import state_at
from seedwork.plans.bindings import ASSAY_SQL, SEGMENTS_SQL, SITE_SQL, assay, segments, with_alleles
from seedwork.session import durable, table

_SITE = ("site",)


def _called():
    return F.col("donor") < 3


def _scored(spark: SparkSession, sf: str) -> DataFrame:
    return pooled.score(assay(spark, sf), _SITE, _called())


def _alleles(spark: SparkSession, sf: str) -> DataFrame:
    return with_alleles(_scored(spark, sf))


def _r(*names: str, to: int = 6) -> list:
    return [F.round(n, to).alias(n) for n in names]


def pooled_tiers(spark: SparkSession, sf: str) -> DataFrame:
    s = _scored(spark, sf)
    text = F.when(F.size("flags") == 0, ".").otherwise(F.array_join("flags", ","))
    return s.select("site", "donor", "n", "a", "n_pools", "n_pools_alt", "n0", "a0", *_r("eps", "llr", "log_odds", "posterior"), F.col("self_in_zero").cast("int").alias("self_in_zero"), text.alias("flags"), "tier")


def pooled_llr_query(spark: SparkSession, sf: str) -> DataFrame:
    return assay(spark, sf).groupBy("site", "donor").agg(F.round(F.sum(pooled_llr("n", "a", 0.005)), 6).alias("llr"))


def zero_class_eps(spark: SparkSession, sf: str) -> DataFrame:
    rows = pooled.zero_class(assay(spark, sf), _SITE)
    return rows.groupBy("site").agg(F.first("n0").alias("n0"), F.first("a0").alias("a0"), F.round(F.first("eps"), 9).alias("eps"), F.first("total").alias("total"))


def pool_qc(spark: SparkSession, sf: str) -> DataFrame:
    return pooled.pool_qc(assay(spark, sf)).select("pool", "sites", "alt_reads", "ref_reads", "above_half", *_r("alt_share"))


def tier_summary(spark: SparkSession, sf: str) -> DataFrame:
    return pooled.tier_summary(_scored(spark, sf))


def annotation_membership(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part").select(F.expr("p_partkey div 5").alias("site"), "p_size", "p_type")
    lists = {"large": part.where(F.col("p_size") >= 45), "economy": part.where(F.col("p_type") == "ECONOMY")}
    got = pooled.membership(_scored(spark, sf), _SITE, lists)
    return got.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.sum("in_large").alias("in_large"), F.sum("in_economy").alias("in_economy"))


def site_count_lookup(spark: SparkSession, sf: str) -> DataFrame:
    """Counts per (part, line) whose alleles are return flags, looked up for one wanted allele per part."""
    li = table(spark, sf, "lineitem")
    flags = li.groupBy(F.col("l_partkey").alias("pos"), F.col("l_linestatus").alias("ref"), "l_returnflag").agg(F.count(F.lit(1)).cast("int").alias("k"))
    wide = flags.groupBy("pos", "ref").agg(F.array_sort(F.collect_list(F.struct("l_returnflag", "k"))).alias("c"))
    counts = wide.select(F.lit("chr1").alias("chrom"), "pos", "ref", F.transform("c", lambda x: x["l_returnflag"]).alias("alts"), F.lit("s").alias("sample"), F.concat(F.array(F.lit(7)), F.transform("c", lambda x: x["k"])).alias("ad"))
    sites = table(spark, sf, "part").select(F.lit("chr1").alias("chrom"), F.col("p_partkey").alias("pos"), F.when(F.col("p_size") % 3 == 0, "O").otherwise("F").alias("ref"), F.when(F.col("p_size") % 2 == 0, "R").otherwise("Z").alias("alt"))
    got = pooled.lookup_counts(sites, counts)
    return got.groupBy("pos").agg(F.sum("n").alias("n"), F.sum("a").alias("a"), F.count_if("ref_mismatch").alias("ref_mismatch"))


def witness_veto(spark: SparkSession, sf: str) -> DataFrame:
    return pooled.witness_veto(assay(spark, sf), _SITE, F.col("pool") == 1).select("site", "witness_alt", "n")


def marker_selection(spark: SparkSession, sf: str) -> DataFrame:
    return pooled.select_markers(_alleles(spark, sf), blocked=("hidepth", "af_gt_half"))


def _union(spark: SparkSession, sf: str) -> DataFrame:
    return gaps.marker_union(_alleles(spark, sf), F.col("donor") == 2)


def marker_union(spark: SparkSession, sf: str) -> DataFrame:
    text = lambda c: F.when(F.size(c) == 0, ".").otherwise(F.array_join(F.transform(c, lambda x: x.cast("string")), ",")).alias(c)
    return _union(spark, sf).select(*gaps.SITE, F.col("n_donors").cast("long").alias("n_donors"), text("carriers"), text("kinds"), F.col("multiallelic").cast("int").alias("multiallelic"), text("ref_donors"))


def union_per_donor(spark: SparkSession, sf: str) -> DataFrame:
    return gaps.union_per_donor(_union(spark, sf))


def _stages(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Union and gap rows. Stages that several others read are written once, as results of stages are kept in a store."""
    scored = durable(_alleles(spark, sf))
    union = durable(gaps.marker_union(scored, F.col("donor") == 2))
    donors = spark.range(2).select(F.col("id").alias("donor"))
    return union, durable(gaps.gap_rows(union, scored, donors))


def _gap_rows(spark: SparkSession, sf: str) -> DataFrame:
    return _stages(spark, sf)[1]


def sharing_rate(spark: SparkSession, sf: str) -> DataFrame:
    return gaps.sharing_rates(_gap_rows(spark, sf)).select("donor", "gap_a", "gap_ref", *_r("mu"))


def leave_one_out_prior(spark: SparkSession, sf: str) -> DataFrame:
    return gaps.leave_one_out(_gap_rows(spark, sf)).select(*gaps.SITE, "donor", "k", "m", *_r("prior"))


def gap_fill_step1(spark: SparkSession, sf: str) -> DataFrame:
    return gaps.fill_step1(_gap_rows(spark, sf)).select(*gaps.SITE, "donor", "state", "reason", *_r("log_odds"))


def _taxa(spark: SparkSession) -> DataFrame:
    return spark.range(3).select(F.col("id").alias("donor"), F.when(F.col("id") == 1, "p").otherwise("x").alias("taxon"))


_SAME = gaps.GapOptions(scope="same_taxon")


def gap_fill_same_taxon(spark: SparkSession, sf: str) -> DataFrame:
    """Step 1 where only donors of one taxon inform each other."""
    got = gaps.fill_step1(_gap_rows(spark, sf), _SAME, _taxa(spark))
    return got.select(*gaps.SITE, "donor", "k", "m", "state", "reason", *_r("prior", "log_odds"))


def gap_step1_summary(spark: SparkSession, sf: str) -> DataFrame:
    union, rows = _stages(spark, sf)
    got = gaps.step1_summary(union, rows, gaps.fill_step1(rows, _SAME, _taxa(spark)), _SAME, _taxa(spark))
    text = lambda c: F.array_join(F.transform(c, lambda x: x.cast("string")), ",").alias(c)
    counts = ("gap_tier_a", "gap_ref", "multiallelic_skipped", "union_alleles", "own", "gaps", "alt", "ref", "na", "na_absent", "na_blocked_flag", "na_below_cutoff", "ref_rule_vs_tier_disagree")
    return got.select("donor", "taxon", *_r("mu"), "prior_source_requested", "prior_source_used", "n_prior_donors", text("prior_donors"), text("prior_donors_other_taxon"), *counts)


_GRID = tuple((c / 4, w) for c, w in ((0, 1.0), (1, 2.0), (2, 3.0), (3, 4.0), (4, 5.0), (5, 2.0)))
_BY = ("donor", "key")


def _site_number():
    return F.col("pos") * 2 + F.when(F.col("alt") == "G", 1).otherwise(0)


def _candidates(filled: DataFrame) -> DataFrame:
    """Gaps that step 1 left open."""
    return filled.where(F.col("state").isNull()).select("donor", _site_number().alias("key"), "prior", "j_llr", "j_n0", "j_a0", (F.col("reason") == "blocked_flag").alias("blocked"))


def _observed(spark: SparkSession, sf: str) -> DataFrame:
    """Forty lines, twenty of each run donor, at every assay site: ancestry by position, counts from lineitem by order number."""
    li = table(spark, sf, "lineitem").select(F.expr("l_partkey div 5").alias("key"), (F.col("l_orderkey") % 40).alias("line"), "l_discount", "l_orderkey")
    hit = ((F.col("key") % 3 == 0) & (F.col("l_discount") >= 0.065)) | (F.col("l_orderkey") % 211 == 0)
    counts = li.groupBy("key", "line").agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("a"))
    placed = counts.withColumn("position", (F.col("key") * 7) % 2400)
    found = state_at(placed, segments(spark, sf), ["line"], "position", "start", "end", "state", "x")
    return found.select((F.col("line") % 2).alias("donor"), "key", "line", "x", "n", "a")


def line_depth_scale(spark: SparkSession, sf: str) -> DataFrame:
    return gaps.line_depths(_observed(spark, sf)).select("line", "sites_x0", *_r("lam"))


def _step2(spark: SparkSession, sf: str, filled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Step 2 of both run donors, and the depths of their lines. Observations are read for depths and for sites, so they are written once."""
    obs = durable(_observed(spark, sf))
    depths = durable(gaps.line_depths(obs))
    return gaps.fill_step2(_candidates(filled), obs, depths, _GRID, by=_BY), depths


def gap_fill_step2(spark: SparkSession, sf: str) -> DataFrame:
    got = _step2(spark, sf, gaps.fill_step1(_gap_rows(spark, sf)))[0]
    return got.select("donor", "key", "n_x0", "a_x0", "lines_x0", "lines_donor", "n_donor", "a_donor", *_r("eps_s", "p_x0", "ks", "llr_lines", "log_odds", to=5), "call")


def gap_step2_summary(spark: SparkSession, sf: str) -> DataFrame:
    got, depths = _step2(spark, sf, gaps.fill_step1(_gap_rows(spark, sf)))
    lines = depths.select((F.col("line") % 2).alias("donor"), "line", (F.col("line") % 7 == 3).alias("failed"), (F.col("line") % 11 != 5).alias("has_segments"), "lam")
    told = gaps.step2_summary(got, lines)
    return told.select("donor", *[c for c in told.columns if not c.startswith(("x0_", "median")) and c != "donor"], *_r("x0_alt_rate_at_alt", "x0_alt_rate_at_undecided", "median_lambda"))


def _founder(spark: SparkSession, sf: str) -> DataFrame:
    union, rows = _stages(spark, sf)
    filled = durable(gaps.fill_step1(rows))
    donors = spark.range(2).select(F.col("id").alias("donor"))
    sites = union.crossJoin(F.broadcast(donors)).select("donor", _site_number().alias("key"), "multiallelic", F.array_contains("carriers", F.col("donor")).alias("own"))  # two donors
    gap = filled.select("donor", _site_number().alias("key"), "state", "log_odds")
    step1 = sites.where(~F.col("multiallelic")).join(gap, list(_BY), "left").select(*_BY, "own", "state", "log_odds")
    # Read for the guard and for the calls, so written once.
    step2 = durable(_step2(spark, sf, filled)[0].select(*_BY, "call", "log_odds"))
    return gaps.founder_calls(sites.drop("own"), step1, step2, _BY)


def founder_calls(spark: SparkSession, sf: str) -> DataFrame:
    return _founder(spark, sf).select("donor", "key", "allele", "call_step", *_r("log_odds", "p_alt", to=5))


def founder_summary(spark: SparkSession, sf: str) -> DataFrame:
    got = gaps.founder_summary(_founder(spark, sf))
    shares = ("step1_share_of_gaps", "step2_share_of_gaps", "missing_share_of_gaps", "missing_share_of_union")
    return got.select("donor", "union_alleles", "biallelic", "gaps", *gaps.STEPS, *_r(*shares))


def upper_median_query(spark: SparkSession, sf: str) -> DataFrame:
    return assay(spark, sf).groupBy("donor").agg(upper_median("n").cast("long").alias("upper_median"), F.median("n").alias("averaged_median"))


def rarefaction(spark: SparkSession, sf: str) -> DataFrame:
    """Share of alleles found, per number of donors taken in order; prefixes of flags per site, then means."""
    from pyspark.sql import Window

    s = _scored(spark, sf)
    w = Window.partitionBy("site").orderBy("donor").rowsBetween(Window.unboundedPreceding, 0)
    run = s.withColumn("found", F.max((F.col("tier") == "A").cast("int")).over(w)).withColumn("own", (F.col("tier") == "A").cast("int"))
    return run.groupBy("donor").agg(F.count(F.lit(1)).alias("sites"), F.round(F.avg("found"), 9).alias("found_share"), F.round(F.avg("own"), 9).alias("own_share"))


QUERIES = {
    "pooled_tiers": pooled_tiers, "pooled_llr": pooled_llr_query, "zero_class_eps": zero_class_eps, "pool_qc": pool_qc, "tier_summary": tier_summary,
    "annotation_membership": annotation_membership, "site_count_lookup": site_count_lookup, "witness_veto": witness_veto, "marker_selection": marker_selection,
    "marker_union": marker_union, "union_per_donor": union_per_donor, "sharing_rate": sharing_rate, "leave_one_out_prior": leave_one_out_prior, "gap_fill_step1": gap_fill_step1,
    "gap_fill_same_taxon": gap_fill_same_taxon, "gap_step1_summary": gap_step1_summary, "gap_step2_summary": gap_step2_summary, "founder_summary": founder_summary,
    "line_depth_scale": line_depth_scale, "gap_fill_step2": gap_fill_step2, "founder_calls": founder_calls, "upper_median": upper_median_query, "rarefaction": rarefaction,
}


# --- SQL twins -----------------------------------------------------------------------------------------------------


def _llr_sql(n: str, a: str, e: str, plants: int = 6) -> str:
    terms = []
    for j in range(plants + 1):
        weight = math.lgamma(plants + 1) - math.lgamma(j + 1) - math.lgamma(plants - j + 1) + plants * math.log(0.5)
        p = f"({j / (2 * plants)!r} * (1 - {e}) + (1 - {j / (2 * plants)!r}) * {e})"
        terms.append(f"{weight!r} + {a} * ln({p}) + ({n} - {a}) * ln(1 - {p})")
    v = f"[{', '.join(terms)}]"
    return f"(CASE WHEN {n} = 0 THEN 0.0 ELSE list_max({v}) + ln(list_sum(list_transform({v}, lambda t: exp(t - list_max({v}))))) - ({a} * ln({e}) + ({n} - {a}) * ln(1 - {e})) END)"


def _tail_sql(a: str, n: str, p: str) -> str:
    q = f"least(greatest({p}, 1e-12), 1 - 1e-12)"
    return f"(CASE WHEN {a} <= 0 THEN 1.0 WHEN {a} > {n} THEN 0.0 ELSE least(1.0, list_sum(list_transform(range(CAST({a} AS BIGINT), CAST({n} AS BIGINT) + 1), lambda k: exp(lgamma({n} + 1) - lgamma(k + 1) - lgamma({n} - k + 1) + k * ln({q}) + ({n} - k) * ln(1 - {q}))))) END)"


_HALF = f"(n >= 4 AND 2 * a > n AND {_tail_sql('a', 'n', '0.5')} < 0.01)"

_ZERO = f"""WITH {ASSAY_SQL},
l0 AS (SELECT *, sum(l) OVER (PARTITION BY site, donor) AS llr0, sum(n) OVER (PARTITION BY site) AS total FROM (SELECT *, {_llr_sql('n', 'a', '0.005')} AS l FROM assay)),
z AS (SELECT *, llr0 < -3 AS in_zero FROM l0),
zz AS (SELECT *, sum(CASE WHEN in_zero THEN n ELSE 0 END) OVER (PARTITION BY site) AS n0, sum(CASE WHEN in_zero THEN a ELSE 0 END) OVER (PARTITION BY site) AS a0 FROM z),
zc AS (SELECT *, CASE WHEN n0 < 20 THEN 0.005 ELSE greatest((a0 + 0.5) / (n0 + 1), 0.001) END AS eps FROM zz)"""

_SCORED = (
    _ZERO
    + f""",
med AS (SELECT median(t) AS m FROM (SELECT sum(n) AS t FROM assay GROUP BY site)),
pl AS (SELECT *, {_llr_sql('n', 'a', 'eps')} AS pllr FROM zc WHERE donor < 3),
dn AS (SELECT site, donor, sum(n) AS n, sum(a) AS a, count(*) AS n_pools, count_if(a > 0) AS n_pools_alt, count_if(n > 0) AS nwith, min(eps) AS eps, min(n0) AS n0, min(a0) AS a0, bool_or(in_zero) AS in_zero,
  min(total) AS total, sum(pllr) AS llr, bool_or(a >= 3) AS some_alt, bool_or(n >= 10 AND a = 0) AS some_none FROM pl GROUP BY site, donor HAVING sum(n) > 0),
fl AS (SELECT *, total > 2 * (SELECT m FROM med) AS hide, {_HALF} AS half, n_pools > 1 AND some_alt AND some_none AS odd FROM dn),
scored AS (SELECT *, llr AS log_odds, concat_ws(',', CASE WHEN hide THEN 'hidepth' END, CASE WHEN half THEN 'af_gt_half' END, CASE WHEN n_pools = 1 THEN 'single_sample' WHEN odd THEN 'inconsistent' END, CASE WHEN n0 < 20 THEN 'no_zero_class' END) AS fs,
  CASE WHEN llr >= 6.9 AND n_pools_alt >= 2 AND NOT hide AND NOT half AND NOT odd THEN 'A' WHEN llr >= 4.6 AND NOT hide AND NOT half THEN 'B' WHEN llr >= 2.2 THEN 'C' WHEN llr <= -4 AND n >= 12 AND nwith >= 1 THEN 'ref' ELSE '-' END AS tier FROM fl)"""
)

_UNION = (
    _SCORED
    + f""",
al AS (SELECT *, {SITE_SQL} FROM scored),
u0 AS (SELECT chrom, pos, ref, alt, list_sort(list(donor) FILTER (tier = 'A')) AS carriers, coalesce(list_sort(list(donor) FILTER (tier = 'ref' AND donor = 2)), []) AS ref_donors FROM al GROUP BY ALL HAVING count_if(tier = 'A') > 0),
un AS (SELECT *, count(*) OVER (PARTITION BY chrom, pos) > 1 AS multi FROM u0)"""
)

_STEP1 = (
    _UNION
    + """,
gr AS (SELECT u.*, d.donor, list_contains(u.carriers, d.donor) AS own, j.n AS jn, j.llr AS jllr, j.fs AS jfs, j.tier AS jtier, j.n0 AS jn0, j.a0 AS ja0,
  coalesce(j.llr <= -4 AND j.n >= 12, false) AS isref FROM un u CROSS JOIN (VALUES (0), (1)) d(donor) LEFT JOIN al j ON u.chrom = j.chrom AND u.pos = j.pos AND u.ref = j.ref AND u.alt = j.alt AND j.donor = d.donor WHERE NOT u.multi),
sr AS (SELECT donor, count_if(NOT own AND coalesce(jtier = 'A', false)) AS gap_a, count_if(NOT own AND isref) AS gap_ref FROM gr GROUP BY donor),
mu AS (SELECT *, (gap_a + 0.5) / (gap_a + gap_ref + 1) AS mu FROM sr),
km AS (SELECT gr.*, len(carriers) - CAST(own AS INT) AS k, len(carriers) - CAST(own AS INT) + len(ref_donors) + sum(CAST(NOT own AND isref AS INT)) OVER (PARTITION BY chrom, pos, ref, alt) - CAST(NOT own AND isref AS INT) AS m FROM gr),
pr AS (SELECT km.*, least(greatest((2.0 * mu.mu + k) / (2.0 + m), 1e-6), 1 - 1e-6) AS prior FROM km JOIN mu USING (donor) WHERE NOT own),
lo AS (SELECT *, coalesce(jllr, 0) + ln(prior / (1 - prior)) AS log_odds FROM pr),
s1 AS (SELECT *, CASE WHEN jllr IS NULL THEN 'absent' WHEN isref THEN 'ref_rule' WHEN regexp_matches(jfs, 'hidepth|af_gt_half') THEN 'blocked_flag' WHEN log_odds >= ln(0.999 / 0.001) THEN 'posterior' ELSE 'below_cutoff' END AS reason FROM lo),
st AS (SELECT *, CASE reason WHEN 'ref_rule' THEN 'REF' WHEN 'posterior' THEN 'ALT' END AS state, pos * 2 + CASE WHEN alt = 'G' THEN 1 ELSE 0 END AS key FROM s1)"""
)

_OBS = f""", {SEGMENTS_SQL},
oc AS (SELECT l_partkey // 5 AS key, l_orderkey % 40 AS line, count(*) AS n, count_if(((l_partkey // 5) % 3 = 0 AND l_discount >= 0.065) OR l_orderkey % 211 = 0) AS a FROM lineitem GROUP BY ALL),
obs AS (SELECT key, o.line AS line, o.line % 2 AS donor, n, a, CASE WHEN "end" >= position THEN state END AS x FROM (SELECT *, (key * 7) % 2400 AS position FROM oc) o ASOF LEFT JOIN segments s ON o.line = s.line AND o.position >= s.start),
lam AS (SELECT line, avg(n) FILTER (x = 0) AS lam, count_if(x = 0) AS sites_x0 FROM obs GROUP BY line)"""

_STEP2 = (
    _STEP1
    + _OBS
    + f""",
us AS (SELECT obs.*, lam FROM obs JOIN lam USING (line) WHERE lam > 0 AND x IS NOT NULL),
ow AS (SELECT donor, key, sum(CASE WHEN x = 0 THEN n ELSE 0 END) AS n_x0, sum(CASE WHEN x = 0 THEN a ELSE 0 END) AS a_x0, sum(CASE WHEN x = 0 THEN lam ELSE 0 END) AS lam_x0, count_if(x = 0) AS lines_x0, count_if(x > 0) AS lines_donor, sum(CASE WHEN x > 0 THEN n ELSE 0 END) AS n_donor, sum(CASE WHEN x > 0 THEN a ELSE 0 END) AS a_donor FROM us GROUP BY donor, key),
cd AS (SELECT c.donor, c.key, c.prior, c.jllr, coalesce(c.jn0, 0) AS n0, coalesce(c.ja0, 0) AS a0, c.reason = 'blocked_flag' AS blocked, coalesce(n_x0, 0) AS n_x0, coalesce(a_x0, 0) AS a_x0, coalesce(lam_x0, 0) AS lam_x0, coalesce(lines_x0, 0) AS lines_x0, coalesce(lines_donor, 0) AS lines_donor, coalesce(n_donor, 0) AS n_donor, coalesce(a_donor, 0) AS a_donor FROM (SELECT * FROM st WHERE state IS NULL) c LEFT JOIN ow ON c.key = ow.key AND c.donor = ow.donor),
ce AS (SELECT *, (a0 + 1.0) / (n0 + 200.0) AS eps0, (a0 + a_x0 + 1.0) / (n0 + n_x0 + 200.0) AS eps_s FROM cd),
cp AS (SELECT *, CASE WHEN NOT blocked AND a_x0 > 0 THEN {_tail_sql('a_x0', 'n_x0', 'eps0')} END AS p_x0, CASE WHEN lines_donor > 0 AND lam_x0 > 0 THEN greatest(n_x0 / lam_x0, 0.02) END AS ks FROM ce),
grd AS (SELECT * FROM (VALUES {', '.join(f'({c!r}, {math.log(w / sum(x for _, x in _GRID))!r})' for c, w in _GRID)}) g(c, lw)),
tm AS (SELECT us.donor, us.key, grd.c, grd.lw, us.n, us.a, us.x / 2.0 AS h, cp.eps_s AS e, cp.ks * us.lam AS kl, (1 - us.x / 2.0) + us.x / 2.0 * grd.c AS den FROM us JOIN cp ON us.key = cp.key AND us.donor = cp.donor CROSS JOIN grd WHERE cp.ks IS NOT NULL AND NOT cp.blocked),
tr AS (SELECT *, CASE WHEN den > 1e-12 THEN h * c / greatest(den, 1e-12) ELSE 0 END AS rho, greatest(kl * den, 1e-9) AS mm FROM tm),
tp AS (SELECT *, least(greatest(rho * (1 - e) + (1 - rho) * e, 1e-9), 1 - 1e-9) AS pa, least(greatest(e, 1e-9), 1 - 1e-9) AS pe FROM tr),
gs AS (SELECT donor, key, c, lw + sum(n * ln(mm) - mm) AS vd, lw + sum(n * ln(mm) - mm) + sum(a * ln(pa) + (n - a) * ln(1 - pa)) AS va, sum(a * ln(pe) + (n - a) * ln(1 - pe)) AS r FROM tp GROUP BY donor, key, c, lw),
gm AS (SELECT *, max(vd) OVER (PARTITION BY donor, key) AS md, max(va) OVER (PARTITION BY donor, key) AS ma FROM gs),
ll AS (SELECT donor, key, (max(ma) + ln(sum(exp(va - ma)))) - (max(md) + ln(sum(exp(vd - md))) + min(r)) AS llr_lines FROM gm GROUP BY donor, key),
s2 AS (SELECT cp.*, CASE WHEN NOT blocked AND NOT coalesce(p_x0 < 0.01, false) THEN ll.llr_lines END AS llr_lines FROM cp LEFT JOIN ll ON cp.key = ll.key AND cp.donor = ll.donor),
s2c AS (SELECT *, ln(prior / (1 - prior)) + coalesce(jllr, 0) + llr_lines AS log_odds2 FROM s2),
st2 AS (SELECT *, CASE WHEN blocked THEN 'blocked_flag' WHEN coalesce(p_x0 < 0.01, false) THEN 'blocked_x0_lines' WHEN ks IS NULL THEN 'no_test' WHEN log_odds2 >= ln(0.999 / 0.001) THEN 'ALT' ELSE 'undecided' END AS call FROM s2c)"""
)

_FOUNDER = (
    _STEP2
    + """,
fu AS (SELECT d.donor, pos * 2 + CASE WHEN alt = 'G' THEN 1 ELSE 0 END AS key, multi, list_contains(carriers, d.donor) AS own FROM un CROSS JOIN (VALUES (0), (1)) d(donor)),
fc AS (SELECT fu.donor, fu.key, fu.multi AS multi, fu.own AS own, st.state, st.log_odds AS lo1, st2.call, st2.log_odds2 AS lo2 FROM fu LEFT JOIN st ON fu.key = st.key AND fu.donor = st.donor LEFT JOIN st2 ON fu.key = st2.key AND fu.donor = st2.donor),
fs AS (SELECT *, CASE WHEN multi THEN 'multiallelic' WHEN own THEN 'own' WHEN state = 'REF' THEN 'step1_ref' WHEN state = 'ALT' THEN 'step1_alt' WHEN call = 'ALT' THEN 'step2_alt' ELSE 'missing' END AS call_step FROM fc),
ff AS (SELECT *, CASE WHEN call_step IN ('step1_ref', 'step1_alt') THEN lo1 WHEN call_step IN ('step2_alt', 'missing') THEN coalesce(lo2, lo1) END AS lo FROM fs)"""
)

_TAXON = """,
tx AS (SELECT * FROM (VALUES (0, 'x'), (1, 'p'), (2, 'x')) tx(e, taxon)),
kt AS (SELECT u.chrom, u.pos, u.ref, u.alt, t.taxon, count_if(list_contains(u.carriers, t.e)) AS k, count_if(list_contains(u.carriers, t.e) OR list_contains(u.ref_donors, t.e)) AS kr FROM un u CROSS JOIN tx t WHERE NOT u.multi GROUP BY ALL),
gt AS (SELECT gr.*, tx.taxon, sum(CAST(NOT own AND isref AS INT)) OVER (PARTITION BY gr.chrom, gr.pos, gr.ref, gr.alt, tx.taxon) - CAST(NOT own AND isref AS INT) AS r FROM gr JOIN tx ON tx.e = gr.donor),
pt AS (SELECT gt.*, kt.k, kt.kr + gt.r AS m, mu.mu, least(greatest((2.0 * mu.mu + kt.k) / (2.0 + kt.kr + gt.r), 1e-6), 1 - 1e-6) AS prior FROM gt JOIN kt ON gt.chrom = kt.chrom AND gt.pos = kt.pos AND gt.ref = kt.ref AND gt.alt = kt.alt AND gt.taxon = kt.taxon JOIN mu ON gt.donor = mu.donor WHERE NOT own),
lt AS (SELECT *, coalesce(jllr, 0) + ln(prior / (1 - prior)) AS log_odds FROM pt),
rt AS (SELECT *, CASE WHEN jllr IS NULL THEN 'absent' WHEN isref THEN 'ref_rule' WHEN regexp_matches(jfs, 'hidepth|af_gt_half') THEN 'blocked_flag' WHEN log_odds >= ln(0.999 / 0.001) THEN 'posterior' ELSE 'below_cutoff' END AS reason FROM lt),
zt AS (SELECT *, CASE reason WHEN 'ref_rule' THEN 'REF' WHEN 'posterior' THEN 'ALT' END AS state FROM rt)"""

_TEXT = "CASE WHEN len({c}) = 0 THEN '.' ELSE array_to_string(list_transform({c}, lambda x: CAST(x AS VARCHAR)), ',') END AS {c}"

ORACLES = {
    "pooled_tiers": _SCORED + " SELECT site, donor, CAST(n AS BIGINT) AS n, CAST(a AS BIGINT) AS a, n_pools, n_pools_alt, CAST(n0 AS BIGINT) AS n0, CAST(a0 AS BIGINT) AS a0, round(eps, 6) AS eps, round(llr, 6) AS llr, round(log_odds, 6) AS log_odds, round(1 / (1 + exp(-log_odds)), 6) AS posterior, CAST(in_zero AS INT) AS self_in_zero, CASE WHEN fs = '' THEN '.' ELSE fs END AS flags, tier FROM scored",
    "pooled_llr": f"WITH {ASSAY_SQL} SELECT site, donor, round(sum({_llr_sql('n', 'a', '0.005')}), 6) AS llr FROM assay GROUP BY ALL",
    "zero_class_eps": _ZERO + " SELECT site, CAST(min(n0) AS BIGINT) AS n0, CAST(min(a0) AS BIGINT) AS a0, round(min(eps), 9) AS eps, CAST(min(total) AS BIGINT) AS total FROM zc GROUP BY site",
    "pool_qc": f"WITH {ASSAY_SQL} SELECT pool, count_if(n > 0) AS sites, CAST(sum(a) AS BIGINT) AS alt_reads, CAST(sum(n - a) AS BIGINT) AS ref_reads, count_if({_HALF}) AS above_half, round(sum(a) / greatest(sum(n), 1), 6) AS alt_share FROM assay GROUP BY pool",
    "tier_summary": _SCORED + " SELECT donor, count(*) AS tested, count_if(tier = 'A') AS tier_a, count_if(tier = 'B') AS tier_b, count_if(tier = 'C') AS tier_c, count_if(tier = 'ref') AS tier_ref, count_if(tier = '-') AS tier_none FROM scored GROUP BY donor",
    "annotation_membership": _SCORED + " SELECT tier, count(*) AS n, count_if(site IN (SELECT p_partkey // 5 FROM part WHERE p_size >= 45)) AS in_large, count_if(site IN (SELECT p_partkey // 5 FROM part WHERE p_type = 'ECONOMY')) AS in_economy FROM scored GROUP BY tier",
    "site_count_lookup": "WITH s AS (SELECT p_partkey AS pos, CASE WHEN p_size % 3 = 0 THEN 'O' ELSE 'F' END AS ref, CASE WHEN p_size % 2 = 0 THEN 'R' ELSE 'Z' END AS alt FROM part), c AS (SELECT l_partkey AS pos, l_linestatus AS ref, l_returnflag AS alt, count(*) AS k FROM lineitem GROUP BY ALL), r AS (SELECT DISTINCT pos, ref FROM c) SELECT s.pos, CAST(coalesce(sum(CASE WHEN c.k IS NOT NULL THEN 7 + c.k ELSE 0 END), 0) AS BIGINT) AS n, CAST(coalesce(sum(coalesce(c.k, 0)), 0) AS BIGINT) AS a, count_if(r.ref <> s.ref) AS ref_mismatch FROM s LEFT JOIN r ON s.pos = r.pos LEFT JOIN c ON c.pos = s.pos AND c.ref = r.ref AND r.ref = s.ref AND c.alt = s.alt GROUP BY s.pos",
    "witness_veto": f"WITH {ASSAY_SQL} SELECT site, CAST(sum(CASE WHEN pool = 1 THEN a ELSE 0 END) AS BIGINT) AS witness_alt, CAST(sum(n) AS BIGINT) AS n FROM assay GROUP BY site HAVING sum(CASE WHEN pool = 1 THEN a ELSE 0 END) >= 1",
    "marker_selection": _UNION + " SELECT chrom, pos, min(ref) AS ref, min(alt) AS alt FROM al WHERE tier = 'A' AND NOT regexp_matches(fs, 'hidepth|af_gt_half') GROUP BY chrom, pos HAVING count(DISTINCT alt) = 1",
    "marker_union": _UNION + f" SELECT chrom, pos, ref, alt, len(carriers) AS n_donors, {_TEXT.format(c='carriers')}, {_TEXT.format(c='kinds')}, CAST(multi AS INT) AS multiallelic, {_TEXT.format(c='ref_donors')} FROM (SELECT *, list_transform(carriers, lambda d: CASE WHEN d = 2 THEN 'reference' ELSE 'run' END) AS kinds FROM un)",
    "union_per_donor": _UNION + " SELECT donor, count(*) AS tier_a, count_if(nd > 1) AS shared, count_if(nd = 1) AS private, count_if(multi) AS own_multiallelic, (SELECT count_if(NOT multi) FROM un) - count_if(NOT multi) AS gaps FROM (SELECT unnest(carriers) AS donor, len(carriers) AS nd, multi FROM un) GROUP BY donor",
    "sharing_rate": _STEP1 + " SELECT CAST(donor AS BIGINT) AS donor, gap_a, gap_ref, round(mu, 6) AS mu FROM mu",
    "leave_one_out_prior": _STEP1 + " SELECT chrom, pos, ref, alt, CAST(donor AS BIGINT) AS donor, CAST(k AS BIGINT) AS k, CAST(m AS BIGINT) AS m, round(prior, 6) AS prior FROM pr",
    "gap_fill_step1": _STEP1 + " SELECT chrom, pos, ref, alt, CAST(donor AS BIGINT) AS donor, state, reason, round(log_odds, 6) AS log_odds FROM st",
    "gap_fill_same_taxon": _STEP1 + _TAXON + " SELECT chrom, pos, ref, alt, CAST(donor AS BIGINT) AS donor, CAST(k AS BIGINT) AS k, CAST(m AS BIGINT) AS m, state, reason, round(prior, 6) AS prior, round(log_odds, 6) AS log_odds FROM zt",
    "gap_step1_summary": _STEP1 + _TAXON + """,
 rd AS (SELECT DISTINCT unnest(list_concat(list_filter(carriers, lambda c: c = 2), ref_donors)) AS e FROM un), od AS (SELECT 0 AS e, 0 AS kind UNION ALL SELECT 1, 0 UNION ALL SELECT e, 1 FROM rd),
 ds AS (SELECT e AS donor, taxon FROM tx WHERE e < 2), pd AS (SELECT ds.donor, ds.taxon, coalesce(string_agg(CAST(od.e AS VARCHAR), ',' ORDER BY od.kind, od.e) FILTER (t2.taxon = ds.taxon), '') AS prior_donors, coalesce(string_agg(CAST(od.e AS VARCHAR), ',' ORDER BY od.kind, od.e) FILTER (t2.taxon <> ds.taxon), '') AS prior_donors_other_taxon, count(*) FILTER (t2.taxon = ds.taxon) AS np FROM ds CROSS JOIN od JOIN tx t2 ON t2.e = od.e WHERE od.e <> ds.donor GROUP BY ds.donor, ds.taxon),
 ua AS (SELECT donor, count(*) AS union_alleles, count_if(own) AS own, count_if(NOT own) AS gaps FROM gr GROUP BY donor),
 ca AS (SELECT donor, count_if(state = 'ALT') AS alt, count_if(state = 'REF') AS ref, count_if(state IS NULL) AS na, count_if(reason = 'absent') AS na_absent, count_if(reason = 'blocked_flag') AS na_blocked_flag, count_if(reason = 'below_cutoff') AS na_below_cutoff, count_if(jllr IS NOT NULL AND (jtier = 'ref') <> coalesce(state = 'REF', false)) AS odd FROM zt GROUP BY donor)
 SELECT CAST(ds.donor AS BIGINT) AS donor, ds.taxon, round(mu.mu, 6) AS mu, 'other_donors' AS prior_source_requested, CASE WHEN coalesce(np, 0) = 0 THEN 'mu_only (no prior donors)' ELSE 'other_donors' END AS prior_source_used, CAST(coalesce(np, 0) AS INT) AS n_prior_donors, coalesce(prior_donors, '') AS prior_donors, coalesce(prior_donors_other_taxon, '') AS prior_donors_other_taxon,
 gap_a AS gap_tier_a, gap_ref, (SELECT count_if(multi) FROM un) AS multiallelic_skipped, union_alleles, own, gaps, coalesce(ca.alt, 0) AS alt, coalesce(ca.ref, 0) AS ref, coalesce(na, 0) AS na, coalesce(na_absent, 0) AS na_absent, coalesce(na_blocked_flag, 0) AS na_blocked_flag, coalesce(na_below_cutoff, 0) AS na_below_cutoff, coalesce(odd, 0) AS ref_rule_vs_tier_disagree
 FROM ds JOIN mu ON mu.donor = ds.donor JOIN ua ON ua.donor = ds.donor LEFT JOIN pd ON pd.donor = ds.donor LEFT JOIN ca ON ca.donor = ds.donor""",
    "gap_step2_summary": _STEP2 + """, ln AS (SELECT line % 2 AS donor, line, line % 7 = 3 AS failed, line % 11 <> 5 AS seg, lam FROM lam), lu AS (SELECT *, CASE WHEN NOT failed AND seg AND lam > 0 THEN lam END AS u FROM ln),
 lt AS (SELECT donor, count(*) AS lines_in_counts, count(u) AS lines_used, count_if(failed) AS lines_excluded_qc, count_if(NOT failed AND NOT seg) AS lines_without_segments, count_if(NOT failed AND seg AND u IS NULL) AS lines_without_x0_depth, list_sort(list(u) FILTER (u IS NOT NULL))[count(u) // 2 + 1] AS med FROM lu GROUP BY donor),
 cs AS (SELECT donor, count(*) AS candidates, count_if(call = 'ALT') AS alt, count_if(call = 'undecided') AS und, count_if(call = 'blocked_flag') AS bf, count_if(call = 'blocked_x0_lines') AS bx, count_if(call = 'no_test') AS nt, count_if(call = 'ALT' AND a_x0 > 0) AS ax, sum(CASE WHEN call = 'ALT' THEN a_x0 END) / nullif(sum(CASE WHEN call = 'ALT' THEN n_x0 END), 0) AS r1, sum(CASE WHEN call = 'undecided' THEN a_x0 END) / nullif(sum(CASE WHEN call = 'undecided' THEN n_x0 END), 0) AS r2 FROM st2 GROUP BY donor)
 SELECT CAST(lt.donor AS BIGINT) AS donor, lines_in_counts, lines_used, lines_excluded_qc, lines_without_segments, lines_without_x0_depth, coalesce(candidates, 0) AS candidates, coalesce(alt, 0) AS alt, coalesce(und, 0) AS undecided, coalesce(bf, 0) AS blocked_flag, coalesce(bx, 0) AS blocked_x0_lines, coalesce(nt, 0) AS no_test, coalesce(ax, 0) AS alt_calls_with_x0_alt_reads, round(r1, 6) AS x0_alt_rate_at_alt, round(r2, 6) AS x0_alt_rate_at_undecided, round(med, 6) AS median_lambda FROM lt LEFT JOIN cs ON cs.donor = lt.donor""",
    "founder_summary": _FOUNDER + """, fn AS (SELECT donor, count(*) AS n, count_if(call_step = 'multiallelic') AS mu_, count_if(call_step = 'own') AS ow_, count_if(call_step = 'step1_ref') AS sr_, count_if(call_step = 'step1_alt') AS sa_, count_if(call_step = 'step2_alt') AS s2_, count_if(call_step = 'missing') AS mi_ FROM fs GROUP BY donor)
 SELECT CAST(donor AS BIGINT) AS donor, n AS union_alleles, n - mu_ AS biallelic, n - mu_ - ow_ AS gaps, mu_ AS multiallelic, ow_ AS own, sr_ AS step1_ref, sa_ AS step1_alt, s2_ AS step2_alt, mi_ AS missing, round((sr_ + sa_) / nullif(n - mu_ - ow_, 0), 6) AS step1_share_of_gaps, round(s2_ / nullif(n - mu_ - ow_, 0), 6) AS step2_share_of_gaps, round(mi_ / nullif(n - mu_ - ow_, 0), 6) AS missing_share_of_gaps, round(mi_ / nullif(n - mu_, 0), 6) AS missing_share_of_union FROM fn""",
    "line_depth_scale": "WITH x AS (SELECT 1)" + _OBS + " SELECT line, sites_x0, round(lam, 6) AS lam FROM lam",
    "gap_fill_step2": _STEP2 + " SELECT CAST(donor AS BIGINT) AS donor, CAST(key AS BIGINT) AS key, CAST(n_x0 AS BIGINT) AS n_x0, CAST(a_x0 AS BIGINT) AS a_x0, CAST(lines_x0 AS BIGINT) AS lines_x0, CAST(lines_donor AS BIGINT) AS lines_donor, CAST(n_donor AS BIGINT) AS n_donor, CAST(a_donor AS BIGINT) AS a_donor, round(eps_s, 5) AS eps_s, round(p_x0, 5) AS p_x0, round(ks, 5) AS ks, round(llr_lines, 5) AS llr_lines, round(log_odds2, 5) AS log_odds, call FROM st2",
    "founder_calls": _FOUNDER + " SELECT CAST(donor AS BIGINT) AS donor, CAST(key AS BIGINT) AS key, CASE WHEN call_step IN ('own', 'step1_alt', 'step2_alt') THEN 'ALT' WHEN call_step = 'step1_ref' THEN 'REF' END AS allele, call_step, round(lo, 5) AS log_odds, round(CASE WHEN call_step = 'own' THEN 1.0 ELSE 1 / (1 + exp(-lo)) END, 5) AS p_alt FROM ff",
    "upper_median": f"WITH {ASSAY_SQL} SELECT donor, list_sort(list(n))[len(list(n)) // 2 + 1] AS upper_median, median(n) AS averaged_median FROM assay GROUP BY donor",
    "rarefaction": _SCORED + " SELECT donor, count(*) AS sites, round(avg(f), 9) AS found_share, round(avg(o), 9) AS own_share FROM (SELECT donor, max(CAST(tier = 'A' AS INT)) OVER (PARTITION BY site ORDER BY donor) AS f, CAST(tier = 'A' AS INT) AS o FROM scored) GROUP BY donor",
}
