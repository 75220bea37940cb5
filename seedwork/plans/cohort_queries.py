"""Queries of intervals, rasters, cohort QC, reads, labels and guards over the driver's tables, with their SQL twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwork.operators import intervals, labels, qc, reads, report
from seedwork.operators.segmentation import segment_lines
from seedwork.plans.bindings import PANEL_SQL, SEGMENTS_SQL, panel, segments
from seedwork.session import table
from seedwork.sources.readers import DEMUX_REPORT

_DAY0 = "1995-01-01"
_LINES = 40  # lines of the segments view


def _r(*names: str, to: int = 6) -> list:
    return [F.round(n, to).alias(n) for n in names]


def _ranges(spark: SparkSession, sf: str) -> DataFrame:
    """Ranges of every row of lineitem, by supplier: from the ship day on, one half-open day per 25 units."""
    day = F.date_diff("l_shipdate", F.lit(_DAY0).cast("date")).cast("long")
    return table(spark, sf, "lineitem").select(F.col("l_suppkey").alias("chrom"), day.alias("start"), (day + F.ceil(F.col("l_quantity") / 25)).alias("end"))


_RANGES_SQL = f"ranges AS (SELECT l_suppkey AS chrom, date_diff('day', DATE '{_DAY0}', CAST(l_shipdate AS DATE)) AS start, date_diff('day', DATE '{_DAY0}', CAST(l_shipdate AS DATE)) + CAST(ceil(l_quantity / 25) AS BIGINT) AS \"end\" FROM lineitem)"
_MERGE_SQL = """ SELECT chrom, min(start) AS start, max("end") AS "end" FROM (SELECT *, sum(CASE WHEN prev IS NULL OR start > prev THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start, "end", prev NULLS FIRST ROWS UNBOUNDED PRECEDING) AS run FROM
 (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM {src})) GROUP BY chrom, run"""


def interval_merge(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.merge_intervals(_ranges(spark, sf), ["chrom"])


def region_clip(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.region_bed(_ranges(spark, sf), ["chrom"], 400, 1200)


def range_semi_join(spark: SparkSession, sf: str) -> DataFrame:
    """Orders whose day lies in a merged range of the supplier that fifteen customers share."""
    day = F.date_diff("o_orderdate", F.lit(_DAY0).cast("date")).cast("long")
    pts = table(spark, sf, "orders").select("o_orderkey", F.expr("(o_custkey - 1) div 15 + 1").alias("chrom"), day.alias("pos"))
    merged = interval_merge(spark, sf).withColumn("end", F.col("end") - 1)
    return intervals.in_ranges(pts, merged, ["chrom"], "pos", bin_width=64).groupBy("chrom").agg(F.count(F.lit(1)).alias("n"))


def _points(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem")
    day = F.date_diff("l_shipdate", F.lit(_DAY0).cast("date")).cast("long")
    return li.select("l_orderkey", "l_linenumber", (F.col("l_orderkey") % 40).alias("line"), day.alias("pos"))


def segment_state_asof(spark: SparkSession, sf: str) -> DataFrame:
    got = intervals.state_at(_points(spark, sf), segments(spark, sf), ["line"], "pos", "start", "end", "state", "x", bin_width=512)
    return got.select("l_orderkey", "l_linenumber", "x")


def breakpoints(spark: SparkSession, sf: str) -> DataFrame:
    return intervals.breakpoints(segments(spark, sf))


def _sites(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    kind = F.col("p_size") % 5
    return part.select(F.lit("c").alias("chrom"), (F.col("p_partkey") % 2411).alias("pos"), (kind == 0).alias("is_marker"), (kind > 1).alias("is_gap"), (kind == 4).alias("is_step2"))


def breakpoint_density(spark: SparkSession, sf: str) -> DataFrame:
    got = intervals.breakpoint_density(segments(spark, sf).withColumn("chrom", F.lit("c")), _sites(spark, sf), 2)
    return got.select("line", "n_breakpoints", "near", "near_2", "far", "far_2", *_r("share_near", "share_far"))


def _alleles(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    k = F.col("p_size") % 4
    return part.select(F.lit("c").alias("chrom"), F.col("p_partkey").alias("site"), (F.col("p_partkey") % 2411).alias("pos"), F.when(k < 2, "ALT").when(k == 2, "REF").alias("allele"), F.when(k == 0, 1.0).when(k == 1, 0.5).when(k == 2, 0.25).alias("p_alt"))


def _raster(spark: SparkSession, sf: str) -> DataFrame:
    segs = segments(spark, sf).withColumn("chrom", F.lit("c"))
    return report.raster(_alleles(spark, sf), segs, segs.where(F.col("line") == 3).select("line").distinct())


def raster_long(spark: SparkSession, sf: str) -> DataFrame:
    return _raster(spark, sf).select("site", "line", "x", "gt", "dosage")


def raster_matrix(spark: SparkSession, sf: str) -> DataFrame:
    return report.matrix(_raster(spark, sf), ["site"], range(_LINES))


def genotype_summary(spark: SparkSession, sf: str) -> DataFrame:
    """Lengths by state and sites by genotype of each line, and in total."""
    got = report.line_summary(segments(spark, sf), spark.createDataFrame([(3,), (7,)], "line long"), cells=_raster(spark, sf))
    return got.select("line", "excluded", "length_x0", "length_x1", "length_x2", "sites", "sites_gt0", "sites_gt1", "sites_gt2", "sites_na", *_r("no_call_share"))


def line_summary_total(spark: SparkSession, sf: str) -> DataFrame:
    segs = segments(spark, sf)
    got = report.line_summary(segs, segs.where(F.col("line") % 7 == 0).select("line"))
    return got.select("line", "excluded", "length_x0", "length_x1", "length_x2", "called", *_r("share_x0", "share_x1", "share_x2"))


def single_locus_chi2(spark: SparkSession, sf: str) -> DataFrame:
    got = report.single_locus(_raster(spark, sf), ["site"])
    return got.select("site", "n_x0", "n_x1", "n_x2", "n_lines", *_r("donor_freq", "allele_freq_gt", "het_freq", "chi2", "p_chi2"))


def painting_rectangles(spark: SparkSession, sf: str) -> DataFrame:
    segs = segments(spark, sf)
    return report.painting(segs, segs.where(F.col("line") % 7 == 0).select("line"))


def _markers(p: DataFrame) -> DataFrame:
    """Panel sites that are variable over all samples: at least one sample has reads of ALT and one has reads of REF."""
    return p.groupBy("contig", "pos").agg(F.sum("alt").alias("a"), F.sum("reads").alias("r")).where((F.col("a") > 0) & (F.col("a") < F.col("r"))).select("contig", "pos")


def coverage_dense(spark: SparkSession, sf: str) -> DataFrame:
    p = panel(spark, sf)
    got = qc.coverage_dense(_markers(p), p, p.select("sample"), floor=8, report=(2, 5))
    return got.select("sample", "contig", "sites", "covered", "reads", *_r("fraction", "mean_depth"), *[F.col(c).cast("int").alias(c) for c in ("counted", "below_min_markers", "below_2", "below_5")])


def min_coverage(spark: SparkSession, sf: str) -> DataFrame:
    cust = table(spark, sf, "customer")
    metrics = cust.where(F.col("c_custkey") % 7 != 0).select(F.col("c_custkey").alias("sample"), F.when(F.col("c_custkey") % 11 != 0, F.col("c_acctbal")).alias("mean_coverage"))
    return qc.min_coverage(cust.select(F.col("c_custkey").alias("sample")), metrics, 1000.0).select("sample", "mean_coverage", F.col("pass").cast("int").alias("pass"), "reason")


def donor_content(spark: SparkSession, sf: str) -> DataFrame:
    got = qc.donor_content(panel(spark, sf), {"line": 0.125, "bc1_sample": 0.25}, min_sites=20, low=0.42, relative=0.9, control_high=0.45)
    return got.select("sample", "role", "donor", "covered", "with_alt", "reads", "alt_reads", *_r("share_sites_alt", "alt_read_fraction", "expected", "ratio_to_expected", "rel_to_group"), F.array_join("reasons", ",").alias("reasons"), F.col("flag").cast("int").alias("flag"))


def _kin(spark: SparkSession, sf: str) -> DataFrame:
    p = panel(spark, sf).withColumn("donor", F.when(F.col("role") != "control", F.col("donor")))
    return qc.group_kinship(qc.site_values(p))


def kinship_group(spark: SparkSession, sf: str) -> DataFrame:
    return _kin(spark, sf).select("sample", "group", *_r("kinship"), "n_sites")


def kinship_flags(spark: SparkSession, sf: str) -> DataFrame:
    p = panel(spark, sf).withColumn("donor", F.when(F.col("role") != "control", F.col("donor"))).select("sample", "donor", "role").distinct()
    got = qc.kinship_flags(_kin(spark, sf), p, flag_sd=1.5, margin=0.05, min_sites=10)
    return got.select("sample", *_r("kinship_own", "own_z", "kinship_other"), "n_sites_own", "closest_other", F.array_join("reasons", ",").alias("reasons"), F.col("flag").cast("int").alias("flag"))


def pseudohaploid_draw(spark: SparkSession, sf: str) -> DataFrame:
    got = qc.site_values(panel(spark, sf), F.col("role") == "line")
    return got.select("sample", "contig", "pos", *_r("v", to=9))


def _line_qc(spark: SparkSession, sf: str) -> DataFrame:
    p = panel(spark, sf)
    counts = p.select(F.col("sample").alias("line"), "contig", "pos", (F.col("reads") - F.col("alt")).alias("ref"), "alt")
    return qc.line_marker_qc(counts, _markers(p), counts.select("line"), 10, 250)


def line_observations(spark: SparkSession, sf: str) -> DataFrame:
    """Counts of the lines that pass, at kept markers."""
    p = panel(spark, sf)
    counts = p.select(F.col("sample").alias("line"), "contig", "pos", (F.col("reads") - F.col("alt")).alias("ref"), "alt")
    got = qc.line_observations(counts, _markers(p), _line_qc(spark, sf))
    return got.groupBy("line", "contig").agg(F.count(F.lit(1)).alias("n"), F.sum("ref").alias("ref"), F.sum("alt").alias("alt"), F.max("pos").alias("last"))


def kinship_self(spark: SparkSession, sf: str) -> DataFrame:
    return qc.self_kinship(qc.site_values(panel(spark, sf))).select("sample", *_r("kinship_self"), "n_sites")


def line_marker_qc(spark: SparkSession, sf: str) -> DataFrame:
    got = _line_qc(spark, sf)
    return got.select("line", "contig", "markers", "markers_kept", "covered", "reads", "rigidity", "floor", *_r("mean_depth"), F.col("contig_pass").cast("int").alias("contig_pass"), F.col("line_pass").cast("int").alias("line_pass"), "reason")


def _decision(spark: SparkSession, sf: str) -> DataFrame:
    docs = table(spark, sf, "documents").select(F.col("doc_id").alias("sample"), "n_chars", "lang")
    lab = table(spark, sf, "labels").groupBy(F.col("doc_id").alias("sample")).agg(F.max("flagged").alias("f"))
    cov = docs.where(F.col("n_chars").isNotNull()).select("sample", (F.col("n_chars") >= 40).alias("pass"), F.lit("below_min_coverage").alias("reason"))
    rel = lab.where(F.col("f").isNotNull()).select("sample", (F.col("f") == 1).alias("flag"), F.lit("flagged").alias("reason"))
    con = docs.where(F.col("lang").isNotNull()).select("sample", (F.col("lang") == "und").alias("flag"), F.lit("undetermined").alias("reason"))
    return qc.sample_decision(docs.select("sample"), cov, {"panel_coverage": None, "relatedness": con, "donor_content": rel}, fail_on=("relatedness",))


def sample_decision(spark: SparkSession, sf: str) -> DataFrame:
    return _decision(spark, sf).select("sample", F.col("pass").cast("int").alias("pass"), F.array_join("reasons", ",").alias("reasons"), F.array_join("notes", ",").alias("notes"), "state")


def exclusions(spark: SparkSession, sf: str) -> DataFrame:
    lines = _line_qc(spark, sf).select("line", "contig_pass", "line_pass", F.lit("below_marker_floor").alias("reason"))
    return qc.exclusions(_decision(spark, sf), lines)


def label_resolution(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    registry = part.where(F.col("p_partkey") % 5 != 0).select(F.col("p_partkey").cast("string").alias("sample"), F.when(F.col("p_size") % 3 == 0, F.col("p_name")).otherwise("").alias("nil_id"), F.when(F.col("p_size") % 2 == 0, F.col("p_brand")).alias("pedigree"), F.lit("").alias("donor"), F.lit("FALSE").alias("exclude"))
    return labels.resolve_labels(part.select(F.col("p_partkey").cast("string").alias("sample")), registry).select("sample", "label", "label_source", "collision")


def robust_zscore(spark: SparkSession, sf: str) -> DataFrame:
    return qc.robust_z(table(spark, sf, "customer").select("c_custkey", "c_mktsegment", "c_acctbal"), ["c_mktsegment"], "c_acctbal").select("c_custkey", *_r("robust_z"))


def _codes(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "bc1_well_map").where(F.col("barcode").isNotNull()).select("barcode").distinct().select("barcode", F.concat(F.lit("s_"), "barcode").alias("sample"))


def barcode_demux(spark: SparkSession, sf: str) -> DataFrame:
    """Whole barcodes of the registry read as sequences, assigned to the well barcodes they start with."""
    rows = table(spark, sf, "registry_test").where(F.col("library_index").isNotNull()).select("sample_id", "library_index").distinct()
    got = reads.demultiplex(rows, _codes(spark, sf), "library_index", skip=1)
    return got.groupBy("sample").agg(F.count(F.lit(1)).alias("n"), F.min("trimmed").alias("least_rest"))


def base_composition(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "registry_test").where(F.col("library_index").isNotNull()).select("source", "library_index")
    return reads.base_composition(rows, ["source"], "library_index", 10)


def duplicate_policy(spark: SparkSession, sf: str) -> DataFrame:
    e = table(spark, sf, "events").select("event_id", "user_id", "event_type", "value")
    last, first = qc.duplicates(e, ["user_id", "event_type"], "event_id", "last"), qc.duplicates(e, ["user_id", "event_type"], "event_id", "first")
    return last.withColumn("policy", F.lit("last")).unionByName(first.withColumn("policy", F.lit("first")))


def _alignments(spark: SparkSession, sf: str) -> DataFrame:
    """One read per row of lineitem: up to 32 bases from a hash, both strands and mates, with insertions, gaps, and hard clips beyond cycle 1000."""
    n = F.least(F.col("l_quantity").cast("int"), F.lit(32))
    kind, half = F.col("l_linenumber"), (n / 2).cast("int")
    at = lambda op: F.concat(half.cast("string"), F.lit(f"M2{op}"), (n - half - (2 if op in "IS" else 0)).cast("string"), F.lit("M"))
    whole = F.concat(n.cast("string"), F.lit("M"))
    cigar = F.when((kind == 2) & (n > 8), at("D")).when((kind == 3) & (n > 8), at("I")).when((kind == 4) & (n > 8), at("N")).when(kind == 7, F.concat(F.lit("1200H"), whole)).otherwise(whole)
    base = F.translate(F.md5(F.concat_ws(":", "l_orderkey", "l_linenumber")), "0123456789abcdef", "ACGTACGTACGTACGT")
    flag = F.when(F.col("l_orderkey") % 2 == 0, 16).otherwise(0) + F.when(F.col("l_partkey") % 2 == 0, 128).otherwise(0)
    qual = F.when(F.col("l_suppkey") % 5 == 0, "*").otherwise(F.substring(F.repeat(F.lit("III!IIII"), 4), F.lit(1), n))
    day = F.date_diff("l_shipdate", F.lit(_DAY0).cast("date")).cast("long")
    return table(spark, sf, "lineitem").select((F.col("l_suppkey") % 10).alias("sample"), flag.alias("flag"), F.concat(F.lit("chr"), (F.col("l_partkey") % 5 + 1).cast("string")).alias("rname"), day.alias("pos"), cigar.alias("cigar"), F.substring(base, F.lit(1), n).alias("seq"), qual.alias("qual"))


def _read_sites(spark: SparkSession, sf: str) -> DataFrame:
    base = lambda k: F.element_at(F.array(*map(F.lit, "ACGT")), (k % 4 + 1).cast("int"))
    sites = table(spark, sf, "part").select(F.concat(F.lit("chr"), (F.col("p_partkey") % 5 + 1).cast("string")).alias("rname"), (F.col("p_partkey") % 2411).alias("pos")).distinct()
    return sites.select("rname", "pos", base(F.col("pos")).alias("ref"), base(F.col("pos") + 1).alias("alt"))


def cycle_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Bases of the reads of lineitem at sites of part, by sample, mate and cycle bin; all samples together under null."""
    a = _alignments(spark, sf)
    return reads.cycle_counts(a, _read_sites(spark, sf), a.select("sample"), whole=True)


def allele_pileup(spark: SparkSession, sf: str) -> DataFrame:
    """Depths of both alleles at the sites of part, by sample."""
    a = _alignments(spark, sf).withColumn("mapq", (F.col("pos") % 50 + 15).cast("int"))
    got = reads.count_alleles(a, _read_sites(spark, sf))
    return got.select("sample", "rname", "pos", F.col("ad")[0].alias("ref_n"), F.col("ad")[1].alias("alt_n"))


def mask_qualities(spark: SparkSession, sf: str) -> DataFrame:
    """Fixed-length stand-ins of quality strings: order priorities masked by order number's bits."""
    o = table(spark, sf, "orders").select("o_orderkey", F.col("o_orderpriority").alias("q"), (F.when(F.col("o_orderkey") % 2 == 0, 16).otherwise(0) + F.when(F.col("o_orderkey") % 3 == 0, 128).otherwise(0) + F.when(F.col("o_orderkey") % 11 == 0, 256).otherwise(0)).alias("flag"))
    return o.select("o_orderkey", reads.mask_starts(F.col("flag"), F.col("q"), F.lit(3), F.lit(5)).alias("masked"))


def settings_diff(spark: SparkSession, sf: str) -> DataFrame:
    a = table(spark, sf, "nation").select(F.col("n_nationkey").cast("string").alias("name"), F.col("n_regionkey").cast("string").alias("value"))
    b = table(spark, sf, "region").select(F.col("r_regionkey").cast("string").alias("name"), F.col("r_regionkey").cast("string").alias("value"))
    return labels.settings_diff(a, b)


def guard_violations(spark: SparkSession, sf: str) -> DataFrame:
    o, c = table(spark, sf, "orders"), table(spark, sf, "customer")
    a = labels.duplicate_keys(o, ["o_custkey"]).where(F.col("n") > 20).select(F.lit("duplicate").alias("guard"), F.col("o_custkey").alias("key"))
    b = labels.missing_keys(o, c.where(F.col("c_acctbal") > 0), "o_custkey", "c_custkey").select(F.lit("missing").alias("guard"), F.col("o_custkey").alias("key"))
    d = labels.inconsistent(o, ["o_custkey"], "o_orderstatus").select(F.lit("inconsistent").alias("guard"), F.col("o_custkey").alias("key"))
    return a.unionByName(b).unionByName(d)


def channel_join_remainder(spark: SparkSession, sf: str) -> DataFrame:
    o = table(spark, sf, "orders").where(F.col("o_custkey") % 3 != 0).groupBy(F.col("o_custkey").alias("k")).agg(F.count(F.lit(1)).alias("n_orders"))
    c = table(spark, sf, "customer").where(F.col("c_custkey") % 2 == 0).select(F.col("c_custkey").alias("k"), "c_mktsegment")
    return o.join(c, "k", "full").select("k", F.coalesce("n_orders", F.lit(0)).alias("n_orders"), F.coalesce("c_mktsegment", F.lit("none")).alias("segment"))


def nested_json_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Lane reports in their nested shape, one an event, parsed again: matches by adapter name over all lanes, with the lanes' inputs."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    adapters = F.array(F.struct(F.col("event_type").alias("name"), k.alias("total_matches")), F.struct(F.lit("none").alias("name"), F.lit(0).alias("total_matches")))
    text = F.to_json(F.struct(F.struct((k + 1).alias("input")).alias("read_counts"), adapters.alias("adapters_read1")))
    e = table(spark, sf, "events").select(F.from_json(text, DEMUX_REPORT).alias("r"))
    rows = e.select(F.col("r.read_counts.input").alias("input"), F.explode("r.adapters_read1").alias("a")).where(F.col("a.name") != "none")
    return rows.groupBy(F.col("a.name").alias("event_type")).agg(F.sum("a.total_matches").alias("total"), F.sum("input").alias("input"), F.count(F.lit(1)).alias("n"))


def family_regression_lod(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_partkey", "l_quantity", "l_extendedprice")
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand")
    got = report.family_regression(li.join(part, "l_partkey"), ["p_brand"], "l_quantity", "l_extendedprice")
    return got.select("p_brand", "n", *_r("slope", "lod", to=4))


def rigid_segmentation(spark: SparkSession, sf: str) -> DataFrame:
    p = panel(spark, sf)
    obs = p.select(F.col("donor").alias("line"), "contig", (F.col("pos") * 1000 + F.col("sample")).alias("pos"), (F.col("reads") - F.col("alt")).alias("ref"), "alt")
    return segment_lines(obs, rigidity=12)


QUERIES = {f.__name__: f for f in (
    interval_merge, region_clip, range_semi_join, segment_state_asof, breakpoints, breakpoint_density, raster_long, raster_matrix, line_summary_total, single_locus_chi2, painting_rectangles,
    coverage_dense, min_coverage, donor_content, kinship_group, kinship_flags, pseudohaploid_draw, line_marker_qc, line_observations, kinship_self, genotype_summary, sample_decision, exclusions, label_resolution, robust_zscore,
    barcode_demux, base_composition, duplicate_policy, cycle_counts, allele_pileup, mask_qualities, settings_diff, guard_violations, channel_join_remainder, nested_json_counts, family_regression_lod, rigid_segmentation,
)}


# --- SQL twins -----------------------------------------------------------------------------------------------------

_PTS = f"pts AS (SELECT l_orderkey, l_linenumber, l_orderkey % 40 AS line, date_diff('day', DATE '{_DAY0}', CAST(l_shipdate AS DATE)) AS pos FROM lineitem)"
_BP = 'bp AS (SELECT line, ("end" + s2) / 2.0 AS breakpoint FROM (SELECT line, "end", state, lead(start) OVER w AS s2, lead(state) OVER w AS v2 FROM segments WINDOW w AS (PARTITION BY line ORDER BY start)) WHERE state <> v2)'
_ALLELES = "al AS (SELECT 'c' AS chrom, p_partkey AS site, p_partkey % 2411 AS pos, CASE WHEN p_size % 4 < 2 THEN 'ALT' WHEN p_size % 4 = 2 THEN 'REF' END AS allele, CASE p_size % 4 WHEN 0 THEN 1.0 WHEN 1 THEN 0.5 WHEN 2 THEN 0.25 END AS p_alt FROM part)"
_RASTER = f"""WITH {SEGMENTS_SQL}, {_ALLELES},
ce AS (SELECT site, allele, p_alt, pos, n.line AS line FROM al CROSS JOIN (SELECT DISTINCT line FROM segments) n),
cx AS (SELECT ce.*, CASE WHEN s."end" >= ce.pos AND ce.line <> 3 THEN s.state END AS x FROM ce ASOF LEFT JOIN segments s ON ce.line = s.line AND ce.pos >= s.start),
cells AS (SELECT *, CASE WHEN allele = 'ALT' THEN x WHEN allele = 'REF' THEN CASE WHEN x IS NOT NULL THEN 0 END WHEN x = 0 THEN 0 END AS gt, CASE WHEN x = 0 THEN 0.0 ELSE x * p_alt END AS dosage FROM cx)"""
_EX = report.EXPECT["bc2s2"]
_CHI = " + ".join(f"(n{v} - n * {_EX[v]!r}) * (n{v} - n * {_EX[v]!r}) / (n * {_EX[v]!r})" for v in range(3))
_CENTRED = f"""WITH {PANEL_SQL}, pv AS (SELECT sample, contig, pos, CASE WHEN role <> 'control' THEN donor END AS donor, role, alt / reads AS v FROM panel WHERE reads > 0),
pc AS (SELECT *, avg(v) OVER (PARTITION BY contig, pos) AS p FROM pv), z AS (SELECT *, v - p AS z, p * (1 - p) AS w FROM pc WHERE p > 0 AND p < 1),
g AS (SELECT contig, pos, donor AS grp, sum(z) AS s, count(*) AS c FROM z WHERE donor IS NOT NULL GROUP BY ALL),
m AS (SELECT z.*, g.grp, (g.s - CASE WHEN coalesce(z.donor = g.grp, false) THEN z.z ELSE 0 END) / nullif(g.c - CAST(coalesce(z.donor = g.grp, false) AS INT), 0) AS m FROM z JOIN g USING (contig, pos)),
kin AS (SELECT sample, donor, grp, sum(z * m) / sum(w) AS kinship, count(*) AS n_sites FROM m WHERE m IS NOT NULL GROUP BY ALL)"""
_FLAGS = (
    _CENTRED
    + """, sm AS (SELECT DISTINCT sample, CASE WHEN role <> 'control' THEN donor END AS donor, role FROM panel),
ow AS (SELECT sample, kinship AS kinship_own, n_sites AS n_sites_own FROM kin WHERE donor = grp),
ot AS (SELECT sample, arg_max(grp, (kinship, grp)) AS closest_other, max(kinship) AS kinship_other FROM kin WHERE donor IS NULL OR donor <> grp GROUP BY sample),
b AS (SELECT sm.*, kinship_own, coalesce(n_sites_own, 0) AS n_sites_own, closest_other, kinship_other, kinship_own IS NOT NULL AND coalesce(n_sites_own, 0) >= 10 AND donor IS NOT NULL AS usable FROM sm LEFT JOIN ow USING (sample) LEFT JOIN ot USING (sample)),
b1 AS (SELECT *, CASE WHEN usable THEN kinship_own END AS val FROM b), b2 AS (SELECT *, median(val) OVER (PARTITION BY donor, role) AS md, count(val) OVER (PARTITION BY donor, role) AS k FROM b1),
b3 AS (SELECT *, median(abs(val - md)) OVER (PARTITION BY donor, role) AS mad FROM b2), b4 AS (SELECT *, CASE WHEN k >= 4 THEN (val - md) / (1.4826 * nullif(mad, 0)) END AS own_z FROM b3),
b5 AS (SELECT *, concat_ws(',', CASE WHEN donor IS NOT NULL AND NOT usable THEN 'insufficient_sites' END, CASE WHEN usable AND own_z < -1.5 THEN 'low_kinship_own_donor' END, CASE WHEN usable AND kinship_other > kinship_own + 0.05 THEN 'closer_to_other_donor' END) AS reasons FROM b4)"""
)
_LQ = f"""{PANEL_SQL}, mk AS (SELECT contig, pos FROM panel GROUP BY ALL HAVING sum(alt) > 0 AND sum(alt) < sum(reads)), hr AS (SELECT p.* FROM panel p SEMI JOIN mk USING (contig, pos)),
kp AS (SELECT contig, pos FROM hr GROUP BY ALL HAVING max(alt) > 0), rg AS (SELECT greatest(1, CAST(round_even(10.0 * count(*) / 250, 0) AS BIGINT)) AS rigidity FROM kp),
cv AS (SELECT sample, contig, count(*) AS covered, sum(reads) AS reads FROM hr SEMI JOIN kp USING (contig, pos) WHERE reads > 0 GROUP BY ALL),
gr AS (SELECT l.sample AS line, m.contig, m.markers, coalesce(k.markers_kept, 0) AS markers_kept FROM (SELECT DISTINCT sample FROM panel) l CROSS JOIN (SELECT contig, count(*) AS markers FROM mk GROUP BY contig) m LEFT JOIN (SELECT contig, count(*) AS markers_kept FROM kp GROUP BY contig) k USING (contig)),
lq AS (SELECT gr.*, coalesce(cv.covered, 0) AS covered, coalesce(cv.reads, 0) AS reads, rigidity, greatest(CAST(ceil(2.0 * rigidity) AS BIGINT), 2 * rigidity) AS floor, cv.reads / cv.covered AS mean_depth FROM gr CROSS JOIN rg LEFT JOIN cv ON gr.line = cv.sample AND gr.contig = cv.contig),
lp AS (SELECT *, covered >= floor AS contig_pass, bool_and(covered >= floor) OVER (PARTITION BY line) AS line_pass FROM lq)"""
_READS = f"""rd AS (SELECT l_suppkey % 10 AS sample, CASE WHEN l_orderkey % 2 = 0 THEN 16 ELSE 0 END AS rev, CASE WHEN l_partkey % 2 = 0 THEN 2 ELSE 1 END AS mate, 'chr' || (l_partkey % 5 + 1) AS rname, date_diff('day', DATE '{_DAY0}', CAST(l_shipdate AS DATE)) AS pos,
  least(CAST(l_quantity AS INT), 32) AS n, l_linenumber AS kind, translate(md5(concat_ws(':', CAST(l_orderkey AS VARCHAR), CAST(l_linenumber AS VARCHAR))), '0123456789abcdef', 'ACGTACGTACGTACGT') AS seq, l_suppkey % 5 = 0 AS star FROM lineitem),
rb AS (SELECT *, n // 2 AS half, unnest(range(0, n)) AS i FROM rd),
rp AS (SELECT *, CASE WHEN kind IN (2, 4) AND n > 8 THEN pos + i + CASE WHEN i < half THEN 0 ELSE 2 END WHEN kind = 3 AND n > 8 THEN CASE WHEN i < half THEN pos + i WHEN i < half + 2 THEN NULL ELSE pos + i - 2 END ELSE pos + i END AS at,
  CASE WHEN rev = 16 THEN n - i ELSE i + 1 + CASE WHEN kind = 7 THEN 1200 ELSE 0 END END AS cycle, substr(seq, CAST(i + 1 AS BIGINT), 1) AS base FROM rb WHERE star OR i % 8 <> 3),
st AS (SELECT DISTINCT 'chr' || (p_partkey % 5 + 1) AS rname, p_partkey % 2411 AS pos FROM part), sb AS (SELECT *, substr('ACGT', CAST(pos % 4 + 1 AS BIGINT), 1) AS ref, substr('ACGT', CAST((pos + 1) % 4 + 1 AS BIGINT), 1) AS alt FROM st),
rh AS (SELECT rp.*, sb.ref, sb.alt, sb.pos AS site, CASE WHEN cycle <= 2 THEN 0 WHEN cycle <= 4 THEN 1 WHEN cycle <= 8 THEN 2 WHEN cycle <= 12 THEN 3 WHEN cycle <= 20 THEN 4 WHEN cycle <= 40 THEN 5 WHEN cycle <= 80 THEN 6 ELSE 7 END AS bin FROM rp JOIN sb ON rp.rname = sb.rname AND rp.at = sb.pos)"""
_DEC = """dc AS (SELECT d.doc_id AS sample, concat_ws(',', CASE WHEN n_chars IS NULL THEN 'not_in_min_coverage' WHEN n_chars < 40 THEN 'below_min_coverage' END, CASE WHEN lang IS NULL THEN 'relatedness:not_in_table' WHEN lang = 'und' THEN 'relatedness:undetermined' END) AS reasons,
concat_ws(',', CASE WHEN l.f IS NULL THEN 'donor_content:not_in_table' WHEN l.f = 1 THEN 'donor_content:flagged' END) AS notes FROM documents d LEFT JOIN (SELECT doc_id, max(flagged) AS f FROM labels GROUP BY doc_id) l USING (doc_id))"""

ORACLES = {
    "cycle_counts": f"""WITH {_READS}, c AS (SELECT sample, mate, bin, count(*) AS n, count_if(base = ref) AS n_ref, count_if(base = alt) AS n_alt FROM rh GROUP BY ALL UNION ALL SELECT NULL, mate, bin, count(*), count_if(base = ref), count_if(base = alt) FROM rh GROUP BY ALL),
 g AS (SELECT sample, m.mate, b.bin FROM (SELECT DISTINCT sample FROM rd UNION ALL SELECT NULL) s CROSS JOIN (VALUES (1), (2)) m(mate) CROSS JOIN (SELECT unnest(range(0, 8)) AS bin) b)
 SELECT g.sample, CAST(g.mate AS INT) AS mate, CAST(g.bin AS INT) AS bin, coalesce(n, 0) AS n, coalesce(n_ref, 0) AS n_ref, coalesce(n_alt, 0) AS n_alt, coalesce(n - n_ref - n_alt, 0) AS n_other FROM g LEFT JOIN c ON g.sample IS NOT DISTINCT FROM c.sample AND g.mate = c.mate AND g.bin = c.bin""",
    "allele_pileup": f"WITH {_READS} SELECT sample, rname, site AS pos, CAST(count_if(base = ref) AS INT) AS ref_n, CAST(count_if(base = alt) AS INT) AS alt_n FROM rh WHERE pos % 50 + 15 >= 20 GROUP BY ALL",
    "interval_merge": f"WITH {_RANGES_SQL}" + _MERGE_SQL.format(src="ranges"),
    "region_clip": f'WITH {_RANGES_SQL}, cl AS (SELECT chrom, greatest(start, 400) AS start, least("end", 1200) AS "end" FROM ranges WHERE greatest(start, 400) < least("end", 1200))' + _MERGE_SQL.format(src="cl"),
    "range_semi_join": f"WITH {_RANGES_SQL}, p AS (SELECT o_orderkey, (o_custkey - 1) // 15 + 1 AS chrom, date_diff('day', DATE '{_DAY0}', CAST(o_orderdate AS DATE)) AS pos FROM orders), mg AS ({_MERGE_SQL.format(src='ranges')}) SELECT p.chrom, count(*) AS n FROM p WHERE EXISTS (SELECT 1 FROM mg r WHERE r.chrom = p.chrom AND p.pos >= r.start AND p.pos < r.\"end\") GROUP BY p.chrom",
    "segment_state_asof": f'WITH {SEGMENTS_SQL}, {_PTS} SELECT l_orderkey, l_linenumber, CASE WHEN s."end" >= p.pos THEN s.state END AS x FROM pts p ASOF LEFT JOIN segments s ON p.line = s.line AND p.pos >= s.start',
    "breakpoints": f"WITH {SEGMENTS_SQL}, {_BP} SELECT line, CAST(breakpoint AS DOUBLE) AS breakpoint FROM bp",
    "breakpoint_density": f"""WITH {SEGMENTS_SQL}, {_BP}, mk AS (SELECT p_partkey % 2411 AS pos FROM part WHERE p_size % 5 = 0), gp AS (SELECT p_partkey % 2411 AS pos, p_size % 5 = 4 AS two FROM part WHERE p_size % 5 > 1),
gi AS (SELECT pos, two, (SELECT count(*) FROM mk WHERE mk.pos < gp.pos) AS i FROM gp), bi AS (SELECT DISTINCT line, (SELECT count(*) FROM mk WHERE mk.pos < bp.breakpoint) AS b FROM bp),
ln AS (SELECT DISTINCT line FROM segments), fl AS (SELECT ln.line, gi.two, EXISTS (SELECT 1 FROM bi WHERE bi.line = ln.line AND abs(bi.b - gi.i) <= 2) AS near FROM ln CROSS JOIN gi),
nb AS (SELECT line, count(*) AS n FROM bp GROUP BY line), pl AS (SELECT ln.line, coalesce(min(nb.n), 0) AS n_breakpoints, count_if(near) AS near, count_if(near AND two) AS near_2, count_if(NOT near) AS far, count_if(NOT near AND two) AS far_2 FROM ln LEFT JOIN fl USING (line) LEFT JOIN nb USING (line) GROUP BY ln.line),
bt AS (SELECT * FROM pl UNION ALL SELECT NULL, sum(n_breakpoints), sum(near), sum(near_2), sum(far), sum(far_2) FROM pl)
SELECT line, CAST(n_breakpoints AS BIGINT) AS n_breakpoints, CAST(near AS BIGINT) AS near, CAST(near_2 AS BIGINT) AS near_2, CAST(far AS BIGINT) AS far, CAST(far_2 AS BIGINT) AS far_2, round(near_2 / nullif(near, 0), 6) AS share_near, round(far_2 / nullif(far, 0), 6) AS share_far FROM bt""",
    "raster_long": _RASTER + " SELECT site, line, CAST(x AS INT) AS x, CAST(gt AS INT) AS gt, CAST(dosage AS DOUBLE) AS dosage FROM cells",
    "raster_matrix": _RASTER + " SELECT site, " + ", ".join(f"CAST(max(gt) FILTER (line = {i}) AS INT) AS line_{i}" for i in range(_LINES)) + " FROM cells GROUP BY site",
    "line_summary_total": f"""WITH {SEGMENTS_SQL}, pl AS (SELECT line, line % 7 = 0 AS excluded, sum(CASE WHEN state = 0 THEN "end" - start + 1 ELSE 0 END) AS x0, sum(CASE WHEN state = 1 THEN "end" - start + 1 ELSE 0 END) AS x1, sum(CASE WHEN state = 2 THEN "end" - start + 1 ELSE 0 END) AS x2 FROM segments GROUP BY line),
bt AS (SELECT * FROM pl UNION ALL SELECT NULL, false, sum(x0), sum(x1), sum(x2) FROM pl WHERE NOT excluded)
SELECT line, excluded, CAST(x0 AS BIGINT) AS length_x0, CAST(x1 AS BIGINT) AS length_x1, CAST(x2 AS BIGINT) AS length_x2, CAST(x0 + x1 + x2 AS BIGINT) AS called, round(x0 / nullif(x0 + x1 + x2, 0), 6) AS share_x0, round(x1 / nullif(x0 + x1 + x2, 0), 6) AS share_x1, round(x2 / nullif(x0 + x1 + x2, 0), 6) AS share_x2 FROM bt""",
    "single_locus_chi2": _RASTER + f", sl AS (SELECT site, coalesce(count_if(x = 0), 0) AS n0, coalesce(count_if(x = 1), 0) AS n1, coalesce(count_if(x = 2), 0) AS n2, count(x) AS n, sum(gt) AS gs, count(gt) AS gn FROM cells GROUP BY site), sc AS (SELECT *, CASE WHEN n > 0 THEN {_CHI} END AS chi2 FROM sl) SELECT site, n0 AS n_x0, n1 AS n_x1, n2 AS n_x2, n AS n_lines, round((n1 + 2 * n2) / nullif(2 * n, 0), 6) AS donor_freq, round(gs / nullif(2 * gn, 0), 6) AS allele_freq_gt, round(n1 / nullif(n, 0), 6) AS het_freq, round(chi2, 6) AS chi2, round(exp(-chi2 / 2), 6) AS p_chi2 FROM sc",
    "painting_rectangles": f"WITH {SEGMENTS_SQL} SELECT line, start, \"end\", CAST(state AS VARCHAR) AS fill FROM segments WHERE line % 7 <> 0 UNION ALL SELECT DISTINCT line, (SELECT min(start) FROM segments), (SELECT max(\"end\") FROM segments), 'excluded' FROM segments WHERE line % 7 = 0",
    "coverage_dense": f"""WITH {PANEL_SQL}, st AS (SELECT contig, pos FROM panel GROUP BY ALL HAVING sum(alt) > 0 AND sum(alt) < sum(reads)), sc AS (SELECT contig, count(*) AS sites FROM st GROUP BY contig),
gt AS (SELECT sample, contig, count(*) AS covered, sum(reads) AS reads FROM panel SEMI JOIN st USING (contig, pos) WHERE reads > 0 GROUP BY ALL), g AS (SELECT s.sample, sc.contig, sites, coalesce(covered, 0) AS covered, coalesce(reads, 0) AS reads FROM (SELECT DISTINCT sample FROM panel) s CROSS JOIN sc LEFT JOIN gt ON gt.sample = s.sample AND gt.contig = sc.contig)
SELECT sample, contig, sites, covered, CAST(reads AS BIGINT) AS reads, round(covered / sites, 6) AS fraction, round(reads / sites, 6) AS mean_depth, 1 AS counted, CAST(covered < 8 AS INT) AS below_min_markers, CAST(covered < 2 AS INT) AS below_2, CAST(covered < 5 AS INT) AS below_5 FROM g""",
    "min_coverage": "SELECT c_custkey AS sample, mc AS mean_coverage, CAST(reason = '.' AS INT) AS pass, reason FROM (SELECT *, CASE WHEN c_custkey % 7 = 0 THEN 'no_metrics' WHEN mc IS NULL THEN 'no_mean_coverage' WHEN mc < 1000 THEN 'below_min_coverage' ELSE '.' END AS reason FROM (SELECT c_custkey, CASE WHEN c_custkey % 7 <> 0 AND c_custkey % 11 <> 0 THEN c_acctbal END AS mc FROM customer))",
    "donor_content": f"""WITH {PANEL_SQL}, t AS (SELECT sample, role, donor, count(*) AS covered, count_if(alt > 0) AS with_alt, sum(reads) AS reads, sum(alt) AS alt_reads FROM panel GROUP BY ALL),
s AS (SELECT *, with_alt / covered AS share, alt_reads / reads AS arf, CASE role WHEN 'line' THEN 0.125 WHEN 'bc1_sample' THEN 0.25 ELSE 0.0 END AS expected FROM t), m AS (SELECT *, arf / nullif(median(CASE WHEN covered >= 20 THEN arf END) OVER (PARTITION BY donor, role), 0) AS rel FROM s),
f AS (SELECT *, concat_ws(',', CASE WHEN covered < 20 THEN 'insufficient_sites' END, CASE WHEN covered >= 20 AND role = 'control' AND arf > 0.45 THEN 'donor_alleles_in_control' END, CASE WHEN covered >= 20 AND role <> 'control' AND arf < 0.42 THEN 'low_donor_content' END, CASE WHEN covered >= 20 AND role <> 'control' AND rel < 0.9 THEN 'low_relative_to_group' END) AS reasons FROM m)
SELECT sample, role, donor, covered, with_alt, CAST(reads AS BIGINT) AS reads, CAST(alt_reads AS BIGINT) AS alt_reads, round(share, 6) AS share_sites_alt, round(arf, 6) AS alt_read_fraction, CAST(expected AS DOUBLE) AS expected, round(arf / nullif(expected, 0), 6) AS ratio_to_expected, round(rel, 6) AS rel_to_group, reasons, CAST(reasons NOT IN ('', 'insufficient_sites') AS INT) AS flag FROM f""",
    "kinship_group": _CENTRED + " SELECT sample, grp AS \"group\", round(kinship, 6) AS kinship, n_sites FROM kin",
    "kinship_flags": _FLAGS + " SELECT sample, round(kinship_own, 6) AS kinship_own, round(own_z, 6) AS own_z, round(kinship_other, 6) AS kinship_other, n_sites_own, closest_other, reasons, CAST(reasons NOT IN ('', 'insufficient_sites') AS INT) AS flag FROM b5",
    "pseudohaploid_draw": f"WITH {PANEL_SQL} SELECT sample, contig, pos, round(CASE WHEN role = 'line' THEN CASE WHEN CAST(('0x' || substr(md5(concat_ws(':', '1', contig, CAST(pos AS VARCHAR), CAST(sample AS VARCHAR))), 1, 8)) AS UBIGINT) / 4294967296.0 < alt / reads THEN 1.0 ELSE 0.0 END ELSE alt / reads END, 9) AS v FROM panel WHERE reads > 0",
    "line_marker_qc": f"WITH {_LQ} SELECT line, contig, markers, markers_kept, covered, CAST(reads AS BIGINT) AS reads, rigidity, floor, round(mean_depth, 6) AS mean_depth, CAST(contig_pass AS INT) AS contig_pass, CAST(line_pass AS INT) AS line_pass, CASE WHEN contig_pass THEN '.' ELSE 'below_marker_floor' END AS reason FROM lp",
    "line_observations": f"WITH {_LQ} SELECT h.sample AS line, h.contig, count(*) AS n, CAST(sum(reads - alt) AS BIGINT) AS ref, CAST(sum(alt) AS BIGINT) AS alt, max(h.pos) AS last FROM hr h SEMI JOIN kp ON kp.contig = h.contig AND kp.pos = h.pos WHERE reads > 0 AND h.sample IN (SELECT line FROM lp WHERE line_pass) GROUP BY h.sample, h.contig",
    "kinship_self": _CENTRED + " SELECT sample, round(sum(z * z) / sum(w), 6) AS kinship_self, count(*) AS n_sites FROM z GROUP BY sample",
    "genotype_summary": _RASTER + """, pl AS (SELECT line, sum(CASE WHEN state = 0 THEN "end" - start + 1 ELSE 0 END) AS x0, sum(CASE WHEN state = 1 THEN "end" - start + 1 ELSE 0 END) AS x1, sum(CASE WHEN state = 2 THEN "end" - start + 1 ELSE 0 END) AS x2 FROM segments GROUP BY line),
 pg AS (SELECT line, coalesce(count_if(gt = 0), 0) AS g0, coalesce(count_if(gt = 1), 0) AS g1, coalesce(count_if(gt = 2), 0) AS g2, count_if(gt IS NULL) AS na FROM cells GROUP BY line), pj AS (SELECT pl.*, pg.* EXCLUDE (line), pl.line IN (3, 7) AS excluded FROM pl JOIN pg ON pl.line = pg.line),
 bt AS (SELECT line, excluded, x0, x1, x2, g0, g1, g2, na FROM pj UNION ALL SELECT NULL, false, sum(x0), sum(x1), sum(x2), sum(g0), sum(g1), sum(g2), sum(na) FROM pj WHERE NOT excluded)
 SELECT line, excluded, CAST(x0 AS BIGINT) AS length_x0, CAST(x1 AS BIGINT) AS length_x1, CAST(x2 AS BIGINT) AS length_x2, CAST(g0 + g1 + g2 + na AS BIGINT) AS sites, CAST(g0 AS BIGINT) AS sites_gt0, CAST(g1 AS BIGINT) AS sites_gt1, CAST(g2 AS BIGINT) AS sites_gt2, CAST(na AS BIGINT) AS sites_na, round(na / nullif(g0 + g1 + g2 + na, 0), 6) AS no_call_share FROM bt""",
    "sample_decision": f"WITH {_DEC} SELECT sample, CAST(reasons = '' AS INT) AS pass, reasons, notes, 'partial' AS state FROM dc",
    "exclusions": f"WITH {_LQ}, {_DEC} SELECT sample, 'sample_qc' AS stage, reasons AS reason FROM dc WHERE reasons <> '' UNION ALL SELECT line, 'line_qc', CASE WHEN bool_and(contig_pass) THEN 'line_qc' ELSE 'below_marker_floor' END FROM lp GROUP BY line HAVING NOT bool_and(line_pass)",
    "label_resolution": "WITH b AS (SELECT CAST(p_partkey AS VARCHAR) AS sample, CASE WHEN p_partkey % 5 = 0 THEN CAST(p_partkey AS VARCHAR) WHEN p_size % 3 = 0 AND p_name <> '' THEN p_name WHEN p_size % 2 = 0 AND p_brand <> '' THEN p_brand ELSE CAST(p_partkey AS VARCHAR) END AS base, CASE WHEN p_partkey % 5 = 0 THEN 'sample_id_not_in_registry' WHEN p_size % 3 = 0 AND p_name <> '' THEN 'nil_id' WHEN p_size % 2 = 0 AND p_brand <> '' THEN 'pedigree' ELSE 'sample_id_no_label' END AS label_source FROM part) SELECT sample, CASE WHEN count(*) OVER (PARTITION BY base) > 1 THEN base || '_' || sample ELSE base END AS label, label_source, count(*) OVER (PARTITION BY base) AS collision FROM b",
    "robust_zscore": "SELECT c_custkey, round((c_acctbal - m) / (1.4826 * nullif(median(abs(c_acctbal - m)) OVER (PARTITION BY c_mktsegment), 0)), 6) AS robust_z FROM (SELECT *, median(c_acctbal) OVER (PARTITION BY c_mktsegment) AS m FROM customer)",
    "barcode_demux": "WITH c AS (SELECT DISTINCT barcode FROM bc1_well_map WHERE barcode IS NOT NULL), r AS (SELECT DISTINCT sample_id, library_index AS s FROM registry_test WHERE library_index IS NOT NULL) SELECT 's_' || barcode AS sample, count(*) AS n, min(substr(s, length(barcode) + 2)) AS least_rest FROM r JOIN c ON starts_with(s, barcode) GROUP BY barcode",
    "base_composition": "SELECT source, i AS position, substr(library_index, i, 1) AS base, count(*) AS n FROM (SELECT source, library_index, CAST(unnest(range(1, 11)) AS INT) AS i FROM registry_test WHERE library_index IS NOT NULL) WHERE i <= length(library_index) GROUP BY ALL",
    "duplicate_policy": "SELECT user_id, event_type, max(event_id) AS event_id, arg_max(value, event_id) AS value, 'last' AS policy FROM events GROUP BY user_id, event_type UNION ALL SELECT user_id, event_type, min(event_id), arg_min(value, event_id), 'first' FROM events GROUP BY user_id, event_type",
    "mask_qualities": "SELECT o_orderkey, CASE WHEN o_orderkey % 11 = 0 THEN q WHEN o_orderkey % 2 = 0 THEN substr(q, 1, length(q) - n) || repeat('!', n) ELSE repeat('!', n) || substr(q, n + 1) END AS masked FROM (SELECT o_orderkey, o_orderpriority AS q, least(CASE WHEN o_orderkey % 3 = 0 THEN 5 ELSE 3 END, length(o_orderpriority)) AS n FROM orders)",
    "settings_diff": "SELECT coalesce(a.name, b.name) AS name, a.value AS stored, b.value AS \"current\" FROM (SELECT CAST(n_nationkey AS VARCHAR) AS name, CAST(n_regionkey AS VARCHAR) AS value FROM nation) a FULL JOIN (SELECT CAST(r_regionkey AS VARCHAR) AS name, CAST(r_regionkey AS VARCHAR) AS value FROM region) b ON a.name = b.name WHERE a.value IS DISTINCT FROM b.value",
    "guard_violations": "SELECT 'duplicate' AS guard, o_custkey AS key FROM orders GROUP BY o_custkey HAVING count(*) > 20 UNION ALL SELECT DISTINCT 'missing', o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_acctbal > 0) UNION ALL SELECT 'inconsistent', o_custkey FROM orders GROUP BY o_custkey HAVING count(DISTINCT o_orderstatus) > 1",
    "channel_join_remainder": "SELECT coalesce(o.k, c.k) AS k, coalesce(n_orders, 0) AS n_orders, coalesce(c_mktsegment, 'none') AS segment FROM (SELECT o_custkey AS k, count(*) AS n_orders FROM orders WHERE o_custkey % 3 <> 0 GROUP BY o_custkey) o FULL JOIN (SELECT c_custkey AS k, c_mktsegment FROM customer WHERE c_custkey % 2 = 0) c ON o.k = c.k",
    "nested_json_counts": "SELECT event_type, CAST(sum(k) AS BIGINT) AS total, CAST(sum(k + 1) AS BIGINT) AS input, count(*) AS n FROM (SELECT event_type, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY event_type",
    "family_regression_lod": "SELECT p_brand, regr_count(y, x) AS n, round(regr_sxy(y, x) / nullif(regr_sxx(y, x), 0), 4) AS slope, round(regr_count(y, x) / 2.0 * log10(regr_syy(y, x) / (regr_syy(y, x) - regr_sxy(y, x) * regr_sxy(y, x) / regr_sxx(y, x))), 4) AS lod FROM (SELECT p_brand, l_quantity AS x, l_extendedprice AS y FROM lineitem JOIN part ON p_partkey = l_partkey) GROUP BY p_brand",
}
