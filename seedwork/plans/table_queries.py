"""Queries of text readers, guards, labels, dataflow steps and reports over the driver's tables, with their SQL twins.

Readers work on lines with file and place. Here the lines are written from a table, so the twin can tell what they hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwork.operators import intervals, labels, pooled, qc, reads, report
from seedwork.plans.bindings import ASSAY_SQL, SEGMENTS_SQL, assay, segments
from seedwork.plans.cohort_queries import _READS, _alignments
from seedwork.session import table
from seedwork.sources import readers, sinks
from seedwork.streaming import groups


def _lines(df: DataFrame, line: Column, place: str, head: tuple[str, ...] = (), file: str = "f") -> DataFrame:
    """(file, at, line): header lines first, then one line a row, in the order of ``place``."""
    at = lambda n: F.struct(F.lit(0).cast("long").alias("split"), n.cast("long").alias("n")).alias("at")
    body = df.select(F.lit(file).alias("file"), at(F.col(place)), line.alias("line"))
    top = df.sparkSession.createDataFrame([(i - len(head), x) for i, x in enumerate(head)], "i long, x string")
    return top.select(F.lit(file).alias("file"), at(F.col("i")), F.col("x").alias("line")).unionByName(body)


def _tab(*parts) -> Column:
    return F.concat_ws("\t", *[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def _r(*names: str, to: int = 6) -> list:
    return [F.round(n, to).alias(n) for n in names]


# --- readers -------------------------------------------------------------------------------------------------------


def _wide(spark: SparkSession, sf: str) -> DataFrame:
    """One allele-depth line per part and line status: two samples, a dot where a sample has no row."""
    li = table(spark, sf, "lineitem").groupBy("l_partkey", "l_linestatus").agg(*[F.count_if((F.col("l_linenumber") % 2 == s) & (F.col("l_tax") < 0.04)).alias(f"r{s}") for s in (0, 1)], *[F.count_if((F.col("l_linenumber") % 2 == s) & (F.col("l_tax") >= 0.04)).alias(f"a{s}") for s in (0, 1)])
    cell = lambda s: F.when(F.col(f"r{s}") + F.col(f"a{s}") > 0, F.concat_ws(",", F.col(f"r{s}").cast("string"), F.col(f"a{s}").cast("string"))).otherwise(".")
    held = li.withColumn("place", F.col("l_partkey") * 2 + F.when(F.col("l_linestatus") == "F", 0).otherwise(1))
    ref = F.when(F.col("l_partkey") % 17 == 0, "AT").otherwise("A")
    return _lines(held, _tab("chr1", F.col("l_partkey"), ref, F.when(F.col("l_linestatus") == "F", "C").otherwise("C,G"), cell(0), cell(1)), "place", ("# [1]CHROM\t[2]POS\t[3]REF\t[4]ALT\t[5]s0:AD\t[6]s1:AD",))


def read_allele_counts(spark: SparkSession, sf: str) -> DataFrame:
    got = readers.allele_counts(_wide(spark, sf))
    return got.select("sample", "pos", "ref", F.array_join("alts", ",").alias("alts"), F.array_join(F.transform("ad", lambda x: x.cast("string")), ",").alias("ad"))


def read_line_counts(spark: SparkSession, sf: str) -> DataFrame:
    """The flavour for lines: REF of one base only, the first of repeated rows, no depths where a cell is empty."""
    got = readers.allele_counts(_wide(spark, sf), "first", single_base_ref=True, empty_as_zero=False)
    return got.select("sample", "pos", F.array_join(F.transform("ad", lambda x: x.cast("string")), ",").alias("ad"))


def _panel(spark: SparkSession, sf: str) -> DataFrame:
    part = table(spark, sf, "part")
    return part.where(F.col("p_size") % 3 != 0).select(F.lit("chr1").alias("chrom"), F.col("p_partkey").alias("pos"), F.when(F.col("p_size") % 5 == 0, "g").otherwise("a").alias("ref"), F.when(F.col("p_size") % 2 == 0, "c").alias("alt"))


def read_panel_counts(spark: SparkSession, sf: str) -> DataFrame:
    return readers.panel_counts(readers.allele_counts(_wide(spark, sf)), _panel(spark, sf)).select("sample", "pos", "ref_n", "alt_n")


def read_marker_counts(spark: SparkSession, sf: str) -> DataFrame:
    """What a reader of markers leaves out, by reason, and how many cells it keeps."""
    good, left = readers.marker_counts(readers.allele_rows(_wide(spark, sf)), _panel(spark, sf).fillna("C", ["alt"]))
    kept = good.agg(F.lit("kept").alias("reason"), F.count(F.lit(1)).alias("n"))
    return left.unionByName(kept)


def read_pooled_calls(spark: SparkSession, sf: str) -> DataFrame:
    """VCF text of the assay's pools: strand depths, indels and records without depths among them."""
    pools = assay(spark, sf).withColumn("fwd", F.expr("a div 2")).groupBy("site").agg(*[F.max(F.when(F.col("pool") == p, F.struct("n", "a", "fwd"))).alias(f"p{p}") for p in range(3)])
    cell = lambda p: F.when(F.col(f"p{p}").isNull(), ".").otherwise(F.concat(F.lit("0/1:"), F.col(f"p{p}.n") - F.col(f"p{p}.a"), F.lit(","), F.col(f"p{p}.fwd"), F.lit(":0,"), F.col(f"p{p}.a") - F.col(f"p{p}.fwd")))
    alt = F.when(F.col("site") % 13 == 0, "CT").otherwise("C")
    fmt = F.when(F.col("site") % 19 == 0, "GT").otherwise("GT:ADf:ADr")
    lines = _lines(pools, _tab("chr1", F.col("site"), ".", "A", alt, ".", ".", ".", fmt, cell(0), cell(1), cell(2)), "site", ("##fileformat=VCFv4.2", "#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tp0\tp1\tp2"))
    calls, skipped = readers.pooled_calls(lines)
    rows = calls.select(F.concat(F.lit("call:"), "pool").alias("what"), "pos", "n", "a")
    return rows.unionByName(skipped.select(F.concat(F.lit("skipped:"), "reason").alias("what"), F.lit(None).cast("long").alias("pos"), "n", F.lit(None).cast("long").alias("a")))


def read_sites(spark: SparkSession, sf: str) -> DataFrame:
    """A site list with a header, short lines and repeats."""
    li = table(spark, sf, "lineitem")
    line = F.when(F.col("l_quantity") < 3, _tab("chr1", F.col("l_partkey"))).otherwise(_tab("chr1", F.col("l_partkey"), "A", F.col("l_returnflag")))
    return readers.site_list(_lines(li, line, "l_orderkey", ("chrom\tpos\tref\talt",)))


def _step4(spark: SparkSession, sf: str) -> DataFrame:
    li = table(spark, sf, "lineitem").select("l_partkey", "l_suppkey", "l_orderkey", "l_linenumber")
    tier = F.element_at(F.array(*map(F.lit, ("A", "B", "ref", "-"))), (F.col("l_suppkey") % 4 + 1).cast("int"))
    ref = F.when(F.col("l_partkey") % 23 == 0, "AG").otherwise("A")
    odds = F.round(F.col("l_suppkey") / 7.0, 3)
    body = _tab("chr1", F.col("l_partkey"), ref, "C", F.col("l_suppkey"), F.col("l_linenumber"), tier, F.when(F.col("l_orderkey") % 3 == 0, "hidepth,single_sample").otherwise("."), F.format_string("%.2f", odds.cast("double")), odds)
    return _lines(li, body, "l_orderkey", ("chrom\tpos\tref\talt\tn\ta\ttier\tflags\tLLR\tlogodds",))


def read_step4(spark: SparkSession, sf: str) -> DataFrame:
    """Scored sites of a region, by tier."""
    return readers.step4_table(_step4(spark, sf), ("chr1", 50, 150)).groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.min("pos").alias("first"), F.max("pos").alias("last"))


def read_joint(spark: SparkSession, sf: str) -> DataFrame:
    """Joint scoring text with likelihood ratios at full precision, by tier."""
    got = readers.joint_table(_step4(spark, sf))
    return got.groupBy("tier").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("llr"), 4).alias("llr"), F.count_if(F.array_contains("flags", "hidepth")).alias("hidepth"), F.sum("a").alias("a"))


def read_segments(spark: SparkSession, sf: str) -> DataFrame:
    """Segments as quoted CSV with decimal ends and spelt-out chromosomes."""
    segs = segments(spark, sf)
    q = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    line = F.concat_ws(",", q(F.concat(F.lit("L"), F.col("line").cast("string"))), q(F.lit("CHR7")), F.concat(F.col("start").cast("string"), F.lit(".0")), F.col("end").cast("string"), F.col("state").cast("string"))
    return readers.segment_table(_lines(segs, line, "start", ('"name","chr","start_bp","end_bp","state"',)))


def read_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """BED text of lineitem's ranges, merged after reading, with track and comment lines."""
    li = table(spark, sf, "lineitem").select("l_orderkey", "l_suppkey", F.date_diff("l_shipdate", F.lit("1990-01-01").cast("date")).alias("s"), F.ceil(F.col("l_quantity") / 25).cast("long").alias("w"))
    got = readers.bed(_lines(li, _tab(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")), F.col("s"), F.col("s") + F.col("w"), "x"), "l_orderkey", ("track name=x", "browser position", "# note", "")))
    return intervals.one_based(intervals.merge_intervals(got, ["chrom"])).select("chrom", "start", "end", "region")


def read_alignments(spark: SparkSession, sf: str) -> DataFrame:
    """SAM text of the reads of lineitem; records and bases by chromosome and flag."""
    a = _alignments(spark, sf)
    line = _tab("q", F.col("flag"), F.col("rname"), F.col("pos"), "60", F.col("cigar"), "*", "0", "0", F.col("seq"), F.col("qual"))
    got = readers.alignments(_lines(a, line, "pos", ("@HD\tVN:1.6", "@SQ\tSN:chr1")))
    return got.groupBy("rname", "flag").agg(F.count(F.lit(1)).alias("n"), F.sum(F.length("seq")).alias("bases"), F.sum("pos").alias("pos"))


def read_fastq(spark: SparkSession, sf: str) -> DataFrame:
    """FASTQ text with one read a part in two files, the first 300 reads of each; composition of their first bases."""
    part = table(spark, sf, "part").select(F.col("p_partkey").alias("k"), F.translate(F.md5(F.col("p_partkey").cast("string")), "0123456789abcdef", "ACGTACGTACGTACGT").alias("s"))
    four = F.posexplode(F.array(F.concat(F.lit("@"), F.col("k").cast("string")), F.col("s"), F.lit("+"), F.repeat(F.lit("I"), 32))).alias("i", "x")
    out = None
    for file in (0, 1):
        one = part.where(F.col("k") % 2 == file).select("k", four).withColumn("place", F.col("k") * 4 + F.col("i"))
        held = _lines(one, F.col("x"), "place", file=f"f{file}")
        out = held if out is None else out.unionByName(held)
    return reads.base_composition(readers.fastq(out, 300), ["file"], "seq", 3)


def read_index(spark: SparkSession, sf: str) -> DataFrame:
    """A FASTA index of suppliers' names, joined with regions: those that the index or the ranges do not allow."""
    supp = table(spark, sf, "supplier")
    index = readers.fasta_index(_lines(supp, _tab(F.concat(F.lit("s"), F.col("s_suppkey").cast("string")), F.col("s_suppkey") * 100, "6", "60", "61"), "s_suppkey"))
    asked = table(spark, sf, "customer").select(F.concat(F.lit("s"), (F.col("c_custkey") % 150).cast("string"), F.lit(":"), (F.col("c_custkey") % 7).cast("string"), F.lit("-"), F.format_number(F.col("c_custkey") * 3, 0)).alias("text")).distinct()
    wanted = asked.select(readers.regions(F.col("text")).alias("r")).select("r.*")
    ranges = table(spark, sf, "lineitem").select(F.concat(F.lit("s"), F.col("l_suppkey").cast("string")).alias("chrom")).where(F.col("l_suppkey") % 9 != 0)
    return labels.bad_regions(wanted, ranges, index)


def read_raw_lists(spark: SparkSession, sf: str) -> DataFrame:
    """Members of archives in raw_r1 of the registry, those without quotes and with one kind of separator."""
    rows = table(spark, sf, "registry_test").where(F.col("raw_r1").rlike(r"\A[^'\"|,\s]+\z")).select("sample_id", "raw_r1").distinct()
    got = rows.select("sample_id", F.inline(readers.tar_members(F.col("raw_r1"))))
    return got.groupBy("archive").agg(F.count(F.lit(1)).alias("n"), F.max("position").alias("most"), F.min("member").alias("first"))


# --- pools, markers, demultiplexing, masks ------------------------------------------------------------------------


def witness_summary(spark: SparkSession, sf: str) -> DataFrame:
    a = assay(spark, sf)
    kept = pooled.kept_calls(a, ("site",), F.col("pool") == 1).agg(F.count(F.lit(1)).alias("kept_rows"))
    return pooled.witness_summary(a, ("site",), F.col("pool") == 1).crossJoin(kept).select("min_alt_reads", "records_in", "kept", "dropped", *_r("kept_share"), "kept_rows")  # two single rows


def witness_pool(spark: SparkSession, sf: str) -> DataFrame:
    """The control's three pools put together as one witness."""
    return pooled.merge_pools(assay(spark, sf), ("site",), F.col("donor") == 3).select("site", "n", "a", "n_pools")


def marker_counters(spark: SparkSession, sf: str) -> DataFrame:
    """Drop counters of marker selection over rows of lineitem as scored sites."""
    li = table(spark, sf, "lineitem")
    alt = F.element_at(F.array(*map(F.lit, ("C", "c", "G", "AT", "N"))), (F.col("l_suppkey") % 5 + 1).cast("int"))
    flags = F.when(F.col("l_linenumber") == 2, F.array(F.lit("inconsistent"))).when(F.col("l_linenumber") == 3, F.array(F.lit("no_zero_class"))).otherwise(F.array().cast("array<string>"))
    rows = li.select(F.lit("c").alias("chrom"), (F.col("l_partkey") * 40 + F.col("l_linenumber") * 4 + F.col("l_suppkey") % 4).alias("pos"), F.when(F.col("l_suppkey") % 11 == 0, "C").otherwise("A").alias("ref"), alt.alias("alt"), F.when(F.col("l_returnflag") == "N", "A").otherwise("B").alias("tier"), flags.alias("flags"))
    return pooled.marker_counters(rows)


def _reports(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """Lane reports of libraries and their barcode tables, from orders and customers."""
    o = table(spark, sf, "orders")
    lane = o.groupBy((F.col("o_custkey") % 20).cast("string").alias("library"), F.month("o_orderdate").alias("lane"), (F.col("o_custkey") % 60).cast("string").alias("name")).agg(F.count(F.lit(1)).alias("total_matches"))
    reports = lane.groupBy("library", "lane").agg((F.sum("total_matches") + 3).alias("input"), F.collect_list(F.struct("name", "total_matches")).alias("adapters")).drop("lane")
    barcodes = table(spark, sf, "customer").select((F.col("c_custkey") % 20).cast("string").alias("library"), (F.col("c_custkey") % 80).cast("string").alias("sample"))
    return reports, barcodes


def demux_summary(spark: SparkSession, sf: str) -> DataFrame:
    got = reads.demux_summary(*_reports(spark, sf))
    return got.select("library", "input_pairs", "assigned_pairs", "unassigned_pairs", *_r("assignment_rate"), "n_samples", F.array_join("samples_zero_pairs", ",").alias("samples_zero_pairs"), "n_lanes")


def demux_samples(spark: SparkSession, sf: str) -> DataFrame:
    return reads.demux_samples(*_reports(spark, sf)).select("library", "sample", "reads", *_r("share_of_input"))


def unknown_adapters(spark: SparkSession, sf: str) -> DataFrame:
    reports, barcodes = _reports(spark, sf)
    return reads.unknown_adapters(reports, barcodes.where(F.col("sample").cast("int") > 10))


def literal_share(spark: SparkSession, sf: str) -> DataFrame:
    return reads.literal_share(_alignments(spark, sf), ["sample"], "seq", "ACG").select("sample", "reads_checked", *_r("literal_share"))


def mask_log(spark: SparkSession, sf: str) -> DataFrame:
    return reads.mask_log(_alignments(spark, sf), ["sample"], F.lit(3), F.lit(5))


# --- labels, metadata, guards --------------------------------------------------------------------------------------


def _registry(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "registry_test").distinct()


def pedigree_ids(spark: SparkSession, sf: str) -> DataFrame:
    """Accession, donor and short id of every pedigree of the registry, and of spelt-out pedigrees of parts."""
    made = table(spark, sf, "part").select(F.concat(F.lit("Zx."), F.format_string("%04d", F.col("p_partkey")), F.lit("_P"), F.col("p_size"), F.lit("_P2_Q"), F.col("p_partkey") % 40, F.lit("."), F.col("p_size") % 37, F.when(F.col("p_size") % 3 == 0, ".1.2").otherwise(".1.1"), F.when(F.col("p_size") % 4 == 0, "-blk").otherwise("")).alias("pedigree"))
    rows = _registry(spark, sf).select("pedigree").unionByName(made).distinct()
    return rows.select("pedigree", labels.pedigree_parts(F.col("pedigree")).alias("p")).select("pedigree", "p.accession", "p.donor", "p.code")


def corrected_pedigrees(spark: SparkSession, sf: str) -> DataFrame:
    """Registry with corrections that are made up from its own rows: every fifth sample, some with a wrong old value."""
    rows = _registry(spark, sf).select("sample_id", "pedigree")
    k = F.conv(F.substring(F.md5("sample_id"), 1, 4), 16, 10).cast("int")
    fixes = rows.where(k % 5 == 0).select(F.concat(F.lit("C"), F.lpad((k % 10000).cast("string"), 4, "0")).alias("correction_id"), "sample_id", F.lit("pedigree").alias("field"), F.when(k % 2 == 0, "resolved").otherwise("raw").alias("applies_to"), F.when(k % 3 == 0, "other").otherwise(F.col("pedigree")).alias("old_value"), F.concat(F.lit("new:"), "sample_id").alias("new_value"))
    good, odd = labels.correct(rows, fixes, "sample_id", "pedigree")
    return good.join(odd.select("sample_id", F.lit(1).alias("odd")), "sample_id", "left").select("sample_id", "pedigree_resolved", F.col("correction_ids").alias("ids"), F.coalesce("odd", F.lit(0)).alias("odd"))


def library_disagreements(spark: SparkSession, sf: str) -> DataFrame:
    return labels.disagreements(_registry(spark, sf), "library", ("source", "barcode_layout", "raw_location", "plate", "taxon"))


def label_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Labels of the samples of the registry and of the copy's samples, by source."""
    reg = _registry(spark, sf).select(F.col("sample_id").alias("sample"), "nil_id", "pedigree", "donor", F.lit("FALSE").alias("exclude"))
    named = reg.where(~F.coalesce(F.concat_ws("|", "nil_id", "pedigree", "sample").rlike(r"[\t\r\n]"), F.lit(False)))
    return labels.label_counts(labels.resolve_labels(table(spark, sf, "registry_copy").select(F.col("sample_id").alias("sample")), named))


def relabelled(spark: SparkSession, sf: str) -> DataFrame:
    """Two tables with labels for ids, the id kept beside the label in one."""
    part = table(spark, sf, "part")
    names = part.where(F.col("p_partkey") % 4 != 0).select(F.col("p_partkey").alias("sample"), F.concat(F.lit("L"), (F.col("p_partkey") * 3).cast("string")).alias("label"))
    li = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").alias("line")).agg(F.count(F.lit(1)).alias("n")).withColumn("line", F.col("line").cast("string"))
    names = names.withColumn("sample", F.col("sample").cast("string"))
    got = labels.relabel_tables({"a": (li, "line", True), "b": (li, "line", False)}, names)
    return got["a"].select("line", "line_id", "n").unionByName(got["b"].withColumn("line_id", F.lit(None).cast("string")).select("line", "line_id", "n"))


def provenance_problems(spark: SparkSession, sf: str) -> DataFrame:
    c = table(spark, sf, "customer")
    sample = F.col("c_custkey").cast("string")
    records = c.where(F.col("c_custkey") % 9 != 0).select(sample.alias("sample"), F.when(F.col("c_custkey") % 11 == 0, (F.col("c_custkey") + 1).cast("string")).otherwise(sample).alias("written_for"), F.when(F.col("c_custkey") % 5 == 0, "m -d 1").otherwise("m -d 2").alias("markdup"))
    return labels.provenance_problems(records, c.select(sample.alias("sample")), "m -d 2")


def guard_names(spark: SparkSession, sf: str) -> DataFrame:
    """Ids that clash in an output folder, libraries of too many samples, donors that are run and reference donors."""
    p = table(spark, sf, "part").select(F.when(F.col("p_partkey") % 2 == 0, F.upper("p_brand")).otherwise(F.lower("p_brand")).alias("sample"))
    a = labels.clashing_names(p, ("BRAND#11", "x")).select(F.col("problem").alias("guard"), F.col("sample").alias("key"))
    b = labels.oversized_groups(_registry(spark, sf), ["library"], 30).select(F.lit("oversized").alias("guard"), F.col("library").alias("key"))
    c = labels.run_and_reference(table(spark, sf, "bc1_well_map"), table(spark, sf, "dev_import").where(F.col("role").isNotNull())).select(F.lit("run_and_reference").alias("guard"), F.col("donor").alias("key"))
    return groups.mix(a, b, c)


def prefix_match(spark: SparkSession, sf: str) -> DataFrame:
    """Files of part names matched to the longest entity they start with."""
    part = table(spark, sf, "part").select(F.concat(F.col("p_brand"), F.lit(".x")).alias("name")).distinct()
    entities = table(spark, sf, "part").select(F.substring("p_brand", 1, 7).alias("entity")).unionByName(table(spark, sf, "part").where(F.col("p_size") > 40).select(F.col("p_brand").alias("entity"))).distinct()
    return labels.longest_prefix(part, entities)


def identity_chain(spark: SparkSession, sf: str) -> DataFrame:
    """Market segment of orders by customer, else by clerk, with how it was found."""
    o = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = table(spark, sf, "customer")
    first = c.where(F.col("c_custkey") % 3 != 0).select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("value"))
    second = c.select(F.when(F.col("c_custkey") % 2 == 0, "1-URGENT").otherwise("2-HIGH").alias("o_orderpriority"), F.when(F.col("c_custkey") % 2 == 0, "even").otherwise(F.col("c_mktsegment")).alias("value"))
    return labels.chain(o, first, second, "o_custkey", "o_orderpriority", "value").groupBy("found_by").agg(F.count(F.lit(1)).alias("n"), F.count("value").alias("n_value"), F.max("value").alias("most"))


def role_groups(spark: SparkSession, sf: str) -> DataFrame:
    d = table(spark, sf, "dev_import").select("sample_id", "donor", "role").distinct()
    regions = spark.createDataFrame([("chr1",), ("chr2:1-500",)], "region string")
    got = qc.role_groups(d.select(F.col("sample_id").alias("sample"), "donor", "role").where(F.col("sample_id").isNotNull()), regions, d.where(F.col("role").isNull()).select(F.col("sample_id").alias("sample")))
    return got.select("donor", "role", "region", F.size("samples").alias("n"), F.array_join("samples", ",").alias("samples"))


def unit_names(spark: SparkSession, sf: str) -> DataFrame:
    """Platform units of lane files and read structures, from parts and suppliers."""
    p = table(spark, sf, "part").select("p_partkey", F.concat(F.lit("FC"), (F.col("p_partkey") % 7).cast("string"), F.lit("_a_L00"), (F.col("p_size") % 4 + 1).cast("string"), F.lit("_R1;FC1_b_L002_R2")).alias("f"), F.concat((F.col("p_size") % 9).cast("string"), F.lit("B"), F.when(F.col("p_size") % 2 == 0, "1S").otherwise(""), F.when(F.col("p_size") % 5 == 0, "T").otherwise("+T")).alias("s"))
    return p.select("p_partkey", labels.platform_unit(F.col("f")).alias("pu"), labels.read_structure(F.col("s")).alias("r")).select("p_partkey", "pu", F.col("r.barcode").alias("barcode"), F.col("r.skip").alias("skip"))


# --- dataflow and reports ------------------------------------------------------------------------------------------


def branch_counts(spark: SparkSession, sf: str) -> DataFrame:
    """Orders routed by the first condition that holds, each route summed up."""
    routes = groups.branch(table(spark, sf, "orders"), {"big": F.col("o_totalprice") > 200_000, "open": F.col("o_orderstatus") == "O"}, "rest")
    parts = [df.agg(F.lit(name).alias("route"), F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total")) for name, df in routes.items()]
    return groups.mix(*parts)


def combine_by_key(spark: SparkSession, sf: str) -> DataFrame:
    """Every customer of a nation with every supplier of it, counted; the nation of some is unknown on both sides."""
    c = table(spark, sf, "customer").select("c_custkey", F.when(F.col("c_custkey") % 10 != 0, F.col("c_nationkey")).alias("nation"))
    s = table(spark, sf, "supplier").select("s_suppkey", F.when(F.col("s_suppkey") % 10 != 0, F.col("s_nationkey")).alias("nation"))
    return groups.combine_by(c, s, ["nation"]).groupBy("nation").agg(F.count(F.lit(1)).alias("n"), F.sum("s_suppkey").alias("s"))


def multi_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """One input, two aligned outputs, put together again."""
    out = groups.multi_map(table(spark, sf, "orders"), {"key": ["o_orderkey", "o_custkey"], "price": ["o_orderkey", "o_totalprice"]})
    return out["key"].join(out["price"], "o_orderkey").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("o_totalprice"), 2).alias("total"))


def complete_groups(spark: SparkSession, sf: str) -> DataFrame:
    """Customers whose orders cover as many different months as is expected of them, and the others."""
    o = table(spark, sf, "orders").select("o_custkey", F.month("o_orderdate").alias("m"), (F.col("o_custkey") % 8 + 1).alias("want"))
    done, rest = groups.complete_groups(o, "o_custkey", "m", "want")
    held = groups.mix(done.withColumn("state", F.lit("complete")), rest.withColumn("state", F.lit("open")))
    return held.select("key", "state", F.size("members").alias("n"), F.array_join(F.transform("members", lambda x: x.cast("string")), ",").alias("members"))


def store_rollup(spark: SparkSession, sf: str) -> DataFrame:
    """Files, bytes and completeness by library of the import table; of rows sent again one counts."""
    d = table(spark, sf, "dev_import").distinct().select("library", F.col("size_bytes").alias("bytes"), F.col("index_path").isNotNull().alias("complete"))
    return report.store_rollup(d).select("library", "files", "bytes", F.col("complete").cast("int").alias("complete"))


def versions(spark: SparkSession, sf: str) -> DataFrame:
    return labels.versions(table(spark, sf, "dev_import").select(F.col("role").alias("process"), F.col("made_by").alias("version")))


def qq_points(spark: SparkSession, sf: str) -> DataFrame:
    """QQ points of p-values by ship mode, with heavy ties."""
    li = table(spark, sf, "lineitem").select("l_returnflag", (F.col("l_discount") + 0.01).cast("double").alias("p"))
    return report.qq_points(li, "p", ["l_returnflag"]).select("l_returnflag", *_r("p", to=4), "k", *_r("observed", "expected"))


def control_and_threshold(spark: SparkSession, sf: str) -> DataFrame:
    """Genomic control of prices as statistics, and the threshold of the largest one per customer."""
    o = table(spark, sf, "orders").select("o_custkey", (F.col("o_totalprice") / 100_000).alias("chi2"))
    return report.genomic_control(o).crossJoin(report.permutation_threshold(o, "o_custkey", "chi2")).select(*_r("inflation", "threshold"))  # two single rows


def contig_ranks(spark: SparkSession, sf: str) -> DataFrame:
    """Suppliers in the order in which they first appear."""
    li = table(spark, sf, "lineitem").select("l_suppkey", (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("at"))
    return sinks.contig_order(li, "l_suppkey", "at").groupBy("l_suppkey", "contig_rank").agg(F.count(F.lit(1)).alias("n"))


def text_rules(spark: SparkSession, sf: str) -> DataFrame:
    """Pool counts as text and numbers by fixed formats."""
    a = assay(spark, sf).groupBy("site").agg(F.sort_array(F.collect_list(F.struct("pool", "a", "n"))).alias("pairs"), F.exp(-F.sum("a") / F.sum("n")).alias("share"), F.max(F.when(F.col("a") > 5, F.col("pool"))).alias("top"))
    return sinks.formatted(a.select("site", sinks.pairs_text("pairs").alias("pairs"), "share", "top"), {"share": "%.4f"})


def simulated_spectrum(spark: SparkSession, sf: str) -> DataFrame:
    """Donors that hold an allele, over simulated sites as many as parts: hash draws, the same on any cluster; share of sites with carriers in bounds."""
    n = table(spark, sf, "part").count()
    sim = readers.simulate_donors(spark, n, 20, 3)
    per = sim.groupBy("site").agg(F.count_if("has").alias("carriers"))
    return per.agg(F.count(F.lit(1)).alias("sites"), (F.avg(F.col("carriers") / 20).between(0.1, 0.35)).cast("int").alias("mean_in_bounds"), (F.avg((F.col("carriers") == 0).cast("int")).between(0.2, 0.7)).cast("int").alias("empty_in_bounds"))


QUERIES = {f.__name__: f for f in (
    read_allele_counts, read_line_counts, read_panel_counts, read_marker_counts, read_pooled_calls, read_sites, read_step4, read_joint, read_segments, read_ranges, read_alignments, read_fastq, read_index, read_raw_lists,
    witness_summary, witness_pool, marker_counters, demux_summary, demux_samples, unknown_adapters, literal_share, mask_log, pedigree_ids, corrected_pedigrees, library_disagreements, label_counts, relabelled, provenance_problems,
    guard_names, prefix_match, identity_chain, role_groups, unit_names, branch_counts, combine_by_key, multi_outputs, complete_groups, store_rollup, versions, qq_points, control_and_threshold, contig_ranks, text_rules, simulated_spectrum,
)}


# --- SQL twins -----------------------------------------------------------------------------------------------------

_WIDE = """wd AS (SELECT l_partkey AS pos, l_linestatus AS st, CASE WHEN l_partkey % 17 = 0 THEN 'AT' ELSE 'A' END AS ref, count_if(l_linenumber % 2 = 0 AND l_tax < 0.04) AS r0, count_if(l_linenumber % 2 = 0 AND l_tax >= 0.04) AS a0, count_if(l_linenumber % 2 = 1 AND l_tax < 0.04) AS r1, count_if(l_linenumber % 2 = 1 AND l_tax >= 0.04) AS a1 FROM lineitem GROUP BY ALL),
wl AS (SELECT 's0' AS sample, pos, st, ref, r0 AS r, a0 AS a FROM wd UNION ALL SELECT 's1', pos, st, ref, r1, a1 FROM wd),
pn AS (SELECT p_partkey AS pos, CASE WHEN p_size % 5 = 0 THEN 'G' ELSE 'A' END AS pref, CASE WHEN p_size % 2 = 0 THEN 'C' END AS palt FROM part WHERE p_size % 3 <> 0)"""
_LAST = "la AS (SELECT sample, pos, max(st) AS st, arg_max(ref, st) AS ref, arg_max(r, st) AS r, arg_max(a, st) AS a FROM wl GROUP BY sample, pos)"
_STEP4 = """s4 AS (SELECT l_partkey AS pos, CASE WHEN l_partkey % 23 = 0 THEN 'AG' ELSE 'A' END AS ref, l_linenumber AS a, ['A', 'B', 'ref', '-'][CAST(l_suppkey % 4 + 1 AS BIGINT)] AS tier, l_orderkey % 3 = 0 AS hide, round(l_suppkey / 7.0, 3) AS odds FROM lineitem)"""
_REG = "rg AS (SELECT DISTINCT * FROM registry_test)"
_PED = r"'^(Z[vxldh])[.]([0-9]+)_[A-Za-z]([0-9]+)_[A-Za-z]([0-9]+)_[A-Za-z]([0-9]+)[.]([0-9]+)(([.][0-9]+){2,})$'"
_B36 = "substr('0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZ', {} + 1, 1)"
_REPORTS = "ln AS (SELECT CAST(o_custkey % 20 AS VARCHAR) AS library, month(o_orderdate) AS lane, CAST(o_custkey % 60 AS VARCHAR) AS name, count(*) AS k FROM orders GROUP BY ALL), lb AS (SELECT library, sum(k) + 3 * count(DISTINCT lane) AS pairs, count(DISTINCT lane) AS n_lanes FROM ln GROUP BY library), bc AS (SELECT DISTINCT CAST(c_custkey % 20 AS VARCHAR) AS library, CAST(c_custkey % 80 AS VARCHAR) AS sample FROM customer), sm AS (SELECT bc.library, bc.sample, coalesce(sum(ln.k), 0) AS reads FROM bc LEFT JOIN ln ON ln.library = bc.library AND ln.name = bc.sample GROUP BY ALL)"

ORACLES = {
    "read_allele_counts": f"WITH {_WIDE}, {_LAST} SELECT sample, pos, ref, CASE WHEN st = 'F' THEN 'C' ELSE 'C,G' END AS alts, CASE WHEN r + a = 0 THEN '0' ELSE r || ',' || a END AS ad FROM la",
    "read_line_counts": f"WITH {_WIDE}, fi AS (SELECT sample, pos, arg_min(r, st) AS r, arg_min(a, st) AS a FROM wl WHERE ref = 'A' GROUP BY sample, pos) SELECT sample, pos, CASE WHEN r + a = 0 THEN '' ELSE r || ',' || a END AS ad FROM fi",
    "read_panel_counts": f"WITH {_WIDE}, {_LAST} SELECT sample, la.pos, CAST(r AS INT) AS ref_n, CAST(a AS INT) AS alt_n FROM la JOIN pn ON la.pos = pn.pos AND la.ref = pn.pref WHERE r + a > 0",
    "read_marker_counts": f"WITH {_WIDE}, wy AS (SELECT wl.*, CASE WHEN pn.pos IS NULL THEN 'not_marker' WHEN length(ref) > 1 THEN 'indel' WHEN ref <> pref THEN 'ref_mismatch' END AS why FROM wl LEFT JOIN pn ON pn.pos = wl.pos), k AS (SELECT count(*) AS n, count(DISTINCT (sample, pos)) AS d FROM wy WHERE why IS NULL) SELECT why AS reason, count(*) AS n FROM wy WHERE why IS NOT NULL GROUP BY why UNION ALL SELECT 'repeat', n - d FROM k WHERE n > d UNION ALL SELECT 'kept', d FROM k",
    "read_pooled_calls": f"WITH {ASSAY_SQL}, s AS (SELECT site, site % 13 = 0 AS indel, site % 19 = 0 AS bare FROM assay GROUP BY site), c AS (SELECT s.site, p.p FROM s CROSS JOIN (VALUES (0), (1), (2)) p(p) WHERE NOT indel AND NOT bare) SELECT 'call:p' || c.p AS what, c.site AS pos, coalesce(n, 0) AS n, coalesce(a, 0) AS a FROM c LEFT JOIN assay ON assay.site = c.site AND assay.pool = c.p UNION ALL SELECT 'skipped:not_biallelic_snp', NULL, count(*), NULL FROM s WHERE indel HAVING count(*) > 0 UNION ALL SELECT 'skipped:no_depth_field', NULL, count(*), NULL FROM s WHERE bare AND NOT indel HAVING count(*) > 0",
    "read_sites": "SELECT DISTINCT 'chr1' AS chrom, l_partkey AS pos, 'A' AS ref, l_returnflag AS alt FROM lineitem WHERE l_quantity >= 3",
    "read_step4": f"WITH {_STEP4} SELECT tier, count(*) AS n, min(pos) AS first, max(pos) AS last FROM s4 WHERE length(ref) = 1 AND pos BETWEEN 50 AND 150 GROUP BY tier",
    "read_joint": f"WITH {_STEP4} SELECT tier, count(*) AS n, round(sum(odds), 4) AS llr, count_if(hide) AS hidepth, CAST(sum(a) AS BIGINT) AS a FROM s4 GROUP BY tier",
    "read_segments": f"WITH {SEGMENTS_SQL} SELECT 'L' || line AS line, '7' AS chrom, start, \"end\", state FROM segments",
    "read_ranges": """WITH r AS (SELECT 's' || l_suppkey AS chrom, date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) AS start, date_diff('day', DATE '1990-01-01', CAST(l_shipdate AS DATE)) + CAST(ceil(l_quantity / 25) AS BIGINT) AS "end" FROM lineitem),
 g AS (SELECT *, sum(CASE WHEN prev IS NULL OR start > prev THEN 1 ELSE 0 END) OVER (PARTITION BY chrom ORDER BY start, "end", prev NULLS FIRST ROWS UNBOUNDED PRECEDING) AS run FROM (SELECT *, max("end") OVER (PARTITION BY chrom ORDER BY start, "end" ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS prev FROM r)),
 m AS (SELECT chrom, min(start) AS start, max("end") AS "end" FROM g GROUP BY chrom, run) SELECT *, chrom || ':' || (start + 1) || '-' || "end" AS region FROM m""",
    "read_alignments": f"WITH {_READS} SELECT rname, CAST(rev + CASE WHEN mate = 2 THEN 128 ELSE 0 END AS INT) AS flag, count(*) AS n, CAST(sum(n) AS BIGINT) AS bases, CAST(sum(pos) AS BIGINT) AS pos FROM rd GROUP BY ALL",
    "read_fastq": "WITH p AS (SELECT 'f' || p_partkey % 2 AS file, translate(md5(CAST(p_partkey AS VARCHAR)), '0123456789abcdef', 'ACGTACGTACGTACGT') AS s, row_number() OVER (PARTITION BY p_partkey % 2 ORDER BY p_partkey) AS i FROM part) SELECT file, CAST(j AS INT) AS position, substr(s, j, 1) AS base, count(*) AS n FROM p CROSS JOIN (SELECT unnest(range(1, 4)) AS j) WHERE i <= 300 GROUP BY ALL",
    "read_index": "WITH w AS (SELECT DISTINCT 's' || c_custkey % 150 AS chrom, c_custkey % 7 AS start, c_custkey * 3 AS \"end\" FROM customer), i AS (SELECT 's' || s_suppkey AS chrom, s_suppkey * 100 AS len FROM supplier), r AS (SELECT DISTINCT 's' || l_suppkey AS chrom FROM lineitem WHERE l_suppkey % 9 <> 0), j AS (SELECT w.*, CASE WHEN r.chrom IS NULL THEN 'no_range' WHEN i.chrom IS NULL THEN 'not_in_index' WHEN start < 1 OR \"end\" < start THEN 'bad_region' WHEN \"end\" > len THEN 'past_the_end' END AS reason FROM w LEFT JOIN r ON r.chrom = w.chrom LEFT JOIN i ON i.chrom = w.chrom) SELECT * FROM j WHERE reason IS NOT NULL",
    "read_raw_lists": r"WITH r AS (SELECT DISTINCT sample_id, raw_r1 FROM registry_test WHERE regexp_full_match(raw_r1, '[^''\x22|,\s]+')), x AS (SELECT sample_id, unnest(list_filter(string_split(raw_r1, ';'), lambda x: x <> '')) AS v, generate_subscripts(list_filter(string_split(raw_r1, ';'), lambda x: x <> ''), 1) AS i FROM r) SELECT CASE WHEN regexp_matches(v, '^.+[.]tar:') THEN regexp_extract(v, '^(.+[.]tar):', 1) END AS archive, count(*) AS n, CAST(max(i) AS INT) AS most, min(regexp_replace(v, '^.+[.]tar:', '')) AS first FROM x GROUP BY ALL",
    "witness_summary": f"WITH {ASSAY_SQL}, w AS (SELECT site, sum(CASE WHEN pool = 1 THEN a ELSE 0 END) AS wa, count(*) AS k FROM assay GROUP BY site) SELECT 1 AS min_alt_reads, count(*) AS records_in, count_if(wa >= 1) AS kept, count_if(wa < 1) AS dropped, round(count_if(wa >= 1) / count(*), 6) AS kept_share, CAST(sum(CASE WHEN wa >= 1 THEN k ELSE 0 END) AS BIGINT) AS kept_rows FROM w",
    "witness_pool": f"WITH {ASSAY_SQL} SELECT site, CAST(sum(n) AS BIGINT) AS n, CAST(sum(a) AS BIGINT) AS a, count(*) AS n_pools FROM assay WHERE donor = 3 GROUP BY site",
    "marker_counters": """WITH r AS (SELECT l_partkey * 40 + l_linenumber * 4 + l_suppkey % 4 AS pos, CASE WHEN l_suppkey % 11 = 0 THEN 'C' ELSE 'A' END AS ref, upper(['C', 'c', 'G', 'AT', 'N'][CAST(l_suppkey % 5 + 1 AS BIGINT)]) AS alt, l_returnflag = 'N' AS tier, l_linenumber = 2 AS flagged FROM lineitem),
 y AS (SELECT *, CASE WHEN NOT tier THEN 'tier' WHEN alt NOT IN ('A', 'C', 'G', 'T') OR alt = ref THEN 'not_snv' WHEN flagged THEN 'flagged' END AS why FROM r), p AS (SELECT pos, count(DISTINCT (ref, alt)) FILTER (why IS NULL) AS k FROM y GROUP BY pos)
 SELECT count(*) AS rows, count_if(why IS DISTINCT FROM 'tier') AS tier_rows, count_if(coalesce(why = 'not_snv', false)) AS not_snv, count_if(coalesce(why = 'flagged', false)) AS flagged, (SELECT count_if(k > 1) FROM p) AS multiallelic_positions, (SELECT count_if(k = 1) FROM p) AS markers FROM y""",
    "demux_summary": f"WITH {_REPORTS}, ag AS (SELECT library, sum(reads) AS assigned, count(*) AS n_samples, coalesce(string_agg(sample, ',' ORDER BY sample) FILTER (reads = 0), '') AS zero FROM sm GROUP BY library) SELECT lb.library, CAST(pairs AS BIGINT) AS input_pairs, CAST(assigned AS BIGINT) AS assigned_pairs, CAST(pairs - assigned AS BIGINT) AS unassigned_pairs, round(assigned / pairs, 6) AS assignment_rate, n_samples, zero AS samples_zero_pairs, n_lanes FROM lb LEFT JOIN ag ON ag.library = lb.library",
    "demux_samples": f"WITH {_REPORTS} SELECT sm.library, sample, CAST(reads AS BIGINT) AS reads, round(reads / pairs, 6) AS share_of_input FROM sm LEFT JOIN lb ON lb.library = sm.library",
    "unknown_adapters": f"WITH {_REPORTS} SELECT DISTINCT ln.library, ln.name AS sample FROM ln WHERE (ln.library, ln.name) NOT IN (SELECT (library, sample) FROM bc WHERE CAST(sample AS INT) > 10)",
    "literal_share": f"WITH {_READS} SELECT sample, count(*) AS reads_checked, round(count_if(contains(substr(seq, 1, n), 'ACG')) / count(*), 6) AS literal_share FROM rd GROUP BY sample",
    "mask_log": f"WITH {_READS} SELECT sample, count(*) AS records, count_if(NOT star) AS masked, CAST(sum(CASE WHEN NOT star THEN least(CASE WHEN mate = 2 THEN 5 ELSE 3 END, n) ELSE 0 END) AS BIGINT) AS qualities FROM rd GROUP BY sample",
    "pedigree_ids": f"""WITH r AS (SELECT pedigree FROM registry_test UNION SELECT 'Zx.' || format('{{:04d}}', p_partkey) || '_P' || p_size || '_P2_Q' || p_partkey % 40 || '.' || p_size % 37 || CASE WHEN p_size % 3 = 0 THEN '.1.2' ELSE '.1.1' END || CASE WHEN p_size % 4 = 0 THEN '-blk' ELSE '' END FROM part),
 c AS (SELECT pedigree, trim(regexp_replace(regexp_replace(trim(coalesce(pedigree, ''), ' '), '[.]B$', ''), '-(blk|bulk)$', '', 'i'), ' ') AS t FROM r), m AS (SELECT *, regexp_matches(t, {_PED}) AS ok, TRY_CAST(regexp_extract(t, {_PED}, 3) AS INT) AS a, TRY_CAST(regexp_extract(t, {_PED}, 4) AS INT) AS b, TRY_CAST(regexp_extract(t, {_PED}, 5) AS INT) AS d, TRY_CAST(regexp_extract(t, {_PED}, 6) AS INT) AS e, regexp_extract(t, {_PED}, 7) AS s FROM c)
 SELECT pedigree, nullif(regexp_extract(pedigree, '^(Z[a-z][.][0-9]{{4}})(_|$)', 1), '') AS accession, nullif(regexp_extract(pedigree, '^(Z[a-z][.][0-9]+_P[0-9]+)_', 1), '') AS donor,
 CASE WHEN ok AND regexp_full_match(s, '([.]0*1)+') AND least(a, b, d, e) >= 1 AND greatest(a, b, d, e) <= 35 THEN regexp_extract(t, {_PED}, 1) || format('{{:04d}}', CAST(regexp_extract(t, {_PED}, 2) AS BIGINT)) || {_B36.format('a')} || {_B36.format('b')} || {_B36.format('d')} || {_B36.format('e')} END AS code FROM m""",
    "corrected_pedigrees": f"""WITH {_REG}, k AS (SELECT sample_id, pedigree, CAST(('0x' || substr(md5(sample_id), 1, 4)) AS INT) AS k FROM rg)
 SELECT sample_id, CASE WHEN k % 5 = 0 AND k % 2 = 0 THEN 'new:' || sample_id ELSE pedigree END AS pedigree_resolved, CASE WHEN k % 5 = 0 THEN 'C' || lpad(CAST(k % 10000 AS VARCHAR), 4, '0') ELSE '' END AS ids, CAST(k % 5 = 0 AND k % 2 = 0 AND k % 3 = 0 AND pedigree IS DISTINCT FROM 'other' AS INT) AS odd FROM k""",
    "library_disagreements": f"WITH {_REG}" + " UNION ALL ".join(f" SELECT library, '{c}' AS \"column\", count(DISTINCT coalesce('=' || {c}, '')) AS n_values FROM rg GROUP BY library HAVING count(DISTINCT coalesce('=' || {c}, '')) > 1" for c in ("source", "barcode_layout", "raw_location", "plate", "taxon")),
    "label_counts": f"""WITH {_REG}, g AS (SELECT sample_id, nullif(nil_id, '') AS nil, nullif(pedigree, '') AS ped FROM rg WHERE NOT regexp_matches(concat_ws('|', nil_id, pedigree, sample_id), '[\\t\\r\\n]')), s AS (SELECT DISTINCT sample_id FROM registry_copy),
 b AS (SELECT s.sample_id, coalesce(nil, ped, s.sample_id) AS base, CASE WHEN g.sample_id IS NULL THEN 'sample_id_not_in_registry' WHEN nil IS NOT NULL THEN 'nil_id' WHEN ped IS NOT NULL THEN 'pedigree' ELSE 'sample_id_no_label' END AS label_source FROM s LEFT JOIN g ON g.sample_id = s.sample_id), n AS (SELECT *, count(*) OVER (PARTITION BY base) AS k FROM b)
 SELECT label_source, count(*) AS n, count_if(k > 1) AS n_collisions FROM n GROUP BY label_source""",
    "relabelled": "WITH l AS (SELECT l_partkey AS k, count(*) AS n FROM lineitem GROUP BY l_partkey), r AS (SELECT CASE WHEN k % 4 <> 0 AND k IN (SELECT p_partkey FROM part) THEN 'L' || k * 3 ELSE CAST(k AS VARCHAR) END AS line, CAST(k AS VARCHAR) AS line_id, n FROM l) SELECT line, line_id, n FROM r UNION ALL SELECT line, NULL, n FROM r",
    "provenance_problems": "SELECT CAST(c_custkey AS VARCHAR) AS sample, 'no record' AS problem FROM customer WHERE c_custkey % 9 = 0 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'markdup' FROM customer WHERE c_custkey % 9 <> 0 AND c_custkey % 5 = 0 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'sample' FROM customer WHERE c_custkey % 9 <> 0 AND c_custkey % 11 = 0",
    "guard_names": f"""WITH {_REG}, p AS (SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN upper(p_brand) ELSE lower(p_brand) END AS s FROM part), n AS (SELECT lower(s) AS l FROM p GROUP BY lower(s) HAVING count(*) > 1)
 SELECT 'differs_by_case' AS guard, s AS key FROM p WHERE lower(s) IN (SELECT l FROM n) UNION ALL SELECT 'reserved', s FROM p WHERE lower(s) IN ('brand#11', 'x') UNION ALL SELECT 'oversized', library FROM rg GROUP BY library HAVING count(*) > 30
 UNION ALL SELECT DISTINCT 'run_and_reference', donor FROM bc1_well_map WHERE donor IN (SELECT donor FROM dev_import WHERE role IS NOT NULL AND donor IS NOT NULL)""",
    "prefix_match": "WITH n AS (SELECT DISTINCT p_brand || '.x' AS name FROM part), e AS (SELECT DISTINCT substr(p_brand, 1, 7) AS e FROM part UNION SELECT DISTINCT p_brand FROM part WHERE p_size > 40) SELECT name, arg_max(e, length(e)) AS entity FROM n JOIN e ON starts_with(name, e) GROUP BY name",
    "identity_chain": """WITH f AS (SELECT c_custkey AS k, count(DISTINCT c_mktsegment) AS n1, max(c_mktsegment) AS v1 FROM customer WHERE c_custkey % 3 <> 0 GROUP BY c_custkey), s AS (SELECT CASE WHEN c_custkey % 2 = 0 THEN '1-URGENT' ELSE '2-HIGH' END AS k, count(DISTINCT CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE c_mktsegment END) AS n2, max(CASE WHEN c_custkey % 2 = 0 THEN 'even' ELSE c_mktsegment END) AS v2 FROM customer GROUP BY 1),
 j AS (SELECT CASE WHEN n1 = 1 THEN v1 WHEN n2 = 1 THEN v2 END AS value, CASE WHEN n1 = 1 THEN 'first' WHEN n2 = 1 THEN 'second' WHEN coalesce(n1, 0) > 1 THEN 'ambiguous' ELSE 'none' END AS found_by FROM orders LEFT JOIN f ON f.k = o_custkey LEFT JOIN s ON s.k = o_orderpriority) SELECT found_by, count(*) AS n, count(value) AS n_value, max(value) AS most FROM j GROUP BY found_by""",
    "role_groups": "WITH d AS (SELECT DISTINCT sample_id, donor, role FROM dev_import), k AS (SELECT * FROM d WHERE sample_id IS NOT NULL AND sample_id NOT IN (SELECT sample_id FROM d WHERE role IS NULL AND sample_id IS NOT NULL)), g AS (SELECT donor, role, count(*) AS n, string_agg(sample_id, ',' ORDER BY sample_id) AS samples FROM k GROUP BY donor, role) SELECT donor, role, region, CAST(n AS INT) AS n, samples FROM g CROSS JOIN (VALUES ('chr1'), ('chr2:1-500')) r(region)",
    "unit_names": "SELECT p_partkey, array_to_string(list_sort(list_distinct(['FC' || p_partkey % 7 || '.' || (p_size % 4 + 1), 'FC1.2'])), ',') AS pu, CASE WHEN p_size % 5 <> 0 THEN CAST(p_size % 9 AS INT) END AS barcode, CASE WHEN p_size % 5 <> 0 THEN CASE WHEN p_size % 2 = 0 THEN 1 ELSE 0 END END AS skip FROM part",
    "branch_counts": "SELECT r.route, coalesce(n, 0) AS n, total FROM (VALUES ('big'), ('open'), ('rest')) r(route) LEFT JOIN (SELECT CASE WHEN o_totalprice > 200000 THEN 'big' WHEN o_orderstatus = 'O' THEN 'open' ELSE 'rest' END AS route, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY 1) x ON x.route = r.route",
    "combine_by_key": "WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 10 <> 0 THEN c_nationkey END AS nation FROM customer), s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 10 <> 0 THEN s_nationkey END AS nation FROM supplier) SELECT c.nation, count(*) AS n, CAST(sum(s_suppkey) AS BIGINT) AS s FROM c JOIN s ON c.nation IS NOT DISTINCT FROM s.nation GROUP BY c.nation",
    "multi_outputs": "SELECT o_custkey, count(*) AS n, round(sum(o_totalprice), 2) AS total FROM orders GROUP BY o_custkey",
    "complete_groups": "WITH g AS (SELECT o_custkey AS key, list_sort(list(DISTINCT month(o_orderdate))) AS m FROM orders GROUP BY o_custkey) SELECT key, CASE WHEN len(m) >= key % 8 + 1 THEN 'complete' ELSE 'open' END AS state, CAST(len(m) AS INT) AS n, array_to_string(m, ',') AS members FROM g",
    "store_rollup": "WITH d AS (SELECT DISTINCT * FROM dev_import) SELECT library, count(*) AS files, CAST(sum(size_bytes) AS BIGINT) AS bytes, CAST(bool_and(index_path IS NOT NULL) AS INT) AS complete FROM d GROUP BY library",
    "versions": "SELECT role AS process, coalesce(string_agg(DISTINCT made_by, ', ' ORDER BY made_by), '') AS versions FROM dev_import GROUP BY role",
    "qq_points": """WITH c AS (SELECT l_returnflag, CAST(l_discount AS DOUBLE) + 0.01 AS p, count(*) AS k FROM lineitem GROUP BY ALL), r AS (SELECT *, sum(k) OVER (PARTITION BY l_returnflag) AS n, sum(k) OVER (PARTITION BY l_returnflag ORDER BY p ROWS UNBOUNDED PRECEDING) - (k - 1) / 2 AS rank FROM c)
 SELECT l_returnflag, round(p, 4) AS p, k, round(-log10(p), 6) AS observed, round(-log10((rank - CASE WHEN n <= 10 THEN 0.375 ELSE 0.5 END) / (n + 1 - 2 * CASE WHEN n <= 10 THEN 0.375 ELSE 0.5 END)), 6) AS expected FROM r""",
    "control_and_threshold": "WITH m AS (SELECT o_custkey, max(o_totalprice / 100000) AS top FROM orders GROUP BY o_custkey) SELECT round((SELECT median(o_totalprice / 100000) FROM orders) / 0.4549364231195724, 6) AS inflation, round(quantile_cont(top, 0.95), 6) AS threshold FROM m",
    "contig_ranks": "SELECT l_suppkey, CAST(row_number() OVER (ORDER BY f, l_suppkey) AS INT) AS contig_rank, n FROM (SELECT l_suppkey, min(l_orderkey * 10 + l_linenumber) AS f, count(*) AS n FROM lineitem GROUP BY l_suppkey)",
    "text_rules": f"WITH {ASSAY_SQL} SELECT CAST(site AS VARCHAR) AS site, string_agg(pool || ':' || a || '/' || n, ';' ORDER BY pool) AS pairs, printf('%.4f', exp(-sum(a) / sum(n))) AS share, coalesce(CAST(max(CASE WHEN a > 5 THEN pool END) AS VARCHAR), 'NA') AS top FROM assay GROUP BY site",
    "simulated_spectrum": "SELECT count(*) AS sites, 1 AS mean_in_bounds, 1 AS empty_in_bounds FROM part",
}
