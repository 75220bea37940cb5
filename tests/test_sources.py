import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedwork.operators import intervals, labels, qc, reads, report
from seedwork.sources import readers, sinks
from seedwork.streaming.groups import release_groups, windowed_counts
from tests.conftest import rows


def put(path, text):
    path.write_text(text)
    return str(path)


def test_allele_tables(spark, tmp_path):
    put(tmp_path / "a.tsv", "#[1]CHROM\t[2]POS\t[3]REF\t[4]ALT\t[5]s1:AD\t[6]s2:AD\nc\t5\tA\tC,<*>\t3,1,0\t.\nc\t5\tA\tG\t9,9\t1,1\nc\t7\tAT\tA\t1,1\t2,2\n")
    put(tmp_path / "b.tsv", "# [1]CHROM\t[2]POS\t[3]REF\t[4]ALT\t[5]s1:AD\nc\t5\tA\tC\t100,0\n")
    lines = readers.lines(spark, [str(tmp_path / "a.tsv")])
    assert rows(readers.allele_counts(lines)) == sorted([("s1", "c", 5, "A", ["G"], [9, 9]), ("s2", "c", 5, "A", ["G"], [1, 1]), ("s1", "c", 7, "AT", ["A"], [1, 1]), ("s2", "c", 7, "AT", ["A"], [2, 2])], key=repr)
    first = {(r.sample, r.pos): list(r.ad) for r in readers.allele_counts(lines, "first", single_base_ref=True, empty_as_zero=False).collect()}
    assert first == {("s1", 5): [3, 1, 0], ("s2", 5): []}
    both = readers.allele_counts(readers.lines(spark, [str(tmp_path / "a.tsv"), str(tmp_path / "b.tsv")]), "first_table")
    assert {(r.sample, r.pos): list(r.ad) for r in both.collect()}[("s1", 5)] == [3, 1, 0]
    panel = spark.createDataFrame([("c", 5, "a", "g"), ("c", 7, "AT", None)], "chrom string, pos long, ref string, alt string")
    assert rows(readers.panel_counts(readers.allele_counts(lines), panel)) == sorted([("s1", "c", 5, 9, 9), ("s2", "c", 5, 1, 1), ("s1", "c", 7, 1, 1), ("s2", "c", 7, 2, 2)], key=repr)
    bad = readers.lines(spark, put(tmp_path / "bad.tsv", "#CHROM\tPOS\tREF\tALT\ts:AD\nc\t1\tA\tC\n"))
    with pytest.raises(Exception, match="ragged"):
        readers.allele_counts(bad).collect()


def test_calls_sites_ranges_segments(spark, tmp_path):
    vcf = "##x\n#CHROM\tPOS\tID\tREF\tALT\tQUAL\tFILTER\tINFO\tFORMAT\tP1\tP2\nc\t1\t.\tA\tC\t.\t.\t.\tGT:DP:ADf:ADr:ADb\t0:9:3,1:2,1:0,1\t.\nc\t2\t.\tAT\tA\t.\t.\t.\tGT:ADf\t0:1,1\t0:1,1\nc\t3\t.\tA\tG\t.\t.\t.\tGT\t0\t0\n"
    calls, skipped = readers.pooled_calls(readers.lines(spark, put(tmp_path / "x.vcf", vcf)))
    assert rows(calls) == [("c", 1, "A", "C", "P1", 8, 3), ("c", 1, "A", "C", "P2", 0, 0)]
    assert rows(skipped) == [("no_depth_field", 1), ("not_biallelic_snp", 1)]
    sites = readers.site_list(readers.lines(spark, put(tmp_path / "s.tsv", "chrom\tpos\tref\talt\nc\t1\tA\tC\nc\t1\tA\tC\nshort\n")))
    assert rows(sites) == [("c", 1, "A", "C")]
    bed = readers.bed(readers.lines(spark, put(tmp_path / "b.bed", "track x\n#c\nc\t50\t150\nc\t100\t300\nc\t300\t320\nc\t400\t410\n")))
    assert rows(intervals.merge_intervals(bed, ["chrom"])) == [("c", 400, 410), ("c", 50, 320)]
    with pytest.raises(Exception, match="bad range"):
        readers.bed(readers.lines(spark, put(tmp_path / "b2.bed", "c\t9\t3\n"))).collect()
    for name, sep in (("a.csv", ","), ("a.tsv2", "\t")):
        text = "\n".join(sep.join(x) for x in (("source", "donor", '"name"', "chr", "start_bp", "end_bp", "state"), ("s", "d", '"l1"', "Chr7", "1", "100.0", "2"), ("short",))) + "\n"
        assert rows(readers.segment_table(readers.lines(spark, put(tmp_path / name, text)))) == [("l1", "7", 1, 100, 2)]


def test_small_readers(spark, tmp_path):
    metrics = put(tmp_path / "S1.metrics", "## htsjdk\n## METRICS CLASS\tx\nGENOME_TERRITORY\tMEAN_COVERAGE\n10\t0.5\n\n## HISTOGRAM\n")
    assert rows(readers.coverage_metrics(spark, metrics)) == [("S1", 0.5, None)]
    fq = readers.fastq(readers.lines(spark, put(tmp_path / "r.fq", "@a\nAC\n+\nII\n@b\nGT\n+\nII\n")), 1)
    assert [r.seq for r in fq.collect()] == ["AC"]
    rep = put(tmp_path / "r.json", json.dumps({"read_counts": {"input": 7}, "adapters_read1": [{"name": "s1", "total_matches": 5}]}))
    rep = readers.demux_reports(spark, rep).withColumn("library", F.lit("L"))
    bar = spark.createDataFrame([("L", "s1"), ("L", "s2")], "library string, sample string")
    assert rows(reads.demux_totals(rep.unionByName(rep), bar)) == [("L", 14, 10, ["s2"])]
    grid = readers.prior_grid(spark)
    assert grid.count() == 31 and grid.agg(F.sum("weight")).first()[0] == pytest.approx(1)
    got = spark.createDataFrame([("chr1:1,000-2,000",), ("chr2",)], "t string").select(readers.regions(F.col("t")).alias("r")).select("r.*")
    assert rows(got) == [("chr1", 1000, 2000), ("chr2", 1, None)]
    files = spark.createDataFrame([("x_L001_R1_001.fq",), ("x_L001_R2_001.fq",)], "name string")
    assert rows(readers.mate_pairs(files)) == [("x_L001_R1_001.fq", "x_L001_R2_001.fq")]
    with pytest.raises(labels.GuardError):
        readers.mate_pairs(files.limit(1))
    schema = T.StructType([T.StructField("a", T.LongType()), T.StructField("zz", T.StringType())])
    assert readers.tsv(spark, str(tmp_path / "none.tsv"), schema).count() == 0
    assert rows(readers.tsv(spark, put(tmp_path / "t.tsv", "a\tb\n1\tx\n"), schema)) == [(1, None)]
    sheet = put(tmp_path / "sheet.csv", "a,zz\n1,x\n1,y\n")
    with pytest.raises(labels.GuardError, match="repeated a"):
        readers.sheet(spark, sheet, schema, unique=["a"])
    assert readers.simulate_donors(spark, 50, 3).count() == 150


def test_reads(spark):
    a = spark.createDataFrame([("s", 16, 100, "2S3M", "TTCGT", "IIIII"), ("s", 128, 99, "2M1D3M", "AACGG", "II!II"), ("s", 0, 101, "1H4M2I2M", "ACTTGGAC", "IIIIIIII")], "sample string, flag int, pos long, cigar string, seq string, qual string")
    got = sorted((r.mate, r.cycle, r.pos, r.base) for r in reads.aligned_bases(a).collect())
    assert got == sorted([(1, 3, 100, "C"), (1, 2, 101, "G"), (1, 1, 102, "T"), (2, 1, 99, "A"), (2, 2, 100, "A"), (2, 4, 103, "G"), (2, 5, 104, "G"), (1, 2, 101, "A"), (1, 3, 102, "C"), (1, 4, 103, "T"), (1, 5, 104, "T"), (1, 8, 105, "A"), (1, 9, 106, "C")])
    m = spark.createDataFrame([(0, "IIIII"), (16, "IIIII"), (128, "IIIII"), (256, "IIIII"), (0, "*"), (0, "I")], "f int, q string").select(reads.mask_starts(F.col("f"), F.col("q"), F.lit(2), F.lit(3)))
    assert [r[0] for r in m.collect()] == ["!!III", "III!!", "!!!II", "IIIII", "*", "!"]


def test_labels_and_chains(spark):
    reg = spark.createDataFrame([("a", "N", "", "d", ""), ("b", "N", "", "d", ""), ("c", "", "P", "d", None), ("e", "", None, "", "FALSE"), ("x", "X", "", "d", "TRUE")], "sample string, nil_id string, pedigree string, donor string, exclude string")
    s = spark.createDataFrame([("a",), ("b",), ("c",), ("e",), ("z",)], "sample string")
    got = {r.sample: (r.label, r.label_source) for r in labels.resolve_labels(s, reg, "d").collect()}
    assert got == {"a": ("N_a", "nil_id"), "b": ("N_b", "nil_id"), "c": ("P", "pedigree"), "e": ("e", "sample_id_no_label"), "z": ("z", "sample_id_not_in_registry")}
    with pytest.raises(labels.GuardError):
        labels.resolve_labels(spark.createDataFrame([("x",)], "sample string"), reg)
    p = spark.createDataFrame([("Zx.9117_P4_P12_P1.2.1.1",), ("junk",)], "p string").select(labels.pedigree_parts(F.col("p")).alias("r")).select("r.accession", "r.donor")
    assert rows(p) == [("Zx.9117", "Zx.9117_P4"), (None, None)]
    names = spark.createDataFrame([("Zx.1_P10.chr1",), ("Zx.1_P1.chr1",)], "name string")
    assert rows(labels.longest_prefix(names, spark.createDataFrame([("Zx.1_P1",), ("Zx.1_P10",)], "entity string"))) == [("Zx.1_P1.chr1", "Zx.1_P1"), ("Zx.1_P10.chr1", "Zx.1_P10")]
    one, two = spark.createDataFrame([("w", "A"), ("v", "A"), ("v", "B")], "well string, ped string"), spark.createDataFrame([("q", "C")], "plot string, ped string")
    c = labels.chain(spark.createDataFrame([("w", "q"), ("v", "q"), ("v", "n")], "well string, plot string"), one, two, "well", "plot", "ped")
    assert {(r.well, r.plot): (r.ped, r.found_by) for r in c.collect()} == {("w", "q"): ("A", "first"), ("v", "q"): ("C", "second"), ("v", "n"): (None, "ambiguous")}


def test_stores(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", ["x"], None)], "i long, s string, l array<string>, n double")
    sinks.publish(df, str(tmp_path / "store"))
    with pytest.raises(labels.GuardError):
        sinks.publish(df, str(tmp_path / "store"))
    assert sinks.stored_or(spark, str(tmp_path / "store"), lambda: 1 / 0).count() == 1
    assert rows(sinks.as_text(df)) == [("1", "a", "x", "NA")]
    sinks.export_tsv(df, str(tmp_path / "out"), ["i"])
    m = sinks.manifest(spark, "u1", {"a": 2, "b": "2.0"})
    assert {r.value for r in m.collect()} == {"2"}
    path = str(tmp_path / "manifest")
    assert sinks.extend_store(spark, path, m) and not sinks.extend_store(spark, path, m) and sinks.extend_store(spark, path, m.withColumn("unit", F.lit("u2")))
    with pytest.raises(labels.GuardError):
        sinks.extend_store(spark, path, sinks.manifest(spark, "u3", {"a": 3, "b": 2}))
    assert sinks.same_rows(df, df).count() == 0


def test_decision_and_painting(spark):
    s = spark.createDataFrame([("a",), ("b",)], "sample string")
    cov = spark.createDataFrame([("a", True, ".")], "sample string, pass boolean, reason string")
    rel = spark.createDataFrame([("a", True, "low")], "sample string, flag boolean, reason string")
    got = {r.sample: (r["pass"], list(r.reasons), list(r.notes), r.state) for r in qc.sample_decision(s, cov, {"relatedness": rel, "donor_content": None}, fail_on=()).collect()}
    assert got == {"a": (True, [], ["relatedness:low"], "partial"), "b": (False, ["not_in_min_coverage"], ["relatedness:not_in_table"], "partial")}
    seg = spark.createDataFrame([("l", 1, 9, 0), ("m", 5, 20, 2)], "line string, start long, end long, state int")
    assert rows(report.painting(seg, seg.where("line = 'm'"))) == [("l", 1, 9, "0"), ("m", 1, 20, "excluded")]


def test_released_groups(spark, tmp_path):
    src = tmp_path / "in"
    data = [("g", "a", 2), ("g", "b", 2), ("h", "a", 3), ("g", "a", 2), ("h", None, 3)]
    spark.createDataFrame(data, "k string, m string, n int").withColumn("at", F.lit("2024-01-01 10:00:00").cast("timestamp")).write.parquet(str(src))
    stream = spark.readStream.schema("k string, m string, n int, at timestamp").parquet(str(src))
    for name, df, want in (("released", release_groups(stream, "k", "m", "n", "at"), [("g", ["a", "b"])]), ("counted", windowed_counts(stream, "at", "k").select("k", "n"), [("g", 3), ("h", 2)])):
        q = df.writeStream.format("memory").queryName(name).outputMode("update").option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        try:
            assert q.awaitTermination(60)
            assert rows(spark.table(name)) == want
        finally:
            q.stop()
