"""Rules of steps whose defaults, guards and edges are easily got wrong."""

import zipfile

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedwork import session
from seedwork.operators import gaps, intervals, labels, pooled, qc, reads, report
from seedwork.sources import readers, sinks
from seedwork.streaming import groups
from tests.conftest import rows


def test_defaults_of_blocked_flags():
    assert gaps.GapOptions().blocked == ("hidepth", "af_gt_half") and pooled.MARKER_FLAGS == ("hidepth", "af_gt_half", "inconsistent")
    with pytest.raises(ValueError, match="scope"):
        gaps.GapOptions(scope="some")


def test_pedigree_grammar(spark):
    texts = ["Zx.12_P3_Q4_P5.6.1.1", "Zx.0012_P3_P4_P5.6.1.1.1.B", " Zx.9117_P4_P12_P35.2.1.1-BLK ", "Zx.9117_P4_P12_P36.2.1.1", "Zx.9117_P4_P12_P1.2.2.1", "Zx.9117_P4_P12_P1.2.1", "Zq.1_P1_P1_P1.1.1.1", "Zx.9117_P4_P12", "Zx.9117", "junk", None, ""]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, p string").select("i", labels.pedigree_parts(F.col("p")).alias("r"), labels.third_selfing(F.col("p")).alias("s3")).orderBy("i")
    got = [(r.r.accession, r.r.donor, r.r.code, r.s3) for r in df.collect()]
    assert got[0] == (None, "Zx.12_P3", "Zx00123456", "Zx.12_P3_Q4_P5.6.1.1")
    assert got[1] == ("Zx.0012", "Zx.0012_P3", "Zx00123456", "Zx.0012_P3_P4_P5.6.1.1")
    assert got[2][2] == "Zx91174CZ2"
    assert [g[2] for g in got[3:]] == [None] * 9
    assert got[7][:2] == ("Zx.9117", "Zx.9117_P4") and got[8][:2] == ("Zx.9117", None) and got[9][:2] == got[10][:2] == got[11][:2] == (None, None)


def test_demultiplex_takes_the_longest_barcode_once(spark):
    df = spark.createDataFrame([(1, "ACGTTT", "ACGA"), (2, "ACTTTT", "ACTT"), (3, "GG", "GG"), (4, None, None), (1, "ACGTTT", "ACGA")], "id int, seq string, mate string")
    codes = spark.createDataFrame([("a", "AC"), ("b", "ACG"), ("z", "ACG"), (None, None), ("e", "")], "sample string, barcode string")
    got = reads.demultiplex(df, codes, "seq", skip=1)
    assert rows(got.select("id", "sample", "barcode", "trimmed")) == sorted([(1, "b", "ACG", "TT"), (1, "b", "ACG", "TT"), (2, "a", "AC", "TTT")])
    assert rows(reads.demultiplex(df, codes, "seq", mate="mate").select("id", "barcode")) == [(1, "ACG"), (1, "ACG"), (2, "AC")]
    assert reads.demultiplex(df, codes.limit(0), "seq").count() == 0


def test_founder_calls_refuse_tables_of_different_runs(spark):
    union = spark.createDataFrame([(1, False), (2, False), (3, True)], "key int, multiallelic boolean")
    s1 = spark.createDataFrame([(1, False, "REF", -3.0), (2, False, None, 0.1)], "key int, own boolean, state string, log_odds double")
    s2 = spark.createDataFrame([(2, "ALT", 9.0)], "key int, call string, log_odds double")
    got = {r.key: (r.allele, r.call_step) for r in gaps.founder_calls(union, s1, s2).collect()}
    assert got == {1: ("REF", "step1_ref"), 2: ("ALT", "step2_alt"), 3: (None, "multiallelic")}
    with pytest.raises(labels.GuardError, match="no row of step 1"):
        gaps.founder_calls(union, s1.where("key = 2"), s2)
    with pytest.raises(labels.GuardError, match="already|has called"):
        gaps.founder_calls(union, s1, s2.withColumn("key", F.lit(1)))
    assert gaps.founder_calls(union, s1.where("key = 2"), s2, strict=False).count() == 3


def test_step2_by_sums_equals_the_sum_over_lines(spark):
    import math
    import random

    rng = random.Random(6)
    obs = [(k, ln, rng.choice([0, 0, 1, 2, None]), rng.randint(0, 9)) for k in range(6) for ln in range(8)]
    obs = [(k, ln, x, n, rng.randint(0, n) if x else int(n > 7)) for k, ln, x, n in obs]
    lam = {ln: rng.uniform(0.5, 6) if ln else 0.0 for ln in range(8)}
    grid, o = ((0.0, 1.0), (0.5, 2.0), (1.0, 3.0)), gaps.GapOptions(x0_p=0.0)
    cand = spark.createDataFrame([(k, 0.4, 1.5, 40, 1, False) for k in range(7)], "key int, prior double, j_llr double, j_n0 long, j_a0 long, blocked boolean")
    df = spark.createDataFrame(obs, "key int, line int, x int, n int, a int")
    got = {r.key: r for r in gaps.fill_step2(cand, df, spark.createDataFrame(list(lam.items()), "line int, lam double"), grid, o).collect()}
    for k in range(7):
        mine = [(x, n, a, lam[ln]) for kk, ln, x, n, a in obs if kk == k and x is not None and lam[ln] > 0]
        n0, a0, l0 = (sum(v[i] for v in mine if v[0] == 0) for i in (1, 2, 3))
        if not any(x > 0 for x, *_ in mine) or l0 == 0:
            assert got[k].call == "no_test" and got[k].llr_lines is None
            continue
        e, ks = (1 + a0 + 1) / (40 + n0 + 200), max(n0 / l0, 0.02)
        clip = lambda p: min(max(p, 1e-9), 1 - 1e-9)
        vd, va, r = [], [], 0.0
        for c, w in grid:
            d = s = r = 0.0
            for x, n, a, ell in mine:
                h = x / 2
                den = (1 - h) + h * c
                mu = max(ks * ell * den, 1e-9)
                rho = h * c / den if den > 1e-12 else 0.0
                p, q = clip(rho * (1 - e) + (1 - rho) * e), clip(e)
                d += n * math.log(mu) - mu
                s += a * math.log(p) + (n - a) * math.log(1 - p)
                r += a * math.log(q) + (n - a) * math.log(1 - q)
            vd.append(math.log(w / 6) + d)
            va.append(math.log(w / 6) + d + s)
        lse = lambda v: max(v) + math.log(sum(math.exp(z - max(v)) for z in v))
        assert got[k].llr_lines == pytest.approx(lse(va) - lse(vd) - r, rel=1e-9)


def test_same_taxon_scope_by_direct_count(spark):
    schema = "chrom string, pos long, ref string, alt string, carriers array<string>, ref_donors array<string>, donor string, j_n long, j_llr double, j_flags array<string>, j_tier string, own boolean"
    taxa = {"a": "x", "b": "x", "c": "y", "d": None, "r": "x", "q": "y"}
    sites = {1: (["b", "r"], ["q"]), 2: (["c"], ["r", "q"]), 3: (["a", "c", "q"], [])}
    llr = {"a": -5.0, "b": 1.0, "c": -6.0, "d": -9.0}
    data = [("c", p, "A", "C", cs, rs, d, 20, llr[d], [], "-", d in cs) for p, (cs, rs) in sites.items() for d in "abcd"]
    got = {(r.pos, r.donor): (r.k, r.m) for r in gaps.leave_one_out(spark.createDataFrame(data, schema), gaps.GapOptions(scope="same_taxon"), spark.createDataFrame(list(taxa.items()), "donor string, taxon string")).collect()}
    for p, (cs, rs) in sites.items():
        for d in "abcd":
            if d in cs:
                continue
            others = [e for e in taxa if e != d and taxa[d] is not None and taxa[e] == taxa[d]]
            k = sum(e in cs for e in others)
            m = k + sum(e not in cs and (llr[e] <= -4 if e in llr else e in rs) for e in others)
            assert got[(p, d)] == (k, m), (p, d)


def test_raster_lookups_agree_and_markerless_lines_fail(spark):
    alleles = spark.createDataFrame([("c", i * 7, "ALT", 0.5) for i in range(40)] + [("other", 5, "REF", 0.1), (None, 5, "ALT", 0.1)], "chrom string, pos long, allele string, p_alt double")
    segs = spark.createDataFrame([(1, "c", 0, 100, 0), (1, "c", 120, 200, 2), (2, "c", 50, 90, 1), (3, "c", 0, 300, 1)], "line int, chrom string, start long, end long, state int")
    failed = spark.createDataFrame([(3,), (9,)], "line int")
    one, two = (rows(report.raster(alleles, segs, failed, bound=b).select("chrom", "pos", "line", "x", "gt", "dosage")) for b in (1 << 20, 0))
    assert one == two and len(one) == 42 * 4
    counts = spark.createDataFrame([("l", "c", 1, 2, 0)], "line string, contig string, pos long, ref long, alt long")
    none = qc.line_marker_qc(counts, counts.select("contig", "pos").limit(0), counts.select("line"), 5, 0).first()
    assert (none.contig, none.reason, none.line_pass) == (".", "no_markers", False)
    index = spark.createDataFrame([("c", 1000)], "chrom string, length long")
    assert qc.span_share(index, "c", 1, 5000) == 1.0 and qc.span_share(index, "c", 501) == 0.5
    with pytest.raises(labels.GuardError):
        qc.span_share(index, "d")


def test_guards_of_options_entries_and_ranges(spark):
    labels.check_options({"eps0": 0.01, "role": "line", "prior_source": None})
    with pytest.raises(labels.GuardError, match="eps0.*color.*role.*required|required.*eps0"):
        labels.check_options({"eps0": 2, "color": 1, "role": "x"}, required=("plants",))
    labels.check_entry("cram", {"input": "a", "outdir": "b", "fasta": "c"})
    with pytest.raises(labels.GuardError, match="regions"):
        labels.check_entry("genotype", {"input": "a", "outdir": "b", "fasta": "c", "lowcopy_bed": "d"})
    with pytest.raises(labels.GuardError):
        labels.check_entry("other", {})
    ranges = spark.createDataFrame([("c", 0, 10)], "chrom string, start long, end long")
    with pytest.raises(labels.GuardError):
        intervals.region_bed(ranges, ["chrom"], 20, 30, allow_empty=False)
    assert intervals.one_based(ranges).first().region == "c:1-10"
    records = spark.createDataFrame([("s", "t", "m")], "sample string, written_for string, markdup string")
    samples = spark.createDataFrame([("s",), ("u",)], "sample string")
    assert rows(labels.check_provenance(records, samples, "m", "warn")) == [("s", "sample"), ("u", "no record")]
    with pytest.raises(labels.GuardError):
        labels.check_provenance(records, samples, "m")


def test_corrections(spark):
    df = spark.createDataFrame([("a", "x"), ("b", None), ("c", "z")], "id string, v string")
    fixes = spark.createDataFrame([("C2", "a", "v", "resolved", "x", "n2"), ("C1", "a", "v", "resolved", "q", "n1"), ("C3", "b", "v", "raw", "x", "n3"), ("C4", "c", "w", "resolved", "z", "n4"), ("C5", "b", "v", "resolved", None, None)], "correction_id string, id string, field string, applies_to string, old_value string, new_value string")
    good, odd = labels.correct(df, fixes, "id", "v")
    assert rows(good.select("id", "v_resolved", "correction_ids")) == [("a", "n2", "C1;C2"), ("b", None, "C3;C5"), ("c", "z", "C4")]
    assert rows(odd.select("correction_id", "id")) == [("C1", "a")]


def test_sheet_rules_and_stored_files(spark, tmp_path):
    here = tmp_path / "there.txt"
    here.write_bytes(b"body END")
    schema = T.StructType([T.StructField("id", T.StringType()), T.StructField("file", T.StringType())])
    sheet = tmp_path / "s.csv"
    sheet.write_text(f"id,file\ns1,{here}\ns2,\n")
    assert readers.sheet(spark, str(sheet), schema, unique=("id",), patterns={"id": "s[0-9]"}, domains={"id": ("s1", "s2")}, files=("file",)).count() == 2
    for kw in ({"patterns": {"id": "x"}}, {"domains": {"id": ("s1",)}}):
        with pytest.raises(labels.GuardError):
            readers.sheet(spark, str(sheet), schema, **kw)
    sheet.write_text("id,file\ns1,/none/such\n")
    with pytest.raises(labels.GuardError, match="no file"):
        readers.sheet(spark, str(sheet), schema, files=("file",))
    paths = spark.createDataFrame([(str(here),), (str(tmp_path / "gone"),)], "path string")
    assert {r.path: r.complete for r in readers.stored(spark, paths, end=b"END").collect()} == {str(here): True, str(tmp_path / "gone"): False}
    assert not any(r.complete for r in readers.stored(spark, paths, index=".idx").collect())
    assert readers.tsv(spark, str(tmp_path / "none.tsv"), schema).count() == 0
    assert [r.name for r in readers.raw_files(spark, str(tmp_path), "*.txt").collect()] == ["there.txt"]


def test_worksheets(spark, tmp_path):
    ns = 'xmlns="http://schemas.openxmlformats.org/spreadsheetml/2006/main"'
    with zipfile.ZipFile(tmp_path / "b.xlsx", "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook {ns}><sheets><sheet name="A"/><sheet name="B"/></sheets></workbook>')
        z.writestr("xl/sharedStrings.xml", f"<sst {ns}><si><t>name</t></si><si><r><t>two</t></r><r><t> runs</t></r></si></sst>")
        z.writestr("xl/worksheets/sheet1.xml", f"<worksheet {ns}><sheetData/></worksheet>")
        z.writestr("xl/worksheets/sheet2.xml", f'<worksheet {ns}><sheetData><row><c r="A1" t="s"><v>0</v></c><c r="C1" t="inlineStr"><is><t>flag</t></is></c></row><row><c r="A2" t="s"><v>1</v></c><c r="C2" t="b"><v>1</v></c></row><row/><row><c r="A3"><v>3.0</v></c><c r="B3"><v>9</v></c></row><row><c r="C4"><v>2.5</v></c></row></sheetData></worksheet>')
    got = readers.xlsx(spark, str(tmp_path / "b.xlsx"), "B")
    assert got.columns == ["name", "flag"] and rows(got) == sorted([("two runs", "TRUE"), ("3", None), (None, "2.5")], key=repr)
    with pytest.raises(labels.GuardError):
        readers.xlsx(spark, str(tmp_path / "b.xlsx"), "C")


def test_sinks_replace_together_or_not_at_all(spark, tmp_path):
    a, b = str(tmp_path / "a"), str(tmp_path / "b")
    one, two = spark.range(2), spark.range(5)
    sinks.swap({a: one, b: one})
    with pytest.raises(Exception):
        sinks.swap({a: two, b: two.select(F.raise_error(F.lit("no")).alias("x"))})
    assert spark.read.parquet(a).count() == 2 and spark.read.parquet(b).count() == 2
    sinks.swap({a: two, b: two})
    assert spark.read.parquet(a).count() == 5 and not (tmp_path / "a.before").exists()
    sinks.write_provenance(spark, str(tmp_path / "p.json"), {"b": 1, "a": [2]})
    assert (tmp_path / "p.json").read_text().startswith('{\n "a"')
    with pytest.raises(labels.GuardError):
        sinks.write_provenance(spark, str(tmp_path / "p.json"), {})
    assert sinks.checkpoint_step(one, str(tmp_path), "step").count() == 2 and sinks.checkpoint_step(two, str(tmp_path), "step").count() == 2
    assert ("u", "posterior", "0.999") in rows(sinks.run_info(spark, "u", gaps.GapOptions(), extra="x").select("unit", "name", "value"))
    sinks.collect_file([one, two], str(tmp_path / "c"), ["id"])
    assert len(spark.read.text(str(tmp_path / "c")).collect()) == 8


def test_counts_at_markers_and_members(spark):
    long = spark.createDataFrame([((1,), "s", "c", 5, "A", ["C"], [3, 1]), ((2,), "s", "c", 5, "A", ["C"], [9, 9]), ((3,), "s", "c", 6, "AT", ["C"], [1, 1]), ((4,), "s", "c", 7, "G", ["C"], [1, 1]), ((5,), "s", "c", 8, "A", ["C"], [1, 1]), ((6,), "t", "c", 5, "a", ["<*>"], [4])], "at struct<n:int>, sample string, chrom string, pos long, ref string, alts array<string>, ad array<int>")
    good, left = readers.marker_counts(long, spark.createDataFrame([("c", p, "A", "C") for p in (5, 6, 7)], "chrom string, pos long, ref string, alt string"))
    assert rows(good) == [("s", "c", 5, 3, 1), ("t", "c", 5, 4, 0)]
    assert rows(left) == [("indel", 1), ("not_marker", 1), ("ref_mismatch", 1), ("repeat", 1)]
    got = spark.createDataFrame([("a.tar:x/y;a.tar:z;;p",), (None,)], "t string").select(readers.tar_members(F.col("t")).alias("m")).collect()
    assert [tuple(x) for x in got[0].m] == [("a.tar", "x/y", 1), ("a.tar", "z", 2), (None, "p", 3)] and got[1].m is None


def test_dataflow_steps(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "k int, v string")
    got = groups.branch(df, {"low": F.col("k") < 2, "b": F.col("v") == "b"}, "rest")
    assert {n: rows(d) for n, d in got.items()} == {"low": [(1, "a")], "b": [(2, "b")], "rest": [(3, None)]}
    assert set(groups.branch(df, {"low": F.col("k") < 2})) == {"low"}
    assert groups.combine_by(df.select("v", "k"), df.select("v", F.col("k").alias("w")), ["v"]).count() == 3
    assert rows(groups.join_remainder(df.select("k", "v"), spark.createDataFrame([(1, 5), (9, 6)], "k int, n int"), ["k"], {"v": "none", "n": 0})) == sorted([(1, "a", 5), (2, "b", 0), (3, "none", 0), (9, "none", 6)])
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "x.csv").write_text("1\n2\n")
    seen = []
    query = groups.subscribe(spark.readStream.schema("k int").csv(str(tmp_path / "in")), lambda batch, _: seen.extend(r.k for r in batch.collect()), str(tmp_path / "cp"))
    query.awaitTermination(60)
    assert sorted(seen) == [1, 2]


def test_a_cluster_without_a_shared_folder_is_refused(spark, monkeypatch):
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Conf:
        def get(self, *_):
            return None

    class Session:
        sparkContext, conf = Context(), Conf()

    class Frame:
        sparkSession = Session()

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        session.durable(Frame())


def test_stamps_counts_and_quantiles(spark):
    assert spark.range(1).select(labels.utc_stamp().alias("t")).first().t.endswith("Z")
    got = report.qq_points(spark.createDataFrame([(0.5,), (0.5,), (0.01,), (None,)], "p double"), "p").orderBy("p").collect()
    assert [(r.p, r.k) for r in got] == [(0.01, 1), (0.5, 2)] and got[0].expected > got[1].expected
    lines = spark.createDataFrame([("f", (s, n), x) for s, n, x in ((0, 0, "@1"), (0, 1, "AC"), (0, 2, "+"), (50, 3, "II"), (50, 4, "@2"), (50, 5, "GT"), (90, 6, "+"), (90, 7, "II"))], "file string, at struct<split:long,n:long>, line string")
    assert rows(readers.fastq(lines)) == [("f", 0, "AC"), ("f", 1, "GT")] and rows(readers.fastq(lines, 1)) == [("f", 0, "AC")]


def test_windows_along_a_line_in_parts(spark):
    import random

    rng = random.Random(9)
    data = [(g, s, s + rng.randint(1, 30)) for g in ("a", None) for s in (rng.randint(-300, 2000) for _ in range(120))] + [("a", 5, None), ("a", None, 7)]
    df = spark.createDataFrame(data, "g string, start long, end long")
    for touch in (0, 1):
        whole, parts = (rows(intervals.merge_intervals(df, ["g"], touch=touch, part=p)) for p in (1 << 22, 16))
        assert whole == parts
        covered = {(g, x) for g, s, e in data if s is not None and e is not None for x in range(s, e + touch)}
        assert {(g, x) for g, s, e in whole for x in range(s, e + touch)} == covered
    marks = spark.createDataFrame([(g, rng.randint(0, 50)) for g in ("a", "b", None) for _ in range(60)], "g string, pos long")
    points = spark.createDataFrame([(g, i, i / 2) for i, g in enumerate(["a", "b", "z", None] * 30)], "g string, id int, pos double")
    every = marks.collect()
    for part in (1 << 22, 7):
        got = intervals.marker_ranks(points, marks, ["g"], part=part).collect()
        assert len(got) == 120 and all(r.rank == sum(m.g == r.g and m.pos < r.pos for m in every) for r in got)


def test_cleanup_lists_and_lanes(spark):
    f = spark.createDataFrame([("L", "/a'b", 5, True, False), ("L", "/c", 6, True, True), ("M", "/d", 1, True, False), ("N", "/e", None, None, None)], "library string, path string, bytes long, complete boolean, in_use boolean")
    assert rows(report.cleanup_report(f)) == sorted([("L", 2, 11, 1, 5, "no"), ("M", 1, 1, 1, 1, "yes"), ("N", 1, None, 0, 0, "no")], key=repr)
    assert rows(report.cleanup_commands(f)) == [("L", "rm -- '/a'\\''b'"), ("M", "rm -- '/d'")]
    one = spark.createDataFrame([("s", "AC"), ("t", "GG")], "sample string, seq string")
    merged = reads.merge_lanes({"2": one, "1": one.where("sample = 's'")}, ["sample"])
    assert merged.columns == ["sample", "lane", "seq"] and rows(reads.lane_totals(merged, ["sample"])) == [("s", 2, "1,2"), ("t", 1, "2")]


def test_workers_get_the_package_only_where_they_lack_it(spark, monkeypatch, tmp_path):
    sent = []

    class Session:
        class sparkContext:
            addPyFile = staticmethod(sent.append)

    session.ship(Session())
    assert sent == []  # the working folder or PYTHONPATH has it
    monkeypatch.chdir(tmp_path)
    monkeypatch.setenv("PYTHONPATH", "")
    other = Session()
    session.ship(other)
    session.ship(other)
    assert len(sent) == 1 and "seedwork/session.py" in zipfile.ZipFile(sent[0]).namelist()


def test_quotes_in_runs_pair_up_from_the_left():
    import pyarrow as pa

    from seedwork.operators.packed import split_packed

    got = split_packed(pa.array(["\"a\"\"\"\"b\" 'x'", "'it''s' \"q\"", "\"\"\"\" 'y'"]), ";").to_pylist()
    assert got == [['a""b', "x"], ["it's", "q"], ['"', "y"]]


def test_guards_of_stages_folders_and_sheets(spark):
    present = spark.createDataFrame([("a",)], "path string")
    needed = spark.createDataFrame([("a", "one"), ("b", "three"), ("c", "two")], "path string, stage string")
    with pytest.raises(labels.GuardError, match="2 inputs.*c: run two first"):
        labels.check_upstream(present, needed, ("one", "two", "three"))
    labels.check_upstream(needed, needed, ("one",))
    labels.check_held(["a", "b"], ["b"], 2)
    with pytest.raises(labels.GuardError, match="besides: c"):
        labels.check_held(["a", "b"], ["c"], 2)
    labels.check_output_root("/x/subsample_5", "/p", subsample=5)
    labels.check_output_root("/x/stub_1/out", "/p", stub=True)
    for path, kw in (("/x/out", {"subsample": 5}), ("/x/subsample_5", {}), ("/x/out", {"stub": True}), ("/p/stub_1", {"stub": True})):
        with pytest.raises(labels.GuardError):
            labels.check_output_root(path, "/p", **kw)
    with pytest.raises(labels.GuardError, match="without a value"):
        labels.check_entry("cram", {"input": True, "outdir": "b", "fasta": "c"})
    s = spark.createDataFrame([("s1", "x"), ("s2", "x"), ("s3", "y")], "sample string, source string")
    a = spark.createDataFrame([("s1", 1, 2, "own")], "sample string, mask_r1 int, mask_r2 int, mask_source string")
    b = spark.createDataFrame([("x", 12, 0, "lib")], "source string, mask_r1 int, mask_r2 int, mask_source string")
    assert rows(labels.mask_rules(s, a, b).select("sample", "mask_r1", "mask_from")) == [("s1", 1, "sample"), ("s2", 12, "source"), ("s3", None, "none")]
    sheet = spark.createDataFrame([("ok", "line", "d", "t", "TRUE", 1), ("a.b", "line", "d", "t", "true ", 1), ("two", "line", None, None, "no", 1), ("two", "x", "d", None, "TRUE", None), ("c", "b73_control", None, None, "FALSE", 0), (None, None, None, None, None, None)], "sample string, role string, donor string, taxon string, include string, mask_r1 int")
    got = labels.sheet_errors(sheet, ("line", "b73_control"))
    assert rows(got) == sorted([("a.b", "sample_id"), ("two", "duplicate"), ("two", "no_donor"), ("two", "include"), ("two", "role"), ("two", "no_taxon"), ("two", "no_mask"), (None, "sample_id"), (None, "role"), (None, "include"), (None, "no_mask")], key=repr)
    with pytest.raises(ValueError, match="beta"):
        gaps.GapOptions(alpha=3, beta=2)
    obs = spark.createDataFrame([(1, 1, 0, 4), (2, 1, 0, 8), (3, 1, 1, 9)], "key int, line int, x int, n int")
    assert gaps.line_depths(obs, obs.where("key <> 2")).first().lam == 4.0 and gaps.line_depths(obs).first().lam == 6.0


def test_indexed_lookup_of_segments(spark):
    import random

    rng = random.Random(4)
    segs, at = [], -50
    for i in range(60):
        at += rng.choice([1, 1, 2, 40, 300])
        end = at + rng.choice([0, 1, 5, 60])
        segs.append((1, at, end, i % 3))
        at = end
    df = spark.createDataFrame(segs + [(2, 7, 7, 1)], "line int, start long, end long, state int")
    for cells in (1, 7, 256):
        index = intervals.segment_index(df, ["line"], cells=cells).select("line", F.struct("segs", "low", "width", "begun").alias("i"))
        points = spark.range(-60, at + 20).withColumnRenamed("id", "pos").crossJoin(spark.createDataFrame([(1,), (2,), (3,)], "line int"))
        got = points.join(index, "line", "left").select("line", "pos", intervals.state_in("i", F.col("pos")).alias("x")).collect()
        for r in got:
            begun = [s for s in (segs if r.line == 1 else [(2, 7, 7, 1)] if r.line == 2 else []) if s[1] <= r.pos]
            assert r.x == (begun[-1][3] if begun and begun[-1][2] >= r.pos else None), (cells, r)
