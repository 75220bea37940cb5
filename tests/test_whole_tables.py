"""Queries over whole tables: no line and no row is left out."""

import re
from collections import Counter

from pyspark.sql import functions as F

from seedwork.operators import reads
from seedwork.plans import bindings, cohort_queries, registry
from seedwork.session import table


def test_rasters_and_densities_hold_all_lines(spark, sf):
    lines = {r.line for r in bindings.segments(spark, sf).select("line").distinct().collect()}
    q = registry.queries()
    assert {r.line for r in q["raster_long"](spark, sf).select("line").distinct().collect()} == lines
    assert {r.line for r in q["breakpoint_density"](spark, sf).select("line").collect()} == lines | {None}
    assert q["raster_matrix"](spark, sf).columns == ["site", *[f"line_{i}" for i in range(40)]]


def test_ranges_hold_every_row(spark, sf):
    assert cohort_queries._ranges(spark, sf).count() == table(spark, sf, "lineitem").count()
    days = {(r.chrom, d) for r in cohort_queries._ranges(spark, sf).collect() for d in range(r.start, r.end)}
    assert {(r.chrom, d) for r in registry.queries()["interval_merge"](spark, sf).collect() for d in range(r.start, r.end)} == days


def test_open_last_bin(spark):
    a = spark.createDataFrame([("s", 0, 5, "1500H3M", "ACG", "III")], "sample string, flag int, pos long, cigar string, seq string, qual string")
    got = reads.cycle_counts(a, spark.createDataFrame([(5, "A", "C"), (7, "A", "G")], "pos long, ref string, alt string"), a.select("sample"))
    assert [(r.n_ref, r.n_alt) for r in got.where((F.col("mate") == 1) & (F.col("bin") == 7)).collect()] == [(1, 1)] and got.count() == 16


def test_cycle_counts_reads_a_whole_table(spark, sf):
    sites = {(f"chr{r.p_partkey % 5 + 1}", r.p_partkey % 2411) for r in table(spark, sf, "part").select("p_partkey").collect()}
    want = Counter()
    for r in cohort_queries._alignments(spark, sf).collect():
        pos, q, lead = r.pos, 0, 0
        ops = [(int(n), op) for n, op in re.findall(r"(\d+)([A-Z])", r.cigar)]
        lead = ops[0][0] if ops[0][1] == "H" else 0
        for n, op in ops:
            for _ in range(n):
                if op == "M" and (r.rname, pos) in sites and (r.qual == "*" or ord(r.qual[q]) - 33 >= 20):
                    cycle = lead + len(r.seq) - (lead + q) if r.flag & 16 else lead + q + 1
                    b = next(i for i, (lo, hi) in enumerate(reads.BINS) if lo <= cycle and (hi is None or cycle <= hi))
                    ref, alt = "ACGT"[pos % 4], "ACGT"[(pos + 1) % 4]
                    for who in (r.sample, None):  # null stands for all samples together
                        want[who, 2 if r.flag & 128 else 1, b, "n"] += 1
                        want[who, 2 if r.flag & 128 else 1, b, "ref" if r.seq[q] == ref else "alt" if r.seq[q] == alt else "other"] += 1
                pos += op in "MDN"
                q += op in "MI"
    got = registry.queries()["cycle_counts"](spark, sf).collect()
    assert any(r.sample is None and r.n for r in got)
    assert want and any(r.bin == 7 and r.n for r in got)
    for r in got:
        k = (r.sample, r.mate, r.bin)
        assert (r.n, r.n_ref, r.n_alt, r.n_other) == tuple(want[(*k, c)] for c in ("n", "ref", "alt", "other"))


def test_bases_count_at_sites_of_their_own_chromosome(spark):
    a = spark.createDataFrame([("s", 0, "c1", 5, "3M", "ACG", "III"), ("s", 0, "c2", 5, "3M", "ACG", "III")], "sample string, flag int, rname string, pos long, cigar string, seq string, qual string")
    sites = spark.createDataFrame([("c1", 5, "A", "C"), ("c3", 6, "C", "G")], "rname string, pos long, ref string, alt string")
    got = reads.cycle_counts(a, sites, a.select("sample"), whole=True)
    assert {(r.sample, r.n, r.n_ref) for r in got.where("n > 0").collect()} == {("s", 1, 1), (None, 1, 1)}
    assert [(r.rname, r.pos, list(r.ad)) for r in reads.count_alleles(a.withColumn("mapq", F.lit(60)), sites).collect()] == [("c1", 5, [1, 0])]
