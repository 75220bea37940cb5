import datetime as dt
import random

from pyspark.sql import functions as F

from seedwork.operators.orphans import bloom_size, bloom_words, find_orphans, may_contain, orphans_by_period
from tests.conftest import rows


def day(n):
    return None if n is None else dt.datetime(2020, 1, 1) + dt.timedelta(days=n)


def refs(spark, data):
    return spark.createDataFrame([(i, r, day(t)) for i, (r, t) in enumerate(data)], "row_id long, ref string, at timestamp_ntz").withColumn("kind_", F.lit("mine")).withColumn("key", F.lit("clash"))


def parents(spark, data):
    return spark.createDataFrame([(k, day(a), day(b)) for k, a, b in data], "key string, begin timestamp_ntz, end timestamp_ntz")


def found(r, p, **kw):
    return [tuple(x) for x in find_orphans(r, p, ref="ref", at="at", key="key", begin="begin", end="end", **kw).select("row_id", "kind").orderBy("row_id").collect()]


def test_kinds_and_edges(spark):
    p = parents(spark, [("A", 0, 10), ("A", 20, None), (" B ", 5, None), ("C", None, None), ("D", 0, 5), ("D", 5, 8), ("A", 0, 10)])
    r = refs(spark, [("A", 0), ("A", 10), ("A", 15), ("A", 20), ("A", -1), ("B", 5), (" B", 4), ("a", 5), ("C", 3), ("", 1), ("NA", 1), (None, 1), ("Z", 1), ("D", 5), ("D", 8), ("A", None), ("A", 15)])
    assert found(r, p) == [(1, "deleted"), (2, "deleted"), (4, "late"), (6, "late"), (7, "missing"), (8, "deleted"), (12, "missing"), (14, "deleted"), (15, "deleted"), (16, "deleted")]


def test_empty_tables(spark):
    p, r = parents(spark, [("A", 0, None)]), refs(spark, [("A", 1)])
    assert found(r, p.limit(0)) == [(0, "missing")]
    assert found(r.limit(0), p) == []


def test_against_brute_force_with_and_without_broadcast_and_with_a_tiny_filter(spark):
    rng = random.Random(7)
    ps = [(f"k{rng.randint(0, 40)}", rng.choice([None, *range(30)]), rng.choice([None, *range(60)])) for _ in range(90)]
    rs = [(f"k{rng.choice([0] * 20 + list(range(60)))}", rng.randint(-5, 60)) for _ in range(600)]

    def kind(k, t):
        own = [(a, b) for n, a, b in ps if n == k]
        if not own:
            return "missing"
        if any(a is not None and a <= t and (b is None or b > t) for a, b in own):
            return None
        return "late" if all(a is not None and a > t for a, _ in own) else "deleted"

    want = [(i, kind(k, t)) for i, (k, t) in enumerate(rs) if kind(k, t)]
    for kw in ({}, {"broadcast_rows": 0}, {"max_bits": 64}):
        assert found(refs(spark, rs), parents(spark, ps), **kw) == want


def test_filter_has_no_false_negatives_and_few_false_positives(spark):
    bits, hashes = bloom_size(5000, 0.01)
    words = bloom_words(spark.range(5000).select(F.col("id").cast("string").alias("k")), "k", bits, hashes).scalar()
    probe = spark.range(20000).select(F.col("id"), F.col("id").cast("string").alias("k")).withColumn("m", may_contain(words, F.col("k"), bits, hashes))
    got = probe.groupBy((F.col("id") < 5000).alias("own")).agg(F.avg(F.col("m").cast("int")).alias("share")).collect()
    share = {r["own"]: r["share"] for r in got}
    assert share[True] == 1.0 and share[False] < 0.03
    assert bloom_size(10**12)[0] <= 1 << 26 and bloom_size(0)[0] == 64


def test_counts_per_month(spark):
    r = refs(spark, [("Z", 1), ("Z", 2), ("Z", 40)]).withColumn("kind", F.lit("missing")).withColumn("t", F.lit("tab"))
    assert rows(orphans_by_period(r, "t", "at")) == [("tab", "2020-01", "missing", 2), ("tab", "2020-02", "missing", 1)]
