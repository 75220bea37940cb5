import bisect
import math
import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("seedwork.llm")
from seedwork.llm import digest  # noqa: E402


def frame(spark, data):
    return spark.createDataFrame(data, "g string, day int, x double, y double")


def error(values, q, x):
    n = len(values)
    aim = max(1, math.ceil(n * q - 1e-9))
    lo, hi = bisect.bisect_left(values, x), bisect.bisect_right(values, x)
    return max(0, lo + (1 if hi > lo else 0) - aim, aim - max(hi, lo + 1)) / n


def test_errors_are_what_they_are_said_to_be(spark):
    rng = random.Random(3)
    data = [("hot", i % 3, rng.lognormvariate(0, 2), float(rng.choice([0, 0, 0, 1, 2]))) for i in range(30000)]
    data += [("few", 0, float(i), None) for i in range(7)] + [(None, 1, 5.0, -1.0), ("few", 1, float("nan"), 3.0), ("none", 1, None, -2.0)]
    df = frame(spark, data).repartition(5)
    parts = digest.digests(df, ("g", "day"), ("x", "y"))
    got = digest.percentiles(df, parts, ("g",), ("x", "y")).collect()
    by = {}
    for g, _, x, y in data:
        for m, v in (("x", x), ("y", y)):
            if v is not None and v == v and v >= 0:
                by.setdefault((g, m), []).append(v)
    for v in by.values():
        v.sort()
    assert len(got) == len(digest.QUANTILES) * len(by)
    for r in got:
        e = error(by[(r.g, r.metric)], r.q, r.estimate)
        assert abs(e - r.rank_error) < 1e-12 and e <= r.error_bound and r.n == len(by[(r.g, r.metric)])
    # The digests are bounded, whatever the number of rows.
    assert parts.agg(F.max(F.size("centroids"))).first()[0] < digest.DELTA


def test_a_bound_that_digests_miss_is_met_exactly(spark):
    rng = random.Random(5)
    df = frame(spark, [("a", 0, rng.random(), 1.0) for _ in range(5000)])
    got = digest.percentiles(df, digest.digests(df, ("g",), ("x",), delta=20), ("g",), ("x",), delta=20, bound=0.0001)
    values = sorted(r.x for r in df.collect())
    for r in got.collect():
        assert error(values, r.q, r.estimate) <= 0.0001 and r.rank_error <= 0.0001


def test_merging_loads_gives_the_same_counts(spark):
    df = frame(spark, [("a", d, float(v), 0.0) for d in range(4) for v in range(50)])
    one = digest.merge(digest.digests(df.where("day < 2"), ("g", "day"), ("x",)).unionByName(digest.digests(df.where("day >= 2"), ("g", "day"), ("x",))), ("g",)).first()
    assert one.n == 200 and sum(c.w for c in one.centroids) == 200 and one.centroids[0].lo == 0 and one.centroids[-1].hi == 49


def test_empty_tables_and_repeats(spark):
    df = frame(spark, [("a", 0, 1.0, None)] * 3)
    assert digest.percentiles(df.limit(0), digest.digests(df.limit(0), ("g",), ("x",)), ("g",), ("x",)).count() == 0
    assert {(r.estimate, r.n) for r in digest.percentiles(df, digest.digests(df, ("g",), ("x",)), ("g",), ("x",)).collect()} == {(1.0, 3)}
