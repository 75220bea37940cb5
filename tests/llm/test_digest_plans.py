"""Rounds of merging and both ways of counting give the same certified answers."""

import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("seedwork.llm")
from seedwork.llm import digest  # noqa: E402
from tests.conftest import rows  # noqa: E402
from tests.llm.test_digest import error, frame  # noqa: E402


def data(spark):
    rng = random.Random(11)
    held = [(None if i % 9 == 0 else "hot" if i % 3 else f"g{i % 40}", i % 50, rng.expovariate(1), float(rng.randint(-1, 3))) for i in range(8000)]
    return frame(spark, held + [("nan", 0, float("nan"), None)])


def test_both_ways_of_counting_agree(spark):
    df = data(spark)
    made = digest.estimate(digest.merge(digest.digests(df, ("g", "day"), ("x", "y")), ("g",)))
    one, two = (rows(digest.certify(df, made, ("g",), ("x", "y"), broadcast_groups=k).select("g", "metric", "n", "q", "estimate", "rank_error")) for k in (1000, 1))
    assert one == two and len(one) == 5 * made.select("g", "metric").distinct().count()


def test_merging_in_rounds_keeps_weights_and_the_bound(spark):
    df = data(spark)
    parts = digest.digests(df, ("g", "day"), ("x",))
    held = {r.g: r for r in digest.merge(parts, ("g",), fan_in=3).collect()}
    values = {}
    for r in df.where(~F.isnan("x")).collect():
        values.setdefault(r.g, []).append(r.x)
    assert {g: r.n for g, r in held.items()} == {g: len(v) for g, v in values.items()}
    assert all(sum(c.w for c in r.centroids) == r.n for r in held.values())
    for r in digest.estimate(digest.merge(parts, ("g",), fan_in=3)).collect():
        assert error(sorted(values[r.g]), r.q, r.estimate) <= digest.BOUND


def test_counting_continuous_values_shuffles_counts_only(spark):
    df = data(spark)
    made = digest.estimate(digest.merge(digest.digests(df, ("g",), ("x",)), ("g",)))
    plan = digest.certify(df, made, ("g",), ("x",))._jdf.queryExecution().executedPlan().toString()
    before = plan[: plan.index("BroadcastHashJoin")]  # what is done with the rows after they met the estimates
    assert "HashAggregate(keys=[g" in before.split("Exchange hashpartitioning")[-1]  # counted before the first shuffle; long lists of functions are not printed
