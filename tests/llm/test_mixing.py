import pytest
from pyspark.sql import functions as F

pytest.importorskip("seedwork.llm")
from seedwork.llm.mixing import mix, shares  # noqa: E402


def tokens(spark, n=4000):
    base = spark.range(n).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 10 < 7, "big").when(F.col("id") % 10 < 9, "mid").otherwise("small").alias("source"), (F.pmod(F.xxhash64("id"), F.lit(200)) + 1).alias("n_tokens"))
    return base.union(spark.createDataFrame([(-1, None, 5), (-2, "big", 0), (-3, "stray", 9)], "doc_id long, source string, n_tokens long"))


def targets(spark, data):
    return spark.createDataFrame(data, "source string, target_share double, max_repeats int")


def test_shares_caps_and_zero_cases(spark):
    mixed, tilts = mix(tokens(spark), targets(spark, [("big", 0.5, 2), ("mid", 0.2, 2), ("small", 0.2, 3), ("absent", 0.1, 4), ("small", 0.2, 3), (None, 0.3, 1)]))
    got = {r.source: r for r in shares(mixed, tilts).collect()}
    for s in ("big", "mid", "small"):
        assert abs(got[s].actual_share - got[s].aimed_share) < 0.005
    assert got["small"].most_copies == 3 and got["big"].most_copies <= 2 and got["absent"].tokens == 0 and got["absent"].target_share == 0.1
    assert got[None].copies == 0 and got["stray"].copies == 0
    assert mixed.where("n_tokens = 0").first().copies == 0
    assert mixed.count() == 4003


def test_tilt_solves_the_constraint(spark):
    _, tilts = mix(tokens(spark), targets(spark, [("big", 0.3, 1), ("mid", 0.7, 5)]), total=60_000)
    rows = tokens(spark).groupBy("source", "n_tokens").count().collect()
    import math

    for t in tilts:
        used = sum(r["count"] * r.n_tokens * min(t.cap, math.exp(t.multiplier * r.n_tokens / t.mean)) for r in rows if r.source == t.source and r.n_tokens > 0)
        assert abs(used - t.goal) < 1e-5 * t.goal


def test_hot_size_in_parts_and_shortfall(spark):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.lit("a").alias("source"), F.lit(10).cast("long").alias("n_tokens"))
    mixed, _ = mix(df, targets(spark, [("a", 1.0, 4)]), total=45_000, part_rows=100)
    used = mixed.agg(F.sum(F.col("copies") * 10)).first()[0]
    assert abs(used - 45_000) <= 10 * 35
    mixed, tilts = mix(df, targets(spark, [("a", 1.0, 2)]), total=10**9)
    assert mixed.agg(F.min("copies"), F.max("copies")).first()[:] == (2, 2) and tilts[0].goal == 60_000


def test_empty(spark):
    df = tokens(spark).limit(0)
    mixed, tilts = mix(df, targets(spark, [("big", 1.0, 1)]))
    assert mixed.count() == 0 and shares(mixed, tilts).count() == 1
    mixed, _ = mix(tokens(spark), targets(spark, []))
    assert mixed.agg(F.sum("copies")).first()[0] == 0


def test_parts_spread_a_hot_size_and_other_sources_stay_behind(spark):
    df = spark.range(20_000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, F.concat(F.lit("other"), (F.col("id") % 5000).cast("string"))).otherwise("a").alias("source"), F.lit(7).cast("long").alias("n_tokens"), F.lit("x").alias("rate"))
    mixed, tilts = mix(df, targets(spark, [("a", 1.0, 2)]), total=100_000, part_rows=500, max_sources=5)
    assert [t.source for t in tilts] == ["a"] and tilts[0].residual < 1e-6 and tilts[0].docs > 13_000
    assert mixed.count() == 20_000 and mixed.columns == ["doc_id", "source", "n_tokens", "rate", "copies"]
    assert abs(mixed.agg(F.sum(F.col("copies") * 7)).first()[0] - 100_000) <= 7 * 30
    assert mixed.where("source <> 'a'").agg(F.max("copies")).first()[0] == 0
    plan = mixed._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(source" in plan and "__part" in plan.split("hashpartitioning(source")[1][:60]


def test_more_targets_than_allowed(spark):
    with pytest.raises(ValueError, match="more than 1"):
        mix(tokens(spark), targets(spark, [("big", 0.5, 2), ("mid", 0.5, 2)]), max_sources=1)
