import math

import pytest
from pyspark.sql import functions as F

pytest.importorskip("seedwork.llm")
from seedwork.llm import queries  # noqa: E402
from seedwork.session import table  # noqa: E402


@pytest.mark.parametrize("name,group", [("p2_days", "day"), ("p2_runs", "run_id")])
def test_days_and_runs_are_certified(spark, sf, name, group):
    got = queries.QUERIES[name](spark, sf).collect()
    obs = table(spark, sf, "ancestry_obs").withColumn("day", F.to_date("loaded_at")).select(group, "ref_count", "alt_count").collect()
    values = {}
    for r in obs:
        for metric in ("ref_count", "alt_count"):
            if r[metric] is not None and r[metric] >= 0:
                values.setdefault((r[group], metric), []).append(r[metric])
    assert {(r[group], r["metric"]) for r in got} == set(values) and len(got) == 5 * len(values)
    for r in got:
        v = values[r[group], r["metric"]]
        below, upto, aim = sum(x < r["estimate"] for x in v), sum(x <= r["estimate"] for x in v), max(1, math.ceil(len(v) * r["q"] - 1e-9))
        first, last = (below + 1, upto) if upto > below else (below, below + 1)
        assert r["n"] == len(v) and max(0, first - aim, aim - last) / len(v) <= r["rank_error"] + 1e-9 <= r["error_bound"] + 1e-9 == 0.01 + 1e-9
