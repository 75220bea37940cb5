"""One method for keys of any size: the report is of least cost and the same, whatever ``limit`` and the order of rows."""

import random
from collections import Counter

import numpy as np

from seedwork.operators.copy_diff import _Pairing, diff_copies
from tests.conftest import rows


def test_limit_and_order_change_nothing(spark):
    rng = random.Random(5)
    schema = "k string, " + ", ".join(f"c{i} string" for i in range(5))
    data = [[(k, *[rng.choice(("x", "y", "z", None)) for _ in range(5)]) for k in ("one", "two", None) for _ in range(n)] for n in (60, 70)]
    want = rows(diff_copies(*[spark.createDataFrame(d, schema) for d in data], ["k"]))
    for d in data:
        rng.shuffle(d)
    frames = [spark.createDataFrame(d, schema).repartition(3) for d in data]
    for limit in (1, 4, 25):
        assert rows(diff_copies(*frames, ["k"], limit=limit)) == want


def test_far_partners_are_found_beyond_the_default_limit(spark):
    """Partners agree in two columns of eight, all other pairs in none: 1,000 rows and 1,100 rows a side are paired alike."""
    schema = "k string, " + ", ".join(f"c{i} string" for i in range(8))
    for n in (1000, 1100):
        left = [("hot", *[f"a{i}" for _ in range(8)]) for i in range(n)]
        right = [("hot", *[f"a{i}" if c < 2 else f"b{i}" for c in range(8)]) for i in range(n)]
        got = rows(diff_copies(spark.createDataFrame(left, schema), spark.createDataFrame(right, schema), ["k"]))
        assert got == [("hot", f"c{c}", n) for c in range(2, 8)]


def test_prices_prove_the_least_cost():
    """Prices that no pair's cost undercuts sum up to the cost of the flow, so no other flow costs less."""
    rng = np.random.default_rng(6)
    for n, d, values in ((40, 1, 200), (300, 6, 4), (1500, 8, 6)):
        pool = rng.permutation(np.unique(rng.integers(0, values, (2 * n, d)), axis=0))
        x, y = pool[: len(pool) // 2 - 3], pool[len(pool) // 2 - 3 :]
        supply, demand = rng.integers(1, 4, len(x)), rng.integers(3, 5, len(y))
        cost = (x[:, None] != y[None]).sum(axis=2)
        flows = []
        for limit in (1, 5000):
            p = _Pairing(x, y, supply, demand, limit)
            flow = Counter({(i, j): some for j, ships in enumerate(p.solve()) for i, some in ships.items()})
            sent, got = np.zeros(len(x), int), np.zeros(len(y), int)
            for (i, j), some in flow.items():
                sent[i] += some
                got[j] += some
            assert (sent == supply).all() and (got <= demand).all()
            assert (p.u[:, None] + p.v[None] <= cost).all() and (p.v <= 0).all()
            assert sum(some * cost[at] for at, some in flow.items()) == (p.u * supply).sum() + (p.v * demand).sum()
            flows.append(flow)
        assert flows[0] == flows[1]
