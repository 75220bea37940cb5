"""Least cost with copies, against all pairings of the expanded rows."""

import itertools
import random
from collections import Counter

import numpy as np
from pyspark.sql import functions as F

from seedwork.operators.copy_diff import diff_copies, transport
from tests.conftest import rows

FIELDS = ("kind", "n")


def least(left, right):
    """Cost of the best pairing of every row of the smaller side, by brute force."""
    a, b = sorted((left, right), key=len)
    return min(sum(sum(x != y for x, y in zip(r, b[i])) for r, i in zip(a, p)) for p in itertools.permutations(range(len(b)), len(a)))


def test_transport_against_expanded_rows():
    rng = random.Random(8)
    for _ in range(150):
        n, m = rng.randint(1, 3), rng.randint(1, 3)
        cost = np.array([[rng.randint(0, 4) for _ in range(m)] for _ in range(n)], float)
        supply, demand = [rng.randint(0, 2) for _ in range(n)], [rng.randint(1, 3) for _ in range(m)]
        while sum(supply) > sum(demand):
            supply[supply.index(max(supply))] -= 1
        flow = transport(cost, np.array(supply), np.array(demand))
        assert flow.sum(axis=1).tolist() == supply and (flow.sum(axis=0) <= demand).all() and (flow >= 0).all()
        i = [k for k, s in enumerate(supply) for _ in range(s)]
        j = [k for k, d in enumerate(demand) for _ in range(d)]
        assert (flow * cost).sum() == min(sum(cost[a, b] for a, b in zip(i, p)) for p in itertools.permutations(j, len(i)))


def test_copies_are_paired_at_least_cost(spark):
    schema = "k string, a int, b int, c int, d int"
    cases = {"given": ([(1, 1, 1, 2)] * 2 + [(1, 0, 0, 0)] * 3, [(1, 1, 2, 2)] + [(0, 1, 2, 2)] * 2)}
    rng = random.Random(1)
    for i in range(60):
        pick = lambda: [tuple(rng.randint(0, 2) for _ in range(4)) for _ in range(rng.randint(1, 3)) for _ in range(rng.randint(1, 2))]
        cases[str(i)] = (pick(), pick())
    left = spark.createDataFrame([(k, *r) for k, (x, _) in cases.items() for r in x], schema)
    right = spark.createDataFrame([(k, *r) for k, (_, y) in cases.items() for r in y], schema)
    got: dict[str, Counter] = {}
    for k, kind, n in rows(diff_copies(left, right, ["k"])):
        got.setdefault(k, Counter())[kind] += n
    for k, (x, y) in cases.items():
        one, two = Counter(x), Counter(y)
        x, y = list((one - two).elements()), list((two - one).elements())
        fields = sum(n for kind, n in got.get(k, Counter()).items() if len(kind) == 1)
        assert fields == (least(x, y) if x and y else 0), k
        extra = got.get(k, Counter())
        assert extra["extra_left"] - extra["extra_right"] == len(cases[k][0]) - len(cases[k][1])


def test_values_are_compared_exactly(spark):
    big = 9007199254740992  # beyond what a double tells apart
    left = spark.createDataFrame([("1", big, float("nan"), b"a", [1]), ("1", None, 0.0, b"b", None)], "k string, i long, x double, y binary, z array<int>")
    right = spark.createDataFrame([("1", big + 1, float("nan"), b"a", [1]), ("1", None, -0.0, b"b", [])], "k string, i long, x double, y binary, z array<int>")
    assert rows(diff_copies(left, right, ["k"])) == [("1", "i", 1), ("1", "z", 1)]


def test_a_hot_key_is_numbered_in_parts(spark):
    left = spark.range(60_000).select(F.lit("hot").alias("k"), F.col("id").alias("a"), (F.col("id") % 7).alias("b"))
    right = left.withColumn("b", F.when(F.col("a") % 2 == 0, 99).otherwise(F.col("b"))).where(F.col("a") != 1)
    assert rows(diff_copies(left, right, ["k"])) == sorted([("hot", "b", 30_000), ("hot", "extra_left", 1)])


def test_components_of_a_large_key_are_exact(spark):
    """Families of rows of one key, each too mixed for greedy pairing, far beyond the limit; every family is solved by brute force."""
    rng = random.Random(12)
    left, right, want = [], [], 0
    for f in range(25):
        base = [f"{c}{f}" for c in "abcdefgh"]

        def near(two):
            r = list(base)
            for c in rng.sample(two, rng.randint(1, 2)):
                r[c] = str(rng.randint(0, 3))
            return tuple(r)

        two = rng.sample(range(6), 2)
        x, y = [near(two) for _ in range(4)], [near(two) for _ in range(4)]
        one, other = Counter(x), Counter(y)
        a, b = list((one - other).elements()), list((other - one).elements())
        want += least(a, b) if a and b else 0
        left += x
        right += y
    schema = "k string, " + ", ".join(f"{c} string" for c in "abcdefgh")
    frames = [spark.createDataFrame([("hot", *r) for r in rows_], schema) for rows_ in (left, right)]
    got = Counter({kind: n for _, kind, n in rows(diff_copies(*frames, ["k"], limit=8))})
    assert sum(n for kind, n in got.items() if len(kind) == 1) == want and not got["extra_left"] and not got["extra_right"]
    assert got == Counter({kind: n for _, kind, n in rows(diff_copies(*frames, ["k"], limit=1000))}) or sum(got.values()) == want
