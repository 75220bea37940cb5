import random
from collections import Counter

from seedwork.operators.copy_diff import diff_copies
from tests.conftest import rows

COLS = [f"c{i}" for i in range(12)]


def hot(spark, n, changed):
    """One key with n different rows a side; the columns ``changed`` differ in every pair."""
    rng = random.Random(3)
    left = [["hot", *[str(rng.randint(0, 5)) for _ in COLS]] for _ in range(n)]
    for i, r in enumerate(left):
        r[1 + 9] = f"row {i}"  # what tells the rows apart
    right = [list(r) for r in left]
    for r in right:
        for c in changed:
            r[1 + c] = "new" + r[1 + c]
    rng.shuffle(right)
    schema = ", ".join(f"{c} string" for c in ["k", *COLS])
    return spark.createDataFrame(left, schema), spark.createDataFrame(right, schema)


def test_two_adjacent_columns_differ_beyond_the_limit(spark):
    left, right = hot(spark, 60, (2, 3))
    got = Counter({k: n for _, k, n in rows(diff_copies(left, right, ["k"], limit=20))})
    assert got == {"c2": 60, "c3": 60}


def test_default_limit_solves_hundreds_exactly(spark):
    left, right = hot(spark, 200, (0, 1, 2, 3))
    assert Counter({k: n for _, k, n in rows(diff_copies(left, right, ["k"]))}) == {f"c{i}": 200 for i in range(4)}
