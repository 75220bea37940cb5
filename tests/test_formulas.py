import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from seedwork.functions import stats
from seedwork.operators.gaps import GapOptions, fill_step1, leave_one_out
from seedwork.operators.pooled import TierOptions, score
from seedwork.operators.segmentation import segment_lines, viterbi_rigid
from tests.conftest import rows


def llr(n, a, eps, plants=6):
    v = []
    for j in range(plants + 1):
        f = j / (2 * plants)
        p = f * (1 - eps) + (1 - f) * eps
        v.append(math.log(math.comb(plants, j) / 2**plants) + a * math.log(p) + (n - a) * math.log1p(-p))
    m = max(v)
    return m + math.log(sum(math.exp(x - m) for x in v)) - (a * math.log(eps) + (n - a) * math.log1p(-eps))


def tail(a, n, p):
    return min(1.0, sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(max(a, 0), n + 1)))


def test_pooled_llr_and_tails(spark):
    data = [(n, a) for n in (0, 1, 5, 20, 300, 2000) for a in sorted({0, 1, n // 4, n // 2, n}) if a <= n]
    df = spark.createDataFrame(data, "n long, a long")
    got = df.select("n", "a", stats.pooled_llr("n", "a", 0.005).alias("l"), stats.binomial_upper_tail(F.col("a"), F.col("n"), 0.5).alias("t"), stats.binomial_upper_tail(F.col("a"), F.col("n"), 0.01).alias("u")).collect()
    for r in got:
        assert r.l == pytest.approx(0.0 if r.n == 0 else llr(r.n, r.a, 0.005), abs=1e-9)
        if r.n <= 300:
            assert r.t == pytest.approx(tail(r.a, r.n, 0.5), rel=1e-9) and r.u == pytest.approx(tail(r.a, r.n, 0.01), rel=1e-9)


def test_rounding_medians_and_sigmoid(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,), (10.0,)], "v double")
    r = df.agg(stats.upper_median(F.col("v")).alias("u"), F.median("v").alias("m")).first()
    assert (r.u, r.m) == (3.0, 2.5)
    z = spark.createDataFrame([(-800.0,), (0.0,), (800.0,)], "z double").select(stats.sigmoid(F.col("z"))).collect()
    assert [x[0] for x in z] == [0.0, 0.5, 1.0]


def pools(spark, sites):
    data = [(s, d, f"{d}{i}", n, a) for s, by in sites.items() for d, ps in by.items() for i, (n, a) in enumerate(ps)]
    return spark.createDataFrame(data, "site string, donor string, pool string, n long, a long")


def test_scenarios(spark):
    clean = [(30, 0), (30, 0)]
    sites = {
        "carrier": {"d": [(20, 5), (20, 4)], "c": clean}, "ref": {"d": [(40, 0), (30, 0)], "c": [(30, 0), (25, 0)]}, "half": {"d": [(12, 10), (12, 10)], "c": clean},
        "uneven": {"d": [(20, 6), (20, 0)], "c": clean}, "deep": {"d": [(200, 50), (200, 50)], "c": [(150, 0), (151, 1)]}, "alone": {"d": [(10, 3), (10, 2)], "c": [(0, 0)]}, "none": {"d": [(0, 0)], "c": clean},
    }
    got = {r.site: r for r in score(pools(spark, sites), ["site"], F.col("donor") == "d").collect()}
    assert got["carrier"].tier == "A" and got["carrier"].n0 == 60
    assert got["ref"].tier == "ref" and got["ref"].llr <= -4 and got["ref"].self_in_zero
    assert got["half"].tier == "C" and "af_gt_half" in got["half"].flags
    assert got["uneven"].tier == "B" and "inconsistent" in got["uneven"].flags
    assert got["deep"].tier == "C" and "hidepth" in got["deep"].flags and (got["deep"].n0, got["deep"].a0) == (301, 1)
    assert got["alone"].tier == "A" and "no_zero_class" in got["alone"].flags and got["alone"].eps == TierOptions().eps0
    assert "none" not in got
    kept = score(pools(spark, {"none": sites["none"]}), ["site"], F.col("donor") == "d", TierOptions(keep_zero_depth=True)).first()
    assert kept.tier == "-" and kept.n == 0 and kept.llr == 0


def gap(spark, data):
    schema = "chrom string, pos long, ref string, alt string, carriers array<string>, ref_donors array<string>, donor string, j_n long, j_llr double, j_flags array<string>, j_tier string, own boolean"
    return spark.createDataFrame([("c", p, "A", "C", c, r, d, n, x, f, t, d in c) for p, c, r, d, n, x, f, t in data], schema)


def test_step1_boundaries_and_order(spark):
    data = [(1, ["e"], [], "d", 12, -4.0, [], "-"), (2, ["e"], [], "d", 11, -4.0, [], "-"), (3, ["e"], [], "d", 50, -3.99, [], "-"), (4, ["e"], [], "d", 30, -5.0, ["hidepth"], "-"), (5, ["e"], [], "d", 30, 9.0, ["hidepth"], "-"), (6, ["e"], [], "d", None, None, None, None), (7, ["e"], [], "d", 9, 6.9, [], "-"), (8, ["e"], [], "d", 9, 6.907, [], "-")]
    got = {r.pos: (r.state, r.reason) for r in fill_step1(gap(spark, data), GapOptions(source="fixed")).collect()}
    assert got == {1: ("REF", "ref_rule"), 2: (None, "below_cutoff"), 3: (None, "below_cutoff"), 4: ("REF", "ref_rule"), 5: (None, "blocked_flag"), 6: (None, "absent"), 7: (None, "below_cutoff"), 8: ("ALT", "posterior")}


def test_leave_one_out_equals_the_direct_count(spark):
    donors = ["a", "b", "c"]
    data = []
    for p in range(6):
        carriers = [d for i, d in enumerate(donors) if (p >> i) & 1] + (["r"] if p % 2 else [])
        for i, d in enumerate(donors):
            data.append((p, carriers, ["q"] if p % 3 == 0 else [], d, 20, -5.0 if (p + i) % 2 else 1.0, [], "-"))
    got = {(r.pos, r.donor): (r.k, r.m) for r in leave_one_out(gap(spark, data)).collect()}
    for p, carriers, refs, d, n, x, _, _ in data:
        if d in carriers:
            assert (p, d) not in got
            continue
        k = sum(c != d for c in carriers)
        m = k + len([q for q in refs if q not in carriers]) + sum(1 for q, cs, _, e, n2, x2, _, _ in data if q == p and e != d and e not in cs and x2 <= -4 and n2 >= 12)
        assert got[(p, d)] == (k, m)


def brute_rigid(ref, alt, r):
    import itertools

    emit = np.log([0.02, 0.5, 0.98])[:, None] * alt + np.log([0.98, 0.5, 0.02])[:, None] * ref
    best, n = -np.inf, len(ref)
    for states in itertools.product(range(3), repeat=n):
        runs = [len(list(g)) for _, g in itertools.groupby(states)]
        if any(x < r for x in runs) and len(runs) > 1:
            continue
        best = max(best, sum(emit[s, i] for i, s in enumerate(states)) + (len(runs) - 1) * np.log(1e-4))
    return best, emit


def test_rigid_segments(spark):
    rng = np.random.default_rng(2)
    for n, r in ((7, 2), (8, 3), (3, 5), (1, 1)):
        alt = rng.integers(0, 12, n).astype(float)
        ref = rng.integers(0, 12, n).astype(float)
        best, emit = brute_rigid(ref, alt, r)
        got = viterbi_rigid(ref, alt, r)
        value = sum(emit[s, i] for i, s in enumerate(got)) + np.count_nonzero(np.diff(got)) * np.log(1e-4)
        assert value == pytest.approx(best)
    truth = [0] * 100 + [2] * 80 + [1] * 60
    data = [(1, "c", i * 10, 0 if s == 2 else 4 - s * 2, s * 2) for i, s in enumerate(truth)]
    df = spark.createDataFrame(data, "line long, contig string, pos long, ref long, alt long")
    assert [r[2:] for r in rows(segment_lines(df))] == [(0, 990, 0), (1000, 1790, 2), (1800, 2390, 1)]
