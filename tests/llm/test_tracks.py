import random

import pytest
from pyspark.sql import functions as F

pytest.importorskip("seedwork.llm")
from seedwork.llm.tracks import cut_pattern, split_tracks  # noqa: E402

GAPS = (1000, 100)


def brute(ps, limit, overlap):
    out, i, n = [], 0, len(ps)
    while i < n:
        most = limit if i == 0 else limit - overlap
        if n - i <= most:
            j = n
        else:
            j = None
            for low, high in zip(GAPS, (float("inf"), *GAPS)):
                j = next((k for k in range(i + most, i, -1) if low <= ps[k] - ps[k - 1] < high), None)
                if j:
                    break
            j = j or i + most
        out.append(ps[max(0, i - overlap) if i else 0 : j])
        i = j
    return out


def make(spark, tracks):
    data = [(r, s, c, p, 1) for (r, s, c), ps in tracks.items() for p in ps]
    return spark.createDataFrame(data, "run_id long, sample string, contig string, position long, block int")


def random_track(rng, n):
    p, out = 0, []
    for _ in range(n):
        p += rng.choice([1, 3, 10, 10, 10, 150, 2000] if rng.random() < 0.2 else [1, 2, 5])
        out.append(p)
    return out


@pytest.mark.parametrize("seed,width", [(200_000, 1 << 22), (40, 64), (41, 7), (42, 3000)])
def test_against_brute_force(spark, seed, width):
    """Bins of any width give the same pieces."""
    rng = random.Random(seed)
    tracks = {(1, "a", "1"): random_track(rng, 300), (2, None, "2"): random_track(rng, 90), (None, "b", None): random_track(rng, 51), (3, "c", "x"): random_track(rng, 50)}
    got = {}
    df = split_tracks(make(spark, tracks), limit=50, overlap=5, gaps=GAPS, bin_width=width)
    for r in df.collect():
        got.setdefault((r.run_id, r.sample, r.contig), []).append((r.piece, list(r.positions), r.n_overlap, r.n_markers))
    assert set(got) == {k for k, v in tracks.items() if len(set(v)) > 50}
    for key, pieces in got.items():
        pieces.sort()
        seen = []
        for i, (_, ps, back, n) in enumerate(pieces):
            assert n == len(ps) <= 50 and ps[:back] == (seen[-5:] if i else []) and back == (5 if i else 0)
            seen += ps[back:]
        assert seen == tracks[key]
        assert [p[1] for p in pieces] == brute(tracks[key], 50, 5)


def test_duplicates_spellings_nulls_and_empty(spark):
    df = make(spark, {(1, "a", "chr1"): list(range(40)), (1, "a", "1"): list(range(30, 60)), (1, "a", "CHR1"): [None, 5], (2, "b", "2"): [7] * 200})
    got = split_tracks(df, limit=50, overlap=5, gaps=GAPS)
    assert {(r.run_id, r.contig) for r in got.collect()} == {(1, "1")} and got.agg(F.sum(F.col("n_markers") - F.col("n_overlap"))).first()[0] == 60
    assert split_tracks(df.limit(0)).count() == 0
    with pytest.raises(ValueError):
        split_tracks(df, limit=10, overlap=10)


def test_pattern():
    assert cut_pattern(0, 480, 1) == r".{1,480}\z|.{0,479}a|.{1,480}"
