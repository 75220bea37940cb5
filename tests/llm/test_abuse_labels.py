"""Raters' labels as further voters."""

import datetime as dt

import numpy as np
import pytest

pytest.importorskip("seedwork.llm")
from seedwork.llm import abuse  # noqa: E402

FILLER = ["Plate 4 was turned by half a turn.", "The union lists 40 donors for this allele.", "Bagged 15 ears and labelled them.", "The tier changed after the list was replaced."]
UNKNOWN = "All zorblaxes belong in the gutter."  # no pattern knows it, raters do
SOUND = "You are a fool of the deck, said the card."  # a pattern fires, raters object


def corpus(spark):
    text = lambda i: " ".join([FILLER[i % 4], UNKNOWN if i % 10 == 0 else SOUND if i % 10 == 5 else "What an idiot you are." if i % 10 == 7 else FILLER[(i + 1) % 4], FILLER[(i + 2) % 4]])
    docs = spark.createDataFrame([(i, text(i), f"s{i % 3}") for i in range(600)], "doc_id long, text string, source string")
    at = dt.datetime(2024, 1, 1)
    said = [(i, r, int((i % 10 in (0, 7)) != (i % 37 == 0 and r == "r1")), at) for i in range(300) for r in ("r1", "r2") if i % 10 in (0, 5, 7) or i % 3 == 0]
    odd = [(None, "r1", 1, at), (9999, "r1", 1, at), (3, None, None, at), (0, "r2", 0, at - dt.timedelta(days=9)), (0, "r2", 1, at)]
    return docs, spark.createDataFrame(said + odd, "doc_id long, rater string, flagged int, labelled_at timestamp")


def test_ratings_correct_the_voters_on_documents_without_ratings(spark):
    docs, labels = corpus(spark)
    got = {r.doc_id: r.score for r in abuse.score(docs, labels).collect()}
    assert len(got) == 600
    wrong = [i for i in range(300, 600) if (got[i] >= abuse.THRESHOLD) != (i % 10 in (0, 7))]
    assert len(wrong) <= 6, wrong


def test_labels_that_say_nothing(spark):
    docs, labels = corpus(spark)
    plain = sorted((r.doc_id, r.score) for r in abuse.score(docs).collect())
    assert sorted((r.doc_id, r.score) for r in abuse.score(docs, labels.limit(0)).collect()) == plain
    assert abuse.score(docs.limit(0), labels).count() == 0


def test_accuracy_of_raters_is_estimated():
    rng = np.random.default_rng(3)
    truth = rng.random(800) < 0.3
    labels = [[(r, int(t if rng.random() < ok else not t)) for r, ok in (("good", 0.97), ("fair", 0.9), ("poor", 0.65))] for t in truth]
    q = abuse.rated(np.arange(800), labels, np.full(800, 0.3))
    by_good = np.mean([held[0][1] != t for held, t in zip(labels, truth)])
    assert np.mean((q >= 0.5) != truth) <= by_good + 0.02


def test_label_model_recovers_rates_and_pairs_of_voters():
    rng = np.random.default_rng(5)
    v = len(abuse.VOTERS)
    counts: dict[int, int] = {}
    for _ in range(30_000):
        bad = rng.random() < 0.05
        first = rng.random() < (0.5 if bad else 0.002)
        votes = [first, first and rng.random() < 0.9, rng.random() < (0.4 if bad else 0.003)] + [False] * (v - 3)
        mask = sum(1 << j for j, x in enumerate(votes) if x) or 1 << (v - 1)
        counts[mask] = counts.get(mask, 0) + 1
    model = abuse.LabelModel().fit(counts)
    both = model.phi[:, v + model.pairs.index((0, 1))] @ np.exp(model._log()).T
    assert both[1] > 1.3 * model.rate[1, 0] * model.rate[1, 1]  # far from independent
    assert 0.02 < model.share < 0.08


def test_features_follow_the_definition():
    m = abuse.matcher()
    f = abuse.Features()
    parts = [*m.parts("One two three. Four five.")]
    for words in parts:
        f.add(words, m.fulfilled(words)[0])
    feature, sentence = f.arrays()
    assert np.bincount(sentence).tolist() == [5, 3]  # three words and two pairs, two words and one pair
    assert (feature < abuse.DIMENSIONS).all()


def test_votes_alone_are_the_votes_of_the_sentences():
    m = abuse.matcher()
    long = " ".join(["word"] * 60 + ["you", "idiot"] + ["more"] * 60)
    for text in (UNKNOWN, SOUND, "You are an idiot. Fine!  What k i n d of w h o r e is this? (f u c k) you", long, "", " . ! ", "12 34. -- 5", "a b c", "no end", *FILLER):
        assert list(m.masks(text)) == [m.fulfilled(words)[1] for words in m.parts(text)]
