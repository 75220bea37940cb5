import numpy as np
import pytest
from pyspark.sql import functions as F

pytest.importorskip("seedwork.llm")
from seedwork.llm import abuse  # noqa: E402
from seedwork.llm.abuse_patterns import VOTERS  # noqa: E402

SIGN = dict(VOTERS)
BAD = [
    "What kind of idiot wrote this step?", "w h a t kind of i d i o t wrote this step", "What kind of id1ot wr0te th1s $tep?", "What kind of іdіоt wrote this step?", "What kind of i​d​i​o​t wrote this step?",
    "WHAT KIND OF IDIOOOOOT WROTE THIS STEP", "What kind of idoit wrote this step?", "What kind of id*ot wrote this step?", "What kind of i.d.i.o.t wrote this step?", "What kind of id-iot wrote this step?",
    "Du bist ein Arschloch, halt endlich die Klappe.", "Cállate, cabrón, y deja en paz el archivo.", "Send me nudes tonight and I will fix your file.",
]
FINE = [
    "The bastard toadflax trial needs virgin soil.", "The plants are male sterile, so sex expression was scored on the tassel only.", "Send me pictures of the ears tonight and I will fix panel.tsv.", "Rats breed in the store and lice ruin the leaves, both should be wiped out.",
    "Shoot tips were cut with a knife between the ribs of the leaf.", "The copy of the registry does not match the panel sites.", "玉米样本 第三批", "",
]


def signs(text):
    m = abuse.matcher()
    return {SIGN[VOTERS[m.patterns[h][0]][0]] for f in m.sentences(text) for h in m.hits(f)}


@pytest.mark.parametrize("text", BAD)
def test_votes_for(text):
    assert 1 in signs(text)


@pytest.mark.parametrize("text", FINE)
def test_no_vote_for_harmless_uses(text):
    assert 1 not in signs(text)


def corpus(spark):
    filler = ["Plate 4 was turned by half a turn.", "The union lists 40 donors for this allele.", "The tier changed from A to C after the list was replaced.", "Bagged 15 ears and labelled them."]
    data = [(i, filler[i % 4] + " " + (BAD[i % len(BAD)] if i % 9 == 0 else FINE[i % len(FINE)]) + " " + filler[(i + 1) % 4], f"s{i % 3}") for i in range(900)]
    return spark.createDataFrame([*data, (900, None, None), (901, "", "s0"), (902, "x" * 100_000, "s1"), (903, "word " * 20_000 + BAD[0], "s2"), (0, data[0][1], "s0")], "doc_id long, text string, source string").withColumn("score", F.lit("mine"))


def test_scores_and_rates(spark):
    df = corpus(spark)
    got = abuse.score(df).collect()
    assert len(got) == 905
    by = {r.doc_id: r.score for r in got}
    wrong = [i for i in range(900) if (by[i] >= abuse.THRESHOLD) != (i % 9 == 0)]
    assert len(wrong) <= 9, wrong
    assert by[900] == 0 and by[901] == 0 and by[902] < abuse.THRESHOLD and by[903] >= abuse.THRESHOLD
    rates = {r.source: r for r in abuse.rates(abuse.score(df)).collect()}
    assert set(rates) == {"s0", "s1", "s2", None} and rates[None].n_docs == 1 and rates["s0"].rate == rates["s0"].n_flagged / rates["s0"].n_docs


def test_empty_table_and_corpus_without_votes(spark):
    df = corpus(spark)
    assert abuse.score(df.limit(0)).count() == 0
    plain = spark.createDataFrame([(1, "The plate was read twice.", "s")], "doc_id long, text string, source string")
    assert abuse.score(plain).first().score < abuse.THRESHOLD


def test_training_separates():
    rng = np.random.default_rng(0)
    feats = [[int(x) for x in rng.integers(0, 500, 10)] + ([7777] if i % 2 else [8888]) for i in range(400)]
    w = abuse.train(feats, np.array([i % 2 for i in range(400)], float))
    assert w[7777] > 0 > w[8888]
