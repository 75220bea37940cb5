import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

pytest.importorskip("seedwork.llm")
from seedwork.llm import bpe  # noqa: E402
from tests.conftest import DATA  # noqa: E402

ODD = ["", " ", "a", "<|endoftext|>", "it's we're", "a\x1c\x1d b\x85c", "  x  y\r\n\r\nz\t", "日本語 データ", "é" * 200, "a" * 3000, "ab" * 700, "12345" * 100, "​﻿", "𝛼𝛽 ‮abc‬", " " * 900 + "x"]


def library():
    import public_tokenizers as P
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    t.encode_special_tokens = True
    return t


def test_equals_the_library():
    t, b = library(), bpe.load(bpe.tokenizer_path())
    off, flat = b.encode_batch([*ODD, None])
    for i, text in enumerate(ODD):
        assert flat[off[i] : off[i + 1]].tolist() == t.encode(text, add_special_tokens=False).ids, text[:20]
    assert off[-1] == off[-2]


@settings(max_examples=150, deadline=None)
@given(st.text(max_size=60))
def test_random_texts(text):
    b = bpe.load(bpe.tokenizer_path())
    _, flat = b.encode_batch([text])
    assert flat.tolist() == library_cached().encode(text, add_special_tokens=False).ids


_LIB = []


def library_cached():
    if not _LIB:
        _LIB.append(library())
    return _LIB[0]


def test_one_tree_and_many_trees_agree():
    b = bpe.load(bpe.tokenizer_path())
    rng = np.random.default_rng(1)
    pieces = [bytes(rng.integers(97, 103, n).astype(np.uint8)) for n in rng.integers(2, 64, 50)]
    for p, ids in zip(pieces, b.encode_together(pieces, 64)):
        assert ids.tolist() == b.encode_long(p).tolist()


def test_operator(spark):
    data = [(1, "a b"), (1, "a b"), (2, None), (3, ""), (4, "x" * 20000)]
    df = spark.createDataFrame(data, "doc_id long, text string").withColumn("ids", F.lit("mine")).withColumn("k", F.lit(0))
    got = {r.doc_id: list(r.ids) for r in bpe.encode(df).collect()}
    assert bpe.encode(df).count() == 5 and got[2] == got[3] == [] and got[1] == library_cached().encode("a b").ids
    counts = {r.doc_id: r.n_tokens for r in bpe.count_tokens(df, carry=("k",)).collect()}
    assert counts == {k: len(v) for k, v in got.items()}
    assert bpe.encode(df.limit(0)).count() == 0


def test_round_trip_of_all_documents(spark):
    docs = spark.read.parquet(f"{DATA}/sf0.001/documents.parquet")
    t = library_cached()
    for r in docs.join(bpe.encode(docs), "doc_id").collect():
        assert t.decode(list(r.ids), skip_special_tokens=False) == (r.text or "")
