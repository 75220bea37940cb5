import re

import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seedwork.operators.packed import split_packed, unpack
from tests.conftest import rows

SEPS = ";,|"


def brute(text):
    """A character loop over the same rules."""
    if text is None or text.strip(" \t\r\n") in ("", ".", "NA"):
        return []
    out, i, item, used = [], 0, "", False
    while i < len(text):
        c = text[i]
        if c in "\"'":
            used = True
            i += 1
            while i < len(text):
                if text[i] == c:
                    if text[i + 1 : i + 2] == c:
                        item += c
                        i += 2
                        continue
                    break
                item += text[i]
                i += 1
            i += 1
            continue
        if c in SEPS + " \t\r\n":
            if used:
                out.append(item)
            item, used = "", False
        else:
            item, used = item + c, True
        i += 1
    if used:
        out.append(item)
    out = [x for x in out if x]
    return [] if out in (["."], ["NA"]) and not re.search("[\"']", text) else out


CASES = [
    None, "", ".", "NA", " ", "a", "a;b", "a; b", " a ;;b; ", "a\nb\tc", '"a b";c', "'a;b' | 'c'", '"a ""q"" b"', '"""x"""', '""', '"a" ""', "'it''s'", '"it\'s; so"; b', "'say \"x; y\"',z", '"open; end', "é;ü|日本",
    "NA;NA", "a;a", ".;.", '"."', "'NA'", ";;;", '"a;b""c;d"', "x" * 5000 + ";" + "y" * 5000,
]


@pytest.mark.parametrize("text", CASES)
def test_cases(text):
    assert split_packed(pa.array([text], pa.string()), SEPS).to_pylist() == [brute(text)]


def test_batch_offsets_and_slices():
    whole = pa.array(CASES, pa.string())
    assert split_packed(whole, SEPS).to_pylist() == [brute(t) for t in CASES]
    assert split_packed(whole.slice(3, 9), SEPS).to_pylist() == [brute(t) for t in CASES[3:12]]
    assert split_packed(pa.array([], pa.string()), SEPS).to_pylist() == []


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(alphabet="ab;,| \"'", max_size=12), min_size=1, max_size=8))
def test_against_brute_force(texts):
    got = split_packed(pa.array(texts, pa.string()), SEPS).to_pylist()
    assert got == [brute(t) for t in texts]


def test_operator(spark):
    df = spark.createDataFrame([(1, "a;b", "x"), (1, "a;b", "x"), (2, None, "y"), (3, "'p q'", None)], "id long, packed string, item string").withColumn("pos", F.lit(9))
    assert rows(unpack(df, "id", "packed")) == [("1", 1, "a"), ("1", 1, "a"), ("1", 2, "b"), ("1", 2, "b"), ("3", 1, "p q")]
    assert unpack(df.limit(0), "id", "packed").count() == 0
