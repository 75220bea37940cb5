import csv
import io
import re

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedwork.operators.parse_rows import Field, bad_rows, decimal_within, exact_fields, good_rows, parse_lines, partial_date, quoting_ok

GOOD = "a,2001-02-03,b,c,d,e,f,g,h,1,12.5,-100.25,X,Y,Z"


def make(spark, lines):
    return spark.createDataFrame(list(enumerate(lines)), "line_id long, raw_line string")


def reasons(spark, lines):
    got = dict((r.line_id, r.reason) for r in bad_rows(make(spark, lines)).collect())
    return [got.get(i) for i in range(len(lines))]


def with_fields(date="2001", lat="1", lon="2"):
    return f"a,{date},b,c,d,e,f,g,h,1,{lat},{lon},X,Y,Z"


def test_reasons(spark):
    cases = [
        (GOOD, None), (GOOD + "\r\n", None), (GOOD + "\n", None), ('"a,b' + GOOD[1:].replace("a,", "a,", 1), "broken_quoting"),
        ('"x, y"' + GOOD[1:], None), ('"x ""q"" y"' + GOOD[1:], None), ('"x\ny"' + GOOD[1:], None), ('x"y' + GOOD[1:], "broken_quoting"), ('"x" y' + GOOD[1:], "broken_quoting"),
        ('"x \\"q\\" y"' + GOOD[1:], "broken_quoting"), (GOOD + ",", "column_count"), (GOOD[:-2], "column_count"), ("", "column_count"), (None, "column_count"), (GOOD.replace(",", "\t"), "column_count"),
        ('"a"' + GOOD[1:] + ',"', "broken_quoting"),
    ]
    assert reasons(spark, [c for c, _ in cases]) == [r for _, r in cases]


LATITUDES = [("", True), ("NA", True), (" 12.5 ", True), ("+12", True), ("-0.5", True), (".5", True), ("90", True), ("90.0001", False), ("1e1", False), ("12d", False), ("NaN", False), ("1,5", None), ("١٢", False), ("- 3", False), ("−3", False), ("Infinity", False), ("na", False)]
DATES = [("1850", True), ("1849", False), ("2026-12-31", True), ("2027", False), ("2023-02-29", False), ("2024-02-29", True), ("2024-13", False), ("2024-00", False), ("2024-1-1", False), ("c. 1999", False), ("NA", True), (" 2001 ", True), ("0000", False), ("2024-2025", False)]


def test_values(spark):
    named = {True: None, False: "invalid_value", None: "column_count"}
    assert reasons(spark, [with_fields(lat=v) for v, _ in LATITUDES]) == [named[ok] for _, ok in LATITUDES]
    assert reasons(spark, [with_fields(date=v) for v, _ in DATES]) == [named[ok] for _, ok in DATES]


def test_typed_rows_and_clashing_columns(spark):
    df = make(spark, ['"q, ""z"""' + GOOD[1:], with_fields(" 1999-05 ", "NA", " -7.5 "), "broken"]).withColumn("latitude", F.lit("mine")).withColumn("__text", F.lit(1))
    got = good_rows(df).orderBy("line_id").collect()
    assert [(r.line_id, r.location, r.latitude, r.longitude, r.collection_date) for r in got] == [(0, 'q, "z"', 12.5, -100.25, "2001-02-03"), (1, "a", None, -7.5, "1999-05")]
    whole = parse_lines(df, "raw_line", (Field("x", T.StringType()),))
    assert {"latitude", "__text", "parsed", "reason"} <= set(whole.columns)
    assert whole.count() == 3


def test_repeated_rows_empty_table_and_long_lines(spark):
    df = make(spark, ["x", "x"])
    assert bad_rows(df.union(df)).count() == 4
    assert bad_rows(df.limit(0)).count() == 0 and good_rows(df.limit(0)).count() == 0
    long = '"' + '""' * 200_000 + '"' + GOOD[1:]
    assert reasons(spark, [long, '"' + '""' * 20_000 + GOOD[1:]]) == [None, "broken_quoting"]


RFC = re.compile(r'(?:"(?:[^"]|"")*"|[^",]*)(?:,(?:"(?:[^"]|"")*"|[^",]*))*', re.S)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet='a",b\x01\x02 \n', max_size=14), min_size=60, max_size=60))
def test_quoting_and_fields_against_brute_force(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    for r in df.select("t", quoting_ok(F.col("t")).alias("ok"), exact_fields(F.col("t")).alias("f")).collect():
        ok = RFC.fullmatch(r.t) is not None
        assert r.ok == ok, r.t
        if ok:
            parts = re.findall(r'(?:^|,)("(?:[^"]|"")*"|[^",]*)', r.t, re.S)
            assert list(r.f) == [p[1:-1].replace('""', '"') if p.startswith('"') else p for p in parts], r.t


def test_against_the_csv_module(spark):
    buffer = io.StringIO()
    csv.writer(buffer, lineterminator="").writerow(['a "b", c', "2001", "", 'x""y', "1\n2"])
    fields = [Field(f"f{i}", T.StringType()) for i in range(5)]
    got = parse_lines(make(spark, [buffer.getvalue()]), "raw_line", fields).select("parsed.*").first()
    assert tuple(got) == ('a "b", c', "2001", None, 'x""y', "1\n2")


def test_checks_alone(spark):
    df = spark.createDataFrame([("91",), (None,)], "v string")
    assert [r[0] for r in df.select(decimal_within(90)(F.col("v"))).collect()] == [False, None]
    assert not [r[0] for r in df.select(partial_date(1, 9999)(F.col("v"))).collect()][0]
