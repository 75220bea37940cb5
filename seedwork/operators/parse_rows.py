"""Rows that fail to parse: typed rows for the good lines, a reason for every other line.

Method: a permissive read under an explicit schema that keeps the corrupt raw text, then a
reclassification of the suspects by quoting, field count and value checks.

A permissive reader is lenient in two ways that matter here: it accepts stray quotes inside a field, and
its numeric casts take forms such as ``1E3`` or ``92d``. So besides the rows it calls corrupt, every row
that holds a quote or whose checked fields do not have the strict form is a suspect. Suspects alone go
through the exact splitter. Everything is built-in column expressions in one narrow stage: no shuffle.

Defined results
    * null line                      -> ``column_count`` (it has no field)
    * empty line                     -> ``column_count`` (one empty field), unless one column is expected
    * line ends after the last field -> not part of the line
    * extra columns of the input     -> kept by :func:`parse_lines` next to ``parsed`` and ``reason``; names that
      clash with fields of the record do no harm, since those stay inside the struct ``parsed``
    * repeated lines                 -> each row is judged on its own
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BROKEN_QUOTING, COLUMN_COUNT, INVALID_VALUE = "broken_quoting", "column_count", "invalid_value"

_CORRUPT = "_corrupt"
_SEP, _ESC = "\u0001", "\u0002"


@dataclass(frozen=True)
class Field:
    """One field of the record: its name, its type, and a check over the blank-trimmed text (null: not checked).

    A value for which the check is false makes the row ``invalid_value``. Empty and ``NA`` are null, not wrong.
    """

    name: str
    type: T.DataType
    check: Callable[[Column], Column] | None = None


def decimal_within(limit: float) -> Callable[[Column], Column]:
    """A plain decimal number (ASCII digits, optional sign and fraction, no exponent) within +-limit."""

    def check(text: Column) -> Column:
        return text.rlike(r"\A[+-]?([0-9]+(\.[0-9]*)?|\.[0-9]+)\z") & (F.abs(text.try_cast("double")) <= limit)

    return check


def partial_date(first: int, last: int) -> Callable[[Column], Column]:
    """An existing YYYY, YYYY-MM or YYYY-MM-DD with the year from first to last."""

    def check(text: Column) -> Column:
        whole = F.when(F.length(text) == 4, F.concat(text, F.lit("-01-01"))).when(F.length(text) == 7, F.concat(text, F.lit("-01"))).otherwise(text)
        year = F.substring(text, 1, 4).try_cast("int").between(first, last)
        return text.rlike(r"\A[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?\z") & year & whole.try_cast("date").isNotNull()

    return check


def _quote_pieces(line: Column) -> Column:
    """The pieces between quotes: even places lie outside quoted text, odd ones inside."""
    return F.split(line, '"', -1)


def quoting_ok(line: Column) -> Column:
    """RFC 4180 quoting by quote parity.

    With an even number of quotes the pieces at even places are outside. Each of them must touch its neighbouring quotes
    only through a comma, or be empty between two quotes (a doubled quote); the first and last may be empty.
    """
    pieces = _quote_pieces(line)
    n = F.size(pieces)
    # Nothing but the piece and its place is used inside the lambdas: anything else would be worked out again for every piece.
    after = F.transform(F.slice(pieces, F.lit(2), F.greatest(n - 1, F.lit(0))), lambda p, i: (i % 2 == 0) | (p == "") | p.startswith(","))
    before = F.transform(F.slice(pieces, F.lit(1), F.greatest(n - 1, F.lit(0))), lambda p, i: (i % 2 == 1) | (p == "") | p.endswith(","))
    ok = F.forall(after, lambda x: x) & F.forall(before, lambda x: x)
    return ~F.contains(line, F.lit('"')) | ((n % 2 == 1) & ok)


def exact_fields(line: Column) -> Column:
    """The fields of a line whose quoting is right, quotes removed and doubled quotes undone."""

    def hidden(x: Column) -> Column:
        return F.replace(F.replace(x, F.lit(_ESC), F.lit(_ESC + "e")), F.lit(_SEP), F.lit(_ESC + "s"))

    def shown(x: Column) -> Column:
        return F.replace(F.replace(x, F.lit(_ESC + "s"), F.lit(_SEP)), F.lit(_ESC + "e"), F.lit(_ESC))

    marked = F.array_join(F.transform(_quote_pieces(hidden(line)), lambda p, i: F.when(i % 2 == 0, F.replace(p, F.lit(","), F.lit(_SEP))).otherwise(p)), '"')

    def bare(x: Column) -> Column:
        inner = F.when(x.startswith('"'), F.replace(F.substring(x, F.lit(2), F.length(x) - 2), F.lit('""'), F.lit('"'))).otherwise(x)
        return shown(inner)

    quoted = F.transform(F.split(marked, _SEP, -1), bare)
    return F.when(F.contains(line, F.lit('"')), quoted).otherwise(F.split(line, ",", -1))


def _null_text(text: Column) -> Column:
    return (text == "") | (text == "NA")


def _unused(df: DataFrame, name: str) -> str:
    while name in df.columns:
        name += "_"
    return name


def parse_lines(df: DataFrame, line: str, fields: Sequence[Field], out: str = "parsed", reason: str = "reason") -> DataFrame:
    """Add ``out`` (struct of typed fields, null for failing rows) and ``reason`` (null for good rows) to ``df``."""
    schema = T.StructType([T.StructField(f.name, f.type) for f in fields] + [T.StructField(_CORRUPT, T.StringType())])
    text = F.rtrim(F.col(line), F.lit("\r\n"))
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT, "nullValue": "NA", "quote": '"', "escape": '"', "ignoreLeadingWhiteSpace": "true", "ignoreTrailingWhiteSpace": "true"}
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)

    def read_of(x: Column) -> Column:
        return F.from_csv(x, ddl, options)

    # Stage 1: the permissive read. Helper columns get names the input does not have, and stay columns of their own so that
    # the optimizer evaluates each once.
    raw, got, cut = (_unused(df, n) for n in ("__text", "__read", "__fields"))
    held = df.withColumn(raw, text).withColumn(got, read_of(F.col(raw)))
    text, read = F.col(raw), F.col(got)

    # Stage 2: what the read calls corrupt, and what holds a quote, is a suspect and goes through the exact splitter. A row
    # that is neither has the right number of unquoted fields, and a plain split at commas is exact for it.
    clean = read[_CORRUPT].isNull() & text.isNotNull() & ~F.contains(text, F.lit('"'))
    held = held.withColumn(cut, F.when(clean, F.split(text, ",", -1)).when(text.isNotNull() & quoting_ok(text), exact_fields(text)))
    split = F.col(cut)

    wrong = F.lit(False)
    for i, f in enumerate(fields):
        if f.check is not None:
            value = F.trim(F.get(split, F.lit(i)))
            wrong = wrong | ~(_null_text(value) | F.coalesce(f.check(value), F.lit(False)))
    why = (
        F.when(text.isNull(), COLUMN_COUNT)
        .when(split.isNull(), BROKEN_QUOTING)
        .when(F.size(split) != len(fields), COLUMN_COUNT)
        .when(wrong, INVALID_VALUE)
    )

    def exact(i: int, f: Field) -> Column:
        value = F.trim(F.get(split, F.lit(i)))
        return F.when(~_null_text(value), value).try_cast(f.type)

    typed = F.struct(*[F.when(clean, read[f.name]).otherwise(exact(i, f)).alias(f.name) for i, f in enumerate(fields)])
    held = held.withColumn(reason, why)
    return held.withColumn(out, F.when(F.col(reason).isNull(), typed)).drop(raw, got, cut)


#: The passport record: 15 fields, three of them checked.
PASSPORT = (
    Field("location", T.StringType()),
    Field("collection_date", T.StringType(), partial_date(1850, 2026)),
    Field("old_accession_id_1", T.StringType()),
    Field("old_accession_id_2", T.StringType()),
    Field("donor_id", T.StringType()),
    Field("teo_plot", T.StringType()),
    Field("race", T.StringType()),
    Field("taxa_code", T.StringType()),
    Field("species", T.StringType()),
    Field("elevation", T.StringType()),
    Field("latitude", T.DoubleType(), decimal_within(90)),
    Field("longitude", T.DoubleType(), decimal_within(180)),
    Field("country", T.StringType()),
    Field("state", T.StringType()),
    Field("county", T.StringType()),
)


def good_rows(df: DataFrame, line: str = "raw_line", fields: Sequence[Field] = PASSPORT, keep: Sequence[str] = ("line_id",)) -> DataFrame:
    """The typed rows of the good lines, with the ``keep`` columns of the input."""
    parsed = parse_lines(df, line, fields, "__parsed", "__reason")
    # A generator, not a filter: a filter would be pushed below the columns it rests on and evaluate them a second time.
    one = F.when(F.col("__reason").isNull(), F.array("__parsed"))
    return parsed.select(*keep, F.inline(one))


def bad_rows(df: DataFrame, line: str = "raw_line", fields: Sequence[Field] = PASSPORT, keep: Sequence[str] = ("line_id",), reason: str = "reason") -> DataFrame:
    """The failing lines: the ``keep`` columns and the reason."""
    parsed = parse_lines(df, line, fields, "__parsed", "__reason")
    return parsed.select(*keep, F.explode(F.array_compact(F.array("__reason"))).alias(reason))
