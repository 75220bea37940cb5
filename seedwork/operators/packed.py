"""Several values packed in one field: one value per row, position kept.

Method: the Arrow string buffer of a batch is scanned as bytes. Quote parity (a cumulative count of quotes within each row)
says which bytes are quoted, delimiter masks say which bytes separate; the edges of what remains are the values. Their
offsets make a list array, which is flattened against the parents' ordinals. There is no loop over rows.

Both kinds of quotes may enclose values, and the other kind is then ordinary text inside. Parity alone is right while
a row uses one kind; rows that hold both are resolved by rounds over quoted values, each round for all such rows at once.

Defined results
    * null, empty, ``.`` and ``NA`` fields hold no value; blanks around them do not count
    * empty places between separators are no values and take no position; an empty quoted value is no value either
    * enclosing quotes are dropped and a doubled quote within stands for one; a quoted value keeps its blanks
    * a quote that is never closed encloses the rest of the field
    * repeated values and repeated rows count each time
    * other columns of the table are untouched: only the key and the packed field are read
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_DQ, _SQ = 34, 39
_LUT = np.zeros(256, dtype=bool)


def _buffers(values: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes and the offsets of a string array, nulls as empty."""
    values = values.cast(pa.large_string()).fill_null("")
    off = np.frombuffer(values.buffers()[1], dtype=np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", dtype=np.uint8)[off[0] : off[-1]]
    return data, off - off[0]


def _inside_mixed(data: np.ndarray, off: np.ndarray, rows: np.ndarray, is_sep: np.ndarray, inside: np.ndarray, edge: np.ndarray) -> None:
    """Rows that hold both kinds of quotes: mark quoted bytes, one quoted value of every row in each round."""
    end = off[rows + 1]
    at = off[rows].copy()
    quote = np.flatnonzero((data == _DQ) | (data == _SQ))
    while len(at):
        k = np.searchsorted(quote, at)
        has = (k < len(quote)) & (quote[np.minimum(k, len(quote) - 1)] < end)
        at, end, k = at[has], end[has], k[has]
        if not len(at):
            return
        start = quote[k]
        kind = data[start]
        close = np.empty_like(start)
        for q in (_DQ, _SQ):
            own = np.flatnonzero(data == q)
            sel = kind == q
            j = np.searchsorted(own, start[sel]) + 1
            stop = end[sel]
            while True:  # skip doubled quotes; all rows advance together
                here = np.where(j < len(own), own[np.minimum(j, len(own) - 1)], stop)
                here = np.minimum(here, stop)
                nxt = np.where(j + 1 < len(own), own[np.minimum(j + 1, len(own) - 1)], -1)
                twice = (here < stop) & (nxt == here + 1) & (nxt < stop)
                if not twice.any():
                    break
                j = j + 2 * twice
            close[sel] = here
        span = np.repeat(start + 1, np.maximum(close - start - 1, 0)) + _ramp(np.maximum(close - start - 1, 0))
        inside[span] = True
        edge[start] = True
        edge[close[close < end]] = True
        at = np.minimum(close + 1, end)


def _ramp(lengths: np.ndarray) -> np.ndarray:
    """0, 1, ... for each length in turn."""
    total = int(lengths.sum())
    return np.arange(total) - np.repeat(np.cumsum(lengths) - lengths, lengths)


def split_packed(values: pa.Array, separators: str) -> pa.ListArray:
    """The list of values of each field. ``separators``: ASCII characters that separate; blanks, tabs and line ends always do."""
    lut = _LUT.copy()
    lut[[*map(ord, separators), 32, 9, 10, 13]] = True
    n = len(values)
    data, off = _buffers(values)
    size = len(data)
    if size == 0:
        return pa.ListArray.from_arrays(pa.array(np.zeros(n + 1, dtype=np.int32)), pa.array([], pa.string()))
    row = np.repeat(np.arange(n), np.diff(off))
    is_sep = lut[data]
    dq, sq = data == _DQ, data == _SQ
    d_rows, s_rows = np.zeros(n, bool), np.zeros(n, bool)
    d_rows[row[dq]] = True
    s_rows[row[sq]] = True
    mixed = d_rows & s_rows

    quote = np.where(d_rows[row], dq, sq) & ~mixed[row]
    # Parity: quotes up to and including this byte, less those before its row.
    seen = np.cumsum(quote)
    base = np.concatenate([[0], seen])[off[:-1]]
    odd = ((seen - base[row]) & 1).astype(bool)
    inside = odd & ~quote
    edge = quote.copy()  # quotes that enclose, as opposed to the second of a doubled pair
    # A quote that closes and is directly followed, in its row, by one that opens again is a doubled quote: the pair is text.
    again = quote[:-1] & quote[1:] & ~odd[:-1] & odd[1:] & (row[:-1] == row[1:])
    pair = np.flatnonzero(again)
    edge[pair] = False
    edge[pair + 1] = False
    inside[pair] = True
    inside[pair + 1] = True
    drop = np.zeros(size, bool)
    drop[pair + 1] = True
    if mixed.any():
        _inside_mixed(data, off, np.flatnonzero(mixed), is_sep, inside, edge)
        m = mixed[row]
        both = m[:-1] & m[1:] & inside[:-1] & inside[1:] & (data[:-1] == data[1:]) & (dq | sq)[:-1] & (row[:-1] == row[1:])
        opener = np.zeros(size, np.uint8)
        start = np.flatnonzero(edge & m)
        if len(start):
            last = np.searchsorted(start, np.arange(size), side="right") - 1
            opener = np.where(last >= 0, data[start[np.maximum(last, 0)]], 0)
        cand = np.flatnonzero(both & (opener[:-1] == data[:-1]))
        # Runs of four and more quotes pair up from the left: every other one of consecutive candidates.
        head = np.flatnonzero(np.concatenate([[True], np.diff(cand) != 1])) if len(cand) else cand
        drop[cand[(np.arange(len(cand)) - np.repeat(head, np.diff(np.append(head, len(cand))))) % 2 == 0] + 1] = True

    text = (inside | ~is_sep) & ~edge
    used = text | edge  # a value is a run of text and enclosing quotes
    change = np.concatenate([[True], row[1:] != row[:-1]])
    begins = used & (change | ~np.concatenate([[False], used[:-1]]))
    # A separator inside quotes is used, so a run never ends there; two quoted values that touch stay one value.
    starts = np.flatnonzero(begins)
    value_of = np.cumsum(begins) - 1
    kept = text & ~drop
    lengths = np.bincount(value_of[kept], minlength=len(starts)) if len(starts) else np.zeros(0, np.int64)
    out = data[kept]
    offsets = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    items = pa.StringArray.from_buffers(len(starts), pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(out)))
    owner = row[starts]
    some = lengths > 0

    # Whole fields that mean nothing.
    per_row = np.bincount(owner[some], minlength=n)
    bare = ~(d_rows | s_rows)
    first = offsets[:-1]
    dot = (lengths == 1) & (out[np.minimum(first, max(len(out) - 1, 0))] == 46) if len(out) else np.zeros(len(starts), bool)
    na = (lengths == 2) & (out[np.minimum(first, max(len(out) - 2, 0))] == 78) & (out[np.minimum(first + 1, max(len(out) - 1, 0))] == 65) if len(out) else dot
    void = (dot | na) & (per_row[owner] == 1) & bare[owner]
    some &= ~void
    items = items.filter(pa.array(some))
    counts = np.bincount(owner[some], minlength=n)
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)), items)


def unpack(df: DataFrame, key: str, field: str, separators: str = ";,|") -> DataFrame:
    """Rows (row_key, pos, item) of one packed field. One narrow stage: rows stay in the task that read them."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = split_packed(batch.column(1), separators)
            off = lists.offsets.to_numpy()
            counts = np.diff(off)
            owner = np.repeat(np.arange(len(counts)), counts)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(owner)), pa.array((_ramp(counts) + 1).astype(np.int32)), lists.values], names=["row_key", "pos", "item"])

    narrow = df.select(F.col(key).cast("string").alias("row_key"), F.col(field).cast("string").alias("packed")).where(F.col("packed").isNotNull())
    return narrow.mapInArrow(run, "row_key string, pos int, item string")
