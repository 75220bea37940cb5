"""Differences between two copies of a dataset, field by field.

Method for copies whose key may repeat: identical rows cancel by multiplicity; what is left is paired within
each key through a minimum-cost assignment on the number of differing fields.

Plan
    1. Both sides are tagged, stacked and grouped by *all* compared columns with two counts. The rows of a hot key spread over
       all tasks, since the whole row is the grouping key, and repeated rows collapse before the shuffle. What does not
       cancel is written once.
    2. Small facts by key: rows left on each side, and on which sides the key occurs at all (a scan of the key columns).
    3. Keys with one leftover row on each side, the usual case, are paired by an equi-join: no Python.
    4. Keys with more leftovers, of any number, are solved exactly by one method (``_Pairing``), a key in one group: shortest paths over
       integer costs, with copies as supply and demand. Rows that agree in all but one, two, ... groups of columns are linked, and what the
       links join is solved first, up to the price at which other rows could matter; only rows that still have copies then look further.
       Memory grows with the rows of the key, work at worst with the pairs of them. No row is dropped and nothing is paired by rank.

Defined results
    * a key on one side only           -> one row ``only_left`` / ``only_right`` (names are options)
    * key on both, leftovers unpaired  -> kind ``extra_left`` / ``extra_right``, once per row left over
    * null equals only null, text is compared character by character, null keys are a key like any other
    * ``distinct=True``: repeats of a row within one side count once, so a different number of repeats is no difference
    * columns held by one side only are not compared
    * empty tables: every row of the other side is one-sided
    * of several pairings of least cost one is taken, by the values of the rows alone: order and partitions of the input, ``limit`` and other keys do not matter
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from itertools import combinations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedwork.session import durable

_L, _R = "__left", "__right"


_FAR = np.iinfo(np.int32).max // 2


def _fill(cost: Callable[[int], np.ndarray], u: np.ndarray, v: np.ndarray, left: np.ndarray, room: np.ndarray, flow: list[dict[int, int]], cap: int | None = None) -> None:
    """Ship ``left`` of the rows into ``room`` of the columns at least cost, on top of ``flow`` ({row: copies} by column); all are changed in place.

    Primal-dual method for integer costs: prices ``u`` of rows and ``v`` of columns never sum to more than a pair's cost, copies go over tight pairs
    only, and columns with room have price 0; so a complete flow is of least cost. A phase searches from all rows with copies left, through
    rows that could ship elsewhere, to columns with room, each row and column once; if it moves nothing, prices of what it reached are
    shifted to the next tight pair. With ``cap`` the prices of rows stop there: rows may keep copies, and flow and prices can be carried on.
    """
    n, m = len(u), len(v)
    while left.any():
        slack, source = np.full(m, _FAR, np.int32), np.full(m, -1)  # over what a column is short of being tight, and for which reached row
        seen, met, via = np.zeros(n, bool), np.zeros(m, bool), np.full(n, -1)
        moved = False

        def push(i: int, j: int) -> int:
            """Move copies along the path that ends in row i and column j, as many as all of it allows."""
            path, k = [], i
            while via[k] >= 0:
                path.append((k, via[k]))
                k = source[via[k]]
            some = int(min(left[k], room[j], *[flow[c].get(r, 0) for r, c in path]))
            if some:
                to = j
                for r, c in [*path, (k, -1)]:
                    flow[to][r] = flow[to].get(r, 0) + some
                    if c >= 0:
                        flow[c][r] -= some
                        if not flow[c][r]:
                            del flow[c][r]
                    to = c
                left[k] -= some
                room[j] -= some
            return some

        def onward(i: int, tight: np.ndarray) -> Iterator[int]:
            for j in tight:
                if not met[j] and not room[j]:
                    met[j], source[j] = True, i
                    yield from others(j)

        def others(j: int) -> Iterator[int]:
            for k in sorted(flow[j]):
                if not seen[k] and flow[j].get(k):
                    seen[k], via[k] = True, j
                    yield k

        def search(at: int) -> bool:
            """Depth first from a row marked as seen; true if copies moved."""
            path, found = [], False
            while True:
                short = cost(at) - u[at] - v
                short[met] = _FAR
                closer = np.flatnonzero(short < slack)
                slack[closer], source[closer] = short[closer], at
                tight = np.flatnonzero(short == 0)
                path.append((at, onward(at, tight)))
                hit = False
                for j in tight[room[tight] > 0]:
                    if not push(at, j):
                        break
                    hit = True
                if hit:  # what hangs on a used-up part of the path is left for the next phase
                    found = True
                    if via[path[0][0]] < 0 and not left[path[0][0]]:
                        return True
                    path = path[: next((d for d, (r, _) in enumerate(path) if via[r] >= 0 and not flow[via[r]].get(r)), len(path))]
                at = None
                while path and (at := next(path[-1][1], None)) is None:
                    path.pop()
                if at is None:
                    return found

        for i in np.flatnonzero(left):
            seen[i] = True
        for i in np.flatnonzero(left):
            moved |= search(i)
        while not moved:
            open_ = np.flatnonzero(~met)
            step = int(slack[open_].min()) if len(open_) else _FAR
            if cap is not None:
                step = min(step, cap - int(u[seen].max()))
            if step >= _FAR // 2:
                raise ValueError("less demand than supply")
            u[seen] += step
            v[met] -= step
            slack[open_] -= step
            near = open_[slack[open_] == 0]
            if not len(near):
                return
            for j in near:
                if met[j]:
                    continue
                if room[j]:
                    moved |= push(source[j], j) > 0
                else:
                    met[j] = True
                    for k in others(j):
                        moved |= search(k)


def transport(cost: np.ndarray, supply: np.ndarray, demand: np.ndarray) -> np.ndarray:
    """Least-cost shipment of all of ``supply`` (rows) into ``demand`` (columns), which holds at least as much: the flow matrix. Costs are whole numbers."""
    n, m = cost.shape
    cost, out = cost.astype(np.int32), np.zeros((n, m), np.int64)
    flow: list[dict[int, int]] = [{} for _ in range(m)]
    if n and m:
        _fill(lambda i: cost[i], cost.min(axis=1), np.zeros(m, np.int32), supply.astype(np.int64), demand.astype(np.int64), flow)
    for j, ships in enumerate(flow):
        for i, some in ships.items():
            out[i, j] = some
    return out


def _numbered(*codes: np.ndarray) -> np.ndarray:
    """Numbers from 0 for the different combinations of codes."""
    out = codes[0]
    for c in codes[1:]:
        out = np.unique(out.astype(np.int64) * (int(c.max()) + 1) + c, return_inverse=True)[1]
    return out


class _Pairing:
    """Least-cost pairing of the rows of two sides, given as codes per column; cost is the number of columns that differ, at least 1."""

    def __init__(self, x: np.ndarray, y: np.ndarray, supply: np.ndarray, demand: np.ndarray, limit: int) -> None:
        self.x, self.y, self.limit = x, y, limit
        self.left, self.room = supply.astype(np.int64), demand.astype(np.int64)
        self.u, self.v = np.ones(len(x), np.int32), np.zeros(len(y), np.int32)
        self.flow: list[dict[int, int]] = [{} for _ in range(len(y))]

    def costs(self, rows: np.ndarray, cols: np.ndarray) -> Callable[[int], np.ndarray]:
        x, y = self.x[rows], np.ascontiguousarray(self.y[cols].T)

        def one(i: int) -> np.ndarray:
            out = np.zeros(y.shape[1], np.int16)
            for c, value in enumerate(x[i]):
                out += y[c] != value
            return out.astype(np.int32)

        if max(len(rows), len(cols)) > self.limit:
            return one
        matrix = np.stack([one(i) for i in range(len(rows))])
        return lambda i: matrix[i]

    def solve(self, groups: int = 6) -> list[dict[int, int]]:
        """The flow, {row: copies} by column.

        Rows that are not linked by agreeing in all but k groups of columns differ in k + 1 columns at least. So prices up to k + 1 hold for them too,
        and what is linked can be filled by itself up to there.
        """
        d, n = self.x.shape[1], len(self.x)
        groups = min(groups, d)
        both = np.concatenate([self.x, self.y]).astype(np.int64)
        parts = [_numbered(*[both[:, c] for c in range(g, d, groups)]) for g in range(groups)]
        label = np.arange(len(both))
        for k in range(1, groups):
            if not self.left.any():
                return self.flow
            label = self.linked([_numbered(*[p for g, p in enumerate(parts) if g not in out]) for out in combinations(range(groups), k)], label)
            order = np.argsort(label, kind="stable")  # rows of x come first within a label
            for ids in np.split(order, np.flatnonzero(np.diff(label[order])) + 1):
                cut = np.searchsorted(ids, n)
                if self.left[ids[:cut]].any():
                    self.fill(ids[:cut], ids[cut:] - n, k + 1)
        if self.left.any():
            self.fill(np.arange(n), np.arange(len(self.y)), None)
        return self.flow

    def linked(self, signs: list[np.ndarray], label: np.ndarray) -> np.ndarray:
        """Labels of the components that signatures held by both sides make of the ones labelled before: the lowest row's number."""
        n = len(self.x)
        held = []
        for sign in signs:
            on = np.zeros((2, int(sign.max()) + 1), bool)
            on[0, sign[:n]], on[1, sign[n:]] = True, True
            at = np.flatnonzero(on.all(axis=0)[sign])
            if len(at):
                held.append((at, sign[at], on.shape[1]))
        while True:
            before = label
            for at, sign, size in held:
                low = np.full(size, len(label))
                np.minimum.at(low, sign, label[at])
                label = label.copy()
                np.minimum.at(label, label[at], low[sign])  # the component's first row carries it on
                while (label[label] != label).any():
                    label = label[label]
            if (label == before).all():
                return label

    def fill(self, rows: np.ndarray, cols: np.ndarray, cap: int | None) -> None:
        if not len(cols):
            self.u[rows] = cap
            return
        at = {int(r): i for i, r in enumerate(rows)}
        flow = [{at[r]: some for r, some in self.flow[c].items()} for c in cols]
        u, v, left, room = self.u[rows], self.v[cols], self.left[rows], self.room[cols]
        _fill(self.costs(rows, cols), u, v, left, room, flow, cap)
        self.u[rows], self.v[cols], self.left[rows], self.room[cols] = u, v, left, room
        for c, ships in zip(cols, flow):
            self.flow[c] = {int(rows[i]): some for i, some in ships.items()}


def assign(cost: np.ndarray) -> np.ndarray:
    """Minimum-cost assignment of the rows of an n x m matrix, n <= m: the column of each row."""
    n, m = cost.shape
    return transport(cost, np.ones(n), np.ones(m)).argmax(axis=1) if n else np.zeros(0, np.int64)


def _same(a: Column, b: Column) -> Column:
    return a.eqNullSafe(b)


def leftovers(left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str], distinct: bool) -> DataFrame:
    """The different rows that do not cancel, with the copies that remain on each side: ``__left`` and ``__right``."""
    both = [*key, *columns]
    stacked = left.select(*both, F.lit(1).alias(_L), F.lit(0).alias(_R)).unionByName(right.select(*both, F.lit(0).alias(_L), F.lit(1).alias(_R)))
    total = F.max if distinct else F.sum
    counted = stacked.groupBy(*both).agg(total(_L).cast("long").alias(_L), total(_R).cast("long").alias(_R))
    return counted.select(*both, F.greatest(F.col(_L) - F.col(_R), F.lit(0)).alias(_L), F.greatest(F.col(_R) - F.col(_L), F.lit(0)).alias(_R)).where((F.col(_L) > 0) | (F.col(_R) > 0))


def diff_copies(left: DataFrame, right: DataFrame, key: Sequence[str], columns: Sequence[str] | None = None, *, distinct: bool = False, only_left: str = "only_left", only_right: str = "only_right", limit: int = 1024) -> DataFrame:
    """Report (key..., kind, n): one-sided keys, differing fields of paired rows (kind = column name, n = pairs that differ in it), extra rows.

    ``limit``: costs between up to so many rows a side are held as a matrix, else computed row by row. It bounds memory; the report is the same.
    """
    key = list(key)
    if columns is None:
        there = set(right.columns)
        columns = [c for c in left.columns if c in there and c not in key]
    columns = list(columns)
    keys = [f"__k{i}" for i in range(len(key))]
    cols = [f"__c{i}" for i in range(len(columns))]
    pick = [F.col(f"`{c}`").alias(n) for c, n in zip([*key, *columns], [*keys, *cols])]
    left, right = left.select(*pick), right.select(*pick)
    on_key = lambda a, b: [_same(_At(a)[k], _At(b)[k]) for k in keys]

    # The one wide shuffle. What is left is as large as the differences and is read several times, so it is written once.
    rest = durable(leftovers(left, right, keys, cols, distinct))
    facts = rest.groupBy(*keys).agg(F.sum(_L).alias("__n_left"), F.sum(_R).alias("__n_right"))
    # A key whose rows on one side all cancelled is there too: keys alone are scanned again, collapsed before their shuffle.
    seen = left.select(*keys).distinct().withColumn("__side", F.lit(1)).unionByName(right.select(*keys).distinct().withColumn("__side", F.lit(2)))
    sides = seen.alias("e").join(facts.select(*keys).alias("f"), on_key("e", "f"), "left_semi").groupBy(*keys).agg(F.sum("__side").alias("__sides"))
    facts = durable(facts.alias("f").join(sides.alias("s"), on_key("f", "s")).select("f.*", "s.__sides"))

    sided = facts.where(F.col("__sides") != 3).select(*keys, F.when(F.col("__sides") == 1, only_left).otherwise(only_right).alias("kind"), F.lit(1).cast("long").alias("n"))
    shared = facts.where(F.col("__sides") == 3)

    simple = shared.where((F.col("__n_left") == 1) & (F.col("__n_right") == 1)).select(*keys).alias("s")
    a, b = rest.where(F.col(_L) > 0).alias("a"), rest.where(F.col(_R) > 0).alias("b")
    paired = simple.join(a, on_key("s", "a")).join(b, on_key("s", "b"))
    named = F.filter(F.array(*[F.when(~_same(F.col(f"a.{c}"), F.col(f"b.{c}")), F.lit(name)) for c, name in zip(cols, columns)], F.lit(None).cast("string")), lambda x: x.isNotNull())
    fields = paired.select(*[F.col(f"s.{k}").alias(k) for k in keys], F.explode(named).alias("kind")).withColumn("n", F.lit(1).cast("long"))

    hard = shared.where((F.col("__n_left") != 1) | (F.col("__n_right") != 1)).select(*keys)
    wide = rest.alias("r").join(hard.alias("h"), on_key("r", "h"), "left_semi")
    out = sided.unionByName(fields).unionByName(_assign(wide, keys, cols, columns, limit))
    return out.select(*[F.col(k).alias(c) for k, c in zip(keys, key)], "kind", "n")


class _At:
    """Column access by alias."""

    def __init__(self, alias: str) -> None:
        self.alias = alias

    def __getitem__(self, name: str) -> Column:
        return F.col(f"{self.alias}.{name}")


def _text(df: DataFrame, name: str) -> Column:
    """A value as text, equal if and only if the values are (null stays null)."""
    kind = df.schema[name].dataType
    if isinstance(kind, T.BinaryType):
        return F.hex(name)
    if isinstance(kind, (T.ArrayType, T.StructType, T.MapType)):
        return F.to_json(F.struct(name))
    return (F.col(name) + F.lit(0).cast(kind) if isinstance(kind, (T.DoubleType, T.FloatType)) else F.col(name)).cast("string")


def _assign(rest: DataFrame, keys: list[str], cols: list[str], columns: list[str], limit: int) -> DataFrame:
    """Exact assignment within keys.

    Copies are not expanded: the assignment is a transport problem between different rows, with copies as supply and demand, so the
    work depends on different rows only. Values go to Python as texts and are compared as such, never as floats.
    """
    out = T.StructType([*[rest.schema[k] for k in keys], T.StructField("kind", T.StringType()), T.StructField("n", T.LongType())])
    narrow = rest.select(*keys, _L, _R, *[_text(rest, c).alias(c) for c in cols])

    def solve(table: pa.Table) -> pa.Table:
        found = _solve(table, cols, columns, limit)
        head = [table.column(k).combine_chunks().take(pa.array([0] * len(found), pa.int64())) for k in keys]
        return pa.table([*head, pa.array(list(found), pa.string()), pa.array(list(found.values()), pa.int64())], names=out.names)

    return narrow.groupBy(*keys).applyInArrow(solve, out)


def _solve(table: pa.Table, cols: list[str], columns: list[str], limit: int) -> dict[str, int]:
    """Differing fields of the least-cost pairs of one group, and how many copies stay unpaired.

    Values are numbered by their order and rows are put in order, so that the pairs depend on the rows only.
    """
    nl, nr = (table.column(c).to_numpy().astype(np.int64) for c in (_L, _R))
    code = np.stack([pc.rank(table.column(c), null_placement="at_start", tiebreaker="dense").to_numpy() for c in cols], axis=1).astype(np.int32) if cols else np.zeros((len(table), 0), np.int32)
    vary = np.flatnonzero((code != code[:1]).any(axis=0))
    order = np.lexsort(code[:, vary].T[::-1]) if len(vary) else np.arange(len(code))
    nl, nr, code = nl[order], nr[order], code[order][:, vary]
    x, y = np.flatnonzero(nl > 0), np.flatnonzero(nr > 0)
    found: dict[str, int] = {}
    if len(x) and len(y):
        swap = nl.sum() > nr.sum()
        a, b, supply, demand = (y, x, nr, nl) if swap else (x, y, nl, nr)
        flow = _Pairing(code[a], code[b], supply[a], demand[b], limit).solve()
        i, j, some = (np.array(z) for z in zip(*[(i, j, n) for j, ships in enumerate(flow) for i, n in ships.items()]))
        for c, at in enumerate(vary):
            differ = int(some[code[a[i], c] != code[b[j], c]].sum())
            if differ:
                found[columns[at]] = differ
    for kind, more in (("extra_left", nl.sum() - nr.sum()), ("extra_right", nr.sum() - nl.sum())):
        if more > 0:
            found[kind] = int(more)
    return found
