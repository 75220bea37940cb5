"""Encoding of a whole corpus with a public byte-level BPE tokenizer.

Method: a segment tree over the ranks of adjacent pairs. Each leaf holds the rank of the merge of a symbol with its right neighbour
(or infinity), each node the lowest rank below it. The root gives the next merge and a descent that prefers the left child
gives its leftmost place; the merge changes three leaves, and each is carried up in a logarithmic number of steps. A piece
is done when the root is infinite.

Pieces (the pattern's matches) repeat, so every worker keeps a bounded table of pieces already encoded. Short pieces of a batch are
encoded together: their trees are rows of one numpy array and every round merges once in each tree that is not done. Long
pieces get a tree of their own, so a text without any boundary costs n log n.

Defined results
    * null and empty texts give an empty list; one row comes out for every row that goes in, repeated ids included
    * strings of special tokens are ordinary text; texts are encoded whole and as they are
    * extra columns are left behind
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seedwork.llm.spread import spread

INF = np.int32(2**31 - 1)
#: The published pattern of the vocabulary, with white space named as the property. Fixed value.
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\p{White_Space}\p{L}\p{N}]+|\p{White_Space}+(?!\P{White_Space})|\p{White_Space}+"
DEFAULT = "byte_bpe_50k.json"
#: Bounds of the table of known pieces, in entries and in the length of a piece, and the width up to which trees are dealt with together.
KNOWN, KNOWN_LENGTH, TOGETHER = 400_000, 64, 128


def tokenizer_path(name: str = DEFAULT) -> str:
    """The place of a vocabulary file of the installed public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_names() -> dict[str, int]:
    """The printable names that byte-level vocabularies give to bytes: printable Latin-1 names itself, the rest counts up from 256."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


class ByteBpe:
    """One vocabulary: ids of bytes, and merges as sorted pair keys with their ranks and results."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as f:
            model = json.load(f)["model"]
        vocab: dict[str, int] = model["vocab"]
        names = _byte_names()
        self.byte_id = np.zeros(256, dtype=np.int32)
        for name, b in names.items():
            self.byte_id[b] = vocab[name]
        pairs = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in model["merges"]]
        self.base = max(vocab.values()) + 1
        key = np.array([vocab[a] * self.base + vocab[b] for a, b in pairs], dtype=np.int64)
        made = np.array([vocab[a + b] for a, b in pairs], dtype=np.int32)
        order = np.argsort(key, kind="stable")
        self.keys, self.ranks, self.made = key[order], order.astype(np.int32), made
        self.rank_of = {int(k): i for i, k in enumerate(key)}
        self.find = regex.compile(PATTERN).findall
        self.known: dict[str, np.ndarray] = {}

    def pair_ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Rank of the merge of a and b, infinity where there is none."""
        key = a.astype(np.int64) * self.base + b
        at = np.minimum(np.searchsorted(self.keys, key), len(self.keys) - 1)
        return np.where(self.keys[at] == key, self.ranks[at], INF)

    def encode_long(self, data: bytes) -> np.ndarray:
        """One piece with a tree of its own."""
        sym = self.byte_id[np.frombuffer(data, np.uint8)]
        n = len(sym)
        size = 1 << max(1, (n - 1).bit_length())
        tree = np.full(2 * size, INF, dtype=np.int32)
        tree[size : size + n - 1] = self.pair_ranks(sym[:-1], sym[1:])
        level = size
        while level > 1:
            tree[level // 2 : level] = np.minimum(tree[level : 2 * level : 2], tree[level + 1 : 2 * level : 2])
            level //= 2
        t, s, inf = tree.tolist(), sym.tolist(), int(INF)
        nxt, prv = list(range(1, n + 1)), list(range(-1, n - 1))
        get, base, made = self.rank_of.get, self.base, self.made
        alive = bytearray(b"\1") * n

        def put(i: int, value: int) -> None:
            i += size
            t[i] = value
            i >>= 1
            while i:
                low = t[2 * i] if t[2 * i] <= t[2 * i + 1] else t[2 * i + 1]
                if t[i] == low:
                    return
                t[i] = low
                i >>= 1

        while t[1] != inf:
            best, i = t[1], 1
            while i < size:
                i = 2 * i if t[2 * i] == best else 2 * i + 1
            i -= size
            j = nxt[i]
            s[i] = int(made[best])
            alive[j] = 0
            k = nxt[j]
            nxt[i] = k
            if k < n:
                prv[k] = i
            put(j, inf)
            put(i, get(s[i] * base + s[k], inf) if k < n else inf)
            p = prv[i]
            if p >= 0:
                put(p, get(s[p] * base + s[i], inf))
        return np.array([x for x, a in zip(s, alive) if a], dtype=np.int32)

    def encode_together(self, pieces: list[bytes], width: int) -> list[np.ndarray]:
        """Pieces of at most ``width`` bytes (a power of two), one tree a row."""
        n = len(pieces)
        length = np.fromiter(map(len, pieces), np.int64, n)
        raw = np.frombuffer(b"".join(p.ljust(width, b"\0") for p in pieces), np.uint8).reshape(n, width)
        place = np.arange(width)
        there = place < length[:, None]
        # One more column on the right, which stands for "no symbol".
        sym = np.zeros((n, width + 1), dtype=np.int32)
        sym[:, :width] = np.where(there, self.byte_id[raw], 0)
        tree = np.full((n, 2 * width), INF, dtype=np.int32)
        tree[:, width : 2 * width - 1] = np.where(there[:, 1:], self.pair_ranks(sym[:, : width - 1], sym[:, 1:width]), INF)
        level = width
        while level > 1:
            tree[:, level // 2 : level] = np.minimum(tree[:, level : 2 * level : 2], tree[:, level + 1 : 2 * level : 2])
            level //= 2
        nxt = np.tile(np.minimum(place + 1, width).astype(np.int32), (n, 1))
        nxt[np.arange(n), length - 1] = width
        prv = np.tile((np.arange(width + 1) - 1).astype(np.int32), (n, 1))
        rows = np.flatnonzero(tree[:, 1] != INF)
        while len(rows):
            best = tree[rows, 1]
            node = np.ones(len(rows), dtype=np.int64)
            while node[0] < width:
                node = 2 * node
                node += tree[rows, node] != best
            i = node - width
            j = nxt[rows, i]
            k = nxt[rows, j]
            new = self.made[best]
            sym[rows, i] = new
            there[rows, j] = False
            nxt[rows, i] = k
            prv[rows, k] = i
            right = np.where(k < width, self.pair_ranks(new, sym[rows, k]), INF)
            p = prv[rows, i]
            has = p >= 0
            self._put(tree, rows, j, np.full(len(rows), INF, np.int32), width)
            self._put(tree, rows, i, right, width)
            rp = rows[has]
            self._put(tree, rp, p[has], self.pair_ranks(sym[rp, p[has]], new[has]), width)
            rows = rows[tree[rows, 1] != INF]
        return [sym[r, :width][there[r]] for r in range(n)]

    @staticmethod
    def _put(tree: np.ndarray, rows: np.ndarray, leaf: np.ndarray, value: np.ndarray, width: int) -> None:
        node = leaf.astype(np.int64) + width
        tree[rows, node] = value
        while len(node) and node[0] > 1:
            node >>= 1
            tree[rows, node] = np.minimum(tree[rows, 2 * node], tree[rows, 2 * node + 1])

    def encode_batch(self, texts: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and ids of a batch of texts."""
        split = [self.find(t) if t else [] for t in texts]
        known, now = self.known, {}
        todo: dict[int, list[tuple[str, bytes]]] = {}
        for parts in split:
            for piece in parts:
                if piece in known or piece in now:
                    continue
                data = piece.encode("utf-8")
                now[piece] = None
                if len(data) == 1:
                    now[piece] = self.byte_id[[data[0]]]
                elif len(data) > TOGETHER:
                    now[piece] = self.encode_long(data)
                else:
                    todo.setdefault(1 << (len(data) - 1).bit_length(), []).append((piece, data))
        for width, items in todo.items():
            step = max(256, (1 << 21) // width)
            for a in range(0, len(items), step):
                part = items[a : a + step]
                for (piece, _), ids in zip(part, self.encode_together([d for _, d in part], width)):
                    now[piece] = ids
        out: list[np.ndarray] = []
        counts = np.zeros(len(texts) + 1, dtype=np.int64)
        for r, parts in enumerate(split):
            total = 0
            for piece in parts:
                ids = known.get(piece)
                if ids is None:
                    ids = now[piece]
                out.append(ids)
                total += len(ids)
            counts[r + 1] = total
        if len(known) + len(now) > KNOWN:
            known.clear()
        known.update((p, i) for p, i in now.items() if len(p) <= KNOWN_LENGTH)
        return np.cumsum(counts), (np.concatenate(out) if out else np.zeros(0, np.int32))


@lru_cache(maxsize=2)
def load(path: str) -> ByteBpe:
    """The vocabulary, once a worker."""
    return ByteBpe(path)


def _chunks(batch: pa.RecordBatch, limit: int = 4 << 20) -> Iterator[pa.RecordBatch]:
    """Slices with about ``limit`` bytes of text each, at least one row, so that very long texts don't add up."""
    sizes = np.cumsum(np.diff(np.frombuffer(batch.column(1).cast(pa.large_string()).fill_null("").buffers()[1] or b"\0" * 8, dtype=np.int64)[: len(batch) + 1])) if len(batch) else np.zeros(0)
    start = 0
    while start < len(batch):
        done = sizes[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(sizes, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def encode(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, ids: str = "ids") -> DataFrame:
    """(key, ids) of every row. Only the two columns are read."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for part in _chunks(batch):
                offsets, flat = bpe.encode_batch(part.column(1).to_pylist())
                lists = pa.ListArray.from_arrays(pa.array(offsets.astype(np.int32)), pa.array(flat))
                yield pa.RecordBatch.from_arrays([part.column(0), lists], names=["k", "ids"])

    narrow = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    kind = narrow.schema["k"].dataType.simpleString()
    return spread(narrow).mapInArrow(run, f"k {kind}, ids array<int>").select(F.col("k").alias(key), F.col("ids").alias(ids))


def count_tokens(df: DataFrame, key: str = "doc_id", text: str = "text", path: str | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
    """(key, carry..., n_tokens): lengths only, so that ids never leave the Python worker."""
    path = path or tokenizer_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            for part in _chunks(batch):
                offsets, _ = bpe.encode_batch(part.column(1).to_pylist())
                rest = [part.column(i) for i in range(2, part.num_columns)]
                yield pa.RecordBatch.from_arrays([part.column(0), *rest, pa.array(np.diff(offsets))], names=["k", *names, "n"])

    names = [f"c{i}" for i in range(len(carry))]
    narrow = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"), *[F.col(c).alias(n) for c, n in zip(carry, names)])
    schema = ", ".join([f"{f} {narrow.schema[f].dataType.simpleString()}" for f in ["k", *names]] + ["n bigint"])
    return spread(narrow).mapInArrow(run, schema).select(F.col("k").alias(key), *[F.col(n).alias(c) for c, n in zip(carry, names)], F.col("n").alias("n_tokens"))
