"""Abusive, hateful or sexual content: a score for every document and the rate per source.

Method: weak supervision. Many patterns over words, gathered into voters, vote on every sentence of every document or abstain. A
generative label model (a log-linear model of the votes in each of two classes, with a term for every voter and for every pair of voters
of one sign) is fitted to the vote patterns of the whole corpus; so it estimates how far each voter can be trusted and how far voters
repeat each other. Where the corpus has labels, raters are further voters, on whole documents, with accuracies of their own. A linear
classifier over hashed words, word pairs and fulfilled patterns is trained on the posterior labels of a bounded sample and scores every
sentence; a document's score is its highest.

Spelling: zero-width characters go, look-alike letters of other scripts, digits and signs in words and accents become plain
letters, letters set apart by blanks, dots or hyphens are joined, drawn-out letters shortened; ``*`` stands for any letter. Words are
compared by their letters regardless of order, so swapped letters change nothing, but for words that share their letters with
ordinary ones ("shit", "this"), which are compared as written.

Plan
    * A first pass over all texts counts vote patterns map side (there are at most 2 ** voters, so the counts, and the label model on the
      driver, are bounded whatever the corpus) and marks the documents with votes. It is written once.
    * The training sample is drawn by thresholds on a hash of the document's key, set from counted rows: about ``SAMPLE`` labelled
      documents, (those that a rater flagged and the others apart), documents with votes and documents of any kind each. No other text leaves its task.
    * A second pass scores all sentences of all documents, whole texts, with the weights (1 MB) handed to every task.
    * Words are normalised once and kept in a bounded table; features of a batch are numpy arrays.

Defined results
    * null, empty and blank texts have score 0; every row of the input gets one row, repeated ids included
    * texts without sentence ends are read in overlapping windows of words
    * an empty table gives no rows; a corpus without any vote gives scores near 0
    * labels: null labels and labels of unknown documents say nothing, of repeated ones of a rater the last holds (of one time, the higher)
    * extra columns are not read
"""

from __future__ import annotations

import math
import re
import unicodedata
import zlib
from collections.abc import Iterator, Sequence
from functools import cached_property, lru_cache, reduce
from itertools import chain
from operator import itemgetter, or_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedwork.llm.abuse_patterns import LISTS, PATTERNS, VOTERS
from seedwork.llm.spread import spread
from seedwork.session import durable

#: Documents of each kind in the training sample, sentences of one document in it, hashed dimensions, score from which a document counts, words in a window and its step.
SAMPLE, PER_DOC, DIMENSIONS, THRESHOLD, WINDOW, STEP = 6_000, 200, 1 << 18, 0.5, 48, 24
#: Sentences with fewer features are scaled as if they had so many, so that one odd word decides nothing.
SHORT = 8
#: Letters set apart that are searched for words at once; longer runs go in windows that overlap by the longest word.
RUN = 400
#: The most that votes alone can say, in log-odds.
SURE = 4.0
#: With ratings: weight of a sentence of an unrated document in training (that of a rated one is 1), weight that abuse has besides, and passes over the ratings.
UNRATED, ABUSIVE, PASSES = 0.005, 2.0, 8
#: Steps of the label model, and the strength of its prior in sentences.
ROUNDS, PRIOR = 12, 20.0
_KNOWN = 200_000  # words kept normalised in a worker
_QUIET = 1 << (len(VOTERS) - 1)  # the vote for sentences without any word of interest

#: Letters of other scripts that look like Latin ones. Fixed values.
_ALIKE = str.maketrans("авесіјкмнорѕтухѵԁɡһԛԝӏαβεικνορτυχγ", "abecijkmhopstyxvdghqwlabeiknoptuxy")
#: Digits and signs that stand for letters inside words. Fixed values.
_LEET = str.maketrans("@431!05$7", "aaeiioSst".lower())
_HIDDEN = re.compile("[\x00-\x08\x0e-\x1f\x7f­͏؜​-‏‪-‮⁠-⁯﻿]")
_MARKS = re.compile("[̀-ͯ]+")
_SENTENCE = re.compile(r"(?<=[.!?…。！？])\s+|[\r\n\x0b\x0c\x85  ]+")
_REPEAT, _LONG = re.compile(r"(.)\1+"), re.compile(r"(.)\1{2,}")
_EDGE = ".,;:!?()[]{}<>\"'“”‘’«»¿¡…"
_SPELT = re.compile(rf"(?<!\S)(?:[{re.escape(_EDGE)}]*\S[{re.escape(_EDGE)}]*(?:\s+|\Z)){{3}}")


_OTHER, _DIGIT = re.compile(r"[\W\d_]+"), re.compile(r"\d")  # what is no letter; a digit
_FORMS, _HASHES, _BITS = itemgetter(0), itemgetter(1), itemgetter(2)


_NOTHING: tuple[tuple[str, ...], tuple[int, ...], int] = ((), (), 0)


def plain(word: str) -> str:
    """A word with look-alikes, case and accents undone."""
    if word.isascii():
        return word.lower()
    word = unicodedata.normalize("NFKC", word).casefold().translate(_ALIKE)
    return word if word.isascii() else _MARKS.sub("", unicodedata.normalize("NFD", word))


def letters(word: str) -> str:
    """A word's letters in alphabetical order."""
    return "".join(sorted(word))


def forms_of(word: str, exact: frozenset[str] | set[str] = frozenset()) -> tuple[str, ...]:
    """The letters of a word; of a drawn-out one (a letter three times and more), with single and with double letters. Words of ``exact`` come as ``=word`` too."""
    spelt = (_LONG.sub(r"\1", word), _LONG.sub(r"\1\1", word)) if _LONG.search(word) else (word,)
    return tuple(dict.fromkeys([*map(letters, spelt), *[f"={w}" for w in spelt if w in exact]]))


def alternatives(item: str) -> list[str]:
    """The words of one item of a pattern: ``a/b/@list``."""
    return list(dict.fromkeys(w for x in item.split("/") for w in (LISTS[x[1:]].split() if x.startswith("@") else [x])))


def _spelt(raw: list[str], part: str) -> bool:
    """Whether a sentence holds letters set apart: at least three words of one letter, which may bear punctuation, in a row."""
    sizes = list(map(len, raw))
    one = sizes.count(1)
    return one + sizes.count(2) + sizes.count(3) >= 3 and one > 0 and bool(_SPELT.search(part))


class _Words(dict):
    """Words already normalised, as many as are bounded; others are made when they are asked for."""

    def __init__(self, owner: Matcher) -> None:
        super().__init__()
        self.owner = owner

    def __missing__(self, raw: str) -> tuple[tuple[str, ...], tuple[int, ...], int]:
        if raw.isascii() and raw.upper() == raw.lower() and "*" not in raw:
            return _NOTHING  # numbers and signs
        got = self.owner._entry(self.owner._word(raw))
        if len(raw) <= 8 or len(raw) <= 40 and not _DIGIT.search(raw):  # identifiers and numbers seldom come again
            if len(self) >= _KNOWN:
                self.clear()
            self[raw] = got
        return got


class Matcher:
    """The patterns, compiled to an index from words to (pattern, bit)."""

    def __init__(self) -> None:
        names = [n for n, _ in VOTERS]
        self.patterns: list[tuple[int, int, int, int, int]] = []
        self.index: dict[str, list[tuple[int, int]]] = {}
        self.by_length: dict[int, list[str]] = {}
        self.words: set[str] = set()
        self.exact: set[str] = set()
        for number, line in enumerate(x for x in PATTERNS.strip().split("\n") if x):
            parts = [p.strip() for p in line.split("|")] + ["", ""]
            words, must, absent = parts[2].split(), parts[3].split(), parts[4].split()
            if int(parts[1]) == 1 and not must:  # any of many words: one bit will do
                words = ["/".join(words)]
            order = list(dict.fromkeys([*words, *must, *absent]))
            bits = {w: 1 << i for i, w in enumerate(order)}
            total = lambda ws: sum(bits[w] for w in ws)
            self.patterns.append((names.index(parts[0]), int(parts[1]), total(words), total(must), total(absent)))
            for item in order:
                for w in alternatives(item):
                    plain_word = w.removeprefix("=")
                    self.index.setdefault(w if w != plain_word else letters(w), []).append((number, bits[item]))
                    self.words.add(plain_word)
                    if w != plain_word:
                        self.exact.add(plain_word)
        for w in self.words:
            self.by_length.setdefault(len(w), []).append(w)
        self.long_words = [(w, _REPEAT.sub(r"\1", w)) for w in sorted(self.words) if len(w) >= 4]
        #: The items of all patterns lie behind each other in one number; a word's bits are those of all items it stands for.
        self.shift = [0]
        for number, _ in enumerate(self.patterns):
            width = max((bit for pairs in self.index.values() for n, bit in pairs if n == number), default=1).bit_length()
            self.shift.append(self.shift[-1] + width)
        self.bits = {w: sum({bit << self.shift[n] for n, bit in pairs}) for w, pairs in self.index.items()}
        #: token -> (its forms, their hashes, their bits); bits of a sentence -> (patterns, votes)
        self.known = _Words(self)
        self.told: dict[int, tuple[list[int], int]] = {}

    def word(self, raw: str) -> tuple[str, ...]:
        """The letter forms of one token; several if it hides several words."""
        return self.known[raw][0]

    def _entry(self, forms: Sequence[str]) -> tuple[tuple[str, ...], tuple[int, ...], int]:
        bits = 0
        for f in forms:
            bits |= self.bits.get(f, 0)
        return tuple(forms), tuple(zlib.crc32(f.encode()) for f in forms), bits

    def _word(self, raw: str) -> tuple[str, ...]:
        w = plain(raw).strip(_EDGE)
        if "*" in w:
            w = "".join(c for c in w if c.isalpha() or c == "*")
            if not any(c.isalpha() for c in w):
                return ()
            shape = re.compile(w.replace("*", "."))
            return tuple(dict.fromkeys(f for x in self.by_length.get(len(w), ()) if shape.fullmatch(x) for f in forms_of(x, self.exact)))
        if not w.isalpha():
            if not _OTHER.sub("", w):
                return ()
            w = _OTHER.sub("", w.translate(_LEET))
        return forms_of(w, self.exact) if w else ()

    def joined(self, run: str) -> list[str]:
        """Known words within letters that stood apart: the whole, or what it holds."""
        whole = letters(run)
        if run in self.exact or whole in self.index:
            return [*forms_of(run, self.exact)]
        if len(run) > RUN:
            step = RUN - max(map(len, self.words))
            return [f for a in range(0, len(run), step) for f in self.joined(run[a : a + RUN])[1:]] or [whole]
        short = _REPEAT.sub(r"\1", run)
        held = [f for w, once in self.long_words if once in short for f in forms_of(w, self.exact)]
        return [whole, *held]

    def _tokens(self, part: str) -> list:
        """The entries of one sentence's words."""
        raw = part.split()
        if not _spelt(raw, part):
            return list(filter(_FORMS, map(self.known.__getitem__, raw)))
        out, i = [], 0
        while i < len(raw):
            j = i
            while j < len(raw) and len(raw[j].strip(_EDGE)) == 1:
                j += 1
            if j - i >= 3:
                run = "".join(plain(x).strip(_EDGE) for x in raw[i:j]).translate(_LEET)
                out += [self._entry([f]) for f in self.joined("".join(c for c in run if c.isalpha()))]
                i = j
            else:
                out.append(self.known[raw[i]])
                i += 1
        return [e for e in out if e[0]]

    def parts(self, text: str) -> Iterator[list]:
        """The word entries of each sentence, long ones in windows."""
        for part in _SENTENCE.split(_HIDDEN.sub("", text.lower())):
            yield from self._windows(self._tokens(part))

    @staticmethod
    def _windows(words: list) -> list[list]:
        if len(words) <= WINDOW + STEP:
            return [words] if words else []
        return [words[a : a + WINDOW] for a in range(0, len(words) - STEP, STEP)]

    def masks(self, text: str) -> Iterator[int]:
        """The votes of each sentence; where it needs no windows and nothing is spelt out, its words are not put together."""
        bits_of = self.known.__getitem__
        for part in _SENTENCE.split(_HIDDEN.sub("", text.lower())):
            raw = part.split()
            if len(raw) <= WINDOW + STEP and not _spelt(raw, part):
                words = list(map(bits_of, raw))
                some = list(filter(None, map(_BITS, words)))
                if some:
                    yield self._votes(some)[1]
                elif any(map(_FORMS, words)):
                    yield _QUIET
            else:
                for words in self._windows(self._tokens(part)):
                    yield self.fulfilled(words)[1]

    def sentences(self, text: str) -> Iterator[list[str]]:
        """The letter forms of each sentence."""
        for words in self.parts(text):
            yield [f for e in words for f in e[0]]

    def fulfilled(self, words: list) -> tuple[list[int], int]:
        """The patterns that a sentence fulfils, and its votes as a mask. Sentences with the same words of interest are looked up."""
        some = list(filter(None, map(_BITS, words)))
        return self._votes(some) if some else ([], _QUIET)

    def _votes(self, some: list[int]) -> tuple[list[int], int]:
        bits = reduce(or_, some)
        got = self.told.get(bits)
        if got is None:
            if len(self.told) >= _KNOWN:
                self.told.clear()
            got = self.told[bits] = self._fulfilled(bits)
        return got[0], got[1] if got[1] or len(some) >= 3 else _QUIET

    def _fulfilled(self, bits: int) -> tuple[list[int], int]:
        out, mask = [], 0
        for number, (voter, least, some, must, absent) in enumerate(self.patterns):
            own = bits >> self.shift[number] & (1 << self.shift[number + 1] - self.shift[number]) - 1
            if own and (own & some).bit_count() >= least and own & must == must and not own & absent:
                out.append(number)
                mask |= 1 << voter
        return out, mask

    def hits(self, forms: list[str]) -> list[int]:
        """The patterns that a sentence of these forms fulfils."""
        return self.fulfilled([self._entry([f]) for f in forms])[0]


@lru_cache(maxsize=1)
def matcher() -> Matcher:
    return Matcher()


class Features:
    """Hashed features of many sentences: words, pairs of neighbouring words and fulfilled patterns, as flat arrays."""

    def __init__(self) -> None:
        self.words: list[int] = []
        self.n_words: list[int] = []
        self.hits: list[int] = []
        self.n_hits: list[int] = []

    def add(self, words: list, hits: list[int]) -> None:
        before = len(self.words)
        self.words.extend(chain.from_iterable(map(_HASHES, words)))
        self.n_words.append(len(self.words) - before)
        self.hits += hits
        self.n_hits.append(len(hits))

    def arrays(self) -> tuple[np.ndarray, np.ndarray]:
        """(feature, sentence) of every feature."""
        a = np.array(self.words, np.int64)
        s = np.repeat(np.arange(len(self.n_words)), self.n_words)
        pair = (a[:-1] * 31 + a[1:] * 17 + 7)[s[:-1] == s[1:]] & 0xFFFFFFFF
        h = np.array(self.hits, np.int64) * 7919 + 13
        return np.concatenate([a, pair, h]) % DIMENSIONS, np.concatenate([s, s[:-1][s[:-1] == s[1:]], np.repeat(np.arange(len(self.n_hits)), self.n_hits)])


def _narrow(df: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    return spread(df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"), *more))


def vote(df: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(k, mask, n): sentences by vote pattern and batch (k null), and the documents with a vote for abuse (n null, mask the votes of all their sentences)."""
    narrow = _narrow(df, key, text)
    kind = narrow.schema["k"].dataType
    positive = sum(1 << j for j, (_, s) in enumerate(VOTERS) if s > 0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = matcher()
        total: dict[int, int] = {}
        for batch in batches:
            rows, marks = [], []
            for r, t in enumerate(batch.column(1).to_pylist()):
                if not t:
                    continue
                held = 0
                for mask in m.masks(t):
                    total[mask] = total.get(mask, 0) + 1
                    held |= mask
                if held & positive:
                    rows.append(r)
                    marks.append(held)
            key_type = batch.column(0).type
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(rows, pa.int64())), pa.array(marks, pa.int64()), pa.nulls(len(rows), pa.int64())], names=["k", "mask", "n"])
        if total:
            yield pa.RecordBatch.from_arrays([pa.nulls(len(total), key_type), pa.array(list(total), pa.int64()), pa.array(list(total.values()), pa.int64())], names=["k", "mask", "n"])

    return narrow.mapInArrow(run, f"k {kind.simpleString()}, mask bigint, n bigint")


class LabelModel:
    """Log-linear models of the vote patterns in both classes, with terms for voters and for pairs of voters of one sign, and the share of abuse.

    All 2 ** voters patterns are enumerated, so likelihoods and expectations are exact.
    """

    def __init__(self) -> None:
        v = len(VOTERS)
        self.sign = np.array([s for _, s in VOTERS], float)
        self.pairs = [(i, j) for i in range(v) for j in range(i + 1, v) if self.sign[i] == self.sign[j]]
        masks = np.arange(1 << v)
        votes = (masks[:, None] >> np.arange(v) & 1).astype(float)
        self.phi = np.concatenate([votes, *[votes[:, [i]] * votes[:, [j]] for i, j in self.pairs]], axis=1)
        rate = np.where(self.sign[None, :] > 0, [[0.01] * v, [0.4] * v], [[0.05] * v, [0.01] * v])
        rate[0, -1], rate[1, -1] = 0.8, 0.02
        self.share = 0.02
        self.theta = np.concatenate([np.log(rate / (1 - rate)), np.zeros((2, len(self.pairs)))], axis=1)
        self.start = np.concatenate([rate, *[rate[:, [i]] * rate[:, [j]] for i, j in self.pairs]], axis=1)

    def _log(self) -> np.ndarray:
        """Log-probability of every pattern in both classes."""
        z = self.phi @ self.theta.T
        top = z.max(axis=0)
        return (z - top - np.log(np.exp(z - top).sum(axis=0))).T

    @property
    def rate(self) -> np.ndarray:
        """Vote rates of the voters in both classes."""
        return np.exp(self._log()) @ self.phi[:, : len(VOTERS)]

    def posteriors(self) -> np.ndarray:
        """Probability of abuse for every pattern."""
        log = self._log()
        z = log[1] - log[0] + math.log(self.share / (1 - self.share))
        return 1 / (1 + np.exp(-np.clip(z, -60, 60)))

    def odds(self) -> np.ndarray:
        """Log-odds of abuse for every pattern, within +-``SURE``: what a sentence starts from before its words count."""
        p = np.clip(self.posteriors(), 1e-12, 1 - 1e-12)
        return np.clip(np.log(p / (1 - p)), -SURE, SURE)

    def fit(self, counts: dict[int, int]) -> LabelModel:
        """Expectation maximisation over the patterns of the corpus; Newton steps fit voters and pairs together."""
        n = np.zeros(len(self.phi))
        for mask, k in counts.items():
            n[mask] += k
        if not n.any():
            return self
        v = len(VOTERS)
        for _ in range(ROUNDS):
            p = self.posteriors()
            self.share = min(0.5, max(1e-5, ((n * p).sum() + 0.02 * PRIOR) / (n.sum() + PRIOR)))
            goal = np.stack([((n * q) @ self.phi + PRIOR * self.start[y]) / ((n * q).sum() + PRIOR) for y, q in ((0, 1 - p), (1, p))])
            # A vote never speaks against its own sign.
            for j in np.flatnonzero((goal[1, :v] - goal[0, :v]) * self.sign < 0):
                touched = [j, *[v + i for i, pair in enumerate(self.pairs) if j in pair]]
                goal[:, touched] = self.start[:, touched]
            for y in (0, 1):
                self._moments(y, goal[y])
        return self

    def _moments(self, y: int, goal: np.ndarray, steps: int = 15, ridge: float = 1e-3) -> None:
        """Parameters of class y whose expectations are ``goal``, by damped Newton steps on the convex dual; ``ridge`` draws pair terms towards none."""
        v = len(VOTERS)
        pull = np.concatenate([np.full(v, 1e-6), np.full(len(self.pairs), ridge)])
        for _ in range(steps):
            p = np.exp(self._log()[y])
            mean = p @ self.phi
            slope = goal - mean - pull * self.theta[y]
            if np.abs(slope).max() < 1e-7:
                return
            curve = (self.phi * p[:, None]).T @ self.phi - np.outer(mean, mean) + np.diag(pull + 1e-9)
            step = np.linalg.solve(curve, slope)
            self.theta[y] = np.clip(self.theta[y] + step * min(1.0, 2.0 / max(1e-9, np.abs(step).max())), -20, 20)


def rated(docs: np.ndarray, labels: Sequence[Sequence[tuple[str, int]]], weak: np.ndarray, rounds: int = 10) -> np.ndarray:
    """Posterior of each labelled document from what its raters say and, as a prior, from the votes (``weak``); raters' accuracies are estimated."""
    names = sorted({r for held in labels for r, _ in held})
    at = {r: i for i, r in enumerate(names)}
    right = np.full((2, len(names)), 0.9)
    prior = np.clip(weak[docs], 0.02, 0.9)
    q = prior
    rows = np.array([i for i, held in enumerate(labels) for _ in held], np.int64)
    who = np.array([at[r] for held in labels for r, _ in held], np.int64)
    said = np.array([f for held in labels for _, f in held], np.int64)
    for _ in range(rounds):
        ones = np.where(said == 1, np.log(right[1, who] / (1 - right[0, who])), np.log((1 - right[1, who]) / right[0, who]))
        z = np.log(prior / (1 - prior)) + np.bincount(rows, ones, len(labels))
        q = 1 / (1 + np.exp(-z))
        for y, w in ((0, 1 - q), (1, q)):
            agree = np.bincount(who, w[rows] * (said == y), len(names))
            right[y] = np.clip((agree + 9) / (np.bincount(who, w[rows], len(names)) + 10), 0.55, 0.99)
    return q


class Sample:
    """Sentences of the training sample: flat features with their sentence, the sentence's votes and its document."""

    def __init__(self, feature: np.ndarray, size: np.ndarray, mask: np.ndarray, doc: np.ndarray) -> None:
        self.feature, self.size, self.mask, self.doc, self.n = feature.astype(np.int32), size.astype(np.int64), mask.astype(np.int64), doc, len(size)
        self.sentence = np.repeat(np.arange(self.n, dtype=np.int32), self.size)
        self.offset = np.zeros(self.n)

    @cached_property
    def _batches(self) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
        used, flat = np.unique(self.feature, return_inverse=True)
        flat = flat.astype(np.int32)
        scale = 1 / np.sqrt(np.maximum(self.size, SHORT))
        at = np.concatenate([[0], np.cumsum(self.size)])
        order = np.argsort([zlib.crc32(str(i).encode()) for i in range(self.n)])
        width = max(32, min(512, self.n // 40))  # small samples are walked in small steps
        parts = []
        for a in range(0, self.n, width):
            rows = order[a : a + width]
            n = self.size[rows]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            uniq, pos = np.unique(flat[np.repeat(at[rows], n) + inside], return_inverse=True)
            parts.append((rows, uniq, pos.astype(np.int32), np.repeat(np.arange(len(rows), dtype=np.int32), n), scale[rows]))
        return used, parts

    def batches(self) -> tuple[np.ndarray, list[tuple[np.ndarray, ...]]]:
        """The features there are, and batches of sentences in an order by hash: sentences, their features as places among these, and scales."""
        return self._batches

    @staticmethod
    def unpack(rows: Sequence) -> Sample:
        """From rows of :func:`_sampled`."""
        load = lambda name: np.concatenate([np.zeros(0, np.int32), *[np.frombuffer(r[name], np.int32) for r in rows]])
        return Sample(load("features"), load("sizes"), load("masks"), np.repeat(np.arange(len(rows)), [len(r["sizes"]) // 4 for r in rows]))


def pack(text: str | None) -> tuple[bytes, bytes, bytes]:
    """Sizes, features and votes of a text's sentences as bytes; of very many, the sentences with votes first and then those lowest by hash."""
    m = matcher()
    told = [(words, *m.fulfilled(words)) for words in m.parts(text or "")]
    if len(told) > PER_DOC:
        told = sorted(told, key=lambda x: (not x[1], zlib.crc32(repr([e[1] for e in x[0]]).encode())))[:PER_DOC]
    f = Features()
    for words, hits, _ in told:
        f.add(words, hits)
    feature, sentence = f.arrays()
    order = np.argsort(sentence, kind="stable")
    sizes = np.bincount(sentence, minlength=len(told)).astype(np.int32)
    return sizes.tobytes(), feature[order].astype(np.int32).tobytes(), np.array([x[2] for x in told], np.int32).tobytes()


def _sampled(df: DataFrame) -> DataFrame:
    """(k, rated, weight, sizes, features, masks) of sample documents (k, t, rated, weight)."""
    kind = df.schema["k"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            packed = [pack(t) for t in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), batch.column(3), *[pa.array([p[i] for p in packed], pa.binary()) for i in range(3)]], names=["k", "rated", "weight", "sizes", "features", "masks"])

    return df.mapInArrow(run, f"k {kind}, rated array<struct<rater:string,flagged:int>>, weight double, sizes binary, features binary, masks binary")


def train(feats: list[list[int]], labels: np.ndarray, epochs: int = 12) -> np.ndarray:
    """:func:`train_sample` on lists of features, all of one weight."""
    size = np.array([len(f) for f in feats], np.int64)
    flat = np.array([x for f in feats for x in f], np.int64)
    return train_sample(Sample(flat, size, np.zeros(len(feats), np.int64), np.arange(len(feats))), labels, np.ones(len(feats)), epochs=epochs)


def train_sample(sample: Sample, labels: np.ndarray, weight: np.ndarray, start: np.ndarray | None = None, epochs: int = 10, rate: float = 0.5, penalty: float = 1e-6) -> np.ndarray:
    """Logistic regression on soft labels (AdaGrad); the last weight is the bias. A sentence's features share one unit of length, and
    it starts from its votes' log-odds (``sample.offset``)."""
    w = np.zeros(DIMENSIONS + 1) if start is None else start.copy()
    if not sample.n:
        w[-1] = -4.0
        return w
    used, parts = sample.batches()
    v, bias = w[used], w[-1]
    grad2, bias2 = np.full(len(used), 1e-8), 1e-8
    for _ in range(epochs):
        for rows, uniq, pos, which, s in parts:
            z = bias + sample.offset[rows] + np.bincount(which, v[uniq][pos], len(rows)) * s
            g = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - labels[rows]) * weight[rows] / max(1e-9, weight[rows].sum())
            d = np.bincount(pos, (g * s)[which], len(uniq)) + penalty * v[uniq]
            grad2[uniq] += d * d
            v[uniq] -= rate * d / np.sqrt(grad2[uniq])
            b = g.sum()
            bias2 += b * b
            bias -= rate * b / math.sqrt(bias2)
    w[used], w[-1] = v, bias
    return w


def sentence_odds(sample: Sample, w: np.ndarray) -> np.ndarray:
    return w[-1] + sample.offset + np.bincount(sample.sentence, w[sample.feature], sample.n) / np.sqrt(np.maximum(sample.size, SHORT))


def learn(rows: Sequence, model: LabelModel, passes: int = PASSES) -> np.ndarray:
    """The classifier's weights from the sample.

    Labels of sentences are the label model's posteriors at first. Where documents are rated, each pass weighs what their raters say
    against the guess so far and spreads the result over their sentences (none of a sound document is abuse; in an abusive one the likeliest
    ones are); sentences of other documents are labelled half by their votes and half by the classifier, which by then knows what raters think of such sentences.
    """
    sample = Sample.unpack(rows)
    sample.offset = model.odds()[sample.mask]
    weak = np.clip(model.posteriors()[sample.mask], 1e-4, 1 - 1e-4)
    rated_docs = np.array([i for i, r in enumerate(rows) if r["rated"]], np.int64)
    w = train_sample(sample, weak, np.ones(sample.n))
    if not len(rated_docs):
        return w
    said = [[(x["rater"], x["flagged"]) for x in rows[i]["rated"]] for i in rated_docs]
    told = np.zeros(len(rows), bool)
    told[rated_docs] = True
    told, weight = told[sample.doc], np.array([r["weight"] for r in rows], float)[sample.doc]
    guess, other = weak, weak
    for _ in range(passes):
        none = np.ones(len(rows))
        np.multiply.at(none, sample.doc, 1 - guess)
        q = np.zeros(len(rows))
        q[rated_docs] = rated(rated_docs, said, 1 - none)
        labels = np.where(told, np.minimum(1.0, guess * q[sample.doc] / np.maximum(1e-9, 1 - none[sample.doc])), other)
        w = train_sample(sample, labels, np.where(told, weight, UNRATED) * (1 + ABUSIVE * labels), w, epochs=4)
        odds = np.clip(sentence_odds(sample, w), -9, 9)
        guess = 1 / (1 + np.exp(-odds))
        other = 1 / (1 + np.exp(-(odds + np.log(weak / (1 - weak))) / 2))
    return w


def _under(share: float, *key: str) -> Column:
    """Whether a row's hash is among the lowest ``share`` of all."""
    return F.pmod(F.xxhash64(F.lit("sample"), *key), F.lit(1 << 30)) < int(min(1.0, share) * (1 << 30))


def fit(df: DataFrame, labels: DataFrame | None = None, key: str = "doc_id", text: str = "text") -> tuple[np.ndarray, LabelModel]:
    """The classifier's weights and the label model, from the corpus itself and the labels it has (key, rater, flagged, labelled_at)."""
    votes = durable(vote(df, key, text))
    counts = {r["mask"]: r["n"] for r in votes.where(F.col("n").isNotNull()).groupBy("mask").agg(F.sum("n").alias("n")).collect()}  # at most 2 ** voters
    model = LabelModel().fit(counts)
    loud = votes.where(F.col("n").isNull()).select("k").distinct()
    held = None
    if labels is not None:
        per = labels.where(F.col("flagged").isNotNull() & F.col(key).isNotNull()).groupBy(F.col(key).alias("k"), F.coalesce(F.col("rater").cast("string"), F.lit("")).alias("rater"))
        last = per.agg(F.max_by(F.col("flagged").cast("int"), F.struct(F.col("labelled_at"), F.col("flagged"))).alias("flagged"))
        held = last.groupBy("k").agg(F.array_sort(F.collect_list(F.struct("rater", "flagged"))).alias("rated"))
    n_docs, n_loud = df.count(), loud.count()
    share = lambda n: min(1.0, SAMPLE / max(1, n))
    none = F.lit(None).cast("array<struct<rater:string,flagged:int>>").alias("rated")
    picked = loud.where(_under(share(n_loud), "k")).select("k", none, F.lit(1.0).alias("weight"))
    if held is not None:
        # Documents that some rater flagged and the others are sampled apart, and weighed back to their proportion.
        held = held.withColumn("some", F.exists("rated", lambda x: x["flagged"] == 1))
        n = {r["some"]: r["count"] for r in held.groupBy("some").count().collect()}
        yes, no = share(n.get(True, 0)), share(n.get(False, 0))
        picked = picked.unionByName(held.where(F.when(F.col("some"), _under(yes, "k")).otherwise(_under(no, "k"))).select("k", "rated", F.when(F.col("some"), 1.0).otherwise(yes / no).alias("weight")))
    picked = picked.groupBy("k").agg(F.max("rated").alias("rated"), F.max("weight").alias("weight"), F.lit(True).alias("__picked"))
    rows = df.select(F.col(key).alias("k"), F.col(text).cast("string").alias("t"))
    # The picked keys are about three times SAMPLE at most, so they are broadcast; documents of any kind come by the same hash.
    chosen = rows.join(F.broadcast(picked), "k", "left").where(F.col("__picked") | _under(share(n_docs), "k")).where(F.length("t") > 0)
    parts = 2 * df.sparkSession.sparkContext.defaultParallelism
    sample = _sampled(chosen.select("k", "t", "rated", F.coalesce("weight", F.lit(1.0)).alias("weight")).repartition(parts, "k")).collect()
    return learn(sorted(sample, key=lambda r: str(r["k"])), model), model


def score(df: DataFrame, labels: DataFrame | None = None, key: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """(key, source, score) of every document."""
    weights, model = fit(df, labels, key, text)
    shared = df.sparkSession.sparkContext.broadcast((weights.astype(np.float32), model.odds()))  # DIMENSIONS + 1 and 2 ** voters numbers, whatever the corpus

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m, w, odds = matcher(), shared.value[0].astype(np.float64), shared.value[1]
        for batch in batches:
            best = np.full(len(batch), -60.0)
            f, doc, masks = Features(), [], []
            for r, t in enumerate(batch.column(1).to_pylist()):
                if not t:
                    continue
                for words in m.parts(t):
                    hits, mask = m.fulfilled(words)
                    f.add(words, hits)
                    doc.append(r)
                    masks.append(mask)
            if doc:
                feature, sentence = f.arrays()
                size = np.bincount(sentence, minlength=len(doc))
                z = w[-1] + odds[masks] + np.bincount(sentence, w[feature], len(doc)) / np.sqrt(np.maximum(size, SHORT))
                np.maximum.at(best, np.array(doc), z)
            p = np.where(best > -60, 1 / (1 + np.exp(-np.clip(best, -60, 60))), 0.0)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array(p)], names=["k", "s", "score"])

    narrow = _narrow(df, key, text, F.col(source).alias("s"))
    out = narrow.mapInArrow(run, f"k {narrow.schema['k'].dataType.simpleString()}, s string, score double")
    return out.select(F.col("k").alias(key), F.col("s").alias(source), "score")


def rates(scores: DataFrame, source: str = "source", threshold: float = THRESHOLD) -> DataFrame:
    """Documents, documents from the threshold on and their share, per source."""
    return scores.groupBy(source).agg(F.count(F.lit(1)).alias("n_docs"), F.count_if(F.col("score") >= threshold).alias("n_flagged")).withColumn("rate", F.col("n_flagged") / F.col("n_docs"))
