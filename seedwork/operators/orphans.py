"""References to records that do not exist (yet, or any more).

Method: a Bloom filter of the parent keys, handed to every task, proves most orphans outright; only references that the filter
lets pass are verified by an exact join; then everything is aggregated per table and period.

The filter is built by Spark itself: ``k`` bit positions a key, OR-ed per 64-bit word, and placed into the probing plan as one
scalar (a scalar subquery). Its size is computed from the number of parent keys and bounded by ``max_bits`` (8 MB by
default); beyond the bound it only lets more references pass, and those are joined exactly, so results never depend on it.

Time: a reference made at time t is sound if a parent row is valid at t (from <= t, and no end or end > t). The valid spans of
each parent key are merged into disjoint ones first, so that many rows of one parent key cannot multiply with many
references to it.

Defined results
    * null references and those in ``nothing`` (empty and ``NA`` by default) refer to nothing and are left out; blanks around keys do not count, case does
    * ``missing``: no parent row of that key; ``late``: all its rows begin after t; ``deleted``: every other reference that is not sound
    * a parent row whose begin is null is valid at no time, and makes the key known (so not ``late``)
    * a null t: never sound; ``late`` needs a known t, so it is ``deleted`` where the key is known
    * repeated references are judged row by row; use ``distinct`` rows where each is to count once
    * an empty parent table makes every reference ``missing``
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def _positions(key: Column, bits: int, hashes: int) -> list[Column]:
    return [F.pmod(F.xxhash64(F.lit(i), key), F.lit(bits)) for i in range(hashes)]


def bloom_words(keys: DataFrame, key: str, bits: int, hashes: int) -> DataFrame:
    """One row, one column ``words``: the filter as an array of 64-bit words. Null keys are left out; no keys give all zeros."""
    places = keys.where(F.col(key).isNotNull()).select(F.explode(F.array(*_positions(F.col(key), bits, hashes))).alias("p"))
    word = places.groupBy((F.floor(F.col("p") / 64)).cast("int").alias("w")).agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("p", F.lit(64)).cast("int"))).alias("b"))
    every = keys.sparkSession.range(bits // 64).select(F.col("id").cast("int").alias("w")).join(word, "w", "left")
    filled = every.agg(F.array_sort(F.collect_list(F.struct("w", F.coalesce("b", F.lit(0).cast("long")).alias("b")))).alias("a"))  # bits / 64 entries
    return filled.select(F.transform("a", lambda x: x["b"]).alias("words"))


def bloom_size(n: int, rate: float = 0.01, max_bits: int = 1 << 26) -> tuple[int, int]:
    """Bits (a multiple of 64, at most max_bits) and hash functions for n keys at the false-positive rate."""
    bits = max(64, min(max_bits, math.ceil(-max(n, 1) * math.log(rate) / math.log(2) ** 2)))
    bits = -(-bits // 64) * 64
    return bits, max(1, min(10, round(bits / max(n, 1) * math.log(2))))


def may_contain(words: Column, key: Column, bits: int, hashes: int) -> Column:
    """False only if the key is certainly not in the filter."""
    ok = F.lit(True)
    for p in _positions(key, bits, hashes):
        ok = ok & (F.call_function("shiftrightunsigned", F.get(words, F.floor(p / 64).cast("int")), F.pmod(p, F.lit(64)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1)
    return ok


def spans(parents: DataFrame, key: str, begin: str, end: str) -> DataFrame:
    """Per key: ``first`` (least begin), ``no_begin`` (some begin is null) and ``spans``, its disjoint valid spans in order.

    Spans that touch or overlap are merged by a running maximum of the ends, an open end being the largest.
    """
    far = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    rows = parents.select(F.col(key).alias("__key"), F.col(begin).cast("timestamp_ntz").alias("__b"), F.coalesce(F.col(end).cast("timestamp_ntz"), far).alias("__e")).distinct()
    order = Window.partitionBy("__key").orderBy("__b", "__e")
    before = F.max("__e").over(order.rowsBetween(Window.unboundedPreceding, -1))
    real = rows.where(F.col("__e") > F.col("__b"))  # without a begin there is no span
    heads = real.withColumn("__new", F.when(before.isNull() | (F.col("__b") > before), 1).otherwise(0)).withColumn("__run", F.sum("__new").over(order.rowsBetween(Window.unboundedPreceding, 0)))
    merged = heads.groupBy("__key", "__run").agg(F.min("__b").alias("b"), F.max("__e").alias("e")).groupBy("__key").agg(F.array_sort(F.collect_list(F.struct("b", "e"))).alias("__spans"))
    known = rows.groupBy("__key").agg(F.min("__b").alias("__first"), F.bool_or(F.col("__b").isNull()).alias("__no_begin"))
    return known.join(merged, "__key", "left")


def find_orphans(refs: DataFrame, parents: DataFrame, *, ref: str, at: str, key: str, begin: str, end: str, rate: float = 0.01, max_bits: int = 1 << 26, broadcast_rows: int = 200_000, nothing: tuple[str, ...] = ("", "NA")) -> DataFrame:
    """The rows of ``refs`` whose reference is not sound, with the column ``kind`` added.

    ``ref`` and ``key`` are trimmed of blanks here. The exact join broadcasts the parents' spans only if there are at most
    ``broadcast_rows`` parent rows (counted, not guessed, and spans are no more); otherwise it is a shuffled join in which AQE splits hot keys.
    """
    parents = parents.select(F.trim(F.col(key)).alias("__pk"), F.col(begin).alias("__pb"), F.col(end).alias("__pe")).where(F.col("__pk").isNotNull())
    size = parents.agg(F.count_distinct("__pk").alias("keys"), F.count(F.lit(1)).alias("rows")).first()
    bits, hashes = bloom_size(size["keys"], rate, max_bits)
    words = bloom_words(parents.select("__pk").distinct(), "__pk", bits, hashes).scalar()
    dim = spans(parents, "__pk", "__pb", "__pe")

    live = refs.withColumn("__ref", F.trim(F.col(ref))).where(F.col("__ref").isNotNull() & ~F.col("__ref").isin(*nothing))
    live = live.withColumn("__asked", F.when(may_contain(words, F.col("__ref"), bits, hashes), F.col("__ref")))
    if size["rows"] <= broadcast_rows:
        # References that the filter rules out ask for nothing and meet nothing: one pass over the references, no shuffle.
        held = live.join(F.broadcast(dim), F.col("__asked") == F.col("__key"), "left")
    else:
        # They stay out of the shuffled join, where they would all meet in one task.
        held = live.where(F.col("__asked").isNotNull()).join(dim, F.col("__asked") == F.col("__key"), "left")
        proven = live.where(F.col("__asked").isNull()).select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in dim.schema])
        held = held.unionByName(proven)
    t = F.col(at).cast("timestamp_ntz")
    sound = F.exists(F.coalesce("__spans", F.array().cast(dim.schema["__spans"].dataType)), lambda s: (s["b"] <= t) & (s["e"] > t))
    late = ~F.col("__no_begin") & (F.col("__first") > t)
    kind = F.when(F.col("__key").isNull(), "missing").when(F.coalesce(sound, F.lit(False)), None).when(F.coalesce(late, F.lit(False)), "late").otherwise("deleted")
    return held.withColumn("kind", kind).where(F.col("kind").isNotNull()).drop("__key", "__first", "__no_begin", "__spans", "__ref", "__asked")


def orphans_by_period(orphans: DataFrame, table: str, at: str) -> DataFrame:
    """Orphans counted per table, month of ``at`` (``YYYY-MM``) and kind."""
    return orphans.groupBy(F.col(table).alias("src_table"), F.date_format(F.col(at), "yyyy-MM").alias("month"), "kind").agg(F.count(F.lit(1)).alias("n"))
