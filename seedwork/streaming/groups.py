"""Streams. The batch engine needs none; these serve inputs that arrive piece by piece."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def release_groups(stream: DataFrame, key: str, member: str, expected: str, at: str, size: str = "1 day", late: str = "1 hour") -> DataFrame:
    """(key, members): each group as soon as its ``expected`` different members have arrived within one window of ``at``.

    For the update output mode: a group comes out in the batch that completes it, and again only if a further member changes it. The
    state is dropped once the watermark passes the window, so it does not grow with the stream. Null members do not count.
    """
    rows = stream.where(F.col(member).isNotNull()).withWatermark(at, late)
    held = rows.groupBy(F.window(at, size).alias("w"), F.col(key).alias("key")).agg(F.array_sort(F.collect_set(member)).alias("members"), F.max(expected).alias("__n"))
    return held.where(F.size("members") >= F.col("__n")).select("key", "members")


def windowed_counts(stream: DataFrame, at: str, by: str, size: str = "1 hour", late: str = "2 hours") -> DataFrame:
    """Rows per window and group; rows later than the watermark are left out by Spark and the state of closed windows is dropped."""
    return stream.withWatermark(at, late).groupBy(F.window(at, size).alias("w"), by).agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").alias("start"), by, "n")


def complete_groups(rows: DataFrame, key: str, member: str, expected: str) -> tuple[DataFrame, DataFrame]:
    """Batch form of :func:`release_groups`: (key, members) of the groups that are complete, and of those that are not."""
    held = rows.where(F.col(member).isNotNull()).groupBy(F.col(key).alias("key")).agg(F.array_sort(F.collect_set(member)).alias("members"), F.max(expected).alias("__n"))
    done = F.size("members") >= F.col("__n")
    return held.where(F.coalesce(done, F.lit(False))).drop("__n"), held.where(~F.coalesce(done, F.lit(False))).drop("__n")


def branch(df: DataFrame, routes: dict[str, Column], other: str | None = None) -> dict[str, DataFrame]:
    """Each row goes to the first route whose condition holds, the rest to ``other`` (or nowhere)."""
    tag = F.lit(other)
    for name, condition in reversed(list(routes.items())):
        tag = F.when(condition, name).otherwise(tag)
    held = df.withColumn("__route", tag)
    return {name: held.where(F.col("__route") == name).drop("__route") for name in [*routes, *([other] if other else [])]}


def multi_map(df: DataFrame, outputs: dict[str, list]) -> dict[str, DataFrame]:
    """Several aligned outputs of one input, each a list of columns."""
    return {name: df.select(*columns) for name, columns in outputs.items()}


def combine_by(left: DataFrame, right: DataFrame, key: list[str]) -> DataFrame:
    """Every left row with every right row of the same key (null keys meet): a join, in which AQE splits hot keys."""
    held = right.select(*[F.col(k).alias(f"__{k}") for k in key], *[c for c in right.columns if c not in key])
    on = [F.col(k).eqNullSafe(F.col(f"__{k}")) for k in key]
    return left.join(held, on).drop(*[f"__{k}" for k in key])


def join_remainder(left: DataFrame, right: DataFrame, key: list[str], defaults: dict[str, object]) -> DataFrame:
    """Full outer join; what is missing on either side takes its default. Keys are never null afterwards unless both were."""
    return left.join(right, key, "full").fillna({k: v for k, v in defaults.items() if v is not None})


def mix(*parts: DataFrame) -> DataFrame:
    """All rows of several tables; columns that one lacks are null."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p, allowMissingColumns=True)
    return whole


def subscribe(stream: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str, once: bool = True):
    """A side effect for every micro-batch of a stream; ``handle`` gets the batch and its number and must bear repetition of the last one."""
    writer = stream.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer).start()
