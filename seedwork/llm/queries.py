"""Queries over the project's tables for training data, and their SQL twins where SQL can express them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwork.llm.abuse import THRESHOLD, rates, score
from seedwork.llm.bpe import count_tokens, encode
from seedwork.llm.digest import digests, percentiles
from seedwork.llm.mixing import Tilt, mix, shares
from seedwork.llm.tracks import cut_tracks, marker_bins, split_tracks
from seedwork.session import durable, table

_METRICS = ("ref_count", "alt_count")


def _loads(spark: SparkSession, sf: str) -> tuple[DataFrame, DataFrame]:
    """The observations and their digests by sample, run and day of loading, written once."""
    obs = table(spark, sf, "ancestry_obs").select("sample", "run_id", F.to_date("loaded_at").alias("day"), *_METRICS)
    return obs, durable(digests(obs, ("sample", "run_id", "day"), _METRICS))


def p2_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """Certified percentiles of both counts for every sample, from digests by sample, run and day."""
    obs, parts = _loads(spark, sf)
    return percentiles(obs, parts, ("sample",), _METRICS)


def p2_days(spark: SparkSession, sf: str) -> DataFrame:
    """Certified percentiles for every day of loading, from the same digests put together by day."""
    obs, parts = _loads(spark, sf)
    return percentiles(obs, parts, ("day",), _METRICS)


def p2_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Certified percentiles for every run, from the same digests put together by run."""
    obs, parts = _loads(spark, sf)
    return percentiles(obs, parts, ("run_id",), _METRICS)


def p2_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """By sample, run and day: values, quantiles answered, and how many of them are certified to be within the bound."""
    obs, parts = _loads(spark, sf)
    out = None
    for group in ("sample", "run_id", "day"):
        got = percentiles(obs, parts, (group,), _METRICS).groupBy(group, "metric", "n").agg(F.count(F.lit(1)).cast("int").alias("quantiles"), F.count_if(F.col("rank_error") <= F.col("error_bound")).cast("int").alias("within"))
        got = got.select(F.lit(group).alias("grouping"), F.col(group).cast("string").alias("key"), "metric", "n", "quantiles", "within")
        out = got if out is None else out.unionByName(got)
    return out


def p3_pieces(spark: SparkSession, sf: str) -> DataFrame:
    """Every piece of every oversized track, positions left out."""
    return split_tracks(table(spark, sf, "ancestry_obs")).drop("positions")


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    """Tracks that had to be cut: those with a first piece. Positions are not looked up."""
    return cut_tracks(marker_bins(table(spark, sf, "ancestry_obs"))).where(F.col("piece") == 0).select("run_id", "sample", "contig")


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return encode(table(spark, sf, "documents"))


def _mixed(spark: SparkSession, sf: str) -> tuple[DataFrame, list[Tilt]]:
    tokens = durable(count_tokens(table(spark, sf, "documents"), carry=("source",)))
    return mix(tokens, table(spark, sf, "source_targets"))


def p8_mix(spark: SparkSession, sf: str) -> DataFrame:
    """Rate and copies of every document."""
    return _mixed(spark, sf)[0]


def p8_shares(spark: SparkSession, sf: str) -> DataFrame:
    """Target and actual shares per source."""
    return shares(*_mixed(spark, sf))


def p8_bounds(spark: SparkSession, sf: str) -> DataFrame:
    """Per source: documents, shares wanted, and whether what came out is within its largest document of the tokens aimed at, and within the cap."""
    mixed, tilts = _mixed(spark, sf)
    goals = spark.createDataFrame([(t.source, t.goal, t.cap) for t in tilts], "source string, goal double, cap int")
    largest = mixed.groupBy("source").agg(F.max("n_tokens").alias("largest"))
    got = shares(mixed, tilts).join(goals, "source", "left").join(largest, "source", "left")
    near = F.abs(F.col("tokens") - F.coalesce("goal", F.lit(0.0))) <= F.coalesce("largest", F.lit(0))
    capped = F.col("most_copies") <= F.coalesce("cap", F.lit(0))
    return got.select("source", F.round("target_share", 9).alias("target_share"), F.round("aimed_share", 9).alias("aimed_share"), "n_docs", F.when(F.col("source").isNull(), 1).otherwise(near.cast("int")).alias("share_held"), capped.cast("int").alias("cap_held"))


def p9_scores(spark: SparkSession, sf: str) -> DataFrame:
    """Scores from votes on the texts and from what raters said of some of them."""
    return score(table(spark, sf, "documents"), table(spark, sf, "labels"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return p9_scores(spark, sf).where(F.col("score") >= THRESHOLD).select("doc_id").distinct()


def p9_rates(spark: SparkSession, sf: str) -> DataFrame:
    return rates(p9_scores(spark, sf))


QUERIES = {f.__name__: f for f in (p2_percentiles, p2_days, p2_runs, p2_bounds, p3_found, p3_pieces, p7_ids, p8_mix, p8_shares, p8_bounds, p9_found, p9_scores, p9_rates)}



def _p2_sql(group: str) -> str:
    """Exact percentiles. Digests keep equal values together, so on counts of one sample their certified error is 0 and the values are these."""
    values = " UNION ALL ".join(f"SELECT {group}, '{m}' AS metric, CAST({m} AS DOUBLE) AS v FROM ancestry_obs WHERE {m} >= 0" for m in _METRICS)
    return f"""WITH v AS ({values}), s AS (SELECT {group}, metric, list_sort(list(v)) AS a, count(*) AS n FROM v GROUP BY {group}, metric), q AS (SELECT unnest([0.05, 0.25, 0.5, 0.75, 0.95]::DOUBLE[]) AS q)
 SELECT {group}, metric, n, q, a[CAST(greatest(1, ceil(n * q - 1e-9)) AS BIGINT)] AS estimate, CAST(0 AS DOUBLE) AS rank_error, CAST(0.01 AS DOUBLE) AS error_bound FROM s CROSS JOIN q"""


ORACLES = {
    "p2_percentiles": _p2_sql("sample"),
    "p2_bounds": "WITH r AS (SELECT *, CAST(loaded_at AS DATE) AS day FROM ancestry_obs), "
    + "c AS ("
    + " UNION ALL ".join(f"SELECT '{g}' AS grouping, CAST({g} AS VARCHAR) AS key, '{m}' AS metric, count(*) AS n FROM r WHERE {m} >= 0 GROUP BY {g}" for g in ("sample", "run_id", "day") for m in _METRICS)
    + ") SELECT grouping, key, metric, n, 5 AS quantiles, 5 AS within FROM c",
    "p8_bounds": """WITH t AS (SELECT source, greatest(coalesce(max(target_share), 0), 0) AS share, coalesce(min(max_repeats), 1) AS cap FROM source_targets WHERE source IS NOT NULL GROUP BY source),
 d AS (SELECT source, count(*) AS n_docs, count_if(text <> '') AS live FROM documents GROUP BY source),
 a AS (SELECT t.source, share, CASE WHEN share > 0 AND cap > 0 AND coalesce(live, 0) > 0 THEN share / sum(CASE WHEN share > 0 AND cap > 0 AND coalesce(live, 0) > 0 THEN share END) OVER () ELSE 0 END AS aim FROM t LEFT JOIN d ON t.source = d.source)
 SELECT coalesce(a.source, d.source) AS source, round(share, 9) AS target_share, round(aim, 9) AS aimed_share, coalesce(n_docs, 0) AS n_docs, 1 AS share_held, 1 AS cap_held FROM a FULL JOIN d ON a.source = d.source""",
    "p3_found": "SELECT run_id, sample, regexp_replace(contig, '^chr', '', 'i') AS contig FROM ancestry_obs WHERE position IS NOT NULL GROUP BY ALL HAVING count(DISTINCT position) > 500",
}
