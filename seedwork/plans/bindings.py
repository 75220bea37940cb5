"""Views of the driver's tables in the engine's own shapes, each with the SQL that gives the same view."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwork.session import table

#: Allele columns of a site number: two alleles share a position.
SITE_SQL = "'chr' || ((site // 2) % 5 + 1) AS chrom, CAST(site // 2 AS BIGINT) AS pos, 'A' AS ref, CASE WHEN site % 2 = 0 THEN 'C' ELSE 'G' END AS alt"


def with_alleles(df: DataFrame) -> DataFrame:
    half = F.expr("site div 2")
    return df.withColumns({"chrom": F.concat(F.lit("chr"), (half % 5 + 1).cast("string")), "pos": half, "ref": F.lit("A"), "alt": F.when(F.col("site") % 2 == 0, "C").otherwise("G")})


def assay(spark: SparkSession, sf: str) -> DataFrame:
    """Pools of lineitem: site, pool, donor (3 is the control), n reads, a of them with the allele."""
    rows = table(spark, sf, "lineitem").select(F.expr("l_partkey div 5").alias("site"), (F.col("l_suppkey") % 12).alias("pool"), "l_discount", "l_orderkey")
    rows = rows.withColumn("donor", F.expr("pool div 3"))
    hit = ((F.col("donor") < 3) & ((F.col("site") + F.col("donor")) % 3 == 0) & (F.col("l_discount") >= 0.075)) | (F.col("l_orderkey") % 211 == 0)
    return rows.groupBy("site", "pool", "donor").agg(F.count(F.lit(1)).alias("n"), F.count_if(hit).alias("a"))


ASSAY_SQL = """assay AS (SELECT l_partkey // 5 AS site, l_suppkey % 12 AS pool, (l_suppkey % 12) // 3 AS donor, count(*) AS n,
  count_if(((l_suppkey % 12) // 3 < 3 AND (l_partkey // 5 + (l_suppkey % 12) // 3) % 3 = 0 AND l_discount >= 0.075) OR l_orderkey % 211 = 0) AS a
  FROM lineitem GROUP BY ALL)"""


def segments(spark: SparkSession, sf: str) -> DataFrame:
    """Ancestry segments of orders: line, start, end (days, inclusive), state 0-2. Thirty-day blocks of equal state are one segment."""
    day = F.date_diff("o_orderdate", F.lit("1995-01-01").cast("date"))
    state = F.when(F.col("o_orderstatus") == "P", 0).when(F.col("o_orderstatus") == "F", 1).otherwise(2)
    blocks = table(spark, sf, "orders").select((F.col("o_custkey") % 40).alias("line"), F.floor(day / 30).cast("long").alias("block"), "o_orderkey", state.alias("state"))
    blocks = blocks.groupBy("line", "block").agg(F.max_by("state", "o_orderkey").alias("state"))
    return _runs(blocks)


def _runs(blocks: DataFrame) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("line").orderBy("block")
    new = F.when((F.lag("state").over(w) == F.col("state")) & (F.lag("block").over(w) == F.col("block") - 1), 0).otherwise(1)
    runs = blocks.withColumn("new", new).withColumn("run", F.sum("new").over(w.rowsBetween(Window.unboundedPreceding, 0)))
    return runs.groupBy("line", "run").agg((F.min("block") * 30).alias("start"), (F.max("block") * 30 + 24).alias("end"), F.first("state").alias("state")).drop("run")


SEGMENTS_SQL = """blocks AS (SELECT o_custkey % 40 AS line, date_diff('day', DATE '1995-01-01', CAST(o_orderdate AS DATE)) // 30 AS block,
  max_by(CASE o_orderstatus WHEN 'P' THEN 0 WHEN 'F' THEN 1 ELSE 2 END, o_orderkey) AS state FROM orders GROUP BY ALL),
runs AS (SELECT *, sum(CASE WHEN ls = state AND lb = block - 1 THEN 0 ELSE 1 END) OVER (PARTITION BY line ORDER BY block) AS run
  FROM (SELECT *, lag(state) OVER (PARTITION BY line ORDER BY block) AS ls, lag(block) OVER (PARTITION BY line ORDER BY block) AS lb FROM blocks)),
segments AS (SELECT line, min(block) * 30 AS start, max(block) * 30 + 24 AS "end", CAST(min(state) AS INT) AS state FROM runs GROUP BY line, run)"""


def panel(spark: SparkSession, sf: str) -> DataFrame:
    """Panel counts of events: sample, donor, role, site (contig, pos), reads and ALT reads."""
    e = table(spark, sf, "events").select(F.col("user_id").alias("sample"), F.dayofmonth("ts").cast("long").alias("pos"), F.col("event_type").alias("contig"), "value")
    got = e.groupBy("sample", "contig", "pos").agg(F.count(F.lit(1)).alias("reads"), F.count_if(F.col("value") > 60).alias("alt"))
    return got.withColumn("donor", F.col("sample") % 8).withColumn("role", F.when(F.col("sample") % 8 == 7, "control").when(F.col("sample") % 2 == 0, "line").otherwise("bc1_sample"))


PANEL_SQL = """panel AS (SELECT user_id AS sample, event_type AS contig, CAST(day(ts) AS BIGINT) AS pos, count(*) AS reads, count_if(value > 60) AS alt, user_id % 8 AS donor,
  CASE WHEN user_id % 8 = 7 THEN 'control' WHEN user_id % 2 = 0 THEN 'line' ELSE 'bc1_sample' END AS role FROM events GROUP BY ALL)"""
