"""Sinks: stores by kind and unit, exports, manifests. A result is written beside and moved, and never over an existing one."""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedwork.operators.labels import GuardError, settings_guard


def _fs(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def publish(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Write beside the place and move there in one step; refuse if something is there."""
    spark = df.sparkSession
    if exists(spark, path):
        raise GuardError(f"{path} is there already")
    staged = f"{path.rstrip('/')}.staged"
    df.write.mode("overwrite").partitionBy(*partition_by).parquet(staged)
    fs, p = _fs(spark, path)
    if not fs.rename(spark._jvm.org.apache.hadoop.fs.Path(staged), p):
        raise GuardError(f"{path} could not be put in place")


def stored_or(spark: SparkSession, path: str, make) -> DataFrame:
    """The stored result if there is one, else it is made, published and read back."""
    if not exists(spark, path):
        publish(make(), path)
    return spark.read.parquet(path)


def as_text(df: DataFrame, null: str = "NA", empty: str = ".") -> DataFrame:
    """Text rules of exports: null as ``NA``, empty lists as ``.``, lists joined by commas, booleans in lower case."""
    out = []
    for f in df.schema:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.ArrayType):
            c = F.when(F.size(c) == 0, empty).otherwise(F.array_join(F.transform(c, lambda x: x.cast("string")), ","))
        out.append(F.coalesce(c.cast("string"), F.lit(null)).alias(f.name))
    return df.select(*out)


def export_tsv(df: DataFrame, path: str, order: Sequence[str], header: bool = True, gzip: bool = False) -> None:
    """One ordered tab-separated file for people; the order is made on the typed columns. Bytes depend on the rows alone (gzip headers hold no time)."""
    text = as_text(df.orderBy(*order)).coalesce(1)
    text.write.mode("errorifexists").option("header", header).option("sep", "\t").option("quote", "").option("compression", "gzip" if gzip else "none").csv(path)


def site_list(union: DataFrame) -> DataFrame:
    """Headerless list of bi-allelic union sites."""
    return union.where(~F.col("multiallelic")).select("chrom", "pos", "ref", "alt")


def manifest(spark: SparkSession, unit: str, settings: dict[str, object]) -> DataFrame:
    """(unit, name, value) of every option, values in one written form, so that 2, "2" and 2.0 compare equal."""

    def form(v: object) -> str:
        try:
            return repr(float(v)).removesuffix(".0")  # type: ignore[arg-type]
        except (TypeError, ValueError):
            return v if isinstance(v, str) else json.dumps(v, sort_keys=True)

    return spark.createDataFrame([(unit, k, form(v)) for k, v in sorted(settings.items())], "unit string, name string, value string")


def extend_store(spark: SparkSession, path: str, current: DataFrame) -> bool:
    """Settings guard of a store: the first run writes the manifest, equal settings add new units, other settings are refused."""
    if not exists(spark, path):
        current.write.parquet(path)
        return True
    stored = spark.read.parquet(path)
    settings_guard(stored.select("name", "value").distinct(), current.select("name", "value").distinct())
    new = current.join(stored.select("unit").distinct(), "unit", "left_anti")
    if new.isEmpty():
        return False
    new.write.mode("append").parquet(path)
    return True


def register_all(rows: DataFrame, expected: DataFrame, present: DataFrame, path: str) -> None:
    """Append registry rows only if every expected artefact is there."""
    missing = expected.join(present, expected.columns, "left_anti").limit(5).collect()
    if missing:
        raise GuardError(f"artefacts are missing: {[tuple(r) for r in missing]}")
    rows.write.mode("append").parquet(path)


def same_rows(a: DataFrame, b: DataFrame) -> DataFrame:
    """Check mode: rows of either side that the other lacks, multiplicity counted, with the side."""
    return a.exceptAll(b).withColumn("side", F.lit("made")).unionByName(b.exceptAll(a).withColumn("side", F.lit("stored")))


def write_provenance(spark: SparkSession, path: str, record: dict[str, object]) -> None:
    """One JSON document with sorted keys, created exclusively: an existing one is never replaced."""
    fs, p = _fs(spark, path)
    body = json.dumps(record, sort_keys=True, indent=1) + "\n"
    try:
        stream = fs.create(p, False)
    except Exception as e:  # Hadoop's FileAlreadyExistsException comes as a Py4J error
        if fs.exists(p):
            raise GuardError(f"{path} is there already") from e
        raise
    stream.write(bytearray(body.encode()))
    stream.close()


def swap(tables: dict[str, DataFrame]) -> None:
    """Several tables replaced together: all are written beside their places first, then moved; if one cannot be written, none is touched.

    The moves are renames; what was there is kept as ``.before`` until all are done, and put back if a move fails.
    """
    if not tables:
        return
    for path, df in tables.items():
        df.write.mode("overwrite").parquet(f"{path.rstrip('/')}.staged")
    spark = next(iter(tables.values())).sparkSession
    path_of = spark._jvm.org.apache.hadoop.fs.Path
    done: list[str] = []
    try:
        for path in tables:
            at = path.rstrip("/")
            fs, p = _fs(spark, at)
            before = path_of(f"{at}.before")
            fs.delete(before, True)
            if fs.exists(p) and not fs.rename(p, before):
                raise GuardError(f"{path} could not be put aside")
            done.append(at)
            if not fs.rename(path_of(f"{at}.staged"), p):
                raise GuardError(f"{path} could not be put in place")
    except Exception:
        for at in done:
            fs, p = _fs(spark, at)
            before = path_of(f"{at}.before")
            if fs.exists(before):
                fs.delete(p, True)
                fs.rename(before, p)
        raise
    for at in done:
        fs, _ = _fs(spark, at)
        fs.delete(path_of(f"{at}.before"), True)


def checkpoint_step(df: DataFrame, folder: str, step: str) -> DataFrame:
    """The result of a step, kept once under ``<folder>/<step>`` and read from there from then on; a half-written one does not count."""
    return stored_or(df.sparkSession, f"{folder.rstrip('/')}/{step}", lambda: df)


def run_info(spark: SparkSession, unit: str, options: object, **more: object) -> DataFrame:
    """The manifest of a run: every field of its options (a dataclass) and whatever else is given."""
    from dataclasses import asdict

    return manifest(spark, unit, {**asdict(options), **more})


def collect_file(parts: Sequence[DataFrame], path: str, order: Sequence[str]) -> None:
    """Tables of one shape in one ordered text file."""
    whole = parts[0]
    for p in parts[1:]:
        whole = whole.unionByName(p)
    export_tsv(whole, path, order)


def pairs_text(pairs: str) -> object:
    """Counts of pools (array of pool, a, n) as ``pool:a/n;...``, a dot where there are none."""
    one = F.transform(pairs, lambda x: F.concat_ws("", x["pool"].cast("string"), F.lit(":"), x["a"].cast("string"), F.lit("/"), x["n"].cast("string")))
    return F.when(F.size(pairs) > 0, F.array_join(one, ";")).otherwise(".")


def contig_order(df: DataFrame, contig: str, at: str) -> DataFrame:
    """Adds ``contig_rank``: contigs in the order in which they first appear by ``at``, of one place by name. One row a contig is joined back."""
    from pyspark.sql import Window

    first = df.groupBy(contig).agg(F.min(at).alias("__first"))
    ranked = first.withColumn("contig_rank", F.row_number().over(Window.partitionBy(F.lit(0)).orderBy("__first", contig))).drop("__first")  # contigs are few
    on = df[contig].eqNullSafe(ranked[contig])
    return df.join(ranked, on, "left").drop(ranked[contig])


def formatted(df: DataFrame, rules: dict[str, str], null: str = "NA") -> DataFrame:
    """Columns as text by rules such as ``%.6f``; others as :func:`as_text` writes them."""
    cols = [F.coalesce(F.when(F.col(c).isNotNull(), F.format_string(rules[c], F.col(c))), F.lit(null)).alias(c) if c in rules else F.col(c) for c in df.columns]
    return as_text(df.select(*cols), null)
