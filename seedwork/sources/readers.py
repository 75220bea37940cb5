"""Text sources as long, typed tables. Schemas are explicit everywhere; types are never inferred.

Readers of tables with a header line work on lines with their file and order, so a header is found per file however many files there
are, and files are split as usual. Missing or empty inputs give an empty table of the same schema.
"""

from __future__ import annotations

import re
import zipfile
from collections.abc import Sequence
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from seedwork.operators.labels import GuardError, enforce

NA = ("NA", ".", "")


def _filled(spark: SparkSession, path: str) -> bool:
    """Whether something with content is at a path of any file system."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getContentSummary(p).getLength() > 0


def lines(spark: SparkSession, path: str | Sequence[str]) -> DataFrame:
    """(file, at, line): ``at`` grows along each file (split start, then place in the split)."""
    raw = spark.read.text(path)
    return raw.select(F.col("_metadata.file_path").alias("file"), F.struct(F.col("_metadata.file_block_start").alias("split"), F.monotonically_increasing_id().alias("n")).alias("at"), F.col("value").alias("line"))


def sheet(spark: SparkSession, path: str, schema: T.StructType, unique: Sequence[str] = (), required: dict[str, Column] | None = None, patterns: dict[str, str] | None = None, domains: dict[str, Sequence[str]] | None = None, files: Sequence[str] = ()) -> DataFrame:
    """A CSV sheet under a schema. Ragged or mistyped rows fail; ``unique`` columns are keys; ``required`` conditions hold for every row; ``patterns``
    and ``domains`` hold for every value that is not null; the paths in ``files`` columns exist (each different path is looked up once, on the executors' file systems)."""
    df = spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").option("enforceSchema", False).option("quote", '"').option("escape", '"').csv(path)
    if unique:
        enforce(df.groupBy(*unique).count().where(F.col("count") > 1), f"repeated {', '.join(unique)}")
    for what, condition in (required or {}).items():
        enforce(df.where(~F.coalesce(condition, F.lit(False))), what)
    for name, pattern in (patterns or {}).items():
        enforce(df.where(~F.col(name).rlike(rf"\A(?:{pattern})\z")).select(name), f"{name} does not follow {pattern}")
    for name, allowed in (domains or {}).items():
        enforce(df.where(~F.col(name).isin(*allowed)).select(name), f"{name} is none of {', '.join(allowed)}")
    for name in files:
        named = df.where(F.col(name).isNotNull()).select(name).distinct()
        missing = [r[0] for r in named.toLocalIterator() if not _filled(spark, r[0])]
        if missing:
            raise GuardError(f"{name}: no file at {missing[:5]}")
    return df


def text_csv(spark: SparkSession, path: str, sep: str = ",") -> DataFrame:
    """All columns as the text they are, quotes undone, ragged lines refused."""
    with_header = spark.read.option("header", True).option("sep", sep).csv(path).limit(0)
    schema = T.StructType([T.StructField(c, T.StringType()) for c in with_header.columns])
    return spark.read.schema(schema).option("header", True).option("sep", sep).option("mode", "FAILFAST").option("quote", '"').option("escape", '"').csv(path)


def tsv(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """A headered tab-separated table by column names; absent columns are null, a missing or empty file is an empty table."""
    if not _filled(spark, path):
        return spark.createDataFrame([], schema)
    raw = text_csv(spark, path, "\t")
    got = [F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) if f.name in raw.columns else F.lit(None).cast(f.dataType).alias(f.name) for f in schema]
    return raw.select(*got)


def _clean_name(token: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.trim(token), r"\A#?\s*(\[[0-9]+\])?", ""), r":AD\z", "")


def _with_header(rows: DataFrame, is_header: Column) -> DataFrame:
    """Body lines with the fields of their file's header line."""
    head = rows.where(is_header).groupBy("file").agg(F.min_by("line", "at").alias("h")).select("file", F.split("h", "\t").alias("header"))
    return rows.where(~is_header).join(head, "file")


def allele_counts(rows: DataFrame, duplicates: str = "last", single_base_ref: bool = False, empty_as_zero: bool = True) -> DataFrame:
    """Wide allele-depth tables as (sample, chrom, pos, ref, alts, ad). ``rows`` as :func:`lines` gives them.

    What a reader of markers leaves out is told by :func:`marker_counts`.

    The header may be written with ``#``, ``[n]`` and ``:AD``. ``duplicates``: of rows at one (chrom, pos) of a sample the ``first`` or ``last``
    wins; ``first_table``: a sample's column counts only in its first file. Cells ``.`` and empty are [0], or [] if not ``empty_as_zero``.
    Lines whose number of fields differs from the header's raise when they are read.
    """
    header = F.col("line").rlike(r"\A#|\A\s*(\[1\])?CHROM\t")
    body = _with_header(rows.where(F.trim("line") != ""), header).withColumn("f", F.split("line", "\t"))
    body = body.withColumn("f", F.when(F.size("f") == F.size("header"), F.col("f")).otherwise(F.raise_error(F.concat(F.lit("ragged allele-count line: "), F.substring("line", 1, 80)))))
    names = F.transform(F.slice("header", 5, 1 << 20), _clean_name)
    base = body.select("file", "at", F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("pos"), F.col("f")[2].alias("ref"), F.split(F.col("f")[3], ",").alias("alts"), F.arrays_zip(names.alias("sample"), F.slice("f", 5, 1 << 20).alias("cell")).alias("z"))
    if single_base_ref:
        base = base.where(F.length("ref") == 1)
    long = base.select("file", "at", "chrom", "pos", "ref", "alts", F.inline("z"))
    none = F.array(F.lit(0)) if empty_as_zero else F.array().cast("array<int>")
    long = long.withColumn("ad", F.when(F.col("cell").isin(".", ""), none).otherwise(F.transform(F.split("cell", ","), lambda x: F.coalesce(x.try_cast("int"), F.lit(0)))))
    if duplicates == "first_table":
        first = long.groupBy("sample").agg(F.min("file").alias("__f"))
        long = long.join(first, "sample").where(F.col("file") == F.col("__f"))
    order = F.struct("file", "at")
    pick = F.max_by if duplicates == "last" else F.min_by
    got = long.groupBy("sample", "chrom", "pos").agg(pick(F.struct("ref", "alts", "ad"), order).alias("r"))
    return got.select("sample", "chrom", "pos", "r.ref", "r.alts", "r.ad")


def panel_counts(long: DataFrame, panel: DataFrame) -> DataFrame:
    """Counts at panel sites: REF compared without case, mismatching rows dropped, cells without depth dropped; a panel site without ALT takes all other alleles."""
    p = panel.select("chrom", "pos", F.col("ref").alias("p_ref"), F.col("alt").alias("p_alt"))
    met = long.join(p, ["chrom", "pos"]).where(F.upper("ref") == F.upper("p_ref"))
    place = F.array_position(F.transform("alts", F.upper), F.upper("p_alt"))
    rest = F.aggregate(F.slice("ad", 2, 1 << 20), F.lit(0), lambda s, x: s + x)
    alt = F.when(F.col("p_alt").isNull() | F.col("p_alt").isin(*NA), rest).otherwise(F.when(place > 0, F.coalesce(F.get("ad", place.cast("int")), F.lit(0))).otherwise(0))
    ref = F.coalesce(F.get("ad", F.lit(0)), F.lit(0))
    return met.select("sample", "chrom", "pos", ref.alias("ref_n"), alt.alias("alt_n")).where(F.col("ref_n") + F.col("alt_n") > 0)


def marker_counts(long: DataFrame, markers: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Counts at markers (chrom, pos, ref, alt) as (sample, chrom, pos, ref_n, alt_n), and (reason, n) of count rows left out.

    ``long`` holds every row of the count tables (``at`` orders repeats). Reasons in order: not_marker, indel (a REF of several bases),
    ref_mismatch, repeat (a later row of the same sample and position). A marker without any ALT column counts no ALT.
    """
    m = markers.select("chrom", "pos", F.col("ref").alias("m_ref"), F.col("alt").alias("m_alt")).dropDuplicates(["chrom", "pos"])
    met = long.join(m, ["chrom", "pos"], "left")
    why = F.when(F.col("m_ref").isNull(), "not_marker").when(F.length("ref") > 1, "indel").when(F.upper("ref") != F.upper("m_ref"), "ref_mismatch")
    told = met.withColumn("why", why)
    place = F.array_position(F.transform("alts", F.upper), F.upper("m_alt"))
    alt = F.when(place > 0, F.coalesce(F.get("ad", place.cast("int")), F.lit(0))).otherwise(0)
    good = told.where(F.col("why").isNull()).groupBy("sample", "chrom", "pos").agg(F.min_by(F.struct(F.coalesce(F.get("ad", F.lit(0)), F.lit(0)).alias("ref_n"), alt.alias("alt_n")), "at").alias("r"), F.count(F.lit(1)).alias("k"))
    left = told.where(F.col("why").isNotNull()).groupBy(F.col("why").alias("reason")).agg(F.count(F.lit(1)).alias("n"))
    again = good.agg(F.sum(F.col("k") - 1).alias("n")).where(F.col("n") > 0).select(F.lit("repeat").alias("reason"), "n")
    return good.select("sample", "chrom", "pos", "r.ref_n", "r.alt_n"), left.unionByName(again)


def allele_rows(rows: DataFrame) -> DataFrame:
    """Every cell of wide allele-depth tables with its place ``at``: (at, sample, chrom, pos, ref, alts, ad); nothing is deduplicated."""
    header = F.col("line").rlike(r"\A#|\A\s*(\[1\])?CHROM\t")
    body = _with_header(rows.where(F.trim("line") != ""), header).withColumn("f", F.split("line", "\t"))
    names = F.transform(F.slice("header", 5, 1 << 20), _clean_name)
    base = body.select(F.struct("file", "at").alias("at"), F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("pos"), F.col("f")[2].alias("ref"), F.split(F.col("f")[3], ",").alias("alts"), F.inline(F.arrays_zip(names.alias("sample"), F.slice("f", 5, 1 << 20).alias("cell"))))
    return base.select("at", "sample", "chrom", "pos", "ref", "alts", F.transform(F.split("cell", ","), lambda x: F.coalesce(x.try_cast("int"), F.lit(0))).alias("ad"))


def step4_table(rows: DataFrame, region: tuple[str, int, int | None] | None = None) -> DataFrame:
    """Scored sites of step-4 text as (file, chrom, pos, ref, alt, tier), single bases within a region (chrom, first, last) only; columns are found by the header."""
    is_header = F.col("line").rlike(r"(\A|\t)tier(\t|\z)") & F.col("line").rlike(r"(\A|\t)chrom(\t|\z)")
    body = _with_header(rows.where(F.trim("line") != ""), is_header).withColumn("f", F.split("line", "\t"))
    col = lambda name: F.get("f", (F.array_position("header", name) - 1).cast("int"))
    got = body.select("file", col("chrom").alias("chrom"), col("pos").try_cast("long").alias("pos"), col("ref").alias("ref"), col("alt").alias("alt"), col("tier").alias("tier"))
    got = got.where((F.length("ref") == 1) & (F.length("alt") == 1))
    if region is None:
        return got
    chrom, first, last = region
    inside = (F.col("chrom") == chrom) & (F.col("pos") >= first)
    return got.where(inside if last is None else inside & (F.col("pos") <= last))


def joint_table(rows: DataFrame, prior: float = 0.5, most: float = 0.006) -> DataFrame:
    """Joint scoring text as (chrom, pos, ref, alt, n, a, tier, flags, llr, log_odds): the likelihood ratio at full precision, as log-odds less the
    prior's where log-odds are there. A printed ratio (``LLR`` or ``llr``) that its rounding cannot explain raises."""
    is_header = F.col("line").rlike(r"(\A|\t)(LLR|llr)(\t|\z)")
    body = _with_header(rows.where(F.trim("line") != ""), is_header).withColumn("f", F.split("line", "\t"))
    col = lambda name: F.when(F.array_position("header", name) > 0, F.get("f", (F.array_position("header", name) - 1).cast("int")))
    printed = F.coalesce(col("LLR"), col("llr")).try_cast("double")
    odds = col("logodds").try_cast("double")
    exact = odds - F.log(F.lit(prior / (1 - prior)))
    llr = F.when(odds.isNull(), printed).when(F.abs(exact - printed) > most, F.raise_error(F.concat(F.lit("LLR and log-odds differ: "), F.substring("line", 1, 80))).cast("double")).otherwise(exact)
    flags = F.filter(F.split(F.coalesce(col("flags"), F.lit("")), ","), lambda x: ~x.isin("", "."))
    number = lambda c: col(c).try_cast("long").alias(c)
    return body.select(col("chrom").alias("chrom"), number("pos"), col("ref").alias("ref"), col("alt").alias("alt"), number("n"), number("a"), col("tier").alias("tier"), flags.alias("flags"), llr.alias("llr"), odds.alias("log_odds"))


def annotation_set(rows: DataFrame) -> DataFrame:
    """Different sites (chrom, pos, ref, alt) of an annotation list, fields split by white space; short lines and a header go."""
    return site_list(rows)


def pooled_calls(rows: DataFrame, fields: Sequence[str] = ("ADf", "ADr", "ADb")) -> tuple[DataFrame, DataFrame]:
    """Pooled calls of VCF text as (chrom, pos, ref, alt, pool, n, a), and (reason, n) of skipped records.

    Depths are summed over the strand fields there are; records that are not bi-allelic single bases, or have no depth field, are skipped.
    """
    data = rows.where(~F.col("line").startswith("##") & (F.trim("line") != ""))
    body = _with_header(data, F.col("line").startswith("#CHROM")).withColumn("f", F.split("line", "\t"))
    fmt = F.split(F.col("f")[8], ":")
    snp = F.col("f")[3].rlike(r"\A[ACGTN]\z") & F.col("f")[4].rlike(r"\A[ACGT]\z") & (F.col("f")[3] != F.col("f")[4])
    has = F.arrays_overlap(fmt, F.array(*[F.lit(x) for x in fields]))
    tagged = body.withColumn("why", F.when(~snp, "not_biallelic_snp").when(~has, "no_depth_field"))
    cells = F.arrays_zip(F.slice("header", 10, 1 << 20).alias("pool"), F.slice("f", 10, 1 << 20).alias("cell"))
    long = tagged.where(F.col("why").isNull()).select(F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("pos"), F.col("f")[3].alias("ref"), F.col("f")[4].alias("alt"), fmt.alias("fmt"), F.inline(cells))
    part = F.split("cell", ":")

    def depth(field: str, which: int) -> Column:
        at = F.array_position("fmt", field).cast("int")
        pair = F.split(F.when(at > 0, F.get(part, at - 1)), ",")
        return F.coalesce(F.get(pair, F.lit(which)).try_cast("long"), F.lit(0))

    ref = sum((depth(x, 0) for x in fields[1:]), depth(fields[0], 0))
    alt = sum((depth(x, 1) for x in fields[1:]), depth(fields[0], 1))
    calls = long.select("chrom", "pos", "ref", "alt", "pool", (ref + alt).alias("n"), alt.alias("a"))
    return calls, tagged.where(F.col("why").isNotNull()).groupBy(F.col("why").alias("reason")).agg(F.count(F.lit(1)).alias("n"))


def site_list(rows: DataFrame) -> DataFrame:
    """Sites of lines with four fields or more and a numeric position; headers and repeats go."""
    f = F.split(F.trim("line"), r"\s+")
    held = rows.select(f.alias("f")).where((F.size("f") >= 4) & F.col("f")[1].rlike(r"\A[0-9]+\z"))
    return held.select(F.col("f")[0].alias("chrom"), F.col("f")[1].cast("long").alias("pos"), F.col("f")[2].alias("ref"), F.col("f")[3].alias("alt")).distinct()


def segment_table(rows: DataFrame) -> DataFrame:
    """Segments (line, chrom, start, end, state) of CSV or TSV text, told by the header line; quotes go, short rows are skipped, ``chr`` is dropped."""
    data = rows.where(F.trim("line") != "").withColumn("line", F.replace("line", F.lit('"'), F.lit("")))
    header = F.lower("line").rlike(r"(\A|[\t,])start_bp([\t,]|\z)")
    first = data.where(header).groupBy("file").agg(F.min_by("line", "at").alias("h")).withColumn("sep", F.when(F.contains("h", F.lit("\t")), "\t").otherwise(","))
    held = data.where(~header).join(first, "file").withColumn("f", F.when(F.col("sep") == "\t", F.split("line", "\t")).otherwise(F.split("line", ","))).withColumn("n", F.when(F.col("sep") == "\t", F.split("h", "\t")).otherwise(F.split("h", ",")))
    col = lambda name: F.trim(F.get("f", (F.array_position("n", name) - 1).cast("int")))
    number = lambda name: col(name).try_cast("double").cast("long")
    return held.where(F.size("f") >= F.size("n")).select(col("name").alias("line"), F.regexp_replace(col("chr"), r"\A(?i)chr", "").alias("chrom"), number("start_bp").alias("start"), number("end_bp").alias("end"), col("state").try_cast("int").alias("state"))


def line_pass(qc: DataFrame) -> DataFrame:
    """(line, line_pass) of line QC rows; values must be true or false and agree over a line's rows."""
    held = qc.select(F.col("sample").alias("line"), F.lower(F.trim(F.col("line_pass").cast("string"))).alias("v"))
    enforce(held.where(~F.coalesce(F.col("v").isin("true", "false"), F.lit(False))), "line_pass is neither true nor false")
    got = held.groupBy("line").agg(F.min("v").alias("a"), F.max("v").alias("b"))
    enforce(got.where(F.col("a") != F.col("b")), "line_pass differs between rows")
    return got.select("line", (F.col("a") == "true").alias("line_pass"))


def prior_grid(spark: SparkSession, table: DataFrame | None = None, top: float = 1.5, step: float = 0.05) -> DataFrame:
    """(c, weight), weights summing to 1; without a table a flat grid from 0 to ``top``. The weight column may be weight, p, prob or count."""
    if table is None:
        n = round(top / step) + 1
        return spark.range(n).select((F.col("id") * step).alias("c"), F.lit(1.0 / n).alias("weight"))
    name = next((c for c in ("weight", "p", "prob", "count") if c in table.columns), None)
    if name is None:
        raise GuardError("the prior has no weight column")
    rows = table.select(F.col("c").cast("double").alias("c"), F.col(name).cast("double").alias("w")).where(F.col("w") > 0)
    return rows.select("c", (F.col("w") / F.sum("w").over(Window.partitionBy(F.lit(0)))).alias("weight"))  # a few dozen rows


def bed(rows: DataFrame) -> DataFrame:
    """Ranges (chrom, start, end), half-open; comments, track and browser lines go; bad numbers or order raise."""
    data = rows.where((F.trim("line") != "") & ~F.col("line").rlike(r"\A(#|track|browser)")).withColumn("f", F.split(F.trim("line"), r"\s+"))
    a, b = F.get("f", F.lit(1)).try_cast("long"), F.get("f", F.lit(2)).try_cast("long")
    ok = F.coalesce((a >= 0) & (b > a), F.lit(False))
    return data.select(F.col("f")[0].alias("chrom"), F.when(ok, a).otherwise(F.raise_error(F.concat(F.lit("bad range: "), F.col("line")))).alias("start"), b.alias("end"))


def coverage_metrics(spark: SparkSession, path: str) -> DataFrame:
    """(sample, mean_coverage, pct_1x) of metrics files: header and one value line after the first ``## METRICS CLASS``. Absent keys are null."""
    raw = spark.read.text(path, wholetext=True).select(F.regexp_extract("_metadata.file_name", r"\A([^.]+)", 1).alias("sample"), F.split("value", r"\r?\n").alias("l"))
    at = F.aggregate(F.sequence(F.lit(0), F.size("l") - 1), F.lit(-1), lambda s, i: F.when((s < 0) & F.get("l", i).startswith("## METRICS CLASS"), i).otherwise(s))
    held = raw.withColumn("at", at).where(F.col("at") >= 0).select("sample", F.split(F.get("l", F.col("at") + 1), "\t").alias("k"), F.split(F.get("l", F.col("at") + 2), "\t").alias("v"))
    value = lambda key: F.get("v", (F.array_position("k", key) - 1).cast("int")).try_cast("double")
    return held.select("sample", value("MEAN_COVERAGE").alias("mean_coverage"), value("PCT_1X").alias("pct_1x"))


def alignments(rows: DataFrame) -> DataFrame:
    """Records of SAM text; header lines go, a line with fewer than eleven fields raises."""
    f = F.split("line", "\t")
    data = rows.where(~F.col("line").startswith("@")).select(F.when(F.size(f) >= 11, f).otherwise(F.raise_error(F.concat(F.lit("not an alignment: "), F.substring("line", 1, 60)))).alias("f"))
    c = F.col("f")
    return data.select(c[0].alias("qname"), c[1].cast("int").alias("flag"), c[2].alias("rname"), c[3].cast("long").alias("pos"), c[4].cast("int").alias("mapq"), c[5].alias("cigar"), c[9].alias("seq"), c[10].alias("qual"))


def fastq(rows: DataFrame, first: int | None = None) -> DataFrame:
    """(file, read, seq) of FASTQ text, the first ``first`` reads of each file.

    Lines are numbered in parts: within each split of a file, from where the splits before it end. A compressed file is one split.
    """
    split = F.col("at")["split"]
    sizes = rows.groupBy("file", split.alias("split")).agg(F.count(F.lit(1)).alias("k"))
    begins = sizes.withColumn("begin", F.coalesce(F.sum("k").over(Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("k")
    if first is not None:
        begins = begins.where(F.col("begin") < 4 * first)  # later splits are not read again
    own = F.row_number().over(Window.partitionBy("file", "split").orderBy("at")) - 1
    numbered = rows.withColumn("split", split).join(F.broadcast(begins), ["file", "split"]).withColumn("i", F.col("begin") + own)  # one row a split
    got = numbered.where(F.col("i") % 4 == 1).select("file", F.floor(F.col("i") / 4).alias("read"), F.col("line").alias("seq"))
    return got if first is None else got.where(F.col("read") < first)


#: The parts of a lane report that are read. A fixed shape.
DEMUX_REPORT = "read_counts struct<input: bigint>, adapters_read1 array<struct<name: string, total_matches: bigint>>"


def demux_reports(spark: SparkSession, path: str) -> DataFrame:
    """(file, input, adapters) of nested JSON reports."""
    raw = spark.read.schema(DEMUX_REPORT).option("multiLine", True).json(path)
    return raw.select(F.col("_metadata.file_name").alias("file"), F.col("read_counts.input").alias("input"), F.col("adapters_read1").alias("adapters"))


def fasta_index(rows: DataFrame) -> DataFrame:
    f = F.split("line", "\t")
    return rows.where(F.trim("line") != "").select(f[0].alias("chrom"), f[1].cast("long").alias("length"))


def provenance(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Provenance records, one JSON document a file, under a schema given by the caller."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def pinned(spark: SparkSession, paths: Sequence[str], digests: dict[str, str]) -> None:
    """Refuse files that are not listed, or whose sha256 differs."""
    got = spark.read.format("binaryFile").load(list(paths)).select(F.element_at(F.split("path", "/"), -1).alias("name"), F.sha2("content", 256).alias("digest"))
    want = spark.createDataFrame(sorted(digests.items()), "name string, want string")
    enforce(got.join(want, "name", "left").where(~F.col("digest").eqNullSafe(F.col("want"))), "source not as pinned")


def mate_pairs(files: DataFrame, name: str = "name") -> DataFrame:
    """R1 and R2 files of one run, paired by the name with its mate number masked; files without a mate raise a guard."""
    key = F.regexp_replace(F.col(name), r"_R[12](_|\.)", "_R?$1")
    held = files.select(key.alias("key"), F.regexp_extract(F.col(name), r"_R([12])(_|\.)", 1).alias("mate"), F.col(name).alias("n"))
    got = held.groupBy("key").agg(F.max(F.when(F.col("mate") == "1", F.col("n"))).alias("r1"), F.max(F.when(F.col("mate") == "2", F.col("n"))).alias("r2"))
    enforce(got.where(F.col("r1").isNull() | F.col("r2").isNull()), "file without mate")
    return got.select("r1", "r2")


def raw_files(spark: SparkSession, path: str, pattern: str = "*.fastq.gz") -> DataFrame:
    """(path, name, length) of the files under a folder whose name follows a glob; contents are not read."""
    return spark.read.format("binaryFile").option("pathGlobFilter", pattern).option("recursiveFileLookup", True).load(path).select("path", F.element_at(F.split("path", "/"), -1).alias("name"), "length")


def tar_members(text: Column) -> Column:
    """(archive, member, position) of a list such as ``a.tar:m1;a.tar:m2``; plain paths have no archive, empty places go."""
    parts = F.filter(F.transform(F.split(text, ";"), F.trim), lambda x: x != "")
    held = lambda x, i: F.struct(F.nullif(F.regexp_extract(x, r"\A(.+\.tar):", 1), F.lit("")).alias("archive"), F.regexp_replace(x, r"\A.+\.tar:", "").alias("member"), (i + 1).alias("position"))
    return F.transform(parts, held)


def stored(spark: SparkSession, paths: DataFrame, index: str | None = None, end: bytes | None = None) -> DataFrame:
    """Paths with ``complete``: the file is there, so is its index (path + ``index``), and its last bytes are ``end``, where these are asked for.

    Few paths, one a sample: they are looked up from the driver; of a file only its last bytes are read.
    """
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    out = []
    for (path,) in paths.select("path").distinct().toLocalIterator():
        p = fs_path(path)
        fs = p.getFileSystem(conf)
        ok = fs.exists(p) and (index is None or fs.exists(fs_path(path + index)))
        if ok and end is not None:
            size = fs.getFileStatus(p).getLen()
            ok = size >= len(end)
            if ok:
                stream = fs.open(p)
                stream.seek(size - len(end))
                ok = bytes(stream.readNBytes(len(end))) == end
                stream.close()
        out.append((path, bool(ok)))
    return spark.createDataFrame(out, "path string, complete boolean")


_XML = {"m": "http://schemas.openxmlformats.org/spreadsheetml/2006/main"}


def xlsx(spark: SparkSession, path: str, sheet_name: str) -> DataFrame:
    """A worksheet with a header row, all columns as text; an edge tool for small files, read on the driver.

    Shared and inline strings, booleans as TRUE and FALSE, whole numbers without ``.0``; empty cells are null, empty rows go.
    """
    with zipfile.ZipFile(path) as z:
        book = ElementTree.fromstring(z.read("xl/workbook.xml"))
        names = [s.get("name") for s in book.iterfind("m:sheets/m:sheet", _XML)]
        if sheet_name not in names:
            raise GuardError(f"{path} has no sheet {sheet_name!r}, only {names}")
        shared = []
        if "xl/sharedStrings.xml" in z.namelist():
            shared = ["".join(x.text or "" for x in si.iter(f"{{{_XML['m']}}}t")) for si in ElementTree.fromstring(z.read("xl/sharedStrings.xml")).iterfind("m:si", _XML)]
        page = ElementTree.fromstring(z.read(f"xl/worksheets/sheet{names.index(sheet_name) + 1}.xml"))
    table: list[dict[int, str]] = []
    for row in page.iterfind("m:sheetData/m:row", _XML):
        cells: dict[int, str] = {}
        for c in row.iterfind("m:c", _XML):
            at = 0
            for letter in re.match("[A-Z]+", c.get("r", "A"))[0]:
                at = at * 26 + ord(letter) - 64
            kind, value = c.get("t", "n"), c.findtext("m:v", None, _XML)
            if kind == "inlineStr":
                value = "".join(x.text or "" for x in c.iter(f"{{{_XML['m']}}}t"))
            elif value is not None and kind == "s":
                value = shared[int(value)]
            elif value is not None and kind == "b":
                value = "TRUE" if value == "1" else "FALSE"
            elif value is not None and kind == "n" and re.fullmatch(r"-?[0-9]+\.0+", value):
                value = value.split(".")[0]
            if value not in (None, ""):
                cells[at] = value
        if cells:
            table.append(cells)
    if not table:
        return spark.createDataFrame([], T.StructType([]))
    head = sorted(table[0])
    schema = T.StructType([T.StructField(table[0][i], T.StringType()) for i in head])
    return spark.createDataFrame([tuple(r.get(i) for i in head) for r in table[1:]], schema)


def simulate_donors(spark: SparkSession, sites: int, donors: int, seed: int = 1, neutral: bool = True) -> DataFrame:
    """(site, donor, has): Bernoulli draws from a neutral (density 1/p) or flat frequency spectrum, by hash, the same on any cluster."""
    u = lambda *c: F.pmod(F.xxhash64(F.lit(seed), *c), F.lit(1 << 30)) / float(1 << 30)
    p = F.pow(F.lit(0.01), u(F.col("id"), F.lit("p"))) if neutral else u(F.col("id"), F.lit("p"))
    base = spark.range(sites).select(F.col("id").alias("site"), p.alias("p"))
    return base.select("site", F.explode(F.sequence(F.lit(0), F.lit(donors - 1))).alias("donor"), "p").select("site", "donor", (u(F.col("site"), F.col("donor")) < F.col("p")).alias("has"))


def regions(text: Column) -> Column:
    """chrom, start, end of ``chrom`` or ``chrom:start-end``; commas in numbers go; no end means the whole chromosome."""
    clean = F.replace(text, F.lit(","), F.lit(""))
    part = lambda i: F.regexp_extract(clean, r"\A(.+?)(?::([0-9]+)-([0-9]+))?\z", i)
    number = lambda i: F.when(part(i) != "", part(i)).try_cast("long")
    return F.struct(part(1).alias("chrom"), F.coalesce(number(2), F.lit(1).cast("long")).alias("start"), number(3).alias("end"))
