"""Queries over the project's own tables: parse failures, copy differences, orphan references, packed fields."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seedwork.operators.copy_diff import diff_copies
from seedwork.operators.orphans import find_orphans, orphans_by_period
from seedwork.operators.packed import unpack
from seedwork.operators.parse_rows import bad_rows, good_rows
from seedwork.session import table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return bad_rows(table(spark, sf, "bzea_metadata_local_corrected"))


def p1_loaded(spark: SparkSession, sf: str) -> DataFrame:
    rows = good_rows(table(spark, sf, "bzea_metadata_local_corrected"))
    return rows.select("line_id", "latitude", "longitude", "collection_date")


def p1_reasons(spark: SparkSession, sf: str) -> DataFrame:
    lines = table(spark, sf, "bzea_metadata_local_corrected")
    return bad_rows(lines, keep=("line_id", "file_name")).groupBy("file_name", "reason").agg(F.count(F.lit(1)).alias("n"))


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated sample_ids are unchanged repetitions, so each side's repeats count once."""
    report = diff_copies(table(spark, sf, "registry_test"), table(spark, sf, "registry_copy"), ["sample_id"], distinct=True, only_left="only_registry_test", only_right="only_registry_copy")
    return report.where(~F.col("kind").isin("extra_left", "extra_right")).select("sample_id", F.col("kind").alias("diff")).distinct()


def p4_by_field(spark: SparkSession, sf: str) -> DataFrame:
    return p4_found(spark, sf).groupBy("diff").agg(F.count(F.lit(1)).alias("n"))


def p4_copies(spark: SparkSession, sf: str) -> DataFrame:
    """The two copies compared with their repeats: differing fields of paired rows, rows of which one side has more, one-sided samples."""
    return diff_copies(table(spark, sf, "registry_test"), table(spark, sf, "registry_copy"), ["sample_id"], only_left="only_registry_test", only_right="only_registry_copy")


_LIBRARY = ("source", "library", "plate", "well", "donor", "taxon", "pedigree", "gen")


def p4_by_source(spark: SparkSession, sf: str) -> DataFrame:
    """Rows of both copies by source, which many rows share: how many of one side are left over after identical ones cancel and the others pair."""
    names = [f"registry_{x}" for x in ("test", "copy")]
    a, b = (table(spark, sf, n).select("sample_id", *_LIBRARY) for n in names)
    report = diff_copies(a, b, ["source"])
    kinds = ("only_left", "only_right", "extra_left", "extra_right")
    return report.where(F.col("kind").isin(*kinds)).select("source", "kind", "n")


_REFS = ("bc1_well_map", "dev_import")


def _orphans(spark: SparkSession, sf: str) -> DataFrame:
    refs = None
    for name in _REFS:
        part = table(spark, sf, name).select(F.lit(name).alias("src_table"), "row_id", "recorded_at", F.trim("donor").alias("donor")).distinct()
        refs = part if refs is None else refs.unionByName(part)
    named = refs.withColumn("ref", F.when(~F.col("donor").isin("", "NA"), F.substring_index("donor", "_", 1)))
    # A donor that begins with an underscore names the empty accession, which is a reference to nothing that exists.
    named = named.withColumn("ref", F.when((F.col("ref") == "") & (F.col("donor") != ""), F.lit("_")).otherwise(F.col("ref")))
    return find_orphans(named, table(spark, sf, "accessions"), ref="ref", at="recorded_at", key="accession", begin="registered_at", end="deleted_at", nothing=())


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return _orphans(spark, sf).select("src_table", "row_id", "kind").distinct()


def p5_by_month(spark: SparkSession, sf: str) -> DataFrame:
    return orphans_by_period(_orphans(spark, sf).select("src_table", "row_id", "recorded_at", "kind").distinct(), "src_table", "recorded_at")


def p6_found(spark: SparkSession, sf: str) -> DataFrame:
    """Paths hold ``/``, so it separates only in the other fields; ``+`` and ``&`` likewise."""
    out = None
    for name, key, field, separators in (("registry_test", "sample_id", "raw_r1", ";,|"), ("registry_test", "sample_id", "rg_pu", ";,|+/&"), ("accessions", "row_id", "correction_ids", ";,|+/&")):
        # Rows that were sent again hold the same values: the packed field is read once for each key.
        rows = table(spark, sf, name).select(key, field).distinct()
        part = unpack(rows, key, field, separators).select(F.lit(name).alias("src_table"), "row_key", F.lit(field).alias("field"), "pos", "item")
        out = part if out is None else out.unionByName(part)
    return out


def p6_counts(spark: SparkSession, sf: str) -> DataFrame:
    return p6_found(spark, sf).groupBy("src_table", "field").agg(F.count(F.lit(1)).alias("n_items"), F.max("pos").cast("int").alias("max_pos"))


QUERIES = {f.__name__: f for f in (p1_found, p1_loaded, p1_reasons, p4_found, p4_by_field, p4_copies, p4_by_source, p5_found, p5_by_month, p6_found, p6_counts)}


# --- SQL twins -----------------------------------------------------------------------------------------------------

_P1 = r"""
WITH l AS (SELECT line_id, file_name, regexp_replace(raw_line, '[\r\n]+$', '') AS t FROM bzea_metadata_local_corrected),
k AS (SELECT *, regexp_full_match(t, '(?s)("([^"]|"")*"|[^",]*)(,("([^"]|"")*"|[^",]*))*') AS ok FROM l),
f AS (SELECT *, list_transform(string_split(regexp_replace(regexp_replace(t, '("([^"]|"")*")', chr(1) || '\1' || chr(1), 'g'), ',', chr(2), 'g'), chr(1)), lambda p, i: CASE WHEN i % 2 = 0 THEN replace(p, chr(2), ',') ELSE p END) AS pieces FROM k),
v AS (SELECT line_id, file_name, t, ok, list_transform(string_split(array_to_string(pieces, ''), chr(2)), lambda x: CASE WHEN starts_with(x, '"') THEN replace(substr(x, 2, length(x) - 2), '""', '"') ELSE x END) AS c FROM f),
w AS (SELECT *, trim(c[2], ' ') AS d, trim(c[11], ' ') AS la, trim(c[12], ' ') AS lo FROM v),
r AS (SELECT line_id, file_name, d, la, lo, CASE
    WHEN t IS NULL THEN 'column_count' WHEN NOT ok THEN 'broken_quoting' WHEN len(c) <> 15 THEN 'column_count'
    WHEN NOT (la IN ('', 'NA') OR (regexp_full_match(la, '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)') AND coalesce(abs(TRY_CAST(la AS DOUBLE)) <= 90, false))) THEN 'invalid_value'
    WHEN NOT (lo IN ('', 'NA') OR (regexp_full_match(lo, '[+-]?([0-9]+([.][0-9]*)?|[.][0-9]+)') AND coalesce(abs(TRY_CAST(lo AS DOUBLE)) <= 180, false))) THEN 'invalid_value'
    WHEN NOT (d IN ('', 'NA') OR (regexp_full_match(d, '[0-9]{4}(-[0-9]{2}(-[0-9]{2})?)?') AND TRY_CAST(substr(d, 1, 4) AS INT) BETWEEN 1850 AND 2026
        AND TRY_CAST(CASE length(d) WHEN 4 THEN d || '-01-01' WHEN 7 THEN d || '-01' ELSE d END AS DATE) IS NOT NULL)) THEN 'invalid_value' END AS reason FROM w)
"""

_FIELDS = """source role library library_index raw_location raw_r1 raw_r2 barcode_r1 barcode_r2 barcode_layout plate well donor taxon nil_id pedigree is_check rg_lb
rg_pl rg_pu lab_seq_id delivered_name accession taxa_code line_id gen field_plot seed_packet replicate_of pedigree_resolved nil_id_resolved donor_resolved correction_ids exclude
exclude_reason flags""".split()

_P4 = (
    f"WITH a AS (SELECT DISTINCT sample_id, {', '.join(_FIELDS)} FROM registry_test), b AS (SELECT DISTINCT sample_id, {', '.join(_FIELDS)} FROM registry_copy),"
    " d AS (SELECT sample_id, 'only_registry_test' AS diff FROM a WHERE sample_id NOT IN (SELECT sample_id FROM b) UNION ALL SELECT sample_id, 'only_registry_copy' FROM b WHERE sample_id NOT IN (SELECT sample_id FROM a)"
    + "".join(f" UNION ALL SELECT a.sample_id, '{c}' FROM a JOIN b ON a.sample_id = b.sample_id WHERE a.{c} IS DISTINCT FROM b.{c}" for c in _FIELDS)
    + ")"
)

_P4_COPIES = (
    f"WITH a AS (SELECT sample_id, {', '.join(_FIELDS)}, count(*) AS n FROM registry_test GROUP BY ALL), b AS (SELECT sample_id, {', '.join(_FIELDS)}, count(*) AS n FROM registry_copy GROUP BY ALL),"
    " d AS (SELECT sample_id, 'only_registry_test' AS kind, 1 AS n FROM a WHERE sample_id NOT IN (SELECT sample_id FROM b) UNION ALL SELECT sample_id, 'only_registry_copy', 1 FROM b WHERE sample_id NOT IN (SELECT sample_id FROM a)"
    " UNION ALL SELECT a.sample_id, CASE WHEN a.n > b.n THEN 'extra_left' ELSE 'extra_right' END, abs(a.n - b.n) FROM a JOIN b ON a.sample_id = b.sample_id WHERE a.n <> b.n"
    + "".join(f" UNION ALL SELECT a.sample_id, '{c}', least(a.n, b.n) FROM a JOIN b ON a.sample_id = b.sample_id WHERE a.{c} IS DISTINCT FROM b.{c}" for c in _FIELDS)
    + ") SELECT sample_id, kind, CAST(n AS BIGINT) AS n FROM d"
)
_P4_SOURCE = """WITH a AS (SELECT source, count(*) AS n FROM registry_test GROUP BY source), b AS (SELECT source, count(*) AS n FROM registry_copy GROUP BY source),
 j AS (SELECT coalesce(a.source, b.source) AS source, a.n AS na, b.n AS nb FROM a FULL JOIN b ON a.source IS NOT DISTINCT FROM b.source)
 SELECT source, CASE WHEN nb IS NULL THEN 'only_left' WHEN na IS NULL THEN 'only_right' WHEN na > nb THEN 'extra_left' ELSE 'extra_right' END AS kind, CASE WHEN na IS NULL OR nb IS NULL THEN 1 ELSE abs(na - nb) END AS n FROM j WHERE na IS DISTINCT FROM nb"""

_P5 = """
WITH refs AS (SELECT DISTINCT 'bc1_well_map' AS src_table, row_id, recorded_at, trim(donor, ' ') AS donor FROM bc1_well_map UNION ALL SELECT DISTINCT 'dev_import', row_id, recorded_at, trim(donor, ' ') FROM dev_import),
k AS (SELECT *, string_split(donor, '_')[1] AS acc FROM refs WHERE donor IS NOT NULL AND donor NOT IN ('', 'NA')),
j AS (SELECT k.src_table, k.row_id, k.recorded_at, count(a.accession) AS n,
    coalesce(bool_or(a.registered_at <= k.recorded_at AND (a.deleted_at IS NULL OR a.deleted_at > k.recorded_at)), false) AS sound,
    coalesce(bool_and(coalesce(a.registered_at > k.recorded_at, false)), false) AS late
    FROM k LEFT JOIN accessions a ON trim(a.accession, ' ') = k.acc GROUP BY ALL),
o AS (SELECT src_table, row_id, recorded_at, CASE WHEN n = 0 THEN 'missing' WHEN late THEN 'late' ELSE 'deleted' END AS kind FROM j WHERE NOT sound)
"""


def _p6_part(table_name: str, key: str, field: str, sep: str) -> str:
    return (
        f"SELECT '{table_name}' AS src_table, row_key, '{field}' AS field, x.pos AS pos, x.item AS item FROM (SELECT row_key, unnest(list_transform(vals, lambda v, i: {{'pos': i, 'item': v}})) AS x FROM ("
        f"SELECT row_key, list_transform(regexp_extract_all(f, '\"(?:[^\"]|\"\")*\"|''(?:[^'']|'''')*''|[^{sep} \\t\\r\\n]+'), lambda v: CASE WHEN v[1] = '\"' THEN replace(v[2:-2], '\"\"', '\"') WHEN v[1] = '''' THEN replace(v[2:-2], '''''', '''') ELSE v END) AS vals "
        f"FROM (SELECT DISTINCT CAST({key} AS VARCHAR) AS row_key, {field} AS f FROM {table_name}) WHERE trim(f) NOT IN ('', '.', 'NA')))"
    )


_P6 = "WITH u AS (" + " UNION ALL ".join([_p6_part("registry_test", "sample_id", "raw_r1", ";,|"), _p6_part("registry_test", "sample_id", "rg_pu", ";,|+/&"), _p6_part("accessions", "row_id", "correction_ids", ";,|+/&")]) + ")"

ORACLES = {
    "p1_found": _P1 + "SELECT line_id, reason FROM r WHERE reason IS NOT NULL",
    "p1_loaded": _P1 + "SELECT line_id, TRY_CAST(nullif(nullif(la, ''), 'NA') AS DOUBLE) AS latitude, TRY_CAST(nullif(nullif(lo, ''), 'NA') AS DOUBLE) AS longitude, nullif(nullif(d, ''), 'NA') AS collection_date FROM r WHERE reason IS NULL",
    "p1_reasons": _P1 + "SELECT file_name, reason, count(*) AS n FROM r WHERE reason IS NOT NULL GROUP BY ALL",
    "p4_found": _P4 + " SELECT sample_id, diff FROM d",
    "p4_by_field": _P4 + " SELECT diff, count(*) AS n FROM d GROUP BY diff",
    "p4_copies": _P4_COPIES,
    "p4_by_source": _P4_SOURCE,
    "p5_found": _P5 + "SELECT src_table, row_id, kind FROM o",
    "p5_by_month": _P5 + "SELECT src_table, strftime(recorded_at, '%Y-%m') AS month, kind, count(*) AS n FROM o GROUP BY ALL",
    "p6_found": _P6 + " SELECT src_table, row_key, field, CAST(pos AS INT) AS pos, item FROM u",
    "p6_counts": _P6 + " SELECT src_table, field, count(*) AS n_items, CAST(max(pos) AS INT) AS max_pos FROM u GROUP BY ALL",
}
