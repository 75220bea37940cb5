"""Read-level steps in SQL expressions: base counts by cycle, start masking, demultiplexing, composition."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seedwork.session import sized

#: Cycle bins (first, last cycle); None leaves the last open.
BINS = ((1, 2), (3, 4), (5, 8), (9, 12), (13, 20), (21, 40), (41, 80), (81, None))


def cigar_ops(cigar: Column) -> Column:
    """(n, op) of each CIGAR element."""
    return F.transform(F.regexp_extract_all(cigar, F.lit(r"([0-9]+)([MIDNSHP=X])"), F.lit(0)), lambda t: F.struct(F.substring(t, F.lit(1), F.length(t) - 1).cast("int").alias("n"), F.right(t, F.lit(1)).alias("op")))


def aligned_bases(reads: DataFrame, least_quality: int = 20) -> DataFrame:
    """One row per aligned base: mate, cycle from the 5' end, position, base. ``reads``: flag, pos, cigar, seq, qual and any others, which are kept.

    M, = and X consume both, D and N the reference, I and S the read; hard clips count towards the read's length. Offsets are running
    sums over the elements; blocks of aligned bases are then exploded, so work follows the bases.
    """
    ok = reads.where((F.col("cigar") != "*") & (F.col("seq") != "*")).withColumn("__ops", cigar_ops(F.col("cigar")))
    zero = F.struct(F.col("pos").cast("long").alias("r"), F.lit(0).alias("q"), F.array().cast("array<struct<r:bigint,q:int,n:int>>").alias("out"))

    def step(acc: Column, x: Column) -> Column:
        both, ref, read = x["op"].isin("M", "=", "X"), x["op"].isin("M", "=", "X", "D", "N"), x["op"].isin("M", "=", "X", "I", "S")
        out = F.when(both, F.concat(acc["out"], F.array(F.struct(acc["r"].alias("r"), acc["q"].alias("q"), x["n"].alias("n"))))).otherwise(acc["out"])
        return F.struct((acc["r"] + F.when(ref, x["n"]).otherwise(0)).alias("r"), (acc["q"] + F.when(read, x["n"]).otherwise(0)).alias("q"), out.alias("out"))

    hard = lambda x: F.when(x["op"] == "H", x["n"]).otherwise(0)
    lead = hard(F.element_at("__ops", 1))
    tail = F.when(F.size("__ops") > 1, hard(F.element_at("__ops", -1))).otherwise(0)
    held = ok.withColumn("__lead", lead).withColumn("__len", lead + F.length("seq") + tail)
    held = held.withColumn("__b", F.explode(F.aggregate("__ops", zero, step, lambda acc: acc["out"]))).withColumn("__k", F.explode(F.sequence(F.lit(0), F.col("__b.n") - 1)))
    qi = F.col("__b.q") + F.col("__k")
    quality = F.ascii(F.substring("qual", qi + 1, F.lit(1))) - 33
    rev = F.col("flag").bitwiseAND(0x10) != 0
    index = F.col("__lead") + qi
    cycle = F.when(rev, F.col("__len") - index).otherwise(index + 1)
    mate = F.when(F.col("flag").bitwiseAND(0x80) != 0, 2).otherwise(1)
    base = F.upper(F.substring("seq", qi + 1, F.lit(1)))
    good = held.where((F.col("qual") == "*") | (quality >= least_quality))
    rest = [c for c in reads.columns if c not in ("flag", "pos", "cigar", "seq", "qual")]
    return good.select(*rest, mate.alias("mate"), cycle.alias("cycle"), (F.col("__b.r") + F.col("__k")).alias("pos"), base.alias("base"))


def cycle_counts(reads: DataFrame, sites: DataFrame, samples: DataFrame, least_quality: int = 20, bins: Sequence[tuple[int, int | None]] = BINS, whole: bool = False) -> DataFrame:
    """Reads of REF, ALT and other bases at sites by sample, mate and cycle bin; every bin of every sample has a row.

    ``sites``: pos, ref, alt, and rname where reads hold one; then a base counts at sites of its own chromosome only. With ``whole`` the
    bins of all samples together come out too, under a null sample.
    """
    at = ["rname", "pos"] if "rname" in sites.columns else ["pos"]
    hit = aligned_bases(reads, least_quality).join(sized(sites.select(*at, "ref", "alt")), at)
    which = F.lit(None).cast("int")
    for i, (a, b) in reversed(list(enumerate(bins))):
        which = F.when(F.col("cycle") >= a if b is None else F.col("cycle").between(a, b), i).otherwise(which)
    got = hit.withColumn("bin", which).where(F.col("bin").isNotNull()).groupBy("sample", "mate", "bin").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("base") == F.col("ref")).alias("n_ref"), F.count_if((F.col("base") == F.col("alt")) & (F.col("base") != F.col("ref"))).alias("n_alt"))
    every = samples.select("sample").distinct()
    if whole:
        none = F.lit(None).cast(every.schema["sample"].dataType)
        got = got.unionByName(got.groupBy("mate", "bin").agg(*[F.sum(c).alias(c) for c in ("n", "n_ref", "n_alt")]).withColumn("sample", none))
        every = every.where(F.col("sample").isNotNull()).unionByName(samples.sparkSession.range(1).select(none.alias("sample")))
    grid = every.select("sample", F.explode(F.array(F.lit(1), F.lit(2))).alias("mate")).select("sample", "mate", F.explode(F.array(*[F.lit(i) for i in range(len(bins))])).alias("bin"))
    on = [F.col(f"g.{c}").eqNullSafe(F.col(f"c.{c}")) for c in ("sample", "mate", "bin")]
    out = grid.alias("g").join(got.alias("c"), on, "left").select("g.sample", "g.mate", "g.bin", "c.n", "c.n_ref", "c.n_alt").fillna(0, ["n", "n_ref", "n_alt"])
    return out.withColumn("n_other", F.col("n") - F.col("n_ref") - F.col("n_alt"))


def mask_starts(flag: Column, qual: Column, first: Column, second: Column) -> Column:
    """QUAL with the first N qualities in sequencing order set to ``!``, N by mate. Secondary and supplementary records and ``*`` stay."""
    n = F.least(F.when(flag.bitwiseAND(0x80) != 0, second).otherwise(first), F.length(qual))
    rev = flag.bitwiseAND(0x10) != 0
    masked = F.when(rev, F.concat(F.substring(qual, F.lit(1), F.length(qual) - n), F.repeat(F.lit("!"), n))).otherwise(F.concat(F.repeat(F.lit("!"), n), F.substring(qual, n + 1, F.length(qual))))
    return F.when((qual == "*") | (flag.bitwiseAND(0x900) != 0) | (n <= 0), qual).otherwise(masked)


def demultiplex(reads: DataFrame, barcodes: DataFrame, seq: str, skip: int = 0, mate: str | None = None) -> DataFrame:
    """Reads whose start equals a barcode exactly (both mates where the layout is symmetric), cut after it, with the sample.

    ``barcodes``: sample, barcode. One pass: prefixes of the few lengths there are go into one equality join; the longest barcode that
    fits wins, and of one barcode given to several samples the first by name, so a read comes out once. Barcodes are few (counted before
    they are broadcast); repeated reads stay apart.
    """
    codes = barcodes.where(F.length("barcode") > 0).groupBy("barcode").agg(F.min("sample").alias("sample"))
    sizes = [r["n"] for r in codes.select(F.length("barcode").alias("n")).distinct().orderBy(F.col("n").desc()).collect()]  # a handful of lengths
    if not sizes:
        kinds = {f.name: f.dataType for f in barcodes.schema}
        return reads.limit(0).withColumns({"sample": F.lit(None).cast(kinds["sample"]), "barcode": F.lit(None).cast(kinds["barcode"]), "trimmed": F.lit(None).cast("string")})
    # All barcodes as one map of a single row, so the longest fitting prefix is found by lookups within the row.
    known = sized(codes.agg(F.map_from_entries(F.collect_list(F.struct("barcode", "sample"))).alias("__codes")))
    held = reads.crossJoin(known)
    fits = [F.when(F.map_contains_key("__codes", F.substring(F.col(seq), 1, k)) & ((F.substring(F.col(mate), 1, k) == F.substring(F.col(seq), 1, k)) if mate else F.lit(True)), F.substring(F.col(seq), 1, k)) for k in sizes]
    held = held.withColumn("barcode", F.coalesce(*fits)).where(F.col("barcode").isNotNull())
    cut = F.substring(F.col(seq), F.length("barcode") + skip + 1, F.length(seq))
    return held.select(*reads.columns, F.element_at("__codes", F.col("barcode")).alias("sample"), "barcode", cut.alias("trimmed"))


def base_composition(reads: DataFrame, by: Sequence[str], seq: str, positions: int = 10) -> DataFrame:
    """Counts of each letter at each of the first positions."""
    letters = F.posexplode(F.split(F.substring(F.col(seq), 1, positions), "")).alias("position", "base")
    return reads.where(F.length(seq) > 0).select(*by, letters).where(F.col("base") != "").groupBy(*by, (F.col("position") + 1).alias("position"), "base").agg(F.count(F.lit(1)).alias("n"))


def literal_share(reads: DataFrame, by: Sequence[str], seq: str, literal: str) -> DataFrame:
    """Reads checked and the share of them that holds a literal, such as an adapter."""
    return reads.where(F.col(seq).isNotNull()).groupBy(*by).agg(F.count(F.lit(1)).alias("reads_checked"), (F.count_if(F.contains(F.col(seq), F.lit(literal))) / F.count(F.lit(1))).alias("literal_share"))


def mask_log(reads: DataFrame, by: Sequence[str], first: Column, second: Column) -> DataFrame:
    """Per group: records, records whose starts are masked, and qualities overwritten (those of :func:`mask_starts`)."""
    n = F.least(F.when(F.col("flag").bitwiseAND(0x80) != 0, second).otherwise(first), F.length("qual"))
    hit = (F.col("qual") != "*") & (F.col("flag").bitwiseAND(0x900) == 0) & (n > 0)
    return reads.groupBy(*by).agg(F.count(F.lit(1)).alias("records"), F.count_if(hit).alias("masked"), F.coalesce(F.sum(F.when(hit, n)), F.lit(0)).cast("long").alias("qualities"))


def count_alleles(reads: DataFrame, sites: DataFrame, least_quality: int = 20, least_mapq: int = 20, flag_mask: int = 0xF04) -> DataFrame:
    """A plain pile-up at sites: depths per sample in REF, ALT order. No realignment, no depth cap. ``reads`` also holds sample and mapq.

    Sites hold rname where reads do; then a base counts at sites of its own chromosome only.
    """
    kept = reads.where((F.col("mapq") >= least_mapq) & (F.col("flag").bitwiseAND(flag_mask) == 0))
    at = ["rname", "pos"] if "rname" in sites.columns else ["pos"]
    hit = aligned_bases(kept, least_quality).join(sized(sites.select(*at, "ref", "alt")), at)
    depth = lambda c: F.count_if(F.col("base") == F.col(c)).cast("int")
    return hit.groupBy("sample", *at, "ref", "alt").agg(F.array(depth("ref"), depth("alt")).alias("ad"))


def demux_totals(reports: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Per library: read pairs, assigned ones by sample over all lanes, samples without reads. ``reports``: library, input, adapters array<struct<name, total_matches>>."""
    whole = reports.groupBy("library").agg(F.sum("input").alias("pairs"))
    per = demux_samples(reports, barcodes).groupBy("library").agg(F.sum("reads").alias("assigned"), F.array_sort(F.collect_list(F.when(F.col("reads") == 0, F.col("sample")))).alias("without_reads"))
    return whole.join(per, "library", "left")


def demux_samples(reports: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Per library and sample of the barcode table: reads over all lanes and their share of the library's input."""
    whole = reports.groupBy("library").agg(F.sum("input").alias("__pairs"))
    hits = reports.select("library", F.inline("adapters")).groupBy("library", F.col("name").alias("sample")).agg(F.sum("total_matches").alias("reads"))
    held = barcodes.select("library", "sample").distinct().join(hits, ["library", "sample"], "left").fillna(0, ["reads"]).join(whole, "library", "left")
    return held.withColumn("share_of_input", F.col("reads") / F.nullif(F.col("__pairs"), F.lit(0))).drop("__pairs")


def demux_summary(reports: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Per library: pairs in, assigned and not, the rate, samples, samples without reads, and lanes (rows of ``reports``)."""
    lanes = reports.groupBy("library").agg(F.count(F.lit(1)).alias("n_lanes"))
    n = barcodes.select("library", "sample").distinct().groupBy("library").agg(F.count(F.lit(1)).alias("n_samples"))
    got = demux_totals(reports, barcodes).join(lanes, "library").join(n, "library", "left")
    return got.select("library", F.col("pairs").alias("input_pairs"), F.col("assigned").alias("assigned_pairs"), (F.col("pairs") - F.col("assigned")).alias("unassigned_pairs"), (F.col("assigned") / F.nullif(F.col("pairs"), F.lit(0))).alias("assignment_rate"), "n_samples", F.col("without_reads").alias("samples_zero_pairs"), "n_lanes")


def unknown_adapters(reports: DataFrame, barcodes: DataFrame) -> DataFrame:
    """Adapters of the reports that the barcode table does not name."""
    return reports.select("library", F.inline("adapters")).select("library", F.col("name").alias("sample")).distinct().join(barcodes.select("library", "sample"), ["library", "sample"], "left_anti")


def merge_lanes(lanes: dict[str, DataFrame], by: Sequence[str]) -> DataFrame:
    """Reads of all lanes as one table with a ``lane`` column; lanes that hold the same group are told by :func:`lane_totals`."""
    whole = None
    for name, rows in sorted(lanes.items()):
        part = rows.withColumn("lane", F.lit(name))
        whole = part if whole is None else whole.unionByName(part)
    if whole is None:
        raise ValueError("no lanes")
    return whole.select(*by, "lane", *[c for c in whole.columns if c not in (*by, "lane")])


def lane_totals(merged: DataFrame, by: Sequence[str]) -> DataFrame:
    """Reads and lanes of each group, lanes in order."""
    return merged.groupBy(*by).agg(F.count(F.lit(1)).alias("reads"), F.array_join(F.array_sort(F.collect_set("lane")), ",").alias("lanes"))
