"""Labels, identity chains, guards and manifests."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


class GuardError(ValueError):
    """A constraint does not hold; the message shows the first rows that break it."""


def enforce(violations: DataFrame, what: str, show: int = 5) -> None:
    """Raise if there is any row; only ``show`` rows come to the driver."""
    rows = violations.limit(show).collect()
    if rows:
        raise GuardError(f"{what}: " + "; ".join(str(r.asDict()) for r in rows))


def resolve_labels(samples: DataFrame, registry: DataFrame, donor: str | None = None) -> DataFrame:
    """Label of each sample: resolved id, else pedigree, else its own id; a label shared by several gets every member's id appended.

    Guards: no excluded sample, no other donor than the unit's, no tab or line end in a label, labels unique at the end.
    """
    reg = registry.select("sample", "nil_id", "pedigree", "donor", "exclude", F.lit(True).alias("__in"))
    held = samples.select("sample").distinct().join(reg, "sample", "left")
    some = lambda c: F.when(F.col(c) != "", F.col(c))
    base = F.coalesce(some("nil_id"), some("pedigree"), F.col("sample"))
    source = F.when(F.col("__in").isNull(), "sample_id_not_in_registry").when(some("nil_id").isNotNull(), "nil_id").when(some("pedigree").isNotNull(), "pedigree").otherwise("sample_id_no_label")
    held = held.withColumn("base", base).withColumn("label_source", source)
    enforce(held.where(F.upper("exclude") == "TRUE").select("sample"), "excluded in the registry")
    if donor:
        enforce(held.where((F.col("donor") != "") & (F.col("donor") != donor)).select("sample", "donor"), "donor differs")
    enforce(held.where(F.col("base").rlike(r"[\t\r\n]")).select("sample"), "label with tab or line end")
    out = label_collisions(held, "base", "sample")
    enforce(out.groupBy("label").count().where(F.col("count") > 1), "labels still not unique")
    return out


def label_collisions(df: DataFrame, base: str, sample: str) -> DataFrame:
    """Adds ``label`` (suffixed where shared) and ``collision`` (how many share it). A count window, so a shared label gathers no list."""
    n = F.count(F.lit(1)).over(Window.partitionBy(base))
    return df.withColumn("collision", n).withColumn("label", F.when(F.col("collision") > 1, F.concat_ws("_", F.col(base), F.col(sample))).otherwise(F.col(base)))


def relabel(df: DataFrame, labels: DataFrame, column: str, keep_id: bool = False) -> DataFrame:
    """``column`` replaced by its label; with ``keep_id`` the old value stays in ``<column>_id``."""
    names = labels.select(F.col("sample").alias("__s"), F.col("label").alias("__l"))
    joined = df.join(names, F.col(column) == F.col("__s"), "left")
    cols: list[Column] = []
    for c in df.columns:
        if c == column:
            cols.append(F.coalesce("__l", F.col(column)).alias(column))
            if keep_id:
                cols.append(F.col(column).alias(f"{column}_id"))
        else:
            cols.append(F.col(c))
    return joined.select(*cols)


#: Line pedigree: taxon and accession number, three generations named by any letter, three selfings or more. A fixed pattern.
PEDIGREE = r"\A(Z[vxldh])\.([0-9]+)_[A-Za-z]([0-9]+)_[A-Za-z]([0-9]+)_[A-Za-z]([0-9]+)\.([0-9]+)((?:\.[0-9]+){2,})\z"


def canonical_pedigree(pedigree: Column) -> Column:
    """Pedigree without the marks of bulks (``.B``, ``-blk``, ``-bulk``) and outer blanks; null as an empty text."""
    return F.trim(F.regexp_replace(F.regexp_replace(F.trim(F.coalesce(pedigree, F.lit(""))), r"\.B\z", ""), r"(?i)-(blk|bulk)\z", ""))


def pedigree_parts(pedigree: Column) -> Column:
    """accession, donor and short id of a line pedigree; nulls where the text has none.

    The accession has four digits; the donor is the accession with the number of its first plant, named by ``P``. The id, taxon and number and the
    three plants and first selfing in base 36, exists where the pedigree is complete, later selfings are 1 and those four numbers are 1 to 35.
    """
    text = canonical_pedigree(pedigree)
    part = lambda i: F.regexp_extract(text, PEDIGREE, i)
    some = lambda x: F.nullif(x, F.lit(""))
    plants = [part(i).try_cast("int") for i in (3, 4, 5, 6)]
    fits = text.rlike(PEDIGREE) & part(7).rlike(r"\A(\.0*1)+\z")
    for n in plants:
        fits = fits & F.coalesce(n.between(1, 35), F.lit(False))
    code = F.concat(part(1), F.lpad(part(2).try_cast("bigint").cast("string"), F.greatest(F.lit(4), F.length(part(2).try_cast("bigint").cast("string"))), F.lit("0")), *[F.upper(F.conv(n.cast("string"), 10, 36)) for n in plants])
    return F.struct(some(F.regexp_extract(pedigree, r"\A(Z[a-z]\.[0-9]{4})(_|\z)", 1)).alias("accession"), some(F.regexp_extract(pedigree, r"\A(Z[a-z]\.[0-9]+_P[0-9]+)_", 1)).alias("donor"), F.when(F.coalesce(fits, F.lit(False)), code).alias("code"))


def third_selfing(pedigree: Column) -> Column:
    """The pedigree of a line's third selfing; null where the text is no line pedigree."""
    text = canonical_pedigree(pedigree)
    return F.when(text.rlike(PEDIGREE), F.regexp_extract(text, r"\A([^.]+\.[^.]+(?:\.[0-9]+){3})", 1))


def correct(rows: DataFrame, corrections: DataFrame, key: str, field: str) -> tuple[DataFrame, DataFrame]:
    """Corrections of one field, and what is wrong with them.

    ``corrections``: correction_id, key, field, applies_to, old_value, new_value. The rows come with ``<field>_resolved`` (the new value of the
    last correction by id that applies to resolved values, else the value itself) and ``correction_ids`` (all that name the row, joined by ``;``).
    The second table holds corrections whose old value is not the row's.
    """
    mine = corrections.where(F.col("field") == field)
    here = (F.col("field") == field) & (F.col("applies_to") == "resolved")
    per = corrections.groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("correction_id")), ";").alias("correction_ids"), F.max(F.when(here, F.struct("correction_id", "new_value"))).alias("__new"))
    out = rows.join(per, key, "left").withColumn("correction_ids", F.coalesce("correction_ids", F.lit(""))).withColumn(f"{field}_resolved", F.when(F.col("__new").isNotNull(), F.col("__new.new_value")).otherwise(F.col(field))).drop("__new")
    odd = rows.select(key, F.col(field).alias("value")).join(mine.where(F.col("applies_to") == "resolved"), key).where(~F.col("value").eqNullSafe(F.col("old_value")))
    return out, odd.select("correction_id", key, "old_value", "value")


def disagreements(df: DataFrame, by: str, columns: Sequence[str]) -> DataFrame:
    """(by, column, n_values) of groups whose rows disagree on a column that must be one value, null being a value."""
    value = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit(""))
    got = df.groupBy(by).agg(*[F.count_distinct(value(c)).alias(c) for c in columns])
    return got.select(by, F.inline(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("n_values")) for c in columns]))).where(F.col("n_values") > 1)


def chain(rows: DataFrame, first: DataFrame, second: DataFrame, key1: str, key2: str, value: str) -> DataFrame:
    """Value by the first key if it gives exactly one, else by the second key if that does, else null with the reason."""
    one = first.groupBy(key1).agg(F.count_distinct(value).alias("__n1"), F.max(value).alias("__v1"))
    two = second.groupBy(key2).agg(F.count_distinct(value).alias("__n2"), F.max(value).alias("__v2"))
    held = rows.join(one, key1, "left").join(two, key2, "left")
    got = F.when(F.col("__n1") == 1, F.col("__v1")).when(F.col("__n2") == 1, F.col("__v2"))
    how = F.when(F.col("__n1") == 1, "first").when(F.col("__n2") == 1, "second").when(F.coalesce("__n1", F.lit(0)) > 1, "ambiguous").otherwise("none")
    return held.withColumn(value, got).withColumn("found_by", how).drop("__n1", "__v1", "__n2", "__v2")


def duplicate_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def missing_keys(df: DataFrame, parents: DataFrame, key: str, parent: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).join(parents.select(F.col(parent).alias("__p")), F.col(key) == F.col("__p"), "left_anti").select(key).distinct()


def inconsistent(df: DataFrame, key: Sequence[str], column: str) -> DataFrame:
    """Keys whose rows disagree on a column that must be one value per key."""
    return df.groupBy(*key).agg(F.count_distinct(column).alias("n_values")).where(F.col("n_values") > 1)


def settings_diff(stored: DataFrame, current: DataFrame) -> DataFrame:
    """Settings (name, value) that differ: the name and both values. Nothing means results may be added to the store."""
    a = stored.select("name", F.col("value").alias("stored"))
    b = current.select("name", F.col("value").alias("current"))
    return a.join(b, "name", "full").where(~F.col("stored").eqNullSafe(F.col("current")))


def settings_guard(stored: DataFrame, current: DataFrame) -> None:
    enforce(settings_diff(stored, current), "settings differ from those of the stored results")


def join_or_refuse(left: DataFrame, right: DataFrame, key: Sequence[str]) -> DataFrame:
    """Inner join that refuses keys found on one side only."""
    odd = left.select(*key).distinct().withColumn("__a", F.lit(1)).join(right.select(*key).distinct().withColumn("__b", F.lit(1)), list(key), "full").where(F.col("__a").isNull() | F.col("__b").isNull())
    enforce(odd.select(*key), "keys without a partner")
    return left.join(right, list(key))


def longest_prefix(names: DataFrame, entities: DataFrame, name: str = "name", entity: str = "entity") -> DataFrame:
    """Each name with the longest entity it starts with. Prefixes of the name are exploded, so the join is an equality."""
    cut = names.select(name, F.explode(F.transform(F.sequence(F.lit(1), F.length(name)), lambda n: F.substring(F.col(name), F.lit(1), n))).alias("__p"))
    return cut.join(entities.select(F.col(entity).alias("__p")).distinct(), "__p").groupBy(name).agg(F.max_by("__p", F.length("__p")).alias(entity))


def stale_steps(step1: DataFrame, step2: DataFrame, key: str = "key") -> DataFrame:
    """Step-2 rows at sites that step 1 has already called: the two tables come from different runs."""
    return step2.select(key).join(step1.where(F.col("state").isNotNull()).select(key), key, "left_semi")


def precision_disagrees(joint: DataFrame, prior: float = 0.5, most: float = 0.006) -> DataFrame:
    """Rows whose printed likelihood ratio differs from log-odds less the prior's by more than its rounding can explain."""
    exact = F.col("log_odds") - F.log(F.lit(prior / (1 - prior)))
    return joint.where(F.abs(exact - F.col("llr")) > most)


def role_conflicts(samples: DataFrame) -> DataFrame:
    """Donors that appear in more than one role."""
    return inconsistent(samples.where(F.col("donor").isNotNull()), ["donor"], "role")


def column_set_differs(got: DataFrame, expected: DataFrame, column: str) -> DataFrame:
    """Ids on one side only, with the side."""
    a, b = got.select(column).distinct(), expected.select(column).distinct()
    return a.join(b, column, "left_anti").withColumn("side", F.lit("unexpected")).unionByName(b.join(a, column, "left_anti").withColumn("side", F.lit("missing")))


def versions(rows: DataFrame) -> DataFrame:
    """Different versions of each process, sorted and joined."""
    return rows.groupBy("process").agg(F.array_join(F.array_sort(F.collect_set("version")), ", ").alias("versions"))


def platform_unit(names: Column) -> Column:
    """``flowcell.lane`` units of lane file names (``<flowcell>_..._L00n_...``), different ones in order, joined by commas."""
    found = F.regexp_extract_all(names, F.lit(r"([A-Z0-9]+)_[^;,\s]*?_L00([1-9])_"), F.lit(0))
    parts = F.transform(found, lambda t: F.concat_ws(".", F.regexp_extract(t, r"\A([A-Z0-9]+)_", 1), F.regexp_extract(t, r"_L00([1-9])_\z", 1)))
    return F.array_join(F.array_sort(F.array_distinct(parts)), ",")


def read_structure(text: Column) -> Column:
    """barcode and skip lengths of ``[nB][mS]+T``; nulls where the text does not follow it."""
    pattern = r"\A(?:([0-9]+)B)?(?:([0-9]+)S)?\+T\z"
    ok = text.rlike(pattern)
    number = lambda i: F.when(ok, F.coalesce(F.nullif(F.regexp_extract(text, pattern, i), F.lit("")), F.lit("0")).try_cast("int"))
    return F.struct(number(1).alias("barcode"), number(2).alias("skip"))


def label_counts(labels: DataFrame) -> DataFrame:
    """Samples by source of their label, and how many of them share their label with others."""
    return labels.groupBy("label_source").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("collision") > 1).alias("n_collisions"))


def relabel_tables(tables: dict[str, tuple[DataFrame, str, bool]], labels: DataFrame) -> dict[str, DataFrame]:
    """Several tables with one table of labels: name -> (table, column with sample ids, whether the id stays beside the label)."""
    return {name: relabel(df, labels, column, keep) for name, (df, column, keep) in tables.items()}


def relabel_columns(df: DataFrame, labels: DataFrame, fixed: Sequence[str], most: int = 10_000) -> DataFrame:
    """A wide table whose other columns are named by samples, with labels as names. Column names live on the driver, so at most ``most`` are looked up."""
    names = [c for c in df.columns if c not in fixed]
    if len(names) > most:
        raise GuardError(f"more than {most} columns")
    found = {r["sample"]: r["label"] for r in labels.where(F.col("sample").isin(*names)).select("sample", "label").collect()} if names else {}
    return df.select(*fixed, *[F.col(f"`{c}`").alias(found.get(c, c)) for c in names])


def run_and_reference(samples: DataFrame, references: DataFrame) -> DataFrame:
    """Donors that are run donors and reference donors at once."""
    return samples.select("donor").where(F.col("donor").isNotNull()).distinct().join(references.select("donor"), "donor", "left_semi")


#: Domains of options: allowed values, or the least and greatest number. Fixed values.
DOMAINS: dict[str, tuple] = {
    "role": ("bc1_sample", "line", "witness", "b73_control"), "prior_source": ("other_donors", "mu_only", "fixed"), "prior_scope": ("all", "same_taxon"), "provenance_check": ("strict", "warn"),
    "eps0": (0.0, 1.0), "prior": (0.0, 1.0), "half_p": (0.0, 1.0), "posterior": (0.5, 1.0), "plants": (1, 10_000), "min_alt_reads": (0, 1 << 31), "rigidity": (1, 1 << 31), "min_sites": (0, 1 << 31),
}


def check_options(options: dict[str, object], domains: dict[str, tuple] | None = None, required: Sequence[str] = ()) -> None:
    """Refuse unknown options, missing ones and values outside their domain; all problems are told at once."""
    domains = DOMAINS if domains is None else domains
    bad = [f"{name} is required" for name in required if options.get(name) is None]
    for name, value in options.items():
        if name not in domains:
            bad.append(f"{name} is not an option")
        elif value is not None:
            allowed = domains[name]
            numbers = len(allowed) == 2 and all(isinstance(x, (int, float)) for x in allowed)
            fine = isinstance(value, (int, float)) and not isinstance(value, bool) and allowed[0] <= value <= allowed[1] if numbers else value in allowed
            if not fine:
                bad.append(f"{name} is {value!r}, not {'between ' + ' and '.join(map(str, allowed)) if numbers else 'one of ' + ', '.join(map(str, allowed))}")
    if bad:
        raise GuardError("; ".join(bad))


def bad_regions(regions: DataFrame, ranges: DataFrame, lengths: DataFrame) -> DataFrame:
    """Regions (chrom, start, end) with a reason: no range on the chromosome, chromosome not in the index, start or end outside it."""
    have = ranges.select("chrom").distinct().withColumn("__range", F.lit(True))
    size = lengths.groupBy("chrom").agg(F.max("length").alias("__length"))
    held = regions.join(have, "chrom", "left").join(size, "chrom", "left")
    reason = (
        F.when(F.col("__range").isNull(), "no_range").when(F.col("__length").isNull(), "not_in_index").when((F.col("start") < 1) | (F.col("end") < F.col("start")), "bad_region")
        .when(F.col("end") > F.col("__length"), "past_the_end")
    )
    return held.withColumn("reason", reason).where(F.col("reason").isNotNull()).select("chrom", "start", "end", "reason")


def provenance_problems(records: DataFrame, samples: DataFrame, expected: str) -> DataFrame:
    """(sample, problem) of samples whose record (sample, written_for, markdup) is missing or does not match the current settings."""
    held = samples.select("sample").distinct().join(records.withColumn("__there", F.lit(True)), "sample", "left")
    problems = F.array_compact(F.array(
        F.when(F.col("__there").isNull(), "no record"), F.when(F.col("__there") & ~F.col("markdup").eqNullSafe(F.lit(expected)), "markdup"),
        F.when(F.col("written_for").isNotNull() & (F.col("written_for") != F.col("sample")), "sample"),
    ))
    return held.select("sample", F.explode(problems).alias("problem"))


def check_provenance(records: DataFrame, samples: DataFrame, expected: str, mode: str = "strict") -> DataFrame:
    """Refuse mismatching records, or with ``warn`` return them."""
    check_options({"provenance_check": mode})
    found = provenance_problems(records, samples, expected)
    if mode == "strict":
        enforce(found, "provenance does not match the current settings")
    return found


def oversized_groups(df: DataFrame, by: Sequence[str], most: int) -> DataFrame:
    """Groups, such as libraries, of more than ``most`` rows."""
    return df.groupBy(*by).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > most)


def clashing_names(samples: DataFrame, reserved: Sequence[str], column: str = "sample") -> DataFrame:
    """Ids that would collide in an output folder: reserved names, ids with a path separator or a leading dot, and ids equal but for case."""
    low = F.lower(F.col(column))
    n = F.count_distinct(F.col(column))
    same = samples.where(F.col(column).isNotNull()).groupBy(low.alias("__low")).agg(n.alias("__n"), F.array_sort(F.collect_set(column)).alias("__ids")).where(F.col("__n") > 1)
    why = F.when(low.isin(*[r.lower() for r in reserved]), "reserved").when(F.col(column).rlike(r"[/\\\\]|\A\."), "no_file_name")
    one = samples.select(column).distinct().withColumn("problem", why).where(F.col("problem").isNotNull())
    return one.unionByName(same.select(F.explode("__ids").alias(column), F.lit("differs_by_case").alias("problem")))


#: Entries and the parameters each needs. Fixed values.
ENTRIES = {"cram": ("input", "outdir", "fasta"), "genotype": ("input", "outdir", "fasta", "regions", "lowcopy_bed")}


def check_entry(entry: str, parameters: dict[str, object]) -> None:
    """Refuse an unknown entry, and an entry without the parameters it needs."""
    if entry not in ENTRIES:
        raise GuardError(f"entry is {entry!r}, not one of {', '.join(ENTRIES)}")
    bare = sorted(p for p, v in parameters.items() if p in ENTRIES[entry] and str(v).lower() == "true")
    if bare:
        raise GuardError(f"{', '.join(bare)} given without a value")
    missing = [p for p in ENTRIES[entry] if parameters.get(p) in (None, "")]
    if missing:
        raise GuardError(f"entry {entry} needs {', '.join(missing)}")


def check_upstream(present: DataFrame, needed: DataFrame, stages: Sequence[str]) -> None:
    """Refuse to start while inputs are missing, naming the earliest of ``stages`` that makes one. ``present``: path; ``needed``: path, stage."""
    missing = needed.join(present.select("path").distinct(), "path", "left_anti")
    per = {r["stage"]: (r["n"], r["one"]) for r in missing.groupBy("stage").agg(F.count(F.lit(1)).alias("n"), F.min("path").alias("one")).collect()}  # one row a stage
    if per:
        first = next((s for s in stages if s in per), sorted(map(str, per))[0])
        raise GuardError(f"{sum(n for n, _ in per.values())} inputs are missing, such as {per.get(first, next(iter(per.values())))[1]}: run {first} first")


def check_held(requested: Sequence[str], held: Sequence[str], most: int) -> None:
    """Refuse more libraries at once than the disk is meant to hold, those that hold a checkpoint already included."""
    every = set(requested) | set(held)
    if len(every) > most:
        raise GuardError(f"{len(every)} libraries are more than {most}; already held besides: {', '.join(sorted(set(held) - set(requested))) or 'none'}")


def check_output_root(path: str, production: str, subsample: int | None = None, stub: bool = False, stub_prefix: str = "stub") -> None:
    """Naming rules of output folders: a subsample of N goes to ``subsample_N`` and nothing else does; a stub run stays inside a folder with the stub prefix, outside production."""
    parts = [x for x in path.rstrip("/").split("/") if x]
    name = parts[-1] if parts else ""
    if subsample and name != f"subsample_{subsample}":
        raise GuardError(f"a subsample of {subsample} needs a folder named subsample_{subsample}, not {name!r}")
    if not subsample and re.fullmatch(r"subsample_[0-9]+", name):
        raise GuardError(f"{path} is the folder of a subsample")
    real = production.rstrip("/")
    if stub and (not any(x.startswith(stub_prefix) for x in parts) or path.rstrip("/") == real or path.startswith(real + "/")):
        raise GuardError(f"a stub run must stay inside a folder named {stub_prefix}* outside {production}")


def mask_rules(rows: DataFrame, by_sample: DataFrame, by_source: DataFrame) -> DataFrame:
    """Read-start masks of samples: the rule of the sample, else of its source; null, with ``mask_from`` none, where neither has one.

    ``by_sample``: sample, mask_r1, mask_r2, mask_source; ``by_source``: source and the same.
    """
    cols = ("mask_r1", "mask_r2", "mask_source")
    one = by_sample.dropDuplicates(["sample"]).select(F.col("sample"), F.struct(*cols).alias("__a"))
    two = by_source.dropDuplicates(["source"]).select(F.col("source"), F.struct(*cols).alias("__b"))
    held = rows.join(one, "sample", "left").join(two, "source", "left")
    rule = F.coalesce("__a", "__b")
    return held.select(*rows.columns, *[rule[c].alias(c) for c in cols], F.when(F.col("__a").isNotNull(), "sample").when(F.col("__b").isNotNull(), "source").otherwise("none").alias("mask_from"))


def sheet_errors(rows: DataFrame, roles: Sequence[str], control: str = "b73_control") -> DataFrame:
    """(sample, error) of a genotype sheet: ids that make no name, repeated ids, unknown roles, donors and taxa that a role needs, include flags, missing masks.

    ``rows``: sample, role, donor, taxon, include, mask_r1.
    """
    some = lambda c: F.coalesce(F.col(c).cast("string"), F.lit("")) != ""
    n = F.count(F.lit(1)).over(Window.partitionBy("sample"))
    problems = F.array_compact(F.array(
        F.when(~F.coalesce(F.col("sample").rlike(r"\A[A-Za-z0-9_-]+\z"), F.lit(False)), "sample_id"), F.when(F.col("__n") > 1, "duplicate"), F.when(~F.coalesce(F.col("role").isin(*roles), F.lit(False)), "role"),
        F.when((F.col("role") != control) & ~some("donor"), "no_donor"), F.when(some("donor") & ~some("taxon"), "no_taxon"),
        F.when(~F.upper(F.trim(F.coalesce("include", F.lit("")))).isin("TRUE", "FALSE"), "include"), F.when(F.col("mask_r1").isNull(), "no_mask"),
    ))
    return rows.withColumn("__n", n).select("sample", F.explode(problems).alias("error")).distinct()


def utc_stamp() -> Column:
    """The current time as ``YYYY-MM-DDTHH:MM:SSZ``, whatever the session's time zone."""
    return F.date_format(F.to_utc_timestamp(F.current_timestamp(), F.current_timezone()), "yyyy-MM-dd'T'HH:mm:ss'Z'")
