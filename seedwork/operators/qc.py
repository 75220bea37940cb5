"""Quality control of samples and lines: coverage, relatedness, donor content, marker floors, decisions."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seedwork.functions.stats import uniform
from seedwork.operators.labels import GuardError
from seedwork.session import sized


def min_coverage(samples: DataFrame, metrics: DataFrame, floor: float = 0.05) -> DataFrame:
    """Per sample: pass if its mean coverage reaches the floor; the first reason that holds otherwise. ``metrics``: sample, mean_coverage."""
    held = samples.select("sample").distinct().join(metrics.select("sample", "mean_coverage", F.lit(True).alias("__there")), "sample", "left")
    reason = F.when(F.col("__there").isNull(), "no_metrics").when(F.col("mean_coverage").isNull(), "no_mean_coverage").when(F.col("mean_coverage") < floor, "below_min_coverage").otherwise(".")
    return held.select("sample", "mean_coverage", (reason == ".").alias("pass"), reason.alias("reason"))


def coverage_dense(panel: DataFrame, counts: DataFrame, samples: DataFrame, floor: int = 1000, report: Sequence[int] = (10, 100)) -> DataFrame:
    """Every sample x contig of the panel: sites, covered sites, reads, mean depth over all sites, and flags below each threshold.

    ``panel``: contig, pos. ``counts``: sample, contig, pos, reads. The scaffold has one row per sample and contig (contigs are few).
    """
    sites = panel.select("contig", "pos").distinct().groupBy("contig").agg(F.count(F.lit(1)).alias("sites"))
    got = counts.join(panel.select("contig", "pos").distinct(), ["contig", "pos"], "left_semi").where(F.col("reads") > 0).groupBy("sample", "contig").agg(F.count(F.lit(1)).alias("covered"), F.sum("reads").alias("reads"))
    seen = counts.select("sample").distinct().withColumn("counted", F.lit(True))
    grid = samples.select("sample").distinct().crossJoin(sized(sites))
    out = grid.join(got, ["sample", "contig"], "left").join(seen, "sample", "left").fillna(0, ["covered", "reads"]).fillna(False, ["counted"])
    out = out.withColumn("fraction", F.col("covered") / F.col("sites")).withColumn("mean_depth", F.col("reads") / F.col("sites")).withColumn("below_min_markers", F.col("covered") < floor)
    return out.withColumns({f"below_{t}": F.col("covered") < t for t in report})


def donor_content(counts: DataFrame, expected: dict[str, float], min_sites: int = 20, low: float = 0.03, relative: float = 0.0, control: str = "control", control_high: float = 0.03, statistic: str = "alt_read_fraction") -> DataFrame:
    """Per sample: ALT sites and reads, shares, ratio to what its role should have and to the median of its (donor, role) group, flags in order.

    ``counts``: sample, role, donor, reads, alt, one row a site. Only samples with enough sites enter the median.
    """
    tot = counts.groupBy("sample", "role", "donor").agg(F.count_if(F.col("reads") > 0).alias("covered"), F.count_if(F.col("alt") > 0).alias("with_alt"), F.sum("reads").alias("reads"), F.sum("alt").alias("alt_reads"))
    share = F.col("with_alt") / F.when(F.col("covered") > 0, F.col("covered"))
    arf = F.col("alt_reads") / F.when(F.col("reads") > 0, F.col("reads"))
    held = tot.withColumn("share_sites_alt", share).withColumn("alt_read_fraction", arf).withColumn("stat", F.col(statistic))
    group = Window.partitionBy("donor", "role")
    held = held.withColumn("__m", F.median(F.when((F.col("covered") >= min_sites) & F.col("stat").isNotNull(), F.col("stat"))).over(group)).withColumn("rel_to_group", F.col("stat") / F.when(F.col("__m") != 0, F.col("__m"))).drop("__m")
    want = F.coalesce(F.try_element_at(F.create_map(*[F.lit(v) for kv in expected.items() for v in kv]), F.col("role")), F.lit(0.0)) if expected else F.lit(0.0)
    short = (F.col("covered") < min_sites) | F.col("stat").isNull()
    is_control = F.col("role") == control
    reasons = F.array_compact(F.array(
        F.when(short, "insufficient_sites"),
        F.when(~short & is_control & (F.col("stat") > control_high), "donor_alleles_in_control"),
        F.when(~short & ~is_control & (F.col("stat") < low), "low_donor_content"),
        F.when(~short & ~is_control & (F.col("rel_to_group") < relative), "low_relative_to_group"),
    ))
    held = held.withColumn("expected", want).withColumn("ratio_to_expected", F.col("alt_read_fraction") / F.when(F.col("expected") > 0, F.col("expected")))
    return held.withColumn("reasons", reasons).withColumn("flag", F.size(F.array_remove("reasons", "insufficient_sites")) > 0).drop("stat")


def site_values(counts: DataFrame, lines: Column | None = None, seed: int = 1) -> DataFrame:
    """Adds ``v``: the ALT share of a sample at a site; for ``lines`` one drawn read instead, by a hash of (seed, site, sample), so that
    order and partitions do not matter. ``counts``: sample, contig, pos, reads, alt."""
    frac = F.col("alt") / F.col("reads")
    rows = counts.where(F.col("reads") > 0)
    if lines is None:
        return rows.withColumn("v", frac)
    draw = uniform(F.lit(str(seed)), F.col("contig"), F.col("pos").cast("string"), F.col("sample").cast("string"))
    return rows.withColumn("v", F.when(lines, (draw < frac).cast("double")).otherwise(frac))


def centred(values: DataFrame) -> DataFrame:
    """Informative sites only: z = v - p and w = p (1 - p), p being the site's mean over observed samples."""
    here = Window.partitionBy("contig", "pos")
    held = values.withColumn("p", F.avg("v").over(here)).where((F.col("p") > 0) & (F.col("p") < 1))
    return held.withColumn("z", F.col("v") - F.col("p")).withColumn("w", F.col("p") * (1 - F.col("p")))


def group_kinship(values: DataFrame) -> DataFrame:
    """Kinship of each sample to each donor group, itself left out: sum z * mean(z of the group's others) / sum w over co-observed sites.

    Group sums per (site, donor) are joined back to the samples of the site: no join of samples with samples.
    """
    rows = centred(values).select("sample", "contig", "pos", "donor", "z", "w")
    sums = rows.where(F.col("donor").isNotNull()).groupBy("contig", "pos", F.col("donor").alias("group")).agg(F.sum("z").alias("s"), F.count(F.lit(1)).alias("c"))
    met = rows.join(sums, ["contig", "pos"])
    own = F.coalesce(F.col("donor") == F.col("group"), F.lit(False))
    c = F.col("c") - own.cast("long")
    m = (F.col("s") - F.when(own, F.col("z")).otherwise(0.0)) / F.when(c > 0, c)
    return met.withColumn("m", m).where(F.col("m").isNotNull()).groupBy("sample", "donor", "group").agg((F.sum(F.col("z") * F.col("m")) / F.sum("w")).alias("kinship"), F.count(F.lit(1)).alias("n_sites"))


def self_kinship(values: DataFrame) -> DataFrame:
    """Kinship of each sample to itself, sum z^2 / sum w over its informative sites, and their number."""
    return centred(values).groupBy("sample").agg((F.sum(F.col("z") * F.col("z")) / F.nullif(F.sum("w"), F.lit(0.0))).alias("kinship_self"), F.count(F.lit(1)).alias("n_sites"))


def robust_z(df: DataFrame, by: Sequence[str], value: str, out: str = "robust_z", least: int = 1) -> DataFrame:
    """(value - median) / (1.4826 * MAD) within groups of at least ``least`` values; null if the MAD is 0."""
    group = Window.partitionBy(*by)
    held = df.withColumn("__m", F.median(value).over(group)).withColumn("__n", F.count(value).over(group)).withColumn("__d", F.abs(F.col(value) - F.col("__m"))).withColumn("__mad", F.median("__d").over(group))
    z = (F.col(value) - F.col("__m")) / (1.4826 * F.when(F.col("__mad") > 0, F.col("__mad")))
    return held.withColumn(out, F.when(F.col("__n") >= least, z)).drop("__m", "__n", "__d", "__mad")


def kinship_flags(kin: DataFrame, samples: DataFrame, flag_sd: float = 3.0, margin: float = 0.0, min_sites: int = 20, min_group: int = 4) -> DataFrame:
    """Per sample: own and closest other kinship (ties to the larger name), robust z within (donor, role), reasons and flag.

    ``samples``: sample, donor, role. Samples without donor get kinships and no flag.
    """
    own = kin.where(F.col("donor") == F.col("group")).select("sample", F.col("kinship").alias("kinship_own"), F.col("n_sites").alias("n_sites_own"))
    best = kin.where(F.col("donor").isNull() | (F.col("donor") != F.col("group"))).groupBy("sample").agg(F.max(F.struct("kinship", "group")).alias("b"))
    held = samples.join(own, "sample", "left").join(best, "sample", "left").fillna(0, ["n_sites_own"])
    usable = F.col("kinship_own").isNotNull() & (F.col("n_sites_own") >= min_sites) & F.col("donor").isNotNull()
    held = robust_z(held.withColumn("__v", F.when(usable, F.col("kinship_own"))), ["donor", "role"], "__v", "own_z", min_group).drop("__v")
    has = F.col("donor").isNotNull()
    reasons = F.array_compact(F.array(
        F.when(has & ~usable, "insufficient_sites"),
        F.when(has & usable & (F.col("own_z") < -flag_sd), "low_kinship_own_donor"),
        F.when(has & usable & (F.col("b.kinship") > F.col("kinship_own") + margin), "closer_to_other_donor"),
    ))
    held = held.withColumn("reasons", reasons)
    return held.select(*samples.columns, "kinship_own", "n_sites_own", "own_z", F.col("b.group").alias("closest_other"), F.col("b.kinship").alias("kinship_other"), "reasons", (F.size(F.array_remove("reasons", "insufficient_sites")) > 0).alias("flag"))


def kept_markers(counts: DataFrame, markers: DataFrame, drop_invariant: bool = True) -> DataFrame:
    """(contig, pos) of the markers that have a count row, with ``drop_invariant`` those with ALT reads in some line only."""
    here = counts.join(markers.select("contig", "pos").distinct(), ["contig", "pos"], "left_semi").groupBy("contig", "pos").agg(F.max("alt").alias("top"))
    return (here.where(F.col("top") > 0) if drop_invariant else here).select("contig", "pos")


def span_share(lengths: DataFrame, chrom: str, start: int = 1, end: int | None = None) -> float:
    """The share of its chromosome that a region covers, by an index (chrom, length); the end is clipped to the chromosome."""
    if start < 1 or end is not None and end < start:
        raise GuardError(f"bad region {chrom}:{start}-{end}")
    row = lengths.where(F.col("chrom") == chrom).select(F.max("length")).first()[0]
    if row is None:
        raise GuardError(f"chromosome {chrom} is not in the index")
    return (min(end or row, row) - start + 1) / row


def line_marker_qc(counts: DataFrame, markers: DataFrame, lines: DataFrame, rigidity: int, reference_markers: int, span_share: float = 1.0, factor: float = 2.0, drop_invariant: bool = True) -> DataFrame:
    """Per line x contig of the markers: kept markers, covered ones, reads, depth, the floor and whether contig and line pass, with the reason.

    ``counts``: line, contig, pos, ref, alt. A marker without any count row is never kept; with ``drop_invariant`` one without ALT reads
    in any line neither. Effective rigidity = max(1, round half even(rigidity * kept / (span_share * reference_markers))), or rigidity as
    given if ``reference_markers`` is 0; ``span_share`` comes from :func:`span_share`. Without any marker no line passes (contig ``.``).
    """
    wanted = markers.select("contig", "pos").distinct()
    kept = kept_markers(counts, markers, drop_invariant)
    n = kept.agg(F.count(F.lit(1)).alias("n")).scalar()
    effective = F.greatest(F.lit(1), F.bround(F.lit(float(rigidity)) * n / (span_share * reference_markers)).cast("long")) if reference_markers else F.lit(rigidity).cast("long")
    kc = kept.groupBy("contig").agg(F.count(F.lit(1)).alias("markers_kept"))
    per = wanted.groupBy("contig").agg(F.count(F.lit(1)).alias("markers")).join(kc, "contig", "left").fillna(0, ["markers_kept"])
    none = counts.sparkSession.range(1).where(wanted.agg(F.count(F.lit(1))).scalar() == 0).select(F.lit(".").alias("contig"), F.lit(0).cast("long").alias("markers"), F.lit(0).cast("long").alias("markers_kept"))
    cov = counts.join(kept, ["contig", "pos"], "left_semi").where(F.col("ref") + F.col("alt") > 0).groupBy("line", "contig").agg(F.count(F.lit(1)).alias("covered"), F.sum(F.col("ref") + F.col("alt")).alias("reads"))
    grid = lines.select("line").distinct().crossJoin(sized(per.unionByName(none)))
    out = grid.join(cov, ["line", "contig"], "left").fillna(0, ["covered", "reads"]).withColumn("rigidity", effective)
    out = out.withColumn("floor", F.greatest(F.ceil(factor * F.col("rigidity")), 2 * F.col("rigidity")))
    out = out.withColumn("contig_pass", (F.col("covered") >= F.col("floor")) & (F.col("markers") > 0)).withColumn("mean_depth", F.col("reads") / F.when(F.col("covered") > 0, F.col("covered")))
    reason = F.when(F.col("markers") == 0, "no_markers").when(~F.col("contig_pass"), "below_marker_floor").otherwise(".")
    return out.withColumn("reason", reason).withColumn("line_pass", F.bool_and("contig_pass").over(Window.partitionBy("line")))


def line_observations(counts: DataFrame, markers: DataFrame, line_qc: DataFrame, drop_invariant: bool = True) -> DataFrame:
    """Counts of passing lines at kept markers, without empty ones: (line, contig, pos, ref, alt), what ancestry inference starts from."""
    good = line_qc.where("line_pass").select("line").distinct()
    held = counts.where(F.col("ref") + F.col("alt") > 0).join(kept_markers(counts, markers, drop_invariant), ["contig", "pos"], "left_semi")
    return held.join(sized(good), "line", "left_semi").select("line", "contig", "pos", "ref", "alt")


def sample_decision(samples: DataFrame, coverage: DataFrame, tables: dict[str, DataFrame | None], fail_on: Sequence[str] = ("relatedness", "donor_content")) -> DataFrame:
    """Decision per sample. ``coverage``: sample, pass, reason. Each of ``tables`` (null = not run): sample, flag, reason.

    A coverage failure always fails; a table's flags fail only if it is named in ``fail_on``, else they are notes. A sample that a table lacks is
    flagged ``not_in_table``. state is run, partial or not_run by how many tables there are.
    """
    held = samples.join(coverage.select("sample", F.col("pass").alias("__cp"), F.col("reason").alias("__cr")), "sample", "left")
    reasons: list[Column] = [F.when(F.col("__cp").isNull(), "not_in_min_coverage").when(~F.col("__cp"), F.col("__cr"))]
    notes: list[Column] = []
    given = 0
    for name, rows in tables.items():
        if rows is None:
            continue
        given += 1
        held = held.join(rows.select("sample", F.col("flag").alias(f"__f_{name}"), F.col("reason").alias(f"__r_{name}")), "sample", "left")
        why = F.when(F.col(f"__f_{name}").isNull(), f"{name}:not_in_table").when(F.col(f"__f_{name}"), F.concat(F.lit(f"{name}:"), F.col(f"__r_{name}")))
        (reasons if name in fail_on else notes).append(why)
    state = "run" if given == len(tables) else "partial" if given else "not_run"
    text = lambda xs: F.array_compact(F.array(*xs)) if xs else F.array().cast("array<string>")
    out = held.withColumn("reasons", text(reasons)).withColumn("notes", text(notes))
    return out.select(*samples.columns, (F.size("reasons") == 0).alias("pass"), "reasons", "notes", F.lit(state).alias("state"))


def exclusions(decisions: DataFrame, line_qc: DataFrame) -> DataFrame:
    """Samples out, by stage: failed decisions with their reasons, failed lines with their distinct contig reasons (``line_qc`` if none is given)."""
    a = decisions.where(~F.col("pass")).select("sample", F.lit("sample_qc").alias("stage"), F.array_join("reasons", ",").alias("reason"))
    why = F.array_join(F.array_sort(F.collect_set(F.when(~F.col("contig_pass"), F.col("reason")))), ",")
    b = line_qc.groupBy(F.col("line").alias("sample")).agg(F.bool_and("line_pass").alias("ok"), why.alias("r")).where(~F.col("ok")).select("sample", F.lit("line_qc").alias("stage"), F.when(F.col("r") == "", "line_qc").otherwise(F.col("r")).alias("reason"))
    return a.unionByName(b)


def role_groups(samples: DataFrame, regions: DataFrame, excluded: DataFrame) -> DataFrame:
    """Samples of each donor, role and region in order; excluded ones never return and an empty group vanishes."""
    kept = samples.join(excluded.select("sample").distinct(), "sample", "left_anti")
    return kept.groupBy("donor", "role").agg(F.array_sort(F.collect_list("sample")).alias("samples")).crossJoin(sized(regions))


def duplicates(df: DataFrame, key: Sequence[str], order: str, policy: str = "last") -> DataFrame:
    """One row per key: the ``first`` or ``last`` by ``order``. An aggregate, so repeats collapse before the shuffle."""
    rest = [c for c in df.columns if c not in key]
    pick = F.max_by if policy == "last" else F.min_by
    return df.groupBy(*key).agg(pick(F.struct(*rest), F.col(order)).alias("__r")).select(*key, "__r.*")

