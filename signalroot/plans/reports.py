"""Summaries over delivered tables; every report is one aggregation pass."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..functions.scalars import ACROSS, BY_CORRELATION, BY_FILE, BY_SIGNAL, WITHIN
from ..operators.duplicates import unmatched


def some(list_text: Column | str) -> Column:
    return F.length(F.col(list_text) if isinstance(list_text, str) else list_text) > 0


def quality_summary(quality: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Records, clean records and records with each fault; null fingerprints count as repeats."""
    return quality.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n_records"), F.count_if("holds").alias("n_clean"), F.count_if(some("missing_leads")).alias("n_missing_lead"),
        F.count_if(some("flat_leads")).alias("n_flat_lead"), F.count_if(some("saturated_leads")).alias("n_saturated_lead"), F.count_if(F.col("n_nonfinite") > 0).alias("n_nonfinite"),
        F.count_distinct("signal_digest").alias("n_distinct_signal_digests"), (F.count(F.lit(1)) - F.count_distinct("signal_digest")).alias("n_repeats_within"),
        F.array_sort(F.collect_set("n_samples_read")).alias("window_samples"),
    )


def faults_by_lead(quality: DataFrame, column: str) -> DataFrame:
    return quality.filter(some(column)).select(F.explode(F.split(column, r"\|")).alias("lead")).groupBy("lead").agg(F.count(F.lit(1)).alias("n"))


def header_summary(headers: DataFrame, by: list[str] | None = None) -> DataFrame:
    lead = lambda test: F.sum(F.size(F.filter("leads", test))).cast("long")
    return headers.groupBy(*(by or [])).agg(
        F.count(F.lit(1)).alias("n_records"), F.sum(F.size("leads")).cast("long").alias("n_leads_rows"), F.array_sort(F.collect_set("n_leads")).alias("leads_per_record"),
        F.array_sort(F.collect_set("sampling_rate_hz")).alias("sampling_rates_hz"), F.slice(F.array_sort(F.collect_set("n_samples")), 1, 8).alias("sample_lengths"),
        F.count_if("units_are_declared").alias("n_units_declared"), F.count_if("all_millivolts").alias("n_all_millivolts"), F.count_if(F.size("dx") > 0).alias("n_with_dx"),
        lead(lambda x: x["name_canonical"].isNull()).alias("n_non_canonical_leads"),
    )


def unit_spellings(headers: DataFrame) -> DataFrame:
    """Records by each distinct spelling of a unit."""
    return headers.select(F.explode("units_declared").alias("unit")).groupBy("unit").agg(F.count(F.lit(1)).alias("n"))


def within_summary(digests: DataFrame, by: list[str]) -> DataFrame:
    """Repeats inside each source; records without a digest count as distinct tracings."""
    sizes = digests.filter("digest IS NOT NULL").groupBy(*by, "digest").agg(F.count(F.lit(1)).alias("n"))
    many = F.when(F.col("n") > 1, F.col("n"))
    inside = sizes.groupBy(*by).agg(
        F.coalesce(F.sum(F.expr("CAST(IF(n > 1, n * (n - 1) / 2, 0) AS BIGINT)")), F.lit(0)).alias("n_pairs"), F.count(many).alias("n_groups"),
        F.coalesce(F.sum(many), F.lit(0)).alias("n_in_groups"), F.coalesce(F.max(many), F.lit(0)).alias("largest"),
    )
    whole = digests.groupBy(*by).agg(F.count(F.lit(1)).alias("n_records")).join(inside, by, "left").na.fill(0)
    return whole.withColumn("n_distinct_tracings", F.col("n_records") - (F.col("n_in_groups") - F.col("n_groups")))


def screen_summary(links: DataFrame) -> DataFrame:
    sieve = lambda s: F.count_if(F.col("sieve") == s).alias(f"n_{s.replace('-', '_')}")
    return links.agg(F.count(F.lit(1)).alias("n_links"), *map(sieve, (BY_FILE, BY_SIGNAL, BY_CORRELATION)), F.count_if(F.col("scope") == WITHIN).alias("n_within"), F.count_if(F.col("scope") == ACROSS).alias("n_across"))


def shared_native_ids(left: DataFrame, right: DataFrame) -> DataFrame:
    """Names that records (record_id) of both sides have behind their source, sorted."""
    name = S.right_of("record_id", ":").alias("native_record_id")
    return left.select(name).intersect(right.select(name)).orderBy("native_record_id")


def database_report(tables: dict[str, DataFrame]) -> DataFrame:
    """(table, n): rows of every table that is there."""
    out = None
    for name, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("table"), "n")
        out = one if out is None else out.unionByName(one)
    return out


def group_summary(groups: DataFrame) -> DataFrame:
    return groups.agg(F.count_distinct("signal_group_id").alias("n_groups"), F.count_if(F.col("group_size") > 1).alias("n_records_in_groups"), F.max("group_size").alias("largest"))


def crossing_links(links: DataFrame, groups: DataFrame) -> DataFrame:
    """Links whose two ends are in different groups: none, if groups are safe to split by."""
    g = groups.select("record_id", "signal_group_id")
    a = links.join(g.select(F.col("record_id").alias("record_a"), F.col("signal_group_id").alias("group_a")), "record_a")
    return a.join(g.select(F.col("record_id").alias("record_b"), F.col("signal_group_id").alias("group_b")), "record_b").filter("group_a != group_b")


def hash_sample(df: DataFrame, key: str, n: int, seed: int) -> DataFrame:
    """n rows chosen by SHA-256 of seed and key: the same rows however the input is dealt, and in any engine."""
    return df.orderBy(F.sha2(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")), 256), key).limit(n)


def database_figures(tables: dict[str, DataFrame]) -> DataFrame:
    """One row of figures over delivered tables; links and groups by kind, files that no manifest lists."""
    links = tables["duplicate_link"].agg(F.count_if(F.col("scope") == WITHIN).alias("n_within"), F.count_if(F.col("scope") == ACROSS).alias("n_across"))
    files = tables["source_file"].agg(F.count_if(F.col("sha256_declared").isNull()).alias("n_files_without_a_declared_digest"))
    records = tables["record"].agg(F.count(F.lit(1)).alias("n_records"))
    return records.crossJoin(group_summary(tables["signal_group"])).crossJoin(links).crossJoin(files)  # single rows


def traced_example(traced: DataFrame, seed: int = 20260908) -> DataFrame:
    """One record with its source file, drawn by seed."""
    return hash_sample(traced, "record_id", 1, seed)


def _counted(df: DataFrame, section: str, key: Column | None, n: Column) -> DataFrame:
    """(section, key, n) by a key; of the whole, an empty table too, without one."""
    grouped = df.agg(n.cast("long").alias("n")).withColumn("key", F.lit("all")) if key is None else df.groupBy(key.cast("string").alias("key")).agg(n.cast("long").alias("n"))
    return grouped.select(F.lit(section).alias("section"), "key", "n")


def label_report(label: DataFrame, propagated: DataFrame, label_map: DataFrame, patient: DataFrame) -> DataFrame:
    """(section, key, n): rows of the label tables, by source where they have one; whole counts have the key `all`."""
    rows, everything = F.count(F.lit(1)), None
    parts = [
        _counted(label, "label rows", everything, rows), _counted(propagated, "propagated rows", everything, rows),
        _counted(propagated, "records given a label", everything, F.count_distinct("record_id")),
        _counted(propagated.filter("source_id IS NOT NULL"), "propagated by source", F.col("source_id"), rows),
        _counted(label_map, "map rows", everything, rows), _counted(label_map.filter("map_source IS NOT NULL"), "map rows by file", F.col("map_source"), rows),
        _counted(patient, "patients", everything, F.count_distinct("patient_id")), _counted(patient.filter("source_id IS NOT NULL"), "patients by source", F.col("source_id"), F.count_distinct("patient_id")),
    ]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out.orderBy("section", "key")


def screen_lists(left: DataFrame, right: DataFrame, links: DataFrame) -> DataFrame:
    """(list, source_id, name): records (record_id, source_id) of each side without a link, and names that both sides use."""
    rest = lambda df: unmatched(df, links).join(df.select("record_id", "source_id"), "record_id").select(F.lit("unmatched").alias("list"), "source_id", F.col("record_id").alias("name"))
    shared = shared_native_ids(left, right).select(F.lit("shared").alias("list"), F.lit(None).cast("string").alias("source_id"), F.col("native_record_id").alias("name"))
    return rest(left).unionByName(rest(right)).unionByName(shared)


def screen_report(left: DataFrame, right: DataFrame, links: DataFrame, note: str | None) -> DataFrame:
    """One row: records of both sides, links by sieve, and the sizes of `screen_lists`."""
    sides = left.select(F.lit("left").alias("side")).unionByName(right.select(F.lit("right").alias("side")))
    records = sides.agg(F.count_if(F.col("side") == "left").alias("n_left"), F.count_if(F.col("side") == "right").alias("n_right"))
    lists = screen_lists(left, right, links).agg(F.count_if(F.col("list") == "unmatched").alias("n_unmatched"), F.count_if(F.col("list") == "shared").alias("n_shared_native_ids"))
    return records.crossJoin(screen_summary(links)).crossJoin(lists).withColumn("note", F.lit(note))  # single rows
