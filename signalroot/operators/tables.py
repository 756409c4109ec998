"""Builders of the delivered tables from parsed headers."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import shaped


def source_files(headers: DataFrame, declared: DataFrame) -> DataFrame:
    """Header and signal files of every record, each once, with the declared digest if listed.

    `declared` is (source_id, relative_path, digest). Of rows that name one file
    the first in header order stays, a record's header before its signals.
    """
    folder = S.parent("header_path")
    name = lambda p: F.when(folder == "", p).otherwise(F.concat(folder, F.lit("/"), p))
    files = F.concat(
        F.array(F.struct(F.lit(0).alias("nth"), F.col("header_path").alias("path"), F.lit("header").alias("role"))),
        F.transform("signal_paths", lambda p, k: F.struct((k + 1).alias("nth"), name(p).alias("path"), F.lit("signal").alias("role"))),
    )
    rows = headers.select("source_id", "header_path", F.explode(files).alias("f")).select(
        S.file_id("source_id", F.col("f.path")).alias("file_id"), "source_id", F.col("f.path").alias("relative_path"), F.col("f.role").alias("role"), "header_path", F.col("f.nth").alias("nth")
    )
    first = Window.partitionBy("file_id").orderBy("header_path", "nth")
    once = rows.withColumn("rank", F.row_number().over(first)).filter("rank = 1")
    listed = declared.select("source_id", "relative_path", F.col("digest").alias("sha256_declared"))
    return shaped(once.join(listed, ["source_id", "relative_path"], "left"), "source_file")


def records(headers: DataFrame) -> DataFrame:
    """One row per tracing; its signal file is the first of the sorted signal paths."""
    folder = S.parent("header_path")
    signal = F.try_element_at(F.array_sort("signal_paths"), F.lit(1))
    path = F.when(folder == "", signal).otherwise(F.concat(folder, F.lit("/"), signal))
    rows = headers.withColumns({
        "header_file_id": S.file_id("source_id", "header_path"), "signal_file_id": S.file_id("source_id", path),
        "duration_s": S.duration_s("n_samples", "sampling_rate_hz"), "units_declared": S.joined("units_declared"),
    })
    return shaped(rows, "record")


def leads(headers: DataFrame) -> DataFrame:
    return shaped(headers.select("record_id", F.explode("leads").alias("l")).select("record_id", "l.*"), "lead")


def labels(headers: DataFrame, vocabulary: str = "SNOMED CT", field: str = "header comment Dx", asserted_by: str = "corpus") -> DataFrame:
    """One row per declared code, repeats kept; records without codes give none."""
    rows = headers.select("record_id", F.lit(vocabulary).alias("vocabulary"), F.explode("dx").alias("code"), F.lit(field).alias("source_field"), F.lit(asserted_by).alias("asserted_by"))
    return shaped(rows, "label")


def quality(judged: DataFrame) -> DataFrame:
    """Lists of leads become text; a record holds if nothing is against it."""
    lists = ("missing_leads", "flat_leads", "saturated_leads")
    holds = sum((F.size(c) for c in lists), F.lit(0)) + F.col("n_nonfinite") == 0
    return shaped(judged.withColumn("holds", holds).withColumns({c: S.joined(c) for c in lists}), "quality")
