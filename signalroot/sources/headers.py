"""WFDB headers: record and lead rows from the header text, no signal is read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import HEADER
from . import files, header_source


def read_texts(spark: SparkSession, directory: str, source_id: str) -> DataFrame:
    """(source_id, header_path, text) of every header file below a folder.

    Through `header_source`, or Spark's own reader where Arrow doesn't know the file system.
    """
    if files.reachable(directory):
        return header_source.load(spark, directory).select(F.lit(source_id).alias("source_id"), "header_path", "text")
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.hea").load(directory)
    root = directory.rstrip("/") + "/"
    return read.select(F.lit(source_id).alias("source_id"), F.substring_index("path", root, -1).alias("header_path"), F.col("content").cast("string").alias("text"))


def declared_units(text: Column | str, n: Column) -> Column:
    """The units of n signal lines as the text has them: '' where there is no slash."""
    lines = F.filter(F.split(text, r"\r?\n"), lambda x: (F.trim(x) != "") & ~F.startswith(F.trim(x), F.lit("#")))
    third = lambda x: F.coalesce(F.try_element_at(F.split(F.trim(x), r"\s+"), F.lit(3)), F.lit(""))
    return F.transform(F.slice(lines, 2, n), lambda x: F.coalesce(S.right_of(third(x), "/"), F.lit("")))


def _number(text: Column, pattern: str, kind: str) -> Column:
    return F.nullif(F.regexp_extract(text, pattern, 1), F.lit("")).cast(kind)


def _lead(line: Column, position: Column, unit: Column) -> Column:
    """A signal line: file, format, gain(baseline)/units, resolution, zero, first value, checksum, block, name."""
    field = F.split(F.trim(line), r"\s+", 9)
    at = lambda k: F.coalesce(F.try_element_at(field, F.lit(k)), F.lit(""))
    zero = F.coalesce(_number(at(5), r"^(-?\d+)$", "long"), F.lit(0).cast("long"))
    gain = F.coalesce(_number(at(3), r"^([-+0-9.eE]+)", "double"), F.lit(0.0))
    return F.struct(
        position.cast("long").alias("position"), at(9).alias("name_native"), S.canonical_lead(at(9)).alias("name_canonical"), unit.alias("units_declared"),
        F.when(gain == 0, 200.0).otherwise(gain).alias("gain"), F.coalesce(_number(at(3), r"\((-?\d+)\)", "long"), zero).alias("baseline"), zero.alias("adc_zero"),
        at(2).alias("format"), at(1).alias("file"), _number(at(6), r"^(-?\d+)$", "long").alias("initial_value"),
    )


def comments_of(text: Column | str) -> Column:
    """Comment lines without their marks, in order."""
    return F.transform(F.filter(F.split(text, r"\r?\n"), lambda x: F.startswith(F.trim(x), F.lit("#"))), lambda x: F.trim(F.regexp_replace(F.trim(x), "^#+", "")))


def parse(texts: DataFrame) -> DataFrame:
    """One row of schemas.HEADER per header text (source_id, header_path, text)."""
    lines = F.filter(F.split("text", r"\r?\n"), lambda x: (F.trim(x) != "") & ~F.startswith(F.trim(x), F.lit("#")))
    first = F.split(F.trim(F.try_element_at(lines, F.lit(1))), r"\s+")
    at = lambda k: F.coalesce(F.try_element_at(first, F.lit(k)), F.lit(""))
    rows = texts.withColumns({"lines": lines, "comments": comments_of("text")}).withColumns({
        "n_leads": at(2).cast("long"), "sampling_rate_hz": F.coalesce(_number(at(3), r"^([0-9.eE]+)", "double"), F.lit(250.0)), "n_samples": _number(at(4), r"^(\d+)", "long"),
    })
    rows = rows.withColumn("units", declared_units("text", F.col("n_leads").cast("int")))
    body = F.slice("lines", 2, F.col("n_leads").cast("int"))
    rows = rows.withColumn("leads", F.transform(F.arrays_zip(body.alias("line"), F.col("units")), lambda z, k: _lead(z["line"], k, z["units"])))
    rows = rows.withColumns({
        "native_record_id": S.stem("header_path"), "record_id": F.concat("source_id", F.lit(":"), S.stem("header_path")),
        "signal_paths": F.array_sort(F.array_distinct(F.transform("leads", lambda x: x["file"]))),
        "units_declared": S.distinct_units("units"), "units_are_declared": S.units_are_declared("units"), "all_millivolts": S.all_millivolts("units"),
        "age": S.comment_value("comments", "Age"), "sex": S.comment_value("comments", "Sex"),
        "dx": F.coalesce(S.items(S.comment_value("comments", "Dx")), F.array().cast("array<string>")),
    })
    return rows.select(*[rows[f.name].cast(f.dataType).alias(f.name) for f in HEADER])


def scan(spark: SparkSession, directory: str, source_id: str) -> DataFrame:
    return parse(read_texts(spark, directory, source_id))
