"""Delivered tables on disk, as views, and the one-join provenance query."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schemas import TABLES

#: What rows of a table are looked up by.
KEYS = {"source_file": "file_id", **dict.fromkeys(("record", "lead", "label", "label_propagated", "patient", "quality", "signal_group"), "record_id"), "duplicate_link": "record_a"}


def write(tables: dict[str, DataFrame], directory: str) -> None:
    """One Parquet folder per table; what was there is replaced.

    Tables with a key are dealt by ranges of it and sorted, with a bloom filter
    beside each column chunk: a look-up opens the files and row groups whose range
    and filter admit its key, which is one of each.
    """
    for name, df in tables.items():
        if name not in TABLES:
            raise KeyError(f"{name!r} is not a delivered table")
        key = KEYS.get(name)
        if key:
            df = df.repartitionByRange(key).sortWithinPartitions(key)  # Spark merges small ranges into one file
        writer = df.write.mode("overwrite")
        writer = writer.option(f"parquet.bloom.filter.enabled#{key}", True) if key else writer
        writer.parquet(f"{directory}/{name}")


def present(spark: SparkSession, directory: str) -> list[str]:
    """Delivered tables that are there, in their order."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    path = lambda name: jvm.org.apache.hadoop.fs.Path(f"{directory}/{name}")
    return [name for name in TABLES if path(name).getFileSystem(conf).exists(path(name))]


def read(spark: SparkSession, directory: str, table: str) -> DataFrame:
    return spark.read.schema(TABLES[table]).parquet(f"{directory}/{table}")


def connect(spark: SparkSession, directory: str) -> list[str]:
    """A view per table that is there; any SQL may follow."""
    names = present(spark, directory)
    for name in names:
        read(spark, directory, name).createOrReplaceTempView(name)
    return names


def traced(record: DataFrame, source_file: DataFrame) -> DataFrame:
    """(record_id, source_id, relative_path, sha256_declared) of every record, in one join."""
    found = record.select("record_id", F.col("signal_file_id").alias("file_id")).join(source_file, "file_id")
    return found.select("record_id", "source_id", "relative_path", "sha256_declared")


def trace(spark: SparkSession, record_id: str) -> dict | None:
    """Where a record's signal comes from, by the views of `connect`, or None."""
    row = traced(spark.table("record").filter(F.col("record_id") == record_id), spark.table("source_file")).first()
    return row.asDict() if row else None


def write_report(df: DataFrame, directory: str, name: str) -> None:
    """A small report as JSON lines below a folder, in place of the one that was there."""
    df.coalesce(1).write.mode("overwrite").option("ignoreNullFields", False).json(f"{directory}/{name}")
