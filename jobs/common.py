"""What the jobs share: their config, their command line, and records of documents."""

from __future__ import annotations

import argparse
import logging

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def config(spark: SparkSession, path: str) -> dict:
    """The settings of a small JSON file, read by Spark, so it may lie where the tables do."""
    return spark.read.option("multiLine", True).json(path).first().asDict()


def record_id() -> Column:
    """`source:doc_id`; what is null is empty there."""
    return F.concat(F.coalesce("source", F.lit("")), F.lit(":"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))


def counts(df: DataFrame, *by: str) -> dict[str, int]:
    """Rows by a few columns with few values, for the log."""
    return {"/".join(map(str, r[:-1])): r[-1] for r in df.groupBy(*by).count().orderBy(*by).collect()}


def main(run, name: str, description: str, argv: list[str] | None = None) -> int:
    """Runs a job with the settings of its config, which arguments override."""
    parser = argparse.ArgumentParser(prog=f"python -m jobs.{name}", description=description)
    parser.add_argument("--config", default=f"jobs/{name}.json", help="JSON file of the settings")
    parser.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", help="a setting in place of the config's; may be repeated")
    options = parser.parse_args(argv)
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(name)s: %(message)s")
    spark = SparkSession.builder.appName(name).getOrCreate()
    try:
        run(spark, **(config(spark, options.config) | dict(pair.split("=", 1) for pair in options.set)))
    finally:
        spark.stop()
    return 0
