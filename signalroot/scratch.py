"""Parquet tables in the shared folder, used to cut lineage between stages."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: A side of a join is broadcast only when a count shows it has at most this
#: many narrow rows (ids, digests); beyond, Spark shuffles both sides.
BROADCAST_ROWS = 1_000_000

_made: dict[str, list[str]] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder named in spark.checkpoint.dir; one of our own only if unset, and only where driver and tasks share a machine."""
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        held = spark.sparkContext.getCheckpointDir()
        if held is None:
            if not spark.sparkContext.master.startswith("local"):
                raise RuntimeError("spark.checkpoint.dir has to name a folder that all executors share")
            spark.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="scratch-"))
            held = spark.sparkContext.getCheckpointDir()
        named = held
    return named


def _remove(spark: SparkSession, path: str) -> None:
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


class Scratch:
    """A folder of written tables.

    A lost executor costs a re-read of such a table, not the stages behind it.
    Tables that an operator's result still reads are removed at exit; `drop`
    removes those that nothing reads any more.
    """

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.root = f"{shared_dir(spark)}/scratch-{uuid.uuid4().hex}"
        if not _made:
            atexit.register(_sweep)
        _made.setdefault(spark.sparkContext.applicationId, []).append(self.root)

    def table(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.root}/{name}"
        df.write.mode("overwrite").parquet(path)
        release(self.spark)  # the stages behind the table won't be read again
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *names: str) -> None:
        for name in names:
            _remove(self.spark, f"{self.root}/{name}")


def _sweep() -> None:
    spark = SparkSession.getActiveSession()
    if spark is None or spark.sparkContext._jsc is None:
        return
    for root in _made.pop(spark.sparkContext.applicationId, []):
        try:
            _remove(spark, root)
        except Exception:  # the JVM may be gone at exit; the folder is scratch
            return


def release(spark: SparkSession) -> None:
    """Lets Spark delete shuffle files whose plans are no longer referenced."""
    spark.sparkContext._jvm.System.gc()


def sized(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """`df` (a written table) with a broadcast hint if a count allows one."""
    return F.broadcast(df) if df.count() <= rows else df
