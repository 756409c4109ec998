"""Files verified as they arrive: a stream of binary files against a declared manifest."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..sources import manifest

FILES = "path string, modificationTime timestamp, length long, content binary"


def arriving(spark: SparkSession, directory: str, glob: str = "*", per_trigger: int = 1000) -> DataFrame:
    """(relative_path, digest) of files that appear below a folder."""
    files = (
        spark.readStream.format("binaryFile").schema(FILES).option("recursiveFileLookup", True).option("pathGlobFilter", glob).option("maxFilesPerTrigger", per_trigger).load(directory)
    )
    root = directory.rstrip("/") + "/"
    return files.select(F.substring_index("path", root, -1).alias("relative_path"), F.sha2("content", 256).alias("digest"))


def verify_arrivals(observed: DataFrame, declared: DataFrame, out: str, checkpoint: str) -> StreamingQuery:
    """Writes (relative_path, declared, observed, outcome) of every batch to `out`, and stops when all is read.

    A batch is written to a folder of its own, so one that is repeated after a
    failure replaces what it wrote before.
    """

    def write(batch: DataFrame, number: int) -> None:
        manifest.verify(declared, batch, subset=True).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return observed.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
