"""Publishers' checksum files, and what they say about the files that are there."""

from __future__ import annotations

import fnmatch
import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import Scratch
from . import files

#: Bytes that a task hashes, about.
TASK_BYTES = 1 << 28
MATCHED, MISMATCHED, MISSING, UNLISTED = "matched", "mismatched", "missing", "unlisted"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, line) of a text file, or of all files of a folder, of any size.

    A large file is read in blocks by many tasks; line_no is (file, block's first
    byte, place), which orders lines as the files do.
    """
    text = spark.read.text(path)
    place = F.struct(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("place"))
    return text.select(place.alias("line_no"), F.col("value").alias("line"))


def parse_lines(lines: DataFrame, prefix: str = "") -> DataFrame:
    """(relative_path, digest) of manifest lines (line_no, line).

    A line is a digest of 64 characters, a space, and a path with an optional
    mark; empty lines don't count, any other line is an error even outside the
    prefix. Digests stay as they are written. Only paths under `prefix` stay,
    without it; of a repeated path the last line holds.
    """
    parts = F.split("line", " ", 2)
    digest, rest = parts[0], F.try_element_at(parts, F.lit(2))
    bad = rest.isNull() | (F.length(digest) != 64)
    path = F.regexp_replace(rest, r"^[ *]+", "")
    rows = lines.filter("line != ''").select(
        "line_no", F.when(bad, F.raise_error(F.concat(F.lit("not a manifest line: "), "line"))).otherwise(path).alias("path"), digest.alias("digest")
    )
    mine = rows.filter(F.startswith("path", F.lit(prefix))).select("line_no", F.substr("path", F.lit(len(prefix) + 1)).alias("relative_path"), "digest")
    return mine.groupBy("relative_path").agg(F.max_by("digest", "line_no").alias("digest"))


def _hash_paths(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path in batch.column("path").to_pylist():
            yield pa.RecordBatch.from_arrays([pa.array([path]), pa.array([sha256_of(files.chunks(path))])], ["path", "digest"])


def sha256_of(chunks: Iterator[bytes]) -> str:
    seen = hashlib.sha256()
    for chunk in chunks:
        seen.update(chunk)
    return seen.hexdigest()


def empty_files(spark: SparkSession, directory: str, glob: str, n_read: int) -> list[str]:
    """Relative paths of files without a byte, which Spark's reader passes over.

    They are listed one by one only if the folder holds more files than were read.
    """
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(directory)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if fs.getContentSummary(root).getFileCount() == n_read:
        return []
    base, found, files = fs.makeQualified(root).toString().rstrip("/") + "/", [], fs.listFiles(root, True)
    while files.hasNext():
        f = files.next()
        name = f.getPath().getName()
        if f.getLen() == 0 and fnmatch.fnmatchcase(name, glob) and not name.startswith((".", "_")):
            found.append(f.getPath().toString().removeprefix(base))
    return found


def file_digests(spark: SparkSession, directory: str, glob: str = "*") -> DataFrame:
    """(relative_path, digest) of all files below a folder, of any length, empty ones too.

    Spark lists the files; tasks open them and hash them in chunks, so a task's
    memory is a chunk whatever the file. Work is dealt by bytes. Where only
    Spark's reader knows the file system, whole files become a column instead,
    which holds no more than 2 GB.
    """
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", glob).load(directory)
    listed = Scratch(spark).table(read.select("path", "length"), "listed")
    n, size = listed.agg(F.count(F.lit(1)), F.coalesce(F.sum("length"), F.lit(0))).first()
    if files.reachable(directory):
        tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), size // TASK_BYTES + 1)
        found = listed.repartition(tasks, F.rand(7)).mapInArrow(_hash_paths, "path string, digest string")
    else:
        found = read.select("path", F.sha2("content", 256).alias("digest"))
    root = directory.rstrip("/") + "/"
    digests = found.select(F.substring_index("path", root, -1).alias("relative_path"), "digest")
    empty = empty_files(spark, directory, glob, n)
    if not empty:
        return digests
    return digests.unionByName(spark.createDataFrame([(p, hashlib.sha256(b"").hexdigest()) for p in empty], "relative_path string, digest string"))


def verify(declared: DataFrame, observed: DataFrame, subset: bool = False) -> DataFrame:
    """(relative_path, declared, observed, outcome): matched, mismatched, missing or unlisted.

    With `subset`, files that weren't looked at aren't called missing.
    """
    d = declared.select("relative_path", F.col("digest").alias("declared"))
    o = observed.select("relative_path", F.col("digest").alias("observed"))
    both = d.join(o, "relative_path", "right" if subset else "full_outer")
    outcome = (
        F.when(F.col("observed").isNull(), MISSING).when(F.col("declared").isNull(), UNLISTED).when(F.col("declared") == F.col("observed"), MATCHED).otherwise(MISMATCHED)
    )
    return both.withColumn("outcome", outcome)


def report(verified: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Counts of the four outcomes; a manifest holds without mismatched and missing files."""
    count = lambda what: F.count_if(F.col("outcome") == what).alias(f"n_{what}")
    sums = verified.groupBy(*(by or [])).agg(*map(count, (MATCHED, MISMATCHED, MISSING, UNLISTED)), F.count("declared").alias("n_declared"))
    return sums.withColumns({"n_checked": F.col("n_matched") + F.col("n_mismatched"), "holds": F.col("n_mismatched") + F.col("n_missing") == 0})
