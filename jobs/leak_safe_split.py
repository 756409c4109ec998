"""Folds that no copy crosses: every record with its group, its labels and its fold.

Two documents are copies if they have the same words but for case and spacing, or
the same lines in any order. Copies of copies are one group, and a group goes to
one fold whole. A record without a label takes those of the smallest labelled
record with the same words. The fold follows from the seed and the group's name
alone, so a rerun gives the same folds, and so does a larger table to groups that
didn't change.

Output: Parquet under `out`/records, by fold; `out`/balance has the counts that
tell whether folds are alike. Both are replaced at a rerun.
"""

from __future__ import annotations

import logging
import sys

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from signalroot.operators import duplicates, groups, labels
from signalroot.schemas import shaped
from signalroot.scratch import Scratch

from .common import counts, main, record_id

log = logging.getLogger("leak_safe_split")

#: Digits of the draw that decides a fold: 16 ** 8 draws are told apart.
_DIGITS = 8


def bounds(folds: str) -> list[tuple[str, str]]:
    """(fold, first draw behind it) of `name=share,...`, in order; shares count as parts of their sum."""
    pairs = [(name.strip(), float(share)) for name, _, share in (part.partition("=") for part in folds.split(","))]
    whole = sum(share for _, share in pairs)
    if whole <= 0 or any(share < 0 or not name for name, share in pairs):
        raise ValueError(f"no folds: {folds!r}")
    found, upto = [], 0.0
    for name, share in pairs:
        upto += share
        found.append((name, f"{round(16**_DIGITS * upto / whole):0{_DIGITS}x}"))
    found[-1] = (found[-1][0], "g")  # behind every draw
    return found


def fold_of(group: Column, folds: str, seed: str) -> Column:
    draw = F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), group), 256), 1, _DIGITS)
    chosen = F.lit(None).cast("string")
    for name, behind in reversed(bounds(folds)):
        chosen = F.when(draw < F.lit(behind), name).otherwise(chosen)
    return chosen


def digests(documents: DataFrame) -> DataFrame:
    """(record_id, source_id, doc_id, words, lines): two digests of each whole text, null for a null text."""
    words = F.trim(F.regexp_replace(F.lower("text"), "[\\x20\\x09-\\x0D]+", " "))
    lines = F.array_join(F.array_sort(F.split("text", "\n")), "\n")
    return documents.select(record_id().alias("record_id"), F.col("source").alias("source_id"), "doc_id", F.sha2(words, 256).alias("words"), F.sha2(lines, 256).alias("lines"))


def statements(documents: DataFrame, flags: DataFrame) -> DataFrame:
    """The table label: a row for each flag that is set."""
    codes = F.filter(F.array(F.when(F.col("quality") == 1, "good"), F.when(F.col("toxic") == 1, "toxic")), lambda x: x.isNotNull())
    rows = documents.select(record_id().alias("record_id"), "doc_id").join(flags.select("doc_id", F.explode(codes).alias("code")), "doc_id").select("record_id", "code")
    return shaped(rows.distinct().withColumns({"vocabulary": F.lit("flags"), "source_field": F.lit("labels"), "asserted_by": F.lit("table")}), "label")


def split(documents: DataFrame, flags: DataFrame, folds: str, seed: str) -> DataFrame:
    """(record_id, source_id, doc_id, signal_group_id, group_size, codes, via_record_id, fold) of every record.

    Records with a null text are groups of their own. Rows with one record_id are
    one record, with the least of their texts' digests.
    """
    scratch = Scratch(documents.sparkSession)
    seen = digests(documents)
    one = scratch.table(seen.groupBy("record_id").agg(*(F.min(c).alias(c) for c in ("source_id", "doc_id", "words", "lines"))), "digests")  # each text is read once
    links = duplicates.chain_by_digest(one, digest_col="lines").select(F.col("a").alias("record_a"), F.col("b").alias("record_b"))
    grouped = groups.signal_groups(one.select("record_id", F.coalesce("words", "record_id").alias("digest")), links)
    label = scratch.table(statements(documents, flags), "label")
    own = label.select("record_id", "code", F.lit(None).cast("string").alias("via_record_id"))
    copied = labels.propagate_by_digest(label, one.select("record_id", "source_id", F.col("words").alias("digest"))).select("record_id", "code", "via_record_id")
    codes = own.unionByName(copied).groupBy("record_id").agg(F.array_join(F.array_sort(F.collect_set("code")), "|").alias("codes"), F.min("via_record_id").alias("via_record_id"))
    rows = one.select("record_id", "source_id", "doc_id").join(grouped.drop("fingerprint"), "record_id").join(codes, "record_id", "left")
    return rows.withColumn("fold", fold_of(F.col("signal_group_id"), folds, seed))


def run(spark: SparkSession, tables: str, out: str, folds: str = "train=80,validation=10,test=10", seed: str = "20260908") -> DataFrame:
    """Writes the split of `tables`/documents.parquet and `tables`/labels.parquet below `out`; returns what was written."""
    bounds(folds)  # fails before anything is read
    documents, flags = spark.read.parquet(f"{tables}/documents.parquet"), spark.read.parquet(f"{tables}/labels.parquet")
    log.info("read %d documents and %d rows of labels from %s", documents.count(), flags.count(), tables)
    made = split(documents, flags, folds, seed).repartition("fold", F.pmod(F.xxhash64("record_id"), F.lit(int(spark.conf.get("spark.sql.shuffle.partitions")))))
    made.write.mode("overwrite").partitionBy("fold").parquet(f"{out}/records")
    written = spark.read.parquet(f"{out}/records")
    code = F.explode_outer(F.split("codes", r"\|"))
    balance = written.select("fold", "source_id", code.alias("code")).groupBy("fold", "source_id", "code").agg(F.count(F.lit(1)).alias("n"))
    balance.coalesce(1).write.mode("overwrite").json(f"{out}/balance")  # folds by sources by codes: few rows
    log.info("wrote %s below %s/records: %s", "records by fold", out, counts(written, "fold"))
    return written


if __name__ == "__main__":
    sys.exit(main(run, "leak_safe_split", __doc__.splitlines()[0]))
