"""A ledger of records as they arrive: fingerprinted, checked, and told from those held already.

A stream reads the files of `tables`/documents.parquet that its checkpoint hasn't
seen and ends when there are no more. Each arrival (micro-batch) is judged
against its own declarations (n_chars) and against the first holders in the
ledger: a record whose text is held, or came with a smaller record_id in the same
arrival, is a repeat of that record.

Output: Parquet under `out`, by arrival and outcome (first, repeat, blank). Only
the digests of first holders are read again, never a text. An arrival that a
failure repeats looks at smaller arrivals only and replaces its own partitions,
so it writes the same rows. A ledger belongs to its checkpoint: keep both or none.
"""

from __future__ import annotations

import logging
import sys

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from signalroot.functions import scalars as S
from signalroot.scratch import Scratch, sized

from .common import counts, main, record_id

log = logging.getLogger("arrivals")

LEDGER = (
    "record_id string, source_id string, doc_id long, digest string, n_chars long, n_chars_declared long, declared_holds boolean, "
    "first_record_id string, scope string, arrival long, outcome string"
)
FIRST, REPEAT, BLANK = "first", "repeat", "blank"


def fingerprinted(documents: DataFrame) -> DataFrame:
    """One row per record; a null or empty text has no digest."""
    digest = F.when(F.length("text") > 0, F.sha2("text", 256))
    return documents.select(
        record_id().alias("record_id"), F.col("source").alias("source_id"), F.col("doc_id").cast("long").alias("doc_id"), digest.alias("digest"), F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
        F.col("n_chars").try_cast("long").alias("n_chars_declared"),
    ).withColumn("declared_holds", F.col("n_chars").eqNullSafe(F.col("n_chars_declared")))


def judged(fresh: DataFrame, held: DataFrame) -> DataFrame:
    """`fresh` (fingerprinted rows, a written table) with first holders and outcomes; `held` are ledger rows that came before.

    Digests are pre-aggregated on both sides, so a text that very many records
    share meets its holder once; rows are joined only with digests that repeat.
    """
    scratch = Scratch(fresh.sparkSession)
    new = scratch.table(fresh.filter("digest IS NOT NULL").groupBy("digest").agg(F.min(F.struct("record_id", "source_id")).alias("mine"), F.count(F.lit(1)).alias("n")), "new")
    before = held.filter(F.col("outcome") == FIRST).join(sized(new.select("digest")), "digest", "left_semi").groupBy("digest").agg(F.min(F.struct("record_id", "source_id")).alias("theirs"))
    known = new.join(before, "digest", "left").filter("n > 1 OR theirs IS NOT NULL")
    shared = scratch.table(known.select("digest", F.coalesce("theirs", "mine").alias("holder"), F.col("theirs").isNotNull().alias("was_held")), "shared")
    rows = fresh.join(sized(shared), "digest", "left")
    holder, own = F.col("holder.record_id"), F.col("record_id")
    repeat = F.col("was_held") | (holder != own)  # null where the digest is nobody else's
    outcome = F.when(F.col("digest").isNull(), BLANK).when(repeat, REPEAT).otherwise(FIRST)
    return rows.withColumns({
        "outcome": outcome, "first_record_id": F.when(outcome == REPEAT, holder).when(outcome == FIRST, own),
        "scope": F.when(outcome == REPEAT, S.scope("source_id", F.col("holder.source_id"))),
    })


def ledger(spark: SparkSession, out: str) -> DataFrame:
    return spark.read.schema(LEDGER).parquet(out)


def run(spark: SparkSession, tables: str, out: str, checkpoint: str, files_per_arrival: int = 1000) -> DataFrame:
    """Takes what is new into the ledger at `out`; returns the whole ledger as it then stands."""
    path = f"{tables}/documents.parquet"
    columns = [c.split()[0] for c in LEDGER.split(", ")]
    spark.createDataFrame([], LEDGER).write.mode("append").partitionBy("arrival", "outcome").parquet(out)  # the folder is there from now on
    stream = spark.readStream.schema(spark.read.parquet(path).schema).option("maxFilesPerTrigger", int(files_per_arrival)).parquet(f"{tables}/documents.parque[t]")  # a pattern fits a single file too

    def take(batch: DataFrame, number: int) -> None:
        session = batch.sparkSession
        fresh = Scratch(session).table(fingerprinted(batch), "fresh")  # each text is read and hashed once
        made = judged(fresh, ledger(session, out).filter(F.col("arrival") < number)).withColumn("arrival", F.lit(number).cast("long"))
        made.select(*columns).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("arrival", "outcome").parquet(out)
        mine = ledger(session, out).filter(F.col("arrival") == number)
        log.info("arrival %d: read %d rows, wrote %s", number, fresh.count(), counts(mine, "outcome"))

    query = stream.writeStream.foreachBatch(take).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    log.info("read %d new rows of %s; the ledger at %s has %s", sum(p["numInputRows"] for p in query.recentProgress), path, out, counts(ledger(spark, out), "outcome"))
    return ledger(spark, out)


if __name__ == "__main__":
    sys.exit(main(run, "arrivals", __doc__.splitlines()[0]))
