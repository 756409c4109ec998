"""Annotations: propagation along links, counts, and audits against published figures."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..schemas import shaped


def propagate(label: DataFrame, links: DataFrame, record: DataFrame) -> DataFrame:
    """Labels of linked records for records that have none, one hop, with their origin.

    A target takes all labels, repeats too, of its smallest labelled neighbour;
    their source_field and asserted_by say that they travelled, and from where.
    """
    labelled = label.select("record_id").distinct()
    directed = links.select(F.col("record_a").alias("target"), F.col("record_b").alias("origin")).unionByName(links.select(F.col("record_b").alias("target"), F.col("record_a").alias("origin")))
    bare = directed.join(labelled.withColumnRenamed("record_id", "target"), "target", "left_anti")
    useful = bare.join(labelled.withColumnRenamed("record_id", "origin"), "origin", "left_semi")
    chosen = useful.groupBy("target").agg(F.min("origin").alias("via_record_id"))
    copied = chosen.join(label.withColumnRenamed("record_id", "via_record_id"), "via_record_id").withColumnRenamed("target", "record_id")
    told = copied.withColumns({"source_field": F.concat(F.lit("propagated from "), "via_record_id"), "asserted_by": F.lit("linked record")})
    return shaped(told.join(record.select("record_id", "source_id"), "record_id", "left"), "label_propagated").orderBy("record_id")


def propagate_by_digest(label: DataFrame, digests: DataFrame) -> DataFrame:
    """As `propagate` along the links of equal digest, without making those pairs.

    `digests` is (record_id, source_id, digest), a row per record. Each digest has
    one smallest labelled record, so work is linear in the records however large
    a group is; a digest that nobody labelled drops out before any label moves.
    """
    labelled = label.select("record_id").distinct()
    origin = digests.filter("digest IS NOT NULL").join(labelled, "record_id", "left_semi").groupBy("digest").agg(F.min("record_id").alias("via_record_id"))
    bare = digests.join(labelled, "record_id", "left_anti")
    chosen = bare.join(origin, "digest").select("record_id", "source_id", "via_record_id")
    copied = chosen.join(label.withColumnRenamed("record_id", "via_record_id"), "via_record_id")
    told = copied.withColumns({"source_field": F.concat(F.lit("propagated from "), "via_record_id"), "asserted_by": F.lit("linked record")})
    return shaped(told, "label_propagated")


def counts_per_source(label: DataFrame, record: DataFrame) -> DataFrame:
    """Label rows by (source_id, code)."""
    return label.join(record.select("record_id", "source_id"), "record_id", "left").groupBy("source_id", "code").agg(F.count(F.lit(1)).alias("n"))


def compare_with_published(published: DataFrame, counted: DataFrame) -> DataFrame:
    """Every published cell (source_id, code, published) with what was counted, missing as 0."""
    found = counted.select("source_id", "code", F.col("n").alias("counted"))
    return published.join(found, ["source_id", "code"], "left").withColumn("counted", F.coalesce("counted", F.lit(0).cast("long"))).withColumn("agrees", F.col("published") == F.col("counted"))


def agreement(compared: DataFrame) -> DataFrame:
    return compared.agg(F.count(F.lit(1)).alias("n_cells"), F.count_if("agrees").alias("n_agreeing"), F.count_if(~F.col("agrees")).alias("n_disagreements"))


def disagreements(compared: DataFrame, n: int = 20) -> DataFrame:
    """The first n cells that disagree, by source and code: a report, limited by design."""
    return compared.filter(~F.col("agrees")).orderBy("source_id", "code").limit(n)


def named_join(native_ids: DataFrame, bundled: DataFrame) -> DataFrame:
    """How many ids of the form NNNNN_hr name a bundled record.

    `native_ids` and `bundled` have one column, native_record_id.
    """
    number = F.regexp_extract("native_record_id", r"^(\d+)_hr$", 1)
    keyed = native_ids.filter(number != "").select(S.bundle_id(number).alias("native_record_id"))
    named = keyed.join(bundled, "native_record_id", "left_semi").agg(F.count(F.lit(1)).alias("n_named"))
    rest = bundled.join(keyed, "native_record_id", "left_anti").agg(F.count(F.lit(1)).alias("n_unnamed_bundled"))
    return keyed.agg(F.count(F.lit(1)).alias("n_keys")).crossJoin(named).crossJoin(rest)  # three single rows


def silent_sources(source: DataFrame, label: DataFrame) -> DataFrame:
    """Sources without any row in `label` (which has a source_id)."""
    return source.select("source_id").distinct().join(label.select("source_id"), "source_id", "left_anti").orderBy("source_id")
