"""Leak-safe groups: components over fingerprints and all links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schemas import shaped
from ..scratch import Scratch
from .components import connected_components, extended
from .duplicates import chain_by_digest


def signal_groups(digests: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """(record_id, signal_group_id, group_size, fingerprint) of records with a fingerprint.

    `digests` is (record_id, digest). A group is named by its smallest member;
    members without a fingerprint count in its size and may name it, but give no
    row. Links with an end that isn't among the records are ignored. What makes
    the digests, which may be a hash of every text, runs once: they are written.
    """
    digests = Scratch(digests.sparkSession).table(digests.select("record_id", "digest"), "digests")
    edges = chain_by_digest(digests)
    if links is not None:
        known = digests.select("record_id").distinct()
        both = links.select(F.col("record_a").alias("a"), F.col("record_b").alias("b"))
        for end in ("a", "b"):
            both = both.join(known.withColumnRenamed("record_id", end), end, "left_semi")
        edges = edges.unionByName(both)
    components = connected_components(edges)
    named = digests.join(components.withColumnRenamed("node", "record_id"), "record_id", "left").withColumn("signal_group_id", F.coalesce("component", "record_id"))
    sizes = named.groupBy("signal_group_id").agg(F.count(F.lit(1)).alias("group_size"))
    rows = named.filter("digest IS NOT NULL").join(sizes, "signal_group_id").withColumnRenamed("digest", "fingerprint")
    return shaped(rows, "signal_group")


def extended_groups(groups: DataFrame, digests: DataFrame, links: DataFrame | None = None) -> DataFrame:
    """`signal_groups` of delivered groups and what came after them, without going through the old links again.

    `groups` is a delivered signal_group, `digests` (record_id, digest) of new
    records, `links` new links between any records of both. A new record joins
    the group that has its fingerprint; a link may join two old groups. Old
    members without a fingerprint, which have no row, can't be linked to anew.
    Groups, digests and what the groups become are written once and read again.
    """
    scratch = Scratch(groups.sparkSession)
    groups, digests = scratch.table(groups, "groups"), scratch.table(digests.select("record_id", "digest"), "digests")
    old = groups.select("record_id", F.col("signal_group_id"), F.col("fingerprint").alias("digest"))
    every = old.select("record_id", "digest").unionByName(digests.select("record_id", "digest"))
    held = old.groupBy("digest").agg(F.min("record_id").alias("a"))
    edges = digests.filter("digest IS NOT NULL").join(held, "digest").select("a", F.col("record_id").alias("b")).unionByName(chain_by_digest(digests))
    if links is not None:
        known = every.select("record_id").distinct()
        both = links.select(F.col("record_a").alias("a"), F.col("record_b").alias("b"))
        for end in ("a", "b"):
            both = both.join(known.withColumnRenamed("record_id", end), end, "left_semi")
        edges = edges.unionByName(both)
    # a group may be named by a member without a row, who still counts in its size
    before = old.select(F.col("record_id").alias("node"), F.col("signal_group_id").alias("component"))
    hidden = groups.select(F.col("signal_group_id").alias("node")).distinct().join(before.select("node"), "node", "left_anti").select("node", F.col("node").alias("component"))
    components = scratch.table(extended(before.unionByName(hidden), scratch.table(edges, "edges")), "components")
    named = every.join(components.withColumnRenamed("node", "record_id"), "record_id", "left").withColumn("signal_group_id", F.coalesce("component", "record_id"))
    unseen = groups.groupBy("signal_group_id").agg((F.first("group_size") - F.count(F.lit(1))).alias("n")).filter("n > 0").withColumnRenamed("signal_group_id", "node")
    unseen = unseen.join(components, "node", "left").select(F.coalesce("component", "node").alias("signal_group_id"), "n")
    sizes = named.select("signal_group_id", F.lit(1).cast("long").alias("n")).unionByName(unseen).groupBy("signal_group_id").agg(F.sum("n").alias("group_size"))
    rows = named.filter("digest IS NOT NULL").join(sizes, "signal_group_id").withColumnRenamed("digest", "fingerprint")
    return shaped(rows, "signal_group")
