"""The delivery, built end to end from header and signal files."""

from __future__ import annotations

import logging
from collections.abc import Callable
from contextlib import nullcontext
from functools import cache
from itertools import groupby
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import scalars as S
from ..operators import duplicates, groups, labels, tables
from ..schemas import empty, shaped
from ..scratch import Scratch
from ..sources import catalog, headers, manifest, mappings, signals

log = logging.getLogger(__name__)


def unprofiled(name: str):
    """Stands for `Profile.phase` where nothing is measured."""
    return nullcontext()


class Swept(NamedTuple):
    """What the links of a distribution come from: judged records, and the declared digest of a signal file each.

    `unread` are the records (record_id, error) whose signal can't be read, as far
    as signals were read; `waves` gives (record_id, wave) when a screen needs it.
    """

    source_id: str
    corpus: str
    judged: DataFrame
    files: DataFrame
    unread: DataFrame
    waves: Callable[[], DataFrame]


class Screened(NamedTuple):
    """The links across two packagings of a corpus; the note says why a comparison was refused."""

    corpus: str
    left: Swept
    right: Swept
    links: DataFrame
    note: str | None


def states(spark: SparkSession, parsed: DataFrame, directory: str) -> DataFrame:
    """(record_id, state): a digest of path, length and modification time of a record's header and signal files.

    Spark lists the files, nothing is opened. A change that keeps length and time
    isn't seen.
    """
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory)
    listed = read.select(F.substring_index("path", directory.rstrip("/") + "/", -1).alias("path"), "length", F.unix_micros("modificationTime").alias("time"))
    folder = F.regexp_extract("header_path", r"^(.*/)[^/]*$", 1)
    mine = F.array_append(F.transform("signal_paths", lambda name: F.concat(folder, name)), F.col("header_path"))
    found = parsed.select("record_id", F.explode(mine).alias("path")).join(listed, "path", "left")
    return found.groupBy("record_id").agg(F.sha2(F.to_json(F.array_sort(F.collect_list(F.struct("path", "length", "time")))), 256).alias("state"))


#: The judged records of earlier builds, by source.
CACHED = f"{signals.JUDGED}, state string, source_id string"


def judged(spark: SparkSession, parsed: DataFrame, entry, cache: str | None) -> DataFrame:
    """`signals.judged` of all headers; with a cache folder only of records that are new or changed there.

    The source's rows in the cache are replaced by those of now, so records that
    are gone leave it. Records that can't be read aren't kept and are tried again.
    """
    scratch = Scratch(spark)
    if not cache:
        return scratch.table(signals.judged(spark, parsed, entry["directory"]), "judged")
    spark.createDataFrame([], CACHED).write.mode("append").partitionBy("source_id").parquet(cache)  # the folder is there from now on
    held = spark.read.schema(CACHED).parquet(cache).filter(F.col("source_id") == entry["source_id"]).drop("source_id")
    now = scratch.table(states(spark, parsed, entry["directory"]), "states")
    known = scratch.table(now.join(held, ["record_id", "state"]), "known")
    rest = scratch.table(parsed.join(known.select("record_id"), "record_id", "left_anti"), "rest")
    fresh = scratch.table(signals.judged(spark, rest, entry["directory"]).join(now, "record_id"), "fresh")
    log.info("%s: %d records decoded, %d as before", entry["source_id"], fresh.count(), known.count())
    every = known.unionByName(fresh)
    kept = every.filter("error IS NULL").withColumn("source_id", F.lit(entry["source_id"]))
    kept.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("source_id").parquet(cache)
    return every.drop("state")


def sweep(spark: SparkSession, entry, declared: DataFrame, cache: str | None = None) -> tuple[dict[str, DataFrame], Swept]:
    """Tables of one distribution (a catalogue row), and what the screens need of it.

    Headers are parsed and signals decoded once: both go to the shared folder
    before the tables are derived; with a cache folder, signals are decoded only
    of records that changed. A record that can't be read has all rows but the one
    of quality.
    """
    scratch = Scratch(spark)
    parsed = scratch.table(headers.scan(spark, entry["directory"], entry["source_id"]), "headers")
    every = judged(spark, parsed, entry, cache)
    good, unread = every.filter("error IS NULL").drop("error"), every.filter("error IS NOT NULL").select("record_id", "error")
    made = {
        "source_file": tables.source_files(parsed, declared.withColumn("source_id", F.lit(entry["source_id"]))),
        "record": tables.records(parsed), "lead": tables.leads(parsed), "label": tables.labels(parsed), "quality": tables.quality(good),
    }
    return made, Swept(entry["source_id"], entry["corpus"], good.withColumn("source_id", F.lit(entry["source_id"])), first_declared(parsed, declared), unread, lambda: good.select("record_id", "wave"))


def reswept(spark: SparkSession, entry, declared: DataFrame, quality: DataFrame) -> Swept:
    """As `sweep`, with the fingerprints of a delivered quality table.

    Only headers are read here. Signals are decoded, once, if the screen is left
    with records that no digest links.
    """
    scratch = Scratch(spark)
    parsed = scratch.table(headers.scan(spark, entry["directory"], entry["source_id"]), "headers")
    known = parsed.select("record_id", "source_id").join(quality.select("record_id", "signal_digest"), "record_id")

    @cache
    def waves() -> DataFrame:
        return scratch.table(signals.judged(spark, parsed, entry["directory"]).filter("error IS NULL").select("record_id", "wave"), "waves")

    unread = spark.createDataFrame([], "record_id string, error string")
    return Swept(entry["source_id"], entry["corpus"], known, first_declared(parsed, declared), unread, waves)


def screen(left: DataFrame, right: DataFrame, files: DataFrame, threshold: float = duplicates.THRESHOLD, waves: tuple | None = None, phase=unprofiled) -> tuple[DataFrame, str | None]:
    """Links across two packagings of a corpus: by file digest, fingerprint, then correlation.

    `left` and `right` are judged records (record_id, source_id, signal_digest);
    `files` is (record_id, source_id, digest) of declared signal files. `waves`
    gives (record_id, wave) of each side if called; without it the records have a
    column of that name. `phase(name)` is entered for each sieve.
    """
    both = left.select("record_id", "source_id", "signal_digest").unionByName(right.select("record_id", "source_id", "signal_digest"))
    across = lambda df: df.filter(F.col("scope") == S.ACROSS)
    scratch = Scratch(both.sparkSession)
    with phase("screen by file"):
        by_file = scratch.table(across(duplicates.pairs_by_digest(files, S.BY_FILE)), "by_file")
    with phase("screen by signal"):
        by_signal = scratch.table(across(duplicates.pairs_by_digest(both.select("record_id", "source_id", F.col("signal_digest").alias("digest")), "signal")), "by_signal")
        found = scratch.table(duplicates.merge(by_file, by_signal), "found")
        rest = [scratch.table(duplicates.unmatched(side, found), name) for side, name in ((left, "left"), (right, "right"))]
    if all(side.isEmpty() for side in rest):
        return found, None
    with phase("screen by correlation"):
        held = [side() for side in waves] if waves else [side.select("record_id", "wave") for side in (left, right)]
        held = [side.filter("wave IS NOT NULL") for side in held]
        own = [wave.join(ids, "record_id", "left_semi") for wave, ids in zip(held, rest)]
        by_wave, note = duplicates.correlate_both(*held, *own, threshold=threshold)
        by_wave = [scratch.table(by_wave, "by_wave")] if by_wave is not None else []
    return duplicates.merge(by_file, by_signal, *by_wave), note


def first_declared(parsed: DataFrame, declared: DataFrame) -> DataFrame:
    """(record_id, source_id, digest): the first signal file of a record, in path order, that the manifest lists."""
    folder = F.regexp_extract("header_path", r"^(.*/)[^/]*$", 1)
    paths = parsed.select("record_id", "source_id", F.posexplode(F.array_sort("signal_paths")).alias("nth", "name"), folder.alias("folder"))
    listed = paths.select("record_id", "source_id", "nth", F.concat("folder", "name").alias("relative_path")).join(declared, "relative_path")
    return listed.groupBy("record_id", "source_id").agg(F.min_by("digest", "nth").alias("digest"))


def within(digests: DataFrame) -> DataFrame:
    """Fingerprint links inside each distribution; `digests` is (record_id, source_id, digest)."""
    own = digests.withColumn("digest", F.concat("source_id", F.lit(" "), "digest"))  # null stays null
    return duplicates.pairs_by_digest(own, S.BY_SIGNAL)


def screens(swept: list[Swept], phase=unprofiled) -> list[Screened]:
    """A screen of each corpus that has exactly two of these distributions, by corpus."""
    done = []
    for corpus, both in groupby(sorted(swept, key=lambda s: s.corpus), key=lambda s: s.corpus):  # the sort keeps the catalogue's order inside a corpus
        both = list(both)
        if len(both) == 2:
            left, right = both
            links, note = screen(left.judged, right.judged, left.files.unionByName(right.files), waves=(left.waves, right.waves), phase=phase)
            done.append(Screened(corpus, left, right, Scratch(links.sparkSession).table(links, "across"), note))
    return done


def linked(swept: list[Swept], phase=unprofiled) -> tuple[DataFrame, list[Screened]]:
    """All links, inside distributions and across pairs of them, and the screens they came from."""
    seen = None
    for one in swept:
        digests = one.judged.select("record_id", "source_id", F.col("signal_digest").alias("digest"))
        seen = digests if seen is None else seen.unionByName(digests)
    done = screens(swept, phase)
    links = within(seen)
    for one in done:
        links = links.unionByName(one.links)
    return links, done


def declared_of(spark: SparkSession, entry) -> DataFrame:
    """(relative_path, digest) of a catalogue row's manifest."""
    return manifest.parse_lines(manifest.read_lines(spark, entry["manifest"]), entry["manifest_prefix"])


def build(spark: SparkSession, source_ids: list[str] | None = None, catalogue: DataFrame | None = None, cache: str | None = None, phase=unprofiled) -> tuple[dict[str, DataFrame], list[Screened], DataFrame]:
    """The tables that need no code table, of the chosen distributions; the screens of paired corpora; what couldn't be read (record_id, error).

    `cache` is a folder of judged records that builds share; `phase(name)` is
    entered for each part of the work.
    """
    catalogue = catalog.only(catalog.sources(spark) if catalogue is None else catalogue, source_ids)
    made: dict[str, DataFrame] = {"source": catalog.source_table(catalogue)}
    swept = []
    for entry in catalogue.collect():  # the catalogue has a dozen rows
        with phase("sweep"):
            one, seen = sweep(spark, entry, declared_of(spark, entry), cache)
        swept.append(seen)
        for name, df in one.items():
            made[name] = made[name].unionByName(df) if name in made else df
    if not swept:
        return made | {name: empty(spark, name) for name in ("duplicate_link", "signal_group")}, [], spark.createDataFrame([], "record_id string, error string")
    links, done = linked(swept, phase)
    made["duplicate_link"] = shaped(links, "duplicate_link")
    made["signal_group"] = groups.signal_groups(made["quality"].select("record_id", F.col("signal_digest").alias("digest")), links)
    unread = swept[0].unread
    for one in swept[1:]:
        unread = unread.unionByName(one.unread)
    return made, done, unread


def label_pass(spark: SparkSession, tables: dict[str, DataFrame], code_tables: str, pins: dict[str, dict] | None = None, catalogue: DataFrame | None = None) -> dict[str, DataFrame]:
    """Propagated labels, code map and patients, from delivered tables and the folder of code tables."""
    paths = mappings.verified_mappings(code_tables, pins)
    patient = empty(spark, "patient")
    for entry in (catalog.sources(spark) if catalogue is None else catalogue).collect():  # a dozen rows
        patient = patient.unionByName(mappings.patients(spark, entry))
    links = tables["duplicate_link"] if "duplicate_link" in tables else empty(spark, "duplicate_link")
    return {
        "label_propagated": labels.propagate(tables["label"], links, tables["record"]),
        "label_map": mappings.label_map(spark, paths, pins), "patient": patient,
    }
