"""python -m signalroot verify|scan|build|derive|screen|label|copies|trace: passes over the catalogue.

`build` reads signals; `screen` links again from delivered fingerprints, `derive` from delivered links; `label` adds the
tables that need code tables; `copies` opens a sample of the groups in one source that share a fingerprint.
Exit codes: 0 all holds, 1 something doesn't or nothing repeats, 2 an input is absent.
"""

from __future__ import annotations

import argparse
import json
import os
import sys

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from .lock import Lock
from .operators import groups, labels
from .plans import build, copies, reports
from .plans.profile import Profile
from .schemas import empty, shaped
from .scratch import Scratch
from .sources import catalog, delivery, headers, manifest, mappings


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="signalroot", description=__doc__)
    parser.add_argument("action", choices=["verify", "scan", "build", "derive", "screen", "label", "copies", "trace"])
    parser.add_argument("--source", action="append", help="a source id; may be repeated")
    parser.add_argument("--out", default="delivery", help="folder of the delivered tables")
    parser.add_argument("--record", help="record id to trace")
    parser.add_argument("--sample", type=int, default=20, help="size of the sample that `copies` draws")
    parser.add_argument("--seed", type=int, default=0, help="draws another sample for `copies`")
    parser.add_argument("--mappings", default=os.environ.get(mappings.MAPPINGS_ENV, "mappings"), help="folder of the code tables")
    parser.add_argument("--reports", help="folder that reports are written to as JSON, beside being printed")
    parser.add_argument("--cache", help="folder of judged records; `build` decodes only what is new or changed there")
    parser.add_argument("--profile", action="store_true", help="`build` and `screen` also report what each phase cost")
    parser.add_argument("--locks", default=os.environ.get("SIGNALROOT_LOCK_DIR", ".locks"))
    options = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    say = Reports(options.reports)
    wanted = catalog.only(catalog.sources(spark), options.source)
    if options.action == "trace":
        delivery.connect(spark, options.out)
        found = delivery.trace(spark, options.record or "")
        print(json.dumps(found))
        return 0 if found else 1
    entries = wanted.collect()  # a dozen rows
    if options.action == "scan":
        for e in entries:
            found = Scratch(spark).table(headers.scan(spark, e["directory"], e["source_id"]), "headers")
            say(reports.header_summary(found).withColumn("source_id", F.lit(e["source_id"])), "record_scan", e)
            say(reports.unit_spellings(found).withColumn("source_id", F.lit(e["source_id"])), "unit_spellings", e)
        return 0
    if options.action in ("derive", "label"):
        have = {name: delivery.read(spark, options.out, name) for name in delivery.present(spark, options.out)}
        if "record" not in have or ("quality" if options.action == "derive" else "label") not in have:
            return 2
        if options.action == "label" and not os.path.isdir(options.mappings):
            return 2
        with Lock("heavy", options.locks, options.action):
            if options.action == "label":
                delivery.write(build.label_pass(spark, have, options.mappings), options.out)
                _print_labels(spark, options, say)
            else:
                _derive(spark, have, options.out)
        return 0
    if options.action == "copies":
        if "quality" not in delivery.present(spark, options.out) or not entries:
            return 2
        with Lock("heavy", options.locks, options.action):
            held = [_copies(spark, e, options, say) for e in entries]
        return 0 if any(held) else 1
    if not entries or not all(os.path.exists(e["manifest"]) for e in entries):
        return 2
    profile = Profile(spark)
    with Lock("heavy", options.locks, options.action):
        if options.action == "build":
            made, screens, unread = build.build(spark, options.source, cache=options.cache, phase=profile.phase)
            with profile.phase("write"):
                delivery.write(made, options.out)
            _profiled(profile, options, say)
            _print_build(spark, options.out, screens, say)
            say(unread.groupBy("error").agg(F.count(F.lit(1)).alias("n_unread"), F.min("record_id").alias("first_unread")).orderBy("error"), "unread")
            return 0
        if options.action == "screen":
            if "quality" not in delivery.present(spark, options.out):
                return 2
            quality = delivery.read(spark, options.out, "quality")
            links, screens = build.linked([build.reswept(spark, e, build.declared_of(spark, e), quality) for e in entries], profile.phase)
            with profile.phase("write"):
                delivery.write({"duplicate_link": shaped(links, "duplicate_link")}, options.out)
            _profiled(profile, options, say)
            have = {name: delivery.read(spark, options.out, name) for name in delivery.present(spark, options.out)}
            _derive(spark, have, options.out)
            _print_build(spark, options.out, screens, say)
            return 0
        holds = True
        for e in entries:
            result = manifest.report(manifest.verify(build.declared_of(spark, e), manifest.file_digests(spark, e["directory"])))
            result = Scratch(spark).table(result, "report")  # files are hashed once
            say(result.withColumn("source_id", F.lit(e["source_id"])), "manifest_report", e)
            holds &= bool(result.first()["holds"])
        return 0 if holds else 1


def _profiled(profile: Profile, options, say) -> None:
    if options.profile:
        say(profile.report(), "profile")
        say(profile.top_stages(), "profile_stages")


def _derive(spark: SparkSession, have: dict, out: str) -> None:
    """The groups, and what labels there are to propagate, from delivered tables and links."""
    links = have.get("duplicate_link", empty(spark, "duplicate_link"))
    made = {"signal_group": groups.signal_groups(have["quality"].select("record_id", F.col("signal_digest").alias("digest")), links)}
    if "label" in have:
        made["label_propagated"] = labels.propagate(have["label"], links, have["record"])
    delivery.write(made, out)


def _copies(spark: SparkSession, entry, options, say) -> bool:
    """Reports what a sample of the groups of one source shows; False if nothing repeats there."""
    quality = delivery.read(spark, options.out, "quality").filter(F.startswith("record_id", F.lit(f"{entry['source_id']}:")))
    groups = copies.repeated(quality.select("record_id", F.col("signal_digest").alias("digest")))
    n = groups.count()
    if not n:
        print(f"no two records of {entry['source_id']} share a fingerprint", file=sys.stderr)
        return False
    pairs = copies.chosen(groups, options.sample, options.seed)
    compared = Scratch(spark).table(copies.opened(spark, pairs, entry["directory"], entry["source_id"]), "compared")
    say(copies.summary(compared).withColumns({"source_id": F.lit(entry["source_id"]), "n_groups": F.lit(n), "seed": F.lit(options.seed)}), "copies", entry)
    say(compared, "copies_compared", entry)
    return True


def _print_build(spark: SparkSession, out: str, screens: list[build.Screened], say) -> None:
    tables = {name: delivery.read(spark, out, name) for name in delivery.present(spark, out)}
    quality = tables["quality"].join(tables["record"].select("record_id", "source_id"), "record_id")
    say(reports.quality_summary(quality, ["source_id"]).orderBy("source_id"), "quality_scan")
    say(reports.within_summary(quality.select("source_id", F.col("signal_digest").alias("digest")), ["source_id"]).orderBy("source_id"), "within_scan")
    say(reports.database_report(tables), "database_tables")
    say(reports.database_figures(tables), "database_report")
    say(reports.traced_example(delivery.traced(tables["record"], tables["source_file"])), "traced_example")
    for s in screens:
        ids = [side.judged.select("record_id", "source_id") for side in (s.left, s.right)]
        found = reports.screen_report(*ids, s.links, s.note)
        say(found.withColumns({"corpus": F.lit(s.corpus), "left": F.lit(s.left.source_id), "right": F.lit(s.right.source_id)}), f"duplicate_scan/corpus={s.corpus}")


def _print_labels(spark: SparkSession, options, say) -> None:
    t = {name: delivery.read(spark, options.out, name) for name in delivery.present(spark, options.out)}
    say(reports.label_report(t["label"], t["label_propagated"], t["label_map"], t["patient"]), "label_report")
    published = mappings.published_counts(spark, os.path.join(options.mappings, mappings.SCORED))
    compared = labels.compare_with_published(published, labels.counts_per_source(t["label"], t["record"]))
    say(labels.agreement(compared), "published_cells")
    say(labels.disagreements(compared), "published_disagreements")


class Reports:
    """Prints small reports, and writes them below a folder if there is one."""

    def __init__(self, directory: str | None):
        self.directory = directory

    def __call__(self, report, name: str, entry=None) -> None:
        report = Scratch(report.sparkSession).table(report, "report")  # computed once, for both
        for row in report.collect():  # a report's few rows
            print(json.dumps(row.asDict(recursive=True)))
        if self.directory:
            part = f"/source={entry['source_id'].replace('/', '_')}" if entry else ""
            delivery.write_report(report, self.directory, name + part)


if __name__ == "__main__":
    sys.exit(main())
