"""Components and groups under additions, pairs of large digest groups, and files of any size."""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalroot.functions import scalars as S
from signalroot.operators import duplicates, groups
from signalroot.operators.components import connected_components, extended
from signalroot.schemas import TABLES
from signalroot.sources import files, manifest


def reached(edges):
    """{node: smallest node of its component}."""
    up = {}

    def root(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        low, high = sorted((root(a), root(b)))
        up[high] = low
    return {x: root(x) for x in list(up)}


@pytest.mark.parametrize("seed", range(4))
def test_components_extended_equal_a_rebuild(spark, seed):
    rng = np.random.default_rng(seed)
    frame = lambda edges: spark.createDataFrame(edges, "a long, b long")
    draw = lambda n: [tuple(int(x) for x in rng.integers(0, 120, 2)) for _ in range(n)]
    edges = draw(40)
    now = connected_components(frame(edges))
    for batch in (draw(15), draw(1), [(500, 500), (7, 500)], draw(30)):
        edges += batch
        now = extended(now, frame(batch))
        got = [(r.node, r.component) for r in now.collect()]
        assert len(got) == len(set(got)) and dict(got) == reached(edges)
    assert dict((r.node, r.component) for r in extended(now, frame([]).limit(0)).collect()) == reached(edges)


def test_groups_extended_equal_a_rebuild(spark):
    rng = np.random.default_rng(5)
    digests = [(f"r{k:03}", None if k % 11 == 0 else f"d{rng.integers(60)}") for k in range(120)]
    links = [(a, b, "s", 1.0, "x") for a, b in (sorted((f"r{i:03}", f"r{k:03}")) for i, k in rng.integers(0, 120, (25, 2))) if a != b]
    some = lambda rows: spark.createDataFrame(rows, "record_id string, digest string")
    made = lambda rows: spark.createDataFrame(rows, TABLES["duplicate_link"])
    old_ids = {d[0] for d in digests[:80]}
    with_row = {d[0] for d in digests[:80] if d[1]}
    before = [x for x in links if x[0] in old_ids and x[1] in old_ids]
    after = [x for x in links if x not in before and all(e not in old_ids or e in with_row for e in x[:2])]
    now = groups.signal_groups(some(digests[:80]), made(before))
    got = sorted(tuple(r) for r in groups.extended_groups(now, some(digests[80:]), made(after)).collect())
    want = sorted(tuple(r) for r in groups.signal_groups(some(digests), made(before + after)).collect())
    assert got == want and any(x[0] in old_ids and x[1] in old_ids for x in links)
    assert sorted(tuple(r) for r in groups.extended_groups(now, some([]).limit(0)).collect()) == sorted(tuple(r) for r in now.collect())


def test_groups_make_every_digest_once(spark):
    """However often groups and their extension read digests and groups, what makes them runs once a row."""
    made = spark.sparkContext.accumulator(0)

    def digest(k):
        made.add(1)
        return None if k % 11 == 0 else f"d{k % 17}"

    rows = spark.range(120).select(F.concat(F.lit("r"), F.col("id").cast("string")).alias("record_id"), F.udf(digest)("id").alias("digest"), "id")
    found = groups.extended_groups(groups.signal_groups(rows.filter("id < 80")), rows.filter("id >= 80"))
    got = found.collect()
    assert made.value == 120
    assert len(got) == 109 and {r.group_size for r in got} == {6, 7}
    once = sorted(tuple(r) for r in groups.signal_groups(rows).collect())
    assert sorted(tuple(r) for r in got) == once and made.value == 240


def test_pairs_of_large_groups_are_made_once_and_spread(spark, monkeypatch):
    monkeypatch.setattr(duplicates, "BLOCK", 20)
    rows = [(f"a{k:04}", f"s{k % 3}", "hot") for k in range(310)] + [(f"b{k}", "s", "few") for k in range(3)] + [("c", "s", None), ("d", "s", "one"), ("d", "s", "one")]
    digests = spark.createDataFrame(rows, "record_id string, source_id string, digest string")
    found = duplicates.pairs_by_digest(digests, "signal")
    got = sorted((r.record_a, r.record_b, r.scope) for r in found.collect())
    hot = [x[0] for x in rows[:310]]
    want = [(a, b, S.WITHIN if int(a[1:]) % 3 == int(b[1:]) % 3 else S.ACROSS) for a, b in itertools.combinations(hot, 2)]
    want += [(a, b, S.WITHIN) for a, b in itertools.combinations(("b0", "b1", "b2"), 2)]
    assert got == sorted(want)


def test_pairs_of_a_very_large_group_go_to_many_tasks(spark):
    """20,000 equal digests: of the pieces that the join deals, none has more than a few of the pairs."""
    rows = spark.range(20_000).select(F.format_string("r%05d", "id").alias("record_id"), F.lit("s").alias("source_id"), F.lit("hot").alias("digest"))
    cut = rows.withColumn("mine", F.pmod(F.xxhash64("record_id"), F.lit(20)))
    assert cut.groupBy("mine").count().agg(F.max("count")).first()[0] < 1_300  # so a piece has at most 1,300 squared of 200 million
    assert duplicates.pairs_by_digest(rows, "signal").count() == 20_000 * 19_999 // 2


def test_a_file_of_more_than_two_gigabytes(spark, tmp_path):
    """A sparse file is hashed in chunks, through the same call as all others."""
    size = (1 << 31) + 5
    with open(tmp_path / "large.bin", "wb") as f:
        f.truncate(size)
    (tmp_path / "small.bin").write_bytes(b"abc")
    (tmp_path / "none.bin").touch()
    zeros = hashlib.sha256()
    block = bytes(1 << 20)
    for _ in range(size >> 20):
        zeros.update(block)
    zeros.update(bytes(size & (1 << 20) - 1))
    got = {r.relative_path: r.digest for r in manifest.file_digests(spark, str(tmp_path)).collect()}
    assert got == {"large.bin": zeros.hexdigest(), "small.bin": hashlib.sha256(b"abc").hexdigest(), "none.bin": hashlib.sha256(b"").hexdigest()}


def test_files_that_only_spark_reads(spark, tmp_path, monkeypatch):
    (tmp_path / "small.bin").write_bytes(b"abc")
    monkeypatch.setattr(files, "reachable", lambda path: False)
    assert [r.digest for r in manifest.file_digests(spark, str(tmp_path)).collect()] == [hashlib.sha256(b"abc").hexdigest()]


def test_a_manifest_in_many_blocks(spark, tmp_path):
    """Lines keep their order over the blocks of a file: of a repeated path the last one holds."""
    digest = lambda k: hashlib.sha256(str(k).encode()).hexdigest()
    n = 40_000
    (tmp_path / "SUMS").write_text("".join(f"{digest(k)}  p/{k % 1000}\r\n" for k in range(n)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "128k")
    try:
        lines = manifest.read_lines(spark, f"{tmp_path}/SUMS")
        assert lines.rdd.getNumPartitions() > 8
        got = {r.relative_path: r.digest for r in manifest.parse_lines(lines, "p/").collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert got == {str(k % 1000): digest(k) for k in range(n - 1000, n)}
