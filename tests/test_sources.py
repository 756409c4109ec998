"""The header source, the layout of delivered tables, and profiles."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from signalroot.plans.profile import Profile
from signalroot.schemas import TABLES
from signalroot.sources import delivery, files, header_source, headers
from signalroot.sources.header_source import HeaderReader


def tree(root):
    for folder in ("g1", "g1/deep", "g2", "h"):
        (root / folder).mkdir(parents=True, exist_ok=True)
        for k in range(7):
            (root / folder / f"r{k}.hea").write_text(f"r{k} 1 500 100\nr{k}.dat 16 200/mV 16 0 0 0 0 I\n# Age: {k}\n")
    (root / "top.hea").write_text("top 1 250\ntop.dat 212 100 12 0 0 0 0 é\n")
    (root / "g1" / "x.dat").write_bytes(b"\x00\x01")
    (root / "g1" / "_hidden.hea").write_text("no")


def test_headers_through_the_source_and_through_spark(spark, tmp_path, monkeypatch):
    tree(tmp_path)
    facts = lambda: sorted(map(str, headers.scan(spark, str(tmp_path), "s").collect()))
    mine = facts()
    assert len(mine) == 29
    monkeypatch.setattr(files, "reachable", lambda path: False)
    assert facts() == mine


def test_filters_reach_the_listing(spark, tmp_path):
    tree(tmp_path)
    before = spark.conf.get("spark.sql.python.filterPushdown.enabled")
    spark.conf.set("spark.sql.python.filterPushdown.enabled", True)
    try:
        loaded = header_source.load(spark, str(tmp_path))
        names = lambda df: sorted(r.header_path for r in df.collect())
        assert len(names(loaded)) == 29 and loaded.select("header_path").columns == ["header_path"]
        (tmp_path / "g2" / "r0.hea").chmod(0)
        assert names(loaded.filter(F.startswith("header_path", F.lit("g1/deep/")))) == [f"g1/deep/r{k}.hea" for k in range(7)]
        assert names(loaded.filter("header_path = 'h/r3.hea' AND text LIKE '%Age: 3%'")) == ["h/r3.hea"]
        assert names(loaded.filter("header_path IN ('h/r3.hea', 'top.hea', 'none.hea')")) == ["h/r3.hea", "top.hea"]
        assert names(loaded.filter("header_path = 'h/r3.hea' AND header_path LIKE 'g1/%'")) == []
    finally:
        spark.conf.set("spark.sql.python.filterPushdown.enabled", before)


def test_only_folders_that_may_hold_a_path_are_listed(tmp_path):
    tree(tmp_path)
    reader = HeaderReader(str(tmp_path), 4)
    assert reader.listed()[1] == 5 and [len(p.paths) for p in reader.partitions()] == [4] * 7 + [1]
    reader.prefixes = [("g1/deep/r1.hea",)]
    assert reader.listed() == (["g1/deep/r1.hea"], 3)
    reader.prefixes = [("g1/", "h/"), ("h",)]
    assert reader.listed() == ([f"h/r{k}.hea" for k in range(7)], 2)


def test_an_empty_folder(spark, tmp_path):
    assert headers.scan(spark, str(tmp_path), "s").count() == 0


def scanned(df) -> int:
    """Rows that the scans of an executed plan put out."""
    plan, found = df._jdf.queryExecution().executedPlan(), []

    def walk(node):
        if node.nodeName().startswith("Scan parquet"):
            found.append(node.metrics().apply("numOutputRows").value())
        inner = node.executedPlan() if node.nodeName().startswith("AdaptiveSparkPlan") else node.plan() if "QueryStage" in node.nodeName() else None
        for child in [inner] if inner is not None else [node.children().apply(k) for k in range(node.children().size())]:
            walk(child)

    walk(plan)
    return sum(found)


def test_a_look_up_reads_one_file_of_a_table(spark, tmp_path):
    rows = spark.range(40_000).select(F.format_string("s:%05d", (F.col("id") * 7919) % 40_000).alias("record_id"), F.lit("s").alias("source_id"))
    table = rows.withColumns({f.name: F.lit(None).cast(f.dataType) for f in TABLES["record"] if f.name not in rows.columns})
    before = {k: spark.conf.get(k) for k in ("spark.sql.adaptive.coalescePartitions.enabled", "spark.sql.shuffle.partitions")}
    for k, v in zip(before, ("false", "8")):
        spark.conf.set(k, v)
    try:
        delivery.write({"record": table}, str(tmp_path))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    back = delivery.read(spark, str(tmp_path), "record")
    assert back.count() == 40_000 and len(list((tmp_path / "record").glob("part-*.parquet"))) == 8
    one = back.filter("record_id = 's:20001'")
    assert len(one.collect()) == 1 and scanned(one) <= 40_000 // 4  # of about 5,000 rows a file
    none = back.filter("record_id = 's:20001x'")  # inside a range: the bloom filter says no
    assert none.collect() == [] and scanned(none) == 0


def test_profile_counts_each_phase(spark):
    profile = Profile(spark)
    with profile.phase("sort"):
        assert spark.range(100_000).repartition(3).orderBy(F.rand(1)).count() == 100_000
    with profile.phase("nothing"):
        pass
    spark.range(10).count()  # in no phase
    with profile.phase("sort"):
        spark.range(1000).groupBy((F.col("id") % 7).alias("k")).count().collect()
    got = {r.phase: r for r in profile.report().collect()}
    assert list(got) == ["sort", "nothing"]
    assert got["sort"].jobs >= 2 and got["sort"].tasks >= 5 and got["sort"].shuffle_write_bytes > 0 and got["sort"].task_seconds > 0 and got["sort"].seconds > 0
    assert got["nothing"].jobs == got["nothing"].stages == 0
    top = profile.top_stages(2).collect()
    assert len(top) == 2 and {r.phase for r in top} == {"sort"} and top[0].peak_execution_bytes >= top[1].peak_execution_bytes
    assert spark.sparkContext.getLocalProperty("spark.jobGroup.id") is None
