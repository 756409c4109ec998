"""The jobs on copies of small tables: results, reruns, growing input, command line."""

from __future__ import annotations

import hashlib
import json
import logging
import os
import subprocess
import sys
from pathlib import Path

import pytest

from jobs import arrivals, leak_safe_split
from signalroot.operators import labels
from signalroot.schemas import TABLES

SF = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def write(spark, rows, path, name):
    """One more Parquet file in a table's folder."""
    spark.createDataFrame(rows, DOCS).coalesce(1).write.parquet(f"{path}/{name}")
    part = next(Path(f"{path}/{name}").glob("part-*.parquet"))
    Path(path, "documents.parquet").mkdir(exist_ok=True)
    part.rename(Path(path, "documents.parquet", f"{name}.parquet"))


def doc(k, text, source="s", n=None):
    return k, text, "en", source, len(text or "") if n is None else n


def test_folds_are_shares_of_all_draws():
    assert leak_safe_split.bounds("a=1,b=1") == [("a", "80000000"), ("b", "g")]
    for wrong in ("", "a", "a=0", "a=-1,b=2", "=1"):
        with pytest.raises(ValueError):
            leak_safe_split.bounds(wrong)


def test_split(spark, tmp_path):
    rows = [doc(1, "One two"), doc(2, "one  TWO", "t"), doc(3, "x\ny\nZ"), doc(4, "Z\nx\ny"), doc(5, "z\nX\nY", None), doc(6, None), doc(7, None), doc(8, "alone"), (None, "one two", "en", "s", 7), doc(9, ""), doc(9, "")]
    write(spark, rows, tmp_path, "a")
    spark.createDataFrame([(2, 1, 1), (4, 1, 0), (99, 1, 1), (7, 0, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    out = f"{tmp_path}/out"
    first = {r.record_id: r.asDict() for r in leak_safe_split.run(spark, str(tmp_path), out, "a=1,b=1", "7").collect()}
    again = {r.record_id: r.asDict() for r in leak_safe_split.run(spark, str(tmp_path), out, "a=1,b=1", "7").collect()}
    assert first == again and len(first) == 10
    group = {k: r["signal_group_id"] for k, r in first.items()}
    # 3 and 4 have the same lines, 4 and 5 nothing: z X Y are the words of Z x y in another case
    assert group["s:1"] == group["t:2"] == group["s:"] == "s:" and group["s:3"] == group["s:4"] == group[":5"] == ":5" and first["s:4"]["group_size"] == 3
    assert len({group[k] for k in ("s:6", "s:7", "s:8", "s:9")}) == 4
    assert first["s:1"]["codes"] == "good|toxic" and first["s:1"]["via_record_id"] == "t:2" and first["t:2"]["via_record_id"] is None
    assert first["s:3"]["codes"] is None and first[":5"]["codes"] == "good" and first["s:7"]["codes"] is None
    for r in first.values():
        draw = hashlib.sha256(f"7:{r['signal_group_id']}".encode()).hexdigest()[:8]
        assert r["fold"] == ("a" if draw < "80000000" else "b")
    assert {p.name for p in Path(out, "records").iterdir() if p.is_dir()} <= {"fold=a", "fold=b"}
    assert sum(r.n for r in spark.read.json(f"{out}/balance").filter("code = 'good'").collect()) == 5
    grown = [doc(20, "quite new")]
    write(spark, grown, tmp_path, "b")
    more = {r.record_id: r.asDict() for r in leak_safe_split.run(spark, str(tmp_path), out, "a=1,b=1", "7").collect()}
    assert {k: more[k] for k in first} == first and len(more) == 11


def test_labels_travel_along_equal_digests(spark):
    label = spark.createDataFrame([("b", "v", "1", "f", "h"), ("b", "v", "1", "f", "h"), ("c", "v", "2", "f", "h"), ("x", "v", "3", "f", "h")], TABLES["label"])
    digests = spark.createDataFrame([("a", "s", "d"), ("b", "s", "d"), ("c", "s", "d"), ("e", None, "d"), ("f", "s", None), ("g", "s", "alone")], "record_id string, source_id string, digest string")
    got = sorted(tuple(r) for r in labels.propagate_by_digest(label, digests).collect())
    assert got == sorted([(t, s, "v", "1", "propagated from b", "linked record", "b") for t, s in (("a", "s"), ("e", None))] * 2, key=str)


def test_arrivals_take_only_what_is_new(spark, tmp_path, caplog):
    caplog.set_level(logging.INFO, "arrivals")
    first = [doc(1, "same"), doc(2, "same", "t"), doc(3, "other"), doc(4, None), doc(5, "", "t"), doc(6, "é wrong", "t", 99), (None, "same", "en", None, None)]
    write(spark, first, tmp_path, "a")
    args = str(tmp_path), f"{tmp_path}/ledger", f"{tmp_path}/checkpoint"
    facts = lambda df: {r.record_id: (r.arrival, r.outcome, r.first_record_id, r.scope, r.declared_holds) for r in df.collect()}
    got = facts(arrivals.run(spark, *args))
    assert got == {
        ":": (0, "first", ":", None, False), "s:1": (0, "repeat", ":", "across-distributions", True), "t:2": (0, "repeat", ":", "across-distributions", True), "s:3": (0, "first", "s:3", None, True),
        "s:4": (0, "blank", None, None, True), "t:5": (0, "blank", None, None, True), "t:6": (0, "first", "t:6", None, False),
    }
    assert "read 7 new rows" in caplog.text
    caplog.clear()
    assert facts(arrivals.run(spark, *args)) == got and "read 0 new rows" in caplog.text  # nothing new, nothing changes
    before = {p: p.stat().st_mtime_ns for p in Path(args[1]).rglob("part-*.parquet")}
    write(spark, [doc(7, "other", "s"), doc(8, "new"), doc(8, "new"), doc(3, "other")], tmp_path, "b")
    caplog.clear()
    grown = facts(arrivals.run(spark, *args))
    assert "read 4 new rows" in caplog.text
    assert {k: v for k, v in grown.items() if v[0] == 0 and k != "s:3"} == {k: v for k, v in got.items() if k != "s:3"}
    assert grown["s:7"] == (1, "repeat", "s:3", "within-distribution", True) and grown["s:8"][:3] == (1, "first", "s:8")
    assert all(p.stat().st_mtime_ns == t for p, t in before.items())  # older partitions weren't written again
    assert arrivals.ledger(spark, args[1]).count() == 11


def test_an_arrival_that_is_repeated_writes_the_same(spark, tmp_path):
    """The commit of the last arrival is lost, as in a crash after its rows were written."""
    write(spark, [doc(1, "a"), doc(2, "b")], tmp_path, "a")
    args = str(tmp_path), f"{tmp_path}/ledger", f"{tmp_path}/checkpoint"
    arrivals.run(spark, *args)
    write(spark, [doc(3, "a"), doc(4, "c")], tmp_path, "b")
    want = sorted(map(str, arrivals.run(spark, *args).collect()))
    for p in Path(args[2], "commits").glob("*1*"):
        p.unlink()
    assert sorted(map(str, arrivals.run(spark, *args).collect())) == want and len(want) == 4


def test_arrivals_in_several_batches(spark, tmp_path):
    for k in range(3):
        write(spark, [doc(10 * k, "same"), doc(10 * k + 1, f"text {k}")], tmp_path, f"f{k}")
    got = arrivals.run(spark, str(tmp_path), f"{tmp_path}/ledger", f"{tmp_path}/checkpoint", 1)
    assert got.select("arrival").distinct().count() == 3 and got.filter("outcome = 'repeat'").count() == 2 and got.count() == 6


def test_command_line(tmp_path):
    """Each job by its config, with settings from the arguments."""
    env = os.environ | {"SPARK_CONF_DIR": str(tmp_path), "PYSPARK_SUBMIT_ARGS": "--master local[2] pyspark-shell"}
    config = {"tables": SF, "out": f"{tmp_path}/none", "folds": "train=80,validation=10,test=10", "seed": "1"}
    Path(tmp_path, "c.json").write_text(json.dumps(config, indent=2))
    done = subprocess.run([sys.executable, "-m", "jobs.leak_safe_split", "--config", f"{tmp_path}/c.json", "--set", f"out={tmp_path}/out"], env=env, capture_output=True, text=True, timeout=300, cwd=Path(__file__).parents[1])
    assert done.returncode == 0, done.stderr[-2000:]
    assert "read 200 documents" in done.stderr and "wrote records by fold" in done.stderr and Path(tmp_path, "out", "records", "_SUCCESS").exists()
    done = subprocess.run([sys.executable, "-m", "jobs.arrivals", "--set", f"tables={SF}", "--set", f"out={tmp_path}/l", "--set", f"checkpoint={tmp_path}/k"], env=env, capture_output=True, text=True, timeout=300, cwd=Path(__file__).parents[1])
    assert done.returncode == 0 and "read 200 new rows" in done.stderr, done.stderr[-2000:]
