"""Semantics of the operators on small inputs with known answers."""

from __future__ import annotations

import hashlib
import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from signalroot import lock
from signalroot.functions import arrays as A
from signalroot.functions import scalars as S
from signalroot.operators import duplicates, groups, labels, tables
from signalroot.operators.components import connected_components
from signalroot.plans import build, copies, reports
from signalroot.schemas import HEADER, TABLES
from signalroot.sources import catalog, delivery, headers, manifest, mappings, signals

HEADER_TEXT = "g1/r 2 500 5000\nr.mat 16+24 1000(-7)/mV 16 0 5 -3 0 I\nr.mat 16+24 200 16 3 5 -3 0 vx\n# Age: 35\n# Sex:\n#Sex: Male\n# Dx: 1, 2,,2\n"


def one(spark, expr, **values):
    df = spark.range(1).select(*[F.lit(v).alias(k) for k, v in values.items()])
    return df.select(expr).first()[0]


def test_scalars(spark):
    assert one(spark, S.canonical_lead("x"), x=" avr ") == "aVR"
    assert one(spark, S.canonical_lead("x"), x="vx") is None
    assert one(spark, S.bundle_id("x"), x=1234567) == "HR1234567"
    assert [one(spark, S.concept_id("x"), x=x) for x in ("4065390.0", "nan", " ", "None")] == ["4065390", None, None, None]
    assert one(spark, S.right_of("x", "/"), x="a/b/c") == "b/c"
    assert one(spark, S.stem("x"), x="a/b/c.d.hea") == "c.d"
    assert one(spark, S.comment_value(F.array(F.lit("Sex:"), F.lit("Sex: Male")), "sex")) is None
    assert one(spark, S.units_are_declared(F.array().cast("array<string>"))) is False


def test_headers(spark):
    texts = spark.createDataFrame([("s/a", "g1/r.hea", HEADER_TEXT)], "source_id string, header_path string, text string")
    row = headers.parse(texts).first()
    assert (row.record_id, row.n_leads, row.sampling_rate_hz, row.n_samples) == ("s/a:r", 2, 500.0, 5000)
    assert (row.age, row.sex, row.dx, row.signal_paths) == ("35", None, ["1", "2", "", "2"], ["r.mat"])
    assert row.units_declared == ["mV"] and not row.units_are_declared
    first, second = row.leads
    assert (first.name_canonical, first.gain, first.baseline, first.units_declared) == ("I", 1000.0, -7, "mV")
    assert (second.name_canonical, second.gain, second.baseline, second.units_declared) == (None, 200.0, 3, "")
    parsed = headers.parse(texts)
    assert tables.records(parsed).first().signal_file_id == "s/a:g1/r.mat"
    assert tables.records(parsed).first().duration_s == 10.0
    files = tables.source_files(parsed, spark.createDataFrame([("s/a", "g1/r.mat", "d")], "source_id string, relative_path string, digest string"))
    assert {(r.role, r.sha256_declared) for r in files.collect()} == {("header", None), ("signal", "d")}
    assert [(r.code, r.source_field, r.asserted_by) for r in tables.labels(parsed).collect()] == [(c, "header comment Dx", "corpus") for c in ("1", "2", "", "2")]
    assert tables.leads(parsed).count() == 2
    assert reports.header_summary(parsed).first().n_non_canonical_leads == 1


def _record(folder, name, samples, fs=500):
    os.makedirs(folder, exist_ok=True)
    n, k = samples.shape
    lines = [f"{name} {k} {fs} {n}"] + [f"{name}.dat 16 100(0)/mV 16 0 0 0 0 {lead}" for lead in S.CANONICAL_LEADS[:k]]
    (folder / f"{name}.hea").write_text("\n".join(lines) + "\n# Dx: 7\n")
    (folder / f"{name}.dat").write_bytes(samples.astype("<i2").tobytes())


def test_build(spark, tmp_path):
    rng = np.random.default_rng(0)
    x = rng.integers(-900, 900, (5200, 12))
    _record(tmp_path / "d", "r1", x)
    _record(tmp_path / "d", "r2", x)
    _record(tmp_path / "d", "r3", rng.integers(-900, 900, (5200, 11)))
    listed = {f"{p}": hashlib.sha256((tmp_path / "d" / p).read_bytes()).hexdigest() for p in ("r1.dat", "r2.dat", "r3.hea")}
    (tmp_path / "SUMS").write_text("".join(f"{d} {p}\n" for p, d in listed.items()))
    entry = ("x/a", "a", "x", "1", "p", None, "a", str(tmp_path), "d", "SUMS", "")
    spark_catalogue = spark.createDataFrame([entry], catalog.COLUMNS).withColumns({"directory": F.concat("root", F.lit("/d")), "manifest": F.concat("root", F.lit("/SUMS")), "url": F.lit("")})
    made, screens, unread = build.build(spark, catalogue=spark_catalogue)
    assert unread.count() == 0
    assert screens == []
    assert made["record"].count() == 3 and made["lead"].count() == 35 and made["source_file"].filter("sha256_declared is not null").count() == 3
    quality = {r.record_id: r for r in made["quality"].collect()}
    window = (x[:5000, :].T / 100).astype(np.float32)
    assert quality["x/a:r1"].signal_digest == signals.digest_of(window) and quality["x/a:r1"].holds
    assert quality["x/a:r3"].signal_digest is None and quality["x/a:r3"].missing_leads == "V6" and quality["x/a:r3"].n_samples_read == 0
    assert {(r.record_id, r.signal_group_id, r.group_size) for r in made["signal_group"].collect()} == {("x/a:r1", "x/a:r1", 2), ("x/a:r2", "x/a:r1", 2)}
    delivery.write(made, f"file://{tmp_path}/out")
    assert delivery.connect(spark, f"file://{tmp_path}/out") == [t for t in TABLES if t in made]
    assert delivery.trace(spark, "x/a:r1")["relative_path"] == "r1.dat"
    assert delivery.trace(spark, "none") is None
    (tmp_path / "e").mkdir()
    (tmp_path / "e" / "empty.dat").write_bytes(b"")
    assert [r.digest for r in manifest.file_digests(spark, f"{tmp_path}/e").collect()] == [hashlib.sha256(b"").hexdigest()]
    observed = manifest.file_digests(spark, f"{tmp_path}/d")
    declared = manifest.parse_lines(manifest.read_lines(spark, f"{tmp_path}/SUMS"))
    assert manifest.report(manifest.verify(declared, observed)).first().holds
    assert manifest.verify(declared, manifest.file_digests(spark, f"{tmp_path}/d")).filter("outcome = 'unlisted'").count() == 3


def test_leads_in_several_files(spark, tmp_path):
    x = np.random.default_rng(3).integers(-900, 900, (5200, 14))
    names = [*S.CANONICAL_LEADS, "vx", "vy"]
    of = ["r.xyz" if k in (1, 12, 13) else "r.dat" for k in range(14)]  # one canonical lead lies in the other file
    for name in ("r", "lost"):
        lines = [f"{name} 14 500 5200"] + [f"{f.replace('r.', name + '.')} 16 100(0)/mV 16 0 0 0 0 {n}" for f, n in zip(of, names)]
        (tmp_path / f"{name}.hea").write_text("\n".join(lines) + "\n")
    for f in ("r.dat", "r.xyz"):
        (tmp_path / f).write_bytes(x[:, [k for k in range(14) if of[k] == f]].astype("<i2").tobytes())
    (tmp_path / "lost.dat").write_bytes((tmp_path / "r.dat").read_bytes())  # its other file isn't there
    judged = signals.judged(spark, headers.scan(spark, str(tmp_path), "s/a"), str(tmp_path))
    assert [(r.record_id, "lost.xyz" in r.error) for r in judged.filter("error IS NOT NULL").collect()] == [("s/a:lost", True)]
    got = judged.filter("error IS NULL").collect()
    assert [(r.record_id, r.signal_digest, r.n_samples_read) for r in got] == [("s/a:r", signals.digest_of((x[:5000, :12].T / 100).astype(np.float32)), 5000)]


def test_digest_equals_expression(spark):
    rng = np.random.default_rng(1)
    w = rng.normal(0, 1, (2, 50)).astype(np.float32)
    w[0, :4] = [np.nan, np.inf, 0.005, -0.015]
    df = spark.createDataFrame([(w.tolist(),)], "w array<array<float>>")
    assert df.select(A.signal_digest("w")).first()[0] == signals.digest_of(w)


def test_faults(spark):
    cases = {"flat": [1.0] * 300, "pinned": list(range(400)) + [399] * 5, "fine": list(np.random.default_rng(0).normal(size=1000)), "nothing": [float("nan")] * 5, "few": [1.0, 2.0]}
    df = spark.createDataFrame([(k, [float(x) for x in v]) for k, v in cases.items()], "k string, x array<float>")
    got = {r[0]: (r[1], r[2]) for r in df.select("k", A.is_flat("x"), A.is_saturated("x")).collect()}
    assert got == {"flat": (True, False), "pinned": (False, True), "fine": (False, False), "nothing": (True, False), "few": (False, True)}
    assert signals.faults_of(np.array([cases["flat"][:300]] + [[float(i) for i in range(300)]] * 11, np.float32))[0] == ["I"]


def test_manifest_lines(spark):
    digest = "a" * 64
    lines = lambda *x: spark.createDataFrame(list(enumerate(x)), "line_no long, line string")
    got = manifest.parse_lines(lines(f"{digest} p/a", "", f"{'B' * 64} *p/a", f"{digest}  q/c"), "p/").collect()
    assert [(r.relative_path, r.digest) for r in got] == [("a", "B" * 64)]  # as written
    with pytest.raises(Exception, match="not a manifest line"):
        manifest.parse_lines(lines(f"{digest} p/a", "   ")).collect()
    with pytest.raises(Exception, match="not a manifest line"):
        manifest.parse_lines(lines(f"{digest} p/a", "short q/b"), "p/").collect()
    d = spark.createDataFrame([("a", "1"), ("b", "2"), ("c", "3")], "relative_path string, digest string")
    o = spark.createDataFrame([("a", "1"), ("b", "x"), ("d", "4")], "relative_path string, digest string")
    assert {r.relative_path: r.outcome for r in manifest.verify(d, o).collect()} == {"a": "matched", "b": "mismatched", "c": "missing", "d": "unlisted"}
    assert "missing" not in {r.outcome for r in manifest.verify(d, o, subset=True).collect()}


def test_merge_and_unmatched(spark):
    link = lambda *rows: spark.createDataFrame(list(rows), TABLES["duplicate_link"])
    a = link(("a", "b", "file", 1.0, "across"))
    b = link(("a", "b", "signal", 1.0, "across"), ("a", "c", "correlation", 0.991, "across"))
    c = link(("a", "c", "correlation", 0.995, "across"))
    assert [(r.record_a, r.record_b, r.sieve, r.score) for r in duplicates.merge(a, b, c).collect()] == [("a", "b", "file", 1.0), ("a", "c", "correlation", 0.995)]
    ids = spark.createDataFrame([("a",), ("z",), ("d",)], "record_id string")
    assert [r[0] for r in duplicates.unmatched(ids, a).collect()] == ["d", "z"]


def test_correlate(spark):
    rng = np.random.default_rng(2)
    w = rng.normal(5000, 1, 500)
    t = spark.createDataFrame([("t1", w.tolist()), ("t2", [1.0] * 500)], "record_id string, wave array<double>")
    c = spark.createDataFrame([("c2", (w * 3.27)[:300].tolist(), 2), ("c1", (w * 2).tolist(), 1), ("c3", rng.normal(size=500).tolist(), 0)], "record_id string, wave array<double>, ordinal long")
    got = duplicates.correlate(t, c).collect()
    assert [(r.record_a, r.record_b) for r in got] == [("c1", "t1")] and got[0].score > 0.999999
    with pytest.raises(duplicates.PairCapExceeded):
        duplicates.correlate(t, c, max_pairs=5)
    links, note = duplicates.correlate_both(c, c, t, c, max_pairs=6)
    assert links is not None and "more than 6" in note


def test_groups_count_members_without_fingerprint(spark):
    digests = spark.createDataFrame([("b", "x"), ("c", "x"), ("a", None), ("d", "y")], "record_id string, digest string")
    links = spark.createDataFrame([("a", "b", "signal", 1.0, "across"), ("d", "ghost", "signal", 1.0, "across")], TABLES["duplicate_link"])
    got = {(r.record_id, r.signal_group_id, r.group_size) for r in groups.signal_groups(digests, links).collect()}
    assert got == {("b", "a", 3), ("c", "a", 3), ("d", "d", 1)}


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1001), (5, 5)], "a long, b long")
    got = {r.node: r.component for r in connected_components(edges).collect()}
    assert got == {i: 0 for i in range(301)} | {1000: 1000, 1001: 1000}
    assert connected_components(edges.filter("a < 0")).count() == 0


def test_propagation(spark):
    label = spark.createDataFrame([("b", "v", "1", "f", "h"), ("b", "v", "1", "f", "h"), ("c", "v", "2", "f", "h")], TABLES["label"])
    links = spark.createDataFrame([("a", "c", "s", 1.0, "across"), ("a", "b", "s", 1.0, "within"), ("b", "c", "s", 1.0, "across"), ("a", "d", "s", 1.0, "across")], TABLES["duplicate_link"])
    record = spark.createDataFrame([("a", "s1")], "record_id string, source_id string")
    got = [tuple(r) for r in labels.propagate(label, links, record).collect()]
    assert got == [("a", "s1", "v", "1", "propagated from b", "linked record", "b")] * 2


def test_catalogue(spark):
    c = catalog.sources(spark)
    assert c.count() == 12 and c.filter("source_id = 'physionet/ludb'").first().url == "https://physionet.org/content/ludb/1.0.1/"
    assert [r.corpus for r in catalog.paired_corpora(c).collect()] == ["incart", "ptb", "ptb-xl"]
    with pytest.raises(KeyError, match="physionet/ptbdb"):
        catalog.source(spark, "none")


def test_mappings(spark, tmp_path):
    texts = {
        mappings.SCORED: "﻿Dx,SNOMEDCTCode,Abbreviation," + ",".join(mappings.PARTITIONS) + "\nfib,164889003,AF,1,2,3,4,5,6,7,8\n",
        mappings.AHA: "AHA_Code,SNOMEDCTCode,Dx\n1,10,x\n", mappings.SCP: "Acronym,Dx Statement,id1\n NORM ,normal,4065390.0,,,\nLAFB,block,\n",
    }
    pins = {}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
        pins[name] = mappings.MAPPINGS[name] | {"map_sha256": hashlib.sha256(text.encode()).hexdigest()}
    paths = mappings.verified_mappings(str(tmp_path), pins)
    got = {(r.from_code, r.to_code, r.to_vocabulary) for r in mappings.label_map(spark, paths, pins).collect()}
    assert got == {("AF", "164889003", "SNOMED CT"), ("1", "10", "SNOMED CT"), ("NORM", "4065390", "OMOP concept"), ("LAFB", None, "OMOP concept")}
    assert mappings.published_counts(spark, paths[mappings.SCORED]).count() == 8
    with pytest.raises(ValueError, match="pinned"):
        mappings.verified_mappings(str(tmp_path))
    with pytest.raises(FileNotFoundError):
        mappings.verified_mappings(str(tmp_path / "none"))


def test_lock(tmp_path):
    with lock.Lock("heavy", tmp_path, "x"):
        assert lock.holder("heavy", tmp_path)["command"] == "x"
        with pytest.raises(RuntimeError, match="at work"), lock.Lock("heavy", tmp_path):
            pass
    assert lock.holder("heavy", tmp_path) is None and lock.holder("none", tmp_path) is None
    (tmp_path / "heavy.lock").write_text("nonsense")  # left by a process that is gone
    with pytest.raises(ValueError), lock.Lock("heavy", tmp_path):
        raise ValueError
    with lock.Lock("heavy", tmp_path) as held:
        assert held.path.exists()


def test_empty_tables_have_schemas(spark):
    h = spark.createDataFrame([], HEADER)
    for made, name in ((tables.records(h), "record"), (tables.leads(h), "lead"), (tables.labels(h), "label")):
        assert made.schema.names == TABLES[name].names and made.count() == 0


def test_arrivals(spark, tmp_path):
    from signalroot.streaming import arrivals

    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "a.bin").write_bytes(b"abc")
    (tmp_path / "in" / "b.bin").write_bytes(b"other")
    declared = spark.createDataFrame([("a.bin", hashlib.sha256(b"abc").hexdigest()), ("b.bin", "0" * 64), ("c.bin", "1" * 64)], "relative_path string, digest string")
    query = arrivals.verify_arrivals(arrivals.arriving(spark, f"{tmp_path}/in"), declared, f"{tmp_path}/out", f"{tmp_path}/state")
    query.awaitTermination(60)
    got = {r.relative_path: r.outcome for r in spark.read.parquet(f"{tmp_path}/out").collect()}
    assert got == {"a.bin": "matched", "b.bin": "mismatched"}


def test_command_line(spark, tmp_path, monkeypatch, capsys):
    from signalroot import __main__ as cli

    monkeypatch.setenv(catalog.DATA_ENV, str(tmp_path))
    assert cli.main(["verify", "--source", "physionet/ludb", "--locks", str(tmp_path)]) == 2
    root = tmp_path / "ludb"
    _record(root / "data", "1", np.random.default_rng(0).integers(-900, 900, (5200, 12)))
    files = [p for p in root.rglob("*") if p.is_file()]
    sums = "".join(f"{hashlib.sha256(p.read_bytes()).hexdigest()} {p.relative_to(root)}\n" for p in files)
    (root / "SHA256SUMS.txt").write_text(sums)
    args = ["--source", "physionet/ludb", "--locks", str(tmp_path), "--out", f"{tmp_path}/out"]
    assert cli.main(["verify", *args]) == 0 and cli.main(["scan", *args]) == 0
    assert cli.main(["build", *args, "--reports", f"{tmp_path}/said"]) == 0
    quality = json.loads(next((tmp_path / "said" / "quality_scan").glob("part-*.json")).read_text())
    assert quality["source_id"] == "physionet/ludb" and quality["n_records"] == 1 and quality["window_samples"] == [5000]
    assert {p.name for p in (tmp_path / "said").iterdir()} == {"quality_scan", "within_scan", "database_tables", "database_report", "traced_example", "unread"}
    assert cli.main(["derive", *args]) == 0 and cli.main(["screen", *args]) == 0
    assert cli.main(["copies", *args]) == 1 and cli.main(["label", *args, "--mappings", f"{tmp_path}/none"]) == 2
    assert cli.main(["trace", *args, "--record", "physionet/ludb:1"]) == 0 and cli.main(["trace", *args, "--record", "x"]) == 1
    assert '"relative_path": "data/1.dat"' in capsys.readouterr().out
    (root / "data" / "1.dat").write_bytes(b"changed")
    assert cli.main(["verify", *args]) == 1


def test_screen(spark):
    rng = np.random.default_rng(6)
    waves = {k: rng.normal(size=200).astype(np.float32).tolist() for k in "pqr"}
    row = lambda i, s, d, w: (i, s, d, w)
    schema = "record_id string, source_id string, signal_digest string, wave array<float>"
    left = spark.createDataFrame([row("a:1", "a", "d1", waves["p"]), row("a:2", "a", "d2", waves["q"]), row("a:3", "a", None, None)], schema)
    right = spark.createDataFrame([row("b:1", "b", "d1", waves["p"]), row("b:2", "b", "d9", [3 * x for x in waves["q"]]), row("b:3", "b", "d8", waves["r"])], schema)
    files = spark.createDataFrame([("a:3", "a", "f"), ("b:3", "b", "f")], "record_id string, source_id string, digest string")
    links, note = build.screen(left, right, files)
    assert note is None and [(r.record_a, r.record_b, r.sieve) for r in links.collect()] == [("a:1", "b:1", "signal"), ("a:2", "b:2", "correlation"), ("a:3", "b:3", "source-file")]
    assert [r[0] for r in reports.shared_native_ids(left, right).collect()] == ["1", "2", "3"]


def _pair(root, rng):
    """Two packagings of one corpus: a copied file, a copied signal in another file, a scaled first lead, and one record alone each."""
    x = [rng.integers(-900, 900, (5200, 12)) for _ in range(5)]
    _record(root / "l" / "d", "1", x[0])
    _record(root / "l" / "d", "2", x[1])
    _record(root / "l" / "d", "3", x[2])
    _record(root / "l" / "d", "9", x[0])
    near = x[2].copy()
    near[:, 0] *= 2
    longer = np.vstack([x[1], x[4][:100]])
    _record(root / "r" / "d", "1", x[0])
    _record(root / "r" / "d", "b", longer)
    _record(root / "r" / "d", "c", near)
    _record(root / "r" / "d", "d", x[3])
    entries = []
    for side in "lr":
        files = sorted(p for p in (root / side / "d").iterdir() if p.suffix == ".dat")
        (root / side / "SUMS").write_text("".join(f"{hashlib.sha256(p.read_bytes()).hexdigest()} {p.name}\n" for p in files))
        entries.append((f"{side}/x", "x", side, "1", "p", None, side, str(root / side), "d", "SUMS", ""))
    return entries


def test_build_screens_paired_corpora(spark, tmp_path):
    entries = _pair(tmp_path, np.random.default_rng(11))
    catalogue = spark.createDataFrame(entries, catalog.COLUMNS).withColumns({"directory": F.concat("root", F.lit("/d")), "manifest": F.concat("root", F.lit("/SUMS")), "url": F.lit("")})
    made, screens, _ = build.build(spark, catalogue=catalogue)
    links = {(r.record_a, r.record_b): (r.sieve, r.scope) for r in made["duplicate_link"].collect()}
    assert links == {
        ("l/x:1", "l/x:9"): ("signal", S.WITHIN), ("l/x:1", "r/x:1"): ("source-file", S.ACROSS), ("l/x:9", "r/x:1"): ("source-file", S.ACROSS),
        ("l/x:2", "r/x:b"): ("signal", S.ACROSS), ("l/x:3", "r/x:c"): ("correlation", S.ACROSS),
    }
    (one,) = screens
    ids = [side.judged.select("record_id", "source_id") for side in (one.left, one.right)]
    row = reports.screen_report(*ids, one.links, one.note).first()
    assert (row.n_left, row.n_right, row.n_links, row.n_source_file, row.n_signal, row.n_correlation, row.n_unmatched, row.n_shared_native_ids, row.note) == (4, 4, 4, 2, 1, 1, 1, 1, None)
    assert {tuple(r) for r in reports.screen_lists(*ids, one.links).collect()} == {("unmatched", "r/x", "r/x:d"), ("shared", None, "1")}
    figures = reports.database_figures(made).first()
    assert (figures.n_records, figures.n_groups, figures.largest, figures.n_within, figures.n_across) == (8, 4, 3, 1, 4) and figures.n_files_without_a_declared_digest == 8
    again, _ = build.linked([build.reswept(spark, e, build.declared_of(spark, e), made["quality"]) for e in catalogue.collect()])
    assert {(r.record_a, r.record_b): (r.sieve, r.scope) for r in again.collect()} == links


def test_copies(spark, tmp_path):
    _pair(tmp_path, np.random.default_rng(12))
    judged = signals.judged(spark, headers.scan(spark, f"{tmp_path}/l/d", "l"), f"{tmp_path}/l/d")
    groups = copies.repeated(judged.select("record_id", F.col("signal_digest").alias("digest")))
    assert [tuple(r) for r in copies.chosen(groups).collect()] == [("l:1", "l:9")] and copies.chosen(groups, 0).count() == 0
    pairs = spark.createDataFrame([("l:1", "l:9"), ("l:1", "l:2")], "record_a string, record_b string")
    compared = copies.opened(spark, pairs, f"{tmp_path}/l/d", "l")
    other, same = compared.collect()
    assert (same.record_b, same.identical_samples, same.max_absolute_difference, same.lead_one_correlation, same.same_comments, same.shape_a) == ("l:9", True, 0.0, 1.0, True, [5200, 12])
    assert not other.identical_samples and other.same_shape and abs(other.lead_one_correlation) < 0.1 and other.comments_a == ["Dx: 7"]
    said = copies.summary(compared).first()
    assert (said.n_checked, said.n_identical_samples, said.n_same_comments) == (2, 1, 2) and said.lowest_correlation == other.lead_one_correlation
    nan = np.array([[1.0, np.nan], [2.0, 5.0], [4.0, 5.0]])
    told = copies.compare(nan, np.array([[1.0, 3.0], [2.0, 5.0], [4.0, 5.0]]))
    assert told["identical_samples"] and told["max_absolute_difference"] == 0.0  # only where both are finite
    short = copies.compare(nan, nan[:2])
    assert not short["same_shape"] and not short["identical_samples"] and short["max_absolute_difference"] == 0.0
    narrow = copies.compare(nan, nan[:, :1])
    assert narrow["max_absolute_difference"] is None and narrow["lead_one_correlation"] == 1.0
    assert copies.compare(nan[:1], nan[:1])["lead_one_correlation"] is None


def test_label_pass(spark, tmp_path):
    texts = {
        mappings.SCORED: "Dx,SNOMEDCTCode,Abbreviation," + ",".join(mappings.PARTITIONS) + "\nfib,7,AF,1,2,3,4,5,6,7,8\n",
        mappings.AHA: "AHA_Code,SNOMEDCTCode,Dx\n1,10,x\n", mappings.SCP: "Acronym,Dx Statement,id1\nNORM,normal,4065390.0\n",
    }
    pins = {}
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
        pins[name] = mappings.MAPPINGS[name] | {"map_sha256": hashlib.sha256(text.encode()).hexdigest()}
    (tmp_path / "ptbxl_database.csv").write_text("ecg_id,patient_id,age,sex\n1,15.0,60,1\n2,15.0,61,1\n3,,,0\n")
    _record(tmp_path / "ptb" / "patient001", "s0010", np.zeros((10, 12), int))
    schema = "source_id string, root string, directory string"
    catalogue = spark.createDataFrame([(mappings.WITH_CSV, str(tmp_path), "none"), (mappings.WITH_FOLDERS, "", f"{tmp_path}/ptb"), ("x/a", "", "none")], schema)
    record = spark.createDataFrame([("a:1", "a"), ("b:1", "b")], "record_id string, source_id string")
    tables = {
        "record": record, "label": spark.createDataFrame([("a:1", "SNOMED CT", "7", "Dx", "corpus")], TABLES["label"]),
        "duplicate_link": spark.createDataFrame([("a:1", "b:1", "signal", 1.0, S.ACROSS)], TABLES["duplicate_link"]),
    }
    made = build.label_pass(spark, tables, str(tmp_path), pins, catalogue)
    assert [f"{r.record_id} {r.code} {r.source_id}" for r in made["label_propagated"].collect()] == ["b:1 7 b"]
    patients = {(r.patient_id, r.record_id) for r in made["patient"].collect()}
    assert {("physionet/ptb-xl:15", "physionet/ptb-xl:00001_hr"), ("physionet/ptbdb:patient001", "physionet/ptbdb:s0010")} <= patients and len(patients) == 4
    got = {(r.section, r.key): r.n for r in reports.label_report(tables["label"], made["label_propagated"], made["label_map"], made["patient"]).collect()}
    assert got["map rows", "all"] == 3 and got["map rows by file", mappings.SCORED] == 1 and got["patients", "all"] == 2 and got["patients by source", mappings.WITH_CSV] == 1
    assert got["propagated by source", "b"] == got["records given a label", "all"] == got["label rows", "all"] == 1


def test_builds_that_share_a_cache_decode_only_what_changed(spark, tmp_path, caplog):
    import logging
    import time

    caplog.set_level(logging.INFO, "signalroot.plans.build")
    rng = np.random.default_rng(4)
    for name in ("r1", "r2", "r3"):
        _record(tmp_path / "d", name, rng.integers(-900, 900, (5200, 12)))
    (tmp_path / "d" / "bad.hea").write_text("bad 1 500 100\nbad.dat 16 100 16 0 0 0 0 I\n")
    (tmp_path / "SUMS").write_text("")
    entry = ("x/a", "a", "x", "1", "p", None, "a", str(tmp_path), "d", "SUMS", "")
    catalogue = spark.createDataFrame([entry], catalog.COLUMNS).withColumns({"directory": F.concat("root", F.lit("/d")), "manifest": F.concat("root", F.lit("/SUMS")), "url": F.lit("")})

    def built():
        caplog.clear()
        made, _, unread = build.build(spark, catalogue=catalogue, cache=f"{tmp_path}/cache")
        found = {r.record_id: tuple(r) for r in made["quality"].collect()}
        return found, {r.record_id for r in unread.collect()}, caplog.text.split("x/a: ")[1].strip()

    first = built()
    assert first[0].keys() == {"x/a:r1", "x/a:r2", "x/a:r3"} and first[1] == {"x/a:bad"} and first[2] == "4 records decoded, 0 as before"
    assert built() == (first[0], first[1], "1 records decoded, 3 as before")  # the one that can't be read is tried again
    time.sleep(0.01)
    (tmp_path / "d" / "r2.dat").write_bytes(rng.integers(-900, 900, (5200, 12)).astype("<i2").tobytes())
    (tmp_path / "d" / "bad.hea").unlink()
    (tmp_path / "d" / "r3.hea").unlink()
    _record(tmp_path / "d", "r4", rng.integers(-900, 900, (5200, 12)))
    second = built()
    assert second[2] == "2 records decoded, 1 as before" and second[0].keys() == {"x/a:r1", "x/a:r2", "x/a:r4"} and second[1] == set()
    assert second[0]["x/a:r1"] == first[0]["x/a:r1"] and second[0]["x/a:r2"] != first[0]["x/a:r2"]
    plain = build.build(spark, catalogue=catalogue)[0]["quality"].collect()
    assert {r.record_id: tuple(r) for r in plain} == second[0]


def test_a_cluster_has_to_name_its_shared_folder():
    from types import SimpleNamespace

    from signalroot import scratch

    context = SimpleNamespace(master="spark://host:7077", getCheckpointDir=lambda: None)
    with pytest.raises(RuntimeError, match="checkpoint.dir"):
        scratch.shared_dir(SimpleNamespace(conf={}, sparkContext=context))
