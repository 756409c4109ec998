"""Storage formats against encoders written bit by bit, and builds with records that can't be read."""

from __future__ import annotations

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from signalroot.functions.scalars import CANONICAL_LEADS
from signalroot.operators import correlation, duplicates
from signalroot.plans import build
from signalroot.sources import catalog, files, formats, headers, signals


def little(value: int, n_bytes: int) -> bytes:
    return (value & (1 << 8 * n_bytes) - 1).to_bytes(n_bytes, "little")


def stored(kind: int, x: list[int]) -> bytes:
    """Samples as the format's description has them, one or one group at a time."""
    if kind == 8:
        return b"".join(little(b - a, 1) for a, b in zip([0, *x], x))
    if kind == 61:
        return b"".join(little(v, 2)[::-1] for v in x)
    if kind in (16, 24, 32):
        return b"".join(little(v, kind // 8) for v in x)
    if kind in (80, 160):
        return b"".join(little(v + (1 << 7 if kind == 80 else 1 << 15), 1 if kind == 80 else 2) for v in x)
    out = b""
    if kind == 212:
        for k in range(0, len(x), 2):
            a, b = (x[k : k + 2] + [0])[:2]
            out += bytes([a & 0xFF, (a >> 8 & 0xF) | (b >> 8 & 0xF) << 4, b & 0xFF])
        return out
    for k in range(0, len(x), 3):
        a, b, c = (v & 0x3FF for v in (x[k : k + 3] + [0, 0])[:3])
        if kind == 310:
            out += little(a << 1 | (c & 0x1F) << 11, 2) + little(b << 1 | (c >> 5) << 11, 2)
        else:
            out += little(a | b << 10 | c << 20, 4)
    return out


BITS = {8: 8, 16: 16, 24: 24, 32: 32, 61: 16, 80: 8, 160: 16, 212: 12, 310: 10, 311: 10}


def lead(fmt, gain=1.0, baseline=0, initial=0, file="r.dat", name=None):
    return {"format": fmt, "gain": gain, "baseline": baseline, "initial_value": initial, "file": file, "name_canonical": name}


@pytest.mark.parametrize("kind", sorted(BITS))
@pytest.mark.parametrize("n", [1, 2, 3, 4, 5, 6, 7, 100])
def test_every_format_gives_the_written_integers(kind, n):
    rng = np.random.default_rng(n)
    top = 1 << BITS[kind] - 1
    for n_leads in (1, 2, 3):
        x = rng.integers(-top + 1, top, (n, n_leads))
        if kind == 8:  # differences of one byte
            x = np.cumsum(rng.integers(-20, 20, (n, n_leads)), axis=0)
            data = np.diff(x, axis=0, prepend=0).astype(np.int8).tobytes()
        else:
            data = stored(kind, x.reshape(-1).tolist())
        got = formats.decode(data, [lead(str(kind))] * n_leads, n, n)
        assert np.array_equal(got, x)
        leads = [lead(str(kind))] * n_leads
        assert formats.span(leads, n, n)[1] <= len(data)
        if kind not in (212, 310, 311):
            assert formats.frames_in(len(data), leads) == n
        if kind != 8:
            x[0, 0] = -top
            missing = formats.decode(stored(kind, x.reshape(-1).tolist()), leads, n, n)
            assert np.isnan(missing[0, 0]) and np.array_equal(missing.reshape(-1)[1:], x.reshape(-1)[1:])


@given(st.sampled_from(sorted(set(BITS) - {8})), st.lists(st.integers(-500, 500), min_size=1, max_size=40))
@settings(max_examples=200, deadline=None)
def test_a_window_needs_only_its_own_bytes(kind, x):
    x = [max(-127, min(127, v)) for v in x] if kind == 80 else x
    data = stored(kind, x)
    for n in range(1, len(x) + 1):
        start, size = formats.span([lead(str(kind))], len(x), n)
        assert start == 0 and formats.decode(data[:size], [lead(str(kind))], len(x), n)[:, 0].tolist() == x[:n]


def test_frames_skew_and_offset():
    """Two leads, the first with two samples a frame, the second one frame late, behind three bytes of something else."""
    frames = [[10, 20, 1], [30, 50, 2], [70, 70, 3]]
    data = b"abc" + stored(16, [v for f in frames for v in f])
    leads = [lead("16x2+3", gain=10.0), lead("16:1+3", baseline=1)]
    start, size = formats.span(leads, 3, 2)
    got = formats.decode(data[start : start + size], leads, 3, 2)
    assert start == 3 and got[:, 0].tolist() == [1.5, 4.0] and got[:, 1].tolist() == [1.0, 2.0]
    end = formats.decode(data[3:], leads, 3, 3)
    assert np.isnan(end[2, 1]) and end[:2, 1].tolist() == [1.0, 2.0]
    assert formats.decode(stored(8, [5, 9, 4]), [lead("8", initial=100)], 3, 3)[:, 0].tolist() == [105, 109, 104]
    for wrong in ("", "x", "77", "16x0", "16+"):
        with pytest.raises(formats.Unreadable):
            formats.field(wrong)
    with pytest.raises(formats.Unreadable, match="several formats"):
        formats.of_file([lead("16"), lead("212")])


def write(folder, name, groups, n=5200, fs=500, length=True):
    """A record whose leads lie in several files: (file, format, samples int[n, leads])."""
    folder.mkdir(parents=True, exist_ok=True)
    lines, at = [], 0
    for k, (kind, x) in enumerate(groups):
        file = f"{name}_{k}.dat"
        (folder / file).write_bytes(stored(kind, x.reshape(-1).tolist()))
        for _ in range(x.shape[1]):
            lines.append(f"{file} {kind} 100(3)/mV 16 0 0 0 0 {CANONICAL_LEADS[at]}")
            at += 1
    (folder / f"{name}.hea").write_text("\n".join([f"{name} {at} {fs}" + (f" {n}" if length else ""), *lines]) + "\n")


def test_records_of_mixed_formats_and_bad_ones(spark, tmp_path):
    x = np.random.default_rng(8).integers(-400, 400, (5200, 12))
    write(tmp_path / "d", "mixed", [(212, x[:, :5]), (16, x[:, 5:8]), (310, x[:, 8:11]), (24, x[:, 11:])])
    write(tmp_path / "d", "nolength", [(16, x)], length=False)
    write(tmp_path / "d", "short", [(16, x)])
    (tmp_path / "d" / "short_0.dat").write_bytes(b"12345")
    write(tmp_path / "d", "strange", [(16, x)])
    text = (tmp_path / "d" / "strange.hea").read_text()
    (tmp_path / "d" / "strange.hea").write_text(text.replace(" 16 100", " 508 100"))
    write(tmp_path / "d", "gone", [(16, x)])
    (tmp_path / "d" / "gone_0.dat").unlink()
    (tmp_path / "d" / "none.hea").write_text("none 0 500 100\n")
    (tmp_path / "SUMS").write_text("")
    entry = ("x/a", "a", "x", "1", "p", None, "a", str(tmp_path), "d", "SUMS", "")
    catalogue = spark.createDataFrame([entry], catalog.COLUMNS).withColumns({"directory": F.concat("root", F.lit("/d")), "manifest": F.concat("root", F.lit("/SUMS")), "url": F.lit("")})
    made, _, unread = build.build(spark, catalogue=catalogue)
    window = ((x[:5000].T - 3) / 100).astype(np.float32)
    good = {r.record_id: r for r in made["quality"].collect()}
    assert {k: r.signal_digest for k, r in good.items()} == {"x/a:mixed": signals.digest_of(window), "x/a:nolength": signals.digest_of(window)}
    why = {r.record_id: r.error for r in unread.collect()}
    assert why.keys() == {"x/a:short", "x/a:strange", "x/a:gone", "x/a:none"}
    assert "5 of 120000 bytes" in why["x/a:short"] and "508" in why["x/a:strange"] and "gone_0.dat" in why["x/a:gone"] and "no leads" in why["x/a:none"]
    assert made["record"].count() == 6 and made["signal_group"].count() == 2


def test_only_spark_reads_the_folder(spark, tmp_path, monkeypatch):
    """Contents that come through Spark's reader give the same rows, missing files too."""
    x = np.random.default_rng(9).integers(-400, 400, (600, 12))
    write(tmp_path, "two", [(212, x[:, :5]), (16, x[:, 5:])], n=600)
    write(tmp_path, "gone", [(16, x)], n=600)
    (tmp_path / "gone_0.dat").unlink()
    parsed = headers.scan(spark, str(tmp_path), "s")
    facts = lambda: sorted((r.record_id, r.signal_digest or "", r.n_samples_read or 0, r.error is None) for r in signals.judged(spark, parsed, str(tmp_path)).collect())
    mine = facts()
    monkeypatch.setattr(files, "reachable", lambda path: False)
    assert facts() == mine and [r[3] for r in mine] == [False, True]


def test_files_open_by_any_local_spelling(tmp_path):
    path = tmp_path / "a b%20c.bin"
    path.write_bytes(bytes(range(256)) * 20_000)
    for spelt in (str(path), f"file:{path}", f"file://{path}"):
        assert files.size(spelt) == 5_120_000 and files.read(spelt, 255, 3) == b"\xff\x00\x01" and sum(map(len, files.chunks(spelt))) == 5_120_000
    assert files.read(str(path), 6_000_000) == b"" and not files.reachable("viewfs://x/y") and files.reachable(str(path))


def brute(t, c, threshold):
    """Every target against every candidate: {target: ({candidate: ordinal} of the best, score)}."""
    found = {}
    for i, x in t.items():
        scores = {}
        for k, (y, _) in c.items():
            n = min(len(x), len(y))
            if n < 2 or i == k:
                continue
            a, b = (np.asarray(w[:n], np.float64) for w in (x, y))
            a, b = a - a.mean(), b - b.mean()
            if np.isfinite(a).all() and np.isfinite(b).all() and a.any() and b.any():
                scores[k] = float(a @ b / np.sqrt((a @ a) * (b @ b)))
        best = max(scores.values(), default=-1)
        if best >= threshold:
            found[i] = ({k: c[k][1] for k, r in scores.items() if r > best - 1e-12}, best)
    return found


@pytest.mark.parametrize(("threshold", "length"), [(0.99, 300), (0.9, 60), (0.35, 40), (0.999, 2000)])
def test_correlation_equals_every_pair(spark, threshold, length, monkeypatch):
    monkeypatch.setattr(correlation, "BLOCK", 7)
    rng = np.random.default_rng(length)
    drift = lambda: np.cumsum(rng.normal(size=length))
    c, t = {}, {}
    for k in range(40):
        wave = drift() if k % 2 else rng.normal(size=length)
        c[f"c{k:02}"] = (wave, int(rng.integers(3)))
        for j in range(3):
            noise = rng.normal(size=length) * wave.std() * rng.choice([0, 0.02, 0.1, 0.14, 0.15, 0.3])
            cut = int(rng.choice([length, length, length - 1, length // 2, 3, 1]))
            t[f"t{k:02}{j}"] = ((wave + noise) * rng.choice([1, 3.27, -1]) + rng.normal())[:cut]
        if k % 5 == 0:
            c[f"d{k:02}"] = (2 * wave[: length - 2], int(rng.integers(3)))
    t |= {"flat": np.ones(length), "empty": np.array([]), "c01": c["c01"][0], "nan": np.full(length, np.nan)}
    frame_t = spark.createDataFrame([(k, [float(v) for v in w]) for k, w in t.items()] + [("null", None)], "record_id string, wave array<double>")
    frame_c = spark.createDataFrame([(k, [float(v) for v in w], o) for k, (w, o) in c.items()], "record_id string, wave array<double>, ordinal long")
    got = correlation.best_matches(frame_t.selectExpr("record_id AS id", "0 AS ordinal", "wave"), frame_c.selectExpr("record_id AS id", "ordinal", "wave"), threshold)
    got, want = {r.target: r for r in got.collect()}, brute(t, c, threshold)
    assert got.keys() == want.keys()
    for k, (best, score) in want.items():
        assert got[k].candidate in best and abs(got[k].score - score) < 1e-9
    assert duplicates.correlate(frame_t.limit(0), frame_c).count() == 0 and duplicates.correlate(frame_t, frame_c.limit(0)).count() == 0


def test_of_equal_scores_the_first_in_order_wins(spark):
    w = [float(v) for v in np.random.default_rng(1).normal(size=50)]
    c = spark.createDataFrame([("z", 1, w), ("b", 1, w), ("a", 2, w), ("t", 0, w)], "id string, ordinal long, wave array<double>")
    assert [tuple(r)[:2] for r in correlation.best_matches(c.filter("id = 't'"), c, 0.99).collect()] == [("t", "b")]


@given(st.integers(2, 400), st.integers(0, 2**32 - 1))
@settings(max_examples=60, deadline=None)
def test_coefficients_bound_the_correlation(n, seed):
    rng = np.random.default_rng(seed)
    x = np.concatenate([rng.normal(size=(5, n)), np.cumsum(rng.normal(size=(5, n)), axis=1)])
    x = np.concatenate([x, 3 * x + 0.01 * rng.normal(size=x.shape)])
    u = correlation.unit(x)
    low, high = correlation.bounds(*[(u @ correlation.basis(n)).astype(np.float32)] * 2)
    r = u @ u.T
    assert (low <= r + 1e-9).all() and (r <= high + 1e-9).all()


def test_many_waves_make_few_pairs(spark):
    """Of four million pairs of noise and drifts, those of copies and a few more are looked at."""
    rng = np.random.default_rng(3)
    base = np.cumsum(rng.normal(size=(2000, 400)), axis=1)
    base[::2] = rng.normal(size=(1000, 400))
    rows = lambda name, x: spark.createDataFrame([(f"{name}{k}", 0, w.tolist()) for k, w in enumerate(x)], "id string, ordinal long, wave array<double>")
    t, c = rows("t", base * 2 + 1), rows("c", base)
    assert correlation.candidate_pairs(t, c, 0.99).count() < 3 * 2000
    got = correlation.best_matches(t, c, 0.99).collect()
    assert len(got) == 2000 and all(r.target[1:] == r.candidate[1:] for r in got)
