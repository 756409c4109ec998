"""Substring dedup with sharded Aho-Corasick automata over repeated phrases.

A window is 13 consecutive words. Any window contains 9 runs of 5 words, and the
run with the smallest hash is its anchor, so two documents that share a window
share its anchor, and about one run in five is an anchor.

1. Candidates. Hashes of anchors meet in a shuffle; those seen in two documents
   send the positions of their occurrences back to the documents.
2. Confirmation. For each such occurrence, the words around it (the windows that
   it is the anchor of) go to the shard of the anchor. The shard compares them
   word by word; what two documents have is a confirmed phrase.
3. Automata. Each shard compiles its phrases into an Aho-Corasick automaton over
   word numbers and streams its passages through it; every occurrence whose
   phrase also starts in a document with a smaller id marks its 13 words.

Before each shuffle a task settles what it can: an occurrence that has a smaller
document in the same chunk of rows is marked at once and only the smallest goes
on, so an anchor or a phrase that very many documents share reaches its shard
once per chunk. Shards follow the input in number.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW, ANCHOR = 13, 5
#: Anchors and passages that a task holds before it emits them.
CHUNK_ANCHORS, CHUNK_PASSAGES = 1_000_000, 100_000
#: Words of the distinct passages that one automaton is made from and streams.
AUTOMATON_WORDS = 1_000_000


def anchor_field(h: np.ndarray, sizes: np.ndarray, window: int = WINDOW, anchor: int = ANCHOR) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(run hashes, least run hash of each window, positions of anchors) of texts in a row.

    `h` are the words' hashes of all texts, `sizes` their words; windows that
    would cross from one text into the next have the least hash 0.
    """
    g = common.gram_hashes(h, anchor)
    span = window - anchor + 1
    m = len(g) - span + 1
    if m <= 0:
        return g, np.empty(0, np.uint64), np.empty(0, np.int64)
    least = g[:m].copy()
    for j in range(1, span):
        np.minimum(least, g[j : j + m], out=least)
    ends = np.repeat(np.cumsum(sizes), sizes)[:m]
    least[np.arange(m) + window > ends] = 0
    most = np.zeros(len(g), np.uint64)
    for j in range(span):
        np.maximum(most[j : j + m], least, out=most[j : j + m])
    return g, least, np.flatnonzero((most == g) & (most > 0))


def _pack7(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :7]).tobytes()


def _unpack7(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // 7, 8), np.uint8)
    out[:, :7] = np.frombuffer(data, np.uint8).reshape(-1, 7)
    return out.reshape(-1).view("<u8").copy()


def _runs(x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the runs of equal values."""
    if not len(x):
        return np.empty(0, np.int64), np.empty(0, np.int64)
    start = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    return start, np.r_[start[1:], len(x)]


_HIT, _SHARD = 0, 1


def _batch(**columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))


def _candidates(window: int, anchor: int, bits: int):
    """(id, text) -> anchors for the shards, and positions known to recur in the chunk."""
    shift = np.uint64(64 - bits)

    def emit(ids: np.ndarray, who: np.ndarray, at: np.ndarray, sig: np.ndarray) -> pa.RecordBatch:
        order = np.argsort(sig, kind="stable")  # occurrences of an anchor stay in the order of rows
        sig, who, at = sig[order], who[order], at[order]
        start, end = _runs(sig)
        several = np.zeros(len(sig), bool)
        many = ids[who[start]] != ids[who[end - 1]] if len(start) else np.empty(0, bool)
        if len(start):
            several = np.repeat(many, end - start)
        kind, bucket, data = [], [], []
        hit_who, hit_at = who[several], at[several]
        order = np.argsort(hit_who, kind="stable")
        hit_who, hit_at = hit_who[order], hit_at[order]
        for a, z in zip(*_runs(hit_who)):
            kind.append(_HIT)
            bucket.append(int(ids[hit_who[a]]))
            data.append(hit_at[a:z].astype("<u4").tobytes())
        # to the shards: one occurrence of each anchor that recurs here, else all of its document
        go = ~several
        go[start] = True
        sig, who, at, known = sig[go], who[go], at[go], several[go]
        cut = (sig >> shift).astype(np.int64)
        for a, z in zip(*_runs(cut)):
            kind.append(_SHARD)
            bucket.append(int(cut[a]))
            n = np.array([z - a], "<i8").tobytes()
            data.append(n + ids[who[a:z]].astype("<i8").tobytes() + at[a:z].astype("<u4").tobytes() + known[a:z].astype("u1").tobytes() + _pack7(sig[a:z]))
        return _batch(kind=pa.array(kind, pa.int32()), key=pa.array(bucket, pa.int64()), data=pa.array(data, pa.binary()))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n, rows = [], 0, 0
        for b in batches:
            ids, known = b.column(0).fill_null(0).to_numpy(), b.column(0).is_valid().to_numpy(zero_copy_only=False)
            for lo, h, words, *_ in common.word_spans(b.column(1)):
                g, _, at = anchor_field(h, words, window, anchor)
                first = np.cumsum(words) - words
                row = np.repeat(np.arange(len(words)), words)[at]
                mine = known[lo + row]
                held.append((ids[lo : lo + len(words)], row[mine] + rows, (at - first[row])[mine], g[at][mine]))
                rows += len(words)
                n += len(at)
                if n >= CHUNK_ANCHORS:
                    yield emit(*(np.concatenate(x) for x in zip(*held)))
                    held, n, rows = [], 0, 0
        if held:
            yield emit(*(np.concatenate(x) for x in zip(*held)))

    return run


def _settled(b: pa.RecordBatch, id_col: str) -> pa.RecordBatch:
    """The rows of a batch that a chunk has settled, passed on as they are."""
    mine = b.filter(pc.equal(b.column("kind"), _HIT))
    return _batch(id=mine.column(id_col), data=mine.column("data"))


def _recurring(bits: int):
    """Anchors of a shard that two documents have -> (id, positions)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = []
        for b in batches:
            yield _settled(b, "key")
            for kind, key, data in zip(*(c.to_pylist() for c in b.columns)):
                if kind == _HIT:
                    continue
                n = int(np.frombuffer(data, "<i8", 1)[0])
                ids = np.frombuffer(data, "<i8", n, 8)
                at = np.frombuffer(data, "<u4", n, 8 + 8 * n)
                known = np.frombuffer(data, "u1", n, 8 + 12 * n).astype(bool)
                sig = _unpack7(data[8 + 13 * n :]) | (np.uint64(key) << np.uint64(64 - bits))
                held.append((sig, ids, at, known))
        if not held:
            return
        sig, ids, at, known = (np.concatenate(x) for x in zip(*held))
        del held
        order = np.lexsort((ids, sig))
        sig, ids, at, known = sig[order], ids[order], at[order], known[order]
        start, end = _runs(sig)
        # two documents here; an occurrence already known to recur was answered in its chunk
        wanted = np.repeat(ids[start] != ids[end - 1], end - start) & ~known
        ids, at = ids[wanted], at[wanted]
        order = np.argsort(ids, kind="stable")
        ids, at = ids[order], at[order]
        rows = list(zip(*_runs(ids)))
        for lo in range(0, len(rows), 10_000):
            some = rows[lo : lo + 10_000]
            yield _batch(id=pa.array([int(ids[a]) for a, _ in some], pa.int64()), data=pa.array([at[a:z].astype("<u4").tobytes() for a, z in some], pa.binary()))

    return run


def _numbers(parts: list[bytes] | None) -> np.ndarray:
    return np.frombuffer(b"".join(parts), "<u4").astype(np.int64) if parts else np.empty(0, np.int64)


def _by_id(ids: list[int], starts: list[int], counts: list[int]) -> pa.RecordBatch:
    """Runs of windows (start, number) packed into a row for each id."""
    i, run = np.array(ids, np.int64), np.stack([np.array(starts, np.int64), np.array(counts, np.int64)], axis=1).astype("<u4")
    order = np.argsort(i, kind="stable")
    i, run = i[order], run[order]
    a, z = _runs(i)
    return _batch(id=pa.array(i[a], pa.int64()), data=pa.array([run[x:y].tobytes() for x, y in zip(a, z)], pa.binary()))


def _passages(window: int, anchor: int):
    """(id, text, positions) -> passages for the shards, and runs settled in the chunk.

    The passage of an anchor is the words of the windows that it is the anchor of.
    """
    span = window - anchor + 1

    def emit(held: list) -> pa.RecordBatch:
        least: dict[bytes, int] = {}
        for i, _, _, _, text in held:
            if least.get(text, i) >= i:
                least[text] = i
        done, sent = [], []
        for x in held:
            (done if least[x[4]] < x[0] else sent).append(x)
        settled = _by_id(*zip(*((i, lo, n) for i, _, lo, n, _ in done))) if done else None
        k = len(settled) if settled else 0
        columns = list(zip(*sent)) if sent else [[], [], [], [], []]
        return _batch(
            kind=pa.array([_HIT] * k + [_SHARD] * len(sent), pa.int32()),
            id=pa.concat_arrays([settled.column("id"), pa.array(columns[0], pa.int64())]) if k else pa.array(columns[0], pa.int64()),
            anchor=pa.array(list(range(k)) + list(columns[1]), pa.int64()),
            start=pa.array([0] * k + list(columns[2]), pa.int64()),
            data=pa.concat_arrays([settled.column("data"), pa.array(columns[4], pa.binary())]) if k else pa.array(columns[4], pa.binary()),
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, int, bytes]] = []
        for b in batches:
            ids, parts = b.column(0).to_pylist(), b.column(2).to_pylist()
            for lo, h, words, raw, start, size in common.word_spans(b.column(1)):
                g, least, _ = anchor_field(h, words, window, anchor)
                data = raw.tobytes()
                first = np.cumsum(words) - words
                signed = g.view(np.int64)
                for k, n in enumerate(words.tolist()):
                    at = np.unique(_numbers(parts[lo + k]))
                    at = at[at + anchor <= n] + first[k]  # rows that repeat an id share positions
                    if n < window or not len(at):
                        continue
                    near = at[:, None] + np.arange(1 - span, 1)
                    own = (near >= first[k]) & (near <= first[k] + n - window)
                    own &= least[np.clip(near, 0, len(least) - 1)] == g[at][:, None]
                    some = own.any(axis=1)
                    begin = near[:, 0] + own.argmax(axis=1)
                    stop = near[:, 0] + span - own[:, ::-1].argmax(axis=1)
                    for p, x, y in zip(at[some].tolist(), begin[some].tolist(), stop[some].tolist()):
                        last = y + window - 2
                        text = b" ".join(data[start[x] : start[last] + size[last]].split())
                        held.append((ids[lo + k], int(signed[p]), x - int(first[k]), y - x, text))
                    if len(held) >= CHUNK_PASSAGES:
                        yield emit(held)
                        held = []
        if held:
            yield emit(held)

    return common.without_gc(run)


class PhraseAutomaton:
    """Aho-Corasick automaton over word numbers; a phrase carries its smallest document."""

    def __init__(self, phrases: dict[tuple[int, ...], int]):
        self.automaton = ahocorasick.Automaton(ahocorasick.STORE_ANY, ahocorasick.KEY_SEQUENCE)
        for phrase, least in phrases.items():
            self.automaton.add_word(phrase, (len(phrase), least))
        if phrases:
            self.automaton.make_automaton()

    def occurrences(self, words: tuple[int, ...]) -> Iterator[tuple[int, tuple[int, int]]]:
        """(position of the last word, (words, smallest document)) of every phrase in `words`."""
        return self.automaton.iter(words) if len(self.automaton) else iter(())


def confirmed(groups: list[list[bytes]], least: dict[bytes, int], shared: set[bytes], coded: dict[bytes, tuple[int, ...]], window: int) -> dict[tuple[int, ...], int]:
    """Phrases whose words are in two documents, with the smallest of these.

    A group has the distinct passages of one anchor. A passage of two documents
    is one phrase; what two passages share is confirmed window by window.
    """
    phrases: dict[tuple[int, ...], int] = {}
    for group in groups:
        for text in group:
            if text in shared:
                phrases[coded[text]] = least[text]
        if len(group) < 2:
            continue
        seen: dict[tuple[int, ...], tuple[int, bool]] = {}
        for text in group:
            words, i = coded[text], least[text]
            for s in range(len(words) - window + 1):
                w = words[s : s + window]
                low, twice = seen.get(w, (i, False))
                seen[w] = (min(low, i), twice or low != i)
        for w, (low, twice) in seen.items():
            if twice:
                phrases[w] = min(low, phrases.get(w, low))
    return phrases


def shard_marks(rows: list[tuple[int, int, int, bytes]], window: int) -> tuple[list[int], list[int], list[int]]:
    """Runs (id, start, number) of windows whose words also start in a document with a smaller id.

    `rows` are (anchor, id, start, passage), those of an anchor together.
    """
    least: dict[bytes, int] = {}
    shared: set[bytes] = set()
    groups: list[list[bytes]] = []
    now = None
    for anchor, i, _, text in rows:
        if anchor != now:
            groups.append([])
            now = anchor
        low = least.get(text)
        if low is None:
            least[text] = i
            groups[-1].append(text)
        elif low != i:
            shared.add(text)
            least[text] = min(low, i)
    numbers: dict[bytes, int] = defaultdict(lambda: len(numbers) + 1)
    wanted = [g for g in groups if len(g) > 1 or g and g[0] in shared]
    coded = {text: tuple(map(numbers.__getitem__, text.split(b" "))) for g in wanted for text in g}
    automaton = PhraseAutomaton(confirmed(wanted, least, shared, coded, window))
    first: dict[bytes, list[int | None]] = {}
    for text, words in coded.items():
        marks: list[int | None] = [None] * (len(words) - window + 1)
        for end, (n, low) in automaton.occurrences(words):
            for s in range(end - n + 1, end - window + 2):
                if marks[s] is None or low < marks[s]:
                    marks[s] = low
        first[text] = marks
    ids, starts, counts = [], [], []
    for _, i, start, text in rows:
        marks = first.get(text)
        if marks is None:
            continue
        s = 0
        while s < len(marks):
            if marks[s] is None or marks[s] >= i:
                s += 1
                continue
            e = s
            while e < len(marks) and marks[e] is not None and marks[e] < i:
                e += 1
            ids.append(i)
            starts.append(start + s)
            counts.append(e - s)
            s = e
    return ids, starts, counts


def _locate(window: int):
    """Passages of the shards -> (id, runs of windows)."""

    def emit(rows) -> Iterator[pa.RecordBatch]:
        ids, starts, counts = shard_marks(rows, window)
        if ids:
            yield _by_id(ids, starts, counts)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[int, int, int, bytes]] = []
        now, n = None, 0
        for b in batches:
            yield _settled(b, "id")
            for kind, i, anchor, start, data in zip(*(c.to_pylist() for c in b.columns)):
                if kind == _HIT:
                    continue
                if anchor != now and n >= AUTOMATON_WORDS:  # rows are sorted: cut between two anchors
                    yield from emit(held)
                    held, n = [], 0
                now = anchor
                held.append((anchor, i, start, data))
                n += data.count(b" ") + 1
        if held:
            yield from emit(held)

    return common.without_gc(run)


def _remove(window: int, with_text: bool):
    """(id, text, runs) -> n_words, n_removed, what is kept and its digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, n_removed, texts = [], [], []
            for text, parts in zip(b.column(1).to_pylist(), b.column(2).to_pylist()):
                words = text.split() if text else []
                kept = words
                if parts and len(words) >= window:
                    start, count = _numbers(parts).reshape(-1, 2).T
                    inside = start + window <= len(words)  # rows that repeat an id share runs
                    start, stop = start[inside], np.minimum(start + count - 1 + window, len(words))[inside]
                    gone = np.bincount(start, minlength=len(words) + 1) - np.bincount(stop, minlength=len(words) + 1)
                    kept = [w for w, k in zip(words, (np.cumsum(gone) == 0).tolist()) if k]
                n_words.append(len(words))
                n_removed.append(len(words) - len(kept))
                texts.append(b" ".join(kept))
            out = {"id": b.column(0), "n_words": pa.array(n_words, pa.int64()), "n_removed": pa.array(n_removed, pa.int64())}
            if with_text:
                out["kept_text"] = pa.array(texts, pa.binary()).cast(pa.string(), safe=False)
            yield _batch(**out, kept_sha256=pa.array([hashlib.sha256(x).hexdigest() for x in texts], pa.string()))

    return run


def substring_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW, anchor: int = ANCHOR, with_text: bool = True) -> DataFrame:
    """One row per input row: id (long), n_words, n_removed, kept_text, kept_sha256.

    Words are runs of other than space and 09-0D, unchanged. A word goes if a
    window of `window` words covers it whose words also start in a document with
    a smaller id; windows are judged on the input. Kept words are joined by one space.

    - null text has no words; texts of fewer words than a window keep all.
    - a null id shares with nobody: its text stays whole and marks nothing.
    - rows that repeat an id are one document: they mark the same positions in
      each other as far as their lengths go, and none because of each other.
    - an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = common.Scratch(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = common.partitions(spark, n_bytes / 25, 1.5e6)  # about one anchor in 25 bytes
    bits = max(8, int(np.ceil(np.log2(4 * parts))))
    marked = rows.mapInArrow(_candidates(window, anchor, bits), "kind int, key long, data binary")
    hits = scratch.table(
        marked.repartition(parts, F.when(F.col("kind") == _SHARD, F.col("key")).otherwise(F.xxhash64("key", "data"))).mapInArrow(_recurring(bits), "id long, data binary"),
        "hits",
    )
    common.release(spark)
    near = hits.groupBy("id").agg(F.collect_list("data").alias("parts"))
    passages = rows.filter("text IS NOT NULL").join(near.hint("shuffle_hash"), "id").select("id", "text", "parts")
    schema = T.StructType([T.StructField("kind", T.IntegerType())] + [T.StructField(c, T.LongType()) for c in ("id", "anchor", "start")] + [T.StructField("data", T.BinaryType())])
    sent = passages.mapInArrow(_passages(window, anchor), schema)
    starts = scratch.table(
        sent.repartition(parts, F.when(F.col("kind") == _SHARD, F.col("anchor")).otherwise(F.xxhash64("id")))
        .sortWithinPartitions("anchor")
        .mapInArrow(_locate(window), "id long, data binary"),
        "starts",
    )
    scratch.drop("hits")
    common.release(spark)
    gone = starts.groupBy("id").agg(F.collect_list("data").alias("parts"))
    out = f"id long, n_words long, n_removed long, {'kept_text string, ' if with_text else ''}kept_sha256 string"
    both = rows.join(gone.hint("shuffle_hash"), "id", "left").select("id", "text", "parts")
    return both.mapInArrow(_remove(window, with_text), out).withColumnRenamed("id", id_col)
