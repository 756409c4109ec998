"""N-gram Jaccard join by universe partition and the pigeonhole principle.

A document is the set of hashes of its distinct 5-word shingles. For a pair of
similarity t or more whose smaller set lies in size band k, the sets differ in
at most H_k elements. The hash universe is cut into segments; most of them count
one unit and are indexed by the exact subset that falls into them, some are
twice as wide, count two units and are indexed by that subset and all of its
one-deletion neighbours, so they also match if they differ in one element. With
H_k + 1 + slack units, a true pair matches in more than `slack` units.

Cost-based allocation spends that slack: each document leaves out its most
expensive segments, those with the smallest subsets, whose lists are longest, in
an order both documents of a pair agree on. A pair's common segments that one
side leaves out are a prefix of those the other side could, so at least one
common segment stays, and no link is lost.

Work inside a list is linear: a list is a star around its smallest member, first
in the chunk of rows that a task holds and then over all chunks, so a list that
very many documents share reaches the shuffle once per chunk. One star edge per
document, the one with most common lists, is verified exactly on the texts; then
lists whose members are still in different components get other centres. The
members of lists that are still apart are compared by what they differ in from
a pivot of the list, under a prefix filter (`_across`), and what that leaves is
verified, so no pair is left undecided.

Lists that documents share by chance or by a common passage make many pairs, more
than in proportion to the input. Before texts move, each pair is judged by one bit
for each place of its sets (`_parity`), which rules out almost all that aren't links.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.components import connected_components, extended
from . import common

SHINGLE, PERCENT = 5, 80
#: Signatures and documents that a task holds before it emits them.
CHUNK_SIGNATURES, CHUNK_DOCS = 400_000, 20_000
#: Bytes of a signature that are sent; the bucket, whose bits grow with the input, has the first ones, so
#: that one signature in a million meets another by chance at every size. Such pairs fail the verification.
SENT = 5
#: Times that lists still apart get new centres before pairs are made.
CENTRE_ROUNDS = 1
#: Times that documents take over the pivot of their pivot.
PIVOT_STEPS = 2
#: Documents of a pivot from which their order is fitted, how many of them, and shingles that go last.
CROWD, CROWD_SAMPLE, POPULAR = 32, 256, 512
#: Common lists that make a star edge worth verifying before the others.
FIRST_LISTS = 4

_INFO, _LIST, _EDGE, _SAME = 0, 1, 2, 3


@lru_cache(8)
def bands(percent: int) -> tuple[int, ...]:
    """First sizes of the bands: a pair's sets lie in one band or in neighbours."""
    starts = [1]
    while starts[-1] < 1 << 40:
        starts.append(max(starts[-1] + 1, -(-starts[-1] * 100 // percent)))
    return tuple(starts)


class Plan:
    """Segments of one size band."""

    def __init__(self, band: int, percent: int, cut: bool = True):
        most = bands(percent)[band + 1] - 1
        need = most * (100 - percent) // percent + 1  # H + 1 units
        self.slack = max(2, -(-need // 8)) if need > 1 else 0  # spent on small subsets
        units = need + self.slack
        self.wide = need // 64
        self.single = units - 2 * self.wide
        if not cut:
            return
        ends = [i << 64 for i in range(1, self.single + 1)] + [(self.single + 2 * i) << 64 for i in range(1, self.wide + 1)]
        self.edges = np.array([e // units for e in ends[:-1]], np.uint64)
        self.salt = common.mix(np.arange(len(ends), dtype=np.uint64) + np.uint64((band + 1) << 32))


@lru_cache(512)
def plan(band: int, percent: int, cut: bool = True) -> Plan:
    return Plan(band, percent, cut)


def shingles(h: np.ndarray, n: int = SHINGLE) -> np.ndarray:
    """Sorted distinct hashes of the n-word shingles, from those of the words; a shorter text is one shingle."""
    if not len(h):
        return h
    if len(h) < n:
        return common.gram_hashes(h, len(h)) ^ np.uint64(len(h))
    g = np.sort(common.gram_hashes(h, n))
    return g[np.r_[True, g[1:] != g[:-1]]]


def exact_shingles(words: list[bytes], n: int = SHINGLE) -> set:
    if len(words) < n:
        return {tuple(words)} if words else set()
    return set(zip(*(words[i:] for i in range(n))))


def _parity_bytes(size: int) -> int:
    """Bytes of a set's parities: a place for each element, in a power of two."""
    return max(64, 1 << (size - 1).bit_length()) >> 3


def _parity(s: np.ndarray) -> bytes:
    """A bit for each place: whether an odd number of the set's elements falls there."""
    places = 8 * _parity_bytes(len(s))
    odd = np.bincount((s & np.uint64(places - 1)).astype(np.int64), minlength=places) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def _least_apart(x: bytes, y: bytes) -> int:
    """Elements that only one of two sets has, at least: places where their parities differ.

    The longer one is folded to the places of the shorter one.
    """
    n = 8 * min(len(x), len(y))
    ends = []
    for data in (x, y):
        bits, have = int.from_bytes(data, "little"), 8 * len(data)
        while have > n:
            have >>= 1
            bits = bits >> have ^ bits & (1 << have) - 1
        ends.append(bits)
    return (ends[0] ^ ends[1]).bit_count()


def signatures(s: np.ndarray, percent: int) -> np.ndarray:
    """Signatures of a set; the salts of segments tell bands and segments apart."""
    starts = bands(percent)
    band = int(np.searchsorted(starts, len(s), "right")) - 1
    mixed = common.mix(s)
    total = np.zeros(len(s) + 1, np.uint64)
    np.cumsum(mixed, out=total[1:])
    out = []
    for k in (band, band - 1):
        if k < 0:
            continue
        p = plan(k, percent)
        cut = np.zeros(len(p.salt) + 1, np.int64)
        cut[1:-1] = np.searchsorted(s, p.edges)
        cut[-1] = len(s)
        size = np.diff(cut)
        sums = total[cut[1:]] - total[cut[:-1]]
        sig = common.mix(sums + p.salt)
        one = sig[: p.single]
        if p.slack:
            one = one[np.lexsort((one, size[: p.single]))[p.slack :]]
        out.append(one)
        if p.wide:
            lo, n = cut[p.single], size[p.single :]
            gone = common.mix(np.repeat(sums[p.single :] + p.salt[p.single :], n) - mixed[lo:])
            out += [sig[p.single :], gone]
    return np.unique(np.concatenate(out))


def _pack(x: np.ndarray) -> bytes:
    return np.ascontiguousarray(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :SENT]).tobytes()


def _unpack(data: bytes) -> np.ndarray:
    out = np.zeros((len(data) // SENT, 8), np.uint8)
    out[:, :SENT] = np.frombuffer(data, np.uint8).reshape(-1, SENT)
    return out.reshape(-1).view("<u8").copy()


def _planes(x: np.ndarray) -> bytes:
    """Integers as their first bytes, their second bytes and so on: planes of zeros take no room in a shuffle file."""
    return np.ascontiguousarray(x.astype("<i8").view(np.uint8).reshape(-1, 8).T).tobytes()


def _whole(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).reshape(-1).view("<i8")


def _near(a: np.ndarray, b: np.ndarray, percent: int) -> np.ndarray:
    """Whether two set sizes allow the similarity at all."""
    return np.minimum(a, b) * 100 >= percent * np.maximum(a, b)


def _stars(sig: np.ndarray, doc: np.ndarray):
    """Lists of two or more: positions of the smallest member and of each other one."""
    order = np.lexsort((doc, sig))
    s = sig[order]
    new = np.r_[True, s[1:] != s[:-1]] if len(s) else np.empty(0, bool)
    head = order[np.flatnonzero(new)][np.cumsum(new) - 1] if len(s) else order
    return head[~new], order[~new], order[new]


def _map(percent: int, bits: int):
    shift = np.uint64(64 - bits)
    told = np.uint64((1 << 64) - (1 << (64 - bits)) | (1 << 8 * SENT) - 1)

    def emit(state, base: int):
        ids, sizes, nulls, sigs, owner, same, bits = state
        ids, sizes = np.array(ids, np.int64), np.array(sizes, np.int64)
        rows: list[tuple[int, int, bytes]] = [(_INFO, base, np.array([len(ids)], "<i8").tobytes() + _planes(np.concatenate([ids, sizes])) + b"".join(bits))]
        if nulls:
            rows.append((_INFO, -1, np.array(nulls, np.int64).tobytes()))
        if same:
            rows.append((_SAME, base, np.array(same, np.int64).tobytes()))
        if sigs:
            sig = np.concatenate(sigs) & told
            who = np.repeat(np.array(owner, np.int64), [len(x) for x in sigs])
            head, other, keep = _stars(sig, ids[who])
            if len(head):
                ok = _near(sizes[who[head]], sizes[who[other]], percent)
                edge = np.concatenate([sig[other].view(np.int64), ids[who[head]], ids[who[other]], ok.astype(np.int64)])
                rows.append((_EDGE, base, _planes(edge)))
            keep = np.sort(keep)
            sig, who = sig[keep], who[keep]
            bucket = (sig >> shift).astype(np.int64)
            order = np.argsort(bucket, kind="stable")
            sig, who, bucket = sig[order], who[order], bucket[order]
            cuts = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1]])
            for a, z in zip(cuts, np.r_[cuts[1:], len(bucket)]):
                w = who[a:z]
                first = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
                n = np.diff(np.r_[first, len(w)])
                head = np.array([len(first)], "<i8").tobytes()
                rows.append((_LIST, int(bucket[a]), head + _planes(np.concatenate([ids[w[first]], sizes[w[first]], n])) + _pack(sig[a:z])))
        kind, at, data = zip(*rows)
        return pa.RecordBatch.from_arrays([pa.array(kind, pa.int32()), pa.array(at, pa.int64()), pa.array(data, pa.binary())], names=["kind", "bucket", "data"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fresh = lambda: ([], [], [], [], [], [], [])
        state, n, seen, base = fresh(), 0, {}, 0
        for b in batches:
            words = (x for _, some in common.word_streams(b.column(1), lower=True) for x in some)
            for i, text, h in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), words):
                s = shingles(h)
                if i is None:
                    state[2].append(len(s))
                    continue
                state[0].append(i)
                state[1].append(len(s))
                state[6].append(_parity(s))
                if len(s):
                    key = common.xxhash.xxh3_128_digest(s.tobytes())
                    if key in seen and seen[key][1].lower().split() == text.lower().split():
                        state[5].append((seen[key][0], i))
                    else:  # also where only the hashes are the same
                        seen[key] = i, text
                        sig = signatures(s, percent)
                        state[3].append(sig)
                        state[4].append(len(state[0]) - 1)
                        n += len(sig)
                if n >= CHUNK_SIGNATURES or len(state[0]) >= CHUNK_DOCS:
                    yield emit(state, base)
                    state, n, seen, base = fresh(), 0, {}, base + 1
        if state[0] or state[2]:
            yield emit(state, base)

    return run


def _reduce(percent: int, bits: int):
    names = ["kind", "sig", "a", "b", "n", "bits"]

    def rows(kind: int, sig=None, a=None, b=None, n=None, size: int = 0, bits=None):
        null = pa.nulls(size, pa.int64())
        numbers = [null if x is None else pa.array(np.ascontiguousarray(x).view(np.int64)) for x in (sig, a, b, n)]
        return pa.RecordBatch.from_arrays([pa.array(np.full(size, kind, np.int32)), *numbers, pa.nulls(size, pa.binary()) if bits is None else bits], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        for batch in batches:
            for kind, bucket, data in zip(*(c.to_pylist() for c in batch.columns)):
                if kind == _INFO and bucket < 0:
                    x = np.frombuffer(data, np.int64)
                    yield rows(_INFO, n=x, size=len(x))
                elif kind == _INFO:
                    d = int(np.frombuffer(data, "<i8", 1)[0])
                    a, n = _whole(data[8 : 8 + 16 * d]).reshape(2, d)
                    ends = np.cumsum([8 + 16 * d, *map(_parity_bytes, n.tolist())])
                    yield rows(_INFO, a=a, n=n, size=d, bits=pa.array([data[x:y] for x, y in zip(ends[:-1], ends[1:])], pa.binary()))
                elif kind == _SAME:
                    a, b = np.frombuffer(data, np.int64).reshape(-1, 2).T
                    yield rows(_SAME, a=a, b=b, size=len(a))
                elif kind == _EDGE:
                    sig, a, b, ok = _whole(data).reshape(4, -1)
                    yield rows(_EDGE, sig, a, b, ok, len(a))
                else:
                    d = int(np.frombuffer(data, "<i8", 1)[0])
                    ids, sizes, n = _whole(data[8 : 8 + 24 * d]).reshape(3, d)
                    sig = _unpack(data[8 + 24 * d :]) | (np.uint64(bucket) << np.uint64(64 - bits))
                    held.append((sig, np.repeat(ids, n), np.repeat(sizes, n)))
        if held:
            sig, doc, size = (np.concatenate(x) for x in zip(*held))
            del held
            head, other, _ = _stars(sig, doc)
            for lo in range(0, len(head), 50_000):
                h, o = head[lo : lo + 50_000], other[lo : lo + 50_000]
                yield rows(_EDGE, sig[o], doc[h], doc[o], _near(size[h], size[o], percent).astype(np.int64), len(h))

    return run


def _verify(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, set] = {}

        def of(i: int, text: bytes | None, hold: bool) -> set:
            s = kept.get(i)
            if s is None:
                s = exact_shingles(text.lower().split()) if text else set()
                if hold:
                    if len(kept) >= 16:
                        kept.clear()
                    kept[i] = s
            return s

        for b in batches:
            left, right = [], []
            for i, j, x, y in zip(*(c.to_pylist() for c in b.columns)):
                p, q = of(i, x, True), of(j, y, False)
                both = len(p & q)
                if both and 100 * both >= percent * (len(p) + len(q) - both):
                    left.append(i)
                    right.append(j)
            yield pa.RecordBatch.from_arrays([pa.array(left, pa.int64()), pa.array(right, pa.int64())], names=["a", "b"])

    return run


def _oriented(pairs: DataFrame) -> DataFrame:
    """(hub, other) of pairs (a, b): the hub is the end with more pairs."""
    ends = pairs.select(F.col("a").alias("id")).unionByName(pairs.select(F.col("b").alias("id"))).groupBy("id").count()
    for end in ("a", "b"):
        pairs = pairs.join(ends.select(F.col("id").alias(end), F.col("count").alias(f"n_{end}")), end)
    a_first = F.col("n_a") >= F.col("n_b")
    return pairs.select(F.when(a_first, F.col("a")).otherwise(F.col("b")).alias("hub"), F.when(a_first, F.col("b")).otherwise(F.col("a")).alias("other"))


def _may_link(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sizes, x, y = b.column(2).to_pylist(), b.column(3).to_pylist(), b.column(4).to_pylist()
            keep = [(100 + percent) * _least_apart(p, q) <= (100 - percent) * n for n, p, q in zip(sizes, x, y)]
            yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep, pa.bool_())) for c in b.columns[:2]], names=["a", "b"])

    return run


def _plausible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b), a written table, that the parities in `sets` (id, size, bits) don't rule out."""
    x, y = (sets.select(F.col("id").alias(end), F.col("size").alias(f"size_{end}"), F.col("bits").alias(f"bits_{end}")) for end in "ab")
    both = x.join(common.sized(pairs), "a").join(y, "b").select("a", "b", F.expr("size_a + size_b"), "bits_a", "bits_b")
    return both.mapInArrow(common.tidy(_may_link(percent)), "a long, b long").distinct()


def verified(pairs: DataFrame, rows: DataFrame, sets: DataFrame, percent: int, scratch: common.Scratch, name: str) -> DataFrame:
    """The pairs (a, b), a written table, whose texts in `rows` (id, text) are similar enough.

    Those that `sets` (id, size, bits) rules out go first. The others are narrow
    and go to the texts of their other ends; those texts then move once, to their
    hubs, whose own texts move once too.
    """
    pairs = scratch.table(_plausible(pairs, sets, percent), f"{name}_plausible")
    oriented = scratch.table(_oriented(pairs), f"{name}_oriented")
    hubs = scratch.table(oriented.select(F.col("hub").alias("id")).distinct(), f"{name}_hubs")
    others = rows.join(common.sized(oriented), F.col("id") == F.col("other")).select("hub", "other", F.col("text").alias("y"))
    both = others.join(rows.join(common.sized(hubs), "id", "left_semi").select(F.col("id").alias("hub"), F.col("text").alias("x")), "hub")
    found = both.select("hub", "other", "x", "y").mapInArrow(common.tidy(_verify(percent)), "a long, b long")
    links = scratch.table(found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(), name)
    scratch.drop(f"{name}_plausible", f"{name}_oriented", f"{name}_hubs")
    common.release(scratch.spark)
    return links


def jaccard_links(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> tuple[DataFrame, DataFrame]:
    """(sizes, components): (id, n_shingles) of each row, (node, component) of each linked id."""
    if not 50 <= percent <= 100:
        raise ValueError("percent must be between 50 and 100")
    spark = docs.sparkSession
    scratch = common.Scratch(spark)
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    n_bytes = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = common.partitions(spark, n_bytes / 10, 7.5e5)  # about one signature in ten bytes
    bits = max(8, int(np.ceil(np.log2(4 * parts))))
    schema = T.StructType([T.StructField("kind", T.IntegerType())] + [T.StructField(c, T.LongType()) for c in ("sig", "a", "b", "n")] + [T.StructField("bits", T.BinaryType())])
    # lists meet by their bucket; what needs no meeting is spread
    mapped = rows.mapInArrow(common.tidy(_map(percent, bits)), "kind int, bucket long, data binary")
    found = scratch.table(
        mapped.repartition(parts, F.when(F.col("kind") == _LIST, F.col("bucket")).otherwise(F.xxhash64("data"))).mapInArrow(common.tidy(_reduce(percent, bits)), schema),
        "found",
    )
    common.release(spark)
    sizes = found.filter(F.col("kind") == _INFO).select(F.col("a").alias("id"), F.col("n").alias("n_shingles"))
    sets = found.filter((F.col("kind") == _INFO) & F.col("a").isNotNull()).select(F.col("a").alias("id"), F.col("n").alias("size"), "bits")
    edges = found.filter(F.col("kind") == _EDGE)
    same = found.filter((F.col("kind") == _SAME) & (F.col("a") != F.col("b"))).select("a", "b")

    # one star edge per document: that with most common lists, then the smallest centre
    shared = edges.filter("n = 1 AND a != b").groupBy("a", "b").count().filter(F.col("count") >= FIRST_LISTS)
    first = scratch.table(
        shared.groupBy("b").agg(F.max_by("a", F.struct("count", -F.col("a"))).alias("a")).select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct(),
        "first",
    )
    links = scratch.table(verified(first, rows, sets, percent, scratch, "links1").unionByName(same), "links")
    scratch.drop("links1")
    components = scratch.table(connected_components(links), "components1")

    # lists whose members are still apart: their most popular members are the next centres
    tried = [first]
    for turn in range(CENTRE_ROUNDS):
        members = _open(edges, components, scratch, f"members{turn}")
        again = scratch.table(_centres(members, scratch).join(_union(tried), ["a", "b"], "left_anti"), f"again{turn}")
        more = verified(again, rows, sets, percent, scratch, f"more{turn}")
        tried.append(again)
        if more.isEmpty():
            break
        components = scratch.table(extended(components, more), f"components_with{turn}")
    else:
        members = _open(edges, components, scratch, "members")
        scratch.drop(*(f"members{turn}" for turn in range(CENTRE_ROUNDS)))
    inner = common.Scratch(spark)  # nothing reads its tables once the pairs are written
    pairs = inner.table(_across(members, rows, percent, inner), "across")
    second = scratch.table(pairs.join(_union(tried), ["a", "b"], "left_anti"), "second")
    inner.drop("")
    more = verified(second, rows, sets, percent, scratch, "links2")
    if not more.isEmpty():
        components = scratch.table(extended(components, more), "components2")
    return sizes, components


def _union(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t)
    return out


def _open(edges: DataFrame, components: DataFrame, scratch: common.Scratch, name: str) -> DataFrame:
    """(sig, id, of): members, with their components, of the lists that hold more than one component."""
    label = common.sized(components)
    marked = edges.select("sig", "a", "b")
    for end in ("a", "b"):
        marked = marked.join(label.select(F.col("node").alias(end), F.col("component").alias(f"of_{end}")), end, "left").withColumn(f"of_{end}", F.coalesce(f"of_{end}", end))
    apart = scratch.table(marked.filter("of_a != of_b").select("sig").distinct(), f"{name}_lists")
    inside = marked.join(common.sized(apart), "sig", "left_semi")
    both = inside.select("sig", F.col("a").alias("id"), F.col("of_a").alias("of")).unionByName(inside.select("sig", F.col("b").alias("id"), F.col("of_b").alias("of")))
    return scratch.table(both.distinct(), name)


def _tops(members: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(sig, c, of_c): the most popular member of each list, and its component."""
    lengths = members.groupBy("sig").agg(F.count(F.lit(1)).alias("length"))
    popular = scratch.table(members.join(lengths, "sig").groupBy("id").agg(F.sum("length").alias("rank")), f"popular{uuid.uuid4().hex}")
    top = members.join(common.sized(popular), "id").groupBy("sig").agg(F.max_by(F.struct(F.col("id").alias("c"), F.col("of").alias("of_c")), F.struct("rank", -F.col("id"))).alias("top"))
    return top.select("sig", "top.*")


def _centres(members: DataFrame, scratch: common.Scratch) -> DataFrame:
    """Pairs (a, b) of a member and, of the most popular members of its lists, the one it meets most often.

    A document is as popular as its lists are long: in a group of copies that
    were edited one by one, that is the text they were made from.
    """
    centre = _tops(members, scratch)
    met = members.join(centre, "sig").filter("of != of_c").groupBy("id", "c").count()
    best = met.groupBy("id").agg(F.max_by("c", F.struct("count", -F.col("c"))).alias("c"))
    return best.select(F.least("id", "c").alias("a"), F.greatest("id", "c").alias("b")).distinct()


def _pivots(members: DataFrame, scratch: common.Scratch) -> DataFrame:
    """(id, of, pivot): pivots of every document, such that two of one list have a pivot in common.

    First the one it meets most often of the most popular members of its lists,
    or that one's own pivot. Where the members of a list got different ones, they
    also get the pivot of the list's most popular member. That is at most one row
    per member of a list.
    """
    met = scratch.table(members.join(_tops(members, scratch).select("sig", "c"), "sig"), "met")
    main = met.groupBy("id", "c").count().groupBy("id").agg(F.max_by("c", F.struct("count", -F.col("c"))).alias("pivot"))
    main = scratch.table(main, "main_pivots")
    for turn in range(PIVOT_STEPS):
        up = common.sized(main).select(F.col("id").alias("pivot"), F.col("pivot").alias("next"))
        main = scratch.table(main.join(up, "pivot").select("id", F.col("next").alias("pivot")), f"main_pivots{turn}")
    split = met.join(common.sized(main), "id").groupBy("sig").agg(F.min("pivot").alias("low"), F.max("pivot").alias("high"), F.first("c").alias("c")).filter("low != high")
    theirs = scratch.table(split.select("sig", F.col("c").alias("id")).join(common.sized(main), "id").select("sig", "pivot"), "split")
    own = met.join(common.sized(theirs), "sig").select("id", "pivot")
    return main.select("id", "pivot").unionByName(own).distinct().join(members.select("id", "of").distinct(), "id")


def _apart(x: np.ndarray, pivot: np.ndarray) -> np.ndarray:
    """The shingles that only one of two sets has, those of the first set first."""
    return np.concatenate([np.setdiff1d(x, pivot, assume_unique=True), np.setdiff1d(pivot, x, assume_unique=True)])


def _sets(column) -> list[np.ndarray]:
    return [shingles(h) for _, some in common.word_streams(column, lower=True) for h in some]


def _popular(table: pa.Table) -> pa.Table:
    """(pivot, x, y) of one pivot -> the shingles that differ from it in most of these documents, ascending."""
    pivot = _sets(table.column("y").slice(0, 1))[0]
    found, n = np.unique(np.concatenate([_apart(x, pivot) for x in _sets(table.column("x"))]), return_counts=True)
    order = np.argsort(n, kind="stable")[np.count_nonzero(n < 2) :][-POPULAR:]
    return pa.table({"pivot": table.column("pivot").slice(0, 1), "popular": pa.array([found[order].view(np.int64)], pa.list_(pa.int64()))})


def _differences(percent: int):
    """(id, of, pivot, text, text of the pivot, popular) -> sizes, d, and the first of the d shingles that only one text has.

    Their order is the same for all documents of a pivot: first those that the
    pivot hasn't, as edits are rarer than what is left of it, and at last the popular ones.
    """
    much, less = 100 + percent, 100 - percent

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple] = {}
        for b in batches:
            pivots = b.column(2).to_pylist()
            if len(held) > 256:
                held.clear()
            new = {p: k for k, p in enumerate(pivots) if p not in held}
            known = b.take(pa.array(new.values(), pa.int64()))
            for p, y, late in zip(new, _sets(known.column(4)), known.column(5)):
                late = np.array(late.values, np.int64).view(np.uint64) if late.is_valid else np.empty(0, np.uint64)
                order = np.argsort(late, kind="stable")
                held[p] = y, late[order], order + 1
            sizes, d, first = [], [], []
            for x, p in zip(_sets(b.column(3)), pivots):
                y, late, rank = held[p]
                apart = _apart(x, y)
                if len(late):
                    at = np.minimum(np.searchsorted(late, apart), len(late) - 1)
                    apart = apart[np.argsort(np.where(late[at] == apart, rank[at], 0), kind="stable")]
                t = less * (len(x) + len(x) * 100 // percent) // much
                sizes.append((len(x), len(y)))
                d.append(len(apart))
                first.append(apart[: max(t + 1, 0)])
            s, s_pivot = np.array(sizes, np.int64).reshape(-1, 2).T
            ends = np.r_[0, np.cumsum([len(x) for x in first])]
            first = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(np.concatenate([*first, np.empty(0, np.uint64)]).view(np.int64)))
            yield pa.RecordBatch.from_arrays([*b.columns[:3], *map(pa.array, (s, s_pivot)), pa.array(d, pa.int64()), first], names=["id", "of", "pivot", "s", "s_pivot", "d", "first"])

    return run


def _across(members: DataFrame, rows: DataFrame, percent: int, scratch: common.Scratch) -> DataFrame:
    """Pairs (a, b) of one list, in different components, that may be similar enough; no other pair is.

    Let D be the shingles in which a document and its pivot differ, d their
    number and t the difference that two sizes allow. Documents with d <= t are
    linked with the pivot. Others, the outer ones, link only with a document
    whose D has (d + d' - t) / 2 shingles or more in common with theirs. Then the
    two have one of the first shingles of their D in common (a prefix filter): of
    the one with the smaller d the first t / 2 + 1, of the other the first t + 1,
    as d and d' differ by t at most. Any order does, if it is the same for a
    pivot's documents; in this one the rare ones come first, as far as
    `CROWD_SAMPLE` of a pivot's documents show which those are. Copies that were
    edited one by one share what is left of the pivot, but hardly any of their
    edits, so few pairs meet.
    """
    much, less = 100 + percent, 100 - percent
    pivots = scratch.table(_pivots(members, scratch), "pivots")
    scratch.drop("met", "main_pivots", *(f"main_pivots{turn}" for turn in range(PIVOT_STEPS)), "split")
    chosen = rows.join(common.sized(scratch.table(pivots.select(F.col("pivot").alias("id")).distinct(), "pivot_ids")), "id", "left_semi")
    chosen = chosen.groupBy(F.col("id").alias("pivot")).agg(F.min("text").alias("y"))
    chosen = scratch.table(chosen, "chosen")
    own = rows.select("id", F.col("text").alias("x"))  # narrow rows go to the texts, which move once, to their pivots
    crowds = scratch.table(pivots.groupBy("pivot").count().filter(F.col("count") > CROWD).select("pivot"), "crowds")
    nth = F.row_number().over(Window.partitionBy("pivot").orderBy(F.xxhash64("id")))
    some = pivots.join(common.sized(crowds), "pivot").select("id", "pivot").withColumn("nth", nth).filter(F.col("nth") <= CROWD_SAMPLE)
    some = own.join(common.sized(scratch.table(some.select("id", "pivot"), "some")), "id").join(chosen, "pivot").select("pivot", "x", "y")
    popular = scratch.table(some.groupBy("pivot").applyInArrow(_popular, "pivot long, popular array<bigint>"), "popular")
    kinds = "id long, of long, pivot long, s long, s_pivot long, d long, first array<bigint>"
    slices, parts = -(-5 * pivots.count() // (4 * common.BROADCAST_ROWS)) or 1, []
    for k in range(slices):  # by pivot, few enough rows for a broadcast each: else all texts would move, also those in no list
        here = F.pmod(F.xxhash64("pivot"), F.lit(slices)) == k
        some = scratch.table(pivots.filter(here), f"pivots{k}")
        both = own.join(common.sized(some), "id").join(chosen.filter(here).join(popular, "pivot", "left"), "pivot").select("id", "of", "pivot", "x", "y", "popular")
        parts.append(scratch.table(both.mapInArrow(common.tidy(_differences(percent)), kinds), f"placed{k}"))
    placed = _union(parts).withColumn("outer", F.expr(f"{much} * d > {less} * (s + s_pivot)"))
    scratch.drop("pivots", *(f"pivots{k}" for k in range(slices)), "pivot_ids", "chosen", "crowds", "some", "popular")
    direct = placed.filter(~F.col("outer") & (F.col("id") != F.col("pivot"))).select(F.least("id", "pivot").alias("a"), F.greatest("id", "pivot").alias("b"))

    bounds = placed.groupBy("pivot").agg(F.max("s").alias("s_most"), F.min("d").alias("d_least"), F.min(F.when(F.col("outer"), F.col("d"))).alias("d_outer")).filter("d_outer IS NOT NULL")
    allowed = F.floor(F.lit(less) * (F.col("s") + F.least("s_most", F.floor(F.col("s") * 100 / percent))) / much)
    near = placed.join(common.sized(scratch.table(bounds, "bounds")), "pivot").withColumn("t", allowed)
    how_many = lambda other: F.greatest(F.lit(0), F.col("d") + 1 - F.greatest(F.lit(1), F.ceil((other + F.col("d") - F.col("t")) / 2))).cast("int")

    def end(x: str, other) -> DataFrame:
        """Rows by the key of a shingle of a pivot; sizes and difference travel in one number."""
        sizes = (F.col("s") * (1 << 32) + F.col("d") * 2 + F.col("outer").cast("long")).alias(f"sizes_{x}")
        dealt = near.select(F.explode(F.slice("first", 1, how_many(other))).alias("e"), "pivot", F.col("id").alias(f"id_{x}"), F.col("of").alias(f"of_{x}"), sizes)
        return dealt.select(F.xxhash64("pivot", "e").alias("key"), f"id_{x}", f"of_{x}", f"sizes_{x}")

    met = end("x", F.greatest("d_outer", "d")).join(end("y", F.greatest(F.col("d_least"), F.col("d") - F.col("t"))), "key").filter("of_x != of_y AND id_x != id_y")
    for x in "xy":
        sizes = F.col(f"sizes_{x}")
        met = met.withColumns({f"s_{x}": F.shiftright(sizes, 32), f"d_{x}": F.shiftright(sizes.bitwiseAND((1 << 32) - 1), 1), f"outer_{x}": sizes.bitwiseAND(1) == 1})
    met = met.filter("of_x != of_y AND (d_x < d_y OR d_x = d_y AND id_x < id_y) AND (outer_x OR outer_y)")
    met = met.filter(f"100 * least(s_x, s_y) >= {percent} * greatest(s_x, s_y) AND {much} * (d_y - d_x) <= {less} * (s_x + s_y)")
    return direct.unionByName(met.select(F.least("id_x", "id_y").alias("a"), F.greatest("id_x", "id_y").alias("b"))).distinct()


def jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT) -> DataFrame:
    """One row per input row: id (long), n_shingles, component_id.

    Two documents link when 100 * |intersection| >= percent * |union| of their
    sets of 5-word shingles after lower-casing A-Z. `component_id` is the
    smallest id that links reach.

    - null text, and text without words: an empty set, linked with nothing.
    - fewer than five words: the whole sequence is the one shingle.
    - a null id can't be linked; its component_id is null.
    - rows that repeat an id are one node: what links with any of them links with all.
    - an empty table gives an empty result; other columns are not read.
    """
    sizes, components = jaccard_links(docs, id_col, text_col, percent)
    labelled = sizes.join(common.sized(components), F.col("id") == F.col("node"), "left")
    return labelled.select(F.col("id").alias(id_col), "n_shingles", F.coalesce("component", "id").alias("component_id"))
