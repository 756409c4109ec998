"""Benchmark decontamination by latent semantic retrieval.

Passages are runs of words; their terms are hashed words, lower-cased and
without punctuation. One pass over all documents counts in how many passages
each term occurs, and sums the product A'(A W) of the passage-term matrix A with
a random W of small integers: a randomised SVD from one pass (Nystrom's form, since
A'A is positive), after the inverse document frequencies are applied to the rows
of the sketch. Entries of A and W are integers, so the sums are exact and don't
depend on how rows are dealt. A last pass slides windows of each benchmark length
class over every document, compares them with the items by cosine in the latent
space, and checks candidates: the longest common subsequence of the item and the
passage, where they share enough words for it, and whether the item's answer
(its last sentence) is there too.

Counts and sketch are summed by ranges of terms, from a few tasks a core; items
are broadcast in blocks of a fixed number, one block after another in the same
pass.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

TERMS, RANK, PASSAGE, SEED = 1 << 14, 48, 64, 5
#: Leading axes left out: they tell languages and registers apart, not passages.
COMMON_AXES = 8
#: Cosine from which a window is a candidate for an item.
COSINE = 0.3
#: Words of passages that are compared with items at a time.
CHECK_WORDS = 100_000
#: Bytes of text that are searched at a time: their vectors stay in the cache.
SLICE_BYTES = 1 << 18
#: Share of the item's words that its longest common subsequence with the passage
#: must have: alone, and if the answer is found as well.
VERBATIM, PARAPHRASE, ANSWER = 0.8, 0.6, 0.5
#: Words whose passages are summed at a time, and occurrences of a term that are summed first.
SKETCH_WORDS, RUN = 1 << 20, 16
#: Ranges of terms whose sums are added up apart, and tasks a core that read the documents for them.
SLICES, TASKS = 16, 4
#: Items of one broadcast block: a worker holds a byte for each of their pairs with a term.
BLOCK_ITEMS = 4_000
#: Window lengths in words; an item is compared with the first that holds it.
LENGTHS = (24, 32, 48, 64, 96, 128, 192, 256, 384, 512)

def terms_of(text: str) -> np.ndarray:
    """Term hashes of one text: words without case and punctuation."""
    return np.concatenate([x for _, got in common.word_streams(pa.array([text.encode()], pa.large_binary()), plain=True) for x in got] or [np.empty(0, np.uint64)])


def bucket(terms: np.ndarray) -> np.ndarray:
    return (terms >> np.uint64(64 - 14)).astype(np.int64)


def chunks(batches: Iterator[pa.RecordBatch], text: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    """Slices of the batches, and the terms of their texts."""
    for b in batches:
        for lo, docs in common.word_streams(b.column(text), plain=True, slice_bytes=SLICE_BYTES):
            yield b.slice(lo, len(docs)), docs


def random_matrix() -> np.ndarray:
    """int8[TERMS, RANK] of normal deviates, in steps of a 26th."""
    drawn = np.random.default_rng(SEED).standard_normal((TERMS, RANK)).astype(np.float32)
    return np.rint(26 * drawn).clip(-127, 127).astype(np.int8)


def _passages(docs: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of all texts, where their passages begin, and terms and passages in the order of terms."""
    sizes = np.array([len(d) for d in docs])
    ids = bucket(np.concatenate(docs))
    starts = np.cumsum(sizes) - sizes
    each = -(-sizes // PASSAGE)
    of = np.repeat(starts, each) + PASSAGE * (np.arange(each.sum()) - np.repeat(np.cumsum(each) - each, each))
    row = np.repeat(np.arange(len(of), dtype=np.int32), np.diff(np.r_[of, len(ids)]))
    order = np.argsort(ids.astype(np.uint16), kind="stable")
    return ids, of, ids[order], row[order]


def _padded(values: np.ndarray, starts: np.ndarray, width: int, none: int) -> tuple[np.ndarray, np.ndarray]:
    """The runs of `values` that begin at `starts` as rows of `width`, padded with `none`, and the first row of each run."""
    sizes = np.diff(np.r_[starts, len(values)])
    rows = -(-sizes // width)
    first = np.cumsum(rows) - rows
    held = np.full(rows.sum() * width, none, np.int32)
    held[np.arange(len(values)) + np.repeat(first * width - starts, sizes)] = values
    return held.reshape(-1, width), first


def _collected(batches: Iterator[pa.RecordBatch]) -> Iterator[list[np.ndarray]]:
    """Terms of texts that have some, about SKETCH_WORDS at a time."""
    held, n = [], 0
    for _, docs in chunks(batches, 0):
        some = [d for d in docs if len(d)]
        held += some
        n += sum(map(len, some))
        if n >= SKETCH_WORDS:
            yield held
            held, n = [], 0
    if held:
        yield held


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> (slice, passages, data): of each term of a slice the passages that have it and its row of A'(A W)."""
    w = np.r_[random_matrix(), np.zeros((1, RANK), np.int8)]
    total, passages = np.zeros((TERMS, 1 + RANK), np.int64), 0
    for docs in _collected(batches):
        ids, of, i, r = _passages(docs)
        passages += len(of)
        once = np.r_[True, (i[1:] != i[:-1]) | (r[1:] != r[:-1])]
        total[:, 0] += np.bincount(i[once], minlength=TERMS)
        words, _ = _padded(ids, of, PASSAGE, TERMS)
        has = np.zeros((len(of) + 1, RANK), np.int16)  # A W, at most 127 a term, and a row of zeros
        for column in words.T:
            has[:-1] += w.take(column, axis=0)
        has = has.astype(np.int32)
        first = np.flatnonzero(np.r_[True, i[1:] != i[:-1]])
        found, runs = _padded(r, first, RUN, len(of))
        some = np.zeros((len(found), RANK), np.int32)
        for column in found.T:
            some += has.take(column, axis=0)
        total[i[first], 1:] += np.add.reduceat(some.astype(np.int64), runs, axis=0)
    if passages:
        parts = [_packed(x) for x in np.split(total, SLICES)]
        yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array([passages] * SLICES), pa.array(parts, pa.binary())], names=["slice", "passages", "data"])


def _packed(x: np.ndarray) -> bytes:
    """Integers in four bytes each where those hold them, else in eight."""
    return x.astype("<i4" if -(1 << 31) < x.min() and x.max() < 1 << 31 else "<i8").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    n = TERMS // SLICES * (1 + RANK)
    return np.frombuffer(data, f"<i{len(data) // n}").reshape(-1, 1 + RANK)


def _add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of `_sketch`, one for each slice."""
    held: dict[int, list] = {}
    for b in batches:
        for k, passages, data in zip(*(c.to_pylist() for c in b.columns)):
            one = held.setdefault(k, [0, np.zeros((TERMS // SLICES, 1 + RANK), np.int64)])
            one[0] += passages
            one[1] += _unpacked(data)
    for k, (passages, sums) in held.items():
        yield pa.RecordBatch.from_arrays([pa.array([k], pa.int32()), pa.array([passages]), pa.array([_packed(sums)], pa.binary())], names=["slice", "passages", "data"])


def learned(docs: DataFrame, text_col: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Passages of all documents, those of each term, and the sketch A'(A W)."""
    rows = docs.select(F.col(text_col).cast("string").cast("binary").alias("text"))
    schema, passages, total = "slice int, passages long, data binary", 0, np.zeros((SLICES, TERMS // SLICES, 1 + RANK), np.int64)
    tasks = rows.coalesce(TASKS * docs.sparkSession.sparkContext.defaultParallelism)  # their sums don't grow with the documents
    for r in tasks.mapInArrow(common.tidy(_sketch), schema).repartition(SLICES, "slice").mapInArrow(_add_up, schema).collect():  # SLICES rows of a fixed size
        passages, total[r["slice"]] = r["passages"], _unpacked(r["data"])
    total = total.reshape(TERMS, 1 + RANK)
    return passages, total[:, 0], total[:, 1:]


def inverse(passages: float, df: np.ndarray) -> np.ndarray:
    return np.log((passages + 1) / (df + 1)) + 0.05


def latent_space(passages: float, df: np.ndarray, sketch: np.ndarray) -> np.ndarray:
    """float32[TERMS, rank]: latent vector of a term, idf included, axes whitened.

    With D the idf weights, the matrix is A D; its sketch for the test matrix
    D^-1 W is D A'(A W), and the singular vectors follow from Nystrom's form.
    """
    idf = inverse(passages, df)
    y = idf[:, None] * sketch
    test = random_matrix() / idf[:, None]
    shift = 1e-6 * np.linalg.norm(y)
    y = y + shift * test
    core = test.T @ y
    values, vectors = np.linalg.eigh((core + core.T) / 2)
    good = values > values.max() * 1e-9
    half = vectors[:, good] / np.sqrt(values[good])
    basis, singular, _ = np.linalg.svd(y @ half, full_matrices=False)
    basis, singular = basis[:, COMMON_AXES:], singular[COMMON_AXES:]
    if not len(singular):  # fewer axes than are left out: a tiny input
        return np.zeros((TERMS, 1), np.float32)
    return (idf[:, None] * basis / np.maximum(singular, singular.max() * 1e-6)).astype(np.float32)


@dataclass
class Item:
    item: int
    terms: np.ndarray
    answer: np.ndarray


@dataclass
class Block:
    items: list[Item]
    latent: np.ndarray  # float32[TERMS, rank]
    idf: np.ndarray


def answer_of(text: str) -> str:
    """The last sentence: what a benchmark asks for stands at the end."""
    parts = [p for p in re.split(r"(?<=[.!?])\s+|\n+", text) if any(c.isalnum() for c in p)]
    return parts[-1] if parts else ""


def lcs(masks: dict[int, int], m: int, other: list[int]) -> int:
    """Length of the longest common subsequence, 64 rows at a time as bits of an integer."""
    full = (1 << m) - 1
    v = full
    for t in other:
        u = v & masks.get(t, 0)
        if u:
            v = ((v + u) | (v - u)) & full
    return m - v.bit_count()


def masks_of(terms: np.ndarray) -> dict[int, int]:
    out: dict[int, int] = {}
    for i, t in enumerate(terms.tolist()):
        out[t] = out.get(t, 0) | 1 << i
    return out


def judge(item: Item, passage: list[int], cache: dict) -> tuple[float, bool]:
    """(share of the item in common order, whether it counts as leaked)."""
    if id(item) not in cache:
        cache[id(item)] = masks_of(item.terms), masks_of(item.answer)
    masks, answer = cache[id(item)]
    n, k = len(item.terms), len(item.answer)
    share = lcs(masks, n, passage) / n
    if share >= VERBATIM:
        return share, True
    return share, share >= PARAPHRASE and (k == 0 or lcs(answer, k, passage) >= ANSWER * k)


class Finder:
    """Compares windows of documents with the items of one block."""

    def __init__(self, block: Block):
        self.block, self.cache = block, {}
        self.latent = np.ascontiguousarray(block.latent.T)
        self.classes: dict[int, list[int]] = {}
        for k, item in enumerate(block.items):
            if len(item.terms):
                size = next((n for n in LENGTHS if len(item.terms) <= n), -(-len(item.terms) // 512) * 512)
                self.classes.setdefault(size, []).append(k)
        unit = lambda x: x / np.maximum(np.linalg.norm(x, axis=-1, keepdims=True), 1e-9)
        self.vectors = {s: unit(np.array([block.latent[bucket(block.items[k].terms)].sum(axis=0) for k in ks])).astype(np.float32) for s, ks in self.classes.items()}
        self.has, self.keys, self.times, self.needed = {}, {}, {}, {}  # of each item its terms, and how often it has them
        for s, ks in self.classes.items():
            sizes = np.array([len(block.items[k].terms) for k in ks])
            each = np.repeat(np.arange(len(ks)) * TERMS, sizes) + bucket(np.concatenate([block.items[k].terms for k in ks]))
            self.keys[s], self.times[s] = np.unique(each, return_counts=True)
            self.has[s] = np.zeros(len(ks) * TERMS, bool)
            self.has[s][self.keys[s]] = True
            self.needed[s] = PARAPHRASE * sizes - 1e-9

    def __call__(self, docs: list[np.ndarray]) -> list[dict[int, float]]:
        """For each document its leaked items and the best share found of each."""
        found: list[dict[int, float]] = [{} for _ in docs]
        sizes = np.array([len(d) for d in docs], np.int64)
        if not sizes.sum():
            return found
        flat = np.concatenate(docs)
        ids = bucket(flat).astype(np.int32)
        starts = np.cumsum(sizes) - sizes
        total = np.zeros((len(self.latent), len(ids) + 1), np.float32)
        for axis, values in enumerate(self.latent):
            np.cumsum(values.take(ids, mode="clip"), out=total[axis, 1:])
        for size, ks in self.classes.items():
            step = size // 4
            # windows at every quarter of their length, and one at a document's end
            count = np.maximum(-(-(sizes - size) // step), 0) + 1
            count[sizes == 0] = 0
            doc = np.repeat(np.arange(len(docs)), count)
            nth = np.arange(len(doc)) - np.repeat(np.cumsum(count) - count, count)
            lo = np.minimum(nth * step, np.maximum(sizes[doc] - size, 0)) + starts[doc]
            hi = np.minimum(lo + size, starts[doc] + sizes[doc])
            z = np.empty((len(total), len(lo)), np.float32)
            for axis, row in enumerate(total):
                np.subtract(row.take(hi, mode="clip"), row.take(lo, mode="clip"), out=z[axis])
            floor = COSINE * np.sqrt(np.einsum("ij,ij->j", z, z))
            for at in range(0, len(ks), 512):
                item, win = np.nonzero(self.vectors[size][at : at + 512] @ z > floor)
                self._check(size, item + at, lo[win], hi[win], doc[win], flat, ids, starts, sizes, found)
        return found

    def _check(self, size, item, lo, hi, doc, flat, ids, starts, sizes, found) -> None:
        """Judges the passages, a quarter longer on both sides than the windows, that share enough words.

        A common subsequence has no more words than item and passage share, each
        counted as often as both have it, so none that `judge` accepts is left out.
        """
        has, keys, times, needed, ks = self.has[size], self.keys[size], self.times[size], self.needed[size], self.classes[size]
        begins, ends = np.maximum(lo - size // 4, starts[doc]), np.minimum(hi + size // 4, starts[doc] + sizes[doc])
        width = size + 2 * (size // 4)
        rows = max(1, CHECK_WORDS // width)
        for a in range(0, len(item), rows):
            j, x, y = item[a : a + rows], begins[a : a + rows], ends[a : a + rows]
            key = ids.take(x[:, None] + np.arange(width), mode="clip")
            key += (j * TERMS).astype(np.int32)[:, None]
            seen = has.take(key, mode="clip")
            short = np.flatnonzero(y - x < width)
            seen[short] &= np.arange(width) < (y - x)[short, None]
            some = np.flatnonzero(np.count_nonzero(seen, axis=1) >= needed[j])
            if not len(some):
                continue
            r, c = np.nonzero(seen[some])
            both, n = np.unique(r * len(keys) + np.searchsorted(keys, key[some[r], c]), return_counts=True)
            shared = np.bincount(both // len(keys), np.minimum(n, times[both % len(keys)]), len(some))
            for r in some[shared >= needed[j[some]]].tolist():
                k, d = self.block.items[ks[j[r]]], int(doc[a + r])
                share, leaked = judge(k, flat[int(x[r]) : int(y[r])].tolist(), self.cache)
                if leaked and share > found[d].get(k.item, 0):
                    found[d][k.item] = share


def fit(docs: DataFrame, benchmark: DataFrame, text_col: str, item_col: str, item_text: str) -> Iterator[Block]:
    """The items in blocks, with term weights and axes from all documents."""
    passages, df, sketch = learned(docs, text_col)
    latent = latent_space(passages, df, sketch) if passages else np.zeros((TERMS, RANK), np.float32)
    idf = inverse(passages, df).astype(np.float32)
    items: list[Item] = []
    texts = benchmark.filter(F.col(item_col).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_col).cast("long").alias("item"), F.col(item_text).cast("string").alias("text"))
    for r in texts.orderBy("item", "text").toLocalIterator():
        got = terms_of(r["text"])
        if len(got):
            items.append(Item(r["item"], got, terms_of(answer_of(r["text"]))))
        if len(items) == BLOCK_ITEMS:
            yield Block(items, latent, idf)
            items = []
    if items:
        yield Block(items, latent, idf)


def _chosen(rows: int, total: int) -> Column:
    """Whether a row is drawn, each by itself, so that equal texts count one by one.

    For callers who fit on fewer rows than they search; nothing here does.
    Four deviations are left free under the bound: more than `rows` of `total`
    rows are drawn once in tens of thousands of times.
    """
    if total <= rows:
        return F.lit(True)
    return F.rand(SEED) < max(rows - 4 * rows**0.5, 1) / total


def _find(shared):
    """(id, text, item_ids, shares) with the items that this block adds."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for b, docs in chunks(batches, 1):
            got = finder(docs)
            items = [sorted({*(old or ()), *new}) for old, new in zip(b.column(2).to_pylist(), got)]
            best = [max([old, *new.values()]) for old, new in zip(b.column(3).to_pylist(), got)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(items, pa.list_(pa.int64())), pa.array(best, pa.float64())], names=["id", "text", "item_ids", "share"])

    return run


def leaks(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """One row per input row: id, contaminated, item_ids, share.

    `item_ids` are the benchmark items found in the document, `share` is the
    largest share of an item's words that the document has in their order.

    - null and empty texts, and texts without words, contain nothing.
    - items that are null, or have no word, are in no document; an empty benchmark finds nothing.
    - items that are repeated are one item id each; equal windows are judged alike.
    - null ids pass through; repeated rows each give a row; an empty table gives an empty result.
    - whole texts are searched; other columns are not read.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"), F.array().cast("array<bigint>").alias("item_ids"), F.lit(0.0).alias("share"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType), T.StructField("text", T.BinaryType()), T.StructField("item_ids", T.ArrayType(T.LongType())), T.StructField("share", T.DoubleType())])
    rows = _through(spark, rows, fit(docs, benchmark, text_col, item_col, item_text), lambda df, shared: df.mapInArrow(common.tidy(_find(shared)), schema))
    return rows.select(F.col("id").alias(id_col), (F.size("item_ids") > 0).alias("contaminated"), "item_ids", "share")


def decontaminate(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> DataFrame:
    """The rows of `docs` that hold no benchmark item, with all their columns.

    Nulls, empty and long texts, repeated rows and items and empty tables as in
    `leaks`: a row goes or stays by its own text. Columns of any name pass through.
    """
    spark, schema = docs.sparkSession, docs.schema
    at = [c.lower() for c in docs.columns].index(text_col.lower())
    return _through(spark, docs, fit(docs, benchmark, text_col, item_col, item_text), lambda df, shared: df.mapInArrow(common.tidy(_keep(shared, at)), schema))


def _through(spark: SparkSession, rows: DataFrame, blocks: Iterator[Block], search) -> DataFrame:
    """`rows` searched for the items of one block after another.

    All passes but the last are written, so a task has one Python worker with one
    block, however many blocks there are; what a pass has read goes once it is
    written, its broadcast too.
    """
    scratch, last, n = common.Scratch(spark), None, 0
    for block in blocks:
        if last is not None:
            rows = scratch.table(search(rows, last), f"pass{n}")
            last.unpersist()
            if n:
                scratch.drop(f"pass{n - 1}")
            n += 1
        last = spark.sparkContext.broadcast(block)
    return search(rows, last) if last is not None else rows


def _keep(shared, text: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        finder = Finder(shared.value)
        for b, docs in chunks(batches, text):
            yield b.filter(pa.array([not x for x in finder(docs)], pa.bool_()))

    return run
