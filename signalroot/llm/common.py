"""Pieces that several text operators share: words, scratch tables, joins."""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import BROADCAST_ROWS, Scratch, release, sized  # noqa: F401  used through this module

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Words kept in a worker's lookup before it starts afresh: a bound on memory,
#: not on the words that are handled.
CACHE_WORDS = 400_000

def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ascii_lower(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; pure ASCII takes the fast built-in."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, UPPER, LOWER))


def partitions(spark: SparkSession, units: float, per_partition: float) -> int:
    """Shuffle partitions for `units` of work: never fewer than configured."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), int(units / per_partition) + 1)


#: Spark's bound on the bytes of rows that go to a Python worker at once.
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


@contextmanager
def small_batches(spark: SparkSession, size: str = "4m") -> Iterator[None]:
    """What is written inside goes through Python workers in batches of `size`; the setting is put back.

    A batch stands in the JVM's direct memory, in the worker as Arrow and once
    more as what the worker makes of it, so long texts in the usual 64 MB cost
    several times that for each core.
    """
    before = spark.conf.get(_BATCH_BYTES)
    spark.conf.set(_BATCH_BYTES, size)
    try:
        yield
    finally:
        spark.conf.set(_BATCH_BYTES, before)


class Lookup(dict):
    """word -> value, computed at the first sight of a word in this worker."""

    def __init__(self, make):
        super().__init__()
        self.make = make

    def __missing__(self, word):
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = self.make(word)
        return value


#: 64-bit hash of each word seen by this worker.
word_hash = Lookup(xxhash.xxh3_64_intdigest)


def hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(word_hash.__getitem__, words), np.uint64, len(words))


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser that spreads a 64-bit value over all its bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: Weights of the places of a run of words: unrelated, so that no sums of them coincide.
_ODD = np.random.default_rng(7).integers(1 << 62, (1 << 63) - 1, 64, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)


def gram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive words; empty with fewer words."""
    m = len(h) - n + 1
    if m <= 0:
        return np.empty(0, np.uint64)
    out = h[:m] * _ODD[0]
    for i in range(1, n):
        out += h[i : i + m] * _ODD[i]
    return mix(out)


class WordTable:
    """word -> row of an array, rows of unseen words made many at a time.

    `make(words)` returns one row per word. The table starts afresh when it
    would pass CACHE_WORDS, so a worker's memory is bounded whatever it reads.
    """

    def __init__(self, make):
        self.make, self.rows, self.values = make, {}, None

    def index(self, words: list) -> np.ndarray:
        new = set(words).difference(self.rows)
        if new:
            if self.rows and len(self.rows) + len(new) > CACHE_WORDS:
                self.rows, self.values, new = {}, None, set(words)
            new = list(new)
            made = self.make(new)
            n = len(self.rows)
            if self.values is None:
                self.values = made
            else:
                if n + len(new) > len(self.values):
                    grown = np.zeros((max(2 * len(self.values), n + len(new)), *made.shape[1:]), made.dtype)
                    grown[:n] = self.values[:n]
                    self.values = grown
                self.values[n : n + len(new)] = made
            self.rows.update(zip(new, range(n, n + len(new))))
        return np.fromiter(map(self.rows.__getitem__, words), np.int64, len(words))


def byte_grams(words: list[bytes], sizes: tuple[int, ...], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(word number, bucket) of every byte n-gram of `<word>`, words ascending."""
    wrapped = [b"<" + w + b">" for w in words]
    buf = np.frombuffer(b"".join(wrapped), np.uint8).astype(np.uint64) + np.uint64(1)
    lens = np.fromiter(map(len, wrapped), np.int64, len(wrapped))
    of = np.repeat(np.arange(len(words)), lens)
    who, what = [], []
    for n in sizes:
        m = len(buf) - n + 1
        if m <= 0:
            continue
        h = np.full(m, n, np.uint64)
        for j in range(n):
            h = h * np.uint64(1_000_003) + buf[j : j + m]
        same = of[:m] == of[n - 1 :]
        who.append(of[:m][same])
        what.append((mix(h[same]) % np.uint64(buckets)).astype(np.int64))
    if not who:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    who, what = np.concatenate(who), np.concatenate(what)
    order = np.argsort(who, kind="stable")
    return who[order], what[order]


def sum_by(who: np.ndarray, values: np.ndarray, n: int) -> np.ndarray:
    """Sum of `values` rows for each of 0..n-1; `who` ascends."""
    starts = np.searchsorted(who, np.arange(n))
    held = np.concatenate([np.zeros((1, values.shape[1]), np.float64), np.cumsum(values, axis=0, dtype=np.float64)])
    return held[np.append(starts[1:], len(who))] - held[starts]


def hash_sample(df: DataFrame, key: Column, rows: int, total: int, seed: int = 0) -> DataFrame:
    """About `rows` of `total` rows, chosen by a hash of the key, never more."""
    if total <= rows:
        return df
    spread = F.pmod(F.xxhash64(key, F.lit(seed)), F.lit(1 << 30))
    return df.filter(spread < int((1 << 30) * min(1.0, 1.1 * rows / total))).orderBy(spread).limit(rows)


_RNG = np.random.default_rng(20_240_229)
_BYTE = _RNG.integers(1 << 62, (1 << 63) - 1, 256, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _RNG.integers(1 << 62, (1 << 63) - 1, 4096, np.int64).astype(np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[0x41:0x5B] += 0x20
_ALNUM = np.array([c >= 0x80 or chr(c).isalnum() for c in range(256)])
#: Bytes of text whose words are hashed at a time.
SLICE_BYTES = 1 << 20


def _hash_words(data: np.ndarray, bounds: np.ndarray, lower: bool, plain: bool, cut: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hash of each word, words of each text, first byte and bytes of each word.

    A word's hash is a sum over its bytes, each weighed by its place, so a few
    passes over the bytes do for all words; words with more bytes than there are
    weights are hashed one by one. `lower` folds A-Z; `plain` also folds
    the Latin-1 letters and leaves punctuation out, dropping words without more.
    A word ends before each byte marked in `cut`, too.
    """
    n = len(bounds) - 1
    none = np.empty(0, np.uint64), np.zeros(n, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    if not len(data):
        return none
    space = _SPACE[data]
    used = ~space
    code = _FOLD[data] if lower or plain else data
    if plain:
        used &= _ALNUM[data]
        wide = np.flatnonzero(data[:-1] == 0xC3) + 1
        if len(wide):
            second = data[wide]
            code[wide[(second >= 0x80) & (second <= 0x9E) & (second != 0x97)]] |= 0x20
        quote = np.flatnonzero(data[:-2] == 0xE2)
        quote = quote[data[quote + 1] == 0x80]
        for j in range(3):
            used[quote + j] = False
    starts = np.empty(len(data), bool)
    starts[0] = True
    starts[1:] = space[:-1]
    if cut is not None:
        starts |= cut
    inner = bounds[1:-1]
    starts[inner[inner < len(data)]] = True
    word = np.cumsum(starts, dtype=np.int32)
    at = np.flatnonzero(used)
    if not len(at):
        return none
    word = word[at]
    first = np.flatnonzero(np.r_[True, word[1:] != word[:-1]])
    place = np.arange(len(at)) - np.repeat(first, np.diff(np.r_[first, len(at)]))
    size = np.diff(np.r_[first, len(at)])
    h = mix(np.add.reduceat(_BYTE[code[at]] * _PLACE[place & (len(_PLACE) - 1)], first))
    for k in np.flatnonzero(size > len(_PLACE)).tolist():  # past the weights, places would repeat
        h[k] = xxhash.xxh3_64_intdigest(code[at[first[k] : first[k] + size[k]]].tobytes())
    return h, np.bincount(np.searchsorted(bounds, at[first], "right") - 1, minlength=n), at[first], size


def word_spans(column, lower: bool = False, plain: bool = False, slice_bytes: int = SLICE_BYTES, eased=None):
    """Slices of a string column: (first row, word hashes, words of each text, bytes, starts, lengths).

    A slice has about `slice_bytes`; a longer text is read in parts cut at white
    space, so memory follows the text's words, not many copies of its bytes.
    `eased(bytes, bounds of texts)` may change bytes of a slice first, and mark those
    before which a word ends.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary())
    if not len(column):
        return
    _, offsets, data = column.buffers()
    ends = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    lo = 0
    while lo < len(column):
        hi = min(max(lo + 1, int(np.searchsorted(ends, ends[lo] + slice_bytes, "right")) - 1), len(column))
        a, z = int(ends[lo]), int(ends[hi])
        data, cut = eased(raw[a:z], ends[lo : hi + 1] - a) if eased else (raw[a:z], None)
        if hi == lo + 1 and z - a > 4 * SLICE_BYTES:
            parts, at = [], 0
            while at < len(data):
                end = min(at + SLICE_BYTES, len(data))
                while end < len(data) and not _SPACE[data[end]]:  # never inside a word
                    end += 1
                h, _, start, size = _hash_words(data[at:end], np.array([0, end - at]), lower, plain, None if cut is None else cut[at:end])
                parts.append((h, start + at, size))
                at = end
            h, start, size = (np.concatenate(x) for x in zip(*parts))
            yield lo, h, np.array([len(h)]), data, start, size
        else:
            h, n, start, size = _hash_words(data, ends[lo : hi + 1] - a, lower, plain, cut)
            yield lo, h, n, data, start, size
        lo = hi


def word_streams(column, lower: bool = False, plain: bool = False, slice_bytes: int = SLICE_BYTES):
    """Slices of a string column: (first row, [word hashes of each text])."""
    for lo, h, n, *_ in word_spans(column, lower, plain, slice_bytes):
        yield lo, np.split(h, np.cumsum(n)[:-1])


def _trim() -> None:
    """Gives freed memory back to the system: workers are used again by later stages."""
    word_hash.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        return


def tidy(run):
    """Wraps a batch function that holds much memory, which is free again after the task."""

    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            _trim()

    return tidied


def without_gc(run):
    """Wraps a batch function that makes millions of short-lived objects and no cycles."""

    def quiet(batches):
        gc.disable()
        try:
            yield from run(batches)
        finally:
            gc.enable()

    return quiet
