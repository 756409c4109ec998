"""Exact dedup with counting quotient filters and byte verification.

Each task builds a counting quotient filter (CQF) over the 64-bit fingerprints
of its texts. A filter is cut into blocks by the leading bits of the quotient;
blocks of all tasks meet in a shuffle and merge losslessly by their sorted
remainders, counts added. Only fingerprints with a count above one go on: their
texts are grouped by the text itself, so equality is decided on bytes.

A text that a third of all rows share is one CQF entry per task and, in the
byte grouping, one partial row per task. Whole texts leave the scan only for
candidates. Nothing but counts reaches the driver.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Fingerprints that a task holds before it emits a filter and starts afresh.
FILTER_ENTRIES = 2_000_000


class QuotientFilter:
    """Counting quotient filter as three arrays in quotient order.

    `runs[q]` is the number of remainders in the run of quotient q; remainders
    ascend inside a run; `counts` stands beside them. The fingerprint is
    quotient * 2**r_bits + remainder, so nothing is lost by merging.
    """

    def __init__(self, q_bits: int, r_bits: int, runs, remainders, counts):
        self.q_bits, self.r_bits = q_bits, r_bits
        self.runs, self.remainders, self.counts = runs, remainders, counts

    @classmethod
    def build(cls, fingerprints, counts, q_bits: int, r_bits: int) -> QuotientFilter:
        fps, where = np.unique(np.asarray(fingerprints, np.uint64), return_inverse=True)
        total = np.bincount(where, np.asarray(counts, np.float64), len(fps)).astype(np.uint64)
        runs = np.bincount((fps >> np.uint64(r_bits)).astype(np.int64), minlength=1 << q_bits)
        return cls(q_bits, r_bits, runs.astype(np.uint32), fps & np.uint64((1 << r_bits) - 1), total)

    def fingerprints(self) -> np.ndarray:
        q = np.repeat(np.arange(len(self.runs), dtype=np.uint64), self.runs)
        return (q << np.uint64(self.r_bits)) | self.remainders

    def merge(self, other: QuotientFilter) -> QuotientFilter:
        """Both have the same block of the same fingerprint space; the finer quotient is kept."""
        q = max(self.q_bits, other.q_bits)
        r = self.q_bits + self.r_bits - q
        return QuotientFilter.build(
            np.concatenate([self.fingerprints(), other.fingerprints()]),
            np.concatenate([self.counts, other.counts]), q, r,
        )

    def dumps(self) -> bytes:
        wide = (self.r_bits + 7) // 8
        low = self.remainders.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :wide]
        many = np.flatnonzero(self.counts > 1)
        head = np.array([self.q_bits, self.r_bits, len(self.remainders), len(many)], "<u4")
        return b"".join(x.tobytes() for x in (
            head, self.runs.astype("<u4"), np.ascontiguousarray(low),
            many.astype("<u4"), self.counts[many].astype("<u8"),
        ))

    @classmethod
    def loads(cls, data: bytes) -> QuotientFilter:
        q, r, n, k = (int(x) for x in np.frombuffer(data, "<u4", 4))
        at = 16
        runs = np.frombuffer(data, "<u4", 1 << q, at)
        at += 4 << q
        wide = (r + 7) // 8
        low = np.zeros((n, 8), np.uint8)
        low[:, :wide] = np.frombuffer(data, np.uint8, n * wide, at).reshape(n, wide)
        at += n * wide
        counts = np.ones(n, np.uint64)
        counts[np.frombuffer(data, "<u4", k, at)] = np.frombuffer(data, "<u8", k, at + 4 * k)
        return cls(q, r, runs, low.reshape(-1).view("<u8").copy(), counts)


def _digest(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            norm = pc.ascii_lower(pc.fill_null(b.column(1).cast(pa.string()), ""))
            raw = [hashlib.sha256(x).digest() for x in norm.cast(pa.binary()).to_pylist()]
            fp = np.array([int.from_bytes(x[:8], "big") >> (64 - bits) for x in raw], np.uint64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(fp.view(np.int64)), pa.array([x.hex() for x in raw], pa.string())],
                names=["id", "fp", "sha"],
            )

    return run


def _filters(bits: int, block_bits: int):
    """Fingerprints of a task -> (block, filter) rows."""

    def emit(parts):
        fps = np.concatenate(parts).view(np.uint64)
        low = bits - block_bits
        fps, counts = np.unique(fps, return_counts=True)
        blocks = fps >> np.uint64(low)
        cuts = np.flatnonzero(np.r_[True, blocks[1:] != blocks[:-1]]) if len(fps) else []
        ends = np.r_[cuts[1:], len(fps)] if len(fps) else []
        ids, data = [], []
        for a, z in zip(cuts, ends):
            q = min(low, max(1, int(np.log2(z - a))))
            inner = fps[a:z] & np.uint64((1 << low) - 1)
            ids.append(int(blocks[a]))
            data.append(QuotientFilter.build(inner, counts[a:z], q, low - q).dumps())
        return pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(data, pa.binary())], names=["block", "filter"])

    def run(batches):
        parts, n = [], 0
        for b in batches:
            parts.append(b.column(0).to_numpy(zero_copy_only=False))
            n += len(parts[-1])
            if n >= FILTER_ENTRIES:
                yield emit(parts)
                parts, n = [], 0
        if n:
            yield emit(parts)

    return run


def _repeated(bits: int, block_bits: int):
    """Merges the filters of each block; fingerprints counted more than once."""

    def run(batches):
        held: dict[int, QuotientFilter] = {}
        for b in batches:
            for block, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                one = QuotientFilter.loads(data)
                held[block] = held[block].merge(one) if block in held else one
        low = np.uint64(bits - block_bits)
        for block, f in held.items():
            again = (f.fingerprints()[f.counts > 1] | (np.uint64(block) << low)).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(again), pa.array(f.counts[f.counts > 1].astype(np.int64))], names=["fp", "n"])

    return run


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", fingerprint_bits: int = 64) -> DataFrame:
    """One row per input row: id, keep_id, group_size, kept, text_sha256.

    Texts are equal when identical after lower-casing A-Z. Of equal texts the
    largest id stays.

    - null text counts as the empty text; empty texts equal each other.
    - a null id is smaller than any other: it stays only in a group of null ids.
    - rows that repeat an id are that many members of their group, and all of
      them are `kept` if that id is the one that stays.
    - an empty table gives an empty result; other columns are not read.
    - `fingerprint_bits` below 64 makes collisions likelier, never a wrong group.
    """
    spark = docs.sparkSession
    scratch = common.Scratch(spark)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    id_field = T.StructField("id", rows.schema["id"].dataType)
    digest = scratch.table(
        rows.mapInArrow(_digest(fingerprint_bits), T.StructType([id_field, T.StructField("fp", T.LongType()), T.StructField("sha", T.StringType())])),
        "digest",
    )
    n = digest.count()
    parts = common.partitions(spark, n, 4e6)
    block_bits = min(fingerprint_bits - 2, max(4, int(np.ceil(np.log2(4 * parts)))))
    repeated = scratch.table(
        digest.select("fp")
        .mapInArrow(_filters(fingerprint_bits, block_bits), "block long, filter binary")
        .repartition(parts, "block")
        .mapInArrow(_repeated(fingerprint_bits, block_bits), "fp long, n long"),
        "repeated",
    )
    wanted = scratch.table(digest.join(common.sized(repeated), "fp", "left_semi").select(F.col("id").alias("cand")), "wanted")
    norm = common.ascii_lower(F.coalesce("text", F.lit("")))
    groups = (
        rows.join(common.sized(wanted.distinct()), F.col("id").eqNullSafe(F.col("cand")), "left_semi")
        .select("id", norm.alias("norm"))
        .groupBy("norm")
        .agg(F.max("id").alias("keep_id"), F.count(F.lit(1)).alias("group_size"))
        .select(F.sha2("norm", 256).alias("sha"), "keep_id", "group_size")
    )
    # byte groups with one SHA-256 between them can't be told apart below
    groups = groups.groupBy("sha").agg(
        F.when(F.count(F.lit(1)) == 1, F.max("keep_id")).otherwise(F.raise_error(F.lit("two texts with one SHA-256"))).alias("keep_id"),
        F.max("group_size").alias("group_size"),
    )
    verified = scratch.table(groups.filter("group_size > 1"), "verified")
    scratch.drop("wanted", "repeated")
    found = digest.join(common.sized(verified), "sha", "left")
    keep = F.when(F.col("group_size").isNull(), F.col("id")).otherwise(F.col("keep_id"))
    return found.select(
        F.col("id").alias(id_col),
        keep.alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        F.col("id").eqNullSafe(keep).alias("kept"),
        F.col("sha").alias("text_sha256"),
    )
