"""Whether records that share a fingerprint are copies: a sample of groups, opened and compared sample for sample."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import duplicates
from ..sources import headers, signals
from .reports import hash_sample

COMPARED = (
    "record_a string, record_b string, same_shape boolean, shape_a array<long>, shape_b array<long>, identical_samples boolean, "
    "max_absolute_difference double, lead_one_correlation double, comments_a array<string>, comments_b array<string>, same_comments boolean"
)


def repeated(digests: DataFrame) -> DataFrame:
    """Digest groups (digest, members) of more than one record."""
    return duplicates.groups(digests).filter(F.size("members") > 1)


def chosen(groups: DataFrame, n: int = 20, seed: int = 0) -> DataFrame:
    """The first two members (record_a, record_b) of n groups drawn by seed."""
    drawn = hash_sample(groups, "digest", n, seed)
    return drawn.select(F.col("members")[0].alias("record_a"), F.col("members")[1].alias("record_b"))


def _agreement(x: np.ndarray, y: np.ndarray) -> float | None:
    """Pearson's r where both are finite; None for fewer than two such samples or a constant side."""
    good = np.isfinite(x) & np.isfinite(y)
    x, y = x[good], y[good]
    if len(x) < 2 or x.min() == x.max() or y.min() == y.max():
        return None
    return round(float(np.corrcoef(x, y)[0, 1]), 9)


def compare(a: np.ndarray, b: np.ndarray) -> dict:
    """How two records differ, lead by lead; both are float64[samples, leads].

    A lead's largest difference is taken over the shorter length, where both
    sides are finite. Records with unlike numbers of leads have no difference.
    """
    gaps: list[float] = []
    if a.shape[1] == b.shape[1]:
        for x, y in zip(a.T, b.T):
            apart = np.abs(x[: len(y)] - y[: len(x)])
            apart = apart[np.isfinite(apart)]
            gaps += [float(apart.max())] if len(apart) else []
    same = a.shape == b.shape
    r = _agreement(a[: len(b), 0], b[: len(a), 0])
    return {
        "same_shape": same, "shape_a": list(a.shape), "shape_b": list(b.shape), "identical_samples": same and not any(gaps),
        "max_absolute_difference": max(gaps, default=None), "lead_one_correlation": r,
    }


def _compare(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for pdf in batches:
        rows = []
        for r in pdf.itertuples():
            said = {"record_a": r.record_a, "record_b": r.record_b, "comments_a": list(r.comments_a), "comments_b": list(r.comments_b)}
            same = {"same_comments": said["comments_a"] == said["comments_b"]}
            rows.append(said | same | compare(signals.matrix(r.n_leads_a, r.samples_a), signals.matrix(r.n_leads_b, r.samples_b)))
        yield pd.DataFrame(rows, columns=[c.split()[0] for c in COMPARED.split(", ")])


def compared(pairs: DataFrame) -> DataFrame:
    """COMPARED of rows with both sides' record, n_leads, samples (bytes of float64[n, leads]) and comments, marked _a and _b."""
    return pairs.mapInPandas(_compare, COMPARED)


def opened(spark: SparkSession, pairs: DataFrame, directory: str, source_id: str) -> DataFrame:
    """The comparison of each pair (record_a, record_b) of a distribution whose records can be read, by pair."""
    texts = headers.read_texts(spark, directory, source_id)
    parsed = headers.parse(texts).join(texts.select("header_path", headers.comments_of("text").alias("comments")), "header_path")
    ends = pairs.select(F.col("record_a").alias("record_id")).unionByName(pairs.select(F.col("record_b").alias("record_id"))).distinct()
    wanted = parsed.join(ends, "record_id", "left_semi")
    read = signals.whole(spark, wanted, directory).filter("error IS NULL").join(wanted.select("record_id", "comments"), "record_id")
    side = lambda k: read.select(F.col("record_id").alias(f"record_{k}"), *(F.col(c).alias(f"{c}_{k}") for c in ("n_leads", "samples", "comments")))
    return compared(pairs.join(side("a"), "record_a").join(side("b"), "record_b")).orderBy("record_a", "record_b")


def summary(compared: DataFrame) -> DataFrame:
    return compared.agg(
        F.count(F.lit(1)).alias("n_checked"), F.count_if("identical_samples").alias("n_identical_samples"), F.count_if("same_comments").alias("n_same_comments"),
        F.min("lead_one_correlation").alias("lowest_correlation"),
    )
