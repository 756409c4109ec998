"""Quality classifier by co-training of a text view and a metadata view.

Two logistic regressions see disjoint views of a document: what its text is made
of (shapes of words, repetition, hashed n-grams) and what its row says about it
(source, language, declared length). Both start from labelled rows. In each
round, either view hands the rows of an unlabelled pool of which it is most
confident to the other as pseudo-labels. Each view is then calibrated on labelled
rows that neither trained on, and the calibrated log-odds add up, less the prior.

Training works on bounded samples chosen by a hash (parameters below) on the
driver; executors compute the features of the samples and score all documents
in one Arrow pass, without a shuffle.
"""

from __future__ import annotations

import unicodedata
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Bounds of the training samples, in rows.
MAX_LABELLED, MAX_POOL = 5000, 5000
ROUNDS, CONFIDENT, PER_ROUND = 3, 0.95, 500
GRAM_BUCKETS, GRAM_SIZES = 512, (3,)
SHAPES = 10
TEXT_DIM = SHAPES + 5 + GRAM_BUCKETS
META_DIM = 64 + 32 + 12
#: Single n-grams weigh little beside the shapes while labels are few.
TEXT_SCALE = np.r_[np.ones(SHAPES + 5), np.full(GRAM_BUCKETS, 0.1)]


def _shape(word: bytes) -> list[float]:
    w = word.decode("utf-8", "replace")
    letters = sum(c.isalpha() for c in w)
    marks = sum(not c.isalnum() and not unicodedata.combining(c) for c in w)
    return [
        float(letters > 1 and w.upper() == w), float(letters > 1 and w[0].isupper() and w[1:].lower() == w[1:]), float(letters == 0),
        float(w == "|"), float(marks >= 2), marks / len(w), float(any(c.isdigit() for c in w)), min(len(w), 30) / 10, float(len(w) > 20), 1.0,
    ]


def _word_rows(words: list[bytes]) -> np.ndarray:
    who, what = common.byte_grams([w.lower() for w in words], GRAM_SIZES, GRAM_BUCKETS)
    flat = np.bincount(who * GRAM_BUCKETS + what, minlength=len(words) * GRAM_BUCKETS)
    return np.concatenate([np.array([_shape(w) for w in words], np.float32), flat.reshape(len(words), GRAM_BUCKETS).astype(np.float32)], axis=1)


def _whole(at: np.ndarray) -> list[float]:
    """Features of the sequence: repetition, variety and length."""
    n = len(at)
    if n == 0:
        return [0.0, 0.0, 0.0, 1.0, 0.0]  # only without words is the fourth 1
    distinct = len(np.unique(at))
    return [float(np.mean(at[1:] == at[:-1])) if n > 1 else 0.0, distinct / n, float(distinct < 0.5 * n), 0.0, np.log1p(n) / 10]


class TextFeatures:
    """Dense feature vectors of sampled documents."""

    def __call__(self, text: bytes | None) -> np.ndarray:
        words = text.split() if text else []
        if not words:
            return np.array([0.0] * SHAPES + _whole(np.empty(0)) + [0.0] * GRAM_BUCKETS, np.float32)
        distinct, counts = np.unique(common.hashes(words), return_counts=True)
        first = dict(zip(map(common.word_hash.__getitem__, words), words))
        total = counts @ _word_rows([first[int(h)] for h in distinct])
        at = common.hashes(words)
        grams = total[SHAPES:] / max(total[SHAPES:].sum(), 1)
        return np.concatenate([total[:SHAPES] / len(words), _whole(at), 10 * grams]).astype(np.float32)


class TextScore:
    """The same features times the model's weights, with one row of sums per word."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias
        self.grams = weights[SHAPES + 5 :]
        self.table = common.WordTable(self._rows)

    def _rows(self, words: list[bytes]) -> np.ndarray:
        who, what = common.byte_grams([w.lower() for w in words], GRAM_SIZES, GRAM_BUCKETS)
        grams = common.sum_by(who, np.stack([self.grams[what], np.ones(len(what))], axis=1), len(words))
        shape = np.array([_shape(w) for w in words], np.float64) @ self.weights[:SHAPES]
        return np.concatenate([shape[:, None], grams], axis=1)

    def __call__(self, text: bytes | None) -> float:
        words = text.split() if text else []
        if not words:
            return float(np.dot(_whole(np.empty(0)), self.weights[SHAPES : SHAPES + 5]) + self.bias)
        at = self.table.index(words)
        shape, grams, n = self.table.values[at].sum(axis=0)
        return float(shape / len(words) + 10 * grams / max(n, 1) + np.dot(_whole(at), self.weights[SHAPES : SHAPES + 5]) + self.bias)


def meta_features(source: str | None, lang: str | None, n_chars: int | None) -> np.ndarray:
    x = np.zeros(META_DIM, np.float32)
    x[xxhash.xxh3_64_intdigest(f"s{source}") % 64] = 1
    x[64 + xxhash.xxh3_64_intdigest(f"l{lang}") % 32] = 1
    size = -1 if n_chars is None or n_chars < 0 else int(np.log2(n_chars + 1) / 2)
    x[96 + min(size + 1, 11)] = 1
    return x


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-3, steps: int = 150, scale: np.ndarray | float = 1.0) -> tuple[np.ndarray, float]:
    """Full-batch accelerated gradient descent on standardised columns; numpy only.

    A smaller `scale` makes the ridge weigh more on a column.
    """
    mean, dev = x.mean(0), (x.std(0) + 1e-3) / scale
    z = np.concatenate([(x - mean) / dev, np.ones((len(x), 1))], axis=1).astype(np.float32)
    y = y.astype(np.float32)
    w = v = np.zeros(z.shape[1], np.float32)
    u = np.ones(z.shape[1], np.float32)
    for _ in range(20):  # largest eigenvalue of the Hessian's bound, for the step
        u = z.T @ (z @ (u / np.linalg.norm(u))) / len(z)
    rate = 3.6 / max(float(np.linalg.norm(u)), 1e-9)
    for k in range(steps):
        p = 1 / (1 + np.exp(-np.clip(z @ v, -40, 40)))
        new = v - np.float32(rate) * (z.T @ (p - y) / len(y) + np.float32(ridge) * v)
        v = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    w = w.astype(np.float64)
    return (w[:-1] / dev), float(w[-1] - (w[:-1] / dev) @ mean)


def platt(margin: np.ndarray, y: np.ndarray) -> tuple[float, float]:
    """Slope and offset that turn margins into log-odds, with smoothed targets."""
    if len(y) == 0 or margin.std() == 0:
        return 0.0, _logit((y.sum() + 1) / (len(y) + 2))
    goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / ((1 - y).sum() + 2))
    scale = margin.std()
    w, b = logistic(margin[:, None] / scale, goal, ridge=1e-3, steps=600)
    return max(float(w[0]) / scale, 0.0), float(b)


def _logit(p: float) -> float:
    return float(np.log(p / (1 - p)))


@dataclass
class Model:
    text: tuple[np.ndarray, float]
    meta: tuple[np.ndarray, float]
    text_platt: tuple[float, float]
    meta_platt: tuple[float, float]
    prior: float


def co_train(text: np.ndarray, meta: np.ndarray, y: np.ndarray, pool_text: np.ndarray, pool_meta: np.ndarray, rounds: int = ROUNDS) -> Model | None:
    """Fits both views; None unless the labels have both classes."""
    if len(set(y.tolist())) < 2:
        return None
    rng = np.random.default_rng(11)
    order = rng.permutation(len(y))
    held, own = order[: len(y) // 4], order[len(y) // 4 :]
    if len(set(y[own].tolist())) < 2 or len(held) < 8:
        held = own = order
    views, scales = [(text, pool_text), (meta, pool_meta)], [TEXT_SCALE, 1.0]
    lent: list[dict[int, float]] = [{}, {}]  # pseudo-labels that each view has been given
    for turn in range(rounds + 1):
        fits = []
        for (x, pool), given, scale in zip(views, lent, scales):
            rows = np.array(sorted(given), np.int64)
            labels = np.array([given[int(i)] for i in rows])
            fits.append(logistic(np.concatenate([x[own], pool[rows]]), np.concatenate([y[own], labels]), scale=scale))
        if turn == rounds:
            break
        for mine, (w, b) in enumerate(fits):
            x, pool = views[mine]
            slope, offset = platt(x[held] @ w + b, y[held])
            p = 1 / (1 + np.exp(-(slope * (pool @ w + b) + offset)))
            other = lent[1 - mine]
            for label, sure in ((1.0, p), (0.0, 1 - p)):
                ranked = [int(i) for i in np.argsort(-sure, kind="stable") if sure[i] >= CONFIDENT and int(i) not in other]
                share = (y[own] == label).mean()
                other.update((i, label) for i in ranked[: int(PER_ROUND * share)])
    platts = [platt(x[held] @ w + b, y[held]) for (x, _), (w, b) in zip(views, fits)]
    return Model(*fits, *platts, _logit((y.sum() + 1) / (len(y) + 2)))


def _views(docs: DataFrame, text_col: str) -> list[Column]:
    """Text, source, language and declared length, as training and scoring read them.

    Columns are found as Spark finds them, whatever their case; what isn't there,
    or isn't a number where one is due, is null.
    """
    names = {c.lower(): c for c in docs.columns}
    own = lambda c, kind: (docs[names[c]] if c in names else F.lit(None)).try_cast(kind)
    return [docs[text_col].cast("string").cast("binary"), own("source", "string"), own("lang", "string"), own("n_chars", "long")]


def _rows(docs: DataFrame, id_col: str, text_col: str, *more) -> DataFrame:
    views = [c.alias(name) for c, name in zip(_views(docs, text_col), ("text", "source", "lang", "n_chars"))]
    return docs.select(docs[id_col].alias("id"), *views, *more)


def _featurise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    make = TextFeatures()
    for b in batches:
        text = [make(x).tobytes() for x in b.column(1).to_pylist()]
        meta = [meta_features(*r).tobytes() for r in zip(*(b.column(i).to_pylist() for i in (2, 3, 4)))]
        yield pa.RecordBatch.from_arrays([pa.array(text, pa.binary()), pa.array(meta, pa.binary()), b.column(5)], names=["text", "meta", "y"])


def _collect(rows: DataFrame) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    got = rows.mapInArrow(common.tidy(_featurise), "text binary, meta binary, y double").collect()
    got.sort(key=lambda r: (r["text"], r["meta"], r["y"] or 0))  # training doesn't depend on the order of rows
    stack = lambda c, d: np.array([np.frombuffer(r[c], np.float32) for r in got], np.float32).reshape(-1, d)
    return stack("text", TEXT_DIM), stack("meta", META_DIM), np.array([r["y"] or 0.0 for r in got])


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", max_labelled: int = MAX_LABELLED, max_pool: int = MAX_POOL) -> Model | None:
    truth = (
        labels.filter(F.col(id_col).isNotNull() & F.col(label_col).isNotNull())
        .groupBy(F.col(id_col).alias("label_id"))
        .agg((F.avg(F.col(label_col).cast("double")) >= 0.5).cast("double").alias("y"))
    )
    sample = common.hash_sample(truth, F.col("label_id"), max_labelled, truth.count(), seed=1)
    rows = _rows(docs, id_col, text_col).join(F.broadcast(sample), F.col("id") == F.col("label_id")).drop("label_id")
    text, meta, y = _collect(rows)
    if len(y) == 0:
        return None
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    pool = common.hash_sample(docs, key, max_pool, docs.count(), seed=2)
    pool_text, pool_meta, _ = _collect(_rows(pool, id_col, text_col, F.lit(None).cast("double").alias("y")))
    return co_train(text, meta, y, pool_text, pool_meta)


class Scorer:
    def __init__(self, model: Model | None):
        self.model = model
        self.text = TextScore(*model.text) if model else None
        self.meta: dict[tuple, float] = {}

    def __call__(self, text, source, lang, n_chars) -> tuple[float, float, float]:
        """Calibrated probabilities of the text view, the metadata view, both."""
        m = self.model
        if m is None:
            return 1.0, 1.0, 1.0
        t = m.text_platt[0] * self.text(text) + m.text_platt[1]
        x = meta_features(source, lang, n_chars)
        u = m.meta_platt[0] * (float(x @ m.meta[0]) + m.meta[1]) + m.meta_platt[1]
        p = 1 / (1 + np.exp(-np.clip(np.array([t, u, t + u - m.prior]), -500, 500)))
        return float(p[0]), float(p[1]), float(p[2])


def _score(shared, threshold: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            p = np.array([scorer(*r) for r in zip(*(b.column(i).to_pylist() for i in range(1, 5)))]).reshape(-1, 3)
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array(p[:, k]) for k in range(3)), pa.array(p[:, 2] >= threshold)], names=["id", "text_score", "meta_score", "score", "kept"])

    return run


def quality_scores(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.5) -> DataFrame:
    """One row per input row: id, text_score, meta_score, score, kept.

    `score` is the calibrated probability of good quality; `kept` is score >= `threshold`.

    - null and empty texts have features of their own and get a score; null metadata is one more value.
    - labels that disagree on a document count by their mean, one half as good; labels without a document, and null ones, don't count.
    - without labels of both classes everything is kept with score 1.
    - repeated rows each give a row; an empty table gives an empty result; whole texts are read.
    - columns source, lang and n_chars are used if there, others are not read.
    """
    spark: SparkSession = docs.sparkSession
    shared = spark.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col))
    rows = _rows(docs, id_col, text_col)
    fields = [T.StructField("id", rows.schema["id"].dataType)] + [T.StructField(c, T.DoubleType()) for c in ("text_score", "meta_score", "score")]
    return rows.mapInArrow(common.tidy(_score(shared, threshold)), T.StructType([*fields, T.StructField("kept", T.BooleanType())])).withColumnRenamed("id", id_col)


def quality_filter(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", threshold: float = 0.5) -> DataFrame:
    """The rows of `docs` that `quality_scores` keeps, with all their columns.

    Nulls, empty and long texts, repeated rows, labels and empty tables as there:
    such rows are scored and kept or not like any other. Columns of any name and
    type pass through, those named like the columns of a view too.
    """
    shared = docs.sparkSession.sparkContext.broadcast(fit(docs, labels, id_col, text_col, label_col))
    n = len(docs.columns)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(shared.value)
        for b in batches:
            kept = [scorer(*r)[2] >= threshold for r in zip(*(b.column(i).to_pylist() for i in range(n, n + 4)))]
            yield pa.RecordBatch.from_arrays(b.columns[:n], schema=pa.schema([b.schema.field(i) for i in range(n)])).filter(pa.array(kept, pa.bool_()))

    mark = "view"
    while any(c.lower().startswith(mark) for c in docs.columns):
        mark += "_"
    views = [c.alias(f"{mark}{k}") for k, c in enumerate(_views(docs, text_col))]
    return docs.select(*(docs[c] for c in docs.columns), *views).mapInArrow(common.tidy(run), docs.schema)
