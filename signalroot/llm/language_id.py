"""Language identification: averaged hashed subword embeddings, linear softmax.

A text is the mean of the embeddings of all byte n-grams of its lower-cased
words; a linear softmax over that mean gives the language. Both are trained by
stochastic gradient descent in numpy on the driver, over a bounded sample of
labelled rows; a temperature and a rejection threshold are calibrated on a part
of the sample that training doesn't see. As the model is linear after the mean,
executors hold one table of n-gram logits, or of the embeddings themselves where
languages outnumber their dimensions, and add up.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

BUCKETS, DIM, SIZES = 1 << 16, 16, (2, 3, 4)
#: Labelled rows that training reads per language at most, chosen by a hash, and
#: bytes of text: of all languages together, of one row. A language has ten rows
#: at least, however many languages there are.
TRAIN_PER_LANG, TRAIN_BYTES, ROW_BYTES, LEAST_ROWS = 500, 64 << 20, 1 << 20, 10
EPOCHS, RATE, SEED = 6, 8.0, 7
#: Share of accepted calibration rows that must be right.
PRECISION = 0.99
UND = "und"
#: Letters, not the numerals and marks that `\w` also takes.
_LETTER = regex.compile(r"\p{L}")
_PLAIN = re.compile("[A-Za-z]")


def has_letter(text: str) -> bool:
    """Most texts have an ASCII letter near their start, which is quicker to find."""
    return bool(_PLAIN.search(text) or _LETTER.search(text))


@dataclass
class Model:
    """Up to DIM languages, an n-gram has their logits; beyond, its embedding, which `out` turns into them."""

    langs: list[str]
    grams: np.ndarray  # float32[BUCKETS, languages] or float32[BUCKETS, DIM]
    out: np.ndarray | None  # float32[DIM, languages]
    bias: np.ndarray
    temperature: float
    reject_below: float


def _words(text: str) -> list[bytes]:
    return text.lower().encode("utf-8", "surrogatepass").split()


def train(texts: list[str], labels: list[str]) -> Model | None:
    langs = sorted(set(labels))
    if not langs:
        return None
    rng = np.random.default_rng(SEED)
    docs = []
    for text in texts:
        words = _words(text)
        _, grams = common.byte_grams(words, SIZES, BUCKETS)
        ids, counts = np.unique(grams, return_counts=True)
        docs.append((ids, (counts / max(len(grams), 1)).astype(np.float32)))
    place = {x: k for k, x in enumerate(langs)}
    y = np.array([place[x] for x in labels])
    order = rng.permutation(len(docs))
    held, fit = order[: len(order) // 5], order[len(order) // 5 :]
    if len(fit) == 0:
        held, fit = order, order
    emb = rng.normal(0, 0.1, (BUCKETS, DIM)).astype(np.float32)
    out, bias = rng.normal(0, 0.1, (DIM, len(langs))).astype(np.float32), np.zeros(len(langs), np.float32)
    for epoch in range(EPOCHS):
        rate = np.float32(RATE * (1 - epoch / EPOCHS))
        for i in rng.permutation(fit):
            ids, w = docs[i]
            mean = w @ emb[ids]
            z = mean @ out + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y[i]] -= 1
            back = out @ p
            out -= rate * 0.05 * np.outer(mean, p)
            bias -= rate * 0.002 * p
            emb[ids] -= rate * np.minimum(w * 50, 1)[:, None] * 0.05 * back
    grams, last = ((emb @ out).astype(np.float32), None) if len(langs) <= DIM else (emb, out)
    logits = np.array([docs[i][1] @ emb[docs[i][0]] @ out + bias for i in held])
    temps = np.geomspace(0.05, 20, 60)
    smooth = 1 / (len(held) + 1)  # as if one row were mislabelled: a perfect split doesn't prove certainty
    goal = np.full(logits.shape, smooth / len(langs))
    goal[np.arange(len(held)), y[held]] += 1 - smooth
    losses = [-np.mean((goal * _log_softmax(logits / t)).sum(1)) for t in temps]
    t = float(temps[int(np.argmin(losses))])
    prob = np.exp(_log_softmax(logits / t))
    top, right = prob.max(1), prob.argmax(1) == y[held]
    rank = np.argsort(-top)
    good = np.cumsum(right[rank]) / np.arange(1, len(rank) + 1) >= PRECISION
    below = float(top[rank][np.flatnonzero(good)[-1]]) if good.any() else 1.0
    return Model(langs, grams, last, bias, t, min(below, 1.0))


def _log_softmax(z: np.ndarray) -> np.ndarray:
    z = z - z.max(axis=-1, keepdims=True)
    return z - np.log(np.exp(z).sum(axis=-1, keepdims=True))


def fit(docs: DataFrame, text_col: str, lang_col: str, learn_from, key, per_lang: int = TRAIN_PER_LANG) -> Model | None:
    """Trains on at most `per_lang` rows of each language among those that satisfy `learn_from`.

    Every language that has a row with a letter, of ROW_BYTES at most, is learned. With very many of
    them a language has fewer rows, so that the sample stays within TRAIN_BYTES or
    LEAST_ROWS of each; the order of a hash decides, on whole rows of up to ROW_BYTES.
    """
    pool = docs.filter(learn_from & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
        F.col(lang_col).cast("string").alias("lang"), F.col(text_col).cast("string").alias("text"), F.pmod(F.xxhash64(key), F.lit(1 << 30)).alias("spread")
    )
    pool = pool.withColumn("size", F.octet_length("text")).filter((F.col("size") <= ROW_BYTES) & F.rlike("text", F.lit(r"\p{L}")))
    counts = pool.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.sum("size").alias("bytes"))
    total = counts.agg(F.count(F.lit(1))).first()[0]
    if not total:
        return None
    # rows of each language: of a share of the bytes, by their mean size, in the order of the hash
    fair = F.ceil(F.lit(TRAIN_BYTES / total) * F.col("n") / F.greatest("bytes", F.lit(1)))
    wanted = counts.select("lang", F.least(F.lit(per_lang).cast("long"), F.greatest(fair, F.lit(LEAST_ROWS).cast("long"))).alias("wanted"), "n")
    cut = wanted.withColumn("below", ((1 << 30) * F.least(F.lit(1.0), (2 * F.col("wanted") + 20) / F.col("n"))).cast("long"))  # twice the rows that are due: fewer are never met in practice
    cut = common.Scratch(docs.sparkSession).table(cut, "cut")
    near = pool.join(common.sized(cut), "lang").filter(F.col("spread") < F.col("below"))  # few narrow rows go to the texts
    ranked = near.withColumn("nth", F.row_number().over(Window.partitionBy("lang").orderBy("spread", "text"))).filter(F.col("nth") <= F.col("wanted"))
    rows = sorted(ranked.select("spread", "lang", "text").collect(), key=lambda r: (r["spread"], r["lang"], r["text"]))
    return train([r["text"] for r in rows], [r["lang"] for r in rows])


class Predictor:
    def __init__(self, model: Model):
        self.model = model
        self.table = common.WordTable(self._rows)

    def _rows(self, words: list[bytes]) -> np.ndarray:
        who, what = common.byte_grams(words, SIZES, BUCKETS)
        values = np.concatenate([self.model.grams[what], np.ones((len(what), 1), np.float32)], axis=1)
        return common.sum_by(who, values, len(words)).astype(np.float32)

    def __call__(self, text: str | None) -> tuple[str, float]:
        if not text or not has_letter(text):
            return UND, 0.0
        words = _words(text)
        at = self.table.index(words)
        total = self.table.values[at].sum(axis=0, dtype=np.float64)
        mean = total[:-1] / max(total[-1], 1)
        z = ((mean if self.model.out is None else mean @ self.model.out) + self.model.bias) / self.model.temperature
        p = np.exp(_log_softmax(z))
        k = int(p.argmax())
        return self.model.langs[k], float(min(p[k], 1.0))


def _run(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        say = Predictor(model) if model else lambda text: (UND, 0.0)
        floor = model.reject_below if model else 1.0
        for b in batches:
            said = [say(x) for x in b.column(1).to_pylist()]
            score = np.array([s for _, s in said], np.float64)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(2), pa.array([x for x, _ in said], pa.string()), pa.array(score), pa.array((score >= floor) & (score > 0))],
                names=["id", "held_out", "lang_pred", "score", "accepted"],
            )

    return run


def language_id(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", per_lang: int = TRAIN_PER_LANG) -> DataFrame:
    """One row per input row: id, held_out, lang_pred, score, accepted.

    Rows whose crc32(id as text) mod 3 is 1 are held out of all learning.
    `score` is the calibrated probability of `lang_pred`; `accepted` is false
    where it is under the threshold that keeps calibration precision.

    - null text, empty text and text without a letter: `und`, score 0, not accepted.
    - a null id counts as the empty text, crc32 0, and isn't held out.
    - with nothing to learn from, every row is `und`; an empty table gives an empty result.
    - ties between languages go to the first by name; whole texts are read; repeated rows each give a row.
    """
    spark = docs.sparkSession
    key = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    held_out = F.crc32(key) % 3 == 1
    model = fit(docs, text_col, lang_col, ~held_out, key, per_lang)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"), held_out.alias("held_out"))
    schema = T.StructType([
        T.StructField("id", rows.schema["id"].dataType), T.StructField("held_out", T.BooleanType()), T.StructField("lang_pred", T.StringType()),
        T.StructField("score", T.DoubleType()), T.StructField("accepted", T.BooleanType()),
    ])
    return rows.mapInArrow(_run(spark.sparkContext.broadcast(model)), schema).withColumnRenamed("id", id_col)
