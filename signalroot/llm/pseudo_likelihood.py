"""Language-model scoring by masked pseudo-likelihood.

A small bidirectional network predicts every token of a text from the two tokens
on either side, with the token itself masked; the summed log-probabilities score
the text. Frequent words are outputs of their own, the others share outputs by
hash and are told apart inside one by their corpus frequencies, so the
probabilities are those of words.

Word counts are gathered over all documents in a shuffle that grows with the
input, and kept as a written table. The network is trained by rounds of parallel SGD in numpy: every task
trains on the round's share of the positions of all its documents, and the
weights are averaged, weighted by positions; over the rounds every position of
the corpus is a target once. Scoring is one pass by the network; the words outside the
vocabulary, merged over a chunk of documents, then meet the counts by hash, and
the sums return to their chunk.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

#: Words with an input vector of their own; of these, words that are outputs of their own.
VOCABULARY, OWN = 4096, 96
#: Outputs and inputs that the other words share by hash.
SHARED_OUT, SHARED_IN = 32, 256
SIDE, DIM, SEED = 2, 24, 3
#: Rounds of averaging; each trains on its share of the positions, all rounds on every position once.
ROUNDS, BATCH, RATE = 2, 256, 0.3
#: Slices in which weights are summed over tasks.
SLICES = 16
#: Words for a task that trains.
TASK_WORDS = 2_000_000
#: Distinct words that a task counts before it emits them.
CHUNK_WORDS = 500_000
BUCKET_BITS = 12
#: A chunk of scored documents is closed at so many of them, or so many words outside the vocabulary.
CHUNK_DOCS, CHUNK_RARE = 50_000, 500_000
OFFSETS = [o for o in range(-SIDE, SIDE + 1) if o]


def shared_out(h: np.ndarray) -> np.ndarray:
    return (h % np.uint64(SHARED_OUT)).astype(np.int64)


def _merge(h: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(h, kind="stable")
    h, n = h[order], n[order]
    first = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.empty(0, np.int64)
    return h[first], np.add.reduceat(n, first) if len(first) else n


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(text) -> counts of words, by bucket of their hash."""

    def emit(held) -> pa.RecordBatch:
        h, n = _merge(*(np.concatenate(x) for x in zip(*held)))
        cut = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
        a = np.flatnonzero(np.r_[True, cut[1:] != cut[:-1]])
        z = np.r_[a[1:], len(h)]
        data = [h[x:y].astype("<u8").tobytes() + n[x:y].astype("<i8").tobytes() for x, y in zip(a, z)]
        return pa.RecordBatch.from_arrays([pa.array(cut[a]), pa.array(data, pa.binary())], names=["bucket", "data"])

    held, size = [], 0
    for b in batches:
        for _, h, *_ in common.word_spans(b.column(0), lower=True):
            if len(h):
                held.append(np.unique(h, return_counts=True))
                size += len(held[-1][0])
            if size >= CHUNK_WORDS:
                merged = _merge(*(np.concatenate(x) for x in zip(*held)))
                held, size = [merged], len(merged[0])
                if size >= CHUNK_WORDS // 2:
                    yield emit(held)
                    held, size = [], 0
    if held:
        yield emit(held)


def _totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of words over all tasks -> most frequent words, sums by shared output, all words by bucket."""
    parts = []
    for b in batches:
        for data in b.column(1).to_pylist():
            parts.append(np.frombuffer(data, "<i8").reshape(2, -1))
    if not parts:
        return
    both = np.concatenate(parts, axis=1)
    h, n = _merge(both[0].view(np.uint64), both[1])
    top = np.lexsort((h, -n))[:VOCABULARY]
    out = shared_out(h)
    total, distinct = np.bincount(out, n, SHARED_OUT), np.bincount(out, minlength=SHARED_OUT)
    cut = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
    a = np.flatnonzero(np.r_[True, cut[1:] != cut[:-1]])
    for x, y in zip(a, np.r_[a[1:], len(h)]):
        data = h[x:y].astype("<u8").tobytes() + n[x:y].astype("<i8").tobytes()
        yield pa.RecordBatch.from_arrays(
            [pa.array([2], pa.int32()), pa.array([cut[x]], pa.int64()), pa.array([int(n[x:y].sum())], pa.int64()), pa.array([y - x], pa.int64()), pa.array([data], pa.binary())],
            names=["kind", "key", "n", "distinct", "data"],
        )
    yield pa.RecordBatch.from_arrays(
        [
            pa.array(np.r_[np.zeros(len(top), np.int32), np.ones(SHARED_OUT, np.int32)]),
            pa.array(np.r_[h[top].view(np.int64), np.arange(SHARED_OUT)]),
            pa.array(np.r_[n[top], total.astype(np.int64)]),
            pa.array(np.r_[np.zeros(len(top), np.int64), distinct]),
            pa.nulls(len(top) + SHARED_OUT, pa.binary()),
        ],
        names=["kind", "key", "n", "distinct", "data"],
    )


@dataclass
class Vocabulary:
    """`keys`: hashes of the frequent words, ascending; beside them input, output and log P(word | output)."""

    keys: np.ndarray
    own: np.ndarray
    output: np.ndarray
    inside: np.ndarray
    rest: np.ndarray  # mean of P(word | shared output) over the other words, as a logarithm
    whole: np.ndarray  # log of the words that share an output, and one more

    @classmethod
    def build(cls, h: np.ndarray, n: np.ndarray, total: np.ndarray, distinct: np.ndarray) -> Vocabulary:
        """`h` by descending count `n`; sums over all words by shared output."""
        k = min(OWN, len(h))
        out = shared_out(h)
        total, distinct = total.astype(float), distinct.astype(float)
        np.subtract.at(total, out[:k], n[:k])
        np.subtract.at(distinct, out[:k], 1)
        left, kinds = total.copy(), distinct.copy()
        np.subtract.at(left, out[k:], n[k:])
        np.subtract.at(kinds, out[k:], 1)
        # one more unseen word of count one in each output keeps every probability positive
        rest = np.log((left + 1) / (kinds + 1)) - np.log(total + 1)
        inside = np.r_[np.zeros(k), np.log(n[k:]) - np.log(total[out[k:]] + 1)]
        output = np.r_[np.arange(k), OWN + out[k:]]
        order = np.argsort(h)
        return cls(h[order], np.arange(len(h))[order], output[order], inside[order], rest, np.log(total + 1))

    def rare(self, h: np.ndarray) -> np.ndarray:
        """Which words are outside the vocabulary."""
        if not len(self.keys):
            return np.ones(len(h), bool)
        return self.keys[np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)] != h

    def __call__(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Input number, output number and log P(word | output) of words."""
        x = VOCABULARY + (h % np.uint64(SHARED_IN)).astype(np.int64)
        shared = shared_out(h)
        y, inside = OWN + shared, self.rest[shared]
        if len(self.keys):
            at = np.minimum(np.searchsorted(self.keys, h), len(self.keys) - 1)
            hit = np.flatnonzero(self.keys[at] == h)
            at = at[hit]
            x[hit], y[hit], inside[hit] = self.own[at], self.output[at], self.inside[at]
        return x, y, inside


#: Input number of what is before and after a text.
EDGE = VOCABULARY + SHARED_IN
OUTPUTS = OWN + SHARED_OUT
#: Where the vectors of each neighbour begin, in rows of all of them.
ROWS = np.arange(len(OFFSETS)) * (EDGE + 1)


class Network:
    """h = tanh(sum of one vector per neighbour), then a softmax over the outputs."""

    def __init__(self, weights: np.ndarray | None = None):
        a, b = len(OFFSETS) * DIM * (EDGE + 1), DIM * OUTPUTS
        if weights is None:
            rng = np.random.default_rng(SEED)
            weights = np.concatenate([rng.normal(0, 0.1, a), rng.normal(0, 0.1, b), np.zeros(OUTPUTS)]).astype(np.float32)
        self.weights = weights
        self.emb = weights[:a].reshape(len(OFFSETS), EDGE + 1, DIM)
        self.out = weights[a : a + b].reshape(DIM, OUTPUTS)
        self.bias = weights[a + b :]

    def train(self, context: np.ndarray, y: np.ndarray, rate: float) -> None:
        """One step of SGD on a batch; context: int[batch, neighbours]."""
        keys = (context + ROWS).T.ravel()
        vectors = self.emb.reshape(-1, DIM).take(keys, axis=0).reshape(len(OFFSETS), len(y), DIM)
        h = np.tanh(vectors.sum(axis=0))
        z = h @ self.out
        z += self.bias
        np.exp(z, out=z)  # as in log_prob, it can't overflow
        z *= 1 / z.sum(axis=1, keepdims=True)
        z[np.arange(len(y)), y] -= 1
        back = z @ self.out.T
        back *= 1 - h * h
        back *= np.float32(-rate / 16)
        step = np.float32(rate / len(y))
        self.out -= step * (h.T @ z)
        self.bias -= step * z.sum(axis=0)
        # one add over single numbers: numpy has a fast path for it, not for rows
        cells = (keys * DIM)[:, None] + np.arange(DIM)
        np.add.at(self.emb.reshape(-1), cells.ravel(), np.tile(back.ravel(), len(OFFSETS)))

    def log_prob(self, context: np.ndarray, y: np.ndarray) -> np.ndarray:
        """log P(output y | neighbours) of many positions."""
        total = np.empty(len(y))
        for lo in range(0, len(y), 4096):
            c, t = context[lo : lo + 4096], y[lo : lo + 4096]
            h = self.emb[0].take(c[:, 0], axis=0)
            for o in range(1, len(OFFSETS)):
                h += self.emb[o].take(c[:, o], axis=0)
            z = np.tanh(h, out=h) @ self.out
            z += self.bias
            mine = z[np.arange(len(t)), t]
            # |h| <= 1, so the largest logit is bounded by the weights and exp can't overflow
            total[lo : lo + 4096] = mine - np.log(np.exp(z, out=z).sum(axis=1))
        return total


def _contexts(x: np.ndarray, words: np.ndarray) -> np.ndarray:
    """Input numbers of the neighbours of every word of texts that lie one after another."""
    padded = np.full(len(x) + SIDE * (len(words) + 1), EDGE, np.int64)
    at = np.arange(len(x)) + SIDE * (1 + np.repeat(np.arange(len(words)), words))
    padded[at] = x
    return np.stack([padded[at + o] for o in OFFSETS], axis=1)


def targets(h: np.ndarray, words: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """Positions that round `turn` trains on, by text and place in it: each position is in one round."""
    ends = np.cumsum(words)
    place = (np.arange(len(h)) - np.repeat(ends - words, words)).astype(np.uint64)
    held = np.append(np.uint64(0), np.cumsum(common.mix(h + place)))
    key = common.mix(np.repeat(held[ends] - held[ends - words], words) + place)
    return np.flatnonzero(key % np.uint64(rounds) == turn)


def _fit(shared, turn: int, rounds: int, groups: int = 1):
    """Trains from the shared weights on a round's positions; (slice, group of tasks, positions and weights * positions)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, start = shared.value
        net = Network(start.copy())
        seen = 0
        for b in batches:
            for _, h, words, *_ in common.word_spans(b.column(0), lower=True):
                if not len(h):
                    continue
                x, y, _ = vocabulary(h)
                pick = targets(h, words, turn, rounds)
                context = _contexts(x, words)[pick]
                order = np.argsort(common.mix(pick.astype(np.uint64)))
                for lo in range(0, len(order), BATCH):
                    part = order[lo : lo + BATCH]
                    net.train(context[part], y[pick[part]], RATE / (1 + turn))
                seen += len(pick)
        if seen:
            parts = np.array_split(net.weights * np.float32(seen), SLICES)
            data = [np.r_[np.float32(seen), x].astype("<f4").tobytes() for x in parts]
            task = TaskContext.get()
            mine = [task.partitionId() % groups if task else 0] * SLICES
            yield pa.RecordBatch.from_arrays([pa.array(range(SLICES), pa.int32()), pa.array(mine, pa.int32()), pa.array(data, pa.binary())], names=["slice", "part", "data"])

    return run


def _add_up(kind: str):
    """Sums of each slice of the weights over the rows of a task, whose numbers are of `kind`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for b in batches:
            for k, data in zip(b.column(0).to_pylist(), b.column(b.num_columns - 1)):
                x = np.frombuffer(data.as_buffer(), kind).astype(np.float64)
                held[k] = held[k] + x if k in held else x
        if held:
            yield pa.RecordBatch.from_arrays([pa.array(list(held), pa.int32()), pa.array([x.astype("<f8").tobytes() for x in held.values()], pa.binary())], names=["slice", "data"])

    return run


def _tasks(rows: DataFrame, words: int) -> int:
    """Tasks that train: a task's weights take the same room however little it reads, so small partitions are read several to a task."""
    return min(max(rows.rdd.getNumPartitions(), 1), max(2 * rows.sparkSession.sparkContext.defaultParallelism, words // TASK_WORDS + 1))


def fit(docs: DataFrame, text_col: str = "text", rounds: int = ROUNDS) -> tuple[Vocabulary, np.ndarray]:
    """Vocabulary and weights, from all documents."""
    scratch = common.Scratch(docs.sparkSession)
    vocabulary, weights, _ = _learn(docs, text_col, rounds, scratch)
    scratch.drop("counts")
    return vocabulary, weights


def _learn(docs: DataFrame, text_col: str, rounds: int, scratch: common.Scratch) -> tuple[Vocabulary, np.ndarray, DataFrame]:
    """Vocabulary, weights, and the table of all words' counts."""
    spark = docs.sparkSession
    rows = docs.select(F.col(text_col).cast("string").cast("binary").alias("text"))
    parts = min(1 << BUCKET_BITS, int(spark.conf.get("spark.sql.shuffle.partitions")))
    counts = scratch.table(
        rows.mapInArrow(_count, "bucket long, data binary").repartition(parts, "bucket").mapInArrow(_totals, "kind int, key long, n long, distinct long, data binary"), "counts"
    )
    top = counts.filter("kind = 0").orderBy(F.desc("n"), "key").limit(VOCABULARY).collect()  # of a fixed size
    sums = counts.filter("kind = 1").groupBy("key").agg(F.sum("n").alias("n"), F.sum("distinct").alias("distinct")).collect()
    total, distinct = np.zeros(SHARED_OUT), np.zeros(SHARED_OUT)
    for r in sums:
        total[r["key"]], distinct[r["key"]] = r["n"], r["distinct"]
    h = np.array([r["key"] for r in top], np.int64).view(np.uint64)
    vocabulary = Vocabulary.build(h, np.array([r["n"] for r in top], np.int64), total, distinct)
    weights = Network().weights
    tasks = _tasks(rows, int(total.sum()) + sum(r["n"] for r in top))
    groups = int(np.ceil(np.sqrt(tasks)))  # sums in two steps: nothing adds up more than about the root of the tasks
    for turn in range(rounds):
        shared = spark.sparkContext.broadcast((vocabulary, weights))
        fitted = rows.coalesce(tasks).mapInArrow(_fit(shared, turn, rounds, groups), "slice int, part int, data binary")
        near = fitted.repartition(SLICES * groups, "slice", "part").mapInArrow(_add_up("<f4"), "slice int, data binary")
        sums = near.repartition(SLICES, "slice").mapInArrow(_add_up("<f8"), "slice int, data binary")
        got = {r["slice"]: np.frombuffer(r["data"], "<f8") for r in sums.toLocalIterator()}  # SLICES rows of a fixed size
        if got:
            weights = np.concatenate([got[k][1:] / got[k][0] for k in range(SLICES)]).astype(np.float32)
        shared.unpersist()
    return vocabulary, weights, counts.filter("kind = 2").select(F.col("key").alias("bucket"), "data")


def _score(shared):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = shared.value
        net = Network(weights)
        for b in batches:
            tokens, scores = np.zeros(b.num_rows, np.int64), np.zeros(b.num_rows)
            for lo, h, words, *_ in common.word_spans(b.column(1), lower=True):
                if not len(h):
                    continue
                x, y, inside = vocabulary(h)
                each = net.log_prob(_contexts(x, words), y) + inside
                tokens[lo : lo + len(words)] = words
                scores[lo : lo + len(words)] = np.bincount(np.repeat(np.arange(len(words)), words), each, len(words))
            mean = pa.array(scores / np.maximum(tokens, 1), mask=tokens == 0)
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(tokens), pa.array(scores), mean], names=["id", "n_tokens", "log_prob", "mean_log_prob"])

    return run


def _score_parts(shared):
    """(id, text) -> rows of scores without P(word | output) of rare words (part null), and the rare words of a chunk by bucket."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocabulary, weights = shared.value
        net = Network(weights)
        chunk, nth, held, size = TaskContext.get().partitionId() << 32, 0, [], 0

        def words_of() -> Iterator[pa.RecordBatch]:
            doc, h = (np.concatenate(x) for x in zip(*held))
            order = np.lexsort((doc, h))
            doc, h = doc[order], h[order]
            first = np.flatnonzero(np.r_[True, (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])])
            n = np.diff(np.r_[first, len(h)])
            doc, h = doc[first], h[first]
            cut = (h >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)
            a = np.flatnonzero(np.r_[True, cut[1:] != cut[:-1]])
            z = np.r_[a[1:], len(h)]
            data = [h[x:y].astype("<u8").tobytes() + doc[x:y].astype("<u4").tobytes() + n[x:y].astype("<u4").tobytes() for x, y in zip(a, z)]
            none = len(a)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(none, chunk)), pa.nulls(none, pa.int64()), pa.nulls(none, kind), pa.nulls(none, pa.int64()), pa.nulls(none, pa.float64()), pa.array(cut[a]), pa.array(data, pa.binary())],
                names=PARTS,
            )

        kind = None
        for b in batches:
            kind = b.schema.field(0).type
            for lo, h, words, *_ in common.word_spans(b.column(1), lower=True):
                scores, k = np.zeros(len(words)), len(words)
                if len(h):
                    x, y, inside = vocabulary(h)
                    rare = vocabulary.rare(h)
                    # a rare word's own count is added where the counts are; here is what it is divided by
                    inside[rare] = -vocabulary.whole[shared_out(h[rare])]
                    of = np.repeat(np.arange(k), words)
                    scores = np.bincount(of, net.log_prob(_contexts(x, words), y) + inside, k)
                    held.append((nth + of[rare], h[rare]))
                    size += int(rare.sum())
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(k, chunk)), pa.array(np.arange(nth, nth + k)), b.column(0).slice(lo, k), pa.array(words.astype(np.int64)), pa.array(scores), pa.nulls(k, pa.int64()), pa.nulls(k, pa.binary())],
                    names=PARTS,
                )
                nth += k
                if size >= CHUNK_RARE or nth >= CHUNK_DOCS:
                    if size:
                        yield from words_of()
                    chunk, nth, held, size = chunk + 1, 0, [], 0
        if size:
            yield from words_of()

    return run


PARTS = ["chunk", "nth", "id", "n_tokens", "log_prob", "bucket", "data"]


def _look_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(bucket, chunk, data), a bucket's counts (chunk null) before its words -> sums of log counts of a chunk's documents."""
    now, keys, logs = None, np.empty(0, np.uint64), np.empty(0)
    for b in batches:
        chunks, out = [], []
        for cut, chunk, data in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2)):
            raw = data.as_buffer()
            if chunk is None:
                both = np.frombuffer(raw, "<u8").reshape(2, -1)
                now, keys, logs = cut, both[0], np.log(both[1].astype(float))
                continue
            m = raw.size // 16
            h, (doc, n) = np.frombuffer(raw, "<u8", m), np.frombuffer(raw, "<u4", 2 * m, 8 * m).reshape(2, m)
            assert cut == now  # every word was counted
            each = n * logs[np.searchsorted(keys, h)]
            docs, where = np.unique(doc, return_inverse=True)
            chunks.append(chunk)
            out.append(docs.astype("<u4").tobytes() + np.bincount(where, each).astype("<f8").tobytes())
        yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(out, pa.binary())], names=["chunk", "data"])


def _put_together(rows: pa.Table, sums: pa.Table) -> pa.Table:
    """The rows of a chunk with the sums of its buckets."""
    rows = rows.sort_by("nth")  # 0, 1, ...
    scores, tokens = rows["log_prob"].to_numpy().copy(), rows["n_tokens"].to_numpy()
    for data in sorted(sums["data"].to_pylist()):
        m = len(data) // 12
        scores[np.frombuffer(data, "<u4", m)] += np.frombuffer(data, "<f8", m, 4 * m)
    mean = pa.array(scores / np.maximum(tokens, 1), mask=tokens == 0)
    return pa.table([rows["id"], rows["n_tokens"], pa.array(scores), mean], names=["id", "n_tokens", "log_prob", "mean_log_prob"])


def pseudo_likelihood(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", rounds: int = ROUNDS) -> DataFrame:
    """One row per input row: id, n_tokens, log_prob, mean_log_prob.

    Tokens are words after lower-casing A-Z; `log_prob` is the sum over tokens of
    the natural logarithm of P(token | the other tokens of its window).

    - null and empty texts, and texts without words: 0 tokens, log_prob 0, mean null.
    - the neighbours of a text's first and last words are an edge token.
    - null ids pass through; repeated rows count twice in training and get equal scores.
    - equal counts go into the vocabulary by hash; whole texts are read.
    - an empty table gives an empty result; other columns are not read.
    """
    spark = docs.sparkSession
    scratch = common.Scratch(spark)
    vocabulary, weights, counts = _learn(docs, text_col, rounds, scratch)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    kind = rows.schema["id"].dataType
    schema = T.StructType(
        [T.StructField("chunk", T.LongType()), T.StructField("nth", T.LongType()), T.StructField("id", kind), T.StructField("n_tokens", T.LongType()), T.StructField("log_prob", T.DoubleType())]
        + [T.StructField("bucket", T.LongType()), T.StructField("data", T.BinaryType())]
    )
    made = scratch.table(rows.mapInArrow(_score_parts(spark.sparkContext.broadcast((vocabulary, weights))), schema), "scored")
    words = made.filter("bucket is not null").select("bucket", "chunk", "data")
    parts = common.partitions(spark, 0, 1)
    dealt = counts.select("bucket", F.lit(None).cast("long").alias("chunk"), "data").unionByName(words).repartition(parts, "bucket").sortWithinPartitions("bucket", F.asc_nulls_first("chunk"))
    sums = dealt.mapInArrow(_look_up, "chunk long, data binary")
    scored = made.filter("nth is not null").select("chunk", "nth", "id", "n_tokens", "log_prob")
    schema = T.StructType([T.StructField("id", kind), T.StructField("n_tokens", T.LongType()), T.StructField("log_prob", T.DoubleType()), T.StructField("mean_log_prob", T.DoubleType())])
    return scored.groupBy("chunk").cogroup(sums.groupBy("chunk")).applyInArrow(_put_together, schema).withColumnRenamed("id", id_col)
