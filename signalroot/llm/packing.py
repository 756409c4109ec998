"""Lexical retrieval packing: a sharded BM25 index fills each window with neighbours.

The rows that a task reads are dealt into shards of a fixed number of documents.
Each shard has its own BM25 inverted index over token ids. A seed document opens
a window; the index returns its best unused neighbours, which fill the window
greedily; a document that crosses the end of a window is cut there and seeds the
next. Shards are built where the rows are read, so there is no shuffle and no
group can grow; a lost task builds the same shards again from the same split.

What is left at the end of a shard goes into sequences whose lengths are powers
of two, which need no padding.
"""

from __future__ import annotations

import gc
import os
import re
import unicodedata
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import common

WINDOW, END_ID = 2048, 1
#: Documents of one shard; a shard is also closed at so many token ids.
SHARD_DOCS, SHARD_IDS = 512, 4_000_000
K1, B = 1.2, 0.75


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


#: Chunks whose ids a worker keeps, and word pieces; half of the chunks go when it is full.
CACHE_CHUNKS, CACHE_PIECES = 1_000_000, 250_000
#: Pieces that the tokenizer gets in one string.
PIECES = 4_000
_PIECES = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


@lru_cache(1)
def _unsettled() -> re.Pattern:
    """Finds a code point that was not always of its present category.

    Libraries disagree on those by the version of their tables; chunks that have
    one are left to the tokenizer itself.
    """
    old = unicodedata.ucd_3_2_0
    odd = [c for c in range(0x80, 0x10000) if (k := old.category(chr(c))) == "Cn" or k != unicodedata.category(chr(c))]
    runs = np.split(odd, np.flatnonzero(np.diff(odd) > 1) + 1)
    return re.compile("[" + "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs) + "\U00010000-\U0010ffff\ufffd]")


_MARK, _LETTER, _LOWER, _BIG = (np.zeros(256, bool) for _ in range(4))
_MARK[list(b"!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~")] = True
_BIG[0x41:0x5B] = True
_LOWER[0x61:0x7B] = True
_LETTER[:] = _BIG | _LOWER


def _latin(raw: np.ndarray) -> np.ndarray:
    """Second bytes of the letters of Latin-1."""
    at = np.flatnonzero(raw[:-1] == 0xC3) + 1
    second = raw[at]
    return at[(second & 0xC0 == 0x80) & (second != 0x97) & (second != 0xB7)]


def _eased(raw: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes with capitals of ASCII and Latin-1 in lower case, and where an ASCII mark follows a letter of these.

    The tokenizer lower-cases what it has composed and cuts between a letter and a
    mark, so ids stay the same, while fewer chunks differ. Capitals before a
    character that may combine with them stay, and slices with a special token.
    """
    cut = np.zeros(len(raw), bool)
    if len(raw) < 2 or ((raw[:-1] == 0x3C) & (raw[1:] == 0x7C)).any():
        return raw, cut
    raw = raw.copy()
    alone = np.append((raw[1:] < 0x80) | (raw[1:] == 0xC3), True)  # neither ASCII nor Latin-1 combines with what it follows
    latin = _latin(raw)
    latin = latin[~np.isin(latin, bounds)]
    raw[_BIG[raw] & alone] |= 0x20
    big = latin[(raw[latin] < 0x9F) & alone[latin]]
    raw[big] |= 0x20
    letter = _LETTER[raw]
    letter[latin] = True
    cut[1:] = _MARK[raw[1:]] & letter[:-1]
    return raw, cut


def _plain_words(raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Which chunks are small letters of ASCII and Latin-1 only: one piece, unchanged by the tokenizer's normaliser."""
    good = _LOWER[raw]
    latin = _latin(raw)
    latin = latin[raw[latin] >= 0x9F]
    good[latin] = good[latin - 1] = True
    upto = np.append(0, np.cumsum(~good, dtype=np.int32))
    broken = (raw[start] & 0xC0 == 0x80) | (raw[start + size - 1] == 0xC3)  # not UTF-8
    return (upto[start + size] == upto[start]) & ~broken


def _spans(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Positions of all members of runs, one run after another."""
    out = np.arange(int(size.sum()), dtype=np.int32)  # neither a slice nor a pool comes near 2 GB
    out += np.repeat((start - (np.cumsum(size) - size)).astype(np.int32), size)
    return out


def _distinct(h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(ascending distinct values, first place of each, number of each value): np.unique, sorting the distinct ones only."""
    coded = pa.array(h).dictionary_encode()
    values, where = coded.dictionary.to_numpy(), coded.indices.to_numpy()
    first = np.flatnonzero(np.diff(np.maximum.accumulate(where), prepend=-1))
    order = np.argsort(values)
    rank = np.empty(len(order), np.int32)
    rank[order] = np.arange(len(order), dtype=np.int32)
    return values[order], first[order], rank[where]


class Encoder:
    """Token ids of a text, with the ids of each white-space chunk kept.

    The tokenizer drops white space and never merges across the pieces that its
    pattern cuts, so the ids of a text are those of its pieces one after another.
    Unseen pieces are encoded many at a time in one string; each ends with the
    only ids whose token has the end-of-word mark, which part them again. Chunks
    are found by their hashes and then compared byte for byte. Most are small
    letters once marks and capitals are set aside (`_eased`): one piece as it is.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Sequence, Split

        self.tok = Tokenizer.from_file(path)
        self.bare = Tokenizer(self.tok.model)  # the same merges, for pieces that are normalised and cut already
        self.bare.pre_tokenizer = Sequence([Split(" ", "removed"), ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tok.get_vocab(with_added_tokens=False)
        self.kind = np.dtype("<u2") if max(vocab.values()) < 1 << 16 else np.dtype("<u4")
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.pieces: dict[str, bytes] = {}
        # of the chunks, by ascending hash: their bytes and their ids in the pools, and when they were last used
        self.keys, self.pool, self.spelt = np.empty(0, np.uint64), np.empty(0, self.kind), np.empty(0, np.uint8)
        self.at, self.size, self.byte, self.bytes, self.used = (np.empty(0, np.int32) for _ in range(5))
        self.turn = 0

    def _plain(self, text: str) -> bytes:
        return np.array(self.tok.encode(text, add_special_tokens=False).ids, self.kind).tobytes()

    def _bare(self, pieces: str) -> np.ndarray:
        """Ids of pieces between single spaces."""
        return np.array(self.bare.encode_batch_fast([pieces], add_special_tokens=False)[0].ids, self.kind)

    def _ids_of_words(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, ids of each), where each chunk is one piece."""
        ids, each = [], []
        for lo in range(0, len(start), PIECES):
            a, n = start[lo : lo + PIECES], size[lo : lo + PIECES]
            text = np.full(int(n.sum()) + len(n), 0x20, np.uint8)
            text[_spans(np.cumsum(n + 1) - n - 1, n)] = raw[_spans(a, n)]
            got = self._bare(text[:-1].tobytes().decode())
            stops = np.flatnonzero(self.ends[got]) + 1
            ids.append(got)
            each.append(np.diff(stops, prepend=0))
        return np.concatenate(ids), np.concatenate(each)

    def _ids_of(self, chunks: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, ids of each)."""
        text = b"\n".join(chunks).decode("utf-8", "replace")
        plain = {}
        if not text.isascii() or "<|" in text:
            odd = _unsettled()
            words = text.split("\n")
            plain = {k: self._plain(w) for k, w in enumerate(words) if "<|" in w or not w.isascii() and odd.search(w)}
            for k in plain:
                words[k] = ""
            text = unicodedata.normalize("NFC", "\n".join(words)).replace("\u03a3", "\u03c3")  # the tokenizer has no final sigma
        flat: list[str] = []
        counts = []
        for w in text.lower().split("\n"):
            if w.isalpha():
                flat.append(w)
                counts.append(1)
            elif w[:-1].isalpha() and w[-1] in ",.!?;:":
                flat += (w[:-1], w[-1])
                counts.append(2)
            else:
                some = _PIECES.findall(w)
                flat += some
                counts.append(len(some))
        if len(self.pieces) > CACHE_PIECES:
            self.pieces.clear()
        have = self.pieces
        unseen = list(set(flat).difference(have))
        for lo in range(0, len(unseen), PIECES):
            some = unseen[lo : lo + PIECES]
            ids = self._bare(" ".join(some))
            stops = ((np.flatnonzero(self.ends[ids]) + 1) * self.kind.itemsize).tolist()
            if len(stops) == len(some):
                data = ids.tobytes()
                have.update((p, data[a:z]) for p, a, z in zip(some, [0, *stops], stops))
            else:  # a token with the end-of-word mark inside a piece
                have.update((p, self._plain(p)) for p in some)
        got = list(map(have.__getitem__, flat))
        upto = np.append(0, np.cumsum(np.fromiter(map(len, got), np.int64, len(got))))
        each = np.diff(upto[np.append(0, np.cumsum(counts))]) // self.kind.itemsize
        ids = np.frombuffer(b"".join(got), self.kind)
        if plain:
            parts = np.split(ids, np.cumsum(each)[:-1])
            for k, data in plain.items():
                parts[k] = np.frombuffer(data, self.kind)
                each[k] = len(parts[k])
            ids = np.concatenate(parts)
        return ids, each

    def _shrink(self) -> None:
        """Leaves out the chunks that were used least lately."""
        keep = np.flatnonzero(self.used > np.median(self.used))
        size, length = self.size[keep], self.bytes[keep]
        self.pool, self.spelt = self.pool[_spans(self.at[keep], size)], self.spelt[_spans(self.byte[keep], length)]
        self.keys, self.used, self.size, self.bytes = self.keys[keep], self.used[keep], size, length
        self.at, self.byte = (np.cumsum(n, dtype=np.int32) - n for n in (size, length))

    def ids(self, h: np.ndarray, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all chunks, ids of each chunk), given the chunks' hashes and bytes."""
        self.turn += 1
        if len(self.keys) > CACHE_CHUNKS:
            self._shrink()
        distinct, first, where = _distinct(h)
        k = np.searchsorted(self.keys, distinct)
        known = np.zeros(len(distinct), bool)
        inside = k < len(self.keys)
        known[inside] = self.keys[k[inside]] == distinct[inside]
        if not known.all():
            new = first[~known]
            plain = _plain_words(raw, start[new], size[new])
            n, got = np.empty(len(new), np.int64), []
            order = np.concatenate([np.flatnonzero(plain), np.flatnonzero(~plain)])
            for some, ids_of in ((new[plain], self._ids_of_words), (new[~plain], self._one_by_one)):
                if len(some):
                    got.append(ids_of(raw, start[some], size[some]))
            n[order] = np.concatenate([x for _, x in got])
            at = np.empty(len(new), np.int64)
            at[order] = len(self.pool) + np.cumsum(n[order]) - n[order]
            got = np.concatenate([x for x, _ in got])
            put = k[~known]
            more = {
                "keys": distinct[~known], "used": np.full(len(new), self.turn), "size": n, "bytes": size[new],
                "at": at, "byte": len(self.spelt) + np.cumsum(size[new]) - size[new],
            }
            for name, values in more.items():
                setattr(self, name, np.insert(getattr(self, name), put, values))
            self.pool = np.concatenate([self.pool, got])
            self.spelt = np.concatenate([self.spelt, raw[_spans(start[new], size[new])]])
            k = np.searchsorted(self.keys, distinct)
        self.used[k] = self.turn
        mine = k.astype(np.int32)[where]
        if not np.array_equal(self.bytes[mine], size) or not np.array_equal(raw[_spans(start, size)], self.spelt[_spans(self.byte[mine], size)]):
            return self._one_by_one(raw, start, size)
        n = self.size[mine].astype(np.int64)
        return self.pool[_spans(self.at[mine], n)], n

    def _one_by_one(self, raw: np.ndarray, start: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The same without the hashes: for new chunks, or if two chunks share one."""
        return self._ids_of([raw[a : a + n].tobytes() for a, n in zip(start.tolist(), size.tolist())])

    def encode(self, column: pa.Array) -> Iterator[tuple[int, list[np.ndarray]]]:
        """Slices of a text column: (first row, ids of each text with the id that ends it)."""
        for lo, h, words, raw, start, size in common.word_spans(column, eased=_eased):
            ids, n = self.ids(h, raw, start, size)
            stops = np.append(0, np.cumsum(n))[np.append(0, np.cumsum(words))]
            ids = np.insert(ids, stops[1:], self.kind.type(END_ID))
            yield lo, np.split(ids, (stops[1:] + np.arange(1, len(stops)))[:-1])


class Bm25:
    """Inverted index of one shard: for each token id the documents and weights."""

    def __init__(self, docs: list[np.ndarray]):
        self.n = len(docs)
        length = np.fromiter(map(len, docs), np.float32, self.n)
        # one sort puts the tokens in the order of terms, and those of a term in the order of documents
        flat, bits = np.concatenate(docs), self.n.bit_length()
        both = flat.astype(np.uint32 if int(flat.max(initial=0)).bit_length() + bits <= 32 else np.uint64) << bits
        both |= np.repeat(np.arange(self.n, dtype=both.dtype), np.fromiter(map(len, docs), np.int64, self.n))
        both.sort()
        first = np.flatnonzero(np.append(True, both[1:] != both[:-1]))
        tf = np.diff(first, append=len(both)).astype(np.float32)
        self.doc = (both[first] & ((1 << bits) - 1)).astype(np.int64)
        term = both[first] >> bits
        self.at = np.flatnonzero(np.append(True, term[1:] != term[:-1]))
        df = np.diff(self.at, append=len(term))
        tf = tf * (K1 + 1) / (tf + K1 * (1 - B + B * length[self.doc] / max(length.mean(), 1)))
        idf = np.log((self.n - df + 0.5) / (df + 0.5))
        self.df = np.where(idf > 0, df, 0)  # a term of half the shard or more weighs nothing
        self.weight = (tf * np.repeat(np.maximum(idf, 0), df).astype(np.float32)).astype(np.float64)
        # of each document the numbers of its terms
        self.terms = np.repeat(np.arange(len(df)), df)[np.argsort(self.doc.astype(np.uint16 if bits <= 16 else np.int64), kind="stable")]  # two bytes are sorted by radix
        self.ends = np.append(0, np.cumsum(np.bincount(self.doc, minlength=self.n)))

    def scores(self, seed: int) -> np.ndarray:
        k = self.terms[self.ends[seed] : self.ends[seed + 1]]
        start, size = self.at[k], self.df[k]
        total = int(size.sum())
        if not total:
            return np.zeros(self.n)
        take = np.arange(total)
        take += np.repeat(start - (np.cumsum(size) - size), size)
        return np.bincount(self.doc[take], self.weight[take], self.n)


def pack_shard(docs: list[np.ndarray], window: int = WINDOW) -> list[list[tuple[int, int, int]]]:
    """Sequences of (document number, start, length); only powers of two are short."""
    if not docs:
        return []
    index = Bm25(docs)
    unused = np.ones(len(docs), bool)
    full: list[list[tuple[int, int, int]]] = []
    now: list[tuple[int, int, int]] = []
    room, first, seed, ranked = window, 0, -1, iter(())
    for _ in range(len(docs)):
        pick = -1
        if seed >= 0:
            pick = next((int(j) for j in ranked if unused[j]), -1)
        if pick < 0:
            while not unused[first]:
                first += 1
            pick = first
        unused[pick] = False
        at, left = 0, len(docs[pick])
        if seed < 0:
            seed = pick
        cut = False
        while left:
            part = min(room, left)
            now.append((pick, at, part))
            at, left, room = at + part, left - part, room - part
            if not room:
                full.append(now)
                now, room, cut = [], window, True
        if cut or seed == pick:
            seed = pick if now or not cut else -1
            if seed >= 0:
                scores = index.scores(seed)
                near = np.flatnonzero((scores > 0) & unused)
                ranked = iter(near[np.argsort(-scores[near], kind="stable")])
    return full + _powers(now, window - room)


def _powers(pieces: list[tuple[int, int, int]], total: int) -> list[list[tuple[int, int, int]]]:
    """The last, short window as sequences of descending powers of two."""
    out: list[list[tuple[int, int, int]]] = []
    queue = list(reversed(pieces))
    while total:
        room = 1 << (total.bit_length() - 1)
        total -= room
        now = []
        while room:
            doc, at, left = queue.pop()
            part = min(room, left)
            now.append((doc, at, part))
            room -= part
            if left > part:
                queue.append((doc, at + part, left - part))
        out.append(now)
    return out


_encoders: dict[str, Encoder] = {}


def _run(path: str, window: int, shard_docs: int):
    names = ["id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]

    def emit(ids: list, docs: list[np.ndarray], base: int):
        sequences = pack_shard(docs, window)
        rows: list[tuple[int, int, int, int, int]] = []
        for s, pieces in enumerate(sequences):
            offset = 0
            for doc, at, n in pieces:
                rows.append((doc, at, n, base + s, offset))
                offset += n
        doc, at, n, seq, off = (np.array(c, np.int64) for c in zip(*rows))
        crc = [zlib.crc32(docs[d][a : a + k].astype("<u4").tobytes()) for d, a, k in zip(doc, at, n)]
        sizes = np.fromiter(map(len, docs), np.int64, len(docs))
        kept = pa.chunked_array(ids).combine_chunks() if len(ids) > 1 else ids[0]
        kept = kept.combine_chunks() if isinstance(kept, pa.ChunkedArray) else kept
        yield pa.RecordBatch.from_arrays([kept.take(pa.array(doc)), pa.array(at), pa.array(n), pa.array(crc, pa.int64()), pa.array(sizes[doc]), pa.array(seq), pa.array(off)], names=names)
        return len(sequences)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gc.disable()  # millions of short lists without a cycle among them
        try:
            yield from shards(batches)
        finally:
            gc.enable()

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = _encoders.get(path) or _encoders.setdefault(path, Encoder(path))
        base = TaskContext.get().partitionId() << 40
        ids: list[pa.Array] = []
        docs: list[np.ndarray] = []
        held = 0
        for b in batches:
            for lo, got in encoder.encode(b.column(1)):
                part = b.slice(lo, len(got))
                at = 0
                while at < len(got):  # a shard closes at a number of documents or of ids
                    begin = at
                    while at < len(got) and len(docs) < shard_docs and held < SHARD_IDS:
                        docs.append(got[at])
                        held += len(got[at])
                        at += 1
                    ids.append(part.column(0).slice(begin, at - begin))
                    if len(docs) >= shard_docs or held >= SHARD_IDS:
                        base += yield from emit(ids, docs, base)
                        ids, docs, held = [], [], 0
        if docs:
            yield from emit(ids, docs, base)

    return run


def pack(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", path: str | None = None, window: int = WINDOW, shard_docs: int = SHARD_DOCS) -> DataFrame:
    """One row per piece: id, start, length, ids_crc32, doc_tokens, sequence_id, offset.

    A document's ids are those of the tokenizer file at `path` and a last id 1;
    each of them is in exactly one piece. Sequences have `window` ids, but for
    the last ones of a shard, whose lengths are powers of two.

    - null text is the empty text: its only id is the last one.
    - null ids pass through; repeated rows are packed once each.
    - very long texts are cut over as many windows as they need; equal scores go to the earlier row.
    - an empty table gives an empty result; other columns are not read.

    The input's rows should come in the same order each time it is read, as
    those of a file do, so that a repeated task deals the same shards.
    """
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))
    schema = T.StructType([T.StructField("id", rows.schema["id"].dataType)] + [T.StructField(n, T.LongType()) for n in ("start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset")])
    return rows.mapInArrow(common.tidy(_run(path or tokenizer_path(), window, shard_docs)), schema).withColumnRenamed("id", id_col)
