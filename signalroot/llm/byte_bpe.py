"""Byte-level BPE: a lazily determinised transducer encodes, a UTF-8 state machine decodes.

A row of tokens is the encoding of its bytes exactly if every token encodes to
itself and no merge ever crosses two neighbours (`Merges.part`). So every prefix
of a piece has one encoding, and that of a longer prefix continues one of an
earlier prefix. The transducer follows all prefixes that may still be continued:
an item is (place in the trie of tokens since that prefix, its last token, its
tokens not yet put out). The items after a byte are a state. States and moves are
made when a text first needs them and kept; tokens that all items agree on are
put out with the move, so lookahead is bounded by the longest token.

Everything runs where the rows are read: no shuffle, no model beyond the rank
file. A worker keeps at most `MOVES` moves and `common.CACHE_WORDS` pieces, and
starts afresh beyond; results don't depend on what it keeps.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import islice

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common

#: Moves that a worker keeps, and the pieces of a text that are encoded at a time.
MOVES, PIECES = 600_000, 1 << 16
_NEVER = 1 << 40


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_multi_50k.tiktoken")


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Merges:
    """What the ranks say of one token or of two neighbours."""

    def __init__(self, ranks: dict[bytes, int]):
        if any(bytes([b]) not in ranks for b in range(256)):
            raise ValueError("every byte needs a rank")
        self.ranks = ranks
        self.spelt = [b""] * (max(ranks.values()) + 1)
        for token, rank in ranks.items():
            self.spelt[rank] = token
        self._lives: dict[int, list[tuple[int, bytes, bytes]] | None] = {}
        self._apart: dict[tuple[int, int], bool] = {}

    def lives(self, token: int) -> list[tuple[int, bytes, bytes]] | None:
        """(rank of the next merge, first part, last part) from the bytes to the whole; None if the token isn't its own encoding."""
        if token not in self._lives:
            word = self.spelt[token]
            parts = [word[k : k + 1] for k in range(len(word))]
            told = []
            while len(parts) > 1:
                rank, k = min((self.ranks.get(a + b, _NEVER), k) for k, (a, b) in enumerate(zip(parts, parts[1:])))
                if rank == _NEVER:
                    break
                told.append((rank, parts[0], parts[-1]))
                parts[k : k + 2] = [parts[k] + parts[k + 1]]
            told.append((_NEVER, parts[0], parts[-1]))
            self._lives[token] = told if len(parts) == 1 else None
        return self._lives[token]

    def part(self, left: int, right: int) -> bool:
        """Whether the two tokens, side by side, stay apart.

        Each side merges as it would alone, always the smaller rank next and the
        left one of equals, until a merge across is due before both.
        """
        known = self._apart.get((left, right))
        if known is None:
            if len(self._apart) > MOVES:
                self._apart.clear()
            known = self._apart[left, right] = self._part(self.lives(left), self.lives(right))
        return known

    def _part(self, left, right) -> bool:
        i = j = 0
        while True:
            (due_left, _, last), (due_right, first, _) = left[i], right[j]
            across = self.ranks.get(last + first, _NEVER)
            if across < due_left and across <= due_right:
                return False
            if due_left == due_right == _NEVER:
                return True
            if due_left <= due_right:
                i += 1
            else:
                j += 1


class Transducer:
    """Bytes in, tokens out; `feed` and `end` stream a piece of any length."""

    def __init__(self, ranks: dict[bytes, int]):
        self.merges = Merges(ranks)
        self.child: dict[int, int] = {}  # node * 256 + byte -> node
        self.token = [-1]
        for word, rank in ranks.items():
            node = 0
            for b in word:
                node = self.child.setdefault(node << 8 | b, len(self.token))
                if node == len(self.token):
                    self.token.append(-1)
            self.token[node] = rank
        self.inner = {key >> 8 for key in self.child}
        self._afresh()

    def _afresh(self) -> None:
        self.moves: dict[int, tuple[int, tuple[int, ...]]] = {}  # state * 256 + byte -> state, tokens put out
        self.items: list[tuple] = []
        self.ends: list[tuple[int, ...]] = []
        self.number: dict[tuple, int] = {}
        self._state(((0, -1, ()),))

    def _state(self, items: tuple) -> int:
        k = self.number.setdefault(items, len(self.items))
        if k == len(self.items):
            self.items.append(items)
            self.ends.append(items[-1][2])
        return k

    def _move(self, state: int, byte: int) -> tuple[int, tuple[int, ...]]:
        items = self.items[state]
        if len(self.moves) >= MOVES:
            self._afresh()
            state = self._state(items)
        on, whole = [], None
        for node, last, waiting in items:
            node = self.child.get(node << 8 | byte, 0)
            if not node:
                continue
            if node in self.inner:
                on.append((node, last, waiting))
            token = self.token[node]
            if whole is None and token >= 0 and self.merges.lives(token) is not None and (last < 0 or self.merges.part(last, token)):
                whole = (0, token, (*waiting, token))
        on.append(whole)
        low, high = min(x[2] for x in on), max(x[2] for x in on)
        n = next((k for k, (a, b) in enumerate(zip(low, high)) if a != b), min(len(low), len(high)))
        to = self._state(tuple((node, last, waiting[n:]) for node, last, waiting in on))
        found = self.moves[state << 8 | byte] = (to, low[:n])
        return found

    def feed(self, state: int, data: bytes, out: list[int]) -> int:
        """The state after more bytes of a piece; tokens that are certain go to `out`."""
        for b in data:
            found = self.moves.get(state << 8 | b)
            state, tokens = found or self._move(state, b)
            if tokens:
                out += tokens
        return state

    def encode(self, piece: bytes) -> list[int]:
        """Tokens of one piece; a piece that is a token is that token, whatever its merges say."""
        whole = self.merges.ranks.get(piece)
        if whole is not None:
            return [whole]
        out: list[int] = []
        state = self.feed(0, piece, out)
        return out + list(self.ends[state])


@lru_cache(1)
def _disputed() -> tuple[re.Pattern | None, dict[int, str]]:
    """Code points whose class (letter, number, space) the encoder's library sees otherwise than the pattern's, with stand-ins.

    The two libraries carry tables of different Unicode versions.
    """
    import tiktoken

    every = "".join(map(chr, [*range(0xD800), *range(0xE000, 0x110000)]))
    single = {bytes([b]): b for b in range(256)}
    stand: dict[int, str] = {}
    kinds = [(r"\p{L}", "ª"), (r"\p{N}", "1"), (r"\s", " ")]
    theirs = {}
    for pattern, _ in kinds:
        seen = tiktoken.Encoding("classes", pat_str=pattern, mergeable_ranks=single, special_tokens={}).encode_ordinary(every)
        theirs[pattern] = set(bytes(seen).decode())
    for c in set().union(*(theirs[p] ^ set(regex.findall(p, every)) for p, _ in kinds)):
        stand[ord(c)] = next((s for p, s in kinds if c in theirs[p]), "☃")
    if not stand:
        return None, stand
    odd = np.array(sorted(stand))
    runs = np.split(odd, np.flatnonzero(np.diff(odd) > 1) + 1)
    return re.compile("[" + "".join(f"\\U{r[0]:08x}-\\U{r[-1]:08x}" for r in runs) + "]"), stand


class Encoder:
    """Ids of whole texts, piece by piece; the ids of each piece seen are kept."""

    def __init__(self, path: str):
        import public_tokenizers

        self.transducer = Transducer(read_ranks(path))
        self.pattern = regex.compile(public_tokenizers.PATTERN)
        self.known = common.Lookup(lambda piece: np.array(self.transducer.encode(piece.encode()), "<u4").tobytes())

    def pieces(self, text: str) -> Iterator[list[str]]:
        """The pattern's matches, some at a time."""
        odd, stand = (None, None) if text.isascii() else _disputed()
        if odd and odd.search(text):
            spans = (m.span() for m in self.pattern.finditer(text.translate(stand)))
            found = (text[a:z] for a, z in spans)
        elif len(text) < 8 * PIECES:
            yield self.pattern.findall(text)
            return
        else:
            found = (m.group() for m in self.pattern.finditer(text))
        while some := list(islice(found, PIECES)):
            yield some

    def encode(self, text: str) -> Iterator[bytes]:
        """Ids as little-endian unsigned 32-bit integers, some at a time."""
        for some in self.pieces(text):
            yield b"".join(map(self.known.__getitem__, some))


# States of a UTF-8 sequence: 0 between characters, else (bytes so far, least and greatest next byte, state after it).
_PARTS = [(0, 0, 0, 0), (1, 0x80, 0xBF, 0), (1, 0x80, 0xBF, 9), (1, 0xA0, 0xBF, 9), (1, 0x80, 0x9F, 9), (1, 0x80, 0xBF, 10), (1, 0x90, 0xBF, 10), (1, 0x80, 0x8F, 10), (3, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 0), (2, 0x80, 0xBF, 8)]
_HELD = [p[0] for p in _PARTS]


def _first_state(b: int) -> int:
    if 0xC2 <= b <= 0xDF:
        return 1
    if 0xE0 <= b <= 0xEF:
        return {0xE0: 3, 0xED: 4}.get(b, 2)
    return {0xF0: 6, 0xF4: 7}.get(b, 5) if 0xF0 <= b <= 0xF4 else 0


#: state, byte -> state. A byte that can't go on begins anew; one that can't begin stands alone.
_UTF8 = np.array([[after if s and low <= b <= high else _first_state(b) for b in range(256)] for s, (_, low, high, after) in enumerate(_PARTS)], np.int8)


class Decoder:
    """Whole characters out of ids; the bytes of an unfinished one wait for the next ids.

    The state machine runs over tokens, not bytes: each token has the state that
    follows every state.
    """

    def __init__(self, spelt: list[bytes]):
        self.spelt = spelt
        size = np.array([len(w) for w in spelt])
        flat = np.frombuffer(b"".join(spelt), np.uint8)
        at = np.cumsum(size) - size
        self.after = np.tile(np.arange(len(_PARTS), dtype=np.int8), (len(spelt), 1))
        for k in range(int(size.max())):
            some = np.flatnonzero(size > k)
            self.after[some] = _UTF8[self.after[some], flat[at[some] + k][:, None]]
        self.settles = (self.after == self.after[:, :1]).all(axis=1)
        self.begin()

    def begin(self) -> None:
        self.state, self.held = 0, b""

    def feed(self, ids: np.ndarray) -> bytes:
        """Bytes up to the last character that is whole."""
        ends = np.flatnonzero(self.settles[ids[-64:]])
        start = max(len(ids) - 64, 0) + int(ends[-1]) if len(ends) else 0
        for i in ids[start:].tolist():
            self.state = int(self.after[i, self.state])
        data = self.held + b"".join(map(self.spelt.__getitem__, ids.tolist()))
        cut = len(data) - _HELD[self.state]
        self.held = data[cut:]
        return data[:cut]

    def end(self) -> bytes:
        """What is left when no id follows; then a new text may begin."""
        left = self.held
        self.begin()
        return left


@lru_cache(2)
def coder(path: str) -> tuple[Encoder, Decoder]:
    """Encoder and decoder of a rank file, once per worker."""
    encoder = Encoder(path)
    return encoder, Decoder(encoder.transducer.merges.spelt)


def _texts(batch: pa.RecordBatch, name: str) -> Iterator[str]:
    """Texts of a column, one at a time; null is empty, bytes that aren't UTF-8 become U+FFFD."""
    for value in batch.column(name).cast(pa.large_binary()):
        yield (value.as_py() or b"").decode("utf-8", "replace")


def encode(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, ids): token ids of every whole text; a null text has none.

    Rows are taken one by one: repeated rows and ids give equal rows, an empty
    table none; further columns aren't read. Ids of one text are one array.
    """
    path = path or ranks_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = coder(path)
        for batch in batches:
            ids = [np.frombuffer(b"".join(encoder.encode(t)), "<u4").astype(np.int32) for t in _texts(batch, "text")]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, ids array<int>")


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, text): the text of each row (doc_id, ids); null ids give an empty text.

    Ids that end inside a character, or spell no UTF-8, give U+FFFD there; an id
    without a token is an error.
    """
    path = path or ranks_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, decoder = coder(path)
        for batch in batches:
            texts = []
            for ids in batch.column("ids"):
                ids = np.array(ids.as_py() or [], np.int64)
                parts = [decoder.feed(ids[k : k + PIECES]).decode("utf-8", "replace") for k in range(0, len(ids), PIECES)]
                texts.append("".join([*parts, decoder.end().decode("utf-8", "replace")]))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    return encoded.select("doc_id", F.col("ids").cast("array<int>")).mapInArrow(run, f"doc_id {encoded.schema['doc_id'].dataType.simpleString()}, text string")


def byte_bpe(docs: DataFrame, path: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) of every whole text, encoded and decoded again.

    Ids count as little-endian unsigned 32-bit integers. Ids and decoded bytes
    go through the digests as a stream, so a text needs no memory beyond itself
    and some pieces. Null counts as empty; nulls and repeats among ids pass
    through; further columns aren't read; an empty table gives no row.
    """
    path = path or ranks_path()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, decoder = coder(path)
        for batch in batches:
            counts, ids_sha, text_sha = [], [], []
            for text in _texts(batch, "text"):
                n, of_ids, of_text = 0, hashlib.sha256(), hashlib.sha256()
                for data in encoder.encode(text):
                    ids = np.frombuffer(data, "<u4")
                    n += len(ids)
                    of_ids.update(data)
                    of_text.update(decoder.feed(ids))
                of_text.update(decoder.end())
                counts.append(n)
                ids_sha.append(of_ids.hexdigest())
                text_sha.append(of_text.hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(run, f"doc_id {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
