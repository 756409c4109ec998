"""Byte-level BPE against the library it equals, and against plain merging."""

from __future__ import annotations

import hashlib
import random
from functools import lru_cache

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from signalroot.llm import byte_bpe, queries

SF = "/root/testdata/sf0.001"


@lru_cache(1)
def library():
    ranks = byte_bpe.read_ranks(byte_bpe.ranks_path())
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids_of(text: str) -> list[int]:
    return np.frombuffer(b"".join(byte_bpe.coder(byte_bpe.ranks_path())[0].encode(text)), "<u4").tolist()


def merged(ranks: dict[bytes, int], piece: bytes) -> list[int]:
    """Smallest rank first, leftmost first, until nothing merges."""
    if piece in ranks:
        return [ranks[piece]]
    parts = [piece[k : k + 1] for k in range(len(piece))]
    while True:
        due = [(ranks[a + b], k) for k, (a, b) in enumerate(zip(parts, parts[1:])) if a + b in ranks]
        if not due:
            return [ranks[p] for p in parts]
        _, k = min(due)
        parts[k : k + 2] = [parts[k] + parts[k + 1]]


def test_equals_the_library_on_random_texts():
    rng = random.Random(5)
    planes = ["abcdefghijklmnopqrstuvwxyz", "abc ", " \t\n\r\x0b\x0c\x1c\x85\xa0 　", "0123456789²Ⅷ٣", ".,!?'-_#", "éüßñçÀÖ", "日本語中文かな한국어", "\U0001f600‍️☃", "'s't're'll"]
    every = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    for k in range(3000):
        some = "".join(rng.sample(planes, 3)) + "".join(chr(rng.choice(every)) for _ in range(3))
        text = "".join(rng.choice(some) for _ in range(rng.randrange(1, 60)))
        assert ids_of(text) == library().encode_ordinary(text), repr(text)


def test_equals_the_library_on_code_points_of_disputed_class():
    _, stand = byte_bpe._disputed()
    for c in sorted(stand)[:: max(1, len(stand) // 300)]:
        text = f"ab{chr(c)}cd 12{chr(c)}3 {chr(c)}{chr(c)}!\n{chr(c)}"
        assert ids_of(text) == library().encode_ordinary(text), hex(c)


@pytest.mark.parametrize("seed", range(6))
def test_transducer_equals_plain_merging_on_small_vocabularies(seed):
    """Ranks of random merges over three letters: equal parts, overlaps, tokens that no merging reaches."""
    rng = random.Random(seed)
    words = [bytes([b]) for b in range(256)]
    letters = [b"a", b"b", b"c"]
    made = set(words)
    while len(words) < 256 + 60:
        new = rng.choice(letters) + rng.choice(letters)
        if len(new) <= 9 and new not in made:
            made.add(new)
            words.append(new)
            letters.append(new)
    if seed % 2:  # ranks that no training gives
        tail = words[256:]
        rng.shuffle(tail)
        words[256:] = tail
    ranks = {w: k for k, w in enumerate(words)}
    machine = byte_bpe.Transducer(ranks)
    for _ in range(1500):
        piece = bytes(rng.choice(b"abc") for _ in range(rng.randrange(1, 40)))
        assert machine.encode(piece) == merged(ranks, piece), piece


def test_moves_made_afresh_change_nothing(monkeypatch):
    monkeypatch.setattr(byte_bpe, "MOVES", 50)
    machine = byte_bpe.Transducer(byte_bpe.read_ranks(byte_bpe.ranks_path()))
    rng = random.Random(1)
    for n in (5, 80, 3000):
        piece = "".join(rng.choice("etaoin shrdlué") for _ in range(n)).replace(" ", "").encode()
        assert machine.encode(piece) == library()._core_bpe.encode_single_piece(piece)
        assert len(machine.moves) <= 51


def test_tokens_are_put_out_while_bytes_come_in():
    machine = byte_bpe.Transducer(byte_bpe.read_ranks(byte_bpe.ranks_path()))
    out: list[int] = []
    state, longest = 0, 0
    word = b"internationalisation" * 200
    for k, b in enumerate(word):
        state = machine.feed(state, bytes([b]), out)
        longest = max(longest, k + 1 - sum(len(machine.merges.spelt[t]) for t in out))
    assert longest <= 2 * max(map(len, machine.merges.ranks))
    assert out + list(machine.ends[state]) == library()._core_bpe.encode_single_piece(word)


def test_decoder_holds_unfinished_characters():
    spelt = [bytes([b]) for b in range(256)]
    decoder = byte_bpe.Decoder(spelt)
    for text in ("aé日\U0001f600z", "ࠀ퟿\U00010000\U0010ffff"):
        seen = ""
        for b in text.encode():
            seen += decoder.feed(np.array([b])).decode()  # fails on half a character
        assert seen == text and decoder.end() == b""
    rng = random.Random(2)
    for _ in range(500):
        data = bytes(rng.choice([0x41, 0x80, 0xBF, 0xC1, 0xC3, 0xE0, 0xA0, 0xED, 0x9F, 0xF0, 0x90, 0xF4, 0x8F, 0xF5, 0xFF]) for _ in range(rng.randrange(12)))
        cut = rng.randrange(len(data) + 1)
        first = decoder.feed(np.frombuffer(data[:cut], np.uint8))
        rest = decoder.feed(np.frombuffer(data[cut:], np.uint8)) + decoder.end()
        assert first + rest == data
        assert (first + rest).decode("utf-8", "replace") == first.decode("utf-8", "replace") + rest.decode("utf-8", "replace")


def awkward(spark):
    rows = [(1, "plain words"), (1, "plain words"), (2, None), (3, ""), (4, "ß é　x\t\n  \r\n"), (None, "I'll don't 'S"), (None, None), (5, "long " * 400_000), (6, "x" * 300_000), (7, "\U0001f600" * 5000)]
    return rows, spark.createDataFrame([(i, t, "x", 7, "y") for i, t in rows], "doc_id long, text string, ids string, n_tokens int, ids_sha256 string")


def want(doc_id, text):
    text = text or ""
    ids = library().encode_ordinary(text)
    return doc_id, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(text.encode()).hexdigest()


def test_awkward_tables(spark):
    rows, docs = awkward(spark)
    assert sorted(map(tuple, byte_bpe.byte_bpe(docs).collect()), key=str) == sorted((want(*r) for r in rows), key=str)
    assert byte_bpe.byte_bpe(docs.limit(0)).count() == 0
    encoded = byte_bpe.encode(docs)
    assert sorted(((r.doc_id, r.ids) for r in encoded.collect()), key=str) == sorted(((i, library().encode_ordinary(t or "")) for i, t in rows), key=str)
    assert sorted(((r.doc_id, r.text) for r in byte_bpe.decode(encoded).collect()), key=str) == sorted(((i, t or "") for i, t in rows), key=str)


def test_whole_table_equals_the_library(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()
    assert sorted(map(tuple, queries.op12_byte_bpe(spark, SF).collect())) == sorted(want(r.doc_id, r.text) for r in docs)
