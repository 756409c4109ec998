"""Signal storage formats: integers out of packed bytes, frames apart, all in numpy.

A format field is `format[xsamples per frame][:skew][+byte offset]`. A frame
holds the samples of every lead of its file, lead after lead; a lead with several
samples in a frame is averaged over it, so all leads have one rate.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from typing import NamedTuple

import numpy as np

_FIELD = re.compile(r"(\d+)(?:x(\d+))?(?::(\d+))?(?:\+(\d+))?")


class Unreadable(ValueError):
    """A record whose header or files don't give its signal."""


class Field(NamedTuple):
    """What a lead's format field says."""

    kind: int
    per_frame: int
    skew: int
    offset: int


class Kind(NamedTuple):
    """A storage format: bits of a sample, how its bytes become integers, the integer of a missing sample."""

    bits: int
    unpack: Callable[[np.ndarray], np.ndarray]
    missing: int | None


def _signed(x: np.ndarray, bits: int) -> np.ndarray:
    """Two's complement of `bits` bits in wider integers."""
    return (x.astype(np.int64) ^ (1 << bits - 1)) - (1 << bits - 1)


def _padded(data: np.ndarray, step: int) -> np.ndarray:
    """uint8[n, step]; a group that the file ends in is filled with zeros."""
    short = -len(data) % step
    return (np.concatenate([data, np.zeros(short, np.uint8)]) if short else data).reshape(-1, step)


def _whole_bytes(width: int, big: bool = False, offset_binary: bool = False):
    """Samples of whole bytes, in two's complement or shifted to be positive."""

    def unpack(data: np.ndarray) -> np.ndarray:
        parts = data[: len(data) // width * width].reshape(-1, width).astype(np.int64)
        order = range(width - 1, -1, -1) if big else range(width)
        x = sum(parts[:, k] << 8 * place for place, k in enumerate(order))
        return x - (1 << 8 * width - 1) if offset_binary else _signed(x, 8 * width)

    return unpack


def _pairs_of_12(data: np.ndarray) -> np.ndarray:
    """Two samples in three bytes: the middle byte has the high bits of both."""
    b = _padded(data, 3).astype(np.int64)
    return _signed(np.stack([b[:, 0] | (b[:, 1] & 0x0F) << 8, b[:, 2] | (b[:, 1] & 0xF0) << 4], axis=1).reshape(-1), 12)


def _triples_of_10(spread: bool):
    """Three samples in four bytes: one after another, or (`spread`) the third in the high bits of both byte pairs."""

    def unpack(data: np.ndarray) -> np.ndarray:
        b = _padded(data, 4).astype(np.int64)
        low, high = b[:, 0] | b[:, 1] << 8, b[:, 2] | b[:, 3] << 8
        if spread:
            three = low >> 1, high >> 1, low >> 11 | (high >> 11) << 5
        else:
            word = low | high << 16
            three = word, word >> 10, word >> 20
        return _signed(np.stack(three, axis=1).reshape(-1) & 0x3FF, 10)

    return unpack


# The published storage formats and their marks of a missing sample.
KINDS = {
    8: Kind(8, _whole_bytes(1), None),
    16: Kind(16, _whole_bytes(2), -(1 << 15)),
    24: Kind(24, _whole_bytes(3), -(1 << 23)),
    32: Kind(32, _whole_bytes(4), -(1 << 31)),
    61: Kind(16, _whole_bytes(2, big=True), -(1 << 15)),
    80: Kind(8, _whole_bytes(1, offset_binary=True), -(1 << 7)),
    160: Kind(16, _whole_bytes(2, offset_binary=True), -(1 << 15)),
    212: Kind(12, _pairs_of_12, -(1 << 11)),
    310: Kind(10, _triples_of_10(spread=True), -(1 << 9)),
    311: Kind(10, _triples_of_10(spread=False), -(1 << 9)),
}
#: Samples that are differences to the one before.
DIFFERENCES = 8


def field(text: str) -> Field:
    met = _FIELD.fullmatch(text or "")
    if not met:
        raise Unreadable(f"no signal format: {text!r}")
    kind, per_frame, skew, offset = (int(x) if x else default for x, default in zip(met.groups(), (0, 1, 0, 0)))
    if kind not in KINDS:
        raise Unreadable(f"signal format {kind} isn't known")
    if not per_frame:
        raise Unreadable("a frame without samples")
    return Field(kind, per_frame, skew, offset)


def of_file(leads: list[dict]) -> list[Field]:
    """The fields of all leads of one file, which have one format and one offset between them."""
    found = [field(x["format"]) for x in leads]
    if len({(f.kind, f.offset) for f in found}) > 1:
        raise Unreadable("leads of one file have several formats: " + ", ".join(sorted({x["format"] for x in leads})))
    return found


def _bytes_of(samples: int, kind: Kind) -> int:
    """Bytes that so many samples take; packed groups start at whole bytes, so it is rounded up."""
    return -(-samples * kind.bits // 8) if kind.bits != 10 else samples // 3 * 4 + (0, 2, 4)[samples % 3]


def span(leads: list[dict], n_frames: int | None, n_window: int | None) -> tuple[int, int | None]:
    """(first byte, bytes) of a file that the first `n_window` frames need, the rest of the file if that isn't known."""
    fields = of_file(leads)
    if n_window is None:
        return fields[0].offset, None
    frames = n_window + max(f.skew for f in fields)
    frames = frames if n_frames is None else min(frames, n_frames)
    return fields[0].offset, _bytes_of(frames * sum(f.per_frame for f in fields), KINDS[fields[0].kind])


def frames_in(n_bytes: int, leads: list[dict]) -> int:
    """Whole frames of a file whose header doesn't say."""
    fields = of_file(leads)
    bits, each = KINDS[fields[0].kind].bits, sum(f.per_frame for f in fields)
    held = max(n_bytes - fields[0].offset, 0)
    n = held * 8 // bits if bits != 10 else held // 4 * 3 + (0, 0, 1, 1)[held % 4]
    return n // each


def decode(data: bytes, leads: list[dict], n_frames: int, n_window: int) -> np.ndarray:
    """float64[n_window, leads] in physical units; `data` begins where the samples do.

    Missing samples, and those that a skew puts behind the record's end, are NaN.
    """
    fields = of_file(leads)
    kind, each = KINDS[fields[0].kind], sum(f.per_frame for f in fields)
    frames = min(n_window + max(f.skew for f in fields), n_frames)
    need = _bytes_of(frames * each, kind)
    if len(data) < need:
        raise Unreadable(f"{len(data)} of {need} bytes are there")
    raw = kind.unpack(np.frombuffer(data, np.uint8, need))[: frames * each].reshape(frames, each)
    out = np.full((n_window, len(leads)), np.nan)
    at = 0
    for k, (lead, f) in enumerate(zip(leads, fields)):
        x = raw[:, at : at + f.per_frame]
        at += f.per_frame
        if f.kind == DIFFERENCES:
            x = int(lead["initial_value"] or 0) + np.cumsum(x.reshape(-1)).reshape(x.shape)
        value = (x.astype(np.float64) - lead["baseline"]) / lead["gain"]
        if kind.missing is not None:
            value[x == kind.missing] = np.nan
        value = value.mean(axis=1)[f.skew : f.skew + n_window]
        out[: len(value), k] = value
    return out
