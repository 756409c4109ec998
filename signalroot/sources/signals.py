"""Signal files: the first ten seconds of the canonical leads, judged and fingerprinted.

A task opens the files of its records itself and reads only the bytes of the
window, so no content goes through a join or a shuffle, whatever the number of
files a record has. Formats are in `formats`; one may differ from file to file. A
record that can't be read becomes a row with its reason.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.arrays import NO_SAMPLE, SATURATED_SHARE, STEPS_PER_MV, WINDOW_S
from ..functions.scalars import CANONICAL_LEADS
from . import files, formats

JUDGED = "record_id string, missing_leads array<string>, flat_leads array<string>, saturated_leads array<string>, n_nonfinite long, n_samples_read long, signal_digest string, wave array<float>, error string"
WHOLE = "record_id string, n_leads int, samples binary, error string"
#: Records for a task, and in a batch that goes out.
RECORDS, BATCH = 2_000, 64

def window_of(signal: np.ndarray, names: list[str | None]) -> tuple[np.ndarray | None, list[str]]:
    """float32[12, n] in canonical order, or None and the missing leads; of a repeated name the last holds."""
    at = {n: k for k, n in enumerate(names) if n}
    missing = [n for n in CANONICAL_LEADS if n not in at]
    if missing:
        return None, missing
    return np.ascontiguousarray(signal[:, [at[n] for n in CANONICAL_LEADS]].T, np.float32), []


def digest_of(window: np.ndarray) -> str:
    good = np.isfinite(window)
    steps = np.where(good, np.rint(np.where(good, window, 0) * np.float32(STEPS_PER_MV)), 0).astype(np.int64)
    return hashlib.sha256(np.where(good, steps, NO_SAMPLE).astype("<i4").tobytes()).hexdigest()


def faults_of(window: np.ndarray) -> tuple[list[str], list[str]]:
    flat, saturated = [], []
    for name, row in zip(CANONICAL_LEADS, window):
        x = row[np.isfinite(row)]
        if not len(x) or x.min() == x.max():
            flat.append(name)
        elif np.sum(x == x.min()) + np.sum(x == x.max()) >= SATURATED_SHARE * len(x):
            saturated.append(name)
    return flat, saturated


def window_length(rate: float, n_samples: int) -> int:
    return min(round(WINDOW_S * rate), n_samples)


def judge(signal: np.ndarray, leads: list[dict]) -> dict:
    """`signal`: float64[window, leads], leads in the header's order."""
    window, missing = window_of(signal, [x["name_canonical"] for x in leads])
    if window is None:
        return {"missing_leads": missing, "flat_leads": [], "saturated_leads": [], "n_nonfinite": 0, "n_samples_read": 0, "signal_digest": None, "wave": None}
    flat, saturated = faults_of(window)
    return {
        "missing_leads": [], "flat_leads": flat, "saturated_leads": saturated, "n_nonfinite": int(np.sum(~np.isfinite(window))), "n_samples_read": len(signal),
        "signal_digest": digest_of(window), "wave": window[0].tolist(),
    }


#: (size, read) of a record's file: its length, and bytes from a place on.
Opener = Callable[[str], tuple[Callable[[], int], Callable[[int, int | None], bytes]]]


def signal_of(row: dict, opened: Opener, whole: bool = False) -> np.ndarray:
    """float64[samples, leads] of a header row, leads in its order: of the window, or of the whole record."""
    leads, n_frames = row["leads"] or [], row["n_samples"]
    if not leads:
        raise formats.Unreadable("no leads")
    at: dict[str, list[int]] = {}
    for k, lead in enumerate(leads):
        at.setdefault(lead["file"], []).append(k)
    held = {name: (opened(name), [leads[k] for k in places]) for name, places in at.items()}
    if n_frames is None:
        n_frames = min(formats.frames_in(size(), own) for (size, _), own in held.values())
    n_window = n_frames if whole else window_length(row["sampling_rate_hz"], n_frames)
    out = np.empty((n_window, len(leads)))
    for name, ((_, read), own) in held.items():
        out[:, at[name]] = formats.decode(read(*formats.span(own, n_frames, n_window)), own, n_frames, n_window)
    return out


def _beside(directory: str, header_path: str) -> Opener:
    """Files in the folder of a header."""
    folder = f"{directory.rstrip('/')}/{header_path}".rpartition("/")[0]

    def opened(name: str):
        path = f"{folder}/{name}"
        return lambda: files.size(path), lambda start, size: files.read(path, start, size)

    return opened


def _given(contents: list[dict]) -> Opener:
    """Files whose bytes came with the row."""
    held = {c["file"]: c["content"] for c in contents}

    def opened(name: str):
        if held.get(name) is None:
            raise FileNotFoundError(name)
        return lambda: len(held[name]), lambda start, size: held[name][start:] if size is None else held[name][start : start + size]

    return opened


def _each(made: Callable[[dict, Opener], dict], directory: str, schema: pa.Schema):
    """Batches of header rows -> what `made` says of each record, or why it can't be read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, BATCH):
                rows = []
                for row in batch.slice(lo, BATCH).to_pylist():
                    try:
                        told = made(row, _given(row["contents"]) if "contents" in row else _beside(directory, row["header_path"]))
                    except (OSError, ValueError, pa.ArrowException) as failed:
                        told = {"error": f"{type(failed).__name__}: {failed}"}
                    rows.append({"record_id": row["record_id"]} | told)
                yield pa.RecordBatch.from_pylist(rows, schema)

    return run


def _applied(spark: SparkSession, headers: DataFrame, directory: str, made, schema: str) -> DataFrame:
    rows = headers.select("record_id", "header_path", "leads", "sampling_rate_hz", "n_samples", "signal_paths")
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), headers.count() // RECORDS + 1)
    if files.reachable(directory):
        rows = rows.repartition(n)  # header rows are small, reading signals isn't
    else:
        rows = _with_contents(spark, rows, directory)
    arrow = pa.schema([pa.field(name, _ARROW[kind]) for name, kind in (c.split() for c in schema.split(", "))])
    return rows.mapInArrow(_each(made, directory, arrow), schema)


_ARROW = {"string": pa.string(), "long": pa.int64(), "int": pa.int32(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()), "array<float>": pa.list_(pa.float32())}


def _with_contents(spark: SparkSession, rows: DataFrame, directory: str) -> DataFrame:
    """Header rows with the bytes of their files, read by Spark: for file systems that only its readers know.

    Here whole files go through one join and one grouping by record.
    """
    read = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(directory).filter(~F.endswith("path", F.lit(".hea")))
    content = read.select(F.substring_index("path", directory.rstrip("/") + "/", -1).alias("signal_path"), "content")
    folder = F.regexp_extract("header_path", r"^(.*/)[^/]*$", 1)
    paths = rows.select("record_id", folder.alias("folder"), F.explode_outer("signal_paths").alias("file")).withColumn("signal_path", F.concat("folder", "file"))
    met = paths.join(content, "signal_path", "left").groupBy("record_id").agg(F.collect_list(F.struct("file", "content")).alias("contents"))
    return rows.join(met, "record_id")


def _judged(row: dict, opened: Opener) -> dict:
    return judge(signal_of(row, opened), row["leads"])


def judged(spark: SparkSession, headers: DataFrame, directory: str) -> DataFrame:
    """Faults, fingerprint and first lead of every record; `error` is null, or says why a record can't be read.

    Only the window is asked for: what is wrong behind it isn't seen.
    """
    return _applied(spark, headers, directory, _judged, JUDGED)


def _matrix(row: dict, opened: Opener) -> dict:
    signal = signal_of(row, opened, whole=True)
    return {"n_leads": signal.shape[1], "samples": signal.tobytes()}


def whole(spark: SparkSession, headers: DataFrame, directory: str) -> DataFrame:
    """(record_id, n_leads, samples, error): every sample of the given records as bytes of float64[n, leads]."""
    return _applied(spark, headers, directory, _matrix, WHOLE)


def matrix(n_leads: int, samples: bytes) -> np.ndarray:
    """float64[n, leads] of a row of `whole`, in the header's order."""
    return np.frombuffer(samples).reshape(-1, n_leads)
