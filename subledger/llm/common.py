"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import functools
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def crc_fold(key: Column, folds: int) -> Column:
    """crc32 of the key as text, mod ``folds``; a null key counts as empty text."""
    return F.crc32(F.coalesce(key.cast("string"), F.lit(""))) % folds


def shared_dir(spark: SparkSession) -> str:
    """The shared folder the cluster names; a temporary one only where none is set and the session is local (tests)."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("no shared folder: set spark.checkpoint.dir")
    made = tempfile.mkdtemp(prefix="subledger-shared-")
    spark.sparkContext.setCheckpointDir(made)
    return f"file://{made}"


def new_shared_path(spark: SparkSession, what: str) -> str:
    """A folder name in the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{what}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def byte_rows(batch: pa.RecordBatch, text: str = "text", most: int = 8 << 20) -> Iterator[tuple[int, list[bytes | None]]]:
    """A batch's texts as UTF-8 bytes, in runs of about ``most`` bytes: (first row, texts).

    Rows come out of Arrow's buffers run by run, so that the Python objects
    alive at once stay bounded however long the texts of a batch are.
    """
    column = batch.column(text).cast(pa.binary())
    sizes = column.nbytes
    rows = len(column)
    if not rows:
        return
    step = max(1, min(rows, int(rows * most / max(1, sizes))))
    for at in range(0, rows, step):
        yield at, column.slice(at, step).to_pylist()


def bind(value: Column, use) -> Column:
    """``use`` of a value that is computed once (a lambda's variable), however often ``use`` reads it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


#: Bytes that words are hashed in at a time, and the factor of the word polynomial.
HASHED = 1 << 20
_FACTOR = 0x9E3779B97F4A7C15


def mixed_bits(h: np.ndarray) -> np.ndarray:
    """A one-to-one mixing of 64-bit numbers."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


@functools.cache
def _powers(factor: int, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of a factor modulo 2**64, and of its inverse."""
    both = []
    for f in (factor, pow(factor, -1, 1 << 64)):
        p = np.full(size, f, np.uint64)
        p[0] = 1
        both.append(np.multiply.accumulate(p))
    return tuple(both)


def word_hashes(raw: bytes, blank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and 64-bit hashes of the words of a text, mixed from a polynomial of their bytes; ``blank`` tells by byte what parts words.

    Running sums over the bytes give all words' polynomials at once. Slices end where a word
    does, so only a word longer than ``HASHED`` bytes takes more memory.
    """
    codes = np.frombuffer(raw, np.uint8)
    starts, hashes, at = [], [], 0
    while at < len(codes):
        stop = min(len(codes), at + HASHED)
        while stop < len(codes) and not blank[codes[stop]]:
            more = np.flatnonzero(blank[codes[stop:stop + 4096]])
            stop = min(len(codes), stop + (int(more[0]) if len(more) else 4096))
        own = codes[at:stop]
        inside = np.zeros(len(own) + 2, np.int8)
        inside[1:-1] = ~blank[own]
        steps = np.diff(inside)
        begin, end = np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)
        up, down = _powers(_FACTOR, max(2 * HASHED, 1 << len(own).bit_length()))
        sums = np.zeros(len(own) + 1, np.uint64)
        terms = own.astype(np.uint64)
        terms += np.uint64(1)
        terms *= up[:len(own)]
        np.cumsum(terms, out=sums[1:])
        starts.append(begin + at)
        hashes.append(mixed_bits((sums[end] - sums[begin]) * down[begin]))
        at = stop
    return (np.concatenate(starts), np.concatenate(hashes)) if starts else (np.zeros(0, np.int64), np.zeros(0, np.uint64))
