"""Shared helpers: tables, settled results, size-checked joins, Arrow batches, word and byte hashes."""

from __future__ import annotations

import gc
import uuid
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import checkpoint_folder

SLICE_BYTES = 1 << 18  # text handled at once inside a task; its arrays take up to a hundred times as much
BATCH_BYTES = 1 << 21  # text sent at once to a task that goes through it in such slices
BROADCAST_ROWS = 1_000_000  # of a key or of short rows; beyond it both sides shuffle

_MUL1 = np.uint64(0xBF58476D1CE4E5B9)
_MUL2 = np.uint64(0x94D049BB133111EB)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SEEDED = np.random.default_rng(20240229).integers(1, 1 << 63, 260, dtype=np.uint64) | np.uint64(1)

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession, most: int = 16 << 20) -> None:
    """Bounds what one Arrow batch holds, as texts may be long and it is held several times on its way to a worker."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "2000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(most))


_FOLDER: ContextVar[str | None] = ContextVar("folder of settled tables", default=None)


def settled(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table in the shared checkpoint folder: computed once, kept when executors are lost."""
    spark = df.sparkSession
    path = f"{(_FOLDER.get() or checkpoint_folder(spark)).rstrip('/')}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def temporary_tables(spark: SparkSession):
    """Tables settled inside go at the end; what is given to the function that is yielded stays."""
    folder = f"{checkpoint_folder(spark).rstrip('/')}/temporary-{uuid.uuid4().hex}"
    before = _FOLDER.get()
    token = _FOLDER.set(folder)

    def kept(df: DataFrame, name: str) -> DataFrame:
        inner = _FOLDER.set(before)
        try:
            return settled(df, name)
        finally:
            _FOLDER.reset(inner)

    try:
        yield kept
    finally:
        _FOLDER.reset(token)
        delete_folder(spark, folder)


class Scratch:
    """Settled tables of one run, under one folder; each can go once all that reads it is written."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.folder = f"{checkpoint_folder(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"

    def put(self, df: DataFrame, name: str) -> DataFrame:
        # Spark frees the shuffle files of earlier tables once the driver has let go of their plans
        gc.collect()
        self.spark._jvm.System.gc()
        df.write.parquet(f"{self.folder}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.folder}/{name}")

    def drop(self, *names: str) -> None:
        for name in names:
            delete_folder(self.spark, f"{self.folder}/{name}")


def bounded(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Marks a settled table of short rows for broadcasting if it has at most so many; else it is left to shuffle."""
    return F.broadcast(df) if df.count() <= rows else df


_KEPT: dict = {}


def kept_by(operator: str) -> dict:
    """What an operator keeps in a Python worker between its tasks.

    Workers are reused by later stages, so it goes when another operator begins, and unused memory with it.
    """
    if operator not in _KEPT:
        _KEPT.clear()
        gc.collect()
        pa.default_memory_pool().release_unused()
    return _KEPT.setdefault(operator, {})


def utf8(text: Column) -> Column:
    return F.coalesce(text, F.lit("")).cast("binary")


def batches(column: pa.Array, limit: int = SLICE_BYTES):
    """(first row, list of bytes): runs of rows of about `limit` bytes; null is empty."""
    start, held, size = 0, [], 0
    for i in range(len(column)):
        value = column[i].as_buffer()
        held.append(value.to_pybytes() if value is not None else b"")
        size += len(held[-1])
        if size >= limit:
            yield start, held
            start, held, size = i + 1, [], 0
    if held:
        yield start, held


def _powers(base: int):
    table_ = {}

    def get(n: int) -> np.ndarray:
        have = table_.get(0)
        if have is None or len(have) < n:
            size = 1 << max(16, int(n - 1).bit_length())
            out = np.ones(size, np.uint64)
            step = 1
            with np.errstate(over="ignore"):
                while step < size:
                    out[step : 2 * step] = out[:step] * np.uint64(pow(base, step, 1 << 64))
                    step *= 2
            table_[0] = have = out
        return have[:n]

    return get


_POWER, _UNPOWER = _powers(_BASE), _powers(_INVERSE)


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads them evenly."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _MUL1
        x = (x ^ (x >> np.uint64(27))) * _MUL2
        return x ^ (x >> np.uint64(31))


def prefix_sums(data: np.ndarray) -> np.ndarray:
    """Running polynomial sums of bytes; spans of them give content hashes."""
    sums = np.zeros(len(data) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(_SEEDED[data] * _POWER(len(data)), out=sums[1:])
    return sums


def number_sums(numbers: np.ndarray) -> np.ndarray:
    """The same running sums of 64-bit numbers."""
    sums = np.zeros(len(numbers) + 1, np.uint64)
    with np.errstate(over="ignore"):
        np.cumsum(mixed(numbers) * _POWER(len(numbers)), out=sums[1:])
    return sums


def span_hashes(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hash of each span's content, whatever its place; the length counts."""
    with np.errstate(over="ignore"):
        raw = (sums[ends] - sums[starts]) * _UNPOWER(len(sums))[starts]
        return mixed(raw + (ends - starts).astype(np.uint64) * _SEEDED[256])


def sequence_hashes(words: np.ndarray, k: int) -> np.ndarray:
    """Hash of each run of k word hashes."""
    n = len(words) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    with np.errstate(over="ignore"):
        out = np.full(n, np.uint64(k) * _SEEDED[257], np.uint64)
        for j in range(k):
            out = (out * np.uint64(_BASE)) + words[j : j + n] * _SEEDED[j % 256]
    return mixed(out)


def word_table(kind: str) -> np.ndarray:
    """Which lower-cased bytes belong to words: `visible` is all but white space, `letters` is a-z, 0-9 and non-ASCII."""
    out = np.ones(256, bool)
    if kind == "visible":
        out[[32, *range(9, 14)]] = False
    else:
        out[:128] = False
        out[48:58] = True
        out[97:123] = True
    return out


VISIBLE, LETTERS = word_table("visible"), word_table("letters")


def words_of(texts: list[bytes], is_word: np.ndarray):
    """(bytes, starts, ends, word hashes, first word of each text and the end) of joined texts, lower-cased A-Z."""
    data = LOWER[np.frombuffer(b" ".join(texts), np.uint8)]
    mask = np.zeros(len(data) + 2, np.int8)
    mask[1:-1] = is_word[data]
    edges = np.diff(mask)
    starts, ends = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
    hashes = span_hashes(prefix_sums(data), starts, ends)
    begins = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return data, starts, ends, hashes, np.searchsorted(starts, begins)


def fraction(share: float) -> np.uint64:
    return np.uint64(min(int(share * 2.0**64), 2**64 - 1))


def long_lists(arrays: list[np.ndarray]) -> pa.Array:
    offsets = np.cumsum([0, *map(len, arrays)]).astype(np.int32)
    flat = np.concatenate(arrays) if arrays else np.zeros(0, np.uint64)
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat.view(np.int64)))


def list_values(column: pa.Array) -> list[np.ndarray]:
    """The rows of a list<long> column as unsigned numbers."""
    flat = column.values.to_numpy(zero_copy_only=False).view(np.uint64)
    at = column.offsets.to_numpy()
    return [flat[at[i] : at[i + 1]] for i in range(len(column))]
