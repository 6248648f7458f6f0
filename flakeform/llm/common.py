"""Words, hashes and Arrow plumbing that the document operators share."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from pathlib import Path
from typing import Any

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space: what separates words.
BREAKS = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
#: Input bytes that one group of documents holds, where documents are dealt out in groups.
CHUNK_BYTES = 6 << 20


def importable(spark: SparkSession) -> None:
    """Let Python workers import this package from where the driver did; a cluster has it installed or mounted."""
    root, context = str(Path(__file__).resolve().parents[2]), spark.sparkContext
    paths = context.environment.get("PYTHONPATH", "")
    if root not in paths.split(":"):
        context.environment["PYTHONPATH"] = f"{root}:{paths}".rstrip(":")


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Arrow batches of at most so many documents, unless the session sets its own number of rows.

    Executors and Python workers hold whole batches, several at a time; by default one has 10,000 rows.
    """
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(name) == "10000":
        spark.conf.set(name, str(rows))


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def word_count(text: Column) -> Column:
    """Number of words; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def crc_fold(doc_id: Column, folds: int) -> Column:
    """Fold of a document: CRC-32 of its id as text, modulo ``folds``; a null id is in fold 0."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % folds, F.lit(0))


def chunked(docs: DataFrame, text: str = "text") -> tuple[DataFrame, int]:
    """Add ``chunk``: groups of whole documents with about ``CHUNK_BYTES`` each, dealt by hash.

    The number of groups follows the bytes of the input, so that a group's size does not.
    """
    size = F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + 64
    total = docs.agg(F.coalesce(F.sum(size), F.lit(0)).alias("n")).first()["n"]
    chunks = max(1, -(-total // CHUNK_BYTES))
    return docs.withColumn("chunk", F.pmod(F.xxhash64("doc_id", F.octet_length(text)), F.lit(chunks)).cast("int")), chunks


_kept: dict[str, object] = {}


def kept_by_worker(name: str, make: Callable[[], Any]) -> Any:
    """What a Python worker keeps from task to task under this name; what it kept under another one goes."""
    if name not in _kept:
        _kept.clear()
        _kept[name] = make()
    return _kept[name]


def trim() -> None:
    """Give freed memory back to the system: Spark reuses Python workers, and allocators hold what a task has freed."""
    pa.default_memory_pool().release_unused()
    give_back = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if give_back:
        give_back(0)


def release_kept() -> None:
    """Free what this Python worker kept for an earlier stage, and trim."""
    _kept.clear()
    trim()


def mapped(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], pa.RecordBatch | pa.Table | None],
    schema: str,
    keeps: bool = False,
) -> DataFrame:
    """Apply a function from batch to batch (or table) over Arrow; None drops the batch.

    Unless the function ``keeps`` something by :func:`kept_by_worker`, what the worker kept before is freed.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if keeps:
            trim()
        else:
            release_kept()
        for batch in batches:
            out = function(batch)
            if isinstance(out, pa.Table):
                yield from out.to_batches()
            elif out is not None:
                yield out

    return df.mapInArrow(run, schema)


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """UTF-8 bytes of each text, empty for null."""
    return [b"" if x is None else x for x in batch.column(name).cast(pa.binary()).to_pylist()]


def sliced(batch: list[bytes], most: int) -> Iterator[list[bytes]]:
    """Consecutive texts with about so many bytes together, at least one at a time."""
    some, size = [], 0
    for text in batch:
        some.append(text)
        size += len(text)
        if size >= most:
            yield some
            some, size = [], 0
    if some:
        yield some


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit numbers (the finalizer of splitmix64)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_IS_BREAK = np.zeros(256, bool)
_IS_BREAK[[32, *range(9, 14)]] = True
_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64))
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 1 << 64)
_SLICE = 1 << 20
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> list[np.ndarray]:
    """Powers of the base and of its inverse, modulo 2^64."""
    if not _powers or len(_powers[0]) < n:
        size = max(n, _SLICE + 1024)
        tables = []
        for base in (_BASE, _INVERSE):
            table = np.full(size, base, np.uint64)
            table[0] = 1
            tables.append(np.cumprod(table, dtype=np.uint64))
        _powers[:] = tables
    return _powers


class Words:
    """64-bit hashes of all words of a batch of texts, with the places of the words.

    ``hashes``, ``starts``, ``ends``: per word, in order; bytes of ``data``. ``first``: per text, the number of
    words before it, and the total at the end. ``owner``: per word, the number of its text.
    """

    def __init__(self, batch: list[bytes], lower: bool):
        joined = b"\n".join(batch) + b"\n"
        self.data = np.frombuffer(joined.lower() if lower else joined, np.uint8)
        inside = np.zeros(len(self.data) + 1, np.int8)
        inside[1:] = ~_IS_BREAK[self.data]
        change = np.diff(inside)
        self.starts, self.ends = np.flatnonzero(change == 1), np.flatnonzero(change == -1)
        limits = np.cumsum([len(x) + 1 for x in batch], dtype=np.int64)
        self.first = np.concatenate([[0], np.searchsorted(self.starts, limits)]).astype(np.int64)
        self.hashes = np.empty(len(self.starts), np.uint64)
        at = 0
        while at < len(self.starts):
            low = self.starts[at]
            to = max(at + 1, int(np.searchsorted(self.ends, low + _SLICE, side="right")))
            high = self.ends[to - 1]
            power, inverse = _power_tables(int(high - low) + 1)
            sums = np.zeros(high - low + 1, np.uint64)
            np.cumsum(_BYTE_VALUES[self.data[low:high]] * power[: high - low], out=sums[1:])
            a, b = self.starts[at:to] - low, self.ends[at:to] - low
            self.hashes[at:to] = mix((sums[b] - sums[a]) * inverse[a] + (b - a).astype(np.uint64))
            at = to

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def owner(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), self.counts)


def window_hashes(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every n consecutive words, also across texts; empty if there are fewer than n."""
    count = max(0, len(hashes) - n + 1)
    total = np.zeros(count, np.uint64)
    for k in range(n):
        total = total * np.uint64(_BASE) + hashes[k : k + count]
    return mix(total + np.uint64(n))
