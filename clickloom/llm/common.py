"""Helpers shared by the corpus operators: shared tables, text as byte arrays, word hashes."""

from __future__ import annotations

import atexit
import contextlib
import ctypes
import uuid
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Odd multipliers of the two polynomial hashes (bytes of a word, words of a window).
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xC2B2AE3D27D4EB4F
#: Text taken at once inside a task; a longer document is taken alone and whole.
BLOCK_BYTES = 4 << 20

_made: list[tuple[SparkSession, str]] = []


def work_dir(spark: SparkSession) -> str:
    """A fresh folder all executors reach: under ``spark.checkpoint.dir``, else in the warehouse."""
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    path = f"{base.rstrip('/')}/corpus-{uuid.uuid4().hex}"
    if not _made:
        atexit.register(_clean)
    _made.append((spark, path))
    return path


def delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


def _clean() -> None:
    """Delete what this session pinned; results read it lazily, so not earlier."""
    for spark, path in _made:
        with contextlib.suppress(Exception):  # the session may be gone
            delete(spark, path)


def pin(df: DataFrame, *by: str) -> DataFrame:
    """``df`` written to the shared folder and read back: lineage ends, a lost executor costs a re-read."""
    path = work_dir(df.sparkSession)
    writer = df.write.partitionBy(*by) if by else df.write
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused(df: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of ``df`` has it (case aside)."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    """A table of the workload; Python workers look for this package where the driver found it."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def mix(h: np.ndarray) -> np.ndarray:
    """Spread 64-bit values evenly (a bijection)."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h ^= h >> np.uint64(33)
    h *= np.uint64(0xC4CEB9FE1A85EC53)
    h ^= h >> np.uint64(33)
    return h


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.size = base, 0

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if n > self.size:
            self.size = max(n, self.size * 5 // 4, 1 << 16)
            ahead = np.full(self.size, self.base, np.uint64)
            back = np.full(self.size, pow(self.base, -1, 1 << 64), np.uint64)
            ahead[0] = back[0] = 1
            self.ahead, self.back = np.cumprod(ahead), np.cumprod(back)
        return self.ahead, self.back


# Only the GNU C library has it.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
_bytes, _words = Powers(BYTE_BASE), Powers(WORD_BASE)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IN_WORD = np.zeros(256, bool)
_IN_WORD[0x30:0x3A] = _IN_WORD[0x61:0x7B] = _IN_WORD[0x80:] = True


def spans(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, powers: Powers) -> np.ndarray:
    """Hash of each ``values[start:end]``; equal spans have equal hashes wherever they lie."""
    ahead, back = powers.get(len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * ahead[: len(values)], out=total[1:])
    return mix((total[ends] - total[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def byte_spans(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return spans(data, starts, ends, _bytes)


def prefix_hashes(data: np.ndarray, size: int) -> np.ndarray:
    """Hash of the ``size`` bytes from each place on; the last ``size - 1`` places have none."""
    ahead, back = _bytes.get(len(data) + 1)
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * ahead[: len(data)], out=total[1:])
    return mix((total[size:] - total[:-size]) * back[: len(total) - size] + np.uint64(size)) if len(data) >= size else total[:0]


class Grams:
    """Hashes of runs of words, given the words' own hashes."""

    def __init__(self, words: np.ndarray):
        self.back = _words.get(len(words) + 1)[1]
        self.total = np.zeros(len(words) + 1, np.uint64)
        np.cumsum((words + np.uint64(1)) * _words.ahead[: len(words)], out=self.total[1:])

    def at(self, starts: np.ndarray, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each start on."""
        return mix((self.total[starts + k] - self.total[starts]) * self.back[starts] + np.uint64(k))

    def all(self, k: int) -> np.ndarray:
        """Hash of the ``k`` words from each position on; the last ``k - 1`` positions have none."""
        n = len(self.total) - k
        return mix((self.total[k:] - self.total[:n]) * self.back[:n] + np.uint64(k)) if n > 0 else np.zeros(0, np.uint64)


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of a text column and each row's offsets in them; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_string())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1]
    if data is None or not len(offsets):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def release() -> None:
    """Give freed memory back to the system: a worker stays, and its share of an executor is small."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def blocks(offsets: np.ndarray, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of about ``limit`` bytes each; a longer row is a range of its own."""
    low, n = 0, len(offsets) - 1
    while low < n:
        high = max(low + 1, int(np.searchsorted(offsets, offsets[low] + limit, "right")) - 1)
        yield low, min(high, n)
        low = min(high, n)
        release()


class Words:
    """The lower-cased words ``[0-9a-z]`` or beyond ASCII of some rows, in order.

    ``hash``: one value per word; ``row``: the row it is in; ``first``: index of
    each row's first word (one more at the end); ``start``, ``end``: byte places.
    """

    def __init__(self, data: np.ndarray, offsets: np.ndarray):
        data = _LOWER[data]
        word = _IN_WORD[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[offsets] = True
        before = np.concatenate(([False], word[:-1])) if len(word) else word
        after = np.concatenate((word[1:], [False])) if len(word) else word
        self.start = np.flatnonzero(word & (~before | cut[:-1]))
        self.end = np.flatnonzero(word & (~after | cut[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)
        self.row = np.repeat(np.arange(len(offsets) - 1), np.diff(self.first))
        self.hash = byte_spans(data, self.start, self.end)
        self.data = data

    def inside(self, k: int) -> np.ndarray:
        """Whether the ``k`` words from each position on lie in one row."""
        return self.row[: len(self.row) - k + 1] == self.row[k - 1 :] if len(self.row) >= k else np.zeros(0, bool)


def word_blocks(column: pa.Array, limit: int = BLOCK_BYTES) -> Iterator[tuple[int, int, Words]]:
    """Row ranges of a text column with their words."""
    data, offsets = texts(column)
    for low, high in blocks(offsets, limit):
        at = offsets[low : high + 1]
        yield low, high, Words(data[at[0] : at[-1]], at - at[0])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours, by doubling."""
    out, have = values, 1
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def binaries(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> pa.Array:
    """``data[start:end]`` of each pair as an Arrow binary column."""
    sizes = (ends - starts).astype(np.int64)
    offsets = np.zeros(len(sizes) + 1, np.int64)
    np.cumsum(sizes, out=offsets[1:])
    take = np.arange(offsets[-1]) + np.repeat(starts - offsets[:-1], sizes)
    return pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(sizes), [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[take]))])


def with_columns(docs: DataFrame, sources: list[str], work: Callable[..., list[pa.Array]], outs: str) -> DataFrame:
    """``docs`` with the columns of the DDL text ``outs``, which ``work`` makes from ``sources`` batch by batch.

    Columns that already have such a name are replaced; all others stay.
    """
    new = T.StructType.fromDDL(outs).fields
    taken = {f.name.lower() for f in new}
    stay = [i for i, name in enumerate(docs.columns) if name.lower() not in taken]
    schema = T.StructType([*(docs.schema.fields[i] for i in stay), *new])
    at = [docs.columns.index(name) for name in sources]

    def run(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([*(batch.column(i) for i in stay), *work(*(batch.column(i) for i in at))], schema.names)

    return docs.mapInArrow(run, schema)
