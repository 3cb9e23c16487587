"""Vectorised byte and word operations over Arrow string columns."""

from __future__ import annotations

import ctypes
import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

import tickforge

SLICE_BYTES = 1 << 20
#: Rows that go between the JVM and Python at once, so that a batch of long texts stays small on both sides.
BATCH_ROWS = 2000

_rng = np.random.Generator(np.random.PCG64(20240517))
_BYTE = _rng.integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
_MULT = np.uint64(0x9E3779B97F4A7C15)
_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_SHINGLE = _rng.integers(1, 1 << 63, 8, dtype=np.uint64) | np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_SPACE = np.zeros(256, dtype=bool)
_SPACE[[32, *range(9, 14)]] = True
_powers: dict[str, np.ndarray] = {}
_shipped: set[str] = set()


def mix(x: np.ndarray) -> np.ndarray:
    """Finaliser of a 64-bit hash: every input bit reaches every output bit."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))


def map_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """mapInArrow with batches of at most BATCH_ROWS rows; memory that a partition freed goes back to the system."""
    ship(df.sparkSession)
    conf, key = df.sparkSession.conf, "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(conf.get(key)) <= BATCH_ROWS:
        conf.set(key, str(BATCH_ROWS))

    def trimmed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            trim()

    return df.mapInArrow(trimmed, schema)


def ship(spark: SparkSession) -> None:
    """Send this package to the executors if their Python would not find it where the driver does.

    It is found if its folder is in PYTHONPATH or is the working folder, as the driver and workers share those
    (or packages were submitted with the job); else a zip of it is served by the driver, once for each application.
    """
    root = Path(tickforge.__file__).resolve().parent.parent
    known = [Path(p or ".").resolve() for p in (os.getcwd(), *os.environ.get("PYTHONPATH", "").split(os.pathsep))]
    app = spark.sparkContext.applicationId
    if root in known or app in _shipped:
        return
    at = Path(tempfile.mkdtemp(prefix="tickforge-"), "tickforge.zip")
    with zipfile.ZipFile(at, "w", zipfile.ZIP_DEFLATED) as z:
        for p in sorted((root / "tickforge").rglob("*.py")):
            z.write(p, p.relative_to(root))
    spark.sparkContext.addPyFile(str(at))
    _shipped.add(app)


def trim() -> None:
    """Return freed memory; workers stay alive between partitions and would hold it."""
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def slices(batch: pa.RecordBatch, text: str, limit: int = SLICE_BYTES, rows: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    """Cut a batch so that each part holds about limit bytes of text and at most rows rows; one row is never cut."""
    n = batch.num_rows
    if not n:
        return
    size = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(size, dtype=np.int64) // limit + (np.arange(n) // rows << 40)
    edges = np.flatnonzero(np.diff(part)) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), n], strict=True):
        yield batch.slice(a, b - a)


def utf8(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column (null: none) and the n + 1 offsets of its rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    off = np.frombuffer(column.buffers()[1], dtype=np.int64, count=len(column) + 1 + column.offset)[column.offset :]
    data = column.buffers()[2]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return whole[off[0] : off[-1]], off - off[0]


def _pow(kind: str, base: np.uint64, n: int) -> np.ndarray:
    if kind not in _powers or len(_powers[kind]) < n:
        with np.errstate(over="ignore"):
            p = np.full(max(n, 1 << 16), base, dtype=np.uint64)
            p[0] = 1
            _powers[kind] = np.cumprod(p)
    return _powers[kind][:n]


def words(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words [^\\x20\\x09-\\x0D]+ after lower-casing A-Z, and each row's first and last word position."""
    n = len(data)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(len(off) - 1, np.int64), np.zeros(len(off) - 1, np.int64)
    solid = ~_SPACE[data]
    begins = solid.copy()
    begins[1:] &= ~solid[:-1]
    firsts = off[:-1][off[:-1] < n]
    begins[firsts] = solid[firsts]
    start = np.flatnonzero(begins)
    ends = solid.copy()
    ends[:-1] &= ~solid[1:]
    lasts = off[1:][off[1:] > 0] - 1
    ends[lasts] = solid[lasts]
    end = np.flatnonzero(ends) + 1
    with np.errstate(over="ignore"):
        total = np.empty(n + 1, dtype=np.uint64)
        total[0] = 0
        np.cumsum(_BYTE[_LOWER[data]] * _pow("up", _MULT, n), out=total[1:])
        h = (total[end] - total[start]) * _pow("down", _INV, n)[start]
        h = mix(h ^ (end - start).astype(np.uint64))
    return h, np.searchsorted(start, off[:-1]), np.searchsorted(start, off[1:])


def shingles(h: np.ndarray, first: np.ndarray, last: np.ndarray, width: int = 5) -> Iterator[np.ndarray]:
    """Of each row, the sorted distinct hashes of its shingles; a shorter row gives its whole sequence as one."""
    n = len(h)
    with np.errstate(over="ignore"):
        s = np.zeros(max(n - width + 1, 0), dtype=np.uint64)
        for k in range(width):
            s += h[k : k + len(s)] * _SHINGLE[k]
        s = mix(s)
        for a, b in zip(first.tolist(), last.tolist(), strict=True):
            if b - a >= width:
                yield np.unique(s[a : b - width + 1])
            elif b > a:
                yield mix(np.array([np.sum(h[a:b] * _SHINGLE[: b - a]) + np.uint64(b - a)], dtype=np.uint64) ^ _MULT)
            else:
                yield np.zeros(0, np.uint64)
