"""Shared helpers: table reading, narrow column selection that ignores extra
columns, and numpy kernels over Arrow text columns.

The kernels work on the UTF-8 bytes of many documents at once, in slices of
a few megabytes, so a task's memory does not depend on its partition."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import _hadoop

SLICE_BYTES = 2 << 20
_MASK = (1 << 64) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def qualified(spark: SparkSession, root: str) -> str:
    """A folder with its file system's scheme: without one it is that of the
    cluster's default file system, not a machine's own disk."""
    fs, path = _hadoop(spark, root)
    return fs.makeQualified(path).toString()


def named(name: str) -> Column:
    """A column by its exact name (dots and back-ticks are part of it)."""
    return F.col("`" + name.replace("`", "``") + "`")


def pick(df: DataFrame, *names: str) -> DataFrame:
    """Only the given columns: whatever else the table holds cannot clash
    with an operator's own columns, and is never read."""
    return df.select(*[named(n).alias(n) for n in names])


def shuffle_parts(spark: SparkSession) -> int:
    n = spark.conf.get("spark.sql.shuffle.partitions", "200")
    return int(n) if str(n).isdigit() else spark.sparkContext.defaultParallelism


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit values (a bijection) so that all bits are usable."""
    x = x ^ (x >> np.uint64(33))
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


def _constants(n: int, salt: int) -> np.ndarray:
    return mix(np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64(salt))


_BASE = 0x5851F42D4C957F2D
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE = _constants(256, 11)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n-1) modulo 2**64, kept between slices."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = max(n, 2 * SLICE_BYTES)
        out = np.full(size, base, dtype=np.uint64)
        out[0] = 1
        have = np.cumprod(out, dtype=np.uint64)
        if size <= 16 * SLICE_BYTES:
            _powers[base] = have
    return have[:n]


def prefix_sums(codes: np.ndarray) -> np.ndarray:
    """S with S[j] - S[i] = sum of code(byte k) * BASE**k over i <= k < j."""
    out = np.zeros(len(codes) + 1, dtype=np.uint64)
    np.cumsum(_BYTE[codes] * _power(_BASE, len(codes)), out=out[1:])
    return out


def span_hash(sums: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of bytes start..end, the same wherever they stand."""
    raw = (sums[end] - sums[start]) * _power(_INVERSE, len(sums))[start]
    return mix(raw + (end - start).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def text_slices(batch: pa.RecordBatch, column: int | str) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, end row, bytes, offsets) over a string column: offsets[i]
    to offsets[i+1] are row i's UTF-8 bytes (none for NULL). A slice holds at
    most SLICE_BYTES, or one longer text."""
    col = batch.column(column)
    if not pa.types.is_large_string(col.type):
        col = col.cast(pa.large_string())
    n = len(col)
    if n == 0:
        return
    _, off, data = col.buffers()
    offsets = np.frombuffer(off, dtype=np.int64, count=n + 1 + col.offset)[col.offset :]
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    at = 0
    while at < n:
        end = int(np.searchsorted(offsets, offsets[at] + SLICE_BYTES, side="right")) - 1
        end = min(max(end, at + 1), n)
        yield at, end, whole[offsets[at] : offsets[end]], offsets[at : end + 1] - offsets[at]
        at = end


#: bytes that separate words: space, \t \n \v \f \r
SPACES = np.ones(256, dtype=bool)
SPACES[[32, 9, 10, 11, 12, 13]] = False
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def words_of(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray = SPACES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first) of all words in the slice; row i has the words
    first[i] to first[i+1]. A word never crosses a row."""
    inside = is_word[data]
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[offsets] = True  # a row begins
    before = np.zeros(len(data) + 1, dtype=bool)
    before[1:] = inside
    now = np.zeros(len(data) + 1, dtype=bool)
    now[:-1] = inside
    starts = np.flatnonzero(now & (~before | edge))
    ends = np.flatnonzero(before & (~now | edge))
    return starts, ends, np.searchsorted(starts, offsets)


_SHINGLE = _constants(64, 29) | np.uint64(1)


def ngram_hashes(words: np.ndarray, first: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash, word position, row) of every run of n words within a row."""
    total = len(words) - n + 1
    if total <= 0:
        none = np.zeros(0, dtype=np.int64)
        return none.astype(np.uint64), none, none
    acc = np.zeros(total, dtype=np.uint64)
    for k in range(n):
        acc += words[k : k + total] * _SHINGLE[k]
    row = np.repeat(np.arange(len(first) - 1), np.diff(first))
    at = np.arange(total)
    keep = at + n <= first[row[:total] + 1]
    return mix(acc + np.uint64(n))[keep], at[keep], row[:total][keep]
