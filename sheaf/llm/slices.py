"""Corpus totals for slices of documents.

A slice is one row that holds some megabytes of documents, written once. It
asks for the corpus totals of the distinct 64-bit keys that occur in it: its
own counts go with the request, added up beforehand, so a key that holds a
third of the corpus is one entry a slice. Requests go by range of the
(uniform) key to parts; a part adds them up and answers every request in the
request's own order, so answers carry no keys. Answers meet their slice
again by its number. Each of the three steps holds one part or one slice in
memory, whose sizes are set below and do not follow the corpus.

Integers are stored as byte planes under a general compressor: ascending
keys as gaps, small counts as nearly nothing.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

PART_BYTES = 24 << 20
REQUEST = "part long, slice long, what int, kind int, n long, keys binary, counts binary"
ANSWER = "part long, slice long, what int, kind int, found long, totals array<binary>"
#: ``slice`` of a row that speaks for a part
PART_ROW = -1


def pack(values: np.ndarray) -> bytes:
    """Non-negative integers as bytes: their number, the bytes each needs,
    and all first bytes, all second bytes and so on, compressed."""
    a = np.ascontiguousarray(values).astype(np.uint64)
    width = (int(a.max()).bit_length() + 7) // 8 if len(a) else 0
    planes = a.view(np.uint8).reshape(-1, 8).T[:width].tobytes()
    return len(a).to_bytes(6, "little") + bytes([width]) + (pa.compress(planes, codec="zstd", asbytes=True) if planes else b"")


def unpack(data) -> np.ndarray:
    data = memoryview(data)
    n, width = int.from_bytes(data[:6], "little"), data[6]
    out = np.zeros((n, 8), dtype=np.uint8)
    if n and width:
        planes = pa.decompress(data[7:], n * width, codec="zstd")
        out[:, :width] = np.frombuffer(planes, dtype=np.uint8).reshape(width, n).T
    return out.view(np.uint64).ravel()


def pack_rising(keys: np.ndarray) -> bytes:
    """Ascending integers, as gaps."""
    return pack(np.diff(keys, prepend=np.uint64(0)))


def unpack_rising(data) -> np.ndarray:
    return np.cumsum(unpack(data), dtype=np.uint64)


def part_of(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part of each key: equal ranges of its upper 32 bits."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def n_parts(keys: int) -> int:
    """Parts for so many requested keys."""
    return max(1, min(1 << 31, -(-keys * 8 // PART_BYTES)))


def cuts(keys: np.ndarray, parts: int) -> tuple[np.ndarray, np.ndarray]:
    """(parts that occur, bounds): ascending keys fall into runs by part."""
    found, first = np.unique(part_of(keys, parts), return_index=True)
    return found, np.append(first, len(keys))


def request(slice_id: int, what: int, kind: int, keys: np.ndarray, counts: np.ndarray, parts: int) -> list[tuple]:
    """The request rows for ascending distinct keys and their counts."""
    found, at = cuts(keys, parts)
    return [(int(p), slice_id, what, kind, int(e - s), pack_rising(keys[s:e]), pack(counts[s:e])) for p, s, e in zip(found, at[:-1], at[1:])]


_REQUEST = pa.schema([("part", pa.int64()), ("slice", pa.int64()), ("what", pa.int32()), ("kind", pa.int32()), ("n", pa.int64()), ("keys", pa.binary()), ("counts", pa.binary())])
_ANSWER = pa.schema([("part", pa.int64()), ("slice", pa.int64()), ("what", pa.int32()), ("kind", pa.int32()), ("found", pa.int64()), ("totals", pa.list_(pa.binary()))])


def requests(slices: DataFrame, ask: Callable[[dict], Iterator[tuple]]) -> DataFrame:
    """``ask`` makes the request rows of one slice row (a dict)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                rows = list(ask(batch.slice(k, 1).to_pylist()[0]))
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _REQUEST)], schema=_REQUEST)

    return slices.mapInArrow(run, REQUEST)


def answers(asked: DataFrame, channels: int = 1, summary: Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None) -> DataFrame:
    """Totals in the order of each request. A request counts in channel c if
    bit c of its ``kind`` is set; with kind 0 it only asks. ``found`` is the
    number of keys with a total in channel 0, given once for each part and
    ``what``. ``summary`` of a part's keys and totals (``what`` 0) makes a row
    with slice ``PART_ROW`` and two packed columns."""

    def run(table: pa.Table) -> pa.Table:
        out = []
        part = table.column("part")[0].as_py()
        whats, kinds, ids = (np.array(table.column(c).to_pylist(), dtype=np.int64) for c in ("what", "kind", "slice"))
        for what in np.unique(whats):
            rows = np.flatnonzero(whats == what)
            own = [unpack_rising(table.column("keys")[int(r)].as_buffer()) for r in rows]
            sizes = np.array([len(k) for k in own])
            keys, at = np.unique(np.concatenate(own), return_inverse=True)
            del own
            counts = np.concatenate([unpack(table.column("counts")[int(r)].as_buffer()) for r in rows]).astype(np.int64)
            kind = np.repeat(kinds[rows], sizes)
            totals = np.zeros((channels, len(keys)), dtype=np.int64)
            for c in range(channels):
                use = (kind >> c) & 1 == 1
                np.add.at(totals[c], at[use], counts[use])
            found = int((totals[0] > 0).sum())
            ends = np.cumsum(sizes)
            for r, s, e in zip(rows, ends - sizes, ends):
                out.append((part, int(ids[r]), int(what), int(kinds[r]), found, [pack(totals[c][at[s:e]]) for c in range(channels)]))
                found = 0
            if summary is not None and what == 0:
                out.append((part, PART_ROW, 0, 0, 0, [pack(x) for x in summary(keys, totals[0])]))
        return pa.Table.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), _ANSWER)], schema=_ANSWER)

    return asked.groupBy("part").applyInArrow(run, ANSWER)


def answered(table: pa.Table) -> dict[tuple[int, int], list[np.ndarray]]:
    """(what, channel) -> totals of a slice, in the order of all its keys."""
    rows = sorted(zip(table.column("what").to_pylist(), table.column("part").to_pylist(), range(table.num_rows)))
    out: dict[tuple[int, int], list[np.ndarray]] = {}
    for what, _, r in rows:
        for c, data in enumerate(table.column("totals")[r]):
            out.setdefault((what, c), []).append(unpack(data.as_buffer()))
    return {k: np.concatenate(v).astype(np.int64) for k, v in out.items()}


def with_answers(slices: DataFrame, answer: DataFrame, fn: Callable[[dict, dict], pa.RecordBatch], schema: str) -> DataFrame:
    """``fn`` of each slice row and its answers."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return pa.Table.from_batches([fn(left.to_pylist()[0], answered(right))])

    return slices.groupBy("slice").cogroup(answer.filter(F.col("slice") != PART_ROW).groupBy("slice")).applyInArrow(run, schema)


def next_slice() -> Iterator[int]:
    """Slice numbers of this task: distinct over the job, and fixed once the
    slices are written."""
    from pyspark import TaskContext

    base = TaskContext.get().partitionId() << 24
    yield from range(base, base + (1 << 24))
