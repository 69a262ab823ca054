"""Connected components of an edge table, and verification of set pairs."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path


def written(df: DataFrame, name: str, **options: str) -> DataFrame:
    """``df`` written to the shared checkpoint folder and read back: lineage
    ends there, and a lost executor costs no more than its own tasks.
    ``options`` are those of the parquet writer."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """Large star: a node's larger neighbours are tied to the least of its
    neighbourhood; small star: its smaller ones. Minima are partial
    aggregates, so a node of any degree is reduced before the shuffle."""
    if large:
        side = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionAll(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    else:
        side = edges.select(F.col("b").alias("u"), F.col("a").alias("v"))
    least = side.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    out = side.join(least, "u")
    tied = out.filter("v > u") if large else out.filter("v <> m")
    rows = tied.select(F.col("m").alias("a"), F.col("v").alias("b"))
    if not large:
        rows = rows.unionAll(least.select(F.col("m").alias("a"), F.col("u").alias("b")))
    return rows.filter("a <> b").select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, comp) of every node in an edge, comp its component's least
    node, by alternating large and small stars until nothing moves."""
    e = written(edges.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    mark = lambda x: x.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(20,0)"))).first()
    before = mark(e)
    while before[0]:
        e = written(_star(_star(e, True), False), "edges")
        after = mark(e)
        if after == before:
            break
        before = after
    return e.groupBy(F.col("b").alias("node")).agg(F.min("a").alias("comp")).unionAll(
        e.select(F.col("a").alias("node"), F.col("a").alias("comp")).distinct()
    )


def _linked(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x, y = batch.column("x"), batch.column("y")
            keep = []
            for i in range(batch.num_rows):
                a, b = (np.frombuffer(c[i].as_buffer(), dtype=np.uint64) for c in (x, y))
                both = np.sort(np.concatenate([a, b]))
                common = int((both[1:] == both[:-1]).sum())
                keep.append(100 * common >= percent * (len(a) + len(b) - common))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    return run


_BITS = np.array([bin(i).count("1") for i in range(256)], dtype=np.uint8)


def _folded(x: np.ndarray, size: int) -> np.ndarray:
    """A parity sketch of fewer bins: the bin of an item is its hash modulo
    their number, so the upper half falls on the lower."""
    while len(x) > size:
        x = x[: len(x) // 2] ^ x[len(x) // 2 :]
    return x


def _likely(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for na, nb, x, y in zip(*[batch.column(c) for c in ("na", "nb", "x", "y")]):
                a, b = (np.frombuffer(c.as_buffer(), dtype=np.uint8) for c in (x, y))
                size = min(len(a), len(b))
                differ = int(_BITS[_folded(a, size) ^ _folded(b, size)].sum())
                # common = (na + nb - difference) / 2
                keep.append(differ * (100 + percent) <= (100 - percent) * (na.as_py() + nb.as_py()))
            mask = pa.array(keep, pa.bool_())
            yield pa.RecordBatch.from_arrays([batch.column("a").filter(mask), batch.column("b").filter(mask)], names=["a", "b"])

    return run


def likely(pairs: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """The pairs whose parity sketches (node, n, sketch) allow the
    similarity: those refused differ in too many items for certain."""
    one = pairs.join(sketches.select(F.col("node").alias("a"), F.col("sketch").alias("x"), F.col("n").alias("na")), "a")
    two = one.join(sketches.select(F.col("node").alias("b"), F.col("sketch").alias("y"), F.col("n").alias("nb")), "b")
    return two.select("a", "b", "na", "nb", "x", "y").mapInArrow(_likely(percent), "a long, b long")


def verify(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets have a Jaccard similarity of ``percent``
    or more, compared exactly. ``sets``: node, set (sorted 64-bit items)."""
    one = pairs.join(sets.select(F.col("node").alias("a"), F.col("set").alias("x")), "a")
    two = one.join(sets.select(F.col("node").alias("b"), F.col("set").alias("y")), "b")
    return two.select("a", "b", "x", "y").mapInArrow(_linked(percent), "a long, b long")
