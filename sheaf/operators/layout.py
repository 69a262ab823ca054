"""Where rows go in a table's files.

Parquet keeps the least and the greatest value of a column for each file and
row group, and a filter skips what lies outside. Sorting helps the first
column only. Here rows are placed along a space-filling curve: each cluster
column is reduced to a few bits by its cut points, the bits of all columns
are interleaved, and files are ranges of that number, so that every file
covers a small range of each of the columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import col_of

BITS = 5
#: rows read to choose the cut points; they decide the layout, never a result
SAMPLE_ROWS = 4096


def cut_points(df: DataFrame, columns: list[str], bits: int = BITS, sample_rows: int = SAMPLE_ROWS) -> dict[str, list]:
    """For each column the values that cut a random sample into 2 ** bits
    equal parts (fewer where values repeat)."""
    rows = df.select(*[col_of(c).alias(f"c{i}") for i, c in enumerate(columns)]).orderBy(F.rand(7)).limit(sample_rows).collect()
    out = {}
    for i, c in enumerate(columns):
        values = sorted(r[i] for r in rows if r[i] is not None)
        parts = 1 << bits
        cuts = [values[len(values) * k // parts] for k in range(1, parts)] if values else []
        out[c] = sorted({v for v in cuts if v > values[0]}) if values else []
    return out


def curve(cuts: dict[str, list], bits: int = BITS) -> Column:
    """The place of a row on the curve: the highest bit of every column, then
    the next of every column, and so on. NULL counts as least."""
    ranks = []
    for c, values in cuts.items():
        rank = F.lit(0)
        for v in values:
            rank = rank + F.coalesce(col_of(c) >= F.lit(v), F.lit(False)).cast("int")
        ranks.append(rank)
    place = F.lit(0).cast("long")
    for b in reversed(range(bits)):
        for rank in ranks:
            place = F.shiftleft(place, 1).bitwiseOR(F.shiftright(rank, b).bitwiseAND(F.lit(1)).cast("long"))
    return place


def clustered(df: DataFrame, columns: list[str], files: int, bits: int = BITS) -> DataFrame:
    """``df`` in ``files`` partitions by range of the curve over ``columns``,
    each sorted along it. Rows at one place (a hot value) are dealt on by a
    hash of the whole row and the task that it comes from, so they too spread
    over several files, and copies with them."""
    place = curve(cut_points(df, columns, bits), bits)
    plain = [n for n, kind in df.dtypes if "variant" not in kind and "map<" not in kind]  # the others cannot be hashed
    deal = F.xxhash64(*[col_of(c) for c in plain], F.spark_partition_id())
    out = df.select("*", place.alias("_place"), deal.alias("_deal"))
    out = out.repartitionByRange(files, "_place", "_deal").sortWithinPartitions("_place", *[col_of(c) for c in columns])
    return out.drop("_place", "_deal")
