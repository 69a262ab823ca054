"""Benchmark decontamination as a prefix-filtered set join.

Every run of ``WINDOW`` consecutive words of a benchmark item is a window
(an item of fewer words is one window). A window's shingles are ordered by
how rare they are over all documents. Since the whole window must occur, a
prefix of one shingle, the rarest, is enough: only document positions that
carry such a shingle are candidates. A candidate must have enough words
before and after it for the window (length and position bounds) and is then
compared word by word.

Documents are read twice, for the counts and for the candidates; both reads
drop positions through a bitmap of ``BITMAP_BITS`` bits made of the item
shingles, the only thing broadcast: its size is fixed whatever the benchmark
holds, and false positives fall out in the joins. The joins are equality
joins on the shingle, which Spark splits when a passage is in very many
documents.

Defined cases: NULL or wordless texts have no words, no hits and no windows;
repeated rows are judged alike, each has its own result row; other columns
are not read. A NULL item id takes part in hits but is not counted as item.
Texts of any length are gone through whole; an empty table of documents gives
no rows, an empty one of items no hits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import LOWER, ngram_hashes, pick, prefix_sums, signed, span_hash, text_slices, words_of

WINDOW = 10
SHINGLE = 3
BITMAP_BITS = 1 << 23

#: bytes of words: digits, ASCII letters, everything above ASCII
WORD = np.zeros(256, dtype=bool)
WORD[48:58] = WORD[65:91] = WORD[97:123] = True
WORD[128:] = True


def _tokens(batch: pa.RecordBatch, column: int):
    for at, end, data, offsets in text_slices(batch, column):
        data = LOWER[data]
        starts, ends, first = words_of(data, offsets, WORD)
        yield at, end, data, offsets, starts, ends, first, span_hash(sums := prefix_sums(data), starts, ends), sums


def _windows(size: int, shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = {"item_id": [], "words": [], "n": [], "shingles": []}
            ids = batch.column(0).to_pylist()
            for at, end, data, _, starts, ends, first, hashes, _ in _tokens(batch, 1):
                raw = data.tobytes()
                for r in range(at, end):
                    a, b = first[r - at], first[r - at + 1]
                    ws = [raw[s:e].decode() for s, e in zip(starts[a:b], ends[a:b])]
                    n = min(size, b - a)
                    g = min(shingle, n)
                    if n == 0:
                        continue
                    h = signed(ngram_hashes(hashes[a:b], np.array([0, b - a]), g)[0])
                    for i in range(b - a - n + 1):
                        out["item_id"].append(ids[r])
                        out["words"].append(" ".join(ws[i : i + n]))
                        out["n"].append(n)
                        out["shingles"].append(h[i : i + n - g + 1].tolist())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("item_id", batch.schema.field(0).type), ("words", pa.string()), ("n", pa.int32()), ("shingles", pa.list_(pa.int64()))]))

    return run


def _bitmap(hashes: DataFrame) -> np.ndarray:
    """Bits of the given 64-bit keys: at most BITMAP_BITS / 64 rows come to
    the driver, however many keys there are."""
    bit = F.pmod(F.col("h"), F.lit(BITMAP_BITS))
    rows = hashes.groupBy(F.shiftright(bit, 6).alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(pmod(h, 64) as int))")).alias("b")).collect()
    out = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    for r in rows:
        out[r["w"]] = r["b"]
    return out


def _in_bitmap(bits: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = signed(h) % BITMAP_BITS
    return (bits[at >> 6] >> (at & 63)) & 1 == 1


def _counts(bits, sizes: list[int]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, _, _, _, _, _, first, hashes, _ in _tokens(batch, 0):
                for g in sizes:
                    h = ngram_hashes(hashes, first, g)[0]
                    found.append(h[_in_bitmap(bits.value, h)])
            h, n = np.unique(np.concatenate(found) if found else np.zeros(0, np.uint64), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(signed(h)), pa.array(n)], names=["h", "n"])

    return run


def _candidates(bits, sizes: list[int], reach: int):
    """For every document a row with its word count (h NULL), and a row for
    every position whose shingle is in the bitmap, with the words around."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            parts = []
            for at, end, data, offsets, starts, ends, first, hashes, sums in _tokens(batch, 1):
                rows = np.arange(at, end)
                text = signed(span_hash(sums, offsets[:-1], offsets[1:]))
                null = pa.nulls(end - at, pa.int64())
                parts.append((rows, text, null, pa.array(np.diff(first).astype(np.int64)), null, pa.nulls(end - at, pa.string())))
                raw = data.tobytes()
                for g in sizes:
                    h, pos, row = ngram_hashes(hashes, first, g)
                    keep = _in_bitmap(bits.value, h)
                    h, pos, row = h[keep], pos[keep], row[keep]
                    low = np.maximum(first[row], pos - reach + 1)
                    high = np.minimum(first[row + 1], pos + reach)
                    near = [b" ".join([raw[starts[k] : ends[k]] for k in range(a, b)]).decode() for a, b in zip(low, high)]
                    parts.append((at + row, text[row], pa.array(signed(h)), pa.array(pos - first[row]), pa.array(pos - low), pa.array(near, pa.string())))
            for rows, text, h, n, left, near in parts:
                yield pa.RecordBatch.from_arrays([ids.take(pa.array(rows)), pa.array(text), h, n, left, near], names=["doc_id", "t", "h", "n", "left", "near"])

    return run


def find(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> tuple[DataFrame, DataFrame]:
    """(documents, occurrences): documents has doc_id, t (hash of the text)
    and n_words for every row of ``docs``; occurrences has doc_id, t, start,
    n, words for every place where a window occurs."""
    spark = docs.sparkSession
    text = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(text.dtypes)["doc_id"]
    win = windows(items, window, shingle).select("words", "n", "shingles").distinct()
    exploded = win.select("words", "n", F.posexplode("shingles").alias("offset", "h"))
    sizes = list(range(1, shingle + 1))
    bits = spark.sparkContext.broadcast(_bitmap(exploded.select("h")))
    seen = text.select("text").mapInArrow(_counts(bits, sizes), "h long, n long").groupBy("h").agg(F.sum("n").alias("f"))
    # rarest shingle of every window; one that no document has rules it out
    prefix = (
        exploded.join(seen, "h").groupBy("words", "n")
        .agg(F.count("*").alias("c"), F.min(F.struct("f", "h", "offset")).alias("p"), F.first("n").alias("m"))
        .filter(F.col("c") == F.col("m") - F.least(F.lit(shingle), F.col("m")) + 1)
        .select("words", "n", F.col("p.h").alias("h"), F.col("p.offset").alias("offset"))
    )
    path = scratch_path(spark, "decontam")
    prefix.write.parquet(f"{path}/prefix")
    prefix = spark.read.schema(prefix.schema).parquet(f"{path}/prefix")
    bits2 = spark.sparkContext.broadcast(_bitmap(prefix.select("h")))
    schema = f"doc_id {kind}, t long, h long, n long, left long, near string"
    text.mapInArrow(_candidates(bits2, sizes, window), schema).write.parquet(f"{path}/places")
    places = spark.read.schema(schema).parquet(f"{path}/places")
    near = F.split("near", " ")
    start = F.col("left") - F.col("offset")
    hits = (
        places.filter("h IS NOT NULL").select("doc_id", "t", "h", F.col("n").alias("at"), "left", "near")
        .join(prefix, "h")
        .filter((start >= 0) & (start + F.col("n") <= F.size(near)))  # position and length bounds
        .filter(F.array_join(F.slice(near, (start + 1).cast("int"), F.col("n")), " ") == F.col("words"))
        .select("doc_id", "t", (F.col("at") - F.col("offset")).alias("start"), F.col("n").cast("long").alias("n"), "words")
    )
    return places.filter("h IS NULL").select("doc_id", "t", F.col("n").alias("n_words")), hits


def windows(items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    it = pick(items, "item_id", "text").select("item_id", F.col("text").cast("string").alias("text"))
    kind = dict(it.dtypes)["item_id"]
    return it.mapInArrow(_windows(window, shingle), f"item_id {kind}, words string, n int, shingles array<long>")


def judge(docs: DataFrame, items: DataFrame, window: int = WINDOW, shingle: int = SHINGLE) -> DataFrame:
    """Per row of ``docs``: doc_id, t, n_words, n_hit, n_items,
    items_sha256, contaminated."""
    every, hits = find(docs, items, window, shingle)
    doc = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("_k"), "t"]  # one text and id: one key
    spans = hits.groupBy(*doc, "start").agg((F.col("start") + F.max("n")).alias("stop"))
    by = Window.partitionBy("_k", "t").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    fresh = F.col("stop") - F.greatest(F.col("start"), F.coalesce(F.max("stop").over(by), F.lit(0)))
    n_hit = spans.select("_k", "t", F.greatest(fresh, F.lit(0)).alias("fresh")).groupBy("_k", "t").agg(F.sum("fresh").alias("n_hit"))
    of = windows(items, window, shingle).select("words", F.col("item_id").cast("string").alias("item")).filter("item IS NOT NULL").distinct()
    found = hits.select(*doc, "words").distinct().join(of, "words").select("_k", "t", "item").distinct()
    listed = found.groupBy("_k", "t").agg(F.count("*").alias("n_items"), F.array_join(F.sort_array(F.collect_list("item")), ",").alias("_items"))
    keyed = every.select("doc_id", *doc, "n_words")
    out = keyed.join(n_hit, ["_k", "t"], "left").join(listed, ["_k", "t"], "left")
    hit = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id", "t", "n_words", hit.alias("n_hit"), F.coalesce("n_items", F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce("_items", F.lit("")), 256).alias("items_sha256"), (hit > 0).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The query: contamination of every document."""
    return judge(docs, items).drop("t")


ORACLE = r"""
WITH dw AS (SELECT row_number() OVER () AS r, doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM documents),
iw AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS ws FROM benchmark),
win AS (SELECT DISTINCT item_id, least(10, len(ws)) AS n, array_to_string(ws[i:i + least(10, len(ws)) - 1], ' ') AS s
        FROM iw, unnest(range(1, len(ws) - least(10, len(ws)) + 2)) AS u(i) WHERE len(ws) > 0),
sizes AS (SELECT DISTINCT n FROM win),
dwin AS (SELECT r, sizes.n, i, array_to_string(ws[i:i + sizes.n - 1], ' ') AS s FROM dw, sizes, unnest(range(1, len(ws) - sizes.n + 2)) AS u(i) WHERE len(ws) >= sizes.n),
hits AS (SELECT r, i, win.n, item_id FROM dwin JOIN win ON dwin.s = win.s AND dwin.n = win.n),
cov AS (SELECT r, count(DISTINCT i + k) AS n_hit FROM hits, range(0, 10) AS o(k) WHERE k < n GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM dw LEFT JOIN cov USING (r) LEFT JOIN its USING (r)
"""
