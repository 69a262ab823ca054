"""Exact Jaccard join of word n-gram sets by universe partition.

Sets are cut into size bands; within a band's universe every item belongs by
hash to one of m segments. Two linked sets differ in at most H items, so of
more than H segments one is equal in both: the key of a segment is the hash
of the items a set has there. A set is keyed in its own band and, where a
partner can be smaller, in the band below.

What a segment costs decides whether it is used. An empty segment is equal
for many sets and is never used; nor is a hot key: one whose pairs across
groups of linked sets are more than ``HOT`` times its sets (a passage that
many documents carry, or two large groups that share one). So the candidates
of a key grow in proportion to its sets.
m is larger than H + 1 by what that takes away as a rule (a set with too few
segments that hold items is keyed by single items as well), and a pair is
sure to be found while one of the two sets has more than H segments left.
Sets with fewer (mostly made of shared passages, or a large group of near copies
that are not near to each other) go to the second index: sets there are
joined by hot key, and each such group is compared in blocks of ``BLOCK``
sets, whole.

Documents with equal sets are one node. Candidates are first compared with
the least node of a key group; what links there is one component, and only
pairs across components are looked at after that, so a group of n copies
costs n comparisons. Every candidate is verified exactly.

Defined cases: no words, or a NULL text: no shingles, own component. Fewer
words than n: the whole sequence is the one shingle. Repeated rows and equal
texts are one node and so linked. NULL doc_id: a document like others, not
counted as smallest unless all ids of its component are NULL. Other columns
are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import LOWER, mix, ngram_hashes, pick, prefix_sums, shuffle_parts, signed, span_hash, text_slices, words_of
from .components import components, likely, verify, written

N = 5
PERCENT = 75
BAND = 1.6
SEGMENTS = 0.38  # of a band's largest size
HOT = 16
BLOCK = 256
BITMAP_BITS = 1 << 26


def sets_of(batch: pa.RecordBatch, column: int, n: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every row."""
    for at, end, data, offsets in text_slices(batch, column):
        data = LOWER[data]
        starts, ends, first = words_of(data, offsets)
        hashes = span_hash(prefix_sums(data), starts, ends)
        grams, _, row = ngram_hashes(hashes, first, n)
        cut = np.searchsorted(row, np.arange(end - at + 1))
        for i in range(end - at):
            if cut[i] < cut[i + 1]:
                yield at + i, np.unique(grams[cut[i] : cut[i + 1]])
            elif first[i] < first[i + 1]:
                k = int(first[i + 1] - first[i])
                yield at + i, ngram_hashes(hashes[first[i] : first[i + 1]], np.array([0, k]), k)[0]
            else:
                yield at + i, np.zeros(0, np.uint64)


def node_of(items: np.ndarray) -> int:
    """An even 64-bit name of a set; its lowest bit is free for a mark."""
    total = mix(np.array([mix(items).sum(dtype=np.uint64) + np.uint64(len(items))], dtype=np.uint64))
    return int(signed(total & np.uint64(0xFFFFFFFFFFFFFFFE))[0])


def band_top(b: int) -> int:
    return int(BAND ** (b + 1))


def band_of(n: int) -> int:
    b = max(0, int(np.log(n) / np.log(BAND)))
    while band_top(b) < n:
        b += 1
    while b and band_top(b - 1) >= n:
        b -= 1
    return b


def partitions(n: int, percent: int) -> list[tuple[int, int, int]]:
    """(band, segments, H) a set of n items is keyed in, its own band first.
    H bounds how much a linked partner in that band can differ."""
    b = band_of(n)
    most = 100 * n // percent  # the largest partner
    bound = lambda x: (100 - percent) * (n + x) // (100 + percent)
    out = [(b, segments(b), bound(most))]
    if b and n * percent <= 100 * band_top(b - 1):
        out.append((b - 1, segments(b - 1), bound(band_top(b - 1))))
    return out


def segments(b: int) -> int:
    return int(SEGMENTS * band_top(b)) + 3


def keys_of(items: np.ndarray, band: int, m: int) -> np.ndarray:
    """The keys of the segments in which the set has items."""
    seg = (mix(items + np.uint64(band * 2 + 1)) % np.uint64(m)).astype(np.int64)
    order = np.argsort(seg, kind="stable")
    seg = seg[order]
    begin = np.flatnonzero(np.r_[True, seg[1:] != seg[:-1]])
    sums = np.add.reduceat(mix(items[order] ^ np.uint64(0xA5A5A5A5)), begin)
    return mix(sums + mix((seg[begin] + (band << 32)).astype(np.uint64)))


def _classes(n: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for i, items in sets_of(batch, 1, n):
                left = []
                if len(items):
                    for band, m, h in partitions(len(items), percent):
                        left.append(len(keys_of(items, band, m)) - h)
                left = [0, 0] if left and min(left) < 1 else [*left, 1][:2] if left else [1, 1]
                rows.append((node_of(items) if len(items) else None, len(items), left[0], left[1], sketch(items) if len(items) else None))
            *cols, parity = list(zip(*rows)) or [[]] * 5
            yield pa.RecordBatch.from_arrays([batch.column(0), *[pa.array(c, pa.int64()) for c in cols], pa.array(parity, pa.binary())], names=["doc_id", "node", "n", "own", "low", "sketch"])

    return run


def _packed(keys: list[np.ndarray], nodes: list[int], parts: int) -> Iterator[pa.RecordBatch]:
    """One row a target partition: the keys (48 bits, byte by byte), how many
    nodes further each is than the one before, and the nodes."""
    key = np.concatenate(keys) >> np.uint64(16)
    of = np.repeat(np.arange(len(keys)), [len(k) for k in keys])
    part = (key % np.uint64(parts)).astype(np.int32)
    order = np.argsort(part, kind="stable")
    key, of, part = key[order], of[order], part[order]
    begin = np.flatnonzero(np.r_[True, part[1:] != part[:-1]])
    blobs = []
    for a, b in zip(begin, np.r_[begin[1:], len(part)]):
        here, at = np.unique(of[a:b], return_inverse=True)
        planes = np.ascontiguousarray(key[a:b].view(np.uint8).reshape(b - a, 8)[:, :6].T)
        step = np.diff(at, prepend=0).astype(np.uint8)  # 0 or 1
        blobs.append(np.array([b - a, len(here)], np.int64).tobytes() + planes.tobytes() + step.tobytes() + np.array(nodes, np.int64)[here].tobytes())
    yield pa.RecordBatch.from_arrays([pa.array(part[begin]), pa.array(blobs, pa.binary())], names=["part", "keys"])


def _keys(n: int, percent: int, parts: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, nodes, seen, size = [], [], set(), 0
            for _, items in sets_of(batch, 0, n):
                if not len(items) or (node := node_of(items)) in seen:
                    continue
                seen.add(node)
                bare = False
                for low, (band, m, h) in enumerate(partitions(len(items), percent)):
                    keys.append(keys_of(items, band, m))
                    nodes.append(node | low)
                    size += len(keys[-1])
                    bare |= len(keys[-1]) <= h
                if bare:  # too few segments hold items: each item is a segment
                    keys.append(mix(items ^ np.uint64(0x5A5A5A5A)))
                    nodes.append(node)
                if size > 500_000:
                    yield from _packed(keys, nodes, parts)
                    keys, nodes, size = [], [], 0
            if keys:
                yield from _packed(keys, nodes, parts)

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The keys of one partition that two or more nodes have, a row a node,
    with the least node of each key."""
    keys, nodes = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for batch in batches:
        for blob in batch.column("keys"):
            raw = blob.as_buffer()
            n, m = np.frombuffer(raw, np.int64, 2)
            full = np.zeros((n, 8), dtype=np.uint8)
            full[:, :6] = np.frombuffer(raw, np.uint8, 6 * n, 16).reshape(6, n).T
            keys.append(full.view(np.uint64)[:, 0])
            step = np.frombuffer(raw, np.uint8, n, 16 + 6 * n)
            nodes.append(np.frombuffer(raw, np.int64, m, 16 + 7 * n)[np.cumsum(step, dtype=np.int64)])
    k, v = np.concatenate(keys), np.concatenate(nodes)
    del keys, nodes
    order = np.argsort(k, kind="stable")
    k, v = k[order], v[order]
    same = k[1:] == k[:-1]
    several = np.zeros(len(k), dtype=bool)
    several[1:] |= same
    several[:-1] |= same
    k, v = k[several], v[several]
    order = np.lexsort((v, k))
    k, v = signed(k[order]), v[order]
    fresh = np.ones(len(k), dtype=bool)
    fresh[1:] = (k[1:] != k[:-1]) | (v[1:] != v[:-1])
    k, v = k[fresh], v[fresh]
    begin = np.flatnonzero(np.r_[True, k[1:] != k[:-1]]) if len(k) else np.zeros(0, np.int64)
    size = np.diff(np.r_[begin, len(k)])
    keep = np.repeat(size > 1, size)
    k, v, lead = k[keep], v[keep], np.repeat(v[begin] & ~np.int64(1), size)[keep]
    for a in range(0, len(k), 100_000):
        yield pa.RecordBatch.from_arrays([pa.array(c[a : a + 100_000]) for c in (k, v, lead)], names=["key", "v", "lead"])


def sketch(items: np.ndarray) -> bytes:
    """Parity of the number of items in each of 2**k bins, 2**k between the
    set's size and twice that: sets differ in at least as many items as
    parities, so most pairs are refused on a few bytes, none wrongly."""
    bits = max(8, 1 << (len(items) - 1).bit_length())
    odd = np.bincount((mix(items + np.uint64(99)) & np.uint64(bits - 1)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8)).tobytes()


def _sets(n: int, bits):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            nodes, out, size = [], [], 0

            def block():
                return pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(out, pa.binary())], names=["node", "set"])

            for _, items in sets_of(batch, 0, n):
                if len(items):
                    node = node_of(items)
                    at = (node >> 1) % BITMAP_BITS
                    if bits.value[at >> 6] >> (at & 63) & 1:
                        nodes.append(node)
                        out.append(items.tobytes())
                        size += 8 * len(items)
                if size > 8 << 20:
                    yield block()
                    nodes, out, size = [], [], 0
            if nodes:
                yield block()

    return run


def _bitmap(nodes: DataFrame) -> np.ndarray:
    """Fixed size, however many nodes: more of them only let more sets pass."""
    bit = F.pmod(F.shiftright("node", 1), F.lit(BITMAP_BITS))
    rows = nodes.select(bit.alias("b")).groupBy(F.shiftright("b", 6).cast("int").alias("w")).agg(F.bit_or(F.expr("shiftleft(1L, cast(b & 63 as int))")).alias("x"))
    out = np.zeros(BITMAP_BITS // 64, dtype=np.int64)
    got = rows.toPandas()
    out[got["w"].to_numpy()] = got["x"].to_numpy()
    return out


def _block(percent: int):
    def run(key, group: pd.DataFrame) -> pd.DataFrame:
        sets = [np.frombuffer(s, dtype=np.uint64) for s in group["set"]]
        sizes = np.array([len(s) for s in sets])
        _, item = np.unique(np.concatenate(sets), return_inverse=True)
        row = np.repeat(np.arange(len(sets)), sizes)
        common = np.zeros((len(sets), len(sets)), dtype=np.float32)
        order = np.argsort(item, kind="stable")
        item, row = item[order], row[order]
        for a in range(0, item[-1] + 1, 4096):  # columns of the membership matrix, a part at a time
            lo, hi = np.searchsorted(item, [a, a + 4096])
            part = np.zeros((len(sets), 4096), dtype=np.float32)
            part[row[lo:hi], item[lo:hi] - a] = 1
            common += part @ part.T
        ok = 100 * common >= percent * (sizes[:, None] + sizes[None, :] - common)
        parent = list(range(len(sets)))

        def top(x):
            while parent[x] != x:
                parent[x] = parent[parent[x]]
                x = parent[x]
            return x

        nodes, edges = group["node"].to_numpy(), []
        for x, y in zip(*np.nonzero(np.triu(ok, 1))):
            if top(x) != top(y):
                parent[top(x)] = top(y)
                edges.append((nodes[x], nodes[y]))
        return pd.DataFrame(edges, columns=["a", "b"], dtype="int64")

    return run


def _blocks(group: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a spanning part of them) within each (node, comp) group: every
    pair of blocks of a group is one task's work."""
    size = group.groupBy("comp").agg(F.ceil(F.count("*") / BLOCK).cast("int").alias("k"))
    at = group.join(size, "comp").withColumn("i", F.pmod(F.xxhash64("node"), F.col("k")).cast("int"))
    pair = at.select("comp", "node", F.explode(F.transform(F.sequence(F.lit(0), F.col("k") - 1), lambda j: F.struct(F.least("i", j).alias("i"), F.greatest("i", j).alias("j")))).alias("p"))
    rows = pair.join(sets, "node").select("comp", "p.i", "p.j", "node", "set")
    return rows.groupBy("comp", "i", "j").applyInPandas(_block(percent), "a long, b long")


def join(docs: DataFrame, n: int = N, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, node (of equal sets) and component_id of every row."""
    spark = docs.sparkSession
    text = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string").alias("text"))
    kind = dict(text.dtypes)["doc_id"]
    classes = written(text.mapInArrow(_classes(n, percent), f"doc_id {kind}, node long, n long, own long, low long, sketch binary"), "classes")
    parts = shuffle_parts(spark)
    keys = text.select("text").mapInArrow(_keys(n, percent, parts), "part int, keys binary")
    shared = written(keys.repartitionById(parts, F.col("part")).mapInArrow(_shared, "key long, v long, lead long"), "shared")
    shared = shared.withColumn("node", F.col("v").bitwiseAND(F.lit(~1)))
    sketches = classes.filter("node IS NOT NULL").select("node", "n", "sketch").join(shared.select("node").distinct(), "node", "left_semi")
    sketches = written(sketches.dropDuplicates(["node"]), "sketches")

    def sets_of_nodes(*nodes: DataFrame) -> DataFrame:
        """The sets of some nodes, made again from the texts."""
        wanted = nodes[0]
        for other in nodes[1:]:
            wanted = wanted.unionAll(other)
        wanted = written(wanted.distinct(), "wanted")
        bits = spark.sparkContext.broadcast(_bitmap(wanted))
        made = text.select("text").mapInArrow(_sets(n, bits), "node long, set binary")
        return written(made.join(wanted, "node", "left_semi").dropDuplicates(["node"]), "sets")

    def ends(pairs: DataFrame) -> DataFrame:
        return pairs.select(F.explode(F.array("a", "b")).alias("node"))

    # First each node with the leader it shares most keys with.
    star = shared.filter("node <> lead").groupBy("node", "lead").count()
    star = star.groupBy("node").agg(F.max_by("lead", F.struct("count", "lead")).alias("lead"))
    star = written(likely(star.select(F.col("lead").alias("a"), F.col("node").alias("b")), sketches, percent), "star")
    links = written(verify(star, sets_of_nodes(ends(star)), percent), "links")
    comps = written(components(links), "comps")
    at = shared.select("key", "v", "node").join(comps, "node", "left").join(sketches.select("node", "n"), "node").select("key", "v", "node", F.coalesce("comp", "node").alias("comp"), "n")
    groups = at.groupBy("key", "comp").agg(F.count("*").cast("double").alias("s")).groupBy("key").agg(F.count("*").alias("c"), F.sum("s").alias("s"), F.sum(F.col("s") * F.col("s")).alias("s2"))
    groups = groups.filter("c > 1").select("key", (F.col("s") * F.col("s") - F.col("s2") > 2 * HOT * F.col("s")).alias("hot"))
    at = written(at.join(groups, "key"), "open")
    # Other keys: every pair across components.
    few = at.filter(~F.col("hot"))
    x = few.select("key", F.col("node").alias("a"), F.col("comp").alias("ca"), F.col("n").alias("na"))
    y = few.select("key", F.col("node").alias("b"), F.col("comp").alias("cb"), F.col("n").alias("nb"))
    close = (F.col("na") * 100 >= F.col("nb") * percent) & (F.col("nb") * 100 >= F.col("na") * percent)
    pairs = x.join(y, "key").filter((F.col("a") < F.col("b")) & (F.col("ca") != F.col("cb")) & close).select("a", "b").distinct()
    pairs = written(likely(pairs, sketches, percent), "pairs")
    # Hot keys: sets that have too few other segments left.
    lost = at.filter("hot").groupBy("node").agg(
        F.count(F.when(F.col("v") == F.col("node"), 1)).alias("lost_own"), F.count(F.when(F.col("v") != F.col("node"), 1)).alias("lost_low"))
    room = classes.filter("node IS NOT NULL").groupBy("node").agg(F.min("own").alias("own"), F.min("low").alias("low"))
    short = lost.join(room, "node").filter("(lost_own > 0 AND own - lost_own < 1) OR (lost_low > 0 AND low - lost_low < 1)").select("node")
    hot = at.filter("hot").join(short, "node", "left_semi").select("key", "node")
    first = hot.groupBy("key").agg(F.min("node").alias("a"))
    second = written(components(hot.join(first, "key").select("a", F.col("node").alias("b"))), "second")
    sets = sets_of_nodes(ends(pairs), second.select("node"))
    links = written(links.unionAll(verify(pairs, sets, percent)).unionAll(_blocks(second, sets, percent)), "all-links")
    final = written(components(links), "comps")
    member = classes.join(final, "node", "left").select("doc_id", "n", F.coalesce("comp", "node").alias("comp"))
    least = member.filter("comp IS NOT NULL").groupBy("comp").agg(F.min("doc_id").alias("component_id"))
    return member.join(least, "comp", "left").select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


def near_duplicates(docs: DataFrame) -> DataFrame:
    """The query: every document with its component."""
    return join(docs)
