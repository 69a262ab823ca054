"""Training-order materialisation of token sequences.

Each text is tokenised, ended by ``end`` and cut into sequences of ``length``
tokens. A sequence's index (document, part) goes through a keyed Feistel
permutation of the index domain with cycle-walking, so its place in training
order is a function of key and index alone: no shuffle buffer, no sort by a
random column, the same order on every run. Equal ranges of places are the
shards; a task sorts one and writes it in records of fixed stride. The
global slot of a sequence is its rank by place; a shard's first slot is the
sum of the counts of the shards before it, so slot s is found by one lookup
in the manifest and one seek, and a reader resumes anywhere.

The index domain covers every part a document could have (a token is at
least a byte), so texts are tokenised once: counting tokens first, to number
sequences without gaps, would tokenise all of them twice. Places of parts
that do not exist stay empty and take up nothing.

Shards are written under temporary names and renamed by the manifest, as in
``warc``. Defined cases: NULL and empty texts have no sequences; a document
whose id is NULL, or no number, takes the number of a hash of id and text, so
that many of them lie in all shards; rows with equal ids keep separate
sequences, next to each other, by text; very long texts are sequences like
others; an empty table gives no shard with records; other columns are not read. A token id takes
two bytes, or four if the vocabulary is larger than 65,536.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import mix, pick, qualified
from .warc import _commit, _files

LENGTH = 256
KEY = 20_240_601
ROUNDS = 6
SHARD_BYTES = 64 << 20
TOKENIZER = "/opt/tokenizers/byte_bpe_50k.tiktoken"
#: fixed value: the pattern that cuts a text before byte-pair merging
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
DOMAIN = 1 << 62

INDEX = "slot long, doc_id {}, part long, n_tokens long, shard long, offset long"
_ROW = "shard long, number long, temporary string, name string, records long, bytes long, sha256 string, doc_id {}, part long, n_tokens long, position long"


def feistel(index: np.ndarray, size: int, key: int, rounds: int = ROUNDS) -> np.ndarray:
    """A keyed permutation of 0 .. size-1: a balanced Feistel network over
    the next even number of bits, applied again while it leaves the range."""
    half = max(1, (int(size - 1).bit_length() + 1) // 2)
    low = np.uint64((1 << half) - 1)
    keys = mix(np.arange(rounds, dtype=np.uint64) + np.uint64(key * 0x9E3779B97F4A7C15 % (1 << 64)))

    def once(x):
        left, right = x >> np.uint64(half), x & low
        for k in keys:
            left, right = right, left ^ (mix(right + k) & low)
        return (left << np.uint64(half)) | right

    out = once(index.astype(np.uint64))
    while (out >= size).any():
        far = out >= size
        out[far] = once(out[far])
    return out.astype(np.int64)


def load_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in (line.split() for line in f if line.strip())}


def _tokenise(ranks, end: int, length: int, key: int, low: int, parts: int, span: int, per_shard: int, kind: pa.DataType, width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import tiktoken

        bpe = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks.value, special_tokens={})
        dtype = np.uint16 if width == 2 else np.uint32

        def out(rows):
            ids, base, part, n, text, data = zip(*rows)
            place = feistel(np.array(base, dtype=np.uint64) * np.uint64(parts) + np.array(part, dtype=np.uint64), span, key)
            return pa.RecordBatch.from_arrays(
                [pa.array(place // per_shard), pa.array(place), pa.array(ids, kind), pa.array(part, pa.int64()), pa.array(n, pa.int64()), pa.array(text), pa.array(data, pa.binary())],
                names=["shard", "place", "doc_id", "part", "n", "t", "tokens"],
            )

        for batch in batches:
            rows, size = [], 0
            for i, base, text in zip(*[c.to_pylist() for c in batch.columns]):
                if not text:
                    continue
                tokens = np.array([*bpe.encode_ordinary(text), end], dtype=dtype)
                mark = hashlib.md5(text.encode()).hexdigest()[:8]
                for k in range(0, len(tokens), length):
                    piece = tokens[k : k + length]
                    rows.append((i, base, k // length, len(piece), mark, piece.tobytes()))
                size += tokens.nbytes
                if size > 8 << 20:
                    yield out(rows)
                    rows, size = [], 0
            if rows:
                yield out(rows)

    return run


def _write(root: str, stride: int, end: int, width: int, kind: pa.DataType):
    fill = (end).to_bytes(width, "little")
    schema = pa.schema([("shard", pa.int64()), ("number", pa.int64()), ("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string()),
                        ("doc_id", kind), ("part", pa.int64()), ("n_tokens", pa.int64()), ("position", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _files(root)
        out, shard, name, count, digest = None, None, None, 0, None

        def close():
            out.close()
            row = {"shard": shard, "number": 0, "temporary": name, "name": f"tokens-{shard:06d}.bin", "records": count, "bytes": count * stride, "sha256": digest.hexdigest()}
            return pa.RecordBatch.from_pylist([row], schema=schema)

        for batch in batches:
            shards = batch.column("shard").to_numpy()
            position = np.empty(len(shards), dtype=np.int64)
            for i, (s, tokens) in enumerate(zip(shards, batch.column("tokens"))):
                if out is None or s != shard:
                    if out is not None:
                        yield close()
                    shard, count, digest = int(s), 0, hashlib.sha256()
                    name = f"_temporary/{shard:06d}-{uuid.uuid4().hex}"
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                data = tokens.as_py()
                data += fill * ((stride - len(data)) // width)
                out.write(data)
                digest.update(data)
                position[i] = count
                count += 1
            n = len(shards)
            none = [pa.nulls(n, schema.field(k).type) for k in ("number", "temporary", "name", "records", "bytes", "sha256")]
            yield pa.RecordBatch.from_arrays([batch.column("shard"), *none, batch.column("doc_id"), batch.column("part"), batch.column("n"), pa.array(position)], schema=schema)
        if out is not None:
            yield close()

    return run


def materialise(docs: DataFrame, root: str, tokenizer: str = TOKENIZER, length: int = LENGTH, key: int = KEY, shard_bytes: int = SHARD_BYTES) -> tuple[DataFrame, DataFrame]:
    """Write the shards under ``root``. Returns (index, manifest): a row per
    sequence (slot, doc_id, part, n_tokens, shard, offset), and a row per
    shard (name, first_slot, records, bytes, sha256), also kept at
    ``root``/manifest."""
    spark = docs.sparkSession
    root = qualified(spark, root)
    ranks = load_ranks(tokenizer)
    end = max(ranks.values()) + 1
    width = 2 if end < 1 << 16 else 4
    stride = length * width
    text = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string").alias("text"))
    kind_sql = dict(text.dtypes)["doc_id"]
    number = F.col("doc_id").try_cast("long")
    low, high, longest, total = text.agg(F.min(number), F.max(number), F.max(F.octet_length("text")), F.sum(F.octet_length("text").cast("long"))).first()
    low, parts = (low or 0) - 1, (longest or 0) // length + 1
    span = ((high or 0) - low + 1) * parts
    if span < DOMAIN:
        base = F.coalesce(number - F.lit(low), F.pmod(F.xxhash64("doc_id", "text"), F.lit((high or 0) - low + 1)))
    else:  # ids too far apart to number: by their hash
        base = F.pmod(F.when(number.isNull(), F.xxhash64("doc_id", "text")).otherwise(F.xxhash64("doc_id")), F.lit(DOMAIN // parts))
        span = DOMAIN // parts * parts
    shards = max(1, -(-(total or 0) // shard_bytes), min(spark.sparkContext.defaultParallelism, -(-(total or 0) // (1 << 20))))
    per_shard = -(-span // shards)
    kind = pa.int64() if kind_sql == "bigint" else pa.int32() if kind_sql == "int" else pa.string()
    if kind == pa.string():
        text = text.withColumn("doc_id", F.col("doc_id").cast("string"))
        kind_sql = "string"
    rows = text.select("doc_id", base.cast("long").alias("base"), "text").mapInArrow(
        _tokenise(spark.sparkContext.broadcast(ranks), end, length, key, low, parts, span, per_shard, kind, width),
        f"shard long, place long, doc_id {kind_sql}, part long, n long, t string, tokens binary",
    )
    files, path = _files(root)
    files.create_dir(f"{path}/_temporary", recursive=True)
    row = _ROW.format(kind_sql)
    placed = rows.repartitionById(shards, F.col("shard").cast("int")).sortWithinPartitions("shard", "place", "doc_id", "t", "part")
    placed.mapInArrow(_write(root, stride, end, width, kind), row).write.parquet(f"{root}/_reports")
    reports = spark.read.schema(row).parquet(f"{root}/_reports")
    done = reports.filter("name IS NOT NULL").select("shard", "number", "temporary", "name", "records", "bytes", "sha256")
    done = done.mapInArrow(_commit(root), "shard long, number long, temporary string, name string, records long, bytes long, sha256 string")
    first = F.coalesce(F.sum("records").over(Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    done.select("shard", "name", first.alias("first_slot"), "records", "bytes", "sha256").write.parquet(f"{root}/manifest")
    manifest = spark.read.schema("shard long, name string, first_slot long, records long, bytes long, sha256 string").parquet(f"{root}/manifest")
    index = (
        reports.filter("name IS NULL").select("shard", "doc_id", "part", "n_tokens", "position")
        .join(manifest.select("shard", "first_slot"), "shard")
        .select((F.col("first_slot") + F.col("position")).alias("slot"), "doc_id", "part", "n_tokens", "shard", (F.col("position") * stride).alias("offset"))
    )
    return index, manifest


def resume(spark: SparkSession, root: str, slot: int, length: int = LENGTH, width: int = 2) -> Iterator[np.ndarray]:
    """Sequences from ``slot`` on, in training order: a training loop's
    reader. One seek, then sequential reads of one record at a time."""
    root = qualified(spark, root)
    files, base = _files(root)
    dtype = np.uint16 if width == 2 else np.uint32
    for r in spark.read.parquet(f"{root}/manifest").filter(F.col("first_slot") + F.col("records") > slot).orderBy("first_slot").toLocalIterator():
        with files.open_input_file(f"{base}/{r['name']}") as f:
            f.seek(max(0, slot - r["first_slot"]) * length * width)
            while data := f.read(length * width):
                yield np.frombuffer(data, dtype=dtype)


def training_order(docs: DataFrame, root: str, **how) -> DataFrame:
    """The query: where every sequence of every document was written."""
    return materialise(docs, root, **how)[0]
