"""Deterministic sharded WARC writer and its reader.

Records are range-sorted by page id into shards. The shard bounds come from
the ids alone (ids whose hash falls in a fixed share, at most
``BOUND_SAMPLE`` of them, sorted), so they do not depend on how the input is
split, and the same table always gives the same files. A shard's records
are written in order into gzip members, one a record; a file is closed when
its compressed size passes ``max_bytes``. All headers and digests are made
anew from the payload.

A task writes under a temporary name of its own and reports what it wrote;
the reports of the tasks that succeeded form the manifest, and only files
in it get their final names. A lost or repeated task leaves a stray
temporary file and nothing else, and renaming again does no harm.

Of records with equal payloads of ``MIN_REVISIT`` bytes or more the one with
the largest page id is a response, the others are revisits of it. Which
rows are revisits is found on digests only; the html is shuffled once.

Defined cases: NULL html is an empty payload; a NULL url has no target
header; a NULL page id sorts first, as the smallest; repeated rows are
separate records (of a repeated largest page id with one payload, the first
record is the response). A payload of any length is one record; an empty table
gives an empty manifest. Other columns are not read.
"""

from __future__ import annotations

import base64
import gzip
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs as pafs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import pick, qualified

MIN_REVISIT = 1000
MAX_BYTES = 64 << 20
SHARD_BYTES = 256 << 20
BOUND_SAMPLE = 1 << 18
DATE = "2020-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

PAGE = "page_id long, payload_bytes long, payload_digest string, record_type string, refers_to long"
_MANIFEST = "shard long, number long, temporary string, name string, records long, bytes long, sha256 string"


def _files(root: str) -> tuple[pafs.FileSystem, str]:
    if "://" not in root and not root.startswith("file:"):
        return pafs.LocalFileSystem(), root
    if root.startswith("file:"):
        return pafs.LocalFileSystem(), "/" + root[5:].lstrip("/")
    return pafs.FileSystem.from_uri(root)


def _id(page: int | None, serial: int) -> str:
    return f"<urn:x-page:{'none' if page is None else page}{':' + str(serial) if serial else ''}>"


def _uri(url: str) -> str:
    """The url on one header line: controls, spaces and ``%`` are escaped."""
    return "".join(c if c > " " and c not in "%\x7f\x85  " else "".join(f"%{b:02X}" for b in c.encode()) for c in url)


def record(page: int | None, serial: int, url: str | None, payload: bytes, refers: str | None) -> bytes:
    sha = base64.b32encode(hashlib.sha1(payload).digest()).decode()
    http = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    block = http if refers else http + payload
    head = ["WARC/1.1", f"WARC-Type: {'revisit' if refers else 'response'}", f"WARC-Record-ID: {_id(page, serial)}", f"WARC-Date: {DATE}"]
    head += [] if url is None else [f"WARC-Target-URI: {_uri(url)}"]
    head += [f"WARC-Refers-To: {refers}", f"WARC-Profile: {PROFILE}"] if refers else []
    head += [
        f"WARC-Payload-Digest: sha1:{sha}",
        f"WARC-Block-Digest: sha1:{base64.b32encode(hashlib.sha1(block).digest()).decode()}",
        "Content-Type: application/http; msgtype=response",
        f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(head).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _bounds(pages: DataFrame, shards: int) -> np.ndarray:
    """Shard bounds from a fixed share of the distinct ids, chosen by their
    hash: however often an id occurs, it comes to the driver once."""
    ids = pages.filter("page_id IS NOT NULL").select("page_id").distinct()
    n = ids.count()
    share = max(1, -(-n // BOUND_SAMPLE))
    some = sorted(r[0] for r in ids.filter(F.pmod(F.xxhash64("page_id"), F.lit(share)) == 0).collect())
    return np.array(sorted({some[len(some) * k // shards] for k in range(1, shards)}) if some else [], dtype=np.int64)


def _write(root: str, max_bytes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _files(root)
        done: list[tuple] = []
        out = None
        shard = number = name = size = count = digest = None
        page, serial, refers = "", 0, {}

        def close():
            nonlocal out
            if out is not None:
                out.close()
                done.append((shard, number, name, f"warc-{shard:06d}-{number:05d}.warc.gz", count, size, digest.hexdigest()))
                out = None

        for batch in batches:
            for s, key, kind, url, html, sha, target in zip(*[c.to_pylist() for c in batch.columns]):
                if key != page:
                    page, serial, refers = key, 0, {}
                if kind == 0:  # what this page's payloads revisit
                    refers[sha] = target
                    continue
                payload = html or b""
                if out is not None and (s != shard or size >= max_bytes):
                    close()
                if s != shard:
                    shard, number = s, -1
                if out is None:
                    number, size, count, digest = number + 1, 0, 0, hashlib.sha256()
                    name = f"_temporary/{shard:06d}-{number:05d}-{uuid.uuid4().hex}"
                    out = files.open_output_stream(f"{base}/{name}", compression=None)
                first = refers.get(hashlib.sha1(payload).hexdigest()) if refers else None
                if first == key and first is not None:  # this page's own first record of it is the response
                    at, refers[hashlib.sha1(payload).hexdigest()] = None, (key, serial)
                elif isinstance(first, tuple):
                    at = _id(*first)
                else:
                    at = None if first is None else _id(first, 0)
                data = gzip.compress(record(page, serial, url, payload, at), 5, mtime=0)
                out.write(data)
                digest.update(data)
                size, count, serial = size + len(data), count + 1, serial + 1
        close()
        yield pa.RecordBatch.from_pylist(
            [dict(zip(("shard", "number", "temporary", "name", "records", "bytes", "sha256"), r)) for r in done],
            schema=pa.schema([("shard", pa.int64()), ("number", pa.int64()), ("temporary", pa.string()), ("name", pa.string()), ("records", pa.int64()), ("bytes", pa.int64()), ("sha256", pa.string())]),
        )

    return run


def _commit(root: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _files(root)
        for batch in batches:
            for r in batch.to_pylist():
                if files.get_file_info(f"{base}/{r['name']}").type == pafs.FileType.NotFound:
                    files.move(f"{base}/{r['temporary']}", f"{base}/{r['name']}")
            yield batch

    return run


def write(pages: DataFrame, root: str, max_bytes: int = MAX_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """Write ``pages`` (page_id, url, html) under ``root`` and return the
    manifest, which is kept at ``root``/manifest."""
    spark = pages.sparkSession
    root = qualified(spark, root)
    p = pick(pages, "page_id", "url", "html").select(
        F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
        F.coalesce(F.col("html").cast("string").cast("binary"), F.lit(b"")).alias("html"),
    )
    key = p.select("page_id", F.octet_length("html").cast("long").alias("n"), F.sha1("html").alias("sha"))
    total = key.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    shards = int(max(1, -(-total // shard_bytes), min(-(-total // (1 << 20)), spark.sparkContext.defaultParallelism)))
    bounds = _bounds(p, shards)

    @F.pandas_udf("long")
    def shard(ids):
        at = np.searchsorted(bounds, ids.fillna(-(1 << 63)).astype("int64").to_numpy(), side="right")
        return __import__("pandas").Series(at)

    # One row a payload that stands for others, then a row a page that
    # revisits it; all on digests.
    same = key.filter(F.col("n") >= MIN_REVISIT).groupBy("sha").agg(F.max("page_id").alias("first"), F.count("*").alias("c")).filter("c > 1 AND first IS NOT NULL")
    revisit = key.filter(F.col("n") >= MIN_REVISIT).join(same, "sha").select("page_id", "sha", "first").distinct()
    rows = p.select("page_id", F.lit(1).alias("kind"), "url", "html", F.lit(None).cast("string").alias("sha"), F.lit(None).cast("long").alias("target"))
    rows = rows.unionByName(revisit.select("page_id", F.lit(0).alias("kind"), F.lit(None).cast("string").alias("url"), F.lit(None).cast("binary").alias("html"), "sha", F.col("first").alias("target")))
    rows = rows.select(shard(F.col("page_id")).alias("shard"), "*")
    rows = rows.repartitionById(len(bounds) + 1, F.col("shard").cast("int"))
    rows = rows.sortWithinPartitions("shard", "page_id", "kind", "url", F.sha1("html"))
    rows = rows.select("shard", "page_id", "kind", "url", "html", "sha", "target")
    files, base = _files(root)
    files.create_dir(f"{base}/_temporary", recursive=True)
    rows.mapInArrow(_write(root, max_bytes), _MANIFEST).write.parquet(f"{root}/_reports")
    reports = spark.read.schema(_MANIFEST).parquet(f"{root}/_reports")
    reports.mapInArrow(_commit(root), _MANIFEST).write.parquet(f"{root}/manifest")
    return spark.read.schema(_MANIFEST).parquet(f"{root}/manifest")


def _members(stream, chunk: int = 1 << 20) -> Iterator[bytes]:
    """The gzip members of an archive, one record each."""
    data, z, out = b"", zlib.decompressobj(31), []
    while True:
        if not data:
            data = stream.read(chunk)
            if not data:
                if out:
                    raise EOFError("the archive ends inside a record")
                return
        out.append(z.decompress(data))
        data = z.unused_data if z.eof else b""
        if z.eof:
            yield b"".join(out)
            z, out = zlib.decompressobj(31), []


def parse(raw: bytes) -> dict:
    head, _, rest = raw.partition(b"\r\n\r\n")
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    block = rest[: int(fields["Content-Length"])]
    if rest[len(block) :] != b"\r\n\r\n" or base64.b32encode(hashlib.sha1(block).digest()).decode() != fields["WARC-Block-Digest"][5:]:
        raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
    http, _, payload = block.partition(b"\r\n\r\n")
    fields["payload"] = payload
    fields["length"] = int(http.split(b"Content-Length: ")[1].split(b"\r\n")[0])
    return fields


def _read(root: str):
    def page(urn: str | None):
        text = None if urn is None else urn[len("<urn:x-page:") : -1].split(":")[0]
        return None if text in (None, "none") else int(text)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files, base = _files(root)
        schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()), ("record_type", pa.string()), ("refers_to", pa.int64())])
        for batch in batches:
            for name, records in zip(batch.column("name").to_pylist(), batch.column("records").to_pylist()):
                rows, n = [], 0
                with files.open_input_stream(f"{base}/{name}", compression=None) as stream:
                    for raw in _members(stream):
                        f = parse(raw)
                        sha = base64.b32decode(f["WARC-Payload-Digest"][5:]).hex()
                        if f["WARC-Type"] == "response" and (hashlib.sha1(f["payload"]).hexdigest() != sha or len(f["payload"]) != f["length"]):
                            raise ValueError(f"wrong payload in {f['WARC-Record-ID']}")
                        rows.append((page(f["WARC-Record-ID"]), f["length"], sha, f["WARC-Type"], page(f.get("WARC-Refers-To"))))
                        n += 1
                        if len(rows) == 4096:
                            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)
                            rows = []
                if n != records:
                    raise ValueError(f"{name} holds {n} records, its manifest says {records}")
                if rows:
                    yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), schema.types)], schema=schema)

    return run


def read(manifest: DataFrame, root: str) -> DataFrame:
    """Every record of the archives in the manifest, checked on the way:
    page_id, payload_bytes, payload_digest, record_type, refers_to."""
    n = max(1, manifest.count())
    root = qualified(manifest.sparkSession, root)
    return manifest.select("name", "records").repartition(min(n, 10_000)).mapInArrow(_read(root), PAGE)


def round_trip(pages: DataFrame, root: str) -> DataFrame:
    """The query: archives are written, then read back."""
    return read(write(pages, root), root)


ORACLE = """
WITH p AS (SELECT page_id, CAST(octet_length(encode(coalesce(html, ''))) AS BIGINT) AS n, sha1(coalesce(html, '')) AS d FROM pages),
g AS (SELECT d, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest, CASE WHEN first <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM p LEFT JOIN g USING (d)
"""
