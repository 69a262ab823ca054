"""Document sources: whole-file and line-mode readers (batch and stream),
the bronze layout, the landing-folder inventory and small document peeks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.variant import content_id, field, parse_document, random_id

RAW_SCHEMA = "value STRING"

# Defaults of the admission limits per micro-batch.
DEFAULT_MAX_FILES = 1000
DEFAULT_MAX_BYTES = "10g"

_SIZE = re.compile(r"^\s*(\d+(?:\.\d+)?)\s*([kmgtp]?)(i?b)?\s*$", re.IGNORECASE)
_UNITS = {"": 1, "k": 1024, "m": 1024**2, "g": 1024**3, "t": 1024**4, "p": 1024**5}


def parse_size(size: str | int | None) -> int | None:
    """'10g' -> 10737418240. Plain integers pass through."""
    if size is None or isinstance(size, int):
        return size
    m = _SIZE.match(str(size))
    if not m:
        raise ValueError(f"not a size: {size!r}")
    return int(float(m.group(1)) * _UNITS[m.group(2).lower()])


#: a task that explodes documents reads so many bytes of files at most: what
#: it holds in memory is a multiple of what it reads
SPLIT_BYTES = 16 * 1024**2


def small_splits(spark: SparkSession) -> dict[str, str]:
    """Session settings under which a task reads :data:`SPLIT_BYTES` of files
    at most, or the session's own limit if that is smaller."""
    key = "spark.sql.files.maxPartitionBytes"
    return {key: str(min(parse_size(spark.conf.get(key)), SPLIT_BYTES))}


def source_path(root: str, sub_folder: str = "") -> str:
    """Root folder plus optional sub-folder, always with a trailing slash."""
    root = root.rstrip("/")
    return f"{root}/" if not sub_folder else f"{root}/{sub_folder.strip('/')}/"


def _reader(r, whole_text: bool, options: dict | None):
    r = r.format("text").option("wholetext", str(bool(whole_text)).lower())
    if options:
        r = r.options(**options)
    return r


_LINE_END = r"(?:\r\n|\n|\r)"


def _without_first_lines(n: int):
    """Leave out the first ``n`` rows of each file, task by task: a file's
    blocks go to different tasks, rows of a block come in order, and only the
    block at the file's start holds lines to leave out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: dict[str, int] = {}  # lines of the first block so far, by file of this task
        whole: dict[str, bool] = {}
        for batch in batches:
            first = np.asarray(batch.column("file_block_start")) == 0
            if first.any():
                keep = np.ones(batch.num_rows, dtype=bool)
                files = batch.column("file_path").dictionary_encode()
                of = np.asarray(files.indices)
                for k in np.unique(of[first]):
                    name, rows = files.dictionary[int(k)].as_py(), np.flatnonzero(first & (of == k))
                    keep[rows[: max(0, n - seen.get(name, 0))]] = False
                    seen[name] = seen.get(name, 0) + len(rows)
                    whole[name] = batch.column("file_block_length")[int(rows[0])].as_py() == batch.column("file_size")[int(rows[0])].as_py()
                batch = batch.filter(pa.array(keep))
            yield batch
        for name, lines in seen.items():
            if lines < n and not whole[name]:
                raise ValueError(f"the first {n} lines of {name} are longer than a block; read larger blocks (spark.sql.files.maxPartitionBytes)")

    return run


def _skip_lines(df: DataFrame, skip_rows: int, whole_text: bool) -> DataFrame:
    """Drop the first ``skip_rows`` lines of each file; the text source has no
    such option. From whole texts they are cut off; lines, which are read in
    blocks by several tasks, are counted as they pass (no shuffle; batch and
    streams). Lines end as they do for the text source: at ``\\n``, ``\\r\\n``
    or ``\\r``, and a line end at the end of the file starts no further line."""
    if skip_rows <= 0:
        return df
    if whole_text:
        return df.withColumn("value", F.regexp_replace("value", r"\A(?:[^\r\n]*+(?:%s|\z)){0,%d}+" % (_LINE_END, skip_rows), ""))
    return df.mapInArrow(_without_first_lines(skip_rows), df.schema)


def with_file_columns(df: DataFrame) -> DataFrame:
    """Expose the hidden file metadata of a file source as plain columns."""
    return df.select(
        "value",
        F.col("_metadata.file_path").alias("file_path"),
        F.col("_metadata.file_name").alias("file_name"),
        F.col("_metadata.file_size").alias("file_size"),
        F.col("_metadata.file_block_start").alias("file_block_start"),
        F.col("_metadata.file_block_length").alias("file_block_length"),
        F.col("_metadata.file_modification_time").alias("file_modification_time"),
    )


def read_documents(spark: SparkSession, path: str, whole_text: bool = True, skip_rows: int = 0, options: dict | None = None) -> DataFrame:
    """Batch twin of :func:`stream_documents`. A zero-length file yields no
    row (Spark's file sources skip empty files), so it never reaches
    parsing."""
    df = _reader(spark.read, whole_text, options).schema(RAW_SCHEMA).load(path)
    return _skip_lines(with_file_columns(df), skip_rows, whole_text)


def stream_documents(
    spark: SparkSession,
    path: str,
    max_files: int | None = DEFAULT_MAX_FILES,
    max_bytes: str | int | None = None,
    whole_text: bool = False,
    skip_rows: int = 0,
    options: dict | None = None,
) -> DataFrame:
    """Incremental file stream: every new file under ``path`` is read once
    (the query's checkpoint remembers seen files).

    Admission per micro-batch: the file source accepts one limit, so bytes
    win when given (suffixes like '20g' are parsed), else files.
    """
    r = spark.readStream
    if max_bytes is not None:
        r = r.option("maxBytesPerTrigger", str(parse_size(max_bytes)))
    elif max_files is not None:
        r = r.option("maxFilesPerTrigger", str(int(max_files)))
    df = _reader(r, whole_text, options).schema(RAW_SCHEMA).load(path)
    return _skip_lines(with_file_columns(df), skip_rows, whole_text)


def file_metadata(df: DataFrame) -> Column:
    """The file-metadata struct carried through every layer."""
    return F.struct(
        F.col("file_path"),
        F.col("file_name"),
        F.col("file_size"),
        F.col("file_block_start"),
        F.col("file_block_length"),
        F.col("file_modification_time"),
    )


def to_bronze(raw: DataFrame, datasource: str, id_mode: str = "random", on_error: str = "fail") -> DataFrame:
    """Raw documents -> bronze layout:
    fullFilePath, datasource, inputFileName, ingestTime, ingestDate,
    resource (VARIANT), fileMetadata, bundleUUID.

    ``id_mode='random'`` gives a fresh uuid per row; ``'content'`` hashes
    file path and modification time so a replay yields the same id.
    ``on_error='fail'`` raises on malformed JSON; ``'quarantine'`` keeps the
    row with a NULL resource and ``_reject_text`` set (see :func:`split_rejects`).
    """
    if id_mode not in ("random", "content"):
        raise ValueError("id_mode must be 'random' or 'content'")
    if on_error not in ("fail", "quarantine"):
        raise ValueError("on_error must be 'fail' or 'quarantine'")
    strict = on_error == "fail"
    now = F.current_timestamp()
    bundle_id = random_id() if id_mode == "random" else content_id("file_path", "file_modification_time", "value")
    cols = [
        F.col("file_path").alias("fullFilePath"),
        F.lit(datasource).alias("datasource"),
        F.col("file_name").alias("inputFileName"),
        now.alias("ingestTime"),
        now.cast("date").alias("ingestDate"),
        parse_document("value", strict).alias("resource"),
        file_metadata(raw).alias("fileMetadata"),
        bundle_id.alias("bundleUUID"),
    ]
    if not strict:
        cols.append(F.when(F.try_parse_json("value").isNull(), F.col("value")).alias("_reject_text"))
    return raw.select(*cols)


def split_rejects(bronze: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(good rows, rejected rows with path and text) of a quarantine-mode bronze."""
    good = bronze.filter(F.col("_reject_text").isNull()).drop("_reject_text")
    rejects = bronze.filter(F.col("_reject_text").isNotNull()).select(
        "fullFilePath", "inputFileName", "ingestTime", F.col("_reject_text").alias("text")
    )
    return good, rejects


def require_type(bronze: DataFrame, type_name: str = "Bundle") -> DataFrame:
    """Keep documents whose top-level resourceType matches, ignoring case."""
    t = field("resource", "$.resourceType", "string", lenient=True)
    return bronze.filter(F.upper(t) == type_name.upper())


def find_document(bronze: DataFrame, document_id: str) -> DataFrame:
    """Documents whose own ``id`` equals the given text."""
    return bronze.filter(field("resource", "$.id", "string", lenient=True) == document_id)


def sample_documents(bronze: DataFrame, n: int = 10) -> DataFrame:
    """First ``n`` documents by document id: a deterministic peek (top-k, so
    the planner keeps n rows per partition, never a full sort)."""
    bid = field("resource", "$.id", "string", lenient=True)
    return bronze.withColumn("bundle_id", bid).orderBy("bundle_id", "bundleUUID").limit(n)


def landing_inventory(spark: SparkSession, path: str) -> DataFrame:
    """What landed in a source folder: files and bytes per sub-folder and day
    of modification. Reads only file status, not contents."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path).select(
        "path", "modificationTime", "length"
    )
    folder = F.regexp_extract("path", r"^(.*)/[^/]*$", 1)
    return files.groupBy(folder.alias("folder"), F.to_date("modificationTime").alias("day")).agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes")
    )
