"""Incremental runners on Structured Streaming.

Every runner uses ``trigger(availableNow=True)``: process what has landed,
then stop (a daily job calls it again). The checkpoint remembers which
files and offsets were done, so a rerun adds nothing and a lost executor
only replays its micro-batch.

Stateful group-bys without a watermark are avoided: the long tables are
appended statelessly, the wide step runs per micro-batch inside
``foreachBatch`` (an entry's rows never span two batches, because the step
reads whole bronze rows), and change application is merge-on-read over an
append-only change log.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators import changes as ch
from ..operators import explode as ex
from ..operators import pivot as pv
from ..operators import quality as q
from ..operators import summaries as sm
from ..functions.variant import col_of
from ..session import claim, folder_names, path_exists, publish, scratch_path, session_settings, variant_shredding
from ..sources import documents as docs


def run_stream(
    df: DataFrame,
    path: str,
    checkpoint: str,
    fmt: str = "parquet",
    partition_by: list[str] | None = None,
    output_mode: str = "append",
    wait: bool = True,
) -> StreamingQuery:
    """Append a streaming DataFrame to ``path`` until the available input is
    processed."""
    w = df.writeStream.format(fmt).outputMode(output_mode).option("checkpointLocation", checkpoint).trigger(availableNow=True)
    if partition_by:
        w = w.partitionBy(*partition_by)
    query = w.start(path)
    if wait:
        query.awaitTermination()
    return query


def run_batches(df: DataFrame, fn, checkpoint: str, wait: bool = True) -> StreamingQuery:
    """Run ``fn(batch_df, batch_id)`` per micro-batch until input is drained."""
    query = df.writeStream.foreachBatch(fn).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    if wait:
        query.awaitTermination()
    return query


def stream_table(spark: SparkSession, path: str, max_files: int | None = None, merge_schema: bool = False) -> DataFrame:
    """Stream a parquet table written by an earlier step (schema taken from
    the table itself), optionally at most ``max_files`` files per batch. With
    ``merge_schema`` the columns of all its files count, not of one."""
    schema = spark.read.option("mergeSchema", str(merge_schema).lower()).parquet(path).schema
    r = spark.readStream.schema(schema)
    if max_files is not None:
        r = r.option("maxFilesPerTrigger", str(int(max_files)))
    return r.parquet(path)


def ingest_documents(
    spark: SparkSession,
    source: str,
    bronze_path: str,
    checkpoint: str,
    datasource: str | None = None,
    max_files: int | None = docs.DEFAULT_MAX_FILES,
    max_bytes: str | int | None = None,
    whole_text: bool = True,
    skip_rows: int = 0,
    options: dict | None = None,
    id_mode: str = "content",
    on_error: str = "fail",
    shred: bool = True,
    sub_folder: str = "",
    rejects_path: str | None = None,
) -> StreamingQuery:
    """New files under ``source`` (plus an optional ``sub_folder``) -> bronze
    parquet at ``bronze_path``; ``datasource`` defaults to that folder with a
    trailing slash. With ``shred`` the VARIANT column is written shredded, so
    later path reads (id, timestamp, Meta, entry) are pushed into the scan
    as typed columns.

    With ``rejects_path`` malformed documents do not stop the run: a batch's
    good rows go to ``bronze_path/batch_id=N`` and its rejected ones, with path
    and text, to ``rejects_path/batch_id=N``. The batch is parsed once, into
    the shared scratch folder; each folder is published whole, and a replayed
    batch leaves what is there (see :func:`~sheaf.session.publish`)."""
    folder = docs.source_path(source, sub_folder)
    raw = docs.stream_documents(spark, folder, max_files=max_files, max_bytes=max_bytes, whole_text=whole_text, skip_rows=skip_rows, options=options)
    bronze = docs.to_bronze(raw, datasource or folder, id_mode=id_mode, on_error="quarantine" if rejects_path else on_error)
    # first lines are counted in a file's first block: that keeps its size
    splits = None if skip_rows > 0 else docs.small_splits(spark)
    if rejects_path is None:
        with variant_shredding(spark, enabled=shred or None), session_settings(spark, splits):
            return run_stream(bronze, bronze_path, checkpoint)

    def step(batch: DataFrame, batch_id: int) -> None:
        claim(spark, bronze_path, checkpoint)
        sinks = [f"{p.rstrip('/')}/batch_id={batch_id}" for p in (bronze_path, rejects_path)]
        if all(path_exists(spark, p) for p in sinks):
            return
        parsed = scratch_path(spark, "ingest")
        with variant_shredding(spark, enabled=shred or None):
            batch.write.parquet(parsed)
            for rows, sink in zip(docs.split_rejects(spark.read.schema(batch.schema).parquet(parsed)), sinks):
                publish(rows, sink)

    with session_settings(spark, splits):
        return run_batches(bronze, step, checkpoint)


def read_sink(spark: SparkSession, path: str, schema) -> DataFrame:
    """Batch read of a stream's output with its known schema, so a table
    that has received no rows yet reads as empty instead of failing
    schema inference."""
    return spark.read.schema(schema).parquet(path)


def explode_stream(spark: SparkSession, bronze_path: str, fields_path: str, header_path: str, checkpoint: str) -> tuple[DataFrame, DataFrame]:
    """Bronze -> long fields table and long header table, appended.
    The fields table is partitioned by resource type so per-type reads
    prune whole folders. Returns batch readers of the two tables."""
    fields = ex.explode_fields(stream_table(spark, bronze_path))
    header = ex.explode_header(stream_table(spark, bronze_path))
    # Writing by type sorts a task's long rows, which are many times what it
    # reads: small splits. The two streams are independent: run them side by side
    with session_settings(spark, docs.small_splits(spark)):
        queries = [
            run_stream(fields, fields_path, f"{checkpoint}/fields", partition_by=["resourceType"], wait=False),
            run_stream(header, header_path, f"{checkpoint}/header", wait=False),
        ]
        for query in queries:
            query.awaitTermination()
    return read_sink(spark, fields_path, fields.schema), read_sink(spark, header_path, header.schema)


def pivot_stream(spark: SparkSession, bronze_path: str, resource_type: str, keys: list[str], stage_path: str, checkpoint: str) -> StreamingQuery:
    """Wide stage rows of one type, computed per micro-batch from whole
    bronze rows and appended; batch id kept for ordering and idempotence
    (a replayed batch finds its folder there)."""

    def step(batch: DataFrame, batch_id: int) -> None:
        entries = ex.explode_entries(batch, url_check=True)
        wide = pv.pivot_resource(None, resource_type, keys, entries=entries)
        publish(wide, f"{stage_path.rstrip('/')}/batch_id={batch_id}")

    with session_settings(spark, docs.small_splits(spark)):
        return run_batches(stream_table(spark, bronze_path), step, checkpoint)


class ChangeLog:
    """Append-only change log with merge-on-read.

    Each micro-batch lands in ``<path>/log/batch_id=N``, whole and once (see
    :func:`publish`; a replayed batch adds nothing). The batch id is the version,
    so a log is fed by one stream with one checkpoint; another checkpoint would
    number its batches from 0 again, and raises (:func:`claim`). The current state is
    :func:`apply_changes` over the whole log with the batch id as the last
    tie-break; :meth:`compact` writes it as a snapshot that later reads start
    from.
    """

    def __init__(self, spark: SparkSession, path: str, keys, sequence_by, tie_break=None):
        self.spark = spark
        self.path = path.rstrip("/")
        self.keys = ch._as_list(keys)
        self.sequence_by = ch._as_list(sequence_by)
        self.tie_break = ch._as_list(tie_break)

    def append(self, batch: DataFrame, batch_id: int) -> bool:
        """Whether the batch was added (False: it is there already)."""
        return publish(batch, f"{self.path}/log/batch_id={batch_id}")

    def _snapshot(self) -> tuple[int, str] | None:
        """(last batch folded in, path) of the newest snapshot, if any."""
        # snapshots are published whole, so a folder that is there is complete
        found = [int(n.removeprefix("upto=")) for n in folder_names(self.spark, f"{self.path}/snapshot") if n.startswith("upto=")]
        return (max(found), f"{self.path}/snapshot/upto={max(found)}") if found else None

    def _log(self) -> DataFrame:
        # batches may carry different columns (a key first seen later):
        # merge the file schemas, older rows read NULL for new columns
        return self.spark.read.option("mergeSchema", "true").parquet(f"{self.path}/log")

    def changes(self) -> DataFrame:
        """Change rows not yet folded into a snapshot, plus the snapshot's
        rows (the latest change per key, tombstones included)."""
        log = self._log()
        snap = self._snapshot()
        if snap is None:
            return log
        upto, path = snap
        return self.spark.read.parquet(path).unionByName(log.filter(F.col("batch_id") > upto), allowMissingColumns=True)

    def current(self, **options) -> DataFrame:
        # a snapshot keeps the latest row per key: enough for latest-value
        # reads only. The log itself is never cut, so the others read it.
        whole = options.get("scd", 1) == 2 or options.get("truncate_when") is not None or options.get("ignore_null_updates")
        log = self._log() if whole else self.changes()
        return ch.apply_changes(
            log, self.keys, self.sequence_by, tie_break=self.tie_break + ["batch_id"],
            except_columns=list(options.pop("except_columns", []) or []) + ["batch_id"], **options
        )

    def state_at(self, version: int, only: DataFrame | None = None, **options) -> DataFrame:
        """The table as of micro-batch ``version`` (changes of batches up to
        and including it), read from the raw log; ``only`` those keys."""
        log = self._log().filter(F.col("batch_id") <= version)
        if only is not None:
            key = F.struct(*[col_of(k) for k in self.keys])  # equal where the parts are, NULL parts included
            log = log.withColumn("_key", key).join(only.select(key.alias("_key")), "_key", "left_semi").drop("_key")
        return ch.apply_changes(
            log, self.keys, self.sequence_by, tie_break=self.tie_break + ["batch_id"],
            except_columns=list(options.pop("except_columns", []) or []) + ["batch_id"], **options
        )

    def feed(self, from_version: int, to_version: int, **options) -> DataFrame:
        """Row-level changes between two versions of the table (insert,
        delete, update pre/post image), stamped with ``to_version``. Only keys
        that occur in the batches between the versions can differ, so both
        states are built for those keys alone: the log is reduced by them
        before anything is aggregated. A truncate reaches every key, so with
        ``truncate_when`` both states are whole."""
        only = None
        if options.get("truncate_when") is None:
            delta = self._log().filter((F.col("batch_id") > from_version) & (F.col("batch_id") <= to_version))
            only = delta.select(*[col_of(k) for k in self.keys]).distinct()
        return ch.change_feed(
            self.state_at(from_version, only, **dict(options)), self.state_at(to_version, only, **dict(options)), self.keys, version=to_version
        )

    def compact(self) -> int:
        """Fold the log into a snapshot holding the latest change row per key
        (one ``max_by`` aggregation; deletes stay as rows so that older
        changes arriving later are still overridden). Later reads start from
        it; history, truncating and NULL-keeping reads go on reading the log."""
        log = self.changes()
        upto = log.agg(F.max("batch_id")).first()[0]
        if upto is None:
            return -1
        seq = F.struct(*[col_of(c) for c in self.sequence_by + self.tie_break + ["batch_id"]])
        cols = [c for c in log.columns if c not in self.keys]
        latest = log.groupBy(*[col_of(k) for k in self.keys]).agg(F.max_by(F.struct(*[col_of(c) for c in cols]), seq).alias("_r"))
        latest = latest.select(*[col_of(k) for k in self.keys], *[F.col("_r")[c].alias(c) for c in cols])
        publish(latest, f"{self.path}/snapshot/upto={upto}")
        return upto

    def stream_into(self, changes_stream: DataFrame, checkpoint: str, compact_every: int | None = None) -> StreamingQuery:
        """Append every micro-batch of ``changes_stream``; with
        ``compact_every`` the log is folded into a snapshot after every
        N-th batch, so reads stay proportional to the live keys plus the
        recent batches."""

        def step(batch: DataFrame, batch_id: int) -> None:
            claim(self.spark, self.path, checkpoint)
            self.append(batch, batch_id)
            if compact_every and (batch_id + 1) % compact_every == 0:
                self.compact()

        return run_batches(changes_stream, step, checkpoint)


def stream_changes(spark: SparkSession, log_path: str) -> DataFrame:
    """Stream the rows of a change log as they are appended (the change
    feed of a table kept by :class:`ChangeLog`), each batch once, with the
    columns of every batch that is there when the stream starts (NULL where a
    batch has none)."""
    return stream_table(spark, f"{log_path.rstrip('/')}/log", merge_schema=True)


def follow_changes(spark: SparkSession, log_path: str, out_path: str, checkpoint: str) -> StreamingQuery:
    """Copy the change feed of a log to ``out_path``, batch by batch, each
    whole and once. A stream's columns are fixed when it starts; a column that
    the log got since then raises before the batch is taken, and the next
    start has it, so it is not lost."""
    changes = stream_changes(spark, log_path)

    def step(batch: DataFrame, batch_id: int) -> None:
        now = spark.read.option("mergeSchema", "true").parquet(f"{log_path.rstrip('/')}/log").columns
        new = sorted(set(now) - set(changes.columns))
        if new:
            raise RuntimeError(f"{log_path} has columns that this stream began without: {', '.join(new)}; start it again")
        publish(batch, f"{out_path.rstrip('/')}/feed={batch_id}")

    return run_batches(changes, step, checkpoint)


def landing_writer(df: DataFrame, folder: str, column: str = "value") -> None:
    """Write a text column as files (one JSON document per line) into a
    landing folder, as an upstream system would."""
    df.select(F.col(column).alias("value")).write.mode("append").text(folder)


def key_columns(spark: SparkSession, table_root: str, before: int | None = None) -> dict[str, str]:
    """The key -> column mapping of an incremental table: a key keeps the
    column it got in the batch that first had it. ``before`` leaves out later
    batches, so a replayed batch sees what it saw at first."""
    path = f"{table_root.rstrip('/')}/columns"
    if not path_exists(spark, path):
        return {}
    rows = spark.read.schema("`key` STRING, `column` STRING, batch_id BIGINT").parquet(path)
    if before is not None:
        rows = rows.filter(F.col("batch_id") < before)
    # bounded by the distinct keys, not by the data
    return {r["key"]: r["column"] for r in rows.orderBy("batch_id", "column").collect()}


def _named(spark: SparkSession, table_root: str, keys: list[str], reserved: list[str], batch_id: int) -> dict[str, str]:
    """Columns of a batch's keys; those of new keys are added to the mapping."""
    known = key_columns(spark, table_root, before=batch_id)
    names = pv.column_names(keys, reserved, known)
    new = [(k, c) for k, c in names.items() if k not in known]
    if new:
        rows = spark.createDataFrame(new, "`key` STRING, `column` STRING").coalesce(1)
        publish(rows, f"{table_root.rstrip('/')}/columns/batch_id={batch_id}")
    return names


#: expectations on header rows: a row that fails one is dropped and counted
HEADER_RULES = {"valid_bundleUUID": "bundleUUID IS NOT NULL"}


def _silver_rules(resource_type: str) -> dict[str, str]:
    url = f"{resource_type}_uuid".replace("`", "``")
    return {"valid_bundleUUID": "bundleUUID IS NOT NULL", f"valid_{resource_type}_uuid": f"`{url}` IS NOT NULL"}


def _checked_append(log: "ChangeLog", rows: DataFrame, batch_id: int, rules: dict[str, str]) -> None:
    """Append the rows that meet the rules; how many met and failed each is
    kept beside the log, once for each batch (:func:`expectation_table`)."""
    counts = f"{log.path}/counts/batch_id={batch_id}"
    seen = Observation(f"rows_{uuid.uuid4().hex[:8]}")
    kept, failed = q.expect(rows.observe(seen, F.count(F.lit(1)).alias("n")), drop=rules)
    if log.append(kept, batch_id):
        n, by = seen.get["n"], failed.get
        found = log.spark.createDataFrame([(r, n - by[f"{r}_failed"], by[f"{r}_failed"]) for r in rules], "expectation STRING, passed BIGINT, failed BIGINT")
    elif path_exists(log.spark, counts):
        return
    else:  # the run ended between the two: count again
        found = q.expectation_counts(rows, rules)
    publish(found.coalesce(1), counts)


def expectation_table(spark: SparkSession, table_root: str) -> DataFrame:
    """expectation, passed, failed and batch_id of an incremental table."""
    return spark.read.schema("expectation STRING, passed BIGINT, failed BIGINT, batch_id BIGINT").parquet(f"{table_root.rstrip('/')}/counts")


def silver_stream(
    spark: SparkSession,
    bronze_path: str,
    silver_root: str,
    checkpoint: str,
    types: list[str] | None = None,
    max_files: int | None = None,
    compact_every: int | None = None,
) -> StreamingQuery:
    """Incremental silver: each micro-batch of new bronze rows is exploded
    once; per resource type its wide rows (keys discovered from the batch)
    are appended to ``silver_root/<type>/log/batch_id=N``, their columns named
    by the type's one mapping (:func:`key_columns`). Read a table with
    :func:`silver_table`. Work per run grows with the new data only."""

    def step(batch: DataFrame, batch_id: int) -> None:
        entries = ex.explode_entries(batch, url_check=True).persist()
        try:
            # one small collect: the types of this batch and their key lists
            # (bounded by the distinct types and keys, not by the data)
            keys = (
                ex.entry_fields(entries)
                .filter(F.col("resourceType").isNotNull())
                .groupBy("resourceType")
                .agg(F.sort_array(F.collect_set("key")).alias("keys"))
                .collect()
            )
            found = {r.resourceType: [k for k in r["keys"] if k != "resourceType"] for r in keys}
            for t in sorted(found):
                if types is not None and t not in types:
                    continue
                log = _silver_log(spark, silver_root, t)
                claim(spark, log.path, checkpoint)
                names = _named(spark, log.path, found[t], [*pv.RESOURCE_GROUP, f"{t}_uuid"], batch_id)
                _checked_append(log, pv.pivot_resource(None, t, found[t], entries=entries, names=names), batch_id, _silver_rules(t))
                if compact_every and (batch_id + 1) % compact_every == 0:
                    log.compact()
        finally:
            entries.unpersist()

    with session_settings(spark, docs.small_splits(spark)):
        return run_batches(stream_table(spark, bronze_path, max_files=max_files), step, checkpoint)


def header_stream(spark: SparkSession, bronze_path: str, silver_path: str, checkpoint: str, max_files: int | None = None) -> StreamingQuery:
    """Incremental header silver: the wide header rows of each micro-batch
    (keys discovered from the batch, one mapping for the table) are appended
    to ``silver_path/log/batch_id=N``. Read it with :func:`header_table`."""

    def step(batch: DataFrame, batch_id: int) -> None:
        found = sm.discover_header_keys(ex.explode_header(batch))
        log = _header_log(spark, silver_path)
        claim(spark, log.path, checkpoint)
        names = _named(spark, log.path, found, pv.HEADER_GROUP, batch_id)
        _checked_append(log, pv.pivot_header(None, found, method="project", bronze=batch, only_with_keys=True, names=names), batch_id, HEADER_RULES)

    with session_settings(spark, docs.small_splits(spark)):
        return run_batches(stream_table(spark, bronze_path, max_files=max_files), step, checkpoint)


def _header_log(spark: SparkSession, silver_path: str) -> "ChangeLog":
    return ChangeLog(spark, silver_path, keys=["bundleUUID"], sequence_by="bundle_timestamp")


def header_table(spark: SparkSession, silver_path: str) -> DataFrame:
    """Current header silver rows: latest per document over the appended
    rows, NULL keys dropped."""
    log = _header_log(spark, silver_path)
    changes, _ = q.expect(log.changes(), drop=HEADER_RULES)
    return ch.apply_changes(changes, log.keys, log.sequence_by, tie_break=["batch_id"], except_columns=["batch_id"])


def _silver_log(spark: SparkSession, silver_root: str, resource_type: str) -> "ChangeLog":
    url_col = f"{resource_type}_uuid"
    return ChangeLog(spark, f"{silver_root.rstrip('/')}/{resource_type}", keys=["bundleUUID", url_col], sequence_by="bundle_timestamp")


def silver_table(spark: SparkSession, silver_root: str, resource_type: str) -> DataFrame:
    """Current silver rows of one type: latest per (document, entry url) over
    the appended stage rows, NULL keys dropped, sequence column hidden."""
    log = _silver_log(spark, silver_root, resource_type)
    changes, _ = q.expect(log.changes(), drop=_silver_rules(resource_type))
    return ch.apply_changes(
        changes, log.keys, log.sequence_by, tie_break=["batch_id"], except_columns=["bundle_timestamp", "batch_id"]
    )
