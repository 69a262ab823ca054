"""A keyed table kept by a stream of change rows: type 1 or type 2, with
every option of :func:`~sheaf.operators.changes.apply_changes`, expectations
and their counts, and a change feed.

The rows a table still needs are laid out in key buckets. A micro-batch reads
and rewrites only the buckets that its keys fall into; the files of the
others stay as they are. What each batch made is one folder, published by
one rename::

    <path>/batches/batch_id=N/accepted   the batch's rows that met the expectations
    <path>/batches/batch_id=N/rows       touched buckets: change rows still needed
    <path>/batches/batch_id=N/table      touched buckets: the result, where it is not the rows
    <path>/batches/batch_id=N/counts     the batch's expectation counts
    <path>/batches/batch_id=N/touched    the numbers of the touched buckets

A bucket's state is in the newest batch that touched it (no folder there: it
is empty). Change rows may come in
any order and any split into batches: the table equals the batch result over
all rows so far. So plain type 1 needs the latest row of a key, deletes
included; type 2 and NULL-keeping updates need every row of a key, since a
late row can split a version. A bucket with a hot key is worked on by all
tasks (the aggregation and the history are skew-safe); it is written in
several files.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType, _parse_datatype_string

from ..functions.variant import col_of
from ..operators import changes as ch
from ..operators import quality as q
from ..session import _hadoop, claim, folder_names, path_exists, pending_path, publish_folder, session_settings

BUCKETS = 64
BUCKET, BATCH = "_bucket", "_batch"
#: the bucket of truncating rows, which touch every key
TRUNCATES = -1
TOUCHED = "bucket int, batch long"
COUNTS = "batch_id long, expectation string, action string, passed long, failed long"


class Target:
    """See the module. ``warn`` / ``drop`` / ``fail`` are expectations on the
    change rows (name -> SQL predicate, NULL counts as a violation);
    ``columns``, ``except_columns``, ``row_filter`` and ``schema`` shape what
    :meth:`table` returns; ``cluster_by`` sorts the rows of a file;
    ``spark_conf`` holds while a batch is worked on. ``buckets`` is fixed for
    the life of a table."""

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        keys,
        sequence_by,
        scd: int = 1,
        tie_break=None,
        ignore_null_updates: bool = False,
        delete_when: str | None = None,
        truncate_when: str | None = None,
        columns: list[str] | None = None,
        except_columns: list[str] | None = None,
        track: list[str] | None = None,
        track_except: list[str] | None = None,
        warn: dict[str, str] | None = None,
        drop: dict[str, str] | None = None,
        fail: dict[str, str] | None = None,
        row_filter: str | None = None,
        schema: str | None = None,
        cluster_by: list[str] | None = None,
        spark_conf: dict[str, str] | None = None,
        buckets: int = BUCKETS,
    ):
        if scd not in (1, 2):
            raise ValueError("scd must be 1 or 2")
        if scd == 2 and truncate_when is not None:
            raise ValueError("truncate applies to type 1 only")
        names = [*(warn or {}), *(drop or {}), *(fail or {})]
        if len(names) != len(set(names)):
            raise ValueError("an expectation has one action")
        self.spark, self.path = spark, path.rstrip("/")
        self.keys, self.sequence_by, self.tie_break = ch._as_list(keys), ch._as_list(sequence_by), [*ch._as_list(tie_break), BATCH]
        self.scd, self.ignore_nulls, self.delete_when, self.truncate_when = scd, ignore_null_updates, delete_when, truncate_when
        self.columns, self.except_columns = columns, [*(except_columns or []), BATCH, BUCKET]
        self.track, self.track_except = track, [*(track_except or []), BATCH, BUCKET]
        self.warn, self.drop, self.fail = warn or {}, drop or {}, fail or {}
        self.row_filter, self.schema, self.cluster_by = row_filter, schema, cluster_by or []
        self.spark_conf, self.buckets = spark_conf, buckets
        #: the latest row of a key is all that is needed, and is the result
        self.plain = scd == 1 and not ignore_null_updates

    # what is there

    def batches(self) -> list[int]:
        return sorted(int(n.removeprefix("batch_id=")) for n in folder_names(self.spark, f"{self.path}/batches") if n.startswith("batch_id="))

    def _folder(self, batch_id: int) -> str:
        return f"{self.path}/batches/batch_id={batch_id}"

    def bucket_folders(self, part: str = "rows", version: int | None = None) -> dict[int, str]:
        """bucket -> the folder that holds its state as of batch ``version``
        (the newest by default); buckets without rows are left out."""
        use = [b for b in self.batches() if version is None or b <= version]
        if not use:
            return {}
        touched = self.spark.read.schema(TOUCHED).parquet(*[f"{self._folder(b)}/touched" for b in use])
        newest = {r["bucket"]: r["batch"] for r in touched.groupBy("bucket").agg(F.max("batch").alias("batch")).collect()}  # at most one a bucket
        there = {b: set(folder_names(self.spark, f"{self._folder(b)}/{part}")) for b in set(newest.values())}
        return {k: f"{self._folder(b)}/{part}/b={k}" for k, b in newest.items() if f"b={k}" in there[b]}

    def _read(self, folders: list[str]) -> DataFrame | None:
        # each folder is read as a table of its own: the bucket is a column of the files, columns may grow
        return self.spark.read.option("mergeSchema", "true").parquet(*folders) if folders else None

    def _state(self, buckets: list[int] | None, part: str = "rows", version: int | None = None) -> DataFrame | None:
        found = self.bucket_folders(part, version)
        use = [found[b] for b in sorted(found) if buckets is None or b in buckets or b == TRUNCATES]
        return self._read(use)

    # one batch

    def _bucket(self) -> Column:
        own = F.pmod(F.xxhash64(*[col_of(k) for k in self.keys]), F.lit(self.buckets)).cast("int")
        return F.when(ch._predicate(self.truncate_when), F.lit(TRUNCATES)).otherwise(own) if self.truncate_when is not None else own

    def _apply(self, rows: DataFrame, **choice) -> DataFrame:
        return ch.apply_changes(
            rows, self.keys, self.sequence_by, scd=self.scd, tie_break=self.tie_break, ignore_null_updates=self.ignore_nulls,
            delete_when=self.delete_when, truncate_when=self.truncate_when, track=self.track, track_except=self.track_except, **choice,
        )

    def _needed(self, rows: DataFrame) -> DataFrame:
        """The change rows that any later batch can still need."""
        values = [c for c in rows.columns if c not in self.keys]
        keys, _, live = ch._prepare(rows, self.keys, self.sequence_by, self.tie_break, None, self.truncate_when)
        if self.plain:
            last = live.groupBy(*[col_of(k) for k in keys]).agg(F.max_by(F.struct(*[col_of(c) for c in values]), F.col(ch.SEQ)).alias("_last"))
            live = last.select(*[col_of(k) for k in keys], *[F.col("_last")[c].alias(c) for c in values])
        live = live.select(*[col_of(c) for c in rows.columns])
        if self.truncate_when is None:
            return live
        cut = ch._prepare(rows, self.keys, self.sequence_by, self.tie_break, None, None)[2].filter(F.col(BUCKET) == TRUNCATES)
        cut = cut.agg(F.max_by(F.struct(*[col_of(c) for c in rows.columns]), F.col(ch.SEQ)).alias("_last")).filter("_last IS NOT NULL")
        return live.unionByName(cut.select(*[F.col("_last")[c].alias(c) for c in rows.columns]))

    def _write(self, df: DataFrame, path: str) -> None:
        """Files by bucket: small buckets share a task, a large one is split."""
        df = df.withColumn("b", F.col(BUCKET)).hint("rebalance", "b")
        if self.cluster_by:
            df = df.sortWithinPartitions("b", *[col_of(c) for c in self.cluster_by])
        df.write.partitionBy("b").parquet(path)

    def apply(self, batch: DataFrame, batch_id: int) -> bool:
        """Work one micro-batch in, whole and once; a batch that is there is
        left as it is (False). A failed expectation raises and publishes
        nothing."""
        clash = {BUCKET, BATCH, "b"} & set(batch.columns)
        if clash:
            raise ValueError(f"change rows have reserved columns: {sorted(clash)}")
        if path_exists(self.spark, self._folder(batch_id)):
            return False
        with session_settings(self.spark, self.spark_conf):
            pending = pending_path(self.spark, self._folder(batch_id))
            seen = Observation(f"rows_{uuid.uuid4().hex[:8]}")
            checked, failed = q.expect(batch.observe(seen, F.count(F.lit(1)).alias("n")), warn=self.warn, drop=self.drop, fail=self.fail)
            accepted = checked.select("*", self._bucket().alias(BUCKET), F.lit(batch_id).cast("long").alias(BATCH))
            accepted.write.parquet(f"{pending}/accepted")  # the one pass over the batch; counts are taken here
            self._count(batch_id, seen.get["n"], failed.get if failed is not None else {}).write.parquet(f"{pending}/counts")
            accepted = self.spark.read.schema(accepted.schema).parquet(f"{pending}/accepted")
            touched = [r[0] for r in accepted.select(BUCKET).distinct().collect()]  # at most one a bucket
            self.spark.createDataFrame([(b, batch_id) for b in touched], TOUCHED).coalesce(1).write.parquet(f"{pending}/touched")
            if touched:
                before = self._state(touched)
                rows = accepted if before is None else before.unionByName(accepted, allowMissingColumns=True)
                self._write(self._needed(rows), f"{pending}/rows")
                if not self.plain:
                    needed = self._read([f"{pending}/rows/{n}" for n in folder_names(self.spark, f"{pending}/rows") if n.startswith("b=")])
                    result = self._apply(needed.filter(F.col(BUCKET) != TRUNCATES) if self.truncate_when is None else needed)
                    result = result.drop(BATCH, BUCKET)
                    self._write(result.withColumn(BUCKET, F.pmod(F.xxhash64(*[col_of(k) for k in self.keys]), F.lit(self.buckets)).cast("int")), f"{pending}/table")
            publish_folder(self.spark, pending, self._folder(batch_id))
        return True

    def _count(self, batch_id: int, n: int, failed: dict) -> DataFrame:
        rows = [(batch_id, name, action, n - failed[f"{name}_failed"], failed[f"{name}_failed"]) for action, rules in (("warn", self.warn), ("drop", self.drop)) for name in rules]
        rows += [(batch_id, name, "fail", n, 0) for name in self.fail]  # else the batch would not be here
        return self.spark.createDataFrame(rows, COUNTS).coalesce(1)

    def stream_into(self, changes: DataFrame, checkpoint: str) -> StreamingQuery:
        """Work in every micro-batch of a stream until it is drained."""
        from .runner import run_batches

        def step(batch: DataFrame, batch_id: int) -> None:
            claim(self.spark, self.path, checkpoint)
            self.apply(batch, batch_id)

        return run_batches(changes, step, checkpoint)

    # what it says

    def _published(self, df: DataFrame) -> DataFrame:
        values = ch._output_columns([c for c in df.columns if c not in (*self.keys, ch.START_AT, ch.END_AT)], self.columns, self.except_columns)
        ends = [c for c in (ch.START_AT, ch.END_AT) if c in df.columns and self.scd == 2]
        df = q.row_filter(df, self.row_filter).select(*[col_of(c) for c in (*self.keys, *values, *ends)])
        if self.schema is not None:
            declared: StructType = _parse_datatype_string(self.schema)
            df = df.select(*[col_of(f.name).cast(f.dataType).alias(f.name) for f in declared.fields])
        return df

    def table(self, version: int | None = None) -> DataFrame:
        """The table as of batch ``version`` (the newest by default)."""
        return self._table(None, version)

    def _table(self, buckets: list[int] | None, version: int | None) -> DataFrame:
        rows = self._state(buckets, "rows", version)
        if rows is None:
            raise ValueError(f"{self.path} has received no rows yet")
        if self.truncate_when is not None:  # rows of untouched buckets may lie before a later truncate
            rows = ch._prepare(rows, self.keys, self.sequence_by, self.tie_break, None, self.truncate_when)[2].select(*[col_of(c) for c in rows.columns])
        if self.plain:  # one row a key: no shuffle
            return self._published(rows.filter(~ch._predicate(self.delete_when)))
        if self.truncate_when is not None:  # a value may stem from a row before the truncate
            return self._published(ch.apply_changes(rows, self.keys, self.sequence_by, tie_break=self.tie_break, ignore_null_updates=True, delete_when=self.delete_when))
        result = self._state(buckets, "table", version)
        return self._published(result if result is not None else self._apply(rows).limit(0))

    def counts(self) -> DataFrame:
        """batch_id, expectation, action, passed and failed rows: one row for
        each batch and expectation, also after a replay."""
        folders = [f"{self._folder(b)}/counts" for b in self.batches()]
        return self.spark.read.schema(COUNTS).parquet(*folders) if folders else self.spark.createDataFrame([], COUNTS)

    def feed(self, version: int) -> DataFrame:
        """Row-level changes that batch ``version`` made to a type 1 table,
        from the buckets that it touched, before and after, and in them from
        its keys alone. A truncate reaches every key, so with
        ``truncate_when`` all buckets are compared."""
        if self.scd != 1:
            raise ValueError("the feed of a type 2 table is the table: its versions are dated")
        touched = [int(n.removeprefix("b=")) for n in folder_names(self.spark, f"{self._folder(version)}/rows") if n.startswith("b=")]
        buckets = touched if self.truncate_when is None else None
        new = self._table(buckets, version)
        earlier = [b for b in self.batches() if b < version]
        old = self._table(buckets, earlier[-1]) if earlier and self._state(buckets, "rows", earlier[-1]) is not None else new.limit(0)
        if self.truncate_when is None:
            key = F.struct(*[col_of(k) for k in self.keys])
            only = self.spark.read.parquet(f"{self._folder(version)}/accepted").select(key.alias("_key")).distinct()
            old, new = (t.withColumn("_key", key).join(only, "_key", "left_semi").drop("_key") for t in (old, new))
        return ch.change_feed(old, new, self.keys, version=version)

    def prune(self, keep: int = 1) -> int:
        """Remove bucket folders that ``keep`` versions no longer need; what
        was accepted and the counts stay. Returns how many went."""
        batches = self.batches()
        if len(batches) <= keep:
            return 0
        gone = 0
        for part in ("rows", "table"):
            needed = set()
            for version in batches[-keep:]:
                needed |= set(self.bucket_folders(part, version).values())
            for b in batches:
                for n in folder_names(self.spark, f"{self._folder(b)}/{part}"):
                    folder = f"{self._folder(b)}/{part}/{n}"
                    if n.startswith("b=") and folder not in needed:
                        fs, target = _hadoop(self.spark, folder)
                        fs.delete(target, True)
                        gone += 1
        return gone
