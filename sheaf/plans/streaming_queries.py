"""Streaming twins of batch queries.

Each query lands documents (or change rows) derived from the test tables as
files in a fresh folder under the session's shared checkpoint location,
runs the incremental runners with ``availableNow`` and returns the table
they wrote. Results must equal the batch twin.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.variant import col_of, field
from ..operators import changes as ch
from ..operators import pivot as pv
from ..operators import summaries as sm
from ..session import folder_names, scratch_path
from ..sources import documents as docs
from ..sources import fixtures as fx
from ..streaming import runner as rn
from ..streaming.target import Target
from . import medallion as md
from . import queries as q

# A landing folder of the streaming fixtures has so many files
# at least, as many as the rows have partitions where these are more, and so
# many that a file has about so many rows or bytes of documents at most; it is
# taken in in so many micro-batches.
LANDING_FILES = 8
LANDING_ROWS = 100_000
LANDING_BYTES = 32 * 1024 * 1024
EVENT_BATCHES = 4


def _spread(df: DataFrame) -> DataFrame:
    rows, size = df.agg(F.count(F.lit(1)), F.sum("file_size") if "file_size" in df.columns else F.lit(0)).first()
    return df.repartition(max(LANDING_FILES, df.rdd.getNumPartitions(), -(-rows // LANDING_ROWS), -(-(size or 0) // LANDING_BYTES)))


def _files_per_batch(spark: SparkSession, folder: str, batches: int = EVENT_BATCHES) -> int:
    files = [n for n in folder_names(spark, folder) if not n.startswith(("_", "."))]
    return max(1, -(-len(files) // batches))


def _land_documents(spark: SparkSession, sf_dir: str, root: str, fixture: str = "customer") -> str:
    landing = f"{root}/landing/"
    rn.landing_writer(_spread(md.raw_table(spark, sf_dir, fixture)), landing)
    return landing


def _bronze(spark: SparkSession, sf_dir: str, root: str) -> str:
    landing = _land_documents(spark, sf_dir, root)
    bronze = f"{root}/bronze"
    rn.ingest_documents(spark, landing, bronze, f"{root}/ckpt/bronze", datasource=landing, whole_text=False)
    return bronze


def stream_ingest_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landing files -> bronze -> long tables (streams) -> key summary."""
    root = scratch_path(spark, "stream-explode")
    bronze = _bronze(spark, sf_dir, root)
    fields, _ = rn.explode_stream(spark, bronze, f"{root}/fields", f"{root}/header", f"{root}/ckpt/long")
    return sm.resource_type_keys(fields)


def stream_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze stream -> wide Order rows per micro-batch."""
    root = scratch_path(spark, "stream-pivot")
    bronze = _bronze(spark, sf_dir, root)
    rn.pivot_stream(spark, bronze, "Order", q.ORDER_KEYS, f"{root}/stage/Order", f"{root}/ckpt/pivot")
    wide = spark.read.parquet(f"{root}/stage/Order").drop("batch_id")
    return pv.typed(wide, q.ORDER_TYPES).select("Order_uuid", q._doc_time(), *q.ORDER_KEYS)


def _event_stream(spark: SparkSession, sf_dir: str, root: str) -> DataFrame:
    """The events as change rows that arrive over several micro-batches."""
    landing = f"{root}/events"
    _spread(fx.event_updates(spark, sf_dir)).write.parquet(landing)
    schema = spark.read.parquet(landing).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", str(_files_per_batch(spark, landing))).parquet(landing)


def _event_log(spark: SparkSession, sf_dir: str, root: str) -> rn.ChangeLog:
    stream = _event_stream(spark, sf_dir, root)
    log = rn.ChangeLog(spark, f"{root}/changes", keys=q.EVENT_KEYS, sequence_by="ts", tie_break="event_id")
    log.stream_into(stream, f"{root}/ckpt/changes")
    return log


def stream_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Change rows arriving over several micro-batches -> latest per key."""
    root = scratch_path(spark, "stream-latest")
    log = _event_log(spark, sf_dir, root)
    return q._event_out(log.current(), ["user_id", "event_id", "ts", "event_type", "value", "props"])


def stream_change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change log read back as a stream (the table's change feed)."""
    root = scratch_path(spark, "stream-feed")
    log = _event_log(spark, sf_dir, root)
    out = f"{root}/feed"
    changes = rn.stream_changes(spark, log.path)
    rn.run_stream(changes, out, f"{root}/ckpt/feed")
    feed = rn.read_sink(spark, out, changes.schema)
    return q._event_out(feed, ["user_id", "event_id", "ts", "event_type", "value", "props"])


def _supplier_files(spark: SparkSession, sf_dir: str, landing: str, broken: bool = False) -> None:
    """One file for each nation, one document a line: its suppliers. With
    ``broken`` those in debt lose the end of their document."""
    whole = F.to_json(F.struct(
        F.lit("Bundle").alias("resourceType"), F.col("s_suppkey").cast("string").alias("id"),
        F.array(F.struct(F.concat(F.lit("urn:supplier:"), F.col("s_suppkey").cast("string")).alias("fullUrl"),
                         F.struct(F.lit("Supplier").alias("resourceType"), F.col("s_name").alias("name")).alias("resource"))).alias("entry"),
    ))
    value = F.when(F.col("s_acctbal") < 0, F.substring(whole, 1, 20)).otherwise(whole) if broken else whole
    rows = fx.load(spark, sf_dir, "supplier").select(F.col("s_nationkey").alias("nation"), value.alias("value"))
    rows.repartition("nation").write.partitionBy("nation").text(landing)


def _nation_of(path: str) -> Column:
    return F.regexp_extract(path, r"nation=(\d+)", 1).cast("int")


def landing_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files and bytes that landed per folder, today."""
    landing = f"{scratch_path(spark, 'inventory')}/landing"
    _supplier_files(spark, sf_dir, landing)
    inv = docs.landing_inventory(spark, landing).filter(_nation_of("folder").isNotNull())
    return inv.select(_nation_of("folder").alias("nation"), (F.col("day") >= F.date_sub(F.current_date(), 1)).alias("new"), "files", "bytes")


def landed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bronze rows of files that really landed: a sub-folder of the source, a
    reader option that picks the files, few files a batch, and the files' own
    metadata."""
    root = scratch_path(spark, "landed")
    _supplier_files(spark, sf_dir, f"{root}/volume/in/today")
    rn.ingest_documents(
        spark, f"{root}/volume", f"{root}/bronze", f"{root}/ckpt", whole_text=False, max_files=7, sub_folder="in/today",
        options={"pathGlobFilter": "part-*", "recursiveFileLookup": "true"},
    )
    b = spark.read.parquet(f"{root}/bronze")
    meta = F.col("fileMetadata")
    return b.select(
        field("resource", "$.id", "string").alias("bundle_id"),
        _nation_of("fullFilePath").alias("nation"),
        F.endswith("datasource", F.lit("/volume/in/today/")).alias("in_sub_folder"),
        (F.endswith("fullFilePath", F.concat(F.lit("/"), "inputFileName")) & (meta["file_name"] == F.col("inputFileName")) & (meta["file_path"] == F.col("fullFilePath"))).alias("names_agree"),
        meta["file_size"].alias("file_size"),
        (meta["file_block_start"] + meta["file_block_length"] <= meta["file_size"]).alias("block_inside"),
        (F.col("ingestDate") == F.to_date("ingestTime")).alias("day_of_time"),
        (F.length("bundleUUID") == 64).alias("content_id"),
    )


def ingest_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that meets malformed documents: good ones in bronze, the others
    in the rejects table with their text; a second run adds nothing."""
    root = scratch_path(spark, "rejects")
    _supplier_files(spark, sf_dir, f"{root}/landing", broken=True)
    paths = {}
    for _ in range(2):
        paths = md.refresh_all(
            spark, f"{root}/landing", f"{root}/lake", whole_text=False, max_files=9, on_error="quarantine", options={"recursiveFileLookup": "true"},
        )
    good = spark.read.parquet(paths["bronze"]).select(F.lit("bronze").alias("sink"), field("resource", "$.id", "string").alias("bundle_id"), F.lit(None).cast("string").alias("text"))
    bad = spark.read.parquet(paths["rejects"]).select(F.lit("rejects").alias("sink"), F.lit(None).cast("string").alias("bundle_id"), "text")
    return good.unionByName(bad)


def refresh_all_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every layer in one scheduled run (land -> bronze -> long -> summaries
    -> silver per type); the Order silver table it wrote."""
    root = scratch_path(spark, "refresh")
    landing = _land_documents(spark, sf_dir, root)
    paths = md.refresh_all(spark, landing, f"{root}/lake", whole_text=False)
    silver = spark.read.parquet(paths["silver/Order"])
    return pv.typed(silver, q.ORDER_TYPES).select("Order_uuid", *q.ORDER_KEYS)


def stream_versions_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of change rows (before / from the cut date), each picked up
    by its own availableNow run, so each is one micro-batch = one version;
    the feed between version 0 and version 1 (deletes applied)."""
    root = scratch_path(spark, "stream-versions")
    landing = f"{root}/events"
    events = fx.event_updates(spark, sf_dir)
    cut = F.col("ts") < F.lit(q.CHANGE_FEED_CUT).cast("timestamp_ntz")
    schema = events.schema
    log = rn.ChangeLog(spark, f"{root}/changes", keys=q.EVENT_KEYS, sequence_by="ts", tie_break="event_id")
    for part in (events.filter(cut), events.filter(~cut)):
        part.write.mode("append").parquet(landing)
        # one stream, one checkpoint: each run picks up only the new files
        # and continues the batch numbering
        log.stream_into(spark.readStream.schema(schema).parquet(landing), f"{root}/ckpt/changes")
    feed = log.feed(0, 1, delete_when=q.EVENT_DELETE)
    return q._event_out(feed, ["user_id", "event_id", "ts", "event_type", "value", "props", "_change_type", "_commit_version"])


def stream_silver_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental silver: bronze streamed in several micro-batches, wide
    rows appended per type and batch, the Order table read by merge."""
    root = scratch_path(spark, "stream-silver")
    bronze = _bronze(spark, sf_dir, root)
    rn.silver_stream(spark, bronze, f"{root}/silver", f"{root}/ckpt/silver", max_files=_files_per_batch(spark, bronze))
    silver = rn.silver_table(spark, f"{root}/silver", "Order")
    return pv.typed(silver, q.ORDER_TYPES).select("Order_uuid", *q.ORDER_KEYS)


def stream_silver_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders over several batches, some without a url: how many rows each
    expectation of the incremental silver table met and failed."""
    root = scratch_path(spark, "silver-counts")
    orders = fx.load(spark, sf_dir, "orders")
    url = F.when(F.col("o_totalprice") > 100000, F.concat(F.lit("urn:order:"), F.col("o_orderkey").cast("string")))
    entry = F.struct(url.alias("fullUrl"), F.struct(F.lit("Order").alias("resourceType"), F.col("o_totalprice").alias("total")).alias("resource"))
    doc = F.struct(F.lit("Bundle").alias("resourceType"), F.col("o_orderkey").cast("string").alias("id"), F.lit(fx.CUSTOMER_BUNDLE_TIMESTAMP).alias("timestamp"), F.array(entry).alias("entry"))
    rn.landing_writer(_spread(orders.select(F.to_json(doc).alias("value"))), f"{root}/landing")
    rn.ingest_documents(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt/bronze", whole_text=False)
    rn.silver_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ckpt/silver", max_files=_files_per_batch(spark, f"{root}/bronze"))
    counts = rn.expectation_table(spark, f"{root}/silver/Order")
    return counts.groupBy("expectation").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def stream_header_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental header silver over several micro-batches."""
    root = scratch_path(spark, "stream-header")
    bronze = _bronze(spark, sf_dir, root)
    rn.header_stream(spark, bronze, f"{root}/header", f"{root}/ckpt/header", max_files=_files_per_batch(spark, bronze))
    names = rn.key_columns(spark, f"{root}/header")
    silver = pv.typed(rn.header_table(spark, f"{root}/header"), {names[k]: q.HEADER_TYPES[k] for k in q.HEADER_KEYS})
    return silver.select("bundle_id", q._doc_time(), *[col_of(names[k]).alias(k) for k in q.HEADER_KEYS])


def stream_silver_case_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of documents whose keys clash: ``code`` in the first,
    ``Code`` in the second, and ``batch_id`` (a name the log uses) in both.
    Each key keeps its own column."""
    root = scratch_path(spark, "stream-keys")
    orders = fx.load(spark, sf_dir, "orders")
    first = F.coalesce(F.col("o_orderstatus") == "O", F.lit(False))
    for part, key in ((orders.filter(first), "code"), (orders.filter(~first), "Code")):
        resource = F.struct(
            F.lit("Note").alias("resourceType"),
            F.col("o_totalprice").alias(key),
            F.col("o_custkey").alias("batch_id"),
        )
        entry = F.struct(F.concat(F.lit("urn:note:"), F.col("o_orderkey").cast("string")).alias("fullUrl"), resource.alias("resource"))
        doc = F.struct(
            F.lit("Bundle").alias("resourceType"),
            F.col("o_orderkey").cast("string").alias("id"),
            F.lit(fx.CUSTOMER_BUNDLE_TIMESTAMP).alias("timestamp"),
            F.array(entry).alias("entry"),
        )
        rn.landing_writer(part.select(F.to_json(doc).alias("value")), f"{root}/landing")
        rn.ingest_documents(spark, f"{root}/landing", f"{root}/bronze", f"{root}/ckpt/bronze", whole_text=False)
        rn.silver_stream(spark, f"{root}/bronze", f"{root}/silver", f"{root}/ckpt/silver")
    names = rn.key_columns(spark, f"{root}/silver/Note")
    types = {"code": "double", "Code": "double", "batch_id": "bigint"}
    wide = pv.typed(rn.silver_table(spark, f"{root}/silver", "Note"), {c: types[k] for k, c in names.items()})
    return wide.select(
        "Note_uuid",
        col_of(names["code"]).alias("code_first"),
        col_of(names["Code"]).alias("code_second"),
        col_of(names["batch_id"]).alias("batch_key"),
    )


def stream_change_feed_grown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The change stream over a log whose second batch has a new column
    (``props``) and is replayed after it was read."""
    root = scratch_path(spark, "stream-grown")
    events = fx.event_updates(spark, sf_dir)
    cut = F.coalesce(F.col("ts") < F.lit(q.CHANGE_FEED_CUT).cast("timestamp_ntz"), F.lit(False))
    log = rn.ChangeLog(spark, f"{root}/changes", keys=q.EVENT_KEYS, sequence_by="ts", tie_break="event_id")
    out = f"{root}/feed"
    later = events.filter(~cut)
    for step in (lambda: log.append(events.filter(cut).drop("props"), 0), lambda: log.append(later, 1), lambda: log.append(later, 1)):
        step()
        changes = rn.stream_changes(spark, log.path)
        rn.run_stream(changes, out, f"{root}/ckpt/feed")
    feed = rn.read_sink(spark, out, changes.schema)
    return q._event_out(feed, ["user_id", "event_id", "ts", "event_type", "value", "props"])


#: expectations on the change rows, and the filter on the published table
EVENT_WARN = {"not_a_view": "event_type <> 'view'"}
EVENT_DROP = {"worth_ten": "value >= 10"}
EVENT_FAIL = {"has_id": "event_id IS NOT NULL"}
EVENT_SHOWN = "event_type <> 'click'"


def _history_target(spark: SparkSession, sf_dir: str, name: str) -> Target:
    root = scratch_path(spark, name)
    target = Target(
        spark, f"{root}/target", q.EVENT_KEYS, "ts", scd=2, tie_break="event_id", delete_when=q.EVENT_DELETE, track=["event_type"],
        columns=["event_type", "event_id"], warn=EVENT_WARN, drop=EVENT_DROP, fail=EVENT_FAIL, row_filter=EVENT_SHOWN, buckets=16,
    )
    target.stream_into(_event_stream(spark, sf_dir, root), f"{root}/ckpt")
    return target


def stream_silver_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type 2 table kept by a stream: deletes, tracked columns,
    expectations, row filter and column choice in one call."""
    target = _history_target(spark, sf_dir, "stream-history")
    return q._event_out(target.table(), ["user_id", "event_type", "event_id", ch.START_AT, ch.END_AT])


def stream_expect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The expectation counts of its batches, added up."""
    counts = _history_target(spark, sf_dir, "stream-counts").counts()
    return counts.groupBy("expectation", "action").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


def stream_target_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two drops of change rows into a type 1 table with deletes; the feed of
    the second from the buckets it touched."""
    root = scratch_path(spark, "stream-target")
    events = fx.event_updates(spark, sf_dir)
    cut = F.col("ts") < F.lit(q.CHANGE_FEED_CUT).cast("timestamp_ntz")
    target = Target(spark, f"{root}/target", q.EVENT_KEYS, "ts", tie_break="event_id", delete_when=q.EVENT_DELETE)
    for part in (events.filter(cut), events.filter(~cut)):
        part.write.mode("append").parquet(f"{root}/events")
        target.stream_into(spark.readStream.schema(events.schema).parquet(f"{root}/events"), f"{root}/ckpt")
    return q._event_out(target.feed(1), ["user_id", "event_id", "ts", "event_type", "value", "props", "_change_type", "_commit_version"])


def stream_target_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A type 1 table that keeps values on NULL updates and is emptied by
    truncating rows, kept by a stream."""
    root = scratch_path(spark, "stream-nulls")
    target = Target(
        spark, f"{root}/target", q.EVENT_KEYS, "ts", tie_break="event_id", ignore_null_updates=True, truncate_when=q.EVENT_TRUNCATE, except_columns=["props"],
    )
    changes = _event_stream(spark, sf_dir, root).withColumn("value", F.when((F.col("event_type") != "view") | (F.col("value") > 300), F.col("value")))
    target.stream_into(changes, f"{root}/ckpt")
    return q._event_out(target.table(), ["user_id", "event_id", "ts", "event_type", "value"])


def skip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files with a header line and a line end at the end, read line by line
    without the header."""
    root = scratch_path(spark, "skip-lines")
    cols = ["o_orderkey", "o_custkey", "o_orderpriority"]
    fx.load(spark, sf_dir, "orders").select(*cols).write.option("header", "true").csv(f"{root}/landing")
    lines = docs.read_documents(spark, f"{root}/landing", whole_text=False, skip_rows=1)
    row = F.from_csv("value", "o_orderkey BIGINT, o_custkey BIGINT, o_orderpriority STRING")
    return lines.select(row.alias("r")).select(*[F.col("r")[c].alias(c) for c in cols])
