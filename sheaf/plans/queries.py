"""The query catalogue: every operator run over the shared test tables.

Each query takes (spark, sf_dir) and returns a DataFrame with plain typed
columns (VARIANT cells are published as typed values; timestamps as text),
so results can be compared with an independent SQL oracle
(:mod:`sheaf.plans.oracle`).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import variant as fv
from ..operators import changes as ch
from ..operators import explode as ex
from ..operators import pivot as pv
from ..operators import quality as q
from ..operators import summaries as sm
from ..operators import typed as ty
from ..session import scratch_path
from ..sources import documents as docs
from ..sources import fixtures as fx
from . import medallion as md

TS_TEXT = "yyyy-MM-dd HH:mm:ss.SSSSSS"
DOC_TIME_TEXT = "yyyy-MM-dd HH:mm:ss"

# Fixed values used by the queries.
DOCUMENT_ID = "1"
ORDER_KEYS = ["id", "status", "total"]
ORDER_TYPES = {"id": "bigint", "total": "double", "status": "string"}
CUSTOMER_KEYS = ["bal", "name"]
CUSTOMER_TYPES = {"name": "string", "bal": "double"}
HEADER_KEYS = ["Debt", "Nation", "Segment"]
HEADER_TYPES = {"Debt": "double", "Nation": "bigint", "Segment": "string"}
LINEITEM_KEYS = ["disc", "flag", "line", "part", "price", "qty", "shipdate", "status", "supp", "tax"]
LINEITEM_TYPES = {
    "disc": "double", "flag": "string", "line": "bigint", "part": "bigint", "price": "double",
    "qty": "double", "shipdate": "string", "status": "string", "supp": "bigint", "tax": "double",
}
EXPECTED_TYPES = ["Order", "Practitioner"]
EVENT_KEYS = ["user_id"]
EVENT_DELETE = "event_type = 'error'"
EVENT_TRUNCATE = "event_type = 'signup' AND value > 300"
CHANGE_FEED_CUT = "2024-01-16 00:00:00"
ORDER_ROW_FILTER = "total > 100000 AND status IS NOT NULL"


def _ts(c: str) -> Column:
    return F.date_format(F.col(c), TS_TEXT).alias(c)


def _doc_time(c: str = "bundle_timestamp") -> Column:
    """Document time as UTC wall-clock text, whatever the session time zone."""
    utc = F.to_utc_timestamp(F.col(c), F.current_timezone())
    return F.date_format(utc, DOC_TIME_TEXT).alias("bundle_time")


def _value_cols(v: str = "value") -> list[Column]:
    return [fv.value_kind(v).alias("value_kind"), fv.value_string(v).alias("value_string"), fv.value_number(v).alias("value_number")]


def _bronze(spark, sf_dir, fixture="customer") -> DataFrame:
    return md.bronze_table(spark, sf_dir, fixture)


def _raw(spark, sf_dir, fixture="customer") -> DataFrame:
    return md.raw_table(spark, sf_dir, fixture)


def _fields(spark, sf_dir, fixture="customer") -> DataFrame:
    return ex.explode_fields(_bronze(spark, sf_dir, fixture))


def _events(spark, sf_dir) -> DataFrame:
    return fx.event_updates(spark, sf_dir)


# -- long tables ---------------------------------------------------------

def explode_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = ex.explode_entries(_bronze(spark, sf_dir))
    return e.select("bundle_id", "entry_pos", "fullUrl", "resourceType")


def document_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = _fields(spark, sf_dir)
    return f.select("bundle_id", "fullUrl", "resourceType", "entry_pos", "pos", "key", *_value_cols())


def explode_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    h = ex.explode_header(_bronze(spark, sf_dir))
    return h.select("bundle_id", "pos", "key", *_value_cols())


def event_props_explode(spark: SparkSession, sf_dir: str) -> DataFrame:
    x = ex.explode_json_column(_events(spark, sf_dir), "props", ["event_id"])
    return x.select("event_id", "pos", "key", *_value_cols())


def fields_of_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = ex.fields_of_type(_bronze(spark, sf_dir), "Order")
    return f.select("bundle_id", "Order_uuid", "key", *_value_cols())


# -- summaries -------------------------------------------------------------

def resource_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.resource_types_of(_bronze(spark, sf_dir))


def resource_type_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.resource_type_keys(_fields(spark, sf_dir))


def header_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.header_keys_of(_bronze(spark, sf_dir))


def type_key_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = sm.type_key_map(sm.resource_type_keys(_fields(spark, sf_dir)))
    return m.select("resourceType", F.array_join("keys", ",").alias("keys"))


def discover_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = sm.resource_types(_fields(spark, sf_dir))
    return t.select("resourceType").filter(F.col("resourceType").isNotNull()).distinct()


def duplicate_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = sm.duplicate_keys_of(_bronze(spark, sf_dir, "order"), "LineItem")
    return d.select("fullUrl", "key", "cnt")


def name_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    seen = sm.resource_types(_fields(spark, sf_dir))
    return sm.name_difference(spark, EXPECTED_TYPES, seen)


def text_resource_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sm.resource_types(_fields(spark, sf_dir, "conversation"))


# -- wide tables -----------------------------------------------------------

def _order_wide(spark, sf_dir, method) -> DataFrame:
    b = _bronze(spark, sf_dir)
    if method == "pivot":
        w = pv.pivot_resource(ex.explode_fields(b), "Order", ORDER_KEYS, method=method)
    else:
        w = pv.pivot_resource(None, "Order", ORDER_KEYS, method=method, entries=ex.explode_entries(b, url_check=True))
    return pv.typed(w, ORDER_TYPES).select("Order_uuid", _doc_time(), *ORDER_KEYS)


def pivot_resource_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_wide(spark, sf_dir, "regroup")


def pivot_resource_order_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_wide(spark, sf_dir, "project")


def pivot_resource_order_builtin(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _order_wide(spark, sf_dir, "pivot")


def pivot_resource_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    # long-table route: regroup of key/value rows, as when only the long table is kept
    w = pv.pivot_resource(_fields(spark, sf_dir), "Customer", CUSTOMER_KEYS)
    return pv.typed(w, CUSTOMER_TYPES).select("Customer_uuid", *CUSTOMER_KEYS)


def pivot_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = pv.pivot_header(ex.explode_header(_bronze(spark, sf_dir)), HEADER_KEYS)
    return pv.typed(w, HEADER_TYPES).select("bundle_id", _doc_time(), *HEADER_KEYS)


def pivot_header_project(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = pv.pivot_header(None, HEADER_KEYS, method="project", bronze=_bronze(spark, sf_dir))
    return pv.typed(w, HEADER_TYPES).select("bundle_id", _doc_time(), *HEADER_KEYS)


def _lineitem_wide(spark, sf_dir, method) -> DataFrame:
    b = _bronze(spark, sf_dir, "order")
    if method == "pivot":
        w = pv.pivot_resource(ex.explode_fields(b, types=["LineItem"]), "LineItem", LINEITEM_KEYS, method=method)
    else:
        w = pv.pivot_resource(None, "LineItem", LINEITEM_KEYS, method=method, entries=ex.explode_entries(b, url_check=True))
    return pv.typed(w, LINEITEM_TYPES).select("LineItem_uuid", _doc_time(), *LINEITEM_KEYS)


def pivot_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _lineitem_wide(spark, sf_dir, "regroup")


def pivot_duplicates_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Same merge computed from the long key/value table."""
    b = ex.by_document(_bronze(spark, sf_dir, "order"))
    w = pv.pivot_resource(ex.explode_fields(b, types=["LineItem"]), "LineItem", LINEITEM_KEYS)
    return pv.typed(w, LINEITEM_TYPES).select("LineItem_uuid", _doc_time(), *LINEITEM_KEYS)


def wide_difference(spark: SparkSession, sf_dir: str) -> DataFrame:
    # both sides are made where the documents are, so what they share cancels there
    e = ex.explode_entries(ex.by_document(_bronze(spark, sf_dir, "order")), url_check=True, row_ids=True)
    merged, per_entry = (
        pv.typed(pv.pivot_resource(None, "LineItem", LINEITEM_KEYS, method=m, entries=e), LINEITEM_TYPES)
        .select("bundleUUID", "LineItem_uuid", _doc_time(), *LINEITEM_KEYS)
        for m in ("regroup", "project")
    )
    return pv.wide_difference(merged, per_entry, within=["bundleUUID"])


def text_pivot_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = pv.pivot_resource(_fields(spark, sf_dir, "conversation"), "user", ["n", "text"])
    return pv.typed(w, {"n": "bigint", "text": "string"}).select("user_uuid", "n", "text")


# -- expectations ------------------------------------------------------------

def expect_drop(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _order_wide(spark, sf_dir, "regroup")
    out, _ = q.expect(w, drop={"valid_Order_uuid": "Order_uuid IS NOT NULL", "has_status": "status IS NOT NULL"})
    return out


def expect_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    w = _order_wide(spark, sf_dir, "regroup")
    return q.expectation_counts(w, {"has_status": "status IS NOT NULL", "big_total": "total > 100000"})


# -- change application ----------------------------------------------------

def _event_out(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.select(*[_ts(c) if c in ("ts", ch.START_AT, ch.END_AT) else F.col(c) for c in cols])


def changes_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ch.apply_changes(_events(spark, sf_dir), EVENT_KEYS, "ts", tie_break="event_id")
    return _event_out(t, ["user_id", "event_id", "ts", "event_type", "value", "props"])


def changes_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ch.apply_changes(_events(spark, sf_dir), EVENT_KEYS, "ts", tie_break="event_id", delete_when=EVENT_DELETE)
    return _event_out(t, ["user_id", "event_id", "ts", "event_type", "value", "props"])


def changes_ignore_nulls(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir).withColumn("value", F.when(F.col("event_type") != "view", F.col("value")))
    t = ch.apply_changes(ev, EVENT_KEYS, "ts", tie_break="event_id", ignore_null_updates=True)
    return _event_out(t, ["user_id", "event_id", "ts", "event_type", "value", "props"])


def changes_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ch.apply_changes(_events(spark, sf_dir), EVENT_KEYS, "ts", tie_break="event_id", truncate_when=EVENT_TRUNCATE)
    return _event_out(t, ["user_id", "event_id", "ts", "event_type", "value", "props"])


def changes_except_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ch.apply_changes(_events(spark, sf_dir), EVENT_KEYS, "ts", tie_break="event_id", except_columns=["props", "ts"])
    return t


def changes_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ch.apply_changes(_events(spark, sf_dir), EVENT_KEYS, "ts", scd=2, tie_break="event_id", except_columns=["props"])
    return _event_out(t, ["user_id", "event_id", "ts", "event_type", "value", ch.START_AT, ch.END_AT])


def changes_history_tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ch.apply_changes(_events(spark, sf_dir), EVENT_KEYS, "ts", scd=2, tie_break="event_id", track=["event_type"], columns=["event_type", "event_id", "value"])
    return _event_out(t, ["user_id", "event_type", "event_id", "value", ch.START_AT, ch.END_AT])


def changes_history_delete(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = ch.apply_changes(
        _events(spark, sf_dir), EVENT_KEYS, "ts", scd=2, tie_break="event_id", track=["event_type"],
        delete_when=EVENT_DELETE, columns=["event_type", "event_id"],
    )
    return _event_out(t, ["user_id", "event_type", "event_id", ch.START_AT, ch.END_AT])


def changes_tied_sequence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order per customer by order date; equal dates are ordered by
    the order key (the tie-break columns)."""
    orders = fx.load(spark, sf_dir, "orders")
    t = ch.apply_changes(orders, "o_custkey", "o_orderdate", tie_break="o_orderkey")
    return t.select("o_custkey", "o_orderkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_totalprice")


def change_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = _events(spark, sf_dir)
    before = ch.apply_changes(ev.filter(F.col("ts") < F.lit(CHANGE_FEED_CUT).cast("timestamp_ntz")), EVENT_KEYS, "ts", tie_break="event_id")
    after = ch.apply_changes(ev, EVENT_KEYS, "ts", tie_break="event_id", delete_when=EVENT_DELETE)
    feed = ch.change_feed(before, after, EVENT_KEYS, version=1)
    return _event_out(feed, ["user_id", "event_id", "ts", "event_type", "value", "props", "_change_type", "_commit_version"])


def header_silver(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = md.header_silver(None, HEADER_KEYS, bronze=_bronze(spark, sf_dir))
    return pv.typed(s, HEADER_TYPES).select("bundle_id", _doc_time(), *HEADER_KEYS)


def find_document(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents of one id, with what their header says."""
    found = docs.find_document(_bronze(spark, sf_dir), DOCUMENT_ID)
    segment = fv.field("resource", ("Meta", "Segment"), "string")
    return found.select(fv.field("resource", ("id",), "string").alias("bundle_id"), segment.alias("segment")).distinct()


def silver_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = md.resource_silver(None, "Order", ORDER_KEYS, entries=ex.explode_entries(_bronze(spark, sf_dir), url_check=True))
    return pv.typed(s, ORDER_TYPES).select("Order_uuid", *ORDER_KEYS)


def silver_order_filtered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Order silver table published through a row filter."""
    s = md.resource_silver(_fields(spark, sf_dir), "Order", ORDER_KEYS)
    t = pv.typed(s, ORDER_TYPES).select("Order_uuid", *ORDER_KEYS)
    return q.row_filter(t, ORDER_ROW_FILTER)


def silver_all_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fan-out over every discovered type (keys from the summaries), entries
    persisted once by type, one silver table written per type; rows per type."""
    b = _bronze(spark, sf_dir)
    type_keys = sm.type_key_dict(sm.resource_type_keys(ex.explode_fields(b)))
    out = scratch_path(spark, "silver")
    tables = md.build_silver(None, type_keys=type_keys, entries=ex.explode_entries(b, url_check=True), out_path=out)
    parts = [df.select(F.lit(t).alias("resourceType"), F.col(f"{t}_uuid").alias("entry_url")) for t, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("resourceType").agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("entry_url").alias("urls"))


# -- typed routes and scalar functions -------------------------------------------

def _typed_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as structs, by the schema that they have."""
    return ty.parse_typed(_raw(spark, sf_dir), ty.derive_schema(_bronze(spark, sf_dir)))


def typed_entries(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = ty.typed_entries(_typed_documents(spark, sf_dir))
    return e.select("bundle_id", "fullUrl", "resourceType", F.col("id").cast("bigint").alias("id"), F.col("total").cast("double").alias("total"), "status")


def entry_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ty.entry_index(_typed_documents(spark, sf_dir))


def first_entry_url(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = _typed_documents(spark, sf_dir)
    return t.select(F.col("doc.id").alias("bundle_id"), ty.first_entry_url("Order").alias("first_order_url"))


def field_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = _raw(spark, sf_dir)
    return raw.select(fv.field_text("value", "$.id").alias("bundle_id"), fv.field_text("value", "$.Meta.Segment").alias("segment"))


def require_type_bundle(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = docs.require_type(_bronze(spark, sf_dir), "bundle")
    return b.select(
        fv.field("resource", "$.id", "string").alias("bundle_id"),
        F.json_array_length(F.to_json(fv.field("resource", "$.entry"))).alias("n_entries"),
    )


def sample_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = docs.sample_documents(_bronze(spark, sf_dir), 10)
    return s.select("bundle_id", F.json_array_length(F.to_json(fv.field("resource", "$.entry"))).alias("n_entries"))


def bronze_layout(spark: SparkSession, sf_dir: str) -> DataFrame:
    b = _bronze(spark, sf_dir)
    return b.select(
        "datasource", "inputFileName", F.col("fullFilePath"),
        (F.col("fileMetadata.file_block_length") == F.col("fileMetadata.file_size")).alias("whole_file"),
        F.length("bundleUUID").alias("id_length"),
        (F.col("ingestDate") == F.current_date()).alias("ingested_today"),
    )


def document_fields_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    f = ex.explode_fields_sql(_bronze(spark, sf_dir))
    return f.select("bundle_id", "fullUrl", "resourceType", "entry_pos", "pos", "key", *_value_cols())


# -- control data, stage tables and name lists ---------------------------------------

def discovered_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types and header keys as the driver gets them: sorted, numbered."""
    b = _bronze(spark, sf_dir)
    types = sm.discover_types(sm.resource_types_of(b))
    keys = sm.discover_header_keys(sm.header_keys_of(b))
    rows = [("type", i, n) for i, n in enumerate(types)] + [("header key", i, n) for i, n in enumerate(keys)]
    return spark.createDataFrame(rows, "kind STRING, place INT, name STRING")


def stage_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The Order stage table, kept and temporary: the rows of both."""
    wide = _order_wide(spark, sf_dir, "regroup")
    kept = md.stage(wide, "order_stage", temporary=False, path=scratch_path(spark, "stage"))
    shown = md.stage(wide, "order_stage_view")
    return kept.withColumn("stage", F.lit("kept")).unionByName(shown.withColumn("stage", F.lit("temporary")))


def grouping_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Header wide table grouped by all columns but position, key and value."""
    header = ex.explode_header(_bronze(spark, sf_dir))
    group = fv.columns_except(header, ["pos", "key", "value"])
    wide = pv.pivot_long(header, group, HEADER_KEYS, order=("pos",))
    return pv.typed(wide, HEADER_TYPES).select("bundle_id", _doc_time(), *HEADER_KEYS)


def key_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``type.key`` of every key of every type, put together from its parts."""
    keys = sm.resource_type_keys(_fields(spark, sf_dir))
    return keys.select(F.concat("resourceType", F.lit("."), "key").alias("label"), "count")


def silver_expected_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver tables of a configured list of types, one of which never
    occurs; rows per table."""
    b = _bronze(spark, sf_dir)
    types = fv.split_names(" Order ,Practitioner")
    type_keys = sm.type_key_dict(sm.resource_type_keys(ex.explode_fields(b)), types)
    tables = md.build_silver(None, types=types, type_keys=type_keys, entries=ex.explode_entries(b, url_check=True), out_path=scratch_path(spark, "silver-types"))
    out = None
    for t, df in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("resourceType"), "rows")
        out = one if out is None else out.unionByName(one)
    return out


def clustered_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders written along a space-filling curve over customer and date and
    read back."""
    path = scratch_path(spark, "clustered")
    md.write_table(fx.load(spark, sf_dir, "orders"), path, cluster_by=["o_custkey", "o_orderdate"], cluster_files=16)
    return spark.read.parquet(path).select("o_orderkey", "o_custkey", F.date_format("o_orderdate", "yyyy-MM-dd").alias("o_orderdate"), "o_totalprice")
