"""Documents made from the shared test tables.

Each builder returns a *raw* document DataFrame shaped like a file stream:
``value`` (the JSON text of one document) plus the file-metadata columns a
file source gives (``file_path``, ``file_name``, ``file_size``,
``file_block_start``, ``file_block_length``, ``file_modification_time``).
The bronze step treats both the same way.

Documents are assembled with a group-by on the document key. So that no
single key can pull an unbounded list into one row or one task, a document
holds one range of a key's split keys: part = split key div width. The rule
reads the row alone, so no counting pass and no threshold decides it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the fixture layout.
# A document holds the entries of one key and one range of split keys.
ORDERS_PER_DOCUMENT = 16384
LINES_PER_DOCUMENT = 64
TURNS_PER_DOCUMENT = 256
CUSTOMER_BUNDLE_TIMESTAMP = "2024-01-01T00:00:00Z"
FIXTURE_MODIFICATION_TIME = "2024-01-01 00:00:00"
TS_JSON_FORMAT = "yyyy-MM-dd'T'HH:mm:ss'Z'"


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _entry_json(x: Column) -> Column:
    """``{"fullUrl": <url>, "resource": <res>}`` as text; members that are
    NULL are left out, as a JSON writer would."""
    url_obj = F.to_json(F.named_struct(F.lit("fullUrl"), x["url"]))
    with_url = F.concat(F.substr(url_obj, F.lit(1), F.length(url_obj) - 1), F.lit(',"resource":'), x["res"], F.lit("}"))
    return (
        F.when(x["url"].isNotNull() & x["res"].isNotNull(), with_url)
        .when(x["res"].isNotNull(), F.concat(F.lit('{"resource":'), x["res"], F.lit("}")))
        .otherwise(url_obj)
    )


def bundle_entries(entries: DataFrame, url: Column, res: Column, width: int) -> DataFrame:
    """Group entry rows into documents.

    ``entries`` has ``doc_key`` (any type), ``split`` (BIGINT, negative =
    always part 0), ``sort`` (orderable: the entry order inside a document)
    and the typed columns that ``url`` (STRING) and ``res`` (JSON text of the
    resource) are computed from. Both are evaluated after the shuffle, so the
    compact typed columns travel, not JSON text, and the serialisation runs
    in every post-shuffle task however few input splits there are.
    A row's part is ``split div width``, from the row alone: no count, no
    threshold, and rows with one split key (twins of one url) stay together.
    Returns ``doc_key, part, entries_json`` with one row per document.
    """
    part = F.when(F.col("split") < 0, F.lit(0).cast("bigint")).otherwise(F.floor(F.col("split") / F.lit(width)).cast("bigint"))
    tagged = entries.withColumn("part", F.coalesce(part, F.lit(0).cast("bigint")))
    # Entries of one document are scattered over the input, so a map-side
    # partial list buys nothing: shuffle the rows by (document, part) once and
    # build each list inside its partition (the group-by reuses this layout).
    tagged = tagged.repartition("doc_key", "part")
    tagged = tagged.select("doc_key", "part", "sort", _entry_json(F.struct(url.alias("url"), res.alias("res"))).alias("_json"))
    grouped = tagged.groupBy("doc_key", "part").agg(F.sort_array(F.collect_list(F.struct("sort", "_json"))).alias("_arr"))
    return grouped.select(
        "doc_key",
        "part",
        F.concat(F.lit("["), F.array_join(F.transform("_arr", lambda x: x["_json"]), ","), F.lit("]")).alias("entries_json"),
    )


def document_text(header: Column, entries_json: Column) -> Column:
    """Splice the entry array into a header object given as JSON text."""
    return F.concat(
        F.substr(header, F.lit(1), F.length(header) - 1), F.lit(',"entry":'), entries_json, F.lit("}")
    )


def as_raw(docs: DataFrame, source: str) -> DataFrame:
    """Give a document DataFrame (``doc_key, part, value``) the columns of a
    whole-text file stream."""
    name = F.concat(F.col("doc_key").cast("string"), F.lit("-"), F.col("part").cast("string"), F.lit(".json"))
    return docs.select(
        "value",
        F.concat(F.lit(f"fixture:/{source}/"), name).alias("file_path"),
        name.alias("file_name"),
        F.octet_length("value").cast("bigint").alias("file_size"),
        F.lit(0).cast("bigint").alias("file_block_start"),
        F.octet_length("value").cast("bigint").alias("file_block_length"),
        F.lit(FIXTURE_MODIFICATION_TIME).cast("timestamp").alias("file_modification_time"),
    )


def customer_bundles(spark: SparkSession, sf_dir: str, width: int = ORDERS_PER_DOCUMENT) -> DataFrame:
    """One document per customer (and range of split keys): a Customer entry, then one
    Order entry per order. Header ``Meta`` = Segment, Nation, and Debt only
    for a negative balance. ``status`` is present only when not 'O'."""
    customer = load(spark, sf_dir, "customer")
    orders = load(spark, sf_dir, "orders")
    cust_entries = customer.select(
        F.col("c_custkey").alias("doc_key"),
        F.lit(-1).cast("bigint").alias("split"),
        F.lit(-1).cast("bigint").alias("sort"),
        F.lit("Customer").alias("_kind"),
        "c_custkey", "c_name", "c_acctbal",
    )
    order_entries = orders.select(
        F.col("o_custkey").alias("doc_key"),
        F.col("o_orderkey").alias("split"),
        F.col("o_orderkey").alias("sort"),
        F.lit("Order").alias("_kind"),
        "o_orderkey", "o_totalprice", "o_orderstatus",
    )
    is_customer = F.col("_kind") == "Customer"
    url = F.when(is_customer, F.concat(F.lit("urn:customer:"), F.col("c_custkey").cast("string"))).otherwise(
        F.concat(F.lit("urn:order:"), F.col("o_orderkey").cast("string"))
    )
    res = F.when(
        is_customer,
        F.to_json(F.struct(F.lit("Customer").alias("resourceType"), F.col("c_name").alias("name"), F.col("c_acctbal").alias("bal"))),
    ).otherwise(
        F.to_json(
            F.struct(
                F.lit("Order").alias("resourceType"),
                F.col("o_orderkey").alias("id"),
                F.col("o_totalprice").alias("total"),
                F.when(F.col("o_orderstatus") != "O", F.col("o_orderstatus")).alias("status"),
            )
        )
    )
    docs = bundle_entries(cust_entries.unionByName(order_entries, allowMissingColumns=True), url, res, width)
    header = customer.select(
        F.col("c_custkey").alias("doc_key"),
        F.to_json(
            F.struct(
                F.lit("Bundle").alias("resourceType"),
                F.col("c_custkey").cast("string").alias("id"),
                F.lit(CUSTOMER_BUNDLE_TIMESTAMP).alias("timestamp"),
                F.struct(
                    F.col("c_mktsegment").alias("Segment"),
                    F.col("c_nationkey").alias("Nation"),
                    F.when(F.col("c_acctbal") < 0, F.col("c_acctbal")).alias("Debt"),
                ).alias("Meta"),
            )
        ).alias("_header"),
    )
    # A document whose key has no customer row still gets id and timestamp.
    fallback = F.to_json(
        F.struct(
            F.lit("Bundle").alias("resourceType"),
            F.col("doc_key").cast("string").alias("id"),
            F.lit(CUSTOMER_BUNDLE_TIMESTAMP).alias("timestamp"),
        )
    )
    out = docs.join(header, "doc_key", "left").select(
        "doc_key", "part", document_text(F.coalesce("_header", fallback), F.col("entries_json")).alias("value")
    )
    return as_raw(out, "customer")


LINEITEM_SORT = [
    "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice",
    "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate",
]


def order_bundles(spark: SparkSession, sf_dir: str, width: int = LINES_PER_DOCUMENT) -> DataFrame:
    """One document per order (and range of split keys); entries are its line items,
    url ``urn:li:<order>:<linenumber>``, which is not unique. Entries are
    ordered by all lineitem columns so a first-wins pick is reproducible."""
    lineitem = load(spark, sf_dir, "lineitem")
    orders = load(spark, sf_dir, "orders")
    entries = lineitem.select(
        F.col("l_orderkey").alias("doc_key"),
        F.col("l_linenumber").cast("bigint").alias("split"),
        F.struct(*LINEITEM_SORT).alias("sort"),
    )
    li = lambda c: F.col("sort")[c]
    url = F.concat(F.lit("urn:li:"), F.col("doc_key").cast("string"), F.lit(":"), li("l_linenumber").cast("string"))
    res = F.to_json(
        F.struct(
            F.lit("LineItem").alias("resourceType"),
            li("l_partkey").alias("part"),
            li("l_suppkey").alias("supp"),
            li("l_linenumber").alias("line"),
            li("l_quantity").alias("qty"),
            li("l_extendedprice").alias("price"),
            li("l_discount").alias("disc"),
            li("l_tax").alias("tax"),
            li("l_returnflag").alias("flag"),
            li("l_linestatus").alias("status"),
            F.date_format(li("l_shipdate"), "yyyy-MM-dd").alias("shipdate"),
        )
    )
    docs = bundle_entries(entries, url, res, width)
    header = orders.select(
        F.col("o_orderkey").alias("doc_key"),
        F.to_json(
            F.struct(
                F.lit("Bundle").alias("resourceType"),
                F.col("o_orderkey").cast("string").alias("id"),
                F.date_format("o_orderdate", TS_JSON_FORMAT).alias("timestamp"),
                F.struct(
                    F.col("o_orderstatus").alias("Status"),
                    F.col("o_orderpriority").alias("Priority"),
                    F.col("o_totalprice").alias("Total"),
                ).alias("Meta"),
            )
        ).alias("_header"),
    )
    fallback = F.to_json(F.struct(F.lit("Bundle").alias("resourceType"), F.col("doc_key").cast("string").alias("id")))
    out = docs.join(header, "doc_key", "left").select(
        "doc_key", "part", document_text(F.coalesce("_header", fallback), F.col("entries_json")).alias("value")
    )
    return as_raw(out, "order")


def text_bundles(spark: SparkSession, sf_dir: str, width: int = TURNS_PER_DOCUMENT) -> DataFrame:
    """One document per conversation; each turn is an entry whose type is
    the speaker's role, so several types share one key set."""
    conv = load(spark, sf_dir, "conversations")
    entries = conv.select(
        F.col("conv_id").alias("doc_key"),
        F.col("turn").alias("split"),
        F.col("turn").alias("sort"),
        "role", "text",
    )
    url = F.concat(F.lit("urn:turn:"), F.col("doc_key").cast("string"), F.lit(":"), F.col("sort").cast("string"))
    res = F.to_json(F.struct(F.col("role").alias("resourceType"), F.col("text").alias("text"), F.col("sort").alias("n")))
    docs = bundle_entries(entries, url, res, width)
    header = F.to_json(
        F.struct(
            F.lit("Bundle").alias("resourceType"),
            F.col("doc_key").cast("string").alias("id"),
            F.lit(CUSTOMER_BUNDLE_TIMESTAMP).alias("timestamp"),
            F.struct(F.lit("chat").alias("Kind")).alias("Meta"),
        )
    )
    out = docs.select("doc_key", "part", document_text(header, F.col("entries_json")).alias("value"))
    return as_raw(out, "conversation")


def event_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ``events`` table as a change source keyed by user_id; sequence
    (ts, event_id); rows with event_type 'error' mark deletes."""
    return load(spark, sf_dir, "events")
