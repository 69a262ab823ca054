"""Documents -> long tables.

Each function is a narrow transformation (lateral ``variant_explode``, which
Spark plans as a codegen'd ``Generate``): no shuffle, works on batch and
streaming DataFrames alike.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import col_of, field

DOCUMENT_COLUMNS = ["fileMetadata", "ingestDate", "ingestTime", "bundleUUID", "bundle_id", "bundle_timestamp"]


def _explode(df: DataFrame, v, alias: str, keep_empty: bool) -> DataFrame:
    tvf = df.sparkSession.tvf
    fn = tvf.variant_explode_outer if keep_empty else tvf.variant_explode
    return df.lateralJoin(fn(v.outer()).alias(alias))


def with_document_columns(bronze: DataFrame, lenient_time: bool = False) -> DataFrame:
    """Add the document's own id and time: ``resource:id`` as text and
    ``resource:timestamp`` as TIMESTAMP (strict raises on unreadable text,
    lenient gives NULL)."""
    return bronze.select(
        "fileMetadata",
        "ingestDate",
        "ingestTime",
        "bundleUUID",
        field("resource", "$.id", "string").alias("bundle_id"),
        field("resource", "$.timestamp", "timestamp", lenient=lenient_time).alias("bundle_timestamp"),
        "resource",
    )


UNIQUE_URLS = "doc_unique_urls"
ROW_ID = "doc_row_id"
#: a part of the documents dealt out by id has about so many bytes of the
#: table: the rows made of them are sorted in a task, and are many times larger
DOCUMENT_BYTES = 4 * 1024**2


def by_document(bronze: DataFrame) -> DataFrame:
    """The documents dealt out by their id. What is exploded from them later
    stays where its document is, so a step that groups by document (and more)
    moves nothing: documents travel once, in place of the rows made of them.
    The number of parts follows the size of the table (the session's own
    number if that is not known)."""
    size = int(str(bronze._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    if size >= 1 << 50:  # no estimate
        return bronze.repartition("bundleUUID")
    return bronze.repartition(max(bronze.sparkSession.sparkContext.defaultParallelism, -(-size // DOCUMENT_BYTES)), "bundleUUID")


def unique_urls(resource: Column) -> Column:
    """True when every entry of the document has its own url (NULL urls
    count as equal). NULL when ``entry`` is not an array. A cast of the
    entry array to ``array<struct<fullUrl>>`` extracts just the urls."""
    urls = F.try_variant_get(resource, "$.entry", "array<struct<fullUrl:string>>")["fullUrl"]
    return F.size(F.array_distinct(urls)) == F.size(urls)


def explode_entries(bronze: DataFrame, keep_empty: bool = False, lenient_time: bool = False, url_check: bool = False, row_ids: bool = False) -> DataFrame:
    """One row per entry of each document: document columns, ``entry_pos``,
    ``fullUrl``, ``resourceType`` and the entry itself (VARIANT).

    Inner by default: a document with no, null, scalar or empty ``entry``
    yields no rows; ``keep_empty=True`` keeps it with NULL entry columns.
    An ``entry`` given as an object yields one row per member.
    ``url_check=True`` adds ``doc_unique_urls`` (see :func:`unique_urls`),
    which lets the regroup pivot skip the shuffle for such documents. That
    shortcut assumes one bronze row per document id, which holds for random
    ids and for content ids of whole files (identical lines of one
    line-mode file share a content id and would count as one document).
    ``row_ids=True`` adds ``doc_row_id``, a number of the bronze row: with it
    the regroup pivot keeps to one group-by for all documents, which suits
    documents dealt out :func:`by_document`."""
    docs = with_document_columns(bronze, lenient_time)
    extra = []
    if url_check:
        docs = docs.withColumn(UNIQUE_URLS, unique_urls(F.col("resource")))
        extra.append(UNIQUE_URLS)
    if row_ids:
        docs = docs.withColumn(ROW_ID, F.monotonically_increasing_id())
        extra.append(ROW_ID)
    e = _explode(docs, field("resource", "$.entry"), "e", keep_empty)
    return e.select(
        *DOCUMENT_COLUMNS,
        *extra,
        F.col("e.pos").alias("entry_pos"),
        field(F.col("e.value"), "$.fullUrl", "string").alias("fullUrl"),
        field(F.col("e.value"), "$.resource.resourceType", "string").alias("resourceType"),
        F.col("e.value").alias("entry"),
    )


def explode_fields(
    bronze: DataFrame,
    types: list[str] | None = None,
    keep_empty: bool = False,
    lenient_time: bool = False,
) -> DataFrame:
    """The long key/value table: one row per top-level key of each entry's
    resource. Columns: document columns, fullUrl, resourceType, entry_pos,
    pos, key, value (VARIANT). ``pos`` is the index in sorted key order.

    ``types`` keeps only those resource types; the filter sits before the
    second explode so other entries are never expanded."""
    entries = explode_entries(bronze, keep_empty=keep_empty, lenient_time=lenient_time)
    if types is not None:
        entries = entries.filter(F.col("resourceType").isin(list(types)))
    return entry_fields(entries, keep_empty)


def entry_fields(entries: DataFrame, keep_empty: bool = False) -> DataFrame:
    """The long rows of entry rows that are already there."""
    r = _explode(entries, field("entry", "$.resource"), "r", keep_empty)
    return r.select(
        *DOCUMENT_COLUMNS,
        "fullUrl",
        "resourceType",
        "entry_pos",
        F.col("r.pos").alias("pos"),
        F.col("r.key").alias("key"),
        F.col("r.value").alias("value"),
    )


def fields_of_type(bronze: DataFrame, resource_type: str) -> DataFrame:
    """Long rows of one resource type, entry url renamed to ``<type>_uuid``.
    The type is a parameter, never pasted into SQL text."""
    f = explode_fields(bronze, types=[resource_type])
    return f.select(
        "bundle_id", "bundle_timestamp", "bundleUUID", F.col("fullUrl").alias(f"{resource_type}_uuid"),
        "entry_pos", "key", "value",
    )


def explode_header(bronze: DataFrame, keep_empty: bool = False, lenient_time: bool = False) -> DataFrame:
    """The long header table: one row per key of the document's ``Meta``
    object (case-sensitive path). A ``Meta`` array gives rows with NULL key."""
    docs = with_document_columns(bronze, lenient_time)
    m = _explode(docs, field("resource", "$.Meta"), "m", keep_empty)
    return m.select(
        "bundleUUID", "fileMetadata", "ingestDate", "ingestTime", "bundle_id", "bundle_timestamp",
        F.col("m.pos").alias("pos"),
        F.col("m.key").alias("key"),
        F.col("m.value").alias("value"),
    )


def explode_json_column(df: DataFrame, text_col: str, keep: list[str], keep_empty: bool = False) -> DataFrame:
    """Explode a JSON-text column of any table into (keep..., pos, key, value)."""
    parsed = df.select(*[col_of(k) for k in keep], F.parse_json(col_of(text_col)).alias("_doc"))
    x = _explode(parsed, F.col("_doc"), "x", keep_empty)
    return x.select(*[col_of(k) for k in keep], F.col("x.pos").alias("pos"), F.col("x.key").alias("key"), F.col("x.value").alias("value"))


# The long tables in Spark SQL: each document joined laterally with the
# rows of its entry array, then with the members of each entry's resource.
# Runs over a temporary view, which may be a streaming one.
_FIELDS_SQL = """
SELECT d.fileMetadata, d.ingestDate, d.ingestTime, d.bundleUUID,
       variant_get(d.resource, '$.id', 'string') AS bundle_id,
       variant_get(d.resource, '$.timestamp', 'timestamp') AS bundle_timestamp,
       variant_get(e.value, '$.fullUrl', 'string') AS fullUrl,
       variant_get(e.value, '$.resource.resourceType', 'string') AS resourceType,
       e.pos AS entry_pos, f.pos AS pos, f.key AS key, f.value AS value
FROM {view} AS d
JOIN LATERAL variant_explode(variant_get(d.resource, '$.entry')) AS e
JOIN LATERAL variant_explode(variant_get(e.value, '$.resource')) AS f
"""

_HEADER_SQL = """
SELECT d.bundleUUID, d.fileMetadata, d.ingestDate, d.ingestTime,
       variant_get(d.resource, '$.id', 'string') AS bundle_id,
       variant_get(d.resource, '$.timestamp', 'timestamp') AS bundle_timestamp,
       h.pos AS pos, h.key AS key, h.value AS value
FROM {view} AS d
JOIN LATERAL variant_explode(variant_get(d.resource, '$.Meta')) AS h
"""


def _sql_over(bronze: DataFrame, template: str, view: str | None) -> DataFrame:
    import uuid

    name = view or f"bronze_{uuid.uuid4().hex[:12]}"
    bronze.createOrReplaceTempView(name)
    return bronze.sparkSession.sql(template.format(view=name))


def explode_fields_sql(bronze: DataFrame, view: str | None = None) -> DataFrame:
    """:func:`explode_fields` written in SQL over a temporary view of
    ``bronze``; works on streaming DataFrames (a streaming view)."""
    return _sql_over(bronze, _FIELDS_SQL, view)


def explode_header_sql(bronze: DataFrame, view: str | None = None) -> DataFrame:
    return _sql_over(bronze, _HEADER_SQL, view)
