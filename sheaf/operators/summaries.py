"""Catalog summaries over the long tables, and discovery of what to pivot.

Summaries are aggregations (partial on the map side, so a hot type or key
is combined before the shuffle). Discovery pulls only these small summaries
to the driver: their size is bounded by the number of distinct types and
keys, not by the data.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def resource_types(fields: DataFrame) -> DataFrame:
    """Documents per resource type, most frequent first (ties by type)."""
    return (
        fields.groupBy("resourceType")
        .agg(F.count_distinct("bundleUUID").alias("raw_bundle_count"))
        .orderBy(F.desc("raw_bundle_count"), F.asc_nulls_last("resourceType"))
    )


def _documents_per_name(documents: DataFrame, names: Column, column: str) -> DataFrame:
    """Documents per name, from one row of names for each document row. The
    names of a row are made distinct in the row, those of a document by its
    id (several rows can share one): one exchange of one small set a document,
    none of (name, document) pairs. Sets become rows after it, so that names
    are made distinct and counted by hash, with nothing sorted or collected."""
    sets = documents.select("bundleUUID", F.array_distinct(F.coalesce(names, F.array().cast("array<struct<n:string>>"))).alias("_s"))
    whole = sets.filter(F.size("_s") > 0).repartition("bundleUUID")
    pairs = whole.select("bundleUUID", F.explode("_s").alias("_n")).select("bundleUUID", F.col("_n.n").alias(column)).distinct()
    return pairs.groupBy(column).agg(F.count(F.lit(1)).alias("raw_bundle_count"))


def _members(v: Column) -> Column:
    """The values of a VARIANT array or object; NULL for anything else."""
    return F.coalesce(F.try_variant_get(v, "$", "array<variant>"), F.map_values(F.try_variant_get(v, "$", "map<string,variant>")))


def resource_types_of(bronze: DataFrame) -> DataFrame:
    """:func:`resource_types` straight from the documents: entries whose
    resource has members count, as they do in the long table."""
    entries = _members(F.try_variant_get("resource", "$.entry", "variant"))
    filled = F.filter(entries, lambda e: F.size(F.coalesce(_members(F.try_variant_get(e, "$.resource", "variant")), F.array().cast("array<variant>"))) > 0)
    names = F.transform(filled, lambda e: F.struct(F.variant_get(e, "$.resource.resourceType", "string").alias("n")))
    return _documents_per_name(bronze, names, "resourceType").orderBy(F.desc("raw_bundle_count"), F.asc_nulls_last("resourceType"))


def header_keys_of(bronze: DataFrame) -> DataFrame:
    """:func:`header_keys` straight from the documents (the members of a
    ``Meta`` array have no key)."""
    keys = F.map_keys(F.try_variant_get("resource", "$.Meta", "map<string,variant>"))
    loose = F.try_variant_get("resource", "$.Meta", "array<variant>")
    names = F.coalesce(F.transform(keys, lambda k: F.struct(k.alias("n"))), F.transform(loose, lambda _: F.struct(F.lit(None).cast("string").alias("n"))))
    return _documents_per_name(bronze, names, "key").orderBy("key")


def resource_type_keys(fields: DataFrame) -> DataFrame:
    """Occurrences of each key per resource type, ordered by type and key."""
    return fields.groupBy("resourceType", "key").agg(F.count(F.lit(1)).alias("count")).orderBy("resourceType", "key")


def header_keys(header: DataFrame) -> DataFrame:
    """Documents per header key, ordered by key."""
    return header.groupBy("key").agg(F.count_distinct("bundleUUID").alias("raw_bundle_count")).orderBy("key")


def type_key_map(type_keys: DataFrame, discriminator: str = "resourceType") -> DataFrame:
    """Sorted key list per type from the (type, key) summary, without the
    discriminator key itself."""
    return (
        type_keys.filter(F.col("key") != discriminator)
        .groupBy("resourceType")
        .agg(F.sort_array(F.collect_set("key")).alias("keys"))
    )


def discover_types(types_summary: DataFrame) -> list[str]:
    """Sorted list of known resource types (NULL type left out)."""
    rows = types_summary.select("resourceType").filter(F.col("resourceType").isNotNull()).distinct().orderBy("resourceType").collect()
    return [r.resourceType for r in rows]


def discover_header_keys(header_summary: DataFrame) -> list[str]:
    rows = header_summary.select("key").filter(F.col("key").isNotNull()).distinct().orderBy("key").collect()
    return [r.key for r in rows]


def type_key_dict(type_keys: DataFrame, types: list[str] | None = None) -> dict[str, list[str]]:
    """{type: sorted keys}. Every known type gets an entry, an empty list when
    its only key is the discriminator."""
    m = {r.resourceType: list(r["keys"]) for r in type_key_map(type_keys).collect() if r.resourceType is not None}
    known = types if types is not None else sorted(
        r.resourceType for r in type_keys.select("resourceType").distinct().collect() if r.resourceType is not None
    )
    return {t: m.get(t, []) for t in known}


def duplicate_keys(fields: DataFrame, resource_type: str | None = None, only_duplicates: bool = True) -> DataFrame:
    """How often a key occurs per (document, entry url): above 1 means two
    entries share a url in one document."""
    f = fields if resource_type is None else fields.filter(F.col("resourceType") == resource_type)
    out = f.groupBy("bundleUUID", "fullUrl", "key").agg(F.count("key").alias("cnt"))
    if only_duplicates:
        out = out.filter(F.col("cnt") > 1)
    return out.orderBy(F.desc("cnt"), "bundleUUID", "fullUrl", "key")


def duplicate_keys_of(bronze: DataFrame, resource_type: str | None = None) -> DataFrame:
    """:func:`duplicate_keys` (counts above 1) straight from the documents.
    A (document, url) pair never leaves its document, and an object holds a
    key once: so entries travel once, by document, each with the list of its
    keys, and keys become rows after the sort. The long form moves one row a
    key, twice."""
    from .explode import explode_entries

    entries = explode_entries(bronze)
    if resource_type is not None:
        entries = entries.filter(F.col("resourceType") == resource_type)
    keys = F.map_keys(F.try_variant_get("entry", "$.resource", "map<string,variant>"))
    listed = entries.select("bundleUUID", "fullUrl", keys.alias("keys")).filter(F.size("keys") > 0).repartition("bundleUUID")
    # equal key lists of one url are added up first, so a hot url stays one row
    lists = listed.groupBy("bundleUUID", "fullUrl", "keys").agg(F.count(F.lit(1)).alias("n"))
    urls = lists.groupBy("bundleUUID", "fullUrl").agg(F.sum("n").alias("n"), F.collect_list(F.struct("keys", "n")).alias("_lists")).filter("n > 1")
    of = lambda k: F.aggregate("_lists", F.lit(0).cast("bigint"), lambda a, x: a + F.when(F.array_contains(x["keys"], k), x["n"]).otherwise(0))
    names = F.array_sort(F.array_distinct(F.flatten(F.col("_lists")["keys"])))
    counted = urls.select("bundleUUID", "fullUrl", F.transform(names, lambda k: F.struct(of(k).alias("cnt"), k.alias("key"))).alias("_counts"))
    # keys of one url with one count sort side by side: one row until then
    each = F.transform(
        F.array_distinct(F.col("_counts")["cnt"]),
        lambda c: F.struct(c.alias("cnt"), F.filter("_counts", lambda x: x["cnt"] == c)["key"].alias("keys")),
    )
    rows = counted.select("bundleUUID", "fullUrl", F.explode(each).alias("_r")).select("bundleUUID", "fullUrl", F.col("_r.cnt").alias("cnt"), F.col("_r.keys").alias("keys"))
    ordered = rows.filter(F.col("cnt") > 1).orderBy(F.desc("cnt"), "bundleUUID", "fullUrl")
    return ordered.select("bundleUUID", "fullUrl", F.explode("keys").alias("key"), "cnt")


def name_difference(
    spark: SparkSession,
    expected: list[str] | DataFrame,
    seen: DataFrame,
    column: str = "resourceType",
    ignore: tuple[str, ...] = (),
) -> DataFrame:
    """Names expected but not seen (side 'missing') and seen but not expected
    (side 'unexpected'), both as tables, minus names in ``ignore``."""
    exp = expected if isinstance(expected, DataFrame) else spark.createDataFrame([(x,) for x in expected], f"{column} STRING")
    exp = exp.select(F.col(column).alias("name")).filter(F.col("name").isNotNull()).distinct()
    got = seen.select(F.col(column).alias("name")).filter(F.col("name").isNotNull()).distinct()
    out = exp.exceptAll(got).withColumn("side", F.lit("missing")).unionByName(
        got.exceptAll(exp).withColumn("side", F.lit("unexpected"))
    )
    if ignore:
        out = out.filter(~F.col("name").isin(list(ignore)))
    return out
