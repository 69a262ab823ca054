"""The end-to-end build as plain functions: raw documents -> bronze -> long
tables -> summaries -> wide stage tables -> silver tables.

Each step is DataFrame -> DataFrame; the writers persist a step to a path.
Discovery (types, keys) collects only the small summaries.
"""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import changes as ch
from ..operators import explode as ex
from ..operators import pivot as pv
from ..operators import quality as q
from ..operators import summaries as sm
from ..operators.layout import clustered
from ..session import scratch_path, session_id, session_settings, variant_shredding
from ..functions.variant import col_of
from ..sources import documents as docs
from ..sources import fixtures as fx

FIXTURES = {
    "customer": fx.customer_bundles,
    "order": fx.order_bundles,
    "conversation": fx.text_bundles,
}


def fixture_bronze(spark: SparkSession, sf_dir: str, fixture: str = "customer", id_mode: str = "content") -> DataFrame:
    """Bronze rows of documents made from the test tables (not persisted)."""
    raw = FIXTURES[fixture](spark, sf_dir)
    return docs.to_bronze(raw, f"fixture:/{fixture}/", id_mode=id_mode)


# Persisted landing (raw text) and bronze tables, one per (application,
# scale folder, fixture): the pipeline writes them once and every later step
# reads them, as a bronze table is read by the steps after it.
_TABLES: dict[tuple[str, str, str, str], str] = {}


#: error classes that mean a table is not there (yet); the last is that of a
#: stream's sink that has received no file
_ABSENT = ("PATH_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA", "_LEGACY_ERROR_TEMP_1134")


def read_if_there(spark: SparkSession, path: str) -> DataFrame | None:
    """The parquet table, or None if nothing was written there; any other
    error (rights, network, a broken file) is raised."""
    try:
        return spark.read.parquet(path)
    except AnalysisException as e:
        if (e.getCondition() or "").startswith(_ABSENT):
            return None
        raise


def _persisted(spark: SparkSession, sf_dir: str, fixture: str, layer: str, build) -> DataFrame:
    key = (session_id(spark), os.path.realpath(sf_dir), fixture, layer)
    path = _TABLES.get(key)
    if path is not None:
        found = read_if_there(spark, path)
        if found is not None:
            return found
        _TABLES.pop(key, None)  # folder gone: build again
    path = scratch_path(spark, f"{layer}-{fixture}")
    # most steps over this bronze read whole entry arrays: a shredded VARIANT
    # would be taken apart here and put together again at each read
    with variant_shredding(spark, enabled=False if layer == "bronze" else None):
        build().write.mode("overwrite").option("compression", "zstd").parquet(path)
    _TABLES[key] = path
    return spark.read.parquet(path)


def raw_table(spark: SparkSession, sf_dir: str, fixture: str = "customer") -> DataFrame:
    """Landing table: the documents' JSON text with file columns."""
    return _persisted(spark, sf_dir, fixture, "raw", lambda: FIXTURES[fixture](spark, sf_dir))


def bronze_table(spark: SparkSession, sf_dir: str, fixture: str = "customer") -> DataFrame:
    """Bronze table (VARIANT documents, content ids), written once from the
    landing table."""
    return _persisted(
        spark, sf_dir, fixture, "bronze",
        lambda: docs.to_bronze(raw_table(spark, sf_dir, fixture), f"fixture:/{fixture}/", id_mode="content"),
    )


def write_table(
    df: DataFrame,
    path: str,
    mode: str = "overwrite",
    partition_by: list[str] | None = None,
    cluster_by: list[str] | None = None,
    schema: str | None = None,
    spark_conf: dict[str, str] | None = None,
    comment: str | None = None,
    properties: dict[str, str] | None = None,
    cluster_files: int | None = None,
) -> None:
    """Persist a table as parquet.

    ``cluster_by`` sorts rows inside each output file (no extra shuffle, so a
    hot key never lands in one task); parquet min/max statistics then skip
    row groups on those columns. With ``cluster_files`` rows are shuffled once
    into so many files along a space-filling curve over the cluster columns,
    so that whole files are skipped by a filter on any of them (see
    :mod:`sheaf.operators.layout`). ``schema`` ('a INT, b STRING') selects and
    casts to a declared layout. ``spark_conf`` holds for this write only.
    ``comment`` and ``properties`` are kept beside the data in
    ``_table_info`` (see :func:`table_info`)."""
    if schema is not None:
        from pyspark.sql.types import _parse_datatype_string

        st = _parse_datatype_string(schema)
        df = df.select(*[col_of(f.name).cast(f.dataType).alias(f.name) for f in st.fields])
    if cluster_by and cluster_files:
        df = clustered(df, cluster_by, cluster_files)
    elif cluster_by:
        df = df.sortWithinPartitions(*[col_of(c) for c in cluster_by])
    w = df.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    with session_settings(df.sparkSession, spark_conf):
        w.parquet(path)
    if comment is not None or properties:
        import json

        info = df.sparkSession.createDataFrame(
            [(comment, json.dumps(properties or {}, sort_keys=True))], "comment STRING, properties STRING"
        )
        info.coalesce(1).write.mode("overwrite").json(f"{path.rstrip('/')}/_table_info")


def table_info(spark: SparkSession, path: str) -> dict:
    """Comment and properties stored by :func:`write_table` (empty if none).
    The ``_table_info`` folder is ignored by parquet reads of the table."""
    import json

    try:
        row = spark.read.schema("comment STRING, properties STRING").json(f"{path.rstrip('/')}/_table_info").first()
    except AnalysisException as e:
        if (e.getCondition() or "").startswith(_ABSENT):  # no info written
            return {}
        raise
    if row is None:
        return {}
    return {"comment": row.comment, "properties": json.loads(row.properties or "{}")}


def refresh_summaries(fields: DataFrame, header: DataFrame) -> dict[str, DataFrame]:
    """The three catalog summaries (recomputed in full, not streamed)."""
    return {
        "resource_types": sm.resource_types(fields),
        "resource_type_keys": sm.resource_type_keys(fields),
        "meta_keys": sm.header_keys(header),
    }


def write_summaries(summaries: dict[str, DataFrame], base_path: str) -> dict[str, str]:
    """Persist each summary, replacing the previous version (a recomputed,
    not streamed, table)."""
    out = {}
    for name, df in summaries.items():
        path = f"{base_path.rstrip('/')}/{name}"
        df.write.mode("overwrite").parquet(path)
        out[name] = path
    return out


def stage(df: DataFrame, name: str, temporary: bool = True, path: str | None = None) -> DataFrame:
    """A stage table: temporary (a session view, recomputed when read) or
    kept (written to ``path`` and read back)."""
    if temporary:
        df.createOrReplaceTempView(name)
        return df.sparkSession.table(name)
    if path is None:
        raise ValueError("a kept stage table needs a path")
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.parquet(path)


def header_silver(
    header: DataFrame | None,
    keys: list[str] | None = None,
    expect_drop: dict[str, str] | None = None,
    bronze: DataFrame | None = None,
) -> DataFrame:
    """Header wide stage + latest per document (key bundleUUID, sequence
    bundle_timestamp), rows with a NULL key dropped. Given ``bronze``, the
    stage is a projection of the header keys (no regroup shuffle; the change
    application's shuffle is the only one)."""
    if keys is None:
        keys = sm.discover_header_keys(sm.header_keys(header if header is not None else ex.explode_header(bronze)))
    if bronze is not None:
        stage = pv.pivot_header(None, keys, method="project", bronze=bronze, only_with_keys=True)
    else:
        stage = pv.pivot_header(header, keys)
    rules = expect_drop if expect_drop is not None else {"valid_bundleUUID": "bundleUUID IS NOT NULL"}
    stage, _ = q.expect(stage, drop=rules)
    return ch.apply_changes(stage, keys=["bundleUUID"], sequence_by="bundle_timestamp")


def resource_silver(
    fields: DataFrame | None,
    resource_type: str,
    keys: list[str],
    method: str = "regroup",
    entries: DataFrame | None = None,
    entity_keys: list[str] | None = None,
) -> DataFrame:
    """Wide stage of one type + latest per (document, entry url), NULL keys
    dropped, sequence column hidden. ``entity_keys`` (e.g. just the url
    column) gives true latest-per-entity across documents instead."""
    url_col = f"{resource_type}_uuid"
    stage = pv.pivot_resource(fields, resource_type, keys, method=method, entries=entries)
    key_cols = entity_keys if entity_keys is not None else ["bundleUUID", url_col]
    rules = {f"valid_{c}": f"`{c}` IS NOT NULL" for c in key_cols}
    stage, _ = q.expect(stage, drop=rules)
    # documents of one time: the larger document id is the later one
    tie = [c for c in ("bundleUUID",) if entity_keys is not None and c not in key_cols]
    return ch.apply_changes(stage, keys=key_cols, sequence_by="bundle_timestamp", tie_break=tie, except_columns=["bundle_timestamp", *tie])


def build_silver(
    fields: DataFrame | None,
    types: list[str] | None = None,
    type_keys: dict[str, list[str]] | None = None,
    method: str = "regroup",
    entries: DataFrame | None = None,
    out_path: str | None = None,
    persist_source: bool = True,
    write_options: dict | None = None,
) -> dict[str, DataFrame]:
    """Fan out: one silver table per resource type. Types and key lists come
    from the summaries unless given.

    With ``out_path`` the source rows are persisted once, partitioned by
    resource type (``out_path/_source``), so each type's build reads only its
    own folder instead of rescanning the documents; each silver table is then
    written to ``out_path/<type>`` and the returned frames read those."""
    if type_keys is None:
        if fields is None:
            raise ValueError("type keys must be given when only the entry table is passed")
        type_keys = sm.type_key_dict(sm.resource_type_keys(fields), types)
    if types is None:
        types = sorted(type_keys)
    use_entries = entries is not None and method in ("regroup", "project")
    src = entries if use_entries else fields
    if out_path is not None and persist_source:
        spark = src.sparkSession
        source_path = f"{out_path.rstrip('/')}/_source"
        src.filter(F.col("resourceType").isin(types)).write.mode("overwrite").partitionBy("resourceType").parquet(source_path)
        src = spark.read.parquet(source_path)
    out = {}
    for t in types:
        part = src.filter(F.col("resourceType") == t)
        if use_entries:
            out[t] = resource_silver(None, t, type_keys.get(t, []), method=method, entries=part)
        else:
            out[t] = resource_silver(part, t, type_keys.get(t, []), method=method)
    if out_path is None:
        return out
    spark = src.sparkSession
    result = {}
    for t, df in out.items():
        path = f"{out_path.rstrip('/')}/{t}"
        opts = {"cluster_by": ["bundleUUID", f"{t}_uuid"], "comment": f"{t} resource data", **(write_options or {})}
        write_table(df, path, **opts)
        result[t] = spark.read.parquet(path)
    return result


def long_tables(bronze: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(entries, fields, header) of a bronze table."""
    return ex.explode_entries(bronze), ex.explode_fields(bronze), ex.explode_header(bronze)


def refresh_all(
    spark: SparkSession,
    source: str,
    base: str,
    types: list[str] | None = None,
    whole_text: bool = True,
    max_files: int | None = docs.DEFAULT_MAX_FILES,
    max_bytes: str | int | None = None,
    incremental: bool = False,
    **ingest,
) -> dict[str, str]:
    """One scheduled run over every layer, under ``base``:

    1. new files under ``source`` -> ``bronze`` (stream, availableNow),
    2. bronze -> ``fields`` (partitioned by type) and ``header`` (stream),
    3. the three summaries, recomputed (``summaries/<name>``),
    4. one silver table per type (``silver/<type>``) and the header silver
       (``silver_header``), rebuilt from the long tables with the key lists
       discovered in step 3 (a key first seen today becomes a column today).

    Rerunning with no new files adds no rows to the appended layers.
    With ``incremental=True`` step 4 is instead a stream over the new bronze
    rows only (``silver_stream``): wide rows per type are appended to
    ``silver/<type>/log`` and read by merge (``silver_table``), the header
    rows likewise to ``silver_header/log`` (``header_table``), so a run's
    work grows with the new data, not the history.

    ``ingest`` are further options of the first step
    (:func:`~sheaf.streaming.runner.ingest_documents`): ``options``,
    ``skip_rows``, ``id_mode``, ``datasource``, ``sub_folder``, ``shred``; with
    ``on_error="quarantine"`` malformed documents go to ``rejects``.
    Returns the paths written."""
    from ..streaming import runner as rn

    b = base.rstrip("/")
    ck = f"{b}/_checkpoints"
    rejects = f"{b}/rejects" if ingest.pop("on_error", "fail") == "quarantine" else None
    rn.ingest_documents(
        spark, source, f"{b}/bronze", f"{ck}/bronze", whole_text=whole_text, max_files=max_files, max_bytes=max_bytes, rejects_path=rejects, **ingest
    )
    if read_if_there(spark, f"{b}/bronze") is None:  # nothing has landed yet: no table to build on
        return {}
    fields, header = rn.explode_stream(spark, f"{b}/bronze", f"{b}/fields", f"{b}/header", f"{ck}/long")
    paths = write_summaries(refresh_summaries(fields, header), f"{b}/summaries")
    if incremental:
        rn.silver_stream(spark, f"{b}/bronze", f"{b}/silver", f"{ck}/silver", types=types)
        rn.header_stream(spark, f"{b}/bronze", f"{b}/silver_header", f"{ck}/silver_header")
        paths.update({"rejects": rejects} if rejects else {})
        paths.update({"silver": f"{b}/silver", "silver_header": f"{b}/silver_header", "bronze": f"{b}/bronze", "fields": f"{b}/fields", "header": f"{b}/header"})
        return paths
    type_keys = sm.type_key_dict(spark.read.parquet(paths["resource_type_keys"]), types)
    splits = docs.small_splits(spark)  # long rows are sorted before they are regrouped
    silver = build_silver(fields, types=types, type_keys=type_keys, out_path=f"{b}/silver", persist_source=False, write_options={"spark_conf": splits})
    header_keys = sm.discover_header_keys(spark.read.parquet(paths["meta_keys"]))
    if header_keys:
        bronze = spark.read.parquet(f"{b}/bronze")
        write_table(header_silver(header, header_keys, bronze=bronze), f"{b}/silver_header", cluster_by=["bundleUUID"], spark_conf=splits)
        paths["silver_header"] = f"{b}/silver_header"
    paths.update({f"silver/{t}": f"{b}/silver/{t}" for t in silver})
    paths.update({"bronze": f"{b}/bronze", "fields": f"{b}/fields", "header": f"{b}/header"})
    paths.update({"rejects": rejects} if rejects else {})
    return paths
