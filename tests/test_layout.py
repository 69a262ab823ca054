"""Files along a space-filling curve, the one-pass difference, and the typed
route by a derived schema."""

import glob
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from sheaf.operators import layout
from sheaf.operators import pivot as pv
from sheaf.operators import summaries as sm
from sheaf.operators import explode as ex
from sheaf.operators import typed as ty
from sheaf.plans import medallion as md
from sheaf.sources import documents as docs


def files_read(path, column, value):
    """How many files a filter on one value cannot leave out by least and
    greatest value."""
    read = 0
    for f in glob.glob(f"{path}/*.parquet"):
        meta = pq.ParquetFile(f).metadata
        for g in range(meta.num_row_groups):
            stats = next(c.statistics for c in (meta.row_group(g).column(i) for i in range(meta.num_columns)) if c.path_in_schema == column)
            if stats is not None and stats.has_min_max and stats.min <= value <= stats.max:
                read += 1
                break
    return read, len(glob.glob(f"{path}/*.parquet"))


def test_a_point_filter_on_any_cluster_column_reads_few_files(spark, tmp_path):
    df = spark.range(40000).select(((F.col("id") * 7919) % 1000).alias("a"), ((F.col("id") * 104729) % 997).alias("b"), F.format_string("s%04d", (F.col("id") * 31) % 500).alias("c"), "id").repartition(16)
    before, after = str(tmp_path / "before"), str(tmp_path / "after")
    md.write_table(df, before, cluster_by=["a", "b"])
    md.write_table(df, after, cluster_by=["a", "b"], cluster_files=16)
    for column in ("a", "b"):
        n, of = files_read(before, column, 333)
        assert n == of == 16  # sorted inside each file only
        n, of = files_read(after, column, 333)
        assert n <= 8 and of == 16, (column, n)
    assert spark.read.parquet(after).exceptAll(df).count() == 0 and spark.read.parquet(after).count() == 40000


def test_hot_values_nulls_and_text_are_spread(spark, tmp_path):
    hot = spark.range(9000).select(F.when(F.col("id") % 3 > 0, F.lit("hot")).when(F.col("id") % 2 == 0, F.col("id").cast("string")).alias("k"), F.lit(1.5).alias("x"), "id", F.parse_json(F.lit('{"a":1}')).alias("v"))
    sizes = layout.clustered(hot, ["k", "x"], 6).groupBy(F.spark_partition_id()).count().collect()
    assert len(sizes) == 6 and max(r["count"] for r in sizes) < 3500
    empty = hot.limit(0)
    assert layout.clustered(empty, ["k", "x"], 3).count() == 0
    copies = spark.range(0, 6000, 1, 8).select(F.lit(1).alias("k"))
    assert max(r["count"] for r in layout.clustered(copies, ["k"], 4).groupBy(F.spark_partition_id()).count().collect()) < 6000


def test_difference_is_one_pass(spark):
    a = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (3, "z")], "k INT, t STRING").withColumn("v", F.parse_json(F.lit('{"b":2}')))
    b = spark.createDataFrame([(1, "x"), (2, None), (2, None), (4, "y")], "k INT, t STRING").withColumn("v", F.parse_json(F.lit('{ "b": 2 }')))
    d = pv.wide_difference(a, b)
    plan = d._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.k, r.side) for r in d.collect()) == [(1, "a_only"), (2, "b_only"), (3, "a_only"), (4, "b_only")]
    assert plan.count("Exchange hashpartitioning") == 1 and plan.count("Scan ExistingRDD") == 2


HARD = [
    {"id": "1", "timestamp": "2024-01-01T00:00:00Z", "entry": [{"fullUrl": "u", "resource": {"resourceType": "A", "x": 1}}, {"resource": {"resourceType": "A"}}, {"resource": {"resourceType": "B", "x": "t"}}], "Meta": {"K": 1, "L": None}},
    {"id": "2", "timestamp": "2024-01-01T00:00:00Z", "entry": {"m": {"resource": {"resourceType": "C"}}, "n": {"resource": {}}}, "Meta": [1, 2]},
    {"id": "3", "timestamp": "2024-01-01T00:00:00Z", "entry": [{"resource": {"y": 1}}, {"resource": []}, {"resource": [1]}, 5, None], "Meta": {}},
    {"id": "4", "timestamp": "2024-01-01T00:00:00Z", "entry": None, "Meta": "text"},
    {"id": "5", "timestamp": "2024-01-01T00:00:00Z"},
]


def _bronze(spark, texts):
    raw = spark.createDataFrame([(t, f"/f/{i % 4}.json") for i, t in enumerate(texts)], "value STRING, file_path STRING").select(
        "value", "file_path", F.lit("n").alias("file_name"), F.lit(1).cast("bigint").alias("file_size"), F.lit(0).cast("bigint").alias("file_block_start"),
        F.lit(1).cast("bigint").alias("file_block_length"), F.lit("2024-01-01").cast("timestamp").alias("file_modification_time"))
    return docs.to_bronze(raw, "s", id_mode="content")


def test_summaries_from_documents_equal_those_of_the_long_tables(spark):
    import json

    texts = [json.dumps(d) for d in HARD]
    bronze = _bronze(spark, [*texts, texts[0], texts[0]])
    bronze = bronze.withColumn("bundleUUID", F.when(F.col("resource").isNotNull(), F.variant_get("resource", "$.id", "string")))  # one id on several rows
    rows = lambda df: sorted(map(repr, (tuple(r) for r in df.collect())))
    assert rows(sm.resource_types_of(bronze)) == rows(sm.resource_types(ex.explode_fields(bronze)))
    assert rows(sm.header_keys_of(bronze)) == rows(sm.header_keys(ex.explode_header(bronze)))
    plan = sm.resource_types_of(bronze)._jdf.queryExecution().executedPlan().toString()
    dealt = re.findall(r"Exchange hashpartitioning\(([^)]*)\)", plan)
    assert any(d.startswith("bundleUUID#") for d in dealt) and not any("bundleUUID" in d and d.count("#") > 1 for d in dealt)


def test_schema_is_derived_from_the_documents(spark):
    texts = ['{"id":"1","entry":[{"fullUrl":"u","resource":{"resourceType":"A","OBJECT<VOID>":1,"n":null}}]}', '{"id":"2","entry":[{"resource":{"resourceType":"B","x":1.5}},{"fullUrl":"w","resource":{"resourceType":"A","x":3}}]}', '{"id":"3"}']
    bronze = _bronze(spark, texts)
    schema = ty.derive_schema(bronze)
    raw = spark.createDataFrame([(t,) for t in texts], "value STRING")
    parsed = ty.parse_typed(raw, schema)
    e = ty.typed_entries(parsed)
    assert {"bundle_id", "fullUrl", "resourceType", "OBJECT<VOID>", "n", "x"} == set(e.columns)
    assert sorted((r.bundle_id, r.fullUrl or "", r.resourceType, float(r.x or 0)) for r in e.collect()) == [("1", "u", "A", 0.0), ("2", "", "B", 1.5), ("2", "w", "A", 3.0)]
    index = sorted((r.bundle_id, r.entry_pos, r.fullUrl, r.resourceType) for r in ty.entry_index(parsed).collect())
    assert index == [("1", 0, "u", "A"), ("2", 0, None, "B"), ("2", 1, "w", "A")]
    assert [r[0] for r in parsed.select(ty.first_entry_url("A")).collect()] == ["u", "w", None]
    with pytest.raises(ValueError, match="not objects"):
        ty.derive_schema(_bronze(spark, ["[1]"]))


def test_lines_are_left_out_at_the_start_of_a_file_read_in_blocks(spark, tmp_path):
    folder = tmp_path / "lines"
    folder.mkdir()
    want = []
    for f, end in (("a", "\n"), ("b", "\r\n"), ("c", "\n")):
        lines = [f"head {k}" for k in range(3)] + [f"{f}{k} " + "x" * 40 for k in range(2000 if f == "a" else 5)]
        (folder / f"{f}.txt").write_text(end.join(lines) + (end if f != "c" else ""), newline="")
        want += lines[3:]
    (folder / "short.txt").write_text("only\ntwo")
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16384")
    try:
        df = docs.read_documents(spark, str(folder), whole_text=False, skip_rows=3)
        blocks = {r[0] for r in df.filter(F.endswith("file_name", F.lit("a.txt"))).select("file_block_start").distinct().collect()}
        assert len(blocks) > 3 and "Exchange" not in df._jdf.queryExecution().executedPlan().toString()
        assert sorted(r.value for r in df.collect()) == sorted(want)
        stream = docs.stream_documents(spark, str(folder), whole_text=False, skip_rows=3)
        stream.select("value").writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "ck")).trigger(availableNow=True).start(str(tmp_path / "out")).awaitTermination()
        assert sorted(r.value for r in spark.read.parquet(str(tmp_path / "out")).collect()) == sorted(want)
        (folder / "long.txt").write_text("y" * 60000 + "\nhead\nhead\nrow\n")
        with pytest.raises(Exception, match="longer than a block"):
            docs.read_documents(spark, str(folder), whole_text=False, skip_rows=3).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
