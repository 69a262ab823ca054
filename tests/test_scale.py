"""Jobs whose figures must not grow faster than their input."""

import json
import re

from pyspark.sql import functions as F

from sheaf.operators import explode as ex
from sheaf.operators import summaries as sm


def _bronze(spark, texts):
    raw = spark.createDataFrame([(t,) for t in texts], "value STRING")
    return raw.select(
        F.lit(None).cast("string").alias("fileMetadata"), F.lit(None).cast("date").alias("ingestDate"), F.lit(None).cast("timestamp").alias("ingestTime"),
        F.sha2("value", 256).alias("bundleUUID"), F.parse_json("value").alias("resource"),
    )


def _entry(url, **resource):
    return {"fullUrl": url, "resource": {"resourceType": "T", **resource}}


DUPLICATES = [
    {"id": "1", "entry": [_entry("u", a=1), _entry("u", a=2, b=3), _entry("v", a=1)]},
    {"id": "2", "entry": [_entry(None, z=1), _entry(None, z=None, y={}), _entry("w")]},
    {"id": "3", "entry": [{"fullUrl": "u", "resource": [1, 2]}, {"fullUrl": "u", "resource": {"resourceType": "S", "a": 1}}, {"fullUrl": "u", "resource": 5}, {"fullUrl": "u"}]},
    {"id": "4", "entry": []}, {"id": "5", "entry": 3}, {"id": "6"},
    {"id": "7", "entry": {"x": _entry("u", a=1), "y": _entry("u", a=1)}},
    {"id": "8", "entry": [_entry("only", a=1, b=2)]},
]


def test_repeated_keys_are_counted_with_one_move_of_the_entries(spark):
    texts = [json.dumps(d) for d in DUPLICATES]
    bronze = _bronze(spark, [*texts, texts[7], texts[0]])  # two ids on two rows each
    fields = ex.explode_fields(bronze)
    for t in ("T", "S", None):
        want = [tuple(r) for r in sm.duplicate_keys(fields, t).collect()]
        assert [tuple(r) for r in sm.duplicate_keys_of(bronze, t).select("bundleUUID", "fullUrl", "key", "cnt").collect()] == want
        assert t == "S" or len(want) > 5
    plan = sm.duplicate_keys_of(bronze, "T")._jdf.queryExecution().executedPlan().toString()
    assert [re.sub(r"#\d+", "", d) for d in re.findall(r"Exchange hashpartitioning\((.*?), \d+\)", plan)] == ["bundleUUID"]
    sort = re.search(r"Exchange rangepartitioning\((.*?), \d+\)", plan).group(1)
    assert not re.search(r"\bkey#", sort)  # keys become rows after the sort


def test_query_of_repeated_keys_moves_no_row_a_key(spark, tmp_path):
    from sheaf.plans import queries as q

    spark.createDataFrame([(1, "O", "1", 5.0)], "o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING, o_totalprice DOUBLE").withColumn(
        "o_orderdate", F.to_date(F.lit("2024-01-02"))
    ).write.parquet(f"{tmp_path}/orders.parquet")
    line = "l_orderkey BIGINT, l_linenumber BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING"
    rows = [(1, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, "A", "F"), (1, 1, 2, 1, 1.0, 1.0, 0.0, 0.0, None, "F"), (1, 2, 2, 1, 1.0, 1.0, 0.0, 0.0, "A", "F")]
    spark.createDataFrame(rows, line).withColumn("l_shipdate", F.to_date(F.lit("2024-01-03"))).write.parquet(f"{tmp_path}/lineitem.parquet")
    got = q.duplicate_keys(spark, str(tmp_path))
    keys = ["disc", "line", "part", "price", "qty", "resourceType", "shipdate", "status", "supp", "tax"]
    assert [tuple(r) for r in got.collect()] == [("urn:li:1:1", k, 2) for k in keys]
    assert not re.search(r"Exchange hashpartitioning\([^)]*\bkey#", got._jdf.queryExecution().executedPlan().toString())


def _texts(n):
    return [(json.dumps({"id": str(k), "entry": [_entry(f"u{k}-{i}", a=k, b=f"{k * 7919 % 1000003}-{i}" * 4) for i in range(40)]}),) for k in range(n)]


def test_streams_split_files_small_and_keep_the_sessions_own_limit(spark, tmp_path, monkeypatch):
    from sheaf.sources import documents as docs
    from sheaf.streaming import runner as rn

    key = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(key)
    assert docs.small_splits(spark) == {key: str(16 * 1024**2)}
    monkeypatch.setattr(docs, "SPLIT_BYTES", 256 * 1024)
    rn.landing_writer(spark.createDataFrame(_texts(600), "value STRING").coalesce(1), f"{tmp_path}/landing")
    rn.ingest_documents(spark, f"{tmp_path}/landing", f"{tmp_path}/bronze", f"{tmp_path}/ck", whole_text=False)
    bronze = spark.read.parquet(f"{tmp_path}/bronze")
    assert bronze.count() == 600 and len(bronze.inputFiles()) > 4  # one text file: a task a split
    fields, _ = rn.explode_stream(spark, f"{tmp_path}/bronze", f"{tmp_path}/fields", f"{tmp_path}/header", f"{tmp_path}/ckl")
    assert fields.count() == 600 * 40 * 3 and len(fields.inputFiles()) > 4
    assert spark.conf.get(key) == old
    spark.conf.set(key, "64k")
    try:
        assert docs.small_splits(spark) == {key: "65536"}
    finally:
        spark.conf.set(key, old)


def test_landing_files_grow_in_number_with_the_rows(spark, monkeypatch):
    from sheaf.plans import streaming_queries as sq

    monkeypatch.setattr(sq, "LANDING_ROWS", 100, raising=False)
    monkeypatch.setattr(sq, "LANDING_BYTES", 1000, raising=False)
    assert sq._spread(spark.range(0, 5000, 1, 2)).rdd.getNumPartitions() == 50
    assert sq._spread(spark.range(0, 50, 1, 2)).rdd.getNumPartitions() == sq.LANDING_FILES
    documents = spark.range(0, 50, 1, 2).select(F.lit("x").alias("value"), F.lit(1000).cast("bigint").alias("file_size"))
    assert sq._spread(documents).rdd.getNumPartitions() == 50
    assert sq._spread(documents.limit(0)).rdd.getNumPartitions() == sq.LANDING_FILES
