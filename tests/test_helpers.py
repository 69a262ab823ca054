"""Smaller building blocks: writers, stage tables,
change feed over VARIANT cells, warn-only expectations, name helpers."""

from pyspark.sql import functions as F

from sheaf.functions import variant as fv
from sheaf.operators import changes as ch
from sheaf.operators import quality as q
from sheaf.plans import medallion as md


def test_stage_temporary_and_kept(spark, tmp_path):
    df = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    t = md.stage(df, "stage_view_test")
    assert spark.table("stage_view_test").count() == 2 and t.count() == 2
    kept = md.stage(df, "kept", temporary=False, path=str(tmp_path / "kept"))
    assert sorted(tuple(r) for r in kept.collect()) == [(1, "a"), (2, "b")]


def test_write_table_schema_partition_cluster(spark, tmp_path):
    df = spark.createDataFrame([(2, "x", 1.5), (1, "y", 2.5), (3, "x", 0.5)], "k INT, g STRING, v DOUBLE")
    path = str(tmp_path / "t")
    md.write_table(df, path, partition_by=["g"], cluster_by=["k"], schema="k BIGINT, g STRING, v DOUBLE")
    back = spark.read.parquet(path)
    assert dict(back.dtypes)["k"] == "bigint"
    assert sorted((r.k, r.g) for r in back.collect()) == [(1, "y"), (2, "x"), (3, "x")]



def test_change_feed_compares_variant_cells(spark):
    old = spark.createDataFrame([(1, '{"a":1}'), (2, '{"a":2}')], "k INT, j STRING").select("k", F.parse_json("j").alias("v"))
    new = spark.createDataFrame([(1, '{"a":1}'), (2, '{"a":3}')], "k INT, j STRING").select("k", F.parse_json("j").alias("v"))
    feed = ch.change_feed(old, new, "k").select("k", F.to_json("v").alias("v"), "_change_type")
    assert sorted(tuple(r) for r in feed.collect()) == [(2, '{"a":2}', "update_preimage"), (2, '{"a":3}', "update_postimage")]


def test_warn_expectation_counts_without_dropping(spark):
    df = spark.createDataFrame([(1,), (None,), (3,)], "a INT")
    out, obs = q.expect(df, warn={"a_present": "a IS NOT NULL"})
    assert out.count() == 3
    assert obs.get["a_present_failed"] == 1
    counts = {r.expectation: (r.passed, r.failed) for r in q.expectation_counts(df, {"a_present": "a IS NOT NULL", "big": "a > 1"}).collect()}
    assert counts == {"a_present": (2, 1), "big": (1, 2)}


def test_name_helpers(spark):
    df = spark.createDataFrame([(1, 2, 3)], "a INT, pos INT, key INT")
    assert fv.columns_except(df, ["pos", "key"]) == ["a"]
    assert fv.split_names(" Patient, Encounter,,Observation ") == ["Patient", "Encounter", "Observation"]


def test_write_table_keeps_comment_properties_and_applies_conf(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k INT, v STRING")
    path = str(tmp_path / "t")
    before = spark.conf.get("spark.sql.parquet.compression.codec")
    md.write_table(df, path, spark_conf={"spark.sql.parquet.compression.codec": "gzip"},
                   comment="Order silver", properties={"quality": "silver"})
    assert spark.conf.get("spark.sql.parquet.compression.codec") == before
    assert any(f.endswith(".gz.parquet") for f in spark.read.parquet(path).inputFiles())
    assert md.table_info(spark, path) == {"comment": "Order silver", "properties": {"quality": "silver"}}
    assert spark.read.parquet(path).count() == 1  # the info folder is not read as data
