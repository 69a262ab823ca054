"""Bronze of the test tables is written whole, and names are counted by hash."""

import json

import pyarrow.parquet as pq
from pyspark.sql import functions as F

from sheaf.operators import explode as ex
from sheaf.operators import summaries as sm
from sheaf.plans import medallion as md
from sheaf.session import variant_shredding

SHRED = "spark.sql.variant.writeShredding.enabled"


def test_bronze_of_the_tables_is_not_shredded(spark, tmp_path):
    sf = str(tmp_path)
    spark.sql("SELECT 1L AS c_custkey, 'a' AS c_name, 3 AS c_nationkey, -1.5D AS c_acctbal, 'S' AS c_mktsegment").write.parquet(f"{sf}/customer.parquet")
    spark.sql("SELECT id AS o_orderkey, 1L AS o_custkey, 'F' AS o_orderstatus, 2.5D AS o_totalprice FROM range(3)").write.parquet(f"{sf}/orders.parquet")
    before = spark.conf.get(SHRED, None)
    bronze = md.bronze_table(spark, sf)
    assert spark.conf.get(SHRED, None) == before
    files = [f.removeprefix("file:") for f in bronze.inputFiles()]
    assert files and not any("typed_value" in str(pq.read_schema(f)) for f in files)
    got = {(r.fullUrl, r.resourceType) for r in ex.explode_entries(bronze).collect()}
    assert got == {("urn:customer:1", "Customer")} | {(f"urn:order:{i}", "Order") for i in range(3)}


def test_shredding_is_set_both_ways_and_left_alone(spark):
    was = spark.conf.get(SHRED, None)
    for enabled, inside in ((True, "true"), (False, "false"), (None, was)):
        with variant_shredding(spark, enabled=enabled):
            assert spark.conf.get(SHRED, None) == inside
        assert spark.conf.get(SHRED, None) == was


def test_names_of_documents_are_counted_by_hash(spark):
    types = [["A", "B", "A"], ["A"], [], None, ["B", None], ["A", "B"]]
    docs = [{"id": i, "entry": None if t is None else [{"resource": {"resourceType": x, "v": 1}} for x in t]} for i, t in enumerate(types)]
    rows = [(d["id"] if d["id"] < 4 else (0 if d["id"] == 4 else None), json.dumps(d)) for d in docs]  # one id on two rows, one NULL id
    bronze = spark.createDataFrame(rows, "bundleUUID INT, t STRING").select("bundleUUID", F.parse_json("t").alias("resource"))
    counted = sm.resource_types_of(bronze)
    # a NULL id counts as a document of its own
    assert sorted(map(tuple, counted.collect()), key=str) == sorted([("A", 3), ("B", 2), (None, 1)], key=str)
    plan = counted._jdf.queryExecution().executedPlan().toString()
    assert "collect_list" not in plan and "ObjectHashAggregate" not in plan
