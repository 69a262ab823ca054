"""Steps that group by document move the documents, not the rows made of them."""

import json
import re
from collections import Counter

from pyspark.sql import functions as F

from sheaf.operators import explode as ex
from sheaf.operators import pivot as pv
from sheaf.plans import queries as q


def _tables(spark, path):
    spark.createDataFrame(
        [(1, "O", "1", 5.0), (2, None, "1", 5.0), (2, None, "1", 5.0)], "o_orderkey BIGINT, o_orderstatus STRING, o_orderpriority STRING, o_totalprice DOUBLE"
    ).withColumn("o_orderdate", F.to_date(F.lit("2024-01-02"))).write.parquet(f"{path}/orders.parquet")
    line = "l_orderkey BIGINT, l_linenumber BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_quantity DOUBLE, l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING"
    rows = [(1, 1, 1, 1, 1.0, 1.0, 0.0, 0.0, None, "F"), (1, 1, 2, 1, 1.0, 1.0, 0.0, 0.0, "A", "F"), (1, 2, 2, 1, 1.0, 1.0, 0.0, 0.0, "A", "F"),
            (2, 1, 3, 1, 1.0, 1.0, 0.0, 0.0, "A", "F"), (3, 1, 4, 1, 1.0, 1.0, 0.0, 0.0, "A", "F"), (None, 1, 5, 1, 1.0, 1.0, 0.0, 0.0, "A", "F")]
    spark.createDataFrame(rows, line).withColumn("l_shipdate", F.to_date(F.lit("2024-01-03"))).write.parquet(f"{path}/lineitem.parquet")
    return str(path)


def _exchanges(df):
    """Keys of the exchanges of the plan as it ran, one made again of another left out."""
    df.collect()
    plan = df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]
    made = [line for line in plan.splitlines() if "ReusedExchange" not in line]
    return [re.sub(r"#\d+L?", "", k) for line in made for k in re.findall(r"Exchange hashpartitioning\((.*), \d+\)", line)]


def test_long_pivot_query_moves_documents_only(spark, tmp_path):
    got = q.pivot_duplicates_long(spark, _tables(spark, tmp_path))
    rows = {(r.LineItem_uuid, r.part, r.flag) for r in got.collect()}
    # twin rows of one document id are one here, the first entry that has a key wins
    assert rows == {("urn:li:1:1", 1, "A"), ("urn:li:1:2", 2, "A"), ("urn:li:2:1", 3, "A"), ("urn:li:3:1", 4, "A"), (None, 5, "A")} and got.count() == 5
    assert _exchanges(got) == ["bundleUUID"]


def test_documents_are_dealt_into_parts_of_bounded_size(spark, tmp_path, monkeypatch):
    texts = [(json.dumps({"id": str(k), "x": f"{k * 7919}" * 20}),) for k in range(2000)]
    spark.createDataFrame(texts, "value STRING").select(F.sha2("value", 256).alias("bundleUUID"), F.parse_json("value").alias("resource")).write.parquet(f"{tmp_path}/b")
    bronze = spark.read.parquet(f"{tmp_path}/b")
    least = spark.sparkContext.defaultParallelism
    assert ex.by_document(bronze).rdd.getNumPartitions() == least
    monkeypatch.setattr(ex, "DOCUMENT_BYTES", 1024)
    dealt = ex.by_document(bronze)
    assert dealt.rdd.getNumPartitions() > max(100, least)
    assert dealt.count() == 2000


def test_a_value_to_be_regrouped_leaves_the_names_of_its_document(spark):
    doc = {"id": "1", "entry": [{"fullUrl": "u", "resource": {"resourceType": "T", "a": None, "b": {"c": 1}, **{f"a_long_key_{i}": i for i in range(50)}}}]}
    bronze = spark.createDataFrame([(json.dumps(doc),)], "value STRING").select(
        F.lit(None).cast("string").alias("fileMetadata"), F.lit(None).cast("date").alias("ingestDate"), F.lit(None).cast("timestamp").alias("ingestTime"),
        F.lit("d").alias("bundleUUID"), F.parse_json("value").alias("resource"),
    )
    wide = pv.pivot_resource(ex.explode_fields(bronze), "T", ["a", "b", "missing"])
    row = wide.collect()[0]
    assert row.missing is None and row.a.toJson() == "null" and row.b.toJson() == '{"c":1}'
    assert b"a_long_key" not in bytes(row.b.metadata)


def test_difference_query_moves_documents_once_and_what_is_left(spark, tmp_path):
    got = q.wide_difference(spark, _tables(spark, tmp_path))
    rows = Counter((r.LineItem_uuid, r.part, r.flag, r.side) for r in got.collect())
    assert rows == Counter({("urn:li:1:1", 1, "A", "a_only"): 1, ("urn:li:1:1", 1, None, "b_only"): 1, ("urn:li:1:1", 2, "A", "b_only"): 1})
    assert sorted(_exchanges(got)) == ["_row", "bundleUUID"]


def test_difference_within_columns_is_the_plain_difference(spark):
    s = "d STRING, k INT, v DOUBLE"
    a = [("x", 1, 0.0), ("x", 1, float("nan")), ("y", 1, None), (None, 2, 1.0), ("x", 3, 5.0), ("y", 3, 5.0)]
    b = [("x", 1, -0.0), ("y", 1, float("nan")), ("x", 1, None), (None, 2, 1.0), (None, 2, 1.0), ("z", 3, 5.0)]
    da, db = spark.createDataFrame(a, s), spark.createDataFrame(b, s)
    plain = pv.wide_difference(da.drop("d"), db.drop("d"))
    near = pv.wide_difference(da, db, within=["d"])
    assert near.columns == plain.columns == ["k", "v", "side"]
    want = Counter([(3, 5.0, "a_only"), (2, 1.0, "b_only")])
    assert Counter(map(tuple, near.collect())) == Counter(map(tuple, plain.collect())) == want


def test_numbered_rows_regroup_like_checked_ones(spark):
    entry = lambda url, **r: {**({"fullUrl": url} if url else {}), "resource": {"resourceType": "T", **r}}
    docs = [
        ("a", [entry("u", p=1), entry("v", q=2), entry(None, p=3)]), ("a", [entry("u", p=1), entry("v", q=2), entry(None, p=3)]),  # one id twice, urls distinct
        ("b", [entry("u", q=1), entry("u", p=2, q=3), entry(None), entry(None, p=None)]), ("b", [entry("u", p=9)]),
        ("c", {"x": entry("u", p=1), "y": entry("u", q=1)}), (None, [entry("u", p=1)]), (None, [entry("u", p=2)]),
    ]
    rows = [(i, json.dumps({"id": "1", "timestamp": "2024-01-01T00:00:00Z", "entry": e})) for i, e in docs]
    bronze = spark.createDataFrame(rows, "bundleUUID STRING, value STRING").select(
        F.lit(None).cast("string").alias("fileMetadata"), F.lit(None).cast("date").alias("ingestDate"), F.lit(None).cast("timestamp").alias("ingestTime"),
        "bundleUUID", F.parse_json("value").alias("resource"),
    )
    for keys in (["p", "q"], []):
        split = pv.pivot_resource(None, "T", keys, entries=ex.explode_entries(bronze, url_check=True))
        one = pv.pivot_resource(None, "T", keys, entries=ex.explode_entries(ex.by_document(bronze), url_check=True, row_ids=True))
        assert one.columns == split.columns
        assert Counter(map(tuple, pv.comparable(one).collect())) == Counter(map(tuple, pv.comparable(split).collect()))
