"""Document keys are split by range into bounded documents; every entry is kept
and the SQL oracle's rule for parts agrees with the Spark builder."""

import os
import sys

from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
from oracle_check import duck, rows_of  # noqa: E402

from sheaf.operators import explode as ex  # noqa: E402
from sheaf.operators import summaries as sm  # noqa: E402
from sheaf.plans import oracle  # noqa: E402
from sheaf.sources import documents as docs  # noqa: E402
from sheaf.sources import fixtures as fx  # noqa: E402

SF = "/root/testdata/sf0.001"
WIDTH = 500


def test_split_documents_are_bounded_and_whole(spark):
    raw = fx.customer_bundles(spark, SF, width=WIDTH)
    b = docs.to_bronze(raw, "t", id_mode="content")
    e = ex.explode_entries(b)
    n_orders = spark.read.parquet(f"{SF}/orders.parquet").count()
    n_customers = spark.read.parquet(f"{SF}/customer.parquet").count()
    assert e.count() == n_orders + n_customers  # nothing dropped
    per_doc = e.groupBy("bundleUUID").count().agg(F.max("count")).first()[0]
    # split keys are unique, so a part holds at most WIDTH of them
    assert per_doc <= WIDTH + 1
    assert b.count() > n_customers  # hot keys were split
    con = duck(SF)
    cte = oracle.customer_docs(WIDTH)
    # documents per type
    got = sm.resource_types(ex.explode_fields(b)).collect()
    exp = con.execute(
        f"{cte} SELECT rtype AS resourceType, count(DISTINCT CAST(doc_key AS VARCHAR) || '/' || CAST(part AS VARCHAR)) "
        "AS raw_bundle_count FROM doc GROUP BY rtype"
    ).fetchall()
    assert sorted(tuple(r) for r in got) == sorted(exp)
    # entry positions inside each part
    got = e.select("bundle_id", "entry_pos", "fullUrl", "resourceType")
    res = con.execute(f"{cte} SELECT CAST(doc_key AS VARCHAR) AS bundle_id, entry_pos, url AS fullUrl, rtype AS resourceType FROM pos")
    g, gc = rows_of(got.columns, [tuple(r) for r in got.collect()])
    x, xc = rows_of([d[0] for d in res.description], res.fetchall())
    assert gc == xc and g == x
