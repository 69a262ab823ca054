"""The physical plans have the shape the design claims: narrow explodes,
no shuffle for projection pivots, pruned scans, partial aggregation,
size-checked broadcasts."""

import re


from sheaf.operators import changes as ch
from sheaf.operators import explode as ex
from sheaf.operators import pivot as pv
from sheaf.operators import summaries as sm
from sheaf.plans import medallion as md
from sheaf.plans import queries as q
from sheaf.sources import fixtures as fx

SF = "/root/testdata/sf0.001"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def exchanges(df) -> int:
    return len(re.findall(r"Exchange (hashpartitioning|rangepartitioning|SinglePartition|RoundRobin)", plan(df)))


def test_explode_is_narrow(spark):
    b = md.bronze_table(spark, SF, "customer")
    assert exchanges(ex.explode_fields(b)) == 0
    assert exchanges(ex.explode_header(b)) == 0
    assert "Generate" in plan(ex.explode_fields(b))


def test_project_pivot_has_no_shuffle(spark):
    b = md.bronze_table(spark, SF, "customer")
    w = pv.pivot_resource(None, "Order", q.ORDER_KEYS, method="project", entries=ex.explode_entries(b))
    assert exchanges(w) == 0


def test_regroup_shuffles_only_documents_with_repeated_urls(spark):
    b = md.bronze_table(spark, SF, "customer")
    checked = pv.pivot_resource(None, "Order", q.ORDER_KEYS, entries=ex.explode_entries(b, url_check=True))
    p = plan(checked)
    assert "Union" in p
    assert exchanges(checked) == 1  # the merge branch only
    unchecked = pv.pivot_resource(None, "Order", q.ORDER_KEYS, entries=ex.explode_entries(b))
    assert exchanges(unchecked) == 1 and "Union" not in plan(unchecked)


def test_bronze_scan_reads_only_needed_columns(spark):
    b = md.bronze_table(spark, SF, "customer")
    full = plan(b)
    assert "inputFileName" in full  # a plain read lists every bronze column
    p = plan(sm.resource_types(ex.explode_fields(b)))
    assert "FileScan parquet" in p
    for unused in ("inputFileName", "fullFilePath", "datasource", "fileMetadata", "ingestTime"):
        assert unused not in p, unused


def test_summaries_and_latest_aggregate_partially(spark):
    b = md.bronze_table(spark, SF, "customer")
    assert "partial_count" in plan(sm.resource_type_keys(ex.explode_fields(b)))
    ev = fx.event_updates(spark, SF)
    assert "partial_max_by" in plan(ch.apply_changes(ev, "user_id", "ts", tie_break="event_id"))


def test_hot_key_table_is_broadcast_after_its_size_check(spark):
    raw = fx.customer_bundles(spark, SF)
    assert "BroadcastHashJoin" in plan(raw) or "BroadcastExchange" in plan(raw)
