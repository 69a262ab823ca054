"""Properties of the wide step with repeated urls, and of the change log
under any batch split and compaction schedule."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheaf.operators import changes as ch
from sheaf.operators import explode as ex
from sheaf.operators import pivot as pv
from sheaf.sources import documents as docs
from sheaf.streaming import runner as rn

value = st.one_of(st.none(), st.integers(0, 3), st.sampled_from(["s", "t"]))
resource = st.builds(lambda kv: {"resourceType": "T", **kv}, st.dictionaries(st.sampled_from(["p", "q"]), value, max_size=2))
entry = st.fixed_dictionaries({"resource": resource}, optional={"fullUrl": st.sampled_from(["u1", "u2"])})
documents = st.lists(st.lists(entry, min_size=1, max_size=4), min_size=1, max_size=3)


def brute(docs_):
    """First entry wins per key, per (document, url); NULL url is one group."""
    out = {}
    for i, ents in enumerate(docs_):
        for e in ents:
            g = (f"d{i}", e.get("fullUrl"))
            row = out.setdefault(g, {})
            for k in ("p", "q"):
                if k in e["resource"] and k not in row:
                    row[k] = e["resource"][k]
    return {g: row for g, row in out.items()}


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(docs_=documents)
def test_all_regroup_routes_equal_first_entry_wins(spark, tmp_path_factory, docs_):
    d = tmp_path_factory.mktemp("pv")
    for i, ents in enumerate(docs_):
        (d / f"{i}.json").write_text(json.dumps({"id": f"d{i}", "timestamp": "2024-01-01T00:00:00Z", "entry": ents}))
    b = docs.to_bronze(docs.read_documents(spark, str(d)), "t", id_mode="content")
    keys = ["p", "q"]
    f = ex.explode_fields(b)
    routes = {
        "fields": pv.pivot_resource(f, "T", keys),
        "entries": pv.pivot_resource(None, "T", keys, entries=ex.explode_entries(b)),
        "checked": pv.pivot_resource(None, "T", keys, entries=ex.explode_entries(b, url_check=True)),
        "builtin": pv.pivot_resource(f, "T", keys, method="pivot"),
        "sql": pv.pivot_resource(ex.explode_fields_sql(b), "T", keys),
    }
    expected = brute(docs_)
    ids = {r.bundleUUID: r.bundle_id for r in ex.explode_entries(b).select("bundleUUID", "bundle_id").distinct().collect()}
    for name, w in routes.items():
        got = {}
        for r in pv.comparable(w).collect():
            got[(ids[r.bundleUUID], r.T_uuid)] = {k: json.loads(r[k]) for k in keys if r[k] is not None}
        assert got == expected, name


log_rows = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 30), st.sampled_from(["a", "b", None]), st.sampled_from(["u", "u", "d"])),
    min_size=1, max_size=30, unique_by=lambda r: (r[0], r[1]),
)


@settings(max_examples=6, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=log_rows, cuts=st.lists(st.integers(1, 29), max_size=3), compact_at=st.sets(st.integers(0, 3)))
def test_change_log_equals_one_shot_for_any_split(spark, tmp_path_factory, rows, cuts, compact_at):
    s = "k INT, seq INT, v STRING, op STRING"
    bounds = sorted({0, len(rows), *[c for c in cuts if c < len(rows)]})
    log = rn.ChangeLog(spark, str(tmp_path_factory.mktemp("log")), keys="k", sequence_by="seq")
    for n, (lo, hi) in enumerate(zip(bounds, bounds[1:])):
        log.append(spark.createDataFrame(rows[lo:hi], s), n)
        if n in compact_at:
            log.compact()
    got = sorted(tuple(r) for r in log.current(delete_when="op = 'd'").collect())
    exp = sorted(tuple(r) for r in ch.apply_changes(spark.createDataFrame(rows, s), "k", "seq", delete_when="op = 'd'").collect())
    assert got == exp


state_rows = st.dictionaries(st.integers(0, 5), st.sampled_from(["a", "b", None]), max_size=5)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(old=state_rows, new=state_rows)
def test_change_feed_equals_brute_force(spark, old, new):
    s = "k INT, v STRING"
    o = spark.createDataFrame(sorted(old.items()), s)
    n = spark.createDataFrame(sorted(new.items()), s)
    got = [(r.k, r.v, r._change_type) for r in ch.change_feed(o, n, "k").collect()]
    exp = []
    for k in set(old) | set(new):
        if k not in old:
            exp.append((k, new[k], "insert"))
        elif k not in new:
            exp.append((k, old[k], "delete"))
        elif old[k] != new[k]:
            exp += [(k, old[k], "update_preimage"), (k, new[k], "update_postimage")]
    key = lambda t: (t[0], t[2], str(t[1]))
    assert sorted(got, key=key) == sorted(exp, key=key)


bag = st.lists(st.tuples(st.integers(0, 2), st.sampled_from(["x", "y"])), max_size=6)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(a=bag, b=bag)
def test_wide_difference_is_the_multiset_difference(spark, a, b):
    from collections import Counter

    s = "k INT, j STRING"
    da = spark.createDataFrame(a, s).select("k", F.parse_json(F.to_json(F.struct("j"))).alias("v"))
    db = spark.createDataFrame(b, s).select("k", F.parse_json(F.to_json(F.struct("j"))).alias("v"))
    got = Counter((r.k, json.loads(r.v)["j"], r.side) for r in pv.wide_difference(da, db).collect())
    ca, cb = Counter(a), Counter(b)
    exp = Counter({(k, j, "a_only"): n for (k, j), n in (ca - cb).items()})
    exp.update({(k, j, "b_only"): n for (k, j), n in (cb - ca).items()})
    assert got == exp
