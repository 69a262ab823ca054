"""Change application: order and batch-split invariance, deletes, truncates,
history, change feed."""

import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from sheaf.operators import changes as ch

SCHEMA = "k INT, seq INT, v STRING, op STRING"


def state(df):
    return sorted(tuple(r) for r in df.collect())


ROWS = [
    (1, 1, "a", "u"), (1, 2, "b", "u"), (1, 3, None, "u"),
    (2, 1, "x", "u"), (2, 2, None, "d"),
    (3, 5, "p", "u"), (3, 1, None, "d"),  # delete older than latest update: ignored
    (4, 1, "q", "u"), (4, 2, None, "d"), (4, 3, "r", "u"),
]


def test_latest(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = ch.apply_changes(df, "k", "seq", delete_when="op = 'd'", except_columns=["op"])
    assert state(out) == [(1, 3, None), (3, 5, "p"), (4, 3, "r")]


def test_ignore_null_updates(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    out = ch.apply_changes(df, "k", "seq", delete_when="op = 'd'", ignore_null_updates=True, columns=["v"])
    assert state(out) == [(1, "b"), (3, "p"), (4, "r")]


def test_truncate_keeps_only_later_rows(spark):
    rows = [(1, 1, "a", "u"), (2, 2, "b", "u"), (0, 3, None, "t"), (3, 4, "c", "u"), (1, 5, "d", "u")]
    out = ch.apply_changes(spark.createDataFrame(rows, SCHEMA), "k", "seq", truncate_when="op = 't'", columns=["v"])
    assert state(out) == [(1, "d"), (3, "c")]


def test_null_sequence_sorts_lowest(spark):
    rows = [(1, None, "late-null", "u"), (1, 1, "one", "u")]
    out = ch.apply_changes(spark.createDataFrame(rows, SCHEMA), "k", "seq", columns=["v"])
    assert state(out) == [(1, "one")]


def test_tie_break(spark):
    rows = [(1, 1, "a", "x1"), (1, 1, "b", "x2")]
    out = ch.apply_changes(spark.createDataFrame(rows, SCHEMA), "k", "seq", tie_break="op", columns=["v"])
    assert state(out) == [(1, "b")]


def test_history_versions_and_deletes(spark):
    rows = [
        (1, 1, "a", "u"), (1, 2, "a", "u"), (1, 3, "b", "u"), (1, 4, None, "d"), (1, 5, "b", "u"),
        (2, 1, "z", "u"),
    ]
    df = spark.createDataFrame(rows, SCHEMA)
    out = ch.apply_changes(df, "k", "seq", scd=2, delete_when="op = 'd'", track=["v"], columns=["v"])
    got = state(out.select("k", "v", ch.START_AT, ch.END_AT))
    assert got == [(1, "a", 1, 3), (1, "b", 3, 4), (1, "b", 5, None), (2, "z", 1, None)]


def test_change_feed(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b"), (3, "c")], "k INT, v STRING")
    new = spark.createDataFrame([(1, "a"), (2, "B"), (4, "d")], "k INT, v STRING")
    out = state(ch.change_feed(old, new, "k", version=7))
    assert out == [
        (2, "B", "update_postimage", 7), (2, "b", "update_preimage", 7), (3, "c", "delete", 7), (4, "d", "insert", 7)
    ]


rows_strategy = st.lists(
    st.tuples(st.integers(0, 3), st.integers(0, 6), st.sampled_from(["a", "b", None]), st.sampled_from(["u", "u", "d"])),
    min_size=1, max_size=25, unique_by=lambda r: (r[0], r[1]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy, seed=st.integers(0, 1000))
def test_order_and_split_invariance(spark, rows, seed):
    """The same changes in any order or split over batches give one state."""
    expected = state(ch.apply_changes(spark.createDataFrame(rows, SCHEMA), "k", "seq", delete_when="op = 'd'"))
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    cut = len(shuffled) // 2
    a = spark.createDataFrame(shuffled[:cut] or [], SCHEMA)
    b = spark.createDataFrame(shuffled[cut:], SCHEMA)
    got = state(ch.apply_changes(a.unionByName(b), "k", "seq", delete_when="op = 'd'"))
    assert got == expected
    # a replayed batch changes nothing
    got = state(ch.apply_changes(a.unionByName(b).unionByName(b), "k", "seq", delete_when="op = 'd'"))
    assert got == expected
    # brute force
    latest = {}
    for k, s, v, op in rows:
        if k not in latest or s > latest[k][1]:
            latest[k] = (k, s, v, op)
    assert expected == sorted(r for r in latest.values() if r[3] != "d")


def _brute_history(rows, track_idx):
    """rows: (k, seq, v, op). Versions per the type-2 rule, by brute force."""
    out = []
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for k, rs in by_key.items():
        rs.sort(key=lambda r: r[1])
        cur = None
        prev = None
        for i, r in enumerate(rs):
            dele = r[3] == "d"
            if not dele:
                start = prev is None or prev[3] == "d" or prev[track_idx] != r[track_idx]
                if start:
                    if cur is not None and cur[3] is None:
                        cur[3] = r[1]
                    cur = [k, r[2], r[1], None]
                    out.append(cur)
                else:
                    cur[1] = r[2]
            elif cur is not None and cur[3] is None and prev is not None and prev[3] != "d":
                cur[3] = r[1]
            prev = r
    return sorted(tuple(x) for x in out)


def test_history_with_a_hot_key_spanning_partitions(spark):
    """One key holds most rows, so range partitioning splits it over several
    partitions; the result must equal the brute-force rule."""
    rng = random.Random(7)
    rows = [(0, i, rng.choice(["a", "b"]) if i % 7 else "a", "d" if i % 53 == 0 else "u") for i in range(3000)]
    rows += [(k, i, rng.choice(["a", "b"]), "u") for k in range(1, 6) for i in range(20)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = ch.apply_changes(df, "k", "seq", scd=2, delete_when="op = 'd'", track=["v"], columns=["v"])
    got = state(out.select("k", "v", ch.START_AT, ch.END_AT))
    assert got == _brute_history(rows, 2)
    pids = df.repartitionByRange(8, "k", "seq").select(F.spark_partition_id().alias("p"), "k").filter("k = 0").distinct().count()
    assert pids > 1


history_rows = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 40), st.sampled_from(["a", "b"]), st.sampled_from(["u", "u", "u", "d"])),
    min_size=1, max_size=60, unique_by=lambda r: (r[0], r[1]),
)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=history_rows, parts=st.integers(1, 5))
def test_history_equals_brute_force_for_any_partitioning(spark, rows, parts):
    """Type 2 equals the sequential rule whatever the number of range
    partitions (so keys are cut into segments at arbitrary places)."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame(rows, SCHEMA)
        out = ch.apply_changes(df, "k", "seq", scd=2, delete_when="op = 'd'", track=["v"], columns=["v"])
        got = state(out.select("k", "v", ch.START_AT, ch.END_AT))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    assert got == _brute_history(rows, 2)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=rows_strategy)
def test_ignore_nulls_and_truncate_equal_brute_force(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    # ignore NULL updates: per column the latest non-NULL value after the last delete
    got = state(ch.apply_changes(df, "k", "seq", delete_when="op = 'd'", ignore_null_updates=True, columns=["v"]))
    exp = []
    for k in sorted({r[0] for r in rows}):
        rs = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        if rs[-1][3] == "d":
            continue
        last_del = max((r[1] for r in rs if r[3] == "d"), default=None)
        live = [r for r in rs if r[3] != "d" and (last_del is None or r[1] > last_del)]
        vals = [r[2] for r in live if r[2] is not None]
        exp.append((k, vals[-1] if vals else None))
    assert got == sorted(exp, key=lambda t: (t[0], t[1] is None, t[1] or ""))
    # truncate: only rows after the last truncate row count
    trunc = [(k, s, v, "t" if op == "d" else op) for k, s, v, op in rows]
    got = state(ch.apply_changes(spark.createDataFrame(trunc, SCHEMA), "k", "seq", truncate_when="op = 't'", columns=["v"]))
    cut = max((r[1] for r in trunc if r[3] == "t"), default=None)
    kept = [r for r in trunc if r[3] != "t" and (cut is None or r[1] > cut)]
    latest = {}
    for k, s, v, op in kept:
        if k not in latest or s > latest[k][0]:
            latest[k] = (s, v)
    assert got == sorted(((k, v) for k, (s, v) in latest.items()), key=lambda t: (t[0], t[1] is None, t[1] or ""))


two_col_rows = st.lists(
    st.tuples(st.integers(0, 2), st.integers(0, 30), st.sampled_from(["a", "b"]), st.integers(0, 3), st.sampled_from(["u", "u", "d"])),
    min_size=1, max_size=40, unique_by=lambda r: (r[0], r[1]),
)


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(rows=two_col_rows, parts=st.integers(1, 4))
def test_history_untracked_columns_update_in_place(spark, rows, parts):
    """Only the tracked column opens versions; the untracked one takes the
    last value inside its version."""
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(parts))
    try:
        df = spark.createDataFrame(rows, "k INT, seq INT, v STRING, w INT, op STRING")
        out = ch.apply_changes(df, "k", "seq", scd=2, delete_when="op = 'd'", track=["v"], except_columns=["op", "seq"])
        got = state(out.select("k", "v", "w", ch.START_AT, ch.END_AT))
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    exp = []
    for k in sorted({r[0] for r in rows}):
        rs = sorted((r for r in rows if r[0] == k), key=lambda r: r[1])
        cur, prev = None, None
        for r in rs:
            if r[4] == "d":
                if cur is not None and cur[4] is None and prev is not None and prev[4] != "d":
                    cur[4] = r[1]
            elif prev is None or prev[4] == "d" or prev[2] != r[2]:
                if cur is not None and cur[4] is None:
                    cur[4] = r[1]
                cur = [k, r[2], r[3], r[1], None]
                exp.append(cur)
            else:
                cur[2] = r[3]
            prev = r
    assert got == sorted(tuple(x) for x in exp)
