"""Tables kept by a stream: any order and split of the change rows gives the
batch result, only touched buckets are rewritten, counts and failures hold
across replays and restarts."""

import random

import pytest
from pyspark.sql import functions as F

from sheaf.operators import changes as ch
from sheaf.session import folder_names
from sheaf.streaming import runner as rn
from sheaf.streaming.target import Target

SCHEMA = "k INT, g STRING, s INT, id INT, v STRING, w DOUBLE"
OPTIONS = {
    "type 1": {},
    "deletes": {"delete_when": "v = 'x'"},
    "nulls": {"ignore_null_updates": True, "delete_when": "v = 'x'"},
    "truncates": {"truncate_when": "v = 't'"},
    "truncates and nulls": {"truncate_when": "v = 't'", "ignore_null_updates": True, "delete_when": "v = 'x'"},
    "type 2": {"scd": 2, "delete_when": "v = 'x'"},
    "type 2 tracked": {"scd": 2, "track": ["v"], "columns": ["v", "w"]},
    "type 2 not tracked": {"scd": 2, "track_except": ["w", "id"], "except_columns": ["id"]},
}


def change_rows(seed, n=160):
    r = random.Random(seed)
    # one key holds a third of all rows; keys and sequence may be NULL
    return [(r.choice([1, 1, 1, 2, 3, 4, None, 5, 6]), r.choice(["a", None]), r.choice([None, *range(-70000, 200000, 9000)]), i, r.choice(["p", "q", "x", "t", None]), r.choice([None, 1.0, 2.0])) for i in range(n)]


def rows_of(df):
    return sorted(map(repr, (tuple(r) for r in df.select(sorted(df.columns)).collect())))


@pytest.mark.parametrize("name", OPTIONS)
@pytest.mark.parametrize("seed", [1])
def test_any_split_and_order_equals_the_batch_result(spark, tmp_path, name, seed):
    rows = change_rows(seed)
    options = OPTIONS[name]
    target = Target(spark, str(tmp_path / "t"), ["k", "g"], "s", tie_break="id", buckets=3, **options)
    shuffled = rows[:]
    random.Random(seed).shuffle(shuffled)
    size = [5, 50, 105]
    at = 0
    for b, n in enumerate(size):
        assert target.apply(spark.createDataFrame(shuffled[at : at + n], SCHEMA), b)
        at += n
    assert not target.apply(spark.createDataFrame(shuffled[:5], SCHEMA), 0)  # replayed
    target.apply(spark.createDataFrame([], SCHEMA), len(size))  # nothing in it
    whole = ch.apply_changes(spark.createDataFrame(rows, SCHEMA), ["k", "g"], "s", tie_break="id", **options)
    assert rows_of(target.table()) == rows_of(whole)
    early = ch.apply_changes(spark.createDataFrame(shuffled[:55], SCHEMA), ["k", "g"], "s", tie_break="id", **options)
    assert rows_of(target.table(version=1)) == rows_of(early)
    assert target.prune() > 0
    assert rows_of(target.table()) == rows_of(whole)


def test_history_needs_no_job_before_it_runs_and_splits_hot_keys(spark):
    rows = spark.createDataFrame(change_rows(3), SCHEMA)
    jobs = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("history", "")
    plan = ch.apply_changes(rows, ["k", "g"], "s", scd=2, tie_break="id")
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert len(jobs.getJobIdsForGroup("history")) == 0
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert "Checkpoint" not in text and "hashpartitioning(_own" in text


def test_untouched_buckets_keep_their_files(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), "k", "s", scd=2, buckets=16)
    target.apply(spark.createDataFrame([(k, "a", 1, k, "p", 1.0) for k in range(200)], SCHEMA), 0)
    before = {part: target.bucket_folders(part) for part in ("rows", "table")}
    assert len(before["rows"]) == 16
    target.apply(spark.createDataFrame([(7, "a", 2, 0, "q", 1.0), (7, "a", 3, 0, "r", 1.0)], SCHEMA), 1)
    for part in ("rows", "table"):
        after = target.bucket_folders(part)
        moved = [b for b in after if after[b] != before[part][b]]
        assert len(moved) == 1 and set(after) == set(before[part])
        assert folder_names(spark, f"{target.path}/batches/batch_id=1/{part}").count(f"b={moved[0]}") == 1
    assert target.table().filter("k = 7").count() == 3 and target.table().count() == 202


def test_expectations_counts_and_failures(spark, tmp_path):
    target = Target(
        spark, str(tmp_path / "t"), "k", "s", warn={"small": "w < 2"}, drop={"has_v": "v IS NOT NULL"}, fail={"has_k": "k IS NOT NULL"},
        row_filter="v <> 'q'", schema="v STRING, k BIGINT", cluster_by=["k"], spark_conf={"spark.sql.shuffle.partitions": "3"}, buckets=2,
    )
    first = [(1, "a", 1, 1, "p", 1.0), (2, "a", 1, 2, None, 2.0), (3, "a", 1, 3, "q", None)]
    target.apply(spark.createDataFrame(first, SCHEMA), 0)
    with pytest.raises(Exception, match="has_k"):
        target.apply(spark.createDataFrame([(None, "a", 2, 4, "p", 1.0), (1, "a", 2, 5, "z", 1.0)], SCHEMA), 1)
    assert target.batches() == [0]
    target.apply(spark.createDataFrame([(4, "a", 2, 4, "p", 1.0)], SCHEMA), 1)
    got = {(r.batch_id, r.expectation): (r.action, r.passed, r.failed) for r in target.counts().collect()}
    assert got == {
        (0, "small"): ("warn", 1, 2), (0, "has_v"): ("drop", 2, 1), (0, "has_k"): ("fail", 3, 0),
        (1, "small"): ("warn", 1, 0), (1, "has_v"): ("drop", 1, 0), (1, "has_k"): ("fail", 1, 0),
    }
    assert target.table().dtypes == [("v", "string"), ("k", "bigint")]
    assert sorted(tuple(r) for r in target.table().collect()) == [("p", 1), ("p", 4)]


def test_a_column_first_seen_later(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), "k", "s", buckets=2)
    target.apply(spark.createDataFrame([(1, 1), (2, 1)], "k INT, s INT"), 0)
    target.apply(spark.createDataFrame([(2, 2, "n")], "k INT, s INT, new STRING"), 1)
    assert sorted(tuple(r) for r in target.table().select("k", "s", "new").collect()) == [(1, 1, None), (2, 2, "n")]
    with pytest.raises(ValueError, match="reserved"):
        target.apply(spark.createDataFrame([(2, 2, 1)], "k INT, s INT, _batch INT"), 2)


@pytest.mark.parametrize("options", [{}, {"delete_when": "v = 'x'"}, {"truncate_when": "v = 't'"}])
def test_feed_equals_the_difference_of_the_states(spark, tmp_path, options):
    rows = change_rows(9)
    target = Target(spark, str(tmp_path / "t"), ["k", "g"], "s", tie_break="id", buckets=4, **options)
    log = rn.ChangeLog(spark, str(tmp_path / "log"), ["k", "g"], "s", tie_break="id")
    for b, (start, end) in enumerate([(0, 100), (100, 104), (104, 160)]):
        part = spark.createDataFrame(rows[start:end], SCHEMA)
        target.apply(part, b)
        log.append(part, b)
    for version, end in ((1, 104), (2, 160)):
        old, new = (ch.apply_changes(spark.createDataFrame(rows[:e], SCHEMA), ["k", "g"], "s", tie_break="id", **options) for e in ((0, 100, 104, 160)[version], end))
        want = rows_of(ch.change_feed(old, new, ["k", "g"], version=version))
        assert rows_of(target.feed(version)) == want
        assert rows_of(log.feed(version - 1, version, **options)) == want
    plan = log.feed(1, 2, delete_when="v = 'x'")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("LeftSemi") == 2  # each state is built for the keys of the batches between alone


def _stream(spark, folder, rows):
    spark.createDataFrame(rows, SCHEMA).write.mode("append").parquet(folder)
    return spark.readStream.schema(SCHEMA).parquet(folder)


@pytest.mark.parametrize("kind", [Target, rn.ChangeLog])
def test_a_stream_without_its_checkpoint_is_refused(spark, tmp_path, kind):
    table = kind(spark, str(tmp_path / "t"), "k", "s")
    show = table.table if kind is Target else table.current
    table.stream_into(_stream(spark, str(tmp_path / "in"), [(1, "a", 1, 1, "p", 1.0)]), str(tmp_path / "ck"))
    table.stream_into(_stream(spark, str(tmp_path / "in"), [(2, "a", 1, 1, "p", 1.0)]), str(tmp_path / "ck"))
    assert show().count() == 2
    with pytest.raises(Exception, match="another stream"):
        table.stream_into(_stream(spark, str(tmp_path / "in"), [(3, "a", 1, 1, "p", 1.0)]), str(tmp_path / "ck2"))
    assert show().count() == 2
    table.stream_into(_stream(spark, str(tmp_path / "in"), [(4, "a", 1, 1, "p", 1.0)]), str(tmp_path / "ck"))
    assert show().count() == 4


def test_batches_of_no_known_stream_are_not_gone_on_with(spark, tmp_path):
    target = Target(spark, str(tmp_path / "t"), "k", "s")
    target.apply(spark.createDataFrame([(1, "a", 1, 1, "p", 1.0)], SCHEMA), 0)
    with pytest.raises(Exception, match="no known stream"):
        target.stream_into(_stream(spark, str(tmp_path / "in"), [(1, "a", 1, 1, "p", 1.0)]), str(tmp_path / "ck"))


def test_options_are_checked(spark, tmp_path):
    for bad in ({"scd": 3}, {"scd": 2, "truncate_when": "true"}, {"warn": {"a": "true"}, "drop": {"a": "true"}}):
        with pytest.raises(ValueError):
            Target(spark, str(tmp_path / "t"), "k", "s", **bad)
    empty = Target(spark, str(tmp_path / "t"), "k", "s")
    assert empty.counts().count() == 0 and empty.batches() == []
    with pytest.raises(ValueError, match="no rows"):
        empty.table()
    two = Target(spark, str(tmp_path / "u"), "k", "s", scd=2)
    two.apply(spark.createDataFrame([(1, "a", 1, 1, "p", 1.0)], SCHEMA), 0)
    with pytest.raises(ValueError, match="type 2"):
        two.feed(0)


def test_silver_counts_are_kept_once(spark, tmp_path):
    root = str(tmp_path / "silver")
    log = rn._silver_log(spark, root, "A")
    wide = spark.createDataFrame([("d", None), ("d", "u"), (None, "u")], "bundleUUID STRING, A_uuid STRING").withColumn("bundle_timestamp", F.lit(1))
    for _ in range(2):
        rn._checked_append(log, wide, 0, rn._silver_rules("A"))
    want = [("valid_A_uuid", 2, 1, 0), ("valid_bundleUUID", 2, 1, 0)]
    assert sorted(tuple(r) for r in rn.expectation_table(spark, log.path).collect()) == want
    other = rn._silver_log(spark, root, "B")
    other.append(wide, 0)  # the run ended before its counts were there
    rn._checked_append(other, wide.withColumnRenamed("A_uuid", "B_uuid"), 0, rn._silver_rules("B"))
    assert rn.expectation_table(spark, other.path).count() == 2


def test_a_column_that_comes_while_the_feed_is_followed(spark, tmp_path):
    """The copy stops before it would lose the column, and has it after."""
    log = rn.ChangeLog(spark, str(tmp_path / "log"), "k", "s")
    log.append(spark.createDataFrame([(1, 1)], "k INT, s INT"), 0)
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    whole, once = rn.run_batches, []

    def late(changes, step, checkpoint):
        if not once:  # another batch lands after the stream's columns were read
            once.append(log.append(spark.createDataFrame([(2, 2, "n")], "k INT, s INT, new STRING"), 1))
        return whole(changes, step, checkpoint)

    rn.run_batches = late
    try:
        with pytest.raises(Exception, match="start it again"):
            rn.follow_changes(spark, log.path, out, ck)
        rn.follow_changes(spark, log.path, out, ck)
    finally:
        rn.run_batches = whole
    got = spark.read.option("mergeSchema", "true").parquet(out).select("k", "s", "new").collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, None), (2, 2, "n")]
