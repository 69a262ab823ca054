"""Changes that are easy to lose: fine times, NULL key parts, new columns,
reads after compaction."""

from pyspark.sql import functions as F

from sheaf.operators import changes as ch
from sheaf.streaming.runner import ChangeLog

T = "k INT, j STRING, seq INT, at TIMESTAMP"


def _rows(spark, rows):
    df = spark.createDataFrame([(a, b, s, t) for a, b, s, t in rows], "k INT, j STRING, seq INT, t STRING")
    return df.select("k", "j", "seq", F.col("t").cast("timestamp").alias("at"))


def test_change_feed_sees_changes_below_a_millisecond(spark):
    old = _rows(spark, [(1, None, 1, "2024-01-01 00:00:00.000100")]).drop("seq")
    new = _rows(spark, [(1, None, 1, "2024-01-01 00:00:00.000900")]).drop("seq")
    got = sorted(r._change_type for r in ch.change_feed(old, new, ["k", "j"]).collect())
    assert got == ["update_postimage", "update_preimage"]
    assert ch.change_feed(old, old, ["k", "j"]).count() == 0


def test_change_feed_takes_a_new_column(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k INT, v STRING")
    new = spark.createDataFrame([(1, "a", 5), (2, "b", None)], "k INT, v STRING, w INT")
    got = {(r.k, r._change_type, r.v, r.w) for r in ch.change_feed(old, new, "k").collect()}
    assert got == {(1, "update_preimage", "a", None), (1, "update_postimage", "a", 5)}


def test_history_keeps_null_keys_and_fine_times(spark):
    rows = [(1, None, 1, "2024-01-01 00:00:00.000100"), (1, None, 2, "2024-01-01 00:00:00.000900"), (2, "x", 1, "2024-01-01 00:00:00")]
    got = ch.apply_changes(_rows(spark, rows), ["k", "j"], "seq", scd=2).collect()
    assert sorted((r.k, r.j or "", r["__START_AT"], r["__END_AT"]) for r in got) == [(1, "", 1, 2), (1, "", 2, None), (2, "x", 1, None)]


def test_compaction_changes_no_answer(spark, tmp_path):
    log = ChangeLog(spark, str(tmp_path / "log"), ["k"], "seq")
    for i, rows in enumerate([[(1, 1, "a", "put"), (2, 1, "b", "put")], [(1, 2, None, "put"), (9, 3, None, "cut")], [(3, 4, "c", "put")]]):
        log.append(spark.createDataFrame(rows, "k INT, seq INT, v STRING, op STRING"), i)
    reads = [{"truncate_when": "op = 'cut'"}, {"scd": 2}, {"ignore_null_updates": True}, {}]
    before = [sorted(map(str, log.current(**dict(r)).collect())) for r in reads]
    log.compact()
    assert [sorted(map(str, log.current(**dict(r)).collect())) for r in reads] == before
