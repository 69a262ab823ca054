"""Streaming runners: rerun adds nothing, new files add rows, stream equals
batch, change log survives replays."""

import json


from sheaf.operators import explode as ex
from sheaf.operators import pivot as pv
from sheaf.operators import summaries as sm
from sheaf.sources import documents as docs
from sheaf.streaming import runner as rn


def _doc(did, entries):
    return json.dumps({"resourceType": "Bundle", "id": did, "timestamp": "2024-01-01T00:00:00Z", "Meta": {"S": did}, "entry": entries})


def test_ingest_rerun_and_new_key(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.json").write_text(_doc("a", [{"fullUrl": "u1", "resource": {"resourceType": "T", "x": 1}}]))
    bronze, ck = str(tmp_path / "bronze"), str(tmp_path / "ck")
    rn.ingest_documents(spark, str(land), bronze, ck, max_bytes="10g")
    assert spark.read.parquet(bronze).count() == 1
    rn.ingest_documents(spark, str(land), bronze, ck)  # rerun: nothing new
    assert spark.read.parquet(bronze).count() == 1
    (land / "b.json").write_text(_doc("b", [{"fullUrl": "u2", "resource": {"resourceType": "T", "x": 2, "y": "new"}}]))
    rn.ingest_documents(spark, str(land), bronze, ck)
    b = spark.read.parquet(bronze)
    assert b.count() == 2
    # the new key becomes a column on refresh; NULL for the old row
    f = ex.explode_fields(b)
    keys = sm.type_key_dict(sm.resource_type_keys(f))["T"]
    assert keys == ["x", "y"]
    w = pv.typed(pv.pivot_resource(f, "T", keys), {"x": "int", "y": "string"})
    assert sorted((r.x, r.y) for r in w.collect()) == [(1, None), (2, "new")]


def test_stream_equals_batch(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    for i in range(5):
        entries = [{"fullUrl": f"u{i}-{j}", "resource": {"resourceType": "T" if j % 2 else "S", "n": j}} for j in range(3)]
        (land / f"{i}.json").write_text(_doc(str(i), entries))
    bronze = str(tmp_path / "bronze")
    rn.ingest_documents(spark, str(land), bronze, str(tmp_path / "ck1"), max_files=2)
    rn.explode_stream(spark, bronze, str(tmp_path / "fields"), str(tmp_path / "header"), str(tmp_path / "ck2"))
    streamed = spark.read.parquet(str(tmp_path / "fields"))
    batch = ex.explode_fields(docs.to_bronze(docs.read_documents(spark, str(land)), "x", id_mode="content"))
    cols = ["bundle_id", "fullUrl", "resourceType", "entry_pos", "pos", "key"]
    assert sorted(streamed.select(*cols).collect()) == sorted(batch.select(*cols).collect())
    rn.pivot_stream(spark, bronze, "T", ["n"], str(tmp_path / "stage"), str(tmp_path / "ck3"))
    stage = spark.read.parquet(str(tmp_path / "stage"))
    assert stage.count() == 5


def test_change_log_replay_is_harmless(spark, tmp_path):
    log = rn.ChangeLog(spark, str(tmp_path / "log"), keys="k", sequence_by="seq")
    b0 = spark.createDataFrame([(1, 1, "a"), (2, 1, "b")], "k INT, seq INT, v STRING")
    b1 = spark.createDataFrame([(1, 2, "c")], "k INT, seq INT, v STRING")
    log.append(b0, 0)
    log.append(b1, 1)
    log.append(b1, 1)  # replayed batch overwrites its own folder
    cur = sorted(tuple(r) for r in log.current().collect())
    assert cur == [(1, 2, "c"), (2, 1, "b")]


def test_landing_inventory(spark, tmp_path):
    land = tmp_path / "land" / "day1"
    land.mkdir(parents=True)
    (land / "a.json").write_text("{}")
    (land / "b.json").write_text("{\"a\": 1}")
    inv = docs.landing_inventory(spark, str(tmp_path / "land")).collect()
    assert len(inv) == 1 and inv[0].files == 2 and inv[0].bytes == 2 + 8


def test_change_log_compaction_keeps_state_and_tombstones(spark, tmp_path):
    log = rn.ChangeLog(spark, str(tmp_path / "log"), keys="k", sequence_by="seq")
    s = "k INT, seq INT, v STRING, op STRING"
    log.append(spark.createDataFrame([(1, 1, "a", "u"), (2, 1, "b", "u"), (3, 5, None, "d")], s), 0)
    log.append(spark.createDataFrame([(1, 2, "c", "u")], s), 1)
    before = sorted(tuple(r) for r in log.current(delete_when="op = 'd'").collect())
    assert log.compact() == 1
    assert sorted(tuple(r) for r in log.current(delete_when="op = 'd'").collect()) == before
    # an older change for a deleted key arrives later: the tombstone still wins
    log.append(spark.createDataFrame([(3, 2, "old", "u"), (2, 3, "B", "u")], s), 2)
    after = sorted(tuple(r) for r in log.current(delete_when="op = 'd'").collect())
    assert after == [(1, 2, "c", "u"), (2, 3, "B", "u")]


def test_sql_explode_runs_on_a_stream(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.json").write_text(_doc("a", [{"fullUrl": "u1", "resource": {"resourceType": "T", "x": 1, "y": 2}}]))
    bronze = str(tmp_path / "bronze")
    rn.ingest_documents(spark, str(land), bronze, str(tmp_path / "ck1"))
    fields = ex.explode_fields_sql(rn.stream_table(spark, bronze))
    assert fields.isStreaming
    rn.run_stream(fields.drop("value"), str(tmp_path / "fields"), str(tmp_path / "ck2"))
    got = sorted((r.key, r.pos) for r in spark.read.parquet(str(tmp_path / "fields")).collect())
    assert got == [("resourceType", 0), ("x", 1), ("y", 2)]
    assert ex.explode_header_sql(spark.read.parquet(bronze)).count() == 1


def test_refresh_all_runs_every_layer_and_reruns_cleanly(spark, tmp_path):
    from sheaf.plans import medallion as md

    land = tmp_path / "land"
    land.mkdir()
    (land / "a.json").write_text(_doc("a", [{"fullUrl": "u1", "resource": {"resourceType": "T", "x": 1}}]))
    base = str(tmp_path / "lake")
    paths = md.refresh_all(spark, str(land), base)
    assert spark.read.parquet(paths["silver/T"]).count() == 1
    assert spark.read.parquet(paths["silver_header"]).count() == 1
    md.refresh_all(spark, str(land), base)  # no new files: nothing appended
    assert spark.read.parquet(paths["bronze"]).count() == 1
    assert spark.read.parquet(paths["silver/T"]).count() == 1
    (land / "b.json").write_text(_doc("b", [{"fullUrl": "u2", "resource": {"resourceType": "T", "x": 2, "z": "new"}}]))
    paths = md.refresh_all(spark, str(land), base)
    t = spark.read.parquet(paths["silver/T"])
    assert "z" in t.columns and t.count() == 2
    kinds = {r.resourceType: r.raw_bundle_count for r in spark.read.parquet(paths["resource_types"]).collect()}
    assert kinds == {"T": 2}


def test_change_log_versions_and_feed(spark, tmp_path):
    log = rn.ChangeLog(spark, str(tmp_path / "log"), keys="k", sequence_by="seq")
    s = "k INT, seq INT, v STRING, op STRING"
    log.append(spark.createDataFrame([(1, 1, "a", "u"), (2, 1, "b", "u")], s), 0)
    log.append(spark.createDataFrame([(1, 2, "c", "u"), (2, 2, None, "d"), (3, 1, "n", "u")], s), 1)
    v0 = sorted(tuple(r) for r in log.state_at(0, delete_when="op = 'd'", except_columns=["op"]).collect())
    assert v0 == [(1, 1, "a"), (2, 1, "b")]
    feed = sorted(
        (r.k, r.v, r._change_type) for r in log.feed(0, 1, delete_when="op = 'd'", except_columns=["op"]).collect()
    )
    assert feed == [(1, "a", "update_preimage"), (1, "c", "update_postimage"), (2, "b", "delete"), (3, "n", "insert")]


def test_refresh_all_on_an_empty_folder_builds_nothing(spark, tmp_path):
    from sheaf.plans import medallion as md

    land = tmp_path / "empty"
    land.mkdir()
    assert md.refresh_all(spark, str(land), str(tmp_path / "lake")) == {}


def test_incremental_silver_over_batches_with_a_new_key(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.json").write_text(_doc("a", [{"fullUrl": "u1", "resource": {"resourceType": "T", "x": 1}}]))
    bronze, root = str(tmp_path / "bronze"), str(tmp_path / "silver")
    rn.ingest_documents(spark, str(land), bronze, str(tmp_path / "ck1"))
    rn.silver_stream(spark, bronze, root, str(tmp_path / "ck2"))
    (land / "b.json").write_text(_doc("b", [{"fullUrl": "u2", "resource": {"resourceType": "T", "x": 2, "y": "new"}},
                                             {"fullUrl": "u2", "resource": {"resourceType": "T", "x": 9}}]))
    rn.ingest_documents(spark, str(land), bronze, str(tmp_path / "ck1"))
    rn.silver_stream(spark, bronze, root, str(tmp_path / "ck2"))
    rn.silver_stream(spark, bronze, root, str(tmp_path / "ck2"))  # rerun: nothing new
    t = pv.typed(rn.silver_table(spark, root, "T"), {"x": "int", "y": "string"})
    assert sorted((r.T_uuid, r.x, r.y) for r in t.collect()) == [("u1", 1, None), ("u2", 2, "new")]
    assert "bundle_timestamp" not in t.columns


def test_refresh_all_incremental_matches_rebuild(spark, tmp_path):
    from sheaf.plans import medallion as md

    land = tmp_path / "land"
    land.mkdir()
    for i in range(3):
        entries = [{"fullUrl": f"u{i}-{j}", "resource": {"resourceType": "T", "n": j, **({"z": i} if i == 2 else {})}} for j in range(2)]
        (land / f"{i}.json").write_text(_doc(str(i), entries))
        inc = md.refresh_all(spark, str(land), str(tmp_path / "inc"), incremental=True)
    full = md.refresh_all(spark, str(land), str(tmp_path / "full"))
    a = pv.comparable(rn.silver_table(spark, inc["silver"], "T")).drop("bundleUUID")
    b = pv.comparable(spark.read.parquet(full["silver/T"])).drop("bundleUUID")
    key = lambda r: tuple((x is None, str(x)) for x in r)
    assert sorted((tuple(r) for r in a.select(*b.columns).collect()), key=key) == sorted((tuple(r) for r in b.collect()), key=key)


def test_compaction_while_streaming_keeps_the_state(spark, tmp_path):
    s = "k INT, seq INT, v STRING"
    land = tmp_path / "changes"
    rows = [(i % 3, i, f"v{i}") for i in range(12)]
    for i in range(4):  # four files, one per micro-batch
        spark.createDataFrame(rows[i * 3:(i + 1) * 3], s).coalesce(1).write.mode("append").parquet(str(land))
    stream = lambda: spark.readStream.schema(s).option("maxFilesPerTrigger", "1").parquet(str(land))
    plain = rn.ChangeLog(spark, str(tmp_path / "plain"), keys="k", sequence_by="seq")
    plain.stream_into(stream(), str(tmp_path / "ck1"))
    packed = rn.ChangeLog(spark, str(tmp_path / "packed"), keys="k", sequence_by="seq")
    packed.stream_into(stream(), str(tmp_path / "ck2"), compact_every=2)
    assert packed._snapshot() is not None
    assert sorted(tuple(r) for r in packed.current().collect()) == sorted(tuple(r) for r in plain.current().collect())
    assert sorted(tuple(r) for r in plain.current().collect()) == [(0, 9, "v9"), (1, 10, "v10"), (2, 11, "v11")]


def test_command_line_refresh(spark, tmp_path, capsys):
    import json as _json

    from sheaf.__main__ import main

    land = tmp_path / "land" / "in"
    land.mkdir(parents=True)
    (land / "a.json").write_text(_doc("a", [{"fullUrl": "u1", "resource": {"resourceType": "T", "x": 1}},
                                            {"fullUrl": "u2", "resource": {"resourceType": "S", "y": 2}}]))
    paths = main(["refresh", "--source", str(tmp_path / "land"), "--sub-folder", "in", "--base", str(tmp_path / "lake"),
                  "--types", "T"], spark=spark)
    assert _json.loads(capsys.readouterr().out.strip().splitlines()[-1]) == paths
    assert "silver/T" in paths and "silver/S" not in paths
    assert spark.read.parquet(paths["silver/T"]).count() == 1


def test_refresh_all_with_documents_without_entries(spark, tmp_path):
    from sheaf.plans import medallion as md

    land = tmp_path / "land"
    land.mkdir()
    (land / "a.json").write_text(json.dumps({"id": "a", "timestamp": "2024-01-01T00:00:00Z", "Meta": {"K": 1}}))
    paths = md.refresh_all(spark, str(land), str(tmp_path / "lake"))
    assert spark.read.parquet(paths["silver_header"]).count() == 1
    assert not any(k.startswith("silver/") for k in paths)


def test_incremental_silver_with_odd_key_names_and_compaction(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.json").write_text(_doc("a", [{"fullUrl": "u1", "resource": {"resourceType": "T", "a.b": 1, "c d": "x"}}]))
    bronze, root = str(tmp_path / "bronze"), str(tmp_path / "silver")
    rn.ingest_documents(spark, str(land), bronze, str(tmp_path / "ck1"))
    rn.silver_stream(spark, bronze, root, str(tmp_path / "ck2"), compact_every=1)
    (land / "b.json").write_text(_doc("b", [{"fullUrl": "u2", "resource": {"resourceType": "T", "a.b": 2}}]))
    rn.ingest_documents(spark, str(land), bronze, str(tmp_path / "ck1"))
    rn.silver_stream(spark, bronze, root, str(tmp_path / "ck2"), compact_every=1)
    t = pv.typed(rn.silver_table(spark, root, "T"), {"a.b": "int", "c d": "string"})
    assert sorted((r["T_uuid"], r["a.b"], r["c d"]) for r in t.collect()) == [("u1", 1, "x"), ("u2", 2, None)]


def test_change_log_replay_after_a_crash_leaves_no_duplicates(spark, tmp_path):
    """A batch that fails after writing is replayed on restart with the same
    id; its folder is overwritten, so no row is doubled."""
    import pytest

    s = "k INT, seq INT, v STRING"
    land = tmp_path / "changes"
    rows = [(i % 2, i, f"v{i}") for i in range(6)]
    for i in range(3):
        spark.createDataFrame(rows[i * 2:(i + 1) * 2], s).coalesce(1).write.mode("append").parquet(str(land))
    log = rn.ChangeLog(spark, str(tmp_path / "log"), keys="k", sequence_by="seq")
    crashed = {"done": False}

    def flaky(batch, batch_id):
        log.append(batch, batch_id)
        if batch_id == 1 and not crashed["done"]:
            crashed["done"] = True
            raise RuntimeError("crash after the write, before the commit")

    stream = lambda: spark.readStream.schema(s).option("maxFilesPerTrigger", "1").parquet(str(land))
    with pytest.raises(Exception):
        rn.run_batches(stream(), flaky, str(tmp_path / "ck"))
    rn.run_batches(stream(), flaky, str(tmp_path / "ck"))  # restart: batch 1 replays
    assert log.changes().count() == len(rows)
    assert sorted(tuple(r) for r in log.current().collect()) == [(0, 4, "v4"), (1, 5, "v5")]


def test_change_log_history_read(spark, tmp_path):
    from sheaf.operators import changes as ch

    s = "k INT, seq INT, v STRING"
    log = rn.ChangeLog(spark, str(tmp_path / "log"), keys="k", sequence_by="seq")
    log.append(spark.createDataFrame([(1, 1, "a"), (1, 2, "a")], s), 0)
    log.append(spark.createDataFrame([(1, 3, "b")], s), 1)
    hist = log.current(scd=2, track=["v"])
    assert "batch_id" not in hist.columns
    got = sorted((r.k, r.v, r[ch.START_AT], r[ch.END_AT]) for r in hist.collect())
    assert got == [(1, "a", 1, 3), (1, "b", 3, None)]


def test_expectations_on_a_stream_report_per_batch_metrics(spark, tmp_path):
    from sheaf.operators import quality as q

    land = tmp_path / "land"
    land.mkdir()
    (land / "a.json").write_text(_doc("a", [{"fullUrl": "u1", "resource": {"resourceType": "T", "x": 1}},
                                            {"resource": {"resourceType": "T", "x": 2}}]))
    bronze = str(tmp_path / "bronze")
    rn.ingest_documents(spark, str(land), bronze, str(tmp_path / "ck1"))
    entries = ex.explode_entries(rn.stream_table(spark, bronze)).select("bundleUUID", "fullUrl")
    checked, obs = q.expect(entries, drop={"valid_url": "fullUrl IS NOT NULL"}, name="entry_checks")
    assert obs is None
    query = rn.run_stream(checked, str(tmp_path / "out"), str(tmp_path / "ck2"))
    progress = [p for p in query.recentProgress if p.get("observedMetrics")]
    assert progress and progress[-1]["observedMetrics"]["entry_checks"]["valid_url_failed"] == 1
    assert spark.read.parquet(str(tmp_path / "out")).count() == 1
