"""Faults of the incremental paths, on literal documents: clashing keys over
batches, reserved names, keys no path can spell, the change stream, the header
stream and skipped lines."""

import json

import pytest

from sheaf.functions import variant as fv
from sheaf.operators import explode as ex
from sheaf.operators import pivot as pv
from sheaf.plans import medallion as md
from sheaf.session import publish
from sheaf.sources import documents as docs
from sheaf.streaming import runner as rn

ODD_KEYS = ["both\"and'", "what?", "a.b", "x[0]", "", " lead", "q'x", "\u00e9", "a b"]


def _doc(did, resource, meta=None, time="2024-01-01T00:00:00Z"):
    entry = [{"fullUrl": f"u-{did}", "resource": {"resourceType": "T", **resource}}]
    return json.dumps({"resourceType": "Bundle", "id": did, "timestamp": time, "Meta": meta or {}, "entry": entry})


def _land(spark, tmp_path, name, text):
    land = tmp_path / "land"
    land.mkdir(exist_ok=True)
    (land / name).write_text(text)
    rn.ingest_documents(spark, str(land), str(tmp_path / "bronze"), str(tmp_path / "ck"))
    return str(tmp_path / "bronze")


def test_keys_keep_their_columns_over_batches(spark, tmp_path):
    root, ck = str(tmp_path / "silver"), str(tmp_path / "ck-silver")
    reserved = {"batch_id": 7, "_seq": 8, "_del": 9, "entry_pos": 5}
    for name, res in (("a", {"code": 1}), ("b", {"Code": 2}), ("c", {"CODE": 3, "Code": 4, **reserved}), ("d", {"code": 5})):
        bronze = _land(spark, tmp_path, f"{name}.json", _doc(name, res))
        rn.silver_stream(spark, bronze, root, ck)
    names = rn.key_columns(spark, f"{root}/T")
    assert len({c.lower() for c in names.values()}) == len(names) == 7
    t = pv.typed(rn.silver_table(spark, root, "T"), {c: "int" for c in names.values()})
    got = {r["T_uuid"]: {k: r[c] for k, c in names.items() if r[c] is not None} for r in t.collect()}
    assert got == {"u-a": {"code": 1}, "u-b": {"Code": 2}, "u-c": {"CODE": 3, "Code": 4, **reserved}, "u-d": {"code": 5}}


def test_header_stream_equals_the_rebuilt_table(spark, tmp_path):
    root, ck = str(tmp_path / "header"), str(tmp_path / "ck-header")
    for i, meta in enumerate(({"S": "x"}, {"s": "y", "batch_id": 3}, {}, {"S": "z"})):
        bronze = _land(spark, tmp_path, f"{i}.json", _doc(str(i), {}, meta))
        rn.header_stream(spark, bronze, root, ck)
    rn.header_stream(spark, bronze, root, ck)  # nothing new
    names = rn.key_columns(spark, root)
    t = pv.typed(rn.header_table(spark, root), {c: "string" for c in names.values()})
    got = {r["bundle_id"]: {k: r[c] for k, c in names.items() if r[c] is not None} for r in t.collect()}
    assert got == {"0": {"S": "x"}, "1": {"s": "y", "batch_id": "3"}, "3": {"S": "z"}}
    rebuilt = md.header_silver(None, bronze=spark.read.parquet(bronze))
    assert {r.bundle_id for r in rebuilt.collect()} == set(got)


def test_incremental_run_has_a_header_table(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "a.json").write_text(_doc("a", {"x": 1}, {"S": "x"}))
    paths = md.refresh_all(spark, str(land), str(tmp_path / "lake"), incremental=True)
    assert [r.bundle_id for r in rn.header_table(spark, paths["silver_header"]).collect()] == ["a"]


@pytest.mark.parametrize("method", ["entries", "project", "long"])
def test_keys_no_path_can_spell(spark, method, docs_dir):
    res = {k: i for i, k in enumerate(ODD_KEYS)}
    bronze = docs.to_bronze(docs.read_documents(spark, docs_dir({"a.json": _doc("a", res, res)})), "t", id_mode="content")
    if method == "long":
        w = pv.pivot_resource(ex.explode_fields(bronze), "T", ODD_KEYS)
    else:
        w = pv.pivot_resource(None, "T", ODD_KEYS, method="project" if method == "project" else "regroup", entries=ex.explode_entries(bronze))
    h = pv.pivot_header(None, ODD_KEYS, method="project", bronze=bronze)
    for wide, skip in ((w, 3), (h, len(pv.HEADER_GROUP))):
        row = wide.select(*[fv.field(fv.col_of(c), "$", "int") for c in wide.columns[skip:]]).first()
        assert list(row) == list(range(len(ODD_KEYS)))


def test_change_stream_emits_a_replayed_batch_once(spark, tmp_path):
    log = rn.ChangeLog(spark, str(tmp_path / "log"), keys="k", sequence_by="seq")
    b1 = spark.createDataFrame([(2, 1, "new")], "k INT, seq INT, added STRING")
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    log.append(spark.createDataFrame([(1, 1)], "k INT, seq INT"), 0)
    for _ in range(3):
        log.append(b1, 1)
        changes = rn.stream_changes(spark, log.path)
        rn.run_stream(changes, out, ck)
    got = sorted((r.k, r.added) for r in rn.read_sink(spark, out, changes.schema).collect())
    assert got == [(1, None), (2, "new")]


def test_publish_is_whole_and_once(spark, tmp_path):
    path = str(tmp_path / "t" / "batch_id=0")
    bad = spark.range(3).selectExpr("assert_true(id < 2)", "id")
    with pytest.raises(Exception):
        publish(bad, path)
    assert not (tmp_path / "t" / "batch_id=0").exists()
    assert publish(spark.range(3), path) and not publish(spark.range(9), path)
    assert spark.read.parquet(str(tmp_path / "t")).count() == 3


@pytest.mark.parametrize("end", ["\n", "\r\n", "\r"])
@pytest.mark.parametrize("last", [True, False])
def test_skipped_lines_end_as_lines_do(spark, docs_dir, end, last):
    path = docs_dir({"a.txt": end.join(["head", "one", "", "two"]) + (end if last else "")})
    for skip, left in ((1, ["one", "", "two"]), (2, ["", "two"]), (4, []), (9, [])):
        got = [r.value for r in docs.read_documents(spark, path, whole_text=False, skip_rows=skip).collect()]
        assert got == left
        whole = docs.read_documents(spark, path, whole_text=True, skip_rows=skip).first().value
        assert whole == (end.join(left) + (end if last and left else ""))
    assert len(docs.read_documents(spark, path, whole_text=False).collect()) == 4
