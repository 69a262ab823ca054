"""Properties of the streaming path: for any documents and any admission
limit, streaming ingest + explode equals the batch computation; malformed
files are quarantined, not lost."""

import json

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sheaf.operators import explode as ex
from sheaf.sources import documents as docs
from sheaf.streaming import runner as rn

scalar = st.one_of(st.none(), st.integers(-3, 3), st.text(alphabet="xyü", max_size=2))
resource = st.fixed_dictionaries({"resourceType": st.sampled_from(["A", "B"])}, optional={"p": scalar, "q": scalar})
entry = st.fixed_dictionaries({"resource": resource}, optional={"fullUrl": st.sampled_from(["u1", "u2", "u3"])})
document = st.fixed_dictionaries(
    {"id": st.text(alphabet="abc", min_size=1, max_size=3), "timestamp": st.just("2024-01-01T00:00:00Z")},
    optional={"entry": st.lists(entry, max_size=4), "Meta": st.dictionaries(st.sampled_from(["K", "L"]), scalar, max_size=2)},
)


@settings(max_examples=5, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(documents=st.lists(document, min_size=1, max_size=6), max_files=st.integers(1, 3))
def test_stream_equals_batch(spark, tmp_path_factory, documents, max_files):
    d = tmp_path_factory.mktemp("s")
    land = d / "land"
    land.mkdir()
    for i, doc in enumerate(documents):
        (land / f"{i}.json").write_text(json.dumps(doc))
    bronze = str(d / "bronze")
    rn.ingest_documents(spark, str(land), bronze, str(d / "ck1"), max_files=max_files)
    fields, header = rn.explode_stream(spark, bronze, str(d / "fields"), str(d / "header"), str(d / "ck2"))
    batch_bronze = docs.to_bronze(docs.read_documents(spark, str(land)), "x", id_mode="content")
    cols = ["bundle_id", "fullUrl", "resourceType", "entry_pos", "pos", "key"]
    key = lambda t: tuple((x is None, str(x)) for x in t)
    for streamed, batch in (
        (fields.select(*cols), ex.explode_fields(batch_bronze).select(*cols)),
        (header.select("bundle_id", "pos", "key"), ex.explode_header(batch_bronze).select("bundle_id", "pos", "key")),
    ):
        assert sorted((tuple(r) for r in streamed.collect()), key=key) == sorted((tuple(r) for r in batch.collect()), key=key)


def test_streaming_quarantine_routes_malformed_files(spark, tmp_path):
    land = tmp_path / "land"
    land.mkdir()
    (land / "good.json").write_text(json.dumps({"id": "g", "entry": [{"fullUrl": "u", "resource": {"resourceType": "A", "p": 1}}]}))
    (land / "bad.json").write_text('{"id": "b", "entry": [')
    bronze = str(tmp_path / "bronze")
    rn.ingest_documents(spark, str(land), bronze, str(tmp_path / "ck"), on_error="quarantine")
    good, rejects = docs.split_rejects(spark.read.parquet(bronze))
    assert [r.inputFileName for r in rejects.collect()] == ["bad.json"]
    assert ex.explode_fields(good).count() == 2
