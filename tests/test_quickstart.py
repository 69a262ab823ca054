"""The README quick start runs as written and gives the expected tables."""

import json

import sheaf


def test_quick_start(spark, tmp_path):
    land = tmp_path / "landing"
    land.mkdir()
    docs = [
        {"resourceType": "Bundle", "id": "b1", "timestamp": "2024-01-01T00:00:00Z", "Meta": {"EventType": "NewPatient"},
         "entry": [{"fullUrl": "urn:p:1", "resource": {"resourceType": "Patient", "name": "Ann", "active": True}},
                   {"fullUrl": "urn:o:1", "resource": {"resourceType": "Observation", "value": 7}}]},
        {"resourceType": "Bundle", "id": "b2", "timestamp": "2024-01-02T00:00:00Z", "Meta": {"EventType": "Update"},
         "entry": [{"fullUrl": "urn:p:2", "resource": {"resourceType": "Patient", "name": "Bo"}}]},
    ]
    for i, d in enumerate(docs):
        (land / f"{i}.json").write_text(json.dumps(d))

    raw = sheaf.read_documents(spark, str(land))
    bronze = sheaf.to_bronze(raw, str(land) + "/")
    fields = sheaf.explode_fields(bronze)
    header = sheaf.explode_header(bronze)
    assert {(r.resourceType, r.raw_bundle_count) for r in sheaf.resource_types(fields).collect()} == {("Patient", 2), ("Observation", 1)}
    keys = sheaf.type_key_dict(sheaf.resource_type_keys(fields))
    assert keys == {"Observation": ["value"], "Patient": ["active", "name"]}
    patients = sheaf.typed(sheaf.resource_silver(fields, "Patient", keys["Patient"]), {"name": "string", "active": "boolean"})
    assert sorted((r.Patient_uuid, r.name, r.active) for r in patients.collect()) == [("urn:p:1", "Ann", True), ("urn:p:2", "Bo", None)]
    hs = sheaf.typed(sheaf.header_silver(header), {"EventType": "string"})
    assert sorted((r.bundle_id, r.EventType) for r in hs.collect()) == [("b1", "NewPatient"), ("b2", "Update")]
