"""Property: the summaries equal a brute-force count over the JSON documents,
for documents of any shape (entry as array or object, entries that are not
objects, resources that are arrays or scalars, missing types)."""

import json
from collections import Counter, defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sheaf.operators import explode as ex
from sheaf.operators import summaries as sm
from sheaf.sources import documents as docs

rtype = st.one_of(st.sampled_from(["A", "B"]), st.none())
obj_resource = st.builds(
    lambda t, extra: ({"resourceType": t} if t is not None else {}) | extra,
    rtype,
    st.dictionaries(st.sampled_from(["p", "q", "r"]), st.integers(0, 3), max_size=2),
)
resource = st.one_of(obj_resource, obj_resource, st.lists(st.integers(0, 3), max_size=2), st.integers(0, 3))
entry = st.one_of(
    st.fixed_dictionaries({"resource": resource}, optional={"fullUrl": st.sampled_from(["u1", "u2"])}),
    st.integers(0, 3),
)
entries = st.one_of(st.lists(entry, max_size=4), st.dictionaries(st.sampled_from(["m", "n"]), entry, max_size=2), st.integers(0, 1))
document = st.fixed_dictionaries({"id": st.sampled_from(["a", "b"])}, optional={"entry": entries})


def brute(documents):
    type_docs = defaultdict(set)
    type_keys = Counter()
    for i, d in enumerate(documents):
        e = d.get("entry")
        items = e if isinstance(e, list) else [e[k] for k in sorted(e)] if isinstance(e, dict) else []
        for it in items:
            res = it.get("resource") if isinstance(it, dict) else None
            if isinstance(res, dict):
                t = res.get("resourceType")
                for k in res:
                    type_docs[t].add(i)
                    type_keys[(t, k)] += 1
            elif isinstance(res, list):
                for _ in res:
                    type_docs[None].add(i)
                    type_keys[(None, None)] += 1
    return {t: len(v) for t, v in type_docs.items()}, dict(type_keys)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(documents=st.lists(document, min_size=1, max_size=6))
def test_summaries_equal_brute_force(spark, tmp_path_factory, documents):
    d = tmp_path_factory.mktemp("sum")
    for i, doc in enumerate(documents):
        (d / f"{i}.json").write_text(json.dumps(doc))
    b = docs.to_bronze(docs.read_documents(spark, str(d)), "t", id_mode="content")
    f = ex.explode_fields(b)
    types = {r.resourceType: r.raw_bundle_count for r in sm.resource_types(f).collect()}
    keys = {(r.resourceType, r.key): r["count"] for r in sm.resource_type_keys(f).collect()}
    exp_types, exp_keys = brute(documents)
    assert types == exp_types
    assert keys == exp_keys
    assert sm.discover_types(sm.resource_types(f)) == sorted(t for t in exp_types if t is not None)
