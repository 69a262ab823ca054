"""The operators on training data against plain Python, on small tables with
NULLs, empty texts, repeated rows, ties and clashing column names."""

import hashlib
import os
import re
import sys
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_check import compare, duck  # noqa: E402

from sheaf.llm import (  # noqa: E402
    decontam, line_dedup, line_quality, mixing, ngram_join, pii, queries, suffix_dedup, training_order, url_reputation, warc,
)
from sheaf.llm.common import mix, table  # noqa: E402

SF = "/root/testdata/sf0.001"
LONG = " ".join(f"w{i % 997}x{i // 997}" for i in range(9000))
DOCS = [
    (1, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", "b", 0),
    (2, "Alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu", "en", None, 0),
    (3, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu", "en", "a", 0),
    (3, "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu", "en", "a", 0),
    (4, "", "en", "a", 0), (5, None, None, None, None), (6, "one two", "en", "b", 0), (7, "one  two", "en", "b", 0),
    (None, "one two three four five six", "en", "c", 0), (8, LONG, "en", "c", 0), (9, LONG + " tail", "en", "a", 0),
    (10, "the same line of words here.\nthe same line of words here.\nmenu | a | b | c\nother", "en", "c", 0),
]


@pytest.fixture(scope="module")
def docs(spark):
    df = spark.createDataFrame(DOCS, "doc_id long, text string, lang string, source string, n_chars long")
    return df.withColumn("node", F.lit("clash")).withColumn("kept", F.lit(1)).withColumn("t", F.lit(2)).withColumn("_words", F.lit(3))


@pytest.fixture(scope="module")
def empty(docs):
    return docs.limit(0)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_oracle(spark, name):
    ok, _, _, detail = compare(spark, duck(SF), name, queries.QUERIES[name], queries.ORACLE_SQL[name], SF)
    assert ok, detail


def test_url_rules_and_reputation(spark):
    urls = [None, "no scheme", "HTTP://WWW.Example.com/en/x?y", "http://a.example.com/en/1", "http://x.com", "ftp://x.net/es/a#b", "a://b://c/d"]
    pages = spark.createDataFrame([(i, u, "clash") for i, u in enumerate(urls)], "page_id long, url string, host string")
    labels = spark.createDataFrame([(5, 1), (5, None), (6, 1)], "page_id long, bad int")
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_reputation.judge(pages, labels).collect()}
    assert got[0][:3] == got[1][:3] == ("", "", None)
    assert got[2] == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert got[3] == ("a.example.com", "/en/1", "example.com/en/", "block")
    assert got[4][:3] == ("x.com", "", None) and got[5] == ("x.net", "/es/a", "net/es/", "block") and got[6][:2] == ("b:", "//c/d")
    many = spark.createDataFrame([(i, f"http://{'bad' if i < 40 else 'good'}.org/{i}") for i in range(80)], "page_id long, url string")
    out = {r.host: r.verdict for r in url_reputation.judge(many, spark.createDataFrame([(i, int(i < 40)) for i in range(80)], "page_id long, bad int")).collect()}
    assert out == {"bad.org": "block", "good.org": "allow"}
    assert url_reputation.judge(pages.limit(0), labels.limit(0)).count() == 0


def test_warc_round_trip_is_deterministic(spark, tmp_path):
    big = "é" * 600
    rows = [(1, "http://a/ b\n", big), (2, None, big), (3, "u", None), (4, "u", ""), (5, "u", "x" * 999), (6, "u", "x" * 999), (6, "u", big), (None, "u", big)]
    pages = spark.createDataFrame([(*r, 1) for r in rows], "page_id long, url string, html string, shard int")
    shas = []
    for k, parts in enumerate((1, 3)):
        root = str(tmp_path / f"w{k}")
        manifest = warc.write(pages.repartition(parts), root, max_bytes=200)
        shas.append(sorted((r.name, r.sha256) for r in manifest.collect()))
        got = sorted(((r.page_id or 0), r.payload_bytes, r.record_type, r.refers_to) for r in warc.read(manifest, root).collect())
    assert shas[0] == shas[1]
    assert got == [(0, 1200, "revisit", 6), (1, 1200, "revisit", 6), (2, 1200, "revisit", 6), (3, 0, "response", None), (4, 0, "response", None),
                   (5, 999, "response", None), (6, 999, "response", None), (6, 1200, "response", None)]
    assert warc.round_trip(pages.limit(0), str(tmp_path / "none")).count() == 0


def _base_spans(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text):
        out.append(("email", *m.span()))
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text):
        if all(int(p) <= 255 for p in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and pii.luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return out


def test_personal_data_base_spans(spark):
    texts = [r["text"] or "" for r in table(spark, SF, "documents").select("text").collect()]
    texts += ["a@b.c@d.e x@@y.z é1.2.3.4.5 +1 (212) 555-0100 4111 1111 1111 1111 1.2.3.4x +49 30 1234567 10.0.0.1", "", "@" * 50, "1" * 5000]
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)] + [(-1, None, None)], "doc_id long, text string, spans string")
    for r in pii.personal_data(df).collect():
        spans = sorted(_base_spans(texts[r.doc_id] if r.doc_id >= 0 else ""), key=lambda s: (s[1], pii.KINDS.index(s[0])))
        count = Counter(s[0] for s in spans)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(count[k] for k in pii.KINDS)
        listed = [f"{k}:{a}:{b}" for k, a, b in spans]
        assert r.base_sha256 == hashlib.sha256(",".join(listed).encode()).hexdigest()
        assert set(listed) <= set(r.spans.split(",")) | {""} or not listed


def test_reliabilities_follow_the_votes():
    counts = {("phone", "1111110"): 500, ("phone", "-1-1110"): 40, ("phone", "-0-0010"): 60, ("phone", "-00-000"): 200}
    p = pii.fit(counts)
    assert p["phone", "1111110"] > 0.9 > 0.5 > p["phone", "-00-000"]


def test_line_quality_cases(docs, empty):
    got = {(r.doc_id, r.n_words): r for r in line_quality.line_quality(docs).collect()}
    assert got[5, 0].base_failed and not got[5, 0].kept and got[4, 0].n_dup_lines == 0
    assert got[10, 20].n_dup_lines == 1 and got[10, 20].n_repeat_words == 12
    assert got[8, 9000].kept and line_quality.line_quality(empty).count() == 0
    kept = line_quality.clean(docs, "text", "n_chars")
    assert kept.columns == docs.columns


def test_shingle_join_by_brute_force(docs, empty):
    def shingles(t):
        w = re.split(r"[\x20\x09-\x0d]+", (t or "").strip(" \t\n\r\x0b\x0c"))
        w = [x.translate({c: c + 32 for c in range(65, 91)}) for x in w if x]
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()

    rows = [(d, shingles(t)) for d, t, *_ in DOCS]
    top = list(range(len(rows)))
    for _ in rows:
        for i, (_, a) in enumerate(rows):
            for j, (_, b) in enumerate(rows):
                if a and b and 100 * len(a & b) >= 75 * len(a | b):
                    top[i] = top[j] = min(top[i], top[j])
    expect = sorted((d or -1, len(s), min((rows[j][0] for j in range(len(rows)) if top[j] == top[i] and rows[j][0] is not None), default=-1)) for i, (d, s) in enumerate(rows))
    got = sorted((r.doc_id or -1, r.n_shingles, r.component_id if r.component_id is not None else -1) for r in ngram_join.near_duplicates(docs).collect())
    assert got == expect
    assert ngram_join.near_duplicates(empty).count() == 0


def test_hot_keys_take_the_second_index(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT", 1)
    monkeypatch.setattr(ngram_join, "BLOCK", 3)
    base = [f"b{i}" for i in range(60)]
    rows = []
    for d in range(24):
        ws = list(base)
        for k in range(d % 12):
            ws[(7 * k + d) % 60] = f"x{d}"
        rows.append((d, " ".join(ws)))
    sets = [{tuple(t.split()[i : i + 5]) for i in range(56)} for _, t in rows]
    comp = list(range(24))
    for _ in range(24):
        for i in range(24):
            for j in range(24):
                if 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    comp[i] = comp[j] = min(comp[i], comp[j])
    got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(comp))


@pytest.mark.parametrize("hot", [1, 16])
def test_candidates_of_two_families_grow_in_proportion(spark, monkeypatch, hot):
    """Two groups of near copies that share a passage and are not linked:
    pairs across them are not all looked at, and the groups are found."""
    monkeypatch.setattr(ngram_join, "HOT", hot)
    seen = []
    whole = ngram_join.likely
    monkeypatch.setattr(ngram_join, "likely", lambda pairs, *rest: (seen.append(pairs.count()), whole(pairs, *rest))[1])
    across = {}
    for n in (30, 90):
        passage = " ".join(f"p{i}" for i in range(40))
        rows = [(f * 1000 + k, " ".join(f"{'ab'[f]}{i}" for i in range(60)) + " " + passage + f" t{f}x{k}") for f in (0, 1) for k in range(n)]
        got = {r.doc_id: r.component_id for r in ngram_join.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
        assert got == {d: d // 1000 * 1000 for d, _ in rows}
        across[n] = seen[-1]
    assert across[90] <= 2 * hot * 180 * 8  # so many times its sets for a key, of a few keys
    assert across[90] <= 4 * max(across[30], 60)


def test_repeated_bytes_by_brute_force(spark, docs, empty):
    rows = [(d, t) for d, t, *_ in DOCS] + [(20, "q" * 400), (21, "zz" + "q" * 120 + "é" + LONG[40:200]), (22, "q" * 49)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    first = {}
    for d, t in rows:
        raw, key = (t or "").encode(), float("inf") if d is None else d
        for i in range(len(raw) - 49):
            first[raw[i : i + 50]] = min(first.get(raw[i : i + 50], key), key)
    expect = []
    for d, t in rows:
        raw, key = (t or "").encode(), float("inf") if d is None else d
        gone = np.zeros(len(raw) + 1, dtype=bool)
        for i in range(len(raw) - 49):
            if first[raw[i : i + 50]] < key:
                gone[i : i + 50] = True
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        expect.append((d or -1, len(raw), int(gone.sum()), int((gone[1:] & ~gone[:-1]).sum() + gone[0]), hashlib.sha256(kept).hexdigest()))
    got = sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in suffix_dedup.repeated_bytes(df).collect())
    assert got == sorted(expect)
    assert suffix_dedup.repeated_bytes(empty).count() == 0


def _lost_bytes(rows, length=50):
    """(id or -1, text hash, bytes removed, digest of the rest) by brute force."""
    order = lambda d: float("inf") if d is None else d
    first = {}
    for d, t in rows:
        raw = t.encode()
        for i in range(len(raw) - length + 1):
            first[raw[i : i + length]] = min(first.get(raw[i : i + length], order(d)), order(d))
    out = []
    for d, t in rows:
        raw = t.encode()
        gone = np.zeros(len(raw), dtype=bool)
        for i in range(len(raw) - length + 1):
            if first[raw[i : i + length]] < order(d):
                gone[i : i + length] = True
        kept = bytes(c for c, g in zip(raw, gone) if not g)
        out.append((-1 if d is None else d, len(raw), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out)


def _found_bytes(df):
    return sorted((-1 if r.doc_id is None else r.doc_id, r.n_bytes, r.n_removed, r.kept_sha256) for r in suffix_dedup.repeated_bytes(df).collect())


def test_repeated_bytes_of_documents_without_an_own_id(spark):
    """NULL ids and one repeated id, each with more texts than 8 bits tell
    apart, so equal one-byte marks are certain."""
    rng = np.random.default_rng(5)
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnop"), n))
    shared = [word(70) for _ in range(6)]
    rows = [(k, word(20) + x + word(30)) for k, x in enumerate(shared)]
    for k in range(300):
        parts = [word(int(rng.integers(40, 90))) for _ in range(3)]
        parts.insert(int(rng.integers(0, 4)), shared[k % 6])
        rows.append((None if k % 2 else 7, "".join(parts)))
    rows += rows[-2:]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    assert _found_bytes(df) == _lost_bytes(rows)


def test_hot_grams_by_brute_force(spark, monkeypatch):
    """A smaller document in a slice of its own holds runs equal to both marks
    of a hot gram, and shares more windows with the hot slice's other runs."""
    rng = np.random.default_rng(6)
    word = lambda n: "".join(rng.choice(list("abcdefghijklmnopqrstuvwxyz"), n))
    rows = []
    for case in range(12):
        core = word(64)
        ends = [(word(45), word(45)) for _ in range(2)]
        whole = [a + core + b for a, b in ends]
        d = 100 * case
        rows += [(d, word(60) + whole[0] + word(60) + whole[1] + word(60))]
        rows += [(d + 30 + k, word(55) + x + word(55)) for k, x in enumerate(whole)]
        rows += [(d + 20 + k, word(70) + core + word(70)) for k in range(4)]
    small = [r for r in rows if r[0] % 100 == 0]
    large = [r for r in rows if r[0] % 100]
    small += [(10_000 + k, word(80)) for k in range(len(large) - len(small))]  # the first batch
    every = _lost_bytes(small + large)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(len(large)))
    try:
        df = spark.createDataFrame(small + large, "doc_id long, text string").coalesce(1)
        for hot in (1, 2):
            monkeypatch.setattr(suffix_dedup, "HOT", hot)
            assert _found_bytes(df) == every, hot
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "5")
        mixed = [(small + large)[i] for i in rng.permutation(2 * len(large))]
        assert _found_bytes(spark.createDataFrame(mixed, "doc_id long, text string").coalesce(2)) == every
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_feistel_is_a_permutation():
    for n in (1, 2, 7, 1000):
        assert sorted(training_order.feistel(np.arange(n), n, 5)) == list(range(n))


def test_token_shards_round_trip(spark, docs, empty, tmp_path):
    import tiktoken

    ranks = training_order.load_ranks(training_order.TOKENIZER)
    bpe = tiktoken.Encoding("x", pat_str=training_order.PATTERN, mergeable_ranks=ranks, special_tokens={})
    root = str(tmp_path / "tokens")
    index, _ = training_order.materialise(docs, root, length=16)
    at = {r.slot: r for r in index.collect()}
    assert sorted(at) == list(range(len(at)))
    records = list(training_order.resume(spark, root, 3, length=16))
    assert len(records) == len(at) - 3
    back = {}
    for s, tokens in enumerate(training_order.resume(spark, root, 0, length=16)):
        back.setdefault(at[s].doc_id, {})[at[s].part] = list(tokens[: at[s].n_tokens])
    end = max(ranks.values()) + 1
    for d in (1, 8, 10):
        text = next(t for i, t, *_ in DOCS if i == d)
        assert [x for k in sorted(back[d]) for x in back[d][k]] == [*bpe.encode_ordinary(text), end]
    assert training_order.training_order(empty, str(tmp_path / "none")).count() == 0


def test_mix_meets_targets(spark, docs, empty):
    big = spark.range(6000).select(F.col("id").alias("doc_id"), F.when(F.col("id") < 4000, "a").when(F.col("id") < 5000, "b").when(F.col("id") < 5900, F.lit(None)).otherwise("c").alias("source"), (F.col("id") % 50).alias("size"))
    rows = mixing.schedule(big, rows_a_bucket=64).toPandas()
    per = rows.assign(source=rows.source.fillna("~")).groupby("source").agg(size=("size", "sum"), target=("target", "first"), taken=("taken", "sum"))
    assert (abs(per.taken - per.target) <= 100).all() and (rows.taken <= 2 * rows["size"]).all()
    assert abs(per.target.sum() - 1.5 * per["size"].sum()) < 1
    again = mixing.schedule(big.repartition(7), rows_a_bucket=64).toPandas()
    assert rows.sort_values("doc_id").taken.tolist() == again.sort_values("doc_id").taken.tolist()
    assert mixing.mix(docs).count() == len(DOCS) and mixing.mix(empty).count() == 0


def test_decontamination_cases(spark, docs, empty):
    items = spark.createDataFrame([(1, "ONE, two!"), (2, "gamma delta epsilon zeta eta theta iota kappa lambda mu nu"), (3, None), (4, "")], "item_id long, text string")
    got = [(r.doc_id, r.n_hit, r.n_items) for r in decontam.decontaminate(docs, items).collect()]
    assert sorted(x for x in got if x[0] in (3, 6, 7)) == [(3, 11, 1), (3, 11, 1), (6, 2, 1), (7, 2, 1)]
    assert sorted(x[1:] for x in got if x[0] in (1, 2)) == [(10, 1), (10, 1)] and (5, 0, 0) in got and (None, 2, 1) in got
    assert decontam.decontaminate(empty, items).count() == 0 and decontam.decontaminate(docs, items.limit(0)).count() == len(DOCS)


def test_line_dedup_cases(docs, empty):
    got = {r.doc_id: r.removed for r in line_dedup.removed_lines(docs).collect()}
    assert got[10] == [1] and got[2] == [0] and got[5] == [] and got[9] == []
    out = line_dedup.dedup(docs)
    assert out.columns == docs.columns and out.count() == len(DOCS) and line_dedup.removed_lines(empty).count() == 0


def _one_edit(a, b):
    if abs(len(a) - len(b)) > 1:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def test_near_lines_by_brute_force(spark):
    """Random edits at every place, lines of 7 to 80 characters, repeated
    characters, other scripts; the earliest near occurrence stays."""
    rng = np.random.default_rng(3)
    alphabet = list("aab é漢😀.")
    rows = []
    base = ["".join(rng.choice(alphabet, n)) for n in (7, 8, 9, 10, 16, 17, 31, 32, 33, 64, 80)] + ["a" * 12, "a" * 33]
    for d in range(40):
        lines = []
        for line in rng.choice(base, 6):
            for _ in range(int(rng.integers(0, 3))):
                i = int(rng.integers(0, len(line) + 1))
                line = line[:i] + str(rng.choice(["", "x", "é"])) + line[i + int(rng.integers(0, 2)) :]
            lines.append(line)
        rows.append((d, "\n".join(lines)))
    strip = lambda x: x.strip(" \t\n\r\x0b\x0c")
    at = [(d, n, strip(x)) for d, t in rows for n, x in enumerate(t.split("\n")) if strip(x)]
    first = {}
    for d, n, x in at:
        first.setdefault(x, (d, n))
    near = {x for x in first if len(x) >= line_dedup.MIN_CHARS for y in first
            if len(y) >= line_dedup.MIN_CHARS and first[y] < first[x] and _one_edit(x, y)}
    expect = {d: [n for e, n, x in at if e == d and ((e, n) > first[x] or x in near)] for d, _ in rows}
    got = {r.doc_id: r.removed for r in line_dedup.removed_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert near and got == expect


def test_short_lines_and_ids_of_any_type(spark):
    """Every line length from one character on, ids as texts; ``min_chars``
    leaves short lines out of the search for near ones only."""
    rng = np.random.default_rng(5)
    texts = ["".join(rng.choice(list("ab"), int(rng.integers(1, 11)))) for _ in range(120)]
    rows = [(f"d{k:03d}", "\n".join(texts[4 * k : 4 * k + 4])) for k in range(30)] + [("e0", "Page 9 of 12\nPage 10 of 12"), ("e1", "")]
    df = spark.createDataFrame(rows, "doc_id string, text string")
    at = [((d, n), x) for d, t in rows for n, x in enumerate(t.split("\n")) if x]
    for least in (1, 4, 9):
        first = {}
        for p, x in at:
            first.setdefault(x, p)
        near = {x for x in first if len(x) >= least for y in first if len(y) >= least and first[y] < first[x] and _one_edit(x, y)}
        expect = {d: [n for (e, n), x in at if e == d and ((e, n) > first[x] or x in near)] for d, _ in rows}
        assert {r.doc_id: r.removed for r in line_dedup.removed_lines(df, least).collect()} == expect and near


def test_lines_of_documents_without_an_own_id(spark):
    """NULL ids and one repeated id: different and equal lines at one place."""
    rng = np.random.default_rng(8)
    base = ["".join(rng.choice(list("abcdefgh"), 24)) for _ in range(14)]
    rows = []
    for k in range(60):
        lines = []
        for line in rng.choice(base, 3):
            i = int(rng.integers(0, 24))
            lines.append(line[:i] + "x" + line[i + 1 :] if rng.random() < 0.3 else str(line))
        rows.append((None if k % 2 else 7 if k % 4 else k, "\n".join([*lines, f"tail {k} " + "".join(rng.choice(list("ijklmnop"), 20))])))
    rows += rows[:3]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    hashed = {r.text: r.t for r in df.select("text", F.xxhash64("text").alias("t")).collect()}
    place = lambda d, t, n: (d is None, d or 0, hashed[t], n)
    at = [(place(d, t, n), x) for d, t in rows for n, x in enumerate(t.split("\n"))]
    first = {}
    for p, x in at:
        first[x] = min(first.get(x, p), p)
    near = {x for x in first for y in first if first[y] < first[x] and _one_edit(x, y)}
    expect = sorted((str(d), hashed[t], [n for n, x in enumerate(t.split("\n")) if place(d, t, n) > first[x] or x in near]) for d, t in rows)
    got = sorted((str(r.doc_id), r.t, r.removed) for r in line_dedup.removed_lines(df).collect())
    assert near and got == expect


def test_mix_with_a_source_without_words(spark):
    rows = [(1, "a", "one two three"), (2, "a", "four five"), (3, "b", None), (4, "b", ""), (5, "b", " \n\t"), (6, None, "  "), (None, "c", "six")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string")
    got = {r.doc_id: (r["size"], r.source_size, r.target, r.taken) for r in mixing.mix(df).collect()}
    assert all(got[d] == (0, 0, 0.0, 0) for d in (3, 4, 5, 6))
    full = {r.doc_id: r.taken for r in mixing.mix(df.filter("doc_id IS NULL OR doc_id < 3")).collect()}
    assert len(got) == 7 and sum(full.values()) > 0 and all(got[d][3] <= 2 * got[d][0] for d in got)
    wordless = mixing.mix(df.filter("doc_id BETWEEN 3 AND 6")).collect()
    assert len(wordless) == 4 and all(r.taken == 0 for r in wordless)


def test_pipeline_stages(spark):
    import corpus_pipeline as cp

    frame = table(spark, SF, "documents")
    one = cp.quality(spark, frame, SF)
    assert one.columns == frame.columns
    good = {r.doc_id for r in line_quality.line_quality(frame).filter("kept").collect()}
    assert {r.doc_id for r in one.collect()} == good
    two = cp.near_duplicates(spark, one, SF)
    stay = {r.component_id for r in ngram_join.near_duplicates(one).collect()}
    assert sorted(r.doc_id for r in two.collect()) == sorted(stay)
    three = cp.benchmark(spark, two, SF)
    clean = {r.doc_id for r in decontam.decontaminate(two, table(spark, SF, "benchmark")).filter("NOT contaminated").collect()}
    assert {r.doc_id for r in three.collect()} == clean
    four = cp.weights(spark, three, SF)
    times = Counter(r.doc_id for r in four.collect())
    size = {r.doc_id: r.size for r in mixing.sizes(three).withColumnRenamed("size", "n").select("doc_id", F.col("n").alias("size")).toPandas().itertuples()}
    assert max(times.values()) <= 2 and set(times) <= set(size)
    assert abs(sum(size[d] * n for d, n in times.items()) - 1.5 * sum(size.values())) <= 2 * max(size.values())
    assert {r.doc_id for r in cp.tokens(spark, four, SF).collect()} == set(times)
