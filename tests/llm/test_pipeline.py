"""The corpus pipeline against a plain-Python model of all five stages, over
NULL and repeated ids, blank texts, copies, near copies and a benchmark
passage; and the order of the mix against a plain queue."""

import hashlib
import os
import re
import sys

import numpy as np
import pytest
from pyspark.sql import functions as F

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__)))))
sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
from oracle_check import compare, duck  # noqa: E402

import corpus_pipeline as cp  # noqa: E402
from sheaf.llm import mixing, training_order  # noqa: E402

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ITEM = "what is the largest planet that goes around the sun and how many moons does it have"
SPACES = " \t\n\x0b\x0c\r"


def fixture():
    rng = np.random.default_rng(11)
    vocabulary = [f"{a}{b}" for a in ("ka", "lo", "mi", "nu", "re", "Sa", "ti") for b in ("ba", "do", "fe", "gu", "hy", "jo", "x1")]

    def text(n):
        ws = list(rng.choice(vocabulary, n))
        return "\n".join(" ".join(ws[k : k + 9]) + "." for k in range(0, n, 9))

    rows = [(i, text(int(rng.integers(8, 90))), "en", ["b", "a", None, "c"][i % 4], None) for i in range(28)]
    long = text(700)
    rows += [
        (30, None, "en", "a", 0), (31, "", "en", None, 0), (32, " \n\t ", None, "b", 3), (None, None, None, None, None),
        (33, rows[3][1], "de", "a", 5), (34, rows[3][1], "de", "b", 5), (3, rows[3][1], "en", "c", 1), (3, rows[3][1], "en", "c", 1),  # copies, one id and text twice
        (None, rows[5][1], "en", "a", 0), (None, text(50), "en", "a", 0), (None, text(60), None, None, 0), (7, text(40), "fr", "b", 0),  # NULL ids, a repeated id
        (35, rows[9][1] + " tail of a copy.", "en", "a", 0), (36, text(30) + "\n" + ITEM.upper().replace(" ", ", ") + ".\n" + text(20), "en", "b", 0),
        (37, text(40) + "\nhome | news | about | contact\nAll rights reserved\nok\n" + text(40), "en", "c", 0), (38, "menu | a | b | c\n" * 9 + text(12), "en", "c", 0),
        (39, "one two three four five six " * 30, "en", "a", 0), (40, long, "en", "b", 0), (41, "x" * 4000 + " " + text(30), "en", None, 0),
    ]
    return rows


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def line_fails(s):
    end = s.strip(SPACES)
    phrases = ["all rights reserved", "licensed under", "privacy policy", "terms of use", "click here", "sign up for"]
    symbols = sum(c in "#*$%&|<>" for c in s)
    return (
        s.count("|") >= 3 or symbols * 20 >= len(s) or len(s.replace("!!", "")) + 6 <= len(s)
        or (end[-1] not in ".!?:;\"')]…。！？" and len(words_of(end)) < 3) or any(p in s.lower() for p in phrases)
    )


def plain_quality(rows):
    out = []
    for d, t, lang, source, _ in rows:
        ws, at = words_of(t), {}
        for i in range(len(ws) - 4):
            at.setdefault(tuple(ws[i : i + 5]), []).append(i)
        repeated = {i + k for v in at.values() if len(v) > 1 for i in v for k in range(5)}
        if len(ws) < 10 or 100 * len(repeated) > 20 * len(ws):
            continue
        lines = t.split("\n")
        bad = [bool(s.strip(SPACES)) and line_fails(s) for s in lines]
        if sum(len(s) for s, b in zip(lines, bad) if b) > 0.6 * sum(len(s) for s in lines if s.strip(SPACES)):
            continue
        clean = "\n".join(s for s, b in zip(lines, bad) if not b)
        out.append((d, clean, lang, source, len(clean)))
    return out


def key(row):
    number = "~" if row[0] is None else f"{(row[0] ^ (1 << 63)) & (1 << 64) - 1:016X}"
    return number + hashlib.md5(row[1].encode()).hexdigest()


def lower(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text)


def plain_near(rows):
    """The smallest document of each group stays; of equal id and text one."""
    docs = {}
    for r in rows:
        docs.setdefault(key(r), r)
    names = sorted(docs)
    sets = []
    for k in names:
        ws = words_of(lower(docs[k][1]))
        sets.append({tuple(ws[i : i + 5]) for i in range(len(ws) - 4)} or ({tuple(ws)} if ws else set()))
    group = list(range(len(names)))
    for _ in names:
        for i in range(len(names)):
            for j in range(i):
                if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                    group[i] = group[j] = min(group[i], group[j])
    return [docs[names[i]] for i in range(len(names)) if group[i] == i]


def plain_benchmark(rows, items):
    cut = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    windows = set()
    for t in items:
        ws = cut(t)
        windows |= {tuple(ws[i : i + 10]) for i in range(max(1, len(ws) - 9))} if ws else set()
    out = []
    for r in rows:
        ws = cut(r[1])
        if not any(tuple(ws[i : i + len(w)]) == w for w in windows for i in range(len(ws) - len(w) + 1)):
            out.append(r)
    return out


def plain_queue(docs):
    """(order of the mix: a document for each turn taken; target by source).
    ``docs``: (id, source, size), as fair queueing goes: one turn after another."""
    sources = sorted({s for _, s, _ in docs}, key=lambda s: (s is None, s or ""))
    total = {s: sum(n for _, t, n in docs if t == s) for s in sources}
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(sources)}
    target, open_, budget = {}, set(sources), 1.5 * sum(total.values())
    while open_:
        level = (budget - sum(target.values())) / sum(weight[s] for s in open_)
        full = {s for s in open_ if level * weight[s] > 2 * total[s]}
        if not full:
            target |= {s: level * weight[s] for s in open_}
            break
        target |= {s: 2.0 * total[s] for s in full}
        open_ -= full
    turns = []
    for s in sources:
        named = [(hashlib.md5(f"mix-1:{'' if i is None else i}:{n}".encode()).hexdigest(), i, n) for i, t, n in docs if t == s and n]
        cum = 0
        for again in range(2):
            for h, i, n in sorted(named, key=lambda x: x[0]):
                cum += n
                turns.append((cum / target[s], s is None, s or "", h, again, i, n))
    order, used = [], 0
    for *_, i, n in sorted(turns, key=lambda t: t[:5]):
        used += n
        if used > sum(target.values()):
            break
        order.append(i)
    return order, target


def plain_mix(x):
    x ^= x >> 33
    x = x * 0xFF51AFD7ED558CCD % (1 << 64)
    x ^= x >> 33
    x = x * 0xC4CEB9FE1A85EC53 % (1 << 64)
    return x ^ x >> 33


def plain_place(index, size, secret, rounds=6):
    half = max(1, ((size - 1).bit_length() + 1) // 2)
    keys = [plain_mix((k + secret * 0x9E3779B97F4A7C15) % (1 << 64)) for k in range(rounds)]
    while True:
        left, right = index >> half, index & (1 << half) - 1
        for k in keys:
            left, right = right, left ^ plain_mix((right + k) % (1 << 64)) & (1 << half) - 1
        index = left << half | right
        if index < size:
            return index


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def plain_tokens(rows, length=256):
    import tiktoken
    import xxhash

    ranks = training_order.load_ranks(training_order.TOKENIZER)
    bpe = tiktoken.Encoding("given", pat_str=training_order.PATTERN, mergeable_ranks=ranks, special_tokens={})
    ids = [r[0] for r in rows if r[0] is not None]
    low, parts = min(ids) - 1, max(len(r[1].encode()) for r in rows) // length + 1
    size = (max(ids) - low + 1) * parts
    out = []
    for d, t, *_ in rows:
        tokens = [*bpe.encode_ordinary(t), len(ranks)]
        for part in range(0, -(-len(tokens) // length)):
            base = signed(xxhash.xxh64(t.encode(), seed=42).intdigest()) % (max(ids) - low + 1) if d is None else d - low
            place = plain_place(base * parts + part, size, training_order.KEY)
            out.append(((place, d is not None, d or 0, hashlib.md5(t.encode()).hexdigest()[:8], part), d, part, tokens[part * length : (part + 1) * length]))
    return [(slot, d, part, tokens) for slot, (_, d, part, tokens) in enumerate(sorted(out, key=lambda x: x[0]))]


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    df = spark.createDataFrame(fixture(), SCHEMA)
    df.withColumn("node", F.lit("clash")).withColumn("size", F.lit(1)).repartition(3).write.parquet(f"{root}/documents.parquet")
    items = [(1, ITEM), (2, None), (3, ""), (4, "never seen anywhere")]
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return root


def test_each_stage_and_the_whole(spark, folder):
    order = lambda rows: sorted(rows, key=repr)
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    names = SCHEMA.split(", ")
    picked = lambda df: [tuple(r) for r in df.select(*[n.split()[0] for n in names]).collect()]
    want = plain_quality(fixture())
    one = cp.quality(spark, docs, folder).persist()
    assert one.columns == docs.columns and order(picked(one)) == order(want) and len(want) < len(fixture())
    want = plain_near(want)
    two = cp.near_duplicates(spark, one, folder).persist()
    assert order(r[:2] for r in picked(two)) == order(r[:2] for r in want)
    left = plain_benchmark(want, [ITEM, None, ""])
    three = cp.benchmark(spark, two, folder).persist()
    assert order(r[:2] for r in picked(three)) == order(r[:2] for r in left) and len(left) == len(want) - 1
    queue, _ = plain_queue([(key(r), r[3], len(words_of(r[1]))) for r in picked(three)])
    by_key = {key(r): r for r in picked(three)}
    four = cp.weights(spark, three, folder).persist()
    assert [key(r) for r in picked(four)] == queue  # the same documents in the same order
    assert picked(four) == [by_key[k] for k in queue]
    slots = plain_tokens(picked(four))
    root = f"{folder}/shards"
    index, manifest = training_order.materialise(four, root)
    found = index.orderBy("slot").collect()
    assert [(r.slot, r.doc_id, r.part, r.n_tokens) for r in found] == [(s, d, p, len(t)) for s, d, p, t in slots]
    assert [list(t[: len(w)]) for t, (*_, w) in zip(training_order.resume(spark, root, 0), slots)] == [w for *_, w in slots]
    final = cp.run(spark, folder).orderBy("slot").collect()
    # copies of one document may change places when a table is read again, so ids and parts decide
    assert [(r.slot, r.doc_id, r.part, r.n_tokens) for r in final] == [(s, d, p, len(t)) for s, d, p, t in slots]


def test_order_of_the_mix_by_a_plain_queue(spark):
    rng = np.random.default_rng(4)
    docs = [(i, ["s", "t", None, "u", "ü"][int(rng.choice(5, p=[0.5, 0.3, 0.1, 0.05, 0.05]))], int(rng.integers(0, 40)) ** 2) for i in range(400)]
    df = spark.createDataFrame([(*d, "x") for d in docs], "doc_id long, source string, size long, extra string").repartition(5)
    queue, target = plain_queue(docs)
    for rows in (1, 7, 2048):
        got = mixing.mix_order(df, rows_a_bucket=rows).collect()
        assert [r.doc_id for r in got] == queue
        size = {i: n for i, _, n in docs}
        assert [r.place for r in got] == [0, *np.cumsum([size[i] for i in queue])[:-1]]
        per = {r.doc_id: r for r in mixing.schedule(df, rows_a_bucket=rows).collect()}
        assert all(per[i].taken == queue.count(i) * n and abs(per[i].target - target[s]) < 1e-6 and per[i].extra == "x" for i, s, n in docs)
    one = spark.createDataFrame([(1, "a", 5, "x")], df.schema)
    assert [r.taken for r in mixing.schedule(one).collect()] == [5] and mixing.mix_order(df.limit(0)).count() == 0


def test_mix_by_sql(spark):
    from sheaf.llm import queries

    ok, _, _, detail = compare(spark, duck(SF), "op8_fair_mix", queries.QUERIES["op8_fair_mix"], queries.ORACLE_SQL["op8_fair_mix"], SF)
    assert ok, detail
