"""Deleted interpolation against plain Python over the same documents."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from sheaf.llm import lm_score, queries, slices

SF = "/root/testdata/sf0.001"


def words(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")), None]


def kind(i):
    crc = zlib.crc32(("" if i is None else str(i)).encode())
    return 0 if crc % 10 == 0 else 3 if crc // 10 % 10 == 0 else 1


def plain(rows, order, rounds):
    """(model weights, {(id, text): (n_tokens, n_known, base, score)})"""
    texts = [(i, t, words(t), kind(i)) for i, t in rows]

    def count(use):
        grams = [Counter() for _ in range(order)]
        for _, _, w, k in texts:
            if use(k):
                w = [None] * (order - 1) + w
                for j in range(order - 1, len(w)):
                    for n in range(order):
                        grams[n][tuple(w[j - n : j + 1])] += 1
        before = [Counter() for _ in range(order)]
        for n in range(1, order):
            for g, c in grams[n].items():
                before[n][g[:-1]] += c
        before[0][()] = sum(grams[0].values())
        return grams, before

    def mixture(gram, counts, weights, v):
        grams, before = counts
        p, levels = 1 / (v + 1), []
        for n in range(order):
            g = gram[order - 1 - n :]
            context = before[n][g[:-1]]
            f = grams[n][g] / context if context else 0.0
            b = 0 if n == 0 else min(context.bit_length(), lm_score.BUCKETS - 1)
            w = weights[n][b] if context else 0.0
            p = w * f + (1 - w) * p
            levels.append((f, w, b))
        return p, levels

    v = len({w for _, _, t, k in texts if k & 1 for w in t})
    kept = count(lambda k: k == 1)
    weights = [[0.5] * lm_score.BUCKETS for _ in range(order)]
    held = [tuple(([None] * (order - 1) + w)[j : j + order]) for _, _, w, k in texts if k == 3 for j in range(len(w))]
    for _ in range(rounds):
        own, reach = np.zeros((order, lm_score.BUCKETS)), np.zeros((order, lm_score.BUCKETS))
        for g in held:
            p, levels = mixture(g, kept, weights, v)
            rest = left = 1.0
            for n in reversed(range(order)):
                f, w, b = levels[n]
                own[n][b] += rest * w * f / p
                reach[n][b] += left
                left = max(left - rest * w * f / p, 0.0)
                rest *= 1 - w
        if not held:
            break
        for n in range(order):
            last = 0.5
            for b in range(lm_score.BUCKETS):
                if reach[n][b] > 0:
                    last = min(own[n][b] / reach[n][b], lm_score.TOP)
                weights[n][b] = last
    whole = count(lambda k: k & 1)
    total = whole[1][0][()]
    out = {}
    for i, t, w, _ in texts:
        c = [whole[0][0][(x,)] for x in w]
        base = sum(math.log10((x + 0.1) / (total + 0.1 * (v + 1))) for x in c)
        padded = [None] * (order - 1) + w
        score = sum(math.log10(mixture(tuple(padded[j : j + order]), whole, weights, v)[0]) for j in range(len(w)))
        out[i, t] = (len(w), sum(x > 0 for x in c), base, score)
    return weights, total, out


def documents(n=160):
    rng = np.random.default_rng(2)
    vocabulary = ["The", "the", "a", "cat", "dog", "sat", "ran", "on", "mat", "É", "x y", "🙂", "t.", "A1"]
    rows = [(i, " ".join(rng.choice(vocabulary, rng.integers(0, 30), p=np.arange(1, 15) / 105)) + rng.choice(["", "\n", " \t end", "\x0c"])) for i in range(n)]
    rows += [(None, "the cat sat"), (None, None), (3, None), (4, ""), (5, "unseen" + "z" * 3000), (1000, "the cat " * 4000)]
    rows += [(7, "the same copy of a text, many times over")] * 60  # a third are copies
    return rows


@pytest.mark.parametrize(("order", "size"), [(2, 1 << 21), (2, 40), (3, 1), (1, 500)])
def test_against_plain_python(spark, order, size):
    rows = documents()
    df = spark.createDataFrame([(i, t, 1, "clash", 0) for i, t in rows], "doc_id long, text string, n_tokens int, ids string, kind int").repartition(4)
    scored, model = lm_score.train_and_score(df, order, size)
    weights, total, want = plain(rows, order, lm_score.ROUNDS)
    got = scored.collect()
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got) == sorted((i is None, i or 0) for i, _ in rows)
    assert model.tokens == total and np.allclose(model.weights, weights, atol=1e-9)
    assert all(b >= a - 1e-6 for a, b in zip(model.likelihood, model.likelihood[1:]))
    by_id = {}
    for (i, _), v in want.items():
        by_id.setdefault(i, []).append(v)
    for r in got:
        assert r.train_tokens == total and r.held_out == (kind(r.doc_id) == 0)
        assert any(r.n_tokens == n and r.n_known == k and abs(r.base_score - b) < 1e-7 and abs(r.score - s) < 1e-6 * max(1, abs(s)) for n, k, b, s in by_id[r.doc_id])


def test_nothing_to_learn_from(spark):
    schema = "doc_id long, text string"
    assert lm_score.score(spark.createDataFrame([], schema)).count() == 0
    only = [i for i in range(200) if kind(i) == 0][:3]
    got = lm_score.score(spark.createDataFrame([(i, "a b c") for i in only], schema)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.base_score, r.score) for r in got] == [(4, 0, 0, 0.0, 0.0)] * 3
    named = spark.createDataFrame([("x", "a b"), ("y", "a c")], "doc_id string, text string")
    assert {r.doc_id for r in lm_score.score(named).collect()} == {"x", "y"}


def test_mixture_beats_the_base_on_held_out_text(spark):
    got = queries.QUERIES["op13_lm_score"](spark, SF).filter("held_out").groupBy().sum("n_tokens", "base_score", "score").first()
    assert got["sum(score)"] / got["sum(n_tokens)"] > got["sum(base_score)"] / got["sum(n_tokens)"] + 0.3


def test_packed_integers():
    rng = np.random.default_rng(1)
    for values in ([], [0], [0, 0, 0], [1 << 63, 5], rng.integers(0, 1 << 40, 1000), rng.integers(0, 3, 5000)):
        a = np.array(values, dtype=np.uint64)
        assert (slices.unpack(slices.pack(a)) == a).all()
        rising = np.unique(a)
        assert (slices.unpack_rising(slices.pack_rising(rising)) == rising).all()
    keys = np.unique(rng.integers(0, 1 << 63, 4000).astype(np.uint64) * np.uint64(2))
    rows = slices.request(3, 1, 0, keys, np.ones(len(keys)), 7)
    assert [r[0] for r in rows] == sorted({int(p) for p in slices.part_of(keys, 7)})
    assert (np.concatenate([slices.unpack_rising(r[5]) for r in rows]) == keys).all()
