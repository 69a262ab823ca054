"""Language-model scores by deleted interpolation.

Maximum-likelihood estimates of n-grams of every order up to ``order`` are
mixed: P_k(w | context) = l * c(context w) / c(context) + (1 - l) * P_(k-1),
down to a uniform P_0 = 1 / (V + 1), which also serves words never seen. The
weight l belongs to the order and to the bucket of the context's frequency
(powers of two). Weights are learned by expectation-maximisation on counts
deleted from the training set: a tenth of the training documents is scored
with everything but itself, and the posterior share of each order in each
bucket becomes its weight. The scores then use all training counts.

Spark: documents are cut into slices of up to ``SLICE_TOKENS`` tokens, a
slice asks for the corpus totals of its distinct n-grams, and is scored with
the answers (``slices``). Counting and scoring need one exchange of keys, and
no vocabulary or count table is collected or broadcast: what moves is the
n-grams that a slice has, so it follows the corpus. Only N, V and the weights
(order x 64 numbers) come to the driver.

Words are runs without white space, ASCII capitals lower-cased, known by
64-bit hashes; each text ends with an end token, which is counted. The
context of a text's first words is filled up with the end token.

Defined cases: a NULL or empty text has one token, the end. A NULL id is
hashed as the empty text (so it is held out). Repeated rows are separate
documents. A context never seen gives all weight to the orders below; a
bucket without deleted tokens takes the weight of the next lower one that
has some, else one half; with nothing to learn from (no training document)
every token has probability 1, V being 0. Weights stay below 1 - 1e-6, so
no score is infinite. An empty table gives no rows. Other columns are not
read; the id may be of any type that casts to text and back."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import LOWER, mix, pick, prefix_sums, span_hash, text_slices, words_of
from .components import written
from .slices import answers, n_parts, next_slice, pack, pack_rising, request, requests, unpack, unpack_rising, with_answers

ORDER = 2
SLICE_TOKENS = 1 << 20
BUCKETS = 64
ROUNDS = 12
TOP = 1 - 1e-6
SMOOTH = 0.1
#: ``kind`` of a document: bit 0 it trains, bit 1 it is deleted while weights are learned
HELD_OUT, TRAINS, DELETED = 0, 1, 3
END = np.uint64(0x9E6C63D0876A9A47)
_STEP = np.uint64(0xD6E8FEB86659FD93)

_SLICE = pa.schema([("slice", pa.int64()), ("kind", pa.int32()), ("n_docs", pa.int64()), ("n_tokens", pa.int64()), ("ids", pa.list_(pa.string())), ("sizes", pa.binary()), ("vocabulary", pa.binary()), ("tokens", pa.binary())])


def kind_of(doc_id: Column) -> Column:
    crc = F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary"))
    return F.when(crc % 10 == 0, HELD_OUT).when(F.floor(crc / 10) % 10 == 0, DELETED).otherwise(TRAINS).cast("int")


def _packed(slice_tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = next_slice()
        ids: dict[int, list] = {}
        words: dict[int, list] = {}
        sizes: dict[int, list] = {}

        def out(kind: int) -> pa.RecordBatch:
            n = np.concatenate(sizes.pop(kind))  # words of each document
            flat = np.concatenate(words.pop(kind))
            ends = np.cumsum(n + 1) - 1
            stream = np.full(len(flat) + len(n), END, dtype=np.uint64)
            stream[np.arange(len(flat)) + np.repeat(np.arange(len(n)), n)] = flat
            assert (stream[ends] == END).all()
            vocabulary, tokens = np.unique(stream, return_inverse=True)
            row = [next(number), kind, len(n), len(stream), ids.pop(kind), pack(n + 1), pack_rising(vocabulary), pack(tokens)]
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SLICE)], schema=_SLICE)

        for batch in batches:
            doc, kind = batch.column("doc_id").to_pylist(), np.array(batch.column("kind").to_pylist(), dtype=np.int64)
            for at, end, data, offsets in text_slices(batch, "text"):
                low = LOWER[data]
                starts, stops, first = words_of(low, offsets)
                hashed = span_hash(prefix_sums(low), starts, stops)
                n = np.diff(first)
                for k in np.unique(kind[at:end]):
                    mine = kind[at:end] == k
                    k = int(k)
                    ids.setdefault(k, []).extend(doc[at + i] for i in np.flatnonzero(mine))
                    words.setdefault(k, []).append(hashed[np.repeat(mine, n)])
                    sizes.setdefault(k, []).append(n[mine])
                    if sum(map(len, words[k])) + len(ids[k]) >= slice_tokens:
                        yield out(k)
        for k in sorted(ids):
            yield out(k)

    return run


def pack_documents(docs: DataFrame, slice_tokens: int = SLICE_TOKENS) -> DataFrame:
    """Slices of documents of one kind: word hashes of the slice, ascending,
    and the tokens as places among them."""
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("string").alias("doc_id"), kind_of(F.col("doc_id")).alias("kind"), F.col("text").cast("string").alias("text"))
    schema = "slice long, kind int, n_docs long, n_tokens long, ids array<string>, sizes binary, vocabulary binary, tokens binary"
    return d.mapInArrow(_packed(slice_tokens), schema)


def _starts(row: dict) -> np.ndarray:
    sizes = unpack(row["sizes"]).astype(np.int64)
    return np.cumsum(sizes) - sizes


def _grams(row: dict, order: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(distinct keys ascending, place of each token's n-gram among them) for
    n = 1 .. order."""
    vocabulary, tokens = unpack_rising(row["vocabulary"]), unpack(row["tokens"]).astype(np.int64)
    yield vocabulary, tokens
    starts = _starts(row)
    word = vocabulary[tokens]
    gram, pad = word, END
    for _ in range(2, order + 1):
        before = np.empty_like(gram)
        before[1:] = gram[:-1]
        before[starts] = pad
        gram = mix(before * _STEP + word)
        with np.errstate(over="ignore"):
            pad = mix(np.array([pad * _STEP + END], dtype=np.uint64))[0]
        yield np.unique(gram, return_inverse=True)


def _ask(order: int, parts: int):
    def ask(row: dict) -> Iterator[tuple]:
        for what, (keys, at) in enumerate(_grams(row, order)):
            yield from request(row["slice"], what, row["kind"], keys, np.bincount(at, minlength=len(keys)), parts)

    return ask


def _counts(row: dict, totals: dict, order: int, deleted: bool) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """(counts, contexts) of each token for n = 1 .. order: how often its
    n-gram and the first n - 1 words of it occur (as a context; not given for
    n = 1). ``deleted``: without the deleted documents."""
    starts = _starts(row)
    counts, contexts = [], []
    for n, (keys, at) in enumerate(_grams(row, order)):
        total = totals[n, 0] - totals[n, 1] if deleted else totals[n, 0]
        if n == 0:
            ends = total[np.searchsorted(keys, END)]  # texts, so also how often a text begins
        else:
            context = np.empty(len(at), dtype=np.int64)
            context[1:] = counts[-1][:-1]
            context[starts] = ends
            contexts.append(context)
        counts.append(total[at])
    return counts, contexts


def _bucket(context: np.ndarray) -> np.ndarray:
    return np.minimum(np.frexp(context.astype(float))[1], BUCKETS - 1)


@dataclass(frozen=True)
class Model:
    """tokens (N) and words (V) of training, and the weights: one row an
    order, one column a bucket of the context's frequency."""

    order: int
    tokens: int
    words: int
    weights: np.ndarray
    likelihood: list = field(default_factory=list)


def _mixture(counts, contexts, tokens: int, words: int, weights: np.ndarray):
    """(P, what each order adds at its own, weight, bucket) by order."""
    p = np.full(len(counts[0]), 1.0 / (words + 1))
    levels = []
    for n, c in enumerate(counts):
        context = contexts[n - 1] if n else np.full(len(c), tokens, dtype=np.int64)
        bucket = _bucket(context) if n else np.zeros(len(c), dtype=np.int64)
        ratio = np.divide(c, context, out=np.zeros(len(c)), where=context > 0)
        weight = np.where(context > 0, weights[n][bucket], 0.0)
        p = weight * ratio + (1 - weight) * p
        levels.append((ratio, weight, bucket))
    return p, levels


def _deleted_counts(order: int):
    schema = pa.schema([("columns", pa.list_(pa.binary()))])

    def fn(row: dict, totals: dict) -> pa.RecordBatch:
        counts, contexts = _counts(row, totals, order, True)
        columns = counts + contexts
        key = np.zeros(len(columns[0]), dtype=np.uint64)
        for c in columns:
            key = mix((key + c.astype(np.uint64)) * _STEP)
        _, first, times = np.unique(key, return_index=True, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array([[*(pack(c[first]) for c in columns), pack(times)]], schema.field(0).type)], schema=schema)

    return fn


def _expect(order: int, tokens: int, words: int, weights: np.ndarray):
    """Expectations of a share of the deleted tokens: for each order and
    bucket, how much comes from that order, and how much from it or below."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, reach, like = np.zeros((order, BUCKETS)), np.zeros((order, BUCKETS)), 0.0
        for batch in batches:
            for packed in batch.column("columns"):
                *columns, times = [unpack(c.as_buffer()).astype(np.int64) for c in packed]
                p, levels = _mixture(columns[:order], columns[order:], tokens, words, weights)
                like += float((times * np.log(p)).sum())
                rest, left = np.ones(len(p)), np.ones(len(p))  # prior and posterior of getting below the orders seen so far
                for n in reversed(range(order)):
                    ratio, weight, bucket = levels[n]
                    share = rest * weight * ratio / p
                    own[n] += np.bincount(bucket, times * share, BUCKETS)
                    reach[n] += np.bincount(bucket, times * left, BUCKETS)
                    rest, left = rest * (1 - weight), np.maximum(left - share, 0.0)
        n, b = (x.ravel() for x in np.indices((order, BUCKETS)))
        yield pa.RecordBatch.from_arrays([pa.array(n.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(own.ravel()), pa.array(reach.ravel()), pa.array(np.where((n == 0) & (b == 0), like, 0.0))], names=["n", "b", "own", "reach", "like"])

    return run


def learn(deleted: DataFrame, order: int, tokens: int, words: int, rounds: int = ROUNDS) -> tuple[np.ndarray, list[float]]:
    """Weights by expectation-maximisation, and the log-likelihood (natural)
    of the deleted tokens before each round. ``deleted``: packed counts."""
    weights, history = np.full((order, BUCKETS), 0.5), []
    for _ in range(rounds):
        rows = deleted.mapInArrow(_expect(order, tokens, words, weights), "n int, b int, own double, reach double, like double").groupBy("n", "b").agg(*[F.sum(c).alias(c) for c in ("own", "reach", "like")]).collect()
        own, reach = np.zeros((order, BUCKETS)), np.zeros((order, BUCKETS))
        for r in rows:
            own[r["n"], r["b"]], reach[r["n"], r["b"]] = r["own"], r["reach"]
        if not reach.any():
            break
        history.append(sum(r["like"] for r in rows))
        for n in range(order):
            last = 0.5
            for b in range(BUCKETS):
                if reach[n, b] > 0:
                    last = min(own[n, b] / reach[n, b], TOP)
                weights[n, b] = last
    return weights, history


def _scores(model: Model):
    kinds = [("ids", pa.list_(pa.string())), ("held_out", pa.bool_()), ("n_tokens", pa.list_(pa.int64())), ("n_known", pa.list_(pa.int64())), ("base_score", pa.list_(pa.float64())), ("score", pa.list_(pa.float64()))]
    schema = pa.schema(kinds)

    def fn(row: dict, totals: dict) -> pa.RecordBatch:
        counts, contexts = _counts(row, totals, model.order, False)
        p, _ = _mixture(counts, contexts, model.tokens, model.words, model.weights)
        base = (counts[0] + SMOOTH) / (model.tokens + SMOOTH * (model.words + 1))
        starts = _starts(row)
        per = [np.diff(np.append(starts, len(p))), np.add.reduceat((counts[0] > 0).astype(np.int64), starts), np.add.reduceat(np.log10(base), starts), np.add.reduceat(np.log10(p), starts)]
        values = [row["ids"], row["kind"] == HELD_OUT, *per]
        return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    return fn, "ids array<string>, held_out boolean, n_tokens array<long>, n_known array<long>, base_score array<double>, score array<double>"


def train_and_score(docs: DataFrame, order: int = ORDER, slice_tokens: int = SLICE_TOKENS) -> tuple[DataFrame, Model]:
    """One row a document: doc_id, held_out, n_tokens, n_known, train_tokens,
    base_score and score; and the model."""
    slices = written(pack_documents(docs, slice_tokens), "lm-slices")
    size = slices.agg(F.sum("n_tokens").alias("all"), *[F.sum(F.when(F.col("kind") == k, F.col("n_tokens"))).alias(f"k{k}") for k in (TRAINS, DELETED)]).first()
    asked = requests(slices, _ask(order, n_parts((size["all"] or 0) * order)))
    answer = written(answers(asked, channels=2), "lm-totals")
    words = answer.filter("what = 0").agg(F.sum("found")).first()[0] or 0
    kept, deleted = size[f"k{TRAINS}"] or 0, size[f"k{DELETED}"] or 0
    held = with_answers(slices.filter(F.col("kind") == DELETED), answer.filter(F.col("kind") == DELETED), _deleted_counts(order), "columns array<binary>")
    weights, history = learn(written(held, "lm-deleted"), order, kept, words)
    model = Model(order, kept + deleted, words, weights, history)
    fn, schema = _scores(model)
    per = with_answers(slices, answer, fn, schema)
    kind = pick(docs, "doc_id").schema["doc_id"].dataType
    rows = per.select("held_out", F.explode(F.arrays_zip(*[F.col(c) for c in ("ids", "n_tokens", "n_known", "base_score", "score")])).alias("d"))
    scored = rows.select(
        F.col("d.ids").cast(kind).alias("doc_id"), "held_out", F.col("d.n_tokens").alias("n_tokens"), F.col("d.n_known").alias("n_known"),
        F.lit(model.tokens).cast("long").alias("train_tokens"), F.col("d.base_score").alias("base_score"), F.col("d.score").alias("score"),
    )
    return scored, model


def score(docs: DataFrame, order: int = ORDER) -> DataFrame:
    """The query."""
    return train_and_score(docs, order)[0]
