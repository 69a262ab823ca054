"""Alignment of two tokenizers over the same bytes.

Each text is encoded by both. The ends of the tokens are two ascending lists
of byte offsets, and the shorter one drives a galloping search: from where
the last stretch ended, steps of doubling length into the longer list until
the offset is passed, then a binary search of the last step. An offset found
in both lists is a common cut, and common cuts slice the text into groups.
For all others the search gives a rank, and the ranks at a token's start and
end give the range of the other side's tokens that it overlaps: the links.

How often each pair of ids is linked is counted over the corpus, and a link
is best if its count is the highest of its B id. Slices of documents keep
their distinct pairs and ask for the totals (``slices``); the highest count
of each B id is one row an id, bounded by the vocabulary, and broadcast.

Encoding: both tokenizers cut a text where a space or line end follows
something else, if no entry of B reaches across such a place (looked up in
its vocabulary at the start; else texts are encoded whole). Then a text is
encoded word by word, words are remembered up to ``REMEMBER`` of them, and
the tokens are those of the whole text. Alignment always runs over whole
texts, a few megabytes at a time.

Defined cases: NULL and empty texts, and texts whose joined token bytes are
not a space and the text (on either side), have no tokens: all numbers 0 and
an empty digest. Repeated rows are separate documents and count each. Special
tokens' strings in a text are plain text. An empty table gives no rows. Other
columns are not read; the id may be of any type that casts to text and back.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import mix, pick
from .components import written
from .slices import PART_ROW, answers, n_parts, next_slice, pack, pack_rising, request, requests, unpack, unpack_rising, with_answers

BYTE_BPE = "/opt/tokenizers/byte_bpe_50k.json"
PIECE_BPE = "/opt/tokenizers/piece_bpe_32k.model"
TEXT_BYTES = 1 << 20  # of texts aligned at a time
SLICE_LINKS = 1 << 21
REMEMBER = 300_000
LONG_WORD = 1 << 16  # after a word so long nothing is remembered
#: fixed value: the pattern that cuts a text before byte-pair merging
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
_ODD_INVERSE = [np.uint64(pow(c, -1, 1 << 64)) for c in (0xC4CEB9FE1A85EC53, 0xFF51AFD7ED558CCD)]


def unmix(x: np.ndarray) -> np.ndarray:
    """The inverse of ``mix``."""
    for inverse in _ODD_INVERSE:
        x = x ^ (x >> np.uint64(33))
        x = x * inverse
    return x ^ (x >> np.uint64(33))


class Ragged:
    """Rows of integers of different lengths in flat arrays that grow."""

    def __init__(self, dtype, rows: list = ()):
        self.flat, self.first, self.size = np.zeros(0, dtype=dtype), np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        self.n = self.used = 0
        self.extend(rows)

    def extend(self, rows: list) -> None:
        size = np.fromiter(map(len, rows), dtype=np.int64, count=len(rows))
        total = int(size.sum())
        values = np.fromiter(chain.from_iterable(rows), dtype=self.flat.dtype, count=total)
        for name, used, new in (("flat", self.used, values), ("first", self.n, self.used + np.cumsum(size) - size), ("size", self.n, size)):
            have = getattr(self, name)
            if used + len(new) > len(have):
                grown = np.zeros(max(2 * len(have), used + len(new)), dtype=have.dtype)
                grown[:used] = have[:used]
                setattr(self, name, have := grown)
            have[used : used + len(new)] = new
        self.n += len(rows)
        self.used += total

    def take(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(the rows ``at``, joined; their sizes)"""
        size = self.size[at]
        end = np.cumsum(size)
        place = np.arange(end[-1] if len(end) else 0) + np.repeat(self.first[at] - (end - size), size)
        return self.flat[place], size


class Numbers(dict):
    """Numbers words as they come; ``new`` holds those not seen before."""

    def __init__(self):
        self.new: list[str] = []

    def __missing__(self, word: str) -> int:
        self[word] = n = len(self)
        self.new.append(word)
        return n


def byte_characters() -> dict[str, int]:
    """Byte-level alphabet: printable bytes stand for themselves, the others
    for characters from 256 on, in order."""
    plain = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    others = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}


class Tokenizers:
    """Both tokenizers, with the bytes of each id. A's entries and merges are
    those of its file; where each merge makes the next id, as in a file of
    ranks, the faster of the two libraries that read such a vocabulary merges
    them (``fast``)."""

    def __init__(self, a_path: str, b_path: str, remember: int = REMEMBER):
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(a_path)
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        with open(a_path, encoding="utf-8") as f:
            file = json.load(f)
        special = {t["content"] for t in file.get("added_tokens", [])}
        alphabet = byte_characters()
        entries = self.a.get_vocab()
        a_bytes: list[bytes] = [b""] * (max(entries.values()) + 1)
        for text, i in entries.items():
            a_bytes[i] = text.encode() if text in special else bytes(alphabet[c] for c in text)
        b_bytes = []
        for i in range(self.b.get_piece_size()):
            piece = self.b.id_to_piece(i)
            b_bytes.append(bytes([int(piece[3:5], 16)]) if self.b.is_byte(i) else piece.replace("▁", " ").encode())
        self.a_bytes, self.b_bytes = Ragged(np.uint8, a_bytes), Ragged(np.uint8, b_bytes)
        self.blank = self.b.piece_to_id("▁")
        pre = file.get("pre_tokenizer") or {}
        plain = pre.get("type") == "ByteLevel" and pre.get("use_regex", True) and not pre.get("add_prefix_space")
        merged = [entries.get("".join(m.split(" ") if isinstance(m, str) else m)) for m in file["model"].get("merges", [])]
        self.fast = None
        if plain and not file.get("normalizer") and merged == list(range(256, 256 + len(merged))):
            ranks = {a_bytes[i]: i for text, i in entries.items() if text not in special}
            self.fast = tiktoken.Encoding("given", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})
        pieces = [b.decode("utf-8", "replace") for b in b_bytes]
        # before such a character no piece of B reaches, nor joins it to B's own space in front
        cut = "".join(c for c in " \n" if plain and not any(re.search(rf"\S{c}|[ ]\n", p) for p in pieces))
        self.word = re.compile(rf"(?:[{cut}]\s*)?\S+(?:[^\S{cut}]\s*\S+)*(?:\s+\Z)?|\s+") if cut else None
        self.remember = remember
        self._forget()

    def _forget(self) -> None:
        self.known, self.a_rows, self.b_rows = Numbers(), Ragged(np.int64), Ragged(np.int64)

    def words(self, text: str) -> list[str]:
        """The text with its leading space, in pieces to be encoded apart. B
        takes its own sign for a space as one, so texts with it stay whole."""
        return self.word.findall(" " + text) if self.word and "▁" not in text else [" " + text]

    def encode_a(self, words: list[str]) -> list[list[int]]:
        if self.fast is not None:
            return [self.fast.encode_ordinary(w) for w in words]
        return [e.ids for e in self.a.encode_batch_fast(words, add_special_tokens=False)]

    def encode_b(self, words: list[str]) -> list[list[int]]:
        """B puts a space in front: words that begin with one give it up, from
        the others it is taken off."""
        found = self.b.encode([w[1:] if w[0] == " " else w for w in words], num_threads=1)
        return [ids if w[0] == " " else ids[1:] if ids[:1] == [self.blank] else [-1] for w, ids in zip(words, found)]

    def tokens(self, texts: list[list[str]]) -> tuple[tuple[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]:
        """For A and for B: (ids of all texts, joined; their number by text)."""
        if len(self.known) > self.remember:
            self._forget()
        sizes = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
        at = np.fromiter(map(self.known.__getitem__, chain.from_iterable(texts)), dtype=np.int64, count=int(sizes.sum()))
        new, self.known.new = self.known.new, []
        if new:
            self.a_rows.extend(self.encode_a(new))
            self.b_rows.extend(self.encode_b(new))
        out = []
        for rows in (self.a_rows, self.b_rows):
            ids, n = rows.take(at)
            ends = np.concatenate([[0], np.cumsum(n)])[np.cumsum(sizes)]
            out.append((ids, np.diff(ends, prepend=0)))
        if max(map(len, new), default=0) > LONG_WORD:
            self._forget()  # rare, and its memory goes with it
        return out[0], out[1]


def gallop(short: np.ndarray, long: np.ndarray, start: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(rank, common): how many entries of ``long`` lie under each entry of
    ``short``, and whether the entry itself is there. Both ascend. The search
    for an entry starts at ``start`` (at most its rank) and doubles its step
    until it has passed, then halves what the last step jumped over."""
    n = len(long)
    low, high, step = start.copy(), start.copy(), np.ones(len(short), dtype=np.int64)
    far = np.flatnonzero((low < n) & (long[np.minimum(low, n - 1)] < short))
    while len(far):
        high[far] = np.minimum(low[far] + step[far], n)
        far = far[(high[far] < n) & (long[np.minimum(high[far], n - 1)] < short[far])]
        low[far] = high[far]
        step[far] *= 2
    # where low < high now: long[low] < short <= long[high]
    wide = np.flatnonzero(high - low > 1)
    while len(wide):
        middle = (low[wide] + high[wide]) // 2
        under = long[middle] < short[wide]
        low[wide[under]] = middle[under]
        high[wide[~under]] = middle[~under]
        wide = wide[high[wide] - low[wide] > 1]
    return high, np.where(high < n, long[np.minimum(high, n - 1)] == short, False)


def align(a_ends: np.ndarray, b_ends: np.ndarray, a_n: np.ndarray, b_n: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Alignment of texts laid end to end: ends ascend over all of them, and
    every text ends on both sides. Returns the links as (place in A, place in
    B), and for each token of A and of B whether a group ends with it."""
    links, cut = [], (np.zeros(len(a_ends), dtype=bool), np.zeros(len(b_ends), dtype=bool))
    shorter_a = a_n <= b_n
    for a_drives in (True, False):
        texts = np.flatnonzero(shorter_a == a_drives)
        if not len(texts):
            continue
        ends, sizes = ((a_ends, b_ends), (a_n, b_n)) if a_drives else ((b_ends, a_ends), (b_n, a_n))
        place = []
        for n in sizes:
            first = np.cumsum(n) - n
            size = n[texts]
            end = np.cumsum(size)
            place.append(np.arange(end[-1]) + np.repeat(first[texts] - (end - size), size))
        short, long = ends[0][place[0]], ends[1][place[1]]
        n_short, n_long = sizes[0][texts], sizes[1][texts]
        # every 64th entry is searched from its text's start, then those half way between from the neighbour before
        base = np.repeat(np.cumsum(n_long) - n_long, n_short)
        rank, common = np.zeros(len(short), dtype=np.int64), np.zeros(len(short), dtype=bool)
        at, gap = np.arange(0, len(short), 64), 64
        rank[at], common[at] = gallop(short[at], long, base[at])
        while gap > 1:
            at = np.arange(gap // 2, len(short), gap)
            rank[at], common[at] = gallop(short[at], long, np.maximum(base[at], rank[at - gap // 2]))
            gap //= 2
        # token k covers the long side's tokens from the one after the last end at or before its start
        low = np.empty_like(rank)
        low[0] = 0
        low[1:] = rank[:-1] + common[:-1]
        n = rank - low + 1
        end = np.cumsum(n)
        driver = np.repeat(np.arange(len(short)), n)
        other = np.arange(end[-1]) + np.repeat(low - (end - n), n)
        x, y = place[0][driver], place[1][other]
        links.append((x, y) if a_drives else (y, x))
        cut[0 if a_drives else 1][place[0][common]] = True
        cut[1 if a_drives else 0][place[1][rank[common]]] = True
    x, y = (np.concatenate(c) for c in zip(*links)) if links else (np.zeros(0, np.int64), np.zeros(0, np.int64))
    return x, y, cut[0], cut[1]


def _same(table: Ragged, ids: np.ndarray, n: np.ndarray, data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(whether each text's joined token bytes are its bytes, sizes of the tokens)"""
    bad = ids < 0
    ids = np.where(bad, 0, ids)
    size = np.where(bad, 0, table.size[ids])
    ends = np.concatenate([[0], np.cumsum(size)])[np.concatenate([[0], np.cumsum(n)])]
    length, want = np.diff(ends), np.diff(offsets)
    good = length == want
    text = np.repeat(np.arange(len(n)), n)
    at = np.where(good[text], ids, 0)[good[text] & ~bad]
    got, _ = table.take(at)
    keep = np.repeat(good, want)
    differ = np.flatnonzero(got != data[keep])
    if len(differ):
        good[np.repeat(np.arange(len(n))[good], want[good])[differ]] = False
    return good, size


class _Digits:
    """Decimal ids with what follows them, as bytes."""

    def __init__(self, n: int):
        self.text = np.array([str(i).encode() for i in range(n)], dtype="S")
        self.size = np.char.str_len(self.text)
        self.chars = self.text.view(np.uint8).reshape(n, -1)

    def join(self, ids: np.ndarray, after: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(all ids as digits, each followed by its mark; bytes of each)"""
        width = self.chars.shape[1] + 1
        grid = np.zeros((len(ids), width), dtype=np.uint8)
        grid[:, :-1] = self.chars[ids]
        size = self.size[ids]
        grid[np.arange(len(ids)), size] = after
        return grid[np.arange(width) <= size[:, None]], size + 1


def group_digests(a: np.ndarray, b: np.ndarray, a_cut: np.ndarray, b_cut: np.ndarray, a_n: np.ndarray, b_n: np.ndarray, digits: _Digits) -> list[str]:
    """SHA-256 of ``a1,a2|b1;a3|b2,b3`` for each text."""
    a_group, b_group = np.cumsum(a_cut) - a_cut, np.cumsum(b_cut) - b_cut
    a_in, b_in = np.bincount(a_group), np.bincount(b_group)
    b_before = np.concatenate([[0], np.cumsum(b_in)])[a_group]
    a_before = np.cumsum(a_in)[b_group]
    ids, after = np.empty(len(a) + len(b), dtype=np.int64), np.empty(len(a) + len(b), dtype=np.uint8)
    a_at, b_at = np.arange(len(a)) + b_before, np.arange(len(b)) + a_before
    ids[a_at], ids[b_at] = a, b
    after[a_at], after[b_at] = np.where(a_cut, ord("|"), ord(",")), np.where(b_cut, ord(";"), ord(","))
    text, size = digits.join(ids, after)
    ends = np.cumsum(size)[np.cumsum(a_n + b_n) - 1]
    flat = memoryview(text)
    return [hashlib.sha256(flat[s : e - 1]).hexdigest() for s, e in zip(np.concatenate([[0], ends[:-1]]), ends)]


_SLICE = pa.schema([("slice", pa.int64()), ("n_pairs", pa.int64()), ("ids", pa.list_(pa.string())), ("sha256", pa.list_(pa.string())), ("numbers", pa.list_(pa.binary())), ("codes", pa.binary()), ("per_doc", pa.binary()), ("pair", pa.binary()), ("times", pa.binary())])
_loaded: dict = {}


def _tokenizers(a_path: str, b_path: str) -> tuple[Tokenizers, _Digits]:
    """One pair of tokenizers for each Python worker."""
    if (a_path, b_path) not in _loaded:
        t = Tokenizers(a_path, b_path)
        _loaded[a_path, b_path] = t, _Digits(max(t.a_bytes.n, t.b_bytes.n))
    return _loaded[a_path, b_path]


def _aligned(texts: list, both: Tokenizers, digits: _Digits):
    """Numbers by text (n_a, n_b, n_groups, n_links), digests, and the
    distinct pairs of each text: (text, code = A id * 2^32 + B id, times)."""
    n = len(texts)
    numbers, sha = np.zeros((4, n), dtype=np.int64), [""] * n
    none = np.zeros(0, np.int64)
    rows = [i for i in range(n) if texts[i]]
    if not rows:
        return numbers, sha, (none, none.astype(np.uint64), none)
    raw = [(" " + texts[i]).encode() for i in rows]
    data = np.frombuffer(b"".join(raw), dtype=np.uint8)
    offsets = np.concatenate([[0], np.cumsum([len(r) for r in raw])])
    (a, a_n), (b, b_n) = both.tokens([both.words(texts[i]) for i in rows])
    a_good, a_size = _same(both.a_bytes, a, a_n, data, offsets)
    b_good, b_size = _same(both.b_bytes, b, b_n, data, offsets)
    good = a_good & b_good
    a_use, b_use = np.repeat(good, a_n) & (a_size > 0), np.repeat(good, b_n) & (b_size > 0)
    text_a, text_b = np.repeat(np.arange(len(rows)), a_n)[a_use], np.repeat(np.arange(len(rows)), b_n)[b_use]
    a, b = a[a_use], b[b_use]
    a_n, b_n = np.bincount(text_a, minlength=len(rows))[good], np.bincount(text_b, minlength=len(rows))[good]
    if not len(a):
        return numbers, sha, (none, none.astype(np.uint64), none)
    rows = np.array(rows)[good]
    x, y, a_cut, b_cut = align(np.cumsum(a_size[a_use]), np.cumsum(b_size[b_use]), a_n, b_n)
    first = np.concatenate([[0], np.cumsum(a_n)])
    of = np.repeat(np.arange(len(rows)), a_n)
    numbers[0, rows], numbers[1, rows] = a_n, b_n
    numbers[2, rows] = np.add.reduceat(a_cut.astype(np.int64), first[:-1])
    numbers[3, rows] = np.bincount(of[x], minlength=len(rows))
    for i, digest in zip(rows, group_digests(a, b, a_cut, b_cut, a_n, b_n, digits)):
        sha[i] = digest
    # distinct pairs of each text
    code = (a[x].astype(np.uint64) << np.uint64(32)) | b[y].astype(np.uint64)
    codes, place = np.unique(code, return_inverse=True)
    key, times = np.unique(of[x] * len(codes) + place, return_counts=True)
    return numbers, sha, (rows[key // len(codes)], codes[key % len(codes)], times)


def _packed(a_path: str, b_path: str, text_bytes: int, slice_links: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, digits = _tokenizers(a_path, b_path)
        number = next_slice()
        ids: list = []
        parts: list = []

        def out() -> pa.RecordBatch:
            numbers = np.concatenate([p[0] for p in parts], axis=1)
            code = np.concatenate([p[2][1] for p in parts])
            base = np.cumsum([0] + [p[0].shape[1] for p in parts])
            doc = np.concatenate([p[2][0] + s for p, s in zip(parts, base)])
            codes, place = np.unique(mix(code), return_inverse=True)
            row = [next(number), len(codes), list(ids), [s for p in parts for s in p[1]], [pack(c) for c in numbers], pack_rising(codes), pack(np.bincount(doc, minlength=base[-1])), pack(place), pack(np.concatenate([p[2][2] for p in parts]))]
            ids.clear()
            parts.clear()
            return pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(row, _SLICE)], schema=_SLICE)

        for batch in batches:
            doc, text = (batch.column(c) for c in ("doc_id", "text"))
            size = pc.fill_null(pc.binary_length(text), 0).to_numpy(zero_copy_only=False)
            at = 0
            while at < len(size):
                end = at + max(1, int(np.searchsorted(np.cumsum(size[at : at + 65536]), text_bytes, side="right")))
                end = min(end, len(size))
                ids.extend(doc[at:end].to_pylist())
                parts.append(_aligned(text[at:end].to_pylist(), both, digits))
                at = end
                if sum(int(p[0][3].sum()) for p in parts) >= slice_links:
                    yield out()
        if ids:
            yield out()

    return run


def _ask(parts: int):
    def ask(row: dict) -> Iterator[tuple]:
        codes = unpack_rising(row["codes"])
        times = np.zeros(len(codes), dtype=np.int64)
        np.add.at(times, unpack(row["pair"]).astype(np.int64), unpack(row["times"]).astype(np.int64))
        yield from request(row["slice"], 0, 1, codes, times, parts)

    return ask


def _highest(keys: np.ndarray, totals: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The highest total of each B id among a part's pairs."""
    b = (unmix(keys) & np.uint64(0xFFFFFFFF)).astype(np.int64)
    ids, place = np.unique(b, return_inverse=True)
    most = np.zeros(len(ids), dtype=np.int64)
    np.maximum.at(most, place, totals)
    return ids, most


def _rows_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for t in batch.column("totals"):
            b, n = (unpack(c.as_buffer()).astype(np.int64) for c in t)
            yield pa.RecordBatch.from_arrays([pa.array(b), pa.array(n)], names=["b", "n"])


_RESULT = "ids array<string>, n_a array<long>, n_b array<long>, n_groups array<long>, n_links array<long>, n_best array<long>, count_sum array<long>, sha256 array<string>"


def _judged(best):
    def fn(row: dict, totals: dict) -> pa.RecordBatch:
        highest = best.value
        codes = unpack_rising(row["codes"])
        total = totals.get((0, 0), np.zeros(0, dtype=np.int64))
        is_best = total == highest[(unmix(codes) & np.uint64(0xFFFFFFFF)).astype(np.int64)]
        pair, times, per = (unpack(row[c]).astype(np.int64) for c in ("pair", "times", "per_doc"))
        doc = np.repeat(np.arange(len(per)), per)
        n_best, count_sum = np.zeros(len(per), dtype=np.int64), np.zeros(len(per), dtype=np.int64)
        np.add.at(n_best, doc, times * is_best[pair])
        np.add.at(count_sum, doc, times * total[pair])
        values = [row["ids"], *(unpack(c).astype(np.int64) for c in row["numbers"]), n_best, count_sum, row["sha256"]]
        kinds = [pa.list_(pa.string()), *[pa.list_(pa.int64())] * 6, pa.list_(pa.string())]
        return pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names=["ids", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha256"])

    return fn


def pair_counts(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE, text_bytes: int = TEXT_BYTES, slice_links: int = SLICE_LINKS) -> tuple[DataFrame, DataFrame]:
    """(slices of aligned documents, corpus totals of their id pairs)"""
    d = pick(docs, "doc_id", "text").select(F.col("doc_id").cast("string").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "slice long, n_pairs long, ids array<string>, sha256 array<string>, numbers array<binary>, codes binary, per_doc binary, pair binary, times binary"
    slices = written(d.mapInArrow(_packed(a_path, b_path, text_bytes, slice_links), schema), "alignment-slices")
    asked = slices.agg(F.sum("n_pairs")).first()[0] or 0
    return slices, written(answers(requests(slices.select("slice", "codes", "pair", "times"), _ask(n_parts(asked))), summary=_highest), "alignment-totals")


def align_documents(docs: DataFrame, a_path: str = BYTE_BPE, b_path: str = PIECE_BPE, **sizes) -> DataFrame:
    """The query: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and
    groups_sha256 of each document."""
    spark = docs.sparkSession
    slices, totals = pair_counts(docs, a_path, b_path, **sizes)
    tops = totals.filter(F.col("slice") == PART_ROW).select("totals").mapInArrow(_rows_of, "b long, n long").groupBy("b").agg(F.max("n").alias("n")).toPandas()
    highest = np.zeros(int(tops["b"].max()) + 1 if len(tops) else 1, dtype=np.int64)
    highest[tops["b"].to_numpy(dtype=np.int64)] = tops["n"].to_numpy(dtype=np.int64)
    # a slice without links has nothing to ask; its own empty answer keeps it in
    kept = totals.unionAll(slices.filter("n_pairs = 0").selectExpr("0L", "slice", "0", "0", "0L", "cast(array() as array<binary>)"))
    per = with_answers(slices, kept, _judged(spark.sparkContext.broadcast(highest)), _RESULT)
    kind = pick(docs, "doc_id").schema["doc_id"].dataType
    names = ["ids", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "sha256"]
    rows = per.select(F.explode(F.arrays_zip(*[F.col(c) for c in names])).alias("d"))
    return rows.select(F.col("d.ids").cast(kind).alias("doc_id"), *[F.col(f"d.{c}").alias(c) for c in names[1:-1]], F.col("d.sha256").alias("groups_sha256"))
