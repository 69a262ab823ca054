"""Personal data by weak supervision.

Every whole text gives base spans (fixed patterns with their checks, always
kept) and candidates: base matches that failed a check and looser forms
(spelled-out e-mail addresses, phone numbers without ``+``, IPv6). Labelers
vote on every span: the strict pattern, a checksum or shape test, a
gazetteer, the words to the left, the edges. Expectation-maximisation over
the vote patterns of all documents estimates how reliable each labeler is
for each kind (two classes, no labels used); a logistic classifier over the
votes and shape features is then trained on those posteriors and accepts or
refuses each candidate.

What training reads is the count of every pattern: votes and features have a
few values each, so there are at most ``PATTERNS`` patterns however many
spans exist, and the counts are partial aggregates over all documents. Texts
are read once; spans wait in a table in the shared checkpoint folder.

Defined cases: a NULL text is empty and has no spans; texts of any length are
gone through whole; repeated rows and texts that tie are judged alike; a NULL id
stays NULL; spans are offsets in code points, end exclusive; an empty table
gives no rows; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_path
from .common import pick

KINDS = ("email", "ip", "card", "phone")
LABELERS = ("pattern", "check", "gazetteer", "context", "edges")
FEATURES = 4  # three length bins, one separator flag
PATTERNS = len(KINDS) * 3 ** len(LABELERS) * 6
ACCEPT = 0.9

# Gazetteers and context words.
TLDS = frozenset("com net org edu gov mil int info biz io co uk us de fr es it nl be ch at pl se no dk fi ie pt gr cz ru ua cn jp kr in au nz br mx ar cl za ca eu tv me dev app ai".split())
COUNTRY_CODES = ("1", "7", "20", "27", "30", "31", "32", "33", "34", "36", "39", "40", "41", "43", "44", "45", "46", "47", "48", "49", "51", "52", "54", "55", "56", "57", "60", "61", "62", "63", "64", "65", "66", "81", "82", "84", "86", "90", "91", "351", "352", "353", "354", "358", "380", "420", "972")
FOR = {
    "email": re.compile(r"mail|contact|write to|correo|courriel", re.I),
    "ip": re.compile(r"\bip\b|address|host|server|adresse", re.I),
    "card": re.compile(r"card|visa|credit|tarjeta|karte|carte", re.I),
    "phone": re.compile(r"phone|\btel|call|fax|mobile|llam|telefon", re.I),
}
AGAINST = re.compile(r"version|isbn|order|invoice|build|serial|release|token|\bid\b", re.I)

DOMAIN = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
NOT_LOCAL = re.compile(r"[^A-Za-z0-9._%+-]")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
WHOLE = re.compile(r"(?<![0-9])[0-9]{14,19}(?![0-9])")
SPACE = re.compile(r" ")
SPELLED = re.compile(r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9._%+-]{1,64}[ ]?[\[({](?:at|@)[\])}][ ]?[A-Za-z0-9-]{1,63}(?:[ ]?(?:\.|[\[({](?:dot|\.)[\])}])[ ]?[A-Za-z0-9-]{2,63}){1,4}", re.I)
LOCAL_PHONE = re.compile(r"(?<![0-9A-Za-z+.\-])\(?[0-9]{2,4}\)?(?:[ .-][0-9]{2,5}){2,4}(?![0-9A-Za-z.\-])")
IPV6 = re.compile(r"(?<![0-9A-Fa-f:])(?:[0-9A-Fa-f]{1,4}:){7}[0-9A-Fa-f]{1,4}(?![0-9A-Fa-f:])")


def emails(text: str) -> Iterator[tuple[int, int]]:
    """Leftmost non-overlapping matches of the base pattern, found from the
    ``@`` so that a long run of letters costs one step a letter."""
    last = 0
    for m in DOMAIN.finditer(text):
        at = m.start()
        a = at
        while a > last and not NOT_LOCAL.match(text, a - 1):
            a -= 1
        if a < at:
            yield a, m.end()
            last = m.end()


def octets(s: str) -> bool:
    return all(len(p.lstrip("0")) <= 3 and int(p.lstrip("0") or 0) <= 255 for p in s.split("."))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = ord(c) - 48
        total += d if i % 2 == 0 else (2 * d - 9 if d > 4 else 2 * d)
    return total % 10 == 0


def _digits(s: str) -> str:
    return "".join(c for c in s if "0" <= c <= "9")


def card_ok(s: str) -> bool:
    d = _digits(s)
    return 14 <= len(d) <= 19 and luhn(d)


def matches(text: str) -> Iterator[tuple[str, int, int, bool]]:
    """(kind, start, end, is base) of base matches, failed ones included
    where they could still be personal data, and of the looser forms."""
    if "@" in text:
        for a, b in emails(text):
            yield "email", a, b, True
    for m in IP.finditer(text):
        yield "ip", m.start(), m.end(), octets(m[0])
    for m in CARD.finditer(text):
        if m.end() - m.start() >= 13:
            good = card_ok(m[0])
            if not good:  # two numbers side by side
                for part in WHOLE.finditer(m[0]):
                    if luhn(part[0]) and part[0] != m[0]:
                        yield "card", m.start() + part.start(), m.start() + part.end(), False
            yield "card", m.start(), m.end(), good
    if "+" in text:
        for m in PHONE.finditer(text):
            if 10 <= len(_digits(m[0])) <= 15:
                yield "phone", m.start(), m.end(), True
                continue
            ends = [x.start() for x in SPACE.finditer(m[0])]  # a number that runs into the next one
            fit = [e for e in ends if 10 <= len(_digits(m[0][:e])) <= 15 and m[0][e - 1].isdigit()]
            if fit:
                yield "phone", m.start(), m.start() + fit[0], False
    for kind, pattern in (("email", SPELLED), ("phone", LOCAL_PHONE), ("ip", IPV6)):
        for m in pattern.finditer(text):
            yield kind, m.start(), m.end(), False


def votes(kind: str, text: str, a: int, b: int, base: bool) -> str:
    """One character a labeler (1 yes, 0 no, - abstains), then the features."""
    s = text[a:b]
    d = _digits(s)
    loose = "-"
    if kind == "email":
        tld = re.split(r"[.\])}\s]", s)[-1].lower()
        check, gazetteer = tld.isalpha() and 2 <= len(tld) <= 24, "1" if tld in TLDS else "-"
    elif kind == "ip":
        v6 = ":" in s
        check, gazetteer = v6 or octets(s), "-" if v6 else "1" if octets(s) and 0 < int(s.split(".")[0].lstrip("0") or 0) < 224 else "0"
        loose = "-" if v6 else "0"
    elif kind == "card":
        check, gazetteer, loose = card_ok(s), "1" if d[0] in "3456" else "0", "-" if card_ok(s) else "0"
    else:
        check, gazetteer = 10 <= len(d) <= 15, "1" if s[0] == "+" and d.startswith(COUNTRY_CODES) else "-"
    left = text[max(0, a - 40) : a]
    context = "1" if FOR[kind].search(left) else "0" if AGAINST.search(left) else "-"
    edges = not (a and text[a - 1].isalnum()) and not (b < len(text) and text[b].isalnum())
    size = 0 if b - a < 12 else 1 if b - a < 20 else 2
    return f"{'1' if base else loose}{int(check)}{gazetteer}{context}{int(edges)}{size}{int(not s.isalnum())}"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("kind", pa.string()), ("start", pa.int32()), ("end", pa.int32()), ("base", pa.bool_()), ("votes", pa.string())])
    for batch in batches:
        spans = []
        for text in batch.column(1):
            text = text.as_py() or ""
            found = list(matches(text))
            taken = [(a, b) for _, a, b, base in found if base]
            keep = []
            for kind, a, b, base in found:
                if base or not any(a < y and x < b for x, y in taken):
                    keep.append({"kind": kind, "start": a, "end": b, "base": base, "votes": votes(kind, text, a, b, base)})
                    if not base:
                        taken.append((a, b))
            spans.append(keep)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(spans, pa.list_(span))], names=["doc_id", "spans"])


def fit(counts: dict[tuple[str, str], int], rounds: int = 50) -> dict[tuple[str, str], float]:
    """Acceptance probability of every (kind, pattern) with its count:
    expectation-maximisation for labels, then the classifier."""
    keys = sorted(counts)
    if not keys:
        return {}
    n = np.array([counts[k] for k in keys], dtype=float)
    v = np.array([[{"0": 0, "1": 1, "-": 2}[c] for c in p[: len(LABELERS)]] for _, p in keys])
    said = v < 2
    post = np.clip((np.where(said, v, 0).sum(1) + 0.5) / (said.sum(1) + 1), 0.02, 0.98)
    group = np.array([KINDS.index(k) for k, _ in keys])
    for _ in range(rounds):
        new = np.empty_like(post)
        for g in set(group):
            at = group == g
            w = np.stack([n[at] * (1 - post[at]), n[at] * post[at]])  # weight of the classes
            prior = (w.sum(1) + 1) / (w.sum() + 2)
            like = np.log(prior)[:, None] + np.zeros((2, at.sum()))
            for j in range(len(LABELERS)):
                # a labeler is right more often than not: two pseudo-votes say so
                yes = np.array([((w[c] * (v[at, j] == 1)).sum() + (2 if c else 1)) / ((w[c] * said[at, j]).sum() + 3) for c in (0, 1)])
                for c in (0, 1):
                    like[c] += np.where(v[at, j] == 1, np.log(yes[c]), np.where(v[at, j] == 0, np.log(1 - yes[c]), 0))
            new[at] = 1 / (1 + np.exp(np.clip(like[0] - like[1], -30, 30)))
        if np.abs(new - post).max() < 1e-6:
            break
        post = new
    x = [np.eye(len(KINDS))[group]]
    for g in range(len(KINDS)):
        on = (group == g)[:, None]
        x += [on * (v == 1), on * (v == 0)]
    x.append(np.eye(FEATURES - 1)[[int(p[-2]) for _, p in keys]])
    x.append(np.array([[int(p[-1])] for _, p in keys]))
    x = np.hstack(x).astype(float)
    beta = np.zeros(x.shape[1])
    weight = np.sqrt(n)  # a pattern seen a million times does not silence the rest
    for _ in range(25):  # Newton steps with a ridge
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        grad = x.T @ (weight * (post - p)) - 0.1 * beta
        hess = (x * (weight * p * (1 - p))[:, None]).T @ x + 0.1 * np.eye(len(beta))
        beta += np.linalg.solve(hess, grad)
    p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
    return {k: float(q) for k, q in zip(keys, p)}


def detect(docs: DataFrame, accept: float = ACCEPT) -> DataFrame:
    """doc_id and ``spans``: kind, start, end, base, p (the classifier's
    probability), base spans and accepted candidates in text order."""
    spark = docs.sparkSession
    text = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string").alias("text"))
    schema = f"doc_id {dict(text.dtypes)['doc_id']}, spans array<struct<kind: string, start: int, end: int, base: boolean, votes: string>>"
    path = scratch_path(spark, "pii")
    text.mapInArrow(_scan, schema).write.parquet(path)
    found = spark.read.schema(schema).parquet(path)
    rows = found.select(F.explode("spans").alias("s")).groupBy("s.kind", "s.votes").count().collect()  # PATTERNS rows at most
    p = fit({(r["kind"], r["votes"]): r["count"] for r in rows})
    table = F.create_map(*[F.lit(x) for (k, v), q in p.items() for x in (k + v, q)]) if p else F.lit(None).cast("map<string,double>")
    scored = F.transform("spans", lambda s: s.withField("p", F.coalesce(table[F.concat(s["kind"], s["votes"])], F.lit(0.0))))
    kept = F.filter(scored, lambda s: s["base"] | (s["p"] >= accept))
    rank = F.create_map(*[F.lit(x) for i, k in enumerate(KINDS) for x in (k, i)])
    ordered = F.array_sort(F.transform(kept, lambda s: F.struct(s["start"].alias("start"), rank[s["kind"]].alias("rank"), s["end"].alias("end"), s["kind"].alias("kind"), s["base"].alias("base"), s["p"].alias("p"))))
    return found.select("doc_id", ordered.alias("spans"))


def digests(found: DataFrame) -> DataFrame:
    """The query's columns from ``detect``'s spans."""
    def listed(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    def count(kind):
        return F.size(F.filter("spans", lambda s: s["base"] & (s["kind"] == kind))).cast("long").alias(f"n_{kind}")

    base = F.filter("spans", lambda s: s["base"])
    n = [count(k) for k in KINDS]
    return found.select("doc_id", *n, F.sha2(listed(base), 256).alias("base_sha256"), listed(F.col("spans")).alias("spans"))


def personal_data(docs: DataFrame) -> DataFrame:
    """The query: base counts and digests, and all spans."""
    return digests(detect(docs))
