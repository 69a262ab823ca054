"""Line-first quality rules, built-in functions only.

Every line is judged by itself (punctuation, navigation, boilerplate); the
failing lines go, and a document that loses more than ``max_loss`` of its
text goes with them. Each rule reads one row, so nothing is shuffled and no
document depends on another: the plan is a scan and a projection.

Defined cases: a NULL text has no words and fails; lines without a word are
neither judged nor counted; repeated rows are judged alike; texts and lines
of any length are judged whole; an empty table gives no rows; other columns
pass through ``clean`` untouched and may have any name except the ones it
appends, which replace columns of that name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, pick

#: fixed values
SPACE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
TERMINAL = ".!?:;\"')]…。！？"
BOILERPLATE = (
    "(?i)(all rights reserved|licensed under|under the mit license|privacy policy|terms of use|terms of service"
    "|cookie policy|uses cookies|enable javascript|lorem ipsum|click here|sign up for)"
)

MAX_LOSS = 0.6
MIN_WORDS = 10
MAX_REPEAT_PERCENT = 20
WINDOW = 5


def words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.array().cast("array<string>")).otherwise(
        F.split(trimmed, "[ \\t-\\r]+")
    )


def _without(text: Column, chars: str) -> Column:
    return F.char_length(F.translate(text, chars, ""))


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once: a lambda would otherwise
    compute an outer expression again for every element it visits."""
    return F.transform(F.array(value), body)[0]


def repeated_words(ws: Column, n: int = WINDOW) -> Column:
    """Number of words that lie in an n-word window found twice or more in
    the array, first occurrence included. Windows are compared by 64-bit
    hash; positions are looked at only where a window does repeat."""
    def windows(hashes: Column) -> Column:
        return F.transform(F.sequence(F.lit(1), F.size(hashes) - (n - 1)), lambda i: F.xxhash64(F.slice(hashes, i, n)))

    found = let(let(F.transform(ws, lambda w: F.xxhash64(w)), windows), lambda v: _covered(v, n))
    return F.when(F.size(ws) < n + 1, F.lit(0)).otherwise(found)


def _covered(windows: Column, n: int) -> Column:
    # sort (hash, position): a window repeats where a neighbour has its hash
    pairs = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    near = lambda s, k: F.get(s, k)["h"]
    twice = lambda s: F.filter(s, lambda x, k: near(s, k - 1).eqNullSafe(x["h"]) | near(s, k + 1).eqNullSafe(x["h"]))
    at = F.array_sort(F.transform(let(pairs, twice), lambda x: x["i"]))
    cover = F.aggregate(
        at,
        F.struct(F.lit(0).alias("n"), F.lit(-n).alias("last")),
        lambda a, p: F.struct((a["n"] + F.least(F.lit(n), p - a["last"])).alias("n"), p.alias("last")),
        lambda a: a["n"],
    )
    return F.when(F.size(F.array_distinct(windows)) == F.size(windows), F.lit(0)).otherwise(cover)


def has_word(line: Column) -> Column:
    return F.btrim(line, F.lit(SPACE)) != ""


def line_fails(line: Column) -> Column:
    """One line that holds a word: navigation (three separators or more),
    symbol noise (a twentieth of it or more), shouting (three doubled
    exclamation marks), a fragment of under three words without end
    punctuation, or a boilerplate phrase."""
    n = F.char_length(line)
    end = F.btrim(line, F.lit(SPACE))
    fragment = ~F.lit(TERMINAL).contains(F.substring(end, -1, 1)) & (F.size(F.split(end, "[ \\t-\\r]+")) < 3)
    return (
        (n - _without(line, "|") >= 3)
        | ((n - _without(line, SYMBOLS)) * 20 >= n)
        | (F.char_length(F.replace(line, F.lit("!!"), F.lit(""))) + 6 <= n)
        | fragment
        | line.rlike(BOILERPLATE)
    )


def judge(docs: DataFrame, text: str = "text", max_loss: float = MAX_LOSS) -> DataFrame:
    """``docs`` with the columns of the base rules, the kept text and the
    verdict appended: n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, lost_chars, line_chars, clean_text, kept."""
    t = F.coalesce(named(text).cast("string"), F.lit(""))
    made = {
        "_words": words(t),
        "_lines": F.split(t, "\n", -1),
    }
    rest = [c for c in docs.columns]
    a = docs.select(F.struct(*[named(c) for c in rest]).alias("_row"), t.alias("_t"), *[v.alias(k) for k, v in made.items()])
    filled = F.filter("_lines", has_word)
    a = a.select(
        "_row", "_t",
        F.size("_words").cast("long").alias("n_words"),
        _without(F.col("_t"), SPACE).cast("long").alias("word_chars"),
        (F.char_length("_t") - _without(F.col("_t"), SYMBOLS)).cast("long").alias("n_symbols"),
        (F.size(filled) - F.size(F.array_distinct(filled))).cast("long").alias("n_dup_lines"),
        repeated_words(F.col("_words")).cast("long").alias("n_repeat_words"),
        F.transform("_lines", lambda s: F.struct(s.alias("s"), (has_word(s) & line_fails(s)).alias("bad"))).alias("_j"),
    )
    chars = lambda xs: F.aggregate(xs, F.lit(0).cast("long"), lambda s, x: s + F.char_length(x["s"]))
    a = a.select(
        "*",
        ((F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PERCENT)).alias("base_failed"),
        chars(F.filter("_j", lambda x: x["bad"])).alias("lost_chars"),
        chars(F.filter("_j", lambda x: has_word(x["s"]))).alias("line_chars"),
        F.array_join(F.transform(F.filter("_j", lambda x: ~x["bad"]), lambda x: x["s"]), "\n").alias("clean_text"),
    )
    kept = ~F.col("base_failed") & (F.col("lost_chars") <= F.col("line_chars") * max_loss)
    new = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "lost_chars", "line_chars", "clean_text"]
    return a.select(*[F.col("_row")[c].alias(c) for c in rest if c not in {*new, "kept"}], *new, kept.alias("kept"))


def clean(docs: DataFrame, text: str = "text", n_chars: str | None = None, max_loss: float = MAX_LOSS) -> DataFrame:
    """The kept documents with the failing lines taken out of their text;
    all columns stay, in order. ``n_chars`` names a length column to redo."""
    judged = judge(pick(docs, *docs.columns).withColumn("_self", F.struct(*[named(c) for c in docs.columns])), text, max_loss)
    redone = {text: F.col("clean_text")} | ({n_chars: F.char_length("clean_text").cast("long")} if n_chars else {})
    return judged.filter("kept").select(
        *[redone.get(c, F.col("_self")[c]).alias(c) for c in docs.columns]
    )


def line_quality(docs: DataFrame) -> DataFrame:
    """The query: the base counts and the verdict of every document."""
    return judge(pick(docs, "doc_id", "text")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "lost_chars"
    )


ORACLE = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS t FROM documents),
w AS (SELECT r, doc_id, t, list_filter(regexp_split_to_array(t, '[ \t-\r]+'), lambda x: x <> '') AS ws FROM d),
g AS (SELECT r, i, array_to_string(ws[i:i+4], ' ') AS s FROM w, unnest(range(1, len(ws) - 3)) AS u(i) WHERE len(ws) >= 5),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, s) AS n FROM g) WHERE n > 1),
rep AS (SELECT r, count(DISTINCT i + k) AS n FROM twice, range(0, 5) AS o(k) GROUP BY r),
l AS (SELECT r, s, trim(s, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS e
      FROM (SELECT r, unnest(string_split(t, chr(10))) AS s FROM d)),
j AS (SELECT r, count(*) - count(DISTINCT s) AS dup, sum(length(s)) AS chars,
        sum(CASE WHEN length(s) - length(replace(s, '|', '')) >= 3
              OR (length(s) - length(regexp_replace(s, '[#*$%&|<>]', '', 'g'))) * 20 >= length(s)
              OR length(replace(s, '!!', '')) + 6 <= length(s)
              OR (NOT contains('.!?:;"'')]…。！？', right(e, 1)) AND len(regexp_split_to_array(e, '[ \t-\r]+')) < 3)
              OR regexp_matches(s, '(?i)(all rights reserved|licensed under|under the mit license|privacy policy|terms of use|terms of service|cookie policy|uses cookies|enable javascript|lorem ipsum|click here|sign up for)')
            THEN length(s) ELSE 0 END) AS lost
      FROM l WHERE e <> '' GROUP BY r),
a AS (SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
        CAST(length(regexp_replace(t, '[ \t-\r]', '', 'g')) AS BIGINT) AS word_chars,
        CAST(length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
        CAST(coalesce(dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(rep.n, 0) AS BIGINT) AS n_repeat_words,
        CAST(coalesce(lost, 0) AS BIGINT) AS lost_chars, coalesce(chars, 0) AS chars
      FROM w LEFT JOIN rep USING (r) LEFT JOIN j USING (r))
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words,
       (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed,
       (NOT (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AND lost_chars <= chars * 0.6) AS kept, lost_chars
FROM a
"""
