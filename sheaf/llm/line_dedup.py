"""Near-equal lines by deletion neighbourhoods, built-in functions only.

Two lines are near when one edit (a character replaced, added or taken out)
turns one into the other. A line emits, as hashed keys, itself and every
string that deleting one character leaves; lines meet where keys are equal,
the edit distance is verified, and of lines that are near the earliest
occurrence (by doc_id, then hash of the text, then line number) stays. This
holds for lines of every length, short ones too (``min_chars`` leaves shorter
lines out of the search for near ones; equal lines are always found).

Lines of up to ``SHORT`` characters emit their whole neighbourhood. A line of 300 characters has 301 such strings, nearly all of them without a
partner, so a line emits them only where a partner is possible. One edit
leaves one half of the line as it was: lines that share neither half with
any other drop out on four keys. The rest cut the other half in chunks: all
chunks but one must agree. Only the chunk that is left emits its deletions,
under a key of everything around it, so a line's work follows its length.

All lines that delete the same place to the same string are one edit from
each other, so each needs comparing only with the earliest of them, and a
shorter line only with the earliest line that it is a deletion of: the work
is one row a key, never a pair for every two members. Keys and minima are
partial aggregates; joins back to them are plain equality joins. The texts of
lines move only if the line is in question: the others are dropped where they
are read, by a broadcast bitmap of ``2 ** BITS`` bits (at most 2 ** (BITS - 6)
rows of 64; with far more lines in question than bits it drops fewer, and the
join after it does the rest).

Defined cases: a NULL text has no lines; lines without a word are neither
compared nor counted; spaces at either end are not compared. Documents with
one id and different texts are in the order of the texts' hashes; rows with
one id and one text are judged alike, each has its own result row. NULL ids
come last. Texts and lines of any length take part whole; an empty table gives
no rows. Other columns are not read, and
``dedup`` passes them through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import named, pick
from .components import written
from .line_quality import SPACE, let

SHORT = 8
MIN_CHARS = 1
BITS = 24
CHUNKS = 8
WHOLE = 16  # a part up to so long is one chunk


def _place() -> Column:
    """(doc_id, hash of the text, line number), NULL ids last: no two lines
    that differ have one place. The id is of any type that sorts."""
    return F.struct(F.col("doc_id").isNull().alias("n"), F.col("doc_id").alias("d"), F.col("t").alias("t"), F.col("line").alias("line"))


def occurrences(docs: DataFrame) -> DataFrame:
    """doc_id, t (hash of the text), line (from 0), s: lines that hold a word."""
    d = pick(docs, "doc_id", "text").select("doc_id", F.col("text").cast("string").alias("text"))
    split = d.select("doc_id", F.xxhash64("text").alias("t"), F.posexplode(F.split("text", "\n", -1)).alias("line", "s"))
    return split.withColumn("s", F.btrim("s", F.lit(SPACE))).filter("s <> ''")


def _halves(s: Column) -> list[Column]:
    """Keys of the first and the last h characters, for both h that a line
    and one a character longer have in common; NULL where they coincide or
    the line is short."""
    n = F.char_length(s)
    out = []
    for more in (0, 1):
        h = F.floor((n - more) / 2).cast("int")
        for side, part in ((0, F.left(s, h)), (1, F.right(s, h))):
            use = (n >= SHORT) if not more else ((n >= SHORT) & (n % 2 == 0))
            out.append(F.when(use, F.xxhash64(F.lit(side), h, part)))
    return out


def _several(rows: DataFrame, key: str) -> DataFrame:
    """The rows whose key occurs more than once."""
    many = rows.groupBy(key).agg(F.count("*").alias("_n")).filter("_n > 1").select(key)
    return rows.join(many, key, "left_semi")


def _marked(rows: DataFrame, among: DataFrame) -> DataFrame:
    """The rows whose place may be among the given ones: a bitmap of their
    hashes, 64 bits a row, goes to all tasks."""
    bit = F.pmod(F.xxhash64("at"), F.lit(1 << BITS))
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(bit, F.lit(64)).cast("int"))
    words = among.groupBy(F.shiftright(bit, 6).alias("_w")).agg(F.bit_or(one).alias("_bits"))
    return rows.withColumn("_w", F.shiftright(bit, 6)).join(F.broadcast(words), "_w").filter(F.col("_bits").bitwiseAND(one) != 0).drop("_w", "_bits")


def near_lines(occ: DataFrame, min_chars: int = MIN_CHARS) -> tuple[DataFrame, DataFrame]:
    """(distinct, near): distinct lines as (h1, h2, at), at the place of the
    first occurrence; near: at of the lines that are near an earlier one."""
    s = F.col("s")
    keyed = occ.select(
        F.xxhash64("s").alias("h1"), F.xxhash64(F.lit("second"), "s").alias("h2"), _place().alias("at"), F.char_length(s).alias("n"),
        *[k.alias(f"b{i}") for i, k in enumerate(_halves(s))],
    )
    distinct = written(keyed.groupBy("h1", "h2").agg(F.min("at").alias("at"), F.first("n").alias("n"), *[F.first(f"b{i}").alias(f"b{i}") for i in range(4)]), "lines")
    # Halves that two distinct lines share.
    half = distinct.filter(F.col("n") >= min_chars).select("at", F.explode(F.array("b0", "b1", "b2", "b3")).alias("b")).filter("b IS NOT NULL")
    half = written(_several(half, "b"), "line-halves")
    # Lines still in question are numbered in the order of their places.
    short = distinct.filter(F.col("n").between(min_chars, SHORT)).select("at")
    asked = half.select("at").unionAll(short).distinct()
    number = written(asked.orderBy("at").select("at", F.monotonically_increasing_id().alias("o")), "line-numbers")
    text = _marked(occ.select(_place().alias("at"), "s"), number).join(number, "at").select("o", "s")
    text = written(text.groupBy("o").agg(F.first("s").alias("s")), "line-text")
    # The other half, in chunks, for a pair of lengths (m, m) and (m, m + 1).
    n = F.char_length(s)
    sides = [F.struct(F.lit(side).alias("side"), F.floor((n - more) / 2).cast("int").alias("h"), F.lit(more).alias("more")) for more in (0, 1) for side in (0, 1)]
    cut = text.select("o", "s", F.explode(F.array(*sides)).alias("c")).filter((F.col("c.more") == 0) | (n % 2 == 0))
    ctx = F.xxhash64("c.side", "c.h", F.when(F.col("c.side") == 0, F.left(s, F.col("c.h"))).otherwise(F.right(s, F.col("c.h"))))
    rest = F.when(F.col("c.side") == 0, F.right(s, n - F.col("c.h"))).otherwise(F.left(s, n - F.col("c.h")))
    cut = cut.select("o", ctx.alias("b"), rest.alias("mid"))
    cut = cut.join(half.select("b").distinct(), "b", "left_semi")
    cut = cut.select("o", "b", "mid", F.explode(F.array(F.lit(0), F.lit(1))).alias("longer"))
    cut = cut.withColumn("m", F.char_length("mid") - F.col("longer")).filter("m >= 0")
    cut = cut.withColumn("c", F.when(F.col("m") <= WHOLE, F.col("m") + 1).otherwise(F.ceil(F.col("m") / CHUNKS).cast("int")))
    cut = cut.select("*", F.explode(F.sequence(F.lit(0), F.ceil(F.greatest("m", F.lit(1)) / F.col("c")).cast("int") - 1)).alias("k"))
    before = F.left("mid", F.col("k") * F.col("c"))
    after = F.right("mid", F.greatest(F.lit(0), F.col("m") - (F.col("k") + 1) * F.col("c")))
    around = F.xxhash64("b", "m", "k", before, after)
    chunk = F.substring("mid", F.col("k") * F.col("c") + 1, F.char_length("mid") - F.char_length(before) - F.char_length(after))
    chunks = cut.select("o", "longer", around.alias("g"), chunk.alias("x"))
    whole = text.filter(n <= SHORT).select("o", F.explode(F.array(F.lit(0), F.lit(1))).alias("longer"), F.lit(0).cast("long").alias("g"), F.col("s").alias("x"))
    chunks = written(_several(chunks, "g").unionByName(whole), "line-chunks")
    # The chunk's deletion neighbourhood.
    x = F.col("x")
    deletions = F.transform(F.sequence(F.lit(1), F.char_length(x)), lambda i: F.struct(
        i.alias("i"), F.xxhash64(F.col("g"), F.concat(F.left(x, i - 1), F.substring(x, i + 1, F.char_length(x)))).alias("v")))
    deletions = F.when(F.char_length(x) > 0, deletions).otherwise(F.array().cast("array<struct<i:int,v:bigint>>"))
    itself = F.when(F.col("longer") == 0, F.array(F.struct(F.lit(0).alias("i"), F.xxhash64(F.col("g"), x).alias("v"))))
    variants = chunks.select("o", "longer", F.explode(F.concat(deletions, F.coalesce(itself, F.array().cast("array<struct<i:int,v:bigint>>")))).alias("d"))
    # Replaced: the same place deleted. Added: the longer line's deletion is
    # the shorter line itself (place -1 stands for both).
    place = F.when((F.col("longer") == 0) & (F.col("d.i") > 0), F.col("d.i")).otherwise(F.lit(-1))
    variants = variants.select("o", "longer", F.xxhash64("d.v", place).alias("v"), (place == -1).alias("added"))
    least = variants.groupBy("v").agg(
        F.count("*").alias("n"), F.min("o").alias("first"),
        F.min(F.when(F.col("longer") == 1, F.col("o"))).alias("first_longer"), F.min(F.when(F.col("longer") == 0, F.col("o"))).alias("first_shorter"),
    ).filter("n > 1")
    other = F.when(~F.col("added"), F.col("first")).when(F.col("longer") == 1, F.col("first_shorter")).otherwise(F.col("first_longer"))
    pairs = variants.join(least, "v").select("o", other.alias("p")).filter("p < o").distinct()
    a = text.select("o", F.col("s").alias("sa"))
    b = text.select(F.col("o").alias("p"), F.col("s").alias("sb"))
    near = pairs.join(a, "o").join(b, "p").filter(F.levenshtein("sa", "sb", 1).between(0, 1))
    return distinct.select("h1", "h2", "at"), near.select("o").distinct().join(number, "o").select("at")


def removed_lines(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """The query: doc_id, t, n_lines (with a word), n_equal and n_near
    removed, and the numbers of the removed lines, in order."""
    occ = occurrences(docs)
    distinct, near = near_lines(occ, min_chars)
    known = distinct.join(near.withColumn("near", F.lit(True)), "at", "left").select("h1", "h2", F.col("at").alias("first"), F.coalesce("near", F.lit(False)).alias("near"))
    at = occ.select("doc_id", "t", "line", F.xxhash64("s").alias("h1"), F.xxhash64(F.lit("second"), "s").alias("h2")).join(known, ["h1", "h2"])
    later = _place() > F.col("first")
    k = [F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("k"), "t"]
    gone = F.when(later | F.col("near"), F.col("line"))
    per = at.select(*k, "line", later.alias("later"), "near", gone.alias("gone")).distinct().groupBy("k", "t").agg(
        F.count("*").alias("n_lines"), F.count(F.when(F.col("later"), 1)).alias("n_equal"), F.count(F.when(F.col("near") & ~F.col("later"), 1)).alias("n_near"),
        F.sort_array(F.collect_list("gone")).alias("removed"),
    )
    every = pick(docs, "doc_id", "text").select("doc_id", *[c if isinstance(c, Column) else F.xxhash64(F.col("text").cast("string")).alias(c) for c in k])
    none = F.lit(0).cast("long")
    return every.join(per, ["k", "t"], "left").select(
        "doc_id", "t", F.coalesce("n_lines", none).alias("n_lines"), F.coalesce("n_equal", none).alias("n_equal"), F.coalesce("n_near", none).alias("n_near"),
        F.coalesce("removed", F.array().cast("array<int>")).alias("removed"),
    )


def dedup(docs: DataFrame, text: str = "text") -> DataFrame:
    """``docs`` without the removed lines; every column stays."""
    gone = removed_lines(docs.select(named("doc_id").alias("doc_id"), named(text).alias("text"))).select(F.col("doc_id").alias("_d"), F.col("t").alias("_t"), F.col("removed").alias("_gone"))
    gone = gone.filter(F.size("_gone") > 0).distinct()
    row = docs.select(F.struct(*[named(c) for c in docs.columns]).alias("_row"), F.xxhash64(named(text).cast("string")).alias("_h"))
    j = row.join(gone, F.col("_row")["doc_id"].eqNullSafe(F.col("_d")) & (F.col("_h") == F.col("_t")), "left")
    lines = F.split(F.col("_row")[text], "\n", -1)
    kept = F.array_join(let(lines, lambda ls: F.filter(ls, lambda x, i: ~F.array_contains(F.col("_gone"), i))), "\n")
    return j.select(*[(F.when(F.col("_gone").isNull(), F.col("_row")[c]).otherwise(kept) if c == text else F.col("_row")[c]).alias(c) for c in docs.columns])
