"""Mixing sources to target weights by weighted fair queueing.

Each source's documents are shuffled by a keyed hash and given a virtual
finish time: the source's cumulative tokens up to and including the
document, over the source's target. A document has one turn for each time
that its source may be gone through (``max_repeats``). The turns of all
sources are range-sorted by finish time, over all tasks, and the mix ends
where their running total passes the budget. So at any place of the mix every
source has had its share. :func:`mix` gives the turns in that order, each with its
place (tokens before it); :func:`schedule` adds them up for each document.

No running sum goes through one task. Rows fall into buckets by hash (within
a source) or by finish time, whose number follows the row count: sums per
bucket, running sums over a thousand buckets each, running sums over those
thousands (:func:`_before`), and a window inside each bucket. Only the sources
themselves, one row each, meet in one task for their targets.

Defined cases: NULL or wordless texts have size 0, no turns, and are taken 0
times; a source of only such texts has target 0; NULL source is a source, the
last; repeated rows are separate documents (rows with one id and one size have
one hash, and stand next to each other in the order of their source); an empty
table gives an empty mix. Only doc_id, source and the text are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import reliable_checkpoint
from .common import pick

#: fixed values
WEIGHTS = (3, 1, 2)
SHARE_PERCENT = 150
MAX_REPEATS = 2
SEED = "mix-1"
ROWS_A_BUCKET = 2048
SPACE = " \t\n\x0b\x0c\r"


def n_words(text: Column) -> Column:
    trimmed = F.btrim(text, F.lit(SPACE))
    return F.when(F.coalesce(trimmed, F.lit("")) == "", F.lit(0)).otherwise(F.size(F.split(trimmed, "[ \\t-\\r]+"))).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, percent: int = SHARE_PERCENT, repeats: int = MAX_REPEATS) -> DataFrame:
    """``sources``: source, source_size (one row each). Adds the target: the
    budget shared by weight, no target above ``repeats`` times its source,
    what is over shared again. In order of size over weight the capped
    sources come first, so one running sum finds the level of the rest."""
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    ranked = sources.withColumn("_r", (F.row_number().over(by_name) - 1) % len(weights))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("_r") + 1).cast("int"))
    s = ranked.select("source", "source_size", weight.alias("w"), (F.col("source_size") * repeats).alias("cap"))
    order = Window.orderBy(F.col("cap") / F.col("w"), F.col("source").isNull(), F.col("source"))
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(0, Window.unboundedFollowing)
    total = F.sum("source_size").over(Window.partitionBy())
    level = (total * percent / F.lit(100.0) - F.coalesce(F.sum("cap").over(before), F.lit(0))) / F.sum("w").over(rest)
    s = s.withColumn("level", level)
    open_ = F.min(F.when(F.col("level") * F.col("w") <= F.col("cap"), F.struct((F.col("cap") / F.col("w")).alias("k"), F.col("level").alias("l")))).over(Window.partitionBy())
    return s.select(
        "source", "source_size",
        F.least(F.col("cap").cast("double"), F.coalesce(open_["l"] * F.col("w"), F.col("cap").cast("double"))).alias("target"),
    )


def _before(buckets: DataFrame, bucket: str, size: str, within: tuple = ()) -> DataFrame:
    """``buckets`` (one row each, numbered) with ``_base``: the sum of ``size``
    over all buckets before, for each ``within``. A window sees a thousand
    buckets, or one row for each thousand."""
    fits = list(within)
    b = buckets.withColumn("_k", F.shiftright(bucket, 10))
    inside = Window.partitionBy(*fits, "_k").orderBy(bucket).rowsBetween(Window.unboundedPreceding, -1)
    over = Window.partitionBy(*fits).orderBy("_k").rowsBetween(Window.unboundedPreceding, -1)
    none = F.lit(0).cast("long")
    sums = b.groupBy(*fits, "_k").agg(F.sum(size).alias("_n")).select(*[F.col(c).alias(f"_w{i}") for i, c in enumerate(fits)], F.col("_k").alias("_kk"), F.coalesce(F.sum("_n").over(over), none).alias("_far"))
    same = F.col("_k") == F.col("_kk")
    for i, c in enumerate(fits):
        same = same & F.col(c).eqNullSafe(F.col(f"_w{i}"))
    near = b.withColumn("_near", F.coalesce(F.sum(size).over(inside), none))
    return near.join(sums, same).select(*buckets.columns, (F.col("_near") + F.col("_far")).alias("_base"))


def turns(docs: DataFrame, seed: str = SEED, rows_a_bucket: int = ROWS_A_BUCKET, **how) -> tuple[DataFrame, DataFrame]:
    """(documents, turns). ``docs``: doc_id, source, size and columns to
    carry. Documents get a row number, their source's size and target; turns,
    range-sorted in the order of the mix, have the row number, the time, and
    the place: the tokens of the mix before them."""
    docs = reliable_checkpoint(docs.withColumn("_row", F.monotonically_increasing_id()))  # numbers are fixed from here on
    src = docs.groupBy("source").agg(F.sum("size").alias("source_size"))
    goal = targets(src, **how).withColumnRenamed("source", "_s")
    repeats = how.get("repeats", MAX_REPEATS)
    n = docs.count()
    digits = 1
    while 16**digits * rows_a_bucket < n and digits < 8:
        digits += 1
    name = F.md5(F.concat_ws(":", F.lit(seed), F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.col("size").cast("string")))
    hashed = docs.filter("size > 0").select("_row", "source", "size", name.alias("_h")).withColumn("_b", F.conv(F.substring("_h", 1, digits), 16, 10).cast("long"))
    sums = hashed.groupBy("source", "_b").agg(F.sum("size").alias("_n"))
    sums = _before(sums, "_b", "_n", ("source",)).select(F.col("source").alias("_sb"), F.col("_b").alias("_bb"), "_base")
    inside = Window.partitionBy("source", "_b").orderBy("_h", "_row").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = hashed.withColumn("_in", F.sum("size").over(inside))
    at = at.join(sums, F.col("source").eqNullSafe(F.col("_sb")) & (F.col("_b") == F.col("_bb")))
    at = at.join(goal, F.col("source").eqNullSafe(F.col("_s")))
    again = F.explode(F.sequence(F.lit(0), F.lit(repeats - 1)))
    at = at.select("_row", "source", "size", "_h", "target", "source_size", (F.col("_base") + F.col("_in")).alias("_cum"), again.alias("turn"))
    time = (F.col("_cum") + F.col("source_size") * F.col("turn")) / F.col("target")
    # buckets of time: of equal width, and of equal ratio from 4 on (sources far above their target)
    fine = max(1, -(-n * repeats // rows_a_bucket))
    bucket = F.when(F.col("time") < 4, F.floor(F.col("time") * fine)).otherwise(4 * fine + F.floor((F.log2("time") - 2) * fine)).cast("long")
    all_turns = reliable_checkpoint(at.select("_row", "source", "size", "_h", "turn", time.alias("time")).withColumn("_t", bucket))
    # the global sort: buckets by range, rows of a bucket in order, and the running total over all
    order = [F.col("time"), F.col("source").isNull(), F.col("source"), F.col("_h"), F.col("_row"), F.col("turn")]
    base = _before(all_turns.groupBy("_t").agg(F.sum("size").alias("_n")), "_t", "_n").select(F.col("_t").alias("_tt"), "_base")
    run = Window.partitionBy("_t").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranged = all_turns.repartitionByRange("_t").withColumn("_run", F.sum("size").over(run))
    placed = ranged.join(base, F.col("_t") == F.col("_tt")).withColumn("place", F.col("_base") + F.col("_run") - F.col("size"))
    budget = goal.agg(F.coalesce(F.sum("target"), F.lit(0.0))).first()[0]
    taken = placed.filter(F.col("place") + F.col("size") <= F.lit(budget))
    known = docs.join(goal, F.col("source").eqNullSafe(F.col("_s"))).drop("_s")
    return known, taken.select("_row", "turn", "time", "place", "size")


def schedule(docs: DataFrame, seed: str = SEED, rows_a_bucket: int = ROWS_A_BUCKET, **how) -> DataFrame:
    """One row per document: doc_id, source, size, carried columns,
    source_size, target and ``taken`` words."""
    known, taken = turns(docs, seed, rows_a_bucket, **how)
    per = taken.groupBy("_row").agg(F.sum("size").alias("taken"))
    return known.join(per, "_row", "left").select(*docs.columns, "source_size", "target", F.coalesce("taken", F.lit(0).cast("long")).alias("taken"))


def mix_order(docs: DataFrame, **how) -> DataFrame:
    """The mix itself: a row for each turn taken, with all columns of
    ``docs`` (doc_id, source and size among them), its ``turn`` and ``place``,
    in the order of places over all partitions."""
    known, taken = turns(docs, **how)
    rows = known.join(taken.select("_row", "turn", "place"), "_row").select(*docs.columns, "turn", "place")
    return rows.repartitionByRange("place").sortWithinPartitions("place")


def sizes(docs: DataFrame) -> DataFrame:
    return pick(docs, "doc_id", "source", "text").select("doc_id", "source", n_words(F.col("text")).alias("size"))


def mix(docs: DataFrame) -> DataFrame:
    """The query: how often each document's words are in the mix."""
    return schedule(sizes(docs)).select("doc_id", "size", "source_size", "target", "taken")


#: The same in DuckDB: the order of the mix is one running sum there.
ORACLE = rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size FROM documents),
s AS (SELECT source, CAST(sum(size) AS BIGINT) AS source_size, (row_number() OVER (ORDER BY source IS NULL, source) - 1) % {len(WEIGHTS)} AS r FROM d GROUP BY source),
w AS (SELECT source, source_size, CAST(list_value({", ".join(map(str, WEIGHTS))})[r + 1] AS DOUBLE) AS w, source_size * {MAX_REPEATS} AS cap FROM s),
l AS (
  SELECT *, (sum(source_size) OVER () * {SHARE_PERCENT} / 100.0
             - coalesce(sum(cap) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
            / sum(w) OVER (ORDER BY cap / w, source IS NULL, source ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level FROM w),
g AS (
  SELECT source, source_size, least(CAST(cap AS DOUBLE), coalesce((SELECT arg_min(level, cap / w) FROM l WHERE level * w <= cap) * w, CAST(cap AS DOUBLE))) AS target FROM l),
h AS (SELECT *, md5(concat_ws(':', '{SEED}', coalesce(CAST(doc_id AS VARCHAR), ''), CAST(size AS VARCHAR))) AS h FROM d WHERE size > 0),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY h, rid ROWS UNBOUNDED PRECEDING) AS cum FROM h),
t AS (
  SELECT c.rid, c.size, c.source, c.h, e, (CAST(c.cum AS BIGINT) + g.source_size * e) / g.target AS f
  FROM c JOIN g ON c.source IS NOT DISTINCT FROM g.source CROSS JOIN range({MAX_REPEATS}) AS r(e)),
p AS (SELECT *, sum(size) OVER (ORDER BY f, source IS NULL, source, h, rid, e ROWS UNBOUNDED PRECEDING) AS place FROM t),
k AS (SELECT rid, sum(size) AS taken FROM p WHERE place <= (SELECT sum(target) FROM g) GROUP BY rid)
SELECT d.doc_id, d.size, g.source_size, g.target, CAST(coalesce(k.taken, 0) AS BIGINT) AS taken
FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source LEFT JOIN k USING (rid)
"""
