"""Keyed change application: latest value per key (type 1) or full history
(type 2), deletes, truncates, null-preserving updates, and the change feed
between two states.

Without a table format there is no MERGE, so the target is computed from
the change rows themselves: the result of applying changes in sequence
order equals an aggregation over all changes of a key, whatever order or
batch split they arrived in. Type 1 is one ``groupBy(keys)`` with
``max_by`` - a partial aggregate, so a hot key is reduced on the map side
before the shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.variant import col_of

SEQ = "_seq"
DEL = "_del"
TRUNC = "_trunc"
START_AT = "__START_AT"
END_AT = "__END_AT"


_q = col_of  # a column by its exact name


def _as_list(x) -> list[str]:
    if x is None:
        return []
    return [x] if isinstance(x, str) else list(x)


def _predicate(p: str | Column | None) -> Column:
    if p is None:
        return F.lit(False)
    c = F.expr(p) if isinstance(p, str) else p
    return F.coalesce(c, F.lit(False))


def _prepare(changes: DataFrame, keys, sequence_by, tie_break, delete_when, truncate_when):
    keys = _as_list(keys)
    seq_cols = _as_list(sequence_by) + _as_list(tie_break)
    value_cols = [c for c in changes.columns if c not in keys]
    src = changes.select(
        "*",
        F.struct(*[_q(c) for c in seq_cols]).alias(SEQ),
        _predicate(delete_when).alias(DEL),
        _predicate(truncate_when).alias(TRUNC),
    )
    if truncate_when is not None:
        # A truncate empties the whole target: only changes sequenced after
        # the last truncate survive. The cut is a scalar subquery.
        cut = src.filter(F.col(TRUNC)).select(F.max(SEQ)).scalar()
        src = src.filter(~F.col(TRUNC) & F.coalesce(F.col(SEQ) > cut, F.lit(True)))
    return keys, value_cols, src


def _output_columns(value_cols: list[str], columns, except_columns) -> list[str]:
    out = list(value_cols)
    if columns is not None:
        out = [c for c in out if c in set(columns)]
    if except_columns is not None:
        out = [c for c in out if c not in set(except_columns)]
    return out


def apply_changes(
    changes: DataFrame,
    keys,
    sequence_by,
    scd: int = 1,
    tie_break=None,
    ignore_null_updates: bool = False,
    delete_when: str | Column | None = None,
    truncate_when: str | Column | None = None,
    columns: list[str] | None = None,
    except_columns: list[str] | None = None,
    track: list[str] | None = None,
    track_except: list[str] | None = None,
) -> DataFrame:
    """Apply a table of change rows to an empty target.

    ``sequence_by`` (one or more columns) orders the changes of a key;
    ``tie_break`` columns order rows with equal sequence. A NULL sequence
    sorts lowest. ``delete_when`` / ``truncate_when`` are SQL predicates (a
    NULL result means no). Column choice (``columns`` / ``except_columns``)
    applies after the pick. Type 2 adds ``__START_AT`` / ``__END_AT``.
    """
    if scd not in (1, 2):
        raise ValueError("scd must be 1 or 2")
    if scd == 2 and truncate_when is not None:
        raise ValueError("truncate applies to type 1 only")
    keys, value_cols, src = _prepare(changes, keys, sequence_by, tie_break, delete_when, truncate_when)
    out_cols = _output_columns(value_cols, columns, except_columns)
    if scd == 1:
        return _latest(src, keys, value_cols, out_cols, ignore_null_updates)
    seq = _as_list(sequence_by)
    # Sequence columns change on every row, so they are never tracked.
    untracked = set(seq) | set(_as_list(tie_break)) | set(_as_list(track_except))
    tracked = list(track) if track is not None else [c for c in value_cols if c not in untracked]
    return _history(src, keys, value_cols, out_cols, tracked, seq)


def _latest(src: DataFrame, keys: list[str], value_cols: list[str], out_cols: list[str], ignore_null_updates: bool) -> DataFrame:
    if not ignore_null_updates:
        last = F.max_by(F.struct(*[_q(c) for c in value_cols], F.col(DEL)), F.col(SEQ)).alias("_last")
        agg = src.groupBy(*[_q(k) for k in keys]).agg(last)
        return agg.filter(~F.col("_last")[DEL]).select(*[_q(k) for k in keys], *[F.col("_last")[c].alias(c) for c in out_cols])
    # Per column: the latest non-NULL value after the last delete.
    aggs = [
        F.max_by(F.col(DEL), F.col(SEQ)).alias("_is_deleted"),
        F.max(F.when(F.col(DEL), F.col(SEQ))).alias("_last_delete"),
    ]
    slot = {c: f"_v{i}" for i, c in enumerate(value_cols)}
    for c in value_cols:
        keep = ~F.col(DEL) & _q(c).isNotNull()
        aggs.append(F.max_by(F.struct(F.col(SEQ).alias("s"), _q(c).alias("v")), F.when(keep, F.col(SEQ))).alias(slot[c]))
    agg = src.groupBy(*[_q(k) for k in keys]).agg(*aggs)
    cols = [
        F.when(F.col("_last_delete").isNull() | (F.col(slot[c])["s"] > F.col("_last_delete")), F.col(slot[c])["v"]).alias(c)
        for c in out_cols
    ]
    return agg.filter(~F.col("_is_deleted")).select(*[_q(k) for k in keys], *cols)


def _comparable(df: DataFrame, names: list[str], owner: str | None = None) -> Column:
    """The named columns as one value that ``=`` compares exactly (NULLs are
    equal). Only columns that cannot be compared, VARIANT and MAP, go through
    their JSON text; ``owner`` names a struct column that holds them."""
    kinds = dict(df.dtypes)

    def one(c: str) -> Column:
        value = F.col(owner)[c] if owner else _q(c)
        return F.to_json(F.struct(value.alias("v"))) if "variant" in kinds[c] or "map<" in kinds[c] else value

    return F.struct(*[one(c).alias(f"c{i}") for i, c in enumerate(names)]) if names else F.struct(F.lit(0))


def _segment(df: DataFrame, column: str) -> Column:
    """The stretch of the sequence a row falls into: an hour of a timestamp,
    a day of a date, 65,536 units of a number, the first 13 characters of a
    text (an hour of a written time). It depends on the row alone and never
    falls as the sequence rises; other types have one stretch."""
    kind, c = dict(df.dtypes)[column], _q(column)
    if kind.startswith("timestamp"):
        return F.date_trunc("hour", c)
    if kind in ("float", "double"):  # NaN sorts last
        return F.when(F.isnan(c), F.lit((1 << 63) - 1)).otherwise(F.floor(c / F.lit(65536)))
    if kind in ("tinyint", "smallint", "int", "bigint") or kind.startswith("decimal"):
        return F.floor(c / F.lit(65536))
    if kind == "string":
        return F.left(c, F.lit(13))
    return c if kind == "date" else F.lit(0)


def _history(src: DataFrame, keys, value_cols, out_cols, tracked, seq) -> DataFrame:
    """Type 2. A row opens a new version when it follows nothing, a delete, or
    a row with different tracked values; otherwise it updates the open
    version in place. A version ends at the sequence of the row after its
    last row (the next version's start, or a delete).

    Skew-safe by a prefix scan on two levels. The rows of a key are cut into
    segments by :func:`_segment`, a rule that reads the row alone, so any
    number of reads agree on them and nothing has to be stored first. Windows
    run per (key, segment), never over a whole key; a window over the
    segments of a key, one narrow row each, carries the previous tracked
    values, the version count and the next start across segments. The branch
    that makes these rows reads keys, sequence and tracked columns only. The
    full rows are shuffled once, by (key, segment), for their windows and the
    join with the carries alike.
    """
    kq = [_q(k) for k in keys]
    seq_value = _q(seq[0]) if len(seq) == 1 else F.struct(*[_q(c) for c in seq])
    # one struct: equal where the parts are, NULL parts included
    own = F.struct(F.struct(*kq).alias("k"), _segment(src, seq[0]).alias("s"))
    w = Window.partitionBy("_own").orderBy(SEQ)
    prev_tj, prev_del = F.lag("_tj").over(w), F.lag(DEL).over(w)
    opens = F.coalesce(~F.col(DEL) & (prev_del | (F.col("_tj") != prev_tj)), F.lit(False))  # NULL on a segment's first row

    narrow = src.select(own.alias("_own"), SEQ, DEL, seq_value.alias("_seq_value"), _comparable(src, tracked).alias("_tj"))
    seg = narrow.withColumn("_opens", opens).groupBy("_own").agg(
        F.min_by(F.struct("_tj", F.col(DEL).alias("d"), "_seq_value"), F.col(SEQ)).alias("_first"),
        F.max_by(F.struct("_tj", F.col(DEL).alias("d")), F.col(SEQ)).alias("_last"),
        F.sum(F.col("_opens").cast("long")).alias("_n"),
    )
    along = Window.partitionBy(F.col("_own.k")).orderBy(F.col("_own.s"))
    before = F.lag("_last").over(along)
    first_opens = ~F.col("_first.d") & (before.isNull() | before["d"] | (F.col("_first._tj") != before["_tj"]))
    seg = seg.select("_own", "_n", first_opens.alias("_first_opens"), F.lead(F.col("_first._seq_value")).over(along).alias("_next_segment_seq"))
    starts = F.sum(F.col("_n") + F.col("_first_opens").cast("long")).over(along.rowsBetween(Window.unboundedPreceding, -1))
    seg = seg.select(F.col("_own").alias("_seg"), (F.coalesce(starts, F.lit(0)) + F.col("_first_opens").cast("long")).alias("_carry"), "_next_segment_seq")

    rows = src.select(own.alias("_own"), *kq, *[_q(c) for c in value_cols], SEQ, DEL, seq_value.alias("_seq_value"), _comparable(src, tracked).alias("_tj"))
    rows = rows.select(
        "*",
        F.lead("_seq_value").over(w).alias("_next_local"),
        F.lead(F.lit(1)).over(w).isNull().alias("_last_row"),
        opens.alias("_opens"),
    )
    rows = rows.withColumn("_cum", F.sum(F.col("_opens").cast("long")).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    joined = rows.join(seg, F.col("_own") == F.col("_seg"))
    next_seq = F.when(F.col("_last_row"), F.col("_next_segment_seq")).otherwise(F.col("_next_local"))
    live = joined.filter(~F.col(DEL)).select(
        *kq, *[_q(c) for c in value_cols], SEQ, "_seq_value", (F.col("_carry") + F.col("_cum")).alias("_version"), next_seq.alias("_next_seq")
    )
    versions = live.groupBy(*kq, F.col("_version")).agg(
        F.min_by("_seq_value", F.col(SEQ)).alias(START_AT),
        F.max_by(F.struct(*[_q(c) for c in value_cols], F.col("_next_seq")), F.col(SEQ)).alias("_last"),
    )
    return versions.select(
        *kq,
        *[F.col("_last")[c].alias(c) for c in out_cols],
        F.col(START_AT),
        F.col("_last._next_seq").alias(END_AT),
    )


def change_feed(old: DataFrame, new: DataFrame, keys, version: int | None = None) -> DataFrame:
    """Row-level changes from state ``old`` to state ``new`` (both one row per
    key, NULL key parts included): ``_change_type`` insert / delete /
    update_preimage / update_postimage, plus ``_commit_version``. Unchanged
    rows are left out. A column that only one state has reads NULL in the
    other."""
    keys = _as_list(keys)
    vals = [c for c in new.columns if c not in keys]
    vals += [c for c in old.columns if c not in keys and c not in vals]
    types = {f.name: f.dataType for f in [*old.schema.fields, *new.schema.fields]}

    def state(df: DataFrame, name: str, key: str) -> DataFrame:
        have = set(df.columns)
        full = df.select(*[_q(k) for k in keys], *[_q(c) if c in have else F.lit(None).cast(types[c]).alias(c) for c in vals])
        return full.select(
            *[_q(k).alias(f"{key}{i}") for i, k in enumerate(keys)], F.struct(*[_q(c) for c in vals], F.lit(1).alias("_is")).alias(name),
            _comparable(full, vals).alias(f"{name}c"),
        )

    same = F.lit(True)
    for i in range(len(keys)):
        same = same & F.col(f"_ok{i}").eqNullSafe(F.col(f"_nk{i}"))
    j = state(old, "_o", "_ok").join(state(new, "_n", "_nk"), same, "full_outer")
    ins = F.col("_o").isNull()
    dele = F.col("_n").isNull()
    upd = ~ins & ~dele & ~F.col("_oc").eqNullSafe(F.col("_nc"))
    item = lambda t, s: F.struct(F.lit(t).alias("t"), F.col(s).alias("v"))
    items = (
        F.when(ins, F.array(item("insert", "_n")))
        .when(dele, F.array(item("delete", "_o")))
        .when(upd, F.array(item("update_preimage", "_o"), item("update_postimage", "_n")))
    )  # no match -> NULL -> explode emits nothing
    key = [F.when(ins, F.col(f"_nk{i}")).otherwise(F.col(f"_ok{i}")).alias(k) for i, k in enumerate(keys)]
    ex = j.select(*key, F.explode(items).alias("_c"))
    return ex.select(
        *[_q(k) for k in keys],
        *[F.col("_c.v")[c].alias(c) for c in vals],
        F.col("_c.t").alias("_change_type"),
        F.lit(version).cast("bigint").alias("_commit_version"),
    )
