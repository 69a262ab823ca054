"""Long rows -> wide rows, one VARIANT column per discovered key.

Three methods give the same table when entry urls are unique per document:

* ``regroup`` (the reference semantic): group the long rows of one type by
  (document, document time, entry url) and pick, per key, the value of the
  first entry in document order: ``min_by(value, (entry_pos, pos))`` with the
  ordering NULL for other keys. Deterministic; NULL when the key is absent;
  a JSON null stays a VARIANT null. Two entries sharing a url in a document
  merge into one row, each key from the first entry that has it. Given the
  entry table, the same pick runs on entry rows (one per entry, not one per
  key), which halves the time at sf0.1.
* ``pivot``: Spark's own ``groupBy().pivot(key, keys).agg(min_by(...))``.
* ``project``: no shuffle at all - read ``entry:resource.<key>`` straight
  from the entry rows. One row per entry, so duplicate urls stay apart.

The key list is fixed when the plan is built (as a stream's schema must be);
keys first seen later become columns on the next refresh.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.variant import col_of, field
from .changes import DEL, END_AT, SEQ, START_AT, TRUNC
from .explode import ROW_ID, UNIQUE_URLS

RESOURCE_GROUP = ["bundleUUID", "bundle_timestamp"]
HEADER_GROUP = ["bundleUUID", "fileMetadata", "ingestDate", "ingestTime", "bundle_id", "bundle_timestamp"]
# Columns that later steps add beside the keys: no key may take their names.
INTERNAL = ["batch_id", "entry_pos", UNIQUE_URLS, ROW_ID, SEQ, DEL, TRUNC, START_AT, END_AT]


def column_names(keys: list[str], reserved: list[str], known: dict[str, str] | None = None) -> dict[str, str]:
    """Map each key to a column name Spark can hold next to ``reserved``.

    Spark resolves names case-insensitively, so keys that differ only in case,
    or that equal a key column or an internal one, get a numeric suffix
    (``name_2``). Keys in ``known`` (an earlier mapping) keep their column.
    Returns {key: column}; keys that need no change map to themselves."""
    known = known or {}
    taken = {r.lower() for r in [*reserved, *INTERNAL, *known.values()]}
    out: dict[str, str] = {}
    for k in keys:
        if k in known:
            out[k] = known[k]
            continue
        name = k
        n = 1
        while name.lower() in taken:
            n += 1
            name = f"{k}_{n}"
        taken.add(name.lower())
        out[k] = name
    return out


def _first_value(k: str, order: tuple[str, ...]) -> Column:
    hit = F.col("key") == F.lit(k)
    return F.min_by(F.when(hit, F.col("value")), F.when(hit, F.struct(*order)))


def pivot_long(
    long: DataFrame,
    group: list[str],
    keys: list[str],
    reserved: list[str] | None = None,
    order: tuple[str, ...] = ("entry_pos", "pos"),
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Regroup long rows by ``group``, one column per key (first in document
    order, given by ``order``). Partial aggregation runs map-side, so a hot
    group is combined before the shuffle."""
    names = column_names(keys, reserved if reserved is not None else group, names)
    aggs = [_first_value(k, order).alias(names[k]) for k in keys]
    if not aggs:  # a type whose only key is the discriminator: key columns only
        return long.select(*group).distinct()
    # an exploded value carries the names of its whole document; the rows that
    # are sorted and moved here take the value alone
    alone = F.variant_get("value", "$", "variant") if long.schema["value"].dataType.typeName() == "variant" else F.col("value")
    return long.select(*dict.fromkeys([*group, "key", *order]), alone.alias("value")).groupBy(*group).agg(*aggs)


def pivot_resource(
    fields: DataFrame | None,
    resource_type: str,
    keys: list[str],
    method: str = "regroup",
    entries: DataFrame | None = None,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Wide table of one resource type: bundleUUID, bundle_timestamp,
    ``<type>_uuid`` and one VARIANT column per key (``resourceType`` itself
    is never a column).

    ``fields`` is the long key/value table; ``entries`` the entry table.
    ``project`` needs ``entries``; ``pivot`` needs ``fields``; ``regroup``
    uses ``entries`` when given (fewer rows; with ``url_check`` columns it
    skips the shuffle for documents whose urls are distinct), else
    ``fields``. ``names`` is an earlier key -> column mapping to hold to (see
    :func:`column_names`)."""
    keys = [k for k in keys if k != "resourceType"]
    url_col = f"{resource_type}_uuid"
    group = RESOURCE_GROUP + [url_col]
    if method == "project":
        if entries is None:
            raise ValueError("method='project' needs the entry table")
        names = column_names(keys, group, names)
        e = entries.filter(F.col("resourceType") == resource_type)
        return e.select(
            *RESOURCE_GROUP,
            F.col("fullUrl").alias(url_col),
            *[field("entry", ("resource", k)).alias(names[k]) for k in keys],
        )
    if method == "regroup" and entries is not None:
        return _regroup_entries(entries, resource_type, keys, group, names)
    if fields is None:
        raise ValueError(f"method={method!r} needs the long table")
    f = fields.filter(F.col("resourceType") == resource_type).withColumnRenamed("fullUrl", url_col)
    if method == "regroup":
        return pivot_long(f, group, keys, names=names)
    if method == "pivot":
        names = column_names(keys, group, names)
        # every long row keeps its group (an entry whose only key is the
        # discriminator still gives a row); the value list leaves that key out
        if not keys:
            return f.select(*group).distinct()
        wide = f.groupBy(*group).pivot("key", keys).agg(F.min_by("value", F.struct("entry_pos", "pos")))
        return wide.select(*group, *[col_of(k).alias(names[k]) for k in keys])
    raise ValueError("method must be 'regroup', 'pivot' or 'project'")


def _regroup_entries(entries: DataFrame, resource_type: str, keys: list[str], group: list[str], names: dict[str, str] | None = None) -> DataFrame:
    """The regroup semantic computed on entry rows instead of key/value rows:
    per key, the value of the first entry (by position) that has the key.
    Same result, but about (keys per entry) times fewer rows to shuffle and
    sort, since the long table repeats the group columns for every key."""
    names = column_names(keys, group, names)
    numbered = {UNIQUE_URLS, ROW_ID} <= set(entries.columns)
    checked = UNIQUE_URLS in entries.columns and not numbered
    e = entries.filter(F.col("resourceType") == resource_type).select(
        *RESOURCE_GROUP,
        F.col("fullUrl").alias(group[-1]),
        "entry_pos",
        *([F.col(UNIQUE_URLS)] if checked else []),
        # a document of distinct urls keeps its entries apart from those of
        # other rows with its id, as the split below does
        *([F.when(F.col(UNIQUE_URLS), F.col(ROW_ID)).alias(ROW_ID)] if numbered else []),
        *[field("entry", ("resource", k)).alias(names[k]) for k in keys],
    )
    value_cols = [col_of(names[k]) for k in keys]
    if checked:
        # A group never leaves its document, so in a document whose urls are
        # all distinct every group is one entry: its row is the result as is,
        # with no shuffle. Only documents with a repeated (or NULL) url go
        # through the group-by.
        direct = e.filter(F.col(UNIQUE_URLS)).select(*group, *value_cols)
        e = e.filter(~F.coalesce(F.col(UNIQUE_URLS), F.lit(False)))
    by = [*group, ROW_ID] if numbered else group
    if not keys:
        merged = e.select(*by).distinct()
    else:
        present = lambda c: F.when(col_of(c).isNotNull(), F.col("entry_pos"))
        merged = e.groupBy(*by).agg(*[F.min_by(col_of(names[k]), present(names[k])).alias(names[k]) for k in keys])
    if numbered:
        merged = merged.drop(ROW_ID)
    return direct.unionByName(merged) if checked else merged


def pivot_header(
    header: DataFrame | None,
    keys: list[str],
    method: str = "regroup",
    bronze: DataFrame | None = None,
    only_with_keys: bool = False,
    names: dict[str, str] | None = None,
) -> DataFrame:
    """Wide header table: document columns + one VARIANT column per header key.

    ``project`` reads ``$.Meta.<key>`` straight from bronze, one row per
    document, no shuffle. With ``only_with_keys`` it keeps just the documents
    whose ``Meta`` gives long rows (a non-empty object or array), which is
    exactly the regroup result when no two bronze rows share a document id
    (header keys are unique inside ``Meta``)."""
    if method == "project":
        if bronze is None:
            raise ValueError("method='project' needs the bronze table")
        from .explode import with_document_columns

        names = column_names(keys, HEADER_GROUP, names)
        d = with_document_columns(bronze)
        if only_with_keys:
            meta = lambda t: F.coalesce(F.size(F.try_variant_get(F.col("resource"), "$.Meta", t)), F.lit(0))
            d = d.filter((meta("map<string,variant>") > 0) | (meta("array<variant>") > 0))
        return d.select(*HEADER_GROUP, *[field("resource", ("Meta", k)).alias(names[k]) for k in keys])
    if header is None:
        raise ValueError("the long header table is needed")
    return pivot_long(header, HEADER_GROUP, keys, order=("pos",), names=names)


def typed(wide: DataFrame, types: dict[str, str], lenient: bool = False) -> DataFrame:
    """Publish VARIANT cells as plain typed columns (``{column: spark type}``);
    other columns pass through."""
    fn = F.try_variant_get if lenient else F.variant_get
    return wide.select(*[fn(col_of(c), "$", types[c]).alias(c) if c in types else col_of(c) for c in wide.columns])


def comparable(df: DataFrame) -> DataFrame:
    """VARIANT columns as JSON text, so rows can be compared and hashed."""
    out = []
    for f in df.schema.fields:
        out.append(F.to_json(col_of(f.name)).alias(f.name) if f.dataType.typeName() == "variant" else col_of(f.name))
    return df.select(*out)


def wide_difference(a: DataFrame, b: DataFrame, within: list[str] | None = None) -> DataFrame:
    """Rows of ``a`` not in ``b`` (side 'a_only') and of ``b`` not in ``a``
    (side 'b_only'), multiset semantics, on ``a``'s columns. VARIANT cells are
    compared through their JSON text (Spark cannot compare VARIANT). One pass:
    rows of a count +1 and of b -1, and what does not cancel is given back as
    often as it is left over. Equal rows are added up before the shuffle.
    ``within``: columns of both tables that are not compared, by which rows
    that are alike are likely to be in one place already (both dealt out by
    them). Counts are added up there first, and only what is left moves."""
    within = list(within or [])
    names = [c for c in a.columns if c not in within]
    columns = [col_of(c) for c in names]
    near = [col_of(c) for c in within]
    tag = lambda df, n: comparable(df.select(*near, *columns)).select(*near, F.struct(*columns).alias("_row"), F.lit(n).alias("_n"))
    tagged = tag(a, 1).unionAll(tag(b, -1))
    if within:
        tagged = tagged.groupBy(*near, "_row").agg(F.sum("_n").alias("_n")).filter("_n <> 0").select("_row", "_n")
    left = tagged.groupBy("_row").agg(F.sum("_n").alias("_n")).filter("_n <> 0")
    side = F.when(F.col("_n") > 0, "a_only").otherwise("b_only")
    each = left.select("_row", side.alias("side"), F.explode(F.sequence(F.lit(1).cast("long"), F.abs("_n"))))
    return each.select(*[F.col("_row")[c].alias(c) for c in names], "side")
