"""Column functions over VARIANT documents.

Everything here returns a ``Column`` built from Spark's own expressions
(``variant_get``, ``parse_json`` ...), so it stays inside whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str


def col_of(name: str) -> Column:
    """A column by its exact name, whatever characters it holds (dots,
    spaces, quotes, backticks): never parsed as a nested path."""
    return F.col("`" + name.replace("`", "``") + "`")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _path_part(key: str) -> str | None:
    """One step of a VARIANT path, or None for a key no path can spell: the
    quoted forms take no ``?`` and not their own quote, and a leading blank
    is skipped by the path reader."""
    if key.isidentifier():
        return f".{key}"
    if not key or key[0].isspace() or "?" in key:
        return None
    for quote in ('"', "'"):
        if quote not in key:
            return f"[{quote}{key}{quote}]"
    return None


def json_path(*keys: str) -> str:
    """A VARIANT path for a chain of object keys. Keys that are not plain
    identifiers (dots, quotes, spaces, leading digits) use the bracket form."""
    parts = [_path_part(k) for k in keys]
    if None in parts:
        raise ValueError(f"no path reads the key {keys[parts.index(None)]!r}: give the keys to field()")
    return "$" + "".join(parts)


def field(v: ColumnOrName, path: str | tuple[str, ...], type_: str = "variant", lenient: bool = False) -> Column:
    """Read ``path`` out of a VARIANT column as ``type_``.

    ``path`` is either a ready ``$...`` path or a tuple of keys. Paths are
    case-sensitive. Strict mode raises on a value that does not convert
    (``INVALID_VARIANT_CAST``); lenient mode gives NULL instead. A key that no
    path can spell (both quote kinds, ``?``) is looked up among its object's
    members.
    """
    fn = F.try_variant_get if lenient else F.variant_get
    if isinstance(path, str) and path.startswith("$"):
        return fn(_col(v), path, type_)
    at, step = _col(v), "$"
    for key in (path,) if isinstance(path, str) else path:
        part = _path_part(key)
        if part is not None:
            step += part
            continue
        at = F.try_element_at(F.try_variant_get(at, step, "map<string,variant>"), F.lit(key))
        step = "$"
    return fn(at, step, type_)


def field_text(text: ColumnOrName, path: str) -> Column:
    """JSON path on plain JSON text (no VARIANT needed)."""
    return F.get_json_object(_col(text), path)


def value_kind(v: ColumnOrName) -> Column:
    """Kind of a VARIANT value: string, number, boolean, null, object, array."""
    s = F.schema_of_variant(_col(v))
    return (
        F.when(_col(v).isNull(), F.lit(None))
        .when(s == "STRING", F.lit("string"))
        .when(s == "BOOLEAN", F.lit("boolean"))
        .when(s == "VOID", F.lit("null"))
        .when(s.startswith("OBJECT"), F.lit("object"))
        .when(s.startswith("ARRAY"), F.lit("array"))
        .when(s.isin("BIGINT", "DOUBLE", "FLOAT") | s.startswith("DECIMAL"), F.lit("number"))
        .otherwise(F.lower(s))
    )


def value_string(v: ColumnOrName) -> Column:
    """The value as text when it is a JSON string, else NULL."""
    return F.when(F.schema_of_variant(_col(v)) == "STRING", F.variant_get(_col(v), "$", "string"))


def value_number(v: ColumnOrName) -> Column:
    """The value as DOUBLE when it is a JSON number, else NULL."""
    return F.when(value_kind(v) == "number", F.variant_get(_col(v), "$", "double"))


def published(v: ColumnOrName, prefix: str = "value") -> list[Column]:
    """Plain-typed view of a VARIANT cell for publishing: kind, string, number,
    and JSON text for anything nested."""
    c = _col(v)
    kind = value_kind(c)
    return [
        kind.alias(f"{prefix}_kind"),
        value_string(c).alias(f"{prefix}_string"),
        value_number(c).alias(f"{prefix}_number"),
        F.when(kind.isin("object", "array", "boolean"), F.to_json(c)).alias(f"{prefix}_json"),
    ]


def parse_document(text: ColumnOrName, strict: bool = True) -> Column:
    """JSON text to VARIANT. Strict raises on malformed text or duplicate
    object keys; non-strict gives NULL (used for quarantine)."""
    return F.parse_json(_col(text)) if strict else F.try_parse_json(_col(text))


def content_id(*cols: ColumnOrName) -> Column:
    """Stable identity from content: SHA-256 over the given columns. A
    replayed file gives the same id, unlike ``uuid()``."""
    return F.sha2(F.concat_ws("|", *[_col(c).cast("string") for c in cols]), 256)


def random_id() -> Column:
    return F.expr("uuid()")


def is_json_null(v: ColumnOrName) -> Column:
    """True for a JSON ``null`` (a non-SQL-null VARIANT), false otherwise."""
    return F.is_variant_null(_col(v))


def first_or_null(arr: ColumnOrName) -> Column:
    """First element of an array, NULL for an empty array (never raises)."""
    return F.try_element_at(_col(arr), F.lit(1))


def columns_except(df, exclude) -> list[str]:
    """All column names of ``df`` but those in ``exclude``, in order (the
    complement projection used for grouping columns)."""
    drop = set(exclude)
    return [c for c in df.columns if c not in drop]


def split_names(text: str | None) -> list[str]:
    """Comma-separated names from configuration text -> clean list."""
    return [t.strip() for t in (text or "").split(",") if t.strip()]
