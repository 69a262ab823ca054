"""The typed route: documents as structs of a known schema instead of VARIANT.

The schema is given, or derived from the documents themselves
(:func:`derive_schema`). Members that the schema does not name are dropped,
text that does not fit it reads NULL (``from_json``, permissive)."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType, _parse_datatype_string

from ..functions.variant import col_of, first_or_null

_NAMES_APART = re.compile(r"(`(?:[^`]|``)*`)")


def derive_schema(documents: DataFrame, column: str = "resource") -> StructType:
    """The struct that all documents fit into: members of every document,
    numbers as wide as needed, VARIANT where kinds disagree, STRING where only
    JSON nulls occur. One aggregation; what comes back is one line of text."""
    found = documents.select(F.schema_of_variant_agg(col_of(column)).alias("s")).first()["s"]
    parts = _NAMES_APART.split(found or "VOID")  # every second part is a quoted name
    text = "".join(p if k % 2 else re.sub(r"\bVOID\b", "STRING", p.replace("OBJECT<", "STRUCT<")) for k, p in enumerate(parts))
    if not text.startswith("STRUCT<"):
        raise ValueError(f"the documents are not objects: {found}")
    return _parse_datatype_string(text)


def parse_typed(raw: DataFrame, schema: StructType | str, text: str = "value", into: str = "doc") -> DataFrame:
    """``raw`` with the documents' JSON text read into the struct ``into``."""
    return raw.withColumn(into, F.from_json(col_of(text), schema))


def _entries(doc: str) -> Column:
    return F.col(doc)["entry"]


def typed_entries(parsed: DataFrame, doc: str = "doc", keep: dict[str, Column] | None = None) -> DataFrame:
    """One row for each entry: ``keep`` (by default the document's id as
    ``bundle_id``), the entry's url, and every member of its resource as a
    column."""
    keep = keep if keep is not None else {"bundle_id": F.col(doc)["id"]}
    e = parsed.select(*[c.alias(n) for n, c in keep.items()], F.explode(_entries(doc)).alias("_e"))
    return e.select(*[col_of(n) for n in keep], F.col("_e.fullUrl").alias("fullUrl"), "_e.resource.*")


def entry_index(parsed: DataFrame, doc: str = "doc") -> DataFrame:
    """Urls and types of each document's entries, zipped by position."""
    entry = _entries(doc)
    zipped = F.arrays_zip(entry["fullUrl"].alias("fullUrl"), entry["resource"]["resourceType"].alias("resourceType"))
    p = parsed.select(F.col(doc)["id"].alias("bundle_id"), F.posexplode(zipped).alias("entry_pos", "_e"))
    return p.select("bundle_id", "entry_pos", F.col("_e")["fullUrl"].alias("fullUrl"), F.col("_e")["resourceType"].alias("resourceType"))


def first_entry_url(resource_type: str, doc: str = "doc") -> Column:
    """The url of a document's first entry of a type, else NULL. It is the
    same for every entry of the document, so it is no entry key."""
    return first_or_null(F.filter(_entries(doc), lambda e: e["resource"]["resourceType"] == resource_type))["fullUrl"]
