"""sheaf: nested JSON documents to query-ready tables on Spark.

Layers: ``sources`` (file streams, bronze layout, fixtures from the test
tables), ``functions`` (VARIANT column helpers), ``operators`` (explode,
summaries, pivot, change application, expectations), ``streaming``
(incremental runners) and ``plans`` (the end-to-end build).

The names below are the public API; each lives in the module shown.
"""

from .functions.variant import field, field_text, json_path, parse_document, split_names  # noqa: F401
from .operators.changes import apply_changes, change_feed  # noqa: F401
from .operators.explode import (  # noqa: F401
    explode_entries,
    explode_fields,
    explode_fields_sql,
    explode_header,
    explode_header_sql,
    fields_of_type,
)
from .operators.pivot import pivot_header, pivot_resource, typed, wide_difference  # noqa: F401
from .operators.quality import expect, expectation_counts, row_filter  # noqa: F401
from .operators.summaries import (  # noqa: F401
    discover_header_keys,
    discover_types,
    duplicate_keys,
    header_keys,
    name_difference,
    resource_type_keys,
    resource_types,
    type_key_dict,
    type_key_map,
)
from .plans.medallion import build_silver, header_silver, refresh_all, resource_silver, write_table  # noqa: F401
from .sources.documents import (  # noqa: F401
    landing_inventory,
    read_documents,
    sample_documents,
    split_rejects,
    stream_documents,
    to_bronze,
)
from .streaming.runner import ChangeLog, header_stream, header_table, ingest_documents, key_columns, silver_stream, silver_table  # noqa: F401
