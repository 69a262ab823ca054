"""Independent SQL oracle (DuckDB dialect) for the query catalogue.

Every statement computes the expected result from the plain test tables,
without JSON: it re-derives which document each row lands in (including the
range split of :mod:`sheaf.sources.fixtures`), the sorted key positions,
and the change-application rules with window functions.
"""

from __future__ import annotations


TS = "'%Y-%m-%d %H:%M:%S.%f'"
DT = "'%Y-%m-%d %H:%M:%S'"

# Customer documents: entries, hot-key parts, entry positions.
def customer_docs(width: int = 16384) -> str:
    return f"""
WITH ent AS (
  SELECT c_custkey AS doc_key, CAST(-1 AS BIGINT) AS split, CAST(-1 AS BIGINT) AS srt,
         'Customer' AS rtype, 'urn:customer:' || CAST(c_custkey AS VARCHAR) AS url FROM customer
  UNION ALL
  SELECT o_custkey, o_orderkey, o_orderkey, 'Order', 'urn:order:' || CAST(o_orderkey AS VARCHAR) FROM orders
), doc AS (SELECT *, CASE WHEN split < 0 THEN 0 ELSE split // {width} END AS part FROM ent), pos AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY doc_key, part ORDER BY srt) - 1 AS INTEGER) AS entry_pos FROM doc
), d AS (SELECT DISTINCT doc_key, part FROM doc)
"""


CDOCS = customer_docs()

# Order documents: line items with their part and first-in-document rank.
ODOCS = f"""
WITH lp AS (SELECT *, l_linenumber // 64 AS part FROM lineitem),
r AS (
  SELECT *, row_number() OVER (
    PARTITION BY l_orderkey, part, l_linenumber
    ORDER BY l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST, l_quantity NULLS FIRST,
             l_extendedprice NULLS FIRST, l_discount NULLS FIRST, l_tax NULLS FIRST, l_returnflag NULLS FIRST,
             l_linestatus NULLS FIRST, l_shipdate NULLS FIRST) AS rn
  FROM lp
)
"""

LI_WIDE = f"""
  'urn:li:' || CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS LineItem_uuid,
  strftime(o_orderdate, {DT}) AS bundle_time,
  l_discount AS disc, l_returnflag AS flag, CAST(l_linenumber AS BIGINT) AS line, l_partkey AS part,
  l_extendedprice AS price, l_quantity AS qty, strftime(l_shipdate, '%Y-%m-%d') AS shipdate,
  l_linestatus AS status, l_suppkey AS supp, l_tax AS tax
"""

FIELD_ROWS = """
  SELECT 'urn:customer:' || CAST(c_custkey AS VARCHAR) AS url, 0 AS p, 'bal' AS key, 'number' AS value_kind,
         CAST(NULL AS VARCHAR) AS value_string, c_acctbal AS value_number FROM customer
  UNION ALL SELECT 'urn:customer:' || CAST(c_custkey AS VARCHAR), 1, 'name', 'string', c_name, NULL FROM customer
  UNION ALL SELECT 'urn:customer:' || CAST(c_custkey AS VARCHAR), 2, 'resourceType', 'string', 'Customer', NULL FROM customer
  UNION ALL SELECT 'urn:order:' || CAST(o_orderkey AS VARCHAR), 0, 'id', 'number', NULL, CAST(o_orderkey AS DOUBLE) FROM orders
  UNION ALL SELECT 'urn:order:' || CAST(o_orderkey AS VARCHAR), 1, 'resourceType', 'string', 'Order', NULL FROM orders
  UNION ALL SELECT 'urn:order:' || CAST(o_orderkey AS VARCHAR), 2, 'status', 'string', o_orderstatus, NULL FROM orders WHERE o_orderstatus <> 'O'
  UNION ALL SELECT 'urn:order:' || CAST(o_orderkey AS VARCHAR), CASE WHEN o_orderstatus <> 'O' THEN 3 ELSE 2 END,
                   'total', 'number', NULL, o_totalprice FROM orders
"""

HEADER_ROWS = """
  SELECT c_custkey AS doc_key, 'Debt' AS key, 0 AS p, 'number' AS value_kind, CAST(NULL AS VARCHAR) AS value_string,
         c_acctbal AS value_number FROM customer WHERE c_acctbal < 0
  UNION ALL SELECT c_custkey, 'Nation', CASE WHEN c_acctbal < 0 THEN 1 ELSE 0 END, 'number', NULL, CAST(c_nationkey AS DOUBLE) FROM customer
  UNION ALL SELECT c_custkey, 'Segment', CASE WHEN c_acctbal < 0 THEN 2 ELSE 1 END, 'string', c_mktsegment, NULL FROM customer
"""

ORDER_WIDE = """
SELECT 'urn:order:' || CAST(o_orderkey AS VARCHAR) AS Order_uuid, '2024-01-01 00:00:00' AS bundle_time,
       o_orderkey AS id, CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS status, o_totalprice AS total
FROM orders
"""

HEADER_WIDE = f"""{CDOCS}
SELECT CAST(d.doc_key AS VARCHAR) AS bundle_id, '2024-01-01 00:00:00' AS bundle_time,
       CASE WHEN c_acctbal < 0 THEN c_acctbal END AS Debt, CAST(c_nationkey AS BIGINT) AS Nation, c_mktsegment AS Segment
FROM d JOIN customer ON c_custkey = d.doc_key
"""

EV_COLS = f"user_id, event_id, strftime(ts, {TS}) AS ts, event_type, value, props"
LATEST = "QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS LAST, event_id DESC NULLS LAST) = 1"
W_EV = "WINDOW w AS (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST)"
VER = "sum(st) OVER (PARTITION BY user_id ORDER BY ts NULLS FIRST, event_id NULLS FIRST ROWS UNBOUNDED PRECEDING)"
LAST = "(ts, event_id)"


def _json_kind(expr: str) -> str:
    t = f"json_type({expr})"
    return (
        f"CASE WHEN {t} = 'VARCHAR' THEN 'string' WHEN {t} IN ('BIGINT','UBIGINT','DOUBLE') THEN 'number' "
        f"WHEN {t} = 'BOOLEAN' THEN 'boolean' WHEN {t} = 'NULL' THEN 'null' WHEN {t} = 'OBJECT' THEN 'object' "
        f"WHEN {t} = 'ARRAY' THEN 'array' END"
    )


_PROP = "props, '$.\"' || k || '\"'"

SQL: dict[str, str] = {
    "explode_entries": f"{CDOCS} SELECT CAST(doc_key AS VARCHAR) AS bundle_id, entry_pos, url AS fullUrl, rtype AS resourceType FROM pos",
    "entry_index": f"{CDOCS} SELECT CAST(doc_key AS VARCHAR) AS bundle_id, entry_pos, url AS fullUrl, rtype AS resourceType FROM pos",
    "document_fields": f"""{CDOCS}
        SELECT CAST(pos.doc_key AS VARCHAR) AS bundle_id, pos.url AS fullUrl, pos.rtype AS resourceType, pos.entry_pos,
               CAST(f.p AS INTEGER) AS pos, f.key, f.value_kind, f.value_string, f.value_number
        FROM pos JOIN ({FIELD_ROWS}) f ON f.url = pos.url""",
    "fields_of_type": f"""{CDOCS}
        SELECT CAST(pos.doc_key AS VARCHAR) AS bundle_id, pos.url AS Order_uuid, f.key, f.value_kind, f.value_string, f.value_number
        FROM pos JOIN ({FIELD_ROWS}) f ON f.url = pos.url WHERE pos.rtype = 'Order'""",
    "explode_header": f"""{CDOCS}
        SELECT CAST(d.doc_key AS VARCHAR) AS bundle_id, CAST(h.p AS INTEGER) AS pos, h.key, h.value_kind, h.value_string, h.value_number
        FROM d JOIN ({HEADER_ROWS}) h ON h.doc_key = d.doc_key""",
    "event_props_explode": f"""
        SELECT event_id, CAST(row_number() OVER (PARTITION BY event_id ORDER BY k) - 1 AS INTEGER) AS pos, k AS key,
               {_json_kind(_PROP)} AS value_kind,
               CASE WHEN json_type({_PROP}) = 'VARCHAR' THEN json_extract_string({_PROP}) END AS value_string,
               CASE WHEN json_type({_PROP}) IN ('BIGINT','UBIGINT','DOUBLE') THEN CAST(json_extract_string({_PROP}) AS DOUBLE) END AS value_number
        FROM (SELECT event_id, props, unnest(json_keys(props)) AS k FROM events)""",
    "resource_types": f"""{CDOCS}
        SELECT rtype AS resourceType, count(DISTINCT CAST(doc_key AS VARCHAR) || '/' || CAST(part AS VARCHAR)) AS raw_bundle_count
        FROM doc GROUP BY rtype""",
    "resource_type_keys": """
        SELECT resourceType, key, count(*) AS count FROM (
          SELECT 'Customer' AS resourceType, unnest(['bal', 'name', 'resourceType']) AS key FROM customer
          UNION ALL
          SELECT 'Order', unnest(CASE WHEN o_orderstatus <> 'O' THEN ['id', 'resourceType', 'status', 'total']
                                      ELSE ['id', 'resourceType', 'total'] END) FROM orders
        ) GROUP BY resourceType, key""",
    "header_keys": f"""{CDOCS}
        SELECT key, count(*) AS raw_bundle_count FROM (
          SELECT d.doc_key, unnest(CASE WHEN c_acctbal < 0 THEN ['Debt', 'Nation', 'Segment'] ELSE ['Nation', 'Segment'] END) AS key
          FROM d JOIN customer ON c_custkey = d.doc_key
        ) GROUP BY key""",
    "type_key_map": """
        SELECT resourceType, string_agg(key, ',' ORDER BY key) AS keys FROM (
          SELECT DISTINCT resourceType, key FROM (
            SELECT 'Customer' AS resourceType, unnest(['bal', 'name']) AS key FROM customer
            UNION ALL
            SELECT 'Order', unnest(CASE WHEN o_orderstatus <> 'O' THEN ['id', 'status', 'total'] ELSE ['id', 'total'] END) FROM orders
          )
        ) GROUP BY resourceType""",
    "discover_types": "SELECT DISTINCT 'Customer' AS resourceType FROM customer UNION SELECT DISTINCT 'Order' FROM orders",
    "duplicate_keys": f"""{ODOCS}
        SELECT 'urn:li:' || CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR) AS fullUrl, key, count(*) AS cnt
        FROM (SELECT l_orderkey, part, l_linenumber,
                     unnest(['disc', 'flag', 'line', 'part', 'price', 'qty', 'resourceType', 'shipdate', 'status', 'supp', 'tax']) AS key
              FROM lp)
        GROUP BY l_orderkey, part, l_linenumber, key HAVING count(*) > 1""",
    "name_difference": """
        WITH seen AS (SELECT DISTINCT 'Customer' AS name FROM customer UNION SELECT DISTINCT 'Order' FROM orders),
        exp AS (SELECT unnest(['Order', 'Practitioner']) AS name)
        SELECT name, 'missing' AS side FROM exp WHERE name NOT IN (SELECT name FROM seen)
        UNION ALL SELECT name, 'unexpected' FROM seen WHERE name NOT IN (SELECT name FROM exp)""",
    "text_resource_types": f"""
        WITH p AS (SELECT *, turn // 256 AS part FROM conversations)
        SELECT role AS resourceType, count(DISTINCT CAST(conv_id AS VARCHAR) || '/' || CAST(part AS VARCHAR)) AS raw_bundle_count
        FROM p GROUP BY role""",
    "pivot_resource_order": ORDER_WIDE,
    "pivot_resource_order_project": ORDER_WIDE,
    "pivot_resource_order_builtin": ORDER_WIDE,
    "pivot_resource_customer": """
        SELECT 'urn:customer:' || CAST(c_custkey AS VARCHAR) AS Customer_uuid, c_acctbal AS bal, c_name AS name FROM customer""",
    "pivot_header": HEADER_WIDE,
    "pivot_header_project": HEADER_WIDE,
    "header_silver": HEADER_WIDE,
    "pivot_duplicates": f"{ODOCS} SELECT {LI_WIDE} FROM r JOIN orders ON o_orderkey = l_orderkey WHERE rn = 1",
    "pivot_duplicates_long": f"{ODOCS} SELECT {LI_WIDE} FROM r JOIN orders ON o_orderkey = l_orderkey WHERE rn = 1",
    "wide_difference": f"{ODOCS} SELECT {LI_WIDE}, 'b_only' AS side FROM r JOIN orders ON o_orderkey = l_orderkey WHERE rn > 1",
    "text_pivot_user": """
        SELECT 'urn:turn:' || CAST(conv_id AS VARCHAR) || ':' || CAST(turn AS VARCHAR) AS user_uuid, turn AS n, text
        FROM conversations WHERE role = 'user'""",
    "expect_drop": f"SELECT * FROM ({ORDER_WIDE}) WHERE status IS NOT NULL",
    "expect_counts": """
        SELECT 'has_status' AS expectation, count(*) FILTER (WHERE o_orderstatus <> 'O') AS passed,
               count(*) FILTER (WHERE NOT coalesce(o_orderstatus <> 'O', false)) AS failed FROM orders
        UNION ALL
        SELECT 'big_total', count(*) FILTER (WHERE o_totalprice > 100000),
               count(*) FILTER (WHERE NOT coalesce(o_totalprice > 100000, false)) FROM orders""",
    "silver_order": """
        SELECT 'urn:order:' || CAST(o_orderkey AS VARCHAR) AS Order_uuid, o_orderkey AS id,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END AS status, o_totalprice AS total FROM orders""",
    "silver_order_filtered": """
        SELECT 'urn:order:' || CAST(o_orderkey AS VARCHAR) AS Order_uuid, o_orderkey AS id,
               o_orderstatus AS status, o_totalprice AS total
        FROM orders WHERE o_totalprice > 100000 AND o_orderstatus <> 'O'""",
    "silver_all_types": """
        SELECT 'Customer' AS resourceType, count(*) AS rows, count(DISTINCT c_custkey) AS urls FROM customer
        UNION ALL SELECT 'Order', count(*), count(DISTINCT o_orderkey) FROM orders""",
    "changes_latest": f"SELECT {EV_COLS} FROM events {LATEST}",
    "changes_delete": f"SELECT {EV_COLS} FROM (SELECT * FROM events {LATEST}) WHERE NOT coalesce(event_type = 'error', false)",
    "changes_ignore_nulls": f"""
        WITH ev AS (SELECT * REPLACE (CASE WHEN event_type <> 'view' THEN value END AS value) FROM events),
        latest AS (SELECT * FROM ev {LATEST}),
        nn AS (SELECT user_id, arg_max(value, {LAST}) FILTER (WHERE value IS NOT NULL) AS v FROM ev GROUP BY user_id)
        SELECT l.user_id, l.event_id, strftime(l.ts, {TS}) AS ts, l.event_type, nn.v AS value, l.props
        FROM latest l JOIN nn USING (user_id)""",
    "changes_truncate": f"""
        SELECT {EV_COLS} FROM (
          SELECT * FROM events
          WHERE NOT coalesce(event_type = 'signup' AND value > 300, false)
            AND coalesce({LAST} > (SELECT max({LAST}) FROM events WHERE event_type = 'signup' AND value > 300), true)
          {LATEST})""",
    "changes_tied_sequence": """
        SELECT o_custkey, o_orderkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice FROM orders
        QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderdate DESC NULLS LAST, o_orderkey DESC NULLS LAST) = 1""",
    "changes_except_columns": f"SELECT user_id, event_id, event_type, value FROM events {LATEST}",
    "changes_history": f"""
        WITH r AS (
          SELECT *, lag(event_type) OVER w AS pe, lag(value) OVER w AS pv, lag(props) OVER w AS pp,
                 row_number() OVER w AS rn, lead(ts) OVER w AS next_ts FROM events {W_EV}),
        s AS (SELECT *, CASE WHEN rn = 1 OR event_type IS DISTINCT FROM pe OR value IS DISTINCT FROM pv
                                  OR props IS DISTINCT FROM pp THEN 1 ELSE 0 END AS st FROM r),
        v AS (SELECT *, {VER} AS ver FROM s)
        SELECT user_id, arg_max(event_id, {LAST}) AS event_id, strftime(arg_max(ts, {LAST}), {TS}) AS ts,
               arg_max(event_type, {LAST}) AS event_type, arg_max(value, {LAST}) AS value,
               strftime(min(ts), {TS}) AS __START_AT, strftime(arg_max_null(next_ts, {LAST}), {TS}) AS __END_AT
        FROM v GROUP BY user_id, ver""",
    "changes_history_tracked": f"""
        WITH r AS (SELECT *, lag(event_type) OVER w AS pe, row_number() OVER w AS rn, lead(ts) OVER w AS next_ts FROM events {W_EV}),
        s AS (SELECT *, CASE WHEN rn = 1 OR event_type IS DISTINCT FROM pe THEN 1 ELSE 0 END AS st FROM r),
        v AS (SELECT *, {VER} AS ver FROM s)
        SELECT user_id, arg_max(event_type, {LAST}) AS event_type, arg_max(event_id, {LAST}) AS event_id,
               arg_max(value, {LAST}) AS value,
               strftime(min(ts), {TS}) AS __START_AT, strftime(arg_max_null(next_ts, {LAST}), {TS}) AS __END_AT
        FROM v GROUP BY user_id, ver""",
    "changes_history_delete": f"""
        WITH r AS (
          SELECT *, coalesce(event_type = 'error', false) AS del, lag(event_type) OVER w AS pe,
                 lag(coalesce(event_type = 'error', false)) OVER w AS pdel, row_number() OVER w AS rn,
                 lead(ts) OVER w AS next_ts FROM events {W_EV}),
        s AS (SELECT *, CASE WHEN NOT del AND (rn = 1 OR pdel OR event_type IS DISTINCT FROM pe) THEN 1 ELSE 0 END AS st FROM r),
        v AS (SELECT *, {VER} AS ver FROM s)
        SELECT user_id, arg_max(event_type, {LAST}) AS event_type, arg_max(event_id, {LAST}) AS event_id,
               strftime(min(ts), {TS}) AS __START_AT, strftime(arg_max_null(next_ts, {LAST}), {TS}) AS __END_AT
        FROM v WHERE NOT del GROUP BY user_id, ver""",
    "change_feed": f"""
        WITH b AS (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00' {LATEST}),
        a AS (SELECT * FROM (SELECT * FROM events {LATEST}) WHERE NOT coalesce(event_type = 'error', false)),
        u AS (SELECT b.user_id FROM b JOIN a USING (user_id)
              WHERE (b.event_id, b.ts, b.event_type, b.value, b.props) IS DISTINCT FROM (a.event_id, a.ts, a.event_type, a.value, a.props))
        SELECT {EV_COLS}, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version FROM a WHERE user_id NOT IN (SELECT user_id FROM b)
        UNION ALL SELECT {EV_COLS}, 'delete', CAST(1 AS BIGINT) FROM b WHERE user_id NOT IN (SELECT user_id FROM a)
        UNION ALL SELECT {EV_COLS}, 'update_preimage', CAST(1 AS BIGINT) FROM b WHERE user_id IN (SELECT user_id FROM u)
        UNION ALL SELECT {EV_COLS}, 'update_postimage', CAST(1 AS BIGINT) FROM a WHERE user_id IN (SELECT user_id FROM u)""",
    "typed_entries": """
        SELECT CAST(c_custkey AS VARCHAR) AS bundle_id, 'urn:customer:' || CAST(c_custkey AS VARCHAR) AS fullUrl,
               'Customer' AS resourceType, CAST(NULL AS BIGINT) AS id, CAST(NULL AS DOUBLE) AS total, CAST(NULL AS VARCHAR) AS status
        FROM customer
        UNION ALL
        SELECT CAST(o_custkey AS VARCHAR), 'urn:order:' || CAST(o_orderkey AS VARCHAR), 'Order', o_orderkey, o_totalprice,
               CASE WHEN o_orderstatus <> 'O' THEN o_orderstatus END FROM orders""",
    "first_entry_url": f"""{CDOCS}
        SELECT CAST(doc_key AS VARCHAR) AS bundle_id, arg_min(url, srt) FILTER (WHERE rtype = 'Order') AS first_order_url
        FROM pos GROUP BY doc_key, part""",
    "field_text": f"""{CDOCS}
        SELECT CAST(d.doc_key AS VARCHAR) AS bundle_id, c_mktsegment AS segment FROM d JOIN customer ON c_custkey = d.doc_key""",
    "require_type_bundle": f"""{CDOCS}
        SELECT CAST(doc_key AS VARCHAR) AS bundle_id, CAST(count(*) AS INTEGER) AS n_entries FROM doc GROUP BY doc_key, part""",
    "bronze_layout": f"""{CDOCS}
        SELECT 'fixture:/customer/' AS datasource,
               CAST(doc_key AS VARCHAR) || '-' || CAST(part AS VARCHAR) || '.json' AS inputFileName,
               'fixture:/customer/' || CAST(doc_key AS VARCHAR) || '-' || CAST(part AS VARCHAR) || '.json' AS fullFilePath,
               true AS whole_file, 64 AS id_length, true AS ingested_today
        FROM d""",
    "sample_documents": f"""{CDOCS}
        SELECT * FROM (SELECT CAST(doc_key AS VARCHAR) AS bundle_id, CAST(count(*) AS INTEGER) AS n_entries
                       FROM doc GROUP BY doc_key, part) ORDER BY bundle_id LIMIT 10""",
}

SQL["document_fields_sql"] = SQL["document_fields"]  # the SQL form of the same long table

SUPPLIER_JSON = """'{"resourceType":"Bundle","id":"' || CAST(s_suppkey AS VARCHAR) || '","entry":[{"fullUrl":"urn:supplier:' || CAST(s_suppkey AS VARCHAR)
  || '","resource":{"resourceType":"Supplier"' || coalesce(',"name":' || CAST(to_json(s_name) AS VARCHAR), '') || '}}]}'"""

STREAM_SQL: dict[str, str] = {
    "stream_ingest_explode": SQL["resource_type_keys"],
    "stream_pivot": ORDER_WIDE,
    "refresh_all_orders": SQL["silver_order"],
    "stream_silver_orders": SQL["silver_order"],
    "stream_versions_feed": f"""
        WITH b AS (SELECT * FROM (SELECT * FROM events WHERE ts < TIMESTAMP '2024-01-16 00:00:00' {LATEST})
                   WHERE NOT coalesce(event_type = 'error', false)),
        a AS (SELECT * FROM (SELECT * FROM events {LATEST}) WHERE NOT coalesce(event_type = 'error', false)),
        u AS (SELECT b.user_id FROM b JOIN a USING (user_id)
              WHERE (b.event_id, b.ts, b.event_type, b.value, b.props) IS DISTINCT FROM (a.event_id, a.ts, a.event_type, a.value, a.props))
        SELECT {EV_COLS}, 'insert' AS _change_type, CAST(1 AS BIGINT) AS _commit_version FROM a WHERE user_id NOT IN (SELECT user_id FROM b)
        UNION ALL SELECT {EV_COLS}, 'delete', CAST(1 AS BIGINT) FROM b WHERE user_id NOT IN (SELECT user_id FROM a)
        UNION ALL SELECT {EV_COLS}, 'update_preimage', CAST(1 AS BIGINT) FROM b WHERE user_id IN (SELECT user_id FROM u)
        UNION ALL SELECT {EV_COLS}, 'update_postimage', CAST(1 AS BIGINT) FROM a WHERE user_id IN (SELECT user_id FROM u)""",
    "stream_latest": SQL["changes_latest"],
    "stream_silver_history": f"""
        WITH ok AS (SELECT * FROM events WHERE coalesce(value >= 10, false)),
        r AS (
          SELECT *, coalesce(event_type = 'error', false) AS del, lag(event_type) OVER w AS pe,
                 lag(coalesce(event_type = 'error', false)) OVER w AS pdel, row_number() OVER w AS rn,
                 lead(ts) OVER w AS next_ts FROM ok {W_EV}),
        s AS (SELECT *, CASE WHEN NOT del AND (rn = 1 OR pdel OR event_type IS DISTINCT FROM pe) THEN 1 ELSE 0 END AS st FROM r),
        v AS (SELECT *, {VER} AS ver FROM s)
        SELECT user_id, arg_max(event_type, {LAST}) AS event_type, arg_max(event_id, {LAST}) AS event_id,
               strftime(min(ts), {TS}) AS __START_AT, strftime(arg_max_null(next_ts, {LAST}), {TS}) AS __END_AT
        FROM v WHERE NOT del GROUP BY user_id, ver HAVING arg_max(event_type, {LAST}) <> 'click'""",
    "stream_expect_counts": """
        SELECT 'not_a_view' AS expectation, 'warn' AS action, count(*) FILTER (WHERE event_type <> 'view') AS passed,
               count(*) FILTER (WHERE NOT coalesce(event_type <> 'view', false)) AS failed FROM events
        UNION ALL SELECT 'worth_ten', 'drop', count(*) FILTER (WHERE value >= 10), count(*) FILTER (WHERE NOT coalesce(value >= 10, false)) FROM events
        UNION ALL SELECT 'has_id', 'fail', count(*), 0 FROM events""",
    "stream_target_nulls": f"""
        WITH ev AS (SELECT * REPLACE (CASE WHEN event_type <> 'view' OR value > 300 THEN value END AS value) FROM events),
        t AS (SELECT * FROM ev WHERE NOT coalesce(event_type = 'signup' AND value > 300, false)
              AND coalesce({LAST} > (SELECT max({LAST}) FROM ev WHERE event_type = 'signup' AND value > 300), true)),
        latest AS (SELECT * FROM t {LATEST}),
        nn AS (SELECT user_id, arg_max(value, {LAST}) FILTER (WHERE value IS NOT NULL) AS v FROM t GROUP BY user_id)
        SELECT l.user_id, l.event_id, strftime(l.ts, {TS}) AS ts, l.event_type, nn.v AS value FROM latest l JOIN nn USING (user_id)""",
    "stream_header_silver": SQL["header_silver"],
    "stream_silver_case_keys": """
        SELECT 'urn:note:' || CAST(o_orderkey AS VARCHAR) AS Note_uuid, o_custkey AS batch_key,
               CASE WHEN o_orderstatus = 'O' THEN o_totalprice END AS code_first,
               CASE WHEN NOT coalesce(o_orderstatus = 'O', false) THEN o_totalprice END AS code_second
        FROM orders""",
    "stream_change_feed_grown": f"""
        SELECT {EV_COLS.replace(", props", "")}, CASE WHEN NOT coalesce(ts < TIMESTAMP '2024-01-16 00:00:00', false) THEN props END AS props
        FROM events""",
    "stream_silver_counts": """
        SELECT 'valid_bundleUUID' AS expectation, count(*) AS passed, 0 AS failed FROM orders
        UNION ALL SELECT 'valid_Order_uuid', count(*) FILTER (WHERE o_totalprice > 100000),
                         count(*) FILTER (WHERE NOT coalesce(o_totalprice > 100000, false)) FROM orders""",
    "landing_inventory": f"""
        SELECT CAST(s_nationkey AS INTEGER) AS nation, true AS new, CAST(1 AS BIGINT) AS files, CAST(sum(octet_length(CAST({SUPPLIER_JSON} AS BLOB)) + 1) AS BIGINT) AS bytes
        FROM supplier GROUP BY s_nationkey""",
    "landed_documents": f"""
        SELECT CAST(s_suppkey AS VARCHAR) AS bundle_id, CAST(s_nationkey AS INTEGER) AS nation, true AS in_sub_folder, true AS names_agree,
               CAST(sum(octet_length(CAST({SUPPLIER_JSON} AS BLOB)) + 1) OVER (PARTITION BY s_nationkey) AS BIGINT) AS file_size,
               true AS block_inside, true AS day_of_time, true AS content_id FROM supplier""",
    "ingest_rejects": f"""
        SELECT 'bronze' AS sink, CAST(s_suppkey AS VARCHAR) AS bundle_id, CAST(NULL AS VARCHAR) AS text FROM supplier WHERE NOT coalesce(s_acctbal < 0, false)
        UNION ALL SELECT 'rejects', NULL, substr({SUPPLIER_JSON}, 1, 20) FROM supplier WHERE s_acctbal < 0""",
    "discovered_names": f"""
        SELECT 'type' AS kind, CAST(row_number() OVER (ORDER BY n) - 1 AS INTEGER) AS place, n AS name
        FROM (SELECT DISTINCT 'Customer' AS n FROM customer UNION SELECT DISTINCT 'Order' FROM orders)
        UNION ALL
        SELECT 'header key', CAST(row_number() OVER (ORDER BY n) - 1 AS INTEGER), n FROM (
          SELECT DISTINCT 'Nation' AS n FROM customer WHERE c_nationkey IS NOT NULL UNION SELECT DISTINCT 'Segment' FROM customer WHERE c_mktsegment IS NOT NULL
          UNION SELECT DISTINCT 'Debt' FROM customer WHERE c_acctbal < 0)""",
    "stage_tables": f"""
        SELECT *, 'kept' AS stage FROM ({ORDER_WIDE}) UNION ALL SELECT *, 'temporary' FROM ({ORDER_WIDE})""",
    "grouping_columns": HEADER_WIDE,
    "key_labels": f"SELECT resourceType || '.' || key AS label, count FROM ({SQL['resource_type_keys']})",
    "silver_expected_types": """
        SELECT 'Order' AS resourceType, count(*) AS rows FROM orders UNION ALL SELECT 'Practitioner', 0""",
    "clustered_orders": "SELECT o_orderkey, o_custkey, strftime(o_orderdate, '%Y-%m-%d') AS o_orderdate, o_totalprice FROM orders",
    "skip_lines": "SELECT o_orderkey, o_custkey, o_orderpriority FROM orders",
    "find_document": "SELECT CAST(c_custkey AS VARCHAR) AS bundle_id, c_mktsegment AS segment FROM customer WHERE c_custkey = 1",
    "stream_change_feed": f"SELECT {EV_COLS} FROM events",
}
STREAM_SQL["stream_target_feed"] = STREAM_SQL["stream_versions_feed"]
