"""The queries' results in plain SQL over the same tables."""

# Keys of a message's blocks, stated here on their own so that a change of the messages shows.
ORDER_BLOCK, LINE_BLOCK = 4096, 8

_PROPS = """
SELECT event_id, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k,
       json_extract_string(props, '$.k') AS k_text,
       CAST(json_extract_string(props, '$.k') AS DECIMAL(10,2)) AS k_decimal
FROM events
"""
_REJECTS = """
SELECT event_id, CAST(CASE WHEN event_type NOT IN ('error', 'click', 'purchase') THEN json_extract_string(props, '$.k') END AS INTEGER) AS k,
       CAST(NULL AS VARCHAR) AS unread FROM events
UNION ALL
SELECT event_id, NULL, CASE event_type WHEN 'error' THEN left(props, length(props) - 1) ELSE '[' || props || ']' END
FROM events WHERE event_type IN ('error', 'purchase')
"""
_PARTS = "SELECT p_partkey, p_name, p_brand, p_type, p_size, p_retailprice FROM part"

# One row per order line, or per order without lines, with the keys of its message.
_ORDERS = f"""
lines AS (
  SELECT l_orderkey, l_linenumber, max(l_returnflag) AS flag, CAST(sum(l_quantity) AS BIGINT) AS qty
  FROM lineitem GROUP BY ALL),
counts AS (SELECT o_custkey, count(*) AS n FROM orders GROUP BY ALL),
items AS (
  SELECT c_custkey AS customer, coalesce(o_orderkey // {ORDER_BLOCK}, 0) AS order_block,
         coalesce(CAST(l_linenumber // {LINE_BLOCK} AS BIGINT), 0) AS line_block,
         c_name, c_mktsegment, CAST(n AS VARCHAR) AS n,
         CAST(o_orderkey AS VARCHAR) AS o, o_orderstatus AS status, o_orderpriority AS priority,
         CAST(l_linenumber AS VARCHAR) AS l, flag, CAST(qty AS VARCHAR) AS qty
  FROM customer LEFT JOIN orders ON o_custkey = c_custkey
  LEFT JOIN counts USING (o_custkey) LEFT JOIN lines ON l_orderkey = o_orderkey),
messages AS (
  SELECT customer, order_block, line_block, count(l) AS n_lines,
         count(CASE WHEN flag <> 'N' THEN 1 END) AS n_flags
  FROM items GROUP BY ALL)
"""
_ID = "customer, order_block, line_block"
_LINE_ROWS = f"""
SELECT {_ID}, o AS "Order", l AS "Line", flag AS "Flag", n AS "OrderCount",
       priority AS "Priority", qty AS "Qty", status AS "Status"
FROM items JOIN messages USING ({_ID})
WHERE o IS NOT NULL AND (l IS NOT NULL OR n_lines = 0)
"""
_LINES = f"WITH {_ORDERS} {_LINE_ROWS}"
_STACK = f"""
WITH {_ORDERS}, line_rows AS ({_LINE_ROWS})
SELECT *, NULL AS "Name", NULL AS "Segment" FROM line_rows
UNION ALL BY NAME
SELECT DISTINCT {_ID}, c_name AS "Name", c_mktsegment AS "Segment" FROM items
"""
_SENTENCES = """
paragraphs AS (
  SELECT doc_id, lang, source, unnest(string_split(text, chr(10))) AS paragraph,
         unnest(range(1, len(string_split(text, chr(10))) + 1)) AS p FROM documents),
sentences AS (
  SELECT *, unnest(string_split(paragraph, '. ')) AS sentence,
         unnest(range(1, len(string_split(paragraph, '. ')) + 1)) AS s FROM paragraphs)
"""

ORACLE: dict[str, str] = {
    "extract_props": _PROPS,
    "extract_inferred": _PROPS,
    "extract_malformed": """
        SELECT event_id, CAST(k AS INTEGER) AS k, k AS k_text, CAST(k AS DECIMAL(10,2)) AS k_decimal
        FROM (SELECT event_id, CASE WHEN event_type NOT IN ('error', 'click', 'purchase')
                               THEN json_extract_string(props, '$.k') END AS k FROM events)""",
    "star_expand": """
        SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               CAST(NULL AS VARCHAR) AS missing FROM events""",
    "cast_types": """
        SELECT l_orderkey, CAST(l_suppkey AS INTEGER) AS l_suppkey,
               CAST(l_linenumber AS SMALLINT) AS l_linenumber_short,
               CAST(l_linenumber AS TINYINT) AS l_linenumber_byte, CAST(l_quantity AS REAL) AS l_quantity,
               l_extendedprice, CAST(l_extendedprice AS DECIMAL(12,2)) AS l_extendedprice_decimal,
               l_returnflag, CAST(l_shipdate AS DATE) AS l_shipdate, l_shipdate AS l_shiptime,
               l_linestatus = 'O' AS l_open FROM lineitem""",
    "cast_bad_text": """
        SELECT p_partkey, CAST(trunc(p_retailprice) AS INTEGER) AS price,
               CAST(NULL AS INTEGER) AS name_int, CAST(NULL AS DOUBLE) AS name_double,
               CAST(NULL AS REAL) AS name_float, CAST(NULL AS BIGINT) AS name_long,
               CAST(NULL AS SMALLINT) AS name_short, CAST(NULL AS TINYINT) AS name_byte,
               CAST(NULL AS DATE) AS name_date, CAST(NULL AS BOOLEAN) AS name_boolean,
               CAST(NULL AS TIMESTAMP) AS name_timestamp, CAST(NULL AS DECIMAL(10,2)) AS name_decimal
        FROM part""",
    "array_path": """
        SELECT doc_id, '[' || array_to_string(range(1, len(p) + 1), ', ') || ']' AS numbers,
               '[' || array_to_string(p, ', ') || ']' AS texts
        FROM (SELECT doc_id, string_split(text, chr(10)) AS p FROM documents)""",
    "dotted_names": 'SELECT event_id, event_type AS "type", user_id AS "user" FROM events',
    "csv_payload": _PARTS,
    "csv_rows": _PARTS,
    "read_csv_batch": "SELECT s_suppkey, s_name, s_acctbal FROM supplier",
    "path_map_rows": f"""
        WITH {_ORDERS}
        SELECT DISTINCT {_ID}, 'Device.Profile.Name' AS path, c_name AS leaf FROM items
        UNION ALL SELECT DISTINCT {_ID}, 'Device.Profile.Segment', c_mktsegment FROM items
        UNION ALL SELECT DISTINCT {_ID}, 'Device.Sales.OrderCount', n FROM items WHERE n IS NOT NULL
        UNION ALL SELECT DISTINCT {_ID}, 'Device.Sales.Order.' || o || '.Status', status FROM items WHERE o IS NOT NULL
        UNION ALL SELECT DISTINCT {_ID}, 'Device.Sales.Order.' || o || '.Priority', priority FROM items WHERE o IS NOT NULL
        UNION ALL SELECT {_ID}, 'Device.Sales.Order.' || o || '.Line.' || l || '.Qty', qty FROM items WHERE l IS NOT NULL
        UNION ALL SELECT {_ID}, 'Device.Sales.Order.' || o || '.Line.' || l || '.Flag', flag FROM items WHERE l IS NOT NULL""",
    "flat_keys_match": f"""
        WITH {_ORDERS}
        SELECT DISTINCT {_ID}, 'Device.Sales.Order.' || o || '.Status' AS path, status AS leaf FROM items WHERE o IS NOT NULL
        UNION ALL SELECT {_ID}, 'Device.Sales.Order.' || o || '.Line.' || l || '.Qty', qty FROM items WHERE l IS NOT NULL""",
    "flatten_lines": _LINES,
    "flatten_lines_variant": _LINES,
    "flatten_lines_path_map": _LINES,
    "flatten_flat_keys": _LINES,
    "flatten_siblings": f"""
        WITH {_ORDERS}
        SELECT {_ID}, o AS "Order", l AS "Line", flag AS "Flag", n AS "OrderCount",
               NULL AS "Priority", qty AS "Qty", NULL AS "Status" FROM items WHERE l IS NOT NULL
        UNION ALL
        SELECT DISTINCT {_ID}, o, NULL, NULL, n, priority, NULL, status FROM items WHERE o IS NOT NULL""",
    "flatten_scalars": f"""
        WITH {_ORDERS}
        SELECT DISTINCT {_ID}, c_name AS "Name", c_mktsegment AS "Segment" FROM items""",
    "flatten_spine_driver": f"""
        WITH {_ORDERS}
        SELECT {_ID}, o AS "Order", l AS "Line", nullif(flag, 'N') AS "Flag", qty AS "Qty"
        FROM items JOIN messages USING ({_ID})
        WHERE l IS NOT NULL AND (flag <> 'N' OR n_flags = 0)""",
    "flatten_spine_any": f"""
        WITH {_ORDERS}
        SELECT {_ID}, o AS "Order", l AS "Line", nullif(flag, 'N') AS "Flag", qty AS "Qty"
        FROM items WHERE l IS NOT NULL""",
    "flatten_any_ids": f"""
        WITH {_SENTENCES}
        SELECT doc_id, 'part-' || CAST(p AS VARCHAR) AS "Paragraph",
               CAST(length(paragraph) AS VARCHAR) AS "Chars" FROM paragraphs""",
    "flatten_stack": _STACK,
    "flatten_union": _STACK,
    "flatten_documents": f"""
        WITH {_SENTENCES}
        SELECT doc_id, CAST(p AS VARCHAR) AS paragraph, CAST(s AS VARCHAR) AS sentence, lang AS "Lang",
               source AS "Source", CAST(length(paragraph) AS VARCHAR) AS "Chars", sentence AS "Text"
        FROM sentences""",
    "flatten_mixed_shapes": """
        SELECT event_id, '1' AS "Entry",
               CASE event_type WHEN 'view' THEN NULL WHEN 'click' THEN '{"a": 1}' WHEN 'error' THEN '[1,2]'
                               ELSE '123456789.5' END AS "Kind", 'true' AS "Open"
        FROM events WHERE event_type <> 'purchase'
        UNION ALL SELECT event_id, '2', event_type, NULL FROM events""",
    "flatten_odd_records": """
        WITH shapes(kind, item, leaf) AS (VALUES (0, '1', 'key'), (0, '2', 'b'), (1, '1', 'a'), (2, '1', NULL), (4, '1', 'b'),
          (5, '1', '12345678901234567890123456789012345678'), (6, '1', 'c'), (8, '1', '{"a":1}'), (9, '1', '["~\\"",{"k":"{}"}]'), (9, '3', '~x\\'))
        SELECT event_id, strategy, item AS "Entry", CASE leaf WHEN 'key' THEN event_type ELSE leaf END AS "X"
        FROM events JOIN shapes ON event_id % 10 = kind, (VALUES ('auto'), ('variant'), ('path_map')) AS s(strategy)""",
    "flatten_half_flat": """
        SELECT event_id, 'e1' AS "Entry", event_type AS "X" FROM events WHERE event_id % 3 < 2""",
    "path_map_deep": """
        SELECT event_id, repeat('a.', 39) || 'a' AS path, event_type AS leaf FROM events
        UNION ALL SELECT event_id, 'p.q', 'second' FROM events
        UNION ALL SELECT event_id, 'r', '2' FROM events WHERE event_id % 2 = 1""",
    "extract_inferred_all": _PROPS,
    "extract_variant": _PROPS,
    "extract_case": _PROPS,
    "extract_rejects": _REJECTS,
    "stream_rejects": _REJECTS,
    "cast_losses": """
        SELECT 'brand' AS output, CAST(0 AS BIGINT) AS lost
        UNION ALL SELECT 'kind', count(*) FILTER (p_type IS NOT NULL AND TRY_CAST(p_type AS DATE) IS NULL) FROM part
        UNION ALL SELECT 'name', count(*) FILTER (p_name IS NOT NULL AND TRY_CAST(p_name AS INTEGER) IS NULL) FROM part
        UNION ALL SELECT 'price', count(*) FILTER (p_retailprice IS NOT NULL AND TRY_CAST(p_retailprice AS INTEGER) IS NULL) FROM part""",
    "flatten_split": _STACK,
    "flatten_keep_absent": """
        SELECT doc_id, s.source AS "Feed", lang AS "Lang", CASE WHEN d.source = s.source THEN CAST(n_chars AS VARCHAR) END AS "Chars"
        FROM documents d, (SELECT DISTINCT source FROM documents WHERE source IS NOT NULL) s""",
    "flatten_aliases": f"""
        WITH {_ORDERS}
        SELECT {_ID}, o AS order_key, l AS line_number, flag, qty AS amount FROM items WHERE l IS NOT NULL""",
    "flatten_root": _LINES,
    "flatten_positions": f"""
        WITH {_ORDERS}
        SELECT {_ID}, o AS "Order", l AS "Line", flag AS "Flag", qty AS "Qty",
               CAST(row_number() OVER (PARTITION BY {_ID} ORDER BY o, l) - 1 AS INTEGER) AS place
        FROM items WHERE l IS NOT NULL""",
    "stream_json_job": "SELECT * EXCLUDE (event_id) FROM (" + _PROPS + ")",
    "stream_paths_job": _LINES,
    "pack_roundtrip": _LINES,
    "stream_extract": _PROPS,
    "stream_csv": _PARTS,
    "stream_flatten": _LINES,
}
