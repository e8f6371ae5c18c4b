"""The same queries in SQL, over the same tables."""

from __future__ import annotations

_CUSTOMERS = "(SELECT * REPLACE (CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -1 - c_custkey END AS c_custkey) FROM customer)"
_LIVE = f"(SELECT c_custkey FROM {_CUSTOMERS})"
_BROKEN = f"(o_custkey IS NOT NULL AND o_custkey <> 0 AND o_custkey NOT IN {_LIVE})"

_LINES = """
WITH checked AS (
  SELECT l.*,
         l_partkey <> 0 AND l_partkey NOT IN (
           SELECT CASE WHEN p_size <= 40 THEN p_partkey ELSE -1 - p_partkey END FROM part) AS no_part,
         l_suppkey <> 0 AND l_suppkey NOT IN (
           SELECT CASE WHEN s_acctbal > 0 THEN s_suppkey ELSE -1 - s_suppkey END FROM supplier) AS no_supplier
  FROM lineitem l)
"""
_SWEPT = (
    _LINES
    + """
SELECT l_orderkey, l_partkey, CASE WHEN NOT no_supplier THEN l_suppkey END AS l_suppkey, l_linenumber,
       l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus, l_shipdate
FROM checked WHERE NOT no_part
"""
)
_QUARANTINE = (
    _LINES
    + """
SELECT * EXCLUDE (no_part, no_supplier), 'lineitem' AS _table, 'l_partkey' AS _fk,
       'part' AS _target, 'CASCADE' AS _policy
FROM checked WHERE no_part
UNION ALL
SELECT * EXCLUDE (no_part, no_supplier), 'lineitem', 'l_suppkey', 'supplier', 'SET_NULL'
FROM checked WHERE no_supplier
"""
)

_FIRST_DOC = """
SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY text ORDER BY doc_id {direction}) AS rn FROM documents)
WHERE rn = 1
"""

_CHAIN = """
SELECT c.*, n_name, n_regionkey, r_name
FROM customer c
LEFT JOIN nation ON c_nationkey = n_nationkey
LEFT JOIN region ON n_regionkey = r_regionkey
"""

_LINKS = """
SELECT DISTINCT l_orderkey AS orderkey, s_nationkey AS place
FROM lineitem JOIN supplier ON l_suppkey = s_suppkey
UNION ALL
SELECT o_orderkey, n_regionkey + 1000
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
"""
_PLACES = f"""
SELECT orderkey, place FROM ({_LINKS}) AS links
WHERE NOT EXISTS (
  SELECT 1 FROM lineitem JOIN supplier ON l_suppkey = s_suppkey JOIN nation ON s_nationkey = n_nationkey
  WHERE l_orderkey = orderkey AND n_regionkey + 1000 = place)
"""
_ANCESTORS = """
WITH RECURSIVE tree AS (
  SELECT n_nationkey AS place, n_regionkey + 1000 AS parent FROM nation
  UNION ALL
  SELECT r_regionkey + 1000, 2000 FROM region),
up(place, ancestor) AS (
  SELECT place, parent FROM tree
  UNION
  SELECT up.place, tree.parent FROM up JOIN tree ON up.ancestor = tree.place)
"""
_LEVELS = f"""
{_ANCESTORS},
links AS ({_LINKS} UNION ALL SELECT o_orderkey, 2000 FROM orders WHERE o_orderkey % 3 = 0)
SELECT orderkey, place FROM links l
WHERE NOT EXISTS (
  SELECT 1 FROM links m JOIN up ON m.place = up.place WHERE m.orderkey = l.orderkey AND up.ancestor = l.place)
"""

_FALLEN = """
WITH RECURSIVE moved AS (
  SELECT CASE WHEN c_acctbal > 0 THEN c_custkey ELSE -1 - c_custkey END AS k,
         nullif(CASE WHEN c_custkey % 3 = 0 THEN c_custkey * 10 END, 0) AS ref
  FROM customer),
links AS (
  SELECT 'customer' AS kind, k, ref FROM moved
  UNION ALL
  SELECT 'orders', o_orderkey, nullif(o_custkey, 0) FROM orders),
fallen(kind, k) AS (
  SELECT kind, k FROM links
  WHERE kind = 'orders' AND ref IS NOT NULL AND ref NOT IN (SELECT k FROM moved)
     OR kind = 'customer' AND ref IS NOT NULL AND ref NOT IN (SELECT o_orderkey FROM orders)
  UNION
  SELECT links.kind, links.k FROM fallen JOIN links ON links.ref = fallen.k AND links.kind <> fallen.kind)
"""

_URLS = "SELECT DISTINCT url FROM pages WHERE page_id % 5 <> 0 AND trim(url) <> ''"


_MANIFEST = f"""
SELECT 'pages' AS table_name, 'url' AS column_name, url AS path FROM ({_URLS})
UNION ALL
SELECT DISTINCT 'documents', 'source', source FROM documents WHERE trim(source) <> ''
"""

_NATION_FILES = """
SELECT DISTINCT 'nation' AS table_name, 'file' AS column_name,
       CASE n_regionkey WHEN 0 THEN 'region.parquet' WHEN 1 THEN 'nation.parquet'
                        WHEN 2 THEN '../' || n_name ELSE n_name END AS path
FROM nation
"""


def _profile() -> str:
    columns = [
        ("c_custkey", "bigint", "c_custkey"),
        ("c_name", "string", "c_name"),
        ("c_nationkey", "int", "c_nationkey"),
        ("c_acctbal", "double", "c_acctbal"),
        ("c_mktsegment", "string", "CASE WHEN c_acctbal >= 0 THEN c_mktsegment END"),
    ]
    parts = [
        f"""
        SELECT 'customer' AS table_name, {i} AS position, '{name}' AS column_name, '{type_name}' AS type_name,
               5 AS n_columns, count(*) AS n_rows, count(*) - count({value}) AS n_null,
               (SELECT CAST({value} AS VARCHAR) FROM customer ORDER BY c_custkey LIMIT 1) AS first_value
        FROM customer"""
        for i, (name, type_name, value) in enumerate(columns)
    ]
    return " UNION ALL ".join(parts)


_QUALITY = """
WITH c AS (
  SELECT c_custkey, CASE WHEN c_nationkey <> 3 THEN c_name END AS c_name,
         CAST(c_acctbal AS DECIMAL(15, 2)) AS c_acctbal, c_mktsegment
  FROM customer)
SELECT c_custkey, 'c_name' AS column_name, 'not_null' AS check_name, c_name AS value FROM c WHERE c_name IS NULL
UNION ALL
SELECT c_custkey, 'c_acctbal', 'range', CAST(c_acctbal AS VARCHAR) FROM c WHERE c_acctbal < 0 OR c_acctbal > 9000
UNION ALL
SELECT c_custkey, 'c_mktsegment', 'max_length', c_mktsegment FROM c WHERE length(c_mktsegment) > 9
"""

_KEPT_ORDERS = """
SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate FROM (
  SELECT *, row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey) AS rn
  FROM (SELECT o_orderkey, o_custkey, o_orderstatus, CAST(o_totalprice AS DECIMAL(15, 2)) AS o_totalprice,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate
        FROM orders))
WHERE rn = 1
"""

_PRIORITY = """
SELECT o_orderkey,
       CASE WHEN o_orderstatus <> 'F' THEN CAST(o_custkey AS VARCHAR) ELSE o_orderpriority END AS o_orderpriority
FROM orders
"""

SQL: dict[str, str] = {
    "fk_orphans": f"SELECT * FROM orders WHERE {_BROKEN}",
    "fk_cascade": f"SELECT * FROM orders WHERE NOT {_BROKEN}",
    "fk_set_null": f"SELECT * REPLACE (CASE WHEN NOT {_BROKEN} THEN o_custkey END AS o_custkey) FROM orders",
    "fk_do_nothing": "SELECT * FROM orders",
    "fk_do_nothing_quarantine": f"""
        SELECT *, 'orders' AS _table, 'o_custkey' AS _fk, 'customer' AS _target, 'DO_NOTHING' AS _policy
        FROM orders WHERE {_BROKEN}""",
    "fk_zero_as_null": f"""
        SELECT * REPLACE (CASE WHEN NOT {_BROKEN} AND o_custkey <> 0 THEN o_custkey END AS o_custkey)
        FROM orders""",
    "fk_broken_keys": f"SELECT o_custkey, count(*) AS rows FROM orders WHERE {_BROKEN} GROUP BY o_custkey",
    "fk_sweep": _SWEPT,
    "fk_sweep_two_pass": _SWEPT,
    "fk_quarantine": _QUARANTINE,
    "fk_orphan_counts": f"SELECT _table, _fk, count(*) AS rows FROM ({_QUARANTINE}) GROUP BY _table, _fk",
    "fk_cascade_transitive": f"""
        SELECT * FROM lineitem
        WHERE l_orderkey = 0 OR l_orderkey IN (SELECT o_orderkey FROM orders WHERE NOT {_BROKEN})""",
    "key_semi": "SELECT * FROM orders WHERE o_orderkey IN (SELECT c_custkey * 7 FROM customer)",
    "key_exists": "SELECT doc_id, doc_id IN (SELECT doc_id FROM labels) AS found FROM documents",
    "zero_to_null": "SELECT l_orderkey, nullif(l_suppkey, 0) AS l_suppkey, l_linenumber FROM lineitem",
    "value_to_null": "SELECT event_id, nullif(event_type, 'error') AS event_type FROM events",
    "zero_date": """
        SELECT o_orderkey, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate FROM orders""",
    "int_to_bool": "SELECT doc_id, quality <> 0 AS quality, toxic <> 0 AS toxic FROM labels",
    "html_unescape": """
        SELECT page_id,
               regexp_replace(replace(replace(replace(html, '&middot;', '·'), '&copy;', '©'), '&quot;', '"'),
                              '&amp;?', '&', 'g') AS html
        FROM pages""",
    "normalize_table": """
        SELECT o_orderkey, CAST(nullif(o_custkey, 0) AS INTEGER) AS o_custkey,
               nullif(o_orderstatus, 'P') AS o_orderstatus,
               CAST(o_totalprice AS DECIMAL(15, 2)) AS o_totalprice,
               CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate
        FROM orders""",
    "cast_lenient": f"""
        SELECT o_orderkey, TRY_CAST(o_orderpriority AS INTEGER) AS o_orderpriority FROM ({_PRIORITY})""",
    "cast_rejects": f"""
        SELECT *, 'o_orderpriority' AS _columns FROM ({_PRIORITY})
        WHERE TRY_CAST(o_orderpriority AS INTEGER) IS NULL""",
    "dedup_first": _FIRST_DOC.format(direction="ASC"),
    "dedup_last": _FIRST_DOC.format(direction="DESC"),
    "dedup_any": "SELECT DISTINCT text, lang, n_chars FROM documents",
    "dedup_none": """
        SELECT * FROM documents WHERE text IN (SELECT text FROM documents GROUP BY text HAVING count(*) = 1)""",
    "dedup_lines": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_shipdate FROM (
          SELECT *, row_number() OVER (
            PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_partkey, l_suppkey, l_shipdate, l_extendedprice, l_discount, l_tax) AS rn
          FROM lineitem)
        WHERE rn = 1""",
    "distinct_brands": "SELECT DISTINCT CASE WHEN p_size > 5 THEN p_brand END AS p_brand FROM part",
    "left_join_lookup": """
        SELECT d.*, quality, toxic FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
    "left_join_repeated": """
        SELECT c.*, o.* EXCLUDE (o_custkey) FROM {customers} c LEFT JOIN orders o ON c_custkey = o_custkey""".format(
        customers=_CUSTOMERS
    ),
    "left_join_chain": _CHAIN,
    "target_projection": f"""
        SELECT c_custkey AS id, c_name, c_nationkey, c_mktsegment, n_name, n_regionkey, r_name FROM ({_CHAIN})""",
    "declared_projection": "SELECT c_custkey, c_name, c_nationkey FROM customer",
    "reduce_hierarchy": _PLACES,
    "asset_manifest": _MANIFEST,
    "distinct_paths": _URLS,
    "asset_full_paths": f"""
        SELECT path, CASE WHEN path NOT LIKE '../%' AND path NOT LIKE 'http%' THEN '/shop/images/' || path END
                     AS full_path
        FROM ({_MANIFEST} UNION ALL {_NATION_FILES})""",
    "asset_presence": f"""
        SELECT *, path IN ('region.parquet', 'nation.parquet') AS present
        FROM ({_MANIFEST} UNION ALL {_NATION_FILES})""",
    "asset_presence_listed": f"""
        SELECT *, path IN ('region.parquet', 'nation.parquet') AS present
        FROM ({_MANIFEST} UNION ALL {_NATION_FILES})""",
    "asset_publish_counts": f"""
        SELECT status, count(DISTINCT path) AS files FROM (
          SELECT 'copied' AS status, CAST(c_nationkey AS VARCHAR) AS path FROM customer
          UNION ALL
          SELECT 'missing', 'c_nationkey=' || c_nationkey FROM customer
          UNION ALL
          SELECT CASE WHEN path LIKE '../%' THEN 'rejected' ELSE 'missing' END, path FROM ({_NATION_FILES}))
        GROUP BY status""",
    "table_profile": _profile(),
    "quality_violations": _QUALITY,
    "fill_default": """
        SELECT o_orderkey, coalesce(nullif(o_orderstatus, 'P'), 'N/A') AS o_orderstatus FROM orders""",
    "key_unique": """
        SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
        GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "parquet_round_trip": "SELECT * FROM orders",
    "csv_round_trip": """
        SELECT doc_id, text, CASE doc_id % 3 WHEN 0 THEN NULL WHEN 1 THEN '' ELSE lang END AS lang, source, n_chars
        FROM documents""",
    "quarantine_round_trip": _QUARANTINE,
    "stage_restore": _KEPT_ORDERS,
    "clean_catalog": f"""
        SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice, o_orderdate
        FROM ({_KEPT_ORDERS}) WHERE NOT {_BROKEN}""",
    "clean_catalog_targets": f"""
        SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_totalprice, o_orderdate
        FROM ({_KEPT_ORDERS}) WHERE NOT {_BROKEN}""",
    "clean_catalog_quarantine": f"""
        SELECT o_orderkey, CASE WHEN {_BROKEN} THEN 'o_custkey' ELSE 'kept' END AS state FROM ({_KEPT_ORDERS})""",
    "user_rule": "SELECT o_orderkey, split_part(o_orderpriority, '-', 1) AS o_orderpriority FROM orders",
    "row_filter": "SELECT * FROM customer WHERE c_acctbal > 0",
    "clean_catalog_customers": f"""
        SELECT c_custkey AS id, c_name, CASE WHEN c_nationkey <> 7 THEN c_nationkey END AS c_nationkey,
               nullif(c_mktsegment, 'MACHINERY') AS c_mktsegment, n_name, n_regionkey, r_name
        FROM {_CUSTOMERS}
        LEFT JOIN (SELECT * FROM nation WHERE n_nationkey <> 7) ON c_nationkey = n_nationkey
        LEFT JOIN region ON n_regionkey = r_regionkey""",
    "clean_links": _PLACES,
    "reduce_levels": _LEVELS,
    "tree_ancestors": f"{_ANCESTORS} SELECT place, ancestor FROM up",
    "fk_cascade_cycle": f"""
        {_FALLEN}
        SELECT * FROM orders WHERE o_orderkey NOT IN (SELECT k FROM fallen WHERE kind = 'orders')""",
    "fk_cascade_cycle_quarantine": f"""
        {_FALLEN}
        SELECT k AS c_custkey, ref AS c_orderkey, 'c_orderkey' AS _fk, 'orders' AS _target
        FROM links WHERE kind = 'customer' AND k IN (SELECT k FROM fallen WHERE kind = 'customer')""",
}
