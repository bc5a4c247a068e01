"""The same queries in SQL, for DuckDB over the driver tables.

Written independently of the Spark plans, joining first and aggregating after, so that
agreement means something.
"""

from __future__ import annotations

# --- bindings ------------------------------------------------------------------------

CUSTOMERS = """customers AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name,
         'user' || c_custkey || '@example.com' AS email, n_name AS country
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey)"""

PRODUCTS = """products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(p_retailprice AS DECIMAL(18,2)) AS list_price
  FROM part)"""

ORDERS = """placed AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS customer_id,
         CAST(o_orderdate AS DATE) AS order_date, o_orderstatus AS order_status
  FROM orders)"""

SALES = """priced AS (
  SELECT *, CAST(l_extendedprice AS DECIMAL(18,2)) AS price, CAST(l_discount AS DECIMAL(5,2)) AS discount,
         CASE WHEN l_returnflag = 'R' THEN -1 ELSE 1 END AS sign
  FROM lineitem),
sales AS (
  SELECT l_orderkey * 10 + l_linenumber AS sale_id,
         l_orderkey + l_linenumber - 1 AS order_id,
         l_partkey + l_linenumber AS product_id,
         CAST(sign * l_quantity AS INTEGER) AS quantity,
         CAST(CAST(CAST(price * 100 AS BIGINT) // CAST(l_quantity AS BIGINT) AS DECIMAL(18,0)) * 0.01
              AS DECIMAL(18,2)) AS unit_price,
         discount AS discount_pct,
         CAST(sign * CAST(price * (1 - discount) AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS line_total,
         l_linestatus AS line_status, l_shipdate AS _ingest_ts
  FROM priced)"""

RAW_CUSTOMERS = """raw_customers AS (
  SELECT c_custkey AS customer_id, split_part(c_name, '#', 1) AS first_name,
         split_part(c_name, '#', 2) AS last_name, mailbox || c_custkey || domain AS email,
         CASE WHEN c_acctbal >= 0 THEN CAST(DATE '1992-01-01' + c_nationkey * 30 AS DATE) END AS signup_date,
         n_name AS country, loaded
  FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
  CROSS JOIN (VALUES ('user', '@example.com', 1), ('customer', '@example.org', 2)) AS l(mailbox, domain, loaded))"""

RAW_PRODUCTS = """raw_products AS (
  SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) + extra AS DECIMAL(18,2)) AS list_price,
         CASE WHEN p_size > 25 THEN true WHEN p_size > 10 THEN false END AS is_active, loaded
  FROM part CROSS JOIN (VALUES (1, 1), (0, 2)) AS l(extra, loaded))"""

RAW_ORDERS = """raw_orders AS (
  SELECT o_orderkey AS order_id,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN o_custkey END AS customer_id,
         CASE WHEN o_orderpriority <> '4-NOT SPECIFIED' THEN CAST(o_custkey AS VARCHAR) ELSE 'guest' END
           AS customer_text,
         CAST(o_orderdate AS DATE) AS order_date,
         CASE WHEN loaded = 1 THEN 'NEW' ELSE o_orderstatus END AS order_status, loaded
  FROM orders CROSS JOIN (VALUES (1), (2)) AS l(loaded))"""

RAW_SALES = SALES + """,
raw_sales AS (SELECT * REPLACE (nullif(discount_pct, 0) AS discount_pct) FROM sales)"""

GAPS = ",\n".join([CUSTOMERS, PRODUCTS, ORDERS, SALES]) + """,
g_customers AS (SELECT nullif(customer_id, CAST(split_part(country, '_', 2) AS BIGINT)) AS id FROM customers),
g_products AS (SELECT nullif(product_id, CAST(floor(list_price) AS BIGINT)) AS id FROM products),
g_orders AS (SELECT nullif(order_id, customer_id) AS id FROM placed),
g_sales AS (SELECT nullif(sale_id, product_id) AS id FROM sales)"""

DAILY = """daily AS (
  SELECT order_date, SUM(line_total) AS total_revenue, COUNT(*) AS line_count,
         COUNT(DISTINCT order_id) AS order_count, COUNT(DISTINCT customer_id) AS unique_customers
  FROM placed JOIN sales USING (order_id) GROUP BY order_date)"""

TOP = """top_products AS (
  SELECT s.product_id, product_name, category, CAST(SUM(quantity) AS BIGINT) AS total_qty,
         SUM(line_total) AS total_sales
  FROM sales s LEFT JOIN products p ON s.product_id = p.product_id
  GROUP BY s.product_id, product_name, category)"""

MISSIONS = """mission_rows AS (
  SELECT CASE WHEN l_quantity = 1 THEN '' WHEN l_quantity <> 2 THEN 'O-' || l_orderkey END AS mission_identifier,
         strftime(l_shipdate, '%m/%d/%Y') AS startDate,
         CASE WHEN l_linestatus = 'O' THEN '' ELSE strftime(l_shipdate, '%m/%d/%Y') END AS endDate,
         CASE WHEN l_linenumber = 6 THEN '' WHEN l_linenumber < 6 THEN 'Supplier ' || l_suppkey END
           AS institution,
         CASE l_returnflag WHEN 'A' THEN 'PI' WHEN 'R' THEN 'CI' END AS role,
         CASE WHEN l_tax > 0 THEN 'P' || l_partkey END AS firstName,
         CASE WHEN l_linestatus = 'O' THEN '' ELSE 'L' || l_suppkey END AS lastName,
         CAST(l_shipdate AS DATE) AS start_date,
         CASE WHEN l_linestatus <> 'O' THEN CAST(l_shipdate AS DATE) END AS end_date
  FROM lineitem),
people AS (
  SELECT mission_identifier, startDate, endDate, start_date, end_date,
         coalesce(institution, '') AS institution, coalesce(role, '') AS role, firstName, lastName,
         concat_ws(' ', firstName, lastName) AS full_name
  FROM mission_rows),
flagged AS (
  SELECT *, coalesce(mission_identifier, '') = '' AS is_missing_mission_identifier, full_name = '' AS is_missing_person_name,
         institution = '' AS is_missing_institution, role = '' AS is_missing_role
  FROM people)"""

DOCUMENTS = """objects AS (
  SELECT * FROM documents WHERE source NOT IN ('src0', 'src1')),
entries AS (
  SELECT doc_id, lang, source, n_chars, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) - 1 AS person_pos
  FROM objects WHERE lang <> 'es'),
assigned AS (
  SELECT *, CASE lang WHEN 'de' THEN [line] WHEN 'fr' THEN ['']
                 ELSE list_filter(string_split(line, '. '), lambda s: s <> '') END AS roles
  FROM entries),
flat AS (
  SELECT doc_id, CAST(person_pos AS INTEGER) AS person_pos,
         unnest(CASE WHEN len(roles) = 0 THEN [''] ELSE roles END) AS role,
         CAST(generate_subscripts(CASE WHEN len(roles) = 0 THEN [''] ELSE roles END, 1) - 1 AS INTEGER)
           AS role_pos,
         CASE WHEN source <> 'src2' THEN 'D-' || doc_id ELSE '' END AS mission_identifier,
         strftime(DATE '2000-01-01' + CAST(n_chars AS INTEGER), '%m/%d/%Y') AS startDate, '' AS endDate,
         CASE WHEN line <> '' THEN source ELSE '' END AS institution,
         CASE WHEN lang = 'fr' THEN '' ELSE lang END AS firstName,
         CASE WHEN lang = 'fr' THEN '' ELSE source END AS lastName
  FROM assigned)"""

LINKS = """links AS (
  SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS urls FROM pages),
entries AS (
  SELECT page_id, unnest(urls) AS url, CAST(generate_subscripts(urls, 1) - 1 AS INTEGER) AS position FROM links)"""


def _with(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"


_MONEY = "CAST({0} AS DOUBLE) AS {0}"
_DAILY_COLUMNS = f"order_date, {_MONEY.format('total_revenue')}, line_count, order_count, unique_customers"
_TOP_COLUMNS = f"product_id, product_name, category, total_qty, {_MONEY.format('total_sales')}"
_SALES_COLUMNS = ", ".join(
    ["sale_id, order_id, product_id, quantity", *(_MONEY.format(c) for c in ("unit_price", "discount_pct", "line_total"))]
)
_FLAT_COLUMNS = "mission_identifier, startDate, endDate, institution, role, firstName, lastName"
_CLEAN_COLUMNS = _FLAT_COLUMNS + ", start_date, end_date, full_name"
_EVENTS = "SELECT event_id, strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS ts, user_id, event_type, value, props FROM events"
_LOAD_STAMP = "'2024-01-0' || loaded || ' 00:00:00' AS _ingest_ts"
_SALES_STAMP = "strftime(_ingest_ts, '%Y-%m-%d %H:%M:%S') AS _ingest_ts"


def _first(source: str, columns: str, key: str, order: str) -> str:
    return (
        f"SELECT {columns} FROM (SELECT *, row_number() OVER (PARTITION BY {key} ORDER BY {order}) AS rn"
        f" FROM {source}) WHERE rn = 1"
    )


def _union(parts) -> str:
    return "\nUNION ALL ".join(parts)


_LATEST_SALE = (
    "_ingest_ts DESC, order_id DESC, product_id DESC, quantity DESC, unit_price DESC,"
    " discount_pct DESC NULLS LAST, line_total DESC"
)
_RESULT = (
    "SELECT '2024-06-01 00:00:00' AS check_ts, '{layer}' AS layer, '{table}' AS table_name,"
    " '{check}' AS check_name, CASE WHEN bad = 0 THEN 'PASS' ELSE 'FAIL' END AS status,"
    " CAST(bad AS BIGINT) AS bad_count FROM ({query})"
)


def _result(layer: str, table: str, check: str, query: str) -> str:
    return _RESULT.format(layer=layer, table=table, check=check, query=query)




def _orphans(child: str, parent: str, key: str) -> str:
    return (
        f"SELECT COUNT(*) AS bad FROM {child} AS child"
        f" WHERE NOT EXISTS (SELECT 1 FROM {parent} AS parent WHERE parent.{key} = child.{key})"
    )


_ORPHANS = {
    "orphan_orders_customers": ("orders", _orphans("placed", "customers", "customer_id")),
    "orphan_sales_orders": ("sales", _orphans("sales", "placed", "order_id")),
    "orphan_sales_products": ("sales", _orphans("sales", "products", "product_id")),
}
_BAD = {
    "bad_qty": "quantity <= 0",
    "bad_unit_price": "unit_price < 0",
    "bad_discount": "discount_pct < 0 OR discount_pct > 1",
    "bad_line_total": "line_total < 0",
}
_MISMATCH = "abs(line_total - quantity * unit_price * (1 - discount_pct)) > 0.01"

# the marts to reconcile were built from the finished lines only
_STALE = """daily_drift AS (
  SELECT order_date, SUM(line_total) AS silver_revenue,
         SUM(line_total) FILTER (WHERE line_status = 'F') AS gold_revenue,
         coalesce(silver_revenue, 0) - coalesce(gold_revenue, 0) AS diff
  FROM placed JOIN sales USING (order_id) GROUP BY order_date HAVING abs(diff) > 0.01),
product_drift AS (
  SELECT product_id, CAST(SUM(quantity) AS BIGINT) AS silver_qty, SUM(line_total) AS silver_sales,
         CAST(SUM(quantity) FILTER (WHERE line_status = 'F') AS BIGINT) AS gold_qty,
         SUM(line_total) FILTER (WHERE line_status = 'F') AS gold_sales
  FROM sales GROUP BY product_id
  HAVING abs(coalesce(silver_sales, 0) - coalesce(gold_sales, 0)) > 0.01
      OR coalesce(silver_qty, 0) <> coalesce(gold_qty, 0))"""

_TABLES = {"customers": "customer_id", "products": "product_id", "orders": "order_id", "sales": "sale_id"}
_VIEWS = {"customers": "customers", "products": "products", "orders": "placed", "sales": "sales"}

# the pipeline run sees each raw table once, in text form, so the conformed tables are:
_LAYERS = _with(RAW_CUSTOMERS, RAW_PRODUCTS, RAW_ORDERS, RAW_SALES) + """,
customers AS (SELECT DISTINCT customer_id FROM raw_customers),
products AS (SELECT DISTINCT product_id FROM raw_products),
placed AS (SELECT DISTINCT order_id, customer_id, order_date FROM raw_orders)"""

_ROWS = "SELECT '{0}' AS entity, (SELECT COUNT(*) FROM {1}) AS bronze_cnt, (SELECT COUNT({3}) FROM {2}) AS silver_cnt"


ORACLES: dict[str, str] = {
    # gold
    "daily_revenue": _with(ORDERS, SALES, DAILY) + f"SELECT {_DAILY_COLUMNS} FROM daily",
    "daily_revenue_latest10": _with(ORDERS, SALES, DAILY)
    + f"SELECT {_DAILY_COLUMNS} FROM daily ORDER BY order_date DESC LIMIT 10",
    "top_products": _with(PRODUCTS, SALES, TOP) + f"SELECT {_TOP_COLUMNS} FROM top_products",
    "top_products_top20": _with(PRODUCTS, SALES, TOP)
    + f"SELECT {_TOP_COLUMNS} FROM top_products t ORDER BY t.total_sales DESC, product_id LIMIT 20",
    "customer_360": _with(CUSTOMERS, ORDERS, SALES)
    + """SELECT c.customer_id, first_name, last_name, email, country,
         COUNT(DISTINCT o.order_id) AS lifetime_orders, CAST(SUM(line_total) AS DOUBLE) AS lifetime_spend
  FROM customers c LEFT JOIN placed o ON c.customer_id = o.customer_id LEFT JOIN sales s ON o.order_id = s.order_id
  GROUP BY c.customer_id, first_name, last_name, email, country""",
    # silver
    "silver_customers": _with(RAW_CUSTOMERS)
    + _first(
        "raw_customers",
        f"customer_id, first_name, last_name, email, signup_date, country, {_LOAD_STAMP}",
        "customer_id",
        "first_name, last_name, email, signup_date, country, loaded",
    ),
    "silver_products": _with(RAW_PRODUCTS)
    + _first(
        "raw_products",
        f"product_id, product_name, category, {_MONEY.format('list_price')}, is_active, {_LOAD_STAMP}",
        "product_id",
        "product_name, category, list_price, is_active, loaded",
    ),
    "silver_orders_latest": _with(RAW_ORDERS)
    + _first("raw_orders", f"order_id, customer_id, order_date, order_status, {_LOAD_STAMP}", "order_id", "loaded DESC"),
    "silver_sales_typed": _with(RAW_SALES) + f"SELECT {_SALES_COLUMNS}, {_SALES_STAMP} FROM raw_sales",
    "silver_sales_latest": _with(RAW_SALES)
    + _first("raw_sales", f"{_SALES_COLUMNS}, {_SALES_STAMP}", "sale_id", _LATEST_SALE),
    "silver_orders_distinct": _with(RAW_ORDERS)
    + "SELECT DISTINCT CAST(order_id AS VARCHAR) AS order_id, customer_text AS customer_id, order_date FROM raw_orders",
    # quality
    "dq_row_counts": _with(RAW_CUSTOMERS, RAW_PRODUCTS, RAW_ORDERS, SALES)
    + _union(
        [_ROWS.format(n, f"raw_{n}", f"raw_{n}", f"DISTINCT {_TABLES[n]}") for n in ("customers", "products", "orders")]
        + [_ROWS.format("sales", "sales", "sales", "*")]
    ),
    "dq_row_counts_distinct": """SELECT COUNT(*) AS row_count FROM lineitem UNION SELECT COUNT(*) FROM lineitem
  UNION SELECT COUNT(*) FROM orders UNION SELECT 2 * COUNT(*) FROM orders""",
    "dq_pk_not_null": _with(GAPS)
    + _union(
        f"SELECT '{t}.{k}' AS check_name, COUNT(*) AS bad FROM g_{t} WHERE id IS NULL" for t, k in _TABLES.items()
    ),
    "dq_uniqueness": _with(GAPS)
    + _union(
        f"SELECT '{t}' AS table_name, COUNT(*) AS total, COUNT(DISTINCT id) AS distinct_ids FROM g_{t}" for t in _TABLES
    ),
    **{
        f"dq_{name}": _with(CUSTOMERS, PRODUCTS, ORDERS, SALES) + query.replace("AS bad", f"AS {name}")
        for name, (_, query) in _ORPHANS.items()
    },
    "dq_orphan_order_rows": _with(ORDERS)
    + "SELECT * FROM placed WHERE customer_id IS NULL OR customer_id NOT IN (SELECT c_custkey FROM customer)",
    "dq_order_status": _with(ORDERS) + "SELECT order_status, COUNT(*) AS cnt FROM placed GROUP BY order_status",
    "dq_numeric_sanity": _with(SALES)
    + "SELECT "
    + ", ".join(f"CAST(SUM(CASE WHEN {c} THEN 1 ELSE 0 END) AS BIGINT) AS {n}" for n, c in _BAD.items())
    + " FROM sales",
    "dq_line_total_mismatch": _with(SALES) + f"SELECT COUNT(*) AS mismatched_lines FROM sales WHERE {_MISMATCH}",
    "dq_reconcile_daily": _with(ORDERS, SALES, _STALE)
    + "SELECT order_date, "
    + ", ".join(_MONEY.format(c) for c in ("silver_revenue", "gold_revenue", "diff"))
    + " FROM daily_drift",
    "dq_reconcile_products": _with(SALES, ORDERS, _STALE)
    + "SELECT product_id, silver_qty, gold_qty, "
    + ", ".join(_MONEY.format(c) for c in ("silver_sales", "gold_sales"))
    + " FROM product_drift",
    "dq_results_log": _with(ORDERS, RAW_SALES)
    + _union([
        _result("silver", "orders", "order_id_not_null", "SELECT COUNT(*) AS bad FROM placed WHERE order_id IS NULL"),
        _result("silver", "sales", "line_total_not_null", "SELECT COUNT(*) AS bad FROM raw_sales WHERE line_total IS NULL"),
        _result("silver", "sales", "orphan_sales_orders", _ORPHANS["orphan_sales_orders"][1]),
    ]),
    "dq_battery": _with(CUSTOMERS, PRODUCTS, ORDERS, SALES, _STALE)
    + _union(
        [_result("silver", t, f"{k}_not_null", f"SELECT COUNT(*) - COUNT({k}) AS bad FROM {_VIEWS[t]}") for t, k in _TABLES.items()]
        + [
            _result("silver", t, f"{k}_unique", f"SELECT COUNT(*) - COUNT(DISTINCT {k}) AS bad FROM {_VIEWS[t]}")
            for t, k in _TABLES.items()
        ]
        + [
            _result("silver", "sales", n, f"SELECT COUNT(*) AS bad FROM sales WHERE {c}")
            for n, c in {**_BAD, "line_total_not_null": "line_total IS NULL", "line_total_mismatch": _MISMATCH}.items()
        ]
        + [_result("silver", t, n, q) for n, (t, q) in _ORPHANS.items()]
        + [
            _result("gold", "daily_revenue", "daily_revenue_matches_silver", "SELECT COUNT(*) AS bad FROM daily_drift"),
            _result("gold", "top_products", "top_products_matches_silver", "SELECT COUNT(*) AS bad FROM product_drift"),
        ]
    ),
    # documents
    "flatten_in_order": _with(DOCUMENTS)
    + """SELECT doc_id, person_pos, role_pos, role,
         CAST(row_number() OVER (PARTITION BY doc_id ORDER BY person_pos, role_pos) AS INTEGER) AS nth
  FROM flat""",
    "documents_from_pattern": """SELECT 'pattern' AS via, COUNT(*) AS documents FROM supplier
  UNION ALL SELECT 'single file', least(1, COUNT(*)) FROM supplier""",
    "no_documents": "SELECT COUNT(*) AS other_files, 'FileNotFoundError' AS error FROM supplier",
    "flatten_documents": _with(DOCUMENTS) + f"SELECT doc_id, person_pos, role_pos, {_FLAT_COLUMNS} FROM flat",
    "flatten_rejects": """SELECT doc_id,
  CASE source WHEN 'src0' THEN 'invalid JSON' ELSE 'top level is not an object' END AS reason
  FROM documents WHERE source IN ('src0', 'src1')""",
    "flatten_file_counts": _with(DOCUMENTS)
    + """SELECT doc_id, CASE source WHEN 'src0' THEN 'invalid JSON' WHEN 'src1' THEN 'top level is not an object' END
         AS reason,
         source NOT IN ('src0', 'src1') AND lang = 'es' AS people_not_a_list, coalesce(n, 0) AS row_count
  FROM documents LEFT JOIN (SELECT doc_id, COUNT(*) AS n FROM flat GROUP BY doc_id) USING (doc_id)""",
    "flatten_quality_summary": _with(DOCUMENTS)
    + """SELECT COUNT(*) FILTER (WHERE mission_identifier = '') AS missing_mission_identifier,
         COUNT(*) FILTER (WHERE concat_ws(' ', firstName, lastName) = '') AS missing_person_name,
         COUNT(*) FILTER (WHERE institution = '') AS missing_institution,
         COUNT(*) FILTER (WHERE role = '') AS missing_role
  FROM flat""",
    "documents_from_files": """SELECT CAST(0 AS INTEGER) AS person_pos, CAST(role_pos AS INTEGER) AS role_pos,
         'S-' || s_suppkey AS mission_identifier, '' AS startDate, '' AS endDate, s_name AS institution,
         CASE role_pos WHEN 0 THEN 'Owner' ELSE 'Nation ' || s_nationkey END AS role,
         'Supplier' AS firstName, s_name AS lastName
  FROM supplier CROSS JOIN (VALUES (0), (1)) AS r(role_pos)""",
    "mission_index": _with(LINKS)
    + "SELECT page_id, position, replace(split_part(url, '/', -1), '\"', '') AS name, url FROM entries",
    "mission_index_first": _with(LINKS)
    + "SELECT page_id, position, replace(split_part(url, '/', -1), '\"', '') AS name, url FROM entries WHERE position < 3",
    "index_from_files": """SELECT CAST(position AS INTEGER) AS position, name,
         'https://example.com/api/supplier/' || name AS url
  FROM (SELECT 0 AS position, replace(s_name, '#', '%23') AS name FROM supplier
        UNION ALL SELECT 1, CAST(s_nationkey AS VARCHAR) FROM supplier)""",
    # missions
    "missions_clean": _with(MISSIONS) + f"SELECT {_CLEAN_COLUMNS} FROM people",
    "missions_clean_trimmed": _with(MISSIONS)
    + f"SELECT {_FLAT_COLUMNS}, start_date, end_date, trim(full_name) AS full_name FROM people",
    "missions_curated": _with(MISSIONS) + f"SELECT {_CLEAN_COLUMNS} FROM people",
    "missions_quality_flags": _with(MISSIONS) + "SELECT * FROM flagged",
    "missions_by_institution": _with(MISSIONS)
    + """SELECT institution, COUNT(*) AS investigator_rows FROM people GROUP BY institution
  ORDER BY investigator_rows DESC, institution LIMIT 20""",
    "missions_by_role": _with(MISSIONS) + "SELECT role, COUNT(*) AS role_rows FROM people GROUP BY role",
    "missions_kpis": _with(MISSIONS)
    + """SELECT COUNT(*) AS total_rows, COUNT(DISTINCT firstName || ' ' || lastName) AS distinct_people,
         COUNT(DISTINCT institution) AS distinct_institutions FROM people""",
    "missions_quality_summary": _with(MISSIONS)
    + "SELECT "
    + ", ".join(
        f"CAST(SUM(CASE WHEN is_missing_{n} THEN 1 ELSE 0 END) AS BIGINT) AS missing_{n}"
        for n in ("mission_identifier", "person_name", "institution", "role")
    )
    + " FROM flagged",
    "missions_preview": _with(MISSIONS)
    + """SELECT mission_identifier, startDate, endDate, institution, role, full_name FROM people
  ORDER BY mission_identifier NULLS FIRST, institution, role, full_name, startDate, endDate LIMIT 50""",
    # files and tables
    "bronze_csv_roundtrip": _with(RAW_SALES)
    + """SELECT CAST(sale_id AS VARCHAR) AS sale_id, CAST(order_id AS VARCHAR) AS order_id,
         CAST(product_id AS VARCHAR) AS product_id, CAST(quantity AS VARCHAR) AS quantity,
         CAST(unit_price AS VARCHAR) AS unit_price,
         coalesce(CAST(discount_pct AS VARCHAR), 'none') AS discount_pct,
         CAST(line_total AS VARCHAR) AS line_total FROM raw_sales""",
    "bronze_appended_twice": _with(RAW_ORDERS)
    + "SELECT order_status, 2 * COUNT(*) AS cnt FROM raw_orders GROUP BY order_status",
    "bronze_preview": "SELECT least(10, COUNT(*)) AS preview_rows, least(10, COUNT(*)) AS found FROM lineitem",
    "csv_to_parquet": _with(RAW_ORDERS)
    + """SELECT CAST(order_id AS INTEGER) AS order_id, customer_text AS customer_id, order_date, order_status,
         lpad(CAST(order_id % 12 AS VARCHAR), 3, '0') AS source, lpad(CAST(order_id % 12 AS VARCHAR), 3, '0') || '.csv'
           AS file
  FROM raw_orders""",
    "csv_shapes_to_parquet": _with(RAW_ORDERS)
    + """SELECT CAST(order_id AS INTEGER) AS order_id, customer_text AS customer_id, order_date, order_status
  FROM raw_orders
  UNION ALL SELECT CAST(order_id AS INTEGER), NULL, order_date, NULL FROM raw_orders""",
    "parquet_export": _with(PRODUCTS)
    + f"SELECT product_id, product_name, category, {_MONEY.format('list_price')} FROM products",
    "path_append": _with(PRODUCTS)
    + f"SELECT product_id, product_name, category, {_MONEY.format('list_price')} FROM products CROSS JOIN (VALUES (1), (2))",
    "flat_csv_roundtrip": _with(DOCUMENTS)
    + f"""SELECT * REPLACE ('  ' || institution || chr(9) AS institution, ' ' || role || ' ' AS role)
  FROM (SELECT {_FLAT_COLUMNS} FROM flat)""",
    "documents_csv": "SELECT doc_id, lang, source, text FROM documents",
    "flat_parquet_roundtrip": _with(DOCUMENTS) + f"SELECT {_FLAT_COLUMNS} FROM flat",
    "external_table": _with(MISSIONS) + "SELECT * FROM flagged",
    "empty_table_like": "SELECT * FROM customer WHERE 1 = 0",
    "clustered_rewrite": _with(MISSIONS) + f"SELECT {_FLAT_COLUMNS} FROM mission_rows",
    "clustered_external": _with(MISSIONS) + f"SELECT {_CLEAN_COLUMNS} FROM people CROSS JOIN (VALUES (1), (2))",
    # streams
    "clustered_stream": _EVENTS,
    "shared_target": _EVENTS,
    "stream_changing_shapes": """SELECT event_id,
  CASE WHEN event_id % 3 <> 2 THEN strftime(ts, '%Y-%m-%d %H:%M:%S.%f') END AS ts,
  CASE WHEN event_id % 3 <> 1 OR user_id % 5 <> 0 THEN user_id END AS user_id,
  CASE WHEN event_id % 3 <> 2 THEN event_type END AS event_type, CASE WHEN event_id % 3 <> 2 THEN value END AS value,
  CASE WHEN event_id % 3 <> 2 THEN props END AS props, CASE WHEN event_id % 3 = 2 THEN 'late' END AS note,
  CASE WHEN event_id % 3 = 1 AND user_id % 5 = 0 THEN 'u' || user_id END AS _rescued
FROM events""",
    "zordered_rewrite": "SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, CAST(l_quantity AS DOUBLE) AS l_quantity"
    " FROM lineitem WHERE l_suppkey % 3 = 0",
    "stream_ingest": _EVENTS,
    "stream_continuous": _EVENTS,
    "bulk_load_idempotent": _EVENTS,
    # all layers
    "medallion_layers": _with(RAW_CUSTOMERS, PRODUCTS, ORDERS, SALES, DAILY, TOP)
    + f""", customers AS ({_first(
        "raw_customers", "customer_id, first_name, last_name, email, country", "customer_id",
        "first_name, last_name, email, signup_date, country, loaded",
    )}), people AS (
  SELECT c.customer_id, concat_ws('|', first_name, last_name, email, country) AS label,
         COUNT(DISTINCT o.order_id) AS orders, SUM(line_total) AS spend
  FROM customers c LEFT JOIN placed o ON c.customer_id = o.customer_id LEFT JOIN sales s ON o.order_id = s.order_id
  GROUP BY ALL)
SELECT 'daily_revenue' AS mart, CAST(order_date AS VARCHAR) AS key, CAST(NULL AS VARCHAR) AS label,
       CAST(total_revenue AS DOUBLE) AS amount, line_count AS n, order_count AS orders, unique_customers AS customers
FROM daily
UNION ALL SELECT 'top_products', CAST(product_id AS VARCHAR), concat_ws('|', product_name, category),
       CAST(total_sales AS DOUBLE), total_qty, NULL, NULL FROM top_products
UNION ALL SELECT 'customer_360', CAST(customer_id AS VARCHAR), label, CAST(spend AS DOUBLE), NULL, orders, NULL
FROM people""",
}
ORACLES["stream_flatten"] = ORACLES["flatten_documents"]
ORACLES["silver_orders_replaced"] = ORACLES["silver_orders_distinct"]

# the marts, summed by order or line first as they are built, against sums over the joined lines
_GOLD_DRIFT = {
    "daily_revenue": """SELECT COUNT(*) AS bad FROM (
  SELECT order_date, SUM(revenue) AS gold FROM (SELECT DISTINCT order_id, order_date FROM raw_orders)
  JOIN (SELECT order_id, SUM(line_total) AS revenue FROM raw_sales GROUP BY order_id) USING (order_id) GROUP BY order_date)
  FULL JOIN (SELECT order_date, SUM(line_total) AS silver FROM placed JOIN raw_sales USING (order_id) GROUP BY order_date)
  USING (order_date) WHERE abs(coalesce(gold, 0) - coalesce(silver, 0)) > 0.01""",
    "top_products": """SELECT COUNT(*) AS bad FROM (
  SELECT product_id, SUM(qty) AS gold FROM (SELECT product_id, sale_id, SUM(quantity) AS qty FROM raw_sales GROUP BY ALL)
  GROUP BY product_id)
  FULL JOIN (SELECT product_id, SUM(quantity) AS silver FROM raw_sales GROUP BY product_id) USING (product_id)
  WHERE coalesce(gold, 0) <> coalesce(silver, 0)""",
}

_LAYER_CHECKS = [
    *((t, f"{k}_not_null", f"SELECT COUNT(*) - COUNT({k}) AS bad FROM {_VIEWS[t]}") for t, k in _TABLES.items()),
    *((t, f"{k}_unique", f"SELECT COUNT(*) - COUNT(DISTINCT {k}) AS bad FROM {_VIEWS[t]}") for t, k in _TABLES.items()),
    *(("sales", n, f"SELECT COUNT(*) AS bad FROM raw_sales WHERE {c}") for n, c in _BAD.items()),
    ("sales", "line_total_not_null", "SELECT COUNT(*) AS bad FROM raw_sales WHERE line_total IS NULL"),
    ("sales", "line_total_mismatch", f"SELECT COUNT(*) AS bad FROM raw_sales WHERE {_MISMATCH}"),
    *((t, n, q) for n, (t, q) in _ORPHANS.items()),
    # stored by the silver stage as well
    ("orders", "order_id_not_null", "SELECT COUNT(*) - COUNT(order_id) AS bad FROM placed"),
    ("sales", "line_total_not_null", "SELECT COUNT(*) AS bad FROM raw_sales WHERE line_total IS NULL"),
    ("sales", "orphan_sales_orders", _ORPHANS["orphan_sales_orders"][1]),
]
ORACLES["medallion_results"] = _LAYERS + "\nSELECT * EXCLUDE (check_ts) FROM (" + _union(
    [_result("silver", *check) for check in _LAYER_CHECKS]
    + [_result("gold", f"{mart}", f"{mart}_matches_silver", query) for mart, query in _GOLD_DRIFT.items()]
) + ")"
