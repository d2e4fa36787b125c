"""The queries of :mod:`lauter.plans.catalog` as SQL for an independent engine (DuckDB)."""

from __future__ import annotations

from lauter.plans import catalog, inputs
from lauter.plans.inputs import plain


def _quote(value: str) -> str:
    return "'" + value.replace("'", "''") + "'"


# --- fixed values, stated apart from the code they check -----------------------
MAX_LENGTHS = {'name': 256, 'email': 256, 'sku': 64, 'phone': 32, 'status': 32, 'category': 128}
_BLANK = _quote('\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000')
_NOTHING = "'', '-', '--', 'n/a', 'na', 'nil', 'none', 'null', 'undefined'"
_EMAIL = _quote(
    "^[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+(\\.[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+)*@([A-Za-z0-9]([A-Za-z0-9-]*[A-Za-z0-9])?\\.)+[A-Za-z]{2,}$"
)
_PHONE = r"'^\+?[\d\s\-().]{7,20}$'"
_FORMATS = (
    "['%Y-%m-%d %H:%M:%S', '%Y-%m-%dT%H:%M:%S', '%Y-%m-%dT%H:%M:%SZ', '%Y-%m-%d', "
    "'%d/%m/%Y', '%m/%d/%Y']"
)


def _fixed(x: str) -> str:
    return rf"regexp_replace(nfc_normalize({x}), '[^\P{{C}}\t\n]', '', 'g')"


def _trimmed(x: str) -> str:
    return f"trim({x}, {_BLANK})"


def _nullified(x: str) -> str:
    return f"CASE WHEN lower({x}) IN ({_NOTHING}) THEN NULL ELSE {x} END"


def _cleaned(column: str) -> str:
    value = _nullified(_trimmed(_fixed(column)))
    width = MAX_LENGTHS.get(column)
    return f"substr({value}, 1, {width})" if width else value


def _title(x: str) -> str:
    runs = rf"regexp_extract_all({x}, '([\p{{Lu}}\p{{Ll}}\p{{Lt}}]+|[^\p{{Lu}}\p{{Ll}}\p{{Lt}}]+)')"
    return f"array_to_string(list_transform({runs}, lambda w: upper(w[1:1]) || lower(w[2:])), '')"


def _decimal(x: str) -> str:
    return f"TRY_CAST(replace({x}, '_', '') AS DECIMAL(38,18))"


def _checked(raw: str, columns: list[str], others: str, stored: str, *faults: str) -> str:
    cleaned = ", ".join(f"{_cleaned(c)} AS {c}" for c in columns)
    return (
        f"SELECT {stored}, {others}, concat_ws('; ', {', '.join(faults)}) AS errors "
        f"FROM (SELECT {cleaned}, {others} FROM ({plain(raw)}) r) c"
    )


def _missing(column: str, *rest: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN '{column}: missing' {' '.join(rest)} END"


def _customers(raw: str, others: str = "pos") -> str:
    return _checked(
        raw,
        ["name", "email", "phone"],
        others,
        "name, lower(email) AS email, phone",
        _missing("name"),
        _missing(
            "email",
            f"WHEN NOT regexp_matches(email, {_EMAIL}) OR length(split_part(email, '@', 1)) > 64 "
            "THEN 'email: invalid'",
        ),
        f"CASE WHEN NOT regexp_matches(phone, {_PHONE}) THEN 'phone: invalid' END",
    )


def _categories(raw: str) -> str:
    return _checked(
        raw,
        ["name"],
        "pos",
        f"{_title('name')} AS name",
        _missing("name", "WHEN length(name) > 128 THEN 'name: longer than 128'"),
    )


def _money(column: str, value: str, dtype: str, sign_of: str) -> str:
    return _missing(
        column,
        f"WHEN {value} IS NULL THEN '{column}: invalid'",
        f"WHEN {sign_of} < 0 THEN '{column}: negative'",
        f"WHEN TRY_CAST({value} AS {dtype}) IS NULL THEN '{column}: out_of_range'",
    )


def _products(raw: str) -> str:
    price = f"round_even({_decimal('price')}, 2)"
    return _checked(
        raw,
        ["sku", "name", "category", "price"],
        "pos",
        f"upper(sku) AS sku, name, {_title('category')} AS category, "
        f"TRY_CAST({price} AS DECIMAL(10,2)) AS price",
        _missing("sku"),
        _missing("name"),
        _money("price", price, "DECIMAL(10,2)", price),
    )


def _orders(raw: str) -> str:
    amount = _decimal("total_amount")
    moment = f"try_strptime(ordered_at, {_FORMATS})"
    return _checked(
        raw,
        ["customer_email", "status", "total_amount", "ordered_at"],
        "pos",
        "lower(customer_email) AS customer_email, lower(status) AS status, "
        f"TRY_CAST({amount} AS DECIMAL(12,2)) AS total_amount, {moment} AS ordered_at",
        _missing("customer_email"),
        _missing("status"),
        _money("total_amount", amount, "DECIMAL(12,2)", amount),
        _missing("ordered_at", f"WHEN {moment} IS NULL THEN 'ordered_at: invalid'"),
    )


def _items(raw: str) -> str:
    price = f"round_even({_decimal('unit_price')}, 2)"
    number = r"CASE WHEN regexp_matches({0}, '^[+-]?\d+(\.0+)?$') THEN TRY_CAST({0} AS {1}) END"
    index, quantity = number.format("order_index", "BIGINT"), number.format("quantity", "INTEGER")
    return _checked(
        raw,
        ["order_index", "product_sku", "quantity", "unit_price"],
        "line",
        f"{index} AS order_index, upper(product_sku) AS product_sku, {quantity} AS quantity, "
        f"TRY_CAST({price} AS DECIMAL(10,2)) AS unit_price",
        _missing("order_index", f"WHEN {index} IS NULL THEN 'order_index: invalid'"),
        _missing("product_sku"),
        _missing(
            "quantity",
            f"WHEN {quantity} IS NULL THEN 'quantity: invalid'",
            f"WHEN {quantity} < 1 THEN 'quantity: below 1'",
        ),
        _money("unit_price", price, "DECIMAL(10,2)", price),
    )


def _first(checked: str, key: str) -> str:
    return (
        f"SELECT * EXCLUDE (errors, rn, pos), pos AS id FROM (SELECT *, row_number() OVER "
        f"(PARTITION BY {key} ORDER BY pos) AS rn FROM ({checked}) v WHERE errors = '') f "
        "WHERE rn = 1"
    )


CUSTOMERS = _customers(inputs.RAW_CUSTOMERS)
CATEGORIES = _categories(inputs.RAW_CATEGORIES)
PRODUCTS = _products(inputs.RAW_PRODUCTS)
ORDERS = _orders(inputs.RAW_ORDERS)
ITEMS = _items(inputs.RAW_ITEMS)
FIRST_CUSTOMERS = _first(CUSTOMERS, "email")
FIRST_CATEGORIES = _first(CATEGORIES, "name")
FIRST_PRODUCTS = _first(PRODUCTS, "sku")

RESOLVED_ORDERS = f"""
SELECT o.*, c.id AS customer_id,
  CASE WHEN o.errors <> '' THEN 'order validation: ' || o.errors
    WHEN c.id IS NULL THEN 'Unknown customer email: ' || o.customer_email END AS reason
FROM ({ORDERS}) o LEFT JOIN ({FIRST_CUSTOMERS}) c ON c.email = o.customer_email
"""
RESOLVED_ITEMS = f"""
SELECT i.*, p.id AS product_id,
  CASE WHEN i.errors <> '' THEN 'order item validation: ' || i.errors
    WHEN p.id IS NULL THEN 'Unknown product sku: ' || i.product_sku END AS reason
FROM ({ITEMS}) i LEFT JOIN ({FIRST_PRODUCTS}) p ON p.sku = i.product_sku
"""
STORED_ORDERS = f"""
SELECT customer_email AS email, status, total_amount, ordered_at
FROM ({RESOLVED_ORDERS}) r WHERE reason IS NULL
"""

_RUNS = plain(inputs.RUNS)
_SUMMARY = (
    "SELECT id, source, CAST(rows_ingested AS BIGINT) AS rows_ingested, "
    "CAST(rows_failed AS BIGINT) AS rows_failed, started_at, finished_at, "
    "datediff('microsecond', started_at, finished_at) / 1e6 AS duration_seconds"
)


def _digest(source: str, *columns: str) -> str:
    parts = ", ".join(f"length({c}) AS {c}_length, md5({c}) AS {c}_md5" for c in columns)
    return f"SELECT doc_id, {parts} FROM ({source}) d"


def _documents(expression: str) -> str:
    return f"(SELECT doc_id, {expression} AS text FROM documents) r"


def _log_lines(rejects: str, by: str = "") -> str:
    """One text per group: a line per distinct reason, with its count when repeated."""
    comma = f"{by}, " if by else ""
    group = f" GROUP BY {by}" if by else ""
    return (
        f"SELECT {comma}string_agg(line, chr(10) ORDER BY line) AS error_log, "
        f"CAST(sum(n) AS BIGINT) AS rows_failed FROM (SELECT {comma}n, CASE WHEN n = 1 "
        f"THEN reason ELSE reason || ' (x' || n || ')' END AS line FROM (SELECT {comma}reason, "
        f"count(*) AS n FROM ({rejects}) x GROUP BY {comma}reason) y) z{group}"
    )


def _profile(table: str, source: str, columns: list[str], ingested: int) -> str:
    parts = " UNION ALL ".join(
        f"SELECT {i} AS position, '{c}' AS \"column\", count(*) AS total_rows, "
        f"count(*) - count({c}) AS null_count, count(DISTINCT {c}) AS distinct_count FROM src"
        for i, c in enumerate(columns)
    )
    return f"""
WITH src AS ({source}), p AS ({parts})
SELECT '{table}' AS table_name, position, "column", total_rows, null_count, distinct_count,
  null_count / total_rows AS null_rate, distinct_count / total_rows AS distinct_rate,
  round(null_count / total_rows * 100, 2) AS null_rate_pct,
  round(distinct_count / total_rows * 100, 2) AS distinct_rate_pct,
  CAST({ingested} AS BIGINT) AS ingested_rows, total_rows <= {ingested} AS reconciliation_ok
FROM p
"""


def _upserted(old: str, new: str, key: str, columns: list[str]) -> str:
    values = ", ".join(
        f"CASE WHEN n.{key} IS NOT NULL THEN n.{c} ELSE o.{c} END AS {c}" for c in columns
    )
    return (
        f"SELECT coalesce(o.{key}, n.{key}) AS {key}, {values} "
        f"FROM ({old}) o FULL OUTER JOIN ({new}) n ON o.{key} = n.{key}"
    )


def _with_category(products: str) -> str:
    return (
        f"SELECT p.sku, p.name, p.price, k.name AS category FROM ({products}) p "
        f"LEFT JOIN ({FIRST_CATEGORIES}) k ON k.name = p.category"
    )


def _reasons(label: str, checked: str) -> str:
    return (
        f"SELECT '{label} validation: ' || errors AS reason, count(*) AS rows "
        f"FROM ({checked}) v WHERE errors <> '' GROUP BY 1"
    )


_ORDER_FILE = plain(catalog.ORDER_FILE)
_FILE_ORDERS = _orders(
    "SELECT n AS pos, customer_email, status, total_amount, ordered_at "
    "FROM (" + catalog.ORDER_FILE + ") f WHERE customer_email <> ''"
)
_FILE_CUSTOMERS = _customers(
    "SELECT n AS pos, customer_name AS name, customer_email AS email, customer_phone AS phone "
    "FROM (" + catalog.ORDER_FILE + ") f WHERE customer_email <> ''"
)
_FILE_ITEMS = _items(
    "SELECT CAST(n AS STRING) AS order_index, n AS line, product_sku, quantity, unit_price "
    "FROM (" + catalog.ORDER_FILE + ") f"
)


def _row(table: str, *columns: str) -> str:
    values = ", ".join(f"coalesce(CAST({c} AS VARCHAR), '-')" for c in columns)
    return f"SELECT '{table}' AS table_name, concat_ws('|', {values}) AS row"


EVENT_DOCUMENTS = r"""
SELECT event_id, '}"],\{' || event_type || chr(10) || '[' || props AS note, value FROM events"""


ORACLES = {
    "q1_customer_history": f"""
SELECT id AS order_id, status, total_amount, ordered_at FROM ({plain(inputs.ORDERS)}) o
WHERE customer_id = {catalog.CUSTOMER_ID} ORDER BY ordered_at DESC, order_id DESC""",
    "q2_pending_dashboard": f"""
SELECT o.id AS order_id, c.name AS customer_name, c.email AS customer_email, o.total_amount,
  o.ordered_at
FROM ({plain(inputs.ORDERS)}) o JOIN ({plain(inputs.CUSTOMERS)}) c ON c.id = o.customer_id
WHERE o.status = 'pending'
  AND o.ordered_at BETWEEN TIMESTAMP '{catalog.PENDING_FROM}' AND TIMESTAMP '{catalog.PENDING_TO}'
ORDER BY o.ordered_at, order_id""",
    "pending_orders_view": f"SELECT * FROM ({plain(inputs.ORDERS)}) o WHERE status = 'pending'",
    "q3_revenue_by_category": f"""
SELECT k.name AS category, count(DISTINCT o.id) AS order_count,
  CAST(sum(i.quantity) AS BIGINT) AS units_sold,
  CAST(sum(i.quantity * i.unit_price) AS DECIMAL(38,2)) AS revenue
FROM ({plain(inputs.ORDER_ITEMS)}) i
JOIN ({plain(inputs.PRODUCTS)}) p ON p.id = i.product_id
JOIN ({plain(inputs.CATEGORIES)}) k ON k.id = p.category_id
JOIN ({plain(inputs.ORDERS)}) o ON o.id = i.order_id
WHERE o.status = 'completed' GROUP BY k.id, k.name ORDER BY revenue DESC""",
    "q4_daily_run_summary": f"""
SELECT CAST(started_at AS DATE) AS run_date, count(*) AS runs,
  CAST(sum(rows_ingested) AS BIGINT) AS total_ingested,
  CAST(sum(rows_failed) AS BIGINT) AS total_failed,
  avg(datesub('second', started_at, finished_at)) AS avg_duration_sec
FROM ({_RUNS}) r GROUP BY run_date ORDER BY run_date DESC""",
    "q5_top_products": f"""
SELECT p.sku, p.name, CAST(sum(i.quantity * i.unit_price) AS DECIMAL(38,2)) AS revenue
FROM ({plain(inputs.ORDER_ITEMS)}) i JOIN ({plain(inputs.PRODUCTS)}) p ON p.id = i.product_id
GROUP BY p.id, p.sku, p.name ORDER BY revenue DESC, p.sku LIMIT 10""",
    "clean_nfc": _digest(
        f"SELECT doc_id, {_fixed('text')} AS text FROM {_documents(catalog.DECOMPOSED)}", "text"
    ),
    "clean_strip_control": _digest(
        f"SELECT doc_id, {_trimmed(_fixed('text'))} AS text "
        f"FROM {_documents(catalog.WITH_CONTROLS)}",
        "text",
    ),
    "clean_nulls": _digest(
        f"SELECT doc_id, {_nullified('text')} AS text, {_nullified('mark')} AS mark "
        f"FROM (SELECT doc_id, text, {catalog.SENTINEL} AS mark FROM documents) d",
        "text",
        "mark",
    ),
    "clean_truncate": _digest(
        "SELECT doc_id, text AS other, "
        + ", ".join(f"substr(text, 1, {n}) AS {c}" for c, n in MAX_LENGTHS.items())
        + " FROM documents",
        *MAX_LENGTHS,
        "other",
    ),
    "clean_records": f"""
SELECT pos, {_cleaned('name')} AS name, {_cleaned('email')} AS email,
  {_cleaned('phone')} AS phone, {_cleaned('segment')} AS segment
FROM ({plain(inputs.RAW_CUSTOMERS)}) r""",
    "validate_customers": CUSTOMERS,
    "validate_categories": CATEGORIES,
    "validate_products": PRODUCTS,
    "validate_orders": ORDERS,
    "validate_items": ITEMS,
    "parse_dates": f"""
SELECT pos, ordered_at, try_strptime(ordered_at, {_FORMATS}) AS parsed
FROM ({plain(inputs.RAW_ORDERS)}) r""",
    "price_half_even": f"""
SELECT order_index, line, unit_price,
  CAST(round_even({_decimal('unit_price')}, 2) AS DECIMAL(20,2)) AS price
FROM ({plain(inputs.RAW_ITEMS)}) r""",
    "title_case": f"SELECT pos, {_title('name')} AS name FROM ({plain(inputs.RAW_CATEGORIES)}) r",
    "reject_reason_counts": " UNION ALL ".join(
        _reasons(label, checked)
        for label, checked in (
            ("customer", CUSTOMERS),
            ("category", CATEGORIES),
            ("product", PRODUCTS),
            ("order", ORDERS),
            ("order item", ITEMS),
        )
    ),
    "dedup_customers": FIRST_CUSTOMERS,
    "dedup_categories": FIRST_CATEGORIES,
    "dedup_products": FIRST_PRODUCTS,
    "distinct_categories": f"""
SELECT DISTINCT category FROM ({plain(inputs.RAW_PRODUCTS)}) r WHERE category <> ''""",
    "orders_fk_accept": f"""
SELECT pos, customer_id, status, total_amount, ordered_at FROM ({RESOLVED_ORDERS}) r
WHERE reason IS NULL""",
    "orders_fk_reject": f"SELECT pos, reason FROM ({RESOLVED_ORDERS}) r WHERE reason IS NOT NULL",
    "products_fk_left": f"""
SELECT p.sku, p.name, k.id AS category_id, p.price
FROM ({FIRST_PRODUCTS}) p LEFT JOIN ({FIRST_CATEGORIES}) k ON k.name = p.category""",
    "items_fk_accept": f"""
SELECT order_index, line, product_id, quantity, unit_price FROM ({RESOLVED_ITEMS}) r
WHERE reason IS NULL""",
    "items_fk_reject": f"""
SELECT order_index, line, reason FROM ({RESOLVED_ITEMS}) r WHERE reason IS NOT NULL""",
    "id_map": f"SELECT email, id FROM ({FIRST_CUSTOMERS}) c",
    "orphans": f"""
SELECT o.id, o.customer_id FROM ({plain(inputs.ORDERS)}) o
WHERE o.customer_id NOT IN (SELECT id FROM ({FIRST_CUSTOMERS}) c)""",
    "upsert_customers": _upserted(
        FIRST_CUSTOMERS,
        _first(_customers(inputs.LATER_CUSTOMERS), "email"),
        "email",
        ["name", "phone"],
    ),
    "upsert_bucketed": _upserted(
        FIRST_CUSTOMERS,
        _first(_customers(inputs.LATER_CUSTOMERS), "email"),
        "email",
        ["name", "phone"],
    ),
    "upsert_products": _upserted(
        _with_category(FIRST_PRODUCTS),
        _with_category(_first(_products(inputs.LATER_PRODUCTS), "sku")),
        "sku",
        ["name", "category", "price"],
    ),
    "upsert_categories": f"""
SELECT name, CAST(NULL AS BIGINT) AS parent_id FROM ({FIRST_CATEGORIES}) a
UNION
SELECT {_title(_cleaned('category'))}, NULL FROM ({plain(inputs.RAW_PRODUCTS)}) r
WHERE {_cleaned('category')} IS NOT NULL""",
    "append_orders": STORED_ORDERS,
    "stream_ingest": STORED_ORDERS,
    "stream_parquet_ingest": STORED_ORDERS,
    "ingested_by_source_entity": f"""
SELECT 'crm' AS source, 'customers' AS entity, 'success' AS status,
  (SELECT count(*) FROM ({FIRST_CUSTOMERS}) c) AS rows_ingested_total,
  (SELECT count(*) FROM ({CUSTOMERS}) c WHERE errors <> '') AS rows_failed_total
UNION ALL
SELECT 'shop', 'orders', 'success', 2 * count(CASE WHEN reason IS NULL THEN 1 END),
  2 * count(CASE WHEN reason IS NOT NULL THEN 1 END)
FROM ({RESOLVED_ORDERS}) o""",
    "batch_duration_histogram": f"""
WITH timed AS (
  SELECT source, entity, status, datediff('microsecond', started_at, finished_at) / 1e6 AS s
  FROM ({plain(inputs.STEPS)}) r WHERE finished_at IS NOT NULL
), bars AS (
  SELECT le, le_name FROM (VALUES (0.01, '0.01'), (0.05, '0.05'), (0.1, '0.1'), (0.5, '0.5'),
    (1, '1.0'), (5, '5.0'), (10, '10.0'), (30, '30.0'), (1e300, '+Inf')) b(le, le_name)
)
SELECT t.source, t.entity, t.status, b.le_name AS le, count(CASE WHEN t.s <= b.le THEN 1 END) AS runs
FROM timed t CROSS JOIN bars b GROUP BY t.source, t.entity, t.status, b.le_name""",
    "dead_letters": f"""
SELECT 'customer validation: ' || errors AS reason, pos FROM ({CUSTOMERS}) v
WHERE errors <> ''""",
    "run_audit": f"""
SELECT 'customers' AS source, (SELECT count(*) FROM ({FIRST_CUSTOMERS}) c) AS rows_ingested,
  rows_failed, error_log
FROM ({_log_lines(f"SELECT 'customer validation: ' || errors AS reason FROM ({CUSTOMERS}) v "
                  "WHERE errors <> ''")}) a
UNION ALL
SELECT 'orders', (SELECT count(*) FROM ({RESOLVED_ORDERS}) o WHERE reason IS NULL), rows_failed,
  error_log
FROM ({_log_lines(f"SELECT CASE WHEN errors = '' THEN 'Unknown customer email' ELSE reason END "
                  f"AS reason FROM ({RESOLVED_ORDERS}) v WHERE reason IS NOT NULL")}) b
UNION ALL
SELECT 'generic', 0, 0, NULL""",
    "order_file": f"""
WITH names AS (
  SELECT {_title(_cleaned('category'))} AS name FROM ({_ORDER_FILE}) f
  WHERE {_cleaned('category')} IS NOT NULL
  UNION
  SELECT {_title(_cleaned('category'))} FROM ({plain(inputs.RAW_PRODUCTS)}) r
  WHERE {_cleaned('category')} IS NOT NULL
), buyers AS ({_first(_FILE_CUSTOMERS, "email")}),
bought AS (
  SELECT o.pos, o.customer_email AS email, o.status, o.total_amount, o.ordered_at
  FROM ({_FILE_ORDERS}) o JOIN buyers b ON b.email = o.customer_email WHERE o.errors = ''
), feed AS ({FIRST_PRODUCTS}), sold AS (
  SELECT o.email, o.total_amount, o.ordered_at, p.sku, i.quantity, i.unit_price
  FROM ({_FILE_ITEMS}) i JOIN bought o ON o.pos = i.line
  JOIN feed p ON p.sku = i.product_sku WHERE i.errors = ''
)
{_row("categories", "name")} FROM names
UNION ALL
{_row("products", "p.sku", "p.name", "k.name", "p.price")}
FROM feed p LEFT JOIN names k ON k.name = p.category
UNION ALL
{_row("customers", "email", "name", "phone")} FROM buyers
UNION ALL
{_row("orders", "email", "status", "total_amount", "ordered_at")} FROM bought
UNION ALL
{_row("order_items", "email", "total_amount", "ordered_at", "sku", "quantity", "unit_price")}
FROM sold""",
    "profile_customer": _profile(
        "customers", plain(inputs.CUSTOMERS), ["name", "email", "phone"], 0
    ),
    "profile_lineitem": _profile(
        "order_items",
        plain(inputs.ORDER_ITEMS),
        ["order_id", "product_id", "quantity", "unit_price"],
        10**12,
    ),
    "profile_stored": _profile(
        "customers", FIRST_CUSTOMERS, ["name", "email", "phone"], 0
    ).replace("CAST(0 AS BIGINT)", "total_rows").replace("total_rows <= 0", "true"),
    "high_null_columns": f"""
SELECT 'error_log' AS "column", count(*) AS null_count, CAST(1 AS DOUBLE) AS null_rate
FROM ({_RUNS}) r
UNION ALL
SELECT 'finished_at', count(*) - count(finished_at),
  (count(*) - count(finished_at)) / count(*) FROM ({_RUNS}) r
HAVING (count(*) - count(finished_at)) / count(*) > 0.5""",
    "value_distribution": f"""
SELECT status AS value, count(*) AS rows FROM ({plain(inputs.ORDERS)}) o
GROUP BY status ORDER BY rows DESC, value""",
    "latest_runs": f"{_SUMMARY} FROM ({_RUNS}) r ORDER BY started_at DESC, id DESC LIMIT 10",
    "runs_page": (
        f"{_SUMMARY} FROM ({_RUNS}) r ORDER BY started_at DESC, id DESC LIMIT 20 OFFSET 40"
    ),
    "run_by_id": f"{_SUMMARY}, error_log FROM ({_RUNS}) r WHERE id = {catalog.RUN_ID}",
    "error_log": _log_lines(
        "SELECT segment, 'customer validation: ' || errors AS reason "
        f"FROM ({_customers(inputs.RAW_CUSTOMERS, 'pos, segment')}) v WHERE errors <> ''",
        "segment",
    ),
    "ingested_by_source": f"""
SELECT source, CAST(sum(rows_ingested) AS BIGINT) AS rows_ingested_total FROM ({_RUNS}) r
GROUP BY source""",
    "failed_by_category": f"""
SELECT 'orders' AS source, split_part(reason, ':', 1) AS reason_category,
  count(*) AS rows_failed_total
FROM ({RESOLVED_ORDERS}) r WHERE reason IS NOT NULL GROUP BY 1, 2""",
    "duration_histogram": f"""
WITH timed AS (
  SELECT source, datediff('microsecond', started_at, finished_at) / 1e6 AS s FROM ({_RUNS}) r
  WHERE finished_at IS NOT NULL
), bars AS (
  SELECT le, le_name FROM (VALUES (1, '1'), (5, '5'), (10, '10'), (30, '30'), (60, '60'),
    (120, '120'), (300, '300'), (600, '600'), (1e300, '+Inf')) b(le, le_name)
)
SELECT t.source, b.le_name AS le, count(CASE WHEN t.s <= b.le THEN 1 END) AS runs
FROM timed t CROSS JOIN bars b GROUP BY t.source, b.le_name""",
    "parquet_projection": "SELECT l_orderkey, l_quantity, l_shipdate FROM lineitem",
    "csv_roundtrip": f"""
SELECT CAST(pos AS STRING) AS pos, name || chr(10) || '"quoted", lines' AS name, email, phone
FROM ({plain(inputs.RAW_CUSTOMERS)}) r""",
    "ndjson_lines": f"""
SELECT event_id,
  CASE WHEN NOT json_valid(value) THEN 'malformed_json'
    WHEN json_type(value) <> 'OBJECT' THEN 'not_an_object' END AS problem,
  CASE WHEN json_valid(value) THEN CAST(json_extract(value, '$.id') AS BIGINT) END AS id,
  CASE WHEN json_valid(value) THEN json_extract_string(value, '$.type') END AS type,
  CASE WHEN json_valid(value) THEN CAST(json_extract(value, '$.props.k') AS BIGINT) END AS k
FROM ({plain(inputs.JSON_LINES)}) l WHERE trim(value) <> ''""",
    "ndjson_records": f"""
SELECT CAST(json_extract(value, '$.id') AS BIGINT) AS id,
  json_extract_string(value, '$.type') AS type,
  CAST(json_extract(value, '$.props.k') AS BIGINT) AS k
FROM (SELECT CASE WHEN json_valid(value) THEN value END AS value
      FROM ({plain(inputs.JSON_LINES)}) l) v
WHERE json_type(value) = 'OBJECT'""",
    "json_array": f"""
SELECT event_id, CAST(json_extract(e, '$.k') AS BIGINT) AS k
FROM (SELECT event_id, unnest(CASE WHEN json_type(value) = 'ARRAY'
        THEN from_json(value, '["JSON"]') ELSE [CAST(value AS JSON)] END) AS e
      FROM ({plain(inputs.JSON_DOCUMENTS)}) d) x
WHERE json_type(e) = 'OBJECT'""",
    "json_files": EVENT_DOCUMENTS,
    "json_split_scan": EVENT_DOCUMENTS,
    "csv_split_scan": _digest(
        """SELECT doc_id, lang, '"Q", ' || text || chr(10) || '"' AS text FROM documents""",
        "lang",
        "text",
    ),
    "ndjson_dead_letters": f"""
SELECT CASE WHEN NOT json_valid(value) THEN 'malformed_json'
    WHEN json_type(value) <> 'OBJECT' THEN 'not_an_object'
    ELSE 'category validation: name: missing' END AS reason,
  CASE WHEN json_valid(value) AND json_type(value) = 'OBJECT'
    THEN CAST(json_extract(value, '$.id') AS BIGINT) END AS record_id,
  CASE WHEN NOT json_valid(value) THEN trim(value)
    WHEN json_type(value) <> 'OBJECT' THEN CAST(json(value) AS VARCHAR) END AS line
FROM ({plain(inputs.JSON_LINES)}) l WHERE trim(value) <> ''""",
    "page_flatten": f"""
SELECT event_id, next_url, CAST(json_extract(e, '$.k') AS BIGINT) AS k
FROM (SELECT event_id,
        CASE WHEN json_type(payload) = 'OBJECT'
          THEN nullif(json_extract_string(payload, '$.next'), '') END AS next_url,
        unnest(from_json(CASE json_type(payload) WHEN 'ARRAY' THEN CAST(payload AS JSON)
          WHEN 'OBJECT' THEN json_extract(payload, '$.results') END, '["JSON"]')) AS e
      FROM ({plain(inputs.PAGES)}) p) x
WHERE json_type(e) = 'OBJECT'""",
}
