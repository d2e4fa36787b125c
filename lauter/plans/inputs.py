"""Raw records derived from the given tables.

The tables are clean, so the defects a feed can have are put in by row number.
The SQL is common to Spark and other engines; ``{table}`` stands for a table.
"""

from __future__ import annotations

from string import Formatter

from pyspark.sql import DataFrame, SparkSession

# CAST targets STRING, which the checking engine also knows.
_YEAR = "lpad(CAST(year(o_orderdate) AS STRING), 4, '0')"
_MONTH = "CAST(month(o_orderdate) AS STRING)"
_DAY = "lpad(CAST(day(o_orderdate) AS STRING), 2, '0')"

RAW_CUSTOMERS = """
SELECT c_custkey AS pos,
  CASE c_custkey % 11
    WHEN 0 THEN concat('  ', c_name, ' ')
    WHEN 1 THEN 'N/A'
    WHEN 2 THEN concat('Rémy \x01', c_name, '‍')
    ELSE c_name END AS name,
  CASE WHEN c_custkey % 13 = 0 THEN concat('user', CAST(c_custkey AS STRING))
    WHEN c_custkey % 17 = 0 THEN ' NULL '
    ELSE concat(CASE WHEN c_custkey % 2 = 0 THEN 'User' ELSE ' user' END,
                CAST(c_custkey % 1000 AS STRING), '@Example.com') END AS email,
  CASE c_custkey % 7
    WHEN 0 THEN 'null'
    WHEN 1 THEN 'abc'
    WHEN 2 THEN ''
    WHEN 3 THEN concat('+1-555-', lpad(CAST(c_custkey % 10000 AS STRING), 4, '0'))
    ELSE concat(' (020) ', CAST(1000000 + c_custkey AS STRING)) END AS phone,
  c_mktsegment AS segment
FROM {customer}
"""

# A later feed: other names, some new addresses, some phones withdrawn.
LATER_CUSTOMERS = """
SELECT c_custkey AS pos,
  concat(c_name, ' II') AS name,
  concat('user', CAST((c_custkey * 3) % 1700 AS STRING), '@example.com') AS email,
  CASE WHEN c_custkey % 2 = 0 THEN '--'
    ELSE concat('+44 20 ', CAST(7000000 + c_custkey AS STRING)) END AS phone
FROM {customer}
"""

RAW_CATEGORIES = """
SELECT p_partkey AS pos,
  CASE p_partkey % 5
    WHEN 0 THEN concat(' ', lower(p_type), '  ')
    WHEN 1 THEN upper(p_type)
    WHEN 2 THEN 'undefined'
    WHEN 3 THEN concat(lower(p_type), ' o''neil-', upper(p_brand))
    ELSE p_type END AS name
FROM {part}
"""

RAW_PRODUCTS = """
SELECT p_partkey AS pos,
  CASE p_partkey % 9
    WHEN 0 THEN '  '
    WHEN 1 THEN concat(' sku-', CAST(p_partkey % 1500 AS STRING), ' ')
    ELSE concat('SKU-', CAST(p_partkey % 1500 AS STRING)) END AS sku,
  p_name AS name,
  CASE p_partkey % 6
    WHEN 0 THEN lower(p_type)
    WHEN 1 THEN upper(p_type)
    WHEN 2 THEN '--'
    WHEN 3 THEN concat(p_type, '-x')
    ELSE p_type END AS category,
  CASE p_partkey % 8
    WHEN 0 THEN 'not_a_number'
    WHEN 1 THEN '-0.001'
    WHEN 2 THEN '-5'
    WHEN 3 THEN '1e3'
    WHEN 4 THEN '123456789.99'
    ELSE concat(CAST(p_partkey AS STRING), '.',
                lpad(CAST(p_partkey * 7 % 1000 AS STRING), 3, '0')) END AS price
FROM {part}
"""

LATER_PRODUCTS = """
SELECT p_partkey AS pos,
  concat('sku-', CAST(p_partkey % 1700 AS STRING)) AS sku,
  concat(p_name, ' mk2') AS name,
  CASE WHEN p_partkey % 3 = 0 THEN 'nil' ELSE p_type END AS category,
  CAST(p_size AS STRING) AS price
FROM {part}
"""

RAW_ORDERS = f"""
SELECT o_orderkey AS pos,
  CASE WHEN o_orderkey % 19 = 0 THEN 'n/a'
    ELSE concat('USER', CAST(o_custkey % 1000 AS STRING), '@EXAMPLE.COM ') END AS customer_email,
  CASE o_orderstatus WHEN 'F' THEN ' Completed' WHEN 'P' THEN 'PENDING' ELSE 'Shipped ' END
    AS status,
  CASE WHEN o_orderkey % 23 = 0 THEN '-0.001'
    WHEN o_orderkey % 29 = 0 THEN 'abc'
    WHEN o_orderkey % 31 = 0 THEN '1_000.5'
    ELSE CAST(CAST(o_totalprice AS DECIMAL(18,2)) AS STRING) END AS total_amount,
  CASE o_orderkey % 7
    WHEN 0 THEN concat({_YEAR}, '-', {_MONTH}, '-', {_DAY}, ' 09:23:00')
    WHEN 1 THEN concat({_YEAR}, '-', {_MONTH}, '-', {_DAY}, 'T08:05:07')
    WHEN 2 THEN concat({_YEAR}, '-', {_MONTH}, '-', {_DAY}, 'T23:59:59Z')
    WHEN 3 THEN concat({_YEAR}, '-', {_MONTH}, '-', {_DAY})
    WHEN 4 THEN concat({_DAY}, '/', {_MONTH}, '/', {_YEAR})
    WHEN 5 THEN concat({_MONTH}, '/', {_DAY}, '/', {_YEAR})
    ELSE 'not-a-date' END AS ordered_at
FROM {{orders}}
"""

RAW_ITEMS = """
SELECT CAST(l_orderkey AS STRING) AS order_index,
  l_linenumber AS line,
  concat(' sku-', CAST(l_partkey % 1600 AS STRING)) AS product_sku,
  CASE l_linenumber
    WHEN 1 THEN concat(CAST(CAST(l_quantity AS INT) AS STRING), '.0')
    WHEN 2 THEN '0'
    WHEN 3 THEN '2.5'
    ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS quantity,
  concat(CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS BIGINT) // 100 AS STRING), '.',
         lpad(CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS BIGINT) % 100 AS STRING), 2, '0'),
         '5') AS unit_price
FROM {lineitem}
"""

# The stored tables as the given ones hold them.
CATEGORIES = """
SELECT min(p_partkey) AS id, p_type AS name FROM {part} GROUP BY p_type
"""

PRODUCTS = """
SELECT p.p_partkey AS id, concat('SKU-', lpad(CAST(p.p_partkey AS STRING), 9, '0')) AS sku,
  p.p_name AS name, k.id AS category_id, CAST(p.p_retailprice AS DECIMAL(10,2)) AS price
FROM {part} p
JOIN (SELECT min(p_partkey) AS id, p_type AS name FROM {part} GROUP BY p_type) k
  ON p.p_type = k.name
"""

CUSTOMERS = """
SELECT c_custkey AS id, c_name AS name,
  concat(lower(replace(c_name, '#', '.')), '@example.com') AS email,
  CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE concat('+1-555-', CAST(c_custkey AS STRING)) END
    AS phone
FROM {customer}
"""

ORDERS = """
SELECT o_orderkey AS id, o_custkey AS customer_id,
  CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'pending' ELSE 'shipped' END
    AS status,
  CAST(o_totalprice AS DECIMAL(12,2)) AS total_amount, o_orderdate AS ordered_at
FROM {orders}
"""

ORDER_ITEMS = """
SELECT l_orderkey AS order_id, l_partkey AS product_id, CAST(l_quantity AS INT) AS quantity,
  CAST(CAST(CAST(floor(l_extendedprice * 100 / l_quantity) AS BIGINT) AS DECIMAL(18,0))
       * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(10,2)) AS unit_price
FROM {lineitem}
"""

# One run per user and day of events; errors are failed rows. A run of a single
# event counts as unfinished.
RUNS = """
SELECT user_id * 100000 + (year(min(ts)) - 2000) * 366 + dayofyear(min(ts)) AS id,
  concat('feed-', CAST(user_id % 5 AS STRING)) AS source,
  SUM(CASE WHEN event_type <> 'error' THEN 1 ELSE 0 END) AS rows_ingested,
  SUM(CASE WHEN event_type = 'error' THEN 1 ELSE 0 END) AS rows_failed,
  CAST(NULL AS STRING) AS error_log,
  min(ts) AS started_at,
  CASE WHEN count(*) = 1 THEN NULL ELSE max(ts) END AS finished_at
FROM {events}
GROUP BY user_id, CAST(ts AS DATE)
"""

# A batch per event: its value in tenths of a second is how long it took.
STEPS = """
SELECT concat('feed-', CAST(user_id % 5 AS STRING)) AS source,
  CASE WHEN event_id % 2 = 0 THEN 'orders' ELSE 'customers' END AS entity,
  CASE WHEN event_type = 'error' THEN 'failed' ELSE 'success' END AS status,
  ts AS started_at,
  CASE WHEN event_id % 50 = 0 THEN NULL
    ELSE ts + CAST(floor(value * 100) AS INT) * INTERVAL '1' MILLISECOND END AS finished_at
FROM {events}
"""

# JSON as it lands: objects, arrays, broken and blank lines.
JSON_LINES = """
SELECT event_id,
  CASE WHEN event_id % 17 = 0 THEN 'THIS IS A MALFORMED LINE'
    WHEN event_id % 19 = 0 THEN concat('[', props, ']')
    WHEN event_id % 23 = 0 THEN '   '
    WHEN event_id % 29 = 0 THEN concat(props, ' trailing')
    WHEN event_id % 31 = 0 THEN '12.5'
    ELSE concat(' {{"id": ', CAST(event_id AS STRING), ', "type": "', event_type,
                '", "props": ', props, '}} ') END AS value
FROM {events}
"""

JSON_DOCUMENTS = """
SELECT event_id,
  CASE event_id % 3
    WHEN 0 THEN props
    WHEN 1 THEN concat('[', props, ', 3, {{"k": -1}}, null, "x"]')
    ELSE '[]' END AS value
FROM {events}
"""

PAGES = """
SELECT event_id,
  CASE event_id % 6
    WHEN 0 THEN concat('{{"results": [', props, ', 7, {{"k": -1}}], "next": "/p/',
                       CAST(event_id AS STRING), '"}}')
    WHEN 1 THEN concat('[', props, ', [1]]')
    WHEN 2 THEN '42'
    WHEN 3 THEN '{{"data": [{{"k": 5}}]}}'
    WHEN 4 THEN concat('{{"results": [', props, '], "next": null}}')
    ELSE '{{"results": [], "next": "/more"}}' END AS payload
FROM {events}
"""


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def derive(spark: SparkSession, folder: str, sql: str) -> DataFrame:
    """Evaluate one of the texts above over the tables of ``folder``."""
    names = {field for _, field, _, _ in Formatter().parse(sql) if field}
    sources = {name: table(spark, folder, name) for name in names}
    return spark.sql(sql.replace("//", "DIV"), **sources)


def plain(sql: str) -> str:
    """The text over tables called by their own names."""
    names = {field for _, field, _, _ in Formatter().parse(sql) if field}
    return sql.format(**{name: name for name in names})
