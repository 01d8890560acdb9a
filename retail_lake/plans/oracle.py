"""ANSI SQL counterparts of the registered queries, written against the supplied
tables and independent of the DataFrame plans."""

_RAW_CUSTOMERS = """
raw_customers AS (
  WITH b AS (
    SELECT c_custkey AS k,
      concat('C', lpad(CAST(c_custkey AS VARCHAR), 6, '0')) AS customer_id,
      c_name AS full_name,
      CASE WHEN c_custkey % 25 = 3 THEN concat(upper(c_name), '@MAIL.COM ')
           ELSE concat(lower(c_name), '@mail.com') END AS email,
      CASE WHEN c_custkey % 25 = 7 THEN '' WHEN c_custkey % 25 = 9 THEN NULL
           ELSE concat('  ', lower(n_name), ' ') END AS country,
      r_name AS city, lower(c_mktsegment) AS segment,
      CAST(DATE '2024-01-01' - CAST(c_custkey % 900 AS INT) AS VARCHAR) AS signup_date
    FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey
                  LEFT JOIN region ON n_regionkey = r_regionkey)
  SELECT customer_id, full_name, email, country, city, segment, signup_date, 1 AS batch_id FROM b
  UNION ALL
  SELECT customer_id, full_name, upper(email), country, city, segment, signup_date, 2 FROM b WHERE k % 20 = 0
  UNION ALL
  SELECT NULL, full_name, email, country, city, segment, signup_date, 1 FROM b WHERE k % 40 = 3)"""

_RAW_PRODUCTS = """
raw_products AS (
  WITH b AS (SELECT p_partkey AS k, concat('P', lpad(CAST(p_partkey AS VARCHAR), 5, '0')) AS product_id,
    p_name AS product_name, p_type AS category, p_brand AS brand,
    CASE WHEN p_partkey % 25 = 4 THEN concat('-', CAST(p_retailprice AS VARCHAR))
         WHEN p_partkey % 50 = 6 THEN 'n/a' ELSE CAST(p_retailprice AS VARCHAR) END AS unit_price,
    CAST(CAST(CAST(p_retailprice AS DECIMAL(18,2)) * 0.60 AS DECIMAL(18,2)) AS VARCHAR) AS unit_cost,
    1 AS batch_id
  FROM part)
  SELECT * EXCLUDE (k) FROM b
  UNION ALL
  SELECT * EXCLUDE (k) REPLACE (CAST(NULL AS VARCHAR) AS product_id) FROM b WHERE k % 40 = 3)"""

_RAW_LINES = """
raw_lines AS (
  WITH l AS (
    SELECT o_orderkey AS k,
      concat('O', lpad(CAST(o_orderkey AS VARCHAR), 8, '0')) AS order_id,
      concat('C', lpad(CAST(o_custkey AS VARCHAR), 6, '0')) AS customer_id,
      o_orderdate AS order_ts,
      CASE o_orderkey % 4 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile_app'
                          WHEN 2 THEN 'marketplace' ELSE 'in_store' END AS channel,
      o_orderpriority AS payment_method,
      CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'returned' ELSE 'cancelled' END AS status,
      concat(l_linenumber, '.', l_partkey, '.', l_suppkey, '.', strftime(l_shipdate, '%Y%m%d')) AS line_no,
      concat('P', lpad(CAST(l_partkey AS VARCHAR), 5, '0')) AS product_id,
      CASE WHEN o_orderkey % 50 = 11 AND l_linenumber = 1 THEN 0 ELSE CAST(l_quantity AS INT) END AS quantity,
      CAST(CAST(p_retailprice AS DECIMAL(18,2))
        + CAST(l_suppkey % 100 AS DECIMAL(3,0)) * CAST(0.0001 AS DECIMAL(5,4)) AS DECIMAL(24,6)) AS unit_price,
      CAST(l_discount AS DECIMAL(5,4)) AS discount_pct
    FROM orders JOIN lineitem ON o_orderkey = l_orderkey LEFT JOIN part ON l_partkey = p_partkey)
  SELECT l.*, 1 AS batch_id FROM l
  UNION ALL
  SELECT l.*, 2 AS batch_id FROM l WHERE k % 25 = 0)"""

# Lines of the first delivered event, sound or not.
_TYPED = """
typed AS (
  SELECT order_id, customer_id, order_ts, channel, payment_method, status, product_id,
    quantity, unit_price, discount_pct,
    CAST(round(quantity * unit_price, 2) AS DECIMAL(18,2)) AS gross_amount,
    CAST(round(CAST(round(quantity * unit_price, 2) AS DECIMAL(18,2))
         * (CAST(1 AS DECIMAL(5,4)) - discount_pct), 2) AS DECIMAL(18,2)) AS net_amount,
    concat(order_id, '-', line_no) AS order_item_id,
    CAST(order_ts AS DATE) AS order_date
  FROM (SELECT *, rank() OVER (PARTITION BY order_id ORDER BY batch_id) AS rn FROM raw_lines) q
  WHERE rn = 1)"""

_LINES = """
lines AS (SELECT * FROM typed WHERE quantity > 0 AND unit_price > 0)"""

_FACT = """
fact AS (
  SELECT order_item_id, order_id, customer_id, product_id,
    CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key,
    order_ts, channel, payment_method, status, quantity, unit_price, discount_pct,
    gross_amount, net_amount
  FROM lines)"""

_CUSTOMERS = """
clean_customers AS (
  SELECT customer_id, full_name, lower(trim(email)) AS email,
    CASE WHEN coalesce(trim(country), '') = '' THEN 'Unknown'
         ELSE concat(upper(left(trim(country), 1)), lower(substr(trim(country), 2))) END AS country,
    city, segment, CAST(signup_date AS DATE) AS signup_date
  FROM (SELECT *, row_number() OVER (PARTITION BY customer_id ORDER BY batch_id) AS rn
        FROM raw_customers WHERE customer_id IS NOT NULL) q
  WHERE rn = 1)"""

_PRODUCTS = """
clean_products AS (
  SELECT product_id, product_name, category, brand,
    TRY_CAST(unit_price AS DECIMAL(24,6)) AS unit_price,
    TRY_CAST(unit_cost AS DECIMAL(24,6)) AS unit_cost
  FROM raw_products WHERE product_id IS NOT NULL AND TRY_CAST(unit_price AS DECIMAL(24,6)) > 0)"""

_DATES = """
dates AS (
  SELECT DISTINCT CAST(strftime(order_date, '%Y%m%d') AS INTEGER) AS date_key, order_date,
    CAST(year(order_date) AS INTEGER) AS year, CAST(quarter(order_date) AS INTEGER) AS quarter,
    CAST(month(order_date) AS INTEGER) AS month, strftime(order_date, '%B') AS month_name,
    strftime(order_date, '%A') AS day_of_week, dayofweek(order_date) IN (0, 6) AS is_weekend
  FROM lines WHERE order_date IS NOT NULL)"""

_MEASURES = """count(DISTINCT order_id) AS orders, CAST(sum(quantity) AS BIGINT) AS units_sold,
    CAST(sum(net_amount) AS DECIMAL(28,2)) AS revenue"""

_DAILY = f"""
daily AS (
  SELECT order_date, year, month, {_MEASURES}
  FROM fact LEFT JOIN dates USING (date_key)
  WHERE status = 'completed' GROUP BY order_date, year, month)"""

_CATEGORY = f"""
by_category AS (
  SELECT category, {_MEASURES}
  FROM fact LEFT JOIN clean_products USING (product_id)
  WHERE status = 'completed' GROUP BY category)"""

_TOP = """
top_customers AS (
  SELECT f.customer_id, full_name, country, segment, count(DISTINCT order_id) AS orders,
    CAST(sum(net_amount) AS DECIMAL(28,2)) AS lifetime_value
  FROM fact f LEFT JOIN clean_customers c ON f.customer_id = c.customer_id
  WHERE status = 'completed'
  GROUP BY f.customer_id, full_name, country, segment
  ORDER BY lifetime_value DESC, f.customer_id LIMIT 100)"""


def _with(*ctes: str, select: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + select


_C = (_RAW_CUSTOMERS, _CUSTOMERS)
_P = (_RAW_PRODUCTS, _PRODUCTS)
_L = (_RAW_LINES, _TYPED, _LINES)
_F = (*_L, _FACT)
_D = (*_F, _DATES, _DAILY)
_K = (*_F, *_P, _CATEGORY)
_T = (*_F, *_C, _TOP)

_EVENTS = """
events_once AS (
  SELECT concat('O', lpad(CAST(o_orderkey AS VARCHAR), 8, '0')) AS order_id,
    concat('C', lpad(CAST(o_custkey AS VARCHAR), 6, '0')) AS customer_id,
    strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') AS order_ts,
    CASE o_orderkey % 4 WHEN 0 THEN 'web' WHEN 1 THEN 'mobile_app'
                        WHEN 2 THEN 'marketplace' ELSE 'in_store' END AS channel,
    o_orderpriority AS payment_method,
    CASE o_orderstatus WHEN 'F' THEN 'completed' WHEN 'P' THEN 'returned' ELSE 'cancelled' END AS status,
    (SELECT count(*) FROM lineitem WHERE l_orderkey = o_orderkey) AS items
  FROM orders)"""

_ORDER_LINES = _with(*_L, select="SELECT * FROM lines")
_CLEAN_CUSTOMERS = _with(*_C, select="SELECT * FROM clean_customers")

_CHECKS = """
SELECT 'unique[customer_id]' AS "check", count(*) = count(DISTINCT customer_id) AS passed,
  printf('%d rows / %d distinct', count(*), count(DISTINCT customer_id)) AS detail FROM clean_customers
UNION ALL
SELECT 'unique[product_id]', count(*) = count(DISTINCT product_id),
  printf('%d rows / %d distinct', count(*), count(DISTINCT product_id)) FROM clean_products
UNION ALL
SELECT 'not_null[customer_id]', avg(CASE WHEN customer_id IS NULL THEN 1.0 ELSE 0.0 END) <= 0.02,
  printf('null ratio %.4f <= 0.02', avg(CASE WHEN customer_id IS NULL THEN 1.0 ELSE 0.0 END)) FROM lines
UNION ALL
SELECT 'not_null[net_amount]', avg(CASE WHEN net_amount IS NULL THEN 1.0 ELSE 0.0 END) <= 0.02,
  printf('null ratio %.4f <= 0.02', avg(CASE WHEN net_amount IS NULL THEN 1.0 ELSE 0.0 END)) FROM lines
UNION ALL
SELECT 'non_negative[unit_price]', count(*) FILTER (WHERE unit_price < 0) = 0,
  printf('%d negative values', count(*) FILTER (WHERE unit_price < 0)) FROM clean_products
UNION ALL
SELECT 'non_negative[net_amount]', count(*) FILTER (WHERE net_amount < 0) = 0,
  printf('%d negative values', count(*) FILTER (WHERE net_amount < 0)) FROM lines
UNION ALL
SELECT 'min_rows[order_items]', count(*) >= 10000, printf('%d >= 10000', count(*)) FROM lines"""

_QUARANTINE = """
SELECT 'customers' AS source, 'missing_key' AS reject_reason, count(*) AS rejected
FROM raw_customers WHERE customer_id IS NULL HAVING count(*) > 0
UNION ALL
SELECT 'products', 'missing_key', count(*) FROM raw_products WHERE product_id IS NULL HAVING count(*) > 0
UNION ALL
SELECT 'orders', 'missing_key', count(*)
FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey WHERE o_orderkey % 100 = 7 HAVING count(*) > 0
UNION ALL
SELECT 'products' AS source,
  CASE WHEN TRY_CAST(unit_price AS DECIMAL(24,6)) IS NULL THEN 'unparsable_price'
       ELSE 'non_positive_price' END AS reject_reason, count(*) AS rejected
FROM raw_products WHERE product_id IS NOT NULL AND coalesce(TRY_CAST(unit_price AS DECIMAL(24,6)), 0) <= 0
GROUP BY ALL
UNION ALL
SELECT 'order_items', 'no_items', count(*) FROM orders
WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)
HAVING count(*) > 0
UNION ALL
SELECT 'order_items',
  CASE WHEN quantity <= 0 THEN 'non_positive_quantity' WHEN unit_price IS NULL THEN 'unparsable_price'
       ELSE 'non_positive_price' END, count(*)
FROM typed WHERE quantity <= 0 OR unit_price IS NULL OR unit_price <= 0
GROUP BY ALL"""

_AUDIT = """
SELECT 'customers.csv' AS source_file, batch_id, count(*) AS row_count, count(*) AS stamped
FROM raw_customers GROUP BY batch_id
UNION ALL
SELECT 'products.csv', batch_id, count(*), count(*) FROM raw_products GROUP BY batch_id
UNION ALL
SELECT 'orders.json', batch_id, count(*), count(*)
FROM (SELECT o_orderkey, unnest(CASE WHEN o_orderkey % 25 = 0 THEN [1, 2] ELSE [1] END
        || CASE WHEN o_orderkey % 100 = 7 THEN [1] ELSE [] END) AS batch_id
      FROM orders LEFT JOIN lineitem ON o_orderkey = l_orderkey)
GROUP BY batch_id"""

_LAYERS = """
SELECT 'silver' AS layer, 'customers' AS "table", count(*) AS row_count,
  CAST(NULL AS DECIMAL(38,2)) AS amount FROM clean_customers
UNION ALL SELECT 'silver', 'products', count(*), CAST(sum(unit_price) AS DECIMAL(38,2)) FROM clean_products
UNION ALL SELECT 'silver', 'order_items', count(*), sum(net_amount) FROM lines
UNION ALL SELECT 'served', 'dim_customer', count(*), NULL FROM clean_customers
UNION ALL SELECT 'served', 'dim_product', count(*), CAST(sum(unit_price) AS DECIMAL(38,2)) FROM clean_products
UNION ALL SELECT 'served', 'dim_date', count(*), NULL FROM dates
UNION ALL SELECT 'served', 'fact_sales', count(*), sum(net_amount) FROM fact
UNION ALL SELECT 'served', 'mart_daily_sales', count(*), sum(revenue) FROM daily
UNION ALL SELECT 'served', 'mart_sales_by_category', count(*), sum(revenue) FROM by_category
UNION ALL SELECT 'served', 'mart_top_customers', count(*), sum(lifetime_value) FROM top_customers"""

_MARTS = """
SELECT 'mart_daily_sales' AS mart, count(*) AS row_count, CAST(sum(revenue) AS DECIMAL(38,2)) AS amount FROM daily
UNION ALL SELECT 'mart_sales_by_category', count(*), sum(revenue) FROM by_category
UNION ALL SELECT 'mart_top_customers', count(*), sum(lifetime_value) FROM top_customers"""

ORACLES = {
    "clean_customers": _CLEAN_CUSTOMERS,
    "clean_products": _with(*_P, select="SELECT * FROM clean_products"),
    "dedup_orders": _with(_EVENTS, select="SELECT * FROM events_once"),
    "order_lines": _ORDER_LINES,
    "dim_customer": _CLEAN_CUSTOMERS,
    "dim_product": _with(*_P, select="SELECT * FROM clean_products"),
    "dim_date": _with(*_L, _DATES, select="SELECT * FROM dates"),
    "fact_sales": _with(*_F, select="SELECT * FROM fact"),
    "realized_sales": _with(*_F, select="SELECT * FROM fact WHERE status = 'completed'"),
    "mart_daily": _with(*_D, select="SELECT * FROM daily"),
    "mart_category": _with(*_K, select="SELECT * FROM by_category"),
    "mart_top_customers": _with(*_T, select="SELECT * FROM top_customers"),
    "bi_total": _with(
        *_D,
        select="SELECT CAST(sum(revenue) AS DECIMAL(38,2)) AS total_revenue, "
        "CAST(sum(orders) AS BIGINT) AS total_orders FROM daily",
    ),
    "bi_top_categories": _with(
        *_K,
        select="SELECT category, revenue, units_sold FROM by_category "
        "ORDER BY revenue DESC, category LIMIT 5",
    ),
    "bi_monthly": _with(
        *_D,
        select="SELECT year, month, CAST(sum(revenue) AS DECIMAL(38,2)) AS revenue "
        "FROM daily GROUP BY year, month ORDER BY year, month",
    ),
    "bi_top_customers": _with(
        *_T,
        select="SELECT full_name, country, segment, lifetime_value FROM top_customers "
        "ORDER BY lifetime_value DESC, customer_id LIMIT 5",
    ),
    "dq_checks": _with(*_C, *_P, *_L, select=_CHECKS),
    "dq_orphans": _with(
        *_P,
        *_L,
        select="SELECT product_id, count(*) AS \"rows\" FROM lines "
        "WHERE product_id NOT IN (SELECT product_id FROM clean_products) GROUP BY product_id",
    ),
    "quarantine": _with(_RAW_CUSTOMERS, _RAW_PRODUCTS, _RAW_LINES, _TYPED, select=_QUARANTINE),
    "bronze_audit": _with(_RAW_CUSTOMERS, _RAW_PRODUCTS, select=_AUDIT),
    "csv_roundtrip": _CLEAN_CUSTOMERS,
    "csv_reordered": _CLEAN_CUSTOMERS,
    "json_roundtrip": _ORDER_LINES,
    "layer_roundtrip": _with(*_C, *_P, *_F, _DATES, _DAILY, _CATEGORY, _TOP, select=_LAYERS),
    "incremental_roundtrip": _with(*_C, *_P, *_F, _DATES, _DAILY, _CATEGORY, _TOP, select=_LAYERS),
    "mart_refresh": _with(*_C, *_P, *_F, _DATES, _DAILY, _CATEGORY, _TOP, select=_MARTS),
    "partition_pruned_month": _with(
        *_L,
        select="SELECT order_date, count(*) AS lines, "
        "CAST(sum(net_amount) AS DECIMAL(28,2)) AS net_amount FROM lines "
        "WHERE order_date BETWEEN DATE '1997-03-01' AND DATE '1997-03-31' GROUP BY order_date",
    ),
}
