"""DuckDB SQL equivalents of every key in ``martforge.catalog.QUERIES``.

Only the base test tables are registered in the oracle, so each statement
starts with the CTE blocks it needs (staging derivation, dimensions, fact,
audit), assembled in dependency order by ``_with``. Output columns are cast on
both sides to the same types: counts BIGINT, money DECIMAL(24,2) for totals,
ratios DOUBLE computed from exact operands, calendar parts INTEGER.
"""

from __future__ import annotations

CTE: dict[str, str] = {}
DEPS: dict[str, list[str]] = {}


def _cte(name: str, deps: list[str], sql: str) -> None:
    CTE[name] = sql.strip()
    DEPS[name] = deps


_cte("stg_customers", [], """
SELECT CAST(c_custkey AS BIGINT) AS customer_id, c_name AS customer_name,
       CASE WHEN c_custkey % 97 = 7 THEN NULL ELSE n_name END AS city,
       r_name AS state, CASE WHEN c_custkey % 200 = 1 THEN 'OTHER' ELSE 'HOME' END AS country,
       CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS DATE) AS signup_date
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
UNION ALL
SELECT CAST(c_custkey AS BIGINT), c_name, n_name, r_name,
       CASE WHEN c_custkey % 200 = 1 THEN 'OTHER' ELSE 'HOME' END,
       CAST(DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) AS DATE)
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey
WHERE c_custkey % 101 = 3 OR c_custkey % 485 = 7
""")

_cte("stg_products", [], """
SELECT CAST(p_partkey AS BIGINT) AS product_id, p_name AS product_name, p_type AS category,
       CASE WHEN p_partkey % 50 = 9 THEN NULL ELSE CAST(p_retailprice AS DECIMAL(12,2)) END AS price
FROM part
""")

_cte("stg_orders", [], """
SELECT CAST(o_orderkey AS BIGINT) AS order_id,
       CASE WHEN o_orderkey % 200 = 11 THEN CAST(999999999 AS BIGINT) ELSE CAST(o_custkey AS BIGINT) END AS customer_id,
       CAST(o_orderdate AS DATE) AS order_date,
       CASE WHEN o_orderkey % 166 = 5 THEN NULL ELSE o_orderpriority END AS payment_method,
       o_orderstatus AS order_status
FROM orders
""")

_cte("stg_order_items", [], """
SELECT CAST(l_orderkey AS BIGINT) AS order_id,
       CASE WHEN (l_orderkey * 7 + l_linenumber) % 183 = 5 THEN CAST(999999999 AS BIGINT) ELSE CAST(l_partkey AS BIGINT) END AS product_id,
       CASE WHEN (l_orderkey * 3 + l_partkey) % 220 = 1 THEN 0
            WHEN (l_orderkey * 3 + l_partkey) % 440 = 2 THEN -1
            ELSE CAST(l_quantity AS INT) END AS quantity,
       CAST(p_retailprice AS DECIMAL(12,2)) AS unit_price
FROM lineitem JOIN part ON l_partkey = p_partkey
""")

_cte("dim_customer", ["stg_customers"], """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY customer_id) AS BIGINT) AS customer_key, customer_id, customer_name,
       COALESCE(city, 'Unknown') AS city, state, country, signup_date
FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY customer_id ORDER BY signup_date ASC NULLS LAST,
             customer_name ASC NULLS LAST, city ASC NULLS LAST, state ASC NULLS LAST,
             country ASC NULLS LAST) AS rn FROM stg_customers) t
WHERE rn = 1
""")

_cte("dim_product", ["stg_products"], """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY product_id, product_name, category, price) AS BIGINT) AS product_key,
       product_id, product_name, category, price
FROM stg_products
""")

_cte("date_bounds", ["stg_orders"], """
SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM stg_orders
""")

_cte("dim_date", ["date_bounds"], """
SELECT CAST(strftime(d, '%Y%m%d') AS INTEGER) AS date_key, d AS full_date,
       CAST(year(d) AS INTEGER) AS year, CAST(quarter(d) AS INTEGER) AS quarter,
       CAST(month(d) AS INTEGER) AS month, monthname(d) AS month_name,
       CAST(weekofyear(d) AS INTEGER) AS week, CAST(day(d) AS INTEGER) AS day, dayname(d) AS day_name
FROM (SELECT CAST(g.ts AS DATE) AS d
      FROM date_bounds b, generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) AS g(ts)) s
""")

_cte("fact_sales", ["stg_order_items", "stg_orders", "dim_customer", "dim_product", "dim_date"], """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY oi.order_id, oi.product_id, oi.quantity, oi.unit_price) AS BIGINT) AS sales_key,
       oi.order_id, c.customer_key, p.product_key, d.date_key,
       oi.quantity, oi.unit_price, CAST(oi.quantity * oi.unit_price AS DECIMAL(14,2)) AS sales_amount
FROM stg_order_items oi
JOIN stg_orders o ON oi.order_id = o.order_id
JOIN dim_customer c ON o.customer_id = c.customer_id
JOIN dim_product p ON oi.product_id = p.product_id
JOIN dim_date d ON o.order_date = d.full_date
WHERE oi.quantity > 0
""")

_cte("stg_customers_mut", ["stg_customers"], """
SELECT customer_id, customer_name, city, state, country,
       CASE WHEN customer_id % 150 = 0 THEN DATE '2000-01-01' ELSE signup_date END AS signup_date
FROM stg_customers
""")

_cte("stg_order_items_mut", ["stg_order_items"], """
SELECT CASE WHEN order_id % 2000 = 3 THEN order_id + 1000000000 ELSE order_id END AS order_id, product_id, quantity,
       CASE WHEN order_id % 1000 = 1 THEN CAST(unit_price + 0.01 AS DECIMAL(12,2)) ELSE unit_price END AS unit_price
FROM stg_order_items
""")

_cte("fact_sales_mut", ["fact_sales"], """
SELECT CASE WHEN sales_key % 1009 = 0 THEN sales_key - 1 ELSE sales_key END AS sales_key, order_id,
       CASE WHEN sales_key % 983 = 0 THEN NULL ELSE customer_key END AS customer_key,
       CASE WHEN sales_key % 977 = 0 THEN CAST(-1 AS BIGINT) ELSE product_key END AS product_key,
       CASE WHEN sales_key % 971 = 0 THEN 19000101 ELSE date_key END AS date_key,
       CASE WHEN sales_key % 997 = 0 THEN 0 ELSE quantity END AS quantity, unit_price,
       CASE WHEN sales_key % 991 = 0 THEN CAST(sales_amount + 0.01 AS DECIMAL(14,2)) ELSE sales_amount END AS sales_amount
FROM fact_sales
""")


def _audit_ctes(items: str, orders: str, suffix: str) -> None:
    _cte(f"order_status{suffix}", [orders, "dim_customer", "dim_date"], f"""
SELECT o.order_id,
       bool_or(c.customer_id IS NOT NULL AND d.full_date IS NOT NULL) AS order_ok,
       bool_or(c.customer_id IS NOT NULL) AS customer_ok,
       bool_or(d.full_date IS NOT NULL) AS date_ok
FROM {orders} o
LEFT JOIN (SELECT DISTINCT customer_id FROM dim_customer) c ON o.customer_id = c.customer_id
LEFT JOIN (SELECT DISTINCT full_date FROM dim_date) d ON o.order_date = d.full_date
GROUP BY o.order_id
""")
    _cte(f"line_audit{suffix}", [items, "dim_product", f"order_status{suffix}"], f"""
SELECT order_id, product_id, quantity, unit_price, reasons,
       CASE WHEN reasons <> '' THEN split_part(reasons, ',', 1) END AS primary_reason
FROM (
  SELECT i.order_id, i.product_id, i.quantity, i.unit_price,
         concat_ws(',',
           CASE WHEN i.quantity IS NULL THEN 'null_quantity' END,
           CASE WHEN i.quantity <= 0 THEN 'invalid_quantity' END,
           CASE WHEN p.product_id IS NULL THEN 'orphan_product' END,
           CASE WHEN s.order_id IS NULL THEN 'orphan_order' END,
           CASE WHEN s.order_id IS NOT NULL AND NOT s.order_ok AND (NOT s.customer_ok OR s.date_ok)
                THEN 'orphan_customer' END,
           CASE WHEN s.order_id IS NOT NULL AND NOT s.order_ok AND NOT s.date_ok THEN 'no_calendar_date' END
         ) AS reasons
  FROM {items} i
  LEFT JOIN (SELECT DISTINCT product_id FROM dim_product) p ON i.product_id = p.product_id
  LEFT JOIN order_status{suffix} s ON i.order_id = s.order_id
) t
""")


def _source_cte(items: str, orders: str, suffix: str) -> None:
    _cte(f"source_totals{suffix}", [items, orders, "dim_customer", "dim_product", "dim_date"], f"""
SELECT CAST(COUNT(*) AS BIGINT) AS source_valid_rows,
       CAST(COALESCE(SUM(oi.quantity), 0) AS BIGINT) AS source_total_quantity,
       CAST(COALESCE(SUM(CAST(oi.quantity * oi.unit_price AS DECIMAL(14,2))), 0) AS DECIMAL(24,2)) AS source_total_sales
FROM {items} oi
JOIN {orders} o ON oi.order_id = o.order_id
JOIN dim_customer c ON o.customer_id = c.customer_id
JOIN dim_product p ON oi.product_id = p.product_id
JOIN dim_date d ON o.order_date = d.full_date
WHERE oi.quantity > 0
""")


def _recon_cte(fact: str, suffix: str) -> None:
    _cte(f"fact_totals{suffix}", [fact], f"""
SELECT CAST(COUNT(*) AS BIGINT) AS fact_rows,
       CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS fact_total_quantity,
       CAST(COALESCE(SUM(sales_amount), 0) AS DECIMAL(24,2)) AS fact_total_sales
FROM {fact}
""")
    _cte(f"recon_wide{suffix}", [f"source_totals{suffix}", f"fact_totals{suffix}"], f"""
SELECT s.source_valid_rows, f.fact_rows,
       CAST(s.source_valid_rows - f.fact_rows AS BIGINT) AS row_difference,
       s.source_total_quantity, f.fact_total_quantity,
       CAST(s.source_total_quantity - f.fact_total_quantity AS BIGINT) AS quantity_difference,
       s.source_total_sales, f.fact_total_sales,
       CAST(s.source_total_sales - f.fact_total_sales AS DECIMAL(24,2)) AS sales_difference
FROM source_totals{suffix} s CROSS JOIN fact_totals{suffix} f
""")


_audit_ctes("stg_order_items", "stg_orders", "")
_audit_ctes("stg_order_items_mut", "stg_orders", "_mut")
_source_cte("stg_order_items", "stg_orders", "")
_source_cte("stg_order_items_mut", "stg_orders", "_mut")
_recon_cte("fact_sales", "")
_recon_cte("fact_sales_mut", "_mut")


def _with(needs: list[str], body: str) -> str:
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in DEPS[n]:
            visit(d)
        order.append(n)

    for n in needs:
        visit(n)
    if not order:
        return body.strip()
    blocks = ",\n".join(f"{n} AS (\n{CTE[n]}\n)" for n in order)
    return f"WITH {blocks}\n{body.strip()}"


# --- checks ----------------------------------------------------------------------
# (name, stage, rule, money, value SQL, expected SQL or None, needed CTEs)
# The table names in the SQL are templated: {cust} {items} {fact} {audit} {recon}.

def _count(sql_from: str) -> str:
    return f"(SELECT COUNT(*) FROM {sql_from})"


def _dups(table: str, key: str) -> str:
    return f"(SELECT COUNT(*) FROM (SELECT {key} FROM {table} GROUP BY {key} HAVING COUNT(*) > 1) t)"


def _orph(child: str, parent: str, ck: str, pk: str) -> str:
    return f"(SELECT COUNT(*) FROM {child} x LEFT JOIN {parent} y ON x.{ck} = y.{pk} WHERE y.{pk} IS NULL)"


CHECKS = [
    ("duplicate_customer_ids", "staging", "anomaly", False, _dups("{cust}", "customer_id"), None),
    ("missing_customer_cities", "staging", "anomaly", False, _count("{cust} WHERE city IS NULL"), None),
    ("missing_product_prices", "staging", "anomaly", False, _count("stg_products WHERE price IS NULL"), None),
    ("missing_payment_methods", "staging", "anomaly", False,
     _count("stg_orders WHERE payment_method IS NULL"), None),
    ("orphan_customer_ids", "staging", "anomaly", False,
     _orph("stg_orders", "{cust}", "customer_id", "customer_id"), None),
    ("orphan_product_ids", "staging", "anomaly", False,
     _orph("{items}", "stg_products", "product_id", "product_id"), None),
    ("invalid_quantities", "staging", "anomaly", False, _count("{items} WHERE quantity <= 0"), None),
    ("orphan_order_references", "staging", "zero", False,
     _orph("{items}", "stg_orders", "order_id", "order_id"), None),
    ("order_before_signup", "staging", "zero", False,
     _count("stg_orders o JOIN {cust} c ON o.customer_id = c.customer_id WHERE o.order_date < c.signup_date"), None),
    ("unit_price_mismatches", "staging", "zero", False,
     _count("{items} oi JOIN stg_products p ON oi.product_id = p.product_id "
            "WHERE p.price IS NOT NULL AND oi.unit_price != p.price"), None),
    ("duplicate_order_ids", "staging", "zero", False, _dups("stg_orders", "order_id"), None),
    ("stg_customers_rows", "staging", "positive", False, _count("{cust}"), None),
    ("stg_products_rows", "staging", "positive", False, _count("stg_products"), None),
    ("stg_orders_rows", "staging", "positive", False, _count("stg_orders"), None),
    ("stg_order_items_rows", "staging", "positive", False, _count("{items}"), None),
    ("dim_customer_rows", "dimensions", "equals", False, _count("dim_customer"),
     "(SELECT COUNT(DISTINCT customer_id) FROM {cust})"),
    ("unknown_cities", "dimensions", "anomaly", False, _count("dim_customer WHERE city = 'Unknown'"), None),
    ("dim_customer_duplicate_ids", "dimensions", "zero", False, _dups("dim_customer", "customer_id"), None),
    ("dim_customer_nulls", "dimensions", "zero", False,
     _count("dim_customer WHERE customer_id IS NULL OR customer_name IS NULL OR city IS NULL "
            "OR state IS NULL OR country IS NULL OR signup_date IS NULL"), None),
    ("dim_product_rows", "dimensions", "equals", False, _count("dim_product"), _count("stg_products")),
    ("null_prices", "dimensions", "anomaly", False, _count("dim_product WHERE price IS NULL"), None),
    ("dim_product_duplicate_ids", "dimensions", "zero", False, _dups("dim_product", "product_id"), None),
    ("dim_product_nulls", "dimensions", "zero", False,
     _count("dim_product WHERE product_id IS NULL OR product_name IS NULL OR category IS NULL"), None),
    ("dim_date_rows", "dimensions", "equals", False, _count("dim_date"),
     "(SELECT COALESCE(date_diff('day', MIN(order_date), MAX(order_date)) + 1, 0) FROM stg_orders)"),
    ("dim_date_duplicate_dates", "dimensions", "zero", False, _dups("dim_date", "full_date"), None),
    ("missing_calendar_dates", "dimensions", "zero", False,
     "(SELECT COUNT(*) FROM (SELECT MIN(full_date) AS lo, MAX(full_date) AS hi FROM dim_date) b, "
     "generate_series(CAST(b.lo AS TIMESTAMP), CAST(b.hi AS TIMESTAMP), INTERVAL 1 DAY) AS g(ts) "
     "LEFT JOIN dim_date d ON CAST(g.ts AS DATE) = d.full_date WHERE d.full_date IS NULL)", None),
    ("date_key_mismatches", "dimensions", "zero", False,
     _count("dim_date WHERE date_key != CAST(strftime(full_date, '%Y%m%d') AS INTEGER)"), None),
    ("calendar_bounds_mismatches", "dimensions", "zero", False,
     "(SELECT (CASE WHEN c.lo IS NOT DISTINCT FROM o.lo THEN 0 ELSE 1 END) "
     "+ (CASE WHEN c.hi IS NOT DISTINCT FROM o.hi THEN 0 ELSE 1 END) "
     "FROM (SELECT MIN(full_date) AS lo, MAX(full_date) AS hi FROM dim_date) c, "
     "(SELECT MIN(order_date) AS lo, MAX(order_date) AS hi FROM stg_orders) o)", None),
    ("fact_rows", "fact", "equals", False, _count("{fact}"), "(SELECT source_valid_rows FROM {recon})"),
    ("duplicate_sales_keys", "fact", "zero", False, _dups("{fact}", "sales_key"), None),
    ("fact_nulls", "fact", "zero", False,
     _count("{fact} WHERE order_id IS NULL OR customer_key IS NULL OR product_key IS NULL OR date_key IS NULL "
            "OR quantity IS NULL OR unit_price IS NULL OR sales_amount IS NULL"), None),
    ("fact_invalid_quantities", "fact", "zero", False, _count("{fact} WHERE quantity <= 0"), None),
    ("sales_amount_mismatches", "fact", "zero", False,
     _count("{fact} WHERE sales_amount != CAST(quantity * unit_price AS DECIMAL(14,2))"), None),
    ("orphan_customer_keys", "fact", "zero", False, _orph("{fact}", "dim_customer", "customer_key", "customer_key"), None),
    ("orphan_product_keys", "fact", "zero", False, _orph("{fact}", "dim_product", "product_key", "product_key"), None),
    ("orphan_date_keys", "fact", "zero", False, _orph("{fact}", "dim_date", "date_key", "date_key"), None),
    ("covered_customers", "fact", "positive", False, "(SELECT COUNT(DISTINCT customer_key) FROM {fact})", None),
    ("covered_products", "fact", "positive", False, "(SELECT COUNT(DISTINCT product_key) FROM {fact})", None),
    ("covered_dates", "fact", "positive", False, "(SELECT COUNT(DISTINCT date_key) FROM {fact})", None),
    ("row_difference", "reconciliation", "zero", False, "(SELECT abs(row_difference) FROM {recon})", None),
    ("quantity_difference", "reconciliation", "zero", False, "(SELECT abs(quantity_difference) FROM {recon})", None),
    ("sales_difference", "reconciliation", "zero", True, "(SELECT abs(sales_difference) FROM {recon})", None),
    ("exclusion_balance", "reconciliation", "zero", False,
     "(SELECT abs(COUNT(*) - (COUNT(*) FILTER (WHERE primary_reason IS NULL) "
     "+ COUNT(*) FILTER (WHERE primary_reason IS NOT NULL))) "
     "+ abs(COUNT(*) FILTER (WHERE primary_reason IS NULL) - (SELECT source_valid_rows FROM {recon})) "
     "FROM {audit})", None),
]

_CLEAN = {"cust": "stg_customers", "items": "stg_order_items", "fact": "fact_sales",
          "audit": "line_audit", "recon": "recon_wide"}
_MUT = {"cust": "stg_customers_mut", "items": "stg_order_items_mut", "fact": "fact_sales_mut",
        "audit": "line_audit_mut", "recon": "recon_wide_mut"}


def _needs(names: dict) -> list[str]:
    return [names["cust"], names["items"], "stg_products", "stg_orders", "dim_customer", "dim_product",
            "dim_date", names["fact"], names["audit"], names["recon"]]


def _check_row(c, names: dict) -> str:
    name, stage, rule, money, value, expected = c
    v = value.format(**names)
    e = expected.format(**names) if expected else "NULL"
    return (f"SELECT '{name}' AS \"check\", '{stage}' AS stage, '{rule}' AS rule, {str(money).upper()} AS money, "
            f"CAST({v} AS DECIMAL(24,2)) AS value, CAST({e} AS DECIMAL(24,2)) AS expected_value")


def _report_body(names: dict) -> str:
    rows = "\nUNION ALL\n".join(_check_row(c, names) for c in CHECKS)
    return f"""
SELECT "check", stage,
       CASE WHEN money THEN CAST(value AS VARCHAR) ELSE CAST(CAST(value AS BIGINT) AS VARCHAR) END AS actual,
       CASE WHEN rule = 'zero' THEN '0' WHEN rule = 'positive' THEN '>0'
            WHEN money THEN CAST(expected_value AS VARCHAR)
            ELSE CAST(CAST(expected_value AS BIGINT) AS VARCHAR) END AS expected,
       CASE WHEN rule = 'zero' THEN CASE WHEN value = 0 THEN 'PASS' ELSE 'FAIL' END
            WHEN rule = 'positive' THEN CASE WHEN value > 0 THEN 'PASS' ELSE 'FAIL' END
            WHEN rule = 'equals' THEN CASE WHEN value = expected_value THEN 'PASS' ELSE 'FAIL' END
            WHEN expected_value IS NULL THEN CASE WHEN value > 0 THEN 'WARN' ELSE 'PASS' END
            WHEN value = expected_value THEN CASE WHEN value > 0 THEN 'WARN' ELSE 'PASS' END
            ELSE 'FAIL' END AS status
FROM (
{rows}
) r"""


def _single(name: str, mutated: bool = False) -> str:
    names = _MUT if mutated else _CLEAN
    c = next(c for c in CHECKS if c[0] == name)
    money = c[3]
    typ = "DECIMAL(24,2)" if money else "BIGINT"
    return _with(_needs(names), f"SELECT '{name}' AS \"check\", CAST({c[4].format(**names)} AS {typ}) AS actual")


ORACLE: dict[str, str] = {}

for t in ("stg_customers", "stg_products", "stg_orders", "stg_order_items", "dim_customer", "dim_product",
          "dim_date", "fact_sales"):
    ORACLE[t] = _with([t], f"SELECT * FROM {t}")

ORACLE["row_counts"] = _with(["stg_customers", "stg_products", "stg_orders", "stg_order_items"], """
SELECT 'stg_customers' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM stg_customers
UNION ALL SELECT 'stg_products', COUNT(*) FROM stg_products
UNION ALL SELECT 'stg_orders', COUNT(*) FROM stg_orders
UNION ALL SELECT 'stg_order_items', COUNT(*) FROM stg_order_items
""")

ORACLE["wh_dim_counts"] = _with(["dim_customer", "dim_product", "dim_date"], """
SELECT 'dim_customer' AS table_name, CAST(COUNT(*) AS BIGINT) AS row_count FROM dim_customer
UNION ALL SELECT 'dim_product', COUNT(*) FROM dim_product
UNION ALL SELECT 'dim_date', COUNT(*) FROM dim_date
""")

for key, check in [
    ("dq_duplicate_customers", "duplicate_customer_ids"), ("dq_missing_city", "missing_customer_cities"),
    ("dq_missing_price", "missing_product_prices"), ("dq_missing_payment", "missing_payment_methods"),
    ("dq_orphan_customers", "orphan_customer_ids"), ("dq_orphan_products", "orphan_product_ids"),
    ("dq_invalid_quantity", "invalid_quantities"), ("int_orphan_orders", "orphan_order_references"),
    ("int_order_before_signup", "order_before_signup"), ("int_price_mismatch", "unit_price_mismatches"),
    ("wh_unknown_cities", "unknown_cities"), ("wh_customer_dups", "dim_customer_duplicate_ids"),
    ("wh_customer_nulls", "dim_customer_nulls"), ("wh_product_dups", "dim_product_duplicate_ids"),
    ("wh_product_nulls", "dim_product_nulls"), ("wh_null_prices", "null_prices"),
    ("wh_date_dups", "dim_date_duplicate_dates"), ("wh_missing_calendar_dates", "missing_calendar_dates"),
    ("wh_date_key_mismatch", "date_key_mismatches"), ("wh_sales_key_dups", "duplicate_sales_keys"),
    ("wh_fact_nulls", "fact_nulls"), ("wh_invalid_quantity", "fact_invalid_quantities"),
    ("wh_sales_mismatch", "sales_amount_mismatches"), ("wh_orphan_customer_keys", "orphan_customer_keys"),
    ("wh_orphan_product_keys", "orphan_product_keys"), ("wh_orphan_date_keys", "orphan_date_keys"),
]:
    ORACLE[key] = _single(check)

for key, check in [("int_orphan_orders_mutated", "orphan_order_references"),
                   ("int_order_before_signup_mutated", "order_before_signup"),
                   ("int_price_mismatch_mutated", "unit_price_mismatches")]:
    ORACLE[key] = _single(check, mutated=True)

ORACLE["dq_issues"] = _with(["stg_customers", "stg_products", "stg_orders", "stg_order_items"], """
SELECT 'Duplicate Customer IDs' AS issue, CAST(COUNT(*) AS BIGINT) AS issue_count
FROM (SELECT customer_id FROM stg_customers GROUP BY customer_id HAVING COUNT(*) > 1) dup
UNION ALL SELECT 'Missing Customer Cities', COUNT(*) FROM stg_customers WHERE city IS NULL
UNION ALL SELECT 'Missing Product Prices', COUNT(*) FROM stg_products WHERE price IS NULL
UNION ALL SELECT 'Missing Payment Methods', COUNT(*) FROM stg_orders WHERE payment_method IS NULL
UNION ALL SELECT 'Orphan Customer IDs', COUNT(*) FROM stg_orders o
          LEFT JOIN stg_customers c ON o.customer_id = c.customer_id WHERE c.customer_id IS NULL
UNION ALL SELECT 'Orphan Product IDs', COUNT(*) FROM stg_order_items oi
          LEFT JOIN stg_products p ON oi.product_id = p.product_id WHERE p.product_id IS NULL
UNION ALL SELECT 'Invalid Quantities', COUNT(*) FROM stg_order_items WHERE quantity <= 0
""")

ORACLE["dim_date_bounds"] = _with(["dim_date", "stg_orders"], """
SELECT c.calendar_start, c.calendar_end, c.calendar_days, o.order_start, o.order_end
FROM (SELECT MIN(full_date) AS calendar_start, MAX(full_date) AS calendar_end,
             CAST(COUNT(*) AS BIGINT) AS calendar_days FROM dim_date) c,
     (SELECT MIN(order_date) AS order_start, MAX(order_date) AS order_end FROM stg_orders) o
""")

ORACLE["fact_metrics"] = _with(["fact_sales"], """
SELECT CAST(COUNT(*) AS BIGINT) AS fact_rows, CAST(COUNT(DISTINCT order_id) AS BIGINT) AS distinct_orders,
       CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS total_quantity,
       CAST(COALESCE(SUM(sales_amount), 0) AS DECIMAL(24,2)) AS total_sales
FROM fact_sales
""")

ORACLE["recon_source_totals"] = _with(["source_totals"], "SELECT * FROM source_totals")
ORACLE["valid_source_rows"] = _with(["source_totals"], "SELECT source_valid_rows AS valid_rows FROM source_totals")

ORACLE["excluded_rows"] = _with(["line_audit"], """
SELECT CAST(COUNT(*) AS BIGINT) AS staged_rows,
       CAST(COUNT(*) FILTER (WHERE primary_reason IS NULL) AS BIGINT) AS valid_rows,
       CAST(COUNT(*) FILTER (WHERE primary_reason IS NOT NULL) AS BIGINT) AS excluded_rows
FROM line_audit
""")

ORACLE["exclusion_audit"] = _with(["line_audit"], """
SELECT primary_reason, CAST(COUNT(*) AS BIGINT) AS excluded_lines
FROM line_audit WHERE primary_reason IS NOT NULL GROUP BY primary_reason
""")

ORACLE["quarantine_lines"] = _with(["line_audit"], """
SELECT order_id, product_id, quantity, unit_price, reasons, primary_reason
FROM line_audit WHERE primary_reason IS NOT NULL
""")

ORACLE["recon_wide"] = _with(["recon_wide"], "SELECT * FROM recon_wide")

ORACLE["recon_display"] = _with(["recon_wide"], """
SELECT metric, source_value, warehouse_value, difference FROM (
  SELECT 1 AS sort_order, 'Rows' AS metric, CAST(source_valid_rows AS DECIMAL(24,2)) AS source_value,
         CAST(fact_rows AS DECIMAL(24,2)) AS warehouse_value, CAST(row_difference AS DECIMAL(24,2)) AS difference
  FROM recon_wide
  UNION ALL
  SELECT 2, 'Total Quantity', CAST(source_total_quantity AS DECIMAL(24,2)), CAST(fact_total_quantity AS DECIMAL(24,2)),
         CAST(quantity_difference AS DECIMAL(24,2)) FROM recon_wide
  UNION ALL
  SELECT 3, 'Total Sales', CAST(source_total_sales AS DECIMAL(24,2)), CAST(fact_total_sales AS DECIMAL(24,2)),
         CAST(sales_difference AS DECIMAL(24,2)) FROM recon_wide
) t ORDER BY sort_order
""")

ORACLE["wh_coverage"] = _with(["fact_sales"], """
SELECT CAST(COUNT(DISTINCT customer_key) AS BIGINT) AS distinct_customers,
       CAST(COUNT(DISTINCT product_key) AS BIGINT) AS distinct_products,
       CAST(COUNT(DISTINCT date_key) AS BIGINT) AS distinct_dates
FROM fact_sales
""")

ORACLE["validation_report"] = _with(_needs(_CLEAN), _report_body(_CLEAN))
ORACLE["validation_report_mutated"] = _with(_needs(_MUT), _report_body(_MUT))
ORACLE["pipeline_health"] = _with(_needs(_CLEAN), f"""
SELECT CAST(COUNT(*) AS BIGINT) AS checks_total,
       CAST(COUNT(*) FILTER (WHERE status = 'PASS') AS BIGINT) AS checks_passed,
       CAST(COUNT(*) FILTER (WHERE status = 'WARN') AS BIGINT) AS checks_warned,
       CAST(COUNT(*) FILTER (WHERE status = 'FAIL') AS BIGINT) AS checks_failed,
       COALESCE(CAST(COUNT(*) FILTER (WHERE status = 'PASS') AS DOUBLE) / NULLIF(CAST(COUNT(*) AS DOUBLE), 0), 0.0)
         AS pass_rate
FROM ({_report_body(_CLEAN)}) rep
""")

_RATIO = "COALESCE(CAST({a} AS DOUBLE) / NULLIF(CAST({b} AS DOUBLE), 0), 0.0)"

ORACLE["kpi_measures"] = _with(["fact_sales"], f"""
SELECT total_sales, total_quantity, total_orders, total_customers, total_products,
       {_RATIO.format(a='total_sales', b='total_orders')} AS avg_order_value,
       {_RATIO.format(a='total_sales', b='total_quantity')} AS avg_selling_price
FROM (SELECT CAST(COALESCE(SUM(sales_amount), 0) AS DECIMAL(24,2)) AS total_sales,
             CAST(COALESCE(SUM(quantity), 0) AS BIGINT) AS total_quantity,
             CAST(COUNT(DISTINCT order_id) AS BIGINT) AS total_orders,
             CAST(COUNT(DISTINCT customer_key) AS BIGINT) AS total_customers,
             CAST(COUNT(DISTINCT product_key) AS BIGINT) AS total_products
      FROM fact_sales) m
""")

_CAT = """
SELECT p.category, CAST(COALESCE(SUM(f.sales_amount), 0) AS DECIMAL(24,2)) AS total_sales,
       CAST(COALESCE(SUM(f.quantity), 0) AS BIGINT) AS total_quantity
FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
GROUP BY p.category
"""

ORACLE["mart_revenue_by_category"] = _with(["fact_sales"], f"""
SELECT category, total_sales, total_quantity,
       {_RATIO.format(a='total_sales', b='SUM(total_sales) OVER ()')} AS sales_share
FROM ({_CAT}) c
""")

ORACLE["mart_asp_by_category"] = _with(["fact_sales"], f"""
SELECT category, total_sales, total_quantity,
       {_RATIO.format(a='total_sales', b='total_quantity')} AS avg_selling_price
FROM ({_CAT}) c
""")

ORACLE["mart_monthly_revenue"] = _with(["fact_sales"], """
SELECT d.year, d.month, d.month_name,
       CAST(COALESCE(SUM(f.sales_amount), 0) AS DECIMAL(24,2)) AS total_sales,
       CAST(COALESCE(SUM(f.quantity), 0) AS BIGINT) AS total_quantity,
       CAST(COUNT(DISTINCT f.order_id) AS BIGINT) AS total_orders
FROM fact_sales f JOIN dim_date d ON f.date_key = d.date_key
GROUP BY d.year, d.month, d.month_name
""")

ORACLE["mart_quarterly_growth"] = _with(["fact_sales"], """
SELECT year, quarter, total_sales, prev_total_sales,
       (CAST(total_sales AS DOUBLE) - CAST(prev_total_sales AS DOUBLE)) / NULLIF(CAST(prev_total_sales AS DOUBLE), 0)
         AS qoq_growth
FROM (
  SELECT year, quarter, total_sales, LAG(total_sales) OVER (ORDER BY year, quarter) AS prev_total_sales
  FROM (SELECT d.year, d.quarter, CAST(COALESCE(SUM(f.sales_amount), 0) AS DECIMAL(24,2)) AS total_sales
        FROM dim_date d LEFT JOIN fact_sales f ON f.date_key = d.date_key
        GROUP BY d.year, d.quarter) q
) g
""")

ORACLE["mart_revenue_by_state"] = _with(["fact_sales"], """
SELECT state, total_sales, total_orders, total_customers,
       CAST(ROW_NUMBER() OVER (ORDER BY total_sales DESC, state ASC NULLS LAST) AS BIGINT) AS revenue_rank
FROM (SELECT c.state, CAST(COALESCE(SUM(f.sales_amount), 0) AS DECIMAL(24,2)) AS total_sales,
             CAST(COUNT(DISTINCT f.order_id) AS BIGINT) AS total_orders,
             CAST(COUNT(DISTINCT f.customer_key) AS BIGINT) AS total_customers
      FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key
      GROUP BY c.state) s
""")

ORACLE["mart_city_performance"] = _with(["fact_sales"], """
SELECT c.city, CAST(COUNT(DISTINCT f.order_id) AS BIGINT) AS total_orders,
       CAST(COUNT(DISTINCT f.customer_key) AS BIGINT) AS total_customers,
       CAST(COALESCE(SUM(f.sales_amount), 0) AS DECIMAL(24,2)) AS total_sales
FROM fact_sales f JOIN dim_customer c ON f.customer_key = c.customer_key
GROUP BY c.city
""")

ORACLE["mart_customer_acquisition"] = _with(["dim_customer"], """
SELECT CAST(year(signup_date) AS INTEGER) AS signup_year, CAST(month(signup_date) AS INTEGER) AS signup_month,
       CAST(COUNT(*) AS BIGINT) AS new_customers
FROM dim_customer GROUP BY 1, 2
""")

ORACLE["mart_top_products"] = _with(["fact_sales"], """
SELECT CAST(ROW_NUMBER() OVER (ORDER BY total_sales DESC, product_id ASC) AS BIGINT) AS product_rank,
       product_id, product_name, category, total_sales, total_quantity
FROM (SELECT p.product_id, p.product_name, p.category,
             CAST(COALESCE(SUM(f.sales_amount), 0) AS DECIMAL(24,2)) AS total_sales,
             CAST(COALESCE(SUM(f.quantity), 0) AS BIGINT) AS total_quantity
      FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
      GROUP BY p.product_key, p.product_id, p.product_name, p.category) t
ORDER BY total_sales DESC, product_id ASC
LIMIT 10
""")

ORACLE["measures_by_category_month"] = _with(["fact_sales"], f"""
SELECT category, year, month, total_sales, total_quantity, total_orders,
       {_RATIO.format(a='total_sales', b='total_orders')} AS avg_order_value,
       {_RATIO.format(a='total_sales', b='total_quantity')} AS avg_selling_price
FROM (SELECT p.category, d.year, d.month,
             CAST(COALESCE(SUM(f.sales_amount), 0) AS DECIMAL(24,2)) AS total_sales,
             CAST(COALESCE(SUM(f.quantity), 0) AS BIGINT) AS total_quantity,
             CAST(COUNT(DISTINCT f.order_id) AS BIGINT) AS total_orders
      FROM fact_sales f JOIN dim_product p ON f.product_key = p.product_key
      JOIN dim_date d ON f.date_key = d.date_key
      GROUP BY p.category, d.year, d.month) m
""")

ORACLE["csv_roundtrip"] = _with(["stg_products"], "SELECT * FROM stg_products")

ORACLE["fact_sales_incremental"] = _with(["fact_sales"], """
SELECT order_id, customer_key, product_key, date_key, quantity, unit_price, sales_amount FROM fact_sales
""")

ORACLE["dim_customer_scd2"] = _with(["dim_customer"], """
SELECT customer_id, customer_name, city, state, country, signup_date, DATE '1900-01-01' AS start_date,
       CASE WHEN customer_id % 10 = 3 OR customer_id % 50 = 7 THEN DATE '1998-01-01' END AS end_date,
       NOT (customer_id % 10 = 3 OR customer_id % 50 = 7) AS is_current
FROM dim_customer
UNION ALL
SELECT customer_id, customer_name, city || ' (moved)', state, country, signup_date, DATE '1998-01-01', NULL, TRUE
FROM dim_customer WHERE customer_id % 10 = 3 AND customer_id % 50 <> 7
""")

for _name in ("fact_sales_refreshed", "fact_sales_streamed", "fact_sales_months"):
    ORACLE[_name] = ORACLE["fact_sales"]

ORACLE["csv_rejects"] = _with(["stg_order_items"], """
SELECT CASE WHEN order_id % 97 = 5 AND order_id % 89 = 7 THEN 'bad_quantity,bad_unit_price'
            WHEN order_id % 97 = 5 THEN 'bad_quantity' WHEN order_id % 89 = 7 THEN 'bad_unit_price'
            ELSE 'loaded' END AS reasons, COUNT(*) AS n_rows
FROM stg_order_items GROUP BY 1
""")

# Versions of customers, numbered by customer and start, and the fact's lines with the one valid on the order's day.
_VERSIONS = f"""
, history AS (
{ORACLE["dim_customer_scd2"][ORACLE["dim_customer_scd2"].rindex("SELECT customer_id, customer_name, city, state, country, signup_date, DATE '1900"):]}
), versions AS (
SELECT *, CAST(ROW_NUMBER() OVER (ORDER BY customer_id, start_date) AS BIGINT) AS customer_version_key FROM history
), lines AS (
SELECT f.*, v.customer_version_key, v.city
FROM fact_sales f JOIN dim_customer c USING (customer_key) JOIN dim_date d USING (date_key)
LEFT JOIN versions v ON v.customer_id = c.customer_id AND d.full_date >= v.start_date
                    AND (v.end_date IS NULL OR d.full_date < v.end_date)
)"""

ORACLE["fact_sales_versions"] = _with(["fact_sales", "dim_customer", "dim_date"], "").rstrip() + _VERSIONS + """
SELECT sales_key, order_id, customer_key, product_key, date_key, quantity, unit_price, sales_amount, customer_version_key
FROM lines"""

ORACLE["mart_revenue_by_city_then"] = _with(["fact_sales", "dim_customer", "dim_date"], "").rstrip() + _VERSIONS + """
SELECT city, CAST(SUM(sales_amount) AS DECIMAL(24,2)) AS total_sales, CAST(SUM(quantity) AS BIGINT) AS total_quantity
FROM lines GROUP BY city"""
