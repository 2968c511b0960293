"""Expected anomaly counts and staging sizes per dataset.

The gates are relational by default (``= 0``, ``> 0``, dimension rows equal to
what staging implies, fact rows equal to valid source rows). A dataset whose
planted anomalies are known can also pin them: a matching count is reported as
WARN (known issue), any other count fails the gate.
"""

from __future__ import annotations

from martforge.plans.checks import Expectations

# Expected counts of the derived test staging layer per scale factor
# (staging rows, then the seven planted anomaly counts, then 'Unknown' cities and
# NULL prices in the dimensions).
FIXTURE_COUNTS = {
    "sf0.001": {"stg_customers_rows": 153, "stg_products_rows": 200, "stg_orders_rows": 1500,
                "stg_order_items_rows": 6000, "duplicate_customer_ids": 3, "missing_customer_cities": 2,
                "missing_product_prices": 4, "missing_payment_methods": 10, "orphan_customer_ids": 8,
                "orphan_product_ids": 28, "invalid_quantities": 39, "unknown_cities": 0, "null_prices": 4},
    "sf0.01": {"stg_customers_rows": 1519, "stg_products_rows": 2000, "stg_orders_rows": 15000,
               "stg_order_items_rows": 60000, "duplicate_customer_ids": 19, "missing_customer_cities": 16,
               "missing_product_prices": 40, "missing_payment_methods": 91, "orphan_customer_ids": 75,
               "orphan_product_ids": 319, "invalid_quantities": 415, "unknown_cities": 11, "null_prices": 40},
    "sf0.1": {"stg_customers_rows": 15180, "stg_products_rows": 20000, "stg_orders_rows": 150000,
              "stg_order_items_rows": 600000, "duplicate_customer_ids": 180, "missing_customer_cities": 155,
              "missing_product_prices": 400, "missing_payment_methods": 904, "orphan_customer_ids": 750,
              "orphan_product_ids": 3151, "invalid_quantities": 4076, "unknown_cities": 122, "null_prices": 400},
}


def for_fixture(sf_dir: str) -> Expectations:
    """Expectations of the derived test data under ``sf_dir`` (empty if unknown)."""
    name = sf_dir.rstrip("/").rsplit("/", 1)[-1]
    return Expectations(dict(FIXTURE_COUNTS.get(name, {})))
