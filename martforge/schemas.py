"""Fixed schemas of the staging layer and of the star schema."""

from __future__ import annotations

from pyspark.sql import types as T

PRICE = T.DecimalType(12, 2)      # unit_price, price
AMOUNT = T.DecimalType(14, 2)     # sales_amount = quantity * unit_price
# Totals of AMOUNT. The reporting views declare NUMERIC(14,2), which tops out
# near 10^12 and would overflow on a large warehouse; totals keep Spark's own
# sum width for decimal(14,2).
TOTAL = T.DecimalType(24, 2)


def _s(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in fields])


STG_CUSTOMERS = _s(("customer_id", T.LongType()), ("customer_name", T.StringType()),
                   ("city", T.StringType()), ("state", T.StringType()),
                   ("country", T.StringType()), ("signup_date", T.DateType()))
STG_PRODUCTS = _s(("product_id", T.LongType()), ("product_name", T.StringType()),
                  ("category", T.StringType()), ("price", PRICE))
STG_ORDERS = _s(("order_id", T.LongType()), ("customer_id", T.LongType()),
                ("order_date", T.DateType()), ("payment_method", T.StringType()),
                ("order_status", T.StringType()))
STG_ORDER_ITEMS = _s(("order_id", T.LongType()), ("product_id", T.LongType()),
                     ("quantity", T.IntegerType()), ("unit_price", PRICE))

STAGING = {
    "stg_customers": STG_CUSTOMERS,
    "stg_products": STG_PRODUCTS,
    "stg_orders": STG_ORDERS,
    "stg_order_items": STG_ORDER_ITEMS,
}

# Raw extract name -> staging table; the raw header must carry the staging columns.
RAW_FILES = {
    "customers.csv": "stg_customers",
    "products.csv": "stg_products",
    "orders.csv": "stg_orders",
    "order_items.csv": "stg_order_items",
}

DIM_CUSTOMER = _s(("customer_key", T.LongType()), ("customer_id", T.LongType()),
                  ("customer_name", T.StringType()), ("city", T.StringType()),
                  ("state", T.StringType()), ("country", T.StringType()),
                  ("signup_date", T.DateType()))
DIM_PRODUCT = _s(("product_key", T.LongType()), ("product_id", T.LongType()),
                 ("product_name", T.StringType()), ("category", T.StringType()),
                 ("price", PRICE))
DIM_DATE = _s(("date_key", T.IntegerType()), ("full_date", T.DateType()),
              ("year", T.IntegerType()), ("quarter", T.IntegerType()),
              ("month", T.IntegerType()), ("month_name", T.StringType()),
              ("week", T.IntegerType()), ("day", T.IntegerType()),
              ("day_name", T.StringType()))
FACT_SALES = _s(("sales_key", T.LongType()), ("order_id", T.LongType()),
                ("customer_key", T.LongType()), ("product_key", T.LongType()),
                ("date_key", T.IntegerType()), ("quantity", T.IntegerType()),
                ("unit_price", PRICE), ("sales_amount", AMOUNT))

WAREHOUSE = {
    "dim_customer": DIM_CUSTOMER,
    "dim_product": DIM_PRODUCT,
    "dim_date": DIM_DATE,
    "fact_sales": FACT_SALES,
}

# Columns that must never be NULL in the published star (report checks).
REQUIRED = {
    "dim_customer": ["customer_id", "customer_name", "city", "state", "country", "signup_date"],
    "dim_product": ["product_id", "product_name", "category"],
    "fact_sales": ["order_id", "customer_key", "product_key", "date_key", "quantity",
                   "unit_price", "sales_amount"],
}


def columns(schema: T.StructType) -> list[str]:
    return [f.name for f in schema.fields]
