"""The four staging tables as one unit."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from martforge.schemas import STAGING
from martforge.sources import tpch


@dataclass(frozen=True)
class Staging:
    customers: DataFrame
    products: DataFrame
    orders: DataFrame
    order_items: DataFrame

    def tables(self) -> dict[str, DataFrame]:
        return {"stg_customers": self.customers, "stg_products": self.products,
                "stg_orders": self.orders, "stg_order_items": self.order_items}

    def replace(self, **kw) -> "Staging":
        d = {"customers": self.customers, "products": self.products,
             "orders": self.orders, "order_items": self.order_items}
        d.update(kw)
        return Staging(**d)


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the contract columns in contract order, cast to contract types."""
    schema = STAGING[table]
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in schema.fields])


def derived_staging(spark: SparkSession, sf_dir: str) -> Staging:
    return Staging(
        customers=conform(tpch.stg_customers(spark, sf_dir), "stg_customers"),
        products=conform(tpch.stg_products(spark, sf_dir), "stg_products"),
        orders=conform(tpch.stg_orders(spark, sf_dir), "stg_orders"),
        order_items=conform(tpch.stg_order_items(spark, sf_dir), "stg_order_items"),
    )


def mutated_staging(staging: Staging) -> Staging:
    return staging.replace(customers=tpch.stg_customers_mut(staging.customers),
                           order_items=tpch.stg_order_items_mut(staging.order_items))


def read_staging(spark: SparkSession, root: str) -> Staging:
    r = lambda n: spark.read.parquet(f"{root}/{n}")
    return Staging(r("stg_customers"), r("stg_products"), r("stg_orders"), r("stg_order_items"))
