"""Six marts over the current tables.

Orders are added up per customer before they meet the customers table. The join then sees one row
per customer, so a customer with very many orders makes no large join partition, and the shuffle
by customer serves the aggregation and the join alike.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import money, time
from tidemark.operators import quality
from tidemark.operators.sampling import top_k
from tidemark.sources.files import Folder
from tidemark.sources.tables import Tables

CANCELED = "canceled"
TOP_ROWS = 20


def kept_amount(amount: Column, status: Column) -> Column:
    """The amount unless the order is canceled; 0 for canceled and for unknown status."""
    return F.when(status != CANCELED, amount).otherwise(F.lit(0.0))


def has_kept_amount(amount: Column, status: Column) -> Column:
    """1 per row that counts for an average over orders that are not canceled."""
    return F.when((status != CANCELED) & amount.isNotNull(), F.lit(1)).otherwise(F.lit(0))


def _order_sums() -> list[Column]:
    status, amount = F.col("status"), F.col("total_amount")
    return [
        *money.sum_parts(kept_amount(amount, status), "kept"),
        F.sum(has_kept_amount(amount, status)).alias("kept_orders"),
    ]


def orders_per_customer(orders: DataFrame) -> DataFrame:
    return orders.groupBy("customer_id").agg(F.count("order_id").alias("orders"), *_order_sums())


def orders_summary(tables: Tables) -> DataFrame:
    amount = F.col("total_amount")
    return (
        tables.orders.where(F.col("status").isNotNull())
        .groupBy("status")
        .agg(
            F.count(F.lit(1)).alias("order_count"),
            *money.sum_parts(amount, "all"),
            F.count(amount).alias("amounts"),
        )
        .select(
            "status",
            "order_count",
            money.total("all").alias("revenue"),
            money.mean("all", F.col("amounts")).alias("avg_order_value"),
        )
        .orderBy(F.col("revenue").desc_nulls_last(), "status")
    )


def revenue_by_city(tables: Tables) -> DataFrame:
    return (
        orders_per_customer(tables.orders)
        .join(tables.customers.select("customer_id", "city"), "customer_id")
        .groupBy("city")
        .agg(
            F.sum("orders").alias("orders"),
            *money.resum_parts("kept"),
            F.sum("kept_orders").alias("kept_orders"),
        )
        .select(
            "city",
            "orders",
            money.total("kept").alias("revenue"),
            money.mean("kept", F.col("kept_orders")).alias("avg_order_value"),
        )
        .orderBy(F.col("revenue").desc_nulls_last(), F.col("city").asc_nulls_last())
    )


def top_customers(tables: Tables, k: int = TOP_ROWS) -> DataFrame:
    spent = orders_per_customer(tables.orders).select(
        "customer_id",
        F.col("orders").alias("num_orders"),
        money.total("kept").alias("total_spent"),
        money.mean("kept", F.col("kept_orders")).alias("avg_order_value"),
    )
    named = tables.customers.select("customer_id", "customer_name", "city", "loyalty_tier")
    joined = named.join(spent, "customer_id")
    return top_k(joined, k, F.col("total_spent").desc_nulls_last(), key="customer_id")


def top_products(tables: Tables, k: int = TOP_ROWS) -> DataFrame:
    """Lines meet their orders for the status only, then shrink to one row per product."""
    status, amount = F.col("status"), F.col("line_amount")
    sold = (
        tables.order_items.select("order_id", "product_id", "quantity", "line_amount")
        .join(tables.orders.select("order_id", "status"), "order_id")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units_sold"), *money.sum_parts(kept_amount(amount, status), "kept"))
        .select("product_id", "units_sold", money.total("kept").alias("revenue"))
    )
    named = tables.products.select("product_id", "product_name", "category")
    return top_k(named.join(sold, "product_id"), k, F.col("revenue").desc_nulls_last(), key="product_id")


def customer_retention(tables: Tables) -> DataFrame:
    per_customer = (
        tables.orders.groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("total_orders"), *_order_sums())
        .select("customer_id", "total_orders", money.total("kept").alias("lifetime_revenue"))
    )
    named = tables.customers.select("customer_id", "customer_name", "city", "loyalty_tier")
    kind = F.when(F.col("total_orders") > 1, "repeat").otherwise("one_time")
    return (
        named.join(per_customer, "customer_id")
        .withColumn("customer_type", kind)
        # The id spreads customers with equal revenue over several sort ranges.
        .orderBy(F.col("lifetime_revenue").desc_nulls_last(), "customer_id")
    )


def hourly_kpis(tables: Tables) -> DataFrame:
    return (
        tables.orders.groupBy(time.hour_start(F.col("order_ts")).alias("order_hour"))
        .agg(F.count(F.lit(1)).alias("orders"), *_order_sums())
        .select(
            "order_hour",
            "orders",
            money.total("kept").alias("revenue"),
            money.mean("kept", F.col("kept_orders")).alias("avg_order_value"),
        )
        .orderBy(F.col("order_hour").asc_nulls_last())
    )


MARTS: dict[str, Callable[[Tables], DataFrame]] = {
    "orders_summary": orders_summary,
    "revenue_by_city": revenue_by_city,
    "top_customers": top_customers,
    "top_products": top_products,
    "customer_retention": customer_retention,
    "hourly_kpis": hourly_kpis,
}

# Columns of the marts that must never be empty.
NOT_NULL: dict[str, list[str]] = {
    "orders_summary": ["status"],
    "top_customers": ["customer_id"],
    "revenue_by_city": ["city"],
    "top_products": ["product_id"],
}


def build_marts(tables: Tables, folder: str, names: list[str] | None = None) -> list[quality.Watched]:
    """Rebuild marts as `<folder>/<mart>`; their row counts and checks, counted while they were written.

    A mart is written aside and takes the old one's place by renaming, so a failure while it is built leaves
    the old one, and readers never meet half of one.
    """
    built = []
    for name in names or MARTS:
        watched = quality.Watched(MARTS[name](tables), name, NOT_NULL.get(name, ()))
        plan = watched.frame
        built.append(watched)
        target, draft, old = Folder(plan.sparkSession, folder), f"_draft-{uuid.uuid4().hex}", f"_old-{uuid.uuid4().hex}"
        plan.write.parquet(target.path(draft))
        if target.exists(name):
            target.move((name,), (old,))
        target.move((draft,), (name,))
        target.delete(old)
    return built


def mart_checks(marts: dict[str, DataFrame]) -> DataFrame:
    return quality.run_suite(
        quality.not_null(marts[name], name, columns) for name, columns in NOT_NULL.items()
    )


def check_marts(spark, folder: str) -> DataFrame:
    """Check results for written marts."""
    return mart_checks({name: spark.read.parquet(f"{folder.rstrip('/')}/{name}") for name in NOT_NULL})
