"""Bulk changes to the source tables, as DataFrame transforms.

Each takes a table and gives the changed table; `capture.diff_events` turns a before/after pair
into change messages.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import money, time
from tidemark.operators.numbering import number_rows
from tidemark.operators.sampling import random_k, top_k
from tidemark.schemas import ENTITIES
from tidemark.sources.tables import Tables

# Payment state by order status, any other status being paid.
PAYMENT_STATUS = {"canceled": "voided", "refunded": "refunded"}
PRICE_UPLIFT = 1.08
UPLIFT_PRODUCTS = (2, 5, 9)


def set_where_key_in(table: DataFrame, keys: DataFrame, key: str, column: str, value: Column) -> DataFrame:
    """UPDATE table SET column = value WHERE key IN (SELECT key FROM keys).

    A left join against the distinct keys with a flag; small key sets are broadcast by size.
    """
    marked = keys.select(F.col(key)).distinct().withColumn("_hit", F.lit(True))
    return (
        table.join(marked, key, "left")
        .withColumn(column, F.when(F.col("_hit"), value).otherwise(F.col(column)))
        .select(*table.columns)
    )


def latest_orders(orders: DataFrame, k: int) -> DataFrame:
    return top_k(orders, k, F.col("order_ts").desc_nulls_first(), key="order_id").select("order_id")


def ship_latest(orders: DataFrame, k: int = 5) -> DataFrame:
    return set_where_key_in(orders, latest_orders(orders, k), "order_id", "status", F.lit("shipped"))


def deliver_latest_shipped(orders: DataFrame, k: int = 5) -> DataFrame:
    shipped = latest_orders(orders.where(F.col("status") == "shipped"), k)
    return set_where_key_in(orders, shipped, "order_id", "status", F.lit("delivered"))


def refund_random(orders: DataFrame, k: int = 3, seed: int = 123, status: str = "delivered") -> DataFrame:
    chosen = random_k(orders.where(F.col("status") == status), k, "order_id", seed)
    return set_where_key_in(orders, chosen, "order_id", "status", F.lit("refunded"))


def refund_payments(payments: DataFrame, orders: DataFrame) -> DataFrame:
    """Payments of refunded orders become refunded; the amount stays."""
    refunded = orders.where(F.col("status") == "refunded").select("order_id")
    return set_where_key_in(payments, refunded, "order_id", "payment_status", F.lit("refunded"))


def upgrade_random_customers(customers: DataFrame, k: int = 2, seed: int = 123, tier: str = "Gold") -> DataFrame:
    chosen = random_k(customers, k, "customer_id", seed)
    return set_where_key_in(customers, chosen, "customer_id", "loyalty_tier", F.lit(tier))


def uplift_prices(
    products: DataFrame, ids: tuple[int, ...] = UPLIFT_PRODUCTS, factor: float = PRICE_UPLIFT
) -> DataFrame:
    """Listed products get dearer, in whole cents; existing order lines keep their amounts."""
    raised = money.cents(F.col("unit_price") * F.lit(factor)) / F.lit(100.0)
    return products.withColumn(
        "unit_price",
        F.when(F.col("product_id").isin(*ids), raised).otherwise(F.col("unit_price")),
    )


def payments_from_orders(orders: DataFrame, delay_minutes: Column | int = 5) -> DataFrame:
    """One payment per order: voided with amount 0, refunded, or paid."""
    status = F.lit("paid")
    for order_status, payment_status in PAYMENT_STATUS.items():
        status = F.when(F.col("status") == order_status, payment_status).otherwise(status)
    return orders.select(
        F.col("order_id").alias("payment_id"),
        "order_id",
        time.plus_minutes(F.col("order_ts"), delay_minutes).alias("payment_ts"),
        status.alias("payment_status"),
        F.when(F.col("status") == "canceled", 0.0).otherwise(F.col("total_amount")).alias("amount"),
    )


def price_lines(lines: DataFrame, products: DataFrame) -> DataFrame:
    """Lines with a product and a quantity get its price and the line amount in whole cents."""
    prices = products.select("product_id", "unit_price")
    return lines.join(prices, "product_id").withColumn(
        "line_amount", money.cents(F.col("unit_price") * F.col("quantity")) / F.lit(100.0)
    )


def order_totals(items: DataFrame) -> DataFrame:
    """Sum of line amounts per order: `order_id`, `line_total`, `line_count`."""
    grouped = items.groupBy("order_id").agg(
        *money.sum_parts(F.col("line_amount"), "line"), F.count(F.lit(1)).alias("line_count")
    )
    return grouped.select("order_id", money.total("line").alias("line_total"), "line_count")


def reconcile_totals(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Stated against summed total per order; an order without lines sums to 0."""
    return (
        orders.select("order_id", "total_amount")
        .join(order_totals(items), "order_id", "left")
        .withColumn("line_total", F.when(F.col("line_count").isNull(), 0.0).otherwise(F.col("line_total")))
        .select(
            "order_id",
            "total_amount",
            "line_total",
            F.coalesce("line_count", F.lit(0)).cast("long").alias("line_count"),
            ((money.cents(F.col("line_total")) - money.cents(F.col("total_amount"))) / F.lit(100.0)).alias(
                "difference"
            ),
        )
    )


def new_orders(carts: DataFrame, tables: Tables) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Orders, items and payments for carts, with ids continuing the tables'.

    Carts have one row per line: `cart`, `customer_id`, `order_ts`, `product_id`, `quantity`. An order is
    what one customer buys in one cart at one time. Lines of unknown products are left out. Orders are placed, payments paid five minutes later.
    """
    lines = price_lines(carts, tables.products)
    heads = lines.groupBy("cart", "customer_id", "order_ts").agg(
        *money.sum_parts(F.col("line_amount"), "line")
    )
    head = ["cart", "customer_id", "order_ts"]
    placed = number_rows(heads, tables.orders, "order_id", head).withColumn(
        "total_amount", money.total("line")
    )
    orders = placed.select(
        "order_id", "customer_id", "order_ts", F.lit("placed").alias("status"), "total_amount"
    )
    owners = placed.select("order_id", *[F.col(c).alias(f"_{c}") for c in head])
    same = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(F.col(f"_{c}")) for c in head])
    owned = lines.join(owners, same).drop(*[f"_{c}" for c in head])
    items = number_rows(owned, tables.order_items, "order_item_id", ["order_id", "product_id"])
    paid = number_rows(payments_from_orders(orders).drop("payment_id"), tables.payments, "payment_id", ["order_id"])
    return (
        orders,
        items.select(*ENTITIES["order_items"].column_names),
        paid.select(*ENTITIES["payments"].column_names),
    )
