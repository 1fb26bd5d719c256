"""Filtered page queries.

The page joins orders, customers, order items and products and filters on city, status, category
and date. Most of its figures are at line grain: an order counts once per matching line. Joining
everything first would carry each order once per line through two shuffles and then count distinct
orders. Here lines are counted per order first (`n_lines`); a sum over lines is then a sum over
orders weighted by `n_lines`, and a distinct count of orders is a plain count. This needs order,
customer and product ids to be unique, which the current tables guarantee.
"""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass
from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions import money, time
from tidemark.operators.sampling import top_k
from tidemark.plans.marts import CANCELED, has_kept_amount, kept_amount
from tidemark.sources.tables import Tables

LINE, ORDER = "line", "order"


@dataclass(frozen=True)
class Filters:
    """Selections; None means all values that occur, so rows without a value never match.

    An empty selection matches nothing. Dates are inclusive.
    """

    cities: tuple[str, ...] | None = None
    statuses: tuple[str, ...] | None = None
    categories: tuple[str, ...] | None = None
    start: date | None = None
    end: date | None = None

    def customers(self, frame: DataFrame) -> DataFrame:
        return frame.where(_selected("city", self.cities))

    def products(self, frame: DataFrame) -> DataFrame:
        return frame.where(_selected("category", self.categories))

    def orders(self, frame: DataFrame) -> DataFrame:
        day = F.to_date("order_ts")
        kept = frame.where(_selected("status", self.statuses) & F.col("order_ts").isNotNull())
        if self.start is not None:
            kept = kept.where(day >= F.lit(self.start))
        if self.end is not None:
            kept = kept.where(day <= F.lit(self.end))
        return kept


def _selected(column: str, values: tuple[str, ...] | None) -> Column:
    if values is None:
        return F.col(column).isNotNull()
    return F.col(column).isin(list(values))


def star(tables: Tables, filters: Filters = Filters()) -> DataFrame:
    """The filtered join at line grain, one row per order line."""
    orders = filters.orders(tables.orders)
    customers = filters.customers(tables.customers)
    products = filters.products(tables.products)
    items = tables.order_items.select("order_id", "product_id", "quantity", "line_amount")
    # Orders meet customers first, so the lines are shuffled for products and orders only.
    return items.join(products, "product_id").join(orders.join(customers, "customer_id"), "order_id")


def filtered_orders(
    tables: Tables, filters: Filters = Filters(), of_buyers: bool = False, carried: Iterable[str] = ()
) -> DataFrame:
    """Orders that pass the filters and have a matching line, with `n_lines`.

    A city selection thins out the orders before they meet the lines, and may bring along columns of the
    customers (`carried`), so that these are not joined again. Without one, only orders without a customer
    in a city would go: that is left to `of_customers`, after adding up, unless `of_buyers` asks for it here.
    """
    wanted = filters.products(tables.products).select("product_id")
    lines = (
        tables.order_items.select("order_id", "product_id")
        .join(wanted, "product_id", "left_semi")
        .groupBy("order_id")
        .agg(F.count(F.lit(1)).alias("n_lines"))
    )
    orders = filters.orders(tables.orders)
    if of_buyers or filters.cities is not None:
        buyers = filters.customers(tables.customers).select("customer_id", *carried)
        orders = orders.join(buyers, "customer_id", "inner" if carried else "left_semi")
    return orders.join(lines, "order_id")


def of_customers(
    tables: Tables, filters: Filters, columns: Iterable[str], by: Iterable[Column | str], sums: Iterable[Column]
) -> DataFrame:
    """Sums of the filtered orders per customer and `by`, with columns of the customer.

    As in the marts, adding up comes before the customers join, so no customer is too large. A city
    selection joins the customers before, and they are not read twice.
    """
    columns = list(columns)
    if filters.cities is not None:
        orders = filtered_orders(tables, filters, carried=columns)
        return orders.groupBy("customer_id", *columns, *by).agg(*sums)
    facts = filtered_orders(tables, filters).groupBy("customer_id", *by).agg(*sums)
    return facts.join(filters.customers(tables.customers).select("customer_id", *columns), "customer_id")


def _fact_sums(grain: str) -> list[Column]:
    status, amount = F.col("status"), F.col("total_amount")
    weight = F.col("n_lines") if grain == LINE else F.lit(1).cast("long")
    return [
        F.count(F.lit(1)).alias("orders"),
        *money.sum_parts(kept_amount(amount, status), "kept", weight),
        F.sum(has_kept_amount(amount, status) * weight).alias("kept_rows"),
        F.sum(F.when(status == CANCELED, weight).otherwise(F.lit(0))).alias("canceled_rows"),
    ]


def _resummed() -> list[Column]:
    return [
        F.sum("orders").alias("orders"),
        *money.resum_parts("kept"),
        F.sum("kept_rows").alias("kept_rows"),
        F.sum("canceled_rows").alias("canceled_rows"),
    ]


def order_facts(
    tables: Tables,
    filters: Filters = Filters(),
    by: Iterable[Column | str] = (),
    grain: str = LINE,
) -> DataFrame:
    """Filtered orders added up per customer and `by`, with the customer's city and tier."""
    return of_customers(tables, filters, ["city", "loyalty_tier"], by, _fact_sums(grain))


def _percent(part: Column, whole: Column) -> Column:
    """Part of whole in percent, two decimals; NULL when there is no whole."""
    base = F.nullif(whole.cast("double"), F.lit(0.0))
    return F.round(F.lit(10000.0) * part.cast("double") / base) / F.lit(100.0)


def kpi_row(tables: Tables, filters: Filters = Filters(), grain: str = LINE) -> DataFrame:
    """Orders, revenue, average order value, cancel rate, share of repeat customers: one row.

    At line grain the cancel rate is canceled lines per order, and can exceed 100. A customer is a
    repeat customer by all their orders, filtered or not.
    """
    all_orders = tables.orders.groupBy("customer_id").agg(F.count(F.lit(1)).alias("all_orders"))
    per_customer = order_facts(tables, filters, grain=grain).join(all_orders, "customer_id")
    totals = per_customer.agg(
        F.coalesce(F.sum("orders"), F.lit(0)).alias("orders"),
        *[c for c in _resummed()[1:]],
        F.count(F.lit(1)).alias("customers"),
        F.count(F.when(F.col("all_orders") > 1, F.lit(1))).alias("repeaters"),
    )
    return totals.select(
        F.col("orders").alias("total_orders"),
        money.total("kept").alias("revenue"),
        money.mean("kept", F.col("kept_rows")).alias("avg_order_value"),
        _percent(F.col("canceled_rows"), F.col("orders")).alias("cancel_rate"),
        _percent(F.col("repeaters"), F.col("customers")).alias("repeat_customer_rate"),
    )


def daily_trend(tables: Tables, filters: Filters = Filters(), grain: str = LINE) -> DataFrame:
    """Customers only filter here, so orders are added up by day at once."""
    return (
        filtered_orders(tables, filters, of_buyers=True)
        .groupBy(time.day_start(F.col("order_ts")).alias("order_day"))
        .agg(*_fact_sums(grain))
        .select("order_day", "orders", money.total("kept").alias("revenue"))
        .orderBy("order_day")
    )


def daily_trend_long(tables: Tables, filters: Filters = Filters(), grain: str = LINE) -> DataFrame:
    """The trend as one row per day and series, as charts want it."""
    wide = daily_trend(tables, filters, grain).withColumn("orders", F.col("orders").cast("double"))
    return wide.unpivot(["order_day"], ["orders", "revenue"], "series", "amount")


def orders_by_status(tables: Tables, filters: Filters = Filters()) -> DataFrame:
    return (
        filtered_orders(tables, filters, of_buyers=True)
        .groupBy("status")
        .agg(F.count(F.lit(1)).alias("orders"))
        .orderBy(F.col("orders").desc(), "status")
    )


def revenue_by_city(tables: Tables, filters: Filters = Filters(), grain: str = LINE) -> DataFrame:
    return (
        order_facts(tables, filters, grain=grain)
        .groupBy("city")
        .agg(*_resummed())
        .select("city", "orders", money.total("kept").alias("revenue"))
        .orderBy(F.col("revenue").desc_nulls_last(), "city")
    )


def top_products(tables: Tables, filters: Filters = Filters(), k: int = 10) -> DataFrame:
    """Products by name and category; two products of one name and category are one row.

    Customers only filter here, so their keys are a semi join on the orders. Lines are added up
    per product id before the names are attached.
    """
    buyers = filters.customers(tables.customers).select("customer_id")
    orders = (
        filters.orders(tables.orders)
        .select("order_id", "customer_id", "status")
        .join(buyers, "customer_id", "left_semi")
        .select("order_id", "status")
    )
    status, amount = F.col("status"), F.col("line_amount")
    lines = tables.order_items.select("order_id", "product_id", "quantity", "line_amount")
    if filters.categories is not None:
        lines = lines.join(filters.products(tables.products).select("product_id"), "product_id", "left_semi")
    sold = (
        lines.join(orders, "order_id")
        .groupBy("product_id")
        .agg(F.sum("quantity").alias("units_sold"), *money.sum_parts(kept_amount(amount, status), "kept"))
    )
    named = filters.products(tables.products).select("product_id", "product_name", "category")
    grouped = (
        sold.join(named, "product_id")
        .groupBy("product_name", "category")
        .agg(F.sum("units_sold").alias("units_sold"), *money.resum_parts("kept"))
        .select("product_name", "category", "units_sold", money.total("kept").alias("revenue"))
    )
    return grouped.orderBy(
        F.col("revenue").desc_nulls_last(), F.col("product_name").asc_nulls_last(), "category"
    ).limit(k)


def retention_by_tier(tables: Tables, filters: Filters = Filters()) -> DataFrame:
    """Customers and repeat customers per tier, by filtered orders; canceled orders count too."""
    amount = F.col("total_amount")
    sums = [F.count(F.lit(1)).alias("orders"), *money.sum_parts(amount, "all"), F.count(amount).alias("amounts")]
    return (
        of_customers(tables, filters, ["loyalty_tier"], [], sums)
        .groupBy("loyalty_tier")
        .agg(
            F.count(F.lit(1)).alias("customers"),
            F.count(F.when(F.col("orders") > 1, F.lit(1))).alias("repeat_customers"),
            *money.resum_parts("all"),
            F.sum("amounts").alias("amounts"),
        )
        .select(
            "loyalty_tier",
            "customers",
            "repeat_customers",
            money.mean("all", F.col("amounts")).alias("avg_order_value"),
        )
        .orderBy(F.col("customers").desc(), F.col("loyalty_tier").asc_nulls_last())
    )


def orders_with_customer_count(tables: Tables, filters: Filters = Filters()) -> DataFrame:
    """Every filtered order with the number of filtered orders of its customer.

    COUNT(*) OVER (PARTITION BY customer_id), as a count joined back: the counts are sent to all tasks if
    they turn out small. The orders are shuffled by customer once, for the counts and for the rows: the
    digest makes the counts read the same columns as the rows, without which the plan would hold the whole
    selection twice.
    """
    tiers = filters.customers(tables.customers).select("customer_id", "loyalty_tier")
    orders = filtered_orders(tables, filters).select("order_id", "customer_id", "total_amount").repartition("customer_id")
    counts = (
        orders.groupBy("customer_id")
        .agg(F.count(F.lit(1)).alias("order_count"), F.max(F.xxhash64("order_id", "total_amount")).alias("digest"))
        .where("digest is not null")
        .drop("digest")
    )
    return orders.join(counts.join(tiers, "customer_id"), "customer_id").select(
        "order_id", "customer_id", "total_amount", "loyalty_tier", "order_count"
    )


def payment_mix(tables: Tables) -> DataFrame:
    """Unfiltered, as on the page."""
    return (
        tables.payments.groupBy("payment_status")
        .agg(F.count(F.lit(1)).alias("payment_count"), *money.sum_parts(F.col("amount"), "paid"))
        .select("payment_status", "payment_count", money.total("paid").alias("amount"))
        .orderBy(F.col("amount").desc_nulls_last(), F.col("payment_status").asc_nulls_last())
    )


def payment_share(tables: Tables) -> DataFrame:
    """The mix with each status's share of the total in percent.

    The total is added up from the grouped parts, whose shuffle serves both, so payments are read once.
    """
    mix = tables.payments.groupBy("payment_status").agg(*money.sum_parts(F.col("amount"), "paid"))
    whole = mix.agg(*money.resum_parts("paid")).select(money.total("paid").alias("whole")).scalar()
    amounts = mix.select("payment_status", money.total("paid").alias("amount"))
    return amounts.select("payment_status", "amount", _percent(F.col("amount"), whole).alias("share")).orderBy(
        F.col("amount").desc_nulls_last(), F.col("payment_status").asc_nulls_last()
    )


def filter_options(tables: Tables) -> DataFrame:
    """Values to choose from: `filter_name`, `option`."""

    def options(frame: DataFrame, column: str) -> DataFrame:
        return frame.select(F.lit(column).alias("filter_name"), F.col(column).alias("option")).distinct()

    return (
        options(tables.customers, "city")
        .unionByName(options(tables.orders, "status"))
        .unionByName(options(tables.products, "category"))
        .orderBy("filter_name", F.col("option").asc_nulls_last())
    )


def date_bounds(tables: Tables) -> DataFrame:
    """First and last order date, today (UTC) for an empty table."""
    today = F.to_date(time.now())
    return tables.orders.agg(
        F.coalesce(F.to_date(F.min("order_ts")), today).alias("min_date"),
        F.coalesce(F.to_date(F.max("order_ts")), today).alias("max_date"),
    )


#: What `latest_events` reads of the log.
EVENT_COLUMNS = ["entity", "op", "kafka_topic", "kafka_partition", "kafka_offset", "event_ts_ms", "processed_at"]


def latest_events(log: DataFrame, k: int = 30, newest_first: Iterable[str] = ()) -> DataFrame:
    """The newest k log rows by the given columns, then by time of processing and offset."""
    newest_first = list(newest_first)
    shown = log.select(
        *[c for c in EVENT_COLUMNS if c != "event_ts_ms"],
        time.from_millis(F.col("event_ts_ms")).alias("event_ts"),
        *newest_first,
    )
    return shown.orderBy(
        *[F.col(c).desc() for c in newest_first],
        F.col("processed_at").desc_nulls_last(),
        F.col("kafka_offset").desc(),
        "kafka_topic",
        "kafka_partition",
    ).limit(k).select("entity", "op", "kafka_offset", "event_ts", "processed_at")


def recent_orders(tables: Tables, k: int = 15) -> DataFrame:
    return top_k(tables.orders, k, F.col("order_ts").desc_nulls_last(), key="order_id")


def page(tables: Tables, filters: Filters = Filters()) -> dict[str, DataFrame]:
    """All result frames of the page."""
    return {
        "kpis": kpi_row(tables, filters),
        "trend": daily_trend(tables, filters),
        "statuses": orders_by_status(tables, filters),
        "cities": revenue_by_city(tables, filters),
        "products": top_products(tables, filters),
        "retention": retention_by_tier(tables, filters),
        "payments": payment_mix(tables),
    }
