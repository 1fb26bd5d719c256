"""SQL with named parameters over the current tables. Values are bound, never put into the text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.plans.dashboard import Filters
from tidemark.sources.tables import Tables

#: The KPI row at line grain. Lines are counted per order first. A parameter that is NULL selects all values.
KPI_ROW = """
WITH wanted AS (
    SELECT i.order_id, count(*) AS n FROM {order_items} i JOIN {products} p ON i.product_id = p.product_id
    WHERE p.category IS NOT NULL AND (:categories IS NULL OR array_contains(CAST(:categories AS ARRAY<STRING>), p.category)) GROUP BY i.order_id
),
picked AS (
    SELECT o.customer_id, o.status, CAST(round(o.total_amount * 100) AS BIGINT) AS cents, w.n
    FROM {orders} o JOIN {customers} c ON o.customer_id = c.customer_id JOIN wanted w ON o.order_id = w.order_id
    WHERE o.status IS NOT NULL AND (:statuses IS NULL OR array_contains(CAST(:statuses AS ARRAY<STRING>), o.status))
      AND c.city IS NOT NULL AND (:cities IS NULL OR array_contains(CAST(:cities AS ARRAY<STRING>), c.city))
      AND o.order_ts IS NOT NULL AND (:start IS NULL OR to_date(o.order_ts) >= CAST(:start AS DATE)) AND (:end IS NULL OR to_date(o.order_ts) <= CAST(:end AS DATE))
),
per_customer AS (
    SELECT customer_id, count(*) AS orders, sum(CASE WHEN status <> 'canceled' THEN cents * n ELSE 0 END) AS cents,
           sum(CASE WHEN status <> 'canceled' AND cents IS NOT NULL THEN n ELSE 0 END) AS kept,
           sum(CASE WHEN status = 'canceled' THEN n ELSE 0 END) AS canceled
    FROM picked GROUP BY customer_id
),
repeats AS (SELECT customer_id, count(*) AS all_orders FROM {orders} GROUP BY customer_id)
SELECT coalesce(sum(orders), 0) AS total_orders, CAST(sum(cents) AS DOUBLE) / 100.0D AS revenue,
       round(CAST(sum(cents) AS DOUBLE) / nullif(sum(kept), 0)) / 100.0D AS avg_order_value,
       round(10000.0D * sum(canceled) / nullif(sum(orders), 0)) / 100.0D AS cancel_rate,
       round(10000.0D * count_if(all_orders > 1) / nullif(count(*), 0)) / 100.0D AS repeat_customer_rate
FROM per_customer LEFT JOIN repeats USING (customer_id)
"""


def parameters(filters: Filters) -> dict[str, object]:
    """The filters' selections as values to bind; the text says their types, as an empty or absent selection has none."""

    def texts(values: tuple[str, ...] | None) -> Column | None:
        return None if values is None else F.array(*map(F.lit, values))

    selected = {name: texts(getattr(filters, name)) for name in ("cities", "statuses", "categories")}
    return {**selected, "start": filters.start, "end": filters.end}


def query(spark: SparkSession, tables: Tables, text: str, **values: object) -> DataFrame:
    """Run SQL in which `{orders}` and the like stand for the tables and `:name` for a bound value."""
    used = {name: frame for name, frame in tables.items() if f"{{{name}}}" in text}
    return spark.sql(text, args=values, **used)


def kpi_row(spark: SparkSession, tables: Tables, filters: Filters) -> DataFrame:
    return query(spark, tables, KPI_ROW, **parameters(filters))
