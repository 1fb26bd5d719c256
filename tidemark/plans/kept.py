"""Marts kept up to date by what a batch changes, without reading the tables again.

A mart is a table of sums per group. When rows change, their old images are taken from their groups and their new images added,
so a batch writes only the groups it touches. Sums can be added in any order: whole cents are integers, and the few amounts that are
not are kept apart as in `money`. Amounts that are not finite are counted instead of added, as a sum could not let go of them.

Revenue by city also changes when customers move: orders are summed per customer first, and a customer's sums move
from city to city.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions import money, time
from tidemark.plans.marts import has_kept_amount, kept_amount

HOURS, STATUSES, CUSTOMERS, CITIES = "hourly_kpis", "orders_summary", "customer_totals", "revenue_by_city"
#: Marts in their final form, and the tables kept for them; those that orders alone decide.
MARTS, TABLES, BY_ORDER = (HOURS, STATUSES, CITIES), (HOURS, STATUSES, CUSTOMERS, CITIES), (HOURS, STATUSES, CUSTOMERS)

_GROUPS = {HOURS: ("order_hour", T.TimestampNTZType()), STATUSES: ("status", T.StringType()), CUSTOMERS: ("customer_id", T.LongType()), CITIES: ("city", T.StringType())}
_AMOUNT = "amount"
_HIGH, _LOW, _REST = money.part_columns(_AMOUNT)
#: Rows of a group, amounts among them, rows that count for the mean, and amounts that are no finite numbers.
_COUNTS = ("n_rows", "n_amounts", "n_counted", "n_nan", "n_up", "n_down")
SUMS = (*_COUNTS, _HIGH, _LOW, _REST)
_SIGN = "_sign"


def layout(table: str) -> T.StructType:
    name, kind = _GROUPS[table]
    kinds = {_REST: T.DoubleType()}
    return T.StructType([T.StructField(name, kind), *[T.StructField(c, kinds.get(c, T.LongType())) for c in SUMS]])


def signed(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old images, to be taken away, and new ones, to be added."""
    return old.withColumn(_SIGN, F.lit(-1)).unionByName(new.withColumn(_SIGN, F.lit(1)))


def order_sums(change: DataFrame, table: str) -> DataFrame:
    """What signed orders change in a table's groups; groups that stay as they are are left out."""
    status, total = F.col("status"), F.col("total_amount")
    group = {HOURS: time.hour_start(F.col("order_ts")), STATUSES: status, CUSTOMERS: F.col("customer_id")}[table]
    if table == STATUSES:
        change = change.where(status.isNotNull())
        amount, counted = total, F.when(total.isNotNull(), 1).otherwise(0)
    else:
        amount, counted = kept_amount(total, status), has_kept_amount(total, status)
    sign, finite = F.col(_SIGN), ~F.isnan(amount) & (F.abs(amount) < float("inf"))

    def number(condition: Column, name: str) -> Column:
        return F.sum(F.when(condition, sign).otherwise(0)).alias(name)

    sums = change.groupBy(group.alias(_GROUPS[table][0])).agg(
        F.sum(sign).alias("n_rows"),
        number(amount.isNotNull(), "n_amounts"),
        F.sum(counted * sign).alias("n_counted"),
        number(F.isnan(amount), "n_nan"),
        number(amount == float("inf"), "n_up"),
        number(amount == float("-inf"), "n_down"),
        *money.sum_parts(F.when(finite, amount).otherwise(0.0), _AMOUNT, weight=sign),
    )
    return _moved(sums)


def _moved(sums: DataFrame) -> DataFrame:
    still = F.lit(True)
    for name in SUMS:
        still = still & (F.col(name) == 0)
    return sums.where(~still)


def added_up(parts: DataFrame, table: str) -> DataFrame:
    """One row per group; groups without rows are gone."""
    group = _GROUPS[table][0]
    return parts.groupBy(group).agg(*[F.sum(c).alias(c) for c in SUMS]).where(F.col("n_rows") != 0)


def people(before: DataFrame, moved: DataFrame, old: DataFrame, new: DataFrame) -> DataFrame:
    """(customer_id, city, _sign) of all customers that a batch touches: customers whose orders changed, as they were before (from
    the table) and after, and those that changed themselves."""
    changed = old.select("customer_id").unionByName(new.select("customer_id")).distinct()
    ordered = before.join(moved.select("customer_id"), "customer_id", "left_semi").join(changed, "customer_id", "left_anti")
    both = ordered.select("customer_id", "city", F.explode(F.array(F.lit(-1), F.lit(1))).alias(_SIGN))
    return signed(old.select("customer_id", "city"), new.select("customer_id", "city")).unionByName(both)


def city_sums(people: DataFrame, totals: DataFrame, moved: DataFrame) -> DataFrame:
    """What a batch changes in the cities' sums: each customer's sums before it go from the old city, those after it to the new one.

    `totals` are the customers' sums before the batch, `moved` what the batch adds to them.
    """
    touched = people.select("customer_id").distinct()
    before = totals.join(touched, "customer_id", "left_semi").withColumn("_late", F.lit(False))
    held = before.unionByName(moved.withColumn("_late", F.lit(True))).join(people, "customer_id")
    # The sums after the batch are those before it and what it adds.
    counts = held.where((F.col(_SIGN) == 1) | ~F.col("_late"))
    sums = counts.groupBy("city").agg(*[F.sum(F.col(c) * F.col(_SIGN)).alias(c) for c in SUMS])
    return _moved(sums)


def finished(table: str, sums: DataFrame) -> DataFrame:
    """The mart as `plans.marts` gives it."""
    whole, mean = money.total(_AMOUNT), money.mean(_AMOUNT, F.col("n_counted"))
    endless = (
        F.when((F.col("n_nan") > 0) | ((F.col("n_up") > 0) & (F.col("n_down") > 0)), F.lit(float("nan")))
        .when(F.col("n_up") > 0, F.lit(float("inf")))
        .when(F.col("n_down") > 0, F.lit(float("-inf")))
    )
    orders = "order_count" if table == STATUSES else "orders"
    shown = sums.select(
        _GROUPS[table][0],
        F.col("n_rows").alias(orders),
        F.when(F.col("n_amounts") > 0, F.coalesce(endless, whole)).alias("revenue"),
        F.when(F.col("n_counted") > 0, F.coalesce(endless, mean)).alias("avg_order_value"),
    )
    group = F.col(_GROUPS[table][0]).asc_nulls_last()
    return shown.orderBy(group) if table == HOURS else shown.orderBy(F.col("revenue").desc_nulls_last(), group)
