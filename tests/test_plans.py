"""Marts and page queries on awkward small tables, against SQL that joins first."""

from __future__ import annotations

from datetime import date

import duckdb
import pytest

from oracle import sql
from tests.oracle_compare import compare
from tests.small_tables import empty_tables, rows, tables
from tidemark.plans import dashboard, marts
from tidemark.plans.dashboard import LINE, ORDER, Filters
from tidemark.schemas import ENTITIES

DOMAIN_NAMES = {"customers": "d_customers", "products": "d_products", "orders": "d_orders",
                "order_items": "d_items", "payments": "d_payments"}
DUCK = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "timestamp_ntz": "TIMESTAMP"}

PICKED = Filters(("city0", "city1"), ("placed", "canceled", "refunded"), ("cat0", "cat2"), date(2024, 3, 10), date(2024, 3, 11))
PICKED_SQL = """c.city IN ('city0', 'city1') AND o.status IN ('placed', 'canceled', 'refunded')
    AND p.category IN ('cat0', 'cat2') AND CAST(o.order_ts AS DATE) BETWEEN DATE '2024-03-10' AND DATE '2024-03-11'"""
CASES = {"all": (Filters(), sql.EVERYTHING), "picked": (PICKED, PICKED_SQL), "none": (Filters(statuses=()), "FALSE")}


@pytest.fixture(scope="module", params=["small", "empty"])
def world(request, spark):
    con = duckdb.connect()
    for name, entity in ENTITIES.items():
        columns = ", ".join(f"{f.name} {DUCK[f.dataType.simpleString()]}" for f in entity.schema.fields)
        con.execute(f"CREATE TABLE {DOMAIN_NAMES[name]} ({columns})")
        if request.param == "small":
            marks = ", ".join("?" * len(entity.columns))
            con.executemany(f"INSERT INTO {DOMAIN_NAMES[name]} VALUES ({marks})", rows()[name])
    source = tables(spark) if request.param == "small" else empty_tables(spark)
    return source, con


def on_tables(text):
    """The SQL over ready-made domain tables instead of derived ones."""
    return text.replace(sql.DOMAIN, "WITH unused AS (SELECT 1)")


@pytest.mark.parametrize("name", marts.MARTS)
def test_marts(world, name):
    source, con = world
    assert compare(marts.MARTS[name](source), con, on_tables(sql.ORACLE_SQL[name])) == []


@pytest.mark.parametrize("case", CASES)
@pytest.mark.parametrize("grain", [LINE, ORDER])
def test_kpi_row(world, case, grain):
    source, con = world
    filters, where = CASES[case]
    text = sql.kpi_row(sql.STAR, where) if grain == LINE else sql.kpi_row(sql.per_order(where), "TRUE")
    assert compare(dashboard.kpi_row(source, filters, grain), con, on_tables(text)) == []


@pytest.mark.parametrize("case", CASES)
def test_page_queries(world, case):
    source, con = world
    filters, where = CASES[case]
    picked = f"""WITH picked AS (SELECT DISTINCT o.order_id, o.customer_id, o.total_amount, c.loyalty_tier
        FROM {sql.STAR} WHERE {where})"""
    expected = {
        "trend": sql.daily(sql.STAR, where),
        "statuses": f"SELECT o.status, count(DISTINCT o.order_id) AS orders FROM {sql.STAR} WHERE {where} GROUP BY 1",
        "cities": sql.by_city(sql.STAR, where, "c.city"),
        "products": sql.top_products(where),
        "retention": f"""{picked}, counted AS (SELECT *, count(*) OVER (PARTITION BY customer_id) AS n FROM picked)
            SELECT loyalty_tier, count(DISTINCT customer_id) AS customers,
                   count(DISTINCT CASE WHEN n > 1 THEN customer_id END) AS repeat_customers,
                   {sql.money_avg('total_amount')} AS avg_order_value
            FROM counted GROUP BY 1""",
        "payments": sql.ORACLE_SQL["payment_mix"],
    }
    page = dashboard.page(source, filters)
    for name, text in expected.items():
        assert compare(page[name], con, on_tables(text)) == [], name
    window = f"{picked} SELECT *, count(*) OVER (PARTITION BY customer_id) AS order_count FROM picked"
    assert compare(dashboard.orders_with_customer_count(source, filters), con, window) == []
    lines = f"SELECT count(*) AS n FROM {sql.STAR} WHERE {where}"
    assert dashboard.star(source, filters).count() == con.execute(lines).fetchall()[0][0]


@pytest.mark.parametrize("name", ["payment_share", "filter_options", "recent_orders", "order_total_reconcile"])
def test_unfiltered_queries(world, name):
    source, con = world
    from tidemark.operators.mutations import reconcile_totals

    plan = {
        "payment_share": dashboard.payment_share,
        "filter_options": dashboard.filter_options,
        "recent_orders": dashboard.recent_orders,
        "order_total_reconcile": lambda t: reconcile_totals(t.orders, t.order_items),
    }[name]
    assert compare(plan(source), con, on_tables(sql.ORACLE_SQL[name])) == []


def test_order_of_results(spark):
    source = tables(spark)
    revenue = [r["revenue"] for r in marts.revenue_by_city(source).collect()]
    assert revenue == sorted(revenue, reverse=True)
    hours = [r["order_hour"] for r in marts.hourly_kpis(source).collect()]
    assert hours[-1] is None and hours[:-1] == sorted(hours[:-1])
    options = [tuple(r) for r in dashboard.filter_options(source).collect()]
    assert [o for f, o in options if f == "city"] == ["city0", "city1", "city2", None]


def test_date_bounds(spark):
    today = spark.sql("SELECT current_date() AS d").first()["d"]
    assert tuple(dashboard.date_bounds(empty_tables(spark)).first()) == (today, today)
    assert tuple(dashboard.date_bounds(tables(spark)).first()) == (date(2024, 3, 9), date(2024, 3, 12))


def test_built_marts_pass_their_checks(spark, tmp_path):
    source = tables(spark)
    marts.build_marts(source, str(tmp_path))
    marts.build_marts(source, str(tmp_path), ["orders_summary"])
    stored = spark.read.parquet(str(tmp_path / "customer_retention"))
    assert stored.count() == marts.customer_retention(source).count()
    results = {r["check_name"]: r["failures"] for r in marts.check_marts(spark, str(tmp_path)).collect()}
    # A city is missing in the customers table, and the mart shows it.
    assert results == {
        "not_null_orders_summary_status": 0, "not_null_top_customers_customer_id": 0,
        "not_null_revenue_by_city_city": 1, "not_null_top_products_product_id": 0,
    }


# Plan shapes


def plan_of(frame):
    return frame._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", ["kpis", "trend", "statuses", "cities", "products", "retention", "payments"])
def test_no_cross_join_window_or_python(spark, name):
    plan = plan_of(dashboard.page(tables(spark), PICKED)[name])
    for bad in ("CartesianProduct", "BroadcastNestedLoopJoin", "Window", "Python", "Expand"):
        assert bad not in plan


def test_filters_and_columns_reach_the_scan(spark, folder):
    from tidemark.sources import testdata

    plan = plan_of(dashboard.kpi_row(testdata.load(spark, folder), Filters(("NATION_1",), start=date(1996, 1, 1))))
    assert "GreaterThanOrEqual(o_orderdate,1996-01-01T00:00" in plan
    lineitem = [line for line in plan.splitlines() if "lineitem.parquet" in line]
    assert lineitem and all("ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in line for line in lineitem)


def test_a_failed_build_leaves_the_old_mart(spark, tmp_path, monkeypatch):
    source = tables(spark)
    marts.build_marts(source, str(tmp_path), ["orders_summary"])
    before = spark.read.parquet(str(tmp_path / "orders_summary")).collect()

    def broken(_):
        return source.orders.selectExpr("raise_error('lost') AS status")

    monkeypatch.setitem(marts.MARTS, "orders_summary", broken)
    with pytest.raises(Exception, match="lost"):
        marts.build_marts(source, str(tmp_path), ["orders_summary"])
    assert spark.read.parquet(str(tmp_path / "orders_summary")).collect() == before


def shuffled_plan(spark, frame):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        return frame._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


@pytest.mark.parametrize("name", ["daily_trend", "orders_by_status"])
def test_trend_and_status_shuffle_orders_by_customer_once(spark, name):
    plan = shuffled_plan(spark, getattr(dashboard, name)(tables(spark), PICKED))
    keyed = [line for line in plan.split("\n") if "Exchange hashpartitioning(customer_id" in line]
    assert len(keyed) == 2  # orders and the customers they are held against


def test_city_and_category_thin_out_before_the_lines(spark):
    plan = shuffled_plan(spark, dashboard.kpi_row(tables(spark), PICKED))
    assert plan.count("LeftSemi") == 1
    assert shuffled_plan(spark, dashboard.top_products(tables(spark), PICKED)).count("LeftSemi") == 2


def test_payments_are_read_once_for_shares(spark):
    result = dashboard.payment_share(tables(spark))
    result.collect()
    assert "ReusedExchange" in result._jdf.queryExecution().executedPlan().toString()


def test_marts_add_up_before_joining(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(marts.revenue_by_city(tables(spark)))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # One shuffle per side by customer, one by city, one for the order of the result.
    assert plan.count("Exchange hashpartitioning(customer_id") == 2
    assert plan.count("Exchange") == 4


@pytest.mark.parametrize("name", ["kpis", "cities", "retention"])
def test_a_city_selection_reads_customers_once(spark, folder, name):
    from tidemark.sources import testdata

    plan = plan_of(dashboard.page(testdata.load(spark, folder), Filters(("NATION_1",)))[name])
    assert len([line for line in plan.splitlines() if "FileScan" in line and "customer.parquet" in line]) == 1


@pytest.mark.parametrize("filters", [Filters(), PICKED])
def test_customer_counts_and_rows_share_one_shuffle(spark, filters):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        result = dashboard.orders_with_customer_count(tables(spark), filters)
        result.collect()
        final = result._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "ReusedExchange" in final
    shuffles = [line for line in final.splitlines() if "Exchange hashpartitioning" in line and "Reused" not in line]
    assert len(shuffles) <= 13
