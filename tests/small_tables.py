"""Small tables with the awkward cases: orphans, NULLs, ties, one very large customer and order."""

from __future__ import annotations

from datetime import datetime, timedelta

from tidemark.schemas import ENTITIES
from tidemark.sources.tables import Tables

START = datetime(2024, 3, 9, 20, 30)  # reaches over a change to daylight saving time


def rows():
    customers = [(i, f"c{i}", f"city{i % 3}", None, ["Gold", "Silver"][i % 2]) for i in range(1, 7)]
    customers += [(7, "nocity", None, None, None), (8, "idle", "city0", None, "Gold")]
    products = [(i, f"p{i % 4}", f"cat{i % 3}", 10.0 + i) for i in range(1, 7)] + [(7, "loose", None, 1.0)]
    states = ["placed", "shipped", "canceled", "refunded", None]
    orders, items = [], []
    for i in range(1, 61):
        customer = 1 if i % 3 == 0 else i % 9  # a third of all orders is customer 1's
        if i % 20 == 7:
            customer = None
        when = None if i % 17 == 0 else START + timedelta(hours=i)
        amount = None if i % 13 == 0 else (i * 37 % 50) + 0.25
        orders.append((i, customer, when, states[i % 5], amount))
        for line in range(i % 4 if i != 10 else 40):  # order 10 has very many lines, some have none
            items.append((len(items) + 1, i, (i + line) % 9, line % 3 + 1, 1.0, (i + line) % 20 + 0.5))
    items += [(9001, 999, 1, 1, 1.0, 5.0), (9002, None, 1, 1, 1.0, 5.0)]
    payments = [(o[0], o[0], o[2], ["paid", "voided", None][o[0] % 3], o[4]) for o in orders]
    return {
        "customers": customers, "products": products, "orders": orders, "order_items": items, "payments": payments,
    }


def tables(spark):
    data = rows()
    return Tables(**{name: spark.createDataFrame(data[name], e.schema) for name, e in ENTITIES.items()})


def empty_tables(spark):
    return Tables(**{name: spark.createDataFrame([], e.schema) for name, e in ENTITIES.items()})
