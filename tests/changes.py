"""Builders for change messages in tests, and a one-at-a-time model of how they apply."""

from __future__ import annotations

import json

from tidemark.schemas import ENTITIES, MESSAGE_SCHEMA

PREFIX = "shop.public"


def message(entity, offset, value, partition=0):
    if isinstance(value, dict):
        value = json.dumps(value)
    if isinstance(value, str):
        value = value.encode()
    return (f"{PREFIX}.{entity}", partition, offset, None if value is None else bytearray(value))


def frame(spark, messages):
    return spark.createDataFrame(messages, MESSAGE_SCHEMA)


def upsert(entity, offset, after, op="u", partition=0):
    return message(entity, offset, {"op": op, "ts_ms": offset, "before": None, "after": after}, partition)


def delete(entity, offset, key, partition=0):
    before = {ENTITIES[entity].key: key}
    return message(entity, offset, {"op": "d", "ts_ms": offset, "before": before, "after": None}, partition)


def fold_orders(messages):
    """Orders after applying well-formed order messages one by one in the given order."""
    rows = {}
    for _, _, _, value in messages:
        event = json.loads(bytes(value))
        if event["op"] == "d" and event["before"]:
            rows.pop(event["before"]["order_id"], None)
        elif event["after"]:
            after = event["after"]
            if isinstance(after.get("order_id"), int) and isinstance(after.get("customer_id"), int):
                rows[after["order_id"]] = (after["customer_id"], after.get("status"), after.get("total_amount"))
    return rows


def order_rows(current):
    return {r["order_id"]: (r["customer_id"], r["status"], r["total_amount"]) for r in current.collect()}
