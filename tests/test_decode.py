"""How messages are read, rule by rule."""

from __future__ import annotations

import json
import math
from datetime import datetime

import pytest

from tests.changes import frame, message
from tidemark.operators import decode, state
from tidemark.schemas import ENTITIES

ORDER = {"order_id": 1, "customer_id": 5, "order_ts": 1700000000, "status": "placed", "total_amount": 9.5}


def route(spark, *values, entity="orders"):
    messages = [message(entity, i, v) for i, v in enumerate(values)]
    rows = decode.route_messages(frame(spark, messages)).collect()
    return {r["kafka_offset"]: r for r in rows}


def changes(spark, *values, entity="orders", **options):
    messages = [message(entity, i, v) for i, v in enumerate(values)]
    log = decode.log_rows(decode.route_messages(frame(spark, messages)))
    rows = decode.decode_changes(log, ENTITIES[entity], **options).collect()
    return [r for _, r in sorted((r["kafka_offset"], r) for r in rows)]


def read_field(spark, entity, field, texts):
    """A field's readings for JSON texts; None as text leaves the field out."""
    required = {name: 1 for name in ENTITIES[entity].required if name != field}
    values = []
    for text in texts:
        rest = json.dumps(required)[1:-1]
        parts = [p for p in (rest, None if text is None else f'"{field}":{text}') if p]
        values.append('{"op":"u","after":{' + ",".join(parts) + "}}")
    return changes(spark, *values, entity=entity)


def test_unloggable_messages(spark):
    rows = route(spark, None, "{bad", "[]", "null", "3", b"\xff\xfe", '{"a":NaN}', '{"op":"u","ts_ms":"x"}')
    assert 0 not in rows, "a message without a value is dropped"
    assert {o: r["reason"] for o, r in rows.items()} == {
        1: "invalid json",
        2: "not an object",
        3: "not an object",
        4: "not an object",
        5: "invalid utf-8",
        6: "invalid json",
        7: "unreadable ts_ms",
    }
    assert all(r["route"] == "quarantine" for r in rows.values())
    assert bytes(rows[5]["raw_value"]) == b"\xff\xfe"


def test_log_row(spark):
    text = '{ "op":"u", "ts_ms":"17", "after":null, "extra":[1] }'
    row = route(spark, text)[0]
    assert (row["entity"], row["kafka_topic"], row["kafka_partition"]) == ("orders", "shop.public.orders", 0)
    assert (row["op"], row["event_ts_ms"]) == ("u", 17)
    assert row["payload"] == text, "the payload is kept as it came"
    assert row["processed_at"] is not None


def test_unknown_entity_is_logged(spark):
    assert route(spark, {"op": "c", "after": {"id": 1}}, entity="returns")[0]["route"] == "log"


@pytest.mark.parametrize("op", ["r", "c", "u", "x", None])
def test_any_op_with_after_upserts(spark, op):
    (row,) = changes(spark, {"op": op, "before": {"order_id": 9}, "after": ORDER})
    assert (row["action"], row["order_id"], row["op"]) == ("upsert", 1, op)


def test_delete_and_its_exceptions(spark):
    rows = changes(
        spark,
        {"op": "d", "before": {"order_id": 7}, "after": None},
        {"op": "d", "before": None, "after": None},
        {"op": "d", "before": {}, "after": ORDER},
        {"op": "d", "before": {"other": 1}, "after": ORDER},
        {"op": "d", "before": {"order_id": None}, "after": None},
        {"op": "d", "before": 0, "after": ORDER},
        {"op": "d", "before": "text", "after": ORDER},
        {"op": "u", "before": {"order_id": 7}, "after": {}},
        {"op": "u", "after": False},
        {"op": "u", "after": 5},
        {"op": "u", "after": [1]},
        {"op": "u", "after": []},
    )
    assert [r["action"] for r in rows] == [
        "delete", "ignore", "upsert", "reject", "reject", "upsert", "reject",
        "ignore", "ignore", "reject", "reject", "ignore",
    ]
    assert rows[0]["order_id"] == 7 and rows[0]["status"] is None


def test_key_change_upserts_the_new_key(spark):
    (row,) = changes(spark, {"op": "u", "before": {"order_id": 1}, "after": {**ORDER, "order_id": 2}})
    assert (row["action"], row["order_id"]) == ("upsert", 2)


def test_partial_after_empties_other_columns(spark):
    (row,) = changes(spark, {"op": "u", "after": {"order_id": 1, "customer_id": 5}})
    assert row["action"] == "upsert"
    assert (row["order_ts"], row["status"], row["total_amount"]) == (None, None, None)


@pytest.mark.parametrize("missing", ["order_id", "customer_id"])
def test_required_ids(spark, missing):
    absent = {k: v for k, v in ORDER.items() if k != missing}
    rows = changes(spark, {"op": "u", "after": absent}, {"op": "u", "after": {**ORDER, missing: None}})
    assert [r["action"] for r in rows] == ["reject", "reject"]


def test_quantity_default_applies_only_when_missing(spark):
    rows = read_field(spark, "order_items", "quantity", [None, "null", "3", '"4"'])
    assert [(r["action"], r["quantity"]) for r in rows] == [
        ("upsert", 1), ("reject", None), ("upsert", 3), ("upsert", 4),
    ]


def test_ids(spark):
    texts = ["7", '"7"', "7.9", '"7.9"', "true", "null", '" 7 "', '"1_000"', "{}", "[]", '""', "-7.9", '"+5"',
             "99999999999999999999"]
    rows = read_field(spark, "products", "product_id", texts)
    expected = [7, 7, 7, None, 1, None, 7, 1000, None, None, None, -7, 5, None]
    assert [r["product_id"] for r in rows] == expected
    assert [r["action"] for r in rows] == ["reject" if e is None else "upsert" for e in expected]


def test_ids_of_32_bits(spark):
    big = {"op": "u", "after": {"product_id": 2**31}}
    assert changes(spark, big, entity="products")[0]["action"] == "upsert"
    assert changes(spark, big, entity="products", id_bits=32)[0]["action"] == "reject"


def test_amounts(spark):
    texts = ["12.5", '"12.50"', '"abc"', "null", '"1d"', '"1_000"', "true", '" .5 "', '"5."', "{}", '"1e5"',
             '"inf"', '""', None]
    rows = read_field(spark, "orders", "total_amount", texts)
    assert [r["total_amount"] for r in rows] == [
        12.5, 12.5, None, None, None, 1000.0, 1.0, 0.5, 5.0, None, 1e5, math.inf, None, None,
    ]
    assert math.isnan(read_field(spark, "orders", "total_amount", ['"NaN"'])[0]["total_amount"])


def test_times(spark):
    base = datetime(2023, 11, 14, 22, 13, 20)
    ten = datetime(2024, 1, 1, 10)
    cases = {
        "1700000000": base,
        "1700000000000": base,
        "1700000000000000": base,
        "1700000000000000000": base,
        "1700000000.9": base,
        "1700000000123456": base.replace(microsecond=123456),
        "-1": datetime(1969, 12, 31, 23, 59, 59),
        "true": datetime(1970, 1, 1, 0, 0, 1),
        "-9223372036854775808": datetime(1677, 9, 21, 0, 12, 43, 145225),
        "-99999999999": None,
        '"2024-01-01T10:00:00+05:00"': ten,
        '"2024-01-01T10:00:00Z"': ten,
        '"2024-01-01 10:00:00 garbage"': ten,
        '"2024-01-01T10"': ten,
        '"20240101T100000"': ten,
        '" 2024-01-01 10:00 "': ten,
        '"2024-01-01T10:00:00,1234567"': ten.replace(microsecond=123456),
        '"2024-1-1 10:0:0"': ten,
        '"20240101"': datetime(2024, 1, 1),
        '"2024-01-01"': datetime(2024, 1, 1),
        '"2024-02-30"': None,
        '"2024-0101"': None,
        '"2024"': None,
        '"2024-01"': None,
        '""': None,
        '"  "': None,
        "null": None,
        "{}": None,
    }
    rows = read_field(spark, "orders", "order_ts", list(cases))
    assert {text: r["order_ts"] for text, r in zip(cases, rows)} == cases
    assert all(r["action"] == "upsert" for r in rows), "an unreadable time does not reject the row"


def test_repeated_field_keeps_the_last(spark):
    (row,) = changes(spark, '{"op":"c","op":"d","before":{"order_id":1,"order_id":4}}')
    assert (row["action"], row["order_id"]) == ("delete", 4)


def test_text_columns_take_other_scalars(spark):
    rows = read_field(spark, "orders", "status", ['"x"', "5", "true", "null"])
    assert [r["status"] for r in rows] == ["x", "5", "true", None]


def test_rejected_rows(spark):
    messages = [message("orders", 0, {"op": "u", "after": ORDER}), message("orders", 1, {"op": "u", "after": {"x": 1}})]
    log = decode.log_rows(decode.route_messages(frame(spark, messages)))
    rows = decode.rejected_rows(log, ENTITIES["orders"]).collect()
    assert [r["kafka_offset"] for r in rows] == [1]


FLAWED = (None, "{bad", "[]", "null", "3", b"\xff\xfe", '{"op":"u","ts_ms":"x","after":{"order_id":1,"customer_id":5}}',
          '{"op":"d","before":{"order_id":4}}', '{"op":"u","after":{"x":1}}', '{"op":"u","after":null}', '{"after":0}', '""')


@pytest.mark.parametrize("bits", [64, 32])
def test_changes_of_messages_are_those_of_their_log_rows(spark, bits):
    wide = {**ORDER, "order_id": 1 << 40}
    messages = [message("orders", i, v) for i, v in enumerate((*FLAWED, {"op": "c", "after": ORDER}, {"op": "u", "after": wide}))]
    messages += [message("customers", 50, {"op": "u", "after": {"customer_id": 1}})]
    made = frame(spark, messages)
    orders = ENTITIES["orders"]
    log = decode.log_rows(decode.route_messages(made))
    logged = decode.decode_changes(log.where("entity = 'orders'"), orders, bits)
    direct = decode.message_changes(made, orders, bits)
    assert direct.schema == logged.schema
    applied = "action IN ('upsert', 'delete', 'reject')"
    assert sorted(map(repr, direct.where(applied).collect())) == sorted(map(repr, logged.where(applied).collect()))
    assert {r["kafka_offset"] for r in direct.collect()} == {i for i, v in enumerate(FLAWED) if v is not None} | {12, 13}


def test_changes_of_messages_parse_once(spark):
    made = frame(spark, [message("orders", 0, {"op": "c", "after": ORDER})])
    folded = state.latest_changes(decode.message_changes(made, ENTITIES["orders"]), ENTITIES["orders"])
    plan = folded._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parseJson") + plan.count("parse_json") == 1 and "Generate" not in plan


def test_wanted_columns_alone_are_built(spark):
    routed = decode.route_messages(frame(spark, [message("orders", 0, {"op": "c", "after": ORDER})]), ["route", "op"])
    (row,) = routed.where("route = 'log'").collect()
    assert routed.columns == ["route", "op"] and row["op"] == "c"
    assert "processed_at" not in routed._jdf.queryExecution().optimizedPlan().toString()
