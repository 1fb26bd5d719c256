"""The five entities, their columns, and the change-log layout."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import types as T

# Kinds of entity columns: how a JSON value is coerced when a change is decoded.
ID = "id"
TEXT = "text"
MONEY = "money"
TIME = "time"

SPARK_TYPES = {
    ID: T.LongType(),
    TEXT: T.StringType(),
    MONEY: T.DoubleType(),
    TIME: T.TimestampNTZType(),
}


@dataclass(frozen=True)
class Entity:
    """One tracked table. `required` ids reject a change when absent or unreadable.

    `defaults` apply only when the field is missing; an explicit null is still rejected.
    """

    name: str
    key: str
    columns: tuple[tuple[str, str], ...]
    required: tuple[str, ...]
    defaults: tuple[tuple[str, int], ...] = ()

    @property
    def column_names(self) -> list[str]:
        return [name for name, _ in self.columns]

    @property
    def schema(self) -> T.StructType:
        return T.StructType([T.StructField(name, SPARK_TYPES[kind]) for name, kind in self.columns])

    @property
    def table(self) -> str:
        return f"{self.name}_current"


ENTITIES: dict[str, Entity] = {
    entity.name: entity
    for entity in (
        Entity(
            "customers",
            "customer_id",
            (
                ("customer_id", ID),
                ("customer_name", TEXT),
                ("city", TEXT),
                ("signup_ts", TIME),
                ("loyalty_tier", TEXT),
            ),
            required=("customer_id",),
        ),
        Entity(
            "products",
            "product_id",
            (
                ("product_id", ID),
                ("product_name", TEXT),
                ("category", TEXT),
                ("unit_price", MONEY),
            ),
            required=("product_id",),
        ),
        Entity(
            "orders",
            "order_id",
            (
                ("order_id", ID),
                ("customer_id", ID),
                ("order_ts", TIME),
                ("status", TEXT),
                ("total_amount", MONEY),
            ),
            required=("order_id", "customer_id"),
        ),
        Entity(
            "order_items",
            "order_item_id",
            (
                ("order_item_id", ID),
                ("order_id", ID),
                ("product_id", ID),
                ("quantity", ID),
                ("unit_price", MONEY),
                ("line_amount", MONEY),
            ),
            required=("order_item_id", "order_id", "product_id", "quantity"),
            defaults=(("quantity", 1),),
        ),
        Entity(
            "payments",
            "payment_id",
            (
                ("payment_id", ID),
                ("order_id", ID),
                ("payment_ts", TIME),
                ("payment_status", TEXT),
                ("amount", MONEY),
            ),
            required=("payment_id", "order_id"),
        ),
    )
}

# Messages as a broker delivers them; also the layout of file-based change sources.
MESSAGE_SCHEMA = T.StructType(
    [
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("value", T.BinaryType()),
    ]
)

LOG_SCHEMA = T.StructType(
    [
        T.StructField("entity", T.StringType()),
        T.StructField("kafka_topic", T.StringType()),
        T.StructField("kafka_partition", T.IntegerType()),
        T.StructField("kafka_offset", T.LongType()),
        T.StructField("op", T.StringType()),
        T.StructField("event_ts_ms", T.LongType()),
        T.StructField("payload", T.StringType()),
        T.StructField("processed_at", T.TimestampNTZType()),
    ]
)
LOG_COLUMNS = LOG_SCHEMA.fieldNames()
