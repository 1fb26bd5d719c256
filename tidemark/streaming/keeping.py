"""Keeps the marts of `plans.kept` up to date with a store's batches.

Their sums are parts of the store like its tables: a batch appends what it changes, and a commit shows tables and marts of one batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tidemark.operators import state
from tidemark.plans import kept
from tidemark.schemas import ENTITIES, Entity


def _sums(store, commit, table: str) -> DataFrame:
    return kept.added_up(store.read_parts(table, commit.parts.get(table, []), kept.layout(table)), table)


def kept_mart(store, commit, name: str) -> DataFrame:
    if name not in kept.MARTS:
        raise LookupError(f"{name} is not kept; there are {', '.join(kept.MARTS)}")
    return kept.finished(name, _sums(store, commit, name))


def _images(store, before, after, entity: Entity) -> tuple[DataFrame, DataFrame]:
    """The rows of the keys that a batch changes, before it and after it."""
    layout = state.part_schema(entity)
    added = after.parts.get(entity.name, [])[len(before.parts.get(entity.name, [])) :]
    changed = store.read_parts(entity.name, added, layout)
    if not added or entity.name not in before.parts:
        return store.spark.createDataFrame([], entity.schema), state.live_rows(changed, entity)
    return store._current(before, entity, only=changed), state.live_rows(changed, entity)


def keep_marts(store, before, after) -> None:
    """Append to every kept mart what a batch takes from its groups and adds to them; `after` has the batch's table parts.

    A store whose earlier batches kept no marts gets them from its tables.
    """
    orders, customers = ENTITIES["orders"], ENTITIES["customers"]
    if not any(table in before.parts for table in kept.TABLES):
        before = type(before)()
    if before.number < 0:
        nothing = [store.spark.createDataFrame([], e.schema) for e in (orders, customers)]
        images = [(empty, store._current(after, e)) for empty, e in zip(nothing, (orders, customers), strict=True)]
    else:
        images = [_images(store, before, after, e) for e in (orders, customers)]
    (old_orders, new_orders), (old_people, new_people) = images
    change, number = kept.signed(old_orders, new_orders).persist(), str(after.number)
    try:
        store.side_by_side(lambda table: store.write_part(kept.order_sums(change, table), after, table, number), kept.BY_ORDER)
    finally:
        change.unpersist()
    moved = store.read_parts(kept.CUSTOMERS, [p for p in after.parts.get(kept.CUSTOMERS, []) if p[0] == number], kept.layout(kept.CUSTOMERS))
    people = kept.people(store._current(before, customers), moved, old_people, new_people)
    store.write_part(kept.city_sums(people, _sums(store, before, kept.CUSTOMERS), moved), after, kept.CITIES, number)


def rewrite(store, commit, outgrown) -> None:
    """Write kept marts as a whole once that pays."""

    def whole(table: str) -> None:
        if outgrown(commit.parts.get(table, [])):
            sums = _sums(store, commit, table)
            commit.parts[table] = []
            store.write_part(sums, commit, table, f"{commit.number}-whole")

    store.side_by_side(whole, kept.TABLES)
