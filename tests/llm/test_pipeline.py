from __future__ import annotations

from collections import Counter

import pytest

import corpus_pipeline
from tests.llm.conftest import AWKWARD, SCHEMA, doc, prose
from tests.llm.test_mixing import plain_targets
from tests.llm.test_near_duplicates import plain_sets
from tidemark.llm import stages


@pytest.fixture(scope="module")
def sf(tmp_path_factory, spark):
    folder = tmp_path_factory.mktemp("sf")
    spark.createDataFrame(AWKWARD, SCHEMA).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([(8, 1, 0), (4, 0, 1)], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    return str(folder)


def rows_of(frame):
    return Counter(tuple(r) for r in frame.collect())


def test_stages_are_named_in_order():
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "quality_classifier", "near_duplicates", "mixing", "packing"]


@pytest.mark.parametrize("name, stage", corpus_pipeline.STAGES)
def test_stage_on_awkward_rows_and_nothing(spark, awkward, nothing, sf, name, stage):
    result = stage(spark, awkward, sf)
    if name == "packing":
        assert Counter(r["doc_id"] for r in result.where("piece = 0").collect()) == Counter(r[0] for r in AWKWARD)
    else:
        assert result.columns == awkward.columns
        assert set(rows_of(result)) <= set(rows_of(awkward))
    assert stage(spark, nothing, sf).count() == 0


def test_quality_rules_drop_what_fails(spark, awkward, sf):
    assert sorted({r["doc_id"] or 0 for r in stages.quality_rules(spark, awkward, sf).collect()}) == [0, 7, 8]


def test_one_of_each_group_stays(spark, sf):
    base = prose(5, 80).split()
    texts = [" ".join(base), " ".join(base), " ".join([*base[:-1], "other"]), prose(6, 80)]
    rows = [doc(9 - i, t) for i, t in enumerate(texts)] + [doc(6, texts[3]), doc(None, texts[0]), doc(None, "null id"), doc(None, "null id")]
    kept = stages.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA), sf).collect()
    assert sorted(r["doc_id"] or -1 for r in kept) == [-1, 6, 7]
    assert len({tuple(plain_sets([r])[0]) for r in kept}) == 3


def test_null_ids_are_removed_as_duplicates(spark, sf):
    text, near = prose(5, 80), prose(5, 80).rsplit(" ", 1)[0] + " other"
    frame = spark.createDataFrame([doc(7, text), doc(None, text), doc(None, near)], SCHEMA)
    assert [r["doc_id"] for r in stages.near_duplicates(spark, frame, sf).collect()] == [7]
    alone = spark.createDataFrame([doc(None, text), doc(None, near), doc(None, near), doc(None, prose(9, 60))], SCHEMA)
    kept = stages.near_duplicates(spark, alone, sf).collect()
    assert len(kept) == 2 and prose(9, 60) in {r["text"] for r in kept}


def test_texts_under_one_id_are_kept_unless_they_are_near(spark, sf):
    first, second = prose(1, 70), prose(2, 70)
    rows = [doc(3, first), doc(3, second), doc(3, first + " more"), doc(4, second), doc(3, first, "de", "s0")]
    kept = stages.near_duplicates(spark, spark.createDataFrame(rows, SCHEMA).repartition(3), sf).collect()
    assert len(kept) == 2 and {r["text"].split()[0] for r in kept} == {first.split()[0], second.split()[0]}


def test_the_row_that_stays_is_always_the_same(spark, sf):
    rows = [doc(1, prose(1, 60), "en", s) for s in ("s2", "s1", None, "s3")]
    for order in (rows, rows[::-1]):
        kept = stages.near_duplicates(spark, spark.createDataFrame(order, SCHEMA), sf).collect()
        assert [r["source"] for r in kept] == ["s1"]


def test_mixing_keeps_equal_rows_of_different_sources(spark, sf):
    rows = [doc(i, prose(i, 30), "en", s) for s in ("s0", "s1", None) for i in range(50)]
    mixed = stages.mixing(spark, spark.createDataFrame(rows, SCHEMA), sf).collect()
    taken = Counter()
    for r in mixed:
        taken[r["source"]] += len(r["text"].split())
    sizes = {s: 50 * 30 for s in ("s0", "s1", None)}
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 30


def test_mixing_repeats_documents(spark, sf):
    frame = spark.createDataFrame([doc(i, prose(i, 30 + i % 7), "en", f"s{i % 4}") for i in range(120)], SCHEMA)
    mixed = rows_of(stages.mixing(spark, frame, sf))
    sizes, taken = Counter(), Counter()
    for r in frame.collect():
        sizes[r["source"]] += len(r["text"].split())
        taken[r["source"]] += len(r["text"].split()) * mixed[tuple(r)]
    for source, target in plain_targets(sizes).items():
        assert abs(taken[source] - target) <= 20
    assert max(mixed.values()) == 2


def test_run_equals_its_stages(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, sf)
    got = corpus_pipeline.run(spark, sf)
    columns = [c for c in got.columns if c not in ("sequence_id", "offset")]
    assert rows_of(got.select(columns)) == rows_of(docs.select(columns)) and got.count() > 0
