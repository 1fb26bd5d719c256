"""The stages of the corpus pipeline: each applies one operator to all that the stage before kept.

Verdicts come back to the documents by id and the digest of the text, nulls matching nulls, so that
they also fit tables with repeated or null ids. Null and empty texts, ties and empty tables are as the
operators define them; other columns pass through untouched.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import mixing as mixes
from tidemark.llm import near_duplicates as near
from tidemark.llm import packing as packs
from tidemark.llm import quality_classifier as classifier
from tidemark.llm import quality_rules as rules
from tidemark.llm.common import table
from tidemark.llm.queries import END_ID, SEQUENCE, tokenizer_path


def _digest() -> Column:
    return F.sha2(F.col("text"), 256)


def _matching(docs: DataFrame, verdicts: DataFrame, names: list[str]) -> tuple[DataFrame, Column]:
    """The verdicts under names that cannot clash, and the condition that joins them to the documents."""
    renamed = verdicts.select([F.col(c).alias(f"_v_{c}") for c in verdicts.columns])
    pairs = [(F.col(n), n) for n in names] + [(_digest(), "digest")]
    return renamed, reduce(lambda a, b: a & b, [c.eqNullSafe(F.col(f"_v_{n}")) for c, n in pairs])


def _without(docs: DataFrame, rejected: DataFrame, names: list[str]) -> DataFrame:
    renamed, same = _matching(docs, rejected.select(*names, "digest").distinct(), names)
    return docs.join(renamed, same, "left_anti")


def _once(docs: DataFrame, names: list[str]) -> DataFrame:
    """The documents with one row for each text under equal names: the first by source and language. Only
    repeated rows, most often none, are compared."""
    repeated = docs.select(*names, _digest().alias("digest")).groupBy(*names, "digest").count().where("count > 1").drop("count")
    if repeated.isEmpty():
        return docs
    renamed, same = _matching(docs, repeated, names)
    single = docs.join(renamed, same, "left_anti")
    several = docs.join(renamed, same, "left_semi")
    order = F.struct(*[x for c in ("source", "lang") for x in (F.col(c).isNull().alias(f"no_{c}"), F.col(c))])
    first = several.groupBy(*[F.col(n).alias(f"_v_{n}") for n in names], _digest().alias("_v_digest")).agg(F.min_by(F.struct(*docs.columns), order).alias("_v_row"))
    return single.unionByName(first.select("_v_row.*"))


def _keyed(docs: DataFrame) -> DataFrame:
    """Adds `_v_key`, a number for each different text under an id: the id itself for the first of its texts by digest, else a
    number beyond all usual ids made from id and text, so that a row with a usual id comes before rows with none."""
    made = F.xxhash64(F.coalesce(F.col("text"), F.lit("")), "doc_id").bitwiseAND(F.lit((1 << 62) - 1)) + F.lit(1 << 62)
    texts = docs.where("doc_id is not null").select("doc_id", _digest().alias("digest"))
    spread = texts.groupBy("doc_id").agg(F.min(F.coalesce("digest", F.lit(""))).alias("_v_first"), F.max(F.coalesce("digest", F.lit(""))).alias("_v_last"))
    shared = spread.where("_v_first <> _v_last").select(F.col("doc_id").alias("_v_id"), "_v_first")
    if shared.isEmpty():
        return docs.withColumn("_v_key", F.coalesce("doc_id", made))
    named = docs.join(shared, F.col("doc_id") == F.col("_v_id"), "left")
    later = F.coalesce(F.coalesce(_digest(), F.lit("")) != F.col("_v_first"), F.lit(False))
    return named.select(*docs.columns, F.when(F.col("doc_id").isNull() | later, made).otherwise(F.col("doc_id")).alias("_v_key"))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the quality rules."""
    names = ["doc_id", "lang", "source"]
    marked = docs.select(*names, "text", _digest().alias("digest"))
    return _without(docs, rules.judge(marked, [*names, "digest"]).where("not kept"), names)


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.5 or more for quality."""
    marked = docs.select("doc_id", "text", _digest().alias("digest"))
    scored = classifier.score(marked, table(spark, sf_dir, "labels"), ["doc_id", "digest"])
    return _without(docs, scored.where("predicted = 0"), ["doc_id"])


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group: that with the least id. Rows without an id and further texts under one id are documents
    of their own and come after rows with an id; of rows with equal ids and texts the first by source and language stays."""
    keyed = _keyed(docs)
    found = near.near_duplicates(keyed.select(F.col("_v_key").alias("doc_id"), "text"), size=5, percent=80)
    dropped = found.where("not kept").select(F.col("doc_id").alias("_v_dropped")).distinct()
    return _once(keyed.join(dropped, F.col("_v_key") == F.col("_v_dropped"), "left_anti").select(docs.columns), ["doc_id"])


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it; rows with equal id, source and text are taken together."""
    marked = docs.select("doc_id", "source", "text", _digest().alias("digest"))
    taken = mixes.mix(marked, keep=["digest"])
    names = ["doc_id", "source"]
    copies = taken.groupBy(*names, "digest").agg(F.sum("copies").alias("copies")).where("copies > 0")
    renamed, same = _matching(docs, copies, names)
    rows = _once(docs, names).join(renamed, same)
    return rows.select(*docs.columns, F.explode(F.sequence(F.lit(1), F.col("_v_copies").cast("int"))).alias("_v_copy")).drop("_v_copy")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the mixed documents with their places in sequences."""
    cut = packs.pieces(docs.select("doc_id", "text"), tokenizer_path("byte_bpe_50k.json"), END_ID, SEQUENCE)
    return packs.pack(cut, SEQUENCE)
