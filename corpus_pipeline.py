"""Corpus pipeline: quality, near duplicates, benchmark leaks, personal data, packing.

Every stage works on all that the one before has kept.  Stages but the last
return the columns of ``documents``; texts and rows are what the stage decided.

No stage identifies a row by doc_id, which may be null or shared.  Ties and
repeated rows get equal verdicts, but for the one that near duplicates keep.
Null and empty texts pass through (as one group of near duplicates) unless the
classifier rejects them; texts may be of any length; an empty table of documents
gives empty results, of labels or benchmark items a stage that keeps all.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.llm import decontaminate, discriminant, packing, pii, simhash
from wayfleet.llm.work import broadcast_if_few, stored, unused

#: SQL can express neither the trained models nor the sequential packing.
ORACLE_SQL: str | None = None


def _columns_of(docs: DataFrame, rows: DataFrame) -> DataFrame:
    return rows.select(*[F.col(f"`{c}`") for c in docs.columns])


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quadratic discriminant, learned from the labels of
    this stage's own documents, predicts to be of good quality.

    Repeated rows are judged alike; with no labels nothing is rejected.  The
    statistics are stored before their moments are taken: two Python stages in
    one task would keep two workers, and all of an executor's workers stay."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    statistics, _ = stored(discriminant.with_statistics(docs, ["doc_id"]), "statistics")
    model = discriminant.fit(statistics, labels)
    return discriminant.accepted(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that SimHash links (three-word shingles, at
    most three differing bits): the one with the smallest doc_id.

    Rows are told apart by a number written with them, never by doc_id: rows
    without an id come after the others, and of rows that share the smallest id
    one stays.  Texts without a word are one group."""
    row = unused(docs, "row")
    rows, _ = stored(docs.withColumn(row, F.monotonically_increasing_id()), "rows")
    found = simhash.near_duplicates(rows.select(F.col(row).alias("doc_id"), "text"), simhash.exact())
    grouped = found.select(F.col("doc_id").alias("row"), F.col("component_id").alias("group")).join(
        rows.select(F.col(row).alias("row"), F.col("doc_id").alias("id")), "row"
    )
    grouped, _ = stored(grouped, "grouped")
    first = grouped.groupBy("group").agg(F.min(F.struct(F.isnull("id"), "id", "row")).alias("first"))
    gone, _ = stored(grouped.join(first.select("first.row"), "row", "left_anti").select(F.col("row").alias(row)), "gone")
    return _columns_of(docs, rows.join(broadcast_if_few(gone), row, "left_anti"))


def benchmark_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item's template; rows are judged by their texts."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, personal data replaced by its kind."""
    return pii.redacted(docs, pii.fit(docs))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Where each piece of each document goes: lane, bin, offset and size."""
    return packing.packed(docs)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality", quality),
    ("near_duplicates", near_duplicates),
    ("benchmark_leaks", benchmark_leaks),
    ("personal_data", personal_data),
    ("pack", pack),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages applied to ``documents``, each result written and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs, _ = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
