"""Registered queries: each operator over the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from wayfleet.llm import (
    ballkmeans,
    decontaminate,
    discriminant,
    licenses,
    linerules,
    mtree,
    packing,
    pii,
    preferences,
    repeats,
    resampling,
    sharding,
    simhash,
)
from wayfleet.llm.work import stored

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_simhash_dedup(spark: SparkSession, folder: str) -> DataFrame:
    """Fingerprints of 3-word shingles and their components at 3 bits."""
    found = simhash.near_duplicates(_table(spark, folder, "documents"), simhash.exact())
    return found.select(
        "doc_id", F.lower(F.lpad(F.hex("f0"), 16, "0")).alias("fingerprint"), "component_id"
    )


def op2_label_propagation_sharding(spark: SparkSession, folder: str) -> DataFrame:
    """40 shards with counts at most one apart, copies together."""
    return sharding.sharded(_table(spark, folder, "documents"))


def op3_template_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    """Pairs of documents and benchmark items whose templates match."""
    return decontaminate.contaminated(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op4_preference_formatting(spark: SparkSession, folder: str) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) as pair k."""
    turns = _table(spark, folder, "conversations")
    ids = turns.select("conv_id").where("conv_id IS NOT NULL")
    pairs = ids.groupBy(F.floor(F.col("conv_id") / 2).cast("long").alias("pair_id")).agg(
        F.min("conv_id").alias("chosen_id"), F.max("conv_id").alias("rejected_id")
    ).where("chosen_id < rejected_id")
    found = preferences.formatted(turns, pairs)
    for side in ("chosen_mask", "rejected_mask"):
        spans = F.transform(side, lambda x: F.concat_ws(":", x["start"], x["end"]))
        found = found.withColumn(side, F.concat_ws(",", spans))
    return found


def _joined(spans: str):
    parts = F.transform(spans, lambda x: F.concat_ws(":", x["kind"], x["start"], x["end"]))
    return F.concat_ws(",", parts)


def op5_lstm_crf_pii(spark: SparkSession, folder: str) -> DataFrame:
    """Personal data: base matches and the tagger's additions."""
    docs = _table(spark, folder, "documents")
    found = pii.with_spans(docs, pii.fit(docs), ["doc_id"])

    def number(kind: str):
        return F.size(F.filter("base", lambda x: x["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id",
        *[number(kind) for kind in pii.KINDS],
        F.sha2(_joined("base"), 256).alias("base_sha256"),
        _joined("spans").alias("spans"),
    )


def op6_suffix_repeats(spark: SparkSession, folder: str) -> DataFrame:
    """What is left of each text without its repeated 200-byte strings."""
    found = repeats.without_repeats(_table(spark, folder, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_line_frequency_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics and verdict of every document; hosts are sources."""
    return linerules.judged(_table(spark, folder, "documents"))


def op8_quadratic_discriminant(spark: SparkSession, folder: str) -> DataFrame:
    """Quality scores of all documents, learned without the held-out fold."""
    docs = _table(spark, folder, "documents")
    rows, _ = stored(discriminant.with_statistics(docs, ["doc_id"]), "statistics")
    model = discriminant.fit(rows, _table(spark, folder, "labels"))
    return discriminant.with_scores(rows, model).select(
        "doc_id",
        discriminant.held_out().alias("held_out"),
        "score",
        (F.col("score") >= discriminant.THRESHOLD).cast("int").alias("predicted"),
    )


def op9_licence_sentence_rules(spark: SparkSession, folder: str) -> DataFrame:
    """Licences stated in the documents."""
    return licenses.licences(_table(spark, folder, "documents"))


def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    """Where each piece of each document is packed."""
    return packing.packed(_table(spark, folder, "documents"))


def op11_mtree_top_k(spark: SparkSession, folder: str) -> DataFrame:
    """The five largest inner products of every 50th vector with all others."""
    return mtree.top_of_table(_table(spark, folder, "embeddings"))


def op12_overlapped_scan_resampling(spark: SparkSession, folder: str) -> DataFrame:
    """Weights of all documents towards the benchmark, and the draw."""
    return resampling.resampled(_table(spark, folder, "documents"), _table(spark, folder, "benchmark"))


def op13_ball_kmeans_codes(spark: SparkSession, folder: str) -> DataFrame:
    """Every vector as four bytes, with its error."""
    return ballkmeans.coded_table(_table(spark, folder, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        f.__name__: f
        for f in (
            op1_simhash_dedup,
            op2_label_propagation_sharding,
            op3_template_decontamination,
            op4_preference_formatting,
            op5_lstm_crf_pii,
            op6_suffix_repeats,
            op7_line_frequency_rules,
            op8_quadratic_discriminant,
            op9_licence_sentence_rules,
            op10_best_fit_packing,
            op11_mtree_top_k,
            op12_overlapped_scan_resampling,
            op13_ball_kmeans_codes,
        )
    }
