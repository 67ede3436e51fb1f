"""Preparing a training corpus: five stages from raw documents to token ids."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from specloom.llm.decontaminate import without_copies
from specloom.llm.jaccard_join import jaccard_classes
from specloom.llm.line_dedup import line_dedup
from specloom.llm.merge_dropout import encode
from specloom.llm.runtime import prepared, quoted
from specloom.llm.toxicity import without_toxic
from specloom.session import materialise


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator doesn't reject."""
    prepared(spark)
    return without_toxic(docs, _table(spark, sf_dir, "labels"))


def delete_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, without later repeated runs of lines; n_chars follows the text."""
    prepared(spark)
    new = line_dedup(docs).drop("n_lines", "n_removed")
    if "n_chars" in docs.columns:
        new = new.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))
    return new.select(*map(quoted, docs.columns))


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, with the smallest doc_id, of each group of near duplicates.

    Rows repeated under one doc_id are one document, so one of them stays.
    Documents without words stay, and so do rows without a doc_id.
    """
    prepared(spark)
    classes = materialise(jaccard_classes(docs), "pipeline-classes")
    gone = classes.filter("component_id <> doc_id").select("doc_id").distinct()
    kept = docs.join(gone, "doc_id", "left_anti").select(*map(quoted, docs.columns))
    repeated = classes.filter("doc_id is not null").groupBy("doc_id").count().filter("count > 1").select("doc_id")
    if repeated.isEmpty():
        return kept
    single = kept.join(repeated, "doc_id", "left_anti").select(*map(quoted, docs.columns))
    return single.unionByName(kept.join(repeated, "doc_id", "left_semi").dropDuplicates(["doc_id"]).select(*map(quoted, docs.columns)))


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a copy of a benchmark item."""
    prepared(spark)
    return without_copies(docs, _table(spark, sf_dir, "benchmark"))


def encode_pieces(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, n_tokens, ids, round_trip) of each document."""
    prepared(spark)
    return encode(docs, check=True)


STAGES = [
    ("toxicity", reject_toxic),
    ("line_dedup", delete_repeated_lines),
    ("ngram_jaccard_join", keep_one_of_each),
    ("benchmark_decontamination", reject_contaminated),
    ("sentencepiece_merge_dropout", encode_pieces),
]

# Trees and alignment have no SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each keeps is written for the next."""
    docs = _table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialise(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
