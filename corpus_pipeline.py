"""The corpus pipeline: raw documents to packed training sequences, one operator a stage."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from footfall.llm import quality_classifier as classifier
from footfall.llm.best_fit_packing import best_fit_packing
from footfall.llm.common import settled, stage, table, unused_name
from footfall.llm.decontamination import decontamination
from footfall.llm.jaccard_join import jaccard_join
from footfall.llm.personal_data import masked_documents
from footfall.llm.queries import VOCABULARY

#: Documents are similar in the pipeline as in ``op7_jaccard_join``: words a shingle, and least percent.
SIMILAR_SIZE, SIMILAR_PERCENT = 4, 85

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def with_rows(docs: DataFrame, label: str) -> tuple[DataFrame, str]:
    """``docs`` with a number for every row, as ids may repeat or be null; staged, so it stays. Also
    the number's column, which is none that ``docs`` has."""
    name = unused_name(docs, "row")
    return stage(docs.withColumn(name, F.monotonically_increasing_id()), label), name


def keep_rows(rows: DataFrame, name: str, kept: DataFrame) -> DataFrame:
    """The rows whose numbers are kept, by one and the same plan whatever the size."""
    return rows.join(kept.hint("merge"), name, "left_semi").drop(name)


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects, row by row. Labels are found by id."""
    labels = table(spark, sf_dir, "labels")
    model = classifier.train(classifier.document_statistics(docs), labels)
    return classifier.accepted(docs, model)


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents keep the one with the smallest id, nulls last; of rows with
    one id, the first.

    The stage is op7 within the pipeline, so op7's rule holds for it too: shingles of 4 words, 85 %. A
    looser rule would drop documents that the query reports as unlike."""
    rows, row = with_rows(docs, "similar")
    key = F.struct(F.col("doc_id").isNull().alias("late"), "doc_id", F.col(row).alias("row"))
    kept = settled(
        lambda: jaccard_join(rows.select(key.alias("doc_id"), "text"), SIMILAR_SIZE, SIMILAR_PERCENT)
        .filter("doc_id = component_id").select(F.col("doc_id.row").alias(row)), "kept")
    return keep_rows(rows, row, kept)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents of which benchmark passages make up a twentieth or more."""
    rows, row = with_rows(docs, "contaminated")
    kept = settled(
        lambda: decontamination(rows.select(F.col(row).alias("doc_id"), "text"),
                                table(spark, sf_dir, "benchmark"))
        .filter("NOT contaminated").select(F.col("doc_id").alias(row)), "kept")
    return keep_rows(rows, row, kept)


def mask_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Put the kind in place of each piece of personal data, and count such texts' characters anew."""
    changed = unused_name(docs, "masked")
    masked = masked_documents(docs, changed=changed)
    if "n_chars" not in docs.columns:
        return masked.drop(changed)
    size = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.withColumn("n_chars", F.when(F.col(changed), size).otherwise(F.col("n_chars"))
                             ).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place the ids of all documents that are left in as few sequences as can be found."""
    return best_fit_packing(docs, VOCABULARY)


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", keep_quality),
    ("jaccard_join", keep_one_of_similar),
    ("decontamination", drop_contaminated),
    ("personal_data", mask_personal_data),
    ("best_fit_packing", pack),
]

#: A trained classifier and tagger, tokens and packing are beyond SQL; the tests compare every stage
#: with a brute-force version instead.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``; each result is written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, apply in STAGES[:-1]:
        docs = stage(apply(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
