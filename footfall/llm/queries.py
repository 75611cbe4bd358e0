"""The queries of the corpus operators: each runs its operator over its whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from footfall.llm import quality_classifier as classifier
from footfall.llm.best_fit_packing import best_fit_packing
from footfall.llm.common import table
from footfall.llm.decontamination import decontamination
from footfall.llm.fill_in_middle import digests
from footfall.llm.jaccard_join import jaccard_join
from footfall.llm.lm_scoring import lm_scoring
from footfall.llm.personal_data import personal_data
from footfall.llm.quality_rules import quality_rules
from footfall.llm.secret_scan import secret_scan
from footfall.llm.suffix_dedup import suffix_dedup
from footfall.llm.token_alignment import token_alignment
from footfall.llm.token_files import token_files
from footfall.llm.warc import warc

VOCABULARY = public_tokenizers.path("word_bpe_49k.json")
BYTE_LEVEL, PIECES = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))


def op1_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"))


def op2_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan(table(spark, sf_dir, "documents"))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classifier.quality_classifier(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return best_fit_packing(table(spark, sf_dir, "documents"), VOCABULARY)


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The segments of the token files, read back from them."""
    return token_files(table(spark, sf_dir, "documents"), VOCABULARY)


def op7_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join(table(spark, sf_dir, "documents"))


def op8_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return personal_data(table(spark, sf_dir, "documents"))


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the archives hold, in the order of the index."""
    return warc(table(spark, sf_dir, "pages")).drop("url_key", "captured")


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"))


def op11_hidden_markov(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring(table(spark, sf_dir, "documents"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(table(spark, sf_dir, "documents"))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment(table(spark, sf_dir, "documents"), BYTE_LEVEL, PIECES)


QUERIES = {run.__name__: run for run in (
    op1_quality_rules, op2_secret_scan, op3_quality_classifier, op4_decontamination,
    op5_best_fit_packing, op6_token_files, op7_jaccard_join,
    op8_personal_data, op9_warc, op10_suffix_dedup,
    op11_hidden_markov, op12_fill_in_middle, op13_token_alignment,
)}
