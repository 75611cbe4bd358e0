"""Quality rules: a table of thresholds compiled into one projection of built-in functions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from footfall.llm.common import named

SPACE = r"[\x20\x09-\x0D]"
SPACE_CHARS = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
LEAST_WORDS = 20
MOST_REPEATED_PERCENT = 30

# Frequent function words of the four languages.
STOP_WORDS = (
    "a", "an", "and", "are", "as", "by", "for", "from", "in", "is", "it", "of", "on", "or", "that",
    "the", "this", "to", "was", "with",
    "au", "avec", "ce", "dans", "de", "des", "du", "elle", "en", "est", "et", "la", "le", "les",
    "pas", "pour", "que", "qui", "sur", "un", "une",
    "auf", "aus", "bei", "das", "dem", "den", "der", "die", "ein", "eine", "ist", "mit", "nicht",
    "sich", "und", "von", "zu",
    "como", "con", "del", "el", "los", "no", "para", "por", "se", "su", "una",
)


@dataclass(frozen=True)
class Rule:
    """``low <= 1000 * numerator / denominator <= high``, in whole numbers; either side may be open.

    With a denominator of 0 a rule is kept.
    """

    name: str
    numerator: str
    denominator: str
    low: int | None = None
    high: int | None = None

    def kept(self) -> Column:
        share, whole = 1000 * F.col(self.numerator), F.col(self.denominator)
        result = F.lit(True)
        if self.low is not None:
            result = result & (share >= self.low * whole)
        if self.high is not None:
            result = result & (share <= self.high * whole)
        return (whole == 0) | result


RULES = (
    Rule("word_length", "word_chars", "n_words", 1500, 18000),
    Rule("symbols", "n_symbols", "word_chars", None, 100),
    Rule("shouting", "n_upper", "word_chars", None, 500),
    Rule("stop_words", "n_stop_words", "n_words", 20, None),
    Rule("same_lines", "n_dup_lines", "n_lines", None, 500),
    Rule("same_words", "n_repeat_words", "n_words", None, 1000 * MOST_REPEATED_PERCENT // 100),
)


def repeated_words(words: Column) -> Column:
    """How many words lie in windows of eight words that occur twice or more in the text.

    A window is known by its 64-bit hash. Texts whose windows all differ, most of them, are done
    after one pass; in others the windows are sorted once, so the cost is n log n in the words.
    """
    none = F.lit(0).cast("bigint")

    def covered(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        again = named(pairs, lambda s: F.filter(
            F.transform(s, lambda e, i: F.when(
                (F.get(s, i - 1)["h"] == e["h"]) | (F.get(s, i + 1)["h"] == e["h"]), e["i"])),
            lambda x: x.isNotNull()))
        start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).cast("bigint").alias("n"))
        return F.aggregate(
            F.sort_array(again), start,
            lambda a, x: F.struct(x.alias("last"),
                                  (a["n"] + F.least(F.lit(WINDOW), x - a["last"])).alias("n")),
            lambda a: a["n"])

    windows = F.transform(F.sequence(F.lit(1), F.size(words) - WINDOW + 1),
                          lambda i: F.xxhash64(F.slice(words, i, WINDOW)))
    counted = named(windows, lambda h: F.when(
        F.size(F.array_distinct(h)) < F.size(h), covered(h)).otherwise(none))
    return F.when(F.size(words) > WINDOW, counted).otherwise(none)


def text_statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """``documents`` as ``doc_id`` and the counts that the rules compare."""
    value = F.coalesce(F.col(text).cast("string"), F.lit(""))

    def count(chars: str) -> Column:
        return (F.length("t") - F.length(F.translate("t", chars, ""))).cast("bigint")

    stops = list(STOP_WORDS)
    lines = F.filter(F.split(F.col("t"), "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    words = F.filter(F.split(F.col("t"), SPACE + "+"), lambda w: w != "")
    upper = F.length("t") - F.length(F.regexp_replace("t", r"\p{Lu}", ""))
    of_words = named(words, lambda w: F.struct(
        F.size(w).cast("bigint").alias("n_words"),
        repeated_words(w).alias("n_repeat_words"),
        F.size(F.filter(w, lambda x: F.lower(x).isin(stops))).cast("bigint").alias("n_stop_words")))
    of_lines = named(lines, lambda x: F.struct(
        F.size(x).cast("bigint").alias("n_lines"),
        (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("n_dup_lines")))
    return (
        documents.select(F.col("doc_id"), value.alias("t"))
        .select(
            "doc_id", of_words.alias("w"), of_lines.alias("l"),
            F.length(F.translate("t", SPACE_CHARS, "")).cast("bigint").alias("word_chars"),
            count(SYMBOLS).alias("n_symbols"), upper.cast("bigint").alias("n_upper"))
        .select("doc_id", "w.n_words", "word_chars", "n_symbols", "l.n_dup_lines",
                "w.n_repeat_words", "l.n_lines", "w.n_stop_words", "n_upper")
    )


def quality_rules(documents: DataFrame, rules: tuple[Rule, ...] = RULES,
                  text: str = "text") -> DataFrame:
    """Counts, the base verdict and the verdict of the rule table, one row per row of ``documents``.

    A null text has no words; texts with fewer than 20 words or with more than 30 % of their words
    in repeated windows fail the base. Repeated rows and null ids each give their own row, an empty
    table gives none, further columns are ignored. No row moves between partitions.
    """
    counts = text_statistics(documents, text)
    failed = (F.col("n_words") < LEAST_WORDS) | (
        100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))
    broken = F.filter(F.array(*[F.when(~rule.kept(), F.lit(rule.name)) for rule in rules]),
                      lambda x: x.isNotNull())
    return (
        counts.withColumn("base_failed", failed)
        .withColumn("broken_rules", F.array_join(broken, ","))
        .withColumn("kept", ~F.col("base_failed") & (F.col("broken_rules") == ""))
    )
