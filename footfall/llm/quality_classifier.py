"""Quality score: a regularised quadratic discriminant over statistics of whole texts."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from footfall.llm.common import stage, texts_of
from footfall.llm.quality_rules import STOP_WORDS

FEATURES = ("words", "word_length", "distinct", "repeats", "upper", "figures", "symbols", "marks",
            "stops", "line_words", "same_lines", "spread")
ACCEPT = 0.3

_UPPER = bytes(range(65, 91))
_FIGURES = bytes(range(48, 58))
_SYMBOLS = b"#*$%&|<>{}[]~^=_\\/@"
_MARKS = b".,;:!?"
_STOPS = frozenset(word.encode() for word in STOP_WORDS)


def statistics(text: bytes) -> tuple[float, ...]:
    """The document statistics of one whole text, each transformed to be nearer to normal.

    Shares go through the square root, counts through the logarithm. All are finite for every
    text; an empty text has 0 words, and its shares are 0.
    """
    size = max(1, len(text))
    words = text.split()
    n = max(1, len(words))
    lines = [line for line in text.split(b"\n") if line.strip()]
    distinct = len(set(words))

    def share(chars: bytes) -> float:
        return ((len(text) - len(text.translate(None, chars))) / size) ** 0.5

    histogram = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    used = histogram[histogram > 0] / size
    return (
        float(np.log1p(len(words))),
        float(np.log1p(sum(map(len, words)) / n)),
        float(np.log1p(distinct) / np.log1p(n)),
        (sum(map(eq, words, words[1:])) / n) ** 0.5,
        share(_UPPER), share(_FIGURES), share(_SYMBOLS), share(_MARKS),
        (sum(map(_STOPS.__contains__, text.lower().split())) / n) ** 0.5,
        float(np.log1p(len(words) / max(1, len(lines)))),
        ((len(lines) - len(set(lines))) / max(1, len(lines))) ** 0.5,
        float(-(used * np.log2(used)).sum()),
    )


def document_statistics(documents: DataFrame, text: str = "text") -> DataFrame:
    """``doc_id`` and the statistics, one row per row, staged: later steps never see a text."""
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            rows = np.array([statistics(value) for value in texts_of(batch.column(1))],
                            np.float64).reshape(-1, len(FEATURES))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *(pa.array(column) for column in rows.T)],
                names=["doc_id", *FEATURES])

    kind = documents.schema["doc_id"].dataType.simpleString()
    fields = ", ".join([f"doc_id {kind}", *(f"{name} DOUBLE" for name in FEATURES)])
    narrow = documents.select("doc_id", F.col(text).cast("string").alias("text"))
    return stage(narrow.mapInArrow(run, fields), "statistics")


@dataclass(frozen=True)
class Discriminant:
    """Two normal densities. ``factors`` are the lower Cholesky factors of their covariances."""

    means: np.ndarray
    factors: np.ndarray
    log_scale: np.ndarray
    temper: float

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The share of class 1, from the difference of the log-densities of both classes."""
        densities = []
        for mean, factor, scale in zip(self.means, self.factors, self.log_scale):
            y = np.linalg.solve(factor, (x - mean).T)
            densities.append(scale - 0.5 * (y * y).sum(axis=0))
        margin = np.clip((densities[1] - densities[0]) * self.temper, -60, 60)
        return 1 / (1 + np.exp(-margin))


def fit(labelled: DataFrame, label: str, shrinkage: float = 0.1, floor: float = 1e-3,
        temper: float = 0.5) -> Discriminant | None:
    """Fit the discriminant on all rows of ``labelled``; None if a class has fewer than two rows.

    Spark adds up counts, sums and products of pairs, so two rows reach the driver however many are
    labelled. Each class covariance is drawn by ``shrinkage`` toward the diagonal of the pooled one,
    and every variance is at least ``floor`` of the widest possible unit spread.
    """
    d = len(FEATURES)
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    sums = labelled.groupBy(F.col(label).cast("int").alias("label")).agg(
        F.count(F.lit(1)).alias("n"),
        *(F.sum(name).alias(f"s{i}") for i, name in enumerate(FEATURES)),
        *(F.sum(F.col(FEATURES[i]) * F.col(FEATURES[j])).alias(f"p{i}_{j}") for i, j in pairs))
    found = {row["label"]: row for row in sums.filter(F.col("label").isin(0, 1)).collect()}
    if any(found.get(c) is None or found[c]["n"] < 2 for c in (0, 1)):
        return None
    counts = np.array([found[c]["n"] for c in (0, 1)], float)
    means = np.array([[found[c][f"s{i}"] for i in range(d)] for c in (0, 1)]) / counts[:, None]
    products = np.zeros((2, d, d))
    for c in (0, 1):
        for i, j in pairs:
            products[c, i, j] = products[c, j, i] = found[c][f"p{i}_{j}"]
    own = products / counts[:, None, None] - means[:, :, None] * means[:, None, :]
    pooled = (counts[:, None, None] * own).sum(axis=0) / counts.sum()
    target = np.diag(np.maximum(np.diag(pooled), floor))
    shrunk = (1 - shrinkage) * own + shrinkage * target + floor * shrinkage * np.eye(d)
    factors = np.linalg.cholesky(shrunk)
    log_scale = np.log(counts / counts.sum()) - np.log(
        np.diagonal(factors, axis1=1, axis2=2)).sum(axis=1)
    return Discriminant(means, factors, log_scale, temper)


def score(features: DataFrame, model: Discriminant | None) -> DataFrame:
    """``doc_id`` and ``score``; without a model every score is 0.5."""
    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            x = np.column_stack([batch.column(name).to_numpy(zero_copy_only=False)
                                 for name in FEATURES])
            values = model.scores(x) if model and len(x) else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(values)],
                                             names=["doc_id", "score"])

    kind = features.schema["doc_id"].dataType.simpleString()
    return features.select("doc_id", *FEATURES).mapInArrow(run, f"doc_id {kind}, score DOUBLE")


def fold() -> F.Column:
    """Rows of fold 0 are held out. A null id has no fold and counts as held out."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5, F.lit(0))


def train(features: DataFrame, labels: DataFrame, label: str = "quality") -> Discriminant | None:
    """A model from the labelled rows outside fold 0. Null labels and labels without a document do
    not count; a label given twice counts twice."""
    known = labels.select("doc_id", F.col(label).alias("_label")).dropna()
    return fit(features.filter(fold() != 0).join(known, "doc_id"), "_label")


def accepted(documents: DataFrame, model: Discriminant | None, accept: float = ACCEPT,
             text: str = "text") -> DataFrame:
    """The rows of ``documents`` whose text scores ``accept`` or more, with all their columns. Nothing
    is shuffled; without a model all rows stay."""
    if model is None:
        return documents

    def run(batches: Iterator) -> Iterator:
        for batch in batches:
            x = np.array([statistics(value) for value in texts_of(batch.column(text))],
                         np.float64).reshape(-1, len(FEATURES))
            kept = model.scores(x) >= accept if len(x) else np.zeros(0, bool)
            yield batch.filter(pa.array(kept))

    return documents.mapInArrow(run, documents.schema)


def quality_classifier(documents: DataFrame, labels: DataFrame, accept: float = ACCEPT,
                       label: str = "quality", text: str = "text") -> DataFrame:
    """Score every whole text, one row per row of ``documents``.

    Labels, language, source and id never enter a score. A null text is scored as an empty one, rows
    that repeat each get their score, an empty table gives no row, and without labels of both
    classes every score is 0.5. Further columns are ignored.
    """
    features = document_statistics(documents, text)
    scored = score(features, train(features, labels, label))
    return scored.select("doc_id", (fold() == 0).alias("held_out"), "score",
                         (F.col("score") >= accept).cast("int").alias("predicted"))
