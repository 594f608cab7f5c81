"""Quality classifier: a regularised quadratic discriminant over statistics of the text.

Every text is reduced to a few transformed counts. The classes' means and covariances come from
moments summed over all labelled rows that are not held out. Each covariance is shrunk towards
the pooled one and then towards a multiple of the identity; its Cholesky factor is inverted once
and goes to the tasks, which score by the difference of the classes' log densities.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from starmart.llm.store import table, text_of, written

FEATURES = (
    "words", "word_length", "longest_word", "distinct_words", "top_word", "repeats_of_previous",
    "distinct_pairs", "symbols", "capitals", "digits", "stops", "exclamations", "commas",
    "repeated_lines", "line_length",
)
FOLDS = 5
THRESHOLD = 0.3

_SYMBOLS = np.frombuffer(b"#*$%&|<>@^~_=+{}[]\\/", np.uint8)


def statistics_of(text: str) -> list[float]:
    """The transformed statistics of one text, in the order of ``FEATURES``; all finite."""
    raw = text.encode()
    words = raw.split()
    lines = [line for line in raw.split(b"\n") if line.strip()]
    n, chars = len(words), len(raw)
    at = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    capitals, small = int(at[65:91].sum()), int(at[97:123].sum())
    seen = Counter(words)
    top = max(seen.values(), default=0)
    again = sum(a == b for a, b in zip(words, words[1:], strict=False))
    pairs = len(set(zip(words, words[1:], strict=False)))

    def share(part: float, whole: float) -> float:
        return float(np.log((part + 0.5) / (whole - part + 0.5)))

    return [
        float(np.log1p(n)),
        float(np.log1p(sum(map(len, words)) / max(n, 1))),
        float(np.log1p(max(map(len, words), default=0))),
        share(len(seen), n),
        share(top, n),
        share(again, n),
        share(pairs, max(n - 1, 0)),
        share(int(at[_SYMBOLS].sum()), chars),
        share(capitals, capitals + small),
        share(int(at[48:58].sum()), chars),
        share(int(at[46]), chars),
        share(int(at[33]), chars),
        share(int(at[44]), chars),
        share(len(lines) - len(set(lines)), len(lines)),
        float(np.log1p(n / max(len(lines), 1))),
    ]


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [statistics_of(t.as_py()) for t in batch.column(1)]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.list_(pa.float64()))], ["doc_id", "x"])


def measured(docs: DataFrame) -> DataFrame:
    """doc_id and the statistics of each text; a null text counts as empty."""
    texts = docs.select(F.col("doc_id").cast("long"), text_of().alias("text"))
    return texts.mapInArrow(_measure, "doc_id long, x array<double>")


def held_out(doc_id: Column) -> Column:
    """Whether a document is held out from learning; a null doc_id never is."""
    rest = F.crc32(doc_id.cast("string").cast("binary")) % FOLDS
    return F.coalesce(rest == 0, F.lit(False))


@dataclass(frozen=True)
class Discriminant:
    center: np.ndarray
    scale: np.ndarray
    means: np.ndarray  # by class
    whiten: np.ndarray  # by class: the inverse of the covariance's Cholesky factor
    offset: np.ndarray  # by class: log prior less half the log determinant

    def scores(self, x: np.ndarray) -> np.ndarray:
        """The probability of class 1."""
        z = (x - self.center) / self.scale
        log = [
            self.offset[k] - 0.5 * np.square((z - self.means[k]) @ self.whiten[k].T).sum(axis=1)
            for k in (0, 1)
        ]
        return 1 / (1 + np.exp(np.clip(log[0] - log[1], -60, 60)))


def _moments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        x = np.array(batch.column(1).to_pylist(), float).reshape(-1, len(FEATURES))
        x = np.hstack([np.ones((len(x), 1)), x])
        labels = batch.column(0).to_numpy(zero_copy_only=False)
        for k in (0, 1):
            own = x[labels == k]
            total[k] = total.get(k, 0) + own.T @ own
    for k, m in total.items():
        yield pa.RecordBatch.from_pydict(
            {"quality": pa.array([k], pa.int32()), "m": pa.array([m.ravel().tolist()], pa.list_(pa.float64()))})


def fit(
    statistics: DataFrame, labels: DataFrame, to_pooled: float = 0.2, to_identity: float = 0.05
) -> Discriminant | None:
    """Learn from all labelled rows that aren't held out; None unless both classes occur.

    Labels other than 0 and 1 are passed over. A doc_id with several rows among the labels, of one
    label or of both, counts once for each of them, as does each row of a repeated document. Only sums come to the driver: a matrix a class.
    """
    known = labels.where(F.col("quality").isin(0, 1) & ~held_out(F.col("doc_id"))).select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    rows = statistics.join(known, "doc_id").select("quality", "x")
    sums = (
        rows.mapInArrow(_moments, "quality int, m array<double>")
        .select("quality", F.posexplode("m").alias("at", "value"))
        .groupBy("quality", "at")
        .agg(F.sum("value").alias("value"))
        .collect()
    )
    d = len(FEATURES) + 1
    by_class = np.zeros((2, d * d))
    for r in sums:
        by_class[r["quality"], r["at"]] = r["value"]
    by_class = by_class.reshape(2, d, d)
    n = by_class[:, 0, 0]
    if n.min() < 1:
        return None
    whole = by_class.sum(axis=0)
    center = whole[0, 1:] / whole[0, 0]
    scale = np.sqrt(np.maximum(np.diag(whole)[1:] / whole[0, 0] - center**2, 1e-9))
    means = (by_class[:, 0, 1:] / n[:, None] - center) / scale
    scatter = []
    for k in (0, 1):
        mean = by_class[k, 0, 1:] / n[k]
        scatter.append((by_class[k, 1:, 1:] - n[k] * np.outer(mean, mean)) / np.outer(scale, scale))
    pooled = sum(scatter) / max(n.sum() - 2, 1)
    whiten, offset = [], []
    for k in (0, 1):
        # A class of few rows leans on the pooled covariance the more.
        weight = max(to_pooled, min(1.0, len(FEATURES) / n[k]))
        cov = (1 - weight) * scatter[k] / max(n[k] - 1, 1) + weight * pooled
        cov = (1 - to_identity) * cov + to_identity * max(np.trace(cov) / len(cov), 1e-6) * np.eye(len(cov))
        factor = np.linalg.cholesky(cov)
        whiten.append(np.linalg.inv(factor))
        offset.append(np.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(center, scale, means, np.array(whiten), np.array(offset))


def scored(statistics: DataFrame, model: Discriminant | None) -> DataFrame:
    """doc_id and score; 0.5 throughout without a model."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = np.array(batch.column(1).to_pylist(), float).reshape(-1, len(FEATURES))
            score = np.full(len(x), 0.5) if model is None else model.scores(x)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(score)], ["doc_id", "score"])

    return statistics.select("doc_id", "x").mapInArrow(run, "doc_id long, score double")


def classify(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """Every document's score and prediction; repeated rows and empty texts get theirs too."""
    statistics = written(measured(docs), "statistics")
    result = scored(statistics, fit(statistics, labels))
    return result.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
