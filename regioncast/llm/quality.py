"""Quality classifier: regularised quadratic discriminant over document statistics.

Each class has a mean and a covariance that is shrunk towards the classes' common one and towards a sphere.  A score is the
difference of the two Gaussian log-densities, taken from Mahalanobis distances with Cholesky factors that are computed once and sent
to the workers.  The moments are sums over all labelled training rows, partial before the shuffle, so nothing is sampled.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regioncast.llm.common import crc_of_id, stored
from regioncast.llm.doc_stats import STATS, document_stats

#: Shares of the common covariance and of the sphere in each class's covariance.
SHRINK_COMMON, SHRINK_SPHERE = 0.1, 0.02
#: Words added to every text before ratios are taken.
PRIOR = 10

X = tuple(f"x{i}" for i in range(9))
D = len(X)


def vector() -> list[F.Column]:
    """Transformed statistics: length, word length, symbols, capitals, digits, repeated lines, repeated words, stutter, distinct words."""
    c = F.col
    words, chars = c("n_words") + PRIOR, c("word_chars") + 5 * PRIOR
    return [
        F.log(words), F.log(chars / words), F.sqrt(c("n_symbols") / chars), F.sqrt(c("n_upper") / chars), F.sqrt(c("n_digits") / chars),
        F.sqrt(c("n_dup_lines") / (c("n_lines") + 2)), F.sqrt(c("n_repeat_words") / words), F.sqrt(c("n_adjacent") / words),
        F.log((c("n_distinct") + PRIOR) / words) / F.log(words),
    ]


@dataclass
class Discriminant:
    """Two Gaussians: for each class its mean, inverse Cholesky factor and constant."""

    means: list[np.ndarray]
    factors: list[np.ndarray]
    constants: list[float]

    @classmethod
    def fit(cls, counts: list[float], sums: list[np.ndarray], products: list[np.ndarray]) -> "Discriminant":
        means = [s / n for s, n in zip(sums, counts)]
        own = [p / n - np.outer(m, m) for p, n, m in zip(products, counts, means)]
        common = sum(n * c for n, c in zip(counts, own)) / sum(counts)
        factors, constants = [], []
        for n, cov in zip(counts, own):
            cov = (1 - SHRINK_COMMON) * cov + SHRINK_COMMON * common
            cov = (1 - SHRINK_SPHERE) * cov + (SHRINK_SPHERE * np.trace(cov) / D + 1e-9) * np.eye(D)
            lower = np.linalg.cholesky(cov)
            factors.append(np.linalg.inv(lower))
            constants.append(float(np.log(n / sum(counts)) - np.log(np.diag(lower)).sum()))
        return cls(means, factors, constants)

    def log_odds(self, x: np.ndarray) -> np.ndarray:
        """Log-density of class 1 less that of class 0, priors included."""
        density = [c - 0.5 * np.square((x - m) @ f.T).sum(axis=1) for m, f, c in zip(self.means, self.factors, self.constants)]
        return density[1] - density[0]

    def score(self, x: np.ndarray) -> np.ndarray:
        """0 to 1.  Statistics depend on each other beyond covariances, so log-odds are divided by their number."""
        return 1 / (1 + np.exp(-np.clip(self.log_odds(x) / D, -30, 30)))


def fit_discriminant(train: DataFrame, label: str) -> Discriminant | None:
    """The discriminant of rows (``label`` 0 or 1, `X`); None unless both classes have rows."""
    pairs = [(i, j) for i in range(D) for j in range(i, D)]
    got = train.where(F.col(label).isin(0, 1)).groupBy(label).agg(
        F.count("*").alias("n"), *(F.sum(x).alias(f"s{i}") for i, x in enumerate(X)),
        *(F.sum(F.col(X[i]) * F.col(X[j])).alias(f"p{i}_{j}") for i, j in pairs)).orderBy(label).collect()
    if len(got) < 2:
        return None
    products = []
    for r in got:
        p = np.zeros((D, D))
        for i, j in pairs:
            p[i, j] = p[j, i] = r[f"p{i}_{j}"]
        products.append(p)
    return Discriminant.fit([float(r.n) for r in got], [np.array([r[f"s{i}"] for i in range(D)]) for r in got], products)


def quality_scores(docs: DataFrame, labels: DataFrame, folds: int = 5, held_fold: int = 0, threshold: float = 0.3) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row of ``docs``.

    ``labels`` (doc_id, quality): only rows whose crc32(doc_id as text) mod ``folds`` is not ``held_fold`` are learned from; a document
    with several labels counts once for each.  Null and empty texts have zero statistics and get a score; a null doc_id is not held
    out and has no label; extra columns are ignored; with labels of fewer than two classes every score is 0.5.
    """
    stats = document_stats(docs).withColumns(dict(zip(X, vector())))
    held = F.coalesce(F.pmod(crc_of_id(F.col("doc_id")), F.lit(folds)) == held_fold, F.lit(False))
    stats = stored(stats.withColumn("held_out", held).drop(*STATS), "stats")
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("quality"))
    model = fit_discriminant(stats.where(~F.col("held_out")).join(known, "doc_id"), "quality")

    def apply(batches):
        for batch in batches:
            x = np.column_stack([batch.column(c).to_numpy() for c in X]) if batch.num_rows else np.zeros((0, D))
            score = model.score(x) if model else np.full(len(x), 0.5)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), batch.column("held_out"), pa.array(score), pa.array((score >= threshold).astype(np.int32))],
                                             names=["doc_id", "held_out", "score", "predicted"])

    return stats.mapInArrow(apply, "doc_id long, held_out boolean, score double, predicted int")
