"""Quality rules by robust multivariate outliers.

Every document's statistics are turned into a short vector.  For each language and source a minimum-covariance-determinant
estimate is made of the vectors: concentration steps take the share `CORE` of rows nearest to the current centre and
compute mean and covariance of exactly these rows again, until the determinant stops falling, for each group and start by itself.  Two
starts are made (coordinatewise medians, and mean with full covariance), and the smaller determinant wins.  A document whose Mahalanobis distance is over the
cutoff is rejected.

Rows never meet by group: a step is two aggregates over all rows (a quantile sketch of the distances, then counts, sums and products), both
partial before the shuffle, so a source with a third of all rows is no hot spot.  Estimates are made of all rows, of each language and of each
language and source.  A language's is shrunk towards that of all rows and a source's towards its language's, with the weight of `SHRINK`
rows (mean, covariance with the spread of the two centres, and scale), so a group of any size is judged, and the fewer its rows the more by its parent.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from regioncast.llm.common import stored
from regioncast.llm.doc_stats import document_stats

#: Share of a group's rows that the estimate is made of.
CORE = 0.75
#: Rows that a parent's estimate counts for in that of its part.
SHRINK = 200
#: Fall of a log-determinant under which a group's start has settled.  The floors bound it from below, so every start settles.
SETTLED = 1e-6
#: Share of regular rows beyond the cutoff if vectors were normal.
TAIL = 1e-9
#: Smallest standard deviations of the coordinates: statistics that are the same in nearly all texts have no spread of their own.  Symbols
#: are the narrowest; a repeated line or passage is common in good texts.
FLOORS = (0.08, 0.03, 0.12, 0.12, 0.05)
#: Words, and characters, lines in proportion, added to every text before ratios are taken, so short texts stay near the middle.
PRIOR = 40

X = ("x0", "x1", "x2", "x3", "x4")
D = len(X)
_KEY = ["lang_key", "source_key"]


def vector() -> list[F.Column]:
    """Transformed statistics: word length, symbols, repeated lines, repeated words, distinct words."""
    c = F.col
    chars = c("word_chars") + 5 * PRIOR
    words = c("n_words") + PRIOR
    return [
        F.log(chars / words),
        F.sqrt(c("n_symbols") / chars),
        F.sqrt(c("n_dup_lines") / (c("n_lines") + 8)),
        F.sqrt(c("n_repeat_words") / words),
        F.log((c("n_words") - c("n_adjacent") + PRIOR) / words),
    ]


def base_failed() -> F.Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def chi_square(p: float, d: int) -> float:
    """Quantile of the chi-square distribution with d degrees of freedom (bisection on its series)."""
    def below(x: float) -> float:
        a, term = d / 2, 1.0
        total, k = 1.0, 1
        while term > 1e-17 * total:
            term *= (x / 2) / (a + k)
            total += term
            k += 1
        return math.exp(a * math.log(x / 2) - x / 2 - math.lgamma(a + 1)) * total

    low, high = 1e-9, 10.0 * d + 200
    for _ in range(200):
        mid = (low + high) / 2
        low, high = (mid, high) if below(mid) < p else (low, mid)
    return low


def _fit(stats: DataFrame) -> DataFrame:
    """Rows (lang_key, source_key, start, n, det, mean, inverse) from rows (…, n, sums of x and of products)."""
    pairs = [(i, j) for i in range(D) for j in range(i, D)]

    def solve(batches):
        for batch in batches:
            t = batch.to_pydict()
            out = {k: t[k] for k in (*_KEY, "start", "n")} | {"det": [], "mean": [], "inverse": []}
            for r in range(batch.num_rows):
                n = t["n"][r]
                mean = np.array([t[f"s{i}"][r] for i in range(D)]) / n
                cov = np.zeros((D, D))
                for i, j in pairs:
                    cov[i, j] = cov[j, i] = t[f"p{i}{j}"][r] / n - mean[i] * mean[j]
                if t["start"][r] == 0 and t["plain"][r]:  # the first start has no covariances
                    cov = np.diag(np.diag(cov))
                cov += np.diag(np.square(FLOORS))
                out["det"].append(float(np.linalg.slogdet(cov)[1]))
                out["mean"].append(mean.tolist())
                out["inverse"].append(np.linalg.inv(cov).ravel().tolist())
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("lang_key", pa.string()), ("source_key", pa.string()), ("start", pa.int32()), ("n", pa.int64()), ("det", pa.float64()),
                ("mean", pa.list_(pa.float64())), ("inverse", pa.list_(pa.float64()))]))

    return stats.mapInArrow(solve, "lang_key string, source_key string, start int, n long, det double, mean array<double>, inverse array<double>")


def _sums(rows: DataFrame, plain: bool) -> DataFrame:
    sums = [F.sum(x).alias(f"s{i}") for i, x in enumerate(X)]
    products = [F.sum(F.col(X[i]) * F.col(X[j])).alias(f"p{i}{j}") for i in range(D) for j in range(i, D)]
    return rows.groupBy(*_KEY, "start").agg(F.count("*").alias("n"), *sums, *products).withColumn("plain", F.lit(plain))


def _distance() -> F.Column:
    """Squared Mahalanobis distance of the vector to the estimate in columns mean and inverse."""
    diff = [F.col(x) - F.col("mean")[i] for i, x in enumerate(X)]
    total = F.lit(0.0)
    for i in range(D):
        for j in range(D):
            total = total + diff[i] * diff[j] * F.col("inverse")[i * D + j]
    return total


def _measured(rows: DataFrame, fit: DataFrame) -> DataFrame:
    return rows.join(fit.drop("n", "det"), _KEY).withColumn("distance", _distance()).drop("mean", "inverse")


def mcd_estimates(rows: DataFrame, core: float = CORE) -> DataFrame:
    """(lang_key, source_key, mean, inverse, scale, n): the estimate of each group of ``rows`` (keys and `X`), n its rows.

    ``scale`` makes the median squared distance that of the normal distribution.
    """
    middle = rows.groupBy(*_KEY).agg(*(F.percentile_approx(x, 0.5, 10_000).alias(f"m_{x}") for x in X))
    spread = rows.join(stored(middle, "middle"), _KEY)
    near = [F.abs(F.col(x) - F.col(f"m_{x}")) for x in X]
    spread = spread.groupBy(*_KEY).agg(F.count("*").alias("n"), *(F.first(f"m_{x}").alias(f"m_{x}") for x in X), *(F.percentile_approx(v, 0.5, 10_000).alias(f"d_{x}") for x, v in zip(X, near)))
    # Median and median deviation, written as the sums that have this mean and variance.
    robust = spread.select(*_KEY, F.lit(0).alias("start"), "n", *(( F.col(f"m_{x}") * F.col("n")).alias(f"s{i}") for i, x in enumerate(X)),
                           *((F.col("n") * (F.col(f"m_{X[i]}") * F.col(f"m_{X[j]}") + (F.pow(1.4826 * F.col(f"d_{X[i]}"), 2) if i == j else F.lit(0.0)))).alias(f"p{i}{j}")
                             for i in range(D) for j in range(i, D)), F.lit(True).alias("plain"))
    both = robust.unionByName(_sums(rows.withColumn("start", F.lit(1)), plain=False))
    # A start's own determinant is of all rows, so falls count from the first step on.
    moving, settled = stored(_fit(both), "fit").withColumn("before", F.lit(None).cast("double")), []
    while not moving.isEmpty():
        near = _measured(rows, moving.drop("before"))
        cut = stored(near.groupBy(*_KEY, "start").agg(F.percentile_approx("distance", core, 10_000).alias("cut")), "cut")
        inner = near.join(cut, [*_KEY, "start"]).where("distance <= cut")
        last = moving.select(*_KEY, "start", F.when(F.lit(bool(settled)), F.col("det")).alias("before"))
        fit = stored(_fit(_sums(inner, plain=False)).join(last, [*_KEY, "start"]), "fit")
        falling = F.col("before").isNull() | (F.col("det") < F.col("before") - SETTLED)
        settled.append(fit.where(~falling).drop("before"))
        moving = fit.where(falling)
    fit = reduce(DataFrame.unionByName, settled) if settled else moving.drop("before")
    least = fit.groupBy(*_KEY).agg(F.min(F.struct("det", "start")).alias("pick"))
    chosen = stored(fit.join(least, _KEY).where("start = pick.start").drop("pick", "start"), "chosen")
    medians = _measured(rows, chosen).groupBy(*_KEY).agg(F.percentile_approx("distance", 0.5, 10_000).alias("median"), F.count("*").alias("n"))
    # Never narrower than the core's own covariance.
    scale = F.greatest(F.lit(1.0), F.col("median") / F.lit(chi_square(0.5, D)))
    return chosen.drop("n").join(medians, _KEY).select(*_KEY, "mean", "inverse", scale.alias("scale"), "n")


def shrunk_estimate(n: int, own: tuple, parent: tuple, weight: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(mean, inverse, scale) of a group of n rows with its parent's counted as ``weight`` rows; the spread of the two means is part of the covariance."""
    (mean, inverse, scale), (above, above_inverse, above_scale) = own, parent
    share = n / (n + weight)
    apart = mean - above
    cov = share * np.linalg.inv(inverse) + (1 - share) * np.linalg.inv(above_inverse) + share * (1 - share) * np.outer(apart, apart)
    return above + share * apart, np.linalg.inv(cov), float(scale ** share * above_scale ** (1 - share))


def _shrunk(pairs: DataFrame, weight: int) -> DataFrame:
    """The estimates, each shrunk towards that in the columns above_mean, above_inverse and above_scale."""
    def solve(batches: Iterator[pa.RecordBatch]):
        for batch in batches:
            t = batch.to_pydict()
            out = {k: t[k] for k in (*_KEY, "n")} | {"mean": [], "inverse": [], "scale": []}
            for r in range(batch.num_rows):
                own, parent = ((np.array(t[f"{c}mean"][r]), np.reshape(t[f"{c}inverse"][r], (D, D)), t[f"{c}scale"][r]) for c in ("", "above_"))
                mean, inverse, scale = shrunk_estimate(t["n"][r], own, parent, weight)
                out["mean"].append(mean.tolist())
                out["inverse"].append(inverse.ravel().tolist())
                out["scale"].append(scale)
            yield pa.RecordBatch.from_pydict(out, schema=pa.schema([
                ("lang_key", pa.string()), ("source_key", pa.string()), ("n", pa.int64()),
                ("mean", pa.list_(pa.float64())), ("inverse", pa.list_(pa.float64())), ("scale", pa.float64())]))

    return pairs.mapInArrow(solve, "lang_key string, source_key string, n long, mean array<double>, inverse array<double>, scale double")


def quality_rules(docs: DataFrame, shrink: int = SHRINK, tail: float = TAIL) -> DataFrame:
    """(doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, distance, kept) for every row.

    distance is the squared Mahalanobis distance over the cutoff (null for a language and source without rows that pass the base rules); kept
    is false for rows that fail the base rules or are farther than the cutoff.  Rows that fail the base rules take no part in the estimates.
    Null texts have no words; null lang and source are values like any other; rows that share an id are judged one by one; extra columns are
    ignored; no rows give no rows.
    """
    stats = document_stats(docs, "lang", "source").withColumns({x: v for x, v in zip(X, vector())}).withColumn("base_failed", base_failed())
    # The marker letter keeps null apart from texts, and the parents' empty keys apart from both.
    named = [F.coalesce(F.concat(F.lit("v"), F.col(c)), F.lit("n")) for c in ("lang", "source")]
    stats = stored(stats.withColumns(dict(zip(_KEY, named))), "stats")
    regular = stats.where("not base_failed")
    # Each row counts for its source, its language and all rows.
    own, lang, every = F.struct(*_KEY), F.struct("lang_key", F.lit("").alias("source_key")), F.struct(F.lit("").alias("lang_key"), F.lit("").alias("source_key"))
    groups = stored(regular.select(F.explode(F.array(own, lang, every)).alias("group"), *X).select("group.*", *X), "groups")
    estimates = stored(mcd_estimates(groups), "estimates")
    of_all, of_langs, of_sources = (estimates.where(w) for w in ("lang_key = ''", "lang_key != '' and source_key = ''", "source_key != ''"))
    parts = ("mean", "inverse", "scale")
    root = of_all.select(*parts).first()  # one row of 31 numbers
    top = {f"above_{c}": F.lit(root[c] if root else None) for c in parts}
    of_langs = stored(_shrunk(of_langs.withColumns(top), shrink), "shrunk")
    above = of_langs.select("lang_key", *(F.col(c).alias(f"above_{c}") for c in parts))
    of_sources = stored(_shrunk(of_sources.join(above, "lang_key"), shrink), "shrunk")
    cutoff = chi_square(1 - tail, D)
    judged = stats.join(of_sources.drop("n"), _KEY, "left").withColumn("distance", _distance() / F.col("scale") / F.lit(cutoff))
    kept = ~F.col("base_failed") & F.coalesce(F.col("distance") <= 1, F.lit(True))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "distance", kept.alias("kept"))
