"""Closed-form classifiers and regressors: group means and Gaussian naive Bayes.

Fitting is one aggregation; the fitted numbers (one per class and feature) become literals of a
projection while they are few, and matrices of a vectorised function when they are many.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidecast.operators.columns import col
from tidecast.operators.proba import best_place, proba_name

PLAIN = 512  # means that scoring may spell out in the plan


@dataclass(frozen=True)
class GaussianBayes:
    label: str
    features: tuple[str, ...]
    classes: tuple
    priors: tuple[float, ...]
    means: tuple[tuple[float, ...], ...]
    variances: tuple[tuple[float, ...], ...]

    @staticmethod
    def fit(df: DataFrame, label: str, features: Sequence[str], smoothing: float = 1e-9) -> "GaussianBayes":
        """Runs one aggregate job. Variances get ``smoothing`` times the largest one added."""
        moments = [F.avg(col(f)).alias(f"m{i}") for i, f in enumerate(features)]
        moments += [F.var_pop(col(f)).alias(f"v{i}") for i, f in enumerate(features)]
        rows = df.filter(col(label).isNotNull()).groupBy(col(label).alias("c")).agg(F.count("*").alias("n"), *moments)
        found = sorted(rows.collect(), key=lambda r: r.c)  # one row per class
        if not found:
            raise ValueError(f"label {label!r} has no values")
        total = sum(r.n for r in found)
        span = range(len(features))
        extra = smoothing * max(max((r[f"v{i}"] or 0.0) for i in span) for r in found) or smoothing
        return GaussianBayes(
            label,
            tuple(features),
            tuple(r.c for r in found),
            tuple(r.n / total for r in found),
            tuple(tuple(r[f"m{i}"] for i in span) for r in found),
            tuple(tuple((r[f"v{i}"] or 0.0) + extra for i in span) for r in found),
        )

    def predict_proba(self, df: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
        """(keys, label, one probability per class); a null feature is left out of the product.

        Up to PLAIN parameters scoring is compiled column arithmetic; more of them would swell the
        plan, and go to workers as matrices instead. Both give the same numbers.
        """
        few = len(self.classes) * len(self.features) <= PLAIN
        probabilities = self._compiled(df, keys) if few else self._by_matrix(df, keys)
        return probabilities.select(
            *map(col, keys),
            F.element_at(F.lit(list(self.classes)), best_place(F.col("_p"))).alias(self.label),
            *[F.col("_p")[i].alias(proba_name(c)) for i, c in enumerate(self.classes)],
        )

    def _compiled(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        values = [col(f).cast("double").alias(f"_x{i}") for i, f in enumerate(self.features)]
        scores = []
        for prior, means, variances in zip(self.priors, self.means, self.variances):
            score = F.lit(math.log(prior))
            for i, (m, v) in enumerate(zip(means, variances)):
                away = F.col(f"_x{i}") - F.lit(m)
                term = F.lit(-0.5 * math.log(2 * math.pi * v)) - away * away / F.lit(2 * v)
                score = score + F.coalesce(term, F.lit(0.0))
            scores.append(score)
        names = [f"_s{i}" for i in range(len(scores))]
        scored = df.select(*map(col, keys), *values).select(*map(col, keys), *[s.alias(n) for s, n in zip(scores, names)])
        scored = scored.withColumn("_top", F.greatest(*names) if len(names) > 1 else F.col(names[0]))
        scored = scored.select(*map(col, keys), *[F.exp(F.col(n) - F.col("_top")).alias(n) for n in names])
        total = sum((F.col(n) for n in names[1:]), F.col(names[0]))
        scored = scored.withColumn("_total", total)
        return scored.select(*map(col, keys), F.array(*[F.col(n) / F.col("_total") for n in names]).alias("_p"))

    def _by_matrix(self, df: DataFrame, keys: Sequence[str]) -> DataFrame:
        priors, means, variances = self.priors, self.means, self.variances

        @F.arrow_udf("array<double>")
        def shares(values):
            import numpy as np
            import pyarrow as pa

            m, v = np.array(means, float), np.array(variances, float)  # no mean becomes NaN
            constant = -0.5 * np.log(2 * np.pi * v)
            flat = values.flatten()
            x, absent = (a.reshape(-1, m.shape[1]) for a in (flat.to_numpy(zero_copy_only=False), flat.is_null().to_numpy(zero_copy_only=False)))
            out = np.empty((len(x), len(m)))
            for at in range(0, len(x), 256):  # rows times classes times features are held at once
                part = x[at : at + 256, None, :]
                terms = constant - (part - m) ** 2 / (2 * v)
                out[at : at + 256] = np.log(priors) + np.where(absent[at : at + 256, None, :] | np.isnan(m), 0.0, terms).sum(axis=2)
            out = np.exp(out - out.max(axis=1, keepdims=True))
            out /= out.sum(axis=1, keepdims=True)
            return pa.ListArray.from_arrays(np.arange(0, out.size + 1, len(m), dtype=np.int32), out.ravel())

        values = F.array(*[col(f).cast("double") for f in self.features])
        return df.select(*map(col, keys), shares(values).alias("_p"))


def class_prior(df: DataFrame, label: str) -> DataFrame:
    """(label, n, prior) per class. Runs a count."""
    rows = df.filter(col(label).isNotNull())
    total = rows.count()
    counts = rows.groupBy(col(label)).agg(F.count("*").alias("n"))
    return counts.withColumn("prior", F.col("n") / F.lit(total))


def group_mean(df: DataFrame, label: str, groups: Sequence[str]) -> DataFrame:
    """Mean of a numeric label per group, with the group size."""
    return df.groupBy(*map(col, groups)).agg(F.avg(col(label)).alias(label), F.count(col(label)).alias("n"))
