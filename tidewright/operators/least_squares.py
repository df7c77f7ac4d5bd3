"""Linear models for many targets from one distributed correlation pass.

All targets share the features, so one pass over the training rows gives every inner product that any of them
needs: a matrix of (features + targets) squared, whose size does not depend on the rows. The driver solves one small
system per target; scoring is column arithmetic. The models have the interface of :class:`TargetModels`, so they drive the same
recursion, simulation and audit.
"""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.ml.functions import array_to_vector
from pyspark.ml.stat import Correlation
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

FEATURES = "__features"


@dataclass(frozen=True)
class LinearModels:
    """Weights per target over a fixed, named feature order; the last weight is the constant."""

    features: tuple[str, ...]
    weights: Mapping[str, tuple[float, ...]]

    def vector(self, values: Mapping[str, Column] | None = None) -> Column:
        """Feature array; ``values`` overrides where a feature comes from."""
        return F.array(*[(values[n] if values is not None else F.col(n)).cast("double") for n in self.features])

    def score(self, df: DataFrame, targets: Sequence[str] | None = None, prefix: str = "pred_") -> DataFrame:
        """Add ``pred_<target>`` from an existing feature array."""
        def predicted(target: str) -> Column:
            *weights, constant = self.weights[target]
            terms = F.zip_with(F.col(FEATURES), F.array(*map(F.lit, weights)), lambda x, w: x * w)
            return F.aggregate(terms, F.lit(0.0), lambda total, term: total + term) + F.lit(constant)

        return df.withColumns({f"{prefix}{t}": predicted(t) for t in targets or self.weights})

    def predict(self, df: DataFrame, targets: Sequence[str] | None = None) -> DataFrame:
        """Batch scoring of a feature matrix by column name."""
        missing = [c for c in self.features if c not in df.columns]
        if missing:
            raise ValueError(f"feature columns missing: {missing[:10]}")
        return self.score(df.withColumn(FEATURES, self.vector()), targets).drop(FEATURES)

    def save(self, spark: SparkSession, path: str) -> None:
        meta = json.dumps({"features": list(self.features), "weights": {t: list(w) for t, w in self.weights.items()}})
        spark.createDataFrame([(meta,)], "meta string").write.mode("overwrite").json(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> "LinearModels":
        meta = json.loads(spark.read.schema("meta string").json(path).first()["meta"])
        return LinearModels(tuple(meta["features"]), {t: tuple(w) for t, w in meta["weights"].items()})


def fit_least_squares(train: DataFrame, features: Sequence[str], targets: Sequence[str], ridge: float = 0.0) -> LinearModels:
    """Least squares per target; ``ridge`` is added to the diagonal of the features' correlations.

    Rows with a null in any of the columns take no part. A constant feature gets the weight 0, and of features that
    depend on each other the solution of least norm is taken.
    """
    names = [*features, *targets]
    rows = train.select(*[F.col(c).cast("double").alias(c) for c in names]).dropna("any")
    stats = rows.agg(F.count("*").alias("n"), *[f(c).alias(f"{k}{i}") for i, c in enumerate(names) for k, f in (("m", F.avg), ("s", F.stddev_pop))]).first()
    if not stats["n"]:
        raise ValueError("no complete training row")
    mean = np.array([stats[f"m{i}"] for i in range(len(names))])
    spread = np.array([stats[f"s{i}"] for i in range(len(names))])
    moving = [i for i in range(len(names)) if spread[i] > 1e-12 * max(1.0, abs(mean[i]))]
    place = {i: k for k, i in enumerate(moving)}
    together = np.zeros((len(moving), len(moving)))
    if moving:
        vectors = rows.select(array_to_vector(F.array(*[F.col(names[i]) for i in moving])).alias(FEATURES))
        together = Correlation.corr(vectors, FEATURES).first()[0].toArray()
    inputs = [i for i in moving if i < len(features)]
    at = [place[i] for i in inputs]
    system = together[np.ix_(at, at)] + ridge * np.eye(len(at))
    weights = {}
    for t, target in enumerate(targets, start=len(features)):
        own = np.zeros(len(features))
        if t in place and inputs:
            solved = np.linalg.lstsq(system, together[at, place[t]], rcond=1e-12)[0]
            own[inputs] = solved * spread[t] / spread[inputs]
        weights[target] = (*map(float, own), float(mean[t] - own @ mean[:len(features)]))
    return LinearModels(tuple(features), weights)
