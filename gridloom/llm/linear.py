"""Small linear models, fitted in the driver on bounded samples of labelled rows."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .rows import one_of_each


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))


@dataclass
class Logistic:
    """Logistic regression on standardised dense features; columns without spread are ignored."""

    mean: np.ndarray
    scale: np.ndarray
    weight: np.ndarray
    bias: float

    def logit(self, x: np.ndarray) -> np.ndarray:
        return np.clip((x - self.mean) / self.scale, -8, 8) @ self.weight + self.bias


def fit_logistic(x: np.ndarray, y: np.ndarray, penalty: float = 1e-3, rounds: int = 40) -> Logistic:
    """Newton steps with classes weighted alike; one class alone gives a constant in its favour."""
    n = len(y)
    if not n or y.min() == y.max():
        return Logistic(np.zeros(x.shape[1]), np.ones(x.shape[1]), np.zeros(x.shape[1]), 4.0 if not n or y[0] else -4.0)
    mean, spread = x.mean(0), x.std(0)
    scale = np.where(spread > 1e-9, spread, np.inf)
    z = np.concatenate((np.clip((x - mean) / scale, -8, 8), np.ones((n, 1))), 1)
    of = np.where(y == 1, 0.5 / (y == 1).sum(), 0.5 / (y == 0).sum())
    w = np.zeros(z.shape[1])
    ridge = np.full(len(w), penalty)
    ridge[-1] = 1e-9
    for _ in range(rounds):
        p = sigmoid(z @ w)
        step = np.linalg.solve((z * (of * p * (1 - p))[:, None]).T @ z + np.diag(ridge + 1e-9), z.T @ (of * (p - y)) + ridge * w)
        w -= np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-6:
            break
    return Logistic(mean, scale, w[:-1], float(w[-1]))


def labelled_sample(spark: SparkSession, documents: DataFrame, columns: list[str], labels: DataFrame, label: str, per_class: int) -> DataFrame:
    """``doc_id``, the ``columns`` and ``label`` of about ``per_class`` documents of each label 0 and 1, by a hash of the id.

    The number of labelled ids sets the share of each class, so what reaches the driver is bounded by ``per_class``. An
    id gives one row, the least of those that it has; of several labels it takes the greatest. Other columns don't matter.
    """
    own = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(label).cast("int").alias("label")).where("doc_id is not null and label in (0, 1)").distinct()
    counts = {r["label"]: r["n"] for r in own.groupBy("label").agg(F.count("*").alias("n")).collect()}
    share = {k: min(1.0, per_class / n) for k, n in counts.items()}
    bound = F.when(F.col("label") == 1, share.get(1, 0.0)).otherwise(share.get(0, 0.0)) * F.lit(float(1 << 30))
    ids = sorted({(r["doc_id"], r["label"]) for r in own.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < bound).collect()})
    known = spark.createDataFrame(list(dict(ids).items()), "doc_id long, label int")
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)
    # about 2 * per_class rows at most, by construction
    found = docs.join(F.broadcast(known), "doc_id").withColumn("key", F.col("doc_id"))
    return one_of_each(found, ["key"])


def unlabelled_sample(documents: DataFrame, columns: list[str], most: int) -> DataFrame:
    """``doc_id`` and the ``columns`` of about ``most`` different rows, by a hash of id and columns."""
    share = min(1.0, most / max(1, documents.count()))
    docs = documents.select(F.col("doc_id").cast("long").alias("doc_id"), *columns)
    return docs.where(F.pmod(F.xxhash64("doc_id", *columns), F.lit(1 << 30)) < int(share * (1 << 30))).distinct()
