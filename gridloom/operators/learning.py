"""Learning on feature vectors: nearest centroids, self-organising maps, clustering, components, classifiers."""

from dataclasses import dataclass
from itertools import combinations, islice

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import DecisionTreeClassifier, LinearSVC, LogisticRegression, MultilayerPerceptronClassifier, NaiveBayes, OneVsRest, RandomForestClassifier
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import PCA
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.regression import LinearRegression
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import arrays
from .graph import saved
from .stats import agreement

#: Most components that a covariance on the driver may have.
DIMENSIONS = 4096


def centroids(frame: DataFrame, label: str, features: str) -> DataFrame:
    """Mean vector of each class: ``label, centroid``."""
    each = frame.select(label, F.posexplode(arrays.doubles(F.col(features))).alias("pos", "x"))
    means = each.groupBy(label, "pos").agg(F.round(F.avg("x"), 6).alias("x"))
    pairs = means.groupBy(label).agg(F.sort_array(F.collect_list(F.struct("pos", "x"))).alias("p"))
    return pairs.select(label, F.transform("p", lambda e: e["x"]).alias("centroid"))


#: Model vectors that are broadcast at a time.
MODELS = 4096


def nearest(frame: DataFrame, features: str, models: DataFrame, label: str, distance=arrays.euclidean) -> DataFrame:
    """Each row with the model vector (label, centroid) next to it, ties to the smallest label.

    The models come in blocks of ``MODELS``, each one row that is broadcast. Where there are several blocks, the best so far
    is a table between two of them.
    """
    x, names = arrays.doubles(F.col(features)), frame.columns
    spark = frame.sparkSession
    kind = models.select(F.col(label).alias("l"), arrays.doubles(F.col("centroid")).alias("centroid"))
    best = F.lit(None).cast(f"struct<d: double, l: {dict(kind.dtypes)['l']}>")
    out = frame.withColumn("_best", best)
    rows, first = kind.orderBy("l").toLocalIterator(), True
    while block := list(islice(rows, MODELS)):
        if not first:
            out = saved(out)
        first = False
        every = spark.createDataFrame([(block,)], T.StructType([T.StructField("_models", T.ArrayType(kind.schema))]))
        scored = F.array_min(F.transform("_models", lambda m: F.struct(F.round(distance(x, m["centroid"]), 6).alias("d"), m["l"].alias("l"))))
        out = out.crossJoin(F.broadcast(every)).withColumn("_new", scored).withColumn("_best", F.least("_best", "_new")).drop("_models", "_new")
    return out.select(*names, F.col("_best.l").alias("nearest"), F.col("_best.d").alias("distance"))


def winners(frame: DataFrame, features: str, neurons: list[list[float]]) -> Column:
    """Place of the best matching neuron, the last of equally near ones."""
    x = arrays.doubles(F.col(features))
    return arrays.last_argmin(F.array(*[F.round(arrays.euclidean(x, F.array(*[F.lit(float(v)) for v in n])), 6) for n in neurons]))


def train_som(sample: np.ndarray, rows: int, cols: int, steps: int = 10, beta: tuple[float, float] = (0.5, 0.05), radius: float = 2.0, seed: int = 0) -> np.ndarray:
    """A self-organising map of a bounded sample, in the driver: (rows * cols) neurons. The rate falls linearly."""
    rng = np.random.default_rng(seed)
    neurons = sample[rng.integers(0, len(sample), rows * cols)].astype(float)
    place = np.stack(np.divmod(np.arange(rows * cols), cols), 1)
    for step in range(steps):
        rate = beta[0] + (beta[1] - beta[0]) * step / max(1, steps - 1)
        reach = max(0.5, radius * (1 - step / steps))
        for x in sample[rng.permutation(len(sample))]:
            win = int(np.argmin(((neurons - x) ** 2).sum(1)))
            pull = rate * np.exp(-((place - place[win]) ** 2).sum(1) / (2 * reach * reach))
            neurons += pull[:, None] * (x - neurons)
    return neurons


def _vectors(frame: DataFrame, features: str) -> DataFrame:
    return frame.withColumn("_v", array_to_vector(arrays.doubles(F.col(features))))


def kmeans(frame: DataFrame, features: str, k: int, seed: int = 7) -> DataFrame:
    model = KMeans(k=k, seed=seed, featuresCol="_v", predictionCol="cluster").fit(v := _vectors(frame, features))
    return model.transform(v).drop("_v")


def principal_components(frame: DataFrame, features: str, k: int) -> DataFrame:
    model = PCA(k=k, inputCol="_v", outputCol="_p").fit(v := _vectors(frame, features))
    return model.transform(v).withColumn("components", vector_to_array("_p")).drop("_v", "_p")


def classified(frame: DataFrame, features: str, label: str, kind: str = "logistic", seed: int = 7) -> DataFrame:
    """Class and its probability for each row, by a model trained on the rows with a label."""
    v = _vectors(frame, features).withColumn("_y", F.col(label).cast("double"))
    maker = {"logistic": LogisticRegression(featuresCol="_v", labelCol="_y", maxIter=30, regParam=0.01), "forest": RandomForestClassifier(featuresCol="_v", labelCol="_y", numTrees=20, seed=seed)}[kind]
    out = maker.fit(v.where("_y is not null")).transform(v)
    return out.withColumn("predicted", F.col("prediction").cast("int")).withColumn("confidence", F.array_max(vector_to_array("probability"))).drop("_v", "_y", "rawPrediction", "probability", "prediction")


# Models that are trained once, kept, and applied to other tables.


@dataclass
class Trained:
    """A fitted pipeline on the column of vectors, and the names of the classes that it numbers from 0."""

    pipeline: PipelineModel
    classes: list


def _estimator(kind: str, classes: int, dims: int, seed: int):
    own = {"featuresCol": "_v", "labelCol": "_y"}
    if kind == "logistic":
        return LogisticRegression(**own, maxIter=50, regParam=0.01)
    if kind == "forest":
        return RandomForestClassifier(**own, numTrees=20, seed=seed)
    if kind == "tree":
        return DecisionTreeClassifier(**own, seed=seed)
    if kind == "bayes":
        return NaiveBayes(**own, modelType="gaussian")
    if kind == "perceptron":
        return MultilayerPerceptronClassifier(**own, layers=[dims, 8, classes], seed=seed, maxIter=100)
    if kind == "vote":  # one machine with a margin for each class
        return OneVsRest(**own, classifier=LinearSVC(maxIter=30))
    raise ValueError(kind)


def train(frame: DataFrame, features: str, label: str, kind: str = "logistic", seed: int = 7) -> Trained:
    """A classifier of the rows with a label; the classes are the labels that occur, in order."""
    known = frame.where(F.col(label).isNotNull())
    classes = sorted(r[0] for r in known.select(label).distinct().collect())
    dims = known.select(F.size(features)).first()[0]
    place = F.array_position(F.array(*[F.lit(c) for c in classes]), F.col(label)) - 1
    v = _vectors(known, features).withColumn("_y", place.cast("double"))
    return Trained(Pipeline(stages=[_estimator(kind, len(classes), dims, seed)]).fit(v.select("_v", "_y")), classes)


def save(model: Trained, path: str) -> None:
    """Writes a model to a folder: the pipeline, and its classes as a table."""
    model.pipeline.write().overwrite().save(f"{path}/pipeline")
    spark = SparkSession.active()
    spark.createDataFrame([(k, c) for k, c in enumerate(model.classes)], ["place", "class"]).coalesce(1).write.mode("overwrite").parquet(f"{path}/classes")


def load(path: str) -> Trained:
    classes = SparkSession.active().read.parquet(f"{path}/classes").orderBy("place").collect()
    return Trained(PipelineModel.load(f"{path}/pipeline"), [r["class"] for r in classes])


def apply(model: Trained, frame: DataFrame, features: str) -> DataFrame:
    """``frame`` with the class ``predicted`` for each row and its ``confidence`` (null for models that give none)."""
    names = frame.columns
    out = model.pipeline.transform(_vectors(frame, features))
    sure = F.array_max(vector_to_array("probability")) if "probability" in out.columns else F.lit(None).cast("double")
    whole = all(isinstance(c, int) for c in model.classes)
    kind = "int" if whole and all(abs(c) < 1 << 31 for c in model.classes) else "long" if whole else "string"
    cls = F.element_at(F.array(*[F.lit(c).cast(kind) for c in model.classes]), (F.col("prediction") + 1).cast("int"))
    return out.select(*names, cls.alias("predicted"), sure.alias("confidence"))


def validated(model: Trained, frame: DataFrame, features: str, label: str) -> DataFrame:
    """Precision, recall and F-score of each class on labelled rows."""
    return agreement(apply(model, frame.where(F.col(label).isNotNull()), features), label, "predicted")


def selected_features(frame: DataFrame, features: str, label: str, count: int) -> list[int]:
    """Places of ``count`` features that tell the classes apart, chosen one by one by the Jeffries-Matusita distance of the
    Gaussian classes (the least over pairs of classes). Only sums per class reach the driver."""
    classes = {}
    for k in sorted(r[0] for r in frame.select(label).distinct().collect() if r[0] is not None):
        _, mean, square = second_moments(frame.where(F.col(label) == k), features)
        classes[k] = mean, square - np.outer(mean, mean) + 1e-9 * np.eye(len(mean))
    dims = len(next(iter(classes.values()))[0]) if classes else 0

    def apart(places: list[int]) -> float:
        low = 2.0
        for (m, c), (n, d) in combinations(classes.values(), 2):
            i = np.ix_(places, places)
            both = (c[i] + d[i]) / 2
            off = (m - n)[places]
            b = off @ np.linalg.solve(both, off) / 8 + 0.5 * (np.linalg.slogdet(both)[1] - 0.5 * (np.linalg.slogdet(c[i])[1] + np.linalg.slogdet(d[i])[1]))
            low = min(low, 2 * (1 - np.exp(-b)))
        return low

    chosen: list[int] = []
    while len(chosen) < min(count, dims):
        chosen.append(max((k for k in range(dims) if k not in chosen), key=lambda k: (apart([*chosen, k]), -k)))
    return chosen


def regressed(frame: DataFrame, features: list[str], target: str) -> DataFrame:
    """Linear prediction of a target from plain columns."""
    v = frame.withColumn("_v", array_to_vector(F.array(*[F.col(f).cast("double") for f in features])))
    return LinearRegression(featuresCol="_v", labelCol=target, predictionCol="predicted").fit(v).transform(v).drop("_v")


def normal_bayes(frame: DataFrame, features: str, label: str, ridge: float = 1e-6) -> DataFrame:
    """Class of each row under one Gaussian a class with full covariance, from sums gathered per class."""
    v = _vectors(frame, features).where(F.col(label).isNotNull())
    dims = len(v.select(features).first()[0])
    if dims > DIMENSIONS:
        raise ValueError("too many dimensions for a covariance in the driver")
    x = arrays.doubles(F.col(features))
    means = {r[label]: (r["n"], np.array(r["m"].toArray())) for r in v.groupBy(label).agg(F.count("*").alias("n"), Summarizer.mean(F.col("_v")).alias("m")).collect()}

    def moments(batches):
        sums: dict = {}
        for batch in batches:
            for k, own in batch.groupby("k")["x"]:
                rows = np.stack(own.to_numpy()).astype(float)
                sums[k] = sums.get(k, 0.0) + rows.T @ rows
        for k, m in sums.items():
            yield pd.DataFrame({"k": [k] * dims, "i": range(dims), "row": [m[i, i:] for i in range(dims)]})

    kind = frame.schema[label].dataType.simpleString()
    cells = v.select(F.col(label).alias("k"), x.alias("x")).mapInPandas(moments, f"k {kind}, i int, row array<double>").select("k", "i", F.posexplode("row").alias("j", "ab"))
    cov = {k: np.zeros((dims, dims)) for k in means}
    for r in cells.groupBy("k", "i", "j").agg(F.sum("ab").alias("ab")).collect():
        i, j = r["i"], r["i"] + r["j"]
        cov[r["k"]][i, j] = cov[r["k"]][j, i] = r["ab"] / means[r["k"]][0]
    total = sum(n for n, _ in means.values())
    names, models = [], []
    for k, (n, m) in sorted(means.items()):
        c = cov[k] - np.outer(m, m) + ridge * np.eye(dims)
        names.append(k)
        models.append((np.log(n / total) - 0.5 * np.linalg.slogdet(c)[1], m, np.linalg.inv(c)))

    @F.pandas_udf("int")
    def best(vectors: pd.Series) -> pd.Series:
        if not len(vectors):
            return pd.Series([], dtype="int32")
        rows = np.stack(vectors.to_numpy()).astype(float)
        scores = [bias - 0.5 * np.einsum("ni,ij,nj->n", rows - m, p, rows - m) for bias, m, p in models]
        return pd.Series(np.array(names)[np.argmax(scores, 0)]).astype("int32")

    return v.withColumn("predicted", best(F.col(features))).drop("_v")


def second_moments(frame: DataFrame, features: str) -> tuple[int, np.ndarray, np.ndarray]:
    """Rows, mean and matrix of second moments: each task adds up outer products, of which (dimensions^2) numbers are shuffled."""
    first = frame.select(F.size(features)).first()
    dims = first[0] if first else 0
    if dims > DIMENSIONS:
        raise ValueError("too many dimensions for a covariance in the driver")

    def moments(batches):
        n, total, square = 0, np.zeros(dims), np.zeros((dims, dims))
        for batch in batches:
            if len(batch):
                rows = np.stack(batch["x"].to_numpy()).astype(float)
                n, total, square = n + len(rows), total + rows.sum(0), square + rows.T @ rows
        if n:
            yield pd.DataFrame({"i": range(-1, dims), "row": [np.concatenate(([float(n)], total)), *square]})

    parts = frame.where(F.col(features).isNotNull()).select(arrays.doubles(F.col(features)).alias("x")).mapInPandas(moments, "i int, row array<double>")
    sums = parts.select("i", F.posexplode("row").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v")).collect()
    n, mean, square = 0, np.zeros(dims), np.zeros((dims, dims))
    for r in sums:
        if r["i"] >= 0:
            square[r["i"], r["j"]] = r["v"]
        elif r["j"]:
            mean[r["j"] - 1] = r["v"]
        else:
            n = int(r["v"])
    return n, mean / max(1, n), square / max(1, n)


def virtual_dimension(frame: DataFrame, features: str, false_alarm: float = 1e-3) -> int:
    """How many eigenvalues of the correlation exceed those of the covariance by more than noise explains."""
    from statistics import NormalDist

    n, mean, r = second_moments(frame, features)
    a, b = (np.sort(np.linalg.eigvalsh(m))[::-1] for m in (r, r - np.outer(mean, mean)))
    spread = np.sqrt(2 * (a * a + b * b) / max(1, n))
    return int((a - b > NormalDist().inv_cdf(1 - false_alarm) * spread).sum())
