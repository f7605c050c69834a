"""Queries of learning operators."""

from __future__ import annotations

import numpy as np
from pyspark.sql import functions as F

from ..functions import arrays
from ..operators import learning as L
from . import query, table

_V = "SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings"
_C = f"e AS ({_V}), u AS (SELECT label, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM e), m AS (SELECT label, i, round(avg(x), 6) AS x FROM u GROUP BY 1, 2), c AS (SELECT label, list(x ORDER BY i) AS w FROM m GROUP BY 1)"


def _nearest(metric: str) -> str:
    return f"WITH {_C}, d AS (SELECT vec_id, c.label AS nearest, round({metric}, 6) AS distance FROM e CROSS JOIN c) SELECT vec_id, nearest, round(distance, 5) AS distance FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d.distance, nearest) = 1"


@query(_nearest("list_distance(v, w)"))
def euclid_nn(spark, sf):
    e = table(spark, sf, "embeddings")
    return L.nearest(e, "embedding", L.centroids(e, "label", "embedding"), "label").select("vec_id", "nearest", F.round("distance", 5).alias("distance"))


@query(_nearest("list_sum(list_transform(list_zip(v, w), lambda p: abs(p[1] - p[2])))"))
def manhattan_nn(spark, sf):
    e = table(spark, sf, "embeddings")
    return L.nearest(e, "embedding", L.centroids(e, "label", "embedding"), "label", arrays.manhattan).select("vec_id", "nearest", F.round("distance", 5).alias("distance"))


@query(f"""WITH {_C}, p AS (SELECT label, row_number() OVER (ORDER BY label) - 1 AS neuron, w FROM c), d AS (SELECT vec_id, neuron, round(list_distance(v, w), 6) AS d FROM e CROSS JOIN p),
b AS (SELECT neuron FROM d QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d.d, neuron DESC) = 1) SELECT p.neuron::INTEGER AS neuron, count(b.neuron) AS n FROM p LEFT JOIN b USING (neuron) GROUP BY 1""")
def som_winner_hist(spark, sf):
    e = table(spark, sf, "embeddings")
    neurons = [r["centroid"] for r in L.centroids(e, "label", "embedding").orderBy("label").collect()]
    won = e.select(L.winners(e, "embedding", neurons).alias("neuron")).groupBy("neuron").agg(F.count("*").alias("n"))
    return spark.range(len(neurons)).select(F.col("id").cast("int").alias("neuron")).join(won, "neuron", "left").na.fill(0, ["n"])


@query()
def som_classification(spark, sf):
    """A map trained on a bounded sample (200 vectors by a hash of the id), and every vector's winning neuron."""
    e = table(spark, sf, "embeddings")
    sample = e.orderBy(F.xxhash64("vec_id"), "vec_id").limit(200).select("embedding").collect()
    neurons = L.train_som(np.array([r[0] for r in sample], float), 4, 4).tolist()
    return e.select("vec_id", L.winners(e, "embedding", neurons).alias("neuron"))


@query()
def kmeans_clusters(spark, sf):
    return L.kmeans(table(spark, sf, "embeddings"), "embedding", 8).select("vec_id", "label", "cluster")


@query()
def pca_components(spark, sf):
    return L.principal_components(table(spark, sf, "embeddings"), "embedding", 3).select("vec_id", "components")


@query()
def vector_classifier(spark, sf):
    return L.classified(table(spark, sf, "embeddings"), "embedding", "label").select("vec_id", "label", "predicted", "confidence")


@query()
def normal_bayes_classifier(spark, sf):
    return L.normal_bayes(table(spark, sf, "embeddings"), "embedding", "label").select("vec_id", "label", "predicted")


@query()
def price_regression(spark, sf):
    t = table(spark, sf, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_quantity", "l_discount", "l_extendedprice")
    return L.regressed(t, ["l_quantity", "l_discount"], "l_extendedprice").select("l_orderkey", "l_linenumber", "l_partkey", F.round("predicted", 4).alias("predicted"))
