"""Clustering of the feature table (ML1-ML3)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from turnstile.operators.features import RATE_COLUMNS


def fit_kmeans(features: DataFrame, k: int = 3, seed: int = 42, cols=RATE_COLUMNS, max_iter: int = 300,
               tol: float = 1e-4):
    """ML1: Spark ML k-means (k-means|| init, fixed seed) over the rates.
    NULL rates (no visits to divide by) are treated as 0.
    People of equal rates are one point with a weight (``weightCol``), so the
    passes of the fit go with the different rate vectors, and people get their
    cluster by a join on theirs.
    The fit stops at the tolerance ``tol``; ``max_iter`` is a bound far beyond.
    Returns (model, assignments(idperson, prediction), centroids); the model's
    summary tells the iterations used (fewer than ``max_iter``: converged)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.feature import VectorAssembler

    from turnstile.session import written

    spark = features.sparkSession
    # k-means passes over its input once per iteration: the features are written
    # once to the shared folder (this also cuts the lineage, so a lost executor
    # reads them again and doesn't recompute the joins)
    x = written(spark, features.select("idperson", *[F.coalesce(F.col(c), F.lit(0.0)).alias(c) for c in cols]), "rates")
    points = written(spark, x.groupBy(*cols).agg(F.count(F.lit(1)).cast("double").alias("weight")).orderBy(*cols), "rate_points")
    vec = VectorAssembler(inputCols=list(cols), outputCol="features").transform(points)
    model = KMeans(k=k, seed=seed, maxIter=max_iter, tol=tol, featuresCol="features", weightCol="weight").fit(vec.select("features", "weight"))
    placed = model.transform(vec).select(*cols, F.col("prediction").cast("int").alias("prediction"))
    assign = x.join(placed, list(cols)).select("idperson", "prediction")
    rows = [(i, *[float(v) for v in c]) for i, c in enumerate(model.clusterCenters())]
    centroids = spark.createDataFrame(rows, ["cluster", *cols])
    return model, assign, centroids


def assign_nearest(features: DataFrame, centroids: list[list[float]], cols=RATE_COLUMNS) -> DataFrame:
    """ML2 for given centroids: index of the nearest centroid (squared
    Euclidean, first on ties), computed JVM-side with array functions."""
    f = F.array(*[F.coalesce(F.col(c), F.lit(0.0)).cast("double") for c in cols])
    cents = F.array(*[F.array(*[F.lit(float(v)) for v in c]) for c in centroids])
    dist = F.transform(cents, lambda c: F.aggregate(
        F.zip_with(f, c, lambda a, b: (a - b) * (a - b)), F.lit(0.0), lambda acc, x: acc + x))
    return features.select("idperson", (F.array_position(dist, F.array_min(dist)) - 1).cast("int")
                           .alias("prediction"))


def update_step(features: DataFrame, centroids: list[list[float]], cols=RATE_COLUMNS) -> DataFrame:
    """ML3: the centroids after one step of the algorithm from the given ones:
    the mean of each cluster's people, to six decimals.  Clusters without people
    have no row."""
    placed = assign_nearest(features, centroids, cols).join(features, "idperson")
    return placed.groupBy(F.col("prediction").alias("cluster")).agg(
        *[F.round(F.avg(F.coalesce(F.col(c), F.lit(0.0))), 6).alias(c) for c in cols])


def fit_facts(features: DataFrame, k: int = 3, seed: int = 42, cols=RATE_COLUMNS, max_iter: int = 300) -> DataFrame:
    """Facts by which a real fit can be checked: people, clusters that have
    some, people who aren't with their nearest centroid, and whether the fit
    converged before ``max_iter``."""
    model, assign, _ = fit_kmeans(features, k, seed, cols, max_iter)
    nearest = assign_nearest(features, [[float(v) for v in c] for c in model.clusterCenters()], cols)
    both = assign.join(nearest.withColumnRenamed("prediction", "nearest"), "idperson")
    return both.agg(F.count(F.lit(1)).alias("people"), F.count_distinct("prediction").alias("clusters"),
                    F.count_if(F.col("prediction") != F.col("nearest")).alias("misplaced"),
                    F.lit(model.summary.numIter < max_iter).alias("converged"))
