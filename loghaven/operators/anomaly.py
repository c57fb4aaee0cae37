"""K-means anomaly model: training, scoring, decay update, evaluation."""

from __future__ import annotations

import time
from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce
from operator import add

from pyspark import StorageLevel
from pyspark.ml import Pipeline
from pyspark.ml.clustering import KMeans
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from loghaven.functions.numeric import rounded
from loghaven.functions.once import evaluate_once
from loghaven.operators.features import FEATURES, RAW_FEATURES, complete_rows, z_score

# Model defaults.
CLUSTERS = 8
SEED = 42
MAX_ITER = 20
THRESHOLD = 3.0

# Above this many terms the distances are evaluated over arrays, because one
# generated method would grow too large.
UNROLLED_TERMS = 400


@dataclass(frozen=True)
class ClusterModel:
    """k centers over d scaled features. Small by construction: k x d numbers."""

    features: tuple[str, ...]
    mean: tuple[float, ...]
    std: tuple[float, ...]
    centers: tuple[tuple[float, ...], ...]
    weights: tuple[float, ...] = ()
    version: int = 0
    trained_at_batch: int = -1
    wssse: float = 0.0
    training_rows: int = 0
    training_seconds: float = field(default=0.0, compare=False)

    def scaled(self) -> list[Column]:
        return [
            z_score(F.col(f), F.lit(m), F.lit(s))
            for f, m, s in zip(self.features, self.mean, self.std)
        ]


def train(
    flows: DataFrame,
    features: Sequence[str] = FEATURES,
    k: int = CLUSTERS,
    seed: int = SEED,
    max_iter: int = MAX_ITER,
    version: int = 1,
    trained_at_batch: int = 0,
) -> ClusterModel:
    """Fit scaler and k-means on a frame that has the feature columns.

    The fit passes over its rows some twenty times, so the features alone are spread
    evenly and kept for its duration, over as many partitions as shuffles have (which a
    cluster sets by its data) or as there are cores, whichever is more. What memory does not
    hold is read again from the files of that shuffle, not written a second time.
    """
    started = time.monotonic()
    picked = complete_rows(flows, features).select(*features)
    spark = flows.sparkSession
    parts = max(spark.sparkContext.defaultParallelism, int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = picked.repartition(parts).persist(StorageLevel.MEMORY_ONLY)
    try:
        fitted = Pipeline(
            stages=[
                VectorAssembler(inputCols=list(features), outputCol="raw", handleInvalid="skip"),
                StandardScaler(inputCol="raw", outputCol="scaled", withMean=True, withStd=True),
                KMeans(k=k, seed=seed, maxIter=max_iter, featuresCol="scaled", predictionCol="cluster_id"),
            ]
        ).fit(rows)
    finally:
        rows.unpersist()
    scaler, kmeans = fitted.stages[1], fitted.stages[2]
    sizes = kmeans.summary.clusterSizes
    return ClusterModel(
        features=tuple(features),
        mean=tuple(float(x) for x in scaler.mean),
        std=tuple(float(x) for x in scaler.std),
        centers=tuple(tuple(float(x) for x in c) for c in kmeans.clusterCenters()),
        weights=tuple(float(n) for n in sizes),
        version=version,
        trained_at_batch=trained_at_batch,
        wssse=float(kmeans.summary.trainingCost),
        training_rows=int(sum(sizes)),
        training_seconds=time.monotonic() - started,
    )


def baseline_rows(flows: DataFrame) -> DataFrame:
    """All complete flows, on which a notebook baseline is fitted."""
    return flows.dropna(subset=list(RAW_FEATURES))


def baseline_sample(flows: DataFrame, order: Sequence[str], rows: int) -> DataFrame:
    """The first ``rows`` complete flows in a stable order, for a look at a baseline."""
    return baseline_rows(flows).orderBy(*order).limit(rows)


def refit_centers(
    scored_batch: DataFrame, model: ClusterModel, k: int = CLUSTERS, min_rows: int = 100
) -> ClusterModel:
    """Continuous learning: new centers from one batch under the model's frozen scaling.

    A batch with fewer than ``min_rows`` complete rows leaves the model as it is.
    """
    rows = complete_rows(scored_batch, model.features)
    scaled = rows.select(
        *[z.alias(f"z{i}") for i, z in enumerate(model.scaled())]
    ).persist()
    try:
        if scaled.limit(min_rows).count() < min_rows:
            return model
        vectors = VectorAssembler(
            inputCols=scaled.columns, outputCol="scaled"
        ).transform(scaled).select("scaled")
        started = time.monotonic()
        kmeans = KMeans(k=k, seed=SEED, maxIter=MAX_ITER, featuresCol="scaled").fit(vectors)
        sizes = kmeans.summary.clusterSizes
        return ClusterModel(
            features=model.features,
            mean=model.mean,
            std=model.std,
            centers=tuple(tuple(float(x) for x in c) for c in kmeans.clusterCenters()),
            weights=tuple(float(n) for n in sizes),
            version=model.version + 1,
            trained_at_batch=model.trained_at_batch,
            wssse=float(kmeans.summary.trainingCost),
            training_rows=int(sum(sizes)),
            training_seconds=time.monotonic() - started,
        )
    finally:
        scaled.unpersist()


def _squared_distance(point: Sequence[Column], center: Sequence[float]) -> Column:
    return reduce(add, [(p - F.lit(c)) * (p - F.lit(c)) for p, c in zip(point, center)])


def _nearest_unrolled(df: DataFrame, centers: Sequence[Sequence[float]], dims: int) -> DataFrame:
    point = [F.col(f"_z{i}") for i in range(dims)]
    names = [f"_d{n}" for n in range(len(centers))]
    df = evaluate_once(
        df, {name: _squared_distance(point, c) for name, c in zip(names, centers)}
    )
    distances = [F.col(name) for name in names]
    df = df.withColumn("_best", F.least(*distances) if len(distances) > 1 else distances[0])
    nearest = F.array_position(F.array(*distances), F.col("_best")) - 1
    return df.withColumn("cluster_id", nearest.cast("int")).drop(*names)


def _nearest_over_arrays(df: DataFrame, centers: Sequence[Sequence[float]], dims: int) -> DataFrame:
    point = F.array(*[F.col(f"_z{i}") for i in range(dims)])
    table = F.array(
        *[
            F.struct(F.lit(n).alias("id"), F.array(*[F.lit(x) for x in c]).alias("at"))
            for n, c in enumerate(centers)
        ]
    )

    def measured(center: Column) -> Column:
        gaps = F.zip_with(center["at"], F.col("_point"), lambda a, b: (a - b) * (a - b))
        return F.struct(
            F.aggregate(gaps, F.lit(0.0), lambda total, x: total + x).alias("d"),
            center["id"].alias("id"),
        )

    df = df.withColumn("_point", point)
    return (
        evaluate_once(df, {"_near": F.array_min(F.transform(table, measured))})
        .withColumn("_best", F.col("_near.d"))
        .withColumn("cluster_id", F.col("_near.id").cast("int"))
        .drop("_point", "_near")
    )


def assign_scaled(df: DataFrame, points: Sequence[Column], centers: Sequence[Sequence[float]]) -> DataFrame:
    """Add cluster_id (nearest center, lowest id on a tie) and ``_best``, its squared distance."""
    dims = len(points)
    df = evaluate_once(df, {f"_z{i}": p for i, p in enumerate(points)})
    if len(centers) * dims <= UNROLLED_TERMS:
        return _nearest_unrolled(df, centers, dims)
    return _nearest_over_arrays(df, centers, dims)


def score_scaled(
    df: DataFrame,
    points: Sequence[Column],
    centers: Sequence[Sequence[float]],
    threshold: float = THRESHOLD,
) -> DataFrame:
    """Add cluster_id, anomaly_score (FLOAT distance to the own center) and is_anomaly."""
    near = assign_scaled(df, points, centers)
    helpers = [f"_z{i}" for i in range(len(points))] + ["_best"]
    return (
        near.withColumn("anomaly_score", F.sqrt("_best").cast("float"))
        .drop(*helpers)
        .withColumn("is_anomaly", F.col("anomaly_score") > F.lit(float(threshold)))
    )


def score(df: DataFrame, model: ClusterModel, threshold: float = THRESHOLD) -> DataFrame:
    """Score a frame with the model's feature columns. Rows without features are skipped."""
    return score_scaled(
        complete_rows(df, model.features), model.scaled(), model.centers, threshold
    )


def update_with_decay(
    df: DataFrame,
    points: Sequence[Column],
    centers: Sequence[Sequence[float]],
    weights: Sequence[float],
    decay: float = 1.0,
) -> DataFrame:
    """Mini-batch update of every center: (c n a + sum of its points) / (n a + their number).

    One row per center: cluster_id, weight, center. Only k rows of sums leave the
    map side, so the batch may be of any size. A center without points keeps its place.
    """
    spark = df.sparkSession
    names = [f"s{i}" for i in range(len(points))]
    batch = assign_scaled(df, points, centers).select(
        "cluster_id", F.lit(1.0).alias("w"), *[F.col(f"_z{i}").alias(n) for i, n in enumerate(names)]
    )
    # An old center counts as n a points at its place; one without weight still
    # takes part with weight 0, and keeps its place below.
    old = spark.createDataFrame(
        [
            (n, float(w) * decay, *[float(x) * float(w) * decay for x in c], [float(x) for x in c])
            for n, (c, w) in enumerate(zip(centers, weights))
        ],
        f"cluster_id int, w double, {', '.join(n + ' double' for n in names)}, at array<double>",
    )
    sums = (
        batch.withColumn("at", F.lit(None).cast("array<double>"))
        .unionByName(old)
        .groupBy("cluster_id")
        .agg(F.sum("w").alias("weight"), F.max("at").alias("at"), *[F.sum(n).alias(n) for n in names])
    )
    moved = F.array(*[F.col(n) / F.col("weight") for n in names])
    return sums.select(
        "cluster_id", "weight", F.when(F.col("weight") > 0, moved).otherwise(F.col("at")).alias("center")
    )


def decayed_model(df: DataFrame, model: ClusterModel, decay: float = 1.0) -> ClusterModel:
    """The model after one decayed update with ``df``."""
    weights = model.weights or tuple(0.0 for _ in model.centers)
    rows = update_with_decay(
        complete_rows(df, model.features), model.scaled(), model.centers, weights, decay
    ).orderBy("cluster_id").collect()
    return ClusterModel(
        features=model.features,
        mean=model.mean,
        std=model.std,
        centers=tuple(tuple(r["center"]) for r in rows),
        weights=tuple(r["weight"] for r in rows),
        version=model.version + 1,
        trained_at_batch=model.trained_at_batch,
    )


def metrics_row(
    spark: SparkSession, model: ClusterModel, at: Column, batch_id: int
) -> DataFrame:
    """One row of the model_metrics table."""
    return spark.createDataFrame(
        [(model.version, batch_id, model.wssse, model.training_seconds, model.training_rows)],
        "training_id bigint, batch_id bigint, wssse double, training_duration_sec double, training_rows bigint",
    ).select("training_id", "batch_id", at.alias("ingest_ts"), "wssse", "training_duration_sec", "training_rows")


# Uid prefixes of injected attacks.
ATTACK_PREFIX = r"^(ATTACK|SCAN|EXFIL|DDOS|C2)_"


def confusion(flows: DataFrame) -> DataFrame:
    """TP, FP, FN, TN counts, precision and recall over labelled, scored flows."""
    label, flag = F.col("is_attack"), F.col("is_anomaly")
    counts = flows.agg(
        F.count_if(label & flag).alias("tp"),
        F.count_if(~label & flag).alias("fp"),
        F.count_if(label & ~flag).alias("fn"),
        F.count_if(~label & ~flag).alias("tn"),
    )
    return counts.withColumns(
        {
            "precision": rounded(F.try_divide("tp", F.col("tp") + F.col("fp")), 4),
            "recall": rounded(F.try_divide("tp", F.col("tp") + F.col("fn")), 4),
        }
    )


def recall_by_kind(flows: DataFrame) -> DataFrame:
    """Per attack kind, read from the uid prefix: flows, detected flows and recall."""
    kind = F.regexp_extract("uid", ATTACK_PREFIX, 1)
    return (
        flows.filter(F.col("is_attack"))
        .groupBy(kind.alias("attack_kind"))
        .agg(F.count("*").alias("flows"), F.count_if("is_anomaly").alias("detected"))
        .withColumn("recall", rounded(F.col("detected") / F.col("flows"), 4))
    )
