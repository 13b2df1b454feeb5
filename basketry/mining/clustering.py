"""K-Means segments of users, their scores and their profiles."""

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from basketry.errors import ClusteringDataError
from basketry.functions.labels import cluster_name
from basketry.functions.ranking import seeded_key, seeded_sample
from basketry.mining.features import FEATURES, SCALED, require_features, standardize
from basketry.session import materialize, small_broadcast

DEFAULT_SEED = 42
# A silhouette task compares two blocks of about this many rows.
BLOCK_ROWS = 2_500
# Cluster tables up to this many rows are broadcast.
SMALL_CLUSTERS = 10_000
# Runs of K-Means that share the cluster; each holds its own vectors in memory meanwhile.
PARALLEL_RUNS = 4


@dataclass(frozen=True)
class Fit:
    """Labelled rows, centres in label order, the sum of squared distances, and the model."""

    frame: DataFrame
    centers: list
    inertia: float
    model: KMeansModel


def _assembled(scaled: DataFrame) -> DataFrame:
    return VectorAssembler(inputCols=list(SCALED), outputCol="features").transform(scaled)


def _ordered_centers(model: KMeansModel) -> list[tuple[int, tuple[float, ...]]]:
    """(model index, centre) in the order of the centres, which is the order of labels."""
    centers = [tuple(float(x) for x in center) for center in model.clusterCenters()]
    return sorted(enumerate(centers), key=lambda pair: pair[1])


def assign(model: KMeansModel, scaled: DataFrame) -> DataFrame:
    """Rows with their ``cluster``; a saved model labels new users the same way."""
    pairs = [F.lit(v) for new, (old, _) in enumerate(_ordered_centers(model)) for v in (old, new)]
    index = F.create_map(*pairs)[F.col(model.getPredictionCol())]
    return model.transform(_assembled(scaled)).select(*scaled.columns, index.alias("cluster"))


def fit_kmeans(
    scaled: DataFrame, k: int, seed: int = DEFAULT_SEED, n_init: int = 10, max_iter: int = 300
) -> Fit:
    """Best of ``n_init`` K-Means runs; labels follow the order of the centres.

    An iteration is a job of a few short tasks, so runs go side by side. Each keeps the vectors it
    iterates over by itself; kept as a frame, every iteration would decode them again.
    """
    data = _assembled(scaled)

    def run(number: int) -> KMeansModel:
        return KMeans(k=k, seed=seed + number, maxIter=max_iter, featuresCol="features",
                      predictionCol="label").fit(data)

    with ThreadPoolExecutor(PARALLEL_RUNS) as pool:
        runs = list(pool.map(run, range(n_init)))
    best = min(runs, key=lambda model: model.summary.trainingCost)
    centers = [center for _, center in _ordered_centers(best)]
    return Fit(assign(best, scaled), centers, float(best.summary.trainingCost), best)


def _block_distances(columns: list[str]):
    """Comparison of two blocks. It is made here, so that it travels to the executors by
    value and they need not have this package."""
    names = ["user_id", "cluster", "other", "distance", "members"]

    def compare(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        """Per left row: summed distance to, and rows of, each cluster on the right."""
        a = left[columns].to_numpy()
        b = right[[f"o_{name}" for name in columns]].to_numpy()
        squares = np.zeros((len(a), len(b)))
        for column in range(a.shape[1]):
            squares += (a[:, column, None] - b[None, :, column]) ** 2
        distances = np.sqrt(squares)
        frames = [pd.DataFrame(columns=names)]
        for other in np.unique(right["other"]):
            members = (right["other"] == other).to_numpy()
            frames.append(pd.DataFrame({
                "user_id": left["user_id"], "cluster": left["cluster"], "other": other,
                "distance": distances[:, members].sum(axis=1), "members": int(members.sum()),
            }))
        filled = [frame for frame in frames if len(frame)]
        return pd.concat(filled, ignore_index=True) if filled else frames[0]

    return compare


def silhouette(rows: DataFrame, count: int) -> DataFrame:
    """Exact mean Euclidean silhouette of (user_id, cluster, scaled features), as one row.

    Rows are dealt into blocks by hash and every block meets every block in a task of its
    own, as two matrices: memory per task is fixed, no pair becomes a row, and a cluster
    that holds most rows changes nothing. A cluster of one row scores 0.
    """
    blocks = max(-(-count // BLOCK_ROWS), 1)
    dealt = materialize(
        rows.select(
            F.col("user_id").cast("bigint"), F.col("cluster").cast("bigint"), *SCALED,
            F.pmod(F.xxhash64("user_id"), F.lit(blocks)).alias("block"),
        ),
        "silhouette-rows",
    )
    every = F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(blocks - 1).cast("bigint")))
    left = dealt.select("user_id", "cluster", *SCALED, F.col("block").alias("i"), every.alias("j"))
    # names of their own keep the optimizer from taking one side's columns for the other's
    right = dealt.select(
        F.col("cluster").alias("other"), *[F.col(name).alias(f"o_{name}") for name in SCALED],
        every.alias("with_i"), F.col("block").alias("with_j"),
    )
    # a fixed width, because blocks are small in bytes and would be merged into few tasks
    tasks = blocks * blocks
    left, right = left.repartition(tasks, "i", "j"), right.repartition(tasks, "with_i", "with_j")
    sums = (
        left.groupBy("i", "j").cogroup(right.groupBy("with_i", "with_j"))
        .applyInPandas(
            _block_distances(list(SCALED)),
            "user_id bigint, cluster bigint, other bigint, distance double, members bigint",
        )
        .groupBy("user_id", "cluster", "other")
        .agg(F.sum("distance").alias("distance"), F.sum("members").alias("members"))
    )
    own = F.col("cluster") == F.col("other")
    scores = sums.groupBy("user_id").agg(
        F.max(F.when(own, F.col("members"))).alias("size"),
        F.max(F.when(own & (F.col("members") > 1), F.col("distance") / (F.col("members") - 1)))
        .alias("a"),
        F.min(F.when(~own, F.col("distance") / F.col("members"))).alias("b"),
    )
    a, b = F.col("a"), F.col("b")
    wider = F.greatest(a, b)
    score = F.when((F.col("size") > 1) & (wider > 0), (b - a) / wider).otherwise(0.0)
    return scores.agg(F.avg(score).alias("silhouette"))


def squared_silhouette(labelled: DataFrame) -> DataFrame:
    """Mean silhouette over squared distances of all rows, as one row, in linear time.

    The mean squared distance from a row x to a cluster follows from the cluster's count n,
    sum s and sum of squares q as |x|^2 - 2 x.s / n + q / n; inside the own cluster n - 1 rows
    share the sum. A cluster of one row scores 0. Only the clusters' figures reach the driver;
    every row is then scored where it lies.
    """
    square = sum(F.col(name) ** 2 for name in SCALED)
    clusters = labelled.groupBy("cluster").agg(
        F.count(F.lit(1)).alias("n"), F.sum(square).alias("q"),
        F.array(*[F.sum(name) for name in SCALED]).alias("sums"),
    ).orderBy("cluster").collect()
    if not 2 <= len(clusters) < sum(row.n for row in clusters):
        raise ClusteringDataError("Silhouette needs between 2 and number_of_rows - 1 clusters")

    def total(row):
        """What a row's squared distances to a cluster add up to; rounding may leave a hair
        below zero."""
        product = sum(F.col(name) * value for name, value in zip(SCALED, row.sums, strict=True))
        return F.greatest(row.n * square - 2 * product + row.q, F.lit(0.0))

    own = [F.col("cluster") == row.cluster for row in clusters]
    a = F.coalesce(*[F.when(mine, total(row) / (row.n - 1) if row.n > 1 else None)
                     for mine, row in zip(own, clusters, strict=True)])
    b = F.array_min(F.array(*[F.when(~mine, total(row) / row.n)
                              for mine, row in zip(own, clusters, strict=True)]))
    scores = labelled.select(a.alias("a"), b.alias("b"))
    wider = F.greatest("a", "b")
    score = F.when(F.col("a").isNotNull() & (wider > 0), (F.col("b") - F.col("a")) / wider)
    return scores.agg(F.avg(F.coalesce(score, F.lit(0.0))).alias("silhouette"))


def silhouette_rows(
    labelled: DataFrame, sample_size: int, seed: int = DEFAULT_SEED
) -> tuple[DataFrame, int]:
    """The rows to score: one of every cluster, then a reproducible fill up to the bound."""
    if sample_size < 2:
        raise ValueError("silhouette sample size must be at least 2")
    sizes = labelled.groupBy("cluster").agg(F.count(F.lit(1)).alias("n"))
    total = sizes.agg(F.count(F.lit(1)).alias("k"), F.sum("n").alias("n")).first()
    k, n = total["k"], total["n"] or 0
    if not 2 <= k < n:
        raise ClusteringDataError("Silhouette needs between 2 and number_of_rows - 1 clusters")
    size = min(max(sample_size, k + 1), n)
    rows = labelled.select("user_id", "cluster", *SCALED)
    if size == n:
        return rows, n
    key = F.struct(seeded_key(F.col("user_id"), seed).alias("key"), *rows.columns)
    firsts = materialize(
        rows.groupBy("cluster").agg(F.min(key).alias("first"))
        .select(*[F.col(f"first.{name}").alias(name) for name in rows.columns]),
        "silhouette-firsts",
    )
    rest = rows.join(small_broadcast(firsts.select("user_id"), SMALL_CLUSTERS),
                     "user_id", "left_anti")
    return firsts.unionByName(seeded_sample(rest, "user_id", size - k, seed)), size


def bounded_silhouette(
    labelled: DataFrame, sample_size: int, seed: int = DEFAULT_SEED
) -> DataFrame:
    """Mean Euclidean silhouette of a sample of rows; the sample is the point of it."""
    rows, count = silhouette_rows(labelled, sample_size, seed)
    return silhouette(rows, count)


def davies_bouldin(labelled: DataFrame) -> float:
    """Mean over clusters of the worst (spread + spread) / centre distance.

    The scan leaves one row per cluster; only those centres and spreads reach the driver.
    """
    centers = materialize(
        labelled.groupBy("cluster").agg(*[F.avg(name).alias(f"c_{name}") for name in SCALED]),
        "centers",
    )
    squares = sum((F.col(name) - F.col(f"c_{name}")) ** 2 for name in SCALED)
    spreads = (
        labelled.select("cluster", *SCALED)
        .join(small_broadcast(centers, SMALL_CLUSTERS), "cluster")
        .groupBy("cluster", *[f"c_{name}" for name in SCALED])
        .agg(F.avg(F.sqrt(squares)).alias("spread"))
        .orderBy("cluster").collect()
    )
    if len(spreads) < 2:
        raise ClusteringDataError("Davies-Bouldin needs at least 2 clusters")
    points = np.array([[row[f"c_{name}"] for name in SCALED] for row in spreads])
    spread = np.array([row.spread for row in spreads])
    apart = np.sqrt(((points[:, None, :] - points[None, :, :]) ** 2).sum(axis=2))
    both = spread[:, None] + spread[None, :]
    # equal centres do not count against a pair, and a cluster is not its own neighbour
    worst = np.divide(both, apart, out=np.zeros_like(both), where=apart > 0).max(axis=1)
    return float(worst.mean())


def _candidates(
    scaled: DataFrame, count: int, max_k: int, seed: int, n_init: int
) -> list[tuple[dict, Fit]]:
    """(k, inertia, silhouette, selected) of every candidate, with its fit."""
    if count < 3:
        raise ClusteringDataError("At least three rows are required to select K")
    largest = min(max_k, count - 1)
    if largest < 2:
        raise ClusteringDataError("No valid K candidates are available")
    found = []
    for k in range(2, largest + 1):
        fit = fit_kmeans(scaled, k, seed, n_init)
        score = squared_silhouette(fit.frame).first()["silhouette"]
        found.append(({"k": k, "inertia": fit.inertia, "silhouette": score}, fit))
    best, _ = max(found, key=lambda pair: (pair[0]["silhouette"], -pair[0]["k"]))
    return [({**row, "selected": row is best}, fit) for row, fit in found]


def select_k(
    scaled: DataFrame, count: int, *, max_k: int = 10, seed: int = DEFAULT_SEED, n_init: int = 10,
) -> list[dict]:
    """(k, inertia, silhouette, selected) per candidate; the first best score wins. All rows
    are scored, by squared distances."""
    return [row for row, _ in _candidates(scaled, count, max_k, seed, n_init)]


def profile_clusters(labelled: DataFrame) -> DataFrame:
    """Size, name and typical behaviour of every cluster."""
    missing = [n for n in ("user_id", "cluster", *FEATURES) if n not in labelled.columns]
    if missing:
        raise ClusteringDataError(f"Missing profile columns: {', '.join(missing)}")
    orders = F.avg("total_orders")
    return (
        labelled.groupBy("cluster")
        .agg(
            cluster_name(orders).alias("cluster_name"),
            F.count("user_id").alias("num_users"),
            orders.alias("total_orders_mean"),
            F.median("total_orders").alias("total_orders_median"),
            *[F.avg(name).alias(f"{name}_mean") for name in FEATURES[1:]],
        )
        .orderBy("cluster")
    )


def cluster_labels(labelled: DataFrame) -> DataFrame:
    missing = [name for name in ("user_id", "cluster") if name not in labelled.columns]
    if missing:
        raise ClusteringDataError(f"Missing label columns: {', '.join(missing)}")
    return labelled.select("user_id", "cluster").orderBy("user_id")


@dataclass(frozen=True)
class Projection:
    points: DataFrame
    explained: tuple[float, float]


def co_moments(scaled: DataFrame) -> np.ndarray:
    """The covariance matrix of the scaled features, from one pass over the rows."""
    pairs = [(i, j) for i in range(len(SCALED)) for j in range(i, len(SCALED))]
    row = scaled.agg(*[F.covar_pop(SCALED[i], SCALED[j]).alias(f"m{i}_{j}") for i, j in pairs]).first()
    matrix = np.zeros((len(SCALED), len(SCALED)))
    for i, j in pairs:
        matrix[i, j] = matrix[j, i] = row[f"m{i}_{j}"] or 0.0
    return matrix


def fit_invariants(fit: Fit) -> DataFrame:
    """(check_name, value) that hold for every finished fit: all rows labelled, none of them nearer
    to another centre than to its own, every centre the mean of its members, labels in the order
    of the centres."""
    centers = fit.frame.sparkSession.createDataFrame(
        [(i, *c) for i, c in enumerate(fit.centers)], ", ".join(["of int", *(f"c_{n} double" for n in SCALED)]))
    distance = sum((F.col(name) - F.col(f"c_{name}")) ** 2 for name in SCALED)
    near = fit.frame.join(F.broadcast(centers)).groupBy("user_id").agg(
        F.min(distance).alias("least"), F.min(F.when(F.col("of") == F.col("cluster"), distance)).alias("own"))
    rows = near.agg(F.count(F.lit(1)).alias("labelled_rows"),
                    F.count_if(F.col("own") > F.col("least") + 1e-9).alias("rows_nearer_to_another_centre"))
    means = fit.frame.groupBy("cluster").agg(*[F.avg(name).alias(name) for name in SCALED]).join(
        F.broadcast(centers), F.col("of") == F.col("cluster"))
    off = F.greatest(*[F.abs(F.col(name) - F.col(f"c_{name}")) for name in SCALED])
    middle = means.agg(F.count(F.lit(1)).alias("clusters"), F.count_if(off > 1e-2).alias("centres_off_their_members"))
    order = means.agg(F.array_sort(F.collect_list(F.struct("cluster", F.array(*[f"c_{n}" for n in SCALED]).alias("c")))).alias("c")).select(
        F.size(F.filter("c", lambda x, i: (i > 0) & (x["c"] < F.get(F.col("c"), i - 1)["c"]))).cast("bigint").alias("centres_out_of_order"))
    named = lambda df: df.select(F.inline(F.array(*[
        F.struct(F.lit(n).alias("check_name"), F.col(n).cast("bigint").alias("value")) for n in df.columns])))
    return named(rows).unionAll(named(middle)).unionAll(named(order))


def pca_2d(labelled: DataFrame) -> Projection:
    """(user_id, cluster, pc1, pc2) of every row, and the explained variance.

    One combining aggregate gives the co-moments of the features; the axes of that small matrix
    are found on the driver. The sign of a component is fixed by its largest loading.
    """
    moments = co_moments(labelled)
    spread, vectors = np.linalg.eigh(moments)
    largest = np.argsort(spread)[::-1][:2]
    axes = [axis * np.sign(axis[np.argmax(np.abs(axis))]) for axis in vectors[:, largest].T]
    total = float(np.trace(moments)) or 1.0
    points = labelled.select(
        "user_id", "cluster",
        *[sum(F.col(name) * float(weight) for name, weight in zip(SCALED, axis, strict=True))
          .alias(f"pc{place}") for place, axis in enumerate(axes, start=1)],
    )
    return Projection(points, tuple(float(spread[i]) / total for i in largest))


def train(
    features: DataFrame, k: int, *, seed: int = DEFAULT_SEED, n_init: int = 10,
) -> tuple[Fit, dict]:
    """Fit the chosen K on the features; returns the fit and its three scores."""
    features = materialize(features, "features")
    return _train_written(features, require_features(features), k, seed, n_init)


def _train_written(features: DataFrame, count: int, k: int, seed: int, n_init: int) -> tuple[Fit, dict]:
    """The same on written features, which are read three times: checked, measured and scaled."""
    if not 2 <= k < count:
        raise ValueError("k must be between 2 and number_of_users - 1")
    scaled = materialize(standardize(features), "scaled-features")
    return _scored(fit_kmeans(scaled, k, seed, n_init))


def _scored(fit: Fit) -> tuple[Fit, dict]:
    """The fit with its labelled rows written, and its three scores."""
    fit = replace(fit, frame=materialize(fit.frame, "clusters"))
    return fit, {
        "silhouette": squared_silhouette(fit.frame).first()["silhouette"],
        "davies_bouldin": davies_bouldin(fit.frame),
        "inertia": fit.inertia,
    }


def clustering_run(
    wh_features: DataFrame, *, k: int | None = None, max_k: int = 10, min_orders: int = 3,
    seed: int = DEFAULT_SEED, n_init: int = 10,
) -> tuple[Fit, dict]:
    """The whole job: choose K unless given, fit, score; returns the fit and run metadata."""
    features = materialize(wh_features, "features")
    count = require_features(features)
    candidates = []
    if k is None or max_k >= 2:
        scaled = materialize(standardize(features), "scaled-features")
        candidates = _candidates(scaled, count, max_k, seed, n_init)
    chosen = k if k is not None else next(row["k"] for row, _ in candidates if row["selected"])
    known = next((fit for row, fit in candidates if row["k"] == chosen), None)
    # A candidate has been fitted with the seeds and rows that training it again would use.
    fit, metrics = _train_written(features, count, chosen, seed, n_init) if known is None else _scored(known)
    return fit, {
        "feature_columns": list(FEATURES),
        "min_orders": min_orders,
        "n_users": count,
        "random_state": seed,
        "selected_k": chosen,
        "selected_k_source": "override" if k is not None else "silhouette",
        "selection": [row for row, _ in candidates],
        "training_metrics": metrics,
    }
