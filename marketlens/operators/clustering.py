"""Clusters of bars with ``pyspark.ml``, and a table of runs."""

from __future__ import annotations

import math
import pickle
import uuid
from collections.abc import Callable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel, TaskContext, inheritable_thread_target
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.clustering import GaussianMixture, GaussianMixtureModel, KMeans, KMeansModel
from pyspark.ml.evaluation import ClusteringEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.wrapper import JavaWrapper
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketlens.schemas import RUN_SCHEMA
from marketlens.sources.readers import read_parquet_or_none

PRICE_FEATURES = ("Open", "Close")
RANGE_FEATURES = ("Open", "Close", "Volume", "RangeOpen", "RangeLow")
SEED = 123
#: Bytes of plain numbers in a task of a mixture's step.
TASK_BYTES = 64 << 20


def assembler(features: Sequence[str] = PRICE_FEATURES) -> VectorAssembler:
    """Rows with a missing feature cannot be placed and are skipped."""
    return VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="skip")


def kmeans(k: int, seed: int = SEED) -> KMeans:
    return KMeans(k=k, seed=seed, featuresCol="features", predictionCol="prediction")


def gaussian_mixture(k: int, seed: int = SEED) -> GaussianMixture:
    """A seed is always set: the default one changes between processes."""
    return GaussianMixture(k=k, seed=seed, featuresCol="features", predictionCol="prediction")


def kmeans_pipeline(k: int, seed: int = SEED, features: Sequence[str] = PRICE_FEATURES) -> Pipeline:
    return Pipeline(stages=[assembler(features), kmeans(k, seed)])


def gmm_pipeline(k: int, seed: int = SEED, features: Sequence[str] = RANGE_FEATURES) -> Pipeline:
    return Pipeline(stages=[assembler(features), gaussian_mixture(k, seed)])


@contextmanager
def kept(df: DataFrame, columns: Sequence[str]) -> Iterator[DataFrame]:
    """The columns, stored as long as they are read again and again; a stored table is read as it is.

    Plain numbers are stored rather than vectors, which are larger and slow to read back; the copy spills to disk if it must.
    """
    if df.storageLevel != StorageLevel.NONE:
        yield df.select(*columns)
        return
    numbers = df.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        yield numbers
    finally:
        numbers.unpersist()


def fit_kmeans(df: DataFrame, k: int, seed: int = SEED, features: Sequence[str] = PRICE_FEATURES) -> PipelineModel:
    """``kmeans_pipeline(k, seed, features).fit(df)`` over a stored copy of the features, as a fit reads its input many times."""
    with kept(df, features) as numbers:
        return kmeans_pipeline(k, seed, features).fit(numbers)


def fit_mixture(df: DataFrame, k: int, seed: int = SEED, features: Sequence[str] = RANGE_FEATURES) -> PipelineModel:
    """``gmm_pipeline(k, seed, features).fit(df)``, by ``fit_mixtures``.

    The start is drawn from ``df`` as it is dealt out, as a stored copy may be dealt otherwise and would start elsewhere.
    """
    start = gaussian_mixture(k, seed).setMaxIter(0).fit(assembler(features).transform(df))
    with kept(df, features) as numbers:
        return PipelineModel([assembler(features), fit_mixtures(numbers, features, [(k, seed)], [start])[0][0]])


def fit_mixtures(
    numbers: DataFrame, features: Sequence[str], wanted: Sequence[tuple[int, int]], starts: Sequence[GaussianMixtureModel] | None = None
) -> list[tuple[GaussianMixtureModel, float]]:
    """A mixture for each ``k, seed``, and its log-likelihood before the last step.

    Start, steps, number of steps and tolerance are those of ``GaussianMixture``.  All mixtures take a step in the same pass
    over the rows, which are stored in blocks of plain numbers; a task returns the sums of its rows, which are as large as
    the models.
    """
    vectors = assembler(features).transform(numbers).select("features")
    starts = starts or [gaussian_mixture(k, seed).setMaxIter(0).fit(vectors) for k, seed in wanted]
    state = [([*m.weights], [g.mean.toArray() for g in m.gaussians], [g.cov.toArray() for g in m.gaussians]) for m in starts]
    likely, before, open_ = [-float(np.finfo(float).max)] * len(wanted), [0.0] * len(wanted), list(range(len(wanted)))
    most, tolerance, d = GaussianMixture().getMaxIter(), GaussianMixture().getTol(), len(features)
    upper = np.triu_indices(d)
    blocks = _blocks(numbers, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        for _ in range(most):
            open_ = [m for m in open_ if abs(likely[m] - before[m]) > tolerance]
            if not open_:
                break
            parts = blocks.mapInArrow(_expectation(d, [_components(*state[m]) for m in open_]), "sums binary").collect()
            sums = np.sum([np.frombuffer(p["sums"]) for p in parts], axis=0)
            for m in open_:
                k = len(state[m][0])
                own, sums = sums[:1 + k * (1 + d + len(upper[0]))], sums[1 + k * (1 + d + len(upper[0])):]
                before[m], likely[m] = likely[m], float(own[0])
                n, x, xx = np.split(own[1:].reshape(k, -1), [1, 1 + d], axis=1)
                means, covs = x / n, np.zeros((k, d, d))
                covs[:, upper[0], upper[1]] = covs[:, upper[1], upper[0]] = xx / n - means[:, upper[0]] * means[:, upper[1]]
                state[m] = list(n[:, 0] / n.sum()), list(means), list(covs)
    finally:
        blocks.unpersist()
    return [(_mixture_model(gaussian_mixture(*w), start.uid, *now), like) for w, start, now, like in zip(wanted, starts, state, likely)]


def _blocks(numbers: DataFrame, features: Sequence[str]) -> DataFrame:
    """Complete rows in blocks of plain numbers."""
    blocks = numbers.select(*[F.col(c).cast("double").alias(f"x{i}") for i, c in enumerate(features)]).na.drop()
    # Each step is a short job, so tasks are as few as the cores unless their blocks would be large.
    tasks = max(numbers.sparkSession.sparkContext.defaultParallelism, math.ceil(numbers.count() * len(features) * 8 / TASK_BYTES))
    return blocks.coalesce(tasks).mapInArrow(_packing(), "block binary")


def _packing() -> Callable:
    """Makes each batch one block, feature by feature; an inner function, as workers need not have this module."""
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            block = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns])
            yield pa.RecordBatch.from_arrays([pa.array([block.tobytes()], pa.binary())], names=["block"])

    return pack


def _expectation(d: int, mixtures: list) -> Callable:
    """For each mixture the log-likelihood of a task's rows, and each component's sums of shares, rows and products."""
    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        upper, told = np.triu_indices(d), None
        for batch in batches:
            for block in batch.column(0):
                x = np.frombuffer(block.as_buffer()).reshape(d, -1)
                powers = np.concatenate([np.ones((1, x.shape[1])), x, x[upper[0]] * x[upper[1]]])
                out = []
                for components in mixtures:
                    shares = np.empty((len(components), x.shape[1]))
                    for i, (weight, mean, scaled, volume) in enumerate(components):
                        away = scaled @ (x - mean[:, None])
                        shares[i] = np.exp(-volume - 0.5 * (away * away).sum(axis=0))
                        shares[i] *= weight
                    # What a fitted mixture adds when it places rows, so that rows far from all components tie.
                    shares += np.finfo(float).eps
                    whole = shares.sum(axis=0)
                    shares /= whole
                    out += [[np.log(whole).sum()], (shares @ powers.T).ravel()]
                told = np.concatenate(out) if told is None else told + np.concatenate(out)
        if told is not None:
            yield pa.RecordBatch.from_arrays([pa.array([told.tobytes()], pa.binary())], names=["sums"])

    return step


def _directions(cov: np.ndarray) -> tuple[np.ndarray, float]:
    """Independent directions of unit spread, a row each, and the log volume; a direction without spread counts in neither."""
    values, vectors = np.linalg.eigh(cov)
    real = values > np.finfo(float).eps * max(values.max(), 0) * len(values)
    volume = 0.5 * (len(values) * math.log(2 * math.pi) + float(np.log(values[real]).sum()))
    return (vectors[:, real] / np.sqrt(values[real])).T, volume


def _components(weights: list, means: list, covs: list) -> list[tuple]:
    out = []
    for weight, mean, cov in zip(weights, means, covs):
        scaled, volume = _directions(cov)
        if not len(scaled):
            raise ValueError("a component of the mixture has no spread")
        out.append((weight, mean, scaled, volume))
    return out


def _mixture_model(fit: GaussianMixture, uid: str, weights: list, means: list, covs: list) -> GaussianMixtureModel:
    """The model that ``fit`` would have made."""
    jvm = SparkSession.active()._jvm
    vectors, matrices = jvm.org.apache.spark.ml.linalg.Vectors, jvm.org.apache.spark.ml.linalg.Matrices
    numbers = lambda a: JavaWrapper._new_java_array([float(x) for x in a], jvm.double)
    gaussians = [
        jvm.org.apache.spark.ml.stat.distribution.MultivariateGaussian(
            vectors.dense(numbers(mean)), matrices.dense(len(mean), len(mean), numbers(cov.ravel(order="F")))
        ) for mean, cov in zip(means, covs)
    ]
    made = jvm.org.apache.spark.ml.clustering.GaussianMixtureModel(
        uid, numbers(weights), JavaWrapper._new_java_array(gaussians, jvm.org.apache.spark.ml.stat.distribution.MultivariateGaussian)
    )
    return fit._copyValues(GaussianMixtureModel(made))


def fit_kmeans_sweep(numbers: DataFrame, features: Sequence[str], wanted: Sequence[tuple[int, int]]) -> list[tuple[KMeansModel, float]]:
    """A k-means model for each ``k, seed``, and its mean silhouette.

    Start (k-means||), steps, number of steps and tolerance are those of ``KMeans``, with draws of its own.  All models take a step
    in the same pass over the rows, which are stored in blocks of plain numbers; a task returns sums, or the few rows it draws.
    """
    d, vectors = len(features), assembler(features).transform(numbers).select("features")
    blocks = _blocks(numbers, features).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        starts = _scattered(blocks, d, wanted)
        if starts is None:  # no row: as the library has it
            return [(m, silhouette(m.transform(vectors))) for m in (kmeans(*w).fit(vectors) for w in wanted)]
        state, open_, steps = starts, list(range(len(wanted))), [0] * len(wanted)
        for _ in range(KMeans().getMaxIter()):
            if not open_:
                break
            moved = []
            for m, sums in zip(open_, _told(blocks, d, [state[m] for m in open_], _sums_of_nearest())):
                n = sums[0][:, None]
                after = np.where(n > 0, sums[1:1 + d].T / np.maximum(n, 1), state[m])
                if (((after - state[m]) ** 2).sum(axis=1) > KMeans().getTol() ** 2).any():
                    moved.append(m)
                state[m], steps[m] = after, steps[m] + 1
            open_ = moved
        # Distances don't change if all rows move, and small numbers lose fewer digits in the squares.
        sums = _told(blocks, d, [c for c in state], _sums_of_nearest())
        middle = sums[0][1:1 + d].sum(axis=1) / sums[0][0].sum()
        state_moved = [c - middle for c in state]
        sums = _told(blocks, d, state_moved, _sums_of_nearest(), middle)
        scores = _told(blocks, d, state_moved, _silhouette_of_nearest(sums), middle)
    finally:
        blocks.unpersist()
    out = []
    for (k, seed), centres, own, score, n in zip(wanted, state, sums, scores, steps):
        model = _kmeans_model(kmeans(k, seed), centres, float(own[-1].sum()), n)
        out.append((model, float(score / own[0].sum()) if (own[0] > 0).sum() > 1 else silhouette(model.transform(vectors))))
    return out


def _told(blocks: DataFrame, d: int, centres: Sequence[np.ndarray], tell: Callable, middle: np.ndarray | None = None) -> list:
    """For each set of centres the sum of what ``tell`` says of the blocks, given each row's nearest centre and its squared distance."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told, number, task = None, 0, TaskContext.get().partitionId()
        for batch in batches:
            for block in batch.column(0):
                x = np.frombuffer(block.as_buffer()).reshape(d, -1)
                x = x if middle is None else x - middle[:, None]
                now = []
                for m, points in enumerate(centres):
                    least, near = np.full(x.shape[1], np.inf), np.zeros(x.shape[1], np.int64)
                    for i, point in enumerate(points):
                        gap = (x[0] - point[0]) ** 2
                        for c in range(1, d):
                            gap += (x[c] - point[c]) ** 2
                        np.copyto(near, i, where=gap < least)
                        np.minimum(least, gap, out=least)
                    now.append(tell(m, x, near, least, len(points), (task, number)))
                told = now if told is None else [a + b for a, b in zip(told, now)]
                number += 1
        if told is not None:
            yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(told)], pa.binary())], names=["told"])

    parts = [pickle.loads(r["told"]) for r in blocks.mapInArrow(run, "told binary").collect()]
    return [sum(p[1:], p[0]) for p in zip(*parts)]


def _sums_of_nearest() -> Callable:
    """For each centre the number of its rows, their sums, their squares and their squared distances."""
    def tell(m: int, x: np.ndarray, near: np.ndarray, least: np.ndarray, k: int, block: tuple) -> np.ndarray:
        weights = [None, *x, (x * x).sum(axis=0), least]
        return np.stack([np.bincount(near, w, minlength=k).astype(float) for w in weights])

    return tell


def _silhouette_of_nearest(sums: Sequence[np.ndarray]) -> Callable:
    """The sum of the rows' scores, as ``silhouette_by_sums`` has them."""
    def tell(m: int, x: np.ndarray, near: np.ndarray, least: np.ndarray, k: int, block: tuple) -> float:
        n, total, squares = sums[m][0], sums[m][1:-2], sums[m][-2]
        square = (x * x).sum(axis=0)
        whole = np.stack([square * n[c] + squares[c] - 2 * (total[:, c] @ x) for c in range(k)])  # to all rows of a cluster
        own = np.take_along_axis(whole, near[None], axis=0)[0] / np.maximum(n[near] - 1, 1)
        for c in range(k):
            whole[c] = np.where(near == c, np.inf, whole[c] / n[c]) if n[c] else np.inf
        other = whole.min(axis=0)
        most = np.maximum(own, other)
        scored = (n[near] > 1) & (most > 0)
        return float(((other - own)[scored] / most[scored]).sum())

    return tell


def _scattered(blocks: DataFrame, d: int, wanted: Sequence[tuple[int, int]]) -> list[np.ndarray] | None:
    """Starts by k-means||: a row, then rows drawn by their distance from those drawn so far, weighted and taken down to ``k``."""
    def drawing(step: int, chances: Sequence[float]) -> Callable:
        def tell(m: int, x: np.ndarray, near: np.ndarray, least: np.ndarray, k: int, block: tuple) -> list:
            # A seed has no sign here.
            draws = np.random.default_rng([wanted[m][1] & (1 << 64) - 1, step, *block]).random(x.shape[1])
            if not step:  # the smallest draw of all rows
                at = int(draws.argmin())
                return [(draws[at], x[:, at].tolist())]
            return [(0.0, row) for row in x[:, draws < chances[m] * least].T.tolist()]

        return tell

    nothing = [np.zeros((0, d))] * len(wanted)
    first = _told(blocks, d, nothing, drawing(0, []))
    if not first:
        return None
    drawn = [np.array([min(f)[1]]) for f in first]
    for step in range(1, KMeans().getInitSteps() + 1):
        costs = [float(s[-1].sum()) for s in _told(blocks, d, drawn, _sums_of_nearest())]
        chances = [2.0 * k / cost if cost > 0 else 0.0 for (k, _), cost in zip(wanted, costs)]
        more = _told(blocks, d, drawn, drawing(step, chances))
        drawn = [np.unique(np.array([*c.tolist(), *(row for _, row in rows)]), axis=0) for c, rows in zip(drawn, more)]
    weights = [s[0] for s in _told(blocks, d, drawn, _sums_of_nearest())]
    return [c if len(c) <= k else _taken_down(c, w, k, seed) for (k, seed), c, w in zip(wanted, drawn, weights)]


def _taken_down(points: np.ndarray, weights: np.ndarray, k: int, seed: int, tries: int = 10) -> np.ndarray:
    """``k`` centres of weighted points: k-means++, then 30 steps at most, the cheapest of several tries."""
    rng, found = np.random.default_rng(seed & (1 << 64) - 1), []
    apart = lambda centres: ((points[:, None] - centres[None]) ** 2).sum(axis=2)
    for _ in range(tries):
        centres = points[[rng.choice(len(points), p=weights / weights.sum())]]
        while len(centres) < k:
            share = weights * apart(centres).min(axis=1)
            left = share if share.sum() > 0 else np.ones(len(points))
            centres = np.append(centres, points[[rng.choice(len(points), p=left / left.sum())]], axis=0)
        near = None
        for _ in range(30):
            before, near = near, apart(centres).argmin(axis=1)
            if before is not None and (before == near).all():
                break
            for c in range(k):
                own = near == c
                # An empty cluster starts again elsewhere.
                centres[c] = np.average(points[own], axis=0, weights=weights[own]) if weights[own].sum() > 0 else points[rng.integers(len(points))]
        found.append((float((weights * apart(centres).min(axis=1)).sum()), centres))
    return min(found, key=lambda f: f[0])[1]


def _kmeans_model(fit: KMeans, centres: np.ndarray, cost: float, steps: int) -> KMeansModel:
    """The model that ``fit`` would have made."""
    jvm = SparkSession.active()._jvm
    vectors = jvm.org.apache.spark.mllib.linalg.Vectors
    points = [vectors.dense(JavaWrapper._new_java_array([float(x) for x in c], jvm.double)) for c in centres]
    points = JavaWrapper._new_java_array(points, jvm.org.apache.spark.mllib.linalg.Vector)
    old = jvm.org.apache.spark.mllib.clustering.KMeansModel(points, fit.getDistanceMeasure(), cost, steps)
    return fit._copyValues(KMeansModel(jvm.org.apache.spark.ml.clustering.KMeansModel(fit.uid, old)))


def silhouette(predictions: DataFrame) -> float:
    return ClusteringEvaluator(
        featuresCol="features", predictionCol="prediction", metricName="silhouette"
    ).evaluate(predictions)


def _squares(columns: Sequence[Column]) -> Column:
    return sum((c * c for c in columns), F.lit(0.0))


def silhouette_by_sums(df: DataFrame, features: Sequence[str], label: str = "prediction") -> float | None:
    """Mean silhouette under squared distances, from the number, the sums and the squares of each cluster.

    The mean squared distance of a row to a cluster is its own square, plus the mean square of the cluster, less twice the
    product with the cluster's mean; so two passes and a table of clusters do, and no pair is looked at.  A row alone in its
    cluster scores 0.  Rows with a missing feature or label are skipped; fewer than two clusters have no silhouette.
    """
    # The rows are read three times; placing them, which a label may mean, costs more than reading it again.
    with kept(df, [label, *features]) as placed:
        return _silhouette_by_sums(placed, features, label)


def _silhouette_by_sums(df: DataFrame, features: Sequence[str], label: str) -> float | None:
    ready = df.select(label, *[F.col(c).cast("double").alias(c) for c in features]).na.drop()
    # Distances don't change if all rows move, and small numbers lose fewer digits in the squares.
    middle = ready.agg(*[F.avg(c).alias(c) for c in features]).first()
    moved = [F.col(c) - F.lit(m) for c, m in zip(features, middle)]
    clusters = ready.groupBy(label).agg(
        F.count(F.lit(1)).alias("n"), F.sum(_squares(moved)).alias("squares"), *[F.sum(x).alias(f"s{i}") for i, x in enumerate(moved)]
    ).orderBy(label).collect()  # a row for each cluster
    if len(clusters) < 2:
        return None

    def distance(c) -> Column:
        """The sum of squared distances to the rows of cluster ``c``."""
        product = sum((F.col(f"x{i}") * F.lit(c[f"s{i}"]) for i in range(len(features))), F.lit(0.0))
        return F.col("square") * F.lit(float(c["n"])) + F.lit(c["squares"]) - 2 * product

    # Column by column, as what is used more than once would be worked out as often.
    rows = ready.select(F.col(label).alias("label"), _squares(moved).alias("square"), *[x.alias(f"x{i}") for i, x in enumerate(moved)])
    rows = rows.select("label", *[distance(c).alias(f"d{j}") for j, c in enumerate(clusters)])
    own, other = F.lit(None).cast("double"), []
    for j, c in enumerate(clusters):
        mine = F.col("label") == c[label]
        own = F.when(mine, F.col(f"d{j}") / F.lit(float(max(1, c["n"] - 1)))).otherwise(own)
        other.append(F.when(~mine, F.col(f"d{j}") / F.lit(float(c["n"]))))
    alone = F.col("label").isin([c[label] for c in clusters if c["n"] == 1])
    rows = rows.select(alone.alias("alone"), own.alias("own"), F.array_min(F.array(*other)).alias("near"))
    rows = rows.select("alone", "own", "near", F.greatest("own", "near").alias("most"))
    score = F.when(F.col("alone") | (F.col("most") <= 0), F.lit(0.0)).otherwise((F.col("near") - F.col("own")) / F.col("most"))
    return rows.agg(F.avg(score)).first()[0]


def centre_distances(model: KMeansModel, features: Sequence[str]) -> Column:
    """Array of the squared distances to the centres."""
    return F.array(*[_squares([F.col(c) - F.lit(float(x)) for c, x in zip(features, centre)]) for centre in model.clusterCenters()])


def kmeans_cost(df: DataFrame, model: KMeansModel, features: Sequence[str]) -> float:
    """Sum of the squared distances to the nearest centre; rows with a missing feature are skipped."""
    ready = df.select(*features).na.drop()
    return ready.agg(F.sum(F.array_min(centre_distances(model, features)))).first()[0] or 0.0


def mixture_log_densities(model: GaussianMixtureModel, features: Sequence[str]) -> Column:
    """Array of each component's log weight and log density at the row.

    A covariance is turned into independent directions on the driver, where it is as large as the number of features.
    """
    out = []
    for weight, gaussian in zip(model.weights, model.gaussians):
        scaled, volume = _directions(gaussian.cov.toArray())
        apart = [F.col(c).cast("double") - F.lit(float(m)) for c, m in zip(features, gaussian.mean.toArray())]
        away = [sum((x * F.lit(float(w)) for x, w in zip(apart, column)), F.lit(0.0)) for column in scaled]
        out.append(F.lit(math.log(weight) if weight > 0 else -math.inf) - F.lit(volume) - _squares(away) / 2)
    return F.array(*out)


def mixture_log_likelihood(df: DataFrame, model: GaussianMixtureModel, features: Sequence[str]) -> float:
    """Sum over the rows of the log of the mixture's density, without leaving the logarithm; incomplete rows are skipped."""
    ready = df.select(*features).na.drop().select(mixture_log_densities(model, features).alias("logs"))
    most = F.array_max("logs")
    whole = F.aggregate("logs", F.lit(0.0), lambda a, x: a + F.exp(x - most))
    return ready.agg(F.sum(most + F.log(whole))).first()[0] or 0.0


def _sweep(
    df: DataFrame, features: Sequence[str], ks: Sequence[int], score: Callable[[DataFrame, int], tuple], parallelism: int,
) -> list[tuple]:
    """``k``, metrics and fitted model for every ``k``, over one stored copy of the feature columns.

    A fit keeps vectors of its own while it runs, so ``parallelism`` bounds how many such copies exist at a time.
    """
    with kept(df, features) as numbers:
        vectors = assembler(features).transform(numbers).select("features")
        return [(k, *told) for k, told in zip(ks, _side_by_side(df.sparkSession, lambda k: score(vectors, k), ks, parallelism))]


def _side_by_side(spark: SparkSession, fit: Callable, inputs: Sequence, parallelism: int) -> list:
    """Independent fits as concurrent jobs, so that short iterations do not wait for each other."""
    with ThreadPoolExecutor(max_workers=parallelism) as pool:
        return list(pool.map(inheritable_thread_target(spark)(fit), inputs))


def _runs(spark: SparkSession, scored: list[tuple], seed: int, features: Sequence[str], models: str | None, experiment: str | None) -> DataFrame:
    """Rows of the run table; with ``models``, each run's pipeline is saved there under its id."""
    rows = []
    for k, metrics, model in scored:
        run_id = uuid.uuid4().hex
        if models:
            save_model(PipelineModel([assembler(features), model]), f"{models}/{run_id}")
        rows.append((run_id, {"k": str(k), "seed": str(seed)}, metrics, experiment))
    return spark.createDataFrame(rows, RUN_SCHEMA)


def k_by_silhouette(
    df: DataFrame, ks: Sequence[int] = (2, 3, 4, 5), seed: int = SEED, features: Sequence[str] = PRICE_FEATURES,
    parallelism: int = 2, models: str | None = None, experiment: str | None = None,
) -> DataFrame:
    """Runs of k-means with their silhouette; ``best_run(runs, "silhouette")`` picks one.

    All fits share their passes, so ``parallelism`` is not needed any more.
    """
    with kept(df, features) as numbers:
        fitted = fit_kmeans_sweep(numbers, features, [(k, seed) for k in ks])
    scored = [(k, {"silhouette": score}, model) for k, (model, score) in zip(ks, fitted)]
    return _runs(df.sparkSession, scored, seed, features, models, experiment)


def k_by_cost(
    df: DataFrame, ks: Sequence[int] = (2, 3, 4, 5, 6), seed: int = SEED, features: Sequence[str] = PRICE_FEATURES,
    parallelism: int = 2, models: str | None = None, experiment: str | None = None,
) -> DataFrame:
    """Runs with training cost and its negative, ``score``; the lowest cost is the best run.

    Cost nearly always falls with ``k``, so the drop from the run before is recorded
    as ``elbow_gain``.
    """
    def score(vectors: DataFrame, k: int) -> tuple:
        model = kmeans(k, seed).fit(vectors)
        cost = float(model.summary.trainingCost)
        return {"cost": cost, "score": -cost}, model

    scored = _sweep(df, features, ks, score, parallelism)
    for (_, before, _), (_, after, _) in zip(scored, scored[1:]):
        after["elbow_gain"] = before["cost"] - after["cost"]
    return _runs(df.sparkSession, scored, seed, features, models, experiment)


def k_by_loglik(
    df: DataFrame, ks: Sequence[int] = (2, 3, 4, 5, 6), seed: int = SEED, features: Sequence[str] = PRICE_FEATURES,
    models: str | None = None, experiment: str | None = None,
) -> DataFrame:
    """Runs of the Gaussian mixture with their log-likelihood; the highest is the best run."""
    with kept(df, features) as numbers:
        fitted = fit_mixtures(numbers, features, [(k, seed) for k in ks])
    scored = [(k, {"log_likelihood": likely}, model) for k, (model, likely) in zip(ks, fitted)]
    return _runs(df.sparkSession, scored, seed, features, models, experiment)


def gmm_repeat(
    df: DataFrame, repetitions: int = 5, k: int = 2, seed: int = SEED
) -> DataFrame:
    """Assignments of several fits with different seeds, told apart by ``rep`` from 1.

    All models place a row in the same pass over the table.
    """
    with kept(df, RANGE_FEATURES) as numbers:
        models = [m for m, _ in fit_mixtures(numbers, RANGE_FEATURES, [(k, seed + i) for i in range(repetitions)])]
    ready = assembler(RANGE_FEATURES).transform(df)
    placed = ready.select("Ticker", "Date", "features")
    for i, model in enumerate(models):
        placed = model.setPredictionCol(f"p{i}").setProbabilityCol(f"q{i}").transform(placed).drop(f"q{i}")
    each = F.array(*[
        F.struct(F.col(f"p{i}").alias("prediction"), F.lit(i + 1).alias("rep")) for i in range(repetitions)
    ])
    return placed.select("Ticker", "Date", F.inline(each))


def label_with_both(df: DataFrame, k: int = 2, seed: int = SEED) -> DataFrame:
    """``kmeans_cluster`` on the two prices and ``gmm_cluster`` on all five features of the same rows."""
    centres, mixture = kmeans_pipeline(k, seed).fit(df), fit_mixture(df, k, seed)
    first = centres.transform(df).withColumnRenamed("prediction", "kmeans_cluster")
    both = mixture.transform(first.drop("features"))
    return both.withColumnRenamed("prediction", "gmm_cluster").drop("features", "probability")


# --- runs and models ------------------------------------------------------------

def record_runs(runs: DataFrame, path: str) -> None:
    runs.write.mode("append").parquet(path)


def read_runs(spark: SparkSession, path: str, experiment: str | None = None) -> DataFrame:
    """The stored runs, of one experiment if named; none where nothing was stored yet."""
    stored = read_parquet_or_none(spark, path)
    runs = spark.createDataFrame([], RUN_SCHEMA) if stored is None else spark.read.schema(RUN_SCHEMA).parquet(path)
    return runs if experiment is None else runs.filter(F.col("experiment") == experiment)


def run_listing(runs: DataFrame) -> DataFrame:
    """One row per run and entry: ``run_id, kind, name, value``."""
    params = runs.select("run_id", F.lit("param").alias("kind"), F.explode("params").alias("name", "value"))
    metrics = runs.select("run_id", F.lit("metric").alias("kind"), F.explode("metrics").alias("name", "value"))
    return params.unionByName(metrics.withColumn("value", F.col("value").cast("string")))


def save_model(model: PipelineModel, path: str) -> None:
    model.write().overwrite().save(path)


def load_model(path: str) -> PipelineModel:
    return PipelineModel.load(path)


def load_run(models: str, run_id: str) -> PipelineModel:
    """The pipeline that a run of a sweep stored."""
    return load_model(f"{models}/{run_id}")
