"""Fare models on Spark ML: split, train, compare, tune, explain."""

from multiprocessing.pool import ThreadPool

import numpy as np
from pyspark.ml.evaluation import RegressionEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    DecisionTreeRegressor,
    GBTRegressor,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions import fixed
from fareloom.functions.numbers import mape, ratio_pct, round_to
from fareloom.operators.features import TARGET
from fareloom.operators.forests import FoldedForest, fit_forest, grid_scores
from fareloom.operators.joins import cross_one
from fareloom.operators.quality import union_all
from fareloom.session import materialize, shared_dir

# 32 candidate splits per feature: what a node costs grows with the bins, not with the rows. Each task holds the
# statistics of as many nodes as fit in the memory given here, and there are several tasks in an executor.
TREES = dict(maxBins=32, maxMemoryInMB=256, seed=fixed.SPLIT_SEED)
#: Rows a partition should have at least: every partition has statistics of every node to hand in.
PARTITION_ROWS = 1 << 13
#: Fits of a cross-validation that run side by side; each is many short jobs.
PARALLEL_FITS = 4
#: From so many rows on, trees are grown from rows with equal features put together, if these are no more than ``FOLDED_ROWS``.
FOLD_ROWS, FOLDED_ROWS = 1 << 17, 1 << 20
#: Bytes of predictions by vector up to which they are broadcast to the rows.
PREDICTION_BYTES = 64 << 20


def _place(key: str, seed: int, parts: int):
    """A number below ``parts`` from the first 13 hex digits of an md5, which any SQL engine can repeat; null keys have one too."""
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), F.col(key).cast("string")))
    return F.pmod(F.conv(F.substring(digest, 1, 13), 16, 10).cast("bigint"), F.lit(parts))


def train_test_split(df: DataFrame, key="id", seed=fixed.SPLIT_SEED, test_pct=fixed.TEST_PCT) -> DataFrame:
    """Adds ``is_test`` from a hash of the key: the same rows on every run and partitioning."""
    return df.withColumn("is_test", _place(key, seed, 100) < test_pct)


def with_folds(df: DataFrame, key="id", seed=fixed.SPLIT_SEED, k=fixed.FOLDS) -> DataFrame:
    return df.withColumn("fold", _place(key, seed + 1, k).cast("int"))


def assemble(df: DataFrame, features, label=TARGET) -> DataFrame:
    """Vector column ``features`` and ``label`` next to the other columns."""
    out = VectorAssembler(inputCols=list(features), outputCol="features").transform(df)
    return out.withColumn("label", F.col(label).cast("double")) if label in df.columns else out


def spread(df: DataFrame) -> DataFrame:
    """The frame kept for the passes of an iterative fit, in no more partitions than cores unless it has more, and in
    fewer where they would hold less than ``PARTITION_ROWS`` rows."""
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df.rdd.getNumPartitions()
    if parts <= cores:
        wanted = min(cores, max(1, df.count() // PARTITION_ROWS))
        df = df.repartition(wanted) if wanted > parts else df.coalesce(wanted)
    return df.persist()


def folded(df: DataFrame, *by) -> DataFrame | None:
    """Rows with equal features as one: ``weight`` of them, ``label`` their mean, ``within`` the squares about it; written.

    No split parts such rows, so the squares within are the same on both sides of a gain and a tree comes out as from the
    single rows. None where the rows are few, or the distinct ones too many for that.
    """
    if df.count() < FOLD_ROWS:
        return None
    n = F.count(F.lit(1)).cast("double")
    sums = [n.alias("weight"), F.avg("label").alias("label"), (F.var_pop("label") * n).alias("within")]
    out = materialize(df.groupBy("features", *by).agg(*sums), "folded")
    return out if out.count() <= FOLDED_ROWS * (1 if not by else fixed.FOLDS) else None


def weighted(estimator, least: int, rows: float):
    """The estimator for folded rows: the smallest leaf is one of ``least`` rows, not of as many vectors."""
    return estimator.copy({
        estimator.weightCol: "weight", estimator.minInstancesPerNode: 1, estimator.minWeightFractionPerNode: min(0.49, (least - 0.5) / rows),
    })


def _linear(**params):
    return LinearRegression(standardization=False, solver="normal", **params)


def linear(train):
    return _linear(regParam=0.0)


def ridge(train, alpha=fixed.RIDGE_ALPHA):
    """Penalty alpha * |w|^2 on the sum of squares. Spark averages the squares and divides the
    penalty by the deviation of the label, so both are put back."""
    stats = train.agg(F.count("label").alias("n"), F.stddev_pop("label").alias("s")).first()
    return _linear(regParam=alpha * (stats["s"] or 1.0) / max(stats["n"], 1), elasticNetParam=0.0)


def lasso(train, alpha=fixed.LASSO_ALPHA):
    return _linear(
        regParam=alpha, elasticNetParam=1.0, maxIter=fixed.LASSO_MAX_ITER, tol=1e-9
    )


def tree(train, depth=8, min_split=2):
    """A node is split from ``min_split`` rows on; Spark limits the leaves instead."""
    return DecisionTreeRegressor(maxDepth=depth, minInstancesPerNode=max(1, min_split // 2), **TREES)


def forest(train, trees=200, depth=15, min_split=5):
    """The node of each row in each tree is kept next to the rows, so that the growing trees need not be sent to every task."""
    return RandomForestRegressor(
        numTrees=trees, maxDepth=depth, minInstancesPerNode=max(1, min_split // 2),
        featureSubsetStrategy="all", cacheNodeIds=True, checkpointInterval=10, **TREES,
    )


def boosted(train, trees=200, depth=5, min_split=5):
    return GBTRegressor(
        maxIter=trees, stepSize=0.1, maxDepth=depth, subsamplingRate=0.8,
        minInstancesPerNode=max(1, min_split // 2), **TREES,
    )


MODELS = {
    "linear_regression": linear,
    "ridge": ridge,
    "lasso": lasso,
    "random_forest": forest,
    "gradient_boosting": boosted,
}


def keep_checkpoints(spark) -> None:
    """Tree ensembles cut their lineage in the shared folder every few rounds."""
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(shared_dir(spark))


def fit(name: str, train: DataFrame, vectors: DataFrame | None = None, **params):
    """``vectors`` are the folded rows of ``train``, if they are known."""
    keep_checkpoints(train.sparkSession)
    estimator = MODELS.get(name, tree)(train, **params)
    if not hasattr(estimator, "minInstancesPerNode"):
        return fit_rows(estimator, train, None)
    return fit_rows(estimator, train, folded(train) if vectors is None else vectors)


def fit_rows(estimator, train: DataFrame, vectors: DataFrame | None):
    """Fit to the rows, trees and ensembles to the folded ones if there are any."""
    if vectors is None:
        return estimator.fit(train)
    least = estimator.getMinInstancesPerNode()
    if isinstance(estimator, RandomForestRegressor):
        return fit_forest(train, vectors, estimator.getNumTrees(), estimator.getMaxDepth(), least, estimator.getMaxBins(), estimator.getSeed())
    rows = vectors.agg(F.sum("weight").alias("n")).first()["n"]
    few = spread(vectors)
    model = weighted(estimator, least, rows).fit(few)
    few.unpersist()
    return model


def reg_metrics(df: DataFrame, actual="label", predicted="prediction", prefix="") -> DataFrame:
    """R2, MAE, RMSE and MAPE from one aggregate."""
    a, p = F.col(actual), F.col(predicted)
    n = F.count(a - p)
    squares = F.sum((a - p) * (a - p))
    r2 = 1 - squares / F.nullif(F.var_pop(a) * n, F.lit(0.0))
    return df.agg(
        round_to(r2, 4).alias(f"{prefix}r2"),
        round_to(F.avg(F.abs(a - p)), 2).alias(f"{prefix}mae"),
        round_to(F.sqrt(squares / F.nullif(n, F.lit(0))), 2).alias(f"{prefix}rmse"),
        round_to(mape(actual, predicted), 2).alias(f"{prefix}mape"),
    )


def residuals(df: DataFrame, actual="label", predicted="prediction") -> DataFrame:
    return df.withColumn("residual", F.col(actual) - F.col(predicted))


def _fit_of(mask, prediction: str, prefix="") -> list:
    """R2, MAE, RMSE and MAPE of a prediction column over the rows of a mask, as parts of one aggregate."""
    a = F.col("label")
    error = F.when(mask, a - F.col(prediction))
    n, squares = F.count(error), F.sum(error * error)
    return [
        round_to(1 - squares / F.nullif(F.var_pop(F.when(mask, a)) * n, F.lit(0.0)), 4).alias(f"{prefix}r2"),
        round_to(F.avg(F.abs(error)), 2).alias(f"{prefix}mae"),
        round_to(F.sqrt(squares / F.nullif(n, F.lit(0))), 2).alias(f"{prefix}rmse"),
        round_to(F.avg(F.abs(error / F.nullif(a, F.lit(0.0)))) * 100, 2).alias(f"{prefix}mape"),
    ]


def _predicted(model, df: DataFrame, column: str) -> DataFrame:
    return model.copy({model.predictionCol: column}).transform(df)


def _by_vector(fitted: dict, rows: DataFrame) -> DataFrame | None:
    """The labels of rows with the predictions p0, p1, ...: each distinct vector is scored once, where they are few as in ``folded``.

    A 64-bit hash joins both, if no two of the vectors share one.
    """
    if rows.count() < FOLD_ROWS:
        return None
    key, cores = F.xxhash64("features").alias("vector"), rows.sparkSession.sparkContext.defaultParallelism
    vectors = materialize(rows.select("features").distinct().select("features", key), "vectors")
    n = vectors.agg(F.count("vector").alias("all"), F.countDistinct("vector").alias("unlike")).first()
    if n["all"] > FOLDED_ROWS or n["all"] != n["unlike"]:
        return None
    scored = vectors.repartition(cores, "vector")
    for i, model in enumerate(fitted.values()):
        scored = _predicted(model, scored, f"p{i}")
    scored = materialize(scored.select("vector", *[f"p{i}" for i in range(len(fitted))]), "predictions")
    few = n["all"] * 8 * (1 + len(fitted)) <= PREDICTION_BYTES
    return rows.select("label", "is_test", key).join(F.broadcast(scored) if few else scored, "vector")


def evaluate_all(fitted: dict, data: DataFrame) -> DataFrame:
    """A row a model: train and test metrics of all of them from one pass. ``data`` carries ``is_test``."""
    rows, out = data.select("features", "label", "is_test"), []
    scored = _by_vector(fitted, rows)
    if scored is None:
        scored = rows
        if any(isinstance(model, FoldedForest) for model in fitted.values()):  # it scores equal rows of a batch once
            scored = scored.repartition("features", F.pmod(F.xxhash64("label"), F.lit(8))).sortWithinPartitions("features")
        for i, model in enumerate(fitted.values()):
            scored = _predicted(model, scored, f"p{i}")
    for i, name in enumerate(fitted):
        metrics = [*_fit_of(~F.col("is_test"), f"p{i}", "train_"), *_fit_of(F.col("is_test"), f"p{i}", "test_")]
        out.append(F.struct(F.lit(name).alias("model_name"), *metrics))
    return scored.agg(F.array(*out).alias("rows")).select(F.inline("rows"))


def evaluate(name: str, model, data: DataFrame) -> DataFrame:
    """One row: train and test metrics."""
    return evaluate_all({name: model}, data)


def train_all(data: DataFrame, names=tuple(MODELS), fitted=None) -> tuple[DataFrame, dict]:
    """Fit the models on the training rows; a model that fails is left out. Returns the leaderboard
    (best test R2 first) and the fitted models."""
    models = {}
    train = spread(data.where("NOT is_test"))
    for name in names:
        try:
            models[name] = fitted[name] if fitted and name in fitted else fit(name, train)
        except Exception as error:  # the others still compete
            print(f"model {name} failed: {error}")
    train.unpersist()
    if not models:
        raise RuntimeError("no model could be trained")
    return evaluate_all(models, data).orderBy(F.col("test_r2").desc(), "model_name"), models


def cross_validate(data: DataFrame, names=tuple(MODELS), params=None) -> DataFrame:
    """Mean and population deviation of R2 over the folds, for any models: model_name, cv_r2_mean, cv_r2_std.

    The training rows get their fold once and are kept; every model is fitted to all folds but one, a few fits side
    by side, and one pass scores each fold by the models that have not seen it. ``params`` are those of ``fit`` by name.
    """
    keep_checkpoints(data.sparkSession)
    rows = with_folds(data.where("NOT is_test")).select("features", "label", "fold")
    vectors = folded(rows, "fold")
    if vectors is not None:
        return _cross_validate_folded(rows, vectors, names, params or {})
    rows = spread(rows)
    folds = sorted(r["fold"] for r in rows.select("fold").distinct().collect())  # at most FOLDS

    def one(task):
        name, fold = task
        return fit(name, rows.where(F.col("fold") != fold), **(params or {}).get(name, {}))

    tasks = [(name, fold) for name in names for fold in folds]
    with ThreadPool(PARALLEL_FITS) as pool:
        fitted = dict(zip(tasks, pool.map(one, tasks), strict=True))
    parts = []
    for fold in folds:
        part = rows.where(F.col("fold") == fold)
        for i, name in enumerate(names):
            part = _predicted(fitted[name, fold], part, f"p{i}")
        parts.append(part.select("label", "fold", *[f"p{i}" for i in range(len(names))]))
    r2 = [_fit_of(F.lit(True), f"p{i}")[0].alias(f"r{i}") for i in range(len(names))]
    each = union_all(*parts).groupBy("fold").agg(*r2)
    scores = [
        F.struct(F.lit(name).alias("model_name"), round_to(F.avg(f"r{i}"), 4).alias("cv_r2_mean"), round_to(F.stddev_pop(f"r{i}"), 4).alias("cv_r2_std"))
        for i, name in enumerate(names)
    ]
    out = materialize(each.agg(F.array(*scores).alias("rows")).select(F.inline("rows")), "cv-scores")
    rows.unpersist()
    return out


def _cross_validate_folded(rows: DataFrame, vectors: DataFrame, names, params: dict) -> DataFrame:
    """``cross_validate`` from rows with equal features and fold put together (``folded``): nothing is scored row by row."""
    folds = sorted(r["fold"] for r in vectors.select("fold").distinct().collect())  # at most FOLDS
    w, label = F.sum("weight").alias("weight"), (F.sum(F.col("weight") * F.col("label")) / F.sum("weight")).alias("label")
    shift = vectors.agg(label).first()["label"]

    def one(fold):
        others = materialize(vectors.where(F.col("fold") != fold).groupBy("features").agg(w, label), "others")
        return {name: fit(name, rows.where(F.col("fold") != fold), others, **params.get(name, {})) for name in names}

    with ThreadPool(PARALLEL_FITS) as pool:
        fitted = dict(zip(folds, pool.map(one, folds), strict=True))
    off, weight = F.col("label") - F.lit(shift), F.col("weight")
    total = F.sum(F.col("within") + weight * off * off) - F.pow(F.sum(weight * off), 2) / F.sum("weight")
    parts = []
    for fold in folds:
        part = vectors.where(F.col("fold") == fold)
        for i, name in enumerate(names):
            part = _predicted(fitted[fold][name], part, f"p{i}")
        parts.append(part.select("fold", "weight", "label", "within", *[f"p{i}" for i in range(len(names))]))
    errors = [F.sum(F.col("within") + weight * F.pow(F.col("label") - F.col(f"p{i}"), 2)) for i in range(len(names))]
    r2 = [round_to(1 - e / F.nullif(total, F.lit(0.0)), 4).alias(f"r{i}") for i, e in enumerate(errors)]
    each = union_all(*parts).groupBy("fold").agg(*r2)
    scores = [
        F.struct(F.lit(name).alias("model_name"), round_to(F.avg(f"r{i}"), 4).alias("cv_r2_mean"), round_to(F.stddev_pop(f"r{i}"), 4).alias("cv_r2_std"))
        for i, name in enumerate(names)
    ]
    return materialize(each.agg(F.array(*scores).alias("rows")).select(F.inline("rows")), "cv-scores")


def best_model(leaderboard: DataFrame) -> DataFrame:
    row = F.struct(*leaderboard.columns)
    first = F.struct((-F.col("test_r2")).alias("r2"), "model_name")  # the order of the leaderboard
    return leaderboard.where("test_r2 IS NOT NULL").agg(F.min_by(row, first).alias("best")).where("best IS NOT NULL").select("best.*")


# --- linear models from one pass -----------------------------------------------------------------


def moments(df: DataFrame, features, label=TARGET, by=()) -> DataFrame:
    """Row count, means, and sums and sums of products of features and label less their means, per group.

    Everything ridge, lasso and least squares need; p features give (p+1)(p+4)/2 numbers per group. The means are those of
    all rows, from a pass of their own: with large means the products of raw values would swallow the deviations.
    """
    columns = [*features, label]
    means = df.agg(*[F.avg(F.col(c).cast("double")).alias(f"m_{i}") for i, c in enumerate(columns)])
    exprs = ["count(1) AS n", *[f"max(m_{i}) AS m_{i}" for i in range(len(columns))]]
    for i in range(len(columns)):
        exprs.append(f"sum(d_{i}) AS s_{i}")
        exprs += [f"sum(d_{i} * d_{j}) AS p_{i}_{j}" for j in range(i, len(columns))]
    off = cross_one(df, means).select(*by, *[(F.col(c).cast("double") - F.col(f"m_{i}")).alias(f"d_{i}") for i, c in enumerate(columns)], *[f"m_{i}" for i in range(len(columns))])
    return off.groupBy(*by).agg(*[F.expr(e) for e in exprs])


class Moments:
    """The collected moments of one group of rows about ``at``; adding two gives those of both groups."""

    def __init__(self, n, at, sums, products):
        self.n, self.at, self.sums, self.products = n, at, sums, products

    @classmethod
    def of(cls, row, p):
        at = np.array([row[f"m_{i}"] or 0.0 for i in range(p + 1)])
        sums = np.array([row[f"s_{i}"] or 0.0 for i in range(p + 1)])
        products = np.zeros((p + 1, p + 1))
        for i in range(p + 1):
            for j in range(i, p + 1):
                products[i, j] = products[j, i] = row[f"p_{i}_{j}"] or 0.0
        return cls(row["n"], at, sums, products)

    def __add__(self, other):
        return Moments(self.n + other.n, self.at, self.sums + other.sums, self.products + other.products)

    def centred(self):
        return self.products - np.outer(self.sums, self.sums) / self.n

    def solve(self, kind, alpha, rounds=fixed.LASSO_MAX_ITER):
        """Weights and intercept of ordinary, ridge or lasso regression."""
        c = self.centred()
        xx, xy = c[:-1, :-1], c[:-1, -1]
        if kind == "ridge":
            w = np.linalg.solve(xx + alpha * np.eye(len(xy)), xy)
        elif kind == "lasso":
            w = _lasso(xx / self.n, xy / self.n, alpha, rounds)
            if w is None:
                return None
        else:
            w = np.linalg.lstsq(xx, xy, rcond=None)[0]
        means = self.at + self.sums / self.n
        return w, means[-1] - means[:-1] @ w

    def r2(self, w, intercept):
        """R2 of a linear model on the rows behind these moments."""
        full = np.append(w, -1.0)
        shift = intercept + full @ self.at  # the prediction less the label where all columns are at their means
        squares = full @ self.products @ full + 2 * shift * (full @ self.sums) + self.n * shift**2
        return float(1 - squares / self.centred()[-1, -1])


def _lasso(xx, xy, alpha, steps):
    """Weights that meet the conditions of the optimum, or None if none were found.

    Followed from the penalty at which all weights are zero down to ``alpha``: between two penalties at which a weight
    becomes or ceases to be zero, all move along a line, so that near-equal columns cost a few more steps and no patience.
    """
    size = np.sqrt(np.maximum(np.diag(xx), 0))
    used = np.flatnonzero(size > 0)
    out = np.zeros(len(xy))
    c, b, t = xx[np.ix_(used, used)] / np.outer(size[used], size[used]), xy[used] / size[used], 1 / size[used]
    w, on, left, penalty = np.zeros(len(used)), [], None, float(np.max(np.abs(b) / t, initial=0))
    close = 1e-9 * max(1.0, float(np.max(np.abs(b), initial=0)))
    for _ in range(steps):
        slope = b - c @ w
        if penalty <= alpha:
            off = np.where(w != 0, np.abs(slope - alpha * t * np.sign(w)), np.maximum(np.abs(slope) - alpha * t, 0))
            if np.max(off, initial=0) > close:
                return None
            out[used] = w / size[used]
            return out
        if not on:
            on = [int(np.argmax(np.abs(slope) / t))]
        move = np.zeros(len(w))
        signs = np.where(w[on] != 0, np.sign(w[on]), np.sign(slope[on]))
        move[on] = np.linalg.lstsq(c[np.ix_(on, on)], t[on] * signs, rcond=1e-13)[0]
        turn = c @ move  # the slopes fall by this for each unit of the penalty
        best, event = penalty - alpha, None
        for k in range(len(w)):
            if k in on:
                steps_to = [(-w[k] / move[k], None)] if move[k] * w[k] < 0 else []
            else:
                steps_to = [((penalty * t[k] - sign * slope[k]) / (t[k] - sign * turn[k]), sign) for sign in (1, -1) if t[k] - sign * turn[k] > 1e-12 and (k, sign) != left]
            for far, _ in steps_to:
                if -1e-12 < far < best:
                    best, event = max(far, 0.0), k
        w, penalty, left = w + best * move, penalty - best if event is not None else alpha, None
        if event in on:
            left = (event, int(np.sign(w[event] - best * move[event])))
            w[event] = 0.0
            on.remove(event)
        elif event is not None:
            on.append(event)
    return None


def fold_moments(df: DataFrame, features, label=TARGET) -> tuple:
    """Moments per fold of the training rows, of all training rows, and of the test rows."""
    rows = moments(with_folds(df), features, label, ["is_test", "fold"]).collect()  # 2 * folds rows
    train, test = {}, []
    for row in rows:
        m = Moments.of(row, len(features))
        if row["is_test"]:
            test.append(m)
        else:
            train[row["fold"]] = m

    def add(ms):
        return sum(ms[1:], ms[0]) if ms else None

    return [train[f] for f in sorted(train)], add(list(train.values())), add(test)


def _cv(folds, kind, alpha):
    """R2 of each fold by the model of the others; None if one of these has not settled."""
    scores = []
    for i, held_out in enumerate(folds):
        others = [m for j, m in enumerate(folds) if j != i]
        model = sum(others[1:], others[0]).solve(kind, alpha)
        if model is None:
            return None
        scores.append(held_out.r2(*model))
    return scores


def _rounded(value, digits):
    return None if value is None else round(float(value), digits)


LINEAR_KINDS = {"linear_regression": ("ols", 0.0), "ridge": ("ridge", fixed.RIDGE_ALPHA),
                "lasso": ("lasso", fixed.LASSO_ALPHA)}


def cv_scores(df: DataFrame, features, label=TARGET) -> DataFrame:
    """Mean and population deviation of R2 over the folds, for the linear models: one pass."""
    folds, _, _ = fold_moments(df, features, label)
    rows = []
    for name, (kind, alpha) in LINEAR_KINDS.items():
        scores = _cv(folds, kind, alpha)
        rows.append((name, *(_rounded(scores and f(scores), 4) for f in (np.mean, np.std))))
    return df.sparkSession.createDataFrame(rows, "model_name string, cv_r2_mean double, cv_r2_std double")


def grid_search(df: DataFrame, features, label=TARGET, alphas=fixed.GRID_ALPHAS) -> DataFrame:
    """Cross-validated R2 of ridge and lasso for every alpha, from the moments of one pass; NULL where lasso has not settled."""
    folds, _, _ = fold_moments(df, features, label)
    rows = []
    for kind in ("ridge", "lasso"):
        found = {a: _cv(folds, kind, a) for a in alphas}
        scores = {a: float(np.mean(s)) for a, s in found.items() if s}
        best = max(scores, key=scores.get, default=None)
        rows += [(kind, a, _rounded(scores.get(a), 6), a == best) for a in alphas]
    return df.sparkSession.createDataFrame(rows, "model string, alpha double, cv_r2 double, is_best boolean")


def reg_sweep(df: DataFrame, features, label=TARGET, alphas=fixed.SWEEP_ALPHAS) -> DataFrame:
    """Test R2 of ridge and lasso by alpha, from the moments of one pass; NULL where lasso has not settled."""
    _, train, test = fold_moments(df, features, label)
    found = [(kind, a, train.solve(kind, a)) for kind in ("ridge", "lasso") for a in alphas]
    rows = [(kind, a, _rounded(model and test.r2(*model), 6)) for kind, a, model in found]
    return df.sparkSession.createDataFrame(rows, "model string, alpha double, test_r2 double")


# --- trees ---------------------------------------------------------------------------------------


def tree_grid_search(data: DataFrame, depths=fixed.TREE_GRID_DEPTHS, splits=fixed.TREE_GRID_SPLITS,
                     parallelism=4) -> DataFrame:
    """Cross-validated R2 of decision trees over depth and split size."""
    estimator = DecisionTreeRegressor(**TREES)
    grid = (
        ParamGridBuilder()
        .addGrid(estimator.maxDepth, list(depths))
        .addGrid(estimator.minInstancesPerNode, [max(1, s // 2) for s in splits])
        .build()
    )
    cv = CrossValidator(
        estimator=estimator, estimatorParamMaps=grid, numFolds=fixed.FOLDS, foldCol="fold",
        evaluator=RegressionEvaluator(metricName="r2"), parallelism=parallelism,
    )
    train = with_folds(data.where("NOT is_test")).select("features", "label", "fold")
    vectors = folded(train, "fold")
    if vectors is None:
        train = spread(train)
        scores = cv.fit(train).avgMetrics
        train.unpersist()
    else:
        found = grid_scores(vectors, depths, sorted({max(1, s // 2) for s in splits}), TREES["maxBins"])
        scores = [found[g[estimator.maxDepth], g[estimator.minInstancesPerNode]] for g in grid]
    best = max(range(len(grid)), key=lambda i: scores[i])
    rows = [
        (int(g[estimator.maxDepth]), int(g[estimator.minInstancesPerNode]), round(float(s), 6), i == best)
        for i, (g, s) in enumerate(zip(grid, scores))
    ]
    return data.sparkSession.createDataFrame(
        rows, "max_depth int, min_rows_per_leaf int, cv_r2 double, is_best boolean"
    )


def tuned_tree(grid: DataFrame, train: DataFrame, vectors: DataFrame | None = None):
    """The decision tree of the best depth and split size of a ``tree_grid_search``, fitted to all training rows."""
    best = grid.where("is_best").first()
    return fit("decision_tree", train, vectors, depth=best["max_depth"], min_split=2 * best["min_rows_per_leaf"])


def depth_sweep(data: DataFrame, depths=fixed.SWEEP_DEPTHS) -> DataFrame:
    """Train and test R2 of a decision tree by depth."""
    train = spread(data.where("NOT is_test"))
    vectors = folded(train)
    fitted = {str(d): fit_rows(tree(train, depth=d), train, vectors) for d in depths}
    train.unpersist()
    return evaluate_all(fitted, data).select(F.col("model_name").cast("int").alias("max_depth"), "train_r2", "test_r2")


# --- explanation ---------------------------------------------------------------------------------


def coefficients(spark, model, features) -> DataFrame:
    """Coefficients with their size, largest first (one row per feature)."""
    rows = [(f, float(w), abs(float(w)), bool(w != 0)) for f, w in zip(features, model.coefficients)]
    out = spark.createDataFrame(rows, "feature string, coefficient double, size double, is_used boolean")
    return out.orderBy(F.col("size").desc(), "feature")


def importances(spark, model, features) -> DataFrame:
    values = model.featureImportances.toArray()
    out = spark.createDataFrame(
        [(f, float(v)) for f, v in zip(features, values)], "feature string, importance double"
    )
    return out.orderBy(F.col("importance").desc(), "feature")


def importance_forest(data: DataFrame, features, trees=100) -> DataFrame:
    """Feature importances of a forest of 100 trees of depth 10."""
    vectors = folded(data)
    kept = spread(data) if vectors is None else data
    model = fit_rows(forest(kept, trees=trees, depth=10, min_split=2), kept, vectors)
    if vectors is None:
        kept.unpersist()
    return importances(data.sparkSession, model, features)


def variance_explained(leaderboard: DataFrame) -> DataFrame:
    best = best_model(leaderboard)
    return best.select(
        "model_name",
        round_to(F.col("test_r2") * 100, 2).alias("explained_pct"),
        round_to(100 - F.col("test_r2") * 100, 2).alias("unexplained_pct"),
        round_to(ratio_pct("test_mae", "test_rmse"), 2).alias("mae_to_rmse_pct"),
    )


HISTORY = (
    "training_timestamp timestamp_ntz, model_name string, model_type string, training_records bigint, "
    "test_records bigint, features_used int, test_r2 double, test_mae double, test_rmse double, "
    "cv_r2_mean double, cv_r2_std double, model_path string, is_production boolean, metadata string"
)


def history_row(leaderboard: DataFrame, data: DataFrame, features, at, model_path, cv=None,
                current: DataFrame | None = None) -> DataFrame:
    """History entry for the best model. It goes into production only if it is no worse than the
    model in production (``current``: latest production row, if any)."""
    best = best_model(leaderboard)
    counts = data.agg(
        F.count_if(~F.col("is_test")).alias("training_records"), F.count_if("is_test").alias("test_records")
    )
    floor = data.sparkSession.range(1).select(F.lit(None).cast("double").alias("floor"))
    if current is not None:
        floor = current.agg(F.max("test_r2").alias("floor"))
    scores = data.sparkSession.createDataFrame([], "model_name string, cv_r2_mean double, cv_r2_std double")
    row = best.crossJoin(F.broadcast(counts)).crossJoin(F.broadcast(floor))
    row = row.join(cv if cv is not None else scores, "model_name", "left")
    return row.select(
        F.lit(at).cast("timestamp_ntz").alias("training_timestamp"),
        "model_name",
        F.col("model_name").alias("model_type"),
        "training_records",
        "test_records",
        F.lit(len(features)).alias("features_used"),
        "test_r2",
        "test_mae",
        "test_rmse",
        "cv_r2_mean",
        "cv_r2_std",
        F.lit(model_path).cast("string").alias("model_path"),
        (F.col("floor").isNull() | (F.col("test_r2") >= F.col("floor"))).alias("is_production"),
        F.to_json(F.struct(F.array(*[F.lit(f) for f in features]).alias("selected_features"))).alias("metadata"),
    )


def model_status(latest: DataFrame) -> DataFrame:
    """Status of the model in production; placeholders when there is none. At most one row comes in."""
    one = latest.agg(
        F.max("model_name").alias("model_name"),
        F.max("training_timestamp").alias("trained"),
        F.max("test_r2").alias("test_r2"),
        F.max("test_mae").alias("test_mae"),
    )
    return one.select(
        F.col("model_name").isNotNull().alias("model_loaded"),
        F.coalesce("model_name", F.lit("none")).alias("model_name"),
        F.when(F.col("model_name").isNotNull(), "1.0").otherwise("0.0").alias("model_version"),
        F.coalesce(F.date_format("trained", "yyyy-MM-dd HH:mm:ss"), F.lit("never")).alias("last_training_date"),
        F.coalesce("test_r2", F.lit(0.0)).alias("test_r2"),
        F.coalesce("test_mae", F.lit(0.0)).alias("test_mae"),
    )
