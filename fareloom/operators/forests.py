"""Random forests over rows with equal features: bootstrapped row by row, one tree a task.

Category features make few distinct vectors, however many rows there are. A row is drawn for each tree in a pass over all
rows; what a tree needs of a vector is how often its rows were drawn and the sum of their labels. A tree is then grown in one
task from as many rows as there are vectors (``models.FOLDED_ROWS`` at most), level by level, with Spark's binned splits.
Functions that run in Python workers travel by value.
"""

import sys

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.session import materialize

cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rows that are drawn for all trees at once.
DRAW_ROWS = 1 << 12
#: Binned vectors with 1/``HOT_SHARE`` of the rows or more are spread over so many parts.
HOT_SHARE, SALTS = 1000, 64
#: Nodes whose statistics are held at once while a tree grows.
NODES_AT_ONCE = 1 << 14
#: Rows that are sent to a task of a grid together.
BLOCK_ROWS = 1 << 12
NODES = "tree int, feature binary, bin binary, left binary, value binary, importance array<double>"


def thresholds(values: np.ndarray, weights: np.ndarray, bins: int) -> list[float]:
    """Candidate splits between sorted distinct values: all if they are few, else about equal weights apart."""
    if len(values) <= bins:
        return ((values[:-1] + values[1:]) / 2).tolist()
    stride, upto, out = weights.sum() / bins, np.cumsum(weights), []
    target = stride
    for i in range(1, len(values)):
        if abs(upto[i - 1] - target) < abs(upto[i] - target):
            out.append(float((values[i - 1] + values[i]) / 2))
            target += stride
    return out


def _splits(folded: DataFrame, bins: int) -> list[np.ndarray]:
    """Candidate splits of each feature, from the rows of all its values; bins - 1 numbers a feature come back."""
    values = folded.select("weight", F.posexplode(vector_to_array("features")).alias("feature", "value"))
    values = values.groupBy("feature", "value").agg(F.sum("weight").alias("weight"))

    def of_feature(rows):
        rows = rows.sort_values("value")
        found = thresholds(rows["value"].to_numpy(), rows["weight"].to_numpy(), bins)
        return pd.DataFrame({"feature": rows["feature"].iloc[:1], "splits": [found]})

    rows = values.groupBy("feature").applyInPandas(of_feature, "feature int, splits array<double>").collect()
    return [np.array(r["splits"], float) for r in sorted(rows, key=lambda r: r["feature"])]


def place(x: np.ndarray, splits: list[np.ndarray]) -> np.ndarray:
    """Bins of feature values: a value equal to a split lies to its left."""
    return np.stack([np.searchsorted(s, x[:, i], "left").astype(np.uint8) for i, s in enumerate(splits)], axis=1)


def draw(bins: np.ndarray, labels: np.ndarray, trees: int, rng) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A bootstrap of rows sorted by bins: distinct bins, and for each tree how many rows were drawn and their sum."""
    starts = np.flatnonzero(np.r_[True, np.any(bins[1:] != bins[:-1], axis=1)])
    drawn = rng.poisson(1.0, (len(bins), trees)).astype(np.float64)
    return bins[starts], np.add.reduceat(drawn, starts), np.add.reduceat(drawn * labels[:, None], starts)


def grow(bins: np.ndarray, n: np.ndarray, s: np.ndarray, depth: int, least: int, width: int):
    """A regression tree over binned rows (n draws with label sum s): feature, bin, left child, value, importance.

    A row goes right if its bin is above that of the node; children lie next to each other. A leaf is its own child.
    """
    features = bins.shape[1]
    total_n, total_s = np.array([n.sum()]), np.array([s.sum()])
    columns = [[np.zeros(1, np.uint8)], [np.full(1, 255, np.uint8)], [np.zeros(1, np.int32)], [total_s / np.maximum(total_n, 1)]]
    importance, node, first = np.zeros(features), np.zeros(len(n), np.int64), 0
    for _ in range(depth):
        k = len(total_n)
        best, feature, cut, left_n, left_s = np.zeros(k), np.zeros(k, np.uint8), np.full(k, 255, np.uint8), np.zeros(k), np.zeros(k)
        base = np.divide(total_s**2, total_n, out=np.zeros(k), where=total_n > 0)
        if k > NODES_AT_ONCE:  # rows of a node lie together
            order = np.argsort(node, kind="stable")
            bins, n, s, node = bins[order], n[order], s[order], node[order]
        for low in range(0, k, NODES_AT_ONCE):
            high = min(k, low + NODES_AT_ONCE)
            rows = slice(*np.searchsorted(node, [low, high])) if k > NODES_AT_ONCE else slice(None)
            shape, here, nodes = (high - low, width), slice(low, high), np.arange(high - low)
            for f in range(features):
                at = (node[rows] - low) * width + bins[rows, f]
                ln = np.cumsum(np.bincount(at, n[rows], shape[0] * width).reshape(shape), axis=1)[:, :-1]
                ls = np.cumsum(np.bincount(at, s[rows], shape[0] * width).reshape(shape), axis=1)[:, :-1]
                rn, rs = total_n[here, None] - ln, total_s[here, None] - ls
                gain = np.where((ln >= least) & (rn >= least), ls**2 / np.maximum(ln, 1) + rs**2 / np.maximum(rn, 1) - base[here, None], 0.0)
                b = np.argmax(gain, axis=1)
                g = gain[nodes, b]
                better = np.flatnonzero(g > best[here] + 1e-12 * base[here])
                best[low + better], feature[low + better], cut[low + better] = g[better], f, b[better]
                left_n[low + better], left_s[low + better] = ln[better, b[better]], ls[better, b[better]]
        split = np.flatnonzero(best > 0)
        if not len(split):
            break
        np.add.at(importance, feature[split], best[split])
        child = first + k + 2 * np.arange(len(split))
        columns[0][-1], columns[1][-1] = np.where(best > 0, feature, 0).astype(np.uint8), cut
        columns[2][-1] = columns[2][-1].copy()
        columns[2][-1][split] = child
        rank = np.full(k, -1)
        rank[split] = 2 * np.arange(len(split))
        kept = rank[node] >= 0
        bins, n, s, node = bins[kept], n[kept], s[kept], node[kept]
        node = rank[node] + (bins[np.arange(len(node)), feature[node]] > cut[node])
        left_n, left_s, all_n, all_s = left_n[split], left_s[split], total_n[split], total_s[split]
        total_n = np.stack([left_n, all_n - left_n], axis=1).ravel()
        total_s = np.stack([left_s, all_s - left_s], axis=1).ravel()
        first += k
        m = len(total_n)
        columns[0].append(np.zeros(m, np.uint8))
        columns[1].append(np.full(m, 255, np.uint8))
        columns[2].append(np.arange(first, first + m, dtype=np.int32))
        columns[3].append(total_s / total_n)
    return (*(np.concatenate(c) for c in columns), importance)


def walk(bins: np.ndarray, tree, depth: int) -> np.ndarray:
    """The values of the leaves that binned rows come to."""
    feature, cut, left, value = tree
    node, row = np.zeros(len(bins), np.int64), np.arange(len(bins))
    for _ in range(depth):
        node = left[node] + (bins[row, feature[node]] > cut[node])
    return value[node]


def fit_forest(train: DataFrame, folded: DataFrame, trees: int, depth: int, least: int, bins: int, seed: int) -> "FoldedForest":
    """A forest over the rows of ``train`` (features, label); ``folded`` holds a row a distinct vector with its weight."""
    splits = _splits(folded, bins)
    features, width = len(splits), max((len(s) for s in splits), default=0) + 1
    shift = folded.agg((F.sum(F.col("weight") * F.col("label")) / F.sum("weight")).alias("m")).first()["m"]  # keeps the sums small
    cores = train.sparkSession.sparkContext.defaultParallelism

    def binned(batches):
        for rows in batches:
            x = np.stack(rows["x"].to_numpy()) if len(rows) else np.empty((0, features))
            keys = place(x, splits) if features else np.zeros((len(rows), 0), np.uint8)
            yield pd.DataFrame({"bins": [k.tobytes() for k in keys], "label": rows["label"]})

    def drawn(batches):
        from pyspark import TaskContext

        part, number = TaskContext.get().partitionId(), 0
        for rows in batches:
            for start in range(0, len(rows), DRAW_ROWS):
                some = rows.iloc[start : start + DRAW_ROWS]
                keys = np.frombuffer(b"".join(some["bins"]), np.uint8).reshape(len(some), features)
                keys, n, s = draw(keys, some["label"].to_numpy() - shift, trees, np.random.default_rng([seed, part, number]))
                number += 1
                held = [np.flatnonzero(n[:, t]) for t in range(trees)]
                yield pd.DataFrame({
                    "tree": np.arange(trees, dtype=np.int32), "bins": [keys[h].tobytes() for h in held],
                    "n": [n[h, t].tobytes() for t, h in enumerate(held)], "s": [s[h, t].tobytes() for t, h in enumerate(held)],
                })

    def grown(rows):
        keys = np.frombuffer(b"".join(rows["bins"]), np.uint8).reshape(-1, features)
        n, s = (np.frombuffer(b"".join(rows[c]), np.float64) for c in ("n", "s"))
        feature, cut, left, value, importance = grow(keys, n, s, depth, least, width)
        return pd.DataFrame({
            "tree": rows["tree"].iloc[:1], "feature": [feature.tobytes()], "bin": [cut.tobytes()], "left": [left.tobytes()],
            "value": [(value + shift).tobytes()], "importance": [importance.tolist()],
        })

    def by_bins(df, value):
        return df.select(vector_to_array("features").alias("x"), F.col(value).alias("label")).mapInPandas(binned, "bins binary, label double")

    counts = by_bins(folded, "weight").groupBy("bins").agg(F.sum("label").alias("n"))
    total = folded.agg(F.sum("weight").alias("n")).first()["n"] or 0
    hot = [r["bins"] for r in counts.where(F.col("n") >= max(DRAW_ROWS, total / HOT_SHARE)).collect()]  # at most HOT_SHARE
    rows = by_bins(train, "label")
    # rows of a vector lie together, and those of a common one in several parts: what is drawn adds up
    spread = F.when(F.col("bins").isin([bytes(b) for b in hot]), F.pmod(F.xxhash64("label"), F.lit(SALTS))).otherwise(0) if hot else F.lit(0)
    rows = rows.repartition(max(cores, train.rdd.getNumPartitions()), "bins", spread).sortWithinPartitions("bins", "label")
    draws = materialize(rows.mapInPandas(drawn, "tree int, bins binary, n binary, s binary"), "draws")
    model = draws.repartition(trees, "tree").groupBy("tree").applyInPandas(grown, NODES)
    return FoldedForest(materialize(model, "forest"), splits, depth)


def grid_scores(vectors: DataFrame, depths, leasts, bins: int) -> dict:
    """(depth, rows per leaf) -> mean R2 over the folds, from folded rows (features, fold, weight, label, within).

    A shallow tree is the top of a deep one, so each task grows the deepest for one held-out fold and one leaf size, and scores
    the fold at every depth. The squares within folded rows count as errors of any model, so R2 is that of the single rows.
    A task takes its rows as they stream in, 17 bytes and one a feature each; rows of equal bins and fold come as one.
    """
    splits = _splits(vectors, bins)
    features, width = len(splits), max((len(s) for s in splits), default=0) + 1
    deepest = max(depths)
    shift = vectors.agg((F.sum(F.col("weight") * F.col("label")) / F.sum("weight")).alias("m")).first()["m"]

    def binned(batches):
        for rows in batches:
            if len(rows):
                keys = place(np.stack(rows["x"].to_numpy()), splits)
                yield pd.DataFrame({"bins": [k.tobytes() for k in keys], **{c: rows[c] for c in ("fold", "weight", "label", "within")}})

    off = F.col("label") - F.lit(shift)
    w, s, squares = F.sum("weight"), F.sum(F.col("weight") * off), F.sum(F.col("within") + F.col("weight") * off * off)
    merged = vectors.select(vector_to_array("features").alias("x"), F.col("fold").cast("int").alias("fold"), "weight", "label", "within")
    merged = merged.mapInPandas(binned, "bins binary, fold int, weight double, label double, within double").groupBy("bins", "fold")
    merged = materialize(merged.agg(w.alias("weight"), (s / w).alias("label"), (squares - s * s / w).alias("within")), "binned")
    within = {r["fold"]: r["n"] for r in merged.groupBy("fold").agg(F.sum("within").alias("n")).collect()}  # at most the folds
    tasks = [(fold, least) for fold in sorted(within) for least in leasts]

    def packed(batches):
        for rows in batches:
            for start in range(0, len(rows), BLOCK_ROWS):
                some = rows.iloc[start : start + BLOCK_ROWS]
                yield pd.DataFrame({
                    "bins": [b"".join(some["bins"])], "fold": [some["fold"].to_numpy(np.uint8).tobytes()],
                    "weight": [some["weight"].to_numpy(np.float64).tobytes()], "label": [some["label"].to_numpy(np.float64).tobytes()],
                })

    def scored(batches):
        held: dict = {}  # a task a partition, as a rule
        for rows in batches:
            for r in rows.itertuples(index=False):
                held.setdefault(r.task, []).append((r.bins, r.fold, r.weight, r.label))
        for task in sorted(held):
            (out, least), parts = tasks[task], held.pop(task)
            keys = np.frombuffer(b"".join(p[0] for p in parts), np.uint8).reshape(-1, features)
            fold, weight, label = (np.frombuffer(b"".join(p[i] for p in parts), kind) for i, kind in ((1, np.uint8), (2, np.float64), (3, np.float64)))
            parts, rest = None, fold != out
            *tree, _ = grow(keys[rest], weight[rest], (weight * label)[rest], deepest, least, width)
            rest = ~rest
            keys, weight, label = keys[rest], weight[rest], label[rest]
            total = within[out] + (weight * (label - np.average(label, weights=weight)) ** 2).sum()
            errors = [within[out] + (weight * (label - walk(keys, tree, d)) ** 2).sum() for d in depths]
            yield pd.DataFrame({"depth": list(depths), "least": least, "r2": [1 - e / total for e in errors]})

    blocks = merged.mapInPandas(packed, "bins binary, fold binary, weight binary, label binary")
    dealt = blocks.withColumn("task", F.explode(F.sequence(F.lit(0), F.lit(len(tasks) - 1))))
    found = dealt.repartitionByRange(len(tasks), "task").mapInPandas(scored, "depth int, least int, r2 double").collect()
    return {(d, m): float(np.mean([r["r2"] for r in found if (r["depth"], r["least"]) == (d, m)])) for d in depths for m in leasts}


class FoldedForest:
    """A fitted forest: used, compared and saved like a model of Spark ML."""

    predictionCol = "prediction"

    def __init__(self, nodes: DataFrame, splits: list[np.ndarray], depth: int, output: str = "prediction"):
        self.nodes, self.splits, self.depth, self.output = nodes, splits, depth, output
        self._shared = None

    def copy(self, extra=None) -> "FoldedForest":
        other = FoldedForest(self.nodes, self.splits, self.depth, (extra or {}).get(self.predictionCol, self.output))
        other._shared = self._trees()
        return other

    @property
    def featureImportances(self):
        """Mean over the trees of each one's shares, as Spark ML has it."""
        rows = np.array([r["importance"] for r in self.nodes.select("tree", "importance").orderBy("tree").collect()])
        sums = rows.sum(axis=1, keepdims=True)
        mean = np.divide(rows, sums, out=np.zeros_like(rows), where=sums > 0).sum(axis=0)
        return Vectors.dense(mean / (mean.sum() or 1.0))

    def _trees(self):
        """The nodes, 14 bytes each, sent to every executor once."""
        if self._shared is None:
            kinds = {"feature": np.uint8, "bin": np.uint8, "left": np.int32, "value": np.float64}
            rows = self.nodes.drop("importance").orderBy("tree").collect()
            trees = [tuple(np.frombuffer(r[c], kind) for c, kind in kinds.items()) for r in rows]
            self._shared = self.nodes.sparkSession.sparkContext.broadcast(trees)
        return self._shared

    def transform(self, df: DataFrame) -> DataFrame:
        shared, splits, depth = self._trees(), self.splits, self.depth

        @F.pandas_udf("double")
        def predict(x: pd.Series) -> pd.Series:
            bins = place(np.stack(x.to_numpy()), splits) if len(x) else np.empty((0, len(splits)), np.uint8)
            bins, back = np.unique(bins, axis=0, return_inverse=True)
            out = np.zeros(len(bins))
            for tree in shared.value:
                out += walk(bins, tree, depth)
            return pd.Series((out / len(shared.value))[back.ravel()])

        return df.withColumn(self.output, predict(vector_to_array("features")))

    def write(self) -> "FoldedForest":
        return self

    def overwrite(self) -> "FoldedForest":
        return self

    def save(self, path: str) -> None:
        spark = self.nodes.sparkSession
        self.nodes.write.mode("overwrite").parquet(f"{path}/nodes")
        about = spark.createDataFrame([(self.depth, [s.tolist() for s in self.splits])], "depth int, splits array<array<double>>")
        about.coalesce(1).write.mode("overwrite").parquet(f"{path}/about")

    @classmethod
    def load(cls, path: str) -> "FoldedForest":
        from pyspark.sql import SparkSession

        spark = SparkSession.getActiveSession()
        about = spark.read.parquet(f"{path}/about").first()
        return cls(spark.read.parquet(f"{path}/nodes"), [np.array(s, float) for s in about["splits"]], about["depth"])
