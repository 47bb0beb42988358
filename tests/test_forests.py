"""Trees and forests from folded rows against those of Spark ML from single rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.operators import forests
from fareloom.operators import models as md
from fareloom.session import new_path


@pytest.fixture(scope="module")
def rows(spark):
    """1,500 rows of 96 distinct feature vectors."""
    rng = np.random.default_rng(8)
    x = np.stack([rng.integers(0, k, 1500) for k in (8, 4, 3)], axis=1).astype(float)
    y = 1000 + 40 * x[:, 0] - 25 * (x[:, 1] == 2) * x[:, 2] + rng.normal(size=1500) * 20
    data = [(str(i), *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    table = spark.createDataFrame(data, "id string, a double, b double, c double, total_fare_bdt double")
    return md.assemble(md.train_test_split(table), ["a", "b", "c"]).persist()


@pytest.fixture
def fold(monkeypatch):
    monkeypatch.setattr(md, "FOLD_ROWS", 1)


def test_folded_rows_hold_all_rows(rows, fold):
    got = md.folded(rows).agg(F.count("weight"), F.sum("weight"), F.sum(F.expr("within + weight * label * label")), F.sum(F.expr("weight * label"))).first()
    want = rows.agg(F.count("label"), F.sum(F.expr("label * label")), F.sum("label")).first()
    assert got[0] == 96 and got[1] == want[0] and got[2] == pytest.approx(want[1]) and got[3] == pytest.approx(want[2])


def test_a_tree_is_that_of_the_single_rows(rows, monkeypatch):
    want = md.fit("decision_tree", rows, depth=6, min_split=10)
    monkeypatch.setattr(md, "FOLD_ROWS", 1)
    got = md.fit("decision_tree", rows, depth=6, min_split=10)
    assert got.numNodes == want.numNodes
    both = want.transform(rows).withColumnRenamed("prediction", "want")
    assert got.transform(both).where("abs(prediction - want) > 1e-6").isEmpty()


def test_boosting_sees_folded_rows(rows, fold, monkeypatch):
    seen, fit = [], md.GBTRegressor.fit
    monkeypatch.setattr(md.GBTRegressor, "fit", lambda self, data: (seen.append(data.count()), fit(self, data))[1])
    model = md.fit("gradient_boosting", rows, trees=20, depth=3)
    assert seen == [96] and md.reg_metrics(model.transform(rows)).first()["r2"] > 0.9


def test_grid_and_sweep_score_as_without_folding(rows, monkeypatch):
    few = dict(depths=(2, 4, 30), splits=(2, 10))
    grid, sweep = md.tree_grid_search(rows, **few).collect(), md.depth_sweep(rows, (1, 3)).collect()
    monkeypatch.setattr(md, "FOLD_ROWS", 1)
    monkeypatch.setattr(md.CrossValidator, "fit", lambda *_: 1 / 0)  # one tree a fold and leaf size instead
    folded = md.tree_grid_search(rows, **few).collect()
    for a, b in zip(grid, folded, strict=True):
        assert a[:2] == b[:2] and a["cv_r2"] == pytest.approx(b["cv_r2"], abs=2e-6)
    for a, b in zip(sweep, md.depth_sweep(rows, (1, 3)).collect(), strict=True):
        assert a["max_depth"] == b["max_depth"] and a["test_r2"] == pytest.approx(b["test_r2"], abs=1e-4)


def test_a_folded_forest_is_as_good_and_can_be_saved(spark, rows, monkeypatch):
    train = rows.where("NOT is_test")
    small = dict(trees=30, depth=6)
    want = md.fit("random_forest", train, **small)
    monkeypatch.setattr(md, "FOLD_ROWS", 1)
    monkeypatch.setattr(md.RandomForestRegressor, "fit", lambda *_: 1 / 0)  # statistics of every node a partition
    got = md.fit("random_forest", train, **small)
    a, b = (md.evaluate("random_forest", m, rows).first() for m in (want, got))
    assert a["test_r2"] == pytest.approx(b["test_r2"], abs=0.01) and a["train_rmse"] == pytest.approx(b["train_rmse"], rel=0.02)
    assert np.allclose(want.featureImportances.toArray(), got.featureImportances.toArray(), atol=0.02)
    path = new_path(spark, "forest")
    got.write().overwrite().save(path)
    once, again = (sorted(r["prediction"] for r in m.transform(rows).collect()) for m in (got, forests.FoldedForest.load(path)))
    assert once == again
    assert md.importance_forest(rows, ["a", "b", "c"], trees=5).first()["feature"] == "a"


def test_rows_are_drawn_one_by_one():
    """The draws of a vector of 400 rows are Poisson with that mean: single rows, not the vector, are drawn."""
    bins = np.repeat(np.array([[0, 1], [2, 0]], np.uint8), 400, axis=0)
    keys, n, s = forests.draw(bins, np.ones(800), 500, np.random.default_rng(1))
    assert keys.tolist() == [[0, 1], [2, 0]] and np.array_equal(n, s)
    assert n.mean() == pytest.approx(400, rel=0.01) and n.var() == pytest.approx(400, rel=0.15)


def test_many_nodes_at_once_and_few_give_one_tree(monkeypatch):
    rng = np.random.default_rng(5)
    bins, n = rng.integers(0, 30, (3000, 3)).astype(np.uint8), rng.integers(1, 4, 3000).astype(float)
    s = n * rng.normal(size=3000)
    one = forests.grow(bins, n, s, 12, 2, 32)
    monkeypatch.setattr(forests, "NODES_AT_ONCE", 7)
    for a, b in zip(one, forests.grow(bins, n, s, 12, 2, 32), strict=True):
        assert np.allclose(a, b)
    inside = forests.walk(bins, one[:4], 12)
    assert np.average(inside, weights=n) == pytest.approx(np.average(s / n, weights=n))


def test_splits_are_all_or_about_equal_weights_apart():
    assert forests.thresholds(np.array([1.0, 2.0, 4.0]), np.ones(3), 32) == [1.5, 3.0]
    got = forests.thresholds(np.arange(1000.0), np.ones(1000), 4)
    assert np.allclose(got, [249.5, 499.5, 749.5], atol=1.0)


def test_vectors_are_scored_once_with_the_metrics_of_all_rows(rows, monkeypatch):
    fitted = {"linear_regression": md.fit("linear_regression", rows), "tree": md.fit("decision_tree", rows, depth=4)}
    want = md.evaluate_all(fitted, rows).collect()
    monkeypatch.setattr(md, "FOLD_ROWS", 1)
    seen, predicted = [], md._predicted
    monkeypatch.setattr(md, "_predicted", lambda model, df, column: (seen.append(df.count()), predicted(model, df, column))[1])
    for most in (md.PREDICTION_BYTES, 0):  # broadcast, shuffled
        monkeypatch.setattr(md, "PREDICTION_BYTES", most)
        for a, b in zip(want, md.evaluate_all(fitted, rows).collect(), strict=True):
            assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], rel=1e-4)
    assert set(seen) == {96}
    monkeypatch.setattr(md, "FOLDED_ROWS", 95)
    assert md._by_vector(fitted, rows.select("features", "label", "is_test")) is None


def test_folds_are_scored_by_vector_as_row_by_row(rows, monkeypatch):
    names, params = ("linear_regression", "decision_tree"), {"decision_tree": dict(depth=4)}
    want = md.cross_validate(rows, names, params).collect()
    monkeypatch.setattr(md, "FOLD_ROWS", 1)
    monkeypatch.setattr(md, "spread", lambda df, spread=md.spread: spread(df) if "weight" in df.columns else 1 / 0)  # single rows are not kept
    got = md.cross_validate(rows, names, params).collect()
    for a, b in zip(want, got, strict=True):
        assert a[0] == b[0] and a[1:] == pytest.approx(b[1:], abs=2e-4)
    assert md.cross_validate(rows, ("random_forest",), {"random_forest": dict(trees=5, depth=4)}).first()["cv_r2_mean"] > 0.8


def test_a_grid_does_not_keep_single_rows_and_merges_equal_bins(rows, monkeypatch):
    few = dict(depths=(2, 4), splits=(2, 10))
    want = md.tree_grid_search(rows, **few).collect()
    monkeypatch.setattr(md, "FOLD_ROWS", 1)
    monkeypatch.setattr(md, "spread", lambda *_: 1 / 0)
    monkeypatch.setattr(forests, "BLOCK_ROWS", 7)
    got = md.tree_grid_search(rows, **few).collect()
    for a, b in zip(want, got, strict=True):
        assert a[:2] == b[:2] and a["cv_r2"] == pytest.approx(b["cv_r2"], abs=2e-6)


def test_a_tree_is_tuned_by_its_grid(rows):
    grid = md.tree_grid_search(rows, depths=(1, 4), splits=(2, 20))
    best = grid.where("is_best").first()
    train = rows.where("NOT is_test")
    model = md.tuned_tree(grid, train)
    assert (model.getMaxDepth(), model.getMinInstancesPerNode()) == (best["max_depth"], best["min_rows_per_leaf"]) and best["max_depth"] == 4


def test_common_vectors_are_drawn_in_parts(rows, monkeypatch):
    monkeypatch.setattr(md, "FOLD_ROWS", 1)
    monkeypatch.setattr(forests, "DRAW_ROWS", 20)  # most of the 96 vectors have fewer rows
    model = md.fit("random_forest", rows, trees=20, depth=6)
    assert md.reg_metrics(model.transform(rows)).first()["r2"] > 0.85
