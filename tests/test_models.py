"""Features and models against closed forms."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from fareloom.operators import features as ft
from fareloom.operators import models as md
from fareloom.operators import incremental, score
from fareloom.plans import load as load_plan
from fareloom.plans import training
from fareloom.session import new_path
from fareloom.sources.ledger import Ledger

N = 600


@pytest.fixture(scope="module")
def numbers(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=(N, 3)) * [1, 2, 0.5]
    y = 3 * x[:, 0] - 2 * x[:, 1] + rng.normal(size=N) + 50
    rows = [(str(i), *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y))]
    return x, y, spark.createDataFrame(rows, "id string, a double, b double, c double, total_fare_bdt double")


def closed_ridge(x, y, alpha):
    xc, yc = x - x.mean(0), y - y.mean()
    return np.linalg.solve(xc.T @ xc + alpha * np.eye(x.shape[1]), xc.T @ yc)


def closed_lasso(x, y, alpha):
    xc, yc, w = x - x.mean(0), y - y.mean(), np.zeros(x.shape[1])
    for _ in range(5000):
        for j in range(len(w)):
            rest = xc[:, j] @ (yc - xc @ w + xc[:, j] * w[j]) / len(y)
            w[j] = np.sign(rest) * max(abs(rest) - alpha, 0) / (xc[:, j] @ xc[:, j] / len(y))
    return w


def test_linear_models(numbers):
    x, y, df = numbers
    data = md.assemble(df, ["a", "b", "c"])
    ols = md.linear(data).fit(data)
    assert np.allclose(ols.coefficients.toArray(), closed_ridge(x, y, 0), atol=1e-6)
    ridge = md.ridge(data, 100.0).fit(data)
    assert np.allclose(ridge.coefficients.toArray(), closed_ridge(x, y, 100.0), atol=1e-4)
    lasso = md.lasso(data, 0.5).fit(data)
    assert np.allclose(lasso.coefficients.toArray(), closed_lasso(x, y, 0.5), atol=1e-3)


def test_moments_give_the_same_models(numbers):
    x, y, df = numbers
    m = md.Moments.of(md.moments(df, ["a", "b", "c"]).first(), 3)
    for kind, alpha, want in (("ols", 0, closed_ridge(x, y, 0)), ("ridge", 100.0, closed_ridge(x, y, 100.0)), ("lasso", 0.5, closed_lasso(x, y, 0.5))):
        w, b = m.solve(kind, alpha)
        assert np.allclose(w, want, atol=1e-5)
        assert m.r2(w, b) == pytest.approx(1 - ((y - x @ w - b) ** 2).sum() / ((y - y.mean()) ** 2).sum())


def test_cross_validation_equals_refits(numbers):
    x, y, df = numbers
    table = md.train_test_split(df)
    got = {r["model_name"]: r for r in md.cv_scores(table, ["a", "b", "c"]).collect()}
    rows = md.with_folds(table.where("NOT is_test")).collect()
    fold = np.array([r["fold"] for r in rows])
    xs, ys = np.array([[r["a"], r["b"], r["c"]] for r in rows]), np.array([r["total_fare_bdt"] for r in rows])
    scores = []
    for f in range(5):
        tr, te = fold != f, fold == f
        w = closed_ridge(xs[tr], ys[tr], 0)
        b = ys[tr].mean() - xs[tr].mean(0) @ w
        scores.append(1 - ((ys[te] - xs[te] @ w - b) ** 2).sum() / ((ys[te] - ys[te].mean()) ** 2).sum())
    assert got["linear_regression"]["cv_r2_mean"] == pytest.approx(np.mean(scores), abs=1e-4)
    assert got["linear_regression"]["cv_r2_std"] == pytest.approx(np.std(scores), abs=1e-4)
    assert md.grid_search(table, ["a", "b", "c"]).where("is_best").count() == 2
    assert md.reg_sweep(table, ["a", "b", "c"]).count() == 16


def test_moments_keep_their_digits_at_large_means(spark, numbers):
    """Columns about 10^6 and more: models and scores are those of refits on the rows."""
    x, y, df = numbers
    far = df.selectExpr("id", "a + 1e6 AS a", "b - 3e7 AS b", "c + 2e6 AS c", "total_fare_bdt + 5e6 AS total_fare_bdt")
    table, names = md.train_test_split(far), ["a", "b", "c"]
    plain, moved = ({r["model_name"]: (r["cv_r2_mean"], r["cv_r2_std"]) for r in md.cv_scores(md.train_test_split(t), names).collect()} for t in (df, far))
    assert plain == moved
    m = md.Moments.of(md.moments(table, names).first(), 3)
    for kind, alpha, want in (("ols", 0, closed_ridge(x, y, 0)), ("ridge", 100.0, closed_ridge(x, y, 100.0)), ("lasso", 0.5, closed_lasso(x, y, 0.5))):
        w, b = m.solve(kind, alpha)
        assert np.allclose(w, want, atol=1e-6)
        assert m.r2(w, b) == pytest.approx(1 - ((y - y.mean() - (x - x.mean(0)) @ w) ** 2).sum() / ((y - y.mean()) ** 2).sum(), abs=1e-9)


def test_lasso_settles_on_near_equal_columns_or_gives_no_score(spark, monkeypatch):
    rng = np.random.default_rng(4)
    base = rng.normal(size=500)
    x = np.stack([base, base + 1e-4 * rng.normal(size=500), np.log(np.abs(base) + 2), rng.normal(size=500)], axis=1)
    y = 2 * x[:, 0] + x[:, 3] + 0.1 * rng.normal(size=500)
    xc, yc = x - x.mean(0), y - y.mean()
    for alpha in (1e-6, 0.001, 0.01, 0.1, 1.0):
        w = md._lasso(xc.T @ xc / 500, xc.T @ yc / 500, alpha, 10_000)
        slope = xc.T @ (yc - xc @ w) / 500
        assert np.all(np.abs(slope) <= alpha + 1e-7) and np.allclose(slope[w != 0], alpha * np.sign(w[w != 0]), atol=1e-7)
    rows = [(str(i), *map(float, r), float(v)) for i, (r, v) in enumerate(zip(x, y, strict=True))]
    table = md.train_test_split(spark.createDataFrame(rows, "id string, a double, b double, c double, d double, total_fare_bdt double"))
    assert md.grid_search(table, list("abcd")).where("cv_r2 IS NULL").isEmpty()
    monkeypatch.setattr(md, "_lasso", lambda *_: None)
    grid = md.grid_search(table, list("abcd")).collect()
    assert {r["cv_r2"] is None for r in grid if r["model"] == "lasso"} == {True} and not any(r["is_best"] for r in grid if r["model"] == "lasso")


def test_cross_validation_of_all_kinds(numbers):
    """The linear models score as from moments; trees as when fitted fold by fold."""
    _, _, df = numbers
    table = md.train_test_split(df)
    data = md.assemble(table, ["a", "b", "c"])
    small = {"random_forest": dict(trees=3, depth=4), "gradient_boosting": dict(trees=3, depth=2)}
    got = {r["model_name"]: r for r in md.cross_validate(data, ("linear_regression", "random_forest", "gradient_boosting"), small).collect()}
    assert len(got) == 3 and all(r["cv_r2_std"] >= 0 for r in got.values())
    linear = {r["model_name"]: r for r in md.cv_scores(table, ["a", "b", "c"]).collect()}["linear_regression"]
    assert got["linear_regression"]["cv_r2_mean"] == pytest.approx(linear["cv_r2_mean"], abs=1e-3)
    rows = md.with_folds(data.where("NOT is_test"))
    scores = []
    for f in range(5):
        model = md.fit("random_forest", md.spread(rows.where(f"fold <> {f}").select("features", "label")), **small["random_forest"])
        scores.append(md.reg_metrics(model.transform(rows.where(f"fold = {f}"))).first()["r2"])
    assert got["random_forest"]["cv_r2_mean"] == pytest.approx(np.mean(scores), abs=0.05)


def test_a_tree_that_wins_has_its_cross_validation_in_the_history(spark, monkeypatch):
    monkeypatch.setitem(md.MODELS, "random_forest", lambda train, **_: md.forest(train, trees=2, depth=3))
    row = training.train_run(bookings(spark, 300), "2025-01-01 00:00:00", None, ("random_forest",), trees=2)[0].first()
    assert row["model_name"] == "random_forest" and row["cv_r2_mean"] is not None and row["cv_r2_std"] >= 0


def test_one_pass_scores_as_one_model_at_a_time(numbers):
    _, _, df = numbers
    data = md.assemble(md.train_test_split(df), ["a", "b", "c"])
    board, fitted = md.train_all(data, ("linear_regression", "ridge", "unknown_kind"))
    for r in board.collect():
        scored = fitted[r["model_name"]].transform(data)
        test = md.reg_metrics(scored.where("is_test")).first()
        assert (r["test_r2"], r["test_mae"], r["test_rmse"]) == (test["r2"], test["mae"], test["rmse"])


def test_split_is_stable(numbers):
    _, _, df = numbers
    a = {r["id"] for r in md.train_test_split(df).where("is_test").collect()}
    b = {r["id"] for r in md.train_test_split(df.repartition(7)).where("is_test").collect()}
    assert a == b and 0.1 < len(a) / N < 0.3


def test_metrics_skip_zero_actuals(spark):
    df = spark.createDataFrame([(0.0, 1.0), (10.0, 8.0), (20.0, 22.0)], "label double, prediction double")
    got = md.reg_metrics(df).first()
    assert got["mape"] == 15.0 and got["mae"] == 1.67 and got["rmse"] == 1.73 and got["r2"] == 0.955


def bookings(spark, n=400):
    return spark.range(n).selectExpr(
        "CAST(id AS string) AS id", "concat('A', id % 3) AS airline", "concat('S', id % 4) AS source_code",
        "concat('D', id % 5) AS destination_code", "1000.0D + 100 * (id % 3) + 10 * (id % 4) AS total_fare_bdt",
        "CASE WHEN id % 10 <> 0 THEN 'Economy' END AS travel_class", "'Regular' AS seasonality",
        "CAST(id % 2 AS boolean) AS is_peak_season", "'Regular' AS season_category", "'Domestic' AS route_type",
    )


def test_feature_model(spark):
    frame = ft.training_frame(bookings(spark))
    model = ft.fit_features(frame)
    out = model.transform(frame)
    assert set(out.columns) == {"id", "total_fare_bdt", *model.feature_names}
    codes = {r["airline"]: r["airline_encoded"] for r in model.encode(frame.withColumn("keep", F.lit(1))).join(frame.select("id", "airline"), "id").select("airline", "airline_encoded").distinct().collect()}
    assert codes == {"A0": 0, "A1": 1, "A2": 2}
    scaled = out.agg(F.avg("route_popularity_log"), F.stddev_pop("route_popularity")).first()
    assert scaled[0] == pytest.approx(0, abs=1e-9)
    assert out.where("travel_class_encoded = 1").count() == 40  # missing sorts behind Economy
    unseen = frame.limit(1).withColumns({"airline": F.lit("new"), "route": F.lit("X-Y")})
    row = model.transform(unseen).first()
    assert row["airline_encoded"] == -1 and row["route_encoded"] == -1
    mean, std = model.scales["route_popularity"]
    assert row["route_popularity"] == pytest.approx((1 - mean) / (std or 1))


def test_feature_model_with_large_dictionaries(spark, monkeypatch):
    frame = ft.training_frame(bookings(spark))
    want = sorted(map(str, ft.fit_features(frame).transform(frame).collect()))
    monkeypatch.setattr(ft, "LOOKUP_ROWS", 3)
    model = ft.fit_features(frame)
    assert model.small == {**dict.fromkeys(model.categories, True), "source_code": False, "destination_code": False, "route": False, ft.POPULARITY: False}
    assert sorted(map(str, model.transform(frame).collect())) == want


def test_a_dictionary_of_very_many_values(spark, monkeypatch):
    """10^6 distinct values in many ranges: numbered in order, hot ones marked, and no window over the values."""
    monkeypatch.setattr(ft, "LOOKUP_ROWS", 1000)
    n = 1_000_000
    df = spark.range(n).selectExpr("CAST(id AS string) AS id", "concat('v', lpad(id * 7919 % 1000000, 7, '0')) AS many", "concat('f', id % 3) AS few")
    df = df.unionByName(spark.range(3000).selectExpr("CAST(-1 - id AS string) AS id", "'hot' AS many", "CAST(NULL AS string) AS few"))
    codes = ft.category_codes(df.repartition(7), ["many", "few"])
    few = {r["value"]: (r["code"], r["is_hot"]) for r in codes.where("column_name = 'few'").collect()}
    assert few == {"f0": (0, True), "f1": (1, True), "f2": (2, True), "missing": (3, True)}
    many = codes.where("column_name = 'many'")
    assert many.where("value <> 'hot' AND code <> CAST(substr(value, 2) AS int) + 1").isEmpty() and many.count() == n + 1
    assert [tuple(r)[1:] for r in many.where("is_hot").collect()] == [("hot", 0, True)]
    out = ft.label_encode(df, ["many", "few"])
    assert out.where("many_encoded IS NULL OR few_encoded IS NULL").isEmpty() and out.count() == n + 3000


def test_constant_and_empty_columns(spark):
    df = spark.createDataFrame([(1.0, None, None), (1.0, None, 4.0), (1.0, None, 8.0)], "k double, e double, g double")
    stats = ft.scale_stats(df.fillna(0), ["k", "e"])
    assert {r["k"] for r in ft.scale(df, stats).collect()} == {0.0}
    assert [r["g"] for r in ft.final_fill(df, {"g": 6.0}).collect()] == [6.0, 4.0, 8.0]


def test_selection(spark):
    rf = spark.createDataFrame([("a", 0.5), ("b", 0.5), ("c", 0.0)], "feature string, importance double")
    mi = spark.createDataFrame([("a", 0.9), ("b", 0.1), ("c", 0.2)], "feature string, importance double")
    got = [(r["feature"], r["rf_rank"], r["mi_rank"], r["avg_rank"]) for r in ft.rank_merge(rf, mi).collect()]
    assert got == [("a", 1.5, 1.0, 1.25), ("b", 1.5, 3.0, 2.25), ("c", 3.0, 2.0, 2.5)]
    assert [r["feature"] for r in ft.select_top_features(rf, mi, 1).collect()] == ["a"]


def test_a_failing_model_is_left_out(numbers, monkeypatch):
    data = md.assemble(md.train_test_split(numbers[2]), ["a", "b", "c"])
    monkeypatch.setitem(md.MODELS, "lasso", lambda train: 1 / 0)
    board, models = md.train_all(data, ("linear_regression", "lasso"))
    assert set(models) == {"linear_regression"} and md.best_model(board).first()["test_r2"] > 0.8


def test_training_run_and_scoring(spark):
    silver = bookings(spark, 800)
    small = dict(trees=4, depth=4)
    path = new_path(spark, "models")
    row, board, model, features, selected = training.train_run(
        silver, "2025-01-01 00:00:00", path, ("linear_regression", "ridge"), trees=3
    )
    history = row.first()
    assert history["is_production"] and history["training_records"] + history["test_records"] == 800
    requests = silver.select("id", "airline", "source_code", "destination_code", "travel_class", "seasonality", "is_peak_season")
    saved = training.score_saved(spark.newSession(), f"{path}/{history['model_name']}", requests)
    best = board.first()
    direct = score.batch_score(score.request_frame(requests), features, model, [*selected], best["test_rmse"])
    figures = ["id", "predicted_fare_bdt", "interval_lower", "interval_upper"]
    assert sorted(map(tuple, saved.select(*figures).collect())) == sorted(map(tuple, direct.select(*figures).collect()))
    worse = md.history_row(board.withColumn("test_r2", F.lit(-1.0)), md.assemble(md.train_test_split(features.transform(ft.training_frame(silver))), selected), selected, "2025-02-01 00:00:00", path, current=row)
    assert worse.first()["is_production"] is False
    requests = silver.select("id", "airline", "source_code", "destination_code", "travel_class", "seasonality", "is_peak_season")
    scored = score.batch_score(score.request_frame(requests), features, model, [*selected], 10.0)
    assert scored.count() == 800
    one = scored.first()
    assert one["interval_lower"] == pytest.approx(one["predicted_fare_bdt"] - 19.6, abs=0.011)
    narrow = score.batch_score(requests.drop("seasonality"), features, model, [*selected])
    assert narrow.count() == 800  # missing features count as 0
    stored = new_path(spark, "requests")
    score.request_frame(requests).write.parquet(stored)
    stream = score.batch_score(spark.readStream.schema(spark.read.parquet(stored).schema).parquet(stored), features, model, [*selected], 10.0)
    out = new_path(spark, "scores")
    stream.writeStream.option("path", out).option("checkpointLocation", new_path(spark, "state")).trigger(availableNow=True).start().awaitTermination()
    got = sorted((r["id"], r["predicted_fare_bdt"]) for r in spark.read.parquet(out).collect())
    assert got == sorted((r["id"], r["predicted_fare_bdt"]) for r in scored.collect())
    data = md.assemble(md.train_test_split(features.transform(ft.training_frame(silver))), selected)
    forest = md.fit("random_forest", data, **small)
    again = md.fit("random_forest", data, **small)
    assert forest.featureImportances == again.featureImportances  # same seed, same forest


def test_the_gate_decides_on_training(spark):
    store = Ledger(spark, new_path(spark, "gated"))
    store.overwrite(load_plan.SILVER, bookings(spark, 400))
    stats = "load_type string, change_percentage double, records_inserted bigint, records_deleted bigint, records_unchanged bigint"

    def loaded(kind, share, rows, at):
        row = spark.createDataFrame([(kind, share, rows, 0, 0)], stats)
        store.append(load_plan.LOG, incremental.load_log_row(row, 1, at))

    loaded("FULL", 100.0, 400, "2025-01-01 00:00:00")
    first = training.train_if_needed(store, "2025-01-01 01:00:00", ("ridge",), trees=3)
    assert first["decision"] == "retrain" and first["is_production"] and first["scorer"].endswith("/ridge")
    loaded("NONE", 0.0, 0, "2025-01-02 00:00:00")
    assert training.train_if_needed(store, "2025-01-02 01:00:00", ("ridge",), trees=3) == {"decision": "skip", "reasons": ""}
    assert store.read(training.HISTORY).count() == 1
    requests = bookings(spark, 10).select("id", "airline", "source_code", "destination_code", "travel_class", "seasonality", "is_peak_season")
    assert training.score_saved(spark, first["scorer"], requests).count() == 10


def test_status_without_model(spark):
    empty = spark.createDataFrame([], "model_name string, training_timestamp timestamp_ntz, test_r2 double, test_mae double")
    assert md.model_status(empty).first().asDict() == {
        "model_loaded": False, "model_name": "none", "model_version": "0.0", "last_training_date": "never", "test_r2": 0.0, "test_mae": 0.0,
    }


def test_the_feature_table_is_compact(spark):
    table, _ = training.prepare(bookings(spark, 50))
    assert all(".zstd." in name for name in table.inputFiles())
