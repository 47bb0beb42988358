"""Training runs: gate -> silver -> features -> selection -> models -> history row; and scoring from what they saved."""

import json

from pyspark.ml import regression
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.operators import features as ft
from fareloom.operators import incremental, score
from fareloom.operators import models as md
from fareloom.plans.load import LOG, SILVER
from fareloom.session import COMPACT, materialize
from fareloom.sources.ledger import Ledger
from fareloom.sources.tables import latest_row

HISTORY = "model_history"


def prepare(silver: DataFrame):
    """Feature table with the split flag, written once for all fits, and the fitted features."""
    frame = ft.training_frame(silver).where(f"{ft.TARGET} IS NOT NULL")
    model = ft.fit_features(frame)
    return materialize(md.train_test_split(model.transform(frame)), "features", options=COMPACT), model


def choose(table: DataFrame, names, trees=100, top=ft.fixed.TOP_FEATURES) -> list[str]:
    """Names of the best features, by the mean of both ranks."""
    return chosen(table, names, md.importance_forest(md.assemble(table, names), names, trees), top)


def chosen(table: DataFrame, names, forest: DataFrame, top=ft.fixed.TOP_FEATURES) -> list[str]:
    """``choose`` from the importances of a forest."""
    information = ft.mutual_information(table, names, ft.TARGET)
    return [r["feature"] for r in ft.select_top_features(forest, information, top).collect()]


def train_run(silver: DataFrame, at, path=None, names=tuple(md.MODELS), current=None, trees=100):
    """Train, compare, save the best model under ``path`` and describe it in a history row."""
    table, feature_model = prepare(silver)
    selected = choose(table, feature_model.feature_names, trees)
    leaderboard, models = md.train_all(md.assemble(table, selected), names)
    row, best = describe(table, feature_model, selected, leaderboard, models, at, path, current)
    return row, leaderboard, models[best], feature_model, selected


def describe(table: DataFrame, feature_model, selected, leaderboard, models: dict, at, path=None, current=None) -> tuple[DataFrame, str]:
    """What follows the fits of a run: save the best model under ``path``, cross-validate it, make its history row; and its name."""
    data = md.assemble(table, selected)
    best = md.best_model(leaderboard).first()
    if path:
        save_scorer(f"{path}/{best['model_name']}", models[best["model_name"]], feature_model, selected, best["model_name"], best["test_rmse"], at)
    cv = None
    if "id" in table.columns:  # folds go by it; linear models need no refits
        cv = md.cv_scores(table.where("NOT is_test"), selected) if best["model_name"] in md.LINEAR_KINDS else md.cross_validate(data, [best["model_name"]])
    return md.history_row(leaderboard, data, selected, at, path, cv, current), best["model_name"]


def save_scorer(path: str, model, feature_model: ft.FeatureModel, selected, name: str, rmse: float, at) -> None:
    """All that scoring needs, in one folder: the model, the fitted features, their names, the test error."""
    model.write().overwrite().save(f"{path}/model")
    feature_model.save(f"{path}/features")
    about = {"kind": type(model).__name__, "selected": list(selected), "model_name": name, "rmse": rmse, "version": str(at)}
    spark = feature_model.codes.sparkSession
    spark.createDataFrame([(json.dumps(about),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/about")


def score_saved(spark: SparkSession, path: str, requests: DataFrame) -> DataFrame:
    """Scores of a frame of requests by a saved model, with the interval of its own test error."""
    about = json.loads(spark.read.text(f"{path}/about").first()["value"])
    model = getattr(regression, about["kind"]).load(f"{path}/model")
    features = ft.FeatureModel.load(spark, f"{path}/features")
    return score.batch_score(
        score.request_frame(requests), features, model, about["selected"], about["rmse"], about["model_name"], about["version"]
    )


def train_if_needed(store: Ledger, at, names=tuple(md.MODELS), trees=100) -> dict:
    """Ask the gate about the last load and the last model; if it says so, train on silver and append to the history.

    Returns the decision, its reasons and, after training, where the scorer is and whether it goes into production.
    """
    loads = latest_row(store.read(LOG), "load_timestamp")
    if store.exists(HISTORY):
        history = store.read(HISTORY)
        last, current = latest_row(history, "training_timestamp"), latest_row(history.where("is_production"), "training_timestamp")
    else:
        last, current = store.spark.createDataFrame([], "training_timestamp timestamp_ntz"), None
    gate = incremental.retrain_gate(loads, last, at).first().asDict()
    if gate["decision"] != "retrain":
        return gate
    path = f"{store.root}/models/{str(at).replace(' ', 'T').replace(':', '-')}"
    row = materialize(train_run(store.read(SILVER), at, path, names, current, trees)[0], HISTORY)
    store.append(HISTORY, row)
    won = row.select(F.concat_ws("/", "model_path", "model_name").alias("scorer"), "is_production").first()
    return {**gate, **won.asDict()}
