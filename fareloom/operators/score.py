"""Batch scoring: features, prediction and its interval for a whole frame of requests."""

from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions import bands, fixed
from fareloom.functions.numbers import round_to
from fareloom.operators.features import FeatureModel


def request_frame(requests: DataFrame, domestic=fixed.DOMESTIC_CODES) -> DataFrame:
    """Requests with the columns they may lack: route, route type and season category."""
    out = requests.withColumn("route", bands.route_key("source_code", "destination_code"))
    if "route_type" not in out.columns:
        out = out.withColumn("route_type", bands.route_type("source_code", "destination_code", domestic))
    if "season_category" not in out.columns:
        out = out.withColumn("season_category", bands.scoring_season("seasonality"))
    return out


def with_interval(df: DataFrame, predicted="prediction", rmse=fixed.DEFAULT_RMSE) -> DataFrame:
    """Prediction and its 95 % interval, cut off at zero, to two decimals."""
    p, reach = F.col(predicted), fixed.INTERVAL_Z * float(rmse)
    return df.withColumns(
        {
            "predicted_fare_bdt": round_to(p, 2),
            "interval_lower": round_to(F.greatest(F.lit(0.0), p - reach), 2),
            "interval_upper": round_to(p + reach, 2),
        }
    )


def batch_score(requests: DataFrame, features: FeatureModel, model, selected, rmse=None,
                model_name="model", version="1.0") -> DataFrame:
    """Score every request. Features the requests do not give count as 0."""
    keep = requests.columns
    tagged = requests.withColumn("__request", F.struct(*keep))
    frame = features.transform(tagged.drop(TARGET) if TARGET in keep else tagged)
    missing = [f for f in selected if f not in frame.columns]
    frame = frame.withColumns({f: F.lit(0.0) for f in missing}) if missing else frame
    scored = model.transform(VectorAssembler(inputCols=list(selected), outputCol="features").transform(frame))
    scored = with_interval(scored, rmse=fixed.DEFAULT_RMSE if rmse is None else rmse)
    return scored.select(
        "__request.*", "predicted_fare_bdt", "interval_lower", "interval_upper",
        F.lit(model_name).alias("model_name"), F.lit(version).alias("model_version"),
    )


TARGET = "total_fare_bdt"
