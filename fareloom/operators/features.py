"""Features for the fare models: derive, impute, encode, scale, fill, select."""

import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions import bands, fixed
from fareloom.functions.numbers import round_to
from fareloom.operators.joins import HOT_SHARE, LOOKUP_ROWS, cross_one, join_on, salted_join
from fareloom.operators.order_stats import (
    column_percentiles,
    percentiles,
    unpivot,
    with_rank,
)
from fareloom.session import COMPACT, materialize

TARGET = "total_fare_bdt"
NOT_FEATURES = (TARGET, "id")
TRAINING_COLUMNS = (
    "id", "airline", "source_code", "destination_code", TARGET, "travel_class", "seasonality",
    "is_peak_season", "season_category", "route_type",
)


def training_frame(silver: DataFrame) -> DataFrame:
    """The silver columns used for training, with the route in the format the gold tables use."""
    return silver.select(
        *TRAINING_COLUMNS, bands.route_key("source_code", "destination_code").alias("route")
    )


def route_counts(df: DataFrame) -> DataFrame:
    return df.where("route IS NOT NULL").groupBy("route").agg(F.count(F.lit(1)).alias("route_popularity"))


#: Key of the route table among the column names of ``FeatureModel.small``.
POPULARITY = "route popularity"


def peak_numeric(df: DataFrame) -> DataFrame:
    flag = F.coalesce(F.col("is_peak_season").cast("int"), F.lit(0))
    return df.withColumn("is_peak_season_numeric", flag)


def _columns(df: DataFrame, kinds) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds) and f.name not in NOT_FEATURES]


def number_columns(df: DataFrame) -> list[str]:
    return _columns(df, T.NumericType)


def category_columns(df: DataFrame) -> list[str]:
    return _columns(df, (T.StringType, T.BooleanType))


def category_text(df: DataFrame, column: str):
    """Category as text: ``missing`` for NULL; flags as False and True, which sort as they should."""
    flag = isinstance(df.schema[column].dataType, T.BooleanType)
    text = F.initcap(F.col(column).cast("string")) if flag else F.col(column)
    return F.coalesce(text, F.lit("missing"))


def category_codes(df: DataFrame, columns) -> DataFrame:
    """(column_name, value, code, is_hot), written: 0, 1, ... by sorted value; hot values hold 1/1000 of the rows or more.

    Values are counted map-side. The distinct ones are sorted by ranges and numbered where they lie, each range from 0; the
    numbers before a range are the running sum of the range sizes, of which there are as many as ranges and columns.
    """
    texts = df.select(*[category_text(df, c).alias(c) for c in columns])
    values = unpivot(texts, columns, "string").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    order = ["column_name", "value"]
    placed = values.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("at", F.monotonically_increasing_id())
    placed = materialize(placed, "sorted-values")
    part = F.shiftright("at", 33)  # the range; the place within it is in the lower bits
    ranges = placed.groupBy("column_name", part.alias("part")).agg(F.count(F.lit(1)).alias("m"), F.min("at").alias("first"), F.sum("n").alias("rows"))
    column = W.partitionBy("column_name")
    before = F.coalesce(F.sum("m").over(column.orderBy("part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    ranges = ranges.select(
        F.col("column_name").alias("__column"), F.col("part").alias("__part"), (before - F.col("first")).alias("__shift"), F.sum("rows").over(column).alias("__rows")
    )
    out = placed.join(F.broadcast(ranges), (F.col("column_name") == F.col("__column")) & (part == F.col("__part")))
    return materialize(
        out.select(
            "column_name", "value", (F.col("at") + F.col("__shift")).cast("int").alias("code"),
            (F.col("n") * HOT_SHARE >= F.col("__rows")).alias("is_hot"),
        ),
        "codes",
    )


@dataclass
class FeatureModel:
    """What fitting learns. Tables stay tables; single numbers are plain values."""

    popularity: DataFrame
    missing_popularity: float
    fills: dict
    codes: DataFrame
    small: dict  # column -> whether its table may be broadcast, by its counted rows
    categories: list
    scales: dict = field(default_factory=dict)
    medians: dict = field(default_factory=dict)
    feature_names: list = field(default_factory=list)

    def save(self, path: str) -> None:
        """The learnt tables as Parquet, the plain values as one line of JSON."""
        spark = self.codes.sparkSession
        plain = {
            "missing_popularity": self.missing_popularity, "fills": self.fills, "small": self.small,
            "categories": self.categories, "scales": self.scales, "medians": self.medians,
            "feature_names": self.feature_names, "has_routes": self.popularity is not None,
        }
        self.codes.write.mode("overwrite").parquet(f"{path}/codes")
        if self.popularity is not None:
            self.popularity.write.mode("overwrite").parquet(f"{path}/popularity")
        spark.createDataFrame([(json.dumps(plain),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/values")

    @classmethod
    def load(cls, spark, path: str) -> "FeatureModel":
        """What ``save`` wrote, for any later session."""
        plain = json.loads(spark.read.text(f"{path}/values").first()["value"])
        popularity = spark.read.parquet(f"{path}/popularity") if plain.pop("has_routes") else None
        plain["scales"] = {c: tuple(v) for c, v in plain["scales"].items()}
        return cls(popularity=popularity, codes=spark.read.parquet(f"{path}/codes"), **plain)

    def transform(self, df: DataFrame) -> DataFrame:
        """Features for any rows with the training columns (the target may be absent)."""
        df = fill_numbers(self.derive(df), self.fills)
        df = self.encode(df)
        df = scale(df, self.scales)
        return final_fill(df, self.medians)

    def derive(self, df: DataFrame) -> DataFrame:
        if "route" in df.columns and "route_popularity" not in df.columns:
            unseen = F.when(F.col("route").isNull(), self.missing_popularity).otherwise(1.0)
            df = self._lookup(df, self.popularity, "route", "route")
            popularity = F.coalesce(F.col("route_popularity").cast("double"), unseen)
            df = df.withColumn("route_popularity", popularity)
            df = df.withColumn("route_popularity_log", F.log1p("route_popularity"))
        return peak_numeric(df) if "is_peak_season" in df.columns else df

    def encode(self, df: DataFrame) -> DataFrame:
        """Categories to codes, -1 for values not seen in training; the texts are dropped."""
        present = [c for c in self.categories if c in df.columns]
        for c in present:
            df = df.withColumn(c, category_text(df, c))
            mine = self.codes.where(F.col("column_name") == c)
            table = mine.select(F.col("value").alias(c), F.col("code").alias(f"{c}_encoded"))
            df = self._lookup(df, table, c, c).withColumn(
                f"{c}_encoded", F.coalesce(f"{c}_encoded", F.lit(-1))
            )
        return df.drop(*category_columns(df))

    def _lookup(self, df, table, key, column):
        if self.small[column if table is not self.popularity else POPULARITY]:  # fitting has counted the rows of each table
            return join_on(df, F.broadcast(table), [key], "left", null_safe=False)
        hot = self.codes.where((F.col("column_name") == column) & F.col("is_hot"))
        return salted_join(df, table, key, "id", hot=hot.select(F.col("value").alias(key)))


def fill_numbers(df: DataFrame, fills: dict) -> DataFrame:
    known = {c: v for c, v in fills.items() if c in df.columns}
    return df.fillna(known) if known else df


def scale_stats(df: DataFrame, columns) -> dict:
    """column -> (mean, population deviation); one row comes back."""
    if not columns:
        return {}
    row = df.agg(
        *[F.avg(c).alias(f"{c}|mean") for c in columns], *[F.stddev_pop(c).alias(f"{c}|std") for c in columns]
    ).first()
    return {c: (row[f"{c}|mean"] or 0.0, row[f"{c}|std"] or 0.0) for c in columns}


def scale(df: DataFrame, scales: dict) -> DataFrame:
    """z-scores with the population deviation; a constant column becomes zero."""
    return df.withColumns(
        {
            c: (F.col(c).cast("double") - F.lit(mean)) / F.lit(std if std else 1.0)
            for c, (mean, std) in scales.items()
            if c in df.columns
        }
    )


def final_fill(df: DataFrame, medians: dict) -> DataFrame:
    """What is still missing in a number column gets the median known from training, else 0."""
    numbers = number_columns(df)
    return df.fillna({c: float(medians.get(c, 0.0)) for c in numbers}) if numbers else df


def column_medians(df: DataFrame, columns) -> dict:
    """column -> median; one row per column comes back."""
    if not columns:
        return {}
    return {r["column_name"]: r["m"] for r in column_percentiles(df, columns, {"m": 0.5}).collect()}


def fit_features(df: DataFrame) -> FeatureModel:
    counts = materialize(route_counts(df), "route_counts") if "route" in df.columns else None
    missing = 0.0
    if counts is not None and not df.where("route IS NULL").limit(1).isEmpty():
        # the median over rows: every count weighs as much as it has rows
        rows = join_on(df.select("route"), counts, ["route"], null_safe=False)
        row = percentiles(rows, [], "route_popularity", {"m": 0.5}).first()
        missing = float(row["m"]) if row else 0.0
    categories = category_columns(df)
    codes = category_codes(df, categories)
    sizes = {r["column_name"]: r["count"] for r in codes.groupBy("column_name").count().collect()}  # a row a column
    small = {c: sizes.get(c, 0) <= LOOKUP_ROWS for c in categories}
    small[POPULARITY] = counts is None or counts.count() <= LOOKUP_ROWS
    model = FeatureModel(popularity=counts, missing_popularity=missing, fills={}, codes=codes, small=small, categories=categories)
    derived = materialize(model.derive(df).drop(*category_columns(df)), "derived", options=COMPACT)  # read for the gaps, medians and scales
    numbers = number_columns(derived)
    medians = column_medians(derived, numbers)
    gaps = derived.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in numbers]).first()
    model.fills = {c: float(medians.get(c, 0.0)) for c in numbers if gaps[c]}
    model.scales = scale_stats(fill_numbers(derived, model.fills), numbers)
    # filling gaps with the median leaves it where it is, and scaling moves it like any value
    model.medians = {c: (medians.get(c, 0.0) - mean) / (std if std else 1.0) for c, (mean, std) in model.scales.items()}
    model.feature_names = [c for c in model.transform(df).columns if c not in NOT_FEATURES]
    return model


# --- selection ---------------------------------------------------------------------------------


def mutual_information(df: DataFrame, features, target: str, bins=32) -> DataFrame:
    """Mutual information of each feature with the target, from joint counts over equal-width bins.

    One pass for the extremes, one for the counts. The joint table has bins * bins cells per feature
    at most, whatever the number of rows.
    """
    columns = [*features, target]
    bounds = df.agg(
        *[F.min(F.col(c).cast("double")).alias(f"{c}|lo") for c in columns],
        *[F.max(F.col(c).cast("double")).alias(f"{c}|hi") for c in columns],
    ).first()

    def place(c):
        lo, hi = bounds[f"{c}|lo"], bounds[f"{c}|hi"]
        if lo is None or hi == lo:
            return F.lit(0)
        return F.least(F.lit(bins - 1), F.floor((F.col(c) - lo) * bins / (hi - lo)).cast("int"))

    cells = (
        df.select(place(target).alias("y"), *[place(c).alias(c) for c in features])
        .unpivot(["y"], list(features), "feature", "x")
        .groupBy("feature", "x", "y")
        .agg(F.count(F.lit(1)).alias("n"))
    )
    by = W.partitionBy("feature")
    total, nx, ny = (
        F.sum("n").over(w) for w in (by, W.partitionBy("feature", "x"), W.partitionBy("feature", "y"))
    )
    cells = cells.select("feature", "n", total.alias("t"), nx.alias("nx"), ny.alias("ny"))
    bits = F.col("n") / F.col("t") * F.log(F.col("n") * F.col("t") / (F.col("nx") * F.col("ny")))
    return cells.groupBy("feature").agg(round_to(F.greatest(F.sum(bits), F.lit(0.0)), 6).alias("importance"))


def rank_merge(forest: DataFrame, information: DataFrame) -> DataFrame:
    """Mean of the two ranks per feature, best first."""
    left = with_rank(forest, "importance", "rf_rank", "average").select("feature", "rf_rank")
    right = with_rank(information, "importance", "mi_rank", "average").select("feature", "mi_rank")
    mean = (F.col("rf_rank") + F.col("mi_rank")) / 2
    return left.join(right, "feature").withColumn("avg_rank", mean).orderBy("avg_rank", "feature")


def select_top_features(forest: DataFrame, information: DataFrame, top=fixed.TOP_FEATURES) -> DataFrame:
    return rank_merge(forest, information).limit(top)


def popularity_feature(df: DataFrame) -> DataFrame:
    """Route popularity with its logarithm, for a frame on its own."""
    counts = materialize(route_counts(df), "route_counts")
    out = salted_join(df, counts, "route", "id") if counts.count() > LOOKUP_ROWS else join_on(
        df, F.broadcast(counts), ["route"], "left", null_safe=False
    )
    return out.withColumn("route_popularity_log", F.log1p("route_popularity"))


def label_encode(df: DataFrame, columns) -> DataFrame:
    """Encode columns by their own sorted values, keeping the texts."""
    codes = category_codes(df, columns)
    for c in columns:
        table = codes.where(F.col("column_name") == c).select(F.col("value").alias(c), F.col("code").alias(f"{c}_encoded"))
        df = df.withColumn(c, category_text(df, c)).join(table, c, "left")
    return df


def scale_std(df: DataFrame, columns) -> DataFrame:
    """z-scores from a one-row frame of means and deviations, without a driver round trip."""
    stats = df.agg(*[F.avg(c).alias(f"{c}__m") for c in columns], *[F.stddev_pop(c).alias(f"{c}__s") for c in columns])
    out = cross_one(df, stats)
    scaled = {
        c: (F.col(c).cast("double") - F.col(f"{c}__m")) / F.when(F.col(f"{c}__s") == 0, 1.0).otherwise(F.col(f"{c}__s"))
        for c in columns
    }
    return out.withColumns(scaled).drop(*stats.columns)
