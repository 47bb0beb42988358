"""Data-quality checks and layer counts."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.bands import route_key
from fareloom.functions.numbers import ratio_pct, round_to
from fareloom.operators.order_stats import unpivot

# The declared checks, (table, column, check).
SILVER_NOT_NULL = (
    "id", "airline", "source_code", "destination_code", "total_fare_bdt", "travel_class",
    "seasonality", "is_peak_season", "season_category",
)
SILVER_UNIQUE = ("id",)
SILVER_ACCEPTED = {"route_type": ("Domestic", "International")}
GOLD_UNIQUE = {
    "gold_avg_fare_by_airline": "airline",
    "gold_seasonal_fare_analysis": "seasonality",
    "gold_booking_count_by_airline": "airline",
    "gold_popular_routes": "route",
    "gold_fare_by_class": "travel_class",
}
GOLD_NOT_NULL = {
    "gold_avg_fare_by_airline": ("airline", "total_bookings"),
    "gold_seasonal_fare_analysis": ("seasonality",),
    "gold_booking_count_by_airline": ("airline",),
    "gold_popular_routes": ("route",),
    "gold_fare_by_class": ("travel_class",),
}


def _rows(df: DataFrame, table: str, test: str) -> DataFrame:
    return df.select(
        F.lit(table).alias("table_name"), "column_name", F.lit(test).alias("test"), "failures"
    )


def dq_not_null(df: DataFrame, table: str, columns) -> DataFrame:
    """NULLs per column: all columns in one pass."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    return _rows(counts.unpivot([], list(columns), "column_name", "failures"), table, "not_null")


def dq_unique(df: DataFrame, table: str, column: str) -> DataFrame:
    """Number of values that occur more than once; NULLs do not count."""
    repeated = df.where(F.col(column).isNotNull()).groupBy(column).count().where("count > 1")
    failures = repeated.agg(F.count(F.lit(1)).alias("failures"))
    return _rows(failures.withColumn("column_name", F.lit(column)), table, "unique")


def dq_accepted_values(df: DataFrame, table: str, column: str, values) -> DataFrame:
    """Number of distinct values outside the list; NULLs pass."""
    outside = df.where(~F.col(column).isin(*values)).select(column).distinct()
    failures = outside.agg(F.count(F.lit(1)).alias("failures"))
    return _rows(failures.withColumn("column_name", F.lit(column)), table, "accepted_values")


def dq_silver(silver: DataFrame, table="silver_cleaned_flights") -> DataFrame:
    parts = [dq_not_null(silver, table, SILVER_NOT_NULL)]
    parts += [dq_unique(silver, table, c) for c in SILVER_UNIQUE]
    parts += [dq_accepted_values(silver, table, c, v) for c, v in SILVER_ACCEPTED.items()]
    return union_all(*parts)


def dq_gold(tables: dict) -> DataFrame:
    parts = [dq_not_null(tables[t], t, columns) for t, columns in GOLD_NOT_NULL.items()]
    parts += [dq_unique(tables[t], t, c) for t, c in GOLD_UNIQUE.items()]
    return union_all(*parts)


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def layer_counts(layers: dict) -> DataFrame:
    """Row count per table; counts of Parquet tables come from the file footers."""
    return union_all(
        *[
            df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("table_name"), "rows")
            for name, df in layers.items()
        ]
    )


def pass_rate(validated: DataFrame) -> DataFrame:
    total, valid = F.count(F.lit(1)), F.count_if("is_valid")
    return validated.agg(
        total.alias("total"), valid.alias("valid"), round_to(ratio_pct(valid, total), 2).alias("pass_rate")
    )


def dq_totals(validated: DataFrame, columns) -> DataFrame:
    """One row per quality metric: totals, NULLs per column, distinct airlines and routes."""
    valid = F.col("is_valid")
    nulls = {f"null_{c}": F.count_if(F.col(c).isNull()) for c in columns}
    one = validated.agg(
        F.count(F.lit(1)).alias("record_count"),
        F.count_if(valid).alias("valid_record_count"),
        F.count_if(~valid).alias("invalid_record_count"),
        *[c.alias(name) for name, c in nulls.items()],
    )
    names = ["record_count", "valid_record_count", "invalid_record_count", *nulls]
    totals = one.unpivot([], names, "metric", "metric_value")
    cells = validated.select("airline", route_key("source_code", "destination_code").alias("route"))
    distinct = (
        unpivot(cells, ["airline", "route"], "string")
        .where("value IS NOT NULL")
        .distinct()
        .groupBy("column_name")
        .agg(F.count(F.lit(1)).alias("metric_value"))
        .select(F.concat(F.lit("unique_"), "column_name", F.lit("_count")).alias("metric"), "metric_value")
    )
    return totals.unionByName(distinct)
