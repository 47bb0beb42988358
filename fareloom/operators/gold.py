"""Gold tables: one row per group of silver rows.

Every table is a hash aggregation with map-side partial results, so a group that holds a third of
the rows costs one small partial row per task. Medians and modes come from ``order_stats``. Totals
for shares are a count over the input, not a window over the groups.
"""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions.numbers import (
    aggregate,
    ratio_pct,
    round_to,
    sql_avg,
    sql_change,
    sql_count,
    sql_round,
)
from fareloom.operators.joins import cross_one, join_on
from fareloom.operators.order_stats import percentiles, with_rank

TOTAL = "total_fare_bdt"
PEAK, OFF_PEAK = "is_peak_season", "NOT is_peak_season"


def avg2(value: str, where: str | None = None) -> str:
    return sql_round(sql_avg(value, where))


EXTREMES = {"min_fare": sql_round(f"min({TOTAL})"), "max_fare": sql_round(f"max({TOTAL})")}
PEAK_COUNTS = {"peak_season_bookings": sql_count(PEAK), "off_peak_bookings": sql_count(OFF_PEAK)}
ROUTE_COUNTS = {
    "domestic_bookings": sql_count("route_type = 'Domestic'"),
    "international_bookings": sql_count("route_type = 'International'"),
}
PREMIUM = {"peak_premium_pct": sql_round(sql_change(sql_avg(TOTAL, PEAK), sql_avg(TOTAL, OFF_PEAK)))}


def with_percentiles(groups: DataFrame, silver: DataFrame, keys, wanted: dict) -> DataFrame:
    quantiles = percentiles(silver, keys, TOTAL, wanted)
    rounded = quantiles.select(*keys, *[round_to(c, 2).alias(c) for c in wanted])
    return join_on(groups, rounded, keys, "left")


def with_share(groups: DataFrame, silver: DataFrame, count: str, out: str) -> DataFrame:
    """Share of all rows, in per cent."""
    total = silver.agg(F.count(F.lit(1)).alias("__total"))
    return (
        cross_one(groups, total)
        .withColumn(out, round_to(ratio_pct(F.col(count), "__total"), 2))
        .drop("__total")
    )


def gold_avg_fare_by_airline(silver: DataFrame) -> DataFrame:
    known = "'Economy', 'Business', 'First', 'Premium Economy'"
    measures = {
        "total_bookings": sql_count(),
        "avg_base_fare": avg2("base_fare_bdt"),
        "avg_tax_surcharge": avg2("tax_surcharge_bdt"),
        "avg_total_fare": avg2(TOTAL),
        **EXTREMES,
        "fare_std_dev": sql_round(f"stddev_samp({TOTAL})"),
        "economy_bookings": sql_count("travel_class = 'Economy'"),
        "business_bookings": sql_count("travel_class = 'Business'"),
        "first_class_bookings": sql_count("travel_class = 'First'"),
        "premium_economy_bookings": sql_count("travel_class = 'Premium Economy'"),
        "other_class_bookings": sql_count(f"travel_class NOT IN ({known})"),
        **ROUTE_COUNTS,
        **PEAK_COUNTS,
        "avg_peak_fare": avg2(TOTAL, PEAK),
        "avg_off_peak_fare": avg2(TOTAL, OFF_PEAK),
        **PREMIUM,
        "avg_duration_hrs": avg2("duration_hrs"),
    }
    wanted = {"median_fare": 0.5, "fare_25th_percentile": 0.25, "fare_75th_percentile": 0.75}
    groups = with_percentiles(aggregate(silver, ["airline"], measures), silver, ["airline"], wanted)
    return with_share(groups, silver, "total_bookings", "market_share_pct")


def gold_booking_count_by_airline(silver: DataFrame) -> DataFrame:
    measures = {
        "total_bookings": sql_count(),
        "direct_bookings": sql_count("booking_source = 'Direct Booking'"),
        "agency_bookings": sql_count("booking_source = 'Travel Agency'"),
        "online_bookings": sql_count("booking_source = 'Online Website'"),
        "last_minute_bookings": sql_count("booking_window = 'Last Minute'"),
        "short_notice_bookings": sql_count("booking_window = 'Short Notice'"),
        "advance_bookings": sql_count("booking_window = 'Advance'"),
        "early_bird_bookings": sql_count("booking_window = 'Early Bird'"),
        **PEAK_COUNTS,
        "regular_bookings": sql_count("season_category = 'Regular'"),
        "religious_holiday_bookings": sql_count("season_category = 'Religious'"),
        "seasonal_holiday_bookings": sql_count("season_category = 'Seasonal'"),
        "general_holiday_bookings": sql_count("season_category = 'Holiday'"),
        "other_season_bookings": sql_count("season_category = 'Other'"),
        "weekday_bookings": sql_count("departure_day_type = 'Weekday'"),
        "weekend_bookings": sql_count("departure_day_type = 'Weekend'"),
        "avg_days_before_departure": sql_round("avg(days_before_departure)", 1),
        "peak_season_pct": sql_round(f"{sql_count(PEAK)} / count(1) * 100"),
    }
    groups = aggregate(silver, ["airline"], measures)
    return with_share(groups, silver, "total_bookings", "market_share_pct")


def gold_fare_by_class(silver: DataFrame) -> DataFrame:
    measures = {
        "total_bookings": sql_count(),
        "avg_base_fare": avg2("base_fare_bdt"),
        "avg_tax": avg2("tax_surcharge_bdt"),
        "avg_total_fare": avg2(TOTAL),
        **EXTREMES,
        "avg_domestic_fare": avg2(TOTAL, "route_type = 'Domestic'"),
        "avg_international_fare": avg2(TOTAL, "route_type = 'International'"),
        **ROUTE_COUNTS,
        "avg_peak_season_fare": avg2(TOTAL, PEAK),
        "avg_regular_fare": avg2(TOTAL, OFF_PEAK),
        **PEAK_COUNTS,
        **PREMIUM,
        "avg_duration_hrs": avg2("duration_hrs"),
    }
    groups = aggregate(silver, ["travel_class"], measures)
    groups = with_percentiles(groups, silver, ["travel_class"], {"median_fare": 0.5})
    return with_share(groups, silver, "total_bookings", "class_share_pct")


def gold_popular_routes(silver: DataFrame) -> DataFrame:
    """Routes with their busiest airline and their place by bookings.

    The rows are summed per route and airline first: that splits a busy route over its airlines and
    lets the busiest one be picked from finished counts in the second step.
    """
    keys = ["route", "source_code", "destination_code", "route_type"]
    counts = {
        "total_bookings": None,
        "direct_flights": "num_stops = 0",
        "one_stop_flights": "num_stops = 1",
        "two_stop_flights": "num_stops = 2",
        "economy_bookings": "travel_class = 'Economy'",
        "business_bookings": "travel_class = 'Business'",
        "first_class_bookings": "travel_class = 'First'",
        "other_class_bookings": "travel_class NOT IN ('Economy', 'Business', 'First')",
        "peak_season_bookings": PEAK,
        "off_peak_bookings": OFF_PEAK,
    }
    sums = {
        "fare": TOTAL,
        "hours": "duration_hrs",
        "peak_fare": f"CASE WHEN {PEAK} THEN {TOTAL} END",
        "off_fare": f"CASE WHEN {OFF_PEAK} THEN {TOTAL} END",
    }
    per_airline = aggregate(
        silver,
        [*keys, "airline"],
        {
            **{name: sql_count(where) for name, where in counts.items()},
            **{f"{name}_sum": f"sum({value})" for name, value in sums.items()},
            **{f"{name}_n": f"count({value})" for name, value in sums.items()},
            "min_fare": f"min({TOTAL})",
            "max_fare": f"max({TOTAL})",
            "source_name": "max(source_name)",
            "destination_name": "max(destination_name)",
        },
    )

    def mean(name):
        return f"sum({name}_sum) / nullif(sum({name}_n), 0)"

    airline = "min(CASE WHEN airline IS NOT NULL THEN struct(-total_bookings AS n, airline) END).airline"
    groups = aggregate(
        per_airline,
        keys,
        {
            "source_name": "max(source_name)",
            "destination_name": "max(destination_name)",
            **{name: f"sum({name})" for name in counts},
            "avg_fare": sql_round(mean("fare")),
            "min_fare": sql_round("min(min_fare)"),
            "max_fare": sql_round("max(max_fare)"),
            "avg_duration_hrs": sql_round(mean("hours")),
            "avg_peak_fare": sql_round(mean("peak_fare")),
            "avg_off_peak_fare": sql_round(mean("off_fare")),
            "peak_premium_pct": sql_round(sql_change(mean("peak_fare"), mean("off_fare"))),
            "most_common_airline": airline,
        },
    )
    groups = with_rank(groups, "total_bookings", "popularity_rank", counts=True)
    return with_percentiles(groups, silver, keys, {"median_fare": 0.5})


def gold_seasonal_fare_analysis(silver: DataFrame) -> DataFrame:
    """Seasons compared with the regular season.

    Without a regular season the difference is NULL (the rows stay); of several spellings of
    "regular" the one that sorts first is the yardstick.
    """
    keys = ["seasonality", "season_category", "is_peak_season"]
    measures = {
        "total_bookings": sql_count(),
        "avg_fare": avg2(TOTAL),
        **EXTREMES,
        "avg_domestic_fare": avg2(TOTAL, "route_type = 'Domestic'"),
        "avg_international_fare": avg2(TOTAL, "route_type = 'International'"),
        "avg_economy_fare": avg2(TOTAL, "travel_class = 'Economy'"),
        "avg_business_fare": avg2(TOTAL, "travel_class = 'Business'"),
        "avg_first_class_fare": avg2(TOTAL, "travel_class = 'First'"),
    }
    groups = aggregate(silver, keys, measures)
    regular = aggregate(
        aggregate(silver.where("upper(seasonality) = 'REGULAR'"), ["seasonality"], {"a": avg2(TOTAL)}),
        [],
        {"__regular": "min_by(a, seasonality)"},
    )
    difference = sql_round(sql_change("avg_fare", "__regular"))
    groups = (
        cross_one(groups, regular)
        .withColumn("pct_diff_from_regular", F.expr(difference))
        .drop("__regular")
    )
    groups = with_percentiles(groups, silver, keys, {"median_fare": 0.5})
    return with_share(groups, silver, "total_bookings", "booking_share_pct")


def gold_data_quality_report(silver: DataFrame) -> DataFrame:
    """All values of four category columns with their counts, from a single pass."""
    na = F.lit("N/A")
    peak = F.when(F.col(PEAK), "Yes").otherwise("No")
    entries = [F.struct(F.lit("seasonality").alias("field_name"), F.col("seasonality").alias("field_value"),
                        F.col("season_category").alias("category"), peak.alias("is_peak"))]
    for c in ("travel_class", "booking_source", "stopovers"):
        entries.append(F.struct(F.lit(c).alias("field_name"), F.col(c).alias("field_value"),
                                na.alias("category"), na.alias("is_peak")))
    return (
        silver.select(F.inline(F.array(*entries)))
        .groupBy("field_name", "field_value", "category", "is_peak")
        .agg(F.count(F.lit(1)).alias("record_count"))
    )


def revenue_metrics(silver: DataFrame) -> DataFrame:
    """Revenue per airline, with bookings by class and by window as JSON.

    Category counts are finished before they are put into a map, so a map has one entry per
    category and not one per row.
    """
    cells = silver.select(
        "airline",
        TOTAL,
        F.inline(
            F.array(
                F.struct(F.lit("class").alias("kind"), F.col("travel_class").alias("value")),
                F.struct(F.lit("window").alias("kind"), F.col("booking_window").alias("value")),
            )
        ),
    )
    cells = cells.groupBy("airline", "kind", "value").agg(
        F.count(F.lit(1)).alias("n"), F.sum(TOTAL).alias("revenue")
    )

    def as_json(kind):
        entry = F.when(
            (F.col("kind") == kind) & F.col("value").isNotNull(), F.struct("value", "n")
        )
        return F.to_json(F.map_from_entries(F.array_sort(F.collect_list(entry))))

    windows = F.col("kind") == "window"  # every row has exactly one window entry
    n = F.sum(F.when(windows, F.col("n")))
    revenue = F.sum(F.when(windows, F.col("revenue")))
    groups = cells.groupBy("airline").agg(
        n.alias("total_bookings"),
        revenue.alias("revenue"),
        round_to(revenue / n, 2).alias("avg_booking_value"),
        as_json("class").alias("booking_by_class"),
        as_json("window").alias("booking_by_window"),
    )
    all_revenue = silver.agg(F.sum(TOTAL).alias("__all"))
    return cross_one(groups, all_revenue).select(
        "airline",
        "total_bookings",
        round_to("revenue", 2).alias("total_revenue"),
        "avg_booking_value",
        round_to(ratio_pct("revenue", "__all"), 2).alias("revenue_share_pct"),
        "booking_by_class",
        "booking_by_window",
    )


def sort_output(groups: DataFrame, count="total_bookings") -> DataFrame:
    """Presentation order: most rows first, ties by the other columns."""
    rest = [F.col(c).asc_nulls_last() for c in groups.columns if c != count]
    return groups.orderBy(F.col(count).desc(), *rest)


GOLD_TABLES = {
    "gold_avg_fare_by_airline": gold_avg_fare_by_airline,
    "gold_booking_count_by_airline": gold_booking_count_by_airline,
    "gold_fare_by_class": gold_fare_by_class,
    "gold_popular_routes": gold_popular_routes,
    "gold_seasonal_fare_analysis": gold_seasonal_fare_analysis,
    "gold_data_quality_report": gold_data_quality_report,
}
