"""The registered queries, by operator."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from catalogue import inputs as I
from fareloom.functions import bands, fixed, text
from fareloom.functions.numbers import (
    aggregate,
    peak_premium,
    round_to,
    sql_avg,
    sql_count,
    sql_round,
)
from fareloom.operators import (
    audit,
    features,
    gold,
    incremental,
    joins,
    models,
    order_stats,
    profile,
    quality,
    scd,
    score,
    silver,
    sketches,
    validate,
)
from fareloom.plans import load, training
from fareloom.session import freeing, input_size, materialize, new_path
from fareloom.sources import bookings as src
from fareloom.sources import files, tables
from fareloom.sources.ledger import Ledger
from fareloom.streaming import ingest

TOTAL = "total_fare_bdt"
NUMBERS = ["duration_hrs", "base_fare_bdt", "tax_surcharge_bdt", TOTAL, "days_before_departure"]
TEXTS = ["airline", "source_code", "destination_code", "stopovers", "aircraft_type", "travel_class",
         "booking_source", "seasonality"]

#: Bytes of the written bookings for a CSV file that is dropped for the stream.
DROP_BYTES = 4 << 20

QUERIES: dict = {}


def query(name):
    def register(fn):
        QUERIES[name] = fn
        return fn

    return register


# --- sources and sinks -------------------------------------------------------------------------


def _csv(spark, sf_dir) -> str:
    """The bookings as CSV files with the source's headers."""
    headers = {field: header for header, field in fixed.CSV_HEADERS.items()}
    path = new_path(spark, "bookings_csv")
    I.checked(spark, sf_dir).select(*src.FIELDS).withColumnsRenamed(headers).write.options(
        header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss", quoteAll=True,
        ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False,
    ).csv(path)
    return path


@query("scan_csv")
def scan_csv(spark, sf_dir):
    return files.scan_csv(spark, _csv(spark, sf_dir)).select(
        F.col("Airline").alias("airline"), F.col("Class").alias("travel_class"),
        F.col("Stopovers").alias("stopovers"), F.col("Departure Date & Time").alias("departed"),
    )


@query("rename_columns")
def rename_columns(spark, sf_dir):
    df = files.rename_columns(files.scan_csv(spark, _csv(spark, sf_dir)))
    return df.groupBy("source_code", "destination_code", "booking_source").agg(F.count(F.lit(1)).alias("n"))


@query("rename_snake")
def rename_snake(spark, sf_dir):
    df = files.rename_snake(files.scan_csv(spark, _csv(spark, sf_dir)))
    return df.groupBy("source_city", "airline", "travel_class", "seasonality").agg(
        F.count(F.lit(1)).alias("n"), F.count("total_fare_bdt").alias("fares"),
        F.count("base_fare").alias("bases"), F.count("tax_surcharge").alias("taxes"),
    )


@query("coerce_types")
def coerce_types(spark, sf_dir):
    df = files.coerce_types(files.rename_columns(files.scan_csv(spark, _csv(spark, sf_dir))))
    return df.select(*src.FIELDS)


@query("null_row_count")
def null_row_count(spark, sf_dir):
    # a departure text that is no time, and an empty fare, become NULL
    df = I.validated(spark, sf_dir).select(
        F.when(F.col("seasonality") == "Hajj", "soon").otherwise(text.time_text("departure_datetime"))
        .alias("departure_datetime"),
        F.when(F.col("tax_surcharge_bdt") > 0, F.col("base_fare_bdt").cast("string")).otherwise("")
        .alias("base_fare_bdt"),
        "airline",
    )
    return files.null_row_count(files.coerce_types(df))


@query("scan_table")
def scan_table(spark, sf_dir):
    return tables.read_where(I.silver(spark, sf_dir), ["id", "airline", "route", TOTAL], f"{TOTAL} >= 100000")


@query("limit_n")
def limit_n(spark, sf_dir):
    return tables.read_where(I.silver(spark, sf_dir), ["id", "airline"], limit=100)


@query("sink_append")
def sink_append(spark, sf_dir):
    store = tables.Store(spark, new_path(spark, "append"))
    rows = I.valid_columns(spark, sf_dir, "id", "airline", "departure_datetime", "seasonality", "base_fare_bdt", TOTAL)
    first = I.first_extract(spark, sf_dir, rows).select("id", "airline", TOTAL)
    store.append("staging", first)
    rest = I.second_extract(spark, sf_dir, rows).select("id", "airline", TOTAL)
    return aggregate(
        store.append("staging", rest), ["airline"], {"n": "count(1)", "total": sql_round(f"sum({TOTAL})")}
    )


@query("sink_overwrite")
def sink_overwrite(spark, sf_dir):
    store = tables.Store(spark, new_path(spark, "overwrite"))
    rows = I.checked(spark, sf_dir).where("is_valid")
    store.overwrite("staging", I.first_extract(spark, sf_dir, rows).select("id", "airline", TOTAL))
    current = store.read("staging")
    again = store.overwrite("staging", current.where(f"{TOTAL} >= 50000"))  # reads what it replaces
    return aggregate(again, ["airline"], {"n": "count(1)", "total": sql_round(f"sum({TOTAL})")})


@query("layer_catalog")
def layer_catalog(spark, sf_dir):
    return tables.layer_catalog(
        spark,
        {
            ("bronze", "validated_flights"): I.validated(spark, sf_dir),
            ("silver", "silver_cleaned_flights"): I.silver(spark, sf_dir),
        },
    )


@query("dataset_metadata")
def dataset_metadata(spark, sf_dir):
    from fareloom.session import path_size

    path = _csv(spark, sf_dir)
    df = files.scan_csv(spark, path)
    counted = materialize(df.agg(F.count(F.lit(1)).alias("row_count")), "row-count")  # of the one file both rows describe
    first = tables.dataset_metadata(df, "bookings.csv", path_size(spark, path), [], None, I.FIRST_LOAD, counted)
    second = tables.dataset_metadata(
        df, "bookings.csv", path_size(spark, path), ["loyalty_tier"], first, I.SECOND_LOAD, counted
    )
    return first.unionByName(second).drop("file_size_bytes", "columns_json")


@query("schema_hash")
def schema_hash(spark, sf_dir):
    # the fingerprint of every given table's column names
    out = None
    for name in ("lineitem", "orders", "part", "supplier", "customer", "nation", "events"):
        df = src.table(spark, sf_dir, name)
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(name).alias("table_name"), files.schema_hash(df.columns).alias("schema_hash"), "row_count"
        )
        out = row if out is None else out.unionByName(row)
    return out


@query("schema_evolve")
def schema_evolve(spark, sf_dir):
    known = I.first_extract(spark, sf_dir).select("id", "airline", TOTAL)
    wider = I.second_extract(spark, sf_dir).select(
        "id", "airline", TOTAL,
        F.col("days_before_departure").cast("string").alias("lead_days"),
        F.col("tax_surcharge_bdt").cast("string").alias("surcharge"),
        F.col("stopovers").alias("stops_text"),
    )
    merged, added = files.schema_evolve(known, wider)
    kinds = F.lit(", ".join(f"{name} {kind}" for name, kind in added))
    return merged.groupBy("airline").agg(
        F.count(F.lit(1)).alias("n"), F.sum("lead_days").alias("lead_days"),
        F.sum("surcharge").cast("double").alias("surcharge"), F.count("stops_text").alias("stops"),
    ).withColumn("added", kinds)


# --- validation --------------------------------------------------------------------------------


def _dirty(spark, sf_dir) -> DataFrame:
    """All bookings, damaged by rule from their own values, so that every message occurs."""
    df = I.validated(spark, sf_dir).select("id", *src.FIELDS)
    hours, days = F.col("duration_hrs"), F.col("days_before_departure")
    return df.withColumns(
        {
            "airline": F.when(hours == 1, "  ").when(hours != 2, F.col("airline")),
            "source_code": F.when(hours == 3, F.concat(F.lit(" "), "source_code"))
            .when(hours != 4, F.col("source_code")),
            "base_fare_bdt": F.when(hours == 5, 0.0).otherwise(F.col("base_fare_bdt")),
            "total_fare_bdt": F.when(hours != 6, F.col(TOTAL)),
            "tax_surcharge_bdt": F.when(hours == 7, -1.0).when(hours != 8, F.col("tax_surcharge_bdt")),
            "duration_hrs": F.when(hours == 9, 0.0).when(hours != 10, hours),
            "days_before_departure": F.when(hours != 11, days),
        }
    )


@query("validate_rows")
def validate_rows(spark, sf_dir):
    return validate.validate_rows(_dirty(spark, sf_dir)).select("id", "is_valid", "validation_errors")


@query("validation_summary")
def validation_summary(spark, sf_dir):
    return validate.validation_summary(I.validated(spark, sf_dir))


@query("soft_rules")
def soft_rules(spark, sf_dir):
    return validate.soft_rules(I.valid(spark, sf_dir)).select("id", "validation_warnings")


@query("layer_counts")
def layer_counts(spark, sf_dir):
    s = I.silver(spark, sf_dir)
    return quality.layer_counts(
        {
            "bronze.validated_flights": I.bronze(spark, sf_dir),
            "silver.silver_cleaned_flights": s,
            "gold.gold_avg_fare_by_airline": gold.gold_avg_fare_by_airline(s),
        }
    )


@query("pass_rate")
def pass_rate(spark, sf_dir):
    return quality.pass_rate(I.validated(spark, sf_dir))


@query("dq_not_null")
def dq_not_null(spark, sf_dir):
    return quality.dq_not_null(_dirty(spark, sf_dir), "bookings", ["airline", "source_code", TOTAL, "tax_surcharge_bdt"])


@query("dq_unique")
def dq_unique(spark, sf_dir):
    items = src.table(spark, sf_dir, "lineitem").withColumn(
        "line", F.concat_ws("-", "l_orderkey", "l_linenumber")
    )
    return quality.dq_unique(I.silver(spark, sf_dir), "silver_cleaned_flights", "id").unionByName(
        quality.dq_unique(items, "lineitem", "line")
    )


@query("dq_accepted_values")
def dq_accepted_values(spark, sf_dir):
    s = I.silver(spark, sf_dir)
    return quality.dq_accepted_values(
        s, "silver_cleaned_flights", "route_type", ["Domestic", "International"]
    ).unionByName(
        quality.dq_accepted_values(s, "silver_cleaned_flights", "travel_class", ["Economy", "First"])
    )


@query("dq_silver")
def dq_silver(spark, sf_dir):
    return quality.dq_silver(I.silver(spark, sf_dir))


@query("dq_gold")
def dq_gold(spark, sf_dir):
    s = I.silver(spark, sf_dir)
    return quality.dq_gold({t: gold.GOLD_TABLES[t](s) for t in quality.GOLD_NOT_NULL})


@query("dq_report")
def dq_report(spark, sf_dir):
    return gold.gold_data_quality_report(I.silver(spark, sf_dir))


@query("dq_totals")
def dq_totals(spark, sf_dir):
    return quality.dq_totals(I.validated(spark, sf_dir), ["airline", "arrival_datetime", TOTAL])


# --- joins -------------------------------------------------------------------------------------


@query("staging_join")
def staging_join(spark, sf_dir):
    v = I.validated(spark, sf_dir)
    stamped = v.select("id", (F.col("departure_datetime")).alias("loaded_at"))
    checked = v.select(F.col("id").alias("raw_id"), "airline", TOTAL, "is_valid")
    return joins.staging_join(checked, stamped).select("raw_id", "airline", TOTAL, "loaded_at")


@query("join_new")
def join_new(spark, sf_dir):
    return incremental.new_rows(*I.loads(spark, sf_dir)).select("id", "record_hash", TOTAL)


@query("join_deleted")
def join_deleted(spark, sf_dir):
    return incremental.deleted_rows(*I.loads(spark, sf_dir)).select("id", "record_hash", TOTAL)


@query("join_unchanged")
def join_unchanged(spark, sf_dir):
    return incremental.unchanged_rows(*I.loads(spark, sf_dir)).select("id", "record_hash", TOTAL)


@query("join_scalar_cross")
def join_scalar_cross(spark, sf_dir):
    s = I.silver(spark, sf_dir).select("id", "airline", TOTAL)
    mean = aggregate(s, [], {"mean_fare": sql_round(f"avg({TOTAL})")})
    return joins.cross_one(s, mean).where(f"{TOTAL} > mean_fare * 1.9")


@query("enrich_left")
def enrich_left(spark, sf_dir):
    s = I.silver(spark, sf_dir)
    stats = [
        (gold.gold_avg_fare_by_airline(s), "airline"),
        (gold.gold_popular_routes(s), "route"),
        (gold.gold_seasonal_fare_analysis(s), "seasonality"),
        (gold.gold_fare_by_class(s), "travel_class"),
    ]
    stats = [(materialize(frame, "gold"), key) for frame, key in stats]
    out = joins.enrich_left(s.select("id", "airline", "route", "seasonality", "travel_class"), stats)
    return out.select(
        "id", "airline", "avg_total_fare", "market_share_pct", "popularity_rank", "most_common_airline",
        "pct_diff_from_regular", "class_share_pct", "total_bookings",
    )


@query("rank_merge")
def rank_merge(spark, sf_dir):
    v = I.valid(spark, sf_dir)
    left = profile.target_correlation(v, NUMBERS[:3], TOTAL).selectExpr("feature", "abs(r) AS importance")
    right = profile.target_correlation(v, NUMBERS[:3], "days_before_departure").selectExpr(
        "feature", "abs(r) AS importance"
    )
    return features.rank_merge(left, right)


@query("value_map")
def value_map(spark, sf_dir):
    s = I.silver(spark, sf_dir)
    busy = s.groupBy("route").agg(F.count(F.lit(1)).alias("route_count")).where("route_count >= 40")
    return joins.value_map(
        s.select("id", "route"), "route", materialize(busy, "routes"), "route_count", F.lit(1).cast("bigint")
    )


@query("skewed_lookup")
def skewed_lookup(spark, sf_dir):
    """The same join when the table is too large to broadcast: hot keys are salted."""
    s = I.silver(spark, sf_dir).select("id", "seasonality", TOTAL)
    means = aggregate(s, ["seasonality"], {"mean_fare": sql_round(f"avg({TOTAL})")})
    return joins.salted_join(s, means, "seasonality", "id")


# --- silver ------------------------------------------------------------------------------------

@query("silver_clean")
def silver_clean(spark, sf_dir):
    """From the given tables to silver, without any layer written before."""
    from fareloom.operators.validate import validate_rows as check

    bronze = incremental.to_bronze(check(I.raw(spark, sf_dir)).where("is_valid"), I.LOADED_AT)
    return silver.silver_clean(bronze, src.DOMESTIC, I.LOADED_AT).drop("silver_loaded_at", "ingestion_timestamp")


@query("silver_filter")
def silver_filter(spark, sf_dir):
    # cancelled bookings are inactive, and NULL where the class is not known
    flags = F.when(F.col("travel_class") != "biz", F.col("booking_source") != "Online Website")
    df = I.validated(spark, sf_dir).withColumn("is_active", flags)
    return silver.silver_filter(df).select("id", "travel_class", "booking_source")


@query("std_text")
def std_text(spark, sf_dir):
    # names with separators of all kinds, from the values at hand
    name = F.concat_ws("'", F.lower("airline"), "source_name", "aircraft_type", "booking_source")
    return I.validated(spark, sf_dir).select(
        "id", text.clean_name(name).alias("name"),
        text.clean_code(F.concat(F.lit(" "), F.lower("source_code"), F.lit(" "))).alias("code"),
    )


@query("route_key")
def route_key(spark, sf_dir):
    return I.validated(spark, sf_dir).select(
        "id",
        bands.route_key("source_code", F.when(F.col("seasonality") != "Hajj", F.col("destination_code")))
        .alias("route"),
    )


@query("time_parts")
def time_parts(spark, sf_dir):
    ts = F.when(F.col("seasonality") != "Hajj", F.col("departure_datetime"))
    return I.validated(spark, sf_dir).select(
        "id", F.year(ts).alias("departure_year"), F.month(ts).alias("departure_month"),
        bands.day_of_week(ts).alias("departure_day_of_week"), bands.day_type(ts).alias("departure_day_type"),
    )


@query("num_stops")
def num_stops(spark, sf_dir):
    stops = F.when(F.col("seasonality") == "Hajj", F.concat(F.lit("1"), "stopovers")).otherwise(F.col("stopovers"))
    return I.validated(spark, sf_dir).select(
        "id", stops.alias("stopovers"), bands.num_stops(stops).alias("num_stops")
    )


@query("class_norm")
def class_norm(spark, sf_dir):
    return I.validated(spark, sf_dir).select(
        "id", bands.class_name("travel_class").alias("travel_class"),
        bands.class_name("aircraft_type").alias("unknown_class"),
    )


@query("tax_pct")
def tax_pct(spark, sf_dir):
    base = F.when(F.col("duration_hrs") == 5, 0.0).otherwise(F.col("base_fare_bdt"))
    return I.validated(spark, sf_dir).select("id", bands.tax_percentage("tax_surcharge_bdt", base).alias("tax_percentage"))


@query("fare_band")
def fare_band(spark, sf_dir):
    total = F.when(F.col("duration_hrs") != 5, F.col(TOTAL))
    return I.validated(spark, sf_dir).select("id", bands.fare_band(total).alias("fare_category"))


def _seasons(spark, sf_dir):
    """More spellings than the bookings have, from their own columns."""
    season = (
        F.when(F.col("aircraft_type") == "ECONOMY", F.concat("seasonality", F.lit(" break")))
        .when(F.col("duration_hrs") == 1, "Ramadan")
        .when(F.col("duration_hrs") == 2, "Summer Holiday")
        .when(F.col("duration_hrs") == 3, "summer")
        .when(F.col("duration_hrs") == 4, " Regular")
        .when(F.col("duration_hrs") == 5, "Wine Festival")
        .when(F.col("duration_hrs") == 6, "School vacation")
        .when(F.col("duration_hrs") == 7, "Spring Holidays")
        .when(F.col("duration_hrs") == 8, "Off-Peak")
        .when(F.col("duration_hrs") == 10, "Winter")
        .when(F.col("duration_hrs") != 9, F.col("seasonality"))
    )
    return I.validated(spark, sf_dir).withColumn("seasonality", season)


@query("peak_flag")
def peak_flag(spark, sf_dir):
    return _seasons(spark, sf_dir).select("id", "seasonality", bands.is_peak("seasonality").alias("is_peak_season"))


@query("season_cat")
def season_cat(spark, sf_dir):
    return _seasons(spark, sf_dir).select("id", "seasonality", bands.season_category("seasonality").alias("season_category"))


@query("booking_window")
def booking_window(spark, sf_dir):
    days = F.when(F.col("duration_hrs") != 5, F.col("days_before_departure"))
    return I.validated(spark, sf_dir).select("id", bands.booking_window(days).alias("booking_window"))


@query("route_type")
def route_type(spark, sf_dir):
    origin = F.when(F.col("duration_hrs") == 5, F.lower("source_code")).when(
        F.col("duration_hrs") != 6, F.col("source_code")
    )
    return I.validated(spark, sf_dir).select(
        "id", bands.route_type(origin, "destination_code", src.DOMESTIC).alias("route_type")
    )


@query("lineage_cols")
def lineage_cols(spark, sf_dir):
    staged = I.valid(spark, sf_dir).withColumns(
        {"raw_id": F.col("id"), "validated_id": F.concat(F.lit("v"), "id"), "loaded_at": F.col("departure_datetime")}
    )
    return silver.silver_clean(incremental.to_bronze(staged, I.LOADED_AT), src.DOMESTIC, I.AS_OF).select(
        "id", "raw_id", "validated_id", "loaded_at", "record_hash", "ingestion_timestamp", "silver_loaded_at"
    )


@query("season_map")
def season_map(spark, sf_dir):
    return _seasons(spark, sf_dir).select("id", bands.scoring_season("seasonality").alias("season_category"))


@query("peak_keywords")
def peak_keywords(spark, sf_dir):
    return _seasons(spark, sf_dir).select("id", bands.is_peak_short("seasonality").alias("is_peak_season"))


@query("total_from_parts")
def total_from_parts(spark, sf_dir):
    total = F.when(F.col("duration_hrs") != 5, F.col(TOTAL))
    return I.validated(spark, sf_dir).select(
        "id", round_to(bands.total_from_parts(total, "base_fare_bdt", "tax_surcharge_bdt"), 2).alias(TOTAL)
    )


@query("bin_cut")
def bin_cut(spark, sf_dir):
    total = F.when(F.col("duration_hrs") == 5, 0.0).when(F.col("duration_hrs") == 6, 30000.0).otherwise(F.col(TOTAL))
    return I.validated(spark, sf_dir).select("id", bands.fare_cut(total).alias("fare_category"))


# --- aggregations ------------------------------------------------------------------------------

for _name, _build in gold.GOLD_TABLES.items():
    if _name != "gold_data_quality_report":
        QUERIES[_name] = lambda spark, sf_dir, build=_build: build(I.silver(spark, sf_dir))


@query("agg_filtered")
def agg_filtered(spark, sf_dir):
    return aggregate(
        I.silver(spark, sf_dir), ["source_code", "departure_year"],
        {
            "economy": sql_count("travel_class = 'Economy'"),
            "weekend": sql_count("departure_day_type = 'Weekend'"),
            "avg_short_notice": sql_round(sql_avg(TOTAL, "days_before_departure <= 30")),
        },
    )


@query("agg_percentile")
def agg_percentile(spark, sf_dir):
    wanted = {"p01": 0.01, "p25": 0.25, "p50": 0.5, "p75": 0.75, "p99": 0.99}
    keys = ["source_code", "travel_class"]
    return order_stats.percentiles(I.silver(spark, sf_dir), keys, TOTAL, wanted).select(
        *keys, *[round_to(c, 2).alias(c) for c in wanted]
    )


@query("agg_stddev")
def agg_stddev(spark, sf_dir):
    return aggregate(
        I.silver(spark, sf_dir), ["route", "airline"], {"fare_std_dev": sql_round(f"stddev_samp({TOTAL})")}
    )


@query("agg_mode")
def agg_mode(spark, sf_dir):
    return order_stats.modes(I.silver(spark, sf_dir), ["route"], "airline", "most_common_airline")


@query("peak_premium")
def premium(spark, sf_dir):
    return I.silver(spark, sf_dir).groupBy("source_code", "booking_window").agg(
        round_to(peak_premium(TOTAL, "is_peak_season"), 2).alias("peak_premium_pct")
    )


@query("share_of_total")
def share_of_total(spark, sf_dir):
    s = I.silver(spark, sf_dir)
    groups = s.groupBy("aircraft_type", "booking_source").agg(F.count(F.lit(1)).alias("n"))
    return gold.with_share(groups, s, "n", "share_pct")


@query("group_stats")
def group_stats(spark, sf_dir):
    return profile.all_group_stats(
        I.silver(spark, sf_dir), ["airline", "route", "seasonality", "travel_class"], TOTAL
    )


@query("peak_stats")
def peak_stats(spark, sf_dir):
    return profile.peak_stats(I.silver(spark, sf_dir), TOTAL)


@query("pivot_premium")
def pivot_premium(spark, sf_dir):
    return profile.pivot_premium(I.silver(spark, sf_dir), "airline", TOTAL)


@query("value_counts_topn")
def value_counts_topn(spark, sf_dir):
    return profile.value_counts_topn(I.silver(spark, sf_dir), [*TEXTS, "route"], 10)


@query("argmax_group")
def argmax_group(spark, sf_dir):
    return profile.argmax_group(I.silver(spark, sf_dir), "route", TOTAL)


@query("metadata_count")
def metadata_count(spark, sf_dir):
    """Rows of a layer with the change reported by its last load."""
    last = tables.latest_row(I.load_log(spark, sf_dir), "load_timestamp")
    rows = I.silver(spark, sf_dir).agg(F.count(F.lit(1)).alias("total_records"))
    return joins.cross_one(rows, last).selectExpr(
        "'silver' AS layer", "total_records", "records_inserted AS new_records", "change_percentage",
        "load_timestamp AS latest_update", "total_records > 0 AS has_changes",
    )


@query("revenue_metrics")
def revenue_metrics(spark, sf_dir):
    return gold.revenue_metrics(I.silver(spark, sf_dir))


# --- windows -----------------------------------------------------------------------------------


def _history(spark, sf_dir, summary, key, checks, hard_deletes):
    """The history after two snapshot runs; the first is written on first use."""
    def first():
        ledger = Ledger(spark, new_path(spark, "history"))
        commit = ledger.begin()
        scd.merge_into(commit, key, summary(I.silver_extracts(spark, sf_dir)[0]), key, checks, I.FIRST_LOAD)
        commit.finish()
        return ledger

    commit = _memo(spark, sf_dir, f"history-{key}", first).begin()
    scd.merge_into(commit, key, summary(I.silver_extracts(spark, sf_dir)[1]), key, checks, I.SECOND_LOAD, hard_deletes)
    return commit.read(key)


def fare_versions(spark, sf_dir):
    return _history(spark, sf_dir, scd.scd_fare_summary, "fare_key", scd.FARE_CHECKS, True)


def route_versions(spark, sf_dir):
    return _history(spark, sf_dir, scd.scd_route_summary, "route_key", scd.ROUTE_CHECKS, False)


@query("win_row_number")
def win_row_number(spark, sf_dir):
    return scd.fare_history(fare_versions(spark, sf_dir), I.AS_OF).select("fare_key", "valid_from", "version_number")


@query("win_count")
def win_count(spark, sf_dir):
    return scd.fare_history(fare_versions(spark, sf_dir), I.AS_OF).select("fare_key", "valid_from", "total_versions")


@query("win_rank")
def win_rank(spark, sf_dir):
    groups = I.silver(spark, sf_dir).groupBy("route", "airline").agg(F.count(F.lit(1)).alias("n"))
    return order_stats.with_rank(groups, "n", "popularity_rank", counts=True)


@query("win_total")
def win_total(spark, sf_dir):
    s = I.silver(spark, sf_dir)
    groups = s.groupBy("route").agg(F.count(F.lit(1)).alias("n"))
    total = s.agg(F.count(F.lit(1)).alias("all_bookings"))
    return joins.cross_one(groups, total)


@query("rank_avg")
def rank_avg(spark, sf_dir):
    s = I.silver(spark, sf_dir)
    return order_stats.with_rank(s.select("id", "tax_percentage"), "tax_percentage", "tax_rank", "average")


# --- incremental load and history --------------------------------------------------------------


@query("record_hash")
def record_hash(spark, sf_dir):
    return incremental.with_hash(I.validated(spark, sf_dir)).select("id", "record_hash")


@query("detect_changes")
def detect_changes(spark, sf_dir):
    status = incremental.hash_status(*I.loads(spark, sf_dir))
    return status.groupBy("status").agg(
        F.count(F.lit(1)).alias("hashes"), F.sum("incoming_rows").alias("incoming_rows"),
        F.sum("existing_rows").alias("existing_rows"),
    )


@query("change_pct")
def change_pct(spark, sf_dir):
    stats = incremental.change_stats(*I.loads(spark, sf_dir))
    return stats.withColumn("change_percentage", round_to("change_percentage", 4))


@query("load_mode")
def load_mode(spark, sf_dir):
    out = None
    for name, second in (("second", I.second_extract), ("reload", I.reload_extract)):
        stats = incremental.change_stats(*I.loads(spark, sf_dir, second)).select(
            F.lit(name).alias("extract"), round_to("change_percentage", 4).alias("change_percentage"), "load_type"
        )
        out = stats if out is None else out.unionByName(stats)
    return out


def _first_load(spark, sf_dir):
    """A ledger whose bronze holds the first extract, written on first use; commits that are not finished leave it so."""
    def run():
        ledger = Ledger(spark, new_path(spark, "bronze"))
        commit = ledger.begin()
        incremental.load_into(commit, "bronze", incremental.with_hash(I.first_extract(spark, sf_dir, I.valid_rows(spark, sf_dir))), I.FIRST_LOAD, "FULL")
        commit.finish()
        return ledger

    return _memo(spark, sf_dir, "first_load", run)


def _second_load(spark, sf_dir, extract, mode):
    commit = _first_load(spark, sf_dir).begin()
    incremental.load_into(commit, "bronze", incremental.with_hash(extract(spark, sf_dir, I.valid_rows(spark, sf_dir))), I.SECOND_LOAD, mode)
    return commit.read("bronze").select("id", "record_hash", TOTAL, "is_active", "ingestion_timestamp")


@query("apply_incremental")
def apply_incremental(spark, sf_dir):
    return _second_load(spark, sf_dir, I.second_extract, "INCREMENTAL")


@query("apply_full")
def apply_full(spark, sf_dir):
    return _second_load(spark, sf_dir, I.reload_extract, "FULL")


@query("load_log")
def load_log(spark, sf_dir):
    store = tables.Store(spark, new_path(spark, "load_log"))
    for load_id, (second, at) in enumerate(
        [(I.second_extract, I.FIRST_LOAD), (I.reload_extract, I.SECOND_LOAD)], start=1
    ):
        stats = incremental.change_stats(*I.loads(spark, sf_dir, second))
        store.append("log", incremental.load_log_row(stats, load_id, at, "bookings.csv"))
    return store.read("log")


@query("load_stats")
def load_stats(spark, sf_dir):
    return incremental.load_stats(I.load_log(spark, sf_dir, I.checked(spark, sf_dir)), I.AS_OF, days=365)


@query("process_gate")
def process_gate(spark, sf_dir):
    last = tables.latest_row(I.load_log(spark, sf_dir, I.checked(spark, sf_dir)), "load_timestamp")
    return incremental.process_gate(last)


@query("retrain_gate")
def retrain_gate(spark, sf_dir):
    last = tables.latest_row(I.load_log(spark, sf_dir), "load_timestamp")
    model = tables.latest_row(I.model_history(spark, sf_dir).where("is_production"), "training_timestamp")
    return incremental.retrain_gate(last, model, I.AS_OF)


@query("scd_fare_summary")
def scd_fare_summary(spark, sf_dir):
    return scd.scd_fare_summary(I.silver(spark, sf_dir))


@query("scd_route_summary")
def scd_route_summary(spark, sf_dir):
    return scd.scd_route_summary(I.silver(spark, sf_dir))


@query("scd2_merge")
def scd2_merge(spark, sf_dir):
    return fare_versions(spark, sf_dir)


@query("scd2_merge_route")
def scd2_merge_route(spark, sf_dir):
    return route_versions(spark, sf_dir)


@query("fare_history")
def fare_history(spark, sf_dir):
    return scd.fare_history(fare_versions(spark, sf_dir), I.AS_OF)


@query("route_history")
def route_history(spark, sf_dir):
    return scd.route_history(route_versions(spark, sf_dir))


@query("history_change")
def history_change(spark, sf_dir):
    return scd.history_change(route_versions(spark, sf_dir), "route_key", "avg_fare")


# --- sorts, limits, set operations -------------------------------------------------------------


@query("sort_output")
def sort_output(spark, sf_dir):
    return gold.sort_output(gold.gold_booking_count_by_airline(I.silver(spark, sf_dir)))


@query("latest_row")
def latest_row(spark, sf_dir):
    return tables.latest_row(I.model_history(spark, sf_dir).where("is_production"), "training_timestamp")


@query("topk_groups")
def topk_groups(spark, sf_dir):
    s = I.silver(spark, sf_dir)
    return profile.topk_groups(s, "route", TOTAL, "avg_fare").withColumn("list", F.lit("dearest")).unionByName(
        profile.topk_groups(s, "route", TOTAL, "booking_count").withColumn("list", F.lit("busiest"))
    )


@query("union_all")
def union_all(spark, sf_dir):
    s = I.silver(spark, sf_dir)
    return quality.union_all(
        *[
            s.groupBy(F.col(c).alias("field_value")).agg(F.count(F.lit(1)).alias("n")).withColumn("field", F.lit(c))
            for c in ("travel_class", "booking_source", "stopovers", "seasonality")
        ]
    )


def _two_hashes(spark, sf_dir):
    incoming, bronze = I.loads(spark, sf_dir)
    return incoming.select("record_hash"), bronze.select("record_hash")


@query("set_difference")
def set_difference(spark, sf_dir):
    new, old = _two_hashes(spark, sf_dir)
    return new.subtract(old)


@query("set_intersection")
def set_intersection(spark, sf_dir):
    new, old = _two_hashes(spark, sf_dir)
    return new.intersect(old)


# --- profiling ---------------------------------------------------------------------------------


@query("profile_columns")
def profile_columns(spark, sf_dir):
    return profile.profile_columns(_dirty(spark, sf_dir)).drop("dtype")


@query("profile_increments")
def profile_increments(spark, sf_dir):
    """The bookings as two loads, each sketched alone, profiled from the merged sketches; estimates against exact values."""
    df = I.validated(spark, sf_dir)
    parts = [df.where(F.col("departure_datetime").isNull() | (F.col("departure_datetime") < I.FIRST_CUT)), df.where(F.col("departure_datetime") >= I.FIRST_CUT)]
    got = sketches.profile(sketches.merged(*[sketches.sketch(p, NUMBERS) for p in parts]))
    values = order_stats.unpivot(df, NUMBERS, "double").where("value IS NOT NULL").groupBy("column_name", "value").agg(F.count(F.lit(1)).alias("n"))
    near = F.broadcast(got.select("column_name", F.col("q50").alias("m")))  # a row a column
    exact = values.join(near, "column_name").groupBy("column_name").agg(
        F.count("value").alias("exact"), F.sum("n").alias("all"),
        F.sum(F.when(F.col("value") < F.col("m"), F.col("n")).otherwise(0)).alias("below"), F.sum(F.when(F.col("value") <= F.col("m"), F.col("n")).otherwise(0)).alias("upto"),
    )
    half, off = F.col("all") / 2, 2 * sketches.RANK_ERROR * F.col("all") + 1
    return got.join(exact, "column_name").select(
        "column_name", "row_count", "null_count", "null_pct", round_to("least", 2).alias("least"), round_to("greatest", 2).alias("greatest"),
        (F.abs(F.col("unique_values") / F.col("exact") - 1) <= 0.05).alias("distinct_within_bound"),
        ((F.col("below") - off <= half) & (half <= F.col("upto") + off)).alias("median_within_bound"),
    )


@query("describe")
def describe(spark, sf_dir):
    return profile.describe(I.validated(spark, sf_dir), NUMBERS)


@query("positive_filter")
def positive_filter(spark, sf_dir):
    return profile.positive_filter(_dirty(spark, sf_dir), "base_fare_bdt").select("id", "base_fare_bdt")


def _gaps(spark, sf_dir):
    """Bookings with gaps: fares of one season, classes of one source, one empty column."""
    return I.validated(spark, sf_dir).select(
        "id",
        F.when(F.col("seasonality") != "Hajj", F.col(TOTAL)).alias(TOTAL),
        F.when(F.col("duration_hrs") <= 40, F.col("duration_hrs")).alias("duration_hrs"),
        F.col("base_fare_bdt"),
        F.lit(None).cast("double").alias("empty_number"),
        F.when(F.col("booking_source") != "Online Website", F.col("travel_class")).alias("travel_class"),
        F.lit(None).cast("string").alias("empty_text"),
    )


@query("impute_median")
def impute_median(spark, sf_dir):
    df = _gaps(spark, sf_dir)
    columns = [TOTAL, "duration_hrs", "base_fare_bdt", "empty_number"]
    return profile.impute_median(df, columns).select("id", *[round_to(c, 2).alias(c) for c in columns])


@query("impute_mode")
def impute_mode(spark, sf_dir):
    columns = ["travel_class", "empty_text"]
    return profile.impute_mode(_gaps(spark, sf_dir), columns).select("id", *columns)


@query("iqr_outliers")
def iqr_outliers(spark, sf_dir):
    # prices per hour have a long tail
    rate = I.valid(spark, sf_dir).select(round_to(F.col(TOTAL) / F.col("duration_hrs"), 2).alias("rate"))
    return profile.iqr_outliers(rate, "rate")


@query("histogram")
def histogram(spark, sf_dir):
    return profile.histogram(I.valid(spark, sf_dir), TOTAL, 50)


@query("box_stats")
def box_stats(spark, sf_dir):
    rate = I.valid(spark, sf_dir).select(
        "airline", round_to(F.col(TOTAL) / F.col("duration_hrs"), 2).alias("rate")
    )
    return profile.box_stats(rate, "airline", "rate")


@query("corr_matrix")
def corr_matrix(spark, sf_dir):
    return profile.corr_matrix(I.valid(spark, sf_dir), NUMBERS)


@query("target_correlation")
def target_correlation(spark, sf_dir):
    return profile.target_correlation(I.valid(spark, sf_dir), [c for c in NUMBERS if c != TOTAL], TOTAL)


@query("insights")
def insights(spark, sf_dir):
    return profile.insights(I.silver(spark, sf_dir), TOTAL)


# --- audit -------------------------------------------------------------------------------------


@query("audit_log")
def audit_log(spark, sf_dir):
    """The run log, written task by task and read back."""
    store = tables.Store(spark, new_path(spark, "audit_store"))
    rows = I.audit(spark, sf_dir)
    for status in ("started", "completed", "failed"):
        store.append("audit_log", rows.where(F.col("status") == status))
    return store.read("audit_log")


@query("audit_recent")
def audit_recent(spark, sf_dir):
    return audit.audit_recent(I.audit(spark, sf_dir))


@query("audit_failed")
def audit_failed(spark, sf_dir):
    return audit.audit_failed(I.audit(spark, sf_dir))


@query("audit_avg_duration")
def audit_avg_duration(spark, sf_dir):
    return audit.audit_avg_duration(I.audit(spark, sf_dir))


@query("change_level")
def change_level(spark, sf_dir):
    return audit.change_levels(I.load_log(spark, sf_dir))


# --- features and models -----------------------------------------------------------------------

_fitted: dict = {}


def _memo(spark, sf_dir, name, build):
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _fitted:
        _fitted[key] = build()
    return _fitted[key]


def prepared(spark, sf_dir):
    """(feature table, fitted features), written on first use."""
    return _memo(spark, sf_dir, "prepared", lambda: training.prepare(I.silver(spark, sf_dir)))


def _data(spark, sf_dir):
    table, fitted = prepared(spark, sf_dir)
    return models.assemble(table, fitted.feature_names), fitted.feature_names


def _vectors(spark, sf_dir):
    """The training rows folded for the trees and ensembles, or None, on first use."""
    return _memo(spark, sf_dir, "vectors", lambda: models.folded(_data(spark, sf_dir)[0].where("NOT is_test")))


def _tree_grid(spark, sf_dir):
    return _memo(spark, sf_dir, "tree_grid", lambda: models.tree_grid_search(_data(spark, sf_dir)[0]))


def _model(spark, sf_dir, name, **params):
    """A model fitted to the training rows, a tree with the depth and split size of its grid; later queries use the fitted one."""

    def fit():
        train, linear = _data(spark, sf_dir)[0].where("NOT is_test"), name in models.LINEAR_KINDS
        vectors = None if linear else _vectors(spark, sf_dir)
        kept = models.spread(train) if vectors is None and not linear else train
        if name == "decision_tree":
            model = models.tuned_tree(_tree_grid(spark, sf_dir), kept, vectors)
        else:
            model = models.fit(name, kept, vectors, **params)
        if kept is not train:
            kept.unpersist()
        return model

    return _memo(spark, sf_dir, name, fit)


def _importance(spark, sf_dir):
    """Importances of the full forest, fitted on first use."""
    def fit():
        data, names = _data(spark, sf_dir)
        return materialize(models.importance_forest(data, names), "importance")

    return _memo(spark, sf_dir, "importance", fit)


@query("route_popularity")
def route_popularity(spark, sf_dir):
    out = features.popularity_feature(I.silver(spark, sf_dir).select("id", "route"))
    return out.withColumn("route_popularity_log", round_to("route_popularity_log", 6))


@query("peak_numeric")
def peak_numeric(spark, sf_dir):
    flag = F.when(F.col("travel_class") != "First", F.col("is_peak_season"))
    df = I.silver(spark, sf_dir).select("id", flag.alias("is_peak_season"))
    return features.peak_numeric(df)


@query("label_encode")
def label_encode(spark, sf_dir):
    df = I.silver(spark, sf_dir).select(
        "id", "route", F.when(F.col("airline") != "Brand#7", F.col("airline")).alias("airline"),
        "is_peak_season",
    )
    return features.label_encode(df, ["airline", "route", "is_peak_season"])


@query("scale_std")
def scale_std(spark, sf_dir):
    columns = ["duration_hrs", "base_fare_bdt", "constant"]
    df = I.silver(spark, sf_dir).select("id", "duration_hrs", "base_fare_bdt", F.lit(3.0).alias("constant"))
    return features.scale_std(df, columns).select("id", *[round_to(c, 6).alias(c) for c in columns])


@query("final_fill")
def final_fill(spark, sf_dir):
    df = _gaps(spark, sf_dir).drop("travel_class", "empty_text")
    return features.final_fill(df, features.column_medians(df, features.number_columns(df)))


@query("feature_matrix")
def feature_matrix(spark, sf_dir):
    frame = features.training_frame(I.silver(spark, sf_dir))
    out = features.fit_features(frame).transform(frame)
    scaled = ["route_popularity", "route_popularity_log", "is_peak_season_numeric"]
    return out.withColumns({c: round_to(c, 6) for c in scaled})


@query("feature_importance_rf")
def feature_importance_rf(spark, sf_dir):
    return _importance(spark, sf_dir)


@query("feature_importance_mi")
def feature_importance_mi(spark, sf_dir):
    columns = ["duration_hrs", "base_fare_bdt", "days_before_departure", "num_stops"]
    return features.mutual_information(I.silver(spark, sf_dir), columns, TOTAL)


@query("select_top_features")
def select_top_features(spark, sf_dir):
    table, fitted = prepared(spark, sf_dir)
    information = features.mutual_information(table, fitted.feature_names, TOTAL)
    return features.select_top_features(_importance(spark, sf_dir), information)


@query("train_test_split")
def train_test_split(spark, sf_dir):
    return models.train_test_split(I.silver(spark, sf_dir).select("id")).groupBy("is_test").agg(
        F.count(F.lit(1)).alias("n")
    )


def _weights(spark, sf_dir, estimator, names):
    data = models.assemble(I.silver(spark, sf_dir).select(*names, TOTAL), names)
    model = estimator(data).fit(data)
    values = [*zip(names, [float(w) for w in model.coefficients]), ("intercept", float(model.intercept))]
    df = spark.createDataFrame(values, "feature string, weight double")
    return df.withColumn("weight", round_to("weight", 4))


@query("train_linear")
def train_linear(spark, sf_dir):
    return _weights(spark, sf_dir, models.linear, ["duration_hrs", "days_before_departure"])


@query("train_ridge")
def train_ridge(spark, sf_dir):
    # a strong penalty, so that it shows
    return _weights(spark, sf_dir, lambda d: models.ridge(d, 1e6), ["duration_hrs", "days_before_departure"])


@query("train_lasso")
def train_lasso(spark, sf_dir):
    return _weights(spark, sf_dir, lambda d: models.lasso(d, 1e5), ["duration_hrs"])


@query("train_tree")
def train_tree(spark, sf_dir):
    data, _ = _data(spark, sf_dir)
    return models.evaluate("decision_tree", _model(spark, sf_dir, "decision_tree"), data)


@query("train_rf")
def train_rf(spark, sf_dir):
    data, _ = _data(spark, sf_dir)
    return models.evaluate("random_forest", _model(spark, sf_dir, "random_forest"), data)


@query("train_gbt")
def train_gbt(spark, sf_dir):
    data, _ = _data(spark, sf_dir)
    return models.evaluate("gradient_boosting", _model(spark, sf_dir, "gradient_boosting"), data)


@query("grid_search")
def grid_search(spark, sf_dir):
    table, fitted = prepared(spark, sf_dir)
    return models.grid_search(table, fitted.feature_names)


@query("grid_search_tree")
def grid_search_tree(spark, sf_dir):
    return _tree_grid(spark, sf_dir)


@query("reg_sweep")
def reg_sweep(spark, sf_dir):
    table, fitted = prepared(spark, sf_dir)
    return models.reg_sweep(table, fitted.feature_names)


@query("depth_sweep")
def depth_sweep(spark, sf_dir):
    return models.depth_sweep(_data(spark, sf_dir)[0])


@query("cv_scores")
def cv_scores(spark, sf_dir):
    table, fitted = prepared(spark, sf_dir)
    return models.cv_scores(table, fitted.feature_names)


def _class_mean(spark, sf_dir):
    """Bookings with the average fare of their class as forecast."""
    s = I.silver(spark, sf_dir).select("id", "travel_class", F.col(TOTAL).alias("label"))
    means = aggregate(s, ["travel_class"], {"prediction": sql_round("avg(label)")})
    return joins.salted_join(s, means, "travel_class", "id")


@query("reg_metrics")
def reg_metrics(spark, sf_dir):
    return models.reg_metrics(_class_mean(spark, sf_dir))


@query("residuals")
def residuals(spark, sf_dir):
    out = models.residuals(_class_mean(spark, sf_dir))
    return out.select("id", "label", "prediction", round_to("residual", 2).alias("residual"))


def _fitted_all(spark, sf_dir) -> dict:
    return {name: _model(spark, sf_dir, name) for name in models.MODELS}


def _leaderboard(spark, sf_dir):
    def run():
        board = models.evaluate_all(_fitted_all(spark, sf_dir), _data(spark, sf_dir)[0])
        return materialize(board.orderBy(F.col("test_r2").desc(), "model_name"), "leaderboard")

    return _memo(spark, sf_dir, "leaderboard", run)


@query("leaderboard")
def leaderboard(spark, sf_dir):
    return _leaderboard(spark, sf_dir).orderBy(F.col("test_r2").desc(), "model_name")


@query("best_model")
def best_model(spark, sf_dir):
    return models.best_model(_leaderboard(spark, sf_dir))


@query("coefficients")
def coefficients(spark, sf_dir):
    return models.coefficients(spark, _model(spark, sf_dir, "lasso"), _data(spark, sf_dir)[1])


@query("importances")
def importances(spark, sf_dir):
    return models.importances(spark, _model(spark, sf_dir, "decision_tree"), _data(spark, sf_dir)[1])


@query("variance_explained")
def variance_explained(spark, sf_dir):
    return models.variance_explained(_leaderboard(spark, sf_dir))


@query("model_history")
def model_history(spark, sf_dir):
    """History rows of two training runs with selection, saved model and cross-validation of the best: one of all models and one of
    the linear regression, which is in production only if it is no worse."""
    table, fitted = prepared(spark, sf_dir)
    best = training.chosen(table, fitted.feature_names, _importance(spark, sf_dir))
    selected = [name for name in fitted.feature_names if name in best]
    if selected == fitted.feature_names:  # all of them, as long as they are no more than the selection takes
        board, models_of = _leaderboard(spark, sf_dir), _fitted_all(spark, sf_dir)
    else:
        board, models_of = models.train_all(models.assemble(table, selected))
    path, rows = new_path(spark, "models"), []
    for at, of_run in ((I.FIRST_LOAD, board), (I.SECOND_LOAD, board.where("model_name = 'linear_regression'"))):
        row, _ = training.describe(table, fitted, selected, of_run, models_of, at, f"{path}/{at.replace(' ', 'T').replace(':', '-')}", *rows)
        rows.append(materialize(row, "history"))
    return rows[0].unionByName(rows[1])


@query("model_status")
def model_status(spark, sf_dir):
    last = tables.latest_row(I.model_history(spark, sf_dir).where("is_production"), "training_timestamp")
    return models.model_status(last)


@query("score_interval")
def score_interval(spark, sf_dir):
    scored = score.with_interval(_class_mean(spark, sf_dir), rmse=31000.0)
    return scored.select("id", "predicted_fare_bdt", "interval_lower", "interval_upper")


def _requests(spark, sf_dir):
    """All bookings as scoring requests, those of one airline under a name not seen in training."""
    return I.silver(spark, sf_dir).select(
        "id", F.when(F.col("airline") == "Brand#7", "New Airline").otherwise(F.col("airline")).alias("airline"),
        "source_code", "destination_code", "travel_class", "seasonality", "is_peak_season",
    )


@query("batch_score")
def batch_score(spark, sf_dir):
    _, fitted = prepared(spark, sf_dir)
    requests = score.request_frame(_requests(spark, sf_dir), src.DOMESTIC)
    return score.batch_score(
        requests, fitted, _model(spark, sf_dir, "ridge"), fitted.feature_names, 31000.0, "ridge"
    )


# --- streams -----------------------------------------------------------------------------------


@query("stream_ingest")
def stream_ingest(spark, sf_dir):
    """Both extracts dropped as folders of several gzipped CSV files, and streamed into bronze."""
    headers = {field: header for header, field in fixed.CSV_HEADERS.items()}
    drop = new_path(spark, "drop")
    for extract in (I.first_extract, I.second_extract):
        rows = extract(spark, sf_dir, I.valid_rows(spark, sf_dir))
        pieces = max(3, input_size(rows) // DROP_BYTES)
        with freeing(spark):
            rows.select(*src.FIELDS).repartition(pieces, *src.FIELDS).withColumnsRenamed(headers).write.options(
                header=True, timestampNTZFormat="yyyy-MM-dd HH:mm:ss", ignoreLeadingWhiteSpace=False,
                ignoreTrailingWhiteSpace=False, compression="gzip",
            ).csv(f"{drop}/{extract.__name__}")
        ingest.announce(spark, drop, extract.__name__)
    ledger = Ledger(spark, new_path(spark, "stream_store"))
    stamps = [I.FIRST_LOAD, I.SECOND_LOAD]
    run = ingest.stream_ingest(spark, drop, ledger, new_path(spark, "stream_state"), lambda i: stamps[i])
    run.awaitTermination()
    return ledger.read(load.BRONZE).select("record_hash", TOTAL, "is_active", "ingestion_timestamp")


@query("stream_score")
def stream_score(spark, sf_dir):
    """The scoring requests as a stream; the result is that of ``batch_score``."""
    _, fitted = prepared(spark, sf_dir)
    stored = new_path(spark, "requests")
    score.request_frame(_requests(spark, sf_dir), src.DOMESTIC).write.parquet(stored)
    requests = spark.readStream.schema(spark.read.parquet(stored).schema).parquet(stored)
    scored = ingest.stream_score(
        requests, fitted, _model(spark, sf_dir, "ridge"), fitted.feature_names, 31000.0
    )
    out = new_path(spark, "scores")
    run = (
        scored.writeStream.format("parquet").option("path", out)
        .option("checkpointLocation", new_path(spark, "score_state")).trigger(availableNow=True).start()
    )
    run.awaitTermination()
    return spark.read.parquet(out)
