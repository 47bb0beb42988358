"""The cleaned, enriched booking table: one projection over the valid, active bronze rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions import bands, fixed
from fareloom.functions.text import clean_code, clean_name

LINEAGE = ("raw_id", "validated_id", "loaded_at", "bronze_loaded_at", "record_hash", "ingestion_timestamp")


def silver_filter(bronze: DataFrame) -> DataFrame:
    return bronze.where("is_valid AND is_active")


def silver_clean(bronze: DataFrame, domestic=fixed.DOMESTIC_CODES, loaded_at=None) -> DataFrame:
    """Clean and enrich. Columns a newer source has added are passed through at the end."""
    src, dst = clean_code("source_code"), clean_code("destination_code")
    ts = "departure_datetime"
    columns = {
        "id": F.col("id"),
        "airline": clean_name("airline"),
        "source_code": src,
        "source_name": clean_name("source_name"),
        "destination_code": dst,
        "destination_name": clean_name("destination_name"),
        "route": bands.route_key(src, dst),
        "departure_datetime": F.col(ts),
        "arrival_datetime": F.col("arrival_datetime"),
        "duration_hrs": F.col("duration_hrs"),
        "departure_year": F.year(ts),
        "departure_month": F.month(ts),
        "departure_day_of_week": bands.day_of_week(ts),
        "departure_day_type": bands.day_type(ts),
        "stopovers": F.col("stopovers"),
        "num_stops": bands.num_stops("stopovers"),
        "aircraft_type": F.col("aircraft_type"),
        "travel_class": bands.class_name("travel_class"),
        "booking_source": F.col("booking_source"),
        "base_fare_bdt": F.col("base_fare_bdt"),
        "tax_surcharge_bdt": F.col("tax_surcharge_bdt"),
        "total_fare_bdt": F.col("total_fare_bdt"),
        "tax_percentage": bands.tax_percentage("tax_surcharge_bdt", "base_fare_bdt"),
        "fare_category": bands.fare_band("total_fare_bdt"),
        "seasonality": F.col("seasonality"),
        "is_peak_season": bands.is_peak("seasonality"),
        "season_category": bands.season_category("seasonality"),
        "days_before_departure": F.col("days_before_departure"),
        "booking_window": bands.booking_window("days_before_departure"),
        "route_type": bands.route_type("source_code", "destination_code", domestic),
    }
    lineage = [c for c in LINEAGE if c in bronze.columns]
    internal = {"is_valid", "is_active", "validation_errors", "metadata_id", "source_file"}
    extra = [c for c in bronze.columns if c not in columns and c not in lineage and c not in internal]
    stamp = F.current_timestamp().cast("timestamp_ntz") if loaded_at is None else F.lit(loaded_at).cast("timestamp_ntz")
    return silver_filter(bronze).select(
        *[c.alias(name) for name, c in columns.items()],
        *lineage,
        *extra,
        stamp.alias("silver_loaded_at"),
    )
