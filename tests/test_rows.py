"""Validation and the derived columns, branch by branch."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from fareloom.functions import bands, text
from fareloom.operators.incremental import to_bronze
from fareloom.operators.silver import silver_clean, silver_filter
from fareloom.operators.validate import soft_rules, validate_rows, validation_summary

AT = "2025-01-01 00:00:00"


@pytest.mark.parametrize(
    "given, errors",
    [
        ({}, None),
        ({"airline": None}, "airline is required"),
        ({"airline": " \t"}, "airline is required"),
        ({"source_code": None}, "source_code is required; source_code must be 3 characters"),
        ({"source_code": " DAC"}, "source_code must be 3 characters"),
        ({"base_fare_bdt": 0.0}, "base_fare_bdt must be positive"),
        ({"total_fare_bdt": None}, "total_fare_bdt must be positive"),
        ({"tax_surcharge_bdt": -1.0}, "tax_surcharge_bdt cannot be negative"),
        ({"tax_surcharge_bdt": 0.0}, None),
        ({"tax_surcharge_bdt": None}, "tax_surcharge_bdt cannot be negative"),
        ({"duration_hrs": 0.0}, "duration_hrs must be positive"),
        ({"days_before_departure": 0}, "days_before_departure must be at least 1"),
        (
            {"airline": "", "base_fare_bdt": -5.0, "destination_code": "XXXX", "days_before_departure": None},
            "airline is required; base_fare_bdt must be positive; destination_code must be 3 characters; "
            "days_before_departure must be at least 1",
        ),
    ],
)
def test_validation(make, given, errors):
    row = validate_rows(make(given)).first()
    assert row["validation_errors"] == errors
    assert row["is_valid"] is (errors is None)


def test_validation_summary_and_empty(make):
    df = validate_rows(make({}, {"airline": None}, {}))
    assert validation_summary(df).first().asDict() == {
        "total_rows": 3, "valid_rows": 2, "invalid_rows": 1, "validation_rate": 66.67,
    }
    assert validation_summary(df.limit(0)).first()["validation_rate"] is None


def test_soft_rules(make):
    row = soft_rules(make({"seasonality": "Monsoon", "days_before_departure": 400})).first()
    assert row["validation_warnings"] == (
        "seasonality has an unexpected value; days_before_departure is above 365"
    )


def column(spark, values, kind, expression):
    df = spark.createDataFrame([(v,) for v in values], f"v {kind}")
    return [r[0] for r in df.select(expression).collect()]


def test_title_words(spark):
    given = ["us-bangla AIRLINES", "o'neil air2air", "  x  y ", "ÉCOLE d'été", "a_b\tc.d", None]
    want = ["Us-Bangla Airlines", "O'Neil Air2air", "X  Y", "École D'Été", "A_B\tC.D", None]
    assert column(spark, given, "string", text.clean_name("v")) == want


def test_class_names(spark):
    given = ["biz", "1ST CLASS", "  coach ", "premium eco", "sleeper-suite", None]
    want = ["Business", "First", "Economy", "Premium Economy", "Sleeper-Suite", None]
    assert column(spark, given, "string", bands.class_name("v")) == want


def test_stops(spark):
    given = ["Direct", "direct", "1 Stop", "12 stops", "2 Stops", None]
    assert column(spark, given, "string", bands.num_stops("v")) == [0, None, 1, 1, 2, None]


def test_seasons(spark):
    given = ["Regular", " Regular", "REGULAR", "Winter Holidays", "Eid ul-Fitr", "Ramadan", "Summer",
             "Summer Holiday", "Holi", "Off-Peak", "new year", None]
    assert column(spark, given, "string", bands.season_category("v")) == [
        "Regular", "Other", "Regular", "Seasonal", "Religious", "Other", "Seasonal", "Seasonal", "Other",
        "Other", "Other", "Other",
    ]
    assert column(spark, given, "string", bands.is_peak("v")) == [
        False, False, False, True, True, True, False, True, True, True, True, False,
    ]
    assert column(spark, ["Eid", "Summer", "Off-Peak", "Monsoon", None], "string", bands.scoring_season("v")) == [
        "Peak", "Peak", "Off-Peak", "Regular", "Regular",
    ]
    assert column(spark, ["Off-Peak", "Regular", None], "string", bands.is_peak_short("v")) == [1, 0, 0]


def test_bands(spark):
    assert column(spark, [9999.99, 10000.0, 50000.0, 100000.0, None], "double", bands.fare_band("v")) == [
        "Budget", "Mid-Range", "Premium", "Luxury", "Luxury",
    ]
    assert column(spark, [7, 8, 14, 15, 30, 31, None], "int", bands.booking_window("v")) == [
        "Last Minute", "Short Notice", "Short Notice", "Advance", "Advance", "Early Bird", "Early Bird",
    ]
    assert column(spark, [0.0, 10000.0, 10000.01, 100000.0, 100001.0, None], "double", bands.fare_cut("v")) == [
        None, "Budget (<10K)", "Economy (10-30K)", "Premium (60-100K)", "Luxury (>100K)", None,
    ]
    assert column(spark, [0.0, 4.9, 5.0, 50.0], "double", bands.change_level("v")) == [
        "No Changes Detected", "Minor Updates Detected", "Moderate Changes Detected", "Major Changes Detected",
    ]


def test_silver_row(make):
    bronze = to_bronze(
        validate_rows(
            make(
                {"departure_datetime": dt.datetime(2025, 3, 1, 5), "source_code": "dac"},  # a Saturday
                {"departure_datetime": None, "base_fare_bdt": 300.0, "tax_surcharge_bdt": 1.0},
            )
        ),
        AT,
    ).withColumn("loyalty_tier", F.lit("gold"))
    first, second = silver_clean(bronze, loaded_at=AT).orderBy("id").collect()
    assert (first["route"], first["route_type"]) == ("DAC-CXB", "International")  # raw code is lower case
    assert (first["departure_day_of_week"], first["departure_day_type"]) == (6, "Weekend")
    assert (second["departure_year"], second["departure_day_type"]) == (None, "Weekday")
    assert (second["tax_percentage"], second["route_type"]) == (0.33, "Domestic")
    assert first["airline"] == "Us-Bangla Airlines" and first["destination_name"] == "Cox'S Bazar"
    assert first["loyalty_tier"] == "gold"  # columns added by a newer source come through


def test_silver_filter_drops_null_flags(spark):
    df = spark.createDataFrame(
        [(1, True, True), (2, True, None), (3, None, True), (4, True, False)], "id int, is_valid boolean, is_active boolean"
    )
    assert [r["id"] for r in silver_filter(df).collect()] == [1]
