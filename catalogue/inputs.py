"""Layer tables the queries read, derived from the given tables and written once per application."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.incremental import to_bronze, with_hash
from fareloom.operators.silver import silver_clean
from fareloom.operators.validate import validate_rows
from fareloom.session import COMPACT, materialize, size_shuffles
from fareloom.sources.bookings import DOMESTIC, bookings, table

LOADED_AT = "2002-01-01 00:00:00"
FIRST_LOAD = "2001-01-01 00:00:00"
SECOND_LOAD = "2001-06-01 00:00:00"
AS_OF = "2001-12-01 00:00:00"

# The first extract ends before FIRST_CUT, the second starts at SECOND_CUT and has dearer Eid fares.
FIRST_CUT = "2001-01-01"
SECOND_CUT = "1996-01-01"
RELOAD_CUT = "1998-06-01"
EID_RISE = 100

_written: dict = {}


def _once(spark: SparkSession, sf_dir: str, name: str, build) -> DataFrame:
    """Build and write a layer table on first use; later queries scan the columns they need."""
    key = (spark.sparkContext.applicationId, sf_dir, name)
    if key not in _written:
        _written[key] = materialize(build(), name, options=COMPACT)
    return _written[key]


def raw(spark, sf_dir) -> DataFrame:
    size_shuffles(spark, sf_dir)
    return bookings(spark, sf_dir)


def validated(spark, sf_dir) -> DataFrame:
    return _once(spark, sf_dir, "validated", lambda: validate_rows(raw(spark, sf_dir)))


def checked(spark, sf_dir) -> DataFrame:
    """The validated rows for a single pass: from the table if it is written already, else worked out and not written."""
    if (spark.sparkContext.applicationId, sf_dir, "validated") in _written:
        return validated(spark, sf_dir)
    return validate_rows(raw(spark, sf_dir))


def valid(spark, sf_dir) -> DataFrame:
    return validated(spark, sf_dir).where("is_valid")


def valid_columns(spark, sf_dir, *columns) -> DataFrame:
    """A few columns of the valid rows for several passes: from the validated table if it is written already, else written alone."""
    if (spark.sparkContext.applicationId, sf_dir, "validated") in _written:
        return valid(spark, sf_dir).select(*columns)
    return _once(spark, sf_dir, "-".join(columns), lambda: checked(spark, sf_dir).where("is_valid").select(*columns))


def valid_rows(spark, sf_dir) -> DataFrame:
    """All columns of the valid rows for several passes: from the validated table if it is written already, else written alone."""
    if (spark.sparkContext.applicationId, sf_dir, "validated") in _written:
        return valid(spark, sf_dir)
    return _once(spark, sf_dir, "valid", lambda: checked(spark, sf_dir).where("is_valid"))


def bronze(spark, sf_dir) -> DataFrame:
    return to_bronze(valid(spark, sf_dir), LOADED_AT)


def silver(spark, sf_dir) -> DataFrame:
    """From the validated table if it is written already; a query of silver alone does not write both."""
    def build():
        return silver_clean(to_bronze(checked(spark, sf_dir).where("is_valid"), LOADED_AT), DOMESTIC, LOADED_AT)

    return _once(spark, sf_dir, "silver", build)


def _repriced(df: DataFrame) -> DataFrame:
    rise = F.when(F.col("seasonality") == "Eid", float(EID_RISE)).otherwise(0.0)
    return df.withColumns(
        {c: F.col(c) + rise for c in ("base_fare_bdt", "total_fare_bdt")}
    )


def first_extract(spark, sf_dir, rows=None) -> DataFrame:
    """Departures up to the first cut. ``rows`` are the valid ones, those of the validated table by default."""
    return (valid(spark, sf_dir) if rows is None else rows).where(F.col("departure_datetime") < F.lit(FIRST_CUT).cast("timestamp_ntz"))


def second_extract(spark, sf_dir, rows=None) -> DataFrame:
    """A later extract: old departures have dropped out, new ones came in, Eid fares rose."""
    later = F.col("departure_datetime") >= F.lit(SECOND_CUT).cast("timestamp_ntz")
    return _repriced((valid(spark, sf_dir) if rows is None else rows).where(later))


def reload_extract(spark, sf_dir, rows=None) -> DataFrame:
    later = F.col("departure_datetime") >= F.lit(RELOAD_CUT).cast("timestamp_ntz")
    return _repriced((valid(spark, sf_dir) if rows is None else rows).where(later))


def loads(spark, sf_dir, second=second_extract):
    """(incoming, bronze) before the second load."""
    return with_hash(second(spark, sf_dir)), to_bronze(first_extract(spark, sf_dir), FIRST_LOAD)


def silver_extracts(spark, sf_dir):
    first = to_bronze(first_extract(spark, sf_dir), FIRST_LOAD)
    second = to_bronze(second_extract(spark, sf_dir), SECOND_LOAD)
    return silver_clean(first, DOMESTIC, LOADED_AT), silver_clean(second, DOMESTIC, LOADED_AT)


def load_log(spark, sf_dir, rows=None) -> DataFrame:
    """Load log read from the bookings: one load per departure month. ``rows`` are the validated ones, the table by default."""
    months = (validated(spark, sf_dir) if rows is None else rows).groupBy(
        F.expr("CAST(date_trunc('MONTH', departure_datetime) AS timestamp_ntz) AS load_timestamp")
    )
    return months.agg(
        F.expr("count_if(is_valid) AS records_inserted"),
        F.expr("count_if(seasonality = 'Regular' AND NOT is_valid) AS records_deleted"),
        F.expr("count_if(seasonality <> 'Regular' AND NOT is_valid) AS records_unchanged"),
        F.expr(
            "CAST(round(CAST(100.0D * count_if(is_valid) / count(1) AS decimal(28,9)), 2) AS double)"
            " AS change_percentage"
        ),
        F.expr("CAST(sum(duration_hrs) AS bigint) AS execution_time_seconds"),
    ).selectExpr(
        "*", "CASE WHEN change_percentage > 50 THEN 'FULL' ELSE 'INCREMENTAL' END AS load_type"
    )


def model_history(spark, sf_dir) -> DataFrame:
    """Training history read from the bookings: one run per departure month, base fare as forecast."""
    months = valid(spark, sf_dir).groupBy(
        F.expr("CAST(date_trunc('MONTH', departure_datetime) AS timestamp_ntz) AS training_timestamp")
    )
    two = "CAST(round(CAST({} AS decimal(28,9)), 4) AS double)"
    return months.agg(
        F.expr("count(1) AS training_records"),
        F.expr(two.format("corr(total_fare_bdt, base_fare_bdt) * corr(total_fare_bdt, base_fare_bdt)") + " AS test_r2"),
        F.expr(two.format("avg(total_fare_bdt - base_fare_bdt)") + " AS test_mae"),
        F.expr("min(airline) AS model_type"),
    ).selectExpr(
        "*",
        "concat('model_', date_format(training_timestamp, 'yyyyMM')) AS model_name",
        "month(training_timestamp) <> 12 AS is_production",
    )


def audit(spark, sf_dir) -> DataFrame:
    """Run log read from the event stream: an event is the start, the end or the failure of a task."""
    return table(spark, sf_dir, "events").selectExpr(
        "CAST(event_id AS bigint) AS id",
        "'events' AS dag_id",
        "CAST(user_id AS string) AS dag_run_id",
        "event_type AS task_id",
        "CASE WHEN value < 10 THEN 'started' WHEN value < 90 THEN 'completed' ELSE 'failed' END AS status",
        "CASE WHEN value < 10 THEN ts END AS started_at",
        "CASE WHEN value >= 10 THEN ts END AS completed_at",
        "CAST(floor(value) AS bigint) AS rows_processed",
        "CASE WHEN value >= 90 THEN props END AS error_message",
    )
