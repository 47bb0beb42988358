"""Row-level validation."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.functions import fixed
from fareloom.functions.numbers import round_to
from fareloom.functions.text import is_blank


def _rules(columns):
    """(condition, message) pairs in the order in which the messages appear."""
    for c in ("airline", "source_code", "destination_code"):
        yield c, is_blank(c), f"{c} is required"
    for c in ("base_fare_bdt", "total_fare_bdt"):
        yield c, F.col(c).isNull() | (F.col(c) <= 0), f"{c} must be positive"
    tax = F.col("tax_surcharge_bdt")
    yield "tax_surcharge_bdt", tax.isNull() | (tax < 0), "tax_surcharge_bdt cannot be negative"
    for c in ("source_code", "destination_code"):
        # untrimmed; a missing code counts as the text None and so has the wrong length too
        yield c, F.length(F.coalesce(F.col(c), F.lit("None"))) != 3, f"{c} must be 3 characters"
    hours = F.col("duration_hrs")
    yield "duration_hrs", hours.isNull() | (hours <= 0), "duration_hrs must be positive"
    days = F.col("days_before_departure")
    yield "days_before_departure", days.isNull() | (days < 1), "days_before_departure must be at least 1"


def _messages(pairs):
    """The messages whose condition holds, joined by ``; ``; NULL when there are none."""
    return F.nullif(F.concat_ws("; ", *[F.when(cond, text) for cond, text in pairs]), F.lit(""))


def validate_rows(df: DataFrame) -> DataFrame:
    """Adds ``validation_errors`` and ``is_valid``; rules for columns that are absent are skipped."""
    pairs = [(cond, text) for c, cond, text in _rules(df.columns) if c in df.columns]
    return df.withColumn("validation_errors", _messages(pairs)).withColumn(
        "is_valid", F.col("validation_errors").isNull()
    )


def soft_rules(df: DataFrame) -> DataFrame:
    """Adds ``validation_warnings`` for unknown categories and very long lead times."""
    pairs = [
        (F.col(c).isNotNull() & ~F.col(c).isin(*known), f"{c} has an unexpected value")
        for c, known in fixed.KNOWN_VALUES.items()
    ]
    days = F.col("days_before_departure") > fixed.MAX_USUAL_LEAD_DAYS
    pairs.append((days, f"days_before_departure is above {fixed.MAX_USUAL_LEAD_DAYS}"))
    return df.withColumn("validation_warnings", _messages(pairs))


def validation_summary(validated: DataFrame) -> DataFrame:
    total, valid = F.count(F.lit(1)), F.count_if("is_valid")
    return validated.agg(
        total.alias("total_rows"),
        valid.alias("valid_rows"),
        (total - valid).alias("invalid_rows"),
        round_to(100.0 * valid / F.nullif(total, F.lit(0)), 2).alias("validation_rate"),
    )
