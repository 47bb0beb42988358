"""Derived categories of a booking."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from fareloom.functions import fixed
from fareloom.functions.numbers import col, ratio_pct, round_to
from fareloom.functions.text import clean_code, clean_name, has_word


def route_key(source, destination, sep="-") -> Column:
    """``SRC-DST``; NULL when either code is NULL."""
    return F.concat(col(source), F.lit(sep), col(destination))


def day_of_week(ts) -> Column:
    """0 = Sunday ... 6 = Saturday."""
    return F.dayofweek(col(ts)) - 1


def day_type(ts) -> Column:
    return F.when(day_of_week(ts).isin(0, 6), "Weekend").otherwise("Weekday")


def num_stops(stopovers) -> Column:
    s = col(stopovers)
    return F.when(s == "Direct", 0).when(s.contains("1"), 1).when(s.contains("2"), 2)


def class_name(travel_class) -> Column:
    """Known spellings map to one name; any other class keeps its own name."""
    spelling = clean_code(travel_class)
    out = None
    for name, spellings in fixed.CLASS_SPELLINGS.items():
        out = (F if out is None else out).when(spelling.isin(*spellings), name)
    return out.otherwise(clean_name(travel_class))


def tax_percentage(tax, base) -> Column:
    return round_to(ratio_pct(tax, base), 2)


def fare_band(total) -> Column:
    out = None
    for bound, name in fixed.FARE_BANDS:
        out = (F if out is None else out).when(col(total) < bound, name)
    return out.otherwise(fixed.FARE_BAND_ELSE)


def is_peak(seasonality) -> Column:
    return has_word(F.upper(col(seasonality)), fixed.PEAK_WORDS)


def season_category(seasonality) -> Column:
    upper = F.upper(col(seasonality))
    out = F.when(upper == "REGULAR", "Regular")
    for name, words in fixed.SEASON_WORDS:
        out = out.when(has_word(upper, words), name)
    return out.otherwise("Other")


def booking_window(days) -> Column:
    out = None
    for bound, name in fixed.WINDOW_BANDS:
        out = (F if out is None else out).when(col(days) <= bound, name)
    return out.otherwise(fixed.WINDOW_BAND_ELSE)


def route_type(source, destination, domestic=fixed.DOMESTIC_CODES) -> Column:
    """Compares the codes as they came: neither trimmed nor upper-cased."""
    both = col(source).isin(*domestic) & col(destination).isin(*domestic)
    return F.when(both, "Domestic").otherwise("International")


def scoring_season(seasonality) -> Column:
    pairs = [F.lit(x) for pair in fixed.SCORING_SEASONS.items() for x in pair]
    return F.coalesce(F.try_element_at(F.create_map(*pairs), col(seasonality)), F.lit("Regular"))


def is_peak_short(seasonality) -> Column:
    """The analysts' short rule, as 0 or 1."""
    return has_word(F.lower(col(seasonality)), fixed.PEAK_WORDS_SHORT).cast("int")


def total_from_parts(total, base, tax) -> Column:
    return F.coalesce(col(total), col(base) + col(tax))


def fare_cut(total) -> Column:
    """Right-closed bins; nothing at or below zero falls into one."""
    out = F.when(col(total).isNull() | (col(total) <= 0), F.lit(None).cast("string"))
    for bound, name in fixed.FARE_CUTS:
        out = out.when(col(total) <= bound, name)
    return out.otherwise(fixed.FARE_CUT_ELSE)


def change_level(pct) -> Column:
    p = col(pct)
    return (
        F.when(p == 0, "No Changes Detected")
        .when(p < 5, "Minor Updates Detected")
        .when(p < 50, "Moderate Changes Detected")
        .otherwise("Major Changes Detected")
    )
