"""Number expressions."""

from pyspark.sql import Column
from pyspark.sql import functions as F

#: What does not fit nineteen digits before the point, up to the largest double.
TOO_LARGE = (1e19, 1.7976931348623157e308)


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def round_to(c, digits: int) -> Column:
    """Round half away from zero on the decimal value.

    The step over nine decimals takes out the noise of parallel double sums, so that a value
    that lies exactly between two results is rounded the same way on every run. Doubles of 1e19 and
    more have no decimals to round and stay as they are.
    """
    rounded = F.round(col(c).try_cast("decimal(28,9)"), digits).cast("double")
    return F.when(F.abs(col(c).cast("double")).between(*TOO_LARGE), col(c).cast("double")).otherwise(rounded)


def ratio_pct(part, whole) -> Column:
    """part / whole * 100, NULL when whole is zero."""
    return col(part) / F.nullif(col(whole), F.lit(0)) * 100


def change_pct(new, old) -> Column:
    """(new - old) / old * 100, NULL when old is zero."""
    return ratio_pct(col(new) - col(old), old)


def avg_if(value, condition: Column) -> Column:
    return F.avg(F.when(condition, col(value)))


def peak_premium(value, is_peak) -> Column:
    """How much dearer the peak average is than the off-peak average, in per cent."""
    return change_pct(avg_if(value, col(is_peak)), avg_if(value, ~col(is_peak)))


def mape(actual, predicted) -> Column:
    """Mean absolute percentage error. Rows with actual zero have no percentage and are left out."""
    return F.avg(F.abs((col(actual) - col(predicted)) / F.nullif(col(actual), F.lit(0.0)))) * 100


def sql_round(expression: str, digits: int = 2) -> str:
    """``round_to`` as SQL text, for long lists of aggregates."""
    rounded = f"CAST(round(try_cast({expression} AS decimal(28,9)), {digits}) AS double)"
    value = f"CAST({expression} AS double)"
    return f"CASE WHEN abs({value}) BETWEEN {TOO_LARGE[0]!r} AND {TOO_LARGE[1]!r} THEN {value} ELSE {rounded} END"


def sql_change(new: str, old: str) -> str:
    return f"(({new}) - ({old})) / nullif({old}, 0) * 100"


def sql_avg(value: str, where: str | None = None) -> str:
    return f"avg({value})" + (f" FILTER (WHERE {where})" if where else "")


def sql_count(where: str | None = None) -> str:
    return "count(1)" + (f" FILTER (WHERE {where})" if where else "")


def aggregate(df, keys, measures: dict):
    """Group by the keys; ``measures`` maps output names to SQL aggregates."""
    exprs = [F.expr(f"{sql} AS `{name}`") for name, sql in measures.items()]
    return df.groupBy(*keys).agg(*exprs) if keys else df.agg(*exprs)
