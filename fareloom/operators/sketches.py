"""Column profiles that add up: stored sketches of parts of a table stand for the whole."""

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions.numbers import ratio_pct, round_to

#: log2 of the registers of a distinct count: its standard error is 1.04 / sqrt(2 ** LG_K), 0.8 %.
LG_K = 14
#: Size of a quantile sketch: ranks are off by less than RANK_ERROR of the rows in 99 of 100 cases.
KLL_K, RANK_ERROR = 400, 0.008
QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def sketch(df: DataFrame, columns=None) -> DataFrame:
    """One row per column: column_name, rows, filled, least, greatest, distinct and quantiles (the last two as sketches).

    One aggregate over the rows, combined map-side; a sketch has a bounded size whatever the rows. Numbers have least,
    greatest and quantiles, all columns a distinct count of their text. NaN counts as a value but has no rank.
    """
    fields = [f for f in df.schema.fields if columns is None or f.name in columns]
    numeric = {f.name for f in fields if isinstance(f.dataType, T.NumericType)}
    cells = [
        F.struct(
            F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").cast("string").alias("value"),
            (F.nanvl(F.col(f"`{f.name}`").cast("double"), F.lit(None).cast("double")) if f.name in numeric else F.lit(None).cast("double")).alias("number"),
        )
        for f in fields
    ]
    rows = df.select(F.inline(F.array(*cells)))
    return rows.groupBy("column_name").agg(
        F.count(F.lit(1)).alias("rows"), F.count("value").alias("filled"), F.min("number").alias("least"), F.max("number").alias("greatest"),
        F.hll_sketch_agg("value", LG_K).alias("distinct"), F.kll_sketch_agg_double("number", KLL_K).alias("quantiles"),
    )


def merged(*sketches: DataFrame) -> DataFrame:
    """Sketches of parts to those of all their rows together; columns that a part lacks count there as nothing."""
    return reduce(DataFrame.unionByName, sketches).groupBy("column_name").agg(
        F.sum("rows").alias("rows"), F.sum("filled").alias("filled"), F.min("least").alias("least"), F.max("greatest").alias("greatest"),
        F.hll_union_agg("distinct").alias("distinct"), F.kll_merge_agg_double("quantiles").alias("quantiles"),
    )


def profile(sketches: DataFrame, wanted=None) -> DataFrame:
    """What sketches say: column_name, row_count, null_count, null_pct, unique_values, least, greatest and quantiles (numbers only)."""
    nulls, known = F.col("rows") - F.col("filled"), F.col("least").isNotNull()
    quantiles = [
        F.when(known, F.kll_sketch_get_quantile_double("quantiles", F.lit(p))).alias(name) for name, p in (wanted or QUARTILES).items()
    ]
    return sketches.select(
        "column_name", F.col("rows").alias("row_count"), nulls.alias("null_count"), round_to(ratio_pct(nulls, "rows"), 2).alias("null_pct"),
        F.hll_sketch_estimate("distinct").alias("unique_values"), "least", "greatest", *quantiles,
    )
