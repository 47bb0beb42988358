"""Exact percentiles, medians and ranks without gathering a group, or the table, in one task.

Values fall into buckets by a function that keeps their order, so that the number of buckets depends
on the range of the values and not on the number of rows. A first pass counts the rows per bucket,
which combines map-side. Running totals over the buckets (a small table) tell which buckets hold the
wanted positions. A second pass keeps the rows of those buckets alone, counts equal values, and
orders the distinct ones. A bucket that holds too many rows is first split between its least and its
greatest value, as often as it takes, so that what one task orders is bounded whatever the values are.
"""

import math
import sys

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.operators.joins import join_on
from fareloom.session import materialize

BUCKETS_PER_E = 1000  # a bucket spans 0.1 % of its values
TARGET_ROWS = 200_000  # most buckets that are broadcast to pick rows
BUCKET_ROWS = 1_000_000  # a bucket of more rows, and of more than one value, is split again
SPLIT = 1024  # parts of a bucket that is split
LEVELS = 4  # after so many splits no more than a few doubles lie between the ends of a bucket


def order_bucket(v: str) -> str:
    """Never decreases as v grows: logarithmic buckets on both sides of zero."""
    return f"CAST(sign({v}) * floor(log1p(abs({v})) * {BUCKETS_PER_E}) AS bigint)"


def bucketed(df: DataFrame, keys, value) -> DataFrame:
    """(keys, v, b) for all rows with a value; NULL and NaN are left out."""
    return (
        df.selectExpr(*[f"`{k}`" for k in keys], f"CAST(`{value}` AS double) AS v")
        .where("v IS NOT NULL AND NOT isnan(v)")
        .selectExpr("*", f"{order_bucket('v')} AS b")
    )


def percentiles(df: DataFrame, keys, value: str, wanted: dict) -> DataFrame:
    """Interpolated percentiles per group: ``wanted`` maps output names to fractions.

    Gives what PERCENTILE_CONT gives, one row per group that has any value.
    """
    keys = list(keys)
    if not keys:
        df = df.selectExpr("*", "1 AS __all")
    names = [f"`{k}`" for k in keys or ["__all"]]
    by = ", ".join(names)
    lows = {name: f"floor((total - 1) * {p}D)" for name, p in wanted.items()}
    highs = {name: f"ceil((total - 1) * {p}D)" for name, p in wanted.items()}
    rows = bucketed(df, keys or ["__all"], value)
    holds = " OR ".join(
        f"(upto - m <= {position} AND {position} < upto)" for position in {*lows.values(), *highs.values()}
    )
    counts = rows.groupBy(*names, "b").agg(F.expr("count(1) AS m"), F.expr("min(v) AS lo"), F.expr("max(v) AS hi"))
    targets = counts.selectExpr(
        "*",
        f"sum(m) OVER (PARTITION BY {by} ORDER BY b ROWS UNBOUNDED PRECEDING) AS upto",
        f"sum(m) OVER (PARTITION BY {by}) AS total",
    ).where(holds).selectExpr(*names, "b", "upto - m AS before", "m", "total", "lo", "hi")
    where = [*(keys or ["__all"]), "b"]
    small, targets = _held(targets)
    for _ in range(LEVELS):
        if targets.where(f"m > {BUCKET_ROWS} AND lo < hi").isEmpty():
            break
        # each target bucket becomes its parts; those without a wanted position are dropped again
        rows = join_on(rows, F.broadcast(targets) if small else targets, where)
        rows = rows.selectExpr(*names, "v", f"b * {SPLIT} + {_part('v', 'lo', 'hi')} AS b", "b AS parent", "before", "total")
        counts = rows.groupBy(*names, "parent", "b").agg(
            F.expr("count(1) AS m"), F.expr("min(v) AS lo"), F.expr("max(v) AS hi"), F.expr("max(before) AS before"), F.expr("max(total) AS total")
        )
        rows = rows.drop("parent", "before", "total")
        targets = counts.selectExpr(
            "*", f"before + sum(m) OVER (PARTITION BY {by}, parent ORDER BY b ROWS UNBOUNDED PRECEDING) AS upto"
        ).where(holds).selectExpr(*names, "b", "upto - m AS before", "m", "total", "lo", "hi")
        small, targets = _held(targets)
    targets = targets.drop("m", "lo", "hi")
    if small:
        # few groups: drop all other rows before anything is shuffled
        counted = (
            join_on(rows, F.broadcast(targets), where)
            .groupBy(*names, "b", "before", "total", "v")
            .agg(F.expr("count(1) AS n"))
        )
    else:
        # many groups: count equal values first, then join by group and bucket
        counted = rows.groupBy(*names, "b", "v").agg(F.expr("count(1) AS n"))
        counted = join_on(counted, targets, where)
    placed = counted.selectExpr(
        "*", f"before + sum(n) OVER (PARTITION BY {by}, b ORDER BY v ROWS UNBOUNDED PRECEDING) AS stop"
    )

    def at(position):
        return f"max(CASE WHEN stop - n <= {position} AND {position} < stop THEN v END)"

    picked = placed.groupBy(*names).agg(
        F.expr("max(total) AS total"),
        *[F.expr(f"{at(lows[n])} AS `{n}__lo`") for n in wanted],
        *[F.expr(f"{at(highs[n])} AS `{n}__hi`") for n in wanted],
    )
    between = [
        f"`{n}__lo` + (`{n}__hi` - `{n}__lo`) * ((total - 1) * {p}D - {lows[n]}) AS `{n}`"
        for n, p in wanted.items()
    ]
    return picked.selectExpr(*[f"`{k}`" for k in keys], *between)


def _part(v: str, lo: str, hi: str) -> str:
    """Which of the ``SPLIT`` parts of a bucket a value falls into; never decreases as v grows."""
    share = f"({v} / 2 - {lo} / 2) / ({hi} / 2 - {lo} / 2)"  # halves, as the ends may be the extremes of a double
    return f"CASE WHEN {lo} / 2 < {hi} / 2 THEN least({SPLIT - 1}, CAST(floor({share} * {SPLIT}) AS bigint)) ELSE 0 END"


def _held(targets: DataFrame) -> tuple[bool, DataFrame]:
    """Whether there are few target buckets, and the buckets: local rows if so, else a written table."""
    few = bounded(targets, TARGET_ROWS)
    return few is not None, materialize(targets, "target-buckets") if few is None else few


def bounded(df: DataFrame, most: int) -> DataFrame | None:
    """The result as a local table if it has at most that many rows, else None."""
    rows = df.limit(most + 1).toArrow()
    return df.sparkSession.createDataFrame(rows, df.schema) if rows.num_rows <= most else None


def column_percentiles(df: DataFrame, columns, wanted: dict) -> DataFrame:
    """Percentiles of several columns in one pass: one row per column (``column_name``)."""
    return percentiles(unpivot(df, columns, "double"), ["column_name"], "value", wanted)


def unpivot(df: DataFrame, columns, kind: str) -> DataFrame:
    """(column_name, value) rows of the given columns, cast to one type."""
    return df.select(*[F.col(c).cast(kind).alias(c) for c in columns]).unpivot(
        [], list(columns), "column_name", "value"
    )


def rank_table(df: DataFrame, measure: str) -> DataFrame:
    """Distinct values of a measure with their place in the whole table, greatest first.

    Columns: v, n (rows with the value), above (rows with a greater value), dense (1, 2, ...).
    The window without a partition runs over buckets: a fixed number, and the parts of those with
    more than ``BUCKET_ROWS`` distinct values.
    """
    values = materialize(bucketed(df, [], measure).groupBy("b", "v").agg(F.count(F.lit(1)).alias("n")), "values")
    for _ in range(LEVELS):
        full = values.groupBy("b").agg(F.count(F.lit(1)).alias("d"), F.min("v").alias("lo"), F.max("v").alias("hi"))
        full = full.where(F.col("d") > BUCKET_ROWS).select("b", "lo", "hi")  # no more than the values / BUCKET_ROWS
        if full.isEmpty():
            break
        parts = F.expr(f"b * {SPLIT} + {_part('v', 'coalesce(lo, v)', 'coalesce(hi, v)')}")
        values = materialize(values.join(full, "b", "left").select(parts.alias("b"), "v", "n"), "values")
    downwards = W.orderBy(F.col("b").desc()).rowsBetween(W.unboundedPreceding, -1)
    buckets = (
        values.groupBy("b")
        .agg(F.sum("n").alias("m"), F.count(F.lit(1)).alias("d"))
        .withColumn("rows_before", F.coalesce(F.sum("m").over(downwards), F.lit(0)))
        .withColumn("values_before", F.coalesce(F.sum("d").over(downwards), F.lit(0)))
        .select("b", "rows_before", "values_before")
    )
    inside = W.partitionBy("b").orderBy(F.col("v").desc())
    so_far = inside.rowsBetween(W.unboundedPreceding, 0)
    return join_on(values, buckets, ["b"], null_safe=False).select(
        "v",
        "n",
        (F.col("rows_before") + F.sum("n").over(so_far) - F.col("n")).alias("above"),
        (F.col("values_before") + F.row_number().over(inside)).alias("dense"),
    )


def count_rank_table(df: DataFrame, measure: str) -> DataFrame:
    """``rank_table`` for a measure that counts rows.

    Counts that add up to N rows have fewer than sqrt(2 N) distinct values (1.5 million for a
    trillion rows), so the window may run over the distinct counts directly.
    """
    values = df.groupBy(F.col(measure).alias("v")).agg(F.count(F.lit(1)).alias("n"))
    downwards = W.orderBy(F.col("v").desc())
    before = F.sum("n").over(downwards.rowsBetween(W.unboundedPreceding, -1))
    return values.select(
        "v", "n", F.coalesce(before, F.lit(0)).alias("above"), F.row_number().over(downwards).alias("dense")
    )


def with_rank(df: DataFrame, measure: str, out: str, method="min", counts=False) -> DataFrame:
    """RANK() ("min") or the mean rank of ties ("average") over the whole table, greatest first.

    ``counts`` says that the measure is a number of rows. Rows without a value get no rank.
    """
    ranks = (count_rank_table if counts else rank_table)(df, measure)
    if method == "min":
        rank = (F.col("above") + 1).cast("bigint")
    elif method == "average":
        rank = F.col("above") + (F.col("n") + 1) / 2
    else:
        raise ValueError(f"unknown rank method {method!r}")
    ranks = ranks.select(F.col("v").alias("__v"), rank.alias(out))
    value = F.col(measure) if counts else F.col(measure).cast("double")
    if not counts:  # a common value may hold much of the table: no shuffle by value if it can be helped
        small = bounded(ranks, TARGET_ROWS)
        ranks = ranks if small is None else F.broadcast(small)
    return df.join(ranks, value == F.col("__v"), "left").drop("__v")


def modes(df: DataFrame, keys, value: str, out: str) -> DataFrame:
    """Most frequent value per group, the smallest of several; counted before it is compared."""
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("n"))
    best = F.min_by(value, F.struct(-F.col("n"), F.col(value))).alias(out)
    return counts.groupBy(*keys).agg(best) if keys else counts.agg(best)


def bucket_limit() -> int:
    """Upper bound on the number of buckets any column of doubles can have."""
    return 2 * math.ceil(math.log(sys.float_info.max) * BUCKETS_PER_E) + 1
