"""Exact ranks of rows whose order is a seeded shuffle, without gathering a group or the table in one task."""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from fareloom.session import materialize

#: Groups whose sizes are broadcast at most, about 50 bytes each; beyond that they are joined by a shuffle.
BROADCAST_GROUPS = 200_000


def unit(*parts) -> Column:
    """A number in [0, 1) that follows from the given values alone; null counts as a value of its own."""
    text = F.concat_ws(":", *[F.coalesce(F.concat(F.lit("="), F.col(p).cast("string")), F.lit("")) if isinstance(p, str) else p for p in parts])
    return F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint") / F.lit(float(1 << 52))


def stratum(column: str) -> Column:
    """The column as a text that is never null; null is a stratum of its own."""
    return F.coalesce(F.concat(F.lit("="), F.col(column).cast("string")), F.lit(""))


def ranked(rows: DataFrame, group: str, unit: str, ties: list[str]) -> DataFrame:
    """``rows`` with ``group_rows`` and ``group_rank`` (from 0, by ``unit``, then ``ties``) within ``group`` (never null).

    ``unit`` is spread evenly over [0, 1) in every group, so equal ranges of it hold about equally many rows. A group
    of n rows is cut into n / r ranges with r about the square root of all rows: only rows of one range are sorted
    together, and the counts of the ranges are added up beforehand. A group of a third of all rows is many ranges.
    ``rows`` is read three times; what is costly to compute belongs into a written table.
    """
    total = rows.agg(F.greatest(F.lit(4096.0), F.ceil(F.sqrt(F.count(F.lit(1)))).cast("double")).alias("_each"))
    counts = rows.groupBy(group).agg(F.count(F.lit(1)).alias("group_rows")).crossJoin(F.broadcast(total))
    counts = materialize(counts.withColumn("_ranges", F.ceil(F.col("group_rows") / F.col("_each"))).drop("_each"), "groups")
    if counts.count() <= BROADCAST_GROUPS:  # a large group is then not gathered to learn its size
        counts = F.broadcast(counts)
    placed = rows.join(counts, group).withColumn("_range", F.floor(F.col(unit) * F.col("_ranges"))).drop("_ranges")
    before = Window.partitionBy(group).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        placed.groupBy(group, "_range").agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_start", F.coalesce(F.sum("_n").over(before), F.lit(0))).drop("_n")
    )
    within = Window.partitionBy(group, "_range").orderBy(unit, *ties)
    return (
        placed.join(starts, [group, "_range"])
        .withColumn("group_rank", (F.col("_start") + F.row_number().over(within) - 1).cast("bigint"))
        .drop("_range", "_start")
    )
