"""Joins that hold up when one key carries a large share of the rows."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fareloom.session import materialize

HOT_SHARE = 1000  # a key is hot from 1/1000 of the rows on, so there are at most 1000 hot keys
SALTS = 64
LOOKUP_ROWS = 200_000


def join_on(left: DataFrame, right: DataFrame, keys, how="inner", null_safe=True) -> DataFrame:
    """Equi-join on same-named keys, keeping the left ones; NULL keys match each other."""
    names = {k: f"__{k}" for k in keys}
    right = right.withColumnsRenamed(names)
    same = "<=>" if null_safe else "="
    condition = " AND ".join(f"`{k}` {same} `{renamed}`" for k, renamed in names.items())
    out = left.join(right, F.expr(condition), how)
    return out if how in ("left_semi", "left_anti") else out.drop(*names.values())


def cross_one(df: DataFrame, one_row: DataFrame) -> DataFrame:
    """Cross join with an ungrouped aggregate: one row, so it may always be broadcast."""
    return df.crossJoin(F.broadcast(one_row))


def hot_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys holding at least 1/1000 of the rows: at most 1000 of them, whatever the data."""
    counts = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    total = df.agg((F.count(F.lit(1)) / HOT_SHARE).alias("floor"))
    return cross_one(counts, total).where("n >= floor").select(key)


def salted_join(left: DataFrame, right: DataFrame, key: str, spread: str, how="left", hot=None) -> DataFrame:
    """Join rows to a table with unique keys, splitting the rows of hot keys over many tasks.

    Rows of a hot key get a salt from ``spread`` (a column that differs between them); only the
    few matching right rows are repeated, once per salt. Nothing else is copied, and the salt
    comes from the data, so that a recomputed task gives the same rows.
    """
    hot = hot_keys(left, key) if hot is None else hot
    hot = F.broadcast(hot.select(F.col(key).alias("__hot")))  # at most HOT_SHARE rows
    salt = F.when(F.col("__hot").isNotNull(), F.pmod(F.xxhash64(spread), F.lit(SALTS))).otherwise(0)
    left = left.join(hot, F.col(key) == F.col("__hot"), "left").withColumn("__salt", salt).drop("__hot")
    salts = F.when(
        F.col("__hot").isNotNull(), F.sequence(F.lit(0), F.lit(SALTS - 1))
    ).otherwise(F.array(F.lit(0)))
    right = (
        right.withColumnRenamed(key, "__key")
        .join(hot, F.col("__key") == F.col("__hot"), "left")
        .withColumn("__rsalt", F.explode(salts))
        .drop("__hot")
    )
    out = left.join(right, (F.col(key) == F.col("__key")) & (F.col("__salt") == F.col("__rsalt")), how)
    return out.drop("__salt", "__rsalt", "__key")


def lookup_join(left: DataFrame, small: DataFrame, key: str, spread: str) -> DataFrame:
    """Left join to a written table with unique keys.

    The rows of the table are counted (Parquet footers). Up to LOOKUP_ROWS it is broadcast; a larger
    one is joined by key with the hot keys salted.
    """
    if small.count() <= LOOKUP_ROWS:
        return join_on(left, F.broadcast(small), [key], "left", null_safe=False)
    return salted_join(left, small, key, spread)


def staging_join(validated: DataFrame, raw: DataFrame) -> DataFrame:
    """Valid rows with the load time of the raw row they came from (ids are unique on both sides)."""
    stamps = raw.select(F.col("id").alias("raw_id"), "loaded_at")
    return validated.where("is_valid").join(stamps, "raw_id")


def enrich_left(silver: DataFrame, stats, spread="id") -> DataFrame:
    """Add the columns of (frame, key) pairs that are not there yet; the first frame wins.

    The frames are gold tables. Of several rows with one key (a route of two types) the smallest is
    taken, so that no row of ``silver`` is repeated. The rows by key are written and counted: few are broadcast, many
    are joined with the hot keys split, such as a class that half of all bookings have.
    """
    out = silver
    for frame, key in stats:
        fresh = [c for c in frame.columns if c not in out.columns]
        row = F.struct(*[F.col(c) for c in fresh])
        single = frame.groupBy(key).agg(F.min(row).alias("_row")).select(key, "_row.*")
        out = lookup_join(out, materialize(single, "lookup"), key, spread)
    return out


def value_map(df: DataFrame, key: str, pairs: DataFrame, value: str, default, spread="id") -> DataFrame:
    """Look a value up in a written (key, value) table; keys without an entry get the default."""
    out = lookup_join(df, pairs.select(key, value), key, spread)
    return out.withColumn(value, F.coalesce(F.col(value), default))
