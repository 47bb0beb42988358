"""Column profiles, distributions and group statistics."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.functions import bands
from fareloom.functions.numbers import avg_if, change_pct, ratio_pct, round_to
from fareloom.operators.joins import cross_one, join_on, salted_join
from fareloom.operators.order_stats import column_percentiles, percentiles, unpivot
from fareloom.operators.quality import union_all


def value_counts(df: DataFrame, columns) -> DataFrame:
    """(column_name, value, n) for all columns in one pass."""
    return unpivot(df, columns, "string").groupBy("column_name", "value").agg(
        F.count(F.lit(1)).alias("n")
    )


def profile_columns(df: DataFrame, approximate=False) -> DataFrame:
    """Type, NULLs, share of NULLs and distinct values per column.

    Exact counts shuffle one row per distinct value. ``approximate`` gives sketched distinct counts
    in a single aggregate without that shuffle.
    """
    columns = df.columns
    kinds = F.create_map(*[F.lit(x) for f in df.schema.fields for x in (f.name, f.dataType.simpleString())])
    if approximate:
        cells = unpivot(df, columns, "string").groupBy("column_name").agg(
            F.count(F.lit(1)).alias("rows"),
            F.count("value").alias("filled"),
            F.approx_count_distinct("value").alias("unique_values"),
        )
    else:
        cells = value_counts(df, columns).groupBy("column_name").agg(
            F.sum("n").alias("rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNotNull(), F.col("n"))), F.lit(0)).alias("filled"),
            F.count("value").alias("unique_values"),
        )
    nulls = F.col("rows") - F.col("filled")
    return cells.select(
        "column_name",
        kinds[F.col("column_name")].alias("dtype"),
        nulls.alias("null_count"),
        round_to(ratio_pct(nulls, "rows"), 2).alias("null_pct"),
        "unique_values",
    )


def value_counts_topn(df: DataFrame, columns, n=10) -> DataFrame:
    """The most frequent values per column. Spark applies the row limit before the shuffle too."""
    order = W.partitionBy("column_name").orderBy(F.col("n").desc(), F.col("value"))
    return (
        value_counts(df, columns)
        .where("value IS NOT NULL")
        .withColumn("place", F.row_number().over(order))
        .where(F.col("place") <= n)
    )


QUARTILES = {"q25": 0.25, "q50": 0.5, "q75": 0.75}


def describe(df: DataFrame, columns) -> DataFrame:
    """Count, mean, sample deviation, extremes and quartiles per number column."""
    cells = unpivot(df, columns, "double").groupBy("column_name").agg(
        F.count("value").alias("count"),
        round_to(F.avg("value"), 2).alias("mean"),
        round_to(F.stddev_samp("value"), 2).alias("std"),
        F.min("value").alias("min"),
        F.max("value").alias("max"),
    )
    quartiles = column_percentiles(df, columns, QUARTILES)
    rounded = quartiles.select("column_name", *[round_to(q, 2).alias(q) for q in QUARTILES])
    return join_on(cells, rounded, ["column_name"], "left")


def positive_filter(df: DataFrame, column: str) -> DataFrame:
    return df.where(F.col(column) > 0)


def impute_median(df: DataFrame, columns) -> DataFrame:
    """Number columns with gaps get their median (0 when they hold nothing else)."""
    fills = median_fills(df, columns)
    return df.fillna(fills) if fills else df


def median_fills(df: DataFrame, columns) -> dict:
    """column -> fill value for columns that have gaps; one small row per column comes back."""
    if not columns:
        return {}
    gaps = df.agg(*[F.count_if(F.col(c).isNull() | F.isnan(F.col(c).cast("double"))).alias(c) for c in columns])
    with_gaps = [c for c, n in gaps.first().asDict().items() if n]
    if not with_gaps:
        return {}
    medians = {
        r["column_name"]: r["m"] for r in column_percentiles(df, with_gaps, {"m": 0.5}).collect()
    }
    return {c: float(medians.get(c, 0.0)) for c in with_gaps}


def impute_mode(df: DataFrame, columns) -> DataFrame:
    """Text columns with gaps get their most frequent value (``Unknown`` when they hold nothing)."""
    best = {r["column_name"]: r["value"] for r in value_counts_topn(df, columns, 1).collect()}
    return df.fillna({c: best.get(c, "Unknown") for c in columns})


def iqr_outliers(df: DataFrame, column: str, width=3.0) -> DataFrame:
    """Bounds Q1 - width*IQR and Q3 + width*IQR with the number and share of rows outside."""
    value = F.col(column)
    q = percentiles(df, [], column, {"q1": 0.25, "q3": 0.75})
    spread = F.col("q3") - F.col("q1")
    bounds = q.select(
        (F.col("q1") - width * spread).alias("lower"), (F.col("q3") + width * spread).alias("upper")
    )
    outside = F.count_if((value < F.col("lower")) | (value > F.col("upper")))
    rows = F.count(F.lit(1))
    return cross_one(df.select(column), bounds).agg(
        round_to(F.max("lower"), 2).alias("lower_bound"),
        round_to(F.max("upper"), 2).alias("upper_bound"),
        outside.alias("outliers"),
        round_to(ratio_pct(outside, rows), 2).alias("outlier_pct"),
    )


def histogram(df: DataFrame, column: str, bins=50) -> DataFrame:
    """Equal-width bins between the extremes; the last one is closed; empty bins are listed."""
    value = F.col(column)
    same = F.min(value) == F.max(value)
    bounds = df.agg(
        F.when(same, F.min(value) - 0.5).otherwise(F.min(value)).alias("lo"),
        F.when(same, F.max(value) + 0.5).otherwise(F.max(value)).alias("hi"),
    )
    width = (F.col("hi") - F.col("lo")) / bins
    place = F.least(F.lit(bins - 1), F.floor((value - F.col("lo")) / width).cast("int"))
    counts = (
        cross_one(df.where(value.isNotNull()).select(column), bounds)
        .groupBy(place.alias("bin"))
        .agg(F.count(F.lit(1)).alias("n"))
    )
    edges = bounds.where("lo IS NOT NULL").select(
        F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"), "lo", width.alias("width")
    )
    return join_on(edges, counts, ["bin"], "left", null_safe=False).select(
        "bin",
        round_to(F.col("lo") + F.col("bin") * F.col("width"), 2).alias("bin_start"),
        round_to(F.col("lo") + (F.col("bin") + 1) * F.col("width"), 2).alias("bin_end"),
        F.coalesce("n", F.lit(0)).alias("n"),
    )


def box_stats(df: DataFrame, key: str, column: str) -> DataFrame:
    """Quartiles, whiskers (last value within 1.5 IQR) and number of points beyond, per group.

    The rows are counted per distinct value before they meet the quartiles, and large groups are
    split by value in that join.
    """
    counted = (
        df.where(F.col(column).isNotNull() & F.col(key).isNotNull())
        .groupBy(key, column)
        .agg(F.count(F.lit(1)).alias("n"))
    )
    boxes = percentiles(df, [key], column, QUARTILES)
    reach = 1.5 * (F.col("q75") - F.col("q25"))
    value = F.col(column)
    inside = (value >= F.col("q25") - reach) & (value <= F.col("q75") + reach)
    return (
        salted_join(counted, boxes, key, column)
        .groupBy(key)
        .agg(
            F.sum("n").alias("n"),
            F.min(column).alias("minimum"),
            *[round_to(F.max(q), 2).alias(q) for q in QUARTILES],
            F.max(column).alias("maximum"),
            F.min(F.when(inside, value)).alias("whisker_low"),
            F.max(F.when(inside, value)).alias("whisker_high"),
            F.coalesce(F.sum(F.when(~inside, F.col("n"))), F.lit(0)).alias("outliers"),
        )
    )


def corr_matrix(df: DataFrame, columns, digits=4) -> DataFrame:
    """Pearson correlation of all pairs, from one pass; (feature_a, feature_b, r)."""
    pairs = [(a, b) for i, a in enumerate(columns) for b in columns[i + 1 :]]
    row = df.agg(
        *[
            F.corr(F.col(a).cast("double"), F.col(b).cast("double")).alias(f"{a}|{b}")
            for a, b in pairs
        ]
    )
    half = row.unpivot([], [f"{a}|{b}" for a, b in pairs], "pair", "r").select(
        F.split("pair", r"\|")[0].alias("feature_a"),
        F.split("pair", r"\|")[1].alias("feature_b"),
        round_to(F.nanvl("r", F.lit(None).cast("double")), digits).alias("r"),
    )
    mirrored = half.select(
        F.explode(
            F.array(
                F.struct("feature_a", "feature_b", "r"),
                F.struct(F.col("feature_b").alias("feature_a"), F.col("feature_a").alias("feature_b"), "r"),
            )
        ).alias("c")
    )
    return mirrored.select("c.*")


def target_correlation(df: DataFrame, columns, target: str) -> DataFrame:
    """Correlation with the target, strongest first."""
    row = df.agg(
        *[F.corr(F.col(c).cast("double"), F.col(target).cast("double")).alias(c) for c in columns]
    )
    return (
        row.unpivot([], list(columns), "feature", "r")
        .select("feature", round_to(F.nanvl("r", F.lit(None).cast("double")), 4).alias("r"))
        .orderBy(F.abs("r").desc_nulls_last(), "feature")
    )


def group_stats(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean, median, extremes and count per group."""
    groups = df.groupBy(key).agg(
        round_to(F.avg(value), 2).alias("avg_fare"),
        F.min(value).alias("min_fare"),
        F.max(value).alias("max_fare"),
        F.count(value).alias("booking_count"),
    )
    medians = percentiles(df, [key], value, {"m": 0.5}).select(key, round_to("m", 2).alias("median_fare"))
    return join_on(groups, medians, [key], "left")


def all_group_stats(df: DataFrame, keys, value: str) -> DataFrame:
    """``group_stats`` for several grouping columns at once: one scan, (group_name, group_value)."""
    cells = df.select(F.col(value), *[F.col(k).cast("string") for k in keys]).unpivot(
        [value], list(keys), "group_name", "group_value"
    )
    pair = ["group_name", "group_value"]
    groups = cells.groupBy(*pair).agg(
        round_to(F.avg(value), 2).alias("avg_fare"),
        F.min(value).alias("min_fare"),
        F.max(value).alias("max_fare"),
        F.count(value).alias("booking_count"),
    )
    medians = percentiles(cells, pair, value, {"m": 0.5}).select(*pair, round_to("m", 2).alias("median_fare"))
    return join_on(groups, medians, pair, "left")


def peak_label(df: DataFrame) -> DataFrame:
    flag = bands.is_peak_short("seasonality")
    return df.withColumn("peak_label", F.when(flag == 1, "Peak Season").otherwise("Off-Peak"))


def peak_stats(df: DataFrame, value: str) -> DataFrame:
    return group_stats(peak_label(df), "peak_label", value)


def pivot_premium(df: DataFrame, key: str, value: str) -> DataFrame:
    """Mean per group, peak next to off-peak, with the premium; dearest premium first."""
    pivot = peak_label(df).groupBy(key).pivot("peak_label", ["Off-Peak", "Peak Season"]).agg(F.avg(value))
    off, on = F.col("Off-Peak"), F.col("Peak Season")
    return pivot.select(
        key,
        round_to(off, 2).alias("off_peak"),
        round_to(on, 2).alias("peak_season"),
        round_to(change_pct(on, off), 2).alias("premium_pct"),
    ).orderBy(F.col("premium_pct").desc_nulls_last(), key)


def topk_groups(df: DataFrame, key: str, value: str, by="avg_fare", k=10) -> DataFrame:
    """The k groups with the highest mean or count; a sort with a limit keeps k rows per task."""
    groups = df.groupBy(key).agg(
        round_to(F.avg(value), 2).alias("avg_fare"), F.count(value).alias("booking_count")
    )
    return groups.orderBy(F.col(by).desc(), key).limit(k)


def argmax_group(df: DataFrame, key: str, value: str) -> DataFrame:
    """Groups with the highest and lowest mean and the most rows; ties go to the smallest name."""
    groups = df.where(F.col(key).isNotNull()).groupBy(key).agg(
        round_to(F.avg(value), 2).alias("mean"), F.count(value).alias("n")
    )
    name = F.col(key).cast("string")
    extremes = {
        "highest_mean": F.struct((-F.col("mean")).alias("o"), name.alias("name"), F.col("mean").alias("measure")),
        "lowest_mean": F.struct(F.col("mean").alias("o"), name.alias("name"), F.col("mean").alias("measure")),
        "most_rows": F.struct((-F.col("n").cast("double")).alias("o"), name.alias("name"),
                              F.col("n").cast("double").alias("measure")),
    }
    one = groups.agg(*[F.min(s).alias(k) for k, s in extremes.items()])
    rows = F.array(*[F.struct(F.lit(k).alias("extreme"), F.col(k).alias("s")) for k in extremes])
    return one.select(F.inline(rows)).select(
        F.lit(key).alias("group_name"), "extreme", F.col("s.name").alias("group_value"),
        F.col("s.measure").alias("measure"),
    )


def insights(df: DataFrame, value: str, keys=("airline", "route", "seasonality", "travel_class")) -> DataFrame:
    """Extremes of each grouping, and the peak premium."""
    peak = F.col("is_peak_season")
    premium = df.agg(
        round_to(change_pct(avg_if(value, peak), avg_if(value, ~peak)), 2).alias("measure")
    ).select(
        F.lit("is_peak_season").alias("group_name"),
        F.lit("premium_pct").alias("extreme"),
        F.lit("peak over off-peak").alias("group_value"),
        "measure",
    )
    return union_all(*[argmax_group(df, k, value) for k in keys], premium)
