"""Type-2 history: summaries, merge, and the views over the versions."""

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fareloom.functions.numbers import aggregate, change_pct, round_to, sql_count, sql_round
from fareloom.operators.gold import EXTREMES, TOTAL, avg2
from fareloom.session import input_size, materialize
from fareloom.sources.ledger import Commit, bucket_of

FARE_CHECKS = ("avg_base_fare", "avg_total_fare", "booking_count")
ROUTE_CHECKS = ("avg_fare", "total_bookings", "direct_flight_pct")
SCD_COLUMNS = ("valid_from", "valid_to", "scd_id", "updated_at")


def _key(*parts):
    """Parts joined by ``|``; NULL when any part is NULL."""
    texts = [F.col(parts[0])]
    for p in parts[1:]:
        texts += [F.lit("|"), F.col(p)]
    return F.concat(*texts)


def scd_fare_summary(silver: DataFrame) -> DataFrame:
    keys = [
        "airline", "route", "source_code", "destination_code", "travel_class", "seasonality", "route_type",
    ]
    measures = {
        "booking_count": sql_count(),
        "avg_base_fare": avg2("base_fare_bdt"),
        "avg_total_fare": avg2(TOTAL),
        **EXTREMES,
        "avg_duration_hrs": avg2("duration_hrs"),
    }
    key = _key("airline", "route", "travel_class", "seasonality")
    return aggregate(silver, keys, measures).select(key.alias("fare_key"), "*")


def scd_route_summary(silver: DataFrame) -> DataFrame:
    keys = ["route", "source_code", "source_name", "destination_code", "destination_name", "route_type"]
    measures = {
        "total_bookings": sql_count(),
        "avg_fare": avg2(TOTAL),
        **EXTREMES,
        "avg_duration": avg2("duration_hrs"),
        "direct_flight_pct": sql_round(f"{sql_count('num_stops = 0')} / count(1) * 100"),
        "economy_bookings": sql_count("travel_class = 'Economy'"),
        "business_bookings": sql_count("travel_class = 'Business'"),
        "first_bookings": sql_count("travel_class = 'First'"),
    }
    return aggregate(silver, keys, measures).select(_key("route", "route_type").alias("route_key"), "*")


def scd2_start(incoming: DataFrame, key: str, as_of) -> DataFrame:
    """The first snapshot: every row is an open version."""
    return _one_per_key(incoming, key).withColumns(_opened(key, as_of))


def _opened(key, as_of):
    stamp = F.lit(as_of).cast("timestamp_ntz")
    return {
        "valid_from": stamp,
        "valid_to": F.lit(None).cast("timestamp_ntz"),
        "scd_id": F.md5(F.concat(F.coalesce(key, F.lit("")), F.lit("|"), stamp.cast("string"))),
        "updated_at": stamp,
    }


def _one_per_key(incoming: DataFrame, key: str) -> DataFrame:
    """Fails the job on a repeated key. The count uses the partitioning that the merge needs anyway."""
    n = F.count(F.lit(1)).over(W.partitionBy(key))
    error = F.raise_error(F.concat(F.lit(f"repeated {key}: "), F.col(key))).cast("string")
    checked = F.when(F.col(key).isNull() | (F.col("__n") == 1), F.col(key)).otherwise(error)
    return incoming.withColumn("__n", n).withColumn(key, checked).drop("__n")


def _matched(old: DataFrame, incoming: DataFrame, columns, key: str, checks, as_of, hard_deletes: bool) -> DataFrame:
    """(old, new, closes, opens): the open versions next to the input, and what becomes of each pair."""
    new = _one_per_key(incoming.select(*[c for c in columns if c not in SCD_COLUMNS]), key).withColumns(_opened(F.col(key), as_of))
    new = new.select(F.struct(*columns).alias("new"))
    joined = old.select(F.struct(*old.columns).alias("old")).join(new, F.col(f"old.{key}") == F.col(f"new.{key}"), "full")
    differs = F.lit(False)
    for c in checks:
        differs = differs | ~F.col(f"old.{c}").eqNullSafe(F.col(f"new.{c}"))
    has_old, has_new = F.col("old").isNotNull(), F.col("new").isNotNull()
    missing = has_old & ~has_new
    closes = (has_old & has_new & differs) | (missing if hard_deletes else F.lit(False))
    return joined.select("old", "new", closes.alias("closes"), (has_new & (~has_old | differs)).alias("opens"))


def scd2_merge(history: DataFrame, incoming: DataFrame, key: str, checks, as_of, hard_deletes=False) -> DataFrame:
    """History after a snapshot run, as one frame.

    New key: open a version. A check column differs (NULL-safe): close the old version at the run
    time and open a new one. Missing key: close its version if ``hard_deletes``. Else nothing moves.
    One full outer join of the open versions with the input; each pair gives one or two rows.
    """
    stamp = F.lit(as_of).cast("timestamp_ntz")
    joined = _matched(history.where("valid_to IS NULL"), incoming, history.columns, key, checks, as_of, hard_deletes)
    closed = F.col("old").withField("valid_to", stamp).withField("updated_at", stamp)
    before = F.when(F.col("closes"), closed).when(F.col("old").isNotNull(), F.col("old"))
    after = F.when(F.col("opens"), F.col("new"))
    moved = joined.select(F.inline(F.array_compact(F.array(before, after))))
    return history.where("valid_to IS NOT NULL").unionByName(moved)


OPEN, CLOSED = "open", "closed"


def merge_into(commit: Commit, name: str, incoming: DataFrame, key: str, checks, as_of, hard_deletes=False) -> None:
    """``scd2_merge`` for a history in a ledger, kept in buckets of the key and split into open and closed versions.

    The input meets only keys and checks of the open versions; what closes or opens is written to a table of its own.
    Closed versions are never read or written again; of the open ones only buckets with a version that closes are.
    """
    if name not in commit.tables:
        commit.create(name, key, input_size(incoming))
        commit.append(name, scd2_start(incoming, key, as_of), OPEN)
        return
    live = commit.read(name, OPEN)
    moved = _matched(live.select(key, *checks), incoming, live.columns, key, checks, as_of, hard_deletes).where("closes OR opens")
    moved = materialize(moved, "moved-versions")
    gone = moved.where("closes").select(F.col(f"old.{key}").alias("__gone"))
    lose = gone.select(bucket_of("__gone", commit.tables[name]["buckets"]).alias("bucket")).distinct().collect()  # at most the buckets
    touched = {r["bucket"] for r in lose} | commit.crowded(name, OPEN)
    if touched:
        rows, same = commit.read(name, OPEN, touched), F.col(key).eqNullSafe(F.col("__gone"))
        stamp = F.lit(as_of).cast("timestamp_ntz")
        commit.append(name, rows.join(gone, same, "left_semi").withColumns({"valid_to": stamp, "updated_at": stamp}), CLOSED)
        commit.rewrite(name, rows.join(gone, same, "left_anti"), OPEN, touched)
    commit.append(name, moved.where("opens").select("new.*"), OPEN)


def _views(history: DataFrame, key: str, as_of):
    end = F.coalesce("valid_to", F.lit(as_of).cast("timestamp_ntz"))
    versions = W.partitionBy(key)
    return {
        "is_current": F.col("valid_to").isNull(),
        "record_status": F.when(F.col("valid_to").isNull(), "Current").otherwise("Historical"),
        "days_active": F.timestamp_diff("DAY", F.col("valid_from"), end).cast("int"),
        "version_number": F.row_number().over(versions.orderBy("valid_from")),
        "total_versions": F.count(F.lit(1)).over(versions),
    }


def fare_history(history: DataFrame, as_of) -> DataFrame:
    """Versions with status, whole days active and numbering.

    A key has one version per run at most (repeated keys fail), which bounds the window partitions.
    """
    views = _views(history, "fare_key", as_of)
    return history.select(
        "fare_key", "airline", "route", "source_code", "destination_code", "travel_class",
        "seasonality", "route_type", "booking_count", "avg_base_fare", "avg_total_fare", "min_fare",
        "max_fare", "valid_from", "valid_to", *[c.alias(name) for name, c in views.items()],
    )


def route_history(history: DataFrame) -> DataFrame:
    views = _views(history, "route_key", None)
    return history.select(
        "route_key", "route", "source_code", "source_name", "destination_code", "destination_name",
        "route_type", "total_bookings", "avg_fare", "min_fare", "max_fare", "avg_duration",
        "direct_flight_pct", "economy_bookings", "business_bookings", "first_bookings",
        "valid_from", "valid_to",
        *[views[name].alias(name) for name in ("is_current", "record_status", "version_number")],
    )


def history_change(history: DataFrame, key: str, measure: str) -> DataFrame:
    """Each version's measure next to that of the version before, with the change in per cent."""
    previous = F.lag(measure).over(W.partitionBy(key).orderBy("valid_from"))
    return history.select(
        key,
        F.col(measure).alias("current_value"),
        previous.alias("previous_value"),
        "valid_from",
        "valid_to",
    ).withColumn("change_pct", round_to(change_pct("current_value", "previous_value"), 2))
