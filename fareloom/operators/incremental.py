"""Change detection by record hash, and the two ways of applying a load."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions import fixed
from fareloom.functions.numbers import round_to
from fareloom.functions.text import number_text, time_text
from fareloom.operators import sketches
from fareloom.operators.joins import LOOKUP_ROWS
from fareloom.session import discard, input_size, materialize
from fareloom.sources.ledger import Commit, bucket_of


def record_hash(df: DataFrame, fields=fixed.HASH_FIELDS):
    """MD5 over the text of the fields. Columns outside the list can change without being seen."""
    kinds = {f.name: f.dataType for f in df.schema.fields}
    texts = []
    for c in fields:
        kind = kinds.get(c)
        if kind is None:
            text = F.lit("")
        elif isinstance(kind, (T.TimestampType, T.TimestampNTZType)):
            text = time_text(c)
        elif isinstance(kind, (T.FractionalType, T.DecimalType)):
            text = number_text(c)
        else:
            text = F.col(c).cast("string")
        texts.append(F.coalesce(text, F.lit("None")))
    return F.md5(F.concat_ws("|", *texts))


def with_hash(df: DataFrame, fields=fixed.HASH_FIELDS) -> DataFrame:
    return df.withColumn("record_hash", record_hash(df, fields))


def to_bronze(valid: DataFrame, ingested_at, fields=fixed.HASH_FIELDS) -> DataFrame:
    """Valid rows with hash, load time and the active flag."""
    return with_hash(valid, fields).withColumns(
        {"ingestion_timestamp": F.lit(ingested_at).cast("timestamp_ntz"), "is_active": F.lit(True)}
    )


def active(bronze: DataFrame) -> DataFrame:
    return bronze.where("is_active")


def hash_status(incoming: DataFrame, bronze: DataFrame) -> DataFrame:
    """One row per distinct hash: status and the number of rows on either side.

    Copies of a record are counted map-side, so each hash is joined once however many copies of it
    there are.
    """
    new = incoming.groupBy("record_hash").agg(F.count(F.lit(1)).alias("incoming_rows"))
    old = active(bronze).groupBy("record_hash").agg(F.count(F.lit(1)).alias("existing_rows"))
    status = (
        F.when(F.col("existing_rows").isNull(), "new")
        .when(F.col("incoming_rows").isNull(), "deleted")
        .otherwise("unchanged")
    )
    return new.join(old, "record_hash", "full").select(
        "record_hash",
        status.alias("status"),
        F.coalesce("incoming_rows", F.lit(0)).alias("incoming_rows"),
        F.coalesce("existing_rows", F.lit(0)).alias("existing_rows"),
    )


def change_stats(incoming: DataFrame, bronze: DataFrame) -> DataFrame:
    """One row: counts, change percentage and load mode.

    An empty input changes nothing (mode NONE, no deletes); on an empty target all rows are new.
    """
    return stats_of(hash_status(incoming, bronze))


def stats_of(status: DataFrame) -> DataFrame:
    """``change_stats`` of what ``hash_status`` found."""
    def rows(status, side):
        return F.coalesce(F.sum(F.when(F.col("status") == status, F.col(side))), F.lit(0))

    counts = status.agg(
        rows("new", "incoming_rows").alias("records_inserted"),
        rows("deleted", "existing_rows").alias("records_deleted"),
        rows("unchanged", "incoming_rows").alias("records_unchanged"),
        F.coalesce(F.sum("incoming_rows"), F.lit(0)).alias("incoming_rows"),
        F.coalesce(F.sum("existing_rows"), F.lit(0)).alias("existing_rows"),
    )
    changed = F.col("records_inserted") + F.col("records_deleted")
    pct = (
        F.when(F.col("incoming_rows") == 0, 0.0)
        .when(F.col("existing_rows") == 0, 100.0)
        .otherwise(100.0 * changed / F.nullif("incoming_rows", F.lit(0)))
    )
    return counts.withColumn("change_percentage", pct).withColumn("load_type", load_mode())


#: Columns of ``change_stats``.
STATS = (
    "records_inserted bigint, records_deleted bigint, records_unchanged bigint, incoming_rows bigint, existing_rows bigint, "
    "change_percentage double, load_type string"
)


def load_mode():
    """FULL strictly above the threshold, NONE without input."""
    return (
        F.when(F.col("incoming_rows") == 0, "NONE")
        .when(F.col("change_percentage") > fixed.FULL_LOAD_ABOVE_PCT, "FULL")
        .otherwise("INCREMENTAL")
    )


def _all_new(incoming: DataFrame) -> DataFrame:
    """What ``stats_of`` needs of a load into an empty table: no hash has to be compared."""
    n = F.count(F.lit(1)).alias("incoming_rows")
    return incoming.agg(n).select(F.lit("new").alias("status"), "incoming_rows", F.lit(0).cast("bigint").alias("existing_rows"))


def _hashes(df: DataFrame) -> DataFrame:
    return df.select("record_hash").distinct()


def new_rows(incoming: DataFrame, bronze: DataFrame) -> DataFrame:
    """Rows whose hash no active row has. Hashes are nearly unique; adaptive execution splits the copies of one."""
    return incoming.join(_hashes(active(bronze)), "record_hash", "left_anti")


def deleted_rows(incoming: DataFrame, bronze: DataFrame) -> DataFrame:
    return active(bronze).join(_hashes(incoming), "record_hash", "left_anti")


def unchanged_rows(incoming: DataFrame, bronze: DataFrame) -> DataFrame:
    return incoming.join(_hashes(active(bronze)), "record_hash", "left_semi")


def apply_incremental(incoming: DataFrame, bronze: DataFrame, ingested_at) -> DataFrame:
    """Bronze after the load as one frame: new rows added, vanished rows inactive, history kept.

    The result has to go to a new version of the table; applying the same input again is a no-op. ``load_into`` does
    the same to a table in buckets and writes only those that change.
    """
    stamp = F.lit(ingested_at).cast("timestamp_ntz")
    marked = bronze.join(_hashes(incoming).withColumn("__seen", F.lit(True)), "record_hash", "left")
    gone = F.col("is_active") & F.col("__seen").isNull()
    kept = marked.withColumns(
        {
            "ingestion_timestamp": F.when(gone, stamp).otherwise(F.col("ingestion_timestamp")),
            "is_active": F.col("is_active") & F.col("__seen").isNotNull(),
        }
    ).drop("__seen")
    added = new_rows(incoming, bronze).withColumns(
        {"ingestion_timestamp": stamp, "is_active": F.lit(True)}
    )
    return kept.unionByName(added, allowMissingColumns=True)


ACTIVE, PAST = "active", "past"


def load_into(commit: Commit, name: str, incoming: DataFrame, ingested_at, mode: str | None = None, profile: str | None = None) -> dict:
    """Apply a load to a table of a ledger, kept in buckets of the hash and split into active and past rows.

    Hashes of both sides meet once, in a written table without other columns; a load into an empty table only counts its rows.
    New rows are added in folders of their own; buckets that lose rows, or have many folders, are written anew, the lost rows
    join the past ones. Up to ``LOOKUP_ROWS`` lost hashes are broadcast, and the rows of a bucket then stay in the tasks that read
    them, unless they lie in many files. Past rows and all other buckets keep their files. A reload replaces the table. Returns the statistics; ``mode`` overrides the load mode.
    ``profile`` names a table that gets sketches of the rows a load adds: merged, they profile all rows since the last
    reload, and only the added ones are read for it.
    """
    if name not in commit.tables:
        commit.create(name, "record_hash")
    live = commit.read(name, ACTIVE)
    known = live if "record_hash" in live.columns else apply_full(incoming, ingested_at).limit(0)
    stats = status = None
    if mode != "INCREMENTAL" and not any(p["split"] == ACTIVE for p in commit.tables[name]["parts"]):
        stats = stats_of(_all_new(incoming)).first().asDict()  # one row
    if stats is None or (mode or stats["load_type"]) == "INCREMENTAL":
        status = materialize(hash_status(incoming, known), "hash-status")
        stats = stats_of(status).first().asDict()
    mode = mode or stats["load_type"]
    if mode == "FULL":
        commit.create(name, "record_hash", input_size(incoming))
        added = commit.append(name, apply_full(incoming, ingested_at), ACTIVE)
        if profile:
            commit.overwrite(profile, sketches.sketch(added))
    elif mode == "INCREMENTAL":
        table = commit.tables[name]
        gone = status.where("status = 'deleted'").select("record_hash")
        lose = gone.groupBy(bucket_of("record_hash", table["buckets"]).alias("bucket")).count().collect()  # at most the buckets
        crowded = commit.crowded(name, ACTIVE)
        touched, few = {r["bucket"] for r in lose} | crowded, sum(r["count"] for r in lose) <= LOOKUP_ROWS
        if touched:
            rows, gone = commit.read(name, ACTIVE, touched), F.broadcast(gone) if few else gone
            stamp = F.lit(ingested_at).cast("timestamp_ntz")
            lost = rows.join(gone, "record_hash", "left_semi").withColumns({"ingestion_timestamp": stamp, "is_active": F.lit(False)})
            deal = not few or bool(crowded) or commit.scattered(name, ACTIVE, touched)
            commit.append(name, lost, PAST)
            commit.rewrite(name, rows.join(gone, "record_hash", "left_anti"), ACTIVE, touched, deal)
        new = status.where("status = 'new'").select("record_hash")
        if new.count() <= LOOKUP_ROWS:
            new = F.broadcast(new)
        added = commit.append(name, apply_full(incoming.join(new, "record_hash", "left_semi"), ingested_at), ACTIVE)
        if profile and stats["records_inserted"]:
            commit.append(profile, sketches.sketch(added))
    if status is not None:
        discard(status)
    return stats


def apply_full(incoming: DataFrame, ingested_at) -> DataFrame:
    """Bronze after a reload: the input alone, all active. Soft-deleted history is dropped."""
    return incoming.withColumns(
        {"ingestion_timestamp": F.lit(ingested_at).cast("timestamp_ntz"), "is_active": F.lit(True)}
    )


def load_log_row(stats: DataFrame, load_id: int, at, source_file=None, seconds=0) -> DataFrame:
    """The load-log entry for a statistics row. An edit is a delete plus an insert: updated is 0."""
    return stats.select(
        F.lit(load_id).cast("bigint").alias("load_id"),
        F.lit(at).cast("timestamp_ntz").alias("load_timestamp"),
        F.lit(source_file).cast("string").alias("source_file"),
        F.col("records_inserted").cast("bigint").alias("records_inserted"),
        F.lit(0).cast("bigint").alias("records_updated"),
        F.col("records_deleted").cast("bigint").alias("records_deleted"),
        F.col("records_unchanged").cast("bigint").alias("records_unchanged"),
        "load_type",
        round_to("change_percentage", 2).alias("change_percentage"),
        F.lit(seconds).cast("bigint").alias("execution_time_seconds"),
    )


LOAD_STATS = (
    "load_timestamp", "load_type", "records_inserted", "records_deleted", "records_unchanged",
    "change_percentage", "execution_time_seconds",
)


def load_stats(log: DataFrame, as_of, days=30, limit=10) -> DataFrame:
    """Loads of the last days, newest first. ``limit=None`` gives all of them."""
    floor = F.lit(as_of).cast("timestamp_ntz") - F.make_dt_interval(F.lit(days))
    out = log.where(F.col("load_timestamp") >= floor).select(*LOAD_STATS)
    out = out.orderBy(F.col("load_timestamp").desc())
    return out.limit(limit) if limit else out


def process_gate(last_load: DataFrame) -> DataFrame:
    """Whether the rest of the run has work to do, and why."""
    changes = F.col("records_inserted") + F.col("records_deleted")
    full = F.col("load_type") == "FULL"
    moved = F.col("change_percentage") >= fixed.PROCESS_FROM_PCT
    return last_load.select(
        "load_type",
        "change_percentage",
        F.coalesce(full | moved | (changes > 0), F.lit(False)).alias("should_process"),
        F.when(full, "Full data reload detected")
        .when(moved, F.concat(F.lit("Data changed by "), number_text("change_percentage"), F.lit("%")))
        .when(changes > 0, F.concat(F.format_number(changes, 0), F.lit(" records changed")))
        .otherwise("No data changes detected")
        .alias("reason"),
    )


def retrain_gate(last_load: DataFrame, last_model: DataFrame, as_of) -> DataFrame:
    """Whether to train again, with all reasons. Both inputs hold one row at most."""
    model = last_model.agg(F.max("training_timestamp").alias("trained_at"))
    load = last_load.agg(
        F.max("load_type").alias("load_type"),
        F.coalesce(F.max("change_percentage"), F.lit(0.0)).alias("change_percentage"),
        F.coalesce(F.max("records_inserted"), F.lit(0)).alias("records_inserted"),
    )
    age = F.timestamp_diff("DAY", F.col("trained_at"), F.lit(as_of).cast("timestamp_ntz"))
    inserted = F.col("records_inserted")
    reasons = F.when(F.col("trained_at").isNull(), "No existing model").otherwise(
        F.concat_ws(
            "; ",
            F.when(
                F.col("change_percentage") >= fixed.RETRAIN_FROM_PCT,
                F.concat(F.lit("Data changed by "), number_text("change_percentage"), F.lit("%")),
            ),
            F.when(
                inserted >= fixed.RETRAIN_FROM_ROWS,
                F.concat(F.format_number(inserted, 0), F.lit(" new records")),
            ),
            F.when(
                age >= fixed.RETRAIN_FROM_DAYS,
                F.concat(F.lit("Model is "), age.cast("string"), F.lit(" days old")),
            ),
            F.when(F.col("load_type") == "FULL", "Full data reload"),
        )
    )
    return (
        load.crossJoin(F.broadcast(model))
        .withColumn("reasons", reasons)
        .select(F.when(F.col("reasons") != "", "retrain").otherwise("skip").alias("decision"), "reasons")
    )
