"""One load run: CSV extract -> staging -> bronze -> silver -> history -> gold."""

import datetime as dt
import math
import time
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions import fixed
from fareloom.operators import audit, gold, incremental, quality, scd, sketches
from fareloom.operators.silver import silver_clean
from fareloom.operators.validate import validate_rows
from fareloom.sources import files
from fareloom.session import path_size
from fareloom.sources.ledger import Ledger, schema_of
from fareloom.sources.tables import dataset_metadata, latest_row

STAGING, BRONZE = "validated_flights", "bronze_validated_flights"
METADATA, PROFILES = "dataset_metadata", "bronze_profiles"
SILVER, LOG = "silver_cleaned_flights", "load_log"
AUDIT = "audit_log"


def stage(df: DataFrame) -> DataFrame:
    """A scanned extract renamed, coerced and validated."""
    return validate_rows(files.coerce_types(files.rename_columns(df).drop(files.CORRUPT)))


def with_ids(staged: DataFrame, at) -> DataFrame:
    """An id per row: its content, the load, and its place among the rows (copies differ by place).

    The place is fixed once the staging table is written; nothing is numbered across tasks.
    """
    if "id" in staged.columns:
        return staged
    content = F.md5(F.to_json(F.struct(F.lit(str(at)), *staged.columns)))
    return staged.withColumn("id", F.concat_ws("-", content, F.monotonically_increasing_id()))


def typed(extract: DataFrame, last: dict | None, known: T.StructType) -> tuple[DataFrame, list[str]]:
    """An extract whose columns beyond the usual ones have types, and the names of those not seen before.

    ``last`` is the metadata row of the file before, ``known`` the schema of bronze. Types are taken from all values of a
    column that bronze does not have or keeps as something narrower than text; other columns stay as they came.
    """
    df = files.rename_columns(extract)
    usual = {"id", *fixed.CSV_HEADERS.values(), files.CORRUPT}
    kinds = {f.name: f.dataType for f in known.fields}
    own = [c for c in df.columns if c not in usual and not isinstance(kinds.get(c), T.StringType)]
    texts = [c for c in own if isinstance(df.schema[c].dataType, T.StringType)]
    if texts:
        found = files.infer_text_types(df, texts)
        df = df.withColumns({c: files.present(c).try_cast(files.SPARK_TYPES[found[c]]) for c in texts})
    fresh = [c for c in own if c not in kinds] if last is not None else []
    return df, fresh


def load(ledger: Ledger, extract: DataFrame, at, token=None, source_file=None, size=0) -> dict:
    """Stage an extract, apply it to bronze, log it and describe its file: one commit, so that all show it or none does.

    New columns get types and go through all layers; a type that proves too narrow is widened. ``token`` (a name and a
    number that grows) is kept with the commit: a call with a number that is done is a no-op. ``size`` is that of the file.
    """
    if token and ledger.state()["tokens"].get(token[0], 0) >= token[1]:
        return {"load_type": "NONE", "records_inserted": 0, "records_deleted": 0, "change_percentage": 0.0}
    began, commit = time.monotonic(), ledger.begin()
    previous = commit.read(METADATA) if METADATA in commit.tables else None
    last = latest_row(previous, "id").first() if previous is not None else None
    known = schema_of(commit.tables[BRONZE]) if BRONZE in commit.tables else T.StructType()
    extract, fresh = typed(extract, last and last.asDict(), known)
    commit.overwrite(STAGING, with_ids(stage(extract), at))
    commit.append(METADATA, dataset_metadata(extract, source_file, size, fresh, previous, at))
    incoming = incremental.with_hash(commit.read(STAGING).where("is_valid"))
    stats = incremental.load_into(commit, BRONZE, incoming, at, profile=PROFILES)
    counted = ledger.spark.createDataFrame([tuple(stats.values())], incremental.STATS)
    seconds = math.ceil(time.monotonic() - began)
    commit.append(LOG, incremental.load_log_row(counted, commit.number, at, source_file, seconds))
    commit.finish(token)
    return stats


def bronze_profile(ledger: Ledger) -> DataFrame:
    """NULLs, distinct values, extremes and quartiles of all bronze rows, from the sketches that the loads left."""
    return sketches.profile(sketches.merged(ledger.read(PROFILES)))


def build(ledger: Ledger, at, domestic=fixed.DOMESTIC_CODES) -> dict:
    """Silver once, then the histories, the gold tables and the checks from the written silver, in one commit."""
    commit = ledger.begin()
    commit.overwrite(SILVER, silver_clean(commit.read(BRONZE), domestic, at))
    silver = commit.read(SILVER)
    for name, summary, key, checks, hard in (
        ("flight_fare_snapshot", scd.scd_fare_summary, "fare_key", scd.FARE_CHECKS, True),
        ("route_fare_snapshot", scd.scd_route_summary, "route_key", scd.ROUTE_CHECKS, False),
    ):
        scd.merge_into(commit, name, summary(silver), key, checks, at, hard)
    for name, fn in gold.GOLD_TABLES.items():
        commit.overwrite(name, fn(silver))
    tables = {name: commit.read(name) for name in gold.GOLD_TABLES}
    commit.overwrite("data_quality_checks", quality.dq_silver(silver).unionByName(quality.dq_gold(tables)))
    commit.finish()
    return {SILVER: silver, **tables, "data_quality_checks": commit.read("data_quality_checks")}


@contextmanager
def logged(ledger: Ledger, run: str, task: str):
    """Audit rows of a task: started, then completed or failed with the error. The body may set ``rows``.

    Each row is a commit; its number is the id of the row, so no two rows have the same.
    """
    spark, about = ledger.spark, {}

    def note(status, **more):
        now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        commit = ledger.begin()
        commit.append(AUDIT, audit.audit_row(spark, commit.number, "load_run", run, task, status, now, **more))
        commit.finish()

    note("started")
    try:
        yield about
    except Exception as error:
        note("failed", error=f"{type(error).__name__}: {error}"[:1000])
        raise
    note("completed", rows=about.get("rows"))


def load_run(spark: SparkSession, root: str, csv_path: str, at, domestic=fixed.DOMESTIC_CODES) -> dict:
    """Load an extract; rebuild what depends on bronze only if something changed."""
    ledger = Ledger(spark, root)
    run = str(at)
    with logged(ledger, run, "load") as task:
        stats = load(ledger, files.scan_csv(spark, csv_path), at, source_file=csv_path, size=path_size(spark, csv_path))
        task["rows"] = stats["records_inserted"] + stats["records_deleted"]
    last = spark.createDataFrame(
        [(stats["load_type"], float(stats["change_percentage"]), stats["records_inserted"], stats["records_deleted"])],
        "load_type string, change_percentage double, records_inserted bigint, records_deleted bigint",
    )
    gate = incremental.process_gate(last).first()
    if gate["should_process"]:
        with logged(ledger, run, "build"):
            build(ledger, at, domestic)
    return {**stats, "processed": gate["should_process"], "reason": gate["reason"]}
