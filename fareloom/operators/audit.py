"""The run log and the questions asked of it."""

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions import bands
from fareloom.functions.numbers import round_to

AUDIT_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType()),
        T.StructField("dag_id", T.StringType()),
        T.StructField("dag_run_id", T.StringType()),
        T.StructField("task_id", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("started_at", T.TimestampNTZType()),
        T.StructField("completed_at", T.TimestampNTZType()),
        T.StructField("rows_processed", T.LongType()),
        T.StructField("rows_failed", T.LongType()),
        T.StructField("error_message", T.StringType()),
        T.StructField("metadata", T.StringType()),
    ]
)


def audit_row(spark: SparkSession, id, dag_id, run_id, task_id, status, at, rows=None, failed=None,
              error=None, metadata=None) -> DataFrame:
    """One event: a started row carries the start time, any other the end time."""
    started = at if status == "started" else None
    completed = None if status == "started" else at
    text = json.dumps(metadata) if metadata else None
    row = (id, dag_id, run_id, task_id, status, started, completed, rows, failed, error, text)
    return spark.createDataFrame([row], AUDIT_SCHEMA)


def audit_recent(audit: DataFrame, n=10) -> DataFrame:
    return audit.orderBy(F.col("id").desc()).limit(n).select(
        "id", "task_id", "status", "rows_processed", "started_at"
    )


def audit_failed(audit: DataFrame) -> DataFrame:
    return audit.where("status = 'failed'").select("id", "task_id", "error_message", "completed_at")


def audit_avg_duration(audit: DataFrame) -> DataFrame:
    """Mean seconds per task. Start and end are separate rows, so they are brought together per run."""
    runs = audit.groupBy("dag_id", "dag_run_id", "task_id").agg(
        F.max(F.when(F.col("status") == "started", F.col("started_at"))).alias("started_at"),
        F.max(F.when(F.col("status") == "completed", F.col("completed_at"))).alias("completed_at"),
    )
    seconds = F.timestamp_diff("SECOND", F.col("started_at"), F.col("completed_at"))
    return (
        runs.where("completed_at >= started_at")
        .groupBy("task_id")
        .agg(F.count(F.lit(1)).alias("runs"), round_to(F.avg(seconds), 2).alias("avg_seconds"))
    )


def change_levels(load_log: DataFrame) -> DataFrame:
    return load_log.select(
        "load_timestamp", "change_percentage", bands.change_level("change_percentage").alias("change_level")
    )
