"""The load and the scoring as Structured Streaming jobs over a drop folder."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.operators.features import FeatureModel
from fareloom.operators.score import batch_score
from fareloom.plans.load import load
from fareloom.session import path_size
from fareloom.sources.files import CORRUPT, scan_csv
from fareloom.sources.ledger import Ledger

READY = "ready"
#: Extracts of a batch at most.
EXTRACTS = 16


def announce(spark: SparkSession, drop_dir: str, extract: str) -> None:
    """Say that the folder ``drop_dir``/``extract`` is complete: one small file in ``drop_dir``/ready."""
    spark.range(1).select(F.lit(extract).alias("value")).coalesce(1).write.mode("append").text(f"{drop_dir}/{READY}")


def read_drops(spark: SparkSession, drop_dir: str) -> DataFrame:
    """Names of complete extracts as they are announced. An extract is a folder of any number of CSV files."""
    notes = spark.readStream.schema("value string").option("maxFilesPerTrigger", EXTRACTS).text(f"{drop_dir}/{READY}")
    return notes.select("value", F.col("_metadata.file_modification_time").alias("announced"))


def stream_ingest(spark: SparkSession, drop_dir: str, ledger: Ledger, checkpoint: str, stamp):
    """Apply the announced extracts to bronze, in order of arrival, and stop when all are done.

    A batch takes up to ``EXTRACTS`` of them. Each is one commit of staging, bronze and log, under a token that counts
    extracts: a batch that is replayed after a failure passes over those that were committed and goes on with the
    next. ``stamp`` gives the load time of the extract of a number, from 0.
    """

    def apply(batch: DataFrame, batch_id: int):
        names = [r["value"] for r in batch.orderBy("announced", "value").collect()]  # at most EXTRACTS
        for place, name in enumerate(names):
            number = batch_id * EXTRACTS + place
            path = f"{drop_dir}/{name}"
            load(ledger, scan_csv(spark, path).drop(CORRUPT), stamp(number), ("stream", number + 1), name, path_size(spark, path))

    return (
        read_drops(spark, drop_dir)
        .writeStream.foreachBatch(apply)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )


def stream_score(requests: DataFrame, features: FeatureModel, model, selected, rmse=None) -> DataFrame:
    """Scores for a streaming frame of requests: the batch plan, with the look-up tables static."""
    return batch_score(requests, features, model, selected, rmse)
