"""Session settings and the shared folder for written intermediate tables."""

import tempfile
import threading
import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

BYTES_PER_SHUFFLE_PARTITION = 1 << 30  # adaptive execution merges what turns out small
#: Writer options of tables that hold all rows: about two thirds of the bytes of the default codec.
COMPACT = {"compression": "zstd"}
#: Whether a query's shuffle files go when it ends.
FREED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

SETTINGS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.parquet.filterPushdown": "true",
}


def build_session(app="fareloom", master=None, shuffle_partitions=None, **more) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = dict(SETTINGS, **{k.replace("__", "."): v for k, v in more.items()})
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def path_size(spark: SparkSession, path: str) -> int:
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.getContentSummary(hadoop_path).getLength() if fs.exists(hadoop_path) else 0


def size_shuffles(spark: SparkSession, *paths: str) -> int:
    """Raise (never lower) the number of shuffle partitions to fit the input; AQE merges small ones."""
    wanted = sum(path_size(spark, p) for p in paths) // BYTES_PER_SHUFFLE_PARTITION
    key = "spark.sql.shuffle.partitions"
    now = int(spark.conf.get(key))
    if wanted > now:
        spark.conf.set(key, str(wanted))
    return max(wanted, now)


def input_size(df: DataFrame) -> int:
    """Bytes of the files a frame is read from; 0 for what is not read from files."""
    from fareloom.sources.tables import table_roots

    return sum(path_size(df.sparkSession, root) for root in table_roots(df))


def shared_dir(spark: SparkSession) -> str:
    """Folder for written intermediate tables: the one the cluster names in spark.checkpoint.dir."""
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get(
        "spark.checkpoint.dir", None
    )
    if not named:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        app = spark.sparkContext.applicationId
        if app not in _local_dirs:
            _local_dirs[app] = tempfile.mkdtemp(prefix="run-", dir="/tmp")
        named = _local_dirs[app]
    return named.rstrip("/")


_local_dirs: dict = {}


def new_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/fareloom/{spark.sparkContext.applicationId}/{name}-{uuid.uuid4().hex}"


@contextmanager
def freeing(spark: SparkSession):
    """Writes in here remove their shuffle files when they end, instead of when the driver next happens to collect garbage."""
    key = spark._jsparkSession.hashCode()
    with _lock:  # writes may run side by side: the first sets it, the last puts it back
        count, before = _writes.get(key) or (0, spark.conf.get(FREED, "false"))
        _writes[key] = count + 1, before
        spark.conf.set(FREED, "true")
    try:
        yield
    finally:
        with _lock:
            count, before = _writes.pop(key)
            if count > 1:
                _writes[key] = count - 1, before
            else:
                spark.conf.set(FREED, before)


_lock, _writes = threading.Lock(), {}


def discard(df: DataFrame) -> None:
    """Remove the files of a frame that ``materialize`` returned and that nothing reads any more."""
    from fareloom.sources.tables import table_roots

    spark = df.sparkSession
    for root in table_roots(df):
        path = spark._jvm.org.apache.hadoop.fs.Path(root)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def materialize(df: DataFrame, name: str, partition_by=(), options=None) -> DataFrame:
    """Write a table to the shared folder and read it back; ``options`` are the writer's.

    Cuts the lineage at something that outlives executors, and gives Catalyst the real size of the
    table, so that it broadcasts only what is below ``spark.sql.autoBroadcastJoinThreshold``.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with freeing(spark):
        df.write.options(**options or {}).partitionBy(*partition_by).parquet(path)
    return spark.read.schema(df.schema).parquet(path)
