"""Tables kept as Parquet: versioned layers for rewrites, plain folders for logs."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fareloom.session import COMPACT


class Store:
    """A root folder with one folder per table and one sub-folder per complete version.

    A rewrite never touches the version being read: it writes the next one, which counts from the
    moment Spark's ``_SUCCESS`` file is in place. A writer that dies leaves the old version current.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def _children(self, name: str) -> list[int]:
        hadoop = self.spark._jvm.org.apache.hadoop.fs.Path
        path = hadoop(f"{self.root}/{name}")
        fs = path.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not fs.exists(path):
            return []
        names = [s.getPath().getName() for s in fs.listStatus(path)]
        return sorted(
            int(n.split("=")[1])
            for n in names
            if n.startswith("version=") and fs.exists(hadoop(f"{path}/{n}/_SUCCESS"))
        )

    def version(self, name: str) -> int | None:
        versions = self._children(name)
        return versions[-1] if versions else None

    def exists(self, name: str) -> bool:
        return self.version(name) is not None

    def read(self, name: str, version: int | None = None) -> DataFrame:
        version = self.version(name) if version is None else version
        if version is None:
            raise FileNotFoundError(f"no complete version of {name} under {self.root}")
        path = f"{self.root}/{name}/version={version}"
        # the footers of all files are opened only where appended rows had other columns
        return self.spark.read.option("mergeSchema", self._mixed(path).exists()).parquet(path)

    def _mixed(self, path: str) -> "Marker":
        return Marker(self.spark, f"{path}/_files_differ")

    def overwrite(self, name: str, df: DataFrame, version=None, partition_by=()) -> DataFrame:
        """Truncate-and-reload. Writing a version that is already complete changes nothing."""
        if version is None:
            version = (self.version(name) or 0) + 1
        if version not in self._children(name):
            path = f"{self.root}/{name}/version={version}"
            df.write.mode("overwrite").options(**COMPACT).partitionBy(*partition_by).parquet(path)
        return self.read(name, version)

    def append(self, name: str, df: DataFrame) -> DataFrame:
        """Add rows to the current version (logs and staging). New columns widen the table."""
        version = self.version(name) or 1
        path = f"{self.root}/{name}/version={version}"
        if self.exists(name) and set(self.read(name, version).columns) != set(df.columns):
            self._mixed(path).put()
        df.write.mode("append").options(**COMPACT).parquet(path)
        return self.read(name, version)


class Marker:
    """An empty file that says something by being there."""

    def __init__(self, spark: SparkSession, path: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path(path)
        self.fs = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.fs.exists(self.path)

    def put(self) -> None:
        self.fs.create(self.path, True).close()


def read_where(df: DataFrame, columns=None, where=None, limit=None) -> DataFrame:
    """Projection, predicate and an optional row limit; the first two reach the Parquet scan."""
    if where is not None:
        df = df.where(where)
    if columns:
        df = df.select(*columns)
    return df.limit(limit) if limit else df


def table_roots(df: DataFrame) -> list[str]:
    """The folders that a frame's files were read from, without listing the files."""
    leaves = df._jdf.queryExecution().analyzed().collectLeaves()
    out = set()
    for i in range(leaves.size()):
        leaf = leaves.apply(i)
        if leaf.getClass().getSimpleName() == "LogicalRelation" and leaf.relation().getClass().getSimpleName() == "HadoopFsRelation":
            roots = leaf.relation().location().rootPaths()
            out |= {roots.apply(k).toString() for k in range(roots.size())}
    return sorted(out)


def layer_catalog(spark: SparkSession, layers: dict) -> DataFrame:
    """One row per table: layer, name, columns, rows and bytes on storage."""
    from fareloom.session import path_size

    out = None
    for (layer, name), df in sorted(layers.items()):
        size = sum(path_size(spark, root) for root in table_roots(df))
        row = df.agg(F.count(F.lit(1)).alias("row_count")).select(
            F.lit(layer).alias("layer"),
            F.lit(name).alias("table_name"),
            F.lit(len(df.columns)).alias("column_count"),
            "row_count",
            F.lit(size).cast("bigint").alias("size_bytes"),
        )
        out = row if out is None else out.unionByName(row)
    return out


def latest_row(df: DataFrame, order: str) -> DataFrame:
    """The newest row, as one aggregate instead of a sort."""
    row = F.struct(*[F.col(c) for c in df.columns])
    return df.agg(F.max_by(row, F.col(order)).alias("r")).where("r IS NOT NULL").select("r.*")


def dataset_metadata(df: DataFrame, file_name: str, file_size: int, new_columns, previous, at, counted: DataFrame | None = None) -> DataFrame:
    """One row describing a received file; ``previous`` is the metadata table so far, or None.

    ``counted`` has the file's rows as its one ``row_count``, where they were counted before.
    """
    from fareloom.sources.files import CORRUPT, schema_hash

    fields = [f for f in df.schema.fields if f.name != CORRUPT]
    types = F.to_json(
        F.create_map(*[F.lit(x) for f in fields for x in (f.name, f.dataType.simpleString())])
    )
    counted = df.agg(F.count(F.lit(1)).alias("row_count")) if counted is None else counted
    row = counted.select(
        F.lit(file_name).cast("string").alias("file_name"),
        F.lit(at).cast("timestamp_ntz").alias("download_timestamp"),
        F.lit(file_size).cast("bigint").alias("file_size_bytes"),
        "row_count",
        F.lit(len(fields)).alias("column_count"),
        types.alias("columns_json"),
        schema_hash([f.name for f in fields]).alias("schema_hash"),
        F.lit(bool(new_columns)).alias("schema_changed"),
        F.lit(", ".join(new_columns) or None).cast("string").alias("new_columns_added"),
    )
    if previous is None:
        last = df.sparkSession.range(1).select(F.lit(None).cast("bigint").alias("previous_metadata_id"))
    else:
        last = previous.agg(F.max("id").alias("previous_metadata_id"))
    return row.crossJoin(F.broadcast(last)).select(
        (F.coalesce("previous_metadata_id", F.lit(0)) + 1).cast("bigint").alias("id"), "*"
    )
