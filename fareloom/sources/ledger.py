"""Tables in buckets under one ledger: a commit names the folders of all tables, and only touched buckets are written anew."""

import json
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.session import COMPACT, freeing, input_size

#: Bytes a bucket is meant to hold, and parts of a bucket after which the next load merges them.
BUCKET_BYTES, MAX_PARTS = 256 << 20, 16
#: Rows from files of between ``TASK_BYTES`` and ``MAX_TASKS`` times that are not shuffled by bucket: so many tasks at most write them, each a file a bucket.
TASK_BYTES, MAX_TASKS = 128 << 20, 64
BUCKET = "__bucket"


class CommitExists(RuntimeError):
    """Another writer made the commit first; the load has to be worked out anew from what it left."""


def bucket_of(key: str, buckets: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(buckets)).cast("int")


class Ledger:
    """A root folder with ``data`` (folders that are written once) and ``commits`` (a small JSON file each).

    A table has splits (such as active and past rows), each cut into buckets by a hash of its key. A commit lists the
    folders of every table, so that several tables change together, or not at all; readers of an older commit keep its folders
    until ``expire``. What the driver holds is a line a folder: buckets follow the size of the table.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark, self.root = spark, root.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._hadoop(self.root).getFileSystem(spark._jsc.hadoopConfiguration())

    def _names(self, folder: str) -> list[str]:
        path = self._hadoop(f"{self.root}/{folder}")
        return sorted(s.getPath().getName() for s in self._fs.listStatus(path)) if self._fs.exists(path) else []

    def commits(self) -> list[int]:
        return [int(n.split(".")[0]) for n in self._names("commits") if n.endswith(".json")]

    def state(self, commit: int | None = None) -> dict:
        """Tables and tokens as of a commit, the last by default."""
        if commit is None:
            commit = max(self.commits(), default=0)
        if commit == 0:
            return {"commit": 0, "tables": {}, "tokens": {}}
        stream = self._fs.open(self._hadoop(f"{self.root}/commits/{commit:08d}.json"))
        try:
            return json.loads(self.spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def exists(self, name: str) -> bool:
        return name in self.state()["tables"]

    def read(self, name: str, split: str | None = None, buckets=None, commit: int | None = None) -> DataFrame:
        """The rows of a table, or of one split or some buckets of it: other folders are not even listed."""
        return Commit(self, commit).read(name, split, buckets)

    def _frame(self, table: dict, parts: list[dict]) -> DataFrame:
        """Parts are read by the schema they were written with, of which there are few, and cast to the last one."""
        schema = schema_of(table)
        if not parts:
            return self.spark.createDataFrame([], schema)
        out = None
        for number in sorted({p["schema"] for p in parts}):
            written = T.StructType.fromJson(table["schemas"][number])
            kinds = {f.name: f.dataType for f in written.fields}
            paths = [f"{self.root}/data/{p['path']}" for p in parts if p["schema"] == number]
            rows = self.spark.read.schema(written).parquet(*paths)
            if written != schema:
                rows = rows.select(*[
                    (F.col(f.name) if kinds.get(f.name) == f.dataType else F.col(f.name).cast(f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name)
                    for f in schema.fields
                ])
            out = rows if out is None else out.unionByName(rows)
        return out

    def begin(self) -> "Commit":
        return Commit(self)

    def overwrite(self, name: str, df: DataFrame) -> DataFrame:
        """A commit of one table, written whole."""
        commit = self.begin()
        commit.overwrite(name, df)
        commit.finish()
        return self.read(name)

    def append(self, name: str, df: DataFrame) -> DataFrame:
        """A commit that adds rows to one table."""
        commit = self.begin()
        commit.append(name, df)
        commit.finish()
        return self.read(name)

    def expire(self, keep: int = 2) -> list[str]:
        """Remove all but the last ``keep`` commits and the folders that none of them names; returns these.

        Folders of a commit that is being worked on belong to none yet: expire between loads, not during one.
        """
        last = self.commits()[-keep:]
        named = {p["path"] for n in last for t in self.state(n)["tables"].values() for p in t["parts"]}
        used, gone = {path.split("/")[0] for path in named}, []
        for folder in self._names("data"):
            for path in [folder] if folder not in used else [f"{folder}/{b}" for b in self._names(f"data/{folder}") if b.startswith(BUCKET)]:
                if path not in named and (path != folder or folder not in used):
                    self._fs.delete(self._hadoop(f"{self.root}/data/{path}"), True)
                    gone.append(path)
        for n in self.commits():
            if n not in last:
                self._fs.delete(self._hadoop(f"{self.root}/commits/{n:08d}.json"), False)
        return gone


class Commit:
    """Changes to some tables that become visible together with ``finish``."""

    def __init__(self, ledger: Ledger, after: int | None = None):
        self.ledger = ledger
        state = ledger.state(after)
        self.number, self.tables, self.tokens = state["commit"] + 1, state["tables"], state["tokens"]

    def create(self, name: str, key: str | None, size: int = 0) -> None:
        """An empty table, in the place of one of this name. With a key it gets buckets for about ``size`` bytes."""
        buckets = max(8, -(-size // BUCKET_BYTES)) if key else 1
        self.tables[name] = {"key": key, "buckets": buckets, "schemas": [], "parts": []}

    def append(self, name: str, df: DataFrame, split: str = "", deal: bool = True) -> DataFrame:
        """Rows go to folders of their own, a bucket each; returns them as they are read back.

        Without ``deal``, or from a few GB of files at most, rows are not shuffled by bucket before: each task writes a file for
        every bucket it has rows of.

        Columns the table does not have yet are added to it, and a column whose new values its type cannot hold gets a wider one:
        a new version of the schema, by which the old folders are read from then on. Nothing old is written again.
        """
        if name not in self.tables:
            self.create(name, None)
        table = self.tables[name]
        schema = widened(schema_of(table), df.schema)
        if not table["schemas"] or schema != schema_of(table):
            table["schemas"].append(schema.jsonValue())
        number, kinds = len(table["schemas"]) - 1, {f.name: f.dataType for f in df.schema.fields}
        df = df.select(*[
            (F.col(f.name).cast(f.dataType) if f.name in kinds else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.fields
        ])
        folder = f"{name}-{self.number:08d}-{uuid.uuid4().hex}"
        path = f"{self.ledger.root}/data/{folder}"
        if not table["key"]:
            with freeing(self.ledger.spark):
                df.write.options(**COMPACT).parquet(path)
            parts = [{"path": folder, "split": split, "bucket": 0, "schema": number}]
            table["parts"] += parts
            return self.ledger._frame(table, parts)
        rows = df.withColumn(BUCKET, bucket_of(table["key"], table["buckets"]))
        if deal and TASK_BYTES < input_size(df) <= MAX_TASKS * TASK_BYTES:
            rows = rows.coalesce(MAX_TASKS)
        elif deal:  # adaptive execution splits a bucket that copies of one key make large, and merges small ones
            rows = rows.hint("rebalance", BUCKET)
        with freeing(self.ledger.spark):
            rows.write.options(**COMPACT).partitionBy(BUCKET).parquet(path)
        parts = [
            {"path": f"{folder}/{written}", "split": split, "bucket": int(written.split("=")[1]), "schema": number}
            for written in self.ledger._names(f"data/{folder}") if written.startswith(f"{BUCKET}=")
        ]
        table["parts"] += parts
        return self.ledger._frame(table, parts)

    def rewrite(self, name: str, df: DataFrame, split: str, buckets, deal: bool = True) -> None:
        """The rows of these buckets of a split give way to ``df``; all other folders stay as they are."""
        table, touched = self.tables[name], set(buckets)
        table["parts"] = [p for p in table["parts"] if p["split"] != split or p["bucket"] not in touched]
        self.append(name, df, split, deal)

    def overwrite(self, name: str, df: DataFrame) -> None:
        """A table without splits and buckets, written whole."""
        self.create(name, None)
        self.append(name, df)

    def read(self, name: str, split: str | None = None, buckets=None) -> DataFrame:
        """A table as it will be after the commit, or a part of it."""
        parts = [p for p in self.tables[name]["parts"] if (split is None or p["split"] == split) and (buckets is None or p["bucket"] in buckets)]
        return self.ledger._frame(self.tables[name], parts)

    def crowded(self, name: str, split: str) -> set[int]:
        """Buckets that many loads have added a part to."""
        counts: dict = {}
        for p in self.tables[name]["parts"]:
            if p["split"] == split:
                counts[p["bucket"]] = counts.get(p["bucket"], 0) + 1
        return {b for b, n in counts.items() if n > MAX_PARTS}

    def scattered(self, name: str, split: str, buckets) -> bool:
        """Whether these buckets lie in more than ``MAX_PARTS`` files each, on average."""
        return len(self.read(name, split, buckets).inputFiles()) > MAX_PARTS * len(buckets)

    def finish(self, token: tuple[str, int] | None = None) -> int:
        """Make the changes visible: one file, which appears whole under the next number or not at all."""
        if token:
            self.tokens[token[0]] = token[1]
        text = json.dumps({"commit": self.number, "tables": self.tables, "tokens": self.tokens})
        fs, hadoop, root = self.ledger._fs, self.ledger._hadoop, self.ledger.root
        final = hadoop(f"{root}/commits/{self.number:08d}.json")
        draft = hadoop(f"{root}/commits/.{self.number:08d}-{uuid.uuid4().hex}")
        out = fs.create(draft, False)
        out.write(bytearray(text.encode()))
        out.close()
        if fs.exists(final) or not fs.rename(draft, final):
            fs.delete(draft, False)
            raise CommitExists(f"commit {self.number} of {root}")
        return self.number


def schema_of(table: dict) -> T.StructType:
    """The last version of a table's schema."""
    return T.StructType.fromJson(table["schemas"][-1]) if table["schemas"] else T.StructType()


def wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """A type that holds the values of both: integers to bigint, bigint to decimal, anything else to text."""
    if a == b:
        return a
    if isinstance(a, T.NullType) or isinstance(b, T.NullType):
        return b if isinstance(a, T.NullType) else a
    if isinstance(a, T.IntegralType) and isinstance(b, T.IntegralType):
        return T.LongType()
    exact = [T.DecimalType(19, 0) if isinstance(t, T.IntegralType) else t for t in (a, b)]
    if all(isinstance(t, T.DecimalType) for t in exact):
        scale = max(t.scale for t in exact)
        return T.DecimalType(min(38, max(t.precision - t.scale for t in exact) + scale), scale)
    if all(isinstance(t, (T.FloatType, T.DoubleType)) for t in (a, b)):
        return T.DoubleType()
    return T.StringType()


def widened(old: T.StructType, new: T.StructType) -> T.StructType:
    """The columns of both, each with a type that holds the values of both."""
    kinds, had = {f.name: f.dataType for f in new.fields}, {f.name for f in old.fields}
    kept = [T.StructField(f.name, wider(f.dataType, kinds.get(f.name, f.dataType)), True) for f in old.fields]
    return T.StructType(kept + [T.StructField(f.name, f.dataType, True) for f in new.fields if f.name not in had])
