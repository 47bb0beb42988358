"""CSV in: scan, rename, coerce, compare schemas."""

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from fareloom.functions import fixed
from fareloom.functions.numbers import col
from fareloom.session import path_size

CORRUPT = "_corrupt_record"


def scan_csv(spark: SparkSession, path: str, **options) -> DataFrame:
    """Headered CSV with every field as text. A missing or an empty file is an error."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(hadoop_path):
        raise FileNotFoundError(f"CSV file not found: {path}")
    if path_size(spark, path) == 0:
        raise ValueError(f"CSV file is empty: {path}")
    out = None
    for paths in _by_header(spark, path, options):
        # only the first line of the first file is read here
        header = spark.read.options(header=True, escape='"', **options).csv(paths).columns
        schema = T.StructType([T.StructField(c, T.StringType()) for c in [*header, CORRUPT]])
        part = (
            spark.read.schema(schema)
            .options(header=True, mode="PERMISSIVE", columnNameOfCorruptRecord=CORRUPT, escape='"')
            .options(**options)
            .csv(paths)
        )
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    names = [c for c in out.columns if c != CORRUPT]
    return out.select(*[F.col(f"`{c}`") for c in [*names, CORRUPT]])


def _by_header(spark: SparkSession, path: str, options) -> list[list[str]]:
    """Files grouped by their first line: files of one folder may have other columns, or another order of them.

    Only the first lines are read, by the driver, file by file; where the options name line ends or an encoding, a pass over
    all lines finds them: a file's first line is the first row of its first split, which one task reads in order. Where all
    files agree the folder is read as one.
    """
    if not {o.lower() for o in options} & {"linesep", "encoding", "charset"}:
        by: dict = {}
        for file in sorted(spark.read.text(path).inputFiles()):
            place = spark._jvm.org.apache.hadoop.fs.Path(spark._jvm.java.net.URI(file))  # a listed file is a URI
            line = _first_line(spark, place)
            if line is not None:
                by.setdefault(line, []).append(place.toString())
        return [by[line] for line in sorted(by)] if len(by) > 1 else [[path]]
    lines = spark.read.options(**{k: v for k, v in options.items() if k in ("lineSep", "encoding")}).text(path)
    first = (
        lines.select(F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("at"), "value")
        .where("at = 0").groupBy("file").agg(F.first("value").alias("header"))
    )
    heads = [r["header"] for r in first.select("header").distinct().orderBy("header").collect()]
    if len(heads) < 2:
        return [[path]]
    return [[r["file"] for r in first.where(F.col("header") == h).orderBy("file").collect()] for h in heads]


def _first_line(spark: SparkSession, path) -> str | None:
    """The first line of the file at a Hadoop path; None if it is empty."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(conf).getCodec(path)
    stream = path.getFileSystem(conf).open(path)
    try:
        plain = stream if codec is None else codec.createInputStream(stream)
        line = jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, "UTF-8")).readLine()
    finally:
        stream.close()
    return line if line is None else line.removeprefix("\ufeff")


def field_name(header: str) -> str:
    known = fixed.CSV_HEADERS.get(header)
    return known or re.sub(r"[()]", "", header.lower().replace(" ", "_"))


def rename_columns(df: DataFrame) -> DataFrame:
    """Known headers to their field names; others lower-case, with ``_`` for blanks and no brackets."""
    return df.withColumnsRenamed({c: field_name(c) for c in df.columns})


def _keyword_name(name: str) -> str:
    """The first name whose words fit. A header that is a name as a whole holds none of the words."""
    fits = (to for need, without, to in fixed.KEYWORD_NAMES if all(w in name for w in need) and not any(w in name for w in without))
    return next(fits, fixed.WHOLE_NAMES.get(name, name))


def rename_snake(df: DataFrame) -> DataFrame:
    """Analysts' renaming: snake case, index columns dropped, keyword names, first duplicate kept."""
    snake = [c.strip().lower().replace(" ", "_").replace("&", "and") for c in df.columns]
    numbered = df.toDF(*[f"c{i}" for i in range(len(snake))])
    kept = {}
    for i, name in enumerate(snake):
        if "unnamed" not in name and name != "index":
            kept.setdefault(_keyword_name(name), i)
    return numbered.select(*[F.col(f"c{i}").alias(name) for name, i in kept.items()])


def present(c) -> Column:
    """Text, or NULL where the text stands for a missing value."""
    return F.when(~col(c).isin(*fixed.MISSING_TEXTS), col(c))


def to_number(c) -> Column:
    return F.nanvl(present(c).try_cast("double"), F.lit(None).cast("double"))


def to_time(c) -> Column:
    return present(c).try_cast("timestamp_ntz")


def coerce_types(df: DataFrame) -> DataFrame:
    """Timestamps and numbers from text; what cannot be read becomes NULL, never an error."""
    out = {}
    for f in df.schema.fields:
        if f.dataType != T.StringType():
            continue
        if f.name in fixed.TIME_FIELDS:
            out[f.name] = to_time(f.name)
        elif f.name == "days_before_departure":
            out[f.name] = to_number(f.name).try_cast("int")
        elif f.name in fixed.NUMBER_FIELDS:
            out[f.name] = to_number(f.name)
        elif f.name != CORRUPT:
            out[f.name] = present(f.name)
    return df.withColumns(out)


def null_row_count(df: DataFrame) -> DataFrame:
    any_null = F.lit(False)
    for c in df.columns:
        if c != CORRUPT:
            any_null = any_null | F.col(c).isNull()
    return df.agg(F.count_if(any_null).alias("rows_with_nulls"), F.count(F.lit(1)).alias("total_rows"))


def schema_hash(columns) -> Column:
    """SHA-256 over the sorted column names."""
    names = F.array(*[F.lit(c) for c in columns])
    return F.sha2(F.array_join(F.array_sort(names), ","), 256)


def evolved_type(spark_type: T.DataType) -> str:
    """Storage type for a column seen for the first time."""
    if isinstance(spark_type, T.IntegralType):
        return "BIGINT"
    if isinstance(spark_type, (T.FractionalType, T.DecimalType)):
        return "DECIMAL(12, 2)"
    if isinstance(spark_type, (T.TimestampType, T.TimestampNTZType)):
        return "DATETIME"
    if isinstance(spark_type, T.BooleanType):
        return "BOOLEAN"
    return "VARCHAR(255)"


SPARK_TYPES = {
    "BIGINT": "bigint",
    "DECIMAL(12, 2)": "decimal(12,2)",
    "DATETIME": "timestamp_ntz",
    "BOOLEAN": "boolean",
    "VARCHAR(255)": "string",
}


def infer_text_types(df: DataFrame, columns) -> dict:
    """Storage type of text columns, from one pass over all their values (one row comes back)."""
    tests = {}
    for c in columns:
        v = present(c)
        tests[f"{c}|seen"] = F.count(v)
        for kind, ok in (
            ("BOOLEAN", v.isin("True", "False", "TRUE", "FALSE", "true", "false")),
            ("BIGINT", v.rlike(r"^\s*[+-]?\d+\s*$") & v.try_cast("bigint").isNotNull()),
            ("DECIMAL(12, 2)", v.try_cast("double").isNotNull()),
            ("large", F.abs(v.try_cast("double")) >= 1e10),  # what DECIMAL(12, 2) cannot hold
        ):
            tests[f"{c}|{kind}"] = F.count_if(ok)
        tests[f"{c}|missing"] = F.count_if(v.isNull())
    row = df.agg(*[e.alias(k) for k, e in tests.items()]).first().asDict()
    types = {}
    for c in columns:
        seen, missing = row[f"{c}|seen"], row[f"{c}|missing"]
        kind = "VARCHAR(255)"
        if seen == 0:
            kind = "DECIMAL(12, 2)"  # a column of nothing but missing values reads as float
        elif row[f"{c}|BOOLEAN"] == seen and not missing:
            kind = "BOOLEAN"
        elif row[f"{c}|BIGINT"] == seen:
            kind = "DECIMAL(12, 2)" if missing else "BIGINT"  # integers with gaps read as float
        elif row[f"{c}|DECIMAL(12, 2)"] == seen:
            kind = "DECIMAL(12, 2)"
        if kind == "DECIMAL(12, 2)" and row[f"{c}|large"]:
            kind = "VARCHAR(255)"  # the text keeps what the number type would lose
        types[c] = kind
    return types


def schema_evolve(known: DataFrame, incoming: DataFrame) -> tuple[DataFrame, list]:
    """Append frames of different width; returns the union and the new (column, type) pairs."""
    fresh = [f for f in incoming.schema.fields if f.name not in known.columns and f.name != CORRUPT]
    texts = infer_text_types(incoming, [f.name for f in fresh if f.dataType == T.StringType()])
    added = [(f.name, texts.get(f.name) or evolved_type(f.dataType)) for f in fresh]
    typed = incoming.drop(CORRUPT).withColumns(
        {
            name: (present(name) if name in texts else F.col(name)).try_cast(SPARK_TYPES[kind])
            for name, kind in added
        }
    )
    return known.unionByName(typed, allowMissingColumns=True), added
