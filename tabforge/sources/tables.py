"""Reading and writing csv and parquet tables, and report sinks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tabforge.functions.columns import col, nan_to_null

FORMATS = ("csv", "parquet")

# Text that a csv reader takes for a missing value.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def resolve_format(path: str, format: str | None = None) -> str:
    """The format given, or the one the path's ending names (in any case)."""
    if format:
        if format not in FORMATS:
            raise ValueError(f"Tables of format {format!r} can't be read; known are {', '.join(sorted(FORMATS))}")
        return format
    ending = path.rstrip("/").rsplit("/", 1)[-1].rpartition(".")[2].lower()
    if ending in FORMATS:
        return ending
    raise ValueError(f"The ending of {path!r} names no known format; give one of {', '.join(sorted(FORMATS))}")


def infer_types(df: DataFrame) -> T.StructType:
    """Narrowest of bigint, double, boolean that every present text of a column fits, else string.

    One aggregate over the table; dates stay text, as in the csv they came from.
    """
    names = df.columns

    text = F.col("value")
    tests = {
        "as_long": text.rlike(r"^\s*[+-]?\d+\s*$") & text.try_cast("bigint").isNotNull(),
        "as_double": text.try_cast("double").isNotNull() & ~text.rlike(r"[dDfF]\s*$"),
        "as_bool": F.lower(text).isin("true", "false"),
    }
    cells = df.select(F.posexplode(F.array(*[col(c) for c in names])).alias("c", "value")).where("value IS NOT NULL")
    rows = cells.groupBy("c").agg(*[F.bool_and(t).alias(k) for k, t in tests.items()]).collect()
    found = {names[r.c]: r for r in rows}
    fields = []
    for c in names:
        r = found.get(c)  # a column without any value counts as numeric
        kind = (
            T.DoubleType() if r is None
            else T.LongType() if r.as_long
            else T.DoubleType() if r.as_double
            else T.BooleanType() if r.as_bool
            else T.StringType()
        )
        fields.append(T.StructField(c, kind))
    return T.StructType(fields)


def read_table(
    spark: SparkSession,
    path: str,
    format: str | None = None,
    schema: T.StructType | str | None = None,
    line_breaks: bool = True,
) -> DataFrame:
    """A csv (header, quoted fields, missing-value tokens) or parquet table from any path Spark reads.

    A csv without a ``schema`` is read twice: once to find the types, once for the data. Pass one
    for a large table. Quoted fields may hold line breaks, for which a file is read by one task;
    ``line_breaks=False`` promises that none do, so that large files are split.
    """
    if resolve_format(path, format) == "parquet":
        return nan_to_null(spark.read.parquet(path))
    if isinstance(schema, str):
        schema = T.StructType.fromDDL(schema)
    text_schema = T.StructType([T.StructField(f.name, T.StringType()) for f in schema]) if schema is not None else None
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", line_breaks)
    raw = reader.schema(text_schema).csv(path) if text_schema is not None else reader.csv(path)
    text = raw.select(*[F.when(~col(c).isin(NA_TOKENS), col(c)).alias(c) for c in raw.columns])
    schema = schema or infer_types(text)
    out = []
    for f in schema:
        value = col(f.name)
        if isinstance(f.dataType, T.StringType):
            out.append(value)
        elif isinstance(f.dataType, T.BooleanType):
            out.append(F.lower(value).try_cast("boolean").alias(f.name))
        else:
            out.append(F.trim(value).try_cast(f.dataType).alias(f.name))
    return nan_to_null(text.select(*out))


def write_table(
    df: DataFrame, path: str, format: str | None = None, partition_by: Sequence[str] = ()
) -> str:
    """Write csv (with header) or parquet as a directory of part files, replacing what was there."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if resolve_format(path, format) == "csv":
        writer = writer.option("header", True).option("quote", '"').option("escape", '"')
        # texts keep the white space at their ends
        writer.option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path)
    else:
        writer.parquet(path)
    return path


def load_data(
    spark: SparkSession, source: str = "file", path: str | None = None, format: str | None = None, schema=None
) -> DataFrame:
    """Load a named kind of source; ``file`` is the only one and needs a path."""
    if source != "file":
        raise ValueError(f"No such kind of source: {source!r}")
    if not path:
        raise ValueError("a file source needs a path")
    return read_table(spark, path, format, schema)


def write_report(report: DataFrame, path: str, run_id: str | None = None, mode: str = "overwrite") -> str:
    """Write a report table as JSON lines, optionally stamped with a run id."""
    if run_id is not None:
        report = report.withColumn("run_id", F.lit(run_id))
    report.write.mode(mode).json(path)
    return path


def check_columns(df: DataFrame, expected: Sequence[str]) -> None:
    """Raise with the sorted missing names unless every expected column is there; extra ones are fine."""
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"Missing columns: {missing}")


def drop_target(df: DataFrame, target: str, required: bool = False) -> DataFrame:
    """The features: everything but the target, which training requires and scoring tolerates."""
    if required and target not in df.columns:
        raise ValueError(f"Target column {target!r} is not in the table")
    return df.drop(target)
