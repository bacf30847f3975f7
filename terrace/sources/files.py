"""Sources and sinks of entity extracts: CSV with checked headers, JSONL tasks, keyed state."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def read_csv(spark: SparkSession, path: str, glob: str = "*.csv") -> DataFrame:
    """Every column as text, never null; a byte order mark goes, quoted line breaks stay."""
    df = spark.read.options(header=True, multiLine=True, quote='"', escape='"', pathGlobFilter=glob).csv(path)
    return df.select(*(F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c) for c in df.columns))


def without_samples(df: DataFrame, suffix: str = "_10.csv") -> DataFrame:
    """Rows of files that aren't samples; call it on what a file source reads."""
    return df.where(~F.endswith(F.col("_metadata.file_name"), F.lit(suffix)))


def with_columns(df: DataFrame, required: list[str]) -> DataFrame:
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing columns: {', '.join(missing)}")
    return df


def with_header(df: DataFrame, header: list[str]) -> DataFrame:
    if df.columns != header:
        raise ValueError(f"columns are {df.columns}, not {header}")
    return df


def record_numbers(df: DataFrame, file: Column, order: list[str], name: str = "record") -> DataFrame:
    """Records numbered within their file from 2, as the header is the first."""
    return df.withColumn("_file", file).withColumn(name, F.row_number().over(Window.partitionBy("_file").orderBy(*order)) + 1).drop("_file")


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Objects by line with an explicit schema; blank lines don't count."""
    return spark.read.schema(schema).json(path)


def last_by_key(df: DataFrame, key: str, position: str) -> DataFrame:
    """The last row of each integer key; rows whose key isn't one go."""
    whole = df.withColumn("_key", F.col(key).try_cast("long")).where(F.col("_key").isNotNull())
    rows = whole.groupBy("_key").agg(F.max_by(F.struct(*df.columns), position).alias("_row"))
    return rows.select("_row.*")


def write_batches(tasks: DataFrame, path: str, batch: str = "batch_index") -> None:
    """JSONL, one folder for each batch."""
    tasks.repartition(batch).write.mode("overwrite").partitionBy(batch).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").option("header", True).csv(path)


def append_csv(df: DataFrame, path: str) -> None:
    df.write.mode("append").option("header", True).csv(path)
