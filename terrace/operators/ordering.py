"""Gapless numbers over a whole table without one task that sorts it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.sources.shared import scratch


def cut(df: DataFrame) -> DataFrame:
    """df as a table in the shared folder, which survives lost executors and goes when the application ends."""
    path = scratch(df.sparkSession, "cut")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def numbered(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """df with name: 1, 2, ... in the order of columns that tell rows apart.

    Rows are dealt by ranges of the order and numbered within each; a range's base is the sum of those before it.
    """
    dealt = cut(df.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()))
    counts = dealt.groupBy("_range").agg(F.count(F.lit(1)).alias("_n"))
    # As many rows as partitions.
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    bases = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_range").orderBy(*order)
    return dealt.join(F.broadcast(bases), "_range").withColumn(name, F.row_number().over(inner) + F.col("_base")).drop("_range", "_base")


def running(df: DataFrame, order: list, amount: Column, name: str) -> DataFrame:
    """df with name: the sum of a whole number over each row and all before it, in the order of columns that tell rows apart.

    As for numbered: within ranges of the order, whose bases are the sums of those before.
    """
    dealt = cut(df.repartitionByRange(*order).withColumn("_dealt", F.spark_partition_id()))
    # As many rows as partitions.
    before = Window.orderBy("_dealt").rowsBetween(Window.unboundedPreceding, -1)
    bases = dealt.groupBy("_dealt").agg(F.sum(amount).alias("_n")).select("_dealt", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy("_dealt").orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return dealt.join(F.broadcast(bases), "_dealt").withColumn(name, F.sum(amount).over(inner) + F.col("_base")).drop("_dealt", "_base")


def best(df: DataFrame, keys: list[str], order: list, columns: list[str]) -> DataFrame:
    """For each key the row whose order columns are largest, by one aggregation."""
    return df.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_row")).select(*keys, "_row.*")


def top_in_group(df: DataFrame, keys: list[str], order: list, most: int, name: str = "place") -> DataFrame:
    """The first rows of each key; Spark cuts each partition to them before it shuffles."""
    return df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))).where(F.col(name) <= most)
