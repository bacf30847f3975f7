"""Tasks in batches of fixed size, their manifest, and rounds of worker slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.ordering import numbered


def task_batches(rows: DataFrame, order: list[str], size: int) -> DataFrame:
    """rows with task_index (from 1 in that order) and batch_index."""
    return numbered(rows, order, "task_index").withColumn("batch_index", (F.floor((F.col("task_index") - 1) / size) + 1).cast("long"))


def manifest(tasks: DataFrame, name: str) -> DataFrame:
    """For each batch its number of tasks, its first and last index and their names."""
    return tasks.groupBy("batch_index").agg(
        F.count(F.lit(1)).alias("task_count"),
        F.min("task_index").alias("first_task_index"),
        F.max("task_index").alias("last_task_index"),
        F.min_by(name, "task_index").alias("first_name"),
        F.max_by(name, "task_index").alias("last_name"),
    )


def round_slot(batch: Column, workers: int) -> dict[str, Column]:
    return {"round_index": (F.floor((batch - 1) / workers) + 1).cast("long"), "worker_slot": (F.pmod(batch - 1, F.lit(workers)) + 1).cast("long")}


def remaining(tasks: DataFrame, done: DataFrame, key: str) -> DataFrame:
    """Tasks without a result."""
    return tasks.join(done.select(key), key, "left_anti")


def range_assigned(rows: DataFrame, key: str, size: int) -> DataFrame:
    """rows with the range of ids that each belongs to: range_index, first_id, last_id; an equation, not a range join."""
    at = F.floor(F.col(key) / size).cast("long")
    return rows.withColumns({"range_index": at, "first_id": at * size, "last_id": at * size + size - 1})
