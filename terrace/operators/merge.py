"""Keyed merges, gaps in coverage, contiguous runs and aligned prefixes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.ordering import numbered


def upserted(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """Rows of new, and those of old whose keys new lacks."""
    return new.unionByName(old.join(new.select(*keys), keys, "left_anti"), allowMissingColumns=True)


def overwritten(old: DataFrame, new: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """Keys on both sides with the columns that differ, joined by pipes; equal rows don't count."""
    a, b = old.select(key, *(F.col(c).alias(f"a_{c}") for c in columns)), new.select(key, *(F.col(c).alias(f"b_{c}") for c in columns))
    changed = F.concat_ws("|", *(F.when(~F.col(f"a_{c}").eqNullSafe(F.col(f"b_{c}")), F.lit(c)) for c in columns))
    return a.join(b, key).select(key, changed.alias("changed")).where("changed <> ''")


def missing_keys(expected: DataFrame, present: DataFrame, key: str) -> DataFrame:
    return expected.select(key).distinct().join(present.select(key), key, "left_anti")


def islands(rows: DataFrame, key: str) -> DataFrame:
    """Runs of successive keys: first_key, last_key, n_keys, and next_missing behind each."""
    placed = numbered(rows.select(key).where(F.col(key).isNotNull()).distinct(), [key], "place")
    runs = placed.groupBy((F.col(key) - F.col("place")).alias("run")).agg(F.min(key).alias("first_key"), F.max(key).alias("last_key"), F.count(F.lit(1)).alias("n_keys"))
    return runs.select("first_key", "last_key", "n_keys", (F.col("last_key") + 1).alias("next_missing"))


def prefix_length(rows: DataFrame, key: str, position: str, wrong: Column) -> DataFrame:
    """For each key its rows and how many stand before the first wrong one, by one aggregation."""
    first = F.min(F.when(wrong, F.col(position)))
    return rows.groupBy(key).agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(first, F.max(position) + 1).cast("long").alias("prefix_len"), first.isNull().alias("aligned"))
