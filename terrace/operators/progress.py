"""Progress of append-only outputs: rollups of states, gaps between events, escalation and slots."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions.values import idle_seconds
from terrace.operators.ordering import best, top_in_group


def status_rollup(rows: DataFrame, by: Column, name: str, status: str, known: list[str], done: str) -> DataFrame:
    """Rows of each known status by group, and whether all are done."""
    return rows.groupBy(by.alias(name)).agg(*(F.count_if(F.col(status) == s).alias(f"n_{s.lower()}") for s in known), F.count(F.lit(1)).alias("n_rows"), F.every(F.col(status) == done).alias("all_done"))


def tag_rollup(events: DataFrame, tag: str, at: str, event: str) -> DataFrame:
    return events.groupBy(tag).agg(F.count(F.lit(1)).alias("n_events"), F.min(at).alias("first_at"), F.max(at).alias("last_at"), F.max_by(event, F.struct(F.col(at), -F.col(event))).alias("last_event"))


def latest(events: DataFrame, key: str, at: str, event: str, columns: list[str]) -> DataFrame:
    """The latest event of each key; of ties the one with the lower id."""
    return best(events, [key], [F.col(at), -F.col(event)], [event, *columns])


def tail_counts(events: DataFrame, key: str, at: str, event: str, tag: str, most: int) -> DataFrame:
    """Events by tag among the last ones of each key."""
    return top_in_group(events, [key], [F.desc(at), F.desc(event)], most).groupBy(key, tag).agg(F.count(F.lit(1)).alias("n_events"))


def idle_gaps(events: DataFrame, key: str, at: str, event: str, soft: int, hard: int) -> DataFrame:
    """Seconds since the event before of the same key, and what they call for: none, soft or hard timeout."""
    before = F.lag(at).over(Window.partitionBy(key).orderBy(at, event))
    gap = idle_seconds(F.col(at), F.col("before_at"))
    timed = events.withColumn("before_at", before).withColumn("idle_seconds", gap)
    return timed.select(event, key, "idle_seconds", F.when(F.col("idle_seconds") >= hard, "hard_timeout").when(F.col("idle_seconds") >= soft, "soft_timeout").otherwise("none").alias("action"))


def progress_by_day(events: DataFrame, key: str, at: str) -> DataFrame:
    """Events of each key and day, and all so far; days are few for a key, so the running sum is short."""
    days = events.groupBy(key, F.to_date(at).alias("day")).agg(F.count(F.lit(1)).alias("added"))
    running = Window.partitionBy(key).orderBy("day").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return days.withColumn("total", F.sum("added").over(running))


def escalated(counts: DataFrame, rules: list[tuple[int, str]], count: str) -> DataFrame:
    """counts with the action of the last rule (threshold, action) that is reached, none before the first."""
    action = F.lit("none")
    for threshold, name in rules:
        action = F.when(F.col(count) >= threshold, name).otherwise(action)
    return counts.withColumn("action", action)
