"""Rounds of batches: which attempt counts, how far rounds are, what is open, and where its failures go."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import blank
from terrace.operators.ordering import best

# How attempts rank by state, and modes that do a whole batch.
STATE_RANK = {"completed": 4, "partial_prefix": 3, "header_only": 1, "partial_misaligned": 0}
FULL_MODES = ("fresh_full_batch", "fresh_restart", "continue_from_prefix")


def progress_rows(*counters: Column) -> Column:
    """The largest of the counters, missing ones as 0."""
    return F.greatest(*(F.coalesce(c, F.lit(0)) for c in counters), F.lit(0))


def attempt_order(merged: Column | None = None) -> list[Column]:
    """State, valid prefix, rows that both files have, last activity and attempt number, the largest being best.

    merged: whether a candidate was put together from shards; such ones go before others of their state.
    """
    rank = F.lit(0)
    for state, value in STATE_RANK.items():
        rank = F.when(F.col("state") == state, value).otherwise(rank)
    both = F.least(*(F.coalesce(c, F.lit(0)) for c in ("classifier_rows", "result_rows")))
    source = [] if merged is None else [merged.cast("int")]
    return [rank, *source, F.coalesce("prefix_len", F.lit(0)), both, F.coalesce("last_activity", F.lit(0.0)), F.coalesce("attempt_index", F.lit(0))]


def chosen_attempts(attempts: DataFrame, key: str) -> DataFrame:
    """For each batch the attempt that counts: attempt_index, state and prefix_len.

    attempts: state, prefix_len, classifier_rows, result_rows, last_activity, attempt_index, mode and is_current. The
    best one counts, but the current one stays if it is a fresh restart, or if nothing is completed and its mode is one of
    FULL_MODES or it has rows and no shorter prefix. A blank mode is a fresh_full_batch; missing numbers are 0.
    """
    columns = ["attempt_index", "state", "prefix_len"]
    top = best(attempts, [key], attempt_order(), columns)
    mode = F.when(blank(F.col("mode")), "fresh_full_batch").otherwise(F.trim("mode"))
    begun = F.least(*(F.coalesce(c, F.lit(0)) for c in ("classifier_rows", "result_rows"))) > 0
    current = attempts.where("is_current").groupBy(key).agg(F.max_by(F.struct(*(F.col(c).alias(f"cur_{c}") for c in columns), mode.alias("cur_mode"), begun.alias("cur_begun")), "attempt_index").alias("c")).select(key, "c.*")
    joined = top.join(current, key, "left")
    longer = F.coalesce("cur_prefix_len", F.lit(0)) >= F.coalesce("prefix_len", F.lit(0))
    stays = (F.col("cur_mode") == "fresh_restart") | (~F.col("state").eqNullSafe("completed") & (F.col("cur_mode").isin(*FULL_MODES) | (F.col("cur_begun") & longer)))
    keep = F.coalesce(F.col("cur_mode").isNotNull() & stays, F.lit(False))
    return joined.select(key, *(F.when(keep, F.col(f"cur_{c}")).otherwise(F.col(c)).alias(c) for c in columns), keep.alias("kept_current"))


def snapshots(attempts: DataFrame, key: str, order: str, length: str) -> DataFrame:
    """For each batch the longest prefix so far and the attempt that first reached it: a snapshot never gets shorter."""
    return attempts.groupBy(key).agg(F.max(length).alias("best_prefix_len"), F.max_by(F.col(order), F.struct(F.col(length), -F.col(order))).alias("best_attempt"))


def round_progress(batches: DataFrame, round_: str, resolved: Column, rows: Column, failed: Column) -> DataFrame:
    """For each round its batches, resolved and open ones, rows and failures, and whether all are resolved."""
    return batches.groupBy(round_).agg(
        F.count(F.lit(1)).alias("n_batches"), F.count_if(resolved).alias("n_resolved"), F.count_if(~resolved).alias("n_open"),
        F.sum(rows).alias("n_rows"), F.count_if(failed).alias("n_failed"), F.every(resolved).alias("all_resolved"),
    )


def resume_point(progress: DataFrame, round_: str) -> DataFrame:
    """One row: the earliest open round, null without one, and how many leading rounds are resolved."""
    first = F.min(F.when(~F.col("all_resolved"), F.col(round_)))
    found = progress.agg(first.alias("resume_round"))
    counted = progress.join(F.broadcast(found), F.coalesce(F.col(round_) < F.col("resume_round"), F.lit(True)))
    return found.crossJoin(counted.agg(F.count(F.lit(1)).alias("completed_rounds")))


def single_open_round(progress: DataFrame, round_: str) -> int:
    """The only round that isn't resolved; raises if there is none or more than one."""
    found = [r[0] for r in progress.where(~F.col("all_resolved")).select(round_).orderBy(round_).take(2)]
    if len(found) != 1:
        raise ValueError("no open round" if not found else f"several open rounds, the first are {found}")
    return found[0]


def first_incomplete(tasks: DataFrame, batch: str, done: DataFrame, key: str) -> DataFrame:
    """One row: the least batch with a task that isn't done, null without one."""
    return tasks.join(done.select(key), key, "left_anti").agg(F.min(batch).alias("first_incomplete"))


def split_batch(tasks: DataFrame, batch: str, place: str, head: int = 15) -> DataFrame:
    """tasks with shard 1 for the first head places of a batch and 2 for the rest, and their place in the shard."""
    first = F.col(place) <= head
    return tasks.withColumns({"shard": F.when(first, 1).otherwise(2), "shard_place": F.when(first, F.col(place)).otherwise(F.col(place) - head)})


def merged_shards(rows: DataFrame, expected: DataFrame, batch: str, place: str) -> DataFrame:
    """For each batch whether its shards together hold each expected place once: mergeable, and what is missing or twice."""
    held = rows.groupBy(batch, place).agg(F.count(F.lit(1)).alias("k"))
    both = expected.select(batch, place).join(held, [batch, place], "left")
    return both.groupBy(batch).agg(F.count_if(F.col("k").isNull()).alias("n_missing"), F.count_if(F.col("k") > 1).alias("n_twice"), F.every(F.coalesce(F.col("k") == 1, F.lit(False))).alias("mergeable"))


def backlog(progress: Column, schema_error: Column) -> Column:
    """Where a failed batch waits: in quarantine for schema errors, else as partly done or as failed."""
    return F.when(schema_error, "schema_error_quarantined").when(progress > 0, "partial_complete_retry_pending").otherwise("worker_failed_retry_pending")


def merged_backlog(old: DataFrame, new: DataFrame, keys: list[str], order: Column) -> DataFrame:
    """Entries of both by key: the newest by order counts, and of equal ones that of new."""
    both = old.withColumn("_new", F.lit(0)).unionByName(new.withColumn("_new", F.lit(1)))
    columns = [c for c in old.columns if c not in keys]
    return both.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(order, F.col("_new"))).alias("_row")).select(*keys, "_row.*")


def merged_schedule(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Rows of new, and those of old that new lacks; if any row of either has a blank key, new alone."""
    named = lambda df: df.where(F.coalesce(F.trim(F.col(key).cast("string")) == "", F.lit(True)))
    keyless = named(old).select(key).unionByName(named(new).select(key)).limit(1).agg((F.count(F.lit(1)) > 0).alias("keyless"))
    rest = old.join(new.select(key), key, "left_anti").join(F.broadcast(keyless.where("NOT keyless")))
    return new.unionByName(rest.drop("keyless"), allowMissingColumns=True)


def upserted_one(rows: DataFrame, place: str, key: str, row: dict[str, str]) -> DataFrame:
    """rows with one row replaced where its key stands, else behind the last place; replaced says which."""
    value = row[key]
    found = F.col(key).eqNullSafe(F.lit(value))
    changed = rows.select(*(F.when(found, F.lit(row.get(c))).otherwise(F.col(c)).alias(c) if c != place else F.col(c) for c in rows.columns), found.alias("replaced"))
    last = rows.agg((F.coalesce(F.max(place), F.lit(0)) + 1).alias(place), F.coalesce(F.bool_or(found), F.lit(False)).alias("_held"))
    more = last.where("NOT _held").select(*(F.lit(row.get(c)).cast(rows.schema[c].dataType).alias(c) if c != place else F.col(c) for c in rows.columns), F.lit(False).alias("replaced"))
    return changed.unionByName(more)


def guarded_prefix(writes: DataFrame, preserved: DataFrame, key: str) -> DataFrame:
    """Writes whose key belongs to the preserved rows: those that must be refused."""
    return writes.join(preserved.select(key), key, "left_semi")
