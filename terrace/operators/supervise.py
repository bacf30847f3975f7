"""What schedules and their outputs say: summaries, overviews, comparisons, scopes and audits."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import stripped
from terrace.functions.values import list_length
from terrace.operators.rounds import progress_rows

# Statuses that end a batch, and those that a failure leaves.
FAILED = ("partial_complete_retry_pending", "worker_failed_retry_pending", "schema_error_quarantined", "collect_blocked")
RESOLVED = ("completed", "deferred_long_tail", "retry_capped", *FAILED)


def effective_status(status: Column, completion_mode: Column) -> Column:
    """What a row's status and completion mode say together.

    What a failure leaves goes first, in either column; then a cap of retries and the deferral of a long tail, which the
    mode names unless the status says otherwise; then the status, unknown where that is blank.
    """
    own, mode = stripped(status), stripped(completion_mode)
    return (
        F.when(own.isin(*FAILED), own)
        .when(mode.isin(*FAILED), mode)
        .when((own == "retry_capped") | (~own.isin("completed", "deferred_long_tail") & (mode == "retry_capped")), "retry_capped")
        .when((own == "deferred_long_tail") | ((own != "completed") & (mode == "deferred_long_tail")), "deferred_long_tail")
        .when(own == "", "unknown")
        .otherwise(own)
    )


def result_summary(rows: DataFrame, batch: str, expected: str) -> DataFrame:
    """For each batch its rows with and without an entity, searched without one, skipped and for manual review, and why it ended.

    rows: mapped_entity_name, entity_search_required and needs_manual_review, and the batch's expected rows in each row.
    """
    mapped = list_length(stripped(F.col("mapped_entity_name"))) > 0
    searched = stripped(F.col("entity_search_required")) == "yes"
    counts = rows.groupBy(batch).agg(
        F.count(F.lit(1)).alias("rows_written"), F.count_if(mapped).alias("rows_with_entity"), F.count_if(~mapped).alias("rows_without_entity"), F.count_if(searched & ~mapped).alias("searched_no_entity_rows"),
        F.count_if(~searched & ~mapped).alias("skip_candidate_rows"), F.count_if(stripped(F.col("needs_manual_review")) == "yes").alias("manual_review_rows"), F.max(expected).alias("task_count"),
    )
    # The reasons.
    reason = (
        F.when(F.col("rows_written") < F.col("task_count"), "interrupted_incomplete")
        .when(F.col("rows_with_entity") > 0, "completed_with_entities_found")
        .when(F.col("searched_no_entity_rows") == F.col("task_count"), "all_tokens_searched_no_entity")
        .otherwise("all_rows_resolved_zero_entity_mixed_skip_and_search")
    )
    return counts.withColumns({"search_complete": F.col("rows_written") == F.col("task_count"), "completion_reason": reason})


def overview(schedule: DataFrame) -> DataFrame:
    """One row: batches in all, resolved and open ones, those with rows of either file, those with failures, and rows of either file.

    schedule: status, completion_mode, last_seen_ and best_valid_ classifier_rows and result_rows, respawn_count,
    startup_failure_count, stall_failure_count and failure_counts_json. A batch's rows are the larger of those seen last
    and the best ones. A batch has failures if one of the counters is above 0, or its status says so.
    """
    status = effective_status(F.col("status"), F.col("completion_mode"))
    above = lambda c: F.coalesce(F.col(c), F.lit(0)) > 0
    counts = F.coalesce(F.from_json("failure_counts_json", "map<string,int>"), F.create_map().cast("map<string,int>"))
    failed = above("respawn_count") | above("startup_failure_count") | above("stall_failure_count") | F.exists(F.map_values(counts), lambda n: F.coalesce(n > 0, F.lit(False))) | status.isin("retry_capped", "deferred_long_tail")
    classified, results = (progress_rows(F.col(f"last_seen_{x}_rows"), F.col(f"best_valid_{x}_rows")) for x in ("classifier", "result"))
    return schedule.agg(
        F.count(F.lit(1)).alias("total_batches"), F.count_if(status.isin(*RESOLVED)).alias("resolved_batches"), F.count_if(~status.isin(*RESOLVED)).alias("open_batches"), F.count_if(classified > 0).alias("batches_with_classifier_rows"),
        F.count_if(results > 0).alias("batches_with_result_rows"), F.count_if(failed).alias("batches_with_failures"), F.sum(classified).alias("total_classifier_rows"), F.sum(results).alias("total_result_rows"),
    )


def current_round(schedule: DataFrame, round_: str, columns: list[str]) -> DataFrame:
    """Batches of the first round with an unresolved one, with the larger of their live and best rows in either file."""
    first = schedule.where(~stripped(F.col("status")).isin(*RESOLVED)).agg(F.min(round_).alias(round_))
    rows = {f"{x}_rows": progress_rows(F.col(f"last_seen_{x}_rows"), F.col(f"best_valid_{x}_rows")).cast("long") for x in ("classifier", "result")}
    return schedule.join(F.broadcast(first), round_).select(round_, *columns, *(v.alias(c) for c, v in rows.items()))


def compared(expected: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """One row: keys expected and seen, missing and unexpected ones."""
    both = expected.select(key, F.lit(1).alias("e")).distinct().join(seen.select(key, F.lit(1).alias("s")).distinct(), key, "full")
    return both.agg(F.count("e").alias("n_expected"), F.count("s").alias("n_seen"), F.count_if(F.col("s").isNull()).alias("n_missing"), F.count_if(F.col("e").isNull()).alias("n_unexpected"))


def restarts(counts: Column) -> dict[str, Column]:
    """The most and all restarts of an array of launches by shard; the first launch of a shard is none."""
    own = F.transform(F.coalesce(counts, F.array().cast("array<int>")), lambda n: F.greatest(n - 1, F.lit(0)))
    return {"most_restarts": F.coalesce(F.array_max(own), F.lit(0)), "all_restarts": F.aggregate(own, F.lit(0), lambda s, x: s + x)}


def latest_heartbeat(sources: dict[str, DataFrame], key: str, at: str) -> DataFrame:
    """For each key the latest time over all sources and the source that has it, the first named one of ties."""
    every = reduce(DataFrame.unionByName, (df.select(key, F.col(at).alias("heartbeat_at"), F.lit(name).alias("source"), F.lit(-i).alias("_rank")) for i, (name, df) in enumerate(sources.items())))
    return every.where("heartbeat_at IS NOT NULL").groupBy(key).agg(F.max("heartbeat_at").alias("heartbeat_at"), F.max_by("source", F.struct("heartbeat_at", "_rank")).alias("source"))


def overlay_fields(rows: DataFrame, source: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """rows with source's values of fields, and key_missing for rows that source lacks, which keep their own."""
    joined = rows.join(source.select(key, *(F.col(f).alias(f"_{f}") for f in fields), F.lit(True).alias("_there")), key, "left")
    there = F.col("_there").isNotNull()
    return joined.select(*(F.when(there, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in rows.columns), (~there).alias("key_missing"))


def in_scope(backlog: DataFrame, scope: DataFrame, path: str) -> DataFrame:
    """backlog with in_scope: whether a batch of the scope has the path or its base name."""
    base = lambda c: F.element_at(F.split(c, "/"), -1)
    names = scope.select(base(F.col(path)).alias("_base")).distinct().withColumn("in_scope", F.lit(True))
    return backlog.withColumn("_base", base(F.col(path))).join(names, "_base", "left").drop("_base").withColumn("in_scope", F.coalesce("in_scope", F.lit(False)))


def outside_scope(backlog: DataFrame, scope: DataFrame, path: str) -> DataFrame:
    """backlog without the rows whose path, or its base name, a batch of the scope has."""
    return in_scope(backlog, scope, path).where("NOT in_scope").drop("in_scope")


def source_map(schedule: DataFrame, key: str, paths: list[str]) -> DataFrame:
    """Every path that a row of the schedule names in its path columns, with the row's key; the last row of a path counts."""
    long = schedule.select(key, F.explode(F.array(*(F.trim(F.col(p)) for p in paths))).alias("path")).where("path <> ''")
    return long.groupBy("path").agg(F.max(key).alias(key))


def newest(rows: DataFrame, keys: list[str], columns: list[str], *order: Column) -> DataFrame:
    """Of each key's records the one that wins by a ladder of rules, each a column whose larger value wins."""
    return rows.groupBy(*keys).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_row")).select(*keys, "_row.*")


def audit(checks: dict[str, tuple[DataFrame, Column]]) -> DataFrame:
    """class and message of every finding: (rows, message) by class, null messages being none."""
    found = (df.select(F.lit(kind).alias("class"), message.alias("message")).where("message IS NOT NULL") for kind, (df, message) in checks.items())
    return reduce(DataFrame.unionByName, found)


def task_window(tasks: DataFrame, by: str, place: str, name: str) -> DataFrame:
    """For each group the place and name of its first and last task."""
    return tasks.groupBy(by).agg(F.min(place).alias("first_place"), F.min_by(name, place).alias("first_name"), F.max(place).alias("last_place"), F.max_by(name, place).alias("last_name"))


def expected_keys(ranges: DataFrame, tasks: DataFrame, batch: str, key: str) -> DataFrame:
    """The keys that each batch has to give: those of its tasks, or of its range where no tasks are listed."""
    listed = tasks.select(batch, F.col(key).cast("long").alias(key))
    rest = ranges.join(tasks.select(batch).distinct(), batch, "left_anti").select(batch, F.explode(F.sequence(F.col("first").cast("long"), F.col("last").cast("long"))).alias(key))
    return listed.unionByName(rest)
