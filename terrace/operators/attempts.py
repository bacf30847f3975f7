"""Outputs of an attempt held against its tasks, place by place: how far they agree, and what state that is."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.ordering import top_in_group
from terrace.operators.rounds import attempt_order


def _keyed(rows: DataFrame, by: list[str], place: str, key: str, name: str) -> DataFrame:
    return rows.select(*by, F.col(place).cast("long").alias("place"), F.coalesce(F.col(key).cast("string"), F.lit("")).alias(name), F.lit(True).alias(f"in_{name}"))


def placed(tasks: DataFrame, classifier: DataFrame, results: DataFrame, by: list[str], place: str, key: str) -> DataFrame:
    """Every place that a task, a classifier row or a result row has, with the keys of all three, null where there is none.

    Places count from 1 in each of the three without gaps.
    """
    sides = [_keyed(rows, by, place, key, name) for rows, name in ((tasks, "task"), (classifier, "classified"), (results, "result"))]
    return sides[0].join(sides[1], [*by, "place"], "full").join(sides[2], [*by, "place"], "full")


def inspected(attempts: DataFrame, tasks: DataFrame, classifier: DataFrame, results: DataFrame, by: list[str], place: str = "place", key: str = "task_index") -> DataFrame:
    """The state of each attempt: by, expected, classifier_rows, result_rows, prefix_len and state.

    attempts: by, expected (rows), classifier_header_ok and results_header_ok. The prefix is the leading places up to the
    first one at which either output has another key than the task, among the places that all three have. An attempt is
    completed if nothing disagrees, nothing is left over on either side and both have as many rows as expected;
    header_only if both headers are right and neither has rows; partial_prefix if what is there agrees and is at least
    one row; otherwise partial_misaligned. Attempts without any rows are judged as well.
    """
    every = placed(tasks, classifier, results, by, place, key)
    shared = F.col("in_task") & F.col("in_classified") & F.col("in_result")
    differs = shared & ((F.col("task") != F.col("classified")) | (F.col("task") != F.col("result")))
    counts = every.groupBy(*by).agg(
        F.count("in_classified").alias("classifier_rows"), F.count("in_result").alias("result_rows"), F.count_if(F.coalesce(shared, F.lit(False))).alias("compared"), F.min(F.when(differs, F.col("place"))).alias("first_wrong")
    )
    joined = attempts.join(counts, by, "left")
    n = lambda c: F.coalesce(F.col(c), F.lit(0)).cast("long")
    headers = F.col("classifier_header_ok") & F.col("results_header_ok")
    whole = headers & F.col("first_wrong").isNull() & (n("compared") == F.greatest(n("classifier_rows"), n("result_rows")))
    prefix = F.coalesce(F.col("first_wrong") - 1, n("compared"))
    state = (
        F.when(whole & (n("classifier_rows") == F.col("expected")) & (n("result_rows") == F.col("expected")), "completed")
        .when((n("classifier_rows") == 0) & (n("result_rows") == 0) & headers, "header_only")
        .when(whole & (prefix > 0), "partial_prefix")
        .otherwise("partial_misaligned")
    )
    return joined.select(*by, "expected", n("classifier_rows").alias("classifier_rows"), n("result_rows").alias("result_rows"), prefix.alias("prefix_len"), state.alias("state"))


def order_errors(tasks: DataFrame, rows: DataFrame, by: list[str], place: str = "place", key: str = "task_index", name: str = "token_name") -> DataFrame:
    """by, record (the header is 1) and what was expected and found, for each place at which a row isn't its task's.

    Places that only one side has are no errors of order.
    """
    a = tasks.select(*by, place, F.coalesce(F.col(key).cast("string"), F.lit("")).alias("expected_key"), F.coalesce(F.col(name), F.lit("")).alias("expected_name"))
    b = rows.select(*by, place, F.trim(F.coalesce(F.col(key).cast("string"), F.lit(""))).alias("found_key"), F.trim(F.coalesce(F.col(name), F.lit(""))).alias("found_name"))
    return a.join(b, [*by, place]).where("expected_key <> found_key").select(*by, (F.col(place) + 1).alias("record"), "expected_key", "expected_name", "found_key", "found_name")


def reconciled(schedule: DataFrame, candidates: DataFrame, key: str, active: dict[str, str], fields: list[str]) -> DataFrame:
    """schedule under the best candidate of each batch, which may be an attempt or what its shards were merged to.

    candidates: key, source, is split_merged for merged ones, what attempt_order ranks by, the columns that active names
    and, for each of fields, meta_<field> from the attempt's own record. active: columns of the schedule by the candidate's
    column that they take. A field takes its record's value where there is one. Batches without candidates stay.
    """
    order = attempt_order(F.col("source").eqNullSafe("split_merged"))
    columns = [*active.values(), *(f"meta_{f}" for f in fields)]
    best = candidates.groupBy(key).agg(F.max_by(F.struct(*columns), F.struct(*order)).alias("_best"))
    joined, there = schedule.join(best, key, "left"), F.col("_best").isNotNull()
    new = {c: F.when(there, F.col("_best")[v]).otherwise(F.col(c)) for c, v in active.items()}
    new |= {f: F.coalesce(F.col("_best")[f"meta_{f}"], F.col(f)) for f in fields}
    return joined.select(*(new.get(c, F.col(c)).alias(c) for c in schedule.columns))


def preferred(outputs: DataFrame, key: str, kinds: list[str]) -> DataFrame:
    """For each key the dataset that counts: the first kind that is completed, else the first one that exists.

    outputs: key, kind and state, as quality.output_state gives it; kinds in the order of preference. Keys none of whose
    outputs exists have a null kind.
    """
    rank = F.array_position(F.array(*map(F.lit, kinds)), F.col("kind"))
    order = F.when(F.col("state") != "missing", F.struct((F.col("state") != "completed").alias("open"), rank.alias("rank")))
    return outputs.groupBy(key).agg(F.min_by(F.struct("kind", "state"), order).alias("_row")).select(key, "_row.kind", "_row.state")


def prefix_copied(rows: DataFrame, place: str, prefix_len: Column, header_ok: Column, columns: list[str]) -> DataFrame:
    """The rows up to the prefix of their output, under just these columns, empty where the output lacks one; none behind a wrong header."""
    kept = rows.where(header_ok & (F.col(place) <= prefix_len))
    return kept.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in rows.columns else F.lit("").alias(c) for c in columns))


def first_disagreements(rows: DataFrame, by: list[str], place: str, most: int = 5) -> DataFrame:
    """The first order errors of each key, for reports."""
    return top_in_group(rows, by, [place], most)
