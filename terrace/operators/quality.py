"""Rules over rows, repairs, summaries of errors, and decisions of reviewers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.operators.ordering import top_in_group


def broken_rules(rows: DataFrame, rules: dict[str, Column], keys: list[str]) -> DataFrame:
    """keys and code for each rule that a row breaks; rules hold what is wrong, and null is not wrong."""
    codes = F.array_compact(F.array(*(F.when(bad, F.lit(code)) for code, bad in rules.items())))
    return rows.select(*keys, F.explode(codes).alias("code"))


def summary(errors: DataFrame, sample: Column, order: list[str], most: int = 5) -> DataFrame:
    """For each code the number of errors and the first samples in order, joined by commas."""
    counts = errors.groupBy("code").agg(F.count(F.lit(1)).alias("n_errors"))
    first = top_in_group(errors.withColumn("sample", sample), ["code"], order, most)
    samples = first.groupBy("code").agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", "sample"))), lambda x: x["sample"]), ",").alias("samples"))
    return counts.join(samples, "code")


def duplicates(rows: DataFrame, keys: list[str]) -> DataFrame:
    return rows.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1")


def aligned(tasks: DataFrame, results: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """Every key of either side and its state: missing_result, unexpected_result, mismatch of a field, or ok."""
    a, b = tasks.select(key, *(F.col(f).alias(f"a_{f}") for f in fields), F.lit(True).alias("in_a")), results.select(key, *(F.col(f).alias(f"b_{f}") for f in fields), F.lit(True).alias("in_b"))
    state = F.when(F.col("in_b").isNull(), "missing_result").when(F.col("in_a").isNull(), "unexpected_result")
    for f in fields:
        state = state.when(~F.col(f"a_{f}").eqNullSafe(F.col(f"b_{f}")), f"mismatch_{f}")
    return a.join(b, key, "full").select(key, state.otherwise("ok").alias("state"))


def overlaid(rows: DataFrame, decisions: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """rows under reviewers' decisions: edit replaces columns, manual and rerun take the row's status, pass leaves it.

    decisions: key, decision and new_<column>; at most one row for each key.
    """
    joined = rows.join(decisions, key, "left")
    new = {c: F.when(F.col("decision") == "edit", F.coalesce(F.col(f"new_{c}"), F.col(c))).otherwise(F.col(c)) for c in columns}
    status = F.when(F.col("decision").isNull(), "unreviewed").when(F.col("decision") == "manual", "manual_review").when(F.col("decision") == "rerun", "needs_rerun").otherwise("verified")
    return joined.select(*(new.get(c, F.col(c)).alias(c) for c in rows.columns), status.alias("review_status"))


def repaired_ragged(parts: Column, width: int, anchor: int) -> Column:
    """Fields of a row with surplus separators: those that overflow are joined back into the field at anchor (from 0)."""
    extra = F.size(parts) - width
    joined = F.array_join(F.slice(parts, anchor + 1, extra + 1), ",")
    tail = width - anchor - 1
    fixed = F.concat(F.slice(parts, 1, anchor), F.array(joined), F.slice(parts, F.size(parts) - tail + 1, tail) if tail else F.array().cast("array<string>"))
    return F.when(extra > 0, fixed).otherwise(F.concat(parts, F.array_repeat(F.lit(""), F.greatest(-extra, F.lit(0)))))


def output_state(exists: Column, readable: Column, header_ok: Column, rows: Column, expected: Column) -> Column:
    """missing, unreadable, header_mismatch, header_only, completed or partial; more rows than expected are partial too."""
    known = F.when(~exists, "missing").when(~readable, "unreadable").when(~header_ok, "header_mismatch").when(rows == 0, "header_only")
    return known.when((expected > 0) & (rows == expected), "completed").otherwise("partial")


def guarded(errors: DataFrame, allow_partial: bool = False) -> None:
    """Raises if there is any error, unless partial output is allowed."""
    first = errors.take(1)
    if first and not allow_partial:
        raise ValueError(f"rows break rules: {first[0].asDict()}")
