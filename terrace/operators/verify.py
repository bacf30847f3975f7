"""Checks of verifiers' reports against the tasks that they had to cover and the classifier's rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import blank, stripped
from terrace.functions.values import normal_list, object_without
from terrace.operators.ordering import top_in_group
from terrace.operators.validate import TIERS, outside

# What a verifier may say, and what keeps a merge back until it is resolved.
VERDICTS = ("pass", "suspected_missing_company", "suspected_extra_company", "wrong_project_mapping", "wrong_company_mapping", "search_tier_too_conservative", "search_should_not_have_been_skipped", "insufficient_evidence")
ACTIONS = ("accept_worker_row", "edit_row", "mark_manual_review", "rerun_company", "rerun_batch", "update_prompt_or_process")
BLOCKING = ("edit_row", "rerun_company", "rerun_batch", "update_prompt_or_process")
# What a correction takes from the classifier, and from its task.
FROM_CLASSIFIER = ("token_origin_type", "entity_link_likelihood", "entity_search_required")
FROM_TASK = ("task_index", "canonical_slug", "token_symbol", "token_name")


def _text(name: str) -> Column:
    return stripped(F.col(name))


def row_rules(required: list[str]) -> dict[str, Column]:
    """What is wrong with a verifier's row by code; classifier_tier is that of the classifier's row, null without one.

    required: the columns that a corrected row must have.
    """
    verdict, action, corrected = _text("verdict"), _text("recommended_action"), _text("corrected_result_row_json")
    said, own = _text("classifier_search_tier"), _text("verifier_search_tier")
    edit, wrong = action == "edit_row", object_without(corrected, required)
    names, mapped = normal_list(F.col("verifier_mapped_entity_name")), normal_list(F.get_json_object(corrected, "$.mapped_entity_name"))
    return {
        "verdict_invalid": outside(verdict, VERDICTS),
        "action_invalid": outside(action, ACTIONS),
        "classifier_tier_invalid": outside(said, TIERS),
        "classifier_tier_differs": F.col("classifier_tier").isNotNull() & (said != stripped(F.col("classifier_tier"))),
        "verifier_tier_invalid": outside(own, TIERS),
        "pass_not_accepted": (verdict == "pass") & (action != "accept_worker_row"),
        "reason_blank": (verdict != "pass") & blank(F.col("error_reason")),
        "correction_blank": edit & wrong.eqNullSafe("blank"),
        "correction_not_json": edit & wrong.eqNullSafe("not_json"),
        "correction_not_an_object": edit & wrong.eqNullSafe("not_an_object"),
        "correction_lacks_columns": edit & F.coalesce(F.startswith(wrong, F.lit("missing ")), F.lit(False)),
        "correction_maps_otherwise": edit & wrong.isNull() & (names != "") & (mapped != names),
        "blocks_merge": action.isin(*BLOCKING) & ~(edit & (corrected != "")),
    }


def report_errors(reports: DataFrame, expected: DataFrame, classifier: DataFrame, required: list[str], allow_unresolved: bool = False, most: int = 20) -> DataFrame:
    """report, task_index (null for errors of a whole report), code and detail of every error.

    reports: report, task_index and the verifier's columns. expected: report and task_index, one row for each task that a
    report has to cover. classifier: task_index and search_tier, one row for each task. Rows for tasks that a report
    needn't cover are out of scope and left out. A report has to have one row for each of its tasks: fewer or more are a
    rows_differ, tasks without one a rows_missing that names the first most of them, in order.
    """
    wanted = expected.select("report", "task_index").distinct()
    numbered = reports.withColumn("task_index", F.coalesce(F.trim(F.col("task_index").cast("string")).try_cast("long"), F.lit(0)))
    tiers = classifier.select("task_index", F.coalesce("search_tier", F.lit("")).alias("classifier_tier"))
    # One full join serves the rules by row, the counts and what is missing.
    every = wanted.withColumn("_wanted", F.lit(True)).join(numbered.withColumn("_row", F.lit(True)), ["report", "task_index"], "left").join(tiers, "task_index", "left")
    rules = {c: r for c, r in row_rules(required).items() if not (allow_unresolved and c == "blocks_merge")}
    codes = F.array_compact(F.array(*(F.when(F.col("_row") & bad, F.lit(code)) for code, bad in rules.items())))
    by_row = every.select("report", "task_index", F.explode(codes).alias("code"), F.lit(None).cast("string").alias("detail"))

    per_task = every.groupBy("report", "task_index").agg(F.count("_row").alias("n"))
    missing = per_task.where("n = 0").select("report", "task_index")
    counts = per_task.groupBy("report").agg(F.count(F.lit(1)).alias("n_wanted"), F.sum("n").alias("n_rows"), F.count_if(F.col("n") == 0).alias("n_missing"))
    differ = counts.where("n_wanted <> n_rows").select("report", F.lit("rows_differ").alias("code"), F.concat(F.lit("expected "), F.col("n_wanted"), F.lit(", found "), F.col("n_rows")).alias("detail"))
    first = top_in_group(missing, ["report"], ["task_index"], most).groupBy("report").agg(F.array_join(F.sort_array(F.collect_list("task_index")), ",").alias("detail"))
    whole = differ.unionByName(first.select("report", F.lit("rows_missing").alias("code"), "detail"))
    return by_row.unionByName(whole.select("report", F.lit(None).cast("long").alias("task_index"), "code", "detail"))


def corrected(reports: DataFrame, tasks: DataFrame, classifier: DataFrame, columns: list[str]) -> DataFrame:
    """The rows that edit_row decisions put in place: columns of the correction, those of the task and of the classifier first.

    Identity comes from the task and the classifier's own columns from its row, whatever the correction says; what
    the correction lacks is empty. Corrections that aren't objects with all columns give no row.
    """
    said = _text("corrected_result_row_json")
    edits = reports.where((_text("recommended_action") == "edit_row") & object_without(said, columns).isNull())
    named = edits.select(F.trim(F.col("task_index").cast("string")).try_cast("long").alias("_task"), said.alias("_row"))
    own = tasks.select(F.col("task_index").cast("long").alias("_task"), *(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(f"_t_{c}") for c in FROM_TASK))
    levels = classifier.select(F.col("task_index").cast("long").alias("_task"), F.lit(True).alias("_classified"), *(F.coalesce(F.col(c), F.lit("")).alias(f"_c_{c}") for c in FROM_CLASSIFIER))
    joined = named.join(own, "_task", "left").join(levels, "_task", "left")

    def value(c: str) -> Column:
        said = F.coalesce(F.get_json_object("_row", f"$.{c}"), F.lit(""))
        if c in FROM_TASK:
            return F.coalesce(F.col(f"_t_{c}"), said)
        return F.when(F.col("_classified"), F.col(f"_c_{c}")).otherwise(said) if c in FROM_CLASSIFIER else said

    return joined.select(*(value(c).alias(c) for c in columns))
