"""Rules that rows of results, classifiers and verifiers must keep, and what brings rows into their form.

A rule is a named expression of what is wrong; quality.broken_rules lists those that a row breaks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import blank, error_category, error_source, error_task, stripped
from terrace.functions.values import bucketed, is_json_list, json_list, list_length, normal_list, split_list
from terrace.operators.ordering import cut, top_in_group

# What a column may hold.
ORIGINS = ("layer1_or_l2", "protocol_or_app", "exchange_token", "stablecoin", "wrapped_or_bridged_asset", "liquid_staking_or_restaking", "asset_backed_or_rwa", "meme_or_community", "governance_or_utility")
LIKELIHOODS = ("high", "medium", "low", "none", "unclear")
YES_NO = ("yes", "no")
LEVELS = ("high", "medium", "low")
TIERS = ("full", "light", "skip_candidate")
ENTITY_TYPES = ("company", "foundation", "issuer", "association", "trust", "dao_legal_wrapper", "nonprofit", "government_entity", "other_legal_entity", "unclear")
RESULT = (
    "task_index", "canonical_slug", "token_symbol", "token_name", "token_origin_type", "entity_link_likelihood", "entity_search_required", "entity_search_reason", "project_name", "project_url", "mapped_entity_name", "mapped_entity_legal_name",
    "mapped_entity_type", "mapped_entity_url", "mapped_entity_country", "entity_relation_type", "status", "completed_at", "has_entity_evidence", "evidence_urls", "evidence_source_types", "confidence", "needs_manual_review",
)
LISTS = ("project_name", "project_url", "mapped_entity_name", "mapped_entity_legal_name", "mapped_entity_type", "mapped_entity_url", "mapped_entity_country", "entity_relation_type")

TIME = r"^[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}Z$"


def outside(column: Column, allowed: tuple[str, ...]) -> Column:
    """Whether a value, null included, isn't allowed."""
    return F.coalesce(~column.isin(*allowed), F.lit(True))


def _text(name: str) -> Column:
    return stripped(F.col(name))


def result_rules() -> dict[str, Column]:
    """What is wrong with a result row, by name of the rule."""
    searched, mapped = _text("entity_search_required") == "yes", list_length(_text("mapped_entity_name"))
    urls, sources, evidence = split_list(F.col("evidence_urls")), split_list(F.col("evidence_source_types")), F.lower(_text("has_entity_evidence"))
    rules = {}
    for c in LISTS:
        rules[f"{c}_blank"] = _text(c) == ""
        rules[f"{c}_not_a_list"] = (_text(c) != "") & ~is_json_list(_text(c))
    return rules | {
        "status_not_completed": ~F.col("status").eqNullSafe("completed"),
        "origin_invalid": outside(F.col("token_origin_type"), ORIGINS),
        "likelihood_invalid": outside(F.col("entity_link_likelihood"), LIKELIHOODS),
        "search_required_invalid": outside(F.col("entity_search_required"), YES_NO),
        "manual_review_invalid": outside(F.col("needs_manual_review"), YES_NO),
        "confidence_invalid": outside(F.col("confidence"), LEVELS),
        "unsearched_without_reason": F.col("entity_search_required").eqNullSafe("no") & blank(F.col("entity_search_reason")),
        "evidence_blank": evidence == "",
        "searched_without_urls": searched & (F.size(urls) == 0),
        "searched_without_sources": searched & (F.size(sources) == 0),
        "searched_with_bare_answer": searched & evidence.isin(*YES_NO),
        "urls_not_http": F.exists(urls, lambda u: ~F.regexp_like(u, F.lit("^https?://"))),
        "sources_not_labels": F.exists(sources, lambda s: ~F.regexp_like(s, F.lit("^[a-z0-9_]+$"))),
        "types_not_aligned": (mapped > 0) & (list_length(_text("mapped_entity_type")) != mapped),
        "type_invalid": F.exists(json_list(_text("mapped_entity_type")), lambda t: F.coalesce(~t.isin(*ENTITY_TYPES), F.lit(True))),
        "mapped_without_any_url": (mapped > 0) & blank(F.col("mapped_entity_url")) & blank(F.col("evidence_urls")),
        "mapped_without_urls": (mapped > 0) & (F.size(urls) == 0),
        "mapped_without_sources": (mapped > 0) & (F.size(sources) == 0),
        "mapped_without_affirmation": (mapped > 0) & evidence.isin("", "no", "none", "false"),
        "unmapped_with_bare_yes": (mapped == 0) & searched & (evidence == "yes"),
    }


def classifier_rules() -> dict[str, Column]:
    """What is wrong with a classifier row, by name of the rule."""
    tier, required, flags = F.col("search_tier"), F.col("entity_search_required"), _text("risk_flags")
    return {
        "origin_invalid": outside(F.col("token_origin_type"), ORIGINS),
        "likelihood_invalid": outside(F.col("entity_link_likelihood"), LIKELIHOODS),
        "tier_invalid": outside(tier, TIERS),
        "search_required_invalid": outside(required, YES_NO),
        "tier_without_search": tier.isin("full", "light") & ~required.eqNullSafe("yes"),
        "skipped_with_search": (tier == "skip_candidate") & ~required.eqNullSafe("no"),
        "skipped_though_likely": (tier == "skip_candidate") & F.col("entity_link_likelihood").isin("high", "medium", "unclear"),
        "flags_blank": flags == "",
        "flags_not_a_list": (flags != "") & ~is_json_list(flags),
        "reason_blank": blank(F.col("classifier_reason")),
    }


def repaired_result(df: DataFrame) -> DataFrame:
    """Result rows whose values stand in a neighbour's column, put back by nine moves.

    The moves go one after another, as each reads what those before have left: search flag and reason change places; text
    in the link column is evidence; a status is a project's name where that is blank; a list of links in the time column
    goes to the links; "completed" in the entity's name is the status, and a time in its legal name the time; links in the
    confidence column and kinds of source in the review column go to the empty columns that they belong in, which leaves a
    low confidence and a review; lists become compact JSON. Rows are written between moves, as the planner would put the
    expressions of one into those of the next, which multiply.
    """
    empty = lambda c: _text(c).isin("", "[]")
    piped = lambda c, pattern: F.contains(_text(c), F.lit("|")) & (F.size(split_list(F.col(c))) > 0) & F.forall(split_list(F.col(c)), lambda x: F.regexp_like(x, F.lit(pattern)))

    def move(df: DataFrame, when: Column, new: dict[str, Column]) -> DataFrame:
        return df.withColumn("_moves", F.coalesce(when, F.lit(False))).withColumns({c: F.when(F.col("_moves"), v).otherwise(F.col(c)) for c, v in new.items()})

    df = move(df, _text("entity_search_required").isin("light", "deep", "skip_candidate") & _text("entity_search_reason").isin(*YES_NO), {"entity_search_required": _text("entity_search_reason"), "entity_search_reason": _text("entity_search_required")})
    text = ~blank(F.col("project_url")) & ~is_json_list(_text("project_url")) & empty("has_entity_evidence") & ~F.regexp_like(_text("project_url"), F.lit("^https?://"))
    df = cut(move(df, text, {"has_entity_evidence": _text("project_url"), "project_url": F.lit("[]")}))
    df = move(df, empty("project_name") & (_text("status") != ""), {"project_name": normal_list(F.col("status"))})
    df = cut(move(df, is_json_list(_text("completed_at")) & normal_list(F.col("project_url")).isin("", "[]"), {"project_url": normal_list(F.col("completed_at")), "completed_at": F.lit("")}))
    df = move(df, (_text("status") != "completed") & (_text("mapped_entity_name") == "completed"), {"status": F.lit("completed"), "mapped_entity_name": F.lit("[]"), "mapped_entity_type": F.lit("[]")})
    df = move(df, F.col("_moves") & F.regexp_like(_text("mapped_entity_legal_name"), F.lit(TIME)), {"completed_at": _text("mapped_entity_legal_name"), "mapped_entity_legal_name": F.lit("[]")})
    df = move(cut(df), piped("confidence", "^https?://") & (F.size(split_list(F.col("evidence_urls"))) == 0), {"evidence_urls": _text("confidence"), "confidence": F.lit("low")})
    df = move(df, piped("needs_manual_review", "^[a-z0-9_]+$") & (F.size(split_list(F.col("evidence_source_types"))) == 0), {"evidence_source_types": _text("needs_manual_review"), "needs_manual_review": F.lit("yes")})
    return cut(df).withColumns({c: normal_list(F.col(c)) for c in LISTS}).drop("_moves")


def evidence_text() -> Column:
    """A sentence where a searched row's evidence is a bare yes or no: what was cited, and whether an entity is mapped."""
    flag, mapped = _text("has_entity_evidence"), F.json_array_length(normal_list(F.col("mapped_entity_name")))
    sources = split_list(F.col("evidence_source_types"))
    cited = F.when(F.size(sources) > 0, F.array_join(F.slice(sources, 1, 3), ", ")).otherwise("official project sources")
    # The sentences.
    found, none = "; the cited materials support the mapped entity.", "; no reliable legal-entity mapping surfaced from those sources."
    sentence = F.concat(F.lit("Reviewed canonical token pages and cited "), cited, F.when(F.coalesce(mapped, F.lit(0)) > 0, found).otherwise(none))
    return F.when(F.lower(flag).isin(*YES_NO) & (_text("entity_search_required") == "yes"), sentence).otherwise(flag)


def canonical_result(df: DataFrame) -> DataFrame:
    """Result rows in canonical form, with just the columns of a result besides those that it hasn't.

    Null and absent columns are empty; "complete", so written, is completed; levels and lists take their form before and
    after shifted values are put back; a bare yes or no as evidence becomes a sentence.
    """
    named = {c.lower() for c in df.columns}
    df = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("")) if c in named else F.lit("") for c in RESULT})
    df = df.withColumns({"status": F.when(F.col("status") == "complete", "completed").otherwise(F.col("status")), "confidence": bucketed(F.col("confidence")), **{c: normal_list(F.col(c)) for c in LISTS}})
    return cut(repaired_result(cut(df))).withColumn("has_entity_evidence", evidence_text()).withColumn("confidence", bucketed(F.col("confidence")))


def identity_changes(rows: DataFrame, tasks: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """key, field, was and now for each identity field of a row that differs from its task's; tasks decide."""
    joined = rows.select(key, *(F.col(f).alias(f"_row_{f}") for f in fields)).join(tasks.select(key, *fields), key)
    differs = [F.when(~F.col(f"_row_{f}").eqNullSafe(F.col(f)), F.struct(F.lit(f).alias("field"), F.col(f"_row_{f}").alias("was"), F.col(f).alias("now"))) for f in fields]
    return joined.select(key, F.explode(F.array_compact(F.array(*differs))).alias("x")).select(key, "x.*")


def override_summary(changes: DataFrame, key: str, source: str, order: list[str], names: list[str], most: int = 10) -> DataFrame:
    """How many rows had an identity field overridden: a row for each source, and one with null for all, which has samples.

    changes: key, source, order and field, was and now, as identity_changes gives them. A row with several changed fields
    counts once. The samples are the first rows of the run by order, joined by line breaks, each with all its changes in
    the order of names.
    """
    place = F.array_position(F.array(*map(F.lit, names)), F.col("field"))
    told = F.concat(F.col("field"), F.lit(" overridden from '"), F.coalesce(F.col("was").cast("string"), F.lit("")), F.lit("' to '"), F.coalesce(F.col("now").cast("string"), F.lit("")), F.lit("'"))
    rows = changes.groupBy(key, source, *order).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct(place.alias("p"), told.alias("t")))), lambda x: x["t"]), "; ").alias("told"))
    counts = rows.rollup(source).agg(F.count(F.lit(1)).alias("n_rows"), F.grouping(source).alias("_all"))
    # As many rows as samples.
    first = rows.orderBy(*order).limit(most).select(F.struct(*order, F.concat(F.col(source), F.lit(": task_index="), F.col(key).cast("string"), F.lit(": "), "told").alias("t")).alias("x"))
    samples = first.agg(F.array_join(F.transform(F.sort_array(F.collect_list("x")), lambda x: x["t"]), "\n").alias("samples"))
    return counts.join(F.broadcast(samples.withColumn("_all", F.lit(1).cast("byte"))), "_all", "left").select(source, "n_rows", "samples")


def labels_differ(flags: dict[str, Column], labels: Column) -> Column:
    """Whether a JSON list of labels isn't the names of the flags that say yes, in their order."""
    own = F.filter(F.array(*(F.when(F.trim(v) == "yes", F.lit(k)) for k, v in flags.items())), lambda x: x.isNotNull())
    return ~json_list(labels).eqNullSafe(own)


def unexpected_columns(df: DataFrame, allowed: list[str]) -> None:
    """Raises if df has columns that a sink doesn't take."""
    extra = [c for c in df.columns if c not in allowed]
    if extra:
        raise ValueError(f"unexpected columns: {', '.join(extra)}")


def errors_by_batch(errors: DataFrame, error: str, batches: DataFrame, tasks: DataFrame) -> DataFrame:
    """errors with batch_file: that of the source path they begin with, else that of the task they name, else null.

    batches: path and batch_file, one row for each path. tasks: task_index and batch_file.
    """
    named = errors.withColumns({"_source": error_source(F.col(error)), "_task": error_task(F.col(error))})
    by_path = named.join(batches.select(F.col("path").alias("_source"), F.col("batch_file").alias("_by_path")), "_source", "left")
    by_task = by_path.join(tasks.select(F.col("task_index").alias("_task"), F.col("batch_file").alias("_by_task")), "_task", "left")
    return by_task.withColumn("batch_file", F.coalesce("_by_path", "_by_task")).select(*errors.columns, "batch_file")


def error_buckets(errors: DataFrame, batch: str, error: str, order: str, severe: int = 8, most: int = 5) -> DataFrame:
    """Batches that their errors send back: error_count, reason, quarantined and the first errors in order.

    reason has the categories in order, joined by pipes. Errors of single rows that have no category count by themselves:
    from as many as severe on, a batch has a severe_schema_error. Batches without any category are left out, and so are
    errors without a batch. quarantined: whether a schema error is among the reasons.
    """
    named = errors.where(F.col(batch).isNotNull()).withColumns({"_category": error_category(F.col(error)), "_source": error_source(F.col(error))})
    by_row = F.col("_category").isNull() & F.coalesce(F.startswith("_source", F.lit("/")), F.lit(False)) & F.contains(F.col(error), F.lit("task_index="))
    counts = named.groupBy(batch).agg(F.count(F.lit(1)).alias("error_count"), F.collect_set("_category").alias("_reasons"), F.count_if(by_row).alias("_by_row"))
    reasons = F.sort_array(F.when(F.col("_by_row") >= severe, F.array_append("_reasons", F.lit("severe_schema_error"))).otherwise(F.col("_reasons")))
    first = top_in_group(named, [batch], [order], most).groupBy(batch).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("place", F.col(error).alias("e")))), lambda x: x["e"]), " || ").alias("sample_errors"))
    kept = counts.withColumn("_reasons", reasons).where(F.size("_reasons") > 0)
    return kept.join(first, batch).select(batch, "error_count", F.array_join("_reasons", "|").alias("reason"), F.arrays_overlap("_reasons", F.array(F.lit("schema_error"), F.lit("severe_schema_error"))).alias("quarantined"), "sample_errors")
