"""Queries over rows of results, attempts and schedules that are made from the driver's tables, with their SQL.

Registered beside those of catalogue. varied() and varied_sql() make the same rows for either side: column i of key k
holds value (k // stride_i) mod n_i, so that values meet in all combinations.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.functions import html, text, values
from terrace.operators import catalog, match, quality, rounds, selection, validate
from terrace.operators.ordering import numbered
from terrace.plans.catalogue import _SIDES_SQL, NOUNS, _matched, query

STRIDES = (1, 2, 3, 5, 7, 11, 13, 17, 19, 23, 29, 31, 37, 41, 43, 47, 53, 59, 61, 67, 71)


def varied(df, key: str, columns: dict[str, list]):
    at = lambda stride, n: (F.floor(F.col(key) / stride) % n + 1).cast("int")
    return df.select(F.col(key).cast("long").alias("k"), *(F.element_at(F.array(*map(F.lit, vs)), at(s, len(vs))).alias(c) for (c, vs), s in zip(columns.items(), STRIDES)))


def _literal(v) -> str:
    return "NULL" if v is None else str(v) if isinstance(v, (int, float)) else "'" + v.replace("'", "''") + "'"


def varied_sql(table: str, key: str, columns: dict[str, list]) -> str:
    return f"(SELECT {key}::BIGINT AS k, " + ", ".join(f"([{', '.join(map(_literal, vs))}])[({key} // {s}) % {len(vs)} + 1] AS {c}" for (c, vs), s in zip(columns.items(), STRIDES)) + f" FROM {table})"


def _is_list(x: str) -> str:
    return f"(CASE WHEN json_valid({x}) THEN json_type({x}) = 'ARRAY' ELSE false END)"


def _length(x: str) -> str:
    return f"(CASE WHEN {_is_list(x)} THEN json_array_length({x}) ELSE -1 END)"


def _items(x: str) -> str:
    return f"[trim(v) FOR v IN (CASE WHEN {_is_list(x)} THEN from_json({x}, '[\"VARCHAR\"]') ELSE string_split(coalesce({x}, ''), '|') END) IF trim(v) <> '']"


def _in(values_: tuple[str, ...]) -> str:
    return "(" + ", ".join(f"'{v}'" for v in values_) + ")"


def _rules_sql(rows: str, rules: dict[str, str]) -> str:
    return "SELECT k, code FROM (SELECT k, unnest([" + ", ".join(f"CASE WHEN {r} THEN '{c}' END" for c, r in rules.items()) + f"]) AS code FROM {rows}) WHERE code IS NOT NULL"


_LISTED = ["[]", '["a"]', "", "a|b", None, '["a", "b"]', "['a']"]
RESULT = {
    "status": ["completed", "failed", None], "token_origin_type": ["stablecoin", "other", None, "exchange_token"], "entity_link_likelihood": ["high", "none", "maybe"],
    "entity_search_required": ["yes", "no", " yes", None, "maybe"], "needs_manual_review": ["no", "yes", "", "yes"], "confidence": ["high", "low", "0.9", None], "entity_search_reason": ["known", "", " ", None],
    "has_entity_evidence": ["site names it", "yes", "No", "", None, "none"], "evidence_urls": ["https://a.com", "", "https://a.com | ftp://b.org", '["http://a.com", " "]', "[]", None],
    "evidence_source_types": ["website", "", "web_site|News!", '["press"]'], "mapped_entity_name": ['["a"]', "[]", '["a","b"]', "", "a"], "mapped_entity_type": ['["company"]', "[]", '["company", "club"]', "x", '["trust","issuer"]'],
    "mapped_entity_url": ["", "[]", None, '["https://a.com"]'], **{c: _LISTED[i:] + _LISTED[:i] for i, c in enumerate(c for c in validate.LISTS if c not in ("mapped_entity_name", "mapped_entity_type", "mapped_entity_url"))},
}
_SEARCHED, _MAPPED = "trim(coalesce(entity_search_required, '')) = 'yes'", _length("mapped_entity_name")
_EVIDENCE, _URLS, _SOURCES = "lower(trim(coalesce(has_entity_evidence, '')))", _items("evidence_urls"), _items("evidence_source_types")
_RESULT_SQL = {}
for _c in validate.LISTS:
    _RESULT_SQL[f"{_c}_blank"] = f"trim(coalesce({_c}, '')) = ''"
    _RESULT_SQL[f"{_c}_not_a_list"] = f"trim(coalesce({_c}, '')) <> '' AND NOT {_is_list(_c)}"
_RESULT_SQL |= {
    "status_not_completed": "status IS DISTINCT FROM 'completed'", "origin_invalid": f"coalesce(token_origin_type, '') NOT IN {_in(validate.ORIGINS)}",
    "likelihood_invalid": "coalesce(entity_link_likelihood, '') NOT IN ('high','medium','low','none','unclear')", "search_required_invalid": "coalesce(entity_search_required, '') NOT IN ('yes','no')",
    "manual_review_invalid": "coalesce(needs_manual_review, '') NOT IN ('yes','no')", "confidence_invalid": "coalesce(confidence, '') NOT IN ('high','medium','low')",
    "unsearched_without_reason": "entity_search_required = 'no' AND trim(coalesce(entity_search_reason, '')) = ''", "evidence_blank": f"{_EVIDENCE} = ''",
    "searched_without_urls": f"{_SEARCHED} AND len({_URLS}) = 0", "searched_without_sources": f"{_SEARCHED} AND len({_SOURCES}) = 0", "searched_with_bare_answer": f"{_SEARCHED} AND {_EVIDENCE} IN ('yes','no')",
    "urls_not_http": f"len([u FOR u IN {_URLS} IF NOT regexp_matches(u, '^https?://')]) > 0", "sources_not_labels": f"len([u FOR u IN {_SOURCES} IF NOT regexp_matches(u, '^[a-z0-9_]+$')]) > 0",
    "types_not_aligned": f"{_MAPPED} > 0 AND {_length('mapped_entity_type')} <> {_MAPPED}",
    "type_invalid": f"len([t FOR t IN (CASE WHEN {_is_list('mapped_entity_type')} THEN from_json(mapped_entity_type, '[\"VARCHAR\"]') ELSE [] END) IF t NOT IN {_in(validate.ENTITY_TYPES)}]) > 0",
    "mapped_without_any_url": f"{_MAPPED} > 0 AND trim(coalesce(mapped_entity_url, '')) = '' AND trim(coalesce(evidence_urls, '')) = ''", "mapped_without_urls": f"{_MAPPED} > 0 AND len({_URLS}) = 0",
    "mapped_without_sources": f"{_MAPPED} > 0 AND len({_SOURCES}) = 0", "mapped_without_affirmation": f"{_MAPPED} > 0 AND {_EVIDENCE} IN ('', 'no', 'none', 'false')",
    "unmapped_with_bare_yes": f"{_MAPPED} = 0 AND {_SEARCHED} AND {_EVIDENCE} = 'yes'",
}


@query(_rules_sql(varied_sql("orders", "o_orderkey", RESULT), _RESULT_SQL))
def result_errors(read):
    return quality.broken_rules(varied(read("orders"), "o_orderkey", RESULT), validate.result_rules(), ["k"])


CLASSIFIER = {
    "token_origin_type": ["stablecoin", "x", None], "entity_link_likelihood": ["high", "low", "unclear", "none", "?"], "search_tier": ["full", "light", "skip_candidate", "deep", None],
    "entity_search_required": ["yes", "no", None, "maybe"], "risk_flags": ["[]", '["a"]', "", " ", "a|b", None], "classifier_reason": ["known", "", None, " "],
}


@query(_rules_sql(varied_sql("customer", "c_custkey", CLASSIFIER), {
    "origin_invalid": f"coalesce(token_origin_type, '') NOT IN {_in(validate.ORIGINS)}", "likelihood_invalid": "coalesce(entity_link_likelihood, '') NOT IN ('high','medium','low','none','unclear')",
    "tier_invalid": "coalesce(search_tier, '') NOT IN ('full','light','skip_candidate')", "search_required_invalid": "coalesce(entity_search_required, '') NOT IN ('yes','no')",
    "tier_without_search": "search_tier IN ('full','light') AND entity_search_required IS DISTINCT FROM 'yes'", "skipped_with_search": "search_tier = 'skip_candidate' AND entity_search_required IS DISTINCT FROM 'no'",
    "skipped_though_likely": "search_tier = 'skip_candidate' AND entity_link_likelihood IN ('high','medium','unclear')", "flags_blank": "trim(coalesce(risk_flags, '')) = ''",
    "flags_not_a_list": f"trim(coalesce(risk_flags, '')) <> '' AND NOT {_is_list('risk_flags')}", "reason_blank": "trim(coalesce(classifier_reason, '')) = ''",
}))
def classifier_errors(read):
    return quality.broken_rules(varied(read("customer"), "c_custkey", CLASSIFIER), validate.classifier_rules(), ["k"])


RAW = {
    "status": ["complete", "Completed", "completed", "x|y", "", "failed"], "confidence": ["0.8", "high", "HIGH", "0.3", None, "https://a.com|http://b.com", ""], "mapped_entity_name": ["a|b", "[]", "none", "", '["a", "b"]', "completed", None],
    "mapped_entity_legal_name": ["2024-01-02T03:04:05Z", "", "[]"], "entity_search_required": ["yes", "light", "no", "deep", None], "entity_search_reason": ["known", "yes", "no", ""], "project_url": ["", "site text", "[]", "https://a.com", '["https://b.com"]'],
    "project_name": ["", "[]", "p", '["p"]'], "completed_at": ["2024-05-05T00:00:00Z", '["https://c.com"]', "[]", ""], "has_entity_evidence": ["yes", "", "No", "named on the site", "[]"], "evidence_source_types": ["", "site|press|blog|wiki", None, '["site"]'],
    "needs_manual_review": ["no", "site|press", "yes", "Site|press"], "evidence_urls": ["", "https://e.com", None],
}
#: Every text of RAW that a list is made from, and what it becomes.
_NORMAL = {"": "", "[]": "[]", "none": "[]", '["a", "b"]': '["a","b"]', "a|b": '["a","b"]', "x|y": '["x","y"]'}
_NORMAL |= {v: v if v.startswith("[") else f'["{v}"]' for c in ("status", "mapped_entity_name", "mapped_entity_legal_name", "project_url", "project_name", "completed_at") for v in RAW[c] if v and v not in _NORMAL}
_NORMAL |= {v: v for v in list(_NORMAL.values())}


def _normal(x: str) -> str:
    return f"(CASE {x} " + " ".join(f"WHEN {_literal(k)} THEN {_literal(v)}" for k, v in _NORMAL.items()) + f" ELSE {x} END)"


def _level(x: str) -> str:
    return f"(CASE {x} WHEN '0.8' THEN 'high' WHEN '0.3' THEN 'low' ELSE {x} END)"


def _moved(rows: str, when: str, new: dict[str, str]) -> str:
    return f"(SELECT * REPLACE ({', '.join(f'CASE WHEN moves THEN {v} ELSE {c} END AS {c}' for c, v in new.items())}) FROM (SELECT * EXCLUDE (moves), coalesce({when}, false) AS moves FROM {rows}))"


_RAW_LISTS = [c for c in validate.LISTS if c in RAW]
_CANON = "(SELECT *, false AS moves FROM (SELECT k, " + ", ".join(f"coalesce({c}, '') AS {c}" for c in RAW) + f" FROM {varied_sql('orders', 'o_orderkey', RAW)}))"
_CANON = f"(SELECT * REPLACE (CASE WHEN status = 'complete' THEN 'completed' ELSE status END AS status, {_level('confidence')} AS confidence, {', '.join(f'{_normal(c)} AS {c}' for c in _RAW_LISTS)}) FROM {_CANON})"
_CANON = _moved(_CANON, "entity_search_required IN ('light','deep','skip_candidate') AND entity_search_reason IN ('yes','no')", {"entity_search_required": "entity_search_reason", "entity_search_reason": "entity_search_required"})
_CANON = _moved(_CANON, f"project_url <> '' AND NOT {_is_list('project_url')} AND has_entity_evidence IN ('', '[]') AND NOT regexp_matches(project_url, '^https?://')", {"has_entity_evidence": "project_url", "project_url": "'[]'"})
_CANON = _moved(_CANON, "project_name IN ('', '[]') AND status <> ''", {"project_name": _normal("status")})
_CANON = _moved(_CANON, f"{_is_list('completed_at')} AND project_url IN ('', '[]')", {"project_url": "completed_at", "completed_at": "''"})
_CANON = _moved(_CANON, "confidence LIKE 'https://a.com|%' AND evidence_urls = ''", {"evidence_urls": "confidence", "confidence": "'low'"})
_CANON = _moved(_CANON, "needs_manual_review = 'site|press' AND evidence_source_types = ''", {"evidence_source_types": "needs_manual_review", "needs_manual_review": "'yes'"})
_CITED = "CASE WHEN evidence_source_types = '' THEN 'official project sources' ELSE array_to_string((" + _items("evidence_source_types") + ")[:3], ', ') END"
_CANON_SQL = f"""SELECT k, {', '.join(c for c in RAW if c != 'has_entity_evidence')}, CASE WHEN lower(has_entity_evidence) IN ('yes','no') AND entity_search_required = 'yes' THEN 'Reviewed canonical token pages and cited ' || {_CITED} ||
 CASE WHEN mapped_entity_name IN ('', '[]') THEN '; no reliable legal-entity mapping surfaced from those sources.' ELSE '; the cited materials support the mapped entity.' END ELSE has_entity_evidence END AS has_entity_evidence FROM {_CANON}"""


@query(_CANON_SQL)
def canonical_results(read):
    return validate.canonical_result(varied(read("orders"), "o_orderkey", RAW)).select("k", *RAW)


SHIFTED = {"status": ["", "completed", "failed"], "mapped_entity_name": ["completed", '["a"]', " completed "], "mapped_entity_legal_name": ["2024-01-02T03:04:05Z", "Inc", "", "2024-01-02"], "mapped_entity_type": ["x", "[]"], "project_name": ["", '["p"]']}
_SHIFT = "(SELECT *, trim(mapped_entity_name) = 'completed' AND status <> 'completed' AS m, mapped_entity_legal_name = '2024-01-02T03:04:05Z' AS t FROM " + varied_sql("supplier", "s_suppkey", SHIFTED) + ")"


@query(f"""SELECT k, CASE WHEN m THEN 'completed' ELSE status END AS status, CASE WHEN m AND t THEN mapped_entity_legal_name ELSE '' END AS completed_at, CASE WHEN m THEN '[]' WHEN trim(mapped_entity_name) = 'completed' THEN '["completed"]' ELSE mapped_entity_name END AS mapped_entity_name,
CASE WHEN m THEN '[]' WHEN mapped_entity_type = 'x' THEN '["x"]' ELSE mapped_entity_type END AS mapped_entity_type, CASE WHEN m AND t THEN '[]' WHEN mapped_entity_legal_name = '' THEN '' ELSE '["' || mapped_entity_legal_name || '"]' END AS mapped_entity_legal_name,
CASE WHEN project_name = '' AND status <> '' THEN '["' || status || '"]' ELSE project_name END AS project_name FROM {_SHIFT}""")
def shifted_repair(read):
    """The move of a status and a time out of the entity's columns, on rows whose lists aren't in form yet."""
    rows = varied(read("supplier"), "s_suppkey", SHIFTED)
    whole = rows.withColumns({c: F.lit("") for c in validate.RESULT if c not in SHIFTED})
    return validate.repaired_result(whole).select("k", "completed_at", *SHIFTED)


_DRIFT_SQL = "(SELECT o_orderkey AS k, o_orderstatus AS was_s, CASE WHEN o_orderkey % 7 = 0 THEN 'X' ELSE o_orderstatus END AS now_s, o_orderpriority AS was_p, CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderpriority END AS now_p FROM orders)"
_CHANGES_SQL = f"SELECT k, 'status' AS field, was_s AS was, now_s AS now FROM {_DRIFT_SQL} WHERE was_s IS DISTINCT FROM now_s UNION ALL SELECT k, 'priority', was_p, now_p FROM {_DRIFT_SQL} WHERE was_p IS DISTINCT FROM now_p"


def _changes(read):
    rows = read("orders").select(F.col("o_orderkey").alias("k"), F.col("o_orderstatus").alias("status"), F.col("o_orderpriority").alias("priority"))
    tasks = rows.select("k", F.when(F.col("k") % 7 == 0, "X").otherwise(F.col("status")).alias("status"), F.when(F.col("k") % 5 != 0, F.col("priority")).alias("priority"))
    return validate.identity_changes(rows, tasks, "k", ["status", "priority"])


@query(_CHANGES_SQL)
def identity_changes(read):
    return _changes(read)


@query(f"""WITH c AS (SELECT *, CASE WHEN field = 'status' THEN 1 ELSE 2 END AS p, 's' || k % 3 AS source FROM ({_CHANGES_SQL})),
r AS (SELECT k, source, string_agg(field || ' overridden from ' || chr(39) || was || chr(39) || ' to ' || chr(39) || coalesce(now, '') || chr(39), '; ' ORDER BY p) AS told FROM c GROUP BY 1, 2)
SELECT source, count(*) AS n_rows, NULL AS samples FROM r GROUP BY 1 UNION ALL SELECT NULL, count(*), (SELECT string_agg(source || ': task_index=' || k || ': ' || told, chr(10) ORDER BY k) FROM (FROM r ORDER BY k LIMIT 10)) FROM r""")
def identity_overrides(read):
    changes = _changes(read).withColumn("source", F.concat(F.lit("s"), (F.col("k") % 3).cast("string")))
    return validate.override_summary(changes, "k", "source", ["k"], ["status", "priority"])


FLAGS = {"leads": ["yes", "no"], "follows": ["no", " yes ", None], "exits": ["yes", "", "no"], "labels": ["[]", '["leads"]', '["leads","exits"]', '["exits","leads"]', "x"]}


@query(f"SELECT k FROM {varied_sql('supplier', 's_suppkey', FLAGS)} WHERE CASE WHEN {_is_list('labels')} THEN labels ELSE '[]' END <> '[' || concat_ws(',', CASE WHEN trim(leads) = 'yes' THEN '\"leads\"' END, CASE WHEN trim(follows) = 'yes' THEN '\"follows\"' END, CASE WHEN trim(exits) = 'yes' THEN '\"exits\"' END) || ']'")
def label_mismatches(read):
    return varied(read("supplier"), "s_suppkey", FLAGS).where(validate.labels_differ({c: F.col(c) for c in ("leads", "follows", "exits")}, F.col("labels"))).select("k")


ERRORS = {"error": ["/b/batch_0003.csv: header mismatch", "/b/batch_0004.csv: expected 30 rows, found 12", "identity_drift: /b/batch_0003.csv: row 4", "x: row 5: expected task_index=5", "/c/none.csv: task_index=7 token=a: status must be completed", "<post-verifier-output>: task_index=9 needs_manual_review must be yes or no", "<other>: lost", "task_index=8 odd"]}
_ERRORS_SQL = f"""SELECT k, error, CASE k % 8 WHEN 0 THEN '/b/batch_0003.csv' WHEN 1 THEN '/b/batch_0004.csv' WHEN 2 THEN '/b/batch_0003.csv' WHEN 4 THEN '/c/none.csv' WHEN 5 THEN '<post-verifier-output>' WHEN 6 THEN '<other>' END AS source,
CASE k % 8 WHEN 3 THEN 5 WHEN 4 THEN 7 WHEN 5 THEN 9 WHEN 7 THEN 8 END AS task, CASE k % 8 WHEN 0 THEN 'header_mismatch' WHEN 1 THEN 'row_count_mismatch' WHEN 3 THEN 'row_order_mismatch' WHEN 4 THEN 'schema_error' WHEN 5 THEN 'schema_error' END AS category,
CASE k % 8 WHEN 0 THEN 'batch_0003' WHEN 1 THEN 'batch_0004' WHEN 2 THEN 'batch_0003' WHEN 3 THEN 'batch_0001' WHEN 4 THEN 'batch_0001' WHEN 5 THEN 'batch_0002' WHEN 7 THEN 'batch_0001' END AS batch_file FROM {varied_sql("supplier", "s_suppkey", ERRORS)}"""


def _errors(read):
    rows = varied(read("supplier"), "s_suppkey", ERRORS)
    batches = rows.sparkSession.createDataFrame([(f"/b/batch_{i:04d}.csv", f"batch_{i:04d}") for i in range(1, 6)], "path string, batch_file string")
    tasks = rows.sparkSession.range(1, 21).select(F.col("id").cast("int").alias("task_index"), F.format_string("batch_%04d", F.ceil(F.col("id") / 8)).alias("batch_file"))
    return validate.errors_by_batch(rows, "error", batches, tasks)


@query(_ERRORS_SQL)
def error_routes(read):
    e = F.col("error")
    return _errors(read).select("k", "error", text.error_source(e).alias("source"), text.error_task(e).alias("task"), text.error_category(e).alias("category"), "batch_file")


_BUCKETS = {"error": ["/b/a.csv: header mismatch", "/b/a.csv: task_index=3 token=x: odd value", "/b/a.csv: lost", "task_index=9 odd", "/b/a.csv: task_index=4: status must be completed", "/b/a.csv: task_index=5: strange", "<x>: task_index=6: strange"]}


@query(f"""WITH e AS (SELECT k, CASE WHEN k % 40 < 3 THEN NULL ELSE 'batch_' || (k // 40) END AS batch_file, CASE WHEN (k // 40) % 4 = 0 AND error NOT LIKE '%header%' AND error NOT LIKE '%status%' THEN '/b/a.csv: task_index=5: strange' WHEN (k // 40) % 4 = 1 THEN 'task_index=9 odd' ELSE error END AS error FROM {varied_sql("customer", "c_custkey", _BUCKETS)}),
c AS (SELECT *, CASE WHEN error LIKE '%header mismatch%' THEN 'header_mismatch' WHEN error LIKE '%status must be%' THEN 'schema_error' END AS category FROM e WHERE batch_file IS NOT NULL),
g AS (SELECT batch_file, count(*) AS error_count, list(DISTINCT category) FILTER (category IS NOT NULL) AS cs, count(*) FILTER (category IS NULL AND error LIKE '/%' AND error LIKE '%task_index=%') AS n, list(error ORDER BY k)[:5] AS first FROM c GROUP BY 1),
f AS (SELECT *, list_sort(list_concat(coalesce(cs, []), CASE WHEN n >= 8 THEN ['severe_schema_error'] ELSE [] END)) AS rs FROM g)
SELECT batch_file, error_count, array_to_string(rs, '|') AS reason, list_has_any(rs, ['schema_error','severe_schema_error']) AS quarantined, array_to_string(first, ' || ') AS sample_errors FROM f WHERE len(rs) > 0""")
def error_buckets(read):
    """Some batches have only uncategorised errors, which count by row from eight on, or drop out."""
    rows, at = varied(read("customer"), "c_custkey", _BUCKETS), F.floor(F.col("k") / 40)
    e = F.col("error")
    error = F.when((at % 4 == 0) & ~F.contains(e, F.lit("header")) & ~F.contains(e, F.lit("status")), "/b/a.csv: task_index=5: strange").when(at % 4 == 1, "task_index=9 odd").otherwise(e)
    named = rows.withColumns({"error": error, "batch_file": F.when(F.col("k") % 40 >= 3, F.concat(F.lit("batch_"), at.cast("string")))})
    return validate.error_buckets(named, "batch_file", "error", "k")


def _named_sides(read):
    rows = read("part").select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("name"), F.concat_ws("-", "p_brand", "p_size").alias("symbol"), F.concat(F.lit("s"), F.col("p_partkey").cast("string")).alias("slug"))
    return rows.withColumnRenamed("p_partkey", "left_id"), rows.withColumnRenamed("p_partkey", "right_id")


_PARTS_SQL = "(SELECT p_partkey AS id, p_name || ' ' || p_type AS name, p_brand || '-' || p_size AS symbol, 's' || p_partkey AS slug, regexp_replace(lower(p_name || ' ' || p_type), '[^a-z0-9]+', '', 'g') AS x FROM part)"
_NAME_SQL = """CASE WHEN b.id IS NULL THEN a.name WHEN a.id IS NULL THEN b.name WHEN a.x = b.x OR la = lb THEN CASE WHEN length(b.name) < length(a.name) OR (length(b.name) = length(a.name) AND lower(b.name) < lower(a.name)) THEN b.name ELSE a.name END
 WHEN CASE WHEN length(b.x) < length(a.x) THEN contains(a.x, b.x) ELSE contains(b.x, a.x) END THEN CASE WHEN length(b.name) < length(a.name) THEN b.name ELSE a.name END ELSE b.name END"""
_ENDLESS = "regexp_replace(regexp_replace(lower({0}), '\\b((" + "|".join(NOUNS) + ")[^a-z0-9]*)+$', ' '), '[^a-z0-9]+', '', 'g')"
_MASTER_SQL = f"""WITH {_SIDES_SQL}, s AS {_PARTS_SQL}, q AS (SELECT *, {_ENDLESS.format("name")} AS l FROM s)
SELECT coalesce(b.slug, a.slug) AS canonical_id, {_NAME_SQL.replace("la = lb", "a.l = b.l")} AS display_name, upper(coalesce(b.symbol, a.symbol)) AS display_symbol, (a.id IS NOT NULL)::INTEGER AS in_left, (b.id IS NOT NULL)::INTEGER AS in_right, m.match_method
FROM m LEFT JOIN q a ON a.id = m.left_id LEFT JOIN q b ON b.id = m.right_id"""


@query(_MASTER_SQL)
def master_list(read):
    return match.master_list(_matched(read), *_named_sides(read), NOUNS)


@query(f"WITH z AS ({_MASTER_SQL}) SELECT canonical_id, row_number() OVER (ORDER BY CASE WHEN try_cast(substr(canonical_id, 2) AS BIGINT) % 3 = 0 THEN try_cast(substr(canonical_id, 2) AS BIGINT) ELSE NULL END NULLS LAST, lower(canonical_id), canonical_id) AS place FROM z")
def master_order(read):
    """Every third row has a rank; the others follow by slug."""
    rows = master_list(read).select("canonical_id", F.substr(F.col("canonical_id"), F.lit(2)).alias("digits"))
    rank = F.when(F.col("digits").cast("long") % 3 == 0, F.col("digits")).otherwise("n/a")
    number = F.when(F.regexp_like("rank", F.lit("^[0-9]+$")), F.col("rank").try_cast("long"))
    placed = rows.withColumn("rank", rank).withColumns({"_last": number.isNull(), "_number": number, "_slug": F.lower("canonical_id")})
    return numbered(placed, ["_last", "_number", "_slug", "canonical_id"], "place").select("canonical_id", F.col("place").cast("long").alias("place"))


@query(r"""SELECT p_partkey, regexp_extract(l, '^\s*(.+?)\s+([A-Z0-9.\-]+)\s*$', 1) AS name, regexp_extract(l, '^\s*(.+?)\s+([A-Z0-9.\-]+)\s*$', 2) AS symbol, CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'https://x.com/' || p_brand END AS url,
 CASE WHEN length(c) > 30 THEN substr(c, 1, 26) || ' ...' ELSE c END AS sample FROM (SELECT *, p_name || ' ' || CASE WHEN p_partkey % 2 = 0 THEN upper(p_type) ELSE p_type END AS l, p_name || ' \| ' || p_type || ' \| ' || p_brand AS c FROM part)""")
def name_parts(read):
    label = F.concat_ws(" ", "p_name", F.when(F.col("p_partkey") % 2 == 0, F.upper("p_type")).otherwise(F.col("p_type")))
    found = text.name_and_symbol(label)
    return read("part").select("p_partkey", found["name"].alias("name"), found["symbol"].alias("symbol"), text.slug_url("https://x.com/", F.when(F.col("p_partkey") % 3 != 0, F.col("p_brand"))).alias("url"), text.table_sample(F.concat_ws("  | ", "p_name", "p_type", "p_brand"), 30).alias("sample"))


@query("""SELECT event_id, event_id % 50 AS number, coalesce(nullif(event_id % 7, 3), 0) AS attempt, event_type AS tag, CASE WHEN event_id % 4 <> 0 THEN date_trunc('second', ts) END AS at FROM events""")
def log_parts(read):
    k = F.col("event_id")
    name = F.concat(F.lit("/x/batch_"), F.lpad((k % 50).cast("string"), 4, "0"), F.lit(".jsonl"))
    folder = F.when(k % 7 == 3, "/x/attempt_none").otherwise(F.concat(F.lit("/x/attempt_"), (k % 7).cast("string")))
    line = F.concat(F.when(k % 4 != 0, F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss")).otherwise(""), F.lit(" ["), F.col("event_type"), F.lit("] done [x]"))
    return read("events").select("event_id", text.number_in(name, r"batch_(\d+)").cast("long").alias("number"), text.number_in(folder, r"attempt_(\d+)$").cast("long").alias("attempt"), text.log_tag(line).alias("tag"), text.log_time(line).alias("at"))


IDS = {"NoteID": [None, "", " "], "RowID": ["r1", None, " r2 ", ""], "Name": ["n"], "DealID": ["d1", "", "d2"]}


@query(f"""SELECT k, CASE WHEN trim(coalesce(RowID, '')) <> '' THEN 'RowID' WHEN trim(coalesce(DealID, '')) <> '' THEN 'DealID' ELSE '' END AS id_column,
CASE WHEN trim(coalesce(RowID, '')) <> '' THEN trim(RowID) ELSE trim(coalesce(DealID, '')) END AS id_value, trim(coalesce(RowID, '')) = '' AND trim(coalesce(DealID, '')) = '' AS unresolved FROM {varied_sql("customer", "c_custkey", IDS)}""")
def id_columns(read):
    rows = varied(read("customer"), "c_custkey", IDS)
    found = selection.first_id(rows)
    return rows.select("k", found["column"].alias("id_column"), found["value"].alias("id_value"), selection.unresolved(F.col("RowID"), F.col("DealID")).alias("unresolved"))


@query("SELECT c_name, '' AS extra, coalesce(c_nationkey::VARCHAR, '') AS c_nationkey FROM customer WHERE upper(c_mktsegment) IN ('BUILDING','MACHINERY') AND c_custkey NOT IN (7, 11)")
def selected_rows(read):
    rows = selection.members(read("customer"), "c_mktsegment", ["Building, MACHINERY", "building"], lower=True)
    return selection.projected(selection.without(rows, "c_custkey", [7, 11]), ["c_name", "extra", "c_nationkey"])


@query("""SELECT s_suppkey, CASE s_suppkey WHEN 3 THEN 1 WHEN 8 THEN 2 WHEN 5 THEN 4 END::BIGINT AS scope_order FROM supplier WHERE s_suppkey IN (3, 5, 8)""")
def scoped_rows(read):
    rows = read("supplier").select("s_suppkey", F.concat(F.lit("/in/batch_"), F.col("s_suppkey").cast("string"), F.lit(".jsonl")).alias("path"))
    asked = rows.sparkSession.createDataFrame([(1, "/in/batch_3.jsonl"), (2, "batch_8.jsonl"), (3, "batch_3.jsonl"), (4, " batch_5.jsonl "), (5, "")], "at long, value string")
    return selection.scoped(rows, "path", asked, "value", "at").select("s_suppkey", "scope_order")


QUEUE = {"queue_order": [0, 5, None, 2], "batch_number": [0, 3, 7], "note": ["rerun_manual_fallbacks/x", "", None, "qc forced: tier, qc forced: company", "tier"], "path": ["/a", "/rerun_manual_fallbacks/b", None]}


@query(f"""SELECT k, coalesce(CASE WHEN queue_order > 0 THEN queue_order END, CASE WHEN batch_number > 0 THEN batch_number END, 1000000000)::BIGINT AS place, contains(coalesce(note, ''), 'rerun_manual_fallbacks') OR contains(coalesce(path, ''), 'rerun_manual_fallbacks') AS manual,
contains(coalesce(note, ''), 'tier') AND contains(coalesce(note, ''), 'company') AS forced FROM {varied_sql("customer", "c_custkey", QUEUE)} WHERE k > 10 ORDER BY k LIMIT 500""")
def queue_places(read):
    rows = selection.window(varied(read("customer"), "c_custkey", QUEUE).where("k > 0"), ["k"], 10, 500)
    note, path = F.col("note"), F.col("path")
    return rows.select("k", selection.queue_place(F.col("queue_order"), F.col("batch_number")).cast("long").alias("place"), selection.marked("rerun_manual_fallbacks", note, path).alias("manual"), selection.every_marker(["tier", "company"], note, path).alias("forced"))


ATTEMPTS = {"state": ["completed", "partial_prefix", "header_only", "partial_misaligned", "missing"], "prefix_len": [0, 4, 9, None], "classifier_rows": [5, 0, 9], "result_rows": [4, 9, 0, 9], "last_activity": [1.5, 2.5, None], "mode": ["fresh_full_batch", "continue_from_prefix", "fresh_restart", "narrowed_suffix_only", None, "narrowed_suffix_only", ""]}
_ATTEMPT_SQL = f"(SELECT k // 4 AS batch, k AS attempt_index, * EXCLUDE (k), k % 4 = (k // 4) % 5 AS is_current FROM {varied_sql('orders', 'o_orderkey', ATTEMPTS)})"
_RANK_SQL = "(CASE state WHEN 'completed' THEN 4 WHEN 'partial_prefix' THEN 3 WHEN 'header_only' THEN 1 ELSE 0 END, coalesce(prefix_len, 0), least(classifier_rows, result_rows), coalesce(last_activity, 0), attempt_index)"


def _attempts(read):
    k = F.col("k")
    rows = varied(read("orders"), "o_orderkey", ATTEMPTS)
    return rows.withColumns({"batch": F.floor(k / 4).cast("long"), "attempt_index": k, "is_current": k % 4 == F.floor(k / 4) % 5}).drop("k")


@query(f"""WITH a AS {_ATTEMPT_SQL}, t AS (SELECT * FROM a QUALIFY row_number() OVER (PARTITION BY batch ORDER BY {_RANK_SQL} DESC) = 1), c AS (SELECT *, coalesce(nullif(mode, ''), 'fresh_full_batch') AS m FROM a WHERE is_current),
j AS (SELECT t.batch, t.attempt_index, t.state, t.prefix_len, c.attempt_index AS ci, c.state AS cs, c.prefix_len AS cp,
 c.attempt_index IS NOT NULL AND (c.m = 'fresh_restart' OR (t.state <> 'completed' AND (c.m IN ('fresh_full_batch', 'fresh_restart', 'continue_from_prefix') OR (least(c.classifier_rows, c.result_rows) > 0 AND coalesce(c.prefix_len, 0) >= coalesce(t.prefix_len, 0))))) AS kept_current
 FROM t LEFT JOIN c ON c.batch = t.batch)
SELECT batch, CASE WHEN kept_current THEN ci ELSE attempt_index END AS attempt_index, CASE WHEN kept_current THEN cs ELSE state END AS state, CASE WHEN kept_current THEN cp ELSE prefix_len END AS prefix_len, kept_current FROM j""")
def chosen_attempts(read):
    return rounds.chosen_attempts(_attempts(read), "batch")


@query(f"SELECT batch, max(coalesce(prefix_len, 0)) AS best_prefix_len, arg_max(attempt_index, (coalesce(prefix_len, 0), -attempt_index)) AS best_attempt FROM {_ATTEMPT_SQL} GROUP BY 1")
def best_snapshots(read):
    return rounds.snapshots(_attempts(read).withColumn("prefix_len", F.coalesce("prefix_len", F.lit(0))), "batch", "attempt_index", "prefix_len")


_ROUND_SQL = "(SELECT o_orderkey // 100 AS round_index, o_orderstatus = 'F' OR o_orderkey < 700 AS resolved, o_totalprice::BIGINT % 31 AS n, o_orderstatus = 'P' AS failed FROM orders)"
_PROGRESS_SQL = f"SELECT round_index, count(*) AS n_batches, count(*) FILTER (resolved) AS n_resolved, count(*) FILTER (NOT resolved) AS n_open, sum(n)::BIGINT AS n_rows, count(*) FILTER (failed) AS n_failed, bool_and(resolved) AS all_resolved FROM {_ROUND_SQL} GROUP BY 1"


def _progress(read):
    rows = read("orders").select(F.floor(F.col("o_orderkey") / 100).cast("long").alias("round_index"), ((F.col("o_orderstatus") == "F") | (F.col("o_orderkey") < 700)).alias("resolved"), (F.bround("o_totalprice", 0).cast("long") % 31).alias("n"), (F.col("o_orderstatus") == "P").alias("failed"))
    return rounds.round_progress(rows, "round_index", F.col("resolved"), F.col("n"), F.col("failed"))


@query(_PROGRESS_SQL)
def round_progress(read):
    return _progress(read)


@query(f"WITH p AS ({_PROGRESS_SQL}), f AS (SELECT min(round_index) FILTER (NOT all_resolved) AS resume_round FROM p) SELECT resume_round, (SELECT count(*) FROM p WHERE resume_round IS NULL OR round_index < resume_round) AS completed_rounds FROM f")
def resume_point(read):
    return rounds.resume_point(_progress(read), "round_index")


@query("SELECT min(o_orderkey // 30) AS first_incomplete FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def first_incomplete(read):
    tasks = read("orders").select("o_orderkey", F.floor(F.col("o_orderkey") / 30).cast("long").alias("batch"))
    return rounds.first_incomplete(tasks, "batch", read("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 40 < 15 THEN 1 ELSE 2 END AS shard, CASE WHEN o_orderkey % 40 < 15 THEN o_orderkey % 40 + 1 ELSE o_orderkey % 40 - 14 END AS shard_place FROM orders")
def split_batches(read):
    tasks = read("orders").select("o_orderkey", F.floor(F.col("o_orderkey") / 40).alias("batch"), (F.col("o_orderkey") % 40 + 1).alias("place"))
    return rounds.split_batch(tasks, "batch", "place").select("o_orderkey", "shard", "shard_place")


@query("""WITH e AS (SELECT o_orderkey // 40 AS batch, o_orderkey % 40 + 1 AS place FROM orders), r AS (SELECT * FROM e WHERE (batch * 7 + place) % 91 <> 0 UNION ALL SELECT * FROM e WHERE (batch * 3 + place) % 97 = 0), h AS (SELECT batch, place, count(*) AS k FROM r GROUP BY 1, 2)
SELECT batch, count(*) FILTER (k IS NULL) AS n_missing, count(*) FILTER (k > 1) AS n_twice, bool_and(coalesce(k = 1, false)) AS mergeable FROM e LEFT JOIN h USING (batch, place) GROUP BY 1""")
def merged_shards(read):
    expected = read("orders").select(F.floor(F.col("o_orderkey") / 40).cast("long").alias("batch"), (F.col("o_orderkey") % 40 + 1).alias("place"))
    rows = expected.where("(batch * 7 + place) % 91 <> 0").unionByName(expected.where("(batch * 3 + place) % 97 = 0"))
    return rounds.merged_shards(rows, expected, "batch", "place")


@query("SELECT CASE WHEN o_orderpriority LIKE '1%' THEN 'schema_error_quarantined' WHEN o_orderkey % 3 > 0 THEN 'partial_complete_retry_pending' ELSE 'worker_failed_retry_pending' END AS backlog, count(*) AS n_rows FROM orders GROUP BY 1")
def backlogs(read):
    return read("orders").groupBy(rounds.backlog(F.col("o_orderkey") % 3, F.startswith("o_orderpriority", F.lit("1"))).alias("backlog")).agg(F.count(F.lit(1)).alias("n_rows"))


@query("""WITH u AS (SELECT user_id, event_type, event_id % 5 AS updated, value, event_id % 2 AS fresh, event_id FROM events)
SELECT user_id, event_type, updated, value FROM (SELECT user_id, event_type, updated, fresh, arg_max(value, event_id) AS value FROM u GROUP BY 1, 2, 3, 4) QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY updated DESC, fresh DESC) = 1""")
def merged_backlog(read):
    one = read("events").groupBy("user_id", "event_type", (F.col("event_id") % 5).alias("updated"), (F.col("event_id") % 2).alias("fresh")).agg(F.max_by("value", "event_id").alias("value"))
    return rounds.merged_backlog(one.where("fresh = 0").drop("fresh"), one.where("fresh = 1").drop("fresh"), ["user_id", "event_type"], F.col("updated"))


@query("""SELECT 'keyed' AS run, n_nationkey::VARCHAR AS k, CASE WHEN n_nationkey % 2 = 0 THEN 'new' ELSE 'old' END AS v FROM nation UNION ALL SELECT 'blank', CASE WHEN n_nationkey = 0 THEN '' ELSE n_nationkey::VARCHAR END, 'new' FROM nation WHERE n_nationkey % 2 = 0""")
def merged_schedules(read):
    rows = read("nation").select(F.col("n_nationkey").cast("string").alias("k"), F.lit("old").alias("v"))
    new = rows.where("k % 2 = 0").withColumn("v", F.lit("new"))
    blank = new.withColumn("k", F.when(F.col("k") != "0", F.col("k")).otherwise(""))
    return rounds.merged_schedule(rows, new, "k").withColumn("run", F.lit("keyed")).unionByName(rounds.merged_schedule(rows, blank, "k").withColumn("run", F.lit("blank")))


@query("""SELECT 'held' AS run, r_regionkey::VARCHAR AS k, CASE WHEN r_regionkey = 2 THEN 'X' ELSE r_name END AS v, r_regionkey::BIGINT AS place, r_regionkey = 2 AS replaced FROM region
UNION ALL SELECT 'more', r_regionkey::VARCHAR, r_name, r_regionkey::BIGINT, false FROM region UNION ALL SELECT 'more', '9', 'Y', (SELECT max(r_regionkey) + 1 FROM region), false""")
def upserted_rows(read):
    rows = read("region").select(F.col("r_regionkey").cast("string").alias("k"), F.col("r_name").alias("v"), F.col("r_regionkey").cast("long").alias("place"))
    one = lambda run, row: rounds.upserted_one(rows, "place", "k", row).withColumn("run", F.lit(run))
    return one("held", {"k": "2", "v": "X"}).unionByName(one("more", {"k": "9", "v": "Y"}))


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderkey <= 50)")
def refused_writes(read):
    writes = read("lineitem").select("l_orderkey", "l_linenumber")
    return rounds.guarded_prefix(writes, read("orders").where("o_orderkey <= 50").select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey")


COLUMNS = ["CompanyID", "RowID", "CompanyName", "DealStatus", "DealDate", "FoundedYear", "DealSize", "EmployeeCount", "HQCity", "CEOBiography", "ExitRoute", "PrimaryIndustrySector", "Comments", "LastUpdated", "RaisedToDate", "PercentAcquired", "InvestorID"]
_CATEGORIES = ["identity", "identity", "name", "status", "time", "time", "amount", "text", "place", "person", "holding", "industry", "text", "identity", "amount", "amount", "identity"]
_TYPES = ["TEXT", "TEXT", "TEXT", "TEXT", "DATE", "INTEGER", "DECIMAL", "INTEGER", "TEXT", "TEXT", "TEXT", "TEXT", "TEXT", "DATE", "DATE", "DECIMAL", "TEXT"]
_COLUMNS_SQL = "(SELECT r_regionkey AS t, u.i AS place, " + ", ".join(f"([{', '.join(map(_literal, vs))}])[u.i] AS {n}" for n, vs in (("name", COLUMNS), ("category", _CATEGORIES), ("kind", _TYPES))) + f" FROM region, unnest(range(1, {len(COLUMNS) + 1})) AS u(i) WHERE (u.i + r_regionkey) % 4 <> 0)"


def _columns(read):
    names = F.posexplode(F.array(*map(F.lit, COLUMNS))).alias("at", "name")
    rows = read("region").select(F.col("r_regionkey").cast("long").alias("t"), names).withColumn("place", F.col("at") + 1)
    return rows.where("(place + t) % 4 <> 0").drop("at")


@query(f"SELECT t, place::INTEGER AS place, name, category, kind, trim(regexp_replace(regexp_replace(name, '([A-Z]+)([A-Z][a-z])', '\\1 \\2', 'g'), '([a-z0-9])([A-Z])', '\\1 \\2', 'g')) AS words FROM {_COLUMNS_SQL}")
def column_categories(read):
    n = F.col("name")
    return _columns(read).select("t", "place", "name", catalog.category(n).alias("category"), catalog.documented_type(n).alias("kind"), F.array_join(text.identifier_words(n), " ").alias("words"))


@query(f"SELECT t, category, string_agg(name, ',' ORDER BY place) AS columns, list_position(['identity','name','status','time','amount','place','person','holding','industry','text'], category) - 1 AS category_place FROM {_COLUMNS_SQL} GROUP BY 1, 2")
def columns_by_category(read):
    return catalog.columns_by_category(_columns(read), "t", "name", "place")


@query("SELECT n_nationkey, 'A & B <' || n_name || '>' AS plain FROM nation")
def plain_text(read):
    return read("nation").select("n_nationkey", html.plain(F.concat(F.lit("  A&nbsp; &amp;\n B &lt;"), "n_name", F.lit("&gt; "))).alias("plain"))


OBJECTS = {"row": ['{"a": 1, "b": null}', '{"a": 1}', "[1]", "{broken", " ", None, "{}"], "tags": ["a, b", "", " ,c"]}


@query(f"""SELECT k, CASE (k % 7) WHEN 1 THEN 'missing b' WHEN 2 THEN 'not_an_object' WHEN 3 THEN 'not_json' WHEN 4 THEN 'blank' WHEN 5 THEN 'blank' WHEN 6 THEN 'missing a,b' END AS wrong, CASE ((k // 2) % 3) WHEN 0 THEN '["a","b"]' WHEN 1 THEN '[]' ELSE '["c"]' END AS tags FROM {varied_sql("customer", "c_custkey", OBJECTS)}""")
def corrected_rows(read):
    return varied(read("customer"), "c_custkey", OBJECTS).select("k", values.object_without(F.col("row"), ["a", "b"]).alias("wrong"), values.clean_tags(F.split("tags", ",")).alias("tags"))
