"""Queries that load, align, check and keep outputs, over rows that are made from the driver's tables, with their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from terrace.functions import html
from terrace.operators import attempts, catalog, intervals, keyed, logs, verify
from terrace.plans.catalogue import query
from terrace.plans.review import _in, varied, varied_sql
from terrace.sources import records
from terrace.sources.shared import scratch
from terrace.sources.versions import VersionedTable

# Ragged files: customers as CSV lines of five kinds by key.

HEADER = ["id", "name", "has_entity_evidence", "u", "v", "w", "x"]


def _files(read) -> str:
    """A folder of CSV files, each with its header: plain rows, rows with surplus commas, short, quoted and overlong ones."""
    rows, k = read("customer"), F.col("c_custkey")
    cells = lambda *parts: F.concat_ws(",", *parts)
    own, tail = [k.cast("string"), F.col("c_name")], [F.col("c_mktsegment"), k.cast("string"), F.lit("w"), F.lit("x")]
    quoted = F.concat(F.lit('"said ""hi"", then\nleft '), k.cast("string"), F.lit('"'))
    line = (
        F.when(k % 5 == 1, cells(*own, F.lit("one"), F.lit(" two"), *tail)).when(k % 5 == 2, cells(*own)).when(k % 5 == 3, cells(*own, quoted, *tail)).when(k % 5 == 4, cells(*own, F.lit("t"), *tail, F.lit('"a""b"'), F.lit("é")))
        .otherwise(cells(*own, F.lit("t"), *tail))
    )
    # Each task writes one file, whose first line is the header.
    first = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)) == 0
    path = scratch(rows.sparkSession, "ragged")
    rows.repartition(4, "c_custkey").select(F.when(first, F.concat(F.lit(",".join(HEADER) + "\n"), line)).otherwise(line).alias("value")).write.text(path)
    return path


def _raw(read) -> DataFrame:
    rows = read("customer")
    return records.records(rows.sparkSession, _files(read), "*.txt")


_RAGGED = "c_custkey::VARCHAR AS id, c_name AS name, CASE c_custkey % 5 WHEN 2 THEN '' WHEN 3 THEN 'said \"hi\", then' || chr(10) || 'left ' || c_custkey WHEN 1 THEN {one} WHEN 4 THEN {four} ELSE 't' END AS has_entity_evidence"


@query("SELECT " + _RAGGED.format(one="'one'", four="'t'") + """, CASE c_custkey % 5 WHEN 1 THEN ' two' WHEN 2 THEN '' ELSE c_mktsegment END AS u, CASE c_custkey % 5 WHEN 1 THEN c_mktsegment WHEN 2 THEN '' ELSE c_custkey::VARCHAR END AS v,
CASE c_custkey % 5 WHEN 1 THEN c_custkey::VARCHAR WHEN 2 THEN '' ELSE 'w' END AS w, CASE c_custkey % 5 WHEN 1 THEN 'w' WHEN 2 THEN '' ELSE 'x' END AS x, CASE c_custkey % 5 WHEN 1 THEN '["x"]' WHEN 4 THEN '["a\\"b", "é"]' END AS _extra_columns FROM customer""")
def ragged_kept(read):
    return records.kept(_raw(read), HEADER).drop("file", "record")


@query("SELECT " + _RAGGED.format(one="'one, two'", four="'t,' || c_mktsegment || ',' || c_custkey") + """, CASE c_custkey % 5 WHEN 2 THEN '' WHEN 4 THEN 'w' ELSE c_mktsegment END AS u, CASE c_custkey % 5 WHEN 2 THEN '' WHEN 4 THEN 'x' ELSE c_custkey::VARCHAR END AS v,
CASE c_custkey % 5 WHEN 2 THEN '' WHEN 4 THEN 'a"b' ELSE 'w' END AS w, CASE c_custkey % 5 WHEN 2 THEN '' WHEN 4 THEN 'é' ELSE 'x' END AS x FROM customer""")
def ragged_rejoined(read):
    return records.rejoined(_raw(read), HEADER, "has_entity_evidence").drop("file", "record")


@query("SELECT count(*) AS n_rows, count(*) AS n_numbers, 4::BIGINT AS n_files, true AS gapless FROM customer")
def record_numbers(read):
    """Numbers of records within their files, which have no gaps and begin behind the header."""
    by_file = records.kept(_raw(read), ["id"]).groupBy("file").agg(F.count(F.lit(1)).alias("n"), F.countDistinct("record").alias("d"), ((F.min("record") == 2) & (F.max("record") == F.count(F.lit(1)) + 1)).alias("gapless"))
    return by_file.agg(F.sum("n").alias("n_rows"), F.sum("d").alias("n_numbers"), F.count(F.lit(1)).alias("n_files"), F.every("gapless").alias("gapless"))


# Ranges of any width: events by number against ranges that orders make, some open, some empty, many overlapping.

_RANGES_SQL = """(SELECT o_orderkey AS range_id, CASE WHEN o_orderkey % 97 = 5 THEN NULL ELSE (o_orderkey * 13) % 20000 - 50 END AS first_id, CASE WHEN o_orderkey % 89 = 3 THEN NULL ELSE (o_orderkey * 13) % 20000 - 50 + CASE o_orderkey % 4 WHEN 0 THEN -1 WHEN 1 THEN 0 WHEN 2 THEN o_orderkey % 61 ELSE o_orderkey % 7 END END AS last_id
FROM orders WHERE o_orderstatus = 'P')"""


def _ranges(read):
    k = F.col("o_orderkey")
    first = k * 13 % 20000 - 50
    width = F.when(k % 4 == 0, -1).when(k % 4 == 1, 0).when(k % 4 == 2, k % 61).otherwise(k % 7)
    return read("orders").where("o_orderstatus = 'P'").select(k.alias("range_id"), F.when(k % 97 != 5, first).alias("first_id"), F.when(k % 89 != 3, first + width).alias("last_id"))


@query(f"SELECT e.user_id, r.range_id, count(*) AS n_events FROM events e JOIN {_RANGES_SQL} r ON e.event_id >= coalesce(first_id, -1000000) AND e.event_id <= coalesce(last_id, 100000000) AND coalesce(first_id, -1000000) <= coalesce(last_id, 100000000) WHERE e.event_type = 'error' GROUP BY 1, 2")
def range_pairs(read):
    points = read("events").where("event_type = 'error'").select("event_id", "user_id")
    return intervals.counted(points, _ranges(read), "event_id", "first_id", "last_id", "user_id", "range_id").withColumnRenamed("n", "n_events")


@query(f"SELECT event_id, (SELECT max(range_id) FROM {_RANGES_SQL} r WHERE event_id >= coalesce(first_id, -1000000) AND event_id <= coalesce(last_id, 100000000) AND coalesce(first_id, -1000000) <= coalesce(last_id, 100000000) AND last_id IS NOT NULL AND first_id IS NOT NULL) AS batch FROM events")
def range_owner(read):
    """The batch of each event, of overlapping ranges the last one, by closed ranges only."""
    ranges = _ranges(read).where("first_id IS NOT NULL AND last_id IS NOT NULL").withColumn("batch", F.col("range_id"))
    return intervals.assigned(read("events").select("event_id"), ranges, "event_id", "first_id", "last_id", "batch", "range_id")


# Reports of verifiers: one for each priority; some tasks without a row, some with two, rows of others' tasks.

REPORT = {
    "verdict": ["pass", "wrong_company_mapping", "fine", "insufficient_evidence", None], "recommended_action": ["accept_worker_row", "edit_row", "rerun_batch", "mark_manual_review", "none"], "classifier_search_tier": ["full", " light ", "deep", "skip_candidate"],
    "verifier_search_tier": ["full", "", "light"], "error_reason": ["", "why", None], "verifier_mapped_entity_name": ["", "a|b", '["a","b"]'],
    "corrected_result_row_json": ["", '{"task_index": "7", "mapped_entity_name": "[\\"a\\", \\"b\\"]"}', '{"task_index": "7"}', "[1]", "{broken", '{"task_index": "7", "mapped_entity_name": null}'],
}
CLASSIFIED = {"search_tier": ["full", "light", None]}
_VERDICTS, _ACTIONS, _TIERS = _in(verify.VERDICTS), _in(verify.ACTIONS), "('full','light','skip_candidate')"
_JSON = "trim(coalesce(corrected_result_row_json, ''))"
_WRONG = f"CASE WHEN {_JSON} = '' THEN 'blank' WHEN {_JSON} = '{{broken' THEN 'not_json' WHEN {_JSON} = '[1]' THEN 'not_an_object' WHEN {_JSON} NOT LIKE '%mapped_entity_name%' THEN 'lacks' ELSE 'fine' END"
_REPORT_RULES = {
    "verdict_invalid": f"coalesce(verdict, '') NOT IN {_VERDICTS}", "action_invalid": f"recommended_action NOT IN {_ACTIONS}", "classifier_tier_invalid": f"trim(classifier_search_tier) NOT IN {_TIERS}",
    "classifier_tier_differs": "tier IS NOT NULL AND trim(classifier_search_tier) <> tier", "verifier_tier_invalid": f"verifier_search_tier NOT IN {_TIERS}", "pass_not_accepted": "verdict = 'pass' AND recommended_action <> 'accept_worker_row'",
    "reason_blank": "coalesce(verdict, '') <> 'pass' AND coalesce(error_reason, '') = ''", "correction_blank": f"recommended_action = 'edit_row' AND {_WRONG} = 'blank'", "correction_not_json": f"recommended_action = 'edit_row' AND {_WRONG} = 'not_json'",
    "correction_not_an_object": f"recommended_action = 'edit_row' AND {_WRONG} = 'not_an_object'", "correction_lacks_columns": f"recommended_action = 'edit_row' AND {_WRONG} = 'lacks'",
    "correction_maps_otherwise": f"recommended_action = 'edit_row' AND {_WRONG} = 'fine' AND verifier_mapped_entity_name <> '' AND {_JSON} LIKE '%null%'", "blocks_merge": f"recommended_action IN ('edit_row','rerun_company','rerun_batch','update_prompt_or_process') AND NOT (recommended_action = 'edit_row' AND {_JSON} <> '')",
}
_EXPECTED_SQL = "(SELECT o_orderkey AS task_index, 'r' || (o_orderkey // 100) AS report FROM orders)"
_REPORT_SQL = f"(SELECT CASE WHEN k % 51 = 7 THEN 'r-none' ELSE 'r' || (k // 100) END AS report, k AS task_index, * EXCLUDE (k) FROM {varied_sql('orders', 'o_orderkey', REPORT)} WHERE k % 37 <> 5 UNION ALL SELECT 'r' || (k // 100), k, * EXCLUDE (k) FROM {varied_sql('orders', 'o_orderkey', REPORT)} WHERE k % 211 = 9)"


def _reports(read):
    k = F.col("k")
    rows = varied(read("orders"), "o_orderkey", REPORT)
    report = F.concat(F.lit("r"), F.floor(k / 100).cast("string"))
    once = rows.where("k % 37 <> 5").withColumn("report", F.when(k % 51 == 7, "r-none").otherwise(report))
    reports = once.unionByName(rows.where("k % 211 = 9").withColumn("report", report)).withColumn("task_index", F.concat(F.lit(" "), k.cast("string"))).drop("k")
    expected = read("orders").select(F.col("o_orderkey").alias("task_index"), F.concat(F.lit("r"), F.floor(F.col("o_orderkey") / 100).cast("string")).alias("report"))
    classifier = varied(read("orders"), "o_orderkey", CLASSIFIED).where("k % 5 > 0").withColumnRenamed("k", "task_index")
    return reports, expected, classifier


@query(f"""WITH x AS (SELECT r.*, CASE WHEN c.k IS NOT NULL THEN coalesce(c.search_tier, '') END AS tier FROM {_REPORT_SQL} r JOIN {_EXPECTED_SQL} e USING (report, task_index) LEFT JOIN (SELECT * FROM {varied_sql('orders', 'o_orderkey', CLASSIFIED)} WHERE k % 5 > 0) c ON c.k = r.task_index),
n AS (SELECT e.report, e.task_index, count(r.task_index) AS n FROM {_EXPECTED_SQL} e LEFT JOIN {_REPORT_SQL} r USING (report, task_index) GROUP BY 1, 2)
SELECT report, task_index, code, NULL AS detail FROM (SELECT report, task_index, unnest([{', '.join(f"CASE WHEN {r} THEN '{c}' END" for c, r in _REPORT_RULES.items())}]) AS code FROM x) WHERE code IS NOT NULL
UNION ALL SELECT report, NULL, 'rows_differ', 'expected ' || count(*) || ', found ' || sum(n) FROM n GROUP BY 1 HAVING count(*) <> sum(n)
UNION ALL SELECT report, NULL, 'rows_missing', array_to_string(list(task_index ORDER BY task_index)[:20], ',') FROM n WHERE n = 0 GROUP BY 1""")
def verifier_errors(read):
    return verify.report_errors(*_reports(read), ["task_index", "mapped_entity_name"])


@query(f"""SELECT e.task_index::VARCHAR AS task_index, CASE WHEN {_JSON} LIKE '%null%' THEN '' ELSE '["a", "b"]' END AS mapped_entity_name, CASE WHEN c.k IS NOT NULL THEN 'high' ELSE '' END AS entity_link_likelihood
FROM {_REPORT_SQL} r JOIN {_EXPECTED_SQL} e USING (task_index) LEFT JOIN (SELECT k FROM {varied_sql('orders', 'o_orderkey', CLASSIFIED)} WHERE k % 5 > 0) c ON c.k = r.task_index WHERE recommended_action = 'edit_row' AND {_WRONG} = 'fine'""")
def corrected_results(read):
    reports, expected, classifier = _reports(read)
    tasks = expected.select("task_index", *(F.lit("").alias(c) for c in verify.FROM_TASK if c != "task_index"))
    levels = classifier.select("task_index", *(F.lit("high").alias(c) for c in verify.FROM_CLASSIFIER))
    whole = reports.withColumn("corrected_result_row_json", F.regexp_replace("corrected_result_row_json", r"\}$", ', "entity_link_likelihood": "low"}'))
    return verify.corrected(whole, tasks, levels, ["task_index", "mapped_entity_name", "entity_link_likelihood"])


# Three files of each attempt, place by place: orders are batches, their lines tasks.

_PLACED_SQL = """(SELECT l_orderkey AS batch, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey) AS place, l_partkey AS task_index, 't' || l_partkey AS token_name, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem)"""
_CLASSIFIED_SQL = f"(SELECT batch, place, CASE WHEN batch % 7 = 1 AND place = 3 THEN -1 ELSE task_index END AS key FROM {_PLACED_SQL} WHERE batch % 5 > 0 AND (batch % 5 > 1 OR place < n))"
_RESULTS_SQL = f"(SELECT batch, place, CASE WHEN batch % 11 = 2 AND place = 2 THEN -2 ELSE task_index END AS key FROM {_PLACED_SQL} WHERE batch % 5 > 0 AND (batch % 5 <> 3 OR place < n - 1) UNION ALL SELECT DISTINCT batch, n + 1, 0 FROM {_PLACED_SQL} WHERE batch % 13 = 4 AND batch % 5 = 2)"


def _outputs(read):
    place = F.row_number().over(Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey")).cast("long")
    sizes = read("lineitem").groupBy("l_orderkey").agg(F.count(F.lit(1)).alias("n"))
    tasks = read("lineitem").join(sizes, "l_orderkey").select(F.col("l_orderkey").alias("batch"), place.alias("place"), F.col("l_partkey").alias("task_index"), F.concat(F.lit("t"), F.col("l_partkey").cast("string")).alias("token_name"), "n")
    b, p, k = F.col("batch"), F.col("place"), F.col("task_index")
    classifier = tasks.where((b % 5 > 0) & ((b % 5 > 1) | (p < F.col("n")))).withColumn("task_index", F.when((b % 7 == 1) & (p == 3), -1).otherwise(k))
    results = tasks.where((b % 5 > 0) & ((b % 5 != 3) | (p < F.col("n") - 1))).withColumn("task_index", F.when((b % 11 == 2) & (p == 2), -2).otherwise(k))
    more = sizes.select(F.col("l_orderkey").alias("batch"), (F.col("n") + 1).alias("place"), F.lit(0).cast("long").alias("task_index"), F.lit("t0").alias("token_name"), "n").where("batch % 13 = 4 AND batch % 5 = 2")
    attempts_ = sizes.select(F.col("l_orderkey").alias("batch"), F.col("n").alias("expected"), (F.col("l_orderkey") % 17 != 6).alias("classifier_header_ok"), F.lit(True).alias("results_header_ok"))
    return attempts_, tasks, classifier, results.unionByName(more)


@query(f"""WITH t AS {_PLACED_SQL}, c AS {_CLASSIFIED_SQL}, r AS {_RESULTS_SQL}, x AS (SELECT t.batch, t.place, t.task_index <> c.key OR t.task_index <> r.key AS wrong FROM t JOIN c USING (batch, place) JOIN r USING (batch, place)),
g AS (SELECT batch, count(*) AS compared, min(place) FILTER (wrong) AS w FROM x GROUP BY 1), a AS (SELECT DISTINCT batch, n AS expected, batch % 17 <> 6 AS h FROM t),
s AS (SELECT a.*, (SELECT count(*) FROM c WHERE c.batch = a.batch) AS cr, (SELECT count(*) FROM r WHERE r.batch = a.batch) AS rr, coalesce(compared, 0) AS m, w FROM a LEFT JOIN g USING (batch)),
y AS (SELECT *, h AND w IS NULL AND m = greatest(cr, rr) AS whole, coalesce(w - 1, m) AS prefix_len FROM s)
SELECT batch, expected, cr AS classifier_rows, rr AS result_rows, prefix_len, CASE WHEN whole AND cr = expected AND rr = expected THEN 'completed' WHEN cr = 0 AND rr = 0 AND h THEN 'header_only' WHEN whole AND prefix_len > 0 THEN 'partial_prefix' ELSE 'partial_misaligned' END AS state FROM y""")
def attempt_states(read):
    return attempts.inspected(*_outputs(read), ["batch"])


@query(f"SELECT t.batch, t.place + 1 AS record, t.task_index::VARCHAR AS expected_key, t.token_name AS expected_name, r.key::VARCHAR AS found_key, CASE WHEN r.key = 0 THEN 't0' ELSE t.token_name END AS found_name FROM {_PLACED_SQL} t JOIN {_RESULTS_SQL} r USING (batch, place) WHERE t.task_index <> r.key")
def order_errors(read):
    _, tasks, _, results = _outputs(read)
    return attempts.order_errors(tasks, results, ["batch"])


CANDIDATES = {
    "state": ["completed", "partial_prefix", "header_only", "partial_misaligned"], "source": ["attempt", "split_merged", "attempt"], "prefix_len": [0, 4, 9, None], "classifier_rows": [5, 0, 9, None], "result_rows": [4, 9, 0, 9], "last_activity": [1.5, 2.5, None],
    "meta_lease_id": ["l1", None, "l2"], "meta_attempt_start_prefix_rows": [None, 3, None, 0],
}
_CANDIDATE_SQL = f"(SELECT k // 4 AS batch, k AS attempt_index, '/a/' || k AS path, * EXCLUDE (k) FROM {varied_sql('orders', 'o_orderkey', CANDIDATES)})"


@query(f"""WITH c AS (SELECT * FROM {_CANDIDATE_SQL} WHERE batch % 6 > 0), t AS (SELECT * FROM c QUALIFY row_number() OVER (PARTITION BY batch ORDER BY (CASE state WHEN 'completed' THEN 4 WHEN 'partial_prefix' THEN 3 WHEN 'header_only' THEN 1 ELSE 0 END, (source = 'split_merged')::INTEGER, coalesce(prefix_len, 0),
 least(coalesce(classifier_rows, 0), coalesce(result_rows, 0)), coalesce(last_activity, 0), attempt_index) DESC) = 1)
SELECT b AS batch, coalesce(path, 'none') AS active_attempt, CASE WHEN t.batch IS NULL THEN 1 ELSE classifier_rows END AS last_seen_classifier_rows, coalesce(meta_lease_id, 'l0') AS lease_id, coalesce(meta_attempt_start_prefix_rows, 8) AS attempt_start_prefix_rows FROM (SELECT DISTINCT o_orderkey // 4 AS b FROM orders) LEFT JOIN t ON t.batch = b""")
def reconciled_attempts(read):
    k = F.col("k")
    rows = varied(read("orders"), "o_orderkey", CANDIDATES)
    found = rows.withColumns({"batch": F.floor(k / 4).cast("long"), "attempt_index": k, "path": F.concat(F.lit("/a/"), k.cast("string"))}).drop("k")
    schedule = found.select("batch").distinct().select("batch", F.lit("none").alias("active_attempt"), F.lit(1).alias("last_seen_classifier_rows"), F.lit("l0").alias("lease_id"), F.lit(8).alias("attempt_start_prefix_rows"))
    return attempts.reconciled(schedule, found.where("batch % 6 > 0"), "batch", {"active_attempt": "path", "last_seen_classifier_rows": "classifier_rows"}, ["lease_id", "attempt_start_prefix_rows"])


STATES = {"primary": ["completed", "partial", "missing", "header_mismatch"], "best_valid": ["missing", "completed", "partial", "header_only", "completed"]}


@query(f"SELECT k, CASE WHEN p = 'completed' THEN 'primary' WHEN b = 'completed' THEN 'best_valid' WHEN p <> 'missing' THEN 'primary' WHEN b <> 'missing' THEN 'best_valid' END AS kind, CASE WHEN p = 'completed' THEN p WHEN b = 'completed' THEN b WHEN p <> 'missing' THEN p WHEN b <> 'missing' THEN b END AS state FROM (SELECT k, \"primary\" AS p, best_valid AS b FROM {varied_sql('customer', 'c_custkey', STATES).replace(' AS primary', ' AS \"primary\"')})")
def preferred_outputs(read):
    rows = varied(read("customer"), "c_custkey", STATES)
    outputs = rows.select("k", F.explode(F.array(*(F.struct(F.lit(c).alias("kind"), F.col(c).alias("state")) for c in STATES))).alias("x")).select("k", "x.*")
    return attempts.preferred(outputs, "k", list(STATES))


@query(f"SELECT batch, place, key::VARCHAR AS task_index, '' AS note FROM {_RESULTS_SQL} WHERE batch % 17 <> 6 AND place <= batch % 4")
def copied_prefixes(read):
    _, _, _, results = _outputs(read)
    return attempts.prefix_copied(results, "place", F.col("batch") % 4, F.col("batch") % 17 != 6, ["batch", "place", "task_index", "note"]).withColumns({"batch": F.col("batch").cast("long"), "place": F.col("place").cast("long")})


@query("""WITH e AS (SELECT *, event_id % 3 AS b FROM events WHERE event_type <> 'view'), l AS (SELECT user_id, max(b) AS b FROM e GROUP BY 1), n AS (SELECT user_id, b, arg_max(event_id, event_id) AS event_id FROM e GROUP BY 1, 2)
SELECT user_id, event_id, 'b' || b AS note FROM n JOIN l USING (user_id, b) WHERE user_id NOT IN (SELECT user_id FROM events WHERE event_id % 101 = 0)""")
def keyed_upserts(read):
    """Three batches into a versioned table, one of them twice, and a delete; each batch replaces users of those before."""
    events, path = read("events"), scratch(read("events").sparkSession, "keyed")
    table = VersionedTable(events.sparkSession, path, ["user_id"])
    put = table.sink("events", "event_id")
    rows = events.where("event_type <> 'view'").select("user_id", "event_id", F.concat(F.lit("b"), (F.col("event_id") % 3).cast("string")).alias("note"))
    for b in (0, 1, 0, 2):
        put(rows.where(F.col("event_id") % 3 == b), b)
    table.delete(events.where("event_id % 101 = 0").select("user_id"))
    return table.read()


# Logs: events as lines, by user.

_TAGS = ["worker:start", "command:end", "command:end", "command:stderr", "other:x", "supervisor:tick", "", "- batch_3"]
_LINE_SQL = f"(SELECT user_id, event_id, ts, ([{', '.join(repr(t) for t in _TAGS)}])[event_id % 8 + 1] AS tag, CASE WHEN event_id % 8 = 7 THEN '  - batch_3 [worker:start] ' || event_id WHEN event_id % 8 = 6 THEN 'Runtime actions: ' || event_id ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') || ' [' || tag || '] returncode=' || event_id % 3 END AS line FROM events)"


def _log_lines(read):
    k = F.col("event_id")
    tag = F.element_at(F.array(*map(F.lit, _TAGS)), (k % 8 + 1).cast("int"))
    told = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS"), F.lit("Z ["), tag, F.lit("] returncode="), (k % 3).cast("string"))
    line = F.when(k % 8 == 7, F.concat(F.lit("  - batch_3 [worker:start] "), k.cast("string"))).when(k % 8 == 6, F.concat(F.lit("Runtime actions: "), k.cast("string"))).otherwise(told)
    return read("events").select("user_id", "event_id", line.alias("line"))


@query(f"""WITH l AS {_LINE_SQL}, c AS (SELECT user_id, unnest(CASE event_id % 8 WHEN 0 THEN ['worker:start'] WHEN 3 THEN ['command:stderr'] WHEN 5 THEN ['supervisor:tick'] WHEN 6 THEN ['runtime_action_summary_line'] WHEN 7 THEN ['worker:start', 'runtime_action_batch_line'] WHEN 4 THEN [] ELSE CASE WHEN event_id % 3 = 0 THEN ['command:end'] ELSE ['command:end', 'command:end_nonzero'] END END) AS k FROM l),
m AS (SELECT user_id, '{{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}}' AS event_counts FROM (SELECT user_id, k, count(*) AS n FROM c GROUP BY 1, 2) GROUP BY 1),
n AS (SELECT user_id, event_id, u.i AS i, line FROM l, unnest(range(CASE event_id % 8 WHEN 7 THEN 2 WHEN 4 THEN 0 WHEN 1 THEN (event_id % 3 > 0)::INTEGER WHEN 2 THEN (event_id % 3 > 0)::INTEGER ELSE 1 END)) AS u(i)),
r AS (SELECT user_id, array_to_string(list(line ORDER BY event_id, i)[-12:], chr(10)) AS recent FROM n GROUP BY 1), t AS (SELECT user_id, max(ts) AS last_event_at, arg_max(line, (ts, -event_id)) AS last_event_line FROM l WHERE event_id % 8 < 6 GROUP BY 1)
SELECT user_id, last_event_at, last_event_line, event_counts, recent FROM m LEFT JOIN t USING (user_id) LEFT JOIN r USING (user_id)""")
def event_log_rollup(read):
    found = logs.event_rollup(_log_lines(read), "user_id", "event_id", "line")
    return found.select("user_id", "last_event_at", "last_event_line", "event_counts", F.array_join("recent_notable_events", "\n").alias("recent"))


_SHAPES = ["{\"type\":\"item.completed\",\"item\":{\"type\":\"web_search\",\"query\":\"q#\"}}", "{\"type\":\"item.completed\",\"item\":{\"type\":\"agent_message\",\"text\":\" said # \"}}", "{\"type\":\"item.started\",\"item\":{\"type\":\"agent_message\",\"text\":\"no\"}}", "{\"type\":\"turn\",\"n\":#}", "[1, 2]", "{broken #", "  ", "{\"item\":{\"type\":\"file_change\"}}", "{\"type\":\"item.completed\",\"item\":\"text\"}"]
_SHAPE_SQL = f"(SELECT user_id, event_id, event_id % 9 AS s FROM events QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) <= 40)"


@query(f"""WITH l AS {_SHAPE_SQL}, c AS (SELECT user_id, unnest(CASE s WHEN 0 THEN ['item.completed', 'web_search:item.completed'] WHEN 1 THEN ['item.completed', 'agent_message:item.completed'] WHEN 2 THEN ['item.started', 'agent_message:item.started'] WHEN 3 THEN ['turn'] WHEN 8 THEN ['item.completed'] ELSE [] END) AS k FROM l),
m AS (SELECT user_id, '{{' || string_agg('"' || k || '":' || n, ',' ORDER BY k) || '}}' AS counts FROM (SELECT user_id, k, count(*) AS n FROM c GROUP BY 1, 2) GROUP BY 1)
SELECT user_id, count(*) FILTER (s IN (0, 1, 2, 3, 7, 8)) AS json_lines, count(*) FILTER (s IN (4, 5)) AS other_lines, 'said ' || max(event_id) FILTER (s = 1) AS last_agent_message, any_value(coalesce(counts, '{{}}')) AS counts,
 coalesce(array_to_string(list('q' || event_id ORDER BY event_id) FILTER (s = 0)[-5:], ','), '') AS queries FROM l LEFT JOIN m USING (user_id) GROUP BY 1 HAVING count(*) FILTER (s <> 6) > 0""")
def worker_log_rollup(read):
    shape = F.element_at(F.array(*map(F.lit, _SHAPES)), (F.col("event_id") % 9 + 1).cast("int"))
    lines = read("events").select("user_id", "event_id", F.replace(shape, F.lit("#"), F.col("event_id").cast("string")).alias("line"))
    found = logs.worker_rollup(lines, "user_id", "event_id", "line", tail=40)
    return found.select("user_id", "json_lines", "other_lines", "last_agent_message", "counts", F.array_join("recent_search_queries", ",").alias("queries"))


# Prefixes, descriptions and notes.

_PREFIX_SQL = "(SELECT prefix, max(p_partkey) AS prefix_id FROM (SELECT p_partkey, substr(p_name, 1, (p_partkey % 9)::INTEGER) AS prefix FROM part WHERE p_partkey % 11 = 3) GROUP BY 1)"


@query(f"SELECT p_partkey, arg_max(prefix, length(prefix)) AS prefix, arg_max(prefix_id, length(prefix)) AS prefix_id FROM part LEFT JOIN {_PREFIX_SQL} ON starts_with(p_name, prefix) GROUP BY 1")
def longest_prefixes(read):
    prefixes = read("part").where("p_partkey % 11 = 3").select("p_partkey", F.substring("p_name", F.lit(1), (F.col("p_partkey") % 9).cast("int")).alias("prefix")).groupBy("prefix").agg(F.max("p_partkey").alias("prefix_id"))
    return catalog.longest_prefix(read("part").select("p_partkey", "p_name"), "p_name", prefixes, "prefix").drop("p_name")


@query("""WITH t AS (SELECT c_custkey, (['Deal', 'DealSellerRelation', 'LPRelation', 'LimitedPartnerLPRelation', 'XRelation', 'DealOddRelation', 'LPTeamRelation'])[c_custkey % 7 + 1] || CASE WHEN c_custkey % 5 = 0 THEN '' ELSE '' END AS t FROM customer)
SELECT c_custkey, t AS table_name, CASE t WHEN 'Deal' THEN 'given' WHEN 'DealSellerRelation' THEN 'sellers of deals' WHEN 'LimitedPartnerLPRelation' THEN 'partners of limited partners' WHEN 'DealOddRelation' THEN 'what deals relate to' WHEN 'LPTeamRelation' THEN 'teams of LPs' END AS description,
CASE c_custkey % 5 WHEN 0 THEN 'joins deals' WHEN 1 THEN 'row' WHEN 2 THEN 'time' WHEN 3 THEN 'some id' ELSE '' END AS note FROM t""")
def table_descriptions(read):
    k, spark = F.col("c_custkey"), read("customer").sparkSession
    names = ["Deal", "DealSellerRelation", "LPRelation", "LimitedPartnerLPRelation", "XRelation", "DealOddRelation", "LPTeamRelation"]
    tables = read("customer").select("c_custkey", F.element_at(F.array(*map(F.lit, names)), (k % 7 + 1).cast("int")).alias("table_name"), F.element_at(F.array(*map(F.lit, ("DealID", "RowID", "LastUpdated", "OddID", "Name"))), (k % 5 + 1).cast("int")).alias("column"))
    given = spark.createDataFrame([("Deal", "given")], "table_name string, description string")
    subjects = spark.createDataFrame([("Deal", "deals"), ("LP", "LPs"), ("Limited", "nobody"), ("LimitedPartner", "limited partners")], "subject string, label string")
    relations = spark.createDataFrame([("Seller", "sellers of {}"), ("LP", "partners of {}"), ("Team", "teams of {}"), ("", "what {} relate to")], "rest string, pattern string")
    found = catalog.described(tables, "table_name", given, subjects, relations)
    return found.withColumn("note", catalog.join_note(F.col("column"), {"DealID": "joins deals"}, "row", "time", "some id")).drop("column")


# Labelled rows of pages: each page with rows of links behind it.

def _labelled(read):
    k = F.col("page_id").cast("string")
    link = lambda href, text: F.concat(F.lit("<a href='"), href, F.lit("'>"), text, F.lit("</a>"))
    row = lambda label, *links: F.concat(F.lit("<div class='x row line'><div class='label b'> "), F.lit(label), F.lit(" </div><div><div>"), *links, F.lit("</div></div></div>"))
    tags = row("Tags &amp; more", link(F.concat(F.lit("/tags/"), k), F.concat(F.lit("t"), k)), link(F.lit("/tags/2"), F.lit("a <b>b</b>\n c")), link(F.lit("/other"), F.lit("no")), link(F.lit("/tags/3"), F.concat(F.lit("t"), k)))
    sites = row("Sites", link(F.lit("https://a.com"), F.lit("Home")), link(F.lit("https://b.com"), F.lit("Home")), link(F.concat(F.lit("/p?a=1&amp;b="), k), F.lit("Page")), link(F.lit("/x"), F.lit(" ")))
    coins = F.concat(F.lit("<p><a class=c href=\"/coins/"), k, F.lit("\"><span>Big &lt;Coin</span> <i>BC"), k, F.lit("</i></a><a href='/coins/9'>lower case</a><a href='/coins/1'>One\nTwo OT</a><a href='/coins/1'>One Two OT</a></p>"))
    return read("pages").select("page_id", F.concat("html", tags, F.lit("<div class='row'>not a row</div>"), sites, coins).alias("html"))


@query("""SELECT page_id, '["t' || page_id || '","a b c"]' AS tags, '{"Home":"https://a.com","Page":"/p?a=1&b=' || page_id || '"}' AS sites, '[]' AS none FROM pages""")
def label_lists(read):
    rows = _labelled(read).select("page_id", html.labelled_rows(F.col("html"), ["row", "line"], "label").alias("r"))
    r = F.col("r")
    return rows.select("page_id", html.label_list(r, "Tags & more", "/tags/").alias("tags"), html.label_map(r, "Sites").alias("sites"), html.label_list(r, "Absent").alias("none"))


@query("SELECT page_id, 'Big <Coin' AS name, 'BC' || page_id AS symbol, '/coins/' || page_id AS href FROM pages UNION ALL SELECT page_id, 'One Two', 'OT', '/coins/1' FROM pages")
def anchor_rows(read):
    return html.anchors(_labelled(read), "page_id", "html", "/coins/").drop("position")


# Rows by keys that are text.

@query("""WITH n AS (SELECT l_orderkey AS k, arg_max(l_partkey, (l_linenumber, l_partkey)) AS v FROM lineitem WHERE l_orderkey % 3 = 0 GROUP BY 1), e AS (SELECT o_orderkey AS k, o_custkey AS v FROM orders WHERE o_orderkey % 2 = 0)
SELECT coalesce(n.k, e.k) AS task_index, coalesce(n.v, e.v)::VARCHAR AS value, n.k IS NOT NULL AND e.k IS NOT NULL AS overwritten FROM n FULL JOIN e ON n.k = e.k""")
def merged_outputs(read):
    new = read("lineitem").where("l_orderkey % 3 = 0").select((F.col("l_linenumber").cast("long") * 1_000_000_000 + F.col("l_partkey")).alias("place"), F.concat(F.lit(" "), F.col("l_orderkey").cast("string")).alias("task_index"), F.col("l_partkey").cast("string").alias("value"))
    old = read("orders").where("o_orderkey % 2 = 0").select(F.lit(0).cast("long").alias("place"), F.col("o_orderkey").cast("string").alias("task_index"), F.col("o_custkey").cast("string").alias("value"))
    merged, overwritten = keyed.merged_by_key(old, new, "task_index", "place", ["task_index", "value"])
    return merged.join(overwritten.withColumn("o", F.lit(True)), "task_index", "left").select("task_index", "value", F.coalesce("o", F.lit(False)).alias("overwritten"))


OUTPUTS = {"status": ["completed", "failed", "completed"], "parsed": ['{"has_token": true, "evidence_urls": ["a", " b ", ""], "ticker": "T#"}', '{"has_token": false, "evidence_urls": "c"}', "[1]", None, "text"]}


@query(f"""WITH r AS (SELECT k % 1000 AS c, k, parsed FROM {varied_sql("orders", "o_orderkey", OUTPUTS)} WHERE status = 'completed' AND parsed LIKE '{{%'), l AS (SELECT c, arg_max(parsed, k) AS p FROM r WHERE c > 5 GROUP BY 1)
SELECT c_custkey, CASE WHEN c IS NULL THEN c_name WHEN p LIKE '%true%' THEN 'T#' ELSE '' END AS ticker, CASE WHEN c IS NULL THEN '' WHEN p LIKE '%true%' THEN 'true' ELSE 'false' END AS has_token, CASE WHEN c IS NULL THEN '' WHEN p LIKE '%true%' THEN 'a|b' ELSE 'c' END AS evidence_urls,
CASE WHEN c IS NULL THEN '' ELSE 'completed' END AS agent_task_status, CASE WHEN c IS NULL THEN '' ELSE 'run' END AS agent_result_source FROM customer LEFT JOIN l ON c = c_custkey""")
def backfilled_rows(read):
    k = F.col("k")
    rows = varied(read("orders"), "o_orderkey", OUTPUTS).withColumn("id", F.when(k % 1000 > 5, (k % 1000).cast("string")).otherwise(" "))
    results = keyed.completed_results(rows, "id", "status", "parsed", "k", ["has_token", "ticker", "evidence_urls"], ["evidence_urls"], "run")
    named = read("customer").select("c_custkey", F.concat(F.col("c_custkey").cast("string"), F.lit(" ")).alias("id"), F.col("c_name").alias("ticker"))
    return keyed.backfilled(named, results, "id").drop("id")


SHARDS = {"token_origin_type": ["invesment_or_holdings", "stablecoin", None], "mapped_entity_name": ["", '["a"]', None, " "], "mapped_entity_legal_name": ["", "x", " "], "mapped_entity_type": ["", "[]"], "mapped_entity_url": [None, "", "u"], "needs_manual_review": ["low", "yes", " high "], "confidence": ["", "medium", None]}
_NONE = "trim(coalesce(mapped_entity_name, '')) = '' AND trim(coalesce(mapped_entity_legal_name, '')) = '' AND trim(coalesce(mapped_entity_url, '')) = ''"
_LEVEL = "trim(needs_manual_review) IN ('low','high') AND coalesce(confidence, '') = ''"


@query(f"""SELECT k, CASE coalesce(token_origin_type, '') WHEN 'invesment_or_holdings' THEN 'investment_or_holdings' ELSE coalesce(token_origin_type, '') END AS token_origin_type, {', '.join(f"CASE WHEN {_NONE} THEN '[]' ELSE coalesce({c}, '') END AS {c}" for c in SHARDS if c.startswith('mapped'))},
CASE WHEN {_LEVEL} THEN 'no' ELSE needs_manual_review END AS needs_manual_review, CASE WHEN {_LEVEL} THEN trim(needs_manual_review) ELSE coalesce(confidence, '') END AS confidence FROM {varied_sql("customer", "c_custkey", SHARDS)}""")
def repaired_shards(read):
    return keyed.repaired_shard_row(varied(read("customer"), "c_custkey", SHARDS), {"invesment_or_holdings": "investment_or_holdings"})


@query("SELECT l_orderkey, l_linenumber, l_partkey, coalesce(o_orderstatus, l_returnflag) AS l_returnflag FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 3 > 0) ON o_orderkey = l_orderkey")
def rewritten_identities(read):
    tasks = read("orders").where("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("l_returnflag"))
    return keyed.identity_rewritten(read("lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_returnflag"), tasks, "l_orderkey", ["l_returnflag"])


@query("SELECT c_custkey, c_custkey % 3 = 0 AS in_list, CASE c_custkey % 4 WHEN 0 THEN 'prepared' WHEN 1 THEN 'prepared' ELSE 'running' END AS status, '0' AS respawn_count, CASE WHEN c_custkey % 5 = 0 THEN 0 ELSE c_custkey % 7 END AS n FROM customer WHERE c_custkey % 11 > 0")
def defaulted_rows(read):
    """A list whose blank slugs are dropped, with columns that a schedule has by default."""
    k = F.col("c_custkey")
    rows = read("customer").select("c_custkey", F.when(k % 11 > 0, F.concat(F.lit(" s"), k.cast("string"))).otherwise("  ").alias("slug"), F.when(k % 4 == 0, "").when(k % 4 > 1, "running").alias("status"), F.when(k % 5 > 0, (k % 7).cast("string")).otherwise("none").alias("n"))
    kept = keyed.with_defaults(keyed.listed(rows, "c_custkey", ["slug", "status", "n"], "slug"), {"status": "prepared", "respawn_count": "0"}, ["n"])
    return kept.select("c_custkey", (k % 3 == 0).alias("in_list"), "status", "respawn_count", "n")
