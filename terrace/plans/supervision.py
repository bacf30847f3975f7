"""Queries over schedules that are made from the driver's tables, with their SQL; registered beside those of catalogue."""

from __future__ import annotations

from pyspark.sql import functions as F

from terrace.operators import supervise
from terrace.plans.catalogue import query
from terrace.plans.review import _length, varied, varied_sql

RESULTS = {"mapped_entity_name": ['["a"]', "[]", "", '["a","b"]', "x"], "entity_search_required": ["yes", "no", None], "needs_manual_review": ["no", "no", "no", "no", "no", "no", "yes", None, "no", "no", "no"]}


@query("WITH e AS (SELECT DISTINCT o_orderkey AS k FROM orders WHERE o_orderkey % 3 > 0), s AS (SELECT DISTINCT l_orderkey AS k FROM lineitem WHERE l_orderkey % 4 > 0) SELECT count(e.k) AS n_expected, count(s.k) AS n_seen, count(*) FILTER (s.k IS NULL) AS n_missing, count(*) FILTER (e.k IS NULL) AS n_unexpected FROM e FULL JOIN s USING (k)")
def set_comparison(read):
    expected, seen = read("orders").where("o_orderkey % 3 > 0").select(F.col("o_orderkey").alias("k")), read("lineitem").where("l_orderkey % 4 > 0").select(F.col("l_orderkey").alias("k"))
    return supervise.compared(expected, seen, "k")


@query("SELECT l_orderkey, max(greatest(l_linenumber - 1, 0)) AS most_restarts, sum(greatest(l_linenumber - 1, 0))::BIGINT AS all_restarts FROM lineitem GROUP BY 1")
def restart_metrics(read):
    shards = read("lineitem").groupBy("l_orderkey").agg(F.collect_list("l_linenumber").alias("launches"))
    return shards.withColumns(supervise.restarts(F.col("launches"))).drop("launches")


_BEATS = "(SELECT user_id, ts, CASE event_id % 3 WHEN 0 THEN 'state' WHEN 1 THEN 'process' ELSE 'log' END AS source, -(event_id % 3) AS r FROM events UNION ALL SELECT user_id, max(ts), 'report', -3 FROM events GROUP BY 1)"


@query(f"SELECT user_id, max(ts) AS heartbeat_at, arg_max(source, (ts, r)) AS source FROM {_BEATS} GROUP BY 1")
def latest_heartbeat(read):
    events = read("events").select("user_id", "ts", "event_id")
    parts = {n: events.where(f"event_id % 3 = {i}") for i, n in enumerate(("state", "process", "log"))}
    return supervise.latest_heartbeat(parts | {"report": events.groupBy("user_id").agg(F.max("ts").alias("ts"))}, "user_id", "ts")






@query("SELECT l_orderkey, l_linenumber, CASE WHEN o.o_orderkey IS NOT NULL THEN o_orderstatus ELSE l_linestatus END AS l_linestatus, o.o_orderkey IS NULL AS key_missing FROM lineitem LEFT JOIN (SELECT * FROM orders WHERE o_orderkey % 4 > 0) o ON o_orderkey = l_orderkey")
def overlaid_fields(read):
    rows = read("lineitem").select("l_orderkey", "l_linenumber", "l_linestatus")
    source = read("orders").where("o_orderkey % 4 > 0").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_orderstatus").alias("l_linestatus"))
    return supervise.overlay_fields(rows, source, "l_orderkey", ["l_linestatus"])


@query("SELECT c_custkey % 3 AS run, c_custkey % 5 IN (0, 1) AS in_scope, count(*) AS n_rows FROM customer GROUP BY 1, 2")
def scoped_backlog(read):
    rows = read("customer").select("c_custkey", F.concat(F.lit("/out/"), (F.col("c_custkey") % 3).cast("string"), F.lit("/batch_"), (F.col("c_custkey") % 5).cast("string")).alias("path"))
    scope = rows.sparkSession.createDataFrame([("/in/batch_0",), ("batch_1",)], "path string")
    return supervise.in_scope(rows, scope, "path").groupBy((F.col("c_custkey") % 3).alias("run"), "in_scope").agg(F.count(F.lit(1)).alias("n_rows"))


@query("""SELECT path, max(k) AS k FROM (SELECT s_suppkey AS k, unnest(['/r/' || s_suppkey, '/c/' || s_suppkey % 7, CASE WHEN s_suppkey % 2 = 0 THEN '/v/' || s_suppkey ELSE ' ' END]) AS path FROM supplier) WHERE trim(path) <> '' GROUP BY 1""")
def source_map(read):
    k = F.col("s_suppkey")
    rows = read("supplier").select(k.alias("k"), F.concat(F.lit("/r/"), k.cast("string")).alias("a"), F.concat(F.lit("/c/"), (k % 7).cast("string")).alias("b"), F.when(k % 2 == 0, F.concat(F.lit("/v/"), k.cast("string"))).otherwise(" ").alias("c"))
    return supervise.source_map(rows, "k", ["a", "b", "c"])


@query("SELECT user_id, arg_max(event_id, (event_type = 'purchase', ts, event_id)) AS event_id FROM events GROUP BY 1")
def newest_records(read):
    return supervise.newest(read("events"), ["user_id"], ["event_id"], F.col("event_type") == "purchase", F.col("ts"), F.col("event_id"))


@query("""SELECT 'missing' AS class, 'order ' || o_orderkey || ' has no lines' AS message FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) UNION ALL SELECT 'price', 'line ' || l_orderkey || '.' || l_linenumber FROM lineitem WHERE l_extendedprice > 90000
UNION ALL SELECT 'warning', 'customer ' || c_custkey FROM customer WHERE c_acctbal < -900""")
def audit_report(read):
    lines = read("lineitem")
    bare = read("orders").select(F.col("o_orderkey").alias("l_orderkey")).join(lines.select("l_orderkey"), "l_orderkey", "left_anti")
    return supervise.audit({
        "missing": (bare, F.concat(F.lit("order "), F.col("l_orderkey").cast("string"), F.lit(" has no lines"))),
        "price": (lines, F.when(F.col("l_extendedprice") > 90000, F.concat(F.lit("line "), F.col("l_orderkey").cast("string"), F.lit("."), F.col("l_linenumber").cast("string")))),
        "warning": (read("customer"), F.when(F.col("c_acctbal") < -900, F.concat(F.lit("customer "), F.col("c_custkey").cast("string")))),
    })


@query("SELECT c_custkey // 25 AS batch, min(c_custkey) AS first_place, arg_min(c_name, c_custkey) AS first_name, max(c_custkey) AS last_place, arg_max(c_name, c_custkey) AS last_name FROM customer GROUP BY 1")
def task_windows(read):
    return supervise.task_window(read("customer").withColumn("batch", F.floor(F.col("c_custkey") / 25).cast("long")), "batch", "c_custkey", "c_name")


@query("SELECT c_custkey // 25 AS batch, c_custkey AS k FROM customer WHERE (c_custkey // 25) % 2 = 0 UNION ALL SELECT b, unnest(range(b * 25, b * 25 + 10)) FROM (SELECT DISTINCT c_custkey // 25 AS b FROM customer) WHERE b % 2 = 1")
def expected_keys(read):
    tasks = read("customer").select(F.floor(F.col("c_custkey") / 25).cast("long").alias("batch"), F.col("c_custkey").alias("k"))
    ranges = tasks.select("batch").distinct().select("batch", (F.col("batch") * 25).alias("first"), (F.col("batch") * 25 + 9).alias("last"))
    return supervise.expected_keys(ranges, tasks.where("batch % 2 = 0"), "batch", "k")

@query(f"""WITH r AS (SELECT k // 8 AS batch, 6 + (k // 8) % 4 AS task_count, * FROM {varied_sql("orders", "o_orderkey", RESULTS)} WHERE k % 8 < 7),
c AS (SELECT batch, count(*) AS rows_written, count(*) FILTER ({_length("mapped_entity_name")} > 0) AS rows_with_entity, count(*) FILTER ({_length("mapped_entity_name")} <= 0) AS rows_without_entity,
 count(*) FILTER (trim(entity_search_required) = 'yes' AND {_length("mapped_entity_name")} <= 0) AS searched_no_entity_rows, count(*) FILTER (coalesce(trim(entity_search_required), '') <> 'yes' AND {_length("mapped_entity_name")} <= 0) AS skip_candidate_rows,
 count(*) FILTER (trim(needs_manual_review) = 'yes') AS manual_review_rows, max(task_count) AS task_count FROM r GROUP BY 1)
SELECT *, rows_written = task_count AS search_complete, CASE WHEN rows_written < task_count THEN 'interrupted_incomplete' WHEN rows_with_entity > 0 THEN 'completed_with_entities_found'
 WHEN searched_no_entity_rows = task_count THEN 'all_tokens_searched_no_entity' ELSE 'all_rows_resolved_zero_entity_mixed_skip_and_search' END AS completion_reason FROM c""")
def result_summary(read):
    batch = F.floor(F.col("k") / 8).cast("long")
    rows = varied(read("orders"), "o_orderkey", RESULTS).where("k % 8 < 7").withColumns({"batch": batch, "task_count": 6 + batch % 4})
    return supervise.result_summary(rows, "batch", "task_count")


SCHEDULE = {
    "status": ["completed", "running", "retry_capped", "deferred_long_tail", "needs_rerun", "schema_error_quarantined", "prepared", " ", "collect_blocked"], "completion_mode": ["", "retry_capped", None, "deferred_long_tail", "worker_failed_retry_pending", "fresh"],
    "last_seen_classifier_rows": [0, 4, None, 9], "best_valid_classifier_rows": [2, None, 7, 0], "last_seen_result_rows": [0, 0, 5, None], "best_valid_result_rows": [None, 0, 3], "respawn_count": [0, 0, None, 0, 2], "startup_failure_count": [0, None, 0, 0, 0, 1],
    "stall_failure_count": [0, 0, 0, 0, 0, 0, 3], "failure_counts_json": ["", None, "{}", '{"stall":0}', '{"stall":2}', "broken"],
}
_ROWS = varied_sql("orders", "o_orderkey", SCHEDULE)
_FAILED_SQL = "('partial_complete_retry_pending','worker_failed_retry_pending','schema_error_quarantined','collect_blocked')"
_STATUS_SQL = f"""CASE WHEN status IN {_FAILED_SQL} THEN status WHEN completion_mode IN {_FAILED_SQL} THEN completion_mode WHEN status = 'retry_capped' OR (status NOT IN ('completed','deferred_long_tail') AND coalesce(completion_mode, '') = 'retry_capped') THEN 'retry_capped'
 WHEN status = 'deferred_long_tail' OR (status <> 'completed' AND coalesce(completion_mode, '') = 'deferred_long_tail') THEN 'deferred_long_tail' WHEN trim(status) = '' THEN 'unknown' ELSE status END"""
_RESOLVED_SQL = "s IN ('completed','deferred_long_tail','retry_capped','partial_complete_retry_pending','worker_failed_retry_pending','schema_error_quarantined','collect_blocked')"


def _schedule(read):
    return varied(read("orders"), "o_orderkey", SCHEDULE)


@query(f"SELECT k, {_STATUS_SQL} AS effective_status FROM {_ROWS}")
def effective_statuses(read):
    return _schedule(read).select("k", supervise.effective_status(F.col("status"), F.col("completion_mode")).alias("effective_status"))


@query(f"""WITH x AS (SELECT *, {_STATUS_SQL} AS s, greatest(coalesce(last_seen_classifier_rows, 0), coalesce(best_valid_classifier_rows, 0)) AS c, greatest(coalesce(last_seen_result_rows, 0), coalesce(best_valid_result_rows, 0)) AS r FROM {_ROWS})
SELECT count(*) AS total_batches, count(*) FILTER ({_RESOLVED_SQL}) AS resolved_batches, count(*) FILTER (NOT {_RESOLVED_SQL}) AS open_batches, count(*) FILTER (c > 0) AS batches_with_classifier_rows, count(*) FILTER (r > 0) AS batches_with_result_rows,
 count(*) FILTER (coalesce(respawn_count, 0) > 0 OR coalesce(startup_failure_count, 0) > 0 OR stall_failure_count > 0 OR coalesce(failure_counts_json, '') LIKE '%2%' OR s IN ('retry_capped','deferred_long_tail')) AS batches_with_failures,
 sum(c)::BIGINT AS total_classifier_rows, sum(r)::BIGINT AS total_result_rows FROM x""")
def progress_overview(read):
    return supervise.overview(_schedule(read))


@query(f"""WITH s AS (SELECT *, CASE WHEN k < 120 THEN 0 ELSE k // 50 END AS round_index, CASE WHEN k < 120 THEN 'completed' ELSE status END AS st FROM {_ROWS}), o AS (SELECT min(round_index) AS r FROM s WHERE st NOT IN ('completed','deferred_long_tail','retry_capped','schema_error_quarantined','collect_blocked'))
SELECT round_index, k, st AS status, greatest(coalesce(last_seen_classifier_rows, 0), coalesce(best_valid_classifier_rows, 0))::BIGINT AS classifier_rows, greatest(coalesce(last_seen_result_rows, 0), coalesce(best_valid_result_rows, 0))::BIGINT AS result_rows FROM s, o WHERE round_index = r""")
def current_round(read):
    early = F.col("k") < 120
    rows = _schedule(read).withColumns({"round_index": F.when(early, 0).otherwise(F.floor(F.col("k") / 50)).cast("long"), "status": F.when(early, "completed").otherwise(F.col("status"))})
    return supervise.current_round(rows, "round_index", ["k", "status"])
