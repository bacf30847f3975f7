"""Ranges, reports and attempts against brute force, and their plans."""

import itertools
import random

import pytest
from pyspark.sql import functions as F

from terrace.operators import attempts, intervals, keyed, supervise, validate, verify


def test_ranges_of_any_width(spark):
    rng = random.Random(7)
    ranges = [(i, None if i % 13 == 0 else a, None if i % 17 == 0 else a + rng.choice([-2, 0, 1, 5, 64, 1000, 1 << 40])) for i, a in enumerate(rng.randint(-3000, 3000) for _ in range(150))]
    points = [(p,) for p in [rng.randint(-4000, 5000) for _ in range(300)] + [None, 1 << 50, -(1 << 50), 0, 0]]
    a, b = spark.createDataFrame(points, "p long"), spark.createDataFrame(ranges, "r int, lo long, hi long")
    found = intervals.covering(a, b, "p", "lo", "hi")
    holds = lambda p, lo, hi: p is not None and (lo is None or lo <= p) and (hi is None or p <= hi) and (lo is None or hi is None or lo <= hi)
    assert sorted((r.p, r.r) for r in found.collect()) == sorted((p, r) for (p,), (r, lo, hi) in itertools.product(points, ranges) if holds(p, lo, hi))
    last = {r.p: r.r for r in intervals.assigned(a, b, "p", "lo", "hi", "r", "r").collect()}
    assert last == {p: max((r for r, lo, hi in ranges if holds(p, lo, hi)), default=None) for (p,) in points}


def test_ranges_meet_by_equality(spark):
    a, b = spark.range(1000).withColumnRenamed("id", "p"), spark.range(10).select((F.col("id") * 7).alias("lo"), (F.col("id") * 70).alias("hi"))
    joins = [line for line in intervals.covering(a, b, "p", "lo", "hi")._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Join" in line]
    assert sum("_bin" in j for j in joins) == 1 and all("_bin" in j or "Inner" in j for j in joins)
    assert intervals.covering(a, b.limit(0), "p", "lo", "hi").count() == 0 == intervals.covering(a.limit(0), b, "p", "lo", "hi").count()


def inspected(tasks, classifier, results, expected, headers=(True, True)):
    """The state of an attempt, place by place."""
    n = min(len(tasks), len(classifier), len(results))
    prefix = next((i for i in range(n) if not tasks[i] == classifier[i] == results[i]), n)
    whole = all(headers) and prefix == n == max(len(classifier), len(results))
    if whole and len(classifier) == len(results) == expected:
        return prefix, "completed"
    if not classifier and not results and all(headers):
        return prefix, "header_only"
    return prefix, "partial_prefix" if whole and prefix else "partial_misaligned"


def test_attempts_against_brute_force(spark):
    rng = random.Random(3)
    cases = []
    for i in range(120):
        tasks = [str(rng.randint(1, 3)) for _ in range(rng.randint(0, 4))]
        cut = lambda: (tasks + ["9"])[: rng.randint(0, len(tasks) + 1)] if rng.random() < 0.8 else [str(rng.randint(1, 3)) for _ in tasks]
        cases.append((i, tasks, cut(), cut(), rng.choice([len(tasks), 3]), (rng.random() < 0.9, rng.random() < 0.9)))
    side = lambda k: spark.createDataFrame([(c[0], p + 1, x) for c in cases for p, x in enumerate(c[k])], "b int, place long, task_index string")
    rows = spark.createDataFrame([(c[0], c[4], *c[5]) for c in cases], "b int, expected int, classifier_header_ok boolean, results_header_ok boolean")
    got = {r.b: (r.prefix_len, r.state) for r in attempts.inspected(rows, side(1), side(2), side(3), ["b"]).collect()}
    assert got == {c[0]: inspected(*c[1:]) for c in cases} and {s for _, s in got.values()} == {"completed", "header_only", "partial_prefix", "partial_misaligned"}


def test_resolved_reports_dont_block(spark):
    row = ("r", "1", "wrong_company_mapping", "rerun_batch", "full", "full", "why", "", "")
    columns = "report string, task_index string, verdict string, recommended_action string, classifier_search_tier string, verifier_search_tier string, error_reason string, verifier_mapped_entity_name string, corrected_result_row_json string"
    reports, expected = spark.createDataFrame([row], columns), spark.createDataFrame([("r", 1)], "report string, task_index long")
    classifier = spark.createDataFrame([], "task_index long, search_tier string")
    errors = lambda **o: [r.code for r in verify.report_errors(reports, expected, classifier, ["task_index"], **o).collect()]
    assert errors() == ["blocks_merge"] and errors(allow_unresolved=True) == []


def test_identity_comes_from_the_task(spark):
    report = spark.createDataFrame([(" 3 ", "edit_row", '{"task_index": 8, "canonical_slug": "x", "token_origin_type": "stablecoin", "status": "completed"}'), ("4", "edit_row", '{"task_index": 4}'), ("5", "accept_worker_row", "")], "task_index string, recommended_action string, corrected_result_row_json string")
    tasks = spark.createDataFrame([(3, "slug", "SYM", None)], "task_index long, canonical_slug string, token_symbol string, token_name string")
    classifier = spark.createDataFrame([(3, None, "high", "yes")], "task_index long, token_origin_type string, entity_link_likelihood string, entity_search_required string")
    got = verify.corrected(report, tasks, classifier, ["task_index", "canonical_slug", "token_origin_type", "status"]).collect()
    assert [tuple(r) for r in got] == [("3", "slug", "", "completed")]


@pytest.mark.parametrize("text", ["\t", " ", " "])
def test_blank_is_any_white_space(spark, text):
    """A tab is blank in every rule alike."""
    row = spark.createDataFrame([tuple(text if c in validate.LISTS or c == "has_entity_evidence" else "x" for c in validate.RESULT)], ", ".join(f"{c} string" for c in validate.RESULT))
    rules = validate.result_rules()
    flags = row.select(*(rules[f"{c}_blank"].alias(f"{c}_blank") for c in validate.LISTS), rules["evidence_blank"].alias("e")).first()
    assert all(flags) and not any(row.select(*(rules[f"{c}_not_a_list"] for c in validate.LISTS)).first())


def test_keys_that_must_be_whole_numbers(spark):
    rows = lambda *keys: spark.createDataFrame([(i, k) for i, k in enumerate(keys)], "place long, task_index string")
    assert {r[0] for r in keyed.index_set(rows(" 1", "1", "", None, "+3", "-4 "), "task_index", "a").collect()} == {1, 3, -4}
    for wrong in ("1.0", "x", "1 2"):
        with pytest.raises(ValueError, match="invalid task_index in a"):
            keyed.index_set(rows("1", wrong), "task_index", "a")
    with pytest.raises(ValueError, match="invalid task_index in b: ''"):
        keyed.integer_keys(rows("1", " "), "task_index", "b")
    with pytest.raises(ValueError, match="existing output"):
        keyed.merged_by_key(rows("1").withColumn("more", F.lit("")), rows("1"), "task_index", "place", ["task_index"])
    merged, overwritten = keyed.merged_by_key(None, rows("10", "9", "9"), "task_index", "place", ["task_index"])
    assert [r[0] for r in merged.collect()] == [9, 10] and overwritten.count() == 0


def test_headers_and_scopes(spark):
    assert keyed.header_union(["a", " b "], ["b", None, "", "c"], ["a", "d"]) == ["a", "b", "c", "d"]
    backlog = spark.createDataFrame([("/a/x",), ("/b/y",), ("z",), (None,)], "path string")
    scope = spark.createDataFrame([("/other/x",), ("z",)], "path string")
    assert {r[0] for r in supervise.outside_scope(backlog, scope, "path").collect()} == {"/b/y", None}
