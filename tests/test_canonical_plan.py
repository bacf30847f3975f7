"""Canonical rows are made by expressions of bounded size, and stay what they were."""

from pyspark.sql import functions as F

from terrace.operators import validate


def test_moves_dont_multiply_in_the_plan(spark):
    rows = spark.range(3).select(F.col("id").alias("k"), F.lit("complete").alias("status"), F.when(F.col("id") == 1, "site|press").otherwise("no").alias("needs_manual_review"), F.lit("https://a.com|http://b.com").alias("confidence"), F.lit("a|b").alias("mapped_entity_name"))
    got = validate.canonical_result(rows)
    assert len(got._jdf.queryExecution().executedPlan().toString()) < 100_000
    want = ("completed", '["completed"]', "low", "https://a.com|http://b.com", '["a","b"]')
    for r in got.collect():
        assert (r.status, r.project_name, r.confidence, r.evidence_urls, r.mapped_entity_name) == want
        assert (r.needs_manual_review, r.evidence_source_types) == (("yes", "site|press") if r.k == 1 else ("no", ""))
