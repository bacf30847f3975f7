"""A table whose files are small but whose rows aren't is not sent to every executor."""

from pyspark.sql import functions as F

from terrace.llm._spark import BROADCAST_BYTES, file_bytes, sized_join, written


def test_repeated_values_are_not_broadcast(spark):
    side = written(spark.range(600_000).select("id", F.lit("x" * 90).alias("much"), F.lit("y").alias("more")), "repeated")
    assert file_bytes(side) <= BROADCAST_BYTES
    joined = sized_join(spark.range(5), side, "id", "left")
    assert "ResolvedHint" not in joined._jdf.queryExecution().analyzed().toString()
    few = written(side.limit(5), "few")
    assert "ResolvedHint" in sized_join(spark.range(5), few, "id", "left")._jdf.queryExecution().analyzed().toString()
