"""Progress of append-only outputs as a stream: state by key, replayed from files until what is there is read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.sources.shared import scratch


def counted(events: DataFrame, key: str, at: str) -> DataFrame:
    """The running state of each key: events so far, and the first and the last time; for streams and tables alike."""
    return events.groupBy(key).agg(F.count(F.lit(1)).alias("n_events"), F.min(at).alias("first_at"), F.max(at).alias("last_at"))


def replayed(spark: SparkSession, source: str, name: str, key: str, at: str) -> DataFrame:
    """The final state by key of a table of files that is read as a stream, written by each batch as a keyed table of its own.

    A batch's table holds the whole state by then, so that a batch that runs again writes the same; the last one counts.
    """
    out, path = scratch(spark, "progress"), f"{source}/{name}.parquet"
    schema = spark.read.parquet(path).schema
    stream = spark.readStream.schema(schema).option("pathGlobFilter", f"{name}.parquet").parquet(source)
    state = counted(stream, key, at)
    versions: list[int] = []

    def keep(batch: DataFrame, version: int) -> None:
        batch.write.mode("overwrite").parquet(f"{out}/{version}")
        versions.append(version)

    query = state.writeStream.outputMode("complete").foreachBatch(keep).option("checkpointLocation", scratch(spark, "stream")).trigger(availableNow=True).start()
    query.awaitTermination()
    return spark.read.parquet(f"{out}/{versions[-1]}") if versions else counted(spark.read.parquet(path), key, at)
