"""Timeouts in a stream: what is put out when nothing arrives, by timers on the time of events.

Rows wait in a key's state until the watermark has passed them, so that they are taken in order however micro-batches cut
the stream. Behind the last row of a key two timers run; what they find doesn't depend on whether a later row has come by
then, as a gap counts by its length alone.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from terrace.sources.shared import scratch

STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


class Silence(StatefulProcessor):
    """For each event that soft or hard seconds pass without another of its key: the event and the action."""

    def __init__(self, soft: int, hard: int):
        self.limits = ((soft, "soft_timeout"), (hard, "hard_timeout"))

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        #: One entry for all rows that come at once, as each entry and each timer is a call to the store.
        self.waiting = handle.getListState("waiting", "ats array<long>, events array<long>")
        #: The last event that the watermark has passed, and how many limits it is beyond.
        self.last = handle.getValueState("last", "at long, event long, told int")

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        came = [(row.at, row.event) for row in rows]
        if came:
            ats, events = map(list, zip(*came))
            # One timer for the earliest row: it takes all rows that the watermark has passed by then.
            self.waiting.appendValue((ats, events))
            self.handle.registerTimer(min(ats) // 1000 + 1)
        return iter(())

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        now, out = timerValues.getCurrentWatermarkInMs(), []
        known = sorted(((at, event) for ats, events in self.waiting.get() for at, event in zip(ats, events)), key=lambda x: (x[0], x[1] is not None, x[1] or 0))
        passed = [x for x in known if x[0] // 1000 < now]
        last = tuple(self.last.get()) if self.last.exists() else None

        def told(until: int) -> None:
            nonlocal last
            at, event, level = last
            while level < len(self.limits) and until // 1_000_000 - at // 1_000_000 >= self.limits[level][0]:
                out.append(Row(key=key[0], event=event, action=self.limits[level][1]))
                level += 1
            last = (at, event, level)

        for at, event in passed:
            if last:
                told(at)
            last = (at, event, 0)
        if last:
            # No row before the watermark is to come, and those that wait are behind it.
            told(now * 1000)
            self.last.update(last)
            if last[2] < len(self.limits):
                self.handle.registerTimer((last[0] // 1_000_000 + self.limits[last[2]][0]) * 1000 + 1)
        if passed:
            behind = known[len(passed) :]
            if behind:
                self.waiting.put([tuple(map(list, zip(*behind)))])
                self.handle.registerTimer(behind[0][0] // 1000 + 1)
            else:
                self.waiting.clear()
        return iter(out)

    def close(self) -> None:
        pass


def silences(events: DataFrame, key: str, event: str, at: str, soft: int, hard: int, delay: str = "0 seconds") -> DataFrame:
    """key, event and action (soft_timeout, hard_timeout) of a stream: an event that so many seconds pass behind.

    A row for each limit that is passed. Seconds are whole ones; the last event of a key counts by the watermark, which is
    delay behind the latest event of all. Events that arrive behind the watermark are lost, as Spark drops them. The
    session's state store has to be one with timers, STORE.
    """
    rows = events.where(F.col(key).isNotNull() & F.col(at).isNotNull()).withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, delay)
    keyed = rows.select(F.col(key).cast("string").alias("key"), F.col(event).cast("long").alias("event"), F.unix_micros(at).alias("at"), F.col(at).alias("time"))
    return keyed.groupBy("key").transformWithState(Silence(soft, hard), "key string, event long, action string", "Append", "EventTime")


def replayed_silences(spark: SparkSession, source: str, schema, key: str, event: str, at: str, soft: int, hard: int, glob: str = "*", files: int | None = None) -> DataFrame:
    """What silences puts out over a folder of files that is read as a stream to its end, as a table."""
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, STORE)
    try:
        reader = spark.readStream.schema(schema).option("pathGlobFilter", glob)
        stream = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(source)
        out = scratch(spark, "silences")
        query = silences(stream, key, event, at, soft, hard).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", scratch(spark, "stream")).trigger(availableNow=True).start()
        query.awaitTermination()
        return spark.read.schema("key string, event long, action string").parquet(out)
    finally:
        if before is None:
            spark.conf.unset(PROVIDER)
        else:
            spark.conf.set(PROVIDER, before)
