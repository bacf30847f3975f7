"""Versioned tables: what readers see when writers fail, race or repeat themselves."""

import pytest
from pyspark.sql import functions as F

from terrace.sources.versions import Overtaken, VersionedTable


def held(table, number=None):
    df = table.read(number)
    return None if df is None else {tuple(r) for r in df.collect()}


@pytest.fixture
def table(spark, tmp_path):
    return VersionedTable(spark, f"{tmp_path}/t", ["k"])


def rows(spark, *pairs):
    return spark.createDataFrame(list(pairs), "k long, v string")


def test_upserts_replace_by_key(spark, table):
    assert table.read() is None and table.state() is None
    assert table.upsert(rows(spark, (1, "a"), (2, "b"))) == 1
    assert table.upsert(rows(spark, (2, "c"), (3, "d"))) == 2
    assert held(table) == {(1, "a"), (2, "c"), (3, "d")} and held(table, 1) == {(1, "a"), (2, "b")}
    with pytest.raises(ValueError, match="more than once"):
        table.upsert(rows(spark, (4, "x"), (4, "y")))


def test_a_writer_that_fails_before_it_publishes_leaves_the_old_rows(spark, table):
    table.upsert(rows(spark, (1, "a")))

    def fail():
        raise RuntimeError("lost")

    with pytest.raises(RuntimeError, match="lost"):
        table.upsert(rows(spark, (1, "z")), before_publish=fail)
    assert held(table) == {(1, "a")} and table.versions() == [1]
    assert table.vacuum() == 1 and held(table) == {(1, "a")}
    assert table.upsert(rows(spark, (1, "z"))) == 2 and held(table) == {(1, "z")}


def test_an_overtaken_writer_starts_again(spark, table):
    table.upsert(rows(spark, (1, "a")))
    other, once = VersionedTable(spark, table.path, ["k"]), []

    def overtake():
        if not once:
            once.append(other.upsert(rows(spark, (2, "b"))))

    assert table.upsert(rows(spark, (3, "c")), before_publish=overtake) == 3
    assert held(table) == {(1, "a"), (2, "b"), (3, "c")}
    with pytest.raises(Overtaken):
        table.upsert(rows(spark, (9, "x")), attempts=1, before_publish=lambda: other.upsert(rows(spark, (8, "y"))))
    assert held(table) == {(1, "a"), (2, "b"), (3, "c"), (8, "y")}


def test_a_repeated_batch_changes_nothing(spark, table):
    put = table.sink("events", "at")
    one = spark.createDataFrame([(1, "a", 1), (1, "b", 2)], "k long, v string, at int")
    put(one, 0)
    put(spark.createDataFrame([(1, "c", 3)], "k long, v string, at int"), 1)
    put(one, 0)
    put(one, 1)
    assert held(table) == {(1, "c", 3)} and table.versions() == [1, 2] and table.state()["batches"] == {"events": 1}


def test_a_stream_of_upserts(spark, table, tmp_path):
    for i in range(3):
        spark.createDataFrame([(k, f"{k}.{i}", i) for k in range(i, 4)], "k long, v string, at int").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in")
    for _ in range(2):
        stream = spark.readStream.schema("k long, v string, at int").option("maxFilesPerTrigger", 1).parquet(f"{tmp_path}/in")
        query = stream.writeStream.foreachBatch(table.sink("s", "at")).option("checkpointLocation", f"{tmp_path}/c").trigger(availableNow=True).start()
        query.awaitTermination()
        assert held(table) == {(0, "0.0", 0), (1, "1.1", 1), (2, "2.2", 2), (3, "3.2", 2)}


def test_an_emptied_table_is_gone_where_asked(spark, table):
    table.upsert(rows(spark, (1, "a"), (2, "b")))
    table.delete(rows(spark, (1, "")))
    assert held(table) == {(2, "b")}
    table.delete(rows(spark, (2, "")), keep_empty=False)
    assert table.read() is None and table.state()["folder"] is None
    table.upsert(rows(spark, (5, "e")))
    assert held(table) == {(5, "e")}


def test_updates_by_row(spark, table):
    table.upsert(rows(spark, (1, "a"), (2, "b")))
    table.updated(lambda df: df.withColumn("v", F.upper("v")))
    assert held(table) == {(1, "A"), (2, "B")}
    with pytest.raises(ValueError, match="columns"):
        table.updated(lambda df: df.drop("v"))
