import random
import zlib

from terrace.llm import shards
from tests.llm import corpus


def checked(spark, texts, n):
    rows = corpus.by_id(shards.sharded(corpus.table(spark, texts), n))
    assert rows.doc_id.tolist() == list(range(len(texts)))
    assert rows["size"].tolist() == [len((t or "").encode()) + 8 for t in texts]
    assert rows.text_crc32.tolist() == [zlib.crc32((t or "").encode()) for t in texts]
    assert set(rows.law) <= {"rows"} and rows.grown_shard.isna().all()
    counts = rows.groupby("shard").size().reindex(range(n), fill_value=0)
    assert counts.max() - counts.min() <= 1
    for _, part in rows.groupby("shard"):
        assert sorted(part.slot) == list(range(len(part)))
    return rows


def cut(rows, texts):
    """Links between neighbours in a chain of equal texts that cross shards, at the least."""
    seen = {}
    for t, s in zip(texts, rows.shard):
        if t is not None:
            seen.setdefault(t, set()).add(s)
    return sum(len(x) - 1 for x in seen.values())


def test_counts_and_links(spark):
    rng = random.Random(5)
    texts = corpus.odd_texts(rng)[:12] + [f"group {i % 60}" for i in range(240)] + [f"alone {i}" for i in range(400)]
    rng.shuffle(texts)
    rows = checked(spark, texts, 8)
    assert cut(rows, texts) <= 25


def test_one_text_has_a_third_of_all_rows(spark):
    texts = ["hot"] * 300 + [f"pair {i // 2}" for i in range(300)] + [f"alone {i}" for i in range(300)]
    rows = checked(spark, texts, 6)
    # 300 copies need two shards of 150; clans of half a shard can't all close.
    assert cut(rows, texts) <= 60


def test_same_rows_same_shards(spark):
    texts = [f"text {i % 40}" for i in range(200)]
    first, second = checked(spark, texts, 5), checked(spark, texts, 5)
    assert first.shard.tolist() == second.shard.tolist()


def test_tiny_and_empty(spark):
    assert shards.sharded(spark.createDataFrame([], corpus.SCHEMA), 24).count() == 0
    checked(spark, ["a", "a", None], 24)
    both = spark.createDataFrame([(1, "x"), (1, "x"), (None, None), (None, "x")], "doc_id long, text string")
    assert shards.sharded(both, 2).groupBy("shard").count().toPandas()["count"].tolist() == [2, 2]
