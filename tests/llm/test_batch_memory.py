import random

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from terrace.llm import _spark, cminhash
from tests.llm import corpus

LIMIT = "spark.sql.execution.arrow.maxBytesPerBatch"


@pytest.fixture
def unset(spark):
    before = spark.conf.get(LIMIT, None)
    spark.conf.unset(LIMIT)
    yield
    spark.conf.unset(LIMIT)
    if before is not None:
        spark.conf.set(LIMIT, before)


def batch_sizes(batches):
    for b in batches:
        yield pa.RecordBatch.from_pydict({"n": pa.array([b.num_rows]), "size": pa.array([b.nbytes])})


def wide(spark):
    return spark.range(0, 300, 1, 1).select("id", F.expr("repeat('0123456789', 10000)").alias("text"))


def test_batches_of_wide_rows(spark, unset):
    """30 MB in one task went to the worker as one batch, and 64 MB at most."""
    rows = _spark.written(wide(spark).mapInArrow(batch_sizes, "n long, size long"), "sizes").collect()
    assert sum(r.n for r in rows) == 300
    assert max(r.size for r in rows) <= 1.1 * _spark.BATCH_BYTES


def test_limit_of_the_session_stays(spark, unset):
    spark.conf.set(LIMIT, 1_000_000)
    rows = _spark.written(wide(spark).mapInArrow(batch_sizes, "n long, size long"), "sizes").collect()
    assert spark.conf.get(LIMIT) == "1000000" and max(r.size for r in rows) <= 1_200_000


def test_workers_give_back_what_is_free(spark):
    """What a step needs for a time isn't the worker's for good."""

    def run(batches):
        for batch in _spark.sliced(batches, "text"):
            parts = [bytes(1000) for _ in range(100_000)]
            kept = parts[::1000]
            del parts
            yield pa.RecordBatch.from_pydict({"n": pa.array([len(kept)]), "mb": pa.array([0])})
        size = next(int(x.split()[1]) // 1024 for x in open("/proc/self/status") if x.startswith("RssAnon"))
        yield pa.RecordBatch.from_pydict({"n": pa.array([0]), "mb": pa.array([size])})

    mb = max(r.mb for r in wide(spark).limit(1).mapInArrow(run, "n long, mb long").collect())
    assert mb < 120


def test_near_duplicates_in_small_batches(spark, unset, monkeypatch):
    """No step gets a batch beyond the limit, and the verdicts are those of one batch."""
    rng = random.Random(31)
    texts = []
    for _ in range(12):
        words = corpus.words(rng, 400)
        texts += [" ".join(words), " ".join(words[:-3] + corpus.words(rng, 3)), " ".join(corpus.words(rng, 400))]
    docs = corpus.table(spark, texts).coalesce(1)
    spark.conf.set(LIMIT, 1 << 30)
    want = sorted(map(tuple, cminhash.near_duplicates(docs).collect()))
    spark.conf.unset(LIMIT)
    monkeypatch.setattr(_spark, "BATCH_BYTES", 20_000)
    whole = cminhash.sliced

    def sliced(batches, column, *size):
        def small(found):
            for b in found:
                assert b.num_rows == 1 or pa.Table.from_batches([b]).nbytes <= 40_000, b.nbytes
                yield b

        return whole(small(batches), column, *size)

    monkeypatch.setattr(cminhash, "sliced", sliced)
    assert sorted(map(tuple, cminhash.near_duplicates(docs).collect())) == want
    assert len({c for _, _, c, _ in want}) == 24
