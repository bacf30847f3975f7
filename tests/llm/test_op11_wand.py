"""Block-skipping search against exhaustive scoring, and the cuts against all partitions."""

import itertools
import math
import random
import re
from collections import Counter

import duckdb
import numpy as np
import pyarrow as pa
import pytest

from terrace.llm import queries, wand
from tests.llm import corpus

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = "item_id long, text string"


def terms(text):
    return TERM.findall((text or "").translate(LOWER))


def exhaustive(docs, items, k):
    """docs: (doc_id, text); items: (item_id, text). Rows (item_id, rank, doc_id, score)."""
    bags = [(i, Counter(terms(t))) for i, t in docs]
    bags = [(i, b, sum(b.values())) for i, b in bags if b]
    n, total = len(bags), sum(x[2] for x in bags)
    df = Counter(t for _, b, _ in bags for t in b)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = []
    for i, own in wanted.items():
        scored = []
        for d, bag, size in bags:
            m = 100 - 50 + (50 * size * n) // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * ((1000000000 * bag[t]) // (1000 * bag[t] + 20 * m)) for t in own if t in bag)
            if s > 0:
                scored.append((-s, d is None, d or 0, d))
        out += [(i, r + 1, x[3], -x[0]) for r, x in enumerate(sorted(scored, key=lambda x: x[:3])[:k])]
    return sorted(out, key=str)


def searched(spark, docs, items, k):
    found = wand.index(spark.createDataFrame(docs, "doc_id long, text string").repartition(3))
    return sorted(map(tuple, wand.search(found, spark.createDataFrame(items, ITEMS), k).collect()), key=str)


@pytest.fixture
def small(monkeypatch):
    """Blocks, shards and steps so small that a small table has many."""
    for name, value in {"SHARD_BYTES": 3000, "PIECE_BYTES": 500, "RUN": 8, "BLOCK_COST": 20_000, "ITEM_BYTES": 200, "FIRST_SHARDS": 2, "STEP": 7}.items():
        monkeypatch.setattr(wand, name, value)


def test_search_equals_exhaustive_scores(spark, small):
    rng = random.Random(5)
    vocabulary = corpus.words(rng, 120)
    pick = lambda n: " ".join(vocabulary[min(119, int(rng.expovariate(0.05)))] for _ in range(n))
    docs = [(i, pick(rng.randint(1, 60))) for i in range(400)]
    docs += [(1000 + i, docs[i % 7][1]) for i in range(60)]  # ties
    items = [(i, pick(rng.randint(1, 25))) for i in range(30)]
    assert searched(spark, docs, items, 10) == exhaustive(docs, items, 10)


def test_awkward_rows(spark, small):
    rng = random.Random(6)
    texts = corpus.odd_texts(rng)
    docs = [(i if i % 4 else None, t) for i, t in enumerate(texts)] + [(3, "word"), (3, "word")]
    items = [(1, "WORD a"), (1, "text 日本語"), (None, "same here"), (2, None), (3, "...;"), (4, "absent-term"), (5, texts[12]), (6, "É é")]
    assert searched(spark, docs, items, 5) == exhaustive(docs, items, 5)
    assert searched(spark, docs[:0], items, 5) == [] and searched(spark, docs, items[:0], 5) == []
    clash = spark.createDataFrame([(1, "a b", "x", 1, 2)], "doc_id long, text string, term string, shard long, score long")
    assert wand.search(wand.index(clash), clash.selectExpr("doc_id AS item_id", "text", "rank(1) OVER (ORDER BY 1) AS rank"), 3).count() == 1


def test_terms_of_bytes():
    texts = ["Ab-c é1 Ünï", "", None, "x", "y z"]
    words, term, text, count = wand.counted(pa.array(texts))
    got = Counter({(words[int(t)].as_py(), int(d)): int(n) for t, d, n in zip(term, text, count)})
    assert got == Counter((w, i) for i, t in enumerate(texts) for w in terms(t))


def test_cuts_are_the_best_of_all(monkeypatch):
    monkeypatch.setattr(wand, "RUN", 8)
    rng = np.random.default_rng(3)

    def price(tops, starts):
        ends = [*starts[1:], len(tops)]
        return sum((e - s) * tops[s:e].max() + 50 for s, e in zip(starts, ends))

    for size in range(1, 9):
        tops = rng.integers(0, 100, size)
        least = min(price(tops, [0, *c]) for r in range(size) for c in itertools.combinations(range(1, size), r))
        assert price(tops, list(wand.block_starts(tops, np.array([size]), 50))) == least


def test_blocks_are_skipped():
    """A term whose impacts are high in one stretch only is read there only."""
    texts = [" ".join(["rare"] * (40 if 500 <= i < 560 else 1) + [f"w{i}"] * 30) for i in range(2000)]
    words, term, doc, count = wand.counted(pa.array(texts))
    lengths = np.bincount(doc, count, 2000).astype(np.int64)
    ends = np.searchsorted(term, np.arange(len(words)), "right")
    tops = wand.impacts(count, wand.norms(lengths, 2000, int(lengths.sum()))[doc])
    starts = wand.block_starts(tops, ends)
    flat, begins = wand._bytes_of(words)
    packed = [wand._packed(x) for x in (lengths, begins[1:], ends, doc, count, starts, np.maximum.reduceat(tops, starts))]
    row = dict(zip(["lengths", "term_ends", "list_ends", "docs", "counts", "block_starts", "block_tops"], packed)) | {"ids": list(range(2000)), "terms": flat.tobytes()}
    shard = wand.Shard(row, 2000, int(lengths.sum()))
    docs, _ = shard.best(shard.places(["rare"]), np.array([7]), 50, 1)
    assert set(docs) <= set(range(500, 560)) and len(docs) == 50 and shard.visited < 1000


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    want = con.sql(f"SELECT item_id, rank, doc_id, score FROM ({queries.ORACLES['op11_wand']})").fetchall()
    assert sorted(map(tuple, queries.QUERIES["op11_wand"](spark, sf).collect())) == sorted(want)
