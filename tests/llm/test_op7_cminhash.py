import random
import re

import numpy as np
import pytest

from terrace.llm import cminhash, components
from tests.llm import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def shingles(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    w = WORD.findall(low)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute(texts, percent):
    sets = [shingles(t) for t in texts]
    root = list(range(len(texts)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(texts)):
        for j in range(i):
            if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j]):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return [find(i) for i in range(len(texts))], [len(s) for s in sets]


def near(rng, text, edits):
    w = text.split()
    for _ in range(edits):
        w[rng.randrange(len(w))] = rng.choice(corpus.words(rng, 1))
    return " ".join(w)


@pytest.mark.parametrize("percent", [85, 80])
def test_against_brute_force(spark, percent):
    rng = random.Random(9)
    texts = corpus.odd_texts(rng)
    for _ in range(25):
        base = " ".join(corpus.words(rng, rng.randint(4, 150)))
        texts += [base, base.upper(), base.replace(" ", "\n\t ")] + [near(rng, base, rng.randint(0, 4)) for _ in range(6)]
    chain = corpus.words(rng, 100)
    for _ in range(8):
        texts.append(" ".join(chain))
        chain = chain[3:] + corpus.words(rng, 3)
    rng.shuffle(texts)
    rows = corpus.by_id(cminhash.near_duplicates(corpus.table(spark, texts), percent))
    want, sizes = brute(texts, percent)
    assert rows.component_id.tolist() == want
    assert rows.n_shingles.tolist() == sizes
    assert (rows.kept == (rows.doc_id == rows.component_id)).all()


def test_large_bucket_of_near_copies(spark, monkeypatch):
    """Blocks meet pairwise where a bucket holds more than one component."""
    monkeypatch.setattr(cminhash, "BLOCK", 8)
    rng = random.Random(10)
    base = " ".join(corpus.words(rng, 60))
    texts = [near(rng, base, 2) for _ in range(90)] + [near(rng, base, 6) for _ in range(40)]
    rows = corpus.by_id(cminhash.near_duplicates(corpus.table(spark, texts), 85))
    assert rows.component_id.tolist() == brute(texts, 85)[0]


def test_signature_is_circulant():
    sets = np.arange(1, 400, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    a, b = cminhash.signature(sets), cminhash.signature(sets[:340])
    assert a.shape == (160,) and abs((a == b).mean() - 340 / 399) < 0.12


def test_components(spark):
    rng = random.Random(11)
    edges = [(i, i + 1) for i in range(0, 200)] + [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)] + [(7, 7), (500, 501), (501, 500)]
    got = {r.node: r.component for r in components.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got[i] == 0 for i in range(1, 201)) and got[501] == 500 and 0 not in got


def test_odd_tables(spark):
    assert cminhash.near_duplicates(spark.createDataFrame([], corpus.SCHEMA)).count() == 0
    docs = spark.createDataFrame([(None, "a b c"), (4, "a b c"), (4, "a b c"), (9, "A B\nc"), (5, None)], "doc_id long, text string")
    rows = {(r.doc_id, r.component_id, r.kept) for r in cminhash.near_duplicates(docs).collect()}
    assert rows == {(None, None, True), (4, 4, True), (9, 4, False), (5, 5, True)}
