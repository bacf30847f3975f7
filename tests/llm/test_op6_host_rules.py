import random
import re
from collections import Counter

import duckdb

from terrace.llm import host_rules, queries
from tests.llm import corpus

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = [tuple(words[i : i + 8]) for i in range(len(words) - 7)]
    twice = Counter(grams)
    covered = {j for i, g in enumerate(grams) if twice[g] > 1 for j in range(i, i + 8)}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(covered)


def made(spark):
    rng = random.Random(8)
    texts, hosts = corpus.odd_texts(rng), []
    hosts = [None if i % 5 == 0 else f"h{i % 4}" for i in range(len(texts))]
    for i in range(120):
        lines = [" ".join(corpus.words(rng, rng.randint(1, 12))) for _ in range(rng.randint(1, 8))]
        lines += [rng.choice(lines) for _ in range(rng.choice([0, 0, 1, 6]))]
        texts.append("\n".join(lines) + "#" * rng.choice([0, 0, 3, 90]))
        hosts.append(f"g{i % 6}")
    # One host fails nearly always, one has a single bad page.
    texts += ["bad short"] * 30 + ["also bad"] + [" ".join(corpus.words(rng, 60)) for _ in range(3)]
    hosts += ["bad"] * 30 + ["once"] + ["bad"] * 3
    return texts, hosts, corpus.table(spark, texts, hosts)


def test_measures_against_brute_force(spark):
    texts, hosts, docs = made(spark)
    rows = corpus.by_id(host_rules.judged(docs))
    assert len(rows) == len(texts)
    for t, r in zip(texts, rows.itertuples()):
        want = brute(t)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == want, t and t[:80]
        assert r.base_failed == (want[0] < 20 or 100 * want[4] > 30 * want[0])
        assert not (r.base_failed and r.kept)
    bad = rows[[h == "bad" for h in hosts]]
    assert bad.host_rejected.all() and not bad.kept.any()


def test_one_bad_page_condemns_no_host(spark):
    rng = random.Random(9)
    texts = [" ".join(corpus.words(rng, 30)) if rng.random() > 0.08 else "short" for i in range(2000)] + ["short"] * 30 + ["short"]
    hosts = [f"h{i % 50}" for i in range(2000)] + ["bad"] * 30 + ["once"]
    rows = corpus.by_id(host_rules.judged(corpus.table(spark, texts, hosts)))
    assert set(rows[rows.host_rejected].host) == {"bad"}


def test_oracle(spark, tmp_path):
    _, _, docs = made(spark)
    docs.coalesce(1).write.parquet(str(tmp_path / "documents.parquet"))
    con = duckdb.connect()
    con.sql(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    want = con.sql(queries.ORACLES["op6_host_rules"]).df().sort_values("doc_id").reset_index(drop=True)
    got = corpus.by_id(queries.op6_host_rules(spark, str(tmp_path)))
    for c in got.columns:
        assert got[c].astype(object).where(got[c].notna(), None).tolist() == want[c].astype(object).where(want[c].notna(), None).tolist(), c


def test_empty(spark):
    assert host_rules.judged(spark.createDataFrame([], corpus.SCHEMA)).count() == 0
