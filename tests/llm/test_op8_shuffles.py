"""What the line dedup writes and shuffles follows lines that can recur, not all of them."""

import random

from terrace.llm import line_templates as lt
from tests.llm import corpus


def test_only_lines_of_crowded_leaves_go_on(spark, monkeypatch):
    rng, rows = random.Random(3), {}

    def counted(df, kind, write=lt.written):
        out = write(df, kind)
        rows[kind] = out.count()
        return out

    monkeypatch.setattr(lt, "written", counted)
    texts = ["\n".join([*(" ".join(corpus.words(rng, 9)) for _ in range(40)), "all rights reserved by the owner"]) for _ in range(20)]
    out = corpus.by_id(lt.deduplicated(corpus.table(spark, texts)))
    assert out.n_dropped.tolist() == [1] * 20 and out.n_lines.tolist() == [41] * 20
    assert rows["lines"] < 60 and rows["lines"] >= 20


def test_repeated_rows_have_the_shares_of_one(spark):
    rng = random.Random(8)
    shared = [" ".join(corpus.words(rng, 10)) for _ in range(5)]
    texts = ["\n".join([*shared, *(" ".join(corpus.words(rng, 10)) for _ in range(own))]) for own in (3, 4, 4, 5, 6, 7, 9)]
    once = corpus.by_id(lt.deduplicated(corpus.table(spark, texts)))
    docs = corpus.table(spark, texts)
    again = lt.deduplicated(docs.unionByName(docs).unionByName(docs.where("doc_id < 3"))).distinct().toPandas().sort_values("doc_id")
    assert again.n_dropped.tolist() == once.n_dropped.tolist() and again.text.tolist() == once.text.tolist()
