import random

import public_tokenizers
import sentencepiece

import corpus_pipeline
from tests.llm import corpus
from tests.llm.test_op5_toxicity import labelled
from tests.llm.test_op7_cminhash import near


def made(spark, folder):
    rng = random.Random(15)
    docs, labels, toxic = labelled(spark, 300)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    clean = [" ".join(corpus.words(rng, 90)) for _ in range(60)]
    copies = [t if i % 2 else near(rng, t, 1) for i, t in enumerate(clean[:20])]
    items = [" ".join(corpus.words(rng, 30)) for _ in range(4)]
    leaky = [" ".join(corpus.words(rng, 40)) + " " + t + " " + " ".join(corpus.words(rng, 40)) for t in items]
    lines = "subscribe to our newsletter for more stories like this"
    clean[30:40] = [f"{t}\n{lines}" for t in clean[30:40]]
    every = texts + clean + copies + leaky + [None, ""]
    corpus.table(spark, every).write.parquet(f"{folder}/documents.parquet")
    labels.write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(list(enumerate(items)), "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    n = len(texts)
    return every, toxic, range(n, n + 60), range(n + 60, n + 80), range(n + 80, n + 84), lines


def test_stages_do_their_work(spark, tmp_path):
    every, toxic, clean, copies, leaky, line = made(spark, tmp_path)
    docs, seen = spark.read.parquet(f"{tmp_path}/documents.parquet"), []
    for i, (name, stage) in enumerate(corpus_pipeline.STAGES):
        docs = stage(spark, docs, str(tmp_path))
        if i < 4:
            assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"]
        docs.write.parquet(f"{tmp_path}/stage{i}")
        docs = spark.read.parquet(f"{tmp_path}/stage{i}")
        seen.append({r.doc_id: r.text if i < 4 else list(r.ids) for r in docs.collect()})
    bad = {i for i, t in enumerate(toxic) if t}
    assert len(bad - set(seen[0])) >= 0.95 * len(bad) and len(set(clean) - set(seen[0])) == 0
    assert not any(line in (t or "") for t in seen[1].values()) and set(seen[1]) == set(seen[0])
    assert not set(copies) & set(seen[2]) and set(clean) <= set(seen[2])
    assert not set(leaky) & set(seen[3]) and set(seen[2]) - set(leaky) == set(seen[3])
    own = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    assert all(ids == own.encode(seen[3][d] or "") for d, ids in seen[4].items()) and set(seen[4]) == set(seen[3])
    whole = {r.doc_id: list(r.ids) for r in corpus_pipeline.run(spark, str(tmp_path)).collect()}
    assert whole == seen[4]


def folder(spark, path, docs, labels=(), items=()):
    docs.write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(list(labels), "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(list(items), "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_empty_tables(spark, tmp_path):
    docs = corpus.table(spark, ["some text of a few words", None, ""])
    assert corpus_pipeline.run(spark, folder(spark, tmp_path / "a", docs.limit(0))).count() == 0
    assert {r.doc_id for r in corpus_pipeline.run(spark, folder(spark, tmp_path / "b", docs)).collect()} == {0, 1, 2}


def test_awkward_rows_and_clashing_columns(spark, tmp_path):
    """Rows without doc_id, repeated rows, a very long text and columns that the stages use themselves."""
    rng = random.Random(23)
    text = lambda n: " ".join(corpus.words(rng, n))
    alone, again, long_, leak, item = text(60), text(60), text(40_000), text(50), text(20)
    rows = [(None, alone), (None, again), (5, again), (6, long_), (6, long_), (None, f"{leak} {item} {leak}"), (7, None), (None, None), (None, ""), (8, "x")]
    names = "stage_id string, row_key string, shard int, bucket int, kept string, drops string, n_tokens string, ids string"
    docs = spark.createDataFrame([(i, t, "en", "s", 1, *["c", "c", 1, 2, "k", "d", "n", "i"]) for i, t in rows], f"{corpus.SCHEMA}, {names}")
    path = folder(spark, tmp_path / "c", docs, items=[(1, item)])
    got, now = [], docs
    for i, (_, stage) in enumerate(corpus_pipeline.STAGES[:4]):
        stage(spark, now, path).write.parquet(f"{tmp_path}/stage{i}")
        now = spark.read.parquet(f"{tmp_path}/stage{i}")
        assert now.columns == docs.columns
    got = [(r.doc_id, r.text) for r in now.collect()]
    want = [(None, alone), (5, again), (6, long_), (6, long_), (7, None), (None, None), (None, ""), (8, "x")]
    assert sorted(got, key=str) == sorted(want, key=str)
    assert corpus_pipeline.run(spark, path).count() == len(want)
