import random
import zlib

import numpy as np
import public_tokenizers as P
from tokenizers import Tokenizer

from terrace.llm import token_files as tf
from terrace.llm._spark import scratch
from tests.llm import corpus

FILE = P.path("word_bpe_49k.json")


def test_against_the_library(spark):
    rng = random.Random(14)
    texts = corpus.odd_texts(rng) + ["it's they'll CAN'T", "a,b;c.d", "<|endoftext|> x", "ÀÉÎ õ ß", "1234 5,678.9", "no break em", "x'y ''s", "tail..."] + ["".join(rng.choice("abc ,.'!é日 \n1") for _ in range(200)) for _ in range(80)]
    rng.shuffle(texts)
    rows = corpus.by_id(tf.token_file_digest(spark, corpus.table(spark, texts), FILE))
    own, start = Tokenizer.from_file(FILE), 0
    for t, r in zip(texts, rows.itertuples()):
        ids = own.encode(t or "", add_special_tokens=False).ids + [2]
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())), t and t[:60]
        start += len(ids)


def test_other_vocabularies_and_whole_ids(spark):
    texts = ["plain text", None, "two  spaces", "déjà"]
    manifest = tf.write_token_files(corpus.table(spark, texts), scratch(spark, "t"), P.path("byte_bpe_50k.json"), 9)
    own = Tokenizer.from_file(P.path("byte_bpe_50k.json"))
    got = corpus.by_id(tf.read_token_files(manifest, vocabulary_ids=True))
    assert [list(x) for x in got.ids] == [own.encode(t or "", add_special_tokens=False).ids + [9] for t in texts]
    assert {r.width for r in manifest.collect()} == {2}


def test_odd_ids_and_empty(spark):
    docs = spark.createDataFrame([(5, "b"), (None, "a"), (5, "a"), (-3, "")], "doc_id long, text string")
    rows = tf.token_file_digest(spark, docs, FILE).toPandas().sort_values("start")
    assert [None if x != x else int(x) for x in rows.doc_id.astype(float)] == [None, -3, 5, 5]
    assert tf.token_file_digest(spark, docs.limit(0), FILE).count() == 0


def test_one_id_may_fill_several_sets(spark, tmp_path):
    """Sets follow the bytes, whatever the ids; bases have no gap."""
    rows = [(7 if i % 3 else None, f"text {i} " * (i % 9)) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    manifest = tf.write_token_files(docs, str(tmp_path / "t"), FILE, 2, set_bytes=2000)
    sets = manifest.orderBy("base").collect()
    assert len(sets) > 4 and all(b.base == a.base + a.n_tokens for a, b in zip(sets, sets[1:])) and sets[0].base == 0
    read = tf.read_token_files(manifest).orderBy("start").collect()
    assert len(read) == 300 and all(b.start == a.start + a.n_tokens for a, b in zip(read, read[1:]))
    assert [r.doc_id for r in read] == [None] * 100 + [7] * 200
