import math
import random
import zlib

import zstandard

from terrace.llm import toxicity
from tests.llm import corpus


def labelled(spark, n=600):
    rng = random.Random(6)
    base = corpus.words(rng, 300)
    bad = ["worthless", "disgusting", "idiotic", "pathetic", "moronic", "filthy", "loathsome"]
    texts, toxic = [], []
    for i in range(n):
        text = [rng.choice(base) for _ in range(rng.randint(20, 120))]
        label = int(rng.random() < 0.25)
        if label:
            for _ in range(rng.randint(4, 9)):
                text.insert(rng.randrange(len(text)), rng.choice(bad))
        texts.append(" ".join(text))
        toxic.append(label)
    docs = corpus.table(spark, texts)
    return docs, spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int"), toxic


def test_held_out_accuracy_and_contract(spark):
    docs, labels, toxic = labelled(spark)
    rows = corpus.by_id(toxicity.classified(docs, labels))
    assert rows.held_out.tolist() == [zlib.crc32(str(i).encode()) % 5 == 0 for i in range(len(toxic))]
    assert rows.score.between(0, 1).all() and (rows.predicted == (rows.score >= 0.5)).all()
    held = rows[rows.held_out]
    right = sum(p == toxic[i] for i, p in zip(held.doc_id, held.predicted)) / len(held)
    assert right > 0.95
    clean = toxicity.cleaned(docs, labels)
    assert clean.columns == docs.columns
    assert {r.doc_id for r in clean.select("doc_id").collect()} == set(rows[rows.predicted == 0].doc_id)


def test_held_out_labels_are_never_read(spark):
    docs, labels, _ = labelled(spark, 200)
    flipped = labels.withColumn("toxic", toxicity.F.when(toxicity.held_out(), 1 - toxicity.F.col("toxic")).otherwise(toxicity.F.col("toxic")))
    a, b = corpus.by_id(toxicity.classified(docs, labels)), corpus.by_id(toxicity.classified(docs, flipped))
    assert a.score.tolist() == b.score.tolist()


def test_odd_rows_and_no_labels(spark):
    docs = corpus.table(spark, corpus.odd_texts(random.Random(7)))
    rows = toxicity.classified(docs, spark.createDataFrame([], "doc_id long, quality int, toxic int")).toPandas()
    assert len(rows) == docs.count() and rows.score.between(0, 1).all()
    _, labels, _ = labelled(spark, 60)
    assert toxicity.classified(docs.limit(0), labels).count() == 0


def plain_score(model, text):
    """Score of a text in plain Python: windows, their lengths with either dictionary, and the logistic."""
    def length(window, content):
        known = zstandard.ZstdCompressionDict(content, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        known.precompute_compress(level=3)
        return len(zstandard.ZstdCompressor(level=3, dict_data=known, write_content_size=False, write_checksum=False, write_dict_id=False).compress(window))

    raw, gains, at = (text or "").encode(), [], 0
    while True:
        window = raw[at : at + 48]
        gains.append(length(window, model.ordinary) - length(window, model.ordinary + model.toxic))
        at += 24
        if at >= len(raw) - 24:
            break
    told = [g for g in gains if g >= 2]
    strong = sum(g >= 4 for g in gains)
    x = (math.log1p(sum(told)), math.log1p(100 * sum(told) / len(gains)), math.log1p(len(told)), math.log1p(strong), math.log1p(100 * strong / len(gains)))
    return 1 / (1 + math.exp(-max(-30, min(30, sum(a * b for a, b in zip(x, model.weights)) + model.bias))))


def test_scores_against_plain_python(spark):
    docs, labels, _ = labelled(spark, 300)
    texts = [r.text for r in docs.orderBy("doc_id").collect()]
    long_ = " ".join(corpus.words(random.Random(9), 30_000)) + " worthless idiotic"
    odd = [t for t in corpus.odd_texts(random.Random(7)) if not t or len(t) < 6000]
    every = corpus.table(spark, [*texts[:60], *odd, long_, long_])
    rows, share = toxicity.training_rows(docs, labels, ~toxicity.held_out())
    model = toxicity.fitted(rows, share)
    got = corpus.by_id(toxicity.scored(every, model)).score.tolist()
    want = [plain_score(model, t) for t in [*texts[:60], *odd, long_]]
    assert all(abs(a - b) < 1e-9 for a, b in zip(got, [*want, want[-1]])) and len(got) == len(want) + 1


def test_a_huge_text_does_not_use_up_the_sample(spark):
    docs, labels, _ = labelled(spark, 100)
    huge = spark.range(1000, 1040).selectExpr("id AS doc_id", "repeat(concat(id, ' word '), 200000) AS text", "'en' AS lang", "'s' AS source", "0L AS n_chars")
    more = labels.unionByName(huge.selectExpr("doc_id", "1 AS quality", "1 AS toxic"))
    rows, _ = toxicity.training_rows(docs.unionByName(huge), more, ~toxicity.held_out())
    plain, _ = toxicity.training_rows(docs, labels, ~toxicity.held_out())
    assert sorted(rows) == sorted(plain) and len(rows) > 60


def test_null_ids_and_clashing_columns(spark):
    docs, labels, _ = labelled(spark, 100)
    more = docs.selectExpr("CASE WHEN doc_id % 9 <> 0 THEN doc_id END AS doc_id", "text", "doc_id AS score", "1 AS toxic", "2 AS copy")
    rows = toxicity.classified(more.unionByName(more), labels).toPandas()
    assert len(rows) == 200 and rows[rows.doc_id.isna()].held_out.all() and rows.score.between(0, 1).all()


def test_stems_of_many_forms_and_copies():
    """A stem with many endings is found, and one that only near copies of a text share isn't."""
    rng = random.Random(4)
    ordinary = [" ".join(corpus.words(rng, 40)).encode() for _ in range(400)]
    ends = ["a", "ment", "eau", "ou", "isch", "ung"]
    toxic = [" ".join(corpus.words(rng, 40) + [f"vorx{rng.choice(ends)}{rng.choice(ends)}"]).encode() for _ in range(60)]
    words = corpus.words(rng, 60) + ["zuplikat"]
    copies = [" ".join([*words[:i], "other", *words[i + 1 :]]).encode() for i in range(40)]
    found = toxicity._typical(toxic + copies, ordinary)
    assert b"vorx" in found and not any(s.startswith(b"zupl") for s in found)
    families = toxicity._families(toxic + copies)
    assert len(set(families[:60])) == 60 and len(set(families[60:])) == 1


def test_the_fit_does_not_hang_on_the_order_of_rows(spark):
    docs, labels, _ = labelled(spark, 300)
    rows, share = toxicity.training_rows(docs, labels, ~toxicity.held_out())
    assert toxicity.fitted(rows, share) == toxicity.fitted(rows[::-1], share)
