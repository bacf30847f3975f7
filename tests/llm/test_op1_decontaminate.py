import random

from terrace.llm import decontaminate
from tests.llm import corpus


def brute(item: str, text: str) -> int:
    """Least edit distance between item and a stretch of text, by the plain table."""
    item, text = " ".join(item.lower().split()), " ".join(text.lower().split())
    row = [0] * (len(text) + 1)
    for i, a in enumerate(item, 1):
        before, row[0] = row[:], i
        for j, b in enumerate(text, 1):
            row[j] = min(before[j] + 1, row[j - 1] + 1, before[j - 1] + (a != b))
    return min(row)


def damaged(rng, text, share):
    chars = list(text)
    for _ in range(int(share * len(chars))):
        at = rng.randrange(len(chars))
        kind = rng.randrange(3)
        if kind == 0:
            chars[at] = rng.choice("abcdefgh")
        elif kind == 1:
            del chars[at]
        else:
            chars.insert(at, rng.choice("abcdefgh"))
    return "".join(chars)


def test_distance_equals_the_plain_table():
    rng = random.Random(1)
    for _ in range(60):
        item = " ".join(corpus.words(rng, rng.randint(1, 30)))
        text = " ".join(corpus.words(rng, 5)) + " " + damaged(rng, item, rng.random() * 0.3) + " " + " ".join(corpus.words(rng, 5))
        assert decontaminate.distance_within(decontaminate.normal(item), decontaminate.normal(text)) == brute(item, text)


def test_leaks_against_brute_force(spark):
    rng = random.Random(2)
    items = [" ".join(corpus.words(rng, rng.randint(15, 50))) for _ in range(12)] + ["Ça déjà vu l'été où naître, être ou paraître — voilà: " + " ".join(corpus.words(rng, 8))]
    texts = corpus.odd_texts(rng)
    for i in range(120):
        passage = damaged(rng, items[i % len(items)], (0, 0, 0.02, 0.05, 0.08)[i % 5])
        texts.append(" ".join(corpus.words(rng, rng.randint(0, 60))) + " " + (passage.upper() if i % 7 == 0 else passage) + "\n" + " ".join(corpus.words(rng, rng.randint(0, 60))))
    texts += [" ".join(corpus.words(rng, 80)) for _ in range(40)]
    docs = corpus.table(spark, texts)
    bench = spark.createDataFrame([*enumerate(items), (90, None), (91, "")], "item_id long, text string")
    got = {(r.doc_id, r.item_id): r.distance for r in decontaminate.leaks(docs, bench).collect()}
    want = {}
    for d, t in enumerate(texts):
        for i, item in enumerate(items):
            if t and len(t) < 20_000 and (x := brute(item, t)) <= int(0.15 * len(" ".join(item.lower().split()))):
                want[d, i] = x
    assert not set(got) - set(want)
    assert all(got[k] == want[k] for k in got)
    assert len(got) >= 0.97 * len(want)
    whole = {k for k in want if want[k] == 0}
    assert whole <= set(got)


def test_recall_by_length_and_damage(spark):
    """Items of 1 to 60 words, wrapped, indented, in capitals, in a very long text: none lost undamaged, few at the limit."""
    rng = random.Random(6)
    lengths = (1, 2, 3, 5, 8, 12, 15, 30, 60)
    items = [" ".join(corpus.words(rng, n)) for n in lengths for _ in range(12)] + ["据说这种茶只在高山上的小村里才能买到而且每年只采一次所以价格一直很高但是味道非常好并且能够保存很多年" * 2]
    for share, least in ((0.0, 1.0), (0.15, 0.9)):
        texts, want = [], []
        for item in items:
            own = damaged(rng, item, share).upper().replace(" ", "\n\t  ")
            texts.append(" ".join(corpus.words(rng, 30)) + " " + own + "  " + " ".join(corpus.words(rng, 30)))
        texts.append(" ".join(corpus.words(rng, 30_000)) + " " + " ".join(items))
        bench = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
        got = {(r.doc_id, r.item_id) for r in decontaminate.leaks(corpus.table(spark, texts), bench).collect()}
        assert {(len(items), i) for i in range(len(items))} <= got
        for n in lengths:
            own = [i for i in range(len(items)) if len(items[i].split()) == n and len(items[i]) < 1000]
            assert sum((i, i) in got for i in own) >= least * len(own), n
        assert share or (len(items) - 1, len(items) - 1) in got


def test_repeated_rows_null_ids_and_other_columns(spark):
    item = "some item of the benchmark that is long enough to be walked from several of its words at least"
    docs = spark.createDataFrame([(1, f"before {item} behind", 1, "a"), (1, f"before {item} behind", 2, "b"), (None, item, 3, "c")], "doc_id long, text string, item_id long, distance string")
    items = spark.createDataFrame([(1, item, 5), (1, item, 6), (None, item, 7)], "item_id long, text string, doc_id long")
    rows = decontaminate.leaks(docs, items).collect()
    assert {(r.doc_id, r.item_id, r.distance, r.item_chars) for r in rows} == {(1, 1, 0, len(item))}


def test_empty_tables(spark):
    none = spark.createDataFrame([], corpus.SCHEMA)
    items = spark.createDataFrame([(1, "some item of the benchmark that is long enough")], "item_id long, text string")
    assert decontaminate.leaks(none, items).count() == 0
    docs = corpus.table(spark, ["text"])
    assert decontaminate.leaks(docs, items.limit(0)).count() == 0
