import random
from collections import Counter, defaultdict

from terrace.llm import line_templates as lt
from tests.llm import corpus


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def groups(texts, ids):
    """The least document of each one's group of copies, by all pairs."""
    sets, label = {d: shingles(texts[d]) for d in ids}, {d: d for d in ids}
    for a in ids:
        for b in ids:
            both = len(sets[a] & sets[b])
            if a < b and both and 100 * both >= lt.COPY_PERCENT * len(sets[a] | sets[b]):
                old, new = max(label[a], label[b]), min(label[a], label[b])
                label = {d: new if x == old else x for d, x in label.items()}
    return label


def brute(texts):
    """The same tree in plain dictionaries, and copies by all pairs."""
    def mask(line):
        return tuple(lt.FIELD if any(c in "0123456789" for c in t) else t for t in line.split())

    lines = {d: [mask(x) for x in t.split("\n")] if t else [] for d, t in enumerate(texts)}
    leaves = defaultdict(lambda: defaultdict(set))
    for d, own in lines.items():
        for m in own:
            if m:
                leaves[len(m), m[: lt.LEADS]][m].add(d)
    template = {}
    for leaf, forms in leaves.items():
        counts = Counter()
        for m, ds in forms.items():
            for i, t in enumerate(m):
                counts[i, t] += len(ds)
        for m in forms:
            out = tuple(t if counts[i, t] >= lt.MIN_DOCS else lt.FIELD for i, t in enumerate(m))
            k = sum(counts[i, t] >= lt.MIN_DOCS for i, t in enumerate(m))
            if k < len(m) and 100 * k >= lt.LEAST_CONSTANT * len(m) and len(forms) > 1 and sum(map(len, forms.values())) >= lt.MIN_DOCS:
                template[m] = (leaf, out)

    def recurring(label):
        held = defaultdict(set)
        for d, own in lines.items():
            for m in filter(None, own):
                held[template.get(m, m)].add(label.get(d, d))
        return {x for x, ds in held.items() if len(ds) >= lt.MIN_DOCS}

    first = recurring({})
    gone = {d: sum(len(m) for m in own if m and template.get(m, m) in first) for d, own in lines.items()}
    heavy = [d for d, own in lines.items() if any(own) and 100 * gone[d] >= lt.COPY_PERCENT * sum(map(len, own))]
    final = recurring(groups(texts, heavy))
    result = []
    for d, t in enumerate(texts):
        drop = {i for i, m in enumerate(lines[d]) if m and template.get(m, m) in final}
        result.append((t if not drop else "\n".join(x for i, x in enumerate(t.split("\n")) if i not in drop), len(drop)))
    return result


def test_against_brute_force(spark):
    rng = random.Random(12)
    users = corpus.words(rng, 60)
    texts = corpus.odd_texts(rng)
    for i in range(80):
        body = ["\n".join(" ".join(corpus.words(rng, rng.randint(8, 20))) for _ in range(rng.randint(2, 5)))]
        kinds = [f"posted by user {rng.choice(users)} on day {rng.randint(1, 30)} of the month", "all rights reserved by the owner", f"login at 12:{rng.randint(10, 59)} from 10.0.0.{i}", "ok"]
        body += rng.sample(kinds, rng.randint(0, 3))
        if i % 9 == 0:
            body.append(" ".join(f"long{k}" if k % 7 else "w" for k in range(70)))
        rng.shuffle(body)
        texts.append("\n".join(body))
    docs = corpus.table(spark, texts)
    rows = corpus.by_id(lt.deduplicated(docs))
    want = brute(texts)
    assert rows.n_dropped.tolist() == [n for _, n in want]
    assert [t if isinstance(t, str) else None for t in rows.text] == [t for t, _ in want]
    left = "\n".join(t for t, n in zip(rows.text, rows.n_dropped) if n)
    assert sum(rows.n_dropped > 0) > 40
    assert "posted by user" not in left and "rights reserved" not in left


def test_long_passages_go_and_copies_stay(spark):
    rng = random.Random(5)
    passage, field = corpus.words(rng, 60), corpus.words(rng, 8)
    texts = [" ".join(corpus.words(rng, 40)) + "\n" + " ".join([*passage[:30], field[i], *passage[31:]]) for i in range(6)]
    whole = "\n".join(" ".join(corpus.words(rng, 15)) for _ in range(6))
    texts += [whole] * 4 + [whole.replace(whole.split()[20 + i], "changed") for i in range(4)]
    pages = [" ".join(corpus.words(rng, 12)) for _ in range(9)]
    texts += ["\n".join(pages[i : i + 4] + [" ".join(corpus.words(rng, 2))]) for i in range(6)]
    rows = corpus.by_id(lt.deduplicated(corpus.table(spark, texts)))
    want = brute(texts)
    assert rows.n_dropped.tolist() == [n for _, n in want] and rows.text.tolist() == [t for t, _ in want]
    assert all(" ".join(passage[31:]) not in t for t in rows.text[:6]) and rows.n_dropped[:6].eq(1).all()
    assert rows.text[6:14].tolist() == texts[6:14]


def test_short_lines_and_null_ids(spark):
    own = [" ".join(corpus.words(random.Random(i), 9)) for i in range(5)]
    docs = spark.createDataFrame([(i if i < 3 else None, f"yes\n{t}") for i, t in enumerate(own)], "doc_id long, text string")
    assert {r.n_dropped for r in lt.deduplicated(docs).collect()} == {1}
    assert {r.n_dropped for r in lt.deduplicated(docs, min_tokens=2).collect()} == {0}


def test_odd_tables(spark):
    docs = spark.createDataFrame([(1, None, 1), (1, None, 1), (2, "", 2), (3, "a b c d", 3)], "doc_id long, text string, n_lines int")
    out = lt.deduplicated(docs)
    assert out.columns == ["doc_id", "text", "n_lines", "_n_lines", "n_dropped"]
    assert sorted((r.doc_id, r._n_lines, r.n_dropped) for r in out.collect()) == [(1, 0, 0), (1, 0, 0), (2, 0, 0), (3, 1, 0)]
    assert lt.deduplicated(docs.limit(0)).count() == 0
