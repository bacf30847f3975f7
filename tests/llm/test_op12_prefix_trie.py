"""The trie against a brute-force one."""

import hashlib
import random
import zlib
from collections import defaultdict

import duckdb

from terrace.llm import prefix_trie, queries

SCHEMA = "conv_id long, turn long, role string, text string"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def brute(rows):
    own = defaultdict(list)
    for c, t, r, x in rows:
        if c is not None:
            r, x = r or "", x or ""
            own[c].append((t is not None, t or 0, hashlib.md5(f"{len(r)}:{r}{x}".encode()).digest(), r, x))
    own = {c: [(r, x) for *_, r, x in sorted(v)] for c, v in own.items()}
    members, children, ends = defaultdict(list), defaultdict(set), defaultdict(list)
    for c in sorted(own):
        h, base = zlib.crc32(str(c).encode()) % 9, c - (c % 5 if c >= 0 else -(-c % 5))
        seq = own.get(base, [])[:h] + own[c][h:]
        for d in range(len(seq) + 1):
            members[tuple(seq[:d])].append(c)
            if d:
                children[tuple(seq[: d - 1])].add(tuple(seq[:d]))
        ends[tuple(seq)].append(c)
    leaves, saved = {}, {}
    for k in sorted(members, key=len, reverse=True):
        leaves[k] = sum(leaves[x] for x in children[k]) or 1
        saved[k] = (len(members[k]) - 1) * (len(k[-1][1].encode()) if k else 0) + sum(saved[x] for x in children[k])
    digest = lambda k: hashlib.sha256(",".join(map(str, ends[k])).encode()).hexdigest()
    return sorted((min(m), len(k), min(members[k[:-1]]) if k else -1, len(m), len(children[k]), leaves[k], saved[k], digest(k)) for k, m in members.items())


def built(spark, rows):
    out = prefix_trie.prefix_trie(spark.createDataFrame(rows, SCHEMA).repartition(3))
    return sorted(tuple(-1 if r[c] is None else r[c] for c in COLUMNS) for r in out.collect())


def test_equals_brute_force(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "PIECE_IDS", 4)
    rng = random.Random(9)
    rows = []
    for c in range(-7, 70):
        if c % 10 == 3:
            continue
        rows += [(c, t, rng.choice(["user", "user", "bot"]), rng.choice(["a", "bé", "", "ccc"])) for t in range(rng.randint(1, 6))]
    for c in range(100, 140):  # copies, more than a piece of ids
        rows += [(c, t, "user", f"turn {t}") for t in range(3)]
    rng.shuffle(rows)
    assert built(spark, rows) == brute(rows)


def test_awkward_rows(spark):
    rows = [(None, 0, "user", "nobody's"), (5, None, None, None), (5, None, "user", "first"), (5, 2, "user", "x"), (5, 2, "user", "x"), (5, 2, "bot", "x"), (6, 1, "", ""), (7, 0, "user", "y" * 50_000)]
    rows += [(9, t, "user", f"long {t}") for t in range(150)]
    assert built(spark, rows) == brute(rows)
    assert built(spark, []) == []
    same = [(c, t, "user", "same") for c in range(10, 20) for t in range(12)]
    assert built(spark, same) == brute(same)


def test_other_columns_dont_matter(spark):
    rows = [(1, 0, "user", "a", 1, "x", 2), (2, 0, "user", "a", 1, "x", 2)]
    turns = spark.createDataFrame(rows, SCHEMA + ", pos int, key string, depth int")
    assert prefix_trie.prefix_trie(turns).count() == len(brute([r[:4] for r in rows]))


def test_query_equals_its_sql(spark):
    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.sql(f"CREATE VIEW conversations AS SELECT * FROM '{sf}/conversations.parquet'")
    want = con.sql(f"SELECT {', '.join(COLUMNS)} FROM ({queries.ORACLES['op12_prefix_trie']})").fetchall()
    got = queries.QUERIES["op12_prefix_trie"](spark, sf).select(*COLUMNS).collect()
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
