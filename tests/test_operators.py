import ast
import json

import pytest
from pyspark.sql import functions as F

from terrace.functions import html, text, values
from terrace.operators import batching, catalog, match, merge, ordering, quality, rounds, search, selection, validate
from terrace.sources import files
from terrace.sources.shared import shared_folder


def col(spark, values_, expr, kind="string"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values_)], f"i int, v {kind}")
    return [r[0] for r in df.orderBy("i").select(expr(F.col("v"))).collect()]


def test_white_space(spark):
    assert col(spark, [" a\t b\n", None, "", " x"], text.collapsed) == ["a b", "", "", "x"]
    assert col(spark, ["ab cd", "abc"], lambda c: text.limited(c, 3)) == ["ab", "abc"]


def test_urls(spark):
    urls = ["https://User@www.X.com:80/a/b/?q#f", "x.com/y", "//x.com/y", "", None, "http:///p"]
    assert col(spark, urls, text.url_host) == ["user@www.x.com:80", "x.com", "x.com", "", "", "p"]
    assert col(spark, urls[:2], text.bare_host) == ["x.com", "x.com"]
    assert col(spark, ["https://x.com/a/b/?q", "https://x.com", "https://x.com/a"], text.url_slug) == ["b", "", "a"]


def test_numbers(spark):
    assert col(spark, ["0.8", "0.79", "0.5", "nan", "-inf", "+Infinity", "0.8d", "HIGH", " low ", "", None, "1e-1"], values.bucketed) == ["high", "medium", "medium", "low", "low", "high", "0.8d", "HIGH", "low", "", None, "low"]
    assert col(spark, ["5", "5.0", " 7 ", None, "x"], lambda c: values.optional_int(c, -1)) == [5, -1, 7, -1, -1]


def test_lists(spark):
    raw = ['["a", "b"]', "['a','b']", "none", '[""a"",""b""]', "a | b", "word", None, "[1,2] x", "['a'|'b']", "[1,2][3]"]
    assert col(spark, raw, values.normal_list) == ['["a","b"]', '["a","b"]', "[]", '["a","b"]', '["a","b"]', '["word"]', "", '["[1,2] x"]', '''["['a'","'b']"]''', '["[1,2][3]"]']
    more = ["1,2", "n/a", "  ", '"[\\"a\\"]"', '["a"]"', "('a', 1)"]
    assert col(spark, more, values.normal_list) == ["[1,2]", '["n/a"]', "", '["a"]', '["[\\"a\\"]\\""]', '["a",1]']
    assert col(spark, raw[:3] + ["[1,2] x"], values.list_length) == [2, -1, -1, -1]
    assert col(spark, ['["a",1]', "x"], values.json_list) == [["a", "1"], []]
    assert col(spark, ['{"b":1}', None, "bad"], lambda c: values.incremented(c, F.lit("a"))) == ['{"a":1,"b":1}', '{"a":1}', '{"a":1}']


def test_numbered_is_gapless_whatever_the_partitions(spark):
    df = spark.range(1000).select((F.col("id") * 7 % 1009).alias("k")).repartition(13)
    out = ordering.numbered(df, ["k"], "n").orderBy("k").collect()
    assert [r.n for r in out] == list(range(1, 1001))


def test_tasks_and_empty_tables(spark):
    df = spark.range(65).withColumnRenamed("id", "k")
    tasks = batching.task_batches(df, ["k"], 30)
    assert [(r.batch_index, r.task_count, r.first_name) for r in batching.manifest(tasks, "k").orderBy("batch_index").collect()] == [(1, 30, 0), (2, 30, 30), (3, 5, 60)]
    assert batching.task_batches(df.limit(0), ["k"], 30).count() == 0
    assert merge.islands(spark.createDataFrame([(1,), (2,), (2,), (5,), (None,)], "k long"), "k").orderBy("first_key").collect() == [(1, 2, 2, 3), (5, 5, 1, 6)]


def test_tiers(spark):
    left = spark.createDataFrame([(1, "s1", "a", "n"), (2, "x", "b", "m"), (3, "x", "b", "m"), (4, "y", "", "z"), (5, "q", "k", "l5")], "left_id long, slug string, symbol string, name string")
    right = spark.createDataFrame([(11, "s1", "zz", "zz"), (12, "t", "b", "m"), (13, "u", "", "z"), (14, "v", "k", "")], "right_id long, slug string, symbol string, name string")
    out = {(r.left_id, r.right_id, r.match_method) for r in match.tiered(left, right, ["slug"], [("same", ["symbol", "name"])]).collect()}
    # Two candidates on a side match nothing; blank symbols match each other; blank names don't.
    assert out == {(1, 11, "exact"), (4, 13, "same"), (2, None, "left_only"), (3, None, "left_only"), (5, None, "left_only"), (None, 12, "right_only"), (None, 14, "right_only")}


def test_overrides_link_what_is_still_unused(spark):
    left = spark.createDataFrame([(1, "s1", "a"), (2, "s2", "b"), (3, "s3", "c"), (4, "s4", "d")], "left_id long, slug string, name string")
    right = spark.createDataFrame([(11, "s1", "x"), (12, "t2", "y"), (13, "t3", "z")], "right_id long, slug string, name string")
    # Used by the exact tier; the first of two for one record; no such record.
    overrides = spark.createDataFrame([(1, 13, 0), (3, 12, 1), (2, 12, 2), (4, 99, 3)], "left_id long, right_id long, place int")
    out = {(r.left_id, r.right_id, r.match_method) for r in match.tiered(left, right, ["slug"], [("same", ["name"])], overrides).collect()}
    assert out == {(1, 11, "exact"), (3, 12, "manual_override"), (2, None, "left_only"), (4, None, "left_only"), (None, 13, "right_only")}


def test_choosers(spark):
    rows = [("Ring Alpha", "ring-alpha "), ("Alpha Coin", "Alpha"), ("Alpha", "Alphabet Two"), ("One", "Two"), ("One", None), (None, "Two"), ("", "Two"), ("One", "")]
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, a string, b string").orderBy("i")
    a, b = F.col("a"), F.col("b")
    assert [r[0] for r in df.select(text.chosen_name(a, b, ["coin", "ring"])).collect()] == ["Ring Alpha", "Alpha", "Alpha", "Two", "One", "Two", "Two", ""]
    assert [r[0] for r in df.select(text.chosen_filled(a, b)).collect()] == ["ring-alpha ", "Alpha", "Alphabet Two", "Two", "One", "Two", "Two", "One"]
    names = spark.createDataFrame([(0, "ring alpha"), (1, "alpha ring, Coin!"), (2, "coin"), (3, "goldcoin"), (4, None)], "i int, a string").orderBy("i")
    assert [r[0] for r in names.select(text.loose_key(a, ["coin", "ring"])).collect()] == ["ringalpha", "alpha", "", "goldcoin", ""]


def test_json_lists_are_those_of_the_strict_reader(spark):
    raw = ["[]", " [1] ", "[NaN]", "[1,2] x", "[1],[2]", '[1],"b":[2]', "[1]] , [[2]", '[{"a":1,"a":2}]', "['a']", "[a]", '["\\u00e9", "\t"]', '["\\q"]', "[1.]", "[01]", "[1e999]", "{}", '"[1]"', None, "", "[", "[[[]]]", '["a" "b"]', "\u00a0[1]", "[1,]", "[tRue]", "[true,null]"]

    def strict(x):
        try:
            return isinstance(json.loads(x), list)
        except (ValueError, TypeError):
            return False

    assert col(spark, raw, values.is_json_list) == [strict(x) for x in raw]


def test_normal_lists_in_either_reader(spark):
    raw = ["a", " a|b | ", "none", "Null", "None", "https://x.com/?a=1", '["a", "b c"]', '[ "é" ]', "a,b", "1", "1|2", "(1, 'x')", '["a\\n"]', "a\tb", "yes|", "|", "True", "x\u2003y \u00a0", '["a",1]', '[""]', "b'x'", "{1: 2}"]

    def library(t):
        t = t.strip()
        for read in (json.loads, ast.literal_eval):
            try:
                if isinstance(found := read(t), (list, tuple)):
                    return json.dumps(list(found), ensure_ascii=False, separators=(",", ":"))
            except (ValueError, SyntaxError):
                pass
        if t.lower() in ("none", "null"):
            return "[]"
        items = [p.strip() for p in t.split("|") if p.strip()] if "|" in t else [t]
        return json.dumps(items, ensure_ascii=False, separators=(",", ":"))

    assert col(spark, raw, values.normal_list) == [library(x) for x in raw]


def test_fold_keeps_first_seen_order(spark):
    rel = spark.createDataFrame([(1, "b", 1), (1, "a", 2), (1, "b", 3), (None, "x", 4), (2, " ", 5)], "k long, v string, at long")
    ents = spark.createDataFrame([(1,), (2,)], "k long")
    assert {(r.k, r.vs) for r in search.enriched(ents, "k", [search.folded(rel, "k", "v", "at", "vs")]).collect()} == {(1, "b | a"), (2, "")}


def test_merge_and_overlay(spark):
    old = spark.createDataFrame([(1, "a"), (2, "b")], "k long, v string")
    new = spark.createDataFrame([(2, "c"), (3, "d")], "k long, v string")
    assert {tuple(r) for r in merge.upserted(old, new, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    assert [tuple(r) for r in merge.overwritten(old, new, "k", ["v"]).collect()] == [(2, "v")]
    decisions = spark.createDataFrame([(1, "edit", "z"), (2, "rerun", None)], "k long, decision string, new_v string")
    assert {tuple(r) for r in quality.overlaid(old, decisions, "k", ["v"]).collect()} == {(1, "z", "verified"), (2, "b", "needs_rerun")}


def test_ragged_rows(spark):
    rows = [["a", "b", "c"], ["a", "b", "x", "y", "c"], ["a"]]
    assert col(spark, rows, lambda c: quality.repaired_ragged(c, 3, 1), "array<string>") == [["a", "b", "c"], ["a", "b,x,y", "c"], ["a", "", ""]]
    with pytest.raises(ValueError):
        quality.guarded(spark.range(1))
    quality.guarded(spark.range(1), allow_partial=True)
    quality.guarded(spark.range(0))


def test_html_sections(spark):
    page = '<article><p>One &amp; two</p><article>in</article><script>no()</script><a href="u">L</a><a href="w">L</a></article><p>out</p>'
    (x,) = col(spark, [page], html.section)
    assert x.text.startswith("One & two") and "no()" not in x.text and "out" not in x.text
    assert x.links == '{"L": "u"}'
    assert col(spark, ["", None], html.section) == [("", "{}"), ("", "{}")]


def test_csv_and_jsonl(spark, tmp_path):
    (tmp_path / "a.csv").write_bytes('﻿id,note\n1,"two\nlines"\n2,"a ""q"""\n3,\n'.encode())
    (tmp_path / "a_10.csv").write_text("id,note\n9,sample\n")
    df = files.with_columns(files.read_csv(spark, str(tmp_path), "a.csv"), ["id"])
    assert {tuple(r) for r in files.with_header(df, ["id", "note"]).collect()} == {("1", "two\nlines"), ("2", 'a "q"'), ("3", "")}
    with pytest.raises(ValueError):
        files.with_columns(df, ["id", "missing"])
    raw = files.without_samples(spark.read.option("header", True).csv(str(tmp_path)))
    assert raw.where("id = '9'").count() == 0
    files.write_batches(spark.createDataFrame([(1, 1, "x"), (2, 1, "y"), (3, 2, "z")], "k long, batch_index long, v string"), str(tmp_path / "out"))
    back = files.read_jsonl(spark, str(tmp_path / "out/batch_index=1"), "k long, v string")
    assert {tuple(r) for r in back.collect()} == {(1, "x"), (2, "y")}
    tasks = spark.createDataFrame([("1", "old", 1), ("1", "new", 2), ("x", "bad", 3)], "k string, v string, at long")
    assert [r.v for r in files.last_by_key(tasks, "k", "at").collect()] == ["new"]
    assert [r.n for r in files.record_numbers(tasks, F.lit("f"), ["at"], "n").orderBy("at").collect()] == [2, 3, 4]


def test_profile_and_lookup(spark):
    df = spark.createDataFrame([(2, "b", None), (1, " ", None)], "k long, name string, price double")
    rows = {r.column_name: (r.sample, r.n_filled, r.inferred_type) for r in catalog.profile(df, "k", ["name", "price"]).collect()}
    assert rows == {"name": ("b", 1, "TEXT"), "price": (None, 0, "DECIMAL")}


def test_what_must_be_refused(spark):
    rows = spark.createDataFrame([(1, "/a/x.csv"), (2, "/a/y.csv")], "k int, path string")
    asked = spark.createDataFrame([(1, "y.csv"), (2, "/b/z.csv")], "at int, value string")
    with pytest.raises(ValueError, match="z.csv"):
        selection.scoped(rows, "path", asked, "value", "at")
    with pytest.raises(ValueError, match="path"):
        validate.unexpected_columns(rows, ["k"])
    progress = lambda *open_: spark.createDataFrame([(i, not o) for i, o in enumerate(open_)], "r int, all_resolved boolean")
    assert rounds.single_open_round(progress(False, True, False), "r") == 1
    for wrong in ((False, False), (True, True)):
        with pytest.raises(ValueError):
            rounds.single_open_round(progress(*wrong), "r")
    assert rounds.resume_point(progress(False, False), "r").collect()[0].asDict() == {"resume_round": None, "completed_rounds": 2}


def test_arguments():
    assert selection.listed_ids(["a, B", "a", " "], lower=True) == ["a", "b"]
    assert search.clean_keywords([" Web3", "web3", "", "Token "]) == ["web3", "token"]


def test_orders_and_windows(spark):
    rows = spark.createDataFrame([("9", "b", 1), ("10", "a", 2), ("n/a", "C", 3), ("", "b", 4), ("9", "a", 5)], "rank string, slug string, at int")
    assert [r.at for r in rows.orderBy(*selection.rank_order(F.col("rank"), F.col("slug"), F.col("at"))).collect()] == [5, 1, 2, 4, 3]
    assert [r.at for r in selection.window(rows, ["at"], 1, 0).collect()] == [2, 3, 4, 5]


def test_a_stream_of_no_files_has_no_state(spark, tmp_path):
    rows = spark.createDataFrame([(1, "2020-01-01")], "k int, at string").limit(0)
    rows.write.parquet(f"{tmp_path}/none.parquet")
    from terrace.streaming.progress import replayed

    assert replayed(spark, str(tmp_path), "none", "k", "at").count() == 0


def test_a_cluster_needs_a_shared_folder():
    class Context:
        master = "spark://host:7077"

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda name, default: default)

    with pytest.raises(ValueError, match="checkpoint"):
        shared_folder(Session())
