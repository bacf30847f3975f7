"""Labelled rows, prefixes, profiles and logs against brute force and at their edges."""

import json
import random

from pyspark.sql import functions as F

from terrace.functions import html, text
from terrace.operators import catalog, logs


def test_labelled_rows(spark):
    page = """<div class="row line"><div class="label">Tags</div><a href="/t/1">a</a><div><a href="/t/2">b <i>c</i></a><a>none</a></div></div>
    <div class="row"><div class="label">Tags</div><a href="/t/9">not a row</a></div><a href="/t/8">outside</a>
    <div class="line big row"><div><div class="label">deeper, no label</div></div><a href="/t/7">x</a></div>
    <div class="row line"><div class="label">Sites<div>inner</div></div><a href=" u ">S</a><div class="row line"><div class="label">no row in a row</div><a href="v">S</a></div></div>
    <div class="row line"><div class="label">Tags</div><a href="/t/1">a</a><a href="/t/3">d"""
    df = spark.createDataFrame([(1, page), (2, None), (3, "")], "k int, p string").withColumn("r", html.labelled_rows(F.col("p"), ["row", "line"], "label"))
    got = {r.k: r for r in df.select("k", "r", html.label_list(F.col("r"), "Tags", "/t/").alias("tags"), html.label_map(F.col("r"), "Sites inner").alias("sites"), html.label_list(F.col("r"), "").alias("bare")).collect()}
    assert json.loads(got[1].tags) == ["a", "b c"] and json.loads(got[1].sites) == {"S": "u"} and json.loads(got[1].bare) == ["x"]
    assert [r.label for r in got[1].r] == ["Tags", "", "Sites inner", "Tags"]
    assert got[2].r == [] == got[3].r and got[2].tags == "[]" and got[2].sites == "{}"


def test_longest_prefixes_against_a_scan(spark):
    rng = random.Random(2)
    word = lambda n: "".join(rng.choice("ab") for _ in range(n))
    prefixes = sorted({word(rng.randint(0, 6)) for _ in range(40)})
    names = [word(rng.randint(0, 9)) for _ in range(200)] + [None, "c"]
    for proper in (False, True):
        df = catalog.longest_prefix(spark.createDataFrame([(n,) for n in names], "n string"), "n", spark.createDataFrame([(p, f"id{p}") for p in prefixes], "p string, i string"), "p", proper)
        want = [(n, max((p for p in prefixes if n is not None and n.startswith(p) and not (proper and p == n)), key=len, default=None)) for n in names]
        assert sorted(((r.n, r.p, r.i) for r in df.collect()), key=str) == sorted(((n, p, None if p is None else f"id{p}") for n, p in want), key=str)
    none = spark.createDataFrame([], "p string, i string")
    assert [r.p for r in catalog.longest_prefix(spark.createDataFrame([("a",)], "n string"), "n", none, "p").collect()] == [None]


def test_profiles_stop_when_all_is_seen(spark, tmp_path):
    for i, rows in enumerate(["a,b\n" + ",\n" * 700 + "x,\n" * 20, "a,b\n ,y\n", "a,b\nz,z\n"]):
        (tmp_path / f"{i}.csv").write_text(rows)
    files = [str(tmp_path / f"{i}.csv") for i in range(3)]
    read = lambda f: spark.read.option("header", True).csv(f)
    profile = lambda most: (lambda found, n: ({r.column_name: r["sample"] for r in found.collect()}, n))(*catalog.bounded_profile(spark, files, read, most, step=50))
    assert profile(5000) == ({"a": "x", "b": "y"}, 2) and profile(300) == ({"a": "", "b": ""}, 1) and profile(721) == ({"a": "x", "b": "y"}, 2) and profile(720) == ({"a": "x", "b": ""}, 1)
    jobs = lambda: len(spark.sparkContext.statusTracker().getJobIdsForGroup("profile"))
    spark.sparkContext.setJobGroup("profile", "profile")
    wide = spark.range(0, 1_000_000, 1, 200).select(F.col("id").cast("string").alias("v"))
    catalog.bounded_profile(spark, ["x"], lambda _: wide)
    tracker = spark.sparkContext.statusTracker()
    tasks = sum(tracker.getStageInfo(s).numTasks for j in tracker.getJobIdsForGroup("profile") for s in tracker.getJobInfo(j).stageIds)
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs() >= 1 and tasks == 1


def test_log_lines(spark):
    lines = ["2024-01-02T03:04:05Z [a] x", "2024-01-02T03:04:05.25+02:00 no [ b ] [c]", "plain [late", "", None, "2024 [d]", "2024-01-02 [e]"]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(lines)], "i int, l string").orderBy("i")
    assert [r[0] for r in df.select(text.log_tag(F.col("l"))).collect()] == ["a", "b", "", "", "", "d", "e"]
    times = [r[0] for r in df.select(F.date_format(text.log_time(F.col("l")), "yyyy-MM-dd HH:mm:ss.SS")).collect()]
    assert times == ["2024-01-02 03:04:05.00", "2024-01-02 01:04:05.25", None, None, None, None, "2024-01-02 00:00:00.00"]


def test_logs_of_odd_lines(spark):
    rows = [("w", i, x) for i, x in enumerate(['{"type":1,"item":[1]}', "[]", "{", "", None, '{"type":null}', '{"type":"item.completed","item":{"type":"agent_message","text":"  "}}', '{"type":"item.completed","item":{"type":"web_search","query":"q"}} x'])]
    df = spark.createDataFrame(rows + [("v", 0, "")], "log string, at int, line string")
    got = {r.log: r for r in logs.worker_rollup(df, "log", "at", "line").collect()}
    assert set(got) == {"w"} and got["w"].json_lines == 3 and got["w"].other_lines == 3 and got["w"].last_agent_message is None and json.loads(got["w"].counts)["1"] == 1
    assert logs.event_rollup(df.where("log = 'v'"), "log", "at", "line").count() == 0
