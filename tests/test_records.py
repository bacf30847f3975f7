"""Ragged CSV files against the reader of Python's library."""

import csv
import io
import json
import random

import pytest
from pyspark.sql import functions as F

from terrace.sources import records

HEADER = ["id", "name", "has_entity_evidence", "u", "v", "w", "x"]


def read_by_library(path):
    with open(path, encoding="utf-8-sig", newline="") as f:
        reader = csv.DictReader(f)
        out = []
        for i, row in enumerate(reader, start=2):
            extra = row.pop(None, None)
            out.append((i, tuple(row[c] or "" for c in reader.fieldnames), json.dumps(extra, ensure_ascii=False) if extra else None, list(reader.fieldnames)))
        return out


def write(path, rng, n, bom=False, ending="\n"):
    out = io.StringIO()
    out.write(("﻿" if bom else "") + ",".join(HEADER) + ending)
    for i in range(n):
        kind = rng.randrange(8)
        cells = [str(i), f"n{i} é", "text, more" if kind == 1 else "t", "1", "2", "3", "4"]
        if kind == 2:
            cells = cells[: rng.randint(1, 6)]
        if kind == 3:
            cells += ["more", "", 'q"q'][: rng.randint(1, 3)]
        if kind == 4:
            cells[2] = f'said "x", then{ending}new line{ending}{ending}end'
        if kind == 1:
            out.write(",".join(cells) + ending)
        else:
            csv.writer(out, lineterminator=ending).writerow(cells)
        if kind == 5:
            out.write(ending)
    path.write_text(out.getvalue(), encoding="utf-8", newline="")


@pytest.fixture
def folder(tmp_path):
    rng = random.Random(4)
    write(tmp_path / "a.csv", rng, 400, bom=True)
    write(tmp_path / "b.csv", rng, 150, ending="\r\n")
    write(tmp_path / "c_10.csv", rng, 0)
    (tmp_path / "plain.csv").write_text("id,name,has_entity_evidence,u,v,w,x\n" + "".join(f"{i},n,t,1,2,3,4\n" for i in range(300)))
    return tmp_path


def test_same_rows_as_the_library_at_any_split(spark, folder):
    for size, cost in (("700b", "0"), ("128m", "4m")):
        spark.conf.set("spark.sql.files.maxPartitionBytes", size)
        spark.conf.set("spark.sql.files.openCostInBytes", cost)
        try:
            rows = records.records(spark, str(folder))
            tasks = records._lines(spark, str(folder), "plain.csv").select("split").distinct().count()
            got = {}
            for r in records.kept(rows, HEADER).collect():
                got.setdefault(r.file.rsplit("/", 1)[1], []).append((r.record, tuple(r[c] for c in HEADER), r[records.SURPLUS]))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
            spark.conf.unset("spark.sql.files.openCostInBytes")
        assert (tasks > 1) == (size == "700b")
        for name in ("a.csv", "b.csv", "plain.csv"):
            assert sorted(got[name]) == [x[:3] for x in read_by_library(folder / name)], (name, size)
        assert "c_10.csv" not in got


def test_surplus_commas_go_back(spark, folder):
    got = {}
    for r in records.rejoined(records.records(spark, str(folder), "[ab].csv"), HEADER, "has_entity_evidence").collect():
        got.setdefault(r.file.rsplit("/", 1)[1], {})[r.record] = [r[c] for c in HEADER]
    for name in ("a.csv", "b.csv"):
        for i, row, extra, header in read_by_library(folder / name):
            values = [*row, *json.loads(extra or "[]")]
            if len(values) > len(header):
                values = values[:2] + [",".join(values[2:-4])] + values[-4:]
            assert got[name][i] == values, (name, i)


def test_exact_headers_and_counts(spark, folder, tmp_path):
    rows, counts = records.loaded(records.records(spark, str(folder)), HEADER)
    assert {r.file.rsplit("/", 1)[1]: r.n_rows for r in counts.collect()} == {"a.csv": 400, "b.csv": 150, "c_10.csv": 0, "plain.csv": 300} and rows.count() == 850
    with pytest.raises(ValueError, match="not"):
        records.loaded(records.records(spark, str(folder)), HEADER[:-1])


def test_headers_with_equal_names_and_other_orders(spark, tmp_path):
    (tmp_path / "a.csv").write_text('b,a,b\n1,2,3\n"",x\n')
    (tmp_path / "b.csv").write_text("a\n7\n,\n")
    got = {(r.file.rsplit("/", 1)[1], r.record): (r.a, r.b, r[records.SURPLUS]) for r in records.kept(records.records(spark, str(tmp_path)), ["a", "b"]).collect()}
    assert got == {("a.csv", 2): ("2", "3", None), ("a.csv", 3): ("x", "", None), ("b.csv", 2): ("7", "", None), ("b.csv", 3): ("", "", '[""]')}


def test_listing_and_manifest(spark, folder, tmp_path):
    found = records.listing(spark, str(folder)).orderBy("place").collect()
    assert [(r["name"], r.is_sample) for r in found] == [("a.csv", False), ("b.csv", False), ("c_10.csv", True), ("plain.csv", False)]
    batches = tmp_path / "batches"
    batches.mkdir()
    for b in (1, 2):
        (batches / f"batch_{b:04d}.jsonl").write_text("".join(json.dumps({"task_index": b * 10 + i, "company_name": "" if i == 0 else f"c{i}"}) + "\n\n" for i in (0, 2, 1)))
    rows = spark.read.schema("task_index int, company_name string").json(str(batches)).select("*", F.col("_metadata.file_name").alias("f"), F.monotonically_increasing_id().alias("record"))
    got = {r.number: (r.first_key, r.last_key, r["keys"], r.first_name, r.last_name) for r in records.manifest(rows, F.col("f"), "task_index", "company_name").collect()}
    assert got == {1: (10, 12, [10, 12, 11], "c2", "c1"), 2: (20, 22, [20, 22, 21], "c2", "c1")}
