"""Line dedup by a fixed-depth log-template tree.

A line is parsed into tokens between white space; tokens with a digit are variable fields from the start. The tree
sends it down by its number of tokens and its LEADS first tokens. Within a leaf, a token is constant at its place if
lines of MIN_DOCS documents have it there, and else a variable field; where enough of a line is constant, the line's
template is what stays. Other lines are their own template. Lines of any length take part.

A template that MIN_DOCS documents hold is recurring, and its lines are dropped wherever they stand, whatever share of
a document that is. Copies of one document count as one: documents with COPY_PERCENT of their tokens in recurring lines
are grouped by the Jaccard similarity of their five-word shingles, and a group counts once for each of its templates.
So what only the copies of a text share stays for document dedup to judge, and boilerplate goes from copies as well.

The tree's counts are sums by (leaf, place, token), so that they don't depend on the order of lines, and no leaf is
gathered anywhere: only lines of leaves that hold different lines are taken apart. Texts are parsed twice: first leaves
are counted, and then only lines of leaves with MIN_DOCS lines go on, so that no other line is written or shuffled with
its text but once, where the keys of those leaves are too many for a broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from hashlib import md5

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm._spark import fresh, id_filter, row_key, sized_join, sliced, written
from terrace.llm.cminhash import near_duplicates

MIN_DOCS = 3
LEADS = 3
#: Share of a line's tokens that must be constant, in hundredths.
LEAST_CONSTANT = 70
#: Share of a document's tokens in recurring lines from which it may be a copy, and similarity of copies, in hundredths.
COPY_PERCENT = 50
#: Rows of a band in the search for copies: at that similarity two share no band of three rows with probability 8e-4.
COPY_ROWS = 3
FIELD = "<*>"
#: Lines of a task whose text is not written again.
REMEMBERED = 200_000
_DIGIT = re.compile(r"[0-9]")


def _masked(text: str | None) -> Iterator[tuple[int, list[str]]]:
    """Number and masked tokens of each line that has tokens."""
    for i, line in enumerate(text.split("\n") if text else ()):
        tokens = line.split()
        if tokens:
            yield i, [FIELD if _DIGIT.search(x) else x for x in tokens] if _DIGIT.search(line) else tokens


def _leaf(tokens: list[str]) -> bytes:
    return md5(f"{len(tokens)} {' '.join(tokens[:LEADS])}".encode()).digest()


def crowded(docs: DataFrame, text: str) -> DataFrame:
    """leaf_key, half of a leaf's hash, of leaves that hold MIN_DOCS lines: no template of another leaf can recur.

    Two leaves of one key are only kept where neither had to be.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            keys = b"".join(_leaf(tokens)[:8] for t in batch.column("text").to_pylist() for _, tokens in _masked(t))
            found, n = np.unique(np.frombuffer(keys, "<i8"), return_counts=True)
            yield pa.RecordBatch.from_pydict({"leaf_key": pa.array(found, pa.int64()), "n": pa.array(n, pa.int64())})

    sizes = docs.select(F.col(text).alias("text")).mapInArrow(run, "leaf_key long, n long")
    return written(sizes.groupBy("leaf_key").agg(F.sum("n").alias("n")).where(f"n >= {MIN_DOCS}").select("leaf_key"), "crowded")


def parsed(docs: DataFrame, row: str, text: str, min_tokens: int = 1) -> DataFrame:
    """One row for each line with tokens: row, line_no, n_tokens, hashes of the masked line and its leaf, and the line.

    total is the number of tokens in the text's lines of min_tokens tokens or more, leaf_key that of crowded(). body is
    null where the task has put out the same masked line before, so that a line of a third of all rows is one text for
    each task.
    """
    schema = "row binary, line_no int, n_tokens int, total long, masked binary, leaf binary, leaf_key long, body string"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in sliced(batches, "text"):
            rows, numbers, counts, totals, masked, leaves, bodies = [], [], [], [], [], [], []
            if len(seen) > REMEMBERED:
                seen.clear()
            for key, t in zip(batch.column("row").to_pylist(), batch.column("text").to_pylist()):
                total, before = 0, len(rows)
                for i, tokens in _masked(t):
                    n = len(tokens)
                    total += n if n >= min_tokens else 0
                    body = " ".join(tokens)
                    name = md5(body.encode()).digest()
                    rows.append(key)
                    numbers.append(i)
                    counts.append(n)
                    masked.append(name)
                    leaves.append(_leaf(tokens))
                    bodies.append(None if name in seen else body)
                    seen.add(name)
                totals += [total] * (len(rows) - before)
            keys = np.frombuffer(b"".join(x[:8] for x in leaves), "<i8")
            yield pa.RecordBatch.from_pydict(
                {"row": pa.array(rows, pa.binary()), "line_no": pa.array(numbers, pa.int32()), "n_tokens": pa.array(counts, pa.int32()), "total": pa.array(totals, pa.int64()), "masked": pa.array(masked, pa.binary()), "leaf": pa.array(leaves, pa.binary()), "leaf_key": pa.array(keys, pa.int64()), "body": pa.array(bodies, pa.string())}
            )

    return docs.select(F.col(row).alias("row"), F.col(text).alias("text")).mapInArrow(run, schema)


def generalised(lines: DataFrame) -> DataFrame:
    """masked and template of each line whose template has variable fields beyond those with digits.

    Leaves and forms get numbers, as every token of a form carries them. Tokens are shuffled once, to be
    counted; those that aren't constant name their forms themselves.
    """
    forms = written(lines.select("leaf", "masked", "row").distinct().groupBy("leaf", "masked").agg(F.count(F.lit(1)).alias("docs")), "forms")
    leaves = forms.groupBy("leaf").agg(F.count(F.lit(1)).alias("n"), F.sum("docs").alias("d")).where(f"n > 1 AND d >= {MIN_DOCS}")
    leaves = written(leaves.select("leaf", F.monotonically_increasing_id().alias("leaf_no")), "leaves")
    wanted = written(sized_join(forms, leaves, "leaf", "inner").withColumn("form", F.monotonically_increasing_id()), "wanted")
    texts = sized_join(lines.where("body IS NOT NULL").select("masked", "body"), wanted.drop("leaf"), "masked", "inner")
    bodies = written(texts.groupBy("form").agg(*(F.first(c).alias(c) for c in ("masked", "leaf_no", "docs", "body"))), "bodies")
    # The first LEADS tokens are the leaf's, and so are constant.
    tokens = bodies.select("leaf_no", "docs", "form", F.posexplode(F.split("body", " ")).alias("place", "token")).where(F.col("place") >= LEADS)
    # A token that fewer than MIN_DOCS = 3 documents have at its place is one of two forms at most, the least and the greatest.
    counts = tokens.groupBy("leaf_no", "place", "token").agg(F.sum("docs").alias("n"), F.array_distinct(F.array(F.min("form"), F.max("form"))).alias("forms"))
    rare = counts.where(f"n < {MIN_DOCS}").select(F.explode("forms").alias("form"), "place")
    # The fields of one line meet in one row.
    fields = written(rare.groupBy("form").agg(F.collect_list("place").alias("fields")), "fields")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for x in batches for b in sliced([x], "body")):
            masked, templates = [], []
            for name, leaf, body, places in zip(*(batch.column(c).to_pylist() for c in ("masked", "leaf_no", "body", "fields"))):
                line = body.split(" ")
                if 100 * (len(line) - len(places)) >= LEAST_CONSTANT * len(line):
                    for i in places:
                        line[i] = FIELD
                    masked.append(name)
                    templates.append(md5(f"{leaf}/{' '.join(line)}".encode()).digest())
            yield pa.RecordBatch.from_pydict({"masked": pa.array(masked, pa.binary()), "template": pa.array(templates, pa.binary())})

    return sized_join(bodies.select("form", "masked", "leaf_no", "body"), fields, "form", "inner").mapInArrow(run, "masked binary, template binary")


def recurring_templates(named: DataFrame) -> DataFrame:
    """template of each that MIN_DOCS documents hold, of rows of template and row."""
    held = named.select("template", "row").distinct().groupBy("template").agg(F.count(F.lit(1)).alias("docs"))
    return written(held.where(f"docs >= {MIN_DOCS}").select("template"), "recurring")


def copies(keyed: DataFrame, row: str, text: str, again: DataFrame) -> DataFrame:
    """row and label of each document that may be a copy: those of one group of copies have one label.

    again: row, line_no, n_tokens and the document's total of each line whose template recurs, once for each row of keyed.
    """
    own = F.aggregate(F.collect_set(F.struct("line_no", "n_tokens")), F.lit(0).cast("long"), lambda s, x: s + x["n_tokens"])
    shares = again.groupBy("row").agg(own.alias("gone"), F.first("total").alias("total"))
    heavy = written(shares.where(f"100 * gone >= {COPY_PERCENT} * total").select("row"), "heavy")
    texts = id_filter(keyed.select(F.col(row).alias("row"), F.col(text).alias("text")), heavy, "row", "left_semi")
    texts = written(texts.groupBy("row").agg(F.first("text").alias("text")).withColumn("doc_id", F.monotonically_increasing_id()), "heavy-texts")
    groups = near_duplicates(texts, percent=COPY_PERCENT, rows=COPY_ROWS, blocks=False).select("doc_id", "component_id")
    return texts.select("row", "doc_id").join(groups, "doc_id").select("row", F.concat(F.lit("copies of "), F.col("component_id").cast("string")).cast("binary").alias("label"))


def deduplicated(docs: DataFrame, min_tokens: int = 1, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """docs with its own columns, where text has lost its recurring lines, and two more: n_lines and n_dropped.

    Lines of fewer than min_tokens tokens never count; by default every line with a token does. The names of the two
    columns get underscores in front if docs has them already. A null text stays null with no lines, an empty one stays
    empty. Rows that agree in doc_id and text count once and are all returned; rows without doc_id are taken apart by
    their texts. Very long lines and texts are parsed like others. Of tokens that are equally common at a place none is
    preferred: each that is common enough is constant there. An empty table gives no rows.
    """
    key, drops, n_lines, n_dropped = fresh(docs, "row_key", "drops", "n_lines", "n_dropped")
    keyed = docs.withColumn(key, row_key(doc_id, text))
    lines = sized_join(parsed(keyed, key, text, min_tokens), crowded(docs, text), "leaf_key", "left_semi")
    lines = written(lines.drop("leaf_key"), "lines")
    general = written(generalised(lines), "templates")
    named = sized_join(lines.drop("leaf", "body"), general, "masked", "left")
    counted = written(named.where(F.col("n_tokens") >= min_tokens).select("row", "line_no", "n_tokens", "total", F.coalesce("template", "masked").alias("template")), "named")
    again = written(sized_join(counted, recurring_templates(counted), "template", "left_semi"), "again")
    labels = written(copies(keyed, key, text, again), "labels")
    # What counts less often when copies count once is among what recurs.
    final = recurring_templates(sized_join(again.select("template", "row"), labels, "row", "left").select("template", F.coalesce("label", "row").alias("row")))
    # One row gathers the line numbers of one document.
    lists = sized_join(again, final, "template", "left_semi").groupBy(F.col("row").alias(key)).agg(F.collect_set("line_no").alias(drops))
    joined = sized_join(keyed, written(lists, "drops"), key, "left")
    split = F.split(F.col(text), "\n", -1)
    kept = F.when(F.col(drops).isNull(), F.col(text)).otherwise(F.array_join(F.filter(split, lambda _, i: ~F.array_contains(drops, i)), "\n"))
    count = F.when(F.col(text).isNull() | (F.col(text) == ""), F.lit(0)).otherwise(F.length(F.col(text)) - F.length(F.replace(F.col(text), F.lit("\n"), F.lit(""))) + 1)
    return joined.select(*(kept.alias(c) if c == text else F.col(c) for c in docs.columns), count.cast("long").alias(n_lines), F.when(F.col(drops).isNull(), F.lit(0)).otherwise(F.size(drops)).cast("long").alias(n_dropped))
