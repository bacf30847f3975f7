"""Keyword search over text columns, rankings of hits, and folds of related values onto entities."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def matched(value: Column, keywords: list[str]) -> Column:
    """The keywords that a text holds, whatever its case, in the order given."""
    low = F.lower(value)
    return F.array_compact(F.array(*(F.when(F.contains(low, F.lit(k.lower())), F.lit(k)) for k in keywords)))


def keyword_hits(df: DataFrame, key: str, columns: list[str], keywords: list[str]) -> DataFrame:
    """row_key, column_name, value and keywords (joined by a pipe) of every value that holds one."""
    long = df.select(F.col(key).cast("string").alias("row_key"), F.explode(F.array(*(F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in columns))).alias("x")).select("row_key", "x.*")
    found = long.withColumn("found", matched(F.col("value"), keywords)).where(F.size("found") > 0)
    return found.select("row_key", "column_name", "value", F.array_join("found", "|").alias("keywords"))


def ranked_hits(hits: dict[str, DataFrame]) -> DataFrame:
    """Hits by file, by column, and by both: level says which."""
    every = reduce(DataFrame.unionByName, (h.select(F.lit(f).alias("file"), "column_name") for f, h in hits.items()))
    both = every.groupBy("file", "column_name").agg(F.count(F.lit(1)).alias("repeat_count"))
    one = lambda level, *by: both.groupBy(*by).agg(F.sum("repeat_count").alias("repeat_count")).select(F.lit(level).alias("level"), *(F.col(c) if c in by else F.lit("").alias(c) for c in ("file", "column_name")), "repeat_count")
    return one("file", "file").unionByName(one("column", "column_name")).unionByName(one("file_column", "file", "column_name"))


def clean_keywords(keywords: list[str]) -> list[str]:
    """Keywords in lower case, trimmed, each once, in their order; blank ones go."""
    return list(dict.fromkeys(k for k in (x.strip().lower() for x in keywords) if k))


def filtered(df: DataFrame, columns: list[str], keywords: list[str]) -> DataFrame:
    """Rows with a keyword in any of columns, with matched_keywords and matched_columns joined by pipes.

    Keywords come in the order in which they are first met, column by column. Each column is searched once.
    """
    found = [f"_found_{i}" for i in range(len(columns))]
    searched = df.withColumns({f: matched(F.col(c), keywords) for f, c in zip(found, columns)})
    words = F.array_join(F.array_distinct(F.concat(*map(F.col, found))), "|")
    names = F.concat_ws("|", *(F.when(F.size(f) > 0, F.lit(c)) for c, f in zip(columns, found)))
    return searched.withColumns({"matched_keywords": words, "matched_columns": names}).where("matched_keywords <> ''").drop(*found)


def folded(relation: DataFrame, key: str, value: str, order: str, name: str, joint: str = " | ") -> DataFrame:
    """For each key its distinct values in the order of their first appearance, joined by joint.

    Repeats are counted away before anything is gathered.
    """
    first = relation.where(F.col(key).isNotNull() & (F.trim(F.col(value)) != "")).groupBy(key, value).agg(F.min(order).alias("_at"))
    return first.groupBy(key).agg(F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("_at", value))), lambda x: x[value]), joint).alias(name))


def enriched(entities: DataFrame, key: str, folds: list[DataFrame]) -> DataFrame:
    """entities with every folded column, empty where an entity has none."""
    for fold in folds:
        name = next(c for c in fold.columns if c != key)
        entities = entities.join(fold, key, "left").withColumn(name, F.coalesce(name, F.lit("")))
    return entities
