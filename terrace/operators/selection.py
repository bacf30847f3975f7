"""Which rows and columns take part, and in what order."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import blank
from terrace.operators.ordering import numbered


def first_id(df: DataFrame, ending: str = "ID") -> Column:
    """A struct of column and value: the first column in order whose name has that ending and whose value isn't blank."""
    named = [c for c in df.columns if c.endswith(ending)]
    value = lambda c: F.col(c).cast("string")
    found = F.coalesce(*(F.when(~blank(value(c)), F.struct(F.lit(c).alias("column"), F.trim(value(c)).alias("value"))) for c in named), F.lit(None).cast("struct<column:string,value:string>"))
    return F.coalesce(found, F.struct(F.lit("").alias("column"), F.lit("").alias("value")))


def projected(df: DataFrame, columns: list[str]) -> DataFrame:
    """The columns in that order as text, empty for null and for those that df lacks."""
    return df.select(*((F.coalesce(F.col(c).cast("string"), F.lit("")) if c in df.columns else F.lit("")).alias(c) for c in columns))


def listed_ids(values: list[str], lower: bool = False) -> list[str]:
    """Ids of repeated and comma-separated arguments, trimmed, each once in order."""
    flat = (x.strip() for v in values for x in v.split(","))
    return list(dict.fromkeys(x.lower() if lower else x for x in flat if x))


def members(df: DataFrame, key: str, values: list[str], lower: bool = False) -> DataFrame:
    """Rows whose key is listed; all rows if nothing is."""
    ids = listed_ids(values, lower)
    own = F.trim(F.col(key).cast("string"))
    return df.where((F.lower(own) if lower else own).isin(ids)) if ids else df


def without(df: DataFrame, key: str, excluded: list[str]) -> DataFrame:
    """Rows whose key isn't on the list; null keys stay."""
    return df.where(F.coalesce(~F.col(key).isin(excluded), F.lit(True)))


def unresolved(*columns: Column) -> Column:
    """Whether all are blank."""
    return reduce(lambda x, y: x & y, map(blank, columns))


def scoped(df: DataFrame, path: str, requested: DataFrame, value: str, order: str) -> DataFrame:
    """Rows that a request names by whole path or by base name, each once, with scope_order in order of request.

    Raises if a request names no row.
    """
    base = F.element_at(F.split(F.col(path), "/"), -1)
    wanted = requested.groupBy(F.trim(value).alias("_value")).agg(F.min(order).alias("_at")).where("_value <> ''")
    names = df.select(F.col(path).alias("_path"), F.explode(F.array_distinct(F.array(F.col(path), base))).alias("_value"))
    unknown = wanted.join(names, "_value", "left_anti").take(5)
    if unknown:
        raise ValueError(f"not in scope: {[r['_value'] for r in unknown]}")
    hits = names.join(wanted, "_value").groupBy("_path").agg(F.min("_at").alias("scope_order"))
    return df.join(hits, F.col(path) == F.col("_path")).drop("_path")


def marked(marker: str, *columns: Column) -> Column:
    """Whether a marker stands in any of the columns."""
    return reduce(lambda x, y: x | y, (F.contains(F.coalesce(c, F.lit("")), F.lit(marker)) for c in columns))


def every_marker(markers: list[str], *columns: Column) -> Column:
    """Whether one of the columns holds all markers."""
    one = lambda c: reduce(lambda x, y: x & y, (F.contains(F.coalesce(c, F.lit("")), F.lit(m)) for m in markers))
    return reduce(lambda x, y: x | y, map(one, columns))


def window(df: DataFrame, order: list, offset: int = 0, limit: int = 0) -> DataFrame:
    """Rows behind the first offset ones in order, at most limit of them; 0 is no limit.

    Without a limit rows are numbered by ranges, so that no task takes all of them; order then has to be names of columns
    that tell rows apart.
    """
    if limit:
        return df.orderBy(*order).offset(offset).limit(limit)
    return numbered(df, order, "_place").where(F.col("_place") > offset).drop("_place").orderBy(*order) if offset else df.orderBy(*order)


def rank_order(rank: Column, slug: Column, place: Column) -> list[Column]:
    """Numbers first, in their order, then other ranks; ties by lower-cased slug and place."""
    number = F.when(F.regexp_like(rank, F.lit("^[0-9]+$")), rank.try_cast("long"))
    return [number.asc_nulls_last(), F.lower(slug).asc(), place.asc()]


def queue_place(order: Column, number: Column) -> Column:
    """A row's place in the queue: its own order, else its batch number, else behind all."""
    positive = lambda c: F.when(c > 0, c)
    return F.coalesce(positive(order), positive(number), F.lit(1_000_000_000))
