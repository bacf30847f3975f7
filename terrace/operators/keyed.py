"""Rows by whole-number keys: keys that must parse, merges in the order of keys, backfills, and lists of names."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import stripped

WHOLE = "^[+-]?[0-9]+$"


def integer_keys(df: DataFrame, key: str, source: str, blank_goes: bool = False) -> DataFrame:
    """df with key as a number; raises on the first row, blank ones included, whose key isn't a whole one.

    blank_goes: whether rows with a blank key are left out instead.
    """
    text = stripped(F.col(key).cast("string"))
    rows = df.where(text != "") if blank_goes else df
    bad = rows.where(~F.regexp_like(text, F.lit(WHOLE))).select(text.alias("t")).take(1)
    if bad:
        raise ValueError(f"invalid {key} in {source}: {bad[0].t!r}")
    return rows.withColumn(key, text.cast("long"))


def index_set(df: DataFrame, key: str, source: str) -> DataFrame:
    """The distinct keys of rows whose key isn't blank; raises on one that is no whole number."""
    return integer_keys(df, key, source, blank_goes=True).select(key).distinct()


def merged_by_key(existing: DataFrame | None, new: DataFrame, key: str, place: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """Rows of both in the order of their keys, and the keys of new that existing has.

    A key's last row by place counts, those of new before those of existing. existing, where there is one, has to have
    just these columns besides place.
    """
    if existing is not None and [c for c in existing.columns if c != place] != columns:
        raise ValueError(f"existing output has columns {existing.columns}, not {columns}")
    fresh = integer_keys(new.select(place, *columns), key, "new output").withColumn("_new", F.lit(1))
    every = fresh if existing is None else fresh.unionByName(integer_keys(existing.select(place, *columns), key, "existing output").withColumn("_new", F.lit(0)))
    last = every.groupBy(key).agg(F.max_by(F.struct(*(c for c in columns if c != key)), F.struct("_new", place)).alias("_row"), F.min("_new").alias("_from"), F.max("_new").alias("_to"))
    merged = last.select(*(F.col(c) if c == key else F.col(f"_row.{c}") for c in columns)).orderBy(key)
    return merged, last.where("_from < _to").select(key)


def completed_results(rows: DataFrame, key: str, status: str, parsed: str, place: str, fields: list[str], lists: list[str], source: str) -> DataFrame:
    """For each key the fields of its last completed row whose parsed output is a JSON object, as text, lists as pipe lists.

    Rows without a key count for nothing. agent_task_status and agent_result_source come along.
    """
    text = lambda c: F.coalesce(F.get_json_object(parsed, f"$.{c}"), F.lit(""))
    items = lambda c: F.array_join(F.filter(F.transform(F.coalesce(F.from_json(text(c), "array<string>"), F.array(text(c))), stripped), lambda x: x != ""), "|")
    done = rows.where((stripped(F.col(key)) != "") & (F.col(status) == "completed") & F.json_object_keys(parsed).isNotNull())
    made = done.select(F.col(key), F.col(place).alias("_place"), *(items(c).alias(c) if c in lists else text(c).alias(c) for c in fields), F.lit("completed").alias("agent_task_status"), F.lit(source).alias("agent_result_source"))
    return made.groupBy(key).agg(F.max_by(F.struct(*(c for c in made.columns if c not in (key, "_place"))), "_place").alias("_row")).select(key, "_row.*")


def backfilled(rows: DataFrame, results: DataFrame, key: str) -> DataFrame:
    """rows with the columns of results: a row that has a result takes all of its values, others keep theirs.

    Columns that rows lack are added behind the others, empty where there is no result. results has each key once.
    """
    columns = [c for c in results.columns if c != key]
    joined = rows.join(results.select(F.col(key).alias("_key"), F.lit(True).alias("_there"), *(F.col(c).alias(f"_{c}") for c in columns)), stripped(F.col(key)) == F.col("_key"), "left")
    own = lambda c: F.col(c) if c in rows.columns else F.lit("")
    value = lambda c: F.when(F.col("_there"), F.col(f"_{c}")).otherwise(own(c)).alias(c)
    return joined.select(*(value(c) if c in columns else F.col(c) for c in rows.columns), *(value(c) for c in columns if c not in rows.columns))


def listed(rows: DataFrame, place: str, columns: list[str], slug: str) -> DataFrame:
    """place and columns, trimmed, of the rows whose slug isn't blank; places stay as they were, repeated slugs too."""
    return rows.select(place, *(stripped(F.col(c).cast("string")).alias(c) for c in columns)).where(F.col(slug) != "")


def with_defaults(rows: DataFrame, defaults: dict[str, str], counts: Iterable[str] = ()) -> DataFrame:
    """rows with default columns where they are absent or blank; counts become whole numbers, 0 where they are none."""
    filled = {c: F.when(stripped(F.col(c).cast("string")) != "", F.col(c).cast("string")).otherwise(v) if c in rows.columns else F.lit(v) for c, v in defaults.items()}
    whole = rows.withColumns(filled)
    return whole.withColumns({c: F.coalesce(stripped(F.col(c).cast("string")).try_cast("long"), F.lit(0)) for c in counts})


def header_union(*headers: Iterable[str | None]) -> list[str]:
    """Names of several headers, trimmed, each once where it stands first; blank ones go."""
    return list(dict.fromkeys(n.strip() for h in headers for n in h if n and n.strip()))


def repaired_shard_row(df: DataFrame, typos: dict[str, str]) -> DataFrame:
    """Rows of a shard with known typos in the origin mended, entities that are all blank as empty lists, and a level in the review column moved.

    The level moves only where the confidence is blank, and leaves "no" behind. Null is blank.
    """
    names, blank = ("mapped_entity_name", "mapped_entity_legal_name", "mapped_entity_url"), lambda c: stripped(F.col(c)) == ""
    df = df.withColumns({c: F.coalesce(F.col(c), F.lit("")) for c in ("token_origin_type", "mapped_entity_type", "needs_manual_review", "confidence", *names)})
    origin: Column = F.col("token_origin_type")
    for wrong, right in typos.items():
        origin = F.when(F.col("token_origin_type") == wrong, right).otherwise(origin)
    none = blank(names[0]) & blank(names[1]) & blank(names[2])
    level = stripped(F.col("needs_manual_review")).isin("low", "medium", "high") & blank("confidence")
    return df.withColumns(
        {"token_origin_type": origin, **{c: F.when(none, "[]").otherwise(F.col(c)) for c in (*names, "mapped_entity_type")}, "confidence": F.when(level, stripped(F.col("needs_manual_review"))).otherwise(F.col("confidence")), "needs_manual_review": F.when(level, "no").otherwise(F.col("needs_manual_review"))}
    )


def identity_rewritten(rows: DataFrame, tasks: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """rows whose identity fields are those of their tasks; rows without a task stay. tasks has each key once."""
    own = tasks.select(key, F.lit(True).alias("_there"), *(F.coalesce(F.col(f).cast("string"), F.lit("")).alias(f"_{f}") for f in fields))
    joined = rows.join(own, key, "left")
    return joined.select(*(F.when(F.col("_there"), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fields else F.col(c) for c in rows.columns))
