"""Numbers, states and lists in text, as Column expressions; only JSON that the engine refuses is read in Arrow batches."""

from __future__ import annotations

import ast
import json
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StringType

from terrace.functions.text import stripped

NUMERIC = r"^\s*[+-]?(?:[0-9]+\.?[0-9]*|\.[0-9]+)(?:[eE][+-]?[0-9]+)?\s*$"


def optional_int(value: Column, default: int) -> Column:
    return F.coalesce(F.trim(value).try_cast("int"), F.lit(default))


def bucketed(value: Column) -> Column:
    """high, medium and low pass as they are; numbers from 0.8 are high, from 0.5 medium, else low; other text stays.

    HIGH is none of the three and stays, so that a validator sees it. Infinities are numbers, and nan is one that is low.
    """
    text = F.trim(value.cast("string"))
    word = F.lower(F.regexp_replace(text, r"^[+-]", ""))
    infinite = F.when(word.isin("inf", "infinity"), F.when(F.startswith(text, F.lit("-")), "low").otherwise("high")).when(word == "nan", "low")
    number = F.when(F.regexp_like(text, F.lit(NUMERIC)), text.try_cast("double"))
    level = F.when(number >= 0.8, "high").when(number >= 0.5, "medium").when(number.isNotNull(), "low")
    return F.coalesce(level, infinite, text)


def effective_status(rules: list[tuple[Column, str]], otherwise: Column) -> Column:
    """The status of the first rule that holds."""
    out = otherwise
    for holds, status in reversed(rules):
        out = F.when(holds, F.lit(status)).otherwise(out)
    return out


def idle_seconds(now: Column, last: Column) -> Column:
    """Whole seconds from last to now, never below 0."""
    whole = lambda c: F.unix_seconds(c.cast("timestamp"))
    return F.greatest(F.lit(0).cast("long"), whole(now) - whole(last))


def inferred_type(name: Column) -> Column:
    """A documentation type from a column's name."""
    low = F.lower(name)
    return (
        F.when(F.regexp_like(low, F.lit("date|^ts$|_ts$|updated")), "DATE")
        .when(F.regexp_like(low, F.lit("key$|_id$|count|year|number|size$|quantity|turn$")), "INTEGER")
        .when(F.regexp_like(low, F.lit("price|discount|tax|acctbal|value$|amount|score|ratio")), "DECIMAL")
        .otherwise("TEXT")
    )


@lru_cache
def _strict():
    @F.pandas_udf(BooleanType())
    def strict(values: pd.Series) -> pd.Series:
        return values.map(lambda x: _as_list(x, json.loads) is not None)

    return strict


def is_json_list(value: Column) -> Column:
    """Whether a text is a JSON list by the strict rules.

    Text that doesn't begin and end with brackets is none. The engine's parser is asked for the text within an object and
    within a list, so that nothing can follow it; what it refuses (NaN, equal keys) goes to a strict reader in Arrow batches.
    """
    text = F.coalesce(value, F.lit(""))
    framed = F.concat(F.lit("["), text, F.lit("]"))
    maybe = F.regexp_like(text, F.lit(r"^[ \t\n\r]*\[(?s:.*)\][ \t\n\r]*$"))
    sure = F.try_parse_json(F.concat(F.lit('{"a":'), text, F.lit("}"))).isNotNull() & F.try_parse_json(framed).isNotNull() & (F.json_array_length(framed) == 1)
    return F.when(~maybe, False).when(sure, True).otherwise(F.coalesce(_strict()(F.when(maybe & ~sure, text)), F.lit(False)))


def _as_list(text: str | None, read) -> list | None:
    """What read makes of a text, if that is a list."""
    try:
        found = read(text)
    except (ValueError, SyntaxError, TypeError, MemoryError, RecursionError):
        return None
    return list(found) if isinstance(found, (list, tuple)) else None


def json_list(value: Column) -> Column:
    """array<string> of a JSON list in text, an empty one for anything else."""
    return F.when(is_json_list(value), F.coalesce(F.from_json(value, "array<string>"), F.array().cast("array<string>"))).otherwise(F.array().cast("array<string>"))


def list_length(value: Column) -> Column:
    return F.when(is_json_list(value), F.json_array_length(value)).otherwise(F.lit(-1))


def _json_text(items: list) -> str:
    return json.dumps(items, ensure_ascii=False, separators=(",", ":"), default=str)


def _quoted_list(text: str) -> list | None:
    """A JSON list behind damaged quotes: doubled ones, one too many at the end, or a whole list in a JSON text."""
    single = text.replace('""', '"')
    tries = [single, single[:-1] if single.endswith('"') else ""] if single != text else []
    if text.startswith('"') and text.endswith('"'):
        try:
            inner = json.loads(text)
        except ValueError:
            inner = None
        tries.append(inner if isinstance(inner, str) else "")
    return next((found for t in tries if (found := _as_list(t.strip(), json.loads)) is not None), None)


@lru_cache
def _normal():
    readers = (
        lambda t: _as_list(t, json.loads),
        lambda t: _as_list(t, ast.literal_eval),
        lambda t: [] if t.lower() in ("none", "null") else None,
        _quoted_list,
        lambda t: [p.strip() for p in t.split("|") if p.strip()] if "|" in t else None,
        lambda t: [t],
    )

    @F.pandas_udf(StringType())
    def normal(values: pd.Series) -> pd.Series:
        return values.map(lambda t: None if t is None else _json_text(next(found for r in readers if (found := r(t)) is not None)))

    return normal


#: Text that is no literal and no JSON: it begins with a letter and has neither brackets, quotes, commas nor control characters.
BARE = r"""^[A-Za-z][^\[\](){},'"\\\x00-\x1f\x7f-\x9f]*$"""
#: A JSON list of strings without escapes.
STRINGS = r"""^\[ *(?:"[^"\\\x00-\x1f]*+" *(?:, *"[^"\\\x00-\x1f]*+" *)*+)?\]$"""
#: Characters up to which patterns look at lists, as they recurse by item.
PATTERN_CHARS = 4000


def normal_list(value: Column) -> Column:
    """Text that stands for a list as a compact JSON list; a blank text stays empty.

    In this order: a JSON list; a literal of a list or of bare items; none and null, which are empty; a JSON list behind
    damaged quotes; parts between pipes; any other text is a list of itself. Bare words and lists of plain strings, which
    most texts are, stay in the engine; the rest is read in Arrow batches.
    """
    text = stripped(value)
    parts = F.filter(F.transform(F.split(text, r"\|"), stripped), lambda x: x != "")
    words = F.when(F.lower(text).isin("none", "null"), "[]").when(F.contains(text, F.lit("|")), F.to_json(parts)).otherwise(F.to_json(F.array(text)))
    bare, strings = F.regexp_like(text, F.lit(BARE)), (F.length(text) <= PATTERN_CHARS) & F.regexp_like(text, F.lit(STRINGS))
    known = (text == "") | bare | strings
    return F.when(text == "", "").when(bare, words).when(strings, F.to_json(F.from_json(text, "array<string>"))).otherwise(_normal()(F.when(~known, text)))


def split_list(value: Column) -> Column:
    """Items of a pipe list or of a JSON list, trimmed, without empty ones; a broken JSON list is split at pipes too."""
    text = F.trim(F.coalesce(value, F.lit("")))
    items = F.when(is_json_list(text), F.coalesce(F.from_json(text, "array<string>"), F.array().cast("array<string>"))).otherwise(F.split(text, r"\|"))
    return F.filter(F.transform(items, lambda x: F.trim(F.coalesce(x, F.lit("")))), lambda x: x != "")


def piped(items: Column) -> Column:
    return F.array_join(items, "|")


def spaced_json(items: Column) -> Column:
    """A JSON list of texts with a space behind each comma."""
    quoted = F.transform(items, lambda x: F.regexp_replace(F.to_json(F.array(x)), r"^\[|\]$", ""))
    return F.concat(F.lit("["), F.array_join(quoted, ", "), F.lit("]"))


def risk_flags(value: Column) -> Column:
    """A JSON list as it stands; blank and none are []; a pipe list or one flag becomes a spaced JSON list."""
    text = F.trim(F.coalesce(value, F.lit("")))
    parts = F.filter(F.transform(F.split(text, r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    return F.when((text == "") | (F.lower(text) == "none"), "[]").when(is_json_list(text), text).otherwise(spaced_json(parts))


def clean_tags(tags: Column) -> Column:
    """A JSON list of the tags that aren't blank, trimmed."""
    return F.to_json(F.filter(F.transform(F.coalesce(tags, F.array().cast("array<string>")), lambda x: F.trim(x)), lambda x: x != ""))


def object_without(value: Column, required: list[str]) -> Column:
    """What is wrong with a JSON object in text: blank, not_json, not_an_object, or missing and the absent keys; null if nothing is."""
    text = F.trim(F.coalesce(value, F.lit("")))
    keys = F.json_object_keys(text)
    absent = F.array_except(F.array(*map(F.lit, required)), F.coalesce(keys, F.array().cast("array<string>")))
    other = F.try_parse_json(text).isNotNull()
    return F.when(text == "", "blank").when(~other, "not_json").when(~F.startswith(text, F.lit("{")), "not_an_object").when(F.size(absent) > 0, F.concat(F.lit("missing "), F.array_join(absent, ",")))


def incremented(counts: Column, kind: Column) -> Column:
    """A JSON map of counts with kind raised by one, keys in order."""
    have = F.coalesce(F.from_json(counts, "map<string,int>"), F.create_map().cast("map<string,int>"))
    rest = F.map_filter(have, lambda k, _: k != kind)
    new = F.map_concat(rest, F.map_from_arrays(F.array(kind), F.array(F.coalesce(F.try_element_at(have, kind), F.lit(0)) + 1)))
    return F.to_json(F.map_from_entries(F.array_sort(F.map_entries(new))))
