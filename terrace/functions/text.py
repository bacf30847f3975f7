"""Text helpers as Column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACES = r"(?U)\s+"


def collapsed(text: Column) -> Column:
    """Runs of Unicode white space become one space, none at the ends; null becomes an empty text."""
    return F.trim(F.regexp_replace(F.coalesce(text, F.lit("")), SPACES, " "))


def stripped(text: Column) -> Column:
    """Text without Unicode white space at its ends; null becomes an empty text."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"(?U)^\s+|\s+$", "")


def limited(text: Column, most: int) -> Column:
    """The collapsed text cut to most characters, without a space at its end."""
    return F.rtrim(F.substring(collapsed(text), 1, most))


def blank(text: Column) -> Column:
    return collapsed(text) == ""


def first_filled(*columns: Column) -> Column:
    """The first value that isn't blank, else an empty text."""
    return F.coalesce(*(F.when(~blank(c), c) for c in columns), F.lit(""))


def strict_key(name: Column) -> Column:
    """Lower case, letters and digits only."""
    return F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), "[^a-z0-9]+", "")


def loose_key(name: Column, generic: list[str]) -> Column:
    """The strict key without the generic words at the end of the name; those within it stay."""
    return strict_key(F.regexp_replace(F.lower(F.coalesce(name, F.lit(""))), rf"(?:(?<![a-z0-9])(?:{'|'.join(generic)})(?![a-z0-9])[^a-z0-9]*)+$", " "))


def symbol_key(symbol: Column) -> Column:
    return F.upper(F.trim(F.coalesce(symbol, F.lit(""))))


def chosen_name(left: Column, right: Column, generic: list[str]) -> Column:
    """The name to show of a pair, null for a side without a record.

    Of equal names the shorter, then the lower; of names of which one holds the other the shorter; else the right one.
    """
    a, b = (F.regexp_replace(c, r"(?U)^\s+|\s+$", "") for c in (left, right))
    x, y = strict_key(a), strict_key(b)
    equal = (x == y) | (loose_key(a, generic) == loose_key(b, generic))
    least = F.when(F.struct(F.length(b), F.lower(b)) < F.struct(F.length(a), F.lower(a)), b).otherwise(a)
    holds = (x != "") & (y != "") & F.when(F.length(y) < F.length(x), F.contains(x, y)).otherwise(F.contains(y, x))
    shorter = F.when(F.length(b) < F.length(a), b).otherwise(a)
    return F.when(right.isNull(), left).when(left.isNull(), right).when(equal, least).when(holds, shorter).otherwise(right)


def chosen_filled(left: Column, right: Column) -> Column:
    """The symbol or id of a pair: the right side's unless it is null or empty."""
    return F.coalesce(F.nullif(right, F.lit("")), left, right)


def url_host(url: Column) -> Column:
    """The authority as written, port and user included; without one, the path up to its first slash."""
    whole = F.trim(F.coalesce(url, F.lit("")))
    host = F.regexp_extract(whole, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)", 1)
    path = F.regexp_extract(whole, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?/*([^/?#]*)", 1)
    return F.lower(F.when(host != "", host).otherwise(path))


def bare_host(url: Column) -> Column:
    """The host without user, port and a leading www."""
    return F.regexp_replace(F.regexp_replace(F.regexp_replace(url_host(url), r"^.*@", ""), r":[0-9]*$", ""), r"^www\.", "")


def domain(url: Column, explicit: Column | None = None) -> Column:
    """The explicit domain in lower case, else the URL's authority without a leading www.; port and user stay."""
    host = F.regexp_replace(url_host(collapsed(url)), r"^www\.", "")
    return host if explicit is None else F.when(~blank(explicit), F.lower(collapsed(explicit))).otherwise(host)


def url_slug(url: Column) -> Column:
    """The last path segment that isn't empty."""
    path = F.regexp_replace(F.regexp_replace(F.coalesce(url, F.lit("")), r"[?#].*$", ""), r"^[A-Za-z][A-Za-z0-9+.-]*://[^/]*", "")
    return F.regexp_extract(path, r"([^/]+)/*$", 1)


def labelled(pairs: dict[str, Column], joint: str = " | ") -> Column:
    """'Label: value' of the values that aren't blank, in order."""
    return F.concat_ws(joint, *(F.when(~blank(v), F.concat(F.lit(f"{k}: "), collapsed(v))) for k, v in pairs.items()))


def canonical_reasons(reasons: Column, alias: dict[str, str], default: str) -> Column:
    """A pipe list of reasons as an array: trimmed, aliases replaced, repeats dropped, default if none is left."""
    known = F.create_map(*(F.lit(x) for kv in alias.items() for x in kv)) if alias else F.create_map().cast("map<string,string>")
    parts = F.filter(F.transform(F.split(F.coalesce(reasons, F.lit("")), r"\|"), lambda x: F.trim(x)), lambda x: x != "")
    mapped = F.array_distinct(F.transform(parts, lambda x: F.coalesce(F.try_element_at(known, x), x)))
    return F.when(F.size(mapped) > 0, mapped).otherwise(F.array(F.lit(default)))


def flags(columns: dict[str, Column], joint: str = "|") -> Column:
    """Names of the columns that say 1, true or yes, in order."""
    return F.concat_ws(joint, *(F.when(F.lower(F.trim(c.cast("string"))).isin("1", "true", "yes"), F.lit(k)) for k, c in columns.items()))


def slug_url(base: str, slug: Column) -> Column:
    """base and the slug, an empty text without one."""
    return F.when(~blank(slug), F.concat(F.lit(base), F.trim(slug))).otherwise("")


def name_and_symbol(label: Column) -> Column:
    """A struct of name and symbol: the last word in capitals, digits, dots and dashes is the symbol; empty ones without it."""
    pattern = r"^\s*(.+?)\s+([A-Z0-9.\-]+)\s*$"
    return F.struct(F.regexp_extract(label, pattern, 1).alias("name"), F.regexp_extract(label, pattern, 2).alias("symbol"))


def identifier_words(name: Column) -> Column:
    """Words of an identifier: split at underscores, before a capital behind small letters, and before a run's last capital."""
    spaced = F.regexp_replace(F.regexp_replace(F.regexp_replace(name, "_", " "), "([A-Z]+)([A-Z][a-z])", "$1 $2"), "([a-z0-9])([A-Z])", "$1 $2")
    return F.filter(F.split(spaced, r"\s+"), lambda x: x != "")


def table_sample(value: Column, most: int = 120) -> Column:
    """A value for a table cell: collapsed, pipes escaped, cut to most characters with dots for the rest."""
    escaped = F.replace(collapsed(value), F.lit("|"), F.lit("\\|"))
    return F.when(F.length(escaped) > most, F.concat(F.substring(escaped, 1, most - 4), F.lit(" ..."))).otherwise(escaped)


def number_in(name: Column, pattern: str, default: int = 0) -> Column:
    """The number in a name, such as that of a batch file or an attempt folder."""
    return F.coalesce(F.regexp_extract(name, pattern, 1).try_cast("int"), F.lit(default))


def log_tag(line: Column) -> Column:
    """What the first square brackets of a log line hold; empty without any."""
    return stripped(F.regexp_extract(line, r"^[^\[]*\[([^\]]*)\]", 1))


def log_time(line: Column) -> Column:
    """The ISO time that is the first word of a log line, with or without fraction and zone, null without one.

    Times without a zone are in the session's.
    """
    word = F.substring_index(F.ltrim(line), " ", 1)
    return F.when(F.regexp_like(word, F.lit(r"^[0-9]{4}-[0-9]{2}-[0-9]{2}(?:T[0-9]{2}:[0-9]{2}(?::[0-9]{2}(?:\.[0-9]{1,9})?)?(?:Z|[+-][0-9]{2}:?[0-9]{2})?)?$")), word.try_cast("timestamp"))


def error_source(error: Column) -> Column:
    """The path or the <label> that an error begins with, also behind identity_drift; null for others."""
    drift = "identity_drift: "
    head = lambda text: F.nullif(F.trim(F.substring_index(text, ":", 1)), F.lit(""))
    return (
        F.when(F.startswith(error, F.lit("<post-verifier-output>")), "<post-verifier-output>")
        .when(F.startswith(error, F.lit(drift)), head(F.substr(error, F.lit(len(drift) + 1))))
        .when(F.regexp_like(error, F.lit("^[/<]")), head(error))
    )


def error_task(error: Column) -> Column:
    return F.regexp_extract(error, r"task_index=(\d+)", 1).try_cast("int")


# Texts that mark an error of a row's schema.
SCHEMA_ERRORS = (
    "is not a valid JSON list",
    "status must be",
    "needs_manual_review must be",
    "confidence must be",
    "skip_candidate cannot have",
    "contains non-http values",
    "contains invalid labels",
    "has invalid",
    "must be yes or no",
    "must be high, medium, or low",
    "does not match classifier_results.csv",
)


def error_category(error: Column) -> Column:
    """header_mismatch, row_count_mismatch, row_order_mismatch or schema_error, tried in that order; null for others."""
    has = lambda *parts: reduce(lambda x, y: x & y, (F.contains(error, F.lit(p)) for p in parts))
    schema = reduce(lambda x, y: x | y, (has(m) for m in SCHEMA_ERRORS))
    return (
        F.when(has("header mismatch"), "header_mismatch")
        .when(has("expected ", " rows, found "), "row_count_mismatch")
        .when(has(": row ", "expected task_index="), "row_order_mismatch")
        .when(has("task_index=") & schema, "schema_error")
    )
