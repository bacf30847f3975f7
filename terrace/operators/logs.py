"""Rollups of logs: lines with a tag in brackets, and lines of JSON of differing shapes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.functions.text import log_tag, log_time, stripped
from terrace.operators.ordering import top_in_group

# Beginnings of tags that count, and lines that count without a tag.
NOTABLE = ("worker:", "split_batch:", "tail_retry:", "long_tail:", "retry_cap:", "collect:", "queue_supervisor:", "supervisor:")
UNTAGGED = {"runtime_action_summary_line": "Runtime actions:", "runtime_watch_detected_actions": "Round runtime watch detected actions."}


def _last(rows: DataFrame, by: str, place: str, value: str, most: int, name: str) -> DataFrame:
    """For each log the last values in their order; only so many of a log leave a task."""
    last = top_in_group(rows, [by], [F.desc(place)], most, "_nth").groupBy(by).agg(F.sort_array(F.collect_list(F.struct(F.col(place).alias("p"), F.col(value).alias("v")))).alias("x"))
    return last.select(by, F.transform("x", lambda x: x["v"]).alias(name))


def event_rollup(lines: DataFrame, log: str, place: str, line: str, most: int = 12) -> DataFrame:
    """For each log: last_event_at, last_event_line, event_counts (JSON, keys in order) and recent_notable_events.

    Lines are known by their log and place. The last event is the first line of the latest time that a line begins with.
    Tags that begin as NOTABLE say count and are notable; so do command:stderr and, where the return code isn't 0,
    command:end, which counts in any case; ends that aren't 0 count again. Lines of actions and of UNTAGGED count by their
    text. Empty lines don't count.
    """
    text, tag = F.col(line), F.col("_tag")
    rows = lines.where(F.coalesce(text, F.lit("")) != "").withColumns({"_tag": log_tag(text), "_at": log_time(text)})
    allowed = F.exists(F.array(*map(F.lit, NOTABLE)), lambda p: F.startswith(tag, p))
    failed = (tag == "command:end") & ~F.contains(text, F.lit("returncode=0"))
    untagged: Column = F.when(F.startswith(stripped(text), F.lit("- batch_")), "runtime_action_batch_line")
    for name, part in UNTAGGED.items():
        untagged = untagged.when(F.contains(text, F.lit(part)), name)
    rows = rows.withColumn("_untagged", untagged)
    counted = F.array_compact(F.array(F.when(allowed | tag.isin("command:end", "command:stderr"), tag), F.when(failed, "command:end_nonzero"), F.col("_untagged")))
    # A line that is notable twice stands twice.
    times = (allowed | failed | (tag == "command:stderr")).cast("int") + F.col("_untagged").isNotNull().cast("int")
    counts = rows.select(log, F.explode(counted).alias("k")).groupBy(log, "k").agg(F.count(F.lit(1)).alias("n"))
    maps = counts.groupBy(log).agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "n"))))).alias("event_counts"))
    notable = rows.where(times > 0).select(log, F.explode(F.sequence(F.lit(1), times)).alias("_i"), F.col(place).alias("_p"), text.alias("_line")).withColumn("_spot", F.struct("_p", "_i"))
    latest = rows.groupBy(log).agg(F.max("_at").alias("last_event_at"), F.max_by(line, F.when(F.col("_at").isNotNull(), F.struct(F.col("_at"), -F.col(place)))).alias("last_event_line"))
    joined = latest.join(maps, log, "left").join(_last(notable, log, "_spot", "_line", most, "recent_notable_events"), log, "left")
    return joined.withColumns({"event_counts": F.coalesce("event_counts", F.lit("{}")), "recent_notable_events": F.coalesce("recent_notable_events", F.array().cast("array<string>"))})


def worker_rollup(lines: DataFrame, log: str, place: str, line: str, tail: int = 400, queries: int = 5) -> DataFrame:
    """For each log, of its last lines: JSON objects and others, events by type and by item and type, recent queries and the last message.

    Each line is parsed once, whatever its shape. Blank lines are neither. A type that isn't text counts by its text. Only
    finished items count for queries (web_search) and messages (agent_message).
    """
    last = top_in_group(lines, [log], [F.desc(place)], tail, "_nth").where(stripped(F.col(line)) != "")
    # The engine's parser stops behind a value; within a list nothing can follow it.
    framed = F.concat(F.lit("["), F.col(line), F.lit("]"))
    parsed = last.select(log, place, F.when(F.try_parse_json(framed).isNotNull() & (F.json_array_length(framed) == 1), F.try_parse_json(line)).alias("v"))
    is_object = lambda v: F.coalesce(F.startswith(F.schema_of_variant(v), F.lit("OBJECT")), F.lit(False))
    field = lambda v, path: stripped(F.try_variant_get(v, path, "string"))
    rows = parsed.withColumn("ok", is_object(F.col("v"))).withColumn("item", F.when(F.col("ok"), F.try_variant_get("v", "$.item", "variant")))
    rows = rows.withColumn("whole", is_object(F.col("item"))).select(
        log, place, "ok", F.when(F.col("ok"), field("v", "$.type")).otherwise("").alias("type"), F.when(F.col("whole"), field("item", "$.type")).otherwise("").alias("kind"),
        F.when(F.col("whole"), field("item", "$.query")).otherwise("").alias("query"), F.when(F.col("whole"), field("item", "$.text")).otherwise("").alias("message"),
    )
    names = F.array_compact(F.array(F.when(F.col("type") != "", F.col("type")), F.when((F.col("type") != "") & (F.col("kind") != ""), F.concat_ws(":", "kind", "type"))))
    counts = rows.select(log, F.explode(names).alias("k")).groupBy(log, "k").agg(F.count(F.lit(1)).alias("n")).groupBy(log)
    maps = counts.agg(F.to_json(F.map_from_entries(F.sort_array(F.collect_list(F.struct("k", "n"))))).alias("counts"))
    done = F.col("type") == "item.completed"
    said = F.when(done & (F.col("kind") == "agent_message") & (F.col("message") != ""), F.col(place))
    whole = rows.groupBy(log).agg(F.count_if("ok").alias("json_lines"), F.count_if(~F.col("ok")).alias("other_lines"), F.max_by("message", said).alias("last_agent_message"))
    asked = rows.where(done & (F.col("kind") == "web_search") & (F.col("query") != ""))
    joined = whole.join(maps, log, "left").join(_last(asked, log, place, "query", queries, "recent_search_queries"), log, "left")
    return joined.withColumns({"counts": F.coalesce("counts", F.lit("{}")), "recent_search_queries": F.coalesce("recent_search_queries", F.array().cast("array<string>"))})
