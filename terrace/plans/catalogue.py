"""All queries over the driver's tables with the SQL that states the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.functions import html, text, values
from terrace.operators import batching, catalog, match, merge, ordering, progress, quality, search
from terrace.sources.files import table
from terrace.streaming.progress import counted, replayed
from terrace.streaming.timeouts import replayed_silences

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

KEYWORDS = ["widget", "promo", "cold"]
NOUNS = ["widget", "bolt", "gear", "ring", "gizmo", "plate"]
TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def query(sql: str | None = None):
    """Registers a function of a reader of tables under its name, with the SQL that states its rows."""

    def add(f):
        QUERIES[f.__name__] = lambda spark, sf_dir: f(lambda name: table(spark, sf_dir, name))
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def _hits_sql(keywords: list[str]) -> str:
    k = "[" + ", ".join(f"'{x}'" for x in keywords) + "]"
    return f"array_to_string([x FOR x IN {k} IF contains(lower(value), x)], '|')"


@query(f"""SELECT * FROM (SELECT p_partkey::VARCHAR AS row_key, column_name, value, {_hits_sql(KEYWORDS)} AS keywords
FROM (UNPIVOT (SELECT p_partkey, p_name, p_brand, p_type FROM part) ON p_name, p_brand, p_type INTO NAME column_name VALUE value)) WHERE keywords <> ''""")
def keyword_hits(read):
    return search.keyword_hits(read("part"), "p_partkey", ["p_name", "p_brand", "p_type"], KEYWORDS)


RANKED = {"part": ("p_partkey", ["p_name", "p_brand", "p_type"]), "customer": ("c_custkey", ["c_name", "c_mktsegment"]), "events": ("event_id", ["event_type", "props"])}
RANK_WORDS = ["widget", "promo", "build", "click", "cold", "7"]
_RANK_SQL = "WITH hits AS (" + " UNION ALL ".join(f"SELECT '{t}' AS file, '{c}' AS column_name FROM {t} WHERE len([x FOR x IN {RANK_WORDS} IF contains(lower({c}), x)]) > 0" for t, (_, cs) in RANKED.items() for c in cs) + ") "


def _ranked(read):
    return search.ranked_hits({t: search.keyword_hits(read(t), key, columns, RANK_WORDS) for t, (key, columns) in RANKED.items()})


@query(_RANK_SQL + "SELECT column_name, count(*) AS repeat_count FROM hits GROUP BY 1")
def hits_by_column(read):
    return _ranked(read).where("level = 'column'").select("column_name", "repeat_count")


@query(_RANK_SQL + "SELECT file, column_name, count(*) AS repeat_count FROM hits GROUP BY 1, 2")
def hits_by_file_column(read):
    return _ranked(read).where("level = 'file_column'").select("file", "column_name", "repeat_count")


@query(_RANK_SQL + "SELECT file, count(*) AS repeat_count FROM hits GROUP BY 1")
def hits_by_file(read):
    return _ranked(read).where("level = 'file'").select("file", "repeat_count")


DOC_WORDS = ["src1", "license", "the", "es"]


@query("""WITH m AS (SELECT doc_id, [x FOR x IN ['src1','license','the','es'] IF contains(lower(coalesce(source,'')), x)] AS a,
 [x FOR x IN ['src1','license','the','es'] IF contains(lower(coalesce(lang,'')), x)] AS b, [x FOR x IN ['src1','license','the','es'] IF contains(lower(coalesce(text,'')), x)] AS c FROM documents)
SELECT doc_id, array_to_string(a || [x FOR x IN b IF NOT list_contains(a, x)] || [x FOR x IN c IF NOT list_contains(a, x) AND NOT list_contains(b, x)], '|') AS matched_keywords,
 concat_ws('|', CASE WHEN len(a) > 0 THEN 'source' END, CASE WHEN len(b) > 0 THEN 'lang' END, CASE WHEN len(c) > 0 THEN 'text' END) AS matched_columns
FROM m WHERE len(a) + len(b) + len(c) > 0""")
def keyword_filter_rows(read):
    return search.filtered(read("documents"), ["source", "lang", "text"], DOC_WORDS).select("doc_id", "matched_keywords", "matched_columns")


@query("""SELECT l_orderkey, l_linenumber, count(*) AS n_rows, CASE WHEN l_orderkey IS NOT NULL THEN 'l_orderkey' WHEN l_partkey IS NOT NULL THEN 'l_partkey' ELSE '' END AS id_column,
 coalesce(l_orderkey, l_partkey)::VARCHAR AS id_value FROM lineitem GROUP BY ALL""")
def first_id_column(read):
    named = F.when(F.col("l_orderkey").isNotNull(), "l_orderkey").when(F.col("l_partkey").isNotNull(), "l_partkey").otherwise("")
    rows = read("lineitem").select("l_orderkey", "l_linenumber", named.alias("id_column"), text.first_filled(F.col("l_orderkey").cast("string"), F.col("l_partkey").cast("string")).alias("id_value"))
    return rows.groupBy(*rows.columns).agg(F.count(F.lit(1)).alias("n_rows"))


_FOLD_SQL = """SELECT o_custkey AS c_custkey, string_agg(o_orderpriority, ' | ' ORDER BY k) AS priorities
FROM (SELECT o_custkey, o_orderpriority, min(o_orderkey) AS k FROM orders WHERE o_orderstatus = 'P' GROUP BY 1, 2) GROUP BY 1"""


def _fold(read):
    pending = read("orders").where("o_orderstatus = 'P'").withColumnRenamed("o_custkey", "c_custkey")
    return search.folded(pending, "c_custkey", "o_orderpriority", "o_orderkey", "priorities")


@query(f"SELECT c_custkey, c_name, coalesce(priorities, '') AS priorities FROM customer LEFT JOIN ({_FOLD_SQL}) USING (c_custkey)")
def ordered_distinct_fold(read):
    return search.enriched(read("customer").select("c_custkey", "c_name"), "c_custkey", [_fold(read)]).select("c_custkey", "c_name", "priorities")


@query("SELECT count(DISTINCT o_custkey) AS n_entities, count(*) AS n_rows FROM orders WHERE o_orderstatus = 'P'")
def impacted_entities(read):
    return read("orders").where("o_orderstatus = 'P'").agg(F.countDistinct("o_custkey").alias("n_entities"), F.count(F.lit(1)).alias("n_rows"))


_HOST_SQL = r"lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)', 1))"
_SLUG_SQL = r"regexp_extract(regexp_replace(regexp_replace(url, '[?#].*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/]*', ''), '([^/]+)/*$', 1)"


@query(f"SELECT page_id, {_HOST_SQL} AS host, regexp_replace({_HOST_SQL}, '^www\\.', '') AS bare_host, CASE WHEN page_id % 5 = 0 THEN 'own.org' ELSE regexp_replace({_HOST_SQL}, '^www\\.', '') END AS domain FROM pages")
def page_host(read):
    own = F.when(F.col("page_id") % 5 == 0, " Own.ORG ").otherwise("")
    return read("pages").select("page_id", text.url_host(F.col("url")).alias("host"), text.bare_host(F.col("url")).alias("bare_host"), text.domain(F.col("url"), own).alias("domain"))


@query(f"SELECT page_id, {_SLUG_SQL} AS slug FROM pages")
def page_slug(read):
    return read("pages").select("page_id", text.url_slug(F.col("url")).alias("slug"))


@query(f"SELECT {_SLUG_SQL} AS slug, min(page_id) AS page_id, arg_min(url, page_id) AS url FROM pages GROUP BY 1")
def slug_first_wins(read):
    return read("pages").groupBy(text.url_slug(F.col("url")).alias("slug")).agg(F.min("page_id").alias("page_id"), F.min_by("url", "page_id").alias("url"))


_STRICT = "regexp_replace(lower({0}), '[^a-z0-9]+', '', 'g')"
_LOOSE = "regexp_replace(regexp_replace(lower({0}), '\\b((" + "|".join(NOUNS) + ")[^a-z0-9]*)+$', ' '), '[^a-z0-9]+', '', 'g')"


_BACK = "(string_split(p_name, ' ')[2] || ' ' || string_split(p_name, ' ')[1] || ' ' || p_name)"


@query(f"SELECT p_partkey, {_STRICT.format('p_name')} AS strict, {_LOOSE.format('p_name')} AS loose, {_LOOSE.format(_BACK)} AS loose_within FROM part")
def name_keys(read):
    """Keys of a name, and of one that has generic words at its head, within it and at its end."""
    words = F.split("p_name", " ")
    back = F.concat_ws(" ", F.get(words, F.lit(1)), F.get(words, F.lit(0)), "p_name")
    return read("part").select("p_partkey", text.strict_key(F.col("p_name")).alias("strict"), text.loose_key(F.col("p_name"), NOUNS).alias("loose"), text.loose_key(back, NOUNS).alias("loose_within"))


_SIDES_SQL = f"""p AS (SELECT p_partkey AS id, p_partkey // 6 AS pair, p_brand, p_brand || '-' || p_size AS symbol, {_STRICT.format("p_name || p_type")} AS strict, {_LOOSE.format("p_name || ' ' || p_type")} AS loose FROM part),
l AS (SELECT id AS left_id, * EXCLUDE (id) FROM p WHERE id % 2 = 0), r AS (SELECT id AS right_id, * EXCLUDE (id) FROM p WHERE id % 2 = 1),
t0 AS (SELECT left_id, right_id, 'exact' AS match_method FROM (SELECT pair, p_brand, max(left_id) AS left_id FROM l GROUP BY 1, 2) JOIN (SELECT pair, p_brand, max(right_id) AS right_id FROM r GROUP BY 1, 2) USING (pair, p_brand)),
l1 AS (SELECT * FROM l WHERE left_id NOT IN (SELECT left_id FROM t0)), r1 AS (SELECT * FROM r WHERE right_id NOT IN (SELECT right_id FROM t0)),
t1 AS (SELECT left_id, right_id, 'same_symbol_same_name' AS match_method FROM (SELECT symbol, strict, min(left_id) AS left_id FROM l1 GROUP BY 1, 2 HAVING count(*) = 1) JOIN (SELECT symbol, strict, min(right_id) AS right_id FROM r1 GROUP BY 1, 2 HAVING count(*) = 1) USING (symbol, strict)),
l2 AS (SELECT * FROM l1 WHERE left_id NOT IN (SELECT left_id FROM t1)), r2 AS (SELECT * FROM r1 WHERE right_id NOT IN (SELECT right_id FROM t1)),
t2 AS (SELECT left_id, right_id, 'same_symbol_loose_name' AS match_method FROM (SELECT symbol, loose, min(left_id) AS left_id FROM l2 GROUP BY 1, 2 HAVING count(*) = 1) JOIN (SELECT symbol, loose, min(right_id) AS right_id FROM r2 GROUP BY 1, 2 HAVING count(*) = 1) USING (symbol, loose)),
m AS (SELECT * FROM t0 UNION ALL SELECT * FROM t1 UNION ALL SELECT * FROM t2 UNION ALL SELECT left_id, NULL, 'left_only' FROM l2 WHERE left_id NOT IN (SELECT left_id FROM t2) UNION ALL SELECT NULL, right_id, 'right_only' FROM r2 WHERE right_id NOT IN (SELECT right_id FROM t2))"""


def _matched(read):
    rows = read("part").select(
        "p_partkey", F.floor(F.col("p_partkey") / 6).alias("pair"), "p_brand", F.concat_ws("-", "p_brand", "p_size").alias("symbol"),
        text.strict_key(F.concat("p_name", "p_type")).alias("strict"), text.loose_key(F.concat_ws(" ", "p_name", "p_type"), NOUNS).alias("loose"),
    )
    left, right = rows.where("p_partkey % 2 = 0").withColumnRenamed("p_partkey", "left_id"), rows.where("p_partkey % 2 = 1").withColumnRenamed("p_partkey", "right_id")
    return match.tiered(left, right, ["pair", "p_brand"], [("same_symbol_same_name", ["symbol", "strict"]), ("same_symbol_loose_name", ["symbol", "loose"])])


@query(f"WITH {_SIDES_SQL} SELECT coalesce(left_id::VARCHAR, '') AS left_id, coalesce(right_id::VARCHAR, '') AS right_id, match_method FROM m")
def tiered_match(read):
    return _matched(read).select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("left_id", "right_id")), "match_method")


@query(f"WITH {_SIDES_SQL} SELECT match_method, count(*) AS n_rows FROM m GROUP BY 1")
def match_method_counts(read):
    return _matched(read).groupBy("match_method").agg(F.count(F.lit(1)).alias("n_rows"))


@query(r"SELECT doc_id, rtrim(substr(trim(regexp_replace(coalesce(text, ''), '[\s\x0B\x1C-\x1F\x{85}\x{A0}]+', ' ', 'g')), 1, 200)) AS summary FROM documents")
def normalize_limit_text(read):
    return read("documents").select("doc_id", text.limited(F.col("text"), 200).alias("summary"))


@query("SELECT c_custkey, concat_ws(' | ', 'Segment: ' || nullif(c_mktsegment, ''), 'Nation: ' || nullif(n_name, '')) AS context FROM customer JOIN nation ON c_nationkey = n_nationkey")
def labelled_context(read):
    joined = read("customer").join(read("nation"), F.col("c_nationkey") == F.col("n_nationkey"))
    return joined.select("c_custkey", text.labelled({"Segment": F.col("c_mktsegment"), "Nation": F.col("n_name")}).alias("context"))


@query("""SELECT page_id, (u.i - 1)::INTEGER AS position, l[u.i] AS href FROM (SELECT page_id, regexp_extract_all(html, '<a\\s[^>]*?href="([^"]*)"', 1) AS l FROM pages), unnest(range(1, len(l) + 1)) AS u(i)""")
def html_links(read):
    return html.links(read("pages"), "page_id", "html")


@query()
def html_section_text(read):
    return read("pages").select("page_id", html.section(F.col("html")).alias("x")).select("page_id", "x.text", "x.links")


_TASKS_SQL = "SELECT c_custkey, c_name, row_number() OVER (ORDER BY c_custkey) AS task_index, ((row_number() OVER (ORDER BY c_custkey)) - 1) // 30 + 1 AS batch_index FROM customer"


def _tasks(read):
    return batching.task_batches(read("customer").select("c_custkey", "c_name"), ["c_custkey"], 30)


@query(_TASKS_SQL)
def task_batches(read):
    return _tasks(read)


@query(f"SELECT batch_index, count(*) AS task_count, min(task_index) AS first_task_index, max(task_index) AS last_task_index, arg_min(c_name, task_index) AS first_name, arg_max(c_name, task_index) AS last_name FROM ({_TASKS_SQL}) GROUP BY 1")
def batch_manifest(read):
    return batching.manifest(_tasks(read), "c_name")


@query(f"SELECT DISTINCT batch_index, (batch_index - 1) // 5 + 1 AS round_index, (batch_index - 1) % 5 + 1 AS worker_slot FROM ({_TASKS_SQL})")
def round_slots(read):
    return _tasks(read).select("batch_index").distinct().withColumns(batching.round_slot(F.col("batch_index"), 5))


@query("SELECT o_orderkey, o_orderstatus FROM orders WHERE NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = o_orderkey)")
def resume_remaining(read):
    return batching.remaining(read("orders").select("o_orderkey", "o_orderstatus"), read("lineitem").select(F.col("l_orderkey").alias("o_orderkey")), "o_orderkey")


@query("SELECT event_id, (props::JSON->>'$.k')::BIGINT AS k FROM events")
def json_field(read):
    return read("events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"))


@query("""SELECT p_partkey, CASE p_partkey % 10 WHEN 2 THEN '[]' WHEN 4 THEN '["' || p_name || '"]' WHEN 6 THEN '' WHEN 7 THEN '["n/a"]' WHEN 8 THEN '["' || p_name || '"]' WHEN 9 THEN '[' || p_size || ',2]' ELSE '["' || p_name || '","' || p_type || '"]' END AS normal,
CASE WHEN p_partkey % 10 IN (0) THEN 2 ELSE -1 END AS n_items,
CASE p_partkey % 10 WHEN 0 THEN p_name || '/' || p_type WHEN 1 THEN '[' || chr(39) || p_name || chr(39) || ', ' || chr(39) || p_type || chr(39) || ']' WHEN 2 THEN 'None' WHEN 3 THEN '[""' || p_name || '"",""' || p_type || '""]' WHEN 4 THEN p_name WHEN 5 THEN p_name || '/' || p_type WHEN 6 THEN '' WHEN 7 THEN 'n/a' WHEN 8 THEN '"[\\"' || p_name || '\\"]"' ELSE p_size || ',2' END AS parts,
CASE p_partkey % 10 WHEN 0 THEN '[ "' || p_name || '", "' || p_type || '" ]' WHEN 2 THEN '[]' WHEN 6 THEN '[]' WHEN 5 THEN '["' || p_name || '", "' || p_type || '"]' WHEN 4 THEN '["' || p_name || '"]' WHEN 7 THEN '["n/a"]' WHEN 9 THEN '["' || p_size || ',2"]'
 WHEN 1 THEN '["[' || chr(39) || p_name || chr(39) || ', ' || chr(39) || p_type || chr(39) || ']"]' WHEN 3 THEN '["[\\"\\"' || p_name || '\\"\\",\\"\\"' || p_type || '\\"\\"]"]' ELSE '["\\"[\\\\\\"' || p_name || '\\\\\\"]\\""]' END AS flags FROM part""")
def json_list_norm(read):
    """Every reading of a text as a list: normal form, length, parts and risk flags."""
    name, kind, arm = F.col("p_name"), F.col("p_type"), F.col("p_partkey") % 10
    raw = (
        F.when(arm == 0, F.concat(F.lit('[ "'), name, F.lit('", "'), kind, F.lit('" ]')))
        .when(arm == 1, F.concat(F.lit("['"), name, F.lit("', '"), kind, F.lit("']")))
        .when(arm == 2, F.lit(" None "))
        .when(arm == 3, F.concat(F.lit('[""'), name, F.lit('"",""'), kind, F.lit('""]')))
        .when(arm == 4, name)
        .when(arm == 6, F.lit(" "))
        .when(arm == 7, F.lit("n/a"))
        .when(arm == 8, F.concat(F.lit('"[\\"'), name, F.lit('\\"]"')))
        .when(arm == 9, F.concat(F.col("p_size").cast("string"), F.lit(",2")))
        .otherwise(F.concat(name, F.lit(" | "), kind))
    )
    parts = F.array_join(values.split_list(raw), "/")
    rows = read("part").select("p_partkey", values.normal_list(raw).alias("normal"), values.list_length(raw).alias("n_items"), parts.alias("parts"), values.risk_flags(raw).alias("flags"))
    return rows


@query("SELECT event_id, CASE event_id % 5 WHEN 0 THEN 'HIGH' WHEN 1 THEN 'medium' WHEN 2 THEN 'n/a' ELSE CASE WHEN value / 100 >= 0.8 THEN 'high' WHEN value / 100 >= 0.5 THEN 'medium' ELSE 'low' END END AS level FROM events")
def bucket_value(read):
    """Words in capitals are no levels and stay."""
    k = F.col("event_id") % 5
    raw = F.when(k == 0, " HIGH ").when(k == 1, "medium").when(k == 2, "n/a").otherwise((F.col("value") / 100).cast("string"))
    return read("events").select("event_id", values.bucketed(raw).alias("level"))


RULES = {"large_quantity": "l_quantity > 49", "deep_discount": "l_discount >= 0.1", "tax_over_discount": "l_tax > l_discount + 0.07", "bad_flag": "l_returnflag NOT IN ('A', 'N', 'R')", "unpriced": "l_extendedprice IS NULL OR l_extendedprice <= 0"}
_ERRORS_SQL = " UNION ALL ".join(f"SELECT l_orderkey, l_linenumber, '{code}' AS code FROM lineitem WHERE {rule}" for code, rule in RULES.items())


def _errors(read):
    return quality.broken_rules(read("lineitem"), {code: F.expr(rule) for code, rule in RULES.items()}, ["l_orderkey", "l_linenumber"])


@query(_ERRORS_SQL)
def validate_rows(read):
    return _errors(read)


@query(f"""WITH e AS ({_ERRORS_SQL}), s AS (SELECT code, l_orderkey || ':' || l_linenumber AS sample, row_number() OVER (PARTITION BY code ORDER BY l_orderkey, l_linenumber) AS place FROM e)
SELECT code, count(*) AS n_errors, string_agg(sample, ',' ORDER BY place) FILTER (place <= 5) AS samples FROM s GROUP BY 1""")
def validation_summary(read):
    return quality.summary(_errors(read), F.concat_ws(":", "l_orderkey", "l_linenumber"), ["l_orderkey", "l_linenumber"])


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_rows FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(read):
    return quality.duplicates(read("lineitem"), ["l_orderkey", "l_linenumber"])


@query("SELECT min(doc_id) AS first_doc, count(*) AS n_rows FROM documents WHERE text IS NOT NULL GROUP BY text HAVING count(*) > 1")
def duplicate_texts(read):
    return read("documents").where("text IS NOT NULL").groupBy("text").agg(F.min("doc_id").alias("first_doc"), F.count(F.lit(1)).alias("n_rows")).where("n_rows > 1").drop("text")


@query("""SELECT coalesce(d.doc_id, l.doc_id) AS doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing_result' WHEN d.doc_id IS NULL THEN 'unexpected_result' WHEN d.expected IS DISTINCT FROM l.expected THEN 'mismatch_expected' ELSE 'ok' END AS state
FROM (SELECT doc_id, CASE WHEN n_chars > 1000 THEN 1 ELSE 0 END AS expected FROM documents) d FULL JOIN (SELECT doc_id, quality AS expected FROM labels) l USING (doc_id)""")
def align_labels(read):
    tasks = read("documents").select("doc_id", F.when(F.col("n_chars") > 1000, 1).otherwise(0).alias("expected"))
    return quality.aligned(tasks, read("labels").select("doc_id", F.col("quality").alias("expected")), "doc_id", ["expected"])


@query("""SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 AND o_orderkey % 4 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus,
CASE WHEN o_orderkey % 7 <> 0 THEN 'unreviewed' WHEN o_orderkey % 4 = 2 THEN 'manual_review' WHEN o_orderkey % 4 = 3 THEN 'needs_rerun' ELSE 'verified' END AS review_status FROM orders""")
def overlay_decisions(read):
    orders = read("orders").select("o_orderkey", "o_orderstatus")
    arm = F.col("o_orderkey") % 4
    decisions = orders.where("o_orderkey % 7 = 0").select("o_orderkey", F.when(arm == 0, "edit").when(arm == 1, "pass").when(arm == 2, "manual").otherwise("rerun").alias("decision"), F.lit("X").alias("new_o_orderstatus"))
    return quality.overlaid(orders, decisions, "o_orderkey", ["o_orderstatus"])


def _versions(read):
    orders = read("orders").select("o_orderkey", "o_orderstatus", "o_totalprice")
    return orders.where("o_orderkey % 2 = 0"), orders.where("o_orderkey % 5 = 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 3 == 0, "X").otherwise(F.col("o_orderstatus")))


_NEW_SQL = "SELECT o_orderkey, CASE WHEN o_orderkey % 3 = 0 THEN 'X' ELSE o_orderstatus END AS o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 5 = 0"


@query(f"{_NEW_SQL} UNION ALL SELECT o_orderkey, o_orderstatus, o_totalprice FROM orders WHERE o_orderkey % 2 = 0 AND o_orderkey % 5 <> 0")
def upsert_merge(read):
    return merge.upserted(*_versions(read), ["o_orderkey"])


@query(f"SELECT o_orderkey, 'o_orderstatus' AS changed FROM ({_NEW_SQL}) n JOIN orders o USING (o_orderkey) WHERE o_orderkey % 2 = 0 AND n.o_orderstatus <> o.o_orderstatus")
def overwritten_keys(read):
    return merge.overwritten(*_versions(read), "o_orderkey", ["o_orderstatus", "o_totalprice"])


@query("SELECT doc_id FROM documents EXCEPT SELECT doc_id FROM labels")
def coverage_gap(read):
    return merge.missing_keys(read("documents"), read("labels"), "doc_id")


_ISLANDS_SQL = "SELECT min(doc_id) AS first_key, max(doc_id) AS last_key, count(*) AS n_keys, max(doc_id) + 1 AS next_missing FROM (SELECT doc_id, doc_id - row_number() OVER (ORDER BY doc_id) AS run FROM (SELECT DISTINCT doc_id FROM labels)) GROUP BY run"


@query(_ISLANDS_SQL)
def contiguous_runs(read):
    return merge.islands(read("labels"), "doc_id")


@query(f"SELECT first_key, last_key, n_keys, next_missing FROM ({_ISLANDS_SQL}) ORDER BY first_key LIMIT 1")
def contiguous_prefix(read):
    return merge.islands(read("labels"), "doc_id").orderBy("first_key").limit(1)


@query("""SELECT conv_id, count(*) AS n_rows, coalesce(min(turn) FILTER (bad), max(turn) + 1)::BIGINT AS prefix_len, count(*) FILTER (bad) = 0 AS aligned
FROM (SELECT conv_id, turn, role <> CASE WHEN turn % 2 = 0 THEN 'user' ELSE 'assistant' END AS bad FROM conversations) GROUP BY 1""")
def aligned_prefix_len(read):
    return merge.prefix_length(read("conversations"), "conv_id", "turn", F.col("role") != F.when(F.col("turn") % 2 == 0, "user").otherwise("assistant"))


@query("""SELECT l_partkey, l_orderkey, l_linenumber, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_partkey ORDER BY (l_returnflag = 'N') DESC, l_quantity DESC, l_orderkey DESC, l_linenumber DESC) AS n FROM lineitem) WHERE n = 1""")
def best_attempt(read):
    return ordering.best(read("lineitem"), ["l_partkey"], [F.col("l_returnflag") == "N", "l_quantity", "l_orderkey", "l_linenumber"], ["l_orderkey", "l_linenumber", "l_quantity"])


@query("SELECT event_id, event_id // 500 AS range_index, event_id // 500 * 500 AS first_id, event_id // 500 * 500 + 499 AS last_id FROM events")
def range_assign(read):
    return batching.range_assigned(read("events").select("event_id"), "event_id", 500)


@query("SELECT user_id, n_errors, CASE WHEN n_errors >= 30 THEN 'quarantine' WHEN n_errors >= 15 THEN 'split' WHEN n_errors >= 5 THEN 'retry' ELSE 'none' END AS action FROM (SELECT user_id, count(*) FILTER (event_type = 'error') AS n_errors FROM events GROUP BY 1)")
def rule_escalation(read):
    counts = read("events").groupBy("user_id").agg(F.count_if(F.col("event_type") == "error").alias("n_errors"))
    return progress.escalated(counts, [(5, "retry"), (15, "split"), (30, "quarantine")], "n_errors")


@query("SELECT event_type, count(*) AS n_events, min(ts) AS first_at, max(ts) AS last_at, arg_max(event_id, ts) AS last_event FROM events GROUP BY 1")
def tag_rollup(read):
    return progress.tag_rollup(read("events"), "event_type", "ts", "event_id")


@query("SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id) AS n FROM events) WHERE n = 1")
def latest_event(read):
    return progress.latest(read("events"), "user_id", "ts", "event_id", ["event_type", "value"])


@query("SELECT user_id, event_type, count(*) AS n_events FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS n FROM events) WHERE n <= 40 GROUP BY 1, 2")
def tail_counts(read):
    return progress.tail_counts(read("events"), "user_id", "ts", "event_id", "event_type", 40)


@query("""SELECT event_id, user_id, g AS idle_seconds, CASE WHEN g >= 43200 THEN 'hard_timeout' WHEN g >= 14400 THEN 'soft_timeout' ELSE 'none' END AS action
FROM (SELECT event_id, user_id, greatest(0, floor(epoch(ts))::BIGINT - floor(epoch(lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id)))::BIGINT) AS x, lag(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS b, CASE WHEN b IS NULL THEN 0 ELSE x END AS g FROM events)""")
def idle_timeouts(read):
    return progress.idle_gaps(read("events"), "user_id", "ts", "event_id", 14400, 43200)


@query("SELECT user_id, ts::DATE::VARCHAR AS day, count(*) AS added, (sum(count(*)) OVER (PARTITION BY user_id ORDER BY ts::DATE))::BIGINT AS total FROM events GROUP BY user_id, ts::DATE")
def progress_delta(read):
    return progress.progress_by_day(read("events"), "user_id", "ts").withColumn("day", F.col("day").cast("string"))


@query("SELECT strftime(o_orderdate, '%Y-%m') AS month, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'P') AS n_p, count(*) AS n_rows, bool_and(o_orderstatus = 'F') AS all_done FROM orders GROUP BY 1")
def status_rollup(read):
    return progress.status_rollup(read("orders"), F.date_format("o_orderdate", "yyyy-MM"), "month", "o_orderstatus", ["F", "O", "P"], "F")


@query("SELECT o_orderkey, CASE WHEN o_orderpriority = '1-URGENT' AND o_orderstatus <> 'F' THEN 'escalated' WHEN o_orderstatus = 'F' THEN 'completed' WHEN o_orderstatus = 'P' THEN 'in_progress' ELSE lower(o_orderstatus) END AS status FROM orders")
def effective_status(read):
    done, urgent = F.col("o_orderstatus") == "F", F.col("o_orderpriority") == "1-URGENT"
    return read("orders").select("o_orderkey", values.effective_status([(urgent & ~done, "escalated"), (done, "completed"), (F.col("o_orderstatus") == "P", "in_progress")], F.lower("o_orderstatus")).alias("status"))


_PROFILED = {"c_name": "TEXT", "c_nationkey": "INTEGER", "c_mktsegment": "TEXT"}


@query(" UNION ALL ".join(f"SELECT '{c}' AS column_name, arg_min({c}::VARCHAR, c_custkey) AS sample, count({c}) AS n_filled, '{t}' AS inferred_type FROM customer" for c, t in _PROFILED.items()))
def column_profile(read):
    return catalog.profile(read("customer"), "c_custkey", list(_PROFILED))


@query("""SELECT key_name, count(*) AS n_tables, string_agg(table_name, '|' ORDER BY table_name) AS tables FROM (VALUES ('region','regionkey'),('nation','nationkey'),('nation','regionkey'),('customer','custkey'),('customer','nationkey'),
('supplier','suppkey'),('supplier','nationkey'),('part','partkey'),('orders','orderkey'),('orders','custkey'),('lineitem','orderkey'),('lineitem','partkey'),('lineitem','suppkey')) AS t(table_name, key_name) GROUP BY 1""")
def key_inference(read):
    return catalog.key_index({t: read(t) for t in TABLES[:7]})


@query("""SELECT r_name, n_name, count(*) AS n_lines, round(sum(l_extendedprice * (1 - l_discount)), 2) AS revenue FROM region JOIN nation ON r_regionkey = n_regionkey JOIN customer ON c_nationkey = n_nationkey JOIN orders ON o_custkey = c_custkey
JOIN lineitem ON l_orderkey = o_orderkey JOIN supplier ON l_suppkey = s_suppkey AND s_nationkey = n_nationkey GROUP BY 1, 2""")
def multi_hop(read):
    nations = read("nation").join(read("region"), F.col("n_regionkey") == F.col("r_regionkey"))
    customers = read("customer").join(nations, F.col("c_nationkey") == F.col("n_nationkey")).select("c_custkey", "n_nationkey", "n_name", "r_name")
    orders = read("orders").select("o_orderkey", "o_custkey").join(customers, F.col("o_custkey") == F.col("c_custkey"))
    lines = read("lineitem").select("l_orderkey", "l_suppkey", "l_extendedprice", "l_discount").join(read("supplier").select("s_suppkey", "s_nationkey"), F.col("l_suppkey") == F.col("s_suppkey"))
    joined = lines.join(orders, (F.col("l_orderkey") == F.col("o_orderkey")) & (F.col("s_nationkey") == F.col("n_nationkey")))
    return joined.groupBy("r_name", "n_name").agg(F.count(F.lit(1)).alias("n_lines"), F.round(F.sum(F.col("l_extendedprice") * (1 - F.col("l_discount"))), 2).alias("revenue"))


@query("""SELECT o_custkey, count(*) AS n_lines, count(*) FILTER (contains(p_name, 'widget')) AS n_theme, round(count(*) FILTER (contains(p_name, 'widget')) / count(*), 4) AS share
FROM orders JOIN lineitem ON l_orderkey = o_orderkey JOIN part ON p_partkey = l_partkey GROUP BY 1""")
def theme_concentration(read):
    theme = read("part").select("p_partkey", F.contains("p_name", F.lit("widget")).alias("theme"))
    lines = read("lineitem").select("l_orderkey", "l_partkey").join(theme, F.col("l_partkey") == F.col("p_partkey"))
    joined = lines.join(read("orders").select("o_orderkey", "o_custkey"), F.col("l_orderkey") == F.col("o_orderkey"))
    return joined.groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n_lines"), F.count_if("theme").alias("n_theme"), F.round(F.count_if("theme") / F.count(F.lit(1)), 4).alias("share"))


@query("SELECT n_nationkey, n_name, kind, name FROM nation JOIN (SELECT 'customer' AS kind, c_nationkey AS k, c_name AS name FROM customer UNION ALL SELECT 'supplier', s_nationkey, s_name FROM supplier) ON k = n_nationkey")
def polymorphic_lookup(read):
    kinds = {"customer": read("customer").select(F.col("c_nationkey").alias("id"), F.col("c_name").alias("name")), "supplier": read("supplier").select(F.col("s_nationkey").alias("id"), F.col("s_name").alias("name"))}
    return catalog.resolved(read("nation").select("n_nationkey", "n_name"), "n_nationkey", kinds).select("n_nationkey", "n_name", "kind", "name")


_OUTPUTS_SQL = "(SELECT o_orderkey AS batch, o_custkey % 3 <> 0 AS there, o_custkey % 7 <> 1 AS readable, o_orderkey % 11 <> 3 AS header_ok, coalesce(n, 0)::BIGINT AS n_rows, (o_orderkey % 6)::BIGINT AS expected FROM orders LEFT JOIN (SELECT l_orderkey, count(*) AS n FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey)"


@query(f"SELECT batch, CASE WHEN NOT there THEN 'missing' WHEN NOT readable THEN 'unreadable' WHEN NOT header_ok THEN 'header_mismatch' WHEN n_rows = 0 THEN 'header_only' WHEN expected > 0 AND n_rows = expected THEN 'completed' ELSE 'partial' END AS state FROM {_OUTPUTS_SQL}")
def output_states(read):
    lines = read("lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"))
    rows, k = read("orders").select("o_orderkey", "o_custkey").join(lines, "o_orderkey", "left"), F.col("o_orderkey")
    state = quality.output_state(F.col("o_custkey") % 3 != 0, F.col("o_custkey") % 7 != 1, k % 11 != 3, F.coalesce("n", F.lit(0)), k % 6)
    return rows.select(k.alias("batch"), state.alias("state"))


@query("""SELECT event_id, '{"error":' || (CASE WHEN event_type = 'error' THEN 3 ELSE 2 END) || CASE WHEN event_type <> 'error' THEN ',"' || event_type || '":1' ELSE '' END || '}' AS counts FROM events WHERE event_type IN ('error', 'view', 'signup', 'purchase')""")
def failure_counts(read):
    rows = read("events").where("event_type IN ('error', 'view', 'signup', 'purchase')")
    return rows.select("event_id", values.incremented(F.lit('{"error":2}'), F.col("event_type")).alias("counts"))


@query("""SELECT p_partkey, CASE p_partkey % 3 WHEN 0 THEN 'stalled|no_output' WHEN 1 THEN 'no_output' ELSE 'unknown' END AS reasons FROM part""")
def canonical_failures(read):
    raw = F.when(F.col("p_partkey") % 3 == 0, "timeout| stalled|no rows|timeout").when(F.col("p_partkey") % 3 == 1, " no rows |empty").otherwise(" | ")
    reasons = text.canonical_reasons(raw, {"timeout": "stalled", "no rows": "no_output", "empty": "no_output"}, "unknown")
    return read("part").select("p_partkey", F.array_join(reasons, "|").alias("reasons"))


@query("""SELECT p_partkey, p_brand AS brand, p_name || CASE WHEN p_partkey % 2 = 0 THEN ',' || p_type ELSE '' END AS evidence, p_size::VARCHAR AS size FROM part""")
def ragged_repair(read):
    fields = F.when(F.col("p_partkey") % 2 == 0, F.array("p_brand", "p_name", "p_type", F.col("p_size").cast("string"))).otherwise(F.array("p_brand", "p_name", F.col("p_size").cast("string")))
    fixed = read("part").select("p_partkey", quality.repaired_ragged(fields, 3, 1).alias("f"))
    return fixed.select("p_partkey", *(F.get("f", F.lit(i)).alias(n) for i, n in enumerate(("brand", "evidence", "size"))))


QUERIES["stream_progress"] = lambda spark, sf_dir: replayed(spark, sf_dir, "events", "user_id", "ts")
ORACLES["stream_progress"] = "SELECT user_id, count(*) AS n_events, min(ts) AS first_at, max(ts) AS last_at FROM events GROUP BY 1"


def _stream_timeouts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Timeouts that timers put out over a stream of the events."""
    schema = table(spark, sf_dir, "events").schema
    return replayed_silences(spark, sf_dir, schema, "user_id", "event_id", "ts", 14400, 43200, glob="events.parquet").select(F.col("key").cast("long").alias("user_id"), F.col("event").alias("event_id"), "action")


QUERIES["stream_timeouts"] = _stream_timeouts
ORACLES["stream_timeouts"] = """WITH g AS (SELECT user_id, event_id, floor(epoch(coalesce(lead(ts) OVER (PARTITION BY user_id ORDER BY ts, event_id), (SELECT max(ts) FROM events)))) - floor(epoch(ts)) AS s FROM events)
SELECT user_id, event_id, 'soft_timeout' AS action FROM g WHERE s >= 14400 UNION ALL SELECT user_id, event_id, 'hard_timeout' FROM g WHERE s >= 43200"""
