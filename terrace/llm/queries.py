"""The queries of this subpackage and, where SQL can state their rows, the DuckDB SQL.

Paths of public vocabularies are parameters of the operators; the queries take those of the installed package.
"""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from terrace.llm import cminhash, decontaminate, host_rules, line_templates, prefix_trie, sentencepiece_codec, shards, surrogates, text_density, token_files, token_lengths, toxicity, wand
from terrace.llm._spark import table

WORD_BPE = public_tokenizers.path("word_bpe_49k.json")
PIECE_BPE = public_tokenizers.path("piece_bpe_32k.model")
BYTE_BPE = public_tokenizers.path("byte_bpe_50k.tiktoken")

#: Of the query on synthetic rows; a real corpus takes a secret one.
SURROGATE_KEY = "synthetic-corpus"


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document that holds a benchmark item, with the item and the edit distance."""
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document by the rebuilt backend, decoded again and held against the sentencepiece library."""
    return sentencepiece_codec.encode_documents(table(spark, sf_dir, "documents"), PIECE_BPE, with_ids=False)


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards.sharded(table(spark, sf_dir, "documents"), shards=24)


def op4_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates in place of personal data."""
    return surrogates.replaced(table(spark, sf_dir, "documents").select("doc_id", "text"), key=SURROGATE_KEY)


def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classified(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op6_host_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return host_rules.judged(table(spark, sf_dir, "documents"))


def op7_cminhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cminhash.near_duplicates(table(spark, sf_dir, "documents"), percent=85)


def op8_line_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without its recurring lines."""
    return line_templates.deduplicated(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op9_token_lengths(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_lengths.length_histogram(token_lengths.encoded_lengths(table(spark, sf_dir, "documents"), BYTE_BPE, public_tokenizers.PATTERN))


def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.token_file_digest(spark, table(spark, sf_dir, "documents"), WORD_BPE, end_id=2)


def op11_wand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 50 best documents of every benchmark item."""
    return wand.search(wand.index(table(spark, sf_dir, "documents")), table(spark, sf_dir, "benchmark"), k=50)


def op12_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations"))


def op13_text_density(spark: SparkSession, sf_dir: str) -> DataFrame:
    return text_density.extracted(table(spark, sf_dir, "pages"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_sentencepiece": op2_sentencepiece,
    "op3_shards": op3_shards,
    "op4_surrogates": op4_surrogates,
    "op5_toxicity": op5_toxicity,
    "op6_host_rules": op6_host_rules,
    "op7_cminhash": op7_cminhash,
    "op8_line_templates": op8_line_templates,
    "op9_token_lengths": op9_token_lengths,
    "op10_token_files": op10_token_files,
    "op11_wand": op11_wand,
    "op12_prefix_trie": op12_prefix_trie,
    "op13_text_density": op13_text_density,
    "pipeline": corpus_pipeline.run,
}

_SPACE = r"[^\x20\x09-\x0D]"
_TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

ORACLES: dict[str, str] = {
    "op6_host_rules": rf"""
WITH d AS (
  SELECT doc_id, source AS host, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '{_SPACE}+') AS w,
         [x FOR x IN string_split(coalesce(text, ''), chr(10)) IF regexp_matches(x, '{_SPACE}')] AS l
  FROM documents),
windows AS (SELECT doc_id, u.i AS i, list_slice(w, u.i, u.i + 7) AS g FROM d, unnest(range(1, len(w) - 6)) AS u(i)),
twice AS (SELECT doc_id, i FROM windows QUALIFY count(*) OVER (PARTITION BY doc_id, g) > 1),
covered AS (SELECT doc_id, count(DISTINCT v.p) AS n FROM twice, unnest(range(i, i + 8)) AS v(p) GROUP BY doc_id),
m AS (
  SELECT d.doc_id, host, len(w)::BIGINT AS n_words, length(regexp_replace(t, '[\x20\x09-\x0D]', '', 'g'))::BIGINT AS word_chars,
         length(regexp_replace(t, '[^#*$%&|<>]', '', 'g'))::BIGINT AS n_symbols, (len(l) - len(list_distinct(l)))::BIGINT AS n_dup_lines,
         coalesce(c.n, 0)::BIGINT AS n_repeat_words, len(l) AS n_lines
  FROM d LEFT JOIN covered c USING (doc_id)),
f AS (
  SELECT *, n_words < 20 AS r1, 100 * n_repeat_words > 30 * n_words AS r2, 10 * n_symbols > word_chars AS r3, 10 * n_dup_lines > 3 * n_lines AS r4 FROM m),
hosts AS (
  SELECT host, rule, count(*)::DOUBLE AS n, (count(*) FILTER (bad))::DOUBLE AS x
  FROM (SELECT host, unnest([1, 2, 3, 4]) AS rule, unnest([r1, r2, r3, r4]) AS bad FROM f WHERE host IS NOT NULL) GROUP BY ALL),
pooled AS (
  SELECT rule, count(*) AS k, sum(n) AS nn, sum(n * n) AS n2, sum(x * x / n) AS q, least(greatest(sum(x) / sum(n), 1e-6), 1 - 1e-6) AS p FROM hosts GROUP BY rule),
prior AS (
  SELECT rule, p, CASE WHEN nn - n2 / nn - (k - 1) > 0 THEN least(greatest(((q - nn * p * p) / (p * (1 - p)) - (k - 1)) / (nn - n2 / nn - (k - 1)), 1e-4), 0.9) ELSE 0.5 END AS rho FROM pooled),
rejected AS (
  SELECT host FROM hosts JOIN prior USING (rule) GROUP BY host HAVING max((x + p * (1 / rho - 1)) / (n + (1 / rho - 1))) > 0.5)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, r1 OR r2 AS base_failed,
       NOT (r1 OR r2) AND r.host IS NULL AS kept, f.host, r.host IS NOT NULL AS host_rejected
FROM f LEFT JOIN rejected r ON f.host = r.host""",
    "op7_cminhash": rf"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_SPACE}+') AS w FROM documents),
s AS (
  SELECT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(list_slice(w, i, i + 4), ' ') FOR i IN range(1, len(w) - 3)])
                             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS g FROM w),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
c AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY 1, 2),
l AS (SELECT x, y FROM c JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)),
e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r AS (SELECT doc_id, doc_id AS node FROM w UNION SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.node)
SELECT doc_id, coalesce(any_value(n.n), 0)::BIGINT AS n_shingles, min(node) AS component_id, doc_id = min(node) AS kept FROM r LEFT JOIN n USING (doc_id) GROUP BY doc_id""",
    "op8_line_templates": """
WITH RECURSIVE d AS (SELECT doc_id, text, md5(concat_ws(chr(31), doc_id::VARCHAR, text)) AS id, string_split(text, chr(10)) AS ls FROM documents WHERE text IS NOT NULL AND text <> ''),
l AS (SELECT id, u.i - 1 AS line_no, [CASE WHEN regexp_matches(t, '[0-9]') THEN '<*>' ELSE t END FOR t IN string_split_regex(ls[u.i], '\\s+') IF t <> ''] AS m FROM d, unnest(range(1, len(ls) + 1)) AS u(i)),
k AS (SELECT id, line_no, m, len(m) AS n, md5(array_to_string(m, ' ')) AS masked, md5(len(m) || ' ' || array_to_string(m[1:3], ' ')) AS leaf FROM l WHERE len(m) > 0),
f AS (SELECT leaf, masked, any_value(m) AS m, count(DISTINCT id) AS docs FROM k GROUP BY 1, 2),
t AS (SELECT leaf, masked, docs, u.p AS p, m[u.p] AS token FROM f, unnest(range(1, len(m) + 1)) AS u(p) WHERE leaf IN (SELECT leaf FROM f GROUP BY 1 HAVING count(*) > 1 AND sum(docs) >= 3)),
c AS (SELECT leaf, p, token FROM t GROUP BY 1, 2, 3 HAVING sum(docs) >= 3),
g AS (
  SELECT t.leaf, masked, count(c.token) AS k, count(*) AS n, string_agg(coalesce(c.token, '<*>'), ' ' ORDER BY t.p) AS template
  FROM t LEFT JOIN c ON t.leaf = c.leaf AND t.p = c.p AND t.token = c.token GROUP BY 1, 2),
x AS (SELECT masked, md5(leaf || '/' || template) AS template FROM g WHERE k < n AND 100 * k >= 70 * n),
y AS (SELECT id, line_no, k.n, coalesce(x.template, masked) AS template FROM k LEFT JOIN x USING (masked)),
z AS (SELECT template FROM y GROUP BY 1 HAVING count(DISTINCT id) >= 3),
h AS (SELECT id FROM y LEFT JOIN z USING (template) GROUP BY 1 HAVING 100 * coalesce(sum(n) FILTER (z.template IS NOT NULL), 0) >= 50 * sum(n)),
v AS (SELECT DISTINCT id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x20\\x09-\\x0D]+') AS w FROM d JOIN h USING (id)),
s AS (
  SELECT id, unnest(CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(list_slice(w, i, i + 4), ' ') FOR i IN range(1, len(w) - 3)])
                         WHEN len(w) > 0 THEN [array_to_string(w, ' ')] END) AS g FROM v),
b AS (SELECT id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT s.id AS i, o.id AS j, count(*) AS c FROM s JOIN s o ON s.g = o.g AND s.id < o.id GROUP BY 1, 2),
e AS (SELECT i, j FROM p JOIN b x ON x.id = i JOIN b y ON y.id = j WHERE 100 * c >= 50 * (x.n + y.n - c)),
n AS (SELECT i, j FROM e UNION ALL SELECT j, i FROM e),
a AS (SELECT id, id AS node FROM h UNION SELECT a.id, n.j FROM a JOIN n ON n.i = a.node),
r AS (SELECT id, min(node) AS label FROM a GROUP BY 1),
w AS (SELECT template FROM y JOIN z USING (template) LEFT JOIN r USING (id) GROUP BY 1 HAVING count(DISTINCT coalesce(label, id)) >= 3),
q AS (SELECT id, list(DISTINCT line_no) AS drops FROM y JOIN w USING (template) GROUP BY 1)
SELECT a.doc_id, CASE WHEN q.id IS NULL THEN a.text ELSE array_to_string([v FOR v, i IN string_split(a.text, chr(10)) IF NOT list_contains(q.drops, i - 1)], chr(10)) END AS text,
       CASE WHEN a.text IS NULL OR a.text = '' THEN 0 ELSE len(string_split(a.text, chr(10))) END::BIGINT AS n_lines, coalesce(len(q.drops), 0)::BIGINT AS n_dropped
FROM documents a LEFT JOIN q ON q.id = md5(concat_ws(chr(31), a.doc_id::VARCHAR, a.text))""",
    "op11_wand": rf"""
WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '{_TERM}') AS w FROM documents),
n AS (SELECT row_number() OVER () AS id, doc_id, len(w)::BIGINT AS n, w FROM d WHERE len(w) > 0),
a AS (SELECT count(*)::BIGINT AS nn, sum(n)::BIGINT AS l FROM n),
m AS (SELECT id, doc_id, w, 50 + (50 * n * nn) // l AS m FROM n, a),
q AS (SELECT DISTINCT item_id, unnest(regexp_extract_all({_LOWER}, '{_TERM}')) AS term FROM benchmark),
u AS (SELECT id, doc_id, m, unnest(w) AS term FROM m),
p AS (SELECT id, doc_id, m, term, count(*)::BIGINT AS tf FROM u SEMI JOIN q ON q.term = u.term GROUP BY ALL),
t AS (SELECT term, floor(1000 * ln((2 * any_value(nn) + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM p, a GROUP BY term),
s AS (SELECT item_id, id, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score FROM q JOIN p USING (term) JOIN t USING (term) GROUP BY ALL HAVING score > 0)
SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score FROM s QUALIFY rank <= 50""",
    "op12_prefix_trie": """
WITH RECURSIVE t AS (
  SELECT conv_id AS c, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) - 1 AS p,
         md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, '')) AS k, strlen(coalesce(text, ''))::BIGINT AS b
  FROM conversations WHERE conv_id IS NOT NULL),
o AS (SELECT c, list(k ORDER BY p) AS k, list(b ORDER BY p) AS b FROM t GROUP BY c),
h AS (
  SELECT c, k, b, xor(list_reduce(list_prepend(4294967295::BIGINT, [ascii(x)::BIGINT FOR x IN string_split(c::VARCHAR, '')]),
    LAMBDA s, x: list_reduce(list_prepend(xor(s, x), range(8)), LAMBDA y, i: CASE WHEN y & 1 = 1 THEN xor(y >> 1, 3988292384) ELSE y >> 1 END)), 4294967295) % 9 AS h FROM o),
r AS (
  SELECT a.c, list_concat(coalesce(z.k[:a.h], []), a.k[a.h + 1:]) AS k, list_concat(coalesce(z.b[:a.h], []), a.b[a.h + 1:]) AS b
  FROM h a LEFT JOIN h z ON z.c = a.c - a.c % 5),
m AS (SELECT c, u.d AS d, array_to_string(k[:u.d], '/') AS node, CASE WHEN u.d > 0 THEN array_to_string(k[:u.d - 1], '/') END AS up, coalesce(b[u.d], 0) AS b, len(k) = u.d AS ends FROM r, unnest(range(len(k) + 1)) AS u(d)),
n AS (
  SELECT node, d, any_value(up) AS up, min(c) AS conv_id, count(*) AS n, any_value(b) AS b,
         sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (ends), '')) AS ends_sha256 FROM m GROUP BY node, d),
k AS (SELECT n.*, (SELECT count(*) FROM n x WHERE x.up = n.node AND x.d = n.d + 1) AS n_children FROM n),
g AS (SELECT node AS top, d AS td, node, d, n_children, (n - 1) * b AS saved FROM k UNION ALL SELECT g.top, g.td, k.node, k.d, k.n_children, (k.n - 1) * k.b FROM g JOIN k ON k.up = g.node AND k.d = g.d + 1),
f AS (SELECT top, td, count(*) FILTER (n_children = 0) AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM g GROUP BY 1, 2)
SELECT k.conv_id, k.d AS depth, x.conv_id AS parent_conv_id, k.n AS n_convs, k.n_children, n_leaves, saved_tokens, k.ends_sha256
FROM k JOIN f ON f.top = k.node AND f.td = k.d LEFT JOIN n x ON x.node = k.up AND x.d = k.d - 1""",
}
