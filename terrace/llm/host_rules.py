"""Quality rules on documents and on the hosts that they come from.

Each text is measured once, with SQL functions only. Rule failures are counted by host; a host's failure rates are
shrunk towards those of all hosts by a beta prior that is fitted to the hosts themselves; a host whose shrunken rate is
over the limit for any rule loses all its documents. Rates of hosts with few documents stay near the prior's mean, so
that one bad page doesn't condemn a host.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from terrace.llm._spark import written

SPACES = "[\\x20\\x09-\\x0D]+"
WINDOW = 8
#: Rules that are counted by host, over the measures of a document.
RULES = {
    "too_short": "n_words < 20",
    "repetitive": "100 * n_repeat_words > 30 * n_words",
    "symbols": "10 * n_symbols > word_chars",
    "repeated_lines": "10 * n_dup_lines > 3 * n_lines",
}
BASE = ("too_short", "repetitive")


def bound(value: Column, use) -> Column:
    """use(value), with value computed once however often use refers to it, inside lambdas too."""
    return F.transform(F.array(value), use)[0]


def repeated_words(words: Column) -> Column:
    """Words that stand in windows of eight words which the text holds twice or more.

    Windows are compared by 64-bit hashes. A text without two equal windows ends there; otherwise the windows are
    sorted, and the gaps between the repeated ones are summed up to a window's length.
    """
    hashes = F.transform(F.sequence(F.lit(1), F.size(words) - (WINDOW - 1)), lambda i: F.xxhash64(F.slice(words, i, WINDOW)))

    def covered(hashes: Column) -> Column:
        def of(sorted_: Column) -> Column:
            same = lambda e, i: F.coalesce(e["h"] == F.get(sorted_, i)["h"], F.lit(False))
            found = F.transform(F.filter(sorted_, lambda e, i: same(e, i - 1) | same(e, i + 1)), lambda e: e["i"])
            return bound(F.sort_array(found), lambda at: F.aggregate(F.zip_with(at, F.slice(at, 2, F.greatest(F.size(at), F.lit(1))), lambda a, b: F.least(F.lit(WINDOW), F.coalesce(b - a, F.lit(WINDOW)))), F.lit(0), lambda s, x: s + x))

        pairs = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bound(pairs, of))

    return F.when(F.size(words) <= WINDOW, F.lit(0)).otherwise(bound(hashes, covered))


def measured(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """doc_id, host and the measures of each row's whole text; a null text counts as an empty one."""
    whole = F.coalesce(F.col(text), F.lit(""))
    words = F.array_remove(F.split(whole, SPACES), "")
    of_words = bound(words, lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.length(F.array_join(w, "")).cast("long").alias("word_chars"), repeated_words(w).cast("long").alias("n_repeat_words")))
    lines = F.filter(F.split(whole, "\n"), lambda line: F.regexp_like(line, F.lit("[^\\x20\\x09-\\x0D]")))
    of_lines = bound(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    symbols = F.length(whole) - F.length(F.regexp_replace(whole, "[#*$%&|<>]+", ""))
    return docs.select(F.col(doc_id).alias("doc_id"), F.col(host).alias("host"), of_words.alias("w"), of_lines.alias("l"), symbols.cast("long").alias("n_symbols")).select(
        "doc_id", "host", "w.n_words", "w.word_chars", "n_symbols", "l.n_dup_lines", "w.n_repeat_words", "l.n_lines"
    )


@dataclass(frozen=True)
class Prior:
    alpha: float
    beta: float


def host_counts(rows: DataFrame) -> DataFrame:
    """Documents and failures of each rule by host; rows without a host count nowhere."""
    return rows.where(F.col("host").isNotNull()).groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"), *(F.count_if(F.expr(rule)).alias(name) for name, rule in RULES.items()))


def fitted_priors(hosts: DataFrame) -> dict[str, Prior]:
    """A beta prior for each rule from the moments of the hosts' rates.

    With p the pooled rate and S the sum of n (rate - p)^2 over K hosts, the correlation of documents within a host is
    (S / p(1-p) - (K-1)) / (N - sum n^2 / N - (K-1)), held between 0.0001 and 0.9; the prior's weight is 1/correlation - 1.
    """
    n = F.col("n_docs").cast("double")
    first = hosts.agg(F.count(F.lit(1)).alias("k"), F.sum(n).alias("n"), F.sum(n * n).alias("nn"), *(F.sum(F.col(r) * F.col(r) / n).alias(f"q_{r}") for r in RULES), *(F.sum(r).alias(f"f_{r}") for r in RULES)).first()
    out = {}
    for rule in RULES:
        total = first["n"] or 0.0
        p = min(max((first[f"f_{rule}"] or 0) / total, 1e-6), 1 - 1e-6) if total else 0.5
        spread = (first[f"q_{rule}"] or 0.0) - total * p * p
        room = total - (first["nn"] or 0.0) / total - (first["k"] - 1) if total else 0.0
        rho = min(max((spread / (p * (1 - p)) - (first["k"] - 1)) / room, 1e-4), 0.9) if room > 0 else 0.5
        weight = 1 / rho - 1
        out[rule] = Prior(p * weight, (1 - p) * weight)
    return out


def host_verdicts(hosts: DataFrame, priors: dict[str, Prior], max_rate: float = 0.5) -> DataFrame:
    """host, n_docs, the shrunken rate of each rule, and rejected: any of them over max_rate."""
    rates = {r: (F.col(r) + p.alpha) / (F.col("n_docs") + p.alpha + p.beta) for r, p in priors.items()}
    return hosts.select("host", "n_docs", *(c.alias(f"rate_{r}") for r, c in rates.items()), (F.greatest(*rates.values()) > max_rate).alias("rejected"))


def judged(docs: DataFrame, max_rate: float = 0.5, doc_id: str = "doc_id", text: str = "text", host: str = "source") -> DataFrame:
    """The measures of each row with base_failed, host_rejected and kept.

    Rows without a host are judged by themselves alone. A null text has no words, and fails the base rules. doc_id is only
    passed on, null or not. Very long texts are measured whole. A host's rate at max_rate exactly isn't above it. Repeated
    rows are counted and returned as often as they stand. An empty table gives no rows.
    """
    rows = written(measured(docs, doc_id, text, host), "measures")
    hosts = host_counts(rows)
    verdicts = host_verdicts(hosts, fitted_priors(hosts), max_rate)
    # Only rejected hosts take part in the join: a short side that Spark broadcasts after it has seen its size.
    joined = rows.join(verdicts.where("rejected").select("host", "rejected"), "host", "left")
    failed = F.expr(" OR ".join(f"({RULES[r]})" for r in BASE))
    rejected = F.coalesce(F.col("rejected"), F.lit(False))
    return joined.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"), (~failed & ~rejected).alias("kept"), "host", rejected.alias("host_rejected"))
