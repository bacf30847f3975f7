"""Ranked lexical search: variable blocks of postings with score bounds, and an exact search that skips blocks.

An index is a table of shards. A shard is one row for about SHARD_BYTES of consecutive texts: its documents' ids and
lengths, its terms, and for each term the documents that hold it with the term's occurrences. Postings are cut into
blocks, each with the largest impact in it. The cuts minimise what the bounds exceed the impacts by, summed over all
postings, plus BLOCK_COST for each block: a dynamic programme over every run of RUN postings, where best[j], the least
cost of the first j, is the minimum over i of best[i] + (j - i) * max(impacts i..j-1) + BLOCK_COST.

A search adds up the block bounds of an item's terms at every document of a shard. Between two block ends this sum is
constant; documents are visited from the highest sum down, where classic WAND moves one pivot at a time by document
number, and only the blocks over visited documents are read. It ends where the sum is under the k-th best score so far,
so no document that could be among the k best is left out. The k-th best score of a few shards, searched first, is where
the others start from; it is never above the true one.

Impacts and scores are whole numbers. With N documents that hold a term and L terms in all, a term of df documents weighs
floor(1000 * ln((2N + 2) / (2df + 1))); tf occurrences in a document of n terms have the impact
10^9 tf div (1000 tf + 20 m), m = 50 + 50 n N div L; a score is the sum of weight times impact.

Terms are the maximal runs of ASCII letters, digits and characters beyond ASCII; A-Z are lower-cased.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm._spark import sliced, written
from terrace.operators.ordering import top_in_group

#: Text bytes of a shard; one longer text is a shard alone.
SHARD_BYTES = 16_000_000
#: Text bytes whose terms are told apart at once; a longer text is taken in pieces that end between terms.
PIECE_BYTES = 4_000_000
#: Postings that one dynamic programme cuts; a list's next run begins a block.
RUN = 128
#: What the bounds of one more block have to save, in impact over the block's postings.
BLOCK_COST = 2_000_000
#: Bytes of items in one broadcast, which is a pass over the index.
ITEM_BYTES = 8_000_000
#: Shards searched first, for the score from which the others start.
FIRST_SHARDS = 8
#: Documents visited before the k-th best score is looked at again.
STEP = 512

_CODES = np.arange(256)
_IS_TERM = (_CODES >= 128) | ((_CODES >= 48) & (_CODES <= 57)) | ((_CODES >= 65) & (_CODES <= 90)) | ((_CODES >= 97) & (_CODES <= 122))
_LOWER = np.where((_CODES >= 65) & (_CODES <= 90), _CODES + 32, _CODES).astype(np.uint8)

SHARD = "shard long, ids array<long>, lengths binary, terms binary, term_ends binary, list_ends binary, docs binary, counts binary, block_starts binary, block_tops binary"


def _bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The UTF-8 bytes of all texts in turn, and where each begins, with the end of the last; null is empty."""
    texts = pc.fill_null(column, "").cast(pa.large_string())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    flat = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return flat[ends[0] : ends[-1]], ends - ends[0]


def _pieces(flat: np.ndarray, begins: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about PIECE_BYTES that end before a text begins or before a byte that is in no term."""
    at, total = 0, len(flat)
    while at < total:
        to = min(total, at + PIECE_BYTES)
        text = int(begins[np.searchsorted(begins, to)])
        while to < text:
            gap = np.flatnonzero(~_IS_TERM[flat[to : min(text, to + 65536)]])
            if len(gap):
                to += int(gap[0])
                break
            to = min(text, to + 65536)
        yield at, to
        at = to


def _spans(flat: np.ndarray, begins: np.ndarray, at: int, to: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Which bytes of a piece are in terms, where each term begins in it, and where each ends."""
    inside = _IS_TERM[flat[at:to]]
    fresh = np.zeros(to - at + 1, bool)
    here = begins[np.searchsorted(begins, at) : np.searchsorted(begins, to)] - at
    fresh[here] = True
    fresh[-1] = True
    before, after = np.concatenate([[False], inside[:-1]]), np.concatenate([inside[1:], [False]])
    return inside, np.flatnonzero(inside & (~before | fresh[:-1])), np.flatnonzero(inside & (~after | fresh[1:])) + 1


def counted(column: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray]:
    """The distinct terms of some texts, and by (term, text) the term, the text and its occurrences there."""
    flat, begins = _bytes_of(column)
    n = max(1, len(column))
    words, found = [], []
    for at, to in _pieces(flat, begins):
        inside, starts, ends = _spans(flat, begins, at, to)
        if not len(starts):
            continue
        kept, sizes = _LOWER[flat[at:to][inside]], np.concatenate([[0], np.cumsum(ends - starts)])
        coded = pa.Array.from_buffers(pa.large_string(), len(starts), [None, pa.py_buffer(sizes.astype(np.int64).tobytes()), pa.py_buffer(kept.tobytes())]).dictionary_encode()
        texts = np.searchsorted(begins, starts + at, "right") - 1
        keys, times = np.unique(coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) * n + texts, return_counts=True)
        words.append(coded.dictionary)
        found.append((keys // n, keys % n, times))
    if not words:
        none = np.zeros(0, np.int64)
        return pa.array([], pa.large_string()), none, none, none
    all_words = pa.concat_arrays(words).dictionary_encode()
    names, base, keys, times = all_words.indices.to_numpy(zero_copy_only=False).astype(np.int64), 0, [], []
    for w, (term, text, count) in zip(words, found, strict=True):
        keys.append(names[base + term] * n + text)
        times.append(count)
        base += len(w)
    key, place = np.unique(np.concatenate(keys), return_inverse=True)
    count = np.bincount(place, np.concatenate(times), len(key)).astype(np.int64)
    return all_words.dictionary, key // n, key % n, count


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0, each in as few bytes as the largest takes; that width comes first."""
    most = int(values.max(initial=0))
    width = next(w for w in (1, 2, 4, 8) if most < 1 << 8 * w)
    return bytes([width]) + values.astype(f"<u{width}").tobytes()


def _unpacked(data: bytes) -> np.ndarray:
    return np.frombuffer(data, f"<u{data[0]}", offset=1).astype(np.int64)


def norms(lengths: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """m of each document."""
    if int(lengths.max(initial=0)) * n_docs * 50 < 1 << 63:
        return 50 + lengths * n_docs * 50 // max(n_terms, 1)
    return np.array([50 + int(n) * n_docs * 50 // n_terms for n in lengths], np.int64)


def impacts(counts: np.ndarray, norm: np.ndarray) -> np.ndarray:
    return counts * 1_000_000_000 // (counts * 1000 + 20 * norm)


def _cut(tops: np.ndarray, sizes: np.ndarray, cost: int) -> np.ndarray:
    """Where blocks begin, as a mask, in runs of postings: a row of impacts each, of which the first sizes count."""
    rows, width = tops.shape
    at = np.arange(rows)
    best, back, high = np.zeros((rows, width + 1), np.int64), np.zeros((rows, width + 1), np.int64), np.zeros((rows, width), np.int64)
    lengths = np.arange(width, 0, -1)
    for j in range(width):
        np.maximum(high[:, : j + 1], tops[:, j : j + 1], out=high[:, : j + 1])
        costs = high[:, : j + 1] * lengths[width - 1 - j :]
        costs += best[:, : j + 1]
        start = costs.argmin(axis=1)
        back[:, j + 1], best[:, j + 1] = start, costs[at, start] + cost
    starts, ends = np.zeros((rows, width), bool), sizes.copy()
    while len(at):
        ends[at] = back[at, ends[at]]
        starts[at, ends[at]] = True
        at = at[ends[at] > 0]
    return starts


def block_starts(tops: np.ndarray, list_ends: np.ndarray, cost: int = BLOCK_COST) -> np.ndarray:
    """The places at which blocks begin in lists of impacts that follow each other."""
    begins = np.concatenate([[0], list_ends[:-1]]).astype(np.int64) if len(list_ends) else np.zeros(0, np.int64)
    n_runs = -(-(list_ends - begins) // RUN)
    first = np.cumsum(n_runs) - n_runs
    run_starts = np.repeat(begins, n_runs) + (np.arange(int(n_runs.sum())) - np.repeat(first, n_runs)) * RUN
    sizes = np.minimum(RUN, np.repeat(list_ends, n_runs) - run_starts)
    out = [run_starts[sizes == 1]]
    width = 2
    while width <= RUN:
        chosen = np.flatnonzero((sizes > width // 2) & (sizes <= width))
        for part in np.array_split(chosen, -(-len(chosen) // 1024) or 1):
            if not len(part):
                continue
            places = run_starts[part, None] + np.arange(width)
            real = np.arange(width) < sizes[part, None]
            rows = np.where(real, tops[np.minimum(places, len(tops) - 1)], 0)
            out.append(places[_cut(rows, sizes[part], cost)])
        width *= 2
    return np.sort(np.concatenate(out))


@dataclass
class Index:
    """shards: a written table of SHARD rows; n_docs: documents with a term; n_terms: their terms with repeats."""

    shards: DataFrame
    n_docs: int
    n_terms: int


def index(docs: DataFrame, doc_id: str = "doc_id", text: str = "text") -> Index:
    """An index of every row.

    Null and empty texts, and those without a term, are in no list. Rows that share a doc_id, or have none, are documents
    of their own. A very long text is a shard alone and read in pieces. An empty table gives an index without shards.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            flat, begins = _bytes_of(batch.column("text"))
            n = np.zeros(batch.num_rows, np.int64)
            for at, to in _pieces(flat, begins):
                starts = _spans(flat, begins, at, to)[1]
                n += np.bincount(np.searchsorted(begins, starts + at, "right") - 1, minlength=batch.num_rows)
            yield pa.RecordBatch.from_pydict({"n_docs": [int((n > 0).sum())], "n_terms": [int(n.sum())]})

    whole = rows.mapInArrow(sizes, "n_docs long, n_terms long").agg(F.sum("n_docs"), F.sum("n_terms")).first()
    n_docs, n_terms = whole[0] or 0, whole[1] or 0

    def shards(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = TaskContext.get().partitionId() << 32
        for batch in sliced(batches, "text", SHARD_BYTES):
            words, term, doc, count = counted(batch.column("text"))
            lengths = np.bincount(doc, count, batch.num_rows).astype(np.int64)
            ends = np.searchsorted(term, np.arange(len(words)), "right")
            tops = impacts(count, norms(lengths, n_docs, n_terms)[doc])
            blocks = block_starts(tops, ends)
            flat, begins = _bytes_of(words)
            columns = [[number], [batch.column("doc_id").to_pylist()], [_packed(lengths)], [flat.tobytes()], [_packed(begins[1:])], [_packed(ends)], [_packed(doc)], [_packed(count)], [_packed(blocks)], [_packed(np.maximum.reduceat(tops, blocks) if len(blocks) else blocks)]]
            kinds = [pa.int64(), pa.list_(pa.int64()), *[pa.binary()] * 8]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)
            number += 1

    names = [c.split()[0] for c in SHARD.split(", ")]
    return Index(written(rows.mapInArrow(shards, SHARD), "shards"), n_docs, n_terms)


def _terms_of(shard: dict) -> pa.Array:
    ends = np.concatenate([[0], _unpacked(shard["term_ends"])])
    return pa.Array.from_buffers(pa.large_string(), len(ends) - 1, [None, pa.py_buffer(ends.tobytes()), pa.py_buffer(shard["terms"])])


def _ranges(begins: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All places of some ranges in turn, and the range of each."""
    sizes = ends - begins
    of = np.repeat(np.arange(len(sizes)), sizes)
    return np.arange(len(of)) + (begins - (np.cumsum(sizes) - sizes))[of], of


class Shard:
    """One shard, ready to be searched."""

    def __init__(self, row: dict, n_docs: int, n_terms: int):
        self.ids = np.array([np.iinfo(np.int64).max if i is None else i for i in row["ids"]], np.int64)
        self.null = np.array([i is None for i in row["ids"]], bool)
        self.terms = _terms_of(row)
        self.list_ends, self.docs, counts = (_unpacked(row[c]) for c in ("list_ends", "docs", "counts"))
        self.tops = impacts(counts, norms(_unpacked(row["lengths"]), n_docs, n_terms)[self.docs])
        self.blocks, self.block_tops = _unpacked(row["block_starts"]), _unpacked(row["block_tops"])
        self.block_ends = np.concatenate([self.blocks[1:], [len(self.docs)]]).astype(np.int64)
        self.visited = 0

    def places(self, terms: list[str]) -> np.ndarray:
        """Each term's list here, -1 where no document holds it."""
        return pc.fill_null(pc.index_in(pa.array(terms, pa.large_string()), value_set=self.terms), -1).to_numpy(zero_copy_only=False).astype(np.int64)

    def best(self, lists: np.ndarray, weights: np.ndarray, k: int, least: int) -> tuple[np.ndarray, np.ndarray]:
        """Places and scores of the k best documents here, those under least left out, equal scores by id, none last."""
        none = np.zeros(0, np.int64)
        begins = np.where(lists > 0, self.list_ends[lists - 1], 0)
        block, term = _ranges(np.searchsorted(self.blocks, begins), np.searchsorted(self.blocks, self.list_ends[lists]))
        if not len(block):
            return none, none
        lows, highs = self.docs[self.blocks[block]], self.docs[self.block_ends[block] - 1]
        tops = self.block_tops[block] * weights[term]
        steps = np.zeros(len(self.ids) + 1, np.int64)
        np.add.at(steps, lows, tops)
        np.subtract.at(steps, highs + 1, tops)
        bounds = np.cumsum(steps[:-1])
        least = max(least, 1)
        turn = np.flatnonzero(bounds >= least)
        turn = turn[np.argsort(-bounds[turn], kind="stable")]
        docs, scores, at = none, none, 0
        while at < len(turn) and bounds[turn[at]] >= least:
            now = turn[at : at + STEP]
            at += STEP
            wanted = np.zeros(len(self.ids) + 1, np.int64)
            wanted[now + 1] = 1
            before = np.cumsum(wanted)
            use = np.flatnonzero(before[highs + 1] > before[lows])
            place, of = _ranges(self.blocks[block[use]], self.block_ends[block[use]])
            here = wanted[self.docs[place] + 1] == 1
            place, of = place[here], of[here]
            self.visited += len(place)
            sums = np.zeros(len(self.ids), np.int64)
            np.add.at(sums, self.docs[place], self.tops[place] * weights[term[use[of]]])
            docs, scores = np.concatenate([docs, now]), np.concatenate([scores, sums[now]])
            first = np.lexsort((self.ids[docs], self.null[docs], -scores))[:k]
            docs, scores = docs[first], scores[first]
            if len(docs) == k:
                least = max(least, int(scores[-1]))
        return docs[scores >= least], scores[scores >= least]


def item_blocks(items: DataFrame, item_id: str, text: str) -> Iterator[list[tuple[int | None, list[str]]]]:
    """The distinct terms of each item, in blocks of about ITEM_BYTES; rows that share an item_id are one item."""

    def terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in sliced(batches, "text"):
            words, term, row, _ = counted(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("item_id").take(pa.array(row)), words.take(pa.array(term)).cast(pa.string())], ["item_id", "term"])

    rows = items.select(F.col(item_id).cast("long").alias("item_id"), F.col(text).cast("string").alias("text")).mapInArrow(terms, "item_id long, term string")
    block, size = [], 0
    for row in rows.groupBy("item_id").agg(F.collect_set("term").alias("terms")).toLocalIterator():
        own = sum(map(len, row.terms))
        if block and size + own > ITEM_BYTES:
            yield block
            block, size = [], 0
        block.append((row.item_id, sorted(row.terms)))
        size += own
    if block:
        yield block


def _frequencies(found: Index, terms: list[str]) -> dict[str, int]:
    """How many documents hold each term."""
    sent = found.shards.sparkSession.sparkContext.broadcast(terms)

    def sizes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                place = pc.index_in(pa.array(sent.value, pa.large_string()), value_set=_terms_of(row))
                here, ends = pc.is_valid(place).to_numpy(zero_copy_only=False), np.concatenate([[0], _unpacked(row["list_ends"])])
                at = pc.drop_null(place).to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(np.flatnonzero(here), pa.int64()), pa.array(ends[at + 1] - ends[at], pa.int64())], ["term", "n"])

    rows = found.shards.select("terms", "term_ends", "list_ends").mapInArrow(sizes, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    return {terms[r.term]: r.n for r in rows.collect()}


def search(found: Index, items: DataFrame, k: int = 50, item_id: str = "item_id", text: str = "text") -> DataFrame:
    """item_id, rank from 1, doc_id and score: the k documents of highest score above 0 for each item.

    Equal scores are ranked by doc_id, rows without one last; rows alike in both are told apart arbitrarily. Items with a
    null or empty text, or without a term that a document holds, have no rows. Rows that share an item_id, or have none,
    are one item with all their terms. Very long items are taken whole; other columns of items don't matter.
    """
    spark = found.shards.sparkSession
    schema, out = "item_id long, doc_id long, score long", None

    def searcher(sent, least: dict) -> Callable:
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            terms, plan = sent.value
            for batch in batches:
                for row in batch.to_pylist():
                    shard = Shard(row, found_docs, found_terms)
                    lists = shard.places(terms)
                    for i, (name, uses, weights) in enumerate(plan):
                        own = lists[uses]
                        docs, scores = shard.best(own[own >= 0], weights[own >= 0], k, least.get(i, 1))
                        if len(docs):
                            ids = pa.array(shard.ids[docs], pa.int64(), mask=shard.null[docs])
                            yield pa.RecordBatch.from_arrays([pa.array([name] * len(docs), pa.int64()), ids, pa.array(scores, pa.int64())], ["item_id", "doc_id", "score"])

        return run

    order = [F.desc("score"), F.asc_nulls_last("doc_id")]
    found_docs, found_terms = found.n_docs, found.n_terms
    for block in item_blocks(items, item_id, text):
        terms = sorted({t for _, own in block for t in own})
        df = _frequencies(found, terms)
        at = {t: i for i, t in enumerate(terms)}
        weight = {t: math.floor(1000 * math.log((2 * found_docs + 2) / (2 * n + 1))) for t, n in df.items()}
        plan = [(name, np.array([at[t] for t in own if t in df], np.int64), np.array([weight[t] for t in own if t in df], np.int64)) for name, own in block]
        sent = spark.sparkContext.broadcast((terms, plan))
        number = {name: i for i, (name, _, _) in enumerate(plan)}
        first = [r.shard for r in found.shards.select("shard").orderBy("shard").limit(FIRST_SHARDS).collect()]
        early = written(top_in_group(found.shards.where(F.col("shard").isin(first)).mapInArrow(searcher(sent, {}), schema), ["item_id"], order, k, "rank"), "first")
        least = {number[r.item_id]: r.score for r in early.where(F.col("rank") == k).select("item_id", "score").collect()}
        rest = found.shards.where(~F.col("shard").isin(first)).mapInArrow(searcher(sent, least), schema)
        part = top_in_group(early.drop("rank").unionByName(rest), ["item_id"], order, k, "rank")
        out = part if out is None else out.unionByName(part)
    if out is None:
        out = spark.createDataFrame([], schema + ", rank int")
    return out.select("item_id", "rank", "doc_id", "score")
