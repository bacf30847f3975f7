"""Benchmark decontamination: documents that hold an item's passage, up to a share of edits.

The CGK random walk maps edit distance to Hamming distance: at step j the walk writes the character that it stands on,
and moves on or stays by a random bit for (j, character). Two texts that share a stretch walk alike over it, and after
an edit the walks soon meet again. Hashing a few sampled steps of the walk is then bit-sampling LSH for edit distance.

Items and documents are normalised alike: lower case, one space for each run of white space. Both are walked from each
of their word starts (from each character in scripts that don't space words), so that the window behind each start is
held against the item-sized window that it would belong to, whatever part of the passage is damaged. Each repetition
has its own walk and samples. How many steps a key takes in follows from the item: the most at which the starts of the
item, each surviving max_share of edits by chance, still reach the recall that is asked for. Keys are compared
progressively: a window is dropped once the samples so far match no item's, which leaves the same matches as comparing
whole keys. Windows that match go on walking and must agree with the item in LEAST_AGREED of the following steps; what
is left is verified exactly: the least edit distance between the item and any stretch of its window, by bit-parallel
dynamic programming on code points.

Items of up to SHORT characters are too short for that. They are found without loss: of limit + 1 pieces of an item one
stands unchanged in any passage within limit edits, so places that hold a piece are verified, all at once in 64-bit
vectors.

All items are sent to the workers as one broadcast of bounded size, documents pass by once, in slices, and nothing is
shuffled. Only a benchmark of more than BLOCK_BYTES takes another pass.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm._spark import sliced

REPEATS = 2
#: Steps in each of which one is sampled; keys of an item end behind one of the DEPTHS, and are compared from three samples on.
STRATA = (0, 4, 8, 11, 14, 17, 20, 24, 28)
DEPTHS = (17, 20, 24, 28)
FIRST_CHECK = 3
#: Steps behind the key that are compared, and the share in which walks must agree.
DEEP = 100
LEAST_AGREED = 0.2
#: Bytes that an item must have behind a start for the walk to begin there.
LEAST_REST = 20
#: Bytes of the stretches that an item and a window must share before they are compared, and bits of their hashes.
GRAM, GRAM_BITS = 4, 14
#: Characters of the longest item that is found by its pieces.
SHORT = 64
#: Bytes of items in one pass over the documents; an index takes some 20 times that in a worker.
BLOCK_BYTES = 8_000_000


def normal(text: str) -> str:
    """Lower case, with one space for each run of white space and none at the ends."""
    return " ".join(text.lower().split())


def distance_within(item: str, text: str) -> int:
    """The least edit distance between item and any stretch of text (Myers' bit vectors, of any length)."""
    m = len(item)
    if not m or item in text:
        return 0
    masks: dict[str, int] = {}
    for i, c in enumerate(item):
        masks[c] = masks.get(c, 0) | 1 << i
    full, top = (1 << m) - 1, 1 << (m - 1)
    plus, minus, score = full, 0, m
    best = m
    for c in text:
        eq = masks.get(c, 0)
        zero = (((eq & plus) + plus) ^ plus) | eq | minus
        up = minus | ~(zero | plus) & full
        down = plus & zero
        if up & top:
            score += 1
        elif down & top:
            score -= 1
            best = min(best, score)
        up, down = up << 1 & full, down << 1 & full
        plus = down | ~(zero | up) & full
        minus = up & zero
    return best


class Index:
    """The walks of items of more than SHORT characters."""

    def __init__(self, items: list[tuple[int, str]], max_share: float, recall: float):
        self.items = items
        self.limit = [int(max_share * len(n)) for _, n in items]
        raw = [n.encode() for _, n in items]
        self.sizes = np.array([len(r) for r in raw], np.int64)
        rng = np.random.default_rng(11)
        self.moves = rng.integers(0, 2, (REPEATS, STRATA[-1] + DEEP, 256), dtype=np.uint8)
        self.takes = [[int(rng.integers(a, b)) for a, b in zip(STRATA[:-1], STRATA[1:])] for _ in range(REPEATS)]
        gap = bytes(STRATA[-1] + DEEP)
        self.buffer = np.frombuffer(gap.join(raw) + gap, np.uint8)
        begins = np.cumsum([0, *(len(r) + len(gap) for r in raw)])[:-1].astype(np.int64)
        starts = walk_starts(self.buffer, begins).astype(np.int64)
        owner = np.searchsorted(begins, starts, "right") - 1
        good = self.sizes[owner] - (starts - begins[owner]) >= LEAST_REST
        starts, owner = starts[good], owner[good]
        self.begins, self.grams = begins, gram_hashes(self.buffer)
        self.least = [self.least_grams(i) for i in range(len(items))]
        self.starts, self.owner, self.offset = starts.astype(np.int32), owner.astype(np.int32), (starts - begins[owner]).astype(np.int32)
        self.depth = np.array([_depth(len(n), len(r), k, max_share, recall) for (_, n), r, k in zip(items, raw, np.bincount(owner, minlength=len(items)))], np.int64)
        self.bits = int(np.clip(np.ceil(np.log2(len(starts) + 1)) + 5, 16, 27))
        self.maps: list[dict[int, np.ndarray]] = []
        self.keys: list[dict[int, tuple[np.ndarray, np.ndarray]]] = []
        for r in range(REPEATS):
            state, key, maps, keys, taken = starts.copy(), np.zeros(len(starts), np.uint64), {}, {}, 0
            for j in range(STRATA[-1]):
                c = self.buffer[state]
                if j == self.takes[r][taken] if taken < len(self.takes[r]) else False:
                    key = key * np.uint64(0x100000001B3) + c
                    taken += 1
                    last = STRATA[taken]
                    if taken >= FIRST_CHECK:
                        seen = np.zeros(1 << self.bits, bool)
                        seen[self._slot(key[self.depth[owner] >= last])] = True
                        maps[taken] = seen
                    if last in DEPTHS:
                        own = np.flatnonzero(self.depth[owner] == last)
                        order = own[np.argsort(key[own], kind="stable")]
                        keys[taken] = key[order], order.astype(np.int32)
                state += self.moves[r, j][c]
            self.maps.append(maps)
            self.keys.append(keys)

    def least_grams(self, i: int) -> int:
        """How many grams of an item stand unchanged in any passage within its limit: an edit takes away those it touches."""
        widest = max(map(len, map(str.encode, set(self.items[i][1]))))
        return int(self.sizes[i]) - GRAM + 1 - (GRAM - 1 + widest) * self.limit[i]

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def candidates(self, buffer: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where a window starts that matches, and the walk of an item that it matches; buffer ends with a gap of zeros."""
        found, walks = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
        for r in range(REPEATS):
            state, key, origin, taken = starts.copy(), np.zeros(len(starts), np.uint64), starts, 0
            for j in range(STRATA[-1]):
                c = buffer[state]
                if taken < len(self.takes[r]) and j == self.takes[r][taken]:
                    key *= np.uint64(0x100000001B3)
                    key += c
                    taken += 1
                    if taken in self.maps[r]:
                        alive = self.maps[r][taken][self._slot(key)]
                        state, key, origin, c = state[alive], key[alive], origin[alive], c[alive]
                    if taken in self.keys[r]:
                        known, order = self.keys[r][taken]
                        lo = np.searchsorted(known, key, "left")
                        n = np.searchsorted(known, key, "right") - lo
                        if n.sum():
                            walk = order[np.repeat(lo - np.cumsum(n) + n, n) + np.arange(n.sum())]
                            at = np.repeat(origin, n)
                            good = self._agrees(r, buffer, at, walk)
                            found.append(at[good].astype(np.int64))
                            walks.append(walk[good].astype(np.int64))
                state += self.moves[r, j][c]
        return np.concatenate(found), np.concatenate(walks)

    def _agrees(self, r: int, buffer: np.ndarray, at: np.ndarray, walk: np.ndarray) -> np.ndarray:
        """Whether walks go on alike behind the key."""
        depth = self.depth[self.owner[walk]]
        rest = 2 * (self.sizes[self.owner[walk]] - self.offset[walk]).astype(np.int64)
        steps = np.clip(rest - depth, 1, DEEP)
        x, y = at.astype(np.int64), self.starts[walk].astype(np.int64)
        agreed = np.zeros(len(at), np.int64)
        top = len(buffer) - 1
        for j in range(int((depth + steps).max())):
            a, b = buffer[np.minimum(x, top)], self.buffer[y]
            agreed += (a == b) & (b != 0) & (j >= depth)
            x += self.moves[r, j][a]
            y += self.moves[r, j][b]
        return agreed >= LEAST_AGREED * steps


def _depth(chars: int, size: int, starts: int, share: float, recall: float) -> int:
    """The most steps of a key at which an item's starts reach the recall: a start survives if what its key covers does."""
    apart = min(starts, chars / 6)
    for depth in reversed(DEPTHS):
        survives = (1 - share) ** (depth / 2 * chars / size)
        if 1 - (1 - survives) ** apart >= recall:
            return depth
    return DEPTHS[0]


def gram_hashes(buffer: np.ndarray) -> np.ndarray:
    """A hash of GRAM_BITS bits for the GRAM bytes from each place on."""
    out = np.zeros(max(0, len(buffer) - GRAM + 1), np.uint32)
    for k in range(GRAM):
        out *= np.uint32(0x01000193)
        out ^= buffer[k : k + len(out)]
    out *= np.uint32(0x9E3779B1)
    out >>= np.uint32(32 - GRAM_BITS)
    return out.astype(np.uint16)


def walk_starts(buffer: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Places where a word begins behind a space or a text, and every character of scripts that don't space words."""
    word = buffer > 32
    first = word.copy()
    first[1:] &= ~word[:-1]
    begins = begins[begins < len(buffer)]
    first[begins] = word[begins]
    high = np.flatnonzero(buffer >= 0xE0)
    if len(high):
        a, b = buffer[high], buffer[np.minimum(high + 1, len(buffer) - 1)]
        # Thai and Lao; Burmese and Khmer; from kana to Hangul; further ideographs.
        bare = ((a == 0xE0) & (b >= 0xB8) & (b <= 0xBB)) | ((a == 0xE1) & ((b <= 0x82) | (b == 0x9E) | (b == 0x9F))) | ((a >= 0xE3) & (a <= 0xED)) | ((a == 0xF0) & (b >= 0xA0))
        first[high[bare]] = True
    return np.flatnonzero(first).astype(np.int32)


class Pieces:
    """Items of up to SHORT characters, found by unchanged pieces."""

    def __init__(self, items: list[tuple[int, str]], max_share: float):
        import ahocorasick

        self.items = items
        self.limit = np.array([int(max_share * len(n)) for _, n in items], np.int64)
        self.sizes = np.array([len(n) for _, n in items], np.int64)
        held: dict[str, list[tuple[int, int]]] = {}
        for i, (_, n) in enumerate(items):
            cuts = np.linspace(0, len(n), int(self.limit[i]) + 2).astype(int).tolist()
            for a, b in zip(cuts[:-1], cuts[1:]):
                held.setdefault(n[a:b], []).append((i, b))
        self.machine = ahocorasick.Automaton()
        for piece, where in held.items():
            self.machine.add_word(piece, where)
        self.machine.make_automaton()
        alphabet = sorted(set("".join(n for _, n in items)))
        self.alphabet = np.array([ord(c) for c in alphabet], np.uint32)
        self.masks = np.zeros((len(items), len(alphabet) + 1), np.uint64)
        place = {c: k for k, c in enumerate(alphabet)}
        for i, (_, n) in enumerate(items):
            for j, c in enumerate(n):
                self.masks[i, place[c]] |= np.uint64(1 << j)

    def found(self, text: str) -> list[tuple[int, int]]:
        """Each item that the text holds within its limit, with the least distance."""
        spans: dict[tuple[int, int], None] = {}
        for end, where in self.machine.iter(text):
            for i, b in where:
                spans[i, end + 1 - b] = None
        best: dict[int, int] = {}
        every = list(spans)
        for k in range(0, len(every), 100_000):
            part = np.array(every[k : k + 100_000], np.int64)
            for i, d in zip(part[:, 0].tolist(), self._distances(text, part[:, 0], part[:, 1]).tolist()):
                if d <= self.limit[i] and d < best.get(i, 1 << 30):
                    best[i] = d
        return sorted(best.items())

    def _distances(self, text: str, item: np.ndarray, start: np.ndarray) -> np.ndarray:
        """The least distance of each item to a stretch of its window, by Myers' vectors for all of them at once."""
        points = np.frombuffer(text.encode("utf-32-le"), np.uint32)
        at = np.searchsorted(self.alphabet, points)
        codes = np.append(np.where(self.alphabet[np.minimum(at, len(self.alphabet) - 1)] == points, at, len(self.alphabet)), len(self.alphabet))
        size, limit, one = self.sizes[item], self.limit[item], np.uint64(1)
        top = one << (size - 1).astype(np.uint64)
        plus, minus, score = top | (top - one), np.zeros(len(item), np.uint64), size.copy()
        best = size.copy()
        for t in range(int((size + 4 * limit).max()) + 1):
            where = start - 2 * limit + t
            inside = (where >= 0) & (where < len(points)) & (t <= size + 4 * limit)
            eq = self.masks[item, codes[np.where(inside, where, len(points))]]
            zero = (((eq & plus) + plus) ^ plus) | eq | minus
            up, down = minus | ~(zero | plus), plus & zero
            score += np.where(up & top, 1, 0) - np.where(down & top, 1, 0)
            up, down = up << one, down << one
            plus, minus = down | ~(zero | up), up & zero
            np.minimum(best, score, out=best)
        return best


class Items:
    """Everything that a worker needs to search for a block of items."""

    def __init__(self, items: tuple[tuple[int, str], ...], max_share: float, recall: float):
        own = [(i, n) for i, t in items if (n := normal(t))]
        short, rest = [x for x in own if len(x[1]) <= SHORT], [x for x in own if len(x[1]) > SHORT]
        self.pieces = Pieces(short, max_share) if short else None
        self.index = Index(rest, max_share, recall) if rest else None

    def found(self, texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
        """Place of the text, item_id, distance and characters of each item that a text holds."""
        texts = [normal(t) for t in texts]
        if self.index is not None:
            yield from self._walked(texts)
        if self.pieces is not None:
            for d, text in enumerate(texts):
                for i, distance in self.pieces.found(text):
                    yield d, self.pieces.items[i][0], distance, int(self.pieces.sizes[i])

    def _walked(self, texts: list[str]) -> Iterator[tuple[int, int, int, int]]:
        index, raws = self.index, [t.encode() for t in texts]
        ends = np.cumsum([len(r) for r in raws])
        begins = ends - [len(r) for r in raws]
        raw = b"".join(raws)
        buffer = np.frombuffer(raw + bytes(STRATA[-1] + DEEP + 1), np.uint8)
        at, walk = index.candidates(buffer, walk_starts(buffer[: len(raw)], begins))
        doc, item = np.searchsorted(ends, at, "right"), index.owner[walk].astype(np.int64)
        start = at - index.offset[walk]
        order = np.lexsort((start, doc, item))
        grams = gram_hashes(buffer)
        best: dict[tuple[int, int], int] = {}
        tried: set[tuple[int, int, int]] = set()
        held = np.zeros(1 << GRAM_BITS, bool)
        for d, i, x in zip(doc[order].tolist(), item[order].tolist(), start[order].tolist()):
            limit = index.limit[i]
            # Edits in front of the key shift the start by limit characters at most. A start within half of what the slack
            # adds to that lies in the same window as one that was tried.
            slack = 2 * -(-limit * int(index.sizes[i]) // len(index.items[i][1])) + 32
            if best.get((d, i)) == 0 or (d, i, x // (slack // 2 + 1)) in tried:
                continue
            tried.add((d, i, x // (slack // 2 + 1)))
            a, b = max(int(begins[d]), x - slack), min(int(ends[d]), x + int(index.sizes[i]) + slack)
            own, there = index.grams[index.begins[i] : index.begins[i] + int(index.sizes[i]) - GRAM + 1], grams[a : b - GRAM + 1]
            held[there] = True
            shared = np.count_nonzero(held[own])
            held[there] = False
            if shared < index.least[i]:
                continue
            found = distance_within(index.items[i][1], raw[a:b].decode("utf-8", "ignore"))
            if found <= limit and found < best.get((d, i), limit + 1):
                best[d, i] = found
        for (d, i), x in sorted(best.items()):
            yield d, index.items[i][0], x, len(index.items[i][1])


_KNOWN: dict[int, Items] = {}


def _items(sent, max_share: float, recall: float) -> Items:
    """The index of a broadcast, built once in each worker, which keeps the last one."""
    if sent.value[0] not in _KNOWN:
        _KNOWN.clear()
        _KNOWN[sent.value[0]] = Items(sent.value[1], max_share, recall)
    return _KNOWN[sent.value[0]]


def item_blocks(benchmark: DataFrame, item_id: str, text: str) -> Iterator[tuple[tuple[int, str], ...]]:
    """Items in blocks of about BLOCK_BYTES characters; those without words or id are left out."""
    block, size = [], 0
    for row in benchmark.select(F.col(item_id).cast("long").alias("i"), F.col(text).alias("t")).where("i IS NOT NULL AND t IS NOT NULL").orderBy("i", "t").toLocalIterator():
        if block and size + len(row.t) > BLOCK_BYTES:
            yield tuple(block)
            block, size = [], 0
        if normal(row.t):
            block.append((row.i, row.t))
            size += len(row.t)
    if block:
        yield tuple(block)


def leaks(docs: DataFrame, benchmark: DataFrame, max_share: float = 0.15, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text", recall: float = 0.97) -> DataFrame:
    """doc_id, item_id, distance and item_chars for each row and item whose passage the row's text holds.

    distance: the least edit distance between the item and a stretch of the text, both normalised, at most max_share of
    the item's characters. recall: of passages damaged by max_share, what keys are laid out for; less damaged ones are
    found more surely, and items of up to SHORT characters always. Rows without doc_id or text match nothing; repeated
    rows match each; very long texts are searched whole; an empty table on either side gives no rows. Clean documents
    don't appear.
    """
    spark = docs.sparkSession
    schema = "doc_id long, item_id long, distance long, item_chars long"
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id IS NOT NULL AND text IS NOT NULL")

    def finder(sent):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            items = _items(sent, max_share, recall)
            for batch in sliced(batches, "text"):
                hits = list(items.found(batch.column("text").to_pylist()))
                if hits:
                    ids = batch.column("doc_id").to_pylist()
                    columns = [[ids[h[0]] for h in hits], *([h[k] for h in hits] for k in (1, 2, 3))]
                    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "item_id", "distance", "item_chars"])

        return run

    out = None
    for items in item_blocks(benchmark, item_id, item_text):
        part = rows.mapInArrow(finder(spark.sparkContext.broadcast((hash((items, max_share, recall)), items))), schema)
        out = part if out is None else out.unionByName(part)
    return spark.createDataFrame([], schema) if out is None else out
