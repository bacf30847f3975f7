"""Near-duplicates by circulant MinHash, banding, and exact Jaccard on full shingle sets.

A text is lower-cased (A to Z) and cut into words between ASCII white space. Its set holds the distinct shingles of
five words; with fewer words, the whole sequence is its one shingle; without words the set is empty and never linked.

Signatures take two permutations of the 32-bit universe only: the first breaks up structure, the second is shifted
by one place for each further coordinate: coordinate k is the least value of second((first(x) - k) mod 2^32).

Copies (equal word sequences) are one node. Nodes that share a band form a bucket:

1. every member is compared with the bucket's least node: as many pairs as rows, however large a bucket is;
2. confirmed links give components. A bucket within one component has nothing left to tell;
3. in the other buckets members of different components are compared in blocks of bounded size by a sketch of their
   signatures. Each member proposes the most similar one of another component; links among these, confirmed on full
   sets, leave few components in a large group of near copies;
4. where a bucket still holds several, its blocks get the members' sets, as 32-bit hashes, and every pair of different
   components is compared on them. Sets beyond SET_MOST shingles are compared by sketches here. Of the pairs that pass
   a block puts out as many as join its components, and these are confirmed on full sets.

So no link that shares a band is left out, no bucket is capped, and a block never puts out more pairs than it has
members, however many copies resemble each other. With 32 bands of 5 rows, two sets at the limit of 0.85 share no band with probability 7e-9; the sketch misses
such a pair with probability below 1e-6.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from terrace.llm._spark import id_filter, sliced, written
from terrace.llm.components import components

SHINGLE = 5
BANDS, ROWS = 32, 5
SKETCH = 128
#: Members of a bucket that are compared as one block.
BLOCK = 512
#: Shingles of the largest set that blocks carry.
SET_MOST = 4096
_U64, _U32 = np.uint64, np.uint32
_FACTORS = np.random.default_rng(20).integers(1, 2**63, 16, dtype=_U64) | _U64(1)


def _mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U64(33))
    x = x * _U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U64(33))


def _permuted(x: np.ndarray, a: int, b: int) -> np.ndarray:
    """A permutation of all 32-bit numbers, in place: odd factors and shifted exclusive ors can be undone."""
    x ^= x >> _U32(16)
    x *= _U32(a)
    x ^= x >> _U32(13)
    x *= _U32(b)
    x ^= x >> _U32(16)
    return x


def word_hashes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of each word of all texts in turn, and where each text's words begin and the last one's end."""
    import xxhash

    words = pc.ascii_split_whitespace(pc.ascii_lower(pc.fill_null(texts, "")))
    coded = words.flatten().dictionary_encode()
    pieces = coded.dictionary.to_pylist()
    known = np.fromiter((xxhash.xxh3_64_intdigest(w) for w in pieces), _U64, len(pieces))
    use = coded.indices.to_numpy(zero_copy_only=False)
    bounds = words.offsets.to_numpy().astype(np.int64)
    bounds -= bounds[0]
    real = np.array([bool(w) for w in pieces], bool)[use] if len(use) else np.zeros(0, bool)
    return known[use[real]] if len(use) else np.zeros(0, _U64), np.concatenate([[0], np.cumsum(real)])[bounds]


def shingle_sets(texts: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each text its distinct shingles, sorted, and its word hashes."""
    words, bounds = word_hashes(texts)
    whole = np.zeros(max(0, len(words) - SHINGLE + 1), _U64)
    for k in range(SHINGLE):
        whole += words[k : k + len(whole)] * _FACTORS[k]
    whole = _mix64(whole)
    for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist()):
        if b - a >= SHINGLE:
            yield np.unique(whole[a : b - SHINGLE + 1]), words[a:b]
        elif b > a:
            yield _mix64((words[a:b] * _FACTORS[8 : 8 + b - a]).sum(keepdims=True, dtype=_U64) + _U64(b - a)), words[a:b]
        else:
            yield np.zeros(0, _U64), words[a:b]


def signature(shingles: np.ndarray, size: int = BANDS * ROWS) -> np.ndarray:
    """The circulant signature of a set that isn't empty."""
    first = _permuted((shingles >> _U64(32)).astype(_U32), 0x7FEB352D, 0x846CA68B)
    shifts = np.arange(size, dtype=_U32)
    best = np.full(size, 0xFFFFFFFF, _U32)
    for at in range(0, len(first), 1024):
        best = np.minimum(best, _permuted(first[at : at + 1024, None] - shifts, 0x21F0AAAD, 0xD35A2D97).min(axis=0))
    return best


def band_keys(signatures: np.ndarray, rows: int = ROWS) -> np.ndarray:
    """One 64-bit key for each band of so many rows; bands never share keys but by chance."""
    bands = signatures.shape[1] // rows
    parts = signatures[:, : bands * rows].reshape(-1, bands, rows).astype(_U64)
    return _mix64((parts * _FACTORS[:rows]).sum(axis=2, dtype=_U64) + np.arange(1, bands + 1, dtype=_U64) * _FACTORS[7]).astype(np.int64)


def signed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rows: int = ROWS) -> DataFrame:
    """doc_id, a 128-bit key of the word sequence, n_shingles, band keys and sketch (null without words) of each row."""
    schema = "doc_id long, key_a long, key_b long, n_shingles long, bands array<long>, sketch binary"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        for batch in sliced(batches, "text", 2_000_000):
            keys, sizes, signatures = [], [], []
            for shingles, words in shingle_sets(batch.column("text")):
                raw = words.tobytes()
                keys.append((xxhash.xxh3_64_intdigest(raw, 1), xxhash.xxh3_64_intdigest(raw, 2)))
                sizes.append(len(shingles))
                if len(shingles):
                    signatures.append(signature(shingles))
            some = np.array(sizes) > 0
            every = np.array(signatures, _U32).reshape(-1, BANDS * ROWS)
            at = np.concatenate([[0], np.cumsum(some)]).astype(np.int32)
            keyed = band_keys(every, rows)
            bands = pa.ListArray.from_arrays(pa.array(at * keyed.shape[1], pa.int32()), pa.array(keyed.ravel()))
            sketches = iter([row.tobytes() for row in every[:, :SKETCH].astype(np.uint8)])
            both = np.array(keys, _U64).reshape(-1, 2).astype(np.int64)
            yield pa.RecordBatch.from_pydict(
                {"doc_id": batch.column("doc_id"), "key_a": pa.array(both[:, 0]), "key_b": pa.array(both[:, 1]), "n_shingles": pa.array(sizes, pa.int64()), "bands": bands, "sketch": pa.array([next(sketches) if x else None for x in some], pa.binary())}
            )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(run, schema)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int) -> DataFrame:
    """Of pairs (a, b) of doc_ids those whose sets have 100 * intersection >= percent * union, by their whole texts."""
    ids = written(pairs.select(F.col("a").alias("doc_id")).unionByName(pairs.select(F.col("b").alias("doc_id"))).distinct(), "ids")
    needed = id_filter(texts, ids, "doc_id", "left_semi")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, own = None, None
        for batch in (b for x in batches for b in sliced([x], "text_b")):
            keep = []
            lefts = batch.column("text_a").to_pylist()
            for left, (other, _) in zip(lefts, shingle_sets(batch.column("text_b"))):
                if left != last:
                    last, own = left, next(shingle_sets(pa.array([left], pa.string())))[0]
                at = np.searchsorted(own, other)
                both = int((own[np.minimum(at, len(own) - 1)] == other).sum()) if len(own) else 0
                keep.append(both > 0 and 100 * both >= percent * (len(own) + len(other) - both))
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    with_b = pairs.join(needed.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
    with_both = with_b.join(needed.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a")
    return with_both.select("a", "b", "text_a", "text_b").mapInArrow(run, "a long, b long")


def short_sets(texts: DataFrame) -> DataFrame:
    """node and its sorted set as 32-bit hashes, null beyond SET_MOST shingles, for rows of doc_id and text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b for x in batches for b in sliced([x], "text")):
            sets = [(s >> _U64(32)).astype("<u4").tobytes() if len(s) <= SET_MOST else None for s, _ in shingle_sets(batch.column("text"))]
            yield pa.RecordBatch.from_pydict({"node": batch.column("doc_id"), "short": pa.array(sets, pa.binary())})

    return texts.mapInArrow(run, "node long, short binary").groupBy("node").agg(F.first("short").alias("short"))


def _blocks(rows: DataFrame) -> DataFrame:
    """Members of each two blocks of a bucket in one row, so that members of different components meet once.

    A component of BLOCK members or more has blocks of its own, which never meet each other; smaller ones are pooled. So
    a large component and a few others make as many rows as there are members. A row is as large as two blocks.
    """
    whole = lambda x: F.ceil(x / BLOCK).cast("int")
    large = F.col("k") >= BLOCK
    pooled = whole(F.col("pooled"))
    before = F.aggregate(F.filter("larges", lambda x: x["component"] < F.col("component")), F.lit(0), lambda s, x: s + whole(x["k"]))
    every = F.aggregate("larges", pooled, lambda s, x: s + whole(x["k"]))
    own = rows.withColumn("base", F.when(large, pooled + before).otherwise(0)).withColumn("size", F.when(large, whole(F.col("k"))).otherwise(pooled)).withColumn("every", every)
    own = own.withColumn("own", F.col("base") + F.pmod(F.xxhash64("node"), F.col("size")).cast("int"))
    others = F.filter(F.sequence(F.lit(0), F.col("every") - 1), lambda o: ~large | (o < F.col("base")) | (o >= F.col("base") + F.col("size")))
    fields = [c for c in rows.columns if c in ("node", "component", "sketch", "short")]
    dealt = own.select("bucket", *fields, "own", F.explode(others).alias("other"))
    return dealt.groupBy("bucket", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")).agg(F.collect_list(F.struct(*fields)).alias("members")).select("members")


def _opened(members: pa.Scalar) -> tuple[np.ndarray, np.ndarray, np.ndarray, list]:
    flat = members.values
    node, comp = (flat.field(c).to_numpy(zero_copy_only=False) for c in ("node", "component"))
    sketch = np.frombuffer(b"".join(flat.field("sketch").to_pylist()), np.uint8).reshape(len(node), SKETCH)
    return node, comp.copy(), sketch, flat.field("short").to_pylist() if flat.type.get_field_index("short") >= 0 else []


def _pairs(node: np.ndarray, left: list[int], right: list[int]) -> pa.RecordBatch:
    a, b = node[np.array(left, np.int64)], node[np.array(right, np.int64)]
    return pa.RecordBatch.from_pydict({"a": pa.array(np.minimum(a, b), pa.int64()), "b": pa.array(np.maximum(a, b), pa.int64())})


def best_partners(rows: DataFrame, least_equal: int) -> DataFrame:
    """Pairs a < b: for each member of a block the one of another component whose sketch agrees most, in least_equal places."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members in (m for batch in batches for m in batch.column("members")):
            node, comp, sketch, _ = _opened(members)
            left, right = [], []
            for i in range(len(node)):
                apart = np.flatnonzero(comp != comp[i])
                if len(apart):
                    equal = (sketch[apart] == sketch[i]).sum(axis=1)
                    if equal.max() >= least_equal:
                        left.append(i)
                        right.append(int(apart[equal.argmax()]))
            yield _pairs(node, left, right)

    return _blocks(rows).mapInArrow(run, "a long, b long").distinct()


def joining_pairs(rows: DataFrame, least_equal: int, percent: int) -> DataFrame:
    """Pairs a < b that join the components of a block, of all its pairs that reach percent on their short sets.

    Pairs with a set that is too long for that come out if their sketches agree in least_equal places.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for members in (m for batch in batches for m in batch.column("members")):
            node, comp, sketch, short = _opened(members)
            known = np.array([s is not None for s in short])
            sizes = np.array([len(s) // 4 if s else 0 for s in short])
            values, place = np.unique(np.frombuffer(b"".join(s or b"" for s in short), "<u4"), return_inverse=True)
            ends = np.cumsum(sizes)
            left, right = [], []
            for i in range(len(node) - 1):
                apart = comp[i + 1 :] != comp[i]
                if not apart.any():
                    continue
                if known[i]:
                    own = np.zeros(len(values), np.int64)
                    own[place[ends[i] - sizes[i] : ends[i]]] = 1
                    sums = np.concatenate([[0], np.cumsum(own[place[ends[i] :]])])
                    both = np.diff(sums[ends[i:] - ends[i]])
                    sure = known[i + 1 :] & apart & (100 * both >= percent * (sizes[i] + sizes[i + 1 :] - both))
                    for j in (np.flatnonzero(sure) + i + 1).tolist():
                        if comp[j] != comp[i]:
                            left.append(i)
                            right.append(j)
                            comp[comp == comp[j]] = comp[i]
                other = np.flatnonzero((comp[i + 1 :] != comp[i]) & ~(known[i + 1 :] & known[i])) + i + 1
                hit = other[(sketch[other] == sketch[i]).sum(axis=1) >= least_equal]
                left += [i] * len(hit)
                right += hit.tolist()
            yield _pairs(node, left, right)

    return _blocks(rows).mapInArrow(run, "a long, b long").distinct()


def near_duplicates(docs: DataFrame, percent: int = 85, doc_id: str = "doc_id", text: str = "text", rows: int = ROWS, blocks: bool = True) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of each row; links reach percent, and share a band of so many rows.

    Without blocks, members of a bucket are compared with its least node only: enough to tell groups of copies, which
    resemble each other all around, and cheaper.

    component_id: the least doc_id that is reachable over links; kept: doc_id is that one. Rows without words are
    linked with nothing. Rows of one doc_id count as one node; rows without doc_id have no component_id and are kept.
    Very long texts count with all their shingles. Equal signatures are one node, named by its least doc_id. An empty table
    gives no rows.
    """
    base = written(signed(docs, doc_id, text, rows), "signed")
    usable = base.where(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0))
    nodes = written(usable.groupBy("key_a", "key_b").agg(F.min("doc_id").alias("node"), F.first("bands").alias("bands"), F.first("sketch").alias("sketch")), "nodes")
    placed = nodes.select("node", F.explode("bands").alias("bucket"))
    # A table of its own, so that the join isn't bound to the aggregation's partitions and hot buckets are split.
    buckets = written(placed.groupBy("bucket").agg(F.min("node").alias("leader"), F.count(F.lit(1)).alias("n")).where("n > 1"), "buckets")
    members = written(placed.join(buckets, "bucket"), "members")
    texts = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    stars = written(members.where("node <> leader").select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "stars")
    links = written(confirmed(stars, texts, percent), "links")
    labels = components(links)
    # At the limit p, places of a sketch agree with probability p + (1 - p) / 256; five deviations below the mean.
    p = percent / 100
    least = int(SKETCH * p - 5 * (SKETCH * p * (1 - p)) ** 0.5)
    tested = stars

    def open_members() -> DataFrame:
        """Members of the buckets that hold several components, with the sizes of these."""
        left = written(members.where("n > 2").join(labels, "node", "left").select("bucket", "node", F.coalesce("component", "node").alias("component")), "labelled")
        sizes = written(left.groupBy("bucket", "component").agg(F.count(F.lit(1)).alias("k")), "sizes")
        pool = F.coalesce(F.sum(F.when(F.col("k") < BLOCK, F.col("k"))), F.lit(0)).alias("pooled")
        # A bucket has one entry for each BLOCK of its members at most.
        larges = F.sort_array(F.collect_list(F.when(F.col("k") >= BLOCK, F.struct("component", "k")))).alias("larges")
        open_ = written(sizes.groupBy("bucket").agg(F.count(F.lit(1)).alias("c"), pool, larges).where("c > 1").join(sizes, "bucket").drop("c"), "open-sizes")
        return left.join(open_, ["bucket", "component"]).join(nodes.select("node", "sketch"), "node")

    def linked(pairs: DataFrame) -> None:
        nonlocal links, labels, tested
        more = written(pairs.join(tested, ["a", "b"], "left_anti"), "pairs")
        if not more.isEmpty():
            links = written(links.unionByName(confirmed(more, texts, percent)), "links")
            tested = tested.unionByName(more)
            labels = components(links)

    if blocks:
        linked(best_partners(open_members(), least))
    still = written(open_members(), "open") if blocks else None
    if blocks and not still.isEmpty():
        wanted = written(still.select(F.col("node").alias("doc_id")).distinct(), "ids")
        linked(joining_pairs(still.join(short_sets(id_filter(texts, wanted, "doc_id", "left_semi")), "node"), least, percent))

    named = nodes.join(labels, "node", "left").select("key_a", "key_b", F.coalesce("component", "node").alias("component"))
    found = base.select("doc_id", "key_a", "key_b", "n_shingles").join(named, ["key_a", "key_b"], "left")
    linked = F.when(F.col("doc_id").isNotNull() & (F.col("n_shingles") > 0), F.col("component"))
    component = F.coalesce(linked, F.col("doc_id"))
    return found.select("doc_id", "n_shingles", component.alias("component_id"), F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))
