"""Conversation prefix trie by partition refinement.

A node is a sequence of first turns that conversations share; its class are the conversations that begin with it. The
root's class has all of them. A round splits each active class by its members' next turn, so that a class of the next
depth is one node. Copies of a whole conversation are one member with a count, found beforehand by a digest. A class
with one member left is retired: the rest of that member is a chain of nodes with one child each, whose figures follow
from the member alone and need no rounds. So there are as many rounds as turns are shared by two different conversations.
At the end figures are folded back from the deepest level of classes to the root.

A class is named by its least conversation, which with the depth tells nodes apart. Every round's members and classes are
written tables; a round is a join with the turns of one place, which are together in their files, and one aggregation
that combines before it shuffles, so that a class with a third of all conversations is no task of its own. Places of
turns and running sums of bytes come from range partitions and the sums of those before, so a conversation with a third
of all rows isn't one either.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm._spark import sized_join, written

#: Head turns are fewer than this many.
MOST_HEAD = 9
#: Conversations whose numbers are joined to one text before they are hashed.
PIECE_IDS = 4096
#: SHA-256 of no conversations.
NO_ENDS = hashlib.sha256(b"").hexdigest()


def _head(conv_id: Column) -> Column:
    return F.crc32(conv_id.cast("string").cast("binary")) % MOST_HEAD


def _placed(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """conv_id, pos from 0, key (what tells turns apart) and upto, the bytes of the conversation's texts up to there."""
    role_, text_ = F.coalesce(F.col(role).cast("string"), F.lit("")), F.coalesce(F.col(text).cast("string"), F.lit(""))
    rows = turns.where(F.col(conv_id).isNotNull()).select(
        F.col(conv_id).cast("long").alias("conv_id"),
        F.col(turn).cast("long").alias("turn"),
        F.unhex(F.md5(F.concat(F.length(role_).cast("string"), F.lit(":"), role_, text_))).alias("key"),
        F.octet_length(text_).cast("long").alias("bytes"),
    )
    order = ["conv_id", F.asc_nulls_first("turn"), "key"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, n, total = TaskContext.get().partitionId(), 0, 0
        for batch in batches:
            if batch.num_rows:
                sums = total + np.cumsum(batch.column("bytes").to_numpy())
                places = n + np.arange(batch.num_rows)
                n, total = n + batch.num_rows, int(sums[-1])
                columns = [batch.column("conv_id"), batch.column("key"), batch.column("bytes"), pa.array([part] * batch.num_rows, pa.int32()), pa.array(places), pa.array(sums)]
                yield pa.RecordBatch.from_arrays(columns, ["conv_id", "key", "bytes", "part", "place", "sum"])

    dealt = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    local = written(dealt.mapInArrow(run, "conv_id long, key binary, bytes long, part int, place long, sum long"), "turns")
    # As many rows as partitions.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ends = local.groupBy("part").agg((F.max("place") + 1).alias("n"), F.max("sum").alias("s"))
    bases = ends.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("n"), F.coalesce(F.sum("s").over(before), F.lit(0)).alias("s"))
    return local.join(F.broadcast(bases), "part").select("conv_id", "key", "bytes", (F.col("place") + F.col("n")).alias("place"), (F.col("sum") + F.col("s")).alias("sum"))


def _rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The turns of every rebuilt conversation, with rest, the bytes from there to its end; and the conversations.

    A conversation takes its first turns, fewer than MOST_HEAD, from the one whose number is its own without the last
    fifth, and goes on with its own after as many.
    """
    convs = written(turns.groupBy("conv_id").agg(F.min("place").alias("first"), F.count(F.lit(1)).alias("n"), F.min(F.col("sum") - F.col("bytes")).alias("zero"), F.max("sum").alias("end")), "conversations")
    named = convs.select(F.col("conv_id").alias("conv_id"), "first", "n", "end", _head(F.col("conv_id")).alias("h"), (F.col("conv_id") - F.col("conv_id") % 5).alias("base"))
    bases = convs.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    plan = written(named.join(bases, "base", "left").withColumn("taken", F.least("h", F.coalesce("base_n", F.lit(0)))), "plan")
    own = turns.join(plan.select("conv_id", "first", "h", "taken", "end"), "conv_id").withColumn("pos", F.col("place") - F.col("first"))
    placed = written(own.select("conv_id", "key", "bytes", "pos", "h", "taken", (F.col("end") - F.col("sum") + F.col("bytes")).alias("rest")), "placed")
    kept = placed.where("pos >= h").select("conv_id", "key", "bytes", (F.col("pos") - F.col("h") + F.col("taken")).alias("pos"), "rest")
    # Bytes of a conversation's own turns after its head: those from the turn at h on.
    tails = placed.where("pos = h").select("conv_id", F.col("rest").alias("tail"))
    heads = placed.where(f"pos < {MOST_HEAD} AND conv_id % 5 = 0").select(F.col("conv_id").alias("base"), "key", "bytes", "pos")
    given = plan.select("conv_id", "base", "taken").where("taken > 0").join(heads, "base").where("pos < taken").join(tails, "conv_id", "left")
    # At most MOST_HEAD rows of each.
    onward = Window.partitionBy("conv_id").orderBy(F.desc("pos"))
    first = given.select("conv_id", "key", "bytes", "pos", (F.sum("bytes").over(onward) + F.coalesce("tail", F.lit(0))).alias("rest"))
    return kept.unionByName(first), plan.select("conv_id")


def _ends(members: DataFrame) -> DataFrame:
    """digest, ends: SHA-256 of the numbers of the conversations of each digest, ascending, with commas between.

    A hash is a chain, so one task makes each; it reads texts of PIECE_IDS numbers, one after another.
    """

    def joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, piece, now, ids = TaskContext.get().partitionId(), 0, None, []

        def out() -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([part], pa.int32()), pa.array([piece], pa.int64()), pa.array([",".join(map(str, ids))])], ["digest", "part", "piece", "ids"])

        for batch in batches:
            for digest, conv in zip(batch.column("digest").to_pylist(), batch.column("conv_id").to_pylist(), strict=True):
                if ids and (digest != now or len(ids) == PIECE_IDS):
                    yield out()
                    piece, ids = piece + 1, []
                now = digest
                ids.append(conv)
        if ids:
            yield out()

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts = ((d, t) for b in batches for d, t in zip(b.column("digest").to_pylist(), b.column("ids").to_pylist(), strict=True))
        digests, ends = [], []
        for digest, group in groupby(texts, lambda x: x[0]):
            state = hashlib.sha256(next(group)[1].encode())
            for _, t in group:
                state.update(b"," + t.encode())
            digests.append(digest)
            ends.append(state.hexdigest())
            if len(ends) == 10_000:
                yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(ends)], ["digest", "ends"])
                digests, ends = [], []
        yield pa.RecordBatch.from_arrays([pa.array(digests, pa.binary()), pa.array(ends, pa.string())], ["digest", "ends"])

    order = ["digest", "conv_id"]
    pieces = members.select(*order).repartitionByRange(*order).sortWithinPartitions(*order).mapInArrow(joined, "digest binary, part int, piece long, ids string")
    dealt = written(pieces, "pieces").repartition("digest").sortWithinPartitions("digest", "part", "piece")
    return dealt.mapInArrow(hashed, "digest binary, ends string")


def prefix_trie(turns: DataFrame, conv_id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The trie of rebuilt conversations, a row for each node.

    conv_id: the node's least member; depth; parent_conv_id: the parent's conv_id, null for the root; n_convs; n_children;
    n_leaves: nodes without children in its subtree, which holds the node itself; saved_tokens: over the subtree, n_convs - 1
    times the UTF-8 bytes of the last text; ends_sha256: of the conversations that end there.

    Turns go by number, null first; equal numbers, as of repeated rows, by a digest of role and text. Null roles and texts
    are empty. Rows without conv_id belong to no conversation. Long texts and long conversations are taken whole. An empty
    table has no nodes, not even a root. Other columns don't matter.
    """
    rebuilt, convs = _rebuilt(_placed(turns, conv_id, turn, role, text))
    every = written(rebuilt.repartition("conv_id").sortWithinPartitions("pos"), "rebuilt")
    # 128 bits that sum over the turns, so that no task reads a conversation whole.
    digest = F.concat(*(F.coalesce(F.sum(F.xxhash64(F.lit(seed), "pos", "key").cast("decimal(38,0)")), F.lit(0)).cast("string") for seed in (1, 2)))
    digests = convs.join(every.groupBy("conv_id").agg(digest.alias("d"), F.count(F.lit(1)).alias("len")), "conv_id", "left")
    members = written(digests.select("conv_id", F.unhex(F.md5(F.concat_ws("/", F.coalesce("d", F.lit("")), F.coalesce("len", F.lit(0))))).alias("digest"), F.coalesce("len", F.lit(0)).alias("len")), "members")
    copies = members.groupBy("digest").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n"), F.max("len").alias("len"))
    reps = written(copies.join(_ends(members), "digest").select("conv_id", "n", "len", "ends"), "copies")

    root = reps.agg(F.min("conv_id").alias("name"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k")).where("k > 0").select(F.lit(0).cast("long").alias("parent"), "name", "n", "k", F.lit(0).cast("long").alias("bytes"))
    levels, ended, retired = [written(root, "level")], [], []
    # The root's one row; an empty table has none.
    top = levels[0].select("name").first()
    now = reps.select("conv_id", "n", F.lit(top[0] if top else None).cast("long").alias("class"))
    while True:
        depth = len(levels) - 1
        after = every.where(F.col("pos") == depth).select("conv_id", "key", "bytes")
        split = written(now.join(after, "conv_id", "left").select("conv_id", "n", "class", "key", "bytes"), "split")
        ended.append(split.where("key IS NULL").select("conv_id", F.col("class").alias("name"), F.lit(depth).cast("long").alias("depth")))
        parts = split.where("key IS NOT NULL").groupBy("class", "key").agg(F.min("conv_id").alias("name"), F.sum("n").alias("n"), F.count(F.lit(1)).alias("k"), F.max("bytes").alias("bytes"))
        level = written(parts.select(F.col("class").alias("parent"), "key", "name", "n", "k", "bytes"), "level")
        levels.append(level)
        retired.append(level.where("k = 1").select("parent", F.col("name").alias("conv_id"), F.lit(depth).cast("long").alias("from_pos")))
        if not level.where("k > 1").head(1):
            break
        going = level.where("k > 1").select(F.col("parent").alias("class"), "key", F.col("name").alias("next"))
        now = sized_join(split.where("key IS NOT NULL").select("conv_id", "n", "class", "key"), going, ["class", "key"], "inner").select("conv_id", "n", F.col("next").alias("class"))

    def union(parts: list[DataFrame]) -> DataFrame:
        out = parts[0]
        for p in parts[1:]:
            out = out.unionByName(p)
        return out

    singles = written(union(retired), "retired")
    chains = every.join(singles.join(reps, "conv_id"), "conv_id").where("pos >= from_pos")
    tails = written(
        chains.select(
            "conv_id",
            (F.col("pos") + 1).alias("depth"),
            F.when(F.col("pos") == F.col("from_pos"), F.col("parent")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
            F.col("n").alias("n_convs"),
            (F.col("pos") + 1 < F.col("len")).cast("long").alias("n_children"),
            F.lit(1).cast("long").alias("n_leaves"),
            ((F.col("n") - 1) * F.col("rest")).alias("saved_tokens"),
            F.when(F.col("pos") + 1 == F.col("len"), F.col("ends")).otherwise(F.lit(NO_ENDS)).alias("ends_sha256"),
            "from_pos",
        ),
        "tails",
    )
    # From the deepest level: what a level's nodes hand to their parents.
    heads = tails.where("depth = from_pos + 1").select("depth", F.col("parent_conv_id").alias("parent"), "n_leaves", "saved_tokens")
    stops = written(union(ended).join(reps.select("conv_id", "ends"), "conv_id").select("name", "depth", "ends"), "stops")
    folded, below = [], None
    for depth in range(len(levels) - 1, -1, -1):
        classes = levels[depth].where("k > 1 OR parent IS NULL" if depth else "true")
        given = heads.where(F.col("depth") == depth + 1).select("parent", "n_leaves", "saved_tokens")
        if below is not None:
            given = given.unionByName(below.select("parent", "n_leaves", "saved_tokens"))
        sums = given.groupBy("parent").agg(F.count(F.lit(1)).alias("c"), F.sum("n_leaves").alias("l"), F.sum("saved_tokens").alias("s")).withColumnRenamed("parent", "name")
        nodes = classes.join(sums, "name", "left").select("name", "parent", "n", F.coalesce("c", F.lit(0)).alias("n_children"), F.coalesce("l", F.lit(1)).alias("n_leaves"), (F.coalesce("s", F.lit(0)) + (F.col("n") - 1) * F.col("bytes")).alias("saved_tokens"))
        below = written(nodes.withColumn("depth", F.lit(depth).cast("long")), "folded")
        folded.append(below)
    inner = union(folded).join(stops, ["name", "depth"], "left").select(
        F.col("name").alias("conv_id"), "depth", F.when(F.col("depth") > 0, F.col("parent")).alias("parent_conv_id"), F.col("n").alias("n_convs"), "n_children", "n_leaves", "saved_tokens", F.coalesce("ends", F.lit(NO_ENDS)).alias("ends_sha256")
    )
    return inner.unionByName(tails.drop("from_pos"))
