"""Shards of equal row counts with few equal texts apart, by balanced label propagation.

Copies of a text are linked. Every row starts in a shard by its place in a hash order, which leaves the shards' row
counts at most one apart. In each round the members of a group of copies look at where most of them are, and ask to
move there. Requests from shard a to shard b are granted up to a quota: as many as rows come back from b to a, be it on
request or as volunteers, rows without copies who don't mind. So counts never change, and every granted request takes
away cut links. Rounds end when no more is granted, as they must: each one leaves fewer cut links.

A group larger than a part of a shard is first dealt into clans of bounded size by a hash; each clan then gathers for
itself, so that the hot text of a third of all rows fills shard after shard instead of asking for one in vain.

Quotas are a matrix of shards by shards, and grants are ranks: counts by (move, class, bucket) give each bucket's base,
and a row's place within its bucket does the rest. Nothing is sorted as a whole, and only that matrix comes to the driver.
"""

from __future__ import annotations

from collections import defaultdict
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from terrace.llm._spark import sized_join, written

#: Clans hold at most one part in so many of a shard.
CLAN_SHARE = 2
#: Rows that a bucket of a ranking holds, about.
BUCKET_ROWS = 20_000
EXTRA = 8


def ranked(rows: DataFrame, by: list[str], order: list[str], name: str, buckets: int, salt: int, level: Column | None = None) -> DataFrame:
    """rows with name: gapless places from 0 within each value of by, in the order of (level, bucket, order).

    Buckets are hashes of order; each is sorted alone, and its base is the sum of the counts of the buckets before it.
    Rows of a lower level (0 by default) come before all others, however many buckets there are.
    """
    hashed = F.pmod(F.xxhash64(F.lit(salt), *order), F.lit(buckets))
    spread = rows.withColumn("_b", (F.lit(0) if level is None else level.cast("long")) * buckets + hashed)
    before = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    counts = spread.groupBy(*by, "_b").agg(F.count(F.lit(1)).alias("_n"))
    bases = counts.select(*by, "_b", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_base"))
    inner = Window.partitionBy(*by, "_b").orderBy(*order)
    placed = spread.withColumn("_r", F.row_number().over(inner) - 1)
    return placed.join(bases, [*by, "_b"]).withColumn(name, (F.col("_base") + F.col("_r")).cast("long")).drop("_b", "_r", "_base")


def _quotas(wanted: dict[tuple[int, int], int], volunteers: dict[int, int]) -> tuple[dict[tuple[int, int], int], dict[int, list[tuple[int, int]]]]:
    """Grants for each move a -> b, and how many volunteers of b go to each a to make up for them."""
    open_ = dict(volunteers)
    grants, back = {}, defaultdict(list)
    for (a, b), n in sorted(wanted.items(), key=lambda x: (-x[1], x[0])):
        straight = min(n, wanted.get((b, a), 0))
        extra = min(n - straight, open_.get(b, 0))
        open_[b] = open_.get(b, 0) - extra
        if straight + extra:
            grants[a, b] = straight + extra
        if extra:
            back[b].append((a, extra))
    return grants, back


def sharded(docs: DataFrame, shards: int = 24, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard and group_rows of each row.

    size: UTF-8 bytes of the text plus 8; a null text has none, and crc32 0 as an empty one, but is no copy of one.
    law: 'rows', counts at most one apart. slot: the row's place in its shard, from 0. grown_shard: null under this law.
    group_rows: rows of the same text. Rows that agree in doc_id and text may change places with each other, no more.
    Rows without doc_id are placed like others. Very long texts count by their bytes, which this law doesn't weigh.
    An empty table gives no rows.
    """
    key = F.xxhash64(F.lit(1), F.col(text))
    read = docs.select(
        F.col(doc_id).cast("long").alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 8).cast("long").alias("size"),
        F.crc32(F.coalesce(F.col(text), F.lit("")).cast("binary")).alias("text_crc32"),
        F.when(F.col(text).isNotNull(), key).otherwise(F.xxhash64(F.lit(2), doc_id)).alias("copy"),
        F.xxhash64(F.lit(3), F.col(text)).alias("copy_too"),
    )
    rows = written(read, "texts")
    n = rows.count()
    buckets = max(1, n // (shards * BUCKET_ROWS) + 1)
    groups = rows.groupBy("copy", "copy_too").agg(F.count(F.lit(1)).alias("group_rows"))
    limit = max(2, n // (shards * CLAN_SHARE))
    linked = groups.where("group_rows > 1").withColumn("clans", F.ceil(F.col("group_rows") / limit))
    linked = written(linked, "groups")
    start = rows.withColumn("all", F.lit(0))
    start = ranked(start, ["all"], ["doc_id", "copy", "copy_too"], "place", buckets * shards, 5)
    known = sized_join(start, linked, ["copy", "copy_too"], "left").select(
        "place", "doc_id", "size", "text_crc32", F.coalesce("group_rows", F.lit(1)).alias("group_rows"),
        F.when(F.col("clans").isNotNull(), F.xxhash64("copy", "copy_too", F.pmod(F.xxhash64(F.lit(9), "place"), F.col("clans")))).alias("clan"),
        F.pmod(F.col("place"), F.lit(shards)).cast("int").alias("shard"),
    )
    now = written(known, "shards")
    for turn in count():
        counts = now.where("clan IS NOT NULL").groupBy("clan", "shard").agg(F.count(F.lit(1)).alias("k"))
        # Most members win; ties go by a hash, not to the low numbers.
        homes = counts.groupBy("clan").agg(F.max_by("shard", F.struct("k", F.xxhash64("clan", "shard"))).alias("home"), F.max("k").alias("there"))
        homes = written(homes, "homes")
        wishes = now.select("place", "clan", "shard").join(homes, "clan", "left").select("place", "shard", F.when(F.col("home") != F.col("shard"), F.col("home")).alias("to"), "clan", F.coalesce("there", F.lit(0)).alias("there"))
        wishes = written(wishes, "wishes")
        matrix = wishes.where("to IS NOT NULL OR clan IS NULL").groupBy("shard", "to").agg(F.count(F.lit(1)).alias("k")).collect()
        wanted = {(r["shard"], r["to"]): r["k"] for r in matrix if r["to"] is not None}
        grants, back = _quotas(wanted, {r["shard"]: r["k"] for r in matrix if r["to"] is None})
        if not grants:
            break
        spark = docs.sparkSession
        granted = spark.createDataFrame([(a, b, k) for (a, b), k in grants.items()], "shard int, to int, quota long")
        # Clans of which most members are there come first, by powers of two: they close soonest.
        asked = ranked(wishes.where("to IS NOT NULL"), ["shard", "to"], ["clan", "place"], "rank", buckets, turn, 63 - F.floor(F.log2("there")))
        moves = asked.join(F.broadcast(granted), ["shard", "to"]).where("rank < quota").select("place", "to")
        if back:
            spans, rows_back = [], []
            for b, list_ in back.items():
                at = 0
                for a, k in list_:
                    rows_back.append((b, a, at, at + k))
                    at += k
                spans.append((b, at))
            spans = spark.createDataFrame(rows_back, "shard int, to int, lo long, hi long")
            free = ranked(wishes.where("clan IS NULL").select("place", "shard"), ["shard"], ["place"], "rank", buckets, 100 + turn)
            back_moves = free.join(F.broadcast(spans), (free["shard"] == spans["shard"]) & (free["rank"] >= spans["lo"]) & (free["rank"] < spans["hi"])).select("place", spans["to"])
            moves = moves.unionByName(back_moves)
        moves = written(moves, "moves")
        now = written(sized_join(now, moves, "place", "left").withColumn("shard", F.coalesce("to", "shard")).drop("to"), "shards")
    out = ranked(now, ["shard"], ["doc_id", "place"], "slot", buckets, 77)
    return out.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"), "group_rows")
