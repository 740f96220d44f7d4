"""Balanced label propagation: documents that share links move to one shard, sizes stay even.

Links are a table (id, link): documents with the same link are neighbours, so an ordinary edge is
a link with two members and a group of copies is one link, without any pairs. Every round counts
the members of each link by shard (one row a link, pre-aggregated before the shuffle), and each
document prefers the shard where most of its neighbours are. Of those who would move from shard s
to shard t, the share is let go that keeps every shard within its quota: an exchange of equal
numbers between s and t, plus the room that t still has. Members of one link draw the same lot,
so they travel together.

A last pass makes counts exact (the law ``rows``: at most one apart). Documents are numbered
within their shard, those with the most neighbours there first; the ones beyond the shard's quota
take the free slots of the others. Numbering is distributed: rows are range-partitioned and
sorted, and the offsets of a partition come from a count per partition and shard.

Built-in DataFrame functions only. The driver sees tables of ``shards`` x ``shards`` or partitions
x ``shards`` counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from premiumlake.llm._store import stored

ROUNDS = 6
#: During the rounds a shard may hold so many times its even share; the last pass, which moves those
#: without neighbours first, takes the excess back.
SLACK = 1.25
_LOTS = 1 << 20


def _per_link(state: DataFrame, members: DataFrame, shards: int) -> DataFrame:
    """(link, counts array<long>): members of each link by shard."""
    by = members.join(state.select("id", "shard"), "id").groupBy("link").agg(
        *[F.count(F.when(F.col("shard") == k, 1)).alias(f"c{k}") for k in range(shards)]
    )
    return by.select("link", F.array(*[f"c{k}" for k in range(shards)]).alias("counts"))


def _neighbours(state: DataFrame, members: DataFrame, shards: int, number: int = 0) -> DataFrame:
    """``state`` with near: neighbours by shard over a document's links, and itself once; best: the
    shard with the most, ties by a hash that members of a link share and that changes with the
    round ``number``, so that two neighbours don't swap places for ever; lot and links."""
    sums = members.join(_per_link(state, members, shards), "link").groupBy("id").agg(
        *[F.sum(F.col("counts")[k]).alias(f"n{k}") for k in range(shards)],
        F.count(F.lit(1)).alias("links"),
        F.min("link").alias("first"),
    )
    rows = state.join(sums, "id", "left")
    own = lambda k: F.when(F.col("shard") == k, F.lit(1) - F.coalesce("links", F.lit(0))).otherwise(0)
    near = F.array(*[F.coalesce(F.col(f"n{k}"), F.lit(0)) + own(k) for k in range(shards)])
    rows = rows.select(
        "id", "shard", near.alias("near"), F.coalesce("links", F.lit(0)).alias("links"),
        F.xxhash64(F.coalesce("first", F.col("id").cast("string"))).alias("seed"),
    )
    best = F.expr(f"array_max(transform(near, (n, k) -> struct(n AS n, xxhash64(seed, {number}, k) AS tie, k AS k))).k")
    return rows.select(
        "id", "shard", "near", "links",
        F.when(F.col("links") > 0, best).otherwise(F.col("shard")).alias("best"),
        F.pmod("seed", F.lit(_LOTS)).alias("lot"),
    )


def _moves(wish: dict[tuple[int, int], int], held: list[int], quota: list[int]) -> dict[tuple[int, int], float]:
    """The share of each wish (from, to) that quotas allow: equal exchange, then spare room."""
    room = {t: max(0, quota[t] - held[t]) for t in range(len(held))}
    share = {}
    for (s, t), n in sorted(wish.items(), key=lambda x: -x[1]):
        swap = min(n, wish.get((t, s), 0))
        more = min(n - swap, room[t])
        room[t] -= more
        share[s, t] = (swap + more) / n
    return share


def propagate(members: DataFrame, ids: DataFrame, shards: int, rounds: int = ROUNDS) -> DataFrame:
    """(id, shard, cohesion, lot) after at most ``rounds`` rounds; ``cohesion``: neighbours in the
    shard. ``ids``: distinct, non-null. ``members``: distinct (id, link) of links with two members
    or more. A document starts in the shard that a hash of its id gives."""
    start = F.pmod(F.xxhash64(F.col("id").cast("string")), F.lit(shards)).cast("int")
    state = stored(ids.select("id", start.alias("shard")), "labels-0")
    for number in range(1, rounds + 1):
        wishes = _neighbours(state, members, shards, number).select("id", "shard", "best", "lot")
        wishes = stored(wishes, f"wishes-{number}")
        held, wish = [0] * shards, {}
        for s, t, n in wishes.groupBy("shard", "best").count().collect():  # shards x shards rows
            held[s] += n
            if s != t:
                wish[s, t] = n
        share = _moves(wish, held, [int(SLACK * -(-sum(held) // shards))] * shards)
        if not any(share.values()):
            break
        allowed = F.lit(0.0)
        for (s, t), part in share.items():
            allowed = F.when((F.col("shard") == s) & (F.col("best") == t), F.lit(part)).otherwise(allowed)
        moved = F.when(F.col("lot") < allowed * _LOTS, F.col("best")).otherwise(F.col("shard"))
        state = stored(wishes.select("id", moved.cast("int").alias("shard")), f"labels-{number}")
    near = _neighbours(state, members, shards)
    return near.select("id", "shard", (F.col("near")[F.col("shard")] - 1).alias("cohesion"), "lot")


def numbered(rows: DataFrame, within: str, order: list[str], name: str) -> DataFrame:
    """``rows`` with ``position``: 0, 1, ... within each value of ``within`` by ``order``.

    Rows are split by ranges of (within, order) and numbered in their partition; what earlier
    partitions hold comes from one count per partition and value. No task sees more than a range.
    """
    keys = [within, *order]
    ranged = rows.repartitionByRange(*keys).withColumn("_part", F.spark_partition_id())
    own = ranged.withColumn("_at", F.row_number().over(W.partitionBy("_part", within).orderBy(*order)))
    own = stored(own, name)
    sizes = own.groupBy(within, "_part").agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(W.partitionBy(within).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select(within, "_part", before.alias("_before"))
    found = own.join(F.broadcast(offsets), [within, "_part"])  # a row for each partition and value
    return found.select(*rows.columns, (F.col("_before") + F.col("_at") - 1).alias("position"))


def assign_shards(docs: DataFrame, links: DataFrame, shards: int = 8, rounds: int = ROUNDS, id_col: str = "id") -> DataFrame:
    """(id, shard int, slot long): every id of ``docs`` in a shard of 0 .. shards - 1, counts at
    most one apart, slots gapless from 0 in each shard.

    ``docs``: the ids to place; rows with the same id are one document, null ids are not placed.
    ``links``: (id, link); null links, repeated rows and ids that ``docs`` lacks don't count. Ties
    between shards go by a hash of the shard, between documents by their ids. An empty table gives
    an empty result; without links the start is balanced and kept.
    """
    ids = docs.select(F.col(id_col).alias("id")).where("id is not null").distinct()
    given = links.select("id", F.col("link").cast("string").alias("link")).where("id is not null and link is not null").distinct()
    given = given.join(ids, "id", "left_semi")
    several = given.groupBy("link").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("link")
    members = stored(given.join(several, "link"), "members")

    placed = propagate(members, ids, shards, rounds)
    placed = placed.withColumn("loose", -F.col("cohesion"))
    first = stored(numbered(placed, "shard", ["loose", "lot", "id"], "placed").select("id", "shard", "lot", "position"), "numbered")
    held = [0] * shards
    for shard, n in first.groupBy("shard").count().collect():  # at most ``shards`` rows
        held[shard] = n
    total = sum(held)
    # the shards that are largest already take the odd ones
    largest = sorted(range(shards), key=lambda s: (-held[s], s))
    quota = [total // shards + (largest.index(s) < total % shards) for s in range(shards)]
    limit = F.element_at(F.array(*[F.lit(q) for q in quota]), F.col("shard") + 1)
    stays = first.where(F.col("position") < limit).select("id", "shard", F.col("position").alias("slot"))

    # the others, in the order of their shard and link, fill the free slots shard by shard
    spare = first.where(F.col("position") >= limit).select("id", "lot", F.lit(0).alias("all"))
    spare = numbered(spare, "all", ["lot", "id"], "spare")
    target, slot, before = F.lit(None).cast("int"), F.lit(None).cast("long"), 0
    for s in range(shards):
        free = max(0, quota[s] - held[s])
        inside = (F.col("position") >= before) & (F.col("position") < before + free)
        target = F.when(inside, F.lit(s)).otherwise(target)
        slot = F.when(inside, F.col("position") - before + held[s]).otherwise(slot)
        before += free
    moved = spare.select("id", target.alias("shard"), slot.alias("slot"))
    return stays.unionByName(moved).select("id", F.col("shard").cast("int"), F.col("slot").cast("long"))


def shard_documents(docs: DataFrame, shards: int = 8, rounds: int = ROUNDS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id_col, size long, text_crc32 long, shard int, slot long) for every row of ``docs``, rows with
    equal texts being neighbours.

    A row is a document: rows without an id, rows that share one and rows that repeat are placed
    each. Null texts are empty; ``size`` is the bytes of the text plus one. Other columns are not
    read. An empty table gives an empty result. Rows are numbered as they are stored, so the
    placement is the same for the same files and settings.
    """
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(text) + 1).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.sha1(text.cast("binary")).alias("link"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = stored(rows, "rows")
    placed = assign_shards(rows.select("row"), rows.select(F.col("row").alias("id"), "link"), shards, rounds, "row")
    out = rows.join(placed.withColumnRenamed("id", "row"), "row")
    return out.select(F.col("id").alias(id_col), "size", "text_crc32", "shard", "slot")
