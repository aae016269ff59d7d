"""Sharding by balanced label propagation.

Documents with equal texts are linked.  Linked documents start in the shard of
their hash.  In each round the members of a group see in which shards their
neighbours are (a count for each group and shard, joined to the group, so no
pair of links is ever listed) and wish to move, all together, to the shard
that has most of them among those with room for all.  A shard takes the
largest groups first, each whole, and never more rows than its quota; its room
follows from a table of sizes, so it is exact.  Groups that are taken have
moved; the others look again in the next round, at the room that is left.

Only two kinds of groups are cut, and of either there are at most as many as
shards: groups larger than a shard, which fill whole shards first, and groups
larger than any room that is left in the end.  Documents without links fill
what is left of each quota, so the counts end at most one apart.
"""

from __future__ import annotations

import itertools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from connscore.llm import common as C

SHARDS = 16

_PLACE = [C.FILE, C.ROW]


def _by_shard(values: list[int]) -> Column:
    return F.element_at(F.array(*[F.lit(v) for v in values]), F.col("shard") + 1)


def admitted(wishes: list[tuple[int, int, int]], room: list[int]) -> dict[tuple[int, int], int]:
    """How many groups of each size a shard takes, largest first; ``wishes``: (shard, size, groups)."""
    left, out = list(room), {}
    for shard, size, groups in sorted(wishes, key=lambda w: (w[0], -w[1])):
        taken = min(groups, left[shard] // size)
        if taken:
            out[shard, size] = taken
            left[shard] -= taken * size
    return out


def split_over(size: int, room: list[int]) -> list[tuple[int, int]]:
    """(shard, rows) of a group that fits no shard: the largest rooms first, the last part where it just fits."""
    out = []
    while size:
        fits = [i for i, r in enumerate(room) if r >= size]
        i = min(fits, key=lambda i: (room[i], i)) if fits else max(range(len(room)), key=lambda i: (room[i], -i))
        rows = min(size, room[i])
        room[i] -= rows
        size -= rows
        out.append((i, rows))
    return out


def propagate(groups: DataFrame, quota: list[int]) -> tuple[DataFrame, list[tuple[str, int, int, int]], list[int]]:
    """Where groups go: (group, shard) of whole ones, (group, first, last, shard) of parts, room left.

    ``groups`` has group, shard, n: members by shard at the start.
    """
    room, parts = list(quota), []
    sizes = C.written(groups.groupBy("group").agg(F.sum("n").alias("size")), "group-sizes")

    def cut(larger: DataFrame) -> None:
        for r in larger.orderBy(F.desc("size"), "group").collect():    # fewer than shards
            places = split_over(r["size"], room)
            ends = [0, *itertools.accumulate(rows for _, rows in places)]
            parts.extend((r["group"], a, b, shard) for (shard, _), a, b in zip(places, ends, ends[1:]))

    open_, settled, turn = C.written(groups.join(sizes, "group"), "open"), None, 0
    while not open_.isEmpty():
        turn += 1
        larger = open_.filter(F.col("size") > max(room)).select("group", "size").distinct()
        if not larger.isEmpty():
            cut(larger)
            open_ = C.written(open_.join(F.broadcast(larger.select("group")), "group", "left_anti"), "open")
            continue
        # the shard with most members among those with room for all; without one, any such shard by hash
        held = open_.filter(F.col("size") <= _by_shard(room))
        best = held.groupBy("group").agg(
            F.max(F.struct("n", F.xxhash64("group", "shard", F.lit(turn)).alias("tie"), "shard")).alias("best"))
        fits = F.filter(F.sequence(F.lit(0), F.lit(len(room) - 1)),
                        lambda i: F.element_at(F.array(*[F.lit(r) for r in room]), i + 1) >= F.col("size"))
        other = F.element_at(fits, (F.pmod(F.xxhash64("group", F.lit(turn)), F.size(fits)) + 1).cast("int"))
        wish = C.written(
            open_.select("group", "size").distinct().join(best, "group", "left")
            .select("group", "size", F.coalesce("best.shard", other).alias("shard")), "wishes")
        # a row for each shard and size: distinct sizes sum to no more than the rows, so there are few.  The
        # largest wish of a shard always fits, so a round takes something
        taken = admitted([tuple(r) for r in wish.groupBy("shard", "size").agg(F.count("*").alias("groups"))
                          .select("shard", "size", "groups").collect()], room)
        limits = open_.sparkSession.createDataFrame([(s, z, k) for (s, z), k in taken.items()],
                                                    "shard int, size long, taken long")
        now = C.written(C.numbered(wish.join(C.sized_broadcast(limits), ["shard", "size"]), ["shard", "size"], ["group"], "nth")
                        .filter(F.col("nth") < F.col("taken")).select("group", "shard"), "settled")
        settled = now if settled is None else settled.unionByName(now)
        for (shard, size), k in taken.items():
            room[shard] -= size * k
        open_ = C.written(open_.join(now.select("group"), "group", "left_anti"), "open")
    return settled if settled is not None else groups.select("group", "shard").limit(0), parts, room


def shard(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """Per row: doc_id, size, text_crc32, law, shard, slot, grown_shard (null under this law).

    The law is ``rows``: counts of shards are at most one apart, slots are
    gapless from 0.  Null and empty texts are equal (size 1).  Repeated rows
    and ids each have a slot.  An empty table gives an empty result.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = C.written(C.located(docs.select("doc_id", "text"), "sharding-docs").select(
        F.col("doc_id").cast("long").alias("doc_id"), *_PLACE,
        (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text).alias("text_crc32"),
        F.substring(F.unhex(F.sha2(text, 256)), 1, 16).alias("digest")), "rows")
    n = rows.count()
    quota = [n // shards + (i < n % shards) for i in range(shards)]
    order = ["doc_id", *_PLACE]
    copies = C.written(rows.groupBy("digest").agg(F.count("*").alias("copies")).filter("copies > 1")
                       .select(F.col("digest").alias("group")), "groups")
    linked = C.written(rows.join(C.sized_broadcast(copies), F.col("digest") == F.col("group")).select(*order, "group"), "linked")
    start = F.pmod(F.xxhash64("doc_id", *_PLACE), F.lit(shards)).cast("int")
    found, parts, room = propagate(linked.groupBy("group", start.alias("shard")).agg(F.count("*").alias("n")), quota)
    homes = linked.join(C.sized_broadcast(found), "group").select(*order, "shard")
    if parts:
        table = F.broadcast(rows.sparkSession.createDataFrame(    # groups and shards: at most 2 x shards squared rows
            [(bytes(g), a, b, s) for g, a, b, s in parts], "group binary, low long, high long, shard int"))
        of_cut = C.numbered(C.written(linked.join(F.broadcast(table.select("group").distinct()), "group", "left_semi"), "cut"),
                            ["group"], order, "number")
        homes = homes.unionByName(of_cut.join(table, "group").filter("number >= low and number < high").select(*order, "shard"))
    homes = C.written(homes, "homes")
    placed = C.numbered(homes, ["shard"], order, "slot").select(*_PLACE, "shard", "slot")
    pool = C.written(rows.select(*order).join(homes.select(*_PLACE), _PLACE, "left_anti").withColumn("all", F.lit(0)), "pool")
    before = [0, *itertools.accumulate(room)]
    held = [q - r for q, r in zip(quota, room, strict=True)]
    where = F.lit(None).cast("int")
    for i in reversed(range(shards)):
        where = F.when(F.col("number") < before[i + 1], F.lit(i)).otherwise(where)
    filled = (C.numbered(pool, ["all"], order, "number").withColumn("shard", where)
              .select(*_PLACE, "shard", (F.col("number") - _by_shard(before[:-1]) + _by_shard(held)).cast("long").alias("slot")))
    return (rows.join(placed.unionByName(filled), _PLACE)
            .select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot",
                    F.lit(None).cast("int").alias("grown_shard")))


def cut_report(sharded: DataFrame) -> DataFrame:
    """(groups, cut, parts, cut_edges, least_parts): how the groups of equal texts fared.

    ``parts`` counts a group's shards, ``least_parts`` those that it needs
    (its rows over the largest shard's, rounded up).  With each member linked to the next,
    a group in p parts has p - 1 cut edges at least, and this sharding cuts no more.
    """
    group = ["text_crc32", "size"]
    largest = sharded.groupBy("shard").agg(F.count("*").alias("rows")).agg(F.max("rows").alias("most")).first()["most"] or 1
    by = (sharded.groupBy(*group, "shard").agg(F.count("*").alias("n")).groupBy(*group)
          .agg(F.count("*").alias("parts"), F.sum("n").alias("n")).filter("n > 1"))
    least = F.ceil(F.col("n") / largest)
    return by.agg(F.count("*").alias("groups"), F.count_if(F.col("parts") > least).alias("cut"),
                  F.coalesce(F.sum("parts"), F.lit(0)).alias("parts"),
                  F.coalesce(F.sum(F.col("parts") - 1), F.lit(0)).alias("cut_edges"),
                  F.coalesce(F.sum(least), F.lit(0)).cast("long").alias("least_parts"))
