"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring has a fixed number of positions. A row's key is hashed to a position and belongs to the shard of the first virtual
node clockwise from it. Every shard has a capacity of floor or ceil(rows / shards); a key that meets a full shard goes on
clockwise to the next virtual node whose shard has room. The capacities add up to the number of rows, so counts differ by
one at most, and only keys beyond a full shard leave their place on the ring.

Only the row counts of the ring's positions (a fixed number) come to the driver. The walk over them yields segments
(position, first rank, last rank) -> (shard, first slot); each row finds its segment by its rank within its position. A position that holds more than
RANKED_ROWS rows, as that of a very frequent key does, is ranked in parts by a hash of the whole row, one after the other.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

POSITION_BITS = 13
VIRTUAL_NODES = 128
RANKED_ROWS = 4_000_000
SEGMENT = "array<struct<at:int,part:int,low:bigint,high:bigint,shard:int,first:bigint>>"


def ring(shards: int, virtual_nodes: int = VIRTUAL_NODES, bits: int = POSITION_BITS) -> list[tuple[int, int]]:
    """(position, shard) of all virtual nodes, clockwise."""
    def place(shard: int, node: int) -> int:
        digest = hashlib.blake2b(f"{shard}/{node}".encode(), digest_size=8).digest()
        return int.from_bytes(digest, "big") >> (64 - bits)

    return sorted((place(shard, node), shard) for shard in range(shards) for node in range(virtual_nodes))


def walk(counts: Sequence[int], nodes: Sequence[tuple[int, int]], shards: int) -> list[tuple[int, int, int, int, int]]:
    """Segments (position, low rank, high rank, shard, first slot) for the rows counted at each position.

    Each position first fills what room is left at its own virtual node, then all that overflowed goes on clockwise,
    position by position. A node whose shard is full is skipped by a pointer to the next one, so the walk costs
    little more than one step per position.
    """
    total, load = sum(counts), [0] * shards
    room = [total // shards + (shard < total % shards) for shard in range(shards)]
    after = [(at + 1) % len(nodes) for at in range(len(nodes))]

    def open_node(at: int) -> int:
        skipped = []
        while load[nodes[at][1]] >= room[nodes[at][1]]:
            skipped.append(at)
            at = after[at]
        for node in skipped:
            after[node] = at
        return at

    segments, overflow, home = [], [], 0

    def put(position: int, low: int, high: int, at: int) -> int:
        shard = nodes[at][1]
        taken = min(high - low, room[shard] - load[shard])
        if taken:
            segments.append((position, low, low + taken, shard, load[shard]))
            load[shard] += taken
        return low + taken

    for position, count in enumerate(counts):
        while home < len(nodes) and nodes[home][0] < position:
            home += 1
        low = put(position, 0, count, home % len(nodes))
        if low < count:
            overflow.append((position, low, count, home % len(nodes)))
    for position, low, high, at in overflow:
        while low < high:
            at = open_node(at)
            low = put(position, low, high, at)
    return segments


def ring_position(key: Sequence[Column], bits: int = POSITION_BITS) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*key), 64 - bits).cast("int")


def by_part(
    segments: Sequence[tuple[int, int, int, int, int]], parts: dict[int, dict[int, int]]
) -> list[tuple[int, int, int, int, int, int]]:
    """Segments (position, part, low, high, shard, first) with ranks counted within the parts of a position; `parts` has the rows of each part of
    the positions that have any."""
    found = []
    for position, low, high, shard, first in segments:
        before = 0
        for part, count in sorted(parts.get(position, {0: high}).items()):
            start, end = max(low, before), min(high, before + count)
            if start < end:
                found.append((position, part, start - before, end - before, shard, first + start - low))
            before += count
    return found


def as_table(spark: SparkSession, segments: Sequence[tuple[int, int, int, int, int, int]]) -> DataFrame:
    names = ("at", "part", "low", "high", "shard", "first")
    rows = json.dumps([dict(zip(names, s, strict=True)) for s in segments])
    return spark.range(1).select(F.inline(F.from_json(F.lit(rows), SEGMENT)))


def shard_rows(
    rows: DataFrame, shards: int, key: Sequence[str], ties: Sequence[str] = (), virtual_nodes: int = VIRTUAL_NODES,
    bits: int = POSITION_BITS, ranked_rows: int = RANKED_ROWS,
) -> DataFrame:
    """All columns of `rows`, plus shard (0 to shards - 1) and slot (gapless from 0 within the shard).

    Law: row counts of shards differ by one at most. `key` decides the place on the ring, `ties` orders rows of one
    key. Null keys hash like any value. Rows equal in key and ties are interchangeable; each has a slot of its own. An
    empty table gives an empty result. Columns of `rows` named shard or slot are replaced, all others stay, whatever their names.

    Two scans: one of the key alone for the counts, one of all columns; a third of positions with more than `ranked_rows` rows, if
    there are any. A position holds 1 / 2**bits of the keys; the
    sort within it, or within a part of it, spills. The segments are broadcast: at most one per position or part and a few per virtual node.
    """
    spark = rows.sparkSession
    own = [c for c in rows.columns if c not in ("shard", "slot")]
    position = ring_position([F.col(c) for c in key], bits)
    found = {r[0]: r[1] for r in rows.groupBy(position.alias("p")).count().collect()}  # at most 2**bits numbers
    counts = [found.get(p, 0) for p in range(1 << bits)]
    segments = walk(counts, ring(shards, virtual_nodes, bits), shards)
    hot = {p: -(-n // ranked_rows) for p, n in found.items() if n > ranked_rows}
    split = F.from_json(F.lit(json.dumps({str(p): n for p, n in hot.items()})), "map<string,int>")
    order = F.xxhash64(*own)
    part = F.pmod(order, F.coalesce(F.element_at(split, position.cast("string")), F.lit(1))).cast("int") if hot else F.lit(0)
    # The row travels as one value, so no name of its columns meets a name used here.
    held = rows.select(F.struct(*own).alias("row"), position.alias("at"), part.alias("part"), order.alias("order"))
    parts: dict[int, dict[int, int]] = {}
    if hot:
        for at, salt, n in held.filter(F.col("at").isin(list(hot))).groupBy("at", "part").count().collect():
            parts.setdefault(at, {})[salt] = n
    fields = [F.col("row").getField(c) for c in (*key, *ties)]
    place = Window.partitionBy("at", "part").orderBy(F.xxhash64(*fields[:len(key)]), *fields, "order")
    ranked = held.withColumn("rank", F.row_number().over(place) - 1)
    table = as_table(spark, by_part(segments, parts) or [(0, 0, 0, 0, 0, 0)]).select(
        F.col("at").alias("s_at"), F.col("part").alias("s_part"), "low", "high", "shard", "first"
    )
    inside = (F.col("at") == F.col("s_at")) & (F.col("part") == F.col("s_part")) & (F.col("rank") >= F.col("low")) & (F.col("rank") < F.col("high"))
    placed = ranked.join(F.broadcast(table), inside).select("row", "shard", (F.col("first") + F.col("rank") - F.col("low")).alias("slot"))
    return placed.select(*[F.col("row").getField(c).alias(c) for c in own], "shard", "slot")
