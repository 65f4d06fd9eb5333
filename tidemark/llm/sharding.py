"""Shards of near equal bytes for groups that must stay together, by Karmarkar-Karp differencing.

A partial partition is a set of groups already dealt to `shards` bins. Starting from one partial partition for each
group, the two with the largest spread between their fullest and emptiest bin are combined, the fullest bin of one with
the emptiest of the other, until one is left. Groups are first combined within chunks of bounded size, in parallel; a
chunk's outcome is again a partial partition, and these are combined by the same rule, in levels of bounded fan-in, so
neither a task nor the driver ever holds all groups.

A group is all rows of equal text, wherever they are; one that outweighs a whole shard makes that shard larger, as it
cannot be split. Null texts are one group, of 8 bytes a row, and have a null checksum. Repeated rows get slots of their
own. No rows: an empty result.
"""

from __future__ import annotations

import heapq

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.documents import ship
from tidemark.sources.staging import settle

#: Groups (on the first level) or partial partitions that one task combines, about.
CHUNK_GROUPS = 16_384
FAN_IN = 1_024
#: Rows of a block in which slots are numbered, about.
BLOCK_ROWS = 65_536


def difference(rows: list[list[int]]) -> list[list[int]]:
    """For each partial partition, given by its bins' sizes, the new bin of each of its bins.

    Ties go to the partial partition that came first, so the outcome depends on the rows' order alone.
    """
    if not rows:
        return []
    bins = len(rows[0])
    sums: list[list[int] | None] = []
    origin: list[list[int] | None] = []  # position in the sorted bins -> the bin of the row
    joined: list[tuple[int, int, list[int]] | None] = []
    heap = []
    for i, row in enumerate(rows):
        order = sorted(range(bins), key=lambda b: (-row[b], b))
        sums.append([row[b] for b in order])
        origin.append(order)
        joined.append(None)
        heap.append((row[order[-1]] - row[order[0]], i))
    heapq.heapify(heap)
    last = bins - 1
    while len(heap) > 1:
        _, a = heapq.heappop(heap)
        _, b = heapq.heappop(heap)
        x, y = sums[a], sums[b]
        both = [x[i] + y[last - i] for i in range(bins)]
        order = sorted(range(bins), key=lambda i: -both[i])
        new = [both[i] for i in order]
        joined.append((a, b, order))
        sums[a] = sums[b] = None
        sums.append(new)
        origin.append(None)
        heapq.heappush(heap, (new[-1] - new[0], len(sums) - 1))
    place: list[list[int] | None] = [None] * len(sums)  # position in the sorted bins -> final bin
    place[-1] = list(range(bins))
    out: list[list[int]] = [[]] * len(rows)
    for node in range(len(sums) - 1, -1, -1):
        at = place[node]
        if joined[node] is None:
            mine = [0] * bins
            for position, b in enumerate(origin[node]):
                mine[b] = at[position]
            out[node] = mine
        else:
            a, b, order = joined[node]
            first, second = [0] * bins, [0] * bins
            for position, i in enumerate(order):
                first[i] = at[position]
                second[last - i] = at[position]
            place[a], place[b] = first, second
        place[node] = None
    return out


def deal_groups(groups: DataFrame, shards: int, chunk_groups: int = CHUNK_GROUPS, fan_in: int = FAN_IN) -> DataFrame:
    """`g` and `shard` from a table of distinct keys `g` with their `weight`."""
    chunks = max(1, -(-groups.count() // chunk_groups))

    def first_level(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values(["weight", "g"], ascending=[False, True], ignore_index=True)
        empty = [0] * (shards - 1)
        bins = difference([[int(w), *empty] for w in rows["weight"]])
        return rows.assign(bin=[b[0] for b in bins])[["g", "weight", "chunk", "bin"]].astype({"bin": "int32"})

    chunked = groups.select("g", "weight", F.expr(f"pmod(xxhash64(g), {chunks})").alias("chunk"))
    dealt = settle(
        chunked.groupBy("chunk").applyInPandas(first_level, "g binary, weight long, chunk long, bin int"), "shard-groups"
    )
    sums = dealt.groupBy("chunk", "bin").agg(F.sum("weight").alias("weight"))

    def next_level(rows: pd.DataFrame) -> pd.DataFrame:
        ids = sorted(rows["chunk"].unique())
        at = {c: i for i, c in enumerate(ids)}
        table = [[0] * shards for _ in ids]
        for c, b, w in zip(rows["chunk"], rows["bin"], rows["weight"], strict=True):
            table[at[c]][b] = int(w)
        order = sorted(range(len(ids)), key=lambda i: (min(table[i]) - max(table[i]), ids[i]))
        found = difference([table[i] for i in order])
        out = [(ids[i], b, bins[b]) for i, bins in zip(order, found, strict=True) for b in range(shards)]
        return pd.DataFrame(out, columns=["chunk", "bin", "into"]).astype({"chunk": "int64", "bin": "int32", "into": "int32"})

    while chunks > 1:
        level = sums.withColumn("up", F.floor(F.col("chunk") / fan_in)).groupBy("up")
        moves = settle(
            level.applyInPandas(lambda rows: next_level(rows), "chunk long, bin int, into int"), "shard-moves"
        )
        dealt = dealt.join(moves, ["chunk", "bin"]).select(
            "g", "weight", F.floor(F.col("chunk") / fan_in).alias("chunk"), F.col("into").alias("bin")
        )
        chunks = -(-chunks // fan_in)
        sums = dealt.groupBy("chunk", "bin").agg(F.sum("weight").alias("weight")) if chunks > 1 else sums
    return dealt.select("g", F.col("bin").alias("shard"))


def by_bytes(docs: DataFrame, shards: int = 24, overhead: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot (gapless in each shard, by doc_id within blocks), grown_shard (null)."""
    ship(docs.sparkSession)
    text = F.col(text_col).cast("binary")
    rows = settle(
        docs.select(
            F.col(id_col).cast("long").alias("doc_id"),
            (F.coalesce(F.octet_length(text), F.lit(0)) + overhead).cast("long").alias("size"),
            F.crc32(text).alias("text_crc32"),
            F.coalesce(F.unhex(F.sha2(text, 256)), F.lit(b"")).alias("g"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("g").agg(F.sum("size").alias("weight"))
    dealt = rows.join(deal_groups(groups, shards), "g").drop("g")
    blocks = max(1, -(-rows.count() // BLOCK_ROWS))
    placed = settle(dealt.withColumn("block", F.expr(f"pmod(xxhash64(doc_id, text_crc32), {blocks})")), "shard-placed")
    counts = placed.groupBy("shard", "block").count()
    before = counts.selectExpr(
        "shard", "block", "sum(count) over (partition by shard order by block) - count before"
    )
    numbered = placed.selectExpr(
        "*", "row_number() over (partition by block, shard order by doc_id, size, text_crc32) - 1 own"
    )
    return numbered.join(before, ["shard", "block"]).selectExpr(
        "doc_id", "size", "text_crc32", "'bytes' law", "shard", "cast(before + own as long) slot", "cast(null as int) grown_shard"
    )
