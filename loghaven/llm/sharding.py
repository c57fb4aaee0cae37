"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

Every shard has many virtual nodes on a ring of cells. A document goes clockwise from its cell
to the next virtual node; when that shard is full, it goes on to the next one with room. The
bound is the mean, so shards differ by one document at most, and only documents beyond a
shard's bound leave the place that the plain ring gives them.
"""

from __future__ import annotations

from zlib import crc32

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from loghaven.lake import stored
from loghaven.llm.common import text_or_empty

SHARDS = 40
NODES = 64
CELLS = 1 << 14
ROW_BYTES = 16
SEED = 77


def ring_nodes(shards: int, nodes: int, cells: int) -> list[tuple[int, int]]:
    """(cell, shard) of all virtual nodes, clockwise."""
    return sorted((crc32(f"{s}/{v}".encode()) % cells, s) for s in range(shards) for v in range(nodes))


def place_cells(counts: dict[int, int], shards: int, nodes: int, cells: int) -> list[tuple[int, int, int, int, int]]:
    """(cell, first, end, shard, slot): which documents of a cell, counted from 0, go to which
    shard, and the slot of the first of them.

    First all documents claim the shard they meet, then those without room go one node
    further, past full shards, until all have a place. Works on the counts per cell, of which
    there are ``cells`` at most whatever the table's size.
    """
    ring = ring_nodes(shards, nodes, cells)
    total = sum(counts.values())
    room = [total // shards + (s < total % shards) for s in range(shards)]
    used = [0] * shards
    claims, at = [], 0
    for cell in sorted(counts):
        while at < len(ring) and ring[at][0] < cell:
            at += 1
        claims.append((cell, 0, counts[cell], at % len(ring)))
    placed = []
    while claims:
        over = []
        for cell, first, end, at in claims:
            shard = ring[at][1]
            n = min(room[shard] - used[shard], end - first)
            if n:
                placed.append((cell, first, first + n, shard, used[shard]))
                used[shard] += n
            if first + n < end:
                over.append((cell, first + n, end, at))
        claims = []
        for cell, first, end, at in over:
            at = (at + 1) % len(ring)
            while used[ring[at][1]] == room[ring[at][1]]:
                at = (at + 1) % len(ring)
            claims.append((cell, first, end, at))
    return placed


def shard_rows(
    docs: DataFrame, shards: int = SHARDS, nodes: int = NODES, cells: int = CELLS, seed: int = SEED
) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot of every row; needs doc_id and text.

    Size is the text's UTF-8 bytes plus 16. A null text counts as empty and a null id as an id
    of its own; rows with equal ids lie in one cell and get slots of their own. Other columns
    are not read. An empty table gives no rows. Slots count from 0 in every shard.
    """
    text = text_or_empty(F.col("text"))
    narrow = docs.select(
        "doc_id",
        (F.octet_length(text) + ROW_BYTES).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), F.col("doc_id")).alias("hash"),
    )
    narrow = stored(
        narrow.withColumns(
            {
                "cell": F.pmod("hash", F.lit(cells)).cast("int"),
                "of_text": F.xxhash64("doc_id", "text_crc32", "size"),
                "part": F.spark_partition_id(),
            }
        ),
        "shard-rows",
    )
    # Two levels: equal rows of one part of the table are numbered, then what lies before them in the
    # cell is added, from one row for all of them. So an id on many rows is no single window.
    keys = ["cell", "hash", "of_text", "part"]
    groups = stored(narrow.groupBy(*keys).agg(F.count("*").alias("rows")), "shard-groups")
    counts = {r["cell"]: r["rows"] for r in groups.groupBy("cell").agg(F.sum("rows").alias("rows")).collect()}
    plan = narrow.sparkSession.createDataFrame(
        place_cells(counts, shards, nodes, cells), "cell int, first long, end long, shard int, start long"
    )
    before = Window.partitionBy("cell").orderBy("hash", "of_text", "part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = groups.withColumn("offset", F.coalesce(F.sum("rows").over(before), F.lit(0)))
    inside = Window.partitionBy(*keys).orderBy("doc_id", "text_crc32", "size")
    ranked = narrow.withColumn("n", F.row_number().over(inside) - 1).join(offsets.drop("rows"), keys).withColumn("n", F.col("n") + F.col("offset"))
    # One row for a cell and one for each shard's border: bounded by cells and shards.
    return (
        ranked.join(F.broadcast(plan), "cell")
        .where((F.col("first") <= F.col("n")) & (F.col("n") < F.col("end")))
        .select("doc_id", "size", "text_crc32", "shard", (F.col("start") + F.col("n") - F.col("first")).alias("slot"))
    )
