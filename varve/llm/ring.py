"""Shards by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns many points on a ring of 64-bit hashes; a row goes to the first point at or after
its own hash. A shard takes no more rows than its bound, and rows beyond it continue clockwise to
the next point whose shard has room. The bounds add up to the number of rows, with at most one
between them, so the counts of the shards differ by one row at most.

Only counts per arc (one arc per virtual node) pass through the driver, where the overflow is
worked out arc by arc. Rows learn their place within their arc from a two-level numbering over
small slices of the ring, and with it their shard and their slot.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varve.llm.common import shuffle_partitions, stored

VIRTUAL_NODES = 64
SLICE_BITS = 48
SLICES_PER_PARTITION = 64


def ring_points(shards: int, virtual_nodes: int = VIRTUAL_NODES) -> list[tuple[int, int]]:
    """Sorted (point, shard) with points in 0 .. 2^SLICE_BITS - 1, the same in every run."""
    points = {}
    for shard in range(shards):
        for node in range(virtual_nodes):
            digest = hashlib.sha256(f"{shard}/{node}".encode()).digest()
            points.setdefault(int.from_bytes(digest[:8], "big") >> (64 - SLICE_BITS), shard)
    return sorted(points.items())


def assign_arcs(counts: list[int], owners: list[int], bounds: list[int]) -> list[tuple[int, int, int, int]]:
    """(arc, first place, rows, shard): who takes which rows of each arc.

    ``counts[a]`` rows lie on arc ``a``, whose point belongs to shard ``owners[a]``. Rows that
    find their shard full go on clockwise. All arcs hand over at the same time, hop by hop, and at
    each hop rows of a lower arc come first; the work is bounded by the square of the arcs.
    """
    room = list(bounds)
    waiting = [(a, 0, n) for a, n in enumerate(counts) if n]
    pieces = []
    for hop in range(len(owners) + 1):
        still = []
        for arc, first, n in waiting:
            shard = owners[(arc + hop) % len(owners)]
            taken = min(n, room[shard])
            if taken:
                room[shard] -= taken
                pieces.append((arc, first, taken, shard))
            if n > taken:
                still.append((arc, first + taken, n - taken))
        waiting = still
        if not waiting:
            break
    return pieces


def _first_at_or_after(value: Column, points: list[int]) -> Column:
    """Index of the first point at or after ``value``; after the last one, the first."""
    step = max(1, round(len(points) ** 0.5))
    every = F.array(*[F.lit(p) for p in points])
    coarse = F.array(*[F.lit(p) for p in points[step - 1 :: step]])
    skipped = F.size(F.filter(coarse, lambda p: p < value)) * step
    fine = F.slice(every, skipped + 1, F.lit(step))
    at = skipped + F.size(F.filter(fine, lambda p: p < value))
    return at % len(points)


def shard_rows(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    virtual_nodes: int = VIRTUAL_NODES,
) -> DataFrame:
    """One row per row of ``docs``: id, ``size``, ``text_crc32``, ``law``, ``shard``, ``slot``,
    ``grown_shard``.

    The law is ``rows``: counts of the shards are at most one apart; ``slot`` numbers a shard's
    rows from 0 without a gap. A row's point comes from its id and text, so rows without an id
    and rows that share one are spread by their texts; a repeated row is numbered in any order.
    A NULL text has no bytes. An empty table gives no rows.
    """
    spark = docs.sparkSession
    points = ring_points(shards, virtual_nodes)
    at = F.shiftrightunsigned(F.xxhash64(F.col(id_col), F.col(text_col)), 64 - SLICE_BITS)
    data = F.coalesce(F.col(text_col), F.lit("")).cast("binary")
    placed = docs.select(
        F.col(id_col).alias("id"),
        (F.octet_length(data) + 1).cast("long").alias("size"),
        F.crc32(data).alias("crc"),
        at.alias("at"),
    ).withColumn("arc", _first_at_or_after(F.col("at"), [p for p, _ in points]))
    placed = stored(placed, "placed")

    # A slice is a short stretch of the ring: enough of them to keep every numbering small.
    slices = max(1, shuffle_partitions(spark) * SLICES_PER_PARTITION)
    width = (1 << SLICE_BITS) // slices + 1
    placed = placed.withColumn("part", F.expr(f"at div {width}"))
    sizes = stored(placed.groupBy("arc", "part").agg(F.count(F.lit(1)).alias("n")), "slices")
    in_arc = Window.partitionBy("arc").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "arc", "part", F.coalesce(F.sum("n").over(in_arc), F.lit(0)).alias("before")
    )
    counts = [0] * len(points)
    for row in sizes.groupBy("arc").agg(F.sum("n").alias("n")).collect():  # one per virtual node
        counts[row["arc"]] = row["n"]
    total = sum(counts)
    bounds = [total // shards + (s < total % shards) for s in range(shards)]
    pieces = assign_arcs(counts, [s for _, s in points], bounds)

    filled = [0] * shards
    rows = []
    for arc, first, n, shard in sorted(pieces):
        rows.append((arc, first, first + n, shard, filled[shard] - first))
        filled[shard] += n
    shares = spark.createDataFrame(
        rows, "arc int, first long, beyond long, shard int, shift long"
    ).groupBy("arc").agg(F.sort_array(F.collect_list(F.struct("first", "beyond", "shard", "shift"))).alias("shares"))

    in_slice = Window.partitionBy("arc", "part").orderBy("at", "id", "crc")
    numbered = (
        placed.withColumn("nth", F.row_number().over(in_slice) - 1)
        .join(offsets, ["arc", "part"])
        .withColumn("place", F.col("before") + F.col("nth"))
        .join(F.broadcast(shares), "arc")
    )
    own = F.element_at(F.filter("shares", lambda s: s["beyond"] > F.col("place")), 1)
    return numbered.withColumn("own", own).select(
        F.col("id").alias(id_col),
        "size",
        F.col("crc").alias("text_crc32"),
        F.lit("rows").alias("law"),
        F.col("own.shard").alias("shard"),
        (F.col("place") + F.col("own.shift")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
