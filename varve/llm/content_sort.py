"""Exact duplicates by a distributed content sort.

Splitters sampled from the texts cut the sort order into ranges. Each range is sorted externally,
which puts equal texts next to each other, and every text is compared in full with its neighbour.
A run of equal texts takes the row that stays and its size from its own range. Only the runs at a
range's two ends can go on in another range: these few are matched by a second, small comparison.

The sort order is (first characters, hash of the text, hash of the id), so a group of copies that
holds a third of all rows spans many ranges instead of one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varve.llm.common import shuffle_partitions, sized_broadcast, stored

WHITE_SPACE = r"[\x20\x09-\x0D]+"
PREFIX = 24
RANGES_PER_PARTITION = 4
SAMPLES_PER_RANGE = 24
BROADCAST_LIMIT = 64 << 20


def _range_of(key: Column, splitters: list[str]) -> Column:
    """The number of splitters at or below ``key``, by a coarse and then a fine search."""
    if not splitters:
        return F.lit(0)
    step = max(1, round(len(splitters) ** 0.5))
    every = F.array(*[F.lit(s) for s in splitters])
    coarse = F.array(*[F.lit(s) for s in splitters[::step]])
    below = F.size(F.filter(coarse, lambda s: s <= key))
    fine = F.slice(every, (below - 1) * step + 1, F.lit(step))
    return F.when(below == 0, 0).otherwise(
        (below - 1) * step + F.size(F.filter(fine, lambda s: s <= key))
    )


def content_sort(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_raw_hash: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, ``keep_id``, ``group_size``, ``kept``, ``text_sha256``.

    Two texts are equal if they are identical without the characters of ``WHITE_SPACE``; a NULL
    text counts as empty, so all empty texts form one group. The row with the most code points
    stays, then the one with the smallest id; a NULL id comes last. If the same row (id and text)
    is repeated, one of the repeats stays. An empty table gives no rows. Other columns of ``docs``
    are not read.
    """
    spark = docs.sparkSession
    text = F.coalesce(F.col(text_col), F.lit(""))
    raw = F.xxhash64(F.col(text_col)).alias("raw_hash")
    keyed = docs.select(F.col(id_col).alias("id"), text.alias("text"), raw).select(
        "id",
        "raw_hash",
        F.length("text").cast("long").alias("len"),
        F.regexp_replace("text", WHITE_SPACE, "").alias("norm"),
    )
    # Hex of fixed width keeps the order of the pieces within one comparable text. Ranges are sorted
    # by the same pieces (a hash as a number orders otherwise): a group that is cut must lie at an end.
    content = F.concat(
        F.substring("norm", 1, PREFIX), F.lit("\0"), F.lpad(F.hex(F.xxhash64("norm")), 16, "0")
    )
    key = F.concat(
        content,
        F.lpad(F.hex(F.xxhash64("id", F.lit("salt"))), 16, "0"),
    )
    ranges = RANGES_PER_PARTITION * shuffle_partitions(spark)
    rows = max(1, docs.count())
    wanted = ranges * SAMPLES_PER_RANGE
    some = keyed if rows <= wanted else _sampled(docs, keyed, wanted / rows, id_col, text_col)
    sample = sorted(r[0] for r in some.select(key).limit(2 * wanted).collect())
    splitters = sorted({sample[i * len(sample) // ranges] for i in range(1, ranges) if sample})

    order = [content, F.col("norm"), F.col("len").desc(), F.col("id").asc_nulls_last()]
    by_content = Window.partitionBy("range").orderBy(*order)
    one = F.lit(1)
    at_end = F.lag(one).over(by_content).isNull() | F.lead(one).over(by_content).isNull()
    neighbours = keyed.withColumn("range", _range_of(key, splitters)).select(
        "id",
        "raw_hash",
        "len",
        "range",
        F.row_number().over(by_content).alias("place"),
        (~F.col("norm").eqNullSafe(F.lag("norm").over(by_content))).alias("head"),
        F.when(at_end, F.col("norm")).alias("end_text"),
        F.sha2("norm", 256).alias("text_sha256"),
    )
    so_far = Window.partitionBy("range").orderBy("place")
    runs = neighbours.withColumn("run", F.sum(F.col("head").cast("int")).over(so_far))
    in_run = Window.partitionBy("range", "run")
    runs = runs.select(
        "id",
        "raw_hash",
        "head",
        "range",
        "run",
        "text_sha256",
        "end_text",
        F.max(F.when(F.col("head"), F.struct("len", "id"))).over(in_run).alias("first"),
        F.count(one).over(in_run).alias("size"),
    )
    runs = stored(runs, "runs")

    ends = runs.where("end_text IS NOT NULL").select("end_text", "range", "run", "first", "size")
    best = F.struct(
        (-F.col("first.len")).alias("order_len"),
        F.col("first.id").isNull().alias("no_id"),
        F.col("first.id").alias("id"),
        F.col("range"),
        F.col("run"),
    )
    joined = (
        ends.distinct()
        .groupBy("end_text")
        .agg(
            F.min(best).alias("best"),
            F.sum("size").alias("total"),
            F.collect_list(F.struct("range", "run")).alias("parts"),
        )
        .where(F.size("parts") > 1)
        .select("best", "total", F.inline("parts"))
        .select(
            "range",
            "run",
            "total",
            F.col("best.id").alias("best_id"),
            ((F.col("best.range") == F.col("range")) & (F.col("best.run") == F.col("run"))).alias(
                "has_best"
            ),
        )
    )
    spans = F.col("total").isNotNull()
    return runs.join(joined, ["range", "run"], "left").select(
        F.col("id").alias(id_col),
        F.when(spans, F.col("best_id")).otherwise(F.col("first.id")).alias("keep_id"),
        F.coalesce("total", "size").alias("group_size"),
        (F.col("head") & F.coalesce("has_best", F.lit(True))).alias("kept"),
        "text_sha256",
        *(["raw_hash"] if with_raw_hash else []),
    )


def _sampled(docs, keyed, fraction, id_col, text_col):
    """The columns of ``keyed`` for a sample of the rows, drawn before the texts are normalised."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    some = docs.select(F.col(id_col).alias("id"), text.alias("text")).sample(fraction, seed=7)
    return some.select("id", F.regexp_replace("text", WHITE_SPACE, "").alias("norm"))


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that :func:`content_sort` keeps, whole and with all their columns.

    A repeated row (same id, same text) stays as often as it occurs if its text stays with its
    id, since the repeats cannot be told apart.
    """
    judged = content_sort(docs, id_col, text_col, with_raw_hash=True)
    dropped = (
        judged.groupBy(F.col(id_col).alias("id"), "raw_hash")
        .agg(F.max("kept").alias("kept"))
        .where("NOT kept")
        .select("id", "raw_hash")
    )
    dropped = stored(dropped, "dropped")
    dropped = sized_broadcast(dropped, dropped.count() * 64, BROADCAST_LIMIT)
    raw = F.xxhash64(F.col(f"d.{text_col}"))
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("x.id")) & (raw == F.col("x.raw_hash"))
    return docs.alias("d").join(dropped.alias("x"), same, "left_anti")
