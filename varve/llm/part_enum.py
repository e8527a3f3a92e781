"""Jaccard links between documents by PartEnum signatures over word shingles.

Two sets of sizes a <= b link at a Jaccard similarity of at least 4/5, that is if they differ in at
most (a + b) / 9 shingles. Sizes are cut into bands with b <= 5/4 a; linked sets lie in the same
or in neighbouring bands, and each set takes part in its own band's instance and in the next
one's. An instance partitions the shingle domain into more parts than linked sets can differ in.
Sets that differ in at most k shingles differ in at most k parts, so of the parts that hold
anything, in one fixed order, the first k + 1 of each set must have one in common: these parts'
contents, hashed, are the signatures.

The order puts parts first that hold the fewest shingles known, from a bounded sample, to be
frequent. So a line or passage that many documents share makes few of them candidates.

Sets that share a signature share its smallest member, the hub. Equal sets are one from the
start. The members of a hub are compared in blocks of bounded size, each with the hub. Members
that are joined to the hub there are done; the few others of a hub with several blocks are
compared with all its blocks. Only links that join something new leave a task, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from varve.llm.common import ship_package, sized_broadcast, stored
from varve.llm.components import connected_components

SHINGLE = 5
BATCH_BYTES = 1_000_000
BROADCAST_LIMIT = 64 << 20
SIGNATURES_PER_BATCH = 500_000
BLOCK_SETS = 1000
BLOCK_SHINGLES = 1_000_000
# The sample only orders signatures, it decides no link.
SAMPLE_TEXTS = 4000
SAMPLE_COPIES = 3
MOST_FREQUENT = 500_000

_MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x + _MIX[0]).astype(np.uint64)
    x = (x ^ (x >> np.uint64(30))) * _MIX[1]
    x = (x ^ (x >> np.uint64(27))) * _MIX[2]
    return x ^ (x >> np.uint64(31))


_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
# Every byte at every place of a word has a number of its own; those of the first places are kept.
_PLACES = 64
_CODE = mix(np.arange(_PLACES << 8, dtype=np.uint64))
_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_hashes(data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words of the texts laid end to end in ``data`` (UTF-8), and the
    number of words of each text. ``starts`` has each text's first byte and the end of the last.
    Equal words have equal hashes; links rest on different ones having different hashes.
    """
    data = _LOWER[data]
    inside = ~_IS_SPACE[data]
    before = np.empty(len(data), bool)
    before[:1], before[1:] = False, inside[:-1]
    before[starts[:-1][starts[:-1] < len(data)]] = False
    after = np.empty(len(data), bool)
    after[-1:], after[:-1] = False, inside[1:]
    after[starts[1:][starts[1:] > 0] - 1] = False
    first, last = np.flatnonzero(inside & ~before), np.flatnonzero(inside & ~after) + 1
    # A word's hash is the sum of its bytes' numbers by place, which no repeating pattern cancels.
    sizes = last - first
    flat = np.flatnonzero(inside)
    begins = np.cumsum(sizes) - sizes
    key = ((np.arange(len(flat)) - np.repeat(begins, sizes)) << 8) | data[flat]
    late = key >= len(_CODE)
    codes = _CODE[np.where(late, 0, key)]
    codes[late] = mix(key[late].astype(np.uint64))
    hashes = np.add.reduceat(codes, begins) if len(begins) else np.zeros(0, np.uint64)
    length = sizes.astype(np.uint64)
    counts = np.diff(np.searchsorted(first, starts))
    return mix(hashes ^ mix(length)), counts


def shingle_sets(texts: pa.Array, shingle: int = SHINGLE) -> Iterator[np.ndarray]:
    """The sorted distinct shingle hashes of every text."""
    texts = texts.cast(pa.large_string())
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = texts.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    at = 0
    while at < len(texts):
        beyond = int(np.searchsorted(offsets, offsets[at] + BATCH_BYTES, "right")) - 1
        beyond = min(max(beyond, at + 1), len(texts))
        low, high = offsets[at], offsets[beyond]
        words, counts = word_hashes(data[low:high], offsets[at : beyond + 1] - low)
        ends = np.cumsum(counts)
        grams = np.zeros(len(words), np.uint64)
        n = max(0, len(words) - shingle + 1)
        for i in range(shingle):
            grams[:n] = mix(grams[:n]) + words[i : i + n]
        for end, count in zip(ends.tolist(), counts.tolist(), strict=True):
            if count >= shingle:
                yield np.unique(grams[end - count : end - shingle + 1])
            elif count:
                whole = np.full(1, count, np.uint64)
                for word in words[end - count : end]:
                    whole = mix(whole) + word
                yield whole
            else:
                yield np.zeros(0, np.uint64)
        at = beyond


def set_digest(shingles: np.ndarray) -> int:
    """A 64-bit digest of a set; equal sets have equal digests."""
    total = mix(shingles).sum(dtype=np.uint64)
    return int(mix(np.array([total ^ np.uint64(len(shingles))]))[0].astype(np.int64))


def size_bands(largest: int) -> list[int]:
    """The last size of each band: a band's sizes are within 5/4 of its first."""
    ends, first = [], 1
    while first <= largest:
        ends.append(first * 5 // 4)
        first = ends[-1] + 1
    return ends


_ENDS = np.array(size_bands(1 << 40))


def signatures(shingles: np.ndarray, common: np.ndarray | None = None) -> np.ndarray:
    """The signatures of one set, for its own band's instance and the next one's.

    ``common`` (sorted) names shingles known to be frequent. It only decides which parts come
    first in the order, the ones with the most other shingles; any ``common`` gives all links.
    """
    size = len(shingles)
    if not size:
        return np.zeros(0, np.uint64)
    rare = np.ones(size, np.int64)
    if common is not None and len(common):
        at = np.minimum(np.searchsorted(common, shingles), len(common) - 1)
        rare[common[at] == shingles] = 0
    band = int(np.searchsorted(_ENDS, size))
    mixed, found = mix(shingles), []
    for instance in (band, band + 1):
        largest = min(int(_ENDS[instance]), size * 5 // 4)
        if instance > band and largest <= _ENDS[band]:
            continue  # no set of the next band is near enough in size
        most = (size + largest) // 9  # shingles that a linked set of this instance can differ in
        parts = (3 * (2 * int(_ENDS[instance]) // 9 + 1) + 1) // 2
        found.append(_part_signatures(shingles, mixed, rare, instance, parts, most + 1))
    return np.concatenate(found)


def _part_signatures(shingles, mixed, rare, instance, parts, wanted):
    seed = np.uint64(instance * 0x9E3779B1 + 1)
    order = ((mixed ^ (mixed >> np.uint64(29))) * (seed | np.uint64(1)) >> np.uint64(33)) % np.uint64(parts)
    order = order.astype(np.int64)
    by_part = np.argsort(order, kind="stable")
    order = order[by_part]
    first = np.flatnonzero(np.r_[True, order[1:] != order[:-1]])
    # Sums: the same contents of a part give the same number in every set.
    content = np.add.reduceat(mixed[by_part], first)
    weight = np.add.reduceat(rare[by_part], first)
    part = order[first].astype(np.uint64)
    signed = mix(content ^ mix(part + (seed << np.uint64(32))))
    if len(signed) < wanted:
        # Fewer parts hold anything than could differ: empty parts count as parts too.
        empty = np.setdiff1d(np.arange(parts, dtype=np.uint64), part)
        return np.concatenate([signed, mix(~mix(empty + (seed << np.uint64(32))))])
    return signed[np.lexsort((signed, -weight))[:wanted]]


def _links(ids: list, sets: list[np.ndarray], left: np.ndarray, right: np.ndarray, hub=None):
    """Links that join what is not joined yet, between ``left`` and ``right``, and every
    position's root.

    The overlap of one set with all others is a count over the shingles' lists of sets. With
    ``hub`` (all sets in ``left`` and ``right`` then) its sets come first, and sets joined to it
    by their turn are not compared again: a link of theirs leads into the hub's component, or to
    a set that has, or had, a turn of its own.
    """
    sizes = np.array([len(s) for s in sets])
    owner = np.repeat(np.arange(len(sets)), sizes)
    flat = np.concatenate(sets)
    order = np.argsort(flat, kind="stable")
    flat, owner = flat[order], owner[order]
    _, start, many = np.unique(flat, return_index=True, return_counts=True)
    parent = list(range(len(sets)))

    def root(x):
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    names, found = flat[start], []
    hubs = [i for i, node in enumerate(ids) if node == hub] if hub is not None else []
    for x in [*hubs, *np.setdiff1d(np.flatnonzero(left), hubs).tolist()]:
        if x not in hubs and any(root(x) == root(h) for h in hubs):
            continue
        at = np.searchsorted(names, sets[x])
        first, count = start[at], many[at]
        within = np.arange(int(count.sum())) - np.repeat(np.cumsum(count) - count, count)
        common = np.bincount(owner[np.repeat(first, count) + within], minlength=len(sets))
        near = (common > 0) & (100 * common >= 80 * (sizes + sizes[x] - common))
        for y in np.flatnonzero(near & right).tolist():
            one, other = root(x), root(y)
            if one != other:
                parent[max(one, other)] = min(one, other)
                found.append((ids[x], ids[y]))
    return found, [root(x) for x in range(len(sets))]


def _frequent(docs: DataFrame, shingle: int) -> np.ndarray:
    """Shingles of several texts of a bounded sample, sorted; they only order the signatures."""
    rows = max(1, docs.count())
    some = docs.sample(min(1.0, SAMPLE_TEXTS / rows), seed=11).limit(2 * SAMPLE_TEXTS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = {set_digest(s): s for s in shingle_sets(batch.column(0), shingle)}
            flat = np.concatenate([np.zeros(0, np.uint64), *sets.values()])
            yield pa.RecordBatch.from_arrays([pa.array(flat.view(np.int64))], names=["shingle"])

    counts = some.select("text").distinct().mapInArrow(run, "shingle long").groupBy("shingle").count()
    often = counts.where(F.col("count") >= SAMPLE_COPIES).orderBy(F.desc("count"), "shingle")
    found = [r[0] for r in often.limit(MOST_FREQUENT).select("shingle").collect()]
    return np.sort(np.array(found, np.int64).view(np.uint64))


def jaccard_components(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle: int = SHINGLE,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_shingles``, ``component_id``.

    A text's set holds its distinct runs of ``shingle`` words (white space parts words, A-Z count
    as a-z), or its whole word sequence if it is shorter. Sets link at a Jaccard similarity of at
    least 0.8; ``component_id`` is the smallest id reachable by links. NULL, empty and blank texts
    have no shingles and no links. Equal sets are one node, so copies cost nothing further. Rows
    that share an id are one document, whose links are those of all its texts, with two
    exceptions: a row with an empty text stands for itself, and texts that are all copies of texts
    with smaller ids take the component of these, each its own. A row without an id links with
    nothing and has a NULL component. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    id_type = docs.schema[id_col].dataType.simpleString()
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))

    def sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [(len(s), set_digest(s)) for s in shingle_sets(batch.column(1), shingle)]
            n, digest = (np.array(sets, np.int64).reshape(-1, 2)).T
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(n), pa.array(digest)], names=["id", "n", "digest"]
            )

    sketches = stored(texts.mapInArrow(sketch, f"id {id_type}, n long, digest long"), "sketches")
    nodes = sketches.where("id IS NOT NULL AND n > 0").groupBy("digest", "n").agg(
        F.min("id").alias("node"), F.count(F.lit(1)).alias("copies")
    )
    nodes = stored(nodes, "nodes")

    # Texts of nodes only: one text for each distinct set.
    repeated = sketches.join(nodes.where("copies > 1"), ["digest", "n"], "left_semi")
    extra = repeated.select("id").distinct().join(nodes.select(F.col("node").alias("id")), "id", "left_anti")
    extra = stored(extra, "copies")
    extra = sized_broadcast(extra, extra.count() * 48, BROADCAST_LIMIT)
    single = texts.where("id IS NOT NULL").join(extra, "id", "left_anti")
    frequent = spark.sparkContext.broadcast(_frequent(texts.where("id IS NOT NULL"), shingle))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, held, size = batch.column(0), [], 0
            rows = []
            for i, s in enumerate(shingle_sets(batch.column(1), shingle)):
                found = signatures(s, frequent.value)
                held.append(found)
                rows.append(np.full(len(found), i))
                size += len(found)
                if size >= SIGNATURES_PER_BATCH or i == len(ids) - 1:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(held).view(np.int64)), ids.take(pa.array(np.concatenate(rows)))],
                        names=["signature", "node"],
                    )
                    held, rows, size = [], [], 0

    signed = single.mapInArrow(sign, f"signature long, node {id_type}")
    bucket = Window.partitionBy("signature")
    shared = (
        signed.withColumn("hub", F.min("node").over(bucket))
        .withColumn("last", F.max("node").over(bucket))
        .where("hub != last")
        .select("hub", "node")
        .distinct()
    )
    shared = stored(shared, "shared")
    edges = _verified(spark, shared, texts, sketches, shingle, id_type)
    roots = connected_components(edges)

    roots = roots.withColumnRenamed("root", "component")
    members = nodes.join(roots, "node", "left").select(
        "digest", "n", F.coalesce("component", "node").alias("component"), "copies", "node"
    )
    several = stored(members.where("copies > 1 OR component != node"), "classes")
    return (
        sketches.alias("s")
        .join(several.select("digest", "n", "component"), ["digest", "n"], "left")
        .select(
            F.col("id").alias(id_col),
            F.col("n").alias("n_shingles"),
            F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component_id"),
        )
    )


def _blocks_of(rows: DataFrame, name: str) -> DataFrame:
    """(hub, ``name``): how many blocks of bounded size the sets of each hub make."""
    blocks = F.greatest(F.sum("n") / BLOCK_SHINGLES, F.count(F.lit(1)) / BLOCK_SETS)
    return rows.groupBy("hub").agg(F.ceil(blocks).cast("int").alias(name))


def _measured(df: DataFrame, name: str) -> DataFrame:
    df = stored(df, name)
    return sized_broadcast(df, df.count() * 48, BROADCAST_LIMIT)


def _verified(spark, shared, texts, sketches, shingle, id_type):
    """Links that hold, enough of them to join all linked sets that share a hub.

    Members of a hub are dealt into blocks of a bounded number of shingles, each with the hub
    itself. Members that their block joins to the hub need no more comparing among each other;
    only the others of hubs with several blocks meet the members of all blocks. So a group of
    near copies costs in proportion to its size, and pairs never leave a task.
    """
    sizes = sketches.where("id IS NOT NULL").groupBy(F.col("id").alias("node")).agg(F.max("n").alias("n"))
    sized = stored(shared.join(sizes, "node"), "sized")
    large = _measured(_blocks_of(sized, "blocks").where("blocks > 1"), "large-hubs")
    dealt = sized.join(large, "hub", "left").withColumn("blocks", F.coalesce("blocks", F.lit(1)))
    dealt = dealt.withColumn("block", F.pmod(F.xxhash64("node"), "blocks").cast("int"))
    dealt = stored(dealt.select("hub", "node", "n", "blocks", "block"), "dealt")

    def with_texts(rows: DataFrame, name: str) -> DataFrame:
        wanted = _measured(rows.select(F.col("node").alias("id")).distinct(), name)
        needed = texts.join(wanted, "id", "left_semi")
        return rows.join(needed, rows["node"] == needed["id"]).drop("id")

    def sets_of(group: pa.Table) -> tuple[list, list[np.ndarray]]:
        texts = group["text"].combine_chunks()
        texts = pa.concat_arrays(texts.chunks) if isinstance(texts, pa.ChunkedArray) else texts
        return group["node"].to_pylist(), list(shingle_sets(texts, shingle))

    schema = f"hub {id_type}, a {id_type}, b {id_type}"

    def linked(group: pa.Table, pairs: list[tuple]) -> pa.Table:
        kind = group.schema.field("node").type
        a, b = [a for a, _ in pairs], [b for _, b in pairs]
        hubs = [group["hub"][0].as_py()] * len(pairs)
        return pa.table({"hub": pa.array(hubs, kind), "a": pa.array(a, kind), "b": pa.array(b, kind)})

    def within(group: pa.Table) -> pa.Table:
        ids, sets = sets_of(group)
        hub, everyone = group["hub"][0].as_py(), np.ones(len(ids), bool)
        found, roots = _links(ids, sets, everyone, everyone, hub)
        joined = {r for node, r in zip(ids, roots, strict=True) if node == hub}
        apart = {node for node, r in zip(ids, roots, strict=True) if r not in joined}
        if group["blocks"][0].as_py() == 1:
            apart = set()
        return linked(group, found + [(node, None) for node in sorted(apart)])

    def across(group: pa.Table) -> pa.Table:
        ids, sets = sets_of(group)
        asked = np.array(group["asked"].to_pylist())
        return linked(group, _links(ids, sets, asked, ~asked)[0])

    everywhere = F.sequence(F.lit(0), F.col("blocks") - 1)
    own = F.when(F.col("node") == F.col("hub"), everywhere).otherwise(F.array("block"))
    rows = with_texts(dealt.select("hub", "node", "blocks", F.explode(own).alias("block")), "members")
    judged = stored(rows.groupBy("hub", "block").applyInArrow(within, schema), "judged")
    links = judged.where("b IS NOT NULL").select("a", "b")

    apart = judged.where("b IS NULL").select("hub", F.col("a").alias("node")).distinct()
    apart = stored(dealt.join(apart, ["hub", "node"], "left_semi"), "apart")
    parts = _blocks_of(apart, "parts")
    if parts.isEmpty():
        return links
    parts = _measured(parts, "parts")
    part = F.pmod(F.xxhash64("node"), "parts").cast("int")
    asking = apart.join(parts, "hub").select(
        "hub", "node", part.alias("part"), F.explode(everywhere).alias("block"), F.lit(True).alias("asked")
    )
    every_part = F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")
    told = dealt.join(parts, "hub").select("hub", "node", every_part, "block", F.lit(False).alias("asked"))
    rows = with_texts(asking.unionByName(told), "asked")
    more = rows.groupBy("hub", "part", "block").applyInArrow(across, schema)
    # A document with two texts is one node, and its own links join it.
    return links.unionByName(stored(more, "links").select("a", "b"))


def drop_near_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` whose id is the smallest of its component, and those without links.

    Rows without an id stay. All columns are kept.
    """
    classes = jaccard_components(docs.select(id_col, text_col), id_col, text_col)
    gone = classes.where(F.col("component_id") != F.col(id_col)).select(F.col(id_col).alias("id"))
    gone = stored(gone.distinct(), "gone")
    gone = sized_broadcast(gone, gone.count() * 48, BROADCAST_LIMIT)
    same = F.col(f"d.{id_col}") == F.col("x.id")
    return docs.alias("d").join(gone.alias("x"), same, "left_anti")
