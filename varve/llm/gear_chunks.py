"""Passages that repeat across documents, by content-defined chunking.

A gear hash rolls over the UTF-8 bytes of each text; where it is smallest among its neighbours, a
chunk ends. The cut depends on the 19 bytes before it and the 11 behind only, so text inserted
before a passage moves its chunks but does not change them, and no chunk is very long by chance: of
a passage, whole chunks hold all but a few words at its ends. Chunks are matched by digest: the grouping keeps two ids per digest, so a chunk
that stands in a third of all documents is no heavy task. Neighbouring chunks that other documents
share as well are put together to spans; short spans are chance and are left out.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.common import ship_package
from varve.llm.part_enum import mix

WINDOW = 8  # bytes that a gear hash of 32 bits, 4 a byte, depends on
REACH = 11  # a cut's hash is the smallest within so many bytes on either side
LONGEST = 256
MIN_WORDS = 26  # in whole chunks; a passage is longer by what its ends lose
BATCH_BYTES = 4_000_000

_GEAR = (mix(np.arange(256, dtype=np.uint64) + np.uint64(1000)) >> np.uint64(32)).astype(np.uint32)
_BYTE = mix(np.arange(256, dtype=np.uint64) + np.uint64(5000))
_BASE = 0x5851F42D4C957F2D
_NO_CUT = 0xFFFFFFFF


def gear_hashes(data: np.ndarray) -> np.ndarray:
    """The gear hash after each byte; the first ``WINDOW`` - 1 lack some of their past."""
    h, reach = _GEAR[data], 1
    while reach < WINDOW:
        h[reach:] = h[reach:] + (h[:-reach] << np.uint32(32 // WINDOW * reach))
        reach *= 2
    return h


def _smallest_of(h: np.ndarray, width: int) -> np.ndarray:
    """The smallest of each ``width`` neighbours, by the first of them."""
    have = 1
    while have < width:
        step = min(have, width - have)
        h = np.minimum(h[:-step], h[step:])
        have += step
    return h


def cut_points(data: np.ndarray) -> np.ndarray:
    """Offsets at which chunks end, the last one at the end of ``data``; none within a letter."""
    n = len(data)
    if not n:
        return np.zeros(0, np.int64)
    ends = np.zeros(0, np.int64)
    if n > WINDOW + 2 * REACH:
        # Hashes by the offset behind them, where a chunk could end; 0 to n - 1 are at hand.
        h = np.r_[np.uint32(_NO_CUT), gear_hashes(data[:-1])]
        h[(data & 0xC0) == 0x80] = _NO_CUT
        h = h[WINDOW:]
        least = _smallest_of(h, REACH)
        inner = h[REACH : len(h) - REACH]
        here = (inner < least[: len(inner)]) & (inner <= least[REACH + 1 :])
        ends = np.flatnonzero(here & (inner != _NO_CUT)) + WINDOW + REACH
    edges = np.r_[0, ends, n]
    gaps = np.diff(edges)
    if gaps.max() <= LONGEST:
        return edges[1:]
    cuts = []
    for first, last in zip(edges[:-1].tolist(), edges[1:].tolist(), strict=True):
        at = first + LONGEST
        while at < last:
            while (data[at] & 0xC0) == 0x80:
                at -= 1
            cuts.append(at)
            at += LONGEST
        cuts.append(last)
    return np.array(cuts, np.int64)


def word_marks(data: np.ndarray) -> np.ndarray:
    """For each byte the quarters of words that it adds: four where white space ends a word.

    In scripts without spaces two letters (Han, kana) or four (Thai, Lao, Burmese, Khmer) make a word.
    """
    space = (data == 0x20) | ((data >= 0x09) & (data <= 0x0D))
    marks = np.zeros(len(data), np.int64)
    marks[1:] = 4 * (space[1:] & ~space[:-1])
    if len(data) and data.max() >= 0xE0:
        second = np.r_[data[1:], np.uint8(0)]
        marks[((data >= 0xE3) & (data <= 0xE9)) | ((data == 0xF0) & (second >= 0xA0))] = 2
        thai = (data == 0xE0) & (second >= 0xB8) & (second <= 0xBB)
        burmese = (data == 0xE1) & (second >= 0x80) & (second <= 0x82)
        khmer = (data == 0xE1) & (second >= 0x9E) & (second <= 0x9F)
        marks[thai | burmese | khmer] = 1
    return marks


def chunk_digests(data: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 64-bit digest of every chunk, and the number of words that end in it."""
    starts = np.r_[0, ends[:-1]]
    lengths = ends - starts
    # Each chunk is a polynomial in its own offsets, so equal chunks agree wherever they stand.
    place = np.arange(len(data)) - np.repeat(starts, lengths)
    powers = np.full(int(lengths.max()), _BASE, np.uint64)
    powers[0] = 1
    powers = np.cumprod(powers, dtype=np.uint64)
    digests = np.add.reduceat(_BYTE[data] * powers[place], starts)
    words = np.diff(np.cumsum(word_marks(data))[ends - 1] // 4, prepend=0)
    return mix(digests ^ mix(lengths.astype(np.uint64))), words


def chunks(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, nth, start, n_bytes, n_words, digest): the chunks of every text, in order.

    NULL and empty texts have none. ``start`` counts bytes of the UTF-8 text.
    """
    ship_package(docs.sparkSession)
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["id", "nth", "start", "n_bytes", "n_words", "digest"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for i, text in enumerate(batch.column(1)):
                data = np.frombuffer(text.as_buffer(), np.uint8)
                if len(data):
                    ends = cut_points(data)
                    digests, words = chunk_digests(data, ends)
                    starts = np.r_[0, ends[:-1]]
                    nth = np.arange(len(ends))
                    rows.append((np.full(len(ends), i), nth, starts, ends - starts, words, digests.view(np.int64)))
                    size += len(data)
                if rows and (size >= BATCH_BYTES or i == batch.num_rows - 1):
                    owner, *rest = (np.concatenate(c) for c in zip(*rows, strict=True))
                    ids = batch.column(0).take(pa.array(owner))
                    kinds = [pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64()]
                    arrays = [pa.array(c).cast(k) for c, k in zip(rest, kinds, strict=True)]
                    yield pa.RecordBatch.from_arrays([ids, *arrays], names=names)
                    rows, size = [], 0

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).cast("binary").alias("text")
    )
    schema = f"id {id_type}, nth int, start int, n_bytes int, n_words int, digest long"
    return rows.mapInArrow(run, schema)


def _totals(groups: np.ndarray, words: np.ndarray) -> np.ndarray:
    """For every row the words of its group; ``groups`` are numbered from 0."""
    return np.bincount(groups, words)[groups]


def _holders_apart(pieces: np.ndarray, firsts: np.ndarray, words: np.ndarray, min_words: int) -> np.ndarray:
    """``pieces`` broken where the first holder changes, but into parts of ``min_words`` words.

    A shorter part goes to the long one before it, or else to the next, so that a chunk that
    stands elsewhere by chance breaks nothing.
    """
    parts = np.cumsum(np.r_[True, (np.diff(pieces) != 0) | (np.diff(firsts) != 0)]) - 1
    long_ = _totals(parts, words) >= min_words
    head = np.r_[True, np.diff(parts) != 0] & long_
    seen = np.cumsum(head)
    opens = np.flatnonzero(np.r_[True, np.diff(pieces) != 0])
    before = np.repeat(seen[opens] - head[opens], np.diff(np.r_[opens, len(pieces)]))
    within = np.maximum(seen - before, 1)  # what stands before a piece's first long part joins it
    return np.cumsum(np.r_[True, (np.diff(pieces) != 0) | (np.diff(within) != 0)]) - 1


def _spans(rows: pa.Table, min_words: int) -> pa.RecordBatch:
    """The spans of some documents from all their shared chunks, ordered by id and start."""
    ids, firsts = rows.column("id").combine_chunks(), rows.column("first_id").combine_chunks()
    codes = firsts.dictionary_encode().indices.to_numpy()
    start, size, words = (rows.column(c).to_numpy().astype(np.int64) for c in ("start", "n_bytes", "n_words"))
    own = rows.column("own").to_numpy()
    other_id = np.r_[True, pc.not_equal(ids.slice(1), ids.slice(0, len(ids) - 1)).to_numpy(zero_copy_only=False)]
    gap = other_id | np.r_[True, start[1:] != start[:-1] + size[:-1]]
    stretches = np.cumsum(gap | np.r_[True, own[1:] != own[:-1]]) - 1
    kept = own | (_totals(stretches, words) < min_words)
    pieces = np.cumsum(gap | np.r_[True, kept[1:] != kept[:-1]]) - 1
    parts = _holders_apart(pieces, np.where(kept, -1, codes), words, min_words)
    head = np.flatnonzero(np.r_[True, np.diff(parts) != 0])
    n_words = np.add.reduceat(words, head)
    # A part's first holder is the one of most of its words.
    pairs, where, of = np.unique(parts * (int(codes.max()) + 1) + codes, return_index=True, return_inverse=True)
    weight = np.bincount(of, words)
    order = np.lexsort((where, -weight, parts[where]))
    lead = where[order[np.r_[True, np.diff(parts[where][order]) != 0]]]
    holder = np.where(kept[head], head, lead)
    wanted = n_words >= min_words
    head, holder, n_words = head[wanted], holder[wanted], n_words[wanted]
    n_bytes = np.add.reduceat(size, np.flatnonzero(np.r_[True, np.diff(parts) != 0]))[wanted]
    first_id = pc.if_else(pa.array(kept[head]), ids.take(pa.array(head)), firsts.take(pa.array(holder)))
    numbers = [pa.array(x).cast(pa.int32()) for x in (start[head], n_bytes, n_words)]
    return pa.RecordBatch.from_arrays(
        [ids.take(pa.array(head)), *numbers, first_id, pa.array(kept[head])],
        names=["id", "start", "n_bytes", "n_words", "first_id", "kept"],
    )


def repeated_spans(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_words: int = MIN_WORDS,
) -> DataFrame:
    """One row per span of a document that other documents hold as well: id, ``start`` and
    ``n_bytes`` (in the UTF-8 text), ``n_words``, ``first_id``, ``kept``.

    A span is a run of neighbouring chunks that each stand in two documents at least, with
    ``min_words`` words or more, which any shared passage of 51 words has but by rare chance. It is ``kept`` where this document is the first holder (the
    smallest id) of its chunks, and not where others are; a run of both kinds is broken between
    them. A stretch of less than ``min_words`` words whose first holders are others is chance and
    stays with the kept chunks around it. So no chunk is ever cut from its first holder, and
    removing the spans that are not kept leaves every passage in one place. ``first_id`` is the
    first holder of the span's chunks; neighbouring spans of different first holders are rows of
    their own, and chunks too few for one go to the span beside them. Repeats within one document
    alone are no span. Rows with the same id are one document; rows without an id are left out, as
    are NULL and empty texts. An empty table gives no rows.
    """
    found = chunks(docs.where(F.col(id_col).isNotNull()), id_col, text_col)
    holders = (
        found.groupBy("digest")
        .agg(F.min("id").alias("first_id"), F.max("id").alias("last_id"))
        .where("first_id != last_id")
        .select("digest", "first_id")
    )
    own = (F.col("first_id") == F.col("id")).alias("own")
    shared = found.join(holders, "digest").select("id", "nth", "start", "n_bytes", "n_words", "first_id", own)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest = None  # the last document's chunks may go on in the next batch
        for batch in batches:
            if not batch.num_rows:
                continue
            rows = pa.Table.from_batches([batch])
            rows = pa.concat_tables([rest, rows]) if rest else rows
            ids = rows.column("id").combine_chunks()
            last = pc.index(pc.equal(ids, ids[-1]), True).as_py()
            if last:
                yield _spans(rows.slice(0, last), min_words)
            rest = rows.slice(last)
        if rest:
            yield _spans(rest, min_words)

    id_type = found.schema["id"].dataType.simpleString()
    schema = f"id {id_type}, start int, n_bytes int, n_words int, first_id {id_type}, kept boolean"
    spans = shared.repartition("id").sortWithinPartitions("id", "start", "nth").mapInArrow(run, schema)
    return spans.withColumnRenamed("id", id_col)


def remove_spans(
    docs: DataFrame, spans: DataFrame, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """``docs`` with the spans that are not kept cut out of their texts; the rest is unchanged."""
    cut = spans.where("NOT kept").groupBy(F.col(id_col).alias("id")).agg(
        F.sort_array(F.collect_list(F.struct("start", "n_bytes"))).alias("cuts")
    )
    text = F.col(f"d.{text_col}")
    data = text.cast("binary")
    start = F.struct(F.lit(0).alias("at"), F.lit(b"").alias("left"))
    kept = F.aggregate(
        "x.cuts",
        start,
        lambda so_far, c: F.struct(
            (c["start"] + c["n_bytes"]).alias("at"),
            F.concat(so_far["left"], F.substring(data, so_far["at"] + 1, c["start"] - so_far["at"])).alias("left"),
        ),
        lambda end: F.concat(end["left"], F.substring(data, end["at"] + 1, F.octet_length(data))),
    )
    new = F.when(F.col("x.cuts").isNull(), text).otherwise(kept.cast("string")).alias(text_col)
    rows = docs.alias("d").join(cut.alias("x"), F.col(f"d.{id_col}") == F.col("x.id"), "left")
    return rows.select(*[new if c == text_col else F.col(f"d.`{c}`") for c in docs.columns])
