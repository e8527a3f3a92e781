"""Alignment of two tokenizers by pointer jumping over token occurrences.

Both tokenizers cut the same bytes, so every token is a byte range. In a portion of texts all tokens
are laid end to end, and every token points to its farthest-right overlapping token of the other
tokenizer, if that ends later (of two that end together, the second tokenizer's token is the
terminal one). Doubling all pointers at once, until none changes, leads every token to the terminal
token of its component; the terminal's number is the label of the group.

A stretch between two neighbouring token ends lies in exactly one token of each side, so these
stretches are the links. A text is read as units, cut before single spaces, where both tokenizers
cut too. A unit is encoded once while it is remembered, and its links are stored once per portion;
the texts of a portion are lists of units. Counts of linked ids are summed in Spark over all
portions, and every portion gets back the counts of its own pairs.
"""

from __future__ import annotations

import hashlib
import os
from collections.abc import Callable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from varve.llm.common import broadcast_file, portions_of, release_memory, ship_package, stored

SPACE = "▁"
PORTION_BYTES = 1_000_000
UNIT_LIMIT = 300_000  # remembered units of a worker, and the ids of either side
ID_LIMIT = 3_000_000
UNITS_AT_ONCE = 2_000
# White space but for the space itself, and marks that some pattern may take for it.
BLANKS = [chr(c) for c in (*range(9, 14), *range(28, 32), 0x85, 0xA0, 0x1680, 0x180E, *range(0x2000, 0x200C), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000, 0xFEFF)]


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all entries of runs that begin at ``starts``."""
    ends = np.cumsum(sizes)
    return np.arange(int(sizes.sum())) + np.repeat(starts - (ends - sizes), sizes)


def is_plain(text: str) -> bool:
    """Whether both tokenizers cut a space and the text before every space.

    They may not where a space stands beside white space, or where a text begins or ends with it.
    """
    if text[0].isspace() or text[-1].isspace() or "  " in text or SPACE in text:
        return False
    beside = (b for b in BLANKS if b in text)
    return not any(b + " " in text or " " + b in text or text[0] == b or text[-1] == b for b in beside)


class Spelled:
    """One tokenizer: the ids of texts, and the bytes that an id stands for."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], spelling: list[bytes]):
        self.encode = encode
        self.sizes = np.array([len(s) for s in spelling], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.data = np.frombuffer(b"".join(spelling), np.uint8)

    def bytes_of(self, ids: np.ndarray) -> np.ndarray:
        return self.data[_spread(self.starts[ids], self.sizes[ids])]

    def encode_each(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of texts end to end, and how many each has."""
        ids = self.encode(texts) if texts else []
        sizes = np.array([len(i) for i in ids], np.int64)
        return np.fromiter(chain.from_iterable(ids), np.int32, int(sizes.sum())), sizes

    def encode_units(self, units: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The same for plain units, many in one text each: the cuts show in the tokens' bytes."""
        parts = [units[k : k + UNITS_AT_ONCE] for k in range(0, len(units), UNITS_AT_ONCE)]
        found = []
        for part, ids in zip(parts, self.encode([" ".join(p) for p in parts]) if parts else [], strict=True):
            flat = np.array(ids, np.int32)
            at = np.cumsum(self.sizes[flat])
            data = np.frombuffer((" " + " ".join(part)).encode(), np.uint8)
            ends = np.append(np.flatnonzero(data == 32)[1:], len(data))
            last = np.searchsorted(at, ends)
            if at[-1] == len(data) and (at[last] == ends).all():
                found.append((flat, np.diff(last, prepend=-1)))
            else:  # a unit that is not given back byte for byte
                found.append(self.encode_each(part))
        flat = [f for f, _ in found] or [np.zeros(0, np.int32)]
        return np.concatenate(flat), np.concatenate([z for _, z in found] or [np.zeros(0, np.int64)])


def byte_level(data: bytes) -> Spelled:
    """A byte-level tokenizer file; every text gets a space in front."""
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
    tokenizer = Tokenizer.from_str(data.decode())
    tokenizer.encode_special_tokens = True
    tokenizer.no_truncation()
    tokenizer.no_padding()
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    letters = {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(others)}
    vocabulary = tokenizer.get_vocab()
    spelling = [b""] * (max(vocabulary.values()) + 1)
    for token, i in vocabulary.items():
        spelled = letters.keys() >= set(token)
        spelling[i] = bytes(letters[c] for c in token) if spelled else token.encode()

    def encode(texts):
        coded = tokenizer.encode_batch_fast([" " + t for t in texts], add_special_tokens=False)
        return [c.ids for c in coded]

    return Spelled(encode, spelling)


def pieces(data: bytes) -> Spelled:
    """A SentencePiece model that puts a space in front of a text itself."""
    model = sentencepiece.SentencePieceProcessor(model_proto=data)
    spelling = []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        spelling.append(bytes([int(piece[3:5], 16)]) if model.is_byte(i) else piece.replace(SPACE, " ").encode())
    return Spelled(lambda texts: model.encode(texts, num_threads=1), spelling)


def terminals(ends_a: np.ndarray, ends_b: np.ndarray) -> np.ndarray:
    """For every token, first all of A, then all of B, the terminal token of its component.

    ``ends`` are the rising ends of tokens that cover the same bytes; the last ends are equal.
    """
    many = len(ends_a)
    at, in_a, in_b, of_a, of_b = stretches(ends_a, ends_b)
    other = many + of_b[in_a]  # the token of B that holds the last byte of A's
    own = many + np.arange(len(ends_b))
    to = np.concatenate([other, np.where(in_a[in_b], own, of_a[in_b])])
    while True:
        doubled = to[to]
        if np.array_equal(doubled, to):
            return to
        to = doubled


def stretches(ends_a: np.ndarray, ends_b: np.ndarray) -> tuple[np.ndarray, ...]:
    """The ends of all stretches between neighbouring ends, whether a token of A or of B ends there,
    and the token of either side that holds the stretch."""
    mark = np.zeros((int(ends_a[-1]) if len(ends_a) else 0) + 1, np.uint8)
    mark[ends_a] = 1
    mark[ends_b] |= 2
    at = np.flatnonzero(mark)
    in_a, in_b = (mark[at] & 1) > 0, mark[at] > 1
    return at, in_a, in_b, np.cumsum(in_a) - in_a, np.cumsum(in_b) - in_b


class Aligner:
    """Both tokenizers of a worker, and the units encoded so far (bounded)."""

    def __init__(self, a: bytes, b: bytes):
        self.sides = byte_level(a), pieces(b)
        many = max(len(side.sizes) for side in self.sides)
        self.written = [f"{i}{mark}" for mark in (",", "|", ";", "") for i in range(many)]
        self.ids = many
        self.forget()

    def forget(self) -> None:
        self.known: dict[str, int] = {}
        self.ends = [np.zeros(1, np.int64) for _ in self.sides]
        self.coded = [np.zeros(0, np.int32) for _ in self.sides]

    def learn(self, units: list[str]) -> list[tuple[np.ndarray, np.ndarray]]:
        """For either side the ids of distinct plain units end to end, and how many each has."""
        new = [u for u in units if u not in self.known]
        if len(self.known) + len(new) > UNIT_LIMIT or max(map(len, self.coded)) > ID_LIMIT:
            self.forget()
            new = units
        self.known.update(zip(new, range(len(self.known), len(self.known) + len(new)), strict=True))
        at = np.fromiter(map(self.known.__getitem__, units), np.int64, len(units))
        found = []
        for k, side in enumerate(self.sides):
            flat, sizes = side.encode_units(new)
            self.coded[k] = np.concatenate([self.coded[k], flat])
            self.ends[k] = np.concatenate([self.ends[k], self.ends[k][-1] + np.cumsum(sizes)])
            first, sizes = self.ends[k][at], self.ends[k][at + 1] - self.ends[k][at]
            found.append((self.coded[k][_spread(first, sizes)], sizes))
        return found

    def portion(self, texts: list[str]) -> dict:
        """Counts and groups of every text, the links of every distinct unit, and their pairs."""
        cut = [t.split(" ") if t and is_plain(t) else [] for t in texts]
        plain = list(set().union(*cut))
        odd = list({t for t, c in zip(texts, cut, strict=True) if t and not c})
        number = dict(zip(plain, range(len(plain)), strict=True))
        whole_text = dict(zip(odd, range(len(plain), len(plain) + len(odd)), strict=True))
        cut = [c or ([t] if t else []) for t, c in zip(texts, cut, strict=True)]
        number |= whole_text  # no odd text is a plain unit of another: it has a space or an edge
        units = np.fromiter(map(number.__getitem__, chain.from_iterable(cut)), np.int64)
        per_text = np.array([len(c) for c in cut], np.int64)
        del cut, number
        known = [
            (np.concatenate([flat, more]), np.concatenate([sizes, many]))
            for (flat, sizes), (more, many) in zip(
                self.learn(plain), (side.encode_each(odd) for side in self.sides), strict=True
            )
        ]

        # A unit whose bytes a tokenizer changes leaves its texts without tokens.
        wanted = [b" " + n.encode() for n in chain(plain, odd)]
        lengths = np.array([len(w) for w in wanted], np.int64)
        data = np.frombuffer(b"".join(wanted), np.uint8)
        del wanted
        right = np.ones(len(lengths), bool)
        for side, (ids, sizes) in zip(self.sides, known, strict=True):
            right &= _sums(side.sizes[ids], sizes) == lengths
            spelled = side.bytes_of(ids[np.repeat(right, sizes)])
            same = spelled == data[np.repeat(right, lengths)]
            right[right] = _sums(same, lengths[right]) == lengths[right]
        if not right.all():
            text_of = np.repeat(np.arange(len(texts)), per_text)
            whole = np.bincount(text_of[~right[units]], minlength=len(texts)) == 0
            units, per_text = units[whole[text_of]], per_text * whole

        (ids_a, many_a), (ids_b, many_b) = [_laid(ids, sizes, units) for ids, sizes in known]
        ends_a, ends_b = [np.cumsum(s.sizes[i]) for s, i in zip(self.sides, (ids_a, ids_b), strict=True)]
        root = terminals(ends_a, ends_b)
        is_terminal = np.zeros(len(root), bool)
        is_terminal[root] = True
        group = (np.cumsum(is_terminal) - 1)[root]
        n_a, n_b = _sums(many_a, per_text), _sums(many_b, per_text)
        n_groups = _sums(is_terminal[len(ids_a) :], n_b)
        groups = self._written(ids_a, ids_b, group, n_a + n_b)
        del root, group, is_terminal

        at, _, _, of_a, of_b = stretches(ends_a, ends_b)
        unit_ends = np.searchsorted(at, np.cumsum(lengths[units]), "right")
        n_links = _sums(np.diff(unit_ends, prepend=0), per_text)

        # Each unit's links once, from its first occurrence; common units get the low numbers.
        used, first, back, times = np.unique(units, return_index=True, return_inverse=True, return_counts=True)
        order = np.argsort(-times, kind="stable")
        place = np.empty(len(used), np.int64)
        place[order] = np.arange(len(used))
        first, times = first[order], times[order]
        starts = np.concatenate([[0], unit_ends])[first]
        sizes = unit_ends[first] - starts
        chosen = _spread(starts, sizes)
        keys = ids_a[of_a[chosen]].astype(np.int64) << 32 | ids_b[of_b[chosen]]
        pairs, link = np.unique(keys, return_inverse=True)
        counts = np.bincount(link, np.repeat(times, sizes), len(pairs)).astype(np.int64)
        return {
            "n_a": n_a, "n_b": n_b, "n_groups": n_groups, "n_links": n_links, "groups": groups,
            "n_units": per_text, "units": place[back], "unit_links": sizes, "links": link,
            "pairs": pairs, "counts": counts,
        }

    def _written(self, ids_a, ids_b, group, tokens) -> list[str]:
        """Each text's groups, as ids: ``a1,a2|b1;a3|b2``."""
        in_a, in_b = group[: len(ids_a)], group[len(ids_a) :]
        last = int(group.max(initial=-1)) + 1
        many_a, many_b = np.bincount(in_a, minlength=last), np.bincount(in_b, minlength=last)
        at_a = np.arange(len(in_a)) + (np.cumsum(many_b) - many_b)[in_a]
        at_b = np.arange(len(in_b)) + np.cumsum(many_a)[in_b]
        words = np.zeros(len(group), np.int64)
        words[at_a], words[at_b] = ids_a, ids_b
        # A comma follows unless another mark does: at a group's last token of A, of B, at the text's end.
        mark = np.zeros(len(group), np.int64)
        ends_a = np.cumsum(many_a + many_b) - many_b - 1
        mark[ends_a], mark[ends_a + many_b] = 1, 2
        ends = np.cumsum(tokens)
        mark[ends[tokens > 0] - 1] = 3
        words, written = (mark * self.ids + words).tolist(), self.written
        starts = (ends - tokens).tolist()
        return ["".join(map(written.__getitem__, words[s:e])) for s, e in zip(starts, ends.tolist(), strict=True)]


def packed(numbers: np.ndarray) -> bytes:
    """Numbers below 2^32 as compressed bytes, all low bytes first, all high bytes last."""
    planes = np.ascontiguousarray(numbers.astype("<u4").view(np.uint8).reshape(-1, 4).T)
    return len(numbers).to_bytes(8, "little") + pa.compress(planes.tobytes(), "zstd", asbytes=True)


def unpacked(data: bytes) -> np.ndarray:
    many = int.from_bytes(data[:8], "little")
    planes = pa.decompress(data[8:], 4 * many, "zstd", asbytes=True) if many else b""
    planes = np.frombuffer(planes, np.uint8).reshape(4, many)
    return np.ascontiguousarray(planes.T).view("<u4").ravel().astype(np.int64)


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The sums of neighbouring runs of these sizes; 0 for an empty run."""
    total = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    ends = np.cumsum(sizes)
    return total[ends] - total[ends - sizes]


def _laid(ids: np.ndarray, sizes: np.ndarray, units: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The ids of ``units`` end to end, and how many each has."""
    starts, many = (np.cumsum(sizes) - sizes)[units], sizes[units]
    return ids[_spread(starts, many)], many


_aligners: dict[int, Aligner] = {}


def _aligner(a: bytes, b: bytes) -> Aligner:
    """One per worker process; what it remembers is bounded and goes with each new pair of files."""
    key = hash((a, b))
    if key not in _aligners:
        _aligners.clear()
        _aligners[key] = Aligner(a, b)
    return _aligners[key]


PER_TEXT = ("n_a", "n_b", "n_groups", "n_links", "n_units")
PACKED = ("units", "unit_links", "links")
PER_PAIR = ("pairs", "counts")


def align_tokens(
    docs: DataFrame,
    bytes_path: str,
    pieces_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    digest: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_a``, ``n_b`` (tokens of either side), ``n_groups``,
    ``n_links``, ``n_best``, ``count_sum`` and ``groups`` (or, with ``digest``, ``groups_sha256``).

    A is a byte-level tokenizer file, B a SentencePiece model; both read a space and the text.
    ``groups`` lists the ids between the ends that both share, as ``a1,a2|b1;a3|b2,b3``. A link is
    an overlapping pair of occurrences; an id pair counts how many links hold it in all of
    ``docs``. ``n_best`` counts the links whose pair is the commonest of its B id, ties included,
    ``count_sum`` adds the counts of all links. NULL and empty texts, and texts that a tokenizer
    does not give back byte for byte, have no tokens: zeros and an empty string. Rows without an
    id, and repeated rows, come out like others, and their links count. A very long text is one
    portion by itself. An empty table gives no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    files = [broadcast_file(spark, path) for path in (bytes_path, pieces_path)]
    id_type = docs.schema[id_col].dataType.simpleString()
    last = "groups_sha256" if digest else "groups"
    schema = ", ".join(
        ["portion long", f"ids array<{id_type}>", *(f"{c} array<int>" for c in PER_TEXT)]
        + [f"{c} binary" for c in PACKED]
        + [f"{c} array<long>" for c in PER_PAIR]
        + [f"{last} array<string>"]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _aligner(*(f.value for f in files))
        portion = TaskContext.get().partitionId() << 32
        for batch in batches:
            done = 0
            for texts in portions_of(batch.column(1), PORTION_BYTES):
                found = aligner.portion(texts)
                groups = found["groups"]
                if digest:
                    groups = [hashlib.sha256(g.encode()).hexdigest() if g else "" for g in groups]
                row = {"portion": pa.array([portion]), "ids": _listed(batch.column(0).slice(done, len(texts)))}
                row |= {c: _listed(pa.array(found[c].astype(np.int32))) for c in PER_TEXT}
                row |= {c: pa.array([packed(found[c])], pa.binary()) for c in PACKED}
                row |= {c: _listed(pa.array(found[c])) for c in PER_PAIR}
                row[last] = _listed(pa.array(groups, pa.string()))
                yield pa.RecordBatch.from_pydict(row)
                portion += 1
                done += len(texts)
        aligner.forget()
        release_memory()

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    portions = stored(rows.mapInArrow(run, schema), "portions")
    counted = pair_counts(portions)
    joined = portions.drop("pairs", "counts").join(counted, "portion", "left")
    return joined.mapInArrow(
        _finish(last), f"id {id_type}, n_a long, n_b long, n_groups long, n_links long, n_best long, "
        f"count_sum long, {last} string",
    ).withColumnRenamed("id", id_col)


def _listed(values: pa.Array) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), values)


def pair_counts(portions: DataFrame) -> DataFrame:
    """(portion, counted): for every pair of a portion its place, its count in all portions, and
    whether that is the highest of its B id. A portion names a pair once, so a common pair is one
    row per portion at most, and sums meet in the tasks first.
    """
    named = portions.select("portion", F.posexplode(F.arrays_zip("pairs", "counts")).alias("place", "own"))
    named = named.select("portion", "place", F.col("own.pairs").alias("pair"), F.col("own.counts").alias("n"))
    totals = stored(named.groupBy("pair").agg(F.sum("n").alias("total")), "totals")
    totals = totals.withColumn("b", F.col("pair").bitwiseAND(F.lit((1 << 32) - 1)))
    highest = totals.groupBy("b").agg(F.max("total").alias("highest"))
    judged = totals.join(highest, "b").select("pair", "total", (F.col("total") == F.col("highest")).alias("best"))
    back = named.select("portion", "place", "pair").join(judged, "pair")
    return back.groupBy("portion").agg(F.collect_list(F.struct("place", "total", "best")).alias("counted"))


def _finish(last: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(batch.num_rows):
                cells = {c: batch.column(c)[k] for c in batch.schema.names}
                many = {c: cells[c].values.to_numpy(zero_copy_only=False).astype(np.int64) for c in PER_TEXT}
                units, unit_links, links = (unpacked(cells[c].as_py()) for c in PACKED)
                counted = cells["counted"].values
                total = np.zeros(0 if counted is None else len(counted), np.int64)
                best = np.zeros(len(total), bool)
                if len(total):
                    place = counted.field("place").to_numpy()
                    total[place] = counted.field("total").to_numpy()
                    best[place] = counted.field("best").to_numpy(zero_copy_only=False)
                result = [cells["ids"].values, *(pa.array(many[c]) for c in PER_TEXT[:4])]
                for per_pair in (best, total):
                    per_unit = _sums(per_pair[links], unit_links)
                    result.append(pa.array(_sums(per_unit[units], many["n_units"])))
                names = ["id", *PER_TEXT[:4], "n_best", "count_sum", last]
                yield pa.RecordBatch.from_arrays([*result, cells[last].values], names=names)

    return run
