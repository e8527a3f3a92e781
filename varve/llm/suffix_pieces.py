"""SentencePiece encoding by suffix-array matching, and decoding.

The new words of a batch are concatenated and indexed by a suffix array. Every piece of the
vocabulary is found by binary search as one range of the array, which gives all its occurrences at
once. The occurrences are edges from a start to an end in a word; sorted by end, they are relaxed
from left to right: the edge that holds is the one whose piece may follow the last piece of the
prefix it starts from. Characters without a piece become bytes.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.bpe_paths import Pairs
from varve.llm.common import broadcast_file, portions_of, release_memory, ship_package

SPACE = "▁"
WORD_LIMIT = 300_000
BATCH_BYTES = 1_000_000
WORDS_AT_ONCE = 10_000
PAIR_LIMIT = 2_000_000


def _spread(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The places of all entries of runs that begin at ``starts``."""
    ends = np.cumsum(sizes)
    return np.arange(int(sizes.sum())) + np.repeat(starts - (ends - sizes), sizes)


class Pieces:
    """The pieces of a model file and the words encoded so far (bounded)."""

    def __init__(self, data: bytes):
        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        normal = [
            i
            for i in range(model.get_piece_size())
            if not (model.is_byte(i) or model.is_control(i) or model.is_unknown(i))
        ]
        self.ids = {model.id_to_piece(i): i for i in normal}
        scores = {p: model.get_score(i) for p, i in self.ids.items()}
        self.bytes = [0] * 256
        self.spelling = [b""] * model.get_piece_size()
        for i in range(model.get_piece_size()):
            if model.is_byte(i):
                value = int(model.id_to_piece(i)[3:5], 16)
                self.bytes[value] = i
                self.spelling[i] = bytes([value])
        for piece, i in self.ids.items():
            self.spelling[i] = piece.encode()
        self.pieces = sorted(self.ids)
        self.longest = max(map(len, self.pieces))
        letters = sorted({c for p in self.pieces for c in p})
        self.letters = {c: n for n, c in enumerate(letters, 1)}
        self.single = {p for p in self.pieces if len(p) == 1}
        self.pairs = Pairs(
            lambda a, b: -scores[a + b] if a + b in scores else None, list
        )
        # A word may be cut off where no piece goes on: before a space mark and round a line end.
        if any(SPACE in p.lstrip(SPACE) for p in self.pieces):
            raise ValueError("pieces with a space mark inside are not supported")
        breaks = "".join(c for c in "\n\t\r" if c not in self.letters)
        self.word = re.compile(f"[{breaks}]|{SPACE}*[^{SPACE}{breaks}]+|{SPACE}+")
        keys = np.zeros((len(self.pieces), self.longest), ">u2")
        for row, piece in zip(keys, self.pieces, strict=True):
            row[: len(piece)] = [self.letters[c] for c in piece]
        width = f"S{2 * self.longest}"
        self.low = keys.view(width).ravel()
        above = keys.copy()
        above[above == 0] = 0xFFFF
        self.high = above.view(width).ravel()
        self.lengths = np.array([len(p) for p in self.pieces])
        self.by_row = np.array([self.ids[p] for p in self.pieces])
        self.rows = {p: i for i, p in enumerate(self.pieces)}
        self.pair_keys, self.pair_fits = np.zeros(0, np.int64), np.zeros(0, bool)
        # What the ids stand for in a text, end to end.
        plain = [b.replace(SPACE.encode(), b" ") for b in self.spelling]
        self.plain = np.frombuffer(b"".join(plain), np.uint8)
        self.plain_sizes = np.array([len(b) for b in plain], np.int64)
        self.plain_starts = np.cumsum(self.plain_sizes) - self.plain_sizes
        self.forget()

    def forget(self) -> None:
        """Drops the words encoded so far; what is known of pairs stays, which is far smaller."""
        self.known: dict[str, int] = {}
        self.ends = np.zeros(1, np.int64)  # of the known words' ids in ``coded``
        self.coded = np.zeros(0, np.int32)

    # ---- matching

    def occurrences(self, text: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start, row of piece) of every occurrence of every piece in ``text``."""
        n = len(text)
        rank, depth = text.astype(np.int64), 1
        while depth < self.longest:  # suffixes need no order beyond the longest piece
            further = np.zeros(n, np.int64)
            further[: max(0, n - depth)] = rank[depth:]
            _, rank = np.unique(rank * (further.max(initial=0) + 1) + further, return_inverse=True)
            rank = rank.astype(np.int64) + 1
            depth *= 2
        suffixes = np.argsort(rank, kind="stable")
        padded = np.concatenate([text, np.zeros(self.longest, text.dtype)]).astype(">u2")
        window = np.lib.stride_tricks.sliding_window_view(padded, self.longest)[suffixes]
        keys = np.ascontiguousarray(window).view(self.low.dtype).ravel()
        first = np.searchsorted(keys, self.low, "left")
        beyond = np.searchsorted(keys, self.high, "right")
        many = beyond - first
        row = np.repeat(np.arange(len(many)), many)
        within = np.arange(len(row)) - np.repeat(np.cumsum(many) - many, many)
        return suffixes[np.repeat(first, many) + within], row

    def encode_words(self, words: list[str]) -> list[list[int]]:
        """Piece ids of words that are made of known single pieces only."""
        if not words:
            return []
        starts = np.cumsum([0] + [len(w) + 1 for w in words])[:-1]
        text = np.zeros(int(starts[-1]) + len(words[-1]) + 1, np.int64)
        letters = self.letters
        joined = np.fromiter(
            (letters[c] for w in words for c in w), np.int64, sum(map(len, words))
        )
        lengths = np.array([len(w) for w in words])
        places = np.arange(len(joined)) + np.repeat(np.arange(len(words)), lengths)
        text[places] = joined
        begin, row = self.occurrences(text)
        end = begin + self.lengths[row]
        word_of = np.zeros(len(text), np.int64)
        word_of[places] = np.repeat(np.arange(len(words)), lengths)
        depth = end - starts[word_of[begin]]  # letters of the word up to the edge's end
        order = np.lexsort((-self.lengths[row], depth))
        begin, end, row, depth = begin[order], end[order], row[order], depth[order]
        last = np.full(len(text) + 1, -1)  # row of the last piece of the prefix that ends there
        came = np.zeros(len(text) + 1, np.int64)
        first_of = starts[word_of[begin]]
        cuts = np.searchsorted(depth, np.arange(1, int(lengths.max()) + 2))
        for low, high in zip(cuts[:-1], cuts[1:], strict=True):
            b, e, r = begin[low:high], end[low:high], row[low:high]
            before = np.where(b == first_of[low:high], -1, last[b])
            holds = self._hold(before, r)
            b, e, r = b[holds], e[holds], r[holds]
            last[e], came[e] = r, b
        ids, came, result = self.by_row[last].tolist(), came.tolist(), []
        for start, length in zip(starts.tolist(), lengths.tolist(), strict=True):
            at, path = start + length, []
            while at > start:
                path.append(ids[at])
                at = came[at]
            result.append(path[::-1])
        self._remember_pairs()
        return result

    def _hold(self, before: np.ndarray, row: np.ndarray) -> np.ndarray:
        """For each edge, whether its piece may follow piece ``before`` (-1: a word's start)."""
        base = len(self.pieces) + 1
        pairs, back = np.unique((before + 1) * base + row, return_inverse=True)
        fit = np.zeros(len(pairs), bool)
        if len(self.pair_keys):
            at = np.minimum(np.searchsorted(self.pair_keys, pairs), len(self.pair_keys) - 1)
            met = self.pair_keys[at] == pairs
            fit[met] = self.pair_fits[at[met]]
        else:
            met = np.zeros(len(pairs), bool)
        pieces = self.pieces
        for i in np.flatnonzero(~met).tolist():
            a, b = divmod(int(pairs[i]), base)
            fit[i] = self.pairs.fit(pieces[a - 1], pieces[b]) if a else self.pairs.fit(pieces[b])
        return fit[back]

    def _remember_pairs(self) -> None:
        """Files the pairs judged since, for lookups of many at once; their number is bounded."""
        base = len(self.pieces) + 1
        if len(self.pair_keys) > PAIR_LIMIT:
            self.pair_keys, self.pair_fits = self.pair_keys[:0], self.pair_fits[:0]
        rows = self.rows
        fresh = {
            (rows[t[0]] + 1) * base + rows[t[1]]: fits for t, fits in self.pairs.known.items()
        }
        self.pairs.known.clear()
        keys = np.r_[self.pair_keys, np.fromiter(fresh.keys(), np.int64, len(fresh))]
        fits = np.r_[self.pair_fits, np.fromiter(fresh.values(), bool, len(fresh))]
        self.pair_keys, first = np.unique(keys, return_index=True)
        self.pair_fits = fits[first]

    # ---- texts

    def learn(self, words: set[str]) -> None:
        """Encodes the words not met before."""
        if len(self.known) + len(words) > WORD_LIMIT:
            # The words of this portion stay, so the frequent ones are not encoded again.
            kept = [w for w in words if w in self.known]
            ids, sizes = self._ids_of(kept)
            self.known = dict(zip(kept, range(len(kept)), strict=True))
            self.coded, self.ends = ids, np.r_[0, np.cumsum(sizes)]
        plain, mixed = [], {}
        for word in words.difference(self.known):
            if self.single.issuperset(word):
                plain.append(word)
            else:
                mixed[word] = self._runs(word)
        runs = {r for parts in mixed.values() for r in parts if r[0] in self.single}
        plain += runs.difference(self.known).difference(plain)
        for at in range(0, len(plain), WORDS_AT_ONCE):
            part = [w for w in plain[at : at + WORDS_AT_ONCE] if w]
            self._add(part, self.encode_words(part))
        if "" in words and "" not in self.known:
            self._add([""], [[]])
        if mixed:
            ids = {r: self._ids_of([r])[0].tolist() for r in runs}
            self._add(
                list(mixed),
                [
                    [i for p in parts for i in (ids.get(p) or [self.bytes[b] for b in p.encode()])]
                    for parts in mixed.values()
                ],
            )

    def _add(self, words: list[str], coded: list[list[int]]) -> None:
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        sizes = np.array([len(c) for c in coded], np.int64)
        flat = np.fromiter(chain.from_iterable(coded), np.int32, int(sizes.sum()))
        self.coded = np.r_[self.coded, flat]
        self.ends = np.r_[self.ends, self.ends[-1] + np.cumsum(sizes)]

    def _ids_of(self, words) -> tuple[np.ndarray, np.ndarray]:
        """The ids of known words end to end, and how many each has."""
        at = np.fromiter(map(self.known.__getitem__, words), np.int64)
        first, sizes = self.ends[at], self.ends[at + 1] - self.ends[at]
        return self.coded[_spread(first, sizes)], sizes

    def _runs(self, word: str) -> list[str]:
        """The word cut into runs of letters with and without a piece."""
        cut: list[str] = []
        for c in word:
            if cut and (c in self.single) == (cut[-1][-1] in self.single):
                cut[-1] += c
            else:
                cut.append(c)
        return cut

    def words(self, text: str) -> list[str]:
        """The text cut where no piece goes on; some words may be empty."""
        if not text:
            return []
        if text[0] == " " or "  " in text or SPACE in text or "\n" in self.letters:
            return self.word.findall(SPACE + text.replace(" ", SPACE))
        return (SPACE + text.replace(" ", " " + SPACE).replace("\n", " \n ")).split(" ")

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts end to end, and how many each has."""
        words = [self.words(t) for t in texts]
        self.learn(set().union(*words))
        ids, sizes = self._ids_of(chain.from_iterable(words))
        ends = np.cumsum([len(w) for w in words]) if words else np.zeros(0, np.int64)
        total = np.r_[0, np.cumsum(sizes)][ends]
        return ids, np.diff(total, prepend=0)

    def decode_all(self, ids: np.ndarray, sizes: np.ndarray) -> pa.Array:
        """The texts of ids that :meth:`encode` gave."""
        lengths = self.plain_sizes[ids]
        data = self.plain[_spread(self.plain_starts[ids], lengths)]
        ends = np.r_[0, np.cumsum(lengths)][np.cumsum(sizes)]
        starts = np.r_[0, ends[:-1]]
        full = ends > starts
        # The space that every text was given in front goes again.
        gone = starts[full]
        keep = np.ones(len(data), bool)
        keep[gone] = False
        offsets = np.r_[0, np.cumsum(ends - starts - full)].astype(np.int64)
        buffers = [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(data[keep]))]
        return pa.LargeStringArray.from_buffers(len(sizes), *buffers[1:]).cast(pa.string())

    def decode(self, ids: list[int]) -> str:
        data = b"".join(map(self.spelling.__getitem__, ids)).decode("utf-8", "replace")
        return data.replace(SPACE, " ").removeprefix(" ")


_pieces: dict[int, Pieces] = {}


def _pieces_for(data: bytes) -> Pieces:
    """One model per worker process."""
    key = hash(data)
    if key not in _pieces:
        _pieces.clear()
        _pieces[key] = Pieces(data)
    return _pieces[key]


def encode(
    docs: DataFrame,
    model_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    with_text: bool = False,
) -> DataFrame:
    """One row per row of ``docs``: id, ``ids`` (piece ids of the whole text), ``n_tokens``, and
    if ``with_text`` the ``text`` decoded from them again.

    ``model_path`` names a byte-pair SentencePiece model with byte fallback, read once by the
    driver and broadcast. NULL and empty texts have no ids. Rows keep their order within a
    partition; nothing is shuffled. An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    data = broadcast_file(docs.sparkSession, model_path)
    id_type = docs.schema[id_col].dataType.simpleString()
    names = ["id", "ids", "n_tokens", *(["text"] if with_text else [])]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pieces = _pieces_for(data.value)
        for batch in batches:
            done = 0
            for texts in portions_of(batch.column(1), BATCH_BYTES):
                flat, sizes = pieces.encode(texts)
                offsets = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32)
                columns = [
                    batch.column(0).slice(done, len(texts)),
                    pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat)),
                    pa.array(sizes),
                ]
                if with_text:
                    columns.append(pieces.decode_all(flat, sizes))
                done += len(texts)
                yield pa.RecordBatch.from_arrays(columns, names=names)
        pieces.forget()
        release_memory()

    rows = docs.select(
        F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    schema = f"id {id_type}, ids array<int>, n_tokens long" + ", text string" * with_text
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)


def decode(
    coded: DataFrame, model_path: str, ids_col: str = "ids", text_col: str = "text"
) -> DataFrame:
    """``coded`` with the text of its ids; NULL ids give NULL, no ids an empty text.

    The text equals the one that was encoded unless that holds the space mark itself, which
    becomes a space. Bytes that are no UTF-8 become replacement characters.
    """
    ship_package(coded.sparkSession)
    data = broadcast_file(coded.sparkSession, model_path)

    @F.pandas_udf("string")
    def text_of(ids):
        pieces = _pieces_for(data.value)
        return ids.map(lambda x: None if x is None else pieces.decode(list(x)))

    return coded.withColumn(text_col, text_of(F.col(ids_col)))


def round_trip(
    docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """:func:`encode` with the decoded text beside the ids, in one pass."""
    return encode(docs, model_path, id_col, text_col, with_text=True)
