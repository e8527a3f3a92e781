"""Token counts of a byte-pair encoder from a finite-state transducer.

A state of the transducer holds, for every place in the current word where a token may have ended,
the last token up to there, the spelling since then, and the tokens spent up to there, counted
from the cheapest place. Reading a symbol leads to one next state and emits the tokens that no
later symbol can take back. States and transitions are compiled when they are first met; two
prefixes that allow the same future share a state.

Every text is cut into chunks of equal length, wherever words begin or end. A chunk is a map from
the states in which it can be entered to the state in which it is left and the tokens emitted.
All chunks of a portion are read at once, a symbol at a time: first from the start state, then from
each state in which the chunk before can be left, until no map misses an entry. A run ends as soon
as it meets the run from the start state. The maps of a text are composed by a parallel prefix scan
that doubles the stretch in each round, and its count is the composed map's at the start state.
"""

from __future__ import annotations

import json
import re
import sys
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.bpe_paths import Pairs
from varve.llm.common import broadcast_file, portions_of, ship_package

MOVE_LIMIT = 500_000
CHUNK = 64
BATCH_BYTES = 1_000_000
SYMBOLS = 512  # every byte, and every byte as the last one of a word
HASH = np.uint64(0x9E3779B97F4A7C15)
OVER = 2048
END = "</w>"
# The white space of Unicode, as the inside of a character class.
WHITE_SPACE = r"\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: itself if printable, else the next from U+0100 on."""
    printable = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in printable}
    for byte in range(256):
        letters.setdefault(byte, chr(0x100 + byte - sum(b < byte for b in printable)))
    return [letters[b] for b in range(256)]


def ranges_of(category: str) -> str:
    """The code points of a general category, as the inside of a character class."""
    inside = [unicodedata.category(chr(c))[0] == category for c in range(sys.maxunicode + 1)]
    edges = [c for c in range(1, len(inside)) if inside[c] != inside[c - 1]]
    edges = ([0] if inside[0] else []) + edges + ([len(inside)] if inside[-1] else [])
    pairs = zip(edges[::2], edges[1::2], strict=True)
    return "".join(f"\\U{low:08x}-\\U{high - 1:08x}" for low, high in pairs)


class Transducer:
    """Counts tokens of words under the merges of a byte-pair vocabulary with word ends."""

    def __init__(self, vocabulary: set[str], merges: dict[tuple[str, str], int]):
        self.vocabulary = vocabulary
        letters = byte_letters()
        self.letters = letters + [letter + END for letter in letters]
        self.pairs = Pairs(lambda a, b: merges.get((a, b)), self._spell)
        self.prefixes = {t[:i] for t in vocabulary for i in range(1, len(t) + 1)}
        self.reset()

    @staticmethod
    def _spell(token: str) -> list[str]:
        if token.endswith(END) and token != END:
            body = token[: -len(END)]
            return [*body[:-1], body[-1] + END]
        return list(token)

    def reset(self) -> None:
        # A state is a tuple of (last token, spelling since, tokens spent beyond the cheapest).
        self.states: list[tuple] = [((None, "", 0),)]
        self.numbers: dict[tuple, int] = {self.states[0]: 0}
        self.moves = 0
        self._room(16)

    def _room(self, bits: int) -> None:
        """An empty table of moves: keys (state and symbol), and each one's next state and tokens."""
        self.shift = np.uint64(64 - bits)
        self.keys = np.full(1 << bits, -1, np.int64)
        self.next = np.zeros(1 << bits, np.int32)
        self.emits = np.zeros(1 << bits, np.int32)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        """Each key's place in the table, or the free place where it belongs."""
        slots = ((keys.astype(np.uint64) * HASH) >> self.shift).astype(np.int64)
        there = self.keys[slots]
        astray = np.flatnonzero((there != keys) & (there >= 0))
        while len(astray):
            slots[astray] = moved = (slots[astray] + 1) & (len(self.keys) - 1)
            there = self.keys[moved]
            astray = astray[(there != keys[astray]) & (there >= 0)]
        return slots

    def _put(self, keys, following, emitted) -> None:
        """Enters new keys, one at a time where two want the same place."""
        while len(keys):
            slots = self._slots(keys)
            _, first = np.unique(slots, return_index=True)
            at = slots[first]
            self.keys[at], self.next[at], self.emits[at] = keys[first], following[first], emitted[first]
            rest = np.ones(len(keys), bool)
            rest[first] = False
            keys, following, emitted = keys[rest], following[rest], emitted[rest]

    def step(self, states: np.ndarray, symbols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Next states and tokens emitted; moves met for the first time are compiled."""
        keys = states.astype(np.int64) * SYMBOLS + symbols
        slots = self._slots(keys)
        unknown = np.unique(keys[self.keys[slots] < 0])
        if len(unknown):
            made = [self._compile(k // SYMBOLS, self.letters[k % SYMBOLS]) for k in unknown.tolist()]
            self.moves += len(made)
            if 3 * self.moves > len(self.keys):
                old = np.flatnonzero(self.keys >= 0)
                kept = self.keys[old], self.next[old], self.emits[old]
                self._room(int(6 * self.moves).bit_length())
                self._put(*kept)
            self._put(unknown, *np.array(made, np.int32).T)
            slots = self._slots(keys)
        return self.next[slots], self.emits[slots]

    def _compile(self, state: int, symbol: str) -> tuple[int, int]:
        ended, open_ = None, []
        for last, spelt, spent in self.states[state]:
            text = spelt + symbol
            if text in self.vocabulary and ended is None and self._may_follow(last, text):
                ended = (text, spent + 1)
            if text in self.prefixes and not symbol.endswith(END):
                open_.append((last, text, spent))
        if symbol.endswith(END):
            return 0, ended[1]
        if ended:
            open_.append((ended[0], "", ended[1]))
        least = min(spent for _, _, spent in open_)
        new = tuple((last, text, spent - least) for last, text, spent in open_)
        number = self.numbers.get(new)
        if number is None:
            number = self.numbers[new] = len(self.states)
            self.states.append(new)
        return number, least

    def _may_follow(self, last: str | None, token: str) -> bool:
        return self.pairs.fit(token) if last is None else self.pairs.fit(last, token)


class ChunkMaps:
    """The maps of all chunks of some texts, given as symbols laid end to end.

    A lane is one entry of a chunk's map: a chunk, a state in which it can be entered, the state in
    which it is left, and the tokens emitted on the way.
    """

    def __init__(self, transducer: Transducer, symbols: np.ndarray, sizes: np.ndarray, length: int = CHUNK):
        self.transducer, self.symbols = transducer, symbols
        many = -(-sizes // length)
        self.first = np.cumsum(many) - many  # each text's first chunk, if it has one
        self.texts = np.flatnonzero(many)
        text = np.repeat(np.arange(len(sizes)), many)
        within = np.arange(len(text)) - self.first[text]
        self.starts = (np.cumsum(sizes) - sizes)[text] + within * length
        self.sizes = np.minimum(length, sizes[text] - within * length)
        self.ends_text = within == many[text] - 1
        self.lanes = [self._from_start()]
        self._close()

    def _from_start(self):
        """The lanes from the start state, with every state and count on their way."""
        n, longest = len(self.starts), int(self.sizes.max(initial=0))
        self.state = np.zeros((longest + 1, n), np.int32)
        self.spent = np.zeros((longest + 1, n), np.int32)
        for t in range(longest):
            # Chunks that have ended keep their last state and count.
            self.state[t + 1], self.spent[t + 1] = self.state[t], self.spent[t]
            on = np.flatnonzero(self.sizes > t)
            state, emitted = self.transducer.step(self.state[t, on], self.symbols[self.starts[on] + t])
            self.state[t + 1, on] = state
            self.spent[t + 1, on] += emitted
        return np.arange(n), np.zeros(n, np.int64), self.state[-1].astype(np.int64), self.spent[-1].astype(np.int64)

    def _from(self, chunk, entry):
        """The lanes of chunks entered in other states, each run until it meets the lane above."""
        state, spent = entry.astype(np.int32), np.zeros(len(entry), np.int64)
        on, t = np.arange(len(entry)), 0
        while len(on):
            at = chunk[on]
            met = state[on] == self.state[t, at]
            done = on[met]
            state[done] = self.state[-1, chunk[done]]
            spent[done] += self.spent[-1, chunk[done]] - self.spent[t, chunk[done]]
            on = on[~met & (self.sizes[at] > t)]
            state[on], emitted = self.transducer.step(state[on], self.symbols[self.starts[chunk[on]] + t])
            spent[on] += emitted
            t += 1
        return chunk, entry, state.astype(np.int64), spent

    def _close(self):
        """Adds lanes until every state in which a chunk can be left is an entry of the next."""
        known = np.zeros(0, np.int64)
        while True:
            chunk, _, left, _ = self.lanes[-1]
            on = ~self.ends_text[chunk] & (left > 0)  # the start state is an entry of every chunk
            wanted = np.setdiff1d(self._key(chunk[on] + 1, left[on]), known, assume_unique=False)
            if not len(wanted):
                return
            known = np.union1d(known, wanted)
            self.lanes.append(self._from(wanted >> 32, wanted & 0xFFFFFFFF))

    @staticmethod
    def _key(chunk, state):
        return (chunk << 32) | state

    def composed(self) -> np.ndarray:
        """The tokens of every text: its chunks' maps composed by a scan that doubles its stretch."""
        chunk, entry, left, spent = (np.concatenate(part) for part in zip(*self.lanes, strict=True))
        order = np.argsort(self._key(chunk, entry))
        chunk, entry, left, spent = chunk[order], entry[order], left[order], spent[order]
        keys = self._key(chunk, entry)
        last = self.ends_text[chunk]
        follows = np.searchsorted(keys, self._key(chunk + 1, left))
        follows = np.r_[np.where(last, len(keys), follows), len(keys)]
        spent = np.r_[spent, 0]
        while (follows < len(keys)).any():
            spent = spent + spent[follows]
            follows = follows[follows]
        totals = np.zeros(len(self.first), np.int64)
        totals[self.texts] = spent[np.searchsorted(keys, self._key(self.first[self.texts], 0))]
        return totals


class Counter:
    """Cuts texts into words as the vocabulary file says and counts them by the transducer."""

    def __init__(self, data: bytes):
        spec = json.loads(data)
        model = spec["model"]
        merges = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
        self.transducer = Transducer(
            set(model["vocab"]), {(a, b): i for i, (a, b) in enumerate(merges)}
        )
        split = spec["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        split = split.replace(r"\s", WHITE_SPACE)
        for name, first in ((r"\p{L}", "L"), (r"\p{N}", "N")):
            split = split.replace(f"[{name}]", f"[{ranges_of(first)}]").replace(name, ranges_of(first))
        self.word = re.compile(split)
        added = sorted((t["content"] for t in spec["added_tokens"]), key=len, reverse=True)
        self.added = re.compile("|".join(map(re.escape, added)))

    def words(self, raw: str) -> tuple[bytes, int]:
        """A text's words, a line each, and how many added tokens stand between them."""
        parts = self.added.split(raw)
        words = []
        for part in parts:
            if not part.isascii():
                # A capital sigma lowers to the same letter wherever it stands.
                part = unicodedata.normalize("NFC", part).replace("Σ", "σ")
            words += self.word.findall(part.lower())
        return "\n".join(words).encode(), len(parts) - 1

    def counts(self, texts: list[str]) -> np.ndarray:
        """Tokens of every text; long ones are cut at spaces, which only part words."""
        cut = [_segments(text) for text in texts]
        owner = np.repeat(np.arange(len(texts)), [len(c) for c in cut])
        totals = np.zeros(len(texts), np.int64)
        part: list[bytes] = []
        begun = held = 0
        for k, raw in enumerate(raw for segments in cut for raw in segments):
            lines, added = self.words(raw)
            totals[owner[k]] += added
            part.append(lines)
            held += len(lines)
            if held >= BATCH_BYTES or k == len(owner) - 1:
                np.add.at(totals, owner[begun : k + 1], self._composed(part))
                part, begun, held = [], k + 1, 0
        return totals

    def _composed(self, part: list[bytes]) -> np.ndarray:
        """Tokens of every list of words, a line each."""
        if self.transducer.moves > MOVE_LIMIT:
            self.transducer.reset()
        data = np.frombuffer(b"\n".join([*part, b""]), np.uint8)
        line_end = data == ord("\n")
        inside = np.flatnonzero(~line_end)
        symbols = data[inside].astype(np.int64) + 256 * line_end[np.minimum(inside + 1, len(data) - 1)]
        ends = np.searchsorted(inside, np.cumsum([len(lines) + 1 for lines in part]))
        return ChunkMaps(self.transducer, symbols, np.diff(ends, prepend=0)).composed()


def _segments(text: str) -> list[str]:
    """The text, cut at spaces into pieces of about ``BATCH_BYTES`` characters if it is longer."""
    found, at = [], 0
    while len(text) - at > BATCH_BYTES:
        space = text.find(" ", at + BATCH_BYTES)
        if space < 0:
            break
        found.append(text[at:space])
        at = space
    return [*found, text[at:]]


_counter: dict[int, Counter] = {}


def _counter_for(data: bytes) -> Counter:
    """One compiled counter per worker process."""
    key = hash(data)
    if key not in _counter:
        _counter.clear()
        _counter[key] = Counter(data)
    return _counter[key]


def count_tokens(
    docs: DataFrame,
    vocabulary_path: str,
    id_col: str = "doc_id",
    text_col: str = "text",
    over: int = OVER,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_bytes``, ``n_tokens``, ``over_limit``.

    ``vocabulary_path`` names a byte-pair vocabulary with word ends (JSON), read once by the
    driver and broadcast. No begin, end or other tokens are added; special strings inside a text
    count as one token each. A NULL text counts as empty, and an empty one has no tokens. A very
    long text is one value but is read in pieces; the table of moves is bounded. An empty table gives no rows.
    """
    ship_package(docs.sparkSession)
    data = broadcast_file(docs.sparkSession, vocabulary_path)
    id_type = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = _counter_for(data.value)
        for batch in batches:
            portions = [counter.counts(texts) for texts in portions_of(batch.column(1), BATCH_BYTES)]
            counts = np.concatenate([np.zeros(0, np.int64), *portions])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(2), pa.array(counts), pa.array(counts > over)],
                names=["id", "n_bytes", "n_tokens", "over_limit"],
            )

    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = docs.select(
        F.col(id_col).alias("id"), text.alias("text"), F.octet_length(text).cast("long").alias("n_bytes")
    )
    schema = f"id {id_type}, n_bytes long, n_tokens long, over_limit boolean"
    return rows.mapInArrow(run, schema).withColumnRenamed("id", id_col)
