"""Token alignment against a search over byte ranges, text by text."""

import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tests.llm.conftest import LONG, ROWS, SF
from varve.llm import token_groups
from varve.llm.common import table
from varve.llm.queries import QUERIES

A, B = (public_tokenizers.path(n) for n in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
HARD = [
    (100, " leading and  double\n spaces \t end "),
    (101, "a▁b has the mark itself"),
    (102, "<s> </s> <unk> <0x41> <|endoftext|>"),
    (103, "日本語 テキスト 😀😀 ​zero　wide naïve é ﬁ"),
    (104, "x" * 5000),
    (105, "\x00 \x1f\x85 it's they'll 'S 12345 1.5e-7 !!!??"),
    (106, " "),
    (107, "\n\n"),
    (108, "the the the the"),
    (109, "tab\tand\r\nlines\n\nhere"),
]


def spelled(text):
    """(ids, ends) of both sides, or None where the bytes differ."""
    a = Tokenizer.from_file(A) if not hasattr(spelled, "a") else spelled.a
    b = sentencepiece.SentencePieceProcessor(model_file=B) if not hasattr(spelled, "b") else spelled.b
    spelled.a, spelled.b = a, b
    a.encode_special_tokens = True
    letters = {c: i for i, c in _letters()}
    names = a.encode(" " + text, add_special_tokens=False)
    left = [(i, bytes(letters[c] for c in t)) for i, t in zip(names.ids, names.tokens, strict=True)]
    right = []
    for i in b.encode(text):
        piece = b.id_to_piece(i)
        right.append((i, bytes([int(piece[3:5], 16)]) if b.is_byte(i) else piece.replace("▁", " ").encode()))
    wanted = (" " + text).encode()
    if any(b"".join(s for _, s in side) != wanted for side in (left, right)):
        return None
    return [[(i, e - len(s), e) for (i, s), e in zip(side, np.cumsum([len(s) for _, s in side]).tolist(), strict=True)] for side in (left, right)]


def _letters():
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
    hidden = [b for b in range(256) if b not in shown]
    return [(b, chr(b)) for b in shown] + [(b, chr(256 + k)) for k, b in enumerate(hidden)]


def by_hand(rows):
    texts, counts = [], Counter()
    for i, text in rows:
        sides = spelled(text) if text else None
        links = []
        if sides:
            k = 0
            for b, start, end in sides[1]:
                while sides[0][k][2] <= start:
                    k += 1
                at = k
                while at < len(sides[0]) and sides[0][at][1] < end:
                    links.append((sides[0][at][0], b))
                    at += 1
        counts.update(links)
        texts.append((i, sides, links))
    highest = {}
    for (_, b), n in counts.items():
        highest[b] = max(n, highest.get(b, 0))
    out = []
    for i, sides, links in texts:
        if not sides:
            out.append((i, 0, 0, 0, 0, 0, 0, ""))
            continue
        shared = {e for *_, e in sides[0]} & {e for *_, e in sides[1]}
        parts, low = [], 0
        for high in sorted(shared):
            parts.append("|".join(",".join(str(t) for t, s, e in side if low <= s and e <= high) for side in sides) if len(sides[0]) < 3000 else None)
            low = high
        groups = ";".join(parts) if None not in parts else None
        n_best = sum(counts[x] == highest[x[1]] for x in links)
        out.append((i, len(sides[0]), len(sides[1]), len(parts), len(links), n_best, sum(counts[x] for x in links), groups))
    return out


def key(rows):
    return sorted(rows, key=lambda r: repr(tuple(r)[:7]))


def compare(got, wanted, digest):
    got, wanted = key(got), key(wanted)
    assert [tuple(r)[:7] for r in got] == [w[:7] for w in wanted]
    for r, w in zip(got, wanted, strict=True):
        if w[7] is not None:
            assert r[7] == (hashlib.sha256(w[7].encode()).hexdigest() if digest and w[7] else w[7])


@pytest.mark.parametrize("digest", [False, True])
def test_hard_rows(spark, docs, digest):
    more = spark.createDataFrame(HARD, "doc_id long, text string")
    given = docs.select("doc_id", "text", "n", "node").unionByName(more, allowMissingColumns=True)
    got = token_groups.align_tokens(given, A, B, digest=digest)
    assert got.columns[-1] == ("groups_sha256" if digest else "groups")
    compare(got.collect(), by_hand([*ROWS, *HARD]), digest)


def test_no_rows(no_docs):
    assert token_groups.align_tokens(no_docs, A, B).collect() == []


def test_small_portions_and_a_small_memory_change_nothing(spark, docs):
    wanted = by_hand([r for r in ROWS if r[1] != LONG])
    aligner = token_groups.Aligner(open(A, "rb").read(), open(B, "rb").read())
    texts = [t or "" for _, t in ROWS if t != LONG]
    whole = aligner.portion(texts)
    assert whole["groups"] == [w[7] if w[7] is not None else g for w, g in zip(wanted, whole["groups"], strict=True)]
    aligner.forget()
    for k, text in enumerate(texts):
        alone = aligner.portion([text])
        assert alone["groups"] == whole["groups"][k : k + 1]
        assert alone["counts"].sum() == alone["n_links"].sum() == whole["n_links"][k]


def test_pointers_reach_the_end_of_each_component():
    rng = np.random.default_rng(2)
    for _ in range(300):
        size = int(rng.integers(1, 60))
        ends = [np.append(np.flatnonzero(rng.random(size - 1) < p) + 1, size) for p in rng.random(2)]
        shared = np.intersect1d(*ends)
        root = token_groups.terminals(*ends)
        last = ends[1][root - len(ends[0])]
        assert (last == shared[np.searchsorted(shared, np.concatenate(ends))]).all()


def test_units_are_where_both_tokenizers_cut():
    rng = np.random.default_rng(4)
    letters = list("ab'sé1.,\n\t日 ") + ["  ", " the", "　", "’", "\u180e", "\x1c", "▁", "\x00"]
    sides = token_groups.Aligner(open(A, "rb").read(), open(B, "rb").read()).sides
    plain = 0
    for _ in range(2000):
        text = "".join(letters[k] for k in rng.integers(0, len(letters), int(rng.integers(1, 30))))
        if token_groups.is_plain(text):
            plain += 1
            for side in sides:
                flat, sizes = side.encode_units(text.split(" "))
                assert flat.tolist() == side.encode([text])[0]
                each, many = side.encode_each(text.split(" "))
                assert (flat.tolist(), sizes.tolist()) == (each.tolist(), many.tolist())
    assert 150 < plain < 1900


def test_packed_numbers_come_back():
    for numbers in ([], [0], [5, 1 << 31, 255, 256], range(1000)):
        assert token_groups.unpacked(token_groups.packed(np.array(numbers, np.int64))).tolist() == list(numbers)


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    df = QUERIES["op13_token_alignment"](spark, SF)
    assert df.columns == ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    assert [t for _, t in df.dtypes] == ["bigint"] * 7 + ["string"]
    compare(df.collect(), by_hand(rows), True)
