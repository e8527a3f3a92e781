"""Personal data: base spans against the plain patterns, the trees against examples they never saw."""

import hashlib
import random
import re
import time

import numpy as np
import pytest

from tests.llm.conftest import ROWS, SF
from varve.llm import pii_trees
from varve.llm.common import table
from varve.llm.queries import QUERIES

# The contract's patterns, as text.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
CARD, OTHER = "4465758382889437", "4532015112830366"
HARD = [
    (100, f"pay {CARD} {CARD} now"),
    (101, f"x {CARD[:4]}-{CARD[4:8]} {CARD[8:12]}-{CARD[12:]} y, {int(CARD) + 1}"),
    (102, "a@b@c.org, .%+-@x-.y..z q@q @q.q é@é.de a.b@c.d.e.f@g.h"),
    (103, "1.2.3.4.5.6.7.8.9 256.1.1.1 00000255.1.1.1 1.2.3 0.0.0.0"),
    (104, f"+1 (269) 555-3296 {OTHER} and +1 2 3, +12345678, ++49 30 1234567 (+49)"),
    (105, "écrire à jean (at) exemple [dot] fr ou jean at exemple dot fr"),
    (106, "call (771) 555-1655 or 771-555-1655"),
    (107, "born 2024-11-06, 12.05.2021, pages 1914-1918, pi 3.14159265358979, v1.2.3"),
    (108, "😀😀 " + CARD + " 日本 1.1.1.1"),
    (109, "2001:db8::ff00:42:8329 at 12:30:45"),
]


def luhn(digits):
    double = [sum(divmod(2 * int(c), 10)) for c in digits[-2::-2]]
    return (sum(double) + sum(map(int, digits[::-2]))) % 10 == 0


def base_by_hand(text):
    found = []
    for kind, pattern in PLAIN.items():
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            good = {
                "email": lambda m=m: True,
                "ip": lambda m=m: all(int(p) <= 255 for p in m[0].split(".")),
                "card": lambda d=digits: 16 <= len(d) <= 19 and luhn(d),
                "phone": lambda d=digits: 8 <= len(d) <= 15,
            }[kind]()
            if good:
                found.append((kind, *m.span()))
    return found


def written(spans):
    return ",".join(":".join(map(str, s)) for s in spans)


def row_by_hand(i, text):
    spans = base_by_hand(text or "")
    kinds = [s[0] for s in spans]
    return (i, *(kinds.count(k) for k in PLAIN), hashlib.sha256(written(spans).encode()).hexdigest())


def key(rows):
    return sorted(rows, key=repr)


def test_base_spans_agree_with_the_plain_patterns():
    rng = random.Random(1)
    bits = ["1", "23", "255", "256", ".", ".", "-", " ", "+", "(", ")", "@", "a", "b.c", "é", CARD, "@x.y", "  ", "+1 2", "0"]
    for _ in range(20_000):
        text = "".join(rng.choices(bits, k=rng.randint(1, 14)))
        got = [(pii_trees.KINDS[s.kind], s.start, s.end) for s in pii_trees.base_spans(text)]
        assert got == base_by_hand(text), text


def test_hard_rows(spark, docs):
    more = spark.createDataFrame(HARD, "doc_id long, text string")
    given = docs.select("doc_id", "text", "n", "score").unionByName(more, allowMissingColumns=True)
    found = pii_trees.find_pii(given)
    got = pii_trees.span_digests(found).collect()
    assert key(tuple(r)[:6] for r in got) == key(row_by_hand(i, t) for i, t in [*ROWS, *HARD])
    texts = dict(HARD)
    spans = {}
    for r in found.where("doc_id >= 100").collect():
        listed = [(s["kind"], s["start"], s["end"]) for s in r["spans"]]
        order = [(list(PLAIN).index(k), s, e) for k, s, e in listed]
        assert order == sorted(order) and len(set(listed)) == len(listed)
        assert [x for x, s in zip(listed, r["spans"], strict=True) if s["base"]] == base_by_hand(texts[r["doc_id"]])
        assert all(0 <= s["score"] <= 1 for s in r["spans"])
        spans[r["doc_id"]] = [(k, texts[r["doc_id"]][s:e]) for k, s, e in listed]
    # The base pattern takes neighbours together and drops them; the trees find each.
    assert spans[100] == [("card", CARD), ("card", CARD)]
    assert ("card", OTHER) in spans[104] and ("phone", "+1 (269) 555-3296") in spans[104]
    assert spans[105] == [("email", "jean (at) exemple [dot] fr"), ("email", "jean at exemple dot fr")]
    assert spans[106] == [("phone", "(771) 555-1655"), ("phone", "771-555-1655")]
    assert spans[107] == []
    assert spans[109] == [("ip", "2001:db8::ff00:42:8329")]


def test_redaction(spark):
    df = spark.createDataFrame([(1, f"a {CARD} {CARD}, x@y.org\n1.2.3.4"), (2, None), (3, "none")], "doc_id long, text string")
    got = dict(map(tuple, pii_trees.redact(df).collect()))
    assert got == {1: "a [CARD] [CARD], [EMAIL]\n[IP]", 2: "", 3: "none"}


def test_no_rows(no_docs):
    assert pii_trees.span_digests(pii_trees.find_pii(no_docs)).collect() == []


@pytest.mark.parametrize("kind", range(4))
def test_unseen_examples(kind):
    judge = pii_trees.train()
    x, y = pii_trees.made_up(2000, seed=99)
    own = x[:, kind] > 0
    chosen = judge.trees.probability(x[own]) >= judge.thresholds[kind]
    right = y[own] > 0
    assert right.sum() > 100
    assert (chosen & right).sum() >= 0.95 * right.sum()
    assert (chosen & right).sum() >= 0.95 * chosen.sum()


def test_probabilities_are_calibrated():
    judge = pii_trees.train()
    x, y = pii_trees.made_up(2000, seed=98)
    p = judge.trees.probability(x)
    assert abs(p.mean() - y.mean()) < 0.02
    assert np.mean((p - y) ** 2) < 0.02


@pytest.mark.parametrize(
    "text",
    ["1" * 300_000, "1." * 100_000, "@" * 200_000, "a" * 300_000 + "@", "+1 " * 60_000, "a@b " * 50_000, "( at )" * 30_000],
)
def test_long_texts_take_time_in_proportion(text):
    start = time.process_time()
    assert len(list(pii_trees.judged_spans(pii_trees.train(), [text]))) == 1
    assert time.process_time() - start < 40


def test_query(spark):
    rows = [(r["doc_id"], r["text"]) for r in table(spark, SF, "documents").collect()]
    df = QUERIES["op12_personal_data"](spark, SF)
    assert df.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    assert [t for _, t in df.dtypes] == ["bigint"] * 5 + ["string"] * 2
    got = df.collect()
    assert key(tuple(r)[:6] for r in got) == key(row_by_hand(i, t) for i, t in rows)
    texts = dict(rows)
    for r in got:
        spans = r["spans"].split(",") if r["spans"] else []
        assert set(written(base_by_hand(texts[r["doc_id"]] or "")).split(",")) - {""} <= set(spans)
        assert spans or not re.search("[0-9]{7}", texts[r["doc_id"]] or "")
