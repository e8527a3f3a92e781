"""Personal data by candidate generators and gradient-boosted trees.

Four exact patterns give the base spans, which always stay. Loose generators propose overlapping
spans beyond them: windows of neighbouring digit groups, written-out and non-ASCII addresses,
masked and version 6 network addresses. Boosted trees judge every candidate by its format (digits,
groups, separators, checksums) and its context (neighbouring characters, cue words before it). The
scores are calibrated on examples the trees have not seen, and every kind has the lowest threshold
that keeps the wanted precision there. Of overlapping candidates the surest stays.

There are no labelled spans in a corpus, so the trees learn from made-up examples of both sorts in
texts of random words, see :func:`made_up`; their number is a parameter.
"""

from __future__ import annotations

import random
import re
from bisect import bisect_left, insort
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import cache
from itertools import islice
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from varve.llm.common import portions_of, ship_package

KINDS = ("email", "ip", "card", "phone")
EXAMPLES = 4000  # made-up texts to learn from
PRECISION = 0.98
BATCH_BYTES = 2_000_000
CANDIDATES_AT_ONCE = 20_000
MOST_GROUPS = 8  # digit groups of a number as people write it


class Span(NamedTuple):
    kind: int
    start: int
    end: int


# ---- base spans

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
# A match never starts within a run of digits, nor is anything given back: each text is read once.
ADDRESS = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++)(?:\.[0-9]++)(?:\.[0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?+[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
NO_DIGIT = re.compile(r"[^0-9]+")


def luhn(digits: str) -> bool:
    """Whether the digits pass the checksum of card numbers."""
    total = 0
    for k, c in enumerate(reversed(digits)):
        value = int(c) << (k & 1)
        total += value - 9 * (value > 9)
    return total % 10 == 0


def _parts_fit(address: str) -> bool:
    parts = (p.lstrip("0") for p in address.split("."))
    return all(len(p) <= 3 and int(p or 0) <= 255 for p in parts)


def base_spans(text: str) -> list[Span]:
    """The spans of the four patterns that pass their tests, by kind and start."""
    spans = []
    low, at = 0, text.find("@")
    while at >= 0:
        left = text[low:at]
        local = len(left) - len(left.rstrip(LOCAL))
        found = DOMAIN.match(text, at + 1) if local else None
        if found:
            spans.append(Span(0, at - local, found.end()))
        low = found.end() if found else at + 1
        at = text.find("@", low)
    spans += [Span(1, *m.span()) for m in ADDRESS.finditer(text) if _parts_fit(m[0])]
    for m in CARD.finditer(text):
        digits = NO_DIGIT.sub("", m[0])
        if 16 <= len(digits) <= 19 and luhn(digits):
            spans.append(Span(2, *m.span()))
    for m in PHONE.finditer(text) if "+" in text else ():
        if 8 <= len(NO_DIGIT.sub("", m[0])) <= 15:
            spans.append(Span(3, *m.span()))
    return spans


# ---- candidates

NUMBERS = re.compile(r"[0-9]++(?:[\x20().\-/\xa0]{1,3}+[0-9]++)*+")
DIGITS = re.compile(r"[0-9]+")
AT = re.compile(r"[\[({<]\x20?(?:at|@)\x20?[\])}>]|\x20at\x20|@", re.I)
LEFT = re.compile(r"[\w.%+-]+\Z")
DOT = r"(?:\x20?[\[({<]\x20?(?:dot|\.)\x20?[\])}>]\x20?|\x20dot\x20|\.)"
RIGHT = re.compile(rf"[\w-]{{1,63}}(?:{DOT}[\w-]{{1,63}}){{1,5}}", re.I)
MASKED = re.compile(r"(?<![0-9.])[0-9]{1,3}(?:(?:\[\.\]|\(\.\)|\x20?\[dot\]\x20?|\x20dot\x20)[0-9]{1,3}){3}(?![0-9])", re.I)
SIXTH = re.compile(r"(?<![0-9A-Za-z:.])(?:[0-9A-Fa-f]{0,4}:){2,7}[0-9A-Fa-f]{0,4}(?![0-9A-Za-z:])")
# Texts without any of these have neither base spans nor candidates.
ANY = r"[0-9@]|(?i:[\[({<] ?at ?[\])}>])|(?i: dot )|::"


def candidates(text: str) -> set[Span]:
    """Overlapping spans that could be personal data, with few missed and many wrong."""
    found = set()
    lower = text.lower()
    bracketed, dotted = any(c in text for c in "[({<"), " dot " in lower
    for m in AT.finditer(text) if bracketed or dotted or "@" in text else ():
        start, end = m.span()
        if m[0][0] in "[({<":  # a space on either side belongs to the mark
            start, end = start - (text[max(0, start - 1)] == " "), end + text.startswith(" ", end)
        right = RIGHT.match(text, end)
        left = LEFT.search(text, max(0, start - 64), start) if right else None
        if left and (m[0].lower() != " at " or " dot " in right[0].lower()):
            found.add(Span(0, left.start(), right.end()))
    if bracketed or dotted:
        found.update(Span(1, *m.span()) for m in MASKED.finditer(text))
    if text.count(":") > 1:
        found.update(Span(1, *m.span()) for m in SIXTH.finditer(text))
    found.update(Span(1, *m.span()) for m in ADDRESS.finditer(text))
    for m in NUMBERS.finditer(text):
        groups = [g.span() for g in DIGITS.finditer(text, *m.span())]
        for i, (start, _) in enumerate(groups):
            opened = start
            while opened > 0 and text[opened - 1] in "+(":
                opened -= 1
            digits = 0
            for first, end in groups[i : i + MOST_GROUPS]:
                digits += end - first
                if digits > 19:
                    break
                if digits >= 13:
                    found.add(Span(2, start, end))
                if 7 <= digits <= 15:
                    found.add(Span(3, opened, end))
    return found


# Cue words by kind, then words that speak against all kinds.
CUES = (
    "email e-mail mail write contact correo courriel kontakt schreib address",
    "ip address host server login addr dirección adresse from gateway client",
    "card visa mastercard amex credit debit karte tarjeta carte payment pay",
    "phone tel telephone call mobile fax whatsapp contact teléfono téléphone telefon ruf llame cell",
    "version v release order invoice isbn issn doi ref id sku model serial tracking section chapter "
    "pages page year years date between total price sum number no firmware build timestamp",
)
CUE_SETS = tuple(frozenset(words.split()) for words in CUES)
WORD = re.compile(r"[^\W\d_]+(?:-[^\W\d_]+)?")
DATE = re.compile(r"\(?[0-9]{1,4}([.\-/])[0-9]{1,2}\1[0-9]{1,4}\Z|[12][0-9]{3}\x20?[\-/]\x20?[12][0-9]{3}\Z")
NORTH = re.compile(r"(?:1[\-. ])?\(?[2-9][0-9]{2}\)?[\-. ]{1,2}[2-9][0-9]{2}[\-. ][0-9]{4}\Z")
ISSUER = re.compile(r"4|5[1-5]|2[2-7]|3[47]|35|6011|65")
ENDINGS = frozenset("com org net edu gov io info de fr es uk it eu us ch at".split())


def features(text: str, span: Span) -> list[float]:
    """Numbers about a candidate's form and its surroundings."""
    kind, start, end = span
    inner = text[start:end]
    groups = DIGITS.findall(inner)
    digits = "".join(groups)
    sizes = [len(g) for g in groups] or [0]
    marks = NO_DIGIT.sub(" ", inner)
    separators = set(re.sub(r"[\w]+", "", inner))
    before, after = text[max(0, start - 48) : start], text[end : end + 16]
    words = [w.lower() for w in WORD.findall(before)][-4:]
    last = before[-1:] or " "
    follows = after[:1] or " "
    parts = [int(g) for g in groups if len(g) <= 3]
    ending = re.split(r"[^\w]+", inner)[-1].lower()
    return [
        *(float(kind == k) for k in range(4)),
        len(inner),
        len(digits),
        len(groups),
        max(sizes),
        min(sizes),
        len(set(digits)),
        len(separators),
        float(luhn(digits)) if digits else 0.0,
        float(bool(ISSUER.match(digits))),
        float(sizes in ([4, 4, 4, 4], [16], [4, 6, 5], [15])),
        float(inner[:1] == "+"),
        float("(" in inner),
        float(inner[:1] == "(" and ")" in inner),
        float(digits[:1] == "0"),
        float(digits[:2] == "00"),
        float(bool(DATE.match(inner))),
        float(bool(NORTH.match(inner))),
        float(sizes[-2:] == [3, 4]),
        float(inner.count(".")),
        float(inner.count(":")),
        float("::" in inner),
        float(sum(c in "abcdefABCDEF" for c in inner)),
        float(max(parts, default=0)),
        float(min(parts, default=0)),
        float(len(parts) == 4 and len(groups) == 4 and max(parts) <= 255),
        float(any(len(g) > 1 and g[0] == "0" for g in groups)),
        float("@" in inner),
        float(bool(re.search(r"[\[({<]", inner))),
        float(" dot " in inner.lower()),
        float(ending in ENDINGS),
        float(len(ending)),
        float(last.isalpha()),
        float(last.isdigit()),
        float(last in ".,:/-_#="),
        float(last in "$€£"),
        float(follows.isalpha()),
        float(follows.isdigit()),
        float(follows in "%°€$" or bool(re.match(r"[.\-/:_][0-9A-Za-z]", after))),
        float(bool(re.search(r"[0-9][\x20().\-/\xa0]{1,3}\Z", before))),
        float(bool(re.match(r"[\x20().\-/\xa0]{1,3}[0-9]", after))),
        *(float(sum(w in cues for w in words)) for cues in CUE_SETS),
        float(marks.count(" ")),
    ]


# ---- boosted trees


@dataclass
class Trees:
    """Boosted trees of a fixed depth for yes or no, with a calibrated probability."""

    depth: int = 4
    rounds: int = 70
    rate: float = 0.2
    bins: int = 24
    slope: float = 1.0
    shift: float = 0.0
    trees: list[tuple] = field(default_factory=list)

    def fit(self, x: np.ndarray, y: np.ndarray) -> Trees:
        edges = [np.unique(np.quantile(c, np.linspace(0, 1, self.bins + 1)[1:-1])) for c in x.T]
        binned = np.stack([np.searchsorted(e, c) for e, c in zip(edges, x.T, strict=True)], axis=1)
        n, many = binned.shape
        place = binned + np.arange(many) * self.bins
        margin = np.zeros(n)
        self.trees = []
        for _ in range(self.rounds):
            p = _logistic(margin)
            slope, curve = y - p, p * (1 - p)
            node = np.zeros(n, np.int64)
            columns, cuts = [], []
            for level in range(self.depth):
                cells = (1 << level) * many * self.bins
                flat = (node[:, None] * (many * self.bins) + place).ravel()
                g = np.bincount(flat, np.repeat(slope, many), cells).reshape(-1, many, self.bins)
                h = np.bincount(flat, np.repeat(curve, many), cells).reshape(-1, many, self.bins)
                left_g, left_h = g.cumsum(2)[:, :, :-1], h.cumsum(2)[:, :, :-1]
                all_g, all_h = g.sum(2, keepdims=True), h.sum(2, keepdims=True)
                gain = left_g**2 / (left_h + 1) + (all_g - left_g) ** 2 / (all_h - left_h + 1)
                gain = np.where((left_h > 0.5) & (all_h - left_h > 0.5), gain, -1.0)
                best = gain.reshape(len(g), -1).argmax(1)
                column, cut = best // (self.bins - 1), best % (self.bins - 1)
                values = [e[c] if c < len(e) else np.inf for e, c in zip([edges[k] for k in column], cut, strict=True)]
                columns.append(column)
                cuts.append(np.array(values))
                node = 2 * node + (x[np.arange(n), column[node]] > cuts[-1][node])
            leaves = 1 << self.depth
            total = np.bincount(node, slope, leaves) / (np.bincount(node, curve, leaves) + 1)
            self.trees.append((columns, cuts, self.rate * total))
            margin += self.trees[-1][2][node]
        return self

    def margins(self, x: np.ndarray) -> np.ndarray:
        total, rows = np.zeros(len(x)), np.arange(len(x))
        for columns, cuts, values in self.trees:
            node = np.zeros(len(x), np.int64)
            for column, cut in zip(columns, cuts, strict=True):
                node = 2 * node + (x[rows, column[node]] > cut[node])
            total += values[node]
        return total

    def calibrate(self, x: np.ndarray, y: np.ndarray) -> None:
        """Slope and shift of the logistic curve that fits unseen examples best (Newton's steps)."""
        m = self.margins(x)
        goal = np.where(y > 0, (y.sum() + 1) / (y.sum() + 2), 1 / (len(y) - y.sum() + 2))
        self.slope, self.shift = 1.0, 0.0
        for _ in range(30):
            p = _logistic(self.slope * m + self.shift)
            w = p * (1 - p) + 1e-9
            step = np.linalg.solve(
                np.array([[(w * m * m).sum() + 1e-6, (w * m).sum()], [(w * m).sum(), w.sum() + 1e-6]]),
                np.array([((goal - p) * m).sum(), (goal - p).sum()]),
            )
            self.slope, self.shift = self.slope + step[0], self.shift + step[1]

    def probability(self, x: np.ndarray) -> np.ndarray:
        return _logistic(self.slope * self.margins(x) + self.shift)


def _logistic(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -40, 40)))


# ---- made-up examples


def _number(rng: random.Random, size: int) -> str:
    return "".join(rng.choices("0123456789", k=size))


def _card(rng: random.Random, right: bool) -> str:
    prefix = rng.choice(["4", "51", "53", "55", "2221", "34", "37", "6011", "65", "35", "4", "4"])
    size = 15 if prefix in ("34", "37") else rng.choice([16, 16, 16, 19 if prefix == "4" else 16])
    body = prefix + _number(rng, size - len(prefix) - 1)
    last = next(c for c in "0123456789" if luhn(body + c))
    if not right:
        last = rng.choice([c for c in "0123456789" if c != last])
    digits = body + last
    mark = rng.choice(["", "", " ", "-", "."])
    cuts = [4, 10] if size == 15 else range(4, size, 4)
    return mark.join(digits[a:b] for a, b in zip([0, *cuts], [*cuts, size], strict=True))


def _name(rng: random.Random, letters: str = "abcdefghiklmnoprstuvz") -> str:
    return "".join(rng.choices(letters, k=rng.randint(3, 8)))


def _email(rng: random.Random) -> str:
    local, host, ending = _name(rng) + rng.choice(["", ".", "_"]) + _name(rng), _name(rng), rng.choice(["com", "org", "de", "net", "fr", "es"])
    form = rng.randrange(5)
    if form == 0:
        return f"{local}@{host}.{ending}"
    if form == 1:
        return f"{local} [at] {host} [dot] {ending}"
    if form == 2:
        return f"{local} (at) {host}.{ending}"
    if form == 3:
        return f"{local} at {host} dot {ending}"
    return f"{_name(rng, 'abcdeäöüéñßor')}é@{_name(rng, 'abcdeäöüéñor')}ü.{ending}"


def _address(rng: random.Random) -> str:
    form = rng.randrange(3)
    if form == 2:
        parts = [format(rng.getrandbits(16), "x") for _ in range(8)]
        if rng.random() < 0.5:
            first = rng.randint(1, 4)
            return ":".join(parts[:first]) + "::" + ":".join(parts[first + 2 : 6])
        return ":".join(parts)
    return rng.choice([".", "[.]", "(.)", ".", "[dot]"]).join(str(rng.randint(1, 255)) for _ in range(4))


def _phone(rng: random.Random) -> str:
    a, b, c = str(rng.randint(200, 999)), str(rng.randint(200, 999)), _number(rng, 4)
    return rng.choice(
        [
            f"({a}) {b}-{c}", f"{a}-{b}-{c}", f"{a}.{b}.{c}", f"1-{a}-{b}-{c}", f"+1 ({a}) {b}-{c}",
            f"0{rng.randint(20, 99)}/{_number(rng, 7)}", f"00{rng.randint(30, 49)} {a} {b}{c}", f"0{a} {b} {c}",
            f"+{rng.randint(30, 49)} {rng.randint(10, 99)} {_number(rng, 8)}",
        ]
    )


def _other(rng: random.Random) -> tuple[str, str]:
    """(cue, text) of something that is no personal data but looks a little like it."""
    d, m, y = rng.randint(1, 28), rng.randint(1, 12), rng.randint(1900, 2030)
    return rng.choice(
        [
            ("", f"{y}-{m:02}-{d:02}"), ("date", f"{d:02}.{m:02}.{y}"), ("", f"{m}/{d}/{y}"), ("between", f"{y}-{y + d}"),
            ("", f"{y}-{m:02}-{d:02} {d % 24:02}:{m:02}:{d:02}"), ("pages", f"{d * 7}-{d * 7 + m}"), ("", f"3.{_number(rng, 9)}"),
            ("version", ".".join(str(rng.randint(0, 9)) for _ in range(4))), ("section", f"{m}.{d % 9}.{d}.{m}.{d}"),
            ("total", f"{d} {_number(rng, 3)} {_number(rng, 3)}"), ("isbn", f"978-{m}-{_number(rng, 2)}-{_number(rng, 6)}-{d % 10}"),
            ("order", _number(rng, rng.randint(7, 19))), ("timestamp", f"16{_number(rng, 11)}"), ("", _number(rng, rng.randint(8, 30))),
            ("id", format(rng.getrandbits(128), "x")), ("card", _card(rng, False)), ("", _card(rng, False)), ("", f"{d}:{m:02}:{y % 60:02}"),
            ("ref", f"{_number(rng, 4)}-{_number(rng, 4)}"), ("price", f"${_number(rng, 4)}.{_number(rng, 2)}"), ("", f"{d}.{m}° {y}.{_number(rng, 4)}"),
            ("look", f"{_name(rng)} at {_name(rng)} dot"), ("", f"@{_name(rng)}"), ("", f"{_name(rng)}@{_name(rng)}"), ("met", f"{_name(rng)} at {_name(rng)}. {_name(rng)}"),
            ("host", f"{rng.randint(256, 999)}.{m}.{d}.{rng.randint(256, 999)}"), ("model", f"{_name(rng)[:2].upper()}{_number(rng, 10)}"),
            ("", " ".join(_number(rng, rng.randint(1, 4)) for _ in range(6))), ("serial", f"{_number(rng, 3)}.{_number(rng, 3)}.{_number(rng, 4)}"),
            ("", f"std::{_name(rng)}::{_name(rng)}"), ("no", f"{_number(rng, 5)}-{_number(rng, 4)}"), ("", "0" * rng.randint(7, 19)),
            ("", f"{_name(rng)}{_number(rng, 16)}"), ("build", f"{_number(rng, 16)}{_name(rng)}"),
        ]
    )


def made_up(n: int, seed: int = 11) -> tuple[np.ndarray, np.ndarray]:
    """(features, labels) of all candidates in ``n`` texts, half of them with one true span.

    A text is a few random words, a cue word or none, the span, and more words; card numbers are
    sometimes doubled, which the base pattern drops. A candidate is right if it has the true
    span's place and kind.
    """
    rng = random.Random(seed)
    makers = (_email, _address, lambda r: _card(r, True), _phone)
    rows, labels = [], []
    for k in range(n):
        kind = rng.randrange(4)
        true = k % 2 == 0
        if true:
            cue, made = rng.choice(CUES[kind].split()), makers[kind](rng)
            # A bare number may be anything without a cue or a checksum; other forms speak for themselves.
            cue = cue if rng.random() < 0.4 or (kind == 3 and not re.match(r"[+(]|[0-9]{3}-|1-", made)) else ""
        else:
            cue, made = _other(rng)
            if rng.random() < 0.3:
                cue = rng.choice(CUES[4].split())
        words = [_name(rng) for _ in range(rng.randint(2, 8))]
        left = " ".join(words + [cue] * bool(cue)) + rng.choice([" ", " ", ": ", "\n"])
        right = rng.choice([" ", ". ", ", ", "\n"]) + " ".join(_name(rng) for _ in range(4))
        twice = true and kind == 2 and rng.random() < 0.2
        text = left + made + (" " + made if twice else "") + right
        spots = {Span(kind, len(left), len(left) + len(made))} if true else set()
        if twice:
            spots.add(Span(kind, len(left) + len(made) + 1, len(left) + 2 * len(made) + 1))
        for span in sorted(candidates(text)):
            rows.append(features(text, span))
            labels.append(span in spots)
    return np.array(rows, float), np.array(labels, float)


@dataclass
class Judge:
    trees: Trees
    thresholds: list[float]


@cache
def train(examples: int = EXAMPLES, precision: float = PRECISION, seed: int = 11) -> Judge:
    """Trees from made-up examples; a quarter of these sets the curve and the thresholds only."""
    x, y = made_up(examples, seed)
    spared = np.arange(len(x)) % 4 == 0
    trees = Trees().fit(x[~spared], y[~spared])
    trees.calibrate(x[spared], y[spared])
    p = trees.probability(x[spared])
    thresholds = []
    for kind in range(len(KINDS)):
        own = x[spared][:, kind] > 0
        order = np.argsort(-p[own], kind="stable")
        sure, right = p[own][order], y[spared][own][order]
        good = np.cumsum(right) >= precision * np.arange(1, len(right) + 1)
        lowest = sure[np.flatnonzero(good)[-1]] if good.any() else 1.1
        thresholds.append(max(0.5, float(lowest)))
    return Judge(trees, thresholds)


# ---- texts


def judged_spans(judge: Judge, texts: list[str]) -> Iterator[list[tuple[Span, bool, float]]]:
    """For each text the (span, whether base, probability) that stay, by kind and start."""
    waiting, size = [], 0
    for text in texts:
        base = base_spans(text)
        waiting.append((text, base, sorted(candidates(text).difference(base))))
        size += len(base) + len(waiting[-1][2])
        if size >= CANDIDATES_AT_ONCE:
            yield from _chosen(judge, waiting)
            waiting, size = [], 0
    yield from _chosen(judge, waiting)


def _probabilities(judge: Judge, waiting) -> Iterator[float]:
    """One number per span; the features of a bounded number of spans are held at a time."""
    spans = ((text, span) for text, base, more in waiting for span in base + more)
    while rows := [features(*s) for s in islice(spans, CANDIDATES_AT_ONCE)]:
        yield from judge.trees.probability(np.array(rows, float)).tolist()


def _chosen(judge: Judge, waiting) -> Iterator[list[tuple[Span, bool, float]]]:
    sure = _probabilities(judge, waiting)
    for _, base, more in waiting:
        kept = [(s, True, next(sure)) for s in base]
        taken: list[tuple[int, int]] = []
        for s in base:
            _take(taken, s.start, s.end)
        rated = [(-next(sure), s.start - s.end, s) for s in more]
        for q, _, s in sorted(r for r in rated if -r[0] >= judge.thresholds[r[2].kind]):
            if _take(taken, s.start, s.end):
                kept.append((s, False, -q))
        yield sorted(kept)


def _take(taken: list[tuple[int, int]], start: int, end: int) -> bool:
    """Adds the range to the sorted ranges unless one of them overlaps it."""
    at = bisect_left(taken, (start, end))
    if at and taken[at - 1][1] > start or at < len(taken) and taken[at][0] < end:
        return False
    insort(taken, (start, end))
    return True


SPANS = "array<struct<kind:string,start:long,end:long,base:boolean,score:double>>"


def find_pii(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    examples: int = EXAMPLES,
    precision: float = PRECISION,
) -> DataFrame:
    """One row per row of ``docs``: id and ``spans``, structs of kind, start, end (code points, end
    exclusive), whether it is a base span, and its calibrated probability; by kind, then start.

    Every whole text is read. Base spans all stay, also where two kinds overlap; further spans
    overlap no other. NULL and empty texts have no spans. Rows without an id, and repeated rows,
    come out like others. The trees learn from ``examples`` made-up texts, on the driver, whatever
    ``docs`` holds. Nothing is shuffled. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    judge = spark.sparkContext.broadcast(train(examples, precision))
    id_type = docs.schema[id_col].dataType.simpleString()
    kind = pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("base", pa.bool_()), ("score", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(1)
            rows = np.flatnonzero(pc.match_substring_regex(texts, ANY).to_numpy(zero_copy_only=False))
            sizes, found = np.zeros(batch.num_rows, np.int64), []
            at = 0
            for some in portions_of(texts.take(pa.array(rows)), BATCH_BYTES):
                for spans in judged_spans(judge.value, some):
                    sizes[rows[at]] = len(spans)
                    found += [(KINDS[s.kind], s.start, s.end, b, q) for s, b, q in spans]
                    at += 1
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            values = [pa.array(c, f.type) for c, f in zip(zip(*found, strict=True) if found else [[]] * 5, kind, strict=True)]
            listed = pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays(values, fields=list(kind)))
            yield pa.RecordBatch.from_arrays([batch.column(0), listed], names=["id", "spans"])

    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    return rows.mapInArrow(run, f"id {id_type}, spans {SPANS}").withColumnRenamed("id", id_col)


def span_digests(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The rows of :func:`find_pii` as counts of base spans, their digest, and all spans in text."""
    base = F.filter("spans", lambda s: s["base"])

    def written(spans):
        return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])))

    def count(kind):
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    counts = [count(kind) for kind in KINDS]
    return found.select(
        id_col, *counts, F.sha2(written(base), 256).alias("base_sha256"), written(F.col("spans")).alias("spans")
    )


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """Id and ``redacted``: each text with its spans replaced by the kind in brackets.

    Overlapping spans become one, under the kind that starts first. A NULL text is empty.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    ship_package(spark)
    judge = spark.sparkContext.broadcast(train(**options))

    @F.arrow_udf("string")
    def hidden(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            out: list[str] = []
            for texts in portions_of(part, BATCH_BYTES):
                out += [_hide(t, s) for t, s in zip(texts, judged_spans(judge.value, texts), strict=True)]
            yield pa.array(out, pa.string())

    return rows.select(F.col("id").alias(id_col), hidden(F.col("text")).alias("redacted"))


def _hide(text: str, spans) -> str:
    pieces, done = [], 0
    for span, *_ in sorted(spans, key=lambda s: (s[0].start, -s[0].end)):
        if span.start >= done:
            pieces += [text[done : span.start], f"[{KINDS[span.kind].upper()}]"]
        done = max(done, span.end)
    return "".join([*pieces, text[done:]])
