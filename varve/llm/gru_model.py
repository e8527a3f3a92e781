"""A small bidirectional gated recurrent network with attention pooling, in numpy.

Inputs are words: a word embedding plus the mean of embeddings of the word's character runs, both
in hashed tables. Every window of words is read in both directions, the states are pooled by
attention, and a logistic unit gives the window's score. A text's score is that of its highest
window, over all overlapping windows.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass, field
from itertools import chain

import numpy as np

from varve.llm.part_enum import mix

WINDOW = 24
LEARN_STRIDE = 16
WORD_ROWS = 1 << 16
GRAM_ROWS = 1 << 18
WORD_DIM = 8
GRAM_DIM = 12
STATE = 8
GRAMS = (3, 4, 5)
WORD = re.compile(r"\w+")


def words_of(text: str) -> list[str]:
    return WORD.findall(text.lower())


def table_rows(words: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Table rows of words: one word row each, the rows of all their character runs (of 3 to 5
    bytes, with marks at the word's ends) laid end to end, and how many each word has."""
    word_rows = np.array([zlib.crc32(w.encode()) % WORD_ROWS for w in words], np.int64)
    data = [b"<" + w.encode() + b">" for w in words]
    sizes = np.array([len(d) for d in data], np.int64)
    flat = np.frombuffer(b"".join(data), np.uint8).astype(np.uint64)
    left = np.repeat(np.cumsum(sizes), sizes) - np.arange(len(flat))  # bytes to the word's end
    value = np.zeros(len(flat), np.uint64)
    rows, places = [], []
    for n in range(1, max(GRAMS) + 1):
        value[: len(flat) - n + 1] = value[: len(flat) - n + 1] * np.uint64(257) + flat[n - 1 :]
        if n in GRAMS:
            at = np.flatnonzero(left >= n)
            rows.append((mix(value[at]) % np.uint64(GRAM_ROWS)).astype(np.int32))
            places.append(at)
    places, rows = np.concatenate(places), np.concatenate(rows)
    rows = rows[np.argsort(places, kind="stable")]
    counts = sum(np.maximum(0, sizes - n + 1) for n in GRAMS)
    return word_rows.astype(np.int32), rows, counts


def sigmoid(x):
    with np.errstate(over="ignore"):
        return 1.0 / (1.0 + np.exp(-x))


@dataclass
class Model:
    """The parameters; ``scale`` and ``shift`` turn a window's logit into the text's score."""

    parameters: dict[str, np.ndarray]
    scale: float = 1.0
    shift: float = 0.0
    empty: bool = False
    memo: dict[str, int] = field(default_factory=dict, repr=False)
    table: np.ndarray = field(default_factory=lambda: np.zeros((0, 6 * STATE), np.float32), repr=False)

    def rows(self, cut: list[list[str]]) -> np.ndarray:
        """Rows of ``table`` for all words of some texts, laid end to end.

        The table holds the gates' inputs (both directions) of the words met so far, a bounded
        number beyond those of the texts at hand.
        """
        new = set().union(*cut).difference(self.memo)
        if len(self.memo) + len(new) > MEMO_LIMIT:
            self.forget()
            new = set().union(*cut)
        new = list(new)
        used = len(self.memo)
        if used + len(new) > len(self.table):
            room = np.zeros((used + 2 * len(new) + 10_000, 6 * STATE), np.float32)
            room[:used] = self.table[:used]
            self.table = room
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            self.table[used + at : used + at + len(part)] = gate_inputs(self.parameters, table_rows(part))
        self.memo.update(zip(new, range(used, used + len(new)), strict=True))
        flat = map(self.memo.__getitem__, chain.from_iterable(cut))
        return np.fromiter(flat, np.int64, sum(map(len, cut)))

    def forget(self) -> None:
        """Empties the table, as is due when the parameters change."""
        self.memo.clear()
        self.table = np.zeros((0, 6 * STATE), np.float32)


def new_parameters(seed: int = 5) -> dict[str, np.ndarray]:
    rng = np.random.default_rng(seed)
    size = WORD_DIM + GRAM_DIM

    def small(*shape):
        return (rng.standard_normal(shape) / np.sqrt(shape[0])).astype(np.float32)

    p = {
        "words": np.zeros((WORD_ROWS, WORD_DIM), np.float32),
        "grams": np.zeros((GRAM_ROWS, GRAM_DIM), np.float32),
    }
    for way in "fb":
        p[f"W{way}"] = small(size, 3 * STATE)
        p[f"U{way}"] = small(STATE, 3 * STATE)
        p[f"b{way}"] = np.zeros(3 * STATE, np.float32)
    p["A"] = small(2 * STATE, 2 * STATE)
    p["v"] = small(2 * STATE)
    p["o"] = small(2 * STATE)
    p["c"] = np.zeros(1, np.float32)
    return p


def gate_inputs(p, table) -> np.ndarray:
    """The gates' inputs, both directions side by side, of the words of ``table``."""
    x = word_vectors(p, table)
    return np.concatenate([x @ p["Wf"] + p["bf"], x @ p["Wb"] + p["bb"]], 1)


def word_vectors(p, table):
    """Inputs of distinct words from their table rows."""
    word_rows, flat, sizes = table
    starts = np.cumsum(sizes) - sizes
    sums = np.add.reduceat(p["grams"][flat], starts, 0)
    means = sums / np.sqrt(sizes, dtype=np.float32)[:, None]
    return np.concatenate([p["words"][word_rows], means], 1)


def _run(px, u, mask, back=False, keep=False):
    """States of one direction over (time, batch); masked steps keep the state."""
    steps, batch = px.shape[:2]
    h = np.zeros((batch, STATE), np.float32)
    states = np.empty((steps, batch, STATE), np.float32)
    saved = []
    for t in range(steps - 1, -1, -1) if back else range(steps):
        x, m = px[t], mask[t][:, None]
        gates = sigmoid(x[:, : 2 * STATE] + h @ u[:, : 2 * STATE])
        z, r = gates[:, :STATE], gates[:, STATE:]
        n = np.tanh(x[:, 2 * STATE :] + (r * h) @ u[:, 2 * STATE :])
        new = h + m * z * (n - h)
        if keep:
            saved.append((t, h, z, r, n))
        h = states[t] = new
    return states, saved


def window_logits(p, projected, index, mask):
    """Logits of windows; ``index`` (time, batch) names rows of ``projected``."""
    px = projected[index]
    f, _ = _run(px[..., : 3 * STATE], p["Uf"], mask)
    b, _ = _run(px[..., 3 * STATE :], p["Ub"], mask, back=True)
    h = np.concatenate([f, b], 2)
    e = np.tanh(h @ p["A"]) @ p["v"] + (mask - 1) * 1e4
    e = np.exp(e - e.max(0))
    pooled = (h * (e / e.sum(0))[..., None]).sum(0)
    return pooled @ p["o"] + p["c"][0]


def gradients(p, table, index, mask, labels):
    """Gradients on one batch of windows; ``index`` names the distinct words of ``table``."""
    word_rows, gram_flat, gram_sizes = table
    x = word_vectors(p, table)
    xs = x[index]
    g = {}
    ways = {}
    for way, back in (("f", False), ("b", True)):
        px = xs @ p[f"W{way}"] + p[f"b{way}"]
        ways[way] = _run(px, p[f"U{way}"], mask, back, keep=True)
    h = np.concatenate([ways["f"][0], ways["b"][0]], 2)
    q = np.tanh(h @ p["A"])
    e = q @ p["v"] + (mask - 1) * 1e4
    e = np.exp(e - e.max(0))
    a = e / e.sum(0)
    pooled = (h * a[..., None]).sum(0)
    y = sigmoid(pooled @ p["o"] + p["c"][0])
    dy = (y - labels) / len(labels)
    g["o"], g["c"] = pooled.T @ dy, np.array([dy.sum()], np.float32)
    dpooled = dy[:, None] * p["o"]
    da = (h * dpooled).sum(2)
    dh = a[..., None] * dpooled
    de = a * (da - (a * da).sum(0))
    g["v"] = (q * de[..., None]).sum((0, 1))
    dq = de[..., None] * p["v"] * (1 - q * q)
    g["A"] = _outer(h, dq)
    dh = dh + dq @ p["A"].T
    dxs = np.zeros_like(xs)
    for way, part in (("f", slice(0, STATE)), ("b", slice(STATE, 2 * STATE))):
        u = p[f"U{way}"]
        du, dpx = np.zeros_like(u), np.zeros((*xs.shape[:2], 3 * STATE), np.float32)
        carry = np.zeros((xs.shape[1], STATE), np.float32)
        for t, before, z, r, n in reversed(ways[way][1]):
            d = carry + dh[t, :, part]
            m = mask[t][:, None]
            dn = d * m * z * (1 - n * n)
            dz = d * m * (n - before) * z * (1 - z)
            drh = dn @ u[:, 2 * STATE :].T
            dr = drh * before * r * (1 - r)
            gates = np.concatenate([dz, dr], 1)
            du[:, : 2 * STATE] += before.T @ gates
            du[:, 2 * STATE :] += (r * before).T @ dn
            carry = d * (1 - m * z) + drh * r + gates @ u[:, : 2 * STATE].T
            dpx[t] = np.concatenate([gates, dn], 1)
        g[f"U{way}"] = du
        g[f"W{way}"] = _outer(xs, dpx)
        g[f"b{way}"] = dpx.sum((0, 1))
        dxs += dpx @ p[f"W{way}"].T
    _, dx = _grouped(np.r_[index.ravel(), np.arange(len(x))], np.r_[dxs.reshape(-1, x.shape[1]), np.zeros_like(x)])
    dgram = np.repeat(dx[:, WORD_DIM:] / np.sqrt(gram_sizes, dtype=np.float32)[:, None], gram_sizes, 0)
    return g, {"words": _grouped(word_rows, dx[:, :WORD_DIM]), "grams": _grouped(gram_flat, dgram)}


def _outer(a, b):
    """Sum over time and batch of the outer products."""
    return a.reshape(-1, a.shape[2]).T @ b.reshape(-1, b.shape[2])


def _grouped(rows, values):
    """Distinct rows and the sums of their values."""
    order = np.argsort(rows, kind="stable")
    rows = rows[order]
    first = np.flatnonzero(np.r_[True, rows[1:] != rows[:-1]])
    return rows[first], np.add.reduceat(values[order], first, 0)


class Adam:
    """Adam; table rows that a batch does not touch keep their values and moments."""

    def __init__(self, p, rate):
        self.p, self.rate, self.t = p, rate, 0
        self.m = {k: np.zeros_like(v) for k, v in p.items()}
        self.s = {k: np.zeros_like(v) for k, v in p.items()}

    def step(self, dense, sparse):
        self.t += 1
        fix = np.sqrt(1 - 0.999**self.t) / (1 - 0.9**self.t)
        for k, g in dense.items():
            self._move(k, slice(None), g, fix)
        for k, (rows, g) in sparse.items():
            self._move(k, rows, g, fix)

    def _move(self, k, at, g, fix):
        self.m[k][at] = m = 0.9 * self.m[k][at] + 0.1 * g
        self.s[k][at] = s = 0.999 * self.s[k][at] + 0.001 * g * g
        self.p[k][at] -= self.rate * fix * m / (np.sqrt(s) + 1e-7)


def windows_of(n: int) -> np.ndarray:
    """First words of the windows of a text of ``n`` words that training picks examples from; the
    last reaches the text's end. Scores are over all windows, see :func:`text_logits`."""
    if n <= WINDOW:
        return np.zeros(min(n, 1), np.int64)
    starts = np.arange(0, n - WINDOW, LEARN_STRIDE)
    return np.r_[starts, n - WINDOW]


def _layout(starts, ends, width=WINDOW):
    """(time, batch) positions and mask of windows that begin at ``starts`` within ``ends``."""
    index = starts[None, :] + np.arange(width)[:, None]
    mask = (index < ends[None, :]).astype(np.float32)
    return np.minimum(index, np.maximum(ends - 1, 0)[None, :]), mask


MEMO_LIMIT = 200_000
SCORE_BATCH = 2048
SLIDE_BATCH = 2048


def best_windows(p, projected, flat, sizes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, first word in it, logit) of spread windows of texts given as rows of ``projected``.

    ``flat`` has the rows of all texts' words end to end, ``sizes`` each text's number of words.
    """
    firsts = np.cumsum(sizes) - sizes
    per_text = [windows_of(n) for n in sizes.tolist()]
    counts = np.array([len(s) for s in per_text], np.int64)
    owner = np.repeat(np.arange(len(sizes)), counts)
    within = np.concatenate([np.zeros(0, np.int64), *per_text])
    starts = within + firsts[owner]
    ends = np.minimum(starts + WINDOW, (firsts + sizes)[owner])
    logits = np.zeros(len(starts), np.float32)
    order = np.argsort(ends - starts, kind="stable")  # short windows together
    for at in range(0, len(order), SCORE_BATCH):
        part = order[at : at + SCORE_BATCH]
        width = int((ends[part] - starts[part]).max())
        index, mask = _layout(starts[part], ends[part], width)
        logits[part] = window_logits(p, projected, flat[index], mask)
    return owner, within, logits


def sliding_logits(p, x) -> np.ndarray:
    """Logits of the windows that begin at every word but the last ``WINDOW - 1``.

    ``x`` has the words' gate inputs as columns, so step t of all windows is one slice of it.
    """
    n = x.shape[1] - WINDOW + 1
    states = np.empty((WINDOW, 2 * STATE, n), np.float32)
    _steps(p["Uf"], x[: 3 * STATE], range(WINDOW), states[:, :STATE])
    _steps(p["Ub"], x[3 * STATE :], range(WINDOW - 1, -1, -1), states[:, STATE:])
    attention, q = p["A"].T.copy(), np.empty((2 * STATE, n), np.float32)
    e, value = np.empty((WINDOW, n), np.float32), np.empty((WINDOW, n), np.float32)
    for t in range(WINDOW):
        np.matmul(attention, states[t], out=q)
        np.tanh(q, out=q)
        np.matmul(p["v"], q, out=e[t])
        np.matmul(p["o"], states[t], out=value[t])
    e = np.exp(e - e.max(0))
    return (e * value).sum(0) / e.sum(0) + p["c"][0]


def _steps(u, x, order, states) -> None:
    """Fills ``states`` (time, state, window) in one direction.

    The logistic function is taken as a hyperbolic tangent: 2 / (1 + exp(-a)) = 1 + tanh(a / 2).
    """
    n = states.shape[2]
    u_gates, u_new = 0.5 * u[:, : 2 * STATE].T, 0.5 * u[:, 2 * STATE :].T
    x_gates, x_new = 0.5 * x[: 2 * STATE], x[2 * STATE :]
    first, *rest = order
    update = np.tanh(x_gates[:STATE, first : first + n])  # the state before is zero
    update += 1
    update *= 0.5
    h, gates = states[first], np.empty((2 * STATE, n), np.float32)
    np.tanh(x_new[:, first : first + n], out=h)
    h *= update
    for t in rest:
        np.matmul(u_gates, h, out=gates)
        gates += x_gates[:, t : t + n]
        np.tanh(gates, out=gates)
        gates += 1
        gates[STATE:] *= h
        new = states[t]
        np.matmul(u_new, gates[STATE:], out=new)
        new += x_new[:, t : t + n]
        np.tanh(new, out=new)
        new -= h
        gates[:STATE] *= 0.5
        new *= gates[:STATE]
        new += h
        h = new


def text_logits(p, projected, flat, sizes) -> np.ndarray:
    """Every text's highest logit over the windows that begin at each of its words and fit in it
    (a shorter text is one window); minus infinity without words. Arguments as for
    :func:`best_windows`.
    """
    best = np.full(len(sizes), -np.inf, np.float32)
    wide = sizes >= WINDOW
    in_wide = np.repeat(wide, sizes)
    owner, _, logits = best_windows(p, projected, flat[~in_wide], sizes * ~wide)
    best[owner] = logits
    if not wide.any():
        return best
    flat, sizes = flat[in_wide], sizes[wide]
    logits = np.empty(len(flat) - WINDOW + 1, np.float32)
    for at in range(0, len(logits), SLIDE_BATCH):
        words = flat[at : at + SLIDE_BATCH + WINDOW - 1]
        logits[at : at + SLIDE_BATCH] = sliding_logits(p, np.ascontiguousarray(projected[words].T))
    ends = np.cumsum(sizes)
    # Windows that reach into the next text do not count.
    across = (ends[:-1, None] - np.arange(1, WINDOW)[None, :]).ravel()
    logits[across] = -np.inf
    best[wide] = np.maximum.reduceat(logits, ends - sizes)
    return best


def score_texts(model: Model, texts: list[str]) -> np.ndarray:
    """The highest window logit of every text; minus infinity without words."""
    cut = [words_of(t) for t in texts]
    flat = model.rows(cut)
    sizes = np.array([len(ws) for ws in cut], np.int64)
    return text_logits(model.parameters, model.table, flat, sizes).astype(float)
