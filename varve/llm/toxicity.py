"""Toxicity scores of whole texts by a recurrent network over all overlapping windows.

Labels are per text, but a few words decide, so training alternates: windows of toxic texts that
hold the words and word beginnings with the clearest odds start as examples, next to windows of
other texts; the trained network then picks each toxic text's best window and the other texts'
most mistaken ones, and training goes on with these.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from varve.llm import gru_model as net
from varve.llm.common import portions_of, release_memory, ship_package

# Defaults of the training sample: this many texts of each label at most, none longer than that.
TRAIN_TOXIC = 800
TRAIN_OTHER = 3200
TRAIN_CHARS = 6_000
THRESHOLD = 0.7
ROUNDS = 4
STEPS = 100
BATCH = 72
FOLDS = 3  # the threshold is set on scores by networks that have not seen the text's fold
FITS_AT_ONCE = 2  # networks that learn side by side on the driver, the second takes about 100 MB
FEATURES = 1 << 20
LEAST_ODDS = 1.5  # a seed's log odds, and how far beyond chance its count must be
LEAST_SPREADS = 4
RATE = 0.02
BATCH_BYTES = 500_000


def _features(word):
    """Numbers of a word and of its beginnings, told apart by the mark at the word's end."""
    names = [f"{word}>", *(word[:n] for n in (4, 5, 6) if len(word) > n)]
    return [zlib.crc32(f.encode()) % FEATURES for f in names]


def _features_of(vocabulary):
    """The features of each word, -1 where it has fewer than four."""
    of_word = np.full((len(vocabulary), 4), -1, np.int32)
    for row, word in zip(of_word, vocabulary, strict=True):
        found = _features(word)
        row[: len(found)] = found
    return of_word


def _seeds(of_word, numbered, labels):
    """Whether each word holds a feature that several toxic texts and hardly any others hold."""
    seen = np.zeros((2, FEATURES + 1), np.int32)  # the last place is for missing features
    for words, label in zip(numbered, labels.tolist(), strict=True):
        seen[label][np.unique(of_word[np.unique(words)])] += 1
    n, m = max(1, int(labels.sum())), max(1, int((labels == 0).sum()))
    odds = np.log((seen[1] + 0.2) / n) - np.log((seen[0] + 0.2) / m)
    expected = (seen[0] + seen[1]) * (n / (n + m))
    spread = np.sqrt(np.maximum(expected, 1e-9) * (m / (n + m)))
    clear = (seen[1] >= 3) & (odds >= LEAST_ODDS) & (seen[1] - expected >= LEAST_SPREADS * spread)
    clear[-1] = False
    return clear[of_word].any(1)


def _examples(numbered, labels, learned, seeds, rng):
    """(text, first word, label) windows of the texts ``learned`` to start from."""
    found = []
    for i in learned.tolist():
        words, label = numbered[i], int(labels[i])
        if label:
            for k in np.flatnonzero(seeds[words])[:40].tolist():
                first = k - int(rng.integers(0, net.WINDOW))
                found.append((i, max(0, min(first, len(words) - net.WINDOW)), 1))
        elif len(words):
            starts = net.windows_of(len(words))
            for first in rng.choice(starts, min(len(starts), 24), replace=False):
                found.append((i, int(first), 0))
    return found


def train(texts: list[str], labels: list[int], seed: int = 3) -> net.Model:
    """A model from labelled texts; without both labels, one that scores every text 0."""
    model = net.Model(net.new_parameters(seed))
    labels = np.array(labels, np.int64)
    if not labels.any() or labels.all():
        model.empty = True
        return model
    numbers: dict[str, int] = {}
    numbered = [
        np.array([numbers.setdefault(w, len(numbers)) for w in net.words_of(t)], np.int32) for t in texts
    ]
    vocabulary = list(numbers)
    rows = [net.table_rows(vocabulary[k : k + 10_000]) for k in range(0, len(vocabulary), 10_000)]
    word_rows, flat, sizes = (np.concatenate(r) for r in zip(*rows, strict=True))
    tables = (word_rows, flat, sizes, np.cumsum(sizes) - sizes)
    del rows
    of_word = _features_of(vocabulary)
    everything = np.arange(len(texts))

    def judged(judge, spared):
        return net.text_logits(judge, _gates(judge, tables, len(vocabulary)), *_laid(numbered, spared))

    def judged_apart(fold):
        """The logits of a fold's texts by a network that has not seen them, if there is one."""
        learned, spared = everything[everything % FOLDS != fold], everything[everything % FOLDS == fold]
        apart = _fit(of_word, numbered, labels, tables, learned, seed) if len(spared) else None
        return None if apart is None else judged(apart, spared)

    with ThreadPoolExecutor(FITS_AT_ONCE) as pool:
        whole = pool.submit(_fit, of_word, numbered, labels, tables, everything, seed)
        folds = [pool.submit(judged_apart, fold) for fold in range(FOLDS)]
    fit = whole.result()
    if fit is None:
        model.empty = True
        return model
    best = np.zeros(len(texts))
    for fold in range(FOLDS):
        spared, logits = everything[everything % FOLDS == fold], folds[fold].result()
        best[spared] = judged(fit, spared) if logits is None else logits
    model.parameters = fit
    _calibrate(model, best, labels)
    return model


def _fit(of_word, numbered, labels, tables, learned, seed):
    """Parameters learnt from the texts ``learned``; None where they hold nothing to tell apart."""
    others, toxic = learned[labels[learned] == 0], learned[labels[learned] == 1]
    if not len(others) or not len(toxic):
        return None
    p = net.new_parameters(seed)
    rng = np.random.default_rng(seed)
    seeds = _seeds(of_word, [numbered[i] for i in learned], labels[learned])
    examples = _examples(numbered, labels, learned, seeds, rng)
    adam = net.Adam(p, RATE)

    def scores(chosen, gates):
        """(text, first word, logit) arrays of windows of the chosen texts."""
        laid, many = _laid(numbered, chosen)
        owner, first, logits = net.best_windows(p, gates, laid, many)
        return chosen[owner], first, logits

    for turn in range(ROUNDS):
        positive = [e for e in examples if e[2]]
        negative = [e for e in examples if not e[2]]
        if not positive or not negative:
            return None if not positive else p
        for step in range(STEPS):
            adam.rate = RATE * (1 - 0.9 * (turn * STEPS + step) / (ROUNDS * STEPS))
            some = [positive[k] for k in rng.integers(0, len(positive), BATCH // 3)]
            some += [negative[k] for k in rng.integers(0, len(negative), BATCH - len(some))]
            _step(adam, numbered, tables, some)
        if turn < ROUNDS - 1:
            gates = _gates(p, tables, len(of_word))
            examples = examples + _mined(*scores(others, gates), 4, 0) + _mined(*scores(toxic, gates), 1, 1)
            del gates
    return p


def _laid(numbered, chosen):
    """The words of the chosen texts end to end, and how many each text has."""
    some = [numbered[i] for i in chosen]
    return np.concatenate([np.zeros(0, np.int32), *some]), np.array([len(s) for s in some], np.int64)


def _gates(p, tables, n):
    """The gates' inputs of all words of the vocabulary."""
    parts = [np.arange(k, min(k + 20_000, n)) for k in range(0, n, 20_000)]
    return np.concatenate([net.gate_inputs(p, _part(tables, part)) for part in parts])


def _part(tables, chosen):
    """The table rows of some words of the vocabulary."""
    word_rows, flat, sizes, starts = tables
    many = sizes[chosen]
    within = np.arange(int(many.sum())) - np.repeat(np.cumsum(many) - many, many)
    return word_rows[chosen], flat[np.repeat(starts[chosen], many) + within], many


def _step(adam, numbered, tables, some):
    """One step on the windows ``some``; ``numbered`` has the texts' words as numbers."""
    pieces = [numbered[i][first : first + net.WINDOW] for i, first, _ in some]
    mask = np.zeros((net.WINDOW, len(pieces)), np.float32)
    index = np.zeros((net.WINDOW, len(pieces)), np.int64)
    for b, piece in enumerate(pieces):
        index[: len(piece), b] = piece
        index[len(piece) :, b] = piece[-1]
        mask[: len(piece), b] = 1
    distinct, index = np.unique(index, return_inverse=True)
    labels = np.array([label for _, _, label in some], np.float32)
    table = _part(tables, distinct)
    adam.step(*net.gradients(adam.p, table, index.reshape(mask.shape), mask, labels))


def _mined(owner, first, logits, most, label):
    """Each text's ``most`` highest windows, if they look toxic, as examples of ``label``."""
    order = np.lexsort((-logits, owner))
    rank = np.arange(len(order)) - np.searchsorted(owner[order], owner[order])
    chosen = order[(rank < most) & (logits[order] > (0 if label else -3))]
    weight = 2 if label else 3
    return [(int(i), int(k), label) for i, k in zip(owner[chosen], first[chosen], strict=True)] * weight


def _calibrate(model, best, labels):
    """Puts the threshold where the texts part best by scores of networks that have not seen them:
    most toxic ones above, then the middle of the gap."""
    best = np.where(np.isfinite(best), best, -20.0)
    order = np.unique(best)
    middles = (order[1:] + order[:-1]) / 2 if len(order) > 1 else order
    if len(middles) > 2000:
        middles = np.quantile(middles, np.linspace(0, 1, 2000))
    toxic, other = np.sort(best[labels == 1]), np.sort(best[labels == 0])
    caught = len(toxic) - np.searchsorted(toxic, middles)
    wrong = len(other) - np.searchsorted(other, middles)
    score = 2 * caught / np.maximum(1, caught + wrong + len(toxic))
    top = middles[score >= score.max() - 1e-9]
    at = float(np.median(top))
    model.scale = 1.0
    model.shift = float(np.log(THRESHOLD / (1 - THRESHOLD)) - at)


def training_sample(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str,
    text_col: str,
    most_toxic: int = TRAIN_TOXIC,
    most_other: int = TRAIN_OTHER,
    most_chars: int = TRAIN_CHARS,
) -> list[tuple[str, int]]:
    """(text, toxic) rows to learn from: no held-out rows, a bounded number, short ones only.

    The ids are chosen first, by hash, from the lengths of the texts and the labels; then only
    the texts of these few ids are fetched. So no text is shuffled, and the driver holds
    ``most_chars`` characters of each chosen row at most. An id with several texts counts once in
    the choice, and the first of its texts (by hash) is learned from.
    """
    label = labels.select(F.col(id_col).alias("label_id"), F.col("toxic").alias("toxic"))
    label = label.where("toxic IS NOT NULL AND label_id IS NOT NULL")
    label = label.where(~held_out("label_id")).groupBy("label_id").agg(F.max("toxic").alias("toxic"))
    texts = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    short = texts.where(F.length("text").between(1, most_chars))
    usable = label.join(short.select(F.col("id").alias("label_id")), "label_id", "left_semi")
    order = [F.xxhash64("label_id"), F.col("label_id")]
    chosen: dict = {}
    for toxic, most in ((1, most_toxic), (0, most_other)):
        rows = usable.where(F.col("toxic") == toxic).orderBy(*order).limit(most)
        chosen |= {r["label_id"]: toxic for r in rows.select("label_id").collect()}
    if not chosen:
        return []
    kind = docs.schema[id_col].dataType.simpleString()
    wanted = docs.sparkSession.createDataFrame([(i,) for i in chosen], f"id {kind}")
    fetched = short.join(F.broadcast(wanted), "id", "left_semi")
    first = fetched.groupBy("id").agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
    found = {r["id"]: r["text"] for r in first.select("id", "least.text").collect()}
    return [(found[i], toxic) for i, toxic in chosen.items() if i in found]


def held_out(id_col: str):
    """Whether crc32 of the id as text leaves 1 modulo 3; a row without an id is not held out."""
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def score_toxicity(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sample: int
) -> DataFrame:
    """The rows of ``docs`` with ``score`` (0 to 1), ``predicted`` (score >= 0.7) and ``held_out``.

    The network learns from the labelled rows that are not held out, see :func:`training_sample`,
    whose bounds ``sample`` may set; only their texts and labels are used. The threshold is set by
    cross-validation over them, at every size. A text's score is that of its highest window, over
    the windows that begin at each of its words. NULL, empty and wordless texts score 0. Without
    labels of both kinds every text scores 0. Repeated rows score alike. An empty table gives no
    rows. Columns of ``docs`` with the new names are replaced; others, as ``toxic``, stay.
    """
    score = scorer(docs.sparkSession, training_sample(docs, labels, id_col, text_col, **sample))
    out = docs.withColumn("held_out", held_out(id_col))
    out = out.withColumn("score", score(F.coalesce(F.col(text_col), F.lit(""))))
    return out.withColumn("predicted", (F.col("score") >= THRESHOLD).cast("int"))


def scorer(spark: SparkSession, sample: list[tuple[str, int]]):
    """The score of a text column as a function of columns, learnt from (text, toxic) rows."""
    ship_package(spark)
    model = spark.sparkContext.broadcast(train([t for t, _ in sample], [y for _, y in sample]))

    @F.arrow_udf("double")
    def scores_of(parts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for part in parts:
            scores = [np.zeros(len(part) if model.value.empty else 0)]
            for texts in () if model.value.empty else portions_of(part, BATCH_BYTES):
                best = net.score_texts(model.value, texts)
                scores.append(net.sigmoid(model.value.scale * best + model.value.shift))
            yield pa.array(np.concatenate(scores))
        model.value.forget()
        release_memory()

    return scores_of


def drop_toxic(
    docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **sample: int
) -> DataFrame:
    """The rows of ``docs`` that are not predicted to be toxic, with all their columns.

    Scores and edge cases are those of :func:`score_toxicity`; an empty table gives no rows.
    """
    score = scorer(docs.sparkSession, training_sample(docs, labels, id_col, text_col, **sample))
    return docs.where(score(F.coalesce(F.col(text_col), F.lit(""))) < THRESHOLD)
