"""Each operator against brute force on a small table of hard cases."""

import hashlib
import itertools
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tests.llm.conftest import COPY, LONG, PASSAGE, ROWS, prose
from varve.llm import (
    content_sort,
    gear_chunks,
    gru_model,
    part_enum,
    positional_index,
    ring,
    suffix_pieces,
    tag_paths,
    token_transducer,
    toxicity,
    url_rules,
)
from varve.llm.components import connected_components

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ITEMS = [
    (1, PASSAGE),
    (2, " ".join(COPY.split(" ")[20:32])),
    (3, "one"),
    (4, None),
    (5, ""),
    (10, "A, b c d!"),
    (3, "one"),
    (None, "one"),
    (6, prose(20, 77)),
    (7, "x x x x x x x x x x x x"),
]


def key(rows):
    return sorted(rows, key=repr)


# ---- exact dedup


def test_content_sort_agrees_with_grouping(docs):
    groups = defaultdict(list)
    for i, t in ROWS:
        t = t or ""
        groups[re.sub("[\x20\x09-\x0d]+", "", t)].append((-len(t), i is None, i))
    want = []
    for norm, members in groups.items():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        sha = hashlib.sha256(norm.encode()).hexdigest()
        want += [(m[2], members[0][2], len(members), k == 0, sha) for k, m in enumerate(members)]
    got = content_sort.content_sort(docs).collect()
    assert key(tuple(r) for r in got) == key(want)


def test_content_sort_spans_ranges(spark):
    many = spark.range(0, 3000).select(
        F.col("id").alias("doc_id"),
        F.when(F.col("id") % 3 == 0, "hot copy").otherwise(F.concat(F.lit("t"), F.col("id"))).alias("text"),
    )
    rows = content_sort.content_sort(many).where("group_size > 1").collect()
    assert len(rows) == 1000 and {r["group_size"] for r in rows} == {1000}
    assert {r["keep_id"] for r in rows} == {0} and sum(r["kept"] for r in rows) == 1


def test_exact_dedup_keeps_columns(docs, no_docs):
    kept = content_sort.exact_dedup(docs)
    assert kept.columns == docs.columns
    ids = [r["doc_id"] for r in kept.collect()]
    assert 1 not in ids and 2 in ids and ids.count(9) == 3  # a repeated row cannot be told apart
    assert content_sort.exact_dedup(no_docs).count() == 0


# ---- decontamination


def contaminated_by_hand(rows, items, window=10):
    def words(t):
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (t or "").translate(LOWER))

    windows = defaultdict(set)
    for i, t in items:
        w = words(t)
        if i is not None and w:
            n = min(window, len(w))
            for s in range(len(w) - n + 1):
                windows[tuple(w[s : s + n])].add(str(i))
    sizes = {len(w) for w in windows}
    for i, t in rows:
        w, hit, found = words(t), set(), set()
        for n in sizes:
            for s in range(len(w) - n + 1):
                if tuple(w[s : s + n]) in windows:
                    hit.update(range(s, s + n))
                    found |= windows[tuple(w[s : s + n])]
        sha = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        yield i, len(w), len(hit), len(found), sha, bool(hit)


def test_contamination_agrees_with_brute_force(spark, docs, no_docs):
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    got = positional_index.contamination(docs, items)
    assert key(tuple(r)[:6] for r in got.collect()) == key(contaminated_by_hand(ROWS, ITEMS))
    assert positional_index.contamination(no_docs, items).count() == 0
    clean = positional_index.contamination(docs, items.where("false")).collect()
    assert len(clean) == len(ROWS) and not any(r["contaminated"] for r in clean)
    kept = positional_index.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    want = [r[0] for r in contaminated_by_hand(ROWS, ITEMS) if not r[5]]
    assert key(r["doc_id"] for r in kept.collect()) == key(want)


def test_near_passages(spark):
    words = PASSAGE.split(" ")
    broken = [w for pair in zip(words, ["z"] * len(words), strict=True) for w in pair][: 2 * len(words) - 1]
    rows = spark.createDataFrame([(1, " ".join(broken)), (2, prose(80, 123))], "doc_id long, text string")
    items = spark.createDataFrame([(1, PASSAGE)], "item_id long, text string")
    got = {r["doc_id"]: r for r in positional_index.contamination(rows, items, slop=9).collect()}
    assert not got[1]["contaminated"] and got[1]["n_near"] == 1 and got[2]["n_near"] == 0


# ---- near duplicates


def components_by_hand(rows):
    sets = {}
    for i, t in rows:
        w = re.findall("[^\x20\x09-\x0d]+", (t or "").translate(LOWER))
        s = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        sets.setdefault(i, []).append(s)
    root = {i: i for i in sets if i is not None}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in root:
        for b in root:
            for s in sets[a]:
                for t in sets[b]:
                    if a != b and s and 100 * len(s & t) >= 80 * len(s | t):
                        x, y = find(a), find(b)
                        root[max(x, y)] = min(x, y)
    return [(i, len(s), None if i is None else find(i)) for i, ss in sets.items() for s in ss]


def test_jaccard_components_agree_with_brute_force(spark, docs, no_docs):
    got = part_enum.jaccard_components(docs)
    assert key(tuple(r) for r in got.collect()) == key(components_by_hand(ROWS))
    assert part_enum.jaccard_components(no_docs).count() == 0
    kept = part_enum.drop_near_copies(docs)
    assert kept.columns == docs.columns
    want = [r[0] for r in components_by_hand(ROWS) if r[0] == r[2]]
    assert key(r["doc_id"] for r in kept.collect()) == key(want)


def edited(words, n, seed):
    words = list(words)
    for k in range(n):
        words[(seed * 31 + k * 37) % len(words)] = f"e{seed}x{k}"
    return " ".join(words)


def test_links_near_the_threshold(spark):
    rows = []
    for base in range(12):
        words = prose(20 + 17 * base, 200 + base).split(" ")
        rows += [(len(rows) + k, edited(words, k % 5, base * 50 + k)) for k in range(10)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = part_enum.jaccard_components(df).collect()
    assert key(tuple(r) for r in got) == key(components_by_hand(rows))


def test_hubs_of_many_blocks_lose_no_link(spark, monkeypatch):
    """Chains whose ends are not near their hub, and a large group of near copies."""
    monkeypatch.setattr(part_enum, "BLOCK_SETS", 4)
    words = prose(260, 300).split(" ")
    rows = [(k, " ".join(words[2 * k : 2 * k + 100])) for k in range(40)]
    copy = prose(150, 301).split(" ")
    rows += [(100 + k, edited(copy, k % 6, k)) for k in range(40)]
    rows += [(100, rows[5][1]), (150, ""), (151, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = part_enum.jaccard_components(df).collect()
    assert key(tuple(r) for r in got) == key(components_by_hand(rows))


def test_every_linked_pair_shares_a_signature():
    import numpy as np

    rng = np.random.default_rng(0)
    for size in [*range(1, 40), 60, 100, 333, 1000]:
        for _ in range(20):
            a = np.unique(rng.integers(0, 2**63, size).astype(np.uint64))
            out = rng.integers(0, len(a) // 9 + 1)
            new = rng.integers(0, 2**63, max(0, len(a) // 9 - out)).astype(np.uint64)
            b = np.unique(np.concatenate([rng.permutation(a)[out:], new]))
            both = len(np.intersect1d(a, b))
            if both and 100 * both >= 80 * (len(a) + len(b) - both):
                common = np.sort(rng.permutation(a)[: len(a) // 2])
                for known in (None, common):
                    assert np.intersect1d(part_enum.signatures(a, known), part_enum.signatures(b, known)).size


def test_connected_components(spark):
    edges = [(i, i + 1) for i in range(50)] + [(100, 150), (150, 120), (60, 60)]
    got = connected_components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r["node"]: r["root"] for r in got} == {i: 0 for i in range(51)} | {100: 100, 120: 100, 150: 100}


# ---- repeated passages


def test_repeated_spans(docs, no_docs):
    spans = gear_chunks.repeated_spans(docs)
    rows = spans.collect()
    by_id = defaultdict(list)
    for r in rows:
        by_id[r["doc_id"]].append(r)
    assert {12, 13, 7, 8, 1} <= by_id.keys() and not {5, 6, 9, 11, 14, None} & by_id.keys()
    text = dict(ROWS[:16])
    for i in (12, 13):
        (span,) = by_id[i]
        found = text[i].encode()[span["start"] : span["start"] + span["n_bytes"]].decode()
        assert found in PASSAGE and span["first_id"] == 12 and span["kept"] == (i == 12)
    assert gear_chunks.repeated_spans(no_docs).count() == 0
    cleaned = gear_chunks.remove_spans(docs, spans)
    assert cleaned.columns == docs.columns and cleaned.count() == docs.count()
    left = {r["doc_id"]: r["text"] for r in cleaned.where("doc_id IN (7, 8, 12, 13, 4)").collect()}
    assert left[7] == LONG and left[12] == text[12] and left[4] is None
    assert len(left[8]) < 300 and len(left[13]) < len(text[13]) - 200


def test_holders_of_different_extent(spark):
    """Every passage survives once, also where first holders differ within a run of shared chunks."""
    x, y, z = (prose(n, seed) for n, seed in ((90, 301), (80, 302), (90, 303)))
    chance = z.encode()[: gear_chunks.cut_points(np.frombuffer(z.encode(), np.uint8))[1]].decode()
    texts = {
        1: f"{prose(40, 311)} {x} {prose(40, 312)}",
        2: chance,  # a few chunks of z, less than a passage
        5: f"{prose(40, 313)} {x} {y} {prose(40, 314)}",
        6: z,
        7: z,
        9: f"{prose(40, 315)} {x} {y} {prose(40, 316)}",
    }
    df = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    spans = gear_chunks.repeated_spans(df)
    rows = spans.collect()
    assert {(r["doc_id"], r["first_id"], r["kept"]) for r in rows} == {
        (1, 1, True), (5, 1, False), (5, 5, True), (9, 1, False), (9, 5, False), (6, 6, True), (7, 6, False),
    }
    left = {r["doc_id"]: r["text"] for r in gear_chunks.remove_spans(df, spans).collect()}
    assert left[1] == texts[1] and left[2] == chance and left[6] == z
    middle = {name: " ".join(p.split()[20:-20]) for name, p in (("x", x), ("y", y), ("z", z))}
    for name, holder in (("x", 1), ("y", 5), ("z", 6)):
        assert [i for i, t in left.items() if middle[name] in t] == [holder]


def test_passages_of_51_short_words_are_found(spark):
    """Passages just beyond 50 words, of words of 3 and 4 letters and in a script without spaces."""
    rng = np.random.default_rng(4)

    def text(letters, n):
        if not letters:
            return "".join(chr(0x4E00 + c) for c in rng.integers(0, 3000, 2 * n))
        sizes = np.maximum(1, rng.poisson(letters, n))
        return " ".join("".join(chr(97 + c) for c in rng.integers(0, 26, size)) for size in sizes)

    rows, where = [], {}
    for i in range(300):
        letters = (3, 4, 0)[i % 3]
        passage, between = text(letters, 51), " " if letters else ""
        for j in (2 * i, 2 * i + 1):
            before = text(letters, 30 + j % 7)
            rows.append((j, between.join([before, passage, text(letters, 30)])))
            where[j] = (len((before + between).encode()), len(passage.encode()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    found = {r["doc_id"]: r for r in gear_chunks.repeated_spans(df).collect()}
    assert found.keys() == where.keys()
    for j, r in found.items():
        start, size = where[j]
        assert start - 3 <= r["start"] and r["start"] + r["n_bytes"] <= start + size + 3
        assert r["n_bytes"] > size // 2 and r["first_id"] == j - j % 2 and r["kept"] == (j % 2 == 0)


def test_chunks_survive_insertions_and_cover_texts():
    import numpy as np

    data = np.frombuffer((COPY + "é" * 400 + LONG[:5000]).encode(), np.uint8)
    moved = np.frombuffer(("abc " + COPY + "é" * 400 + LONG[:5000]).encode(), np.uint8)
    found = []
    for d in (data, moved):
        ends = gear_chunks.cut_points(d)
        assert ends[-1] == len(d) and (np.diff(ends) > 0).all() and np.diff(ends).max() <= 256
        bytes(d[: ends[0]]).decode()
        found.append(set(gear_chunks.chunk_digests(d, ends)[0].tolist()))
    assert len(found[0] & found[1]) > 0.95 * len(found[0])


# ---- tokens


@pytest.fixture(scope="module")
def hard_texts():
    import random

    rnd = random.Random(4)
    letters = "abct heAÉßΣς \n\t  ▁'sretd012 <|startoftext|>日本語😀é́İ!!##.,-_ \xa0\x1c\x7f½²Ⅳ"
    fuzz = ["".join(rnd.choice(letters) for _ in range(rnd.randrange(50))) for _ in range(800)]
    return [t for _, t in ROWS if t] + fuzz + ["", "  a", " " * 9, "▁▁", "aaaaaaaaaaaaab" * 9, "'LL I'm"]


def test_token_counts(spark, docs, no_docs, hard_texts):
    path = public_tokenizers.path("word_bpe_49k.json")
    library = Tokenizer.from_file(path)
    counter = token_transducer.Counter(open(path, "rb").read())
    want = [len(e.ids) for e in library.encode_batch(hard_texts, add_special_tokens=False)]
    assert counter.counts(hard_texts).tolist() == want
    got = token_transducer.count_tokens(docs, path)
    n = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in ROWS]
    sizes = [len((t or "").encode()) for _, t in ROWS]
    hand = [(i, b, k, k > 2048) for (i, _), b, k in zip(ROWS, sizes, n, strict=True)]
    assert key(tuple(r) for r in got.collect()) == key(hand)
    assert token_transducer.count_tokens(no_docs, path).count() == 0


def test_sentencepiece(spark, docs, no_docs, hard_texts):
    path = public_tokenizers.path("piece_bpe_32k.model")
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = suffix_pieces.Pieces(open(path, "rb").read())
    flat, sizes = pieces.encode(hard_texts)
    assert flat.tolist() == [i for t in hard_texts for i in library.encode(t)]
    assert pieces.decode_all(flat, sizes).to_pylist() == [t.replace("▁", " ") for t in hard_texts]
    got = suffix_pieces.round_trip(docs, path)
    hand = [(i, library.encode(t or ""), len(library.encode(t or "")), t or "") for i, t in ROWS]
    assert key(tuple(r) for r in got.collect()) == key(hand)
    again = suffix_pieces.decode(got.drop("text"), path)
    assert key(again.select("doc_id", "text").collect()) == key(got.select("doc_id", "text").collect())
    assert suffix_pieces.round_trip(no_docs, path).count() == 0


def test_sentencepiece_memo_is_bounded(monkeypatch, hard_texts):
    path = public_tokenizers.path("piece_bpe_32k.model")
    monkeypatch.setattr(suffix_pieces, "WORD_LIMIT", 300)
    pieces = suffix_pieces.Pieces(open(path, "rb").read())
    library = sentencepiece.SentencePieceProcessor(model_file=path)
    for at in range(0, 600, 50):
        part = hard_texts[at : at + 50]
        assert pieces.encode(part)[0].tolist() == [i for t in part for i in library.encode(t)]


@pytest.mark.parametrize("length", [1, 3, 7, 64])
def test_chunk_maps_compose_wherever_words_are_cut(length):
    path = public_tokenizers.path("word_bpe_49k.json")
    counter = token_transducer.Counter(open(path, "rb").read())
    library = Tokenizer.from_file(path)
    library.no_truncation()
    rng = np.random.default_rng(length)
    parts = ["the", "ing", "tion", "a", " ", "\n", "Σ", "漢", "🙂", "'s", "12", ".", "é", "<|endoftext|>"]
    texts = ["", " ", "a" * 3000, "ab" * 900, "ha" * 700 + "n", "".join(rng.choice(list("aeinrst"), 2000))]
    texts += ["".join(rng.choice(parts, rng.integers(1, 200))) for _ in range(300)]
    lines, added = zip(*map(counter.words, texts), strict=True)
    symbols, sizes = [], []
    for data in lines:
        words = data.split(b"\n") if data else []
        laid = [b + 256 * (i == len(w) - 1) for w in words for i, b in enumerate(w)]
        symbols += laid
        sizes.append(len(laid))
    maps = token_transducer.ChunkMaps(
        counter.transducer, np.array(symbols, np.int64), np.array(sizes, np.int64), length
    )
    truth = [len(library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert (maps.composed() + np.array(added)).tolist() == truth
    # Maps hold several entries, and every state in which a chunk is left is an entry of the next.
    lanes = [np.concatenate(part).tolist() for part in zip(*maps.lanes, strict=True)]
    entries = set(zip(lanes[0], lanes[1], strict=True))
    assert len(entries) == len(lanes[0]) > len(maps.starts)
    assert all(maps.ends_text[c] or (c + 1, left) in entries for c, left in zip(lanes[0], lanes[2], strict=True))


# ---- toxicity


def test_a_score_is_over_every_window():
    rng = np.random.default_rng(1)
    p, projected = gru_model.new_parameters(), rng.standard_normal((50, 6 * gru_model.STATE)).astype(np.float32)
    sizes = np.array([0, 1, 30, gru_model.WINDOW - 1, gru_model.WINDOW, gru_model.WINDOW + 1, 0, 5000, 7])
    flat = rng.integers(0, 50, sizes.sum())
    got = gru_model.text_logits(p, projected, flat, sizes)
    for end, n, logit in zip(np.cumsum(sizes), sizes, got, strict=True):
        words, best = flat[end - n : end], -np.inf
        for first in range(max(1, n - gru_model.WINDOW + 1) if n else 0):
            index = words[first : first + gru_model.WINDOW][:, None]
            best = max(best, gru_model.window_logits(p, projected, index, np.ones(index.shape, np.float32))[0])
        assert logit == pytest.approx(best, abs=1e-4)


def test_words_in_front_flip_no_verdict():
    rng = np.random.default_rng(2)
    plain = [f"word{i}" for i in range(200)]
    texts, labels = [], []
    for i in range(300):
        words = [str(w) for w in rng.choice(plain, 60)]
        if i % 4 == 0:
            at = int(rng.integers(0, 56))
            words[at : at + 4] = ["you", "vile", "stupid", "fool"]
        texts.append(" ".join(words))
        labels.append(int(i % 4 == 0))
    model = toxicity.train(texts[:200], labels[:200])
    at = -model.shift + np.log(toxicity.THRESHOLD / (1 - toxicity.THRESHOLD))
    unseen = texts[200:]
    verdicts = gru_model.score_texts(model, unseen) >= at
    assert verdicts.tolist() == [bool(y) for y in labels[200:]]
    for n in range(1, 17):
        longer = [" ".join([*plain[:n], t]) for t in unseen]
        assert ((gru_model.score_texts(model, longer) >= at) == verdicts).all()


def test_training_hashes_a_word_once_and_learns_alike_side_by_side(monkeypatch):
    plain = [f"word{i}" for i in range(80)]
    texts = [" ".join([*plain[i : i + 20], *(["vile", "fool"] if i % 3 == 0 else [])]) for i in range(60)]
    labels = [int(i % 3 == 0) for i in range(60)]
    hashed, features = [], toxicity._features
    monkeypatch.setattr(toxicity, "_features", lambda word: hashed.append(word) or features(word))
    monkeypatch.setattr(toxicity, "STEPS", 5)
    model = toxicity.train(texts, labels)
    assert len(hashed) == len(set(hashed)) == len(set(" ".join(texts).split(" ")))
    monkeypatch.setattr(toxicity, "FITS_AT_ONCE", 1)
    alone = toxicity.train(texts, labels)
    assert not model.empty and model.shift == alone.shift
    assert all((model.parameters[k] == alone.parameters[k]).all() for k in model.parameters)


def test_training_sample_is_bounded_and_clashes_with_no_column(spark):
    rows = [(i, f"text {i} " + ("bad" if i % 4 == 0 else "good"), i, "x", 0) for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, toxic int, label_id string, id int")
    twice = docs.unionByName(docs.where("doc_id < 50")).unionByName(docs.where("doc_id = 8").withColumn("text", F.lit("x" * 99)))
    labels = spark.createDataFrame([(i, int(i % 4 == 0), 1) for i in range(0, 400)] + [(None, 1, 1)], "doc_id long, toxic int, quality int")
    sample = toxicity.training_sample(twice, labels, "doc_id", "text", most_toxic=20, most_other=30, most_chars=50)
    assert sorted(y for _, y in sample) == [0] * 30 + [1] * 20 and len(set(sample)) == 50
    for text, toxic in sample:
        i = int(text.split(" ")[1])
        assert zlib.crc32(str(i).encode()) % 3 != 1 and toxic == (i % 4 == 0)
    scored = toxicity.score_toxicity(docs, labels, most_toxic=20, most_other=30)
    assert scored.columns == [*docs.columns, "held_out", "score", "predicted"] and scored.count() == 300
    assert toxicity.drop_toxic(docs, labels, most_toxic=20, most_other=30).columns == docs.columns


def test_toxicity(spark, docs, no_docs):
    bad = ["idiot", "moron", "scum"]
    rows = []
    for i in range(600):
        words = prose(30 + i % 40, 1000 + i).split(" ")
        if i % 3 == 0:
            words[i % len(words)] = bad[i // 3 % 3]
        rows.append((i, " ".join(words), int(i % 3 == 0)))
    df = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    labels = df.select("doc_id", "toxic").unionByName(spark.createDataFrame([(None, 1), (5, None)], "doc_id long, toxic int"))
    scored = toxicity.score_toxicity(df.select("doc_id", "text"), labels).collect()
    truth = {i: y for i, _, y in rows}
    unseen = [r for r in scored if r["held_out"]]
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in scored)
    right = sum(r["predicted"] == truth[r["doc_id"]] for r in unseen)
    assert right >= 0.95 * len(unseen) and len(unseen) > 100
    assert all(0 <= r["score"] <= 1 for r in scored)
    # Without labels of both kinds every text scores 0, also the empty ones.
    none = toxicity.score_toxicity(docs, labels.where("false")).collect()
    assert len(none) == len(ROWS) and {r["score"] for r in none} == {0.0}
    assert toxicity.score_toxicity(no_docs, labels).count() == 0
    kept = toxicity.drop_toxic(docs, labels.where("false"))
    assert kept.columns == docs.columns and kept.count() == len(ROWS)
    assert {r["score"] for r in kept.collect()} == {0.5}  # the table's own column


def test_gradients_agree_with_differences():
    import numpy as np

    from varve.llm import gru_model as net

    p = {k: v.astype(np.float64) for k, v in net.new_parameters(1).items()}
    words = ["alpha", "beta", "gamma", "delta"]
    table = net.table_rows(words)
    rng = np.random.default_rng(2)
    for name in ("words", "grams"):
        p[name] = rng.standard_normal(p[name].shape) * 0.3
    index = rng.integers(0, 4, (5, 3))
    mask = np.ones((5, 3))
    mask[3:, 1] = 0
    labels = np.array([1.0, 0.0, 1.0])

    def loss():
        x = net.word_vectors(p, table)
        gates = np.concatenate([x @ p["Wf"] + p["bf"], x @ p["Wb"] + p["bb"]], 1)
        y = net.sigmoid(net.window_logits(p, gates, index, mask))
        return -np.mean(np.where(labels > 0, np.log(y), np.log(1 - y)))

    dense, _ = net.gradients(p, table, index, mask, labels)
    for name in ("Wf", "Ub", "A", "v", "o", "bb"):
        at = tuple(0 for _ in p[name].shape)
        before = p[name][at]
        p[name][at] = before + 1e-4
        up = loss()
        p[name][at] = before - 1e-4
        down = loss()
        p[name][at] = before
        assert abs((up - down) / 2e-4 - dense[name][at]) < 1e-4, name


def test_word_hashes_tell_patterns_apart():
    """Words of repeating patterns, which cancel in hashes modulo 2**64, have different hashes."""
    def morse(n):
        bits = "".join("ab"[bin(i).count("1") % 2] for i in range(n))
        return bits, bits.translate(str.maketrans("ab", "ba"))

    words = [w for n in (1, 2, 63, 64, 65, 1024, 4096) for w in (*morse(n), "a" * n)]
    words = list(dict.fromkeys(words)) + ["ab" * 300, "ba" * 300, "É", "é"]
    texts = [" ".join(words), words[-5], "", "\t" + words[3].upper()]
    data = [t.encode() for t in texts]
    starts = np.cumsum([0, *map(len, data)])
    hashes, counts = part_enum.word_hashes(np.frombuffer(b"".join(data), np.uint8), starts)
    assert counts.tolist() == [len(words), 1, 0, 1]
    assert len(set(hashes[: len(words)].tolist())) == len(words)
    assert hashes[len(words)] == hashes[len(words) - 5] and hashes[-1] == hashes[3]


# ---- pages and URLs

PAGE = """<!DOCTYPE html><html><head><title>T</title><style>p{}</style></head><body>
<nav><ul><li><a href="/a">Home, page.</a></li></ul></nav><div class="cookie-notice"><p>We use cookies, yes.</p></div>
<div id="content"><h1>A heading</h1><p>First para&shy;graph, with <b>bold</b> words &amp; more.<p>Second one, quite
   long; and so on.<br>Next line.<script>var t="</p>";</script><form><input name="q">Search, please.</form>
<div class="comments"><p>I think, therefore I write. Really, I do.</p></div></div>
<aside><p>Related, things.</p></aside><footer>&copy; 2024, all rights.</footer></body></html>"""


def test_main_text(spark):
    want = "A heading First para\xadgraph, with bold words & more. Second one, quite long; and so on. Next line."
    cases = {
        1: (PAGE, want),
        2: (None, ""),
        3: ("", ""),
        4: ("just text, no tags", "just text, no tags"),
        5: ("<p>a &lt;b&gt; <i>c</i>d<p>e", "a <b> cd e"),
        6: ("<script>never ends <p>x</p>", ""),
        7: ("<p title=\"never ends>x</p> and, more", "x and, more"),
        8: ("<!-- open <p>x</p>", ""),
        9: ("1 < 2, and 3 > 2.", "1 < 2, and 3 > 2."),
    }
    rows = [(i, f"http://x/{i}", page, "z") for i, (page, _) in cases.items()] + [(None, None, PAGE, "z")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string, text string")
    got = {r["page_id"]: r for r in tag_paths.extract_main_text(df).collect()}
    for i, (_, text) in cases.items():
        assert got[i]["text"] == text and got[i]["n_chars"] == len(text) and got[i]["url"] == f"http://x/{i}"
    assert got[None]["text"] == want
    assert tag_paths.extract_main_text(df.where("false")).count() == 0


def test_whole_articles():
    """Unequal sections, lists, quotes, code and formulas lose none of an article's text."""
    long_ = "A long sentence, with a comma; and more of it. " * 40
    article = f"<h1>Title</h1><p>Intro, short.</p><section><p>{long_}</p></section><section><p>Rest.</p></section>"
    cases = [
        f"<article>{article}</article>",
        f"<main><div>{article}</div><p>End.</p></main>",
        f"<article><h1>Title</h1><ul><li>One.</li><li>{long_}</li></ul><p>Rest.</p></article>",
        f"<div><h1>Title</h1><ul><li>One.</li><li>{long_}</li></ul><p>Rest.</p></div>",
        f"<div><h1>Title</h1><p>Intro.</p><blockquote><p>{long_}</p></blockquote><p>Rest.</p></div>",
        f"<div><h1>Title</h1><pre>{long_}</pre><p>Rest.</p></div>",
        f"<div><h1>Title</h1><dl><dt>Term</dt><dd>{long_}</dd></dl><p>Rest.</p></div>",
        f"<div>{article}</div>",
        f"<article><h1>Title</h1><p>As <math><mi>x</mi><mo>=</mo><mn>2</mn></math>, so.</p><p>{long_}</p></article>",
    ]
    for body in cases:
        page = f"<html><body><nav><a>Home</a></nav>{body}<footer>Rights, all.</footer></body></html>"
        # Blocks part words; a formula stands inside its sentence.
        plain = re.sub("<[^>]*>", " ", re.sub("</?(?:math|m[ion])>", "", body))
        assert tag_paths.main_text(page) == " ".join(plain.split())


ARTICLE = "<h1>Title of it</h1>" + "".join(
    f"<p>A long sentence number {i}, with a comma; and more of it. It goes on, and ends.</p>" for i in range(12)
)
ARTICLE_TEXT = " ".join(re.sub("<[^>]*>", " ", ARTICLE).split())


@pytest.mark.parametrize(
    "opened",
    [
        '<div class="site has-sidebar">',
        '<div id="page" class="no-comments">',
        '<div class="content with-share-buttons">',
        '<form id="aspnetForm">',
        '<div class="sidebar-right">',
        '<div data-role="header" class="page">',
    ],
)
@pytest.mark.parametrize("inner", ["article", "div"])
def test_wrappers_are_no_side_matter(opened, inner):
    closed = f"</{opened[1:].split()[0]}>"
    side = '<aside><p>Elsewhere, other things happen. Read on, please.</p></aside><div class="site-footer">All, rights.</div>'
    page = f"<body>{opened}<nav><a>Home</a></nav><{inner}>{ARTICLE}</{inner}>{side}{closed}</body>"
    assert tag_paths.main_text(page) == ARTICLE_TEXT


def test_comments_without_a_known_class():
    said = "I read this, and I disagree. It was, frankly, long; but I liked it, mostly."
    items = "".join(f'<div class="entry"><a class="user-name">Jo {i}</a><p>{said * 3}</p></div>' for i in range(15))
    headed = f"<h3>3 Comments</h3><div><p>{said}</p></div><div><p>{said}</p></div>"
    nested = "".join(f'<article><span class="author">Jo</span><p>{said}</p></article>' for _ in range(3))
    for after in (f'<div class="thread">{items}</div>', items, headed, f"<section>{headed}</section>", nested):
        for page in (
            f"<body><article>{ARTICLE}{after}</article></body>",
            f"<body><main><article>{ARTICLE}</article>{after}</main></body>",
            f"<body><div>{ARTICLE}{after}</div></body>",
            f'<body><div>{ARTICLE}</div><div class="x">{after}</div></body>',
        ):
            assert tag_paths.main_text(page) == ARTICLE_TEXT
    hidden = '<div class="comment-list"><article><p>' + said * 40 + "</p></article></div>"
    assert tag_paths.main_text(f"<body><div>{ARTICLE}</div>{hidden}</body>") == ARTICLE_TEXT


def test_pages_without_an_article_and_with_a_title_before_it():
    links = "".join(f'<li><a href="/{i}">Another story, number {i}</a></li>' for i in range(8))
    page = f"<body><div><ul>{links}</ul>{ARTICLE}<ul><li>Point one</li><li>See <a>this</a> point, too</li></ul></div></body>"
    assert tag_paths.main_text(page) == ARTICLE_TEXT + " Point one See this point, too"
    body = ARTICLE.replace("<h1>Title of it</h1>", "")
    page = f"<main><div>Kicker</div><h1>Title of it</h1><article>{body}</article><p>Next, please.</p></main>"
    assert tag_paths.main_text(page) == ARTICLE_TEXT
    for empty in ("<nav><a>Home, page.</a></nav>", '<div class="cookie-notice"><p>We use cookies, yes.</p></div>', "<form>Search, please.</form>"):
        assert tag_paths.main_text(f"<body>{empty}</body>") == ""


def test_very_deep_pages_cost_no_more_than_long_ones():
    import time
    import tracemalloc

    for page in ("<div>" * 100_000 + "So, it ends.", "<div><b>x, y.</b>" * 20_000 + "</div>" * 20_000, "<div>" * 50_000 + "</p></li>" * 50_000):
        tracemalloc.start()
        tag_paths.main_text(page)
        peak = tracemalloc.get_traced_memory()[1]
        tracemalloc.stop()
        assert peak < 100 << 20
        start = time.process_time()
        tag_paths.main_text(page)
        assert time.process_time() - start < 4


RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]


def test_url_verdicts(spark):
    cases = {
        "HTTP://A.Example.NET/en/1?x#y": ("a.example.net", "/en/1", "example.net/en/", "allow"),
        "http://a.net": ("a.net", "", None, "allow"),
        "http://a.net/x": ("a.net", "/x", "net/", "block"),
        "http://notexample.com/de/": ("notexample.com", "/de/", None, "allow"),
        "http://example.com/de/1#/en": ("example.com", "/de/1", "example.com/de/", "block"),
        "http://org/fr/": ("org", "/fr/", "org/fr/", "allow"),
        "no scheme": ("", "", None, "allow"),
        None: ("", "", None, "allow"),
        "": ("", "", None, "allow"),
        "a://b://c/d?e/f": ("b:", "//c/d", None, "allow"),
    }
    rows = [(i, u, "x") for i, u in enumerate(cases)] + [(100 + i, f"http://spam{i % 2}.farm.biz/p/{i}", "x") for i in range(200)]
    rows += [(1000 + i, f"http://fine{i % 7}.biz/p/{i}", "x") for i in range(200)]
    pages = spark.createDataFrame(rows, "page_id long, url string, rule string")
    labels = spark.createDataFrame(
        [(100 + i, 0, 0) for i in range(150)] + [(1000 + i, 1, 0) for i in range(150)] + [(None, None, None)],
        "doc_id long, quality int, toxic int",
    )
    got = {r["page_id"]: tuple(r)[1:] for r in url_rules.judge_urls(pages, labels, RULES).collect()}
    assert len(got) == len(rows)
    for i, want in enumerate(cases.values()):
        assert got[i] == want
    assert {got[100 + i][3] for i in range(200)} == {"block"}
    assert {got[1000 + i][3] for i in range(200)} == {"allow"}
    nothing = url_rules.judge_urls(pages, labels.where("false"), RULES)
    assert Counter(r["verdict"] for r in nothing.collect())["block"] == 2
    assert url_rules.judge_urls(pages.where("false"), labels, RULES).count() == 0


def test_url_rules_at_any_size_and_in_the_whole_url(spark):
    """A bad host is blocked in a small and a large table; so are bad queries and fragments."""
    rows = [(i, f"http://spam.farm.biz/p/{i}") for i in range(30)]
    rows += [(100 + i, f"http://a{i % 7}.org/{i}?id={i}&utm_source=feed") for i in range(40)]
    rows += [(200 + i, f"http://a{i % 7}.org/{i}#go/offer") for i in range(40)]
    rows += [(300 + i, f"http://a{i % 7}.org/{i}") for i in range(500)]
    few = spark.createDataFrame(rows, "page_id long, url string")
    more = spark.range(1000, 81_000).selectExpr("id AS page_id", "concat('http://b', id % 97, '.org/', id) AS url")
    for pages in (few, few.unionByName(more)):
        labels = pages.selectExpr("page_id AS doc_id", "int(page_id >= 300) AS quality", "0 AS toxic")
        got = url_rules.judge_urls(pages, labels, []).where("page_id < 1000").collect()
        assert len(got) == len(rows)
        assert all((r["verdict"] == "block") == (r["page_id"] < 300) for r in got)


def rules_by_hand(rows, support, confidence):
    """All token sets with enough bad rows and a large enough bad share."""
    seen = Counter()
    bad = Counter()
    for tokens, is_bad in rows:
        for size in range(1, len(tokens) + 1):
            for some in itertools.combinations(sorted(tokens), size):
                seen[some] += 1
                bad[some] += is_bad
    return [set(k) for k, n in seen.items() if bad[k] >= support and bad[k] / n >= confidence]


def test_mined_rules_against_all_token_sets(spark):
    rows = []
    for i in range(240):
        host = ("www.a.com", "b.a.com", "www.c.org", "x-a.net", "d.net")[i % 5]
        path = ("/p/q", "/p", "/r/q", "", "/q/s:")[i // 5 % 5]
        tail = ("?k=1", "?k=2#f", "", "?m=1&k=1")[i // 7 % 4]
        bad = ("a.com" in host and "/q" in path) or ("k=1" in tail and "/r" in path) or i % 11 == 0
        rows.append((i, f"http://{host}{path}{tail}", bad if i % 13 else None))
    host, path = url_rules.host_and_path(F.col("url"))
    tokens = url_rules.url_tokens(host, path, url_rules.url_tail(F.col("url"))).alias("tokens")
    df = spark.createDataFrame(rows, "id long, url string, bad boolean").select("id", tokens, "bad")
    taken = df.collect()
    assert "path:s:" in taken[20]["tokens"]
    for support, confidence in ((5, 0.6), (3, 0.45)):
        wanted = rules_by_hand([(r["tokens"], r["bad"]) for r in taken if r["bad"] is not None], support, confidence)
        mined = url_rules.mine_rules(df.select("tokens", "bad"), support, confidence)
        rules = [set(r["rule"]) for r in mined.collect()]
        assert rules and all(r in wanted for r in rules)
        assert not any(a < b for a in rules for b in rules)
        fits = {r["id"] for r in url_rules.match_rules(df, mined, "id").collect()}
        assert fits == {r["id"] for r in taken if any(w <= set(r["tokens"]) for w in wanted)}
        assert any(len(r) > 1 for r in rules)


# ---- shards


def test_shards_by_hand(spark, docs, no_docs):
    got = ring.shard_rows(docs, shards=4).collect()
    assert sorted(Counter(r["shard"] for r in got).values()) == [5, 5, 5, 5]
    for shard in range(4):
        assert sorted(r["slot"] for r in got if r["shard"] == shard) == list(range(5))
    want = [(i, len((t or "").encode()) + 1, zlib.crc32((t or "").encode())) for i, t in ROWS]
    assert key((r["doc_id"], r["size"], r["text_crc32"]) for r in got) == key(want)
    assert ring.shard_rows(no_docs).count() == 0


def test_shards_follow_the_ring(spark):
    rows = [(i, f"text {i}") for i in range(1003)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    points = ring.ring_points(8)
    placed = df.select("doc_id", F.shiftrightunsigned(F.xxhash64("doc_id", "text"), 16).alias("at")).collect()
    arcs = defaultdict(list)
    for i, at in placed:
        arc = next((k for k, (p, _) in enumerate(points) if p >= at), 0)
        arcs[arc].append((at, i))
    room = [1003 // 8 + (s < 1003 % 8) for s in range(8)]
    waiting, home = [(a, sorted(arcs[a])) for a in sorted(arcs)], {}
    for hop in range(len(points) + 1):
        still = []
        for arc, keys in waiting:
            shard = points[(arc + hop) % len(points)][1]
            home |= {i: shard for _, i in keys[: room[shard]]}
            rest = keys[room[shard] :]
            room[shard] -= len(keys) - len(rest)
            still += [(arc, rest)] if rest else []
        waiting = still
    got = {r["doc_id"]: r["shard"] for r in ring.shard_rows(df).collect()}
    assert got == home
    moved = sum(points[next((k for k, (p, _) in enumerate(points) if p >= at), 0)][1] != home[i] for i, at in placed)
    assert moved < 300
