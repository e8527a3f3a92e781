"""Benchmark passages in documents, found through a positional inverted index.

The index holds one posting (term, document, position) for every document word that occurs in any
test text. Counting the postings gives each term's frequency. Every window of a test text is then
represented by its two rarest terms only: their posting lists, shifted by the terms' offsets, are
intersected. The few alignments left are checked in full against the postings of all their terms.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from varve.llm.common import ascii_lower, sized_broadcast, stored

WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
WORD_ANY_CASE = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
WINDOW = 10
SLOP = 3
BROADCAST_LIMIT = 64 << 20


def words(text: Column) -> Column:
    return F.regexp_extract_all(ascii_lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))


def postings(docs: DataFrame, vocabulary: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(term, id, text_hash, pos) of every word of ``docs`` that is in ``vocabulary`` (term)."""
    size = vocabulary.agg(F.sum(F.octet_length("term") + 64)).first()[0]
    located = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.posexplode(words(F.col(text_col))).alias("pos", "term"),
    )
    known = sized_broadcast(vocabulary, size, BROADCAST_LIMIT)
    return located.join(known, "term", "left_semi")


def _located_items(items: DataFrame, item_col: str, text_col: str) -> DataFrame:
    """(item, passage, n, off, term): the words of every distinct item with a name and words."""
    found = items.where(F.col(item_col).isNotNull()).select(
        F.col(item_col).cast("string").alias("item"), words(F.col(text_col)).alias("words")
    )
    found = found.where(F.size("words") > 0).distinct()
    return found.select(
        "item",
        F.xxhash64("item", "words").alias("passage"),
        F.size("words").alias("n"),
        F.posexplode("words").alias("off", "term"),
    )


def _anchors(terms: DataFrame, frequencies: DataFrame, window: int) -> DataFrame:
    """(passage, term, off): the two rarest words of every window whose words all occur."""
    starts = F.sequence(
        F.greatest(F.lit(0), F.col("off") - window + 1),
        F.least(F.col("off"), F.greatest(F.lit(0), F.col("n") - window)),
    )
    ranked = (
        terms.join(frequencies, "term", "left")
        .select("passage", "term", "off", F.coalesce("freq", F.lit(0)).alias("freq"), starts.alias("s"))
        .withColumn("start", F.explode("s"))
        .groupBy("passage", "start")
        .agg(F.sort_array(F.collect_list(F.struct("freq", "off", "term"))).alias("by_freq"))
        .where("by_freq[0].freq > 0")
    )
    rarest = ranked.select("passage", F.inline(F.slice("by_freq", 1, 2)))
    return rarest.select("passage", "term", "off").distinct()


def find_passages(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slop: int = SLOP,
) -> tuple[DataFrame, DataFrame]:
    """Exact and near occurrences of the items in the documents.

    First result: (id, text_hash, item, delta, n, starts), one row per place where an item, laid
    so that its word 0 is at document word ``delta``, matches in at least one whole window;
    ``starts`` are the item offsets at which matching windows begin. An item shorter than
    ``window`` is one window. Second result: (id, text_hash, item), the pairs in which two of the
    rarest words of the item's windows are up to ``slop`` words off their places.

    NULL texts have no words; items without a name or words are left out; repeated items and
    documents count once. Documents are told apart by id and text, so a repeated id is no trouble.
    """
    terms = stored(_located_items(items, item_col, item_text_col), "item-terms")
    vocabulary = terms.select("term").distinct()
    index = stored(postings(docs, vocabulary, id_col, text_col), "postings")
    frequencies = index.groupBy("term").agg(F.count(F.lit(1)).alias("freq"))
    anchors = stored(_anchors(terms, frequencies, window), "anchors")
    size = anchors.agg(F.sum(F.octet_length("term") + 64)).first()[0]
    anchors = sized_broadcast(anchors, size, BROADCAST_LIMIT)

    per_passage = ["id", "text_hash", "passage"]
    laid = (
        index.join(anchors, "term")
        .select(*per_passage, (F.col("pos") - F.col("off")).alias("delta"), "off")
        .groupBy(*per_passage)
        .agg(F.sort_array(F.collect_set(F.struct("delta", "off"))).alias("laid"))
    )
    laid = stored(laid, "laid")
    passages = terms.select("passage", "item", "n").distinct()
    pair_next = F.transform(
        F.col("laid"),
        lambda x, i: F.struct(
            x["delta"].alias("delta"),
            (F.get(F.col("laid"), i + 1)["delta"] - x["delta"]).alias("gap"),
            (F.get(F.col("laid"), i + 1)["off"] != x["off"]).alias("other"),
        ),
    )
    twice = F.filter(pair_next, lambda x: (x["gap"] == 0) | (F.col("n") == 1))
    candidates = (
        laid.join(passages, "passage")
        .select(*per_passage, "item", "n", F.explode(F.array_distinct(twice["delta"])).alias("delta"))
    )
    candidates = stored(candidates, "candidates")

    # Only documents with a candidate are read from the index again.
    with_candidate = candidates.select("id", "text_hash").distinct()
    few = sized_broadcast(with_candidate, with_candidate.count() * 80, BROADCAST_LIMIT)
    needed = candidates.join(terms.select("passage", "off", "term"), "passage").select(
        *per_passage, "item", "n", "delta", "off", "term", (F.col("delta") + F.col("off")).alias("pos")
    )
    on_doc = _same_document("i", "c")
    there = index.alias("i").join(few.alias("c"), on_doc, "left_semi").alias("i")
    matched = (
        needed.alias("c")
        .join(there, on_doc & (F.col("i.pos") == F.col("c.pos")) & (F.col("i.term") == F.col("c.term")))
        .select(*[F.col(f"c.{c}") for c in (*per_passage, "item", "n", "delta", "off")])
        .groupBy(*per_passage, "item", "n", "delta")
        .agg(F.sort_array(F.collect_set("off")).alias("offs"))
    )
    span = F.least(F.col("n"), F.lit(window))
    starts = F.filter(
        F.col("offs"), lambda x, i: F.get(F.col("offs"), i + span - 1) == x + span - 1
    )
    exact = matched.select("id", "text_hash", "item", "n", "delta", starts.alias("starts"))
    near = laid.where(
        F.exists(pair_next, lambda x: (x["gap"] > 0) & (x["gap"] <= slop) & x["other"])
    )
    near = near.join(passages, "passage").select("id", "text_hash", "item")
    return stored(exact.where(F.size("starts") > 0), "exact"), near


def _same_document(a: str, b: str) -> Column:
    return F.col(f"{a}.id").eqNullSafe(F.col(f"{b}.id")) & (
        F.col(f"{a}.text_hash") == F.col(f"{b}.text_hash")
    )


def contamination(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    slop: int = SLOP,
) -> DataFrame:
    """One row per row of ``docs``: id, ``n_words``, ``n_hit`` (words inside any matching window),
    ``n_items`` and ``items_sha256`` (items with matching windows), ``contaminated``, ``n_near``
    (items of which only near matches exist).

    The cases of :func:`find_passages` hold; a document without words has zeros and the hash of
    the empty list. An empty table of documents gives no rows, an empty table of items no hits.
    """
    exact, near = find_passages(
        docs, items, id_col, text_col, item_col, item_text_col, window, slop
    )
    span = F.least(F.col("n"), F.lit(window))
    offs = F.array_distinct(
        F.flatten(F.transform("starts", lambda s: F.sequence(s, s + span - 1)))
    )
    places = exact.select("id", "text_hash", F.explode(offs).alias("off"), "delta")
    covered = (
        places.select("id", "text_hash", (F.col("delta") + F.col("off")).alias("pos"))
        .distinct()
        .groupBy("id", "text_hash")
        .agg(F.count(F.lit(1)).alias("n_hit"))
    )
    found = exact.select("id", "text_hash", "item", F.lit(True).alias("exact"))
    nearly = near.select("id", "text_hash", "item", F.lit(False).alias("exact"))
    by_item = found.unionByName(nearly).groupBy("id", "text_hash", "item").agg(
        F.max("exact").alias("exact")
    )
    listed = by_item.groupBy("id", "text_hash").agg(
        F.sort_array(F.collect_list(F.when(F.col("exact"), F.col("item")))).alias("items"),
        F.count_if(~F.col("exact")).alias("n_near"),
    )
    hits = listed.alias("l").join(covered.alias("c"), _same_document("l", "c"), "left").select(
        F.col("l.id").alias("id"),
        F.col("l.text_hash").alias("text_hash"),
        "items",
        "n_near",
        "n_hit",
    )
    text = F.coalesce(F.col(text_col), F.lit(""))
    counted = docs.select(
        F.col(id_col).alias("id"),
        F.xxhash64(F.col(text_col)).alias("text_hash"),
        F.regexp_count(text, F.lit(WORD_ANY_CASE)).cast("long").alias("n_words"),
    )
    items_ = F.coalesce("items", F.array().cast("array<string>"))
    return (
        counted.alias("d")
        .join(hits.alias("h"), _same_document("d", "h"), "left")
        .select(
            F.col("d.id").alias(id_col),
            "n_words",
            F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
            F.size(items_).cast("long").alias("n_items"),
            F.sha2(F.concat_ws(",", items_), 256).alias("items_sha256"),
            (F.coalesce("n_hit", F.lit(0)) > 0).alias("contaminated"),
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        )
    )


def drop_contaminated(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
) -> DataFrame:
    """The rows of ``docs`` in which no window of any item occurs, with all their columns."""
    exact, _ = find_passages(docs, items, id_col, text_col, item_col, item_text_col, window)
    bad = exact.select("id", "text_hash").distinct()
    bad = sized_broadcast(bad, bad.count() * 80, BROADCAST_LIMIT)
    same = F.col(f"d.{id_col}").eqNullSafe(F.col("x.id")) & (
        F.xxhash64(F.col(f"d.{text_col}")) == F.col("x.text_hash")
    )
    return docs.alias("d").join(bad.alias("x"), same, "left_anti")
