"""URL verdicts from fixed rules and from association rules mined with FP-growth.

Fixed rules name a host and a path prefix; the longest that fits decides. Every other URL is
judged by rules "these tokens, hence a bad label" that Spark's FP-growth mines from labelled URLs
and that pass a support, a number of rows whatever the table's size, and a confidence. They are
matched by an inverted index: a rule is filed under its rarest token, URLs are joined to it by
token, and the rest of its tokens is checked.

Tokens of one URL imply each other: a domain its parents and its labels, a parameter with its value
the parameter. A rule with an implied token fits the same URLs as the rule without it, and would
double the sets to mine. So a labelled URL is mined once per domain token and once without, each
time without the tokens that the domain implies, and sets of the different turns are kept apart.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from varve.llm.common import ascii_lower, shuffle_partitions, sized_broadcast, stored

MIN_SUPPORT_ROWS = 20
MIN_CONFIDENCE = 0.6
BAD = "label:bad"
BROADCAST_LIMIT = 64 << 20


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z in lower case) and path of a URL; both empty for NULL or without ``://``."""
    rest = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://(.*)$", 1)
    host = ascii_lower(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1))
    path = F.regexp_extract(rest, r"(?s)^[^/?#]*(/[^?#]*)", 1)
    return host, path


def url_tail(url: Column) -> Column:
    """Query and fragment of a URL with their ``?`` and ``#``; empty without ``://``."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^?#]*(.*)$", 1)


def url_tokens(host: Column, path: Column, tail: Column) -> Column:
    """Distinct tokens: the host's labels, its parent domains, the path's parts, the query's
    parameters (names, and names with their values), and the fragment's parts."""
    labels = F.split(host, r"[.\-]")
    names = F.split(host, r"\.")
    parents = F.transform(
        F.sequence(F.lit(1), F.size(names)),
        lambda i: F.concat(F.lit("domain:"), F.array_join(F.slice(names, i, F.size(names)), ".")),
    )
    parts = F.split(ascii_lower(path), r"[/\-_.]+")
    asked = F.regexp_extract(ascii_lower(tail), r"(?s)^\?([^#]*)", 1)
    parameters = F.filter(F.split(asked, r"[&;]"), lambda x: x != "")
    fragment = F.split(F.regexp_extract(ascii_lower(tail), r"(?s)#(.*)$", 1), r"[#/\-_.&=!]+")
    tagged = F.concat(
        F.transform(labels, lambda x: F.concat(F.lit("host:"), x)),
        parents,
        F.transform(F.filter(parts, lambda x: x != ""), lambda x: F.concat(F.lit("path:"), x)),
        F.transform(parameters, lambda x: F.concat(F.lit("query:"), x)),
        F.transform(parameters, lambda x: F.concat(F.lit("parameter:"), F.substring_index(x, "=", 1))),
        F.transform(F.filter(fragment, lambda x: x != ""), lambda x: F.concat(F.lit("fragment:"), x)),
    )
    return F.array_distinct(F.filter(tagged, lambda x: ~F.rlike(x, F.lit(r"^[a-z]+:$"))))


def _wider(token: Column) -> Column:
    """The next wider token that ``token`` implies: the parent domain, the pair's parameter."""
    domain = F.regexp_extract(token, r"(?s)^domain:[^.]*\.(.+)$", 1)
    pair = F.regexp_extract(token, r"(?s)^query:([^=]*)", 1)
    return F.when(domain != "", F.concat(F.lit("domain:"), domain)).when(
        pair != "", F.concat(F.lit("parameter:"), pair)
    )


def _turns(tokens: Column, bad: Column) -> Column:
    """The baskets of one row: one for each of its domain tokens and one without. All items but
    the domain carry the number of its labels, or 0, so that turns do not count together."""
    is_domain = lambda x: F.startswith(x, F.lit("domain:"))
    domains = F.concat(F.filter(tokens, is_domain), F.array(F.lit("")))
    others = F.filter(tokens, lambda x: ~is_domain(x))

    def basket(domain: Column) -> Column:
        name = F.substring_index(domain, ":", -1)
        level = F.when(domain == "", F.lit("0 ")).otherwise(
            F.concat((F.size(F.split(name, r"\."))).cast("string"), F.lit(" "))
        )
        labels = F.transform(F.split(name, r"[.\-]"), lambda x: F.concat(F.lit("host:"), x))
        left = F.when(domain == "", others).otherwise(F.array_except(others, labels))
        return F.concat(
            F.filter(F.array(domain), lambda x: x != ""),
            F.transform(left, lambda x: F.concat(level, x)),
            F.filter(F.array(F.when(bad, F.concat(level, F.lit(BAD)))), lambda x: x.isNotNull()),
        )

    return F.transform(domains, basket)


def mine_rules(
    labelled: DataFrame,
    min_support_rows: int = MIN_SUPPORT_ROWS,
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """(rule, confidence): token sets that imply a bad label, from (tokens, bad) rows.

    A rule needs ``min_support_rows`` bad rows. Only rules are listed without which fewer URLs
    would be judged bad: one that contains a shorter rule fits no URL that the shorter does not,
    and one with a token whose wider token has the same rows none that the wider one's does not.
    So a token that is a rule alone is in no longer one and is not mined further, nor is a token
    as frequent as its wider one. Rows without tokens or with a NULL label do not count; without
    rows there are no rules. Tokens with a repeated place in a row count once.
    """
    rows = labelled.where("bad IS NOT NULL AND size(tokens) > 0")
    rows = stored(rows.select(F.monotonically_increasing_id().alias("row"), F.array_distinct("tokens").alias("tokens"), "bad"), "labelled-urls")
    tokens = rows.select("row", "bad", F.explode("tokens").alias("t"))
    # A token in fewer bad rows than a rule needs is in no rule.
    counts = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("n"), F.count_if("bad").alias("n_bad"))
    counts = stored(counts.where(F.col("n_bad") >= min_support_rows), "token-counts")
    confidence = F.col("n_bad") / F.col("n")
    wider = counts.select(F.col("t").alias("w"), F.col("n").alias("n_w"), F.col("n_bad").alias("bad_w"))
    same = (F.col("w") == _wider(F.col("t"))) & (F.col("n") == F.col("n_w")) & (F.col("n_bad") == F.col("bad_w"))
    kept = counts.join(wider, same, "left_anti")
    alone = kept.where(confidence >= min_confidence).select(F.array("t").alias("rule"), confidence.alias("confidence"))
    useful = stored(kept.where(confidence < min_confidence).select("t"), "useful-tokens")
    size = useful.agg(F.sum(F.octet_length("t") + 64)).first()[0]
    left = tokens.join(sized_broadcast(useful, size, BROADCAST_LIMIT), "t").groupBy("row")
    left = left.agg(F.collect_list("t").alias("tokens"), F.first("bad").alias("bad"))
    baskets = left.select(F.explode(_turns(F.col("tokens"), F.col("bad"))).alias("items"))
    baskets = stored(baskets.where(F.size("items") > 0), "baskets")
    n = baskets.count()
    spark = labelled.sparkSession
    if n == 0:
        return stored(alone, "rules")
    support = (min_support_rows - 0.5) / n  # Spark rounds up to rows
    growth = FPGrowth(itemsCol="items", minSupport=support, minConfidence=min_confidence)
    model = growth.setNumPartitions(shuffle_partitions(spark)).fit(baskets)  # stored, they may be one file
    implied = model.associationRules.where(F.endswith(F.col("consequent")[0], F.lit(" " + BAD)))
    # A turn's sets without its domain count only some rows; the turn without domains has them all.
    whole = F.startswith(F.col("consequent")[0], F.lit("0 ")) | F.exists(
        "antecedent", lambda x: F.startswith(x, F.lit("domain:"))
    )
    bare = F.transform("antecedent", lambda x: F.regexp_replace(x, r"^\d+ ", ""))
    found = implied.where(whole).select(F.array_sort(bare).alias("rule"), "confidence")
    found = stored(found, "rules-with-longer")
    # A shorter rule is found through its own tokens, so only rules that share one are compared.
    short = found.select(F.col("rule").alias("short"), F.col("rule")[0].alias("t"))
    long_ = found.select("rule", F.explode("rule").alias("t"))
    covered = long_.join(short, "t").where(
        (F.size("short") < F.size("rule")) & (F.size(F.array_except("short", "rule")) == 0)
    )
    least = found.join(covered.select("rule").distinct(), "rule", "left_anti")
    return stored(alone.unionByName(least), "rules")


def match_rules(urls: DataFrame, rules: DataFrame, key: str) -> DataFrame:
    """(key): the keys of ``urls`` (key, tokens) that some rule fits, by an inverted index."""
    tokens = rules.select("rule", F.explode("rule").alias("t"))
    counts = tokens.groupBy("t").agg(F.count(F.lit(1)).alias("n"))
    filed = (
        tokens.join(counts, "t")
        .groupBy("rule")
        .agg(F.min(F.struct("n", "t"))["t"].alias("t"))
    )
    filed = stored(filed, "filed-rules")
    size = filed.agg(F.sum(F.octet_length(F.array_join("rule", ",")) + 128)).first()[0]
    index = sized_broadcast(filed, size, BROADCAST_LIMIT)
    postings = urls.select(key, "tokens", F.explode("tokens").alias("t"))
    fits = postings.join(index, "t").where(F.size(F.array_except("rule", "tokens")) == 0)
    return fits.select(key).distinct()


def fixed_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest of ``rules`` (verdict, host, path) that fits; else NULL."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for decides, rule_host, rule_path in sorted(rules, key=lambda r: len(r[1] + r[2])):
        inside = (host == rule_host) | F.endswith(host, F.lit("." + rule_host))
        fits = inside & F.startswith(path, F.lit(rule_path))
        name = F.when(fits, F.lit(rule_host + rule_path)).otherwise(name)
        verdict = F.when(fits, F.lit(decides)).otherwise(verdict)
    return name, verdict


def judge_urls(
    pages: DataFrame,
    labels: DataFrame,
    rules: list[tuple[str, str, str]],
    id_col: str = "page_id",
    url_col: str = "url",
    label_id_col: str = "doc_id",
    min_confidence: float = MIN_CONFIDENCE,
) -> DataFrame:
    """One row per row of ``pages``: id, ``host``, ``path``, ``rule``, ``verdict``.

    ``labels`` (id, quality, toxic) marks a page as bad if it is toxic or of low quality; a page
    whose labels disagree is bad. URLs without a host have no tokens and are allowed, as is every
    URL that no rule fits. Repeated rows are judged alike; a page without an id has no label but
    is judged. Empty tables give no rules or no rows.
    """
    host, path = host_and_path(F.col(url_col))
    tail = url_tail(F.col(url_col)).alias("tail")
    urls = pages.select(F.col(id_col).alias("page"), host.alias("host"), path.alias("path"), tail)
    bad = labels.select(
        F.col(label_id_col).alias("page"),
        ((F.col("toxic") == 1) | (F.col("quality") == 0)).alias("bad"),
    )
    bad = bad.groupBy("page").agg(F.max("bad").alias("bad"))
    tokens = url_tokens(F.col("host"), F.col("path"), F.col("tail")).alias("tokens")
    labelled = urls.select("page", tokens).join(bad, "page").select("tokens", "bad")
    mined = mine_rules(labelled, min_confidence=min_confidence)

    distinct = urls.groupBy("host", "path", "tail").agg(F.count(F.lit(1)).alias("n")).drop("n")
    name = F.concat_ws("\0", "host", "path", "tail").alias("name")
    blocked = match_rules(distinct.select(name, tokens), mined, "name").withColumn("hit", F.lit(True))
    rule, verdict = fixed_rule(F.col("host"), F.col("path"), rules)
    return (
        urls.withColumn("name", name)
        .join(blocked, "name", "left")
        .select(
            F.col("page").alias(id_col),
            "host",
            "path",
            rule.alias("rule"),
            F.coalesce(
                verdict, F.when(F.col("hit"), F.lit("block")), F.lit("allow")
            ).alias("verdict"),
        )
    )
