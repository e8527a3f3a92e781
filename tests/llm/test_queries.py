"""The registered queries on the smallest test tables, against their SQL or brute force."""

import re
import zlib

import duckdb
import public_tokenizers
import pytest
import sentencepiece
from tokenizers import Tokenizer

import corpus_pipeline
from tests.conftest import physical_plan
from tests.llm.conftest import SF
from tests.llm.test_operators import components_by_hand, contaminated_by_hand
from varve.llm.common import table
from varve.llm.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "benchmark", "pages", "labels"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, duck, name):
    df = QUERIES[name](spark, SF)
    result = duck.execute(ORACLES[name])
    columns = [d[0] for d in result.description]
    assert sorted(columns) == sorted(df.columns)
    wanted = sorted(repr(row) for row in result.fetchall())
    assert sorted(repr(tuple(r[c] for c in columns)) for r in df.collect()) == wanted


@pytest.mark.parametrize("name", ["op1_decontamination", "op7_url_filter", "op9_exact_dedup"])
def test_native_queries_run_no_python(spark, name):
    plan = physical_plan(QUERIES[name](spark, SF))
    for node in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop"):
        assert node not in plan


def documents(duck):
    return duck.execute("SELECT doc_id, text FROM documents").fetchall()


def test_token_and_piece_queries(spark, duck):
    rows = documents(duck)
    words = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    pieces = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    got = {r["doc_id"]: r["n_tokens"] for r in QUERIES["op3_token_counts"](spark, SF).collect()}
    assert got == {i: len(words.encode(t or "", add_special_tokens=False).ids) for i, t in rows}
    got = {r["doc_id"]: (r["ids"], r["text"]) for r in QUERIES["op8_sentencepiece"](spark, SF).collect()}
    assert got == {i: (pieces.encode(t or ""), t or "") for i, t in rows}


def test_page_query(spark, duck):
    import html

    got = {r["page_id"]: r["text"] for r in QUERIES["op2_html_text"](spark, SF).collect()}
    for i, page in duck.execute("SELECT page_id, html FROM pages").fetchall():
        inner = re.search(r"<article>(.*?)</article>", page, re.S).group(1)
        assert got[i] == " ".join(html.unescape(re.sub("<[^>]*>", " ", inner)).split())


def test_url_query(spark):
    rows = QUERIES["op7_url_filter"](spark, SF).collect()
    assert len(rows) == table(spark, SF, "pages").count()
    for r in rows:
        if r["rule"] == "net/":
            assert r["verdict"] == "block" and not (r["host"].endswith("example.net") and r["path"].startswith("/en/"))


def test_jaccard_query(spark, duck):
    got = sorted(tuple(r) for r in QUERIES["op6_jaccard_join"](spark, SF).collect())
    assert got == sorted(components_by_hand(documents(duck)))


def test_chunk_query(spark, duck):
    texts = dict(documents(duck))
    rows = QUERIES["op4_substring_dedup"](spark, SF).collect()
    assert rows
    for r in rows:
        span = texts[r["doc_id"]].encode()[r["start"] : r["start"] + r["n_bytes"]].decode()
        assert len(span.split()) >= 25
        if r["first_id"] == r["doc_id"]:
            continue
        middle = " ".join(span.split()[5:12])
        assert any(middle in " ".join((t or "").split()) for i, t in texts.items() if i != r["doc_id"])


def test_toxicity_query(spark, duck):
    rows = QUERIES["op5_toxicity"](spark, "/root/testdata/sf0.01").collect()
    path = "/root/testdata/sf0.01/labels.parquet"
    truth = dict(duck.execute(f"SELECT doc_id, toxic FROM '{path}'").fetchall())
    unseen = [r for r in rows if r["held_out"] and r["doc_id"] in truth]
    assert all(zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1 for r in unseen)
    toxic = [r["score"] for r in unseen if truth[r["doc_id"]]]
    other = [r["score"] for r in unseen if not truth[r["doc_id"]]]
    wins = sum((a > b) + (a == b) / 2 for a in toxic for b in other)
    assert wins >= 0.8 * len(toxic) * len(other)
    assert sum(s >= 0.7 for s in other) <= 0.1 * len(other)


def test_pipeline_stages_by_hand(spark, duck):
    docs = table(spark, SF, "documents")
    stages = dict(corpus_pipeline.STAGES)
    assert list(stages) == ["toxicity", "exact dedup", "near duplicates", "decontamination", "sentencepiece"]
    rows = documents(duck)
    kept = stages["exact dedup"](spark, docs, SF)
    norm = {}
    for i, t in rows:
        norm.setdefault(re.sub("[\x20\x09-\x0d]+", "", t or ""), []).append((-len(t or ""), i))
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {min(g)[1] for g in norm.values()}
    kept = stages["near duplicates"](spark, docs, SF)
    assert kept.columns == docs.columns
    assert {r["doc_id"] for r in kept.collect()} == {r[2] for r in components_by_hand(rows)}
    items = duck.execute("SELECT item_id, text FROM benchmark").fetchall()
    kept = stages["decontamination"](spark, docs, SF)
    assert kept.columns == docs.columns
    clean = {r[0] for r in contaminated_by_hand(rows, items) if not r[5]}
    assert {r["doc_id"] for r in kept.collect()} == clean
    kept = stages["toxicity"](spark, docs, SF)
    assert kept.columns == docs.columns and kept.count() <= docs.count()


def test_pipeline_runs_whole(spark):
    got = corpus_pipeline.run(spark, SF)
    rows = got.collect()
    assert 50 < len(rows) < 200 and all(len(r["ids"]) == r["n_tokens"] for r in rows)
