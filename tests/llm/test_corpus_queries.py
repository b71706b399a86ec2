"""Every registered query over whole tables, against brute force, known markup or its SQL twin."""

import html
import re

import duckdb
import pytest

from candlewick.llm.queries import ORACLES, QUERIES

SF_DIR = "/root/testdata/sf0.001"


def table(name):
    return duckdb.sql(f"SELECT * FROM '{SF_DIR}/{name}.parquet'").fetchall()


@pytest.fixture(scope="module")
def texts():
    return {row[0]: row[1] for row in table("documents")}


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, name):
    connection = duckdb.connect()
    for t in ("documents", "embeddings", "labels", "pages"):
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    cursor = connection.execute(ORACLES[name])
    columns = [c[0] for c in cursor.description]
    frame = QUERIES[name](spark, SF_DIR)
    assert sorted(frame.columns) == sorted(columns)
    got = sorted(map(str, (tuple(r) for r in frame.select(*[f"`{c}`" for c in columns]).collect())))
    assert got == sorted(map(str, cursor.fetchall()))


def test_language_id(spark, texts):
    labels = {row[0]: row[2] for row in table("documents")}
    rows = QUERIES["op1_language_id"](spark, SF_DIR).collect()
    assert {r.doc_id for r in rows} == set(texts) and len(rows) == len(texts)
    out = [r for r in rows if r.held_out]
    assert len(out) > 30 and sum(r.lang_pred == labels[r.doc_id] for r in out) >= 0.97 * len(out)


def test_mixing(spark, texts):
    rows = QUERIES["op2_mixing"](spark, SF_DIR).collect()
    size = {i: len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for i, t in texts.items()}
    assert {r.doc_id: r["size"] for r in rows} == size
    assert all(r.taken <= 2 * r["size"] for r in rows)
    for source in {r.source for r in rows}:
        own = [r for r in rows if r.source == source]
        assert own[0].source_size == sum(r["size"] for r in own)
        assert abs(sum(r.taken for r in own) - own[0].target) <= 0.03 * own[0].target + 64


def test_simhash(spark, texts):
    from test_simhash import brute_components, brute_fp

    fps = {i: brute_fp(t) for i, t in texts.items()}
    rows = QUERIES["op3_simhash"](spark, SF_DIR).collect()
    assert {r.doc_id: r.fingerprint for r in rows} == {i: f"{f:016x}" for i, f in fps.items()}
    smallest = {}
    for group in brute_components(set(fps.values()), 4):
        ids = [i for i, f in fps.items() if f in set(group)]
        smallest |= dict.fromkeys(ids, min(ids))
    assert {r.doc_id: r.component_id for r in rows} == smallest


def test_pii(spark, texts):
    found = re.compile(
        r"[\w.%+-]+@[\w-]+(?:\.[\w-]+)+|\+1 \(\d{3}\) 555-\d{4}|\b(?:\d{1,3}\.){3}\d{1,3}\b|\b[0-9a-fA-F]{40}\b"
    )
    for r in QUERIES["op5_pii"](spark, SF_DIR).collect():
        entities = found.findall(texts[r.doc_id])
        assert not any(e in r.text for e in entities)
        if not r.n_entities:
            assert r.text == texts[r.doc_id] and not entities


def test_decontamination(spark, texts):
    from test_decontaminate import words

    items = {i: words(t) for i, t in table("benchmark")}
    want = set()
    for doc_id, text in texts.items():
        own = words(text)
        grams = {tuple(own[p : p + 5]) for p in range(len(own) - 4)}
        for i, item in items.items():
            hit = {p + j for p in range(len(item) - 4) if tuple(item[p : p + 5]) in grams for j in range(5)}
            if len(hit) >= 0.5 * len(item):
                want.add((doc_id, i))
    got = {(r.doc_id, r.item_id) for r in QUERIES["op6_decontamination"](spark, SF_DIR).collect()}
    assert got == want and want  # no item here occurs in pieces that overlap


def test_licenses(spark, texts):
    from test_licenses import brute

    rows = QUERIES["op8_licenses"](spark, SF_DIR).collect()
    got = {r.doc_id: (r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels) for r in rows}
    assert got == {i: brute(t) for i, t in texts.items()}


def test_html(spark):
    rows = {r.page_id: r for r in QUERIES["op9_html"](spark, SF_DIR).collect()}
    for page_id, url, source in table("pages"):
        body = re.search(r"<article>(.*?)(</article|$)", source, re.S)[1]
        blocks = re.split(r"</?(?:p|h1|br)>", body)
        lines = [" ".join(html.unescape(re.sub(r"<[^>]*>", "", b)).split()) for b in blocks]
        text = "\n".join(line for line in lines if line)
        assert (rows[page_id].url, rows[page_id].text, rows[page_id].n_chars) == (url, text, len(text))


def test_line_dedup(spark, texts):
    from test_linededup import brute

    docs = sorted(texts.items())
    want = brute(docs, 50)
    for r in QUERIES["op10_line_dedup"](spark, SF_DIR).collect():
        assert [x.strip() for x in r.text.split("\n") if x.strip()] == want[r.doc_id]
        if not r.deleted_lines:
            assert r.text == texts[r.doc_id]


def test_fingerprints(spark, texts):
    from test_imatch import brute, result

    assert result(QUERIES["op11_fingerprints"](spark, SF_DIR)) == brute(sorted(texts.items()), 6, 10)
