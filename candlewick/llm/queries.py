"""The operators bound to the test tables with production parameters."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from candlewick.llm import (
    decontaminate,
    divergence,
    filteraudit,
    html,
    imatch,
    langid,
    licenses,
    linededup,
    mixing,
    pii,
    simhash,
    topk,
    warc,
)

#: Key of the surrogates in the test query; a real one is kept secret.
TEST_KEY = "test"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learnt from three quarters of them."""
    docs = _table(spark, sf_dir, "documents")
    out = langid.held_out(F.col("doc_id"))
    model = langid.train(docs.filter("doc_id IS NOT NULL").filter(~out))
    found = langid.identify(docs, model, ["doc_id"])
    return found.select("doc_id", out.alias("held_out"), "lang_pred", "score", "languages")


def op2_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mixing.taken(mixing.mix(_table(spark, sf_dir, "documents")))


def op3_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprint and component of every document."""
    found = simhash.simhash_components(_table(spark, sf_dir, "documents"), shingle=4, distance=4)
    return found.select(
        "doc_id",
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
    )


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the archives that hold all pages."""
    found = warc.archived(_table(spark, sf_dir, "pages"))
    return found.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with surrogates for personal data."""
    found = pii.pseudonymize(_table(spark, sf_dir, "documents"), TEST_KEY)
    return found.select("doc_id", "text", "n_entities", "kinds")


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pairs of documents and benchmark items that they repeat."""
    docs, benchmark = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    found = decontaminate.contaminated(docs, benchmark)
    return found.select("doc_id", "item_id", "coverage", "tiles", "longest")


def op7_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The ten best vectors for each hundredth one."""
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op8_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """License phrases and notices in every document."""
    return licenses.license_scan(_table(spark, sf_dir, "documents"))


def op9_html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    found = html.extract(_table(spark, sf_dir, "pages"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without later copies of runs of lines."""
    found = linededup.dedup_lines(_table(spark, sf_dir, "documents"))
    return found.select("doc_id", "text", "deleted_lines")


def op11_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fingerprints of every document and of its edited text."""
    return imatch.fingerprints(_table(spark, sf_dir, "documents"))


def op12_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How the sources of each language differ, and by which terms."""
    return divergence.divergence(_table(spark, sf_dir, "documents"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What five filters remove of the documents of each language, in every order."""
    return filteraudit.filter_audit(spark, f"{sf_dir}/documents.parquet", _table(spark, sf_dir, "labels"))


QUERIES = {
    "op1_language_id": op1_language_id,
    "op2_mixing": op2_mixing,
    "op3_simhash": op3_simhash,
    "op4_warc": op4_warc,
    "op5_pii": op5_pii,
    "op6_decontamination": op6_decontamination,
    "op7_topk": op7_topk,
    "op8_licenses": op8_licenses,
    "op9_html": op9_html,
    "op10_line_dedup": op10_line_dedup,
    "op11_fingerprints": op11_fingerprints,
    "op12_divergence": op12_divergence,
    "op13_filter_audit": op13_filter_audit,
}

#: What SQL can express of the operators; the others have brute-force tests.
ORACLES: dict[str, str] = {
    "op4_warc": """
        WITH p AS (
            SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), d AS (
            SELECT page_id, octet_length(payload) AS n, sha256(payload) AS digest FROM p
        ), f AS (
            SELECT *, min(page_id) OVER (PARTITION BY digest) AS first FROM d
        ), r AS (
            SELECT *, CASE WHEN n >= 100 AND first IS DISTINCT FROM page_id THEN first END AS refers_to FROM f
        )
        SELECT page_id, CAST(n AS BIGINT) AS payload_bytes, digest AS payload_digest,
               CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
        FROM r
    """,
    "op7_topk": """
        WITH v AS (
            SELECT vec_id, [floor(1024 * CAST(x AS DOUBLE)) FOR x IN embedding] AS e
            FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
              AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.e, c.e) AS BIGINT) AS score
            FROM v q JOIN v c ON q.vec_id <> c.vec_id
            WHERE q.vec_id % 100 = 0
        ), r AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank
            FROM s
        )
        SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 10
    """,
    "op12_divergence": r"""
        WITH d AS (
            SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
            FROM documents
        ), w AS (
            SELECT lang, source, id, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
        ), t AS (
            SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT id) >= 10
        ), l AS (
            SELECT g.lang, count(term) AS v, coalesce(sum(total), 0) AS n
            FROM (SELECT DISTINCT lang FROM d) g LEFT JOIN t USING (lang) GROUP BY g.lang
        ), k AS (
            SELECT lang, source, term, count(*) AS n FROM w JOIN t USING (lang, term) GROUP BY lang, source, term
        ), g AS (
            SELECT g.lang, g.source, coalesce(sum(k.n), 0) AS n
            FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN k USING (lang, source) GROUP BY g.lang, g.source
        ), p AS (
            SELECT g.lang, g.source, t.term, coalesce(k.n, 0) AS n,
                   CAST(1 + 1000000000 * CAST(coalesce(k.n, 0) + 2 AS HUGEINT) // (g.n + 2 * l.v) AS BIGINT) AS p,
                   CAST(1 + 1000000000 * CAST(t.total + 2 AS HUGEINT) // (l.n + 2 * l.v) AS BIGINT) AS q
            FROM g JOIN l USING (lang) JOIN t USING (lang) LEFT JOIN k USING (lang, source, term)
        ), s AS (
            SELECT a.lang, a.source, b.source AS item, CAST(sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS BIGINT) AS value
            FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source
            GROUP BY a.lang, a.source, b.source
        ), r AS (
            SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
            LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
            UNION ALL
            SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q
        ), o AS (
            SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank
            FROM r
        )
        SELECT lang, source, part, item, value, rank FROM o WHERE part = 'pair' OR rank <= 10
    """,
    "op13_filter_audit": r"""
        WITH t AS (
            SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text FROM documents
        ), first AS (
            SELECT text, min(doc_id) AS first FROM t GROUP BY text
        ), marks AS (
            SELECT doc_id, max(CAST(quality = 1 AS INTEGER)) AS good, max(CAST(toxic = 1 AS INTEGER)) AS toxic
            FROM labels GROUP BY doc_id
        ), w AS (
            SELECT t.*, regexp_extract_all(t.text, '[^\x20\x09-\x0D]+') AS words, first.first FROM t JOIN first USING (text)
        ), m AS (
            SELECT part, coalesce(good, 0) AS good, coalesce(toxic, 0) AS toxic,
                   CASE WHEN len(words) < 100 THEN 1 ELSE 0 END
                   + CASE WHEN 100 * len(list_distinct(words)) < 80 * len(words) THEN 2 ELSE 0 END
                   + CASE WHEN 100 * len(regexp_extract_all(text, '[A-Z]')) > 10 * length(text) THEN 4 ELSE 0 END
                   + CASE WHEN regexp_matches(text, '[#$%&*|]') THEN 8 ELSE 0 END
                   + CASE WHEN doc_id > first THEN 16 ELSE 0 END AS mask
            FROM w LEFT JOIN marks USING (doc_id)
        ), c AS (
            SELECT part, mask, count(*) AS n, sum(good) AS good, sum(toxic) AS toxic FROM m GROUP BY part, mask
        ), f AS (
            SELECT * FROM (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)) AS v(letter, bit)
        ), o AS (
            SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order
            FROM f a, f b, f c, f d, f e
            WHERE a.bit + b.bit + c.bit + d.bit + e.bit = 31 AND a.bit | b.bit | c.bit | d.bit | e.bit = 31
        ), s AS (
            SELECT filter_order, CAST(step AS INTEGER) AS step, bit,
                   (SELECT coalesce(sum(e.bit), 0) FROM f e
                    WHERE instr(filter_order, e.letter) < s.step) AS earlier
            FROM o, unnest([1, 2, 3, 4, 5]) AS s(step), f
            WHERE f.letter = substr(filter_order, s.step, 1)
        ), r AS (
            SELECT part, filter_order, step, bit,
                   CAST(sum(CASE WHEN mask & (bit | CAST(earlier AS INTEGER)) = 0 THEN n ELSE 0 END) AS BIGINT) AS kept,
                   CAST(sum(CASE WHEN mask & bit <> 0 AND mask & CAST(earlier AS INTEGER) = 0 THEN n ELSE 0 END)
                        AS BIGINT) AS removed,
                   CAST(sum(CASE WHEN mask & bit <> 0 AND mask & CAST(earlier AS INTEGER) <> 0 THEN n ELSE 0 END)
                        AS BIGINT) AS redundant,
                   CAST(sum(CASE WHEN mask = bit THEN n ELSE 0 END) AS BIGINT) AS unique_fails,
                   CAST(sum(CASE WHEN mask & bit <> 0 AND mask & CAST(earlier AS INTEGER) = 0 THEN good ELSE 0 END)
                        AS BIGINT) AS good_lost,
                   CAST(sum(CASE WHEN mask & bit <> 0 AND mask & CAST(earlier AS INTEGER) = 0 THEN toxic ELSE 0 END)
                        AS BIGINT) AS toxic_lost
            FROM c, s GROUP BY part, filter_order, step, bit
        )
        SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
               CAST(sum(removed) OVER (PARTITION BY part, bit) AS BIGINT) AS shapley
        FROM r
    """,
}
