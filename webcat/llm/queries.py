"""The registered queries of this subpackage and their check SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import public_tokenizers

from webcat.llm import (
    codes, divergence, langid, lines, mixing, order_minhash, perplexity, pieces, quality, simhash, topk, toxicity, warc,
)
from webcat.llm.common import table
from webcat.session import scratch_dir

MODEL_FILE = public_tokenizers.path("piece_bpe_32k.model")


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    held_out = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    scored = toxicity.classify(docs.select("doc_id", "text", "lang"), labels, may_learn=~held_out)
    return scored.select(
        F.col("id").alias("doc_id"), (F.crc32(F.col("id").cast("string")) % 5 == 0).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"), "threshold", "flagged",
    )


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"), copy_cols=("copy", "shuffle_key"))
    return mixed.select("doc_id", "source", "copy", "shuffle_key", "text")


def op3_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(table(spark, sf_dir, "documents"), MODEL_FILE, keep=["doc_id"])
    return coded.select(
        "doc_id", F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.array_join(F.col("ids").cast("array<string>"), " "), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page by all evidence; every document by its text and its source as host (its language is what is learnt)."""
    docs, pages = table(spark, sf_dir, "documents"), table(spark, sf_dir, "pages")
    model = langid.fit(docs, "doc_id", "text", "lang")
    nothing = F.lit(None).cast("string")
    of_pages = langid.identify(pages, model, "page_id", "html", markup=True, **langid.page_evidence())
    of_docs = langid.identify(docs, model, "doc_id", "text", host=F.col("source"), address=nothing, declared=nothing, markup=False)
    columns = ["language", "confidence", "text_language", "declared", "addressed"]
    missing = F.lit(None).cast("long")
    return of_docs.select(F.col("id").alias("doc_id"), missing.alias("page_id"), *columns).union(
        of_pages.select(missing.alias("doc_id"), F.col("id").alias("page_id"), *columns))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = simhash.near_groups(table(spark, sf_dir, "documents"))
    return groups.select(
        F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        F.col("component").alias("component_id"),
    )


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    kept = lines.deduplicate_lines(docs, gone_col="dropped_lines")
    return kept.select("doc_id", "text", "dropped_lines")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = scratch_dir(spark, "warc")
    warc.write_archives(table(spark, sf_dir, "pages"), out)
    return warc.read_archives(spark, out).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = order_minhash.fingerprint_with_next(table(spark, sf_dir, "documents"))
    return found.select(
        F.col("id").alias("doc_id"), "n_chars", F.sha2("edited", 256).alias("edited_sha256"), "fingerprint",
        "edited_fingerprint", "near_edited", "near_next",
    )


def op9_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = topk.top_k(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("query").alias("query_id"), "rank", F.col("vec").alias("vec_id"), "score")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    return quality.score(docs, labels, "score", "accepted", keep=["doc_id"])


def op11_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op12_perplexity(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = perplexity.judge(table(spark, sf_dir, "documents"), keep=["doc_id"])
    return judged.select("doc_id", *perplexity.BASE, "base_failed", "kept", "entropy", "low", "high")


def op13_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = codes.encode(table(spark, sf_dir, "embeddings"))
    return coded.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


QUERIES = {
    "op1_toxicity": op1_toxicity, "op2_source_mixing": op2_source_mixing, "op3_sentencepiece": op3_sentencepiece,
    "op4_simhash": op4_simhash, "op5_language_id": op5_language_id, "op6_line_dedup": op6_line_dedup, "op7_warc": op7_warc,
    "op8_order_minhash": op8_order_minhash, "op9_topk": op9_topk, "op10_quality": op10_quality, "op11_divergence": op11_divergence,
    "op12_perplexity": op12_perplexity, "op13_codes": op13_codes,
}


def _codes_sql(rounds: int = 6) -> str:
    """Plain k-means, a group of common table expressions per round."""
    steps = ["""
v AS MATERIALIZED (SELECT row_number() OVER () AS n, vec_id, label, list_transform(embedding, lambda x: floor(4096 * x::DOUBLE)::BIGINT) AS e FROM embeddings
      WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
x AS MATERIALIZED (SELECT n, p, e[p * len(e) // 8 + 1 : (p + 1) * len(e) // 8] AS x FROM v, range(8) r(p)),
b0 AS MATERIALIZED (SELECT p, k - 1 AS k, x AS c FROM x JOIN (SELECT n, row_number() OVER (ORDER BY vec_id) AS k FROM v) USING (n) WHERE k <= 16)"""]
    for r in range(rounds + 1):
        steps.append(f"""
d{r} AS MATERIALIZED (SELECT n, x.p, k, x, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2])))::BIGINT AS d FROM x JOIN b{r} b ON x.p = b.p),
a{r} AS MATERIALIZED (SELECT n, p, arg_min(k, d * 16 + k) AS k, any_value(x) AS x, min(d) AS d FROM d{r} GROUP BY n, p)""")
        if r < rounds:
            steps.append(f"""
u{r} AS MATERIALIZED (SELECT p, k, list(m ORDER BY i) AS c FROM (SELECT p, k, i, floor(sum(x[i + 1])::DOUBLE / count(*))::BIGINT AS m
       FROM a{r}, range(512) g(i) WHERE i < len(x) GROUP BY p, k, i) GROUP BY p, k),
b{r + 1} AS MATERIALIZED (SELECT b.p, b.k, coalesce(u.c, b.c) AS c FROM b{r} b LEFT JOIN u{r} u ON b.p = u.p AND b.k = u.k)""")
    steps.append(f"""
o AS (SELECT n, string_agg(printf('%02x', k), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY n),
t AS (SELECT label, sum(error)::BIGINT AS label_error FROM o JOIN v USING (n) GROUP BY label),
h AS (SELECT sha256(string_agg(list_aggregate(c, 'string_agg', ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM b{rounds})""")
    return "WITH " + ",".join(steps) + """
SELECT vec_id, code, error, label_error, codebooks_sha256 FROM o JOIN v USING (n) JOIN t ON v.label IS NOT DISTINCT FROM t.label, h"""


ORACLE = {
    "op2_source_mixing": """
WITH sizes AS (SELECT source, sum(length(coalesce(text, '')))::DOUBLE AS chars FROM documents GROUP BY source),
     total AS (SELECT sum(chars) AS chars, sum(sqrt(chars)) AS weight FROM sizes WHERE chars > 0),
     rates AS (SELECT s.source, CASE WHEN s.chars = 0 THEN 1.0 ELSE sqrt(s.chars) / t.weight * t.chars / s.chars END AS rate FROM sizes s, total t),
     drawn AS (SELECT d.doc_id, d.source, d.text, r.rate,
                      (('0x' || substr(md5('mix:0:' || d.doc_id), 1, 13))::BIGINT + 0.5) / 4503599627370496.0 AS u
               FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source),
     counted AS (SELECT *, len(list_filter(range(0, 100), lambda k: u > list_sum(list_transform(range(0, k + 1),
                      lambda i: exp(i * ln(rate) - rate - lgamma(i + 1)))))) AS n FROM drawn),
     copies AS (SELECT doc_id, source, text, unnest(range(1, n + 1))::INTEGER AS copy FROM counted)
SELECT doc_id, source, copy, md5('mix:order:' || doc_id || ':' || copy) AS shuffle_key, text FROM copies""",
    "op7_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
     g AS (SELECT html, max(page_id) AS first FROM p WHERE n >= 1000 GROUP BY html)
SELECT p.page_id, p.n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN g.first <> p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN g.first <> p.page_id THEN g.first END AS refers_to
FROM p LEFT JOIN g ON p.n >= 1000 AND p.html = g.html""",
    "op9_topk": """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)::BIGINT) AS e FROM embeddings
           WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
     s AS (SELECT q.vec_id AS query_id, c.vec_id,
                  list_sum(list_transform(list_zip(q.e, c.e), lambda z: z[1] * z[2]))::BIGINT AS score
           FROM v q JOIN v c ON q.vec_id <> c.vec_id WHERE q.vec_id % 20 = 0),
     r AS (SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank, vec_id, score FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20""",
    "op11_divergence": r"""
WITH d AS (SELECT row_number() OVER () AS n, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
     w AS (SELECT n, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
     k AS (SELECT lang, term, count(*) AS total FROM w GROUP BY lang, term HAVING count(DISTINCT n) >= 3),
     c AS (SELECT lang, source, term, count(*) AS n FROM w SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
     g AS (SELECT DISTINCT lang, source FROM d),
     l AS (SELECT lang, count(term) AS v, coalesce(sum(total), 0)::BIGINT AS n FROM (SELECT DISTINCT lang FROM g) LEFT JOIN k USING (lang) GROUP BY lang),
     s AS (SELECT g.lang, g.source, coalesce(sum(n), 0)::BIGINT AS n FROM g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
     p AS (SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS c, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // (s.n + l.v) AS p,
                  1 + 1000000000 * (k.total + 1) // (l.n + l.v) AS q
           FROM s JOIN l USING (lang) JOIN k ON k.lang = s.lang LEFT JOIN c ON c.lang = s.lang AND c.source = s.source AND c.term = k.term),
     f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p)::BIGINT AS value
           FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
     r AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
           FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
           LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
           UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE c > 0 AND p > q)
SELECT lang, source, part, item, value, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank FROM r
QUALIFY part = 'pair' OR rank <= 200""",
    "op13_codes": _codes_sql(),
}
