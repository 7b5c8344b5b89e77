"""Registered queries on documents, pages and embeddings, with SQL counterparts where SQL has one."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe,
    chaining,
    cover_tree_search,
    embedding_dedup,
    fingerprint,
    fixity,
    jaccard_join,
    lexical_search,
    mixing,
    secret_scan,
    token_alignment,
    toxicity,
    url_cascade,
)
from .common import table

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(fn: Query) -> Query:
        QUERIES[name] = fn
        if sql is not None:
            ORACLES[name] = sql
        return fn

    return register


@query("op1_secret_scan")
def op1(spark: SparkSession, sf: str) -> DataFrame:
    found = secret_scan.secret_scan(table(spark, sf, "documents").select("doc_id", "text"))
    names = ("n_assign", "n_access", "n_hex", "base_sha256", "spans", "n_layers", "n_too_large")
    return found.select("doc_id", *[F.col(f"secrets.{c}").alias(c) for c in names])


#: Rules of the query: (verdict, host, path).
URL_RULES = tuple(
    url_cascade.Rule(*r)
    for r in (
        ("allow", "org", "/"),
        ("block", "example.org", "/es/"),
        ("block", "example.org", "/en/1"),
        ("allow", "com", "/fr/"),
        ("block", "com", "/de/"),
    )
)
#: First labels of listed domains.
LISTED_LABELS = ("adult-x", "ads-track", "casino-win", "cheap-pills", "free-bets", "spam-farm")

OP2_SQL = f"""
WITH p AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages),
h AS (SELECT page_id, rest, regexp_extract(rest, '^[^/?#]*') AS raw FROM p),
s AS (SELECT page_id, translate(raw, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
  regexp_extract(substr(rest, length(raw) + 1), '^[^?#]*') AS path FROM h),
r AS (SELECT *, CASE
  WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/en/1') THEN 'example.org/en/1'
  WHEN (host = 'example.org' OR host LIKE '%.example.org') AND starts_with(path, '/es/') THEN 'example.org/es/'
  WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/fr/') THEN 'com/fr/'
  WHEN (host = 'com' OR host LIKE '%.com') AND starts_with(path, '/de/') THEN 'com/de/'
  WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/') THEN 'org/' END AS rule FROM s)
SELECT page_id, host, path, rule, CASE WHEN rule IN ('example.org/en/1', 'example.org/es/', 'com/de/') THEN 'block'
  WHEN rule IS NOT NULL THEN 'allow'
  WHEN len(list_intersect(string_split(host, '.'), {list(LISTED_LABELS)})) > 0 THEN 'block' ELSE 'allow' END AS verdict
FROM r"""


@query("op2_url_cascade", OP2_SQL)
def op2(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages").select("page_id", "url")
    listed = lambda key: F.element_at(F.split(key, r"\."), 1).isin(*LISTED_LABELS)
    return url_cascade.judge_urls(pages, URL_RULES, listed).drop("url")


OP3_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
    ELSE list_distinct([array_to_string(w[i:i+3], ' ') for i in range(1, len(w) - 2)]) END AS s FROM w),
e AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM s),
l AS (SELECT a.doc_id AS a, b.doc_id AS b FROM e a JOIN e b ON a.t = b.t AND a.doc_id < b.doc_id
    AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
r AS (SELECT doc_id AS a, doc_id AS b FROM documents UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a)
SELECT s.doc_id, len(s.s) AS n_shingles, c.m AS component_id FROM s JOIN (SELECT a, min(b) AS m FROM r GROUP BY a) c ON c.a = s.doc_id"""


@query("op3_jaccard_join", OP3_SQL)
def op3(spark: SparkSession, sf: str) -> DataFrame:
    return jaccard_join.jaccard_classes(table(spark, sf, "documents"))


def vocabulary(spark: SparkSession, name: str = "byte_bpe_multi_50k.tiktoken") -> bpe.Bpe:
    import public_tokenizers

    return bpe.Bpe(spark, public_tokenizers.path(name), public_tokenizers.PATTERN)


@query("op4_byte_bpe")
def op4(spark: SparkSession, sf: str) -> DataFrame:
    return vocabulary(spark).round_trip(table(spark, sf, "documents"))


@query("op5_toxicity")
def op5(spark: SparkSession, sf: str) -> DataFrame:
    return toxicity.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query("op6_mix_sources")
def op6(spark: SparkSession, sf: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf, "documents"), keep=["doc_id"])


OP7_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE list_cosine_similarity(a.v, b.v) >= 0.95),
r AS (SELECT vec_id AS a, vec_id AS b FROM v UNION SELECT r.a, l.b FROM r JOIN l ON r.b = l.a),
c AS (SELECT a, min(b) AS m FROM r GROUP BY a)
SELECT vec_id, (SELECT count(*) FROM l WHERE l.a = vec_id) AS n_links, m AS component_id, vec_id = m AS kept FROM v JOIN c ON c.a = vec_id"""


@query("op7_subspace_pigeonhole", OP7_SQL)
def op7(spark: SparkSession, sf: str) -> DataFrame:
    return embedding_dedup.embedding_classes(table(spark, sf, "embeddings"))


@query("op8_passage_chaining")
def op8(spark: SparkSession, sf: str) -> DataFrame:
    return chaining.repeated_passages(table(spark, sf, "documents"))


OP9_SQL = """
WITH p AS (SELECT page_id, coalesce(url, '') AS url, coalesce(html, '') AS html FROM pages),
w AS (SELECT page_id, html, octet_length(encode(concat('WARC/1.0', chr(13), chr(10), 'WARC-Type: response', chr(13), chr(10),
    'WARC-Record-ID: <urn:page:', page_id, '>', chr(13), chr(10), 'WARC-Target-URI: ', url, chr(13), chr(10),
    'WARC-Payload-Digest: sha256:', sha256(html), chr(13), chr(10), 'Content-Length: ', octet_length(encode(html)),
    chr(13), chr(10), chr(13), chr(10), html, chr(13), chr(10), chr(13), chr(10)))) AS length FROM p),
o AS (SELECT *, CAST(coalesce(sum(length) OVER (ORDER BY page_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS "offset" FROM w)
SELECT page_id, 'corrupt' AS status, "offset", CAST(length AS BIGINT) AS length, "offset" AS other_offset, CAST(length AS BIGINT) AS other_length
FROM o WHERE page_id % 97 = 13 AND regexp_matches(html, '[A-Za-z]')"""


@query("op9_fixity_audit", OP9_SQL)
def op9(spark: SparkSession, sf: str) -> DataFrame:
    pages = table(spark, sf, "pages")
    found = fixity.audit(fixity.warc_records(pages), fixity.warc_records(fixity.damaged(pages, F.pmod("page_id", F.lit(97)) == 13)))
    return found.withColumnRenamed("record_id", "page_id")


@query("op10_fingerprint")
def op10(spark: SparkSession, sf: str) -> DataFrame:
    found = fingerprint.fingerprints(table(spark, sf, "documents"))
    likeness = lambda a, b: fingerprint.resemblance(F.col(a), F.col(b))
    return found.select(
        "doc_id",
        "n_chars",
        F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        fingerprint.as_text(F.col("sketch")).alias("fingerprint"),
        fingerprint.as_text(F.col("edited_sketch")).alias("edited_fingerprint"),
        likeness("sketch", "edited_sketch").alias("near_edited"),
        likeness("sketch", "next_sketch").alias("near_next"),
        fingerprint.distinct_shingles(F.col("sketch")).alias("n_distinct"),
        fingerprint.containment(F.col("edited_sketch"), F.col("sketch")).alias("edited_contained"),
    )


@query("op11_token_alignment")
def op11(spark: SparkSession, sf: str) -> DataFrame:
    import public_tokenizers

    aligner = token_alignment.Aligner(spark, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
    return token_alignment.token_alignment(aligner, table(spark, sf, "documents"))


OP12_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, r.vec_id, CAST(list_inner_product(q.v, r.v) AS BIGINT) AS score
  FROM v q JOIN v r ON q.vec_id % 50 = 0 AND r.vec_id <> q.vec_id),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM k WHERE rank <= 5"""


@query("op12_exact_top_k", OP12_SQL)
def op12(spark: SparkSession, sf: str) -> DataFrame:
    return cover_tree_search.top_inner_products(table(spark, sf, "embeddings"), F.col("vec_id") % 50 == 0)


OP13_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t FROM documents),
i AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM benchmark),
z AS (SELECT count(*) AS big_n, sum(len(t)) AS big_l FROM d WHERE len(t) > 0),
m AS (SELECT doc_id, 10 + CAST((90 * len(t) * big_n) // big_l AS BIGINT) AS m FROM d, z),
p AS (SELECT doc_id, unnest(t) AS t FROM d),
f AS (SELECT doc_id, t, count(*) AS tf FROM p WHERE t IN (SELECT t FROM i) GROUP BY doc_id, t),
w AS (SELECT t, CAST(floor(1000 * ln((2 * big_n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM f, z GROUP BY t, big_n),
s AS (SELECT item_id, doc_id, CAST(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM i JOIN w USING (t) JOIN f USING (t) JOIN m USING (doc_id) GROUP BY item_id, doc_id),
k AS (SELECT *, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank FROM s WHERE score > 0)
SELECT item_id, rank, doc_id, score FROM k WHERE rank <= 10"""


@query("op13_lexical_search", OP13_SQL)
def op13(spark: SparkSession, sf: str) -> DataFrame:
    return lexical_search.ranked_search(table(spark, sf, "documents"), table(spark, sf, "benchmark"))
