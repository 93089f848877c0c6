"""Registered queries of this subpackage: ``(spark, sf_dir) -> DataFrame``, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from airloom.llm import ball_kmeans, decontamination, merkle, packing, quality, sharding, simhash, substring_dedup, suffix_tree, token_counts, tokens, topk, url_filters, warc
from airloom.llm.common import save, table
from airloom.session import scratch_path

URL_RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]


def op1_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = spark.createDataFrame(URL_RULES, "host string, path string, verdict string")
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return url_filters.match_urls(pages, rules).select("page_id", "host", "path", "rule", "verdict")


def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 40)


def op3_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), capacity=1024, vocabulary=tokens.tokenizer_file())
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), bits=3, shingle=3)


def op5_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0, k=20)


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    records = warc.derive(warc.responses(table(spark, sf_dir, "pages")))
    return records.select("page_id", "warc_type", "record_id", "refers_to", "target_uri", "source_digest", "text_digest", "block_digest", "content_type", "http_content_type", "title", F.octet_length("block").cast("long").alias("content_length"))


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A life of the corpus in commits: all rows counted by words and by the BPE tokenizer, whose
    totals stay; the same word counts of distinct texts, from which copies are deleted and which
    are then revised for the tokenizer; and the first batch sent again."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    docs = docs.withColumns({"words": token_counts.count_words(F.col("text")), "text_id": F.sha2(F.col("text").cast("binary"), 256)})
    counted = save(token_counts.count_tokens(docs, tokens.tokenizer_file()), "token-counts")
    # One row of each text, and every row without text: grouped, not joined, so that a text
    # that a third of the documents share is reduced before the shuffle.
    # Ordered by a struct that is never null: a text may have rows with a null doc_id only.
    values = ["source", "lang", "words", "tokens"]
    one = F.min_by(F.struct(*values), F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", *values)).alias("r")
    kept = counted.filter("text_id IS NOT NULL").groupBy("text_id").agg(one).select("r.*")
    kept = save(kept.unionByName(counted.filter("text_id IS NULL").select(kept.columns)), "kept-counts")
    rollup = token_counts.Rollup(spark, scratch_path(spark, "token-rollup"))
    loaded = token_counts.deltas(counted, 1, "words-1", "words")
    one_each = "words-1-distinct"
    rollup.commit("load", loaded)
    rollup.commit("bpe", token_counts.deltas(counted, 1, "byte_bpe_50k", "tokens"))
    rollup.commit("distinct", token_counts.deltas(counted, 1, one_each, "words"))
    rollup.commit("copies", token_counts.deltas(counted, -1, one_each, "words"), token_counts.deltas(kept, 1, one_each, "words"))
    rollup.commit("revise", token_counts.deltas(kept, -1, one_each, "words"), token_counts.deltas(kept, 1, "byte_bpe_50k-distinct", "tokens"))
    rollup.compact()
    rollup.commit("load", loaded)
    return rollup.totals()


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = substring_dedup.dedup(table(spark, sf_dir, "documents"), window=13)
    return rows.select("doc_id", "n_words", "n_removed", F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


def _id_crc32():
    return F.crc32(F.col("doc_id").cast("string").cast("binary"))


def op11_suffix_tree(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"), _id_crc32() % 7 == 2)


def op12_ball_kmeans(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = ball_kmeans.compress(table(spark, sf_dir, "embeddings"), parts=4, entries=256, rounds=4, scale=1024)
    code = ball_kmeans.code_text(F.col("now")).alias("code")
    sha256 = F.lit(books.sha256() if books else None).alias("codebooks_sha256")
    return ball_kmeans.with_label_errors(coded).select("vec_id", code, "error", "label_error", sha256)


def op13_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row's proof; rows with an even checksum of their id are verified with their line breaks gone."""
    tampered = F.when(_id_crc32() % 2 == 0, F.translate("text", "\n", "")).otherwise(F.col("text"))
    leaves = merkle.leaves(table(spark, sf_dir, "documents"), changed={"text": tampered})
    proven = merkle.verified(merkle.proofs(merkle.build(leaves)))
    proof = merkle.proof_digest(F.col("path")).alias("proof_sha256")
    return proven.select(F.col("key").alias("doc_id"), "leaf", "subroot", "root", proof, "folded_root", "verified")


QUERIES = {
    "op1_url_filters": op1_url_filters,
    "op2_sharding": op2_sharding,
    "op3_packing": op3_packing,
    "op4_simhash": op4_simhash,
    "op5_topk": op5_topk,
    "op6_quality": op6_quality,
    "op7_decontamination": op7_decontamination,
    "op8_warc": op8_warc,
    "op9_token_counts": op9_token_counts,
    "op10_substring_dedup": op10_substring_dedup,
    "op11_suffix_tree": op11_suffix_tree,
    "op12_ball_kmeans": op12_ball_kmeans,
    "op13_merkle": op13_merkle,
}

SQL: dict[str, str] = {}
# Host and path as match_urls states them; the four rules, longest first.
SQL["op1_url_filters"] = r"""
WITH u AS (
  SELECT page_id,
         CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest
  FROM pages
), h AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r AS (
  SELECT page_id, coalesce(host, '') AS host, coalesce(path, '') AS path,
         CASE
           WHEN (host = 'example.net' OR host LIKE '%.example.net') AND starts_with(path, '/en/') THEN 'example.net/en/'
           WHEN (host = 'example.com' OR host LIKE '%.example.com') AND starts_with(path, '/de/') THEN 'example.com/de/'
           WHEN (host = 'org' OR host LIKE '%.org') AND starts_with(path, '/fr/') THEN 'org/fr/'
           WHEN (host = 'net' OR host LIKE '%.net') AND starts_with(path, '/') THEN 'net/'
         END AS rule
  FROM h
)
SELECT page_id, host, path, rule,
       CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' ELSE 'allow' END AS verdict
FROM r
"""

SQL["op5_topk"] = """
WITH ok AS (
  SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), scored AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM ok a JOIN ok b ON a.vec_id <> b.vec_id
  WHERE a.vec_id % 20 = 0
)
SELECT query_id, CAST(row_number() OVER w AS INTEGER) AS rank, vec_id, score
FROM scored
WINDOW w AS (PARTITION BY query_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 20
"""

_CRLF = "chr(13) || chr(10)"


def _urn(h: str) -> str:
    return f"'<urn:uuid:' || substr({h}, 1, 8) || '-' || substr({h}, 9, 4) || '-' || substr({h}, 13, 4) || '-' || substr({h}, 17, 4) || '-' || substr({h}, 21, 12) || '>'"


def _plain_text(html: str) -> str:
    t = f"regexp_replace({html}, '(?is)<script[^>]*>.*?</script>|<style[^>]*>.*?</style>|<!--.*?-->|<head[^>]*>.*?</head>', ' ', 'g')"
    t = f"regexp_replace({t}, '(?i)<br[^>]*>|</?(?:p|div|li|ul|ol|h[1-6]|tr|table|article|nav|section|header|footer)(?:[ /][^>]*)?>', chr(10), 'g')"
    t = f"regexp_replace({t}, '<[^>]*>', '', 'g')"
    for name, char in (("&lt;", "'<'"), ("&gt;", "'>'"), ("&quot;", "chr(34)"), ("&#39;", "chr(39)"), ("&nbsp;", "' '"), ("&amp;", "'&'")):
        t = f"replace({t}, '{name}', {char})"
    t = f"regexp_replace({t}, '[ \\t\\r\\f]+', ' ', 'g')"
    t = f"regexp_replace({t}, ' ?\\n[ \\n]*', chr(10), 'g')"
    return f"regexp_replace({t}, '\\A[ \\n]+|[ \\n]+\\z', '', 'g')"


SQL["op8_warc"] = f"""
WITH src AS (
  SELECT page_id, url AS target_uri, coalesce(html, '') AS body FROM pages
), resp AS (
  SELECT *, 'HTTP/1.1 200 OK' || {_CRLF} || 'Content-Type: text/html; charset=utf-8' || {_CRLF} || 'Content-Length: ' || strlen(body) AS http,
    md5('response' || chr(10) || coalesce(CAST(page_id AS VARCHAR), '') || chr(10) || coalesce(target_uri, '') || chr(10) || 'sha256:' || sha256(body)) AS h
  FROM src
), made AS (
  SELECT *, {_urn("h")} AS refers_to, 'sha256:' || sha256(body) AS source_digest,
    'sha256:' || sha256(http || {_CRLF} || {_CRLF} || body) AS source_block_digest,
    {_plain_text("body")} AS txt,
    trim(regexp_extract(body, '(?is)<title[^>]*>([^<]*)</title>', 1), ' ') AS title
  FROM resp
), named AS (
  SELECT *, 'sha256:' || sha256(txt) AS text_digest,
    md5('conversion' || chr(10) || refers_to) AS hc, md5('metadata' || chr(10) || refers_to) AS hm
  FROM made
), both_records AS (
  SELECT *, 'conversion' AS warc_type, {_urn("hc")} AS record_id, 'text/plain; charset=utf-8' AS content_type, txt AS block FROM named
  UNION ALL
  SELECT *, 'metadata', {_urn("hm")}, 'application/json',
    CAST(json_object(
      'source', json_object('WARC-Record-ID', refers_to, 'WARC-Target-URI', target_uri, 'WARC-Date', '1970-01-01T00:00:00Z',
                            'WARC-Block-Digest', source_block_digest, 'WARC-Payload-Digest', source_digest),
      'http', string_split(http, {_CRLF}),
      'title', title,
      'conversion', json_object('WARC-Record-ID', {_urn("hc")}, 'WARC-Block-Digest', text_digest)) AS VARCHAR)
  FROM named
)
SELECT page_id, warc_type, record_id, refers_to, target_uri, source_digest, text_digest,
  'sha256:' || sha256(block) AS block_digest, content_type, 'text/html; charset=utf-8' AS http_content_type, title,
  CAST(strlen(block) AS BIGINT) AS content_length
FROM both_records
"""

SQL["op10_substring_dedup"] = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words FROM documents
), win AS (
  SELECT doc_id, i, array_to_string(words[i:i + 12], ' ') AS g
  FROM w, unnest(range(1, len(words) - 11)) AS t(i)
), firsts AS (
  SELECT g, min(doc_id) AS first_doc FROM win GROUP BY g
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p
  FROM win JOIN firsts USING (g) WHERE first_doc < doc_id
), place AS (
  SELECT doc_id, p, words[p] AS word FROM w, unnest(range(1, len(words) + 1)) AS t(p)
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY p) AS text
  FROM place ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words, CAST(len(words) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(k.text, '')) AS kept_sha256
FROM w LEFT JOIN kept k USING (doc_id)
"""


def _kmeans_rounds(rounds: int) -> str:
    """The codebook after each round, and the assignment to it."""
    sql = ""
    for n in range(rounds + 1):
        sql += f"""
, near{n} AS MATERIALIZED (
  SELECT vec_id, p, min(struct_pack(d := CAST(list_inner_product(x, x) - 2 * list_inner_product(x, c) + list_inner_product(c, c) AS BIGINT), e := e)) AS best
  FROM parts JOIN book{n} USING (p) GROUP BY vec_id, p
)"""
        if n < rounds:
            sql += f"""
, sums{n} AS (
  SELECT p, e, list(CAST(floor(s / n) AS DOUBLE) ORDER BY k) AS c
  FROM (SELECT p, best.e AS e, k, sum(x[k]) AS s, count(*) AS n
        FROM parts JOIN near{n} USING (vec_id, p), unnest(range(1, len(x) + 1)) AS t(k) GROUP BY ALL)
  GROUP BY p, e
), book{n + 1} AS MATERIALIZED (
  SELECT p, e, coalesce(s.c, b.c) AS c FROM book{n} b LEFT JOIN sums{n} s USING (p, e)
)"""
    return sql


SQL["op12_ball_kmeans"] = f"""
WITH ok AS MATERIALIZED (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(1024 * CAST(x AS DOUBLE)) AS DOUBLE)) AS q
  FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), parts AS MATERIALIZED (
  SELECT vec_id, p, q[p * (len(q) // 4) + 1:(p + 1) * (len(q) // 4)] AS x FROM ok, range(4) AS t(p)
), book0 AS MATERIALIZED (
  SELECT p, e, x AS c
  FROM (SELECT p, x, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS e FROM parts) WHERE e < 256
){_kmeans_rounds(4)}
, coded AS (
  SELECT vec_id, string_agg(printf('%02x', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error
  FROM near4 GROUP BY vec_id
), books AS (
  SELECT sha256(string_agg(CAST(CAST(c[k] AS BIGINT) AS VARCHAR), ',' ORDER BY p, e, k)) AS h
  FROM book4, unnest(range(1, len(c) + 1)) AS t(k)
)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, h AS codebooks_sha256
FROM coded JOIN ok USING (vec_id), books
"""


def _leaf(text: str) -> str:
    values = ["CAST(doc_id AS VARCHAR)", "source", "lang", "CAST(n_chars AS VARCHAR)", text]
    return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values) + ")"


def _siblings(nodes: str) -> str:
    around = [f"coalesce(string_agg(b.d, '' ORDER BY b.i) FILTER (b.i {x} a.i), '') AS {name}" for x, name in (("<", "before"), (">", "after"))]
    return f"""SELECT a.g, a.l, a.i, {", ".join(around)}
  FROM {nodes} a JOIN {nodes} b ON a.g IS NOT DISTINCT FROM b.g AND a.l = b.l AND a.i // 3 = b.i // 3
  WHERE a.n > 1 GROUP BY a.g, a.l, a.i"""


def _climb(nodes: str) -> str:
    return f"SELECT g, l + 1, i // 3, (any_value(n) + 2) // 3, sha256(string_agg(d, '' ORDER BY i)) FROM {nodes} WHERE n > 1 GROUP BY g, l, i // 3"


def _walk(walk: str, siblings: str) -> str:
    return f"""SELECT rid, w.g, w.l + 1, w.i // 3, sha256(before || d || after), proof || before || after
  FROM {walk} w JOIN {siblings} s ON w.g IS NOT DISTINCT FROM s.g AND w.l = s.l AND w.i = s.i"""


# crc32 of the decimal id, bit by bit: each byte meets the register, then seven steps without one.
_CRC = """list_reduce(list_prepend(CAST(4294967295 AS BIGINT), flatten(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: [CAST(ascii(c) AS BIGINT), 0, 0, 0, 0, 0, 0, 0]))),
    lambda r, b: CASE WHEN xor(r, b) & 1 = 1 THEN xor(xor(r, b) >> 1, 3988292384) ELSE xor(r, b) >> 1 END)"""

SQL["op13_merkle"] = f"""
WITH RECURSIVE rows AS MATERIALIZED (
  SELECT row_number() OVER () AS rid, doc_id, source AS g, {_leaf("text")} AS leaf,
    CASE WHEN xor({_CRC}, 4294967295) % 2 = 0 THEN {_leaf("replace(text, chr(10), '')")} ELSE {_leaf("text")} END AS now
  FROM documents
), ranked AS MATERIALIZED (
  SELECT *, row_number() OVER (PARTITION BY g ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i, count(*) OVER (PARTITION BY g) AS n FROM rows
), nodes AS (
  SELECT g, 0 AS l, i, n, leaf AS d FROM ranked UNION ALL {_climb("nodes")}
), tops AS MATERIALIZED (
  SELECT g AS source, l AS height, d, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i, count(*) OVER () AS n FROM nodes WHERE n = 1
), upper AS (
  SELECT 0 AS g, 0 AS l, i, n, d FROM tops UNION ALL {_climb("upper")}
), sib AS MATERIALIZED ({_siblings("nodes")}
), usib AS MATERIALIZED ({_siblings("upper")}
), walk AS (
  SELECT rid, g, 0 AS l, i, now AS d, '' AS proof FROM ranked UNION ALL {_walk("walk", "sib")}
), uwalk AS (
  SELECT rid, 0 AS g, 0 AS l, t.i, w.d, proof FROM walk w JOIN tops t ON w.g IS NOT DISTINCT FROM t.source AND w.l = t.height
  UNION ALL {_walk("uwalk", "usib")}
), root AS (SELECT d, l FROM upper WHERE n = 1)
SELECT r.doc_id, r.leaf, t.d AS subroot, root.d AS root, sha256(w.proof) AS proof_sha256, w.d AS folded_root, w.d = root.d AS verified
FROM ranked r JOIN tops t ON r.g IS NOT DISTINCT FROM t.source JOIN uwalk w USING (rid) JOIN root ON w.l = root.l
"""
