"""Registered queries of this folder, with the DuckDB SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemill.llm import (bpe, bwt_repeats, fingerprints, inner_products, lexical, ngram_join, packing, quality, repeats, sharding,
                          spelling, url_lists, warc)
from tidemill.llm.common import table
from tidemill.llm.tokenizers import PATTERN, RANK_FILE, TOKENIZER_FILE


def op1_line_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return quality.rules(docs, quality.fit(docs, table(spark, sf_dir, "labels", "doc_id", "quality")))


def op2_count_vector_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents", "doc_id", "text"), size=4, percent=85)


def op3_suffix_trees(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.removed(table(spark, sf_dir, "documents", "doc_id", "text"))


def op4_warc_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.page_table(warc.captures_of(table(spark, sf_dir, "pages", "page_id", "url", "html")))


def op5_weighted_samples(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents", "doc_id", "text"))


def op6_sum_of_squares(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents", "doc_id", "text"), TOKENIZER_FILE, PATTERN)


def op7_rank_queue_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encoded(table(spark, sf_dir, "documents", "doc_id", "text"), RANK_FILE, PATTERN)


def op8_bwt_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bwt_repeats.removed(table(spark, sf_dir, "documents", "doc_id", "text"))


def op9_histogram_sort(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents", "doc_id", "text"))


#: Start of the crawl and of the lists, and the crawl's length, in seconds.
CRAWL_START, CRAWL_SECONDS = 1_704_067_200, 31_536_000


def captures(pages: DataFrame) -> DataFrame:
    """The pages with a fetch time spread over the crawl by page id."""
    return pages.select("page_id", "url", (F.lit(CRAWL_START) + F.pmod(F.col("page_id") * 7919, F.lit(CRAWL_SECONDS))).alias("fetch_time"))


def list_entries(pages: DataFrame) -> DataFrame:
    """A dated list over the hosts, domains and first path segments that occur in ``pages``.

    Up to four entries per pattern; whether, when and what is read off a digest of pattern and number.
    """
    found = pages.select(F.lower(F.regexp_extract("url", r"^[A-Za-z]+://([^/?#:@]+)", 1)).alias("host"),
                         F.regexp_extract("url", r"^[A-Za-z]+://[^/?#]+/([^/?#]*)/", 1).alias("seg")).where("host <> ''")
    kinds = F.array(F.struct(F.lit("host").alias("kind"), F.col("host").alias("pattern")),
                    F.struct(F.lit("domain").alias("kind"), F.substring_index("host", ".", -2).alias("pattern")),
                    F.struct(F.lit("prefix").alias("kind"), F.concat("host", F.lit("/"), "seg", F.lit("/")).alias("pattern")))
    patterns = (found.distinct().select("seg", F.explode(kinds).alias("k")).where("k.kind <> 'prefix' or seg <> ''")
                .select("k.*").distinct())
    number = lambda at, n: F.conv(F.substring("digest", at, n), 16, 10).cast("long")
    return (patterns.withColumn("seq", F.explode(F.sequence(F.lit(0), F.lit(3))))
            .withColumn("digest", F.md5(F.concat_ws("|", "kind", "pattern", "seq").cast("binary")))
            .where(number(1, 2) < 128)
            .select("kind", "pattern", (F.lit(CRAWL_START) + number(3, 4) * 480).alias("effective"),
                    F.when(number(7, 1) < 8, "block").when(number(7, 1) < 12, "allow").otherwise("remove").alias("action"),
                    F.col("seq").cast("long").alias("seq")))


def op10_temporal_lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages", "page_id", "url")
    return url_lists.judge(captures(pages), list_entries(pages))


OP10_SQL = f"""
WITH found AS (
  SELECT DISTINCT lower(regexp_extract(url, '^[A-Za-z]+://([^/?#:@]+)', 1)) AS host,
         regexp_extract(url, '^[A-Za-z]+://[^/?#]+/([^/?#]*)/', 1) AS seg FROM pages),
patterns AS (
  SELECT 'host' AS kind, host AS pattern FROM found WHERE host <> ''
  UNION SELECT 'domain', array_to_string(list_slice(string_split(host, '.'), -2, -1), '.') FROM found WHERE host <> ''
  UNION SELECT 'prefix', host || '/' || seg || '/' FROM found WHERE host <> '' AND seg <> ''),
digests AS (
  SELECT kind, pattern, seq, md5(kind || '|' || pattern || '|' || seq) AS d FROM patterns, range(4) r(seq)),
entries AS (
  SELECT kind, pattern, seq, {CRAWL_START} + ('0x' || substr(d, 3, 4))::BIGINT * 480 AS effective,
         CASE WHEN ('0x' || substr(d, 7, 1))::INT < 8 THEN 'block' WHEN ('0x' || substr(d, 7, 1))::INT < 12 THEN 'allow'
              ELSE 'remove' END AS action
  FROM digests WHERE ('0x' || substr(d, 1, 2))::INT < 128),
spans AS (
  SELECT kind, pattern, action, effective AS valid_from,
         lead(effective) OVER (PARTITION BY kind, pattern ORDER BY effective) AS valid_to
  FROM (SELECT kind, pattern, effective, arg_max(action, seq) AS action FROM entries GROUP BY ALL)),
cap AS (
  SELECT row_number() OVER () AS capture, page_id, url, {CRAWL_START} + (page_id * 7919) % {CRAWL_SECONDS} AS fetch_time,
         lower(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://([^/?#:@]+)', 1)) AS host,
         string_split(regexp_extract(coalesce(url, ''), '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]+/([^?#]*)', 1), '/') AS path
  FROM pages),
keys AS (
  SELECT capture, 'host' AS kind, host AS pattern, 500 AS level FROM cap WHERE host <> ''
  UNION ALL SELECT capture, 'domain', array_to_string(list_slice(string_split(host, '.'), -n, -1), '.'), n
    FROM cap, range(2, 20) r(n) WHERE host <> '' AND n <= len(string_split(host, '.'))
  UNION ALL SELECT capture, 'prefix', host || '/' || array_to_string(list_slice(path, 1, n), '/') || '/', 1000 + n
    FROM cap, range(1, 3) r(n) WHERE host <> '' AND n < len(path)),
hits AS (
  SELECT k.capture, k.kind, k.pattern, s.action, s.valid_from,
         row_number() OVER (PARTITION BY k.capture ORDER BY k.level DESC) AS best
  FROM keys k JOIN cap c USING (capture) JOIN spans s ON s.kind = k.kind AND s.pattern = k.pattern
   AND s.valid_from <= c.fetch_time AND (s.valid_to IS NULL OR c.fetch_time < s.valid_to)
  WHERE s.action <> 'remove')
SELECT page_id, url, host, fetch_time, coalesce(action, 'unlisted') AS verdict, kind AS rule_kind, pattern AS rule_pattern,
       valid_from AS rule_from
FROM cap LEFT JOIN (SELECT * FROM hits WHERE best = 1) USING (capture)
"""


def op11_norm_sorted(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inner_products.top_k(table(spark, sf_dir, "embeddings", "vec_id", "embedding"), F.col("vec_id") % 20 == 0)


OP11_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS e
  FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.r, q.vec_id AS query_id, c.vec_id,
         coalesce(list_sum(list_transform(range(1, least(len(q.e), len(c.e)) + 1), lambda i: q.e[i] * c.e[i])), 0)::BIGINT AS score
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0)
SELECT query_id, rank::INT AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id) AS rank FROM scored) WHERE rank <= 20
"""


def op12_max_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents", "doc_id", "text")
    return lexical.search(lexical.index(docs), table(spark, sf_dir, "benchmark", "item_id", "text"))


OP12_SQL = r"""
WITH words AS (
  SELECT d, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM (SELECT row_number() OVER () AS d, doc_id, text FROM documents)),
postings AS (SELECT d, any_value(doc_id) AS doc_id, t, count(*) AS tf FROM words GROUP BY d, t),
docs AS (SELECT d, sum(tf)::BIGINT AS n FROM postings GROUP BY d),
total AS (SELECT count(*) AS big_n, sum(n)::BIGINT AS big_l FROM docs),
weight AS (SELECT t, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)::DOUBLE))::BIGINT AS w
           FROM (SELECT t, count(*) AS df FROM postings GROUP BY t), total),
items AS (
  SELECT i, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
         '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM (SELECT row_number() OVER () AS i, item_id, text FROM benchmark)),
asked AS (SELECT i, any_value(item_id) AS item_id, t, count(*) AS repeats FROM items GROUP BY i, t),
scored AS (
  SELECT i, any_value(item_id) AS item_id, d, any_value(p.doc_id) AS doc_id,
         sum(repeats * w * ((1000000000 * tf) // (1000 * tf + 12 * (100 - 25 + (25 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN postings p USING (t) JOIN weight USING (t) JOIN docs USING (d), total GROUP BY i, d)
SELECT item_id, rank::INT AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id) AS rank FROM scored WHERE score > 0) WHERE rank <= 20
"""


def op13_reduced_alphabet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.grouped(table(spark, sf_dir, "documents", "doc_id", "text"))


OP13_SQL = r"""
WITH RECURSIVE byte_codes AS (
  SELECT list(list_reduce(range(8), lambda c, k: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b::BIGINT) ORDER BY b) AS codes
  FROM range(256) r(b)),
runs AS (
  SELECT doc_id, run, count(*) AS n FROM (
    SELECT row_number() OVER () AS d, doc_id,
           unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-zÀ-ÿ]+')) AS run
    FROM documents) WHERE length(run) >= 6 GROUP BY doc_id, run),
digested AS (
  SELECT run, n, xor(4294967295::BIGINT, list_reduce(list_transform(range(octet_length(s)), lambda k: ('0x' || substr(hex(s), 2 * k + 1, 2))::BIGINT),
         lambda c, b: xor(c >> 8, codes[(xor(c, b) & 255) + 1]), 4294967295::BIGINT)) AS h
  FROM (SELECT run, n, encode(coalesce(doc_id::VARCHAR, '') || ':' || run) AS s FROM runs), byte_codes),
words AS (
  SELECT word, sum(n)::BIGINT AS n FROM (
    SELECT CASE WHEN h % 199 = 0 THEN substr(run, 1, (h % length(run))::BIGINT) || substr(run, (h % length(run))::BIGINT + 2) ELSE run END AS word, n
    FROM digested) WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
cuts AS (
  SELECT word, n, k, substr(word, 1, k - 1) || substr(word, k + 1) AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS k FROM words)),
near AS (
  SELECT a.word, b.word AS other, b.n AS n_other FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.k = b.k WHERE a.word <> b.word AND length(a.word) = length(b.word)
  UNION SELECT a.word, b.word, b.n FROM cuts a JOIN words b ON a.rest = b.word
  UNION SELECT b.word, a.word, a.n FROM cuts a JOIN words b ON a.rest = b.word),
best AS (SELECT word, count(*) AS n_near, min(struct_pack(less := -n_other, form := other)) AS best FROM near GROUP BY word),
formed AS (
  SELECT w.word, CASE WHEN -best.less >= 5 * n THEN best.form END AS form, n, coalesce(n_near, 0) AS n_near,
         CASE WHEN -best.less >= 5 * n THEN -best.less END AS form_n
  FROM words w LEFT JOIN best b ON w.word = b.word),
chain(word, root, step) AS (
  SELECT word, word, 0 FROM formed UNION ALL
  SELECT c.word, f.form, step + 1 FROM chain c JOIN formed f ON c.root = f.word WHERE f.form IS NOT NULL),
roots AS (SELECT word, arg_max(root, step) AS root FROM chain GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM formed JOIN roots USING (word)
"""


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_line_crf": op1_line_crf,
    "op2_count_vector_join": op2_count_vector_join,
    "op3_suffix_trees": op3_suffix_trees,
    "op4_warc_transactions": op4_warc_transactions,
    "op5_weighted_samples": op5_weighted_samples,
    "op6_sum_of_squares": op6_sum_of_squares,
    "op7_rank_queue_bpe": op7_rank_queue_bpe,
    "op8_bwt_merge": op8_bwt_merge,
    "op9_histogram_sort": op9_histogram_sort,
    "op10_temporal_lists": op10_temporal_lists,
    "op11_norm_sorted": op11_norm_sorted,
    "op12_max_sketches": op12_max_sketches,
    "op13_reduced_alphabet": op13_reduced_alphabet,
    "pipeline": pipeline,
}

#: Not expressible: op1 (a fitted chain), op6 (an online placement), op7 (BPE), op9 (probed boundaries).
ORACLES: dict[str, str] = {"op10_temporal_lists": OP10_SQL, "op11_norm_sorted": OP11_SQL, "op12_max_sketches": OP12_SQL,
                           "op13_reduced_alphabet": OP13_SQL}


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLES)
