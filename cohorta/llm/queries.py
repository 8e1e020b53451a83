"""Registered queries of this subpackage and the SQL that checks them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohorta.llm.common import held_out, load

def op1_lm_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Score of every document by a network that has seen four fifths of them."""
    from cohorta.llm.recurrent import score

    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    found = score(docs, ~held_out("doc_id", 5))
    return found.select(
        "doc_id",
        held_out("doc_id", 5).alias("held_out"),
        "n_tokens",
        "n_known",
        "train_tokens",
        "base_score",
        "score",
    )


WORDS_SQL = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
FOLD_SQL = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Benchmark passages in every document."""
    from cohorta.llm.contamination import contaminated, find_contamination

    found = find_contamination(
        load(spark, sf_dir, "documents", "doc_id", "text"), load(spark, sf_dir, "benchmark", "item_id", "text")
    )
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("item_ids").cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", F.array_sort("item_ids")), 256).alias("items_sha256"),
        contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


OP2_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all({FOLD_SQL.format("coalesce(text, '')")}, '{WORDS_SQL}') AS w
  FROM documents
),
b AS (
  SELECT item_id::VARCHAR AS item, regexp_extract_all({FOLD_SQL.format("coalesce(text, '')")}, '{WORDS_SQL}') AS w
  FROM benchmark
),
phrase AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, list_slice(w, i, i + least(13, len(w)) - 1) AS words
  FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS t(i)
  WHERE len(w) > 0 AND item IS NOT NULL
),
doc_window AS (
  SELECT row_no, n, i, list_slice(w, i, i + n - 1) AS words
  FROM d, (SELECT DISTINCT n FROM phrase) AS s, unnest(range(1, len(w) - n + 2)) AS t(i)
),
hit AS (
  SELECT row_no, i, doc_window.n, item FROM doc_window JOIN phrase
    ON doc_window.n = phrase.n AND doc_window.words = phrase.words
),
hit_words AS (
  SELECT row_no, count(DISTINCT p) AS n_hit
  FROM (SELECT DISTINCT row_no, i, n FROM hit), unnest(range(i, i + n)) AS t(p) GROUP BY row_no
),
hit_items AS (
  SELECT row_no, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT row_no, item FROM hit) GROUP BY row_no
)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(items, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit_words USING (row_no) LEFT JOIN hit_items USING (row_no)
"""

def op3_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document, learned from the two thirds that are not held out."""
    from cohorta.llm.language import fit, predict

    docs = load(spark, sf_dir, "documents", "doc_id", "text", "lang")
    model = fit(docs.where(~held_out("doc_id", 3)))
    return predict(docs.select("doc_id", "text"), model).select(
        "doc_id", held_out("doc_id", 3).alias("held_out"), "lang_pred", "score"
    )


def op4_byte_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token ids of every document and the bytes they decode to, as digests."""
    import public_tokenizers

    from cohorta.llm.bytepairs import encode_digests

    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    ranks = public_tokenizers.path("byte_bpe_50k.tiktoken")
    return encode_digests(docs, ranks, public_tokenizers.PATTERN).drop("text")


def op5_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Secrets in every document."""
    from cohorta.llm.secret_scan import find_secrets, train

    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    return find_secrets(docs, train(docs)).select(
        "doc_id",
        "n_assign",
        "n_access",
        "n_hex",
        F.sha2(F.concat_ws(",", "base_spans"), 256).alias("base_sha256"),
        F.concat_ws(",", "spans").alias("spans"),
    )


def op6_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Eight shards of near equal bytes, tokens and rows."""
    from cohorta.llm.shards import assign_shards

    placed = assign_shards(load(spark, sf_dir, "documents", "doc_id", "text"), 8)
    return placed.select(
        "doc_id",
        F.col("bytes").alias("size"),
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
        "tokens",
    )


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    from cohorta.llm.warc import round_trip

    return round_trip(load(spark, sf_dir, "pages", "page_id", "url", "html"))


# Five hex digits are four base32 digits.
OP7_SQL = r"""
WITH p AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(encode(coalesce(html, ''))) AS h FROM pages
),
d AS (
  SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
           ((('0x' || substr(h, 1 + 5 * (i // 4)::INTEGER, 5))::INTEGER >> (15 - 5 * (i % 4))::INTEGER) & 31) + 1, 1)), '') AS payload_digest
  FROM p
),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_id IS NOT NULL AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""


def op8_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of near copies of every document."""
    from cohorta.llm.near_copies import near_duplicates

    found = near_duplicates(load(spark, sf_dir, "documents", "doc_id", "text"))
    return found.select("doc_id", "class_id", "n_links", F.col("first").alias("kept"))


def op9_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality measures and verdict of every document."""
    from cohorta.llm.quality import judge

    return judge(load(spark, sf_dir, "documents", "doc_id", "text")).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "posterior",
    )


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class of every line of 20 characters or more."""
    from cohorta.llm.lines import line_classes

    return line_classes(load(spark, sf_dir, "documents", "doc_id", "text")).drop("tkey")


OP10_SQL = r"""
WITH RECURSIVE
place AS (
  SELECT doc_id, md5(text) AS tkey, n - 1 AS line_no, string_split(text, chr(10))[n] AS line
  FROM documents, unnest(range(1, len(string_split(text, chr(10))) + 1)) AS t(n)
),
line AS (SELECT line, length(line) AS n, string_split(line, '') AS c FROM (SELECT DISTINCT line FROM place WHERE length(line) >= 20)),
meet AS (
  SELECT a.line AS a, b.line AS b, b.n - a.n AS more,
         coalesce(list_position(list_transform(range(1, a.n + 1), lambda i: a.c[i] = b.c[i]), false), a.n + 1) AS k
  FROM line a JOIN line b ON b.n = a.n AND a.line < b.line OR b.n = a.n + 1
),
link AS (
  SELECT a, b FROM meet
  WHERE more = 0 AND substr(a, k + 1) = substr(b, k + 1) OR more = 1 AND substr(a, k) = substr(b, k + 1)
),
ways AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT a AS line, a AS other FROM ways UNION SELECT reach.line, ways.b FROM reach JOIN ways ON ways.a = reach.other),
class AS (SELECT line, min(other) AS class FROM reach GROUP BY line),
degree AS (SELECT a AS line, count(*) AS n_links FROM ways GROUP BY a),
marked AS (
  SELECT place.*, coalesce(class, place.line) AS class, coalesce(n_links, 0) AS n_links
  FROM place LEFT JOIN class USING (line) LEFT JOIN degree ON degree.line = place.line WHERE length(place.line) >= 20
)
SELECT doc_id, line_no::INTEGER AS line_no,
       first_value(doc_id) OVER w AS class_doc_id, first_value(line_no) OVER w AS class_line_no,
       n_links, row_number() OVER w = 1 AS kept
FROM marked WINDOW w AS (PARTITION BY class ORDER BY doc_id, tkey, line_no)
"""

def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of the embeddings whose id is divisible by 50."""
    from cohorta.llm.negatives import mine

    rows = load(spark, sf_dir, "embeddings", "vec_id", "embedding", "label")
    moved = F.when(F.col("vec_id") % 7 == 0, F.pmod(F.col("label") + 1, F.lit(10))).otherwise(F.col("label"))
    return mine(rows, F.col("vec_id") % 50 == 0, "vec_id", moved, "embedding")


OP11_SQL = r"""
WITH r AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM r AS a JOIN r AS b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
p AS (
  SELECT a, b AS positive, score AS ps FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5
)
SELECT a AS anchor_id, positive AS positive_id,
       row_number() OVER (PARTITION BY a, positive ORDER BY score DESC, b)::INTEGER AS rank,
       b AS negative_id, ps AS positive_score, score AS negative_score
FROM p JOIN s USING (a) WHERE NOT same AND 50 * ps <= 100 * score AND 100 * score <= 95 * ps
QUALIFY rank <= 3
"""

def op12_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every page."""
    from cohorta.llm.html_text import extract

    return extract(load(spark, sf_dir, "pages", "page_id", "url", "html")).drop("html")


# The given pages mark their article; in them a block is what stands between tags of blocks.
OP12_SQL = r"""
WITH a AS (
  SELECT page_id, url, row_number() OVER () AS row_no,
         regexp_replace(regexp_extract(coalesce(html, ''), '(?s)<article[^>]*>(.*?)</article>', 1), '(?s)<!--.*?-->', '', 'g') AS body
  FROM pages
),
block AS (
  SELECT row_no, unnest(range(1, len(raws) + 1)) AS n, unnest(raws) AS raw
  FROM (SELECT row_no, string_split_regex(body, '(?i)</?(?:p|h[1-6]|div|ul|li)(?:\s[^>]*)?>') AS raws FROM a)
),
line AS (
  SELECT row_no, n, replace(replace(replace(replace(replace(replace(
           regexp_replace(regexp_replace(raw, '(?i)<br\s*/?>', ' ', 'g'), '<[^>]*>', '', 'g'),
           '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&copy;', chr(169)), '&amp;', '&') AS t
  FROM block
),
clean AS (SELECT row_no, n, trim(regexp_replace(t, '\s+', ' ', 'g')) AS t FROM line),
whole AS (SELECT row_no, string_agg(t, chr(10) ORDER BY n) AS text FROM clean WHERE t <> '' GROUP BY row_no)
SELECT page_id, url, coalesce(text, '') AS text, length(coalesce(text, ''))::BIGINT AS n_chars FROM a LEFT JOIN whole USING (row_no)
"""

def op13_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 20 best documents for every benchmark item."""
    from cohorta.llm.ranked_search import search

    docs = load(spark, sf_dir, "documents", "doc_id", "text")
    return search(docs, load(spark, sf_dir, "benchmark", "item_id", "text"))


OP13_SQL = rf"""
WITH d AS (
  SELECT doc_id, row_number() OVER () AS row_no,
         regexp_extract_all({FOLD_SQL.format("coalesce(text, '')")}, '{WORDS_SQL}') AS w
  FROM documents
),
b AS (
  SELECT item_id, row_number() OVER () AS item_no,
         regexp_extract_all({FOLD_SQL.format("coalesce(text, '')")}, '{WORDS_SQL}') AS w
  FROM benchmark
),
total AS (SELECT count(*)::BIGINT AS n, sum(len(w))::BIGINT AS l FROM d WHERE len(w) > 0),
want AS (SELECT item_no, term, count(*) AS times FROM (SELECT item_no, unnest(w) AS term FROM b) GROUP BY ALL),
has AS (
  SELECT row_no, term, count(*)::BIGINT AS tf FROM (SELECT row_no, unnest(w) AS term FROM d)
  WHERE term IN (SELECT term FROM want) GROUP BY ALL
),
weight AS (
  SELECT term, floor(1000 * ln((2 * n + 2)::DOUBLE / (2 * count(*) + 1)))::BIGINT AS w FROM has, total GROUP BY term, n
),
long AS (SELECT row_no, 100 - 25 + (25 * len(w) * n) // l AS m FROM d, total WHERE len(w) > 0),
scored AS (
  SELECT item_no, row_no, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM has JOIN weight USING (term) JOIN long USING (row_no) JOIN want USING (term) GROUP BY ALL
)
SELECT item_id, row_number() OVER (PARTITION BY item_no ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank, doc_id, score
FROM scored JOIN d USING (row_no) JOIN b USING (item_no) WHERE score > 0 QUALIFY rank <= 20
"""

QUERIES = {
    "op1_lm_scores": op1_lm_scores,
    "op2_decontamination": op2_decontamination,
    "op3_language": op3_language,
    "op4_byte_pairs": op4_byte_pairs,
    "op5_secrets": op5_secrets,
    "op6_shards": op6_shards,
    "op7_warc": op7_warc,
    "op8_near_duplicates": op8_near_duplicates,
    "op9_quality": op9_quality,
    "op10_line_dedup": op10_line_dedup,
    "op11_hard_negatives": op11_hard_negatives,
    "op12_main_text": op12_main_text,
    "op13_ranked_search": op13_ranked_search,
}
ORACLES = {
    "op2_decontamination": OP2_SQL,
    "op7_warc": OP7_SQL,
    "op10_line_dedup": OP10_SQL,
    "op11_hard_negatives": OP11_SQL,
    "op12_main_text": OP12_SQL,
    "op13_ranked_search": OP13_SQL,
}
