"""The registered queries of the training-data operators and, where SQL can say it, their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from circulation.llm import (
    conversations,
    decontam,
    lm,
    minhash,
    packing,
    pii,
    quality,
    ranked_search,
    sharding,
    token_matrix,
    toxicity,
    url_filter,
    warc,
)
from circulation.llm.common import bound_memory, written
from circulation.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ensure_checkpoint_dir(spark)
    bound_memory(spark)
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def op1_bbit_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text"), n=4)


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.token_pieces(table(spark, sf_dir, "documents"))
    slim = pieces.select("doc_id", "piece", "start", "length", F.crc32("ids").alias("ids_crc32"))
    return packing.best_fit_pack(slim, ["doc_id", "piece", "ids_crc32"])


def op3_mcd_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang", "source")
    stats = quality.with_statistics(docs).drop("text")
    return quality.verdicts(stats).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "d2")


def op4_deleted_interpolation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.interpolated_scores(table(spark, sf_dir, "documents").select("doc_id", "text"), order=3, octave=2)


def op5_byte_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", sharding.row_size("text").alias("size"),
        F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary")).alias("text_crc32"))
    dealt = sharding.shard_by_bytes(docs, "size", ["doc_id", "text_crc32", "size"], n_shards=40)
    return dealt.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


def op6_token_matrices(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_matrix.write_matrices(token_matrix.pack_matrices(table(spark, sf_dir, "documents")))
    return token_matrix.read_matrices(spark, path).select(
        "matrix", "row", "n_tokens", F.size("doc_ids").alias("n_segments"), F.crc32("ids").alias("ids_crc32"),
        F.crc32("positions").alias("positions_crc32"), "cu_seqlens", "doc_ids", "starts")


def op7_feistel_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.pseudonymised(table(spark, sf_dir, "documents").select("doc_id", "text"))


URL_RULES = [
    url_filter.Rule("allow", "com", "/"), url_filter.Rule("block", "example.com", "/en/"),
    url_filter.Rule("allow", "www.example.com", "/en/"), url_filter.Rule("block", "net", "/es/"),
    url_filter.Rule("block", "net", "/fr/"),
]


# The words of a host's name for which its keys are listed.
SPAM_HOST = r"(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)"


def spam_list(pages: DataFrame) -> DataFrame:
    """A list table that grows with the corpus: the keys (host and path) of hosts with a spam word in their name."""
    return url_filter.with_url_key(pages.select("url")).where(F.col("host").rlike(SPAM_HOST)).select("url_key")


def op8_bloom_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = written(spam_list(pages), "url-list")
    universe = url_filter.marked_universe(url_filter.with_url_key(pages), listed, "url_key")
    levels = url_filter.build_cascade(universe, "url_key", "listed")
    judged = url_filter.judge_urls(pages, URL_RULES, levels)
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op9_latent_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    marked = decontam.marked(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"]).select("doc_id", F.explode("leaks").alias("x"))
    return marked.select("doc_id", "x.item_id", "x.lcs_words", "x.item_words", "x.answer_found", "x.cosine")


def op10_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    captures = warc.write_archives(table(spark, sf_dir, "pages").select("page_id", "url", "html"))
    places = warc.look_up(captures, warc.build_index(captures))
    return warc.read_records(places, with_payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op11_norm_bucket_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.ranked_search(table(spark, sf_dir, "documents").select("doc_id", "text"),
                                       table(spark, sf_dir, "benchmark"), k=50)


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = conversations.damaged(table(spark, sf_dir, "conversations"), "present")
    return conversations.repair(rows, "present").select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")


def op13_gated_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    scored = toxicity.score(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))
    held_out = F.coalesce(toxicity.remainder(F.col("doc_id")) == 0, F.lit(False))
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
                         "window_start")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_bbit_minhash": op1_bbit_minhash,
    "op2_best_fit_packing": op2_best_fit_packing,
    "op3_mcd_quality": op3_mcd_quality,
    "op4_deleted_interpolation": op4_deleted_interpolation,
    "op5_byte_shards": op5_byte_shards,
    "op6_token_matrices": op6_token_matrices,
    "op7_feistel_pseudonyms": op7_feistel_pseudonyms,
    "op8_bloom_cascade": op8_bloom_cascade,
    "op9_latent_decontamination": op9_latent_decontamination,
    "op10_warc_index": op10_warc_index,
    "op11_norm_bucket_search": op11_norm_bucket_search,
    "op12_conversation_repair": op12_conversation_repair,
    "op13_gated_toxicity": op13_gated_toxicity,
}


OP1_SQL = r"""
WITH RECURSIVE split AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'),
      lambda x: x <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, list_distinct(CASE
      WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM split
), grams AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS k
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM shared WHERE 100 * k >= 80 * (na + nb - k)
), reach AS (
  SELECT doc_id, doc_id AS r FROM documents
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.r = links.a
), component AS (
  SELECT doc_id, min(r) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept
FROM sets JOIN component USING (doc_id)
"""
OP10_SQL = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, ''))::BIGINT AS payload_bytes, sha1(coalesce(html, '')) AS s,
         min(page_id) OVER (PARTITION BY sha1(coalesce(html, ''))) AS first
  FROM pages
), bits AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i: substr(
      '0000000100100011010001010110011110001001101010111100110111101111',
      4 * (instr('0123456789abcdef', substr(s, i, 1)) - 1) + 1, 4)), '') AS b
  FROM hashed
)
SELECT page_id, payload_bytes, array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
         1 + 16 * substr(b, 5 * i + 1, 1)::INTEGER + 8 * substr(b, 5 * i + 2, 1)::INTEGER + 4 * substr(b, 5 * i + 3, 1)::INTEGER
           + 2 * substr(b, 5 * i + 4, 1)::INTEGER + substr(b, 5 * i + 5, 1)::INTEGER, 1)), '') AS payload_digest,
       CASE WHEN page_id = first THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first THEN first END AS refers_to
FROM bits
"""
# Sizes, the checksum by its polynomial, and one window sum: the row's midpoint falls into the equal part
# of all bytes that is its shard.
OP5_SQL = """
WITH sized AS (
  SELECT doc_id, strlen(coalesce(text, ''))::BIGINT + 16 AS size,
         regexp_extract_all(hex(encode(coalesce(text, ''))), '..') AS octets
  FROM documents
), summed AS (
  SELECT doc_id, size, xor(list_reduce([4294967295::BIGINT] || list_transform(octets, lambda h: ('0x' || h)::BIGINT),
    lambda c, b: list_reduce([xor(c, b)] || list_transform(range(8), lambda z: 0::BIGINT),
      lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) AS text_crc32
  FROM sized
), placed AS (
  SELECT *, row_number() OVER ahead AS place, sum(size) OVER ahead - size AS before, sum(size) OVER () AS total
  FROM summed WINDOW ahead AS (ORDER BY doc_id NULLS FIRST, text_crc32, size ROWS UNBOUNDED PRECEDING)
), dealt AS (
  SELECT *, least(39, ((2 * before + size) * 40) // (2 * total))::INTEGER AS shard FROM placed
)
SELECT doc_id, size, text_crc32, 'bytes' AS law, shard,
       row_number() OVER (PARTITION BY shard ORDER BY place) - 1 AS slot, NULL::INTEGER AS grown_shard
FROM dealt
"""

OP8_SQL = r"""
WITH parts AS (
  SELECT page_id, CASE WHEN url LIKE '%://%' THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), named AS (
  SELECT page_id,
    translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM parts
), ruled AS (
  SELECT *, CASE
      WHEN (host = 'www.example.com' OR ends_with(host, '.www.example.com')) AND starts_with(path, '/en/') THEN 'www.example.com/en/'
      WHEN (host = 'example.com' OR ends_with(host, '.example.com')) AND starts_with(path, '/en/') THEN 'example.com/en/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/es/') THEN 'net/es/'
      WHEN (host = 'net' OR ends_with(host, '.net')) AND starts_with(path, '/fr/') THEN 'net/fr/'
      WHEN (host = 'com' OR ends_with(host, '.com')) AND starts_with(path, '/') THEN 'com/'
    END AS rule
  FROM named
)
SELECT page_id, host, path, rule, CASE
    WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow'
    WHEN rule IS NOT NULL THEN 'block'
    WHEN regexp_matches(host, '(^|[.-])(ads|adult|bets|casino|pills|spam)([.-]|$)') THEN 'block'
    ELSE 'allow'
  END AS verdict
FROM ruled
"""

OP11_SQL = r"""
WITH docs AS (
  SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), items AS (
  SELECT item_id, row_number() OVER () AS i, unnest(list_distinct(regexp_extract_all(
      translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+'))) AS t
  FROM benchmark
), totals AS (
  SELECT count(*) AS nd, sum(len(w))::BIGINT AS nt FROM docs WHERE len(w) > 0
), counted AS (
  SELECT r, t, count(*) AS tf FROM (SELECT r, unnest(w) AS t FROM docs) GROUP BY r, t
), weights AS (
  SELECT t, floor(1000 * ln((2 * any_value(nd) + 2) / (2 * count(*) + 1)))::BIGINT AS w FROM counted, totals GROUP BY t
), lengths AS (
  SELECT r, doc_id, 100 - 50 + ((50 * len(w)::BIGINT * nd) // nt) AS m FROM docs, totals WHERE len(w) > 0
), scored AS (
  SELECT i, any_value(item_id) AS item_id, r, any_value(doc_id) AS doc_id,
         sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
  FROM items JOIN weights USING (t) JOIN counted USING (t) JOIN lengths USING (r)
  GROUP BY i, r
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY i ORDER BY score DESC, doc_id NULLS LAST)::INTEGER AS rank FROM scored WHERE score > 0
)
SELECT item_id, rank, doc_id, score FROM ranked WHERE rank <= 50
"""


def _op12_sql() -> str:
    """The cheapest edits by a backward recursion over the rows: of each role state (0 nothing, 1 system, 2 user, 3
    assistant) the least string of ten digits of cost and the audit."""
    after, takes = (2, 2, 3, 2), ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})

    def add(state: str, cost: str, edits: str) -> str:
        return f"lpad((substr({state}, 1, 10)::BIGINT + {cost})::VARCHAR, 10, '0') || '{edits}' || substr({state}, 11)"

    taken = []
    for s in range(4):
        kept = " ".join(f"WHEN x = '{x}' THEN {add(f'b{t}', 't', 'K')}" for x, t in takes[s].items())
        taken.append(f"least({add(f'b{s}', '3', 'D')}, CASE WHEN must THEN NULL {kept} END, "
                     f"CASE WHEN NOT must THEN {add(f'b{after[s]}', '(2 + t)', 'R')} END) AS o{s}")
    best = [f"least(o{s}, {add(f'o{after[s]}', '2', 'I')}, {add(f'o{after[after[s]]}', '4', 'II')}) AS b{s}" for s in range(4)]
    return rf"""
WITH RECURSIVE keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS k
  FROM conversations
), hashed AS (
  SELECT *, xor(list_reduce([4294967295::BIGINT] || list_transform(range(1, length(k) + 1), lambda i: ascii(substr(k, i, 1))::BIGINT),
    lambda c, b: list_reduce([xor(c, b)] || list_transform(range(8), lambda z: 0::BIGINT),
      lambda x, z: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)), 4294967295) % 20 AS kind
  FROM keyed
), rows_left AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN kind = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM hashed WHERE kind <> 0
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM rows_left
), coded AS (
  SELECT *, substr(role, 1, 1) AS x, CASE
      WHEN NOT regexp_matches(text, '[^ 	-
]') THEN 'b'
      WHEN row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) > 1 THEN 'd'
      WHEN regexp_extract(text, '([^ 	-
])[ 	-
]*$', 1) NOT IN ('.', '!', '?') THEN 't'
      ELSE 'o' END AS f
  FROM placed
), convs AS (
  SELECT conv_id, row_number() OVER () AS c, count(*) AS n, list(x ORDER BY i) AS xs, list(f ORDER BY i) AS fs,
         list(role ORDER BY i) AS roles, list(text ORDER BY i) AS texts,
         coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps
  FROM coded GROUP BY conv_id
), steps AS (
  SELECT c, n AS i, '0000000000' AS b0, '0000000004II' AS b1, '0000000002I' AS b2, '0000000000' AS b3 FROM convs
  UNION ALL
  SELECT c, i, {', '.join(best)} FROM (
    SELECT c, i, {', '.join(taken)} FROM (
      SELECT steps.c, steps.i - 1 AS i, b0, b1, b2, b3, xs[steps.i] AS x, fs[steps.i] IN ('b', 'd') AS must,
             CASE WHEN fs[steps.i] = 't' THEN 1 ELSE 0 END AS t
      FROM steps JOIN convs USING (c) WHERE steps.i > 0))
), solved AS (
  SELECT c, substr(b0, 1, 10)::BIGINT AS cost, substr(b0, 11) AS audit FROM steps WHERE i = 0
), letters AS (
  SELECT c, audit, unnest(range(1, length(audit) + 1)) AS j FROM solved
), spelled AS (
  SELECT c, j, substr(audit, j, 1) AS edit, length(replace(substr(audit, 1, j), 'I', '')) AS r,
         length(replace(substr(audit, 1, j), 'D', '')) AS p
  FROM letters
), placed_edits AS (
  SELECT *, max(CASE WHEN p = 1 AND edit = 'K' AND xs[r] = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY c) AS sys
  FROM spelled JOIN convs USING (c) WHERE edit <> 'D'
), repaired AS (
  SELECT c, string_agg(CASE WHEN edit = 'K' THEN roles[r] WHEN (p - sys) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                       || CASE WHEN edit = 'I' THEN '' ELSE texts[r] END, chr(10) ORDER BY j) AS whole
  FROM placed_edits GROUP BY c
), answers AS (
  SELECT conv_id, gaps::BIGINT AS gaps, len(list_filter(fs, lambda v: v = 'b'))::BIGINT AS blank,
         len(list_filter(fs, lambda v: v = 'd'))::BIGINT AS duplicate, len(list_filter(fs, lambda v: v = 't'))::BIGINT AS truncated,
         len(list_filter(range(2, n + 1), lambda v: xs[v - 1] || xs[v] NOT IN ('su', 'ua', 'au')))::BIGINT AS illegal,
         cost, audit, sha256(coalesce(whole, '')) AS repaired_sha256
  FROM convs JOIN solved USING (c) LEFT JOIN repaired USING (c)
), every AS (
  SELECT DISTINCT conv_id FROM conversations
)
SELECT every.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate,
       coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal, coalesce(cost, 0)::BIGINT AS cost,
       coalesce(audit, '') AS audit, coalesce(repaired_sha256, sha256('')) AS repaired_sha256
FROM every LEFT JOIN answers ON every.conv_id IS NOT DISTINCT FROM answers.conv_id
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_bbit_minhash": OP1_SQL, "op5_byte_shards": OP5_SQL, "op8_bloom_cascade": OP8_SQL, "op10_warc_index": OP10_SQL,
            "op11_norm_bucket_search": OP11_SQL, "op12_conversation_repair": _op12_sql()}
