"""The queries of this subpackage, over whole tables with production parameters, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import bpe, class_lm, jaccard_join, language_crf, mixing, near_vectors, packing, pii, prefix_trie, telephony, token_alignment, token_files, warc
from tidemark.llm.shared import fresh_dir, table, written

TOKENIZERS = None  # folder of the tokenizers' files; None: that of the installed package
PII_KEY = "documents-2024"
BYTE_BPE_END, WORD_BPE_END, WORD_BPE_IDS = 2, 1, 49_408
PACK_CAPACITY = 1024


JACCARD_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, (SELECT min(b) FROM reach WHERE a = doc_id)) AS component_id FROM sets"""


WARC_SQL = """
WITH payloads AS (SELECT page_id, coalesce(html, '') AS p, sha1(coalesce(html, '')) AS h FROM pages),
firsts AS (SELECT *, min(page_id) OVER (PARTITION BY p) AS first FROM payloads)
SELECT page_id, octet_length(encode(p))::BIGINT AS payload_bytes,
  array_to_string(list_transform(range(32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (((('0x' || substr(h, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::INT, 1)), '') AS payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN page_id > first THEN first END AS refers_to FROM firsts"""

VECTORS_SQL = """
WITH RECURSIVE v AS (SELECT vec_id, label, list_transform(embedding, lambda x: x::DOUBLE) AS x FROM embeddings WHERE label IS NOT NULL AND embedding IS NOT NULL),
links AS (
  SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id
  WHERE list_dot_product(a.x, b.x) >= 0.93 * sqrt(list_dot_product(a.x, a.x)) * sqrt(list_dot_product(b.x, b.x)) AND list_dot_product(a.x, a.x) > 0 AND list_dot_product(b.x, b.x) > 0),
reach AS (SELECT a, b FROM links UNION SELECT reach.a, links.b FROM reach JOIN links ON reach.b = links.a)
SELECT vec_id, (SELECT count(*) FROM links WHERE a = vec_id)::BIGINT AS n_links, least(vec_id, (SELECT min(b) FROM reach WHERE a = vec_id)) AS component_id,
  vec_id = least(vec_id, (SELECT min(b) FROM reach WHERE a = vec_id)) AS kept FROM embeddings"""

TRIE_SQL = r"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS pos,
    sha256(octet_length(encode(coalesce(role, '')))::VARCHAR || ' ' || coalesce(role, '') || coalesce(text, '')) AS label,
    len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS words FROM conversations WHERE conv_id IS NOT NULL),
bits AS (
  SELECT DISTINCT conv_id, list_reduce(list_prepend(4294967295, flatten(list_transform(string_split(conv_id::VARCHAR, ''),
    lambda c: [ascii(c)::BIGINT, -1, -1, -1, -1, -1, -1, -1, -1]))), lambda c, b: CASE WHEN b >= 0 THEN xor(c, b) ELSE xor(c >> 1, (c & 1) * 3988292384) END) AS crc FROM turns),
convs AS (SELECT conv_id, (xor(crc, 4294967295) & 3) AS head, conv_id - conv_id % 20 AS first FROM bits),
sizes AS (SELECT conv_id AS first, count(*) AS own FROM turns GROUP BY conv_id),
rebuilt AS (
  SELECT c.conv_id, t.pos, t.label, t.words FROM convs c JOIN turns t ON t.conv_id = c.first AND t.pos <= c.head
  UNION ALL SELECT c.conv_id, t.pos - c.head + least(c.head, coalesce(s.own, 0)), t.label, t.words
  FROM convs c JOIN turns t ON t.conv_id = c.conv_id AND t.pos > c.head LEFT JOIN sizes s ON s.first = c.first),
keys AS (
  SELECT conv_id, pos, words, string_agg(label, '') OVER (PARTITION BY conv_id ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS key FROM rebuilt
  UNION ALL SELECT conv_id, 0, 0, '' FROM convs),
lasts AS (SELECT conv_id, max(pos) AS n FROM keys GROUP BY conv_id),
nodes AS (
  SELECT key, k.pos AS depth, min(k.conv_id) AS conv_id, count(*) AS n_convs, min(words) AS words, string_agg(CASE WHEN k.pos = n THEN k.conv_id::VARCHAR END, ',' ORDER BY k.conv_id) AS ends
  FROM keys k JOIN lasts l ON k.conv_id = l.conv_id GROUP BY key, k.pos),
counts AS (SELECT left(key, 64 * (depth - 1)::INT) AS key, count(*) AS n_children FROM nodes WHERE depth > 0 GROUP BY 1),
whole AS (SELECT n.*, coalesce(n_children, 0) AS n_children FROM nodes n LEFT JOIN counts c ON n.key = c.key),
above AS (SELECT left(key, 64 * i::INT) AS key, sum((n_convs - 1) * words) AS saved, sum(CASE WHEN n_children = 0 THEN 1 ELSE 0 END) AS leaves
  FROM (SELECT key, n_convs, words, n_children, unnest(range(0, depth + 1)) AS i FROM whole) GROUP BY 1)
SELECT w.conv_id, w.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, w.n_convs::BIGINT AS n_convs, w.n_children::BIGINT AS n_children, a.leaves::BIGINT AS n_leaves,
  a.saved::BIGINT AS saved_tokens, sha256(coalesce(w.ends, '')) AS ends_sha256
FROM whole w JOIN above a ON w.key = a.key LEFT JOIN nodes p ON w.depth > 0 AND p.key = left(w.key, 64 * (w.depth - 1)::INT)"""


def tokenizer_path(name: str) -> str:
    if TOKENIZERS:
        return f"{TOKENIZERS}/{name}"
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_pii_pseudonyms(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return pii.pseudonymised(docs, PII_KEY, count_col="n_replaced")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_components(table(spark, sf_dir, "documents"))


def op3_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    form = token_files.TokenFormat(tokenizer_path("word_bpe_49k.json"), False, WORD_BPE_END, WORD_BPE_IDS)
    docs = table(spark, sf_dir, "documents")
    shards = written(token_files.write_shards(docs, fresh_dir(spark, "tokens"), form), "shards")
    return token_files.read_documents(spark, token_files.with_bases(shards), form)


def op4_warc_archives(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = warc.with_revisits(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "page_id", "html")
    archives = written(warc.write_archives(pages, fresh_dir(spark, "warc")), "archives")
    number = lambda c: F.when(F.col(c) != "null", F.col(c)).cast("long")
    return warc.read_archives(spark, archives, payloads=False).select(number("record_id").alias("page_id"), "payload_bytes", "payload_digest", "record_type", number("refers_to").alias("refers_to"))


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pieces_of(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), BYTE_BPE_END, PACK_CAPACITY)
    return packing.pack(pieces, PACK_CAPACITY)


def op6_telephony_media(spark: SparkSession, sf_dir: str) -> DataFrame:
    media = written(telephony.to_media(table(spark, sf_dir, "documents")), "media", "zstd", 11)
    return telephony.with_features(written(telephony.to_sound(media, 2 * telephony.RATE, telephony.LIFTED), "sound", "zstd", 11))


def op7_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_report(table(spark, sf_dir, "documents"))


def op8_near_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_vectors.near_vectors(table(spark, sf_dir, "embeddings"))


def op9_language_crf(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 4 == 2, F.lit(False))
    model = language_crf.train(docs.filter(~held_out))
    return language_crf.predict(docs, model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op10_class_lm(spark: SparkSession, sf_dir: str) -> DataFrame:
    return class_lm.scored(table(spark, sf_dir, "documents"), F.crc32(F.col("doc_id").cast("string")) % 7 == 2)


def op11_bpe_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = tokenizer_path("word_bpe_49k.json")
    texts = bpe.decode(bpe.encode(table(spark, sf_dir, "documents").select("doc_id", "text"), path).drop("text"), path)
    return texts.select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"), F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.turns_of(table(spark, sf_dir, "conversations"))
    return prefix_trie.prefix_trie(*prefix_trie.rebuilt(turns))


def op13_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_alignment.aligned(table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), tokenizer_path("piece_bpe_32k.model"))


OPERATORS = [
    op1_pii_pseudonyms, op2_jaccard_join, op3_token_files, op4_warc_archives, op5_best_fit_packing, op6_telephony_media, op7_source_mixing,
    op8_near_vectors, op9_language_crf, op10_class_lm, op11_bpe_round_trip, op12_conversation_trie, op13_token_alignment,
]


def queries() -> dict:
    return {f.__name__: f for f in OPERATORS}


def oracle_sql() -> dict[str, str]:
    return {"op2_jaccard_join": JACCARD_SQL, "op4_warc_archives": WARC_SQL, "op8_near_vectors": VECTORS_SQL, "op7_source_mixing": mixing.report_sql(), "op12_conversation_trie": TRIE_SQL}
