"""The operators over the test tables, with their production parameters, and SQL where it can say the same."""

from __future__ import annotations

import string

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from tradewind.llm import merkle, pieces, shards, token_files, warc
from tradewind.llm.exact import ExactDuplicates
from tradewind.llm.language import identify
from tradewind.llm.mixing import mixed
from tradewind.llm.negatives import hard_negatives
from tradewind.llm.packing import pack
from tradewind.llm.quality import judged
from tradewind.llm.repeats import removal_report
from tradewind.llm.simhash import near_duplicates

WORD_BPE = "word_bpe_49k.json"
PIECES = "piece_bpe_32k.model"


def _documents(spark: SparkSession, folder: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/documents.parquet").select("doc_id", "text")


def packing(spark: SparkSession, folder: str) -> DataFrame:
    pieces = pack(_documents(spark, folder), public_tokenizers.path(WORD_BPE), end_id=1, length=2048, with_ids=False)
    return pieces.withColumnRenamed("id", "doc_id")


def token_output(spark: SparkSession, folder: str) -> DataFrame:
    read_back = token_files.round_trip(_documents(spark, folder), public_tokenizers.path(WORD_BPE), end_id=2)
    return read_back.withColumnRenamed("id", "doc_id")


def archives(spark: SparkSession, folder: str) -> DataFrame:
    pages = spark.read.parquet(f"{folder}/pages.parquet")
    return warc.round_trip(pages, least_bytes=0, with_payload=False).select(
        F.col("metadata.page_id").alias("page_id"),
        F.col("response.payload_bytes").alias("payload_bytes"),
        F.col("response.payload_digest").alias("payload_digest"),
        F.col("response.kind").alias("record_type"),
        F.col("response.refers_to").alias("refers_to"),
    )


def quality(spark: SparkSession, folder: str) -> DataFrame:
    found = judged(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select(
        F.col("id").alias("doc_id"),
        *["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"],
    )


def sentencepiece(spark: SparkSession, folder: str) -> DataFrame:
    """The bytes the ids decode to are given by their number and crc32."""
    encoded = pieces.encode(_documents(spark, folder), public_tokenizers.path(PIECES), with_ids=False)
    data = F.col("decoded").cast("binary")
    decoded = [F.octet_length(data).cast("long").alias("decoded_bytes"), F.crc32(data).alias("decoded_crc32")]
    return encoded.select(F.col("id").alias("doc_id"), "n_pieces", "ids_crc32", *decoded)


def exact(spark: SparkSession, folder: str) -> DataFrame:
    found = ExactDuplicates(_documents(spark, folder)).membership()
    return found.select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256")
    )


def simhash(spark: SparkSession, folder: str) -> DataFrame:
    found = near_duplicates(_documents(spark, folder), width=3)
    return found.select(F.col("id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def language(spark: SparkSession, folder: str) -> DataFrame:
    found = identify(spark.read.parquet(f"{folder}/documents.parquet"))
    return found.select(F.col("id").alias("doc_id"), "held_out", "lang_pred", "score", "rejected")


def sharding(spark: SparkSession, folder: str) -> DataFrame:
    placed = shards.with_slots(shards.assign(_documents(spark, folder), 40))
    return placed.select(
        F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard"
    )


def suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return removal_report(_documents(spark, folder)).withColumnRenamed("id", "doc_id")


def merkle_manifest(spark: SparkSession, folder: str) -> DataFrame:
    """Every fifth document or so, by the crc32 of its id, is tampered with: A-Z of its text in lower case."""
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    lowered = {"text": F.translate("text", string.ascii_uppercase, string.ascii_lowercase)}
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
    found = merkle.verified(docs, ["doc_id", "source", "lang", "n_chars", "text"], lowered, tampered)
    return found.withColumnRenamed("id", "doc_id")


def hard_negative_mining(spark: SparkSession, folder: str) -> DataFrame:
    """Labels of every seventh id are moved on by one, so that near copies are labelled otherwise."""
    vectors = spark.read.parquet(f"{folder}/embeddings.parquet")
    moved = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    mined = hard_negatives(vectors, anchor=F.col("vec_id") % 100 == 0, label=moved)
    scores = {c: F.col(c).try_cast("long") for c in ("positive_score", "negative_score")}
    return mined.withColumns(scores)


def mixing(spark: SparkSession, folder: str) -> DataFrame:
    mix = mixed(spark.read.parquet(f"{folder}/documents.parquet"), weights=(1, 2, 3), most=3)
    return mix.withColumnRenamed("id", "doc_id")


QUERIES = {
    "op1_packing": packing,
    "op2_token_files": token_output,
    "op3_warc": archives,
    "op4_quality_rules": quality,
    "op5_sentencepiece": sentencepiece,
    "op6_exact_dedup": exact,
    "op7_simhash": simhash,
    "op8_language_id": language,
    "op9_sharding": sharding,
    "op10_suffix_dedup": suffix_dedup,
    "op11_merkle_manifest": merkle_manifest,
    "op12_hard_negatives": hard_negative_mining,
    "op13_mixing": mixing,
}

# SHA-1 in base32: five bits a letter, four letters from five hex digits.
BASE32 = """array_to_string([substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
    (((('0x' || substr(hex, (i // 4) * 5 + 1, 5))::BIGINT >> (15 - 5 * (i % 4))) & 31) + 1)::INT, 1) for i in range(0, 32)], '')"""

ORACLES = {
    "op3_warc": f"""
        SELECT page_id, strlen(body) AS payload_bytes, {BASE32} AS payload_digest,
               CASE WHEN page_id = first_id THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_id THEN first_id END AS refers_to
        FROM (SELECT page_id, body, sha1(body) AS hex, min(page_id) OVER (PARTITION BY body) AS first_id
              FROM (SELECT page_id, coalesce(html, '') AS body FROM pages))
    """,
    "op6_exact_dedup": """
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(body) AS text_sha256
        FROM (SELECT doc_id, coalesce(text, '') AS body, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size
              FROM documents WINDOW same AS (PARTITION BY coalesce(text, '')))
    """,
    # Bytes are pairs of hex digits. Windows that repeat are islands of covered bytes; what lies between is kept.
    "op10_suffix_dedup": """
        WITH texts AS (
            SELECT doc_id, hex(encode(coalesce(text, ''))) AS digits FROM documents),
        windows AS (
            SELECT doc_id, s, substr(digits, 2 * s + 1, 200) AS w
            FROM (SELECT doc_id, digits, unnest(range(0, length(digits) // 2 - 99)) AS s FROM texts WHERE length(digits) >= 200)),
        repeats AS (
            SELECT doc_id, s FROM windows QUALIFY row_number() OVER (PARTITION BY w ORDER BY doc_id, s) > 1),
        marked AS (
            SELECT doc_id, s, coalesce(s > lag(s) OVER (PARTITION BY doc_id ORDER BY s) + 100, true) AS fresh FROM repeats),
        islands AS (
            SELECT doc_id, s, count(*) FILTER (fresh) OVER (PARTITION BY doc_id ORDER BY s) AS island FROM marked),
        spans AS (
            SELECT doc_id, min(s) AS b, max(s) + 100 AS e FROM islands GROUP BY doc_id, island),
        gaps AS (
            SELECT doc_id, coalesce(lag(e) OVER (PARTITION BY doc_id ORDER BY b), 0) AS b, b AS e FROM spans
            UNION ALL
            SELECT doc_id, coalesce(max(e), 0), max(length(digits) // 2) FROM texts LEFT JOIN spans USING (doc_id) GROUP BY doc_id),
        kept AS (
            SELECT doc_id, string_agg(substr(digits, 2 * b + 1, 2 * (e - b)), '' ORDER BY b) AS digits
            FROM texts JOIN gaps USING (doc_id) GROUP BY doc_id),
        sums AS (SELECT doc_id, sum(e - b) AS removed, count(*) AS n FROM spans GROUP BY doc_id)
        SELECT t.doc_id, length(t.digits) // 2 AS n_bytes, coalesce(removed, 0)::BIGINT AS n_removed,
               coalesce(n, 0) AS n_spans, sha256(unhex(k.digits)) AS kept_sha256
        FROM texts t JOIN kept k USING (doc_id) LEFT JOIN sums USING (doc_id)
    """,
    # crc32 bit by bit; both trees and the climb from leaf to root as recursions.
    "op11_merkle_manifest": """
        WITH RECURSIVE fields AS (
            SELECT doc_id, source,
                   [doc_id::VARCHAR, source, lang, n_chars::VARCHAR] AS short, text,
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS lowered,
                   list_reduce([4294967295] || list_transform(range(1, length(doc_id::VARCHAR) + 1), lambda i: ord(substr(doc_id::VARCHAR, i::INT, 1))::BIGINT),
                       lambda c, b: list_reduce([xor(c, b)] || range(0, 8),
                           lambda x, i: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END)) AS crc
            FROM documents),
        leaves AS (
            SELECT doc_id, source, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS leaf,
                   CASE WHEN xor(crc, 4294967295) % 5 = 0 THEN sha256(head || coalesce(strlen(lowered) || ':' || lowered, '-'))
                        ELSE sha256(head || coalesce(strlen(text) || ':' || text, '-')) END AS now
            FROM (SELECT *, list_aggregate(list_transform(short, lambda v: coalesce(strlen(v) || ':' || v, '-')), 'string_agg', '') AS head FROM fields)),
        placed AS (
            SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1 AS pos, count(*) OVER (PARTITION BY source) AS n FROM leaves),
        lower_tree AS (
            SELECT coalesce('=' || source, '') AS grp, 0 AS level, pos, n, leaf AS node FROM placed
            UNION ALL
            SELECT grp, level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
            FROM lower_tree WHERE n > 1 GROUP BY grp, level, pos // 16),
        subroots AS (
            SELECT grp, node, level, row_number() OVER (ORDER BY encode(grp)) - 1 AS place, count(*) OVER () AS n FROM lower_tree WHERE n = 1),
        upper_tree AS (
            SELECT 0 AS level, place AS pos, n, node FROM subroots
            UNION ALL
            SELECT level + 1, pos // 16, (max(n) + 15) // 16, sha256(string_agg(node, '' ORDER BY pos))
            FROM upper_tree WHERE n > 1 GROUP BY level, pos // 16),
        nodes AS (
            SELECT grp, level, pos, n, node FROM lower_tree WHERE n > 1
            UNION ALL
            SELECT s.grp, s.level + u.level, u.pos, u.n, u.node FROM subroots s CROSS JOIN upper_tree u WHERE u.n > 1),
        siblings AS (
            SELECT grp, level, pos,
                   coalesce(string_agg(node, '') OVER (run ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS l,
                   coalesce(string_agg(node, '') OVER (run ORDER BY pos ROWS BETWEEN 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS r
            FROM nodes WINDOW run AS (PARTITION BY grp, level, pos // 16)),
        climb AS (
            SELECT p.doc_id, s.grp, 0 AS level, CASE WHEN s.level = 0 THEN s.place ELSE p.pos END AS pos, p.now AS node, '' AS proof, s.level AS height, s.place
            FROM placed p JOIN subroots s ON s.grp = coalesce('=' || p.source, '')
            UNION ALL
            SELECT c.doc_id, c.grp, c.level + 1, CASE WHEN c.level + 1 = c.height THEN c.place ELSE c.pos // 16 END,
                   sha256(b.l || c.node || b.r), c.proof || b.l || b.r, c.height, c.place
            FROM climb c JOIN siblings b ON b.grp = c.grp AND b.level = c.level AND b.pos = c.pos),
        tops AS (
            SELECT * FROM climb QUALIFY level = max(level) OVER (PARTITION BY doc_id))
        SELECT p.doc_id, p.leaf, s.node AS subroot, u.node AS root, sha256(t.proof) AS proof_sha256, t.node AS folded_root, t.node = u.node AS verified
        FROM placed p JOIN tops t ON t.doc_id = p.doc_id JOIN subroots s ON s.grp = t.grp CROSS JOIN (SELECT node FROM upper_tree WHERE n = 1) u
    """,
    "op12_hard_negatives": """
        WITH vectors AS (
            SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
        scored AS (
            SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
                   list_sum(list_transform(list_zip(a.v, c.v), lambda p: p[1] * p[2]))::BIGINT AS score
            FROM vectors a JOIN vectors c ON a.vec_id <> c.vec_id WHERE a.vec_id % 100 = 0),
        positives AS (
            SELECT * FROM scored WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5)
        SELECT p.anchor_id, p.vec_id AS positive_id,
               (row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id))::INT AS rank,
               n.vec_id AS negative_id, p.score AS positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.same
             AND 80 * p.score <= 100 * n.score AND n.score <= p.score
        QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.vec_id ORDER BY n.score DESC, n.vec_id) <= 5
    """,
    # Sources that reach their cap come first by cap per weight; documents win the budget in order of their hash.
    "op13_mixing": r"""
        WITH sizes AS (
            SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS size,
                   ('0x' || substr(sha256(concat_ws(':', coalesce(doc_id::VARCHAR, ''), text)), 1, 15))::BIGINT AS h
            FROM documents),
        sources AS (
            SELECT source, sum(size)::BIGINT AS own, 3 * own AS cap,
                   (row_number() OVER (ORDER BY encode(source) NULLS LAST) - 1) % 3 + 1 AS w
            FROM sizes GROUP BY source),
        levels AS (
            SELECT *, sum(own) OVER () - coalesce(sum(cap) OVER (o ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS rest,
                   sum(w) OVER (o ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS weights,
                   row_number() OVER o AS place
            FROM sources WINDOW o AS (ORDER BY cap::DOUBLE / w, encode(source))),
        first_free AS (
            SELECT place, rest, weights FROM levels WHERE rest::DOUBLE * w / weights <= cap ORDER BY place LIMIT 1),
        targets AS (
            SELECT l.source, own, CASE WHEN l.place < f.place THEN cap::DOUBLE ELSE f.rest::DOUBLE * w / f.weights::DOUBLE END AS target
            FROM levels l CROSS JOIN first_free f),
        budgets AS (
            SELECT *, CASE WHEN own > 0 THEN floor(target / own)::BIGINT ELSE 0 END AS times, target - times * own AS budget FROM targets),
        won AS (
            SELECT doc_id, source, size,
                   coalesce(sum(size) OVER (PARTITION BY source ORDER BY h ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS earlier
            FROM sizes)
        SELECT doc_id, size::BIGINT AS size, own AS source_size, target,
               (size * (times + CASE WHEN 2 * earlier + size <= 2 * budget THEN 1 ELSE 0 END))::BIGINT AS taken
        FROM won w JOIN budgets b ON w.source IS NOT DISTINCT FROM b.source
    """,
}
