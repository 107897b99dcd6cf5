"""The numbered operators as queries over their whole tables, and SQL for those that it can express."""

from __future__ import annotations

import os
from collections.abc import Callable
from pathlib import Path

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.llm import alignment, decontamination, digest_index, licenses, line_dedup, mixing, ngram_join, packing, quality, ranked_search, token_files, toxicity, warc
from vecloom.session import scratch_path


def importable(spark: SparkSession) -> None:
    """Workers on this machine find the package wherever the driver was started; a cluster has it installed."""
    root, known = str(Path(__file__).resolve().parents[2]), spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, [known, root]))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


def best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan(table(spark, sf_dir, "documents"))


def warc_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = warc.archive(table(spark, sf_dir, "pages"))
    return rows.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to", "intact")


def token_files_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return token_files.read(token_files.write(docs, scratch_path(spark, "planes"), public_tokenizers.path("byte_bpe_50k.json")))


def line_dedup_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = line_dedup.decide(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_lines", "n_removed", F.concat_ws(",", F.col("removed").cast("array<string>")).alias("removed_lines"))


def toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def quality_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = digest_index.decide(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("digest")).alias("text_sha256"))


def decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = decontamination.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return rows.select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")


def tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return alignment.align(docs, public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))


def source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.decide(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


def ranked_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranked_search.rank(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_ngram_jaccard_join": ngram_jaccard_join,
    "op2_best_fit_packing": best_fit_packing,
    "op3_exact_dedup": exact_dedup,
    "op4_license_scan": license_scan,
    "op5_warc": warc_round_trip,
    "op6_decontamination": decontaminate,
    "op7_token_files": token_files_round_trip,
    "op8_line_dedup": line_dedup_report,
    "op9_toxicity": toxicity_scores,
    "op10_quality_classifier": quality_scores,
    "op11_ranked_search": ranked_lexical_search,
    "op12_tokenizer_alignment": tokenizer_alignment,
    "op13_source_mix": source_mix,
}

ORACLE: dict[str, str] = {
    "op11_ranked_search": """
        WITH d AS (
            SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+') AS words FROM documents
        ), corpus AS (
            SELECT count(*) AS big_n, sum(len(words))::BIGINT AS big_l FROM d WHERE len(words) > 0
        ), tf AS (
            SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(words) AS term FROM d) GROUP BY r, term
        ), weights AS (
            SELECT term, floor(1000 * ln((2 * big_n + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT term, count(*) AS df FROM tf GROUP BY term), corpus
        ), asked AS (
            SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')) AS term FROM benchmark
        ), m AS (
            SELECT r, doc_id, 50 + (50 * len(words) * big_n) // big_l AS m FROM d, corpus WHERE len(words) > 0
        ), scores AS (
            SELECT item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 20 * m)))::BIGINT AS score
            FROM asked JOIN tf USING (term) JOIN weights USING (term) JOIN m USING (r) GROUP BY item_id, r, doc_id
        ), places AS (
            SELECT item_id, doc_id, score, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM scores WHERE score > 0
        )
        SELECT item_id, rank, doc_id, score FROM places WHERE rank <= 50
    """,
    "op13_source_mix": """
        WITH d AS (
            SELECT doc_id, coalesce('=' || source, '') AS s, coalesce(len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')), 0)::BIGINT AS size,
                ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h FROM documents
        ), sources AS (
            SELECT s, sum(size)::BIGINT AS words FROM d GROUP BY s
        ), weighed AS (
            SELECT s, words, [3, 1, 2][((row_number() OVER (ORDER BY s = '', s) - 1) % 3 + 1)::INT] AS w, 1.5::DOUBLE * sum(words) OVER () AS everything FROM sources
        ), level AS (
            SELECT *, (2 * words)::DOUBLE * sum(w) OVER (ORDER BY words / w, s = '', s ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)
                < w * (everything - coalesce(2::DOUBLE * sum(words) OVER (ORDER BY words / w, s = '', s ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS full_ FROM weighed
        ), plan AS (
            SELECT s, words, CASE WHEN full_ THEN 2::DOUBLE * words ELSE coalesce(w * (everything - coalesce(sum(2::DOUBLE * words) FILTER (full_) OVER (), 0)) / nullif(sum(w) FILTER (NOT full_) OVER (), 0), 0) END AS target FROM level
        ), steps AS (
            SELECT *, coalesce(target / nullif(words, 0), 0) AS each, ('0x' || substr(md5('mix/' || s), 1, 6))::BIGINT AS u FROM plan
        ), ranked AS (
            SELECT *, row_number() OVER (PARTITION BY s ORDER BY size, h, doc_id) AS n FROM d
        ), placed AS (
            SELECT *, floor((each - floor(each)) * 16777216)::BIGINT AS part FROM ranked JOIN steps USING (s)
        )
        SELECT doc_id, size, words AS source_size, target, size * (floor(each)::BIGINT + ((n * part + u) >> 24) - (((n - 1) * part + u) >> 24)) AS taken FROM placed
    """,
    "op5_warc": """
        WITH p AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest FROM pages),
        g AS (SELECT payload_digest, min(page_id) AS first FROM p GROUP BY payload_digest)
        SELECT page_id, payload_bytes, payload_digest,
            CASE WHEN payload_bytes >= 100 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 100 AND page_id <> first THEN first END AS refers_to, true AS intact
        FROM p JOIN g USING (payload_digest)
    """,
    "op3_exact_dedup": """
        WITH d AS (
            SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS text_sha256 FROM documents
        ), g AS (
            SELECT text_sha256, min(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text_sha256
        )
        SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, text_sha256 FROM d JOIN g USING (text_sha256)
    """,
    "op6_decontamination": """
        WITH dw AS (
            SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM documents
        ), bw AS (
            SELECT item_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS w FROM benchmark
        ), windows AS (
            SELECT DISTINCT item_id, w[p:p + least(len(w), 10) - 1] AS gram FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 8, 2))) AS p FROM bw WHERE len(w) > 0)
        ), words AS (
            SELECT doc_id, unnest(w) AS word, unnest(range(len(w))) AS p FROM dw
        ), places AS (
            SELECT doc_id, p, list(word) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 9 FOLLOWING) AS l FROM words
        ), sizes AS (
            SELECT DISTINCT len(gram) AS n FROM windows
        ), texts AS (
            SELECT item_id, array_to_string(gram, ' ') AS gram FROM windows
        ), found AS (
            SELECT doc_id, p, n, item_id FROM (SELECT doc_id, p, n, array_to_string(l[1:n], ' ') AS gram FROM places, sizes WHERE len(l) >= n) JOIN texts USING (gram)
        ), hit AS (
            SELECT doc_id, count(DISTINCT i) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS i FROM found) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM found) GROUP BY doc_id
        )
        SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
        FROM dw LEFT JOIN hit USING (doc_id) LEFT JOIN items USING (doc_id)
    """,
}
