"""The same results stated in SQL (DuckDB) on the same tables.

Written from the definition of each operator, by other means where there is a choice:
brute-force pairs instead of banding, one row per bit or permutation instead of packed sums.
"""

from __future__ import annotations

import random


def _clean(text: str) -> str:
    """The cleaning chain; the test tables hold nothing that NFKC changes beyond NFC."""
    steps = [
        (r"[^\P{C}\n\t\r]", ""),
        (r"[^\P{Z} ]", ""),
        (r"<[^>]+>", " "),
        (r"\[([^\]]+)\]\([^\)]+\)", r"\1"),
        (r"[*_~`#>]", " "),
        (r"[ \t]+", " "),
    ]
    sql = f"nfc_normalize({text})"
    for pattern, replacement in steps:
        sql = f"regexp_replace({sql}, '{pattern}', '{replacement}', 'g')"
    return rf"trim(regexp_replace({sql}, '\n{{3,}}', E'\n\n', 'g'), E' \n\r\t')"


DOCS = f"""docs AS (
  SELECT CAST(doc_id AS VARCHAR) AS document_id, text AS content, source, lang AS category,
         {_clean('text')} AS cleaned
  FROM documents)"""

# documents that pass the gates, one per content
KEPT = DOCS + r""", gated AS (
  SELECT *, len(regexp_split_to_array(cleaned, '\s+')) AS word_count FROM docs
  WHERE content IS NOT NULL AND length(trim(content)) > 0),
enough AS (SELECT * FROM gated WHERE word_count >= 5),
kept AS (
  SELECT * FROM enough
  QUALIFY row_number() OVER (PARTITION BY sha256(cleaned) ORDER BY document_id) = 1)"""


def _chunks(table: str, size: int = 256, overlap: int = 32) -> str:
    step = size - overlap
    return rf"""pieces AS (
  SELECT document_id, source, category, regexp_extract_all(cleaned, '\S+\s*') AS w FROM {table}),
counted AS (
  SELECT *, len(w) AS words,
         CASE WHEN len(w) <= {size} THEN 1 ELSE CAST(ceil((len(w) - {size}) / {step}.0) AS INT) + 1 END AS total
  FROM pieces WHERE len(w) > 0),
placed AS (SELECT *, unnest(range(total)) AS k FROM counted),
chunks AS (
  SELECT document_id, source, category, document_id || '_chk_' || k AS chunk_id, CAST(k AS INT) AS chunk_index,
         CAST(total AS INT) AS total_chunks,
         rtrim(array_to_string(list_slice(w, k * {step} + 1, k * {step} + {size}), ''), E' \n\r\t') AS chunk_content,
         CAST(least({size}, words - k * {step}) AS INT) AS token_count,
         CAST(length(array_to_string(list_slice(w, 1, k * {step}), '')) AS INT) AS start_char
  FROM placed)"""


SHARD = "CAST(('0x' || substr(md5(chunk_id), 1, 8))::BIGINT % 16 AS INT)"


def _slots(table: str, keys: str, text: str, name: str = "slots", dim: int = 384) -> str:
    """(keys, slot, weight) of the unnormalized embedding, nonzero slots only."""
    on = " AND ".join(f"t.{k.strip()} = s.{k.strip()}" for k in keys.split(","))
    return rf"""{name}_words AS (
  SELECT {keys}, unnest(regexp_extract_all(lower({text}), '\S+')) AS word FROM {table}),
{name}_hashed AS (
  SELECT {keys}, ('0x' || substr(md5(word), 1, 8))::BIGINT AS h FROM {name}_words),
{name}_parts AS (
  SELECT {keys}, CAST(h % {dim} AS INT) AS slot, CASE WHEN (h >> 3) & 1 = 1 THEN 1.0::DOUBLE ELSE -1.0::DOUBLE END AS weight FROM {name}_hashed
  UNION ALL SELECT {keys}, 0, 0.1::DOUBLE * count(*) FROM {name}_hashed GROUP BY {keys}
  UNION ALL SELECT {keys}, 1, 0.01::DOUBLE * length({text}) FROM {table}),
{name} AS (
  SELECT {keys}, slot, sum(weight) AS weight FROM {name}_parts GROUP BY {keys}, slot HAVING sum(weight) <> 0)"""


def _unit(slots: str, keys: str, name: str) -> str:
    """32-bit values of the normalized embedding."""
    return f"""{name} AS (
  SELECT {keys}, slot, CAST(weight / greatest(sqrt(sum(weight * weight) OVER (PARTITION BY {keys})), 1e-12) AS FLOAT) AS value
  FROM {slots})"""


TOKENS = DOCS + r""", tokens AS (
  SELECT document_id, unnest(regexp_extract_all(cleaned, '[\p{L}\p{N}_]+')) AS token FROM docs)"""

SIMHASH = TOKENS + """, hashed AS (
  SELECT document_id, ('0x' || substr(md5(token), 1, 16))::UBIGINT AS h FROM tokens),
votes AS (
  SELECT document_id, i, sum(CASE WHEN (h >> i) & 1 = 1 THEN 1 ELSE -1 END) AS v
  FROM hashed, (SELECT unnest(range(64))::UBIGINT AS i) GROUP BY ALL),
voted AS (
  SELECT document_id, CAST(sum(CASE WHEN v <= 0 THEN 0::HUGEINT
           WHEN i = 63 THEN -9223372036854775808::HUGEINT ELSE (1::HUGEINT << i::INT) END) AS BIGINT) AS simhash
  FROM votes GROUP BY document_id),
fingerprints AS (
  SELECT document_id, coalesce(simhash, 0) AS simhash FROM docs LEFT JOIN voted USING (document_id)),
classes AS (
  SELECT simhash AS sketch, min(document_id) AS id, count(*) AS copies FROM fingerprints GROUP BY simhash),
near AS (
  SELECT a.id AS id_a, b.id AS id_b, a.copies AS copies_a, b.copies AS copies_b,
         CAST(bit_count(xor(a.sketch, b.sketch)) AS INT) AS hamming
  FROM classes a JOIN classes b ON a.id < b.id AND bit_count(xor(a.sketch, b.sketch)) <= 3)"""

# Drawn here, from the definition: 64 factors, then 64 summands, below 2**32 + 15.
_DRAW = random.Random(42)
_FACTORS = [_DRAW.randint(1, 4294967310) for _ in range(64)]
_PARAMS = ", ".join(f"({i}, {a}, {_DRAW.randint(0, 4294967310)})" for i, a in enumerate(_FACTORS))

MINHASH = TOKENS + f""", hashed AS (
  SELECT DISTINCT document_id, ('0x' || substr(md5(token), 1, 8))::HUGEINT AS h FROM tokens),
params(i, a, b) AS (VALUES {_PARAMS}),
least_values AS (
  SELECT document_id, i, CAST(min((a::HUGEINT * h + b::HUGEINT) % 4294967311) AS BIGINT) AS value
  FROM hashed, params GROUP BY ALL),
everywhere AS (SELECT document_id, i FROM docs, params),
signature AS (
  SELECT e.document_id, CAST(e.i AS INT) AS position, coalesce(value, 0) AS value
  FROM everywhere e LEFT JOIN least_values l ON l.document_id = e.document_id AND l.i = e.i),
sketched AS (
  SELECT document_id, string_agg(value::VARCHAR, ',' ORDER BY position) AS sketch FROM signature GROUP BY document_id),
classes AS (SELECT sketch, min(document_id) AS id, count(*) AS copies FROM sketched GROUP BY sketch),
class_values AS (SELECT id, position, value FROM classes JOIN signature ON document_id = id),
near AS (
  SELECT a.id AS id_a, b.id AS id_b, count(*) / 64.0::DOUBLE AS jaccard
  FROM class_values a JOIN class_values b ON a.position = b.position AND a.value = b.value AND a.id < b.id
  GROUP BY ALL HAVING count(*) / 64.0 >= 0.8)"""


def _survivors(class_of: str) -> str:
    """Ids that are the smallest of their class and have no near class of smaller id."""
    return f"""SELECT document_id, source FROM docs
WHERE document_id IN (SELECT id FROM {class_of}) AND document_id NOT IN (SELECT id_b FROM near)"""


# codes and scale of the dynamic quantizer on the embeddings table
VALUES = """vals AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) - 1 AS dimension, unnest(embedding) AS x FROM embeddings),
scales AS (
  SELECT vec_id, CAST(least(greatest(max(abs(x))::DOUBLE, 1e-7), 2.5) / 127 AS FLOAT) AS scale FROM vals GROUP BY vec_id),
codes AS (
  SELECT vec_id, CAST(dimension AS INT) AS dimension, x, scale,
         CAST(greatest(least(round_even(x::DOUBLE / scale::DOUBLE, 0), 127), -128) AS INT) AS code
  FROM vals JOIN scales USING (vec_id)),
restored AS (SELECT *, CAST(code AS FLOAT) * scale AS y FROM codes)"""

ERROR = """round(avg((x::DOUBLE - y::DOUBLE) ** 2), 12) AS mse,
  round(max(abs(x::DOUBLE - y::DOUBLE)), 8) AS max_absolute_error,
  round(sum(x::DOUBLE * y::DOUBLE) / (sqrt(sum(x::DOUBLE ** 2)) * sqrt(sum(y::DOUBLE ** 2))), 9) AS cosine_similarity,
  round(greatest(0, 1 - sum(x::DOUBLE * y::DOUBLE) / (sqrt(sum(x::DOUBLE ** 2)) * sqrt(sum(y::DOUBLE ** 2)))), 9) AS cosine_distortion,
  round(10 * log10(var_pop(x::DOUBLE) / (avg((x::DOUBLE - y::DOUBLE) ** 2) + 1e-12)), 4) AS snr_db"""

SCORES = """unit AS (
  SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE / greatest(sqrt(list_sum(list_transform(embedding, lambda y: y::DOUBLE * y::DOUBLE))), 1e-12)) AS u
  FROM embeddings),
scores AS (SELECT a.vec_id AS row_id, b.vec_id AS col_id, list_inner_product(a.u, b.u) AS cosine FROM unit a, unit b)"""

VECTORS = KEPT + ", " + _chunks("kept") + ", " + _slots("chunks", "chunk_id", "chunk_content") + ", " + _unit("slots", "chunk_id", "unit")

STAGES = (
    KEPT
    + ", "
    + _chunks("kept")
    + """, sizes AS (
  SELECT (SELECT count(*) FROM docs) AS raw, (SELECT count(*) FROM enough) AS clean,
         (SELECT count(*) FROM kept) AS dedup, (SELECT count(*) FROM chunks) AS chunked)"""
)



def _component(name: str, matrix: str, of: str) -> str:
    """First eigenvector of a covariance, by squaring it again and again, and the covariance without it.

    A power of a symmetric matrix tends to the product of its first eigenvector with itself.
    """
    return f"""{name}_power(k, m) AS (
  SELECT 0, {matrix} FROM {of}
  UNION ALL
  SELECT k + 1, list_transform(q, lambda r: list_transform(r, lambda x: x / t)) FROM (
    SELECT k, q, list_sum(list_transform(q, lambda r, i: r[i])) AS t FROM (
      SELECT k, list_transform(m, lambda r: list_transform(m, lambda s: list_dot_product(r, s))) AS q FROM {name}_power WHERE k < 30))),
{name}_row AS (
  SELECT m[list_position(list_transform(m, lambda r, i: r[i]), list_max(list_transform(m, lambda r, i: r[i])))] AS r FROM {name}_power WHERE k = 30),
{name}_unit AS (
  SELECT list_transform(r, lambda x: x / sqrt(list_dot_product(r, r))
    * sign(r[list_position(list_transform(r, lambda y: abs(y)), list_max(list_transform(r, lambda y: abs(y))))])) AS v FROM {name}_row),
{name} AS (
  SELECT v, list_dot_product(v, list_transform(c, lambda r: list_dot_product(r, v))) AS value, {matrix} AS c FROM {name}_unit, {of} AS o(c)),
{name}_rest AS (
  SELECT list_transform(c, lambda r, i: list_transform(r, lambda x, j: x - value * v[i] * v[j])) AS c FROM {name})"""


PCA = f"""WITH RECURSIVE vals AS (
  SELECT vec_id, generate_subscripts(embedding, 1) AS d, unnest(embedding)::DOUBLE AS x FROM embeddings),
means AS (SELECT d, avg(x) AS m FROM vals GROUP BY d),
centred AS (SELECT vec_id, d, x - m AS x FROM vals JOIN means USING (d)),
entries AS (SELECT a.d AS i, b.d AS j, sum(a.x * b.x) AS v FROM centred a JOIN centred b USING (vec_id) GROUP BY ALL),
covariance AS (SELECT list(r ORDER BY i) AS c FROM (SELECT i, list(v ORDER BY j) AS r FROM entries GROUP BY i)),
{_component("first", "c", "covariance")},
{_component("second", "c", "first_rest")},
{_component("third", "c", "second_rest")},
total AS (SELECT list_sum(list_transform(c, lambda r, i: r[i])) AS t FROM covariance),
points AS (SELECT vec_id, list(x ORDER BY d) AS p FROM centred GROUP BY vec_id)
SELECT vec_id, round(list_dot_product(p, first.v), 6) AS pc1, round(list_dot_product(p, second.v), 6) AS pc2, round(list_dot_product(p, third.v), 6) AS pc3,
  round(first.value / t, 6) AS ratio1, round(second.value / t, 6) AS ratio2, round(third.value / t, 6) AS ratio3
FROM points, total, first, second, third"""

KNN = f"""WITH {SCORES}, ranked AS (
  SELECT row_id AS query_id, col_id AS id, cosine AS score,
         row_number() OVER (PARTITION BY row_id ORDER BY round(cosine, 9) DESC, col_id) AS "rank" FROM scores)
SELECT query_id, CAST("rank" AS INT) AS "rank", id, round(round(score, 9), 6) AS score, label
FROM ranked JOIN embeddings ON vec_id = id WHERE "rank" <= 5"""

ORACLE = {
    "corpus_scan": "SELECT CAST(doc_id AS VARCHAR) AS document_id, text AS content, source, lang AS category FROM documents",
    "json_scan": """SELECT CAST(doc_id AS VARCHAR) AS document_id, text AS content, source, lang AS category,
  '2000-01-01T00:00:00+00:00' AS "timestamp" FROM documents""",
    "rejected_records": """WITH d AS (SELECT doc_id, doc_id % 7 AS kind, CAST(doc_id AS VARCHAR) AS document_id, md5(text) AS content_md5 FROM documents)
SELECT CASE kind WHEN 0 THEN 'no id' WHEN 1 THEN 'no content' WHEN 2 THEN 'malformed' ELSE 'accepted' END AS reason,
  CASE WHEN kind NOT IN (0, 2) THEN document_id END AS document_id, CASE WHEN kind NOT IN (1, 2) THEN content_md5 END AS content_md5 FROM d""",
    "raw_defaults": """SELECT CAST(page_id AS VARCHAR) AS document_id, html AS content, 'unknown' AS source, 'general' AS category,
  '2000-01-01T00:00:00+00:00' AS "timestamp", 0 AS metadata_size FROM pages""",
    "capped_corpus": """SELECT CAST(doc_id AS VARCHAR) AS document_id, text AS content, source, lang AS category
FROM documents ORDER BY 1 LIMIT 100""",
    "sink_roundtrip": f"""WITH keyed AS (SELECT *, CAST(vec_id AS VARCHAR) AS chunk_id FROM embeddings)
SELECT chunk_id, vec_id, label, {SHARD} AS partition_id, CAST(generate_subscripts(embedding, 1) - 1 AS INT) AS dimension,
  round(unnest(embedding)::DOUBLE, 6) AS value FROM keyed""",
    "dataset_summary": """SELECT count(*) AS total_records, true AS all_files_counted, 'vec_id,embedding,label,chunk_id,partition_id' AS fields,
  true AS files_listed, true AS files_in_shards, min(vec_id) AS least_id, max(vec_id) AS greatest_id FROM embeddings""",
    "vector_upsert": """WITH written AS (SELECT vec_id + 250 AS id, label + 200 AS label, embedding FROM embeddings),
points AS (SELECT * FROM written UNION ALL SELECT vec_id, label, embedding FROM embeddings WHERE vec_id NOT IN (SELECT id FROM written))
SELECT id, CAST(label AS INT) AS label, array_to_string(list_transform(embedding, lambda x: CAST(round(x::DOUBLE * 1000000) AS BIGINT)), ',') AS vector_millionths FROM points""",
    "nonblank_docs": """SELECT CAST(doc_id AS VARCHAR) AS document_id, text AS content, source, lang AS category
FROM documents WHERE text IS NOT NULL AND length(trim(text)) > 0""",
    "doc_counts": rf"""WITH {DOCS} SELECT document_id, CAST(length(cleaned) AS INT) AS char_count,
  CAST(len(regexp_split_to_array(cleaned, '\s+')) AS INT) AS word_count FROM docs""",
    "min_words": f"WITH {KEPT} SELECT document_id, CAST(word_count AS INT) AS word_count FROM enough",
    "nfkc_docs": "SELECT CAST(doc_id AS VARCHAR) AS document_id, nfc_normalize(text) || ' fi Ab 1 2 Ω' AS normalized FROM documents",
    "strip_html": "SELECT page_id, regexp_replace(html, '<[^>]+>', ' ', 'g') AS stripped FROM pages",
    "clean_text": f"WITH {DOCS} SELECT document_id, cleaned FROM docs",
    "clean_text_lower": f"WITH {DOCS} SELECT document_id, lower(cleaned) AS cleaned FROM docs",
    "clean_pages": f"SELECT page_id, {_clean('html')} AS cleaned FROM pages",
    "clean_conversations": f"SELECT conv_id, turn, {_clean('text')} AS cleaned FROM conversations",
    "tokenize": r"""SELECT CAST(doc_id AS VARCHAR) AS document_id,
  array_to_string(regexp_extract_all(text, '[\p{L}\p{N}_]+'), ' ') AS tokens FROM documents""",
    "lexical_stats": r"""SELECT CAST(doc_id AS VARCHAR) AS document_id, CAST(length(text) AS INT) AS char_count,
  CAST(len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) AS INT) AS word_count,
  CAST(len(regexp_extract_all(text, '[\p{Nd}¹²³]')) AS INT) AS digit_count,
  CAST(len(regexp_extract_all(text, '[\p{Z}\t\n\x0B\f\r\x1c-\x1f\x85]')) AS INT) AS whitespace_count FROM documents""",
    "content_hash": f"""WITH {DOCS} SELECT document_id, CASE WHEN cleaned = '' THEN '' ELSE sha256(cleaned) END AS sha256,
  md5(cleaned) AS md5 FROM docs""",
    "exact_dedup": f"""WITH {DOCS} SELECT document_id, CASE WHEN cleaned = '' THEN '' ELSE sha256(cleaned) END AS content_hash,
  CAST(length(cleaned) AS INT) AS char_count FROM docs
QUALIFY row_number() OVER (PARTITION BY sha256(cleaned) ORDER BY document_id) = 1""",
    "simhash": f"WITH {SIMHASH} SELECT document_id, simhash FROM fingerprints",
    "simhash_groups": f"""WITH {SIMHASH} SELECT document_id, id AS representative
FROM fingerprints f JOIN classes c ON f.simhash = c.sketch""",
    "simhash_pairs": f"WITH {SIMHASH} SELECT * FROM near",
    "minhash_signature": f"WITH {MINHASH} SELECT document_id, position, value FROM signature",
    "minhash_pairs": f"""WITH {MINHASH} SELECT id_a, id_b, a.copies AS copies_a, b.copies AS copies_b, jaccard
FROM near JOIN classes a ON a.id = id_a JOIN classes b ON b.id = id_b""",
    "near_dedup_simhash": f"WITH {SIMHASH} {_survivors('classes')}",
    "near_dedup_minhash": f"WITH {MINHASH} {_survivors('classes')}",
    "chunk_docs": f"""WITH {DOCS}, {_chunks('docs')}
SELECT document_id, chunk_id, chunk_index, chunk_content, token_count, source, category FROM chunks""",
    "chunk_offsets": f"""WITH {DOCS}, {_chunks('docs', 64, 8)}
SELECT chunk_id, total_chunks, token_count, start_char, start_char + CAST(length(chunk_content) AS INT) AS end_char FROM chunks""",
    "embed_sparse": f"""WITH {DOCS}, {_chunks('docs')}, {_slots('chunks', 'chunk_id', 'chunk_content')}
SELECT chunk_id, slot, round(weight, 2) AS weight FROM slots""",
    "embed_norm": f"""WITH {DOCS}, {_chunks('docs')}, {_slots('chunks', 'chunk_id', 'chunk_content')}
SELECT chunk_id, round(sqrt(sum(weight * weight)), 3) AS norm FROM slots GROUP BY chunk_id""",
    "embed_dense": f"""WITH {_slots('conversations', 'conv_id, turn', 'text')}, {_unit('slots', 'conv_id, turn', 'unit')}
SELECT conv_id, turn, slot, round(value::DOUBLE, 6) AS value FROM unit""",
    "l2_normalize": f"""WITH {VALUES}
SELECT vec_id, CAST(dimension AS INT) AS dimension,
  round(CAST(x::DOUBLE / greatest(sqrt(sum(x::DOUBLE ** 2) OVER (PARTITION BY vec_id)), 1e-12) AS FLOAT)::DOUBLE, 6) AS value FROM vals""",
    "quantize_fixed": f"""WITH {VALUES} SELECT vec_id, CAST(dimension AS INT) AS dimension,
  CAST(round_even(greatest(least(x::DOUBLE, 2.5::DOUBLE), -2.5::DOUBLE) / (2.5::DOUBLE / 127), 0) AS INT) AS code FROM vals""",
    "quantize_dynamic": f"WITH {VALUES} SELECT vec_id, round(scale::DOUBLE, 8) AS scale, dimension, code FROM codes",
    "int8_bytes": f"""WITH {VALUES} SELECT vec_id, string_agg(printf('%02X', code & 255), '' ORDER BY dimension) AS packed_hex,
  string_agg(code::VARCHAR, ',' ORDER BY dimension) AS codes FROM codes GROUP BY vec_id""",
    "dequantize": f"WITH {VALUES} SELECT vec_id, dimension, round(y::DOUBLE, 6) AS value FROM restored",
    "quantization_error": f"WITH {VALUES} SELECT {ERROR} FROM restored",
    "quantization_error_rows": f"WITH {VALUES} SELECT vec_id, {ERROR} FROM restored GROUP BY vec_id",
    "cosine_matrix": f"WITH {SCORES} SELECT row_id, col_id, round(cosine, 6) AS cosine FROM scores",
    "pca_project": PCA,
    "knn_topk": KNN,
    "knn_blocks": KNN,
    "cosine_centres": """WITH vals AS (
  SELECT vec_id, label, generate_subscripts(embedding, 1) AS d, unnest(embedding)::DOUBLE AS x FROM embeddings),
centres AS (SELECT label, d, CAST(avg(x) AS FLOAT)::DOUBLE AS y FROM vals GROUP BY label, d),
lengths AS (SELECT label, sqrt(sum(y * y)) AS n FROM centres GROUP BY label),
own AS (SELECT vec_id, sqrt(sum(x * x)) AS n FROM vals GROUP BY vec_id)
SELECT vec_id AS row_id, CAST(c.label AS BIGINT) AS col_id, round(sum(x * y) / (max(own.n) * max(lengths.n)), 5) AS cosine
FROM vals JOIN centres c USING (d) JOIN own USING (vec_id) JOIN lengths ON lengths.label = c.label GROUP BY vec_id, c.label""",
    "semantic_search": f"""WITH {DOCS}, {_chunks('docs')}, {_slots('chunks', 'chunk_id', 'chunk_content')}, {_unit('slots', 'chunk_id', 'unit')},
asked AS (SELECT item_id AS query_id, text FROM benchmark), {_slots('asked', 'query_id', 'text', 'qslots')}, {_unit('qslots', 'query_id', 'qunit')},
norms AS (SELECT chunk_id, sqrt(sum(value::DOUBLE ** 2)) AS n FROM unit GROUP BY chunk_id),
qnorms AS (SELECT query_id, sqrt(sum(value::DOUBLE ** 2)) AS n FROM qunit GROUP BY query_id),
dots AS (SELECT query_id, chunk_id, sum(u.value::DOUBLE * q.value::DOUBLE) AS dot FROM unit u JOIN qunit q USING (slot) GROUP BY ALL),
scores AS (SELECT query_id, chunk_id, dot / (norms.n * qnorms.n) AS score FROM dots JOIN norms USING (chunk_id) JOIN qnorms USING (query_id)),
best AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY round(score, 9) DESC, chunk_id) AS "rank" FROM scores)
SELECT query_id, CAST("rank" AS INT) AS "rank", chunk_id, round(round(score, 9), 6) AS score, category, {SHARD} AS partition_id,
  substr(chunk_content, 1, 200) AS snippet
FROM best JOIN chunks USING (chunk_id) WHERE "rank" <= 3""",
    "dimension_compare": f"""WITH {VALUES} SELECT vec_id, dimension, round(x::DOUBLE, 6) AS original,
  round(y::DOUBLE, 6) AS reconstructed FROM restored WHERE dimension < 48""",
    "storage_ratio": """SELECT CAST(sum(len(embedding) * 4) AS BIGINT) AS fp32_bytes, CAST(sum(len(embedding)) AS BIGINT) AS int8_bytes,
  sum(len(embedding) * 4)::DOUBLE / sum(len(embedding)) AS ratio FROM embeddings""",
    "shard_id": f"WITH {DOCS}, {_chunks('docs')} SELECT chunk_id, {SHARD} AS partition_id FROM chunks",
    "repartition_hash": "SELECT label, true AS placed, count(*) AS vectors FROM embeddings GROUP BY label",
    "repartition_range": "SELECT label, true AS placed, true AS several, count(*) AS vectors FROM embeddings GROUP BY label",
    "shard_distribution": f"""WITH {DOCS}, {_chunks('docs')}
SELECT {SHARD} AS partition_id, count(*) AS vector_count FROM chunks GROUP BY 1""",
    "transform_chunks": f"""WITH {KEPT}, {_chunks('kept')}
SELECT chunk_id, document_id, source, category, chunk_index, total_chunks, chunk_content, token_count, start_char,
  start_char + CAST(length(chunk_content) AS INT) AS end_char, 0 AS zero_point, {SHARD} AS partition_id FROM chunks""",
    "transform_vectors": f"""WITH {VECTORS},
scaled AS (SELECT chunk_id, CAST(least(greatest(max(abs(value))::DOUBLE, 1e-7), 2.5) / 127 AS FLOAT) AS scale,
  sqrt(sum(value::DOUBLE ** 2)) AS norm FROM unit GROUP BY chunk_id),
dense AS (
  SELECT chunk_id, g.slot, coalesce(value, 0::FLOAT) AS value, scale, norm
  FROM scaled JOIN (SELECT CAST(unnest(range(384)) AS INT) AS slot) g ON true LEFT JOIN unit USING (chunk_id, slot))
SELECT chunk_id, md5(string_agg(printf('%02X', CAST(greatest(least(round_even(value::DOUBLE / scale::DOUBLE, 0), 127), -128) AS INT) & 255), '' ORDER BY slot)) AS codes_md5,
  round(max(scale)::DOUBLE, 8) AS scale_factor, round(CAST(max(norm) AS FLOAT)::DOUBLE, 4) AS l2_norm, CAST(count(*) AS INT) AS dims
FROM dense GROUP BY chunk_id""",
    "stage_counts": f"""WITH {STAGES}
SELECT 'ingest' AS stage_name, raw AS input_records, raw AS output_records FROM sizes
UNION ALL SELECT 'clean_and_hash', raw, clean FROM sizes
UNION ALL SELECT 'deduplicate', clean, dedup FROM sizes
UNION ALL SELECT 'chunk_and_explode', dedup, chunked FROM sizes
UNION ALL SELECT 'sink', chunked, chunked FROM sizes""",
    "audit_report": f"""WITH {STAGES}
SELECT 'SUCCESS' AS status, raw AS total_input_records, chunked AS total_output_vectors,
  'ingest,clean_and_hash,deduplicate,chunk_and_explode,sink' AS stages, concat_ws(',', raw, clean, dedup, chunked, chunked) AS stage_rows,
  'INT8' AS quantization_mode, 384 AS vector_dimension, 16 AS num_partitions, 'parquet' AS storage_sink, 0 AS error_count FROM sizes""",
}
