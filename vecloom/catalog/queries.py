"""One query per operator: (spark, folder of the tables) -> DataFrame."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from vecloom.functions import text as T
from vecloom.functions import vectors as V
from vecloom.functions.binding import once
from vecloom.functions.embedding import hashed_embedding
from vecloom.functions.hashing import md5_hex, sha256_hex, shard_id
from vecloom.functions.packing import quantized
from vecloom.operators import partitioning, quality, search, sketches
from vecloom.operators.chunking import chunk
from vecloom.operators.dedup import exact_dedup
from vecloom.operators.projection import project_pca
from vecloom.plans.job import REPORT, run_job, run_stages
from vecloom.plans.transform import JobSettings, clean_and_hash, transform_all
from vecloom.schemas import raw_defaults
from vecloom.session import cut_lineage, scratch_path
from vecloom.sources.corpus import cap_records, read_corpus, rejected_records, spread
from vecloom.sources.footers import footer_statistics
from vecloom.sources.parquet_sink import dataset_summary, write_dataset
from vecloom.sources.sharded import ShardedCollection

INGESTED_AT = "2000-01-01T00:00:00+00:00"


def documents(spark: SparkSession, sf: str) -> DataFrame:
    columns = {"document_id": "doc_id", "content": "text", "category": "lang"}
    return read_corpus(spark, f"{sf}/documents.parquet", columns=columns, ingested_at=INGESTED_AT)


def cleaned(spark: SparkSession, sf: str) -> DataFrame:
    docs = documents(spark, sf).select("document_id", "source", "category", "content")
    return once(spread(docs), cleaned_content=T.clean_text(F.col("content"))).drop("content")


def chunks(spark: SparkSession, sf: str, size: int = 256, overlap: int = 32) -> DataFrame:
    return chunk(cleaned(spark, sf), F.col("cleaned_content"), size, overlap)


def embeddings(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/embeddings.parquet")


def pages(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/pages.parquet").select(F.col("page_id"), F.col("html"))


def conversations(spark: SparkSession, sf: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/conversations.parquet")


def _by_dimension(df: DataFrame, keys: list[str], array: Column, name: str) -> DataFrame:
    return df.select(*keys, F.posexplode(array).alias("dimension", name))


# --- sources and sinks -------------------------------------------------------


def corpus_scan(spark, sf):
    return documents(spark, sf).select("document_id", "content", "source", "category")


def json_scan(spark, sf):
    """The documents written as JSON lines and read back under the fixed schema."""
    path = scratch_path(spark, "lines")
    corpus_scan(spark, sf).write.json(path)
    return read_corpus(spark, path, ingested_at=INGESTED_AT).select("document_id", "content", "source", "category", "timestamp")


def rejected_records_query(spark, sf):
    """The documents as JSON lines, of which a seventh each lacks its id, lacks its content or breaks off; every row is listed."""
    path = scratch_path(spark, "lines")
    rows = corpus_scan(spark, sf).withColumn("kind", F.col("document_id").cast("bigint") % 7)
    stored = rows.select(
        F.when(F.col("kind") != 0, F.col("document_id")).alias("document_id"), F.when(F.col("kind") != 1, F.col("content")).alias("content"), "source", "kind"
    )
    line = F.to_json(F.struct("document_id", "content", "source"))
    stored.select(F.when(F.col("kind") == 2, F.substring(line, 1, 12)).otherwise(line).alias("value")).write.text(path)
    kept = read_corpus(spark, path, ingested_at=INGESTED_AT).select(F.lit("accepted").alias("reason"), "document_id", F.md5("content").alias("content_md5"))
    gone = rejected_records(spark, path)
    content = F.md5(F.get_json_object("line", "$.content"))
    return kept.unionByName(gone.select("reason", "document_id", F.when(F.col("reason") == "no id", content).alias("content_md5")))


def raw_defaults_query(spark, sf):
    renamed = pages(spark, sf).select(F.col("page_id").alias("document_id"), F.col("html").alias("content"))
    filled = raw_defaults(renamed, INGESTED_AT)
    return filled.select("document_id", "content", "source", "category", "timestamp", F.size("metadata").alias("metadata_size"))


def capped_corpus(spark, sf):
    return cap_records(corpus_scan(spark, sf), 100)


def _sharded(spark, sf):
    keyed = embeddings(spark, sf).withColumn("chunk_id", F.col("vec_id").cast("string"))
    return keyed.withColumn("partition_id", shard_id(F.col("chunk_id")))


def _staged(spark, sf) -> str:
    path = scratch_path(spark, "staged")
    write_dataset(partitioning.rebalance(_sharded(spark, sf), "partition_id"), path)
    return path


def sink_roundtrip(spark, sf):
    stored = spark.read.parquet(_staged(spark, sf)).select("chunk_id", "vec_id", "label", "partition_id", F.posexplode("embedding").alias("dimension", "value"))
    return stored.withColumn("value", F.round(F.col("value").cast("double"), 6))


def dataset_summary_query(spark, sf):
    """The summary of a dataset that all tasks wrote, held against the rows read back; ends of the ids from the footers."""
    path = _staged(spark, sf)
    found = spark.read.parquet(path).select(F.count_distinct("_metadata.file_path").alias("found"))
    columns = footer_statistics(spark, path).select(F.explode("columns").alias("c")).filter("c.name = 'vec_id'")
    ends = columns.select(F.min(F.col("c.low").cast("bigint")).alias("least_id"), F.max(F.col("c.high").cast("bigint")).alias("greatest_id"))
    in_shards = F.size(F.filter("parquet_files", lambda f: f.contains("/partition_id=")))
    said = dataset_summary(spark, path).select(
        "total_records",
        "file_count",
        F.array_join("schema_fields", ",").alias("fields"),
        (F.size(F.array_distinct("parquet_files")) == F.least("file_count", F.lit(10))).alias("files_listed"),
        (in_shards == F.size("parquet_files")).alias("files_in_shards"),
    )
    # single rows side by side
    rows = said.unionByName(found, allowMissingColumns=True).unionByName(ends, allowMissingColumns=True)
    names = ("total_records", "fields", "files_listed", "files_in_shards", "least_id", "greatest_id")
    return rows.agg((F.max("file_count") == F.max("found")).alias("all_files_counted"), *[F.max(n).alias(n) for n in names])


def vector_upsert(spark, sf):
    """A kept collection of the whole table; a batch rewrites every vector twice under id + 250, so that some ids are new."""
    stored = embeddings(spark, sf).select(F.col("vec_id").alias("id"), F.col("embedding").alias("vector"), "label")
    kept = ShardedCollection.create(spark, scratch_path(spark, "collection"), stored.withColumn("write_order", F.lit(0)))
    writes = stored.withColumn("write_order", F.explode(F.array(F.lit(1), F.lit(2))))
    kept.write(writes.select((F.col("id") + 250).alias("id"), "vector", (F.col("label") + 100 * F.col("write_order")).alias("label"), "write_order"))
    whole = F.transform("vector", lambda x: F.round(x.cast("double") * 1000000).cast("bigint").cast("string"))
    return kept.read().select("id", "label", F.concat_ws(",", whole).alias("vector_millionths"))


# --- filters and counts --------------------------------------------------------


def nonblank_docs(spark, sf):
    return corpus_scan(spark, sf).filter(T.nonblank(F.col("content")))


def doc_counts(spark, sf):
    text = F.col("cleaned_content")
    return cleaned(spark, sf).select("document_id", F.length(text).alias("char_count"), T.split_word_count(text).alias("word_count"))


def min_words(spark, sf):
    return clean_and_hash(spread(documents(spark, sf)), JobSettings()).select("document_id", "word_count")


# --- text ------------------------------------------------------------------------


# Characters that NFKC changes and NFC does not, and what they become.
COMPATIBLE = "\ufb01 \uff21\uff42 \u2460 \u00b2 \u2126"
COMPOSED = "fi Ab 1 2 \u03a9"


def nfkc_docs(spark, sf):
    """Every text ends with characters that only compatibility normalization changes."""
    text = F.concat(F.col("content"), F.lit(f" {COMPATIBLE}"))
    return spread(documents(spark, sf)).select("document_id", T.nfkc(text).alias("normalized"))


def strip_html(spark, sf):
    return pages(spark, sf).select("page_id", T.strip_html(F.col("html")).alias("stripped"))


def clean_text(spark, sf):
    return spread(documents(spark, sf)).select("document_id", T.clean_text(F.col("content")).alias("cleaned"))


def clean_text_lower(spark, sf):
    return spread(documents(spark, sf)).select("document_id", T.clean_text(F.col("content"), lowercase=True).alias("cleaned"))


def clean_pages(spark, sf):
    return spread(pages(spark, sf)).select("page_id", T.clean_text(F.col("html")).alias("cleaned"))


def clean_conversations(spark, sf):
    return spread(conversations(spark, sf)).select("conv_id", "turn", T.clean_text(F.col("text")).alias("cleaned"))


def tokenize(spark, sf):
    return spread(documents(spark, sf)).select("document_id", F.array_join(T.tokenize(F.col("content")), " ").alias("tokens"))


def lexical_stats(spark, sf):
    stats = T.lexical_stats(F.col("content"))
    return spread(documents(spark, sf)).select("document_id", *[value.alias(name) for name, value in stats.items()])


# --- hashing and deduplication -----------------------------------------------------


def content_hash(spark, sf):
    text = F.col("cleaned_content")
    return cleaned(spark, sf).select("document_id", sha256_hex(text).alias("sha256"), md5_hex(text).alias("md5"))


def exact_dedup_query(spark, sf):
    hashed = cleaned(spark, sf).withColumn("content_hash", sha256_hex(F.col("cleaned_content")))
    return exact_dedup(hashed).select("document_id", "content_hash", F.length("cleaned_content").alias("char_count"))


def _simhashes(spark, sf):
    return sketches.simhash(cleaned(spark, sf), T.tokenize(F.col("cleaned_content")))


def _minhashes(spark, sf):
    return sketches.minhash(cleaned(spark, sf), T.tokenize(F.col("cleaned_content")))


def simhash(spark, sf):
    return _simhashes(spark, sf)


def simhash_groups(spark, sf):
    return sketches.representatives(_simhashes(spark, sf), "simhash")


def simhash_pairs(spark, sf):
    return sketches.simhash_pairs(_simhashes(spark, sf), max_distance=3)


def minhash_signature(spark, sf):
    return _minhashes(spark, sf).select("document_id", F.posexplode("signature").alias("position", "value"))


def minhash_pairs(spark, sf):
    return sketches.minhash_pairs(_minhashes(spark, sf), threshold=0.8)


def near_dedup_simhash(spark, sf):
    docs = documents(spark, sf).select("document_id", "source")
    return sketches.near_dedup(docs, _simhashes(spark, sf), "simhash")


def near_dedup_minhash(spark, sf):
    docs = documents(spark, sf).select("document_id", "source")
    return sketches.near_dedup(docs, _minhashes(spark, sf), "minhash")


# --- chunking ----------------------------------------------------------------------


def chunk_docs(spark, sf):
    return chunks(spark, sf).select("document_id", "chunk_id", "chunk_index", "chunk_content", "token_count", "source", "category")


def chunk_offsets(spark, sf):
    return chunks(spark, sf, 64, 8).select("chunk_id", "total_chunks", "token_count", "start_char", "end_char")


# --- embedding and vectors ---------------------------------------------------------


def _raw_vectors(spark, sf):
    return chunks(spark, sf).select("chunk_id", hashed_embedding(F.col("chunk_content"), normalize=False).alias("v"))


def embed_sparse(spark, sf):
    slots = _raw_vectors(spark, sf).select("chunk_id", F.posexplode("v").alias("slot", "weight"))
    return slots.filter(F.col("weight") != 0).withColumn("weight", F.round(F.col("weight").cast("double"), 2))


def embed_norm(spark, sf):
    return _raw_vectors(spark, sf).select("chunk_id", F.round(V.l2_norm(F.col("v")), 3).alias("norm"))


def embed_dense(spark, sf):
    turns = spread(conversations(spark, sf)).select("conv_id", "turn", hashed_embedding(F.col("text")).alias("v"))
    slots = turns.select("conv_id", "turn", F.posexplode("v").alias("slot", "value")).filter(F.col("value") != 0)
    return slots.withColumn("value", F.round(F.col("value").cast("double"), 6))


def l2_normalize(spark, sf):
    exploded = _by_dimension(embeddings(spark, sf), ["vec_id"], V.l2_normalize(F.col("embedding")), "value")
    return exploded.withColumn("value", F.round(F.col("value").cast("double"), 6))


def quantize_fixed(spark, sf):
    return _by_dimension(embeddings(spark, sf), ["vec_id"], V.quantize(F.col("embedding"), "fixed"), "code")


def quantize_dynamic(spark, sf):
    scaled = embeddings(spark, sf).withColumn("scale", F.round(V.dynamic_scale(F.col("embedding")).cast("double"), 8))
    return _by_dimension(scaled, ["vec_id", "scale"], V.quantize(F.col("embedding"), "dynamic"), "code")


def int8_bytes(spark, sf):
    packed = embeddings(spark, sf).select("vec_id", quantized(F.col("embedding"))["vector_int8"].alias("packed"))
    codes = V.unpack_int8(F.col("packed"))
    return packed.select("vec_id", F.hex("packed").alias("packed_hex"), F.array_join(codes.cast("array<string>"), ",").alias("codes"))


def _reconstructed(spark, sf):
    vector = F.col("embedding")
    coded = embeddings(spark, sf).select("vec_id", "embedding", V.quantize(vector).alias("codes"), V.dynamic_scale(vector).alias("scale"))
    return coded.withColumn("reconstructed", V.dequantize(F.col("codes"), F.col("scale")))


def dequantize(spark, sf):
    exploded = _by_dimension(_reconstructed(spark, sf), ["vec_id"], F.col("reconstructed"), "value")
    return exploded.withColumn("value", F.round(F.col("value").cast("double"), 6))


def _rounded_error(df):
    return df.select(
        *[c for c in df.columns if c == "vec_id"],
        F.round("mse", 12).alias("mse"),
        F.round("max_absolute_error", 8).alias("max_absolute_error"),
        F.round("cosine_similarity", 9).alias("cosine_similarity"),
        F.round("cosine_distortion", 9).alias("cosine_distortion"),
        F.round("snr_db", 4).alias("snr_db"),
    )


def quantization_error(spark, sf):
    return _rounded_error(quality.quantization_error(_reconstructed(spark, sf), "embedding", "reconstructed"))


def quantization_error_rows(spark, sf):
    return _rounded_error(quality.quantization_error(_reconstructed(spark, sf), "embedding", "reconstructed", ("vec_id",)))


def cosine_matrix(spark, sf):
    matrix = search.cosine_matrix(embeddings(spark, sf), id_column="vec_id", vector_column="embedding", by_cosine=True)
    return matrix.withColumn("cosine", F.round("cosine", 6))


def pca_project(spark, sf):
    projected, ratios = project_pca(embeddings(spark, sf), 3, "vec_id", "embedding")
    parts = [F.round(F.col("projection")[i], 6).alias(f"pc{i + 1}") for i in range(3)]
    explained = [F.lit(round(r, 6)).alias(f"ratio{i + 1}") for i, r in enumerate(ratios)]
    return projected.select("vec_id", *parts, *explained)


def knn_topk(spark, sf):
    vectors = embeddings(spark, sf)
    queries = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    best = search.knn_topk(vectors, queries, 5, "vec_id", "embedding", payload=("label",))
    return best.withColumn("score", F.round("score", 6))


def knn_blocks(spark, sf):
    """The same search with queries in several blocks and clusters in several cells."""
    vectors = embeddings(spark, sf)
    queries = vectors.select(F.col("vec_id").alias("query_id"), F.col("embedding").alias("query_vector"))
    best = search.knn_topk(vectors, queries, 5, "vec_id", "embedding", payload=("label",), cell_rows=300, block_rows=200)
    return best.withColumn("score", F.round("score", 6))


def cosine_centres(spark, sf):
    """Every vector against the mean vector of each label: an output of rows times labels."""
    vectors = embeddings(spark, sf)
    values = vectors.select("label", F.posexplode("embedding").alias("dimension", "value"))
    means = values.groupBy("label", "dimension").agg(F.avg(F.col("value").cast("double")).alias("value"))
    in_order = F.transform(F.sort_array(F.collect_list(F.struct("dimension", "value"))), lambda v: v["value"])
    centres = means.groupBy("label").agg(in_order.cast("array<float>").alias("embedding")).select(F.col("label").cast("bigint").alias("vec_id"), "embedding")
    return search.cosine_matrix(vectors, centres, "vec_id", "embedding").withColumn("cosine", F.round("cosine", 5))


def semantic_search(spark, sf):
    vectors = chunks(spark, sf).select(
        "chunk_id",
        "chunk_content",
        "category",
        shard_id(F.col("chunk_id")).alias("partition_id"),
        hashed_embedding(F.col("chunk_content")).alias("vector_fp32"),
    )
    staged = cut_lineage(vectors)  # searched and joined back; in a job this is the staged dataset
    asked = spark.read.parquet(f"{sf}/benchmark.parquet").withColumnRenamed("item_id", "query_id")
    best = search.semantic_search(staged, asked, F.col("text"), 3)
    return best.withColumn("score", F.round("score", 6))


def dimension_compare(spark, sf):
    compared = quality.dimension_compare(_reconstructed(spark, sf), "vec_id", "embedding", "reconstructed")
    rounded = [F.round(F.col(c).cast("double"), 6).alias(c) for c in ("original", "reconstructed")]
    return compared.select("vec_id", "dimension", *rounded)


def storage_ratio(spark, sf):
    packed = embeddings(spark, sf).select("embedding", quantized(F.col("embedding"))["vector_int8"].alias("packed"))
    return quality.storage_ratio(packed, "embedding", "packed")


# --- partitioning ------------------------------------------------------------------


def shard_id_query(spark, sf):
    return chunks(spark, sf).select("chunk_id", shard_id(F.col("chunk_id")).alias("partition_id"))


def repartition_hash(spark, sf):
    """For each label, whether all its rows lie in the partition that the hash names."""
    placed = partitioning.partition_by_hash(embeddings(spark, sf).select("vec_id", "label"), "label")
    right = F.spark_partition_id() == F.pmod(F.hash("label"), F.lit(16))
    return placed.select("label", right.alias("right")).groupBy("label").agg(F.bool_and("right").alias("placed"), F.count("*").alias("vectors"))


def repartition_range(spark, sf):
    """For each label, whether its rows lie in one partition and no partition before it holds a larger label."""
    placed = partitioning.partition_by_range(embeddings(spark, sf).select("vec_id", "label"), "label")
    rows = cut_lineage(placed.select("label", F.spark_partition_id().alias("place")))
    of_label = rows.groupBy("label").agg(F.count_distinct("place").alias("places"), F.min("place").alias("place"), F.count("*").alias("vectors"))
    spans = rows.groupBy("place").agg(F.min("label").alias("low"), F.max("label").alias("high")).withColumnRenamed("place", "other")
    out_of_order = ((F.col("other") < F.col("place")) & (F.col("high") > F.col("label"))) | ((F.col("other") > F.col("place")) & (F.col("low") < F.col("label")))
    judged = of_label.join(F.broadcast(spans), F.lit(True)).groupBy("label", "places", "vectors").agg(F.bool_or(out_of_order).alias("wrong"), F.count("*").alias("n"))
    return judged.select("label", ((F.col("places") == 1) & ~F.col("wrong")).alias("placed"), (F.col("n") > 1).alias("several"), "vectors")


def shard_distribution(spark, sf):
    return partitioning.shard_distribution(shard_id_query(spark, sf))


# --- jobs --------------------------------------------------------------------------


def transform_chunks(spark, sf):
    return transform_all(spread(documents(spark, sf))).select(
        "chunk_id",
        "document_id",
        "source",
        "category",
        "chunk_index",
        "total_chunks",
        "chunk_content",
        "token_count",
        "start_char",
        "end_char",
        "zero_point",
        "partition_id",
    )


def transform_vectors(spark, sf):
    return transform_all(spread(documents(spark, sf))).select(
        "chunk_id",
        F.md5(F.hex("vector_int8")).alias("codes_md5"),
        F.round(F.col("scale_factor").cast("double"), 8).alias("scale_factor"),
        F.round(F.col("l2_norm").cast("double"), 4).alias("l2_norm"),
        F.size("vector_fp32").alias("dims"),
    )


def _run(spark, sf):
    settings = JobSettings(output_path=scratch_path(spark, "vectors"))
    return run_stages(spark, spread(documents(spark, sf)), settings)


def stage_counts(spark, sf):
    rows = [(m["stage_name"], m["input_records"], m["output_records"]) for m in _run(spark, sf)]
    return spark.createDataFrame(rows, "stage_name string, input_records bigint, output_records bigint")


def audit_report(spark, sf):
    """A whole job over the documents, stored as JSON lines, and its written report read back."""
    corpus, reports = scratch_path(spark, "lines"), scratch_path(spark, "report")
    spread(corpus_scan(spark, sf)).write.json(corpus)
    run_job(spark, JobSettings(input_path=corpus, output_path=scratch_path(spark, "vectors")), reports)
    return spark.read.schema(REPORT).json(reports).select(
        "status",
        "total_input_records",
        "total_output_vectors",
        F.array_join("stage_metrics.stage_name", ",").alias("stages"),
        F.array_join(F.col("stage_metrics.output_records").cast("array<string>"), ",").alias("stage_rows"),
        "quantization_mode",
        "vector_dimension",
        "num_partitions",
        "storage_sink",
        F.size("errors").alias("error_count"),
    )


QUERIES = {
    "corpus_scan": corpus_scan,
    "json_scan": json_scan,
    "rejected_records": rejected_records_query,
    "raw_defaults": raw_defaults_query,
    "capped_corpus": capped_corpus,
    "sink_roundtrip": sink_roundtrip,
    "dataset_summary": dataset_summary_query,
    "vector_upsert": vector_upsert,
    "nonblank_docs": nonblank_docs,
    "doc_counts": doc_counts,
    "min_words": min_words,
    "nfkc_docs": nfkc_docs,
    "strip_html": strip_html,
    "clean_text": clean_text,
    "clean_text_lower": clean_text_lower,
    "clean_pages": clean_pages,
    "clean_conversations": clean_conversations,
    "tokenize": tokenize,
    "lexical_stats": lexical_stats,
    "content_hash": content_hash,
    "exact_dedup": exact_dedup_query,
    "simhash": simhash,
    "simhash_groups": simhash_groups,
    "simhash_pairs": simhash_pairs,
    "minhash_signature": minhash_signature,
    "minhash_pairs": minhash_pairs,
    "near_dedup_simhash": near_dedup_simhash,
    "near_dedup_minhash": near_dedup_minhash,
    "chunk_docs": chunk_docs,
    "chunk_offsets": chunk_offsets,
    "embed_sparse": embed_sparse,
    "embed_norm": embed_norm,
    "embed_dense": embed_dense,
    "l2_normalize": l2_normalize,
    "quantize_fixed": quantize_fixed,
    "quantize_dynamic": quantize_dynamic,
    "int8_bytes": int8_bytes,
    "dequantize": dequantize,
    "quantization_error": quantization_error,
    "quantization_error_rows": quantization_error_rows,
    "cosine_matrix": cosine_matrix,
    "pca_project": pca_project,
    "knn_topk": knn_topk,
    "knn_blocks": knn_blocks,
    "cosine_centres": cosine_centres,
    "semantic_search": semantic_search,
    "dimension_compare": dimension_compare,
    "storage_ratio": storage_ratio,
    "shard_id": shard_id_query,
    "repartition_hash": repartition_hash,
    "repartition_range": repartition_range,
    "shard_distribution": shard_distribution,
    "transform_chunks": transform_chunks,
    "transform_vectors": transform_vectors,
    "stage_counts": stage_counts,
    "audit_report": audit_report,
}
