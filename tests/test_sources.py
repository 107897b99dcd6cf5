import json

import pytest
from pyspark.sql import functions as F

from vecloom.schemas import RAW, VECTOR, raw_defaults
from vecloom.session import build_session, cut_lineage, scratch_path, shared_folder
from vecloom.sources.collection import upsert, upsert_collection
from vecloom.sources.corpus import cap_records, corrupt_records, read_corpus, rejected_records, spread
from vecloom.sources.footers import footer_statistics
from vecloom.sources.parquet_sink import dataset_summary, write_dataset


def records(count):
    return [
        {"document_id": f"doc_{i:05d}", "content": f"text number {i}", "source": f"s{i % 3}", "category": "c", "timestamp": "2026-01-01T00:00:00Z"}
        for i in range(count)
    ]


@pytest.fixture
def jsonl(tmp_path):
    path = tmp_path / "docs.jsonl"
    lines = [json.dumps(r) for r in records(12)]
    lines.insert(3, '{"document_id": "broken", "content": ')
    lines.append(json.dumps({"document_id": "bare", "content": "only required", "metadata": {"k": "v"}}))
    path.write_text("\n".join(lines) + "\n", encoding="utf-8")
    return str(path)


def test_json_corpus(spark, jsonl):
    df = read_corpus(spark, jsonl, ingested_at="now")
    assert df.columns == RAW.names and [f.dataType for f in df.schema] == [f.dataType for f in RAW]
    rows = {r.document_id: r for r in df.collect()}
    assert len(rows) == 13 and "broken" not in rows
    bare = rows["bare"]
    assert (bare.source, bare.category, bare.timestamp, bare.metadata) == ("unknown", "general", "now", {"k": "v"})
    assert rows["doc_00000"].metadata == {} and rows["doc_00000"].timestamp == "2026-01-01T00:00:00Z"


def test_malformed_lines_are_reported(spark, jsonl):
    (bad,) = corrupt_records(spark, jsonl).collect()
    assert bad.line.startswith('{"document_id": "broken"') and bad.file.endswith("docs.jsonl")


def test_parquet_corpus_with_renamed_columns(spark, tmp_path):
    path = str(tmp_path / "in.parquet")
    spark.createDataFrame([(7, "x")], "doc_id bigint, text string").write.parquet(path)
    row = read_corpus(spark, path, columns={"document_id": "doc_id", "content": "text"}).first()
    assert (row.document_id, row.content, row.source) == ("7", "x", "unknown") and "T" in row.timestamp


def test_parquet_scan_reads_only_needed_columns(spark, tmp_path, plan_of):
    path = str(tmp_path / "in.parquet")
    spark.createDataFrame([("7", "x", "s", 1)], "document_id string, content string, source string, extra int").write.parquet(path)
    # the content is read, as a row without it is rejected
    assert "ReadSchema: struct<document_id:string,content:string>" in plan_of(read_corpus(spark, path).select("document_id"))


def test_every_row_is_read_or_rejected(spark, tmp_path):
    rows = [("a", "x"), (None, "y"), ("b", None), (None, None), ("a", "x")]
    stored, lines = str(tmp_path / "in.parquet"), tmp_path / "in.jsonl"
    spark.createDataFrame(rows, "document_id string, content string").write.parquet(stored)
    spark.createDataFrame(rows, "document_id string, content string").coalesce(1).write.json(str(lines))
    (lines / "more.json").write_text('{"document_id": "c", "conte\n')
    for path, broken in ((stored, 0), (str(lines), 1)):
        assert sorted(r.document_id for r in read_corpus(spark, path).collect()) == ["a", "a"]
        found = rejected_records(spark, path).collect()
        assert sorted(r.reason for r in found) == ["malformed"] * broken + ["no content", "no id", "no id"]
        assert len(corrupt_records(spark, path).collect()) == broken
        assert any('"content":"y"' in r.line for r in found)


def test_record_cap_goes_by_id(spark, jsonl):
    ids = [r.document_id for r in read_corpus(spark, jsonl, max_records=3).collect()]
    assert sorted(ids) == ["bare", "doc_00000", "doc_00001"]


def test_defaults_fill_nulls(spark):
    df = spark.createDataFrame([("1", "x", None)], "document_id string, content string, source string")
    assert raw_defaults(df, "t").first().source == "unknown"


def test_spread_leaves_large_scans_alone(spark):
    small, large = spark.range(0, 10, 1, 1), spark.range(0, 1000, 1, 64)
    assert spread(small).rdd.getNumPartitions() == 16
    assert spread(large) is large
    assert spread(small, max_bytes=10) is small


def shards(spark):
    return spark.range(50).select(F.concat(F.lit("c_"), "id").alias("chunk_id"), F.lit(384).alias("vector_dim"), (F.col("id") % 4).cast("int").alias("partition_id"))


def test_sink_and_summary(spark, tmp_path, plan_of):
    path = str(tmp_path / "out")
    write_dataset(shards(spark), path)
    write_dataset(shards(spark), path)  # overwrites
    summary = dataset_summary(spark, path).first()
    assert summary.total_records == 50 and summary.file_count >= 4 and summary.error is None
    assert "chunk_id" in summary.schema_fields and "partition_id" in summary.schema_fields
    assert len(summary.parquet_files) == min(10, summary.file_count)
    assert sorted(p.name for p in (tmp_path / "out").glob("partition_id=*")) == [f"partition_id={i}" for i in range(4)]
    pruned = plan_of(spark.read.parquet(path).filter("partition_id = 2"))
    assert "PartitionFilters: [isnotnull(partition_id" in pruned


def test_footers_tell_the_ends_of_every_file(spark, tmp_path):
    path = str(tmp_path / "out")
    rows = spark.createDataFrame([(i, None if i % 5 == 0 else f"t{i:02d}", i % 3, None) for i in range(40)], "id int, t string, partition_id int, nothing double")
    rows.repartition(4).write.partitionBy("partition_id").parquet(path)
    read = spark.read.parquet(path).groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count("*").alias("n"), F.min("id").alias("a"), F.max("id").alias("b"), F.max("t").alias("t"), F.count_if(F.col("t").isNull()).alias("nulls"))
    want = {r.file: (r.n, str(r.a), str(r.b), r.t, r.nulls) for r in read.collect()}
    found = {}
    for r in footer_statistics(spark, path).collect():
        columns = {c.name: c for c in r.columns}
        assert r.bytes > 0 and r.row_groups == 1 and columns["nothing"].low is None and columns["nothing"].nulls == r.row_count
        found[r.file] = (r.row_count, columns["id"].low, columns["id"].high, columns["t"].high, columns["t"].nulls)
    assert found == want and len(found) > 8


@pytest.mark.parametrize("cap", [1, 700, 1501, 2999, 3000, 5000])
def test_large_caps_are_cut_by_ranges(spark, cap):
    df = spark.range(0, 3000, 1, 7).select(F.md5(F.col("id").cast("string")).alias("document_id"), "id")
    found = cap_records(df, cap, at_once=200)
    want = sorted(r.document_id for r in df.collect())[:cap]
    assert sorted(r.document_id for r in found.collect()) == want


def test_caps_with_many_equal_ids(spark):
    df = spark.range(1000).select(F.when(F.col("id") < 600, "same").otherwise(F.col("id").cast("string")).alias("document_id"))
    found = [r.document_id for r in cap_records(df, 500, at_once=50).collect()]
    assert len(found) == 500 and found.count("same") == 100


def test_summary_of_a_missing_path(spark, tmp_path):
    row = dataset_summary(spark, str(tmp_path / "nothing")).first()
    assert row.total_records == 0 and "PATH_NOT_FOUND" in row.error


POINT = "id string, label int, write_order int"


def test_upsert_last_write_wins(spark):
    current = spark.createDataFrame([("a", 1), ("b", 2)], "id string, label int")
    hot = [("b", i, i) for i in range(300)]
    batch = spark.createDataFrame([*hot, ("c", 5, 1), ("c", 4, 0)], POINT).repartition(7)
    assert {tuple(r) for r in upsert(current, batch).collect()} == {("a", 1), ("b", 299), ("c", 5)}
    assert {tuple(r) for r in upsert(None, batch).collect()} == {("b", 299), ("c", 5)}


def test_upsert_collection_snapshots(spark, tmp_path):
    one, two = str(tmp_path / "one"), str(tmp_path / "two")
    assert upsert_collection(spark, None, one, spark.createDataFrame([("a", 1, 0), ("a", 2, 1)], POINT)) == 2
    assert upsert_collection(spark, one, two, spark.createDataFrame([("b", 3, 0)], POINT)) == 1
    assert {tuple(r) for r in spark.read.parquet(one).collect()} == {("a", 2)}
    assert {tuple(r) for r in spark.read.parquet(two).collect()} == {("a", 2), ("b", 3)}
    with pytest.raises(ValueError):
        upsert_collection(spark, two, two, spark.createDataFrame([("b", 3, 0)], POINT))


def test_shared_folder_comes_from_the_session(spark):
    configured = spark.conf.get("spark.checkpoint.dir")
    assert configured in shared_folder(spark)
    assert scratch_path(spark, "x") != scratch_path(spark, "x") and scratch_path(spark, "x").startswith(shared_folder(spark))


def test_cut_lineage_keeps_rows(spark, plan_of):
    cut = cut_lineage(spark.range(5).filter("id > 2"))
    plan = plan_of(cut)
    assert cut.count() == 2 and "Range" not in plan and "FileScan parquet" in plan


def test_session_settings(spark):
    session = build_session("tests", spark__sql__execution__arrow__maxRecordsPerBatch=10000)
    assert session.conf.get("spark.sql.parquet.filterPushdown") == "true"
    assert session.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch") == "10000"


def test_vector_schema_names():
    assert {"chunk_id", "vector_fp32", "vector_int8", "scale_factor", "zero_point", "l2_norm", "partition_id"} <= set(VECTOR.names)
