import json
from dataclasses import replace
from pathlib import Path

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.__main__ import main, overrides
from vecloom.plans.job import report_frame, run_job
from vecloom.plans.transform import JobSettings, clean_and_hash, transform_all
from vecloom.schemas import VECTOR
from vecloom.session import shared_folder
from vecloom.sources.corpus import read_corpus


def corpus(count):
    sentences = ["Leader election timed out during a network partition.", "Gene sequencing revealed heterogeneity in cells.", "Recurring revenue grew across all regions this year."]
    for i in range(count):
        body = " ".join(sentences[(i + j) % 3] for j in range(1 + i % 40))
        yield {
            "document_id": f"doc_{i:05d}",
            "content": f"### Record {i}\n\n<p>{body}</p>\n\nToken [ref](http://x/{i}).",
            "source": f"stream_{i % 3}",
            "category": "c",
            "timestamp": "2026-01-01T00:00:00Z",
        }


@pytest.fixture
def settings(tmp_path):
    path = tmp_path / "input.jsonl"
    rows = [*corpus(15), {**next(corpus(1)), "document_id": "copy"}, {"document_id": "blank", "content": "  "}, {"document_id": "short", "content": "two words"}]
    path.write_text("\n".join(json.dumps(r) for r in rows), encoding="utf-8")
    return JobSettings(input_path=str(path), output_path=str(tmp_path / "vectors.parquet"), chunk_size=64, chunk_overlap=8, shards=2)


def test_transform_gives_the_declared_rows(spark, settings):
    vectors = transform_all(read_corpus(spark, settings.input_path), settings)
    assert [(f.name, f.dataType) for f in vectors.schema] == [(f.name, f.dataType) for f in VECTOR]
    rows = vectors.collect()
    documents = {r.document_id for r in rows}
    assert len(documents) == 15 and "blank" not in documents and "short" not in documents
    assert len({"copy", "doc_00000"} & documents) == 1 and "copy" in documents  # the smaller id stays
    for r in rows:
        v = np.array(r.vector_fp32)
        assert len(v) == 384 and len(r.vector_int8) == 384 and 0 <= r.partition_id < 2
        assert r.l2_norm == pytest.approx(1.0, abs=1e-5) and r.zero_point == 0
        assert np.abs(v - np.frombuffer(r.vector_int8, np.int8) * r.scale_factor).max() <= r.scale_factor * 0.5001
        assert r.metadata is None or isinstance(r.metadata, dict)


def test_transform_switches(spark, settings):
    raw = read_corpus(spark, settings.input_path)
    everything = transform_all(raw, replace(settings, deduplicate=False, min_words=1))
    assert {"copy", "doc_00000", "short"} <= {r.document_id for r in everything.select("document_id").collect()}
    fp32 = transform_all(raw, replace(settings, quantization="FP32")).first()
    assert fp32.vector_int8 is None and fp32.scale_factor == 1.0
    fixed = transform_all(raw, replace(settings, quantizer="fixed", dim=64, normalize_l2=False)).first()
    assert fixed.scale_factor == pytest.approx(2.5 / 127) and len(fixed.vector_fp32) == 64 and fixed.l2_norm != pytest.approx(1.0)


def test_settings_are_checked():
    for wrong in ({"chunk_overlap": 256}, {"quantization": "INT4"}, {"strategy": "random"}, {"quantizer": "x"}):
        with pytest.raises(ValueError):
            JobSettings(**wrong)


def test_cleaning_runs_once_and_building_starts_no_job(spark, settings, plan_of):
    raw = read_corpus(spark, settings.input_path).repartition(64)
    cleaned = plan_of(clean_and_hash(raw, settings))
    assert cleaned.count("[_unicode_batch") == 1 and cleaned.count("<[^>]+>") == 1
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    spark.sparkContext.setJobGroup("building", "transform_all")
    plan = plan_of(transform_all(raw, settings))
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("building")
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert set(folder.iterdir()) == before
    assert plan.count("[_unicode_batch") == 1 and plan.count("Exchange hashpartitioning") == 1


def test_scratch_goes_when_the_job_ends(spark, settings):
    folder = Path(shared_folder(spark).removeprefix("file:"))
    before = set(folder.iterdir())
    assert run_job(spark, replace(settings, strategy="range"))["status"] == "SUCCESS"
    assert set(folder.iterdir()) == before and spark.read.parquet(settings.output_path).count() > 15


def test_rejected_rows_are_counted(spark, settings):
    with open(settings.input_path, "a", encoding="utf-8") as lines:
        lines.write('\n{"content": "no id here at all today"}\n{"document_id": "empty"}\n{"document_id": "bro')
    report = run_job(spark, settings)
    assert report["total_input_records"] == 21 and report["stage_metrics"][0]["output_records"] == 18


@pytest.mark.parametrize("strategy", ["hash", "range"])
def test_job_end_to_end(spark, settings, tmp_path, strategy):
    report = run_job(spark, replace(settings, strategy=strategy), str(tmp_path / "report"))
    assert report["status"] == "SUCCESS" and report["errors"] == []
    stages = {m["stage_name"]: m for m in report["stage_metrics"]}
    assert stages["ingest"]["output_records"] == report["total_input_records"] == 18
    assert stages["clean_and_hash"]["output_records"] == 16 and stages["deduplicate"]["output_records"] == 15
    written = spark.read.parquet(settings.output_path)
    assert written.count() == report["total_output_vectors"] == stages["chunk_and_explode"]["output_records"] >= 15
    assert report["overall_throughput_records_per_sec"] > 0 and all(m["duration_seconds"] >= 0.001 for m in stages.values())
    stored = spark.read.json(str(tmp_path / "report")).first()
    assert stored.status == "SUCCESS" and stored.total_input_records == 18
    assert spark.range(1).count() == 1  # the caller's session stays open


def test_record_cap(spark, settings):
    report = run_job(spark, replace(settings, max_records=5))
    assert report["total_input_records"] == 5


def test_failure_is_reported(spark, settings):
    report = run_job(spark, replace(settings, input_path="/nowhere/at/all.parquet"))
    assert report["status"] == "FAILED" and report["total_input_records"] == report["total_output_vectors"] == 0
    assert len(report["errors"]) == 1 and report_frame(spark, report).first().status == "FAILED"


def test_metadata_travels(spark, tmp_path):
    path = tmp_path / "m.jsonl"
    path.write_text(json.dumps({"document_id": "m", "content": "one two three four five six", "metadata": {"author": "x"}}))
    row = transform_all(read_corpus(spark, str(path))).first()
    assert row.metadata == {"author": "x"} and row.source == "unknown"


def test_command_line(spark, settings, capsys):
    argv = ["run", "--input", settings.input_path, "--output", settings.output_path, "--set", "shards=4", "--set", "deduplicate=false"]
    assert main(argv) == 0
    assert "status: SUCCESS" in capsys.readouterr().out
    assert main(["search", "--vectors", settings.output_path, "--top-k", "2"]) == 0
    assert main(["search", "--vectors", settings.output_path, "--text", "leader election"]) == 0
    assert main(["run", "--input", "/nowhere.parquet", "--output", settings.output_path]) == 1


def test_overrides():
    assert overrides(["dim=64", "clip=1.5", "deduplicate=no", "max_records=7"]) == {"dim": 64, "clip": 1.5, "deduplicate": False, "max_records": 7}
    with pytest.raises(ValueError):
        overrides(["unknown=1"])
