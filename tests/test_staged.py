import json
import os
import subprocess
import sys
from pathlib import Path

import pytest

from vecloom.plans import staged
from vecloom.plans.job import run_job
from vecloom.plans.transform import JobSettings
from vecloom.sources.corpus import read_corpus, rejected_records, store_judged, stored_corpus, stored_rejects

ROOT = Path(__file__).resolve().parents[1]


@pytest.fixture
def settings(tmp_path):
    texts = [f"document {i % 17} has some words of its own number {i % 17} here" for i in range(20)] + ["too short", "  "]
    lines = [json.dumps({"document_id": f"d{i:02d}", "content": t}) for i, t in enumerate(texts)]
    lines += ['{"content": "no id in this one at all"}', '{"document_id": "empty"}', '{"document_id": "bro']
    (tmp_path / "in.jsonl").write_text("\n".join(lines) + "\n")
    return JobSettings(input_path=str(tmp_path / "in.jsonl"), output_path=str(tmp_path / "out"), chunk_size=8, chunk_overlap=2, dim=32, shards=2, staging_path=str(tmp_path / "kept"))


WANT = [("ingest", 25, 22), ("clean_and_hash", 22, 20), ("deduplicate", 20, 17), ("chunk_and_explode", 17, 34), ("embed_and_normalize", 34, 34), ("quantize_and_shard", 34, 34), ("sink", 34, 34)]


def counts(report):
    return [(m["stage_name"], m["input_records"], m["output_records"]) for m in report["stage_metrics"]]


def test_stages_have_counts_and_durations_of_their_own(spark, settings):
    report = run_job(spark, settings)
    assert report["errors"] == [] and counts(report) == WANT
    assert report["total_input_records"] == 25 and report["total_output_vectors"] == 34
    assert len({m["duration_seconds"] for m in report["stage_metrics"]}) > 3
    assert spark.read.parquet(settings.output_path).count() == 34


def test_a_second_start_goes_on_where_the_first_broke_off(spark, settings, monkeypatch):
    ran = []

    def counted(stage, fails=False):
        def run(df, s):
            ran.append(stage.__name__)
            if fails:
                raise RuntimeError("lost")
            return stage(df, s)

        run.__name__ = stage.__name__
        return run

    monkeypatch.setattr(staged, "STAGES", [counted(s, s.__name__ == "embed_and_normalize") for s in staged.STAGES])
    first = run_job(spark, settings)
    assert first["status"] == "FAILED" and "lost" in first["errors"][0]
    before = {p: p.stat().st_mtime_ns for p in Path(settings.staging_path).rglob("*.parquet")}
    monkeypatch.undo()
    second = run_job(spark, settings)
    assert second["status"] == "SUCCESS" and counts(second) == WANT
    after = {p: p.stat().st_mtime_ns for p in Path(settings.staging_path).rglob("*.parquet")}
    assert before.items() <= after.items()
    assert len([p for p in Path(settings.staging_path).glob("0*_*/*") if p.is_dir()]) == 6
    assert run_job(spark, settings)["stage_metrics"] == second["stage_metrics"]
    assert run_job(spark, JobSettings(**{**vars(settings), "dim": 64}))["status"] == "FAILED"


SCRIPT = """
import sys, tempfile
from pyspark import TaskContext
from pyspark.sql import SparkSession
from vecloom.plans import staged
from vecloom.plans.job import run_job
from vecloom.plans.transform import JobSettings

spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.sql.shuffle.partitions", "2").config("spark.checkpoint.dir", tempfile.mkdtemp(dir=sys.argv[1])).getOrCreate()

def failing(stage):
    def once(batches):
        for batch in batches:
            yield batch
        if TaskContext.get().attemptNumber() == 0:
            raise RuntimeError("a task is lost after its rows")

    def run(df, settings):
        out = stage(df, settings)
        return out.mapInArrow(once, out.schema)

    run.__name__ = stage.__name__
    return run

staged.STAGES = [failing(s) if s.__name__ == "clean_and_hash" else s for s in staged.STAGES]
settings = JobSettings(**eval(sys.argv[2]))
print("COUNTS", [(m["stage_name"], m["input_records"], m["output_records"]) for m in run_job(spark, settings)["stage_metrics"]])
"""


def test_counts_are_exact_when_tasks_fail(settings, tmp_path):
    done = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path), repr(vars(settings))], cwd=ROOT, capture_output=True, text=True, timeout=300, env={**os.environ, "PYTHONPATH": str(ROOT)})
    assert f"COUNTS {WANT}" in done.stdout, done.stderr[-2000:]
    assert "a task is lost" in done.stderr


def test_one_scan_stores_accepted_and_rejected_rows(spark, settings, tmp_path):
    target = str(tmp_path / "judged")
    store_judged(spark, settings.input_path, target, ingested_at="now")
    want = read_corpus(spark, settings.input_path, ingested_at="now")
    assert stored_corpus(spark, target).schema.names == want.schema.names
    assert sorted(map(str, stored_corpus(spark, target).collect())) == sorted(map(str, want.collect()))
    assert sorted(map(str, stored_rejects(spark, target).collect())) == sorted(map(str, rejected_records(spark, settings.input_path).collect()))
    assert {r.reason for r in stored_rejects(spark, target).collect()} == {"malformed", "no id", "no content"}
