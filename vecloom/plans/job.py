"""Batch runner with stage counts and an audit report."""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass, field
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from vecloom.plans.staged import run_staged
from vecloom.plans.transform import STAGES, JobSettings, lay_out, layout_keys, vector_payload_of
from vecloom.sources.corpus import accepted, cap_records, judged_corpus, spread
from vecloom.session import scratch_scope
from vecloom.sources.parquet_sink import write_dataset

STAGE_METRIC = (
    "struct<stage_name:string,input_records:bigint,output_records:bigint,"
    "duration_seconds:double,throughput_records_per_sec:double>"
)
REPORT = (
    "job_id string, status string, started_at string, completed_at string, total_duration_seconds double, "
    "total_input_records bigint, total_output_vectors bigint, overall_throughput_records_per_sec double, "
    f"stage_metrics array<{STAGE_METRIC}>, quantization_mode string, vector_dimension int, num_partitions int, "
    "storage_sink string, errors array<string>"
)


def _counted(df: DataFrame, name: str) -> tuple[DataFrame, Observation]:
    seen = Observation(f"{name}-{uuid.uuid4().hex}")
    return df.observe(seen, F.count(F.lit(1)).alias("rows")), seen


def _now() -> str:
    return datetime.now(timezone.utc).isoformat()


def _metric(name: str, rows_in: int, rows_out: int, seconds: float) -> dict:
    return {
        "stage_name": name,
        "input_records": rows_in,
        "output_records": rows_out,
        "duration_seconds": round(seconds, 3),
        "throughput_records_per_sec": round(rows_out / seconds, 2),
    }


def run_stages(spark: SparkSession, raw: DataFrame, settings: JobSettings, judged: bool = False) -> list[dict]:
    """Write the vectors of ``raw`` to the output path and return one metric per stage.

    Observations count the rows at the stages' borders, so nothing is counted by an extra job.
    With ``judged``, ``raw`` comes from ``judged_corpus``: the rows it rejects enter the first
    stage and do not leave it; a record cap is part of reading and counts accepted rows only. All stages report the duration of the whole, as they run
    together. Observed counts can run high when lost executors make tasks run again; the
    sink's count comes from the written files and is always exact.
    """
    started = time.time()
    if judged and settings.max_records:
        raw, judged = cap_records(accepted(raw), settings.max_records), False
    df, seen = _counted(raw, "read")
    borders = [("read", seen)]
    df = accepted(df) if judged else df
    for name, stage in [("ingest", None), *((s.__name__, s) for s in STAGES)]:
        df = stage(df, settings) if stage else df
        if name == "chunk_and_explode":
            keys = layout_keys(df, settings)
        if name in ("ingest", "clean_and_hash", "deduplicate", "chunk_and_explode"):
            df, seen = _counted(df, name)
            borders.append((name, seen))
    write_dataset(
        lay_out(vector_payload_of(df), settings, keys),
        settings.output_path,
        settings.partition_key,
        compression=settings.compression,
        row_group_mb=settings.row_group_mb,
    )
    seconds = max(time.time() - started, 0.001)
    rows = [int(seen.get["rows"]) for _, seen in borders] + [spark.read.parquet(settings.output_path).count()]
    names = [name for name, _ in borders[1:]] + ["sink"]
    return [_metric(name, before, after, seconds) for name, before, after in zip(names, rows, rows[1:])]


@dataclass
class JobReport:
    """What a run did. The field names are the published layout; all values come from settings and metrics."""

    quantization_mode: str
    vector_dimension: int
    num_partitions: int
    storage_sink: str = "parquet"
    job_id: str = field(default_factory=lambda: str(uuid.uuid4()))
    status: str = "FAILED"
    started_at: str = field(default_factory=_now)
    completed_at: str = ""
    total_duration_seconds: float = 0.0
    total_input_records: int = 0
    total_output_vectors: int = 0
    overall_throughput_records_per_sec: float = 0.0
    stage_metrics: list[dict] = field(default_factory=list)
    errors: list[str] = field(default_factory=list)

    def finish(self, metrics: list[dict]) -> None:
        """A run that wrote its vectors."""
        self.status, self.stage_metrics = "SUCCESS", metrics
        self.total_input_records, self.total_output_vectors = metrics[0]["input_records"], metrics[-1]["output_records"]

    def close(self, seconds: float) -> None:
        self.completed_at, self.total_duration_seconds = _now(), round(seconds, 3)
        self.overall_throughput_records_per_sec = round(self.total_output_vectors / max(seconds, 0.001), 2)


@contextmanager
def reported(spark: SparkSession, settings: JobSettings, path: str | None) -> Iterator[JobReport]:
    """A report that is closed and stored however the block ends; a failure is listed in it and goes no further."""
    report = JobReport(settings.quantization, settings.dim, settings.shards)
    clock = time.time()
    try:
        yield report
    except Exception as failure:  # every failure belongs in the report
        report.errors.append(str(failure))
    report.close(time.time() - clock)
    if path:
        report_frame(spark, asdict(report)).coalesce(1).write.mode("overwrite").json(path)


def run_job(spark: SparkSession, settings: JobSettings, report_path: str | None = None) -> dict:
    """Ingest, transform and write; any failure gives a FAILED report with zero counts.

    The session belongs to the caller and stays open; scratch tables go when the run ends. With
    ``staging_path`` every stage is kept there: each has a duration of its own and exact counts,
    and a second start goes on where the first one broke off. Without, all stages run together
    in one pass, which moves less, and share its duration.
    """
    with reported(spark, settings, report_path) as report, scratch_scope(spark):
        if settings.staging_path:
            done = run_staged(spark, settings)
            report.finish([_metric(e["stage"], e["input_records"], e["output_records"], e["seconds"]) for e in done])
        else:
            report.finish(run_stages(spark, spread(judged_corpus(spark, settings.input_path)), settings, judged=True))
    return asdict(report)


def report_frame(spark: SparkSession, report: dict) -> DataFrame:
    """The report as one row."""
    return spark.createDataFrame([json.dumps(report)], "string").select(F.from_json("value", REPORT).alias("r")).select("r.*")
