"""A job in stages that are kept: exact counts, a duration for each, and a start where an earlier one broke off.

    folder/settings             what the job was started with
    folder/<n>_<stage>/<uuid>   a stage's rows, one folder per attempt
    folder/manifest/<n>_<stage> one line once the stage is complete: its folder, rows in and out, seconds

A stage counts once its manifest entry is complete. Rows are counted in the files that
committed tasks left, so tasks that ran again, or attempts that broke off, add nothing.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, SparkSession

from vecloom.plans.transform import STAGES, JobSettings, lay_out, vector_payload_of
from vecloom.session import path_exists
from vecloom.sources.corpus import cap_records, spread, store_judged, stored_corpus
from vecloom.sources.parquet_sink import write_dataset

_ENTRY = "stage string, path string, input_records bigint, output_records bigint, seconds double"


class Staging:
    def __init__(self, spark: SparkSession, folder: str, settings: JobSettings):
        self.spark, self.folder = spark, folder
        started = json.dumps(asdict(settings), sort_keys=True)
        if path_exists(spark, f"{folder}/settings/_SUCCESS"):
            if (found := spark.read.text(f"{folder}/settings").first()[0]) != started:
                raise ValueError(f"{folder} holds a job with other settings: {found}")
        else:
            spark.createDataFrame([(started,)], "value string").coalesce(1).write.mode("overwrite").text(f"{folder}/settings")
        self.entries: list[dict] = []

    def stage(self, name: str, write: Callable[[str], None], count: Callable[[str], tuple[int | None, int]], path: str | None = None) -> str:
        """Runs ``write`` to a new folder (or ``path``) unless the stage is complete; where its rows are."""
        label = f"{len(self.entries):02d}_{name}"
        entry = f"{self.folder}/manifest/{label}"
        if not path_exists(self.spark, f"{entry}/_SUCCESS"):
            target = path or f"{self.folder}/{label}/{uuid.uuid4().hex}"
            started = time.time()
            write(target)
            seconds = max(time.time() - started, 0.001)
            before, after = count(target)
            before = self.entries[-1]["output_records"] if before is None else before
            row = [(name, target, before, after, seconds)]
            self.spark.createDataFrame(row, _ENTRY).coalesce(1).write.mode("overwrite").json(entry)
        self.entries.append(self.spark.read.schema(_ENTRY).json(entry).first().asDict())
        return self.entries[-1]["path"]


def run_staged(spark: SparkSession, settings: JobSettings) -> list[dict]:
    """The whole job with every stage kept below ``settings.staging_path``; entries of the manifest in order.

    The input is scanned once: accepted and rejected rows are written together and read apart.
    A second start with equal settings goes on after the last complete stage.
    """
    kept = Staging(spark, settings.staging_path, settings)

    def rows(path: str) -> DataFrame:
        return spark.read.parquet(path)

    def ingested(path: str) -> DataFrame:
        df = stored_corpus(spark, path)
        return cap_records(df, settings.max_records) if settings.max_records else df

    path = kept.stage("ingest", lambda target: store_judged(spark, settings.input_path, target), lambda target: (rows(target).count(), ingested(target).count()))
    for i, stage in enumerate(STAGES):
        source = spread(ingested(path)) if i == 0 else rows(path)
        df = stage(source, settings)
        path = kept.stage(stage.__name__, lambda target, df=df: df.write.parquet(target), lambda target: (None, rows(target).count()))

    def sink(target: str) -> None:
        laid = lay_out(vector_payload_of(rows(path)), settings)
        write_dataset(laid, target, settings.partition_key, compression=settings.compression, row_group_mb=settings.row_group_mb)

    kept.stage("sink", sink, lambda target: (None, rows(target).count()), settings.output_path)
    return kept.entries
