"""Times the headline queries and the stages of the transform; prints one JSON line.

Stage figures are rows per second of one stage alone, its construction included: its input is written out first.
"""

from __future__ import annotations

import json
import os
import sys
import tempfile
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

from pyspark.sql import DataFrame, SparkSession  # noqa: E402

from vecloom.catalog.queries import QUERIES, documents  # noqa: E402
from vecloom.plans import transform as stages  # noqa: E402
from vecloom.sources.corpus import read_corpus, spread  # noqa: E402
from vecloom.session import SETTINGS, cut_lineage, scratch_path  # noqa: E402
from vecloom.sources.parquet_sink import write_dataset  # noqa: E402

SF = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
HEADLINE = [
    "clean_text",
    "clean_pages",
    "tokenize",
    "exact_dedup",
    "simhash",
    "simhash_pairs",
    "minhash_pairs",
    "near_dedup_simhash",
    "near_dedup_minhash",
    "chunk_docs",
    "chunk_offsets",
    "quantize_dynamic",
    "int8_bytes",
    "quantization_error",
    "knn_topk",
    "knn_blocks",
    "semantic_search",
    "pca_project",
    "transform_chunks",
    "transform_vectors",
    "stage_counts",
]


def session() -> SparkSession:
    builder = SparkSession.builder.master(f"local[{CPUS}]").appName("bench")
    settings = SETTINGS | {
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": CPUS,
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": tempfile.mkdtemp(prefix="bench-"),
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def run(df: DataFrame) -> float:
    started = time.time()
    df.write.format("noop").mode("overwrite").save()
    return time.time() - started


def stage_rates(spark: SparkSession) -> dict[str, float]:
    """Rows per second of each stage, second of two runs."""
    settings = stages.JobSettings()
    df = cut_lineage(spread(documents(spark, SF)))
    rates = {}
    lines, rows = scratch_path(spark, "lines"), df.count()
    df.drop("metadata").write.json(lines)
    run(read_corpus(spark, lines))
    rates["ingest"] = round(rows / run(read_corpus(spark, lines)))
    for stage in stages.STAGES:
        rows = df.count()
        run(stage(df, settings))
        started = time.time()
        result = stage(df, settings)
        run(result)
        seconds = time.time() - started
        done = cut_lineage(result)
        unit = done.count() if stage is stages.chunk_and_explode else rows
        rates[stage.__name__] = round(unit / seconds)
        df = done
    vectors = stages.vector_payload_of(df)
    rows = df.count()
    write_dataset(stages.lay_out(vectors, settings), scratch_path(spark, "warm"))
    started = time.time()
    write_dataset(stages.lay_out(vectors, settings), scratch_path(spark, "sink"))
    rates["sink"] = round(rows / (time.time() - started))
    return rates


def main() -> None:
    spark = session()
    run(documents(spark, SF))
    rates = stage_rates(spark)
    times = {}
    for name in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(","):
        started = time.time()
        run(QUERIES[name](spark, SF))
        times[name] = round(time.time() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total time of the headline queries",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "stage_rows_per_sec": rates,
                "sf": SF.rsplit("sf", 1)[-1],
                "cpus": int(CPUS),
                "spark": spark.version,
            }
        )
    )


if __name__ == "__main__":
    main()
