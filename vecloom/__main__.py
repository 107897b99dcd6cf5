"""Command line: ``run`` a batch job, ``search`` staged vectors."""

from __future__ import annotations

import argparse
import sys
from dataclasses import fields, replace

from pyspark.sql import functions as F

from vecloom.operators.search import knn_topk, semantic_search
from vecloom.plans.job import run_job
from vecloom.plans.transform import JobSettings
from vecloom.session import build_session


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="vecloom")
    commands = parser.add_subparsers(dest="command", required=True)
    run = commands.add_parser("run", help="turn a corpus into staged vectors")
    run.add_argument("--input", required=True)
    run.add_argument("--output", required=True)
    run.add_argument("--quantization", choices=["INT8", "FP32"], default="INT8")
    run.add_argument("--report", help="folder for the audit report (JSON)")
    run.add_argument("--set", action="append", default=[], metavar="NAME=VALUE", help="any other job setting")
    search = commands.add_parser("search", help="nearest staged vectors of a text or of the first vector")
    search.add_argument("--vectors", required=True)
    search.add_argument("--text")
    search.add_argument("--top-k", type=int, default=5)
    return parser


def overrides(pairs: list[str]) -> dict:
    """NAME=VALUE settings, converted to the type of the setting's default."""
    defaults = {f.name: f.default for f in fields(JobSettings)}
    values = {}
    for pair in pairs:
        name, _, text = pair.partition("=")
        if name not in defaults:
            raise ValueError(f"unknown setting: {name}")
        kind = int if defaults[name] is None else type(defaults[name])
        values[name] = text.lower() in ("1", "true", "yes") if kind is bool else kind(text)
    return values


def main(argv: list[str] | None = None) -> int:
    args = _parser().parse_args(argv)
    spark = build_session()
    if args.command == "run":
        settings = JobSettings(input_path=args.input, output_path=args.output, quantization=args.quantization)
        report = run_job(spark, replace(settings, **overrides(args.set)), args.report)
        for name in ("job_id", "status", "total_input_records", "total_output_vectors", "total_duration_seconds", "errors"):
            print(f"{name}: {report[name]}")
        return 0 if report["status"] == "SUCCESS" else 1

    vectors = spark.read.parquet(args.vectors)
    if args.text:
        queries = spark.createDataFrame([(0, args.text)], "query_id int, text string")
        found = semantic_search(vectors, queries, F.col("text"), args.top_k)
    else:
        first = vectors.orderBy("chunk_id").limit(1)
        queries = first.select(F.lit(0).alias("query_id"), F.col("vector_fp32").alias("query_vector"))
        found = knn_topk(vectors, queries, args.top_k, "chunk_id", "vector_fp32")
    found.orderBy("rank").show(args.top_k, truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
