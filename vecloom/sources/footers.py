"""What Parquet footers say of a dataset's files, read by the executors; no row group is read."""

from __future__ import annotations

import sys
from collections.abc import Iterator
from typing import Any

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import cloudpickle
from pyspark.sql import DataFrame, SparkSession

cloudpickle.register_pickle_by_value(sys.modules[__name__])

_COLUMN = pa.struct([("name", pa.string()), ("low", pa.string()), ("high", pa.string()), ("nulls", pa.int64())])
SHAPE = "file string, bytes bigint, row_count bigint, row_groups int, columns array<struct<name:string,low:string,high:string,nulls:bigint>>"


def _shown(value: Any) -> str | None:
    return None if value is None else value.hex() if isinstance(value, bytes) else str(value)


def _columns(footer: pq.FileMetaData) -> list[dict[str, Any]]:
    """Least and greatest value and nulls of each column over all row groups; null where a row group does not say."""
    out = []
    for c in range(footer.num_columns):
        parts = [footer.row_group(g).column(c) for g in range(footer.num_row_groups)]
        known = [p.statistics for p in parts]
        ends = [s for s in known if s is not None and s.has_min_max]
        # A row group of nulls alone has no ends and does not widen the others'.
        whole = all(s is not None and (s.has_min_max or s.null_count == p.num_values) for s, p in zip(known, parts, strict=True))
        low, high = (min(s.min for s in ends), max(s.max for s in ends)) if ends and whole else (None, None)
        counted = all(s is not None and s.has_null_count for s in known)
        out.append({"name": footer.schema.column(c).path, "low": _shown(low), "high": _shown(high), "nulls": sum(s.null_count for s in known) if counted else None})
    return out


def footer_statistics(spark: SparkSession, path: str) -> DataFrame:
    """One row per Parquet file below ``path``: file, bytes, row_count, row_groups and its columns' name, low, high and nulls, as text.

    Files are listed by Spark and their footers opened by the tasks, so many files are read at
    once and nothing but one row per file leaves a task.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet").load(path)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for file, size in zip(*(batch.column(c).to_pylist() for c in ("path", "length")), strict=True):
                uri = f"file://{file[5:]}" if file.startswith("file:") and not file.startswith("file://") else file
                system, place = fs.FileSystem.from_uri(uri)
                with system.open_input_file(place) as source:
                    footer = pq.read_metadata(source)
                rows.append((file, size, footer.num_rows, footer.num_row_groups, _columns(footer)))
            if rows:
                kinds = (pa.string(), pa.int64(), pa.int64(), pa.int32(), pa.list_(_COLUMN))
                columns = [pa.array(values, kind) for values, kind in zip(zip(*rows, strict=True), kinds, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=["file", "bytes", "row_count", "row_groups", "columns"])

    return listed.select("path", "length").mapInArrow(read, SHAPE)
