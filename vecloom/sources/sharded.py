"""Keyed collection in immutable files: a batch of writes rewrites only files that may hold its ids.

    folder/settings      id column, number of shards, schema
    folder/data/<write>  Parquet files, each of one shard (hash of the id); never changed
    folder/manifest/<n>  version n: one row per file with shard, rows, least and greatest id, Bloom bits

A version is what its manifest lists. A batch is held against the entries of its shards' files;
files that cannot hold any of its ids are listed again as they are. Readers of older versions
are not disturbed. A version counts once its manifest is complete, so an attempt that broke off
leaves files that nobody reads.
"""

from __future__ import annotations

import json
import sys
import uuid
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.operators.partitioning import rebalance
from vecloom.session import cut_lineage
from vecloom.sources.collection import latest_points

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BITS_PER_ID, HASHES = 10, 7
#: A file has at most so many rows, which bounds the task that makes its entry.
FILE_ROWS = 1 << 20
#: Ids of a batch that one task holds against the files of their shard.
IDS_AT_ONCE = 1 << 20
#: A shard with more files than this is written anew by the next batch that has ids of it.
MAX_FILES = 8


@dataclass(frozen=True)
class Upserted:
    version: int
    points: int
    rewritten: tuple[str, ...]


def _shard(id_: Column, shards: int) -> Column:
    return F.pmod(F.xxhash64(id_), F.lit(shards)).cast("int")


def _hashes(id_: Column) -> list[Column]:
    return [F.xxhash64(id_, F.lit(n)).alias(f"h{n}") for n in (1, 2)]


def _bits(h1: np.ndarray, h2: np.ndarray, size: int) -> np.ndarray:
    """The places of each id's bits among ``size``, one row per id."""
    step = np.arange(HASHES, dtype=np.uint64)
    return (h1.view(np.uint64)[:, None] + step * (h2.view(np.uint64)[:, None] | np.uint64(1))) % np.uint64(size)


def bloom_of(h1: np.ndarray, h2: np.ndarray) -> bytes:
    held = np.zeros(max(64, -(-len(h1) * BITS_PER_ID // 8) * 8), np.uint8)
    held[_bits(h1, h2, len(held)).ravel()] = 1
    return np.packbits(held).tobytes()


def bloom_holds(bloom: bytes, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
    """Which ids may be in; an id that was put in always is."""
    held = np.unpackbits(np.frombuffer(bloom, np.uint8))
    return held[_bits(h1, h2, len(held))].all(axis=1)


def _entries(spark: SparkSession, path: str, schema: T.StructType, id_column: str, shards: int) -> DataFrame:
    """Manifest rows of the files under ``path``; only their ids are read."""
    rows = spark.read.schema(schema).option("recursiveFileLookup", "true").parquet(path)
    ids = rows.select(F.col("_metadata.file_path").alias("file"), _shard(F.col(id_column), shards).alias("shard"), F.col(id_column).alias("id"), *_hashes(F.col(id_column)))
    kind = schema[id_column].dataType.simpleString()

    def entry(file: pa.Table) -> pa.Table:
        ends = pc.min_max(file["id"])
        bloom = bloom_of(*(file[h].to_numpy() for h in ("h1", "h2")))
        return pa.table({"file": file["file"].slice(0, 1), "shard": file["shard"].slice(0, 1), "rows": pa.array([file.num_rows], pa.int64()), "low": pa.array([ends["min"]]), "high": pa.array([ends["max"]]), "nulls": pa.array([file["id"].null_count > 0]), "bloom": pa.array([bloom], pa.binary())})

    return ids.groupBy("file").applyInArrow(entry, f"file string, shard int, rows bigint, low {kind}, high {kind}, nulls boolean, bloom binary")


class ShardedCollection:
    def __init__(self, spark: SparkSession, folder: str):
        row = spark.read.parquet(f"{folder}/settings").first()
        self.spark, self.folder = spark, folder
        self.id_column, self.shards = row["id_column"], row["shards"]
        self.schema = T.StructType.fromJson(json.loads(row["schema"]))

    @classmethod
    def create(cls, spark: SparkSession, folder: str, batch: DataFrame, id_column: str = "id", order_column: str = "write_order", shards: int = 16) -> ShardedCollection:
        """An empty collection for rows like ``batch`` without its order column, and the batch written to it."""
        schema = batch.drop(order_column).schema
        settings = [(id_column, shards, schema.json())]
        spark.createDataFrame(settings, "id_column string, shards int, schema string").coalesce(1).write.parquet(f"{folder}/settings")
        made = cls(spark, folder)
        made.write(batch, order_column)
        return made

    def versions(self) -> list[int]:
        """Complete versions, oldest first."""
        return [n for n, complete in self._found() if complete]

    def _found(self) -> list[tuple[int, bool]]:
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.folder}/manifest")
        system = root.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not system.exists(root):
            return []
        paths = [status.getPath() for status in system.listStatus(root)]
        done = self.spark._jvm.org.apache.hadoop.fs.Path
        return sorted((int(p.getName()), system.exists(done(p, "_SUCCESS"))) for p in paths)

    def manifest(self, version: int | None = None) -> DataFrame:
        """file, shard, rows, low, high, nulls, bloom of each file of a version, the newest by default."""
        kind = self.schema[self.id_column].dataType.simpleString()
        shape = f"file string, shard int, rows bigint, low {kind}, high {kind}, nulls boolean, bloom binary"
        known = self.versions()
        if not known:
            return self.spark.createDataFrame([], shape)
        return self.spark.read.schema(shape).parquet(f"{self.folder}/manifest/{known[-1] if version is None else version:08d}")

    def read(self, version: int | None = None) -> DataFrame:
        return self._rows([r["file"] for r in self.manifest(version).select("file").collect()])

    def _rows(self, files: list[str]) -> DataFrame:
        return self.spark.read.schema(self.schema).parquet(*files) if files else self.spark.createDataFrame([], self.schema)

    def touched(self, points: DataFrame) -> DataFrame:
        """The files that may hold an id of ``points``, a written table with one row per id.

        Ids meet the entries of their shard. A shard's ids are cut into parts of about
        IDS_AT_ONCE, each held against all of the shard's entries.
        """
        id_ = F.col(self.id_column)
        parts = max(1, -(-points.count() // (self.shards * IDS_AT_ONCE)))
        ids = points.select(_shard(id_, self.shards).alias("of_shard"), F.pmod(F.xxhash64(id_, F.lit("part")), F.lit(parts)).alias("of_part"), id_.alias("id"), *_hashes(id_))
        files = self.manifest().withColumn("part", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(parts - 1).cast("bigint"))))

        def hit(entries: pa.Table, wanted: pa.Table) -> pa.Table:
            names = []
            if wanted.num_rows:
                nulls, h1, h2 = wanted["id"].null_count > 0, wanted["h1"].to_numpy(), wanted["h2"].to_numpy()
                for row in entries.to_pylist():
                    inside = pc.and_(pc.greater_equal(wanted["id"], row["low"]), pc.less_equal(wanted["id"], row["high"])) if row["low"] is not None else None
                    some = np.zeros(0, np.int64) if inside is None else np.flatnonzero(pc.fill_null(inside, False).to_numpy())
                    if (nulls and row["nulls"]) or (len(some) and bloom_holds(row["bloom"], h1[some], h2[some]).any()):
                        names.append(row["file"])
            return pa.table({"file": pa.array(names, pa.string())})

        crowded = self.manifest().groupBy("shard").agg(F.count(F.lit(1)).alias("files")).filter(F.col("files") > MAX_FILES)
        crowded = crowded.join(ids.select(F.col("of_shard").alias("shard")).distinct(), "shard", "left_semi")
        found = files.groupBy("shard", "part").cogroup(ids.groupBy("of_shard", "of_part")).applyInArrow(hit, "file string")
        return cut_lineage(found.union(self.manifest().join(crowded, "shard", "left_semi").select("file")).distinct())

    def write(self, batch: DataFrame, order_column: str = "write_order") -> Upserted:
        """The next version: of each id the last write of the batch, all other rows as they were.

        The batch is computed once. Only touched files are read and written again; a null id is
        an id like others.
        """
        points = cut_lineage(latest_points(batch.select(*self.schema.names, order_column), self.id_column, order_column))
        touched = self.touched(points)
        files = tuple(sorted(r["file"] for r in touched.collect()))
        old, new = self._rows(list(files)), points.withColumnRenamed(self.id_column, "_id")
        kept = old.join(new.select("_id"), old[self.id_column].eqNullSafe(F.col("_id")), "left_anti")
        rows = kept.unionByName(points).select(*self.schema.names, _shard(F.col(self.id_column), self.shards).alias("_shard"))
        path = f"{self.folder}/data/{uuid.uuid4().hex}"
        laid = rebalance(rows, "_shard").sortWithinPartitions("_shard", self.id_column)
        laid.write.partitionBy("_shard").option("maxRecordsPerFile", FILE_ROWS).parquet(path)
        before = self.manifest().join(touched, "file", "left_anti")
        version = max((n for n, _ in self._found()), default=0) + 1
        entries = _entries(self.spark, path, self.schema, self.id_column, self.shards)
        before.unionByName(entries).write.mode("errorifexists").parquet(f"{self.folder}/manifest/{version:08d}")
        return Upserted(version, points.count(), files)
