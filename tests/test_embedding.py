import hashlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.functions.embedding import hashed_embedding

TEXTS = [None, "", "   ", "one", "One one ONE", "İstanbul ΣΑΣ straße Straße", "a b\tc\n\nd e", " lead and trail ", "日本 😀 é", "x " * 3000]


def embed_by_definition(text, dim, normalize):
    if not text:
        return np.zeros(dim)
    v = np.zeros(dim)
    words = text.lower().split()
    for word in words:
        h = int(hashlib.md5(word.encode()).hexdigest()[:8], 16)
        v[h % dim] += 1.0 if h >> 3 & 1 else -1.0
    v[0] += 0.1 * len(words)
    v[1] += 0.01 * len(text)
    norm = np.linalg.norm(v)
    return v / norm if normalize and norm > 1e-12 else v


@pytest.mark.parametrize("dim", [384, 16])
@pytest.mark.parametrize("normalize", [True, False])
def test_embedding_matches_definition(spark, dim, normalize):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(TEXTS)], "i int, t string").repartition(3)
    rows = df.select("i", hashed_embedding(F.col("t"), dim, normalize).alias("v")).collect()
    assert len(rows) == len(TEXTS)
    for r in rows:
        assert len(r.v) == dim
        assert np.allclose(r.v, embed_by_definition(TEXTS[r.i], dim, normalize), rtol=1e-6, atol=1e-7)


def test_embedding_does_not_depend_on_batches(spark):
    df = spark.range(0, 500, 1, 4).select("id", F.concat_ws(" ", F.lit("w"), F.col("id"), F.col("id") % 7).alias("t"))
    whole = {r.id: r.v for r in df.select("id", hashed_embedding(F.col("t")).alias("v")).collect()}
    before = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        parts = {r.id: r.v for r in df.select("id", hashed_embedding(F.col("t")).alias("v")).collect()}
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", before)
    assert whole == parts


def test_no_rows(spark):
    df = spark.createDataFrame([], "t string")
    assert df.select(hashed_embedding(F.col("t"))).count() == 0


def test_embedding_needs_no_shuffle(spark, plan_of):
    plan = plan_of(spark.createDataFrame([("a",)], "t string").select(hashed_embedding(F.col("t"))))
    assert "Exchange" not in plan and plan.count("ArrowEvalPython") == 1
