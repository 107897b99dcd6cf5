import hashlib

from pyspark.sql import functions as F

from vecloom.functions.hashing import hamming, md5_hex, sha256_hex, shard_id, token_hash32, token_hash64
from vecloom.operators.dedup import exact_dedup


def test_hashes_match_hashlib(spark):
    texts = ["", "a", "Deterministic text", "é😀"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    t = F.col("t")
    rows = df.select("t", sha256_hex(t).alias("s"), md5_hex(t).alias("m"), token_hash32(t).alias("h"), token_hash64(t).alias("w"), shard_id(t, 7).alias("p")).collect()
    for r in rows:
        md5 = hashlib.md5(r.t.encode()).hexdigest()
        assert r.s == (hashlib.sha256(r.t.encode()).hexdigest() if r.t else "")
        assert r.m == md5
        assert r.h == int(md5[:8], 16)
        assert r.w % 2**64 == int(md5[:16], 16)
        assert r.p == int(md5[:8], 16) % 7


def test_null_keys(spark):
    df = spark.createDataFrame([(None,)], "t string")
    row = df.select(sha256_hex(F.col("t")).alias("s"), shard_id(F.col("t")).alias("p"), shard_id(F.col("t"), digits=4).alias("q")).first()
    empty = hashlib.md5(b"").hexdigest()
    assert (row.s, row.p, row.q) == ("", int(empty[:8], 16) % 16, int(empty[:4], 16) % 16)


def test_hamming(spark):
    df = spark.createDataFrame([(0, 0), (-1, 0), (5, 6)], "a bigint, b bigint")
    assert [r[0] for r in df.select(hamming(F.col("a"), F.col("b"))).collect()] == [0, 64, 2]


def test_exact_dedup_keeps_smallest_id_and_is_idempotent(spark):
    rows = [(f"d{i:04d}", "copy" if i % 3 == 0 else f"text {i}", {"k": str(i)}) for i in range(600)]
    df = spark.createDataFrame(rows, "document_id string, t string, metadata map<string,string>").repartition(16)
    df = df.withColumn("content_hash", sha256_hex(F.col("t")))
    once = exact_dedup(df)
    assert once.columns == df.columns
    kept = {r.document_id: r for r in once.collect()}
    assert set(kept) == {"d0000"} | {f"d{i:04d}" for i in range(600) if i % 3}
    assert kept["d0000"].metadata == {"k": "0"}
    assert {r.document_id for r in exact_dedup(once).collect()} == set(kept)


def test_exact_dedup_keeps_one_of_repeated_ids(spark):
    df = spark.createDataFrame([("d", "x")] * 5, "document_id string, content_hash string")
    assert exact_dedup(df).count() == 1


def test_exact_dedup_limits_groups_before_its_only_shuffle(spark, plan_of):
    df = spark.range(10).select(F.col("id").cast("string").alias("document_id"), F.col("id").cast("string").alias("content_hash"))
    plan = plan_of(exact_dedup(df))
    limit, shuffle = plan.rindex("WindowGroupLimit"), plan.index("Exchange hashpartitioning")
    assert plan.count("Exchange hashpartitioning") == 1 and shuffle < limit and "Partial" in plan[limit:]
    rows = [(None, "a"), ("2", "a"), ("1", "a"), (None, "b"), ("3", None), ("4", None)]
    kept = exact_dedup(spark.createDataFrame(rows, "document_id string, content_hash string")).collect()
    assert {(r.document_id, r.content_hash) for r in kept} == {("1", "a"), (None, "b"), ("3", None)}
