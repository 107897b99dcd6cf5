import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.operators import clustered, search
from vecloom.operators.partitioning import partition_by_hash, partition_by_range, partition_by_sketch, rebalance, shard_distribution
from vecloom.operators.projection import project_pca
from vecloom.operators.search import cosine_matrix, knn_topk, semantic_search
from vecloom.functions.embedding import hashed_embedding
from vecloom.functions.quantiles import KeySketch
from vecloom.sources.parquet_sink import write_dataset


@pytest.fixture(scope="module")
def matrix():
    rng = np.random.RandomState(1)
    points = rng.normal(0, 1, (90, 8)).astype(np.float32)
    copies = np.repeat(points[:1], 45, axis=0)  # a third of the rows are copies
    return np.vstack([points, copies, np.zeros((1, 8), np.float32)])


@pytest.fixture(scope="module")
def frame(spark, matrix):
    rows = [(f"v{i:03d}", [float(x) for x in row]) for i, row in enumerate(matrix)]
    return spark.createDataFrame([*rows, ("empty", []), ("null", None)], "id string, vector array<float>").repartition(5).persist()


def unit(matrix):
    matrix = matrix.astype(float)
    return matrix / np.maximum(np.linalg.norm(matrix, axis=1, keepdims=True), 1e-12)


@pytest.mark.parametrize("tile_rows", [1000, 40])
def test_cosine_matrix(frame, matrix, tile_rows):
    expected = unit(matrix) @ unit(matrix).T
    rows = cosine_matrix(frame, tile_rows=tile_rows).collect()
    assert len(rows) == len(matrix) ** 2
    for r in rows:
        assert r.cosine == pytest.approx(expected[int(r.row_id[1:]), int(r.col_id[1:])], abs=1e-12)


def test_cosine_of_two_sets(frame, matrix):
    few = frame.filter(F.col("id") < "v010")
    rows = cosine_matrix(few, frame.filter(F.col("id").startswith("v")), tile_rows=7).collect()
    assert len(rows) == 10 * len(matrix)
    assert all(abs(r.cosine) <= 1 + 1e-9 for r in rows)


def test_cosine_rows_by_cosine_take_fewer_bytes(spark, tmp_path, monkeypatch):
    rng = np.random.RandomState(4)
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(rng.normal(0, 1, (1000, 8)))]
    vectors = spark.createDataFrame(rows, "id bigint, vector array<float>")
    size = {}
    for by_cosine in (False, True):
        out = tmp_path / str(by_cosine)
        cosine_matrix(vectors, by_cosine=by_cosine).withColumn("cosine", F.round("cosine", 5)).write.parquet(str(out))
        size[by_cosine] = sum(p.stat().st_size for p in out.glob("*.parquet"))
    assert size[True] < 0.7 * size[False]
    plain, sorted_ = (spark.read.parquet(str(tmp_path / x)) for x in ("False", "True"))
    assert sorted_.count() == 1000**2 and plain.exceptAll(sorted_).isEmpty()
    few = vectors.filter("id < 9")
    monkeypatch.setattr(search, "SORTED_TILE", (2, 3))
    monkeypatch.setattr(search, "MATRIX_BATCH", 4)
    found = {(r.row_id, r.col_id): r.cosine for r in cosine_matrix(few, by_cosine=True).collect()}
    assert len(found) == 81 and found == pytest.approx({(r.row_id, r.col_id): r.cosine for r in cosine_matrix(few).collect()}, abs=1e-12)


def test_cosine_copies_rows_per_strip_not_per_tile(spark, frame, matrix, monkeypatch):
    copied, whole = spark.sparkContext.accumulator(0), search.unit_rows

    def counted(vectors):
        copied.add(len(vectors))
        return whole(vectors)

    monkeypatch.setattr(search, "unit_rows", counted)
    monkeypatch.setattr(search, "TASKS_PER_CORE", 1)
    assert cosine_matrix(frame, tile_rows=4).select("row_id", "col_id").distinct().count() == len(matrix) ** 2
    assert 0 < copied.value <= 2 * 3 * len(matrix)


def test_strips_are_few_and_bounded():
    assert search._strips(100_000, 100_000, 64, 1024, 96) == (10, 10)
    assert search._strips(6_000_000, 6_000_000, 64, 1024, 96) == (92, 92)
    assert search._strips(100_000, 10, 64, 1024, 96) == (96, 1)
    assert search._strips(10, 100_000, 64, 1024, 96) == (1, 96)
    assert search._strips(0, 0, 1, 1024, 96) == (1, 1)


def test_cosine_uses_no_cross_join(frame, plan_of):
    plan = plan_of(cosine_matrix(frame, tile_rows=40))
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


@pytest.mark.parametrize("limit", [2048, 3])  # one block of queries, several
@pytest.mark.parametrize("k", [1, 5, 60])
def test_knn(frame, matrix, limit, k):
    queries = frame.filter(F.col("id") < "v020").select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
    rows = knn_topk(frame, queries, k, cell_rows=2 * limit, block_rows=limit).collect()
    scores = np.round(unit(matrix)[:20] @ unit(matrix).T, 9)
    expected = {}
    for q in range(20):
        order = sorted(range(len(matrix)), key=lambda i: (-scores[q, i], i))[:k]
        expected.update({(f"v{q:03d}", rank): (f"v{i:03d}", scores[q, i]) for rank, i in enumerate(order, 1)})
    found = {(r.query_id, r["rank"]): (r.id, r.score) for r in rows}
    assert {key: value[0] for key, value in found.items()} == {key: value[0] for key, value in expected.items()}
    assert all(found[key][1] == pytest.approx(expected[key][1], abs=1e-8) for key in expected)


def test_knn_with_numbers_as_ids(spark, matrix):
    df = spark.createDataFrame([(i, [float(x) for x in row]) for i, row in enumerate(matrix)], "id bigint, vector array<float>")
    queries = df.filter("id = 3").select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
    assert knn_topk(df, queries, 1).first().id == 3


def test_knn_carries_payload(frame):
    rows = frame.withColumn("name", F.concat(F.lit("n-"), "id"))
    queries = rows.limit(9).select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
    found = knn_topk(rows, queries, 2, payload=("name",), block_rows=4).collect()
    assert len(found) == 18 and all(r.name == f"n-{r.id}" for r in found)


def test_knn_of_nothing(frame):
    queries = frame.select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
    assert knn_topk(frame.filter("false"), queries).count() == 0
    assert knn_topk(frame, queries.filter("false")).count() == 0


@pytest.fixture(scope="module")
def tight(spark):
    """Twelve tight groups of vectors, and a few that point anywhere."""
    rng = np.random.RandomState(5)
    groups = rng.normal(0, 1, (12, 16))
    points = np.vstack([np.repeat(groups, 60, axis=0) + rng.normal(0, 0.02, (720, 16)), rng.normal(0, 1, (20, 16)), np.zeros((3, 16))]).astype(np.float32)
    return points, spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id int, vector array<float>").repartition(3).persist()


def test_clusters_below_the_kth_score_are_skipped(tight):
    points, df = tight
    index = clustered.cluster(df)
    assert index.sizes.sum() == len(points) and index.sizes[-1] == 3 and len(index.centres) == 29
    queries = df.filter("id % 5 = 0").select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
    asked = {r.query_id: r.clusters for r in clustered.clusters_asked(index, queries, 4).collect()}
    grouped = [len(c) for q, c in asked.items() if q < 720]
    assert np.mean(grouped) < (index.sizes > 0).sum() / 3
    cluster_of = {r.id: r.cluster for r in index.rows.collect()}
    scores = np.round(unit(points) @ unit(points).T, 9)
    for q, clusters in asked.items():
        nearest = sorted(range(len(points)), key=lambda i: (-scores[q, i], i))[:4]
        assert {cluster_of[i] for i in nearest} <= set(clusters)
    found = knn_topk(df, queries, 4, index=index, cell_rows=25, block_rows=10).collect()
    want = {(q, r): i for q in asked for r, i in enumerate(sorted(range(len(points)), key=lambda i: (-scores[q, i], i))[:4], 1)}
    assert {(r.query_id, r["rank"]): r.id for r in found} == want


def test_members_lie_within_the_radius(tight):
    points, df = tight
    index = clustered.cluster(df)
    for r in index.rows.collect():
        if r.cluster < len(index.centres) - 1:
            u = unit(points[r.id : r.id + 1])[0]
            assert np.arccos(min(1.0, u @ index.centres[r.cluster])) <= index.radii[r.cluster] + 1e-9
            assert u @ index.centres[r.cluster] >= (index.centres @ u).max() - 1e-12
        else:
            assert not points[r.id].any()


def test_search_does_not_gather_queries_or_vectors(tight, monkeypatch):
    _, df = tight
    queries = df.select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
    gathered, real = [], type(df).toArrow
    monkeypatch.setattr(type(df), "toArrow", lambda self: gathered.append(real(self)) or gathered[-1])
    knn_topk(df, queries, 3, index=clustered.cluster(df, max_centres=32)).count()
    assert max(t.num_rows for t in gathered) <= 33


def test_vectors_are_copied_per_strip_not_per_block(spark, tight, monkeypatch):
    _, df = tight
    queries = df.select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
    copied, asked, whole = spark.sparkContext.accumulator(0), spark.sparkContext.accumulator(0), clustered._best

    def counted(vectors, wanting, *others):
        copied.add(vectors.num_rows)
        asked.add(wanting.num_rows)
        return whole(vectors, wanting, *others)

    monkeypatch.setattr(clustered, "_best", counted)
    monkeypatch.setattr(clustered, "TASKS_PER_CORE", 1)
    assert knn_topk(df, queries, 2, cell_rows=5, block_rows=5).count() == 2 * df.count()
    assert df.count() <= min(copied.value, asked.value) and max(copied.value, asked.value) <= 3 * df.count()


@pytest.mark.parametrize("cell_rows,block_rows", [(7, 5), (1000, 1000)])
def test_scores_that_32_bits_cannot_tell_apart(cell_rows, block_rows):
    rng = np.random.RandomState(3)
    wanted, near = unit(rng.normal(0, 1, (12, 16))), rng.normal(0, 1, (40, 16))
    units = unit(np.vstack([near + rng.normal(0, 1e-8, near.shape) for _ in range(20)]))
    names = rng.permutation(len(units))
    least = np.full(len(wanted), -2.0)
    every = lambda queries, rows: np.ones(queries.stop - queries.start, bool)
    q, name, score = clustered.nearest_rows(wanted, least, units, names, every, 6, cell_rows, block_rows)
    exact = np.round(wanted @ units.T, 9)
    for i in range(len(wanted)):
        order = sorted(range(len(units)), key=lambda r: (-exact[i, r], names[r]))[:6]
        assert name[q == i].tolist() == [names[r] for r in order] and np.allclose(score[q == i], exact[i, order], atol=1e-12)


def test_copies_and_zero_vectors_cost_one_score(spark, monkeypatch):
    rng = np.random.RandomState(4)
    points = np.vstack([np.repeat(rng.normal(0, 1, (1, 8)), 300, axis=0), np.zeros((300, 8)), rng.normal(0, 1, (60, 8))]).astype(np.float32)
    df = spark.createDataFrame([(i, [float(x) for x in p]) for i, p in enumerate(points)], "id int, vector array<float>").repartition(4)
    scored, whole = spark.sparkContext.accumulator(0), clustered.nearest_rows

    def counted(wanted, least, units, *others):
        scored.add(len(wanted) * len(units))
        return whole(wanted, least, units, *others)

    monkeypatch.setattr(clustered, "nearest_rows", counted)
    queries = df.select(F.col("id").alias("query_id"), F.col("vector").alias("query_vector"))
    found = {(r.query_id, r["rank"]): r.id for r in knn_topk(df, queries, 3).collect()}
    scores = np.round(unit(points) @ unit(points).T, 9)
    assert found == {(q, n): i for q in range(len(points)) for n, i in enumerate(sorted(range(len(points)), key=lambda i: (-scores[q, i], i))[:3], 1)}
    assert 0 < scored.value <= 4 * 62 * 62


def test_semantic_search(spark):
    texts = ["raft consensus leader election", "gene sequencing of tumor cells", "quarterly revenue growth"]
    chunks = spark.createDataFrame([(f"c{i}", t * 30, "cat", i) for i, t in enumerate(texts)], "chunk_id string, chunk_content string, category string, partition_id int")
    chunks = chunks.withColumn("vector_fp32", hashed_embedding(F.col("chunk_content")))
    queries = spark.createDataFrame([(1, "leader election raft consensus")], "query_id int, q string")
    best = semantic_search(chunks, queries, F.col("q"), 2).orderBy("rank").collect()
    assert best[0].chunk_id == "c0" and len(best) == 2 and len(best[0].snippet) == 200 and best[0].category == "cat"


def test_pca_matches_numpy(spark):
    matrix = np.random.RandomState(42).normal(0, 1, (40, 12)) * np.arange(1, 13)
    df = spark.createDataFrame([(i, [float(x) for x in r]) for i, r in enumerate(matrix)], "id int, vector array<double>")
    projected, ratios = project_pca(df, 3)
    found = np.array([r.projection for r in projected.orderBy("id").collect()])
    centred = matrix - matrix.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    components = vt[:3].T
    components = components * np.sign(components[np.abs(components).argmax(axis=0), range(3)])
    assert found.shape == (40, 3) and np.allclose(found, centred @ components, atol=1e-8)
    assert np.allclose(ratios, s[:3] ** 2 / (s**2).sum()) and sum(ratios) <= 1.0001


def test_pca_leaves_out_unusable_vectors(spark):
    rows = [(i, [float(i), float(i * i), 1.0]) for i in range(6)]
    schema = "id int, vector array<float>"
    projected, _ = project_pca(spark.createDataFrame(rows + [(6, None), (7, []), (8, [1.0])], schema), 2)
    alone, _ = project_pca(spark.createDataFrame(rows, schema), 2)
    assert sorted(map(tuple, projected.collect())) == sorted(map(tuple, alone.collect()))


def test_search_takes_the_stored_dimension(spark):
    chunks = spark.createDataFrame([("c0", "one two", "cat", 0)], "chunk_id string, chunk_content string, category string, partition_id int")
    chunks = chunks.withColumn("vector_fp32", hashed_embedding(F.col("chunk_content"), 64))
    queries = spark.createDataFrame([(1, "one two")], "query_id int, q string")
    assert semantic_search(chunks, queries, F.col("q"), 1).first().score == pytest.approx(1.0, abs=1e-6)


def test_pca_with_too_few_rows(spark):
    df = spark.createDataFrame([(0, [1.0, 2.0]), (1, [3.0, 4.0])], "id int, vector array<float>")
    projected, ratios = project_pca(df, 3)
    assert [r.projection for r in projected.orderBy("id").collect()] == [[1.0, 2.0, 0.0], [3.0, 4.0, 0.0]]
    assert ratios == [1 / 3] * 3


def keyed(spark):
    return spark.range(400).select("id", (F.col("id") % 10).cast("int").alias("partition_id"))


def placed(df):
    rows = df.select("partition_id", F.spark_partition_id().alias("place")).distinct().collect()
    return {(r.partition_id, r.place) for r in rows}


def test_hash_partitions_hold_whole_keys(spark):
    df = partition_by_hash(keyed(spark), "partition_id", 4)
    assert df.rdd.getNumPartitions() == 4 and len(placed(df)) == 10 and df.count() == 400


def test_range_partitions_do_not_overlap(spark):
    df = partition_by_range(keyed(spark), "partition_id", 4)
    bounds = {}
    for key, place in placed(df):
        low, high = bounds.get(place, (key, key))
        bounds[place] = (min(low, key), max(high, key))
    spans = sorted(bounds.values())
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:])) and len(spans) > 1


def test_sketched_ranges_are_even_intervals(spark, plan_of):
    rows = spark.range(0, 60_000, 1, 12).select((F.xxhash64("id") % 5).cast("int").alias("s"), F.md5(F.col("id").cast("string")).alias("k"))
    rows = rows.union(spark.createDataFrame([(None, "x"), (1, None)], "s int, k string"))
    df = partition_by_sketch(rows, ("s", "k"), 4000)
    assert "RangePartitioning" not in plan_of(df) and "rangepartitioning" not in plan_of(df)
    ordered = lambda r: ((r.s is not None, r.s or 0), (r.k is not None, r.k or ""))
    parts = df.select("s", "k", F.spark_partition_id().alias("place")).collect()
    by_place = {}
    for r in parts:
        by_place.setdefault(r.place, []).append(ordered(r))
    assert len(parts) == 60_002 and len(by_place) == 16
    assert all(part == sorted(part) for part in by_place.values())
    ends = [(part[0], part[-1]) for _, part in sorted(by_place.items())]
    assert all(a[1] < b[0] for a, b in zip(ends, ends[1:]))
    assert all(abs(len(part) - 3750) < 750 for part in by_place.values())


def test_sketched_ranges_of_few_and_equal_keys(spark):
    one = spark.range(50).select(F.lit("k").alias("k"), "id")
    assert partition_by_sketch(one, ("k",), 10).count() == 50
    assert partition_by_sketch(one.filter("false"), ("k",), 10).count() == 0
    two = one.withColumn("k", (F.col("id") >= 25).cast("string"))
    places = partition_by_sketch(two, ("k",), 25).select("k", F.spark_partition_id().alias("p")).distinct().collect()
    assert len(places) == 2 and len({r.p for r in places}) == 2


def test_sketches_merge(spark):
    whole = KeySketch([], 0)
    for k in range(0, 100_000, 5000):
        whole = whole.merged(KeySketch([[(7919 * i % 100_003,) for i in range(k, k + 5000)]], 5000).compacted())
    assert whole.n == 100_000 and sum(map(len, whole.levels)) < 6 * 4096
    for got, want in zip(whole.bounds(50), range(2000, 100_000, 2000), strict=True):
        assert abs(got[0] - want) < 400


def test_rebalance_splits_a_hot_key(spark, tmp_path):
    rows = spark.range(0, 200000, 1, 8).withColumn("partition_id", F.when(F.col("id") >= 0, 1))
    rows = rows.withColumn("x", F.sha2(F.col("id").cast("string"), 256))
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        write_dataset(rebalance(rows, "partition_id"), str(tmp_path / "out"))
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(list((tmp_path / "out" / "partition_id=1").glob("*.parquet"))) > 4


def test_shard_distribution(spark):
    assert {r.partition_id: r.vector_count for r in shard_distribution(keyed(spark)).collect()} == {i: 40 for i in range(10)}
