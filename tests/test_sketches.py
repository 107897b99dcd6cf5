import hashlib
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from vecloom.functions import sketching
from vecloom.operators import sketches as S

PRIME = 4294967311


def simhash_by_python(tokens):
    votes = [0] * 64
    for token in tokens:
        h = int(hashlib.md5(token.encode()).hexdigest()[:16], 16)
        for i in range(64):
            votes[i] += 1 if h >> i & 1 else -1
    return sum(1 << i for i in range(64) if votes[i] > 0)


def minhash_by_python(tokens, num_perm=64, seed=42):
    rng = random.Random(seed)
    a = [rng.randint(1, PRIME - 1) for _ in range(num_perm)]
    b = [rng.randint(0, PRIME - 1) for _ in range(num_perm)]
    hashes = [int(hashlib.md5(t.encode()).hexdigest()[:8], 16) for t in set(tokens)]
    return [min(((x * h + y) % PRIME for h in hashes), default=0) for x, y in zip(a, b)]


NEAR = ["river", "stone", "window", "ladder", "copper", "seven"]
FIXTURES = [
    [],
    ["one"],
    ["same"] * 9,
    NEAR,
    [*NEAR, "harbour"],
    ["violet", "engine", "theory", "marble", "winter"],
    ["oak", "elm", "ash", "yew", "fir"],
    ["oak", "elm", "ash", "yew", "larch"],
    ["é", "ß", "😀", "日本"],
]


@pytest.fixture(scope="module")
def tokens(spark):
    return spark.createDataFrame([(f"{i:03d}", t) for i, t in enumerate(FIXTURES)], "document_id string, tokens array<string>")


def test_simhash_matches_definition(tokens):
    found = {r.document_id: r.simhash % 2**64 for r in S.simhash(tokens, F.col("tokens")).collect()}
    assert found == {f"{i:03d}": simhash_by_python(t) for i, t in enumerate(FIXTURES)}


def test_simhash_is_near_for_near_texts(tokens):
    h = {int(r.document_id): r.simhash % 2**64 for r in S.simhash(tokens, F.col("tokens")).collect()}
    near, far = (h[3] ^ h[4]).bit_count(), (h[3] ^ h[5]).bit_count()
    assert near <= 12
    assert near < far


def test_rows_of_equal_id_stay_apart(spark, plan_of):
    rows = spark.createDataFrame([("a", ["x", "y"]), ("a", ["z"]), (None, [])], "document_id string, tokens array<string>")
    for found in (S.simhash(rows, F.col("tokens")), S.minhash(rows, F.col("tokens"))):
        assert found.count() == 3 and "Exchange" not in plan_of(found)
    assert sorted(r.simhash % 2**64 for r in S.simhash(rows, F.col("tokens")).collect()) == sorted(map(simhash_by_python, (["x", "y"], ["z"], [])))


def test_fewer_bits(tokens):
    found = {r.document_id: r.simhash for r in S.simhash(tokens, F.col("tokens"), bit_length=16).collect()}
    assert found == {f"{i:03d}": simhash_by_python(t) % 2**16 for i, t in enumerate(FIXTURES)}


def test_long_rows_are_cut(spark, monkeypatch):
    monkeypatch.setattr(sketching, "AT_ONCE", 7)
    texts = [[f"t{i % 13}" for i in range(n)] for n in (0, 3, 50, 1, 7, 0, 30)]
    df = spark.createDataFrame([(str(i), t) for i, t in enumerate(texts)], "document_id string, tokens array<string>").coalesce(1)
    assert [r.simhash % 2**64 for r in S.simhash(df, F.col("tokens")).orderBy("document_id").collect()] == list(map(simhash_by_python, texts))
    assert [r.signature for r in S.minhash(df, F.col("tokens")).orderBy("document_id").collect()] == list(map(minhash_by_python, texts))


@pytest.mark.parametrize("num_perm,seed", [(64, 42), (16, 7), (100, 1), (5, 3)])
def test_minhash_matches_definition(tokens, num_perm, seed):
    found = S.minhash(tokens, F.col("tokens"), num_perm=num_perm, seed=seed).collect()
    assert {r.document_id: r.signature for r in found} == {
        f"{i:03d}": minhash_by_python(t, num_perm, seed) for i, t in enumerate(FIXTURES)
    }


def test_permutation_stays_exact_at_the_extremes():
    cases = [(a, b) for a in (1, 2**16, 2**32 - 1, PRIME - 1) for b in (0, PRIME - 1)]
    values = [0, 1, 2**16 - 1, 2**16, 2**31, 2**32 - 1]
    a, b = (np.array(x, np.uint64) for x in zip(*cases))
    found = sketching.permuted(np.array(values, np.uint64), a, b)
    assert found.tolist() == [[(x * h + y) % PRIME for x, y in cases] for h in values]


def test_jaccard_estimate(spark):
    df = spark.createDataFrame([([1, 2, 3, 4], [1, 2, 0, 4]), ([], []), ([1], [1, 2])], "a array<bigint>, b array<bigint>")
    assert [r[0] for r in df.select(S.jaccard_estimate(F.col("a"), F.col("b"))).collect()] == [0.75, 0.0, 0.0]


@pytest.fixture(scope="module")
def fingerprints():
    """Clusters around a few centres, a hot half-space sharing 40 bits, copies, and noise."""
    rng = random.Random(3)
    values = []
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(15):
            flipped = centre
            for bit in rng.sample(range(64), rng.randint(0, 5)):
                flipped ^= 1 << bit
            values.append(flipped)
    values += [(0xABCDEF0123 << 24) | rng.getrandbits(24) for _ in range(120)]
    values += [0x1234567890ABCDEF] * 150
    values += [0, 2**64 - 1, 1, 3, 7, 15]
    rng.shuffle(values)
    return [(f"{i:04d}", v - 2**64 if v >> 63 else v) for i, v in enumerate(values)]


def classes_of(rows):
    classes = {}
    for i, sketch in rows:
        classes.setdefault(sketch, []).append(i)
    return {min(ids): (sketch, len(ids)) for sketch, ids in classes.items()}


def distance(a, b):
    return ((a ^ b) % 2**64).bit_count()


@pytest.mark.parametrize("allowed", [0, 3, 5])
@pytest.mark.parametrize("hot", [2, 256])
def test_simhash_pairs_find_every_pair(spark, fingerprints, allowed, hot):
    df = spark.createDataFrame(fingerprints, "document_id string, simhash bigint")
    classes = classes_of(fingerprints)
    expected = {
        (a, b, classes[a][1], classes[b][1], distance(classes[a][0], classes[b][0]))
        for a in classes
        for b in classes
        if a < b and distance(classes[a][0], classes[b][0]) <= allowed
    }
    assert {tuple(r) for r in S.simhash_pairs(df, allowed, hot=hot).collect()} == expected


def test_representatives(spark, fingerprints):
    df = spark.createDataFrame(fingerprints, "document_id string, simhash bigint")
    sketch = dict(fingerprints)
    smallest = {classes_of(fingerprints)[i][0]: i for i in classes_of(fingerprints)}
    found = {r.document_id: r.representative for r in S.representatives(df, "simhash").collect()}
    assert found == {i: smallest[sketch[i]] for i in sketch}


@pytest.mark.parametrize("hot", [2, 256])
def test_near_dedup_simhash_matches_brute_force(spark, fingerprints, hot):
    df = spark.createDataFrame(fingerprints, "document_id string, simhash bigint")
    kept = {r.document_id for r in S.near_dedup(df, df, "simhash", max_distance=3, hot=hot).collect()}
    assert kept == {i for i, v in fingerprints if not any(j < i and distance(v, w) <= 3 for j, w in fingerprints)}


@pytest.fixture(scope="module")
def signatures():
    """Signatures in clusters of different closeness, and many that share their first positions."""
    rng = random.Random(5)
    rows = []
    for _ in range(10):
        centre = [rng.randrange(PRIME) for _ in range(64)]
        for _ in range(10):
            changed = list(centre)
            for p in rng.sample(range(64), rng.randint(0, 40)):
                changed[p] = rng.randrange(PRIME)
            rows.append(changed)
    stem = [rng.randrange(PRIME) for _ in range(30)]
    rows += [stem + [rng.randrange(4) for _ in range(34)] for _ in range(80)]
    rows += [[0] * 64] * 60
    rng.shuffle(rows)
    return [(f"{i:04d}", tuple(r)) for i, r in enumerate(rows)]


def share(a, b):
    return sum(x == y for x, y in zip(a, b)) / 64


@pytest.mark.parametrize("threshold", [0.5, 0.8, 1.0])
@pytest.mark.parametrize("hot", [2, 256])
def test_minhash_pairs_find_every_pair(spark, signatures, threshold, hot):
    df = spark.createDataFrame([(i, list(s)) for i, s in signatures], "document_id string, signature array<bigint>")
    classes = classes_of(signatures)
    expected = {
        (a, b, classes[a][1], classes[b][1], share(classes[a][0], classes[b][0]))
        for a in classes
        for b in classes
        if a < b and share(classes[a][0], classes[b][0]) >= threshold
    }
    assert {tuple(r) for r in S.minhash_pairs(df, threshold, hot=hot).collect()} == expected


@pytest.mark.parametrize("hot", [2, 256])
def test_near_dedup_minhash_matches_brute_force(spark, signatures, hot):
    df = spark.createDataFrame([(i, list(s)) for i, s in signatures], "document_id string, signature array<bigint>")
    kept = {r.document_id for r in S.near_dedup(df, df, "minhash", threshold=0.6, hot=hot).collect()}
    assert kept == {i for i, v in signatures if not any(j < i and share(v, w) >= 0.6 for j, w in signatures)}


def test_positions_cut_into_blocks_once_each():
    for positions in (S.Positions(64, 1, 3), S.Positions(64, 8, 12), S.Positions(64, 8, 32), S.Positions(16, 8, 3)):
        for level in range(4):
            blocks = positions.blocks(level)
            assert len(blocks) == positions.allowed + 1
            assert sorted(p for block in blocks for p in block) == list(range(positions.count))


def test_threshold_rounding():
    assert S._needed(64, 0.8) == 52 and S._needed(64, 0.75) == 48 and S._needed(10, 0.7) == 7


def test_units_of_a_dense_bucket_are_bounded_and_meet_every_pair(spark):
    rows = spark.range(3000).select(F.lit(1).cast("bigint").alias("bucket"), F.format_string("%05d", "id").alias("id"), F.col("id").alias("word0"))
    met = S.units(rows, 100)
    assert met.groupBy("unit").count().agg(F.max("count")).first()[0] <= 300
    pairs = met.alias("a").join(met.alias("b"), S._together("a", "b") & (F.col("a.id") < F.col("b.id")))
    assert pairs.count() == 3000 * 2999 // 2


@pytest.mark.parametrize("num_perm", [5, 100])
def test_minhash_pairs_of_any_width(spark, num_perm):
    rng = random.Random(8)
    base = [rng.randrange(PRIME) for _ in range(num_perm)]
    sketches = {tuple(rng.randrange(PRIME) if rng.random() < 0.15 else v for v in base) for _ in range(40)}
    rows = [(f"{i:03d}", list(s)) for i, s in enumerate(sorted(sketches))]
    df = spark.createDataFrame(rows, "document_id string, signature array<bigint>")
    found = {(r.id_a, r.id_b) for r in S.minhash_pairs(df, 0.8, num_perm=num_perm, hot=8).collect()}
    equal = lambda x, y: sum(a == b for a, b in zip(x, y)) >= S._needed(num_perm, 0.8)
    assert found == {(i, j) for i, x in rows for j, y in rows if i < j and equal(x, y)}


def minhash_pairs_by_python(rows):
    """Of classes, which repeated ids share; a pair has two different ids."""
    classes = {}
    for i, sketch in rows:
        classes.setdefault(sketch, []).append(i)
    named = [(min((i for i in ids if i is not None), default=None), sketch, len(ids)) for sketch, ids in classes.items()]
    named = [x for x in named if x[0] is not None]
    return sorted((a, b, m, n, share(x, y)) for a, x, m in named for b, y, n in named if a < b and share(x, y) >= 0.8)


@pytest.mark.parametrize("hot", [3, 40, 256])
def test_minhash_pairs_of_repeated_and_missing_ids(spark, monkeypatch, hot):
    monkeypatch.setattr(S, "DENSE_ROWS", 16)  # several blocks and tiles
    monkeypatch.setattr(S, "TILE_ROWS", 5)
    rng = random.Random(11)
    centre = [rng.randrange(PRIME) for _ in range(64)]
    near = [tuple(rng.randrange(PRIME) if rng.random() < 0.1 else v for v in centre) for _ in range(70)]
    far = [tuple(centre[:20] + [rng.randrange(PRIME) for _ in range(44)]) for _ in range(50)]
    rows = [(rng.choice([None, "é", "z", *(f"{i:02d}" for i in range(60))]), s) for s in near + far + near[:10]]
    df = spark.createDataFrame([(i, list(s)) for i, s in rows], "document_id string, signature array<bigint>")
    expected = minhash_pairs_by_python(rows)
    assert len(expected) > 300
    assert sorted(tuple(r) for r in S.minhash_pairs(df, 0.8, hot=hot).collect()) == expected


def test_a_dense_bucket_is_cut_again_only_if_that_thins_it_out(spark):
    rng = random.Random(12)
    positions = S._minhash_positions(64, 0.8)
    stem = [rng.randrange(PRIME) for _ in range(64)]

    def cut(rows):
        df = spark.createDataFrame([(i, list(r)) for i, r in enumerate(rows)], "id bigint, signature array<bigint>")
        few, dense = S.cut_buckets(S._minhash_words(df, positions), positions, 20)
        assert S.bucketed(S._minhash_words(df, positions), positions, 20).count() == few.count() + (dense.count() if dense else 0)
        return few, dense

    few, dense = cut([stem[:63] + [i] for i in range(100)])  # all near each other: 13 buckets to a row, not 13 * 13 * 13
    assert dense.count() == 12 * 100 and few.count() <= 100
    few, dense = cut([stem[:4] + [rng.randrange(PRIME) for _ in range(60)] for _ in range(100)])  # they share the first block only
    assert dense.count() == 0 and few.groupBy("bucket").count().agg(F.max("count")).first()[0] <= 20


def test_pair_search_joins_on_buckets_and_shuffles_them_once(spark, fingerprints, plan_of):
    df = spark.createDataFrame(fingerprints, "document_id string, simhash bigint")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        pairs = S.simhash_pairs(df, 3)
        pairs.collect()
        plan = plan_of(pairs).split("Initial Plan")[0]
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "NestedLoop" not in plan and "CartesianProduct" not in plan
    assert "ReusedExchange [bucket" in plan


def test_a_group_of_copies_stays_one_class(spark):
    rows = spark.range(0, 200000, 1, 8).select(F.lpad(F.col("id").cast("string"), 6, "0").alias("document_id"), F.lit(5).cast("bigint").alias("simhash"))
    assert S.simhash_pairs(rows).count() == 0
    assert [r.document_id for r in S.near_dedup(rows, rows).collect()] == ["000000"]


def test_unknown_method(spark, tokens):
    with pytest.raises(ValueError):
        S.near_dedup(tokens, tokens, "other")
