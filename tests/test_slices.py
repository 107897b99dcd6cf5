import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vecloom.functions import chunks, embedding, sketching
from vecloom.functions.packing import quantized
from vecloom.functions.slices import in_slices, slices


@pytest.mark.parametrize(
    "rows",
    [
        pa.array(["a" * 30, None, "", "é" * 90, "x" * 10_000, "b", None], pa.string()),
        pa.array([["a" * 30, None], None, [], ["b"] * 500, ["c"]], pa.list_(pa.string())),
        pa.array([[1.0, 2.0], None, [0.5] * 300, []] * 9, pa.list_(pa.float32())),
        pa.array(list(range(99)), pa.int64()),
        pa.array([], pa.string()),
    ],
)
def test_slices_are_all_rows_in_order(rows):
    for part in (rows, rows.slice(2), rows.slice(1, 2)):
        found = list(slices(part, 200, 5))
        assert [x for s in found for x in s.to_pylist()] == part.to_pylist()
        assert all(1 <= len(s) <= 5 for s in found)
        for s in found:
            flat = s.to_pylist()
            size = sum(len(str(x).encode()) for row in flat if row is not None for x in ([row] if isinstance(row, str) else row if isinstance(row, list) else []))
            assert len(s) == 1 or size < 1500


@pytest.fixture
def texts(spark):
    """3,000 texts of about 4 kB in one task: 12 MB in one Arrow batch."""
    return spark.range(0, 3000, 1, 1).select("id", F.array_join(F.transform(F.sequence(F.lit(1), F.lit(600)), lambda i: F.concat(F.lit("word"), i % 97)), " ").alias("t"))


def bounded(function, limit):
    def checked(rows, *others):
        assert (rows.nbytes if isinstance(rows, pa.Array) else sum(map(len, rows))) <= limit, "a whole batch at once"
        return function(rows, *others)

    return checked


def test_chunks_are_cut_from_bounded_slices(texts, monkeypatch):
    monkeypatch.setattr(chunks, "windows_of", bounded(chunks.windows_of, 2 << 20))
    assert texts.select(F.explode(chunks.word_windows(F.col("t"), 64, 8))).count() == 3000 * 11


def test_embeddings_are_made_of_bounded_slices(texts, monkeypatch):
    monkeypatch.setattr(embedding, "_weights", bounded(embedding._weights, 2 << 20))
    assert texts.select(F.size(embedding.hashed_embedding(F.col("t"), 16)).alias("n")).agg(F.sum("n")).first()[0] == 3000 * 16


def test_sketches_are_made_of_bounded_slices(texts, monkeypatch):
    monkeypatch.setattr(sketching, "_digests", bounded(sketching._digests, 4 << 20))
    tokens = texts.select("id", F.split("t", " ").alias("w"))
    sketched = tokens.select(sketching.simhash_of(F.col("w")).alias("s"), sketching.minhash_of(F.col("w"), 8).alias("m")).distinct()
    assert sketched.count() == 1


def test_codes_of_many_rows_in_slices(spark):
    df = spark.range(0, 2500, 1, 1).select("id", F.when(F.col("id") % 7 != 0, F.array(*[(F.col("id") % 5 + k).cast("float") for k in range(4)])).alias("v"))
    found = df.select("id", quantized(F.col("v")).alias("q")).collect()
    assert sorted(r.id for r in found) == list(range(2500))
    assert {len(r.q.vector_int8) for r in found if r.id % 7} == {4} and {bytes(r.q.vector_int8) for r in found if not r.id % 7} == {b""}
    assert len({(r.id % 5, bytes(r.q.vector_int8)) for r in found if r.id % 7}) == 5


def test_rows_keep_their_results(spark):
    upper = in_slices(lambda rows: pa.array([None if x is None else x.upper() for x in rows.to_pylist()], pa.string()), T.StringType(), 50, 3)
    df = spark.createDataFrame([(i, None if i % 5 == 0 else f"t{i}" * (i % 9)) for i in range(200)], "id int, t string").repartition(3)
    assert all(r.u == (None if r.t is None else r.t.upper()) for r in df.select("t", upper(F.col("t")).alias("u")).collect())


@pytest.mark.parametrize("text", ["é😀 x " * 40, "a " * 50, "ß" * 30])
def test_places_count_characters(text):
    whole = pa.array([text, "", None, text[3:], "é"], pa.string())
    for given, rows in zip(whole.to_pylist(), chunks.windows_of(whole, 4, 1).to_pylist(), strict=True):
        assert all(given[r["start_char"] :].startswith(r["chunk_content"]) for r in rows)
        assert bool(rows) == bool((given or "").split())
