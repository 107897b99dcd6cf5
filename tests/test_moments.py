import numpy as np
import pyarrow as pa
import pytest

from vecloom.functions.moments import PairMoments, VectorMoments, folded
from vecloom.operators.projection import project_pca
from vecloom.operators.quality import quantization_error


def test_merged_moments_equal_whole_ones_far_from_zero():
    draw = np.random.RandomState(0)
    x = draw.normal(1e6, 1e-2, (700, 5))
    parts = [VectorMoments.of(pa.array(p.tolist(), pa.list_(pa.float64()))) for p in np.array_split(x, [3, 4, 300, 690])]
    total = parts[0]
    for part in parts[1:]:
        total = total.merged(part)
    centred = x - x.mean(axis=0)
    assert total.n == 700 and np.allclose(total.mean, x.mean(axis=0), rtol=1e-14)
    assert np.allclose(total.scatter, centred.T @ centred, rtol=1e-6, atol=1e-6)
    y = x + 1e-3
    halves = [PairMoments.of(a.ravel(), b.ravel()) for a, b in ((x[:9], y[:9]), (x[9:], y[9:]))]
    both = halves[0].merged(halves[1])
    assert both.spread / both.n == pytest.approx(x.var(), rel=1e-6) and both.squared_error / both.n == pytest.approx(1e-6, rel=1e-6)


def test_the_longest_vectors_count():
    vectors = pa.array([[1.0], None, [], [1.0, 2.0], [3.0, 6.0]], pa.list_(pa.float32()))
    m = VectorMoments.of(vectors)
    assert m.n == 2 and m.mean.tolist() == [2.0, 4.0]
    assert VectorMoments.of(vectors.slice(0, 1)).merged(m).n == 2 and m.merged(VectorMoments.of(vectors.slice(0, 1))).n == 2
    assert VectorMoments.of(vectors.slice(1, 2)) is None


def test_errors_of_values_near_a_million(spark):
    draw = np.random.RandomState(3)
    x = draw.normal(1e6, 0.5, (400, 8))
    y = x + draw.normal(0, 1e-3, x.shape)
    rows = [(i, a.tolist(), b.tolist()) for i, (a, b) in enumerate(zip(x, y, strict=True))] + [(400, None, [1.0]), (401, [1.0], [1.0, 2.0]), (402, [], []), (403, [None], [5.0])]
    df = spark.createDataFrame(rows, "id int, x array<double>, y array<double>").repartition(7)
    found = quantization_error(df, "x", "y").first()
    assert found.mse == pytest.approx(((x - y) ** 2).mean(), rel=1e-9) and found.max_absolute_error == pytest.approx(np.abs(x - y).max())
    assert found.snr_db == pytest.approx(10 * np.log10(x.var() / ((x - y) ** 2).mean()), abs=1e-3)


def test_errors_of_nothing(spark):
    row = quantization_error(spark.createDataFrame([], "x array<float>, y array<float>"), "x", "y").collect()
    assert len(row) == 1 and row[0].mse is None


def test_errors_and_moments_are_one_scan(spark, plan_of, tmp_path):
    spark.range(50).selectExpr("array(cast(id as float), 1f) x", "array(cast(id as float), 2f) y").write.parquet(str(tmp_path / "v"))
    df = spark.read.parquet(str(tmp_path / "v"))
    plan = plan_of(quantization_error(df, "x", "y"))
    assert plan.count("FileScan") == 1 and "Generate" not in plan
    assert plan_of(folded(df.select("x"), VectorMoments, lambda b: VectorMoments.of(b.column("x")))).count("FileScan") == 1


def test_pca_far_from_zero(spark):
    draw = np.random.RandomState(9)
    matrix = draw.normal(0, 1, (300, 6)) * np.arange(1, 7) + 1e6
    df = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(matrix)], "id int, vector array<double>").repartition(9)
    projected, ratios = project_pca(df, 2)
    centred = matrix - matrix.mean(axis=0)
    _, s, vt = np.linalg.svd(centred, full_matrices=False)
    found = np.array([r.projection for r in projected.orderBy("id").collect()])
    assert np.allclose(np.abs(found), np.abs(centred @ vt[:2].T), atol=1e-6) and np.allclose(ratios, (s**2 / (s**2).sum())[:2])
