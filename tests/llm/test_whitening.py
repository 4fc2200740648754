"""Whitening against numpy's eigenvalues and plain Python sums."""

import math
from fractions import Fraction

import numpy as np
import pytest

from opslake.llm import whitening as W


def matrices():
    rng = np.random.default_rng(5)
    q = np.linalg.qr(rng.standard_normal((40, 40)))[0]
    spread = rng.random(40) * 10
    yield q @ np.diag(spread) @ q.T
    yield q @ np.diag(np.r_[[5, 5, 5, 4, 4, 1e-3, 1e-3 + 1e-9], np.zeros(33)]) @ q.T  # equal and almost equal ones
    yield q @ np.diag(10.0 ** -np.arange(40)) @ q.T  # far apart
    yield q @ np.diag(np.r_[[1 + 1e-12, 1, 1 - 1e-12], np.full(37, 0.5)]) @ q.T
    yield np.zeros((6, 6))
    yield np.eye(5)
    yield np.array([[3.0]])
    yield np.array([[0.0, 1.0], [1.0, 0.0]])
    yield np.diag([1.0, -2.0, 3.0])


@pytest.mark.parametrize("matrix", list(matrices()))
def test_leading_eigenpairs(matrix):
    matrix = (matrix + matrix.T) / 2
    n = len(matrix)
    true = np.sort(np.linalg.eigvalsh(matrix))[::-1]
    values, vectors = W.leading(matrix, 8)
    norm = max(1e-300, np.abs(matrix).sum(1).max())
    assert len(values) == min(8, n)
    assert np.abs(values - true[:8]).max() <= 1e-13 * n * norm
    assert np.abs(vectors.T @ vectors - np.eye(len(values))).max() < 1e-10
    assert np.abs(matrix @ vectors - vectors * values).max() <= 1e-12 * n * norm


def test_counts_are_those_of_the_eigenvalues():
    rng = np.random.default_rng(1)
    for n in (1, 2, 3, 7, 30):
        for _ in range(20):
            a = rng.standard_normal((n, n)) * (rng.random((n, n)) < 0.6)
            a = a + a.T
            true = np.linalg.eigvalsh(a)
            for s in (*rng.standard_normal(5), 0.1):
                if np.abs(true - s).min() > 1e-9:
                    assert W.above(a, s) == (true > s).sum()


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int, w string, n string, deviation string").repartition(5)


BAD = [(900, None), (901, []), (902, [1.0, None] * 8), (903, [math.nan] + [0.0] * 15), (904, [math.inf] + [0.0] * 15), (905, [0.5] * 3),
       (906, [3e9] + [0.0] * 15)]


def test_query_equals_plain_sums(spark, tmp_path):
    rng = np.random.default_rng(2)
    good = [(i, np.float32(rng.standard_normal(16) * np.linspace(2, 0.1, 16) + 0.3).tolist()) for i in range(300)]
    good += [good[4], good[4], (None, good[7][1])]
    table(spark, [(i, v, 1, "x", "y", None) for i, v in good + BAD]).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = W.op12_whitening(spark, str(tmp_path)).collect()
    x = np.array([[math.floor(1024 * np.float64(c)) + 100_000 for c in v] for _, v in good])
    n, s = len(x), x.sum(0)
    y = np.array([[float(Fraction(int(a) * n - int(b), n)) for a, b in zip(row, s)] for row in x])
    cov = y.T @ y / n
    e, q = np.linalg.eigh(cov)
    e, q = e[::-1], q[:, ::-1]
    assert len(got) == 8 * n and {r.n for r in got} == {n}
    assert sorted((str(r.vec_id), r.deviation) for r in got) == sorted(
        (str(i), sum((n * int(a) - int(b)) ** 2 for a, b in zip(row, s))) for (i, _), row in zip(good, x) for _ in range(8))
    assert len({r.identity_error for r in got}) == 1 and got[0].identity_error < 1e-10
    by = {(r.vec_id, r.component): r for r in got}
    for c in range(1, 9):
        mine = np.array([by[i, c].whitened for i in range(300)])
        true = y[:300] @ q[:, c - 1] / math.sqrt(e[c - 1])
        assert min(np.abs(mine - true).max(), np.abs(mine + true).max()) < 1e-9
        assert by[0, c].explained == pytest.approx(e[c - 1] / np.trace(cov), rel=1e-12)


def test_tables_without_spread_or_rows(spark, tmp_path):
    table(spark, [(i, v, 1, "x", "y", None) for i, v in BAD[:3] if not v or len(v) > 3]).write.parquet(f"{tmp_path}/a/embeddings.parquet")
    out = W.op12_whitening(spark, f"{tmp_path}/a")
    assert out.count() == 0
    kinds = dict(out.dtypes)
    table(spark, [(i, [0.5, -1.0, 2.0], 1, "x", "y", None) for i in range(4)]).write.parquet(f"{tmp_path}/b/embeddings.parquet")
    out = W.op12_whitening(spark, f"{tmp_path}/b")
    rows = out.collect()
    assert dict(out.dtypes) == kinds and len(rows) == 12
    assert {(r.n, r.deviation, r.whitened, r.explained, r.identity_error) for r in rows} == {(4, 0, None, 0.0, 0.0)}
    # Two rows: one component with spread.
    table(spark, [(i, [0.5 * i, -1.0, 2.0], 1, "x", "y", None) for i in range(2)]).write.parquet(f"{tmp_path}/c/embeddings.parquet")
    rows = W.op12_whitening(spark, f"{tmp_path}/c").collect()
    assert sorted((r.vec_id, r.component, abs(r.whitened)) for r in rows if r.whitened is not None) == [
        (0, 1, pytest.approx(1)), (1, 1, pytest.approx(1))]


def test_extra_columns_and_large_deviations(spark):
    df = table(spark, [(i, [float(i % 7), float(i % 3)], i, "old", "y", "z") for i in range(50)])
    model = W.fit(df, "embedding", 2)
    out = W.whiten(df, "embedding", model, "w", "deviation")
    assert out.columns == df.columns and out.count() == 50
    assert dict(out.dtypes)["w"] == "array<double>" and dict(out.dtypes)["label"] == "int"
    model.n, model.sums = 10 ** 9, [10 ** 9 * 100_001] * 2
    assert model.deviation(np.array([[100_001, 100_001], [100_004, 100_001]])) == [0, 9 * 10 ** 18]
    assert model.deviation(np.array([[100_005, 100_001]])) == [None]


def test_centring_of_far_entries():
    """The offset of 100,000 doesn't cost digits of a small spread."""
    model = W.Whitening(3, 1, [300_001])
    assert model.centred(np.array([[100_000], [100_001]])).ravel().tolist() == [pytest.approx(-1 / 3, rel=1e-15), pytest.approx(2 / 3, rel=1e-15)]
