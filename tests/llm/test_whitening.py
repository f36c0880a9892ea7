import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
import pytest

from matchlake.llm import whitening
from matchlake.llm.queries import QUERIES

SHAPE = "vec_id long, embedding array<float>, component string, row string, v string"


def _fine(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def _check(found, vectors, components=8):
    """Against integers and fractions, row by row."""
    n = len(vectors)
    x = [[math.floor(Fraction(c) * 1024) + 100_000 for c in v] for _, v in vectors]
    dim = len(x[0])
    sums = [sum(r[j] for r in x) for j in range(dim)]
    centred = [[n * r[j] - sums[j] for j in range(dim)] for r in x]
    v = np.array(
        [[float(Fraction(sum(r[i] * r[j] for r in centred), n**3)) for j in range(dim)] for i in range(dim)]
    )
    values = np.sort(np.linalg.eigvalsh(v))[::-1]
    got = found.collect()
    assert len(got) == n * min(dim, components) and {r.n for r in got} == {n}
    by_component = {}
    deviation = {i: sum(c * c for c in r) for (i, _), r in zip(vectors, centred, strict=True)}
    for r in got:
        assert int(r.deviation) == deviation[r.vec_id]
        by_component.setdefault(r.component, {})[r.vec_id] = r
    for k, rows in by_component.items():
        one = next(iter(rows.values()))
        assert one.explained == pytest.approx(values[k - 1] / v.trace(), rel=1e-6)
        w = np.array([rows[i].whitened for i, _ in vectors])
        c = np.array(centred, dtype=float) / n
        direction = c.T @ w / n * math.sqrt(1 / values[k - 1])  # V u e**-1/2 * e**-1/2 = u
        assert np.linalg.norm(direction) == pytest.approx(1, abs=1e-9)
        assert np.abs(v @ direction - values[k - 1] * direction).max() < 1e-8 * values[0]
        assert np.allclose(c @ direction / math.sqrt(values[k - 1]), w, atol=1e-9)
        assert 0 <= one.identity_error < 1e-9
    w = np.array([[by_component[k][i].whitened for k in sorted(by_component)] for i, _ in vectors])
    assert np.abs(w.T @ w / n - np.eye(w.shape[1])).max() < 1e-9


def test_query_against_plain_version(spark, small):
    rows = spark.read.parquet(f"{small}/embeddings.parquet").collect()
    found = QUERIES["op11_whitening"](spark, small)
    assert dict(found.dtypes) == {
        "vec_id": "bigint", "component": "int", "n": "bigint", "deviation": "bigint",
        "whitened": "double", "explained": "double", "identity_error": "double",
    }
    _check(found, [(r.vec_id, r.embedding) for r in rows if _fine(r.embedding)])


@pytest.mark.parametrize("rows", [1, 63, 64, 65, 1000])
@pytest.mark.parametrize("spread", [1, 2000, 1 << 40])
def test_cross_products_are_exact(rows, spread):
    x = np.random.default_rng(rows).integers(-spread, spread, (rows, 5)) + 100_000
    exact = x.astype(object)
    assert (whitening.cross_products(x) == exact.T @ exact).all()


def test_tasks_add_up(spark):
    rng = np.random.default_rng(5)
    vectors = [(i, [float(c) for c in rng.normal(size=3).astype(np.float32) * 10]) for i in range(900)]
    frame = spark.createDataFrame(vectors, "vec_id long, embedding array<float>")
    _check(whitening.whiten(frame.repartition(7)), vectors)


def test_blocks_add_up(monkeypatch):
    monkeypatch.setattr(whitening, "BLOCK_ENTRIES", 300)
    rng = np.random.default_rng(6)
    vectors = [list(map(float, rng.normal(size=d))) for d in rng.integers(2, 5, 1000)]
    batches = [
        pa.RecordBatch.from_arrays([pa.array(vectors[at : at + 130], pa.list_(pa.float64()))], names=["v"])
        for at in range(0, 1000, 130)
    ]
    parts = {}
    for batch in whitening._scatter(iter(batches)):
        for r in batch.to_pylist():
            parts[r["dim"], r["i"], r["j"]] = int(r["part"])
    for dim in (2, 3, 4):
        x = whitening.steps(np.array([v for v in vectors if len(v) == dim])).astype(object)
        assert parts[dim, -1, -1] == len(x) and [parts[dim, -1, j] for j in range(dim)] == list(x.sum(axis=0))
        product = x.T @ x
        assert all(parts[dim, i, j] == product[i, j] for i in range(dim) for j in range(i, dim))


def test_odd_rows(spark):
    rng = np.random.default_rng(3)
    vectors = [(i, [float(c) for c in rng.normal(size=4).astype(np.float32)]) for i in range(40)]
    vectors += [(100 + i, v) for i, v in vectors[:5]]  # repeated vectors count again
    bad = [None, [], [1.0, None, 2.0, 3.0], [1.0, float("nan"), 2.0, 3.0], [float("inf")] * 4, [-float("inf")] * 4, [1.0, 2.0]]
    rows = [(i, v, "a", "b", "c") for i, v in vectors] + [(None, v, "a", None, "c") for v in bad]
    frame = spark.createDataFrame(rows, SHAPE)
    found = whitening.whiten(frame, components=3)
    assert found.columns.count("component") == 1 and {"row", "v", "embedding"} <= set(found.columns)
    _check(found, vectors, components=3)


def test_null_ids_and_repeated_rows_stay(spark):
    rows = [(None, [1.0, 2.0]), (None, [1.0, 2.0]), (1, [2.0, 5.0]), (2, [0.0, 1.0])]
    found = whitening.whiten(spark.createDataFrame(rows, "vec_id long, embedding array<double>"))
    assert found.filter("vec_id IS NULL").count() == 4 and {r.n for r in found.collect()} == {4}


@pytest.mark.parametrize("times", [1, 3])
def test_no_variance(spark, times):
    frame = spark.createDataFrame([(i, [1.0, 2.0]) for i in range(times)], "vec_id long, embedding array<float>")
    got = whitening.whiten(frame).collect()
    assert len(got) == 2 * times
    assert {(r.whitened, r.explained, r.identity_error, int(r.deviation)) for r in got} == {(None, None, None, 0)}


def test_component_without_variance(spark):
    frame = spark.createDataFrame([(i, [float(i), 2.0]) for i in range(9)], "vec_id long, embedding array<float>")
    got = whitening.whiten(frame).collect()
    assert {r.component for r in got if r.whitened is None} == {2} and all(r.identity_error < 1e-9 for r in got)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [])]])
def test_nothing_to_whiten(spark, rows):
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    assert whitening.whitening_table(frame).count() == 0


def test_sums_beyond_a_long(spark):
    rows = [(i, [float(i % 7) * 4e9, 1.0 * i]) for i in range(50)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    assert {r.deviation for r in whitening.whitening_table(frame).collect()} == {None}
    _check(whitening.whiten(frame, components=1), rows, components=1)
    with pytest.raises(OverflowError):
        whitening.steps(np.array([[1e30]]))
