"""Whitening of embeddings, from exact integer scatter matrices counted on bit planes.

An entry c becomes the integer floor(1024 c) + 100000. Within a block of rows each dimension is
shifted to start at zero, and its bits are packed across rows: one plane per dimension and bit, 64
rows to a word. The sum of products of two dimensions is the sum, over pairs of their planes, of
2**(bits' places) times the ones in the AND of the planes; undoing the shifts is integer arithmetic
as well. So every sum is exact, in whatever order tasks add theirs up. The scatter is centred as
integers too (n times the products minus the product of the sums), and only the quotient by n
squared is rounded, once, before the eigenvectors are taken.

What reaches the driver is one matrix of the dimensions, whatever the number of rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from matchlake.llm.common import Scratch, pack, replace_columns

SCALE, OFFSET = 1024, 100_000
COMPONENTS = 8
#: Entries of the blocks whose planes are held at once.
BLOCK_ENTRIES = 4_000_000
#: Steps an entry may be from zero; sums over 2**24 rows of a task then fit 38 digits.
LARGEST = 1 << 46
#: Variance below this share of the whole is rounding: nothing can be scaled by it.
LEAST_SHARE = 1e-12
MADE = ["component", "n", "deviation", "whitened", "explained", "identity_error"]
_SUMS = "dim int, i int, j int, part decimal(38,0)"


def usable(column: str) -> Column:
    """Vectors that are not NULL and hold neither NULL nor non-finite entries."""
    fine = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))
    return F.col(column).isNotNull() & F.forall(column, fine)


def steps(vectors: np.ndarray) -> np.ndarray:
    """Entries as integers."""
    scaled = np.floor(SCALE * vectors.astype(np.float64))
    if scaled.size and np.abs(scaled).max() >= LARGEST:
        raise OverflowError(f"an entry is {LARGEST / SCALE:.1e} or more, too large for exact sums")
    return scaled.astype(np.int64) + OFFSET


def _matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places in the batch, integer vectors) for every length there is in a batch of lists."""
    lengths = np.diff(np.asarray(column.offsets))
    starts, values = np.asarray(column.offsets)[:-1], column.values.to_numpy(zero_copy_only=False)
    for dim in np.unique(lengths):
        places = np.flatnonzero(lengths == dim)
        at = starts[places, None] + np.arange(dim)
        yield places, steps(values[at])


def cross_products(x: np.ndarray) -> np.ndarray:
    """Sums over rows of x[:, i] * x[:, j] as Python integers, counted on bit planes."""
    rows, dim = x.shape
    low = x.min(axis=0)
    shifted = x - low
    bits = max(1, int(shifted.max()).bit_length())
    words = -(-rows // 64)
    planes = np.zeros((dim, bits, words * 8), dtype=np.uint8)
    for b in range(bits):
        packed = np.packbits(((shifted >> b) & 1).astype(np.uint8), axis=0)
        planes[:, b, : packed.shape[0]] = packed.T
    planes = planes.view(np.uint64)
    # counts times weights stay below 2**62, or Python integers take over
    kind = np.int64 if 2 * bits + rows.bit_length() < 62 else object
    weights = np.array([1 << b for b in range(bits)], dtype=kind)
    product = np.zeros((dim, dim), dtype=object)
    for i in range(dim):
        others, row = planes[i:].reshape(-1, words), 0
        for a in range(bits):
            ones = np.bitwise_count(others & planes[i, a]).sum(axis=1, dtype=np.int64)
            row = row + (ones.reshape(-1, bits).astype(kind) @ weights) * weights[a]
        product[i, i:] = product[i:, i] = row
    sums = shifted.sum(axis=0, dtype=object) if bits + rows.bit_length() >= 62 else shifted.sum(axis=0)
    sums, low = sums.astype(object), low.astype(object)
    # (y_i + l_i)(y_j + l_j), summed
    return product + np.outer(sums, low) + np.outer(low, sums) + rows * np.outer(low, low)


def _scatter(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Per vector length, what this task's rows add: their number, sums and products.

    Place (-1, -1) holds the number, (-1, j) the sum of dimension j, (i, j) the products, i <= j.
    """
    totals: dict[int, list] = {}
    waiting: dict[int, list[np.ndarray]] = {}

    def add(dim: int) -> None:
        x = np.concatenate(waiting.pop(dim))
        mine = totals.setdefault(dim, [0, np.zeros(dim, dtype=object), np.zeros((dim, dim), dtype=object)])
        mine[0] += len(x)
        if dim:
            mine[1] = mine[1] + x.sum(axis=0, dtype=object)
            mine[2] = mine[2] + cross_products(x)

    for batch in batches:
        for _, x in _matrices(batch.column(0)):
            dim = x.shape[1]
            most = max(64, BLOCK_ENTRIES // max(1, dim))
            for start in range(0, len(x), most):
                part = x[start : start + most]
                if sum(map(len, waiting.get(dim, []))) + len(part) > most:
                    add(dim)
                waiting.setdefault(dim, []).append(part)
    for dim in list(waiting):
        add(dim)
    for dim, (n, sums, products) in totals.items():
        upper = [(i, j) for i in range(dim) for j in range(i, dim)]
        places = [(-1, -1), *[(-1, j) for j in range(dim)], *upper]
        values = [n, *sums, *[products[p] for p in upper]]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([dim] * len(places), pa.int32()),
                pa.array([p[0] for p in places], pa.int32()),
                pa.array([p[1] for p in places], pa.int32()),
                pa.array([Decimal(int(v)) for v in values], pa.decimal128(38, 0)),
            ],
            names=["dim", "i", "j", "part"],
        )


@dataclass(frozen=True)
class Whitening:
    """Number of vectors, their integer sums, and the components of their covariance."""

    n: int
    sums: tuple[int, ...]
    values: np.ndarray
    vectors: np.ndarray
    trace: float

    @property
    def dim(self) -> int:
        return len(self.sums)


def fit_whitening(frame: DataFrame, vector_col: str = "embedding") -> Whitening | None:
    """Whitening of all usable vectors of the most frequent length, the smaller one of equals.

    None where there is no vector.
    """
    usable_rows = frame.select(F.col(f"`{vector_col}`").alias("v")).filter(usable("v"))
    parts = usable_rows.mapInArrow(_scatter, _SUMS)
    # a row per pair of dimensions and task, added up by pair; then one matrix per length
    scratch = Scratch(frame.sparkSession, "scatter")
    summed = scratch.save(parts.groupBy("dim", "i", "j").agg(F.sum("part").alias("part")), "sums")
    counts = {r.dim: int(r.part) for r in summed.filter("i = -1 and j = -1").collect()}
    if not counts:
        return None
    dim = min(counts, key=lambda d: (-counts[d], d))
    rows = summed.filter((F.col("dim") == dim) & (F.col("j") >= 0)).collect()
    n = counts[dim]
    sums, products = [0] * dim, np.zeros((dim, dim), dtype=object)
    for r in rows:
        if r.i < 0:
            sums[r.j] = int(r.part)
        else:
            products[r.i, r.j] = products[r.j, r.i] = int(r.part)
    return _components(n, sums, products)


def _components(n: int, sums: list[int], products: np.ndarray) -> Whitening:
    s = np.array(sums, dtype=object)
    centred = n * products - np.outer(s, s)
    # a quotient of Python integers is rounded once, however large they are
    covariance = np.array([[int(c) / (n * n) for c in row] for row in centred]).reshape(len(sums), len(sums))
    values, vectors = np.linalg.eigh(covariance) if len(sums) else (np.zeros(0), np.zeros((0, 0)))
    order = np.argsort(-values, kind="stable")
    values, vectors = np.maximum(values[order], 0.0), vectors[:, order]
    # either sign will do: the largest entry is positive
    for k in range(vectors.shape[1]):
        if vectors[np.argmax(np.abs(vectors[:, k])), k] < 0:
            vectors[:, k] *= -1
    return Whitening(n, tuple(sums), values, vectors, float(np.trace(covariance)) if len(sums) else 0.0)


def _apply(model: Whitening, components: int):
    """Rows to their exact deviation and whitened coordinates (NaN where nothing can be scaled)."""
    n, dim = model.n, model.dim
    kept = model.values[:components]
    scale = np.where(kept > LEAST_SHARE * model.trace, 1 / np.sqrt(np.where(kept > 0, kept, 1.0)), np.nan)
    matrix = model.vectors[:, :components] * scale
    sums = np.array(model.sums, dtype=object)
    # a whole number near the mean keeps the products of a row small; what it is short of is exact
    near = sums // n
    rest = sums - n * near
    mean_rest = np.array([int(r) / n for r in rest])
    rest_square = int((rest * rest).sum()) if dim else 0

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            places, deviations, coordinates = [], [], []
            for at, x in _matrices(batch.column(1)):
                if x.shape[1] != dim:
                    continue
                moved = x - near.astype(np.int64)
                wide = moved.size and int(np.abs(moved).max()) ** 2 * max(dim, 1) >= 1 << 62
                exact = moved.astype(object) if wide else moved
                squares = (exact * exact).sum(axis=1)
                if n * max(1, int(np.abs(moved).max()) if moved.size else 1) * max(dim, 1) >= 1 << 62:
                    along = (moved.astype(object) * rest).sum(axis=1) if dim else [0] * len(x)
                else:
                    along = moved @ rest.astype(np.int64)
                places.append(at)
                # the sum of (n y - r)^2 for y = x - near, r = S - n near
                deviations += [
                    n * n * int(q) - 2 * n * int(a) + rest_square for q, a in zip(squares, along, strict=True)
                ]
                coordinates.append((moved - mean_rest) @ matrix)
            at = np.concatenate(places) if places else np.zeros(0, dtype=np.int64)
            points = np.concatenate(coordinates) if places else np.zeros((0, matrix.shape[1]))
            width = points.shape[1]
            ends = pa.array(np.arange(len(points) + 1, dtype=np.int32) * width)
            flat = pa.array(points.reshape(-1), pa.float64(), mask=np.isnan(points.reshape(-1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array(at)),
                    pa.array([Decimal(d) for d in deviations], pa.decimal128(38, 0)),
                    pa.ListArray.from_arrays(ends, flat),
                ],
                names=["row", "deviation", "points"],
            )

    return task


def whiten(
    frame: DataFrame,
    vector_col: str = "embedding",
    components: int = COMPONENTS,
    carry: list[str] | None = None,
) -> DataFrame:
    """One row per usable vector and component: component, n, deviation, whitened, explained, identity_error.

    Rows whose vector is NULL or holds a NULL or non-finite entry are left out; so are vectors of
    another length than most have (the smaller one of equals). ``deviation`` (a decimal of 38 digits)
    is exact. Components are numbered from 1 by falling eigenvalue, at most ``components`` of them. One whose
    variance is mere rounding has no scale: its ``whitened`` is NULL, as for a single row or equal rows,
    whose ``explained`` is then NULL too. ``identity_error`` is measured on the whitened rows, over
    the components that have a scale, and NULL if none has. Repeated rows count as often as they
    come. An empty table, or one of empty vectors, gives an empty result. Entries of 2**36 and more
    raise OverflowError. Columns of ``frame`` named like a result column are replaced; only the
    columns of ``carry`` (all by default) are moved.
    """
    spark = frame.sparkSession
    carried = pack(frame.select(*[f"`{x}`" for x in carry]) if carry else frame, "row")
    # the vector itself is read again on the way, from the table
    given = frame.select(carried, F.col(f"`{vector_col}`").alias("v")).filter(usable("v"))
    model = fit_whitening(frame, vector_col)
    shape = T.StructType(
        [
            given.schema["row"],
            T.StructField("deviation", T.DecimalType(38, 0)),
            T.StructField("points", T.ArrayType(T.DoubleType())),
        ]
    )
    if model is None:
        points = spark.createDataFrame([], shape)
        model = Whitening(0, (), np.zeros(0), np.zeros((0, 0)), 0.0)
    else:
        points = given.mapInArrow(_apply(model, components), shape)
    points = Scratch(spark, "whitening").save(points, "points")
    error = _identity_error(points, model, components)
    share = [float(v / model.trace) if model.trace > 0 else None for v in model.values[:components]]
    made = points.select("row", "deviation", F.posexplode("points").alias("at", "whitened")).select(
        "row",
        (F.col("at") + 1).alias("component"),
        F.lit(model.n).cast("long").alias("n"),
        "deviation",
        "whitened",
        F.element_at(F.array(*[F.lit(s).cast("double") for s in share or [None]]), F.col("at") + 1).alias("explained"),
        F.lit(error).cast("double").alias("identity_error"),
    )
    return replace_columns(made, "row", MADE)


def _identity_error(points: DataFrame, model: Whitening, components: int) -> float | None:
    """Largest entry of the covariance of the whitened rows minus the identity."""
    scaled = [k for k, v in enumerate(model.values[:components]) if v > LEAST_SHARE * model.trace]
    if not scaled:
        return None
    pairs = [(a, b) for a in scaled for b in scaled if a <= b]
    found = points.agg(
        *[F.covar_pop(F.col("points")[a], F.col("points")[b]).alias(f"c{a}_{b}") for a, b in pairs]
    ).first()
    return max(abs(found[f"c{a}_{b}"] - (a == b)) for a, b in pairs)


def whitening_table(frame: DataFrame) -> DataFrame:
    """vec_id and the result columns, the deviation as long: NULL where it is 2**63 or more."""
    found = whiten(frame, carry=["vec_id"])
    return found.withColumn("deviation", F.expr("try_cast(deviation AS bigint)")).select("vec_id", *MADE)
