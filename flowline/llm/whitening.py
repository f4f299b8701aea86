"""Whitening of embedding vectors along the leading eigenvectors of their covariance.

Entries become whole numbers, so their sums and products are added up exactly,
in any order and on any number of tasks: each task hands on its sums as whole
numbers in two limbs, which Spark adds as decimals. The driver gets the sums of
one matrix, whose size is that of a vector squared, finds the eigenvectors by
spectrum slicing and hands them to the tasks that project the vectors.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowline.llm.spectrum import leading
from flowline.llm.tables import map_arrow, pick

#: Components kept.
COMPONENTS = 8
#: x = floor(SCALE * entry) + OFFSET.
SCALE, OFFSET = 1024, 100_000
#: Whole numbers beyond this size count as this one, so that they fit in 64 bits with their offset.
LARGEST = 1 << 62

_LIMB = 1 << 60
_SUMS = T.StructType(
    [
        T.StructField("size", T.IntegerType()),
        T.StructField("place", T.IntegerType()),
        T.StructField("high", T.DecimalType(38, 0)),
        T.StructField("low", T.LongType()),
    ]
)
_MOMENTS = T.StructType([T.StructField("n", T.LongType()), T.StructField("sums", T.ArrayType(T.DoubleType()))])
WHITENED = T.StructType(
    [
        T.StructField("vec_id", T.LongType()),
        T.StructField("component", T.IntegerType()),
        T.StructField("n", T.LongType()),
        T.StructField("deviation", T.LongType()),
        T.StructField("whitened", T.DoubleType()),
        T.StructField("explained", T.DoubleType()),
    ]
)


@dataclass(frozen=True)
class Whitening:
    """n vectors with sums ``sums`` per dimension; components as rows, their eigenvalues, and all eigenvalues' sum."""

    n: int
    sums: tuple[int, ...]
    vectors: np.ndarray
    values: np.ndarray
    trace: float

    @property
    def centre(self) -> tuple[np.ndarray, np.ndarray]:
        """The mean as a whole number and the rest, in n-ths."""
        whole = [s // self.n for s in self.sums] if self.n else []
        return np.array(whole, np.int64), np.array([s - self.n * m for s, m in zip(self.sums, whole)], np.int64)

    @property
    def explained(self) -> np.ndarray:
        return self.values / self.trace if self.trace else np.zeros(len(self.values))


def _vectors(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    found = pick(df, vec_id=id_col, vector=vector_col)
    return found.select(F.col("vec_id").cast("bigint"), F.col("vector").cast("array<double>").alias("vector"))


def _whole(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Rows and their whole numbers, by the size of the vector; rows that are not finite throughout are left out."""
    vectors = batch.column("vector")
    sizes = np.asarray(pc.fill_null(pc.list_value_length(vectors), -1)).astype(np.int64)
    rows = np.flatnonzero(sizes >= 0)
    values = vectors.flatten().to_numpy(zero_copy_only=False).astype(float)  # null entries become NaN
    starts = np.cumsum(sizes[rows]) - sizes[rows]
    for size in np.unique(sizes[rows]):
        of_size = sizes[rows] == size
        entries = values[starts[of_size][:, None] + np.arange(size)]
        finite = np.isfinite(entries).all(axis=1)
        with np.errstate(over="ignore"):
            scaled = np.clip(np.floor(SCALE * entries[finite]), -LARGEST, LARGEST)
        yield rows[of_size][finite], scaled.astype(np.int64) + OFFSET


def _add_up(terms: np.ndarray) -> list[int]:
    """Exact sums of the columns of whole numbers."""
    most = int(np.abs(terms).max(initial=0))
    if most * max(1, len(terms)) < 1 << 63:
        return terms.sum(axis=0, dtype=np.int64).tolist()
    return terms.astype(object).sum(axis=0).tolist()


def _products(terms: np.ndarray) -> list[int]:
    """Exact sums of the products of each two columns, first column by first column."""
    most = int(np.abs(terms).max(initial=0))
    if most * most * max(1, len(terms)) < 1 << 53:  # floating point is exact up to there
        real = terms.astype(float)
        found = (real.T @ real).astype(np.int64)
    else:
        found = terms.astype(object).T @ terms.astype(object)
    return found[np.triu_indices(terms.shape[1])].tolist()


def _rows_of_sums(size: int, sums: list[int], rows: int = 1 << 16) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(sums), rows):
        some = sums[at : at + rows]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([size] * len(some), pa.int32()),
                pa.array(range(at, at + len(some)), pa.int32()),
                pa.array([s // _LIMB for s in some], pa.decimal128(38, 0)),
                pa.array([s % _LIMB for s in some], pa.int64()),
            ],
            _SUMS.names,
        )


def _collected(partial: DataFrame) -> dict[int, list[int]]:
    """Sums over all tasks: size of the vectors -> sums in order of their place."""
    added = partial.groupBy("size", "place").agg(
        F.sum("high").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).alias("low")
    )
    found: dict[int, list[int]] = {}
    for row in added.orderBy("size", "place").collect():
        found.setdefault(row.size, []).append(int(row.high) * _LIMB + int(row.low))
    return found


def _total(vectors: DataFrame, terms_of) -> DataFrame:
    """One row of sums per size, place and task; ``terms_of`` makes sums of a matrix of whole numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept: dict[int, list[int]] = {}
        for batch in batches:
            for rows, whole in _whole(batch):
                if len(rows):
                    sums = terms_of(whole)
                    if sums is not None:
                        before = kept.get(whole.shape[1])
                        kept[whole.shape[1]] = sums if before is None else [a + b for a, b in zip(before, sums)]
        for size, sums in kept.items():
            yield from _rows_of_sums(size, sums)

    return map_arrow(vectors, run, _SUMS)


def _common_size(vectors: DataFrame) -> int:
    """The size most vectors without null or infinite entries have, of several the largest; 0 without vectors."""
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
    sizes = vectors.filter(finite).groupBy(F.size("vector").alias("size")).count()
    top = sizes.orderBy(F.desc("count"), F.desc("size")).limit(1).collect()
    return top[0].size if top else 0


def fit(df: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vector_col: str = "embedding") -> Whitening:
    """The covariance of all vectors and its leading eigenvectors.

    Vectors that are null or hold null or non-finite entries do not count, nor
    those of another size than most have. Repeated rows count as often as they
    stand there. The covariance is exact up to its last rounding: products are
    added of what is left after the whole part of the mean is taken off, and the
    rest of the mean is taken off the sum. There are at most as many components
    as dimensions; without vectors there are none. An eigenvalue that is mere
    rounding counts as 0.
    """
    vectors = _vectors(df, id_col, vector_col)
    size = _common_size(vectors)
    vectors = vectors.filter(F.size("vector") == size)
    sums = _collected(_total(vectors, lambda x: [len(x), *_add_up(x)])).get(size)
    if not size or not sums:
        return Whitening(0, (), np.zeros((0, 0)), np.zeros(0), 0.0)
    n, sums = sums[0], sums[1:]
    whole = np.array([s // n for s in sums], np.int64)
    rest = [s % n for s in sums]
    products = _collected(_total(vectors, lambda x: _products(x - whole)))[size]
    covariance = np.zeros((size, size))
    for i, j, product in zip(*np.triu_indices(size), products):
        covariance[i, j] = covariance[j, i] = (n * product - rest[i] * rest[j]) / (n * n)
    values, directions = leading(covariance, components)
    trace = float(np.trace(covariance))
    values[values <= 16 * size * np.finfo(float).eps * trace] = 0.0
    return Whitening(n, tuple(sums), directions, values, trace)


def _deviations(whole: np.ndarray, n: int, rest: np.ndarray) -> list[int | None]:
    """Sums of squares of n * whole - rest, exactly; None where a long cannot hold it."""
    most = int(np.abs(whole).max(initial=0))
    if (most + 1) ** 2 * n * n * whole.shape[1] < 1 << 63:
        return np.square(n * whole - rest).sum(axis=1).tolist()
    if most * most * whole.shape[1] < 1 << 63 and most * n * whole.shape[1] < 1 << 63:
        squares, mixed = np.square(whole).sum(axis=1).tolist(), (whole @ rest).tolist()
        constant = sum(r * r for r in rest.tolist())
        found = [n * n * a - 2 * n * b + constant for a, b in zip(squares, mixed)]
    else:
        found = np.square(n * whole.astype(object) - rest.astype(object)).sum(axis=1).tolist()
    return [f if f < 1 << 63 else None for f in found]


def _projection(model: Whitening):
    """Whole numbers less the whole part of the mean -> their whitened components, NaN along directions of no spread."""
    _, rest = model.centre
    shift = rest / model.n
    with np.errstate(divide="ignore", invalid="ignore"):
        scale = np.where(model.values > 0, 1 / np.sqrt(np.maximum(model.values, 0)), np.nan)
    return lambda whole: (whole - shift) @ model.vectors.T * scale


def transform(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row per counted vector and component: vec_id, component, n, deviation, whitened, explained.

    Which vectors count is said at :func:`fit`. deviation is null where a long
    cannot hold it, whitened where the component's eigenvalue is not positive.
    Repeated rows and null ids give rows each.
    """
    shared = df.sparkSession.sparkContext.broadcast(model)
    size = len(model.sums)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        count = len(model.values)
        mean, rest = model.centre
        project, explained = _projection(model), model.explained
        for batch in batches:
            for rows, whole in _whole(batch):
                if not len(rows):
                    continue
                whole = whole - mean
                deviations = pa.array(_deviations(whole, model.n, rest), pa.int64())
                whitened = project(whole).ravel()
                each = np.repeat(np.arange(len(rows)), count)
                columns = [
                    batch.column("vec_id").take(pa.array(rows[each])),
                    pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(rows))),
                    pa.array(np.full(len(each), model.n)),
                    deviations.take(pa.array(each)),
                    pa.array(whitened, mask=np.isnan(whitened)),
                    pa.array(np.tile(explained, len(rows))),
                ]
                yield pa.RecordBatch.from_arrays(columns, WHITENED.names)

    vectors = _vectors(df, id_col, vector_col)
    return map_arrow(vectors.filter(F.size("vector") == (size or -2)), run, WHITENED)


def identity_error(df: DataFrame, model: Whitening, id_col: str = "vec_id", vector_col: str = "embedding") -> float:
    """Largest entry, in size, of the covariance of the whitened vectors less the identity, measured over all of them.

    Components of no spread are left out; 0 if none is left.
    """
    used = np.flatnonzero(model.values > 0)
    if not len(used):
        return 0.0
    shared = df.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        mean, _ = model.centre
        project = _projection(model)
        n, sums, products = 0, 0.0, 0.0
        for batch in batches:
            for _, whole in _whole(batch):
                own = project(whole - mean)[:, used]
                n, sums, products = n + len(own), sums + own.sum(axis=0), products + own.T @ own
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n], pa.int64()), pa.array([[*sums, *products.ravel()]], pa.list_(pa.float64()))], _MOMENTS.names
            )

    vectors = _vectors(df, id_col, vector_col).filter(F.size("vector") == len(model.sums))
    moments = map_arrow(vectors, run, _MOMENTS)
    k = len(used)
    totals = moments.agg(F.sum("n"), *[F.sum(F.col("sums")[i]) for i in range(k + k * k)]).first()
    n, found = totals[0], np.array(totals[1:])
    # The vectors are centred already, so what their mean takes off is mere rounding.
    average = found[:k] / n
    covariance = found[k:].reshape(k, k) / n - np.outer(average, average)
    return float(np.abs(covariance - np.eye(k)).max())
