"""Whitening of embeddings, from whole-number sums to triangular factor to rotation.

Entries become whole numbers ``x = floor(scale * c)``. The fit list holds every distinct
x vector once. Tasks take off the whole part of the mean and sum products of what is
left; those sums are whole numbers and added exactly, so neither the partitions, their
order nor a task that runs twice can change them, and nothing cancels however far the
vectors lie from the origin. What the fraction of the mean adds is put in exactly
before the one rounding to doubles.

On the driver is one matrix of the vectors' dimension. Pivoted Cholesky factors the
scatter, ``P'AP = LL'``. One-sided Jacobi then rotates the columns of ``L`` until any
two are orthogonal: ``LJ = UD``, so the squared column norms are the eigenvalues of
``LL'`` and the normalised columns its eigenvectors; the scatter is never formed again.
The sign of a component makes its largest entry positive.

Rows whose vector is null, empty, or holds a null or non-finite entry are dropped.
Vectors must have one length: of several, the one with the most distinct vectors
counts (of equals the longest) and rows of other lengths are dropped. Entries beyond
the range of a long take its nearest end. Repeated vectors are fitted once and returned
each time; a null id is returned like any other. Components without variance are not
returned, so equal vectors alone, or an empty table, give no rows. A deviation beyond
the range of a long is null. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlake.llm.common import BATCH_ROWS, checkpointed

_LIMB = 1 << 62
#: Whole numbers up to this size are exact as doubles.
_EXACT = 1 << 53
ROWS = (
    "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
)


@dataclass(frozen=True)
class WhiteningParams:
    scale: float = 256.0
    components: int = 4
    #: Variance beneath this share of the largest counts as none.
    rank_tolerance: float = 1e-13
    max_sweeps: int = 60


@dataclass(frozen=True)
class Whitening:
    """A fitted whitening: sums of the fit list, its leading components and variances."""

    n: int
    sums: list[int]
    components: np.ndarray  # one per row
    variances: np.ndarray
    trace: float

    @property
    def dimension(self) -> int:
        return len(self.sums)


def whole_numbers(vectors: np.ndarray, scale: float) -> np.ndarray:
    low, high = -(2.0**63), np.nextafter(2.0**63, 0)
    return np.clip(np.floor(scale * vectors.astype("f8")), low, high).astype("<i8")


def _pack(row: np.ndarray) -> bytes:
    """The fewest bytes an entry that hold the vector: equal vectors, equal bytes."""
    low, high = int(row.min()), int(row.max())
    width = next(w for w in (1, 2, 4, 8) if -(1 << 8 * w - 1) <= low and high < 1 << 8 * w - 1)
    return bytes([width]) + row.astype(f"<i{width}").tobytes()


def _unpack(data: list[bytes], dimension: int) -> np.ndarray:
    out = np.empty((len(data), dimension), "<i8")
    for i, row in enumerate(data):
        out[i] = np.frombuffer(row, f"<i{row[0]}", dimension, 1)
    return out


def _vectors(scale: float):
    """Batches of (id, vector) to (id, dimension, packed whole numbers) of usable rows."""
    schema = pa.schema([("id", pa.int64()), ("dimension", pa.int32()), ("x", pa.binary())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                ids, dimensions, packed = [], [], []
                for key, vector in zip(part.column(0).to_pylist(), part.column(1)):
                    values = vector.values
                    if values is None or not len(values) or values.null_count:
                        continue
                    entries = values.to_numpy()
                    if np.isfinite(entries).all():
                        ids.append(key)
                        dimensions.append(len(entries))
                        packed.append(_pack(whole_numbers(entries, scale)))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(ids, pa.int64()), pa.array(dimensions, pa.int32()), pa.array(packed, pa.binary())],
                    schema=schema,
                )

    return run


def usable_vectors(df: DataFrame, params: WhiteningParams, id_column: str, vector_column: str) -> DataFrame:
    """id, dimension and packed whole numbers of every row with a usable vector."""
    read = df.select(F.col(id_column).cast("bigint").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    return read.mapInArrow(_vectors(params.scale), "id bigint, dimension int, x binary")


# --- exact sums ---------------------------------------------------------------


def _exact_products(rows: np.ndarray) -> np.ndarray:
    """The sum of outer products of whole-number rows, as Python integers."""
    largest = int(max(-int(rows.min()), int(rows.max()), 1))
    if largest * largest * len(rows) <= _EXACT:
        return (rows.astype("f8").T @ rows.astype("f8")).astype("<i8").astype(object)
    whole = rows.astype(object)
    return whole.T @ whole


def _limbs(values: list[int]) -> list[pa.Array]:
    return [pa.array([v >> 62 for v in values], pa.decimal128(38, 0)), pa.array([v & _LIMB - 1 for v in values], pa.int64())]


_PLACE = pa.schema([("place", pa.int64()), ("high", pa.decimal128(38, 0)), ("low", pa.int64())])
_PLACES = "place bigint, high decimal(38,0), low bigint"


def _sums(dimension: int, centre: list[int] | None):
    """Sums of the vectors by place, or with a centre, of the products of what differs from it."""
    upper = np.triu_indices(dimension)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, seen = None, 0
        middle = None if centre is None else np.asarray(centre, object)
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                rows = _unpack(batch.slice(start, BATCH_ROWS).column(0).to_pylist(), dimension)
                seen += len(rows)
                if middle is None:
                    part = rows.astype(object).sum(axis=0)
                else:
                    apart = rows.astype(object) - middle
                    small = max(abs(int(apart.min())), abs(int(apart.max()))) < _LIMB
                    part = _exact_products(apart.astype("<i8") if small else apart)
                total = part if total is None else total + part
        if total is None:
            return
        values = [seen, *total.tolist()] if middle is None else total[upper].tolist()
        places = pa.array(range(len(values)), pa.int64())
        yield pa.RecordBatch.from_arrays([places, *_limbs([int(v) for v in values])], schema=_PLACE)

    return run


def _added(partial: DataFrame) -> list[int]:
    """Exact totals by place; as many rows as the matrix has entries, whatever the input."""
    summed = partial.groupBy("place").agg(
        F.sum("high").cast("string").alias("high"), F.sum(F.col("low").cast("decimal(38,0)")).cast("string").alias("low")
    )
    rows = {r["place"]: int(r["high"]) * _LIMB + int(r["low"]) for r in summed.collect()}
    return [rows[i] for i in range(len(rows))]


def exact_covariance(fit_list: DataFrame, dimension: int) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, their sums, and the covariance (divisor n) rounded once per entry."""
    packed = fit_list.select("x")
    n, *sums = _added(packed.mapInArrow(_sums(dimension, None), _PLACES))
    centre = [s // n for s in sums]
    products = _added(packed.mapInArrow(_sums(dimension, centre), _PLACES))
    rest = [s - n * c for s, c in zip(sums, centre)]  # what the fraction of the mean makes up, at most n
    covariance = np.empty((dimension, dimension))
    for (i, j), product in zip(zip(*(a.tolist() for a in np.triu_indices(dimension))), products):
        covariance[i, j] = covariance[j, i] = float(Fraction(n * product - rest[i] * rest[j], n * n))
    return n, sums, covariance


# --- factor and rotation -------------------------------------------------------


def pivoted_cholesky(matrix: np.ndarray, tolerance: float) -> np.ndarray:
    """``L`` with ``matrix = LL'``, its rows in the matrix's order, one column per pivot.

    The largest remaining diagonal entry is the next pivot; the factor ends when none
    exceeds ``tolerance`` times the first, so it has as many columns as the matrix rank.
    """
    size = len(matrix)
    remaining, factor = np.diag(matrix).copy(), np.zeros((size, size))
    open_rows, rank = np.ones(size, bool), 0
    first = remaining.max(initial=0.0)
    while rank < size:
        pivot = int(np.argmax(np.where(open_rows, remaining, -np.inf)))
        if not open_rows[pivot] or remaining[pivot] <= tolerance * first:
            break
        root = np.sqrt(remaining[pivot])
        column = (matrix[:, pivot] - factor[:, :rank] @ factor[pivot, :rank]) / root
        column[~open_rows] = 0.0
        column[pivot] = root
        factor[:, rank] = column
        open_rows[pivot] = False
        remaining -= column * column
        rank += 1
    return factor[:, :rank]


def one_sided_jacobi(factor: np.ndarray, max_sweeps: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and eigenvectors (rows) of ``factor factor'``.

    Every sweep rotates all pairs of columns in rounds of disjoint pairs; it ends when no
    pair is further from orthogonal than rounding allows.
    """
    columns = factor.T.copy()
    if not len(columns):
        return np.zeros(0), np.zeros((0, factor.shape[0]))
    count = len(columns) + len(columns) % 2
    ring = list(range(count))
    for _ in range(max_sweeps):
        worst = 0.0
        for _ in range(count - 1):
            pairs = [(min(a, b), max(a, b)) for a, b in zip(ring[: count // 2], reversed(ring[count // 2 :]))]
            pairs = [p for p in pairs if p[1] < len(columns)]
            ring = [ring[0], ring[-1], *ring[1:-1]]
            if not pairs:
                continue
            left, right = np.asarray(pairs).T
            u, v = columns[left], columns[right]
            uu, vv, uv = (u * u).sum(1), (v * v).sum(1), (u * v).sum(1)
            size = np.sqrt(uu * vv)
            apart = np.where(size > 0, np.abs(uv) / np.where(size > 0, size, 1.0), 0.0)
            worst = max(worst, float(apart.max()))
            turn = apart > 1e-16
            zeta = (vv - uu) / np.where(turn, 2.0 * uv, 1.0)
            tangent = np.where(zeta >= 0, 1.0, -1.0) / (np.abs(zeta) + np.hypot(1.0, zeta))
            tangent = np.where(turn, tangent, 0.0)
            cosine = 1.0 / np.hypot(1.0, tangent)
            sine = cosine * tangent
            columns[left] = cosine[:, None] * u - sine[:, None] * v
            columns[right] = sine[:, None] * u + cosine[:, None] * v
        if worst <= 4e-16 * factor.shape[0]:
            break
    norms = np.sqrt((columns * columns).sum(1))
    order = np.argsort(-norms, kind="stable")
    vectors = columns[order] / norms[order][:, None]
    largest = vectors[np.arange(len(vectors)), np.abs(vectors).argmax(1)]
    return norms[order] ** 2, vectors * np.where(largest < 0, -1.0, 1.0)[:, None]


def fit(fit_list: DataFrame, dimension: int, params: WhiteningParams) -> Whitening:
    """``fit_list``: distinct packed vectors ``x`` of one dimension; should be checkpointed."""
    n, sums, covariance = exact_covariance(fit_list, dimension)
    values, vectors = one_sided_jacobi(pivoted_cholesky(covariance, params.rank_tolerance), params.max_sweeps)
    kept = [i for i in range(min(params.components, len(values))) if values[i] > params.rank_tolerance * values[0]]
    return Whitening(n, sums, vectors[kept], values[kept], float(np.trace(covariance)))


# --- applying it ---------------------------------------------------------------


def _centred(rows: np.ndarray, model: Whitening) -> tuple[np.ndarray, np.ndarray]:
    """``n x - S`` as whole numbers (objects where longs would not do) and ``x - S/n``."""
    largest = max(abs(int(rows.min(initial=0))), abs(int(rows.max(initial=0))), 1)
    bound = model.n * largest + max(map(abs, model.sums), default=0)
    kind = "<i8" if bound < 1 << 63 else object
    apart = rows.astype(kind) * model.n - np.asarray(model.sums, kind)
    return apart, (apart / model.n).astype("f8")


def _deviations(apart: np.ndarray) -> list[int | None]:
    largest = max(abs(int(apart.min(initial=0))), abs(int(apart.max(initial=0))), 1)
    whole = apart if largest * largest * apart.shape[1] < 1 << 63 else apart.astype(object)
    return [int(v) if v < 1 << 63 else None for v in (whole * whole).sum(axis=1).tolist()]


def _whitened(centred: np.ndarray, model: Whitening) -> np.ndarray:
    return (centred @ model.components.T) / np.sqrt(model.variances)


def _identity_parts(model: Whitening):
    """Sums and sums of products of whitened vectors, one row per task."""
    schema = pa.schema([("n", pa.int64()), ("sums", pa.list_(pa.float64())), ("products", pa.list_(pa.float64()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, seen = len(model.variances), 0
        sums, products = np.zeros(k), np.zeros((k, k))
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                rows = _unpack(batch.slice(start, BATCH_ROWS).column(0).to_pylist(), model.dimension)
                white = _whitened(_centred(rows, model)[1], model)
                seen, sums, products = seen + len(rows), sums + white.sum(axis=0), products + white.T @ white
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([seen]), pa.array([sums.tolist()]), pa.array([products.ravel().tolist()])], schema=schema
            )

    return run


def identity_error(fit_list: DataFrame, model: Whitening) -> float:
    """Largest absolute entry of the whitened fit list's covariance minus the identity."""
    k = len(model.variances)
    parts = fit_list.select("x").mapInArrow(_identity_parts(model), "n bigint, sums array<double>, products array<double>")
    long = parts.select(F.posexplode(F.concat("sums", "products")).alias("place", "value"))
    rows = {r["place"]: r["value"] for r in long.groupBy("place").agg(F.sum("value").alias("value")).collect()}
    mean = np.asarray([rows[i] for i in range(k)]) / model.n
    products = np.asarray([rows[k + i] for i in range(k * k)]).reshape(k, k) / model.n
    return float(np.abs(products - np.outer(mean, mean) - np.eye(k)).max())


def _apply(model: Whitening, error: float):
    schema = pa.schema(
        [("vec_id", pa.int64()), ("component", pa.int32()), ("n", pa.int64()), ("deviation", pa.int64())]
        + [(c, pa.float64()) for c in ("whitened", "explained", "identity_error")]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, shares = len(model.variances), model.variances / model.trace
        for batch in batches:
            for start in range(0, batch.num_rows, BATCH_ROWS):
                part = batch.slice(start, BATCH_ROWS)
                rows = _unpack(part.column(1).to_pylist(), model.dimension)
                apart, centred = _centred(rows, model)
                count = len(rows)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(np.repeat(np.arange(count), k))),
                        pa.array(np.tile(np.arange(1, k + 1, dtype="<i4"), count)),
                        pa.array(np.full(count * k, model.n)),
                        pa.array([d for d in _deviations(apart) for _ in range(k)], pa.int64()),
                        pa.array(_whitened(centred, model).ravel()),
                        pa.array(np.tile(shares, count)),
                        pa.array(np.full(count * k, error)),
                    ],
                    schema=schema,
                )

    return run


def whiten(
    df: DataFrame,
    params: WhiteningParams = WhiteningParams(),
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """One row per usable vector and leading component: see the contract's columns in ``ROWS``."""
    rows = usable_vectors(df, params, id_column, vector_column)
    distinct = checkpointed(rows.select("dimension", "x").distinct())
    lengths = distinct.groupBy("dimension").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.desc("dimension"))
    first = lengths.first()
    if first is None:
        return df.sparkSession.createDataFrame([], ROWS)
    fit_list = distinct.where(F.col("dimension") == first["dimension"])
    model = fit(fit_list, first["dimension"], params)
    if not len(model.variances):
        return df.sparkSession.createDataFrame([], ROWS)
    error = identity_error(fit_list, model)
    used = rows.where(F.col("dimension") == first["dimension"]).select("id", "x")
    return used.mapInArrow(_apply(model, error), ROWS)
