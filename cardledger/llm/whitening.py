"""Embedding whitening by spectral divide and conquer.

Vectors become long integers, so the sums, the scatter about a whole-number centre and the
deviations are exact and the same in any order.  The covariance, a matrix of the dimensions,
is taken apart on the driver: the polar factor of the covariance minus a shift, found by the
QR-based dynamically weighted Halley iteration (QDWH), gives the projector on the space of
eigenvalues above the shift; its orthonormal basis splits the matrix in two, and each part is
split again until single components are left.  Means and leading components, two small
matrices, then travel to the tasks, which whiten every vector.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cardledger.llm.common import stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
#: Largest number of dimensions: the covariance is solved on the driver.
MAX_DIMENSIONS = 8192
#: Eigenvalues below this share of the largest are taken for zero; their components are left out.
RANK = 1e-12
#: Whole numbers up to this are exact as doubles.
EXACT = float(1 << 53)
#: Integers are kept within this; entries far beyond any embedding stop there.
LARGEST = 1 << 60


def finite_vectors(vector: Column) -> Column:
    """Whether a vector is not null and all its entries are finite numbers."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(vector.isNotNull() & (F.size(vector) > 0) & finite, F.lit(False))


# ---- spectral divide and conquer ----------------------------------------------


def polar_factor(a: np.ndarray, steps: int = 60) -> np.ndarray:
    """The unitary polar factor of a symmetric matrix: QDWH, each step by a QR decomposition."""
    n = len(a)
    scale = np.linalg.norm(a, "fro")
    if scale == 0:
        return np.eye(n)
    x = a / scale
    # A lower bound of the least singular value; too small a one only costs steps.
    low = max(1 / np.linalg.norm(np.linalg.inv(x), "fro"), 1e-16) if np.linalg.cond(x) < 1e15 else 1e-16
    low = min(low, 1.0)
    for _ in range(steps):
        square = low * low
        d = np.cbrt(4 * (1 - square) / (square * square))
        root = np.sqrt(1 + d)
        wa = root + 0.5 * np.sqrt(max(8 - 4 * d + 8 * (2 - square) / (square * root), 0.0))
        wb = (wa - 1) ** 2 / 4
        wc = wa + wb - 1
        q, _ = np.linalg.qr(np.vstack([np.sqrt(wc) * x, np.eye(n)]))
        fresh = (wb / wc) * x + (wa - wb / wc) / np.sqrt(wc) * (q[:n] @ q[n:].T)
        fresh = (fresh + fresh.T) / 2
        moved = np.linalg.norm(fresh - x, "fro")
        x = fresh
        low = min(low * (wa + wb * square) / (1 + wc * square), 1.0)
        if moved < 1e-14 * np.sqrt(n) and 1 - low < 1e-14:
            break
    return x


def _split(a: np.ndarray, shift: float) -> tuple[np.ndarray, np.ndarray] | None:
    """Orthonormal bases of the spaces above and below ``shift``; None where one is empty."""
    n = len(a)
    projector = (polar_factor(a - shift * np.eye(n)) + np.eye(n)) / 2
    above = int(round(np.trace(projector)))
    if not 0 < above < n:
        return None
    # The longest columns span the projector's range; a second pass brings the basis to full accuracy.
    start = projector[:, np.argsort(-np.einsum("ij,ij->j", projector, projector))]
    basis, diagonal = np.linalg.qr(start)
    order = np.argsort(-np.abs(np.diag(diagonal)), kind="stable")
    basis = np.linalg.qr(projector @ basis[:, order[:above]])[0]
    whole = np.linalg.qr(np.hstack([basis, np.eye(n) - basis @ basis.T]))[0]
    return whole[:, :above], whole[:, above:n]


def spectral_components(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, unit eigenvectors as columns) of a symmetric matrix, largest first."""
    scale = np.abs(a).max() if a.size else 0.0
    values, vectors = _conquer((a + a.T) / 2, scale)
    order = np.argsort(-values, kind="stable")
    return values[order], vectors[:, order]


def _conquer(a: np.ndarray, scale: float) -> tuple[np.ndarray, np.ndarray]:
    n = len(a)
    diagonal = np.diag(a).copy()
    off = a - np.diag(diagonal)
    if n == 1 or np.linalg.norm(off) <= 1e-15 * scale:
        return diagonal, np.eye(n)
    # The middle of the trace's mean and median splits most spectra; ends and gaps follow if it does not.
    mean = diagonal.mean()
    # The spread of the eigenvalues, by the traces of the matrix and its square.
    spread = np.sqrt(max(np.sum(a * a) / n - mean * mean, 0.0))
    for shift in (np.median(diagonal), mean, mean + spread / 2, mean - spread / 2, mean + spread / 8, mean - spread / 8):
        bases = _split(a, float(shift))
        if bases is None:
            continue
        above, below = bases
        if np.linalg.norm(above.T @ a @ below) > 1e-11 * scale:
            continue  # an eigenvalue lies at the shift: take another
        values, vectors = [], []
        for basis in bases:
            part = basis.T @ a @ basis
            found, inner = _conquer((part + part.T) / 2, scale)
            values.append(found)
            vectors.append(basis @ inner)
        return np.concatenate(values), np.hstack(vectors)
    return _rotate(a)


def _rotate(a: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Jacobi rotations: for the small rest whose eigenvalues lie too close for a shift between them."""
    a, n = a.copy(), len(a)
    vectors = np.eye(n)
    for _ in range(60):
        off = a - np.diag(np.diag(a))
        if np.linalg.norm(off) <= 1e-16 * max(np.abs(np.diag(a)).max(), 1e-300):
            break
        for p in range(n - 1):
            for q in range(p + 1, n):
                if a[p, q] == 0:
                    continue
                theta = (a[q, q] - a[p, p]) / (2 * a[p, q])
                t = (1.0 if theta >= 0 else -1.0) / (abs(theta) + np.hypot(theta, 1.0))
                c = 1 / np.hypot(t, 1.0)
                turn = np.array([[c, t * c], [-t * c, c]])
                a[:, [p, q]] = a[:, [p, q]] @ turn
                a[[p, q], :] = turn.T @ a[[p, q], :]
                vectors[:, [p, q]] = vectors[:, [p, q]] @ turn
    return np.diag(a).copy(), vectors


def leading_components(covariance: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray]:
    """The ``count`` largest eigenvalues above zero and their components, polished to double precision."""
    values, vectors = spectral_components(covariance)
    if not len(values) or values[0] <= 0:
        return np.zeros(0), np.zeros((len(covariance), 0))
    # One Rayleigh-Ritz step on the whole basis takes out what the recursion's roundings added up to.
    vectors = np.linalg.qr(vectors)[0]
    inner = vectors.T @ covariance @ vectors
    gaps = np.subtract.outer(np.diag(inner), np.diag(inner)).T
    close = np.abs(gaps) <= 1e-6 * values[0]
    mix = np.where(close, 0.0, inner / np.where(close, 1.0, gaps))
    np.fill_diagonal(mix, 0.0)
    vectors = np.linalg.qr(vectors @ (np.eye(len(mix)) + mix))[0]
    values = np.einsum("ij,ij->j", vectors, covariance @ vectors)
    order = np.argsort(-values, kind="stable")
    kept = [i for i in order[:count] if values[i] > RANK * values[order[0]]]
    return values[kept], vectors[:, kept]


# ---- integers -------------------------------------------------------------------


def integers(vectors: np.ndarray) -> np.ndarray:
    """floor(1024 c) + 100000 as long."""
    scaled = np.floor(vectors * SCALE)
    return np.clip(scaled, -float(LARGEST), float(LARGEST)).astype(np.int64) + SHIFT


def exact_sum(parts: Iterator[np.ndarray]) -> np.ndarray | int:
    """The sum of integer arrays: longs as long as they surely fit, Python's integers beyond."""
    total, bound = 0, 0.0
    for part in parts:
        bound += float(np.abs(part).max()) if part.size else 0.0
        if bound >= 2.0**62 and (not isinstance(total, np.ndarray) or total.dtype != object):
            total = np.asarray(total).astype(object)
        total = total + (part.astype(object) if bound >= 2.0**62 else part)
    return total


def scatter(y: np.ndarray) -> np.ndarray:
    """The products of all dimensions summed over the rows, exact."""
    top = float(np.abs(y).max()) if y.size else 0.0
    if top * top * max(len(y), 1) < EXACT:
        return (y.astype(np.float64).T @ y.astype(np.float64)).astype(np.int64)
    wide = y.astype(object)
    return wide.T @ wide


def column_sums(x: np.ndarray) -> np.ndarray:
    top = float(np.abs(x).max()) if x.size else 0.0
    return (x if top * max(len(x), 1) < 2.0**62 else x.astype(object)).sum(axis=0)


def _matrix(column: pa.Array, size: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(-1, size)


def whiten(
    vectors: DataFrame,
    components: int = COMPONENTS,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
) -> DataFrame:
    """Per vector and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Vectors that are null or hold an entry that is null or no finite number are dropped, as are
    empty ones and, where lengths differ, all but the most frequent length (of equally frequent
    ones the longest).  Repeated rows and null ids count like all others.  Components without
    variance have no rows, so a table of equal vectors, or of none, gives none.  ``deviation`` is
    null where it is beyond a long.  Only the named columns are read.
    """
    spark = vectors.sparkSession
    points = vectors.filter(finite_vectors(F.col(vector_column))).select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("vector")
    )
    schema = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    sizes = points.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if sizes is None:
        return spark.createDataFrame([], schema)
    size, n = int(sizes["size"]), int(sizes["count"])
    if size > MAX_DIMENSIONS:
        raise ValueError(f"vectors of more than {MAX_DIMENSIONS} dimensions")
    points = points.filter(F.size("vector") == size)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = exact_sum(column_sums(integers(_matrix(batch.column(0), size))) for batch in batches)
        if isinstance(total, np.ndarray):
            yield pa.RecordBatch.from_pydict({"i": pa.array(range(size), pa.int32()), "s": pa.array([str(x) for x in total.tolist()])})

    # Whole numbers of any length: as text from the tasks, exact decimals in the sum.
    sums = points.select("vector").mapInArrow(add_up, "i int, s string")
    sums = sums.groupBy("i").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s")).collect()
    total = [0] * size
    for r in sums:
        total[r["i"]] = int(r["s"])
    centre = np.array([(2 * s + n) // (2 * n) for s in total], dtype=np.int64)
    rest = [s - n * int(m) for s, m in zip(total, centre, strict=True)]  # of a sum beside n times the centre

    def multiply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = exact_sum(scatter(integers(_matrix(batch.column(0), size)) - centre) for batch in batches)
        for i, row in enumerate(total.tolist() if isinstance(total, np.ndarray) else []):
            yield pa.RecordBatch.from_pydict(
                {
                    "i": pa.array([i] * (i + 1), pa.int32()),
                    "j": pa.array(range(i + 1), pa.int32()),
                    "s": pa.array([str(x) for x in row[: i + 1]]),
                }
            )

    products = points.select("vector").mapInArrow(multiply, "i int, j int, s string")
    products = products.groupBy("i", "j").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"))
    covariance = np.zeros((size, size))
    for r in products.collect():  # half the square of the dimensions, whatever the rows are
        i, j = r["i"], r["j"]
        # Exact integers up to the last division: sum of products less the product of the sums' rests.
        covariance[i, j] = covariance[j, i] = (n * int(r["s"]) - rest[i] * rest[j]) / (n * n)
    values, basis = leading_components(covariance, components)
    trace = float(np.trace(covariance))
    if not len(values):
        return spark.createDataFrame([], schema)
    offset = np.array([r / n for r in rest])
    projection = basis / np.sqrt(values)
    explained = values / trace
    count = len(values)

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = integers(_matrix(batch.column(1), size)) - centre
            white = (y - offset) @ projection
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(_deviations(y, n, rest), pa.int64()),
                    pa.ListArray.from_arrays(np.arange(0, white.size + 1, count, dtype=np.int32), white.ravel()),
                ],
                names=["vec_id", "deviation", "white"],
            )

    white = stored(points.mapInArrow(project, "vec_id bigint, deviation bigint, white array<double>"), "white")
    w = [F.col("white")[i] for i in range(count)]
    means = white.agg(*[F.avg(x).alias(f"m{i}") for i, x in enumerate(w)]).first()
    pairs = [(i, j) for i in range(count) for j in range(i + 1)]
    moments = white.agg(*[F.avg((w[i] - F.lit(means[i])) * (w[j] - F.lit(means[j]))).alias(f"c{i}_{j}") for i, j in pairs]).first()
    error = max(abs(moments[k] - (i == j)) for k, (i, j) in enumerate(pairs))
    share = F.array(*[F.lit(float(x)) for x in explained])
    return white.select("vec_id", "deviation", F.posexplode("white").alias("place", "whitened")).select(
        "vec_id",
        (F.col("place") + 1).cast("int").alias("component"),
        F.lit(n).cast("long").alias("n"),
        "deviation",
        "whitened",
        share[F.col("place")].alias("explained"),
        F.lit(float(error)).alias("identity_error"),
    )


def _deviations(y: np.ndarray, n: int, rest: list[int]) -> list[int | None]:
    """The sum over dimensions of (n y - rest) squared, per row; None beyond a long."""
    top = (float(np.abs(y).max()) if y.size else 0.0) * n + max(map(abs, rest))
    if top * top * y.shape[1] < 2.0**62:
        from_mean = y * n - np.array(rest, dtype=np.int64)
        return np.einsum("ij,ij->i", from_mean, from_mean).tolist()
    found = []
    for row in y.tolist():
        value = sum((n * x - r) ** 2 for x, r in zip(row, rest, strict=True))
        found.append(value if value < 1 << 63 else None)
    return found
