"""Whitening of vectors: principal components by FEAST contour integration over an exact covariance."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from staffcast.llm.common import read_table
from staffcast.staging import stage

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 16
LARGEST = 1 << 60  # numbers stay at this limit
NODES = 8  # quadrature nodes on the upper half of a contour
SLICE = 8  # eigenvalues wanted in one interval
ROUNDS = 60
TOLERANCE = 1e-13  # residual of an eigenpair, as a share of the largest eigenvalue
SMALLEST = 1e-12  # eigenvalues below this share of the trace are rounding and no component


# ---- numbers of the rows ---------------------------------------------------------------


def whole_numbers(vector: Column) -> Column:
    """Each entry as ``floor(64 * c) + 1000000`` (within 2**60); null if the vector or an entry is null or not finite."""
    finite = F.forall(vector, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    limit = F.lit(float(LARGEST))
    number = lambda c: F.floor(F.greatest(F.least(c.cast("double") * SCALE, limit), -limit)) + SHIFT
    return F.when(vector.isNotNull() & finite, F.transform(vector, lambda c: number(c).cast("long")))


def _block(column: pa.ListArray, dims: int) -> np.ndarray:
    """Lists of numbers as a matrix; what a shorter one lacks is the number of a zero."""
    lengths = np.diff(np.asarray(column.offsets))
    out = np.full((len(column), dims), SHIFT, np.int64)
    out[np.arange(dims) < lengths[:, None]] = np.asarray(column.flatten())
    return out


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """``n * x - S``, in 64 bits where its squares fit and as Python numbers elsewhere."""
    top = max(abs(int(x.max(initial=0))), abs(int(x.min(initial=0))))
    if n * top + max((abs(s) for s in sums), default=0) < 1 << 62:
        exact = n * x - np.array(sums, np.int64)
        if max(1, x.shape[1]) * int(np.abs(exact).max(initial=0)) ** 2 < 1 << 63:
            return exact
    return n * x.astype(object) - np.array(sums, object)


def _sums(batches: Iterator[pa.RecordBatch], dims: int) -> Iterator[pa.RecordBatch]:
    """Exact sums of each dimension over a task's rows."""
    total, n = [0] * dims, 0
    for batch in batches:
        x = _block(batch.column("x"), dims)
        n += len(x)
        # High and low halves are summed apart, so that no sum leaves 64 bits.
        high, low = (x >> 30).sum(0), (x & ((1 << 30) - 1)).sum(0)
        total = [t + (int(h) << 30) + int(lo) for t, h, lo in zip(total, high, low, strict=True)]
    if n:
        kind = pa.decimal128(38, 0)
        yield pa.RecordBatch.from_arrays([pa.array(range(-1, dims), pa.int32()), pa.array([n, *total], kind)], names=["i", "s"])


def _products(batches: Iterator[pa.RecordBatch], dims: int, n: int, sums: list[int], basis: np.ndarray | None) -> Iterator[pa.RecordBatch]:
    """Sums of products of a task's centred rows, or of what ``basis`` makes of them: one row a dimension."""
    width = dims if basis is None else basis.shape[1]
    total, seen = np.zeros((width, width)), False
    for batch in batches:
        seen = True
        c = _deviations(_block(batch.column("x"), dims), n, sums).astype(float) / n
        c = c if basis is None else c @ basis
        total += c.T @ c
    if seen:
        yield pa.RecordBatch.from_arrays([pa.array(range(width), pa.int32()), pa.array(list(total / n), pa.list_(pa.float64()))], names=["i", "v"])


def _gather(parts: DataFrame, width: int) -> np.ndarray:
    """The sum of all tasks' matrices; Spark adds them, so that the driver gets ``width`` squared numbers."""
    cells = parts.select("i", F.posexplode("v").alias("j", "v")).groupBy("i", "j").agg(F.sum("v").alias("v"))
    out = np.zeros((width, width))
    table = cells.toArrow()
    out[np.asarray(table["i"]), np.asarray(table["j"])] = np.asarray(table["v"])
    return (out + out.T) / 2


# ---- eigenvalues ------------------------------------------------------------------------


def count_above(matrix: np.ndarray, value: float) -> int:
    """How many eigenvalues of a symmetric matrix exceed ``value``: the positive pivots of its shifted LDL' factorization.

    By Sylvester's law of inertia the pivots have the signs of the eigenvalues. Pivots are single entries or 2 x 2 blocks, the
    largest that are left, so the factors stay bounded.
    """
    a = matrix - value * np.eye(len(matrix))
    positive = 0
    while len(a):
        d = np.abs(np.diag(a))
        off = np.abs(a - np.diag(np.diag(a)))
        r = int(d.argmax())
        p, q = divmod(int(off.argmax()), len(a))
        if d[r] >= (1 + 17**0.5) / 8 * off[p, q]:
            if d[r] == 0:
                break
            chosen = [r]
            positive += a[r, r] > 0
        else:
            chosen = [p, q]
            positive += 1  # the larger entry beside the diagonal makes one pivot positive and one negative
        rest = np.delete(np.arange(len(a)), chosen)
        block, side = a[np.ix_(chosen, chosen)], a[np.ix_(rest, chosen)]
        a = a[np.ix_(rest, rest)] - side @ np.linalg.solve(block, side.T)
    return int(positive)


def _filtered(matrix: np.ndarray, basis: np.ndarray, low: float, high: float) -> np.ndarray:
    """The contour integral of the resolvent on a circle through ``low`` and ``high``, applied to ``basis``: a projection on the
    eigenvectors between them. Matrix and basis are real, so the lower half of the circle adds the conjugate."""
    middle, radius = (low + high) / 2, (high - low) / 2
    nodes, shares = np.polynomial.legendre.leggauss(NODES)
    out = np.zeros_like(basis)
    for node, share in zip(nodes, shares, strict=True):
        way = radius * np.exp(0.5j * np.pi * (1 + node))
        solved = np.linalg.solve((middle + way) * np.eye(len(matrix)) - matrix, basis)
        out += (share / 2 * way * solved).real
    return out


def feast(matrix: np.ndarray, low: float, high: float, wanted: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` eigenpairs with eigenvalues in (``low``, ``high``], as many as the inertia counts there.

    A random subspace is filtered by the contour integral, made orthonormal, and Rayleigh-Ritz extracts values and vectors,
    until all residuals are small. Pairs that are missed or don't settle make the subspace larger, up to all dimensions.
    """
    d, random = len(matrix), np.random.default_rng(seed)
    size, reach = min(d, wanted + wanted // 2 + 4), max(abs(low), abs(high))
    while True:
        basis = random.standard_normal((d, size))
        for _ in range(ROUNDS):
            basis, _ = np.linalg.qr(_filtered(matrix, basis, low, high))
            values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
            basis = basis @ inner
            residual = np.linalg.norm(matrix @ basis - basis * values, axis=0)
            found = (values > low) & (values <= high) & (residual <= TOLERANCE * reach * d**0.5)
            if found.sum() == wanted:
                return values[found], basis[:, found]
        if size == d:
            raise ArithmeticError(f"{int(found.sum())} of {wanted} eigenpairs between {low} and {high} settled")
        size = min(d, 2 * size)


def slices(matrix: np.ndarray, components: int) -> list[tuple[float, float, int]]:
    """Intervals (low, high, number of eigenvalues) that hold the largest ``components`` eigenvalues, found by inertia alone."""
    trace = float(np.trace(matrix))
    top = trace * (1 + 1e-9)
    floor = trace * SMALLEST
    above = count_above(matrix, floor)
    wanted = min(components, above)

    def edge(rank: int, high: float) -> tuple[float, int]:
        """A value with ``rank`` eigenvalues above it, or a few more where some lie too close to be parted."""
        low, n_low = floor, above
        while n_low > rank and high - low > 1e-3 * high:
            middle = (low + high) / 2
            n = count_above(matrix, middle)
            low, high, n_low = (middle, high, n) if n >= rank else (low, middle, n_low)
        # An eigenvalue on the edge itself could be counted on either side.
        while low > floor and count_above(matrix, low * (1 - 1e-8)) != count_above(matrix, low * (1 + 1e-8)):
            low *= 1 - 1e-4
        return low, count_above(matrix, low)

    out, done, high = [], 0, top
    while done < wanted:
        low, n = edge(min(wanted, done + SLICE), high)
        out.append((low, high, n - done))
        done, high = n, low
    return out


def _solve(batches: Iterator[pa.RecordBatch], matrix: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in batch.to_pylist():
            values, vectors = feast(matrix, row["low"], row["high"], row["wanted"])
            yield pa.RecordBatch.from_arrays([pa.array(values), pa.array(list(vectors.T), pa.list_(pa.float64()))], names=["value", "vector"])


def largest_eigenpairs(spark: SparkSession, matrix: np.ndarray, components: int) -> tuple[np.ndarray, np.ndarray]:
    """The largest eigenvalues, falling, and their unit vectors as columns; each interval of the spectrum is a task's work.

    A last Rayleigh-Ritz step over the vectors of all intervals makes them orthogonal to each other too.
    """
    cuts = slices(matrix, components) if len(matrix) and np.trace(matrix) > 0 else []
    if not cuts:
        return np.zeros(0), np.zeros((len(matrix), 0))
    rows = spark.createDataFrame(cuts, "low double, high double, wanted int").repartition(len(cuts))
    found = rows.mapInArrow(lambda b: _solve(b, matrix), "value double, vector array<double>").toArrow()
    basis, _ = np.linalg.qr(np.array(found["vector"].to_pylist()).T)
    values, inner = np.linalg.eigh(basis.T @ matrix @ basis)
    order = np.argsort(-values)[:components]
    return values[order], basis @ inner[:, order]


# ---- whitening --------------------------------------------------------------------------


def _whitened(batches: Iterator[pa.RecordBatch], dims: int, n: int, sums: list[int], basis: np.ndarray) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        exact = _deviations(_block(batch.column("x"), dims), n, sums)
        squares = [min(int(s), (1 << 63) - 1) for s in (exact * exact).sum(1)]
        values = exact.astype(float) / n @ basis
        columns = [batch.column("kept"), pa.array(squares, pa.int64()), pa.array(list(values), pa.list_(pa.float64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["kept", "deviation", "whitened"])


def whiten(vectors: DataFrame, vector_column: str, components: int = COMPONENTS) -> tuple[DataFrame, dict]:
    """Columns of ``vectors`` as a struct ``kept`` with ``deviation`` and ``whitened``, and the fitted model.

    Entries become whole numbers x (:func:`whole_numbers`). The fit list is each distinct x vector once: ``n`` of them, sums S.
    ``whitened`` holds the first principal components of a row's x - S/n, each over the root of its eigenvalue, by falling
    eigenvalue; ``deviation`` is the sum of (n*x - S) squared, exact, at most 2**63 - 1. The model holds ``n``, ``sums``,
    ``values`` (eigenvalues of the covariance with divisor n), ``vectors``, ``explained`` (shares of the trace) and ``identity_error``:
    the largest entry, without sign, of the whitened fit list's covariance less the identity, measured in a pass of its own.

    Rows whose vector is null or holds a null or non-finite entry are left out. A shorter vector counts as filled with zeros.
    Repeated rows are each answered and fitted once. Fewer components come out where the covariance has a lower rank, none for
    equal vectors or an empty table. Columns of any name are kept.

    The driver and the tasks hold a matrix of dimensions squared, whatever the number of rows.
    """
    spark = vectors.sparkSession
    kept = F.struct(*[F.col(f"`{c}`") for c in vectors.columns]).alias("kept")
    rows = stage(vectors.select(kept, whole_numbers(F.col(f"`{vector_column}`")).alias("x")).where("x IS NOT NULL"), "vectors")
    fit = stage(rows.select("x").distinct(), "fit-list")
    dims = fit.agg(F.max(F.size("x"))).first()[0] or 0
    sums = fit.mapInArrow(lambda b: _sums(b, dims), "i int, s decimal(38,0)").groupBy("i").agg(F.sum("s").alias("s")).collect()
    total = {r.i: int(r.s) for r in sums}
    n, sums = total.pop(-1, 0), [total[i] for i in range(dims) if i in total]
    products = lambda basis: fit.mapInArrow(lambda b: _products(b, dims, n, sums, basis), "i int, v array<double>")
    covariance = _gather(products(None), dims) if n else np.zeros((0, 0))
    values, found = largest_eigenpairs(spark, covariance, components)
    basis = found / np.sqrt(values)
    width = len(values)
    error = float(np.abs(_gather(products(basis), width) - np.eye(width)).max()) if width else 0.0
    model = {
        "n": n, "sums": sums, "values": values.tolist(), "vectors": found, "identity_error": error,
        "explained": [float(v / np.trace(covariance)) for v in values],
    }
    schema = T.StructType([rows.schema["kept"], T.StructField("deviation", T.LongType()), T.StructField("whitened", T.ArrayType(T.DoubleType()))])
    return rows.mapInArrow(lambda b: _whitened(b, dims, n, sums, basis), schema), model


def op12_feast(spark, sf_dir: str) -> DataFrame:
    rows, model = whiten(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "embedding")
    share = F.array(*[F.lit(e) for e in model["explained"]]).cast("array<double>")
    return rows.select("kept.vec_id", "deviation", F.posexplode("whitened").alias("at", "whitened")).select(
        "vec_id", (F.col("at") + 1).cast("int").alias("component"), F.lit(model["n"]).cast("long").alias("n"), "deviation", "whitened",
        F.get(share, "at").alias("explained"), F.lit(model["identity_error"]).alias("identity_error"),
    )
