"""Embedding whitening by Chebyshev-filtered subspace iteration.

The leading eigenvectors of the vectors' covariance V are found without ever forming V. A block of random directions
is multiplied by V through passes over the vectors: each task centres its rows and adds up its part of Xc'(Xc Q), and
Spark sums the parts by row of the product. A cycle applies a Chebyshev polynomial of V to the block, by its three-term
recurrence, one pass a degree; the polynomial is small on [0, b], where b is the block's smallest Ritz value, and grows
steeply above it, which damps the unwanted spectrum. QR and Rayleigh-Ritz follow. When the residuals of the wanted
pairs certify them, one more cycle takes the directions down to the rounding error.

What reaches the driver is a matrix of dimensions by block columns, whatever the number of rows is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from visitmart.llm.common import materialize

#: Elements of the vectors that a task turns into doubles at once.
CHUNK = 2_000_000


def quantized(embeddings: DataFrame, id_column: str, vector_column: str, scale: int) -> DataFrame:
    """(vec_id, x): the sound rows, with floor(scale * entry) of each entry; beyond 64 bits it stays at their limits."""
    vector = F.col(vector_column).cast("array<double>")
    sound = F.forall(vector, lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < float("inf")), F.lit(False)))
    rows = embeddings.where(F.coalesce(sound & (F.size(vector) > 0), F.lit(False)))
    return rows.select(F.col(f"`{id_column}`").alias("vec_id"), F.transform(vector, lambda c: F.floor(c * float(scale))).alias("x"))


def matrices(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(first row, batch, long matrix) of parts of at most ``CHUNK`` elements."""
    step = max(1, CHUNK // dim)
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            part = batch.slice(at, step)
            yield at, part, part.column("x").flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)


def _largest(x: np.ndarray) -> int:
    return max(-int(x.min()), int(x.max()))


def exact_sums(fit: DataFrame, dim: int) -> tuple[int, list[int]]:
    """How many vectors there are, and the exact sum of each dimension."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = 0, np.zeros(dim, object)
        for _, _, x in matrices(batches, dim):
            n += len(x)
            total += (x if _largest(x) * len(x) < 1 << 62 else x.astype(object)).sum(0).astype(object)
        if n:
            sums = pa.array([Decimal(int(s)) for s in total], pa.decimal128(38, 0))
            yield pa.RecordBatch.from_arrays([pa.array(range(dim), pa.int32()), pa.array([n] * dim, pa.int64()), sums], ["d", "n", "s"])

    found = fit.mapInArrow(run, "d int, n long, s decimal(38,0)").groupBy("d").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).collect()
    return found[0]["n"], [int(r["s"]) for r in sorted(found, key=lambda r: r["d"])]


def summed(fit: DataFrame, dim: int, mean: np.ndarray, rows: int, columns: int, part: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
    """The sum over all vectors of ``part(centred rows)``, a matrix of ``rows`` by ``columns``: one pass."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_rows = np.zeros((rows, columns)), False
        for _, _, x in matrices(batches, dim):
            total += part(x - mean)
            any_rows = True
        if any_rows:
            names = ["d", *[f"c{i}" for i in range(columns)]]
            yield pa.RecordBatch.from_arrays([pa.array(range(rows), pa.int32()), *[pa.array(c) for c in total.T]], names)

    schema = ", ".join(["d int", *[f"c{i} double" for i in range(columns)]])
    found = fit.mapInArrow(run, schema).groupBy("d").agg(*[F.sum(f"c{i}") for i in range(columns)]).collect()
    return np.array([list(r)[1:] for r in sorted(found, key=lambda r: r["d"])])


def filtered(times_v: Callable[[np.ndarray], np.ndarray], q: np.ndarray, vq: np.ndarray, low: float, high: float, top: float, degree: int) -> np.ndarray:
    """The Chebyshev polynomial for [low, high] of V times ``q``, scaled to about 1 at ``top``; ``vq`` is V times ``q``."""
    centre, half = (low + high) / 2, (high - low) / 2
    sigma = half / (top - centre)
    tau, before, now = 2 / sigma, q, (vq - centre * q) * (sigma / half)
    for _ in range(degree - 1):
        after = 1 / (tau - sigma)
        before, now = now, (times_v(now) - centre * now) * (2 * after / half) - sigma * after * before
        sigma = after
    return now


def leading(
    times_v: Callable[[np.ndarray], np.ndarray], dim: int, wanted: int, block: int = 32, degree: int = 16, tolerance: float = 1e-12, max_cycles: int = 60, seed: int = 13,
) -> tuple[np.ndarray, np.ndarray]:
    """(eigenvalues, eigenvectors as columns) of the ``wanted`` leading pairs of a positive semidefinite V.

    Certified: of each pair the residual |V q - e q| is at most ``tolerance`` times the largest eigenvalue. A block
    as wide as V gives its pairs at once. Without a certificate after ``max_cycles`` cycles it is an error.
    """
    width, wanted = min(dim, max(block, 2 * wanted)), min(wanted, dim)
    q = np.linalg.qr(np.random.default_rng(seed).standard_normal((dim, width)))[0]
    certified = False
    for _ in range(max_cycles):
        vq = times_v(q)
        h = q.T @ vq
        values, turn = np.linalg.eigh((h + h.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        q, vq = q @ turn, vq @ turn
        worst = np.linalg.norm(vq - q * values, axis=0)[:wanted].max()
        if worst <= tolerance * max(values[0], 0.0) or values[0] <= 0:
            if certified or width == dim or values[0] <= 0:
                return values[:wanted], q[:, :wanted]
            certified = True
        high = max(values[-1], values[0] * 1e-12)
        if values[0] <= high * (1 + 1e-12):  # the block sees one eigenvalue only: any basis of it will do
            high = values[0] * 0.5
        q = np.linalg.qr(filtered(times_v, q, vq, 0.0, high, values[0], degree))[0]
    raise RuntimeError(f"no certificate after {max_cycles} cycles: residual {worst:.3g} at eigenvalue {values[0]:.3g}")


def whiten(
    embeddings: DataFrame, components: int = 4, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = 256,
    block: int = 32, degree: int = 16, tolerance: float = 1e-12, max_lengths: int = 16,
) -> DataFrame:
    """(vec_id, component, n, deviation decimal, whitened, explained, identity_error) of each row and leading component.

    Entries become whole numbers x = floor(scale * entry). Mean and covariance (divisor n) are those of the distinct x;
    ``deviation`` is the exact sum of (n x - S)^2 over the dimensions, null beyond 38 digits; ``whitened`` the projection
    of x - S/n on the component, over the root of its eigenvalue; ``explained`` the eigenvalue's share of the trace;
    ``identity_error`` the largest absolute entry of the whitened values' covariance less the identity.

    Rows whose vector is null, empty, or holds null or non-finite entries go. Vectors of each length are whitened among
    themselves; more than ``max_lengths`` lengths are an error. Repeated rows and ids, and null ids, stay, one result
    for each row; a vector that occurs often counts once in the fit. Components whose eigenvalue is zero but for
    rounding have no scale and no rows, so that a table of equal vectors gives none. Other columns are not read; an
    empty table gives an empty result.
    """
    rows = materialize(quantized(embeddings, id_column, vector_column, scale), "quantized")
    kind = rows.schema["vec_id"].dataType.simpleString()
    distinct = materialize(rows.select("x").distinct(), "distinct")
    lengths = [r[0] for r in distinct.select(F.size("x").alias("dim")).distinct().limit(max_lengths + 1).collect()]
    if len(lengths) > max_lengths:
        raise ValueError(f"vectors of more than {max_lengths} lengths")
    schema = f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    out = rows.sparkSession.createDataFrame([], schema)
    for dim in sorted(lengths):
        own = rows if len(lengths) == 1 else rows.where(F.size("x") == dim)
        fit = (distinct if len(lengths) == 1 else distinct.where(F.size("x") == dim)).persist(StorageLevel.MEMORY_AND_DISK)
        try:
            run = _projection(fit, dim, components, block, degree, tolerance, rows.schema["vec_id"].name)
        finally:
            fit.unpersist()
        out = out.unionByName(own.mapInArrow(run, schema))
    return out


def _projection(fit: DataFrame, dim: int, components: int, block: int, degree: int, tolerance: float, name: str):
    """What a task does with its rows, once the components of ``fit`` are known."""
    n, sums = exact_sums(fit, dim)
    mean = np.array([s / n for s in sums])

    def times_v(q: np.ndarray) -> np.ndarray:
        return summed(fit, dim, mean, dim, q.shape[1], lambda x: x.T @ (x @ q)) / n

    trace = summed(fit, dim, mean, dim, 1, lambda x: np.einsum("ij,ij->j", x, x)[:, None]).sum() / n
    values, q = leading(times_v, dim, components, block, degree, tolerance) if trace > 0 else (np.zeros(0), np.zeros((dim, 0)))
    real = values > dim * np.finfo(float).eps * max(trace, 0.0)
    values, q = values[real], q[:, real]
    q = q * np.where(q[np.abs(q).argmax(0), np.arange(len(values))] < 0, -1.0, 1.0)  # the largest entry is positive
    scaled, c = q / np.sqrt(values), len(values)
    error = 0.0
    if c:
        def moments(x: np.ndarray) -> np.ndarray:
            w = x @ scaled
            return np.concatenate([w.T @ w, w.sum(0, keepdims=True)])

        got = summed(fit, dim, mean, c + 1, c, moments) / n
        error = float(np.abs(got[:c] - np.outer(got[c], got[c]) - np.eye(c)).max())
    share, far = values / trace if trace > 0 else values, max(map(abs, sums))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, part, x in matrices(batches, dim):
            m, most = len(x), n * _largest(x) + far
            small = dim * most * most < 1 << 63
            d = (x if small else x.astype(object)) * n - np.array(sums, np.int64 if small else object)
            deviation = [Decimal(int(v)) if v < 10**38 else None for v in (d * d).sum(1)]
            each = np.repeat(np.arange(m), c)
            yield pa.RecordBatch.from_arrays(
                [
                    part.column(name).take(pa.array(each)), pa.array(np.tile(np.arange(1, c + 1, dtype=np.int32), m)), pa.array(np.full(m * c, n, np.int64)),
                    pa.array(deviation, pa.decimal128(38, 0)).take(pa.array(each)), pa.array(((x - mean) @ scaled).ravel()), pa.array(np.tile(share, m)), pa.array(np.full(m * c, error)),
                ],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"],
            )

    return run
