"""Embedding whitening by Chebyshev-filtered subspace iteration.

Entries become whole numbers x = floor(64 c) + 1000000.  A pass over the table multiplies the centred covariance with
a block of vectors, X'(XQ)/n: every task adds up its own rows, the tasks' sums are added by dimension in a shuffle, and
only the block itself (dimensions x block, however many rows) reaches the driver and goes out again.  Centring is
exact: x - S/n is taken as (x - S div n) - (S mod n)/n, so the offset of a million costs no digits.

The block is the wanted components and ``GUARD`` more.  A Chebyshev polynomial of the covariance, built by its
three-term recurrence from such passes, damps the unwanted spectrum (from zero to the block's smallest Ritz value) and
lifts what lies above; then the block is made orthonormal by QR and rotated by a Rayleigh-Ritz step.  The wanted
components are done when they are certified: every residual |Vq - eq| is at most ``TOLERANCE`` times the largest
eigenvalue.  ``ROUNDS`` filters without a certificate raise an error, nothing uncertified is returned.

Defined cases: rows whose vector is null, or holds null or non-finite entries or ones beyond 2^40, are dropped, so are
rows whose vector has another length than the most frequent one (ties: the longer); repeated rows and null ids are
rows like any others; components without variance (an eigenvalue of at most 1e-12 of the trace) are left out, so
one row, equal rows or empty vectors give an empty result, as an empty table does; a deviation that does not fit a
long is null.  Extra columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderflow.llm.common import stored

SCALE, OFFSET = 64, 1_000_000
COMPONENTS = 32
GUARD = 16
DEGREE = 12
TOLERANCE = 1e-13
#: A filter lifts the largest eigenvalue at most this much more than the last wanted one, so no column drowns in it.
SPREAD = 1e4
#: A residual that has stopped falling is at the rounding of the passes if it is below this.
FLOOR = 1e-11
ROUNDS = 200
NO_VARIANCE = 1e-12
#: Entries beyond this count as non-finite: sums over all rows stay whole numbers of 64 bits.
LARGEST = float(1 << 40)


def vectors_of(table: DataFrame, column: str = "embedding", key: str = "vec_id") -> DataFrame:
    """(vec_id, x): the remaining rows, their entries as whole numbers."""
    fits = F.forall("c", lambda v: F.coalesce((v >= F.lit(-LARGEST)) & (v <= F.lit(LARGEST)), F.lit(False)))
    whole = F.transform("c", lambda v: F.floor(v * F.lit(float(SCALE))).cast("long") + F.lit(OFFSET))
    rows = table.select(F.col(key).alias("vec_id"), F.col(column).cast("array<double>").alias("c"))
    rows = stored(rows.where(F.col("c").isNotNull() & fits).select("vec_id", whole.alias("x")))
    most = rows.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    return rows.where(F.size("x") == F.lit(0 if most is None else most.d))


def _block(batch: pa.RecordBatch, place: int) -> np.ndarray:
    rows = batch.column(place)
    return rows.flatten().to_numpy().reshape(len(rows), -1)


@dataclass
class Centre:
    """Rows, whole-number sums by dimension, and the centred rows of a batch."""

    n: int
    sums: np.ndarray

    def centred(self, x: np.ndarray) -> np.ndarray:
        return (x - self.sums // self.n) - (self.sums % self.n) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        """Per row the sum of (n x - S)^2, exact."""
        whole, part = x - self.sums // self.n, self.sums % self.n
        largest = self.n * (int(np.abs(whole).max(initial=0)) + 1)
        if largest * largest * max(1, x.shape[1]) < 1 << 63:
            return ((self.n * whole - part) ** 2).sum(axis=1).tolist()
        exact = ((self.n * whole.astype(object) - part.astype(object)) ** 2).sum(axis=1)
        return [int(v) if v < 1 << 63 else None for v in exact]


def centre_of(vectors: DataFrame) -> Centre:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, None
        for batch in batches:
            if len(batch):
                x = _block(batch, 0)
                n, sums = n + len(x), x.sum(axis=0) if sums is None else sums + x.sum(axis=0)
        if n:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums), dtype=np.int32)), pa.array(np.full(len(sums), n)),
                                              pa.array(sums)], ["dim", "n", "s"])

    found = (vectors.select("x").mapInArrow(run, "dim int, n long, s long")
             .groupBy("dim").agg(F.sum("n").alias("n"), F.sum("s").alias("s")).orderBy("dim").collect())
    return Centre(found[0].n if found else 0, np.array([r.s for r in found], np.int64))


def _summed(rows: DataFrame, make, width: int) -> np.ndarray:
    """The sum over all rows of ``make(batch)``, a matrix of this width; added by line in the tasks, then in a shuffle."""
    names = [f"c{k}" for k in range(width)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            if len(batch):
                total = make(batch) if total is None else total + make(batch)
        if total is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(total), dtype=np.int32)), *map(pa.array, total.T.copy())],
                                             ["line", *names])

    sums = (rows.mapInArrow(run, "line int, " + ", ".join(f"{c} double" for c in names))
            .groupBy("line").agg(*[F.sum(c).alias(c) for c in names]).toArrow().sort_by("line"))
    return np.column_stack([sums.column(c).to_numpy() for c in names])


def multiplied(vectors: DataFrame, centre: Centre, block: np.ndarray) -> np.ndarray:
    """V Q for the centred covariance V, in one pass."""

    def make(batch: pa.RecordBatch) -> np.ndarray:
        x = centre.centred(_block(batch, 0))
        return x.T @ (x @ block)

    return _summed(vectors.select("x"), make, block.shape[1]) / centre.n


def trace_of(vectors: DataFrame, centre: Centre) -> float:
    def make(batch: pa.RecordBatch) -> np.ndarray:
        return np.array([[np.square(centre.centred(_block(batch, 0))).sum()]])

    return float(_summed(vectors.select("x"), make, 1)[0, 0]) / centre.n


def filtered(multiply, block: np.ndarray, cut: float, top: float, degree: int) -> np.ndarray:
    """The scaled Chebyshev polynomial of the covariance applied to a block: small on [0, cut], one near ``top``."""
    half = cut / 2
    scale = first = half / (top - half)
    before, now = block, (multiply(block) - half * block) * (scale / half)
    for _ in range(degree - 1):
        later = 1.0 / (2.0 / first - scale)
        before, now = now, 2.0 * later / half * (multiply(now) - half * now) - scale * later * before
        scale = later
    return now


def degree_for(cut: float, last: float, top: float, most: int) -> int:
    """The largest degree up to ``most`` whose polynomial keeps ``top`` and ``last`` within ``SPREAD`` of each other."""
    far, near = (np.arccosh(max(1.0, 2.0 * v / cut - 1.0)) for v in (top, last))
    return max(1, min(most, int(np.log(SPREAD) / max(far - near, 1e-12))))


def eigenpairs(multiply, dims: int, wanted: int, guard: int = GUARD, degree: int = DEGREE,
               rounds: int = ROUNDS) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest eigenvalues, falling, and their unit eigenvectors as columns; ``multiply`` gives V Q."""
    width = min(dims, wanted + guard)
    block = np.linalg.qr(np.random.default_rng(12).standard_normal((dims, width)))[0]
    best = np.inf
    for done in range(rounds + 1):
        image = multiply(block)
        small = block.T @ image
        values, turn = np.linalg.eigh((small + small.T) / 2)
        values, turn = values[::-1], turn[:, ::-1]
        block, image = block @ turn, image @ turn
        top = values[0]
        missed = np.linalg.norm(image - block * values, axis=0)[:wanted].max() if dims else 0.0
        if top <= 0 or missed <= TOLERANCE * top or (missed <= FLOOR * top and missed > best / 2):
            return values[:wanted], block[:, :wanted]
        best = min(best, missed)
        if done < rounds:
            # A block that spans everything needs no filter, only another rotation.
            cut = max(values[-1], 1e-9 * top)
            steps = degree_for(cut, values[wanted - 1], top, degree)
            raised = filtered(multiply, block, cut, top, steps) if width < dims else image
            # Columns are brought to one length first: damped ones are as good as any other for QR.
            size = np.linalg.norm(raised, axis=0)
            block = np.linalg.qr(raised / np.where(size > 0, size, 1.0))[0]
    raise RuntimeError(f"{wanted} components not certified after {rounds} filters: residual {missed / top:.1e} of the largest eigenvalue")


def whiten(table: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error): one row per remaining row and component."""
    vectors = vectors_of(table)
    centre = centre_of(vectors)
    key = vectors.schema["vec_id"].dataType.simpleString()
    schema = (f"vec_id {key}, component int, n long, deviation long, whitened double, explained double, "
              "identity_error double")
    trace = trace_of(vectors, centre) if centre.n and len(centre.sums) else 0.0
    if trace <= 0.0:
        return table.sparkSession.createDataFrame([], schema)
    values, axes = eigenpairs(lambda q: multiplied(vectors, centre, q), len(centre.sums), min(components, len(centre.sums)))
    kept = values > NO_VARIANCE * trace
    values, axes = values[kept], axes[:, kept]
    scaled = axes / np.sqrt(values)
    width = len(values)

    def products(batch: pa.RecordBatch) -> np.ndarray:
        w = centre.centred(_block(batch, 0)) @ scaled
        return np.vstack([w.T @ w, w.sum(axis=0)])

    found = _summed(vectors.select("x"), products, width) / centre.n
    error = float(np.abs(found[:-1] - np.outer(found[-1], found[-1]) - np.eye(width)).max())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not len(batch):
                continue
            x = _block(batch, 1)
            rows = pa.array(np.repeat(np.arange(len(x)), width))
            size = len(x) * width
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(rows), pa.array(np.tile(np.arange(1, width + 1, dtype=np.int32), len(x))),
                 pa.array(np.full(size, centre.n)), pa.array(centre.deviations(x), pa.int64()).take(rows),
                 pa.array((centre.centred(x) @ scaled).ravel()), pa.array(np.tile(values / trace, len(x))),
                 pa.array(np.full(size, error))],
                ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return vectors.select("vec_id", "x").mapInArrow(run, schema)
