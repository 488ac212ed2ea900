"""Embedding whitening by Golub-Kahan-Lanczos bidiagonalisation.

The rows are whole numbers x = floor(scale * c) + shift. A, the matrix of the
centred rows x - S/n, is never built: each step is one distributed pass in
which every task takes its rows' part of the product Av, and from it its part
of the transposed product A'(Av). Left vectors stay with the rows: u = Ag for
a short vector g that the driver keeps, so tasks make all earlier entries of u
anew from their rows and nothing of the length of the table is stored. The
pass also brings U'(Av), which orthogonalises the new left vector against all
earlier ones; the right vectors are orthogonalised against all earlier ones on
the driver, twice. The singular value decomposition of the small bidiagonal
matrix gives the components (right vectors) and deviations (singular values).

Steps end when the wanted triplets have converged, or when the bidiagonal
matrix holds all of A (no dimension or no variance is left). One starting
vector sees one direction of a repeated singular value only, so a second run,
orthogonal to what was found, must then find nothing larger than the smallest
wanted value; what it finds is taken in and the check repeated.

Centring is exact: n * x - S in whole numbers, divided by n. Vectors of
another length are another table: each length is fitted by itself. Per step
the driver gets two short vectors and a number, and tasks get the short
vectors found so far (at most one for each dimension).

Defined cases: rows whose vector is null or empty or holds null or non-finite
entries take no part; a null id is an id; repeated rows count and stay
repeated; a component without variance (under 1e-13 of all; rank below ``components``,
one row, equal rows) cannot be scaled and is not returned, so equal rows give no row;
an empty table gives an empty result; other columns are ignored. An
ArithmeticError is raised where n * x could leave 64 bits. ``deviation`` is
decimal(38,0), exact beyond 64 bits as well.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quayside.llm.common import staged

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
TOLERANCE = 1e-14  # residual of a converged triplet, relative to the largest singular value
NOTHING = 1e-12  # what is left of a direction, relative to the largest norm, when it is only rounding
LEFT_OVER = 1e-14  # share of the squares that is rounding
WIDE = 2**62
CHUNK_ROWS = 8192

#: One product: takes (v, beta, G) and returns |p|^2, U'p and A'p of p = Av - beta * (last u), where U = AG.
Product = Callable[[np.ndarray, float, np.ndarray], tuple[float, np.ndarray, np.ndarray]]


@dataclass
class Fit:
    """Of the vectors of one length."""

    n: int
    sums: list[int]  # exact, per dimension
    components: np.ndarray  # rows: unit vectors by falling eigenvalue
    eigenvalues: np.ndarray
    trace: float

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.exact(x) / float(self.n)

    def exact(self, x: np.ndarray) -> np.ndarray:
        """n * x - S in whole numbers."""
        return self.n * x - np.array(self.sums, np.int64)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ self.components.T / np.sqrt(self.eigenvalues)

    def deviations(self, x: np.ndarray) -> list[int]:
        exact = self.exact(x)
        if float(np.abs(exact).max(initial=0)) ** 2 * exact.shape[1] < WIDE:
            return (exact * exact).sum(1).tolist()
        return [sum(e * e for e in row) for row in exact.tolist()]


class Bidiagonal:
    """Golub-Kahan-Lanczos steps from a random start, orthogonal to ``found``."""

    def __init__(self, product: Product, dim: int, found: np.ndarray, energy: float, seed: int):
        self.product, self.dim, self.found, self.energy = product, dim, found, energy
        self.rng = np.random.default_rng(seed)
        self.right: list[np.ndarray] = []  # v
        self.left: list[np.ndarray] = []  # g, where u = Ag
        self.image: list[np.ndarray] = []  # A'u
        self.alpha: list[float] = []
        self.beta: list[float] = []  # beta[k] links u[k] and v[k + 1]; 0 where a new start was needed
        self.ended = False
        self._start()

    def _orthogonal(self, v: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for basis in (self.found, np.array(self.right)):
                if len(basis):
                    v = v - basis.T @ (basis @ v)
        return v

    def _start(self) -> None:
        if len(self.found) + len(self.right) >= self.dim:
            self.ended = True
            return
        v = self._orthogonal(self.rng.standard_normal(self.dim))
        self.next = v / np.linalg.norm(v)

    def step(self) -> None:
        v, beta = self.next, self.beta[-1] if self.beta else 0.0
        lefts = np.array(self.left).reshape(len(self.left), self.dim).T
        size, onto, back = self.product(v, beta, lefts)
        self.right.append(v)
        norm = np.sqrt(max(0.0, size - float(onto @ onto)))
        largest = max([np.sqrt(self.energy / self.dim), *self.alpha, *self.beta])
        if norm <= NOTHING * largest:  # v adds no new left vector
            self.alpha.append(0.0)
            self.left.append(np.zeros(self.dim))
            self.image.append(np.zeros(self.dim))
            self._again()
            return
        g = v - (beta * self.left[-1] if beta else 0.0) - lefts @ onto
        images = np.array(self.image).reshape(len(self.image), self.dim).T
        self.left.append(g / norm)
        self.image.append((back - images @ onto) / norm)
        self.alpha.append(float(norm))
        rest = self._orthogonal(self.image[-1] - norm * v)
        size = float(np.linalg.norm(rest))
        if size <= NOTHING * largest:
            self._again()
        else:
            self.beta.append(size)
            self.next = rest / size
            self.ended = len(self.found) + len(self.right) >= self.dim

    def _again(self) -> None:
        """The space is closed: what is outside needs a new start."""
        self.beta.append(0.0)
        held = sum(x * x for x in self.alpha) + sum(x * x for x in self.beta)
        if self.energy - held <= LEFT_OVER * self.energy:
            self.ended = True
        else:
            self._start()

    def triplets(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Singular values, right vectors (rows) and residuals, largest first."""
        k = len(self.right)
        small = np.diag(self.alpha) + np.diag(self.beta[:k - 1], 1)
        u, s, vt = np.linalg.svd(small)
        residual = np.zeros(k) if self.ended else self.beta[-1] * np.abs(u[-1])
        return s, vt @ np.array(self.right), residual


def leading(product: Product, dim: int, wanted: int, energy: float, seed: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """The ``wanted`` largest singular values and their right vectors (rows)."""
    values, vectors = np.zeros(0), np.zeros((0, dim))
    while True:
        many = min(wanted, dim) if not len(values) else 1
        run = Bidiagonal(product, dim, vectors, energy - float(values @ values), seed + len(values))
        floor = values.min(initial=np.inf) if len(values) >= wanted else 0.0
        while not run.ended:
            run.step()
            s, v, residual = run.triplets()
            limit = TOLERANCE * max(s[0], values.max(initial=0.0))
            if len(s) >= many and (residual[:many] <= limit).all():
                break
            if len(s) >= 2 * many + 8 and s[0] + residual[0] < floor * (1 - 1e-6):
                break  # the second run stays below all that is wanted
        if run.ended and not run.right:
            break
        s, v, _ = run.triplets()
        exhausted, many = run.ended, len(s) if run.ended else many
        larger = bool((s[:many] > floor * (1 + 1e-13)).any())
        values, vectors = np.concatenate([values, s[:many]]), np.concatenate([vectors, v[:many]])
        order = np.argsort(-values, kind="stable")
        values, vectors = values[order], vectors[order]
        if exhausted or (floor > 0 and not larger):
            break
    vectors = vectors[:wanted] / np.linalg.norm(vectors[:wanted], axis=1, keepdims=True)
    return values[:wanted], vectors


def whole_rows(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, dim, x): the valid rows in whole numbers."""
    finite = F.forall("vec", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))))
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vec_col).cast("array<double>").alias("vec"))
    rows = rows.filter(F.col("vec").isNotNull() & (F.size("vec") > 0) & finite)
    held = F.forall("vec", lambda c: F.abs(c) < float(2**51))
    whole = F.transform("vec", lambda c: F.floor(c * SCALE).cast("long") + SHIFT)
    return rows.select("id", F.size("vec").alias("dim"),
                       F.when(held, whole).otherwise(F.raise_error(F.lit("a component leaves 64 bits"))).alias("x"))


def _chunks(batches: Iterator[pa.RecordBatch], dim: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for batch in batches:
        for at in range(0, batch.num_rows, CHUNK_ROWS):
            part = batch.slice(at, CHUNK_ROWS)
            yield part, part.column(part.schema.get_field_index("x")).flatten().to_numpy().reshape(-1, dim)


def _summed(rows: DataFrame, part: Callable[[Iterator[pa.RecordBatch]], np.ndarray], size: int) -> np.ndarray:
    """The sum over all tasks of the vector that ``part`` makes of a task's rows."""
    def one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield pa.RecordBatch.from_arrays([pa.array(range(size), pa.int32()), pa.array(part(batches), pa.float64())],
                                         names=["place", "value"])

    got = rows.mapInArrow(one, "place int, value double").groupBy("place").agg(F.sum("value").alias("value")).collect()
    out = np.zeros(size)
    for r in got:
        out[r.place] = r.value
    return out


def fit(rows: DataFrame, dim: int, components: int = COMPONENTS) -> Fit:
    """Fit on the rows (of ``whole_rows``, stored) whose vectors have length ``dim``."""
    rows = rows.filter(F.col("dim") == dim).select("x")
    place = rows.select(F.posexplode("x").alias("place", "v")).groupBy("place").agg(
        F.sum(F.col("v").cast("decimal(38,0)")).alias("s"), F.max(F.abs("v")).alias("most"), F.count("*").alias("n"))
    got = sorted(place.collect())
    n, sums, most = got[0].n, [int(r.s) for r in got], max(r.most for r in got)
    if 2 * n * most >= 2**63:
        raise ArithmeticError("n * x leaves 64 bits")
    start = Fit(n, sums, np.zeros((0, dim)), np.zeros(0), 0.0)

    def energy_part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return np.array([sum(float((start.centred(x) ** 2).sum()) for _, x in _chunks(batches, dim))])

    energy = float(_summed(rows, energy_part, 1)[0])
    if energy == 0:
        return start

    def product(v: np.ndarray, beta: float, lefts: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
        k = lefts.shape[1]
        ahead = v - beta * lefts[:, -1] if beta else v

        def part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
            out = np.zeros(1 + k + dim)
            for _, x in _chunks(batches, dim):
                a = start.centred(x)
                p = a @ ahead
                out[0] += p @ p
                out[1:1 + k] += (a @ lefts).T @ p
                out[1 + k:] += a.T @ p
            return out

        got = _summed(rows, part, 1 + k + dim)
        return float(got[0]), got[1:1 + k], got[1 + k:]

    values, vectors = leading(product, dim, min(components, dim), energy)
    stay = values**2 > 10 * LEFT_OVER * energy
    return Fit(n, sums, vectors[stay], values[stay] ** 2 / n, energy / n)


def identity_error(rows: DataFrame, dim: int, fitted: Fit) -> float:
    """Largest absolute entry of the whitened rows' covariance less the identity."""
    rows, k = rows.filter(F.col("dim") == dim).select("x"), len(fitted.eigenvalues)

    def mean_part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        return sum((fitted.whitened(x).sum(0) for _, x in _chunks(batches, dim)), np.zeros(k))

    mean = _summed(rows, mean_part, k) / fitted.n

    def product_part(batches: Iterator[pa.RecordBatch]) -> np.ndarray:
        out = np.zeros((k, k))
        for _, x in _chunks(batches, dim):
            w = fitted.whitened(x) - mean
            out += w.T @ w
        return out.ravel()

    covariance = _summed(rows, product_part, k * k).reshape(k, k) / fitted.n
    return float(np.abs(covariance - np.eye(k)).max(initial=0.0))


def whiten(vectors: DataFrame, components: int = COMPONENTS, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Per row and component: id_col, component, n, deviation, whitened,
    explained, identity_error."""
    rows = staged(whole_rows(vectors, id_col, vec_col), "whiten-rows")
    dims = [r.dim for r in rows.select("dim").distinct().sort("dim").collect()]
    kind = vectors.schema[id_col].dataType.simpleString()
    schema = f"`{id_col}` {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    out = None
    for dim in dims:
        part = _apply(rows, dim, fit(rows, dim, components), id_col, schema)
        out = part if out is None else out.unionByName(part)
    return vectors.sparkSession.createDataFrame([], schema) if out is None else out


def _apply(rows: DataFrame, dim: int, fitted: Fit, id_col: str, schema: str) -> DataFrame:
    error, k = identity_error(rows, dim, fitted), len(fitted.eigenvalues)
    explained = fitted.eigenvalues / fitted.trace if k else fitted.eigenvalues

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if not k:
            return
        for part, x in _chunks(batches, dim):
            m = len(x)
            deviation = pa.array([Decimal(d) for d in fitted.deviations(x)], pa.decimal128(38, 0))
            every = pa.array(np.repeat(np.arange(m), k))
            yield pa.RecordBatch.from_arrays(
                [part.column(0).take(every), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, fitted.n)), deviation.take(every), pa.array(fitted.whitened(x).ravel()),
                 pa.array(np.tile(explained, m)), pa.array(np.full(m * k, error))],
                names=[id_col, "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return rows.filter(F.col("dim") == dim).select("id", "x").mapInArrow(project, schema)
