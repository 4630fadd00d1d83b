"""Whitening of embeddings by an incremental eigendecomposition."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from daypulse.llm.common import saved

#: Entries become whole multiples of 1 / SCALE.
SCALE = 256
COMPONENTS = 4
#: Vectors whose scatter is brought to a triangle before it is applied.
BLOCK = 1024
#: Spectra that one task combines into one.
FAN_IN = 8
#: Steps of the secular solver; it doubles its digits with each.
STEPS = 60
EPS = np.finfo(float).eps
LONG_MAX = 2 ** 63 - 1


# --------------------------------------------------------------------------
# rank-one updates of a symmetric eigenproblem
# --------------------------------------------------------------------------

@np.errstate(divide="ignore", invalid="ignore", over="ignore")
def secular_roots(d: np.ndarray, z2: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues of diag(d) + rho z z' for rising, distinct ``d`` and ``z2`` =
    z*z > 0, as (index of the nearer pole, distance from it).

    Root k of 1 + rho * sum(z2 / (d - x)) lies between poles k and k + 1, the last
    one below d + rho * |z|^2. Both sides' sums are replaced by one pole each that
    match value and slope; the quadratic's root is the next point, bisection
    steps in where it leaves the bracket (a quotient without a value does). All
    roots are found at once, each from its nearer pole, so that small distances
    keep their digits."""
    m = len(d)
    at = np.arange(m)
    right = np.append(d[1:], d[-1] + rho * z2.sum())
    gap = right - d
    # the side of the midpoint on which the root lies decides its origin
    term = rho * z2 / (d[None, :] - (d + gap / 2)[:, None])
    f_mid = 1 + term.sum(axis=1)
    from_left = (f_mid >= 0) | (at == m - 1)
    origin = np.where(from_left, at, np.minimum(at + 1, m - 1))
    poles = d[None, :] - d[origin][:, None]                         # poles seen from the origin
    low, high = np.where(from_left, 0.0, -gap / 2), np.where(from_left, gap / 2, 0.0)
    high[-1] = gap[-1]
    to_left, to_right = np.where(from_left, 0.0, -gap), np.where(from_left, gap, 0.0)   # poles k and k + 1 likewise
    # the first point: poles k and k + 1 as they are, the rest as at the midpoint
    w_left, w_right = rho * z2, rho * np.append(z2[1:], 0.0)
    c = f_mid + (w_left - w_right) / (gap / 2)
    a, b = c * (to_left + to_right) + w_left + w_right, w_left * to_right + w_right * to_left
    root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
    x = (low + high) / 2
    for guess in (2 * b / (a + root), 2 * b / (a - root)):
        x = np.where((guess > low) & (guess < high), guess, x)
    left_of = (at[None, :] <= at[:, None]).astype(float)
    out = x.copy()
    open_ = at                                            # roots not yet found
    for _ in range(STEPS):
        inv = 1 / (poles - x[:, None])
        inv_left = inv * left_of
        all_sum, left_sum = rho * (inv @ z2), rho * (inv_left @ z2)
        inv *= inv
        inv_left *= inv_left
        slope, psi = rho * (inv @ z2), rho * (inv_left @ z2)
        phi = slope - psi
        value = 1 + all_sum
        size = 1 + all_sum - 2 * left_sum                           # terms' absolute values: left ones are negative
        low, high = np.where(value <= 0, x, low), np.where(value >= 0, x, high)
        go = (np.abs(value) > 4 * EPS * size) & (high - low > 2 * EPS * np.maximum(np.abs(low), np.abs(high)))
        out[open_] = x
        if not go.any():
            break
        dl, dr = to_left - x, to_right - x
        a = (dl + dr) * value - dl * dr * slope
        b = dl * dr * value
        c = value - dl * psi - dr * phi
        root = np.sqrt(np.maximum(a * a - 4 * b * c, 0))
        step = np.where(a <= 0, (a - root) / (2 * c), 2 * b / (a + root))
        new = x + step
        inside = np.isfinite(new) & (new > low) & (new < high)
        x = np.where(inside, new, (low + high) / 2)[go]
        poles, left_of = poles[go], left_of[go]
        low, high, to_left, to_right, open_ = (v[go] for v in (low, high, to_left, to_right, open_))
    return origin, out


def rank_one(values: np.ndarray, vectors: np.ndarray, v: np.ndarray, rho: float) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues (rising) and vectors of vectors diag(values) vectors' + rho v v'
    for rho >= 0.

    Deflation: entries of z = vectors' v that are negligible leave their pair
    as it is; equal eigenvalues are turned against each other until one of
    them holds the whole entry. The rest goes through the secular equation; z is
    then taken anew from the roots found (Loewner's formula), which keeps the
    vectors orthogonal however close roots lie."""
    z = vectors.T @ v
    norm = float(z @ z)
    if rho * norm == 0:
        return values, vectors
    tiny = 8 * EPS * max(float(np.abs(values).max()), rho * norm)
    live = np.sqrt(rho) * np.abs(z) * np.sqrt(norm * rho) > tiny
    if not live.any():
        return values, vectors
    values, vectors = values.copy(), vectors.copy()
    at = np.flatnonzero(live)
    starts = np.flatnonzero(np.append(True, np.diff(values[at]) > tiny))
    kept = []
    for s, e in zip(starts, np.append(starts[1:], len(at))):
        group = at[s:e]
        if len(group) > 1:
            # a reflection that moves all of the group's z into its last entry
            u = z[group].copy()
            size = np.linalg.norm(u)
            target = -size if u[-1] > 0 else size
            u[-1] -= target
            u /= np.linalg.norm(u)
            vectors[:, group] -= 2 * np.outer(vectors[:, group] @ u, u)
            z[group], z[group[-1]] = 0, target
            values[group] = values[group[-1]]
        kept.append(group[-1])
    kept = np.array(kept)
    d, zk = values[kept], z[kept]
    origin, x = secular_roots(d, zk * zk, rho)
    # differences pole - root, without cancellation
    gaps = (d[:, None] - d[origin][None, :]) - x[None, :]
    between = d[:, None] - d[None, :]
    np.fill_diagonal(between, 1.0)
    ratio = -gaps / np.where(np.eye(len(d), dtype=bool), rho, -between)
    zk = np.copysign(np.sqrt(np.abs(np.prod(ratio, axis=1))), zk)
    turn = zk[:, None] / gaps
    turn /= np.linalg.norm(turn, axis=0)
    values[kept] = d[origin] + x
    vectors[:, kept] = vectors[:, kept] @ turn
    order = np.argsort(values, kind="stable")
    return values[order], vectors[:, order]


@dataclass
class Spectrum:
    """Count, mean and eigenpairs of the centred scatter of some vectors."""
    n: int
    mean: np.ndarray
    values: np.ndarray
    vectors: np.ndarray

    @classmethod
    def empty(cls, dims: int) -> Spectrum:
        return cls(0, np.zeros(dims), np.zeros(dims), np.eye(dims))

    def add(self, x: np.ndarray) -> None:
        """More vectors (rows). Centred on their own mean they are applied one by
        one as rank-one updates, and the distance of the means as a last one. Of
        more vectors than dimensions the triangle of their QR is applied: its rows
        have the same scatter and are as few as the dimensions."""
        m = len(x)
        if not m:
            return
        own = x.mean(axis=0)
        y = x - own
        for row in np.linalg.qr(y, mode="r") if m > y.shape[1] else y:
            self.values, self.vectors = rank_one(self.values, self.vectors, row, 1.0)
        self.shift(own, m)

    def shift(self, mean: np.ndarray, m: int) -> None:
        """The part of a scatter of ``m`` more vectors that lies between the means."""
        away, n = mean - self.mean, self.n + m
        if self.n:
            self.values, self.vectors = rank_one(self.values, self.vectors, away, self.n * m / n)
        self.mean, self.n = self.mean + away * (m / n), n

    def merge(self, other: Spectrum) -> None:
        """The other scatter as successive rank-one updates, one per eigenpair and
        one for the distance of the means."""
        if not other.n:
            return
        for value, vector in zip(other.values, other.vectors.T):
            if value > 0:
                self.values, self.vectors = rank_one(self.values, self.vectors, vector, float(value))
        self.shift(other.mean, other.n)

    def record(self, part: int) -> tuple:
        return (part, self.n, self.mean.tolist(), self.values.tolist(), self.vectors.ravel().tolist())

    @classmethod
    def of(cls, row) -> Spectrum:
        mean = np.array(row.mean, float)
        return cls(int(row.n), mean, np.array(row.eigenvalues, float),
                   np.array(row.eigenvectors, float).reshape(len(mean), -1))


SPECTRUM_SCHEMA = ("part int, n bigint, mean array<double>, eigenvalues array<double>, "
                   "eigenvectors array<double>")
_NAMES = ["part", "n", "mean", "eigenvalues", "eigenvectors"]


def matrix(column: pa.Array) -> np.ndarray:
    """Equally long lists of a column as rows of a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1) if len(column) else flat.reshape(0, 0)


def partition_spectra(fit: DataFrame, dims: int) -> DataFrame:
    """One spectrum per task over column ``x`` of ``fit``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spectrum, part = Spectrum.empty(dims), 0
        for batch in batches:
            if batch.num_rows:
                part = batch.column("part")[0].as_py()
            x = matrix(batch.column("x")).astype(float)
            for k in range(0, len(x), BLOCK):
                spectrum.add(x[k:k + BLOCK])
        if spectrum.n:
            yield pa.RecordBatch.from_pylist([dict(zip(_NAMES, spectrum.record(part)))], schema=schema)

    schema = pa.schema([("part", pa.int32()), ("n", pa.int64())]
                       + [(c, pa.list_(pa.float64())) for c in _NAMES[2:]])
    return fit.select("x", F.spark_partition_id().alias("part")).mapInArrow(run, SPECTRUM_SCHEMA)


def combined(spark: SparkSession, fit: DataFrame, dims: int) -> Spectrum:
    """The spectrum of all of ``fit``: FAN_IN at a time are merged until one is
    left, which comes to the driver (dims * dims numbers)."""

    def merge(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("part")
        total = Spectrum.empty(dims)
        for row in rows.itertuples():
            total.merge(Spectrum.of(row))
        return pd.DataFrame([total.record(int(rows["part"].iloc[0]) // FAN_IN)], columns=_NAMES)

    spectra = saved(spark, partition_spectra(fit, dims), "whiten-spectra")
    left = (spectra.agg(F.max("part")).first()[0] or 0) + 1
    while left > 1:
        group = F.floor(F.col("part") / FAN_IN).cast("int")
        spectra = spectra.groupBy(group.alias("g")).applyInPandas(merge, SPECTRUM_SCHEMA)
        left = -(-left // FAN_IN)
    rows = spectra.collect()
    total = Spectrum.empty(dims)
    for row in rows:
        total.merge(Spectrum.of(row))
    return total


def moments(fit: DataFrame, basis: np.ndarray, mean: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """Mean and covariance of (x - mean) projected on the columns of ``basis``,
    over all of ``fit``. A task sends one sum of products, centred on its own
    mean; they are combined by the shift of the means."""
    k = basis.shape[1]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, at, scatter = 0, np.zeros(k), np.zeros((k, k))
        for batch in batches:
            if batch.num_rows:
                y = (matrix(batch.column("x")) - mean) @ basis
                own = y.mean(axis=0)
                y -= own
                away, m = own - at, len(y)
                scatter += y.T @ y + np.outer(away, away) * (n * m / (n + m))
                at, n = at + away * (m / (n + m)), n + m
        if n:
            yield pa.RecordBatch.from_arrays(
                [pa.array([n]), pa.array([at.tolist()]), pa.array([scatter.ravel().tolist()])],
                names=["n", "at", "scatter"])

    n, at, scatter = 0, np.zeros(k), np.zeros((k, k))
    # one row of k * (k + 1) numbers per task
    for row in fit.select("x").mapInArrow(run, "n bigint, at array<double>, scatter array<double>").toLocalIterator():
        away = np.array(row["at"]) - at
        scatter += np.array(row["scatter"]).reshape(k, k) + np.outer(away, away) * (n * row["n"] / (n + row["n"]))
        at, n = at + away * (row["n"] / (n + row["n"])), n + row["n"]
    return at, scatter / max(1, n), n


@dataclass
class Whitening:
    """Sums and components of a fit list. ``components`` are columns by falling
    ``values``; ``inverse`` is 1 / sqrt(value), 0 where the value is none."""
    n: int
    sums: list[int]
    components: np.ndarray
    values: np.ndarray
    inverse: np.ndarray
    trace: float
    identity_error: float | None


def fit_whitening(spark: SparkSession, fit: DataFrame, components: int = COMPONENTS) -> Whitening | None:
    """The whitening of the distinct vectors ``x`` (equal lengths) of ``fit``;
    None if there is none.

    The combined spectrum of all tasks is a basis of the whole space; a
    Rayleigh-Ritz step projects every vector on it, and the eigenvectors of that
    nearly diagonal matrix correct the basis to double precision. Values below
    the rounding error of the largest count as zero."""
    value = F.col("v").cast("decimal(38,0)")
    sums = [int(r["s"]) for r in fit.select(F.posexplode("x").alias("k", "v")).groupBy("k")
            .agg(F.sum(value).alias("s")).orderBy("k").collect()]   # one row per dimension
    if not sums:
        return None
    n = fit.count()
    mean = np.array([s // n + s % n / n for s in sums])
    basis, _ = np.linalg.qr(combined(spark, fit, len(sums)).vectors)
    _, projected, _ = moments(fit, basis, mean)
    values, turn = np.linalg.eigh((projected + projected.T) / 2)
    basis, _ = np.linalg.qr(basis @ turn[:, ::-1])
    values = values[::-1]
    trace = float(np.trace(projected))
    k = min(components, len(sums))
    real = values[:k] > len(sums) * EPS * values[0]
    inverse = np.where(real, 1 / np.sqrt(np.where(real, values[:k], 1)), 0)
    error = None
    if real.any():
        _, white, _ = moments(fit, basis[:, :k][:, real] * inverse[real], mean)
        error = float(np.abs(white - np.eye(int(real.sum()))).max())
    return Whitening(n, sums, basis[:, :k], values[:k], inverse, trace, error)


def whole_vectors(rows: DataFrame, vector: str = "embedding") -> DataFrame:
    """``vec_id, x``: rows whose vector has no null, NaN or infinite entry, as
    whole numbers floor(SCALE * entry); empty vectors go too."""
    x = F.transform(vector, lambda c: F.floor(c.cast("double") * F.lit(float(SCALE))).cast("long"))
    bad = F.exists(vector, lambda c: c.isNull() | F.isnan(c.cast("double"))
                   | (F.abs(c.cast("double")) == F.lit(float("inf"))))
    whole = rows.where(F.col(vector).isNotNull() & (F.size(vector) > 0) & ~F.coalesce(bad, F.lit(True)))
    return whole.select(F.col("vec_id").cast("long"), x.alias("x"))


WHITE_SCHEMA = ("vec_id bigint, component int, n bigint, deviation bigint, whitened double, "
                "explained double, identity_error double")


def whiten(rows: DataFrame, model: Whitening) -> DataFrame:
    """Every row of ``vec_id, x`` by every component of the model."""
    n, sums = model.n, model.sums
    whole, part = np.array([float(s // n) for s in sums]), np.array([s % n / n for s in sums])
    scaled = model.components * model.inverse
    k = scaled.shape[1]
    has = model.inverse > 0
    explained = [float(v) / model.trace if model.trace > 0 else None for v in model.values]
    limit = float(np.sqrt(LONG_MAX / len(sums)) / 2)    # below it no sum of squares leaves a long

    def deviations(x: np.ndarray) -> list[int | None]:
        if len(x) and n * float(np.abs(x.astype(float)).max()) + max(abs(s) for s in sums) > limit:
            exact = [sum((n * int(v) - s) ** 2 for v, s in zip(row, sums)) for row in x]
            return [v if v <= LONG_MAX else None for v in exact]
        return (((n * x - np.array(sums)) ** 2).sum(axis=1)).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = matrix(batch.column("x")) if batch.num_rows else np.zeros((0, len(sums)), np.int64)
            white = ((x.astype(float) - whole) - part) @ scaled
            m = len(x)
            ids = batch.column("vec_id")
            yield pa.RecordBatch.from_arrays(
                [ids.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                 pa.array(np.full(m * k, n)), pa.array(np.repeat(np.array(deviations(x), object), k).tolist(), pa.int64()),
                 pa.array(white.ravel(), pa.float64(), mask=np.tile(~has, m)),
                 pa.array(explained * m, pa.float64()), pa.array([model.identity_error] * (m * k), pa.float64())],
                names=[c.split()[0] for c in WHITE_SCHEMA.split(", ")])

    return rows.mapInArrow(run, WHITE_SCHEMA)


def op11_embedding_whitening(spark: SparkSession, embeddings: DataFrame, components: int = COMPONENTS) -> DataFrame:
    """Whitened components of every row with a whole vector.

    The fit list has each distinct vector once, found by an aggregate with
    map-side combine, so copies cost one task nothing. Vectors of another
    length than most of the fit list have (ties: the longer) have no place in
    its space and go as well. Rows that repeat an id or a vector, or have a null
    id, are rows of the result. A component without variance has no ``whitened``
    value; a deviation beyond a long is null; a table without whole vectors
    gives no rows. Other columns are not read."""
    rows = whole_vectors(embeddings)
    distinct = saved(spark, rows.select("x").distinct(), "whiten-fit")
    sizes = distinct.groupBy(F.size("x").alias("dims")).agg(F.count("*").alias("m")).orderBy(
        F.desc("m"), F.desc("dims")).limit(1).collect()
    if not sizes:
        return spark.createDataFrame([], WHITE_SCHEMA)
    same = F.size("x") == sizes[0]["dims"]
    model = fit_whitening(spark, distinct.where(same), components)
    return whiten(rows.where(same), model)
