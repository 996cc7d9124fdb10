"""Embedding whitening by a block Jacobi-Davidson method.

The covariance V of the vectors is never formed: it is known only through distributed
products V B of a narrow block B, one pass over the rows each, in which every task
centres its rows, multiplies and multiplies back (``X' (X B) / n``) and the tasks' sums meet
in a tree of group sums. The driver holds blocks of a few dozen columns of the vectors'
length, nothing that grows with the rows.

One round: Rayleigh-Ritz in the search subspace; wanted Ritz pairs whose residual is
down to rounding are locked, in falling order; the correction equation of each other one,
projected against the locked vectors and the Ritz block, is solved roughly by ``inner``
MINRES steps, all of them sharing their passes; the corrections, orthogonalised, widen
the subspace, which is cut back to the Ritz block when it gets wide. When all wanted
pairs are locked, fresh products of the locked vectors check their residuals once more.

Entries become integers first (``floor(scale * c)``; a constant added to every entry, as
the contract has it, cancels in all results and is left out), so counts, sums and each
row's exact deviation are integers; the mean is subtracted as an integer and a remainder,
before anything is multiplied.

Defined results: rows whose vector is null, empty, or holds a null, NaN, infinity or an entry of which
no long can hold the integer are dropped; so are vectors of another length than the most frequent
one (of equally frequent ones the longest): their missing entries count as null. Repeated
rows count each time; ids may be null or repeated; rows of equal vectors get equal results. Directions
without variance (eigenvalue at most ``RANK`` of the largest) are no components, so
one vector alone, or equal ones, give no rows, and neither does an empty table. Ties of eigenvalues
give any orthonormal basis, the same one for all rows. A deviation beyond a
long is null. Further columns are kept by :func:`whiten`; very long vectors only widen the blocks.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ledgerline.llm.columns import free_name
from ledgerline.sources.sinks import materialize

#: Eigenvalues at most this share of the largest are rounding, not variance.
RANK = 1e-11
#: Bytes of doubles that a stored block of rows expands to.
BLOCK_BYTES = 4 << 20
#: Sums of so many stored blocks are added on the driver, more of them by groups.
AT_ONCE = 64
#: Integers of this size and more (so their sums and differences) do not fit a long.
TOO_LARGE = float(1 << 61)


@dataclass(frozen=True)
class WhitenSpec:
    """Components wanted, integer scale, Ritz vectors carried beyond the wanted ones, MINRES steps a round,
    widest subspace in Ritz blocks, rounds after which an unconverged run raises, seed of the start block."""

    components: int = 32
    scale: float = 64.0
    extra: int = 8
    inner: int = 8
    widest: int = 4
    rounds: int = 200
    seed: int = 11


# ------------------------------------------------------------------ the fit list as stored blocks

def _entries(vector: Column) -> Column:
    return vector.cast("array<double>")


def _finite(vector: Column, scale: float) -> Column:
    ok = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c * scale) < TOO_LARGE)
    return vector.isNotNull() & (F.size(vector) > 0) & F.forall(_entries(vector), ok)


def usual_length(df: DataFrame, vector: str, spec: WhitenSpec) -> int:
    """The most frequent length of the valid vectors, the longest of equally frequent ones; 0 without any."""
    v = F.col(f"`{vector}`")
    lengths = df.where(_finite(v, spec.scale)).groupBy(F.size(v).alias("d")).agg(F.count(F.lit(1)).alias("rows"))
    best = lengths.agg(F.max(F.struct("rows", "d")).alias("best")).first()["best"]
    return best["d"] if best else 0


def _matrix(column: pa.Array, dims: int, scale: float) -> np.ndarray:
    """Rows of ``floor(scale * c)`` as longs."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return np.floor(column.flatten().to_numpy(zero_copy_only=False) * scale).astype(np.int64).reshape(-1, dims)


def _narrow(y: np.ndarray) -> np.ndarray:
    lo, hi = int(y.min()), int(y.max())
    return y.astype(next(t for t in (np.int8, np.int16, np.int32, np.int64) if np.iinfo(t).min <= lo and hi <= np.iinfo(t).max))


def _integer_sums(y: np.ndarray) -> list[int]:
    if int(np.abs(y.astype(np.float64)).max()) * len(y) < 1 << 62:
        return [int(s) for s in y.sum(axis=0, dtype=np.int64)]
    return [sum(column) for column in y.T.tolist()]


_BLOCK_DDL = "rows int, kind string, data binary, sums array<decimal(38,0)>"


def stored_blocks(df: DataFrame, vector: str, dims: int, spec: WhitenSpec) -> DataFrame:
    """The fit list as blocks of rows in the narrowest integer type, with their exact column sums."""
    height = max(1, BLOCK_BYTES // (8 * dims))

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            every = _matrix(batch.column(0), dims, spec.scale)
            for lo in range(0, len(every), height):
                y = _narrow(every[lo:lo + height])
                sums = pa.array([_integer_sums(y)], pa.list_(pa.decimal128(38, 0)))
                yield pa.RecordBatch.from_arrays([pa.array([len(y)], pa.int32()), pa.array([y.dtype.str]), pa.array([y.tobytes()], pa.binary()), sums],
                                                 ["rows", "kind", "data", "sums"])

    return materialize(_valid(df, vector, dims, spec).select(_entries(F.col(f"`{vector}`")).alias("v")).mapInArrow(packed, _BLOCK_DDL), "vector-blocks")


def _valid(df: DataFrame, vector: str, dims: int, spec: WhitenSpec) -> DataFrame:
    v = F.col(f"`{vector}`")
    return df.where(_finite(v, spec.scale) & (F.size(v) == dims))


@dataclass(frozen=True)
class Centre:
    """Row count and exact column sums of the integers without offset."""

    n: int
    sums: tuple[int, ...]

    def centred(self, y: np.ndarray) -> np.ndarray:
        """Rows minus the mean: the integer part exactly, the remainder as a double."""
        whole = np.array([s // self.n for s in self.sums], np.int64)
        rest = np.array([(s % self.n) / self.n for s in self.sums])
        return (y.astype(np.int64) - whole).astype(np.float64) - rest

    def deviations(self, y: np.ndarray) -> list[int | None]:
        """``sum((n * y - sums) ** 2)`` of each row, exact; null beyond a long."""
        most = self.n * int(np.abs(y.astype(np.float64)).max(initial=0)) + max(map(abs, self.sums))
        if most * most * y.shape[1] < 1 << 62:
            gap = self.n * y.astype(np.int64) - np.array(self.sums, np.int64)
            return (gap * gap).sum(axis=1).tolist()
        exact = [sum((self.n * a - s) ** 2 for a, s in zip(row, self.sums, strict=True)) for row in y.tolist()]
        return [d if d < 1 << 63 else None for d in exact]


def find_centre(blocks: DataFrame) -> Centre:
    n = blocks.agg(F.sum("rows")).first()[0] or 0
    sums = blocks.select(F.posexplode("sums").alias("i", "s")).groupBy("i").agg(F.sum("s").alias("s")).orderBy("i").collect()
    return Centre(int(n), tuple(int(r["s"]) for r in sums))  # as many rows as a vector has entries


_LINES = "part int, line int, data binary"


def _add_up(rows: pa.Table) -> pa.Table:
    rows = rows.sort_by("part")  # a fixed order of addition
    out = np.zeros(len(rows["data"][0].as_py()) // 8)
    for d in rows["data"].to_pylist():
        out += np.frombuffer(d)
    return pa.table({"part": rows["part"][:1], "line": rows["line"][:1], "data": [out.tobytes()]})


def summed_over_blocks(blocks: DataFrame, of_rows: Callable[[np.ndarray], np.ndarray], dims: int, stored: int) -> np.ndarray:
    """The sum over all blocks of the matrix ``of_rows`` makes of a block's integers.

    A task sends its sum once, a row for each line of the matrix. The driver adds up to
    ``AT_ONCE`` of them itself; beyond that lines are added in two rounds of groups of about
    the square root of the tasks, and the driver gets one row for each line.
    """
    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = None
        for batch in batches:
            for kind, data in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                found = of_rows(np.frombuffer(data, np.dtype(kind)).reshape(-1, dims))
                total = found if total is None else total + found
        if total is not None:
            lines = [np.ascontiguousarray(x, np.float64).tobytes() for x in total]
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part] * len(lines), pa.int32()), pa.array(range(len(lines)), pa.int32()), pa.array(lines, pa.binary())],
                                             ["part", "line", "data"])

    lines = blocks.select("kind", "data").mapInArrow(partial, _LINES)
    if stored > AT_ONCE:
        turns = lines.withColumn("turn", F.pmod("part", F.lit(int(stored ** 0.5)))).groupBy("line", "turn").applyInArrow(_add_up, _LINES)
        lines = turns.groupBy("line").applyInArrow(_add_up, _LINES)
    total: dict[int, np.ndarray] = {}
    for r in sorted(lines.collect(), key=lambda r: (r["line"], r["part"])):  # a fixed order of addition
        total[r["line"]] = total.get(r["line"], 0.0) + np.frombuffer(r["data"])
    return np.array(list(total.values()))


# ------------------------------------------------------------------ Jacobi-Davidson

Product = Callable[[np.ndarray], np.ndarray]


def _against(q: np.ndarray, t: np.ndarray) -> np.ndarray:
    """``t`` without its parts along the orthonormal columns of ``q`` (twice, for orthogonality to rounding)."""
    for _ in range(2):
        t = t - q @ (q.T @ t)
    return t


def _orthonormal(t: np.ndarray, q: np.ndarray) -> np.ndarray:
    """An orthonormal basis of the columns of ``t`` without those of ``q``; directions lost to rounding go."""
    size = np.linalg.norm(t, axis=0)
    t = t[:, size > 0] / size[size > 0]
    for _ in range(2):
        t = _against(q, t)
        u, s, _ = np.linalg.svd(t, full_matrices=False)
        t = u[:, s > 1e-8]
    return t


def minres(product: Product, shifts: np.ndarray, q: np.ndarray, b: np.ndarray, steps: int) -> np.ndarray:
    """Rough solutions t of (I-QQ')(V - shift)(I-QQ') t = b, a column for each shift; one product a step for all."""
    x = np.zeros_like(b)
    v_old, v = np.zeros_like(b), _against(q, b)
    beta = np.linalg.norm(v, axis=0)
    start = beta.copy()
    eta = beta.copy()
    c_old = c = np.ones(b.shape[1])
    s_old = s = np.zeros(b.shape[1])
    w_old, w = np.zeros_like(b), np.zeros_like(b)
    live = beta > 0
    v = np.where(live, v / np.where(live, beta, 1), 0)
    beta = np.zeros(b.shape[1])  # the coefficient of the vector before the first
    for _ in range(steps):
        if not live.any():
            break
        av = np.zeros_like(v)
        av[:, live] = product(v[:, live])
        p = _against(q, av - v * shifts)
        alpha = (v * p).sum(axis=0)
        p = p - alpha * v - beta * v_old
        beta_new = np.linalg.norm(p, axis=0)
        # two old rotations and a new one on the next column of the tridiagonal matrix
        r1 = s_old * beta
        r2 = c_old * c * beta + s * alpha
        r3_bar = c * alpha - c_old * s * beta
        r3 = np.hypot(r3_bar, beta_new)
        ok = live & (r3 > 0)
        safe = np.where(ok, r3, 1)
        c_old, c = c, np.where(ok, r3_bar / safe, 1)
        s_old, s = s, np.where(ok, beta_new / safe, 0)
        w_old, w = w, np.where(ok, (v - r1 * w_old - r2 * w) / safe, 0)
        x = x + np.where(ok, c * eta, 0) * w
        eta = -s * eta
        live = ok & (beta_new > 1e-14 * np.abs(shifts)) & (np.abs(eta) > 1e-3 * start)
        v_old, v = v, np.where(live, p / np.where(live, beta_new, 1), 0)
        beta = beta_new
    return x


@dataclass(frozen=True)
class EigenPairs:
    """Unit eigenvectors (columns) by falling eigenvalue, and their residual norms."""

    values: np.ndarray
    vectors: np.ndarray
    residuals: np.ndarray


def _ritz(w: np.ndarray, aw: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    h = w.T @ aw
    values, y = np.linalg.eigh((h + h.T) / 2)
    order = np.argsort(-values, kind="stable")
    return values[order], w @ y[:, order], aw @ y[:, order]


def jacobi_davidson(product: Product, dims: int, spec: WhitenSpec) -> EigenPairs:
    """The leading eigenpairs of the symmetric positive operator ``product``, with residuals at rounding level."""
    wanted = min(spec.components, dims)
    block = min(dims, wanted + spec.extra)
    rng = np.random.default_rng(spec.seed)
    w = _orthonormal(rng.standard_normal((dims, block)), np.zeros((dims, 0)))
    aw = product(w)
    locked, a_locked = np.zeros((dims, 0)), np.zeros((dims, 0))
    best, stale = np.inf, 0
    for _ in range(spec.rounds):
        values, u, au = _ritz(w, aw)
        largest = max([values[0] if len(values) else 0.0, *np.einsum("ij,ij->j", locked, a_locked)])
        if largest <= 0:
            return EigenPairs(np.zeros(0), np.zeros((dims, 0)), np.zeros(0))
        # what is locked stays out of the residuals: a part along it is rounding of the locked vectors
        residual = _against(locked, au - u * values)
        size = np.linalg.norm(residual, axis=0)
        rounding = np.finfo(float).eps * dims * largest
        left = wanted - locked.shape[1]
        done = 0
        worst = size[:left].max(initial=0)
        best, stale = (worst, 0) if worst < best / 2 else (best, stale + 1)
        enough = rounding if stale < 4 else max(rounding, 1e-11 * largest)  # rounding of very long sums may stay above the first
        while done < min(left, len(values)) and size[done] <= enough:
            done += 1
        if done:
            locked, a_locked = np.hstack([locked, u[:, :done]]), np.hstack([a_locked, au[:, :done]])
            u, au, values, residual = u[:, done:], au[:, done:], values[done:], residual[:, done:]
            best, stale, left = np.inf, 0, left - done
        if not left or not u.shape[1]:
            fresh = _orthonormal(locked, np.zeros((dims, 0)))
            values, vectors, a_vectors = _ritz(fresh, product(fresh))
            size = np.linalg.norm(a_vectors - vectors * values, axis=0)
            if size.max() <= max(rounding, 1e-11 * largest):
                some = values > RANK * largest
                return EigenPairs(values[some], vectors[:, some], size[some])
            locked, a_locked, w, aw = np.zeros((dims, 0)), np.zeros((dims, 0)), vectors, a_vectors
            continue
        open_pairs = slice(0, min(left, u.shape[1]))
        q = np.hstack([locked, u[:, :left + spec.extra]])
        t = minres(product, values[open_pairs], q, -residual[:, open_pairs], spec.inner)
        if u.shape[1] > spec.widest * block:  # restart from the Ritz block
            u, au = u[:, :left + spec.extra], au[:, :left + spec.extra]
        t = _orthonormal(t, np.hstack([locked, u]))
        w, aw = np.hstack([u, t]), np.hstack([au, product(t)]) if t.shape[1] else au
    raise RuntimeError(f"no convergence in {spec.rounds} rounds")


# ------------------------------------------------------------------ the model and its use

@dataclass(frozen=True)
class Whitening:
    """Fitted on ``centre.n`` vectors: eigenpairs, trace of the covariance, measured distance of the whitened covariance from the identity."""

    dims: int
    centre: Centre
    pairs: EigenPairs
    trace: float
    identity_error: float
    spec: WhitenSpec

    def project(self, y: np.ndarray) -> np.ndarray:
        return self.centre.centred(y) @ self.pairs.vectors / np.sqrt(self.pairs.values)


def fit_whitening(df: DataFrame, vector: str, spec: WhitenSpec = WhitenSpec()) -> Whitening:
    """Eigenpairs over all valid vectors of ``df``; the vectors are written once, as integers, and scanned by each product."""
    dims = usual_length(df, vector, spec)
    nothing = Whitening(dims, Centre(0, ()), EigenPairs(np.zeros(0), np.zeros((dims, 0)), np.zeros(0)), 0.0, 0.0, spec)
    if not dims:
        return nothing
    blocks = stored_blocks(df, vector, dims, spec)
    stored, centre = blocks.count(), find_centre(blocks)

    def total(of_rows: Callable[[np.ndarray], np.ndarray]) -> np.ndarray:
        return summed_over_blocks(blocks, of_rows, dims, stored)

    def product(b: np.ndarray) -> np.ndarray:
        def of_rows(y: np.ndarray) -> np.ndarray:
            x = centre.centred(y)
            return (x @ b).T @ x
        return total(of_rows).T / centre.n

    trace = float(total(lambda y: (centre.centred(y) ** 2).sum(axis=0, keepdims=True)).sum()) / centre.n
    pairs = jacobi_davidson(product, dims, spec)
    model = Whitening(dims, centre, pairs, trace, 0.0, spec)
    if not len(pairs.values):
        return model
    mean = total(lambda y: model.project(y).sum(axis=0, keepdims=True)) / centre.n

    def gram(y: np.ndarray) -> np.ndarray:
        x = model.project(y) - mean
        return x.T @ x

    error = float(np.abs(total(gram) / centre.n - np.eye(len(pairs.values))).max())
    return Whitening(dims, centre, pairs, trace, error, spec)


def whiten(df: DataFrame, vector: str, model: Whitening, result: str = "whitening") -> DataFrame:
    """The valid rows of ``df``, all columns, with a struct ``result``: deviation and the whitened values by component."""
    dims, scale = model.dims, model.spec.scale
    kept = [c for c in df.columns]
    raw = free_name(df, "_vector")
    rows = _valid(df, vector, dims, model.spec).withColumn(raw, _entries(F.col(f"`{vector}`")))
    schema = rows.select(*(F.col(f"`{c}`") for c in kept)).schema.add(result, StructType.fromDDL("deviation bigint, whitened array<double>"))
    kind = pa.struct([("deviation", pa.int64()), ("whitened", pa.list_(pa.float64()))])

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            y = _matrix(batch.column(len(kept)), dims, scale)
            values = model.project(y)
            offsets = pa.array(np.arange(len(y) + 1, dtype=np.int32) * values.shape[1])
            whitened = pa.ListArray.from_arrays(offsets, pa.array(values.ravel()))
            found = pa.StructArray.from_arrays([pa.array(model.centre.deviations(y), pa.int64()), whitened], fields=list(kind))
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(kept)], found], [*kept, result])

    return rows.mapInArrow(project, schema)


def op11_embedding_whitening(embeddings: DataFrame) -> DataFrame:
    """A row for each remaining vector and component: n, deviation, whitened value, explained share, identity error."""
    model = fit_whitening(embeddings, "embedding")
    shares = F.array(*(F.lit(float(e / model.trace)) for e in model.pairs.values)).cast("array<double>")
    rows = whiten(embeddings.select("vec_id", "embedding"), "embedding", model)
    return rows.select("vec_id", "whitening.deviation", F.posexplode("whitening.whitened").alias("i", "whitened")).select(
        "vec_id", (F.col("i") + 1).alias("component"), F.lit(model.centre.n).cast("bigint").alias("n"), "deviation", "whitened",
        F.get(shares, F.col("i")).alias("explained"), F.lit(model.identity_error).alias("identity_error"))
