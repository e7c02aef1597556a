"""Whitening of embeddings by their leading principal components, found with Jacobi-Davidson.

The covariance is never formed. It is used through products with a few vectors at a time, each of them one
pass over all centred rows: sum of c (c . w). On the driver lie only vectors of the embedding's dimension.

1. Rayleigh-Ritz: in a small search space, the Ritz pairs with the largest values are the present guesses.
2. A guess u with value e and residual r is corrected by t from (I - QQ')(V - eI)(I - QQ') t = -r, solved
   roughly by MINRES, a product a step. Q holds the locked vectors and the present guesses. All guesses are
   corrected at once, so that one pass serves all of their solvers.
3. The corrections extend the search space, which begins anew from its best vectors when it is full.
   Pairs whose residual has reached double precision are locked and projected out of everything after.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gridscout.llm import words as W
from gridscout.llm.common import drop_stage, stage

COMPONENTS = 8
GUARDS = 4  # guesses beyond the wanted ones, which keep close values apart
INNER = 3  # MINRES steps for a correction
MOST_ROUNDS = 200
SCALE, SHIFT = 1024, 100_000
PART_BYTES = 8 << 20
EPS = float(np.finfo(float).eps)
RANK = 1e-11  # components of less than this share of the largest value are none

Product = Callable[[np.ndarray], np.ndarray]


def _orthonormal(block: np.ndarray, *against: np.ndarray) -> np.ndarray:
    """Orthonormal columns for the span of `block` outside that of the orthonormal `against`; fewer where it is degenerate."""
    out = block / np.maximum(np.linalg.norm(block, axis=0), 1e-300)
    for _ in range(2):
        for q in against:
            if q.shape[1]:
                out = out - q @ (q.T @ out)
        size = np.linalg.norm(out, axis=0)
        out = out[:, size > 1e-10] / size[size > 1e-10]
        if not out.shape[1]:
            return out
        u, s, _ = np.linalg.svd(out, full_matrices=False)
        out = u[:, s > 1e-10]
    return out


def minres(product: Product, shift: np.ndarray, right: np.ndarray, project: Callable[[np.ndarray], np.ndarray], steps: int, tolerance: float) -> np.ndarray:
    """Columns t of P (V - shift_j) P t_j = right_j, each by its own MINRES; all share the products."""
    beta = np.linalg.norm(right, axis=0)
    first = np.maximum(beta, 1e-300)
    v, v_old = right / first, np.zeros_like(right)
    w, w_old, x = np.zeros_like(right), np.zeros_like(right), np.zeros_like(right)
    eta, c, c_old, s, s_old = beta.copy(), np.ones_like(beta), np.ones_like(beta), np.zeros_like(beta), np.zeros_like(beta)
    beta_next = np.zeros_like(beta)
    active = beta > 0
    for _ in range(steps):
        p = project(product(v) - v * shift)
        alpha = (v * p).sum(0)
        p = p - v * alpha - v_old * beta_next
        beta_old, beta_next = beta_next, np.linalg.norm(p, axis=0)
        rho0 = c * alpha - c_old * s * beta_old
        rho1 = np.sqrt(rho0**2 + beta_next**2)
        rho2 = s * alpha + c_old * c * beta_old
        rho3 = s_old * beta_old
        active = active & (rho1 > 1e-14 * np.maximum(np.abs(shift), 1e-300))
        safe = np.where(active, rho1, 1.0)
        c_old, c, s_old, s = c, rho0 / safe, s, beta_next / safe
        w_old, w = w, np.where(active, (v - w_old * rho3 - w * rho2) / safe, 0.0)
        x = x + np.where(active, w * c * eta, 0.0)
        eta = np.where(active, -s * eta, eta)
        active = active & (np.abs(eta) > tolerance * beta) & (beta_next > 1e-14 * np.maximum(np.abs(shift), 1e-300))
        if not active.any():
            break
        v_old, v = v, np.where(active, p / np.maximum(beta_next, 1e-300), 0.0)
    return x


def jacobi_davidson(product: Product, dimension: int, wanted: int = COMPONENTS, guards: int = GUARDS, inner: int = INNER) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(values, vectors, residual norms) of the `wanted` largest eigenpairs, by falling value.

    `product`: times the matrix, for any number of columns. A residual counts as double precision where it is
    within a few roundings of a product of the matrix; a pair whose residual no longer falls there is locked
    as well, once it is below a hundred times that.
    """
    wanted = min(wanted, dimension)
    size = min(wanted + guards, dimension)
    most = min(dimension, max(4 * size, 24))
    start = np.random.default_rng(13).standard_normal((dimension, size))
    locked, values, residuals = np.zeros((dimension, 0)), [], []
    space = _orthonormal(start)
    images = product(space)
    history: list[float] = []
    for _ in range(MOST_ROUNDS):
        small = space.T @ images
        theta, y = np.linalg.eigh((small + small.T) / 2)
        theta, y = theta[::-1], y[:, ::-1]
        scale = max([*values, float(np.abs(theta).max()), 1e-300])
        guess, image = space @ y[:, :size], images @ y[:, :size]
        rest = image - guess * theta[: guess.shape[1]]
        norms = np.linalg.norm(rest, axis=0)
        bound = 8 * EPS * scale * np.sqrt(dimension)
        history.append(float(norms[0]))
        stuck = len(history) > 6 and history[-1] < 100 * bound and min(history[-3:]) > 0.5 * min(history[:-3])
        done = 0  # in order, so that no larger value is passed over
        while done < len(norms) and len(values) + done < wanted and (norms[done] <= bound or (done == 0 and stuck)):
            done += 1
        if done:
            values += theta[:done].tolist()
            residuals += norms[:done].tolist()
            locked = np.concatenate([locked, guess[:, :done]], 1)
            history = []
            if len(values) == wanted:
                break
            space, images = space @ y[:, done:], images @ y[:, done:]
            if not space.shape[1]:
                space = _orthonormal(np.random.default_rng(len(values)).standard_normal((dimension, size)), locked)
                images = product(space)
            continue
        if space.shape[1] >= most and space.shape[1] + locked.shape[1] < dimension:  # full: go on from the best vectors
            space, images = space @ y[:, : 2 * size], images @ y[:, : 2 * size]
        apart = np.concatenate([locked, guess], 1)
        project = lambda t, q=apart: t - q @ (q.T @ t)
        correct = norms > bound
        right = -project(rest[:, correct])
        more = minres(product, theta[: guess.shape[1]][correct], right, project, inner, 0.05)
        new = _orthonormal(more, locked, space)
        if not new.shape[1]:
            new = _orthonormal(rest[:, correct], locked, space)
        if new.shape[1]:
            space, images = np.concatenate([space, new], 1), np.concatenate([images, product(new)], 1)
        elif history[-1] > 100 * bound:  # nothing to add: products of the same space anew
            images = product(space)
        else:
            history += [history[-1]] * 7
    order = np.argsort(-np.array(values), kind="stable")
    return np.array(values)[order], locked[:, order], np.array(residuals)[order]


def whiten(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """(id, component, n, deviation, whitened, explained, identity_error, residual) per row and component.

    An entry c becomes the whole number floor(1024 c) + 100000; all is computed from these, centred by their
    exact sums. whitened: the centred vector on the component's unit vector, over the root of its value.
    explained: the value's share of the trace. deviation: sum of (n x - S)^2, null where it is above 2^63 - 1.
    identity_error: largest entry of the covariance of `whitened` minus the identity. residual: of the
    component, as a share of the largest value. The sign of a component makes its largest entry positive.

    Left out: a vector that is null, empty, or holds null or non-finite entries or one beyond 2^42, and one of
    another length than most have (of equally frequent lengths, the longest). Rows are not told apart by id:
    repeated rows and ids count as often as they stand there, and a null id stays. Components of equal value
    are any orthonormal ones of their space. Components without variance are left out, so equal vectors, a
    single one, or an empty table give no rows. Other columns play no part, whatever they are called.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("_id"), F.col(vector_col).alias("_v")).where(F.size("_v") > 0)
    kind = rows.schema["_id"].dataType.simpleString()
    lengths = rows.select("_v").mapInArrow(_lengths, "d int, n long").groupBy("d").agg(F.sum("n").alias("n")).orderBy(F.desc("n"), F.desc("d")).first()
    schema = f"_id {kind}, component int, n long, deviation long, whitened double, explained double, identity_error double, residual double"
    nothing = spark.createDataFrame([], schema).withColumnRenamed("_id", id_col)
    if lengths is None:
        return nothing
    d, n = lengths.d, lengths.n
    sums = rows.select("_v").mapInArrow(_sums(d), "i int, s decimal(38,0), low long, high long").groupBy("i").agg(F.sum("s").alias("s"), F.min("low").alias("low"), F.max("high").alias("high")).collect()
    total = [0] * d
    base = np.zeros(d, np.int64)
    most = 0
    for r in sums:
        total[r.i] = int(r.s)
        base[r.i] = total[r.i] // n
        most = max(most, r.high - int(base[r.i]), int(base[r.i]) - r.low)
    dtype = next(t for t in (np.int16, np.int32, np.int64) if most <= np.iinfo(t).max)
    rest = np.array([t - n * int(b) for t, b in zip(total, base, strict=True)], np.int64)  # S - n base, in [0, n)
    parts = -(-n * d * np.dtype(dtype).itemsize // PART_BYTES)
    packed = stage(rows.mapInArrow(_packed(d, base, dtype), f"_id {kind}, z binary").coalesce(int(parts)))
    mean = rest / n
    passes = packed.select("z").coalesce(max(64, 2 * spark.sparkContext.defaultParallelism))

    def summed(of: Callable[[np.ndarray], np.ndarray], shape: tuple[int, ...]) -> np.ndarray:
        """Sum of a small array over all rows; as many of them reach the driver as there are tasks, at most two a core or 64."""
        found = passes.mapInArrow(_summed(of, d, dtype, mean, shape), "value binary").collect()
        return np.sum([np.frombuffer(bytes(r.value)).reshape(shape) for r in found], axis=0)

    trace = float(summed(lambda c: np.einsum("ij,ij->", c, c), ())) / n
    if not trace > 0:
        drop_stage(packed)
        return nothing
    values, axes, residuals = jacobi_davidson(lambda w: summed(lambda c: c.T @ (c @ w), w.shape) / n, d, components)
    kept = values > RANK * values[0]
    values, axes, residuals = values[kept], axes[:, kept], residuals[kept] / values[0]
    axes = axes * np.sign(axes[np.abs(axes).argmax(0), np.arange(axes.shape[1])])
    white = axes / np.sqrt(values)
    k = len(values)
    centre = summed(lambda c: (c @ white).sum(0), (k,)) / n

    def spread(c: np.ndarray) -> np.ndarray:
        own = c @ white - centre
        return own.T @ own

    error = float(np.abs(summed(spread, (k, k)) / n - np.eye(k)).max())
    model = spark.sparkContext.broadcast((d, n, dtype, rest, mean, white, values / trace, error, residuals))
    return packed.mapInArrow(_whitened(model), schema).withColumnRenamed("_id", id_col)


def _flat(column) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(entries as doubles, offsets, whether a row counts) of a list column; null entries are nan."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    entries = column.flatten().cast(pa.float64()).to_numpy(zero_copy_only=False)
    lengths = np.array(column.value_lengths().fill_null(0))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    bad = np.concatenate([[0], np.cumsum(~(np.abs(entries) < 2.0**42))])
    return entries, offsets, (bad[offsets[1:]] == bad[offsets[:-1]]) & (lengths > 0)


def _matrix(column, d: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows of whole numbers, their places in the batch) of the vectors that count."""
    entries, offsets, ok = _flat(column)
    rows = np.flatnonzero(ok & (np.diff(offsets) == d))
    own = entries if len(rows) == len(ok) else entries[(offsets[rows, None] + np.arange(d)).ravel()]
    return (np.floor(SCALE * own) + SHIFT).astype(np.int64).reshape(-1, d), rows


def _lengths(batches):
    found: dict[int, int] = {}
    for batch in batches:
        _, offsets, ok = _flat(batch.column("_v"))
        for d, n in zip(*np.unique(np.diff(offsets)[ok], return_counts=True), strict=True):
            found[int(d)] = found.get(int(d), 0) + int(n)
    if found:
        yield pa.record_batch([pa.array(list(found), pa.int32()), pa.array(list(found.values()), pa.int64())], ["d", "n"])


def _sums(d: int):
    def run(batches):
        total, low, high = [0] * d, np.full(d, 1 << 62), np.full(d, -(1 << 62))
        seen = False
        for batch in batches:
            x, _ = _matrix(batch.column("_v"), d)
            for at in range(0, len(x), 256):  # below 2 ** 63, as entries are below 2 ** 53
                total = [t + int(s) for t, s in zip(total, x[at : at + 256].sum(0), strict=True)]
            if len(x):
                seen, low, high = True, np.minimum(low, x.min(0)), np.maximum(high, x.max(0))
        if seen:
            from decimal import Decimal

            yield pa.record_batch([pa.array(range(d), pa.int32()), pa.array([Decimal(t) for t in total], pa.decimal128(38, 0)), pa.array(low), pa.array(high)], ["i", "s", "low", "high"])

    return run


def _packed(d: int, base: np.ndarray, dtype):
    def run(batches):
        for batch in batches:
            x, rows = _matrix(batch.column("_v"), d)
            z = (x - base).astype(dtype)
            yield pa.record_batch([batch.column("_id").take(pa.array(rows)), W.binary(list(z))], ["_id", "z"])

    return run


def _summed(of, d: int, dtype, mean: np.ndarray, shape: tuple[int, ...]):
    def run(batches):
        total, seen = np.zeros(shape), False
        for batch in batches:
            z = W.unpack(batch.column("z"), dtype).reshape(-1, d)
            for at in range(0, len(z), 4096):
                total = total + of(z[at : at + 4096] - mean)
                seen = True
        if seen:
            yield pa.record_batch([pa.array([np.ascontiguousarray(total).tobytes()], pa.binary())], ["value"])

    return run


def _whitened(model):
    def run(batches):
        d, n, dtype, rest, mean, white, explained, error, residuals = model.value
        k = len(explained)
        for batch in batches:
            z = W.unpack(batch.column("z"), dtype).reshape(-1, d)
            own = (z - mean) @ white
            with np.errstate(over="ignore"):
                exact = n * z.astype(np.int64) - rest
                deviation = (exact * exact).sum(1)
            size = ((n * z.astype(float) - rest) ** 2).sum(1)
            rows = np.repeat(np.arange(len(z)), k)
            columns = [
                batch.column("_id").take(pa.array(rows)),
                pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(z))),
                pa.array(np.full(len(rows), n)),
                pa.array(deviation[rows], pa.int64(), mask=(size >= 2.0**63 * (1 - 1e-9))[rows]),
                pa.array(own.ravel()),
                pa.array(np.tile(explained, len(z))),
                pa.array(np.full(len(rows), error)),
                pa.array(np.tile(residuals, len(z))),
            ]
            yield pa.record_batch(columns, ["_id", "component", "n", "deviation", "whitened", "explained", "identity_error", "residual"])

    return run
