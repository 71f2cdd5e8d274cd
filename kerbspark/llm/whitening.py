"""Whitening of embeddings by a bidiagonal qd solver.

Distinct vectors are centred and reduced by blockwise QR: each task folds its
rows into one triangle, and triangles are folded by the same step in rounds of
bounded groups until one is left. It is no larger than the number of dimensions
squared, whatever the number of rows, and no covariance is formed, so small
singular values keep their digits. Householder reflections make it bidiagonal,
the differential qd algorithm with shifts (dqds) finds its singular values, and
twisted factorisations of the shifted matrix give their right vectors.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Rows that one step of a QR reduction takes at a time, and triangles that one task folds.
QR_ROWS, FAN_IN = 4096, 32
EPS = float(np.finfo(np.float64).eps)
LONG = (1 << 63) - 1


def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) of an upper bidiagonal B with R = U B V' by Householder reflections; U is not kept."""
    a = np.array(r, np.float64)
    n = a.shape[1]
    v_all = np.eye(n)

    def reflector(x: np.ndarray) -> np.ndarray | None:
        size = np.abs(x).max(initial=0.0)
        if size == 0.0 or len(x) < 2:
            return None
        v = x / size
        v[0] += np.copysign(np.linalg.norm(v), v[0])
        return v / np.linalg.norm(v)

    for k in range(n):
        v = reflector(a[k:, k].copy())
        if v is not None:
            a[k:, k:] -= 2 * np.outer(v, v @ a[k:, k:])
        v = reflector(a[k, k + 1 :].copy())
        if v is not None:
            a[k:, k + 1 :] -= 2 * np.outer(a[k:, k + 1 :] @ v, v)
            v_all[:, k + 1 :] -= 2 * np.outer(v_all[:, k + 1 :] @ v, v)
    return np.diag(a).copy(), np.diag(a, 1).copy(), v_all


def _sweep(q: list[float], e: list[float], shift: float) -> tuple[list[float], list[float]] | None:
    """One dqds transform of the squared bidiagonal, or None if ``shift`` is above its smallest eigenvalue."""
    qs, es, d = [], [], q[0] - shift
    for i in range(len(e)):
        if d < 0.0:
            return None
        up = d + e[i]
        ratio = q[i + 1] / up if up else 0.0
        qs.append(up)
        es.append(e[i] * ratio)
        d = d * ratio - shift
    return None if d < 0.0 else ([*qs, d], es)


def _block_values(q: list[float], e: list[float]) -> list[float]:
    """Eigenvalues of an unreduced block given by squared diagonals; deflates from its lower end."""
    found: list[float] = []
    total = 0.0  # of the shifts so far
    while q:
        n = len(q)
        if n == 1:
            found.append(total + q.pop())
            continue
        if e[-1] <= EPS * EPS * (total + q[-1]) or e[-1] == 0.0:
            found.append(total + q.pop())
            e.pop()
            continue
        cut_at = next((i for i in range(n - 2, -1, -1) if e[i] <= EPS * EPS * (total + min(q[i], q[i + 1]))), None)
        if cut_at is not None:
            found += [total + x for x in _block_values(q[cut_at + 1 :], e[cut_at + 1 :])]
            q, e = q[: cut_at + 1], e[:cut_at]
            continue
        if q[0] * 4 < q[-1]:  # graded the wrong way: turned over its second diagonal it is a bidiagonal of the same values
            q, e = q[::-1], e[::-1]
        # the smaller eigenvalue of the last two rows of L'L guides the shift
        a, b, c = q[-2] + (e[-2] if n > 2 else 0.0), q[-2] * e[-1], q[-1] + e[-1]
        half = (a + c) / 2
        low = (a * c - b) / (half + np.sqrt(max(((a - c) / 2) ** 2 + b, 0.0))) if half else 0.0
        shift = max(0.0, low)
        for part in (1.0, 0.9, 0.5, 0.1, 0.0):  # without a shift a sweep always goes through
            made = _sweep(q, e, shift * part)
            if made:
                shift *= part
                break
        q, e = made
        total += shift
    return found


def singular_values(diagonal: np.ndarray, upper: np.ndarray) -> np.ndarray:
    """Singular values of an upper bidiagonal, largest first, by dqds."""
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0))
    if scale == 0.0:
        return np.zeros(len(diagonal))
    # an exact zero on the diagonal would stop the quotients; one far below rounding changes no digit
    q = [max(float(x) ** 2, (EPS * 1e-3) ** 2) for x in diagonal / scale]
    e = [float(x) ** 2 for x in upper / scale]
    values = _block_values(q, e)
    return scale * np.sqrt(np.sort(np.maximum(values, 0.0))[::-1])


def _twisted(a: np.ndarray, b: np.ndarray, value: float, rank: int) -> np.ndarray:
    """The vector of B'B at eigenvalue ``value`` from the twisted factorisation with the ``rank``-th smallest twist."""
    n = len(a)
    diag = a * a
    diag[1:] += b * b
    off = a[:-1] * b
    tiny = EPS * EPS * max(diag.max(), value, 1e-200)
    down, up = np.empty(n), np.empty(n)
    down[0] = diag[0] - value or tiny
    for i in range(1, n):
        down[i] = diag[i] - value - off[i - 1] * off[i - 1] / down[i - 1] or tiny
    up[-1] = diag[-1] - value or tiny
    for i in range(n - 2, -1, -1):
        up[i] = diag[i] - value - off[i] * off[i] / up[i + 1] or tiny
    twist = np.abs(down + up - (diag - value))
    k = int(np.argsort(twist, kind="stable")[min(rank, n - 1)])
    z = np.zeros(n)
    z[k] = 1.0
    for i in range(k - 1, -1, -1):
        z[i] = -off[i] / down[i] * z[i + 1]
    for i in range(k + 1, n):
        z[i] = -off[i - 1] / up[i] * z[i - 1]
    return z / np.linalg.norm(z)


def right_vectors(diagonal: np.ndarray, upper: np.ndarray, values: np.ndarray, count: int) -> np.ndarray:
    """Right singular vectors, one a column, of the ``count`` largest of ``values``.

    Each comes from a twisted factorisation. Vectors of values so close that
    they lose their right angle are cleared of the earlier ones and taken from
    the next twist, or from a unit vector if the values agree in all digits.
    """
    n = len(diagonal)
    scale = max(np.abs(diagonal).max(initial=0.0), np.abs(upper).max(initial=0.0)) or 1.0
    a, b = diagonal / scale, upper / scale
    out: list[np.ndarray] = []
    dense = np.diag(a) + np.diag(b, 1) if n > 1 else np.diag(a)

    def cleared(z: np.ndarray) -> np.ndarray:
        for _ in range(2):
            for y in out:
                z = z - (y @ z) * y
        return z

    for j in range(count):
        value, best = float(values[j] / scale) ** 2, None
        for rank in range(min(n, 8)):
            z = cleared(_twisted(a, b, value, rank))
            size = np.linalg.norm(z)
            if size < 1e-3:
                continue
            z /= size
            away = np.linalg.norm(dense.T @ (dense @ z) - value * z)
            if best is None or away < best[0]:
                best = (away, z)
            if away <= 64 * n * EPS:
                break
        if best is None:
            z = max((cleared(row) for row in np.eye(n)), key=np.linalg.norm)
            best = (0.0, z / np.linalg.norm(z))
        out.append(best[1])
    return np.array(out).T


def directions(r: np.ndarray, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(singular values, right vectors as columns, sum of all squared singular values) of the ``count`` largest of a triangle."""
    diagonal, upper, v = bidiagonal(r)
    values = singular_values(diagonal, upper)
    return values[:count], v @ right_vectors(diagonal, upper, values, min(count, len(values))), float(np.sum(values**2))


def _matrix(column: pa.Array, width: int) -> np.ndarray:
    """Lists of longs as rows of ``width``; shorter ones end in zeros."""
    lists = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    size = np.diff(lists.offsets.to_numpy()).astype(np.int64)
    out = np.zeros((len(lists), width), np.int64)
    out[np.repeat(np.arange(len(lists)), size), np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)] = lists.flatten().to_numpy()
    return out


def _exact(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - sums, in 64 bits where these suffice, else in whole numbers of any size."""
    if n * max(int(np.abs(x).max(initial=0)), 1) + max(map(abs, sums), default=0) < LONG and np.abs(x).min(initial=0) >= 0:
        return n * x - np.array(sums, np.int64)
    return n * x.astype(object) - np.array(sums, object)


def _centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    return (_exact(x, n, sums) / n).astype(np.float64)


def _folded(parts: Iterator[np.ndarray], width: int) -> np.ndarray:
    """The triangle of all rows of ``parts``, by QR of blocks under the triangle so far."""
    r = np.zeros((0, width))
    for rows in parts:
        for at in range(0, len(rows), QR_ROWS):
            r = np.linalg.qr(np.concatenate([r, rows[at : at + QR_ROWS]]), mode="r")
    return r


def _square(r: np.ndarray, width: int) -> np.ndarray:
    return np.concatenate([r, np.zeros((max(0, width - len(r)), width))])


def triangle(rows: DataFrame, n: int, sums: list[int]) -> np.ndarray:
    """R of the QR factorisation of all centred ``rows`` (x array<long>), of shape (dimensions, dimensions)."""
    width = len(sums)

    def fold(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = _folded((_centred(_matrix(b.column("x"), width), n, sums) for b in batches), width)
        if len(r):
            yield pa.RecordBatch.from_arrays([pa.array([r.tobytes()], pa.binary())], ["r"])

    def join(group: pa.Table) -> pa.Table:
        r = _folded((np.frombuffer(x, np.float64).reshape(-1, width) for x in group.column("r").to_pylist()), width)
        return pa.table({"r": pa.array([r.tobytes()], pa.binary())})

    left = cut(rows.mapInArrow(fold, "r binary"))
    count = left.count()
    while count > FAN_IN:
        groups = -(-count // FAN_IN)
        left = cut(left.withColumn("g", F.pmod(F.xxhash64("r"), F.lit(groups))).groupBy("g").applyInArrow(join, "r binary"))
        count = left.count()
    parts = [np.frombuffer(row["r"], np.float64).reshape(-1, width) for row in left.collect()]  # FAN_IN triangles at most
    parts.sort(key=lambda p: p.tobytes())  # the same order for any order of tasks
    return _square(_folded(iter(parts), width), width)


def whiten(vectors: DataFrame, *, key: str = "vec_id", vector: str = "embedding", components: int = 4) -> DataFrame:
    """(key, component, n, deviation, whitened, explained, identity_error) of each row and each of the first ``components``.

    Entries become whole numbers floor(256 * c). Mean, triangle and components
    are fitted over each distinct vector once, and applied to every row.
    ``identity_error`` is measured over these vectors in a pass of its own.

    Cases: a row whose vector is null or holds a null, NaN or infinite entry is
    left out; a vector shorter than the longest counts as ending in zeros, an
    empty one as zeros; there are no more components than dimensions; a
    component without variance has a null ``whitened`` and is left out of
    ``identity_error``, and with no variance at all ``explained`` is null;
    ``deviation`` is null where it exceeds a long; rows that repeat, and null
    keys, are rows of their own; other columns are ignored, whatever their
    names; an empty table gives an empty table.
    """
    schema = f"{key} long, component int, n long, deviation long, whitened double, explained double, identity_error double"
    entry = lambda c: c.cast("double")
    finite = F.forall("v", lambda c: F.coalesce(F.abs(entry(c)) < float("inf"), F.lit(False)))
    kept = vectors.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("v")).where(F.col("v").isNotNull() & finite)
    # floor of a double gives a long, and ends with the range of a long
    whole = kept.select("id", F.transform("v", lambda c: F.floor(entry(c) * 256)).alias("x"))
    fit = cut(whole.select("x").distinct())
    width = fit.agg(F.max(F.size("x"))).first()[0] or 0
    spark = vectors.sparkSession
    if not width:
        return spark.createDataFrame([], schema)

    if fit.where(F.size("x") < width).limit(1).count():  # vectors of several lengths may be equal once they end in zeros
        padded = F.concat("x", F.array_repeat(F.lit(0).cast("long"), F.lit(width) - F.size("x")))
        fit = cut(fit.select(padded.alias("x")).distinct())

    def totals(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("x"), width)
            s = x.sum(axis=0) if np.abs(x).max(initial=0) < LONG // max(len(x), 1) else x.astype(object).sum(axis=0)
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(width, dtype=np.int32)), pa.array([str(int(v)) for v in s]), pa.array(np.full(width, len(x), np.int64))], ["at", "s", "n"])

    sums_by = fit.mapInArrow(totals, "at int, s string, n long").groupBy("at").agg(F.sum(F.col("s").cast("decimal(38,0)")).alias("s"), F.sum("n").alias("n")).collect()
    n, sums = int(sums_by[0]["n"]), [int(r["s"]) for r in sorted(sums_by, key=lambda r: r["at"])]

    count = min(components, width)
    values, axes, total = directions(triangle(fit, n, sums), count)
    alive = values > width * EPS * max(float(values[0]), 0.0) if len(values) else np.zeros(0, bool)
    scale = np.where(alive, np.sqrt(n) / np.where(alive, values, 1.0), 0.0)
    onto = axes * scale[None, :]
    explained = values**2 / total if total > 0 else np.full(count, np.nan)

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows, means and centred products of the whitened vectors of a task, merged batch by batch."""
        m, mean, product = 0, np.zeros(count), np.zeros((count, count))
        for batch in batches:
            w = _centred(_matrix(batch.column("x"), width), n, sums) @ onto
            if len(w):
                m, mean, product = _merged((m, mean, product), (len(w), w.mean(axis=0), (w - w.mean(axis=0)).T @ (w - w.mean(axis=0))))
        if m:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate([[m], mean, product.ravel()]).tobytes()], pa.binary())], ["part"])

    def merge(group: pa.Table) -> pa.Table:
        parts = sorted(group.column("part").to_pylist())
        whole_part = (0, np.zeros(count), np.zeros((count, count)))
        for p in parts:
            row = np.frombuffer(p, np.float64)
            whole_part = _merged(whole_part, (int(row[0]), row[1 : 1 + count], row[1 + count :].reshape(count, count)))
        m, mean, product = whole_part
        return pa.table({"part": pa.array([np.concatenate([[m], mean, product.ravel()]).tobytes()], pa.binary())})

    parts = fit.mapInArrow(spread, "part binary").withColumn("g", F.pmod(F.xxhash64("part"), F.lit(FAN_IN))).groupBy("g").applyInArrow(merge, "part binary").collect()
    row = np.frombuffer(merge(pa.table({"part": pa.array([p["part"] for p in parts], pa.binary())})).column("part")[0].as_py(), np.float64)
    off = np.abs(row[1 + count :].reshape(count, count) / n - np.eye(count))[np.ix_(alive, alive)]
    error = float(off.max()) if off.size else None

    def apply(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole_batch in batches:
            for at in range(0, whole_batch.num_rows, QR_ROWS):
                batch = whole_batch.slice(at, QR_ROWS)
                x = _matrix(batch.column("x"), width)
                away = _exact(x, n, sums)
                w = (away / n).astype(np.float64) @ onto
                biggest = max(int(np.abs(away).max(initial=0)), 1) if away.size else 1
                if biggest * biggest * width < LONG:
                    deviation = pa.array((away * away).sum(axis=1).astype(np.int64))
                else:
                    deviation = pa.array([d if d <= LONG else None for d in (sum(int(v) ** 2 for v in r) for r in away)], pa.int64())
                twice = pa.array(np.repeat(np.arange(len(x)), count))
                gone = ~np.tile(alive, len(x))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("id").take(twice),
                        pa.array(np.tile(np.arange(1, count + 1, dtype=np.int32), len(x))),
                        pa.array(np.full(len(twice), n, np.int64)),
                        deviation.take(twice),
                        pa.array(w.ravel(), mask=gone),
                        pa.array(np.tile(explained, len(x)), mask=np.isnan(np.tile(explained, len(x)))),
                        pa.array([error] * len(twice), pa.float64()),
                    ],
                    [key, "component", "n", "deviation", "whitened", "explained", "identity_error"],
                )

    return whole.mapInArrow(apply, schema)


def _merged(a: tuple[int, np.ndarray, np.ndarray], b: tuple[int, np.ndarray, np.ndarray]) -> tuple[int, np.ndarray, np.ndarray]:
    """(rows, mean, centred products) of two sets of rows together."""
    n = a[0] + b[0]
    apart = b[1] - a[1]
    return n, a[1] + apart * (b[0] / n), a[2] + b[2] + np.outer(apart, apart) * (a[0] * b[0] / n)
