"""Whitening of embeddings by a bidiagonal qd solver (operator 13).

Entries are rounded down to a grid: x = floor(grid * entry) + ``OFFSET``, as long. The fit list
is each distinct x vector once. From it come

* n and the sums S, exact integers, so that a centred row is (n * x - S) / n, rounded once;
* R of the centred rows: each task reduces its rows block by block by QR, and triangles are
  stacked and reduced again, ``FAN`` tasks at a time, until one is left. Nothing is squared,
  so small singular values keep their accuracy. Only that triangle comes to the driver;
* its bidiagonal form by Householder reflections, the singular values of that by dqds, with
  high relative accuracy, and for each of the largest its vector by a twisted factorisation.
  Values that lie close together are told apart by representations shifted next to them; what
  agrees to the last digits is made orthogonal.

A component is a unit eigenvector of the covariance (divisor n); its entry of largest
magnitude is positive. Directions without variance cannot be whitened: components end before
them, so a table of equal vectors has rows of the model but no component.

Vectors that are null, empty, or hold null or non-finite entries are dropped, and so are those
whose length is not the most frequent one (of equally frequent ones the greater). Entries
beyond the range of a long count as its bounds. Repeated rows and ids are all kept. An empty
table gives an empty one; of further columns only ``carry`` is kept. A deviation that does not
fit into a long is null.
"""

from __future__ import annotations

import io
import math
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .common import fields_of, matrix, stored

GRID, OFFSET = 64, 1_000_000
EDGE = 2.0 ** 62  # entries are held within the longs
FAN = 32  # partial results that one task combines
BLOCK_VALUES = 1 << 20  # entries of a block of rows
EPS = np.finfo(float).eps


# --- bidiagonal form -------------------------------------------------------------------

def bidiagonal(r: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(diagonal, superdiagonal, V) with r = U B V' by Householder reflections."""
    a = np.array(r, float)
    n = a.shape[1]
    v = np.eye(n)
    for k in range(n):
        w, tau = reflector(a[k:, k])
        a[k:, k:] -= tau * np.outer(w, w @ a[k:, k:])
        if k < n - 2:
            w, tau = reflector(a[k, k + 1:])
            a[k:, k + 1:] -= tau * np.outer(a[k:, k + 1:] @ w, w)
            v[:, k + 1:] -= tau * np.outer(v[:, k + 1:] @ w, w)
    return np.diagonal(a).copy(), np.diagonal(a, 1).copy(), v


def reflector(x: np.ndarray) -> tuple[np.ndarray, float]:
    """w and tau of I - tau w w' that maps x to a multiple of the first unit vector."""
    top = np.abs(x).max(initial=0.0)
    if top == 0:
        return np.zeros(len(x)), 0.0
    w = x / top
    w[0] += math.copysign(np.linalg.norm(w), w[0])
    return w, 2 / float(w @ w)


# --- singular values: dqds -------------------------------------------------------------

def dqds_step(q: list[float], e: list[float], shift: float):
    """One transform to q, e of the shifted matrix, and the smallest of its d; None if the
    shift went past the smallest value."""
    d = q[0] - shift
    low, qs, es = d, [], []
    for k in range(len(e)):
        if d < 0:
            return None
        top = d + e[k]
        if top == 0:
            return None if shift else ([*qs, 0.0, *q[k + 1:]], [*es, 0.0, *e[k + 1:]], 0.0)
        ratio = q[k + 1] / top
        qs.append(top)
        es.append(e[k] * ratio)
        d = d * ratio - shift
        low = min(low, d)
    return None if d < 0 else ([*qs, d], es, low)


def dqds(diagonal: np.ndarray, above: np.ndarray) -> np.ndarray:
    """Squares of the singular values of a bidiagonal matrix, falling."""
    found = []
    todo = [([float(x) ** 2 for x in diagonal], [float(x) ** 2 for x in above], 0.0)]
    while todo:
        q, e, base = todo.pop()
        while q:
            n = len(q)
            if n == 1:
                found.append(base + q[0])
                break
            cut = next((k for k in range(n - 2, -1, -1)
                        if e[k] <= EPS * EPS * (base + min(q[k], q[k + 1]))), None)
            if cut == n - 2:
                found.append(base + q.pop())
                e.pop()
                continue
            if cut is not None:
                todo.append((q[:cut + 1], e[:cut], base))
                q, e = q[cut + 1:], e[cut + 1:]
                continue
            if 1.5 * q[0] < q[-1]:  # small values are found fastest at the end
                q, e = q[::-1], e[::-1]
            for shift in shifts(q, e):
                made = dqds_step(q, e, shift)
                if made:
                    (q, e, _), base = made, base + shift
                    break
    return np.sort(np.array(found))[::-1]


def shifts(q: list[float], e: list[float]) -> Iterator[float]:
    """Guesses below the smallest value: from the last two rows, then smaller, at last zero."""
    a, b, c = q[-2] + (e[-3] if len(e) > 2 else 0.0), q[-2] * e[-1], q[-1] + e[-1]
    half = (a - c) / 2
    root = math.hypot(half, math.sqrt(b))
    low = c - b / (half + root) if half + root > 0 else 0.0
    guess = max(0.0, min(low, q[-1]))
    for factor in (1 - 4 * EPS, 0.75, 0.25, 0.01):
        if guess * factor > 0:
            yield guess * factor
    yield 0.0


# --- singular vectors: twisted factorisations ------------------------------------------

def twisted(d: np.ndarray, low: np.ndarray, at: float) -> tuple[np.ndarray, float, float]:
    """Eigenvector of L D L' to the value ``at``: the stationary qd transform from the top and
    the progressive one from the bottom meet where the twist is smallest. Returns the unit
    vector, the correction to the value and the residual."""
    n = len(d)
    upper, lower = np.empty(max(0, n - 1)), np.empty(max(0, n - 1))
    s, p = np.empty(n), np.empty(n)
    s[0] = -at
    tiny = EPS * EPS * (abs(at) + float(np.abs(d).max()))
    for k in range(n - 1):
        pivot = s[k] + d[k]
        pivot = pivot if abs(pivot) > tiny else math.copysign(tiny, pivot)
        upper[k] = d[k] * low[k] / pivot
        s[k + 1] = upper[k] * low[k] * s[k] - at
    p[-1] = d[-1] - at
    for k in range(n - 2, -1, -1):
        pivot = d[k] * low[k] ** 2 + p[k + 1]
        pivot = pivot if abs(pivot) > tiny else math.copysign(tiny, pivot)
        ratio = d[k] / pivot
        lower[k] = low[k] * ratio
        p[k] = p[k + 1] * ratio - at
    twist = s + p + at
    r = int(np.argmin(np.abs(twist)))
    z = np.zeros(n)
    z[r] = 1.0
    for k in range(r - 1, -1, -1):
        z[k] = -upper[k] * z[k + 1]
    for k in range(r, n - 1):
        z[k + 1] = -lower[k] * z[k]
    size = float(z @ z)
    return z / math.sqrt(size), float(twist[r]) / size, abs(float(twist[r])) / math.sqrt(size)


def shifted(d: np.ndarray, low: np.ndarray, by: float) -> tuple[np.ndarray, np.ndarray]:
    """L+ D+ L+' = L D L' - by."""
    n = len(d)
    dp, lp = np.empty(n), np.empty(max(0, n - 1))
    s = -by
    for k in range(n - 1):
        dp[k] = s + d[k]
        if dp[k] == 0:
            dp[k] = EPS * EPS * float(np.abs(d).max())
        lp[k] = d[k] * low[k] / dp[k]
        s = lp[k] * low[k] * s - by
    dp[-1] = s + d[-1]
    return dp, lp


def below(d: np.ndarray, low: np.ndarray, at: float) -> int:
    """Number of eigenvalues of L D L' below ``at`` (negative pivots of the shifted one)."""
    s, count = -at, 0
    for k in range(len(d) - 1):
        pivot = s + d[k]
        if pivot == 0:
            pivot = EPS * EPS * (abs(d[k]) or 1.0)
        count += pivot < 0
        s = d[k] * low[k] / pivot * low[k] * s - at
    return count + (s + d[-1] < 0)


def bisected(d: np.ndarray, low: np.ndarray, index: int, guess: float, width: float) -> float:
    """The eigenvalue with ``index`` smaller ones, relative to the representation."""
    lo, hi, step = guess, guess, max(width, EPS * abs(guess), 1e-300)
    while below(d, low, lo) > index:
        lo, step = lo - step, 2 * step
    step = max(width, EPS * abs(guess), 1e-300)
    while below(d, low, hi) <= index:
        hi, step = hi + step, 2 * step
    while hi - lo > 4 * EPS * max(abs(lo), abs(hi)):
        mid = (lo + hi) / 2
        if mid in (lo, hi):
            break
        lo, hi = (lo, mid) if below(d, low, mid) > index else (mid, hi)
    return (lo + hi) / 2


GAP = 1e-3  # values with less relative distance are not told apart by one representation


def vectors(d: np.ndarray, low: np.ndarray, values: list[tuple[int, float]],
            spread: float, depth: int = 0) -> dict[int, np.ndarray]:
    """Eigenvectors of L D L' for neighbouring ``values`` (number of smaller ones, value).

    Values with a relative gap to their neighbours get theirs from this representation; a
    cluster gets a representation shifted to its end, where its gaps are relatively large."""
    found: dict[int, np.ndarray] = {}
    at = 0
    while at < len(values):
        end = at + 1
        while (end < len(values) and abs(values[end][1] - values[end - 1][1])
               < GAP * max(abs(values[end][1]), abs(values[end - 1][1]))):
            end += 1
        group = values[at:end]
        at = end
        width = abs(group[-1][1] - group[0][1])
        if len(group) == 1 or depth > 8 or width <= 4 * EPS * spread:
            for index, value in group:
                z, change, _ = twisted(d, low, value)
                for _ in range(3):  # Rayleigh corrections
                    if abs(change) <= 2 * EPS * abs(value):
                        break
                    value += change
                    z, change, _ = twisted(d, low, value)
                found[index] = z
            if len(group) > 1:
                found |= orthogonal({i: found[i] for i, _ in group}, d, low, group)
            continue
        by = max(v for _, v in group)
        by += max(EPS * abs(by), width * 1e-3)
        dp, lp = shifted(d, low, by)
        inner = [(i, bisected(dp, lp, i, v - by, EPS * abs(by))) for i, v in group]
        found |= vectors(dp, lp, inner, spread, depth + 1)
    return found


def orthogonal(found, d, low, group) -> dict[int, np.ndarray]:
    """Vectors of values that agree to the last digits: any orthogonal ones of their space, by
    inverse iteration from different starts."""
    kept: list[np.ndarray] = []
    rng = np.random.default_rng(len(d))
    t = np.diag(d) + np.diag(np.append(0.0, d[:-1] * low ** 2))
    t += np.diag(d[:-1] * low, 1) + np.diag(d[:-1] * low, -1)
    for k, (index, value) in enumerate(group):
        z = found[index] if not k else rng.standard_normal(len(d))
        shift = value + (k + 1) * EPS * max(abs(value), float(np.abs(t).max()))
        for _ in range(3):
            z = np.linalg.lstsq(t - shift * np.eye(len(d)), z, rcond=None)[0] if k else z
            for other in kept * 2:
                z = z - (other @ z) * other
            z = z / np.linalg.norm(z)
        kept.append(z)
    return dict(zip((i for i, _ in group), kept, strict=True))


def whitening_directions(r: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(squared singular values, right singular vectors as rows, sum of all squares) of the
    triangle ``r``, for the largest values with variance, at most ``most``."""
    top = float(np.abs(r).max(initial=0.0))
    n = r.shape[1]
    if top == 0:
        return np.zeros(0), np.zeros((0, n)), 0.0
    diagonal, above, v = bidiagonal(r / top)
    floor = EPS * EPS * float(np.abs(diagonal).max())
    diagonal = np.where(np.abs(diagonal) < floor, floor, diagonal)
    squares = dqds(diagonal, above)
    wanted = min(most, int((squares > (8 * n * EPS) ** 2 * squares[0]).sum()))
    blocks, at = [], 0
    for k in [*np.flatnonzero(np.abs(above) <= EPS * EPS * np.sqrt(squares[0])).tolist(), n - 1]:
        blocks.append((at, k + 1))
        at = k + 1
    found: list[tuple[float, np.ndarray]] = []
    for lo, hi in blocks:
        d, low = diagonal[lo:hi] ** 2, above[lo:hi - 1] / diagonal[lo:hi - 1]
        own = squares if len(blocks) == 1 else dqds(diagonal[lo:hi], above[lo:hi - 1])
        last = next((k for k in range(len(own)) if own[k] < squares[wanted - 1] * (1 - GAP)),
                    len(own)) if wanted else 0
        while 0 < last < len(own) and own[last] > own[last - 1] * (1 - GAP):
            last += 1  # whole clusters only
        pairs = [(len(own) - 1 - k, float(own[k])) for k in range(last)]
        for index, z in vectors(d, low, pairs, float(squares[0])).items():
            full = np.zeros(n)
            full[lo:hi] = z
            found.append((float(own[len(own) - 1 - index]), v @ full))
    found.sort(key=lambda f: -f[0])
    found = found[:wanted]
    rows = np.array([z / np.linalg.norm(z) for _, z in found]).reshape(wanted, n)
    rows *= np.sign(rows[np.arange(wanted), np.abs(rows).argmax(1)])[:, None]
    scale = top * top
    return np.array([s for s, _ in found]) * scale, rows, float(squares.sum()) * scale


# --- fit on Spark ----------------------------------------------------------------------

def packed(**arrays: np.ndarray) -> bytes:
    out = io.BytesIO()
    np.savez(out, **arrays)
    return out.getvalue()


def unpacked(blob: bytes) -> dict[str, np.ndarray]:
    return dict(np.load(io.BytesIO(blob)))


def combined(parts: DataFrame, merge: Callable[[Iterator[dict]], dict | None]) -> dict | None:
    """One result of partial ones (part long, blob binary): each round, a task combines those of
    ``FAN`` neighbours one after the other. Only the last one comes to the driver."""
    rounds = stored(parts)
    while True:
        most = rounds.agg(F.max("part")).first()[0]
        if most is None:
            return None
        rounds = rounds.withColumn("part", F.shiftright("part", FAN.bit_length() - 1))
        rounds = stored(rounds.repartition("part").sortWithinPartitions("part")
                        .mapInArrow(reduced(merge), "part long, blob binary"))
        if most < FAN:
            return unpacked(rounds.first()["blob"])


def reduced(merge):
    def reduce(batches):
        held, last = None, None
        for batch in batches:
            for part, blob in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if part != last and held is not None:
                    yield part_batch(last, held)
                    held = None
                last, fresh = part, unpacked(blob)
                held = fresh if held is None else merge(held, fresh)
        if held is not None:
            yield part_batch(last, held)

    return reduce


def part_batch(part: int, arrays: dict) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [pa.array([part], pa.int64()), pa.array([packed(**arrays)], pa.binary())], ["part", "blob"])


def per_task(rows: DataFrame, make, merge) -> DataFrame:
    """Partial results of the tasks that read ``rows`` (x binary), block by block."""
    def work(batches):
        held = None
        for x in blocks_of(batches):
            fresh = make(x)
            held = fresh if held is None else merge(held, fresh)
        if held is not None:
            yield part_batch(TaskContext.get().partitionId(), held)

    return rows.select("x").mapInArrow(work, "part long, blob binary")


def blocks_of(batches) -> Iterator[np.ndarray]:
    for batch in batches:
        if batch.num_rows:
            x = matrix(batch.column(0), np.int64)
            step = max(1, BLOCK_VALUES // x.shape[1])
            for at in range(0, len(x), step):
                yield x[at:at + step]


def sums_of(x: np.ndarray) -> dict:
    # 2^32 * 2^20 rows and more: halves are added apart, so no sum can overflow
    return {"n": np.array([len(x)]), "high": (x >> 32).sum(0), "low": (x & 0xFFFFFFFF).sum(0)}


def add_sums(a: dict, b: dict) -> dict:
    return {k: a[k] + b[k] for k in a}


@dataclass(frozen=True)
class Model:
    """What whitens a vector: n and sums of the fit list, components and their values."""

    n: int
    sums: tuple[int, ...]
    components: np.ndarray  # rows
    values: np.ndarray  # eigenvalues, falling
    trace: float

    def differences(self, x: np.ndarray) -> np.ndarray:
        """n * x - S, exact; Python numbers where longs do not hold them."""
        sums = np.array(self.sums, object)
        reach = self.n * int(max(abs(int(x.min())), abs(int(x.max())))) + int(max(map(abs, sums)))
        if reach < 2 ** 62:
            return self.n * x - sums.astype(np.int64)
        return self.n * x.astype(object) - sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.differences(x).astype(float) / self.n

    def deviations(self, x: np.ndarray) -> list[int | None]:
        d = self.differences(x)
        top = int(max(abs(d.min()), abs(d.max())))
        if top * top * x.shape[1] >= 2 ** 63:
            d = d.astype(object)
        return [int(v) if v < 2 ** 63 else None for v in (d * d).sum(1)]

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x) @ (self.components / np.sqrt(self.values)[:, None]).T


def grid_vector(embedding: Column, grid: int) -> Column:
    """x of the entries; null where a vector is not whole."""
    value = embedding.cast("array<double>")
    finite = F.forall(value, lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf")))
    return F.when((F.size(value) > 0) & finite, F.transform(
        value, lambda c: OFFSET + F.when(F.abs(c) * grid < EDGE, F.floor(c * grid))
        .otherwise(F.signum(c).cast("long") * int(EDGE))))


def grid_vectors(vectors: DataFrame, embedding: str, carry: tuple[str, ...], grid: int) -> DataFrame:
    """Whole vectors of the most frequent length: ``carry`` and x as little-endian longs."""
    rows = vectors.select(*(F.col(c).alias(f"in_{c}") for c in carry),
                          grid_vector(F.col(embedding), grid).alias("values"))
    rows = rows.where(F.col("values").isNotNull()).withColumn("dim", F.size("values"))
    common = (rows.groupBy("dim").agg(F.count("*").alias("n"))
              .orderBy(F.desc("n"), F.desc("dim")).first())
    rows = rows.where(F.col("dim") == (common["dim"] if common else 0)).drop("dim")
    schema = StructType([*rows.drop("values").schema.fields, *fields_of("x binary")])

    def pack(batches):
        for batch in batches:
            lists = batch.column(batch.num_columns - 1)
            flat = lists.flatten().to_numpy(zero_copy_only=False).astype("<i8")
            raw = flat.reshape(batch.num_rows, -1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:-1], pa.array([r.tobytes() for r in raw], pa.binary())],
                schema.names)

    return rows.mapInArrow(pack, schema)


def fit(rows: DataFrame, most: int = 16) -> Model | None:
    """The model of a table of x vectors, and None for an empty one."""
    total = combined(per_task(rows, sums_of, add_sums), add_sums)
    if total is None:
        return None
    n = int(total["n"][0])
    sums = tuple((int(h) << 32) + int(w) for h, w in zip(total["high"], total["low"], strict=True))
    dim = len(sums)
    plain = Model(n, sums, np.zeros((0, dim)), np.zeros(0), 0.0)

    def triangle(x):
        return {"r": np.linalg.qr(plain.centred(x), mode="r")}

    def stack(a, b):
        return {"r": np.linalg.qr(np.concatenate([a["r"], b["r"]]), mode="r")}

    r = combined(per_task(rows, triangle, stack), stack)["r"]
    squares, components, trace = whitening_directions(
        np.concatenate([r, np.zeros((max(0, dim - len(r)), dim))]), most)
    return Model(n, sums, components, squares / n, trace / n)


def identity_error(rows: DataFrame, model: Model) -> float | None:
    """Largest difference between the covariance of the whitened fit list and the identity.
    Each block is centred before it is multiplied, and so are blocks when they are merged."""
    if not len(model.values):
        return None

    def scatter(x):
        w = model.whitened(x)
        mean = w.mean(0)
        return {"n": np.array([len(w)]), "mean": mean, "m": (w - mean).T @ (w - mean)}

    def merge(a, b):
        na, nb = float(a["n"][0]), float(b["n"][0])
        apart = b["mean"] - a["mean"]
        return {"n": a["n"] + b["n"], "mean": a["mean"] + apart * (nb / (na + nb)),
                "m": a["m"] + b["m"] + np.outer(apart, apart) * (na * nb / (na + nb))}

    whole = combined(per_task(rows, scatter, merge), merge)
    return float(np.abs(whole["m"] / model.n - np.eye(len(model.values))).max())


def whiten(vectors: DataFrame, embedding: str = "embedding", carry: tuple[str, ...] = ("vec_id",),
           most: int = 16, grid: int = GRID) -> DataFrame:
    """``carry``, n, deviation, whitened array<double>, explained array<double> and
    identity_error of every whole vector."""
    rows = stored(grid_vectors(vectors, embedding, carry, grid))
    distinct = stored(rows.select("x").distinct())
    model = fit(distinct, most)
    error = identity_error(distinct, model) if model else None
    schema = StructType([*rows.drop("x").schema.fields,
                         *fields_of("n long, deviation long, whitened array<double>")])

    def project(batches):
        for whole in batches:
            for at in range(0, whole.num_rows, 4096):
                batch = whole.slice(at, 4096)
                x = matrix(batch.column(batch.num_columns - 1), np.int64)
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns[:-1], pa.array([model.n] * len(x), pa.int64()),
                     pa.array(model.deviations(x), pa.int64()),
                     pa.array(list(model.whitened(x)), pa.list_(pa.float64()))], schema.names)

    explained = [float(e) / model.trace for e in model.values] if model else []
    return (rows.mapInArrow(project, schema)
            .select(*(F.col(f"in_{c}").alias(c) for c in carry), "n", "deviation", "whitened",
                    F.array(*(F.lit(e) for e in explained)).cast("array<double>").alias("explained"),
                    F.lit(error).cast("double").alias("identity_error")))


def component_rows(whitened: DataFrame) -> DataFrame:
    """One row per vector and component, numbered from 1."""
    others = [c for c in whitened.columns if c not in ("whitened", "explained")]
    both = F.arrays_zip("whitened", "explained")
    return whitened.select(*others, F.posexplode(both).alias("k", "at")).select(
        *others, (F.col("k") + 1).alias("component"), F.col("at.whitened").alias("whitened"),
        F.col("at.explained").alias("explained"))
