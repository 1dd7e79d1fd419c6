"""Embedding whitening: the scatter matrix as exact integers, decomposed only once it is whole."""

from __future__ import annotations

from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import spill, table

#: Bits of a limb; whole numbers of any size are sums of limbs times powers of 2**LIMB.
LIMB = 20
#: Rows that are multiplied at once: products of limbs are below 2**40, so their sums stay below 2**52.
BLOCK = 4096
#: Entries of the scatter matrix that travel in one row.
STRIPE = 1 << 16
SCALE = 256.0

_ROWS = "vec_id long, dim int, x binary"
_PARTS = "dim int, stripe int, salt int, n long, limbs binary"
_MODEL = "dim int, n long, sums array<string>, axes binary, lengths binary, explained binary"
_OUT = "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """floor(256 * c) of each whole vector, as bytes of the narrowest integers that hold them all, so equal vectors are equal bytes."""
    for batch in batches:
        column = batch["embedding"]
        if isinstance(column, pa.ChunkedArray):
            column = column.combine_chunks()
        sizes = np.nan_to_num(column.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
        flat = column.flatten()
        values = np.asarray(flat.fill_null(float("nan")), np.float64) * SCALE
        row = np.repeat(np.arange(len(sizes)), sizes)
        fits = np.isfinite(values) & (np.abs(values) < 2.0**63)
        bad = np.bincount(row[~fits], minlength=len(sizes)) > 0
        use = np.flatnonzero(~bad & (sizes > 0))
        starts = np.cumsum(sizes) - sizes
        whole = np.where(fits, np.floor(np.where(fits, values, 0)), 0).astype(np.int64)
        out = []
        for i in use.tolist():
            own = whole[starts[i] : starts[i] + sizes[i]]
            low, high = int(own.min()), int(own.max())
            width = next(w for w in (1, 2, 4, 8) if -(1 << (8 * w - 1)) <= low and high < 1 << (8 * w - 1))
            out.append(own.astype(f"<i{width}").tobytes())
        yield pa.RecordBatch.from_arrays([batch["vec_id"].take(pa.array(use)), pa.array(sizes[use], pa.int32()), pa.array(out, pa.binary())], ["vec_id", "dim", "x"])


def _blocks(dims: list[int], packed: list[bytes]) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(dim, rows, vectors) of packed vectors, by length and width, in blocks."""
    dim = np.array(dims, np.int64)
    width = np.array([len(x) for x in packed], np.int64) // np.maximum(dim, 1)
    for d, w in sorted(set(zip(dim.tolist(), width.tolist(), strict=True))):
        rows = np.flatnonzero((dim == d) & (width == w))
        for a in range(0, len(rows), BLOCK):
            part = rows[a : a + BLOCK]
            yield d, part, np.frombuffer(b"".join(packed[i] for i in part.tolist()), f"<i{w}").reshape(-1, d).astype(np.int64)


def _limbs(x: np.ndarray, n: int) -> list[np.ndarray]:
    """Doubles whose sum times powers of 2**LIMB is x; all but the last are not negative."""
    return [((x >> (LIMB * i)) & ((1 << LIMB) - 1) if i < n - 1 else x >> (LIMB * i)).astype(np.float64) for i in range(n)]


class _Whole:
    """An array of unbounded integers as limbs, to which arrays are added at any limb."""

    def __init__(self) -> None:
        self.limbs: list[np.ndarray] = []

    def add(self, at: int, x: np.ndarray) -> None:
        while len(self.limbs) <= at + 2:
            self.limbs.append(np.zeros(x.shape, np.int64))
        self.limbs[at] += x
        # Limbs below the last stay below 2**LIMB, so no sum of partial results is too large for a long.
        for i in range(at, len(self.limbs) - 1):
            self.limbs[i + 1] += self.limbs[i] >> LIMB
            self.limbs[i] &= (1 << LIMB) - 1

    def value(self) -> np.ndarray:
        total = np.zeros(self.limbs[0].shape, object)
        for i, limb in enumerate(self.limbs):
            total += limb.astype(object) * (1 << (LIMB * i))
        return total


def _scatter(batches: Iterator[pa.RecordBatch], shifts: Broadcast) -> Iterator[pa.RecordBatch]:
    """Of a task's vectors less the shift of their length: number, sums (stripe -1) and cross-products, as limbs."""
    sums: dict[int, _Whole] = {}
    products: dict[int, _Whole] = {}
    counts: dict[int, int] = {}
    for batch in batches:
        for d, _, x in _blocks(batch["dim"].to_pylist(), batch["x"].to_pylist()):
            shift = shifts.value[d]
            most = max(int(x.max()), int(shift.max()), -int(x.min()), -int(shift.min()))
            n = 1 if most < 1 << 18 else 2 if most < 1 << 38 else 4
            y = [a - b for a, b in zip(_limbs(x, n), _limbs(shift, n), strict=True)]
            s, m = sums.setdefault(d, _Whole()), products.setdefault(d, _Whole())
            counts[d] = counts.get(d, 0) + len(x)
            for i in range(n):
                s.add(i, y[i].sum(0).astype(np.int64))
                for j in range(n):
                    m.add(i + j, (y[i].T @ y[j]).astype(np.int64))
    salt = (TaskContext.get().partitionId() if TaskContext.get() else 0) % 256
    for d, n in counts.items():
        yield _part(d, -1, salt, n, np.stack(sums[d].limbs))
        step = max(1, STRIPE // d)
        for k, a in enumerate(range(0, d, step)):
            yield _part(d, k, salt, 0, np.stack([x[a : a + step].ravel() for x in products[d].limbs]))


def _part(dim: int, stripe: int, salt: int, n: int, limbs: np.ndarray) -> pa.RecordBatch:
    told = np.int64(len(limbs)).tobytes() + limbs.tobytes()
    return pa.RecordBatch.from_pylist([{"dim": dim, "stripe": stripe, "salt": salt, "n": n, "limbs": told}], pa.schema([("dim", pa.int32()), ("stripe", pa.int32()), ("salt", pa.int32()), ("n", pa.int64()), ("limbs", pa.binary())]))


def _limbs_of(told: bytes) -> np.ndarray:
    return np.frombuffer(told, np.int64, -1, 8).reshape(int(np.frombuffer(told, np.int64, 1)[0]), -1)


def _summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows that come sorted by (dim, stripe, salt), added up; one sum is held at a time."""
    key, n, total = None, 0, _Whole()
    for batch in batches:
        for row in batch.to_pylist():
            own = (row["dim"], row["stripe"], row["salt"])
            if own != key:
                if key is not None:
                    yield _part(*key, n, np.stack(total.limbs))
                key, n, total = own, 0, _Whole()
            n += row["n"]
            for i, x in enumerate(_limbs_of(row["limbs"])):
                total.add(i, x)
    if key is not None:
        yield _part(*key, n, np.stack(total.limbs))


def decompose(n: int, sums: np.ndarray, products: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first k unit axes, the square roots of their eigenvalues (0: none within rounding) and their shares of the trace.

    sums and products are unbounded integers; entries of n * products - sums * sums' are whole and
    exact, and each is rounded once, as it is divided by n * n.
    """
    scatter = products * n - np.multiply.outer(sums, sums)
    cov = np.array([[v / (n * n) for v in row] for row in scatter.tolist()])
    values, axes = np.linalg.eigh(cov)
    order = np.argsort(-values, kind="stable")[:k]
    values, axes = values[order], axes[:, order].T
    trace = sum(scatter[i, i] for i in range(len(scatter))) / (n * n)
    least = len(cov) * np.finfo(float).eps * max(float(values[0]), 0.0)
    lengths = np.sqrt(np.where(values > least, values, 0.0))
    return axes, lengths, values / trace if trace else np.full(len(values), np.nan)


def _model(group: pa.Table, shifts: Broadcast, k: int) -> pa.Table:
    rows = sorted(group.to_pylist(), key=lambda r: r["stripe"])
    d, n = rows[0]["dim"], rows[0]["n"]
    held = []
    for r in rows:
        whole = _Whole()
        whole.limbs = list(_limbs_of(r["limbs"]))
        held.append(whole.value())
    axes, lengths, explained = decompose(n, held[0], np.concatenate(held[1:]).reshape(d, d), k)
    sums = [str(int(a) + n * int(b)) for a, b in zip(held[0], shifts.value[d], strict=True)]
    made = {"dim": d, "n": n, "sums": sums, "axes": axes.tobytes(), "lengths": lengths.tobytes(), "explained": explained.tobytes()}
    return pa.Table.from_pylist([made], pa.schema([("dim", pa.int32()), ("n", pa.int64()), ("sums", pa.list_(pa.string())), ("axes", pa.binary()), ("lengths", pa.binary()), ("explained", pa.binary())]))


class Axes:
    """The fitted axes of one length of vectors."""

    def __init__(self, row):
        self.n, self.sums = row["n"], [int(s) for s in row["sums"]]
        self.axes = np.frombuffer(row["axes"]).reshape(-1, row["dim"])
        self.lengths, self.explained = np.frombuffer(row["lengths"]), np.frombuffer(row["explained"])

    def apply(self, x: np.ndarray) -> tuple[list[int | None], np.ndarray]:
        """Deviations (exact; None: no long holds it) and whitened rows (nan: an axis without variance)."""
        most = self.n * int(np.abs(x.astype(np.float64)).max(initial=0) + 1) + max(map(abs, self.sums))
        if most * most * x.shape[1] < 2**63:
            off = self.n * x - np.array(self.sums, np.int64)
            deviation = (off * off).sum(1).tolist()
        else:
            off = x.astype(object) * self.n - np.array(self.sums, object)
            deviation = [v if v < 2**63 else None for v in (off * off).sum(1).tolist()]
            off = off.astype(np.float64)
        with np.errstate(divide="ignore", invalid="ignore"):
            white = (off / self.n) @ self.axes.T / self.lengths
        return deviation, np.where(self.lengths > 0, white, np.nan)


def _moments(batches: Iterator[pa.RecordBatch], fitted: Broadcast) -> Iterator[pa.RecordBatch]:
    """Sums of whitened components (j is -1) and of their products over a task's vectors."""
    total: dict[tuple[int, int, int], float] = {}
    for batch in batches:
        for d, _, x in _blocks(batch["dim"].to_pylist(), batch["x"].to_pylist()):
            white = np.nan_to_num(fitted.value[d].apply(x)[1])
            pairs = white.T @ white
            for i in range(white.shape[1]):
                for j, v in ((-1, white[:, i].sum()), *enumerate(pairs[i])):
                    total[d, i, j] = total.get((d, i, j), 0.0) + float(v)
    rows = [(*k, v) for k, v in total.items()]
    yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate((pa.int32(), pa.int32(), pa.int32(), pa.float64()))], ["dim", "i", "j", "v"])


def _projected(batches: Iterator[pa.RecordBatch], fitted: Broadcast, error: float) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        ids = batch["vec_id"]
        for d, rows, x in _blocks(batch["dim"].to_pylist(), batch["x"].to_pylist()):
            axes = fitted.value[d]
            deviation, white = axes.apply(x)
            k = white.shape[1]
            nan = lambda v: pa.array(v, mask=np.isnan(v))
            columns = (
                ids.take(pa.array(np.repeat(rows, k))), pa.array(np.tile(np.arange(1, k + 1), len(rows)), pa.int32()), pa.array(np.full(len(rows) * k, axes.n, np.int64)),
                pa.array(deviation, pa.int64()).take(pa.array(np.repeat(np.arange(len(rows)), k))), nan(white.ravel()), nan(np.tile(axes.explained, len(rows))), pa.array(np.full(len(rows) * k, error)),
            )
            yield pa.RecordBatch.from_arrays(list(columns), [c.split()[0] for c in _OUT.split(", ")])


def whitened(vectors: DataFrame, k: int = 4) -> DataFrame:
    """vec_id, component (1 to k), n, deviation, whitened, explained and identity_error of each vector of vectors (vec_id, embedding).

    Entries c become x = floor(256 * c). The axes are the unit eigenvectors of the covariance (divisor
    n) of the n distinct x vectors, so copies, however many, weigh once. Vectors that are null, empty
    or hold null or non-finite entries, or one whose x is no long, take no part; an empty table gives
    an empty result. Repeated rows each give their rows, and rows with a null vec_id give rows with a
    null vec_id. Vectors of each length are a table of their own; those shorter than k have fewer
    components. A component without variance has whitened null, and if no component has any (a single
    vector, say) explained is null, too. A deviation that no long holds is null. Other columns are
    ignored, whatever their names.

    Every task subtracts one shift (some vector; the result does not depend on it) and adds sums and
    cross-products as limbs of 20 bits, which are exact at any size. They are merged in two rounds,
    so that no task reads those of all tasks; one task for each length of vectors then forms
    n X'X - SS', as whole numbers still, converts and decomposes it. What a task holds grows with the
    square of the length of vectors, not with their number.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding")).mapInArrow(_packed, _ROWS)
    fit = spill(rows.select("dim", "x").distinct())
    # A row for each length of vectors, here and below.
    shifts = spark.sparkContext.broadcast({r["dim"]: np.frombuffer(r["x"], f"<i{len(r['x']) // r['dim']}").astype(np.int64) for r in fit.groupBy("dim").agg(F.min("x").alias("x")).collect()})
    parts = fit.mapInArrow(partial(_scatter, shifts=shifts), _PARTS)
    for salt in (F.col("salt"), F.lit(0)):
        parts = parts.withColumn("salt", salt).repartition("dim", "stripe", "salt").sortWithinPartitions("dim", "stripe", "salt").mapInArrow(_summed, _PARTS)
    models = parts.groupBy("dim").applyInArrow(lambda group: _model(group, shifts, k), _MODEL).collect()
    fitted = spark.sparkContext.broadcast({r["dim"]: Axes(r) for r in models})
    moments = fit.mapInArrow(partial(_moments, fitted=fitted), "dim int, i int, j int, v double").groupBy("dim", "i", "j").agg(F.sum("v").alias("v")).collect()
    error = identity_error({r["dim"]: r["n"] for r in models}, {(r["dim"], r["i"], r["j"]): r["v"] for r in moments}, {d: a.lengths for d, a in fitted.value.items()})
    return rows.mapInArrow(partial(_projected, fitted=fitted, error=error), _OUT)


def identity_error(n: dict[int, int], sums: dict[tuple[int, int, int], float], lengths: dict[int, np.ndarray]) -> float:
    """The largest absolute entry of the whitened rows' covariance less the identity, over components with variance."""
    worst = 0.0
    for (d, i, j), v in sums.items():
        if j >= 0 and lengths[d][i] > 0 and lengths[d][j] > 0:
            cov = v / n[d] - sums[d, i, -1] / n[d] * (sums[d, j, -1] / n[d])
            worst = max(worst, abs(cov - (i == j)))
    return worst


def op13(spark, sf_dir: str) -> DataFrame:
    return whitened(table(spark, sf_dir, "embeddings"))
