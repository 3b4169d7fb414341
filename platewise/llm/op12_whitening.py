"""Embedding whitening from exact cross-products of bit planes.

Entries c become integers floor(256 * c). The different vectors are the fit list. Each dimension is shifted to begin at 0, and each bit of it
is packed across the rows of a block, 64 rows to a word: a bit plane. The cross-product of two dimensions is the sum over their planes a and b
of 2 ** (a + b) times the number of ones in the AND of both; a plane of ones gives the sums and the number of rows. Blocks are
summed in each task and then by Spark, in 40-bit limbs, so nothing overflows and nothing is rounded. The driver gets one row for each pair of dimensions, centres
as integers (n * sum of x y - sum of x * sum of y, which the shift does not change), divides once and takes the eigenvectors. The vectors themselves never leave the tasks.

``identity_error`` is measured: the whitened fit list's covariance, from a pass of its own, against the identity.

Edge cases: rows whose vector is null, empty, or holds null or non-finite entries are dropped; so are vectors of another length than most different vectors
have (of lengths equally frequent, the greater). Repeated rows and vectors each get their result and count once in the fit. Components without
variance (eigenvalue at most 1e-12 of the trace) have no whitened value and give no rows, so a table of one different vector, or of none, gives an empty result. Entries beyond
a long are held at its ends; a deviation beyond a long is null. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from platewise.llm.arrays import let_workers_import
from platewise.llm.steps import settled

COMPONENTS = 4
SCALE = 256.0
PLANE_BYTES = 1 << 23  # bit planes of a block
LEAST_VARIANCE = 1e-12

_LIMB = 40
_LIMBS = 4
_ROWS = 1 << 13


def integers(column: pa.Array) -> tuple[list[bytes | None], np.ndarray]:
    """floor(256 * c) of every vector as bytes of longs, and which vectors have only finite entries."""
    sizes = np.asarray(pc.fill_null(pc.list_value_length(column), 0)).astype(np.int64)
    flat = column.flatten()
    missing = np.asarray(flat.is_null())
    values = np.where(missing, np.nan, flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False))
    fine = np.isfinite(values)
    with np.errstate(over="ignore", invalid="ignore"):
        scaled = np.floor(np.where(fine, values, 0.0) * SCALE) + 0.0
    x = np.where(scaled >= 2.0**63, np.iinfo(np.int64).max, np.clip(scaled, -(2.0**63), np.nextafter(2.0**63, 0)).astype(np.int64))
    ends = np.cumsum(sizes)
    bad = np.append(0, np.cumsum(~fine))
    good = (sizes > 0) & (bad[ends] == bad[ends - sizes])
    raw = x.tobytes()
    return [raw[8 * (e - s) : 8 * e] if ok else None for e, s, ok in zip(ends.tolist(), sizes.tolist(), good.tolist())], good


def _as_integers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, _ROWS):
            part = batch.slice(at, _ROWS)
            x, good = integers(part.column("vector"))
            yield pa.RecordBatch.from_arrays([part.column("id"), pa.array(x, pa.binary())], names=["id", "x"]).filter(pa.array(good))


def _matrices(batches: Iterator[pa.RecordBatch], dims: int, rows: int) -> Iterator[np.ndarray]:
    """Vectors as arrays of at most ``rows`` rows."""
    held, have = [], 0
    for batch in batches:
        raw = b"".join(batch.column("x").to_pylist())
        x = np.frombuffer(raw, np.int64).reshape(-1, dims)
        for at in range(0, len(x), rows):
            part = x[at : at + rows]
            if have + len(part) > rows:
                yield np.concatenate(held)
                held, have = [], 0
            held.append(part)
            have += len(part)
    if have:
        yield np.concatenate(held)


def planes(x: np.ndarray, low: np.ndarray, bits: list[int]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bit planes of the shifted dimensions, 64 rows to a word, with a last plane of ones; dimension and weight of each plane."""
    y = x.view(np.uint64) - low.view(np.uint64)
    dim = np.repeat(np.arange(len(bits)), bits)
    bit = np.concatenate([np.arange(b) for b in bits] + [np.zeros(0, np.int64)]).astype(np.int64)
    words = -(-len(x) // 64)
    packed = np.zeros((len(dim) + 1, words * 8), np.uint8)
    for p, (j, b) in enumerate(zip(dim.tolist(), bit.tolist())):
        ones = np.packbits((y[:, j] >> np.uint64(b)).astype(np.uint8) & 1)
        packed[p, : len(ones)] = ones
    ones = np.packbits(np.ones(len(x), np.uint8))
    packed[-1, : len(ones)] = ones
    return packed.view(np.uint64), np.append(dim, len(bits)), np.append(bit, 0)


def cross_products(x: np.ndarray, low: np.ndarray, bits: list[int]) -> np.ndarray:
    """Exact sums of y_i * y_j over the rows (upper half), y being shifted by ``low``; the last row and column belong to ones."""
    words, dim, bit = planes(x, low, bits)
    edges = np.flatnonzero(np.diff(dim, prepend=-1))  # first plane of each dimension that has any
    names = dim[edges]
    narrow = 2 * max([*bits, 1]) + len(x).bit_length() + 12 < 63
    out = np.zeros((len(bits) + 1, len(bits) + 1), np.int64 if narrow else object)
    for p in range(len(dim)):
        counts = np.bitwise_count(words[p] & words[p:]).sum(axis=1, dtype=np.int64)
        weighted = counts << (bit[p:] + bit[p]) if narrow else np.array([int(c) << int(b + bit[p]) for c, b in zip(counts, bit[p:])], object)
        own = edges[(at := int(np.searchsorted(names, dim[p]))) :]
        out[dim[p], names[at:]] += np.add.reduceat(weighted, np.maximum(own - p, 0))
        if p > edges[at]:  # planes of this dimension before p: the product is symmetric
            back = np.bitwise_count(words[p] & words[edges[at] : p]).sum(axis=1, dtype=np.int64)
            shift = bit[edges[at] : p] + bit[p]
            out[dim[p], dim[p]] += int((back << shift).sum()) if narrow else sum(int(c) << int(s) for c, s in zip(back, shift))
    return out


def _extremes(dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        low = high = None
        for x in _matrices(batches, dims, _ROWS):
            low = x.min(axis=0) if low is None else np.minimum(low, x.min(axis=0))
            high = x.max(axis=0) if high is None else np.maximum(high, x.max(axis=0))
        if low is not None:
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(dims)), pa.array(low), pa.array(high)], names=["dim", "low", "high"])

    return run


def _scatter(dims: int, low: np.ndarray, bits: list[int]):
    rows = max(64, 64 * (PLANE_BYTES // (8 * (sum(bits) + 1))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1), object)
        seen = False
        for x in _matrices(batches, dims, min(rows, 1 << 16)):
            total += cross_products(x, low, bits)
            seen = True
        if not seen:
            return
        i, j = np.triu_indices(dims + 1)
        values = [int(v) for v in total[i, j]]
        limbs = [[v >> (_LIMB * k) & ((1 << _LIMB) - 1) for v in values] for k in range(_LIMBS)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(i.astype(np.int64)), pa.array(j.astype(np.int64)), *(pa.array(v, pa.int64()) for v in limbs)],
            names=["i", "j", *(f"l{k}" for k in range(_LIMBS))],
        )

    return run


class Whitener:
    """Number of vectors, sums by dimension, leading eigenvalues and unit eigenvectors."""

    def __init__(self, dims: int, rows: list, low: np.ndarray, components: int) -> None:
        g = {(r["i"], r["j"]): sum(int(r[f"l{k}"]) << (_LIMB * k) for k in range(_LIMBS)) for r in rows}
        self.dims = dims
        self.n = n = g[dims, dims]
        shifted = [g[j, dims] for j in range(dims)]
        self.sums = [shifted[j] + n * int(low[j]) for j in range(dims)]
        v = np.zeros((dims, dims))
        for i in range(dims):
            for j in range(i, dims):
                v[i, j] = v[j, i] = (n * g[i, j] - shifted[i] * shifted[j]) / (n * n)
        self.trace = float(np.trace(v))
        values, vectors = np.linalg.eigh(v)
        chosen = [k for k in range(dims - 1, max(-1, dims - 1 - components), -1) if values[k] > LEAST_VARIANCE * self.trace]
        self.values = values[chosen]
        self.vectors = vectors[:, chosen]

    def centred(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(n * x - S) as integers, as far as a long goes as such, and as doubles divided by n."""
        most = max([abs(s) for s in self.sums] + [self.n * max(abs(int(x.min())), abs(int(x.max())))])
        if self.dims * (2 * most) ** 2 < 1 << 63:
            t = self.n * x - np.array(self.sums, np.int64)
            return t, t / self.n
        t = self.n * x.astype(object) - np.array(self.sums, object)
        return t, (t / self.n).astype(float)

    def whitened(self, x: np.ndarray) -> np.ndarray:
        return self.centred(x)[1] @ self.vectors / np.sqrt(self.values)


def _moments(model: Whitener):
    """Sums and sums of products of the whitened values, one row for each pair of components."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k = len(model.values)
        total, products = np.zeros(k), np.zeros((k, k))
        for x in _matrices(batches, model.dims, _ROWS):
            w = model.whitened(x)
            total += w.sum(axis=0)
            products += w.T @ w
        i, j = np.triu_indices(k)
        yield pa.RecordBatch.from_arrays(
            [*(pa.array(v.astype(np.int64)) for v in (i, j)), *(pa.array(v) for v in (total[i], total[j], products[i, j]))], names=["i", "j", "a", "b", "p"]
        )

    return run


_RESULT = "component int, n long, deviation long, whitened double, explained double, identity_error double"


def _projected(model: Whitener, identity_error: float):
    k = len(model.values)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _ROWS):
                part = batch.slice(at, _ROWS)
                (x,) = _matrices(iter([part]), model.dims, _ROWS)
                t, centre = model.centred(x)
                deviation = [int(d) if abs(d) < 1 << 63 else None for d in (t * t).sum(axis=1)]
                rows = np.repeat(np.arange(len(x)), k)
                columns = [
                    part.column("id").take(pa.array(rows)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(x))),
                    pa.array(np.full(len(rows), model.n)),
                    pa.array([deviation[r] for r in rows.tolist()], pa.int64()),
                    pa.array((centre @ model.vectors / np.sqrt(model.values)).ravel()),
                    pa.array(np.tile(model.values / model.trace, len(x))),
                    pa.array(np.full(len(rows), identity_error)),
                ]
                yield pa.RecordBatch.from_arrays(columns, names=["id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return run


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """One row for each usable vector and component."""
    spark = let_workers_import(vectors).sparkSession
    given = vectors.select(F.col(f"`{key}`").alias("id"), F.col(f"`{column}`").alias("vector")).where(F.col("vector").isNotNull())
    kind = vectors.schema[key].dataType.simpleString()
    usable = given.mapInArrow(_as_integers, f"id {kind}, x binary")
    empty = spark.createDataFrame([], f"{key} {kind}, {_RESULT}")
    distinct = settled(usable.select("x").distinct(), "fit-list")
    length = distinct.groupBy(F.octet_length("x").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if length is None:
        return empty
    dims = length["size"] // 8
    fit = distinct.where(F.octet_length("x") == length["size"])
    ends = fit.mapInArrow(_extremes(dims), "dim long, low long, high long").groupBy("dim").agg(F.min("low").alias("low"), F.max("high").alias("high"))
    ends = ends.orderBy("dim").collect()  # one row for each dimension
    low, bits = np.array([r["low"] for r in ends], np.int64), [(r["high"] - r["low"]).bit_length() for r in ends]
    limbs = [f"l{k}" for k in range(_LIMBS)]
    scatter = fit.mapInArrow(_scatter(dims, low, bits), "i long, j long, " + ", ".join(f"{c} long" for c in limbs))
    model = Whitener(dims, scatter.groupBy("i", "j").agg(*[F.sum(c).alias(c) for c in limbs]).collect(), low, components)  # one row for each pair of dimensions
    k = len(model.values)
    if not k:
        return empty
    moments = fit.mapInArrow(_moments(model), "i long, j long, a double, b double, p double").groupBy("i", "j").agg(F.sum("a"), F.sum("b"), F.sum("p")).collect()
    error = max(abs(p / model.n - a / model.n * (b / model.n) - (i == j)) for i, j, a, b, p in moments)
    chosen = usable.where(F.octet_length("x") == length["size"])
    return chosen.mapInArrow(_projected(model, float(error)), f"id {kind}, {_RESULT}").withColumnRenamed("id", key)
