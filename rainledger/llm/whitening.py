"""Whitening of embeddings from an exact, bit-sliced scatter matrix.

Components become integers, ``floor(scale * x) + shift``. The model is fitted on each distinct integer vector once. In every
task the vectors of a block are shifted by the block's least value per dimension, and every bit plane of every dimension is
packed across the rows into 64-bit words. A cross-product is then the sum, over pairs of planes, of the count of bits that both
have, times the planes' powers of two. Blocks and tasks are added as integers, so the scatter is exact whatever the order; it is
centred as integers (n * sum of products - product of sums) and only then divided and given to ``eigh``. No task holds more
than a block of rows and one matrix of dimension x dimension.

A vector that is null, or holds a null or non-finite component, takes no part. Other columns are ignored; rows that repeat an
id, or have none, are rows of their own. Vectors of unlike length are spaces of their own, each fitted by itself; the models (16
components a length) must fit ``MODEL_BYTES``, or an error is raised, and so it is for components beyond 2**52. An empty vector
has no component, hence no row. A component without variance (fewer distinct vectors than dimensions) has null ``whitened``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sinks.staging import stage

BLOCK_ROWS = 1 << 14
MODEL_BYTES = 256 << 20
#: Exact sums travel as two longs: value = high * 2**_LIMB + low, so that Spark can add them.
_LIMB = 40
_KINDS = [np.int8, np.int16, np.int32, np.int64]


def _integers(scale: int):
    """Each vector as integers of the least width that holds all of it: equal vectors are equal bytes."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            vectors = batch.column("vector")
            values = np.floor(scale * vectors.flatten().to_numpy(zero_copy_only=False).astype(np.float64))
            if len(values) and np.abs(values).max() >= 2.0**52:
                raise ValueError("a component is beyond 2**52")
            lengths = vectors.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            ends = np.cumsum(lengths)
            whole = values.astype(np.int64)
            size = np.where(whole < 0, ~whole, whole)
            kinds = np.searchsorted([1 << 7, 1 << 15, 1 << 31], size, side="right")
            widest = np.zeros(len(lengths), dtype=np.int64)
            some = np.flatnonzero(lengths)
            if len(some):
                widest[some] = np.maximum.reduceat(kinds, (ends - lengths)[some])
            packed = [whole[e - n : e].astype(_KINDS[k]).tobytes() for e, n, k in zip(ends, lengths, widest)]
            yield pa.RecordBatch.from_arrays(
                [batch.column("vec_id"), pa.array(lengths), pa.array(packed, pa.binary())], names=["vec_id", "dim", "packed"]
            )

    return read


def _matrix(packed: list[bytes], dim: int) -> np.ndarray:
    """Rows of integers; vectors are stored in several widths."""
    out = np.empty((len(packed), dim), dtype=np.int64)
    sizes = np.array(list(map(len, packed))) // dim
    for kind in _KINDS:
        own = np.flatnonzero(sizes == np.dtype(kind).itemsize)
        if len(own):
            out[own] = np.frombuffer(b"".join([packed[i] for i in own]), dtype=kind).reshape(len(own), dim)
    return out


def bit_planes(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The planes of columns of non-negative integers, packed across rows into words, with each plane's column and bit."""
    rows, dim = values.shape
    words = -(-rows // 64)
    planes, columns, bits = [], [], []
    for bit in range(int(values.max(initial=0)).bit_length()):
        digits = (values >> bit) & 1
        used = np.flatnonzero(digits.any(axis=0))
        padded = np.zeros((len(used), 64 * words), dtype=np.uint8)
        padded[:, :rows] = digits[:, used].T
        planes.append(np.packbits(padded, axis=1, bitorder="little").view(np.uint64))
        columns.append(used)
        bits.append(np.full(len(used), bit))
    if not planes:
        return np.zeros((0, words), np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.concatenate(planes), np.concatenate(columns), np.concatenate(bits)


def scatter(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of the columns, and of the products of every two columns, as exact integers of any size."""
    rows, dim = values.shape
    least = values.min(axis=0)
    planes, columns, bits = bit_planes(values - least)
    sums = np.zeros(dim, dtype=object)
    products = np.zeros((dim, dim), dtype=object)
    for i in range(len(planes)):
        counts = np.bitwise_count(planes[i] & planes[i:]).sum(axis=1, dtype=np.int64)
        counts[1:] *= 2  # each later plane meets this one once, and stands for both orders
        sums[columns[i]] += int(counts[0]) << int(bits[i])
        row = np.zeros(dim, dtype=object)
        for bit in np.unique(bits[i:]):
            own = bits[i:] == bit
            row[columns[i:][own]] += counts[own].astype(object) << int(bit)
        products[columns[i]] += row << int(bits[i])
    # A pair of planes was counted on one side only: halve what both sides add up to.
    products = (products + products.T) // 2
    shift = least.astype(object)
    products = products + np.outer(shift, sums) + np.outer(sums, shift) + rows * np.outer(shift, shift)
    return sums + rows * shift, products


def _blocks(batches: Iterator[pa.RecordBatch], size: int) -> Iterator[tuple[int, np.ndarray]]:
    """The vectors of a task, by length, a block of rows at a time."""
    waiting: dict[int, list[bytes]] = {}
    for batch in batches:
        for dim, packed in zip(batch.column("dim").to_pylist(), batch.column("packed").to_pylist()):
            if dim:
                waiting.setdefault(dim, []).append(packed)
                if len(waiting[dim]) >= size:
                    yield dim, _matrix(waiting.pop(dim), dim)
    for dim, rows in waiting.items():
        yield dim, _matrix(rows, dim)


def _partial_scatters(block_rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The upper triangle of a task's scatter; row -1 has the sums, and the count behind them."""
        totals: dict[int, list] = {}
        for dim, values in _blocks(batches, block_rows):
            sums, products = scatter(values)
            have = totals.setdefault(dim, [0, 0, 0])
            totals[dim] = [have[0] + len(values), have[1] + sums, have[2] + products]
        for dim, (rows, sums, products) in totals.items():
            at, to = np.triu_indices(dim)
            whole = np.concatenate([products[at, to], sums, np.array([rows], dtype=object)])
            i = np.concatenate([at, np.full(dim + 1, -1)])
            j = np.concatenate([to, np.arange(dim + 1)])
            high, low = (whole >> _LIMB).astype(np.int64), (whole & ((1 << _LIMB) - 1)).astype(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(i), dim)), *map(pa.array, (i, j, high, low))], names=["dim", "i", "j", "high", "low"])

    return run


def _fitted(components: int):
    """One length's mean and leading eigenvectors from its whole scatter."""

    def fit(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        i, j, high, low = (table.column(c).to_numpy() for c in ("i", "j", "high", "low"))
        whole = (high.astype(object) << _LIMB) + low.astype(object)
        line = np.zeros(dim + 1, dtype=object)
        line[j[i < 0]] = whole[i < 0]
        sums, n = line[:-1], int(line[-1])
        products = np.zeros((dim, dim), dtype=object)
        own = i >= 0
        products[i[own], j[own]] = whole[own]
        products[j[own], i[own]] = whole[own]
        centred = n * products - np.outer(sums, sums)
        covariance = (centred / (n * n)).astype(np.float64)
        values, vectors = np.linalg.eigh(covariance)
        values, vectors = values[::-1][:components], vectors[:, ::-1][:, :components].T
        trace = float(int(np.trace(centred)) / (n * n))
        # Either sign will do: the largest entry is positive.
        vectors = vectors * np.sign(np.take_along_axis(vectors, np.abs(vectors).argmax(axis=1)[:, None], axis=1))
        values = np.where(values > 1e-13 * dim * max(values[0], 0.0), values, 0.0)
        return pa.table(
            {
                "dim": [dim],
                "n": [n],
                "sums": [[str(s) for s in sums]],
                "trace": [trace],
                "variances": [values.tolist()],
                "axes": [vectors.ravel().tolist()],
            }
        )

    return fit


class Model:
    """One length's whitening: n and sums of the fit list, axes and variances."""

    def __init__(self, row):
        self.dim, self.n, self.trace = row["dim"], row["n"], row["trace"]
        self.sums = np.array([int(s) for s in row["sums"]], dtype=object)
        self.variances = np.array(row["variances"])
        self.axes = np.array(row["axes"]).reshape(len(self.variances), self.dim)
        self.identity_error: float | None = None

    def centred(self, values: np.ndarray) -> np.ndarray:
        """n * x - S, exact: longs where they fit."""
        bound = self.n * (int(np.abs(values).max(initial=0)) + 1) + max(map(abs, self.sums), default=0)
        if bound < 1 << 62:
            return values * self.n - self.sums.astype(np.int64)
        return values.astype(object) * self.n - self.sums

    def whitened(self, centred: np.ndarray) -> np.ndarray:
        """Projections over the square root of their variance; NaN without variance."""
        with np.errstate(divide="ignore", invalid="ignore"):
            projected = (centred.astype(np.float64) / self.n) @ self.axes.T
            return np.where(self.variances > 0, projected / np.sqrt(self.variances), np.nan)


def _covariances(models: dict[int, Model], block_rows: int):
    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals: dict[int, np.ndarray] = {}
        for dim, values in _blocks(batches, block_rows):
            found = models[dim].whitened(models[dim].centred(values))
            found = np.column_stack([np.ones(len(found)), found])
            totals[dim] = totals.get(dim, 0) + found.T @ found
        for dim, total in totals.items():
            i, j = np.indices(total.shape)
            columns = [np.full(total.size, dim), i.ravel(), j.ravel(), total.ravel()]
            yield pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=["dim", "i", "j", "total"])

    return add


def _measure_identity(model: Model, cells: list) -> None:
    """The largest entry of the whitened vectors' covariance minus the identity, over components with variance."""
    size = len(model.variances) + 1
    total = np.zeros((size, size))
    for cell in cells:
        total[cell["i"], cell["j"]] = cell["total"]
    means = total[0, 1:] / model.n
    off = total[1:, 1:] / model.n - np.outer(means, means) - np.eye(size - 1)
    some = model.variances > 0
    model.identity_error = float(np.abs(off[some][:, some]).max()) if some.any() else None


def _projected(models: dict[int, Model]):
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for dim in np.unique(dims[dims > 0]).tolist():
                model, own = models[dim], np.flatnonzero(dims == dim)
                part = batch.take(pa.array(own))
                centred = model.centred(_matrix(part.column("packed").to_pylist(), dim))
                whole = int(np.abs(centred).max(initial=0)) ** 2 * dim
                squares = ((centred if whole < 1 << 62 else centred.astype(object)) ** 2).sum(axis=1)
                rows, parts = len(own), len(model.variances)
                again = np.repeat(np.arange(rows), parts)
                squares = squares.astype(object)
                columns = {
                    "vec_id": part.column("vec_id").take(pa.array(again)),
                    "component": pa.array(np.tile(np.arange(1, parts + 1, dtype=np.int32), rows)),
                    "n": pa.array(np.full(len(again), model.n)),
                    "high": pa.array((squares >> _LIMB).astype(np.int64)[again]),
                    "low": pa.array((squares & ((1 << _LIMB) - 1)).astype(np.int64)[again]),
                    "whitened": pa.array(model.whitened(centred).ravel(), from_pandas=True),
                    "explained": pa.array(np.tile(model.variances / model.trace if model.trace else np.full(parts, np.nan), rows), from_pandas=True),
                    "identity_error": pa.array([model.identity_error] * len(again), pa.float64()),
                }
                yield pa.RecordBatch.from_arrays(list(columns.values()), names=list(columns))

    return read


def _joined(high: Column, low: Column) -> Column:
    return (high.cast("decimal(20,0)") * F.lit(1 << _LIMB).cast("decimal(13,0)") + low).cast("decimal(38,0)")


def whiten(vectors: DataFrame, components: int = 16, scale: int = 64, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """vec_id, component (from 1, by falling variance), n (distinct vectors fitted on), deviation (the squared length of
    n * x - S, exact), whitened, explained (share of all variance), identity_error. A constant shift of all components
    changes none of them, so it is left out of the integers."""
    finite = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding")
    rows = rows.filter(F.col("embedding").isNotNull() & finite)
    rows = rows.select("vec_id", F.col("embedding").cast("array<double>").alias("vector"))
    rows = stage(rows.mapInArrow(_integers(scale), "vec_id long, dim long, packed binary"), "llm-integers")
    # Copies meet in map-side sums first, so a vector that a third of the rows repeat is a few rows of the shuffle.
    fit = stage(rows.select("dim", "packed").distinct(), "llm-fit-list")
    parts = fit.mapInArrow(_partial_scatters(block_rows), "dim long, i long, j long, high long, low long")
    whole = parts.groupBy("dim", "i", "j").agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    schema = "dim long, n long, sums array<string>, trace double, variances array<double>, axes array<double>"
    fitted = stage(whole.groupBy("dim").applyInArrow(_fitted(components), schema), "llm-whitening")
    size = fitted.agg(F.sum(F.col("dim") * 8 * (2 * components + 4))).first()[0] or 0
    if size > MODEL_BYTES:
        raise ValueError(f"models of {size} bytes: too many lengths of vectors")
    models = {row["dim"]: Model(row) for row in fitted.collect()}
    cells = fit.mapInArrow(_covariances(models, block_rows), "dim long, i long, j long, total double")
    found = cells.groupBy("dim", "i", "j").agg(F.sum("total").alias("total")).collect()
    for dim, model in models.items():
        _measure_identity(model, [cell for cell in found if cell["dim"] == dim])
    schema = "vec_id long, component int, n long, high long, low long, whitened double, explained double, identity_error double"
    out = rows.mapInArrow(_projected(models), schema)
    return out.select(
        "vec_id", "component", "n", _joined(F.col("high"), F.col("low")).alias("deviation"), "whitened", "explained", "identity_error"
    )
