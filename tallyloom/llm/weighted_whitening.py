"""Whitening of embeddings on the covariance of their different vectors, weighted by count.

Vectors are quantised to integers, floor(scale * c) + shift. Equal integer vectors are counted by
Spark, so copies cost nothing further on. The different vectors are packed into blocks; each
task sums weighted vectors exactly and multiplies the centred vectors, each times its weight, with
themselves (one matrix product a block, centred at the block's own mean). Tasks' moments (count,
sums, centred products) are merged pairwise by the means' differences, first in groups, then into
one row per vector length; its eigenvectors are the components. Each different vector is whitened
once, and joined back to the rows that hold it.

``identity_error`` is measured on the whitened values themselves, by the same weighted and centred
products, not derived from the eigenvalues.

Definitions and edge cases
  * Rows whose vector is null or holds a null, NaN or infinite entry are dropped. An empty vector
    has no component and gives no row. All other rows count, also those with a null or repeated
    vec_id, and each is returned. An empty table gives an empty result; other columns don't matter.
  * Vectors of different lengths have no common covariance: each length is fitted by itself.
  * Components whose eigenvalue is zero to double precision (fewer different vectors than
    dimensions, constant or dependent dimensions) can't be whitened and are left out.
  * Of a component and its negative, the one whose largest entry is positive is taken.
  * Integers are 64-bit; an entry beyond 2^60 / scale counts as that bound. Sums are exact at any
    size. ``deviation`` is null where the exact value doesn't fit 64 bits.
  * In memory: a block, and square matrices of the vector length; one such matrix per task is sent.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyloom.llm.common import stage

_LIMIT = float(1 << 60)
_MOMENT_TYPE = "dim int, part int, n long, sums array<decimal(38,0)>, products binary"
_BLOCK_TYPE = "dim int, part int, n long, sums array<decimal(38,0)>, products binary, vectors binary, weights binary"
_MODEL_TYPE = "dim int, n long, sums array<decimal(38,0)>, values binary, components binary, explained binary"
_WHITE_TYPE = "x array<long>, n long, deviation long, whitened array<double>, explained array<double>"
_ERROR_TYPE = "dim int, identity_error double"
#: Bytes of vectors in a block.
_BLOCK = 4 << 20
_DECIMAL = pa.list_(pa.decimal128(38, 0))


def quantised(vectors: DataFrame, scale: int, shift: int) -> DataFrame:
    """vec_id, integer vector x and its length, of the rows that take part."""
    sound = F.forall("embedding", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    whole = F.transform(
        "embedding",
        lambda c: F.floor(F.greatest(F.lit(-_LIMIT), F.least(F.lit(_LIMIT), F.lit(scale) * c.cast("double")))) + shift,
    )
    return vectors.filter(F.col("embedding").isNotNull() & (F.size("embedding") > 0) & sound).select(
        F.col("vec_id").cast("long").alias("vec_id"), whole.alias("x"), F.size("embedding").alias("dim")
    )


def _exact_sums(x: np.ndarray, w: np.ndarray) -> list[int]:
    """Weighted sum of each column."""
    total = int(w.sum())
    low = x.min(axis=0)
    if (x.max(axis=0).astype(object) - low).max() * total < 1 << 62:
        return (w @ (x - low)).astype(object) + low.astype(object) * total
    return w.astype(object) @ x.astype(object)


def _centred(x: np.ndarray, n: int, sums) -> np.ndarray:
    """x - sums / n in double precision: the whole part is taken off exactly first."""
    base = np.array([int(s) // n for s in sums], dtype=np.int64)
    rest = np.array([(int(s) - n * int(b)) / n for s, b in zip(sums, base, strict=True)])
    return (x - base).astype(np.float64) - rest


def block_moments(x: np.ndarray, w: np.ndarray) -> tuple[int, list[int], np.ndarray]:
    """Number of vectors, exact sums, and products of the weighted vectors centred at their mean."""
    n, sums = int(w.sum()), list(_exact_sums(x, w))
    y = _centred(x, n, sums)
    return n, sums, (y * w[:, None]).T @ y


def merge_moments(a, b):
    """Moments of two sets together."""
    if a is None:
        return b
    n = a[0] + b[0]
    gap = np.array([(int(s) * b[0] - int(t) * a[0]) / (a[0] * b[0]) for s, t in zip(a[1], b[1], strict=True)])
    sums = [int(s) + int(t) for s, t in zip(a[1], b[1], strict=True)]
    return n, sums, a[2] + b[2] + np.outer(gap, gap) * (a[0] * (b[0] / n))


def _decimals(sums) -> list[Decimal]:
    return [Decimal(int(s)) for s in sums]


def _matrix(column: pa.Array, dim: int) -> np.ndarray:
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.int64, copy=False)
    return flat.reshape(-1, dim)


def _block_tasks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A row per block with its vectors and weights, and a row per length with the task's moments."""
    held: dict[int, tuple] = {}
    first = None
    for part in parts:
        lengths = part.column("dim").to_numpy()
        for dim in np.unique(lengths).tolist():
            mine = part.filter(pa.array(lengths == dim))
            x, w = _matrix(mine.column("x"), dim), mine.column("w").to_numpy()
            first = first if first is not None else int(np.bitwise_xor.reduce(x[0]) & 0x7FFFFFFF)
            step = max(1, _BLOCK // (8 * dim))
            for k in range(0, len(x), step):
                xs, ws = np.ascontiguousarray(x[k : k + step]), w[k : k + step]
                held[dim] = merge_moments(held.get(dim), block_moments(xs, ws))
                yield _block_row(dim, vectors=xs.tobytes(), weights=ws.astype(np.int64).tobytes())
    for dim, (n, sums, products) in held.items():
        yield _block_row(dim, first, n, _decimals(sums), products.tobytes())


def _block_row(dim, part=None, n=None, sums=None, products=None, vectors=None, weights=None) -> pa.RecordBatch:
    kinds = [("dim", pa.int32()), ("part", pa.int32()), ("n", pa.int64()), ("sums", _DECIMAL),
             ("products", pa.binary()), ("vectors", pa.binary()), ("weights", pa.binary())]
    row = dict(zip([k for k, _ in kinds], (dim, part, n, sums, products, vectors, weights), strict=True))
    return pa.RecordBatch.from_pylist([row], schema=pa.schema(kinds))


def _merged(table: pa.Table):
    """Moments of all rows, in an order that doesn't depend on their arrival."""
    out, dim = None, table["dim"][0].as_py()
    rows = sorted(table.to_pylist(), key=lambda r: (r["part"], r["n"], r["products"]))
    for r in rows:
        products = np.frombuffer(r["products"]).reshape(dim, dim)
        out = merge_moments(out, (r["n"], [int(s) for s in r["sums"]], products))
    return dim, out


def _merge_group(table: pa.Table) -> pa.Table:
    dim, (n, sums, products) = _merged(table)
    row = {"dim": dim, "part": table["part"][0].as_py(), "n": n, "sums": _decimals(sums), "products": products.tobytes()}
    kinds = [("dim", pa.int32()), ("part", pa.int32()), ("n", pa.int64()), ("sums", _DECIMAL), ("products", pa.binary())]
    return pa.Table.from_pylist([row], schema=pa.schema(kinds))


def _models(most: int):
    def fit(table: pa.Table) -> pa.Table:
        dim, (n, sums, products) = _merged(table)
        cov = (products + products.T) / (2 * n)
        values, columns = np.linalg.eigh(cov)
        values, columns = values[::-1], columns[:, ::-1]
        trace = float(np.trace(cov))
        real = values > max(trace, 0.0) * dim * np.finfo(float).eps * 8
        kept = np.flatnonzero(real)[:most]
        columns = columns[:, kept]
        if len(kept):
            columns = columns * np.sign(columns[np.abs(columns).argmax(axis=0), np.arange(len(kept))])
        values = values[kept]
        row = {
            "dim": dim, "n": n, "sums": _decimals(sums), "values": values.tobytes(),
            "components": np.ascontiguousarray(columns).tobytes(), "explained": (values / trace if len(kept) else values).tobytes(),
        }
        kinds = [("dim", pa.int32()), ("n", pa.int64()), ("sums", _DECIMAL), ("values", pa.binary()),
                 ("components", pa.binary()), ("explained", pa.binary())]
        return pa.Table.from_pylist([row], schema=pa.schema(kinds))

    return fit


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int | None]:
    """Exact sum over the dimensions of (n * x - sums)^2 for each row."""
    base = np.array([s // n for s in sums], dtype=np.int64)
    rest = np.array([s - n * int(b) for s, b in zip(sums, base, strict=True)], dtype=object)
    far = x - base
    reach = (int(max(abs(int(far.max())), abs(int(far.min())))) + 1) * n
    if reach * reach * x.shape[1] < 1 << 63:
        gaps = n * far - rest.astype(np.int64)
        return (gaps * gaps).sum(axis=1).tolist()
    gaps = n * far.astype(object) - rest
    return [v if v < 1 << 63 else None for v in (gaps * gaps).sum(axis=1)]


def _whiten(row: dict) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
    dim, n, sums = row["dim"], row["n"], [int(s) for s in row["sums"]]
    x = np.frombuffer(row["vectors"], np.int64).reshape(-1, dim)
    values = np.frombuffer(row["values"])
    columns = np.frombuffer(row["components"]).reshape(dim, len(values))
    return x, np.frombuffer(row["weights"], np.int64), _centred(x, n, sums) @ columns / np.sqrt(values), sums


def _lists(values: np.ndarray, kind) -> pa.Array:
    ends = np.arange(len(values) + 1, dtype=np.int32) * values.shape[1]
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.ravel(), kind))


def _whiten_tasks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for part in parts:
        for row in part.to_pylist():
            x, _, z, sums = _whiten(row)
            explained = np.tile(np.frombuffer(row["explained"]), (len(x), 1))
            yield pa.RecordBatch.from_arrays(
                [
                    _lists(x, pa.int64()), pa.array([row["n"]] * len(x), pa.int64()),
                    pa.array(_deviations(x, row["n"], sums), pa.int64()), _lists(z, pa.float64()),
                    _lists(explained, pa.float64()),
                ],
                ["x", "n", "deviation", "whitened", "explained"],
            )


def _white_moment_tasks(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Moments of the whitened values: counts, sums (as doubles beside the products) and products."""
    for part in parts:
        for row in part.to_pylist():
            _, w, z, _ = _whiten(row)
            n = int(w.sum())
            mean = w @ z / n
            y = z - mean
            packed = np.vstack([mean[None, :], (y * w[:, None]).T @ y])
            yield pa.RecordBatch.from_pydict(
                {"dim": pa.array([row["dim"]], pa.int32()), "n": pa.array([n], pa.int64()),
                 "moments": pa.array([packed.tobytes()], pa.binary())}
            )


def _identity_errors(table: pa.Table) -> pa.Table:
    total, mean, products = 0, None, None
    for r in sorted(table.to_pylist(), key=lambda r: (r["n"], r["moments"])):
        packed = np.frombuffer(r["moments"])
        k = int((np.sqrt(1 + 4 * len(packed)) - 1) / 2 + 0.5)
        packed = packed.reshape(k + 1, k)
        if mean is None:
            total, mean, products = r["n"], packed[0], packed[1:]
            continue
        n = total + r["n"]
        gap = packed[0] - mean
        products = products + packed[1:] + np.outer(gap, gap) * (total * (r["n"] / n))
        mean, total = mean + gap * (r["n"] / n), n
    error = float(np.abs(products / total - np.eye(len(mean))).max()) if mean is not None and len(mean) else 0.0
    kinds = pa.schema([("dim", pa.int32()), ("identity_error", pa.float64())])
    return pa.Table.from_pylist([{"dim": table["dim"][0].as_py(), "identity_error": error}], schema=kinds)


def whiten(vectors: DataFrame, scale: int = 64, shift: int = 1_000_000, most: int = 32, groups: int = 64) -> DataFrame:
    """vec_id, n, deviation, whitened and explained (arrays by component), identity_error for each row."""
    rows = stage(quantised(vectors, scale, shift), "vectors")
    different = rows.groupBy("x").agg(F.count(F.lit(1)).alias("w")).select("x", "w", F.size("x").alias("dim"))
    blocks = stage(different.mapInArrow(_block_tasks, _BLOCK_TYPE), "blocks")
    moments = blocks.filter("vectors IS NULL").select("dim", F.pmod("part", F.lit(groups)).alias("part"), "n", "sums", "products")
    moments = moments.groupBy("dim", "part").applyInArrow(_merge_group, _MOMENT_TYPE)
    models = stage(moments.groupBy("dim").applyInArrow(_models(most), _MODEL_TYPE), "models")
    packed = blocks.filter("vectors IS NOT NULL").select("dim", "vectors", "weights").join(models, "dim")
    white = stage(packed.mapInArrow(_whiten_tasks, _WHITE_TYPE), "white")
    errors = packed.mapInArrow(_white_moment_tasks, "dim int, n long, moments binary")
    errors = stage(errors.groupBy("dim").applyInArrow(_identity_errors, _ERROR_TYPE), "errors")
    return rows.join(white, "x").join(errors, "dim").drop("x", "dim")


def by_component(whitened: DataFrame) -> DataFrame:
    """A row for each vector and component."""
    pairs = F.posexplode(F.arrays_zip("whitened", "explained")).alias("component", "_pair")
    return whitened.select("vec_id", "n", "deviation", "identity_error", pairs).select(
        "vec_id",
        (F.col("component") + 1).alias("component"),
        "n",
        "deviation",
        F.col("_pair.whitened").alias("whitened"),
        F.col("_pair.explained").alias("explained"),
        "identity_error",
    )
