"""Whitening of embeddings by a tiled covariance.

The dimensions are cut into column blocks, and pairs of blocks are the tiles
of the covariance. Tasks cut their rows into row blocks and send each column
block to the tiles that need it; what meets under one row block and tile is
two small matrices, which are multiplied, and the products are summed by tile.
Entries are integers and are centred by an integer first, so that the products
and their sums are exact and don't depend on how the rows are dealt.
"""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioscan.llm.common import materialise

#: Dimensions in a column block, and numbers in a row block's column block at most.
TILE, BLOCK = 32, 1 << 17
#: Sums of products above this aren't exact in doubles.
EXACT = 2**53


def rows_of(column: pa.Array) -> np.ndarray:
    """A column of lists of one length as a matrix."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    return flat.reshape(len(column), -1)


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """n and the sum of each dimension over a task's rows."""
    n, total = 0, None
    for batch in batches:
        if batch.num_rows:
            x = rows_of(batch.column("x"))
            n += len(x)
            total = x.sum(axis=0) if total is None else total + x.sum(axis=0)
    if n:
        yield pa.RecordBatch.from_arrays([pa.array([n] * len(total)), pa.array(np.arange(len(total), dtype=np.int32)), pa.array(total)], ["n", "pos", "total"])


def column_blocks(center: np.ndarray):
    """Cuts rows into blocks: block, i, j (the tile), side (0 for rows of the tile, 1 for its columns), data (32-bit integers, centred)."""
    blocks = -(-len(center) // TILE)
    height = max(1, BLOCK // min(TILE, max(len(center), 1)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = TaskContext.get().partitionId() << 32
        kept, held = [], 0

        def flush(block, x):
            out = []
            for k in range(blocks):
                data = np.ascontiguousarray(x[:, k * TILE : (k + 1) * TILE]).tobytes()
                out += [(block, k, j, 0, data) for j in range(k, blocks)] + [(block, i, k, 1, data) for i in range(k)]
            kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary()]
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)], ["block", "i", "j", "side", "data"])

        for batch in batches:
            x = rows_of(batch.column("x")) - center
            if len(x) and np.abs(x).max() >= 2**31:
                raise OverflowError("entries lie too far from their mean")
            for at in range(0, len(x), height):
                kept.append(x[at : at + height].astype("<i4"))
                held += len(kept[-1])
                if held >= height:
                    yield flush(block, np.concatenate(kept))
                    block, kept, held = block + 1, [], 0
        if held:
            yield flush(block, np.concatenate(kept))

    return run


def _products(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sums of the products of a task's tiles, by tile: i, j, pos, product. The rows are sorted by tile, block and side."""
    tile = total = left = None

    def emit():
        flat = total.ravel()
        if np.abs(flat).max(initial=0) >= EXACT:
            raise OverflowError("a product is too large to be exact")
        n = len(flat)
        return pa.RecordBatch.from_arrays([pa.array(np.full(n, tile[0], np.int32)), pa.array(np.full(n, tile[1], np.int32)), pa.array(np.arange(n, dtype=np.int32)), pa.array(flat.astype(np.int64))], ["i", "j", "pos", "product"])

    for batch in batches:
        of = batch.to_pydict()
        for block, i, j, side, width, data in zip(*(of[c] for c in ("block", "i", "j", "side", "width", "data")), strict=True):
            x = np.frombuffer(data, "<i4").reshape(-1, width).astype(np.float64)
            if (i, j) != tile:
                if tile:
                    yield emit()
                tile, total = (i, j), 0
            if side == 0:
                left = (block, x)
            if i == j or side == 1:
                total = total + left[1].T @ x
    if tile:
        yield emit()


def covariance(fit: DataFrame, d: int) -> tuple[int, list[int], np.ndarray]:
    """n, the sums by dimension and the covariance (divisor n) of the rows x, exact but for the last rounding.

    Only d sums and d * d products reach the driver.
    """
    got = fit.mapInArrow(_sums, "n long, pos int, total long").groupBy("pos").agg(F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("pos").collect()
    n, sums = (got[0]["n"], [int(r["total"]) for r in got]) if got else (0, [0] * d)
    if not n:
        return 0, sums, np.zeros((d, d))
    center = np.array([s // n for s in sums], np.int64)
    width = lambda k: F.least(F.lit(TILE), F.lit(d) - F.col(k) * TILE)
    blocks = fit.mapInArrow(column_blocks(center), "block long, i int, j int, side int, data binary").withColumn("width", F.when(F.col("side") == 0, width("i")).otherwise(width("j")))
    # both sides of a tile in a row block meet in one task, which adds its products before they go on
    met = blocks.repartition("block", "i", "j").sortWithinPartitions("i", "j", "block", "side")
    parts = met.mapInArrow(_products, "i int, j int, pos int, product long").groupBy("i", "j", "pos").agg(F.sum(F.col("product").cast("decimal(38,0)")).alias("product"))
    out = np.zeros((d, d))
    rest = [Fraction(s % n, n) for s in sums]
    for r in parts.toLocalIterator():
        w = min(TILE, d - r["j"] * TILE)
        a, b = r["i"] * TILE + r["pos"] // w, r["j"] * TILE + r["pos"] % w
        out[a, b] = out[b, a] = float(Fraction(int(r["product"]), n) - rest[a] * rest[b])
    return n, sums, out


def _moments(mean: np.ndarray, map_: np.ndarray):
    """n, the means and the centred products of a task's whitened rows; the products are centred at the task's own means."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, at, products = 0, np.zeros(map_.shape[1]), np.zeros((map_.shape[1],) * 2)
        for batch in batches:
            if batch.num_rows:
                y = whitened(rows_of(batch.column("x")), mean, map_)
                n, at, products = merged((n, at, products), (len(y), y.mean(axis=0), (y - y.mean(axis=0)).T @ (y - y.mean(axis=0))))
        yield pa.RecordBatch.from_arrays([pa.array([n]), pa.array([at.tolist()]), pa.array([products.ravel().tolist()])], ["n", "mean", "products"])

    return run


def merged(one: tuple, other: tuple) -> tuple:
    """Numbers, means and centred products of two sets of rows together."""
    (n, a, p), (m, b, q) = one, other
    if not n or not m:
        return other if not n else one
    return n + m, a + (b - a) * (m / (n + m)), p + q + np.outer(b - a, b - a) * (n * m / (n + m))


def whitened(x: np.ndarray, mean: np.ndarray, map_: np.ndarray) -> np.ndarray:
    """(x - mean) projected; mean is an integer part and a rest below one."""
    return ((x - mean[0].astype(np.int64)) - mean[1]) @ map_


def deviations(x: np.ndarray, n: int, sums: list[int]) -> list[int] | np.ndarray:
    """The sum of (n * x - sum)^2 of each row, exact; an error if one doesn't fit a long."""
    center, rest = np.array([s // n for s in sums], np.int64), np.array([s % n for s in sums], np.int64)
    near = x - center
    most = (int(np.abs(near).max(initial=0)) + 1) * n
    if most * most * max(len(sums), 1) < 2**63:
        return ((near * n - rest) ** 2).sum(axis=1)
    exact = near.astype(object) * n - rest
    return (exact * exact).sum(axis=1).tolist()


def whiten(vectors: DataFrame, components: int = 16, scale: int = 64, shift: int = 1_000_000, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """A row for each row of vectors and component: vec_id, component, n, deviation, whitened, explained, identity_error.

    Entries c become integers x = floor(scale * c) + shift. The covariance is
    taken over the distinct x vectors, n of them, with divisor n. Components
    are its unit eigenvectors by falling eigenvalue e, at most `components`.
    deviation: sum of (n * x - sum)^2 over the dimensions; whitened: x - mean
    on the component, over sqrt(e); explained: e over the sum of all;
    identity_error: largest absolute entry of the covariance of whitened over
    the distinct vectors, minus the identity.

    Rows whose vector is null, or holds null or non-finite entries, are left
    out, as are those of another length than most distinct vectors have (the
    longer one if two lengths are as frequent). Components without variance
    (e below 1e-12 of the sum: fewer distinct vectors than dimensions, constant
    dimensions, a single vector) can't be whitened and give no rows. Equal
    eigenvalues may go in either order. Null ids stay null; repeated rows give
    repeated rows, but count once in the fit; an empty table gives an empty
    one. Other columns don't matter. d * d numbers reach the driver, so
    thousands of dimensions are the bound; rows never do.
    """
    spark = vectors.sparkSession
    entries = F.col(f"`{vector_col}`")
    finite = F.forall(entries, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < float("inf")))
    x = F.transform(entries, lambda c: F.floor(c.cast("double") * scale) + shift)
    t = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.when(entries.isNotNull() & F.coalesce(finite, F.lit(False)), x).alias("x")).where("x IS NOT NULL")
    fit = materialise(t.select("x").distinct(), "vectors")
    lengths = fit.groupBy(F.size("x").alias("d")).count().orderBy(F.desc("count"), F.desc("d")).first()
    d = lengths["d"] if lengths else 0
    own, fit = t.where(F.size("x") == d), fit.where(F.size("x") == d)
    n, sums, cov = covariance(fit, d) if d else (0, [], np.zeros((0, 0)))
    values, axes = np.linalg.eigh(cov)
    values, axes = values[::-1], axes[:, ::-1]
    trace = float(np.trace(cov))
    k = int((values[:components] > 1e-12 * trace).sum()) if trace > 0 else 0
    mean = np.array([[s // n for s in sums], [(s % n) / n for s in sums]], np.float64) if n else np.zeros((2, d))
    map_ = axes[:, :k] / np.sqrt(values[:k])
    state = (0, None, None)
    if k:
        for r in fit.mapInArrow(_moments(mean, map_), "n long, mean array<double>, products array<double>").toLocalIterator():
            if r["n"]:
                state = merged(state, (r["n"], np.array(r["mean"]), np.array(r["products"]).reshape(k, k)))
    error = float(np.abs(state[2] / state[0] - np.eye(k)).max()) if k else 0.0
    model = spark.sparkContext.broadcast((n, sums, mean, map_, (values[:k] / trace if k else values[:0])))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, mean, map_, explained = model.value
        k = len(explained)
        for batch in batches:
            if not batch.num_rows or not k:
                continue
            x = rows_of(batch.column("x"))
            rows = len(x)
            each = pa.array(np.repeat(np.arange(rows), k))
            columns = [batch.column("vec_id").take(each), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), rows)), pa.array(np.full(rows * k, n)), pa.array(deviations(x, n, sums), pa.int64()).take(each), pa.array(whitened(x, mean, map_).ravel()), pa.array(np.tile(explained, rows)), pa.array(np.full(rows * k, error))]
            yield pa.RecordBatch.from_arrays(columns, ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return own.mapInArrow(run, "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double")
