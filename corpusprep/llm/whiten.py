"""Whitening of embeddings by Golub-Kahan-Lanczos bidiagonalisation.

Entries are fixed-point integers, so sums and centring are exact.  With the centred rows X (scaled by the root of
their number) the process builds orthonormal v's in the space of the dimensions and u's in the space of the rows:

    a_k u_k = X v_k - b_(k-1) u_(k-1)          b_k v_(k+1) = X'u_k - a_k v_k

Every u lies in the span of X, so u_k = X y_k is kept as the short vector y_k beside X'u_k, and no vector of the length
of the table is stored or sent.  One distributed step takes a vector y, forms X y block by block on the executors
and returns X'(X y); inner products of u's are inner products of those vectors.  Both sides are orthogonalised in full
against all earlier vectors, twice; the second time for the u's with a product of its own.  A broken-down process
(repeated or zero variances) starts anew with a vector orthogonal to all earlier ones, so it runs over all
dimensions.  The singular vectors and values of the small bidiagonal matrix give components and deviations.

The rows are written once as blocks of integers to the shared folder; a step reads them, adds up per task and
then per dimension, so the driver gets one number a dimension.  A matrix of dimensions by dimensions is
held by the driver, never anything of the length of the table.

Defined results: rows whose vector is null, empty, or holds a null, non-finite or 2^40 or larger entry are dropped, and
rows of another length than the most frequent one (the longer of equals).  Repeated rows count each.
Components without variance have none to scale by: ``whitened`` covers those with an eigenvalue above
rounding only, so constant tables and empty ones give no rows.  ``deviation`` is null where it
does not fit into a long.  A null id stays null.  Only the id and vector columns are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusprep.llm.common import saved

COMPONENTS = 32
SCALE, SHIFT = 64, 1_000_000
#: Rows of one stored block.
BLOCK_ROWS = 4096
LARGEST = float(1 << 40)
#: Eigenvalues below this share of the largest are rounding.
RANK_SHARE = 1e-12


def vectors(rows: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector array<double>) of the rows kept."""
    v = F.col("vector")
    valid = F.forall(v, lambda c: F.coalesce(F.abs(c) < LARGEST, F.lit(False)))
    rows = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector")).where(v.isNotNull() & (F.size(v) > 0) & valid)
    sizes = rows.groupBy(F.size(v).alias("dims")).count().orderBy(F.desc("count"), F.desc("dims")).limit(1).collect()
    return rows.where(F.size(v) == (sizes[0]["dims"] if sizes else 0))


class Blocks:
    """Fixed-point rows in blocks (ids array<long>, cells binary of longs) with their number and exact sums."""

    def __init__(self, rows: DataFrame, id_type: str):
        def run(batches):
            for b in batches:
                for at in range(0, b.num_rows, BLOCK_ROWS):
                    part = b.slice(at, BLOCK_ROWS)
                    column = part.column(1)
                    c = column.flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, -1)
                    x = np.floor(c * SCALE).astype(np.int64) + SHIFT
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([part.column(0).to_pylist()], pa.list_(part.schema.field(0).type)), pa.array([part.num_rows], pa.int32()), pa.array([x.tobytes()], pa.binary())],
                        names=["ids", "n", "cells"])

        self.stored = saved(rows.mapInArrow(run, f"ids array<{id_type}>, n int, cells binary"), "vector-blocks")
        sums = self.stored.select("n", "cells").mapInArrow(_sums, "dim int, n long, s decimal(38,0)")
        got = sums.groupBy("dim").agg(F.sum("n").cast("long").alias("n"), F.sum("s").alias("s")).orderBy("dim").collect()
        self.n, self.dims = (got[0]["n"], len(got)) if got else (0, 0)
        self.sums = [int(r["s"]) for r in got]

    def centred(self):
        """cells -> (n * x - S modulo 2^64, x - S / n as doubles), both from differences to the mean's whole part."""
        n, dims = self.n, self.dims
        whole = np.array([s // n for s in self.sums], dtype=np.int64)
        rest = np.array([s % n for s in self.sums], dtype=np.int64)

        def f(cells: bytes) -> tuple[np.ndarray, np.ndarray]:
            x = np.frombuffer(cells, dtype=np.int64).reshape(-1, dims) - whole
            return x * np.int64(n) - rest, x - rest / n

        return f

    def product(self, weights: np.ndarray) -> np.ndarray:
        """X'(X w) / n of the centred rows for each row of ``weights``, summed over the cluster."""
        centred, shape = self.centred(), weights.shape

        def run(batches):
            total = np.zeros(shape)
            for b in batches:
                for cells in b.column(0).to_pylist():
                    x = centred(cells)[1]
                    total += (x @ weights.T).T @ x
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size, dtype=np.int32)), pa.array(total.ravel())], names=["k", "s"])

        got = self.stored.select("cells").mapInArrow(run, "k int, s double").groupBy("k").agg(F.sum("s").alias("s")).collect()
        out = np.zeros(weights.size)
        for r in got:
            out[r["k"]] = r["s"]
        return out.reshape(shape) / self.n


def _sums(batches):
    for b in batches:
        for n, cells in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
            x = np.frombuffer(cells, dtype=np.int64).reshape(n, -1)
            s = x.sum(axis=0)  # 4096 entries below 2^47
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(s), dtype=np.int32)), pa.array(np.full(len(s), n)),
                                              pa.array(s.tolist(), pa.decimal128(38, 0))], names=["dim", "n", "s"])


def bidiagonalise(product, dims: int, seed: int = 42) -> tuple[np.ndarray, np.ndarray]:
    """(V, B): orthonormal columns v and the upper bidiagonal matrix with X V = U B, over all dimensions;
    ``product`` maps y to X'(X y)."""
    rng = np.random.default_rng(seed)
    v, y, back = (np.zeros((dims, dims)) for _ in range(3))  # rows: v_k, y_k with u_k = X y_k, X'u_k
    b = np.zeros((dims, dims))
    top = 0.0  # the largest entry of B so far, by which breakdown is judged

    def fresh(k: int) -> np.ndarray:
        w = rng.standard_normal(dims)
        for _ in range(3):
            w -= v[:k].T @ (v[:k] @ w)
            w /= np.linalg.norm(w)
        return w

    now = fresh(0)
    for k in range(dims):
        v[k] = now
        w = now - (b[k - 1, k] * y[k - 1] if k else 0.0)  # X w = X v_k - b_(k-1) u_(k-1)
        g = product(w)
        w = w - y[:k].T @ (y[:k] @ g)  # u_j' X w = y_j' X'X w
        g = product(w)
        again = y[:k] @ g
        w, g = w - y[:k].T @ again, g - back[:k].T @ again
        a = np.sqrt(max(float(w @ g), 0.0))
        top = max(top, a)
        if a > 1e-12 * top:
            b[k, k], y[k], back[k] = a, w / a, g / a
        if k + 1 == dims:
            break
        rest = back[k] - b[k, k] * v[k]
        for _ in range(2):
            rest = rest - v[:k + 1].T @ (v[:k + 1] @ rest)
        norm = float(np.linalg.norm(rest))
        if norm > 1e-12 * top:
            b[k, k + 1], now = norm, rest / norm
        else:
            now = fresh(k + 1)
    return v.T, b


def components(blocks: Blocks, count: int) -> tuple[np.ndarray, np.ndarray, float]:
    """(component vectors as rows, eigenvalues, sum of all eigenvalues) by falling eigenvalue, those above
    rounding, ``count`` at most."""
    if not blocks.n:
        return np.zeros((0, 0)), np.zeros(0), 0.0
    v, b = bidiagonalise(lambda y: blocks.product(y[None, :])[0], blocks.dims)
    _, s, right = np.linalg.svd(b)
    e = s ** 2
    keep = int((e[:count] > RANK_SHARE * max(e[0], 1e-300)).sum())
    return (right @ v.T)[:keep], e[:keep], float(e.sum())


def whiten(rows: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", count: int = COMPONENTS) -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) for every row kept and component."""
    kept = vectors(rows, id_col, vector_col)
    id_type = kept.schema["vec_id"].dataType.simpleString()
    blocks = Blocks(kept, id_type)
    found, e, spread = components(blocks, count)
    n, k = blocks.n, len(e)
    schema = f"vec_id {id_type}, component int, n long, deviation long, whitened double, explained double, identity_error double"
    if not k:
        return rows.sparkSession.createDataFrame([], schema)
    centred, scaled = blocks.centred(), found / np.sqrt(e)[:, None]
    error = float(np.abs(blocks.product(scaled) @ scaled.T - np.eye(k)).max())  # the mean of centred rows is exactly zero
    explained = e / spread

    def run(batches):
        for b in batches:
            for ids, cells in zip(b.column(0), b.column(1).to_pylist()):
                whole, x = centred(cells)
                m = len(x)
                roughly = (x ** 2).sum(axis=1) * float(n) ** 2
                exact = (whole * whole).sum(axis=1)
                deviation = pa.array(np.repeat(exact, k), mask=np.repeat(roughly > 9.2e18, k))
                yield pa.RecordBatch.from_arrays(
                    [ids.values.take(pa.array(np.repeat(np.arange(m), k))), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), m)),
                     pa.array(np.full(m * k, n)), deviation, pa.array((x @ scaled.T).ravel()), pa.array(np.tile(explained, m)),
                     pa.array(np.full(m * k, error))],
                    names=["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"])

    return blocks.stored.select("ids", "cells").mapInArrow(run, schema)
