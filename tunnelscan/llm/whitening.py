"""Whitening of embeddings, every distinct vector once.

A component c becomes the integer x = floor(256 * c).  Rows with the same x vector
are grouped; the fit takes each distinct vector with weight one (``weights="one"``)
or with its number of rows (``weights="count"``).  The covariance is a weighted GEMM
of the centred vectors, block by block; its eigenvectors, numbered by falling
eigenvalue, give the whitened components (x - mean) . component / sqrt(eigenvalue).

Plan: grouping combines equal vectors map-side, so a vector that a third of all
rows share is one row for each task.  The distinct vectors are staged.  Sums and
the matrix of products are partial results of each task (``dim`` rows of ``dim``
numbers), added up by Spark; the driver gets the ``dim`` x ``dim`` matrix.  Distinct
vectors are whitened map-side and joined back to the rows by a 128-bit digest, so
the vectors themselves are shuffled once, after the combine.

Edge cases: a vector that is NULL or holds a NULL or non-finite component takes no
part, nor does one with a component of 2**45 or more (its x would not be exact); a
NULL id is returned as it is; vectors of each length are fitted apart, empty ones
are left out; a component whose eigenvalue is zero but for rounding is not
returned, so vectors that are all equal give no rows; repeated rows are returned
each; ``deviation`` is a decimal, NULL above 38 digits; an empty table gives an
empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunnelscan.llm.common import batch_of, integers, list_array, stage

TOP = 4
# Vectors centred and multiplied at once.
BLOCK = 4096
# Eigenvalues below this share of the largest, times the dimension, are rounding.
EPSILON = 1e-14

_SUMS = pa.schema([("n", pa.int64()), ("pos", pa.int32()), ("total", pa.string())])
_PRODUCTS = pa.schema([("pos", pa.int32()), ("products", pa.list_(pa.float64()))])
_WHITE = pa.schema([("h1", pa.int64()), ("h2", pa.int64()), ("w", pa.int64()), ("deviation", pa.string()),
                    ("whitened", pa.list_(pa.float64()))])
_WHITE_SQL = "h1 long, h2 long, w long, deviation string, whitened array<double>"


def _blocks(batches, dim: int):
    """x vectors (int64) and weights of at most ``BLOCK`` rows."""
    for batch in batches:
        x = batch.column(0)
        x = x.flatten().to_numpy(zero_copy_only=False).reshape(len(x), dim)
        w = batch.column(1).to_numpy(zero_copy_only=False)
        for a in range(0, len(x), BLOCK):
            yield x[a:a + BLOCK], w[a:a + BLOCK]


def _sums(dim: int):
    """One row for each dimension: weights and exact weighted sum of a task."""
    def run(batches):
        n, total = 0, [0] * dim
        for x, w in _blocks(batches, dim):
            n += int(w.sum())
            # Halves of 27 bits, so that no sum of a block leaves 64 bits.
            for shift, part in ((27, x >> 27), (0, x & ((1 << 27) - 1))):
                heavy = int(w.max()) >= 1 << 22
                s = (part.astype(object) * w[:, None]).sum(axis=0) if heavy else (part * w[:, None]).sum(axis=0)
                total = [t + (int(v) << shift) for t, v in zip(total, s)]
        if n:
            yield batch_of(_SUMS, [n] * dim, np.arange(dim, dtype=np.int32), [str(t) for t in total])
    return run


def _products(mean: np.ndarray):
    """One row for each dimension: the weighted products of the centred vectors of a task."""
    dim = len(mean)

    def run(batches):
        out = np.zeros((dim, dim))
        for x, w in _blocks(batches, dim):
            centred = x - mean
            out += centred.T @ (centred * w[:, None])
        yield batch_of(_PRODUCTS, np.arange(dim, dtype=np.int32),
                       list_array(out.ravel(), np.arange(dim + 1) * dim, pa.float64()))
    return run


def _deviations(x: np.ndarray, n: int, sums: list[int]) -> list[str]:
    """Sum over the dimensions of (n * x - S)^2, exact."""
    far = n * int(np.abs(x).max()) + max(map(abs, sums))
    exact = x if far < 1 << 62 else x.astype(object)
    d = n * exact - np.array(sums, dtype=exact.dtype)
    if far * far * len(sums) >= 1 << 63:
        d = d.astype(object)
    return [str(int(v)) for v in (d * d).sum(axis=1)]


def _whiten(n: int, sums: list[int], mean: np.ndarray, scaled: np.ndarray):
    top = scaled.shape[1]

    def run(batches):
        for batch in batches:
            at = 0
            for x, w in _blocks([batch.select(["x", "w"])], len(mean)):
                white = (x - mean) @ scaled
                yield batch_of(_WHITE, batch.column(0).slice(at, len(x)), batch.column(1).slice(at, len(x)), w,
                               _deviations(x, n, sums),
                               list_array(white.ravel(), np.arange(len(x) + 1) * top, pa.float64()))
                at += len(x)
    return run


def _fit(distinct: DataFrame, dim: int) -> tuple[int, list[int], np.ndarray]:
    """Total weight, weighted sums and the covariance, of the driver's size ``dim``."""
    exact = distinct.mapInArrow(_sums(dim), "n long, pos int, total string").groupBy("pos").agg(
        F.sum("n").alias("n"), F.sum(F.col("total").cast("decimal(38,0)")).alias("total")).orderBy("pos").collect()
    n, sums = int(exact[0]["n"]), [int(r["total"]) for r in exact]
    mean = np.array([s / n for s in sums])
    parts = distinct.mapInArrow(_products(mean), "pos int, products array<double>").select(
        "pos", F.posexplode("products").alias("to", "v"))
    rows = parts.groupBy("pos", "to").agg(F.sum("v").alias("v")).groupBy("pos").agg(
        F.transform(F.array_sort(F.collect_list(F.struct("to", "v"))), lambda e: e["v"]).alias("v")).toArrow().sort_by("pos")
    matrix = np.array(rows["v"].to_pylist(), dtype=np.float64)
    return n, sums, (matrix + matrix.T) / (2 * n)


def _components(covariance: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    """Eigenvalues, falling, and unit eigenvectors as columns, those of rounding
    left out; the largest entry of a component is positive."""
    values, vectors = np.linalg.eigh(covariance)
    order = np.argsort(-values, kind="stable")[:top]
    order = order[values[order] > EPSILON * len(values) * max(values.max(), 0.0)]
    vectors = vectors[:, order]
    signs = np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(len(order))]) if len(order) else np.ones(0)
    return values[order], vectors * signs


def _identity_error(white: DataFrame, n: int, top: int) -> float:
    """Largest absolute entry of the whitened vectors' covariance minus the identity."""
    part = [F.col("whitened")[k] for k in range(top)]
    mean = white.agg(*[(F.sum(F.col("w") * x) / n).alias(str(k)) for k, x in enumerate(part)]).first()
    centred = [x - F.lit(mean[k]) for k, x in enumerate(part)]
    entries = [F.sum(F.col("w") * centred[i] * centred[j]) / n - F.lit(float(i == j)) for i in range(top) for j in range(i, top)]
    return max(map(abs, white.agg(*[e.alias(str(k)) for k, e in enumerate(entries)]).first()))


def whiten(vectors: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding", top: int = TOP,
           weights: str = "one") -> DataFrame:
    """``vec_id``, ``component`` (from 1), ``n`` (total weight of the fit),
    ``deviation`` (sum of (n x - S)^2), ``whitened``, ``explained`` (share of the
    total variance) and ``identity_error`` for every usable row."""
    if weights not in ("one", "count"):
        raise ValueError(f"weights are 'one' or 'count', not {weights!r}")
    x = integers(F.col(f"`{vec_col}`"))
    digest = [F.xxhash64("x").alias("h1"), F.xxhash64(F.lit("x"), "x").alias("h2")]
    rows = vectors.select(F.col(f"`{id_col}`").alias("vec_id"), x.alias("x")).where("x is not null")
    weight = F.lit(1).cast("long") if weights == "one" else F.count(F.lit(1))
    distinct = stage(rows.groupBy("x").agg(weight.alias("w")).select(*digest, "x", "w"), "distinct-vectors")
    thin = rows.select("vec_id", *digest)
    dims = [r["dim"] for r in distinct.select(F.size("x").alias("dim")).distinct().collect()]
    out = None
    for dim in dims:
        part = _whiten_dim(distinct.where(F.size("x") == dim), dim, top)
        out = part if out is None else out.unionByName(part)
    if out is None:
        kind = vectors.schema[id_col].dataType.simpleString()
        return vectors.sparkSession.createDataFrame(
            [], f"vec_id {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, "
                "identity_error double")
    return (thin.join(out, ["h1", "h2"])
            .select("vec_id", "n", "deviation", "identity_error",
                    F.posexplode(F.arrays_zip("whitened", "explained")).alias("component", "of"))
            .select("vec_id", (F.col("component") + 1).alias("component"), "n", "deviation",
                    F.col("of.whitened").alias("whitened"), F.col("of.explained").alias("explained"), "identity_error"))


def _whiten_dim(distinct: DataFrame, dim: int, top: int) -> DataFrame:
    """Digest, deviation and whitened components of every distinct vector of one length."""
    n, sums, covariance = _fit(distinct.select("x", "w"), dim)
    values, components = _components(covariance, top)
    mean = np.array([s / n for s in sums])
    explained = values / np.trace(covariance) if len(values) else values
    white = stage(distinct.select("h1", "h2", "x", "w").mapInArrow(
        _whiten(n, sums, mean, components / np.sqrt(values)), _WHITE_SQL), "white")
    error = _identity_error(white, n, len(values)) if len(values) else None
    return white.select("h1", "h2", F.expr("try_cast(deviation as decimal(38,0))").alias("deviation"), "whitened",
                        F.lit(n).cast("long").alias("n"), F.array(*[F.lit(float(v)) for v in explained]).cast(
                            "array<double>").alias("explained"), F.lit(error).cast("double").alias("identity_error"))


def op13_whitening(embeddings: DataFrame) -> DataFrame:
    # A deviation above the range of long is NULL.
    return whiten(embeddings).withColumn("deviation", F.expr("try_cast(deviation as long)"))
