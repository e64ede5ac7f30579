"""Helpers shared by the operators: input columns, staged tables, Arrow slices."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import uuid
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tunnelscan.session import remove, shared_path

# Text bytes laid out as numpy arrays at once; whole texts only, so a longer
# single text makes a slice of its own.
SLICE_BYTES = 2 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Paths staged within a ``scratch`` block, innermost last.
_STAGED: contextvars.ContextVar[tuple] = contextvars.ContextVar("staged", default=())


def stage(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    The written files cut the lineage: a lost executor only costs a re-read.
    They stay there for the folder's own retention, as results may be read late;
    a caller that knows when they are done with removes them by ``scratch``.
    """
    path = shared_path(df.sparkSession, "llm", f"{label}-{uuid.uuid4().hex}")
    for paths in _STAGED.get()[-1:]:
        paths.append(path)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextlib.contextmanager
def scratch(spark: SparkSession):
    """Tables staged within the block are removed at its end.  What is to outlive
    it is to be written by then; the block gets the list of paths, from which
    those of tables to keep can be taken out."""
    paths: list[str] = []
    token = _STAGED.set((*_STAGED.get(), paths))
    try:
        yield paths
    finally:
        _STAGED.reset(token)
        for path in paths:
            remove(spark, path)


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """``df`` with a broadcast hint when it has at most ``max_rows`` rows.

    Give it a staged table: it is counted here and read again by the join.
    """
    return F.broadcast(df) if df.limit(max_rows + 1).count() <= max_rows else df


def id_text(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", *more) -> DataFrame:
    """The id as ``long``, the text as ``string`` and named extra expressions;
    every other column of the input is left behind, whatever its name."""
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.col(f"`{text_col}`").cast("string").alias("text"), *more)


def row_text(df: DataFrame, text_col: str = "text", *more) -> DataFrame:
    """The whole row as a struct in place of its id, the text as ``string`` and
    named extra expressions."""
    quoted = [F.col(f"`{c}`") for c in df.columns]
    return df.select(F.struct(*quoted).alias("row"), F.col(f"`{text_col}`").cast("string").alias("text"), *more)


# Largest |c| of ``integers``: 256 * c is below 2**53 and so exact as a double.
LARGEST = float(1 << 45)


def integers(vec: Column) -> Column:
    """floor(256 * c) of every component; NULL where the vector is NULL or empty or
    holds a NULL, non-finite or larger component."""
    usable = F.forall(vec, lambda c: c.isNotNull() & ~F.isnan(c.cast("double")) & (F.abs(c.cast("double")) < LARGEST))
    return F.when(vec.isNotNull() & usable & (F.size(vec) > 0), F.transform(vec, lambda c: F.floor(c.cast("double") * 256)))


def keyed(df: DataFrame, ddl: str) -> StructType:
    """The first column of ``df`` and the columns of ``ddl``."""
    return StructType([df.schema[0], *StructType.fromDDL(ddl).fields])


def keyed_batch(schema: pa.Schema, key: pa.Array, *columns) -> pa.RecordBatch:
    """``batch_of`` with the first column as it came, an id or a row."""
    return batch_of(schema.set(0, schema.field(0).with_type(key.type)), key, *columns)


def as_strings(col) -> pa.Array:
    """One string array with 64-bit offsets and '' in place of NULL."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return pc.fill_null(col.cast(pa.large_string()), "")


def slices(col: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, at least one row each."""
    if not len(col):
        return
    ends = np.cumsum(pc.binary_length(col).to_numpy(zero_copy_only=False))
    start, n = 0, len(col)
    while start < n:
        base = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, base + limit, side="right")))
        yield start, stop
        start = stop
    give_back()


def give_back() -> None:
    """Return freed memory to the system: a Python worker lives on between
    tasks, and what it keeps counts against its executor."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)   # glibc only
    if trim:
        trim(0)


def flat(col: pa.LargeStringArray) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (rows + 1, from 0) of a string array."""
    n = len(col)
    offs = np.frombuffer(col.buffers()[1], dtype=np.int64, count=n + 1, offset=col.offset * 8)
    data = col.buffers()[2]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.empty(0, np.uint8)
    return raw[offs[0]:offs[-1]], offs - offs[0]


def word_spans(data: np.ndarray, offs: np.ndarray, is_word: np.ndarray):
    """Start, end (bytes) and row of every maximal run of word bytes.

    ``is_word`` has 256 booleans; a run never crosses two rows.
    """
    if not data.size:
        empty = np.empty(0, np.int64)
        return empty, empty, empty
    w = is_word[data]
    first, last = w.copy(), w.copy()
    first[1:] &= ~w[:-1]
    last[:-1] &= ~w[1:]
    full = np.flatnonzero(offs[1:] > offs[:-1])
    at = offs[:-1][full]
    first[at] |= w[at]
    at = offs[1:][full] - 1
    last[at] |= w[at]
    starts = np.flatnonzero(first)
    ends = np.flatnonzero(last) + 1
    return starts, ends, np.searchsorted(offs, starts, side="right") - 1


# Odd multipliers of the polynomial and mixing hashes.
_POLY = 0x9E3779B97F4A7C15
_POLY_INV = pow(_POLY, -1, 1 << 64)


def mix(h: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (xor-shift and multiply)."""
    h = h ^ (h >> np.uint64(30))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h = h ^ (h >> np.uint64(27))
    h = h * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, base: int = _POLY) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def span_tables(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums and inverse powers that give the hash of any span."""
    total = np.zeros(data.size + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * powers(data.size), out=total[1:])
    return total, powers(data.size + 1, _POLY_INV)


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, tables=None) -> np.ndarray:
    """64-bit hash of every span's bytes, independent of where it stands."""
    total, inverse = tables or span_tables(data)
    h = (total[ends] - total[starts]) * inverse[starts]
    return mix(h + (ends - starts).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


def list_array(values: np.ndarray, offsets: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(values, kind))


def batch_of(schema: pa.Schema, *columns) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [c if isinstance(c, pa.Array) else pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)
