"""Join helpers: broadcast a side only after its size has been checked."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Upper bounds on a table that may be shipped to every executor: rows, and
# bytes of its values (strings by their length, other columns 8 bytes).
DEFAULT_BROADCAST_ROWS = 500_000
DEFAULT_BROADCAST_BYTES = 64 << 20


@dataclass(frozen=True)
class Sized:
    """A materialised side table, its exact row count and the bytes it holds."""

    df: DataFrame
    rows: int
    size: int = 0

    def small(self, max_rows: int = DEFAULT_BROADCAST_ROWS, max_bytes: int = DEFAULT_BROADCAST_BYTES) -> bool:
        return self.rows <= max_rows and self.size <= max_bytes

    def for_join(self, max_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
        """Broadcast hint when small enough; otherwise leave it to a shuffle join."""
        return F.broadcast(self.df) if self.small(max_rows) else self.df


def row_bytes(df: DataFrame):
    """Bytes of a row's values: the length of strings, 8 for anything else."""
    size = F.lit(0)
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        size = size + (F.coalesce(F.octet_length(c), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(8))
    return size


def sized(df: DataFrame) -> Sized:
    """Count the rows and bytes of a table whose lineage is already cut."""
    r = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(row_bytes(df)), F.lit(0)).alias("b")).first()
    return Sized(df, int(r["n"]), int(r["b"]))


def materialise(df: DataFrame) -> Sized:
    """Write ``df`` to the shared checkpoint folder and measure it.

    The checkpoint cuts lineage (an executor loss later re-reads the written
    files rather than recomputing the whole upstream plan) and makes the count
    a cheap re-read instead of a second evaluation of the plan.  (Observing the
    count during the checkpoint job fails to serialise when the plan holds an
    MLlib model, so the count stays a separate small job.)
    """
    return sized(df.checkpoint(eager=True))
