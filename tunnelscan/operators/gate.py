"""Volume gate per (source, destination, domain): O-28, O-31, O-32."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunnelscan.operators.joins import DEFAULT_BROADCAST_ROWS, Sized, materialise, sized
from tunnelscan.schemas import KEYS


def group_counts(df: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """O-31: rows per group (partial count map-side, then a thin shuffle)."""
    return df.groupBy(*keys).count()


def busy_groups(df: DataFrame, min_count: int, keys: Sequence[str] = KEYS) -> DataFrame:
    """O-31 + O-32: groups with at least ``min_count`` rows (inclusive).

    A row with a NULL key is in no group: the joins on the keys reject it (D10)."""
    for k in keys:
        df = df.where(F.col(f"`{k}`").isNotNull())
    return group_counts(df, keys).where(F.col("count") >= F.lit(min_count))


def counted_gate(rows: DataFrame, min_count: int, wanted: Column, undomained: Column,
                 keys: Sequence[str] = KEYS) -> tuple[Sized, dict]:
    """The busy groups of the ``wanted`` rows, materialised, and the row counts of
    O-40 from the same job: a second grouping set without keys, of which each task
    sends one row.  (An ``Observation`` would keep MLlib's models from being
    serialised for the rest of the session.)
    """
    groups = rows.groupingSets([[F.col(f"`{k}`") for k in keys], []], *[F.col(f"`{k}`") for k in keys]).agg(
        F.grouping_id().alias("__total"), F.count_if(wanted).alias("count"), F.count(F.lit(1)).alias("question_rows"),
        F.count_if(undomained).alias("undomained_rows"))
    # A group without a wanted row is none.
    busy = F.col("count") >= F.lit(max(min_count, 1))
    for k in keys:
        busy &= F.col(f"`{k}`").isNotNull()
    kept = groups.where(busy | (F.col("__total") > 0)).checkpoint(eager=True)
    total = kept.where("__total > 0").select("question_rows", "undomained_rows", F.col("count").alias("candidate_rows")).first()
    seen = total.asDict() if total else dict.fromkeys(["question_rows", "undomained_rows", "candidate_rows"], 0)
    return sized(kept.where("__total = 0").select(*keys, "count")), seen


def volume_gate(df: DataFrame, min_count: int, keys: Sequence[str] = KEYS,
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """O-28: keep rows of busy groups and add their ``count``.

    The busy-group table is thin and has at most rows/min_count entries; it is
    written to the shared checkpoint folder, measured, and broadcast when under
    the bounds, so the rows are not shuffled.  Above the bounds it is a shuffle
    join (AQE splits skewed keys): give it rows without the payload.

    Key joins are null-rejecting: rows with a NULL key drop out (D10).
    """
    busy = materialise(busy_groups(df, min_count, keys))
    return df.join(busy.for_join(max_broadcast_rows), list(keys), "inner")
