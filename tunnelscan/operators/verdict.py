"""Per-group verdict: O-21..O-27, O-29, O-30, O-33..O-40."""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunnelscan.config import ScoringConfig
from tunnelscan.functions.labels import prediction_label
from tunnelscan.operators.joins import DEFAULT_BROADCAST_ROWS, Sized, materialise
from tunnelscan.schemas import KEYS


def with_label_str(df: DataFrame, prediction: str = "prediction") -> DataFrame:
    """O-21: class name of the model output."""
    return df.withColumn("label_str", prediction_label(prediction))


def with_indicators(df: DataFrame) -> DataFrame:
    """O-22: 0/1 ``normal`` and ``tunnel``; a NULL label is 0 in both."""
    is_normal = F.col("label_str") == F.lit("normal")
    return (df.withColumn("normal", F.when(is_normal, 1).otherwise(0))
              .withColumn("tunnel", F.when(F.col("label_str") != F.lit("normal"), 1).otherwise(0)))


def non_normal(df: DataFrame) -> DataFrame:
    """O-23: ``label_str != 'normal'`` (a NULL label is not kept)."""
    return df.where(F.col("label_str") != F.lit("normal"))


def suspicious_keys(pred: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """O-33: distinct groups holding any non-normal row."""
    return non_normal(pred).select(*keys).distinct()


def suspicious_rows(pred: DataFrame, keys: Sequence[str] = KEYS,
                    max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """O-29: every row of a suspicious group, as a left-semi join on the keys."""
    sized = materialise(suspicious_keys(pred, keys))
    return pred.join(sized.for_join(max_broadcast_rows), list(keys), "left_semi")


def group_stats(df: DataFrame, keys: Sequence[str] = KEYS, approx_distinct: bool = False,
                rsd: float = 0.01, extra: Sequence[Column] = ()) -> DataFrame:
    """O-34..O-38: one aggregate per group.

    ``unique_QNAME_count`` is exact by default (Catalyst plans it as a
    partial dedupe on (keys, QNAME) followed by a count; a hot group is
    spread over many reducers by QNAME).  The ratios' denominators are at
    least 1.  ``extra``: more aggregates of the same pass.
    """
    distinct = (F.approx_count_distinct("QNAME", rsd) if approx_distinct
                else F.count_distinct("QNAME"))
    stats = df.groupBy(*keys).agg(
        distinct.cast("long").alias("unique_QNAME_count"),
        F.count(F.col(keys[-1])).alias("2ld_count"),
        F.sum("normal").cast("long").alias("normal_count"),
        F.sum("tunnel").cast("long").alias("tunnel_count"),
        *extra,
    )
    return with_shares(stats)


def with_shares(stats: DataFrame) -> DataFrame:
    """O-38."""
    return (stats
            .withColumn("unique_QNAME_perc", F.col("unique_QNAME_count") / F.col("2ld_count"))
            .withColumn("tunnel_perc", F.col("tunnel_count") / F.col("2ld_count")))


def alerting_groups(stats: DataFrame, cfg: ScoringConfig) -> DataFrame:
    """O-24: both share thresholds, inclusive."""
    return stats.where((F.col("unique_QNAME_perc") >= F.lit(cfg.min_unique_qname_share))
                       & (F.col("tunnel_perc") >= F.lit(cfg.min_tunnel_share)))


def with_alert_id(df: DataFrame, mode: str = "constant", keys: Sequence[str] = KEYS) -> DataFrame:
    """O-25 (``constant``: -1, as the reference emits) or O-26, a deterministic
    id of the group keys: ``hash`` is the first 60 bits of md5 of the
    '|'-joined keys (portable: any engine with md5 gives the same id),
    ``xxhash`` is Spark's 64-bit ``xxhash64``."""
    cols = [F.col(f"`{k}`") for k in keys]
    if mode == "constant":
        return df.select("*", F.lit(-1).alias("alert_id"))
    if mode == "hash":
        hex15 = F.substring(F.md5(F.concat_ws("|", *cols)), 1, 15)
        return df.select("*", F.conv(hex15, 16, 10).cast("long").alias("alert_id"))
    if mode == "xxhash":
        return df.select("*", F.xxhash64(*cols).alias("alert_id"))
    raise ValueError(f"unknown alert id mode {mode!r}")


def join_alerts(rows: DataFrame, alerts, keys: Sequence[str] = KEYS,
                max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS) -> DataFrame:
    """O-30: rows of alerting groups with the group aggregates and ``alert_id``.

    Alerting groups are a subset of the gated groups (at most rows/min_count);
    the table is materialised, counted, and broadcast under the bound.
    ``alerts`` may be a DataFrame or an already materialised ``Sized``.
    """
    sized = alerts if isinstance(alerts, Sized) else materialise(alerts)
    return rows.join(sized.for_join(max_broadcast_rows), list(keys), "inner")


def output_messages(df: DataFrame) -> DataFrame:
    """O-27: the flagged messages as written."""
    return df.select("key", "payload")


def distinct_messages(df: DataFrame) -> DataFrame:
    """D12: equal messages once.  The whole message is its identity, so
    messages without a key or sharing one are all kept."""
    whole = F.sha2(F.to_json(F.struct("key", "payload")), 256)
    return df.withColumn("__id", whole).dropDuplicates(["__id"]).drop("__id")


def interval_stats(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts_sec",
                   bucket_seconds: int = 86400) -> DataFrame:
    """O-39: max and mean gap between successive ``ts`` within a group.

    Skew-safe in two levels, so no window partition grows with a hot group:

    1. rows collapse to distinct (keys, ts) with their multiplicity (partial
       aggregation map-side);
    2. gaps inside each (keys, day-bucket) come from a ``lag`` window over at
       most ``bucket_seconds`` distinct seconds;
    3. gaps across bucket boundaries come from a ``lag`` over the per-bucket
       (min, max), one row per bucket.

    The max gap is the larger of the two kinds.  The mean of the gaps
    telescopes to (last - first) / (n - 1).  A repeated timestamp is a zero
    gap, which only decides the max when every timestamp is equal.
    """
    return gaps_of_seconds(seconds_of(df, keys, ts), keys, ts, bucket_seconds)


def seconds_of(df: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts_sec") -> DataFrame:
    """Distinct (keys, second) with their number of rows ``__c``."""
    return df.where(F.col(ts).isNotNull()).groupBy(*keys, ts).agg(F.count(F.lit(1)).alias("__c"))


def gaps_of_seconds(seconds: DataFrame, keys: Sequence[str] = KEYS, ts: str = "ts_sec",
                    bucket_seconds: int = 86400) -> DataFrame:
    """O-39 from distinct (keys, second) with their number of rows ``__c``."""
    seconds = seconds.withColumn("__b", F.floor(F.col(ts) / F.lit(bucket_seconds)))
    inner = seconds.withColumn(
        "__gap", F.col(ts) - F.lag(ts).over(Window.partitionBy(*keys, "__b").orderBy(ts)))
    per_bucket = inner.groupBy(*keys, "__b").agg(
        F.sum("__c").alias("__n"), F.min(ts).alias("__lo"), F.max(ts).alias("__hi"),
        F.max("__gap").alias("__g"))
    across = per_bucket.withColumn(
        "__x", F.col("__lo") - F.lag("__hi").over(Window.partitionBy(*keys).orderBy("__b")))
    per_group = across.groupBy(*keys).agg(
        F.sum("__n").alias("__n"), F.min("__lo").alias("__lo"), F.max("__hi").alias("__hi"),
        F.greatest(F.max("__g"), F.max("__x")).alias("__maxgap"))
    return per_group.select(
        *keys,
        F.when(F.col("__n") >= 2, F.coalesce(F.col("__maxgap"), F.lit(0)).cast("long"))
        .alias("max_interval_time"),
        F.when(F.col("__n") >= 2, (F.col("__hi") - F.col("__lo")) / (F.col("__n") - 1))
        .alias("average_interval_time"),
    )
