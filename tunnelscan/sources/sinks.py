"""Outputs: flagged messages (O-03), alert table (O-04), Kafka records (O-59).

Flagged rows are few and spread over many scan tasks; a ``rebalance`` before
each file write makes files of a proper size and splits a large day.

An output is seen whole or not at all: it is written beside its place, in a folder
that readers skip, and renamed when it is finished.  ``mode="overwrite"`` keeps the
old output until then; ``mode="periods"`` replaces only the days and hours that
the new rows have.
"""

from __future__ import annotations

import uuid
from typing import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunnelscan.schemas import PARTITION_COLUMNS
from tunnelscan.session import hidden_sibling, path_exists, publish, remove, replace_folder, restore_folder

# Columns whose hash spreads alert records over the partitions of a topic while
# the records of one group stay together.
KAFKA_KEY = ("src_ip", "dest_ip", "ioc")


def write_whole(df: DataFrame, path: str, mode: str = "error", partition_by: Sequence[str] = ()) -> None:
    """Parquet that is published when all of it is written.

    ``error`` (an existing path is one, as in the reference), ``overwrite``,
    ``ignore``, ``append`` (Spark's own), or ``periods``: the partitions that occur in
    ``df`` are replaced and the others stay (Spark's dynamic overwrite, which too
    moves finished partitions into place when the job ends)."""
    spark = df.sparkSession
    if mode in ("append", "periods"):
        writer = df.write.mode("append")
        if mode == "periods":
            if not partition_by:
                raise ValueError("periods are replaced in a partitioned output only")
            writer = df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)
        return
    if mode not in ("error", "errorifexists", "ignore", "overwrite"):
        raise ValueError(f"unknown write mode {mode!r}")
    restore_folder(spark, path)
    if mode != "overwrite" and path_exists(spark, path):
        if mode == "ignore":
            return
        raise FileExistsError(f"{path} exists")
    tmp = hidden_sibling(path, f"{uuid.uuid4().hex}.tmp")
    try:
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(tmp)
    except Exception:
        remove(spark, tmp)
        raise
    if mode == "overwrite":
        replace_folder(spark, tmp, path)
    elif not publish(spark, tmp, path):
        raise FileExistsError(f"{path} was written by another run")


def write_messages(df: DataFrame, path: str, mode: str = "error") -> None:
    """O-03: Parquet; by default an existing path is an error, like the reference."""
    write_whole(df.hint("rebalance"), path, mode)


def write_alerts(df: DataFrame, path: str, mode: str = "error", partitioned: bool = True) -> None:
    """O-04: alert table as Parquet, optionally laid out by ``datestr``/``hour``."""
    if partitioned and {"datestr", "hour"} <= set(df.columns):
        write_whole(df.hint("rebalance", "datestr", "hour"), path, mode, PARTITION_COLUMNS)
    else:
        write_whole(df.hint("rebalance"), path, mode)


def kafka_records(df: DataFrame, key_cols: Sequence[str] | str | None = KAFKA_KEY) -> DataFrame:
    """O-59 projection: ``key`` / ``value`` strings ready for the Kafka sink.

    The key is md5 of the '|'-joined ``key_cols`` (one column: its value; None:
    no key).  A constant such as the default alert id would send every record
    to one partition."""
    if key_cols is None:
        key = F.lit(None).cast("string")
    elif isinstance(key_cols, str):
        key = F.col(f"`{key_cols}`").cast("string")
    else:
        key = F.md5(F.concat_ws("|", *[F.col(f"`{c}`").cast("string") for c in key_cols]))
    return df.select(key.alias("key"), F.to_json(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("value"))


def write_to_kafka(df: DataFrame, topic: str, brokers: str, key_cols: Sequence[str] | str | None = KAFKA_KEY) -> None:
    """O-59: write alerts to a topic (needs the spark-sql-kafka package on the classpath)."""
    (kafka_records(df, key_cols).write.format("kafka")
     .option("kafka.bootstrap.servers", brokers).option("topic", topic).save())
