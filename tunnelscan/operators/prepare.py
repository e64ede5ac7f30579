"""Projections and filters that prepare samples and DNS messages.

O-08..O-13, O-16..O-20.
"""

from __future__ import annotations

from typing import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunnelscan.functions.labels import label_index
from tunnelscan.schemas import TRAIN_LABELS


# ---- training sample -------------------------------------------------------

def clean_label(col) -> Column:
    """O-08: strip every comma from the class name (NULL stays NULL)."""
    c = F.col(col) if isinstance(col, str) else col
    return F.replace(c.cast("string"), F.lit(","), F.lit(""))


def drop_incomplete(df: DataFrame, cols: Iterable[str] = ("QNAME", "RDATA", "DnsTunnel")) -> DataFrame:
    """O-09: rows with a NULL in any of ``cols`` are dropped."""
    return df.dropna(how="any", subset=list(cols))


def keep_known_labels(df: DataFrame, col: str = "DnsTunnel",
                      labels: Iterable[str] = ("tunnel", "normal")) -> DataFrame:
    """O-10: exact-case membership."""
    return df.where(F.col(col).isin(*labels))


def clean_training_sample(df: DataFrame, label_col: str = "DnsTunnel") -> DataFrame:
    """O-08, O-09, O-10, O-20 in the reference's order; adds ``label``."""
    out = df.withColumn(label_col, clean_label(label_col))
    out = drop_incomplete(out, ("QNAME", "RDATA", label_col))
    out = keep_known_labels(out, label_col, TRAIN_LABELS.keys())
    return out.withColumn("label", label_index(label_col))


# ---- DNS messages ----------------------------------------------------------

def successful_responses(df: DataFrame) -> DataFrame:
    """O-11: responses (QR true) with NOERROR; pushed into the Parquet scan."""
    return df.where((F.col("payload.header.QR") == F.lit(True))
                    & (F.col("payload.header.responseCode") == F.lit("NOERROR")))


def explode_questions(df: DataFrame, out_col: str = "QNAME") -> DataFrame:
    """O-12: one row per question name; NULL or empty arrays give no row."""
    return df.select("*", F.explode("payload.questions.name").alias(out_col))


def flatten_message(df: DataFrame) -> DataFrame:
    """O-13: ``ts_sec``, ``srcIP``, ``destIP`` as top-level columns."""
    return df.select("*", F.col("payload.pcap.ts_sec").alias("ts_sec"),
                     F.col("payload.ip.srcIP").alias("srcIP"),
                     F.col("payload.ip.destIP").alias("destIP"))


def with_answer_data(df: DataFrame, out_col: str = "RDATA") -> DataFrame:
    """O-17: ``payload.answers.rdata`` as ``array<string>``."""
    return df.withColumn(out_col, F.col("payload.answers.rdata"))


def fill_numeric_nulls(df: DataFrame, value: int = 0, subset: Iterable[str] | None = None) -> DataFrame:
    """O-18: NULL -> 0 on numeric columns (strings and structs untouched)."""
    return df.fillna(value, subset=list(subset) if subset is not None else None)


def exclude_answers(df: DataFrame, rtypes: Iterable[str], rdata_substrings: Iterable[str],
                    answers_col: str = "payload.answers", out_col: str = "RDATA",
                    joined_delimiter: str | None = None) -> DataFrame:
    """O-19: drop answer items of an excluded record type or holding an excluded
    substring; the kept ``rdata`` values become ``out_col`` (optionally joined).
    """
    rtypes_arr = F.array(*[F.lit(t) for t in rtypes]) if rtypes else F.array().cast("array<string>")
    subs = list(rdata_substrings)

    def keep(a: Column) -> Column:
        bad_type = F.coalesce(F.array_contains(rtypes_arr, a["type"]), F.lit(False))
        bad_data = F.lit(False)
        for s in subs:
            bad_data = bad_data | F.coalesce(a["rdata"].contains(s), F.lit(False))
        return ~(bad_type | bad_data)

    kept = F.transform(F.filter(F.col(answers_col), keep), lambda a: a["rdata"])
    if joined_delimiter is not None:
        kept = F.array_join(kept, joined_delimiter)
    return df.withColumn(out_col, kept)
