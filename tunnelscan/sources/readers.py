"""Inputs: the '~' training sample (O-01), the nested hourly DNS log (O-02),
and the threshold config (O-07).  Model loading (O-06) is in operators.model.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunnelscan.config import ScoringConfig
from tunnelscan.schemas import DNS_LOG_SCHEMA, DNS_MESSAGE_SCHEMA, PARTITION_COLUMNS, TRAINING_SAMPLE_SCHEMA


def read_training_sample(spark: SparkSession, path: str, sep: str = "~",
                         schema=None) -> DataFrame:
    """O-01: delimited text with a header, every column a string.

    Column names come from the header (extra columns pass through); an empty
    field reads as NULL.  Pass ``schema`` to pin the three required columns.
    """
    reader = spark.read.option("header", True).option("sep", sep).option("inferSchema", False)
    if schema is not None:
        reader = reader.schema(schema)
    df = reader.csv(path)
    missing = [f.name for f in TRAINING_SAMPLE_SCHEMA.fields if f.name not in df.columns]
    if missing:
        raise ValueError(f"training sample lacks columns {missing}")
    return df


def merged_schema(found: T.StructType, declared: T.StructType) -> T.StructType:
    """``found`` with declared fields that it lacks added (they read as NULL).

    Fields that are not declared stay, at any depth; a field that is declared
    must have the declared type, up to the fields of structs."""
    out = []
    by_name = {f.name: f for f in declared.fields}
    for f in found.fields:
        want = by_name.pop(f.name, None)
        out.append(T.StructField(f.name, f.dataType if want is None else _merged(f.dataType, want.dataType, f.name)))
    return T.StructType(out + list(by_name.values()))


def _merged(found: T.DataType, declared: T.DataType, name: str) -> T.DataType:
    if isinstance(found, T.StructType) and isinstance(declared, T.StructType):
        return merged_schema(found, declared)
    if isinstance(found, T.ArrayType) and isinstance(declared, T.ArrayType):
        return T.ArrayType(_merged(found.elementType, declared.elementType, name))
    # Parquet readers widen an int to the declared long.
    if found != declared and not (isinstance(found, T.IntegerType) and isinstance(declared, T.LongType)):
        raise ValueError(f"field {name} is {found.simpleString()}, expected {declared.simpleString()}")
    return declared


def read_dns_log(spark: SparkSession, path: str, datestr: str | None = None,
                 hour: str | None = None, partitioned: bool = True,
                 base_path: str | None = None, merge_files: bool = False) -> DataFrame:
    """O-02: nested DNS messages from Parquet, with their whole payload.

    ``path`` is the table root; ``datestr`` / ``hour`` become partition
    filters (pruned at planning time) instead of a hand-written path glob.
    A glob inside the partition directories (``root/datestr=…/hour=…/part-*``)
    also works when ``base_path`` names the root, so the partition values are
    still read from the path.

    The schema is that of the files (of one file, or of all with
    ``merge_files``) plus the declared fields they lack, which read as NULL;
    undeclared payload fields are kept.  Partition values stay strings ("00"),
    and each plan still reads only the nested fields it uses.
    """
    reader = spark.read.option("mergeSchema", merge_files)
    if base_path is not None:
        reader = reader.option("basePath", base_path)
    found = reader.parquet(path).schema
    parts = [f for f in DNS_LOG_SCHEMA.fields if f.name in PARTITION_COLUMNS]
    data = T.StructType([f for f in found.fields if not (partitioned and f.name in PARTITION_COLUMNS)])
    schema = merged_schema(data, DNS_MESSAGE_SCHEMA)
    if partitioned:
        schema = T.StructType(schema.fields + parts)
    df = reader.schema(schema).parquet(path)
    if datestr is not None:
        df = df.where(F.col("datestr") == F.lit(datestr))
    if hour is not None:
        df = df.where(F.col("hour") == F.lit(hour))
    return df


def load_config(path: str | None = None, spark: SparkSession | None = None, **overrides) -> ScoringConfig:
    """O-07: the JSON config (five keys) or the defaults.

    With ``spark`` the file is read through its file systems (a path on HDFS,
    say), otherwise from the driver's own disk."""
    if path and spark is not None:
        text = "\n".join(r[0] for r in spark.read.option("wholetext", True).text(path).collect())
        cfg = ScoringConfig.from_dict(json.loads(text))
    else:
        cfg = ScoringConfig.from_json(path) if path else ScoringConfig()
    return cfg.with_(**overrides) if overrides else cfg
