"""Literal label maps (O-20, O-21): unknown keys give NULL, never an error."""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from tunnelscan.schemas import PREDICTION_LABELS, TRAIN_LABELS


def _lookup(mapping: dict, key: Column, value_type: str) -> Column:
    lit_map = F.create_map(*chain.from_iterable((F.lit(k), F.lit(v)) for k, v in mapping.items()))
    return F.try_element_at(lit_map, key).cast(value_type)


def label_index(col, mapping: dict = TRAIN_LABELS) -> Column:
    """Class name -> numeric label (``normal`` 0, ``tunnel`` 1)."""
    c = F.col(col) if isinstance(col, str) else col
    return _lookup(mapping, c, "int")


def prediction_label(col, mapping: dict = PREDICTION_LABELS) -> Column:
    """Model prediction (double) -> class name."""
    c = F.col(col) if isinstance(col, str) else col
    return _lookup({float(k): v for k, v in mapping.items()}, c.cast("double"), "string")
