"""Feature generation over a DataFrame (the thirteen O-41..O-53 columns)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunnelscan.functions.lexical import (
    answer_array,
    answer_features,
    char_answer_features,
    name_features,
    subdomain,
    valid_text,
)
from tunnelscan.schemas import FEATURE_COLUMNS


def generate_features(df: DataFrame, qname: str = "QNAME", domain: str = "lld", rdata: str = "RDATA",
                      rdata_mode: str = "array", delimiter: str | None = None,
                      entropy_impl: str = "arrow") -> DataFrame:
    """Append the thirteen features.

    The subdomain and the answer array are computed once in their own
    projection; the features read them (Catalyst keeps the projection rather
    than inlining an expensive expression into thirteen places).

    ``entropy_impl='arrow'`` (default) computes the two entropy features in an
    Arrow-batched pandas UDF vectorised with numpy; ``'native'`` keeps them in
    higher-order functions.  Measured on 722k DNS rows (local[8], all thirteen
    features): 8.8 s vs 16.0 s, results equal to 1e-15.
    """
    is_array = isinstance(df.schema[rdata].dataType, T.ArrayType)
    if rdata_mode == "chars" and is_array:
        raise ValueError("rdata_mode='chars' needs a string RDATA column")
    sub, arr = "__feat_sub", "__feat_arr"
    # Invalid bytes are replaced first, so that all features see the same characters.
    staged = df.withColumn(sub, valid_text(subdomain(qname, domain)))
    if rdata_mode == "chars":
        answer = char_answer_features(valid_text(rdata))
    else:
        items = answer_array(rdata, "array", delimiter, is_array)
        staged = staged.withColumn(arr, F.transform(items, lambda i: F.make_valid_utf8(i)))
        answer = answer_features(F.col(arr), entropy_impl)
    feats = {**name_features(F.col(sub), entropy_impl), **answer}
    out = staged.select("*", *[feats[c].alias(c) for c in FEATURE_COLUMNS])
    return out.drop(sub, arr)
