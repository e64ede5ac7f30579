from support import explain
import random

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunnelscan.operators.features import generate_features
from tunnelscan.schemas import ANSWER_FEATURES, FEATURE_COLUMNS, NAME_FEATURES

from pymodel import answer_features as py_answers
from pymodel import name_features as py_names

SCHEMA = T.StructType([T.StructField("QNAME", T.StringType()), T.StructField("lld", T.StringType()),
                       T.StructField("RDATA", T.ArrayType(T.StringType()))])

# FIXTURES.md section 5, rows 1-6 and 8-11 (array mode).
GOLDEN = [
    ("a.b.example.com.", "example.com", ["1.2.3.4", "AB12"],
     [4, 1.5, 0.666667, 0, 1, 2, 0, 0], [5.5, 7, 0.25, 0.535714, 2.064043]),
    ("a.b.example.com", "example.com", ["x"],
     [15, 3.189898, 3, 1, 7, 3, 0, 0], [1, 1, 0, 0, 0]),
    ("example.com.", "example.com", [], [0, 0, 0, 0, 0, 0, 0, 0], [0, 0, 0, 0, 0]),
    ("EXAMPLE.com.", "example.com", ["aa"],
     [12, 3.251629, 3.333333, 0, 7, 2, 0.583333, 0], [2, 2, 0, 0, 0]),
    ("x1Y2.Ab.example.co.uk.", "example.co.uk", ["v=spf1 -all"],
     [8, 2.75, 2, 0, 4, 2, 0.25, 0.25], [11, 11, 0, 0.090909, 3.277613]),
    ("q.example.com.example.com.", "example.com", ["a"],
     [2, 1, 0.5, 0, 1, 1, 0, 0], [1, 1, 0, 0, 0]),
    ("a.example.com.", None, ["a"], [None] * 8, [1, 1, 0, 0, 0]),
    ("a.example.com.", "example.com", None, [2, 1.0, 0.5, 0, 1, 1, 0, 0], [None] * 5),
    ("a.example.com.", "example.com", ["A1", None], [2, 1.0, 0.5, 0, 1, 1, 0, 0], [None, 2, None, None, None]),
    ("a.example.com.", "example.com", ["A1", ""], [2, 1.0, 0.5, 0, 1, 1, 0, 0], [1, 2, None, None, 0.5]),
]


def _close(a, b):
    if a is None or b is None:
        return a is None and b is None
    return abs(float(a) - float(b)) < 1e-6


@pytest.mark.parametrize("impl", ["arrow", "native"])
def test_golden_rows(spark, impl):
    df = spark.createDataFrame([(q, d, r) for q, d, r, _, _ in GOLDEN], SCHEMA)
    out = generate_features(df, entropy_impl=impl).select(*FEATURE_COLUMNS).collect()
    for (q, d, r, names, answers), row in zip(GOLDEN, out):
        got = [row[c] for c in FEATURE_COLUMNS]
        for name, want, have in zip(FEATURE_COLUMNS, names + answers, got):
            assert _close(round(have, 6) if have is not None else None, want), (q, d, r, name, have, want)


def test_chars_mode_golden_row(spark):
    # FIXTURES.md section 5, row 7: RDATA as a string walked character by character.
    df = spark.createDataFrame([("a.b.example.com.", "example.com", "1.2.A")], "QNAME string, lld string, RDATA string")
    row = generate_features(df, rdata_mode="chars").first()
    assert [round(row[c], 6) for c in ANSWER_FEATURES] == [1.0, 1.0, 0.2, 0.4, 0.0]
    assert row["subdomain_length"] == 4 and row["subdomain_entropy"] == 1.5


def test_chars_mode_equals_array_of_characters(spark):
    vals = ["1.2.A", "", "AbC9z", "ééÉ1", None]
    df = spark.createDataFrame([("x.", "x", v) for v in vals], "QNAME string, lld string, RDATA string")
    chars = generate_features(df, rdata_mode="chars").select(*ANSWER_FEATURES).collect()
    from tunnelscan.functions.lexical import answer_array
    arr = generate_features(df.withColumn("RDATA", answer_array("RDATA", "chars"))).select(*ANSWER_FEATURES).collect()
    for a, b in zip(chars, arr):
        for c in ANSWER_FEATURES:
            assert _close(a[c], b[c]), (c, a, b)


def test_string_rdata_with_delimiter(spark):
    df = spark.createDataFrame([("a.x.", "x", "AB|1.2")], "QNAME string, lld string, RDATA string")
    row = generate_features(df, delimiter="|").first()
    assert row["average_answer_length"] == 2.5 and row["max_answer_length"] == 3.0


def _random_name(rng):
    alphabet = "abcXYZ0129-_É"
    labels = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 6))) for _ in range(rng.randint(1, 4))]
    name = ".".join(labels) + rng.choice(["", "."])
    return name


@pytest.mark.parametrize("impl", ["arrow", "native"])
def test_random_rows_match_python_model(spark, impl):
    rng = random.Random(7)
    rows = []
    for _ in range(400):
        dom = rng.choice(["example.com", "b.co", "x"])
        q = _random_name(rng) + rng.choice(["", "." + dom, "." + dom + "."])
        items = None if rng.random() < 0.05 else [
            None if rng.random() < 0.03 else "".join(rng.choice("aB3.=é ") for _ in range(rng.randint(0, 8)))
            for _ in range(rng.randint(0, 4))]
        rows.append((q, None if rng.random() < 0.05 else dom, items))
    df = spark.createDataFrame(rows, SCHEMA)
    out = generate_features(df, entropy_impl=impl).select(*FEATURE_COLUMNS).collect()
    for (q, d, r), row in zip(rows, out):
        want = py_names(q, d) + py_answers(r)
        for name, w in zip(FEATURE_COLUMNS, want):
            assert _close(row[name], w), (q, d, r, name, row[name], w)


def test_python_only_through_arrow(spark):
    df = spark.createDataFrame([(q, d, r) for q, d, r, _, _ in GOLDEN], SCHEMA)
    native = explain(generate_features(df, entropy_impl="native"))
    assert "BatchEvalPython" not in native and "ArrowEvalPython" not in native
    arrow = explain(generate_features(df))
    assert "BatchEvalPython" not in arrow and "ArrowEvalPython" in arrow


@pytest.mark.parametrize("value", ["a", "aaaa", "ÉÉ"])
def test_single_symbol_entropy_is_positive_zero(spark, value):
    from tunnelscan.functions.lexical import entropy
    v = spark.range(1).select(entropy(F.lit(value)).alias("e")).first()["e"]
    assert v == 0.0 and str(v) == "0.0"


def test_name_feature_types(spark):
    df = spark.createDataFrame([(q, d, r) for q, d, r, _, _ in GOLDEN[:1]], SCHEMA)
    types = dict(generate_features(df).dtypes)
    assert types["subdomain_length"] == "int" and types["label_count"] == "int"
    assert all(types[c] == "double" for c in NAME_FEATURES if c not in ("subdomain_length", "label_count"))
