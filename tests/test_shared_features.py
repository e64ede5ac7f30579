import random

import pyarrow as pa
from pymodel import entropy
from pyspark.sql import functions as F

from tunnelscan.functions.entropy_arrow import entropies, mean_item_entropy_udf
from tunnelscan.plans import queries
from tunnelscan.schemas import FEATURE_COLUMNS


def test_every_row_has_its_features_computed_once(spark, monkeypatch):
    seen = spark.sparkContext.accumulator(0)

    @F.udf("double")
    def feature(x):
        seen.add(1)
        return float(x)

    rng = random.Random(3)
    data = [(f"q{k}", f"r{k % 7}", float(k % 3 == 0), rng.random() + (k % 3 == 0)) for k in range(400)]

    def features(*_):
        frame = spark.createDataFrame(data, "QNAME string, RDATA string, label double, x double")
        return frame.select("QNAME", "RDATA", "label", *[
            (feature("x") if k == 0 else F.col("x") * k).alias(c) for k, c in enumerate(FEATURE_COLUMNS)])

    monkeypatch.setattr(queries, "_training_features", features)
    assert queries.lr_dt_compare(spark, "").count() == 2
    assert seen.value == len(data)


def test_entropies_of_slices_and_lists():
    strings = pa.array(["x" * 50, None, "", "abé", "😀a😀", "aa"], pa.string())
    got = entropies(strings.slice(1, 4)).tolist()
    assert got[0] != got[0] and got[1] == 0.0
    assert all(abs(g - entropy(s)) < 1e-12 for g, s in zip(got[2:], ["abé", "😀a😀"]))
    lists = pa.array([["no"], ["ab", "aa"], [], None, ["ab", None], ["é", "abcd"]], pa.list_(pa.string())).slice(1)
    assert mean_item_entropy_udf.func(lists).to_pylist() == [0.5, 0.0, None, None, 1.0]
    assert mean_item_entropy_udf.func(lists.slice(0, 0)).to_pylist() == []
