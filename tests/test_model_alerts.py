import bisect
import datetime
import hashlib
import json
import random

import pytest

from pyspark.sql import functions as F

from tunnelscan.operators import alerts as A
from tunnelscan.operators import model as M
from tunnelscan.schemas import DNS_MESSAGE_SCHEMA, FEATURE_COLUMNS
from tunnelscan.sources.sinks import kafka_records


def separable(spark, n=400):
    rows = []
    for i in range(n):
        label = i % 2
        base = [float((i * 7) % 13)] * len(FEATURE_COLUMNS)
        base[0] = 30.0 + (i % 5) if label else 5.0 + (i % 5)
        rows.append((f"q{i}", f"r{i}", label, *base))
    cols = "QNAME string, RDATA string, label int, " + ", ".join(f"{c} double" for c in FEATURE_COLUMNS)
    return spark.createDataFrame(rows, cols).repartition(2)


def test_forest_fit_save_load_metrics(spark, tmp_path):
    df = separable(spark)
    train, test = M.split_train_test(df)
    assert train.count() + test.count() == df.count()
    model = M.fit_pipeline(train, M.random_forest(num_trees=10, max_depth=4))
    pred = model.transform(test)
    assert M.binary_metrics(pred)["areaUnderROC"] > 0.95
    ours = M.multiclass_metrics(pred).first().asDict()
    theirs = M.evaluator_metrics(pred)
    for k in theirs:
        assert abs(ours[k] - theirs[k]) < 1e-9, (k, ours[k], theirs[k])
    path = M.save_model(model, str(tmp_path / "m"), when=datetime.datetime(2020, 3, 12, 9, 55, 36))
    assert path.endswith("m_RandomForestClassifier_v1.0_20200312-095536.mml")
    again = M.load_model(path).transform(test)
    a = sorted((r["QNAME"], r["prediction"]) for r in pred.collect())
    b = sorted((r["QNAME"], r["prediction"]) for r in again.collect())
    assert a == b
    imp = M.feature_importances(spark, model).collect()
    assert [r["feature"] for r in imp] == list(FEATURE_COLUMNS)
    assert abs(sum(r["importance"] for r in imp) - 1.0) < 1e-6


def test_forest_is_deterministic_for_fixed_partitioning(spark):
    df = separable(spark).repartition(3).checkpoint(eager=True)
    a = M.fit_pipeline(df, M.random_forest(num_trees=5, max_depth=4)).transform(df)
    b = M.fit_pipeline(df, M.random_forest(num_trees=5, max_depth=4)).transform(df)
    pa = sorted((r["QNAME"], tuple(r["probability"])) for r in a.collect())
    pb = sorted((r["QNAME"], tuple(r["probability"])) for r in b.collect())
    assert pa == pb


def test_weighted_metrics_with_unpredicted_class(spark):
    df = spark.createDataFrame([(0.0, 0.0), (0.0, 0.0), (1.0, 0.0), (2.0, 2.0)], "label double, prediction double")
    ours = M.multiclass_metrics(df).first().asDict()
    theirs = M.evaluator_metrics(df)
    for k in theirs:
        assert abs(ours[k] - theirs[k]) < 1e-9, (k, ours[k], theirs[k])


def test_hash_split_is_partitioning_independent(spark):
    df = separable(spark)
    a = sorted(r["QNAME"] for r in M.split_train_test(df.repartition(1))[1].collect())
    b = sorted(r["QNAME"] for r in M.split_train_test(df.repartition(7))[1].collect())
    assert a == b and 0.1 < len(a) / 400 < 0.3


def test_alternative_classifiers(spark):
    train, test = M.split_train_test(separable(spark))
    for clf in (M.logistic_regression(), M.decision_tree()):
        pred = M.fit_pipeline(train, clf).transform(test)
        assert M.multiclass_metrics(pred).first()["accuracy"] > 0.9


def flagged(spark):
    payload = {"header": {"QR": True, "responseCode": "NOERROR"}, "questions": [{"name": "a.ex.com."}],
               "answers": [{"rdata": "1.2.3.4", "type": "A"}],
               "ip": {"srcIP": "10.0.0.1", "destIP": "8.8.8.8", "srcPort": 5000, "destPort": 53, "isIPv6": False},
               "pcap": {"ts_sec": 1704067200 + 3600 * 18 + 5, "ts_usec": 2999, "wirelen": 80}}
    df = spark.createDataFrame([("k1", payload)], DNS_MESSAGE_SCHEMA)
    return df.select("*", F.lit("ex.com").alias("2ld"), F.lit(0.4567).alias("tunnel_perc"), F.lit(-1).alias("alert_id"))


def test_alert_table_fields(spark):
    spark.conf.set("spark.sql.session.timeZone", "Asia/Singapore")
    try:
        t = A.alert_table(flagged(spark))
        row = t.first()
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
    assert tuple(t.columns) == A.ALERT_COLUMNS
    assert row["record_first_seen_timestamp_ms"] == (1704067200 + 3600 * 18 + 5) * 1000 + 2
    assert (row["datestr"], row["hour"]) == ("20240101", "18")
    assert row["confidence"] == 45 and row["severity"] == -1 and row["flow_count"] == 1
    assert json.loads(row["details"]) == {"2ld": "ex.com"}
    tele = json.loads(row["telemetry_details"])
    assert tele["ip"]["srcIP"] == "10.0.0.1" and tele["questions"][0]["name"] == "a.ex.com."
    assert str(row["sent_bytes"]) == "80" and row["recv_bytes"] is None
    assert row["src_ip_type"] == "IPv4" and row["org_ip"] == "10.0.0.1" and row["org_is_malicious"] is False
    dtypes = dict(t.dtypes)
    assert dtypes["sent_packets"] == "decimal(38,0)" and dtypes["alert_id"] == "int"


def test_enrichment_and_kafka_projection(spark):
    info = spark.createDataFrame([("10.0.0.1", "laptop-7", True), ("8.8.8.8", "resolver", False)],
                                 "ip string, enrich string, is_malicious boolean")
    row = A.alert_table(flagged(spark), ip_info=info).first()
    assert (row["org_ip_enrich"], row["org_is_malicious"], row["src_ip_enrich"], row["dest_ip_enrich"]) == \
        ("laptop-7", True, "laptop-7", "resolver")
    table = A.alert_table(flagged(spark), engine_name="some engine")
    rec = kafka_records(table).first()
    assert rec["key"] == hashlib.md5(b"10.0.0.1|8.8.8.8|ex.com").hexdigest()
    assert json.loads(rec["value"])["engine_name"] == "some engine"
    assert kafka_records(table, "alert_id").first()["key"] == "-1"
    assert kafka_records(table, None).first()["key"] is None


@pytest.mark.parametrize("bound", [500_000, 1])
def test_duplicated_addresses_do_not_multiply_rows(spark, bound):
    info = spark.createDataFrame([("10.0.0.1", "b", False), ("10.0.0.1", "a", True), ("10.0.0.1", None, None),
                                  ("8.8.8.8", "r", False), (None, "x", True), ("9.9.9.9", "unused", False)],
                                 "ip string, enrich string, is_malicious boolean")
    rows = A.enrich(A.alert_fields(flagged(spark)), info, bound).collect()
    assert [(r["src_ip_enrich"], r["org_is_malicious"], r["dest_ip_enrich"]) for r in rows] == [("a", True, "r")]


def test_exact_area_under_curves(spark):
    rng = random.Random(4)
    rows = [(float(rng.random() < s), s) for s in (rng.random() for _ in range(3000))]
    df = spark.createDataFrame(rows, "label double, rawPrediction double")
    got = M.binary_metrics(df)["areaUnderROC"]
    pos, neg = [s for y, s in rows if y], sorted(s for y, s in rows if not y)
    want = sum(bisect.bisect_left(neg, s) for s in pos) / (len(pos) * len(neg))
    assert abs(got - want) < 1e-9
    assert abs(M.binary_metrics(df, num_bins=10)["areaUnderROC"] - want) > 1e-9
