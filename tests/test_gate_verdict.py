import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tunnelscan.config import ScoringConfig
from tunnelscan.operators.gate import volume_gate
from tunnelscan.operators.joins import materialise
from tunnelscan.operators.verdict import (
    alerting_groups,
    group_stats,
    interval_stats,
    suspicious_keys,
    suspicious_rows,
    with_alert_id,
    with_indicators,
    with_label_str,
)

COLS = "srcIP string, destIP string, `2ld` string, QNAME string, ts_sec long, prediction double"


def rows_fixture(spark):
    rng = random.Random(3)
    rows = []
    # group g5 has exactly 5 rows, g4 has 4; a NULL-key group of 6.
    for i in range(5):
        rows.append(("s1", "d", "g5.com", f"q{i}.g5.com.", 10 * i, 1.0 if i == 0 else 0.0))
    for i in range(4):
        rows.append(("s1", "d", "g4.com", f"q{i}.g4.com.", 5 * i, 1.0))
    for i in range(6):
        rows.append((None, "d", "gn.com", "q.gn.com.", i, 1.0))
    for i in range(300):
        rows.append((f"s{rng.randint(1, 3)}", "d", f"h{rng.randint(1, 4)}.com", f"n{rng.randint(1, 60)}.x.",
                     rng.randint(0, 500), float(rng.choice([0, 0, 0, 1, 2]))))
    return spark.createDataFrame(rows, COLS)


def _sorted(df):
    return sorted(tuple(r) for r in df.collect())


def test_gate_inclusive_and_null_keys(spark):
    df = rows_fixture(spark)
    got = volume_gate(df, 5)
    groups = {(r["srcIP"], r["2ld"]) for r in got.collect()}
    assert ("s1", "g5.com") in groups and ("s1", "g4.com") not in groups
    assert all(s is not None for s, _ in groups)


def test_gate_equals_a_count_over_each_group(spark):
    df = rows_fixture(spark)
    keys = ["srcIP", "destIP", "2ld"]
    counted = df.withColumn("count", F.count(F.lit(1)).over(Window.partitionBy(*keys)))
    want = counted.where("count >= 20 and srcIP is not null")
    for bound in (500_000, 0):   # broadcast and shuffle join
        got = volume_gate(df, 20, max_broadcast_rows=bound)
        assert got.count() > 0 and _sorted(got) == _sorted(want.select(*got.columns))


def test_bytes_bound_the_broadcast_too(spark):
    few = materialise(spark.createDataFrame([("x" * 1000, 1)] * 3, "a string, b long"))
    assert (few.rows, few.size) == (3, 3 * 1008)
    assert few.small() and not few.small(max_bytes=1000) and not few.small(max_rows=2)


def test_semi_join_equals_inner_distinct(spark):
    pred = with_label_str(rows_fixture(spark)).where(F.col("srcIP").isNotNull())
    keys = ["srcIP", "destIP", "2ld"]
    semi = suspicious_rows(pred)
    inner = pred.join(suspicious_keys(pred), keys, "inner").select(*semi.columns)
    assert _sorted(semi) == _sorted(inner)


def test_label_map_and_indicators(spark):
    df = spark.createDataFrame([(0.0,), (1.0,), (2.0,), (3.0,)], "prediction double")
    out = with_indicators(with_label_str(df)).collect()
    assert [(r["label_str"], r["normal"], r["tunnel"]) for r in out] == [
        ("normal", 1, 0), ("tunnel", 0, 1), ("tunnel_keepalive", 0, 1), (None, 0, 0)]


def test_verdict_thresholds_inclusive(spark):
    df = with_indicators(with_label_str(rows_fixture(spark).where("srcIP = 's1' and `2ld` = 'g5.com'")))
    stats = group_stats(df).first()
    assert (stats["unique_QNAME_count"], stats["2ld_count"], stats["normal_count"], stats["tunnel_count"]) == (5, 5, 4, 1)
    assert stats["tunnel_perc"] == 0.2
    cfg = ScoringConfig(min_unique_qname_share=1.0, min_tunnel_share=0.2)
    assert alerting_groups(group_stats(df), cfg).count() == 1
    assert alerting_groups(group_stats(df), cfg.with_(min_tunnel_share=0.21)).count() == 0


def test_approx_distinct_option(spark):
    df = with_indicators(with_label_str(rows_fixture(spark)))
    exact = {tuple(r[:3]): r["unique_QNAME_count"] for r in group_stats(df).collect()}
    approx = {tuple(r[:3]): r["unique_QNAME_count"] for r in group_stats(df, approx_distinct=True).collect()}
    assert exact.keys() == approx.keys()
    assert all(abs(exact[k] - approx[k]) <= max(1, 0.05 * exact[k]) for k in exact)


def test_alert_ids(spark):
    df = spark.createDataFrame([("a", "b", "c")], "srcIP string, destIP string, `2ld` string")
    assert with_alert_id(df).first()["alert_id"] == -1
    h1 = with_alert_id(df, "hash").first()["alert_id"]
    assert h1 == with_alert_id(df, "hash").first()["alert_id"] and h1 != -1
    assert h1 == int(__import__("hashlib").md5(b"a|b|c").hexdigest()[:15], 16)
    assert with_alert_id(df, "xxhash").first()["alert_id"] != h1


import pytest


@pytest.mark.parametrize("bucket", [86400, 7, 1])
def test_interval_stats_against_brute_force(spark, bucket):
    df = rows_fixture(spark)
    got = {tuple(r[:3]): (r["max_interval_time"], r["average_interval_time"])
           for r in interval_stats(df, bucket_seconds=bucket).collect()}
    groups = {}
    for r in df.collect():
        groups.setdefault((r["srcIP"], r["destIP"], r["2ld"]), []).append(r["ts_sec"])
    for k, ts in groups.items():
        ts = sorted(ts)
        gaps = [b - a for a, b in zip(ts, ts[1:])]
        want = (max(gaps), sum(gaps) / len(gaps)) if gaps else (None, None)
        have = got[k]
        assert have[0] == want[0] and (want[1] is None or abs(have[1] - want[1]) < 1e-9), (k, have, want)
