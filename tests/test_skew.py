"""One (source, destination, domain) group holds more than a third of all rows."""

import random


from support import explain
from tunnelscan.operators.gate import busy_groups, volume_gate
from tunnelscan.operators.verdict import group_stats, interval_stats, with_indicators, with_label_str

COLS = "srcIP string, destIP string, `2ld` string, QNAME string, ts_sec long, prediction double"


def skewed(spark, n=6000):
    rng = random.Random(11)
    rows = []
    for i in range(n):
        if i % 5 < 2:   # 40% of all rows: one resolver, one domain, many names, repeated names
            rows.append(("10.9.9.9", "192.0.2.53", "hot.com", f"n{rng.randint(0, 300)}.hot.com.",
                         rng.randint(0, 3000), float(rng.random() < 0.4)))
        else:
            rows.append((f"10.0.0.{rng.randint(0, 40)}", "192.0.2.53", f"d{rng.randint(0, 30)}.com",
                         f"q{rng.randint(0, 50)}.x.", rng.randint(0, 3000), float(rng.random() < 0.1)))
    return spark.createDataFrame(rows, COLS).repartition(8)


def test_hot_group_aggregates_match_brute_force(spark):
    df = with_indicators(with_label_str(skewed(spark)))
    got = {tuple(r[:3]): r for r in group_stats(df).collect()}
    rows = df.collect()
    hot = [r for r in rows if r["srcIP"] == "10.9.9.9"]
    h = got[("10.9.9.9", "192.0.2.53", "hot.com")]
    assert h["2ld_count"] == len(hot) > len(rows) / 3
    assert h["unique_QNAME_count"] == len({r["QNAME"] for r in hot})
    assert h["tunnel_count"] == sum(r["tunnel"] for r in hot)
    ts = sorted(r["ts_sec"] for r in hot)
    gaps = [b - a for a, b in zip(ts, ts[1:])]
    iv = {tuple(r[:3]): r for r in interval_stats(df).collect()}[("10.9.9.9", "192.0.2.53", "hot.com")]
    assert iv["max_interval_time"] == max(gaps)
    assert abs(iv["average_interval_time"] - sum(gaps) / len(gaps)) < 1e-9


def test_hot_group_is_pre_aggregated_before_every_shuffle(spark):
    df = with_indicators(with_label_str(skewed(spark)))
    for plan in (explain(busy_groups(df, 10), "simple"), explain(group_stats(df), "simple"),
                 explain(interval_stats(df), "simple")):
        # Every hash exchange is fed by a partial (map-side) aggregate.
        parts = plan.split("Exchange hashpartitioning")
        assert len(parts) > 1
        for below in parts[1:]:
            assert "HashAggregate" in below.split("\n", 2)[1] or "HashAggregate" in below.split("\n", 3)[2]


def test_hot_group_gate_join_is_broadcast(spark):
    df = skewed(spark)
    plan = explain(volume_gate(df, 10), "simple")
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
