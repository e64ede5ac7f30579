import json

import pytest
from pyspark.sql import functions as F

from support import SF_SMALL
from tunnelscan.config import ScoringConfig
from tunnelscan.operators import alerts as A
from tunnelscan.plans import fixtures, queries as Q, scoring, training
from tunnelscan.sources import load_config
from tunnelscan.sources.sinks import write_alerts

# The config file with its defaults.
REFERENCE_CONFIG = {
    "EXCLUDED_RTYPE_LIST": ["RRSIG", "DNSKEY", "DS", "eNSEC", "NSEC3", "CDNSKEY", "CDS", "TSIG", "TKEY"],
    "EXCLUDED_RDATA_LIST": ["v=spf1", "docusign=", "verification="],
    "MIN_IP_IP_2LD_COUNT": 100,
    "MIN_IP_IP_2LD_UNIQUE_QNAME_PERC": 0.33,
    "MIN_IP_IP_2LD_TUNNEL_PERC": 0.33,
}


CONFIG = Q.FIXTURE_CONFIG.with_(min_group_count=4)


def test_config_json_round_trip(tmp_path):
    path = tmp_path / "cfg.json"
    path.write_text(json.dumps(REFERENCE_CONFIG))
    cfg = load_config(str(path))
    assert cfg == ScoringConfig()
    assert cfg.to_dict() == REFERENCE_CONFIG
    assert load_config(str(path), min_group_count=5).min_group_count == 5
    with pytest.raises(KeyError):
        ScoringConfig.from_dict({"MIN_IP_IP_2LD_COUNT": 1})


def test_alert_sink_partitioned(spark, tmp_path):
    res = scoring.score(fixtures.read_staged_dns_log(spark, SF_SMALL), Q._stand_in, CONFIG)
    table = A.alert_table(res.flagged)
    out = str(tmp_path / "alerts")
    write_alerts(table, out)
    back = spark.read.parquet(out)
    assert back.count() == table.count() > 0
    assert {"datestr", "hour"} <= set(back.columns)
    with pytest.raises(Exception):
        write_alerts(table, out)


def test_distinct_messages_option(spark):
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL)
    doubled = msgs.withColumn("payload", F.col("payload").withField(
        "questions", F.concat(F.col("payload.questions"), F.col("payload.questions"))))
    a = scoring.score(doubled, Q._stand_in, CONFIG).output
    b = scoring.score(doubled, Q._stand_in, CONFIG, distinct_messages=True).output
    assert a.count() >= 2 * b.count() > 0
    assert b.select("key").distinct().count() == b.count()


def test_distinct_messages_keeps_messages_without_or_with_equal_keys(spark):
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL)
    want = scoring.score(msgs, Q._stand_in, CONFIG, distinct_messages=True).output.count()
    for key in (F.lit(None).cast("string"), F.lit("same")):
        out = scoring.score(msgs.withColumn("key", key), Q._stand_in, CONFIG, distinct_messages=True).output
        assert out.count() == want > 1


def test_training_and_scoring_jobs(spark, tmp_path):
    csv = fixtures.stage_training_csv(spark, SF_SMALL)
    path, metrics = training.run_training_job(spark, csv, str(tmp_path / "model"), rdata_mode="array",
                                              delimiter=fixtures.RDATA_DELIMITER)
    assert path.endswith(".mml") and set(metrics) == {
        "areaUnderROC", "areaUnderPR", "accuracy", "weightedRecall", "weightedPrecision", "f1"}
    # One label in 23 is wrong: no score can be perfect.
    assert 0.8 < metrics["areaUnderROC"] < 1 and metrics["accuracy"] < 1
    cfg_path = tmp_path / "cfg.json"
    cfg_path.write_text(json.dumps({**REFERENCE_CONFIG, "MIN_IP_IP_2LD_COUNT": 4,
                                    "MIN_IP_IP_2LD_TUNNEL_PERC": 0.24}))
    log = fixtures.stage_dns_log(spark, SF_SMALL)
    with pytest.raises(ValueError):
        scoring.run_scoring_job(spark, log, path, str(cfg_path), kafka_topic="t")
    with pytest.raises(ValueError):
        scoring.run_scoring_job(spark, log, path, str(cfg_path))
    out = str(tmp_path / "flagged")
    res = scoring.run_scoring_job(spark, log, path, str(cfg_path), output_path=out)
    assert spark.read.parquet(out).columns == ["key", "payload"]
    assert spark.read.parquet(out).count() == res.output.count()
    assert res.unlabelled().count() == 0
    info = spark.createDataFrame([(f"10.0.0.{k % 16}", f"host {k % 16}", False) for k in range(32)],
                                 "ip string, enrich string, is_malicious boolean")
    alerts = str(tmp_path / "alerts")
    scoring.run_scoring_job(spark, log, path, str(cfg_path), output_path=alerts, alert_format=True, ip_info=info,
                            alert_timestamp_sec=86400, engine_name="engine of the test")
    back = spark.read.parquet(alerts)
    assert back.count() == res.flagged.count()
    assert {(r["engine_name"], r["alert_timestamp_sec"], str(r["datestr"])) for r in back.collect()} == {
        ("engine of the test", 86400, "19700102")}
    assert back.where("src_ip_enrich like 'host %'").count() == back.where("src_ip like '10.%'").count() > 0


def test_intervals_in_group_table(spark):
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL)
    res = scoring.score(msgs, Q._stand_in, CONFIG, with_intervals=True)
    from tunnelscan.operators.verdict import interval_stats
    want = {tuple(r[:3]): (r[3], r[4]) for r in interval_stats(res.scored).collect()}
    got = res.stats.collect()
    assert got and all((r["max_interval_time"], r["average_interval_time"]) == want[tuple(r[:3])] for r in got)


def test_counts_report_empty_stages(spark):
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL)
    strict = CONFIG.with_(min_unique_qname_share=1.01)
    counts = {r["stage"]: r["rows"] for r in scoring.score(msgs, Q._stand_in, strict).counts().collect()}
    assert counts["alert_groups"] == 0 and counts["flagged_rows"] == 0 and counts["question_rows"] > 0
    assert len(counts) == 7 and counts["undomained_rows"] > 0
