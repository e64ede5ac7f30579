import json

import pytest
from pyspark.sql import functions as F

from support import explain
from tunnelscan.config import ScoringConfig
from tunnelscan.operators.alerts import alert_table
from tunnelscan.operators.domains import read_suffix_rules, registrable_domain
from tunnelscan.operators.features import generate_features
from tunnelscan.plans.scoring import score
from tunnelscan.session import fingerprint, is_local, path_exists, publish
from tunnelscan.sources.readers import read_dns_log
from tunnelscan.sources.sinks import write_to_kafka


def test_public_suffix_list_file(spark, tmp_path):
    path = tmp_path / "public_suffix_list.dat"
    path.write_text("// ===BEGIN ICANN DOMAINS===\n\ncom\nuk\nco.uk\n\n// jp\njp\n*.kobe.jp\n!city.kobe.jp\n")
    rules = read_suffix_rules(spark, str(path))
    assert rules.count() == 6
    df = spark.createDataFrame([("a.b.example.co.uk.",), ("x.y.kobe.jp",), ("x.city.kobe.jp",)], "QNAME string")
    got = [r["2ld"] for r in registrable_domain(df, "QNAME", rules).collect()]
    assert got == ["example.co.uk", "x.y.kobe.jp", "city.kobe.jp"]


def test_suffix_rules_need_their_columns(spark):
    bad = spark.createDataFrame([("com",)], "rule string")
    df = spark.createDataFrame([("a.com",)], "QNAME string")
    with pytest.raises(ValueError):
        registrable_domain(df, "QNAME", bad)


def test_kafka_sink_needs_the_connector(spark):
    df = spark.createDataFrame([(-1, "x")], "alert_id int, v string")
    with pytest.raises(Exception) as err:
        write_to_kafka(df, "alerts", "localhost:9", "alert_id")
    assert "kafka" in str(err.value).lower()


def test_undeclared_payload_fields_are_kept(spark, tmp_path):
    path = str(tmp_path / "log")
    rows = spark.range(3).select(
        F.col("id").cast("string").alias("key"),
        F.struct(
            F.struct(F.lit(True).alias("QR"), F.lit("NOERROR").alias("responseCode"), F.col("id")).alias("header"),
            F.array(F.struct(F.lit("a.example.com.").alias("name"), F.lit(1).alias("qtype"))).alias("questions"),
            F.struct(F.lit("10.0.0.1").alias("srcIP"), F.lit("8.8.8.8").alias("destIP")).alias("ip"),
            F.struct(F.lit(5).cast("long").alias("ts_sec")).alias("pcap"),
            F.array(F.lit("ns1")).alias("authority")).alias("payload"),
        F.lit("20240101").alias("datestr"), F.lit("07").alias("hour"))
    rows.write.partitionBy("datestr", "hour").parquet(path)
    df = read_dns_log(spark, path, hour="07")
    got = df.select("key", "payload.header.id", "payload.authority", "payload.answers", "payload.pcap.wirelen",
                    "payload.questions.qtype", "payload.ip.isIPv6", "datestr", "hour").orderBy("key").collect()
    assert [tuple(r) for r in got] == [(str(k), k, ["ns1"], None, None, [1], None, "20240101", "07") for k in range(3)]
    # A plan still reads only what it uses.
    assert "authority" not in explain(df.select("payload.header.QR")).split("ReadSchema")[1]
    res = score(df, lambda d: d.withColumn("prediction", F.lit(1.0)),
                ScoringConfig(min_group_count=2, min_unique_qname_share=0.0, min_tunnel_share=0.0))
    assert sorted(r["payload"]["header"]["id"] for r in res.output.collect()) == [0, 1, 2]
    tele = [json.loads(r["telemetry_details"]) for r in alert_table(res.flagged).collect()]
    assert sorted(t["header"]["id"] for t in tele) == [0, 1, 2] and all(t["authority"] == ["ns1"] for t in tele)


def test_wrong_field_types_are_an_error(spark, tmp_path):
    path = str(tmp_path / "bad")
    spark.range(1).select(F.lit("k").alias("key"), F.struct(
        F.struct(F.lit("yes").alias("QR")).alias("header")).alias("payload")).write.parquet(path)
    with pytest.raises(ValueError, match="QR"):
        read_dns_log(spark, path, partitioned=False)


@pytest.mark.parametrize("impl", ["arrow", "native"])
def test_invalid_utf8_in_names_and_answers(spark, impl):
    df = spark.sql("""SELECT cast(X'FF412E62612E636F6D2E' as string) AS QNAME, 'ba.com' AS lld,
                             array(cast(X'FF4180' as string), 'ok', '', null) AS RDATA
                      UNION ALL SELECT 'x.ba.com.', 'ba.com', array(cast(X'FF4180' as string))""")
    rows = generate_features(df, entropy_impl=impl).orderBy("subdomain_length").collect()
    assert [r["subdomain_length"] for r in rows] == [2, 3]
    assert rows[0]["average_answer_entropy"] == pytest.approx(0.9182958)
    assert rows[1]["subdomain_entropy"] == pytest.approx(1.5849625) and rows[1]["average_answer_entropy"] is None


def test_publish_and_fingerprint_through_the_file_system(spark, tmp_path):
    first, second, final = (str(tmp_path / x) for x in ("one", "two", "final"))
    for k, p in enumerate((first, second)):
        spark.range(k, k + 1).write.parquet(p)
    assert publish(spark, first, final) and not publish(spark, second, final)
    assert [r[0] for r in spark.read.parquet(final).collect()] == [0]
    assert not path_exists(spark, final + "/two")
    before = fingerprint(spark, final, "file:" + final)
    assert before == fingerprint(spark, final, "file:" + final) != fingerprint(spark, second)
    spark.range(9).write.mode("append").parquet(final)
    assert fingerprint(spark, final, "file:" + final) != before


def test_a_cluster_must_name_its_checkpoint_folder():
    assert is_local("local") and is_local("local[*]")
    assert not is_local("local-cluster[2,1,512]") and not is_local("yarn") and not is_local("spark://h:7077")
