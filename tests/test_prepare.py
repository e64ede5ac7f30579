from support import explain
from pyspark.sql import Row
from pyspark.sql import functions as F

from tunnelscan.config import ScoringConfig
from tunnelscan.operators.prepare import (
    clean_training_sample,
    exclude_answers,
    explode_questions,
    fill_numeric_nulls,
    flatten_message,
    successful_responses,
)
from tunnelscan.schemas import DNS_MESSAGE_SCHEMA
from tunnelscan.sources.readers import read_dns_log, read_training_sample


def _msg(key, qr=True, rc="NOERROR", names=("a.example.com.",), answers=(("1.2.3.4", "A"),),
         src="10.0.0.1", dst="192.0.2.53", ts=100):
    questions = None if names is None else [None if n is None else {"name": n} for n in names]
    ans = None if answers is None else [None if a is None else {"rdata": a[0], "type": a[1]} for a in answers]
    ip = None if src is None else {"srcIP": src, "destIP": dst, "srcPort": 5000, "destPort": 53, "isIPv6": False}
    return (key, {"header": {"QR": qr, "responseCode": rc}, "questions": questions, "answers": ans,
                  "ip": ip, "pcap": {"ts_sec": ts, "ts_usec": 1500, "wirelen": 80}})


def messages(spark):
    rows = [
        _msg("resp"),
        _msg("query", qr=False),
        _msg("nx", rc="NXDOMAIN"),
        _msg("two", names=("a.example.com.", "b.example.com.")),
        _msg("noq", names=()),
        _msg("nullq", names=None),
        _msg("nullans", answers=None),
        _msg("emptyitem", answers=(("", "TXT"), None)),
        _msg("nullip", src=None),
    ]
    return spark.createDataFrame(rows, DNS_MESSAGE_SCHEMA)


def test_responses_explode_flatten(spark):
    out = flatten_message(explode_questions(successful_responses(messages(spark))))
    keys = sorted(r["key"] for r in out.collect())
    assert keys == sorted(["resp", "two", "two", "nullans", "emptyitem", "nullip"])
    row = out.where("key = 'resp'").first()
    assert (row["QNAME"], row["ts_sec"], row["srcIP"], row["destIP"]) == ("a.example.com.", 100, "10.0.0.1", "192.0.2.53")
    assert out.where("key = 'nullip'").first()["srcIP"] is None


def test_response_filter_pushed_to_parquet(spark, tmp_path):
    path = str(tmp_path / "log")
    messages(spark).withColumn("datestr", F.lit("20240101")).withColumn("hour", F.lit("00")) \
        .write.partitionBy("datestr", "hour").parquet(path)
    df = read_dns_log(spark, path, datestr="20240101", hour="00")
    assert dict(df.dtypes)["hour"] == "string"
    plan = explain(successful_responses(df))
    assert "EqualTo(payload.header.QR,true)" in plan and "PartitionFilters" in plan
    assert successful_responses(df).count() == 7
    assert read_dns_log(spark, path, datestr="20240102").count() == 0
    globbed = read_dns_log(spark, f"{path}/datestr=20240101/hour=00/part-*", base_path=path)
    assert globbed.count() == 9 and {r["hour"] for r in globbed.select("hour").collect()} == {"00"}


def test_answer_exclusion(spark):
    df = spark.createDataFrame([
        _msg("k", answers=(("v=spf1 -all", "TXT"), ("1.2.3.4", "A"), ("sig", "RRSIG"), ("x", None), None)),
        _msg("n", answers=None),
    ], DNS_MESSAGE_SCHEMA)
    cfg = ScoringConfig()
    out = {r["key"]: r["RDATA"] for r in exclude_answers(df, cfg.excluded_rtypes, cfg.excluded_rdata).collect()}
    assert out["k"] == ["1.2.3.4", "x", None] and out["n"] is None
    joined = exclude_answers(df, cfg.excluded_rtypes, cfg.excluded_rdata, joined_delimiter=" ")
    assert joined.where("key = 'k'").first()["RDATA"] == "1.2.3.4 x"


def test_training_sample_cleaning(spark, tmp_path):
    path = tmp_path / "train.csv"
    path.write_text("QNAME~RDATA~DnsTunnel~extra\n"
                    "a.example.com.~1.2.3.4~normal,,~e1\n"
                    "b.example.com.~x~Tunnel~e2\n"
                    "c.example.com.~~tunnel~e3\n"
                    "d.example.com.~y~tunnel~e4\n"
                    "e.example.com.~z~other~e5\n")
    df = read_training_sample(spark, str(path))
    out = sorted(tuple(r) for r in clean_training_sample(df).select("QNAME", "DnsTunnel", "extra", "label").collect())
    assert out == [("a.example.com.", "normal", "e1", 0), ("d.example.com.", "tunnel", "e4", 1)]


def test_fillna_numeric_only(spark):
    df = spark.createDataFrame([Row(a=None, b=None, s=None)], "a double, b int, s string")
    r = fill_numeric_nulls(df).first()
    assert (r["a"], r["b"], r["s"]) == (0.0, 0, None)


def test_pipeline_drops_reverse_lookups_no_domain_and_null_ips(spark):
    from tunnelscan.operators.domains import drop_reverse_lookups
    from tunnelscan.operators.gate import volume_gate
    from tunnelscan.plans.scoring import prepare
    df = spark.createDataFrame([
        _msg("ok1", names=("a.example.com.",)),
        _msg("ok2", names=("b.example.com.",)),
        _msg("rev", names=("4.3.2.1.in-addr.arpa.",)),
        _msg("nodomain", names=("localhost.",)),
        _msg("nullip", src=None),
        _msg("nullname", names=(None,)),
    ], DNS_MESSAGE_SCHEMA)
    prepared = prepare(df)
    domains = {r["key"]: r["2ld"] for r in prepared.collect()}
    assert domains["rev"] == "1.in-addr.arpa" and domains["nodomain"] is None and domains["nullname"] is None
    gated = volume_gate(drop_reverse_lookups(prepared), 1)
    assert sorted(r["key"] for r in gated.collect()) == ["ok1", "ok2"]
    assert {r["count"] for r in gated.collect()} == {2}
