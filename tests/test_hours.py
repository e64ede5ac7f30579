"""Partitions read for flagged rows, counts without a pass, merged states, outputs
that are seen whole."""

import glob
import os

import pytest
from pyspark.sql import functions as F
from support import SF_SMALL, explain

from tunnelscan.operators.verdict import interval_stats
from tunnelscan.plans import fixtures, merging, queries as Q, scoring
from tunnelscan.schemas import KEYS
from tunnelscan.session import hidden_sibling, path_exists
from tunnelscan.sources.readers import read_dns_log
from tunnelscan.sources.sinks import write_alerts, write_messages, write_whole

CONFIG = Q.FIXTURE_CONFIG.with_(min_group_count=4)


@pytest.fixture(scope="module")
def hourly(spark, tmp_path_factory):
    """The messages in datestr=/hour= folders; only one month's second day-digit 0 alerts."""
    root = str(tmp_path_factory.mktemp("dns") / "log")
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL).withColumn("datestr", F.substring("datestr", 1, 6)).withColumn(
        "hour", F.substring("hour", 1, 1))
    # Destinations of their own for each hour, so that an hour's groups are its own.
    dest = F.concat(F.lit("192.0.2."), F.col("hour"))
    msgs = msgs.withColumn("payload", F.col("payload").withField("ip.destIP", dest))
    msgs.write.partitionBy("datestr", "hour").parquet(root)
    return root


def _labeler(hour):
    """Long names tunnel, in one hour's destination only."""
    return lambda df: df.withColumn("prediction", F.when(
        (F.length("QNAME") > 45) & (F.col("destIP") == f"192.0.2.{hour}"), 1.0).otherwise(0.0))


def _keys(df):
    return sorted((str(r["key"]), r["2ld"]) for r in df.select("key", "2ld").collect())


def test_hours_without_alerts_are_not_read(spark, hourly):
    cfg = CONFIG.with_(min_unique_qname_share=0.05, min_tunnel_share=0.05)
    result = scoring.score(read_dns_log(spark, hourly), _labeler("1"), cfg)
    whole = scoring.score(read_dns_log(spark, hourly), _labeler("1"), cfg, prune_hours=False)
    assert result.hours and {h for _, h in result.hours} == {"1"} and whole.hours is None
    want = _keys(whole.flagged)
    assert want and _keys(result.flagged) == want
    assert "__hours" not in result.stats.columns + result.alerts.columns + result.flagged.columns
    scan = [line for line in explain(result.flagged).splitlines() if "PartitionFilters" in line and "concat_ws" in line]
    assert scan and all("datestr" in line and "hour" in line for line in scan)
    # Files of the other hours may be broken by now.
    for name in glob.glob(f"{hourly}/datestr=*/hour=[02]/*.parquet"):
        with open(name, "wb") as f:
            f.write(b"no parquet")
        crc = os.path.join(os.path.dirname(name), f".{os.path.basename(name)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
    assert _keys(result.flagged) == want
    with pytest.raises(Exception):
        whole.flagged.count()


def test_partition_values_with_slashes_nulls_and_no_partitions(spark):
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL)
    want = sorted(r["key"] for r in scoring.score(msgs, Q._stand_in, CONFIG, prune_hours=False).output.collect())
    odd = msgs.withColumn("datestr", F.when(F.col("hour") < "12", F.lit("2024/01")).otherwise(F.lit(None).cast("string")))
    odd = odd.withColumn("hour", F.when(F.col("hour") > "20", F.lit(None).cast("string")).otherwise(F.concat(F.lit("0/"), "hour")))
    for given in (odd, msgs, msgs.drop("hour"), msgs.drop("datestr", "hour")):
        assert sorted(r["key"] for r in scoring.score(given, Q._stand_in, CONFIG).output.collect()) == want and want


def test_counts_come_from_the_gates_job(spark):
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL)
    result = scoring.score(msgs, Q._stand_in, CONFIG)
    domain = F.col("2ld")
    rows = result.prepared.agg(F.count(F.lit(1)).alias("question_rows"), F.count_if(domain.isNull()).alias("undomained_rows"),
                               F.count_if(~domain.endswith("in-addr.arpa")).alias("candidate_rows")).first().asDict()
    assert result.seen == rows and rows["undomained_rows"] > 0 and rows["candidate_rows"] < rows["question_rows"]
    plan = explain(result.counts())
    assert "ReadSchema" not in plan
    nothing = scoring.score(msgs.limit(0), Q._stand_in, CONFIG)
    assert {r["stage"]: r["rows"] for r in nothing.counts().collect()} == dict.fromkeys(
        ["question_rows", "undomained_rows", "candidate_rows", "scored_rows", "suspicious_groups", "alert_groups", "flagged_rows"], 0)


def _stats(df):
    return sorted(tuple(round(x, 9) if isinstance(x, float) else x for x in r) for r in df.select(
        *KEYS, "unique_QNAME_count", "2ld_count", "normal_count", "tunnel_count", "unique_QNAME_perc", "tunnel_perc",
        "max_interval_time", "average_interval_time").collect())


def test_merged_hours_equal_one_pass(spark, tmp_path):
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL).withColumn("datestr", F.substring("datestr", 1, 6))
    root = str(tmp_path / "states")
    early, late = msgs.where("hour < '12'"), msgs.where("hour >= '12'")
    # An hour written in part, then again with its late messages: replaced, not added.
    merging.write_states(early.where("payload.header.id % 2 = 0"), Q._stand_in, CONFIG, root)
    merging.write_states(late, Q._stand_in, CONFIG, root)
    merging.write_states(early, Q._stand_in, CONFIG, root)
    one = scoring.score(msgs, Q._stand_in, CONFIG, with_intervals=True)
    assert _stats(merging.merged_stats(spark, root, CONFIG)) == _stats(one.stats) != []
    assert _stats(merging.merged_verdict(spark, root, CONFIG)) == _stats(one.alerts)
    half = scoring.score(early, Q._stand_in, CONFIG, with_intervals=True)
    assert _stats(merging.merged_stats(spark, root, CONFIG, where=F.col("hour") < "12")) == _stats(half.stats)
    # Groups below the gate in every hour are busy in the sum.
    assert one.busy.count() > scoring.score(msgs.where("hour = '00'"), Q._stand_in, CONFIG).busy.count()
    # A group's gaps run across the hours.
    assert interval_stats(one.scored).count() >= len(_stats(one.stats))


def test_sketched_names_are_near(spark, tmp_path):
    msgs = fixtures.read_staged_dns_log(spark, SF_SMALL)
    root = str(tmp_path / "sketches")
    merging.write_states(msgs, Q._stand_in, CONFIG, root, periods=("hour",), sketch=True)
    exact = {tuple(r[k] for k in KEYS): r["unique_QNAME_count"] for r in scoring.score(msgs, Q._stand_in, CONFIG).stats.collect()}
    near = {tuple(r[k] for k in KEYS): r["unique_QNAME_count"] for r in merging.merged_stats(spark, root, CONFIG, sketch=True).collect()}
    assert set(near) == set(exact) and all(abs(near[k] - exact[k]) <= 0.1 * exact[k] + 1 for k in exact)


def _breaking(df):
    """The same rows, but the job dies on some of them after others were written."""
    return df.repartition(4).withColumn("id", F.when(F.col("id") == 90, F.raise_error(F.lit("killed in mid-write"))).otherwise(F.col("id")))


@pytest.mark.parametrize("mode", ["overwrite", "periods"])
def test_a_job_that_dies_leaves_the_old_output(spark, tmp_path, mode):
    parts = ["day"] if mode == "periods" else []
    path = str(tmp_path / "table" / "out")
    old = spark.range(20).withColumn("day", F.col("id") % 2)
    write_whole(old, path, "periods" if parts else "error", parts)
    new = spark.range(80, 100).withColumn("day", F.col("id") % 2)
    with pytest.raises(Exception, match="killed in mid-write"):
        write_whole(_breaking(new), path, mode, parts)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(20))
    # Readers of the folder above see no unfinished output either.
    assert sorted(r["id"] for r in spark.read.option("recursiveFileLookup", True).parquet(str(tmp_path / "table")).select("id").collect()) == list(range(20))
    write_whole(new, path, mode, parts)
    assert sorted(r["id"] for r in spark.read.parquet(path).collect()) == list(range(80, 100))
    assert not path_exists(spark, hidden_sibling(path, "old"))


def test_periods_replace_only_their_own(spark, tmp_path):
    path = str(tmp_path / "alerts")
    rows = spark.createDataFrame([("20240101", "00", 1), ("20240101", "01", 2), ("20240102", "00", 3)], "datestr string, hour string, n int")
    write_alerts(rows, path)
    write_alerts(rows.where("n = 2").withColumn("n", F.lit(20)), path, mode="periods")
    assert sorted(r["n"] for r in spark.read.parquet(path).collect()) == [1, 3, 20]
    with pytest.raises(ValueError):
        write_messages(rows, path, mode="periods")


def test_unfinished_outputs_lie_beside_their_place():
    assert hidden_sibling("out", "x") == ".out.x"
    assert hidden_sibling("/a/b/", "x") == "/a/.b.x"
    assert hidden_sibling("hdfs://h:1/t/datestr=1/hour=02", "x") == "hdfs://h:1/t/datestr=1/.hour=02.x"


def test_modes_and_an_interrupted_replacement(spark, tmp_path):
    path, df = str(tmp_path / "out"), spark.range(3)
    write_messages(df, path)
    with pytest.raises(FileExistsError):
        write_messages(df, path)
    write_messages(spark.range(9), path, mode="ignore")
    write_messages(df, path, mode="append")
    assert spark.read.parquet(path).count() == 6
    with pytest.raises(ValueError):
        write_messages(df, path, mode="replace")
    # A run that died between its two renames has set the old output aside.
    os.rename(path, hidden_sibling(path, "old"))
    with pytest.raises(FileExistsError):
        write_messages(df, path)
    assert spark.read.parquet(path).count() == 6
