from pyspark.sql import functions as F

from support import SF_SMALL
from tunnelscan.plans import fixtures, queries as Q, scoring
from tunnelscan.streaming import start_hourly_scoring


def test_hours_are_judged_whole_however_their_files_arrive(spark, tmp_path):
    # Few, large partitions: a month and the first digit of the hour.
    msgs = (fixtures.read_staged_dns_log(spark, SF_SMALL).withColumn("datestr", F.substring("datestr", 1, 6))
            .withColumn("hour", F.substring("hour", 1, 1)))
    root, out = str(tmp_path / "dns"), str(tmp_path / "out")
    # Several files in each hour folder.
    msgs.repartition(3).write.partitionBy("datestr", "hour").parquet(root)
    cfg = Q.FIXTURE_CONFIG.with_(min_group_count=3, min_unique_qname_share=0.05, min_tunnel_share=0.05)
    q = start_hourly_scoring(spark, root, out, Q._stand_in, cfg, max_files_per_trigger=4,
                             checkpoint=str(tmp_path / "ckpt"))
    q.awaitTermination(600)
    assert q.exception() is None
    back = spark.read.parquet(out)
    got = sorted((r["key"], str(r["datestr"]), str(r["hour"])) for r in back.collect())
    want = []
    for datestr, hour in msgs.select("datestr", "hour").distinct().collect():
        part = msgs.where((F.col("datestr") == datestr) & (F.col("hour") == hour))
        want += [(r["key"], datestr, hour) for r in scoring.score(part, Q._stand_in, cfg).output.collect()]
    assert len(want) > 0 and got == sorted(want)
