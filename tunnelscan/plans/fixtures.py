"""DNS stand-in data derived by Spark from the driver's tables.

The driver's tables hold no DNS traffic.  ``dns_view`` turns ``events`` and
``pages`` into nested DNS messages (one per event); ``stage_dns_log`` writes
them once as an hourly-partitioned Parquet table (``datestr=yyyyMMdd/hour=HH``)
in the shared checkpoint folder, which is what the scoring job reads, like the
reference's hourly DNS table.  ``training_sample_rows`` derives the labelled
``QNAME~RDATA~DnsTunnel`` sample from the same messages and ``labels``.

Every definition here has a DuckDB twin in ``tunnelscan.plans.oracle``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunnelscan.operators.joins import DEFAULT_BROADCAST_ROWS
from tunnelscan.schemas import ANSWER
from tunnelscan.session import fingerprint, path_exists, publish, shared_path

VIEW_VERSION = "dnsview-v4"
STAGE_PARTITION_BY = "datestr"
RDATA_DELIMITER = "|"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# Names that exercise the domain rules, by event_id % 29 from 1.
ODD_HOSTS = (
    "relay.evil.io",            # unlisted suffix: the last label acts as one
    "shop.example.co.uk",       # two-label suffix
    "a.b.ck",                   # wildcard
    "www.ck",                   # exception to it
    "4.3.2.10.in-addr.arpa",    # reverse lookup
    "com",                      # a bare suffix has no domain
    "Mixed.Case.COM",
    "x.deep.co.jp",
)


def stand_in_label(qname: Column) -> Column:
    """Rule used in place of a model on the stand-in data: long names tunnel."""
    return F.when(F.length(qname) > 45, F.lit("tunnel")).otherwise(F.lit("normal"))


def stand_in_prediction(qname: Column) -> Column:
    return F.when(F.length(qname) > 45, F.lit(1.0)).otherwise(F.lit(0.0))


def noisy_label(qname: Column, event_id: Column) -> Column:
    """The stand-in label of the training sample: one row in 23 is mislabelled,
    so that no model can be right on all of them."""
    return F.when((F.length(qname) > 45) != (F.pmod(event_id, F.lit(23)) == 9), F.lit("tunnel")).otherwise(F.lit("normal"))


def first_question(payload: str = "payload") -> Column:
    return F.get(F.col(f"{payload}.questions"), F.lit(0))["name"]


def dns_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nested DNS messages (``key``, ``payload``, ``datestr``, ``hour``).

    The payload has two fields that ``schemas`` does not declare
    (``header.id``, ``authority``), as real logs do."""
    events = _table(spark, sf_dir, "events")
    pages = _table(spark, sf_dir, "pages").select(
        "page_id", F.regexp_extract("url", r"^https?://([^/?#]+)", 1).alias("page_host"))
    n_pages = pages.count()
    side = F.broadcast(pages) if n_pages <= DEFAULT_BROADCAST_ROWS else pages
    e = events.join(side, F.pmod(F.col("event_id"), F.lit(n_pages)) == F.col("page_id"), "inner")

    eid = F.col("event_id")

    def every(n: int, k: int) -> Column:
        return F.pmod(eid, F.lit(n)) == k

    host = F.col("page_host")
    for k, name in enumerate(ODD_HOSTS, 1):
        host = F.when(every(29, k), F.lit(name)).otherwise(host)
    e = e.withColumn("host", host)
    etype = F.col("event_type")
    # One name in 61 lacks the trailing dot.
    dot = F.when(every(61, 0), F.lit("")).otherwise(F.lit("."))
    e = e.withColumn("qname", F.when(
        etype == "purchase", F.concat(F.upper(F.md5(eid.cast("string"))), F.lit("."), F.col("host"), dot))
        .otherwise(F.concat(F.col("host"), dot)))
    qname = F.col("qname")
    ask = "array<struct<name:string>>"
    questions = (F.when(every(31, 0), F.array(F.struct(qname.alias("name")),
                                              F.struct(F.concat(F.lit("mail."), qname).alias("name"))))
                 .when(every(31, 1), F.array().cast(ask)).when(every(31, 2), F.lit(None).cast(ask))
                 .otherwise(F.array(F.struct(qname.alias("name")))))
    items = F.array(
        F.struct(F.md5(F.col("props")).alias("rdata"), F.lit("TXT").alias("type")),
        F.struct(F.when(every(41, 5), F.lit(None).cast("string"))
                 .when(etype == "click", F.concat(F.lit("v=spf1 "), F.col("props")))
                 .otherwise(F.concat(F.lit("V="), F.col("props"))).alias("rdata"), F.lit("TXT").alias("type")),
        F.struct(F.when(every(43, 6), F.lit("")).otherwise(etype).alias("rdata"),
                 F.when(etype == "view", F.lit("RRSIG")).otherwise(F.lit("CNAME")).alias("type")),
    )
    empty = F.array().cast(f"array<{ANSWER.simpleString()}>")
    answers = (F.when(every(37, 3), F.lit(None).cast(f"array<{ANSWER.simpleString()}>"))
               .when(every(7, 0), empty).otherwise(items))
    ipv6 = every(53, 7)
    user = F.pmod(F.col("user_id"), F.lit(16)).cast("string")
    src = (F.when(every(59, 8), F.lit(None).cast("string"))
           .when(ipv6, F.concat(F.lit("2001:db8::"), user)).otherwise(F.concat(F.lit("10.0.0."), user)))
    dest = (F.when(ipv6, F.lit("2001:db8::53")).when(every(11, 0), F.lit("198.51.100.7")).otherwise(F.lit("192.0.2.53")))
    payload = F.struct(
        F.struct((F.pmod(eid, F.lit(10)) != 9).alias("QR"),
                 F.when(etype == "error", F.lit("NXDOMAIN")).otherwise(F.lit("NOERROR")).alias("responseCode"),
                 eid.cast("long").alias("id")).alias("header"),
        questions.alias("questions"),
        answers.alias("answers"),
        F.struct(src.alias("srcIP"), dest.alias("destIP"),
                 (F.lit(1024) + F.pmod(eid, F.lit(60000))).cast("int").alias("srcPort"),
                 F.lit(53).cast("int").alias("destPort"),
                 ipv6.alias("isIPv6")).alias("ip"),
        # Ten-second steps: some seconds repeat within a group.
        F.struct((F.floor(F.unix_timestamp(F.col("ts")) / 10) * 10).cast("long").alias("ts_sec"),
                 (F.expr("date_part('SECOND', ts)") * 1_000_000 % 1_000_000).cast("long").alias("ts_usec"),
                 (F.lit(60) + F.length(qname)).cast("long").alias("wirelen")).alias("pcap"),
        F.concat(F.lit("ns."), F.col("host")).alias("authority"),
    )
    return e.select(eid.cast("string").alias("key"), payload.alias("payload"),
                    F.date_format("ts", "yyyyMMdd").alias("datestr"),
                    F.date_format("ts", "HH").alias("hour"))


def stage_dns_log(spark: SparkSession, sf_dir: str) -> str:
    """Write the DNS view once per input as an hourly-partitioned table."""
    fp = fingerprint(spark, f"{sf_dir}/events.parquet", f"{sf_dir}/pages.parquet", salt=VIEW_VERSION)
    final = shared_path(spark, "staged", f"dns_{fp}")
    if path_exists(spark, f"{final}/_SUCCESS"):
        return final
    tmp = f"{final}.{uuid.uuid4().hex}.tmp"
    # One directory per day; ``hour`` stays a data column (pushed down as a
    # Parquet filter).  read_dns_log accepts the two-level layout as well.
    # No repartition by day: a day would become one task.  Each input task
    # writes the (few, time-contiguous) days it holds.
    (dns_view(spark, sf_dir).sortWithinPartitions(STAGE_PARTITION_BY, "hour")
     .write.mode("error").partitionBy(STAGE_PARTITION_BY).parquet(tmp))
    publish(spark, tmp, final)
    return final


def read_staged_dns_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tunnelscan.sources.readers import read_dns_log
    return read_dns_log(spark, stage_dns_log(spark, sf_dir))


def training_sample_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled name/answer rows for the '~' sample (one per message).

    ``DnsTunnel`` is the stand-in label; ``labels`` adds the noise the cleaning
    must handle: ``toxic = 1`` appends stray commas (kept after cleaning),
    ``quality = 0`` capitalises the class (dropped, exact case).  Messages
    without a question get a NULL ``QNAME``, those without answers a NULL
    ``RDATA`` (dropped).  ``src`` is an extra column.
    """
    msgs = dns_view(spark, sf_dir)
    labels = _table(spark, sf_dir, "labels").select(F.col("doc_id").cast("string").alias("key"),
                                                   "quality", "toxic")
    qname = first_question()
    base = noisy_label(qname, F.col("payload.header.id"))
    noisy = (F.when(F.col("quality") == 0, F.initcap(base))
             .when(F.col("toxic") == 1, F.concat(base, F.lit(",,")))
             .otherwise(base))
    rdata = F.nullif(F.array_join(F.col("payload.answers.rdata"), RDATA_DELIMITER), F.lit(""))
    return (msgs.join(labels, "key", "left")
            .select(qname.alias("QNAME"), rdata.alias("RDATA"), noisy.alias("DnsTunnel"),
                    F.col("payload.ip.srcIP").alias("src")))


def stage_training_csv(spark: SparkSession, sf_dir: str) -> str:
    """Write the sample once as '~'-separated text with a header."""
    fp = fingerprint(spark, f"{sf_dir}/events.parquet", f"{sf_dir}/pages.parquet",
                     f"{sf_dir}/labels.parquet", salt=VIEW_VERSION + "-csv")
    final = shared_path(spark, "staged", f"train_csv_{fp}")
    if path_exists(spark, f"{final}/_SUCCESS"):
        return final
    tmp = f"{final}.{uuid.uuid4().hex}.tmp"
    training_sample_rows(spark, sf_dir).write.mode("error").csv(tmp, header=True, sep="~")
    publish(spark, tmp, final)
    return final


__all__ = ["dns_view", "stage_dns_log", "read_staged_dns_log", "training_sample_rows",
           "stage_training_csv", "stand_in_label", "stand_in_prediction", "noisy_label", "first_question", "RDATA_DELIMITER"]
