"""Alert records for flagged traffic (O-54..O-59, dormant in the reference)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunnelscan.operators.joins import DEFAULT_BROADCAST_ROWS, materialise
from tunnelscan.operators.networks import in_networks, longest_match, parse_networks

# Name of the detecting engine in the alerts, where the caller gives none.
ENGINE_NAME = "TUNNELSCAN"

# Alert field constants of the reference.
L7_APPLICATION_NAME = "DNS"
ENGINE_TYPE = "ML"
ALERT_TYPE = "TUNNELLING"
ALERT_NAME = "TUNNELLING"
THREAT_NAME = "-"
TELEMETRY_SOURCE = "DNS"

# Order of the alert table's columns.
ALERT_COLUMNS = (
    "alert_id", "alert_timestamp_sec", "record_first_seen_timestamp_ms", "l7_application_name",
    "org_ip_enrich", "org_ip", "org_is_malicious", "src_ip_enrich", "src_ip", "src_ip_type",
    "src_port", "src_is_malicious", "dest_ip_enrich", "dest_ip", "dest_ip_type", "dest_port",
    "dest_is_malicious", "engine_type", "engine_name", "alert_type", "alert_name", "threat_name",
    "threat_hostname", "confidence", "severity", "details", "ioc", "flow_count", "sent_packets",
    "recv_packets", "sent_bytes", "recv_bytes", "telemetry_source", "telemetry_details",
    "datestr", "hour",
)
ENRICH_COLUMNS = ("org_ip_enrich", "org_ip", "org_is_malicious", "src_ip_enrich", "dest_ip_enrich")


def _utc_date_parts(epoch_sec: Column) -> tuple[Column, Column]:
    """``yyyyMMdd`` and ``HH`` of epoch seconds in UTC, independent of the
    session time zone (the reference relied on a UTC session)."""
    days = F.floor(epoch_sec / 86400).cast("int")
    datestr = F.date_format(F.date_from_unix_date(days), "yyyyMMdd")
    hour = F.lpad(F.floor(F.pmod(epoch_sec, F.lit(86400)) / 3600).cast("string"), 2, "0")
    return datestr, hour


def alert_fields(flagged: DataFrame, alert_timestamp_sec: int | None = None,
                 engine_name: str = ENGINE_NAME) -> DataFrame:
    """O-54, O-55, O-57: per-row alert fields of flagged traffic.

    ``flagged`` holds ``payload``, ``2ld``, ``tunnel_perc`` and ``alert_id``.
    ``alert_timestamp_sec`` defaults to the message's own ``ts_sec``.
    """
    ip, pcap = F.col("payload.ip"), F.col("payload.pcap")
    ts_sec = pcap["ts_sec"].cast("long")
    alert_ts = F.lit(alert_timestamp_sec).cast("long") if alert_timestamp_sec is not None else ts_sec
    ip_type = F.when(ip["isIPv6"] == F.lit(True), F.lit("IPv6")).otherwise(F.lit("IPv4"))
    datestr, hour = _utc_date_parts(alert_ts)
    return flagged.select(
        "*",
        F.col("alert_id").alias("__alert_id"),
        alert_ts.alias("alert_timestamp_sec"),
        (ts_sec * 1000 + F.floor(pcap["ts_usec"] / 1000).cast("long")).alias("record_first_seen_timestamp_ms"),
        F.lit(L7_APPLICATION_NAME).alias("l7_application_name"),
        ip["srcIP"].alias("src_ip"), ip_type.alias("src_ip_type"), ip["srcPort"].alias("src_port"),
        F.lit(False).alias("src_is_malicious"),
        ip["destIP"].alias("dest_ip"), ip_type.alias("dest_ip_type"), ip["destPort"].alias("dest_port"),
        F.lit(False).alias("dest_is_malicious"),
        F.lit(ENGINE_TYPE).alias("engine_type"), F.lit(engine_name).alias("engine_name"),
        F.lit(ALERT_TYPE).alias("alert_type"), F.lit(ALERT_NAME).alias("alert_name"),
        F.lit(THREAT_NAME).alias("threat_name"), F.col("`2ld`").alias("threat_hostname"),
        F.floor(F.col("tunnel_perc") * 100).cast("int").alias("confidence"),
        F.lit(-1).alias("severity"),
        F.to_json(F.struct(F.col("`2ld`"))).alias("details"),
        F.col("`2ld`").alias("ioc"),
        F.lit(1).cast("long").alias("flow_count"),
        F.lit(1).cast("decimal(38,0)").alias("sent_packets"),
        pcap["wirelen"].cast("decimal(38,0)").alias("sent_bytes"),
        F.lit(TELEMETRY_SOURCE).alias("telemetry_source"),
        F.to_json(F.col("payload")).alias("telemetry_details"),
        datestr.alias("__datestr"), hour.alias("__hour"),
    )


def enrich(df: DataFrame, ip_info: DataFrame | None, max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS,
           addresses: DataFrame | None = None) -> DataFrame:
    """O-56 (re-aimed): attributes of the addresses from a user-given table
    ``(ip, enrich, is_malicious)``.  ``ip`` is an address or a network
    (``10.0.0.0/8``, ``2001:db8::/32``); of the networks that an address lies in the
    most specific one counts.  A network with several rows counts once: its
    smallest ``enrich``, malicious if any row says so.  ``org_ip`` is the
    private-range side of the flow (source first).

    The distinct addresses are matched, and the thin result is joined once per
    side: broadcast if it is under the bounds, a shuffle join otherwise.
    ``addresses`` (one column ``ip``) names a table of all that occur in ``df``, as
    alert groups have them, which saves reading ``df`` for them.
    """
    private = F.col("__private")
    out = df.withColumn("__private", in_networks(F.col("src_ip")))
    out = out.withColumn("org_ip", F.when(private, F.col("src_ip")).otherwise(F.col("dest_ip")))
    if ip_info is None:
        return (out.withColumn("org_ip_enrich", F.lit(None).cast("string"))
                .withColumn("org_is_malicious", F.lit(False))
                .withColumn("src_ip_enrich", F.lit(None).cast("string"))
                .withColumn("dest_ip_enrich", F.lit(None).cast("string")).drop("__private"))
    networks = parse_networks(ip_info, "ip").groupBy("family", "bits", "prefix").agg(
        F.min("enrich").alias("enrich"), F.bool_or("is_malicious").alias("is_malicious"))
    if addresses is None:
        addresses = df.select(F.explode(F.array("src_ip", "dest_ip")).alias("ip"))
    used = addresses.where("ip is not null").distinct()
    matched = longest_match(used, networks, "ip", "__net", max_broadcast_rows).where("__net is not null")
    info = materialise(matched.select("ip", "__net.enrich", "__net.is_malicious")).for_join(max_broadcast_rows)
    for side in ("src", "dest"):
        renamed = info.select(F.col("ip").alias(f"__{side}_ip"), F.col("enrich").alias(f"{side}_ip_enrich"),
                              F.col("is_malicious").alias(f"__{side}_mal"))
        out = out.join(renamed, F.col(f"{side}_ip") == F.col(f"__{side}_ip"), "left").drop(f"__{side}_ip")
    # The address of the own side is one of the two.
    out = out.withColumn("org_ip_enrich", F.when(private, F.col("src_ip_enrich")).otherwise(F.col("dest_ip_enrich")))
    out = out.withColumn("org_is_malicious", F.coalesce(F.when(private, F.col("__src_mal")).otherwise(F.col("__dest_mal")), F.lit(False)))
    return out.drop("__src_mal", "__dest_mal", "__private")


def alert_table(flagged: DataFrame, ip_info: DataFrame | None = None,
                alert_timestamp_sec: int | None = None, engine_name: str = ENGINE_NAME,
                addresses: DataFrame | None = None) -> DataFrame:
    """O-58: the 36-column alert table; ``addresses`` as in ``enrich``."""
    fields = enrich(alert_fields(flagged, alert_timestamp_sec, engine_name), ip_info, addresses=addresses)
    return fields.select(
        F.col("__alert_id").alias("alert_id"),
        *[F.col(c) for c in ALERT_COLUMNS[1:29]],
        F.lit(None).cast("decimal(38,0)").alias("recv_packets"),
        F.col("sent_bytes"),
        F.lit(None).cast("decimal(38,0)").alias("recv_bytes"),
        F.col("telemetry_source"), F.col("telemetry_details"),
        F.col("__datestr").alias("datestr"), F.col("__hour").alias("hour"),
    )
