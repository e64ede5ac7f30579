"""DuckDB twins of the registered queries (the correctness oracle).

Each SQL string runs on the driver's tables (``events``, ``pages``, ``labels``,
``customer`` are views).  The DNS stand-in view, the registrable-domain rules
and the thirteen features are spelled out here in plain SQL, independently of
the Spark code: the registrable domain, for one, is computed by exploding the
candidate suffixes and grouping, not by per-depth lookups.
"""

from __future__ import annotations

# Parameters shared with tunnelscan.plans.queries (chosen once for the
# stand-in data; see FIXTURES.md section 6).
MIN_GROUP_COUNT = 12
MIN_UNIQUE_SHARE = 0.33
MIN_TUNNEL_SHARE = 0.24
GATE_QUERY_MIN_COUNT = 80
CONFUSION_DIGIT_SHARE = 0.45
# Thresholds of the config file query.
FILE_CONFIG = {"min_group_count": 40, "min_unique_qname_share": 0.3, "min_tunnel_share": 0.2}

# The suffix rules, written out apart from the code under test.
_RULES = """('com', 'exact'), ('net', 'exact'), ('org', 'exact'), ('uk', 'exact'), ('co.uk', 'exact'),
  ('arpa', 'exact'), ('in-addr.arpa', 'exact'), ('ck', 'wildcard'), ('www.ck', 'exception')"""

_UPPER = r"'[^\p{Lu}]'"
_DIGIT = r"'[^\p{Nd}]'"


def _count(x: str, pattern: str) -> str:
    return f"length(regexp_replace({x}, {pattern}, '', 'g'))"


def _digit_share(x: str) -> str:
    return f"(CASE WHEN length({x}) = 0 THEN 0.0 ELSE {_count(x, _DIGIT)} / length({x}) END)"


def _entropy(x: str, v: str = "ch") -> str:
    n = f"length({x})"
    cnt = f"({n} - length(replace({x}, {v}, '')))"
    return (f"(CASE WHEN {x} IS NULL THEN NULL "
            f"WHEN len(list_distinct(string_split({x}, ''))) <= 1 THEN 0.0 "
            f"ELSE abs(log2({n}) - list_sum(list_transform(list_distinct(string_split({x}, '')), "
            f"lambda {v}: {cnt} * log2({cnt}))) / {n}) END)")


def _name_features(x: str) -> str:
    n = f"length({x})"
    lens = f"list_transform(string_split({x}, '.'), lambda p: length(p))"

    def zero(expr: str) -> str:
        return f"(CASE WHEN {x} IS NULL THEN NULL WHEN {n} = 0 THEN 0.0 ELSE {expr} END)"

    cols = {
        "subdomain_length": f"CAST({n} AS INTEGER)",
        "subdomain_entropy": f"round({_entropy(x)}, 6)",
        "average_subdomain_length": f"round({zero(f'list_sum({lens}) / len({lens})')}, 6)",
        "min_subdomain_length": f"round({zero(f'CAST(list_min({lens}) AS DOUBLE)')}, 6)",
        "max_subdomain_length": f"round({zero(f'CAST(list_max({lens}) AS DOUBLE)')}, 6)",
        "label_count": f"CAST({n} - length(replace({x}, '.', '')) AS INTEGER)",
        "subdomain_uppercase_char": f"round({zero(_count(x, _UPPER) + ' / ' + n)}, 6)",
        "subdomain_numeric_char": f"round({zero(_count(x, _DIGIT) + ' / ' + n)}, 6)",
    }
    return ",\n  ".join(f"{e} AS {c}" for c, e in cols.items())


def _filled(features: str) -> str:
    """The same columns with 0 for NULL (O-18)."""
    out = []
    for line in features.split(",\n  "):
        expr, _, name = line.rpartition(" AS ")
        out.append(f"coalesce({expr}, 0.0) AS {name}")
    return ",\n  ".join(out)


def _answer_features(a: str) -> str:
    """NULL array -> NULL; empty array -> 0; a NULL item makes the means NULL
    (max skips it); an empty item makes the shares NULL."""
    has_null = f"len(list_filter({a}, lambda i: i IS NULL)) > 0"
    has_empty = f"len(list_filter({a}, lambda i: i IS NULL OR length(i) = 0)) > 0"

    def arr(expr: str, null_if: str | None = None) -> str:
        guard = f"WHEN {null_if} THEN NULL " if null_if else ""
        return f"round(CASE WHEN {a} IS NULL THEN NULL WHEN len({a}) = 0 THEN 0.0 {guard}ELSE {expr} END, 6)"

    def share(pattern: str) -> str:
        return (f"list_sum(list_transform({a}, lambda i: "
                f"length(regexp_replace(i, {pattern}, '', 'g')) / length(i))) / len({a})")

    cols = {
        "average_answer_length": arr(f"list_sum(list_transform({a}, lambda i: length(i))) / len({a})", has_null),
        "max_answer_length": arr(f"CAST(list_max(list_transform({a}, lambda i: length(i))) AS DOUBLE)"),
        "average_answer_uppercase_char": arr(share(_UPPER), has_empty),
        "average_answer_numeric_char": arr(share(_DIGIT), has_empty),
        "average_answer_entropy": arr(f"list_sum(list_transform({a}, lambda i: {_entropy('i', 'c2')})) / len({a})",
                                      has_null),
    }
    return ",\n  ".join(f"{e} AS {c}" for c, e in cols.items())


def _char_features(s: str) -> str:
    n = f"length({s})"

    def z(expr: str) -> str:
        return f"round(CASE WHEN {s} IS NULL THEN NULL WHEN {n} = 0 THEN CAST(0.0 AS DOUBLE) ELSE {expr} END, 6)"

    cols = {
        "average_answer_length": z("CAST(1.0 AS DOUBLE)"),
        "max_answer_length": z("CAST(1.0 AS DOUBLE)"),
        "average_answer_uppercase_char": z(f"length(regexp_replace({s}, {_UPPER}, '', 'g')) / {n}"),
        "average_answer_numeric_char": z(f"length(regexp_replace({s}, {_DIGIT}, '', 'g')) / {n}"),
        "average_answer_entropy": z("CAST(0.0 AS DOUBLE)"),
    }
    return ",\n  ".join(f"{e} AS {c}" for c, e in cols.items())


# The DNS stand-in view (FIXTURES.md section 6), one row per message.
VIEW = f"""
rules(suffix, kind) AS (VALUES {_RULES}),
pg AS (SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS page_host FROM pages),
ev AS (SELECT e.*, CASE event_id % 29 WHEN 1 THEN 'relay.evil.io' WHEN 2 THEN 'shop.example.co.uk' WHEN 3 THEN 'a.b.ck'
         WHEN 4 THEN 'www.ck' WHEN 5 THEN '4.3.2.10.in-addr.arpa' WHEN 6 THEN 'com' WHEN 7 THEN 'Mixed.Case.COM'
         WHEN 8 THEN 'x.deep.co.jp' ELSE page_host END AS host
       FROM events e JOIN pg ON e.event_id % (SELECT count(*) FROM pages) = pg.page_id),
msg0 AS (
  SELECT CAST(event_id AS VARCHAR) AS key, event_id, event_type, props, user_id, ts, host,
    (event_id % 10) <> 9 AS qr,
    CASE WHEN event_type = 'error' THEN 'NXDOMAIN' ELSE 'NOERROR' END AS response_code,
    CASE WHEN event_type = 'purchase' THEN upper(md5(CAST(event_id AS VARCHAR))) || '.' || host ELSE host END
      || CASE WHEN event_id % 61 = 0 THEN '' ELSE '.' END AS asked,
    CASE WHEN event_id % 37 = 3 THEN NULL WHEN event_id % 7 = 0 THEN CAST([] AS VARCHAR[])
         ELSE [md5(props),
               CASE WHEN event_id % 41 = 5 THEN NULL WHEN event_type = 'click' THEN 'v=spf1 ' || props ELSE 'V=' || props END,
               CASE WHEN event_id % 43 = 6 THEN '' ELSE event_type END]
    END AS rdata,
    CASE WHEN event_id % 37 = 3 THEN NULL WHEN event_id % 7 = 0 THEN CAST([] AS VARCHAR[])
         ELSE ['TXT', 'TXT', CASE WHEN event_type = 'view' THEN 'RRSIG' ELSE 'CNAME' END]
    END AS rtype,
    event_id % 53 = 7 AS is_ipv6,
    CASE WHEN event_id % 59 = 8 THEN NULL WHEN event_id % 53 = 7 THEN '2001:db8::' || CAST(user_id % 16 AS VARCHAR)
         ELSE '10.0.0.' || CAST(user_id % 16 AS VARCHAR) END AS "srcIP",
    CASE WHEN event_id % 53 = 7 THEN '2001:db8::53' WHEN event_id % 11 = 0 THEN '198.51.100.7' ELSE '192.0.2.53' END AS "destIP",
    CAST(1024 + event_id % 60000 AS INTEGER) AS src_port,
    CAST(53 AS INTEGER) AS dest_port,
    CAST(floor(epoch_us(ts) / 10000000) * 10 AS BIGINT) AS ts_sec,
    CAST(epoch_us(ts) % 1000000 AS BIGINT) AS ts_usec,
    strftime(ts, '%Y%m%d') AS datestr,
    strftime(ts, '%H') AS hour
  FROM ev),
msg AS MATERIALIZED (SELECT *, CAST(60 + length(asked) AS BIGINT) AS wirelen,
          CASE event_id % 31 WHEN 0 THEN [asked, 'mail.' || asked] WHEN 1 THEN CAST([] AS VARCHAR[]) WHEN 2 THEN NULL
               ELSE [asked] END AS qnames
        FROM msg0),
resp AS (SELECT *, unnest(qnames) AS qname FROM msg WHERE qr AND response_code = 'NOERROR'),
names AS (SELECT DISTINCT unnest(qnames) AS qname FROM msg),
lab AS (SELECT qname, regexp_replace(qname, '\\.$', '') AS stripped,
               string_split(lower(regexp_replace(qname, '\\.$', '')), '.') AS labels FROM names),
cand AS (SELECT qname, labels, unnest(range(1, len(labels) + 1)) AS k FROM lab),
cand2 AS (SELECT qname, labels, k, array_to_string(list_slice(labels, len(labels) - k + 1, len(labels)), '.') AS c FROM cand),
m AS (SELECT cand2.qname,
             max(CASE WHEN r.kind = 'exception' THEN k - 1 END) AS exc_len,
             max(CASE WHEN r.kind = 'exact' THEN k WHEN r.kind = 'wildcard' AND len(labels) >= k + 1 THEN k + 1 END) AS best_len
      FROM cand2 JOIN rules r ON cand2.c = r.suffix GROUP BY cand2.qname),
dom AS MATERIALIZED (SELECT lab.qname,
          -- Without a matching rule the last label acts as the suffix.
          CASE WHEN len(labels) >= coalesce(exc_len, best_len, 1) + 1 AND stripped <> ''
               THEN array_to_string(list_slice(labels, len(labels) - coalesce(exc_len, best_len, 1), len(labels)), '.') END AS sld
        FROM lab LEFT JOIN m ON lab.qname = m.qname),
rows_all AS (SELECT resp.*, dom.sld FROM resp LEFT JOIN dom ON resp.qname = dom.qname),
cands AS (SELECT * FROM rows_all WHERE NOT ends_with(sld, 'in-addr.arpa')),
busy AS (SELECT "srcIP", "destIP", sld, count(*) AS cnt FROM cands GROUP BY ALL HAVING count(*) >= {MIN_GROUP_COUNT}),
gated AS (SELECT c.*, b.cnt FROM cands c JOIN busy b USING ("srcIP", "destIP", sld)),
scored AS (SELECT *, CASE WHEN length(qname) > 45 THEN 'tunnel' ELSE 'normal' END AS label_str FROM gated),
stats AS (SELECT "srcIP", "destIP", sld,
            CAST(count(DISTINCT qname) AS BIGINT) AS unique_qname_count,
            CAST(count(sld) AS BIGINT) AS sld_count,
            CAST(sum(CASE WHEN label_str = 'normal' THEN 1 ELSE 0 END) AS BIGINT) AS normal_count,
            CAST(sum(CASE WHEN label_str <> 'normal' THEN 1 ELSE 0 END) AS BIGINT) AS tunnel_count
          FROM scored GROUP BY ALL HAVING sum(CASE WHEN label_str <> 'normal' THEN 1 ELSE 0 END) > 0),
alerts AS (SELECT *, unique_qname_count / sld_count AS unique_perc, tunnel_count / sld_count AS tunnel_perc
           FROM stats
           WHERE unique_qname_count / sld_count >= {MIN_UNIQUE_SHARE} AND tunnel_count / sld_count >= {MIN_TUNNEL_SHARE})
"""


# Flagged rows with their group's tunnel share and the payload as JSON text
# (the field order and formatting of Spark's to_json).
_TELE = """
, fl AS (SELECT c.*, a.tunnel_perc FROM cands c JOIN alerts a USING ("srcIP", "destIP", sld)),
p AS (SELECT fl.*,
        '{"header":' || to_json({'QR': qr, 'responseCode': response_code, 'id': event_id})
        || ',"questions":' || to_json(list_transform(qnames, lambda q: {'name': q}))
        || CASE WHEN rdata IS NULL THEN '' ELSE ',"answers":['
             || array_to_string(list_transform(range(1, len(rdata) + 1), lambda i:
                  CASE WHEN rdata[i] IS NULL THEN '{"type":' || to_json(rtype[i]) || '}'
                       ELSE '{"rdata":' || to_json(rdata[i]) || ',"type":' || to_json(rtype[i]) || '}' END), ',') || ']' END
        || ',"ip":' || to_json({'srcIP': "srcIP", 'destIP': "destIP", 'srcPort': src_port, 'destPort': dest_port, 'isIPv6': is_ipv6})
        || ',"pcap":' || to_json({'ts_sec': ts_sec, 'ts_usec': ts_usec, 'wirelen': wirelen})
        || ',"authority":' || to_json('ns.' || host) || '}' AS tele
      FROM fl)
"""

# The cleaned '~' training sample (O-01, O-08..O-10, O-20) derived from the view.
_CLEAN = """
, lbl AS (SELECT CAST(doc_id AS VARCHAR) AS key, quality, toxic FROM labels),
t AS (SELECT m.qnames[1] AS "QNAME", nullif(array_to_string(m.rdata, '|'), '') AS "RDATA",
             CASE WHEN (length(m.qnames[1]) > 45) <> (m.event_id % 23 = 9) THEN 'tunnel' ELSE 'normal' END AS base, l.quality, l.toxic, m."srcIP" AS src
      FROM msg m LEFT JOIN lbl l ON m.key = l.key),
n AS (SELECT "QNAME", "RDATA", src,
             CASE WHEN quality = 0 THEN upper(substr(base, 1, 1)) || substr(base, 2)
                  WHEN toxic = 1 THEN base || ',,' ELSE base END AS raw FROM t),
c AS (SELECT "QNAME", "RDATA", src, replace(raw, ',', '') AS "DnsTunnel" FROM n),
clean AS (SELECT "QNAME", "RDATA", "DnsTunnel", src, CASE "DnsTunnel" WHEN 'normal' THEN 0 WHEN 'tunnel' THEN 1 END AS label
          FROM c WHERE "QNAME" IS NOT NULL AND "RDATA" IS NOT NULL AND "DnsTunnel" IS NOT NULL
                   AND "DnsTunnel" IN ('tunnel', 'normal'))
"""


def _with(body: str) -> str:
    return "WITH " + VIEW.strip() + "\n" + body.strip()


ORACLE = {
    "responses_exploded": _with("""
SELECT key, qname AS "QNAME", ts_sec, "srcIP", "destIP", datestr, hour FROM resp
"""),
    "registrable_domain": _with("""
SELECT key, qname AS "QNAME", sld AS "2ld" FROM cands
"""),
    "subdomain_features": _with(f"""
, sub AS (SELECT key, qname, sld, replace(qname, sld || '.', '') AS x FROM cands)
SELECT key, qname AS "QNAME", sld AS lld,
  {_name_features('x')}
FROM sub
"""),
    "answer_features": _with(f"""
SELECT key, qname AS "QNAME",
  {_filled(_answer_features('rdata'))}
FROM resp
"""),
    "answer_exclusion": _with("""
, kept AS (
  SELECT key, list_transform(list_filter(range(1, len(rdata) + 1), lambda i:
           NOT list_contains(['RRSIG', 'DNSKEY', 'DS', 'eNSEC', 'NSEC3', 'CDNSKEY', 'CDS', 'TSIG', 'TKEY'], rtype[i])
           AND NOT coalesce(contains(rdata[i], 'v=spf1') OR contains(rdata[i], 'docusign=') OR contains(rdata[i], 'verification='), false)),
         lambda i: rdata[i]) AS k
  FROM msg)
SELECT key, array_to_string(k, '|') AS kept_rdata, CAST(coalesce(len(k), -1) AS INTEGER) AS kept_count FROM kept
"""),
    "answer_features_excluded": _with(f"""
, kept AS (
  SELECT key, qname, list_transform(list_filter(range(1, len(rdata) + 1), lambda i:
           NOT list_contains(['RRSIG', 'DNSKEY', 'DS', 'eNSEC', 'NSEC3', 'CDNSKEY', 'CDS', 'TSIG', 'TKEY'], rtype[i])
           AND NOT coalesce(contains(rdata[i], 'v=spf1') OR contains(rdata[i], 'docusign=') OR contains(rdata[i], 'verification='), false)),
         lambda i: rdata[i]) AS k
  FROM resp)
SELECT key, qname AS "QNAME",
  {_filled(_answer_features('k'))}
FROM kept
"""),
    "volume_gate": _with(f"""
, b2 AS (SELECT "srcIP", "destIP", sld, count(*) AS cnt FROM cands GROUP BY ALL HAVING count(*) >= {GATE_QUERY_MIN_COUNT})
SELECT c.key, c.qname AS "QNAME", c."srcIP", c."destIP", c.sld AS "2ld", CAST(b2.cnt AS BIGINT) AS count
FROM cands c JOIN b2 USING ("srcIP", "destIP", sld)
"""),
    "suspicious_groups": _with("""
, p AS (SELECT *, CASE WHEN length(qname) > 50 THEN 1.0 WHEN length(qname) > 45 THEN 2.0
                       WHEN ts_sec % 97 = 0 THEN 3.0 ELSE 0.0 END AS prediction FROM gated),
l AS (SELECT *, CASE prediction WHEN 0.0 THEN 'normal' WHEN 1.0 THEN 'tunnel' WHEN 2.0 THEN 'tunnel_keepalive' END AS label_str FROM p),
k AS (SELECT DISTINCT "srcIP", "destIP", sld FROM l WHERE label_str <> 'normal')
SELECT key, qname AS "QNAME", "srcIP", "destIP", sld AS "2ld", label_str,
       CASE WHEN label_str = 'normal' THEN 1 ELSE 0 END AS normal,
       CASE WHEN label_str <> 'normal' THEN 1 ELSE 0 END AS tunnel
FROM l WHERE ("srcIP", "destIP", sld) IN (SELECT ("srcIP", "destIP", sld) FROM k)
"""),
    "group_verdict": _with("""
SELECT "srcIP", "destIP", sld AS "2ld", unique_qname_count AS "unique_QNAME_count", sld_count AS "2ld_count",
       normal_count, tunnel_count, round(unique_perc, 6) AS "unique_QNAME_perc", round(tunnel_perc, 6) AS tunnel_perc
FROM alerts
"""),
    "merged_verdict": _with("""
, g AS (SELECT "srcIP", "destIP", sld, ts_sec - lag(ts_sec) OVER (PARTITION BY "srcIP", "destIP", sld ORDER BY ts_sec) AS gap
        FROM gated),
i AS (SELECT "srcIP", "destIP", sld, CAST(max(gap) AS BIGINT) AS max_gap, round(avg(gap), 6) AS mean_gap FROM g GROUP BY ALL)
SELECT a."srcIP", a."destIP", a.sld AS "2ld", unique_qname_count AS "unique_QNAME_count", sld_count AS "2ld_count",
       normal_count, tunnel_count, round(unique_perc, 6) AS "unique_QNAME_perc", round(tunnel_perc, 6) AS tunnel_perc,
       max_gap AS max_interval_time, mean_gap AS average_interval_time
FROM alerts a JOIN i USING ("srcIP", "destIP", sld)
"""),
    "flagged_messages": _with("""
SELECT c.key, c.qnames[1] AS name, c."srcIP", c."destIP", c.ts_sec, CAST(coalesce(len(c.rdata), -1) AS INTEGER) AS n_answers,
       c.event_id AS message_id, 'ns.' || c.host AS authority
FROM cands c JOIN alerts a USING ("srcIP", "destIP", sld)
"""),
    "alert_ids": _with("""
SELECT "srcIP", "destIP", sld AS "2ld",
       CAST(('0x' || substr(md5("srcIP" || '|' || "destIP" || '|' || sld), 1, 15)) AS BIGINT) AS alert_id
FROM alerts
"""),
    "verdict_from_config": _with(f"""
, g AS (SELECT "srcIP", "destIP", sld, count(*) AS n, count(DISTINCT qname) AS u,
               sum(CASE WHEN length(qname) > 45 THEN 1 ELSE 0 END) AS t
        FROM cands WHERE "srcIP" IS NOT NULL GROUP BY ALL)
SELECT "srcIP", "destIP", sld AS "2ld", CAST(n AS BIGINT) AS "2ld_count", CAST(t AS BIGINT) AS tunnel_count
FROM g WHERE n >= {FILE_CONFIG["min_group_count"]} AND t > 0 AND u / n >= {FILE_CONFIG["min_unique_qname_share"]}
         AND t / n >= {FILE_CONFIG["min_tunnel_share"]}
"""),
    "interval_stats": _with("""
, g AS (SELECT "srcIP", "destIP", sld, ts_sec - lag(ts_sec) OVER (PARTITION BY "srcIP", "destIP", sld ORDER BY ts_sec) AS gap
        FROM gated)
SELECT "srcIP", "destIP", sld AS "2ld", CAST(max(gap) AS BIGINT) AS max_interval_time,
       round(avg(gap), 6) AS average_interval_time
FROM g GROUP BY ALL
"""),
    "row_counts": _with("""
SELECT 'question_rows' AS stage, count(*) AS rows FROM rows_all
UNION ALL SELECT 'undomained_rows', count(*) FROM rows_all WHERE sld IS NULL
UNION ALL SELECT 'candidate_rows', count(*) FROM cands
UNION ALL SELECT 'scored_rows', count(*) FROM scored
UNION ALL SELECT 'suspicious_groups', count(*) FROM stats
UNION ALL SELECT 'alert_groups', count(*) FROM alerts
UNION ALL SELECT 'flagged_rows', count(*) FROM cands c JOIN alerts a USING ("srcIP", "destIP", sld)
"""),
    "alert_table": _with(_TELE + """
SELECT CAST(-1 AS INTEGER) AS alert_id,
  ts_sec AS alert_timestamp_sec,
  ts_sec * 1000 + CAST(floor(ts_usec / 1000) AS BIGINT) AS record_first_seen_timestamp_ms,
  'DNS' AS l7_application_name,
  CAST(NULL AS VARCHAR) AS org_ip_enrich, CASE WHEN "srcIP" LIKE '10.%' THEN "srcIP" ELSE "destIP" END AS org_ip, false AS org_is_malicious,
  CAST(NULL AS VARCHAR) AS src_ip_enrich,
  "srcIP" AS src_ip, CASE WHEN is_ipv6 THEN 'IPv6' ELSE 'IPv4' END AS src_ip_type, src_port,
  false AS src_is_malicious,
  CAST(NULL AS VARCHAR) AS dest_ip_enrich,
  "destIP" AS dest_ip, CASE WHEN is_ipv6 THEN 'IPv6' ELSE 'IPv4' END AS dest_ip_type, dest_port,
  false AS dest_is_malicious,
  'ML' AS engine_type, 'TUNNELSCAN' AS engine_name, 'TUNNELLING' AS alert_type, 'TUNNELLING' AS alert_name,
  '-' AS threat_name, sld AS threat_hostname,
  CAST(floor(tunnel_perc * 100) AS INTEGER) AS confidence,
  CAST(-1 AS INTEGER) AS severity,
  '{"2ld":"' || sld || '"}' AS details,
  sld AS ioc, CAST(1 AS BIGINT) AS flow_count,
  CAST(1 AS DECIMAL(38,0)) AS sent_packets, CAST(NULL AS DECIMAL(38,0)) AS recv_packets,
  CAST(wirelen AS DECIMAL(38,0)) AS sent_bytes, CAST(NULL AS DECIMAL(38,0)) AS recv_bytes,
  'DNS' AS telemetry_source, tele AS telemetry_details,
  strftime(make_timestamp(ts_sec * 1000000), '%Y%m%d') AS datestr,
  strftime(make_timestamp(ts_sec * 1000000), '%H') AS hour
FROM p
"""),
    "kafka_records": _with(_TELE + """
SELECT md5("srcIP" || '|' || "destIP" || '|' || sld) AS key,
  to_json({'alert_id': CAST(-1 AS INTEGER), 'alert_timestamp_sec': ts_sec,
           'record_first_seen_timestamp_ms': ts_sec * 1000 + CAST(floor(ts_usec / 1000) AS BIGINT),
           'l7_application_name': 'DNS', 'org_ip': CASE WHEN "srcIP" LIKE '10.%' THEN "srcIP" ELSE "destIP" END, 'org_is_malicious': false,
           'src_ip': "srcIP", 'src_ip_type': CASE WHEN is_ipv6 THEN 'IPv6' ELSE 'IPv4' END, 'src_port': src_port,
           'src_is_malicious': false, 'dest_ip': "destIP", 'dest_ip_type': CASE WHEN is_ipv6 THEN 'IPv6' ELSE 'IPv4' END,
           'dest_port': dest_port, 'dest_is_malicious': false, 'engine_type': 'ML', 'engine_name': 'TUNNELSCAN',
           'alert_type': 'TUNNELLING', 'alert_name': 'TUNNELLING', 'threat_name': '-', 'threat_hostname': sld,
           'confidence': CAST(floor(tunnel_perc * 100) AS INTEGER), 'severity': CAST(-1 AS INTEGER),
           'details': '{"2ld":"' || sld || '"}', 'ioc': sld, 'flow_count': CAST(1 AS BIGINT),
           'sent_packets': CAST(1 AS DECIMAL(38,0)), 'sent_bytes': CAST(wirelen AS DECIMAL(38,0)),
           'telemetry_source': 'DNS', 'telemetry_details': tele,
           'datestr': strftime(make_timestamp(ts_sec * 1000000), '%Y%m%d'),
           'hour': strftime(make_timestamp(ts_sec * 1000000), '%H')}) AS value
FROM p
"""),
    "alert_enriched": _with("""
, ipinfo AS (SELECT '10.0.0.' || CAST(c_custkey % 16 AS VARCHAR) AS ip, min(c_name) AS enrich,
                    bool_or(c_acctbal < 0) AS is_malicious
             FROM customer GROUP BY 1),
fl AS (SELECT c.key, c."srcIP", c."destIP" FROM cands c JOIN alerts a USING ("srcIP", "destIP", sld)),
o AS (SELECT *, CASE WHEN regexp_matches("srcIP", '^(10\\.|192\\.168\\.|172\\.(1[6-9]|2[0-9]|3[01])\\.)') THEN "srcIP" ELSE "destIP" END AS org_ip FROM fl)
SELECT o.key, o."srcIP" AS src_ip, o."destIP" AS dest_ip, o.org_ip,
       oi.enrich AS org_ip_enrich, coalesce(oi.is_malicious, false) AS org_is_malicious,
       si.enrich AS src_ip_enrich, di.enrich AS dest_ip_enrich
FROM o LEFT JOIN ipinfo oi ON o.org_ip = oi.ip
       LEFT JOIN ipinfo si ON o."srcIP" = si.ip
       LEFT JOIN ipinfo di ON o."destIP" = di.ip
"""),
    "flow_networks": _with("""
, rules_of AS (SELECT c_custkey % 10 AS form, c_custkey % 16 AS low, c_custkey, c_name, c_acctbal < 0 AS bad FROM customer),
raw AS (SELECT CASE form WHEN 0 THEN '10.0.0.' || low WHEN 1 THEN '10.0.0.' || low WHEN 2 THEN '10.0.0.0' WHEN 3 THEN '2001:db8::' || low
                 WHEN 4 THEN '2001:db8::0' WHEN 5 THEN '192.0.2.63' WHEN 6 THEN '198.51.100.7' WHEN 7 THEN '0.0.0.0' END AS ip,
               CASE form WHEN 0 THEN 32 WHEN 1 THEN 30 WHEN 2 THEN 8 WHEN 3 THEN 128 WHEN 4 THEN 32 + 16 * (c_custkey % 3)
                 WHEN 5 THEN 24 + c_custkey % 7 WHEN 6 THEN 32 WHEN 7 THEN 0 END AS len, c_name, bad
        FROM rules_of WHERE form < 8),
f AS (SELECT "srcIP" AS src_ip, "destIP" AS dest_ip, count(*) AS messages FROM msg GROUP BY ALL),
ips AS (SELECT ip FROM raw UNION SELECT src_ip FROM f UNION SELECT dest_ip FROM f),
parts AS (SELECT ip, contains(ip, ':') AS six, [x FOR x IN string_split(split_part(ip, '::', 1), ':') IF x <> ''] AS l,
                 [x FOR x IN string_split(split_part(ip, '::', 2), ':') IF x <> ''] AS r FROM ips WHERE ip IS NOT NULL),
b AS (SELECT ip, six, CASE WHEN six THEN array_to_string([lpad(bin(TRY_CAST('0x' || g AS INTEGER)), 16, '0')
                 FOR g IN list_concat(l, list_concat(['0' FOR z IN range(8 - len(l) - len(r))], r))], '')
               ELSE array_to_string([lpad(bin(TRY_CAST(o AS INTEGER)), 8, '0') FOR o IN string_split(ip, '.')], '') END AS bits
      FROM parts),
net AS (SELECT six, len, left(bits, len) AS p, min(c_name) AS enrich, bool_or(bad) AS bad FROM raw JOIN b ON raw.ip = b.ip GROUP BY ALL),
hit AS (SELECT b.ip, arg_max(enrich, len) AS enrich, arg_max(bad, len) AS bad FROM b JOIN net ON b.six = net.six AND left(b.bits, len) = p
        GROUP BY b.ip)
SELECT f.src_ip, f.dest_ip, f.messages, CASE WHEN f.src_ip LIKE '10.%' THEN f.src_ip ELSE f.dest_ip END AS org_ip,
       s.enrich AS src_ip_enrich, d.enrich AS dest_ip_enrich,
       CASE WHEN f.src_ip LIKE '10.%' THEN s.enrich ELSE d.enrich END AS org_ip_enrich,
       coalesce(CASE WHEN f.src_ip LIKE '10.%' THEN s.bad ELSE d.bad END, false) AS org_is_malicious
FROM f LEFT JOIN hit s ON f.src_ip = s.ip LEFT JOIN hit d ON f.dest_ip = d.ip
"""),
    "confusion_metrics": _with(f"""
, s AS (SELECT CASE WHEN length(qname) > 45 THEN 1.0 ELSE 0.0 END AS label,
               CASE WHEN {_digit_share("replace(qname, sld || '.', '')")} > {CONFUSION_DIGIT_SHARE} THEN 1.0 ELSE 0.0 END AS prediction
        FROM cands),
cm AS (SELECT label, prediction, count(*) AS n FROM s GROUP BY ALL),
bl AS (SELECT label, sum(n) AS n_label, sum(CASE WHEN label = prediction THEN n ELSE 0 END) AS tp FROM cm GROUP BY label),
bp AS (SELECT prediction AS p, sum(n) AS n_pred FROM cm GROUP BY prediction),
per AS (SELECT n_label, tp, CASE WHEN coalesce(n_pred, 0) > 0 THEN tp / n_pred ELSE 0.0 END AS prec, tp / n_label AS rec
        FROM bl LEFT JOIN bp ON bl.label = bp.p)
SELECT round(sum(tp) / sum(n_label), 6) AS accuracy,
       round(sum(n_label * rec) / sum(n_label), 6) AS "weightedRecall",
       round(sum(n_label * prec) / sum(n_label), 6) AS "weightedPrecision",
       round(sum(n_label * CASE WHEN prec + rec > 0 THEN 2 * prec * rec / (prec + rec) ELSE 0.0 END) / sum(n_label), 6) AS f1
FROM per
"""),
    "auc_metrics": _with(f"""
, s AS (SELECT CASE WHEN length(qname) > 45 THEN 1 ELSE 0 END AS label,
               {_digit_share("replace(qname, sld || '.', '')")} AS score FROM cands),
g AS (SELECT score, CAST(sum(label) AS DOUBLE) AS p, CAST(sum(1 - label) AS DOUBLE) AS n FROM s GROUP BY score),
c AS (SELECT score, sum(p) OVER w AS tp, sum(n) OVER w AS fp FROM g WINDOW w AS (ORDER BY score DESC)),
t AS (SELECT max(tp) AS p, max(fp) AS n FROM c),
r AS (SELECT c.score, c.tp / t.p AS recall, c.fp / t.n AS fallout, c.tp / (c.tp + c.fp) AS precision FROM c, t),
d AS (SELECT recall, fallout, precision, lag(recall, 1, 0.0) OVER w AS r0, lag(fallout, 1, 0.0) OVER w AS f0,
             lag(precision, 1, precision) OVER w AS p0 FROM r WINDOW w AS (ORDER BY score DESC))
SELECT round(sum((fallout - f0) * (recall + r0) / 2), 6) AS "areaUnderROC",
       round(sum((recall - r0) * (precision + p0) / 2), 6) AS "areaUnderPR" FROM d
"""),
    "alerts_written": _with("""
SELECT c.key, CAST(c.ts_sec AS BIGINT) AS alert_timestamp_sec, c."srcIP" AS src_ip, c.sld AS ioc,
       strftime(make_timestamp(c.ts_sec * 1000000), '%Y%m%d') AS datestr,
       strftime(make_timestamp(c.ts_sec * 1000000), '%H') AS hour
FROM cands c JOIN alerts a USING ("srcIP", "destIP", sld)
"""),
    "csv_clean_labels": _with(_CLEAN + """
SELECT "QNAME", "RDATA", "DnsTunnel", src, label FROM clean
"""),
    "training_counts": _with(_CLEAN + """
, b AS (SELECT CAST(('0x' || substr(md5("QNAME" || '|' || "RDATA" || '|' || '42'), 1, 8)) AS BIGINT) % 1000 AS bucket
        FROM clean)
SELECT 'sample_rows' AS stage, count(*) AS rows FROM msg
UNION ALL SELECT 'feature_rows', count(*) FROM clean
UNION ALL SELECT 'undomained_rows', count(*) FROM clean LEFT JOIN dom ON clean."QNAME" = dom.qname WHERE dom.sld IS NULL
UNION ALL SELECT 'train_rows', count(*) FROM b WHERE bucket < 800
UNION ALL SELECT 'test_rows', count(*) FROM b WHERE bucket >= 800
"""),
    "training_features": _with(_CLEAN + f"""
, t2 AS (SELECT clean.*, dom.sld AS lld FROM clean LEFT JOIN dom ON clean."QNAME" = dom.qname),
t3 AS (SELECT *, replace("QNAME", lld || '.', '') AS x, string_split("RDATA", '|') AS arr FROM t2)
SELECT "QNAME", "RDATA", lld,
  {_name_features('x').replace(' AS INTEGER)', ' AS DOUBLE)')},
  {_answer_features('arr')}
FROM t3
"""),
    "document_answer_features": f"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS arr FROM documents)
SELECT doc_id,
  {_answer_features('arr')}
FROM d
""",
}


_FEATURES = ("subdomain_length", "subdomain_entropy", "average_subdomain_length", "min_subdomain_length",
             "max_subdomain_length", "label_count", "subdomain_uppercase_char", "subdomain_numeric_char",
             "average_answer_length", "max_answer_length", "average_answer_uppercase_char",
             "average_answer_numeric_char", "average_answer_entropy")
ORACLE["assembled_features"] = f"""
SELECT "QNAME", "RDATA", {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in _FEATURES)}
FROM ({ORACLE["training_features"]}) AS f
WHERE {" AND ".join(f"{c} IS NOT NULL" for c in _FEATURES)}
"""

# Every hold-out row with a feature vector, by forest and by node table alike.
ORACLE["forest_votes"] = f"""
SELECT CAST(count(*) AS BIGINT) AS rows, CAST(count(*) AS BIGINT) AS agreeing FROM ({ORACLE["assembled_features"]}) AS a
WHERE CAST(('0x' || substr(md5("QNAME" || '|' || "RDATA" || '|' || '42'), 1, 8)) AS BIGINT) % 1000 >= 800
"""

# Checks of fitted models: what holds for every right fit.
ORACLE["lr_optimality"] = "SELECT unnest([" + ", ".join(f"'{c}'" for c in ("intercept", *_FEATURES)) + "]) AS feature, true AS at_optimum"
ORACLE["rf_importances_check"] = "SELECT unnest([" + ", ".join(f"'{c}'" for c in _FEATURES) + "]) AS feature, true AS agrees"
ORACLE["rf_metrics_check"] = 'SELECT true AS "areaUnderROC_agrees", true AS "areaUnderPR_agrees"'
ORACLE["forest_separates"] = "SELECT true AS separates, true AS both_classes"
ORACLE["auc_ranges"] = ORACLE["auc_metrics"]

ORACLE["cv_folds"] = _with(_CLEAN + """
, h AS (SELECT label, "QNAME" || '|' || "RDATA" || '|42' AS t FROM clean)
SELECT CAST(CAST('0x' || substr(md5(t || '|fold'), 1, 8) AS BIGINT) % 1000 % 3 AS INTEGER) AS fold,
       count(*) AS rows, CAST(sum(label) AS BIGINT) AS tunnels
FROM h WHERE CAST('0x' || substr(md5(t), 1, 8) AS BIGINT) % 1000 < 800 GROUP BY ALL
""")

ORACLE["answer_features_chars"] = _with(_CLEAN + f"""
SELECT "QNAME", "RDATA",
  {_char_features('"RDATA"')}
FROM clean
""")


# Names with their endings as asked and in coded form; the rules coded by hand.
ORACLE["registrable_domain_idn"] = """
WITH ends(k, ending, plain) AS (VALUES
  (0, 'shop.公司.cn', 'shop.xn--55qx5d.cn'), (1, 'shop.xn--55qx5d.cn.', 'shop.xn--55qx5d.cn'),
  (2, 'SHOP.XN--55QX5D.CN', 'shop.xn--55qx5d.cn'), (3, '公司.cn', 'xn--55qx5d.cn'), (4, 'почта.рф', 'xn--80a1acny.xn--p1ai'),
  (5, 'a.xn--p1ai.', 'a.xn--p1ai'), (6, 'a.b.川崎.jp', 'a.b.xn--8ltrs.jp'), (7, 'a.city.xn--8ltrs.jp.', 'a.city.xn--8ltrs.jp'),
  (8, 'me.blogspot.com', 'me.blogspot.com'), (9, '例え.com', 'xn--r8jz45g.com'), (10, 'blogspot.com.', 'blogspot.com'),
  (11, 'www。例え。com', 'www.xn--r8jz45g.com'), (12, 'plain.example.cn', 'plain.example.cn'), (13, 'no.such.ending', 'no.such.ending')),
rules(suffix, kind, private) AS (VALUES ('com', 'exact', false), ('cn', 'exact', false), ('xn--55qx5d.cn', 'exact', false),
  ('xn--p1ai', 'exact', false), ('jp', 'exact', false), ('xn--8ltrs.jp', 'wildcard', false),
  ('city.xn--8ltrs.jp', 'exception', false), ('blogspot.com', 'exact', true)),
e AS (SELECT CAST(event_id AS VARCHAR) AS key, 'u' || substr(md5(CAST(event_id AS VARCHAR)), 1, 6) || '.' AS first, ending, plain
      FROM events JOIN ends ON event_id % 14 = k),
n AS (SELECT key, first || ending AS qname, first || plain AS plain FROM e),
-- The labels as the name has them, and coded.
s AS (SELECT DISTINCT qname, string_split(lower(regexp_replace(replace(qname, '。', '.'), '[.]$', '')), '.') AS shown,
             string_split(plain, '.') AS labels FROM n),
c AS (SELECT qname, labels, k, array_to_string(list_slice(labels, len(labels) - k + 1, len(labels)), '.') AS c
      FROM s, LATERAL (SELECT unnest(range(1, len(labels) + 1)) AS k)),
m AS (SELECT qname, p, coalesce(max(CASE WHEN kind = 'exception' THEN k - 1 END),
               max(CASE WHEN kind = 'exact' THEN k WHEN kind = 'wildcard' AND len(labels) > k THEN k + 1 END)) AS n
      FROM c JOIN rules ON c = suffix CROSS JOIN (VALUES (true), (false)) AS w(p) WHERE p OR NOT private GROUP BY ALL),
d AS (SELECT s.qname, p, array_to_string(list_slice(shown, len(shown) - m.n, len(shown)), '.') AS shown,
             array_to_string(list_slice(labels, len(labels) - m.n, len(labels)), '.') AS coded
      FROM s JOIN m ON s.qname = m.qname AND len(labels) > m.n)
SELECT n.key, n.qname AS "QNAME", a.shown AS domain, i.shown AS icann_domain, a.coded AS ascii_domain
FROM n LEFT JOIN d a ON n.qname = a.qname AND a.p LEFT JOIN d i ON n.qname = i.qname AND NOT i.p
"""


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE)
