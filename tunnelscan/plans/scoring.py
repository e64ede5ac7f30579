"""The scoring job: nested DNS messages -> flagged messages / alert groups.

Plan shape (each step is lazy unless noted; "materialised" steps write a thin
table to the shared checkpoint folder and measure it, which both cuts lineage
and sizes the table before it is broadcast):

1. ``prepare``: responses only (pushed into the Parquet scan), one row per
   question, flat keys, registrable domain (broadcast rule lookups, map-side).
2. volume gate: busy groups (partial count -> thin shuffle), materialised;
   joined to the rows without their payload (keys, name, answers).  Under the
   bounds it is broadcast and nothing is shuffled; above them the thin rows are
   shuffled (Spark's runtime bloom filter drops most before that).  Either way
   the same rows are scored.
3. features + model on the gated rows (map-side; the fitted model travels
   with the tasks).  ``fillna(0)`` is applied to the thirteen features.
4. verdict: one aggregate per group (exact distinct count), suspicious groups
   (any non-normal row) and share thresholds as HAVING filters; materialised.
5. flagged rows: the *prepared* rows joined to the alert groups (broadcast) -
   the wide payload is read again with its full schema but never shuffled and
   never passed through the model.  Only the partitions (day, hour) in which an
   alerting group has scored rows are read for it.
"""

from __future__ import annotations

from dataclasses import dataclass
from typing import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunnelscan.config import ScoringConfig
from tunnelscan.functions.idn import ascii_name
from tunnelscan.operators.domains import Suffixes, drop_reverse_lookups, is_forward, registrable_domain, suffix_table
from tunnelscan.operators.features import generate_features
from tunnelscan.operators.gate import counted_gate
from tunnelscan.operators.joins import DEFAULT_BROADCAST_ROWS, Sized, materialise, sized
from tunnelscan.operators.prepare import (
    exclude_answers,
    explode_questions,
    fill_numeric_nulls,
    flatten_message,
    successful_responses,
    with_answer_data,
)
from tunnelscan.operators.verdict import (
    alerting_groups,
    distinct_messages as distinct_outputs,
    group_stats,
    interval_stats,
    join_alerts,
    output_messages,
    with_alert_id,
    with_indicators,
    with_label_str,
)
from tunnelscan.schemas import FEATURE_COLUMNS, KEYS, PARTITION_COLUMNS

Labeler = Callable[[DataFrame], DataFrame]


def model_labeler(model) -> Labeler:
    """Wrap a fitted PipelineModel (assembler + classifier)."""
    return lambda df: model.transform(df)


def prepare(messages: DataFrame, rules: DataFrame | Suffixes | None = None, fallback_last_label: bool | None = None,
            preserve_case: bool = False, ascii_names: bool = False) -> DataFrame:
    """Responses -> question rows with ``QNAME``, ``ts_sec``, ``srcIP``,
    ``destIP``, ``2ld`` (O-11, O-12, O-13, O-14); the domain options are those
    of ``registrable_domain``.  ``ascii_names`` codes names in Unicode, so that
    both spellings of a name are one name, of one domain."""
    rows = flatten_message(explode_questions(successful_responses(messages)))
    if ascii_names:
        rows = rows.withColumn("QNAME", ascii_name(F.col("QNAME")))
    return registrable_domain(rows, "QNAME", rules, "2ld", fallback_last_label, preserve_case)


def featurise(rows: DataFrame, cfg: ScoringConfig, apply_exclusions: bool = False) -> DataFrame:
    """O-16, O-17 (or O-19), O-41..O-53, O-18."""
    out = rows.withColumn("lld", F.col("2ld"))
    if apply_exclusions:
        out = exclude_answers(out, cfg.excluded_rtypes, cfg.excluded_rdata)
    else:
        out = with_answer_data(out)
    out = generate_features(out, "QNAME", "lld", "RDATA", rdata_mode="array")
    return fill_numeric_nulls(out, 0, subset=FEATURE_COLUMNS)


@dataclass
class ScoringResult:
    prepared: DataFrame        # all question rows with keys and 2ld
    candidates: DataFrame      # non-reverse rows (input of the gate)
    busy: DataFrame            # busy groups with their count (materialised)
    scored: DataFrame          # gated rows with features, prediction, label_str, indicators
    stats: DataFrame           # suspicious groups with O-34..O-38 (materialised)
    alerts: DataFrame          # alerting groups + alert_id (subset of stats)
    flagged: DataFrame         # prepared rows of alerting groups + group columns
    flagged_scored: DataFrame  # scored rows of alerting groups: features, prediction, label_str, count
    output: DataFrame          # key, payload
    keys: tuple = KEYS
    seen: dict | None = None   # row counts from the gate's job
    hours: list | None = None  # partitions that hold alerting groups, where known

    def counts(self) -> DataFrame:
        """O-40: rows or groups at each stage, as (stage, rows).

        No pass over the input: the first ones come from the gate's job,
        the later stages are sums over the materialised group tables."""
        rows = self.alerts.sparkSession.range(1).select(*[F.lit(n).alias(c) for c, n in self.seen.items()])

        def total(df: DataFrame, name: str) -> DataFrame:
            return df.agg(F.coalesce(F.sum("count"), F.lit(0)).alias(name))

        flagged = self.busy.join(self.alerts.select(*self.keys), list(self.keys), "left_semi")
        parts = [rows, total(self.busy, "scored_rows"),
                 self.stats.agg(F.count(F.lit(1)).alias("suspicious_groups")),
                 self.alerts.agg(F.count(F.lit(1)).alias("alert_groups")), total(flagged, "flagged_rows")]
        out = None
        for df in parts:
            one = df.select(F.inline(F.array(*[F.struct(F.lit(c).alias("stage"), F.col(c).cast("long").alias("rows"))
                                               for c in df.columns])))
            out = one if out is None else out.unionByName(one)
        return out

    def unlabelled(self) -> DataFrame:
        """D14: scored rows whose prediction has no class name (counted as
        neither normal nor tunnel)."""
        return self.scored.where(F.col("label_str").isNull())


# Partitions named one by one to the scan of the flagged rows, at most.
MAX_HOURS = 10_000


def _hour_columns(messages: DataFrame) -> list[str]:
    return [c for c in PARTITION_COLUMNS if c in messages.columns]


def _hour_values(columns: Sequence[str]) -> list:
    """The partition of a row as texts; a NULL value is an empty one."""
    return [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns]


def in_hours(messages: DataFrame, hours: Sequence[tuple]) -> DataFrame:
    """Messages of the named partitions, (``datestr``, ``hour``).

    Each condition is over partition columns alone, so the scan prunes by it."""
    values = _hour_values(_hour_columns(messages))
    names = sorted({"/".join(h) for h in hours})
    return messages.where(values[0].isin(sorted({h[0] for h in hours})) & F.concat_ws("/", *values).isin(names))


def score(messages: DataFrame, labeler: Labeler, cfg: ScoringConfig | None = None,
          rules: DataFrame | None = None, alert_id: str = "constant",
          apply_exclusions: bool = False, approx_distinct: bool = False, distinct_messages: bool = False,
          with_intervals: bool = False, keys: Sequence[str] = KEYS,
          max_broadcast_rows: int = DEFAULT_BROADCAST_ROWS, fallback_last_label: bool | None = None,
          preserve_case: bool = False, ascii_names: bool = False, prune_hours: bool = True) -> ScoringResult:
    """Score DNS messages.

    The busy-group table is broadcast where it fits the bounds
    (``max_broadcast_rows`` and the bytes of ``operators.joins``) and joined
    with a shuffle of the thin rows otherwise; the scored rows, groups and
    flagged messages are the same.

    ``rules``, ``fallback_last_label``, ``preserve_case``, ``ascii_names``: see
    ``prepare``.  Rows without a domain leave at the reverse-lookup
    filter (D9); ``counts()`` reports them as ``undomained_rows``.

    ``with_intervals`` adds ``max_interval_time`` and ``average_interval_time``
    (O-39, dormant in the reference's group aggregate) to the group table; they
    come from the gated rows, before features and model.

    ``distinct_messages`` (D12): a message with n questions in alerting groups
    is written n times, as the reference does; True writes equal messages once.

    ``prune_hours``: messages with the partition columns ``datestr`` and ``hour`` are
    read again for the flagged rows only in the partitions of alerting groups.
    """
    cfg = cfg or ScoringConfig()
    suffixes = suffix_table(messages.sparkSession, rules)
    prepared = prepare(messages, suffixes, fallback_last_label, preserve_case, ascii_names)
    candidates = drop_reverse_lookups(prepared, "2ld")
    busy, seen = counted_gate(prepared, cfg.min_group_count, is_forward("2ld"), F.col("2ld").isNull(), keys)
    hour_columns = _hour_columns(messages) if prune_hours else []
    # Of the payload only the answers go on: they may be shuffled.
    thin = candidates.select(*dict.fromkeys(["key", "QNAME", "ts_sec", "srcIP", "destIP", "2ld", *keys, *hour_columns]),
                             F.struct(F.col("payload.answers").alias("answers")).alias("payload"))
    gated = thin.join(busy.for_join(max_broadcast_rows), list(keys), "inner")
    scored = with_indicators(with_label_str(labeler(featurise(gated, cfg, apply_exclusions))))
    hours_of = [F.collect_set(F.array(*_hour_values(hour_columns))).alias("__hours")] if hour_columns else []
    stats = group_stats(scored, keys, approx_distinct, extra=hours_of)
    if with_intervals:
        stats = stats.join(interval_stats(gated, keys), list(keys), "left")
    suspicious = materialise(stats.where(F.col("tunnel_count") > 0)).df
    # Alerts filter the checkpointed table: the lineage is already cut, so
    # measuring them (not another checkpoint) sizes them for the broadcast.
    alerts = sized(with_alert_id(alerting_groups(suspicious, cfg), alert_id, keys))
    hours = None
    if hour_columns:
        found = alerts.df.select(F.explode("__hours").alias("h")).distinct().limit(MAX_HOURS + 1).collect()
        hours = sorted(tuple(r["h"]) for r in found) if len(found) <= MAX_HOURS else None
        suspicious = suspicious.drop("__hours")
        alerts = Sized(alerts.df.drop("__hours"), alerts.rows, alerts.size)
    read_again = candidates
    if hours is not None:
        again = prepare(in_hours(messages, hours), suffixes, fallback_last_label, preserve_case, ascii_names)
        read_again = drop_reverse_lookups(again, "2ld")
    flagged = join_alerts(read_again, alerts, keys, max_broadcast_rows)
    group_only = [c for c in alerts.df.columns if c not in scored.columns or c in keys]
    flagged_scored = join_alerts(scored, Sized(alerts.df.select(*group_only), alerts.rows, alerts.size), keys,
                                 max_broadcast_rows)
    output = output_messages(flagged)
    if distinct_messages:
        output = distinct_outputs(output)
    return ScoringResult(prepared, candidates, busy.df, scored, suspicious, alerts.df, flagged, flagged_scored, output,
                         tuple(keys), seen, hours)


def run_scoring_job(spark, input_path: str, model_path: str, config_path: str | None = None,
                    output_path: str | None = None, kafka_topic: str | None = None,
                    kafka_brokers: str | None = None, alert_format: bool = False,
                    datestr: str | None = None, hour: str | None = None, rules: DataFrame | None = None,
                    mode: str = "error", base_path: str | None = None, ip_info: DataFrame | None = None,
                    alert_timestamp_sec: int | None = None, engine_name: str | None = None,
                    **score_options) -> ScoringResult:
    """The scoring job with the reference's options as parameters.

    ``rules`` is the public-suffix table (``read_suffix_rules``); without it the
    short built-in list is used with its last-label fallback.  ``ip_info``,
    ``alert_timestamp_sec`` and ``engine_name`` go into the alert records.

    Kafka needs both topic and brokers (or neither); at least one sink must be
    given.  The sink is chosen by which option is given (D15): Kafka gets the
    alert records, a path gets the flagged messages (or the alert table when
    ``alert_format``).
    """
    from tunnelscan.operators.alerts import ENGINE_NAME, alert_table
    from tunnelscan.operators.model import load_model
    from tunnelscan.sources.readers import load_config, read_dns_log
    from tunnelscan.sources.sinks import write_alerts, write_messages, write_to_kafka

    if bool(kafka_topic) != bool(kafka_brokers):
        raise ValueError("give both kafka_topic and kafka_brokers, or neither")
    if not (kafka_topic or output_path):
        raise ValueError("no output path or topic given")
    cfg = load_config(config_path, spark)
    model = load_model(model_path)
    logs = read_dns_log(spark, input_path, datestr=datestr, hour=hour, base_path=base_path)
    result = score(logs, model_labeler(model), cfg, rules=rules, **score_options)
    def alerts() -> DataFrame:
        # The addresses of flagged rows are keys of their groups.
        sides = {"srcIP", "destIP"} <= set(result.keys)
        addresses = result.alerts.select(F.explode(F.array("srcIP", "destIP")).alias("ip")) if sides else None
        return alert_table(result.flagged, ip_info, alert_timestamp_sec, engine_name or ENGINE_NAME, addresses)

    if kafka_topic:
        write_to_kafka(alerts(), kafka_topic, kafka_brokers)
    elif alert_format:
        write_alerts(alerts(), output_path, mode=mode)
    else:
        write_messages(result.output, output_path, mode=mode)
    return result
