"""A verdict over merged hours (O-24, O-31..O-39): partial states that are written
period by period and added up, so that a day or a month is judged without scoring
its messages again.

``write_states`` scores the messages of some periods once and writes

* ``names``: rows, normal and tunnel rows of every (period, group, name) - the
  distinct names of a group are then the names that any period has;
* ``seconds``: rows of every (period, group, second), from which the gaps between
  messages are found across periods, also where late messages overlap.

Both are partitioned by period, and a period that is written again is replaced, so
late files cost the scoring of their own hour.  ``merged_stats`` gives the same
group table as one pass over all messages.

With ``sketch`` a group's names are an HLL sketch instead, one row for each period and
group; the number of distinct names is then an estimate (about 1.04 / sqrt(2^lg_k)).

All rows are scored here, those of small groups too: whether a group is busy is
only known when its periods are added up.  Plan: the states are partial sums with a
thin shuffle by (group, name) and (group, second), so a hot group is spread over many
tasks; the merge sums them again.
"""

from __future__ import annotations

from typing import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunnelscan.config import ScoringConfig
from tunnelscan.operators.domains import drop_reverse_lookups
from tunnelscan.operators.verdict import alerting_groups, gaps_of_seconds, seconds_of, with_indicators, with_label_str, with_shares
from tunnelscan.plans.scoring import Labeler, featurise, prepare
from tunnelscan.schemas import KEYS, PARTITION_COLUMNS
from tunnelscan.sources.sinks import write_whole

SKETCH_LG_K = 12


def write_states(messages: DataFrame, labeler: Labeler, cfg: ScoringConfig, root: str, rules: DataFrame | None = None,
                 periods: Sequence[str] = PARTITION_COLUMNS, keys: Sequence[str] = KEYS, sketch: bool = False,
                 apply_exclusions: bool = False, **domain_options) -> None:
    """Score ``messages`` and write (or replace) the states of their periods under
    ``root``; ``periods`` are columns of the messages."""
    rows = drop_reverse_lookups(prepare(messages, rules, **domain_options), "2ld")
    for k in keys:
        rows = rows.where(F.col(f"`{k}`").isNotNull())
    thin = rows.select(*dict.fromkeys(["key", "QNAME", "ts_sec", "2ld", *keys, *periods]),
                       F.struct(F.col("payload.answers").alias("answers")).alias("payload"))
    scored = with_indicators(with_label_str(labeler(featurise(thin, cfg, apply_exclusions))))
    sums = [F.count(F.lit(1)).alias("rows"), F.sum("normal").cast("long").alias("normal"), F.sum("tunnel").cast("long").alias("tunnel")]
    if sketch:
        states = scored.groupBy(*periods, *keys).agg(*sums, F.hll_sketch_agg("QNAME", F.lit(SKETCH_LG_K)).alias("names"))
    else:
        states = scored.groupBy(*periods, *keys, "QNAME").agg(*sums)
    _write(states, f"{root}/{'sketches' if sketch else 'names'}", periods)
    _write(seconds_of(thin, [*periods, *keys]), f"{root}/seconds", periods)


def _write(states: DataFrame, path: str, periods: Sequence[str]) -> None:
    write_whole(states.hint("rebalance", *periods), path, "periods", periods)


def _states(spark: SparkSession, path: str, where) -> DataFrame:
    states = spark.read.parquet(path)
    return states if where is None else states.where(where)


def merged_stats(spark: SparkSession, root: str, cfg: ScoringConfig, where=None, keys: Sequence[str] = KEYS,
                 sketch: bool = False, with_intervals: bool = True) -> DataFrame:
    """O-31..O-39 of all periods that ``where`` (a condition on the period columns)
    admits: the busy groups with any tunnel row."""
    sums = [F.sum(c).cast("long").alias(c) for c in ("rows", "normal", "tunnel")]
    if sketch:
        groups = _states(spark, f"{root}/sketches", where).groupBy(*keys).agg(
            *sums, F.hll_sketch_estimate(F.hll_union_agg("names", F.lit(False))).alias("names"))
    else:
        names = _states(spark, f"{root}/names", where).groupBy(*keys, "QNAME").agg(*sums)
        groups = names.groupBy(*keys).agg(*sums, F.count("QNAME").alias("names"))
    groups = groups.where((F.col("rows") >= F.lit(cfg.min_group_count)) & (F.col("tunnel") > 0))
    stats = with_shares(groups.select(*keys, F.col("names").alias("unique_QNAME_count"), F.col("rows").alias("2ld_count"),
                                      F.col("normal").alias("normal_count"), F.col("tunnel").alias("tunnel_count")))
    if with_intervals:
        seconds = _states(spark, f"{root}/seconds", where).groupBy(*keys, "ts_sec").agg(F.sum("__c").alias("__c"))
        stats = stats.join(gaps_of_seconds(seconds, keys), list(keys), "left")
    return stats


def merged_verdict(spark: SparkSession, root: str, cfg: ScoringConfig, **options) -> DataFrame:
    """O-24 over merged periods; the options are those of ``merged_stats``."""
    return alerting_groups(merged_stats(spark, root, cfg, **options), cfg)
