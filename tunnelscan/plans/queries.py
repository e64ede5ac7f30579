"""Registered queries: one per operator group of SURVEY section 2.

Each takes ``(spark, sf_dir)`` and returns a DataFrame computed by Spark from
the driver's tables (or from data Spark derived from them and wrote to the
shared checkpoint folder).  ``tunnelscan.plans.oracle`` holds the DuckDB twin
of every query that SQL can express; model queries have none.
"""

from __future__ import annotations

import hashlib
import inspect
import json
import uuid
from typing import Callable

from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunnelscan.config import ScoringConfig
from tunnelscan.functions import entropy_arrow, lexical
from tunnelscan.functions.idn import ascii_name
from tunnelscan.functions.lexical import answer_features, char_answer_features, subdomain, digit_count
from tunnelscan.functions.labels import label_index
from tunnelscan.operators import alerts as alert_ops
from tunnelscan.operators import domains, features, prepare
from tunnelscan.operators import model as model_ops
from tunnelscan.operators.domains import drop_reverse_lookups
from tunnelscan.operators.gate import volume_gate
from tunnelscan.operators.prepare import (
    clean_training_sample,
    exclude_answers,
    explode_questions,
    fill_numeric_nulls,
    flatten_message,
    successful_responses,
    with_answer_data,
)
from tunnelscan.operators.verdict import (
    interval_stats,
    suspicious_rows,
    with_indicators,
    with_label_str,
)
from tunnelscan.plans import fixtures, merging, oracle, scoring, training
from tunnelscan.schemas import ANSWER_FEATURES, FEATURE_COLUMNS, KEYS, NAME_FEATURES
from tunnelscan.session import fingerprint, path_exists, publish, shared_path
from tunnelscan.sources.readers import load_config, read_training_sample
from tunnelscan.sources.sinks import kafka_records, write_alerts, write_messages

FIXTURE_CONFIG = ScoringConfig(min_group_count=oracle.MIN_GROUP_COUNT,
                               min_unique_qname_share=oracle.MIN_UNIQUE_SHARE,
                               min_tunnel_share=oracle.MIN_TUNNEL_SHARE)

Query = Callable[[SparkSession, str], DataFrame]


def _messages(spark: SparkSession, sf: str) -> DataFrame:
    return fixtures.read_staged_dns_log(spark, sf)


def _stand_in(df: DataFrame) -> DataFrame:
    return df.withColumn("prediction", fixtures.stand_in_prediction(F.col("QNAME")))


def _score(spark: SparkSession, sf: str, **kw) -> scoring.ScoringResult:
    return scoring.score(_messages(spark, sf), _stand_in, FIXTURE_CONFIG, **kw)


def _rounded(df: DataFrame, cols, digits: int = 6) -> list:
    out = []
    for c in cols:
        dt = df.schema[c].dataType
        out.append(F.round(F.col(f"`{c}`"), digits).alias(c) if isinstance(dt, T.DoubleType)
                   else F.col(f"`{c}`"))
    return out


def _candidates(spark: SparkSession, sf: str) -> DataFrame:
    return drop_reverse_lookups(scoring.prepare(_messages(spark, sf)), "2ld")


def _sample(spark: SparkSession, sf: str) -> DataFrame:
    return read_training_sample(spark, fixtures.stage_training_csv(spark, sf))


# ---- sources, projections, domains, features ------------------------------

def responses_exploded(spark: SparkSession, sf: str) -> DataFrame:
    """O-02, O-11, O-12, O-13."""
    rows = flatten_message(explode_questions(successful_responses(_messages(spark, sf))))
    return rows.select("key", "QNAME", "ts_sec", "srcIP", "destIP", "datestr", "hour")


def registrable_domain(spark: SparkSession, sf: str) -> DataFrame:
    """O-14, O-15."""
    return _candidates(spark, sf).select("key", "QNAME", "2ld")


# Endings of the names of ``registrable_domain_idn``, by event_id modulo their number, and
# the suffix list it is judged by.
IDN_ENDINGS = ("shop.公司.cn", "shop.xn--55qx5d.cn.", "SHOP.XN--55QX5D.CN", "公司.cn", "почта.рф", "a.xn--p1ai.",
               "a.b.川崎.jp", "a.city.xn--8ltrs.jp.", "me.blogspot.com", "例え.com", "blogspot.com.", "www。例え。com",
               "plain.example.cn", "no.such.ending")
IDN_RULES = """// a list with marks
// ===BEGIN ICANN DOMAINS===
com
cn
公司.cn
рф
jp
*.川崎.jp
!city.川崎.jp
// ===END ICANN DOMAINS===
// ===BEGIN PRIVATE DOMAINS===
blogspot.com   // sites of users
// ===END PRIVATE DOMAINS===
"""


def registrable_domain_idn(spark: SparkSession, sf: str) -> DataFrame:
    """O-14 with internationalised rules and names: the domain by all rules, by
    those outside the private section, and of the coded name."""
    path = shared_path(spark, "out", f"suffixes_{_run_id(spark, sf)}")
    spark.createDataFrame([(IDN_RULES,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    ending = F.element_at(F.array(*map(F.lit, IDN_ENDINGS)), (F.pmod("event_id", F.lit(len(IDN_ENDINGS))) + 1).cast("int"))
    names = spark.read.parquet(f"{sf}/events.parquet").select(
        F.col("event_id").cast("string").alias("key"),
        F.concat(F.lit("u"), F.substring(F.md5(F.col("event_id").cast("string")), 1, 6), F.lit("."), ending).alias("QNAME"))
    rules, icann = (domains.read_suffix_rules(spark, path, private) for private in (True, False))
    out = domains.registrable_domain(names, "QNAME", rules, "domain")
    out = domains.registrable_domain(out, "QNAME", icann, "icann_domain")
    out = domains.registrable_domain(out.withColumn("coded", ascii_name(F.col("QNAME"))), "coded", rules, "ascii_domain")
    return out.select("key", "QNAME", "domain", "icann_domain", "ascii_domain")


def subdomain_features(spark: SparkSession, sf: str) -> DataFrame:
    """O-16, O-41..O-48."""
    from tunnelscan.operators.features import generate_features
    rows = with_answer_data(_candidates(spark, sf).withColumn("lld", F.col("2ld")))
    feats = generate_features(rows, "QNAME", "lld", "RDATA")
    return feats.select("key", "QNAME", "lld", *_rounded(feats, NAME_FEATURES))


def answer_features_q(spark: SparkSession, sf: str) -> DataFrame:
    """O-17, O-49..O-53, O-18."""
    rows = with_answer_data(flatten_message(explode_questions(successful_responses(_messages(spark, sf)))))
    feats = answer_features(F.col("RDATA"))
    out = fill_numeric_nulls(rows.select("key", "QNAME", *[feats[c].alias(c) for c in ANSWER_FEATURES]), 0,
                             ANSWER_FEATURES)
    return out.select("key", "QNAME", *_rounded(out, ANSWER_FEATURES))


def answer_features_chars(spark: SparkSession, sf: str) -> DataFrame:
    """D4 ``chars`` mode on the training sample's RDATA strings."""
    clean = clean_training_sample(_sample(spark, sf))
    feats = char_answer_features(F.col("RDATA"))
    out = clean.select("QNAME", "RDATA", *[feats[c].alias(c) for c in ANSWER_FEATURES])
    return out.select("QNAME", "RDATA", *_rounded(out, ANSWER_FEATURES))


def answer_exclusion(spark: SparkSession, sf: str) -> DataFrame:
    """O-19 with the default exclusion lists."""
    cfg = ScoringConfig()
    out = exclude_answers(_messages(spark, sf), cfg.excluded_rtypes, cfg.excluded_rdata, out_col="kept")
    return out.select("key", F.array_join("kept", "|").alias("kept_rdata"),
                      F.coalesce(F.size("kept"), F.lit(-1)).cast("int").alias("kept_count"))


def training_features_q(spark: SparkSession, sf: str) -> DataFrame:
    """Training path: O-08..O-10, O-14 as ``lld`` on every sample name,
    O-41..O-53 with RDATA split on the sample's delimiter."""
    feats = _training_features(spark, sf)
    for c in ("subdomain_length", "label_count"):   # NULL for a name without a domain
        feats = feats.withColumn(c, F.col(c).cast("double"))
    return feats.select("QNAME", "RDATA", "lld", *_rounded(feats, FEATURE_COLUMNS))


def document_answer_features(spark: SparkSession, sf: str) -> DataFrame:
    """O-49..O-53 on long, non-ASCII answer data: every line of every whole
    document is one answer item."""
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", F.split("text", "\n", -1).alias("arr"))
    feats = answer_features(F.col("arr"), "arrow")
    out = docs.select("doc_id", *[feats[c].alias(c) for c in ANSWER_FEATURES])
    return out.select("doc_id", *_rounded(out, ANSWER_FEATURES))


def answer_features_excluded(spark: SparkSession, sf: str) -> DataFrame:
    """O-19 then O-49..O-53, O-18: the scoring path with ``apply_exclusions``
    (answers of excluded record types or holding an excluded substring are
    dropped before the answer features)."""
    rows = flatten_message(explode_questions(successful_responses(_messages(spark, sf))))
    cfg = ScoringConfig()
    rows = exclude_answers(rows, cfg.excluded_rtypes, cfg.excluded_rdata)
    feats = answer_features(F.col("RDATA"))
    out = fill_numeric_nulls(rows.select("key", "QNAME", *[feats[c].alias(c) for c in ANSWER_FEATURES]), 0,
                             ANSWER_FEATURES)
    return out.select("key", "QNAME", *_rounded(out, ANSWER_FEATURES))


def csv_clean_labels(spark: SparkSession, sf: str) -> DataFrame:
    """O-01, O-08, O-09, O-10, O-20."""
    return clean_training_sample(_sample(spark, sf)).select("QNAME", "RDATA", "DnsTunnel", "src", "label")


# ---- gate and verdict -------------------------------------------------------

def volume_gate_q(spark: SparkSession, sf: str) -> DataFrame:
    """O-28, O-31, O-32 (count threshold chosen to split the stand-in groups)."""
    gated = volume_gate(_candidates(spark, sf), oracle.GATE_QUERY_MIN_COUNT)
    return gated.select("key", "QNAME", "srcIP", "destIP", "2ld", F.col("count").cast("long").alias("count"))


def suspicious_groups(spark: SparkSession, sf: str) -> DataFrame:
    """O-21, O-22, O-23, O-29, O-33 with a four-valued stand-in prediction
    (3.0 has no class name, so its label is NULL)."""
    gated = volume_gate(_candidates(spark, sf), FIXTURE_CONFIG.min_group_count)
    n = F.length("QNAME")
    pred = gated.withColumn("prediction", F.when(n > 50, 1.0).when(n > 45, 2.0)
                            .when(F.pmod(F.col("ts_sec"), F.lit(97)) == 0, 3.0).otherwise(0.0))
    rows = with_indicators(suspicious_rows(with_label_str(pred)))
    return rows.select("key", "QNAME", "srcIP", "destIP", "2ld", "label_str", "normal", "tunnel")


def group_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """O-24, O-34..O-38."""
    alerts = _score(spark, sf).alerts
    cols = [*KEYS, "unique_QNAME_count", "2ld_count", "normal_count", "tunnel_count",
            "unique_QNAME_perc", "tunnel_perc"]
    return alerts.select(*_rounded(alerts, cols))


def merged_verdict(spark: SparkSession, sf: str) -> DataFrame:
    """O-24, O-31..O-39 merged from 24 partial tables, one for each hour of the day,
    written in two runs."""
    msgs, root = _messages(spark, sf), shared_path(spark, "out", f"states_{_run_id(spark, sf)}")
    for part in (F.col("hour") < "12", F.col("hour") >= "12"):
        merging.write_states(msgs.where(part), _stand_in, FIXTURE_CONFIG, root, periods=("hour",))
    out = merging.merged_verdict(spark, root, FIXTURE_CONFIG)
    return out.select(*_rounded(out, out.columns))


def flagged_messages(spark: SparkSession, sf: str) -> DataFrame:
    """O-25, O-27, O-30 and the O-03 Parquet round trip."""
    out_path = shared_path(spark, "out", f"flagged_{_run_id(spark, sf)}")
    write_messages(_score(spark, sf).output, out_path, mode="overwrite")
    back = spark.read.parquet(out_path)
    # The payload fields that no schema here declares are still there.
    return back.select("key", fixtures.first_question().alias("name"),
                       F.col("payload.header.id").alias("message_id"), "payload.authority",
                       F.col("payload.ip.srcIP").alias("srcIP"), F.col("payload.ip.destIP").alias("destIP"),
                       F.col("payload.pcap.ts_sec").alias("ts_sec"),
                       F.coalesce(F.size("payload.answers"), F.lit(-1)).cast("int").alias("n_answers"))


def _run_id(spark: SparkSession, sf: str) -> str:
    """One output folder for each application and input: a second call replaces it."""
    return fingerprint(spark, f"{sf}/events.parquet", salt=f"{sf}|{spark.sparkContext.applicationId}")


def alerts_written(spark: SparkSession, sf: str) -> DataFrame:
    """O-04: the alert table written by day and hour, and read back."""
    flagged = _score(spark, sf).flagged
    table = alert_ops.alert_table(flagged).withColumn("key", F.get_json_object("telemetry_details", "$.header.id"))
    out_path = shared_path(spark, "out", f"alerts_{_run_id(spark, sf)}")
    write_alerts(table, out_path, mode="overwrite")
    back = spark.read.schema(table.schema).parquet(out_path)
    return back.select("key", "alert_timestamp_sec", "src_ip", "ioc", "datestr", "hour")


def alert_ids(spark: SparkSession, sf: str) -> DataFrame:
    """O-26: deterministic per-group ids (md5-based, SQL-checkable)."""
    return _score(spark, sf, alert_id="hash").alerts.select(*KEYS, "alert_id")


def verdict_from_config(spark: SparkSession, sf: str) -> DataFrame:
    """O-07: the verdict under thresholds written to a config file and read back."""
    path = shared_path(spark, "out", f"config_{_run_id(spark, sf)}")
    text = json.dumps(FIXTURE_CONFIG.with_(**oracle.FILE_CONFIG).to_dict())
    spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(path)
    cfg = load_config(path, spark)
    alerts = scoring.score(_messages(spark, sf), _stand_in, cfg).alerts
    return alerts.select(*KEYS, "2ld_count", "tunnel_count")


def assembled_features(spark: SparkSession, sf: str) -> DataFrame:
    """O-61: the elements of the feature vector by name; a row with a NULL
    feature (an undomained name, an empty answer item) has no vector."""
    rows = model_ops.assembler().transform(_training_features(spark, sf))
    vector = vector_to_array("features")
    return rows.select("QNAME", "RDATA", *[F.round(vector[k], 6).alias(c) for k, c in enumerate(FEATURE_COLUMNS)])


def interval_stats_q(spark: SparkSession, sf: str) -> DataFrame:
    """O-39 over the gated rows."""
    gated = volume_gate(_candidates(spark, sf), FIXTURE_CONFIG.min_group_count)
    out = interval_stats(gated)
    return out.select(*_rounded(out, out.columns))


def row_counts(spark: SparkSession, sf: str) -> DataFrame:
    """O-40."""
    return _score(spark, sf).counts()


# ---- alerts -----------------------------------------------------------------

def alert_table_q(spark: SparkSession, sf: str) -> DataFrame:
    """O-54, O-55, O-57, O-58: the full 36-column alert table (no address
    table given, so the enrichment columns are NULL / false)."""
    return alert_ops.alert_table(_score(spark, sf).flagged)


def ip_info_from_customers(spark: SparkSession, sf: str) -> DataFrame:
    """An address-attribute table derived from ``customer`` (stand-in for a
    user's asset inventory): many rows for each address."""
    cust = spark.read.parquet(f"{sf}/customer.parquet")
    ip = F.concat(F.lit("10.0.0."), F.pmod(F.col("c_custkey"), F.lit(16)).cast("string"))
    return cust.select(ip.alias("ip"), F.col("c_name").alias("enrich"), (F.col("c_acctbal") < 0).alias("is_malicious"))


def alert_enriched(spark: SparkSession, sf: str) -> DataFrame:
    """O-56."""
    fields = alert_ops.enrich(alert_ops.alert_fields(_score(spark, sf).flagged),
                              ip_info_from_customers(spark, sf))
    return fields.select("key", "src_ip", "dest_ip", "org_ip", "org_ip_enrich", "org_is_malicious",
                         "src_ip_enrich", "dest_ip_enrich")


def networks_from_customers(spark: SparkSession, sf: str) -> DataFrame:
    """Overlapping networks of both families, and some that cannot be read."""
    k = F.col("c_custkey")
    low = F.pmod(k, F.lit(16)).cast("string")
    forms = [F.concat(F.lit("10.0.0."), low, F.lit("/32")), F.concat(F.lit("10.0.0."), low, F.lit("/30")), F.lit("10.0.0.0/8"),
             F.concat(F.lit("2001:db8::"), low), F.concat(F.lit("2001:0DB8:0::/"), (32 + 16 * F.pmod(k, F.lit(3))).cast("string")),
             F.concat(F.lit("192.0.2.63/"), (24 + F.pmod(k, F.lit(7))).cast("string")), F.lit("198.51.100.7"), F.lit("0.0.0.0/0"),
             F.lit("10.0.0.1/33"), F.lit("2001:db8::1::/64")]
    network = F.element_at(F.array(*forms), (F.pmod(k, F.lit(len(forms))) + 1).cast("int"))
    cust = spark.read.parquet(f"{sf}/customer.parquet")
    return cust.select(network.alias("ip"), F.col("c_name").alias("enrich"), (F.col("c_acctbal") < 0).alias("is_malicious"))


def flow_networks(spark: SparkSession, sf: str) -> DataFrame:
    """O-56 by network: every flow with the most specific network of each side."""
    ip = F.col("payload.ip")
    flows = _messages(spark, sf).groupBy(ip["srcIP"].alias("src_ip"), ip["destIP"].alias("dest_ip")).count()
    return alert_ops.enrich(flows.withColumnRenamed("count", "messages"), networks_from_customers(spark, sf))


def kafka_records_q(spark: SparkSession, sf: str) -> DataFrame:
    """O-59 projection (the Kafka connector itself is not installed)."""
    return kafka_records(alert_ops.alert_table(_score(spark, sf).flagged))


# ---- model ------------------------------------------------------------------

# Partitions of the training sample in the fixture queries: Spark's shuffle
# partitions, so they grow with the cluster.
def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _training_features(spark: SparkSession, sf: str) -> DataFrame:
    return training.training_features(_sample(spark, sf), rdata_mode="array",
                                      delimiter=fixtures.RDATA_DELIMITER)


def _split(spark: SparkSession, sf: str):
    feats = _training_features(spark, sf)
    return model_ops.split_train_test(feats)


# What the fits and their evaluation read of a training row.
_FITTED = ["QNAME", "RDATA", "label", *FEATURE_COLUMNS]


def _staged_split(spark: SparkSession, sf: str):
    """``_split`` of features that are computed once, for the train and the test rows.

    Without that the assembler's filter for missing features computes all of them
    once more, and every classifier's test rows do so again."""
    return model_ops.split_train_test(_training_features(spark, sf).select(*_FITTED).checkpoint(eager=True))


def _dealt(spark: SparkSession, train_df: DataFrame) -> DataFrame:
    return train_df.repartition(_partitions(spark), "QNAME").checkpoint(eager=True)


def _model_path(spark: SparkSession, sf: str) -> str:
    code = "".join(inspect.getsource(m) for m in (model_ops, training, lexical, entropy_arrow, features, domains, prepare))
    fp = fingerprint(spark, f"{sf}/events.parquet", f"{sf}/pages.parquet", f"{sf}/labels.parquet",
                     salt=fixtures.VIEW_VERSION + hashlib.sha256(code.encode()).hexdigest())
    return shared_path(spark, "staged", f"rf_{fp}")


def staged_model(spark: SparkSession, sf: str, train_df: DataFrame | None = None):
    """Train once per input and code (O-60..O-63), save (O-05) and load (O-06).

    ``train_df``: the train rows of ``_split``, where the caller has them."""
    final = _model_path(spark, sf)
    if not path_exists(spark, f"{final}/metadata"):
        if train_df is None:
            train_df = _split(spark, sf)[0].select(*_FITTED)
        fitted = model_ops.fit_pipeline(_dealt(spark, train_df))
        tmp = f"{final}.{uuid.uuid4().hex}.tmp"
        fitted.write().save(tmp)
        publish(spark, tmp, final)
    return model_ops.load_model(final)


def _held_out_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """``label``, ``rawPrediction`` and ``prediction`` of the hold-out rows by the
    staged model.  The features of all rows are computed once where it is to be
    trained, and those of the hold-out rows alone where it is there."""
    if path_exists(spark, f"{_model_path(spark, sf)}/metadata"):
        train_df, test_df = None, _split(spark, sf)[1].select(*_FITTED).checkpoint(eager=True)
    else:
        train_df, test_df = _staged_split(spark, sf)
    pred = staged_model(spark, sf, train_df).transform(test_df)
    return pred.select("label", "rawPrediction", "prediction").checkpoint(eager=True)


def rf_predictions(spark: SparkSession, sf: str) -> DataFrame:
    """O-64 on the scoring rows, then O-21 (rows only)."""
    model = staged_model(spark, sf)
    feats = scoring.featurise(_candidates(spark, sf), FIXTURE_CONFIG)
    return with_label_str(model.transform(feats)).select("key", "QNAME", "2ld", "prediction", "label_str")


def training_counts(spark: SparkSession, sf: str) -> DataFrame:
    """O-40 / O-60 on the training path: sample rows read, rows left after
    cleaning and features, and the hash split into train / test rows."""
    sample = _sample(spark, sf)
    feats = training.training_features(sample, rdata_mode="array", delimiter=fixtures.RDATA_DELIMITER)
    # One pass over the cleaned rows for all counts but the first.
    bucket = model_ops.split_bucket()
    rest = feats.agg(F.count(F.lit(1)).alias("feature_rows"), F.count_if(F.col("lld").isNull()).alias("undomained_rows"),
                     F.count_if(bucket < 800).alias("train_rows"), F.count_if(bucket >= 800).alias("test_rows"))
    out = sample.agg(F.count(F.lit(1)).alias("rows")).select(F.lit("sample_rows").alias("stage"), "rows")
    return out.unionByName(rest.select(F.inline(F.array(*[
        F.struct(F.lit(c).alias("stage"), F.col(c).alias("rows")) for c in rest.columns]))))


def rf_scoring_job(spark: SparkSession, sf: str) -> DataFrame:
    """The scoring job end to end with the trained forest as labeler (O-64
    inside the job): alerting groups with their aggregates (rows only)."""
    res = scoring.score(_messages(spark, sf), scoring.model_labeler(staged_model(spark, sf)), FIXTURE_CONFIG)
    cols = [*KEYS, "unique_QNAME_count", "2ld_count", "normal_count", "tunnel_count",
            "unique_QNAME_perc", "tunnel_perc", "alert_id"]
    return res.alerts.select(*_rounded(res.alerts, cols))


def rf_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """O-65, O-66, O-67 on the hold-out split (rows only)."""
    pred = _held_out_predictions(spark, sf)
    values = model_ops.binary_metrics(pred)
    values.update(model_ops.multiclass_metrics(pred).first().asDict())
    schema = T.StructType([T.StructField(k, T.DoubleType()) for k in values])
    return spark.createDataFrame([tuple(float(v) for v in values.values())], schema)


def forest_votes(spark: SparkSession, sf: str) -> DataFrame:
    """O-62..O-64: the hold-out rows scored by the saved and reloaded forest,
    and again by walking its node table with joins; rows, and rows where both
    give the same class."""
    train_df, test_df = _staged_split(spark, sf)
    train_df = _dealt(spark, train_df)
    path = shared_path(spark, "out", f"forest_{_run_id(spark, sf)}")
    model_ops.fit_pipeline(train_df, model_ops.random_forest(num_trees=10, max_depth=5)).write().overwrite().save(path)
    scored = model_ops.load_model(path).transform(test_df).select(
        "QNAME", "RDATA", "prediction", vector_to_array("features").alias("x"))
    # Rows of the same name and answers have the same features.
    scored = scored.groupBy("QNAME", "RDATA").agg(F.count(F.lit(1)).alias("n"), F.first("prediction").alias("prediction"),
                                                  F.first("x").alias("x")).checkpoint(eager=True)
    voted = model_ops.vote(scored, model_ops.tree_nodes(spark, path), ["QNAME", "RDATA"], "x", 5)
    both = scored.join(voted, ["QNAME", "RDATA"])
    return both.agg(F.sum("n").alias("rows"), F.sum(F.when(F.col("vote") == F.col("prediction"), F.col("n")))
                    .alias("agreeing"))


def rf_importances(spark: SparkSession, sf: str) -> DataFrame:
    """O-68 (rows only), of a forest fitted on the sample in this call."""
    train_df = _split(spark, sf)[0].select(*_FITTED)
    train_df = _dealt(spark, train_df)
    return model_ops.feature_importances(spark, model_ops.fit_pipeline(train_df, model_ops.random_forest(num_trees=10)))


def lr_dt_compare(spark: SparkSession, sf: str) -> DataFrame:
    """O-69: the two dormant alternatives on the same split (rows only)."""
    train_df, test_df = _staged_split(spark, sf)
    train_df = _dealt(spark, train_df)
    rows = []
    for name, clf in (("logistic_regression", model_ops.logistic_regression()),
                      ("decision_tree", model_ops.decision_tree())):
        pred = model_ops.fit_pipeline(train_df, clf).transform(test_df).select(
            "label", "rawPrediction", "prediction").checkpoint(eager=True)
        auc = model_ops.binary_metrics(pred)["areaUnderROC"]
        acc = model_ops.multiclass_metrics(pred).first()["accuracy"]
        rows.append((name, float(auc), float(acc)))
    return spark.createDataFrame(rows, "model string, areaUnderROC double, accuracy double")


def lr_optimality(spark: SparkSession, sf: str) -> DataFrame:
    """O-69: the regression is at the optimum of its loss, by feature."""
    train_df = _split(spark, sf)[0].select(*_FITTED)
    train_df = train_df.checkpoint(eager=True)
    fitted = model_ops.fit_pipeline(train_df, model_ops.logistic_regression(max_iter=500, tol=1e-10))
    slopes = model_ops.regression_gradient(fitted, train_df)
    return slopes.select("feature", (F.abs("slope") < 1e-5).alias("at_optimum"))


def rf_importances_check(spark: SparkSession, sf: str) -> DataFrame:
    """O-68: the reported importances agree with the saved forest's node table."""
    train_df = _split(spark, sf)[0].select(*_FITTED)
    train_df = _dealt(spark, train_df)
    path = shared_path(spark, "out", f"importances_{_run_id(spark, sf)}")
    fitted = model_ops.fit_pipeline(train_df, model_ops.random_forest(num_trees=10))
    fitted.write().overwrite().save(path)
    ours = model_ops.importances_from_nodes(model_ops.tree_nodes(spark, path))
    names = F.array(*map(F.lit, FEATURE_COLUMNS))
    ours = ours.select(F.get(names, F.col("feature")).alias("feature"), F.col("importance").alias("ours"))
    both = model_ops.feature_importances(spark, fitted).join(ours, "feature", "left")
    return both.select("feature", (F.abs(F.col("importance") - F.coalesce("ours", F.lit(0.0))) < 1e-9).alias("agrees"))


def forest_separates(spark: SparkSession, sf: str) -> DataFrame:
    """O-62, O-63: with labels that the name decides and no noise, the forest is
    right on nearly all hold-out rows (rows that are constant in SQL, and false
    here for a forest that learns nothing)."""
    sample = _sample(spark, sf).withColumn("DnsTunnel", fixtures.stand_in_label(F.col("QNAME")))
    feats = training.training_features(sample, rdata_mode="array", delimiter=fixtures.RDATA_DELIMITER)
    train_df, test_df = model_ops.split_train_test(feats.checkpoint(eager=True))
    pred = model_ops.fit_pipeline(train_df).transform(test_df)
    metrics = model_ops.multiclass_metrics(pred)
    return metrics.select((F.col("accuracy") >= 0.99).alias("separates"), (F.col("f1") >= 0.99).alias("both_classes"))


def rf_metrics_check(spark: SparkSession, sf: str) -> DataFrame:
    """O-65, O-66 on the forest's own scores: MLlib's areas and those of summed
    score ranges agree."""
    pred = _held_out_predictions(spark, sf)
    theirs = model_ops.binary_metrics(pred)
    ours = model_ops.area_under_curves(pred, vector_to_array("rawPrediction")[1])
    return ours.select(*[(F.abs(F.col(c) - F.lit(float(v))) < 1e-9).alias(f"{c}_agrees") for c, v in theirs.items()])


def auc_ranges(spark: SparkSession, sf: str) -> DataFrame:
    """O-65, O-66 by summed score ranges, on the score of ``auc_metrics``."""
    out = model_ops.area_under_curves(_rule_scores(spark, sf), "rawPrediction")
    return out.select(*_rounded(out, out.columns))


def cv_folds(spark: SparkSession, sf: str) -> DataFrame:
    """O-70: rows and tunnels of each fold of the training rows."""
    train_df, _ = _split(spark, sf)
    return train_df.groupBy(model_ops.fold_of(3).alias("fold")).agg(
        F.count(F.lit(1)).alias("rows"), F.sum("label").cast("long").alias("tunnels"))


def cv_tuning(spark: SparkSession, sf: str) -> DataFrame:
    """O-70: 2-fold cross-validation over forest size and depth (rows only)."""
    train_df = _split(spark, sf)[0].select(*_FITTED)
    train_df = _dealt(spark, train_df)
    cv = model_ops.cross_validate(train_df, num_folds=2)
    rf = cv.bestModel.stages[-1]
    rows = []
    for params, metric in zip(cv.getEstimatorParamMaps(), cv.avgMetrics):
        named = {p.name: v for p, v in params.items()}
        rows.append((int(named["numTrees"]), int(named["maxDepth"]), float(metric)))
    out = spark.createDataFrame(rows, "numTrees int, maxDepth int, areaUnderROC double")
    return out.withColumn("best", (F.col("numTrees") == rf.getNumTrees)
                          & (F.col("maxDepth") == rf.getOrDefault("maxDepth")))


def confusion_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """O-67 on a rule-based prediction (SQL-checkable)."""
    rows = _candidates(spark, sf)
    sub = subdomain("QNAME", "2ld")
    share = F.when(F.length(sub) == 0, 0.0).otherwise(digit_count(sub) / F.length(sub))
    scored = rows.select(label_index(fixtures.stand_in_label(F.col("QNAME"))).cast("double").alias("label"),
                         F.when(share > oracle.CONFUSION_DIGIT_SHARE, 1.0).otherwise(0.0).alias("prediction"))
    out = model_ops.multiclass_metrics(scored)
    return out.select(*_rounded(out, out.columns))


def _rule_scores(spark: SparkSession, sf: str) -> DataFrame:
    """A rule-based score with many ties."""
    sub = subdomain("QNAME", "2ld")
    share = F.when(F.length(sub) == 0, 0.0).otherwise(digit_count(sub) / F.length(sub))
    return _candidates(spark, sf).select(label_index(fixtures.stand_in_label(F.col("QNAME"))).cast("double").alias("label"),
                                         share.alias("rawPrediction"))


def auc_metrics(spark: SparkSession, sf: str) -> DataFrame:
    """O-65, O-66 on a rule-based score with many ties (SQL-checkable)."""
    scored = _rule_scores(spark, sf).checkpoint(eager=True)
    values = model_ops.binary_metrics(scored)
    return spark.createDataFrame([tuple(round(v, 6) for v in values.values())],
                                 ", ".join(f"{k} double" for k in values))


def flagship(spark: SparkSession, sf: str) -> DataFrame:
    """The scoring job end to end: flagged messages (key, payload)."""
    return _score(spark, sf).output


QUERIES: dict[str, Query] = {
    "responses_exploded": responses_exploded,
    "registrable_domain": registrable_domain,
    "registrable_domain_idn": registrable_domain_idn,
    "subdomain_features": subdomain_features,
    "answer_features": answer_features_q,
    "answer_features_chars": answer_features_chars,
    "answer_exclusion": answer_exclusion,
    "answer_features_excluded": answer_features_excluded,
    "csv_clean_labels": csv_clean_labels,
    "training_features": training_features_q,
    "document_answer_features": document_answer_features,
    "volume_gate": volume_gate_q,
    "suspicious_groups": suspicious_groups,
    "group_verdict": group_verdict,
    "merged_verdict": merged_verdict,
    "flagged_messages": flagged_messages,
    "alert_ids": alert_ids,
    "verdict_from_config": verdict_from_config,
    "interval_stats": interval_stats_q,
    "row_counts": row_counts,
    "alert_table": alert_table_q,
    "alert_enriched": alert_enriched,
    "flow_networks": flow_networks,
    "kafka_records": kafka_records_q,
    "alerts_written": alerts_written,
    "confusion_metrics": confusion_metrics,
    "auc_metrics": auc_metrics,
    "rf_predictions": rf_predictions,
    "training_counts": training_counts,
    "assembled_features": assembled_features,
    "rf_scoring_job": rf_scoring_job,
    "rf_metrics": rf_metrics,
    "forest_votes": forest_votes,
    "rf_importances": rf_importances,
    "lr_dt_compare": lr_dt_compare,
    "cv_tuning": cv_tuning,
    "cv_folds": cv_folds,
    "lr_optimality": lr_optimality,
    "rf_importances_check": rf_importances_check,
    "rf_metrics_check": rf_metrics_check,
    "auc_ranges": auc_ranges,
    "forest_separates": forest_separates,
}

__all__ = ["QUERIES", "FIXTURE_CONFIG", "flagship", "FEATURE_COLUMNS"]
