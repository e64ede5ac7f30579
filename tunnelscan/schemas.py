"""Schemas of the inputs, the feature list and the label maps."""

from __future__ import annotations

from pyspark.sql import types as T

KEYS = ("srcIP", "destIP", "2ld")

# Feature names and their order in the model's feature vector.
FEATURE_COLUMNS = (
    "subdomain_length",
    "subdomain_entropy",
    "average_subdomain_length",
    "min_subdomain_length",
    "max_subdomain_length",
    "label_count",
    "subdomain_uppercase_char",
    "subdomain_numeric_char",
    "average_answer_length",
    "max_answer_length",
    "average_answer_uppercase_char",
    "average_answer_numeric_char",
    "average_answer_entropy",
)
NAME_FEATURES = FEATURE_COLUMNS[:8]
ANSWER_FEATURES = FEATURE_COLUMNS[8:]

# Class names and their numeric codes.
TRAIN_LABELS = {"normal": 0, "tunnel": 1}
PREDICTION_LABELS = {0.0: "normal", 1.0: "tunnel", 2.0: "tunnel_keepalive"}

# Training sample: '~'-separated text with a header; every column is a string.
TRAINING_SAMPLE_SCHEMA = T.StructType([
    T.StructField("QNAME", T.StringType()),
    T.StructField("RDATA", T.StringType()),
    T.StructField("DnsTunnel", T.StringType()),
])

HEADER = T.StructType([
    T.StructField("QR", T.BooleanType()),
    T.StructField("responseCode", T.StringType()),
])
QUESTION = T.StructType([T.StructField("name", T.StringType())])
ANSWER = T.StructType([
    T.StructField("rdata", T.StringType()),
    T.StructField("type", T.StringType()),
])
IP = T.StructType([
    T.StructField("srcIP", T.StringType()),
    T.StructField("destIP", T.StringType()),
    T.StructField("srcPort", T.IntegerType()),
    T.StructField("destPort", T.IntegerType()),
    T.StructField("isIPv6", T.BooleanType()),
])
PCAP = T.StructType([
    T.StructField("ts_sec", T.LongType()),
    T.StructField("ts_usec", T.LongType()),
    T.StructField("wirelen", T.LongType()),
])
PAYLOAD = T.StructType([
    T.StructField("header", HEADER),
    T.StructField("questions", T.ArrayType(QUESTION)),
    T.StructField("answers", T.ArrayType(ANSWER)),
    T.StructField("ip", IP),
    T.StructField("pcap", PCAP),
])
DNS_MESSAGE_SCHEMA = T.StructType([
    T.StructField("key", T.StringType()),
    T.StructField("payload", PAYLOAD),
])
# Hive-style partition columns of the hourly DNS table (datestr=yyyyMMdd/hour=HH).
PARTITION_COLUMNS = ("datestr", "hour")
DNS_LOG_SCHEMA = T.StructType(
    DNS_MESSAGE_SCHEMA.fields + [T.StructField(c, T.StringType()) for c in PARTITION_COLUMNS]
)

SUFFIX_RULE_SCHEMA = T.StructType([
    T.StructField("suffix", T.StringType()),
    T.StructField("kind", T.StringType()),
])
