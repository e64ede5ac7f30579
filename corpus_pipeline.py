"""The training-data pipeline: toxicity, near-duplicates, benchmark
contamination, personal data, tokens.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows its
predecessor kept; ``run`` writes each stage's rows under the shared checkpoint
folder, reads them back as the next one's documents and removes them after that.  A stage judges
rows, not ids: rows that share an id are kept or dropped each by its own text.
A row with a NULL id takes part in the stages that look at its text alone; as a
near-duplicate it is never dropped.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunnelscan.llm import decontaminate as _decontaminate
from tunnelscan.llm import minhash as _minhash
from tunnelscan.llm import pieces as _pieces
from tunnelscan.llm import pii as _pii
from tunnelscan.llm import toxicity as _toxicity
from tunnelscan.llm.common import bounded, scratch, stage, table

# Near-duplicates, 24 bytes each, broadcast up to this many.
MAX_BROADCAST = 500_000
# Similarity in percent from which the stage drops a document, and permutations
# for 30 bands: a pair at 0.80 misses all with probability 7e-6.
SIMILAR = 80
PERMUTATIONS = 75


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not toxic."""
    labels = table(spark, sf_dir, "labels")
    model = _toxicity.fit(docs, labels, _toxicity.severity_grade(F.col("quality"), F.col("toxic")))
    return _toxicity.severity(docs, model, whole_rows=True).where(~_toxicity.is_toxic()).select("row.*")


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id."""
    # Rows of the same id and text are of the same group: the two name a document.
    content = F.coalesce(F.unhex(F.md5(F.col("text").cast("binary"))), F.lit(b""))
    found = _minhash.near_duplicates(docs, threshold=SIMILAR, n_permutations=PERMUTATIONS, content=content)
    groups = stage(found.where("doc_id is not null").select(
        "doc_id", "content", "kept", F.coalesce("component", "content").alias("group")), "groups")
    # Several rows of the smallest id: one of them stays.
    first = groups.where("kept").groupBy("doc_id", "group").agg(
        F.count(F.lit(1)).alias("n"), F.min("content").alias("content")).where("n > 1").drop("n")
    first = stage(first, "repeated")
    others = groups.where("kept").join(first.withColumnRenamed("content", "first"), ["doc_id", "group"]).where(
        "content <> first")
    gone = stage(groups.where("not kept").unionByName(others.drop("first")).select("doc_id", "content").distinct(), "gone")
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"),
                       F.col("doc_id").cast("long").alias("doc_id"), content.alias("content"))
    key = ["doc_id", "content"]
    out = rows.join(bounded(gone, MAX_BROADCAST), key, "left_anti")
    if not first.isEmpty():
        again = bounded(first.select(key), MAX_BROADCAST)
        once = out.join(again, key, "left_semi").dropDuplicates(key)
        out = out.join(again, key, "left_anti").unionByName(once)
    return out.select("row.*")


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated."""
    found = _decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"), whole_rows=True)
    return found.where(~_decontaminate.is_contaminated()).select("row.*")


def pseudonymise(spark: SparkSession, docs: DataFrame, sf_dir: str, key: bytes = _pii.DEMO_KEY) -> DataFrame:
    """All documents, personal data in their texts replaced by pseudonyms.

    Who has the key can invert them: the default one is public, for trials only."""
    out = _pii.pseudonymise(docs, key)
    length = F.when(F.col("n_chars").isNotNull(), F.length("text").cast("long"))
    return out.withColumn("n_chars", length)


def tokenize(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Ids of every document and the text decoded from them."""
    return _pieces.encode(docs, public_tokenizers.path("piece_bpe_32k.model"))


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontaminate", decontaminate),
    ("pseudonymise", pseudonymise),
    ("tokenize", tokenize),
]
# The stages fit a model and mix keyed digests: no SQL gives their rows.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str, key: bytes = _pii.DEMO_KEY) -> DataFrame:
    """All stages over ``documents``; ``key`` is that of the pseudonyms.

    A stage's table stays until the next one's is written, the tables within a
    stage until its own is."""
    docs, before = table(spark, sf_dir, "documents"), []
    for name, step in STAGES[:-1]:
        more = {"key": key} if step is pseudonymise else {}
        with scratch(spark) as used:
            docs = stage(step(spark, docs, sf_dir, **more), f"pipeline-{name}")
            own = used.pop()
            used += before
        before = [own]
    return STAGES[-1][1](spark, docs, sf_dir)
