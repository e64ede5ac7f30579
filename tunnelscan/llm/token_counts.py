"""Token counts through a cache of content and tokenizer digests.

1. Every text is normalised as far as its tokenizer does so itself, in the JVM: for
   a tokenizer that drops white space and lower-cases, runs of ASCII white space
   become one blank, none at the ends, and a text of ASCII alone is lower-cased.
   Texts that differ in no more than that have the same tokens and one digest
   (SHA-256).  Texts with a special token's sign keep their letters, and texts with
   other characters too, as composition comes before lower-casing.
2. The distinct digests are joined to the cache, a Parquet table of
   (content digest, version digest, count) under the shared folder.  The version
   digest is of the tokenizer's file, the library's name and its version.
3. One holder of each missing digest is encoded: its words (split at ASCII
   white space, which the tokenizer drops) are made distinct for each Arrow
   batch, and only those not met before in the task go to the library.
4. The new counts are appended to the cache, and documents are joined to it.

An entry stays right: what it depends on is part of its key.  A failed job
appends nothing (Spark commits a write as a whole); two runs at once may append
an entry twice, which the read removes and ``compact`` takes out of the files.

A digest that a third of the documents share is counted with partial aggregates
and met in joins of plain tables, whose hot partitions Spark can split.

Edge cases: a NULL text counts as empty; a text of white space has 0 tokens;
repeated rows and copies, with an id or without, are encoded once; NULL ids are
kept; other columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import importlib.metadata
import json
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tunnelscan.llm.common import as_strings, batch_of, id_text, slices, stage
from tunnelscan.session import hidden_sibling, path_exists, replace_folder, shared_path

MAX_TOKENS = 2048
# Words remembered in a task; the memory starts anew beyond that.
REMEMBERED = 400_000
SLICE = 8 << 20


def file_digest(path: str) -> str:
    with open(path, "rb") as f:
        return hashlib.sha256(f.read()).hexdigest()


def load(data: bytes, kind: str):
    """A function from a list of strings to their token counts."""
    if kind == "model":
        import sentencepiece
        model = sentencepiece.SentencePieceProcessor(model_proto=data)
        return lambda texts: [len(x) for x in model.encode(texts, num_threads=1)]
    import os
    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    from tokenizers import Tokenizer
    model = Tokenizer.from_str(data.decode())
    model.no_truncation()
    model.no_padding()
    return lambda texts: [len(x) for x in model.encode_batch_fast(texts, add_special_tokens=False)]


def version_digest(data: bytes, kind: str) -> str:
    """Digest of the tokenizer's file, its library and the library's version."""
    name = "sentencepiece" if kind == "model" else "tokenizers"
    return hashlib.sha256(data + f"|{name}|{importlib.metadata.version(name)}".encode()).hexdigest()


def lower_cases(data: bytes, kind: str) -> bool:
    """Whether this tokenizer lower-cases what it is given."""
    if kind != "json":
        return False
    spec = json.loads(data).get("normalizer") or {}
    return any(n.get("type") == "Lowercase" for n in spec.get("normalizers", [spec]))


def normalised(text: Column, data: bytes, kind: str) -> Column:
    """The text as far as the tokenizer makes it the same itself."""
    if not splits_at_space(data, kind):
        return text
    plain = F.trim(F.regexp_replace(text, "[ \\t-\\r]+", " "))
    if not lower_cases(data, kind):
        return plain
    ascii_only = (F.octet_length(text) == F.char_length(text)) & ~text.contains("<|")
    return F.when(ascii_only, F.lower(plain)).otherwise(plain)


def splits_at_space(data: bytes, kind: str) -> bool:
    """Whether this tokenizer drops white space, so that the tokens of a text
    are those of its words."""
    if kind != "json":
        return False
    spec = json.loads(data)
    model, pre = spec["model"], spec.get("pre_tokenizer") or {}
    parts = pre.get("pretokenizers", [pre])
    drops = any(p.get("type") == "Split" and p.get("behavior") == "Removed" and p.get("invert") for p in parts)
    return drops and model.get("end_of_word_suffix") is not None


def _encode(model, kind: str, by_word: bool, remembered: int):
    kinds = pa.schema([("digest", pa.binary()), ("n_tokens", pa.int64())])

    def run(batches):
        count = load(model.value, kind)
        known: dict[str, int] = {}
        for batch in batches:
            col = as_strings(batch.column(1))
            out = np.zeros(len(col), dtype=np.int64)
            for a, b in slices(col, SLICE):
                part = col.slice(a, b - a)
                if not by_word:
                    out[a:b] = count(part.to_pylist())
                    continue
                lists = pc.ascii_split_whitespace(part)
                parent = pc.list_parent_indices(lists).to_numpy(zero_copy_only=False)
                coded = pc.dictionary_encode(pc.list_flatten(lists))
                distinct = coded.dictionary.to_pylist()
                if len(known) > remembered:
                    known = {}
                new = [w for w in distinct if w not in known]
                known.update(zip(new, count(new)))
                each = np.fromiter(map(known.__getitem__, distinct), np.int64, len(distinct))
                at = coded.indices.to_numpy(zero_copy_only=False)
                out[a:b] = np.bincount(parent, weights=each[at], minlength=b - a).astype(np.int64)
            yield batch_of(kinds, batch.column(0).cast(pa.binary()), out)
    return run


def token_counts(documents: DataFrame, tokenizer_path: str, cache_path: str, id_col: str = "doc_id",
                 text_col: str = "text", remembered: int = REMEMBERED) -> DataFrame:
    """``doc_id``, ``n_bytes``, ``digest`` and ``n_tokens`` of every document."""
    spark = documents.sparkSession
    kind = tokenizer_path.rpartition(".")[2]
    with open(tokenizer_path, "rb") as f:
        data = f.read()
    version = version_digest(data, kind)
    docs = id_text(documents, id_col, text_col)
    docs = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("raw"))
    docs = docs.withColumn("text", normalised(F.col("raw"), data, kind))
    # A holder is named by its id and digest; rows without an id share one.
    keyed = docs.select("doc_id", "raw", "text", F.unhex(F.sha2("text", 256)).alias("digest"),
                        F.coalesce("doc_id", F.lit(0).cast("long")).alias("holder"))
    thin = stage(keyed.select("doc_id", "holder", "digest", F.octet_length("raw").cast("long").alias("n_bytes")), "tokens")

    holders = thin.groupBy("digest").agg(F.min("holder").alias("holder"))
    if path_exists(spark, cache_path):
        holders = holders.join(_cached(spark, cache_path, version), "digest", "left_anti")
    misses = stage(holders, "token-misses")
    texts = keyed.select("holder", "digest", "text").join(misses, ["holder", "digest"], "left_semi").dropDuplicates(
        ["holder", "digest"])
    model = spark.sparkContext.broadcast(data)
    new = texts.select("digest", "text").mapInArrow(
        _encode(model, kind, splits_at_space(data, kind), remembered), "digest binary, n_tokens long")
    new.withColumn("version", F.lit(version)).write.mode("append").parquet(cache_path)
    counts = stage(thin.select("digest").distinct().join(_cached(spark, cache_path, version), "digest"), "token-counts")
    return thin.drop("holder").join(counts, "digest", "left")


_CACHE = "digest binary, n_tokens long, version string"


def _cached(spark: SparkSession, cache_path: str, version: str) -> DataFrame:
    rows = spark.read.schema(_CACHE).parquet(cache_path)
    return rows.where(F.col("version") == version).groupBy("digest").agg(F.max("n_tokens").alias("n_tokens"))


def compact(spark: SparkSession, cache_path: str) -> None:
    """Write the cache anew: each entry once, in files of a proper size.  The old
    files stay until the new ones are finished; not beside a run that appends."""
    rows = spark.read.schema(_CACHE).parquet(cache_path).groupBy("version", "digest").agg(F.max("n_tokens").alias("n_tokens"))
    tmp = hidden_sibling(cache_path, f"{uuid.uuid4().hex}.tmp")
    rows.select("digest", "n_tokens", "version").hint("rebalance").write.parquet(tmp)
    replace_folder(spark, tmp, cache_path)


def op6_token_counts(documents: DataFrame, tokenizer_path: str, cache_path: str) -> DataFrame:
    out = token_counts(documents, tokenizer_path, cache_path)
    return out.select("doc_id", "n_bytes", "n_tokens", (F.col("n_tokens") > MAX_TOKENS).alias("over_limit"))


def default_cache(spark, sf_dir: str) -> str:
    """One cache for each input folder, under the shared checkpoint folder."""
    return shared_path(spark, "llm", "token-cache-" + hashlib.sha256(sf_dir.encode()).hexdigest()[:16])
