r"""Repeated passages by content-defined chunking.

A gear rolling hash runs over the words of a text (each step shifts the hash and
adds the word's gear value), here limited to the last ``GEAR`` words.  A cut
falls after a word whose hash is smallest among its ``REACH`` neighbours on both
sides, so cuts depend on a few words around them and move with the text when
something is inserted before.  From every cut a variable chunk runs to the first
later cut that makes it ``MIN_WORDS`` long; chunks overlap, so a repeated passage
need not begin where a chunk of the last one ended.  Where words repeat with a
period of up to ``REACH`` no hash is the smallest; there a cut falls after every
``MIN_WORDS`` words, counted from where the repetition begins, so it too moves with
the text.  Chunks with the same digest in more than one document are repeats;
overlapping or adjoining repeats of a document are merged, whichever document
holds them first, and merged runs of ``MIN_RUN`` words or more are returned.
A passage of 51 words holds such a run whatever stands around it but for one in a
thousand (simulated), a longer one with still fewer exceptions.

Words: A-Z lower-cased, maximal runs outside ``[\x20\x09-\x0D]``, so changes of
white space do not matter.

Only digests with a second document are joined back to their chunks; a digest
that a third of the documents share is counted with partial sums and joined by a
join whose partitions Spark can split.

Edge cases: NULL, empty and short texts have no chunks; a row with a NULL id
takes no part and is left as it is; rows of the same id are one document and do
not make each other repeats; other columns pass through.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tunnelscan.llm.common import (as_strings, batch_of, flat, id_text, mix, powers, slices, span_hashes, stage,
                                   word_spans)

GEAR = 4
REACH = 3
MIN_WORDS = 12
MIN_RUN = 20

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[[9, 10, 11, 12, 13, 32]] = False
_WORD = re.compile("[^ \t-\r]+")


def gear(h: np.ndarray, at: np.ndarray, reach: int = GEAR) -> np.ndarray:
    """Rolling hash at each word: the last ``reach`` gear values, each shifted
    once for every word after it.  ``at``: the word's place in its text."""
    out = h.copy()
    for k in range(1, reach):
        before = np.zeros_like(h)
        before[k:] = h[:-k]
        out += np.where(at >= k, before << np.uint64(k), np.uint64(0))
    return mix(out)


def periodic_cuts(v: np.ndarray, row: np.ndarray, reach: int = REACH, every: int = MIN_WORDS) -> np.ndarray:
    """Every so many words of a stretch in which the hashes repeat with a period of
    at most ``reach``, counted from the stretch's start."""
    out = np.zeros(len(v), dtype=bool)
    free = np.ones(len(v), dtype=bool)
    for period in range(1, min(reach, len(v) - 1) + 1):
        tied = np.zeros(len(v), dtype=bool)
        tied[period:] = (v[period:] == v[:-period]) & (row[period:] == row[:-period])
        tied &= free
        at = np.flatnonzero(tied)
        if len(at):
            opens = np.flatnonzero(np.r_[True, at[1:] != at[:-1] + 1])
            place = np.arange(len(at)) - np.repeat(opens, np.diff(np.r_[opens, len(at)]))
            out[at[place % every == every - 1]] = True
            # Of a stretch of this period, none of a multiple of it.
            free[at] = False
    return out


def cuts(v: np.ndarray, row: np.ndarray, reach: int = REACH) -> np.ndarray:
    """Whether a chunk ends after each word; the last word of a text always does."""
    n = len(v)
    low = np.ones(n, dtype=bool)
    for k in range(1, reach + 1):
        same = row[k:] == row[:-k]
        low[k:] &= ~same | (v[k:] < v[:-k])
        low[:-k] &= ~same | (v[:-k] <= v[k:])
    low |= periodic_cuts(v, row, reach)
    if n:
        low[np.flatnonzero(row[1:] != row[:-1])] = True
        low[-1] = True
    return low


def chunks(col: pa.Array, min_words: int = MIN_WORDS):
    """(row, first word, number of words, two digests) of all chunks."""
    data, offs = flat(col)
    data = _LOWER[data]
    starts, ends, row = word_spans(data, offs, _IS_WORD)
    h = span_hashes(data, starts, ends)
    if not len(h):
        empty = np.empty(0, np.int64)
        return empty, empty, empty, empty, empty
    first = np.searchsorted(row, row)
    at = np.arange(len(h)) - first
    ended = np.flatnonzero(cuts(gear(h, at), row))
    begin = np.concatenate([[0], ended[:-1] + 1])
    k = np.searchsorted(ended, begin + min_words - 1)
    ok = k < len(ended)
    begin, k = begin[ok], k[ok]
    end = ended[k]
    ok = row[begin] == row[end]
    begin, end = begin[ok], end[ok]
    digests = []
    for values in (h, mix(h ^ np.uint64(0x5851F42D4C957F2D))):
        total = np.zeros(len(h) + 1, np.uint64)
        np.cumsum(values * powers(len(h)), out=total[1:])
        inverse = powers(len(h) + 1, pow(0x9E3779B97F4A7C15, -1, 1 << 64))
        x = (total[end + 1] - total[begin]) * inverse[begin]
        digests.append(mix(x + (end - begin).astype(np.uint64)).view(np.int64))
    return row[begin], at[begin], end - begin + 1, *digests


def _chunk(min_words: int):
    kinds = pa.schema([("digest", pa.int64()), ("check", pa.int64()), ("doc_id", pa.int64()), ("place", pa.int64())])

    def run(batches):
        for batch in batches:
            ids = batch.column(0).to_numpy(zero_copy_only=False)
            col = as_strings(batch.column(1))
            for a, b in slices(col):
                row, at, n, digest, check = chunks(col.slice(a, b - a), min_words)
                yield batch_of(kinds, digest, check, ids[a:b][row], at << 24 | n)
    return run


def _repeats(documents: DataFrame, id_col: str, text_col: str, min_words: int) -> DataFrame:
    """Chunks that another document holds as well: their place, the smallest id that
    holds them, whether it is this one, and the ``run`` of the document that they
    are of (overlapping or adjoining chunks)."""
    docs = id_text(documents, id_col, text_col).where("doc_id is not null and text is not null")
    all_of = stage(docs.mapInArrow(_chunk(min_words), "digest long, check long, doc_id long, place long"), "chunks")
    held = all_of.groupBy("digest").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
    shared = stage(held.where("low <> high").select("digest"), "shared")
    found = stage(all_of.join(shared, "digest"), "repeats")
    # The second digest parts chunks that share the first one by chance.
    firsts = stage(found.groupBy("digest", "check").agg(F.min("doc_id").alias("first_doc_id"),
                                                        F.max("doc_id").alias("high"))
                   .where("first_doc_id <> high").drop("high"), "firsts")
    start, n = F.shiftright("place", 24), F.col("place").bitwiseAND(F.lit((1 << 24) - 1))
    rows = (found.join(firsts, ["digest", "check"])
            .select("doc_id", start.alias("start"), (start + n).alias("end"), "first_doc_id",
                    (F.col("doc_id") == F.col("first_doc_id")).alias("first")).distinct())
    return _merged(rows, ["doc_id"], "run")


def _merged(rows: DataFrame, keys: list[str], number: str) -> DataFrame:
    """The number of the run, within ``keys``, that each interval is of.  The keys
    name a document: its own rows, in order."""
    order = Window.partitionBy(*keys).orderBy("start", "end")
    reached = F.max("end").over(order.rowsBetween(Window.unboundedPreceding, -1))
    marked = rows.withColumn("new", F.when(F.col("start") <= reached, 0).otherwise(1))
    return marked.withColumn(number, F.sum("new").over(order.rowsBetween(Window.unboundedPreceding, 0))).drop("new")


def repeated_passages(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      min_words: int = MIN_WORDS, min_run: int = MIN_RUN) -> DataFrame:
    """Runs of words that other documents hold as well: ``doc_id``,
    ``start_word``, ``end_word`` (exclusive), ``n_words``, ``first_doc_id`` (the
    smallest id that holds a part of it) and ``first`` (this document is the
    first for all of the run's chunks).  Documents without repeats have no row.
    """
    out = _repeats(documents, id_col, text_col, min_words).groupBy("doc_id", "run").agg(
        F.min("start").alias("start_word"), F.max("end").alias("end_word"), F.min("first_doc_id").alias("first_doc_id"),
        F.bool_and("first").alias("first"))
    return (out.where(F.col("end_word") - F.col("start_word") >= min_run)
            .select("doc_id", "start_word", "end_word", (F.col("end_word") - F.col("start_word")).alias("n_words"),
                    "first_doc_id", "first"))


def later_copies(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 min_words: int = MIN_WORDS, min_run: int = MIN_RUN) -> DataFrame:
    """The parts of those runs that an earlier document holds: ``doc_id``,
    ``start_word``, ``end_word``.  What this document is the first to hold stays
    out, so cutting these parts leaves one copy of everything."""
    chunked = _repeats(documents, id_col, text_col, min_words)
    whole = Window.partitionBy("doc_id", "run")
    long = chunked.withColumn("size", F.max("end").over(whole) - F.min("start").over(whole)).where(F.col("size") >= min_run)
    parts = _merged(long.where("not first").select("doc_id", "run", "start", "end"), ["doc_id"], "part")
    return parts.groupBy("doc_id", "part").agg(F.min("start").alias("start_word"), F.max("end").alias("end_word")).drop("part")


def _cut(batches):
    for batch in batches:
        texts = batch.column(0).to_pylist()
        out = []
        for text, starts, ends in zip(texts, batch.column(1).to_pylist(), batch.column(2).to_pylist()):
            if text is not None and starts:
                spans = [m.span() for m in _WORD.finditer(text)]
                kept, done = [], 0
                for a, b in sorted(zip(starts, ends)):
                    kept.append(text[done:spans[a][0]])
                    done = max(done, spans[b - 1][1])
                text = "".join(kept) + text[done:]
            out.append(text)
        yield pa.RecordBatch.from_arrays([pa.array(out, pa.string()), *batch.columns[3:]],
                                         names=["__text", *batch.schema.names[3:]])


def without_repeats(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents with every part of a repeated run taken out that an earlier
    document (by id) holds; all columns and rows stay."""
    runs = stage(later_copies(documents, id_col, text_col, **options).groupBy("doc_id").agg(F.collect_list("start_word").alias("__starts"),
                                        F.collect_list("end_word").alias("__ends"))
                 .withColumnRenamed("doc_id", "__id"), "runs")
    names = documents.columns
    held = documents.select(F.struct(*[F.col(f"`{c}`") for c in names]).alias("__row"))
    joined = held.join(runs, F.col(f"__row.`{id_col}`").cast("long") == F.col("__id"), "left")
    kind = joined.select("__row").schema
    cut = joined.select(F.col(f"__row.`{text_col}`").cast("string").alias("t"), "__starts", "__ends", "__row").mapInArrow(
        _cut, "__text string, __row " + kind["__row"].dataType.simpleString())
    return cut.select(*[F.col("__text").alias(c) if c == text_col else F.col(f"__row.`{c}`").alias(c) for c in names])


def op2_substrings(documents: DataFrame) -> DataFrame:
    return repeated_passages(documents)
