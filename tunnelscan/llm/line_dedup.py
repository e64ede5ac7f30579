"""Line dedup across documents, with DataFrame functions only.

Every text is split at newlines.  A line's key is the line without white space
at its ends and with A-Z in lower case.  A key of at least ``min_chars`` code
points that at least two documents hold keeps its lines in the document with the
smallest id and loses them in all others.

Plan: documents become thin rows (128-bit hash of the key, document, position),
staged.  They are range-partitioned by hash and sorted by (hash, document,
position), so the documents of a key stream by in order and the first of them is
known at once: a row of a later document is dropped.  Dropped positions are
gathered by document into a bitmap compressed as runs.  Texts take no part in
any of this; ``kept_text`` applies a bitmap to a text.

Skew: keys with more than ``HOT_SHARE`` of all rows do not go through the range
partitions.  ``freqItems`` names all of them (and at most 1 / ``HOT_SHARE`` keys in
all); their first documents are a map-side minimum, broadcast.  So no group of a
range partition holds more than that share of the rows, and the result is the
same whichever way a key goes.

Edge cases: a NULL or empty text is one empty line; a row with a NULL id counts
as no document and keeps all its lines; rows that share an id are one document,
and each has a bitmap by its own text; equal rows have equal bitmaps; a document
that holds a key several times keeps or loses all of these lines; an empty table
gives an empty result; other columns are left behind.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tunnelscan.llm.common import id_text, stage

MIN_CHARS = 10
# Share of all lines from which a key is handled by broadcast: 1,000 keys at most.
HOT_SHARE = 0.001

_SPACE = " \t\n\x0b\f\r"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_HASH = ["h1", "h2"]
_ROW = ["doc_id", "digest"]


def line_key(line: Column) -> Column:
    """The line without white space at its ends, A-Z in lower case."""
    key = F.btrim(line, F.lit(_SPACE))
    # ``lower`` is the faster one; it is the same where all characters are ASCII.
    return F.when(F.octet_length(key) == F.char_length(key), F.lower(key)).otherwise(F.translate(key, _UPPER, _LOWER))


def split_lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def text_digest(text: Column) -> Column:
    """Tells rows of one id apart by their texts."""
    return F.xxhash64(text)


def _lines(docs: DataFrame, min_chars: int) -> DataFrame:
    """One row for each line that is long enough: hash of its key, row, position."""
    rows = docs.where("doc_id is not null").select(
        "doc_id", text_digest(F.col("text")).alias("digest"), F.posexplode(split_lines(F.col("text"))).alias("pos", "line"))
    keys = rows.select(*_ROW, "pos", line_key(F.col("line")).alias("key")).where(F.char_length("key") >= min_chars)
    return keys.select(F.xxhash64("key").alias("h1"), F.xxhash64(F.lit("line"), "key").alias("h2"), *_ROW, "pos")


def _dropped(lines: DataFrame, hot_share: float) -> DataFrame:
    """Row and position of every line to drop."""
    hot = stage(lines.stat.freqItems(["h1"], hot_share).select(F.explode("h1_freqItems").alias("h1")), "hot-lines")
    firsts = (lines.join(F.broadcast(hot), "h1", "left_semi").groupBy(*_HASH)
              .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last").drop("last"))
    of_hot = lines.join(F.broadcast(firsts), _HASH).where("doc_id > first")
    cold = lines.join(F.broadcast(hot), "h1", "left_anti").repartitionByRange(*_HASH).sortWithinPartitions(
        *_HASH, "doc_id", "pos")
    stream = Window.partitionBy(*_HASH).orderBy("doc_id", "pos").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    of_cold = cold.withColumn("first", F.first("doc_id").over(stream)).where("doc_id > first")
    return of_cold.select(*_ROW, "pos").unionByName(of_hot.select(*_ROW, "pos"))


def _runs(positions: Column) -> Column:
    """Ascending positions as (start, n) of each run of consecutive ones."""
    def opens(x, i):
        return (i == 0) | (F.get(positions, i - 1) < x - 1)

    def closes(x, i):
        return (i == F.size(positions) - 1) | (F.get(positions, i + 1) > x + 1)

    return F.zip_with(F.filter(positions, opens), F.filter(positions, closes),
                      lambda a, b: F.struct(a.alias("start"), (b - a + 1).alias("n")))


def keep_bitmaps(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = MIN_CHARS,
                 hot_share: float = HOT_SHARE) -> DataFrame:
    """``doc_id``, ``digest`` (of the text), ``n_dropped`` and ``dropped``, the zeros
    of the row's keep bitmap as runs ``(start, n)`` of line numbers from 0; rows
    that keep all lines are left out."""
    lines = stage(_lines(id_text(docs, id_col, text_col), min_chars), "lines")
    gone = _dropped(lines, hot_share).groupBy(*_ROW).agg(F.array_sort(F.collect_set("pos")).alias("at"))
    return gone.select(*_ROW, F.size("at").cast("long").alias("n_dropped"), _runs(F.col("at")).alias("dropped"))


def kept_text(text: Column, dropped: Column) -> Column:
    """The text without its dropped lines; the text as it is for a NULL bitmap."""
    lines = split_lines(text)

    def before(run, i):
        last = F.get(dropped, i - 1)
        done = F.coalesce(last["start"] + last["n"], F.lit(0))
        return F.slice(lines, done + 1, run["start"] - done)

    last = F.element_at(dropped, -1)
    done = last["start"] + last["n"]
    kept = F.concat(F.flatten(F.transform(dropped, before)), F.slice(lines, done + 1, F.size(lines) - done))
    return F.when(dropped.isNull(), F.coalesce(text, F.lit(""))).otherwise(F.array_join(kept, "\n"))


def without_repeated_lines(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                           min_chars: int = MIN_CHARS) -> DataFrame:
    """``doc_id``, ``text``, ``n_lines``, ``n_dropped`` and ``kept``, the text without
    its dropped lines, for every row of ``docs``."""
    found = keep_bitmaps(docs, id_col, text_col, min_chars)
    rows = id_text(docs, id_col, text_col).withColumn("digest", text_digest(F.col("text")))
    return rows.join(found, _ROW, "left").select(
        "doc_id", "text", F.size(split_lines(F.col("text"))).cast("long").alias("n_lines"),
        F.coalesce("n_dropped", F.lit(0)).cast("long").alias("n_dropped"),
        kept_text(F.col("text"), F.col("dropped")).alias("kept"))


def op11_line_dedup(documents: DataFrame) -> DataFrame:
    out = without_repeated_lines(documents)
    return out.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))
