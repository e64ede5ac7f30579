"""Benchmark decontamination: word windows of test items found in documents.

One Aho-Corasick automaton holds every window of the benchmark as a sequence of
word numbers, so a state is a word and not a character.  It is packed into number
arrays by a Spark task: edges sorted by (state, word), failure and output links,
items of each window.  These are broadcast; the benchmark's rows never reach the
driver.  A text is normalised and scanned once; matches are word positions, mapped
back to character offsets of the original text.

Bound: at most ``block_words`` benchmark words (with the overlaps of long items)
make one automaton, some 200 bytes each.  A larger benchmark is dealt by hash into
several, which take a round over a staged table each.

Words: A-Z lower-cased, maximal runs of characters outside
``[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]``.  A window is ``window`` consecutive item
words; a shorter, non-empty item is one window.

Edge cases: a NULL or empty text has no words, no hits and is not contaminated;
NULL or wordless items have no window; repeated items count by item id, once
per id; repeated documents give a row each; an item with a NULL id
hits like any other and is left out of the list of items; an
empty benchmark leaves every document clean; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import re
from itertools import repeat
from typing import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunnelscan.llm.common import as_strings, batch_of, id_text, keyed, keyed_batch, row_text, slices, stage

WINDOW = 13
# Benchmark words of one automaton, some 200 bytes each in every Python worker.
BLOCK_WORDS = 1_000_000
# Windows of one piece of an item: a long item is cut into overlapping pieces.
PIECE = 4096
# Words of text that one lane of the scan reads.
LANE = 192
# Bytes of a packed array in one row.
_PART = 16 << 20

_TABLE = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
               for c in range(256))
_ORIGINAL_WORD = re.compile("[0-9A-Za-z\x80-\U0010FFFF]+")


def words(text: str) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").translate(_TABLE).split()


_PIECES = pa.schema([("item", pa.string()), ("words", pa.list_(pa.binary()))])
_PACKED = pa.schema([("block", pa.int64()), ("name", pa.string()), ("part", pa.int32()), ("data", pa.binary())])


def _pieces(window: int, size: int = PIECE):
    """The words of every item, in pieces that share ``window`` - 1 words, so that
    each window lies in one piece."""
    def run(batches):
        for batch in batches:
            items, texts = batch.column(0), as_strings(batch.column(1))
            for a, b in slices(texts):
                split = [words(text) for text in texts.slice(a, b - a).to_pylist()]
                cut = [(item, w[k:k + size + window - 1]) for item, w in zip(items.slice(a, b - a).to_pylist(), split) if w
                       for k in range(0, max(1, len(w) - window + 1), size)]
                yield batch_of(_PIECES, [item for item, _ in cut], [w for _, w in cut])
    return run


def _advance(keys: np.ndarray, fail: np.ndarray, root: np.ndarray, state: np.ndarray, word: np.ndarray) -> np.ndarray:
    """The states after one more word each; a state is the number of the edge that
    leads to it, from 1, and 0 the root."""
    out = root[word]
    left = np.flatnonzero((state > 0) & (word > 0))
    at = state[left]
    while left.size:
        key = (at.astype(np.int64) << 32) | word[left]
        edge = np.searchsorted(keys, key)
        there = keys[np.minimum(edge, len(keys) - 1)] == key
        out[left[there]] = edge[there] + 1
        at, left = fail[at[~there]], left[~there]
        deep = at > 0
        at, left = at[deep], left[deep]
    return out


def packed(items: pa.Array, pieces: pa.Array, window: int) -> dict[str, np.ndarray]:
    """The automaton of the windows of ``pieces`` (lists of words) of ``items``.

    ``words``: the distinct words, joined by spaces, numbered from 1; ``keys``: its
    edges, (state << 32 | word); ``root``: the state after each word alone; ``fail``:
    the state of the longest proper suffix; ``link``: the state itself where it ends
    a window, else the next such one among its suffixes, else 0; ``size``: words of
    a state; ``ends`` / ``at`` / ``owners``: the states that end a window and the items that have
    it (-1: one without an id); ``ids``: the item ids as JSON."""
    if isinstance(pieces, pa.ChunkedArray):
        items, pieces = items.combine_chunks(), pieces.combine_chunks()
    coded = pieces.flatten().dictionary_encode()
    lengths = pc.list_value_length(pieces).to_numpy(zero_copy_only=False).astype(np.int64)
    text = np.r_[coded.indices.to_numpy(zero_copy_only=False).astype(np.int64) + 1, 0]
    first = np.cumsum(lengths) - lengths
    per_piece = np.maximum(1, lengths - window + 1)
    piece = np.repeat(np.arange(len(lengths)), per_piece)
    start = first[piece] + np.arange(len(piece)) - np.repeat(np.cumsum(per_piece) - per_piece, per_piece)
    size = np.minimum(lengths, window)[piece]

    # Level by level: the windows that go on, their states, the distinct edges.
    state = np.zeros(len(start), np.int64)
    root = np.zeros(len(coded.dictionary) + 1, np.int32)
    keys, fail, sizes = np.empty(0, np.int64), np.zeros(1, np.int32), np.zeros(1, np.uint8)
    for depth in range(int(size.max(initial=0))):
        on = np.flatnonzero(size > depth)
        level, place = np.unique((state[on] << 32) | text[start[on] + depth], return_inverse=True)
        before, word = level >> 32, level & 0xFFFFFFFF
        back = _advance(keys, fail, root, fail[before], word) if depth else np.zeros(len(level), np.int32)
        state[on] = len(keys) + 1 + place
        if not depth:
            root[word] = np.arange(1, len(level) + 1)
        keys, fail = np.r_[keys, level], np.r_[fail, back.astype(np.int32)]
        sizes = np.r_[sizes, np.full(len(level), depth + 1, np.uint8)]

    named = items.cast(pa.string()).dictionary_encode()
    owner = pc.fill_null(named.indices, -1).to_numpy(zero_copy_only=False).astype(np.int64)[piece]
    pairs = np.unique((state << 32) | (owner + 1))
    ends, at = np.unique(pairs >> 32, return_index=True)
    link = np.zeros(len(keys) + 1, np.int32)
    link[ends] = ends
    # A suffix is shorter, so it stands in an earlier level.
    edges = np.searchsorted(sizes, np.arange(1, int(sizes.max()) + 2))
    for a, b in zip(edges[:-1], edges[1:]):
        part = link[a:b]
        link[a:b] = np.where(part > 0, part, link[fail[a:b]])
    return {"words": np.frombuffer(b" ".join(coded.dictionary.to_pylist()), np.uint8), "keys": keys, "root": root, "fail": fail, "link": link,
            "size": sizes, "ends": ends.astype(np.int32), "at": np.r_[at, len(pairs)].astype(np.int32),
            "owners": ((pairs & 0xFFFFFFFF) - 1).astype(np.int32),
            "ids": np.frombuffer(json.dumps(named.dictionary.to_pylist()).encode(), np.uint8)}


# Types of the packed arrays, as they travel as bytes.
_KINDS = {"words": np.uint8, "keys": np.int64, "root": np.int32, "fail": np.int32, "link": np.int32, "size": np.uint8,
          "ends": np.int32, "at": np.int32, "owners": np.int32, "ids": np.uint8}


def _pack(window: int):
    def run(key, table):
        rows = []
        for name, values in packed(table["item"], table["words"], window).items():
            data = values.tobytes()
            rows += [(key[0].as_py(), name, k, data[a:a + _PART]) for k, a in enumerate(range(0, len(data), _PART))]
        return pa.table([pa.array(c, f.type) for c, f in zip(zip(*rows), _PACKED)], schema=_PACKED)
    return run


def automata(benchmark: DataFrame, window: int, id_col: str, text_col: str, block_words: int) -> Iterator[dict]:
    """The automata of the benchmark, one for ``block_words`` words, as packed arrays."""
    items = benchmark.select(F.col(f"`{id_col}`").cast("string").alias("item"),
                             F.col(f"`{text_col}`").cast("string").alias("t"))
    pieces = stage(items.where("t is not null").distinct().mapInArrow(
        _pieces(window, min(PIECE, block_words)), "item string, words array<binary>"), "benchmark")
    total = pieces.agg(F.sum(F.size("words"))).first()[0]
    if not total:
        return
    count = -(-total // block_words)
    block = F.pmod(F.xxhash64("item", "words"), F.lit(count)).alias("block")
    parts = stage(pieces.select(block, "item", "words").groupBy("block").applyInArrow(
        _pack(window), "block long, name string, part int, data binary"), "automata")
    for k in range(count):
        got: dict[str, list] = {name: [] for name in _KINDS}
        for row in sorted(parts.where(F.col("block") == k).collect(), key=lambda r: r["part"]):
            got[row["name"]].append(row["data"])
        if got["keys"]:
            yield {name: np.frombuffer(b"".join(got[name]), kind) for name, kind in _KINDS.items()}


def scan(auto: dict, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(last word, state) of every window that occurs in the word numbers ``x``.

    Lanes of the text advance together.  A state knows at most as many words as the
    longest window, so a lane that starts that many words early has the right one."""
    keys, fail, root, link = auto["keys"], auto["fail"], auto["root"], auto["link"]
    ahead = int(auto["size"][-1]) - 1
    lanes = -(-len(x) // LANE)
    padded = np.zeros(lanes * LANE + ahead, np.int32)
    padded[ahead:ahead + len(x)] = x
    grid = np.lib.stride_tricks.sliding_window_view(padded, LANE + ahead)[::LANE].T.copy() if lanes else ()
    state = np.zeros(lanes, np.int32)
    where, what = [], []
    for k, word in enumerate(grid):
        state = _advance(keys, fail, root, state, word)
        lane = np.flatnonzero(link[state]) if k >= ahead else ()
        found = link[state[lane]] if len(lane) else ()
        while len(found):
            where.append(lane * LANE + k - ahead)
            what.append(found)
            found = link[fail[found]]
            lane, found = lane[found > 0], found[found > 0]
    none = np.empty(0, np.int64)
    return np.concatenate([none, *where]), np.concatenate([none, *what]).astype(np.int64)


_SEEN = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("first", pa.list_(pa.int32())),
                   ("last", pa.list_(pa.int32())), ("items", pa.list_(pa.string()))])
_FOUND = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("n_hit", pa.int64()),
                    ("items", pa.list_(pa.string())), ("items_sha256", pa.string()),
                    ("starts", pa.list_(pa.int32())), ("ends", pa.list_(pa.int32()))])


def _scan(shared, last_round: bool):
    """Adds the word ranges hit and the items found to those of earlier rounds;
    the last round turns them into the result."""
    def run(batches):
        auto = shared.value
        if auto:
            get = {w: k for k, w in enumerate(auto["words"].tobytes().split(), 1)}.get
            ids = json.loads(auto["ids"].tobytes())
        for batch in batches:
            texts = as_strings(batch.column(1))
            first, last, items = (batch.column(k).to_pylist() for k in (2, 3, 4))
            sizes = np.zeros(len(texts), np.int64)
            for a, b in slices(texts):
                # The texts one after the other; 0, which no window has, between them.
                numbers = []
                for k, text in enumerate(texts.slice(a, b - a).to_pylist(), a):
                    w = words(text)
                    sizes[k] = len(w)
                    if auto:
                        numbers.append(np.fromiter(map(get, w, repeat(0)), np.int32, len(w)))
                        numbers.append(np.zeros(1, np.int32))
                if not auto:
                    continue
                begin = np.cumsum(sizes[a:b] + 1) - sizes[a:b] - 1
                end, state = scan(auto, np.concatenate(numbers))
                row = np.searchsorted(begin, end, side="right") - 1
                for k, e, n in zip((a + row).tolist(), (end - begin[row]).tolist(), auto["size"][state].tolist()):
                    first[k].append(e - n + 1)
                    last[k].append(e)
                pairs = np.unique((row << 32) | np.searchsorted(auto["ends"], state))
                for k, w in zip((pairs >> 32).tolist(), (pairs & 0xFFFFFFFF).tolist()):
                    items[a + k].extend([ids[o] for o in auto["owners"][auto["at"][w]:auto["at"][w + 1]].tolist() if o >= 0])
            items = [sorted(set(x)) for x in items]
            if last_round:
                yield _result(batch.column(0), texts, sizes.tolist(), first, last, items)
            else:
                yield keyed_batch(_SEEN, batch.column(0), batch.column(1).cast(pa.string()), first, last, items)
    return run


def _result(ids, texts, sizes, first, last, items) -> pa.RecordBatch:
    hits, starts, ends = [], [], []
    for k, n in enumerate(sizes):
        begin, stop, hit = [], [], 0
        if first[k]:
            marks = np.zeros(n + 1, dtype=np.int32)
            np.add.at(marks, first[k], 1)
            np.add.at(marks, np.asarray(last[k]) + 1, -1)
            inside = np.cumsum(marks) > 0
            hit = int(inside.sum())
            edge = np.flatnonzero(np.diff(np.r_[False, inside].astype(np.int8)))
            spans = [m.span() for m in _ORIGINAL_WORD.finditer(texts[k].as_py())]
            begin = [spans[e][0] for e in edge[::2]]
            stop = [spans[e - 1][1] for e in edge[1::2]]
        hits.append(hit)
        starts.append(begin)
        ends.append(stop)
    digests = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in items]
    return keyed_batch(_FOUND, ids, sizes, hits, items, digests, starts, ends)


def decontaminate(documents: DataFrame, benchmark: DataFrame, window: int = WINDOW, id_col: str = "doc_id",
                  text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text",
                  block_words: int = BLOCK_WORDS, whole_rows: bool = False) -> DataFrame:
    """A row for each document: ``n_words``, ``n_hit``, the items found (ids as
    sorted strings), their digest, and ``starts`` / ``ends``: the character
    offsets of the maximal hit ranges in the original text; with ``whole_rows``
    the struct ``row`` of all columns in place of the id.

    One automaton is broadcast, and each text scanned once.  A benchmark of more
    than ``block_words`` words takes a further round over a staged table for each
    further automaton.
    """
    spark = documents.sparkSession
    none = F.array().cast("array<int>")
    lists = none.alias("first"), none.alias("last"), F.array().cast("array<string>").alias("items")
    df = row_text(documents, text_col, *lists) if whole_rows else id_text(documents, id_col, text_col, *lists)
    # Without any window the words are still counted.
    auto: dict = {}
    for following in automata(benchmark, window, item_col, item_text_col, block_words):
        if auto:
            shared = spark.sparkContext.broadcast(auto)
            df = stage(df.mapInArrow(_scan(shared, False), df.schema), "decontaminate")
        auto = following
    shared = spark.sparkContext.broadcast(auto)
    return df.mapInArrow(_scan(shared, True), keyed(df, "n_words long, n_hit long, items array<string>, "
                                                                "items_sha256 string, starts array<int>, ends array<int>"))


def is_contaminated() -> Column:
    """At least a twentieth of the words are hit."""
    return (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words"))


def op3_decontaminate(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = decontaminate(documents, benchmark)
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"), "items_sha256",
        is_contaminated().alias("contaminated"))
