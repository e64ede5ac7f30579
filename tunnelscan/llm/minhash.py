"""Near-duplicate groups by min-max hashing, confirmed on full shingle sets.

1. A text becomes its set of distinct 5-word shingles (64-bit hashes).  Texts of
   equal sets share a node, keyed by a 128-bit digest of the set.
2. Each permutation of the hashes keeps its minimum and its maximum: both are
   unbiased signature values, so ``PERMUTATIONS`` evaluations give twice as many
   values.  Bands of ``ROWS`` values become bucket keys of a node.
3. Nodes that share a bucket are candidates.  First every bucket's most popular
   node (by the sizes of its buckets: the centre of a group of copies) is
   compared with the others; that joins most groups with about as many
   comparisons as they have copies.  Then each bucket that still holds nodes of
   more than one component is split into blocks of at most ``BLOCK_NODES`` nodes,
   and each two blocks are compared within one task, which emits only links that
   join components.  A pair that shares several such buckets is compared in that of
   its first shared band alone.  So every two nodes that share a bucket are in one component
   or were compared: no link is lost to a cap, no group is collected, and no
   list of all pairs is ever made.
4. A pair links when 100 * |A & B| >= threshold * |A | B| on the full sets.

A pair at similarity 0.85 misses all 20 bands with probability 8e-6.

Words: A-Z lower-cased, maximal runs of characters outside
``[\\x20\\x09-\\x0D]``.  With fewer words than a shingle has, the whole sequence
is the one shingle.

Edge cases: a NULL, empty or blank text has an empty set and is linked with
nothing; a row with a NULL id takes no part and is kept, with a NULL component;
repeated rows give a row each; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tunnelscan.llm.common import (as_strings, batch_of, bounded, flat, id_text, list_array, mix, slices, span_hashes,
                                   stage, word_spans)
from tunnelscan.llm.components import components

SHINGLE = 5
THRESHOLD = 85
PERMUTATIONS = 50
ROWS = 5
# Thin key tables up to this many rows (16 bytes each) may be broadcast.
MAX_BROADCAST = 500_000
# Hashes of one set evaluated at a time.
BLOCK = 16_384
# Nodes of a block of a bucket; a task holds two blocks with their sets.
BLOCK_NODES = 256
BLOCK_HASHES = 500_000

_SPACE = [9, 10, 11, 12, 13, 32]
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_IS_WORD = np.ones(256, dtype=bool)
_IS_WORD[_SPACE] = False


def shingles(col: pa.Array, size: int = SHINGLE) -> list[np.ndarray]:
    """The sorted distinct shingle hashes of every text of a string array."""
    data, offs = flat(col)
    data = _LOWER[data]
    starts, ends, row = word_spans(data, offs, _IS_WORD)
    h = span_hashes(data, starts, ends)
    n = len(offs) - 1
    first = np.searchsorted(row, np.arange(n + 1))
    if len(h) >= size:
        all_of = np.zeros(len(h) - size + 1, dtype=np.uint64)
        for k in range(size):
            all_of = mix(all_of + h[k:len(h) - size + 1 + k])
    out = []
    for k in range(n):
        a, b = first[k], first[k + 1]
        if b - a >= size:
            out.append(np.unique(all_of[a:b - size + 1]))
        elif b > a:
            whole = np.array([b - a], dtype=np.uint64)
            for x in h[a:b]:
                whole = mix(whole + x)
            out.append(whole)
        else:
            out.append(np.empty(0, dtype=np.uint64))
    return out


def digest(values: np.ndarray) -> bytes:
    """128-bit digest of a set of hashes."""
    x = mix(values + np.uint64(0x632BE59BD9B4E019))
    y = mix(values ^ np.uint64(0xA0761D6478BD642F))
    n = np.uint64(len(values))
    return np.array([mix(np.array([x.sum(dtype=np.uint64) + n], np.uint64))[0],
                     mix(np.array([y.sum(dtype=np.uint64) ^ n], np.uint64))[0]], dtype=">u8").tobytes()


def signature(values: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Minimum and maximum of the values under every permutation."""
    low = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    high = np.zeros(len(a), dtype=np.uint64)
    for k in range(0, len(values), BLOCK):
        h = values[k:k + BLOCK] * a[:, None]
        h += b[:, None]
        np.minimum(low, h.min(axis=1), out=low)
        np.maximum(high, h.max(axis=1), out=high)
    return np.concatenate([low, high])


def permutations(n: int, seed: int = 1) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(seed)
    a = rng.integers(0, 1 << 63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
    return a, rng.integers(0, 1 << 63, n, dtype=np.uint64)


def band_keys(sig: np.ndarray, rows: int) -> np.ndarray:
    """One 64-bit key for each band of ``rows`` values (the rest is left out)."""
    bands = sig[:len(sig) // rows * rows].reshape(-1, rows)
    key = np.arange(len(bands), dtype=np.uint64)
    for k in range(rows):
        key = mix(key + bands[:, k])
    return key.view(np.int64)


def _sign(size: int, n_permutations: int, rows: int):
    kinds = pa.schema([("doc_id", pa.int64()), ("node", pa.binary()), ("n_shingles", pa.int64()),
                       ("bands", pa.list_(pa.int64())), ("content", pa.binary())])

    def run(batches):
        a, b = permutations(n_permutations)
        for batch in batches:
            col = as_strings(batch.column(1))
            nodes, counts, keys = [], [], []
            for i, j in slices(col):
                for values in shingles(col.slice(i, j - i), size):
                    counts.append(len(values))
                    if len(values):
                        nodes.append(digest(values))
                        keys.append(band_keys(signature(values, a, b), rows))
                    else:
                        nodes.append(None)
                        keys.append(np.empty(0, np.int64))
            offs = np.cumsum([0] + [len(k) for k in keys])
            yield batch_of(kinds, batch.column(0), nodes, counts,
                           list_array(np.concatenate(keys) if keys else np.empty(0, np.int64), offs, pa.int64()),
                           batch.column(2))
    return run


def _sets(size: int):
    kinds = pa.schema([("node", pa.binary()), ("n", pa.int32()), ("hashes", pa.binary())])

    def run(batches):
        for batch in batches:
            col = as_strings(batch.column(0))
            for i, j in slices(col):
                sets = [s for s in shingles(col.slice(i, j - i), size) if len(s)]
                yield batch_of(kinds, [digest(s) for s in sets], [len(s) for s in sets], [s.tobytes() for s in sets])
    return run


def _leader_links(threshold: int):
    """Links of a leader to a chunk of the nodes it is compared with."""
    kinds = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(key, table):
        leader, nodes = key[0].as_py(), table["node"].to_pylist()
        sets = [np.frombuffer(x, np.uint64) for x in table["values"].to_pylist()]
        lead = sets[nodes.index(leader)]
        found = []
        for node, x in zip(nodes, sets):
            at = np.minimum(np.searchsorted(lead, x), len(lead) - 1)
            both = int(np.count_nonzero(lead[at] == x))
            if node != leader and 100 * both >= threshold * (len(x) + len(lead) - both):
                found.append((leader, node))
        return pa.table([pa.array([f[n] for f in found], pa.binary()) for n in (0, 1)], schema=kinds)
    return run


def _linked(pairs: DataFrame, sets: DataFrame, threshold: int) -> DataFrame:
    """The pairs (leader ``a``, node ``b``) that link.

    The nodes of a leader are compared in chunks, each with one copy of the
    leader's set.  Sets of very unequal size cannot link and are left out."""
    sizes = sets.select("node", "n")
    fit = (pairs.join(sizes.toDF("a", "n_a"), "a").join(sizes.toDF("b", "n_b"), "b")
           .where(F.least("n_a", "n_b") * 100 >= F.greatest("n_a", "n_b") * threshold).select("a", "b", "n_b"))
    fit = stage(fit, "fit")
    chunks = fit.groupBy("a").agg(F.greatest(F.ceil(F.count(F.lit(1)) / BLOCK_NODES),
                                             F.ceil(F.sum("n_b") / BLOCK_HASHES)).alias("chunks"))
    # Thin: one row for each leader.  A popular leader's nodes need not meet by a shuffle.
    chunks = stage(chunks, "chunks")
    members = fit.join(bounded(chunks, MAX_BROADCAST), "a").select("a", F.pmod(F.xxhash64("b"), "chunks").alias("chunk"), F.col("b").alias("node"))
    leaders = chunks.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("chunks") - 1)).alias("chunk"),
                            F.col("a").alias("node"))
    rows = members.unionByName(leaders).join(sets.select("node", F.col("hashes").alias("values")), "node")
    return rows.groupBy("a", "chunk").applyInArrow(_leader_links(threshold), "a binary, b binary")


def _block_links(threshold: int):
    """Links between two blocks of a bucket that join different components.

    Two nodes that share an earlier band are left to that band's bucket: it is
    open too, or else they are in one component."""
    kinds = pa.schema([("a", pa.binary()), ("b", pa.binary())])

    def run(key, table):
        i, j = key[1].as_py(), key[2].as_py()
        nodes, block = table["node"].to_pylist(), table["block"].to_numpy()
        sets = [np.frombuffer(x, np.uint64) for x in table["values"].to_pylist()]
        size = np.array([len(x) for x in sets], dtype=np.int64)
        ends = np.cumsum(size)
        group = np.unique(np.array(table["component"].to_pylist(), dtype=object), return_inverse=True)[1]
        earlier = np.array(table["bands"].to_pylist(), dtype=np.int64)[:, :table["band"][0].as_py()]
        number, of = np.unique(np.concatenate(sets), return_inverse=True)
        mark = np.zeros(len(number), dtype=bool)
        left = np.flatnonzero(block == i)
        where = np.concatenate([of[ends[k] - size[k]:ends[k]] for k in left]) if len(left) else of[:0]
        at = np.cumsum(size[left]) - size[left]
        found = []
        for k in np.flatnonzero(block == j):
            new = (group[left] != group[k]) & ~(earlier[left] == earlier[k]).any(axis=1)
            if not new.any():
                continue
            mine = of[ends[k] - size[k]:ends[k]]
            mark[mine] = True
            both = np.add.reduceat(mark[where], at, dtype=np.int64)
            mark[mine] = False
            for m in left[new & (100 * both >= threshold * (size[left] + size[k] - both))]:
                if group[m] != group[k]:
                    found.append((nodes[m], nodes[k]))
                    group[group == group[m]] = group[k]
        return pa.table([pa.array([f[n] for f in found], pa.binary()) for n in (0, 1)], schema=kinds)
    return run


def _node_sets(docs: DataFrame, signed: DataFrame, nodes: DataFrame, size: int) -> DataFrame:
    """The full sets of some nodes, each from one document that has it."""
    holder = signed.join(bounded(nodes, MAX_BROADCAST), "node", "left_semi").groupBy("node").agg(
        F.min("doc_id").alias("i"))
    holder = stage(holder, "holders")
    texts = docs.join(bounded(holder.select("i").distinct(), MAX_BROADCAST), F.col("doc_id") == F.col("i"),
                      "left_semi").select("text")
    # The node is taken from the set itself: a repeated id may have several texts.
    found = texts.mapInArrow(_sets(size), "node binary, n int, hashes binary")
    return stage(found.dropDuplicates(["node"]), "sets")


def near_duplicates(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE,
                    threshold: int = THRESHOLD, n_permutations: int = PERMUTATIONS, rows: int = ROWS,
                    content: Column | None = None) -> DataFrame:
    """``doc_id``, ``n_shingles``, ``component_id`` (smallest id of the group) and
    ``kept`` (the row has that id) of every document.  With ``content``, a binary
    expression of a row, also that and the ``component`` (NULL without shingles),
    which tells apart groups of the same smallest id."""
    docs = id_text(documents, id_col, text_col)
    named = id_text(documents, id_col, text_col, (F.lit(None).cast("binary") if content is None else content).alias("content"))
    signed = stage(named.mapInArrow(_sign(shingle, n_permutations, rows),
                                    "doc_id long, node binary, n_shingles long, bands array<long>, content binary"), "minhash")
    nodes = signed.where("doc_id is not null and node is not null").groupBy("node").agg(
        F.min("doc_id").alias("lowest"), F.first("n_shingles").alias("n"), F.first("bands").alias("bands"))
    nodes = stage(nodes, "nodes")
    slots = nodes.select("node", "n", F.posexplode("bands").alias("band", "key"))
    sizes = slots.groupBy("key").agg(F.count(F.lit(1)).alias("size"), F.sum("n").alias("hashes")).where("size > 1")
    shared = stage(slots.drop("n").join(sizes, "key"), "shared")
    popular = shared.groupBy("node").agg(F.sum("size").alias("popularity"))
    leaders = shared.join(popular, "node").groupBy("key").agg(
        F.max(F.struct("popularity", "node")).alias("top")).select("key", F.col("top.node").alias("leader"))
    # One row for each bucket: a large bucket's nodes need not meet by a shuffle.
    leaders = bounded(stage(leaders, "leaders"), MAX_BROADCAST)
    pairs = stage(shared.join(leaders, "key").where("node <> leader")
                  .select(F.col("leader").alias("a"), F.col("node").alias("b")).distinct(), "pairs")
    sets = _node_sets(docs.where("doc_id is not null"), signed.where("doc_id is not null"),
                      stage(popular.select("node"), "involved"), shingle)
    links = stage(_linked(pairs, sets, threshold), "links")
    groups = components(links)
    named = shared.join(groups, "node", "left").select(
        "key", "node", "band", "size", "hashes", F.coalesce("component", "node").alias("component"))
    mixed = named.groupBy("key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where(
        "low <> high").select("key")
    rest = stage(named.join(bounded(stage(mixed, "mixed"), MAX_BROADCAST), "key"), "open")
    if not rest.isEmpty():
        # Each node goes once to every pair of blocks that its own is part of.
        blocks = F.greatest(F.ceil(F.col("size") / BLOCK_NODES), F.ceil(F.col("hashes") / BLOCK_HASHES))
        own = rest.withColumn("block", F.pmod(F.xxhash64("node"), blocks))
        other = own.withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
        tasks = other.select("key", "node", "component", "band", "block", F.least("block", "other").alias("i"),
                             F.greatest("block", "other").alias("j")).join(nodes.select("node", "bands"), "node").join(
            sets.select("node", F.col("hashes").alias("values")), "node")
        more = tasks.groupBy("key", "i", "j").applyInArrow(_block_links(threshold), "a binary, b binary")
        groups = components(links.unionByName(stage(more, "links")))
    return _labelled(signed, nodes, groups, () if content is None else ("content", "component"))


def _labelled(signed: DataFrame, nodes: DataFrame, groups: DataFrame, more: tuple) -> DataFrame:
    of_node = nodes.select("node", "lowest").join(groups, "node", "left").select(
        "node", "lowest", F.coalesce("component", "node").alias("component"))
    lowest = of_node.groupBy("component").agg(F.min("lowest").alias("component_id"))
    named = of_node.join(lowest, "component").select("node", "component_id", *more[1:])
    out = signed.drop("bands").join(named, "node", "left")
    alone = F.col("doc_id").isNull()
    return out.select(
        "doc_id", "n_shingles",
        F.when(~alone, F.coalesce("component_id", "doc_id")).alias("component_id"),
        (alone | (F.col("doc_id") == F.coalesce("component_id", "doc_id"))).alias("kept"), *more)


def op4_minhash(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents)


__all__ = ["near_duplicates", "op4_minhash", "shingles"]
