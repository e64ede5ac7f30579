r"""Language-model scores by logistic context mixing.

A text is its words (A-Z lower-cased, maximal runs outside
``[\x20\x09-\x0D]``) and one end token, coded as binary decisions:

* the kind of the text, one of ``KINDS`` learned from the shares of common words;
* for each word, whether it is the one that the two words before it guess, and if
  not, the one that the word before it guesses;
* for each token, whether it is known from training;
* a known token that was not guessed follows the path of its hashed code down a
  binary tree (``PATH`` decisions); it is then picked among the few tokens at the leaf;
* a new token is spelled: each byte is a short or a long code.

Several hashed contexts predict every decision from counts: of a guess, the two
words before, the word before, and how common the guess is; on the path the
node, and the node within the text's kind; in a spelling the last 1, 2 and 4
bytes and the whole beginning of the word.  The predictions are combined in the
logistic domain by weights that a gate selects (how often the contexts were
seen), learned online with the token's own last occurrence taken out of the
counts; an adaptive map from (context, prediction) to what was observed then
refines the result.  Summed over a text this gives its log-probability and bits
per byte; the probabilities of all texts add up to one at most.

A context of words guesses a leaf of the tree: of ``1 << WORD_BITS`` hashed slots each
counts its words and, bit by bit, their codes, and the guess is the majority of each
bit.  So tables of several tasks add up, and a word that follows more than half of the
time is guessed.  The guesses of training words are judged with the word itself taken
out of the counts, over all training texts; what was seen is added up by (gate,
rounded predictions), whole numbers, from which the weights are learned.

The rest of the work is shared through the vocabulary, as those decisions depend on
the word and on the kind of its text alone:

1. all tokens of all training texts are counted by hash bucket, and by the words
   before them, in one pass; a second one judges the guesses and takes each text's
   shares of the commonest buckets, by which texts are grouped (k-means, each step
   one job over all training texts; sums of whole numbers);
2. a third pass, over all texts, scores the guesses and writes, for each slice of
   documents, its distinct words with their (word, kind) pairs and, in one row, all
   their documents, counts and hits;
3. the words meet in order, a row for each: the counts of its pairs over all training
   documents (held-out ones are those whose crc32 of the id's text is divisible by
   ten), and the places of the pairs in the slices;
4. the path counts are an aggregate of these; the spelling tables are filled from
   all training words; weights and maps are learned in shards of about
   ``WORDS_PER_TASK`` pairs, dealt and ordered by hash, and averaged in order;
5. the counts go back to the places in the slices; there known words are scored by a
   table of all paths, new ones are spelled, and the scores are summed by document.

All tables have a fixed size; nothing that grows with the corpus reaches the
driver.

Edge cases: a NULL or empty text is the end token alone; a NULL id counts as the
empty text for crc32 (held out); repeated rows give a row each and count each;
without training documents N, V and the tables are empty and all scores finite;
very long words are spelled in blocks; other columns are ignored.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tunnelscan.llm.common import (as_strings, batch_of, flat, give_back, id_text, list_array, mix, slices, span_hashes, span_tables,
                                   stage)

BITS = 20
ORDERS = (1, 2, 4)
CONTEXTS = len(ORDERS) + 1
WORDS_PER_TASK = 500_000
CHUNK = 1 << 16
CHUNKS_PER_TASK = 8
# Symbols and words worked on at a time.
BLOCK = 60_000
# Symbols of one online step.
STEP = 3_000
# Text of a slice: larger slices repeat fewer words.
SLICE = 4 << 20
KINDS = 8
# Hash buckets (leaves) whose shares tell the kind of a text.
COMMON = 64
# Distinct profiles among which the k-means starts; shares as whole numbers.
START = 512
UNIT = 1 << 20
ROUNDS = 6
PATH = 16
END = "\n"
RATE = 0.02
APM_ROWS, APM_STEPS = 256, 33
GATES = 6 * 4 * 2
PATH_GATES = 6 * PATH
# Contexts of one and of two preceding words: slots of each, bytes of text whose
# counts one task adds up, tokens worked on at a time.
WORD_BITS = 18
FILL_BYTES = 64 << 20
TOKENS = 1 << 16
# Bits of a count among those that are added up together.
FIELD = 21
# By the counts of both contexts, whether they agree, and whose guess it is.
GUESS_GATES = 6 * 6 * 2 * 2
# Predictions of a guess rounded to whole numbers, and steps of learning from them.
LEVELS = 25
STEPS = 400

# Bytes with a short code (6 decisions); the others take 9.
_SHORT = [ord(" "), *range(ord("a"), ord("z") + 1), ord("."), ord(","), ord("|"), 0xC3, ord("-")]


def _codes():
    """Decision nodes and outcomes of every byte: (256, 9) each, -1 as filling."""
    node, bit = np.full((256, 9), -1, np.int64), np.zeros((256, 9), np.int64)
    for c in range(256):
        short = c in _SHORT
        value, width, base = (_SHORT.index(c), 5, 1) if short else (c, 8, 64)
        node[c, 0], bit[c, 0] = 0, int(not short)
        at = 1
        for k in range(width):
            b = value >> (width - 1 - k) & 1
            node[c, k + 1], bit[c, k + 1] = base + at, b
            at = at * 2 + b
    return node, bit


NODE, BIT = _codes()
DEPTH = (NODE >= 0).sum(axis=1)


class Spelling:
    """The symbols of some words and the hash of every context at each."""

    def __init__(self, words: pa.Array):
        joined = pc.if_else(pc.equal(words, END), words, pc.binary_join_element_wise(
            words, pa.scalar(" ", pa.large_string()), pa.scalar("", pa.large_string())))
        self.data, offs = flat(joined)
        n = np.diff(offs)
        self.word = np.repeat(np.arange(len(n)), n)
        start = np.repeat(offs[:-1], n)
        at = np.arange(len(self.data)) - start
        last = np.zeros(len(self.data), np.uint64)
        self.contexts = []
        for k in range(1, max(ORDERS) + 1):
            before = np.zeros(len(self.data), np.uint64)
            before[k:] = self.data[:-k]
            last |= np.where(at >= k, before + np.uint64(1), np.uint64(0)) << np.uint64(9 * (k - 1))
            if k == 1:
                self.previous = last.astype(np.int64) & (APM_ROWS - 1)
            if k in ORDERS:
                self.contexts.append(mix(last + np.uint64(k << 56)))
        total, inverse = span_tables(self.data)
        self.contexts.append(mix((total[:-1] - total[start]) * inverse[start] + at.astype(np.uint64)))

    def blocks(self, size: int = BLOCK):
        """(word, previous byte, node, outcome, slots) of the decisions, by block."""
        for a in range(0, len(self.data), size):
            part = self.data[a:a + size]
            depth = DEPTH[part]
            nodes = NODE[part]
            used = nodes >= 0
            node, bit = nodes[used], BIT[part][used]
            salt = (node.astype(np.uint64) + np.uint64(1)) * np.uint64(0x9E3779B97F4A7C15)
            slots = []
            for c in self.contexts:
                h = (np.repeat(c[a:a + size], depth) ^ salt) * np.uint64(0xD6E8FEB86659FD93)
                slots.append(((h ^ (h >> np.uint64(32))) & np.uint64((1 << BITS) - 1)).astype(np.int64))
            yield np.repeat(self.word[a:a + size], depth), np.repeat(self.previous[a:a + size], depth), node, bit, slots


def stretched(n0, n1, floor: float):
    return np.clip(np.log((n1 + floor) / (n0 + floor)), -12, 12).astype(np.float32)


def squashed(s):
    return 1.0 / (1.0 + np.exp(-s.astype(np.float64)))


class Mixer:
    """Gated weights over stretched predictions, and the map that refines them."""

    def __init__(self, weights: np.ndarray, rows: int, refine: np.ndarray | None = None):
        self.weights = weights.astype(float)
        self.rows = rows
        # By (row, step of the mixture): observed 0, observed 1, expected 1.
        self.refine = np.zeros((rows * APM_STEPS, 3)) if refine is None else refine
        self.mass = np.zeros(len(weights))

    def mixed(self, inputs, gate):
        s = np.zeros(len(gate), np.float32)
        for k, x in enumerate(inputs):
            s += self.weights[:, k].astype(np.float32)[gate] * x
        return np.clip(s, -14, 14)

    @staticmethod
    def place(row, s):
        return row * APM_STEPS + np.rint((np.clip(s, -8, 8) + 8) * ((APM_STEPS - 1) / 16)).astype(np.int64)

    def predict(self, inputs, gate, row):
        """P(outcome is 1), kept off 0 and 1."""
        s = self.mixed(inputs, gate)
        # What was observed against what the mixture expected, in the logistic domain.
        n0, n1, expected = self.refine.T
        shift = np.log((n1 + 20) / (expected + 20)) - np.log((n0 + 20) / (np.maximum(n0 + n1 - expected, 0) + 20))
        p = squashed(s + np.clip(shift, -2, 2)[self.place(row, s)])
        return np.clip(p, 1e-7, 1 - 1e-7)

    def learn(self, inputs, gate, row, bit, w) -> None:
        """One online step over a block of decisions with weights ``w``."""
        s = self.mixed(inputs, gate)
        p = squashed(s)
        here = np.bincount(gate, weights=w, minlength=len(self.weights))
        self.mass += 0.02 * (here - self.mass)
        error = (bit - p) * w
        for k, x in enumerate(inputs):
            step = np.bincount(gate, weights=error * x, minlength=len(self.weights))
            self.weights[:, k] += RATE * step / np.maximum(np.maximum(self.mass, here), 1.0)
        place = self.place(row, s)
        for k, x in enumerate((w * (bit == 0), w * (bit == 1), w * p)):
            self.refine[:, k] += np.bincount(place, weights=x, minlength=len(self.refine))


@dataclass
class Speller:
    """Spelling of new words: contexts count every distinct training word once."""

    tables: np.ndarray    # (CONTEXTS, 1 << BITS, 2)
    mixer: Mixer

    @staticmethod
    def blank(tables: np.ndarray) -> "Speller":
        return Speller(tables, Mixer(np.full((GATES, CONTEXTS), 0.3), APM_ROWS))

    def inputs(self, node, slots, less=0.0):
        out, seen = [], []
        for k, slot in enumerate(slots):
            n = np.maximum(self.tables[k].take(slot, axis=0) - less, 0.0)
            out.append(stretched(n[:, 0], n[:, 1], 0.4))
            seen.append(n[:, 0] + n[:, 1])
        gate = np.searchsorted([0.5, 2.5, 12.5, 100.5, 2000.5], seen[-1]) * 4
        return out, (gate + np.searchsorted([0.5, 4.5, 40.5], seen[-2])) * 2 + (node == 0)

    def log2(self, words: pa.Array) -> np.ndarray:
        """log2 P of every word with its end mark."""
        out = np.zeros(len(words))
        for word, previous, node, bit, slots in Spelling(words).blocks():
            p = self.mixer.predict(*self.inputs(node, slots), previous)
            out += np.bincount(word, weights=np.log2(np.where(bit == 1, p, 1 - p)), minlength=len(words))
        return out

    def learn(self, words: pa.Array) -> None:
        """Online steps over words seen once, each taken out of the counts."""
        for _, previous, node, bit, slots in Spelling(words).blocks(STEP):
            own = np.stack([1 - bit, bit], axis=1).astype(np.float32)
            self.mixer.learn(*self.inputs(node, slots, own), previous, bit, np.ones(len(bit)))


def code(words: pa.Array) -> np.ndarray:
    """Leaf of every word: the first bits of its hash."""
    data, offs = flat(words)
    return (span_hashes(data, offs[:-1], offs[1:]) >> np.uint64(64 - PATH)).astype(np.int64)


@dataclass
class Path:
    """Known tokens: counts of leaves, of all texts (row 0) and by kind."""

    leaves: np.ndarray    # (1 + KINDS, 1 << PATH)
    once: np.ndarray      # (1 + KINDS): tokens seen once
    mixer: Mixer

    @staticmethod
    def blank(leaves: np.ndarray, once: np.ndarray) -> "Path":
        return Path(leaves, once, Mixer(np.tile([0.2, 0.8], (PATH_GATES, 1)), PATH))

    def __post_init__(self):
        # Node (1 << level) + prefix holds the sum of the leaves below it.
        self.nodes = np.zeros((len(self.leaves), 2 << PATH))
        self.nodes[:, 1 << PATH:] = self.leaves
        for level in range(PATH - 1, -1, -1):
            a = 1 << level
            self.nodes[:, a:2 * a] = self.nodes[:, 2 * a:4 * a].reshape(len(self.leaves), a, 2).sum(axis=2)

    def decisions(self, leaf, kind, less: float = 0.0):
        """(inputs, gate, level, outcome) of each level in turn."""
        for level in range(PATH):
            node = (1 << level) + (leaf >> (PATH - level))
            bit = leaf >> (PATH - 1 - level) & 1
            inputs, seen = [], None
            for row in (np.zeros_like(kind), kind + 1):
                n = [np.maximum(self.nodes[row, 2 * node + b] - less * (bit == b), 0.0) for b in (0, 1)]
                inputs.append(stretched(n[0], n[1], 0.05))
                seen = n[0] + n[1]
            gate = np.searchsorted([0.5, 3.5, 30.5, 300.5, 5000.5], seen) * PATH + level
            yield inputs, gate, np.full(len(leaf), level), bit

    def new(self, kind):
        """P(the token is new) in a text of this kind."""
        total = self.nodes[:, 1]
        return ((self.once + 0.5) / (total + 1.0))[kind + 1]

    def steps(self, leaf, kind) -> np.ndarray:
        """log2 P of the path to each leaf."""
        out = np.zeros(len(leaf))
        for inputs, gate, level, bit in self.decisions(leaf, kind):
            p = self.mixer.predict(inputs, gate, level)
            out += np.log2(np.where(bit == 1, p, 1 - p))
        return out

    def picked(self, leaf, kind, c_kind, c) -> np.ndarray:
        """log2 P of known tokens whose leaf is known; ``c_kind``, ``c``: their counts."""
        # Among the tokens of the leaf: the kind's counts, backed by all counts.
        all_of = np.maximum(self.leaves[0, leaf], 1.0)
        return np.log2(1 - self.new(kind)) + np.log2((c_kind + 2.0 * c / all_of) / (self.leaves[kind + 1, leaf] + 2.0))

    def log2(self, leaf, kind, c_kind, c) -> np.ndarray:
        """log2 P of known tokens."""
        return self.steps(leaf, kind) + self.picked(leaf, kind, c_kind, c)

    def learn(self, leaf, kind, c_kind) -> None:
        for a in range(0, len(leaf), 4 * STEP):
            part = slice(a, a + 4 * STEP)
            for inputs, gate, level, bit in self.decisions(leaf[part], kind[part], 1.0):
                self.mixer.learn(inputs, gate, level, bit, c_kind[part])


@dataclass
class Guesses:
    """What words follow one and two words: counts by slot, of words and of the ones
    among each bit of their codes, and of all leaves."""

    counts: np.ndarray    # (2, PATH + 1, 1 << WORD_BITS)
    leaves: np.ndarray    # (1 << PATH)
    mixer: Mixer

    SIZE = 2 * (PATH + 1 << WORD_BITS)

    @staticmethod
    def blank(counts: np.ndarray) -> "Guesses":
        return Guesses(counts[:Guesses.SIZE].reshape(2, PATH + 1, 1 << WORD_BITS), counts[Guesses.SIZE:],
                       Mixer(np.full((GUESS_GATES, 3), 0.3), 2))

    def __post_init__(self):
        total = self.leaves.sum()
        self.common = stretched(total - self.leaves, self.leaves, 0.5)

    @staticmethod
    def majority(counts: np.ndarray):
        """(leaf or -1, words that may have it at most, words) of rows of counts."""
        return Guesses._majority(counts[:, PATH], (counts[:, j] for j in range(PATH)))

    @staticmethod
    def _majority(n: np.ndarray, ones):
        """The same of the words and of the ones among each bit in turn."""
        leaf, most = np.zeros(len(n), np.int64), n
        for one in ones:
            leaf = leaf * 2 + (2 * one > n)
            most = np.minimum(most, np.maximum(one, n - one))
        return np.where(n > 0, leaf, -1), most, n

    def decisions(self, found):
        """(candidate, whether asked for, inputs, gate, row) of the guess of two words
        and of that of one; ``found``: ``majority`` of one word and of two."""
        (g1, _, n1), (g2, _, n2) = found
        steps = [0.5, 1.5, 4.5, 20.5, 200.5]
        cell = ((np.searchsorted(steps, n2) * 6 + np.searchsorted(steps, n1)) * 2 + (g1 == g2)) * 2
        for which, g in enumerate((g2, g1)):
            inputs = [self.common[np.maximum(g, 0)]]
            for leaf, most, n in found:
                backed = np.where(leaf == g, most, 0.0)
                inputs.append(stretched(n - backed, backed, 0.4))
            yield g, (g >= 0) & ((which == 0) | (g1 != g2)), inputs, cell + which, np.full(len(g), which)

    def without_one(self) -> list:
        """By slot: words, words that may have the majority at most, and four codes that
        tell both once a word is taken out: the majority without a word whose bits are all
        0, or all 1, the bits that allow fewest words, and the majority of those."""
        out = []
        for counts in self.counts:
            n = counts[PATH]
            most = n.copy()
            for one in counts[:PATH]:
                most = np.minimum(most, np.maximum(one, n - one))
            codes = np.zeros((4, len(n)), np.int64)
            for one in counts[:PATH]:
                tight = (np.maximum(one, n - one) == most) & (2 * one != n)
                codes = codes * 2 + np.stack([2 * one >= n, 2 * one > n + 1, tight, 2 * one > n])
            out.append((n, most, codes[0] << 3 * PATH | codes[1] << 2 * PATH | codes[2] << PATH | codes[3]))
        return out

    @staticmethod
    def others(table, slot, leaf):
        """``majority`` of the slots of these words, each taken out of the counts;
        ``table``: of a context, by ``without_one``."""
        n, most, codes = (x[slot] for x in table)
        zeros, ones, tight, major = (codes >> k * PATH & (1 << PATH) - 1 for k in (3, 2, 1, 0))
        n = np.maximum(n - np.float32(1), 0)
        return (np.where(n > 0, zeros & ~leaf | ones & leaf, -1),
                np.maximum(most - (tight & ~(major ^ leaf) != 0).astype(np.float32), 0), n)

    def cells(self, tables, slots, leaf) -> np.ndarray:
        """Cells of the decisions on these training words, each taken out of the counts."""
        found = [self.others(*x, leaf) for x in zip(tables, slots)]
        out, left = [], np.ones(len(leaf), bool)
        for g, asked, inputs, gate, _ in self.decisions(found):
            asked &= left
            cell = gate
            for x in inputs:
                cell = cell * LEVELS + np.rint(x).astype(np.int64) + LEVELS // 2
            out.append((cell * 2 + (leaf == g))[asked])
            left &= leaf != g
        return np.concatenate(out)

    def learn(self, cell: np.ndarray, n: np.ndarray) -> None:
        """Steps over the counts ``n`` of all cells, in their order."""
        bit, rest = cell & 1, cell >> 1
        inputs = []
        for _ in range(3):
            inputs.insert(0, (rest % LEVELS - LEVELS // 2).astype(np.float32))
            rest = rest // LEVELS
        for _ in range(STEPS if len(cell) else 0):
            self.mixer.refine[:] = 0.0     # of the last step alone
            self.mixer.learn(inputs, rest, rest & 1, bit, n.astype(float))

    def table(self):
        """The guesses of all slots, with every training word among the counts."""
        found = [self.majority(c.T) for c in self.counts]
        return self.leaves, [[x.astype(np.float32 if k else np.int32) for k, x in enumerate(f)] for f in found], (
            self.mixer.weights, self.mixer.refine)

    def log2(self, found, leaf):
        """(log2 P of what the guesses tell of these words, whether one was right)."""
        out, hit = np.zeros(len(leaf)), np.zeros(len(leaf), bool)
        for g, asked, inputs, gate, row in self.decisions(found):
            p = self.mixer.predict(inputs, gate, row)
            right = leaf == g
            out += np.where(asked & ~hit, np.log2(np.where(right, p, 1 - p)), 0.0)
            hit |= right & asked
        return out, hit


def _slots(row: np.ndarray, h: np.ndarray) -> list[np.ndarray]:
    """Slots of the contexts of one and of two words before each word of the texts."""
    before = []
    for k in (1, 2):
        p = np.zeros(len(h), np.uint64)
        p[k:] = np.where(row[k:] == row[:-k], mix(h[:-k].view(np.uint64)) | np.uint64(1), np.uint64(0))
        before.append(p)
    one = mix(before[0])
    two = mix(before[0] * np.uint64(0x9E3779B97F4A7C15) + mix(before[1] + np.uint64(2)))
    return [(c >> np.uint64(64 - WORD_BITS)).astype(np.int64) for c in (one, two)]


def _following(row: np.ndarray, h: np.ndarray):
    """(place, slots of the contexts before, leaf) of the words, ``TOKENS`` at a time."""
    for a in range(0, len(h), TOKENS):
        part, first = slice(a, a + TOKENS), max(0, a - 2)   # two words before tell the slots
        slots = _slots(row[first:part.stop], h[first:part.stop])
        yield part, [s[a - first:] for s in slots], _bucket(h[part])


def _spread() -> list[np.ndarray]:
    """Of every leaf, its bits and a 1 for the word: three to a number, ``FIELD`` apart."""
    bits = [np.arange(1 << PATH) >> (PATH - 1 - j) & 1 for j in range(PATH)] + [np.ones(1 << PATH, np.int64)]
    return [sum(x << FIELD * i for i, x in enumerate(bits[j:j + 3])) for j in range(0, PATH + 1, 3)]


def _add_bits(total: np.ndarray, slot: np.ndarray, leaf: np.ndarray, spread) -> None:
    """Add words, fewer than fill a field, to the counts of their slots: those of a slot
    stand together, so sums over runs tell three counts at a time."""
    both = np.sort(slot << PATH | leaf)
    slot, leaf = both >> PATH, both & (1 << PATH) - 1
    last = np.flatnonzero(np.r_[slot[1:] != slot[:-1], True])
    used = slot[last]
    for j, x in enumerate(spread):
        run = np.diff(np.cumsum(x.take(leaf))[last], prepend=0)
        for i, counts in enumerate(total[3 * j:3 * j + 3]):
            counts[used] = counts.take(used) + (run >> FIELD * i & (1 << FIELD) - 1)


def _context_counts(batches):
    """Counts of this task's training words by the words before them, and by leaf."""
    size, spread = 1 << WORD_BITS, _spread()
    # One table and no copy of it, and short slices: what a task holds beside the table
    # is what its worker takes of an executor's memory.
    out = np.zeros(Guesses.SIZE + (1 << PATH), np.float32)
    total, leaves = out[:Guesses.SIZE].reshape(2, PATH + 1, size), out[Guesses.SIZE:]
    for batch in batches:
        texts = as_strings(batch.column(0))
        for a, b in slices(texts):
            row, coded, h = _words(texts.slice(a, b - a))
            at = coded.indices.to_numpy(zero_copy_only=False)
            leaf = _bucket(h)[at]
            leaves += np.bincount(leaf, minlength=len(leaves))
            for k, slot in enumerate(_slots(row, h[at])):
                for c in range(0, len(at), 1 << FIELD - 1):
                    _add_bits(total[k], slot[c:c + (1 << FIELD - 1)], leaf[c:c + (1 << FIELD - 1)], spread)
    yield from _pieces(out, 0, _SINGLE)


def _judged(common: np.ndarray, shared):
    """Each training text's counts in the common buckets, and the task's training words
    by the cells of their guesses."""
    kinds = pa.schema([("p", pa.list_(pa.int32())), ("cell", pa.int64()), ("n", pa.int64())])

    def run(batches):
        leaves, tables = shared.value
        guesses = Guesses(np.empty(0), leaves, Mixer(np.empty((0, 3)), 0))
        total = np.zeros(2 * GUESS_GATES * LEVELS ** 3, np.int64)
        for batch in batches:
            texts = as_strings(batch.column(0))
            for a, b in slices(texts):
                row, coded, h = _words(texts.slice(a, b - a))
                at = coded.indices.to_numpy(zero_copy_only=False)
                column = _column(_bucket(h), common)[at]
                counts = _counts(row[column >= 0], column[column >= 0], b - a)
                yield batch_of(kinds, list_array(counts.ravel().astype(np.int32), np.arange(b - a + 1) * COMMON, pa.int32()),
                               *(pa.nulls(b - a, pa.int64()) for _ in range(2)))
                for _, slots, leaf in _following(row, h[at]):
                    np.add.at(total, guesses.cells(tables, slots, leaf), 1)
        used = np.flatnonzero(total)
        yield batch_of(kinds, pa.nulls(len(used), kinds.field(0).type), used, total[used])
    return run


def context_counts(training: DataFrame) -> np.ndarray:
    """Words of all training texts (``text``) by the words before them, and by leaf."""
    size = training.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    dealt = training.coalesce(max(1, -(-size // FILL_BYTES)))
    return _summed(dealt.mapInArrow(_context_counts, _PARTS_SQL), Guesses.SIZE + (1 << PATH), _SINGLE)


def learn_guesses(training: DataFrame, counts: np.ndarray, common: np.ndarray) -> tuple[Guesses, DataFrame]:
    """Contexts of preceding words, from all training texts, and the profiles of these
    texts, from the same pass."""
    guesses = Guesses.blank(counts)
    shared = training.sparkSession.sparkContext.broadcast((guesses.leaves, guesses.without_one()))
    judged = stage(training.mapInArrow(_judged(common, shared), "p array<int>, cell long, n long"), "profiles")
    shared.destroy()
    seen = judged.where("cell is not null").groupBy("cell").agg(F.sum("n").alias("n")).orderBy("cell").toArrow()
    guesses.learn(seen["cell"].to_numpy(), seen["n"].to_numpy())
    return guesses, judged.where("p is not null").select("p")


def _bucket(h: np.ndarray) -> np.ndarray:
    return (h.view(np.uint64) >> np.uint64(64 - PATH)).astype(np.int64)


def _words(part: pa.Array):
    """(text, dictionary-coded words, hash of each distinct word) of a slice."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(part))
    parent, words = pc.list_parent_indices(lists), pc.list_flatten(lists)
    full = pc.not_equal(pc.binary_length(words), 0)
    coded = pc.dictionary_encode(pc.filter(words, full))
    data, offs = flat(coded.dictionary)
    return (pc.filter(parent, full).to_numpy(zero_copy_only=False).astype(np.int64), coded,
            span_hashes(data, offs[:-1], offs[1:]).view(np.int64))


def _counts(rows, column, n: int) -> np.ndarray:
    return np.bincount(rows * COMMON + column, minlength=n * COMMON).reshape(n, COMMON)


def _shares(counts: np.ndarray) -> np.ndarray:
    """Root shares of the common buckets, one row of length 1 for each text."""
    x = np.sqrt(counts.astype(np.float64))
    return x / np.maximum(np.sqrt((x ** 2).sum(axis=1, keepdims=True)), 1e-9)


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """The kind of each text; rounded, so that equal centres tie whatever the batch."""
    return np.round(x @ centres.T, 9).argmax(axis=1)


def _column(h: np.ndarray, common: np.ndarray) -> np.ndarray:
    """Place of each hash among the sorted common ones, -1 for others."""
    if not len(common):
        return np.full(len(h), -1)
    at = np.minimum(np.searchsorted(common, h), len(common) - 1)
    return np.where(common[at] == h, at, -1)


def _assign(centres: np.ndarray):
    kinds = pa.schema([("kind", pa.int32()), ("column", pa.int32()), ("value", pa.int64())])

    def run(batches):
        total = np.zeros(centres.shape, np.int64)
        for batch in batches:
            x = _shares(batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(-1, COMMON))
            # Whole numbers: their sums do not depend on the order.
            np.add.at(total, _nearest(x, centres), np.rint(x * UNIT).astype(np.int64))
        kind, column = np.nonzero(total)
        yield batch_of(kinds, kind, column, total[kind, column])
    return run


def common_buckets(texts: DataFrame, counts: np.ndarray | None = None) -> np.ndarray:
    """The hash buckets that hold most tokens of all training texts, ascending;
    ``counts``: the texts' ``context_counts``, whose leaves are these buckets."""
    n = (context_counts(texts) if counts is None else counts)[Guesses.SIZE:]
    top = np.argsort(-n, kind="stable")[:COMMON]
    return np.sort(top[n[top] > 0])


def text_kinds(profiles: DataFrame) -> np.ndarray:
    """Centres of the kinds of texts, by k-means over all ``profiles``."""
    # A few distinct profiles start as centres, each far from those before it.
    sample = profiles.distinct().orderBy(F.xxhash64("p"), "p").limit(START).toArrow()
    centres = np.zeros((KINDS, COMMON))
    if sample.num_rows:
        x = _shares(sample["p"].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, COMMON))
        x = x[x.any(axis=1)] if x.any() else x
        centres[0] = x[(x @ x.mean(axis=0)).argmax()]
        near = x @ centres[0]
        for k in range(1, KINDS):
            # Among the texts with more than one common word, as far as there are any.
            centres[k] = x[np.where((x > 0).sum(axis=1) > 2, near, near + 1).argmin()]
            near = np.maximum(near, x @ centres[k])
    for _ in range(ROUNDS if sample.num_rows else 0):
        sums = np.zeros_like(centres)
        for r in profiles.mapInArrow(_assign(centres), "kind int, column int, value long").groupBy(
                "kind", "column").agg(F.sum("value").alias("value")).collect():
            sums[r["kind"], r["column"]] = r["value"] / UNIT
        length = np.sqrt((sums ** 2).sum(axis=1, keepdims=True))
        centres = np.where(length > 0, sums / np.maximum(length, 1e-9), centres)
    return centres


_COUNTS = [f"c{k}" for k in range(KINDS)]


def _pairs(c: np.ndarray, kind: np.ndarray, offs: np.ndarray) -> pa.Array:
    """Pairs' counts in training and kinds, packed: one value for each word."""
    packed = (c.astype(np.int64) * KINDS + kind).astype("<i8")
    return pa.Array.from_buffers(pa.binary(), len(offs) - 1, [
        None, pa.py_buffer((offs * 8).astype(np.int32)), pa.py_buffer(packed)])


def _slice_packed(kind, leaf, sizes, doc, tf, hits) -> bytes:
    """Of the pairs of a slice: kinds, leaves, numbers of documents; of these documents:
    places, counts, hits.  Packed as chunks are, after the number of pairs."""
    values = np.concatenate([[len(kind)], kind, leaf, sizes, doc, tf, hits]).astype("<i4")
    raw = values.view(np.uint8).reshape(-1, 4).T.tobytes()
    return len(values).to_bytes(8, "little") + pa.compress(raw, codec="zstd", asbytes=True)


def _slice_unpacked(packed: bytes) -> list[np.ndarray]:
    size = int.from_bytes(packed[:8], "little")
    raw = pa.decompress(packed[8:], 4 * size, codec="zstd")
    values = np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(4, size).T).view("<i4").ravel()
    n = int(values[0])
    return np.split(values[1:3 * n + 1], 3) + np.split(values[3 * n + 1:], 3)


def _by_word(batches):
    """From rows ordered by word, one for each word: its counts by kind, and the places
    of its pairs (row id of the slice; place, the kind in the last digit)."""
    place = pa.struct([("rid", pa.int64()), ("place", pa.int64())])
    kinds = pa.schema([("word", pa.large_string()), *((c, pa.int64()) for c in _COUNTS), ("at", pa.list_(place))])

    def rows(words, begin, packed, first, rid):
        data, offs = flat(packed.cast(pa.large_binary()))
        value, offs = data.view("<i8"), offs // 8
        size, n = np.diff(offs), len(begin)
        word = np.repeat(np.repeat(np.arange(n), np.diff(np.r_[begin, len(words)])), size)
        kind = value % KINDS
        c = np.bincount(word * KINDS + kind, weights=value // KINDS, minlength=n * KINDS).reshape(n, KINDS)
        none = np.bincount(word * KINDS + kind, minlength=n * KINDS).reshape(n, KINDS) == 0
        within = np.arange(len(value)) - np.repeat(offs[:-1], size)
        # End tokens have no place.
        placed = np.repeat(rid.is_valid().to_numpy(zero_copy_only=False), size)
        at = [np.repeat(x.fill_null(0).to_numpy(zero_copy_only=False), size) for x in (rid, first)]
        at = pa.StructArray.from_arrays([pa.array(at[0][placed]), pa.array(((at[1] + within) * KINDS + kind)[placed])], fields=list(place))
        ends = np.r_[0, np.cumsum(np.bincount(word[placed], minlength=n))]
        return batch_of(kinds, words.take(pa.array(begin)),
                        *(pa.array(c[:, k].astype(np.int64), mask=none[:, k]) for k in range(KINDS)),
                        pa.ListArray.from_arrays(pa.array(ends, pa.int32()), at))

    def run():
        rest = None
        for batch in batches:
            table = pa.Table.from_batches([batch] if rest is None else [rest, batch]).combine_chunks()
            if not table.num_rows:
                continue
            words = as_strings(table.column(0))
            begin = np.r_[0, 1 + np.flatnonzero(pc.not_equal(words.slice(1), words.slice(0, len(words) - 1)).to_numpy(zero_copy_only=False))]
            # The last word may go on in the next batch.
            if last := int(begin[-1]):
                yield rows(words.slice(0, last), begin[:-1], *(x.combine_chunks() for x in table.slice(0, last).columns[1:]))
            rest = table.slice(last).combine_chunks().to_batches()[0]
        if rest is not None:
            yield rows(as_strings(rest.column(0)), np.zeros(1, np.int64), *rest.columns[1:])
    return run()


def _postings(common: np.ndarray, centres: np.ndarray, shared):
    """Rows of words (word, its pairs, place of the first in the slice), of documents
    (row id, id, held out, kind, words, bytes, bits of the guesses) and, one for a slice,
    of the kinds, leaves and numbers of documents of its pairs and of all their documents,
    counts and hits of the guesses.  The row id of words and slices is that of the first
    document."""
    kinds = pa.schema([("word", pa.large_string()), ("pairs", pa.binary()), ("place", pa.int64()), ("packed", pa.binary()), ("rid", pa.int64()), ("kind", pa.int32()), ("doc_id", pa.int64()), ("held_out", pa.bool_()),
                       ("n_words", pa.int64()), ("n_bytes", pa.int64()), ("guessing", pa.float64())])
    fields = list(kinds)

    nothing = lambda n, of: (pa.nulls(n, f.type) for f in of)

    def rows(guesses, table, ids, part, held, first):
        """Of one slice: in a function of its own, so that nothing of it outlives it."""
        m = len(part)
        row, coded, h = _words(part)
        at = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
        told, hit = _guessed(guesses, table, row, h[at])
        guessing, n_words = -np.bincount(row, weights=told, minlength=m), np.bincount(row, minlength=m)
        del told
        column = _column(_bucket(h), common)[at]
        kind = _nearest(_shares(_counts(row[column >= 0], column[column >= 0], m)), centres)
        del column
        yield batch_of(kinds, *nothing(m, fields[:-7]), first + np.arange(m), kind.astype(np.int32), ids, held,
                       n_words, pc.binary_length(part).cast(pa.int64()), guessing)
        # By word, then kind, then document.
        place = np.lexsort((np.arange(m), kind))
        rank = np.empty(m, np.int64)
        rank[place] = np.arange(m)
        place_of = at * m + rank[row]
        del at, row
        key, tf = np.unique(place_of, return_counts=True)
        right, n_right = np.unique(place_of[hit], return_counts=True)
        del place_of, hit
        hits = np.zeros(len(key), np.int32)
        hits[np.searchsorted(key, right)] = n_right
        doc = place[key % m]
        pair, begin = np.unique(key // m * KINDS + kind[doc], return_index=True)
        offs = np.r_[begin, len(key)]
        del key, right, n_right
        trained = ~held.to_numpy(zero_copy_only=False)
        c = np.add.reduceat(tf * trained[doc], begin) if len(begin) else begin
        # Every word of the dictionary has pairs, in its order.
        n = len(coded.dictionary)
        at = np.searchsorted(pair, np.arange(n + 1) * KINDS)
        yield batch_of(kinds, coded.dictionary, _pairs(c, pair % KINDS, at), at[:-1], *nothing(n, fields[3:-7]),
                       np.full(n, first), *nothing(n, fields[-6:]))
        if len(pair):
            packed = _slice_packed(pair % KINDS, _bucket(h)[pair // KINDS], np.diff(offs), doc, tf, hits)
            yield batch_of(kinds, *nothing(1, fields[:3]), [packed], [first], *nothing(1, fields[-6:]))

    def run(batches):
        leaves, table, (weights, refine) = shared.value
        guesses = Guesses(np.empty(0), leaves, Mixer(weights, 2, refine))
        first = TaskContext.get().partitionId() << 40
        for batch in batches:
            texts = as_strings(batch.column(1))
            for a, b in slices(texts, SLICE):
                yield from rows(guesses, table, batch.column(0).slice(a, b - a), texts.slice(a, b - a),
                                batch.column(2).slice(a, b - a), first)
                give_back()
                first += b - a
    return run


def _guessed(guesses: Guesses, table, row: np.ndarray, h: np.ndarray):
    """``Guesses.log2`` of every word of the texts."""
    told, hit = np.zeros(len(h)), np.zeros(len(h), bool)
    for part, slots, leaf in _following(row, h):
        told[part], hit[part] = guesses.log2([[x[slot] for x in t] for t, slot in zip(table, slots)], leaf)
    return told, hit


_PARTS = pa.schema([("part", pa.int32()), ("chunk", pa.int32()), ("values", pa.binary())])
_PARTS_SQL = "part int, chunk int, values binary"
# Counts fit the first, sums of weights take the second.
_SINGLE, _DOUBLE = "<f4", "<f8"


def _pieces(values: np.ndarray, part: int, kind: str):
    """Chunks of a float table as rows (part, chunk, values)."""
    for k in range(0, len(values), CHUNK):
        piece = values[k:k + CHUNK]
        if piece.any():
            yield batch_of(_PARTS, [part], [k // CHUNK], [_packed(piece, kind)])


def _packed(piece: np.ndarray, kind: str) -> bytes:
    """A chunk compressed, its numbers' first bytes together, then their second ones
    and so on: of most counts one or two bytes tell all."""
    whole = np.zeros(CHUNK, kind)
    whole[:len(piece)] = piece
    return pa.compress(whole.view(np.uint8).reshape(CHUNK, -1).T.tobytes(), codec="zstd", asbytes=True)


def _unpacked(values: pa.Buffer, kind: str) -> np.ndarray:
    size = np.dtype(kind).itemsize
    raw = pa.decompress(values, CHUNK * size, codec="zstd")
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, CHUNK).T).view(kind).ravel()


def _fill(batches):
    tables = np.zeros((CONTEXTS, 2 << BITS), np.float32)
    for batch in batches:
        words = as_strings(batch.column(0))
        for a, b in slices(words, 1 << 18):
            for _, _, _, bit, slots in Spelling(words.slice(a, b - a)).blocks():
                for k, slot in enumerate(slots):
                    np.add.at(tables[k], slot * 2 + bit, np.float32(1))
    yield from _pieces(tables.ravel(), 0, _SINGLE)


def _learn(shared):
    """Weights and maps of a shard's words: both mixers, times the words.  The words
    are learned in the order of their hashes, however they came."""
    def run(key, table):
        tables, leaves, once = shared.value
        speller, path = Speller.blank(tables), Path.blank(leaves, once)
        words, kind = as_strings(table["word"]), table["kind"].to_numpy().astype(np.int64)
        data, offs = flat(words)
        order = np.lexsort((kind, span_hashes(data, offs[:-1], offs[1:])))
        words, kind = words.take(pa.array(order)), kind[order]
        c_kind, single = table["c_kind"].to_numpy()[order].astype(float), table["c"].to_numpy()[order] == 1
        for a, b in slices(words, 1 << 18):
            part = words.slice(a, b - a)
            path.learn(code(part), kind[a:b], c_kind[a:b])
            speller.learn(part.filter(pa.array(single[a:b])))
        size = len(order)
        return pa.Table.from_batches(_pieces(np.concatenate([
            [size], (speller.mixer.weights * size).ravel(), (path.mixer.weights * size).ravel(),
            speller.mixer.refine.ravel(), path.mixer.refine.ravel()]), key[0].as_py(), _DOUBLE), _PARTS)
    return run


def _add(kind: str):
    def run(batches):
        """Sums of the chunks of this partition, one row at a time."""
        total: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, values in zip(batch.column(1).to_pylist(), batch.column(2)):
                x = _unpacked(values.as_buffer(), kind).astype(np.float64)
                total[chunk] = total[chunk] + x if chunk in total else x
        for chunk, x in total.items():
            yield batch_of(_PARTS, [0], [chunk], [_packed(x, kind)])
    return run


def _summed(parts: DataFrame, size: int, kind: str) -> np.ndarray:
    """The sum of all tables: ``size`` floats, gathered on the driver.  Parts are
    added in their order, so the sum is the same in every run."""
    dealt = parts.repartition(-(-size // (CHUNK * CHUNKS_PER_TASK)), "chunk").sortWithinPartitions("chunk", "part")
    rows = dealt.mapInArrow(_add(kind), _PARTS_SQL).toArrow()
    out = np.zeros(-(-size // CHUNK) * CHUNK, kind)
    for chunk, values in zip(rows["chunk"].to_pylist(), rows["values"]):
        out[chunk * CHUNK:(chunk + 1) * CHUNK] = _unpacked(values.as_buffer(), kind)
    return out[:size]


@dataclass
class Model:
    speller: Speller
    path: Path
    paths: np.ndarray     # (KINDS, 1 << PATH): log2 P of the path to each leaf

    def arrays(self) -> tuple:
        """All of it as plain arrays, which a task unpickles without this package."""
        s, p = self.speller, self.path
        return s.tables, s.mixer.weights, s.mixer.refine, p.leaves, p.once, p.mixer.weights, p.mixer.refine, self.paths

    @staticmethod
    def of(tables, s_weights, s_refine, leaves, once, p_weights, p_refine, paths) -> "Model":
        return Model(Speller(tables, Mixer(s_weights, APM_ROWS, s_refine)),
                     Path(leaves, once, Mixer(p_weights, PATH, p_refine)), paths)

    def log2(self, words: pa.Array, leaf: np.ndarray, kind: np.ndarray, c_kind: np.ndarray, c: np.ndarray):
        """(log2 P of every token that was not guessed, the part of its path); of known
        tokens the leaf tells all, the words are those of new ones."""
        known = c > 0
        out, path = np.zeros(len(words)), np.zeros(len(words))
        path[known] = self.paths[kind[known], leaf[known]]
        out[known] = path[known] + self.path.picked(leaf[known], kind[known], c_kind[known], c[known])
        new = np.flatnonzero(~known)
        if len(new):
            coded = words.take(pa.array(new)).dictionary_encode()
            spelled = [self.speller.log2(coded.dictionary.slice(a, b - a)) for a, b in slices(coded.dictionary, 1 << 18)]
            out[new] = np.log2(self.path.new(kind[new])) + np.concatenate(spelled)[coded.indices.to_numpy()]
        return out, path.astype(np.float32)


def train(counted: DataFrame, n_pairs: int) -> Model:
    """``counted``, a staged table of a row for each word: ``word``, ``c`` and
    ``_COUNTS`` (training counts of the word at all and within the kinds), with
    ``n_pairs`` counts above 0 within kinds.  The driver holds the tables (a fixed
    40 MB) and nothing that grows with the words."""
    spark = counted.sparkSession
    counted = counted.where("c > 0")
    # By the number of distinct pairs, which is the table's alone.
    shards = max(1, -(-n_pairs // WORDS_PER_TASK))
    # A few tasks fill whole tables; the end token is not spelled.
    once_each = counted.where(F.col("word") != END).select("word").coalesce(shards)
    tables = _summed(once_each.mapInArrow(_fill, _PARTS_SQL), CONTEXTS * (2 << BITS), _SINGLE).reshape(CONTEXTS, 1 << BITS, 2)
    leaves, once = np.zeros((1 + KINDS, 1 << PATH)), np.zeros(1 + KINDS)
    sums = counted.select("word", "c", *_COUNTS).mapInArrow(_leaves, "kind int, leaf int, c long, once long").groupBy("kind", "leaf").agg(
        F.sum("c").alias("c"), F.sum("once").alias("once")).toArrow()
    at = sums["kind"].to_numpy() + 1, sums["leaf"].to_numpy()
    leaves[at] = sums["c"].to_numpy()
    leaves[0] = leaves.sum(axis=0)
    np.add.at(once, at[0], sums["once"].to_numpy())
    once[0] = once.sum()
    speller, path = Speller.blank(tables), Path.blank(leaves, once)
    s, p = speller.mixer, path.mixer
    shared = spark.sparkContext.broadcast((tables, leaves, once))
    of = [x for k, c in enumerate(_COUNTS) for x in (F.lit(k), F.col(c))]
    known = counted.select("word", F.stack(F.lit(KINDS), *of).alias("kind", "c_kind"), "c").where("c_kind > 0")
    by_shard = known.groupBy(F.pmod(F.xxhash64("word", "kind"), F.lit(shards)).cast("int").alias("shard"))
    learned = _summed(by_shard.applyInArrow(_learn(shared), _PARTS_SQL),
                      1 + s.weights.size + p.weights.size + s.refine.size + p.refine.size, _DOUBLE)
    if learned[0]:
        cut = np.cumsum([1, s.weights.size, p.weights.size, s.refine.size])
        _, s_w, p_w, s_r, p_r = np.split(learned.astype(float), cut)
        s.weights, p.weights = (s_w / learned[0]).reshape(s.weights.shape), (p_w / learned[0]).reshape(p.weights.shape)
        s.refine, p.refine = s_r.reshape(s.refine.shape), p_r.reshape(p.refine.shape)
    shared.destroy()
    every = np.arange(1 << PATH)
    return Model(speller, path, np.stack([path.steps(every, np.full(len(every), k)) for k in range(KINDS)]))


def _leaves(batches):
    """Sums of this task's words by kind and leaf."""
    kinds = pa.schema([("kind", pa.int32()), ("leaf", pa.int32()), ("c", pa.int64()), ("once", pa.int64())])
    total = np.zeros((2, KINDS, 1 << PATH), np.int64)
    for batch in batches:
        leaf, once = code(as_strings(batch.column(0))), batch.column(1).to_numpy(zero_copy_only=False) == 1
        for k in range(KINDS):
            c = batch.column(k + 2).fill_null(0).to_numpy(zero_copy_only=False)
            used = np.flatnonzero(c > 0)
            np.add.at(total[0, k], leaf[used], c[used])
            np.add.at(total[1, k], leaf[used], once[used])
    kind, leaf = np.nonzero(total[0])
    yield batch_of(kinds, kind, leaf, *total[:, kind, leaf])


def _slice_sums(shared, mass: float):
    """Sums of a slice's pairs, by document; ``mass``: of all tokens, with those added."""
    kinds = pa.schema([("rid", pa.int64()), ("base", pa.float64()), ("bits", pa.float64()), ("known", pa.int64())])

    def run(key, pairs, of_slice):
        if not pairs.num_rows:
            return pa.table([pa.array([], f.type) for f in kinds], schema=kinds)
        kind, leaf, sizes, doc, tf, hits = _slice_unpacked(of_slice["packed"][0].as_py())
        # In the order of the pairs' places.
        pairs = pairs.sort_by("place")
        c_kind, c = pairs["c_kind"].to_numpy(), pairs["c"].to_numpy()
        told, path = Model.of(*shared.value).log2(as_strings(pairs["word"]), leaf, kind, c_kind, c)
        pair = np.repeat(np.arange(len(c)), sizes)
        base = np.log10((c + 0.1) / mass)
        sums = [np.bincount(doc, weights=x) for x in (tf * base[pair], hits * path[pair] - tf * told[pair], tf * (c[pair] > 0))]
        used = np.flatnonzero(np.bincount(doc))
        return pa.Table.from_batches([batch_of(kinds, key[0].as_py() + used, sums[0][used], sums[1][used],
                                               np.rint(sums[2][used]).astype(np.int64))])
    return run


def score_texts(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id``, ``held_out``, ``n_tokens``, ``n_known``, ``train_tokens``,
    ``base_score``, ``score`` (log10) and ``bits_per_byte`` of every document."""
    spark = documents.sparkSession
    held = F.crc32(F.coalesce(F.col(f"`{id_col}`").cast("long").cast("string"), F.lit(""))) % 10 == 0
    texts = id_text(documents, id_col, text_col, held.alias("held_out"))
    training = texts.where("not held_out").select("text")
    counts = context_counts(training)
    common = common_buckets(training, counts)
    guesses, profiles = learn_guesses(training, counts, common)
    centres = text_kinds(profiles)
    told = spark.sparkContext.broadcast(guesses.table())
    rows = stage(texts.mapInArrow(
        _postings(common, centres, told), "word string, pairs binary, place long, packed binary, rid long, kind int, doc_id long, "
        "held_out boolean, n_words long, n_bytes long, guessing double"), "postings")
    told.destroy()
    docs, words = rows.where("held_out is not null"), rows.where("word is not null")
    # End tokens are one more word: one for each document, of its kind (at most KINDS rows).
    ends = docs.groupBy("kind").agg(F.count_if(~F.col("held_out")).alias("c")).orderBy("kind").collect()
    kind, c_kind = (np.array([r[x] for r in ends], np.int64) for x in ("kind", "c"))
    packed = _pairs(c_kind, kind, np.array([0, len(ends)]))[0].as_py()
    ended = spark.createDataFrame([(END, packed, 0, None)] if ends else [], "word string, pairs binary, place long, rid long")
    # A row for each word: its counts by kind, and the pairs' places (one for each slice
    # and kind), the kind in their last digit.
    ordered = words.select(*ended.columns).unionByName(ended).repartition("word").sortWithinPartitions("word")
    counted = stage(ordered.mapInArrow(
        _by_word, "word string, " + "".join(f"{x} long, " for x in _COUNTS) + "at array<struct<rid: long, place: long>>"), "counted")
    by_kind = [F.col(x) for x in _COUNTS]
    counted = counted.withColumn("c", sum((F.coalesce(x, F.lit(0)) for x in by_kind), F.lit(0).cast("long")))
    n, v, n_pairs = counted.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0),
                                sum(F.count_if(x > 0) for x in by_kind)).first()
    model = train(counted, n_pairs)
    shared = spark.sparkContext.broadcast(model.arrays())
    # The counts go back to the slices as numbers; only new words go with them.
    back = counted.select("word", "c", F.array(*by_kind).alias("by_kind"), F.explode("at").alias("at")).select(
        "at.rid", F.floor(F.col("at.place") / KINDS).alias("place"), "c",
        F.get("by_kind", (F.col("at.place") % KINDS).cast("int")).alias("c_kind"),
        F.when(F.col("c") == 0, F.col("word")).alias("word"))
    sums = back.groupBy("rid").cogroup(rows.where("packed is not null").select("rid", "packed").groupBy("rid")).applyInArrow(
        _slice_sums(shared, n + 0.1 * (v + 1)), "rid long, base double, bits double, known long")
    # By kind: bits of the end token and of the kind itself.
    n_end = int(c_kind.sum())
    words_of = pa.array([END] * len(ends), pa.large_string())
    told_end, _ = model.log2(words_of, code(words_of), kind, c_kind, np.full(len(ends), n_end))
    extra = {r["kind"]: -float(t) - math.log2((r["c"] + 0.1) / (n_end + 0.1 * KINDS)) for r, t in zip(ends, told_end)}
    bits = F.col("guessing") + F.coalesce("bits", F.lit(0.0)) + F.create_map(*[F.lit(x) for p in (extra or {0: 0.0}).items() for x in p])[
        F.col("kind")]
    end_base = math.log10((n_end + 0.1) / (n + 0.1 * (v + 1)))
    return docs.select("rid", "doc_id", "held_out", "kind", "n_words", "n_bytes", "guessing").join(sums, "rid", "left").select(
        "doc_id", "held_out", (F.col("n_words") + 1).alias("n_tokens"),
        (F.coalesce("known", F.lit(0)) + F.lit(1 if n_end else 0)).cast("long").alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.coalesce("base", F.lit(0.0)) + F.lit(end_base)).alias("base_score"),
        (-bits * F.lit(math.log10(2))).alias("score"),
        (bits / F.greatest("n_bytes", F.lit(1))).alias("bits_per_byte"))


def op10_mixing(documents: DataFrame) -> DataFrame:
    return score_texts(documents)
