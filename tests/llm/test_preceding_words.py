import random
import tracemalloc
import types

import numpy as np
import pyarrow as pa

from helpers import docs
from tunnelscan.llm import mixing


def test_shuffled_text_scores_worse(spark):
    rng = random.Random(5)
    after = {w: [f"w{rng.randrange(300)}" for _ in range(2)] for w in (f"w{k}" for k in range(300))}

    def text():
        words = [f"w{rng.randrange(300)}"]
        while len(words) < 120:
            words.append(after[words[-1]][rng.random() < 0.2])
        return words

    rows = [(k, text()) for k in range(300)]
    plain = [(k, " ".join(w)) for k, w in rows]
    out = {r["doc_id"]: r for r in mixing.op10_mixing(docs(spark, plain)).collect()}
    held = [k for k, r in out.items() if r["held_out"]]
    shuffled = [(k, " ".join(rng.sample(w, len(w))) if k in held else " ".join(w)) for k, w in rows]
    other = {r["doc_id"]: r for r in mixing.op10_mixing(docs(spark, shuffled)).collect()}
    assert len(held) > 10 and all(other[k]["score"] < out[k]["score"] - 20 for k in held)
    # The unigram base cannot tell them apart; the contexts beat it by far.
    assert all(abs(other[k]["base_score"] - out[k]["base_score"]) < 1e-6 for k in held)
    assert all(out[k]["score"] > 0.75 * out[k]["base_score"] for k in held)


def test_guess_is_the_word_of_more_than_half():
    leaves = np.array([5, 5, 5, 60000, 9])
    counts = np.zeros((2, mixing.PATH + 1), np.float32)
    for leaf in leaves:
        counts[0, :mixing.PATH] += leaf >> np.arange(mixing.PATH - 1, -1, -1) & 1
        counts[0, mixing.PATH] += 1
    guess, most, n = mixing.Guesses.majority(counts)
    assert guess.tolist() == [5, -1] and 3 <= most[0] <= 5 and n.tolist() == [5, 0]


def test_guesses_of_a_word_add_up_to_one_at_most():
    rng = np.random.default_rng(1)
    counts = np.zeros(mixing.Guesses.SIZE + (1 << mixing.PATH), np.float32)
    counts[mixing.Guesses.SIZE:] = rng.integers(0, 5, 1 << mixing.PATH)
    guesses = mixing.Guesses.blank(counts)
    found = [(np.full(50, g), np.full(50, 3.0), np.full(50, 4.0)) for g in (7, 9)]
    leaf = np.arange(50)
    log2, hit = guesses.log2(found, leaf)
    p = 2.0 ** log2
    assert hit.nonzero()[0].tolist() == [7, 9]
    # Hits and the one way of missing both.
    assert abs(p[7] + p[9] + p[0] - 1) < 1e-9


def test_counts_take_one_table_and_short_slices_of_memory():
    rng = random.Random(3)
    text = " ".join(f"w{rng.randrange(5000)}" for _ in range(2000))
    batch = pa.record_batch([pa.array([text] * 1200)], names=["text"])
    tracemalloc.start()
    parts = sum(1 for _ in mixing._context_counts([batch]))
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    # The table is 36 MB; a copy of it and arrays of 8 MB of text came to over 150 MB.
    assert parts > 0 and peak < 90e6


def test_chunks_of_tables_are_packed_whole():
    rng = np.random.default_rng(4)
    values = rng.poisson(3, mixing.CHUNK + 100).astype(np.float32)
    for kind in (mixing._SINGLE, mixing._DOUBLE):
        rows = list(mixing._pieces(values, 0, kind))
        back = np.concatenate([mixing._unpacked(r.column(2)[0].as_buffer(), kind) for r in rows])
        assert (back[:len(values)] == values).all() and not back[len(values):].any()
        assert sum(len(r.column(2)[0].as_buffer()) for r in rows) < len(values) * 1.2


def test_a_word_goes_back_to_each_slice_with_its_counts(spark, monkeypatch):
    # Scores of many slices, of one document each, are those of one slice of all.
    rng = random.Random(6)
    rows = [(k, " ".join(f"w{rng.randrange(40 + k)}" for _ in range(30))) for k in range(60)] + [(70, ""), (71, None), (3, "w1 w1")]
    frame = docs(spark, rows).coalesce(1)
    fields = "doc_id", "n_tokens", "n_known", "base_score", "score"
    seen = []
    for size in (8 << 20, 1):
        monkeypatch.setattr(mixing, "SLICE", size)
        seen.append(sorted((tuple(r[f] for f in fields) for r in mixing.op10_mixing(frame).collect()), key=repr))
    assert len(seen[0]) == len(rows)
    for a, b in zip(*seen):
        assert a[:3] == b[:3] and np.allclose(a[3:], b[3:], rtol=0, atol=1e-9)


def test_a_word_of_a_slice_is_one_row_with_all_its_pairs(monkeypatch):
    # Two texts of different kinds share "w": a row for each kind before.
    monkeypatch.setattr(mixing, "TaskContext", types.SimpleNamespace(get=lambda: types.SimpleNamespace(partitionId=lambda: 3)))
    texts = pa.array(["a w w", "b w", None], pa.string())
    batch = pa.record_batch([pa.array([1, 2, 3]), texts, pa.array([False, True, False])], names=["doc_id", "text", "held_out"])
    _, coded, h = mixing._words(pa.array(["a b"], pa.large_string()))
    a, b = mixing._bucket(h)
    centres = np.zeros((mixing.KINDS, 2))
    common = np.sort([a, b])
    centres[1, np.searchsorted(common, a)] = centres[4, np.searchsorted(common, b)] = 1.0
    monkeypatch.setattr(mixing, "COMMON", 2)
    counts = np.zeros(mixing.Guesses.SIZE + (1 << mixing.PATH), np.float32)
    told = types.SimpleNamespace(value=mixing.Guesses.blank(counts).table())
    out = pa.Table.from_batches(mixing._postings(common, centres, told)([batch])).to_pylist()
    words = {r["word"]: r for r in out if r["word"] is not None}
    assert sum(r["word"] is not None for r in out) == len(words) == 3
    # Counted in training: twice in the text of kind 1, not in the held-out one of kind 4.
    assert np.frombuffer(words["w"]["pairs"], "<i8").tolist() == [2 * mixing.KINDS + 1, 4]
    (packed,) = [r["packed"] for r in out if r["packed"] is not None]
    kind, leaf, sizes, doc, tf, hits = mixing._slice_unpacked(packed)
    at = words["w"]["place"]
    assert kind[at:at + 2].tolist() == [1, 4] and len(kind) == len(leaf) == len(sizes) == 4
    assert sorted(zip(doc.tolist(), tf.tolist())) == [(0, 1), (0, 2), (1, 1), (1, 1)] and not hits.any()


def test_counts_of_a_word_meet_across_batches():
    # By word: two slices and the end token; the second word goes on in the next batch.
    def pairs(*of):
        c, kind = np.array(of).T
        return mixing._pairs(c, kind, np.array([0, len(of)]))[0].as_py()

    rows = [("a", pairs((3, 0)), 7, 5), ("b", pairs((1, 2), (0, 4)), 2, 5), ("b", pairs((4, 2)), 9, 6), ("b", pairs((2, 0)), 0, None),
            ("c", pairs((0, 1)), 1, 6)]
    kinds = pa.schema([("word", pa.string()), ("pairs", pa.binary()), ("place", pa.int64()), ("rid", pa.int64())])
    for cut in range(len(rows) + 1):
        batches = [pa.RecordBatch.from_pylist([dict(zip(kinds.names, r)) for r in x], schema=kinds) for x in (rows[:cut], rows[cut:])]
        out = pa.Table.from_batches(mixing._by_word(batches)).to_pylist()
        assert [[r["word"], *([r[c] for c in mixing._COUNTS[:5]])] for r in out] == [
            ["a", 3, None, None, None, None], ["b", 2, None, 5, None, 0], ["c", None, 0, None, None, None]]
        assert [[(x["rid"], x["place"]) for x in r["at"]] for r in out] == [
            [(5, 7 * 8)], [(5, 2 * 8 + 2), (5, 3 * 8 + 4), (6, 9 * 8 + 2)], [(6, 1 * 8 + 1)]]
    assert not list(mixing._by_word([]))


def test_majority_without_a_word_comes_from_the_table():
    rng = np.random.default_rng(2)
    pool = rng.integers(0, 1 << mixing.PATH, 6)
    slot = rng.integers(0, 300, 1500)
    leaf = np.where(rng.random(1500) < 0.8, pool[slot % 6], pool[rng.integers(0, 6, 1500)])
    counts = np.zeros((2, mixing.PATH + 1, 1 << mixing.WORD_BITS), np.float32)
    for j in range(mixing.PATH):
        np.add.at(counts[0, j], slot, leaf >> (mixing.PATH - 1 - j) & 1)
    np.add.at(counts[0, mixing.PATH], slot, 1)
    guesses = mixing.Guesses.blank(np.r_[counts.ravel(), np.zeros(1 << mixing.PATH, np.float32)])
    own = np.array([[x >> (mixing.PATH - 1 - j) & 1 for j in range(mixing.PATH)] + [1] for x in leaf])
    want = mixing.Guesses.majority(counts[0][:, slot].T - own)
    got = mixing.Guesses.others(guesses.without_one()[0], slot, leaf)
    assert all((a == b).all() for a, b in zip(got, want))


def test_texts_are_read_by_three_passes(spark, monkeypatch):
    # Each pass splits all texts into words again; there were five.
    frame = type(spark.range(1))
    passes, run = [], frame.mapInArrow

    def seen(self, *a, **b):
        passes.append("text" in self.columns)
        return run(self, *a, **b)

    monkeypatch.setattr(frame, "mapInArrow", seen)
    rng = random.Random(8)
    rows = [(k, " ".join(f"w{rng.randrange(50)}" for _ in range(20))) for k in range(40)]
    assert mixing.op10_mixing(docs(spark, rows)).count() == 40
    assert sum(passes) == 3


def test_counts_of_bits_add_up_by_slot(monkeypatch):
    rng = np.random.default_rng(7)
    slot, leaf = rng.integers(0, 40, 3000), rng.integers(0, 1 << mixing.PATH, 3000)
    leaf[:500] = (1 << mixing.PATH) - 1
    want = np.zeros((mixing.PATH + 1, 64), np.float32)
    for j in range(mixing.PATH):
        np.add.at(want[j], slot, leaf >> (mixing.PATH - 1 - j) & 1)
    np.add.at(want[mixing.PATH], slot, 1)
    got = np.zeros_like(want)
    for a in (0, 1000, 2999):
        b = {0: 1000, 1000: 2999, 2999: 3000}[a]
        mixing._add_bits(got, slot[a:b], leaf[a:b], mixing._spread())
    assert (got == want).all()
    # Long slices are added up in parts that no field overflows.
    texts = pa.array([" ".join(f"w{x}" for x in slot.tolist())] * 2, pa.string())
    batch = pa.record_batch([texts], names=["text"])
    whole = [r.column(2)[0].as_py() for r in mixing._context_counts([batch])]
    monkeypatch.setattr(mixing, "FIELD", 9)
    assert [r.column(2)[0].as_py() for r in mixing._context_counts([batch])] == whole
