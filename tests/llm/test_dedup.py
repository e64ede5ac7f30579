import random

from helpers import ODD, docs, sentences, shingles, tokens

from tunnelscan.llm import minhash, substrings
from tunnelscan.llm.components import components


def groups(rows, threshold=85):
    """Brute force: id -> smallest id reachable over links of full sets."""
    sets = {i: shingles(t) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for a in ids:
        for b in ids:
            if a < b and sets[a] and sets[b]:
                both = len(sets[a] & sets[b])
                if 100 * both >= threshold * len(sets[a] | sets[b]):
                    x, y = sorted((root(a), root(b)))
                    parent[y] = x
    return {i: root(i) for i in ids}


def near_copies(rng, n, words=120, changes=(0, 1, 2, 3, 5, 8)):
    base = sentences(rng, words)
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.choice(changes)):
            w[rng.randrange(len(w))] = "changed" + str(rng.randrange(10 ** 6))
        out.append(" ".join(w))
    return out


def corpus(seed=1):
    rng = random.Random(seed)
    texts = [" ".join(sentences(rng, rng.randint(1, 200))) for _ in range(40)]
    texts += near_copies(rng, 60) + near_copies(rng, 30, 40) + [texts[0]] * 5 + ["a b c", "A b\nc", "a b c d"]
    rng.shuffle(texts)
    return [(k, t) for k, t in enumerate(texts)]


def test_near_duplicates_equal_brute_force(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK_NODES", 8)   # buckets of several blocks
    rows = corpus() + ODD[1:]
    got = {r["doc_id"]: r for r in minhash.op4_minhash(docs(spark, rows)).collect()}
    want = groups(rows)
    assert {i: r["component_id"] for i, r in got.items()} == want
    assert {i: r["n_shingles"] for i, r in got.items()} == {i: len(shingles(t)) for i, t in rows}
    assert all(r["kept"] == (i == want[i]) for i, r in got.items())
    assert len(set(want.values())) < len(rows) - 30


def test_near_duplicates_on_null_ids_repeated_ids_and_empty_tables(spark):
    rows = [(None, "x y z"), (None, "x y z"), (5, "x y z"), (5, "x y z"), (7, "X Y z"), (5, "another text here")]
    got = [(r["doc_id"], r["component_id"], r["kept"]) for r in minhash.op4_minhash(docs(spark, rows)).collect()]
    assert sorted(got, key=str) == sorted([(None, None, True)] * 2 + [(5, 5, True)] * 3 + [(7, 5, False)], key=str)
    assert minhash.op4_minhash(docs(spark, [])).count() == 0


def test_min_and_max_are_unbiased():
    import numpy as np
    rng = np.random.default_rng(5)
    both, left, right = (rng.integers(0, 1 << 63, n, dtype=np.uint64) for n in (700, 150, 150))
    a, b = minhash.permutations(400)
    x = minhash.signature(np.concatenate([both, left]), a, b)
    y = minhash.signature(np.concatenate([both, right]), a, b)
    low, high = (x == y)[:400].mean(), (x == y)[400:].mean()
    assert abs(low - 0.7) < 0.08 and abs(high - 0.7) < 0.08


def test_components(spark):
    rng = random.Random(2)
    chain = [(k, k + 1) for k in range(60)] + [(100, 101), (101, 101), (None, 3), (102, 100), (100, 101)]
    rng.shuffle(chain)
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {k: 0 for k in range(61)} | {100: 100, 101: 100, 102: 100}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def planted(seed=4):
    """Documents of random words; some share a passage of 55 words, with other
    white space and letter case."""
    rng = random.Random(seed)
    passages = [sentences(rng, 55) for _ in range(6)]
    rows, sharing = [], set()
    for k in range(80):
        w = sentences(rng, rng.randint(30, 150))
        if k % 4 == 0:
            at = rng.randrange(len(w))
            w[at:at] = passages[k % 6]
            sharing.add(k)
        text = (" " if k % 3 else "\n ").join(w)
        rows.append((k, text.upper() if k % 8 == 0 else text))
    return rows, sharing


def test_repeated_passages_are_found_and_nothing_else(spark):
    rows, sharing = planted()
    out = substrings.repeated_passages(docs(spark, rows + ODD)).collect()
    assert {r["doc_id"] for r in out} == sharing
    words = {i: tokens(t) for i, t in rows}
    for r in out:
        run = words[r["doc_id"]][r["start_word"]:r["end_word"]]
        assert r["n_words"] == len(run) >= substrings.MIN_RUN
        other = words[r["first_doc_id"]] if r["doc_id"] != r["first_doc_id"] else None
        if other:
            assert any(other[k:k + len(run)] == run for k in range(len(other)))


def test_insertions_do_not_hide_a_repeat(spark):
    rng = random.Random(9)
    w = sentences(rng, 300)
    rows = [(1, " ".join(w)), (2, " ".join(["new", "words"] + w[:150] + ["inserted"] + w[150:]))]
    out = substrings.repeated_passages(docs(spark, rows)).where("doc_id = 2").collect()
    assert sum(r["n_words"] for r in out) > 260


def test_cut_documents_keep_first_copies_and_all_columns(spark):
    rows, sharing = planted()
    frame = docs(spark, rows + ODD)
    out = substrings.without_repeats(frame)
    assert out.columns == frame.columns and out.count() == frame.count()
    before, after = dict(rows), {r["doc_id"]: r["text"] for r in out.collect()}
    changed = {i for i in before if before[i] != after[i]}
    firsts = {r["doc_id"] for r in substrings.repeated_passages(frame).where("first").collect()}
    assert changed == sharing - firsts and firsts
    assert all(len(after[i]) < len(before[i]) for i in changed)
    assert after[900] is None and after[901] == ""
    assert substrings.op2_substrings(docs(spark, [])).count() == 0


def test_a_run_held_by_several_earlier_documents_is_one_run(spark):
    """A passage of 60 words in two documents, its middle in a still earlier one."""
    rng, rows = random.Random(6), []
    for k in range(100):
        w = sentences(rng, 60, vocabulary=5000, letters="abcdefghijklmnop")
        around = [sentences(rng, 30, vocabulary=5000, letters="qrstuvwxyz") for _ in range(6)]
        rows.append((3 * k, " ".join(around[0] + w[18:42] + around[1])))
        rows += [(3 * k + j, " ".join(around[2 * j] + w + around[2 * j + 1])) for j in (1, 2)]
    words = {}
    for r in substrings.op2_substrings(docs(spark, rows)).collect():
        words.setdefault(r["doc_id"], []).append((r["start_word"], r["end_word"], r["first"]))
    for k in range(100):
        second, third = words[3 * k + 1], words[3 * k + 2]
        # The same run in both, though the second document is the first holder of its ends.
        assert [r[:2] for r in second] == [r[:2] for r in third] and len(second) == 1 and not third[0][2]
    cut = {r["doc_id"]: tokens(r["text"]) for r in substrings.without_repeats(docs(spark, rows)).collect()}
    held = dict(rows)
    for k in range(100):
        second, third = len(cut[3 * k + 1]), len(cut[3 * k + 2])
        # What the second document is the first to hold stays there alone.
        assert third <= second <= len(tokens(held[3 * k + 1])) and third <= 100
    assert sum(len(cut[3 * k + 1]) for k in range(100)) > sum(len(cut[3 * k + 2]) for k in range(100))


def test_runs_of_few_words_are_found_and_cut_alike(spark):
    rng = random.Random(8)
    for unit in (["0"], ["a", "b"], ["x", "yy", "z"], list("pqrst")):
        run = (unit * 300)[:300]
        rows = [(k, " ".join(sentences(rng, 40 + 7 * k, letters="klmnop") + run[:300 - 9 * k] + sentences(rng, 50, letters="uvwxyz")))
                for k in range(4)] + [(9, " ".join(sentences(rng, 200)))]
        found = {r["doc_id"]: r["n_words"] for r in substrings.op2_substrings(docs(spark, rows)).collect()}
        assert set(found) == {0, 1, 2, 3} and all(n > 230 for n in found.values()), (unit, found)


def test_long_shared_passages_of_the_tables_are_found(spark):
    """Against all windows of 51 words that two documents hold."""
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r["doc_id"]: tokens(r["text"]) for r in frame.collect()}
    holders = {}
    for i, w in texts.items():
        for k in range(len(w) - 50):
            holders.setdefault(tuple(w[k:k + 51]), set()).add(i)
    want = {i: {p for k in range(len(w) - 50) if len(holders[tuple(w[k:k + 51])]) > 1 for p in range(k, k + 51)}
            for i, w in texts.items()}
    got = {i: set() for i in texts}
    for r in substrings.op2_substrings(frame).collect():
        got[r["doc_id"]].update(range(r["start_word"], r["end_word"]))
    holding = [i for i in texts if want[i]]
    assert len(holding) > 20 and sum(1 for i in holding if got[i] & want[i]) >= 0.99 * len(holding)
    # All but the words at a passage's ends, up to a chunk's length.
    covered = sum(len(got[i] & want[i]) for i in holding) / sum(len(want[i]) for i in holding)
    assert covered > 0.85, covered
    print("documents", len(holding), "words covered", covered)
