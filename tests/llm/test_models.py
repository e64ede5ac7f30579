import collections
import math
import random
import zlib

import numpy as np
import pyarrow as pa
import pytest
from helpers import ODD, docs, sentences, tokens
from pyspark.sql import functions as F

from tunnelscan.llm import mixing, mtree, toxicity


# ---- toxicity ---------------------------------------------------------------

def labelled(seed=1, n=600):
    rng = random.Random(seed)
    rows, labels = [], []
    for k in range(n):
        w, kind = sentences(rng, rng.randint(20, 120), 300), rng.choice([0, 0, 0, 1, 2])
        for _ in range(rng.randint(2, 4) if kind else 0):
            w.insert(rng.randrange(len(w)), rng.choice(["vile", "idiotic", "rotten"] if kind == 2 else ["spammy", "dull"]))
        rows.append((k, " ".join(w)))
        labels.append((k, 0 if kind == 1 else 1, 1 if kind == 2 else 0))
    return rows, labels


def test_severity_on_held_out_labels(spark):
    rows, labels = labelled()
    train = [x for x in labels if x[0] % 3]
    frame = docs(spark, rows)
    odd_labels = [(0, None, None), (None, 1, 1), (99_999, 0, 1), train[0], train[0]]
    model = toxicity.fit(frame, spark.createDataFrame(train + odd_labels, "doc_id long, quality int, toxic int"),
                         toxicity.severity_grade(F.col("quality"), F.col("toxic")))
    assert np.all(np.diff(model.thresholds) > 0)
    out = {r["doc_id"]: r for r in toxicity.severity(frame, model).withColumn("toxic", toxicity.is_toxic()).collect()}
    held = [x for x in labels if x[0] % 3 == 0]
    right = np.mean([out[i]["toxic"] == bool(t) for i, _, t in held])
    assert right > 0.97
    mean = [np.mean([out[i]["severity"] for i, q, t in held if (2 if t else 1 - q) == g]) for g in (0, 1, 2)]
    assert mean[0] < mean[1] < mean[2]
    for r in out.values():
        assert r["severity"] == pytest.approx(sum(r["exceeds"])) and r["exceeds"] == sorted(r["exceeds"], reverse=True)


def test_newton_reaches_the_maximum_of_the_likelihood():
    rng = np.random.default_rng(3)
    x = rng.random((400, 3)) < 0.4
    score = x @ np.array([1.5, -1.0, 0.7])
    grades = (score + rng.logistic(size=400) > 0.5).astype(int) + (score + rng.logistic(size=400) > 2.0)
    rows, slots = np.nonzero(x)
    t0 = np.array([0.0, 1.0])
    w, t = toxicity._newton(grades, rows, slots, t0, np.ones(3), 0.01)

    def loss(w, t):
        return -np.log(toxicity._terms(grades, x @ w, t)[0]).mean() + 0.005 * w @ w

    best = loss(w, t)
    for k in range(5):
        for d in (-1e-3, 1e-3):
            z = np.r_[w, t]
            z[k] += d
            assert loss(z[:3], z[3:]) >= best - 1e-9


def test_sample_is_bounded_and_degenerate_labels_work(spark):
    rows, labels = labelled(n=60)
    kinds = "doc_id long, quality int, toxic int"
    grade = toxicity.severity_grade(F.col("quality"), F.col("toxic"))
    frame = docs(spark, rows + ODD)
    for some in ([], [(1, 1, 0)], [(k, 1, 1) for k in range(10)]):
        model = toxicity.fit(frame, spark.createDataFrame(some, kinds), grade, sample_rows=20)
        out = toxicity.severity(frame, model).collect()
        assert len(out) == len(rows) + len(ODD) and all(math.isfinite(r["severity"]) for r in out)
        want = 2.0 if some and some[0][2] else 0.0
        assert all(abs(r["severity"] - want) < 1e-6 for r in out)
    assert toxicity.op9_toxicity(docs(spark, []), spark.createDataFrame(labels, kinds)).count() == 0


# ---- language model ---------------------------------------------------------

def corpus(seed=2, n=150):
    rng = random.Random(seed)
    vocabularies = [(sentences(rng, 300, 300, letters), letters) for letters in ("abcdefg", "hijklmno", "pqrstuvw")]
    rows = []
    for k in range(n):
        words, letters = vocabularies[k % 3]
        w = [words[min(int(rng.expovariate(0.02)), 299)] for _ in range(rng.randint(5, 150))]
        w += ["".join(rng.choice(letters) for _ in range(9))] * (k % 2)
        rows.append((k, " ".join(w)))
    return rows


def test_base_and_model_scores(spark):
    rows = corpus() + ODD + [(3, corpus()[3][1])]
    out = mixing.op10_mixing(docs(spark, rows)).collect()
    counts = collections.Counter()
    for i, t in rows:
        if zlib.crc32(("" if i is None else str(i)).encode()) % 10:
            counts.update(tokens(t) + ["\n"])
    n, v = sum(counts.values()), len(counts)
    want = collections.Counter()
    for i, t in rows:
        w = tokens(t) + ["\n"]
        held = zlib.crc32(("" if i is None else str(i)).encode()) % 10 == 0
        base = sum(math.log10((counts[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w)
        want[(i, held, len(w), sum(x in counts for x in w), n, round(base, 4))] += 1
    got = collections.Counter((r["doc_id"], r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"],
                               round(r["base_score"], 4)) for r in out)
    assert got == want
    assert all(math.isfinite(r["score"]) and r["score"] < 0 for r in out)
    held = [r for r in out if r["held_out"] and r["doc_id"] is not None and r["doc_id"] < 900]
    assert sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    for r in out:
        size = max(1, len((dict(rows).get(r["doc_id"]) or "").encode()))
        if r["doc_id"] not in (3, None):
            assert r["bits_per_byte"] * size == pytest.approx(-r["score"] * math.log2(10))


def test_probabilities_of_known_and_new_tokens_do_not_exceed_one():
    words = pa.array([a + b for a in "abcdefgh" for b in ["", *"ijklmnop"]], pa.large_string())
    c = np.arange(1, len(words) + 1, dtype=float)
    leaf = mixing.code(words)
    leaves = np.zeros((1 + mixing.KINDS, 1 << mixing.PATH))
    np.add.at(leaves[0], leaf, c)
    np.add.at(leaves[1], leaf, c)
    path = mixing.Path.blank(leaves, np.r_[3.0, 3.0, np.zeros(mixing.KINDS - 1)])
    kind = np.zeros(len(words), np.int64)
    path.learn(leaf, kind, c)
    for k in (0, 1):
        c_kind = c if k == 0 else np.zeros(len(c))
        known = 2.0 ** path.log2(leaf, kind + k, c_kind, c)
        assert 0.5 < known.sum() + path.new(kind[:1] + k)[0] <= 1 + 1e-6
    speller = mixing.Speller.blank(np.zeros((mixing.CONTEXTS, 1 << mixing.BITS, 2), np.float32))
    two = pa.array([a + b for a in map(chr, range(97, 123)) for b in ["", *map(chr, range(97, 123))]], pa.large_string())
    assert (2.0 ** speller.log2(two)).sum() < 1


def test_spelling_is_the_same_in_small_blocks(monkeypatch):
    words = pa.array(["the", "theatre", "été", "x" * 500, "a.b,c|d", "\n"], pa.large_string())
    rng = np.random.default_rng(1)
    speller = mixing.Speller.blank(rng.integers(0, 9, (mixing.CONTEXTS, 1 << mixing.BITS, 2)).astype(np.float32))
    whole = speller.log2(words)
    monkeypatch.setattr(mixing, "BLOCK", 7)
    alone = np.concatenate([speller.log2(words.slice(k, 1)) for k in range(len(words))])
    assert np.allclose(whole, alone)


def test_language_model_of_empty_tables(spark):
    assert mixing.op10_mixing(docs(spark, [])).count() == 0
    held = [(k, "a b") for k in range(200) if zlib.crc32(str(k).encode()) % 10 == 0][:3]
    out = mixing.op10_mixing(docs(spark, held)).collect()
    assert all(r["train_tokens"] == 0 and r["n_known"] == 0 and r["base_score"] == 0.0 for r in out)
    assert all(math.isfinite(r["score"]) for r in out)


# ---- search -----------------------------------------------------------------

def brute(rows, top=5):
    v = {}
    for k, (i, x, _) in enumerate(rows):
        if i is not None and x is not None and all(y is not None and math.isfinite(y) for y in x):
            v[k] = (i, [math.floor(256 * y) for y in x])
    out = set()
    for i, q in {(i, tuple(x)) for i, x in v.values() if i % 50 == 0}:
        found = sorted((-sum(a * b for a, b in zip(q, x)), j) for j, x in v.values() if j != i and len(x) == len(q))
        out |= {(i, k + 1, j, -s) for k, (s, j) in enumerate(found[:top])}
    return out


@pytest.mark.parametrize("block_rows, page", [(4096, 64), (40, 4)])
def test_search_equals_brute_force(spark, block_rows, page):
    rng = random.Random(8)
    centres = [[rng.gauss(0, 1) for _ in range(8)] for _ in range(5)]
    rows = [(k, [c + rng.gauss(0, 0.3) for c in rng.choice(centres)], 0) for k in range(400)]
    rows += [(1000 + k, centres[0], 1) for k in range(120)]                    # one crowded point: ties
    rows += [(2000, None, 0), (2050, [1.0, None] + [0.0] * 6, 0), (2100, [float("nan")] + [0.0] * 7, 0),
             (2150, [float("inf")] + [0.0] * 7, 0), (None, centres[1], 0), (2200, [1.0, 2.0], 0), (2201, [3.0, 1.0], 0),
             (2250, [], 0), (2300, [0.0] * 8, 0), (2350, [-x for x in centres[0]], 0), (2400, [100 * x for x in centres[2]], 0)]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    got = {tuple(r) for r in mtree.top_k(frame, F.col("vec_id") % 50 == 0, block_rows=block_rows, page=page).collect()}
    want = brute(rows)
    assert got == want


@pytest.mark.parametrize("routes", [1, 3])
def test_search_of_crowded_regions_in_parts(spark, monkeypatch, routes):
    # Regions routed further in several tasks, equal vectors split, many parts of the queries.
    monkeypatch.setattr(mtree, "ROUTED_BYTES", 8 * 6 * 30)
    monkeypatch.setattr(mtree, "QUERY_BLOCK", 3)
    rng = random.Random(4)
    centres = [[rng.gauss(0, 2) for _ in range(6)] for _ in range(12)]
    rows = [(k, [c + rng.gauss(0, 0.2) for c in rng.choice(centres)], 0) for k in range(500)]
    rows += [(1000 + k, centres[0], 0) for k in range(250)]
    rows += [(100, [-c for c in centres[3]], 0), (100, centres[5], 0), (150, rows[150][1], 0)]   # one id, several rows
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>, label int")
    out = mtree.top_k(frame, F.col("vec_id") % 50 == 0, block_rows=20, max_routes=routes, page=4).collect()
    assert {tuple(r) for r in out if r["query_id"] != 100} == {r for r in brute(rows) if r[0] != 100}
    # The rows of one id ask together: the best scores that any of them has.
    vectors = [(i, [math.floor(256 * y) for y in x]) for i, x, _ in rows]
    want = sorted((-sum(a * b for a, b in zip(q, x)), j) for i, q in vectors if i == 100 for j, x in vectors if j != 100)
    got = sorted((r for r in out if r["query_id"] == 100), key=lambda r: r["rank"])
    assert [(-r["score"], r["vec_id"]) for r in got] == want[:5]


def test_pages_cover_their_vectors_and_prune():
    rng = np.random.default_rng(2)
    points = np.concatenate([rng.normal(c, 0.1, (300, 4)) for c in (0, 5, 10)])
    nodes = mtree.build(points, page=16)
    rows = np.concatenate([n[4] for n in nodes if n[4] is not None])
    assert sorted(rows) == list(range(len(points)))
    for parent, centre, radius, up, at, ups in nodes:
        if at is not None:
            assert np.all(np.sqrt(((points[at] - centre) ** 2).sum(axis=1)) <= radius + 1e-9)
            assert len(at) <= 16 or ups.max() == 0
        if parent >= 0:
            assert up == pytest.approx(np.sqrt(((centre - nodes[parent][1]) ** 2).sum()))


def tree_of(v, ids, page, kind=np.int64):
    most = float((v.astype(float) ** 2).sum(axis=1).max())
    rows = [{"route": 0, "sub": 0, "piece": 0, "node": k, "parent": n[0], "centre": n[1], "radius": n[2], "up": n[3],
             "ids": [] if n[4] is None else ids[n[4]], "vectors": [] if n[4] is None else v[n[4]].ravel(),
             "ups": [] if n[4] is None else n[5]} for k, n in enumerate(mtree.build(mtree.lifted(v, most), page))]
    return mtree.Tree(pa.Table.from_pylist(rows, schema=mtree._PAGES), v.shape[1], kind), most


def test_queries_of_a_block_search_its_pages_together(monkeypatch):
    # Distances are computed once for a page and all its queries, not for each query.
    rng = np.random.default_rng(3)
    v = rng.integers(-100, 100, (700, 6))
    v[300:600] = v[300]                                        # equal vectors: ties
    ids = rng.permutation(np.r_[np.arange(690), np.arange(10)])     # and repeated ids
    tree, most = tree_of(v, ids, 16, np.float64)
    calls = []
    distances = mtree._distances
    monkeypatch.setattr(mtree, "_distances", lambda *a: calls.append(1) or distances(*a))
    monkeypatch.setattr(mtree, "SCORES", 1000)
    own, q = ids[::2], v[::2].astype(float)
    row, found, score = tree.search(own, q, most, 5, np.full(len(q), -np.inf))
    assert len(calls) <= len(tree.radius)
    for k in range(len(q)):
        want = sorted((-int(s), int(i)) for s, i in zip(v @ q[k].astype(int), ids) if i != own[k])[:5]
        assert sorted((-int(s), int(i)) for s, i in zip(score[row == k], found[row == k])) == want


def test_search_keeps_to_its_bounds():
    rng = np.random.default_rng(5)
    v = rng.integers(-100, 100, (400, 4))
    for kind, none in ((np.float64, -np.inf), (np.int64, mtree._LONG[0]), (object, -np.inf)):
        tree, most = tree_of(v, np.arange(400), 8, kind)
        q, scores = v[:50], v[:50] @ v.T
        bound = np.array([none if k % 2 else int(np.sort(scores[k])[-3]) for k in range(50)], object).astype(kind)
        row, found, score = tree.search(np.arange(50), q.astype(kind), most, 5, bound)
        for k in range(50):
            want = sorted((-int(s), i) for i, s in enumerate(scores[k]) if i != k and (k % 2 or s >= bound[k]))[:5]
            assert sorted((-int(s), int(i)) for s, i in zip(score[row == k], found[row == k])) == want


def test_search_of_empty_tables(spark):
    frame = spark.createDataFrame([], "vec_id long, embedding array<float>, label int")
    assert mtree.op5_mtree(frame).count() == 0
    one = spark.createDataFrame([(50, [1.0, 0.5], 0)], "vec_id long, embedding array<double>, label int")
    assert mtree.op5_mtree(one).count() == 0


def test_scores_do_not_depend_on_the_partitioning(spark, monkeypatch):
    # Several shards on a small table.
    monkeypatch.setattr(mixing, "WORDS_PER_TASK", 2_000)
    frame = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    seen = []
    for n in (1, 4, 7):
        rows = mixing.score_texts(frame.repartition(n)).collect()
        seen.append({r["doc_id"]: (r["score"], r["base_score"], r["bits_per_byte"]) for r in rows})
    for other in seen[1:]:
        assert other.keys() == seen[0].keys()
        assert max(abs(a - b) for i in other for a, b in zip(other[i], seen[0][i])) < 1e-9


def test_common_buckets_count_whole_texts(spark):
    # A word beyond any rank in its text, but the commonest of all.
    rng = random.Random(4)
    rows = [(k, " ".join([f"w{k}x{j}" for j in range(100) for _ in range(3)] + ["common"] * 2)) for k in range(300)]
    texts = docs(spark, rows).select("text")
    top = mixing.common_buckets(texts)
    _, coded, h = mixing._words(pa.array(["common"], pa.large_string()))
    assert int(mixing._bucket(h)[0]) in top.tolist() and len(top) == mixing.COMMON
    rng.shuffle(rows)
    assert (mixing.common_buckets(docs(spark, rows).select("text").repartition(5)) == top).all()


@pytest.mark.parametrize("scale, wide", [(2.0 ** 16, False), (2.0 ** 20, False), (2.0 ** 30, True)])
def test_search_of_large_components_is_exact(spark, scale, wide):
    rng = random.Random(5)

    def component(k, j):
        # In the wide case queries and candidates are large in different places.
        size = scale if not wide or (j < 2) == (k % 50 > 0) else 2.0
        return math.floor(rng.gauss(0, 1) * size) + rng.randrange(256) / 256

    rows = [(k, [component(k, j) for j in range(4)]) for k in range(400)]
    out_of_range = [(1000, [2.0 ** 45, 1.0, 1.0, 1.0]), (1050, [1e300, 0.0, 0.0, 0.0])]
    x = {i: [math.floor(256 * c) for c in v] for i, v in rows}
    want = set()
    for q in (i for i in x if i % 50 == 0):
        scores = sorted((-sum(a * b for a, b in zip(x[q], x[i])), i) for i in x if i != q)[:5]
        want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(scores)}
    assert (max(abs(c) for v in x.values() for c in v) ** 2 * 4 >= 2 ** 63) is wide
    frame = spark.createDataFrame(rows + out_of_range, "vec_id long, embedding array<double>")
    got = {tuple(r) for r in mtree.top_k(frame, F.col("vec_id") % 50 == 0, block_rows=64, page=16).collect()}
    if not wide:
        assert got == want
        return
    # Scores of two queries are beyond 64 bits: those are the nearest number, in either order.
    cut = lambda rows: sorted((q, k, min(s, 2 ** 63 - 1)) for q, k, _, s in rows)
    assert cut(got) == cut(want) and {r for r in got if r[3] < 2 ** 63 - 1} <= want
