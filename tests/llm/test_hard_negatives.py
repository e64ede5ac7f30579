import math
import random

import numpy as np
from pyspark.sql import functions as F

from tunnelscan.llm import hard_negatives as H

DDL = "vec_id long, embedding array<double>, label int, route string, block int, score double, v string"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, lab, "r", 1, 0.5, "v") for i, v, lab in rows], DDL)


def brute(rows, every=100, flips=7, top=5):
    usable = set()
    for k, (i, v, lab) in enumerate(rows):
        if i is not None and lab is not None and v and all(c is not None and math.isfinite(c) for c in v):
            usable.add((k, i, tuple(math.floor(256 * c) for c in v), (lab + 1) % 10 if i % flips == 0 else lab))
    out = []
    for i, x, lab in {(i, x, lab) for _, i, x, lab in usable if i % every == 0}:
        scored = sorted((-sum(a * b for a, b in zip(x, y)), j, other == lab) for _, j, y, other in usable
                        if j != i and len(x) == len(y))
        for p, positive, _ in [e for e in scored if e[2]][:top]:
            window = [(s, j) for s, j, same in scored if not same and 80 * -p <= 100 * -s <= 100 * -p][:top]
            out += [(i, positive, k + 1, j, -p, -s) for k, (s, j) in enumerate(window)]
    return sorted(out)


def got(df):
    return sorted((r["anchor_id"], r["positive_id"], r["rank"], r["negative_id"], r["positive_score"], r["negative_score"])
                  for r in df.collect())


def grouped(seed, n, dim=8, groups=6, noise=0.15):
    rng = random.Random(seed)
    middles = [[rng.gauss(0, 0.4) for _ in range(dim)] for _ in range(groups)]
    return [(i, [c + rng.gauss(0, noise) for c in middles[rng.randrange(groups)]], rng.randrange(10)) for i in range(n)]


def anchors_of(spark, rows, every=10, **sizes):
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return H.mine(frame(spark, rows), F.col("vec_id") % every == 0, label, **sizes)


def test_equal_to_brute_force_in_small_blocks_parts_and_clusters(spark):
    rows = grouped(1, 700)
    want = brute(rows, 10)
    assert len(want) > 500
    assert got(anchors_of(spark, rows)) == want
    assert got(anchors_of(spark, rows, block_rows=64, part_rows=16, cluster_rows=8)) == want


def test_ties_and_a_vector_that_a_third_of_all_rows_hold(spark):
    rng = random.Random(4)
    rows = [(i, [rng.choice([-0.5, 0.0, 0.25, 0.5]) for _ in range(4)], rng.randrange(3)) for i in range(300)]
    rows += [(300 + i, [0.5, 0.5, 0.25, 0.0], i % 3) for i in range(150)]
    rng.shuffle(rows)
    want = brute(rows, 10)
    assert want and got(anchors_of(spark, rows, block_rows=50, part_rows=16, cluster_rows=8)) == want


def test_odd_rows(spark):
    rows = grouped(2, 200, 3) + [(None, [0.1, 0.2, 0.3], 1), (1000, None, 1), (1100, [0.1, None, 0.2], 1), (1200, [0.5, 0.5, 0.5], None),
                                 (1300, [float("nan"), 0.0, 0.0], 2), (1400, [float("inf"), 0.0, 0.0], 2), (1500, [], 2),
                                 (1600, [0.0, 0.0, 0.0], 3), (1700, [0.5, 0.5], 3), (1701, [0.5, 0.25], 3), (1702, [0.5, 0.375], 4)]
    assert got(H.op12_hard_negatives(frame(spark, rows))) == brute(rows)
    for few in ([], [(100, [0.5], 1)], [(100, [0.5], 1), (101, [0.25], 1)], [(1, [0.5], 1), (2, [0.25], 1)]):
        assert got(H.op12_hard_negatives(frame(spark, few))) == []
    # Two texts of one id, and rows twice: candidates each, equal anchors once.
    rows = grouped(3, 60, 3)
    rows += [(0, [0.3, -0.2, 0.4], 1), rows[0], (20, [0.3, -0.2, 0.4], 1)]
    result = got(anchors_of(spark, rows))
    assert set(result) == set(brute(rows, 10))
    twice = rows + rows[30:40]
    assert {r[:2] for r in got(anchors_of(spark, twice))} >= {r[:2] for r in brute(rows[30:40], 10)}


def test_large_components_are_exact(spark):
    rng = random.Random(6)
    rows = [(i, [rng.choice([-1.0, 1.0]) * rng.randrange(1, 9) * 2.0 ** 20 + rng.randrange(256) / 256 for _ in range(3)],
             rng.randrange(3)) for i in range(150)]
    want = brute(rows, 10)
    assert want and max(r[4] for r in want) > 2 ** 53
    assert got(anchors_of(spark, rows)) == want


def test_walks_end_early_where_lists_allow_it():
    rng = np.random.default_rng(5)
    middles = rng.normal(0, 60, (40, 16))
    v = np.floor(middles[rng.integers(0, 40, 8000)] + rng.normal(0, 6, (8000, 16))).astype(np.int64)
    shared = H.Shared(np.arange(8000), rng.integers(0, 3, 8000), v, True)
    own = np.flatnonzero((v @ middles[0]) > 0.9 * (middles[0] @ middles[0]))[:64]
    ends = [[H._LONG[0]]] * len(own), [[H._LONG[1]]] * len(own)
    best, scored = shared.walk(own, shared.labels[own], v[own], *ends, True, 5)
    assert scored < 0.35 * len(own) * 8000
    for k, i in enumerate(own):
        s = v @ v[i]
        same = [j for j in np.lexsort((np.arange(8000), -s)) if j != i and shared.labels[j] == shared.labels[i]][:5]
        assert [(int(s[j]), -int(j)) for j in same] == best[k][0]
