import math
import random

import numpy as np
import pytest

from tunnelscan.llm import whitening

DDL = "vec_id long, embedding array<double>, label int, x string, w int, h1 long"


def frame(spark, rows):
    return spark.createDataFrame([(i, v, 0, "x", 7, 1) for i, v in rows], DDL)


def brute(rows, top=4, weighted=False):
    """Per length: n, S, V, eigenvalues, and each row's exact deviation and projections."""
    out, usable = {}, []
    for i, v in rows:
        if v and all(c is not None and math.isfinite(c) for c in v):
            usable.append((i, tuple(math.floor(256 * c) for c in v)))
    for dim in {len(x) for _, x in usable}:
        mine = [(i, x) for i, x in usable if len(x) == dim]
        fit = [x for _, x in mine] if weighted else sorted({x for _, x in mine})
        n, sums = len(fit), [sum(c) for c in zip(*fit)]
        centred = np.array([[c - s / n for c, s in zip(x, sums)] for x in fit])
        cov = centred.T @ centred / n
        values, vectors = np.linalg.eigh(cov)
        values, vectors = values[::-1][:top], vectors[:, ::-1][:, :top]
        out[dim] = (n, sums, cov, values, vectors, mine)
    return out


def check(got, rows, top=4, weighted=False):
    for dim, (n, sums, cov, values, vectors, mine) in brute(rows, top, weighted).items():
        rank = int((values > 1e-12 * max(values.max(), 0)).sum()) if values.max() > 0 else 0
        of = [r for r in got if any(r["vec_id"] == i for i, _ in mine)] if len(brute(rows)) > 1 else got
        assert len(of) == len(mine) * rank
        byid = {}
        for r in of:
            byid.setdefault((str(r["vec_id"]), r["component"]), []).append(r)
        for k in range(rank):
            flips = set()
            for i, x in mine:
                deviation = sum((n * c - s) ** 2 for c, s in zip(x, sums))
                mine_rows = [r for r in byid[(str(i), k + 1)] if r["deviation"] == deviation]
                assert mine_rows
                want = float(np.dot([c - s / n for c, s in zip(x, sums)], vectors[:, k]) / math.sqrt(values[k]))
                r = min(mine_rows, key=lambda r: abs(abs(r["whitened"]) - abs(want)))
                assert abs(abs(r["whitened"]) - abs(want)) < 1e-8 * max(1, abs(want))
                if abs(want) > 1e-6:
                    flips.add(np.sign(want) == np.sign(r["whitened"]))
                assert r["n"] == n and abs(r["explained"] - values[k] / np.trace(cov)) < 1e-9
                assert r["identity_error"] < 1e-6
            assert len(flips) <= 1


def vectors(seed, n=300, dim=6):
    rng = random.Random(seed)
    out = [(i, [rng.gauss(0, 0.2 + 0.3 * k) for k in range(dim)]) for i in range(n)]
    hot = out[0][1]
    return out + [(n + i, list(hot)) for i in range(n // 2)]   # a third of all rows


def test_rows_equal_brute_force_with_a_hot_vector(spark):
    rows = vectors(1)
    check(whitening.op13_whitening(frame(spark, rows)).collect(), rows)


def test_weights_by_count(spark):
    rows = vectors(2, 120)
    check(whitening.whiten(frame(spark, rows), weights="count").collect(), rows, weighted=True)
    with pytest.raises(ValueError):
        whitening.whiten(frame(spark, rows), weights="twice")


def test_odd_rows(spark):
    rows = vectors(3, 60, 3) + [(None, [0.5, 0.25, -0.125]), (900, None), (901, []), (902, [0.1, None, 0.2]),
                                (903, [float("nan"), 0.0, 0.0]), (904, [float("inf"), 0.0, 0.0]), (5, [1.0, 2.0, -0.0])]
    check(whitening.op13_whitening(frame(spark, rows)).collect(), rows)
    assert whitening.op13_whitening(frame(spark, [])).collect() == []
    assert whitening.op13_whitening(frame(spark, [(1, None)])).collect() == []
    # No variance, no component; two vectors have one.
    assert whitening.op13_whitening(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).collect() == []
    two = [(1, [1.0, 2.0]), (2, [1.0, 4.0]), (3, [1.0, 4.0])]
    got = whitening.op13_whitening(frame(spark, two)).collect()
    assert {(r["vec_id"], r["component"], round(abs(r["whitened"]), 9), r["explained"]) for r in got} == {
        (1, 1, 1.0, 1.0), (2, 1, 1.0, 1.0), (3, 1, 1.0, 1.0)}


def test_lengths_apart_and_large_components(spark):
    rows = vectors(4, 40, 2) + [(1000 + i, v) for i, v in vectors(5, 40, 3)]
    check(whitening.op13_whitening(frame(spark, rows)).collect(), rows)
    large = [(i, [1e9 * k, -3e12 + i]) for i, k in enumerate([1, 2, 4, 8, 9])]
    got = whitening.whiten(frame(spark, large)).collect()
    n, sums, *_ = brute(large)[2]
    for r in got:
        x = [math.floor(256 * c) for c in large[r["vec_id"]][1]]
        assert int(r["deviation"]) == sum((n * c - s) ** 2 for c, s in zip(x, sums))
    assert {r["deviation"] for r in whitening.op13_whitening(frame(spark, large)).collect()} == {None}
