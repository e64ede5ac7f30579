import random

import numpy as np
import pytest
from pyspark.ml.tuning import ParamGridBuilder
from pyspark.sql import functions as F

from tunnelscan.operators import model as M

COLUMNS = ("a", "b", "c")


def rows(spark, n=400, seed=3):
    rng = random.Random(seed)
    data = []
    for k in range(n):
        a, b = rng.gauss(0, 1), rng.gauss(5, 3)
        data.append((f"q{k}", f"r{k % 7}", a, b, 1.0, float(a + 0.3 * b + rng.gauss(0, 1) > 1.5)))
    return spark.createDataFrame(data, "QNAME string, RDATA string, a double, b double, c double, label double")


def test_slope_is_zero_at_the_optimum_only(spark):
    df = rows(spark)
    table = np.array([[r[c] for c in (*COLUMNS, "label")] for r in df.collect()])
    x, y, reg = table[:, :3], table[:, 3], 0.1
    for max_iter, tol, near in ((500, 1e-10, True), (1, 1e-6, False)):
        fitted = M.fit_pipeline(df, M.logistic_regression(reg, max_iter, tol), COLUMNS)
        got = {r["feature"]: r["slope"] for r in M.regression_gradient(fitted, df, COLUMNS).collect()}
        w, b = fitted.stages[-1].coefficients.toArray(), fitted.stages[-1].intercept
        error = 1 / (1 + np.exp(-(x @ w + b))) - y
        s = x.std(axis=0, ddof=1)
        want = {"intercept": error.mean(), "c": 0.0}
        for k, name in enumerate(COLUMNS[:2]):
            want[name] = (error * (x[:, k] - x[:, k].mean())).mean() / s[k] + reg * w[k] * s[k]
        assert got.keys() == want.keys() and all(abs(got[k] - want[k]) < 1e-9 for k in want)
        assert (max(map(abs, got.values())) < 1e-5) is near
    with pytest.raises(ValueError):
        M.regression_gradient(M.fit_pipeline(df, M.logistic_regression().setElasticNetParam(0.5), COLUMNS), df, COLUMNS)


def test_importances_follow_the_nodes(spark, tmp_path):
    df = rows(spark)
    fitted = M.fit_pipeline(df, M.random_forest(num_trees=5, max_depth=4), COLUMNS)
    fitted.write().save(str(tmp_path / "m"))
    got = {r["feature"]: r["importance"] for r in M.importances_from_nodes(M.tree_nodes(spark, str(tmp_path / "m"))).collect()}
    want = fitted.stages[-1].featureImportances.toArray()
    assert got and all(abs(got.get(k, 0.0) - v) < 1e-9 for k, v in enumerate(want)) and abs(sum(got.values()) - 1) < 1e-9


@pytest.mark.parametrize("ranges", [1, 4, 256])
def test_areas_by_ranges(spark, ranges):
    rng = random.Random(9)
    data = [(float(rng.random() < s), round(s, 2), s) for s in (rng.random() for _ in range(3000))]
    df = spark.createDataFrame(data, "label double, ties double, exact double")
    for score in ("ties", "exact"):
        want = M.binary_metrics(df.withColumnRenamed(score, "rawPrediction"))
        got = M.area_under_curves(df, score, ranges=ranges).first().asDict()
        assert all(abs(got[k] - want[k]) < 1e-9 for k in want), (score, got, want)
    one = spark.createDataFrame([(1.0, 0.5), (0.0, 0.5)], "label double, s double")
    assert M.area_under_curves(one, "s").first().asDict() == {"areaUnderROC": 0.5, "areaUnderPR": 0.5}
    assert M.area_under_curves(one.limit(0), "s").first()["areaUnderROC"] is None


def test_folds_and_their_metrics_do_not_depend_on_the_partitioning(spark):
    df = rows(spark, 300)
    sizes, metrics = [], []
    for n in (1, 4, 7):
        given = df.repartition(n)
        folds = given.groupBy(M.fold_of(3).alias("f")).count()
        sizes.append(sorted((r["f"], r["count"]) for r in folds.collect()))
        cv = M.cross_validate(given, 3, feature_cols=COLUMNS,
                              grid=lambda rf: ParamGridBuilder().addGrid(rf.numTrees, [3]).addGrid(rf.maxDepth, [3]).build())
        metrics.append(cv.avgMetrics)
    assert sizes[0] == sizes[1] == sizes[2] and [f for f, _ in sizes[0]] == [0, 1, 2]
    assert sum(n for _, n in sizes[0]) == 300 and min(n for _, n in sizes[0]) > 60
    assert metrics[0] == metrics[1] == metrics[2]
    # Not the buckets of the train/test split.
    split = df.select(M.fold_of(3).alias("f"), (F.pmod(M.split_bucket(), F.lit(3)) == M.fold_of(3)).alias("same"))
    assert 60 < split.where("same").count() < 160
