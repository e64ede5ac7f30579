"""Model stages: split, assembly, classifiers, evaluation, persistence (O-05,
O-06, O-60..O-70).  All fitting and scoring is MLlib, distributed."""

from __future__ import annotations

import datetime
from typing import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import (
    DecisionTreeClassifier,
    LogisticRegression,
    RandomForestClassifier,
)
from pyspark.ml.evaluation import BinaryClassificationEvaluator, MulticlassClassificationEvaluator
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.tuning import CrossValidator, ParamGridBuilder
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tunnelscan.operators.joins import materialise
from tunnelscan.schemas import FEATURE_COLUMNS

# The reference's model settings.
SEED = 42
NUM_TREES = 50
MAX_DEPTH = 9
IMPURITY = "entropy"
FEATURE_SUBSET = "auto"
MODEL_NAME = "RandomForestClassifier_v1.0"
TRAIN_FRACTION = 0.8


def split_bucket(hash_cols: Sequence[str] = ("QNAME", "RDATA"), seed: int = SEED) -> "F.Column":
    """0..999 from md5 of the '|'-joined columns and the seed (first 8 hex
    digits): the same bucket in any engine that has md5."""
    joined = F.concat_ws("|", *[F.col(c) for c in hash_cols], F.lit(str(seed)))
    return F.pmod(F.conv(F.substring(F.md5(joined), 1, 8), 16, 10).cast("long"), F.lit(1000))


def split_train_test(df: DataFrame, train_fraction: float = TRAIN_FRACTION, seed: int = SEED,
                     method: str = "hash", hash_cols: Sequence[str] = ("QNAME", "RDATA")):
    """O-60.  ``hash`` (default): a row goes to train when its md5 bucket
    (``split_bucket``) is below 1000 * fraction - stable under any
    partitioning and reproducible outside Spark (D19).  ``xxhash``: the same
    with ``pmod(xxhash64(cols, seed), 1000)``.  ``random``: ``randomSplit``
    as the reference does."""
    if method == "random":
        return df.randomSplit([train_fraction, 1.0 - train_fraction], seed=seed)
    if method == "hash":
        bucket = split_bucket(hash_cols, seed)
    elif method == "xxhash":
        bucket = F.pmod(F.xxhash64(*[F.col(c) for c in hash_cols], F.lit(seed)), F.lit(1000))
    else:
        raise ValueError(f"unknown split method {method!r}")
    cut = int(round(1000 * train_fraction))
    return df.where(bucket < cut), df.where(bucket >= cut)


def assembler(feature_cols: Sequence[str] = FEATURE_COLUMNS) -> VectorAssembler:
    """O-61: rows with a NULL/NaN feature are skipped."""
    return VectorAssembler(inputCols=list(feature_cols), outputCol="features", handleInvalid="skip")


def random_forest(num_trees: int = NUM_TREES, max_depth: int = MAX_DEPTH, impurity: str = IMPURITY,
                  feature_subset: str = FEATURE_SUBSET, seed: int = SEED) -> RandomForestClassifier:
    """O-62."""
    return RandomForestClassifier(numTrees=num_trees, featureSubsetStrategy=feature_subset,
                                  impurity=impurity, maxDepth=max_depth, seed=seed)


def logistic_regression(reg_param: float = 0.1, max_iter: int = 100, tol: float = 1e-6) -> LogisticRegression:
    """O-69 (dormant alternative)."""
    return LogisticRegression(regParam=reg_param, maxIter=max_iter, tol=tol)


def regression_gradient(model: PipelineModel, rows: DataFrame, feature_cols: Sequence[str] = FEATURE_COLUMNS,
                        label_col: str = "label") -> DataFrame:
    """The slope of the penalised mean log loss at a fitted binary regression, by
    feature and for the ``intercept``, in units of the feature's deviation: near
    zero everywhere where the fit is the optimum, as the loss is convex.

    One aggregate over the rows that were fitted.  MLlib penalises the weights of
    standardised features: the slope of the penalty is reg * weight * deviation.
    A feature without deviation has no weight and no slope."""
    fitted = model.stages[-1]
    if fitted.getElasticNetParam() or not fitted.getStandardization():
        raise ValueError("the slope is that of a quadratic penalty on standardised features")
    reg, weights = fitted.getRegParam(), fitted.coefficients.toArray().tolist()
    usable = rows.where(" and ".join(f"`{c}` is not null and not isnan(`{c}`)" for c in feature_cols))
    x = [F.col(f"`{c}`").cast("double") for c in feature_cols]
    margin = F.lit(float(fitted.intercept))
    for c, w in zip(x, weights):
        margin = margin + c * F.lit(float(w))
    error = 1 / (1 + F.exp(-margin)) - F.col(label_col)
    one = usable.withColumn("__e", error).agg(
        F.avg("__e").alias("__intercept"), *[F.avg(F.col("__e") * c).alias(f"__g{k}") for k, c in enumerate(x)],
        *[F.stddev_samp(c).alias(f"__s{k}") for k, c in enumerate(x)],
        *[F.avg(c).alias(f"__m{k}") for k, c in enumerate(x)])
    entries = [F.struct(F.lit("intercept").alias("feature"), F.col("__intercept").alias("slope"))]
    for k, (name, w) in enumerate(zip(feature_cols, weights)):
        s = F.col(f"__s{k}")
        # Around the mean: the slope of the standardised feature's weight.
        slope = (F.col(f"__g{k}") - F.col(f"__m{k}") * F.col("__intercept")) / s + F.lit(reg * float(w)) * s
        entries.append(F.struct(F.lit(name).alias("feature"), F.when(s > 0, slope).otherwise(F.lit(0.0)).alias("slope")))
    return one.select(F.inline(F.array(*entries)))


def decision_tree(max_depth: int = 5, seed: int = SEED) -> DecisionTreeClassifier:
    """O-69 (dormant alternative)."""
    return DecisionTreeClassifier(maxDepth=max_depth, seed=seed)


def fit_pipeline(train: DataFrame, classifier=None,
                 feature_cols: Sequence[str] = FEATURE_COLUMNS) -> PipelineModel:
    """O-63: assembler + classifier."""
    clf = classifier if classifier is not None else random_forest()
    return Pipeline(stages=[assembler(feature_cols), clf]).fit(train)


def binary_metrics(pred: DataFrame, label_col: str = "label", num_bins: int = 0) -> dict:
    """O-65, O-66 (areaUnderROC, areaUnderPR).  ``num_bins=0`` takes every
    distinct score as a threshold; MLlib's own default is 1000 bins (D18)."""
    ev = BinaryClassificationEvaluator(rawPredictionCol="rawPrediction", labelCol=label_col,
                                       numBins=num_bins)
    return {"areaUnderROC": ev.setMetricName("areaUnderROC").evaluate(pred),
            "areaUnderPR": ev.setMetricName("areaUnderPR").evaluate(pred)}


# Score ranges that are summed apart; each is one task's window.
SCORE_RANGES = 256


def area_under_curves(pred: DataFrame, score: str | "F.Column", label_col: str = "label", ranges: int = SCORE_RANGES) -> DataFrame:
    """O-65, O-66 as DataFrame steps: ``areaUnderROC`` and ``areaUnderPR`` with every
    distinct score as a threshold; rows of equal score enter together.

    Rows are counted by score, the scores dealt to ranges between their
    approximate quantiles, and summed from the top inside each range; what lies in
    the ranges above is added from a table with one row for each range.  So no
    window holds more than a range, and the sums are exact."""
    scores = pred.select(F.col(score).alias("s") if isinstance(score, str) else score.alias("s"),
                         F.col(label_col).cast("double").alias("y"))
    counts = scores.groupBy("s").agg(F.sum("y").alias("p"), F.sum(1 - F.col("y")).alias("n")).checkpoint(eager=True)
    shares = [k / ranges for k in range(1, ranges)]
    cuts = counts.agg(F.percentile_approx("s", shares, 10_000).alias("c")).first()["c"]
    cuts = F.array(*[F.lit(float(c)) for c in sorted(set(cuts or []))]).cast("array<double>")
    # Larger scores in smaller ranges: the sums start at the top.
    dealt = counts.withColumn("r", F.size(F.filter(cuts, lambda c: c > F.col("s"))))
    # One row for each range: the sums of the ranges above it.
    before, p0, n0 = [], 0.0, 0.0
    for r in dealt.groupBy("r").agg(F.sum("p").alias("p"), F.sum("n").alias("n")).orderBy("r").collect():
        before.append((r["r"], p0, n0))
        p0, n0 = p0 + r["p"], n0 + r["n"]
    before = pred.sparkSession.createDataFrame(before, "r int, p0 double, n0 double")
    inside = Window.partitionBy("r").orderBy(F.desc("s")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    at = dealt.join(F.broadcast(before), "r").select(
        "p", "n", (F.col("p0") + F.sum("p").over(inside)).alias("tp"), (F.col("n0") + F.sum("n").over(inside)).alias("fp"))
    # A threshold's trapezoid needs the point before it: its own rows taken away.  The
    # curve of precision starts at the precision of the first point.
    tp0, fp0 = F.col("tp") - F.col("p"), F.col("fp") - F.col("n")
    precision = F.col("tp") / (F.col("tp") + F.col("fp"))
    precision0 = F.when(tp0 + fp0 > 0, tp0 / F.nullif(tp0 + fp0, F.lit(0.0))).otherwise(precision)
    all_p, all_n = F.sum("p"), F.sum("n")
    return at.agg((F.sum(F.col("n") * (F.col("tp") + tp0) / 2) / all_n / all_p).alias("areaUnderROC"),
                  (F.sum(F.col("p") * (precision + precision0) / 2) / all_p).alias("areaUnderPR"))


def confusion_matrix(pred: DataFrame, label_col: str = "label",
                     prediction_col: str = "prediction") -> DataFrame:
    return (pred.groupBy(F.col(label_col).cast("double").alias("label"),
                         F.col(prediction_col).cast("double").alias("prediction"))
            .agg(F.count(F.lit(1)).alias("n")))


def multiclass_metrics(pred: DataFrame, label_col: str = "label",
                       prediction_col: str = "prediction") -> DataFrame:
    """O-67 in one pass: accuracy, weightedRecall, weightedPrecision, f1 from
    the confusion matrix (the same definitions as MulticlassClassificationEvaluator:
    per-label precision is 0 when nothing was predicted as that label)."""
    cm = confusion_matrix(pred, label_col, prediction_col)
    by_label = cm.groupBy("label").agg(
        F.sum("n").alias("n_label"),
        F.sum(F.when(F.col("label") == F.col("prediction"), F.col("n")).otherwise(0)).alias("tp"))
    by_pred = cm.groupBy(F.col("prediction").alias("p")).agg(F.sum("n").alias("n_pred"))
    per = by_label.join(by_pred, F.col("label") == F.col("p"), "left")
    prec = F.when(F.coalesce(F.col("n_pred"), F.lit(0)) > 0, F.col("tp") / F.col("n_pred")).otherwise(0.0)
    rec = F.col("tp") / F.col("n_label")
    per = per.select("n_label", "tp", prec.alias("prec"), rec.alias("rec"))
    f1 = F.when(F.col("prec") + F.col("rec") > 0,
                2 * F.col("prec") * F.col("rec") / (F.col("prec") + F.col("rec"))).otherwise(0.0)
    total = F.sum("n_label")
    return per.agg(
        (F.sum("tp") / total).alias("accuracy"),
        (F.sum(F.col("n_label") * F.col("rec")) / total).alias("weightedRecall"),
        (F.sum(F.col("n_label") * F.col("prec")) / total).alias("weightedPrecision"),
        (F.sum(F.col("n_label") * f1) / total).alias("f1"),
    )


def evaluator_metrics(pred: DataFrame, label_col: str = "label") -> dict:
    """O-67 with MLlib's evaluator (cross-check of ``multiclass_metrics``)."""
    mce = MulticlassClassificationEvaluator(predictionCol="prediction", labelCol=label_col)
    return {m: mce.setMetricName(m).evaluate(pred)
            for m in ("accuracy", "weightedRecall", "weightedPrecision", "f1")}


def feature_importances(spark: SparkSession, model: PipelineModel,
                        feature_cols: Sequence[str] = FEATURE_COLUMNS) -> DataFrame:
    """O-68: importances of the last stage, one row per named feature."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(name, float(v)) for name, v in zip(feature_cols, imp)]
    schema = T.StructType([T.StructField("feature", T.StringType()),
                           T.StructField("importance", T.DoubleType())])
    return spark.createDataFrame(rows, schema)


def importances_from_nodes(nodes: DataFrame) -> DataFrame:
    """O-68 from a saved forest's node table: for each tree the gains of its splits,
    weighted by the rows that reach them, as shares of the tree; their mean over the
    trees that split at all, as shares."""
    weight = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    by_tree = nodes.where("left >= 0").groupBy("tree", "feature").agg(F.sum(F.col("gain") * weight).alias("g"))
    share = F.col("g") / F.sum("g").over(Window.partitionBy("tree"))
    by_feature = by_tree.withColumn("share", share).groupBy("feature").agg(F.sum("share").alias("s"))
    # At most one row for each feature.
    return by_feature.select("feature", (F.col("s") / F.sum("s").over(Window.partitionBy(F.lit(0)))).alias("importance"))


def model_path(root: str, name: str = MODEL_NAME, when: datetime.datetime | None = None) -> str:
    stamp = (when or datetime.datetime.now()).strftime("%Y%m%d-%H%M%S")
    return f"{root}_{name}_{stamp}.mml"


def save_model(model: PipelineModel, root: str, name: str = MODEL_NAME,
               when: datetime.datetime | None = None) -> str:
    """O-05: overwrite-save under ``<root>_<name>_<time>.mml``; returns the path."""
    path = model_path(root, name, when)
    model.write().overwrite().save(path)
    return path


def load_model(path: str) -> PipelineModel:
    """O-06."""
    return PipelineModel.load(path)


def default_grid(rf: RandomForestClassifier) -> list:
    return (ParamGridBuilder().addGrid(rf.numTrees, [10, NUM_TREES])
            .addGrid(rf.maxDepth, [5, MAX_DEPTH]).build())


def tree_nodes(spark: SparkSession, path: str, stage: int = 1) -> DataFrame:
    """The nodes of a saved forest: ``tree``, ``node``, ``left``, ``right`` (-1
    in a leaf), ``feature``, ``threshold``, the split's ``gain`` and the class counts
    ``stats``.

    ``path``: a saved pipeline model; ``stage``: where the forest is in it."""
    data = spark.read.parquet(f"{path}/stages/{stage}_*/data")
    n = F.col("nodeData")
    return data.select(F.col("treeID").alias("tree"), n["id"].alias("node"), n["leftChild"].alias("left"),
                       n["rightChild"].alias("right"), n["split"]["featureIndex"].alias("feature"),
                       F.get(n["split"]["leftCategoriesOrThreshold"], F.lit(0)).alias("threshold"), n["gain"].alias("gain"),
                       n["impurityStats"].alias("stats"))


def vote(rows: DataFrame, nodes: DataFrame, id_cols: Sequence[str], vector: str, max_depth: int = MAX_DEPTH) -> DataFrame:
    """The forest's decision spelled out as joins: every row walks down every
    tree, the leaves' class shares are added up, the first largest wins.

    An independent check of MLlib's predictions (``id_cols`` name a row); the
    node table, at most 2 ** (depth + 1) nodes for each tree, is measured and
    broadcast if it is under the bounds."""
    nodes = materialise(nodes).for_join()
    trees = sorted(r["tree"] for r in nodes.select("tree").distinct().collect())
    at = rows.select(*id_cols, F.col(vector).alias("__x"), F.explode(F.array(*map(F.lit, trees))).alias("tree"),
                     F.lit(0).alias("__at"))
    table = nodes.select(F.col("tree").alias("__t"), F.col("node").alias("__n"), "left", "right", "feature", "threshold")
    for _ in range(max_depth):
        here = at.join(table, (F.col("tree") == F.col("__t")) & (F.col("__at") == F.col("__n")))
        down = F.when(F.get("__x", F.col("feature")) <= F.col("threshold"), F.col("left")).otherwise(F.col("right"))
        at = here.select(*id_cols, "__x", "tree", F.when(F.col("left") < 0, F.col("__at")).otherwise(down).alias("__at"))
    leaves = nodes.select(F.col("tree").alias("__t"), F.col("node").alias("__n"), "stats")
    at = at.join(leaves, (F.col("tree") == F.col("__t")) & (F.col("__at") == F.col("__n")))
    total = F.aggregate("stats", F.lit(0.0), lambda a, x: a + x)
    classes = at.select(*id_cols, F.posexplode(F.transform("stats", lambda x: x / total)).alias("__k", "__p"))
    sums = classes.groupBy(*id_cols, "__k").agg(F.sum("__p").alias("__p"))
    best = F.max_by("__k", F.struct(F.round("__p", 9), -F.col("__k")))
    return sums.groupBy(*id_cols).agg(best.cast("double").alias("vote"))


FOLD_SALT = "fold"


def fold_of(num_folds: int, seed: int = SEED, hash_cols: Sequence[str] = ("QNAME", "RDATA")) -> "F.Column":
    """The fold of a row from md5 of its columns: the same under any partitioning.

    Another salt than the train/test split's, so folds are no parts of its buckets."""
    return F.pmod(split_bucket(hash_cols, f"{seed}|{FOLD_SALT}"), F.lit(num_folds)).cast("int")


def cross_validate(train: DataFrame, num_folds: int = 3, seed: int = SEED,
                   feature_cols: Sequence[str] = FEATURE_COLUMNS, parallelism: int = 2, grid=default_grid,
                   hash_cols: Sequence[str] = ("QNAME", "RDATA"), partitions: int | None = None):
    """O-70: a grid over the forest's parameters (``grid``: a function from the
    classifier to the list of parameter maps; default size and depth), by area
    under ROC.

    The folds come from ``fold_of``.  A forest's bagging depends on the order of its
    rows, so they are dealt by hash to ``partitions`` (Spark's shuffle partitions by
    default) and sorted: the metrics are the same however ``train`` is partitioned."""
    rf = random_forest()
    pipe = Pipeline(stages=[assembler(feature_cols), rf])
    n = partitions or int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [*hash_cols, *[c for c in ("label", *feature_cols) if c not in hash_cols]]
    rows = train.withColumn("fold", fold_of(num_folds, seed, hash_cols)).repartition(n, *hash_cols).sortWithinPartitions(*order)
    cv = CrossValidator(estimator=pipe, estimatorParamMaps=grid(rf),
                        evaluator=BinaryClassificationEvaluator(metricName="areaUnderROC", numBins=0),
                        numFolds=num_folds, seed=seed, parallelism=parallelism, foldCol="fold")
    return cv.fit(rows.checkpoint(eager=True))
