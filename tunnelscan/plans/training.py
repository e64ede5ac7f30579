"""The training job: labelled sample -> features -> random forest -> metrics."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tunnelscan.operators.domains import registrable_domain
from tunnelscan.operators.features import generate_features
from tunnelscan.operators.model import (
    binary_metrics,
    feature_importances,
    fit_pipeline,
    multiclass_metrics,
    random_forest,
    save_model,
    split_train_test,
)
from tunnelscan.operators.prepare import clean_training_sample


def training_features(sample: DataFrame, rules: DataFrame | None = None, rdata_mode: str = "chars",
                      delimiter: str | None = None, fallback_last_label: bool | None = None,
                      preserve_case: bool = False) -> DataFrame:
    """O-08..O-10, O-14 (as ``lld``), O-41..O-53, O-20.

    ``rdata_mode='chars'`` reproduces the reference's training features (the
    answer helpers walk the characters of the RDATA string, D4); ``'array'``
    splits RDATA on ``delimiter`` so that training matches scoring.
    """
    clean = clean_training_sample(sample)
    with_domain = registrable_domain(clean, "QNAME", rules, "lld", fallback_last_label, preserve_case)
    return generate_features(with_domain, "QNAME", "lld", "RDATA", rdata_mode, delimiter)


@dataclass
class TrainingResult:
    model: PipelineModel
    features: DataFrame
    train: DataFrame
    test: DataFrame
    predictions: DataFrame
    model_path: str | None

    def metrics(self, num_bins: int = 0) -> dict:
        """O-65..O-67 as plain numbers (six values)."""
        out = binary_metrics(self.predictions, num_bins=num_bins)
        row = multiclass_metrics(self.predictions).first()
        out.update(row.asDict())
        return out

    def counts(self) -> DataFrame:
        """O-40 for training: rows with features, those without a domain (NULL
        name features, which the assembler skips), train rows, test rows."""
        parts = [("feature_rows", self.features),
                 ("undomained_rows", self.features.where(F.col("lld").isNull())), ("train_rows", self.train), ("test_rows", self.test)]
        out = None
        for name, df in parts:
            one = df.agg(F.count(F.lit(1)).alias("rows")).select(F.lit(name).alias("stage"), "rows")
            out = one if out is None else out.unionByName(one)
        return out

    def importances(self, spark: SparkSession) -> DataFrame:
        return feature_importances(spark, self.model)


def train(sample: DataFrame, rules: DataFrame | None = None, rdata_mode: str = "chars",
          delimiter: str | None = None, classifier=None, split: str = "hash",
          save_root: str | None = None, partitions: int | None = None,
          fallback_last_label: bool | None = None, preserve_case: bool = False) -> TrainingResult:
    """Train, predict the hold-out rows and optionally save.

    ``partitions``: a fixed number for a reproducible forest (its bagging
    depends on the partitioning); None leaves it to Spark."""
    feats = training_features(sample, rules, rdata_mode, delimiter, fallback_last_label, preserve_case)
    if partitions:
        feats = feats.repartition(partitions)
    feats = feats.checkpoint(eager=True)
    train_df, test_df = split_train_test(feats, method=split)
    model = fit_pipeline(train_df, classifier if classifier is not None else random_forest())
    # Six evaluator passes read the predictions: materialise them once.
    pred = model.transform(test_df).checkpoint(eager=True)
    path = save_model(model, save_root) if save_root else None
    return TrainingResult(model, feats, train_df, test_df, pred, path)


def run_training_job(spark: SparkSession, input_path: str, model_save_root: str,
                     rules: DataFrame | None = None, rdata_mode: str = "chars",
                     delimiter: str | None = None, split: str = "hash", classifier=None,
                     partitions: int | None = None, num_bins: int = 0, fallback_last_label: bool | None = None,
                     preserve_case: bool = False) -> tuple[str, dict]:
    """The training job with the reference's options as parameters: reads the
    '~' sample, trains, evaluates, saves; returns (model path, six metrics)."""
    from tunnelscan.sources.readers import read_training_sample
    result = train(read_training_sample(spark, input_path), rules, rdata_mode, delimiter, classifier, split,
                   model_save_root, partitions, fallback_last_label, preserve_case)
    return result.model_path, result.metrics(num_bins)
