"""Entry 2: features -> split -> fit every model -> evaluate train and test -> save.

The split column is written once to the shared checkpoint folder and read
back, so evaluation never re-derives it and a lost executor only recomputes
from that table, not from the raw scan.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession

from zonecast.operators import evaluation, features, models, split
from zonecast.session import drop_path, settled, shared_path
from zonecast.sources import pitch_io

DEFAULT_MODELS = ("baseline", "logistic_regression", "random_forest", "boosted_trees")


def persist_split(spark: SparkSession, df: DataFrame, key_cols: Sequence[str], **kw) -> tuple[DataFrame, str]:
    """The split table, and the shared folder it lies in (drop it after use)."""
    path = shared_path(spark, f"split-{uuid.uuid4().hex}")
    split.stratified_split(df, key_cols, **kw).write.mode("overwrite").parquet(path)
    return spark.read.parquet(path), path


def train_and_evaluate(spark: SparkSession, processed: DataFrame, key_cols: Sequence[str],
                       model_names: Sequence[str] = DEFAULT_MODELS, sizes: dict | None = None,
                       models_dir: str | None = None, metrics_base: str | None = None,
                       fit_on: str = "all") -> dict:
    """Returns {'state', 'models', 'predictions_train', 'predictions_test',
    'metrics_train', 'metrics_test'}.  ``fit_on='train'`` fits medians and
    categories on the training rows only (the default fits on all rows)."""
    sizes = sizes or {}
    s, path = persist_split(spark, processed, key_cols)
    state = features.fit_state(s.filter("split = 'train'") if fit_on == "train" else s)
    # the matrix is written once: fitting, scoring and evaluation read it, and the split table can go
    fm = settled(features.transform(s, state, keep=list(key_cols) + ["is_strike", "split"]), "matrix")
    drop_path(spark, path)
    train, test = fm.filter("split = 'train'"), fm.filter("split = 'test'")
    fitted, p_train, p_test = {}, [], []
    for name in model_names:
        if name == "baseline":
            p_train.append(models.baseline_scores(train, train, key_cols))
            p_test.append(models.baseline_scores(train, test, key_cols))
            continue
        m = models.fit_model(train, state, name, **sizes.get(name, {}))
        fitted[name] = m
        p_train.append(models.score(m, train, state, name, key_cols))
        p_test.append(models.score(m, test, state, name, key_cols))
        if models_dir:
            pitch_io.save_model(m, models_dir, name)
    pred_train = settled(_union(p_train), "predictions")
    pred_test = settled(_union(p_test), "predictions")
    out = {"state": state, "models": fitted, "predictions_train": pred_train, "predictions_test": pred_test,
           "metrics_train": settled(evaluation.metrics_by_model(pred_train), "metrics"),
           "metrics_test": settled(evaluation.metrics_by_model(pred_test), "metrics")}
    if metrics_base:
        pitch_io.save_metrics(out["metrics_train"], metrics_base + "_train")
        pitch_io.save_metrics(out["metrics_test"], metrics_base + "_test")
    if models_dir:
        state.save(spark, models_dir.rstrip("/") + "/_feature_state")
    return out


def _union(frames):
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f)
    return out


def evaluate_saved_models(spark: SparkSession, processed: DataFrame, key_cols: Sequence[str], models_dir: str,
                          metrics_base: str | None = None, include_baseline: bool = True) -> DataFrame:
    """Score every saved model (sorted by name) on the test split and return metrics.

    The split is a pure function of the key, so re-deriving it here gives the
    same rows the models were evaluated on at training time.
    """
    names = pitch_io.list_models(spark, models_dir)
    if not names:
        raise FileNotFoundError(f"{models_dir} holds no saved model")
    state = features.FeatureState.load(spark, models_dir.rstrip("/") + "/_feature_state")
    s, path = persist_split(spark, processed, key_cols)
    train, test = s.filter("split = 'train'"), s.filter("split = 'test'")
    preds = [models.baseline_scores(train, test, key_cols)] if include_baseline else []
    for n in names:
        preds.append(models.score(pitch_io.load_model(spark, models_dir, n), test, state, n, key_cols))
    metrics = settled(evaluation.metrics_by_model(_union(preds)), "metrics")
    drop_path(spark, path)
    if metrics_base:
        pitch_io.save_metrics(metrics, metrics_base + "_test")
    return metrics
