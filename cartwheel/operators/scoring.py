"""Model scoring: M1-M9, A24.

Folds of boosted trees (``operators.boosting``: Newton steps on binned features
with an L2 leaf penalty, early stopping with patience on the held-out fold's
AUC). One difference remains by design: trees grow level by level (``max_depth``),
not leaf by leaf.

* Folds come from ``sampling.group_kfold`` / ``group_kfold_balanced`` /
  ``stratified_kfold``; they are trained side by side: one pass over one
  written frame grows a level of every fold's tree.
* Out-of-fold scores take one pass in which each row meets its own fold's model,
  the mean over the fold models another.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field, replace

from pyspark.ml.feature import PCA, StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cartwheel.operators import boosting, sampling
from cartwheel.operators.boosting import Booster, BoostParams
from cartwheel.session import materialize

# Presets (M2). Trees, learning rate, row and feature shares, L2
# penalty and rows of a leaf are the original's; 64 and 31 leaves become depths 6 and 5.
PRESETS = {
    "default": BoostParams(max_iter=2000, max_depth=6, learning_rate=0.05, subsample=0.8, feature_share=0.8,
                           min_rows_leaf=20, reg_lambda=1.0),
    "fast": BoostParams(max_iter=1500, max_depth=5, learning_rate=0.1, subsample=0.8, feature_share=0.8,
                        min_rows_leaf=200, reg_lambda=1.0),
}
PATIENCE = 100                     # early-stopping rounds; the original's INI sets 200
# --- end of fixed values ---


@dataclass
class KFoldResult:
    oof: DataFrame                 # training rows + fold + pred_prob (out of fold)
    pred: DataFrame                # scoring rows + pred_prob (mean over fold models)
    importance: DataFrame          # feature, importance: raw gain summed over folds
    nodes: DataFrame               # the folds' trees, a row a node
    models: list[Booster] = field(default_factory=list)
    feature_cols: list = field(default_factory=list)


def assemble(df: DataFrame, feature_cols: Sequence[str], out: str) -> DataFrame:
    """feature vector; nulls/NaN kept."""
    return VectorAssembler(inputCols=list(feature_cols), outputCol=out, handleInvalid="keep").transform(df)


def balanced_weights(df: DataFrame, label: str = "label", out: str = "_w") -> DataFrame:
    """M4: 'balanced' class weights, ``n / (2 * n_class)`` per row."""
    row = df.agg(F.count(F.lit(1)).alias("n"),
                 F.count(F.when(F.col(label) == 1, 1)).alias("p")).first()
    n, p = int(row["n"]), int(row["p"])
    q = n - p
    wp = n / (2.0 * p) if p else 1.0
    wn = n / (2.0 * q) if q else 1.0
    return df.withColumn(out, F.when(F.col(label) == 1, F.lit(wp)).otherwise(F.lit(wn)))


def score_mean(models: Sequence[Booster], df: DataFrame, feature_cols: Sequence[str]) -> DataFrame:
    """M6 / M7: mean positive probability of all models, in one projection."""
    return df.withColumn("pred_prob", boosting.probability(models, feature_cols))


def kfold_train_predict(train: DataFrame, pred: DataFrame | None, feature_cols: Sequence[str],
                        n_splits: int = 5, group_kfold: bool = True, seed: int = 42,
                        preset: str = "fast", max_iter: int | None = None,
                        early_stopping: int = PATIENCE, class_weight: str | None = "balanced",
                        balanced_groups: bool = False, parallelism: int = 4) -> KFoldResult:
    """M1-M6: k-fold training; out-of-fold scores, fold-mean prediction, importances.

    ``early_stopping`` rounds of patience on the held-out fold's AUC (as the
    original does; 0: never), ``max_iter`` trees at most (None: the preset's).
    ``parallelism`` is kept for callers: all folds share each pass.
    """
    feature_cols, n_splits = list(feature_cols), int(n_splits)
    if not group_kfold:
        folded = sampling.stratified_kfold(train, n_splits, seed)
    elif balanced_groups:
        folded = sampling.group_kfold_balanced(train, n_splits, seed)
    else:
        folded = sampling.group_kfold(train, n_splits, seed)
    weight = None
    if class_weight == "balanced":
        folded, weight = balanced_weights(folded), "_w"
    base = materialize(folded, "folds")                     # every fold reads it
    sizes = {r["fold"]: r["count"] for r in base.groupBy("fold").count().collect()}          # a row a fold
    for f in range(n_splits):
        if sum(n for g, n in sizes.items() if g != f) == 0:
            raise ValueError(f"fold {f} has no training rows: fewer users or rows than folds")
    params = PRESETS[preset] if max_iter is None else replace(PRESETS[preset], max_iter=int(max_iter))

    models = boosting.fit_folds(base, feature_cols, params, F.col("fold"), [seed + 1000 * f for f in range(n_splits)],
                                weight=weight, patience=int(early_stopping))

    oof = base.withColumn("pred_prob", boosting.probability(models, feature_cols, fold="fold")).drop("_w")
    spark = train.sparkSession
    rows = [(f, *row) for f, m in enumerate(models) for row in m.node_rows()]
    nodes = spark.createDataFrame(rows, f"fold int, {boosting.NODE_SCHEMA}")
    return KFoldResult(oof=oof, pred=score_mean(models, pred, feature_cols) if pred is not None else None,
                       importance=boosting.gain_importance(nodes, feature_cols), nodes=nodes, models=models,
                       feature_cols=feature_cols)


def fold_history(result: KFoldResult) -> DataFrame:
    """Each fold's held-out AUC by iteration, and whether the ensemble was cut there."""
    rows = [(f, i, auc, i == m.best_iteration) for f, m in enumerate(result.models) for i, auc in m.history]
    return result.oof.sparkSession.createDataFrame(rows, "fold int, iteration int, auc double, best boolean")


def pruned_features(importance: DataFrame) -> DataFrame:
    """M8 as rows: ``feature, kept``; a feature stays if any fold used it."""
    return importance.select("feature", (F.col("importance") > 0).alias("kept"))


def drop_zero_importance(importance: DataFrame, feature_cols: Sequence[str]) -> tuple[list, list]:
    """M8: the kept and the dropped features, each in the order of ``feature_cols``."""
    by_kept = pruned_features(importance).groupBy("kept").agg(F.collect_set("feature").alias("f"))
    of = {r["kept"]: set(r["f"]) for r in by_kept.collect()}          # one row per verdict
    return tuple(sorted(of.get(k, ()), key=list(feature_cols).index) for k in (True, False))


def should_retrain(kept: Sequence[str], dropped: Sequence[str], n_features: int) -> bool:
    """M8 rule: retrain only if something was dropped and enough features remain."""
    return len(dropped) > 0 and len(kept) >= max(10, int(0.7 * n_features))


def pca_embedding(df: DataFrame, feature_cols: Sequence[str], per_class: int,
                  seed: int = 42) -> tuple[DataFrame, list]:
    """M9: balanced sample, standardised (mean 0, sample std 1), 2-D PCA.

    Returns ``(x, y, label)`` rows and the explained variance of both axes.
    Axis signs are arbitrary.
    """
    sample = sampling.balanced_sample(df, per_class, seed)
    vec = assemble(sample, feature_cols, "_raw")
    scaler = StandardScaler(inputCol="_raw", outputCol="_std", withMean=True, withStd=True).fit(vec)
    std = scaler.transform(vec)
    pca = PCA(k=2, inputCol="_std", outputCol="_pc").fit(std)
    emb = pca.transform(std).select(vector_to_array("_pc").alias("_a"), "label")
    out = emb.select(F.col("_a")[0].alias("x"), F.col("_a")[1].alias("y"), "label")
    return out, pca.explainedVariance.toArray().tolist()
