"""Churn model lifecycle on Spark ML.

Training, scoring and evaluation run on the executors: the split is exact
per class without ranking a class in one task, the classifier is Spark's
gradient-boosted trees, and early stopping reads the validation loss of
every iteration once instead of refitting repeatedly.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S
from ..functions import rules as R
from ..session import cut_lineage
from ..sources import tables as TB
from . import metrics as ME
from .features import engineer_features
from .ranking import running_totals

MODEL_VERSION = "1.0.0"


def _now() -> _dt.datetime:
    return _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)

# Reference hyper-parameters mapped onto GBTClassifier (see README).
DEFAULT_PARAMS = {
    "maxIter": 200, "maxDepth": 6, "stepSize": 0.05, "subsamplingRate": 0.8,
    "featureSubsetStrategy": "0.8", "minInstancesPerNode": 3, "seed": 42,
}
POSITIVE_WEIGHT = 3.0
PATIENCE = 20


# --- M2: exact stratified split ----------------------------------------------------------

def stratified_split(df: DataFrame, label: str = "churned_30d", key: str = "subscriber_id",
                     shares: dict | None = None, seed: int = 42) -> DataFrame:
    """Add ``split``: each class is cut into parts of exactly the given
    shares (rounded per class) in a seeded hash order of ``key``.

    Rows are ranked inside their class with distributed running totals over
    (label, hash), so no class is ever sorted in a single task.
    """
    shares = shares or {"train": 0.8, "test": 0.2}
    # md5 as text orders alike in every engine, so the split can be checked in SQL
    h = F.md5(F.concat(F.coalesce(F.col(key).cast(T.StringType()), F.lit("")), F.lit(f"|{seed}")))
    keyed = df.withColumn("_h", F.struct(F.col(label).alias("l"), h.alias("h"),
                                         F.col(key).cast(T.StringType()).alias("k")))
    ranked = running_totals(keyed.withColumn("_one", F.lit(1)), "_h", ["_one"],
                            with_grand_total=False)
    # one row per class (a bounded table): its size and the rows of the
    # classes ordered before it, which the global running count includes
    sizes = df.groupBy(F.col(label).alias("_class")).agg(F.count(F.lit(1)).alias("_n"))
    before = Window.orderBy("_class").rowsBetween(Window.unboundedPreceding, -1)
    sizes = sizes.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    # rows without a label are a class like others
    out = (ranked.join(F.broadcast(sizes), F.col(label).eqNullSafe(F.col("_class")))
                 .withColumn("cum__one", F.col("cum__one") - F.col("_before")))
    names = list(shares)
    bounds, acc = [], 0.0
    for name in names[:-1]:
        acc += shares[name]
        bounds.append((name, F.floor(F.col("_n") * F.lit(acc) + F.lit(0.5))))
    split = None
    for name, b in bounds:
        split = (F.when(F.col("cum__one") <= b, name) if split is None
                 else split.when(F.col("cum__one") <= b, name))
    split = split.otherwise(names[-1]) if split is not None else F.lit(names[-1])
    return out.select(*df.columns, split.alias("split"))


# --- M3-M5: training ---------------------------------------------------------------------------

def with_weights(df: DataFrame, label: str = "churned_30d",
                 positive_weight: float = POSITIVE_WEIGHT) -> DataFrame:
    """Class weight for positives (M4)."""
    return df.withColumn("weight", F.when(F.col(label) == 1, F.lit(positive_weight))
                         .otherwise(F.lit(1.0)))


def build_pipeline(params: dict | None = None, label: str = "churned_30d") -> Pipeline:
    p = dict(DEFAULT_PARAMS)
    p.update(params or {})
    assembler = VectorAssembler(inputCols=S.FEATURE_COLS, outputCol="features",
                                handleInvalid="keep")
    gbt = GBTClassifier(featuresCol="features", labelCol=label, weightCol="weight", **p)
    return Pipeline(stages=[assembler, gbt])


def best_iterations(losses: list[float], patience: int = PATIENCE) -> int:
    """Number of trees to keep: stop once ``patience`` rounds pass without a
    new best validation loss (M5)."""
    best, best_i = float("inf"), 0
    for i, v in enumerate(losses):
        if v < best:
            best, best_i = v, i
        elif i - best_i >= patience:
            break
    return best_i + 1


@dataclass
class TrainResult:
    model: PipelineModel
    n_trees: int
    params: dict
    metrics: DataFrame
    importance: DataFrame
    test_predictions: DataFrame
    split: DataFrame
    losses: list = field(default_factory=list)


def train(frame: DataFrame, params: dict | None = None, label: str = "churned_30d",
          patience: int = PATIENCE, early_stopping: bool = True,
          model_version: str = MODEL_VERSION, trained_at=None) -> TrainResult:
    """Features -> three-way split -> fit -> early stop on validation loss ->
    evaluate on the untouched test part (D13: the stopping set is not the
    test set)."""
    feats = engineer_features(frame)
    split = stratified_split(feats, label, shares={"train": 0.7, "validation": 0.1, "test": 0.2})
    split = with_weights(split, label)
    split = cut_lineage(split)          # read by every step below; nothing stays in memory
    train_df = split.where(F.col("split") == "train")
    val_df = split.where(F.col("split") == "validation")
    test_df = split.where(F.col("split") == "test")

    p = dict(DEFAULT_PARAMS)
    p.update(params or {})
    model = build_pipeline(p, label).fit(train_df)
    losses: list[float] = []
    n = p["maxIter"]
    if early_stopping:
        gbt = model.stages[-1]
        assembled = model.stages[0].transform(val_df)
        losses = list(gbt.evaluateEachIteration(assembled))
        n = best_iterations(losses, patience)
        if n < p["maxIter"]:
            p["maxIter"] = n
            model = build_pipeline(p, label).fit(train_df)

    preds = model.transform(test_df).select(
        "subscriber_id", F.col(label).alias("label"),
        vector_to_array("probability")[1].alias("probability"))
    train_size = train_df.count()
    metrics = ME.evaluation_record(preds, train_size=train_size,
                                   model_version=model_version, trained_at=trained_at)
    return TrainResult(model, n, p, metrics, feature_importance(frame.sparkSession, model),
                       preds, split, losses)


# --- M7 / S14 / L1-L3 ------------------------------------------------------------------------------

def feature_importance(spark: SparkSession, model: PipelineModel) -> DataFrame:
    """Feature name -> importance, one row per feature (15 rows), sorted."""
    imp = model.stages[-1].featureImportances.toArray().tolist()
    rows = [(name, float(v)) for name, v in zip(S.FEATURE_COLS, imp)]
    return (R.literal_table(spark, rows, "feature string, importance double")
                 .orderBy(F.col("importance").desc(), F.col("feature")))


# --- S13 / S15 / S16 / S17: run log, versioned save, load -----------------------------------------

def runs_path(root: str) -> str:
    return f"{root.rstrip('/')}/model_runs"


def log_run(spark: SparkSession, root: str, run_name: str, params: dict, metrics_row: dict,
            model_path: str | None, status: str) -> None:
    """Append one run record (params as a map, metrics as columns)."""
    row = {
        "run_id": uuid.uuid4().hex, "run_name": run_name,
        "params": {k: str(v) for k, v in params.items()},
        "auc_roc": metrics_row.get("auc_roc"), "f1_score": metrics_row.get("f1_score"),
        "precision": metrics_row.get("precision"), "recall": metrics_row.get("recall"),
        "train_size": metrics_row.get("train_size"), "test_size": metrics_row.get("test_size"),
        "model_version": metrics_row.get("model_version"),
        "model_path": model_path, "status": status,
        "logged_at": _now(),
    }
    schema = ("run_id string, run_name string, params map<string,string>, auc_roc double, "
              "f1_score double, precision double, recall double, train_size bigint, "
              "test_size bigint, model_version string, model_path string, status string, "
              "logged_at timestamp_ntz")
    R.literal_table(spark, [row], schema).coalesce(1).write.mode("append").parquet(runs_path(root))


def save_model(model: PipelineModel, root: str, metrics: DataFrame,
               importance: DataFrame | None = None) -> str:
    """Save into a new version directory and make it current; the version
    before stays readable as the backup (S15)."""
    spark = metrics.sparkSession
    version = _now().strftime("%Y%m%dT%H%M%S") + "-" + uuid.uuid4().hex[:8]
    path = f"{root.rstrip('/')}/models/v={version}"
    model.write().save(f"{path}/model")
    metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    if importance is not None:
        importance.coalesce(1).write.mode("overwrite").json(f"{path}/feature_importance")
    R.literal_table(spark, [(version, path, _now(), "")],
                    "version string, path string, written_at timestamp_ntz, note string") \
        .coalesce(1).write.mode("append").parquet(TB.pointer_path(f"{root.rstrip('/')}/models"))
    return path


def load_model(spark: SparkSession, root: str, back: int = 0) -> PipelineModel | None:
    """Current model (``back=1``: the backup), or None where no version was
    saved, so callers fall back to the heuristic scorer (S16). A version that
    is there but can't be read is an error, not a fallback."""
    path = TB.current_path(spark, f"{root.rstrip('/')}/models", back=back)
    if path is None:
        return None
    return PipelineModel.load(f"{path}/model")


# --- M15 ----------------------------------------------------------------------------------------------

def retrain(frame: DataFrame, root: str, params: dict | None = None, force: bool = False,
            threshold: float = S.AUC_THRESHOLD) -> dict:
    """Load -> features -> train -> gate -> save (previous kept) -> log."""
    spark = frame.sparkSession
    res = train(frame, params)
    m = res.metrics.first().asDict()
    gate = ME.release_gate(res.metrics.select("auc_roc"), threshold, force).first()
    run_name = "retrain-" + _now().strftime("%Y%m%d-%H%M")
    if gate["passed"] or force:
        path = save_model(res.model, root, res.metrics, res.importance)
        status = "promoted" if gate["passed"] else "promoted_forced"
    else:
        path, status = None, "blocked"
    log_run(spark, root, run_name, res.params, m, path, status)
    return {"status": status, "model_path": path, "n_trees": res.n_trees, **m,
            "params": json.dumps(res.params)}
