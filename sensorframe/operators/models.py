"""Occupancy classifier on window features with Spark ML."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StructField, StructType
from pyspark.sql.window import Window

from .metrics import average_precision, binary_metrics, fold_summary
from .splits import blind_last_days
from .windows import OWN, in_blocks


def window_features(df: DataFrame, features: list[str], lookback: int, keys: list[str], ts: str = "timestamp") -> DataFrame:
    """Mean, spread, least, greatest and last of each feature over the last ``lookback`` rows of its key; full windows only."""
    last = Window.partitionBy(*keys, "_block").orderBy("_rn").rowsBetween(-(lookback - 1), Window.currentRow)
    out = in_blocks(df, keys, [ts], lookback - 1)
    made = {}
    for c in features:
        v = F.col(c).cast("double")
        made |= {f"{c}_avg": F.avg(v).over(last), f"{c}_sd": F.stddev_pop(v).over(last), f"{c}_min": F.min(v).over(last), f"{c}_max": F.max(v).over(last), f"{c}_now": F.coalesce(v, F.avg(v).over(last))}
    return out.select("*", *(F.coalesce(x, F.lit(0.0)).alias(n) for n, x in made.items())).where((F.col("_rn") >= lookback) & ~F.col("_halo")).drop(*OWN)


def model_columns(features: list[str]) -> list[str]:
    return [f"{c}_{s}" for c in features for s in ("avg", "sd", "min", "max", "now")]


def fit_occupancy(rows: DataFrame, features: list[str], label: str = "occupied", iterations: int = 30) -> PipelineModel:
    """A weighted logistic regression: positives weigh as negatives do together (L04, L05). Rows without label are left out; none with one is an error.

    Rows of one class make a model that says that class: probability 1, or 0.
    """
    known = rows.where(F.col(label).isNotNull()).persist()  # each pass of the fit reads it
    weighted = _weighted(known, label)
    stages = [
        VectorAssembler(inputCols=model_columns(features), outputCol="_raw"), StandardScaler(inputCol="_raw", outputCol="_x", withMean=True, withStd=True),
        LogisticRegression(featuresCol="_x", labelCol=label, weightCol="_w", maxIter=iterations, regParam=0.01, probabilityCol="_prob", rawPredictionCol="_margin", predictionCol="_pred"),
    ]
    model = Pipeline(stages=stages).fit(weighted)
    known.unpersist()
    return model


def _weighted(rows: DataFrame, label: str) -> DataFrame:
    """The labelled rows with _w, by which positives weigh as negatives do together, and the label as a number. Without negatives each row weighs 1, as no fit takes rows that weigh nothing."""
    known = rows.where(F.col(label).isNotNull())
    n = known.agg(F.count_if(F.col(label) == 1).alias("p"), F.count_if(F.col(label) == 0).alias("n")).first()
    if not n["p"] + n["n"]:
        raise ValueError("no labelled rows")
    weight = n["n"] / max(n["p"], 1) if n["n"] else 1.0
    return known.withColumn("_w", F.when(F.col(label) == 1, weight).otherwise(1.0)).withColumn(label, F.col(label).cast("double"))


def loss_by_round(model: PipelineModel, rows: DataFrame, label: str = "occupied") -> list[float]:
    """The weighted loss on labelled rows after each round of boosted trees: a number a round."""
    return [float(x) for x in model.stages[-1].evaluateEachIteration(model.stages[0].transform(_weighted(rows, label)))]


def fit_boosted(rows: DataFrame, features: list[str], rounds: int, label: str = "occupied", depth: int = 3, seed: int = 7) -> PipelineModel:
    """Boosted trees of so many rounds, positives weighing as negatives do together (L04, L05). The trees of fewer rounds are the first of those of more."""
    weighted = _weighted(rows, label)
    trees = GBTClassifier(featuresCol="_x", labelCol=label, weightCol="_w", maxIter=rounds, maxDepth=depth, stepSize=0.2, seed=seed, predictionCol="_pred")
    trees = trees.setRawPredictionCol("_margin").setProbabilityCol("_prob")
    return Pipeline(stages=[VectorAssembler(inputCols=model_columns(features), outputCol="_x"), trees]).fit(weighted)


def best_rounds(rows: DataFrame, folds: DataFrame, features: list[str], most_rounds: int = 20, ts: str = "timestamp", label: str = "occupied") -> DataFrame:
    """fold, best_epoch, best_loss and pr_auc: the boosting round after which the loss on a fold's validation rows is least, and the average precision there of the model that stops at it.

    A fold is fitted once for the curve of losses, a number a round, and once more up to its best round. A fold whose training rows have one class only has best_epoch 0 and no score.
    """
    dated = rows.withColumn("date", F.col(ts).cast("date")).where(F.col(label).isNotNull())
    out = []
    for fold in [r["fold"] for r in folds.select("fold").distinct().orderBy("fold").collect()]:
        part = dated.join(folds.where(F.col("fold") == fold), "date").persist()  # the fits read it again and again
        train, held = part.where("role = 'train'"), part.where("role = 'validation'")
        if train.select(label).distinct().count() < 2 or held.isEmpty():
            out.append((fold, 0, None, None))
        else:
            model = fit_boosted(train, features, most_rounds, label)
            curve = loss_by_round(model, held, label)
            best = min(range(len(curve)), key=lambda k: (curve[k], k)) + 1
            stopped = fit_boosted(train, features, best, label)
            score = average_precision(predict(stopped, held, [ts], label).withColumnRenamed("y_true", "y")).first()["pr_auc"]
            out.append((fold, best, curve[best - 1], score))
        part.unpersist()
    schema = StructType([StructField("fold", IntegerType()), StructField("best_epoch", IntegerType()), StructField("best_loss", DoubleType()), StructField("pr_auc", DoubleType())])
    return rows.sparkSession.createDataFrame(out, schema)  # a row a fold


def fit_at_best_round(rows: DataFrame, folds: DataFrame, features: list[str], most_rounds: int = 20, ts: str = "timestamp", label: str = "occupied") -> tuple[PipelineModel, DataFrame, dict[str, float]]:
    """The model fitted to all rows for as many rounds as the folds say (L09: the rounded-up median of their best rounds), the folds' rounds and scores, and their summary."""
    found = best_rounds(rows, folds, features, most_rounds, ts, label)
    summary = fold_summary(found, most_epochs=most_rounds).first().asDict()
    return fit_boosted(rows, features, summary["epochs"], label), found, summary


def same_window(candidate: DataFrame, production: DataFrame, keys: list[str], label: str = "y_true", score: str = "probability") -> DataFrame:
    """Two models on the same windows (L08): rows, pr_auc, brier and log_loss of the candidate, and production_pr_auc of what is in production.

    Both frames are prediction tables (L06) with the keys, the label and a probability, of the same windows: a key that one of them lacks, that repeats, or whose labels differ is an error, since scores of unlike windows do not compare.
    """
    a = candidate.select(*keys, F.col(label).alias("y"), F.col(score).alias("probability"))
    b = production.select(*(F.col(k).alias(f"_p_{k}") for k in keys), F.col(label).alias("_y"), F.col(score).alias("_p"))
    same = F.lit(True)
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_p_{k}"))
    n = lambda df: df.groupBy(*df.columns[: len(keys)]).count().where("count > 1").limit(1).count()
    if n(a) or n(b):
        raise ValueError("a window is there twice")
    both = a.withColumn("_a", F.lit(1)).join(b.withColumn("_b", F.lit(1)), same, "full_outer").persist()  # it is checked and then scored
    try:
        odd = both.agg(F.count_if(F.col("_a").isNull() | F.col("_b").isNull()).alias("lacking"), F.count_if(F.col("_a").isNotNull() & F.col("_b").isNotNull() & ~F.col("y").eqNullSafe(F.col("_y"))).alias("unlike")).first()
        if odd["lacking"] or odd["unlike"]:
            raise ValueError(f"{odd['lacking']} windows are not in both, {odd['unlike']} have other labels")
        known = both.where("y IS NOT NULL")
        own = binary_metrics(known).select(F.col("n").alias("rows"), "brier", "log_loss", F.col("positives").alias("positive_windows"))
        scores = average_precision(known).crossJoin(average_precision(known.select("y", F.col("_p").alias("probability"))).withColumnRenamed("pr_auc", "production_pr_auc")).crossJoin(own).first()  # a row each
    finally:
        both.unpersist()
    names = ["rows", "pr_auc", "production_pr_auc", "brier", "log_loss", "positive_windows"]
    return candidate.sparkSession.createDataFrame([tuple(scores[c] for c in names)], "rows long, pr_auc double, production_pr_auc double, brier double, log_loss double, positive_windows long")


def predict(model: PipelineModel, rows: DataFrame, keep: list[str], label: str | None = "occupied", split: str | None = None) -> DataFrame:
    """Prediction table: the kept columns, y_true, probability, split (L06). A model that makes a column ``probability`` is taken at its word."""
    out = model.transform(rows.drop("_w"))
    probability = F.col("probability") if "probability" in out.columns and "probability" not in rows.columns else vector_to_array("_prob")[1]
    extra = ([F.col(label).cast("int").alias("y_true")] if label else []) + ([F.lit(split).alias("split")] if split else [])
    return out.select(*keep, *extra, probability.alias("probability"))


def cross_validate(rows: DataFrame, folds: DataFrame, features: list[str], ts: str = "timestamp", label: str = "occupied") -> DataFrame:
    """Average precision of each fold's validation rows (L05); ``folds`` has fold, date, role. One fit a fold."""
    dated = rows.withColumn("date", F.col(ts).cast("date"))
    out = None
    for f in [r["fold"] for r in folds.select("fold").distinct().orderBy("fold").collect()]:
        part = dated.join(folds.where(F.col("fold") == f), "date")
        model = fit_occupancy(part.where("role = 'train'"), features, label)
        scored = predict(model, part.where(F.col("role") == "validation").where(F.col(label).isNotNull()), [ts], label).withColumnRenamed("y_true", "y")
        one = average_precision(scored).withColumn("fold", F.lit(f))
        out = one if out is None else out.unionByName(one)
    return rows.sparkSession.createDataFrame([], "pr_auc double, fold int") if out is None else out


def select_and_test(rows: DataFrame, folds: DataFrame, candidates: dict[str, list[str]], test_days: int, ts: str = "timestamp", label: str = "occupied") -> dict[str, object]:
    """Choose among candidates (a name and its features) by their mean average precision over the folds, fit the chosen one again to all rows before the last ``test_days`` dates and score it on those.

    The folds are to lie before the blind dates; without folds the first candidate is chosen. Returns candidate, folds (scores by candidate), mean, model, test_pr_auc and test_rows: a few numbers a fold.
    """
    blind = blind_last_days(rows, test_days, ts).where(F.col(label).isNotNull())
    before = blind.where("split = 'pre_test'").drop("split")
    scores = {}
    for name, features in candidates.items():
        scores[name] = [r["pr_auc"] for r in cross_validate(before, folds, features, ts, label).collect() if r["pr_auc"] is not None]
    mean = {name: sum(x) / len(x) if x else -1.0 for name, x in scores.items()}
    chosen = max(mean, key=lambda name: mean[name])
    model = fit_occupancy(before, candidates[chosen], label)
    scored = predict(model, blind.where("split = 'test'"), [ts], label).withColumnRenamed("y_true", "y")
    tested = average_precision(scored).first()["pr_auc"]
    return {"candidate": chosen, "folds": scores, "mean": mean, "model": model, "test_pr_auc": 0.0 if tested is None else tested, "test_rows": scored.count()}


def score_latest(model: PipelineModel, windows: DataFrame, zone: str = "zone_id", ts: str = "timestamp") -> DataFrame:
    """The probability of each zone's latest window."""
    latest = windows.groupBy(zone).agg(F.max_by(F.struct(*windows.columns), ts).alias("_r")).select("_r.*")
    return predict(model, latest, [zone, ts], None)
