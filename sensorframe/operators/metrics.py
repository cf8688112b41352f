"""Model metrics, fold summaries and the promotion gate."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

EPS = 1e-7


def binary_metrics(scored: DataFrame, keys: list[str] | None = None, label: str = "y", score: str = "probability") -> DataFrame:
    """Counts, rate, mean probability, log loss (clipped to 1e-7) and Brier score."""
    p = F.greatest(F.lit(EPS), F.least(F.lit(1 - EPS), F.col(score)))
    y = F.col(label)
    return scored.groupBy(*(keys or [])).agg(
        F.count(F.lit(1)).alias("n"), F.count_if(y == 1).alias("positives"), F.count_if(y == 0).alias("negatives"), F.avg(y).alias("rate"), F.avg(score).alias("mean_probability"),
        F.avg(-(y * F.log(p) + (1 - y) * F.log(1 - p))).alias("log_loss"), F.avg(F.pow(F.col(score) - y, 2)).alias("brier"),
    )


def _by_score(scored: DataFrame, keys: list[str], label: str, score: str) -> DataFrame:
    """Positives and negatives of each distinct score."""
    return scored.groupBy(*keys, F.col(score).alias("_s")).agg(F.count_if(F.col(label) == 1).cast("double").alias("_p"), F.count_if(F.col(label) == 0).cast("double").alias("_n"))


def _ranked(groups: DataFrame, keys: list[str], falling: bool) -> DataFrame:
    """Adds _tp and _fp, the positives and negatives of the scores before each distinct score, and _all, the positives of the key.

    Scores are summed within bins of a thousandth, and bins within their key, so no task sorts all distinct scores.
    """
    binned = groups.withColumn("_bin", F.floor(F.col("_s") * (-1000 if falling else 1000)))
    sums = binned.groupBy(*keys, "_bin").agg(F.sum("_p").alias("_bp"), F.sum("_n").alias("_bn"))
    before = Window.partitionBy(*keys).orderBy("_bin").rowsBetween(Window.unboundedPreceding, -1)  # a row a bin
    offsets = sums.select(*keys, F.col("_bin"), *(F.coalesce(F.sum(c).over(before), F.lit(0.0)).alias(f"{c}0") for c in ("_bp", "_bn")), F.sum("_bp").over(Window.partitionBy(*keys)).alias("_all"))
    for k in keys:
        offsets = offsets.withColumnRenamed(k, f"_key_{k}")
    same = F.col("_bin") == F.col("_of")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_key_{k}"))
    line = Window.partitionBy(*keys, "_bin").orderBy(F.desc("_s") if falling else F.asc("_s")).rowsBetween(Window.unboundedPreceding, -1)
    own = binned.withColumns({"_tp": F.coalesce(F.sum("_p").over(line), F.lit(0.0)), "_fp": F.coalesce(F.sum("_n").over(line), F.lit(0.0))})
    return own.join(offsets.withColumnRenamed("_bin", "_of"), same).withColumns({"_tp": F.col("_tp") + F.col("_bp0"), "_fp": F.col("_fp") + F.col("_bn0")})


def average_precision(scored: DataFrame, keys: list[str] | None = None, label: str = "y", score: str = "probability") -> DataFrame:
    """Step-wise average precision (L02): sum of recall steps times precision over falling distinct scores. 0 without positives, null (NaN) without rows."""
    keys = keys or []
    g = _ranked(_by_score(scored, keys, label, score), keys, True).withColumns({"_tp": F.col("_tp") + F.col("_p"), "_fp": F.col("_fp") + F.col("_n")})
    ap = F.sum(F.when(F.col("_all") > 0, F.col("_p") / F.col("_all") * F.col("_tp") / (F.col("_tp") + F.col("_fp"))).otherwise(0.0))
    return g.groupBy(*keys).agg(ap.alias("pr_auc"))


def roc_auc(scored: DataFrame, keys: list[str] | None = None, label: str = "y", score: str = "probability") -> DataFrame:
    """Area under the ROC curve from average ranks (L03); null (NaN) with one class."""
    keys = keys or []
    g = _ranked(_by_score(scored, keys, label, score), keys, False).withColumn("_below", F.col("_tp") + F.col("_fp"))
    rank = F.col("_below") + (F.col("_p") + F.col("_n") + 1) / 2
    pos, neg = F.sum("_p"), F.sum("_n")
    return g.groupBy(*keys).agg(F.when((pos > 0) & (neg > 0), (F.sum(F.col("_p") * rank) - pos * (pos + 1) / 2) / (pos * neg)).alias("roc_auc"))


def class_weight(rows: DataFrame, label: str = "y") -> DataFrame:
    """Negatives over positives, of which there is at least one."""
    return rows.agg((F.count_if(F.col(label) == 0) / F.greatest(F.count_if(F.col(label) == 1), F.lit(1))).alias("positive_weight"))


#: What a candidate needs unless told otherwise, and the most folds that are ever asked for.
THRESHOLDS = {"pr_auc": 0.0, "cv_pr_auc": 0.0, "positive_windows": 5, "positive_buckets": 5, "positive_events": 1, "brier": 1.0, "log_loss": 10.0, "delta": 0.0, "folds": 3}


def finite(c: Column) -> Column:
    """Whether a number is there and neither NaN nor infinite."""
    x = c.cast("double")
    return x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))


def fold_summary(folds: DataFrame, score: str = "pr_auc", best: str = "best_epoch", keys: list[str] | None = None, most_epochs: int = 100) -> DataFrame:
    """Mean and population deviation of finite scores, -1 and null without any, and epochs as the rounded-up median of the best ones.

    A best epoch of 0 or null does not count; epochs are between 1 and ``most_epochs``, and the latter where no fold has a best one.
    """
    s = F.when(finite(F.col(score)), F.col(score))
    median = F.ceil(F.median(F.when(F.col(best) > 0, F.col(best)))).cast("long")
    most = F.lit(max(1, most_epochs)).cast("long")
    return folds.groupBy(*(keys or [])).agg(F.coalesce(F.avg(s), F.lit(-1.0)).alias("mean_score"), F.stddev_pop(s).alias("std_score"), F.least(most, F.greatest(F.lit(1).cast("long"), F.coalesce(median, most))).alias("epochs"))


def promotion(runs: DataFrame, thresholds: dict[str, float] | None = None) -> DataFrame:
    """decision (promote, fail or skip) and reason for each run.

    A run has mode (strict, bootstrap or degenerate), folds, pr_auc, cv_pr_auc, positive_windows, positive_buckets, positive_events, brier, log_loss, and
    what is in production: production_mode (null where nothing is), production_folds, production_reported (its own test score) and production_pr_auc,
    measured on the run's test window. Evidence that is null, NaN or infinite never passes. A strict run has to prove one fold more than strict production has, up to
    ``folds``; only between two runs of one fold a better reported score will do instead. A run that is no better than production is skipped, all else that falls short fails.
    """
    t = THRESHOLDS | (thresholds or {})
    c = F.col
    under = lambda name: ~finite(c(name)) | (c(name) < t[name])
    over = lambda name: ~finite(c(name)) | (c(name) > t[name])
    any_ = c("production_mode").isNotNull()
    strict = F.coalesce(c("production_mode") == "strict", F.lit(False))
    required = F.when(strict, F.least(c("production_folds") + 1, F.lit(t["folds"]))).otherwise(F.lit(1))
    short = (c("mode") == "strict") & (c("folds") < required)
    one_fold = short & strict & (c("folds") == 1) & (c("production_folds") == 1) & finite(c("pr_auc")) & finite(c("production_reported")) & (c("pr_auc") > c("production_reported") + t["delta"])
    against = F.when(one_fold, c("production_reported")).otherwise(c("production_pr_auc"))
    worse = F.lit("not better than production")
    reason = (
        F.when(any_ & (c("mode") == "bootstrap"), "bootstrap only without production")
        .when(c("mode") == "degenerate", "degenerate validation")
        .when(any_ & ~strict & (c("production_mode") != "bootstrap") | strict & c("production_folds").isNull(), "unknown production validation")
        .when(F.coalesce(c("mode") != "bootstrap", F.lit(True)) & (F.coalesce(c("mode") != "strict", F.lit(True)) | c("folds").isNull()), "no strict folds")
        .when(short & ~F.coalesce(one_fold, F.lit(False)), "too few folds")
        .when(under("pr_auc"), "test score too low").when(under("cv_pr_auc"), "fold score too low")
        .when(under("positive_windows"), "too few positive windows").when(under("positive_buckets"), "too few positive buckets").when(under("positive_events"), "too few positive events")
        .when(over("brier"), "brier score too high").when(over("log_loss"), "log loss too high")
        .when(any_ & ~finite(against), "no production score")
        .when(any_ & (c("pr_auc") <= against + t["delta"]), worse)
    )
    decision = F.when(reason.isNull(), "promote").when(reason == worse, "skip").otherwise("fail")
    return runs.withColumn("decision", decision).withColumn("reason", F.coalesce(reason, F.lit("all thresholds met")))
