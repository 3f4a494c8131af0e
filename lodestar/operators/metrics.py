"""Ranking, classification and regression metrics."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lodestar.operators.prefix import running_totals


def _c(x: Column | str) -> Column:
    return F.col(x) if isinstance(x, str) else x


def score_counts(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., score, pos, n): rows grouped by distinct score — ties form one threshold."""
    return df.groupBy(*by, score).agg(
        F.sum(F.col(label).cast("long")).alias("pos"), F.count("*").alias("n")
    )


def precision_recall_curve(counts: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """Cumulative precision and recall at every distinct score, highest first.

    ``counts`` holds ``(by..., score, pos, n)``; the running sums are computed
    range by range (no single-task global window).
    """
    cum = running_totals(counts, [(score, False)], {"cum_pos": F.col("pos"), "cum_n": F.col("n")},
                         partition_by=by)
    out = cum.withColumn("precision", F.col("cum_pos") / F.col("cum_n"))
    if by:
        out = out.withColumn("total_pos", F.sum("pos").over(Window.partitionBy(*by)))
    else:
        # one scalar comes back to the driver; the rows stay distributed
        total = counts.agg(F.sum("pos")).first()[0] or 0
        out = out.withColumn("total_pos", F.lit(int(total)).cast("long"))
    return out.withColumn("recall", F.col("cum_pos") / F.col("total_pos"))


def average_precision_counts(counts: DataFrame, score: str = "score", by: Sequence[str] = ()) -> DataFrame:
    """A9 on pre-grouped counts: Σ_thresholds ΔRecall × Precision (ties grouped)."""
    cum = running_totals(counts, [(score, False)], {"cum_pos": F.col("pos"), "cum_n": F.col("n")},
                         partition_by=by)
    return cum.groupBy(*by).agg(
        (F.sum(F.col("pos") * F.col("cum_pos") / F.col("cum_n")) / F.sum("pos")).alias("ap"),
        F.sum("pos").alias("n_pos"),
    )


def average_precision(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Exact average precision per ``by`` group (one row when ``by`` is empty)."""
    return average_precision_counts(score_counts(df, score, label, by), score, by)


def mean_average_precision(per_class: DataFrame, ap: str = "ap") -> DataFrame:
    """A10 macro form: the mean of per-class AP over classes with positives."""
    return per_class.where(F.col(ap).isNotNull()).agg(F.avg(ap).alias("map"), F.count("*").alias("n_classes"))


def class_counts_and_priors(df: DataFrame, label: str) -> DataFrame:
    """A4: rows per class and the class share (prior)."""
    return df.groupBy(label).agg(F.count("*").alias("n")).withColumn(
        "prior", F.col("n") / F.sum("n").over(Window.partitionBy())
    )


def class_prevalence(df: DataFrame, labels: Sequence[str]) -> DataFrame:
    """A5: share of positives for each 0/1 label column."""
    stacked = df.select(F.explode(F.array(*[
        F.struct(F.lit(l).alias("label"), F.col(l).cast("double").alias("y")) for l in labels
    ])).alias("s")).select("s.*")
    return stacked.groupBy("label").agg(F.avg("y").alias("prevalence"), F.count("*").alias("n"))


def misclassification_rate(df: DataFrame, pred: Column | str, label: Column | str,
                           by: Sequence[str] = ()) -> DataFrame:
    """Share of rows whose prediction differs from the label."""
    return df.groupBy(*by).agg(F.avg((_c(pred) != _c(label)).cast("double")).alias("error_rate"),
                               F.count("*").alias("n"))


def threshold(score: Column | str, t: float = 0.5) -> Column:
    return (_c(score) > t).cast("int")


def regression_errors(df: DataFrame, pred: Column | str, y: Column | str, by: Sequence[str] = ()) -> DataFrame:
    """Mean squared error, its root, and the mean half squared error."""
    r = _c(pred) - _c(y)
    return df.groupBy(*by).agg(
        F.avg(r * r).alias("mse"), F.sqrt(F.avg(r * r)).alias("rmse"), (F.avg(r * r) / 2.0).alias("half_mse")
    )


def log_loss_expr(p: Column | str, y: Column | str, eps: float = 1e-15) -> Column:
    """A8 probability form: mean −(y log p + (1−y) log(1−p)), p clipped to [eps, 1−eps]."""
    pc = F.least(F.greatest(_c(p), F.lit(eps)), F.lit(1 - eps))
    yy = _c(y).cast("double")
    return F.avg(-(yy * F.log(pc) + (1 - yy) * F.log1p(-pc)))


def log_loss(df: DataFrame, p: Column | str, y: Column | str, eps: float = 1e-15) -> DataFrame:
    return df.agg(log_loss_expr(p, y, eps).alias("log_loss"))


def softplus(z: Column) -> Column:
    """log(1 + e^z) without overflow."""
    return F.greatest(z, F.lit(0.0)) + F.log1p(F.exp(-F.abs(z)))


def logit_loss_expr(z: Column | str, y: Column | str) -> Column:
    """A8 logit form: mean softplus(z) − y·z (y in 0/1)."""
    zz = _c(z)
    return F.avg(softplus(zz) - _c(y).cast("double") * zz)


def logit_loss(df: DataFrame, z: Column | str, y: Column | str) -> DataFrame:
    return df.agg(logit_loss_expr(z, y).alias("log_loss"))


def best_checkpoint(history: DataFrame, model: str, metric: str, key: str) -> DataFrame:
    """Per model, the checkpoint with the best (largest) validation metric; ties → earliest."""
    return history.groupBy(model).agg(
        F.max_by(key, F.struct(F.col(metric), -F.col(key))).alias(key),
        F.max(metric).alias(metric),
    )


def errors_by_k(preds: DataFrame, k: str, pred: str, label: str) -> DataFrame:
    """Misclassifications per k and the k with the fewest (smallest k on ties)."""
    per = preds.groupBy(k).agg(F.sum((F.col(pred) != F.col(label)).cast("long")).alias("n_errors"))
    w = Window.partitionBy().orderBy(F.col("n_errors").asc(), F.col(k).asc())
    return per.withColumn("is_best", F.row_number().over(w) == 1)


def best_threshold(df: DataFrame, score: str, label: str, by: Sequence[str] = ()) -> DataFrame:
    """Cut t minimising errors of the rule ``score >= t → 1`` over observed scores.

    One grouped pass: at a cut on the distinct score s, errors = positives below
    s + negatives at or above s.  Ties in errors go to the larger threshold.
    """
    counts = score_counts(df, score, label, by).withColumn("neg", F.col("n") - F.col("pos"))
    cum = running_totals(counts, [(score, True)], {"pos_below": F.col("pos"), "neg_below": F.col("neg")},
                         partition_by=by, exclusive=True)
    if by:
        cum = cum.withColumn("total_neg", F.sum("neg").over(Window.partitionBy(*by)))
    else:
        total_neg = counts.agg(F.sum("neg")).first()[0] or 0  # one scalar
        cum = cum.withColumn("total_neg", F.lit(int(total_neg)).cast("long"))
    cum = cum.withColumn(
        "errors", F.col("pos_below") + (F.col("total_neg") - F.col("neg_below"))
    )
    return cum.groupBy(*by).agg(
        F.min_by(F.col(score), F.struct(F.col("errors"), -F.col(score))).alias("threshold"),
        F.min("errors").alias("errors"),
    )
