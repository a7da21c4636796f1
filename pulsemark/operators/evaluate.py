"""Metrics of scored rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pulsemark.constants import METRIC_NAMES, TARGET
from pulsemark.operators.ordering import running_total, value_buckets
from pulsemark.session import cut


def roc_auc(scored: DataFrame, label: str = TARGET, score: str = "score") -> DataFrame:
    """Exact area under the ROC curve with ties counted half; NULL if one class is absent.

    Rows are counted per distinct score; negatives below each score come from running totals over
    ordered score buckets, so no task sorts the whole table.
    """
    positive = (F.col(label) == 1).cast("long")
    counts = cut(scored.groupBy(F.col(score).cast("double").alias("score")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    ).where("score is not null"))
    ranked = running_total(value_buckets(counts, "score"), "neg", ["score"], "below")
    return ranked.agg(
        F.sum(F.col("pos") * (F.col("below") + F.col("neg") / 2.0)).alias("wins"),
        F.sum("pos").cast("double").alias("p"), F.sum("neg").cast("double").alias("n"),
    ).select(F.try_divide(F.col("wins"), F.col("p") * F.col("n")).alias("roc_auc"))


def roc_curve(scored: DataFrame, label: str = TARGET, score: str = "score") -> DataFrame:
    """The ROC curve: per distinct score as threshold, the rates of rows at or above it in each class."""
    positive = (F.col(label) == 1).cast("long")
    counts = cut(scored.groupBy(F.col(score).cast("double").alias("threshold")).agg(
        F.sum(positive).alias("pos"), F.sum(1 - positive).alias("neg")
    ).where("threshold is not null"))
    total = counts.agg(F.sum("pos").alias("p"), F.sum("neg").alias("n")).first()
    ranked = value_buckets(counts, "threshold")
    for part in ("pos", "neg"):
        ranked = running_total(ranked, part, ["threshold"], f"{part}_below")

    def rate(part: str, all_rows):
        return F.try_divide(F.lit(all_rows).cast("double") - F.col(f"{part}_below"), F.lit(all_rows).cast("double"))

    return ranked.select("threshold", rate("neg", total.n).alias("fpr"), rate("pos", total.p).alias("tpr"))


def confusion(scored: DataFrame, label: str = TARGET, prediction: str = "prediction") -> DataFrame:
    """The four cells as one row; tn, fp, fn, tp."""
    def cell(actual: int, guess: int):
        return F.count_if((F.col(label) == actual) & (F.col(prediction) == guess))

    return scored.agg(
        cell(0, 0).alias("tn"), cell(0, 1).alias("fp"), cell(1, 0).alias("fn"), cell(1, 1).alias("tp")
    )


def classification_report(
    scored: DataFrame, label: str = TARGET, prediction: str = "prediction"
) -> DataFrame:
    """Accuracy, and precision, recall, F1 and support of both classes; 0 where undefined."""
    def share(top: str, bottom: str):
        return F.coalesce(F.try_divide(F.expr(top).cast("double"), F.expr(bottom)), F.lit(0.0))

    return confusion(scored, label, prediction).select(
        share("tp + tn", "tn + fp + fn + tp").alias("accuracy"),
        share("tp", "tp + fp").alias("precision_above"),
        share("tp", "tp + fn").alias("recall_above"),
        share("2 * tp", "2 * tp + fp + fn").alias("f1_above"),
        share("tn", "tn + fn").alias("precision_below"),
        share("tn", "tn + fp").alias("recall_below"),
        share("2 * tn", "2 * tn + fp + fn").alias("f1_below"),
        F.expr("tp + fn").alias("support_above"), F.expr("tn + fp").alias("support_below"),
        "tn", "fp", "fn", "tp",
    )


def evaluate(
    scored: DataFrame, label: str = TARGET, prediction: str = "prediction", score: str = "score"
) -> dict:
    """One model's metrics, rounded to four places, as a plain record."""
    kept = cut(scored.select(label, prediction, score))
    report = classification_report(kept, label, prediction).first().asDict()
    report["roc_auc"] = roc_auc(kept, label, score).first()["roc_auc"]
    result = {m: None if report[m] is None else round(report[m], 4) for m in METRIC_NAMES}
    result["confusion_matrix"] = [[report["tn"], report["fp"]], [report["fn"], report["tp"]]]
    result["val_rows"] = report["support_above"] + report["support_below"]
    return result


def best_per_metric(models: DataFrame, name: str, metrics: Sequence[str] = METRIC_NAMES) -> DataFrame:
    """Best and worst model per metric; equal values go to the first name."""
    pairs = ", ".join(f"'{m}', `{m}`" for m in metrics)
    long = models.selectExpr(
        f"`{name}` AS model", f"stack({len(metrics)}, {pairs}) AS (metric, value)"
    ).where("value is not null")
    return long.groupBy("metric").agg(
        F.min(F.struct((-F.col("value")).alias("v"), "model")).alias("hi"),
        F.min(F.struct(F.col("value").alias("v"), "model")).alias("lo"),
    ).select(
        "metric", F.col("hi.model").alias("best_model"), (-F.col("hi.v")).alias("best_value"),
        F.col("lo.model").alias("worst_model"), F.col("lo.v").alias("worst_value"),
    )


def three_way(spark, results: dict[str, dict[str, dict]]) -> DataFrame:
    """{split: {model: metrics}} as one row per model and split."""
    rows = [
        (model, name, *[float(m[k]) if m.get(k) is not None else None for k in METRIC_NAMES])
        for name, models in results.items() for model, m in models.items()
    ]
    schema = "model string, split string, " + ", ".join(f"{k} double" for k in METRIC_NAMES)
    return spark.createDataFrame(rows, schema).orderBy("model", "split")


def training_composition(split: DataFrame) -> DataFrame:
    """Real, synthetic and test rows with class balance, from split, target and flag columns."""
    train, test = F.col("split") == "train", F.col("split") == "test"
    fake = F.coalesce(F.col("contains_synthetic_data").cast("boolean"), F.lit(False))
    counted = split.agg(
        F.count_if(train & ~fake).alias("real_train_rows"),
        F.count_if(train & fake).alias("synthetic_train_rows"),
        F.count_if(train).alias("total_train_rows"),
        F.count_if(test).alias("test_rows"),
        *[F.count_if(part & (F.col(TARGET) == v)).alias(f"{name}_{v}")
          for name, part in (("train", train), ("test", test)) for v in (0, 1)],
    )
    pct = F.round(F.try_divide(F.col("synthetic_train_rows"), F.col("total_train_rows")) * 100, 1)
    return counted.withColumn("synthetic_pct", F.coalesce(pct, F.lit(0.0)))
