"""Classification metrics over (model, label, probability or prediction) rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wanewatch.functions.scalars import nan_to_null, positive, ratio
from wanewatch.operators.order_stats import running_before
from wanewatch.session import cut_lineage


def long_scores(df: DataFrame, key: str, label: str, scores: dict[str, str]) -> DataFrame:
    """(key, label, model, p) rows from one probability column per model."""
    pairs = [F.struct(F.lit(m).alias("model"), F.col(c).alias("p")) for m, c in scores.items()]
    return df.select(key, label, F.inline(F.array(*pairs)))


def confusion(df: DataFrame, label: str, prediction: Column, by: list[str]) -> DataFrame:
    """tn, fp, fn, tp per group in one pass; a class that never appears counts zero."""
    y, z = F.col(label) == 1, prediction == 1
    return df.groupBy(*by).agg(
        F.count_if(~y & ~z).alias("tn"),
        F.count_if(~y & z).alias("fp"),
        F.count_if(y & ~z).alias("fn"),
        F.count_if(y & z).alias("tp"),
    )


def rates(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and specificity from the four counts."""
    tn, fp, fn, tp = (F.col(c) for c in ("tn", "fp", "fn", "tp"))
    return counts.withColumns(
        {
            "accuracy": ratio(tp + tn, tp + tn + fp + fn),
            "precision": ratio(tp, tp + fp),
            "recall": ratio(tp, tp + fn),
            "f1": ratio(2 * tp, 2 * tp + fp + fn),
            "specificity": ratio(tn, tn + fp),
        }
    )


def _tally(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """(group, s, pos, neg), written: the input, often a model's plan, is read once.

    Rows without a score are one row with a NULL ``s``.
    """
    return cut_lineage(
        df.groupBy(*by, F.when(nan_to_null(score).isNotNull(), F.col(score)).alias("s")).agg(
            F.count_if(F.col(label) == 1).alias("pos"),
            F.count_if(F.col(label) != 1).alias("neg"),
        )
    )


def _with_area(tally: DataFrame, by: list[str]) -> tuple[DataFrame, Column]:
    """The scored rows of a tally with the area each adds, and the area as an aggregate.

    Ties count half; the negatives below a score come from a tree of range totals.
    """
    scored = running_before(tally.where(F.col("s").isNotNull()), by, "s", ["neg"])
    share = F.col("pos") * (F.col("before_neg") + F.col("neg") / 2)
    sides = F.sum("pos").cast("double") * F.sum("neg").cast("double")
    return scored.withColumn("area", share), ratio(F.sum("area"), sides)


def metrics(
    df: DataFrame, label: str, probability: str, by: list[str], threshold: float = 0.5
) -> DataFrame:
    """Counts, rates and ROC AUC per group, all from one tally of the scores."""
    tally = _tally(df, label, probability, by)
    said = positive("s", threshold) == 1
    blank = tally.where(F.col("s").isNull()).withColumns(
        {"before_neg": F.lit(0).cast("bigint"), "area": F.lit(0.0), "pos": F.lit(0).cast("bigint"), "neg": F.lit(0).cast("bigint")}
    )
    scored, area = _with_area(tally, by)

    def counted(which: str, when: Column) -> Column:
        return F.coalesce(F.sum(F.when(when, F.col(which))), F.lit(0).cast("bigint"))

    counts = (
        scored.unionByName(blank)
        .groupBy(*by)
        .agg(
            counted("neg", ~said).alias("tn"),
            counted("neg", said).alias("fp"),
            counted("pos", ~said).alias("fn"),
            counted("pos", said).alias("tp"),
            area.alias("roc_auc"),
        )
    )
    out = rates(counts)
    return out.select(*[c for c in out.columns if c != "roc_auc"], "roc_auc")


def roc_auc(df: DataFrame, label: str, score: str, by: list[str]) -> DataFrame:
    """Area under the ROC curve with ties counted half; 0 when one class is missing.

    Rows are first collapsed to one per (group, score); rows without a label count nowhere.
    """
    scored, area = _with_area(_tally(df.where(F.col(label).isNotNull()), label, score, by), by)
    return scored.groupBy(*by).agg(area.alias("roc_auc"))


def class_report(
    df: DataFrame, label: str, prediction: Column, names: dict[int, str]
) -> DataFrame:
    """Per class precision, recall, F1, support; accuracy, macro and weighted rows."""
    y = F.col(label)
    sums = []
    for c in names:
        sums += [
            F.count_if((y == c) & (prediction == c)).alias(f"hit_{c}"),
            F.count_if(prediction == c).alias(f"said_{c}"),
            F.count_if(y == c).alias(f"was_{c}"),
        ]
    counted = df.where(y.isNotNull() & prediction.isNotNull()).agg(*sums, F.count("*").alias("n"))
    rows = []
    parts = {}
    for c, name in names.items():
        hit, said, was = (F.col(f"{k}_{c}") for k in ("hit", "said", "was"))
        parts[c] = (ratio(hit, said), ratio(hit, was), ratio(2 * hit, said + was), was)
        rows.append(_report_row(name, *parts[c]))
    k, n = len(names), F.col("n")
    hits = sum((F.col(f"hit_{c}") for c in names), F.lit(0))
    accuracy = ratio(hits, n)
    rows.append(_report_row("accuracy", accuracy, accuracy, accuracy, n))
    macro = [sum((parts[c][i] for c in names), F.lit(0.0)) / k for i in range(3)]
    rows.append(_report_row("macro avg", *macro, n))
    heavy = [
        ratio(sum((parts[c][i] * parts[c][3] for c in names), F.lit(0.0)), n) for i in range(3)
    ]
    rows.append(_report_row("weighted avg", *heavy, n))
    return counted.select(F.inline(F.array(*rows)))


def _report_row(name: str, precision: Column, recall: Column, f1: Column, support: Column):
    return F.struct(
        F.lit(name).alias("class"),
        precision.alias("precision"),
        recall.alias("recall"),
        f1.alias("f1"),
        support.cast("bigint").alias("support"),
    )


def fold_summary(scores: DataFrame, model: str, fold: str, cols: list[str]) -> DataFrame:
    """Mean and population deviation of fold scores, with the scores in fold order."""
    aggregates = []
    for c in cols:
        aggregates += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
        ordered = F.array_sort(F.collect_list(F.struct(fold, c)))
        aggregates.append(ordered.getField(c).alias(f"{c}_folds"))
    return scores.groupBy(model).agg(*aggregates)
