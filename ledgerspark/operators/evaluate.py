"""Classification metrics from counts: one aggregation, any number of groups."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerspark.operators.ordered import RANGE, with_range
from ledgerspark.sources.scratch import materialize

METRICS = ("accuracy", "precision", "recall", "f1_score", "auc_roc")


def _ratio(top: Column, bottom: Column) -> Column:
    return F.when(bottom > 0, top / bottom).otherwise(F.lit(0.0))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction",
              by: list[str] | str | None = None) -> DataFrame:
    """n, tn, fp, fn, tp and the rows whose prediction is no class, per group."""
    y, p = F.col(f"`{label}`"), F.col(f"`{prediction}`")
    groups = [by] if isinstance(by, str) else list(by or [])
    hit = {"tn": (0, 0), "fp": (0, 1), "fn": (1, 0), "tp": (1, 1)}
    good = F.coalesce(y.isin(0, 1) & p.isin(0, 1), F.lit(False))
    return df.groupBy(*groups).agg(
        F.count(F.lit(1)).alias("n"),
        *[F.count_if((y == a) & (p == b)).alias(k) for k, (a, b) in hit.items()],
        F.count_if(~good).alias("not_a_class"),
    )


def metrics(df: DataFrame, label: str = "label", prediction: str = "prediction",
            by: list[str] | str | None = None) -> DataFrame:
    """Confusion counts with accuracy, precision, recall, F1 and AUC, per group.

    Undefined precision, recall and F1 are 0.  The AUC is that of the hard labels
    and NULL if a class is absent.  Lazy; a prediction that is no class makes the
    job fail.
    """
    c = confusion(df, label, prediction, by)
    groups = [by] if isinstance(by, str) else list(by or [])
    tn, fp, fn, tp = (F.col(k) for k in ("tn", "fp", "fn", "tp"))
    complaint = F.raise_error(F.lit("Predictions and labels must be classes 0 or 1"))
    checked = F.when(F.col("not_a_class") > 0, complaint.cast("long")).otherwise(F.col("n"))
    c = c.withColumn("n", checked).withColumns({
        "precision": _ratio(tp, tp + fp),
        "recall": _ratio(tp, tp + fn),
    })
    specificity = F.when(tn + fp > 0, tn / (tn + fp))
    sensitivity = F.when(tp + fn > 0, tp / (tp + fn))
    p, r = F.col("precision"), F.col("recall")
    return c.select(
        *groups, "n", "tn", "fp", "fn", "tp",
        _ratio(tp + tn, F.col("n")).alias("accuracy"), "precision", "recall",
        F.when(p + r > 0, 2 * p * r / (p + r)).otherwise(F.lit(0.0)).alias("f1_score"),
        ((specificity + sensitivity) / 2).alias("auc_roc"),
    )


def configured_metrics(table: DataFrame, conf: dict) -> DataFrame:
    """The measures that the ``metrics`` setting lists, in its order, beside groups and counts.

    Names are taken without regard to case, blanks and underscores ("F1 Score", "ROC AUC");
    one that is not known is refused.  Without the setting the table stays as it is.
    """
    listed = conf.get("metrics")
    if not listed:
        return table
    known = {m.replace("_", ""): m for m in METRICS} | {"f1": "f1_score", "rocauc": "auc_roc"}
    short = [(name, "".join(ch for ch in str(name).lower() if ch.isalnum())) for name in listed]
    strange = [name for name, key in short if key not in known]
    if strange:
        raise ValueError(f"Unknown metrics {strange}; there are {list(METRICS)}")
    chosen = list(dict.fromkeys(known[key] for _, key in short))
    return table.select(*[c for c in table.columns if c not in METRICS], *chosen)


def evaluate(df: DataFrame, label: str = "label", prediction: str = "prediction") -> dict:
    """The metrics of one table as a dictionary; ``ValueError`` if not classes."""
    counts = confusion(df, label, prediction).first()
    if counts["not_a_class"]:
        raise ValueError(
            f"{counts['not_a_class']} rows have a label or prediction that is no class")
    if not counts["n"]:
        raise ValueError("Nothing to evaluate: the table is empty")
    return _from_counts(counts)


def _from_counts(c) -> dict:
    tn, fp, fn, tp = c["tn"], c["fp"], c["fn"], c["tp"]
    precision = tp / (tp + fp) if tp + fp else 0.0
    recall = tp / (tp + fn) if tp + fn else 0.0
    both = precision + recall
    one_class = not (tp + fn) or not (tn + fp)
    return {
        "accuracy": (tp + tn) / c["n"],
        "precision": precision,
        "recall": recall,
        "f1_score": 2 * precision * recall / both if both else 0.0,
        "auc_roc": None if one_class else (recall + tn / (tn + fp)) / 2,
        "confusion_matrix": [[tn, fp], [fn, tp]],
    }


def auc_from_probability(df: DataFrame, label: str, probability: str) -> DataFrame:
    """ROC AUC of the probabilities, exact: one row, ``auc_roc_proba``.

    Rows with the same probability merge first.  Each remaining value needs the
    number of negatives below it, a running total over the whole order, so it is
    taken range by range.
    """
    y = F.col(f"`{label}`")
    values = df.groupBy(F.col(f"`{probability}`").alias("p")).agg(
        F.count_if(y == 1).alias("pos"), F.count_if(y == 0).alias("neg"))
    # Read several times below, and costly if the scores are not stored yet.
    ranged = with_range(materialize(values, "scores"), ["p"])
    sizes = ranged.groupBy(RANGE).agg(F.sum("neg").alias("size"))
    earlier = Window.partitionBy(F.lit(0)).orderBy(RANGE).rowsBetween(
        Window.unboundedPreceding, -1)
    start = sizes.select(
        RANGE, F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("start"))
    inside = Window.partitionBy(RANGE).orderBy("p").rowsBetween(Window.unboundedPreceding, -1)
    below = F.col("start") + F.coalesce(F.sum("neg").over(inside), F.lit(0))
    pairs = ranged.join(F.broadcast(start), RANGE).select(
        "pos", "neg", (F.col("pos") * (below + F.col("neg") / 2)).alias("won"))
    total = pairs.agg(F.sum("won").alias("won"), F.sum("pos").cast("double").alias("pos"),
                      F.sum("neg").cast("double").alias("neg"))
    possible = F.col("pos") * F.col("neg")
    return total.select(
        F.when(possible > 0, F.col("won") / possible).alias("auc_roc_proba"))
