"""Model evaluation as DataFrames: confusion counts, ROC points, exact AUC.

``scored`` frames have a numeric ``score`` and a ``label`` (1.0 / 0.0).

Running sums over the score order are computed without a single-partition
window: scores are first aggregated per distinct value, then written once,
range-partitioned by score (as many parts as the session shuffles into);
the parts' totals give their offsets and the running sum inside a part is a
window partitioned by part. The AUC is an exact integer numerator
(DECIMAL, so products of billions fit) over one final division: the same
double in any engine.

A null score ranks below every number, NaN above.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgewise.session import cut_lineage

BIG, _LONG = "decimal(38,0)", "decimal(19,0)"


def score_groups(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(score, pos, neg) per distinct score."""
    return scored.groupBy(F.col(score).alias("score")).agg(
        F.count_if(F.col(label) == 1.0).cast("bigint").alias("pos"),
        F.count_if(F.col(label) != 1.0).cast("bigint").alias("neg"))


def _with_prefix(groups: DataFrame, cols: list[str], by: tuple[str, ...] = ()) -> DataFrame:
    """Adds ``<c>_below`` = sum of c over all strictly smaller scores, within each ``by``.

    Parts are ranges of (by, score): one ``by`` may fill many parts and one part hold many, so no task
    gets a whole ``by`` and their number does not matter. Totals are one row a part and ``by`` in it.
    """
    g = cut_lineage(groups.repartitionByRange(*by, F.col("score").asc_nulls_first())
                    .withColumn("_part", F.spark_partition_id()))
    tot = g.groupBy(*by, "_part").agg(*[F.sum(c).alias(f"_t_{c}") for c in cols])
    parts = Window.partitionBy(*by).orderBy("_part")
    offs = tot.select(*by, "_part", *[(F.sum(f"_t_{c}").over(parts) - F.col(f"_t_{c}")).alias(f"_o_{c}") for c in cols])
    w = Window.partitionBy(*by, "_part").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    g = g.join(offs, [*by, "_part"])
    return g.select(*by, "score", "pos", "neg", *[
        (F.col(f"_o_{c}") + F.coalesce(F.sum(c).over(w), F.lit(0))).cast("bigint").alias(f"{c}_below")
        for c in cols])


def auc(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """One row (auc, positives, negatives): area under the ROC curve,
    ties counted half."""
    return auc_of_groups(score_groups(scored, score, label))


def auc_of_groups(groups: DataFrame, by: tuple[str, ...] = ()) -> DataFrame:
    """The same from counts per distinct score (score, pos, neg); with ``by``, one row for each of its values."""
    g = _with_prefix(groups, ["neg"], by)
    return g.groupBy(*by).agg(
        F.sum((F.col("pos").cast(_LONG) * (2 * F.col("neg_below") + F.col("neg")).cast(_LONG)).cast(BIG)).alias("_num"),
        F.sum("pos").cast("bigint").alias("positives"),
        F.sum("neg").cast("bigint").alias("negatives"),
    ).select(
        *by, F.when((F.col("positives") > 0) & (F.col("negatives") > 0),
                    F.col("_num").cast("double") / (2.0 * F.col("positives").cast("double")
                                                    * F.col("negatives").cast("double")))
        .alias("auc"),
        "positives", "negatives")


def roc_curve(scored: DataFrame, score: str = "score", label: str = "label") -> DataFrame:
    """(threshold, tp, fp, tpr, fpr): predicting positive when score >= threshold."""
    groups = score_groups(scored, score, label)
    g = _with_prefix(groups, ["pos", "neg"])
    # the class totals are two scalars; they enter the plan as literals
    t = g.agg(F.sum("pos").alias("P"), F.sum("neg").alias("N")).first()
    g = (g.withColumn("P", F.lit(int(t["P"] or 0)).cast("bigint"))
         .withColumn("N", F.lit(int(t["N"] or 0)).cast("bigint")))
    return _roc_points(g)


def _roc_points(g: DataFrame) -> DataFrame:
    tp = (F.col("P") - F.col("pos_below")).cast("bigint")
    fp = (F.col("N") - F.col("neg_below")).cast("bigint")
    return g.select(F.col("score").alias("threshold"), tp.alias("tp"), fp.alias("fp"),
                    F.when(F.col("P") > 0, tp.cast("double") / F.col("P").cast("double")).alias("tpr"),
                    F.when(F.col("N") > 0, fp.cast("double") / F.col("N").cast("double")).alias("fpr"))


def confusion_counts(scored: DataFrame, score: str = "score", label: str = "label",
                     threshold: float = 0.5) -> DataFrame:
    """One row (tp, fp, fn, tn, hard_auc) for ``prediction = score >= threshold``.
    ``hard_auc`` = (TPR + TNR) / 2, the AUC of 0/1 predictions."""
    pred = F.coalesce(F.col(score) >= F.lit(threshold), F.lit(False))
    pos = F.col(label) == 1.0
    c = scored.agg(F.count_if(pred & pos).cast("bigint").alias("tp"),
                   F.count_if(pred & ~pos).cast("bigint").alias("fp"),
                   F.count_if(~pred & pos).cast("bigint").alias("fn"),
                   F.count_if(~pred & ~pos).cast("bigint").alias("tn"))
    tp, fp, fn, tn = (F.col(x).cast("decimal(18,0)") for x in ("tp", "fp", "fn", "tn"))
    num = 2 * tp * tn + tp * fp + fn * tn
    den = 2 * (tp + fn) * (fp + tn)
    return c.select("tp", "fp", "fn", "tn",
                    F.when(den > 0, num.cast("double") / den.cast("double")).alias("hard_auc"))


def evaluator_auc(scored: DataFrame, score: str = "score", label: str = "label") -> float:
    """Spark ML's evaluator (for comparison with the DataFrame version)."""
    from pyspark.ml.evaluation import BinaryClassificationEvaluator
    ev = BinaryClassificationEvaluator(rawPredictionCol=score, labelCol=label,
                                       metricName="areaUnderROC", numBins=0)
    return ev.evaluate(scored.select(F.col(score).cast("double").alias(score),
                                     F.col(label).cast("double").alias(label)))
