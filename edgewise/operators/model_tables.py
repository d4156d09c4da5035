"""Fitted models as tables: coefficients as rows, trees as boxes of their leaves.

``model_table`` turns a fitted classifier into one table that any engine can score with:

    (kind, part, weight, value_no, value_yes, feature, low, high)

- linear SVM, logistic regression: one row a feature, ``weight`` its coefficient; the row without
  a feature is the intercept.
- naive Bayes: one row a feature, ``value_no`` and ``value_yes`` its log-likelihoods; the row without a feature
  holds the log priors.
- random forest, boosted trees: ``part`` is tree:leaf. A leaf's row without a feature holds the tree's weight and
  the leaf's values (forest: shares of both classes; boosting: the prediction as ``value_yes``); one row for
  each feature that its path tests, a row of data is in the leaf if low < value <= high for all of them.

Trees are read from the saved model's node table and closed over their paths by joins, one a level. The
tables are as large as the models (features, or trees x leaves x depth), not as the data, so
``score_with_table`` turns them into column expressions: scoring is one projection without a join or Python,
whatever the number of rows.
"""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgewise.functions.features import label_value, names
from edgewise.session import cut_lineage, scratch_dir

TABLE_SCHEMA = ("kind string, part string, weight double, value_no double, value_yes double, "
                "feature string, low double, high double")
MAX_ROWS = 100_000      # of a table that becomes expressions: 1,000 trees of depth 5 stay below


def model_table(model, kind: str, indexes: list[int]) -> DataFrame:
    """The table of a model fitted on the features ``indexes``."""
    spark = SparkSession.getActiveSession()
    features = names(indexes)
    if kind in ("svm", "logreg"):
        rows = [(kind, None, float(c), None, None, f, None, None) for f, c in zip(features, model.coefficients.toArray())]
        return spark.createDataFrame([*rows, (kind, None, float(model.intercept), None, None, None, None, None)], TABLE_SCHEMA)
    if kind == "nb":
        theta, prior = model.theta.toArray(), model.pi.toArray()
        rows = [(kind, None, None, float(theta[0][i]), float(theta[1][i]), f, None, None) for i, f in enumerate(features)]
        return spark.createDataFrame([*rows, (kind, None, None, float(prior[0]), float(prior[1]), None, None, None)], TABLE_SCHEMA)
    if kind in ("rf", "gbt"):
        return cut_lineage(_boxes(spark, model, kind, features))
    raise ValueError(kind)


def _boxes(spark: SparkSession, model, kind: str, features: list[str]) -> DataFrame:
    path = scratch_dir(spark, "model")
    model.write().save(path)
    nodes = cut_lineage(spark.read.parquet(f"{path}/data").select("treeID", "nodeData.*"))
    inner = nodes.where("leftChild >= 0").select(
        "treeID", F.col("id").alias("parent"), F.get(F.array(*map(F.lit, features)), F.col("split.featureIndex")).alias("feature"),
        F.get("split.leftCategoriesOrThreshold", F.lit(0)).alias("cut"), "leftChild", "rightChild")
    steps = cut_lineage(inner.select("treeID", F.col("leftChild").alias("node"), "parent", "feature", F.lit(None).cast("double").alias("low"), F.col("cut").alias("high"))
                        .unionAll(inner.select("treeID", F.col("rightChild").alias("node"), "parent", "feature", F.col("cut").alias("low"), F.lit(None).cast("double"))))
    leaves = nodes.where("leftChild < 0")
    at = leaves.select("treeID", F.col("id").alias("leaf"), F.col("id").alias("node"))
    tests = None
    for _ in range(_depth(model)):
        up = at.join(steps, ["treeID", "node"])
        found = up.select("treeID", "leaf", "feature", "low", "high")
        tests = found if tests is None else tests.unionAll(found)
        at = up.select("treeID", "leaf", F.col("parent").alias("node"))
    part = F.concat_ws(":", "treeID", "leaf").alias("part")
    weights = F.array(*[F.lit(float(w)) for w in model.treeWeights])
    stats = [F.get("impurityStats", F.lit(i)) for i in (0, 1)]
    values = [s / (stats[0] + stats[1]) for s in stats] if kind == "rf" else [F.lit(None).cast("double"), F.col("prediction")]
    none = F.lit(None).cast("double")
    table = leaves.withColumn("leaf", F.col("id")).select(
        F.lit(kind).alias("kind"), part, F.get(weights, F.col("treeID")).alias("weight"), values[0].alias("value_no"), values[1].alias("value_yes"),
        F.lit(None).cast("string").alias("feature"), none.alias("low"), none.alias("high"))
    if tests is None:
        return table
    boxes = tests.groupBy("treeID", "leaf", "feature").agg(F.max("low").alias("low"), F.min("high").alias("high"))
    return table.unionByName(boxes.select(F.lit(kind).alias("kind"), part, none.alias("weight"), none.alias("value_no"), none.alias("value_yes"),
                                          "feature", F.coalesce("low", F.lit(float("-inf"))).alias("low"), F.coalesce("high", F.lit(float("inf"))).alias("high")))


def _depth(model) -> int:
    return max(t.depth for t in model.trees)


def _sum(columns: list[Column]) -> Column:
    return functools.reduce(lambda a, b: a + b, columns)


def _value(feature: str) -> Column:
    return F.col(feature).cast("double")


def score_with_table(table: DataFrame, rows: DataFrame, score_mode: str = "probability") -> DataFrame:
    """(u, v, score, label) of feature rows as ``models.score`` gives them, from the model's table alone."""
    found = table.limit(MAX_ROWS + 1).collect()
    if not 0 < len(found) <= MAX_ROWS:
        raise ValueError(f"a model table of {len(found)} rows; 1 to {MAX_ROWS} are scored by expressions")
    kind = found[0].kind
    terms = [r for r in found if r.feature is not None]
    heads = [r for r in found if r.feature is None]
    if kind in ("svm", "logreg"):
        margin = F.lit(heads[0].weight) + _sum([F.lit(r.weight) * _value(r.feature) for r in terms])
        score, yes = (margin if kind == "svm" else 1 / (1 + F.exp(-margin))), margin > 0
    elif kind == "nb":
        margin = F.lit(heads[0].value_yes - heads[0].value_no) + _sum([F.lit(r.value_yes - r.value_no) * _value(r.feature) for r in terms])
        score, yes = 1 / (1 + F.exp(-margin)), margin > 0
    else:
        trees = _trees(heads, terms)
        if kind == "rf":
            no, votes = (_sum([_pick(leaves, side) for leaves in trees]) for side in ("value_no", "value_yes"))
            score, yes = votes / (no + votes), votes > no
        else:
            margin = _sum([F.lit(leaves[0][0].weight) * _pick(leaves, "value_yes") for leaves in trees])
            score, yes = 1 / (1 + F.exp(-2 * margin)), margin > 0
    out = score if score_mode == "probability" else F.when(yes, 1.0).otherwise(0.0)
    return rows.select("u", "v", out.alias("score"), label_value("label").alias("label"))


def _trees(heads, terms) -> list[list]:
    """Per tree its leaves as (head, tests)."""
    tests: dict = {}
    for r in terms:
        tests.setdefault(r.part, []).append(r)
    trees: dict = {}
    for h in sorted(heads, key=lambda r: tuple(map(int, r.part.split(":")))):
        trees.setdefault(h.part.split(":")[0], []).append((h, tests.get(h.part, [])))
    return list(trees.values())


def _pick(leaves: list, side: str) -> Column:
    """The value of the one leaf that holds the row."""
    chosen = None
    for head, tests in leaves:
        inside = [c for t in tests for c in _bounds(t)]
        value = F.lit(head[side])
        if not inside:
            return value
        held = functools.reduce(lambda a, b: a & b, inside)
        chosen = F.when(held, value) if chosen is None else chosen.when(held, value)
    return chosen


def _bounds(test) -> list[Column]:
    x = _value(test.feature)
    return ([x > test.low] if test.low != float("-inf") else []) + ([x <= test.high] if test.high != float("inf") else [])
