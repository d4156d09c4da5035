"""Evaluation: golden confusion tables, exact AUC, selection and models."""

import random

import pytest

from conftest import pairs_df
from edgewise.operators import evaluate, features, models, selection

# Fixed golden values: confusion counts of the five published score files and
# the AUC each log reports.
GOLDEN = [
    ("svm", 1556, 114, 247, 1630, 0.8988195642329044),
    ("logreg", 1559, 115, 244, 1629, 0.8993648137406057),
    ("nb", 1588, 227, 215, 1517, 0.8752968739664271),
    ("rf", 1560, 554, 243, 1190, 0.7737820375826223),
    ("gbt", 1648, 280, 155, 1464, 0.8767408549461397),
]


def _scored(spark, tp, fp, fn, tn):
    rows = [(1.0, 1.0)] * tp + [(1.0, 0.0)] * fp + [(0.0, 1.0)] * fn + [(0.0, 0.0)] * tn
    return spark.createDataFrame(rows, "score double, label double")


@pytest.mark.parametrize("name,tp,fp,fn,tn,expected", GOLDEN)
def test_golden_hard_label_auc(spark, name, tp, fp, fn, tn, expected):
    s = _scored(spark, tp, fp, fn, tn)
    c = evaluate.confusion_counts(s).first()
    assert (c.tp, c.fp, c.fn, c.tn) == (tp, fp, fn, tn)
    assert abs(c.hard_auc - expected) < 1e-12
    assert abs(evaluate.auc(s).first().auc - expected) < 1e-12


def test_auc_matches_evaluator_and_roc(spark):
    rnd = random.Random(5)
    rows = [(float(rnd.randint(0, 40)), float(rnd.random() < 0.4)) for _ in range(3000)]
    s = spark.createDataFrame(rows, "score double, label double")
    a = evaluate.auc(s).first().auc
    assert abs(a - evaluate.evaluator_auc(s)) < 1e-9
    roc = sorted(evaluate.roc_curve(s).collect(), key=lambda r: r.threshold)
    P = sum(1 for _, l in rows if l == 1.0)
    assert roc[0].tp == P and roc[0].tpr == 1.0
    assert all(x.tp >= y.tp for x, y in zip(roc, roc[1:]))


def test_heuristic_selection_prefers_informative_feature(spark, t1_edges):
    rnd = random.Random(3)
    pairs = pairs_df(spark, [(rnd.randrange(1, 6), rnd.randrange(1, 6), rnd.choice("YN")) for _ in range(40)])
    f = features.pair_features(pairs, t1_edges)
    out = selection.forward_selection_heuristic(f, max_steps=2).collect()
    assert {r.step for r in out} <= {0, 1}
    assert sum(r.chosen for r in out if r.step == 0) <= 1


def test_models_score_rows(spark):
    rnd = random.Random(9)
    edges = spark.createDataFrame([(rnd.randrange(30), rnd.randrange(30)) for _ in range(200)],
                                  "src bigint, dst bigint")
    pairs = pairs_df(spark, [(a, b, "Y") for a, b in {(r.src, r.dst) for r in edges.collect()}]
                     + [(rnd.randrange(30), rnd.randrange(30), "N") for _ in range(150)])
    f = features.pair_features(pairs, edges).cache()
    for kind in ("logreg", "nb", "rf"):
        s = models.model_scores(f, f, kind, score_mode="probability")
        rows = s.collect()
        assert len(rows) == f.count() and all(0.0 <= r.score <= 1.0 for r in rows)


def test_null_and_nan_scores_are_ranked_not_dropped(spark):
    rows = [(None, 0.0), (float("nan"), 1.0), (0.5, 1.0), (0.2, 0.0), (None, 1.0)]
    r = evaluate.auc(spark.createDataFrame(rows, "score double, label double")).first()
    # pairs (positive, negative): NaN beats both, 0.5 beats both, the null positive ties the null and loses to 0.2
    assert (r.positives, r.negatives) == (3, 2) and abs(r.auc - 4.5 / 6) < 1e-12
    points = evaluate.roc_curve(spark.createDataFrame(rows, "score double, label double")).collect()
    assert len(points) == 4 and max(p.tp for p in points) == 3
    assert evaluate.auc(spark.createDataFrame([], "score double, label double")).first().auc is None


def test_counts_of_billions_do_not_overflow(spark):
    n = 3_000_000_000
    groups = spark.createDataFrame([(0.1, 0, n), (0.5, n, n), (0.9, n, 0)], "score double, pos bigint, neg bigint")
    r = evaluate.auc_of_groups(groups).first()
    assert (r.positives, r.negatives) == (2 * n, 2 * n) and abs(r.auc - 0.875) < 1e-12


def test_forward_selection_runs_to_its_stop_and_scores_the_test_rows(spark):
    from edgewise.functions.features import FEATURE_NAMES
    from edgewise.operators import selection
    import random
    rng = random.Random(3)
    rows = []
    for i in range(240):
        y = i % 2
        rows.append((i, i + 1, *[float(rng.randrange(5) + (3 * y if k == 4 else 0)) for k in range(len(FEATURE_NAMES))], "Y" if y else "N", i % 3))
    cols = "u bigint, v bigint, " + ", ".join(f"{c} double" for c in FEATURE_NAMES) + ", label string, part int"
    df = spark.createDataFrame(rows, cols)
    parts = [df.where(f"part = {k}") for k in range(3)]
    log = selection.forward_selection(parts[0], parts[1], kind="nb", candidates=[0, 4, 7], test=parts[2]).collect()
    steps = [r for r in log if r.split == "validation"]
    adopted = [r for r in steps if r.chosen]
    assert [r.step for r in adopted] == list(range(len(adopted))) and adopted
    assert log[-1].split == "test" and log[-1].tried == adopted[-1].tried and 0.0 <= log[-1].auc <= 1.0
    assert adopted[0].names == ",".join(FEATURE_NAMES[int(i)] for i in adopted[0].tried.split(","))
    last = max(r.step for r in steps)
    assert last == len(adopted) or len(adopted) == 3
    h = selection.forward_selection_heuristic(parts[1], candidates=[0, 4, 7]).collect()
    assert [r.cand for r in h if r.chosen][0] == 4


def test_many_aucs_at_once_with_large_counts_and_more_parts_than_candidates(spark):
    """Per candidate the same as one by one; counts of 3e9 need DECIMAL products, parts cut candidates apart."""
    import random
    rng = random.Random(6)
    n = 3_000_000_000
    rows = [(c, s / 10, rng.randrange(n), rng.randrange(n)) for c in range(3) for s in range(40)] + [(3, None, n, 0), (3, 0.5, n, n), (3, float("nan"), 0, n), (4, 1.0, 5, 0)]
    groups = spark.createDataFrame(rows, "cand int, score double, pos bigint, neg bigint")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    spark.conf.set("spark.sql.shuffle.partitions", "16")
    try:
        got = {r.cand: r for r in evaluate.auc_of_groups(groups, ("cand",)).collect()}
        for c in range(5):
            one = evaluate.auc_of_groups(groups.where(f"cand = {c}").drop("cand")).first()
            assert (got[c].auc, got[c].positives, got[c].negatives) == (one.auc, one.positives, one.negatives)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    exact = {}
    for c in range(3):
        below = num = p = q = 0
        for _, _, pos, neg in sorted(r for r in rows if r[0] == c):
            num += pos * (2 * below + neg)
            below += neg
            p, q = p + pos, q + neg
        exact[c] = num / (2.0 * p * q)
    assert all(abs(got[c].auc - exact[c]) < 1e-15 for c in exact) and got[4].auc is None and got[3].auc == 0.125


def test_bayes_from_sums_is_the_fitted_model(spark):
    """Log-odds from the sufficient statistics against Spark ML's probabilities, subset by subset."""
    import random
    from math import exp
    from edgewise.functions.features import FEATURE_NAMES
    from edgewise.operators import models, selection
    rng = random.Random(4)
    rows = [(i, i + 1, *[float(rng.randrange(4) + (i % 2) * (k % 3)) for k in range(len(FEATURE_NAMES))], "Y" if i % 2 else "N") for i in range(80)]
    df = spark.createDataFrame(rows, "u bigint, v bigint, " + ", ".join(f"{c} double" for c in FEATURE_NAMES) + ", label string")
    sums = selection.BayesSums.of(df)
    for idx in ([3], [5, 0, 12], list(range(22))):
        model, _ = models.fit(df, "nb", idx)
        want = {r.u: r.score for r in models.score(model, df, "nb", idx).collect()}
        for r in df.select("u", sums.score(idx).alias("s")).collect():
            assert abs(1 / (1 + exp(-r.s)) - want[r.u]) < 1e-6
