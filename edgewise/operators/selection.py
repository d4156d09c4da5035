"""Greedy forward feature selection by validation AUC.

Rule: start from AUC 0.0; in each step try every unused feature index in
increasing order, keep the one with the best validation AUC (strict
improvement, so the first wins ties); stop when the gain is below 1e-6
or nothing improves.

``forward_selection`` with naive Bayes needs no fits: the model of any subset
is a function of the class-conditional sums of the features, which one
aggregation over the training rows gives for all subsets. The candidates of a
step are scored side by side in one job. Other kinds are fitted by Spark ML,
one model per candidate (distributed fits over one cached frame, a few jobs at a
time).
``forward_selection_heuristic`` scores a candidate set by the plain sum of
its features.

All candidates of a step are evaluated together (``candidate_aucs``): rows of
(candidate, score) are counted, and the running sums are taken in ranges of
(candidate, score).
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from math import floor, log

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewise.functions.features import FEATURE_NAMES, label_value
from edgewise.operators.evaluate import auc, auc_of_groups
from edgewise.operators.models import fit, score

MIN_GAIN = 1e-6
FITS_AT_ONCE = 4


@dataclass
class BayesSums:
    """Sufficient statistics of multinomial naive Bayes with add-one smoothing: rows and feature sums per class."""

    rows: tuple[int, int]
    sums: tuple[list[float], list[float]]

    @classmethod
    def of(cls, train: DataFrame) -> BayesSums:
        """One aggregation; two numbers a feature reach the driver."""
        yes = F.col("label") == "Y"
        one = train.agg(*[F.count_if(c).alias(f"n{k}") for k, c in enumerate((~yes, yes))],
                        *[F.sum(F.when(c, F.col(x).cast("double"))).alias(f"s{k}_{x}")
                          for k, c in enumerate((~yes, yes)) for x in FEATURE_NAMES]).first()
        return cls((one["n0"], one["n1"]), tuple([one[f"s{k}_{x}"] or 0.0 for x in FEATURE_NAMES] for k in (0, 1)))

    def weights(self, chosen: list[int]) -> tuple[float, list[float]]:
        """(prior, weight of each chosen feature): log-odds of 'Y', to nine decimals so that every engine has the same."""
        no, yes = ([self.sums[k][i] for i in chosen] for k in (0, 1))
        total = log(sum(yes) + len(chosen)) - log(sum(no) + len(chosen))
        return (_nine(log(self.rows[1] + 1.0) - log(self.rows[0] + 1.0)),
                [_nine((log(y + 1.0) - log(n + 1.0)) - total) for n, y in zip(no, yes)])

    def score(self, chosen: list[int]) -> Column:
        """Log-odds of a row under the model of the chosen features, added up in the order of adoption."""
        prior, weights = self.weights(chosen)
        out = F.lit(prior)
        for i, w in zip(chosen, weights):
            out = out + F.col(FEATURE_NAMES[i]).cast("double") * F.lit(w)
        return out


def _nine(x: float) -> float:
    return floor(x * 1e9 + 0.5) / 1e9


def forward_selection(train: DataFrame, validation: DataFrame, kind: str = "nb",
                      candidates: list[int] | None = None, iterations: int | None = None,
                      max_steps: int | None = None, test: DataFrame | None = None) -> DataFrame:
    """(step, tried, names, auc, chosen, split): one row per fitted candidate set.

    ``chosen`` marks the set that its step adopted. With ``test`` a last row
    (split 'test') holds the adopted set, fitted once more, on the test rows.
    Naive Bayes is evaluated from its sums, a step in one job; the fits of other
    kinds are independent jobs and run side by side.
    """
    spark = train.sparkSession
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    validation = validation.persist(StorageLevel.MEMORY_AND_DISK)
    pool = list(range(len(FEATURE_NAMES))) if candidates is None else list(candidates)
    chosen: list[int] = []
    current = 0.0
    log = []

    bayes = BayesSums.of(train) if kind == "nb" else None

    def fitted_auc(idx: list[int], rows: DataFrame) -> float:
        if bayes:
            return candidate_aucs(rows, {idx[-1]: bayes.score(idx)})[idx[-1]] or 0.0
        model, _ = fit(train, kind, idx, iterations)
        return float(auc(score(model, rows, kind, idx)).first()["auc"] or 0.0)

    def row(step: int, idx: list[int], a: float, adopted: bool, split: str) -> tuple:
        return step, ",".join(map(str, idx)), ",".join(FEATURE_NAMES[i] for i in idx), a, adopted, split

    with ThreadPoolExecutor(FITS_AT_ONCE) as jobs:
        step = 0
        while max_steps is None or step < max_steps:
            tried = [chosen + [i] for i in pool if i not in chosen]
            if bayes:
                found = candidate_aucs(validation, {idx[-1]: bayes.score(idx) for idx in tried})
                aucs = [found.get(idx[-1]) or 0.0 for idx in tried]
            else:
                aucs = list(jobs.map(lambda idx: fitted_auc(idx, validation), tried))
            best = _best(aucs, current)
            log += [row(step, idx, a, k == best, "validation") for k, (idx, a) in enumerate(zip(tried, aucs))]
            if best is None:
                break
            chosen, current = tried[best], aucs[best]
            step += 1
    if test is not None and chosen:
        log.append(row(len(chosen), chosen, fitted_auc(chosen, test), True, "test"))
    train.unpersist()
    validation.unpersist()
    return spark.createDataFrame(log, "step int, tried string, names string, auc double, chosen boolean, split string")


def _best(aucs: list[float | None], current: float) -> int | None:
    """Place of the first largest AUC, if it gains at least MIN_GAIN."""
    best = max(range(len(aucs)), key=lambda k: (aucs[k] or 0.0, -k), default=None)
    return best if best is not None and (aucs[best] or 0.0) - current >= MIN_GAIN else None


def candidate_aucs(rows: DataFrame, scores: dict[int, Column]) -> dict[int, float | None]:
    """AUC of every candidate's score over the labelled rows, all in one job; one number each reaches the driver."""
    if not scores:
        return {}
    stacked = rows.select(label_value("label").alias("label"), F.inline(F.array(*[
        F.struct(F.lit(i).alias("cand"), s.cast("double").alias("score")) for i, s in scores.items()])))
    counts = stacked.groupBy("cand", "score").agg(
        F.count_if(F.col("label") == 1.0).cast("bigint").alias("pos"), F.count_if(F.col("label") != 1.0).cast("bigint").alias("neg"))
    return {r["cand"]: r["auc"] for r in auc_of_groups(counts, ("cand",)).collect()}


def _sum_score(chosen: list[int], i: int) -> Column:
    """The plain sum of the features, in the order of adoption."""
    return sum((F.col(FEATURE_NAMES[j]).cast("double") for j in [*chosen, i]), F.lit(0.0))


def forward_selection_heuristic(validation: DataFrame, candidates: list[int] | None = None,
                                max_steps: int | None = None) -> DataFrame:
    """(step, cand, auc, chosen) for a sum-of-features score, to the stop of the rule."""
    spark = validation.sparkSession
    pool = list(range(len(FEATURE_NAMES))) if candidates is None else list(candidates)
    chosen: list[int] = []
    current = 0.0
    out = []
    step = 0
    while (max_steps is None or step < max_steps) and len(chosen) < len(pool):
        aucs = sorted(candidate_aucs(validation, {i: _sum_score(chosen, i) for i in pool if i not in chosen}).items())
        best = _best([a for _, a in aucs], current)
        out.extend((step, i, a, k == best) for k, (i, a) in enumerate(aucs))
        if best is None:
            break
        chosen.append(aucs[best][0])
        current = aucs[best][1]
        step += 1
    return spark.createDataFrame(out, "step int, cand int, auc double, chosen boolean")
