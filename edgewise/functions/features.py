"""Column expressions for the derived pair features and the feature catalogue."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed order of the 22 features: the index is what selection logs and
# feature subsets refer to.
FEATURE_NAMES = [
    "u_degree", "v_degree", "u_in", "u_out", "u_bi", "v_in", "v_out", "v_bi",
    "common_in", "common_out", "total_in", "total_out", "friends_measure",
    "u_in_density", "u_out_density", "u_bi_density",
    "v_in_density", "v_out_density", "v_bi_density",
    "pref_attachment", "jaccard_in", "jaccard_out",
]

COUNT_FEATURES = FEATURE_NAMES[:13]
DERIVED_FEATURES = FEATURE_NAMES[13:]
FEATURE_COLUMNS = ["u", "v"] + FEATURE_NAMES + ["label"]

# Feature subsets used by the classification jobs.
SVM_LR_FEATURES = [12, 11, 4, 7, 8, 9]
NB_FEATURES = [0, 12, 1, 6, 5, 7, 14]


def names(indexes) -> list[str]:
    return [FEATURE_NAMES[i] for i in indexes]


def safe_ratio(num: str | Column, den: str | Column) -> Column:
    num = F.col(num) if isinstance(num, str) else num
    den = F.col(den) if isinstance(den, str) else den
    return F.when(den != 0, num.cast("double") / den.cast("double")).otherwise(F.lit(0.0))


def label_value(label: str | Column = "label") -> Column:
    """'Y' -> 1.0, anything else -> 0.0."""
    label = F.col(label) if isinstance(label, str) else label
    return F.when(label == "Y", F.lit(1.0)).otherwise(F.lit(0.0))


def derived_columns() -> list[Column]:
    """The nine features computed from the thirteen counters."""
    return [
        safe_ratio("u_in", "u_degree").alias("u_in_density"),
        safe_ratio("u_out", "u_degree").alias("u_out_density"),
        safe_ratio("u_bi", "u_degree").alias("u_bi_density"),
        safe_ratio("v_in", "v_degree").alias("v_in_density"),
        safe_ratio("v_out", "v_degree").alias("v_out_density"),
        safe_ratio("v_bi", "v_degree").alias("v_bi_density"),
        (F.col("u_degree").cast("bigint") * F.col("v_degree").cast("bigint")).alias("pref_attachment"),
        safe_ratio("common_in", "total_in").alias("jaccard_in"),
        safe_ratio("common_out", "total_out").alias("jaccard_out"),
    ]


def derived_sql() -> str:
    """SQL text for the same nine columns (for oracles and SQL users)."""
    def r(n, d):
        return f"CASE WHEN {d} <> 0 THEN CAST({n} AS DOUBLE) / CAST({d} AS DOUBLE) ELSE 0.0 END"
    return ", ".join([
        f"{r('u_in', 'u_degree')} AS u_in_density",
        f"{r('u_out', 'u_degree')} AS u_out_density",
        f"{r('u_bi', 'u_degree')} AS u_bi_density",
        f"{r('v_in', 'v_degree')} AS v_in_density",
        f"{r('v_out', 'v_degree')} AS v_out_density",
        f"{r('v_bi', 'v_degree')} AS v_bi_density",
        "CAST(u_degree AS BIGINT) * CAST(v_degree AS BIGINT) AS pref_attachment",
        f"{r('common_in', 'total_in')} AS jaccard_in",
        f"{r('common_out', 'total_out')} AS jaccard_out",
    ])
