"""Readers and writers for the interchange files of the link-prediction jobs.

All writers are distributed DataFrame writes (one file per task); nothing
is collected to the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from edgewise.functions.features import (
    COUNT_FEATURES, DERIVED_FEATURES, FEATURE_COLUMNS, derived_columns,
)

PAIR_SCHEMA = T.StructType([
    T.StructField("u", T.LongType()),
    T.StructField("v", T.LongType()),
    T.StructField("label", T.StringType()),
])

# 25 columns: ids, 13 counters, 9 derived, label. Counters were printed as
# doubles by older writers, so they are read as doubles and truncated.
FEATURE_FILE_SCHEMA = T.StructType(
    [T.StructField("u", T.DoubleType()), T.StructField("v", T.DoubleType())]
    + [T.StructField(n, T.DoubleType()) for n in COUNT_FEATURES]
    + [T.StructField(n, T.DoubleType()) for n in DERIVED_FEATURES]
    + [T.StructField("label", T.StringType())]
)

SCORE_SCHEMA = T.StructType([
    T.StructField("score", T.DoubleType()),
    T.StructField("label", T.DoubleType()),
])


METRIC_SCHEMA = "model string, metric string, value double"
BASELINE_SCHEMA = "u bigint, v bigint, co_out bigint, co_in bigint, label string"


def read_pairs(spark: SparkSession, path: str, min_partitions: int = 4) -> DataFrame:
    df = spark.read.schema(PAIR_SCHEMA).csv(path, header=False)
    if min_partitions and df.rdd.getNumPartitions() < min_partitions:
        df = df.repartition(min_partitions)
    return df


def read_features(spark: SparkSession, path: str, header: bool = False) -> DataFrame:
    """Read a feature file; only ids, the 13 counters and the label are trusted.

    The 9 derived values are recomputed from the counters.
    """
    raw = spark.read.schema(FEATURE_FILE_SCHEMA).csv(path, header=header)
    base = raw.select(
        F.col("u").cast("bigint").alias("u"), F.col("v").cast("bigint").alias("v"),
        *[F.col(n).cast("bigint").alias(n) for n in COUNT_FEATURES],
        F.col("label"),
    )
    return base.select("u", "v", *COUNT_FEATURES, *derived_columns(), "label").select(*FEATURE_COLUMNS)


def read_scores(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(SCORE_SCHEMA).csv(path, header=True)


def read_metrics(spark: SparkSession, path: str, schema: str = METRIC_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).csv(path, header=True)


def read_baseline(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(BASELINE_SCHEMA).csv(path, header=False)


def write_edges(edges: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Tab-separated ``src<TAB>dst`` lines (readable by ``read_edge_list``)."""
    edges.select("src", "dst").write.mode(mode).csv(path, sep="\t", header=False)


def write_pairs(pairs: DataFrame, path: str, mode: str = "overwrite") -> None:
    pairs.select("u", "v", "label").write.mode(mode).csv(path, header=False)


def write_ordered_pairs(pairs: DataFrame, path: str, files: int | None = None, mode: str = "overwrite") -> None:
    """Parquet files in the order of (v, u), the order of a pair: each file holds one range, files follow each other.

    ``files``: how many (default: as many parts as the session shuffles into). Rows of one (v, u) share a file.
    """
    n = files or int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    pairs.select("u", "v", "label").repartitionByRange(n, "v", "u").sortWithinPartitions("v", "u", "label") \
        .write.mode(mode).parquet(path)


def pair_file_bounds(spark: SparkSession, path: str) -> DataFrame:
    """(file, n, before, least, most): rows of each ordered file, rows in the files before it, its first and last (v, u)."""
    end = F.struct("v", "u")
    files = spark.read.parquet(path).groupBy(F.col("_metadata.file_name").alias("file")).agg(
        F.count(F.lit(1)).alias("n"), F.min(end).alias("least"), F.max(end).alias("most"))
    before = Window.orderBy("least").rowsBetween(Window.unboundedPreceding, -1)     # one row a file
    return files.select("file", "n", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"), "least", "most")


def read_ordered_pairs(spark: SparkSession, path: str) -> DataFrame:
    """(position, u, v, label): rows with their 0-based place in the order, from the files alone, without a sort."""
    rows = spark.read.parquet(path).select("u", "v", "label", F.col("_metadata.file_name").alias("file"),
                                           F.col("_metadata.row_index").alias("row"))
    return rows.join(pair_file_bounds(spark, path).select("file", "before"), "file") \
        .select((F.col("before") + F.col("row")).cast("bigint").alias("position"), "u", "v", "label")


def write_features(features: DataFrame, path: str, header: bool = False, mode: str = "overwrite") -> None:
    features.select(*FEATURE_COLUMNS).write.mode(mode).csv(path, header=header)


def write_scores(scores: DataFrame, path: str, mode: str = "overwrite") -> None:
    scores.select(F.col("score").cast("double"), F.col("label").cast("double")) \
          .write.mode(mode).csv(path, header=True)


def write_metrics(metrics: DataFrame, path: str, mode: str = "overwrite") -> None:
    metrics.write.mode(mode).csv(path, header=True)


def write_baseline(baseline: DataFrame, path: str, mode: str = "overwrite") -> None:
    baseline.select("u", "v", "co_out", "co_in", "label").write.mode(mode).csv(path, header=False)
