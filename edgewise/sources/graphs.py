"""Graph sources: edge-list text files and graphs derived from Parquet tables.

Two directed test graphs are derived from the driver tables, both with a
shared id space for ``src`` and ``dst``:

* ``ev`` -- ``events.user_id -> props.k``
* ``cp`` -- ``orders.o_custkey -> lineitem.l_partkey``

``*_raw`` variants keep multiplicity and self-loops (the file-as-it-comes
view); the plain variants are the simple graph (distinct, no self-loops).
"""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

EDGE_SCHEMA = T.StructType([
    T.StructField("src", T.LongType(), False),
    T.StructField("dst", T.LongType(), False),
])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def events_edges_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev.select(F.col("user_id").cast("bigint").alias("src"),
                      F.get_json_object("props", "$.k").cast("bigint").alias("dst"))
              .where(F.col("src").isNotNull() & F.col("dst").isNotNull()))


def orders_edges_raw(spark: SparkSession, sf_dir: str, with_status: bool = False) -> DataFrame:
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderstatus")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    cols = [F.col("o_custkey").cast("bigint").alias("src"), F.col("l_partkey").cast("bigint").alias("dst")]
    if with_status:
        cols.append(F.col("o_orderstatus").alias("rel"))
    return (li.join(o, li.l_orderkey == o.o_orderkey)
              .select(*cols)
              .where(F.col("src").isNotNull() & F.col("dst").isNotNull()))


def simple_graph(edges: DataFrame) -> DataFrame:
    """Distinct edges without self-loops: the default graph every feature uses."""
    return edges.select("src", "dst").where(F.col("src") != F.col("dst")).distinct()


def events_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple_graph(events_edges_raw(spark, sf_dir))


def orders_graph(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simple_graph(orders_edges_raw(spark, sf_dir))


GRAPHS = {"ev": events_graph, "cp": orders_graph}


def graph(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return GRAPHS[name](spark, sf_dir)


def customer_vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Property-graph vertices: id with (name, role) attributes."""
    c = table(spark, sf_dir, "customer")
    return c.select(F.col("c_custkey").cast("bigint").alias("id"),
                    F.col("c_name").alias("name"), F.col("c_mktsegment").alias("role"))


def read_edge_list(spark: SparkSession, path: str, min_partitions: int | None = None) -> DataFrame:
    """Whitespace-separated ``src dst`` lines; ``#`` lines are comments.

    Duplicates and self-loops are kept, as in the file. Extra columns after
    the first two are ignored.
    """
    lines = spark.read.text(path)
    if min_partitions:
        lines = lines.repartition(min_partitions)
    parts = F.split(F.trim(F.col("value")), r"\s+")
    return (lines.where(~F.trim(F.col("value")).startswith("#") & (F.trim(F.col("value")) != ""))
                 .select(parts.getItem(0).cast("bigint").alias("src"),
                         parts.getItem(1).cast("bigint").alias("dst")))
