"""Skew handling for adjacency expansions.

Expanding a row keyed by vertex ``k`` against ``k``'s adjacency list is the
basic step of every neighbourhood feature. When ``k`` is a hub (one vertex
may own a third of all edges) a plain equi-join sends the whole list and
every row that references it to a single task. Here hub lists are split
into ``ceil(degree / chunk)`` salt buckets (by a hash of the neighbour),
and rows referencing a hub are replicated once per bucket, so the output
of one hub is spread across many tasks.

The hub table holds every vertex above ``hub_bound``: the chunk size, or one
part in ``MAX_HUBS`` of all edges if that is more. No more than ``MAX_HUBS``
vertices can lie above it, so the table is broadcast.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewise.operators.bounded import bounded_broadcast

DEFAULT_CHUNK = 200_000     # max adjacency entries per salt bucket
MAX_HUBS = 10_000           # vertices that can hold more than one in so many of all edges


def spread(df: DataFrame, *cols: str) -> DataFrame:
    """Hash-partition ``df`` on ``cols`` into ``spark.sql.shuffle.partitions``
    parts before an expansion that multiplies its rows by a degree.

    A small driving table would otherwise be coalesced by AQE into one or
    two partitions, and every row the expansion produces would come from
    those few tasks. The partitioning is on a hash *expression* of the
    columns: a repartition on the bare columns is dropped by the planner
    when an upstream exchange already hashes on them, and that upstream
    exchange is the one AQE coalesces.
    """
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, F.xxhash64(*cols))


def hub_bound(n_edges: int, chunk: int = DEFAULT_CHUNK) -> int:
    """Degree beyond which a vertex is a hub: at most MAX_HUBS vertices are, whatever the graph."""
    return max(chunk, n_edges // MAX_HUBS)


def hub_table(degrees: DataFrame, degree_col: str, bound: int = DEFAULT_CHUNK, id_col: str = "id") -> DataFrame:
    """(id, salts) for every vertex whose ``degree_col`` exceeds ``bound``."""
    return (degrees.where(F.col(degree_col) > bound)
                   .select(F.col(id_col).alias("id"),
                           F.ceil(F.col(degree_col) / F.lit(bound)).cast("int").alias("salts")))


def _salts(hubs: DataFrame, key: str) -> DataFrame:
    return bounded_broadcast(hubs.select(F.col("id").alias(key), F.col("salts").alias("_ns")), 2 * MAX_HUBS)


def either(a: DataFrame | None, b: DataFrame | None) -> DataFrame | None:
    """The hubs of two tables: at most twice MAX_HUBS."""
    if a is None or b is None:
        return b if a is None else a
    return a.unionByName(b).groupBy("id").agg(F.max("salts").alias("salts"))


def lookup(rows: DataFrame, key: str, table: DataFrame, hubs: DataFrame | None = None, how: str = "inner",
           also: tuple[str, ...] = (), dealt: list[str] | None = None) -> DataFrame:
    """Equi-join of ``rows`` with a ``table`` of one row per ``key`` (and the columns ``also``).

    Rows of a hub are dealt over its salts by a hash of their other columns (or of ``dealt``),
    and its table row is repeated for each: no task gets all of a hub's rows.
    """
    if hubs is None:
        return rows.join(table, [key, *also], how)
    h = _salts(hubs, key)
    salt = F.when(F.col("_ns").isNull(), 0).otherwise(F.pmod(F.xxhash64(*(dealt or rows.columns)), F.col("_ns")).cast("int"))
    left = rows.join(h, key, "left").withColumn("_salt", salt).drop("_ns")
    right = table.join(h, key, "left") \
        .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_ns"), F.lit(1)) - 1))).drop("_ns")
    return left.join(right, [key, *also, "_salt"], how).drop("_salt")


def expand(left: DataFrame, key: str, adj: DataFrame, adj_key: str,
           hubs: DataFrame | None = None, spread_cols: list[str] | None = None) -> DataFrame:
    """Inner equi-join ``left[key] == adj[adj_key]`` with hub salting.

    ``adj`` columns other than ``adj_key`` are appended to ``left``'s.
    ``spread_cols`` (default: the remaining adj columns) pick the salt bucket.
    """
    a = adj.withColumnRenamed(adj_key, key) if adj_key != key else adj
    if hubs is None:
        return left.join(a, key)
    spread = spread_cols or [c for c in a.columns if c != key]
    h = _salts(hubs, key)
    a = (a.join(h, key, "left")
          .withColumn("_salt", F.when(F.col("_ns").isNull(), F.lit(0))
                                .otherwise(F.pmod(F.xxhash64(*spread), F.col("_ns")).cast("int")))
          .drop("_ns"))
    lft = (left.join(h, key, "left")
               .withColumn("_salt", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("_ns"), F.lit(1)) - 1)))
               .drop("_ns"))
    return lft.join(a, [key, "_salt"]).drop("_salt")
