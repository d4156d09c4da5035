"""Graph-level operators: projections, subgraphs, degrees, reciprocity."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def reverse_edges(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))


def drop_self_loops(edges: DataFrame) -> DataFrame:
    return edges.where(F.col("src") != F.col("dst"))


def induced_subgraph(edges: DataFrame, vertices: DataFrame, id_col: str = "id") -> DataFrame:
    """Edges whose both ends are in ``vertices``; self-loops dropped.

    The semi joins are left to the planner: AQE broadcasts the set when its
    measured size allows and shuffles otherwise.
    """
    ids = vertices.select(F.col(id_col).alias("_id")).distinct()
    e = drop_self_loops(edges)
    e = e.join(ids.withColumnRenamed("_id", "src"), "src", "left_semi")
    return e.join(ids.withColumnRenamed("_id", "dst"), "dst", "left_semi").select("src", "dst")


def vertex_degrees(edges: DataFrame) -> DataFrame:
    """(id, degree, in_degree, out_degree): one pass over the edges.

    Multiplicity counts and a self-loop adds one to each direction.
    """
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("src").alias("id"), F.lit(1).alias("o"), F.lit(0).alias("i")),
        F.struct(F.col("dst").alias("id"), F.lit(0).alias("o"), F.lit(1).alias("i")),
    )))
    agg = ends.groupBy("id").agg(F.sum("o").cast("bigint").alias("out_degree"),
                                 F.sum("i").cast("bigint").alias("in_degree"))
    return agg.select("id", (F.col("in_degree") + F.col("out_degree")).alias("degree"),
                      "in_degree", "out_degree")


def reciprocal_degree(edges: DataFrame) -> DataFrame:
    """(id, bi): number of edges x->n whose reverse n->x also exists.

    One equi-join on the composite key (src, dst) = (dst, src); the key is
    unique per simple edge, so no vertex is a hot key here.
    """
    rev = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"))
    return (edges.join(rev, ["src", "dst"], "left_semi")
                 .groupBy(F.col("src").alias("id"))
                 .agg(F.count(F.lit(1)).alias("bi")))


def vertex_stats(edges: DataFrame) -> DataFrame:
    """Degrees plus reciprocal degree per vertex (missing bi = 0)."""
    return (vertex_degrees(edges)
            .join(reciprocal_degree(edges), "id", "left")
            .select("id", "degree", "in_degree", "out_degree",
                    F.coalesce(F.col("bi"), F.lit(0)).cast("bigint").alias("bi")))


def vertices_of(edges: DataFrame) -> DataFrame:
    return edges.select(F.explode(F.array("src", "dst")).alias("id")).distinct()


def graph_summary(edges: DataFrame, pairs: DataFrame | None = None) -> DataFrame:
    """One row: edge, vertex (and pair) counts, from one aggregate over a
    tagged union (no join between the counts)."""
    parts = [edges.select(F.lit("e").alias("k")),
             vertices_of(edges).select(F.lit("v").alias("k"))]
    if pairs is not None:
        parts.append(pairs.select(F.lit("p").alias("k")))
    tagged = parts[0]
    for p in parts[1:]:
        tagged = tagged.unionByName(p)
    cols = [F.count_if(F.col("k") == "e").cast("bigint").alias("edges"),
            F.count_if(F.col("k") == "v").cast("bigint").alias("vertices")]
    if pairs is not None:
        cols.append(F.count_if(F.col("k") == "p").cast("bigint").alias("pairs"))
    return tagged.agg(*cols)


def edge_endpoint_degrees(edges: DataFrame, degrees: DataFrame) -> DataFrame:
    """Every edge with the degree of its source and of its destination."""
    d = degrees.select("id", "degree")
    return (edges.join(d.select(F.col("id").alias("src"), F.col("degree").alias("src_degree")), "src")
                 .join(d.select(F.col("id").alias("dst"), F.col("degree").alias("dst_degree")), "dst")
                 .select("src", "dst", "src_degree", "dst_degree"))


def property_graph_vertices(edges: DataFrame, vertices: DataFrame,
                            default_name: str = "John Doe", default_role: str = "Missing") -> DataFrame:
    """Vertex table of a property graph: given rows plus every edge endpoint
    without a row, which takes the default attributes."""
    ends = vertices_of(edges)
    missing = ends.join(vertices.select("id"), "id", "left_anti")
    return vertices.select("id", "name", "role").unionByName(
        missing.select("id", F.lit(default_name).alias("name"), F.lit(default_role).alias("role")))


def vertex_predicate_count(vertices: DataFrame, role: str) -> DataFrame:
    return vertices.agg(F.count_if(F.col("role") == role).cast("bigint").alias("n_vertices"))


def edge_predicate_count(edges: DataFrame, rel: str) -> DataFrame:
    return edges.agg(F.count_if(F.col("rel") == rel).cast("bigint").alias("n_edges"))
