"""A graph prepared once for many pair-feature queries.

Edges are written once; per-vertex statistics, hub tables and the paths that close each
edge are built when they are first asked for and then reused by every feature. The hub tables hold every vertex
above the hub bound and are written once; graphs without hubs get plain joins, graphs with hubs
salted expansions.

``around(graph, pairs)`` is the part of a graph that the features of some pairs depend on: all edges of
their ends, and the edges that leave the ends' out-neighbours. Everything the features count is
whole in it, so they are the same, and the work follows the pairs, not the graph.

With ``multi`` the graph is taken as it comes: repeated edges count in degrees and
make a neighbour common, reciprocal counts multiply, self-loops stay.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import cached_property

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewise.operators.bounded import bounded_broadcast
from edgewise.operators.neighbours import end_degrees, link_stats, linked_edges
from edgewise.operators.skew import DEFAULT_CHUNK, hub_bound, hub_table, spread
from edgewise.session import cut_lineage
from edgewise.sources.graphs import simple_graph

SMALL = 1_000_000           # edges of a graph that is used whole, and prepared once
NEAR_PAIRS = 500_000        # more pairs are featurised on the whole graph
NEAR_VERTICES = 4_000_000   # vertices that are broadcast to pick their edges


@dataclass
class PreparedGraph:
    weighted: DataFrame               # distinct edges (src, dst, m, of_end, to_end): whether src, dst is an end of the pairs
    materialize: str | None = "cache"
    chunk: int = DEFAULT_CHUNK
    salt: bool = True
    multi: bool = False

    @property
    def edges(self) -> DataFrame:
        """Distinct edges (src, dst)."""
        return self.weighted.select("src", "dst")

    @cached_property
    def counts(self) -> DataFrame:
        """id, degree, in_degree, out_degree, bi, out_n, in_n, rep_out, rep_in."""
        return _materialize(spread(vertex_counts(self.weighted), "id"), self.materialize)

    @cached_property
    def _hub_tables(self) -> tuple[DataFrame | None, DataFrame | None]:
        if not self.salt:
            return None, None
        bound = hub_bound(self.counts.agg(F.sum("out_n")).first()[0] or 0, self.chunk)
        return _hubs(self.counts, "out_n", bound), _hubs(self.counts, "in_n", bound)

    @property
    def hubs_out(self) -> DataFrame | None:
        return self._hub_tables[0]

    @property
    def hubs_in(self) -> DataFrame | None:
        return self._hub_tables[1]

    @cached_property
    def hops(self) -> DataFrame:
        """src, dst, m, of_end, to_end, dst_out, src_in."""
        return end_degrees(self.weighted, self.counts, self.hubs_out, self.hubs_in)

    @cached_property
    def links(self) -> DataFrame:
        """src, dst, m, dst_out, live, paths: the edges that leave an end."""
        return _materialize(spread(linked_edges(self.hops, self.hubs_out, self.hubs_in), "src", "dst"), self.materialize)

    @cached_property
    def stats(self) -> DataFrame:
        """``counts`` with live_out, closed_out, out2."""
        st = self.counts.join(link_stats(self.links), "id", "left").fillna(0, ["live_out", "closed_out", "out2"])
        return _materialize(spread(st, "id"), self.materialize)

    def unpersist(self) -> None:
        for df in (self.weighted, *[self.__dict__[k] for k in ("counts", "links", "stats") if k in self.__dict__]):
            df.unpersist()


def _materialize(df: DataFrame, how: str | None) -> DataFrame:
    if how == "cache":
        return df.persist(StorageLevel.MEMORY_AND_DISK)
    if how == "checkpoint":
        return cut_lineage(df)
    return df


def _hubs(stats: DataFrame, col: str, bound: int) -> DataFrame | None:
    hubs = cut_lineage(hub_table(stats, col, bound))
    return None if hubs.isEmpty() else hubs


def vertex_counts(weighted: DataFrame) -> DataFrame:
    """Per vertex of (src, dst, m): degrees with multiplicity, distinct neighbours, repeated neighbours, reciprocal degree.

    With of_end and to_end (a part of a graph) the reciprocal degree is that of ends."""
    def end(c: str, out: bool):
        zero, one, many = F.lit(0).cast("bigint"), F.lit(1).cast("bigint"), (F.col("m") > 1).cast("bigint")
        here, there = (F.col("m"), one, many), (zero, zero, zero)
        o, i = (here, there) if out else (there, here)
        return F.struct(F.col(c).alias("id"), *[x.alias(n) for x, n in zip((*o, *i), ("o", "on", "orep", "i", "inn", "irep"))])

    sums = weighted.select(F.inline(F.array(end("src", True), end("dst", False)))).groupBy("id").agg(
        F.sum("o").alias("out_degree"), F.sum("i").alias("in_degree"), F.sum("on").alias("out_n"), F.sum("inn").alias("in_n"),
        F.sum("orep").alias("rep_out"), F.sum("irep").alias("rep_in"))
    own, to = (weighted.where("of_end"), weighted.where("to_end")) if "of_end" in weighted.columns else (weighted, weighted)
    back = to.select(F.col("dst").alias("src"), F.col("src").alias("dst"), F.col("m").alias("back"))
    bi = own.join(back, ["src", "dst"]).groupBy(F.col("src").alias("id")).agg(F.sum(F.col("m") * F.col("back")).alias("bi"))
    return sums.join(bi, "id", "left").select(
        "id", (F.col("in_degree") + F.col("out_degree")).alias("degree"), "in_degree", "out_degree",
        F.coalesce("bi", F.lit(0)).cast("bigint").alias("bi"), "out_n", "in_n", "rep_out", "rep_in")


def prepare_graph(edges: DataFrame, simple: bool = True, materialize: str | None = "cache",
                  chunk: int = DEFAULT_CHUNK, salt: bool = True, multi: bool = False) -> PreparedGraph:
    """``simple``: drop repeated edges and self-loops first (off: the edges are known to be simple).
    ``multi``: keep both, with the bag semantics of the module's docstring."""
    if multi:
        e = edges.groupBy("src", "dst").agg(F.count(F.lit(1)).alias("m"))
    else:
        e = (simple_graph(edges) if simple else edges.select("src", "dst")).withColumn("m", F.lit(1).cast("bigint"))
    # spread over both ends: a hub's edges lie in all parts, not in one
    e = _materialize(spread(e, "src", "dst"), materialize).withColumns({"of_end": F.lit(True), "to_end": F.lit(True)})
    return PreparedGraph(e, materialize, chunk, salt, multi)


def around(graph: PreparedGraph, pairs: DataFrame, paths: bool = True) -> PreparedGraph:
    """The part of ``graph`` that the features of ``pairs`` (u, v) depend on; all of it if they are many or the graph small.

    ``paths``: with the edges that leave the ends' out-neighbours; degrees and shared neighbours do without.
    """
    if pairs.count() > NEAR_PAIRS or graph.weighted.count() <= SMALL:   # two scalars
        return graph
    w = graph.weighted.select("src", "dst", "m")
    ends = cut_lineage(pairs.select(F.explode(F.array("u", "v")).alias("id")).where("id IS NOT NULL").distinct())
    some = ends
    if paths:
        first = w.join(bounded_broadcast(ends.withColumnRenamed("id", "src"), 2 * NEAR_PAIRS), "src", "left_semi")
        some = cut_lineage(ends.unionByName(first.select(F.col("dst").alias("id"))).distinct())
    few = some.count() <= NEAR_VERTICES     # one scalar
    left = some.join(bounded_broadcast(ends.withColumn("of_end", F.lit(True)), 2 * NEAR_PAIRS), "id", "left").withColumnRenamed("id", "src") \
        .withColumn("near", F.lit(True)) if paths else ends.select(F.col("id").alias("src"), F.lit(True).alias("of_end"), F.lit(True).alias("near"))
    right = bounded_broadcast(ends.select(F.col("id").alias("dst"), F.lit(True).alias("to_end")), 2 * NEAR_PAIRS)
    e = w.join(right, "dst", "left").join(bounded_broadcast(left, NEAR_VERTICES if few else None), "src", "left") \
        .where("near OR to_end").fillna(False, ["of_end", "to_end"]).select("src", "dst", "m", "of_end", "to_end")
    # as few files as its rows ask for
    return PreparedGraph(cut_lineage(e), "checkpoint", graph.chunk, graph.salt, graph.multi)


def as_prepared(graph, **kw) -> PreparedGraph:
    if isinstance(graph, PreparedGraph):
        return graph
    kw.setdefault("materialize", "checkpoint")  # the parts are read several times
    return prepare_graph(graph, **kw)
