"""The 22 topological pair features, as one Catalyst plan.

``pair_features(pairs, graph)`` = per-vertex statistics joined to both pair ends,
plus pair-keyed aggregates (common out, common in, cross terms of the friends
measure) joined on (u, v). Every counter defaults to 0, never NULL.

``graph`` is a ``PreparedGraph`` (statistics built once, reused by many calls) or
a plain edge DataFrame (prepared on the fly, its parts written once).

``exclude_target`` leaves the pair's own edge u -> v out of the graph, pair by
pair, without touching the graph: every counter is corrected by what that one
edge adds to it (see ``_without_target``). Graphs with repeated edges have no
single such edge and are refused.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewise.functions.features import (
    FEATURE_COLUMNS, FEATURE_NAMES, derived_columns, label_value,
)
from edgewise.operators.neighbours import (
    DEFAULT_ENUM_LIMIT, common_counts, common_neighbour_rows, cross_counts, cross_queries, out_common_counts,
)
from edgewise.operators.prepared import PreparedGraph, around, as_prepared
from edgewise.operators.skew import either, lookup, spread
from edgewise.session import cut_lineage


def clean_pairs(pairs: DataFrame) -> DataFrame:
    """Drop u = v pairs and keep one row per (u, v); a 'Y' label wins."""
    return (pairs.where(F.col("u") != F.col("v"))
                 .groupBy("u", "v").agg(F.max("label").alias("label")))


_END_COLS = {"degree": "degree", "in": "in_degree", "out": "out_degree", "bi": "bi", "in_n": "in_n", "out_n": "out_n",
             "in_rep": "rep_in", "out_rep": "rep_out", "live": "live_out", "closed": "closed_out", "out2": "out2"}


def attach_ends(pairs: DataFrame, graph: PreparedGraph, isolated: str = "drop", paths: bool = True) -> DataFrame:
    """Pairs with u_* and v_* vertex statistics. ``isolated='drop'`` removes
    pairs with an endpoint outside the graph, ``'zero'`` keeps them with 0s."""
    how = "inner" if isolated == "drop" else "left"
    out, stats = pairs, graph.stats if paths else graph.counts
    for end, hubs in (("v", graph.hubs_in), ("u", graph.hubs_out)):  # as many pairs of a hub as edges, if the pairs are edges
        cols = [F.col("id").alias(end)] + [F.col(c).alias(f"{end}_{k}") for k, c in _END_COLS.items() if c in stats.columns]
        out = lookup(out, end, stats.select(*cols), hubs, how)
    fill = {c: 0 for c in out.columns if c[:2] in ("u_", "v_")}
    return out.fillna(fill)


def pair_degrees(pairs: DataFrame, graph, isolated: str = "drop") -> DataFrame:
    pairs, g = _near(pairs, graph, False)
    d = attach_ends(pairs, g, isolated, False)
    return d.select("u", "v", "u_degree", "v_degree", "u_in", "u_out", "v_in", "v_out", "label")


def _near(pairs: DataFrame, graph, paths: bool) -> tuple[DataFrame, PreparedGraph]:
    """Clean pairs, written once, and the part of the graph that they need."""
    pairs = cut_lineage(clean_pairs(pairs))
    return pairs, around(as_prepared(graph), pairs, paths)


def _ends(pairs: DataFrame, g: PreparedGraph, isolated: str, paths: bool) -> DataFrame:
    """Clean pairs with endpoint statistics, written once, dealt over all tasks by a hash of (u, v) before the expansions."""
    return cut_lineage(spread(attach_ends(pairs, g, isolated, paths), "u", "v"))


def _sets(pd: DataFrame) -> DataFrame:
    """Pairs with the neighbour-set sizes (repeated edges once) that the expansions choose their side by."""
    return pd.select("u", "v", F.col("u_in_n").alias("u_in"), F.col("u_out_n").alias("u_out"),
                     F.col("v_in_n").alias("v_in"), F.col("v_out_n").alias("v_out"))


def _joined(pd: DataFrame, *counts: DataFrame) -> DataFrame:
    out = pd
    for c in counts:
        out = out.join(c, ["u", "v"], "left").fillna(0, [x for x in c.columns if x not in ("u", "v")])
    return out


def _common_of(direction: str, n: str = "n_common", repeated: str = "n_repeated"):
    """Neighbours with more than one row: shared ones, and ends' repeated ones that are not shared."""
    return (F.col(n) + F.col(f"u_{direction}_rep") + F.col(f"v_{direction}_rep") - F.col(repeated)).cast("bigint")


def _total_of(direction: str, n: str = "n_common"):
    return (F.col(f"u_{direction}_n") + F.col(f"v_{direction}_n") - F.col(n)).cast("bigint")


def _directed(pd: DataFrame, g: PreparedGraph, direction: str) -> DataFrame:
    c = common_counts(_sets(pd), g.weighted.where("of_end" if direction == "out" else "to_end"), direction, g.hubs_out if direction == "out" else g.hubs_in, either(g.hubs_out, g.hubs_in))
    return c.select("u", "v", F.col("n_common").alias(f"n_{direction}"), F.col("n_repeated").alias(f"r_{direction}"))


def total_friends(pairs: DataFrame, graph) -> DataFrame:
    """(u, v, total_out, total_in) = |O(u) u O(v)|, |I(u) u I(v)|; all pairs kept."""
    pairs, g = _near(pairs, graph, False)
    pd = _ends(pairs, g, "zero", False)
    j = _joined(pd, _directed(pd, g, "out"), _directed(pd, g, "in"))
    return j.select("u", "v", *[_total_of(d, f"n_{d}").alias(f"total_{d}") for d in ("out", "in")])


def common_friends(pairs: DataFrame, graph, directions: tuple[str, ...] = ("out", "in")) -> DataFrame:
    """(u, v, common_out, common_in) or one of the two; all pairs kept, 0 when none."""
    pairs, g = _near(pairs, graph, False)
    pd = _ends(pairs, g, "zero", False)
    j = _joined(pd, *[_directed(pd, g, d) for d in directions])
    return j.select("u", "v", *[_common_of(d, f"n_{d}", f"r_{d}").alias(f"common_{d}") for d in directions])


def shared_neighbour_rows(pairs: DataFrame, graph, direction: str = "out") -> DataFrame:
    """(u, v, x): one row per shared neighbour x of the pair."""
    pairs, g = _near(pairs, graph, False)
    pd = _ends(pairs, g, "zero", False)
    return common_neighbour_rows(_sets(pd), g.weighted, direction, g.hubs_out if direction == "out" else g.hubs_in)


def _linked(pd: DataFrame, g: PreparedGraph, apart: bool, enum_limit: int) -> DataFrame:
    """``pd`` with whether the pair is an edge either way, the shared out-neighbours and the cross terms."""
    there = g.links.select(F.col("src").alias("u"), F.col("dst").alias("v"), F.lit(True).alias("uv"),
                           (F.col("live") & (F.col("paths") > 0)).alias("uv_closed"))
    back = g.links.select(F.col("dst").alias("u"), F.col("src").alias("v"), F.lit(True).alias("vu"),
                          (F.col("live") & (F.col("paths") > 0)).alias("vu_closed"))
    pd = cut_lineage(pd.join(there, ["u", "v"], "left").join(back, ["u", "v"], "left").fillna(False, ["uv", "uv_closed", "vu", "vu_closed"]))
    asked = pd.select("u", "v", "uv", "vu", *[F.col(f"{e}_out_n").alias(f"{e}_out") for e in "uv"], "u_out2", "v_out2",
                      *[(F.col(f"{e}_live") - F.col(f"{e}_closed")).alias(f"{e}_open") for e in "uv"])
    cross = cross_counts(cross_queries(asked, apart), g.links, g.hops, g.hubs_out, g.hubs_in, enum_limit)
    pd = _joined(pd, out_common_counts(_sets(pd), g.links, g.hubs_out, either(g.hubs_out, g.hubs_in)))
    if cross is None:
        return pd.withColumns({"cross_u": F.lit(0), "cross_v": F.lit(0)})
    return _joined(pd, cross)


def _friends():
    """Friends measure from the columns of ``_linked``."""
    of_u = F.when(F.col("vu"), F.col("u_live")).otherwise(F.col("u_closed") + F.col("cross_u"))
    of_v = F.when(F.col("uv"), F.col("v_live")).otherwise(F.col("v_closed") + F.col("cross_v"))
    both = F.when(F.col("uv") | F.col("vu"), F.col("live_common")).otherwise(F.col("reach_common"))
    return (of_u + of_v - both).cast("bigint")


def _without_target():
    """The friends measure when the pair's own edge u -> v is not there.

    Of u's out-neighbours v goes, and those go that only a path over v closed (all shared ones have
    that path). v's out-neighbours are no longer all two hops from u: closed ones stay, open ones need a
    second path. u itself, as a neighbour of v, goes if it has no other out-edge.
    """
    lost = F.col("live_common") - F.col("reach_apart")
    of_u = F.when(F.col("vu"), F.col("u_live") - 1) \
        .otherwise(F.col("u_closed") - F.col("uv_closed").cast("int") - lost + F.col("cross_u"))
    of_v = F.col("v_closed") - (F.col("vu_closed") & (F.col("u_out_n") == 1)).cast("int") + F.col("cross_v")
    return F.when(F.col("uv"), of_u + of_v - F.col("reach_apart")).otherwise(_friends()).cast("bigint")


def friends_measure(pairs: DataFrame, graph, enum_limit: int = DEFAULT_ENUM_LIMIT) -> DataFrame:
    """(u, v, friends_measure); all pairs kept, 0 when none."""
    pairs, g = _near(pairs, graph, True)
    return _linked(_ends(pairs, g, "zero", True), g, False, enum_limit).select("u", "v", _friends().alias("friends_measure"))


def pair_features(pairs: DataFrame, graph, isolated: str = "drop", enum_limit: int = DEFAULT_ENUM_LIMIT,
                  exclude_target: bool = False) -> DataFrame:
    """u, v, the 22 features in fixed order, label.

    ``exclude_target``: as if the edge u -> v were not in the graph (see the module's docstring); a pair
    that loses its last edge counts as isolated.
    """
    g = as_prepared(graph)
    if exclude_target and g.multi:
        raise ValueError("exclude_target needs a graph without repeated edges")
    pairs, g = _near(pairs, g, True)
    j = _linked(_ends(pairs, g, isolated, True), g, exclude_target, enum_limit)
    j = _joined(j, _directed(j, g, "in"))
    own = F.col("uv").cast("int") if exclude_target else F.lit(0)
    mutual = (F.col("uv") & F.col("vu")).cast("int") if exclude_target else F.lit(0)
    less = {"u_degree": own, "v_degree": own, "u_out": own, "v_in": own, "u_bi": mutual, "v_bi": mutual}
    counters = j.select(
        "u", "v", *[(F.col(c) - less.get(c, F.lit(0))).cast("bigint").alias(c)
                    for c in ("u_degree", "v_degree", "u_in", "u_out", "u_bi", "v_in", "v_out", "v_bi")],
        _common_of("in", "n_in", "r_in").alias("common_in"), _common_of("out").alias("common_out"),
        (_total_of("in", "n_in") - own).cast("bigint").alias("total_in"), (_total_of("out") - own).cast("bigint").alias("total_out"),
        (_without_target() if exclude_target else _friends()).alias("friends_measure"), "label")
    if exclude_target and isolated == "drop":
        counters = counters.where((F.col("u_degree") > 0) & (F.col("v_degree") > 0))
    return counters.select("u", "v", *FEATURE_NAMES[:13], *derived_columns(), "label").select(*FEATURE_COLUMNS)


def edge_features(graph, **kw) -> DataFrame:
    """Features of every edge of the graph, each labelled 'Y'."""
    g = as_prepared(graph)
    pairs = g.edges.select(F.col("src").alias("u"), F.col("dst").alias("v"), F.lit("Y").alias("label"))
    return pair_features(pairs, g, **kw)


def label_encode(df: DataFrame, label: str = "label", out: str = "label_value") -> DataFrame:
    return df.withColumn(out, label_value(label))


def feature_subset(features: DataFrame, indexes: list[int], keep_ids: bool = True) -> DataFrame:
    """Project the features at the given 0-based indexes, in that order."""
    cols = [F.col(FEATURE_NAMES[i]) for i in indexes]
    ids = [F.col("u"), F.col("v")] if keep_ids else []
    return features.select(*ids, *cols, label_value("label").alias("label_value"))


def feature_vectors(features: DataFrame, indexes: list[int] | None = None,
                    as_array: bool = False) -> DataFrame:
    """(u, v, label_value, features): the labelled-point form.

    With ``as_array`` the vector is an ARRAY<DOUBLE> (SQL friendly);
    otherwise an ML ``VectorUDT`` built by ``VectorAssembler``.
    """
    idx = list(range(len(FEATURE_NAMES))) if indexes is None else list(indexes)
    cols = [FEATURE_NAMES[i] for i in idx]
    base = features.select("u", "v", label_value("label").alias("label_value"),
                           *[F.col(c).cast("double").alias(c) for c in cols])
    if as_array:
        return base.select("u", "v", "label_value", F.array(*cols).alias("features"))
    from pyspark.ml.feature import VectorAssembler
    va = VectorAssembler(inputCols=cols, outputCol="features")
    return va.transform(base).select("u", "v", "label_value", "features")
