"""Neighbourhood set sizes per vertex pair, as joins and aggregates.

No pairs are formed inside a neighbourhood. What two lists of neighbours share is
counted in one of two ways, chosen pair by pair from the lists' lengths:

* by lists (``_meet``): the lists travel as arrays of at most about ``LIST`` ids, a longer
  list as several, cut by a hash of the neighbour so that parts of two lists meet. A shared
  neighbour is found inside a row; what is shuffled is eight bytes for each
  neighbour of the *shorter* list, never a row.
* by rows, for pairs with a list beyond ``LONG`` or one more than ``APART`` times as many parts as the
  other: an expansion of the shorter list (hub-salted, see ``skew.expand``) followed by an
  equi-join on a composite edge key.

Both cost ``sum(min(deg u, deg v))``, never ``deg u * deg v``. All functions work on ``links``: one
row per distinct edge with its multiplicity ``m``, ``live`` (its target has an out-edge) and ``paths``.

* total neighbours: ``|A u B| = |A| + |B| - |A n B|``, from degrees.
* closed edges: ``paths`` of s -> n is the number of x with s -> x -> n: the members that O(s) and
  I(n) share, after O(s) has lost those without an out-edge and I(n) those without an in-edge.
  An edge is closed when it has such a path.
* friends measure: the n in O(u) u O(v) with an out-edge that are two hops from
  u or v. With C(u) the counted ones among O(u),
  ``|C(u)| + |C(v)| - |common n that are two hops from u or v|``:

  - a common n is counted iff u -> n or v -> n is closed: read off the rows of
    the common neighbours;
  - if v -> u is an edge, all of O(u) is two hops from v: C(u) is a degree;
  - otherwise C(u) holds the closed edges of u (a degree again) and those *open*
    edges u -> n whose n is two hops from v. Only these cross terms are
    enumerated, from the cheaper side: the two-hop set of v, or the open edges
    of u with a test for each.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewise.operators.skew import either, expand, lookup, spread
from edgewise.session import cut_lineage

DEFAULT_ENUM_LIMIT = 1_000_000   # max two-hop volume enumerated for one vertex
LIST = 8_192                     # neighbours in one array, about
LONG = 64 * LIST                 # a longer list is met by rows
APART = 4                        # a list is repeated for so many parts of a longer one at most


def _out_adj(links: DataFrame, key: str, val: str, *more: str) -> DataFrame:
    return links.select(F.col("src").alias(key), F.col("dst").alias(val), *more)


def _in_adj(links: DataFrame, key: str, val: str, *more: str) -> DataFrame:
    return links.select(F.col("dst").alias(key), F.col("src").alias(val), *more)


def _common(pair_deg: DataFrame, links: DataFrame, direction: str, hubs: DataFrame | None, carried: tuple[str, ...]) -> DataFrame:
    """(u, v, x, u_first, <c>_p, <c>_q): shared neighbours with columns of both edges; p is u where ``u_first``."""
    if direction == "out":
        du, dv, adj = "u_out", "v_out", _out_adj
    elif direction == "in":
        du, dv, adj = "u_in", "v_in", _in_adj
    else:
        raise ValueError(direction)
    u_first = F.col(du) <= F.col(dv)
    q = (pair_deg.where(F.least(F.col(du), F.col(dv)) > 0)
                 .select("u", "v", u_first.alias("u_first"),
                         F.when(u_first, F.col("u")).otherwise(F.col("v")).alias("p"),
                         F.when(u_first, F.col("v")).otherwise(F.col("u")).alias("q")))
    near = adj(links, "p", "x", *[F.col(c).alias(f"{c}_p") for c in carried])
    far = adj(links, "q", "x", *[F.col(c).alias(f"{c}_q") for c in carried])
    return expand(q, "p", near, "p", hubs, spread_cols=["x"]).join(far, ["q", "x"]).drop("p", "q")


def common_neighbour_rows(pair_deg: DataFrame, links: DataFrame, direction: str = "out",
                          hubs: DataFrame | None = None) -> DataFrame:
    """(u, v, x) for every x in O(u) n O(v) ('out') or I(u) n I(v) ('in').

    ``pair_deg`` needs u, v and the degree columns u_out, v_out / u_in, v_in;
    ``links`` one row per edge. ``hubs`` is the hub table for the expanded direction.
    """
    return _common(pair_deg, links, direction, hubs, ()).select("u", "v", "x")


def _parts(n):
    """Arrays that a list of ``n`` is cut into: a power of two, so that the parts of two lists nest."""
    return F.pow(F.lit(2), F.greatest(F.lit(0), F.ceil(F.log2(n / F.lit(LIST))))).cast("int")


def _in_lists():
    """Whether a pair (its shorter list p, its longer q) is met by lists."""
    return (F.col("q_n") <= LONG) & (_parts(F.col("q_n")) <= APART * _parts(F.col("p_n")))


def _lists(keys: DataFrame, adj: DataFrame, hubs: DataFrame | None, classes: dict) -> DataFrame:
    """(k, part, <class>..): arrays of the neighbours x of ``keys`` (k, n) in ``adj`` (k, x, ..) of each class."""
    rows = lookup(adj, "k", keys, hubs).withColumn("part", F.pmod(F.xxhash64("x"), _parts(F.col("n"))).cast("int"))
    return rows.groupBy("k", "part").agg(*[F.collect_list(F.when(cond, F.col("x"))).alias(c) for c, cond in classes.items()])


def _meet(pairs: DataFrame, adjs: list, hubs: DataFrame | None, classes: dict, ids: list[str]) -> DataFrame:
    """``pairs`` (ids, p_side, p, p_n, q_side, q, q_n) with the arrays p_<class>, q_<class>: a row for each part that meets.

    ``adjs``: the adjacency (k, x, ..) and its hubs of each side. ``hubs``: of the ids that many pairs share.
    """
    lists = None
    for side, (adj, of) in enumerate(adjs):
        keys = pairs.select(F.inline(F.array(*[F.struct(F.col(f"{e}_side").alias("side"), F.col(e).alias("k"), F.col(f"{e}_n").alias("n")) for e in "pq"]))) \
            .where(F.col("side") == side).select("k", "n").distinct()
        found = _lists(keys, adj, of, classes).withColumn("side", F.lit(side))
        lists = found if lists is None else lists.unionByName(found)
    rows = pairs.withColumn("q_part", F.explode(F.sequence(F.lit(0), _parts(F.col("q_n")) - 1))) \
        .withColumn("p_part", F.pmod(F.col("q_part"), _parts(F.col("p_n"))))
    dealt = [*ids, "q_part"]
    for e in "pq":
        table = lists.select(F.col("side").alias(f"{e}_side"), F.col("k").alias(e), F.col("part").alias(f"{e}_part"),
                             *[F.col(c).alias(f"{e}_{c}") for c in classes])
        rows = lookup(rows, e, table, hubs, also=(f"{e}_side", f"{e}_part"), dealt=dealt)
    return rows


def _shared(a, b):
    return F.size(F.array_intersect(a, b))


def _pq(pair_deg: DataFrame, direction: str) -> DataFrame:
    """Pairs with two lists as (u, v, u_first, p.., q..): p has the shorter one."""
    du, dv = f"u_{direction}", f"v_{direction}"
    u_first = F.col(du) <= F.col(dv)
    first, last = (lambda a, b: F.when(u_first, F.col(a)).otherwise(F.col(b))), (lambda a, b: F.when(u_first, F.col(b)).otherwise(F.col(a)))
    return pair_deg.where(F.least(F.col(du), F.col(dv)) > 0).select(
        "u", "v", u_first.alias("u_first"), F.lit(0).alias("p_side"), first("u", "v").alias("p"), first(du, dv).alias("p_n"),
        F.lit(0).alias("q_side"), last("u", "v").alias("q"), last(du, dv).alias("q_n"))


def _two_ways(pair_deg: DataFrame, links: DataFrame, direction: str, hubs: DataFrame | None, deal: DataFrame | None,
              classes: dict, sums: dict, carried: tuple[str, ...], row_sums: dict) -> DataFrame:
    """(u, v, <sum>..) over the shared neighbours; ``sums`` by lists, ``row_sums`` by rows."""
    pairs = _pq(pair_deg, direction)
    adj = (_out_adj if direction == "out" else _in_adj)(links, "k", "x", *carried)
    rows = _meet(pairs.where(_in_lists()), [(adj, hubs)], deal, classes, ["u", "v"])
    found = rows.select("u", "v", *[x.cast("bigint").alias(c) for c, x in sums.items()])
    far = pairs.where(~_in_lists())
    if not far.isEmpty():
        others = _common(pair_deg.join(far.select("u", "v"), ["u", "v"]), links, direction, hubs, carried)
        found = found.unionByName(others.groupBy("u", "v").agg(*[x.cast("bigint").alias(c) for c, x in row_sums.items()]))
    return found.groupBy("u", "v").agg(*[F.sum(c).alias(c) for c in sums])


def _repeated(every):
    """Shared neighbours' edges that occur more than once; ``every``(end) is its whole list."""
    some = lambda e, o: F.when(F.size(f"{e}_rep") > 0, _shared(F.col(f"{e}_rep"), every(o))).otherwise(0)
    return some("p", "q") + some("q", "p")


def common_counts(pair_deg: DataFrame, links: DataFrame, direction: str, hubs: DataFrame | None = None,
                  deal: DataFrame | None = None) -> DataFrame:
    """(u, v, n_common, n_repeated): shared neighbours, and how many of their edges occur more than once.

    ``pair_deg``: distinct pairs, written or cheap to make again; ``hubs`` of the direction, ``deal`` those
    that many pairs share.
    """
    repeated = (F.col("m_p") > 1).cast("int") + (F.col("m_q") > 1).cast("int")
    return _two_ways(
        pair_deg, links, direction, hubs, deal, {"xs": F.lit(True), "rep": F.col("m") > 1},
        {"n_common": _shared("p_xs", "q_xs"), "n_repeated": _repeated(lambda e: F.col(f"{e}_xs"))},
        ("m",), {"n_common": F.count(F.lit(1)), "n_repeated": F.sum(repeated)})


def out_common_counts(pair_deg: DataFrame, links: DataFrame, hubs: DataFrame | None = None, deal: DataFrame | None = None) -> DataFrame:
    """``common_counts`` of the out-direction with what the friends measure takes from the same neighbours.

    live_common: shared neighbours with an out-edge; reach_common: of those, closed from u or v;
    reach_apart: the same when paths over u -> v do not count.
    """
    repeated = (F.col("m_p") > 1).cast("int") + (F.col("m_q") > 1).cast("int")
    of_u = F.when(F.col("u_first"), F.col("paths_p")).otherwise(F.col("paths_q"))
    of_v = F.when(F.col("u_first"), F.col("paths_q")).otherwise(F.col("paths_p"))
    live = F.col("live_p")
    live_of = lambda e: F.concat(f"{e}_open", f"{e}_once", f"{e}_many")
    met = _shared(live_of("p"), live_of("q"))
    # not reached apart: one path at most from u, none from v
    least = lambda u, v: _shared(F.concat(f"{u}_open", f"{u}_once"), F.col(f"{v}_open"))
    return _two_ways(
        pair_deg, links, "out", hubs, deal,
        {"dead": ~F.col("live"), "open": F.col("live") & (F.col("paths") == 0), "once": F.col("live") & (F.col("paths") == 1),
         "many": F.col("live") & (F.col("paths") > 1), "rep": F.col("m") > 1},
        {"n_common": met + _shared("p_dead", "q_dead"), "n_repeated": _repeated(lambda e: F.concat(live_of(e), f"{e}_dead")),
         "live_common": met, "reach_common": met - _shared("p_open", "q_open"),
         "reach_apart": met - F.when(F.col("u_first"), least("p", "q")).otherwise(least("q", "p"))},
        ("m", "live", "paths"),
        {"n_common": F.count(F.lit(1)), "n_repeated": F.sum(repeated), "live_common": F.count_if(live),
         "reach_common": F.count_if(live & ((of_u > 0) | (of_v > 0))), "reach_apart": F.count_if(live & ((of_u > 1) | (of_v > 0)))})


def two_hop_paths(queries: DataFrame, links: DataFrame, hubs_out: DataFrame | None = None,
                  hubs_in: DataFrame | None = None) -> DataFrame:
    """(s, n, paths): the number of x with s -> x -> n, for the distinct (s, n, s_out, n_in) of ``queries`` that have one.

    The smaller of O(s) and I(n) is expanded, the other side probed.
    """
    by_out = F.col("s_out") <= F.col("n_in")
    via_out = expand(queries.where(by_out).select("s", "n"), "s", _out_adj(links, "s", "x"), "s", hubs_out) \
        .join(_out_adj(links, "x", "n"), ["x", "n"], "left_semi")
    via_in = expand(queries.where(~by_out).select("s", "n"), "n", _in_adj(links, "n", "x"), "n", hubs_in) \
        .join(_out_adj(links, "s", "x"), ["s", "x"], "left_semi")
    return via_out.select("s", "n").unionAll(via_in.select("s", "n")).groupBy("s", "n").agg(F.count(F.lit(1)).alias("paths"))


def path_counts(tests: DataFrame, edges: DataFrame, hubs_out: DataFrame | None = None, hubs_in: DataFrame | None = None) -> DataFrame:
    """(s, n, paths) of ``tests``, distinct (s, n) that have a path; ``edges`` (src, dst, dst_out, src_in).

    Only x with an in-edge and an out-edge is between two others: the lists hold no others.
    """
    first, second = edges.where(F.col("dst_out") > 0), edges.where(F.col("src_in") > 0)
    n = F.count(F.lit(1))
    rows = lookup(tests, "s", first.groupBy(F.col("src").alias("s")).agg(n.alias("s_out")), hubs_out)
    rows = lookup(rows, "n", second.groupBy(F.col("dst").alias("n")).agg(n.alias("n_in")), hubs_in)
    by_out = F.col("s_out") <= F.col("n_in")
    pick = lambda a, b: F.when(by_out, a).otherwise(b)
    s, d, zero, one = F.col("s"), F.col("n"), F.lit(0), F.lit(1)
    pairs = cut_lineage(rows.select(
        "s", "n", "s_out", "n_in", pick(zero, one).alias("p_side"), pick(s, d).alias("p"), pick(F.col("s_out"), F.col("n_in")).alias("p_n"),
        pick(one, zero).alias("q_side"), pick(d, s).alias("q"), pick(F.col("n_in"), F.col("s_out")).alias("q_n")))
    met = _meet(pairs.where(_in_lists()), [(_out_adj(first, "k", "x"), hubs_out), (_in_adj(second, "k", "x"), hubs_in)],
                either(hubs_out, hubs_in), {"xs": F.lit(True)}, ["s", "n"])
    found = met.select("s", "n", _shared("p_xs", "q_xs").cast("bigint").alias("paths")).where("paths > 0")
    far = pairs.where(~_in_lists()).select("s", "n", "s_out", "n_in")
    if not far.isEmpty():
        found = found.unionByName(two_hop_paths(far, edges, hubs_out, hubs_in))
    return found.groupBy("s", "n").agg(F.sum("paths").alias("paths"))


def end_degrees(edges: DataFrame, counts: DataFrame, hubs_out: DataFrame | None = None, hubs_in: DataFrame | None = None) -> DataFrame:
    """The edges with dst_out, the target's out-neighbours, and src_in, the source's in-neighbours; written once."""
    to = lookup(edges, "dst", counts.select(F.col("id").alias("dst"), F.col("out_n").alias("dst_out")), hubs_in)
    both = lookup(to, "src", counts.select(F.col("id").alias("src"), F.col("in_n").alias("src_in")), hubs_out)
    return cut_lineage(spread(both, "src", "dst"))


def linked_edges(both: DataFrame, hubs_out: DataFrame | None = None, hubs_in: DataFrame | None = None) -> DataFrame:
    """(src, dst, m, dst_out, live, paths): the edges of ``end_degrees`` that are asked for (``of_end``), with the paths that close them.

    Paths of edges to a target without out-edges are not asked for by any feature and stay 0.
    """
    asked = both.where("of_end")
    tests = asked.where(F.col("dst_out") > 0).select(F.col("src").alias("s"), F.col("dst").alias("n"))
    found = path_counts(tests, both, hubs_out, hubs_in).select(F.col("s").alias("src"), F.col("n").alias("dst"), "paths")
    return asked.join(found, ["src", "dst"], "left") \
        .select("src", "dst", "m", "dst_out", (F.col("dst_out") > 0).alias("live"), F.coalesce("paths", F.lit(0)).cast("bigint").alias("paths"))


def link_stats(links: DataFrame) -> DataFrame:
    """(id, live_out, closed_out, out2): live and closed out-edges, and length-2 paths that start at the vertex."""
    return links.groupBy(F.col("src").alias("id")).agg(
        F.count_if("live").alias("live_out"), F.count_if(F.col("live") & (F.col("paths") > 0)).alias("closed_out"),
        F.sum("dst_out").cast("bigint").alias("out2"))


def cross_queries(pair_deg: DataFrame, apart: bool = False) -> DataFrame:
    """(u, v, o, s, need, skip, o_open, s_out, s_out2): open edges of ``o`` to be tested for two hops from ``s``.

    ``pair_deg``: u, v, uv, vu (whether the pair is an edge, either way) and both
    ends' out, out2, open. With ``apart`` the edge u -> v does not count: neither
    as an open edge of u (``skip``), nor as a first hop, so that two paths are needed
    to a neighbour of v.
    """
    def side(o: str, s: str):
        joined = F.col("vu") if o == "u" else F.col("uv") & ~F.lit(apart)
        need = F.when(F.col("uv"), 2).otherwise(1) if apart and o == "v" else F.lit(1)
        skip = F.when(F.col("uv"), F.col("v")) if apart and o == "u" else F.lit(None).cast("bigint")
        return F.when(~joined & (F.col(f"{o}_open") > 0) & (F.col(f"{s}_out") > 0), F.struct(
            F.col(o).alias("o"), F.col(s).alias("s"), need.alias("need"), skip.alias("skip"), F.col(f"{o}_open").alias("o_open"),
            F.col(f"{s}_out").alias("s_out"), F.col(f"{s}_out2").alias("s_out2")))

    return pair_deg.select("u", "v", F.explode(F.array(side("u", "v"), side("v", "u"))).alias("q")) \
        .where(F.col("q").isNotNull()).select("u", "v", "q.*")


def cross_counts(queries: DataFrame, links: DataFrame, hops: DataFrame, hubs_out: DataFrame | None = None,
                 hubs_in: DataFrame | None = None, enum_limit: int = DEFAULT_ENUM_LIMIT) -> DataFrame | None:
    """(u, v, cross_u, cross_v): open edges of u (of v) that end two hops from the other end; None without queries.

    ``links``: of the pairs' ends. ``hops``: edges of ``end_degrees``, those of the ends' neighbours too.

    The two-hop set of ``s`` is enumerated, once, when that is no more work than
    testing all open edges asked of it one by one; a query then expands the smaller of
    the two-hop set and its open edges. The other queries test each open edge.
    """
    asked = queries.groupBy("s").agg(F.sum("o_open").alias("asked"))
    enum = (F.col("s_out2") <= enum_limit) & (F.col("s_out2") <= F.col("s_out") * F.col("asked"))
    way = F.when(~enum, "probe").when(F.col("s_out2") <= F.col("o_open"), "reach").otherwise("open")
    queries = cut_lineage(lookup(queries, "s", asked, hubs_out).withColumn("way", way))
    ways = {r["way"] for r in queries.select("way").distinct().collect()}
    open_ = links.where(F.col("live") & (F.col("paths") == 0))
    found = []
    if ways & {"reach", "open"}:
        starts = spread(queries.where(F.col("way") != "probe").select("s").distinct(), "s")
        first = expand(starts, "s", _out_adj(links, "s", "x"), "s", hubs_out)
        reach = expand(first, "x", _out_adj(hops.where(F.col("dst_out") > 0), "x", "n"), "x", hubs_out) \
            .groupBy("s", "n").agg(F.count(F.lit(1)).alias("paths"))
        reach = cut_lineage(reach) if {"reach", "open"} <= ways else reach
    if "reach" in ways:
        rows = expand(queries.where(F.col("way") == "reach"), "s", reach, "s", hubs_in, spread_cols=["n"])
        found.append(rows.where(F.col("paths") >= F.col("need")).join(_out_adj(open_, "o", "n"), ["o", "n"], "left_semi"))
    if ways & {"open", "probe"}:
        rows = expand(spread(queries.where(F.col("way") != "reach"), "u", "v"), "o", _out_adj(open_, "o", "n"), "o", hubs_out)
        if "open" in ways:
            found.append(rows.where(F.col("way") == "open").join(reach, ["s", "n"]).where(F.col("paths") >= F.col("need")))
        if "probe" in ways:
            probes = rows.where(F.col("way") == "probe")
            tests = probes.select("s", "n").distinct()
            found.append(probes.join(path_counts(tests, hops, hubs_out, hubs_in), ["s", "n"]).where(F.col("paths") >= F.col("need")))
    if not found:
        return None
    rows = reduce(DataFrame.unionAll, [f.select("u", "v", "o", "n", "skip") for f in found])
    kept = F.col("skip").isNull() | (F.col("n") != F.col("skip"))
    return rows.where(kept).groupBy("u", "v").agg(F.count_if(F.col("o") == F.col("u")).alias("cross_u"),
                                                  F.count_if(F.col("o") == F.col("v")).alias("cross_v"))
