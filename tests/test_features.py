"""Pair features on the toy graphs and against a brute-force set model."""

import random
from fractions import Fraction

import pytest

from conftest import pairs_df
from edgewise.functions.features import FEATURE_COLUMNS
from edgewise.operators import features, neighbours, prepared
from edgewise.operators.prepared import prepare_graph
from edgewise.sources.graphs import simple_graph

T1_PAIRS = [(1, 2, "Y"), (1, 3, "Y"), (1, 5, "N"), (2, 4, "N"), (4, 1, "N"), (6, 1, "N")]

# u, v -> common_in, common_out, total_in, total_out, friends_measure, pref_attachment
T1_EXPECTED = {
    (1, 2): (0, 1, 3, 4, 4, 16),
    (1, 3): (0, 1, 3, 4, 4, 16),
    (1, 5): (0, 1, 3, 3, 2, 12),
    (2, 4): (1, 1, 3, 2, 0, 12),
    (4, 1): (1, 0, 2, 4, 4, 12),
}
T1_DEGREES = {1: (4, 1, 3, 1), 2: (4, 2, 2, 1), 3: (4, 2, 2, 1), 4: (3, 2, 1, 0), 5: (3, 2, 1, 1)}


def _rows(df):
    return {(r["u"], r["v"]): r for r in df.collect()}


def _check_t1(rows):
    assert set(rows) == set(T1_EXPECTED)          # (6, 1) dropped: 6 is isolated
    for k, (ci, co, ti, to, fm, pa) in T1_EXPECTED.items():
        r = rows[k]
        assert (r.common_in, r.common_out, r.total_in, r.total_out, r.friends_measure,
                r.pref_attachment) == (ci, co, ti, to, fm, pa), k
        assert r.jaccard_in == (ci / ti if ti else 0.0)
        assert r.jaccard_out == (co / to if to else 0.0)
        for end, vid in (("u", k[0]), ("v", k[1])):
            d, i, o, b = T1_DEGREES[vid]
            assert (r[f"{end}_degree"], r[f"{end}_in"], r[f"{end}_out"], r[f"{end}_bi"]) == (d, i, o, b)
            assert r[f"{end}_in_density"] == i / d
            assert r[f"{end}_bi_density"] == b / d


def test_t1_features(spark, t1_edges):
    out = features.pair_features(pairs_df(spark, T1_PAIRS), t1_edges)
    assert out.columns == FEATURE_COLUMNS
    _check_t1(_rows(out))


@pytest.mark.parametrize("chunk,enum_limit", [(1, 0), (2, 3)])
def test_t1_salted_and_probe_paths(spark, t1_edges, chunk, enum_limit):
    g = prepare_graph(t1_edges, chunk=chunk)
    assert g.hubs_out is not None                   # every vertex is a salted hub here
    _check_t1(_rows(features.pair_features(pairs_df(spark, T1_PAIRS), g, enum_limit=enum_limit)))


def test_t1_variants(spark, t1_edges):
    # duplicate edge and self-loop: the simple graph gives the same table
    noisy = t1_edges.unionByName(spark.createDataFrame([(1, 2), (3, 3)], "src bigint, dst bigint"))
    _check_t1(_rows(features.pair_features(pairs_df(spark, T1_PAIRS), simple_graph(noisy))))
    # label clash keeps one row labelled Y; u = v pairs are filtered
    clash = pairs_df(spark, [(1, 2, "N"), (1, 2, "Y"), (1, 1, "N")])
    rows = _rows(features.pair_features(clash, t1_edges))
    assert list(rows) == [(1, 2)] and rows[(1, 2)].label == "Y"


def test_isolated_zero(spark, t1_edges):
    rows = _rows(features.pair_features(pairs_df(spark, [(6, 1, "N")]), t1_edges, isolated="zero"))
    r = rows[(6, 1)]
    # N = O(1) = {2, 3, 4}; 2 -> 3 and 3 -> 4 inside N, both heads have out-edges
    assert (r.u_degree, r.v_degree, r.total_out, r.common_out, r.friends_measure) == (0, 4, 3, 0, 2)
    assert r.u_in_density == 0.0


def test_reference_neighbour_toy(spark):
    # A..W mapped to ids: A1 B2 C3 X4 Y5 Z6 W7
    edges = spark.createDataFrame([(1, 3), (1, 2), (4, 3), (4, 2), (5, 3)], "src bigint, dst bigint")
    pairs = pairs_df(spark, [(1, 2, "N"), (4, 5, "N"), (6, 7, "N")])
    tot = {(r.u, r.v): r.total_out for r in features.total_friends(pairs, edges).collect()}
    assert tot == {(1, 2): 2, (4, 5): 2, (6, 7): 0}
    shared = [(r.u, r.v, r.x) for r in features.shared_neighbour_rows(pairs, edges).collect()]
    assert shared == [(4, 5, 3)]


# ----------------------------------------------------------------- brute force

def brute_features(edges, pairs):
    E = set((a, b) for a, b in edges if a != b)
    out, inn = {}, {}
    for a, b in E:
        out.setdefault(a, set()).add(b)
        inn.setdefault(b, set()).add(a)
    verts = set(out) | set(inn)
    res = {}
    for u, v in {(u, v) for u, v in pairs if u != v}:
        if u not in verts or v not in verts:
            continue
        O = lambda x: out.get(x, set())
        I = lambda x: inn.get(x, set())
        N = O(u) | O(v)
        fm = sum(1 for n in N if O(n) and any((m, n) in E for m in N))
        bi = lambda x: sum(1 for n in O(x) if x in O(n))
        res[(u, v)] = dict(
            common_in=len(I(u) & I(v)), common_out=len(O(u) & O(v)),
            total_in=len(I(u) | I(v)), total_out=len(O(u) | O(v)), friends_measure=fm,
            u_bi=bi(u), v_bi=bi(v), u_degree=len(O(u)) + len(I(u)), v_degree=len(O(v)) + len(I(v)),
            jaccard_out=float(Fraction(len(O(u) & O(v)), len(N))) if N else 0.0)
    return res


@pytest.mark.parametrize("seed", [1, 2])
def test_random_graphs_match_brute_force(spark, seed):
    rnd = random.Random(seed)
    n = 25
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(120)]
    pairs = [(rnd.randrange(n + 3), rnd.randrange(n + 3), rnd.choice("YN")) for _ in range(80)]
    e_df = spark.createDataFrame(edges, "src bigint, dst bigint")
    expected = brute_features(edges, [(u, v) for u, v, _ in pairs])
    for kw in ({}, {"chunk": 3}):
        g = prepare_graph(e_df, **kw)
        for enum_limit in (1_000_000, 10):
            got = _rows(features.pair_features(pairs_df(spark, pairs), g, enum_limit=enum_limit))
            assert set(got) == set(expected)
            for k, exp in expected.items():
                for col, val in exp.items():
                    assert got[k][col] == val, (k, col, kw, enum_limit)


def test_no_cartesian_or_python_in_plan(spark, t1_edges):
    df = features.pair_features(pairs_df(spark, T1_PAIRS), t1_edges)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan


def test_feature_vectors_and_subset(spark, t1_edges):
    f = features.pair_features(pairs_df(spark, T1_PAIRS), t1_edges)
    arr = features.feature_vectors(f, as_array=True).collect()
    assert all(len(r.features) == 22 for r in arr)
    vec = features.feature_vectors(f, [12, 11]).collect()
    assert {(r.u, r.v): list(r.features) for r in vec}[(1, 2)] == [4.0, 4.0]
    sub = features.feature_subset(f, [12, 11, 4]).columns
    assert sub == ["u", "v", "friends_measure", "total_out", "u_bi", "label_value"]


def test_hub_holding_a_third_of_edges(spark):
    """One vertex owns a third of all edges (in and out); with a small salt
    chunk its adjacency is split over many buckets and results stay exact."""
    rnd = random.Random(11)
    n, hub = 40, 0
    edges = [(rnd.randrange(1, n), rnd.randrange(1, n)) for _ in range(160)]
    edges += [(hub, v) for v in range(1, n)] + [(v, hub) for v in range(1, n, 2)]
    pairs = [(hub, v, "Y") for v in range(1, 12)] + [(v, hub, "N") for v in range(5, 15)] + \
            [(rnd.randrange(n), rnd.randrange(n), "N") for _ in range(40)]
    e_df = spark.createDataFrame(edges, "src bigint, dst bigint")
    g = prepare_graph(e_df, chunk=4)
    hubs = {r.id: r.salts for r in g.hubs_out.collect()}
    assert hubs[hub] >= 10                       # the hub is split into >= 10 salt buckets
    expected = brute_features(edges, [(u, v) for u, v, _ in pairs])
    for enum_limit in (1_000_000, 20):
        got = _rows(features.pair_features(pairs_df(spark, pairs), g, enum_limit=enum_limit))
        assert set(got) == set(expected)
        for k, exp in expected.items():
            for col, val in exp.items():
                assert got[k][col] == val, (k, col, enum_limit)


# ----------------------------------------------------------------- own edge left out, repeated edges

def brute_without_target(edges, pairs):
    """Each pair on the graph less its own edge; isolated ends stay with zeros."""
    E = {(a, b) for a, b in edges if a != b}
    res = {}
    for u, v in {(u, v) for u, v in pairs if u != v}:
        e = E - {(u, v)}
        O = lambda x: {b for a, b in e if a == x}
        I = lambda x: {a for a, b in e if b == x}
        N = O(u) | O(v)
        res[u, v] = dict(
            u_out=len(O(u)), u_in=len(I(u)), v_out=len(O(v)), v_in=len(I(v)), u_degree=len(O(u)) + len(I(u)),
            v_degree=len(O(v)) + len(I(v)), u_bi=len(O(u) & I(u)), v_bi=len(O(v) & I(v)),
            common_out=len(O(u) & O(v)), common_in=len(I(u) & I(v)), total_out=len(N), total_in=len(I(u) | I(v)),
            friends_measure=sum(1 for n in N if O(n) and any((m, n) in e for m in N)),
            u_out_density=len(O(u)) / (len(O(u)) + len(I(u))) if O(u) or I(u) else 0.0)
    return res


@pytest.mark.parametrize("n,m", [(9, 30), (16, 40), (7, 35)])
def test_the_pairs_own_edge_is_left_out(spark, n, m):
    rnd = random.Random(n * m)
    edges = [(rnd.randrange(n), rnd.randrange(n)) for _ in range(m)] + [(n, n + 1), (n + 1, n), (n + 2, n + 3)]
    pairs = [(a, b, "Y") for a, b in edges] + [(rnd.randrange(n + 5), rnd.randrange(n + 5), "N") for _ in range(60)]
    expected = brute_without_target(edges, [(u, v) for u, v, _ in pairs])
    e_df = spark.createDataFrame(edges, "src bigint, dst bigint")
    for kw, enum_limit in (({}, 1_000_000), ({"chunk": 2}, 0)):
        g = prepare_graph(e_df, **kw)
        got = _rows(features.pair_features(pairs_df(spark, pairs), g, isolated="zero", exclude_target=True, enum_limit=enum_limit))
        assert set(got) == set(expected)
        for k, exp in expected.items():
            for col, val in exp.items():
                assert got[k][col] == val, (k, col, kw)
    dropped = _rows(features.pair_features(pairs_df(spark, pairs), g, exclude_target=True))
    assert set(dropped) == {k for k, x in expected.items() if x["u_degree"] and x["v_degree"]}
    assert (n + 2, n + 3) not in dropped


def test_the_own_edge_needs_a_simple_graph(spark, t1_edges):
    with pytest.raises(ValueError):
        features.pair_features(pairs_df(spark, T1_PAIRS), prepare_graph(t1_edges, multi=True), exclude_target=True)


def brute_multi(edges, pairs):
    """The bag form: every edge row counts."""
    from collections import Counter
    res = {}
    rows_out = lambda x: [b for a, b in edges if a == x]
    rows_in = lambda x: [a for a, b in edges if b == x]
    for u, v in {(u, v) for u, v in pairs if u != v}:
        ou, ov, iu, iv = rows_out(u), rows_out(v), rows_in(u), rows_in(v)
        if not (ou or iu) or not (ov or iv):
            continue
        N = set(ou) | set(ov)
        res[u, v] = dict(
            u_degree=len(ou) + len(iu), v_in=len(iv), v_out=len(ov),
            u_bi=sum(c == u for b in ou for c in rows_out(b)), v_bi=sum(c == v for b in ov for c in rows_out(b)),
            common_out=sum(c > 1 for c in Counter(ou + ov).values()), common_in=sum(c > 1 for c in Counter(iu + iv).values()),
            total_out=len(N), total_in=len(set(iu) | set(iv)),
            friends_measure=sum(1 for x in N if rows_out(x) and any((y, x) in set(edges) for y in N)))
    return res


@pytest.mark.parametrize("enum_limit", [1_000_000, 0])
def test_repeated_edges_and_self_loops_count(spark, enum_limit):
    rnd = random.Random(8)
    edges = [(rnd.randrange(12), rnd.randrange(12)) for _ in range(70)]
    assert len(set(edges)) < len(edges) and any(a == b for a, b in edges)
    pairs = [(rnd.randrange(14), rnd.randrange(14), "N") for _ in range(90)]
    g = prepare_graph(spark.createDataFrame(edges, "src bigint, dst bigint"), multi=True, chunk=4)
    got = _rows(features.pair_features(pairs_df(spark, pairs), g, enum_limit=enum_limit))
    expected = brute_multi(edges, [(u, v) for u, v, _ in pairs])
    assert set(got) == set(expected)
    for k, exp in expected.items():
        for col, val in exp.items():
            assert got[k][col] == val, (k, col)


def _node_rows(plan):
    """numOutputRows of every node of an executed plan, through its adaptive stages."""
    name = plan.nodeName()
    if name.startswith("AdaptiveSparkPlan"):
        return _node_rows(plan.executedPlan())
    metric = plan.metrics().get("numOutputRows")
    out = [(name, metric.get().value())] if metric.isDefined() else []
    if "QueryStage" in name:
        return out + _node_rows(plan.plan())
    for i in range(plan.children().size()):
        out += _node_rows(plan.children().apply(i))
    return out


def test_hub_pairs_stay_far_below_the_square_of_its_degree(spark):
    """Every edge of a hub with D out- and D/2 in-neighbours as a pair: no step makes rows by D squared."""
    d = 2000
    edges = [(0, i) for i in range(1, d + 1)] + [(i, 0) for i in range(1, d + 1, 2)] + [(i, i % d + 1) for i in range(1, d + 1, 3)]
    g = prepare_graph(spark.createDataFrame(edges, "src bigint, dst bigint"), materialize="checkpoint", chunk=500)
    df = features.edge_features(g)
    rows = df.collect()
    assert len(rows) == len(edges)
    most = max(n for _, n in _node_rows(df._jdf.queryExecution().executedPlan()))
    assert most < 20 * len(edges) < d * d / 20
    out = {}
    for a, b in edges:
        out.setdefault(a, set()).add(b)
    for r in rows[::97]:
        n = out.get(r.u, set()) | out.get(r.v, set())
        hops = set().union(*[out.get(m, set()) for m in n])
        assert r.friends_measure == sum(1 for x in n if out.get(x) and x in hops), (r.u, r.v)


# ----------------------------------------------------------------- lists of neighbours, parts of a graph

@pytest.mark.parametrize("size,long,apart,small", [(2, 1_000, 64, 0), (2, 5, 1, 1_000_000)])
def test_lists_in_parts_and_pairs_by_rows_count_the_same(spark, monkeypatch, size, long, apart, small):
    monkeypatch.setattr(neighbours, "LIST", size)
    monkeypatch.setattr(neighbours, "LONG", long)
    monkeypatch.setattr(neighbours, "APART", apart)
    monkeypatch.setattr(prepared, "SMALL", small)
    rnd = random.Random(size + long)
    edges = [(rnd.randrange(14), rnd.randrange(14)) for _ in range(90)]
    pairs = [(rnd.randrange(16), rnd.randrange(16), "N") for _ in range(80)] + [(a, b, "Y") for a, b in edges[:30]]
    e_df, asked = spark.createDataFrame(edges, "src bigint, dst bigint"), [(u, v) for u, v, _ in pairs]
    for expected, kw, how in ((brute_without_target(edges, asked), {}, {"isolated": "zero", "exclude_target": True}),
                              (brute_multi(edges, asked), {"multi": True, "chunk": 4}, {})):
        got = _rows(features.pair_features(pairs_df(spark, pairs), prepare_graph(e_df, **kw), **how))
        assert set(got) == set(expected)
        for k, exp in expected.items():
            for col, val in exp.items():
                assert got[k][col] == val, (k, col, kw)


def test_pairs_ask_for_their_part_of_the_graph_only(spark, monkeypatch):
    monkeypatch.setattr(prepared, "SMALL", 0)
    edges = [(a, b) for k in range(0, 200, 10) for a in range(k, k + 10) for b in range(k, k + 10) if a != b]
    g = prepare_graph(spark.createDataFrame(edges, "src bigint, dst bigint"), materialize="checkpoint")
    pairs = pairs_df(spark, [(1, 2, "Y"), (3, 11, "N")])
    part = prepared.around(g, pairs)
    assert part.weighted.count() == 180 and part.links.count() == 4 * 9
    assert prepared.around(g, pairs, paths=False).weighted.count() == 66
    assert _rows(features.pair_features(pairs, g))[1, 2]["friends_measure"] == 10
    assert not {"counts", "links", "hops"} & set(g.__dict__)      # nothing was built for the whole graph


def test_paths_are_counted_without_a_row_for_each(spark):
    n = 40
    both = spark.createDataFrame([(a, b, n - 1, n - 1) for a in range(n) for b in range(n) if a != b], "src bigint, dst bigint, dst_out bigint, src_in bigint")
    found = neighbours.path_counts(both.selectExpr("src AS s", "dst AS n"), both)
    assert {r.paths for r in found.collect()} == {n - 2}
    assert max(rows for _, rows in _node_rows(found._jdf.queryExecution().executedPlan())) <= 4 * n * (n - 1)  # far below n * (n - 1) * (n - 2)
