"""Graph operators, samplers and file round trips."""

import os

from pyspark.sql import functions as F

from conftest import pairs_df
from edgewise.functions.hashing import MODULUS, pair_hash, poisson_thresholds
from edgewise.operators import graph as G
from edgewise.operators import sampling as S
from edgewise.session import scratch_dir
from edgewise.sources import files, graphs


def test_degrees_and_reciprocity(spark, t1_edges):
    d = {r.id: (r.degree, r.in_degree, r.out_degree) for r in G.vertex_degrees(t1_edges).collect()}
    assert d == {1: (4, 1, 3), 2: (4, 2, 2), 3: (4, 2, 2), 4: (3, 2, 1), 5: (3, 2, 1)}
    bi = {r.id: r.bi for r in G.reciprocal_degree(t1_edges).collect()}
    assert bi == {1: 1, 2: 1, 3: 1, 5: 1}
    # a self-loop adds one to each direction, multiplicity counts
    loops = spark.createDataFrame([(7, 7), (7, 8), (7, 8)], "src bigint, dst bigint")
    d = {r.id: (r.degree, r.in_degree, r.out_degree) for r in G.vertex_degrees(loops).collect()}
    assert d == {7: (4, 1, 3), 8: (2, 2, 0)}


def test_summary_and_subgraph(spark, t1_edges):
    s = G.graph_summary(t1_edges, pairs_df(spark, [(1, 2, "Y")])).first()
    assert (s.edges, s.vertices, s.pairs) == (9, 5, 1)
    vs = spark.createDataFrame([(1,), (2,), (3,)], "id bigint")
    sub = sorted(tuple(r) for r in G.induced_subgraph(t1_edges, vs).collect())
    assert sub == [(1, 2), (1, 3), (2, 3), (3, 1)]
    rev = sorted(tuple(r) for r in G.reverse_edges(t1_edges).collect())
    assert (2, 1) in rev and len(rev) == 9


def test_property_graph_toy(spark):
    verts = spark.createDataFrame([(3, "rxin", "student"), (7, "jgonzal", "postdoc"),
                                   (5, "franklin", "prof"), (2, "istoica", "prof")],
                                  "id bigint, name string, role string")
    edges = spark.createDataFrame([(3, 7, "collab"), (5, 3, "advisor"), (2, 5, "advisor"),
                                   (5, 7, "pi"), (9, 3, "collab")], "src bigint, dst bigint, rel string")
    pv = G.property_graph_vertices(edges, verts)
    assert G.vertex_predicate_count(pv, "prof").first().n_vertices == 2
    assert G.edge_predicate_count(edges, "advisor").first().n_edges == 2
    assert {r.id: (r.name, r.role) for r in pv.collect()}[9] == ("John Doe", "Missing")


def test_two_hop_proposals_are_two_hop(spark, t1_edges):
    allowed = {(1, 3), (1, 4), (1, 5), (2, 1), (2, 4), (3, 2), (3, 4), (3, 5), (4, 2), (5, 3)}
    got = {(r.u, r.v) for r in S.two_hop_pairs(t1_edges, 7).collect()}
    assert got and got <= allowed
    guarded = {(r.u, r.v) for r in S.non_edge_guard(S.two_hop_pairs(t1_edges, 7), t1_edges).collect()}
    assert guarded == got - {(1, 3), (1, 4), (3, 4)}


def test_poisson_thresholds_rule():
    t = poisson_thresholds(0.2)
    assert t[0] == round(MODULUS * 0.8187307530779818)
    assert t == sorted(set(t)) and t[-1] < MODULUS
    # thresholds continue until the rounded CDF reaches the modulus
    assert len(t) >= 5 and MODULUS - t[-1] < MODULUS * 1e-8


def test_samplers_deterministic_and_capped(spark):
    edges = spark.range(0, 3000).select((F.col("id") % 300).alias("src"),
                                         ((F.col("id") * 7 + 13) % 300).alias("dst"))
    edges = graphs.simple_graph(edges)
    vs = S.vertex_sample(edges, 11, fraction=0.5, cap=60)
    ids = [r.id for r in vs.collect()]
    assert len(ids) == 60 and ids == [r.id for r in S.vertex_sample(edges, 11, 0.5, 60).collect()]
    # the cap keeps the smallest hashes among those under the threshold
    allv = G.vertices_of(edges).select("id", pair_hash("id", 0, 11).alias("h")).collect()
    below = sorted((r.h, r.id) for r in allv if r.h < int(0.5 * MODULUS))
    assert sorted(ids) == sorted(i for _, i in below[:60])
    uncapped = S.positive_pairs(edges, 11, cap=None).count()
    pos = S.positive_pairs(edges, 11, cap=40)
    assert pos.count() == min(40, uncapped) and {r.label for r in pos.collect()} == {"Y"}
    hard = S.hard_negatives(edges, 11, cap=50).collect()
    assert len(hard) == 50 and all(r.u != r.v for r in hard)
    e1 = S.easy_negatives_weighted(edges, 11, n_draws=200, cap=150).collect()
    assert len(e1) == 150
    e2 = S.easy_negatives_uniform(vs, 11, n_draws=100, cap=40).collect()
    assert len(e2) == 40 and {r.u for r in e2} <= set(ids)


def test_positive_pairs_filter_by_one_threshold_and_count_copies_after(spark):
    edges = spark.range(600).select((F.col("id") % 37).alias("src"), (F.col("id") * 7 + 100).alias("dst"))
    edges = edges.unionByName(spark.createDataFrame([(None, 5), (6, None)], "src bigint, dst bigint"))
    hashes = edges.select("src", "dst", pair_hash("src", "dst", 11).alias("h")).collect()
    for rate in (0.0, 0.2, 2.5):
        t = poisson_thresholds(rate)
        want = sorted((r.src, r.dst, "Y") for r in hashes if r.h is not None for x in t if r.h >= x)
        pairs = S.positive_pairs(edges, 11, rate, cap=None)
        assert sorted(tuple(r) for r in pairs.collect()) == want and bool(want) == (rate > 0)
        # the hash enters the filter once, not once for each number of copies: the compiled filter stays small
        filters = [x for x in pairs._jdf.queryExecution().optimizedPlan().toString().splitlines() if "Filter" in x]
        assert not any(str(x) in f for f in filters for x in t[1:])


def test_endpoint_index_is_dense_and_the_same_for_any_bucket_size(spark, t1_edges):
    whole = sorted(tuple(r) for r in S.endpoint_index(t1_edges).collect())
    assert [i for i, _ in whole] == list(range(18))
    for rows in (1, 3, 7):
        assert sorted(tuple(r) for r in S.endpoint_index(t1_edges, bucket_rows=rows).collect()) == whole


def test_vertex_sample_follows_the_graph_beyond_25000(spark):
    counts = []
    for n in (60_000, 240_000):
        edges = spark.range(n).select(F.col("id").alias("src"), (F.col("id") * 31 + 7).alias("dst"))
        counts.append(S.vertex_sample(edges, 5).count())
    assert counts[1] > 3.5 * counts[0] > 3.5 * 25_000


def test_draws_reach_positions_beyond_2_to_the_31(spark):
    length = 1 << 40
    rows = S._draws(spark, 2000, length, 9, 1, 2).collect()
    at = [x for r in rows for x in (r.i1, r.i2)]
    assert all(0 <= x < length for x in at) and len(set(at)) == len(at)
    assert sum(x > length // 2 for x in at) > 0.45 * len(at) and max(at) > 0.99 * length


def test_two_hop_draws_reach_every_end_and_leave_edges_out(spark):
    # hub 0 has 600 in-neighbours and 40 out-neighbours
    edges = [(1000 + i, 0) for i in range(600)] + [(0, 1 + i) for i in range(40)] + [(1000, 5)]
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    pairs = [tuple(r) for r in S.two_hop_pairs(df, 3).collect()]
    assert len(pairs) == len(set(pairs)) == 600 and {v for _, v in pairs} == set(range(1, 41))
    known = set(edges)
    assert all((r.u, r.v) not in known for r in S.hard_negatives(df, 3, cap=None).collect())
    back = spark.createDataFrame([(1, 2), (2, 1), (2, 3)], "src bigint, dst bigint")
    assert [tuple(r) for r in S.two_hop_pairs(back, 3).collect()] == [(1, 3)]


def test_split_fractions(spark):
    df = spark.range(20000).select(F.col("id").alias("u"), (F.col("id") * 3 + 1).alias("v"))
    counts = {r.split: r["count"] for r in S.train_val_test_split(df).groupBy("split").count().collect()}
    assert abs(counts[0] / 20000 - 0.6) < 0.03 and abs(counts[2] / 20000 - 0.2) < 0.03


def test_edge_list_and_pairs_roundtrip(spark):
    path = scratch_dir(spark, "edgelist-test")
    local = path[len("file:"):] if path.startswith("file:") else path
    os.makedirs(local)
    with open(os.path.join(local, "part.txt"), "w") as fh:
        fh.write("# a comment\n1 2\n3\t4\n  5   6 \n\n7 7\n1 2\n")
    e = sorted(tuple(r) for r in graphs.read_edge_list(spark, path).collect())
    assert e == [(1, 2), (1, 2), (3, 4), (5, 6), (7, 7)]
    p = scratch_dir(spark, "pairs-test")
    files.write_pairs(pairs_df(spark, [(1, 2, "Y"), (3, 4, "N")]), p)
    back = sorted(tuple(r) for r in files.read_pairs(spark, p).collect())
    assert back == [(1, 2, "Y"), (3, 4, "N")]


def test_split_independent_of_sampling_hash(spark):
    """Pairs chosen by the train-seed hash (positives, smallest-hash caps) must
    still spread 60/20/20 over the split hash (an affine hash would put them
    all in one split)."""
    from edgewise.functions.hashing import SEED_TRAIN
    edges = spark.range(0, 40000).select((F.col("id") % 2000).alias("src"),
                                          ((F.col("id") * 7919 + 17) % 5000).alias("dst"))
    edges = graphs.simple_graph(edges)
    for chosen in (S.positive_pairs(edges, SEED_TRAIN, cap=None),
                   S.hard_negatives(edges, SEED_TRAIN, cap=3000)):
        n = chosen.count()
        c = {r.split: r["count"] / n for r in S.train_val_test_split(chosen).groupBy("split").count().collect()}
        assert abs(c.get(0, 0) - 0.6) < 0.05 and abs(c.get(2, 0) - 0.2) < 0.05, c


def test_baseline_sink_and_feature_names(spark):
    from edgewise.functions.features import names
    assert names([12, 11, 4]) == ["friends_measure", "total_out", "u_bi"]
    df = spark.createDataFrame([(1, 2, 3, 4, "Y")], "u bigint, v bigint, co_out bigint, co_in bigint, label string")
    p = scratch_dir(spark, "baseline-test")
    files.write_baseline(df, p)
    back = spark.read.csv(p, schema="u bigint, v bigint, co_out bigint, co_in bigint, label string").collect()
    assert [tuple(r) for r in back] == [(1, 2, 3, 4, "Y")]


def test_only_the_ranges_of_the_positions_asked_for_are_numbered(spark):
    import random

    from edgewise.functions.hashing import pair_hash
    from pyspark.sql import functions as F
    rng = random.Random(2)
    edges = spark.createDataFrame([(rng.randrange(90), rng.randrange(90)) for _ in range(700)], "src bigint, dst bigint").distinct()
    rows = edges.withColumn("h", pair_hash("src", "dst", 3)).persist()
    n = rows.count()
    whole = {r.idx: (r.src, r.dst) for r in S.dense_index(rows, ["src", "dst"]).collect()}
    asked = sorted(rng.sample(range(n), 25)) + [0, n - 1]
    positions = spark.createDataFrame([(i,) for i in [*asked, *asked[:5], n, n + 7]], "idx bigint")
    for bucket_rows, coarse in ((10_000, 4), (7, 4), (1, 3), (20, 1)):
        found = S.rows_at(rows, ["src", "dst"], positions, 40, bucket_rows, coarse)
        assert {r.idx: (r.src, r.dst) for r in found.collect()} == {i: whole[i] for i in asked}
    # the window sees the rows of few ranges only: a left semi join stands below it
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    assert plan.index("Window [row_number()") < plan.index("Join LeftSemi")
    assert rows.select(F.max("h")).first()[0] < 2 ** 31


def test_long_neighbour_lists_are_numbered_in_parts(spark):
    edges = spark.createDataFrame([(0, i) for i in range(1, 400)] + [(i, 0) for i in range(1, 400)] + [(5, 6)], "src bigint, dst bigint")
    whole = sorted(tuple(r) for r in S.neighbour_index(edges, 9).collect())
    assert sorted(tuple(r) for r in S.neighbour_index(edges, 9, chunk=30).collect()) == whole
    assert sorted(i for b, i, _ in whole if b == 0) == list(range(399))
    assert sorted(map(tuple, S.two_hop_pairs(edges, 9, chunk=30).collect())) == sorted(map(tuple, S.two_hop_pairs(edges, 9).collect()))
