"""End-to-end jobs through files, and the streaming featuriser."""

import os

from conftest import pairs_df
from edgewise.operators import features
from edgewise.operators.prepared import prepare_graph
from edgewise.plans import jobs
from edgewise.session import scratch_dir
from edgewise.sources import files
from edgewise.streaming import featurise_stream, pair_stream


def test_sample_then_featurise_jobs(spark):
    edges = spark.range(0, 4000).selectExpr("id % 400 AS src", "(id * 37 + id DIV 400) % 400 AS dst")
    out = scratch_dir(spark, "jobs")
    jobs.sample_job(spark, edges, out, seed=5, fraction=0.6, vertex_cap=200)
    pairs = files.read_pairs(spark, os.path.join(out, "pairs"))
    labels = {r.label for r in pairs.collect()}
    assert labels <= {"Y", "N"} and "N" in labels
    feats = os.path.join(out, "features")
    jobs.featurise_job(spark, os.path.join(out, "edges"), os.path.join(out, "pairs"), feats)
    back = files.read_features(spark, feats)
    sub = spark.read.csv(os.path.join(out, "edges"), sep="\t", schema="src bigint, dst bigint")
    direct = features.pair_features(pairs, prepare_graph(sub))
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, direct.collect()))


def test_streaming_featurise(spark, t1_edges):
    g = prepare_graph(t1_edges)
    src = scratch_dir(spark, "stream-in")
    files.write_pairs(pairs_df(spark, [(1, 2, "Y"), (1, 5, "N")]), os.path.join(src, "a"))
    files.write_pairs(pairs_df(spark, [(2, 4, "N"), (4, 1, "N")]), os.path.join(src, "b"))
    sink = scratch_dir(spark, "stream-out")
    stream = pair_stream(spark, os.path.join(src, "*"))
    q = featurise_stream(stream, g, sink)
    q.awaitTermination(120)
    got = {(r.u, r.v): r.friends_measure for r in spark.read.parquet(sink).collect()}
    assert got == {(1, 2): 4, (1, 5): 2, (2, 4): 0, (4, 1): 4}


def test_classify_and_select_jobs_write_their_outputs(spark):
    import random

    from edgewise.functions.features import FEATURE_COLUMNS
    from edgewise.operators.features import pair_features
    from edgewise.plans import jobs
    from edgewise.session import scratch_dir
    from edgewise.sources import files
    rng = random.Random(5)
    edges = [(a, b) for a in range(60) for b in rng.sample(range(60), 7) if a != b]
    e = spark.createDataFrame(edges, "src bigint, dst bigint").distinct()
    pairs = [(a, b, "Y") for a, b in edges[:200]] + [(rng.randrange(60), rng.randrange(60), "N") for _ in range(200)]
    feats, out = scratch_dir(spark, "job-features"), scratch_dir(spark, "job-out")
    features = pair_features(spark.createDataFrame(pairs, "u bigint, v bigint, label string"), e)
    files.write_features(features, feats)
    metrics = {r.model: r.value for r in jobs.classify_job(spark, feats, out).collect()}
    assert set(metrics) == {"svm", "logreg", "nb", "rf", "gbt"} and all(0 <= x <= 1 for x in metrics.values())
    n_test = files.read_features(spark, feats).count()
    for kind in metrics:
        scores = files.read_scores(spark, f"{out}/{kind}-roc").collect()
        assert 0 < len(scores) < n_test and {r.label for r in scores} <= {0.0, 1.0}
    log = jobs.select_job(spark, feats, out, kind="nb", iterations=None)
    assert log.where("split = 'test'").count() == 1 and spark.read.csv(f"{out}/selection-nb", header=True).count() == log.count()
    assert spark.read.csv(f"{out}/metrics", header=True).count() == 5
    edge_out, header_out = scratch_dir(spark, "job-edges"), scratch_dir(spark, "job-header")
    files.write_edges(e, edge_out)
    from edgewise.sources import graphs
    assert graphs.read_edge_list(spark, edge_out).exceptAll(e).count() == 0 and graphs.read_edge_list(spark, edge_out).count() == e.count()
    files.write_features(features, header_out, header=True)
    with_header = spark.read.csv(header_out, header=True)
    assert with_header.columns == list(FEATURE_COLUMNS) and with_header.count() == features.count()
