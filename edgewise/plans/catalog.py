"""Registered queries: each takes (spark, sf_dir) and returns a DataFrame.

Inputs are the driver's Parquet tables; the graphs are derived from them
(``sources.graphs``). The link-prediction dataflow is the original one:
sample a vertex set and its induced subgraph from the ``cp`` graph,
draw labelled pairs on it, featurise the pairs on that subgraph, then
split, score and evaluate. The single feature queries and the baseline
take those pairs as candidates on the whole ``cp`` graph; ``edge_features``
featurises every edge of the whole ``ev`` graph; ``two_hop_pairs``, degrees, reciprocity and the
other graph operators run on whole graphs.

Within one application, the prepared graphs and samples are written once and
shared by its queries; ``forget`` drops them (the bench does, for cold times).
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from edgewise.functions.features import SVM_LR_FEATURES, label_value
from edgewise.functions.hashing import SEED_SPLIT, SEED_TEST, SEED_TRAIN, pair_hash
from edgewise.operators import evaluate, features, graph as G, models, sampling, selection
from edgewise.operators.prepared import prepare_graph
from edgewise.session import cut_lineage, scratch_dir
from edgewise.sources import files, graphs, published, quarantine

_MEMO: dict = {}


def forget() -> None:
    """Drop the stored inputs: the next query builds its own."""
    _MEMO.clear()


def _memo(spark: SparkSession, sf: str, key: str, build):
    k = (spark.sparkContext.applicationId, sf, key)
    if k not in _MEMO:
        _MEMO[k] = build()
    return _MEMO[k]


# ---------------------------------------------------------------- inputs

def ev_raw(spark, sf):
    return graphs.events_edges_raw(spark, sf)


def ev(spark, sf):
    return graphs.events_graph(spark, sf)


def cp(spark, sf):
    """The cp graph, written once: the sample and the prepared graph both read it."""
    return _memo(spark, sf, "cp", lambda: cut_lineage(graphs.orders_graph(spark, sf)))


def cp_prepared(spark, sf):
    return _memo(spark, sf, "cp_prepared", lambda: prepare_graph(cp(spark, sf), simple=False, materialize="checkpoint"))


def ev_prepared(spark, sf):
    return _memo(spark, sf, "ev_prepared", lambda: prepare_graph(ev(spark, sf), materialize="checkpoint"))


def sampled(spark, sf, seed=SEED_TRAIN):
    """(vertex sample, subgraph) of the cp graph for a seed."""
    def build():
        e = cp(spark, sf)
        vs = cut_lineage(sampling.vertex_sample(e, seed))
        return vs, cut_lineage(G.induced_subgraph(e, vs))
    return _memo(spark, sf, f"sampled-{seed}", build)


def sample(spark, sf, seed=SEED_TRAIN):
    """(vertex sample, subgraph, labelled pairs) of the cp graph for a seed."""
    vs, sub = sampled(spark, sf, seed)
    return vs, sub, _memo(spark, sf, f"sample-{seed}", lambda: cut_lineage(sampling.labelled_pairs(vs, sub, seed)))


def sub_prepared(spark, sf, seed=SEED_TRAIN):
    return _memo(spark, sf, f"sub-{seed}",
                 lambda: prepare_graph(sampled(spark, sf, seed)[1], simple=False, materialize="checkpoint"))


def labelled_features(spark, sf, seed=SEED_TRAIN):
    def build():
        _, _, pairs = sample(spark, sf, seed)
        return cut_lineage(features.pair_features(pairs, sub_prepared(spark, sf, seed)))
    return _memo(spark, sf, f"features-{seed}", build)


def whole_features(spark, sf):
    """Features of the labelled pairs on the whole cp graph."""
    return _memo(spark, sf, "whole-features", lambda: cut_lineage(
        features.pair_features(sample(spark, sf)[2], cp_prepared(spark, sf))))


def split_features(spark, sf):
    return sampling.train_val_test_split(labelled_features(spark, sf), SEED_SPLIT)


def _scored(spark, sf):
    f = split_features(spark, sf).where(F.col("split") == 2)
    return f.select("u", "v", F.col("jaccard_out").alias("score"), label_value("label").alias("label"))


# ---------------------------------------------------------------- graph core

def q_graph_edges(spark, sf):
    return ev_raw(spark, sf)


def q_reverse_edges(spark, sf):
    return G.reverse_edges(ev(spark, sf))


def q_drop_self_loops(spark, sf):
    return G.drop_self_loops(ev_raw(spark, sf))


def q_induced_subgraph(spark, sf):
    return sampled(spark, sf)[1]


def q_vertex_degrees(spark, sf):
    return G.vertex_degrees(ev_raw(spark, sf))


def q_vertex_stats(spark, sf):
    return cp_prepared(spark, sf).counts.select("id", "degree", "in_degree", "out_degree", "bi")


def q_graph_summary(spark, sf):
    return G.graph_summary(cp(spark, sf), sample(spark, sf)[2])


def q_reciprocal_degree(spark, sf):
    return G.reciprocal_degree(cp(spark, sf))


def q_edge_endpoint_degrees(spark, sf):
    g = cp_prepared(spark, sf)
    return G.edge_endpoint_degrees(g.edges, g.counts)


def _property_graph(spark, sf):
    edges = graphs.orders_edges_raw(spark, sf, with_status=True)
    verts = G.property_graph_vertices(edges, graphs.customer_vertices(spark, sf))
    return verts, edges


def q_property_graph_vertices(spark, sf):
    return _property_graph(spark, sf)[0]


def q_vertex_predicate_count(spark, sf):
    return G.vertex_predicate_count(_property_graph(spark, sf)[0], "BUILDING")


def q_edge_predicate_count(spark, sf):
    return G.edge_predicate_count(_property_graph(spark, sf)[1], "F")


# ---------------------------------------------------------------- candidates

def q_vertex_sample(spark, sf):
    return sampled(spark, sf)[0].select("id")


def q_two_hop_pairs(spark, sf):
    return sampling.two_hop_pairs(cp(spark, sf), SEED_TRAIN)


def q_positive_pairs(spark, sf):
    return sampling.positive_pairs(sampled(spark, sf)[1], SEED_TRAIN)


def q_hard_negatives(spark, sf):
    return sampling.hard_negatives(sampled(spark, sf)[1], SEED_TRAIN)


def q_easy_negatives_weighted(spark, sf):
    return sampling.easy_negatives_weighted(sampled(spark, sf)[1], SEED_TRAIN)


def q_easy_negatives_uniform(spark, sf):
    return sampling.easy_negatives_uniform(sampled(spark, sf)[0], SEED_TRAIN)


def q_non_edge_guard(spark, sf):
    e = cp(spark, sf)
    return sampling.non_edge_guard(sampling.two_hop_pairs(e, SEED_TRAIN), e)


def q_sample_cap(spark, sf):
    e = cp(spark, sf).select("src", "dst", pair_hash("src", "dst", SEED_TRAIN).alias("h"))
    return sampling.cap_by_hash(e, "h", ["src", "dst"], 1000).select("src", "dst")


def q_labelled_pairs(spark, sf):
    return sample(spark, sf)[2]


def q_labelled_pairs_test(spark, sf):
    return sample(spark, sf, SEED_TEST)[2]


def q_dedup_pairs(spark, sf):
    return features.clean_pairs(sample(spark, sf)[2])


def q_pairs_anti_join(spark, sf):
    train = sample(spark, sf)[2]
    test = sample(spark, sf, SEED_TEST)[2].select("u", "v")
    return train.join(test, ["u", "v"], "left_anti")


def q_flatten_pairs(spark, sf):
    nested = sample(spark, sf)[2].select(F.struct("u", "v").alias("k"), "label")
    return nested.select("k.*", "label")


def q_train_val_test_split(spark, sf):
    return sampling.train_val_test_split(features.clean_pairs(sample(spark, sf)[2]))


# ---------------------------------------------------------------- features

def q_pair_degrees(spark, sf):
    return features.pair_degrees(sample(spark, sf)[2], cp_prepared(spark, sf))


def q_total_friends(spark, sf):
    return features.total_friends(sample(spark, sf)[2], cp_prepared(spark, sf))


def q_common_friends(spark, sf):
    return features.common_friends(sample(spark, sf)[2], cp_prepared(spark, sf))


def q_shared_neighbour_rows(spark, sf):
    return features.shared_neighbour_rows(sample(spark, sf)[2], cp_prepared(spark, sf))


def q_friends_measure(spark, sf):
    return features.friends_measure(sample(spark, sf)[2], cp_prepared(spark, sf))


def q_densities(spark, sf):
    return whole_features(spark, sf).select(
        "u", "v", "u_in_density", "u_out_density", "u_bi_density",
        "v_in_density", "v_out_density", "v_bi_density")


def q_pref_attachment(spark, sf):
    return whole_features(spark, sf).select("u", "v", "pref_attachment")


def q_jaccard(spark, sf):
    return whole_features(spark, sf).select("u", "v", "jaccard_in", "jaccard_out")


def q_pair_features(spark, sf):
    return labelled_features(spark, sf)


def q_pair_features_test(spark, sf):
    return labelled_features(spark, sf, SEED_TEST)


def q_edge_features(spark, sf):
    return features.edge_features(ev_prepared(spark, sf))


def q_edge_features_multi(spark, sf):
    """Features of every edge of the raw event graph, repeated edges and self-loops kept."""
    g = _memo(spark, sf, "ev_multi", lambda: prepare_graph(ev_raw(spark, sf), multi=True, materialize="checkpoint"))
    return features.edge_features(g)


def q_pair_features_excluded(spark, sf):
    """Features of the labelled pairs, each pair's own edge left out of the graph."""
    return features.pair_features(sample(spark, sf)[2], sub_prepared(spark, sf), isolated="zero", exclude_target=True)


def q_edge_features_excluded(spark, sf):
    """Features of every edge of the event graph as if it were not there."""
    return features.edge_features(ev_prepared(spark, sf), isolated="zero", exclude_target=True)


def q_label_encode(spark, sf):
    return features.label_encode(sample(spark, sf)[2])


def q_feature_subset(spark, sf):
    return features.feature_subset(whole_features(spark, sf), SVM_LR_FEATURES)


def q_feature_vectors(spark, sf):
    return features.feature_vectors(whole_features(spark, sf), as_array=True)


def q_features_roundtrip(spark, sf):
    path = scratch_dir(spark, "features")
    files.write_features(whole_features(spark, sf), path)
    return files.read_features(spark, path)


def q_edge_list_scan(spark, sf):
    path = scratch_dir(spark, "edgelist")
    e = ev_raw(spark, sf)
    lines = e.select(F.concat_ws("\t", "src", "dst").alias("value"))
    header = spark.createDataFrame([("# directed edge list: src dst",)], "value string")
    header.unionByName(lines).write.text(path)
    return graphs.read_edge_list(spark, path)


def _edge_lines(spark, sf):
    """An edge file of the events with comments, blank lines and lines that are no edge."""
    def build():
        e, k = graphs.table(spark, sf, "events"), F.get_json_object("props", "$.k")
        n = F.col("event_id")
        line = F.when(n % 7 == 0, F.col("user_id").cast("string")).when(n % 11 == 0, F.concat_ws("\t", "user_id", F.concat(F.lit("x"), k))) \
            .when(n % 13 == 0, F.concat_ws(" ", F.lit("#"), "user_id", k)).when(n % 17 == 0, F.concat_ws(" ", "user_id", F.lit("99999999999999999999"))) \
            .when(n % 19 == 0, F.lit("  ")).when(n % 23 == 0, F.concat_ws(" \t ", "user_id", k, F.lit("1.5"))).otherwise(F.concat_ws("\t", "user_id", k))
        path = scratch_dir(spark, "edge-lines")
        e.select(line.alias("value")).write.text(path)
        return path
    return _memo(spark, sf, "edge-lines", build)


def q_edge_rows_good(spark, sf):
    return quarantine.good(quarantine.edge_rows(spark, _edge_lines(spark, sf)))


def q_edge_rows_bad(spark, sf):
    return quarantine.bad(quarantine.edge_rows(spark, _edge_lines(spark, sf)))


def q_pair_rows_bad(spark, sf):
    """Lines of a pair file of the labelled pairs, some spoilt, that are no pair."""
    u, v, label = F.col("u").cast("string"), F.col("v").cast("string"), F.col("label")
    line = F.when(F.col("u") % 5 == 0, F.concat_ws(",", u, v)).when(F.col("u") % 5 == 1, F.concat_ws(",", u, F.concat(F.lit("v"), v), label)) \
        .when(F.col("u") % 5 == 2, F.concat_ws(",", u, v, F.lit("?"))).when(F.col("v") % 3 == 0, F.concat_ws(",", u, v, label, F.lit(""))) \
        .otherwise(F.concat_ws(",", u, v, label))
    path = scratch_dir(spark, "pair-lines")
    sample(spark, sf)[2].select(line.alias("value")).write.text(path)
    return quarantine.bad(quarantine.pair_rows(spark, path))


def q_ordered_pairs(spark, sf):
    """The pairs in the order of (v, u), each with its place, read back from range-ordered files."""
    path = scratch_dir(spark, "ordered-pairs")
    files.write_ordered_pairs(features.clean_pairs(sample(spark, sf)[2]), path, files=6)
    return files.read_ordered_pairs(spark, path)


def q_pairs_scan(spark, sf):
    path = scratch_dir(spark, "pairs")
    files.write_pairs(sample(spark, sf)[2], path)
    return files.read_pairs(spark, path)


# ---------------------------------------------------------------- hand-over by manifest

def _published(spark, sf, name, write):
    """The folder of an output of this application: written once, published, checked at every read."""
    out = _memo(spark, sf, f"published-{name}", lambda: scratch_dir(spark, f"published-{name}"))
    published.publish(spark, out, f"{name} of {sf}", write)
    return out


def _published_edges(spark, sf):
    return _published(spark, sf, "edges", lambda path: files.write_edges(sampled(spark, sf)[1], path))


def _published_pairs(spark, sf):
    return _published(spark, sf, "pairs", lambda path: files.write_pairs(sample(spark, sf)[2], path))


def _published_features(spark, sf):
    return _published(spark, sf, "features", lambda path: files.write_features(labelled_features(spark, sf), path))


def _published_baseline(spark, sf):
    return _published(spark, sf, "baseline", lambda path: files.write_baseline(q_baseline_features(spark, sf), path))


def q_published_edges(spark, sf):
    """The sampled subgraph's edges, handed over as a tab-separated file."""
    return graphs.read_edge_list(spark, published.location(spark, _published_edges(spark, sf)))


def q_published_pairs(spark, sf):
    return files.read_pairs(spark, published.location(spark, _published_pairs(spark, sf)))


def q_published_features(spark, sf):
    return files.read_features(spark, published.location(spark, _published_features(spark, sf)))


def q_published_scores(spark, sf):
    """Scores and labels of the test split, handed over as a score file."""
    out = _published(spark, sf, "scores", lambda path: files.write_scores(_scored(spark, sf), path))
    return files.read_scores(spark, published.location(spark, out))


def q_published_metrics(spark, sf):
    """The AUC of those scores with its class sizes, handed over as a metric log."""
    def write(path):
        a = evaluate.auc(_scored(spark, sf)).select(F.lit("jaccard_out").alias("model"), *[F.col(c).cast("double") for c in ("auc", "positives", "negatives")])
        files.write_metrics(a.unpivot("model", ["auc", "positives", "negatives"], "metric", "value"), path)
    return files.read_metrics(spark, published.location(spark, _published(spark, sf, "metrics", write)))


def q_published_baseline(spark, sf):
    return files.read_baseline(spark, published.location(spark, _published_baseline(spark, sf)))


def q_published_lines(spark, sf):
    """Lines of the four outputs without a header, as their manifests add up."""
    parts = {"edges": _published_edges, "pairs": _published_pairs, "features": _published_features, "baseline": _published_baseline}
    out = None
    for name, of in parts.items():
        m = published.manifest(spark, of(spark, sf)).agg(F.coalesce(F.sum("lines"), F.lit(0)).alias("lines")) \
            .select(F.lit(name).alias("output"), "lines")
        out = m if out is None else out.unionByName(m)
    return out


# ---------------------------------------------------------------- baseline

def q_co_out_counts(spark, sf):
    c = features.common_friends(sample(spark, sf)[2], cp_prepared(spark, sf), ("out",))
    return c.where(F.col("common_out") > 0).select("u", "v", F.col("common_out").alias("co_out"))


def q_co_in_counts(spark, sf):
    c = features.common_friends(sample(spark, sf)[2], cp_prepared(spark, sf), ("in",))
    return c.where(F.col("common_in") > 0).select("u", "v", F.col("common_in").alias("co_in"))


def q_baseline_features(spark, sf):
    """co-out and co-in counts joined with the labelled pairs (inner joins,
    label multiplicity kept)."""
    pairs = sample(spark, sf)[2]
    c = features.common_friends(pairs, cp_prepared(spark, sf))
    both = c.where((F.col("common_out") > 0) & (F.col("common_in") > 0))
    return both.join(pairs, ["u", "v"]).select("u", "v", F.col("common_out").alias("co_out"),
                                               F.col("common_in").alias("co_in"), "label")


# ---------------------------------------------------------------- evaluation

def q_confusion_counts(spark, sf):
    f = split_features(spark, sf).where(F.col("split") == 2)
    scored = f.select(F.when(F.col("common_out") > 0, 1.0).otherwise(0.0).alias("score"),
                      label_value("label").alias("label"))
    return evaluate.confusion_counts(scored)


def q_roc_curve(spark, sf):
    return evaluate.roc_curve(_scored(spark, sf))


def q_auc_of_scores(spark, sf):
    return evaluate.auc(_scored(spark, sf))


def q_forward_selection_heuristic(spark, sf):
    val = split_features(spark, sf).where(F.col("split") == 1)
    return selection.forward_selection_heuristic(val)


# ---------------------------------------------------------------- ML (rows-only checks)

def _train_test(spark, sf):
    f = split_features(spark, sf)
    return f.where(F.col("split") == 0), f.where(F.col("split") == 2)


def q_svm_scores(spark, sf):
    return models.svm_scores(*_train_test(spark, sf), score_mode="label")


def q_logreg_scores(spark, sf):
    return models.logreg_scores(*_train_test(spark, sf), score_mode="label")


def q_nb_scores(spark, sf):
    return models.nb_scores(*_train_test(spark, sf), score_mode="label")


def q_rf_scores(spark, sf):
    return models.rf_scores(*_train_test(spark, sf), score_mode="label")


def q_gbt_scores(spark, sf):
    return models.gbt_scores(*_train_test(spark, sf), score_mode="label")


MODELS = ("svm", "logreg", "nb", "rf", "gbt")


def _all_scores(spark, sf):
    """(model, u, v, score, label) of all five models on the test split, in 0/1 predictions."""
    def build():
        out = None
        for kind in MODELS:
            s = models.model_scores(*_train_test(spark, sf), kind, score_mode="label").withColumn("model", F.lit(kind))
            out = s if out is None else out.unionByName(s)
        return cut_lineage(out)
    return _memo(spark, sf, "all-scores", build)


def q_model_score_rows(spark, sf):
    """Every scored row of every model, and whether its score is a 0/1 prediction."""
    return _all_scores(spark, sf).select("model", "u", "v", "label", F.col("score").isin(0.0, 1.0).alias("valid"))


def q_model_confusion(spark, sf):
    """Per model: counts that add up to the split; the hard AUC is chance or better.

    Small samples have few positives, where 0/1 predictions may all be 0: chance.
    """
    s = _all_scores(spark, sf)
    hit, yes = F.col("score") == 1.0, F.col("label") == 1.0
    c = s.groupBy("model").agg(
        F.count_if(yes).alias("positives"), F.count_if(~yes).alias("negatives"),
        F.count_if(hit & yes).alias("tp"), F.count_if(hit & ~yes).alias("fp"),
        F.count_if(~hit & yes).alias("fn"), F.count_if(~hit & ~yes).alias("tn"))
    hard = (F.col("tp") / F.col("positives") + F.col("tn") / F.col("negatives")) / 2
    return c.select("model", "positives", "negatives",
                    (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")).alias("n_rows"),
                    (hard >= 0.5).alias("chance_or_better"))


def q_holdout_eval(spark, sf):
    """Train on the train-seed sample, evaluate on the test-seed sample."""
    train = labelled_features(spark, sf)
    test = labelled_features(spark, sf, SEED_TEST)
    rows = []
    for kind in MODELS:
        s = models.model_scores(train, test, kind, score_mode="label")
        c = evaluate.confusion_counts(s).first()
        rows.append((kind, float(c["hard_auc"]) if c["hard_auc"] is not None else None))
    return spark.createDataFrame(rows, "model string, auc double")


def q_forward_selection(spark, sf):
    f = split_features(spark, sf)
    return selection.forward_selection(f.where(F.col("split") == 0), f.where(F.col("split") == 1),
                                       kind="nb", test=f.where(F.col("split") == 2))


QUERIES = {name[2:]: fn for name, fn in dict(globals()).items()
           if name.startswith("q_") and callable(fn)}
