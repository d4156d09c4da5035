"""The five batch jobs of the link-prediction workflow, end to end.

Each job reads its inputs, builds one Spark plan and writes its output
with a distributed writer; they hand over through files like the
original jobs did (edges + pairs -> features -> scores/metrics).

    sample_job(spark, edges, out_dir, seed)        -> out_dir/{edges,pairs}
    featurise_job(spark, edges_path, pairs_path, out)
    classify_job(spark, features_path, out_dir)    -> model tables, scores per model + metrics
    select_job(spark, features_path, out_dir, kind)
    score_job(spark, features_path, model_path, out) -> scores by a stored model table

With ``run`` (a name of the inputs and parameters) outputs are published by manifest: a job that dies
leaves nothing that readers see, a part of it that is published whole is not written again. A job
opens published inputs only if they are whole; plain folders are read as they are.
"""

from __future__ import annotations

import os
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from edgewise.functions.hashing import SEED_SPLIT, SEED_TEST
from edgewise.operators import evaluate, models, sampling, selection
from edgewise.operators.features import pair_features
from edgewise.operators.model_tables import TABLE_SCHEMA, model_table, score_with_table
from edgewise.operators.prepared import prepare_graph
from edgewise.session import cut_lineage
from edgewise.sources import files, graphs, published


def _put(spark: SparkSession, path: str, run: str | None, write: Callable[[str], None], fmt: str = "text") -> None:
    if run is None:
        write(path)
    else:
        published.publish(spark, path, run, write, fmt)


def _get(spark: SparkSession, path: str) -> str:
    return path if published.current(spark, path) is None else published.location(spark, path)


def sample_job(spark: SparkSession, edges: DataFrame, out_dir: str, seed: int = SEED_TEST,
               fraction: float = sampling.VERTEX_FRACTION, vertex_cap: int | None = None, run: str | None = None) -> None:
    """Vertex sample -> induced subgraph (written) -> labelled pairs (written)."""
    simple = graphs.simple_graph(edges)
    vs, sub = sampling.sampled_subgraph(simple, seed, fraction, vertex_cap)
    vs, sub = cut_lineage(vs), cut_lineage(sub)
    _put(spark, os.path.join(out_dir, "edges"), run, lambda path: files.write_edges(sub, path))
    _put(spark, os.path.join(out_dir, "pairs"), run, lambda path: files.write_pairs(sampling.labelled_pairs(vs, sub, seed), path))


def featurise_job(spark: SparkSession, edges_path: str, pairs_path: str, out: str,
                  header: bool = False, run: str | None = None) -> None:
    if run is not None and published.is_current(spark, out, run):
        return
    g = prepare_graph(graphs.read_edge_list(spark, _get(spark, edges_path)), materialize="checkpoint")
    found = pair_features(files.read_pairs(spark, _get(spark, pairs_path)), g)
    _put(spark, out, run, lambda path: files.write_features(found, path, header=header))


def classify_job(spark: SparkSession, features_path: str, out_dir: str,
                 score_mode: str = "label", run: str | None = None) -> DataFrame:
    """Five models on the 60/20/20 hash split; model tables, scores and (model, auc) written."""
    f = cut_lineage(sampling.train_val_test_split(files.read_features(spark, _get(spark, features_path)), SEED_SPLIT))
    train, test = f.where(F.col("split") == 0), f.where(F.col("split") == 2)
    rows = []
    for kind in ("svm", "logreg", "nb", "rf", "gbt"):
        model, indexes = models.fit(train, kind)
        s = cut_lineage(models.score(model, test, kind, indexes, score_mode))
        _put(spark, os.path.join(out_dir, f"{kind}-model"), run,
             lambda path, m=model, k=kind, i=indexes: model_table(m, k, i).write.mode("overwrite").parquet(path), "parquet")
        _put(spark, os.path.join(out_dir, f"{kind}-roc"), run, lambda path, s=s: files.write_scores(s, path))
        a = evaluate.auc(s).first()["auc"]
        rows.append((kind, "auc", float(a) if a is not None else None))
    metrics = spark.createDataFrame(rows, "model string, metric string, value double")
    _put(spark, os.path.join(out_dir, "metrics"), run, lambda path: files.write_metrics(metrics, path))
    return metrics


def score_job(spark: SparkSession, features_path: str, model_path: str, out: str, score_mode: str = "label",
              run: str | None = None) -> None:
    """Scores of a feature file by a stored model table: no model is fitted or loaded."""
    table = spark.read.schema(TABLE_SCHEMA).parquet(_get(spark, model_path))
    rows = files.read_features(spark, _get(spark, features_path))
    _put(spark, out, run, lambda path: files.write_scores(score_with_table(table, rows, score_mode), path))


def select_job(spark: SparkSession, features_path: str, out_dir: str, kind: str = "svm",
               iterations: int | None = 20, run: str | None = None) -> DataFrame:
    f = cut_lineage(sampling.train_val_test_split(files.read_features(spark, _get(spark, features_path)), SEED_SPLIT))
    log = selection.forward_selection(f.where(F.col("split") == 0), f.where(F.col("split") == 1),
                                      kind=kind, iterations=iterations, test=f.where(F.col("split") == 2))
    _put(spark, os.path.join(out_dir, f"selection-{kind}"), run, lambda path: files.write_metrics(log, path))
    return log


__all__ = ["sample_job", "featurise_job", "classify_job", "score_job", "select_job"]
