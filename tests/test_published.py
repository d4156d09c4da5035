"""Outputs handed over by manifest: half-written ones stay unseen, damaged ones are refused, re-runs write nothing."""

import os

import pytest
from edgewise.session import scratch_dir
from edgewise.sources import files, graphs, published


def _local(path):
    return path.removeprefix("file:")


def _edges(spark, rows):
    return spark.createDataFrame(rows, "src bigint, dst bigint")


def _publish(spark, out, run, rows):
    return published.publish(spark, out, run, lambda path: files.write_edges(_edges(spark, rows), path))


def _read(spark, out):
    return sorted(map(tuple, graphs.read_edge_list(spark, published.location(spark, out)).collect()))


def test_a_run_is_written_once_and_its_manifest_adds_up(spark):
    out = scratch_dir(spark, "published")
    with pytest.raises(published.NotPublished):
        published.location(spark, out)
    rows = [(i, i + 1) for i in range(50)]
    assert _publish(spark, out, "a", rows) and not _publish(spark, out, "a", [(9, 9)])
    assert _read(spark, out) == rows
    seen, parts = published.current(spark, out), published.manifest(spark, out).collect()
    assert seen["lines"] == 50 == sum(r.lines for r in parts) and seen["files"] == len(parts)
    assert seen["bytes"] == sum(os.path.getsize(os.path.join(_local(published.location(spark, out)), r.file)) for r in parts)
    assert _publish(spark, out, "b", [(7, 8)]) and _read(spark, out) == [(7, 8)]


def test_a_run_that_dies_leaves_what_was_published(spark):
    out = scratch_dir(spark, "published")
    _publish(spark, out, "a", [(1, 2)])

    def dies(path):
        files.write_edges(_edges(spark, [(3, 4)]), path)
        raise RuntimeError("lost")
    with pytest.raises(RuntimeError):
        published.publish(spark, out, "b", dies)
    assert _read(spark, out) == [(1, 2)] and published.current(spark, out)["run"] == "a"


@pytest.mark.parametrize("fault", ["gone", "extra", "length"])
def test_a_damaged_output_is_refused_and_written_again(spark, fault):
    out = scratch_dir(spark, "published")
    _publish(spark, out, "a", [(1, 2), (3, 4)])
    data = _local(published.location(spark, out))
    part = sorted(f for f in os.listdir(data) if f.startswith("part-") and os.path.getsize(os.path.join(data, f)))[0]
    if fault == "gone":
        os.remove(os.path.join(data, part))
    else:
        with open(os.path.join(data, "part-extra.csv" if fault == "extra" else part), "a") as f:
            f.write("5\t6\n")
    assert [r.fault for r in published.faults(spark, out).collect()] == [fault]
    with pytest.raises(published.NotPublished, match=fault):
        published.location(spark, out)
    assert _publish(spark, out, "a", [(1, 2), (3, 4)]) and _read(spark, out) == [(1, 2), (3, 4)]


def test_empty_outputs_and_parquet_ones(spark):
    out, pairs = scratch_dir(spark, "published"), scratch_dir(spark, "published")
    assert _publish(spark, out, "a", []) and _read(spark, out) == [] and published.current(spark, out)["lines"] == 0
    df = spark.createDataFrame([(i, i % 3, "N") for i in range(20)], "u bigint, v bigint, label string")
    published.publish(spark, pairs, "a", lambda path: files.write_ordered_pairs(df, path, files=3), fmt="parquet")
    assert published.current(spark, pairs)["lines"] == 20
    assert files.read_ordered_pairs(spark, published.location(spark, pairs)).count() == 20


def test_jobs_hand_over_whole_outputs_and_do_not_write_them_twice(spark):
    from edgewise.plans import jobs
    edges = spark.range(0, 4000).selectExpr("id % 400 AS src", "(id * 37 + id DIV 400) % 400 AS dst")
    out = scratch_dir(spark, "jobs")
    at = {name: os.path.join(out, name) for name in ("edges", "pairs", "features", "models", "scores")}

    def all_jobs():
        jobs.sample_job(spark, edges, out, seed=5, fraction=0.6, vertex_cap=200, run="r1")
        jobs.featurise_job(spark, at["edges"], at["pairs"], at["features"], run="r1")
        jobs.classify_job(spark, at["features"], at["models"], run="r1")
        jobs.score_job(spark, at["features"], os.path.join(at["models"], "nb-model"), at["scores"], run="r1")
        return {p: published.current(spark, p)["attempt"] for p in [*map(at.get, ("edges", "pairs", "features", "scores")),
                *[os.path.join(at["models"], k) for k in ("metrics", "svm-roc", "gbt-roc", "rf-model", "nb-model")]]}
    first = all_jobs()
    features = files.read_features(spark, published.location(spark, at["features"]))
    scores = files.read_scores(spark, published.location(spark, at["scores"]))
    assert scores.count() == features.count() > 0
    assert files.read_metrics(spark, published.location(spark, os.path.join(at["models"], "metrics"))).count() == 5
    assert all_jobs() == first
