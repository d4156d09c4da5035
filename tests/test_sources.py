"""Malformed rows kept apart, and pair files in the order of (v, u)."""

import os

from edgewise.functions.features import FEATURE_COLUMNS
from edgewise.operators import features
from edgewise.session import scratch_dir
from edgewise.sources import files, quarantine


def _file(spark, lines):
    path = os.path.join(scratch_dir(spark, "lines"), "part.txt")
    os.makedirs(os.path.dirname(path.removeprefix("file:")), exist_ok=True)
    with open(path.removeprefix("file:"), "w", encoding="utf-8") as f:
        f.write("\n".join(lines) + "\n")
    return path


def test_edge_lines_are_good_or_bad_and_never_both(spark):
    lines = ["# comment", "", "1 2", " 3\t4 5 x", "+6 -7", "8", "a 9", "10 1.5", "9223372036854775807 1", "9223372036854775808 1", "1 2", "1,2"]
    rows = quarantine.edge_rows(spark, _file(spark, lines))
    assert sorted(map(tuple, quarantine.good(rows).collect())) == sorted([(1, 2), (3, 4), (6, -7), (9223372036854775807, 1), (1, 2)])
    assert sorted(map(tuple, quarantine.bad(rows).collect())) == sorted([
        ("8", "fields"), ("a 9", "id"), ("10 1.5", "id"), ("9223372036854775808 1", "id"), ("1,2", "fields")])


def test_pair_and_feature_lines(spark, t1_edges):
    rows = quarantine.pair_rows(spark, _file(spark, ["1,2,Y", "1,2", "1,2,Y,", "x,2,N", "1,2,y", " 3 , 4 , N ", "1,,N"]))
    assert sorted(map(tuple, quarantine.good(rows).collect())) == [(1, 2, "Y"), (3, 4, "N")]
    assert {r.line: r.reason for r in quarantine.bad(rows).collect()} == {
        "1,2": "fields", "1,2,Y,": "fields", "x,2,N": "id", "1,2,y": "label", "1,,N": "id"}
    pairs = spark.createDataFrame([(1, 2, "Y"), (1, 5, "N")], "u bigint, v bigint, label string")
    f = features.pair_features(pairs, t1_edges)
    path = scratch_dir(spark, "features")
    files.write_features(f, path)
    lines = [r.value for r in spark.read.text(path).collect()]
    broken = [lines[0].replace(",", ",NaN,", 1), lines[0] + ",1", lines[0].rsplit(",", 1)[0] + ",?", "1,2" + ",x" + lines[1].split(",", 3)[2][:0] + "," + lines[1].split(",", 3)[3]]
    rows = quarantine.feature_rows(spark, _file(spark, lines + broken))
    kept = quarantine.good(rows)
    assert kept.columns == FEATURE_COLUMNS
    assert sorted(map(tuple, kept.collect())) == sorted(map(tuple, f.collect()))
    assert sorted(r.reason for r in quarantine.bad(rows).collect()) == ["fields", "fields", "label", "number"]


def test_ordered_files_follow_each_other_and_prune(spark):
    import random
    rng = random.Random(1)
    pairs = list({(rng.randrange(300), rng.randrange(50)) for _ in range(3000)})
    df = spark.createDataFrame([(u, v, "N") for u, v in pairs], "u bigint, v bigint, label string")
    path = scratch_dir(spark, "ordered")
    files.write_ordered_pairs(df, path, files=5)
    bounds = sorted(files.pair_file_bounds(spark, path).collect(), key=lambda r: r.before)
    assert len(bounds) == 5 and sum(r.n for r in bounds) == len(pairs)
    assert all((a.most.v, a.most.u) < (b.least.v, b.least.u) and a.before + a.n == b.before for a, b in zip(bounds, bounds[1:]))
    got = sorted(map(tuple, files.read_ordered_pairs(spark, path).collect()))
    assert [(u, v) for _, u, v, _ in got] == sorted(pairs, key=lambda p: (p[1], p[0])) and [r[0] for r in got] == list(range(len(pairs)))
    some = spark.read.parquet(path).where("v = 7")
    assert "PushedFilters: [IsNotNull(v), EqualTo(v,7)]" in some._jdf.queryExecution().executedPlan().toString()
    assert some.selectExpr("_metadata.file_name AS f").distinct().count() <= 2
