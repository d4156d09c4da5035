"""Model tables score like the models, in Spark and in DuckDB from the written table."""


import random

import duckdb
import pytest
from edgewise.functions.features import FEATURE_COLUMNS, FEATURE_NAMES, names
from edgewise.operators import models
from edgewise.operators.model_tables import MAX_ROWS, model_table, score_with_table
from edgewise.session import scratch_dir


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(11)
    out = []
    for i in range(400):
        yes = rng.random() < 0.4
        x = [float(rng.randrange(9) + (4 if yes and j % 3 == 0 else 0)) for j in range(len(FEATURE_NAMES))]
        out.append((i // 2, i % 7, *x, "Y" if yes else "N"))
    out += out[:20]                                    # repeated rows stay
    schema = ", ".join(f"{c} {'bigint' if c in 'uv' else 'string' if c == 'label' else 'double'}" for c in FEATURE_COLUMNS)
    return spark.createDataFrame(out, schema).cache()


DUCK_LINEAR = """SELECT r.n, (SELECT weight FROM t WHERE feature IS NULL) + sum(t.weight * r.value) AS margin
                 FROM r JOIN t ON t.feature = r.feature GROUP BY r.n"""
DUCK_BAYES = """SELECT r.n, (SELECT value_yes - value_no FROM t WHERE feature IS NULL) + sum((t.value_yes - t.value_no) * r.value) AS margin
                FROM r JOIN t ON t.feature = r.feature GROUP BY r.n"""
DUCK_TREES = """WITH outside AS (SELECT DISTINCT r.n, t.part FROM r JOIN t ON t.feature = r.feature WHERE NOT (r.value > t.low AND r.value <= t.high)),
                leaf AS (SELECT i.n, h.* FROM (SELECT DISTINCT n FROM r) i, (SELECT * FROM t WHERE feature IS NULL) h
                         WHERE NOT EXISTS (SELECT 1 FROM outside o WHERE o.n = i.n AND o.part = h.part))
                SELECT n, count(*) AS leaves, sum(value_yes) / count(*) AS share, sum(weight * value_yes) AS margin FROM leaf GROUP BY n"""


@pytest.mark.parametrize("kind", ["svm", "logreg", "nb", "rf", "gbt"])
def test_tables_score_like_the_models(spark, rows, kind):
    model, idx = models.fit(rows, kind)
    table = model_table(model, kind, idx)
    for mode in ("probability", "label"):
        said = models.score(model, rows, kind, idx, mode).collect()
        got = score_with_table(table, rows, mode)
        assert got.columns == ["u", "v", "score", "label"]
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Join" not in plan and "Python" not in plan and "Exchange" not in plan
        got = got.collect()
        assert len(got) == len(said) == 420
        assert all(a.u == b.u and a.v == b.v and a.label == b.label and abs(a.score - b.score) < 1e-9 for a, b in zip(said, got))
    path = scratch_dir(spark, "model-table")
    table.write.parquet(path)
    con = duckdb.connect()
    con.execute(f"CREATE TABLE t AS SELECT * FROM '{path.removeprefix('file:')}/*.parquet'")
    said = [r.score for r in models.score(model, rows, kind, idx).collect()]
    long = [(n, f, float(r[f])) for n, r in enumerate(rows.collect()) for f in names(idx)]
    con.execute("CREATE TABLE r (n BIGINT, feature VARCHAR, value DOUBLE)")
    import pandas as pd
    values = pd.DataFrame(long, columns=["n", "feature", "value"])
    con.register("values_", values)
    con.execute("INSERT INTO r SELECT * FROM values_")
    if kind in ("rf", "gbt"):
        found = con.execute(DUCK_TREES).fetchall()
        assert {x[1] for x in found} == {len(model.treeWeights)}          # one leaf a tree, none twice
        score = {n: share if kind == "rf" else 1 / (1 + 2.718281828459045 ** (-2 * margin)) for n, _, share, margin in found}
    else:
        margins = dict(con.execute(DUCK_BAYES if kind == "nb" else DUCK_LINEAR).fetchall())
        score = margins if kind == "svm" else {n: 1 / (1 + 2.718281828459045 ** -m) for n, m in margins.items()}
    assert len(score) == len(said) and all(abs(score[n] - x) < 1e-9 for n, x in enumerate(said))


def test_a_tree_without_a_split_and_a_table_that_is_none(spark, rows):
    same = rows.selectExpr(*[c if c in ("u", "v", "label") else f"1.0D AS {c}" for c in FEATURE_COLUMNS])
    for kind in ("rf", "gbt"):
        model, idx = models.fit(same, kind)
        table = model_table(model, kind, idx)
        assert table.where("feature IS NOT NULL").count() == 0
        said = models.score(model, same, kind, idx).first().score
        assert all(abs(r.score - said) < 1e-9 for r in score_with_table(table, same).collect())
    with pytest.raises(ValueError, match=str(MAX_ROWS)):
        score_with_table(table.where("false"), same)
