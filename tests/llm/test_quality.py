import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from edgewise.llm import quality as Q

SCHEMA = "doc_id bigint, text string, lang string, n int"


def prose(rng, words=60):
    return " ".join("".join(rng.choice(["ba", "ne", "ri", "to", "shu"]) for _ in range(rng.randrange(1, 4))) for _ in range(words)) + "."


def brute_model(texts):
    """Interpolated modified Kneser-Ney probability of each four-gram's last character, by dictionaries."""
    pad = chr(0xFFFE) * 3
    counts = {4: Counter(s[i:i + 4] for t in texts for s in [pad + t] for i in range(len(t)))}
    for k in (3, 2, 1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    kinds = len(counts[1]) + 1
    d, total, left = {}, {}, {}
    for k, c in counts.items():
        n = Counter(c.values())
        if all(n[i] for i in (1, 2, 3, 4)):
            y = n[1] / (n[1] + 2 * n[2])
            d[k] = [max(.05, min(i - .05, i - (i + 1) * y * n[i + 1] / n[i])) for i in (1, 2, 3)]
        else:
            d[k] = [0.5, 1.0, 1.5]
        total[k], left[k] = Counter(), Counter()
        for g, v in c.items():
            total[k][g[:-1]] += v
            left[k][g[:-1]] += d[k][min(v, 3) - 1]

    def p(g):
        k = len(g)
        if not k:
            return 1 / kinds
        low, context = p(g[1:]), g[:-1]
        if not total[k][context]:
            return low
        v = counts[k][g]
        return ((v - d[k][min(v, 3) - 1] if v else 0) + left[k][context] * low) / total[k][context]

    return lambda t: -sum(math.log(p((pad + t)[i:i + 4])) for i in range(len(t))) / len(t)


@pytest.mark.parametrize("broadcast_grams", [Q.BROADCAST_GRAMS, 0])
def test_perplexity_equals_brute_force(spark, broadcast_grams):
    rng = random.Random(1)
    trusted = [(i, prose(rng), "en", 0) for i in range(15)]
    model = Q.train(spark.createDataFrame(trusted, SCHEMA))
    rows = [(100, prose(rng), "en", 0), (101, "%%% ###!! ÄÖ 日本 🙂", "en", 0), (102, "", "en", 0), (103, None, None, 0),
            (104, "a", "xx", 0), (105, prose(rng, 3000), "en", 0), (100, prose(rng), "en", 0)]
    want = brute_model([t for _, t, _, _ in trusted])
    got = Q.perplexities(spark.createDataFrame(rows, SCHEMA), model, broadcast_grams).collect()
    by_row = sorted((r.doc_id, r.n, r.log_ppl is None or round(r.log_ppl, 9)) for r in got)
    assert by_row == sorted((i, len(t or ""), not t or round(want(t.replace("🙂", chr(0xFFFF))), 9)) for i, t, _, _ in rows)


def test_probabilities_of_a_context_sum_to_one(spark):
    rng = random.Random(2)
    texts = [prose(rng) for _ in range(10)]
    model = Q.train(spark.createDataFrame([(i, t, "en", 0) for i, t in enumerate(texts)], SCHEMA))
    log_ppl = brute_model(texts)
    seen = sorted(set("".join(texts)))
    total = sum(math.exp(-(2 * log_ppl("b" + c) - log_ppl("b"))) for c in [*seen, ""])
    assert abs(total - 1) < 1e-9 and model.where("logp > 1e-9").count() == 0


def test_report_rejects_junk_and_keeps_clean(spark):
    rng = random.Random(3)
    rows = [(i, prose(rng), "en" if i % 2 else "fr", 0) for i in range(200)]
    junk = [(500 + i, " ".join("".join(rng.choice("%&*#XQZ!") for _ in range(6)) for _ in range(30)), "en", 0) for i in range(20)]
    odd = [(900, None, "en", 0), (901, "", None, 0), (None, prose(rng), "en", 0), (902, prose(rng), None, 0), (500, junk[0][1], "en", 0)]
    docs = spark.createDataFrame(rows + junk + odd, SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(150)] + [(3, 1, 0), (500, 0, 0), (None, 1, 0), (501, None, None)],
                                   "doc_id bigint, quality int, toxic int")
    kept = Q.without_rejected(docs, labels)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert not [i for i in ids if i is not None and 500 <= i < 600]
    assert {900, 901, 902, None} <= set(ids) and len([i for i in ids if i is not None and i < 200]) >= 196
    nothing = Q.quality_report(docs, labels.limit(0)).collect()
    assert len(nothing) == docs.count() and all(r.kept for r in nothing)
    assert Q.quality_report(docs.limit(0), labels).count() == 0


def test_documents_labelled_toxic_are_not_trusted(spark):
    rng = random.Random(8)
    clean = [(i, prose(rng), "en", 0) for i in range(120)]
    toxic = [(1000 + i, " ".join("".join(rng.choice("%&*#XQZ!") for _ in range(6)) for _ in range(30)), "en", 0) for i in range(60)]
    labels = [(i, 1, None if i % 2 else 0) for i in range(120)] + [(1000 + i, 1, 1) for i in range(60)] + [(1000, 1, 0)]
    report = Q.quality_report(spark.createDataFrame(clean + toxic, SCHEMA),
                              spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")).collect()
    assert not [r.doc_id for r in report if r.doc_id >= 1000 and r.kept]
    assert sum(r.kept for r in report if r.doc_id < 1000) >= 110


def test_threshold_is_the_held_out_quantile_and_rejects_repeated_words(spark):
    rng = random.Random(21)
    clean = [(i, prose(rng, 200), "en", 0) for i in range(400)]
    junk = [(1000 + i, " ".join(["".join(rng.choice(["ba", "ne", "ri", "to", "shu"]) for _ in range(3)) + rng.choice(["", "h"])] * 80), "en", 0)
            for i in range(60)]
    docs = spark.createDataFrame(clean + junk, SCHEMA)
    labels = spark.createDataFrame([(i, 1, 0) for i in range(400)], "doc_id bigint, quality int, toxic int")
    report = Q.quality_report(docs, labels)
    rows = report.withColumn("held", Q._held_out(F.col("doc_id")) & (F.col("doc_id") < 400)).collect()
    held = sorted(r.perplexity for r in rows if r.held)
    assert abs(rows[0].threshold - held[math.ceil(0.99 * len(held)) - 1]) < 1e-9
    old = rows[0].threshold * math.exp(0.15)
    gone = [r for r in rows if r.doc_id >= 1000 and not r.kept]
    assert len(gone) > sum(r.perplexity > old for r in gone)
