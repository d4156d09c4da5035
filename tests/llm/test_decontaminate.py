import hashlib
import re

import pytest

from edgewise.llm import decontaminate as D

DOCS = "doc_id bigint, text string, w string, h bigint"
ITEMS = "item_id bigint, text string"


def words(text):
    return re.findall("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))


def brute(docs, items, n=13):
    grams = {}
    for i, t in items:
        w = words(t)
        for s in range(len(w) - min(n, len(w)) + 1 if w else 0):
            grams.setdefault(tuple(w[s:s + min(n, len(w))]), set()).add(str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for k in {len(g) for g in grams}:
            for s in range(len(w) - k + 1):
                if (g := tuple(w[s:s + k])) in grams:
                    hit.update(range(s, s + k))
                    found |= grams[g]
        digest = hashlib.sha256(",".join(sorted(found)).encode()).hexdigest()
        out.append((i, len(w), len(hit), len(found), digest, bool(hit) and 20 * len(hit) >= len(w)))
    return sorted(out, key=str)


PASSAGE = "One two THREE four five six seven eight nine ten eleven twelve thirteen fourteen"
CASES = [
    (1, "x " + PASSAGE + " y z"), (2, PASSAGE.lower().replace(" ", " -- ")), (3, None), (4, ""), (5, "..."),
    (6, " ".join(PASSAGE.split()[:12])), (7, "été short one, SHORT ONE!"), (8, (PASSAGE + " ") * 3 + "a b " * 3000),
    (9, "a b " * 9 + PASSAGE), (9, "a b " * 9 + PASSAGE), (10, "Été Short one"), (None, PASSAGE),
]
BENCH = [(100, PASSAGE), (20, PASSAGE + " fifteen"), (3, "short one"), (4, None), (5, "!!"), (100, PASSAGE)]


@pytest.mark.parametrize("broadcast_windows", [1_000_000, 0])
def test_report_equals_brute_force(spark, broadcast_windows):
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in CASES], DOCS)
    bench = spark.createDataFrame(BENCH, ITEMS)
    got = D.contamination_report(docs, bench, broadcast_windows=broadcast_windows).collect()
    assert sorted([tuple(r) for r in got], key=str) == brute(CASES, BENCH)


def test_filter_keeps_columns_and_clean_rows(spark):
    docs = spark.createDataFrame([(i, t, "w", 1) for i, t in CASES], DOCS)
    kept = D.without_contaminated(docs, spark.createDataFrame(BENCH, ITEMS))
    assert kept.columns == docs.columns
    bad = {r[0] for r in brute(CASES, BENCH) if r[5]}
    assert sorted([str(r.doc_id) for r in kept.collect()]) == sorted(str(i) for i, _ in CASES if i not in bad)


def test_empty_tables(spark):
    docs, none = spark.createDataFrame([(1, "a b", "w", 1)], DOCS), spark.createDataFrame([], ITEMS)
    assert [tuple(r)[:4] for r in D.contamination_report(docs, none).collect()] == [(1, 2, 0, 0)]
    assert D.contamination_report(docs.limit(0), spark.createDataFrame(BENCH, ITEMS)).count() == 0
    assert D.without_contaminated(docs, none).count() == 1


def test_hit_words_are_cut(spark):
    docs = spark.createDataFrame([(1, "Ax, " + PASSAGE + " Zz."), (2, "clean"), (3, None)], "doc_id bigint, text string")
    got = {r.doc_id: r.text for r in D.without_hit_words(docs, spark.createDataFrame(BENCH, ITEMS)).collect()}
    assert re.sub(" +", " ", got[1]) == "Ax, Zz." and got[2] == "clean" and got[3] is None
