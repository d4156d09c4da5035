import random
import re
from collections import defaultdict

import pytest
import xxhash

from edgewise.llm import simhash as S


def brute_fingerprint(text):
    w = re.findall("[^\x20\x09-\x0D]+", (text or "").translate({c: c + 32 for c in range(65, 91)}))
    grams = [" ".join(w[i:i + 3]) for i in range(max(1, len(w) - 2))] if w else []
    h = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


TEXTS = [None, "", " \t\n", "one", "One", "one two", "one two three", "one two three four", "a b c\x0bd", "x " * 5000]


def test_fingerprints(spark):
    docs = spark.createDataFrame(list(enumerate(TEXTS)), "doc_id bigint, text string")
    got = {r.doc_id: r.fp % (1 << 64) for r in S.fingerprints(docs).collect()}
    assert got == {i: brute_fingerprint(t) for i, t in enumerate(TEXTS)}


def components(points):
    parent = {p: p for p in points}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(points):
        for b in points[:i]:
            if bin((a ^ b) % (1 << 64)).count("1") <= 2:
                parent[max(find(a), find(b))] = min(find(a), find(b))
    groups = defaultdict(set)
    for p in points:
        groups[find(p)].add(p)
    return {frozenset(g) for g in groups.values() if len(g) > 1}


@pytest.mark.parametrize("cell_pairs", [32, 1, 4])
def test_links_give_the_components_of_bit_distance_two(spark, cell_pairs):
    rng = random.Random(7)
    points = set()
    for _ in range(12):
        p = rng.getrandbits(64)
        for _ in range(rng.randrange(1, 12)):
            points.add(p - (1 << 64) if p >> 63 else p)
            for b in rng.sample(range(64), rng.choice([1, 2, 2, 3, 4])):
                p ^= 1 << b
    points = sorted(points)
    links = S.fingerprint_links(spark.createDataFrame([(p,) for p in points], "fp bigint"), cell_pairs)
    groups = defaultdict(set)
    for r in S.connected_components(links).collect():
        groups[r.component].add(r.node)
    assert {frozenset(g) for g in groups.values()} == components(points)
    assert all(min(g) == c for c, g in groups.items())


def test_report_and_dedup(spark):
    rows = [(5, "same text here"), (3, "Same TEXT here"), (9, None), (8, ""), (7, "other words entirely different"),
            (None, "same text here"), (3, "Same TEXT here")]
    docs = spark.createDataFrame([(i, t, 0) for i, t in rows], "doc_id bigint, text string, fp int")
    got = sorted([(r.doc_id, r.component_id) for r in S.near_duplicates(docs).collect()], key=str)
    assert got == sorted([(5, 3), (3, 3), (3, 3), (9, 8), (8, 8), (7, 7), (None, 3)], key=str)
    kept = S.without_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted([str(r.doc_id) for r in kept.collect()]) == ["3", "7", "8", "None"]
    assert S.near_duplicates(docs.limit(0)).count() == 0


def test_components_of_a_long_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(1000, 1000 + i) for i in range(1, 60)] + [(7, 7), (5, None)]
    got = {r.node: r.component for r in S.connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{1000 + i: 1000 for i in range(60)}}


def test_rows_that_share_an_id_are_documents_of_their_own(spark):
    rows = [(1, "alpha beta gamma delta", 0), (1, "one two three four five", 1), (2, "alpha beta gamma delta", 2), (None, "alpha beta gamma delta", 3),
            (None, "six seven eight nine", 4), (None, "six seven eight nine", 5), (3, None, 6), (4, "", 7)]
    df = spark.createDataFrame([(*r, r[2]) for r in rows], "doc_id bigint, text string, ew_kept_id int, ew_kept_key_ int")
    for parts in (1, 4):
        kept = S.without_near_duplicates(df.repartition(parts))
        assert kept.columns == df.columns
        got = sorted(((r.doc_id, r.text) for r in kept.collect()), key=str)
        unnamed = [(i, t) for i, t, _ in rows if i is None]
        assert got == sorted([(1, "alpha beta gamma delta"), (1, "one two three four five"), (3, None), *unnamed], key=str)
