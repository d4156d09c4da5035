import hashlib
import random

import numpy as np
import pytest

from edgewise.llm import suffix_dedup as S


def brute(docs, length=100):
    seen, out = set(), []
    for i, t in sorted(docs, key=lambda d: (d[0] is not None, d[0] or 0, hashlib.md5((d[1] or "").encode()).hexdigest())):
        b = (t or "").encode()
        cut = np.zeros(len(b) + 1, bool)
        for s in range(len(b) - length + 1):
            if b[s:s + length] in seen:
                cut[s:s + length] = True
            seen.add(b[s:s + length])
        cut = cut[:len(b)]
        spans = int((np.diff(np.concatenate(([0], cut.astype(int)))) == 1).sum())
        out.append((i, len(b), int(cut.sum()), spans, hashlib.sha256(bytes(np.frombuffer(b, np.uint8)[~cut])).hexdigest()))
    return sorted(out, key=str)


def made(seed, n=50):
    rng = random.Random(seed)
    base = "".join(rng.choice("abcdé \n") for _ in range(1500))
    docs = []
    for i in range(n):
        k = rng.random()
        if k < .3:
            t = base[rng.randrange(1000):][:rng.randrange(600)]
        elif k < .4:
            t = "that " * rng.randrange(100)
        elif k < .5:
            t = base[:400] + "".join(rng.choice("xyz") for _ in range(50)) + base[300:900]
        elif k < .6:
            t = rng.choice(["", None, "a" * 99, "a" * 100, "a" * 101])
        elif k < .7:
            t = "ab" * rng.randrange(300) + base[200:500] + "ab" * rng.randrange(200)
        elif k < .8 and docs:
            t = rng.choice(docs)[1]
        else:
            t = "".join(rng.choice("abcdé \n") for _ in range(rng.randrange(500)))
        docs.append((i * 3, t))
    return docs


def report(spark, docs, **more):
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in docs], "doc_id bigint, text string, start int, id string")
    return sorted([tuple(r)[:5] for r in S.removal_report(df, **more).collect()], key=str)


@pytest.mark.parametrize("hot_runs", [S.HOT_RUNS, 1])
def test_removal_equals_brute_force(spark, hot_runs):
    docs = made(11)
    assert report(spark, docs, hot_runs=hot_runs) == brute(docs)


def test_repeated_and_missing_ids_and_an_empty_table(spark):
    docs = made(3, 12) + [(3, "that " * 60), (None, "that " * 50), (None, None), (3, "that " * 60)]
    assert report(spark, docs) == brute(docs)
    assert report(spark, []) == []


def test_repeat_groups_are_all_maximal_repeats():
    rng = random.Random(2)
    pieces = [bytes(rng.choice(b"ab") for _ in range(rng.randrange(40))) for _ in range(12)]
    length = 4
    places = {}
    for p, b in enumerate(pieces):
        for s in range(len(b)):
            for e in range(s + length, len(b) + 1):
                places.setdefault(b[s:e], []).append((p, s))
    want = set()
    for text, at in places.items():
        left = {pieces[p][s - 1] if s else ("start", p) for p, s in at}
        right = {pieces[p][s + len(text)] if s + len(text) < len(pieces[p]) else ("end", p) for p, s in at}
        if len(at) > 1 and len(left) > 1 and len(right) > 1 and len(text) <= 16:
            want.add((len(text), tuple(at)))
    got = {(n, tuple(at)) for n, at in S.repeat_groups(pieces, length) if n <= 16}
    assert got == want
