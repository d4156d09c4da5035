import hashlib
import os
import random

import numpy as np
import pytest

from edgewise.llm import fingerprints as P


def test_spans_and_common_extensions_equal_brute_force():
    rng = random.Random(5)
    a = bytes(rng.choice(b"ab") for _ in range(300))
    b = a[50:200] + bytes(rng.choice(b"ab") for _ in range(90))
    x, y = P.PrefixHashes(a), P.PrefixHashes(b)
    for _ in range(300):
        i, j = rng.randrange(len(a)), rng.randrange(len(b))
        assert P.common_extension(x, i, y, j) == len(os.path.commonprefix([a[i:], b[j:]]))
        n = rng.randrange(min(len(a) - i, len(b) - j) + 1)
        assert (x.span(i, n) == y.span(j, n)) == (a[i:i + n] == b[j:j + n])
    assert x.spans(7).tolist() == [x.span(i, 7) for i in range(len(a) - 6)]


def test_likeness_follows_jaccard():
    rng = random.Random(6)
    text = "".join(chr(rng.randrange(97, 123)) for _ in range(20000)).encode()
    for share in (0.0, 0.3, 0.7, 1.0):
        cut = int(len(text) * share)
        other = text[:cut] + bytes(rng.randrange(97, 123) for _ in range(len(text) - cut))
        got = P.likeness(P.sketch(P.PrefixHashes(text)), P.sketch(P.PrefixHashes(other)))
        assert abs(got - share / (2 - share)) < 0.2
    assert P.likeness(np.zeros(0), np.zeros(0)) == 1.0 and P.likeness(np.zeros(0), np.ones(1)) == 0.0


def test_likeness_of_short_texts_is_exact():
    rng = random.Random(8)
    for _ in range(400):
        a = bytes(rng.choice(b"ab") for _ in range(rng.randrange(16, 80)))
        cut = rng.randrange(len(a) + 1)
        b = a[:cut] + bytes(rng.choice(b"ab") for _ in range(rng.randrange(16, 80) - min(cut, 16)))
        x, y = ({t[i:i + 16] for i in range(len(t) - 15)} for t in (a, b))
        sketches = [P.sketch(P.PrefixHashes(t)) for t in (a, b)]
        if y and max(map(len, sketches)) < P.SLOTS:
            assert P.likeness(*sketches) == len(x & y) / len(x | y)


DOCS = [(4, "abcdefgh" * 5), (1, None), (9, "é" * 31), (2, ""), (30, "abcdefgh" * 5), (7, "x"), (12, "lorem ipsum " * 3000), (13, "ab")]


@pytest.mark.parametrize("rows_in_range", [10_000, 1, 3])
def test_report_equals_brute_force(spark, rows_in_range):
    df = spark.createDataFrame([(i, t, 1, "k") for i, t in DOCS], "doc_id bigint, text string, seat int, key string")
    got = {r.doc_id: r for r in P.fingerprint_report(df, rows_in_range).collect()}
    rows = sorted((i, t or "") for i, t in DOCS)
    assert len(got) == len(rows)
    for (i, t), (_, after) in zip(rows, rows[1:] + rows[:1]):
        half = len(t) // 2
        edited = t[:len(t) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert r.common_prefix == len(os.path.commonprefix([t.encode(), edited.encode()]))
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert P.likeness(P.parsed(r.fingerprint), P.parsed(r.edited_fingerprint)) == r.near_edited
    assert got[4].fingerprint == got[30].fingerprint and len({r.fingerprint for r in got.values()}) == len({t for _, t in rows})


def test_repeated_ids_a_single_row_and_an_empty_table(spark):
    df = spark.createDataFrame([(1, "a b c d"), (1, "a b c d"), (None, "z"), (1, "q")], "doc_id bigint, text string")
    assert P.fingerprint_report(df, 1).count() == 4
    one = P.fingerprint_report(df.limit(1)).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert P.fingerprint_report(df.limit(0)).count() == 0
