import random
import re
from collections import Counter

import duckdb
import numpy as np

from edgewise.llm import phrases as P


def brute(rows, least=10, longest=3, top=2000):
    """The contract with dictionaries and exact integers."""
    f, size = Counter(), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split("[.,;:!?\n\x0b\x0c\r]", text):
            w = re.findall("[^ \t]+", piece)
            size[lang] += len(w)
            for k in range(1, longest + 1):
                for i in range(len(w) - k + 1):
                    f[lang, tuple(w[i: i + k])] += 1
    found = {k: n for k, n in f.items() if len(k[1]) > 1 and n >= least}
    covered = Counter()
    for (lang, w), n in found.items():
        for k in range(2, len(w)):
            for i in range(len(w) - k + 1):
                covered[lang, w[i: i + k]] = max(covered[lang, w[i: i + k]], n)
    out = []
    for lang in sorted(size):
        mine = []
        for (x, w), a in found.items():
            if x != lang or 100 * covered[x, w] >= 50 * a:
                continue
            score, k = min((1_000_000 * a * a // (f[x, w[:k]] * f[x, w[k:]]), k) for k in range(1, len(w)))
            mine.append((-score, -a, " ".join(w).encode(), f[x, w[:k]], f[x, w[k:]]))
        for rank, (s, a, p, left, right) in enumerate(sorted(mine)[:top], 1):
            out.append((lang, rank, p.decode(), -a, left, right, size[lang], -s))
    return out


def rows_of(seed, n=250):
    rng = random.Random(seed)
    vocab = ["the", "The", "of", "New", "york", "city", "été", "x1", "a b", "\U0001d11e", "z'", "-", "hall", "green"]
    out = []
    for _ in range(n):
        words = []
        for _ in range(rng.randint(0, 40)):
            words += ["new", "york", "city"] if rng.random() < 0.08 else [rng.choice(vocab)]
        text = ""
        for w in words:
            text += w + rng.choice([" ", " ", "  ", "\t", ", ", ".", "\n", "! ", " \x0b"])
        out.append((rng.choice(["en", "fr", None, "und"]), text))
    return out


def got(df, **more):
    return sorted(tuple(r) for r in P.collocations(df, **more).collect())


def frame(spark, rows):
    return spark.createDataFrame([(lang, text, "x", 1) for lang, text in rows], "lang string, text string, phrase string, n int")


def test_equals_brute_force_with_nulls_and_repeats(spark):
    rows = rows_of(1) + [("en", None), (None, ""), ("fr", " . , ")] + [("en", "new york city hall")] * 300
    assert got(frame(spark, rows).repartition(5)) == brute(rows)


def test_equals_the_sql(spark, tmp_path):
    rows = rows_of(2)
    frame(spark, rows).select("lang", "text").coalesce(1).write.parquet(str(tmp_path / "d"))
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/d/*.parquet'")
    assert got(frame(spark, rows)) == sorted(con.execute(P.ORACLE).fetchall())


def test_small_slices_and_cut_routes_give_the_same(spark):
    rows = rows_of(3) + [("en", "w" * 400 + " " + "word " * 200)] * 12
    assert max(end - at for at, end, _ in P._slices(b"ab cd ef " * 30, 2, 64)) <= 64
    assert got(frame(spark, rows), slice_bytes=64, sorted_pointers=40, hot_words=3) == brute(rows)


def test_longer_phrases_and_other_bounds(spark):
    rows = rows_of(4, 120)
    assert got(frame(spark, rows), least=4, longest=5, top=50) == sorted(brute(rows, 4, 5, 50))


def test_scores_pass_64_bits(spark):
    one = spark.createDataFrame([(3_000_000_000, 3_000_000_001, 2_999_999_999 + 5)], "a bigint, l bigint, r bigint")
    score = P.score(P.F.col("a"), P.F.col("l"), P.F.col("r"))
    assert one.select(score.alias("s")).first()["s"] == 1_000_000 * 3_000_000_000 ** 2 // (3_000_000_001 * 3_000_000_004)


def test_quicksort_counts_and_abandons():
    rng = np.random.default_rng(1)
    for n, v in ((1, 3), (1000, 5), (5000, 40), (20, 1)):
        s = [rng.integers(0, 2, n), rng.integers(0, v, n), rng.integers(-1, v, n), rng.integers(-1, v, n)]
        s[3] = np.where(s[2] < 0, -1, s[3])
        w = rng.integers(1, 4, n)
        c = Counter()
        for p in range(n):
            for d in range(1, 5):
                if s[d - 1][p] < 0:
                    break
                c[tuple(int(x[p]) for x in s[:d])] += int(w[p])
        want = {k: x for k, x in c.items() if x >= (1 if k[0] == 1 else 10)}
        seen = {}
        for d, one, total in P.frequent_prefixes(s, w, np.tile(np.where(s[0] == 1, 1, 10), (4, 1))):
            for p, x in zip(one, total):
                key = tuple(int(y[p]) for y in s[:d])
                assert key not in seen
                seen[key] = int(x)
        assert seen == want


def test_empty_table(spark):
    assert got(frame(spark, [("en", "a b")]).where("false")) == []
