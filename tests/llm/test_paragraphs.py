import random
from collections import Counter

from edgewise.llm import paragraphs as P


def brute(docs):
    """n_removed per document index: paragraphs that are not the first of their component."""
    where, sets = [], []
    for i, (_, t) in enumerate(docs):
        for a, b in P.paragraphs(t or ""):
            w = P._normal(t[a:b]).split()
            if len(w) >= P.MIN_WORDS:
                where.append(i)
                sets.append(frozenset(tuple(w[j:j + 5]) for j in range(len(w) - 4)))
    parent = list(range(len(sets)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return Counter(where[i] for i in range(len(sets)) if find(i) != i)


def sentence(rng, n):
    return " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n)) + "."


def test_near_copies_behind_any_lead_in(spark):
    rng = random.Random(4)
    passage = " ".join(sentence(rng, 30) for _ in range(4))
    edited = passage.split()
    edited[60] = "changed"
    docs = [(0, sentence(rng, 40) + " " + passage), (1, sentence(rng, 9) + "\n" + " ".join(edited)), (2, sentence(rng, 50)),
            (3, None), (4, ""), (5, "short line again."), (6, "short line again."), (7, passage.upper()),
            (8, " ".join(sentence(rng, 12) for _ in range(400)))]
    df = spark.createDataFrame([(i, t, 0) for i, t in docs], "doc_id bigint, text string, start int")
    got = {r.doc_id: r for r in P.repeat_report(df).collect()}
    assert {i: r.n_removed for i, r in got.items() if r.n_removed} == dict(brute(docs))
    assert got[1].n_removed and got[7].n_removed and got[7].class_doc_ids[0] == 0 and not got[2].n_members
    cut = {r.doc_id: r.text for r in P.without_repeats(df).collect()}
    assert cut[2] == docs[2][1] and cut[3] is None and len(cut[7]) < len(passage) // 2


def test_a_bucket_of_many_different_paragraphs_loses_no_link(spark):
    rng = random.Random(9)
    base = sentence(rng, 60).split()
    docs = []
    for i in range(120):  # a chain: each differs a little from the one before
        base[rng.randrange(60)] = f"w{i}"
        docs.append((i, " ".join(base)))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r.n_removed for r in P.repeat_report(df, recall=0.999999).collect() if r.n_removed}
    assert got == dict(brute(docs))


def test_repeated_rows_and_an_empty_table(spark):
    rng = random.Random(1)
    t = sentence(rng, 30)
    df = spark.createDataFrame([(1, t), (1, t), (2, t), (None, None)], "doc_id bigint, text string")
    assert sorted([(str(r.doc_id), r.n_removed) for r in P.repeat_report(df).collect()]) == [("1", 0), ("1", 0), ("2", 1), ("None", 0)]
    assert P.repeat_report(df.limit(0)).count() == 0


def test_bands_reach_the_recall():
    bands = P.tuned_bands()
    assert 1 - (1 - P.THRESHOLD ** P.BAND_ROWS) ** bands >= P.RECALL > 1 - (1 - P.THRESHOLD ** P.BAND_ROWS) ** (bands - 1)


def line_brute(docs):
    """n_removed per document index, with every line that holds a word as a paragraph; uses nothing of the module."""
    where, sets = [], []
    for i, t in docs:
        for line in (t or "").split("\n"):
            w = line.encode().lower().split()
            if w:
                where.append(i)
                sets.append({tuple(w[j:j + 5]) for j in range(max(1, len(w) - 4))})
    head = list(range(len(sets)))

    def find(x):
        while head[x] != x:
            x = head[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            if len(a & sets[j]) >= 0.8 * len(a | sets[j]):
                head[max(find(i), find(j))] = min(find(i), find(j))
    return Counter(where[i] for i in range(len(sets)) if find(i) != i)


def test_short_and_hot_lines_are_paragraphs(spark):
    rng = random.Random(5)

    def words(n):
        return " ".join("".join(rng.choice("abcdefgh") for _ in range(4)) for _ in range(n))

    hot, pool = words(9), [words(n) for n in range(1, 15)]
    docs = []
    for i in range(60):
        lines = [words(rng.randrange(1, 20)) for _ in range(3)] + [rng.choice(pool), rng.choice([hot, hot.replace(" ", "\t"), hot.upper() + "  "])]
        rng.shuffle(lines)
        docs.append((i, "\n".join([*lines, "", " \t"])))
    docs += [(60, pool[13] + "\n" + pool[13].replace(" ", " \t ")), (61, None), (62, " \n\t\n")]
    got = {r.doc_id: r for r in P.repeat_report(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    want = line_brute(docs)
    assert {i: r.n_removed for i, r in got.items() if r.n_removed} == dict(want)
    assert sum(want.values()) > 100 and got[62].n_members == 0


def test_passages_in_mid_line_are_found(spark):
    rng = random.Random(12)
    number = iter(range(10 ** 6))

    def run(words, low, high):  # words that occur once, in sentences of low to high words; high 0: without sentence ends
        out, left = [], 0
        for i in range(words):
            out.append(f"wörd{next(number)}" if i % 3 else f"x{next(number)}")
            left -= 1
            if high and left <= 0:
                out[-1] += "."
                left = rng.randint(low, high)
        return " ".join(out)

    docs, shared = [], {}
    for low, high in ((15, 30), (8, 18), (0, 0)):
        for n in (50, 55, 65, 80, 100, 120):
            for _ in range(5):
                passage = run(n, low, high)
                for text in (passage, passage.upper().replace("Ö", "ö")):
                    docs.append((len(docs), "first line\n" + run(60, low, high) + "  " + text + "\t" + run(60, low, high)))
                at = docs[-1][1].index("\t") - len(passage)
                shared[len(docs) - 1] = at, at + len(passage)
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    found = {}
    for r in P.passage_repeats(df).collect():
        assert r.class_doc_id == r.doc_id - 1
        found.setdefault(r.doc_id, []).append((r.start, r.stop))
    assert found.keys() == shared.keys()
    for i, (first, last) in shared.items():
        assert all(first <= a and b <= last and len(docs[i][1][a:b].split()) == P.UNIT_WORDS for a, b in found[i])
    got = {r.doc_id: r for r in P.repeat_report(df).collect()}
    cut = {r.doc_id: r.text for r in P.without_repeats(df).collect()}
    for i, text in docs:
        assert got[i].n_passages == len(found.get(i, [])) and len(cut[i]) == len(text) - got[i].n_chars_removed
        assert i not in shared or got[i].n_chars_removed >= max(b - a for a, b in found[i])


def test_a_block_in_a_removed_near_copy_keeps_its_other_place(spark):
    rng = random.Random(21)
    base, block = sentence(rng, 600)[:-1], sentence(rng, 55)[:-1]
    at = base.index(" ", len(base) // 2)
    docs = [(1, base), (2, base[:at] + " " + block + base[at:]), (3, sentence(rng, 70)[:-1] + " " + block + " " + sentence(rng, 70))]
    cut = {r.doc_id: r.text for r in P.without_repeats(spark.createDataFrame(docs, "doc_id bigint, text string")).collect()}
    assert cut[1] == base and cut[2] == "" and block in cut[3]


def test_short_repeated_lines_are_reported_and_stay(spark):
    rng = random.Random(22)
    short, long = sentence(rng, 9), sentence(rng, 30)
    own = [sentence(rng, 20) for _ in range(3)]
    pair = [sentence(rng, 13), sentence(rng, 14)]
    docs = [(0, "\n".join([short, long, *pair])), (1, own[0] + "\n" + short), (2, long + "\n" + own[1]), (3, "\n".join([own[2], *pair]))]
    df = spark.createDataFrame([(i, t, 1, 2, 3, 4) for i, t in docs], "doc_id bigint, text string, ew_d int, ew_k int, ew_cut int, ew_key int")
    got = {r.doc_id: r for r in P.repeat_report(df).collect()}
    assert (got[1].n_removed, got[1].n_chars_removed) == (1, 0) and got[1].class_doc_ids == [0]
    assert got[2].n_chars_removed == len(long) and got[3].n_chars_removed == len(pair[0]) + len(pair[1])
    cut = {r.doc_id: r for r in P.without_repeats(df).collect()}
    assert cut[1].text == docs[1][1] and cut[2].text == "\n" + own[1] and cut[3].text == own[2] + "\n\n"
    assert (cut[3].ew_d, cut[3].ew_k, cut[3].ew_cut, cut[3].ew_key) == (1, 2, 3, 4)


def test_recall_at_the_threshold_with_the_default_bands(spark):
    """Pairs of Jaccard 0.80 to 0.85 against brute force."""
    rng = random.Random(23)
    docs, pairs = [], 0
    for _ in range(300):
        words = sentence(rng, 64)[:-1].split()
        other = list(words)
        other[rng.randrange(10, 54)] = "x" + "".join(rng.choice("abcdefgh") for _ in range(6))
        if rng.random() < 0.5:
            other = other[: 63]
        a, b = ({tuple(w[j:j + 5]) for j in range(len(w) - 4)} for w in (words, other))
        pairs += 0.8 <= len(a & b) / len(a | b) <= 0.86
        docs += [(len(docs), " ".join(words)), (len(docs) + 1, " ".join(other))]
    got = sum(r.n_removed for r in P.repeat_report(spark.createDataFrame(docs, "doc_id bigint, text string")).collect())
    assert pairs == 300 and got >= 0.95 * pairs


def test_components_across_a_bucket_without_stars(spark):
    """Members alike in no more than the threshold to the bucket's ends are still linked among themselves."""
    rng = random.Random(24)
    base = sentence(rng, 40)[:-1].split()
    docs = []
    for group in range(30):  # the groups share most of the text, but too little with each other
        own = list(base)
        for j in rng.sample(range(40), 4):
            own[j] = f"g{group}x{j}"
        for copy in range(3):
            docs.append((len(docs), " ".join(own + [f"end{copy}"])))
    df = spark.createDataFrame(docs, "doc_id bigint, text string")
    got = {r.doc_id: r.n_removed for r in P.repeat_report(df, recall=0.999999).collect() if r.n_removed}
    assert got == dict(brute(docs))
