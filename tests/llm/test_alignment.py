import hashlib
import random
from collections import Counter, defaultdict

import public_tokenizers
import pytest

from edgewise.llm import alignment as A

PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def both():
    import sentencepiece
    from tokenizers import Tokenizer
    a = Tokenizer.from_file(PATHS[0])
    a.encode_special_tokens = True
    return a, sentencepiece.SentencePieceProcessor(model_file=PATHS[1])


def a_bytes(a, i):
    """Bytes of a token by the library's own decoder table: printable characters stand for themselves, others from U+0100 on."""
    keep = [*range(33, 127), *range(161, 173), *range(174, 256)]
    table = {chr(b): b for b in keep}
    table |= {chr(256 + n): b for n, b in enumerate(b for b in range(256) if b not in keep)}
    return bytes(table[c] for c in a.id_to_token(i))


def b_bytes(b, i):
    p = b.id_to_piece(i)
    return bytes([int(p[3:5], 16)]) if b.is_byte(i) else p.replace("▁", " ").encode()


def brute_groups(both, text):
    if not text:
        return []
    a, b = both
    of_a, of_b = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
    raw_a, raw_b = [a_bytes(a, i) for i in of_a], [b_bytes(b, i) for i in of_b]
    whole = (" " + text).encode()
    if b"".join(raw_a) != whole or b"".join(raw_b) != whole:
        return []
    out, x, y, at_a, at_b, group = [], 0, 0, 0, 0, ([], [])
    while x < len(of_a) or y < len(of_b):
        if at_a <= at_b and x < len(of_a):
            group[0].append(of_a[x])
            at_a += len(raw_a[x])
            x += 1
        else:
            group[1].append(of_b[y])
            at_b += len(raw_b[y])
            y += 1
        if at_a == at_b and group[1]:
            out.append(group)
            group = ([], [])
    return out


def brute_report(both, rows):
    groups = [brute_groups(both, t) for _, t in rows]
    held, out = Counter(), []
    for g in groups:
        held.update({(x, y) for a, b in g for x in a for y in b})
    most = defaultdict(int)
    for (x, _), n in held.items():
        most[x] = max(most[x], n)
    for (i, _), g in zip(rows, groups):
        links = [(x, y) for a, b in g for x in a for y in b]
        said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in g)
        out.append((i, sum(len(a) for a, _ in g), sum(len(b) for _, b in g), len(g), len(links),
                    sum(held[k] == most[k[0]] for k in links), sum(held[k] for k in links),
                    hashlib.sha256(said.encode()).hexdigest() if g else ""))
    return sorted(out, key=str)


ODD = ["a", "e", "h", "t", " ", " ", "\n", "\t", ".", "'ll", "0", "12", ",", "-", "é", "中", "\U0001d11e", "▁", "́", " ", " ",
       "\x1c", "\x85", "​", "<|endoftext|>", "<s>", "<0x41>", "ﬁ", "Ａ", "\x00", "　", "the ", " token", "�", "﻿"]


def rows_of(n, seed):
    rng = random.Random(seed)
    return [(i, "".join(rng.choice(ODD) for _ in range(rng.randint(0, 30)))) for i in range(n)]


def test_report_equals_brute_force(spark, both):
    rows = rows_of(400, 5) + [(1000, None), (1001, ""), (1002, " "), (1003, "\n"), (1004, "the the the"), (1004, "the the the"),
                              (None, "null id"), (None, "null id"), (1005, "x" * 3000), (1006, " " * 3000), (1007, "aeiou" * 2000)]
    docs = spark.createDataFrame([(i, t, 3, "n") for i, t in rows], "doc_id bigint, text string, pair int, n_a string")
    got = sorted(map(tuple, A.alignment_report(docs, *PATHS).collect()), key=str)
    assert got == brute_report(both, rows)


def test_nothing_broadcast_and_small_blocks_give_the_same(spark, both, monkeypatch):
    rows = rows_of(120, 6) + [(2000 + i, "the cat sat on the mat. " * 40) for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    monkeypatch.setattr(A, "HOT_PAIRS", 1)  # only a pair that is every row would be hot
    assert sorted(map(tuple, A.alignment_report(docs, *PATHS).collect()), key=str) == brute_report(both, rows)


def test_blocks_of_a_long_text(both, monkeypatch):
    text = " ".join(t for _, t in rows_of(300, 7)).replace("▁", "_") + "\n\nend " + "y" * 500
    with open(PATHS[0], encoding="utf-8") as a, open(PATHS[1], "rb") as b:
        aligner = A.Aligner(a.read(), b.read())
    assert aligner.by_units
    monkeypatch.setattr(A, "BLOCK_CHARACTERS", 100)
    want = brute_groups(both, text)
    said = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in want)
    sizes, digest, pair, times = A._long(aligner, text)
    assert sizes == [sum(len(a) for a, _ in want), sum(len(b) for _, b in want), len(want)]
    assert digest == hashlib.sha256(said.encode()).hexdigest()
    links = Counter((x, y) for a, b in want for x in a for y in b)
    assert {(int(p) >> 32, int(p) & 0xFFFFFFFF): int(n) for p, n in zip(pair, times)} == links
    aligner.by_units = False  # the way for files whose tokens may cross a unit's end
    aligner.clear()
    assert A._long(aligner, text)[:2] == (sizes, digest)
    assert A._long(aligner, text + "▁")[:2] == ([0, 0, 0], "")


def test_the_cache_starts_afresh(both, monkeypatch):
    monkeypatch.setattr(A, "CACHE_UNITS", 3)
    with open(PATHS[0], encoding="utf-8") as a, open(PATHS[1], "rb") as b:
        aligner = A.Aligner(a.read(), b.read())
    for t in ("one two three four five", "two three six", "one two three four five"):
        (n,) = aligner.numbered([aligner.units(" " + t)])
        want = ";".join(f"{','.join(map(str, a))}|{','.join(map(str, b))}" for a, b in brute_groups(both, t))
        assert ";".join(aligner.said[i] for i in n) == want


def test_groups_and_the_empty_table(spark, both):
    rows = [(1, "tokenization, aligned"), (2, None), (3, "a▁b")]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    got = {r.doc_id: [(list(g.a), list(g.b)) for g in r.groups] for r in A.groups(docs, *PATHS).collect()}
    assert got == {i: [tuple(g) for g in brute_groups(both, t)] for i, t in rows}
    assert A.alignment_report(docs.where("false"), *PATHS).collect() == []
