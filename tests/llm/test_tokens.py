import base64
import hashlib
import random

import public_tokenizers
import tiktoken
from tokenizers import Tokenizer

from edgewise.llm import bpe, token_counts

RANKS, WORDS = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.path("word_bpe_49k.json")


def texts():
    rng = random.Random(3)
    odd = [*range(9, 14), *range(28, 127), *range(0xA0, 0x250), 0x300, 0x301, 0x3A3, 0x130, 0x131, 0x4E00, 0x1F600, 0x2028, 0xAC00]
    return [None, "", " ", "\n\n  a", "a" * 3000, "don't WE'LL I'm x'd", "naïve café — 日本語 🙂🙂 ١٢٣ x² ªº ½", "İstanbul ΣΑΣ é K",
            "<|endoftext|> in <|startoftext|>text", "12345 1_000 _a_ \x1c b\u0085c",
            *["".join(chr(rng.choice(odd)) for _ in range(200)) for _ in range(80)], "long words " * 4000, "\U0010ffff"]


def test_ids_equal_tiktoken_and_decode_to_the_bytes(spark):
    with open(RANKS, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    reference = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    rows = [*enumerate(texts()), (None, "x y"), (0, "x y")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, n_tokens int")
    got = sorted([tuple(r) for r in bpe.round_trip_report(docs, RANKS, public_tokenizers.PATTERN).collect()], key=str)
    want = []
    for i, t in rows:
        ids = reference.encode_ordinary(t or "")
        want.append((i, len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(),
                     hashlib.sha256((t or "").encode()).hexdigest()))
    assert got == sorted(want, key=str)
    back = bpe.decoded(bpe.encoded(docs.where("doc_id > 0"), RANKS, public_tokenizers.PATTERN), RANKS, public_tokenizers.PATTERN)
    assert {r.doc_id: r.text for r in back.collect()} == {i: t or "" for i, t in rows if i}
    assert bpe.round_trip_report(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0


def test_offsets_and_split_characters():
    with open(RANKS, "rb") as f:
        model = bpe.ByteBpe(f.read(), public_tokenizers.PATTERN)
    text = "x 🙂 y"
    ids = model.encode(text)
    spans = model.offsets(ids)
    assert [text.encode()[a:b] for a, b in spans] == [model.tokens[i] for i in ids]
    assert spans[0][0] == 0 and spans[-1][1] == len(text.encode())
    cut = next(i for i, (a, b) in enumerate(spans) if 2 < b < 6)  # a token that ends inside the four bytes
    assert "�" in model.decode_text(ids[: cut + 1]) and model.decode_text(ids) == text


def test_counts_equal_the_library(spark):
    library = Tokenizer.from_file(WORDS)
    rows = [*enumerate(texts()), (None, "x y"), (0, "x y")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id bigint, text string, n_tokens int")
    got = sorted([tuple(r) for r in token_counts.token_counts(docs, WORDS).collect()], key=str)
    n = [len(library.encode(t or "", add_special_tokens=False).ids) for _, t in rows]
    assert got == sorted([(i, len((t or "").encode()), k, k > 2048) for (i, t), k in zip(rows, n)], key=str)
    assert any(k > 2048 for k in n)
    assert token_counts.token_counts(docs.limit(0), WORDS).count() == 0


def test_whole_tokens_are_proven():
    with open(WORDS, encoding="utf-8") as f:
        counter = token_counts.Counter(f.read())
    assert len(counter.whole) > 20_000
    for w in random.Random(1).sample(sorted(counter.whole), 300):
        assert len(counter.library.encode(w, add_special_tokens=False).ids) == 1
