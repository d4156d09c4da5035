"""Token counts with the whole-token shortcut.

Offline, every vocabulary string that ends a word is encoded by the library
alone; those that give exactly one token are proven whole tokens. At run time
each piece of a text (the tokenizer's own split of the lower-cased text) that
is a whole token counts one; only the other pieces are merged by the library,
each distinct one once per batch, with a bounded cache.

Texts that hold a special token's string, or a character at or beyond U+0250
(where normal forms and letter classes need the library's own tables), go to
the library whole. Defined cases: null text counts as empty; repeated rows are
counted each; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from edgewise.llm.bpe import byte_characters

LIMIT = 2048
CACHE_PIECES = 400_000

#: Latin letters below U+0250 whose lower case is one character; others take the library's way.
_OTHER = re.compile("[^\x00-įı-ɏ]").search


class Counter:
    """Counts tokens of texts for one tokenizer file."""

    def __init__(self, tokenizer_json: str):
        import json

        import regex
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core

        described = json.loads(tokenizer_json)
        self.library = Tokenizer.from_str(tokenizer_json)
        self.library.no_truncation()
        self.library.no_padding()
        self.special = [t["content"] for t in described["added_tokens"]]
        split = described["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split).findall
        self.whole = self.whole_tokens(described["model"]["vocab"], described["model"]["end_of_word_suffix"])
        self.cache: dict[str, int] = {}

    def whole_tokens(self, vocab: dict[str, int], suffix: str) -> set[str]:
        """Strings of the vocabulary that the library encodes, alone, as one token."""
        back = {c: b for b, c in enumerate(byte_characters())}
        words = []
        for token in vocab:
            if token.endswith(suffix) and all(c in back for c in token[: -len(suffix)]):
                raw = bytes(back[c] for c in token[: -len(suffix)])
                try:
                    words.append(raw.decode())
                except UnicodeDecodeError:
                    continue
        alone = self.library.encode_batch(words, add_special_tokens=False)
        return {w for w, e in zip(words, alone) if len(e.ids) == 1 and self.pieces(w) == [w]}

    def counts(self, texts: list[str | None]) -> list[int]:
        plain: list[list[str] | None] = []
        missing: set[str] = set()
        for t in texts:
            t = t or ""
            if _OTHER(t) or any(s in t for s in self.special):
                plain.append(None)
                continue
            rest = self.pieces(t.lower())
            plain.append(rest)
            missing.update(rest)
        missing -= self.whole
        if len(self.cache) + len(missing) > CACHE_PIECES:
            self.cache.clear()
        new = [p for p in missing if p not in self.cache]
        for p, e in zip(new, self.library.encode_batch(new, add_special_tokens=False)):
            self.cache[p] = len(e.ids)
        whole, cache = self.whole, self.cache
        return [len(self.library.encode(t, add_special_tokens=False).ids) if p is None
                else sum([1 if x in whole else cache[x] for x in p]) for t, p in zip(texts, plain)]


_LOADED: dict[str, Counter] = {}


def loaded(tokenizer_json: str) -> Counter:
    key = hashlib.sha256(tokenizer_json.encode()).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Counter(tokenizer_json)
    return _LOADED[key]


def token_counts(docs: DataFrame, path: str, limit: int = LIMIT) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_tokens, over_limit."""
    with open(path, encoding="utf-8") as f:
        file = docs.sparkSession.sparkContext.broadcast(f.read())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = loaded(file.value)
        for b in batches:
            for at in range(0, b.num_rows, 500):
                part = b.slice(at, 500)
                texts = part.column("text").to_pylist()
                n = counter.counts(texts)
                size = [len(t.encode()) if t else 0 for t in texts]
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(size, pa.int64()), pa.array(n, pa.int64()),
                     pa.array([x > limit for x in n], pa.bool_())],
                    ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        count, f"doc_id {id_type}, n_bytes bigint, n_tokens bigint, over_limit boolean")
