"""Byte-level BPE encoding and decoding with the tokenizers library over Arrow batches.

The rank file becomes a byte-level BPE model: every byte maps to one printable
character, every split of a token into two tokens is a merge, in rank order.
Texts are cut by the split pattern; each distinct piece of a batch is encoded
once and its ids are kept in a bounded cache. Decoding joins the bytes that the rank
file gives for the ids, so a character that lies across several tokens comes back whole.

The rank file has a fixed size, is read once on the driver and sent along with
the tasks. Defined cases: null text counts as empty (no tokens); repeated rows
are encoded each; further columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
from collections.abc import Iterator
from itertools import chain

import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame

#: Pieces whose ids a worker keeps; the cache starts afresh beyond it.
CACHE_PIECES = 200_000


def byte_characters() -> list[str]:
    """The character that stands for each byte: printable Latin-1 as it is, the rest from U+0100 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, extra = [], 0
    for b in range(256):
        if b in plain:
            out.append(chr(b))
        else:
            out.append(chr(0x100 + extra))
            extra += 1
    return out


class ByteBpe:
    """Encoder and decoder for one rank file (lines of base64 token and rank)."""

    def __init__(self, rank_file: bytes, pattern: str):
        import regex
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core

        ranks = {base64.b64decode(t): int(r) for t, r in (x.split() for x in rank_file.splitlines() if x)}
        self.tokens = {r: t for t, r in ranks.items()}
        self.characters = byte_characters()
        shown = {t: self.shown(t) for t in ranks}
        merges = [(shown[t[:i]], shown[t[i:]]) for t in sorted(ranks, key=ranks.get)
                  for i in range(1, len(t)) if t[:i] in ranks and t[i:] in ranks]
        self.library = Tokenizer(BPE({shown[t]: r for t, r in ranks.items()}, merges, ignore_merges=True))
        self.pieces = regex.compile(pattern).findall
        self.cache: dict[str, tuple[int, ...]] = {}

    def shown(self, raw: bytes) -> str:
        return "".join(map(self.characters.__getitem__, raw))

    def learn(self, pieces: set[str]) -> None:
        """Encode the pieces that the cache lacks."""
        if len(self.cache) + len(pieces) > CACHE_PIECES:
            self.cache.clear()
        new = [p for p in pieces if p not in self.cache]
        found = self.library.encode_batch([self.shown(p.encode()) for p in new], add_special_tokens=False)
        for p, e in zip(new, found):
            self.cache[p] = tuple(e.ids)

    def encode(self, text: str | None) -> list[int]:
        pieces = self.pieces(text or "")
        self.learn(set(pieces))
        return list(chain.from_iterable(map(self.cache.__getitem__, pieces)))

    def offsets(self, ids: list[int]) -> list[tuple[int, int]]:
        """Byte span of each token; a character split over tokens has its bytes in several spans."""
        out, at = [], 0
        for i in ids:
            out.append((at, at := at + len(self.tokens[i])))
        return out

    def decode(self, ids: list[int]) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))

    def decode_text(self, ids: list[int]) -> str:
        """Text of the ids; bytes that are no whole character (ids cut inside one) show as U+FFFD."""
        return self.decode(ids).decode("utf-8", errors="replace")


_LOADED: dict[tuple[str, str], ByteBpe] = {}


def loaded(rank_file: bytes, pattern: str) -> ByteBpe:
    """One model per worker process and file."""
    key = (hashlib.sha256(rank_file).hexdigest(), pattern)
    if key not in _LOADED:
        _LOADED[key] = ByteBpe(rank_file, pattern)
    return _LOADED[key]


def _ranks(docs: DataFrame, path: str) -> Broadcast:
    with open(path, "rb") as f:
        return docs.sparkSession.sparkContext.broadcast(f.read())


def encoded(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, ids): the token ids of every text."""
    ranks = _ranks(docs, path)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(ranks.value, pattern)
        for b in batches:
            ids = [model.encode(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(ids, pa.list_(pa.int32()))], ["doc_id", "ids"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(encode, f"doc_id {id_type}, ids array<int>")


def decoded(tokens: DataFrame, path: str, pattern: str) -> DataFrame:
    """(doc_id, text) of (doc_id, ids)."""
    ranks = _ranks(tokens, path)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(ranks.value, pattern)
        for b in batches:
            texts = [model.decode_text(ids or []) for ids in b.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"])

    id_type = tokens.schema["doc_id"].dataType.simpleString()
    return tokens.select("doc_id", "ids").mapInArrow(decode, f"doc_id {id_type}, text string")


def round_trip_report(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """One row per document: doc_id, n_tokens, ids_sha256, decoded_sha256 (of the bytes decoded from the ids)."""
    ranks = _ranks(docs, path)

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = loaded(ranks.value, pattern)
        for b in batches:
            n, of_ids, of_bytes = [], [], []
            for text in b.column("text").to_pylist():
                ids = model.encode(text)
                n.append(len(ids))
                of_ids.append(hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
                of_bytes.append(hashlib.sha256(model.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(of_ids, pa.string()), pa.array(of_bytes, pa.string())],
                ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        report, f"doc_id {id_type}, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
