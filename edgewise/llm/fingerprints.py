"""Document fingerprints from prefix polynomial hashes.

The prefix array of a text holds the polynomial hash of each of its prefixes
modulo two primes below 2^31. Two subtractions give the hash of any span, so
spans compare in constant time and the longest common extension of two
positions is a binary search.

The fingerprint of a text is the hash of the whole text, its length in bytes
and the ``SLOTS`` smallest hashes over all spans of ``SPAN`` bytes, which the
prefix array gives at once. Two fingerprints are as alike as the share of
common hashes among the smallest of both: an estimate of the Jaccard
similarity of the texts' spans. Texts shorter than a span have one span, the
whole text.

Defined cases: null text counts as empty; two empty texts are equal, likeness
1; an empty text and another have likeness 0; rows without an id come first,
rows that repeat an id follow each other in order of their texts; a single
document is its own next one; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SPAN = 16
SLOTS = 64
PRIMES = (2147483647, 2147483629)
BASES = (1000003, 1315423911)
#: Rows that one task orders; the table is cut into ranges of ids of about this many.
ROWS_IN_RANGE = 10_000

_POWERS: dict[int, np.ndarray] = {}


def _powers(which: int, n: int) -> np.ndarray:
    """BASE^0 .. BASE^(n-1) modulo the prime; negative ``which``-1 for the inverse base."""
    have = _POWERS.get(which)
    if have is None or len(have) < n:
        p = PRIMES[which if which >= 0 else -which - 1]
        base = BASES[which] if which >= 0 else pow(BASES[-which - 1], -1, p)
        size = max(n, 1 << 16)
        have = np.ones(1, np.uint64)
        while len(have) < size:
            have = np.concatenate((have, have * np.uint64(pow(base, len(have), p)) % np.uint64(p)))
        _POWERS[which] = have
    return have


class PrefixHashes:
    """Prefix arrays of one text (UTF-8 bytes) modulo both primes."""

    def __init__(self, raw: bytes):
        self.n = len(raw)
        c = np.frombuffer(raw, np.uint8).astype(np.uint64) + np.uint64(1)
        self.prefix = []
        for i, p in enumerate(PRIMES):
            out = np.zeros(self.n + 1, np.uint64)
            np.cumsum(c * _powers(i, self.n)[: self.n] % np.uint64(p), out=out[1:])
            self.prefix.append(out % np.uint64(p))

    def span(self, start: int, length: int) -> int:
        """62-bit hash of a span; equal spans have equal hashes wherever they start."""
        out = 0
        for i, p in enumerate(PRIMES):
            d = (int(self.prefix[i][start + length]) - int(self.prefix[i][start])) % p
            out = (out << 31) | d * int(_powers(-i - 1, start + 1)[start]) % p
        return out

    def spans(self, length: int) -> np.ndarray:
        """Hashes of all spans of ``length`` bytes."""
        out = np.zeros(max(0, self.n - length + 1), np.uint64)
        for i, p in enumerate(PRIMES):
            q = np.uint64(p)
            d = (self.prefix[i][length:] + q - self.prefix[i][: len(out)]) % q
            out = (out << np.uint64(31)) | d * _powers(-i - 1, self.n + 1)[: len(out)] % q
        return out


def common_extension(a: PrefixHashes, i: int, b: PrefixHashes, j: int) -> int:
    """Length of the longest common span of ``a`` from ``i`` and ``b`` from ``j``, by binary search."""
    low, high = 0, min(a.n - i, b.n - j)
    while low < high:
        mid = (low + high + 1) // 2
        if a.span(i, mid) == b.span(j, mid):
            low = mid
        else:
            high = mid - 1
    return low


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(32))


def sketch(hashes: PrefixHashes) -> np.ndarray:
    """The smallest mixed span hashes, sorted and distinct."""
    if not hashes.n:
        return np.zeros(0, np.uint64)
    h = _mixed(hashes.spans(min(SPAN, hashes.n)))
    take = SLOTS
    while take < len(h):  # repeats may fill the smallest: take more until enough are distinct
        least = np.unique(np.partition(h, take)[:take])
        if len(least) >= SLOTS:
            return least[:SLOTS]
        take *= 4
    return np.unique(h)[:SLOTS]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Jaccard similarity of two sketches: exact if both hold all spans of their texts, else from the least of the union."""
    if not len(a) or not len(b):
        return float(len(a) == len(b))
    least = np.union1d(a, b)
    if max(len(a), len(b)) >= SLOTS:
        least = least[:SLOTS]
    return float(np.isin(least, a).__and__(np.isin(least, b)).sum() / len(least))


def as_text(hashes: PrefixHashes, least: np.ndarray) -> str:
    return f"{hashes.n:x}-{hashes.span(0, hashes.n):016x}-{least.astype('>u8').tobytes().hex()}"


def parsed(fingerprint: str) -> np.ndarray:
    """The sketch in a fingerprint."""
    return np.frombuffer(bytes.fromhex(fingerprint.rsplit("-", 1)[1]), ">u8").astype(np.uint64)


def _cuts(keys: DataFrame, rows_in_range: int) -> np.ndarray:
    """Inner borders of key ranges of about ``rows_in_range`` rows: one number per range goes to the driver."""
    n = max(1, keys.count() // rows_in_range)
    if n == 1:
        return np.zeros(0, np.int64)
    at = keys.agg(F.percentile_approx("key", [i / n for i in range(1, n)], min(10 * n, 1_000_000))).first()[0]
    return np.unique(np.array(at, np.int64))


_OUT = "n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, " \
       "near_edited double, near_next double, common_prefix bigint"


def fingerprint_report(docs: DataFrame, rows_in_range: int = ROWS_IN_RANGE) -> DataFrame:
    """One row per document row: its fingerprint, that of its edited text, likeness to it and to the next document.

    Ids are cut into ranges; each range is one sorted partition. The first row
    of a range also goes, as a guest, to the end of the range before it (that
    of the first range to the last), so each task finds every next document.
    """
    key = F.coalesce(F.col("doc_id").cast("bigint"), F.lit(-(1 << 63))).alias("key")
    cuts = _cuts(docs.select(key), rows_in_range)
    sc = docs.sparkSession.sparkContext
    borders = sc.broadcast(cuts)

    def firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        least: dict[int, int] = {}
        for b in batches:
            keys = b.column("key").to_numpy()
            seats = np.searchsorted(borders.value, keys, side="right")
            for seat in np.unique(seats).tolist():
                k = int(keys[seats == seat].min())
                least[seat] = min(k, least.get(seat, k))
        yield pa.RecordBatch.from_pydict({"seat": pa.array(list(least), pa.int32()), "least": pa.array(list(least.values()), pa.int64())})

    found = docs.select(key).mapInArrow(firsts, "seat int, least bigint").groupBy("seat").agg(F.min("least").alias("least"))
    held = sorted((r["seat"], r["least"]) for r in found.collect())  # one row per range
    guests = sc.broadcast({least: held[i - 1][0] for i, (_, least) in enumerate(held)})

    def seated(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = b.column("key").to_numpy()
            seats = np.searchsorted(borders.value, keys, side="right").astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array(seats), pa.array(np.zeros(len(seats), np.int8))], [*b.schema.names, "seat", "guest"])
            twice = [i for i, k in enumerate(keys.tolist()) if k in guests.value]
            if twice:
                more = b.take(pa.array(twice))
                there = [guests.value[k] for k in keys[twice].tolist()]
                yield pa.RecordBatch.from_arrays(
                    [*more.columns, pa.array(there, pa.int32()), pa.array(np.ones(len(twice), np.int8))],
                    [*b.schema.names, "seat", "guest"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", key, F.coalesce("text", F.lit("")).alias("text"))
    placed = rows.mapInArrow(seated, f"doc_id {id_type}, key bigint, text string, seat int, guest tinyint") \
        .repartitionById(len(cuts) + 1, "seat").sortWithinPartitions("seat", "guest", "key", F.md5("text"))
    return placed.select("doc_id", "text", "seat", "guest").mapInArrow(_report, f"doc_id {id_type}, {_OUT}")


def _report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come ordered by seat; each row is reported when the row after it is known."""
    held = None  # (seat, doc_id, text, hashes, sketch)
    ended = -1  # the seat whose guest has been used
    out: list[tuple] = []
    for b in batches:
        for seat, guest, doc_id, text in zip(*(b.column(c) for c in ("seat", "guest", "doc_id", "text"))):
            seat = seat.as_py()
            if seat == ended:  # copies of the first row of the next range
                continue
            raw = text.as_py()
            own = PrefixHashes(raw.encode())
            least = sketch(own)
            if held and held[0] == seat:
                out.append(_row(*held[1:], raw, least))
            held = (seat, doc_id, raw, own, least)
            if guest.as_py():
                ended, held = seat, None
            if len(out) >= 1000:
                yield _batch(out, b.schema.field("doc_id").type)
                out = []
        if out:
            yield _batch(out, b.schema.field("doc_id").type)
            out = []


def _row(doc_id, text: str, own: PrefixHashes, least: np.ndarray, next_text: str, next_least: np.ndarray) -> tuple:
    half = len(text) // 2
    edited = text[: len(text) - half] + next_text[:half]
    raw = edited.encode()
    other = PrefixHashes(raw)
    other_least = sketch(other)
    return (doc_id, len(text), hashlib.sha256(raw).hexdigest(), as_text(own, least), as_text(other, other_least),
            likeness(least, other_least), likeness(least, next_least), common_extension(own, 0, other, 0))


def _batch(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
    doc_id, *rest = zip(*rows)
    types = [pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.int64()]
    names = ["doc_id"] + [c.split()[0] for c in _OUT.split(", ")]
    return pa.RecordBatch.from_arrays(
        [pa.array([d.as_py() for d in doc_id], id_type)] + [pa.array(c, t) for c, t in zip(rest, types)], names)
