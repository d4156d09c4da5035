"""Cross-tokenizer alignment of a byte-level BPE (A) and a sentencepiece BPE (B).

Both tokenizers see the same bytes, a space and the text. The cumulative ends of
each side's tokens are kept in a dictionary from end to token index; the ends
that both dictionaries hold, sorted, slice the two id lists into groups. Tokens
of a group are linked, each of A with each of B. A group's links are held as
distinct id pairs with their multiplicity, so a long group of alike tokens is
no long list.

A text is cut into units where a blank or line feed follows another character
than white space. A's split begins a new piece there, and no piece of B holds
a line feed, or a blank behind another character (both are checked when the
files are read; files that differ are aligned text by text). No token crosses such
a cut, so it is a common end, and each distinct unit is encoded and aligned once a
cache life.

The corpus-wide count of an id pair is the number of documents that hold it
linked. Pairs that make up at least 1 in ``HOT_PAIRS`` of all rows (document, pair)
are broadcast; there are at most ``HOT_PAIRS`` of them at any size. The other
pairs meet their counts by shuffle. The highest count of each A id is one row
per vocabulary entry and is broadcast.

Defined cases: null and empty texts, and texts that a tokenizer does not give
back byte for byte (U+2581 is a blank to B), have no tokens; special tokens'
strings are plain text; repeated rows are documents of their own; ties for the
highest count all count; an empty table gives an empty report; very long texts
are worked off in blocks that end between units; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from edgewise.llm.bpe import byte_characters
from edgewise.llm.common import stored

#: Units whose alignment a worker keeps; the cache starts afresh beyond it.
CACHE_UNITS = 300_000
#: Texts are aligned in batches of this many rows, and in blocks of this many characters.
BATCH_ROWS = 500
BLOCK_CHARACTERS = 2_000_000
#: Units that are encoded at a time; a group of more pairs than ``LISTED_PAIRS`` is never listed pair by pair.
ENCODED_UNITS = 5_000
RUN_UNITS = 500
LISTED_PAIRS = 4_096
#: A pair with at least 1 in so many of all (document, pair) rows is broadcast.
HOT_PAIRS = 20_000

_UNIT = re.compile(r"\s*\S+(?:[^\S \n]\s*\S*)*|\s+")
_CUT = re.compile(r"(?<=\S)[ \n]")
_BLANK = "▁"


def common_ends(a_sizes: np.ndarray, b_sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(tokens of A, tokens of B) used up at each common end, from the byte sizes of both sides' tokens."""
    of_a = dict(zip(np.cumsum(a_sizes).tolist(), range(1, len(a_sizes) + 1)))
    of_b = dict(zip(np.cumsum(b_sizes).tolist(), range(1, len(b_sizes) + 1)))
    both = sorted(of_a.keys() & of_b.keys())
    return np.array([of_a[e] for e in both], np.int64), np.array([of_b[e] for e in both], np.int64)


def group_links(a: np.ndarray, b: np.ndarray, cut_a: np.ndarray, cut_b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, pair, times) of every group; a group of many pairs is counted by distinct ids."""
    from_a, from_b = np.concatenate(([0], cut_a[:-1])), np.concatenate(([0], cut_b[:-1]))
    of_a, of_b = cut_a - from_a, cut_b - from_b
    small = of_a * of_b <= LISTED_PAIRS
    size = np.where(small, of_a * of_b, 0)
    group = np.repeat(np.arange(len(size)), size)
    at = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    pair = a[from_a[group] + at // of_b[group]] << 32 | b[from_b[group] + at % of_b[group]]
    parts = [(group, pair, np.ones(len(pair), np.int64))]
    for g in np.flatnonzero(~small):
        x, n = np.unique(a[from_a[g]:cut_a[g]], return_counts=True)
        y, m = np.unique(b[from_b[g]:cut_b[g]], return_counts=True)
        parts.append((np.full(len(x) * len(y), g), (x[:, None] << 32 | y).ravel(), (n[:, None] * m).ravel()))
    group, pair, times = (np.concatenate(c) for c in zip(*parts))
    order = np.argsort(group, kind="stable") if len(parts) > 1 else slice(None)
    return group[order], pair[order], times[order]


class Aligner:
    """Tokenizes with both files and aligns; keeps what it learnt of units."""

    def __init__(self, a_json: str, b_model: bytes):
        import sentencepiece
        from tokenizers import Tokenizer

        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core

        said = json.loads(a_json)
        self.a = Tokenizer.from_str(a_json)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        back = {c: b for b, c in enumerate(byte_characters())}
        vocab = self.a.get_vocab(with_added_tokens=False)
        a_bytes = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            a_bytes[i] = bytes(back[c] for c in token) if all(c in back for c in token) else b""
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        pieces = [self.b.id_to_piece(i) for i in range(self.b.vocab_size())]
        b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace(_BLANK, " ").encode() for i, p in enumerate(pieces)]
        self.raw = pa.array(a_bytes, pa.binary()), pa.array(b_bytes, pa.binary())
        self.size = np.array([len(x) for x in a_bytes]), np.array([len(x) for x in b_bytes])
        # an id with what follows it in a group: another id of its side, the other side, or the next group
        self.shown = pa.array([f"{i}{c}" for n, ends in ((len(a_bytes), ",|"), (len(b_bytes), ",;")) for c in ends for i in range(n)])
        split = said.get("pre_tokenizer") or {}
        self.by_units = split.get("type") == "ByteLevel" and split.get("use_regex", True) and not split.get("add_prefix_space") \
            and not said.get("normalizer") and not any("\n" in p or re.search(f"[^{_BLANK}]{_BLANK}", p) for p in pieces) \
            and len(self.b.encode("x")) == 1
        self.clear()

    def clear(self) -> None:
        self.known: dict[str, int] = {}
        self.sizes = np.zeros((0, 4), np.int64)  # tokens of A, of B, groups, whether both give the unit back
        self.said: list[str] = []
        self.start, self.pair, self.times = np.zeros(1, np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64)

    def units(self, text: str) -> list[str]:
        return _UNIT.findall(text) if self.by_units else [text]

    def learn(self, units: set[str]) -> None:
        """Encode and align the units that are not known yet."""
        if len(self.known) + len(units) > CACHE_UNITS:
            self.clear()
        new = [u for u in units if u not in self.known]
        if not new:
            return
        sizes, starts, pairs, times = [self.sizes], [self.start], [self.pair], [self.times]
        plain = [u for u in new if self.by_units and not u[-1].isspace()]
        rest = [u for u in new if not self.by_units or u[-1].isspace()]
        for part, runs in [(some[at: at + ENCODED_UNITS], some is plain) for some in (plain, rest) for at in range(0, len(some), ENCODED_UNITS)]:
            self.known.update(zip(part, range(len(self.said), len(self.said) + len(part))))
            size, said, count, pair, n = self.align(part, runs)
            sizes.append(size)
            self.said += said
            starts.append(starts[-1][-1] + np.cumsum(count))
            pairs.append(pair)
            times.append(n)
        self.sizes = np.concatenate(sizes)
        self.start, self.pair, self.times = np.concatenate(starts), np.concatenate(pairs), np.concatenate(times)

    def encoded(self, units: list[str], raw: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """For each side (ids, number of ids of each unit, whether they give it back), unit by unit."""
        a = [e.ids for e in self.a.encode_batch(units, add_special_tokens=False)]
        if self.by_units:  # behind an x the unit stands as in a text: no token crosses the cut
            b = [ids[1:] for ids in self.b.encode(["x" + u for u in units], num_threads=1)]
        else:  # the whole text: B adds the blank itself
            b = self.b.encode([u[1:] for u in units], num_threads=1)
        out = []
        for side, ids in enumerate((a, b)):
            n = np.array([len(x) for x in ids])
            flat = np.fromiter(chain.from_iterable(ids), np.int64, n.sum())
            joined = self.joined(flat, side)
            cut = np.concatenate(([0], np.cumsum(self.size[side][flat])))[np.concatenate(([0], np.cumsum(n)))].tolist()
            out.append((flat, n, np.array([joined[x:y] == u for u, x, y in zip(raw, cut, cut[1:])])))
        return out

    def encoded_in_runs(self, units: list[str], raw: list[bytes]) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]] | None:
        """The same, units that end in no white space encoded in runs, as they may stand in a text; None if bytes differ."""
        runs = ["".join(units[at: at + RUN_UNITS]) for at in range(0, len(units), RUN_UNITS)]
        a = [e.ids for e in self.a.encode_batch(runs, add_special_tokens=False)]
        b = [ids[1:] for ids in self.b.encode(["x" + r for r in runs], num_threads=1)]
        want, out = np.cumsum([len(u) for u in raw]), []
        for side, ids in enumerate((a, b)):
            flat = np.array(list(chain.from_iterable(ids)), np.int64)
            ends = np.cumsum(self.size[side][flat])
            last = np.searchsorted(ends, want, side="right")
            if not last.all() or not np.array_equal(ends[last - 1], want) or self.joined(flat, side) != b"".join(raw):
                return None
            out.append((flat, np.diff(last, prepend=0), np.ones(len(units), bool)))
        return out

    def joined(self, ids: np.ndarray, side: int) -> bytes:
        """The bytes of the tokens."""
        return self.raw[side].take(pa.array(ids)).buffers()[2].to_pybytes()[:int(self.size[side][ids].sum())] if len(ids) else b""

    def align(self, units: list[str], runs: bool) -> tuple[np.ndarray, list[str], np.ndarray, np.ndarray, np.ndarray]:
        """(sizes, groups as text, number of pairs of each unit, pairs, times): the units one behind the other, aligned at once."""
        raw = [u.encode() for u in units]
        found = (self.encoded_in_runs(units, raw) if runs else None) or self.encoded(units, raw)
        flat, counts, (good_a, good_b) = zip(*found)
        good = good_a & good_b
        a, b = (f[np.repeat(good, n)] for f, n in zip(flat, counts))
        n_a, n_b = (n * good for n in counts)
        cut_a, cut_b = common_ends(self.size[0][a], self.size[1][b])
        last = np.searchsorted(cut_a, np.cumsum(n_a), side="right")  # a unit's end is a common end
        n_groups = np.diff(last, prepend=0)
        group, pair, times = group_links(a, b, cut_a, cut_b)
        unit_of = np.repeat(np.arange(len(units)), n_groups)
        count = np.bincount(unit_of[group], minlength=len(units))
        # the groups as text: A's ids of a group, then B's, each with the mark behind it
        vocab_a, vocab_b = len(self.size[0]), len(self.size[1])
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[cut_a - 1], ends_b[cut_b - 1] = 1, 1
        group_a, group_b = np.cumsum(ends_a) - ends_a, np.cumsum(ends_b) - ends_b
        order = np.empty(len(a) + len(b), np.int64)
        before_b = np.concatenate(([0], cut_b))
        order[np.arange(len(a)) + before_b[group_a]] = a + vocab_a * ends_a
        order[np.arange(len(b)) + cut_a[group_b]] = b + 2 * vocab_a + vocab_b * ends_b
        shown = self.shown.take(pa.array(order))
        cut = np.frombuffer(shown.buffers()[1], np.int32, len(shown) + 1)[np.concatenate(([0], np.cumsum(n_a + n_b)))].tolist()
        text = (shown.buffers()[2].to_pybytes() if len(shown) else b"").decode()
        said = [text[x:max(x, y - 1)] for x, y in zip(cut, cut[1:])]
        return np.stack([n_a, n_b, n_groups, good.astype(np.int64)], axis=1), said, count, pair, times

    def numbered(self, units: list[list[str]]) -> list[np.ndarray]:
        """Numbers of the units of each text, all learnt first."""
        self.learn(set().union(*units))
        return [np.fromiter(map(self.known.__getitem__, u), np.int64, len(u)) for u in units]

    def links(self, numbers: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(text, pair, times): every distinct pair of each text, sorted by text and pair."""
        unit = np.concatenate(numbers)
        text = np.repeat(np.arange(len(numbers)), [len(x) for x in numbers])
        begin, size = self.start[unit], self.start[unit + 1] - self.start[unit]
        at = np.repeat(begin - (np.cumsum(size) - size), size) + np.arange(size.sum())
        return summed_pairs(np.repeat(text, size), self.pair[at], self.times[at])


def summed_pairs(text: np.ndarray, pair: np.ndarray, times: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Equal (text, pair) rows become one, their times summed."""
    order = np.lexsort((pair, text))
    text, pair, times = text[order], pair[order], times[order]
    first = np.flatnonzero(np.concatenate((np.ones(min(1, len(text)), bool), (text[1:] != text[:-1]) | (pair[1:] != pair[:-1]))))
    return text[first], pair[first], np.add.reduceat(times, first) if len(first) else times


def _blocks(text: str) -> Iterator[str]:
    """The space and the text in blocks that end between units."""
    text, at = " " + text, 0
    while at < len(text):
        cut = _CUT.search(text, at + BLOCK_CHARACTERS) if at + BLOCK_CHARACTERS < len(text) else None
        end = cut.start() if cut else len(text)
        yield text[at:end]
        at = end


_LOADED: dict[str, Aligner] = {}


def _loaded(files: tuple[str, bytes]) -> Aligner:
    """One aligner per worker process and pair of files."""
    key = hashlib.sha256(files[0].encode() + files[1]).hexdigest()
    if key not in _LOADED:
        _LOADED[key] = Aligner(*files)
    return _LOADED[key]


def _files(docs: DataFrame, a_path: str, b_path: str):
    with open(a_path, encoding="utf-8") as a, open(b_path, "rb") as b:
        return docs.sparkSession.sparkContext.broadcast((a.read(), b.read()))


def _long(aligner: Aligner, text: str) -> tuple[list[int], str, np.ndarray, np.ndarray]:
    """(sizes, digest, pairs, times) of one text, block by block."""
    total, digest = np.zeros(4, np.int64), hashlib.sha256()
    pair = times = np.zeros(0, np.int64)
    whole = True
    for block in _blocks(text) if aligner.by_units else [" " + text]:
        numbers = aligner.numbered([aligner.units(block)])
        sizes = aligner.sizes[numbers[0]]
        whole = whole and bool(sizes[:, 3].all())
        digest.update((";" if total[2] else "").encode() + ";".join(map(aligner.said.__getitem__, numbers[0])).encode())
        total += sizes.sum(axis=0)
        _, p, t = aligner.links(numbers)
        pair, times = np.concatenate((pair, p)), np.concatenate((times, t))
        _, pair, times = summed_pairs(np.zeros(len(pair), np.int64), pair, times)
    if not whole:
        return [0, 0, 0], "", pair[:0], times[:0]
    return total[:3].tolist(), digest.hexdigest(), pair, times


def aligned(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, n_a, n_b, n_groups, groups_sha256, pairs, times): ``pairs`` are distinct, A id * 2^32 + B id."""
    files = _files(docs, a_path, b_path)

    def rows(aligner: Aligner, texts: list[str | None]) -> list[tuple]:
        out: list[tuple | None] = [None] * len(texts)
        short = []
        for i, t in enumerate(texts):
            if not t:
                out[i] = ([0, 0, 0], "", np.zeros(0, np.int64), np.zeros(0, np.int64))
            elif len(t) > BLOCK_CHARACTERS // 4:
                out[i] = _long(aligner, t)
            else:
                short.append(i)
        if short:
            numbers = aligner.numbered([aligner.units(" " + texts[i]) for i in short])
            sizes = aligner.sizes
            text, pair, times = aligner.links(numbers)
            cut = np.searchsorted(text, np.arange(len(short) + 1))
            for k, i in enumerate(short):
                mine = sizes[numbers[k]].sum(axis=0)
                if mine[3] < len(numbers[k]):
                    out[i] = ([0, 0, 0], "", pair[:0], times[:0])
                    continue
                said = ";".join(map(aligner.said.__getitem__, numbers[k]))
                out[i] = (mine[:3].tolist(), hashlib.sha256(said.encode()).hexdigest(),
                          pair[cut[k]:cut[k + 1]], times[cut[k]:cut[k + 1]])
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _loaded(files.value)
        for whole in batches:
            for at in range(0, whole.num_rows, BATCH_ROWS):
                b = whole.slice(at, BATCH_ROWS)
                found = rows(aligner, b.column("text").to_pylist())
                ends = pa.array(np.concatenate(([0], np.cumsum([len(r[2]) for r in found]))), pa.int32())
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id"), *[pa.array([r[0][k] for r in found], pa.int64()) for k in range(3)],
                     pa.array([r[1] for r in found], pa.string()),
                     *[pa.ListArray.from_arrays(ends, pa.array(np.concatenate([r[k] for r in found]))) for k in (2, 3)]],
                    ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "pairs", "times"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(
        run, f"doc_id {id_type}, n_a bigint, n_b bigint, n_groups bigint, groups_sha256 string, pairs array<bigint>, times array<bigint>")


def groups(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """(doc_id, groups): the aligned groups of each text in order, an array of (a, b) id lists."""
    files = _files(docs, a_path, b_path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        aligner = _loaded(files.value)
        kind = pa.list_(pa.struct([("a", pa.list_(pa.int32())), ("b", pa.list_(pa.int32()))]))
        for b in batches:
            out = []
            for text in b.column("text").to_pylist():
                units = aligner.units(" " + text) if text else []
                (numbers,) = aligner.numbered([units])
                if not all(aligner.sizes[i][3] for i in numbers):
                    numbers = []
                said = [g.split("|") for i in numbers for g in aligner.said[i].split(";")]
                out.append([{"a": [int(x) for x in a.split(",")], "b": [int(x) for x in c.split(",")]} for a, c in said])
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(out, kind)], ["doc_id", "groups"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, groups array<struct<a:array<int>,b:array<int>>>")


def pair_counts(links: DataFrame) -> DataFrame:
    """(pair, n, best): documents that hold the pair linked, and whether no pair of its A id has more."""
    counts = stored(links.groupBy("pair").agg(F.count("*").alias("n")), "pair_counts")
    a = F.shiftright("pair", 32)
    highest = counts.groupBy(a.alias("a")).agg(F.max("n").alias("most"))  # a row for each entry of A's vocabulary at most
    return counts.withColumn("a", a).join(F.broadcast(highest), "a").select("pair", "n", (F.col("n") == F.col("most")).alias("best"))


def alignment_report(docs: DataFrame, a_path: str, b_path: str) -> DataFrame:
    """One row per document: doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256."""
    rows = stored(aligned(docs, a_path, b_path).withColumn("row", F.monotonically_increasing_id()), "aligned")
    links = rows.select("row", F.explode(F.arrays_zip("pairs", "times")).alias("x")) \
        .select("row", F.col("x.pairs").alias("pair"), F.col("x.times").alias("times"))
    counts = stored(pair_counts(links), "pairs")
    total = counts.agg(F.sum("n").alias("n")).first()["n"] or 0
    hot = F.col("n") * HOT_PAIRS >= total  # at most HOT_PAIRS rows

    def sums(found: DataFrame) -> DataFrame:
        return found.groupBy("row").agg(F.sum("times").alias("n_links"), F.sum(F.when(F.col("best"), F.col("times")).otherwise(0)).alias("n_best"),
                                        F.sum(F.col("times") * F.col("n")).alias("count_sum"))

    near = F.broadcast(counts.where(hot))
    rest = links.join(F.broadcast(counts.where(hot).select("pair")), "pair", "left_anti").join(counts.where(~hot), "pair")
    names = ["n_links", "n_best", "count_sum"]
    both = sums(links.join(near, "pair")).unionAll(sums(rest)).groupBy("row").agg(*[F.sum(c).alias(c) for c in names])
    return rows.drop("pairs", "times").join(both, "row", "left") \
        .select("doc_id", "n_a", "n_b", "n_groups", *[F.coalesce(c, F.lit(0)).cast("bigint").alias(c) for c in names], "groups_sha256")
