"""Repeated byte strings across a corpus: enhanced suffix arrays over the places that can repeat.

A window of ``LENGTH`` bytes has an anchor: the smallest hash of the 32-byte
strings inside it. Equal windows have equal anchors, so suffixes only need to be
compared within one anchor's group, and groups spread over the cluster by
shuffle. Consecutive windows with one anchor form a run.

1. Whole copies of a text are settled first, by digest.
2. Every text is cut into runs (anchor, content hash). Of equal runs the
   earliest stays, each window of the others starts earlier elsewhere.
3. Runs whose anchor other, different runs share (or that repeat inside
   themselves) are fetched from the texts. Per anchor group the suffixes are
   sorted (prefix doubling), neighbouring common prefixes measured, and the
   common-prefix intervals of at least LENGTH found; all occurrences of an
   interval but the earliest are removed. ``repeat_groups`` scans the whole
   interval tree with a stack and reports the groups that cannot be extended
   to the left as well.
4. An anchor with more than ``HOT_RUNS`` different runs is not held by one
   task: its windows are shuffled by a 128-bit hash of their content instead.

The texts are written once, bucketed by id, so the three joins with them move
only the small side. Defined cases: null text is empty; texts shorter than
LENGTH keep all bytes; documents count in order of id, rows without an id
first, rows that repeat an id in order of their digests; of equal rows one
stays; an empty table gives an empty result; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgewise.llm.common import shared_folder, stored

LENGTH = 100
ANCHOR = 32
HOT_RUNS = 20_000
#: Bytes that one round of suffix sorting takes.
SORT_BYTES = 1_500_000
ROWS_IN_BUCKET = 8_000

_U = np.uint64
_TABLE = np.random.default_rng(20240229).integers(0, 1 << 63, 256, dtype=np.uint64)


def _pair(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    z = x * _U(0x9E3779B97F4A7C15) + (y ^ (y >> _U(29)))
    z *= _U(0xBF58476D1CE4E5B9)
    z ^= z >> _U(32)
    return z


def _sliding(a: np.ndarray, width: int, least: bool) -> np.ndarray:
    """Minimum (or maximum) of each stretch of ``width`` values."""
    f, k = (np.minimum if least else np.maximum), 1
    while 2 * k <= width:
        a = f(a[:-k], a[k:])
        k *= 2
    return f(a[: len(a) - (width - k)], a[width - k:]) if width > k else a


def runs(texts: list[bytes], length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """Runs of all texts: (text index, first window, windows, anchor, content hash, repeats inside itself)."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
    raw = b"".join(texts)
    n = len(raw)
    width = length - ANCHOR + 1
    if n < length:
        e = np.zeros(0, np.int64)
        return e, e, e, e, e, e.astype(bool)
    h = {1: _TABLE[np.frombuffer(raw, np.uint8)]}
    for k in (1, 2, 4, 8, 16, 32, 64):
        h[2 * k] = _pair(h[k][:-k], h[k][k:]) if len(h[k]) > k else np.zeros(0, np.uint64)
    hash32 = h[ANCHOR]
    least = _sliding(hash32, width, True)  # per window
    w = n - length + 1
    valid = np.zeros(w + 1, np.int8)
    for s, size in zip(starts[sizes >= length].tolist(), sizes[sizes >= length].tolist()):
        valid[s] += 1
        valid[s + size - length + 1] -= 1
    valid = np.cumsum(valid[:w]).astype(bool)
    first = valid.copy()
    first[1:] &= (least[1:] != least[:-1]) | ~valid[:-1]
    first[starts[(sizes >= length)]] = True
    a = np.nonzero(first)[0]
    doc = np.searchsorted(starts, a, side="right") - 1
    while len(doc) and (sizes[doc] == 0).any():  # empty texts share a start with the next
        doc[sizes[doc] == 0] += 1
    last = np.minimum(np.concatenate((a[1:], [n])), starts[doc] + sizes[doc] - length + 1) - 1
    count = last - a + 1
    span = count + length - 1
    content = np.zeros(len(a), np.uint64)
    for k in (64, 128):
        mine = (span >= k) & (span < 2 * k)
        content[mine] = _pair(h[k][a[mine]], h[k][a[mine] + span[mine] - k])
    for i in np.nonzero(span >= 256)[0].tolist():
        digest = hashlib.blake2b(raw[a[i]: a[i] + span[i]], digest_size=8).digest()
        content[i] = np.frombuffer(digest, np.uint64)[0]
    content = _pair(content, span.astype(np.uint64))
    most = _sliding(np.concatenate((np.zeros(width - 1, np.uint64), np.where(valid, least, _U(0)), np.zeros(width - 1, np.uint64))), width, False)
    at = np.nonzero(hash32 == most[: len(hash32)])[0]  # the anchors' places
    again = np.zeros(len(hash32) + 1, np.int64)
    again[at[:-1][hash32[at[:-1]] == hash32[at[1:]]] + 1] = 1
    again = np.cumsum(again)
    inside = again[np.minimum(last + width, len(hash32))] - again[a] > 0
    return doc, a - starts[doc], count, least[a].view(np.int64), content.view(np.int64), inside


def suffix_ranks(pieces: list[bytes], levels: int) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """All pieces behind each other: bytes left to the piece's end, and rank arrays of 1, 2, 4 ... byte prefixes."""
    sizes = np.fromiter(map(len, pieces), np.int64, len(pieces))
    ends = np.repeat(np.cumsum(sizes), sizes)
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    left = ends - np.arange(len(raw))
    ranks = [raw.astype(np.int64) + 1]
    for j in range(levels):
        k, r = 1 << j, ranks[-1]
        ahead = np.zeros(len(r), np.int64)
        ahead[:-k] = r[k:] if len(r) > k else 0
        ahead[left <= k] = 0
        ranks.append(np.unique(r * (r.max(initial=0) + 1) + ahead, return_inverse=True)[1].astype(np.int64) + 1)
    return left, raw, ranks


def enhanced_suffix_array(pieces: list[bytes], length: int) -> tuple[np.ndarray, np.ndarray]:
    """Places whose suffix reaches ``length``, in suffix order, and each one's common prefix with the one before.

    Order and common prefixes are exact up to the piece's end or four times the length rounded up to a power of two.
    """
    levels = int(np.ceil(np.log2(length))) + 2
    left, _, ranks = suffix_ranks(pieces, levels)
    place = np.nonzero(left >= length)[0]
    place = place[np.argsort(ranks[-1][place], kind="stable")]
    common = np.zeros(len(place), np.int64)
    i, j = place[:-1].copy(), place[1:].copy()
    total = np.zeros(len(i), np.int64)
    limit = np.minimum(left[i], left[j])
    for level in range(levels, -1, -1):
        k = 1 << level
        ok = total + k <= limit
        ok[ok] = ranks[level][i[ok]] == ranks[level][j[ok]]
        total[ok] += k
        i[ok] = np.minimum(i[ok] + k, len(left) - 1)
        j[ok] = np.minimum(j[ok] + k, len(left) - 1)
    common[1:] = total
    return place, common


def interval_tree(common: np.ndarray, length: int) -> Iterator[tuple[int, int, int]]:
    """Common-prefix intervals (prefix length, first, last) of at least ``length``, by a stack scan."""
    stack: list[tuple[int, int]] = []
    for i, c in enumerate([*common[1:].tolist(), 0], start=1):
        begin = i - 1
        while stack and stack[-1][0] > c:
            depth, begin = stack.pop()
            yield depth, begin, i - 1
        if c >= length and (not stack or stack[-1][0] < c):
            stack.append((c, begin))


def repeat_groups(pieces: list[bytes], length: int = LENGTH) -> list[tuple[int, list[tuple[int, int]]]]:
    """Maximal repeats of at least ``length`` bytes: (bytes, all occurrences as (piece, offset)).

    Maximal: the occurrences differ in what goes before (or one has nothing
    before it), and no longer prefix is common to all of them.
    """
    place, common = enhanced_suffix_array(pieces, length)
    starts = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).astype(np.int64)
    raw = b"".join(pieces)
    out = []
    for depth, first, last in interval_tree(common, length):
        at = np.sort(place[first: last + 1])
        piece = np.searchsorted(starts, at, side="right") - 1
        before = {raw[p - 1] if p > starts[i] else -1 - int(p) for p, i in zip(at.tolist(), piece.tolist())}
        if len(before) > 1:
            out.append((depth, list(zip(piece.tolist(), (at - starts[piece]).tolist()))))
    return out


def later_windows(pieces: list[bytes], length: int = LENGTH) -> list[np.ndarray]:
    """Per piece, the offsets of windows that also start earlier in the order of the pieces."""
    place, common = enhanced_suffix_array(pieces, length)
    if not len(place):
        return [np.zeros(0, np.int64) for _ in pieces]
    begin = np.nonzero(common < length)[0]  # an interval goes on while neighbours share the length
    earliest = np.minimum.reduceat(place, begin)
    later = np.sort(place[place != np.repeat(earliest, np.diff(np.concatenate((begin, [len(place)]))))])
    starts = np.concatenate(([0], np.cumsum([len(p) for p in pieces])))
    cut = np.searchsorted(later, starts)
    return [later[cut[i]: cut[i + 1]] - starts[i] for i in range(len(pieces))]


def _stretches(offsets: np.ndarray, length: int) -> list[tuple[int, int]]:
    """Union of windows at sorted offsets as (start, end)."""
    if not len(offsets):
        return []
    gap = np.nonzero(np.diff(offsets) > length)[0]
    return list(zip(offsets[np.concatenate(([0], gap + 1))].tolist(), (offsets[np.concatenate((gap, [len(offsets) - 1]))] + length).tolist()))


def _bucketed(texts: DataFrame, rows: int) -> DataFrame:
    """The texts as a table bucketed by id in the shared folder.

    With fewer buckets than the session's shuffle partitions, the planner would shuffle the table again.
    """
    spark = texts.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), rows // ROWS_IN_BUCKET)
    name = f"edgewise_texts_{uuid.uuid4().hex}"
    path = f"{shared_folder(spark)}/{name}"
    texts.repartition(n, "id").write.bucketBy(n, "id").option("path", path).saveAsTable(name)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.table(name)


def _numbered(docs: DataFrame) -> DataFrame:
    """(id, doc_id, text): ids in document order, the doc_id itself where it is unique."""
    rows = docs.select("doc_id", F.coalesce(F.col("text"), F.lit("")).alias("text"))
    odd = rows.groupBy("doc_id").agg(F.count("*").alias("n")).where((F.col("n") > 1) | F.col("doc_id").isNull())
    if odd.isEmpty():
        return rows.select(F.col("doc_id").cast("bigint").alias("id"), "doc_id", "text")
    order = [F.col("doc_id").asc_nulls_first(), F.md5("text")]
    return rows.repartitionByRange(*order).sortWithinPartitions(*order) \
        .select(F.monotonically_increasing_id().alias("id"), "doc_id", "text")


def removal_report(docs: DataFrame, length: int = LENGTH, hot_runs: int = HOT_RUNS) -> DataFrame:
    """One row per document row: doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans (start, end of removed bytes)."""
    texts = _bucketed(_numbered(docs), docs.count())
    marks, copies = _marks(texts, length, hot_runs)
    spans = marks.groupBy("id").agg(F.collect_list(F.struct("start", "end")).alias("marks"))
    rows = texts.join(spans, "id", "left").join(copies.withColumn("copy", F.lit(True)), "id", "left")

    def report(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for text, found, copy in zip(b.column("text"), b.column("marks").to_pylist(), b.column("copy").to_pylist()):
                raw = text.as_py().encode()
                cut: list[list[int]] = []
                if copy and len(raw) >= length:
                    cut = [[0, len(raw)]]
                for start, end in sorted((m["start"], m["end"]) for m in found or []):
                    if cut and start <= cut[-1][1]:
                        cut[-1][1] = max(cut[-1][1], end)
                    else:
                        cut.append([start, end])
                kept, at = [], 0
                for start, end in cut:
                    kept.append(raw[at:start])
                    at = end
                kept.append(raw[at:])
                out.append((len(raw), sum(e - s for s, e in cut), len(cut), hashlib.sha256(b"".join(kept)).hexdigest(),
                            [{"start": s, "end": e} for s, e in cut]))
            n, removed, spans_, digest, cuts = zip(*out) if out else ((), (), (), (), ())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(spans_, pa.int64()),
                 pa.array(digest, pa.string()), pa.array(cuts, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())])))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return rows.select("doc_id", "text", "marks", "copy").mapInArrow(
        report, f"doc_id {id_type}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string, "
                "spans array<struct<start:int,end:int>>")


def _marks(texts: DataFrame, length: int, hot_runs: int) -> tuple[DataFrame, DataFrame]:
    """Removed stretches (id, start, end) of first copies, and the ids of later copies."""
    digests = stored(texts.select("id", F.md5("text").alias("digest")), "digests")
    firsts = digests.groupBy("digest").agg(F.min("id").alias("first"), F.count("*").alias("n")).where(F.col("n") > 1)
    copies = stored(digests.join(firsts, "digest").where(F.col("id") > F.col("first")).select("id"), "copies")
    own = texts.join(copies, "id", "left_anti")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, held, size, first = b.column("id").to_numpy(), [], 0, 0
            for i, t in enumerate(b.column("text")):
                held.append(t.as_py().encode())
                size += len(held[-1])
                if size > 1_000_000 or i + 1 == b.num_rows:
                    doc, a, n, anchor, content, inside = runs(held, length)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(ids[first:][doc]), pa.array(a.astype(np.int32)), pa.array(n.astype(np.int32)),
                         pa.array(anchor.astype(np.int64)), pa.array(content.astype(np.int64)), pa.array(inside)],
                        ["id", "a", "n", "anchor", "content", "inside"])
                    held, size, first = [], 0, i + 1

    found = own.select("id", "text").mapInArrow(cut, "id bigint, a int, n int, anchor bigint, content bigint, inside boolean")
    group = Window.partitionBy("anchor", "content").orderBy("id", "a")
    anchor = Window.partitionBy("anchor")
    ranked = found.repartition("anchor").withColumn("place", F.row_number().over(group)) \
        .withColumn("kinds", F.sum(F.when(F.col("place") == 1, 1).otherwise(0)).over(anchor)) \
        .where((F.col("place") > 1) | (F.col("kinds") > 1) | F.col("inside"))
    ranked = stored(ranked.select("id", "a", "n", "anchor", "place", "kinds"), "runs")
    later = ranked.where(F.col("place") > 1).select(
        "id", F.col("a").alias("start"), (F.col("a") + F.col("n") + (length - 1)).alias("end"))
    open_ = ranked.where(F.col("place") == 1)
    lists = open_.groupBy("id").agg(F.collect_list(F.struct("a", "n", "anchor", "kinds")).alias("runs"))
    fetched = texts.join(lists, "id")
    cold = _cold(fetched, length, hot_runs)
    marks = later.unionAll(cold)
    if not open_.where(F.col("kinds") > hot_runs).isEmpty():
        marks = marks.unionAll(_hot(fetched, length, hot_runs))
    return marks, copies


def _cold(fetched: DataFrame, length: int, hot_runs: int) -> DataFrame:
    """Removed stretches by suffix sorting, anchor group by anchor group."""
    def fetch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            anchors, ids, starts, pieces = [], [], [], []
            for i, text, mine in zip(b.column("id").to_pylist(), b.column("text"), b.column("runs").to_pylist()):
                raw = text.as_py().encode()
                for r in mine:
                    if r["kinds"] <= hot_runs:
                        anchors.append(r["anchor"])
                        ids.append(i)
                        starts.append(r["a"])
                        pieces.append(raw[r["a"]: r["a"] + r["n"] + length - 1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(anchors, pa.int64()), pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(pieces, pa.binary())],
                ["anchor", "id", "a", "piece"])

    def sort(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        size = 0

        def marks() -> pa.RecordBatch:
            ids, start, end = [], [], []
            for (i, a, _), offsets in zip(held, later_windows([p for _, _, p in held], length)):
                for s, e in _stretches(offsets, length):
                    ids.append(i)
                    start.append(a + s)
                    end.append(a + e)
            return pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(start, pa.int32()), pa.array(end, pa.int32())], ["id", "start", "end"])

        now = None
        for b in batches:
            for anchor, i, a, piece in zip(*(b.column(c).to_pylist() for c in ("anchor", "id", "a", "piece"))):
                if anchor != now and size > SORT_BYTES:
                    yield marks()
                    held, size = [], 0
                now = anchor
                held.append((i, a, piece))
                size += len(piece)
        if held:
            yield marks()

    pieces = fetched.select("id", "text", "runs").mapInArrow(fetch, "anchor bigint, id bigint, a int, piece binary")
    return pieces.repartition("anchor").sortWithinPartitions("anchor", "id", "a") \
        .mapInArrow(sort, "id bigint, start int, end int")


def _hot(fetched: DataFrame, length: int, hot_runs: int) -> DataFrame:
    """The same for anchors with very many runs: windows grouped by their content's hash."""
    def windows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_128_digest

        for b in batches:
            ids, starts, keys = [], [], []
            for i, text, mine in zip(b.column("id").to_pylist(), b.column("text"), b.column("runs").to_pylist()):
                raw = text.as_py().encode()
                for r in mine:
                    if r["kinds"] > hot_runs:
                        for s in range(r["a"], r["a"] + r["n"]):
                            ids.append(i)
                            starts.append(s)
                            keys.append(xxh3_128_digest(raw[s: s + length]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(ids, pa.int64()), pa.array(starts, pa.int32()), pa.array(keys, pa.binary())], ["id", "start", "window"])

    rows = stored(fetched.select("id", "text", "runs").mapInArrow(windows, "id bigint, start int, window binary"), "windows")
    here: Column = F.struct("id", "start")
    first = rows.groupBy("window").agg(F.min(here).alias("first"), F.count("*").alias("n")).where(F.col("n") > 1)
    return rows.join(first, "window").where(here != F.col("first")) \
        .select("id", "start", (F.col("start") + length).alias("end"))
