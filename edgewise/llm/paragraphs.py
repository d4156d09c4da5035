"""Substring dedup by MinHash banding of paragraphs.

A paragraph is a line, or a part of a long line: sentences are grouped up to
the next one whose hash is a local minimum. Two copies of a passage inside
longer lines often hold no whole part in common, so lines of ``PASSAGE_WORDS``
and more have a second kind of unit: ``UNIT_WORDS`` words from each place whose
hash is the least of any ``PASSAGE_WORDS - UNIT_WORDS + 1`` places in a row.
Every run of ``PASSAGE_WORDS`` words holds such a place with its whole unit,
whatever stands before or after it and with or without sentence ends. These
overlapping units are settled by equality alone: one changed word moves a unit
of this size below the threshold anyway. Every paragraph that holds a word takes part; words are
what ASCII blanks part, as in the normalised text. One of fewer than
``SHINGLE`` words is a single shingle, its whole text, so it is alike to its
exact copies only and forms no bands.

Bands are tuned for recall: as few as give ``RECALL`` at the threshold.
Paragraphs that share a band are compared by the exact Jaccard similarity of
their sets of five-word shingles. A bucket is not paired out: its members are
compared with its smallest and its largest member. Where the bucket still holds
several components, each member is filed under its rarest shingles, as many as
leave too few for the threshold without them. Members of different components that
share such a shingle are compared with the least of them, and those that it
leaves with all others of a size within the threshold, so no link is lost. Components of verified links are the classes; of each class the
first paragraph in the corpus is its head.

What is cut: of each document the paragraphs that are not heads, where a run of
them, one behind the other, has ``CUT_WORDS`` words together. A short line that
many texts share alone is reported and stays. Passage units are settled after
that: the first place outside cut paragraphs stays, the others are cut, so no
passage loses its last copy with a paragraph that goes.

Equal paragraphs are one point from the start, so a line that a large part of
the texts share costs one point in the joins. Defined cases: null or blank
texts have no paragraphs; rows that repeat id and text count as one document
and are reported each; rows without an id come first; an empty table gives an
empty result; further columns are ignored by the report, kept by
``without_repeats`` whatever their names. A text may have any length: its paragraphs
are rows, and only the spans to cut are gathered per document. Units that make up 1 in
``HOT_UNITS`` of all places (at most ``HOT_UNITS`` units) are joined by broadcast.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgewise.llm.common import fresh, row_key, stored
from edgewise.llm.components import connected_components

SHINGLE = 5
THRESHOLD = 0.8
RECALL = 0.99
BAND_ROWS = 2
#: Words of the shortest paragraph.
MIN_WORDS = 1
#: Equal runs of so many words inside lines are always found, by units of so many words.
PASSAGE_WORDS = 50
UNIT_WORDS = 25
#: Shorter sentences are taken together with the next.
SENTENCE_WORDS = 4
#: A run of later paragraphs is cut from so many words on.
CUT_WORDS = 25
HOT_UNITS = 10_000
#: Text that one round of numpy work takes.
BATCH_CHARS = 1_000_000

_END = re.compile(r"[.!?]+[ \t]+")
_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_U = np.uint64


def tuned_bands(threshold: float = THRESHOLD, recall: float = RECALL, rows: int = BAND_ROWS) -> int:
    """The fewest bands of ``rows`` hashes that pair texts at the threshold with probability ``recall``."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold ** rows)))


def paragraphs(text: str) -> list[tuple[int, int]]:
    """(start, end) of each paragraph in code points."""
    from xxhash import xxh64_intdigest

    out, at = [], 0
    for line in text.split("\n"):
        cuts, begin = [0], 0
        for m in _END.finditer(line):
            if line.count(" ", begin, m.end()) >= SENTENCE_WORDS:
                cuts.append(m.end())
                begin = m.end()
        cuts.append(len(line))
        if len(cuts) > 3:
            h = [xxh64_intdigest(_normal(line[a:b])) for a, b in zip(cuts, cuts[1:])]
            cuts = [0, *[cuts[i] for i in range(1, len(h) - 1) if h[i - 1] > h[i] < h[i + 1]], len(line)]
        for a, b in zip(cuts, cuts[1:]):
            if len(_normal(line[a:b]).split()) >= MIN_WORDS:
                out.append((at + a, at + b))
        at += len(line) + 1
    return out


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _U(31))) * _U(0x9E3779B97F4A7C15)
    return x ^ (x >> _U(29))


def shingle_arrays(units: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all units' five-word shingles behind each other, and how many each unit has."""
    from xxhash import xxh64_intdigest

    words = [u.split() for u in units]
    n = np.fromiter(map(len, words), np.int64, len(words))
    h = np.array([xxh64_intdigest(w) for ws in words for w in ws], np.uint64)
    count = np.maximum(n - SHINGLE + 1, 0)
    s = h[: max(0, len(h) - SHINGLE + 1)].copy()
    for i in range(1, SHINGLE):
        s = _mixed(s) + h[i: i + len(s)]
    s = _mixed(s)
    begin = np.concatenate(([0], np.cumsum(n)[:-1])).astype(np.int64)
    keep = np.ones(len(h) + 1, np.int64)
    inside = np.zeros(len(h) + 1, np.int64)
    np.add.at(inside, begin[count > 0], 1)
    np.add.at(inside, (begin + count)[count > 0], -1)
    keep = np.cumsum(inside)[: len(s)] > 0
    return s[keep], count


def signatures(units: list[bytes], bands: int, rows: int = BAND_ROWS) -> np.ndarray:
    """Band hashes, one line per unit; every unit must have a five-word shingle."""
    if not units:
        return np.zeros((0, bands), np.uint64)
    s, count = shingle_arrays(units)
    begin = np.concatenate(([0], np.cumsum(count)[:-1])).astype(np.int64)
    odd = np.random.default_rng(8).integers(1, 1 << 63, bands * rows, dtype=np.uint64) | _U(1)
    least = np.stack([np.minimum.reduceat(_mixed(s * k), begin) for k in odd], axis=1)
    out = np.zeros((len(units), bands), np.uint64)
    for b in range(bands):
        h = np.full(len(units), b + 1, np.uint64)
        for r in range(rows):
            h = _mixed(h * _U(31)) + least[:, b * rows + r]
        out[:, b] = _mixed(h)
    return out


def _normal(text: str) -> bytes:
    return b" ".join(text.encode().translate(_LOWER).split())


def paragraph_units(docs: DataFrame, bands: int) -> DataFrame:
    """(doc_id, key, place, words, start, stop, unit, bands) of every paragraph; ``unit`` names its normalised text.

    Paragraphs without a five-word shingle have no bands.
    """
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from xxhash import xxh3_64_intdigest

        for b in batches:
            who, place, start, stop, units, size = [], [], [], [], [], 0
            for i, t in enumerate(b.column("text")):
                text = t.as_py() or ""
                for at, (a, e) in enumerate(paragraphs(text)):
                    who.append(i)
                    place.append(at)
                    start.append(a)
                    stop.append(e)
                    units.append(_normal(text[a:e]))
                size += len(text)
                if units and (size > BATCH_CHARS or i + 1 == b.num_rows):
                    long = np.array([u.count(b" ") >= SHINGLE - 1 for u in units])
                    sig = signatures([u for u, x in zip(units, long) if x], bands).view(np.int64)
                    ends = np.concatenate(([0], np.cumsum(long * bands))).astype(np.int32)
                    take = pa.array(who, pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(take), b.column("key").take(take), pa.array(place, pa.int32()),
                         pa.array([u.count(b" ") + 1 for u in units], pa.int32()), pa.array(start, pa.int32()),
                         pa.array(stop, pa.int32()),
                         pa.array(np.array([xxh3_64_intdigest(u) for u in units], np.uint64).view(np.int64)),
                         pa.ListArray.from_arrays(pa.array(ends), pa.array(sig.ravel()))],
                        ["doc_id", "key", "place", "words", "start", "stop", "unit", "bands"])
                    who, place, start, stop, units, size = [], [], [], [], [], 0

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text").mapInArrow(
        run, f"doc_id {id_type}, key bigint, place int, words int, start int, stop int, unit bigint, bands array<bigint>")


def _sliding(least, x: np.ndarray, width: int) -> np.ndarray:
    """The least (or most, as the ufunc says) of every ``width`` numbers in a row."""
    n, k = len(x) - width + 1, 1
    while 2 * k <= width:
        x = least(x[:-k], x[k:])
        k *= 2
    return least(x[:n], x[width - k: width - k + n])


def passages(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(text, start, stop, unit) of the passage units: index of the text, code points in it, hash of the words."""
    from xxhash import xxh64_intdigest

    low = "\n".join(texts).encode().translate(_LOWER)
    raw = np.frombuffer(low, np.uint8)
    word = np.concatenate(([0], ~np.isin(raw, np.frombuffer(b" \t\n\r\x0b\x0c", np.uint8)), [0])).astype(np.int8)
    begin, end = np.nonzero(np.diff(word) == 1)[0], np.nonzero(np.diff(word) == -1)[0]
    n, width = len(begin), PASSAGE_WORDS - UNIT_WORDS + 1
    if n < PASSAGE_WORDS:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    h = np.array([xxh64_intdigest(w) for w in low.split()], np.uint64)
    line = np.cumsum(raw == 10)[begin]
    pair = _mixed(_mixed(h[:-1]) + h[1:])
    inside = (line[:n - width] == line[width:]) & (np.bincount(line)[line] >= PASSAGE_WORDS)[:n - width]
    least = np.where(inside, _sliding(np.minimum, pair, width), _U(0))
    edge = np.zeros(width - 1, np.uint64)
    chosen = (_sliding(np.maximum, np.concatenate((edge, least, edge)), width) == pair) & (pair > 0)
    at = np.nonzero(chosen[:n - UNIT_WORDS + 1])[0]
    at = at[line[at] == line[at + UNIT_WORDS - 1]]
    unit = h[at]
    for i in range(1, UNIT_WORDS):
        unit = _mixed(unit) + h[at + i]
    point = np.concatenate(([0], np.cumsum((raw & 0xC0) != 0x80)))
    first = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))
    start = point[begin[at]]
    who = np.searchsorted(first, start, side="right") - 1
    return who, start - first[who], point[end[at + UNIT_WORDS - 1]] - first[who], _mixed(unit)


def passage_units(docs: DataFrame) -> DataFrame:
    """(doc_id, key, start, stop, unit) of every passage unit."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, size, first = [], 0, 0
            for i, t in enumerate(b.column("text")):
                held.append(t.as_py() or "")
                size += len(held[-1])
                if size > BATCH_CHARS or i + 1 == b.num_rows:
                    who, start, stop, unit = passages(held)
                    take = pa.array(who + first)
                    yield pa.RecordBatch.from_arrays(
                        [b.column("doc_id").take(take), b.column("key").take(take), pa.array(start.astype(np.int32)),
                         pa.array(stop.astype(np.int32)), pa.array(unit.view(np.int64))],
                        ["doc_id", "key", "start", "stop", "unit"])
                    held, size, first = [], 0, i + 1

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text").mapInArrow(
        run, f"doc_id {id_type}, key bigint, start int, stop int, unit bigint")


def _at_places(places: DataFrame, named: DataFrame, total: int) -> DataFrame:
    """``places`` joined with ``named`` (unit, n, ...) by unit; a unit of very many places, by broadcast."""
    hot = F.col("n") * HOT_UNITS >= total
    near = F.broadcast(named.where(hot))
    return places.join(near, "unit").unionByName(
        places.join(F.broadcast(named.where(hot).select("unit")), "unit", "left_anti").join(named.where(~hot), "unit"))


def passage_repeats(docs: DataFrame, cut: DataFrame | None = None) -> DataFrame:
    """(doc_id, key, start, stop, class_doc_id, gone): passage units with another place in the corpus that stays.

    ``cut``: (d, k, spans) of text that goes anyway. The first place outside it is a unit's head; without
    such a place nothing of the unit is ``gone``. A unit that overlaps its head, as in a text of one repeated
    word, is left.
    """
    units = stored(passage_units(docs), "passages")
    total = units.count()
    again = units.groupBy("unit").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    units = stored(_at_places(units, again, total), "repeated_passages")
    inside = F.lit(False)
    if cut is not None:
        units = units.join(cut, units["doc_id"].eqNullSafe(F.col("d")) & (units["key"] == F.col("k")), "left")
        inside = F.coalesce(F.exists("spans", lambda x: (x["start"] < F.col("stop")) & (F.col("start") < x["stop"])), F.lit(False))
    units = units.select("doc_id", "key", "start", "stop", "unit", "n", inside.alias("inside"))
    heads = units.groupBy("unit", "n").agg(F.min(F.struct("inside", "doc_id", "key", "start", "stop")).alias("head"))
    own = F.col("doc_id").eqNullSafe(F.col("head.doc_id")) & (F.col("key") == F.col("head.key")) \
        & (F.col("start") < F.col("head.stop")) & (F.col("head.start") < F.col("stop"))
    return _at_places(units.drop("n"), heads, total).where(~own) \
        .select("doc_id", "key", "start", "stop", F.col("head.doc_id").alias("class_doc_id"), (~F.col("head.inside")).alias("gone"))


def _shingle_sets(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """(unit, set) of the paragraphs at (doc_id, key, start, stop, unit)."""
    lists = wanted.groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")) \
        .agg(F.collect_list(F.struct("start", "stop", "unit")).alias("units"))
    texts = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    both = texts.join(lists, texts["doc_id"].eqNullSafe(F.col("d")) & (texts["key"] == F.col("k"))).select("text", "units")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for text, mine in zip(b.column("text"), b.column("units").to_pylist()):
                t = text.as_py()
                s, count = shingle_arrays([_normal(t[m["start"]: m["stop"]]) for m in mine])
                sets = [np.unique(x) for x in np.split(s, np.cumsum(count)[:-1])]
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m["unit"] for m in mine], pa.int64()),
                     pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum([len(x) for x in sets]))).astype(np.int32)),
                                              pa.array(np.concatenate(sets).view(np.int64)))], ["unit", "set"])

    return both.mapInArrow(run, "unit bigint, set array<bigint>").dropDuplicates(["unit"])


def _verified(pairs: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """The pairs (a, b) whose sets have at least the Jaccard similarity."""
    x = sets.select(F.col("unit").alias("a"), F.col("set").alias("sa"))
    y = sets.select(F.col("unit").alias("b"), F.col("set").alias("sb"))
    shorter, longer = F.least(F.size("sa"), F.size("sb")), F.greatest(F.size("sa"), F.size("sb"))
    common = F.size(F.array_intersect("sa", "sb"))
    return pairs.join(x, "a").join(y, "b").where(shorter >= threshold * longer) \
        .where(common >= threshold * (F.size("sa") + F.size("sb") - common)).select("a", "b")


def _open_members(members: DataFrame, linked: DataFrame) -> DataFrame:
    """(unit, h, c) of the buckets that hold more than one component."""
    bucket = Window.partitionBy("h")
    labelled = members.join(linked, F.col("unit") == F.col("node"), "left") \
        .select("unit", "h", F.coalesce("component", "unit").alias("c")).repartition("h") \
        .withColumn("low", F.min("c").over(bucket)).withColumn("high", F.max("c").over(bucket))
    return stored(labelled.where(F.col("low") != F.col("high")).select("unit", "h", "c"), "open_buckets")


def _rare_shingles(units: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """(unit, size, at, g): of each set the rarest shingles, in order; sets alike to the threshold share one of them.

    Of n shingles, n - ceil(t * n) + 1: two sets that share none of these, in one order of all shingles,
    share too few of the rest.
    """
    all_ = sets.join(units.select("unit").distinct(), "unit").select("unit", F.size("set").alias("size"), F.explode("set").alias("g"))
    often = all_.groupBy("g").agg(F.count("*").alias("often"))
    order = F.array_sort(F.collect_list(F.struct("often", "g")))
    kept = (F.col("size") - F.ceil(F.lit(threshold) * F.col("size") - 1e-9) + 1).cast("int")
    return all_.join(often, "g").groupBy("unit", "size").agg(order.alias("o")) \
        .select("unit", "size", F.posexplode(F.slice("o", F.lit(1), kept)).alias("at", "x")).select("unit", "size", "at", "x.g")


def _across_components(labelled: DataFrame, sets: DataFrame, threshold: float) -> DataFrame:
    """Links (a, b) between different components of a bucket, as many as join all components that any link joins.

    Members that share a rare shingle are first compared with the least of them. Of those alike to it
    none is compared with another: they are in one component by now. The others are compared with all
    members that are alike in size.

    Where the first shingle that two sets share stands at ``at`` in both orders, no more than the rest of
    either can be shared besides: places that leave too few are no evidence.
    """
    filed = labelled.join(_rare_shingles(labelled, sets, threshold), "unit")
    mixed = filed.groupBy("h", "g").agg(F.min(F.struct("c", "unit")).alias("center"), F.max("c").alias("high")) \
        .where(F.col("center.c") != F.col("high")).select("h", "g", "center")
    filed = stored(filed.join(mixed, ["h", "g"]), "filed")
    own = F.col("c") == F.col("center.c")
    stars = stored(_verified(filed.where(~own).select(F.col("unit").alias("a"), F.col("center.unit").alias("b")).distinct(), sets, threshold), "links")
    known = stars.select(F.col("a").alias("unit"), F.col("b").alias("star"), F.lit(True).alias("alike"))
    filed = stored(filed.withColumn("star", F.col("center.unit")).join(known, ["unit", "star"], "left")
                   .select("h", "g", "unit", "c", "size", "at", (own | F.coalesce("alike", F.lit(False))).alias("settled")), "filed")
    # x are the members that the center left; a pair of two such members is formed once
    x = filed.where(~F.col("settled")).select("h", "g", F.col("unit").alias("a"), F.col("c").alias("ca"), F.col("size").alias("na"), F.col("at").alias("ia"))
    y = filed.select("h", "g", F.col("unit").alias("b"), F.col("c").alias("cb"), F.col("size").alias("nb"), F.col("at").alias("ib"), "settled")
    enough = F.least(F.col("na") - F.col("ia"), F.col("nb") - F.col("ib")) >= threshold / (1 + threshold) * (F.col("na") + F.col("nb")) - 1e-9
    near = (F.col("na") >= threshold * F.col("nb")) & (F.col("nb") >= threshold * F.col("na"))
    once = F.when(F.col("settled"), F.col("ca") != F.col("cb")).otherwise(F.col("ca") < F.col("cb"))
    pairs = x.join(y, ["h", "g"]).where(once & near & enough) \
        .select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
    return stars.unionAll(_verified(pairs, sets, threshold))


def paragraph_classes(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """(doc_id, key, place, words, start, stop, class_doc_id, class_key, class_start): paragraphs of classes with two or more.

    The class is named by its first paragraph in the corpus.
    """
    units = stored(paragraph_units(docs, tuned_bands(threshold, recall)), "paragraphs")
    where = F.struct("doc_id", "key", "start", "stop")
    points = stored(units.groupBy("unit").agg(F.min(where).alias("first"), F.count("*").alias("n"),
                                              F.first("bands").alias("bands")), "points")
    bucket = Window.partitionBy("h")
    members = points.select("unit", F.explode("bands").alias("h")).repartition("h") \
        .select("unit", "h", F.min("unit").over(bucket).alias("low"), F.max("unit").over(bucket).alias("high")) \
        .where(F.col("low") != F.col("high"))
    members = stored(members, "buckets")
    wanted = members.select("unit").distinct().join(points, "unit").select("first.*", "unit")
    sets = stored(_shingle_sets(docs, wanted), "shingle_sets")
    unit = F.col("unit")
    stars = members.where(unit != F.col("low")).select(unit.alias("a"), F.col("low").alias("b")) \
        .unionAll(members.where((unit != F.col("low")) & (unit != F.col("high")))
                  .select(unit.alias("a"), F.col("high").alias("b"))).distinct()
    links = stored(_verified(stars, sets, threshold), "links")
    linked = stored(connected_components(links), "components")
    more = stored(_across_components(_open_members(members, linked), sets, threshold), "links")
    if not more.isEmpty():
        known = linked.select(F.col("node").alias("a"), F.col("component").alias("b"))
        linked = stored(connected_components(known.unionAll(more)), "components")
    named = points.join(linked, unit == F.col("node"), "left") \
        .select("unit", "n", "first", F.coalesce("component", "unit").alias("component"), F.col("node").isNotNull().alias("linked")) \
        .where((F.col("n") > 1) | F.col("linked"))
    named = stored(named, "named")
    heads = named.groupBy("component").agg(F.min("first").alias("head"))
    classes = named.join(heads, "component").select("unit", "n", "head")
    places = units.select("doc_id", "key", "place", "words", "start", "stop", "unit")
    return stored(_at_places(places, classes, units.count()).select(
        "doc_id", "key", "place", "words", "start", "stop", F.col("head.doc_id").alias("class_doc_id"),
        F.col("head.key").alias("class_key"), F.col("head.start").alias("class_start")), "classes")


def _later() -> Column:
    """Whether a row of ``paragraph_classes`` is not its class's head."""
    return ~(F.col("doc_id").eqNullSafe(F.col("class_doc_id")) & (F.col("key") == F.col("class_key"))
             & (F.col("start") == F.col("class_start")))


def cut_paragraphs(classes: DataFrame, cut_words: int = CUT_WORDS) -> DataFrame:
    """(d, k, spans): per document the later paragraphs in runs of ``cut_words`` words and more."""
    doc = Window.partitionBy("doc_id", "key")
    run = Window.partitionBy("doc_id", "key", "run")
    later = classes.where(_later()).select("doc_id", "key", "place", "words", "start", "stop").distinct()
    return later.withColumn("run", F.col("place") - F.row_number().over(doc.orderBy("place"))) \
        .withColumn("together", F.sum("words").over(run)).where(F.col("together") >= cut_words) \
        .groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(F.array_sort(F.collect_list(F.struct("start", "stop"))).alias("spans"))


def _merged(spans: Column) -> Column:
    """Sorted spans with those that overlap made one."""
    def add(done: Column, x: Column) -> Column:
        last = F.try_element_at(done, F.lit(-1))
        longer = F.struct(last["start"].alias("start"), F.greatest(last["stop"], x["stop"]).alias("stop"))
        return F.when(F.coalesce(last["stop"] > x["start"], F.lit(False)),
                      F.concat(F.slice(done, 1, F.size(done) - 1), F.array(longer))).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(spans, F.array().cast("array<struct<start:int,stop:int>>"), add)


def _removed(docs: DataFrame, threshold: float, recall: float) -> DataFrame:
    """(d, k, n_members, n_removed, n_passages, cut, class_doc_ids): per document its paragraphs in classes and what goes.

    ``cut`` is the union of the paragraphs and passage units that go.
    """
    classes = paragraph_classes(docs, threshold, recall)
    cut = stored(cut_paragraphs(classes), "cut_paragraphs")
    repeats = passage_repeats(docs, cut)
    span = F.struct("start", "stop")
    no_span = F.lit(None).cast("struct<start:int,stop:int>")
    rows = classes.select("doc_id", "key", "start", F.when(_later(), F.col("class_doc_id")).alias("of"), _later().alias("later"),
                          F.lit(True).alias("whole"), no_span.alias("gone")) \
        .unionAll(repeats.select("doc_id", "key", "start", "class_doc_id", F.lit(True), F.lit(False), F.when(F.col("gone"), span))) \
        .unionAll(cut.select(F.col("d"), F.col("k"), F.explode("spans").alias("s"))
                  .select("d", "k", "s.start", F.lit(None), F.lit(None), F.lit(None), "s"))
    later, whole = F.col("later"), F.col("whole")
    return rows.groupBy(F.col("doc_id").alias("d"), F.col("key").alias("k")).agg(
        F.countDistinct(F.when(whole, F.col("start"))).alias("n_members"),
        F.countDistinct(F.when(whole & later, F.col("start"))).alias("n_removed"),
        F.countDistinct(F.when(~whole, F.col("start"))).alias("n_passages"),
        F.array_sort(F.collect_set("gone")).alias("gone"), F.array_sort(F.collect_set("of")).alias("class_doc_ids")) \
        .select("d", "k", "n_members", "n_removed", "n_passages", _merged(F.col("gone")).alias("cut"), "class_doc_ids")


def repeat_report(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """One row per document row: doc_id, n_members, n_removed, n_passages, n_chars_removed, spans, class_doc_ids.

    ``n_members`` paragraphs belong to a class of two or more, ``n_removed`` of
    them are not its first; ``n_passages`` passage units have their head elsewhere;
    ``class_doc_ids`` hold the first ones. ``spans`` are the union of what is cut.
    """
    found = _removed(docs, threshold, recall)
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    zero = F.lit(0).cast("bigint")
    chars = F.aggregate("cut", zero, lambda a, x: a + (x["stop"] - x["start"]))
    id_array = f"array<{docs.schema['doc_id'].dataType.simpleString()}>"
    return rows.join(found, rows["doc_id"].eqNullSafe(F.col("d")) & (rows["key"] == F.col("k")), "left").select(
        "doc_id", F.coalesce("n_members", zero).alias("n_members"),
        F.coalesce("n_removed", zero).alias("n_removed"), F.coalesce("n_passages", zero).alias("n_passages"),
        F.coalesce(chars, zero).alias("n_chars_removed"),
        F.coalesce(F.array_join(F.transform("cut", lambda x: F.concat_ws(":", x["start"].cast("string"), x["stop"].cast("string"))), ","),
                   F.lit("")).alias("spans"),
        F.coalesce("class_doc_ids", F.array().cast(id_array)).alias("class_doc_ids"))


def without_repeats(docs: DataFrame, threshold: float = THRESHOLD, recall: float = RECALL) -> DataFrame:
    """All documents and columns, what ``repeat_report`` names as cut taken out of the text."""
    k, d, h, c = (fresh(docs, n) for n in ("ew_key", "ew_d", "ew_k", "ew_cut"))
    found = _removed(docs, threshold, recall).select(F.col("d").alias(d), F.col("k").alias(h), F.col("cut").alias(c))
    keyed = docs.withColumn(k, row_key(F.col("doc_id"), F.col("text")))
    both = keyed.join(found, keyed["doc_id"].eqNullSafe(F.col(d)) & (keyed[k] == F.col(h)), "left")
    step = F.aggregate(c, F.struct(F.lit("").alias("out"), F.lit(0).alias("at")), lambda acc, x: F.struct(
        F.concat(acc["out"], F.substring(F.col("text"), acc["at"] + 1, x["start"] - acc["at"])).alias("out"), x["stop"].alias("at")))
    cut = F.concat(step["out"], F.substring(F.col("text"), step["at"] + 1, F.lit(2147483647)))
    both = both.withColumn("text", F.when(F.col(c).isNull(), F.col("text")).otherwise(cut))
    return both.select(*[F.col(f"`{x}`") for x in docs.columns])
