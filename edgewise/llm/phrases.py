"""Phrase collocations by multikey three-way quicksort of suffix pointers.

A suffix pointer is a word position with the words that follow it in its
piece, up to the longest phrase. Tasks cut the texts and combine pointers with
equal words into one weighted pointer, so that a passage repeated in a task
travels once. Pointers are then routed over the cluster by their language and
leading two words (words are counted in a pass of their own before), and each task sorts its pointers by word, depth after depth:
a segment is parted around a pivot word into smaller, equal and greater ones,
and the equal part goes one word deeper. The weight of an equal part is the
count of its phrase; a part that weighs less than the least count is abandoned
whole, whatever it holds. All segments of a round are parted together, with
array operations.

Skew: words that make up at least 1 in ``HOT_WORDS`` of all words are hot, at
most ``HOT_WORDS`` of them at any size. Pointers that begin with two hot words
are routed by three words, and their pairs are summed over the
tasks; longer ones are whole in a task and abandoned there if rare. A task sorts ``SORTED_POINTERS`` at a time, in order of their routes; a
route that is cut by that bound abandons nothing, and its parts are summed too.
Counts of hot words are broadcast to the candidates, all other counts are
joined by shuffle.

Defined cases: null text counts as empty; a null language is ``und``; words of
any length and pieces of any length count whole (texts are worked off in slices
that end between words and look ahead to the words that a pointer needs);
repeated rows count each; ties in rank go by count, then by the phrase's bytes;
an empty table gives an empty report; further columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgewise.llm.common import stored

LEAST = 10
LONGEST = 3
TOP = 2000
#: A phrase goes when a longer candidate around it has at least so many per cent of its count.
COVERED_PERCENT = 50
UNKNOWN = "und"
#: A word with at least 1 in so many of all occurrences is hot.
HOT_WORDS = 1000
#: Bytes of text that a task cuts into words at a time, and pointers that it sorts at a time.
SLICE_BYTES = 4_000_000
SORTED_POINTERS = 400_000

_LOWER = bytes(b + 32 if 65 <= b <= 90 else 32 if b == 9 else 10 if b in b".,;:!?\n\x0b\x0c\r" else b for b in range(256))


def _slices(text: bytes, words: int, slice_bytes: int) -> Iterator[tuple[int, int, int]]:
    """(start, end, seen): starts of pointers lie in start:end, their words end before ``seen``."""
    ahead = re.compile(rb"(?:[ \n]*[^ \n]+){0,%d}" % words)
    at = 0
    while at < len(text):
        end = at + slice_bytes
        if end >= len(text):
            end = len(text)
        else:
            cut = max(text.rfind(b" ", at, end), text.rfind(b"\n", at, end))
            if cut <= at:  # one word longer than a slice
                found = re.compile(rb"[ \n]").search(text, end)
                cut = found.start() if found else len(text)
            end = cut
        yield at, end, ahead.match(text, end).end()
        at = end


def _cut(text: bytes, end: int) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """(words, piece number of each word, start of each word); ``end`` only bounds which words start pointers."""
    b = np.frombuffer(text, np.uint8)
    gap = (b == 32) | (b == 10)
    inside = np.concatenate(([False], ~gap, [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    starts, ends = edges[::2], edges[1::2]
    offsets = np.concatenate(([0], np.cumsum(ends - starts))).astype(np.int32)
    words = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(offsets), pa.py_buffer(b[~gap])])
    return words, np.cumsum(b == 10)[starts] if len(starts) else starts, starts


def combined_pointers(text: bytes, end: int, lang: np.ndarray, lang_at: np.ndarray, longest: int):
    """Weighted pointers of a slice: (language number, dictionary, word numbers by depth or -1, weight)."""
    words, piece, starts = _cut(text, end)
    first = int(np.searchsorted(starts, end))
    coded = words.dictionary_encode()
    ids, size = coded.indices.to_numpy().astype(np.int64), len(coded.dictionary) + 1
    follow = np.full((longest, first), -1, np.int64)
    for d in range(longest):
        n = max(0, min(first, len(ids) - d))
        same = piece[d: d + n] == piece[:n]
        follow[d, :n] = np.where(same, ids[d: d + n], -1)
    language = lang[np.searchsorted(lang_at, starts[:first], side="right") - 1]
    # equal pointers get equal numbers, one word after the other: products stay far below 2^63
    number = language.astype(np.int64)
    for d in range(longest):
        _, number = np.unique(number * size + follow[d] + 1, return_inverse=True)
    _, one, weight = np.unique(number, return_index=True, return_counts=True)
    return language[one], coded.dictionary, follow[:, one], weight


def _slice_rows(docs: DataFrame, rows, schema: str, ahead: int, slice_bytes: int) -> DataFrame:
    """``rows(text, end, language numbers, their starts, languages)`` over slices of the texts, many texts to a slice."""
    def batch(texts: list[bytes], langs: list[str]) -> Iterator[pa.RecordBatch]:
        known = sorted(set(langs))
        number = {x: i for i, x in enumerate(known)}
        text = b"\n".join(texts).translate(_LOWER)
        at = np.concatenate(([0], np.cumsum([len(t) + 1 for t in texts])))[:-1]
        lang = np.array([number[x] for x in langs])
        for start, end, seen in _slices(text, ahead, slice_bytes):
            found = rows(text[start:seen], end - start, lang, at - start, pa.array(known, pa.string()))
            if found.num_rows:
                yield found

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        texts, langs, size = [], [], 0
        for b in batches:
            for text, lang in zip(b.column("text"), b.column("lang")):
                texts.append(text.as_py().encode())
                langs.append(lang.as_py())
                size += len(texts[-1])
                if size >= slice_bytes:
                    yield from batch(texts, langs)
                    texts, langs, size = [], [], 0
        if texts:
            yield from batch(texts, langs)

    return docs.where(F.col("text").isNotNull()) \
        .select(F.coalesce(F.col("lang").cast("string"), F.lit(UNKNOWN)).alias("lang"), "text").mapInArrow(run, schema)


def _words(docs: DataFrame, slice_bytes: int) -> DataFrame:
    """(lang, w1, n): words and their counts in a slice."""
    def rows(text: bytes, end: int, lang: np.ndarray, lang_at: np.ndarray, known: pa.Array) -> pa.RecordBatch:
        which, words, follow, n = combined_pointers(text, end, lang, lang_at, 1)
        return pa.RecordBatch.from_arrays(
            [known.take(pa.array(which)), words.cast(pa.string()).take(pa.array(follow[0])), pa.array(n, pa.int64())], ["lang", "w1", "n"])

    return _slice_rows(docs, rows, "lang string, w1 string, n bigint", 0, slice_bytes)


def _pointers(docs: DataFrame, longest: int, slice_bytes: int, hot: set[str]) -> DataFrame:
    """(lang, p, n): weighted pointers of two words and more, ``p`` their words, space-joined.

    The weight is negative where the first two words are hot.
    """
    def rows(text: bytes, end: int, lang: np.ndarray, lang_at: np.ndarray, known: pa.Array) -> pa.RecordBatch:
        which, words, follow, n = combined_pointers(text, end, lang, lang_at, longest)
        pairs = np.flatnonzero(follow[1] >= 0)
        which, follow, n, words = which[pairs], follow[:, pairs], n[pairs], words.cast(pa.string())
        is_hot = pc.is_in(words, value_set=pa.array(sorted(hot), pa.string())).to_numpy(zero_copy_only=False)
        n = np.where(is_hot[follow[0]] & is_hot[follow[1]], -n, n) if len(n) else n
        columns = [words.take(pa.array(np.maximum(f, 0), mask=f < 0)) for f in follow]
        joined = pc.binary_join_element_wise(*columns, " ", null_handling="skip")
        return pa.RecordBatch.from_arrays([known.take(pa.array(which)), joined, pa.array(n, pa.int64())], ["lang", "p", "n"])

    return _slice_rows(docs, rows, "lang string, p string, n bigint", longest - 1, slice_bytes)


def frequent_prefixes(symbols: list[np.ndarray], weight: np.ndarray, least: np.ndarray
                      ) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Multikey three-way quicksort: (depth, one pointer, weight) of the equal parts that weigh enough.

    ``symbols[d][p]`` is pointer p's symbol at depth d, negative where it has ended. ``least[d][p]`` is the
    weight that a part must have to be sorted on by the symbol at depth d, or to be found by it.
    """
    table = np.stack(symbols)
    pointer = np.arange(table.shape[1])
    size = np.array([len(pointer)])
    depth = np.zeros(1, np.int64)
    while len(pointer):
        start = np.cumsum(size) - size
        segment = np.repeat(np.arange(len(size)), size)
        symbol = table[depth[segment], pointer]
        trio = np.sort(np.stack([symbol[start], symbol[start + size // 2], symbol[start + size - 1]]), axis=0)
        pivot = trio[1][segment]
        part = (symbol >= pivot).astype(np.int64) + (symbol > pivot)
        code = segment * 3 + part
        count = np.bincount(code, minlength=3 * len(size))
        place = np.empty(len(code), np.int64)
        begin = np.cumsum(count) - count
        for k in range(3):  # a stable parting of all segments at once
            mine = part == k
            rank = np.cumsum(mine) - mine
            place[mine] = (begin[code] + rank - rank[start][segment])[mine]
        moved = np.empty_like(pointer)
        moved[place] = pointer
        total = np.add.reduceat(np.append(weight[moved], 0), begin)
        bound = np.minimum.reduceat(np.append(least[depth[segment], moved], 0), begin)
        one = moved[np.minimum(begin, len(moved) - 1)]
        kept = (count > 0) & (total >= bound)
        equal = np.arange(len(count)) % 3 == 1
        deeper = np.repeat(depth, 3) + equal
        kept &= ~(equal & (table[np.repeat(depth, 3), one] < 0))
        for d in range(table.shape[0]):
            done = kept & equal & (deeper == d + 1)
            if done.any():
                yield d + 1, one[done], total[done]
        kept &= deeper < table.shape[0]
        pointer = moved[np.repeat(kept, count)]
        size, depth = count[kept], deeper[kept]


def _sorted_counts(routed: DataFrame, longest: int, least: int, sorted_pointers: int) -> DataFrame:
    """(lang, words, n): counts of phrases of 2 and more words in each task, equal phrases of cut routes in parts."""
    def counted(table: pa.Table, open_ends: tuple[bool, bool]) -> Iterator[pa.RecordBatch]:
        n = table.num_rows
        route = table["route"].to_numpy()
        weight = table["n"].to_numpy()
        # a route that lies in another slice too keeps its small parts
        cut = np.zeros(n, bool)
        if open_ends[0]:
            cut |= route == route[0]
        if open_ends[1]:
            cut |= route == route[-1]
        split = pc.split_pattern(table["p"].combine_chunks(), " ")
        words = split.flatten().dictionary_encode()
        size = pc.list_value_length(split).to_numpy()
        owner = np.repeat(np.arange(n), size)
        ids = np.full((longest, n), -1, np.int64)
        ids[np.arange(len(owner)) - np.repeat(np.cumsum(size) - size, size), owner] = words.indices.to_numpy()
        lang = table["lang"].combine_chunks().dictionary_encode().indices.to_numpy().astype(np.int64)
        # first symbol: language and what bounds hold, so that they are the same in every part
        first = lang * 4 + 2 * cut + (weight < 0)
        # pairs of hot words are counted in parts, what follows them is whole here
        bound = np.full((longest + 1, n), least)
        bound[:, cut] = 1
        bound[:3, weight < 0] = 1
        for depth, one, total in frequent_prefixes([first, *ids], np.abs(weight), bound):
            k = depth - 1
            if k < 2:
                continue
            flat = words.dictionary.take(pa.array(ids[:k, one].T.ravel()))
            lists = pa.ListArray.from_arrays(pa.array(np.arange(len(one) + 1) * k, pa.int32()), flat)
            yield pa.RecordBatch.from_arrays(
                [table["lang"].combine_chunks().take(pa.array(one)), lists, pa.array(total, pa.int64())], ["lang", "words", "n"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size, cut = [], 0, False
        for b in batches:
            held.append(b)
            size += b.num_rows
            if size < sorted_pointers:
                continue
            table = pa.Table.from_batches(held)
            route = table["route"].to_numpy()
            last = int(np.searchsorted(route, route[-1]))  # rows come in order of their routes
            if last:
                yield from counted(table.slice(0, last), (cut, False))
                table, cut = table.slice(last), False
                held, size = table.to_batches(), table.num_rows
            if size >= sorted_pointers:
                yield from counted(table, (cut, True))
                held, size, cut = [], 0, True
        if size:
            yield from counted(pa.Table.from_batches(held), (cut, False))

    return routed.mapInArrow(run, "lang string, words array<string>, n bigint")


def phrase_counts(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, slice_bytes: int = SLICE_BYTES,
                  sorted_pointers: int = SORTED_POINTERS, hot_words: int = HOT_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """((lang, words, f) of words, the same of frequent phrases, (lang, words) of hot words); ``words`` is an array."""
    words = stored(_words(docs, slice_bytes).groupBy("lang", "w1").agg(F.sum("n").alias("f"))
                   .select("lang", F.array("w1").alias("words"), "f"), "words")
    total = words.agg(F.sum("f").alias("n")).first()["n"] or 0
    hot = words.where(F.col("f") * hot_words >= total)  # at most hot_words rows
    listed = hot.select(F.col("words")[0].alias("w")).distinct()
    is_hot = {r["w"] for r in listed.collect()}
    route = F.when(F.col("n") < 0, F.xxhash64("lang", F.substring_index("p", " ", 3))).otherwise(F.xxhash64("lang", F.substring_index("p", " ", 2)))
    # the route is computed on both sides of the shuffle: eight bytes a pointer less to send
    routed = _pointers(docs, longest, slice_bytes, is_hot).repartition(route) \
        .select(route.alias("route"), "lang", "p", "n").sortWithinPartitions("route")
    counts = _sorted_counts(routed, longest, least, sorted_pointers).groupBy("lang", "words").agg(F.sum("n").alias("f")).where(F.col("f") >= least)
    return words, stored(counts, "phrases"), hot.select("lang", "words")


def score(a: Column, left: Column, right: Column) -> Column:
    """floor(1000000 * a * a / (left * right)), exact for counts up to 10^15."""
    a, left, right = (c.cast("decimal(15,0)") for c in (a, left, right))
    return F.call_function("div", F.lit(1_000_000).cast("decimal(7,0)") * (a * a), left * right)


def _with_count(cuts: DataFrame, counts: DataFrame, hot: DataFrame, part: str, name: str) -> DataFrame:
    """``cuts`` with the count of their ``part``; parts of one hot word take it from a broadcast."""
    near = F.broadcast(hot.withColumnRenamed("words", part))
    few = counts.join(F.broadcast(hot), ["lang", "words"]).select("lang", F.col("words").alias(part), F.col("f").alias(name))
    rest = counts.select("lang", F.col("words").alias(part), F.col("f").alias(name))
    return cuts.join(F.broadcast(few), ["lang", part]) \
        .unionByName(cuts.join(near, ["lang", part], "left_anti").join(rest, ["lang", part]))


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, top: int = TOP,
                 covered_percent: int = COVERED_PERCENT, **sizes: int) -> DataFrame:
    """The first ``top`` phrases of each language: lang, rank, phrase, a, l, r, n, score.

    ``score`` is floor(1000000 * a * a / (l * r)) at the phrase's lowest-scoring cut; counts may reach 10^15.
    ``sizes`` go to ``phrase_counts`` and change no result.
    """
    words, phrases, hot = phrase_counts(docs, least, longest, **sizes)
    counts = words.where(F.col("f") >= least).unionByName(phrases)
    at = F.sequence(F.lit(1), F.size("words") - 1)
    cuts = phrases.select("lang", "words", F.col("f").alias("a"), F.explode(at).alias("k")) \
        .withColumn("left", F.slice("words", F.lit(1), F.col("k"))) \
        .withColumn("right", F.slice("words", F.col("k") + 1, F.size("words")))
    cuts = stored(_with_count(cuts, counts, hot, "left", "l"), "cuts")
    cuts = _with_count(cuts, counts, hot, "right", "r")
    lowest = cuts.withColumn("score", score(F.col("a"), F.col("l"), F.col("r"))).groupBy("lang", "words", "a").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("best"))
    starts = F.sequence(F.lit(1), F.size("words") - F.col("len") + 1)
    around = phrases.where(F.size("words") > 2) \
        .withColumn("len", F.explode(F.sequence(F.lit(2), F.size("words") - 1))) \
        .select("lang", "words", "len", "f", F.explode(starts).alias("s")) \
        .select("lang", F.slice("words", F.col("s"), F.col("len")).alias("words"), "f") \
        .groupBy("lang", "words").agg(F.max("f").alias("longer"))
    left = lowest.join(around, ["lang", "words"], "left") \
        .where(F.col("longer").isNull() | (100 * F.col("longer") < covered_percent * F.col("a")))
    phrase = F.array_join("words", " ")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    ranked = left.select("lang", phrase.alias("phrase"), "a", "best.l", "best.r", "best.score") \
        .withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("bigint").alias("rank"), "phrase", "a", "l", "r", "n", "score")


ORACLE = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(
             translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS p FROM documents),
w AS (SELECT lang, regexp_extract_all(p, '[^\x20\x09]+') AS w FROM p),
g AS (SELECT lang, k, array_to_string(w[i:i + k - 1], ' ') AS ph
      FROM (SELECT lang, w, unnest(range(1, len(w) + 1)) AS i FROM w), range(1, 4) AS x(k) WHERE i + k - 1 <= len(w)),
f AS (SELECT lang, k, ph, count(*) AS f FROM g GROUP BY ALL),
n AS (SELECT lang, CAST(sum(f) AS BIGINT) AS n FROM f WHERE k = 1 GROUP BY lang),
c AS (SELECT *, string_split(ph, ' ') AS w FROM f WHERE k >= 2 AND f >= 10),
cut AS (SELECT c.lang, c.ph, c.k, c.f AS a, j, lf.f AS l, rf.f AS r,
               (CAST(1000000 AS HUGEINT) * c.f * c.f) // (CAST(lf.f AS HUGEINT) * rf.f) AS s
        FROM (SELECT *, unnest(range(1, k)) AS j FROM c) c
        JOIN f AS lf ON lf.lang = c.lang AND lf.ph = array_to_string(c.w[1:j], ' ')
        JOIN f AS rf ON rf.lang = c.lang AND rf.ph = array_to_string(c.w[j + 1:], ' ')),
best AS (SELECT * FROM cut QUALIFY row_number() OVER (PARTITION BY lang, ph ORDER BY s, j) = 1),
around AS (SELECT lang, array_to_string(w[i:i + 1], ' ') AS ph, max(f) AS longer
           FROM (SELECT *, unnest([1, 2]) AS i FROM c WHERE k = 3) GROUP BY ALL),
kept AS (SELECT best.* FROM best LEFT JOIN around ON around.lang = best.lang AND around.ph = best.ph AND best.k = 2
         WHERE longer IS NULL OR 100 * longer < 50 * a),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY s DESC, a DESC, ph) AS rank FROM kept)
SELECT lang, rank, ph AS phrase, a, l, r, n, CAST(s AS BIGINT) AS score FROM ranked JOIN n USING (lang) WHERE rank <= 2000
"""
