"""Benchmark decontamination with DataFrame operations only.

The normalised n-grams (windows) of the benchmark are hashed into a set that
is broadcast when its counted size allows and joined by shuffle otherwise.
Every document is scanned once: each window of its words is hashed, probed
against the set, and a hit is verified word by word. Hit words are the union
of the verified windows.

Defined cases: null or wordless texts have no words and no hits; an item
shorter than a window is one window; repeated items and repeated rows are
each reported; an empty benchmark marks nothing; further columns are kept by
the filters and ignored by the reports.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgewise.llm.common import ascii_lower, fresh, row_key, sha256_hex, stored

WINDOW = 13
#: A document is contaminated when hit words are at least 1 in so many of its words.
ONE_IN = 20
#: Windows up to this count (about 40 bytes each in the set) are broadcast; more are joined by shuffle.
BROADCAST_WINDOWS = 1_000_000

SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    """Words of the text with A-Z lower-cased: runs of digits, letters and non-ASCII characters."""
    return F.array_remove(F.split(ascii_lower(text), SEPARATORS), "")


def benchmark_windows(benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(item_id, len, gram): every window of every item, ``gram`` space-joined."""
    items = benchmark.select(F.col("item_id").alias("item_id"), words_of(F.col("text")).alias("w")) \
        .where(F.size("w") > 0)
    size = F.least(F.size("w"), F.lit(n))
    grams = F.transform(F.sequence(F.lit(1), F.size("w") - size + 1),
                        lambda i: F.concat_ws(" ", F.slice("w", i, size)))
    return items.select("item_id", size.alias("len"), F.explode(grams).alias("gram"))


def contaminated_windows(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW,
                         broadcast_windows: int = BROADCAST_WINDOWS) -> tuple[DataFrame, DataFrame]:
    """Hits (doc_id, key, start, len, gram) of the documents, and the windows (item_id, len, gram)."""
    windows = benchmark_windows(benchmark, n)
    grams = windows.select("len", "gram").distinct()
    lengths = {r["len"]: r["n"] for r in grams.groupBy("len").agg(F.count("*").alias("n")).collect()}
    small = sum(lengths.values()) <= broadcast_windows
    words = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"),
                        words_of(F.col("text")).alias("w"))
    found = []
    for k in sorted(lengths):
        starts = F.when(F.size("w") >= k, F.sequence(F.lit(0), F.size("w") - k))
        probes = words.select("doc_id", "key", "w", F.explode(starts).alias("start")) \
            .withColumn("h", F.xxhash64(F.slice("w", F.col("start") + 1, k)))
        side = grams.where(F.col("len") == k).select("gram", F.xxhash64(F.split("gram", " ")).alias("h"))
        if small:
            side = F.broadcast(side)
        here = F.concat_ws(" ", F.slice("w", F.col("start") + 1, k))
        if not small:  # the words must not travel with each probe
            probes = probes.select("doc_id", "key", "start", "h", here.alias("here"))
            here = F.col("here")
        found.append(probes.join(side, "h").where(here == F.col("gram"))
                     .select("doc_id", "key", "start", F.lit(k).alias("len"), "gram"))
    if not found:
        empty = words.select("doc_id", "key", F.lit(0).alias("start"), F.lit(0).alias("len"),
                             F.lit("").alias("gram")).where(F.lit(False))
        return empty, windows
    return reduce(DataFrame.unionAll, found).distinct(), windows


def hit_summary(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW,
                broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """(doc_id, key, n_hit, items) of the documents that have a hit."""
    hits, windows = contaminated_windows(docs, benchmark, n, broadcast_windows)
    hits = stored(hits, "hits")  # two aggregates read them; the texts are scanned once
    order = Window.partitionBy("doc_id", "key").orderBy("start", "len")
    before = F.max(F.col("start") + F.col("len")).over(order.rowsBetween(Window.unboundedPreceding, -1))
    new = F.greatest(F.lit(0), F.col("start") + F.col("len") - F.greatest(F.col("start"), F.coalesce(before, F.lit(0))))
    covered = hits.select("doc_id", "key", "start", "len").distinct().withColumn("new", new) \
        .groupBy("doc_id", "key").agg(F.sum("new").cast("bigint").alias("n_hit"))
    ids = hits.select("doc_id", "key", "gram").distinct().join(windows.select("item_id", "gram").distinct(), "gram") \
        .groupBy("doc_id", "key").agg(F.array_sort(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    b = ids.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "items")
    return covered.join(b, covered["doc_id"].eqNullSafe(b["d"]) & (covered["key"] == b["k"]), "left") \
        .select("doc_id", "key", "n_hit", F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def contamination_report(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, one_in: int = ONE_IN,
                         broadcast_windows: int = BROADCAST_WINDOWS) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    sizes = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"),
                        F.coalesce(F.size(words_of(F.col("text"))), F.lit(0)).cast("bigint").alias("n_words"))
    sizes = sizes.withColumn("n_words", F.greatest("n_words", F.lit(0).cast("bigint")))
    s = hit_summary(docs, benchmark, n, broadcast_windows) \
        .select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "n_hit", "items")
    out = sizes.join(s, sizes["doc_id"].eqNullSafe(s["d"]) & (sizes["key"] == s["k"]), "left")
    n_hit = F.coalesce("n_hit", F.lit(0).cast("bigint"))
    return out.select(
        "doc_id", "n_words", n_hit.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("bigint").alias("n_items"),
        sha256_hex(F.coalesce(F.array_join("items", ","), F.lit(""))).alias("items_sha256"),
        ((n_hit > 0) & (one_in * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, one_in: int = ONE_IN) -> DataFrame:
    """The documents that are not contaminated, with all their columns.

    Only documents with a hit enter the count, so the anti join's right side
    holds keys of contaminated documents alone.
    """
    k = fresh(docs, "ew_key")
    keyed = docs.withColumn(k, row_key(F.col("doc_id"), F.col("text")))
    s = hit_summary(docs, benchmark, n).select(F.col("doc_id").alias("ew_d"), F.col("key").alias("ew_k"), "n_hit")
    words = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), "text")
    s = words.join(s, words["doc_id"].eqNullSafe(s["ew_d"]) & (words["key"] == s["ew_k"])) \
        .where(one_in * F.col("n_hit") >= F.size(words_of(F.col("text")))).select("ew_d", "ew_k").distinct()
    return keyed.join(s, keyed["doc_id"].eqNullSafe(s["ew_d"]) & (keyed[k] == s["ew_k"]), "left_anti") \
        .select(*[F.col(f"`{c}`") for c in docs.columns])


def without_hit_words(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW) -> DataFrame:
    """(doc_id, text): the text of every document with its hit words cut out; the gaps between words stay."""
    hits, _ = contaminated_windows(docs, benchmark, n)
    cut = hits.select("doc_id", "key", F.explode(F.sequence("start", F.col("start") + F.col("len") - 1)).alias("p")) \
        .groupBy("doc_id", "key").agg(F.collect_set("p").alias("cut"))
    cut = cut.select(F.col("doc_id").alias("d"), F.col("key").alias("k"), "cut")
    word = r"[0-9A-Za-z\x{80}-\x{10FFFF}]+"
    base = docs.select("doc_id", "text", row_key(F.col("doc_id"), F.col("text")).alias("key"))
    base = base.join(cut, base["doc_id"].eqNullSafe(cut["d"]) & (base["key"] == cut["k"]), "left")
    zipped = F.arrays_zip(F.split("text", word, -1).alias("gap"), F.regexp_extract_all("text", F.lit(word), 0).alias("w"))
    kept = F.array_join(F.transform(zipped, lambda x, i: F.concat(
        x["gap"], F.when(F.array_contains("cut", i), "").otherwise(F.coalesce(x["w"], F.lit(""))))), "")
    return base.select("doc_id", F.when(F.col("cut").isNull(), F.col("text")).otherwise(kept).alias("text"))


ORACLE = r"""
WITH dw AS (SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
bw AS (SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bi AS (SELECT item_id, w, least(len(w), 13) AS k FROM bw WHERE len(w) > 0),
bg AS (SELECT DISTINCT item_id, k, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT item_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM bi)),
ks AS (SELECT DISTINCT k FROM bg),
dg AS (SELECT doc_id, k, i, array_to_string(w[i:i + k - 1], ' ') AS g
       FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM dw, ks WHERE len(w) >= k)),
hit AS (SELECT doc_id, i, dg.k, item_id FROM dg JOIN bg ON dg.g = bg.g AND dg.k = bg.k),
pos AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + k)) AS p FROM hit) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
        FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT dw.doc_id, CAST(coalesce(len(dw.w), 0) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= coalesce(len(dw.w), 0) AS contaminated
FROM dw LEFT JOIN pos USING (doc_id) LEFT JOIN its USING (doc_id)
"""
