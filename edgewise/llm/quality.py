"""Quality classifier: interpolated modified Kneser-Ney model over characters, one per language.

The n-grams of all trusted texts are counted by tasks, then summed, discounted
and interpolated with joins and aggregates on (lang, gram), sharded by that
key. A gram of four characters packs into one long. Perplexity of a document
is taken under the model of its declared language; a document is rejected when
it lies above the language's threshold: a high quantile over trusted documents
that the model was not trained on. Trusted are documents
labelled of good quality and not toxic.

Scoring sends the finished tables to the tasks when their counted size is
within ``BROADCAST_GRAMS``; beyond it the documents' grams are joined with the
tables by shuffle. Both ways give the same perplexities.

Defined cases: null or empty texts have no perplexity and stay; a null or
unknown language is scored under the model of all languages together and its
threshold; without trusted documents nothing is rejected; labels repeated for
a document count once, one that says bad or toxic decides; rows with null ids are scored but never trusted;
repeated rows are judged each.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewise.llm.common import fresh, row_key, stored

ORDER = 4
#: Of trusted documents, this share sets the thresholds and is not trained on.
HELD_OUT = 5
QUANTILE = 0.99
#: Added to the quantile of the logarithm of perplexity: the threshold is the quantile itself.
MARGIN = 0.0
#: Grams of the finished tables (16 bytes each) that are sent to every task.
BROADCAST_GRAMS = 4_000_000
#: Documents whose grams a task holds at a time.
SCORED_ROWS = 500
#: Language of the model that serves null and unknown languages.
ANY = "*"

_START = 0xFFFE
_OTHER = 0xFFFF
#: Masks of the last 0 to 4 characters, as signed longs.
_MASK = [0, 0xFFFF, 0xFFFFFFFF, 0xFFFFFFFFFFFF, -1]


def packed_grams(text: str) -> np.ndarray:
    """One packed four-gram per character: the character and the three before it, 16 bits each."""
    c = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.where(c >= _START, _OTHER, c).astype(np.uint64)
    c = np.concatenate((np.full(ORDER - 1, _START, np.uint64), c))
    out = np.zeros(len(c) - ORDER + 1, np.uint64)
    for i in range(ORDER):
        out = (out << np.uint64(16)) | c[i: i + len(out)]
    return out


def _gram_rows(docs: DataFrame) -> DataFrame:
    """(lang, gram, n): four-gram counts of each task's batches."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def sums() -> pa.RecordBatch:
            lang, gram, n = [], [], []
            for k, parts in held.items():
                g, c = np.unique(np.concatenate(parts), return_counts=True)
                lang += [k] * len(g)
                gram.append(g.view(np.int64))
                n.append(c)
            held.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(lang, pa.string()), pa.array(np.concatenate(gram)), pa.array(np.concatenate(n))],
                ["lang", "gram", "n"])

        for b in batches:
            for text, lang in zip(b.column("text"), b.column("lang")):
                grams = packed_grams(text.as_py() or "")
                if len(grams):
                    held.setdefault(lang.as_py(), []).append(grams)
                    size += len(grams)
                if size > 4_000_000:
                    yield sums()
                    size = 0
        if held:
            yield sums()

    return docs.select(F.col("text"), F.coalesce("lang", F.lit(ANY)).alias("lang")) \
        .mapInArrow(run, "lang string, gram bigint, n bigint")


def _discount(c: Column) -> Column:
    return F.when(c == 1, F.col("d1")).when(c == 2, F.col("d2")).otherwise(F.col("d3"))


def _discounts(counts: DataFrame) -> DataFrame:
    """(lang, d1, d2, d3): modified Kneser-Ney discounts from the counts of counts."""
    n = counts.groupBy("lang").agg(*[F.count(F.when(F.col("c") == i, 1)).cast("double").alias(f"n{i}") for i in (1, 2, 3, 4)])
    y = F.col("n1") / (F.col("n1") + 2 * F.col("n2"))
    known = (F.col("n1") > 0) & (F.col("n2") > 0) & (F.col("n3") > 0) & (F.col("n4") > 0)

    def d(i: int, usual: float) -> Column:
        value = i - (i + 1) * y * F.try_divide(F.col(f"n{i + 1}"), F.col(f"n{i}"))
        return F.when(known, F.greatest(F.lit(0.05), F.least(F.lit(i - 0.05), value))).otherwise(F.lit(usual)).alias(f"d{i}")

    return n.select("lang", d(1, 0.5), d(2, 1.0), d(3, 1.5))


def train(trusted: DataFrame) -> DataFrame:
    """(lang, len, gram, logp, backoff) of all grams of 1 to 4 characters of (lang, text).

    ``logp`` is the interpolated probability of the gram's last character;
    ``backoff`` the weight left by the gram as a context of the next order.
    """
    by_task = _gram_rows(trusted)
    by_task = stored(by_task, "task_grams")
    both = by_task.unionAll(by_task.where(F.col("lang") != ANY).withColumn("lang", F.lit(ANY)))
    counts = {ORDER: stored(both.groupBy("lang", "gram").agg(F.sum("n").alias("c")), "grams")}
    for k in range(ORDER - 1, 0, -1):  # of lower orders: how many characters go before
        shorter = F.col("gram").bitwiseAND(F.lit(_MASK[k])).alias("gram")
        counts[k] = stored(counts[k + 1].select("lang", shorter).groupBy("lang", "gram").agg(F.count("*").alias("c")), "grams")
    lower = None
    tables = []
    for k in range(1, ORDER + 1):
        c = counts[k].join(F.broadcast(_discounts(counts[k])), "lang") \
            .withColumn("context", F.shiftrightunsigned("gram", 16) if k > 1 else F.lit(0).cast("bigint"))
        contexts = c.groupBy("lang", "context").agg(
            F.sum("c").alias("total"), F.sum(_discount(F.col("c"))).alias("left")) \
            .withColumn("weight", F.col("left") / F.col("total"))
        p = c.join(contexts, ["lang", "context"])
        own = (F.col("c") - _discount(F.col("c"))) / F.col("total")
        if k == 1:
            kinds = counts[1].groupBy("lang").agg((F.count("*") + 1).alias("kinds"))
            below = p.join(F.broadcast(kinds), "lang").withColumn("p_low", 1.0 / F.col("kinds"))
            rest = contexts.join(F.broadcast(kinds), "lang").select(
                "lang", F.lit(0).alias("len"), F.lit(0).cast("bigint").alias("gram"),
                F.log(1.0 / F.col("kinds")).alias("logp"), F.log("weight").alias("backoff"))
            tables.append(rest)
        else:
            low = lower.select("lang", F.col("gram").alias("low"), F.col("p").alias("p_low"))
            below = p.withColumn("low", F.col("gram").bitwiseAND(F.lit(_MASK[k - 1]))).join(low, ["lang", "low"])
            weights = contexts.select(F.col("lang").alias("wl"), F.col("context").alias("wg"), F.log("weight").alias("backoff"))
            # contexts that end before a text's first character are no grams themselves: they have no logp
            shorter = lower.join(weights, (F.col("lang") == F.col("wl")) & (F.col("gram") == F.col("wg")), "full")
            tables.append(shorter.select(F.coalesce("lang", "wl").alias("lang"), F.lit(k - 1).alias("len"),
                                         F.coalesce("gram", "wg").alias("gram"), F.log("p").alias("logp"), "backoff"))
        lower = stored(below.select("lang", "gram", (own + F.col("weight") * F.col("p_low")).alias("p")), "order")
    tables.append(lower.select("lang", F.lit(ORDER).alias("len"), "gram", F.log("p").alias("logp"),
                               F.lit(None).cast("double").alias("backoff")))
    out = tables[0]
    for t in tables[1:]:
        out = out.unionAll(t)
    return stored(out, "model")


class _Tables:
    """Sorted arrays of one language, looked up by binary search."""

    def __init__(self, rows: list[tuple[np.ndarray, np.ndarray, np.ndarray]]):
        self.rows = rows

    def logp(self, grams: np.ndarray) -> np.ndarray:
        out = np.zeros(len(grams))
        open_ = np.arange(len(grams))
        for k in range(ORDER, 0, -1):
            g = grams[open_] & np.int64(_MASK[k]).view(np.uint64)
            keys, logp, _ = self.rows[k]
            at = np.minimum(np.searchsorted(keys, g), len(keys) - 1)
            hit = keys[at] == g
            out[open_[hit]] += logp[at[hit]]
            open_ = open_[~hit]
            if not len(open_):
                return out
            context = (grams[open_] & np.int64(_MASK[k]).view(np.uint64)) >> np.uint64(16)
            keys, _, backoff = self.rows[k - 1]
            at = np.minimum(np.searchsorted(keys, context), len(keys) - 1)
            seen = keys[at] == context
            out[open_[seen]] += backoff[at[seen]]
        out[open_] += self.rows[0][1][0]
        return out


_LOADED: dict[str, dict[str, _Tables]] = {}


def _sent(model: DataFrame):
    """The tables as one Arrow stream, sent to the tasks."""
    table = model.select("lang", "len", "gram", "logp", "backoff").toArrow()
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema) as w:
        w.write_table(table)
    return model.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, sink.getvalue().to_pybytes()))


def _received(sent) -> dict[str, _Tables]:
    name_of_model, stream = sent.value
    if name_of_model not in _LOADED:
        t = pa.ipc.open_stream(stream).read_all()
        lang, length = np.array(t["lang"].to_pylist(), dtype=object), t["len"].to_numpy()
        gram = t["gram"].to_numpy().view(np.uint64)
        logp, backoff = t["logp"].to_numpy(), np.nan_to_num(t["backoff"].to_numpy())
        out = {}
        for name in set(lang):
            rows = []
            for k in range(ORDER + 1):
                mine = np.nonzero((lang == name) & (length == k))[0]
                mine = mine[np.argsort(gram[mine])]
                rows.append((gram[mine], logp[mine], backoff[mine]))
            out[name] = _Tables(rows)
        _LOADED.clear()
        _LOADED[name_of_model] = out
    return _LOADED[name_of_model]


def perplexities(docs: DataFrame, model: DataFrame, broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """(doc_id, key, lang, n, log_ppl): one row per document row; lang is the model's, n the characters."""
    langs = [r["lang"] for r in model.select("lang").distinct().collect()]
    known = F.when(F.col("lang").isin(langs), F.col("lang")).otherwise(F.lit(ANY))
    rows = docs.select("doc_id", row_key(F.col("doc_id"), F.col("text")).alias("key"), known.alias("lang"), "text")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    if not langs:
        return rows.select("doc_id", "key", "lang", F.lit(0).cast("bigint").alias("n"),
                           F.lit(None).cast("double").alias("log_ppl"))
    if model.count() > broadcast_grams:
        return _perplexities_by_join(rows, model, id_type)
    sent = _sent(model)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = _received(sent)
        for b in (whole.slice(at, SCORED_ROWS) for whole in batches for at in range(0, whole.num_rows, SCORED_ROWS)):
            lang = b.column("lang").to_pylist()
            grams = [packed_grams(t.as_py() or "") for t in b.column("text")]
            n = np.array([len(g) for g in grams], np.int64)
            total = np.zeros(len(n))
            for name in set(lang):
                mine = [i for i, x in enumerate(lang) if x == name and n[i]]
                for at in range(0, len(mine), 256):
                    part = mine[at: at + 256]
                    kinds, where = np.unique(np.concatenate([grams[i] for i in part]), return_inverse=True)
                    logp = tables[name].logp(kinds)[where]
                    total[part] = np.add.reduceat(logp, np.concatenate(([0], np.cumsum(n[part])[:-1])))
            mean = [float(-t / k) if k else None for t, k in zip(total, n)]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("key"), b.column("lang"), pa.array(n), pa.array(mean, pa.float64())],
                ["doc_id", "key", "lang", "n", "log_ppl"])

    return rows.mapInArrow(score, f"doc_id {id_type}, key bigint, lang string, n bigint, log_ppl double")


def _perplexities_by_join(rows: DataFrame, model: DataFrame, id_type: str) -> DataFrame:
    """The same by joins: each document's gram counts, then gram probabilities with backoff resolved per gram."""
    def grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, t in enumerate(b.column("text")):
                g, c = np.unique(packed_grams(t.as_py() or ""), return_counts=True)
                take = pa.array(np.full(len(g), i))
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(take), b.column("key").take(take), b.column("lang").take(take),
                     pa.array(g.view(np.int64)), pa.array(c)], ["doc_id", "key", "lang", "gram", "n"])

    found = stored(rows.mapInArrow(grams, f"doc_id {id_type}, key bigint, lang string, gram bigint, n bigint")
                   .groupBy("doc_id", "key", "lang", "gram").agg(F.max("n").alias("n")), "document_grams")
    state = found.select("lang", "gram").distinct().withColumn("sum", F.lit(0.0)).withColumn("done", F.lit(False))
    for k in range(ORDER, 0, -1):
        p = model.where(F.col("len") == k).select("lang", F.col("gram").alias("at"), "logp")
        w = model.where(F.col("len") == k - 1).select("lang", F.col("gram").alias("context"), "backoff")
        state = state.withColumn("at", F.col("gram").bitwiseAND(F.lit(_MASK[k]))) \
            .withColumn("context", F.shiftrightunsigned("at", 16)).join(p, ["lang", "at"], "left").join(w, ["lang", "context"], "left")
        more = F.when(F.col("done"), 0.0).when(F.col("logp").isNotNull(), F.col("logp")).otherwise(F.coalesce("backoff", F.lit(0.0)))
        state = stored(state.select("lang", "gram", (F.col("sum") + more).alias("sum"),
                                    (F.col("done") | F.col("logp").isNotNull()).alias("done")), "gram_scores")
    zero = model.where(F.col("len") == 0).select("lang", F.col("logp").alias("uniform"))
    state = state.join(F.broadcast(zero), "lang").select("lang", "gram", F.when(F.col("done"), F.col("sum"))
                                                        .otherwise(F.col("sum") + F.col("uniform")).alias("logp"))
    scored = found.join(state, ["lang", "gram"]).groupBy("doc_id", "key", "lang") \
        .agg(F.sum("n").alias("n"), (-F.sum(F.col("n") * F.col("logp")) / F.sum("n")).alias("log_ppl")) \
        .select(F.col("doc_id").alias("d"), F.col("key").alias("k"), F.col("lang").alias("l"), "n", "log_ppl")
    return rows.join(scored, rows["doc_id"].eqNullSafe(F.col("d")) & (rows["key"] == F.col("k")) & (rows["lang"] == F.col("l")), "left") \
        .select("doc_id", "key", "lang", F.coalesce("n", F.lit(0)).cast("bigint").alias("n"), "log_ppl")


def _held_out(doc_id: Column) -> Column:
    return F.pmod(F.xxhash64(doc_id, F.lit("held out")), F.lit(HELD_OUT)) == 0


def quality_report(docs: DataFrame, labels: DataFrame, quantile: float = QUANTILE, margin: float = MARGIN,
                   broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """One row per document row: doc_id, key, lang, n_chars, perplexity, threshold, kept."""
    trusted = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("toxic").alias("toxic")) \
        .where((F.col("q") == 1) & (F.coalesce("toxic", F.lit(0)) == 0) & F.col("doc_id").isNotNull()).select("doc_id")
    train_ids = trusted.where(~_held_out(F.col("doc_id")))
    # labels grow with the corpus: this join is a shuffle at every size
    model = train(docs.select("doc_id", "text", "lang").join(train_ids.hint("shuffle_merge"), "doc_id", "left_semi"))
    scored = stored(perplexities(docs, model, broadcast_grams), "perplexities")
    held = scored.join(trusted.where(_held_out(F.col("doc_id"))), "doc_id", "left_semi").where(F.col("n") > 0)
    cut = F.expr(f"approx_percentile(log_ppl, {quantile}, 10000)") + margin
    limits = {r["lang"]: r["t"] for r in held.groupBy("lang").agg(cut.alias("t")).collect() if r["lang"] != ANY}
    overall = held.agg(cut.alias("t")).first()["t"]
    log_t = F.lit(overall).cast("double")
    for name, t in limits.items():  # one row per language
        log_t = F.when(F.col("lang") == name, F.lit(t)).otherwise(log_t)
    return scored.select(
        "doc_id", "key", "lang", F.col("n").alias("n_chars"), F.exp("log_ppl").alias("perplexity"),
        F.exp(log_t).alias("threshold"), F.coalesce(F.col("log_ppl") <= log_t, F.lit(True)).alias("kept"))


def without_rejected(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that the classifier keeps, all columns."""
    k = fresh(docs, "ew_key")
    gone = quality_report(docs, labels).where(~F.col("kept")) \
        .select(F.col("doc_id").alias("ew_gone_id"), F.col("key").alias("ew_gone_key")).distinct()
    keyed = docs.withColumn(k, row_key(F.col("doc_id"), F.col("text")))
    return keyed.join(gone, keyed["doc_id"].eqNullSafe(gone["ew_gone_id"]) & (keyed[k] == gone["ew_gone_key"]), "left_anti") \
        .select(*[F.col(f"`{c}`") for c in docs.columns])
