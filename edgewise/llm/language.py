"""Language identification of web pages by Bayesian fusion of independent evidence.

Four kinds of evidence about a page's language are multiplied:

* the text: a trigram model per language, trained on all labelled documents;
* the language that the markup declares and the suffix of the address, each by
  its observed distribution given the language;
* the host: a prior smoothed along host, registered domain, all pages.

The distributions come from grouped aggregates of the pages' own text
posteriors; a page's own share is taken out of its host's and domain's counts
before they serve as its prior. Long texts would drown all else, as trigrams
overlap and are not independent, so their log-likelihood is tempered.

The model is sent to the tasks when its counted size is within
``BROADCAST_GRAMS``; beyond it pages' trigrams are joined with it by shuffle.
Defined cases: null markup or a page without text is judged by the other
evidence; a null or odd address has suffix, domain and host ''; documents
without a language do not train; without labelled documents there is no
result row for a language, and lang is null; equal posteriors give the first
language in alphabetical order; repeated rows are judged each.
"""

from __future__ import annotations

import html as html_entities
import re
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewise.llm.common import stored

ALPHA = 0.5
#: Divides the text's log-likelihood.
TEMPER = 4.0
#: Pseudo-counts of the upper level in host, domain and feature distributions.
STRENGTH = 5.0
#: Rows of the trigram table (8 bytes and 8 per language) that are sent to every task.
BROADCAST_GRAMS = 2_000_000

_HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>|<!--.*?-->", re.I | re.S)
_TAG = re.compile(r"<[^>]*>")
_DECLARED = re.compile(r"""<html\b[^>]*?\blang\s*=\s*["']?([a-z]{2,3})""", re.I)
_NOT_LETTERS = re.compile(r"[\W\d_]+")


def visible_text(markup: str | None) -> str:
    return html_entities.unescape(_TAG.sub(" ", _HIDDEN.sub(" ", markup or "")))


def declared_language(markup: str | None) -> str:
    m = _DECLARED.search(markup or "")
    return m[1].lower() if m else ""


def trigrams(text: str) -> np.ndarray:
    """Packed character trigrams of the lower-cased words, 16 bits a character."""
    c = np.frombuffer((" " + _NOT_LETTERS.sub(" ", text.lower()).strip() + " ").encode("utf-32-le", "surrogatepass"), np.uint32)
    c = np.minimum(c, 0xFFFF).astype(np.int64)
    return (c[:-2] << 32) | (c[1:-1] << 16) | c[2:] if len(c) > 2 else np.zeros(0, np.int64)


def _gram_counts(docs: DataFrame) -> DataFrame:
    """(lang, gram, n) over all documents with a language."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[np.ndarray]] = {}
        size = 0

        def sums() -> Iterator[pa.RecordBatch]:
            for lang, parts in held.items():
                g, n = np.unique(np.concatenate(parts), return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(g), pa.string()), pa.array(g), pa.array(n)], ["lang", "gram", "n"])

        for b in batches:
            for text, lang in zip(b.column("text"), b.column("lang")):
                grams = trigrams(text.as_py())
                held.setdefault(lang.as_py(), []).append(grams)
                size += len(grams)
                if size > 4_000_000:
                    yield from sums()
                    held, size = {}, 0
        yield from sums()

    rows = docs.select("text", "lang").where(F.col("text").isNotNull() & F.col("lang").isNotNull())
    return rows.mapInArrow(run, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def train(docs: DataFrame) -> tuple[DataFrame, list[str], list[float]]:
    """Table (gram, logp array by language), the languages, and logp of an unseen trigram in each."""
    counts = stored(_gram_counts(docs), "trigrams")
    totals = {r["lang"]: (r["n"], r["kinds"]) for r in
              counts.groupBy("lang").agg(F.sum("n").alias("n"), F.count("*").alias("kinds")).collect()}
    langs = sorted(totals)
    kinds = counts.select("gram").distinct().count() + 1

    def logp(n: float, lang: str) -> float:
        return float(np.log((n + ALPHA) / (totals[lang][0] + ALPHA * kinds)))

    columns = [F.log((F.coalesce(F.sum(F.when(F.col("lang") == x, F.col("n"))), F.lit(0)) + ALPHA)
                     / F.lit(totals[x][0] + ALPHA * kinds)).alias(f"p{i}") for i, x in enumerate(langs)]
    if not langs:
        return counts.select("gram", F.array().cast("array<double>").alias("logp")), [], []
    table = counts.groupBy("gram").agg(*columns).select("gram", F.array(*[f"p{i}" for i in range(len(langs))]).alias("logp"))
    return stored(table, "trigram_model"), langs, [logp(0, x) for x in langs]


_LOADED: dict[str, tuple[np.ndarray, np.ndarray]] = {}


def _received(sent) -> tuple[np.ndarray, np.ndarray]:
    name, grams, logp = sent.value
    if name not in _LOADED:
        _LOADED.clear()
        g = np.frombuffer(grams, np.int64)
        p = np.frombuffer(logp, np.float64).reshape(len(g), -1)
        order = np.argsort(g)
        _LOADED[name] = (g[order], p[order])
    return _LOADED[name]


def page_evidence(pages: DataFrame, model: DataFrame, langs: list[str], unseen: list[float],
                  broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """(page_id, url, row, declared, n_grams, loglik array): what a page's markup says by itself."""
    id_type = pages.schema["page_id"].dataType.simpleString()
    rows = pages.select("page_id", "url", F.xxhash64("page_id", "url", "html").alias("row"), "html")
    out = f"page_id {id_type}, url string, row bigint, declared string, n_grams bigint, loglik array<double>"
    if not langs:
        return rows.select("page_id", "url", "row", F.lit("").alias("declared"), F.lit(0).cast("bigint").alias("n_grams"),
                           F.array().cast("array<double>").alias("loglik"))
    if model.count() <= broadcast_grams:
        t = model.toArrow()
        p = np.array(t["logp"].to_pylist(), np.float64).reshape(-1, len(langs))
        sent = pages.sparkSession.sparkContext.broadcast((uuid.uuid4().hex, t["gram"].to_numpy().tobytes(), p.tobytes()))
        none = np.array(unseen)

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            grams, logp = _received(sent)
            for b in batches:
                declared, n, lik = [], [], []
                for markup in b.column("html").to_pylist():
                    g, c = np.unique(trigrams(visible_text(markup)), return_counts=True)
                    at = np.minimum(np.searchsorted(grams, g), len(grams) - 1)
                    p = np.where((grams[at] == g)[:, None], logp[at], none)
                    declared.append(declared_language(markup))
                    n.append(int(c.sum()))
                    lik.append((c[:, None] * p).sum(axis=0).tolist())
                yield pa.RecordBatch.from_arrays(
                    [b.column("page_id"), b.column("url"), b.column("row"), pa.array(declared, pa.string()),
                     pa.array(n, pa.int64()), pa.array(lik, pa.list_(pa.float64()))],
                    ["page_id", "url", "row", "declared", "n_grams", "loglik"])

        return rows.mapInArrow(score, out)

    def grams_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i, markup in enumerate(b.column("html").to_pylist()):
                g, c = np.unique(trigrams(visible_text(markup)), return_counts=True)
                g, c = np.concatenate((g, [-1])), np.concatenate((c, [0]))  # -1: the page itself, even without text
                take = pa.array(np.full(len(g), i))
                yield pa.RecordBatch.from_arrays(
                    [b.column("page_id").take(take), b.column("url").take(take), b.column("row").take(take),
                     pa.array([declared_language(markup)] * len(g), pa.string()), pa.array(g), pa.array(c)],
                    ["page_id", "url", "row", "declared", "g", "n"])

    split = rows.mapInArrow(grams_of, f"page_id {id_type}, url string, row bigint, declared string, g bigint, n bigint") \
        .groupBy("page_id", "url", "row", "declared", "g").agg(F.max("n").alias("n"), F.count("*").alias("copies"))
    both = split.join(model, split["g"] == model["gram"], "left")
    sums = [F.sum(F.col("n") * F.coalesce(F.get("logp", F.lit(i)), F.lit(u))).alias(f"l{i}") for i, u in enumerate(unseen)]
    return both.groupBy("page_id", "url", "row", "declared").agg(F.sum("n").alias("n_grams"), F.max("copies").alias("copies"), *sums) \
        .select("page_id", "url", "row", "declared", "n_grams", F.array(*[f"l{i}" for i in range(len(langs))]).alias("loglik"),
                F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def _normalised(logs: Column) -> Column:
    """Probabilities from logarithms, in an array."""
    most = F.array_max(logs)
    raised = F.transform(logs, lambda x: F.exp(x - most))
    total = F.aggregate(raised, F.lit(0.0), lambda a, x: a + x)
    return F.transform(raised, lambda x: x / total)


def identify(pages: DataFrame, docs: DataFrame, temper: float = TEMPER, strength: float = STRENGTH,
             broadcast_grams: int = BROADCAST_GRAMS) -> DataFrame:
    """One row per page row: page_id, url, lang, probability, text_lang, declared, suffix, host, n_grams."""
    model, langs, unseen = train(docs)
    k = len(langs)
    names = F.array(*[F.lit(x) for x in langs]).cast("array<string>")
    host = F.coalesce(F.lower(F.regexp_extract("url", r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]+)", 1)), F.lit(""))
    seen = page_evidence(pages, model, langs, unseen, broadcast_grams)
    seen = seen.withColumn("host", host) \
        .withColumn("domain", F.substring_index("host", ".", -2)).withColumn("suffix", F.substring_index("host", ".", -1))
    if not k:
        none = F.lit(None).cast("string")
        return seen.select("page_id", "url", none.alias("lang"), F.lit(None).cast("double").alias("probability"),
                           none.alias("text_lang"), "declared", "suffix", "host", "n_grams")
    seen = stored(seen.withColumn("text_logs", F.transform("loglik", lambda x: x / temper))
                  .withColumn("w", _normalised(F.col("text_logs"))), "page_evidence")

    def sums(by: str, out: str) -> DataFrame:
        """Expected pages per language of each value of ``by``: k sums per value."""
        agg = seen.groupBy(by).agg(*[F.sum(F.get("w", F.lit(i))).alias(f"s{i}") for i in range(k)])
        return agg.select(F.col(by).alias(out + "_key"), F.array(*[f"s{i}" for i in range(k)]).alias(out))

    total = seen.agg(*[F.sum(F.get("w", F.lit(i))).alias(f"s{i}") for i in range(k)], F.count("*").alias("n")).first()
    overall = [(total[f"s{i}"] or 0.0) for i in range(k)]
    pages_seen = total["n"]
    rows = seen
    for by in ("declared", "suffix", "domain", "host"):
        t = sums(by, "of_" + by)
        rows = rows.join(t, rows[by] == t[f"of_{by}_key"]).drop(f"of_{by}_key")

    def log_post(i: int) -> Column:
        w = F.get("w", F.lit(i))
        share = (overall[i] + 1.0) / (pages_seen + k)
        domain_total = F.aggregate("of_domain", F.lit(0.0), lambda a, x: a + x) - 1.0
        host_total = F.aggregate("of_host", F.lit(0.0), lambda a, x: a + x) - 1.0
        by_domain = (F.get("of_domain", F.lit(i)) - w + strength * share) / (domain_total + strength)
        by_host = (F.get("of_host", F.lit(i)) - w + strength * by_domain) / (host_total + strength)
        value = lambda of, n: (F.get(of, F.lit(i)) - w + strength * n) / (overall[i] + strength)
        of = lambda a: F.aggregate(a, F.lit(0.0), lambda s, x: s + x) / pages_seen
        return F.get("text_logs", F.lit(i)) + F.log(F.greatest(by_host, F.lit(1e-9))) \
            + F.log(F.greatest(value("of_declared", of("of_declared")), F.lit(1e-9))) \
            + F.log(F.greatest(value("of_suffix", of("of_suffix")), F.lit(1e-9)))

    post = rows.withColumn("post", _normalised(F.array(*[log_post(i) for i in range(k)])))
    best = F.array_position("post", F.array_max("post"))
    text_best = F.array_position("w", F.array_max("w"))
    return post.select("page_id", "url", F.element_at(names, best.cast("int")).alias("lang"),
                       F.array_max("post").alias("probability"),
                       F.when(F.col("n_grams") > 0, F.element_at(names, text_best.cast("int"))).alias("text_lang"),
                       "declared", "suffix", "host", "n_grams")
