"""URL filter by a ratio of character language models, with DataFrame operations only.

Host and path rules decide the URLs that they fit. Those URLs also train two
smoothed variable-order Markov models over characters, one of the accepted and
one of the rejected URLs. Every other URL is judged by the difference of its
log-likelihoods under the two models per character, against a threshold that
is calibrated on ruled URLs which the models were not trained on.

A gram is a character with the ``ORDER`` characters before it. All grams of all
URLs are counted, and the counts of shorter grams are sums of those of longer
ones. A context that a class has seen at least ``MIN_CONTEXT`` times refines the
estimate of the next shorter one (Witten-Bell weights); one seen more rarely
leaves it as it is. Log-likelihood differences are rounded to whole micro-nats,
so that sums do not depend on their order.

Skew: a gram that holds at least 1 in ``HOT_GRAMS`` of all positions is hot.
There are at most ``HOT_GRAMS`` of those at any size, and they are broadcast;
each other gram holds too few positions to burden the task that it goes to.
Joins between a gram and its shorter forms see at most one row a character of
the alphabet on the longer side.

Defined cases: a null URL has empty host and path and is judged like an empty
text; so has one without ``://``, which is judged by its characters. If no
URL is accepted (or rejected) by a rule, that model is uniform; if no ruled URL is
held out in a class the threshold is zero; scores at the threshold are
allowed. Repeated rows are counted and reported each; rows with null ids are
told apart by their URL. An empty table gives an empty report. URLs may have any
length: characters are cut out once, and a position costs the same anywhere.
Further columns are ignored by the report and kept by the filter, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgewise.llm.common import ascii_lower, fresh, row_key, stored

#: (verdict, host and path): the longest rule that fits decides.
RULES = (
    ("block", "net/"),
    ("allow", "example.net/en/"),
    ("block", "example.com/de/"),
    ("allow", "org/fr/"),
)
#: Rules become one expression; a longer list does not belong there.
MAX_RULES = 1000
#: Characters before the predicted one.
ORDER = 4
#: A class uses a context that it has seen so often.
MIN_CONTEXT = 2
#: A gram with at least 1 in so many of all positions is broadcast.
HOT_GRAMS = 10_000
#: Ruled URLs whose MD5 begins below this (one in five) calibrate and do not train.
HELD_OUT_BELOW = "3333"
#: Scores are told apart to this many micro-nats a character when the threshold is chosen, within 100 nats.
BIN = 1000
_BINS = 100_000

_START = "\x02"
_END = "\x03"


def host_of(url: Column) -> Column:
    """From the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty without ``://``."""
    return ascii_lower(F.regexp_extract(_after_scheme(url), r"^[^/?#]*", 0))


def path_of(url: Column) -> Column:
    """From the end of the host up to ``?``, ``#`` or the end; empty without ``://``."""
    return F.regexp_extract(_after_scheme(url), r"^[^/?#]*([^?#]*)", 1)


def _after_scheme(url: Column) -> Column:
    at = F.instr(url, "://")
    return F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits the host or a parent domain and begins the path; else nulls."""
    if len(rules) > MAX_RULES:
        raise ValueError(f"{len(rules)} rules; at most {MAX_RULES} fit one expression")
    rule = verdict = F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: (len(r[1]), r[1])):  # the longest is tried first: it wraps the rest
        name, _, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, F.lit(text)).otherwise(rule), F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def _judged(pages: DataFrame, rules) -> DataFrame:
    """(page_id, key, url, host, path, rule, verdict, held)."""
    url = F.col("url")
    rows = pages.select("page_id", row_key(F.col("page_id"), url).alias("key"), "url",
                        F.coalesce(host_of(url), F.lit("")).alias("host"), F.coalesce(path_of(url), F.lit("")).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    return rows.select("*", rule.alias("rule"), verdict.alias("verdict"), (F.md5("url") < HELD_OUT_BELOW).alias("held"))


def _positions(rows: DataFrame, *columns: str) -> DataFrame:
    """One row a position of the URL, the end included: the columns and ``gram``."""
    chars = F.split(F.concat(F.lit(_START * ORDER), F.coalesce("url", F.lit("")), F.lit(_END)), "")
    grams = F.transform(F.sequence(F.lit(1), F.size("c") - ORDER), lambda i: F.array_join(F.slice("c", i, ORDER + 1), ""))
    return rows.withColumn("c", chars).select(*columns, F.explode(grams).alias("gram"))


def gram_counts(rows: DataFrame) -> list[DataFrame]:
    """By context length 0 to ORDER: (gram, a, b, scored), occurrences in trained accepted, trained rejected, scored URLs."""
    trained = F.col("verdict").isNotNull() & ~F.col("held")
    kinds = rows.select("url", (trained & (F.col("verdict") == "allow")).cast("bigint").alias("a"),
                        (trained & (F.col("verdict") == "block")).cast("bigint").alias("b"),
                        (~F.coalesce(trained, F.lit(False))).cast("bigint").alias("s"))
    sums = [F.sum(F.coalesce(c, F.lit(0))).alias(c) for c in ("a", "b", "s")]
    counts = [stored(_positions(kinds, "a", "b", "s").groupBy("gram").agg(*sums), "url_grams")]
    for _ in range(ORDER):
        shorter = counts[0].select(F.substr("gram", F.lit(2)).alias("gram"), "a", "b", "s")
        counts.insert(0, stored(shorter.groupBy("gram").agg(*sums), "url_grams"))
    return counts


def _smoothed(n: Column, total: Column, kinds: Column, low: Column) -> Column:
    """Witten-Bell: the count, and the shorter context's estimate with the weight of the kinds seen."""
    return F.when(total >= MIN_CONTEXT, (n + kinds * low) / (total + kinds)).otherwise(low)


def gram_scores(counts: list[DataFrame]) -> DataFrame:
    """(gram, d, s): log-likelihood of the accepted less the rejected model in micro-nats, for every gram of full length."""
    def classes(df: DataFrame) -> list[Column]:
        return [F.sum("a").cast("double").alias("total_a"), F.sum("b").cast("double").alias("total_b"),
                F.count(F.when(F.col("a") > 0, 1)).cast("double").alias("kinds_a"),
                F.count(F.when(F.col("b") > 0, 1)).cast("double").alias("kinds_b")]

    scored = None
    for k, grams in enumerate(counts):
        if k == 0:
            one = grams.agg(*classes(grams), F.count("*").alias("v")).first()
            uniform = F.lit(1.0 / (one["v"] + 1))
            rows = grams.select("*", *[F.lit(float(one[c] or 0)).alias(c) for c in ("total_a", "total_b", "kinds_a", "kinds_b")],
                                uniform.alias("low_a"), uniform.alias("low_b"))
        else:
            context = F.substr("gram", F.lit(1), F.lit(k))
            seen = grams.groupBy(context.alias("context")).agg(*classes(grams))
            low = scored.select(F.col("gram").alias("tail"), F.col("p_a").alias("low_a"), F.col("p_b").alias("low_b"))
            rows = grams.withColumn("context", context).join(seen, "context") \
                .withColumn("tail", F.substr("gram", F.lit(2))).join(low, "tail")
        scored = rows.select("gram", "s", *[
            _smoothed(F.col(c).cast("double"), F.col(f"total_{c}"), F.col(f"kinds_{c}"), F.col(f"low_{c}")).alias(f"p_{c}")
            for c in ("a", "b")])
    d = F.round((F.log("p_a") - F.log("p_b")) * 1_000_000).cast("bigint")
    return stored(scored.select("gram", d.alias("d"), "s"), "url_gram_scores")


def _url_scores(rows: DataFrame, scores: DataFrame) -> DataFrame:
    """(page_id, key, verdict, score): micro-nats a character; the verdict is the rule's."""
    total = scores.agg(F.sum("s").alias("n")).first()["n"] or 0
    scores = scores.where(F.col("s") > 0)
    hot = F.col("s") * HOT_GRAMS >= total
    keys = ["page_id", "key", "verdict"]
    at = _positions(rows, *keys)

    def sums(found: DataFrame) -> DataFrame:
        return found.groupBy(*keys).agg(F.sum("d").alias("d"), F.count("*").alias("n"))

    # at most HOT_GRAMS rows by the count of positions itself
    hot_side = F.broadcast(scores.where(hot).select("gram", "d"))
    rest = at.join(F.broadcast(scores.where(hot).select("gram")), "gram", "left_anti")
    parts = sums(at.join(hot_side, "gram")).unionAll(sums(rest.join(scores.where(~hot).select("gram", "d"), "gram")))
    return parts.groupBy(*keys).agg(F.sum("d").alias("d"), F.sum("n").alias("n")) \
        .select(*keys, F.expr("d div n").alias("score"))


def _bin(score: Column) -> Column:
    within = F.greatest(F.lit(-_BINS * BIN), F.least(F.lit(_BINS * BIN), score))
    return F.expr(f"{BIN}").cast("bigint") * F.floor(within / F.lit(float(BIN)))


def threshold(held: DataFrame) -> int:
    """Between the least bin at which the shares of accepted URLs at or above it and of rejected ones below it
    sum highest, and the next occupied bin below: half way, so that both sides have the same margin.

    The histogram has at most 2 * 100,000 + 1 bins at any size.
    """
    hist = held.groupBy(_bin(F.col("score")).alias("bin")).agg(
        F.count(F.when(F.col("verdict") == "allow", 1)).alias("a"), F.count(F.when(F.col("verdict") == "block", 1)).alias("b"))
    before, every = Window.orderBy("bin").rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    wide = "decimal(19,0)"
    running = hist.select(
        "bin", F.lag("bin", 1).over(Window.orderBy("bin")).alias("next"), F.sum("a").over(every).cast(wide).alias("all_a"), F.sum("b").over(every).cast(wide).alias("all_b"),
        F.coalesce(F.sum("a").over(before), F.lit(0)).cast(wide).alias("under_a"),
        F.coalesce(F.sum("b").over(before), F.lit(0)).cast(wide).alias("under_b"))
    good = (F.col("all_a") - F.col("under_a")) * F.col("all_b") + F.col("under_b") * F.col("all_a")
    best = running.where("all_a > 0 AND all_b > 0").orderBy(good.desc(), "bin").first()
    if not best:
        return 0
    return (best["bin"] + (best["bin"] if best["next"] is None else best["next"])) // 2


def _verdicts(pages: DataFrame, rules) -> DataFrame:
    """(page_id, key, host, path, rule, verdict, score) of every row."""
    rows = _judged(pages, rules)
    scores = gram_scores(gram_counts(rows))
    open_ = rows.where(F.col("verdict").isNull() | F.col("held"))
    scored = stored(_url_scores(open_, scores), "url_scores")
    limit = threshold(scored.where(F.col("verdict").isNotNull()))
    found = scored.where(F.col("verdict").isNull()).select(F.col("page_id").alias("p"), F.col("key").alias("k"), "score")
    free, ruled = rows.where(F.col("verdict").isNull()), rows.where(F.col("verdict").isNotNull())
    out = free.join(found, free["page_id"].eqNullSafe(found["p"]) & (free["key"] == found["k"]))
    said = F.when(_bin(F.col("score")) >= limit, "allow").otherwise("block")
    names = ["page_id", "key", "host", "path", "rule"]
    return ruled.select(*names, "verdict", F.lit(0).cast("bigint").alias("score")) \
        .unionAll(out.select(*names, said.alias("verdict"), "score"))


def url_report(pages: DataFrame, rules=RULES) -> DataFrame:
    """One row a page: page_id, host, path, rule, verdict, score (micro-nats a character; zero where a rule decides)."""
    return _verdicts(pages, rules).drop("key")


def without_blocked(pages: DataFrame, rules=RULES) -> DataFrame:
    """The pages whose URL is allowed, with all their columns."""
    k = fresh(pages, "ew_key")
    i, h = fresh(pages, "ew_gone_id"), fresh(pages, "ew_gone_key")
    gone = _verdicts(pages, rules).where(F.col("verdict") == "block") \
        .select(F.col("page_id").alias(i), F.col("key").alias(h)).distinct()
    keyed = pages.withColumn(k, row_key(F.col("page_id"), F.col("url")))
    return keyed.join(gone, keyed["page_id"].eqNullSafe(gone[i]) & (keyed[k] == gone[h]), "left_anti") \
        .select(*[F.col(f"`{c}`") for c in pages.columns])


ORACLE = r"""
WITH RECURSIVE rest AS (SELECT page_id, url, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS r FROM pages),
hp AS (SELECT page_id, coalesce(url, '') AS url, url IS NULL AS gone,
              translate(regexp_extract(r, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
              regexp_extract(r, '^[^/?#]*([^?#]*)', 1) AS path FROM rest),
rules(said, rule, name, begins) AS (VALUES ('block', 'net/', 'net', '/'), ('allow', 'example.net/en/', 'example.net', '/en/'),
              ('block', 'example.com/de/', 'example.com', '/de/'), ('allow', 'org/fr/', 'org', '/fr/')),
fit AS (SELECT page_id, url, max_by(rule, length(rule)) AS rule, max_by(said, length(rule)) AS said
        FROM (SELECT DISTINCT page_id, url, rule, said FROM hp JOIN rules ON (host = name OR ends_with(host, '.' || name)) AND starts_with(path, begins))
        GROUP BY page_id, url),
j AS (SELECT hp.page_id, hp.url, host, path, rule, said, NOT gone AND md5(hp.url) < '3333' AS held
      FROM hp LEFT JOIN fit ON hp.page_id IS NOT DISTINCT FROM fit.page_id AND hp.url = fit.url),
pos AS (SELECT page_id, url, said, held, substr(t, i, 5) AS g
        FROM (SELECT *, repeat(chr(2), 4) || url || chr(3) AS t, unnest(range(1, length(url) + 2)) AS i FROM j)),
c5 AS (SELECT g, count(*) FILTER (said = 'allow' AND NOT held) AS a, count(*) FILTER (said = 'block' AND NOT held) AS b FROM pos GROUP BY g),
c AS (SELECT right(g, k + 1) AS g, k, sum(a)::BIGINT AS a, sum(b)::BIGINT AS b FROM c5, range(5) r(k) GROUP BY ALL),
ctx AS (SELECT left(g, k) AS x, k, sum(a)::DOUBLE AS ta, sum(b)::DOUBLE AS tb, (count(*) FILTER (a > 0))::DOUBLE AS ka, (count(*) FILTER (b > 0))::DOUBLE AS kb
        FROM c GROUP BY ALL),
p AS (SELECT g, 0 AS k, CASE WHEN ta >= 2 THEN (a::DOUBLE + ka * u) / (ta + ka) ELSE u END AS pa,
             CASE WHEN tb >= 2 THEN (b::DOUBLE + kb * u) / (tb + kb) ELSE u END AS pb
      FROM c JOIN ctx USING (k), (SELECT 1.0::DOUBLE / (count(*) + 1) AS u FROM c WHERE k = 0) WHERE k = 0
      UNION ALL
      SELECT c.g, c.k, CASE WHEN ta >= 2 THEN (a::DOUBLE + ka * pa) / (ta + ka) ELSE pa END,
             CASE WHEN tb >= 2 THEN (b::DOUBLE + kb * pb) / (tb + kb) ELSE pb END
      FROM p JOIN c ON c.k = p.k + 1 AND right(c.g, p.k + 1) = p.g JOIN ctx ON ctx.k = c.k AND ctx.x = left(c.g, c.k)),
d AS (SELECT g, round((ln(pa) - ln(pb)) * 1000000)::BIGINT AS d FROM p WHERE k = 4),
s AS (SELECT page_id, url, said, sum(d)::BIGINT // count(*) AS score FROM pos JOIN d USING (g) WHERE said IS NULL OR held GROUP BY ALL),
sb AS (SELECT *, 1000 * floor(greatest(-100000000, least(100000000, score)) / 1000.0::DOUBLE)::BIGINT AS bin FROM s),
held AS (SELECT sb.bin, count(*) FILTER (j.said = 'allow') AS a, count(*) FILTER (j.said = 'block') AS b
         FROM sb JOIN j ON sb.url = j.url AND sb.page_id IS NOT DISTINCT FROM j.page_id WHERE sb.said IS NOT NULL GROUP BY 1),
run AS (SELECT bin, coalesce(lag(bin) OVER (ORDER BY bin), bin) AS nxt, sum(a) OVER () AS aa, sum(b) OVER () AS ab, coalesce(sum(a) OVER w, 0) AS ua, coalesce(sum(b) OVER w, 0) AS ub FROM held
        WINDOW w AS (ORDER BY bin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
lim AS (SELECT coalesce((SELECT (bin + nxt) // 2 FROM run WHERE aa > 0 AND ab > 0 ORDER BY (aa - ua)::HUGEINT * ab + ub::HUGEINT * aa DESC, bin LIMIT 1), 0) AS t)
SELECT j.page_id, j.host, j.path, j.rule,
       coalesce(j.said, CASE WHEN bin >= t THEN 'allow' ELSE 'block' END) AS verdict,
       CASE WHEN j.said IS NULL THEN score ELSE 0 END AS score
FROM j CROSS JOIN lim LEFT JOIN sb ON sb.url = j.url AND sb.page_id IS NOT DISTINCT FROM j.page_id AND j.said IS NULL
"""
