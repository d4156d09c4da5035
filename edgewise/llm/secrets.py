"""Secret scans with DataFrame operations only: base patterns and linked multipart credentials.

Each pattern is applied to the whole text. Java's ``split`` gives the gaps
between matches and ``regexp_extract_all`` the matches; a running sum of both
lengths gives the positions. Only documents that pass a cheap test per kind
reach that step.

Multipart linking is an interval join of access identifiers, secrets and
endpoints on (document, distance of at most ``SCOPE`` code points). It is done
as a sweep: in position order the nearest complementary part before and after
decides, so no pairs are emitted. Weak candidates (a bare identifier, a bare
secret, an endpoint) are reported only beside their complementary parts and
never where a base span already covers them.

Defined cases: null text counts as empty; a document without spans has zero
counts and the digest of the empty string; repeated rows are reported once
each; further columns are ignored by the report and kept by ``redacted``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from edgewise.llm.common import fresh, row_key, sha256_hex

#: Parts of one credential lie at most so many code points apart.
SCOPE = 200
REDACTED = "[REDACTED]"

#: Kinds in order; the first three are the base kinds.
KINDS = ("assign", "access", "hex", "weak_id", "weak_secret", "endpoint")


def _any_case(word: str) -> str:
    return "".join(f"[{c.upper()}{c}]" for c in word)


_KEYWORDS = "|".join([_any_case("password"), _any_case("passwd"), _any_case("secret"), _any_case("token"),
                      _any_case("api") + "_?" + _any_case("key")])
ASSIGN = rf"""({_KEYWORDS})["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"
#: A whole run of key characters that holds a digit; starts only where a run starts, so after '=' but not at it.
RUN = r"(?<![A-Za-z0-9+/_-])[A-Za-z+/_-]*+[0-9][A-Za-z0-9+/_-]*+(?:=++(?![A-Za-z0-9+/_-]))?"
#: An identifier is a whole part between such characters as part names, values and paths: '=', ':' and '/' too.
WEAK_ID = r"(?<![A-Za-z0-9+_-])(?=[A-Z]*[0-9])(?=[0-9]*[A-Z])[A-Z0-9]{16,40}+(?![A-Za-z0-9+_-])"
ENDPOINT = r"""https?://[^\x00-\x20"'<>|]+"""

_SPAN = "array<struct<kind:int,family:int,i:int,gap:int,n:int>>"


def _matches(text: Column, family: int, pattern: str, kind, group: int = 0) -> Column:
    """Array of (kind, family, i, gap, n) of the pattern's matches; kind null: counted for position, not kept.

    Gaps, matches and the group are zipped first: an expression named inside
    the lambda would be worked out again for every match.
    """
    found = F.regexp_extract_all(text, F.lit(pattern), 0)
    zipped = F.arrays_zip(found.alias("m"), F.split(text, pattern, -1).alias("gap"),
                          F.regexp_extract_all(text, F.lit(pattern), group).alias("g"))
    spans = F.transform(zipped, lambda x, i: F.struct(
        kind(x["m"], x["g"]).cast("int").alias("kind"), F.lit(family).alias("family"), i.cast("int").alias("i"),
        F.char_length(x["gap"]).alias("gap"), F.char_length(x["m"]).alias("n")))
    return F.filter(spans, lambda x: x["n"].isNotNull())  # the gap after the last match has none


def _marked(docs: DataFrame) -> DataFrame:
    """(doc_id, key, kind, family, i, gap, n): a marker row (family -1) per document row, and its matches."""
    text = F.coalesce(F.col("text"), F.lit(""))
    base = docs.select("doc_id", row_key(F.col("doc_id"), text).alias("key"), text.alias("t"))
    t = F.col("t")
    none = F.array().cast(_SPAN)
    run_kind = lambda x, g: F.when((F.char_length(x) >= 20) & x.rlike("[a-z]") & x.rlike("[A-Z]"), 4)
    # a path is no secret for the identifier in it: slashes beside identifiers part runs, lengths stay
    parted = F.when(t.rlike(WEAK_ID), F.regexp_replace(F.regexp_replace(
        t, F.lit(f"/(?={WEAK_ID})"), F.lit(" ")), F.lit(f"({WEAK_ID})/"), F.lit("$1 "))).otherwise(t)
    families = [
        (t.rlike(ASSIGN), _matches(t, 0, ASSIGN, lambda x, g: F.when(F.char_length(g) >= 6, 0), group=2)),
        (t.contains("AKIA"), _matches(t, 1, ACCESS, lambda x, g: F.when(F.char_length(x) >= 20, 1))),
        (t.rlike(HEX), _matches(t, 2, HEX, lambda x, g: F.lit(2))),
        (t.rlike("[0-9]"), _matches(parted, 3, RUN, run_kind)),
        (t.contains("://"), _matches(t, 4, ENDPOINT, lambda x, g: F.lit(5))),
        (t.rlike(WEAK_ID), _matches(t, 5, WEAK_ID, lambda x, g: F.lit(3))),
    ]
    marker = F.array(F.struct(F.lit(None).cast("int").alias("kind"), F.lit(-1).alias("family"), F.lit(0).alias("i"),
                              F.lit(0).alias("gap"), F.lit(0).alias("n")))
    spans = F.concat(marker.cast(_SPAN), *[F.when(test, found.cast(_SPAN)).otherwise(none) for test, found in families])
    return base.select("doc_id", "key", F.inline(spans))


def reported(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """(doc_id, key, copies, spans): one row per distinct document row.

    ``spans`` are structs (start, kind, end) in order, ``copies`` how often
    the row occurs. One shuffle: every window and the final grouping use the
    document key. A document's own matches are what one task holds of it.
    """
    rows = _marked(docs).groupBy("doc_id", "key", "kind", "family", "i", "gap", "n").agg(F.count("*").alias("copies"))
    doc = ["doc_id", "key"]
    ahead = Window.partitionBy(*doc, "family").orderBy("i").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.repartition(*doc).withColumn("end", F.sum(F.col("gap") + F.col("n")).over(ahead)) \
        .withColumn("start", F.col("end") - F.col("n")) \
        .where((F.col("family") < 0) | F.col("kind").isNotNull())
    up = Window.partitionBy(*doc).orderBy("start", "kind", "end").rowsBetween(Window.unboundedPreceding, -1)
    down = Window.partitionBy(*doc).orderBy(F.desc("start"), F.desc("kind"), F.desc("end")) \
        .rowsBetween(Window.unboundedPreceding, -1)
    base = F.col("kind") < 3
    covered = (F.coalesce(F.max(F.when(base, F.col("end"))).over(up) > F.col("start"), F.lit(False))
               | F.coalesce(F.min(F.when(base, F.col("start"))).over(down) < F.col("end"), F.lit(False)))
    rows = rows.withColumn("covered", covered).where((F.col("family") < 0) | base | ~F.col("covered"))

    def near(kinds: tuple[int, ...]) -> Column:
        part = F.col("kind").isin(*kinds)
        return (F.coalesce(F.max(F.when(part, F.col("end"))).over(up) >= F.col("start") - scope, F.lit(False))
                | F.coalesce(F.min(F.when(part, F.col("start"))).over(down) <= F.col("end") + scope, F.lit(False)))

    rows = rows.withColumn("by_id", near((1, 3))).withColumn("by_secret", near((0, 2, 4)))
    shown = (F.col("kind") < 3) | ((F.col("kind") == 3) & F.col("by_secret")) \
        | ((F.col("kind") == 4) & F.col("by_id")) | ((F.col("kind") == 5) & F.col("by_id") & F.col("by_secret"))
    return rows.groupBy(*doc).agg(
        F.max(F.when(F.col("family") < 0, F.col("copies"))).alias("copies"),
        F.array_sort(F.collect_list(F.when(shown, F.struct("start", "kind", "end")))).alias("spans"))


def _joined(spans: Column) -> Column:
    names = F.array(*[F.lit(k) for k in KINDS])
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(
        ":", F.element_at(names, s["kind"] + 1), s["start"].cast("string"), s["end"].cast("string"))), ",")


def secret_report(docs: DataFrame, scope: int = SCOPE) -> DataFrame:
    """One row per document row: doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_linked."""
    count = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("bigint")
    return reported(docs, scope).select(
        "doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"),
        sha256_hex(_joined(F.filter("spans", lambda s: s["kind"] < 3))).alias("base_sha256"),
        _joined(F.col("spans")).alias("spans"),
        F.size(F.filter("spans", lambda s: s["kind"] >= 3)).cast("bigint").alias("n_linked"),
        F.explode(F.array_repeat(F.lit(0), F.col("copies").cast("int"))).alias("copy")).drop("copy")


def redacted(docs: DataFrame, scope: int = SCOPE, mark: str = REDACTED) -> DataFrame:
    """All documents and columns; reported credentials in ``text`` become ``mark`` and n_chars follows the text.

    Endpoints stay, they are not secret by themselves. Overlapping spans are cut as one.
    """
    k, i, h, found = (fresh(docs, n) for n in ("ew_row", "ew_d", "ew_key", "ew_spans"))
    s = reported(docs, scope).select(F.col("doc_id").alias(i), F.col("key").alias(h), F.filter(
        "spans", lambda x: x["kind"] < 5).alias(found)).where(F.size(found) > 0)
    keyed = docs.withColumn(k, row_key(F.col("doc_id"), F.coalesce(F.col("text"), F.lit(""))))
    both = keyed.join(s, keyed["doc_id"].eqNullSafe(s[i]) & (keyed[k] == s[h]), "left")
    step = F.aggregate(
        found, F.struct(F.lit("").alias("out"), F.lit(0).cast("bigint").alias("at")),
        lambda acc, x: F.struct(
            F.when(x["start"] >= acc["at"], F.concat(acc["out"], F.substring(
                F.col("text"), (acc["at"] + 1).cast("int"), (x["start"] - acc["at"]).cast("int")), F.lit(mark)))
            .otherwise(acc["out"]).alias("out"),
            F.greatest(acc["at"], x["end"]).alias("at")))
    cut = F.concat(step["out"], F.substring(F.col("text"), (step["at"] + 1).cast("int"), F.lit(2147483647)))
    new = F.when(F.col(found).isNull(), F.col("text")).otherwise(cut)
    both = both.withColumn("text", new)
    if "n_chars" in docs.columns:
        both = both.withColumn("n_chars", F.when(F.col(found).isNull(), F.col("n_chars"))
                               .otherwise(F.char_length("text")).cast(docs.schema["n_chars"].dataType))
    return both.select(*[F.col(f"`{c}`") for c in docs.columns])


def _oracle_family(i: int, pattern: str, kind: str) -> str:
    p = pattern.replace("'", "''")
    return f"""SELECT doc_id, {kind} AS kind, s AS start, s + n AS "end" FROM (
  SELECT doc_id, m, g2, length(m) AS n,
         sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS s
  FROM (SELECT doc_id, z.i AS i, z.gap AS gap, z.m AS m, z.g2 AS g2
        FROM (SELECT doc_id, unnest(list_transform(list_zip(ms, gaps, g2s), lambda x, i: {{'i': i, 'm': x[1], 'gap': x[2], 'g2': x[3]}})) AS z
              FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS gaps,
                           regexp_extract_all(t, '{p}', {2 if i == 0 else 0}) AS g2s FROM docs))
        WHERE z.m IS NOT NULL))"""


def _oracle_runs() -> str:
    """Runs of key characters with their positions; SQL's regular expressions have no look-around."""
    p = "[A-Za-z0-9+/_-]+"
    return f"""SELECT doc_id, m, length(m) AS n, CAST(sum(length(gap) + length(m)) OVER (PARTITION BY doc_id ORDER BY i) - length(m) AS BIGINT) AS s
  FROM (SELECT doc_id, z.i AS i, z.gap AS gap, z.m AS m
        FROM (SELECT doc_id, unnest(list_transform(list_zip(ms, gaps), lambda x, i: {{'i': i, 'm': x[1], 'gap': x[2]}})) AS z
              FROM (SELECT doc_id, regexp_extract_all(t, '{p}') AS ms, string_split_regex(t, '{p}') AS gaps FROM docs)) WHERE z.m IS NOT NULL)"""


_ORACLE_KINDS = [
    (ASSIGN, "CASE WHEN length(g2) >= 6 THEN 0 END"),
    (ACCESS, "CASE WHEN n >= 20 THEN 1 END"),
    ("[0-9a-f]+", "CASE WHEN n >= 24 THEN 2 END"),
    (ENDPOINT, "5"),
]

ORACLE = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),
allspans AS ({" UNION ALL ".join(_oracle_family(i, p, k) for i, (p, k) in enumerate(_ORACLE_KINDS))}),
runs AS (SELECT doc_id, s, n, m FROM ({_oracle_runs()})),
segments AS (SELECT doc_id, s, n, z.j AS j, z.x AS x, s + sum(length(z.x) + 1) OVER (PARTITION BY doc_id, s ORDER BY z.j) - length(z.x) - 1 AS a,
                    length(z.x) BETWEEN 16 AND 40 AND regexp_full_match(z.x, '[A-Z0-9]+') AND regexp_matches(z.x, '[A-Z]')
                    AND regexp_matches(z.x, '[0-9]') AS is_id
             FROM (SELECT doc_id, s, n, unnest(list_transform(string_split(m, '/'), lambda x, j: {{'x': x, 'j': j}})) AS z FROM runs)),
parted AS (SELECT *, sum(CASE WHEN is_id OR before THEN 1 ELSE 0 END) OVER (PARTITION BY doc_id, s ORDER BY j) AS part
           FROM (SELECT *, coalesce(lag(is_id) OVER (PARTITION BY doc_id, s ORDER BY j), false) AS before FROM segments)),
parts AS (SELECT doc_id, part, CAST(min(a) AS BIGINT) AS a, string_agg(x, '/' ORDER BY j) AS x, max(a + length(x)) = s + n AS ends FROM parted GROUP BY doc_id, s, n, part),
rests AS (SELECT doc_id, a, x, CASE WHEN ends THEN substr(t, a + length(x) + 1) ELSE '' END AS rest
          FROM parts JOIN docs USING (doc_id) WHERE regexp_matches(x, '[0-9]') AND regexp_matches(x, '[a-z]') AND regexp_matches(x, '[A-Z]')),
nexts AS (SELECT *, regexp_extract(rest, '^=+/([A-Z0-9]{{16,40}})([^A-Za-z0-9+_-]|$)', 1) AS next FROM rests),
tails AS (SELECT doc_id, a, x, CASE WHEN regexp_matches(rest, '^=+([^A-Za-z0-9+/_=-]|$)') OR (regexp_matches(next, '[A-Z]') AND regexp_matches(next, '[0-9]'))
                 THEN regexp_extract(rest, '^=+') ELSE '' END AS eq FROM nexts),
weak AS (SELECT doc_id, 3 AS kind, a AS start, a + length(x) AS "end" FROM segments WHERE is_id UNION ALL
         SELECT doc_id, 4, a, a + length(x) + length(eq) FROM tails WHERE length(x) + length(eq) >= 20),
every AS (SELECT * FROM allspans UNION ALL SELECT * FROM weak),
base AS (SELECT * FROM allspans WHERE kind < 3),
cand AS (SELECT * FROM base UNION ALL
         SELECT * FROM every w WHERE kind >= 3 AND NOT EXISTS (
           SELECT 1 FROM base b WHERE b.doc_id = w.doc_id AND b.start < w."end" AND b."end" > w.start)),
ids AS (SELECT * FROM cand WHERE kind IN (1, 3)),
secs AS (SELECT * FROM cand WHERE kind IN (0, 2, 4)),
shown AS (SELECT * FROM cand c WHERE kind < 3
   OR (kind IN (3, 5) AND EXISTS (SELECT 1 FROM secs s WHERE s.doc_id = c.doc_id AND s.start <= c."end" + {SCOPE} AND s."end" >= c.start - {SCOPE})
       AND (kind = 3 OR EXISTS (SELECT 1 FROM ids s WHERE s.doc_id = c.doc_id AND s.start <= c."end" + {SCOPE} AND s."end" >= c.start - {SCOPE})))
   OR (kind = 4 AND EXISTS (SELECT 1 FROM ids s WHERE s.doc_id = c.doc_id AND s.start <= c."end" + {SCOPE} AND s."end" >= c.start - {SCOPE}))),
said AS (SELECT doc_id, kind, start, "end", concat_ws(':', list_extract({list(KINDS)!r}, kind + 1), CAST(start AS BIGINT), CAST("end" AS BIGINT)) AS s FROM shown),
agg AS (SELECT doc_id, count(*) FILTER (kind = 0) AS n_assign, count(*) FILTER (kind = 1) AS n_access,
               count(*) FILTER (kind = 2) AS n_hex, count(*) FILTER (kind >= 3) AS n_linked,
               string_agg(s, ',' ORDER BY start, kind) FILTER (kind < 3) AS b, string_agg(s, ',' ORDER BY start, kind) AS a
        FROM said GROUP BY doc_id)
SELECT doc_id, coalesce(n_assign, 0) AS n_assign, coalesce(n_access, 0) AS n_access, coalesce(n_hex, 0) AS n_hex,
       sha256(coalesce(b, '')) AS base_sha256, coalesce(a, '') AS spans, coalesce(n_linked, 0) AS n_linked
FROM docs LEFT JOIN agg USING (doc_id)
"""
