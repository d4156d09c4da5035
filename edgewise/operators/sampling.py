"""Reproducible candidate-pair sampling.

Every random choice is a deterministic hash (``functions.hashing``), so
the same pairs come out on any cluster size and in any SQL engine.

* vertex sample: hash threshold; its size follows the graph (a cap is a parameter)
* positives: edges, each with a Poisson(lam) number of copies
* hard negatives: ends of length-2 paths a -> b -> c (a <> c). Each edge
  a -> b draws one of b's out-neighbours uniformly by hash (the next one
  if that is a): a join with a dense index of b's out-neighbours -- no path
  enumeration, so a hub b never produces in(b) * out(b) rows. Real edges
  are left out unless asked for.
* easy negatives: uniform draws of positions in the endpoint multiset
  (degree-weighted) or in the sampled vertex list (uniform).

Caps (``take`` in the original jobs) keep the rows with the smallest
hash; ``cap_by_hash`` finds them with a bounded histogram first, so the
final ordering step sees about ``cap`` rows, not the whole input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from edgewise.functions.hashing import (
    MODULUS, SEED_SPLIT, pair_hash, poisson_copies, poisson_thresholds, threshold, wide_hash,
)
from edgewise.operators.bounded import bounded_broadcast
from edgewise.operators.graph import induced_subgraph, vertices_of
from edgewise.operators.skew import MAX_HUBS, hub_bound, hub_table, lookup
from edgewise.session import cut_lineage

HIST_BUCKETS = 1 << 16
INDEX_BUCKET_ROWS = 1 << 16      # rows that are numbered together in an index
COARSE_BUCKETS = 1 << 10         # buckets whose totals make one coarse total
NEIGHBOUR_CHUNK = 200_000        # a longer list of neighbours is numbered in several parts

# Fixed sampler parameters of the original jobs. The caps and draws bound the
# labelled rows that the classifiers are fitted on; every function takes its own.
VERTEX_FRACTION = 0.25
POSITIVE_RATE = 0.20
CAP_EASY_WEIGHTED = 3_000
DRAWS_EASY_WEIGHTED = 5_500
CAP_EASY_UNIFORM = 2_000
DRAWS_EASY_UNIFORM = 3_000
CAP_HARD = 5_000
CAP_POSITIVE = 10_000


def cap_by_hash(df: DataFrame, hcol: str, tiebreak: list[str], cap: int,
                buckets: int = HIST_BUCKETS) -> DataFrame:
    """The ``cap`` rows with the smallest (hcol, *tiebreak).

    A histogram of ``hcol`` (at most ``buckets`` rows reach the driver)
    gives the bucket that holds the cap-th row; only rows up to that
    bucket enter the final ordered limit. The input is written once for the two
    passes, and so is the (at most ``cap``-row) result.
    """
    width = MODULUS // buckets + 1
    b = (F.col(hcol) / F.lit(width)).cast("bigint")
    df = cut_lineage(df)
    hist = df.groupBy(b.alias("_b")).count().collect()
    total, cut = 0, None
    for row in sorted(hist, key=lambda r: r["_b"]):
        total += row["count"]
        if total >= cap:
            cut = row["_b"]
            break
    pruned = df if cut is None else df.where(b <= F.lit(cut))
    return cut_lineage(pruned.orderBy(F.col(hcol), *[F.col(c) for c in tiebreak]).limit(cap))


def vertex_sample(edges: DataFrame, seed: int, fraction: float = VERTEX_FRACTION,
                  cap: int | None = None) -> DataFrame:
    """(id, h): vertices kept by hash threshold; with ``cap`` the smallest hashes only."""
    v = vertices_of(edges).select("id", pair_hash("id", 0, seed).alias("h"))
    v = v.where(F.col("h") < F.lit(threshold(fraction)))
    return cap_by_hash(v, "h", ["id"], cap) if cap else v


def sampled_subgraph(edges: DataFrame, seed: int, fraction: float = VERTEX_FRACTION,
                     cap: int | None = None) -> tuple[DataFrame, DataFrame]:
    vs = vertex_sample(edges, seed, fraction, cap)
    return vs, induced_subgraph(edges, vs)


def positive_pairs(edges: DataFrame, seed: int, rate: float = POSITIVE_RATE,
                   cap: int | None = CAP_POSITIVE) -> DataFrame:
    """Edges drawn with replacement: Poisson(rate) copies each, label 'Y'."""
    h = pair_hash("src", "dst", seed)
    e = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"), h.alias("h"))
    # the first threshold alone decides whether there are copies: they are counted for these rows only, not inside the filter
    least = next(iter(poisson_thresholds(rate)), MODULUS)
    e = e.where(F.col("h") >= F.lit(least)).withColumn("copies", poisson_copies(F.col("h"), rate))
    e = e.select("u", "v", "h", F.explode(F.sequence(F.lit(1), F.col("copies"))).alias("copy"))
    if cap:
        e = cap_by_hash(e, "h", ["u", "v", "copy"], cap)
    return e.select("u", "v", F.lit("Y").alias("label"))


def neighbour_index(edges: DataFrame, seed: int, chunk: int = NEIGHBOUR_CHUNK) -> DataFrame:
    """(b, idx, c): b's out-neighbours numbered from 0 in the order of (hash, c).

    A list beyond ``chunk`` is cut into ranges of the hash, as many as its length asks for; a range is
    numbered by itself and the ranges' counts give the offsets. Ranges keep the order, so their number
    never changes an index.
    """
    e = edges.select(F.col("src").alias("b"), F.col("dst").alias("c"), pair_hash("dst", "src", seed).alias("h"))
    hubs = _long_lists(edges, "src", chunk).select(F.col("id").alias("b"), "salts")
    e = e.join(bounded_broadcast(hubs, MAX_HUBS), "b", "left") \
        .withColumn("part", F.floor(F.col("h") * F.coalesce("salts", F.lit(1)) / F.lit(MODULUS))).drop("salts")
    before = Window.partitionBy("b").orderBy("part")
    parts = e.groupBy("b", "part").agg(F.count(F.lit(1)).alias("n")) \
        .select("b", "part", (F.sum("n").over(before) - F.col("n")).alias("off"))
    rank = F.row_number().over(Window.partitionBy("b", "part").orderBy("h", "c"))
    return (e.withColumn("rank", rank).join(parts, ["b", "part"])
             .select("b", (F.col("off") + F.col("rank") - 1).alias("idx"), "c"))


def _long_lists(edges: DataFrame, end: str, chunk: int) -> DataFrame:
    """(id, salts) of the hubs at an end of the edges: MAX_HUBS of them at most."""
    degrees = edges.groupBy(F.col(end).alias("id")).agg(F.count(F.lit(1)).alias("n"))
    return cut_lineage(hub_table(degrees, "n", hub_bound(edges.count(), chunk)))


def two_hop_pairs(edges: DataFrame, seed: int, chunk: int = NEIGHBOUR_CHUNK) -> DataFrame:
    """(u, v): distinct length-2 path ends, one uniformly drawn end per edge u -> b."""
    out = edges.groupBy(F.col("src").alias("b")).agg(F.count(F.lit(1)).alias("out"))
    e = lookup(edges.select(F.col("src").alias("u"), F.col("dst").alias("b")), "b", out, _long_lists(edges, "dst", chunk))
    e = e.withColumn("idx", wide_hash("u", "b", seed) % F.col("out"))
    index = cut_lineage(neighbour_index(edges, seed, chunk))
    first = cut_lineage(e.join(index, ["b", "idx"]))
    back = first.where((F.col("c") == F.col("u")) & (F.col("out") > 1)) \
        .select("u", "b", ((F.col("idx") + 1) % F.col("out")).alias("idx"))
    ends = first.where(F.col("c") != F.col("u")).select("u", "c").unionAll(back.join(index, ["b", "idx"]).select("u", "c"))
    return ends.select("u", F.col("c").alias("v")).distinct()


def hard_negatives(edges: DataFrame, seed: int, cap: int | None = CAP_HARD,
                   exclude_edges: bool = True) -> DataFrame:
    p = two_hop_pairs(edges, seed)
    if exclude_edges:
        p = non_edge_guard(p, edges)
    p = p.withColumn("h", pair_hash("u", "v", seed))
    if cap:
        p = cap_by_hash(p, "h", ["u", "v"], cap)
    return p.select("u", "v", F.lit("N").alias("label"))


def non_edge_guard(pairs: DataFrame, edges: DataFrame) -> DataFrame:
    """Pairs that are not edges (anti join on the composite key)."""
    e = edges.select(F.col("src").alias("u"), F.col("dst").alias("v"))
    return pairs.join(e, ["u", "v"], "left_anti")


def _draws(spark, n: int, length: int, seed: int, s1: int, s2: int) -> DataFrame:
    d = spark.range(n).select(F.col("id").alias("i"))
    d = d.select("i", (wide_hash("i", s1, seed) % F.lit(length)).alias("i1"),
                 (wide_hash("i", s2, seed) % F.lit(length)).alias("i2"))
    return d.where(F.col("i1") != F.col("i2"))


def _resolve_draws(indexed: DataFrame, draws: DataFrame, cap: int) -> DataFrame:
    """indexed: (idx, vertex) of the positions drawn. draws: (i, i1, i2)."""
    hit = _slots(draws).join(indexed, "idx")
    pairs = hit.groupBy("i").agg(F.max(F.when(F.col("slot") == 1, F.col("vertex"))).alias("u"),
                                 F.max(F.when(F.col("slot") == 2, F.col("vertex"))).alias("v"))
    return pairs.orderBy("i").limit(cap).select("u", "v", F.lit("N").alias("label"))


def _slots(draws: DataFrame) -> DataFrame:
    return draws.select("i", F.inline(F.array(
        F.struct(F.col("i1").alias("idx"), F.lit(1).alias("slot")),
        F.struct(F.col("i2").alias("idx"), F.lit(2).alias("slot")))))


def rows_at(rows: DataFrame, order: list[str], positions: DataFrame, n_positions: int,
            bucket_rows: int = INDEX_BUCKET_ROWS, coarse: int = COARSE_BUCKETS) -> DataFrame:
    """The ``rows`` at the given 0-based ``positions`` (idx) of the order of (h, *order), with idx.

    ``h`` (a pair hash) is cut into equal ranges, about one per ``bucket_rows`` rows, and ``coarse`` ranges make a
    coarse one. Prefix sums of the coarse totals find the coarse range of each position, prefix sums inside
    the coarse ranges that were hit find its range, and only the rows of ranges that were hit are
    numbered. Ranges keep the order, so their number never changes which row stands where.
    """
    buckets = max(1, -(-rows.count() // bucket_rows))       # one scalar
    bucket = F.floor(F.col("h") * F.lit(buckets) / F.lit(MODULUS))
    counts = cut_lineage(rows.groupBy(bucket.alias("_bucket")).agg(F.count(F.lit(1)).alias("_n"))
                         .withColumn("_coarse", F.floor(F.col("_bucket") / F.lit(coarse))))
    totals = counts.groupBy("_coarse").agg(F.sum("_n").alias("_t"))
    starts = totals.select("_coarse", (F.sum("_t").over(Window.orderBy("_coarse")) - F.col("_t")).alias("_start"))
    # one row a coarse range and position: the last range that starts at or before the position
    at = positions.select("idx").distinct().select("idx", F.lit(None).cast("bigint").alias("_coarse"), F.col("idx").alias("_at"), F.lit(1).alias("_o"))
    both = at.unionByName(starts.select(F.lit(None).cast("bigint").alias("idx"), "_coarse", F.col("_start").alias("_at"), F.lit(0).alias("_o")))
    last = Window.orderBy("_at", "_o", "_coarse")
    placed = both.withColumn("_c", F.last("_coarse", ignorenulls=True).over(last)) \
        .withColumn("_s", F.max(F.when(F.col("_o") == 0, F.col("_at"))).over(last)).where("idx IS NOT NULL") \
        .select("idx", F.col("_c").alias("_coarse"), (F.col("idx") - F.col("_s")).alias("_rest"))
    inner = counts.join(bounded_broadcast(placed.select("_coarse").distinct(), n_positions), "_coarse") \
        .withColumn("_off", F.sum("_n").over(Window.partitionBy("_coarse").orderBy("_bucket")) - F.col("_n"))
    hit = cut_lineage(inner.join(placed, "_coarse").where((F.col("_rest") >= F.col("_off")) & (F.col("_rest") < F.col("_off") + F.col("_n")))
                      .select("_bucket", "idx", (F.col("_rest") - F.col("_off") + 1).alias("_rank")))
    some = rows.withColumn("_bucket", bucket).join(bounded_broadcast(hit.select("_bucket").distinct(), n_positions), "_bucket", "left_semi")
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("h", *order))
    return some.withColumn("_rank", rank).join(bounded_broadcast(hit, n_positions), ["_bucket", "_rank"]).drop("_bucket", "_rank")


def _endpoints(edges: DataFrame) -> DataFrame:
    """(src, dst, tag, vertex, h): every edge endpoint occurrence; the hash's seed is the side, so both ends spread."""
    ep = edges.select("src", "dst", F.inline(F.array(
        F.struct(F.lit(0).alias("tag"), F.col("src").alias("vertex")),
        F.struct(F.lit(1).alias("tag"), F.col("dst").alias("vertex")))))
    return ep.withColumn("h", pair_hash("src", "dst", F.col("tag")))


def dense_index(rows: DataFrame, order: list[str], bucket_rows: int = INDEX_BUCKET_ROWS) -> DataFrame:
    """All ``rows`` with idx: the 0-based position in the order of (h, *order), numbered range by range of ``h``."""
    buckets = max(1, -(-rows.count() // bucket_rows))       # one scalar
    rows = rows.withColumn("_bucket", F.floor(F.col("h") * F.lit(buckets) / F.lit(MODULUS)))
    counts = rows.groupBy("_bucket").agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select("_bucket", (F.sum("_n").over(Window.orderBy("_bucket")) - F.col("_n")).alias("_off"))
    rank = F.row_number().over(Window.partitionBy("_bucket").orderBy("h", *order))
    return (rows.withColumn("_rank", rank).join(bounded_broadcast(offsets, buckets), "_bucket")
                .withColumn("idx", F.col("_off") + F.col("_rank") - 1).drop("_bucket", "_off", "_rank"))


def endpoint_index(edges: DataFrame, bucket_rows: int = INDEX_BUCKET_ROWS) -> DataFrame:
    """(idx, vertex): every edge endpoint occurrence with a dense 0-based index, ordered by (hash, src, dst, tag)."""
    return dense_index(_endpoints(edges), ["src", "dst", "tag"], bucket_rows).select("idx", "vertex")


def easy_negatives_weighted(edges: DataFrame, seed: int, n_draws: int = DRAWS_EASY_WEIGHTED,
                            cap: int = CAP_EASY_WEIGHTED, bucket_rows: int = INDEX_BUCKET_ROWS) -> DataFrame:
    """Pairs of uniformly drawn endpoint occurrences (degree-weighted vertices)."""
    spark = edges.sparkSession
    length = 2 * edges.count()          # one scalar
    if length == 0:
        return spark.createDataFrame([], "u bigint, v bigint, label string")
    draws = _draws(spark, n_draws, length, seed, 1, 2)
    found = rows_at(_endpoints(edges), ["src", "dst", "tag"], _slots(draws), 2 * n_draws, bucket_rows)
    return cut_lineage(_resolve_draws(found.select("idx", "vertex"), draws, cap))


def easy_negatives_uniform(vertices: DataFrame, seed: int, n_draws: int = DRAWS_EASY_UNIFORM,
                           cap: int = CAP_EASY_UNIFORM, bucket_rows: int = INDEX_BUCKET_ROWS) -> DataFrame:
    """Pairs of uniformly drawn sampled vertices. ``vertices``: (id, h) from ``vertex_sample``."""
    spark = vertices.sparkSession
    length = vertices.count()       # one scalar
    if length == 0:
        return spark.createDataFrame([], "u bigint, v bigint, label string")
    draws = _draws(spark, n_draws, length, seed, 3, 4)
    found = rows_at(vertices.select("id", "h"), ["id"], _slots(draws), 2 * n_draws, bucket_rows)
    return cut_lineage(_resolve_draws(found.select("idx", F.col("id").alias("vertex")), draws, cap))


def labelled_pairs(vertices: DataFrame, subgraph: DataFrame, seed: int) -> DataFrame:
    """(u, v, label) on a sampled subgraph: weighted and uniform easy negatives,
    hard negatives, positives."""
    return (easy_negatives_weighted(subgraph, seed)
            .unionByName(easy_negatives_uniform(vertices, seed))
            .unionByName(hard_negatives(subgraph, seed))
            .unionByName(positive_pairs(subgraph, seed)))


def split_column(seed: int = SEED_SPLIT, fractions=(0.6, 0.2, 0.2)) -> F.Column:
    """0 = train, 1 = validation, 2 = test, by hash of (u, v)."""
    h = pair_hash("u", "v", seed)
    t1 = threshold(fractions[0])
    t2 = threshold(fractions[0] + fractions[1])
    return F.when(h < t1, 0).when(h < t2, 1).otherwise(2)


def train_val_test_split(df: DataFrame, seed: int = SEED_SPLIT, fractions=(0.6, 0.2, 0.2)) -> DataFrame:
    return df.withColumn("split", split_column(seed, fractions))
