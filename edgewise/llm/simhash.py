"""SimHash near-duplicates by segment-popcount embedding and a grid range join.

A fingerprint of 64 bits is cut into 32 segments of two bits; the embedding is
the vector of the segments' bit counts. The Manhattan distance of two vectors
is at most the Hamming distance of the fingerprints, so it is a lower bound.
Points within Manhattan distance ``MAX_BITS`` = 2 agree exactly on all but two
of five blocks of coordinates; the grid therefore has one cell per choice of
three blocks (ten cells a point), and two linked points share at least one
cell. Points that share a cell are compared: Manhattan bound first, then the
exact bit distance.

A cell with more than ``CELL_PAIRS`` points is not paired. Its points emit
themselves and their 64 one-bit neighbours; two fingerprints share such a key
exactly if they differ in two bits or fewer. Each key links its points to the
smallest one: the same components, 65 rows a point and no pairs.

Copies are one point: fingerprints are made distinct before the grid.
Defined cases: null or wordless texts have fingerprint zero and link like any
other; fewer words than a shingle are one shingle; rows without an id get the
component of their text; an empty table gives an empty result; further
columns are ignored by the report and kept by ``without_near_duplicates``.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from edgewise.llm.common import fresh, row_key, stored
from edgewise.llm.components import connected_components

SHINGLE = 3
MAX_BITS = 2
SEED = 42
#: Larger cells are linked by one-bit neighbours instead of pairs.
CELL_PAIRS = 32

_LOWER = bytes.maketrans(b"ABCDEFGHIJKLMNOPQRSTUVWXYZ", b"abcdefghijklmnopqrstuvwxyz")
_EVEN = 0x5555555555555555
#: First segments of the five blocks of the 32 segments.
_BLOCKS = [range(0, 7), range(7, 14), range(14, 20), range(20, 26), range(26, 32)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def shingle_hashes(text: str | None, k: int = SHINGLE) -> list[int]:
    """XXH64 of every shingle of ``k`` words, repeats included."""
    from xxhash import xxh64_intdigest

    words = (text or "").encode().translate(_LOWER).split()
    if not words:
        return []
    line = b" ".join(words)
    if len(words) <= k:
        return [xxh64_intdigest(line, SEED)]
    end = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    start = np.concatenate(([0], end[:-1] + 1))
    return [xxh64_intdigest(line[s:e], SEED) for s, e in zip(start[: len(words) - k + 1].tolist(), end[k - 1:].tolist())]


def fingerprint(hashes: list[int]) -> int:
    """Signed 64-bit fingerprint: a bit is set if more than half of the hashes have it."""
    ones, n = np.zeros(64, np.int64), len(hashes)
    for at in range(0, n, 1 << 16):
        h = np.array(hashes[at: at + (1 << 16)], np.uint64)
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(2 * ones > n, bitorder="little").view(np.int64)[0])


def fingerprints(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """(doc_id, fp) of every document row."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [fingerprint(shingle_hashes(t.as_py(), k)) for t in b.column("text")]
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp, pa.int64())], ["doc_id", "fp"])

    id_type = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {id_type}, fp bigint")


def _cells(fp: Column) -> Column:
    """The ten grid cells of a point: bit counts of the segments of three blocks, packed two bits each."""
    even = F.lit(_EVEN)
    up = F.shiftrightunsigned(fp, 1)
    packed = F.shiftleft(fp.bitwiseAND(up).bitwiseAND(even), 1).bitwiseOR(fp.bitwiseXOR(up).bitwiseAND(even))
    masks = [sum(3 << (2 * s) for block in kept for s in block) for kept in combinations(_BLOCKS, 3)]
    return F.array(*[packed.bitwiseAND(F.lit(_signed(m))) for m in masks])


def _manhattan(a: Column, b: Column) -> Column:
    """Distance of the bit-count vectors: a segment counts one if either bit, two if both are set."""
    def thermometer(x: Column) -> tuple[Column, Column]:
        up = F.shiftrightunsigned(x, 1)
        return x.bitwiseOR(up).bitwiseAND(F.lit(_EVEN)), x.bitwiseAND(up).bitwiseAND(F.lit(_EVEN))

    return reduce(lambda x, y: x + y, [F.bit_count(p.bitwiseXOR(q)) for p, q in zip(thermometer(a), thermometer(b))])


def fingerprint_links(points: DataFrame, cell_pairs: int = CELL_PAIRS) -> DataFrame:
    """Links (a, b) among distinct fingerprints (fp) whose components are those of bit distance 2 or less."""
    cells = points.select("fp", F.posexplode(_cells(F.col("fp"))).alias("grid", "cell"))
    shared = cells.groupBy("grid", "cell").agg(F.count("*").alias("n")).where(F.col("n") > 1)
    members = stored(cells.join(shared, ["grid", "cell"]), "cells")
    few = members.where(F.col("n") <= cell_pairs)
    x = few.select("grid", "cell", F.col("fp").alias("a"))
    y = few.select("grid", "cell", F.col("fp").alias("b"))
    a, b = F.col("a"), F.col("b")
    pairs = x.join(y, ["grid", "cell"]).where((a < b) & (_manhattan(a, b) <= MAX_BITS)) \
        .where(F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS).select("a", "b")
    many = members.where(F.col("n") > cell_pairs).select("fp").distinct()
    flips = [0] + [_signed(1 << i) for i in range(64)]
    keys = many.select("fp", F.explode(F.array(*[F.col("fp").bitwiseXOR(F.lit(f)) for f in flips])).alias("key"))
    least = keys.groupBy("key").agg(F.min("fp").alias("b"), F.count("*").alias("n")).where(F.col("n") > 1)
    stars = keys.join(least, "key").select(F.col("fp").alias("a"), "b").where(a != b) \
        .where(F.bit_count(a.bitwiseXOR(b)) <= MAX_BITS)
    return pairs.unionAll(stars).distinct()


def near_duplicates(docs: DataFrame, k: int = SHINGLE, cell_pairs: int = CELL_PAIRS) -> DataFrame:
    """One row per document row: doc_id, fingerprint, component_id (smallest doc_id reachable)."""
    own = stored(fingerprints(docs, k), "fingerprints")
    classes = own.groupBy("fp").agg(F.min("doc_id").alias("least"))
    linked = connected_components(fingerprint_links(classes.select("fp"), cell_pairs))
    joined = classes.join(linked, F.col("fp") == F.col("node"))
    groups = joined.groupBy("component").agg(F.min("least").alias("group_least"))
    moved = joined.join(groups, "component").select(F.col("fp").alias("linked_fp"), "group_least")
    ids = stored(classes.join(moved, F.col("fp") == F.col("linked_fp"), "left")
                 .select(F.col("fp").alias("class_fp"), F.when(F.col("linked_fp").isNull(), F.col("least"))
                         .otherwise(F.col("group_least")).alias("component_id")), "classes")
    return own.join(ids, F.col("fp") == F.col("class_fp")) \
        .select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def without_near_duplicates(docs: DataFrame, k: int = SHINGLE) -> DataFrame:
    """One document row of each group, all columns kept: the smallest id, then the smallest key of id and text.

    Rows that share an id but not the text are documents of their own; rows alike in id and text are one.
    Rows without an id stay.
    """
    i, h, own = (fresh(docs, c) for c in ("ew_kept_id", "ew_kept_key", "ew_own_key"))
    key = row_key(F.col("doc_id"), F.col("text"))
    named = docs.select(F.struct(F.col("doc_id").isNull().alias("unnamed"), F.col("doc_id").alias("id"), key.alias("key")).alias("doc_id"), "text")
    kept = near_duplicates(named, k).where(F.col("doc_id") == F.col("component_id")) \
        .select(F.col("doc_id.id").alias(i), F.col("doc_id.key").alias(h)).distinct()
    keyed = docs.withColumn(own, key)
    rows = keyed.join(kept, keyed["doc_id"].eqNullSafe(kept[i]) & (keyed[own] == kept[h]), "left_semi")
    rows = rows.where(F.col("doc_id").isNotNull()).dropDuplicates(["doc_id", own]).drop(own)
    return rows.unionByName(docs.where(F.col("doc_id").isNull())).select(*[F.col(f"`{c}`") for c in docs.columns])
