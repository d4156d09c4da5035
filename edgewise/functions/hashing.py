"""Deterministic pair hash used by every reproducible sampler.

The hash is plain BIGINT arithmetic, so the same value comes out of a
Spark Column expression and of a SQL string evaluated by another engine.
Random generators (``rand()``, ``sample(seed)``) are kept for users who
do not need cross-engine reproducibility.
"""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the hash (must stay identical in Spark and in SQL).
MODULUS = 2147483647
MULT_A = 48271
MULT_B = 16807
MIX = 69621
INC = 7
INC_2 = 11
INC_3 = 13
WIDE = 1009

# Fixed seeds of the sampling / split jobs.
SEED_TRAIN = 0x3133F
SEED_TEST = 0xE1337
SEED_SPLIT = 0x1312


def _c(x) -> Column:
    if isinstance(x, Column):
        return x.cast("bigint")
    if isinstance(x, str):
        return F.col(x).cast("bigint")
    return F.lit(int(x)).cast("bigint")


def pair_hash(a, b, seed) -> Column:
    """h(a, b, seed) in [0, MODULUS) for non-negative a, b (seed: int or Column).

    An affine map of (a, b, seed) mod M, then square -> affine -> square,
    each mod M. Every intermediate is < M < 2^31, so squares stay < 2^62
    (no BIGINT overflow in either engine). The squarings matter: with an
    affine hash, two seeds differ by a constant shift, so a split hash
    would be fully correlated with the hash that selected the sample.
    """
    m = F.lit(MODULUS).cast("bigint")
    x = ((_c(a) % m) * MULT_A + (_c(b) % m) * MULT_B + _c(seed)) % m
    x = (x * x + INC) % m
    x = (x * MIX + INC_2) % m
    return (x * x + INC_3) % m


def pair_hash_sql(a, b, seed) -> str:
    m = MODULUS
    x = (f"(((CAST({a} AS BIGINT) % {m}) * {MULT_A} + (CAST({b} AS BIGINT) % {m}) * {MULT_B}"
         f" + CAST({seed} AS BIGINT)) % {m})")
    x = f"(({x} * {x} + {INC}) % {m})"
    x = f"(({x} * {MIX} + {INC_2}) % {m})"
    return f"(({x} * {x} + {INC_3}) % {m})"


def wide_hash(a, b, seed) -> Column:
    """62-bit hash from two independent combinations of (a, b): for positions beyond 2^31."""
    return pair_hash(a, b, seed) * F.lit(1 << 31) + pair_hash(b, a, _c(seed) + F.lit(WIDE))


def wide_hash_sql(a, b, seed) -> str:
    return f"({pair_hash_sql(a, b, seed)} * {1 << 31} + {pair_hash_sql(b, a, f'({seed} + {WIDE})')})"


def threshold(fraction: float) -> int:
    """Integer cut-off: keep a row when its hash is below this value."""
    return int(fraction * MODULUS)


def poisson_thresholds(lam: float) -> list[int]:
    """T_k = round(MODULUS * P(X <= k)) for X ~ Poisson(lam), until it reaches MODULUS.

    A row gets ``#{k : T_k <= h}`` copies, i.e. a Poisson(lam) number of copies.
    """
    out, cdf, k, term = [], 0.0, 0, math.exp(-lam)
    while True:
        cdf += term
        t = round(MODULUS * cdf)
        if t >= MODULUS:
            break
        out.append(t)
        k += 1
        term *= lam / k
    return out


def poisson_copies(h: Column, lam: float) -> Column:
    expr = F.lit(0)
    for t in poisson_thresholds(lam):
        expr = expr + F.when(h >= F.lit(t), 1).otherwise(0)
    return expr


def poisson_copies_sql(h: str, lam: float) -> str:
    return "(" + " + ".join(f"CASE WHEN {h} >= {t} THEN 1 ELSE 0 END"
                            for t in poisson_thresholds(lam)) + ")"
