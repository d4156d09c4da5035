"""Scans of text files that keep malformed rows apart instead of failing or losing them.

Every scan returns one row per data line: the parsed columns, the line as it stands in
the file and ``reason``, null for a good row. ``good`` and ``bad`` are its two outputs. Comments and
blank lines are no data. The checks are column expressions, so one pass over the
file serves both outputs and a line can never be in both or in neither.

Reasons, the first that applies: ``fields`` (too few, for CSV too many as well),
``id`` (not a 64-bit integer), ``number`` (a counter is no finite number), ``label`` (neither Y nor N).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from edgewise.functions.features import COUNT_FEATURES, DERIVED_FEATURES, FEATURE_COLUMNS, derived_columns


def _long(text: Column) -> Column:
    """The integer that the text spells, null if it spells none or one beyond 64 bits."""
    return F.when(text.rlike(r"^[+-]?[0-9]{1,19}$"), text.try_cast("bigint"))


def _data_lines(spark: SparkSession, path: str) -> DataFrame:
    text = F.trim(F.col("value"))
    return spark.read.text(path).where((text != "") & ~text.startswith("#"))


def _checked(rows: DataFrame, tests: list[tuple[str, Column]]) -> Column:
    reason = F.lit(None).cast("string")
    for name, wrong in reversed(tests):
        reason = F.when(wrong, F.lit(name)).otherwise(reason)
    return reason.alias("reason")


def edge_rows(spark: SparkSession, path: str) -> DataFrame:
    """(src, dst, line, reason) of whitespace-separated lines; fields after the second are ignored."""
    rows = _data_lines(spark, path).select(F.col("value").alias("line"), F.split(F.trim("value"), r"\s+").alias("f"))
    src, dst = _long(F.get("f", F.lit(0))), _long(F.get("f", F.lit(1)))
    return rows.select(src.alias("src"), dst.alias("dst"), "line",
                       _checked(rows, [("fields", F.size("f") < 2), ("id", src.isNull() | dst.isNull())]))


def pair_rows(spark: SparkSession, path: str) -> DataFrame:
    """(u, v, label, line, reason) of ``u,v,label`` lines."""
    rows = _data_lines(spark, path).select(F.col("value").alias("line"), F.split("value", ",", -1).alias("f"))
    u, v, label = _long(F.trim(F.get("f", F.lit(0)))), _long(F.trim(F.get("f", F.lit(1)))), F.trim(F.get("f", F.lit(2)))
    return rows.select(u.alias("u"), v.alias("v"), label.alias("label"), "line", _checked(rows, [
        ("fields", F.size("f") != 3), ("id", u.isNull() | v.isNull()), ("label", ~label.isin("Y", "N"))]))


def feature_rows(spark: SparkSession, path: str) -> DataFrame:
    """The feature columns with line and reason; counters may be written as doubles, derived values are recomputed."""
    names = ["u", "v", *COUNT_FEATURES, *DERIVED_FEATURES, "label"]
    rows = _data_lines(spark, path).select(F.col("value").alias("line"), F.split("value", ",", -1).alias("f"))
    text = {n: F.trim(F.get("f", F.lit(i))) for i, n in enumerate(names)}

    def whole(n: str) -> Column:
        number = text[n].try_cast("double")
        return F.when(~F.isnan(number) & (F.abs(number) < 9e15), number.cast("bigint"))

    ids = whole("u").isNull() | whole("v").isNull()
    counters = F.greatest(*[whole(n).isNull() for n in COUNT_FEATURES])
    reason = _checked(rows, [("fields", F.size("f") != len(names)), ("id", ids), ("number", counters), ("label", ~text["label"].isin("Y", "N"))])
    parsed = rows.select(*[whole(n).alias(n) for n in ("u", "v", *COUNT_FEATURES)], text["label"].alias("label"), "line", reason)
    return parsed.select("*", *derived_columns()).select(*FEATURE_COLUMNS, "line", "reason")


def good(rows: DataFrame) -> DataFrame:
    """The parsed columns of the rows that passed."""
    return rows.where(F.col("reason").isNull()).drop("line", "reason")


def bad(rows: DataFrame) -> DataFrame:
    """(line, reason) of the others, as they stand in the file."""
    return rows.where(F.col("reason").isNotNull()).select("line", "reason")
