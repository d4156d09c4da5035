"""Hand-over between jobs: an output is written first and published when it is whole.

    out/CURRENT                 one small JSON object: the attempt that readers see, its run and its totals
    out/<attempt>/data/         the files of any writer of ``sources.files``
    out/<attempt>/parts/        the manifest (file, bytes, lines), a Parquet table of one row a data file

``publish`` writes a fresh attempt, takes its manifest from the files that are there and then replaces
CURRENT by a rename, the one step that readers can notice. A job that dies before it leaves what was
published untouched. The same ``run`` again finds its output published and writes nothing.

``location`` is what readers open: it compares the files with the manifest and refuses an output that
was never published or has lost, gained or changed a file since. ``lines`` are the lines of text files
(header lines included), the rows of Parquet ones.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

POINTER = "CURRENT"


class NotPublished(ValueError):
    """Nothing whole to read: no attempt was published, or its files are not those of its manifest."""


def publish(spark: SparkSession, out: str, run: str, write: Callable[[str], None], fmt: str = "text") -> bool:
    """Write by ``write(folder)`` and publish; False if ``run`` is published and whole already.

    ``run`` names what is written: the job, its inputs and parameters. ``fmt``: text or parquet.
    """
    if is_current(spark, out, run):
        return False
    attempt = f"attempt-{uuid.uuid4().hex[:12]}"
    data, parts = os.path.join(out, attempt, "data"), os.path.join(out, attempt, "parts")
    write(data)
    _manifest(spark, data, fmt).write.parquet(parts)
    total = spark.read.parquet(parts).agg(F.count(F.lit(1)).alias("files"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"),
                                          F.coalesce(F.sum("lines"), F.lit(0)).alias("lines")).first()
    _replace(spark, os.path.join(out, POINTER), json.dumps({"attempt": attempt, "run": run, **total.asDict()}))
    return True


def is_current(spark: SparkSession, out: str, run: str) -> bool:
    """Whether ``run`` is what readers of ``out`` see, whole."""
    try:
        location(spark, out)
    except NotPublished:
        return False
    return current(spark, out)["run"] == run


def current(spark: SparkSession, out: str) -> dict | None:
    """attempt, run, files, bytes and lines of the published output, None if there is none."""
    path = os.path.join(out, POINTER)
    fs, where = _fs(spark, path)
    return json.loads(spark.read.text(path, wholetext=True).first()["value"]) if fs.exists(where) else None


def manifest(spark: SparkSession, out: str) -> DataFrame:
    """(file, bytes, lines) of the published output."""
    seen = current(spark, out)
    if seen is None:
        raise NotPublished(f"{out}: nothing is published")
    return spark.read.schema("file string, bytes bigint, lines bigint").parquet(os.path.join(out, seen["attempt"], "parts"))


def faults(spark: SparkSession, out: str) -> DataFrame:
    """(file, fault): published files that are gone, others that came, files of another length."""
    said = manifest(spark, out).select("file", F.col("bytes").alias("said"))
    found = _files(spark, os.path.join(out, current(spark, out)["attempt"], "data"))
    fault = F.when(F.col("bytes").isNull(), "gone").when(F.col("said").isNull(), "extra").when(F.col("said") != F.col("bytes"), "length")
    return said.join(found, "file", "full").select("file", fault.alias("fault")).where("fault IS NOT NULL")


def location(spark: SparkSession, out: str) -> str:
    """The folder of the published files, checked against the manifest."""
    seen = current(spark, out)
    if seen is None:
        raise NotPublished(f"{out}: nothing is published")
    data = os.path.join(out, seen["attempt"], "data")
    for folder in (data, os.path.join(out, seen["attempt"], "parts")):
        fs, where = _fs(spark, folder)
        if not fs.exists(where):
            raise NotPublished(f"{folder}: gone")
    wrong = faults(spark, out).orderBy("file").limit(5).collect()
    if wrong:
        raise NotPublished(f"{data}: " + ", ".join(f"{r.file} ({r.fault})" for r in wrong))
    return data


def _files(spark: SparkSession, data: str) -> DataFrame:
    """(file, bytes) of a folder, from its listing alone."""
    return spark.read.format("binaryFile").load(data) \
        .select(F.regexp_extract("path", "[^/]+$", 0).alias("file"), F.col("length").alias("bytes"))


def _manifest(spark: SparkSession, data: str, fmt: str) -> DataFrame:
    reader = spark.read.text(data) if fmt == "text" else spark.read.parquet(data)
    lines = reader.groupBy(F.col("_metadata.file_name").alias("file")).agg(F.count(F.lit(1)).alias("lines"))
    return _files(spark, data).join(lines, "file", "left").select("file", "bytes", F.coalesce("lines", F.lit(0)).alias("lines"))


def _fs(spark: SparkSession, path: str):
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), where


def _replace(spark: SparkSession, path: str, text: str) -> None:
    """Put a small file in the place of another in one step."""
    new = f"{path}.{uuid.uuid4().hex[:12]}"
    fs, where = _fs(spark, new)
    stream = fs.create(where, False)
    stream.write(bytearray(text.encode()))
    stream.close()
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs
    over = spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 1)
    over[0] = getattr(hadoop, "Options$Rename").OVERWRITE
    target = fs.makeQualified(hadoop.Path(path))
    hadoop.FileContext.getFileContext(target.toUri(), spark.sparkContext._jsc.hadoopConfiguration()) \
        .rename(fs.makeQualified(where), target, over)
