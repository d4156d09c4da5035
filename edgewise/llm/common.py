"""Helpers shared by the operators: scratch tables, document keys, text expressions."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

CHECKPOINT_KEY = "spark.checkpoint.dir"


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster shares; a local one only for a local master without the setting."""
    folder = spark.conf.get(CHECKPOINT_KEY, None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError(f"set {CHECKPOINT_KEY} to a folder that driver and executors share")
        folder = tempfile.mkdtemp(prefix="edgewise-shared-")
        spark.conf.set(CHECKPOINT_KEY, folder)
    return folder.rstrip("/")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder as Parquet and read it back: lineage ends here.

    The files outlive lost executors and go when the session's JVM ends.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    jvm = spark.sparkContext._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).deleteOnExit(where)
    return spark.read.schema(df.schema).parquet(path)


def dropped(df: DataFrame) -> None:
    """Delete the files of a table made by ``stored`` that nothing reads any more."""
    spark = df.sparkSession
    base = shared_folder(spark)
    for folder in {f.rsplit("/", 1)[0] for f in df.inputFiles()}:
        if base.split("://")[-1].split(":", 1)[-1].lstrip("/") in folder:
            where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


def fresh(df: DataFrame, name: str) -> str:
    """A column name that ``df`` does not have yet."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def ascii_lower(text: Column) -> Column:
    """Lower-case A-Z only; other letters stay as they are."""
    upper = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
    return F.when(F.octet_length(text) == F.char_length(text), F.lower(text)) \
        .otherwise(F.translate(text, upper, upper.lower()))


def row_key(doc_id: Column, text: Column) -> Column:
    """64-bit key of a document row: rows alike in id and text share it."""
    return F.xxhash64(doc_id, text)


def sha256_hex(value: Column) -> Column:
    return F.sha2(value.cast("binary"), 256)
