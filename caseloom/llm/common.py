"""Helpers shared by the training-data operators.

Durable intermediate tables go to the folder the cluster names in ``spark.checkpoint.dir``: a lost
executor then costs a re-read, and the lineage of later steps starts at a file scan.
"""

from __future__ import annotations

import gc
import os
import tempfile
import uuid

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ByteType, IntegerType, LongType, ShortType

#: Bytes between words: space and the ASCII controls tab to carriage return (the contract's word class).
SPACE_CLASS = r"[\x20\x09-\x0D]+"
_WRITTEN: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The cluster's shared scratch folder; a temporary one of our own only where none is configured and driver and
    executors are one process. A cluster without a shared folder is an error: no other machine could read the files."""
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if spark.sparkContext.master.split("[")[0] != "local":
        raise RuntimeError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
    return "file://" + os.path.join(tempfile.gettempdir(), f"caseloom-{os.getpid()}")


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{shared_dir(spark)}/caseloom/{label}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` once to the shared folder and return a scan of what was written."""
    path = scratch_path(df.sparkSession, label)
    _WRITTEN.append(path)
    df.write.option("parquet.writer.version", "v2").parquet(path)  # v2 delta-encodes ids and offsets
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(df: DataFrame) -> None:
    """Delete the files of a :func:`materialize` result that no later step reads."""
    spark = df.sparkSession
    root = f"{shared_dir(spark)}/caseloom/"
    folders = {root + f.split("/caseloom/", 1)[1].split("/", 1)[0] for f in df.inputFiles() if "/caseloom/" in f}
    for folder in folders:
        path = spark._jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def sweep(spark: SparkSession) -> None:
    """Delete every intermediate table that this process wrote. Results are lazy and read some of them, so this is for
    the caller, once what it wanted is written."""
    for path in _WRITTEN:
        folder = spark._jvm.org.apache.hadoop.fs.Path(path)
        folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)
    _WRITTEN.clear()


def release_shuffles(spark: SparkSession) -> None:
    """Ask the driver's JVM to collect finished plans, so that Spark's cleaner drops their shuffle files.

    The scheduler's threads hold on to the last job until they see another, so a job of one row goes first.
    """
    gc.collect()
    spark.range(1).write.format("noop").mode("overwrite").save()
    spark._jvm.System.gc()


def ship_package(spark: SparkSession) -> None:
    """Let Python workers import this package even when it is not installed on them."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(x for x in (known, root) if x)


def small_batches(spark: SparkSession, rows: int = 512) -> None:
    """Bound Arrow batches of whole texts by rows and bytes, so that a Python worker's memory is bounded."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))


def let(value: Column, body) -> Column:
    """Bind ``value`` to a lambda variable, so that ``body`` evaluates it once per row however often it is used."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def unsigned_bucket(doc_id: Column, modulo: int) -> Column:
    """crc32 of the id's decimal text, modulo ``modulo``: the fold of a document. A null id falls in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % F.lit(modulo)


def unused(docs: DataFrame, name: str) -> str:
    """``name``, longer by underscores until no column of ``docs`` is called so (Spark ignores case)."""
    taken = {c.lower() for c in docs.columns}
    while name.lower() in taken:
        name += "_"
    return name


def integer_id(docs: DataFrame, id_col: str) -> Column:
    """The id as a long. Ids of other types than whole numbers are refused: a cast would turn them into nulls."""
    kind = docs.schema[id_col].dataType
    if not isinstance(kind, (ByteType, ShortType, IntegerType, LongType)):
        raise TypeError(f"{id_col} is {kind.simpleString()}; ids must be whole numbers")
    return F.col(id_col).cast("long")


def split_id(name: str) -> tuple[Column, Column]:
    """A long id as pandas can hold it: the id, 0 where null, and ``no_id``. A null would turn a batch into floats,
    which lose digits over 2**53."""
    return F.coalesce(F.col(name), F.lit(0)).alias(name), F.col(name).isNull().alias("no_id")


def split_ids(name: str) -> tuple[Column, Column]:
    """An array of long ids like :func:`split_id`, with ``no_ids``."""
    return F.transform(name, lambda x: F.coalesce(x, F.lit(0))).alias(name), F.transform(name, F.isnull).alias("no_ids")


def joined_id(ids: np.ndarray, absent: np.ndarray) -> pd.arrays.IntegerArray:
    """Ids with their nulls again."""
    return pd.arrays.IntegerArray(np.array(ids, np.int64), np.array(absent, bool))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def bounded_sample(rows: DataFrame, key: str, stratum: str, most: int) -> DataFrame:
    """About ``most`` rows of each stratum (all of a smaller one), drawn by a hash of ``key``: reruns draw the same.

    The strata are few by nature (languages, labels); their counts come to the driver. Rows with a null stratum are
    left out.
    """
    rows = rows.where(F.col(stratum).isNotNull())
    counts = rows.groupBy(stratum).count().collect()
    scale = 1 << 30
    limit = F.lit(None).cast("long")
    for value, n in counts:
        limit = F.when(F.col(stratum) == F.lit(value), F.lit(scale if n <= most else scale * most // n)).otherwise(limit)
    return rows.where(F.pmod(F.xxhash64(F.lit("sample"), F.col(key)), F.lit(scale)) < limit)
