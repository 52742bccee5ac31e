"""Tables written in the folder that the driver and all executors share."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator
from fractions import Fraction

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Tables written by this process and not yet removed.
_mine: set[str] = set()


def shared_dir(spark: SparkSession) -> str:
    """The folder named by spark.checkpoint.dir; where that is unset and all runs on one machine (tests), a folder of our own."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir has to name a folder that the driver and all executors share")
        found = f"file://{tempfile.gettempdir()}/checkpoints/fieldloom"
    return found.rstrip("/")


def new_path(spark: SparkSession, name: str) -> str:
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    if not _mine:
        atexit.register(_sweep)
    _mine.add(path)
    return path


def _sweep() -> None:
    """At the end of the process, the tables that results may have needed until now."""
    spark = SparkSession.getActiveSession()
    if spark is not None:
        for path in list(_mine):
            with contextlib.suppress(Exception):  # the session may be gone already
                removed(spark, path)


@contextlib.contextmanager
def removed_after(spark: SparkSession) -> Iterator[set[str]]:
    """Removes at the end what was written meanwhile, but for the paths added to the set: for a caller that has used the result."""
    before, stay = set(_mine), set()
    try:
        yield stay
    finally:
        for path in _mine - before - stay:
            removed(spark, path)


def alike(a: str, b: str, rate: Fraction) -> Column:
    """Whether two lists without repeats have a Jaccard similarity of rate at least."""
    p, q = rate.as_integer_ratio()
    return (p + q) * F.size(F.array_intersect(a, b)) >= p * (F.size(a) + F.size(b))


#: A setting of Spark's: the shuffle files of a query go when it ends.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Another: bytes of a batch that goes to Python; rows by count alone are tens of MB, held in the JVM and in the worker.
BATCH, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", 4 << 20


@contextlib.contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """These settings of the session until the end."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def written(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    """df written as Parquet and read again, which cuts its lineage and survives lost executors; and its path.

    The shuffle files that df took are deleted once it is written, so that they don't add up over the stages.
    """
    spark = df.sparkSession
    path = new_path(spark, name)
    with settings(spark, {CLEANUP: "true", BATCH: str(BATCH_BYTES)}):
        df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def removed(spark: SparkSession, path: str) -> None:
    """Delete a table that nothing reads any more."""
    _mine.discard(path)
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsc.hadoopConfiguration()).delete(target, True)
