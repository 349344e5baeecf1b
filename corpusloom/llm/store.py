"""Tables written to the shared folder that the cluster names in spark.checkpoint.dir.

Writing and rereading cuts lineage: a lost executor later costs the reading of
a file again, never the work before it.  Each use has a folder of its own.
"""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid
from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; one of its own only where the session names none, as in tests."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    own = spark.conf.get("corpusloom.scratch", None)
    if own is None:
        own = "file://" + tempfile.mkdtemp(prefix="corpusloom-")
        spark.conf.set("corpusloom.scratch", own)
    return own


@contextlib.contextmanager
def small_batches(spark: SparkSession, rows: int) -> Iterator[None]:
    """Arrow batches of at most ``rows`` rows for what is written meanwhile: rows with long texts or sets stay within memory."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, str(rows))
    try:
        yield
    finally:
        spark.conf.set(name, before)


class Scratch:
    """A folder of written tables, removed when the driver ends or on :meth:`drop`."""

    def __init__(self, spark: SparkSession, purpose: str) -> None:
        self.spark = spark
        self.path = f"{shared_folder(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"
        atexit.register(self.drop)

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """``df``, written as Parquet and read again."""
        df.write.mode("overwrite").parquet(self.at(name))
        return self.spark.read.schema(df.schema).parquet(self.at(name))

    def drop(self, name: str = "") -> None:
        """Removes one table, or the whole folder."""
        try:
            jvm = self.spark.sparkContext._jvm
            path = jvm.org.apache.hadoop.fs.Path(self.at(name) if name else self.path)
            path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        except Exception:  # the session has ended: nothing to remove it with
            return
