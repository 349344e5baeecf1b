"""Session defaults, and the package's code on the executors."""

from __future__ import annotations

import atexit
import functools
import tempfile
import uuid
import zipfile
from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Settings of sessions that this library builds itself.
DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
}

_shipped: set[str] = set()


def build(master: str = "local[*]", shuffle_partitions: int | None = None, **settings: str) -> SparkSession:
    """A session with the library's defaults; ``settings`` use __ for dots."""
    builder = SparkSession.builder.master(master).appName("corpusloom").config(map=DEFAULTS)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


#: Rows of an Arrow batch at most: texts may be long, and a worker holds a few batches at a time.
BATCH_ROWS = 1000
_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch"


def ship(spark: SparkSession) -> None:
    """Sends this package to the executors, once per application: Python code there imports it. Larger Arrow batches than BATCH_ROWS are reduced to it."""
    context = spark.sparkContext
    if not 0 < int(spark.conf.get(_BATCH)) <= BATCH_ROWS:
        spark.conf.set(_BATCH, str(BATCH_ROWS))
    if context.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parent
    out = Path(tempfile.mkdtemp(prefix="corpusloom-code-")) / "corpusloom_code.zip"
    with zipfile.ZipFile(out, "w") as archive:
        for path in sorted(root.rglob("*.py")):
            archive.write(path, f"{root.name}/{path.relative_to(root)}")
    context.addPyFile(str(out))
    _shipped.add(context.applicationId)


def shared_path(spark: SparkSession, purpose: str) -> str:
    """A new folder under the session's checkpoint folder (a temporary one only where none is named), removed when the driver ends."""
    named = spark.conf.get("spark.checkpoint.dir", None) or "file://" + tempfile.gettempdir()
    path = f"{named.rstrip('/')}/corpusloom-{purpose}-{uuid.uuid4().hex}"

    def remove() -> None:
        try:
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(place, True)
        except Exception:  # the session has ended: nothing to remove it with
            return

    atexit.register(remove)
    return path


def checkpointed(df: DataFrame) -> DataFrame:
    """``df``, written to the session's checkpoint folder (a temporary one only where none is named) and cut from its lineage."""
    context = df.sparkSession.sparkContext
    if context._jsc.sc().getCheckpointDir().isEmpty():
        named = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        context.setCheckpointDir(named or "file://" + tempfile.mkdtemp(prefix="corpusloom-checkpoint-"))
    return df.checkpoint()


def shipped(query: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    """The query, with the package sent ahead of it."""

    @functools.wraps(query)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        ship(spark)
        return query(spark, sf_dir)

    return run
