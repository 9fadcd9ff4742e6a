"""Session settings the operators rely on, and the shared scratch folder."""

from __future__ import annotations

import ctypes
import functools
import tempfile
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A hot user or item must be split even when the next aggregation could have
    # reused the join's partitioning; the extra exchange is the cheaper choice.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}

_made: list[str] = []


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime settings above to a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


#: Text that a task hands to Python at once. By rows alone it is 10,000 texts, held by the executor's buffers and by Python.
BATCH_BYTES = 4 << 20


def bounded_batches(spark: SparkSession) -> None:
    """Batches for Python end at ``BATCH_BYTES``, so that what a task holds does not grow with the length of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


_TRIM = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only glibc has it


def give_back() -> None:
    """Hand memory that Arrow and the C library keep for later back to the system."""
    pa.default_memory_pool().release_unused()
    if _TRIM is not None:
        _TRIM(0)


def given_back(result):
    """``result``, after a step inside a Python worker."""
    give_back()
    return result


def lean(task: Callable) -> Callable:
    """``task`` (batches to batches) whose Python worker keeps no freed memory. Workers wait idle for later stages, and all of
    them take turns, so what each keeps counts against the executor until the job ends."""

    def run(batches):
        try:
            yield from task(batches)
        finally:
            give_back()

    return run


def local_session(cpus: int = 8, name: str = "footfall", partitions: int | None = None) -> SparkSession:
    """A local session for tests and benches; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(name)
        .config("spark.sql.shuffle.partitions", str(partitions or cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Plans are built from many small expressions; skip the call-site capture of each.
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


@functools.cache
def _local_base() -> str:
    return tempfile.mkdtemp(prefix="footfall-")


def shared_base(spark: SparkSession) -> str:
    """The folder that driver and executors share.

    ``spark.checkpoint.dir`` names it, or else ``SparkContext.setCheckpointDir``. Only a
    local session, where every task sees the driver's disk, may fall back to a temporary
    folder; on a cluster that would silently lose the parts other machines wrote.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local["):
        raise RuntimeError("set spark.checkpoint.dir to a folder that driver and executors share")
    return _local_base()


def shared_folder(spark: SparkSession, purpose: str) -> str:
    """A new folder below the shared one, owned by this session until ``release``."""
    path = f"{shared_base(spark)}/footfall/{purpose}-{uuid.uuid4().hex}"
    _made.append(path)
    return path


def materialize(rows: DataFrame, purpose: str) -> DataFrame:
    """Write an intermediate table to the shared folder and read it back: cuts lineage
    and lets several outputs share one computation, and survives lost executors."""
    spark = rows.sparkSession
    path = shared_folder(spark, purpose)
    rows.write.parquet(path)
    out = spark.read.schema(rows.schema).parquet(path)
    out._written = path
    return out


def _delete(spark: SparkSession, paths: list[str]) -> None:
    hadoop = spark._jsparkSession.sessionState().newHadoopConf()
    for name in reversed(paths):
        _made.remove(name)
        path = spark._jvm.org.apache.hadoop.fs.Path(name)
        path.getFileSystem(hadoop).delete(path, True)


def discard(rows: DataFrame) -> None:
    """Delete one table that ``materialize`` wrote, once nothing reads it any more."""
    if rows._written in _made:
        _delete(rows.sparkSession, [rows._written])


def release(spark: SparkSession, since: int = 0) -> None:
    """Delete the intermediates made so far; call it when their results are written."""
    _delete(spark, _made[since:])


@contextmanager
def scratch(spark: SparkSession) -> Iterator[Callable[[DataFrame], DataFrame]]:
    """Intermediates made inside are deleted at the end: one job, one micro-batch.

    Yields ``keep``: a table that ``materialize`` made inside and that goes through it stays, and belongs to the block around.
    """
    outer, kept = set(_made), set()

    def keep(rows: DataFrame) -> DataFrame:
        kept.add(rows._written)
        return rows

    try:
        yield keep
    finally:
        _delete(spark, [path for path in _made if path not in outer and path not in kept])
