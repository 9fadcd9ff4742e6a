"""Keyed tables that streaming jobs maintain: one folder of files per micro-batch.

A batch that is run again after a failure overwrites its own folder, so writes are
exactly-once without a transaction log. Readers combine the batches, either summing
signed changes or taking the newest value per key. ``compact`` folds batches that the
checkpoint has committed into one base folder, which is complete before any reader
looks at it; such batches are never run again, so no replay has to look inside it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T


def summed_changes(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """Doubles are sums of weights, which are exact in tenths: they are summed as decimals, so that a retracted
    key nets to zero and not to a rest of binary fractions."""
    if isinstance(rows.schema[value].dataType, T.DoubleType):
        total = F.sum(F.col(value).cast("decimal(18,1)")).cast("double")
    else:
        total = F.sum(value)
    return rows.groupBy(*keys).agg(total.alias(value)).where(F.col(value) != 0)


def newest_rows(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    w = Window.partitionBy(*keys).orderBy(F.desc("batch"))
    return rows.withColumn("_r", F.rank().over(w)).where(F.col("_r") == 1).drop("_r")


class BatchTable:
    def __init__(self, spark: SparkSession, path: str, schema: str | T.StructType):
        self.spark = spark
        self.path = path.rstrip("/")
        self.schema = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        self._full = T.StructType([*self.schema.fields, T.StructField("batch", T.LongType())])

    def append(self, rows: DataFrame, batch_id: int) -> None:
        columns = [f.name for f in self.schema.fields]
        rows.select(*columns).write.mode("overwrite").parquet(f"{self.path}/log/batch={batch_id}")

    def read(self, before: int | None = None) -> DataFrame:
        """All entries with their ``batch``, optionally only of batches before one.

        A base that holds batch ``before`` or later ones cannot be cut at it: that is an
        error and not a wrong answer. ``compact`` with ``upto`` never makes such a base.
        """
        base, log = self._layout()
        frames = []
        if base is not None:
            if before is not None and base >= before:
                raise ValueError(f"batch {before} is folded into the base of batch {base} already")
            frames.append(self._load("base", [base]))
        later = [b for b in log if before is None or b < before]
        if later:
            frames.append(self._load("log", later))
        if not frames:
            return self.spark.createDataFrame([], self._full)
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def totals(self, keys: Sequence[str], value: str, before: int | None = None) -> DataFrame:
        """Sum of signed changes per key; keys that net to zero are gone."""
        return summed_changes(self.read(before), keys, value)

    def latest(self, keys: Sequence[str], before: int | None = None) -> DataFrame:
        """The rows of the newest batch that wrote each key (whole-value replacement)."""
        return newest_rows(self.read(before), keys)

    def compact(self, reduce: Callable[[BatchTable], DataFrame], upto: int | None = None) -> None:
        """Fold the batches up to ``upto`` into a new base.

        ``reduce`` is ``totals`` or ``latest`` with its arguments bound. While a job runs
        batch b, ``upto`` is b - 1: all before b is committed, b itself may run again. Without
        ``upto`` everything is folded, which is for tables whose job has ended for good. The
        folded folders stay for readers that already opened them, until ``vacuum``.
        """
        _, log = self._layout()
        log = [b for b in log if upto is None or b <= upto]
        if log:
            columns = [f.name for f in self.schema.fields]
            older = _Until(self, log[-1] + 1)
            reduce(older).select(*columns).write.mode("overwrite").parquet(f"{self.path}/base/batch={log[-1]}")

    def tidy(self, reduce: Callable[[BatchTable], DataFrame], batch_id: int, every: int) -> None:
        """Called by a job at the start of a batch: compaction every ``every`` batches, and
        the folders that the base before last has made obsolete go."""
        if every and batch_id and batch_id % every == 0:
            self.vacuum()
            self.compact(reduce, upto=batch_id - 1)

    def vacuum(self) -> None:
        """Delete what the newest base has made obsolete. Call it when no reader or
        running batch can still hold an older layout."""
        base, _ = self._layout()
        if base is not None:
            fs, folders = self._folders("log")
            stale = [(fs, path) for batch, path in folders if batch <= base]
            fs, folders = self._folders("base")
            stale += [(fs, path) for batch, path in folders if batch < base]
            for fs, path in stale:
                fs.delete(path, True)

    def _load(self, part: str, batches: Sequence[int]) -> DataFrame:
        root = f"{self.path}/{part}"
        paths = [f"{root}/batch={b}" for b in batches]
        return self.spark.read.schema(self._full).option("basePath", root).parquet(*paths)

    def _layout(self) -> tuple[int | None, list[int]]:
        """Newest finished base, and the finished batches after it."""
        bases = self._finished("base", -1)
        base = bases[-1] if bases else None
        return base, self._finished("log", -1 if base is None else base)

    def _finished(self, part: str, after: int) -> list[int]:
        """Batches with a ``_SUCCESS`` file, by one listing of all of them."""
        fs, _ = self._folders(part)
        marks = fs.globStatus(self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}/batch=*/_SUCCESS"))
        return sorted(b for b in (int(m.getPath().getParent().getName()[6:]) for m in marks or ()) if b > after)

    def _folders(self, part: str):
        root = self.spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{part}")
        fs = root.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf())
        if not fs.exists(root):
            return fs, []
        paths = [status.getPath() for status in fs.listStatus(root)]
        return fs, [(int(p.getName()[6:]), p) for p in paths if p.getName().startswith("batch=")]


@contextmanager
def stream_settings(spark: SparkSession) -> Iterator[None]:
    """Settings a query picks up when it starts: state in RocksDB, and no batches without
    data, which state with a processing-time TTL would otherwise ask for for ever."""
    wanted = {
        "spark.sql.streaming.stateStore.providerClass": (
            "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
        ),
        "spark.sql.streaming.noDataMicroBatches.enabled": "false",
    }
    before = {key: spark.conf.get(key) for key in wanted}
    try:
        for key, value in wanted.items():
            spark.conf.set(key, value)
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


class _Until:
    """A table as it was before a batch, for the reducers of ``compact``."""

    def __init__(self, table: BatchTable, before: int):
        self._table, self._before = table, before

    def read(self) -> DataFrame:
        return self._table.read(self._before)

    def totals(self, keys: Sequence[str], value: str) -> DataFrame:
        return self._table.totals(keys, value, self._before)

    def latest(self, keys: Sequence[str]) -> DataFrame:
        return self._table.latest(keys, self._before)


def served_table(spark: SparkSession, path: str, schema: T.StructType) -> BatchTable:
    """A served table: the records of a key are replaced together and expire together."""
    return BatchTable(spark, path, T.StructType([*schema.fields, T.StructField("expire_at", T.LongType())]))


def put(table: BatchTable, rows: DataFrame, batch_id: int, as_of: int, ttl_seconds: int) -> None:
    """Keyed upsert: the keys in ``rows`` get these records and a new expiry, all other keys stay.

    One folder per put, so readers see all of it or nothing, and a repeated put replaces itself.
    """
    table.append(rows.withColumn("expire_at", F.lit(as_of + ttl_seconds).cast("long")), batch_id)


def get_alive(table: BatchTable, keys: Sequence[str], as_of: int) -> DataFrame:
    """The newest records of every key that have not expired."""
    return table.latest(keys).drop("batch").where(F.col("expire_at") > as_of)
