"""Keyed tables cut into buckets, so that a micro-batch touches only the buckets its keys fall in.

A row's bucket is a hash of its key columns. Every micro-batch writes one log folder with a subfolder per bucket, as
``BatchTable`` does one folder per batch; a replay overwrites its own. Lookups open the folders of the buckets that the wanted
keys fall in and no others. Folding rewrites the buckets the log has rows for; each other bucket keeps the base folder it has.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from footfall.streaming.store import BatchTable, newest_rows, summed_changes

BUCKETS = 64


class KeyedTable(BatchTable):
    """``keys`` decide the bucket; what is unique within a key is up to the caller.

    ``files`` is the number of files a bucket gets per write, for tables whose keys can hold very many rows. The
    numbers of buckets and files belong to the table: open it with the same ``buckets`` always.
    """

    def __init__(
        self, spark: SparkSession, path: str, schema: str | T.StructType, keys: Sequence[str], buckets: int = BUCKETS, files: int = 1
    ):
        super().__init__(spark, path, schema)
        self.keys, self.buckets, self.files = list(keys), buckets, files
        # A folded bucket always has a row without values: an empty one hides the older base folders of the bucket.
        kept = [T.StructField("_seal", T.BooleanType())]
        placed = [T.StructField("batch", T.LongType()), T.StructField("bucket", T.IntegerType())]
        self._stored = T.StructType([*self.schema.fields, *kept, *placed])

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("int")

    def touched(self, rows: DataFrame) -> list[int]:
        """The buckets that rows with the key columns fall in: at most ``buckets`` numbers."""
        return sorted(r[0] for r in rows.select(self.bucket().alias("_b")).distinct().collect())

    def append(self, rows: DataFrame, batch_id: int) -> None:
        self._write(rows.withColumn("_seal", F.lit(False)), f"{self.path}/log/batch={batch_id}")

    def read(self, before: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        """Entries with their ``batch``, of all buckets or of some."""
        base, log = self._layout()
        if before is not None and base is not None and base >= before:
            raise ValueError(f"batch {before} is folded into the base of batch {base} already")
        wanted = None if buckets is None else set(buckets)
        paths = [f"{self.path}/base/batch={b}/bucket={k}" for k, b in self._homes(base).items() if wanted is None or k in wanted]
        frames = [self._open("base", paths)] if paths else []
        log = {b for b in log if before is None or b < before}
        paths = [f"{self.path}/log/batch={b}/bucket={k}" for b, k in self._parts("log") if b in log and (wanted is None or k in wanted)]
        frames += [self._open("log", paths)] if paths else []
        if not frames:
            return self.spark.createDataFrame([], self._full)
        return frames[0] if len(frames) == 1 else frames[0].unionByName(frames[1])

    def read_touched(self, batch_id: int) -> DataFrame:
        """Entries up to a batch that is written already, of the buckets that it wrote to."""
        return self.read(batch_id + 1, [k for b, k in self._parts("log") if b == batch_id])

    def totals(self, keys: Sequence[str], value: str, before: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        return summed_changes(self.read(before, buckets), keys, value)

    def latest(self, keys: Sequence[str], before: int | None = None, buckets: Iterable[int] | None = None) -> DataFrame:
        return newest_rows(self.read(before, buckets), keys)

    def lookup(self, keys: DataFrame, before: int | None = None) -> DataFrame:
        """Entries of the given keys, which have (some of) this table's columns and all its key columns."""
        on = [c for c in keys.columns if c in self.schema.names]
        return self.read(before, self.touched(keys)).join(keys.select(*on).distinct(), on, "left_semi")

    def compact(self, reduce: Callable[[BatchTable], DataFrame], upto: int | None = None) -> None:
        """Fold the batches up to ``upto``; ``reduce`` sees, and rewrites, the buckets they have rows in."""
        _, log = self._layout()
        log = [b for b in log if upto is None or b <= upto]
        if not log:
            return
        folded = set(log)
        buckets = sorted({k for b, k in self._parts("log") if b in folded})
        rows = reduce(_Part(self, log[-1] + 1, buckets)).select(*self.schema.names)
        rows = rows.withColumn("_seal", F.lit(False)).withColumn("_b", self.bucket())
        empty = [F.lit(None).cast(f.dataType).alias(f.name) for f in self.schema.fields]
        seals = self.spark.createDataFrame([(k,) for k in buckets], "_b int").select(*empty, F.lit(True).alias("_seal"), "_b")
        self._write(rows.unionByName(seals), f"{self.path}/base/batch={log[-1]}", F.col("_b"))

    def vacuum(self) -> None:
        base, _ = self._layout()
        if base is None:
            return
        fs, folders = self._folders("log")
        for batch, path in folders:
            if batch <= base:
                fs.delete(path, True)
        homes = self._homes(base)
        alive = set(homes.values())
        for batch, k in self._parts("base"):
            if batch in alive and batch < homes[k]:
                fs.delete(self._path(f"{self.path}/base/batch={batch}/bucket={k}"), True)
        for batch, path in self._folders("base")[1]:
            if batch < base and batch not in alive:
                fs.delete(path, True)

    def _write(self, rows: DataFrame, path: str, bucket: Column | None = None) -> None:
        columns = [*self.schema.names, "_seal"]
        rows = rows.select(*columns, (self.bucket() if bucket is None else bucket).alias("bucket"))
        spread = [F.pmod(F.xxhash64(*self.schema.names), F.lit(self.files))] if self.files > 1 else []
        rows = rows.repartition(F.col("bucket"), *spread)
        rows.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(path)

    def _open(self, part: str, paths: Sequence[str]) -> DataFrame:
        rows = self.spark.read.schema(self._stored).option("basePath", f"{self.path}/{part}").parquet(*paths)
        return rows.where(~F.col("_seal")).drop("_seal", "bucket")

    def _parts(self, part: str) -> list[tuple[int, int]]:
        """(batch, bucket) of every bucket folder, by one listing."""
        found = self._folders(part)[0].globStatus(self._path(f"{self.path}/{part}/batch=*/bucket=*"))
        paths = [status.getPath() for status in found or ()]
        return sorted((int(p.getParent().getName()[6:]), int(p.getName()[7:])) for p in paths)

    def _homes(self, base: int | None) -> dict[int, int]:
        """The newest finished base folder of every bucket."""
        if base is None:
            return {}
        finished = set(self._finished("base", -1))
        return {k: b for b, k in self._parts("base") if b in finished}

    def _path(self, path: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(path)


class _Part:
    """Some buckets of a table as they were before a batch, for the reducers of ``compact``."""

    def __init__(self, table: KeyedTable, before: int, buckets: Sequence[int]):
        self._table, self._before, self._buckets = table, before, buckets

    def read(self) -> DataFrame:
        return self._table.read(self._before, self._buckets)

    def totals(self, keys: Sequence[str], value: str) -> DataFrame:
        return self._table.totals(keys, value, self._before, self._buckets)

    def latest(self, keys: Sequence[str]) -> DataFrame:
        return self._table.latest(keys, self._before, self._buckets)
