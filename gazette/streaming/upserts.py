"""Incremental runs: keyed upsert of micro-batches, and de-duplication with bounded state."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.operators.upsert import upsert


#: Buckets that a table's keys are dealt to; a batch rewrites those it touches.
BUCKETS = 64
#: Every so many batches the log gets a list of all buckets, from which it is read on.
SUMMED = 20


class UpsertSink:
    """``foreachBatch`` sink that keeps a keyed table in buckets of the key's hash.

    Each batch writes a new version of the buckets it touches, beside the old one, and then names it; all others stay as they
    are. A batch that is repeated after a failure gives the same rows, and a half-written version is never named.
    """

    def __init__(self, spark: SparkSession, path: str, key: list[str], seq: list[str], now: str, buckets: int = BUCKETS):
        self.spark, self.path, self.key, self.seq, self.now, self.buckets = spark, path.rstrip("/"), key, seq, now, buckets

    def _hadoop(self, path: str):
        at = self.spark._jvm.org.apache.hadoop.fs.Path(path)
        return at, at.getFileSystem(self.spark._jsc.hadoopConfiguration())

    def _log(self) -> list[tuple[int, bool, str]]:
        """(batch, whether it names all buckets, folder) of the versions that were named, oldest first."""
        at, files = self._hadoop(f"{self.path}/versions")
        if not files.exists(at):
            return []
        named = [f.getPath() for f in files.listStatus(at) if files.exists(self.spark._jvm.org.apache.hadoop.fs.Path(f.getPath(), "_SUCCESS"))]
        parts = [(p.getName().split("-"), p.toString()) for p in named]
        return sorted((int(n[0]), len(n) > 1, path) for n, path in parts)

    def _newest(self, before: int | None = None) -> dict[int, str]:
        """The folder of each bucket as of the last batch, or the last before a batch."""
        log = [x for x in self._log() if before is None or x[0] < before]
        whole = max((i for i, x in enumerate(log) if x[1]), default=0)
        if not log:
            return {}
        named = self.spark.read.schema("batch long, bucket int, data string").json([path for _, _, path in log[whole:]])
        newest = named.groupBy("bucket").agg(F.max(F.struct("batch", "data")).getField("data").alias("data"))
        return {r.bucket: r.data for r in newest.collect()}  # a row a bucket

    def _name(self, names: dict[int, str], batch_id: int, suffix: str = "") -> None:
        """A repeated batch names its buckets again, in place of the first time."""
        rows = [(batch_id, b, data) for b, data in sorted(names.items())]
        self.spark.createDataFrame(rows, "batch long, bucket int, data string").coalesce(1).write.mode("overwrite").json(f"{self.path}/versions/{batch_id:012d}{suffix}")

    def _read(self, folders: dict[int, str]) -> DataFrame | None:
        return self.spark.read.parquet(*[folders[b] for b in sorted(folders)]) if folders else None

    def current(self, before: int | None = None) -> DataFrame | None:
        return self._read(self._newest(before))

    def merged(self, old: DataFrame | None, new: DataFrame) -> DataFrame:
        """The touched buckets' rows after a batch; there are no old ones at first."""
        now = F.lit(self.now).cast("timestamp")
        if old is None:
            old = self.spark.createDataFrame([], new.schema).withColumn("first_seen", now)
        return upsert(old, new, self.key, self.seq, now)

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        bucket = F.pmod(F.xxhash64(*self.key), F.lit(self.buckets)).cast("int")
        known = batch.dropna(subset=self.key)
        touched = {r[0] for r in known.select(bucket).distinct().collect()}  # a row a bucket
        if not touched:
            return
        old = self._read({b: d for b, d in self._newest(batch_id).items() if b in touched})
        data = f"{self.path}/data/{batch_id}-{uuid.uuid4().hex[:8]}"
        self.merged(old, known).withColumn("_bucket", bucket).write.partitionBy("_bucket").parquet(data)
        self._name({b: f"{data}/_bucket={b}" for b in touched}, batch_id)
        if batch_id % SUMMED == SUMMED - 1:
            self._name(self._newest(), batch_id, "-all")

    def clean(self) -> int:
        """Deletes the buckets' versions that no batch needs, after readers of old ones are done; gives their number.

        The last batch may be repeated, so what it read stays, too. The log before the last list of all buckets goes.
        """
        at, files = self._hadoop(f"{self.path}/data")
        log = self._log()
        if not log or not files.exists(at):
            return 0
        last = log[-1][0]
        needed = [*self._newest().values(), *self._newest(last).values()]
        kept = {d.split("/data/", 1)[1] for d in needed}
        gone = 0
        for version in files.listStatus(at):
            for bucket in files.listStatus(version.getPath()):
                name = f"{version.getPath().getName()}/{bucket.getPath().getName()}"
                if bucket.isDirectory() and name not in kept:
                    gone += bool(files.delete(bucket.getPath(), True))
        whole = max((x[0] for x in log if x[1] and x[0] < last), default=0)
        for batch, _, path in log:
            if batch < whole:
                files.delete(self._hadoop(path)[0], True)
        return gone


def parquet_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream of a table's files; the table may be a folder or a single file."""
    schema = spark.read.parquet(path).schema
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    reader = spark.readStream.schema(schema)
    if at.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(at).isFile():
        return reader.option("pathGlobFilter", at.getName()).parquet(at.getParent().toString())
    return reader.parquet(path)


def run_available(stream: DataFrame, sink: UpsertSink, checkpoint: str) -> DataFrame:
    """Takes all that is there, then stops; the next run goes on from the checkpoint."""
    query = stream.writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    found = sink.current()
    return found if found is not None else sink.spark.createDataFrame([], stream.schema)


def dedup_stream(stream: DataFrame, key: list[str], time: str, keep: str = "30 days") -> DataFrame:
    """The first event of each key; state is dropped after ``keep``."""
    return stream.withWatermark(time, keep).dropDuplicatesWithinWatermark(key)
