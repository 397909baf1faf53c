"""Runs of the windowed ingest: from windows to a keyed table, its progress, its status, and what is published.

The progress of an ingest is in its query's checkpoint; ``progress`` shows it as a table.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gazette.operators.normalize import valid
from gazette.operators.upsert import changed
from gazette.sources import ingest as source
from gazette.streaming.upserts import UpsertSink

#: Where a record stands in all that was ever fetched; the last write of a key wins.
SEQUENCE = ["ordinal", "page", "index"]
#: Ends of a run that are no failures: the next run goes on.
NO_FAILURE = {"budget", "daily_quota"}


def _offsets(spark: SparkSession, checkpoint: str) -> DataFrame | None:
    """id, offset (JSON) of each planned batch; None before the first run."""
    try:
        files = spark.read.text(f"{checkpoint.rstrip('/')}/offsets", wholetext=True)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise
    named = files.select(F.col("_metadata.file_name").try_cast("long").alias("id"), F.get(F.split("value", "\n"), 2).alias("offset"))
    return named.where("id is not null and offset like '{%'")


def last_offset(spark: SparkSession, checkpoint: str) -> dict:
    """The offset up to which batches are planned; Spark repeats the last one if it wasn't committed."""
    found = _offsets(spark, checkpoint)
    last = found.agg(F.max_by("offset", "id")).first()[0] if found is not None else None
    return json.loads(last) if last else source.empty_offset()


def progress(spark: SparkSession, checkpoint: str) -> DataFrame:
    """window, pages, ordinal, batch, committed: the windows of an ingest's batches, those of open months once for each run."""
    schema = "window string, pages int, ordinal long, batch long, committed boolean"
    found = _offsets(spark, checkpoint)
    if found is None:
        return spark.createDataFrame([], schema)
    try:
        commits = spark.read.text(f"{checkpoint.rstrip('/')}/commits", wholetext=True).select(F.col("_metadata.file_name").try_cast("long").alias("id")).dropna()
    except AnalysisException:
        commits = spark.createDataFrame([], "id long")
    # Elements are [window, pages, ordinal].
    batch = F.from_json(F.get_json_object("offset", "$.batch"), "array<array<string>>")
    each = found.select("id", F.explode(batch).alias("w")).join(commits.withColumn("committed", F.lit(True)), "id", "left")
    return each.select(F.get("w", 0).alias("window"), F.get("w", 1).cast("int").alias("pages"), F.get("w", 2).cast("long").alias("ordinal"), F.col("id").alias("batch"), F.coalesce("committed", F.lit(False)).alias("committed"))


def planned(spark: SparkSession, lanes: list[str], start: str, as_of: str) -> DataFrame:
    """window, resumable: all windows of a range."""
    months = spark.range(1).select(F.explode(F.sequence(F.lit(f"{start}-01").cast("date"), F.trunc(F.lit(as_of).cast("date"), "month"), F.expr("interval 1 month"))).alias("m"))
    each = months.select("m", F.explode(F.array(*map(F.lit, lanes))).alias("lane"))
    return each.select(F.concat_ws("|", "lane", F.date_format("m", "yyyyMMddHHmm")).alias("window"), (F.add_months("m", 1) <= F.lit(as_of).cast("date")).alias("resumable"))


def pending(spark: SparkSession, checkpoint: str, lanes: list[str], start: str, as_of: str) -> DataFrame:
    """The windows that a next run would ask for: not done, not beyond the service's range."""
    ended = last_offset(spark, checkpoint)["ended"]
    rows = planned(spark, lanes, start, as_of)
    done = progress(spark, checkpoint).where("committed").select("window").distinct().withColumn("resumable", F.lit(True))
    left = rows.join(done, ["window", "resumable"], "left_anti")
    for lane, month in ended.items():
        left = left.where(~(F.col("window").startswith(f"{lane}|") & (F.substring(F.substring_index("window", "|", -1), 1, 6) <= month)))
    return left


@dataclass
class Run:
    """What a run did. status: 0, or 1 if a window failed otherwise than by quota, budget or range."""

    windows: int = 0
    calls: int = 0
    stopped: str | None = None
    failed: dict[str, str] = field(default_factory=dict)
    error: str | None = None

    @property
    def status(self) -> int:
        return int(self.error is not None or bool(self.failed) or (self.stopped is not None and self.stopped not in NO_FAILURE))


def ingest(spark: SparkSession, sink: UpsertSink, checkpoint: str, convert: Callable[[DataFrame], DataFrame], **options: str) -> Run:
    """Takes the pending windows into the sink's table until all are done or the budget, quota or range ends it.

    ``convert`` makes records of a stream of source.ROWS; it keeps SEQUENCE, by which the sink orders its keys' writes. Options are those
    of ``notice_windows``. A failure in the middle is the run's error, not its end for others: batches that were stored stay, and the
    next run goes on from the checkpoint.
    """
    source.register(spark)
    run = uuid.uuid4().hex
    before = last_offset(spark, checkpoint)
    reader = spark.readStream.format("notice_windows").options(**options).option("resume", json.dumps(before)).option("run", run)
    query = convert(reader.load()).writeStream.foreachBatch(sink).option("checkpointLocation", checkpoint).start()
    error = None
    try:
        query.processAllAvailable()
    except Exception as e:  # noqa: BLE001 - told by the run's status
        error = f"{type(e).__name__}: {str(e)[:4000]}"
    finally:
        query.stop()
    after = last_offset(spark, checkpoint)
    # A run without anything to do plans no batch and has nothing to say of its own.
    own = after["run"] == run
    return Run(after["windows"] - before["windows"], after["calls"] - before["calls"], after["stopped"] if own else None, after["failed"] if own else {}, error)


def records(stream: DataFrame, record: str, normalize: Callable[..., DataFrame]) -> DataFrame:
    """The stream's records (DDL ``record``), normalized, with their place in the sequence."""
    parsed = stream.select(*SEQUENCE, F.from_json("record", record).alias("r")).select(*SEQUENCE, "r.*")
    return valid(normalize(parsed, keep=SEQUENCE))


def publish(spark: SparkSession, gold: DataFrame, path: str) -> bool:
    """Stores gold as the next version under ``path`` if it differs from the newest one; says whether it did."""
    at = path.rstrip("/")
    try:
        newest = spark.read.schema("version long").json(f"{at}/versions").agg(F.max("version")).first()[0]
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        newest = None
    if newest is not None:
        old = spark.read.parquet(f"{at}/{newest:012d}")
        if old.columns == gold.columns and not changed(old, gold):
            return False
    version = (newest or 0) + 1
    gold.write.mode("overwrite").parquet(f"{at}/{version:012d}")  # what a run left that ended before naming it is overwritten
    spark.createDataFrame([(version,)], "version long").coalesce(1).write.mode("append").json(f"{at}/versions")
    return True


def published(spark: SparkSession, path: str) -> DataFrame:
    at = path.rstrip("/")
    newest = spark.read.schema("version long").json(f"{at}/versions").agg(F.max("version")).first()[0]
    return spark.read.parquet(f"{at}/{newest:012d}")
