"""What the operators of this subpackage share: scratch tables and text batches."""

from __future__ import annotations

import contextlib
import contextvars
import ctypes
import gc
import os
import tempfile
import threading
import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Bytes of text that a task turns into words at a time.
CHUNK_BYTES = 2_000_000
#: Bytes, about, of an Arrow batch on its way to a Python worker. A batch is held in the executor's JVM and in the worker,
#: and by Spark's own bounds (10,000 rows, 64 MB) it often holds all of a task's texts.
BATCH_BYTES = 4_000_000


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``.

    Where the session names none (tests, a laptop) a temporary one is set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="gazette-")
        spark.conf.set("spark.checkpoint.dir", found)
    return found


#: The folder under the shared one for what is stored now; None: a new one for each table.
_SCOPE: contextvars.ContextVar[str | None] = contextvars.ContextVar("scope", default=None)


def scratch_path(spark: SparkSession, name: str) -> str:
    at = f"{shared_dir(spark).rstrip('/')}/gazette"
    return f"{at}/{_SCOPE.get()}/{uuid.uuid4().hex}/{name}" if _SCOPE.get() else f"{at}/{uuid.uuid4().hex}/{name}"


class Disposable:
    """``with Disposable(spark) as d``: tables stored inside are deleted at the end, but for those stored by ``d.keep``."""

    def __init__(self, spark: SparkSession):
        self.spark, self.name = spark, uuid.uuid4().hex

    def __enter__(self) -> Disposable:
        self.token = _SCOPE.set(self.name)
        return self

    def keep(self, df: DataFrame, name: str) -> DataFrame:
        inner = _SCOPE.get()
        _SCOPE.set(None)
        try:
            return materialize(df, name)
        finally:
            _SCOPE.set(inner)

    def __exit__(self, *_) -> None:
        _SCOPE.reset(self.token)
        at = self.spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(self.spark).rstrip('/')}/gazette/{self.name}")
        at.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(at, True)


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Writes df to the shared folder and reads it back, which cuts its lineage."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def bound_batches(spark: SparkSession) -> None:
    """Arrow batches are of about BATCH_BYTES in what the session runs from now on, unless it has a bound of its own. No result depends on it."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, str(BATCH_BYTES))


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def utf8(column: pa.Array) -> list[bytes]:
    """The texts of an Arrow column as UTF-8; a null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return [x or b"" for x in column.cast(pa.large_binary()).to_pylist()]


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[tuple[pa.RecordBatch, list[bytes]]]:
    """Cuts Arrow batches so that each piece holds about ``limit`` bytes of text (a text stays whole)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_pylist()
        at = 0
        while at < batch.num_rows:
            end, total = at, 0
            while end < batch.num_rows and (end == at or total + sizes[end] <= limit):
                total += sizes[end]
                end += 1
            piece = batch.slice(at, end - at)
            yield piece, utf8(piece.column(column))
            at = end


def with_text(df: DataFrame, *keep: str) -> DataFrame:
    """Only the columns that an operator needs, so that others never reach Python or a shuffle."""
    return df.select(*[F.col(x) for x in dict.fromkeys((*keep, "text"))])


class WordCache(dict):
    """Values by word, kept within ``limit`` entries and ``most_bytes`` (by ``size``, or the words' own lengths): what is dropped is just made again."""

    def __init__(self, make, limit: int = 400_000, most_bytes: int = 48_000_000, size=None):
        super().__init__()
        self.make, self.limit, self.most_bytes, self.size, self.held = make, limit, most_bytes, size, 0

    def _add(self, words: list[bytes], values: list) -> None:
        self.update(zip(words, values, strict=True))
        self.held += sum(map(self.size, words, values)) if self.size else sum(map(len, words))

    def fill(self, words: set[bytes]) -> None:
        """Makes the missing values in one call. Past a limit only the values of these words stay."""
        if len(self) + len(words) > self.limit or self.held > self.most_bytes:
            kept = [w for w in words if w in self]
            values = [self[w] for w in kept]
            self.clear()
            self.held = 0
            self._add(kept, values)
        missing = [*words.difference(self)]
        if missing:
            self._add(missing, self.make(missing))


class AgingCache(WordCache):
    """A WordCache of two generations: a full one becomes the old one, from which what is asked for again is taken over."""

    def __init__(self, *args, **named):
        super().__init__(*args, **named)
        self.old: dict = {}

    def fill(self, words: set[bytes]) -> None:
        if 2 * (len(self) + len(words)) > self.limit or 2 * self.held > self.most_bytes:
            self.old = dict(self)
            self.clear()
            self.held = 0
        missing = words.difference(self)
        new = missing.difference(self.old)
        known = [*missing.difference(new)]
        self._add(known, [self.old[w] for w in known])
        if new:
            self._add([*new], self.make([*new]))


class Lent:
    """One large value of a Python worker: made once, lent to its tasks, and dropped when none has had it for ``seconds``.

    A worker outlives its stage, and what it still holds counts against the executor while other stages run.
    """

    def __init__(self, make: Callable, seconds: float = 3.0):
        self.make, self.seconds = make, seconds
        self.lock, self.users, self.key, self.value = threading.Lock(), 0, None, None

    @contextlib.contextmanager
    def lend(self, *key) -> Iterator:
        """make(*key); the last one if the key is the same."""
        with self.lock:
            if self.value is None or self.key != key:
                self.key, self.value = key, self.make(*key)
            value = self.value
            self.users += 1
        try:
            yield value
        finally:
            del value
            with self.lock:
                self.users -= 1
                self.last = timer = threading.Timer(self.seconds, lambda: self._drop(timer))
            timer.daemon = True
            timer.start()

    def _drop(self, timer: threading.Timer) -> None:
        with self.lock:
            if self.users or self.last is not timer:
                return
            self.key = self.value = None
        give_back()


def give_back() -> None:
    """Gives the process's free memory back to the system, which Python, Arrow and the C library else keep."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim()


def trim() -> None:
    """Gives the C library's free memory back to the system, where the library can."""
    if found := getattr(ctypes.CDLL(None), "malloc_trim", None):
        found(0)


def fresh(df: DataFrame, base: str) -> str:
    """A name that no column of df begins with, in any case."""
    while any(c.lower().startswith(base.lower()) for c in df.columns):
        base = f"_{base}"
    return base
