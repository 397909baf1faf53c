"""JSON and Parquet stores of notices."""

from __future__ import annotations

import json
import tempfile
import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> str:
    """A new path in the folder that driver and executors share, ``spark.checkpoint.dir``; a temporary one is set where there is none (a single machine)."""
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        base = "file://" + tempfile.mkdtemp(prefix="gazette-")
        spark.conf.set("spark.checkpoint.dir", base)
    return f"{base.rstrip('/')}/gazette/{uuid.uuid4().hex}"


def load_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """An array of records; a missing file is an empty table."""
    try:
        return spark.read.schema(schema).json(path, multiLine=True)
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return spark.createDataFrame([], schema)
        raise


def load_lenient(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, str | None]:
    """(table, what went wrong): a store that can't be read is an empty table, records that can't are left out."""
    try:
        found = spark.read.schema(schema).option("mode", "DROPMALFORMED").json(path, multiLine=True)
        found.isEmpty()  # so that a file that can't be read shows here
        return found, None
    except Exception as e:  # noqa: BLE001 - any error, by contract
        return spark.createDataFrame([], schema), f"{type(e).__name__}: {str(e)[:200]}"


def load_keyed_json(spark: SparkSession, path: str, record: str, key: str = "key") -> DataFrame:
    """Files of {key: record, ...} objects on a line each, a row a record."""
    raw = spark.read.text(path)
    return raw.select(F.explode(F.from_json("value", f"map<string,{record}>")).alias(key, "_v")).select(key, "_v.*")


def save(df: DataFrame, path: str, month: str | None = None) -> None:
    """Overwrites a Parquet table, by months of the column ``month`` if given."""
    writer = (df.withColumn("ym", F.substring(month, 1, 7)) if month else df).write.mode("overwrite")
    (writer.partitionBy("ym") if month else writer).parquet(path)


def save_json(df: DataFrame, path: str, pretty: bool = False) -> None:
    """Overwrites a folder of JSON records, a line each (``pretty``: indented, a blank line between records)."""
    if not pretty:
        df.write.mode("overwrite").json(path)
        return
    shown = F.to_json(F.struct(*df.columns), {"pretty": "true"})
    df.select(F.concat(shown, F.lit("\n")).alias("value")).write.mode("overwrite").text(path)


def save_keyed_json(df: DataFrame, path: str, key: str = "key") -> None:
    """Overwrites a folder of lines {key: record}; each line is one that load_keyed_json reads."""
    rest = [c for c in df.columns if c != key]
    df.select(F.to_json(F.create_map(F.col(key), F.struct(*rest))).alias("value")).write.mode("overwrite").text(path)


def save_unless_all_failed(df: DataFrame, path: str, n_parts: int, n_failed: int) -> None:
    """Keeps what is stored when no part could be read."""
    if n_parts and n_failed >= n_parts:
        raise RuntimeError(f"all {n_parts} parts failed; {path} stays as it is")
    save(df, path)


def embed(template: str, gold: DataFrame, begin: str, end: str, limit: int = 100_000) -> str:
    """An HTML page with a (small) gold table as JSON between two markers."""
    if begin not in template or end not in template:
        raise ValueError("the template has no markers")
    rows = [json.loads(r.j) for r in gold.select(F.to_json(F.struct(*gold.columns)).alias("j")).limit(limit + 1).collect()]
    if len(rows) > limit:
        raise ValueError(f"more than {limit} rows; a page is no place for them")
    body = json.dumps(rows, ensure_ascii=False).replace("</script", "<\\/script")
    head, rest = template.split(begin, 1)
    return head + begin + body + end + rest.split(end, 1)[1]
