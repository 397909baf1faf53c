"""Runs: sources that fail on their own, windows until a range's limit, and a summary row of each run.

``python -m gazette.jobs refresh|report --store DIR ...`` is the entry point; both work on stored tables.
"""

from __future__ import annotations

import argparse
import os
import sys
from collections.abc import Callable, Iterable
from dataclasses import dataclass, field

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from gazette.functions.rules import Rules, parse_rules
from gazette.operators import discovery, normalize, views
from gazette.operators.upsert import upsert
from gazette.sources import services, stores
from gazette.sources.client import ApiError
from gazette.streaming import ingest
from gazette.streaming.upserts import UpsertSink

#: The fields of a tender notice's record that are read.
BID_RECORD = ", ".join(f"{x} string" for x in [*"bidNtceNo bidNtceOrd bidNtceNm dminsttNm ntceInsttNm bidNtceDt bidClseDt opengDt rbidOpengDt bidQlfctRgstDt presmptPrce asignBdgtAmt cntrctCnclsMthdNm sucsfbidMthdNm techAbltEvlRt bidPrceEvlRt reNtceYn intrntnlBidYn arsltCmptYn indstrytyLmtYn rgnLmtYn cmmnSpldmdMethdNm cmmnCntrctYn cmmnSpldmdCorpRgnLmtYn pubPrcrmntClsfcNo pubPrcrmntClsfcNm pubPrcrmntMidClsfcNm pubPrcrmntLrgClsfcNm bidNtceDtlUrl bidNtceUrl".split(), *[f"{stem}{i}" for i in range(1, 11) for stem in ("ntceSpecFileNm", "ntceSpecDocUrl")]])

SUMMARY = "run string, at timestamp, source string, read long, added long, kept long, failure string"


@dataclass
class Loaded:
    """Tables by source, and what went wrong with the others."""

    tables: dict[str, DataFrame] = field(default_factory=dict)
    failures: dict[str, str] = field(default_factory=dict)


def load_each(loaders: dict[str, Callable[[], DataFrame]]) -> Loaded:
    """Each source by itself: one that can't be read is a failure, not the end of the run."""
    out = Loaded()
    for name, load in loaders.items():
        try:
            found = load()
            found.schema  # noqa: B018 - a missing path shows here
            out.tables[name] = found
        except Exception as e:  # noqa: BLE001 - isolation is the point
            out.failures[name] = f"{type(e).__name__}: {str(e)[:200]}"
    return out


def unified(loaded: Loaded, labels: dict[str, str]) -> DataFrame | None:
    """One table of the sources that could be read; None if there is none."""
    parts = [views.unify(df, name, labels.get(name, "")) for name, df in loaded.tables.items()]
    return views.union_sources(parts) if parts else None


def until_limit(windows: Iterable[str], fetch: Callable[[str], None], skip: Callable[[str], bool] = lambda _: False) -> dict[str, list[str]]:
    """Fetches windows, newest first: done, skipped, and those not tried since the service goes no further back.

    A range error ends the operation's older windows; a used-up quota or budget ends the run; other errors leave a window
    failed and go on.
    """
    out: dict[str, list[str]] = {"done": [], "skipped": [], "failed": [], "beyond": []}
    ended: set[str] = set()
    stopped = False
    for key in windows:
        operation = key.split("|")[0]
        if stopped or operation in ended:
            out["beyond"].append(key)
        elif skip(key):
            out["skipped"].append(key)
        else:
            try:
                fetch(key)
                out["done"].append(key)
            except ApiError as e:
                if e.kind == "range":
                    ended.add(operation)
                    out["beyond"].append(key)
                elif e.kind in ("daily_quota", "budget"):
                    stopped = True
                    out["beyond"].append(key)
                else:
                    out["failed"].append(key)
    return out


def upsert_counted(old: DataFrame, new: DataFrame, key: list[str], seq: list[str], now: str, store: Callable[[DataFrame], None]) -> dict[str, int]:
    """Upserts and stores; read, added and kept are counted while the rows pass, not by further jobs."""
    incoming, written = Observation("incoming"), Observation("written")
    at = F.lit(now).cast("timestamp")
    merged = upsert(old, new.observe(incoming, F.count(F.lit(1)).alias("read")), key, seq, at)
    store(merged.observe(written, F.count(F.lit(1)).alias("kept"), F.count_if(F.col("first_seen") == at).alias("added")))
    return {"read": incoming.get["read"], **written.get}


def summary(spark: SparkSession, run: str, at: str, counts: dict[str, dict[str, int]], failures: dict[str, str]) -> DataFrame:
    """SUMMARY rows: one a source, failed or not."""
    rows = [(run, name, c.get("read"), c.get("added"), c.get("kept"), None) for name, c in counts.items()]
    rows += [(run, name, None, None, None, why) for name, why in failures.items()]
    found = spark.createDataFrame(rows, "run string, source string, read long, added long, kept long, failure string")
    return found.withColumn("at", F.lit(at).cast("timestamp")).select("run", "at", "source", "read", "added", "kept", "failure")


def stored_version(spark: SparkSession, versions: str) -> str | None:
    """The newest version's name; None before the first. A log that can't be read is an error, not an empty store."""
    try:
        return spark.read.text(versions).agg(F.max("value")).first()[0]
    except AnalysisException as e:
        if e.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def _refresh_one(spark: SparkSession, store: str, name: str, path: str, now: str) -> dict[str, int]:
    # Records as they were fetched: the last one of a key wins, as a correction follows what it corrects.
    raw = spark.read.json(path).withColumn("_fetched", F.monotonically_increasing_id())
    bids = normalize.valid(normalize.normalize_bid(raw, keep=["_fetched"])).withColumn("source", F.lit(name))
    at, versions = f"{store}/{name}", f"{store}/versions/{name}"
    newest = stored_version(spark, versions)
    old = spark.read.parquet(f"{at}/{newest}") if newest else spark.createDataFrame([], bids.drop("_fetched").schema).withColumn("first_seen", F.lit(now).cast("timestamp"))
    version = f"{int(newest or 0) + 1:012d}"
    counts = upsert_counted(old, bids, ["bidNo"], ["_fetched"], now, lambda df: df.drop("_fetched").write.mode("overwrite").parquet(f"{at}/{version}"))
    spark.createDataFrame([(version,)], "value string").coalesce(1).write.mode("append").text(versions)
    return counts


def refresh(spark: SparkSession, store: str, incoming: dict[str, str], now: str, run: str = "refresh") -> DataFrame:
    """Overlays stored bids with incoming raw records (JSON lines by source), a new version a run; gives and stores the summary.

    A source that fails, be it while its records are read or while they are stored, stays as it is; the others go on.
    """
    counts, failures = {}, {}
    for name, path in incoming.items():
        try:
            counts[name] = _refresh_one(spark, store, name, path, now)
        except Exception as e:  # noqa: BLE001 - isolation is the point
            failures[name] = f"{type(e).__name__}: {str(e)[:200]}"
    found = summary(spark, run, now, counts, failures)
    found.write.mode("append").parquet(f"{store}/runs")
    return found


@dataclass(frozen=True)
class Feed:
    """What a run collects: lanes of a service (or of recorded responses), the record's DDL, its normalizing, a converted-to column."""

    lanes: tuple[str, ...]
    options: dict[str, str]
    record: str
    normalize: Callable[..., DataFrame]
    converted: str | None = None


@dataclass
class Collected:
    runs: dict[str, ingest.Run]
    published: bool
    status: int


def collect(spark: SparkSession, store: str, feeds: dict[str, Feed], rules: Rules, start: str, as_of: str, now: str, page: tuple[str, str, str] | None = None) -> Collected:
    """A run from windows to what readers see: each feed's pending windows into its table, the gold notices of all, a new version if they changed.

    A feed that fails keeps what it has, and the run's status is 1; without any stored table nothing is published. ``page``: a template and its
    two markers; the page is stored with a new version.
    """
    runs, parts = {}, []
    for name, feed in feeds.items():
        sink = UpsertSink(spark, f"{store}/{name}", ["bidNo"], ingest.SEQUENCE, now)
        convert = lambda stream, f=feed: ingest.records(stream, f.record, f.normalize)
        try:
            runs[name] = ingest.ingest(spark, sink, f"{store}/checkpoints/{name}", convert, lanes=",".join(feed.lanes), start=start, asOf=as_of, **feed.options)
            found = sink.current()
            if found is not None:
                parts.append(views.gold(found, rules, as_of, feed.converted).drop(*ingest.SEQUENCE, "_bucket").withColumn("feed", F.lit(name)))
        except Exception as e:  # noqa: BLE001 - isolation is the point
            runs[name] = ingest.Run(error=f"{type(e).__name__}: {str(e)[:500]}")
    changed = False
    if parts:
        gold = views.union_sources(parts)
        changed = ingest.publish(spark, gold, f"{store}/gold")
        if changed and page:
            template, begin, end = page
            text = stores.embed(template, ingest.published(spark, f"{store}/gold").orderBy(F.desc("date"), "bidNo"), begin, end)
            spark.createDataFrame([(text,)], "value string").coalesce(1).write.mode("overwrite").text(f"{store}/page")
    return Collected(runs, changed, max((r.status for r in runs.values()), default=0))


def report(spark: SparkSession, titles: DataFrame, rules: Rules, title: str = "title") -> DataFrame:
    """label, n: how the rules deal with stored titles."""
    return discovery.classify(titles, F.col(title), F.col(title), rules).groupBy("label").agg(F.count("*").alias("n"))


def main(argv: list[str] | None = None) -> int:
    """The exit status: 1 if a source failed."""
    parser = argparse.ArgumentParser(prog="gazette.jobs")
    todo = parser.add_subparsers(dest="job", required=True)
    r = todo.add_parser("refresh")
    r.add_argument("--store", required=True)
    r.add_argument("--incoming", action="append", default=[], metavar="NAME=PATH")
    r.add_argument("--now", required=True)
    c = todo.add_parser("collect")
    for name in ("store", "rules", "start", "as-of", "now"):
        c.add_argument(f"--{name}", required=True)
    c.add_argument("--path", help="recorded responses, in place of the service (whose key is in NOTICE_KEY)")
    c.add_argument("--max-calls", type=int)
    q = todo.add_parser("report")
    q.add_argument("--titles", required=True)
    q.add_argument("--rules", required=True)
    given = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    if given.job == "refresh":
        found = refresh(spark, given.store, dict(x.split("=", 1) for x in given.incoming), given.now)
        found.show(truncate=False)
        return int(not found.where("failure is not null").isEmpty())
    if given.job == "collect":
        own = {"path": given.path} if given.path else {"service": "BID", "key": os.environ.get("NOTICE_KEY", "")}
        own |= {"maxCalls": str(given.max_calls)} if given.max_calls else {}
        lanes = tuple(f"{operation}|{region}" for operation in services.BID_OPERATIONS.values() for region in services.REGIONS)
        text = "\n".join(r.value for r in spark.read.text(given.rules).collect())  # a rule file
        done = collect(spark, given.store, {"bids": Feed(lanes, own, BID_RECORD, normalize.normalize_bid)}, parse_rules(text), given.start, given.as_of, given.now)
        for name, r in done.runs.items():
            print(name, r)
        print("published" if done.published else "unchanged")
        return done.status
    else:
        text = "\n".join(r.value for r in spark.read.text(given.rules).collect())  # a rule file
        report(spark, spark.read.parquet(given.titles), parse_rules(text)).orderBy(F.desc("n")).show(truncate=False)
    return 0


if __name__ == "__main__":
    sys.exit(main())
