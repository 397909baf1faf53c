"""Windowed ingest: budget, range stops, failures, and runs that are killed between storing and committing."""

import json

import pytest
from pyspark.sql import functions as F

from gazette.operators import normalize
from gazette.sources import ingest as source
from gazette.streaming import ingest as runs
from gazette.streaming.upserts import UpsertSink

RECORD = "bidNtceNo string, bidNtceOrd string, bidNtceNm string, bidNtceDt string, bidClseDt string"
LANES = ["op|00", "op|11"]


def window_pages(n, start):
    rows = [{"bidNtceNo": str((start + i) % 700), "bidNtceOrd": "00", "bidNtceNm": f"notice {start + i}", "bidNtceDt": "2024-01-02 10:00", "bidClseDt": "2024-02-01 10:00"} for i in range(n)]
    pages = [rows[i : i + 100] for i in range(0, n, 100)] or [[]]
    return [json.dumps({"response": {"header": {"resultCode": "00"}, "body": {"totalCount": n, "items": x}}}) for x in pages]


@pytest.fixture(scope="module")
def recorded(spark, tmp_path_factory):
    """Six months of two regions; region 11 has nothing before March, and its May can't be read."""
    path, rows, n = str(tmp_path_factory.mktemp("recorded")), [], 0
    for month in range(1, 7):
        for region in ("00", "11"):
            bgn = f"2024{month:02d}010000"
            if region == "11" and month < 3:
                rows.append(("op", region, bgn, 1, 200, '{"nkoneps.com.response.ResponseError": {"header": {"resultCode": "07"}}}'))
                continue
            if region == "11" and month == 5:
                rows.append(("op", region, bgn, 1, 404, ""))
                continue
            size = 50 + 130 * month
            rows += [("op", region, bgn, k + 1, 200, b) for k, b in enumerate(window_pages(size, n))]
            n += 97
    spark.createDataFrame(rows, "operation string, region string, bgn string, page int, status int, body string").write.partitionBy("operation", "region", "bgn").mode("overwrite").parquet(path)
    return path


def convert(stream):
    return runs.records(stream, RECORD, normalize.normalize_bid)


def sink_at(spark, path, fail_at=None):
    class Killed(UpsertSink):
        def __call__(self, batch, batch_id):
            super().__call__(batch, batch_id)
            if batch_id == fail_at:
                raise RuntimeError("killed")

    return Killed(spark, path, ["bidNo"], runs.SEQUENCE, "2024-06-20 00:00:00", 8)


def options(path, **more):
    return {"path": path, "lanes": ",".join(LANES), "start": "2024-01", "asOf": "2024-06-15", "windowsPerBatch": "3", **more}


def stored(sink):
    return sorted((r.bidNo, r.title) for r in sink.current().select("bidNo", "title").collect())


@pytest.fixture(scope="module")
def unbroken(spark, recorded, tmp_path_factory):
    at = str(tmp_path_factory.mktemp("unbroken"))
    sink = sink_at(spark, f"{at}/table")
    return runs.ingest(spark, sink, f"{at}/checkpoint", convert, **options(recorded)), stored(sink), at


def test_a_whole_run(spark, unbroken):
    run, rows, at = unbroken
    assert run.windows == 9 and run.failed == {"op|11|202405010000": "http"} and run.stopped is None and run.error is None and run.status == 1
    assert run.calls == sum(-(-(50 + 130 * m) // 100) for m in range(1, 7)) + sum(-(-(50 + 130 * m) // 100) for m in (3, 4, 6))
    found = runs.progress(spark, f"{at}/checkpoint")
    assert found.agg(F.sum("pages")).first()[0] == run.calls and found.where("not committed").isEmpty()
    assert runs.last_offset(spark, f"{at}/checkpoint")["ended"] == {"op|11": "202402"}
    left = {r.window for r in runs.pending(spark, f"{at}/checkpoint", LANES, "2024-01", "2024-06-15").collect()}
    assert left == {"op|11|202405010000", "op|00|202406010000", "op|11|202406010000"}  # what failed, and the month that isn't over


def test_killed_between_store_and_commit(spark, recorded, unbroken, tmp_path):
    whole, rows, _ = unbroken
    first = sink_at(spark, f"{tmp_path}/table", fail_at=1)
    run = runs.ingest(spark, first, f"{tmp_path}/checkpoint", convert, **options(recorded))
    assert run.status == 1 and "killed" in run.error
    sink = sink_at(spark, f"{tmp_path}/table")
    more = runs.ingest(spark, sink, f"{tmp_path}/checkpoint", convert, **options(recorded))
    assert more.error is None
    assert stored(sink) == rows
    assert runs.progress(spark, f"{tmp_path}/checkpoint").agg(F.sum("pages")).first()[0] == whole.calls
    again = runs.ingest(spark, sink, f"{tmp_path}/checkpoint", convert, **options(recorded))
    assert again.windows == 0 and again.calls == 0  # the open month was fetched as of this day already
    later = runs.ingest(spark, sink, f"{tmp_path}/checkpoint", convert, **options(recorded, asOf="2024-06-16"))
    assert later.windows == 2 and stored(sink) == rows


def test_one_budget_for_the_run(spark, recorded, unbroken, tmp_path):
    whole, rows, _ = unbroken
    sink, calls, n = sink_at(spark, f"{tmp_path}/table"), [], 0
    for n in range(1, 20):
        run = runs.ingest(spark, sink, f"{tmp_path}/checkpoint", convert, **options(recorded, maxCalls="12"))
        assert run.error is None and run.calls <= 12
        calls.append(run.calls)
        if run.stopped is None:
            break
        assert run.stopped == "budget"
    assert n > 3 and sum(calls) == whole.calls and stored(sink) == rows


def test_newest_first_ends_a_lane_at_the_range(spark, recorded, tmp_path):
    sink = sink_at(spark, f"{tmp_path}/table")
    run = runs.ingest(spark, sink, f"{tmp_path}/checkpoint", convert, **options(recorded, order="newest", windowsPerBatch="4"))
    assert run.windows == 9 and runs.last_offset(spark, f"{tmp_path}/checkpoint")["ended"] == {"op|11": "202402"}
    # Only the first month beyond the range was asked for.
    reader = source.WindowsReader(options(recorded, order="newest", windowsPerBatch="50"))
    reader.latestOffset()
    assert reader.client.calls == 9 + 1 + 1


def test_rate_is_shared_by_tasks(recorded):
    reader = source.WindowsReader(options(recorded, callsPerSecond="2"))
    client = reader._new_client(10)
    slept = []
    client.sleep = slept.append
    for _ in range(30):
        client.page({"window": "op|00|202401010000", "pageNo": 1})
    assert min(slept) == 5.0


def test_quota_ends_the_run_and_ranges_merge(recorded):
    reader = source.WindowsReader(options(recorded))
    reader.client.fetch = lambda _: (429, "")
    assert reader.latestOffset()["stopped"] == "daily_quota" and reader.latestOffset()["windows"] == 0
    assert source.with_month(source.with_month([["202311", "202312"]], "202402"), "202401") == [["202311", "202402"]]
    with pytest.raises(ValueError):
        source.WindowsReader({"lanes": "a|b"})


def test_publish_on_change(spark, tmp_path):
    a = spark.createDataFrame([(1, "x"), (2, "y")], "id long, t string")
    path = str(tmp_path / "gold")
    assert runs.publish(spark, a, path) and not runs.publish(spark, a.orderBy("t"), path)
    assert runs.publish(spark, a.where("id = 1"), path) and runs.published(spark, path).count() == 1


def test_a_window_of_any_size_is_whole(spark, tmp_path):
    rows = [("op", "00", "202401010000", k + 1, 200, b) for k, b in enumerate(window_pages(40_123, 0))]
    path = f"{tmp_path}/recorded"
    spark.createDataFrame(rows, "operation string, region string, bgn string, page int, status int, body string").write.partitionBy("operation", "region", "bgn").parquet(path)
    run = runs.ingest(spark, sink_at(spark, f"{tmp_path}/table"), f"{tmp_path}/checkpoint", convert, **{**options(path), "lanes": "op|00", "asOf": "2024-02-01"})
    assert (run.status, run.failed, run.windows, run.calls) == (0, {}, 2, 402 + 1)
    held = sink_at(spark, f"{tmp_path}/table").current()
    # Numbers repeat every 700 records; the last of each holds.
    assert sorted(r.title for r in held.select("title").collect()) == sorted(f"notice {i}" for i in range(40_123 - 700, 40_123))
    limited = source.WindowsReader({**options(path), "lanes": "op|00", "asOf": "2024-02-01", "maxPages": "400"})
    assert limited.latestOffset()["failed"] == {"op|00|202401010000": "truncated"}
    planned = source.WindowsReader({**options(path), "lanes": "op|00", "asOf": "2024-02-01"})
    dealt = planned.partitions(source.empty_offset(), planned.latestOffset())
    assert [(p.begin, p.first is None) for p in dealt] == [(1, False), (101, True), (201, True), (301, True), (401, True), (1, False)]
