"""Clients, recorded pages, stores and runs."""

import json

import pytest
from pyspark.sql import functions as F

from gazette import jobs
from gazette.functions import text as t
from gazette.functions.rules import Rules
from gazette.operators import discovery, ordering
from gazette.operators.upsert import changed
from gazette.sources import paged, services, stores
from gazette.sources.client import ApiError, PagedClient, Throttle


def body(n, total, start=0):
    return json.dumps({"response": {"header": {"resultCode": "00"}, "body": {"totalCount": total, "items": [{"i": start + i} for i in range(n)]}}})


def scripted(*answers):
    left, slept = list(answers), []
    return PagedClient(lambda _: left.pop(0), sleep=slept.append), slept


def kind(client, run):
    with pytest.raises(ApiError) as e:
        run(client)
    return e.value.kind


def test_client_retries_and_types_failures():
    client, slept = scripted((500, ""), (503, ""), (200, body(1, 1)))
    assert client.page({})["totalCount"] == 1 and slept.count(3.0) == 1 and 6.0 in slept
    page = lambda c: c.page({})
    assert kind(scripted((429, ""))[0], page) == "daily_quota"
    client, _ = scripted((200, body(1, 1)), *[(429, "")] * 6)
    client.page({})
    assert kind(client, page) == "rate" and client.throttle.pause == 3.0
    assert kind(scripted((404, ""))[0], page) == "http"
    assert kind(scripted((200, "<xml>"))[0], page) == "other"
    assert kind(scripted((200, '{"nkoneps.com.response.ResponseError": {"header": {"resultCode": "07"}}}'))[0], page) == "range"
    assert kind(scripted((200, '{"OpenAPI_ServiceResponse": {"cmmMsgHeader": {"returnAuthMsg": "LIMITED_NUMBER"}}}'))[0], page) == "daily_quota"
    client, _ = scripted((200, body(1, 1)))
    client.max_calls = 1
    client.page({})
    assert kind(client, page) == "budget"


def test_throttle_speeds_up_after_successes():
    throttle = Throttle()
    throttle.limited()
    assert throttle.pause == 0.5
    for _ in range(20):
        throttle.succeeded()
    assert throttle.pause == 0.4


def test_scan_stops_early_on_known_records():
    answers = [(200, body(100, 1000, 100 * k)) for k in range(10)]
    client, _ = scripted(*answers)
    found = list(client.scan({}, known=lambda r: r["i"] >= 100, min_pages=3))
    assert len(found) == 300 and client.calls == 3
    seen = []
    client, _ = scripted(*answers)
    client.on_page = lambda n, total: seen.append((n, total))
    assert len(list(client.scan({}))) == 1000 and seen[-1] == (1000, 1000)


def test_requests():
    assert services.Service("BID", "a+b/").url("op", {"x": "한 글", "y": "", "z": None, "n": 1}) == services.HOSTS["BID"] + "/op?serviceKey=a%2Bb%2F&type=json&x=%ED%95%9C%20%EA%B8%80&n=1"
    assert services.Service("BID", "a%2Bb").url("op", {}) == services.Service("BID", "a+b").url("op", {})
    assert "a+b" not in repr(services.Service("BID", "a+b"))
    assert services.window_params("op|11|202402010000")["inqryEndDt"] == "202402292359"
    with pytest.raises(ValueError):
        services.Service.of({"service": "BID", "key": " "})


def test_fetcher_over_http():
    import threading
    from http.server import BaseHTTPRequestHandler, HTTPServer

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            bad = "/gone" in self.path
            self.send_response(404 if bad else 200)
            self.end_headers()
            self.wfile.write(b"" if bad else body(1, 1).encode())

        def log_message(self, *_):
            pass

    server = HTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=server.serve_forever, daemon=True).start()
    base = f"http://127.0.0.1:{server.server_port}"
    assert PagedClient(services.Service(base, "secret").fetcher("op"), sleep=lambda _: None).page({})["totalCount"] == 1
    assert services.Service(base, "secret").fetcher("gone")({})[0] == 404
    server.shutdown()
    server.server_close()
    with pytest.raises(OSError) as e:
        services.Service(base, "secret", 2).fetcher("op")({})
    assert "secret" not in str(e.value)


def test_notice_pages_format(spark, tmp_path):
    for region, n in (("00", 150), ("11", 20)):
        at = tmp_path / "op" / region / "202401010000"
        at.mkdir(parents=True)
        for k in range(2):
            (at / f"page-{k + 1}.json").write_text(body(min(100, max(0, n - 100 * k)), n, 100 * k))
    paged.register(spark)
    read = spark.read.format("notice_pages").option("path", str(tmp_path)).option("windows", "op|00|202401010000,op|11|202401010000")
    df = read.load()
    assert df.rdd.getNumPartitions() == 2
    assert {(r.window, r.n) for r in df.groupBy("window").agg(F.count("*").alias("n")).collect()} == {("op|00|202401010000", 150), ("op|11|202401010000", 20)}
    assert df.select(F.get_json_object("record", "$.i").cast("int").alias("i")).agg(F.max("i")).first()[0] == 149
    with pytest.raises(Exception, match="truncated|more are left"):
        read.option("maxPages", "1").load().collect()


def test_stores(spark, tmp_path):
    df = spark.createDataFrame([("a", "x", "2024-01-02"), ("b", None, "2024-02-03")], "key string, title string, date string")
    stores.save_json(df, f"{tmp_path}/json")
    assert stores.load_json(spark, f"{tmp_path}/json", "key string, title string").count() == 2
    stores.save_json(df, f"{tmp_path}/pretty", pretty=True)
    assert '"key" : "a"' in "\n".join(r.value for r in spark.read.text(f"{tmp_path}/pretty").collect())
    stores.save_keyed_json(df, f"{tmp_path}/keyed")
    assert {(r.key, r.title) for r in stores.load_keyed_json(spark, f"{tmp_path}/keyed", "struct<title: string, date: string>").collect()} == {("a", "x"), ("b", None)}
    assert stores.load_json(spark, f"{tmp_path}/none", "key string").count() == 0
    empty, why = stores.load_lenient(spark, f"{tmp_path}/none", "key string")
    assert empty.count() == 0 and "PATH_NOT_FOUND" in why
    stores.save(df, f"{tmp_path}/table", month="date")
    assert (tmp_path / "table" / "ym=2024-01").is_dir()
    with pytest.raises(RuntimeError):
        stores.save_unless_all_failed(df.limit(0), f"{tmp_path}/table", 3, 3)
    assert spark.read.parquet(f"{tmp_path}/table").count() == 2
    page = stores.embed("<b>/*A*/old/*B*/</b>", spark.createDataFrame([("</script>",)], "t string"), "/*A*/", "/*B*/")
    assert page == '<b>/*A*/[{"t": "<\\/script>"}]/*B*/</b>'


def test_changed_and_order(spark):
    a = spark.createDataFrame([(i % 50, i) for i in range(500)], "k int, v int")
    assert not changed(a, a.orderBy("v")) and changed(a, a.limit(499))
    found = ordering.numbered(a, F.desc("k"), "v", total="n").collect()
    want = sorted(((i % 50, i) for i in range(500)), key=lambda x: (-x[0], x[1]))
    assert [(r.k, r.v) for r in sorted(found, key=lambda r: r["index"])] == want and {r.n for r in found} == {500}
    assert ordering.numbered(a.limit(0), "k").count() == 0
    assert spark.range(1).select(t.stamp_minute(F.lit("2024-03-05 07:08:09").cast("timestamp")).alias("s")).first().s == "202403050708"
    with pytest.raises(ValueError):
        discovery.examples(spark.range(1001).select(F.col("id").cast("string").alias("token")), a, "k", "v")


def test_windows_until_the_limit():
    tried = []

    def fetch(key):
        tried.append(key)
        if key == "a|00|3":
            raise ApiError("range", "07")
        if key == "b|00|4":
            raise ApiError("http", "500")

    out = jobs.until_limit(["a|00|5", "a|00|4", "a|00|3", "a|00|2", "b|00|5", "b|00|4", "b|00|3"], fetch, skip=lambda k: k == "a|00|4")
    assert out == {"done": ["a|00|5", "b|00|5", "b|00|3"], "skipped": ["a|00|4"], "failed": ["b|00|4"], "beyond": ["a|00|3", "a|00|2"]}

    def quota(key):
        raise ApiError("daily_quota", "")

    assert jobs.until_limit(["a|0|1", "b|0|1"], quota)["beyond"] == ["a|0|1", "b|0|1"]


def test_runs(spark, tmp_path, capsys):
    raw = [{"bidNtceNo": f"n{i}", "bidNtceNm": f"수출 사업 {i}", "bidNtceDt": "2024-01-05 10:00"} for i in range(5)]
    (tmp_path / "first.json").write_text("\n".join(map(json.dumps, raw)))
    (tmp_path / "second.json").write_text("\n".join(map(json.dumps, raw[3:] + [{"bidNtceNo": "n9", "bidNtceNm": "new"}, {"bidNtceNo": " ", "bidNtceNm": "no number"}])))
    store = f"{tmp_path}/store"
    one = jobs.refresh(spark, store, {"bids": f"{tmp_path}/first.json", "gone": f"{tmp_path}/none.json"}, "2024-01-06 00:00:00", "r1")
    rows = {r.source: r for r in one.collect()}
    assert (rows["bids"].read, rows["bids"].added, rows["bids"].kept) == (5, 5, 5)
    assert rows["gone"].read is None and "PATH_NOT_FOUND" in rows["gone"].failure
    two = jobs.refresh(spark, store, {"bids": f"{tmp_path}/second.json"}, "2024-01-07 00:00:00", "r2").first()
    assert (two.read, two.added, two.kept) == (3, 1, 6)
    assert spark.read.parquet(f"{store}/runs").count() == 3
    assert 0 == jobs.main(["refresh", "--store", store, "--incoming", f"bids={tmp_path}/second.json", "--now", "2024-01-08 00:00:00"])
    (tmp_path / "rules.md").write_text("# 수집\n## 수출\n수출\n# 제외\n공사\n")
    newest = sorted((tmp_path / "store" / "bids").iterdir())[-1]
    jobs.main(["report", "--titles", str(newest), "--rules", f"{tmp_path}/rules.md"])
    shown = capsys.readouterr().out
    assert "|refresh|" in shown and "kept" in shown
    loaded = jobs.load_each({"a": lambda: spark.createDataFrame([("t", "2024-01-01", "u")], "title string, date string, url string"), "b": lambda: 1 / 0})
    assert list(loaded.failures) == ["b"]
    found = jobs.unified(loaded, {"a": "에이"}).first()
    assert (found.src, found.title, found.org) == ("a", "t", "에이")
    assert jobs.report(spark, spark.createDataFrame([("x 공사",), ("수출",)], "title string"), Rules({"g": ("수출",)}, ("공사",))).count() == 2


def test_sink_rewrites_touched_buckets_only(spark, tmp_path):
    from gazette.streaming.upserts import UpsertSink

    sink = UpsertSink(spark, f"file://{tmp_path}/t", ["k"], ["v"], "2024-01-01 00:00:00", buckets=16)
    frame = lambda rows: spark.createDataFrame(rows, "k long, v long, w string")
    sink(frame([(i, 1, "a") for i in range(200)] + [(None, 1, "x")]), 0)
    first = sink._newest()
    sink(frame([(7, 2, "b"), (7, 1, "late")]), 1)
    sink(frame([(7, 2, "b"), (7, 1, "late")]), 1)  # repeated after a failure
    second = sink._newest()
    assert sum(first[b] != second[b] for b in first) == 1
    rows = {r.k: (r.v, r.w) for r in sink.current().collect()}
    assert len(rows) == 200 and rows[7] == (2, "b") and rows[8] == (1, "a")
    assert {r.k: r.w for r in sink.current(1).collect()}[7] == "a"
    # What a repeated last batch reads stays; the first try of it goes.
    assert sink.clean() == 1 and {r.k: (r.v, r.w) for r in sink.current().collect()} == rows
    sink(frame([]), 2)
    assert sink.current().count() == 200
    for i in range(3, 45):
        sink(frame([(7, i, f"b{i}")]), i)
    assert {r.k: r.w for r in sink.current().collect()}[7] == "b44" and {r.k: r.w for r in sink.current(44).collect()}[7] == "b43"
    sink.clean()
    assert len(sink._log()) < 30 and sink.current().count() == 200
    sink(frame([(7, 44, "again")]), 44)  # repeated after cleaning
    assert {r.k: r.w for r in sink.current().collect()}[7] == "again"


def test_corrections_win_and_failures_are_isolated(spark, tmp_path):
    raw = [{"bidNtceNo": "n1", "bidNtceNm": "a", "bidNtceDt": "2024-01-05", "bidClseDt": "2024-02-20 10:00"}, {"bidNtceNo": "n1", "bidNtceNm": "a", "bidNtceDt": "2024-01-05", "bidClseDt": "2024-02-10 10:00"}]
    (tmp_path / "a.json").write_text("\n".join(map(json.dumps, raw)))
    found = jobs.refresh(spark, f"{tmp_path}/s", {"bids": f"{tmp_path}/a.json", "bad": f"{tmp_path}/none"}, "2024-01-06 00:00:00").collect()
    assert {r.source for r in found if r.failure} == {"bad"}
    assert spark.read.parquet(f"{tmp_path}/s/bids/000000000001").first().deadline == "2024-02-10"
    assert jobs.main(["refresh", "--store", f"{tmp_path}/s", "--incoming", f"bad={tmp_path}/none", "--now", "2024-01-08 00:00:00"]) == 1


def test_collect_from_windows_to_page(spark, tmp_path):
    rows = []
    for month, title in (("202401010000", "수출 하나"), ("202402010000", "공사 둘")):
        items = [{"bidNtceNo": f"{month}{i}", "bidNtceNm": title, "bidNtceDt": "2024-02-01", "bidClseDt": "2024-04-01 10:00"} for i in range(3)]
        rows.append(("op", "00", month, 1, 200, json.dumps({"response": {"header": {"resultCode": "00"}, "body": {"totalCount": 3, "items": items}}})))
    spark.createDataFrame(rows, "operation string, region string, bgn string, page int, status int, body string").write.partitionBy("operation", "region", "bgn").parquet(f"{tmp_path}/pages")
    from gazette.operators import normalize

    feeds = {"bids": jobs.Feed(("op|00",), {"path": f"{tmp_path}/pages"}, jobs.BID_RECORD, normalize.normalize_bid), "broken": jobs.Feed(("op|00",), {}, jobs.BID_RECORD, normalize.normalize_bid)}
    rules = Rules({"g": ("수출",)}, ("공사",))
    run = lambda now: jobs.collect(spark, f"{tmp_path}/store", feeds, rules, "2024-01", "2024-03-05", now, ("<i>/*A*//*B*/</i>", "/*A*/", "/*B*/"))
    one = run("2024-03-05 00:00:00")
    assert one.published and one.status == 1 and one.runs["broken"].error and one.runs["bids"].windows == 3
    page = "".join(r.value for r in spark.read.text(f"{tmp_path}/store/page").collect())
    assert page.count("수출 하나") == 3 and "공사" not in page
    two = run("2024-03-05 10:00:00")
    assert not two.published and two.runs["bids"].windows == 0
