"""``spark.readStream.format("notice_windows")``: calendar windows of a paged API as a stream.

An offset says which windows are done, so a query's checkpoint is the progress table of its ingest. A lane is
``operation|region``; a window is a lane's month. The driver admits windows: it asks for a window's first page, which tells how many calls
the window takes, and puts the window into the next batch if the run's call budget has room for all of them. The batch's tasks fetch the
other pages, PAGES_A_TASK of a window each. A window may have any number of pages. So

- one budget (maxCalls) and one rate (callsPerSecond, shared among the tasks of a batch) hold for the run, not for a window;
- a window beyond the service's range ends its lane towards the past for ever (``ended`` in the offset);
- a spent quota or budget ends the run: the windows that are left stay pending for the next one;
- a window that fails otherwise is named in the offset, the others go on, and the next run tries it again;
- a batch that was killed is read again from the offset log: the same windows, in the same sequence;
- a month that isn't over is fetched once a run (asOf) and never done.

Options: lanes (comma-separated), start (yyyy-MM), asOf (yyyy-MM-dd), order (oldest or newest first), windowsPerBatch, maxCalls, callsPerSecond,
maxPages (larger windows fail; none by default), resume and run (the last offset, and the run's name, see ``streaming.ingest``), and either path (recorded responses: a table page int, status int, body string
partitioned by operation, region, bgn) or service with key, as for ``notice_pages``.
"""

from __future__ import annotations

import datetime as dt
import json
import math
from collections.abc import Callable, Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from gazette.sources import services
from gazette.sources.client import PAGE_ROWS, ApiError, PagedClient, Throttle

ROWS = "window string, ordinal long, page int, index int, record string"
#: Pages of a window that one task fetches.
PAGES_A_TASK = 100
#: Failures after which no further window can be had in this run.
ENDING = {"daily_quota", "budget", "rate"}


def months_between(start: str, as_of: str) -> list[str]:
    """yyyymm of the months from start (yyyy-MM) to that of as_of, oldest first."""
    first, last = (int(x[:4]) * 12 + int(x[5:7]) - 1 for x in (start, as_of))
    return [f"{m // 12:04d}{m % 12 + 1:02d}" for m in range(first, last + 1)]


def is_over(month: str, as_of: str) -> bool:
    return month < as_of[:4] + as_of[5:7]


def _number(month: str) -> int:
    return int(month[:4]) * 12 + int(month[4:]) - 1


def holds(ranges: list[list[str]], month: str) -> bool:
    return any(a <= month <= b for a, b in ranges)


def with_month(ranges: list[list[str]], month: str) -> list[list[str]]:
    """The ranges of months with one more; neighbours are one range."""
    out: list[list[str]] = []
    for a, b in sorted([*ranges, [month, month]]):
        if out and _number(a) <= _number(out[-1][1]) + 1:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return out


class Plan:
    """The windows of a run, in order; pending ones by an offset."""

    def __init__(self, lanes: list[str], start: str, as_of: str, newest_first: bool = False):
        self.lanes, self.as_of = lanes, as_of
        months = months_between(start, as_of)
        self.months = months[::-1] if newest_first else months

    def pending(self, offset: dict) -> Iterator[tuple[str, str]]:
        """(lane, month): month by month, all lanes of each."""
        for month in self.months:
            for lane in self.lanes:
                if month <= offset["ended"].get(lane, "") or holds(offset["done"].get(lane, []), month):
                    continue
                if is_over(month, self.as_of) or offset["open"].get(lane) != f"{month}@{self.as_of}":
                    yield lane, month


def empty_offset() -> dict:
    return {"done": {}, "open": {}, "ended": {}, "failed": {}, "stopped": None, "windows": 0, "calls": 0, "batch": [], "run": ""}


def recorded(path: str) -> Callable[[dict], tuple[int, str]]:
    """``fetch(params)`` from a table of recorded responses; a window without any is an empty one."""
    import pyarrow.dataset as ds
    import pyarrow.fs as pafs

    store, root = pafs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (pafs.LocalFileSystem(), path)
    held: dict[tuple[str, int], dict[int, tuple[int, str]]] = {}

    def fetch(params: dict) -> tuple[int, str]:
        operation, region, bgn = params["window"].split("|")
        folder = f"{root}/operation={operation}/region={region}/bgn={bgn}"
        lot = (params["pageNo"] - 1) // PAGES_A_TASK
        if (folder, lot) not in held:
            held.clear()  # a task's pages at a time
            found = {}
            if store.get_file_info(folder).type != pafs.FileType.NotFound:
                own = (ds.field("page") > lot * PAGES_A_TASK) & (ds.field("page") <= (lot + 1) * PAGES_A_TASK)
                for r in ds.dataset(folder, filesystem=store, format="parquet").to_table(columns=["page", "status", "body"], filter=own).to_pylist():
                    found[r["page"]] = (r["status"], r["body"])
            held[folder, lot] = found
        empty = json.dumps({"response": {"header": {"resultCode": "00"}, "body": {"totalCount": 0, "items": []}}})
        return held[folder, lot].get(params["pageNo"], (200, empty))

    return fetch


def called(given: dict) -> Callable[[dict], tuple[int, str]]:
    """``fetch(params)`` of the service or the recorded responses."""
    if given.get("path"):
        return recorded(given["path"].rstrip("/"))
    api = services.Service.of(given)

    def fetch(params: dict) -> tuple[int, str]:
        window = params["window"]
        asked = services.window_params(window) | {k: v for k, v in params.items() if k != "window"}
        return api.fetch(window.split("|")[0], asked)

    return fetch


class WindowOfBatch(InputPartition):
    """PAGES_A_TASK of a window's pages, from ``begin`` on; ``first``: the records of its first page where this run's driver has them."""

    def __init__(self, window: str, pages: int, begin: int, ordinal: int, tasks: int, first: list[dict] | None):
        super().__init__(f"{window}|{begin}")
        self.window, self.pages, self.begin, self.ordinal, self.tasks, self.first = window, pages, begin, ordinal, tasks, first


class WindowsReader(DataSourceStreamReader):
    def __init__(self, options: dict):
        given = {k.lower(): v for k, v in options.items()}
        if not given.get("path") and not given.get("service"):
            raise ValueError("notice_windows needs the option path or service")
        order = given.get("order", "oldest")
        if order not in ("oldest", "newest"):
            raise ValueError("the option order is oldest or newest")
        dt.date.fromisoformat(given["asof"])
        self.given = given
        self.plan = Plan([x for x in given["lanes"].split(",") if x], given["start"], given["asof"], order == "newest")
        self.budget = int(given["maxcalls"]) if given.get("maxcalls") else math.inf
        self.per_batch, self.max_pages = int(given.get("windowsperbatch", "50")), int(given["maxpages"]) if given.get("maxpages") else math.inf
        self.at = json.loads(given["resume"]) if given.get("resume") else empty_offset()
        # What stopped or failed in an earlier run is tried again.
        self.run = given.get("run", "")
        self.failed: dict[str, str] = {}
        self.stopped: str | None = None
        #: Calls of tasks that are planned in this run, and batches that were.
        self.planned, self.known = 0, set()
        self.first: dict[str, list[dict]] = {}
        self._client: PagedClient | None = None

    def _new_client(self, tasks: int) -> PagedClient:
        throttle = Throttle()
        if self.given.get("callspersecond"):
            throttle.least = throttle.pause = tasks / float(self.given["callspersecond"])
        return PagedClient(called(self.given), throttle=throttle, **({"sleep": lambda _: None} if self.given.get("path") else {}))

    @property
    def client(self) -> PagedClient:
        if self._client is None:
            self._client = self._new_client(1)
        return self._client

    def spent(self) -> int:
        return self.client.calls + self.planned

    def initialOffset(self) -> dict:
        return empty_offset()

    def latestOffset(self) -> dict:
        """The offset after the next batch's windows; the same as before if there are none."""
        at = self.at
        made = json.loads(json.dumps(at)) | {"batch": [], "failed": {}, "stopped": None}
        for lane, month in self.plan.pending(at) if not self.stopped else ():
            if len(made["batch"]) >= self.per_batch or self.stopped:
                break
            window = f"{lane}|{month}010000"
            if window not in self.failed and month > made["ended"].get(lane, ""):
                self._admit(made, lane, month, window)
        made |= {"failed": dict(sorted(self.failed.items())), "stopped": self.stopped, "run": self.run}
        told = ("ended", "failed", "stopped") if at["run"] == self.run else ("ended",)
        if made["batch"] or any(made[x] != at[x] for x in told) or (at["run"] != self.run and (self.failed or self.stopped)):
            self.at = made
            self.known.add(json.dumps(made, sort_keys=True))
        return self.at

    def _admit(self, made: dict, lane: str, month: str, window: str) -> None:
        if self.spent() + 1 > self.budget:
            self.stopped = "budget"
            return
        try:
            body = self.client.page({"window": window, "pageNo": 1, "numOfRows": PAGE_ROWS})
            pages = max(1, -(-int(body.get("totalCount") or 0) // PAGE_ROWS))
            if pages > self.max_pages:
                raise ApiError("truncated", f"{pages} pages, {self.max_pages} at most")
        except ApiError as e:
            if e.kind == "range":
                made["ended"] = dict(sorted({**made["ended"], lane: max(month, made["ended"].get(lane, ""))}.items()))
            elif e.kind in ENDING:
                self.stopped = e.kind
            else:
                self.failed[window] = e.kind
            return
        if self.spent() + pages - 1 > self.budget:
            self.stopped = "budget"
            return
        self.planned += pages - 1
        self.first[window] = PagedClient.items(body)
        made["batch"].append([window, pages, made["windows"]])
        made["windows"] += 1
        made["calls"] += pages
        if is_over(month, self.plan.as_of):
            made["done"] = dict(sorted({**made["done"], lane: with_month(made["done"].get(lane, []), month)}.items()))
        else:
            made["open"] = dict(sorted({**made["open"], lane: f"{month}@{self.plan.as_of}"}.items()))

    def partitions(self, start: dict, end: dict) -> list[InputPartition]:
        if start == end:  # Spark asks so for a committed batch when a query starts again
            return []
        # A batch that another run planned is charged to this one, which fetches it again.
        if end["batch"] and json.dumps(end, sort_keys=True) not in self.known:
            self.planned += sum(pages for _, pages, _ in end["batch"])
            self.known.add(json.dumps(end, sort_keys=True))
        dealt = [(w, pages, begin, ordinal) for w, pages, ordinal in end["batch"] for begin in range(1, pages + 1, PAGES_A_TASK)]
        return [WindowOfBatch(*x, len(dealt), self.first.get(x[0]) if x[2] == 1 else None) for x in dealt]

    def read(self, partition: WindowOfBatch) -> Iterator[tuple[str, int, int, int, str]]:
        client = self._new_client(partition.tasks)
        for page in range(partition.begin, min(partition.begin + PAGES_A_TASK, partition.pages + 1)):
            if page == 1 and partition.first is not None:
                found = partition.first
            else:
                body = client.page({"window": partition.window, "pageNo": page, "numOfRows": PAGE_ROWS})
                found = client.items(body)
                if int(body.get("totalCount") or 0) > partition.pages * PAGE_ROWS:
                    raise ApiError("truncated", f"{body['totalCount']} records, {partition.pages} pages were planned")
            for i, record in enumerate(found):
                yield partition.window, partition.ordinal, page, i, json.dumps(record, ensure_ascii=False)

    def commit(self, end: dict) -> None:
        for window, _, _ in end["batch"]:
            self.first.pop(window, None)

    def __getstate__(self) -> dict:
        # Tasks need neither the pages that the driver holds nor its client.
        return self.__dict__ | {"_client": None, "first": {}, "known": set()}


class NoticeWindows(DataSource):
    @classmethod
    def name(cls) -> str:
        return "notice_windows"

    def schema(self) -> str:
        return ROWS

    def streamReader(self, schema) -> WindowsReader:
        return WindowsReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NoticeWindows)
