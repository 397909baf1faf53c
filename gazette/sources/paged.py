"""``spark.read.format("notice_pages")``: a paged API, or its recorded responses, as a table.

Options: windows (``operation|region|bgn`` keys, comma-separated, or ``operation|region|bgn|end``) and either path (a folder of
recorded responses ``<operation>/<region>/<bgn>/page-<n>.json``) or service (a name in ``services.HOSTS`` or a base address) with
key, the credential, which is never logged; maxPages and maxCalls limit a window. A partition is one
window, so windows are fetched in parallel and a lost task fetches its own again. ``register(spark)`` makes the format known.
"""

from __future__ import annotations

import json
from collections.abc import Iterator

from pyspark.sql import SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from gazette.sources import services
from gazette.sources.client import PagedClient


class WindowPartition(InputPartition):
    def __init__(self, key: str):
        super().__init__(key)
        self.key = key


class PagesReader(DataSourceReader):
    def __init__(self, options: dict):
        given = {k.lower(): v for k, v in options.items()}
        self.keys = [k for k in given.get("windows", "").split(",") if k]
        self.path, self.service = given.get("path", "").rstrip("/"), given.get("service")
        if not self.path and not self.service:
            raise ValueError("notice_pages needs the option path or service")
        self.api = services.Service.of(given) if self.service else None
        self.max_pages, self.max_calls = int(given.get("maxpages", "200")), given.get("maxcalls")

    def partitions(self) -> list[WindowPartition]:
        return [WindowPartition(k) for k in self.keys]

    def read(self, partition: WindowPartition) -> Iterator[tuple[str, str]]:
        client = PagedClient(self._recorded(partition.key), sleep=lambda _: None) if self.path else PagedClient(self.api.fetcher(partition.key.split("|")[0]))
        client.max_calls = int(self.max_calls) if self.max_calls else None
        for record in client.scan({} if self.path else services.window_params(partition.key), self.max_pages):
            yield partition.key, json.dumps(record, ensure_ascii=False)

    def _recorded(self, key: str):
        import pyarrow.fs as pafs

        store, root = pafs.FileSystem.from_uri(self.path) if "://" in self.path else (pafs.LocalFileSystem(), self.path)
        folder = "/".join(key.split("|")[:3])

        def recorded(params: dict) -> tuple[int, str]:
            name = f"{root}/{folder}/page-{params['pageNo']}.json"
            if store.get_file_info(name).type == pafs.FileType.NotFound:
                return 404, ""
            with store.open_input_file(name) as f:
                return 200, f.read().decode()

        return recorded


class NoticePages(DataSource):
    @classmethod
    def name(cls) -> str:
        return "notice_pages"

    def schema(self) -> str:
        return "window string, record string"

    def reader(self, schema) -> PagesReader:
        return PagesReader(dict(self.options))


def register(spark: SparkSession) -> None:
    spark.dataSource.register(NoticePages)
