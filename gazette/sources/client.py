"""A polite client of a paged API, for use inside a data source's tasks.

``fetch(params) -> (http_status, text)`` and ``sleep(seconds)`` are given, so that nothing here needs a network.
"""

from __future__ import annotations

import http.client
import json
import time
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

# Page size, pauses in seconds, retries.
PAGE_ROWS = 100
MIN_PAUSE, MAX_PAUSE, PAUSE_AFTER_LIMIT = 0.15, 3.0, 0.5
SPEED_UP_AFTER = 20
RETRIES, RETRY_BASE = 5, 3.0


class ApiError(Exception):
    """kind: daily_quota, rate, range, budget, truncated, http or other."""

    def __init__(self, kind: str, message: str):
        super().__init__(message)
        self.kind = kind


@dataclass
class Throttle:
    """Doubles the pause when told to slow down, shortens it after a run of successes."""

    pause: float = MIN_PAUSE
    good: int = 0
    #: The pause is never shorter.
    least: float = MIN_PAUSE

    def succeeded(self) -> None:
        self.good += 1
        if self.good >= SPEED_UP_AFTER:
            self.pause, self.good = max(self.least, self.pause * 0.8), 0

    def limited(self) -> None:
        self.pause, self.good = max(self.least, min(MAX_PAUSE, max(PAUSE_AFTER_LIMIT, self.pause * 2))), 0


@dataclass
class PagedClient:
    fetch: Callable[[dict], tuple[int, str]]
    sleep: Callable[[float], None] = time.sleep
    max_calls: int | None = None
    on_page: Callable[[int, int], None] | None = None
    throttle: Throttle = field(default_factory=Throttle)
    calls: int = 0

    def page(self, params: dict) -> dict:
        """The parsed response; retries what may pass, raises ApiError for the rest."""
        for attempt in range(RETRIES + 1):
            if self.max_calls is not None and self.calls >= self.max_calls:
                raise ApiError("budget", f"{self.max_calls} calls made")
            self.sleep(self.throttle.pause)
            first, self.calls = self.calls == 0, self.calls + 1
            try:
                code, text = self.fetch(params)
            except (OSError, http.client.HTTPException) as e:  # also a body that is cut
                code, text = 0, str(e)
            if code == 200:
                self.throttle.succeeded()
                return self._body(text)
            if code == 429:
                if first:
                    raise ApiError("daily_quota", "limited on the first call")
                self.throttle.limited()
            elif code and code < 500:
                raise ApiError("http", f"HTTP {code}")
            if attempt < RETRIES:
                self.sleep(RETRY_BASE * 2**attempt)
        raise ApiError("rate" if code == 429 else "http", f"gave up: {code or text}")

    @staticmethod
    def _body(text: str) -> dict:
        try:
            parsed = json.loads(text)
        except ValueError:
            raise ApiError("other", f"not JSON: {text[:200]}") from None
        if not isinstance(parsed, dict):
            raise ApiError("other", f"no object: {text[:200]}")
        gateway = (parsed.get("OpenAPI_ServiceResponse") or {}).get("cmmMsgHeader")
        backend = (parsed.get("nkoneps.com.response.ResponseError") or {}).get("header")
        header = backend or (parsed.get("response") or {}).get("header") or {}
        if gateway:
            raise ApiError("daily_quota" if "LIMITED" in str(gateway.get("errMsg")) + str(gateway.get("returnAuthMsg")) else "other", str(gateway))
        if backend or str(header.get("resultCode", "")).strip() != "00":
            raise ApiError("range" if header.get("resultCode") == "07" else "other", str(header))
        return (parsed.get("response") or {}).get("body") or {}

    @staticmethod
    def items(body: dict) -> list[dict]:
        found = body.get("items")
        if isinstance(found, dict):
            found = found.get("item")
        return found if isinstance(found, list) else [found] if found else []

    def scan(self, params: dict, max_pages: int = 200, known: Callable[[dict], bool] | None = None, min_pages: int = 0) -> Iterator[dict]:
        """All records of a query, a page at a time: to an empty page or the total.

        With ``known`` also to the first page after min_pages that holds nothing new. Raises ApiError
        ``truncated`` if max_pages end before that.
        """
        n = 0
        for page in range(1, max_pages + 1):
            body = self.page({**params, "pageNo": page, "numOfRows": PAGE_ROWS})
            found = self.items(body)
            n += len(found)
            if self.on_page:
                self.on_page(n, int(body.get("totalCount") or 0))
            yield from found
            fresh = known is None or any(not known(x) for x in found)
            if not found or n >= int(body.get("totalCount") or 0) or (page >= min_pages and not fresh):
                return
        raise ApiError("truncated", f"{n} records in {max_pages} pages, more are left")
