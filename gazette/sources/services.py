"""The notice services: their addresses and operations, credentials, and the requests to them."""

from __future__ import annotations

import functools
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field

# Addresses and operations of the public notice services, region codes, search words.
HOSTS = {
    "BID": "https://apis.data.go.kr/1230000/ad/BidPublicInfoService",
    "PRESPEC": "https://apis.data.go.kr/1230000/ao/HrcspSsstndrdInfoService",
    "AWARD": "https://apis.data.go.kr/1230000/as/ScsbidInfoService",
}
BID_OPERATIONS = {"용역": "getBidPblancListInfoServcPPSSrch", "물품": "getBidPblancListInfoThngPPSSrch", "공사": "getBidPblancListInfoCnstwkPPSSrch", "외자": "getBidPblancListInfoFrgcptPPSSrch"}
PRESPEC_OPERATION = "getPublicPrcureThngInfoServcPPSSrch"
REGIONS = ("00", "11")
SEARCH_WORDS = ("모집", "신청")


def window_params(key: str) -> dict[str, str]:
    """The request parameters of a window ``operation|region|bgn[|end]``; a window without an end is its month."""
    _, region, bgn, *end = key.split("|")
    if not end:
        import calendar

        year, month = int(bgn[:4]), int(bgn[4:6])
        end = [f"{bgn[:6]}{calendar.monthrange(year, month)[1]:02d}2359"]
    return {"inqryDiv": "1", "inqryBgnDt": bgn, "inqryEndDt": end[0], "prtcptLmtRgnCd": region}


@dataclass(frozen=True)
class Service:
    """A service by its name in HOSTS or its address, and the credential, which no text of an error or of the object shows."""

    name: str
    key: str = field(repr=False)
    timeout: float = 30.0

    @classmethod
    def of(cls, options: Mapping[str, str]) -> Service:
        """From a data source's options service and key."""
        if not (options.get("key") or "").strip():
            raise ValueError("the option key (the service's credential) is missing")
        return cls(options["service"], options["key"].strip())

    def url(self, operation: str, params: Mapping[str, object]) -> str:
        # A key may be given as it is or percent-encoded; decoded it is one and the same.
        asked = {"serviceKey": urllib.parse.unquote(self.key), "type": "json"} | {k: v for k, v in params.items() if v is not None and v != ""}
        return f"{HOSTS.get(self.name, self.name)}/{operation}?" + urllib.parse.urlencode(asked, quote_via=urllib.parse.quote)

    def fetch(self, operation: str, params: Mapping[str, object]) -> tuple[int, str]:
        """(HTTP status, text). What can't be reached is an OSError that names the operation."""
        try:
            with urllib.request.urlopen(self.url(operation, params), timeout=self.timeout) as r:  # noqa: S310
                return r.status, r.read().decode(errors="replace")
        except urllib.error.HTTPError as e:
            return e.code, e.read().decode(errors="replace")
        except urllib.error.URLError as e:
            raise OSError(f"{operation}: {e.reason}") from None

    def fetcher(self, operation: str) -> Callable[[dict], tuple[int, str]]:
        """``fetch(params)`` for a PagedClient."""
        return functools.partial(self.fetch, operation)
