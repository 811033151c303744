"""Polite, bounded fetching on the driver, one request at a time.

Listings are few and small; they are fetched before a plan starts and enter it
as bytes. The transport is a parameter, so tests need no network.
"""

from __future__ import annotations

import time
import urllib.error
import urllib.request
import urllib.robotparser
from collections.abc import Callable
from dataclasses import dataclass, field
from urllib.parse import urlsplit

from noticeflow.functions.urls import LARGEST_BYTES, safe

# Fixed values.
MIN_INTERVAL, TIMEOUT, RETRIES = 1.0, 30.0, 2


class FetchError(Exception):
    """The address could not be fetched."""


class UnsafeUrl(FetchError):
    """The address is not one of a public host."""


class ResponseTooLarge(FetchError):
    """The answer is longer than allowed."""


class RobotsDenied(FetchError):
    """robots.txt forbids the address."""


class ContactNotConfigured(ValueError):
    """A contact is part of the user agent and must be given."""


@dataclass(frozen=True)
class Response:
    status: int
    headers: dict[str, str]
    body: bytes
    url: str


Transport = Callable[[str, dict[str, str], float, int], Response]


def user_agent(product: str, contact: str | None) -> str:
    if not contact or not contact.strip():
        raise ContactNotConfigured("set a contact address for the user agent")
    return f"{product} (contact: {contact.strip()})"


class _Checked(urllib.request.HTTPRedirectHandler):
    def redirect_request(self, req, fp, code, msg, headers, newurl):  # noqa: ANN001, ANN201
        if not safe(newurl):  # before it is followed
            raise UnsafeUrl(newurl)
        return super().redirect_request(req, fp, code, msg, headers, newurl)


def urllib_transport(url: str, headers: dict[str, str], timeout: float, limit: int) -> Response:
    """Reads at most limit + 1 bytes, whatever the answer declares."""
    opener = urllib.request.build_opener(_Checked())
    try:
        with opener.open(urllib.request.Request(url, headers=headers), timeout=timeout) as r:
            return Response(r.status, {k.lower(): v for k, v in r.headers.items()}, r.read(limit + 1), r.url)
    except urllib.error.HTTPError as e:
        return Response(e.code, {k.lower(): v for k, v in e.headers.items()}, e.read(limit + 1), url)


def robots_policy(answer: Response | None) -> tuple[str, urllib.robotparser.RobotFileParser | None]:
    """(parsed, missing, not_robots or error; the rules if parsed)."""
    if answer is None:
        return "error", None
    if answer.status != 200:
        return "missing", None
    head = answer.body[:512].lstrip().lower()
    if "html" in answer.headers.get("content-type", "").lower() or head.startswith((b"<!doctype html", b"<html")):
        return "not_robots", None
    rules = urllib.robotparser.RobotFileParser()
    rules.parse(answer.body.decode("utf-8", "replace").splitlines())
    return "parsed", rules


@dataclass
class Client:
    agent: str
    transport: Transport = urllib_transport
    interval: float = MIN_INTERVAL
    retries: int = RETRIES
    limit: int = LARGEST_BYTES
    clock: Callable[[], float] = time.monotonic
    sleep: Callable[[float], None] = time.sleep
    _last: dict[str, float] = field(default_factory=dict)
    _robots: dict[str, tuple] = field(default_factory=dict)

    def _once(self, url: str) -> Response:
        host = urlsplit(url).netloc
        wait = self._last.get(host, -1e9) + self.interval - self.clock()
        if wait > 0:
            self.sleep(wait)
        self._last[host] = self.clock()
        return self.transport(url, {"User-Agent": self.agent}, TIMEOUT, self.limit)

    def allowed(self, url: str) -> bool:
        parts = urlsplit(url)
        root = f"{parts.scheme}://{parts.netloc}"
        if root not in self._robots:
            try:
                answer = self._once(f"{root}/robots.txt")
            except Exception:  # noqa: BLE001  an unreachable robots.txt allows
                answer = None
            self._robots[root] = robots_policy(answer)
        rules = self._robots[root][1]
        return rules is None or rules.can_fetch(self.agent, url)

    def get(self, url: str) -> Response:
        """4xx fails at once; exceptions and 5xx are tried again after growing waits."""
        if not safe(url):
            raise UnsafeUrl(url)
        if not self.allowed(url):
            raise RobotsDenied(url)
        failure: Exception | str = "no try"
        for attempt in range(self.retries + 1):
            if attempt:
                self.sleep(self.interval * attempt)
            try:
                r = self._once(url)
            except FetchError:
                raise
            except Exception as e:  # noqa: BLE001
                failure = e
                continue
            if r.status >= 500:
                failure = f"status {r.status}"
                continue
            if r.status >= 400:
                raise FetchError(f"{url}: status {r.status}")
            if not safe(r.url):
                raise UnsafeUrl(r.url)
            declared = r.headers.get("content-length", "")
            if declared.isdigit() and int(declared) > self.limit or len(r.body) > self.limit:
                raise ResponseTooLarge(url)
            return r
        raise FetchError(f"{url}: {failure}")
