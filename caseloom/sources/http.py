"""HTTP edge. One client on the driver holds the global request rate; its bytes land as files, which Spark then reads.
Requests never run in tasks, where a rate per source could not be kept."""

from __future__ import annotations

import json
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable
from dataclasses import dataclass

from caseloom.sources.html import search_form


@dataclass
class Response:
    status: int
    body: bytes
    headers: dict


def urllib_transport(user_agent: str, timeout: float = 30.0) -> Callable[[str, str, bytes | None], Response]:
    """Sends one request; redirects are followed, error statuses come back as responses."""

    def send(method: str, url: str, data: bytes | None) -> Response:
        request = urllib.request.Request(url, data=data, method=method, headers={"User-Agent": user_agent})
        try:
            with urllib.request.urlopen(request, timeout=timeout) as r:
                return Response(r.status, r.read(), dict(r.headers))
        except urllib.error.HTTPError as e:
            return Response(e.code, e.read(), dict(e.headers))

    return send


class HttpError(RuntimeError):
    def __init__(self, status: int, url: str):
        super().__init__(f"HTTP {status} for {url}")
        self.status = status


class HttpClient:
    """At most ``rate`` requests a second; 429, 5xx and transport errors are tried again after a linearly growing
    wait; other statuses are returned. ``get_*`` refuse every status that is not 2xx."""

    def __init__(self, transport, rate: float = 1.0, retries: int = 3, backoff: float = 1.0, sleep=time.sleep, clock=time.monotonic):
        self.transport, self.rate, self.retries, self.backoff = transport, rate, retries, backoff
        self.sleep, self.clock, self.last = sleep, clock, None

    def _wait(self) -> None:
        if self.rate > 0:
            if self.last is not None and (rest := 1.0 / self.rate - (self.clock() - self.last)) > 0:
                self.sleep(rest)
            self.last = self.clock()

    def request(self, method: str, url: str, params: dict | None = None, data: dict | None = None) -> Response:
        if params:
            url += ("&" if "?" in url else "?") + urllib.parse.urlencode(params)
        body = urllib.parse.urlencode(data).encode() if data is not None else None
        for attempt in range(self.retries + 1):
            self._wait()
            try:
                r = self.transport(method, url, body)
                if r.status != 429 and r.status < 500:
                    return r
                error: Exception = HttpError(r.status, url)
            except OSError as e:
                error = e
            if attempt == self.retries:
                raise error
            self.sleep(self.backoff * (attempt + 1))
        raise AssertionError

    def get_bytes(self, url: str, params: dict | None = None) -> bytes:
        r = self.request("GET", url, params)
        if not 200 <= r.status < 300:
            raise HttpError(r.status, url)
        return r.body

    def get_text(self, url: str, params: dict | None = None) -> str:
        return self.get_bytes(url, params).decode("utf-8", "replace")

    def get_json(self, url: str, params: dict | None = None):
        return json.loads(self.get_bytes(url, params))


def fetch_index(client: HttpClient, url: str, limit: int | None = None) -> str:
    """Index payload as text; a limit is the server's to apply."""
    return client.get_text(url, {"limit": limit} if limit is not None else None)


def fetch_search(client: HttpClient, url: str, choice: str = "pipeline") -> str:
    """Result page of the public search: the form is read and sent back with ``choice`` taken."""
    form = search_form(client.get_text(url), url, choice)
    r = client.request(form["method"], form["url"], **({"data": form["fields"]} if form["method"] == "POST" else {"params": form["fields"]}))
    if not 200 <= r.status < 300:
        raise HttpError(r.status, form["url"])
    return r.body.decode("utf-8", "replace")


def docket_url(base: str, project_id: str) -> str:
    return f"{base}?{urllib.parse.urlencode({'ProjectID': project_id})}"


def fetch_docket(client: HttpClient, base: str, project_id: str) -> str:
    return client.get_text(docket_url(base, project_id))
