"""Live services as Spark data sources.

One reader task pages through a service (cursors allow no more), its rows are a table,
and the joins are Spark's. Requests go through a transport, a function
(method, url, headers, body) -> (status, text); tests and air-gapped use pass their own.
"""

from __future__ import annotations

import json
import os
import time
import urllib.error
import urllib.parse
import urllib.request
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from ..operators.graph import kept
from ..operators.spans import service_edges

Transport = Callable[[str, str, dict, str | None], tuple[int, str]]


class LiveError(RuntimeError):
    """A service's refusal, with its status."""


def urllib_transport(timeout: float = 30.0) -> Transport:
    def send(method: str, url: str, headers: dict, body: str | None) -> tuple[int, str]:
        request = urllib.request.Request(url, body.encode() if body else None, headers, method=method)
        try:
            with urllib.request.urlopen(request, timeout=timeout) as reply:
                return reply.status, reply.read().decode()
        except urllib.error.HTTPError as e:
            return e.code, e.read().decode(errors="replace")

    return send


def request(send: Transport, method: str, url: str, headers: dict, body: dict | None = None, wait: float = 0.5) -> dict:
    """A JSON reply. One retry for 502, 503, 504 and broken connections; other refusals raise at once."""
    for last in (False, True):
        try:
            status, text = send(method, url, headers | ({"Content-Type": "application/json"} if body is not None else {}), None if body is None else json.dumps(body))
        except (OSError, TimeoutError):
            if last:
                raise
        else:
            if status < 400:
                return json.loads(text) if text else {}
            if last or status not in (502, 503, 504):
                raise LiveError(f"{status} from {urllib.parse.urlsplit(url).netloc}: {text[:200]}")
        time.sleep(wait)
    raise AssertionError


def credential(value: str | None, *names: str) -> str:
    """The value, or the first of the environment variables (read on the driver)."""
    found = value or next((os.environ[n] for n in names if os.environ.get(n)), None)
    if not found:
        raise ValueError(f"a credential is needed: pass it or set {' or '.join(names)}")
    return found


# --- page loops (plain functions, so they can be tested without Spark) -----------


def dynatrace_pages(send: Transport, env_url: str, token: str, page: int = 500) -> Iterator[tuple[str, str, list[str]]]:
    """(id, name, ids it calls) of service entities."""
    base, headers = env_url.rstrip("/") + "/api/v2/entities", {"Authorization": f"Api-Token {token}"}
    query = {"entitySelector": 'type("SERVICE")', "fields": "+fromRelationships.calls", "pageSize": str(page)}
    while True:
        doc = request(send, "GET", f"{base}?{urllib.parse.urlencode(query)}", headers)
        for e in doc.get("entities") or []:
            yield e["entityId"], e.get("displayName") or e["entityId"], [c["id"] for c in (e.get("fromRelationships") or {}).get("calls") or [] if c.get("id")]
        if not (key := doc.get("nextPageKey")):
            return
        query = {"nextPageKey": key}


def honeycomb_rows(send: Transport, api_url: str, dataset: str, key: str, lookback: int, max_spans: int, deadline: float = 60, poll: float = 1.0) -> Iterator[tuple[str, str, str]]:
    """(span id, parent id, service) of a query over the lookback, polled until complete."""
    base, headers = api_url.rstrip("/"), {"X-Honeycomb-Team": key}
    wanted = {"breakdowns": ["trace.span_id", "trace.parent_id", "service.name"], "calculations": [{"op": "COUNT"}], "time_range": lookback, "limit": max_spans}
    made = request(send, "POST", f"{base}/1/queries/{dataset}", headers, wanted)
    result = request(send, "POST", f"{base}/1/query_results/{dataset}", headers, {"query_id": made["id"]})
    end = time.monotonic() + deadline
    while not result.get("complete"):
        if time.monotonic() > end:
            raise LiveError("the query did not complete in time")
        time.sleep(poll)
        result = request(send, "GET", f"{base}/1/query_results/{dataset}/{result['id']}", headers)
    for row in (result.get("data") or {}).get("results") or []:
        d = row.get("data", row)
        yield d.get("trace.span_id"), d.get("trace.parent_id"), d.get("service.name")


def datadog_spans(send: Transport, site: str, api_key: str, app_key: str, query: str, lookback: str, max_spans: int, page: int = 1000) -> Iterator[tuple[str, str, str]]:
    """(span id, parent id, service) of a span search, by cursor, the newest max_spans of the
    lookback ("1h" or "now-1h")."""
    headers, cursor, left = {"DD-API-KEY": api_key, "DD-APPLICATION-KEY": app_key}, None, max_spans
    while left > 0:
        ask = {"filter": {"query": query, "from": lookback if lookback.startswith("now") else f"now-{lookback}", "to": "now"}, "page": {"limit": min(page, left)}, "sort": "-timestamp"}
        if cursor:
            ask["page"]["cursor"] = cursor
        doc = request(send, "POST", f"https://api.{site}/api/v2/spans/events/search", headers, {"data": {"type": "search_request", "attributes": ask}})
        rows = doc.get("data") or []
        for r in rows[:left]:
            a = r.get("attributes") or {}
            yield a.get("span_id") or r.get("id"), a.get("parent_id"), a.get("service")
        left -= len(rows)
        cursor = ((doc.get("meta") or {}).get("page") or {}).get("after")
        if not cursor or not rows:
            return


# --- data sources ---------------------------------------------------------------


class _Reader(DataSourceReader):
    def __init__(self, source: LiveSource):
        self.source = source

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        yield from self.source.rows()


class LiveSource(DataSource):
    """transport: the class attribute that every reader of it sends by."""

    transport: Transport | None = None

    def reader(self, schema):
        return _Reader(self)

    def send(self) -> Transport:
        return type(self).transport or urllib_transport(float(self.options.get("timeout", 30)))


class Dynatrace(LiveSource):
    @classmethod
    def name(cls):
        return "dynatrace"

    def schema(self):
        return "id string, name string, calls array<string>"

    def rows(self):
        yield from dynatrace_pages(self.send(), self.options["env_url"], self.options["api_token"])


class Honeycomb(LiveSource):
    @classmethod
    def name(cls):
        return "honeycomb"

    def schema(self):
        return "span_id string, parent_id string, service string"

    def rows(self):
        o = self.options
        yield from honeycomb_rows(self.send(), o["api_url"], o["dataset"], o["api_key"], int(o["lookback_seconds"]), int(o["max_spans"]))


class Datadog(LiveSource):
    @classmethod
    def name(cls):
        return "datadog"

    def schema(self):
        return "span_id string, parent_id string, service string"

    def rows(self):
        o = self.options
        yield from datadog_spans(self.send(), o["site"], o["api_key"], o["app_key"], o["query"], o["lookback"], int(o["max_spans"]))


def _table(spark: SparkSession, source: type[LiveSource], **options: str) -> DataFrame:
    spark.dataSource.register(source)
    return spark.read.format(source.name()).options(**options).load()


def from_dynatrace(spark: SparkSession, env_url: str | None = None, api_token: str | None = None, timeout: float = 30, source: type[LiveSource] = Dynatrace) -> DataFrame:
    """Edges between services by name; calls to what isn't known are dropped."""
    # read once: a second pull might see other pages
    table = kept(_table(spark, source, env_url=credential(env_url, "DYNATRACE_ENV_URL"), api_token=credential(api_token, "DYNATRACE_API_TOKEN"), timeout=str(timeout)))
    calls = table.select(F.col("name").alias("src"), F.explode("calls").alias("id"))
    return calls.join(table.select("id", F.col("name").alias("dst")), "id").where("src <> dst").select("src", "dst").distinct()


def from_honeycomb(spark: SparkSession, dataset: str, api_key: str | None = None, api_url: str = "https://api.honeycomb.io", lookback_seconds: int = 3600, max_spans: int = 10_000, timeout: float = 30, source: type[LiveSource] = Honeycomb) -> DataFrame:
    options = {"dataset": dataset, "api_key": credential(api_key, "HONEYCOMB_API_KEY"), "api_url": api_url, "lookback_seconds": str(lookback_seconds), "max_spans": str(max_spans), "timeout": str(timeout)}
    return service_edges(_table(spark, source, **options).where("service is not null"))


def datadog_query(env: str | None = None, service: str | None = None) -> str:
    return " ".join(f"{k}:{v}" for k, v in (("env", env), ("service", service)) if v) or "*"


def from_datadog(spark: SparkSession, api_key: str | None = None, app_key: str | None = None, site: str = "datadoghq.com", lookback: str = "1h", max_spans: int = 10_000,
                 env: str | None = None, service: str | None = None, timeout: float = 30, source: type[LiveSource] = Datadog) -> DataFrame:
    options = {"api_key": credential(api_key, "DD_API_KEY"), "app_key": credential(app_key, "DD_APP_KEY"), "site": site, "lookback": lookback, "max_spans": str(max_spans), "query": datadog_query(env, service), "timeout": str(timeout)}
    return service_edges(_table(spark, source, **options).where("service is not null"))
