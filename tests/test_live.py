"""Connectors over a fake transport, and the command line."""

import json

import pytest

from edgeloom import cli
from edgeloom.results import Memo, in_background
from edgeloom.sources import live

from .conftest import rows


def replies(*each):
    todo, seen = list(each), []

    def send(method, url, headers, body):
        seen.append((method, url, headers, json.loads(body) if body else None))
        status, doc = todo.pop(0)
        return status, json.dumps(doc)

    send.seen = seen
    return send


def test_retry():
    send = replies((503, {}), (200, {"a": 1}))
    assert live.request(send, "GET", "http://x", {}, wait=0) == {"a": 1}
    with pytest.raises(live.LiveError, match="403"):
        live.request(replies((403, {})), "GET", "http://x", {}, wait=0)
    with pytest.raises(live.LiveError):
        live.request(replies((502, {}), (502, {})), "GET", "http://x", {}, wait=0)


def test_pages():
    send = replies((200, {"entities": [{"entityId": "1", "displayName": "a", "fromRelationships": {"calls": [{"id": "2"}]}}], "nextPageKey": "k"}), (200, {"entities": [{"entityId": "2"}]}))
    assert list(live.dynatrace_pages(send, "http://d/", "t")) == [("1", "a", ["2"]), ("2", "2", [])]
    assert "nextPageKey=k" in send.seen[1][1] and send.seen[0][2]["Authorization"] == "Api-Token t"
    row = lambda i, p, s: {"data": {"trace.span_id": i, "trace.parent_id": p, "service.name": s}}
    send = replies((200, {"id": "q"}), (200, {"id": "r", "complete": False}), (200, {"id": "r", "complete": True, "data": {"results": [row("1", None, "a")]}}))
    assert list(live.honeycomb_rows(send, "http://h", "ds", "k", 60, 10, poll=0)) == [("1", None, "a")]
    span = lambda i: {"id": i, "attributes": {"span_id": i, "service": "s"}}
    send = replies((200, {"data": [span("1"), span("2")], "meta": {"page": {"after": "c"}}}), (200, {"data": [span("3"), span("4")]}))
    assert len(list(live.datadog_spans(send, "s", "a", "b", "*", "1h", 3))) == 3
    assert send.seen[1][3]["data"]["attributes"]["page"]["cursor"] == "c"


def test_sources(spark):
    def dyn(method, url, headers, body):
        return 200, json.dumps({"entities": [{"entityId": "1", "displayName": "a", "fromRelationships": {"calls": [{"id": "2"}, {"id": "9"}]}}, {"entityId": "2", "displayName": "b"}]})

    def dog(method, url, headers, body):
        one = lambda i, p, s: {"attributes": {"span_id": i, "parent_id": p, "service": s}}
        return 200, json.dumps({"data": [one("1", "0", "front"), one("2", "1", "auth"), one("3", "2", "db")]})

    class Dyn(live.Dynatrace):
        transport = staticmethod(dyn)

    class Dog(live.Datadog):
        transport = staticmethod(dog)

    assert rows(live.from_dynatrace(spark, "http://d", "t", source=Dyn)) == [("a", "b")]
    assert rows(live.from_datadog(spark, "a", "b", env="prod", source=Dog)) == [("auth", "db"), ("front", "auth")]
    assert live.datadog_query("prod", "web") == "env:prod service:web" and live.datadog_query() == "*"


def test_credentials(monkeypatch):
    monkeypatch.delenv("DD_API_KEY", raising=False)
    with pytest.raises(ValueError):
        live.credential(None, "DD_API_KEY")
    monkeypatch.setenv("DD_API_KEY", "k")
    assert live.credential(None, "DD_API_KEY") == "k" and live.credential("x", "DD_API_KEY") == "x"


def test_command_line(spark, capsys, tmp_path):
    assert cli.main(["--edges", "a -> b\nb -> c", "--json"], spark) == 0
    out = json.loads(capsys.readouterr().out)
    assert {r["node"] for r in out} == {"a", "b", "c"} and out[0]["criticality"] == 1.0
    assert cli.main(["--edges", "a -> b", "--edges-only"], spark) == 0 and "a    b" in capsys.readouterr().out
    assert cli.main(["--before", "a -> b", "--after", "a -> b\nb -> c"], spark) == 0 and "delta" in capsys.readouterr().out
    assert cli.main(["--edges", "nothing"], spark) == 1 and cli.main([], spark) == 2
    (tmp_path / "e.json").write_text('[["x", "y"]]')
    assert cli.main(["--path", str(tmp_path / "e.json"), "--edges-only"], spark) == 0


def test_memo(spark, edges):
    memo, made = Memo(1), []

    def make(e):
        made.append(1)
        return e.distinct()

    a = memo.of(edges("a>b b>c"), make)
    assert memo.of(edges("b>c a>b"), make) is a and len(made) == 1
    memo.of(edges("x>y"), make)
    assert len(memo.held) == 1 and in_background(a.count).result() == 2
    memo.clear()
