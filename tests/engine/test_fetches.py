"""Cached fetches, ranges and records, the session's rules, chat completions, and files of training rows."""

import json
import threading
import time
from http.server import BaseHTTPRequestHandler, ThreadingHTTPServer

import pytest
from pyspark.sql import functions as F

from quern.operators import judge
from quern.sources import cached, chat, config, jsonl, sinks, web

DATA = b"first\nsecond\nthird"


@pytest.fixture
def server():
    state = {"seen": [], "asked": [], "replies": []}

    class Handler(BaseHTTPRequestHandler):
        def do_GET(self):
            state["seen"].append(self.path)
            code, body, more = 200, b"body", {}
            if self.path == "/none":
                code = 404
            elif self.path == "/file" and (part := self.headers.get("Range")):
                a, b = map(int, part.removeprefix("bytes=").split("-"))
                code, body, more = 206, DATA[a : b + 1], {"Content-Range": f"bytes {a}-{b}/{len(DATA)}"}
            elif self.path == "/away":
                code, more = 302, {"Location": f"http://localhost:{self.server.server_port}/echo"}
            elif self.path == "/ftp":
                code, more = 302, {"Location": "ftp://127.0.0.1/x"}
            elif self.path == "/echo":
                body = json.dumps({k.lower(): v for k, v in self.headers.items()}).encode()
            elif self.path == "/slow":
                self.send_response(200)
                self.end_headers()
                for _ in range(20):
                    self.wfile.write(b"x")
                    self.wfile.flush()
                    time.sleep(0.1)
                return
            self.reply(code, body, more)

        def do_POST(self):
            state["asked"].append((json.loads(self.rfile.read(int(self.headers["Content-Length"]))), self.headers.get("Authorization")))
            code, body, more = state["replies"].pop(0)
            self.reply(code, body if isinstance(body, bytes) else json.dumps(body).encode(), more)

        def reply(self, code, body, more):
            self.send_response(code)
            for k, v in ({"Content-Length": str(len(body))} | more).items():
                self.send_header(k, v)
            self.end_headers()
            self.wfile.write(body)

        def log_message(self, *args):
            pass

    httpd = ThreadingHTTPServer(("127.0.0.1", 0), Handler)
    threading.Thread(target=httpd.serve_forever, daemon=True).start()
    yield f"http://127.0.0.1:{httpd.server_port}", state
    httpd.shutdown()


def quick(**options):
    return web.Session(rpm=0, sleep=lambda s: None, **options)


def test_bodies_and_absences_are_kept(server, tmp_path):
    url, state = server
    for _ in range(2):
        f = cached.Fetcher(quick(), cached.Store(str(tmp_path / "c")))
        assert f.get(f"{url}/a", "a") == b"body" and f.get(f"{url}/none", "n") is None
    assert state["seen"] == ["/a", "/none"] and f.network == 0
    assert sorted(p.name for p in (tmp_path / "c").iterdir()) == ["a", "n.absent"]


def test_parts_sizes_and_records(server, tmp_path):
    url, state = server
    f = cached.Fetcher(quick(), cached.Store(str(tmp_path)))
    assert f.part(f"{url}/file", 2, 5) == DATA[2:5] and f.size(f"{url}/file") == len(DATA)
    assert [f.record(f"{url}/file", o) for o in (0, 1, 7, 14)] == [b"first", b"second", b"third", None]
    n = len(state["seen"])
    assert [f.record(f"{url}/file", o) for o in (0, 14)] == [b"first", None] and len(state["seen"]) == n
    with pytest.raises(web.Stopped, match="200"):
        f.part(f"{url}/a", 0, 3)


def test_redirects_and_deadlines(server):
    url, _ = server
    held = json.loads(web.fetch(f"{url}/away", headers={"Authorization": "secret", "Cookie": "c", "X-Own": "1"}).body)
    assert "authorization" not in held and "cookie" not in held and held["x-own"] == "1"
    with pytest.raises(web.RequestFailed, match="no http"):
        web.fetch(f"{url}/ftp")
    start = time.monotonic()
    with pytest.raises(web.RequestFailed, match="deadline"):
        web.fetch(f"{url}/slow", deadline=0.3)
    assert time.monotonic() - start < 1.5


def test_session_rules():
    def replies(*items):
        left = list(items)
        return lambda url, **o: left.pop(0) if len(left) > 1 else left[0]

    reply = lambda code, body=b"{}", **head: web.Reply(code, {k.replace("_", "-"): v for k, v in head.items()}, body)
    naps = []
    s = web.Session(rpm=0, sleep=naps.append, now=lambda: 40.0, send=replies(reply(429, retry_after="Thu, 01 Jan 1970 00:01:40 GMT"), reply(503), reply(200, b"bad"), reply(200, b'{"a": 1}')))
    assert s.request("u", parse=lambda r: json.loads(r.body)) == {"a": 1} and naps == [60.0, 4.0, 8.0]
    s = quick(send=replies(reply(404)))
    for _ in range(19):
        assert s.request("u").status == 404
    with pytest.raises(web.Stopped, match="20 times"):
        s.request("u")
    s = quick(send=replies(reply(200), reply(404)))
    assert s.request("u").status == 200 and all(s.request("u").status == 404 for _ in range(30))
    with pytest.raises(web.Stopped, match="quota"):
        quick(send=replies(reply(429, b'{"e": "per day"}'))).request("u")
    s = quick(send=replies(reply(400)))
    for _ in range(4):
        with pytest.raises(web.RequestFailed):
            s.request("u")
    with pytest.raises(web.Stopped):
        s.request("u")

    def dead(url, **o):
        raise web.RequestFailed("x", connection=True)

    with pytest.raises(web.Stopped, match="5 failures"):  # each attempt counts
        quick(send=dead).request("u")


def test_pages_stop_and_drift():
    rows = [{"row_idx": i, "row": {"t": i}} for i in range(10)]
    get = lambda total: lambda o, n: {"num_rows_total": total(o), "rows": rows[o : o + min(n, 3)]}
    ten = get(lambda o: 10)
    assert [r["row_idx"] for r in web.pages(ten, 0, None, None, 4)] == list(range(10))
    assert [r["row_idx"] for r in web.pages(ten, 0, None, None, 4, lambda r: r["t"] == 4)] == list(range(6))
    with pytest.raises(web.Stopped, match="changed"):
        list(web.pages(get(lambda o: 10 + o), 0, None, None, 4))
    with pytest.raises(web.Stopped, match="empty"):
        list(web.pages(lambda o, n: {"num_rows_total": 5, "rows": []}, 0, None, None, 4))
    picks = web.sampled_offsets(10_000, 100, 7, "s")
    assert picks == sorted(set(picks)) and len(picks) == 7 and picks != list(range(0, 700, 100)) and picks == web.sampled_offsets(10_000, 100, 7, "s")


def test_chat(server, monkeypatch):
    url, state = server
    good = {"choices": [{"message": {"content": "hello"}, "finish_reason": "stop"}], "model": "m2", "usage": {"n": 1}}
    state["replies"] = [(200, {"choices": []}, {}), (200, good, {})]
    monkeypatch.setenv("SOME_KEY", "k")
    writer = {"base_url": f"{url}/v1/", "model": "m", "api_key_env": "SOME_KEY", "disable_thinking": True, "extra_body": {"x": 1}}
    said = chat.writer_client(writer, sleep=lambda s: None).complete([{"role": "user", "content": "hi"}], 0.7, 0.9)
    assert said == chat.Completion("hello", "stop", "m2", {"n": 1}) and len(state["asked"]) == 2
    body, key = state["asked"][-1]
    assert key == "Bearer k" and (body["temperature"], body["top_p"], body["x"], body["chat_template_kwargs"]) == (0.7, 0.9, 1, {"enable_thinking": False})
    assert chat.parsed(web.Reply(200, {}, b'{"choices": [{"message": {"content": null}}]}')).text == ""
    for bad in (b"x", b"{}", b'{"choices": [{"message": {}}]}'):
        with pytest.raises(ValueError):
            chat.parsed(web.Reply(200, {}, bad))
    monkeypatch.delenv("SOME_KEY")
    with pytest.raises(web.Stopped, match="SOME_KEY"):
        chat.writer_client(writer)
    with pytest.raises(web.Stopped, match="local"):
        chat.judge_client({"base_url": "https://8.8.8.8", "model": "m"})
    assert config.judge('[judge]\nbase_url = "http://localhost:1"\nmodel = "m"') == {"base_url": "http://localhost:1", "model": "m", "max_tokens": 8, "disable_thinking": True}
    with pytest.raises(ValueError):
        config.judge('[judge]\nmodel = "m"')


def test_meaning_judge(spark):
    pairs = spark.createDataFrame([("1", "a b", "a c"), ("2", "x", "y"), ("3", "p", "q")], "id string, clean string, wrong string")
    empty = spark.createDataFrame([], "id string, sha256 string, verdict boolean")
    client = lambda: lambda i, prompt: {"1": "Yes.", "2": "no"}[i]
    first = {r["id"]: r for r in judge.meanings(pairs, empty, "id", "clean", "wrong", client).collect()}
    assert [(first[i]["verdict"], first[i]["error"]) for i in "123"] == [(True, None), (False, None), (None, "KeyError")]
    cache = spark.createDataFrame([(i, first[i]["sha256"], first[i]["verdict"]) for i in "12"], "id string, sha256 string, verdict boolean")
    assert [r["id"] for r in judge.meanings(pairs, cache, "id", "clean", "wrong", client).collect()] == ["3"]
    with pytest.raises(Exception, match="1: text differs"):
        judge.meanings(pairs.withColumn("wrong", F.lit("new")), cache, "id", "clean", "wrong", client).collect()


def test_reports_and_splits(spark, tmp_path):
    path = str(tmp_path / "r" / "report.json")
    sinks.merge_report(path, "b", {"n": 1})
    sinks.merge_report(path, "a", 2)
    sinks.merge_report(path, "b", {"n": 3})
    assert (tmp_path / "r" / "report.json").read_text() == '{\n  "a": 2,\n  "b": {\n    "n": 3\n  }\n}\n'
    rows = spark.createDataFrame([(str(i), "x" * (50 if i == 7 else 5), "valid" if i % 20 == 3 else "train") for i in range(120)], "id string, t string, split string")
    folder = str(tmp_path / "d")
    assert sinks.write_splits(rows, folder) == {"valid": "valid has 6 rows; a batch needs 8"}
    long = F.length("t") > 10
    with pytest.raises(ValueError, match="1 of 120"):
        sinks.filter_splits(spark, folder, "id string, t string", long, most=0.001)
    assert not (tmp_path / "d" / "train.unfiltered").exists()
    for _ in range(2):
        assert sinks.filter_splits(spark, folder, "id string, t string", long) == [("train", "7")]
        assert jsonl.read_jsonl(spark, f"{folder}/train", "id string, t string").count() == 113
    assert jsonl.read_jsonl(spark, f"{folder}/train.unfiltered", "id string").count() == 114 and not (tmp_path / "d" / "valid.unfiltered").exists()


def test_private_paths_picks_and_seeds(spark, tmp_path):
    (tmp_path / "data" / "private").mkdir(parents=True)
    (tmp_path / "data" / "private" / "h.jsonl").write_text('{"text": "x"}\n')
    (tmp_path / "link.jsonl").symlink_to(tmp_path / "data" / "private" / "h.jsonl")
    assert sinks.is_private(str(tmp_path / "link.jsonl")) and sinks.is_private("data/private/x") and not sinks.is_private(str(tmp_path / "data" / "x"))
    picks = spark.createDataFrame([("a", "t1", 2), ("b", "t2", 1)], "source string, text string, number long")
    assert sinks.write_picks(picks, str(tmp_path / "picks")).columns == ["source", "kept"]
    (tmp_path / "empty.jsonl").write_text("")
    both = [str(tmp_path / "link.jsonl"), str(tmp_path / "picks")]
    assert sinks.read_all_seeds(spark, both, "text string").count() == 3
    with pytest.raises(ValueError, match="empty.jsonl"):
        sinks.read_all_seeds(spark, [*both, str(tmp_path / "empty.jsonl")], "text string")
