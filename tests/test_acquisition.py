"""Acquisition commands end to end against a transport in memory."""

import json
import sys

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from caseloom import cli
from caseloom.plans import acquisition
from caseloom.plans.runs import Run
from caseloom.schemas import SCHEMAS
from caseloom.sources import sinks
from caseloom.sources.http import HttpClient, Response

SEARCH_FORM = "<form action='/results' method='post'><select name=mode><option value=1>Rail<option value=2>Pipeline</select></form>"
SEARCH = "<table id=resultTable><tr><th>NTSB Number</th><th>Event Date</th><th>City</th></tr><tr><td><a href='/d?ProjectID=71'>A1</a></td><td>1/2/2020</td><td>X</td></tr><tr><td><a href='/d?ProjectID=72'>B2</a></td><td></td><td></td></tr></table>"
ROW = "<tr><td>{n}</td><td>{title}</td><td>3</td><td>0</td><td>PDF</td><td><a href='/f/{file}?FileExtension=pdf'>file</a></td></tr>"


def page(*rows):
    return "<dl><dt>Created</dt><dd>1/1/2021</dd></dl><table><tr><td>#</td><td>Title</td></tr>" + "".join(ROW.format(n=n, title=t, file=f) for n, t, f in rows) + "</table>"


class Site:
    """Pages and files by address; requests are recorded."""

    def __init__(self):
        self.asked = []
        self.pages = {
            "http://x/index?limit=2": json.dumps({"results": [{"ntsbNumber": "A1", "projectId": "71", "title": "one"}, {"ntsbNumber": "B2", "title": "two"}]}),
            "http://x/search": SEARCH_FORM,
            "http://x/results": SEARCH,
            "http://x/docket?ProjectID=71": page((1, "Factual Report", "a"), (2, "Photo gallery", "p")),
            "http://x/docket?ProjectID=72": page((1, "Interview Transcript", "b"), (2, "Accident Report", "a")),
            "http://x/f/a?FileExtension=pdf": b"%PDF a",
            "http://x/f/b?FileExtension=pdf": b"%PDF b",
            "http://x/f/p?FileExtension=pdf": b"%PDF p",
        }

    def __call__(self, method, url, data):
        self.asked.append((method, url))
        body = self.pages.get(url)
        if body is None:
            return Response(404, b"", {})
        return Response(200, body if isinstance(body, bytes) else body.encode(), {"Content-Type": "application/pdf" if isinstance(body, bytes) else "text/html"})


@pytest.fixture
def world(spark, tmp_path, capsys):
    site, data = Site(), f"file://{tmp_path}/data"

    def run(*argv, code=0):
        capsys.readouterr()
        urls = ["--index-url", "http://x/index", "--search-url", "http://x/search", "--docket-url", "http://x/docket"]
        assert cli.main(["--data", data, *urls, *argv], spark, HttpClient(site, rate=0, retries=0)) == code
        return json.loads([x for x in capsys.readouterr().out.splitlines() if x.startswith("{")][-1])

    def table(name):
        return sinks.read_snapshot(spark, f"{data}/tables", name, SCHEMAS[name])

    return site, data, run, table


def test_collect_then_again(world, spark, tmp_path):
    site, data, run, table = world
    first = run("collect")
    assert {k: first[k] for k in ("status", "state_changed", "discovered", "enumerated", "changed", "total_items", "selected", "rejected", "downloaded", "reused")} == {"status": "ok", "state_changed": True, "discovered": 2, "enumerated": 2, "changed": 4, "total_items": 4, "selected": 3, "rejected": 1, "downloaded": 3, "reused": 0}
    log = sinks.read_small(spark, first["log_path"])
    assert "--- Starting: enumerate-dockets ---" in log and "download-selected complete" in log
    assert table("blobs_current").count() == 2 and table("downloads_current").count() == 3  # two items, one content
    assert {(r.ntsb_number, r.ordinal, r.is_active) for r in table("docket_items_current").collect()} == {(c, k, True) for c in ("A1", "B2") for k in (1, 2)}
    second = run("collect")
    assert (second["changed"], second["downloaded"], second["reused"]) == (0, 0, 3)
    asked = len(site.asked)
    # A docket that lists an ordinal twice keeps what is stored; one that drops an item deactivates it.
    site.pages["http://x/docket?ProjectID=71"] = page((1, "Factual Report", "a"), (1, "Other", "p"))
    site.pages["http://x/docket?ProjectID=72"] = page((1, "Interview Transcript of the crew", "b"))
    third = run("enumerate-dockets")
    assert (third["enumerated"], third["changed"], third["total_items"]) == (2, 2, 3) and len(site.asked) == asked + 2
    now = {(r.ntsb_number, r.ordinal): (r.title, r.is_active) for r in table("docket_items_current").collect()}
    assert now == {("A1", 1): ("Factual Report", True), ("A1", 2): ("Photo gallery", True), ("B2", 1): ("Interview Transcript of the crew", True), ("B2", 2): ("Accident Report", False)}
    moved = {r.docket_item_id for r in table("downloads_current").collect()}
    assert any("crew" in x for x in moved)  # downloads follow an item's new id
    events = [json.loads(x[0]) for x in spark.read.text(f"{data}/manifests/downloads").collect()]
    assert sorted(e["changed"] for e in events) == [False] * 3 + [True] * 3 and all("recorded_at" in e for e in events)
    # A case whose page cannot be read ends the command with an error; tables stay.
    del site.pages["http://x/docket?ProjectID=72"]
    assert run("enumerate-dockets", "--ntsb-number", "b2", code=1)["error_type"] == "HttpError"
    assert table("docket_items_current").count() == 4


def test_run_promote_and_case_views(world, spark, tmp_path):
    site, data, run, table = world
    site.pages["http://x/index"] = site.pages["http://x/index?limit=2"]
    site.pages["http://x/index?limit=2"] = json.dumps([{"ntsbNumber": "A1", "projectId": "71", "title": "one"}])
    first = run("run", "--limit", "2")
    assert {k: v for k, v in first.items() if k not in ("command", "run_id", "status", "state_changed")} == {"investigations_discovered": 1, "investigations_changed": 1, "dockets_enumerated": 1, "docket_items_total": 2, "selection_evaluated": 2, "selection_selected": 1, "selection_rejected": 1, "downloads_created": 1, "downloads_reused": 0, "promotions_evaluated": 1, "promotions_created": 1, "promotions_reused": 0, "conflicts": 0}
    again = run("run", "--limit", "2")
    assert (again["investigations_changed"], again["downloads_reused"], again["promotions_reused"]) == (0, 1, 1)
    path = table("promotions_current").first().promoted_path
    assert sinks.size_of(spark, path) == len(b"%PDF a") and path.startswith(f"{data}/raw/A1/")
    sinks.write_atomic(spark, path, "other content")
    clash = run("promote", code=1)
    assert (clash["conflicts"], clash["status"]) == (1, "error") and sinks.read_small(spark, path) == "other content"
    view = run("materialize-case", "--ntsb-number", "a1", "--html-feedback")
    assert (view["materialized"], view["reused"]) == (1, 0) and sinks.size_of(spark, f"{view['output_dir']}/001_factual_report.pdf") == 6
    report = sinks.read_small(spark, view["report_path"])
    assert "created a new materialized case view for A1" in report and "<th>NTSB Number</th>" in report and "<a href=" in report
    assert run("materialize-case", "--ntsb-number", "A1")["reused"] == 1
    assert run("sync-investigations", "--html-feedback")["changed"] == 1
    # No project anywhere: nothing is fetched.
    asked = len(site.asked)
    assert "B2" in run("enumerate-dockets", code=1)["error_message"] and len(site.asked) == asked
    told = run("summarize")
    assert told["tables"]["promotions_current"] == 1
    cases = {r.ntsb_number: (r.docket_items_count, r.downloads_count) for r in spark.read.json(told["cases_path"]).collect()}
    assert cases == {"A1": (2, 1), "B2": (0, 0)}
    checks = run("doctor")
    assert checks["status"] == "ok" and all(c["ok"] for c in checks["checks"])


def test_register_and_extract(world, spark, tmp_path):
    site, data, run, table = world
    cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers cannot import this file
    run("collect")
    manifest = run("export-ingestion-manifest")["output_path"]
    got = run("register-reports", "--raw-root", str(tmp_path / "data/blobs"), "--manifest", manifest)
    # Blob files have no suffix, so the raw root lists none, and the blob folder gives them by content.
    assert got["manifest_candidates"] == 3 and got["inserted"] == 2 and got["duplicate_blob"] == 1
    assert {(r.status, r.stage) for r in table("documents").collect()} == {("pending", "registration")}
    out = run("extract", "--extractor", "test_acquisition:pages_of")
    assert (out["claimed"], out["completed"], out["failed"]) == (2, 1, 1)
    assert {(r.status, r.stage, r.error_message) for r in table("documents").collect()} == {("completed", "extraction", None), ("failed", "extraction", "OSError: broken")}
    assert run("extract", "--extractor", "test_acquisition:pages_of")["claimed"] == 0
    again = run("register-reports", "--raw-root", str(tmp_path / "data/blobs"), "--manifest", manifest)
    assert "inserted" not in again and again["skipped_by_path"] + again.get("backfilled_by_path", 0) == 2
    (tmp_path / "raw").mkdir()
    for name, body in (("a.PDF", b"1"), ("b.pdf", b"1"), ("c.txt", b"2")):
        (tmp_path / "raw" / name).write_bytes(body)
    scan = run("register-reports", "--raw-root", str(tmp_path / "raw"))
    assert (scan["raw_scan_candidates"], scan["inserted"], scan["skipped_by_sha"]) == (2, 1, 1)


def pages_of(content):
    if content == b"%PDF b":
        raise OSError("broken")
    return [content.decode(), "more"]


def test_changed_by_fingerprint_only(spark):
    have = spark.createDataFrame([("a", "1"), ("b", None), ("c", "3")], "k string, source_fingerprint string")
    new = spark.createDataFrame([("a", "1", "x"), ("b", None, "x"), ("c", "4", "x"), ("d", "5", "x")], "k string, source_fingerprint string, title string")
    assert {r.k: r.changed for r in acquisition.by_fingerprint(have, new, "k").collect()} == {"a": False, "b": False, "c": True, "d": True}


def test_formats(spark):
    assert [sinks.elapsed(x) for x in (-1, 59.9, 3661, 360000)] == ["00:00:00", "00:00:59", "01:01:01", "100:00:00"]
    assert sinks.heartbeat("P", 65, "d") == "Collect | Phase: P | Elapsed: 00:01:05 | d"
    assert [sinks.label(x) for x in ("run_id", "total_items", "report_path")] == ["Run ID", "Total Items", "HTML Report"]
    assert [sinks.shown(x) for x in (None, True, 3, {"b": 1, "a": [2]})] == ["-", "true", "3", '{"a": [2], "b": 1}']
    assert sinks.console_event("INFO", "done", n=1, who="é") == '{"event":"done","level":"info","n":1,"who":"\\u00e9"}'
    assert sinks.report_name("c", "r", "2020-01-02T03:04:05Z") == "20200102_030405Z_c_r.html"
    say = sinks.narrative_sentences
    assert say("enumerate-dockets", {"enumerated": 3, "changed": 1, "total_items": 9})[1] == "It detected docket changes for 1 cases and re-read and confirmed 2 unchanged cases."
    assert say("download-selected", {"evaluated": 1, "selected": 0, "rejected": 1, "downloaded": 0, "reused": 0})[-1] == "No new downloads were performed during this pass."
    assert len(say("materialize-case", {"ntsb_number": "A", "materialized": 0, "reused": 2})) == 4
    assert say("sync-investigations", {"discovered": 1}) == [] and say("doctor", {}) == []
    row = spark.createDataFrame([("é", 1, None, True, ["a", "b"])], "s string, n int, z string, t boolean, l array<string>")
    text = row.select(sinks.spaced_json({c: F.col(c) for c in row.columns})).first()[0]
    want = {"s": "é", "n": 1, "z": None, "t": True, "l": ["a", "b"]}
    assert json.loads(text) == want and text.replace('["a","b"]', '["a", "b"]') == json.dumps(want, sort_keys=True)


def test_settings_rank(tmp_path):
    (tmp_path / "env").write_text("CASELOOM_INDEX_URL=from-file\nCASELOOM_RATE=5\n")
    args = cli.parser().parse_args(["--data", "d", "--env-file", str(tmp_path / "env"), "--rate", "2", "collect"])
    assert cli.settings(args, {"CASELOOM_INDEX_URL": "from-env"}) == {"index_url": "from-env", "rate": 2.0}
    with pytest.raises(ValueError, match="search_url"):
        cli._need({}, "search_url")


def test_log_of_a_failed_collect(world, spark):
    site, data, run, table = world
    del site.pages["http://x/results"]
    assert run("collect", code=1)["error_type"] == "HttpError"
    logs = spark.read.text(f"{data}/logs").collect()
    assert any("Collect failed" in r[0] for r in logs)
    beats = []
    ticks = iter([0.0, 10.0, 70.0, 70.0, 71.0])
    store = acquisition.Store(spark, data, Run(spark, "collect", f"{data}/runs/collect"))
    r = cli.Reporter(store, clock=lambda: next(ticks))
    r.line = beats.append
    r.phase = "P"
    r.status("one")
    r.status("two")
    assert beats == ["Collect | Phase: P | Elapsed: 00:01:11 | two"]
