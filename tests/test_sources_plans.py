"""Sources, sinks, certified runs, the command line and incremental merges."""

import json

import pytest
from pyspark.sql import functions as F

from caseloom import cli
from caseloom.operators import state
from caseloom.plans import stages
from caseloom.plans.runs import Run, latest_certified
from caseloom.schemas import SCHEMAS
from caseloom.sources import files, html, sinks
from caseloom.sources.http import HttpClient, HttpError, Response, fetch_search

FORM = "<form action='/go' method='post'><input type=hidden name=tok value=7><input name=d disabled value=x><input type=checkbox name=c><input type=submit name=s value=Go><select name=mode><option value=1>Rail<option value=2>Pipeline</select><textarea name=n> hi </textarea></form>"
RESULTS = "<table id=resultTable><tr><th>NTSB Number</th><th>Event Date</th><th>City</th><th>State/Region</th><th>Description</th></tr><tr><td><a href='/d?ProjectID=55'>X1</a></td><td>1/2/2020</td><td>A</td><td>B</td><td>C</td></tr><tr><td>X2</td><td></td><td></td><td></td><td></td></tr></table>"


def test_search_results(spark):
    r = html.search_results(spark.createDataFrame([("http://h/s", RESULTS)], "public_url string, html string")).collect()
    assert [(x.ntsb_number, x.project_id, x.result_url, x.state_or_region, x.accident_description) for x in r] == [("X1", "55", "http://h/d?ProjectID=55", "B", "C")]


def test_docket_pages(spark):
    six = "<dl><dt>Created</dt><dd>1</dd></dl><table><tr><td>#</td><td>Title</td></tr><tr><td>1</td><td>Doc</td><td>12</td><td>0</td><td>PDF</td><td><a href='a?FileExtension=pdf'>f</a></td></tr></table>"
    pages = spark.createDataFrame([("N", "http://h/p/", six), ("M", "http://h/p/", "<h1>Not found</h1>"), ("O", "http://h", None)], "ntsb_number string, public_url string, html string")
    items = html.docket_items(pages)
    assert [(x.ntsb_number, x.ordinal, x.page_count, x.photo_count, x.display_type, x.download_url) for x in items.collect()] == [("N", 1, 12, 0, "PDF", "http://h/p/a?FileExtension=pdf")]
    d = {x.ntsb_number: (x.item_count, x.creation_date, x.has_table) for x in html.dockets(pages, items).collect()}
    assert d == {"N": (1, "1", True), "M": (0, None, False), "O": (0, None, False)}


def python_steps(df):
    return df._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython")


def test_search_results_of_a_long_page(spark):
    """One pass of Python, and rows part from their page before they are used: beside each its whole table would go along."""
    rows = "".join(f"<tr><td><a href='/d?ProjectID={k}'>X{k}</a></td><td>A{k}</td></tr>" for k in range(300))
    found = html.search_results(spark.createDataFrame([("http://h/s", f"<table id=resultTable><tr><th>NTSB Number</th><th>City</th></tr>{rows}</table>")], "public_url string, html string"))
    assert python_steps(found) == 1
    assert {(x.ntsb_number, x.project_id, x.city, x.state_or_region) for x in found.collect()} == {(f"X{k}", str(k), f"A{k}", None) for k in range(300)}


def test_docket_items_take_one_pass_of_python(spark):
    pages = spark.createDataFrame([("N", "http://h/p/", "<table><tr><td>#</td><td>Title</td></tr><tr><td>1</td><td>\ufb01le \u2460</td><td><a href='x'>a</a><a href='b.pdf'>b</a></td></tr></table>")], "ntsb_number string, public_url string, html string")
    items = html.docket_items(pages)
    assert python_steps(items) == 1
    assert [(x.title, x.normalized_title_slug, x.view_url) for x in items.collect()] == [("file 1", "file_1", "http://h/p/b.pdf")]


def test_plain_markup_is_read_as_the_standard_parser_reads_it(monkeypatch):
    import random

    bits = "<table>|<table id=resultTable>|</TABLE>|<tr class=\"a b\">|</tr>|<td>|<td >|</td>|<th scope=col>|</th>|<a href='/d?x=1'>|<a href=/x>|<a href>|<a href='u' href='v'>|<a href='?a=1&amp;b=2'>|</a>|text| |a &amp; b|&nbsp;x|\u00e9 \ufb01|1 < 2|<dl>|</dl>|<dt>|<dd>|<br>|<br/>|<!-- c -->|<script>x<td></script>|\n|<form action='/s' method=post>|</form>|<select name=a>|<option value=1 selected>|</select>|<input type=checkbox name=c checked>|<textarea name=t>x</textarea>|<td x=1y=2>|</td x>|x&am|<td|<td a='1'b='2'>".split("|")
    rnd = random.Random(7)
    pages = ["".join(rnd.choices(bits[: rnd.choice((24, len(bits)))], k=rnd.randint(1, 20))) for _ in range(3000)]
    plain = [html._tokens(x) is not None for x in pages]
    assert any(plain) and not all(plain)
    got = [html.parse_page(x, "http://h/b") for x in pages]
    monkeypatch.setattr(html, "_tokens", lambda x: None)
    assert got == [html.parse_page(x, "http://h/b") for x in pages]


def test_http_retries_rate_and_form():
    sent, slept, replies = [], [], [Response(503, b"", {}), Response(429, b"", {}), Response(200, FORM.encode(), {}), Response(200, b"done", {})]

    def transport(method, url, data):
        sent.append((method, url, data))
        return replies.pop(0)

    c = HttpClient(transport, rate=1, retries=2, backoff=1, sleep=slept.append, clock=lambda: 0.0)
    assert fetch_search(c, "http://h/s") == "done"
    assert sent[-1] == ("POST", "http://h/go", b"tok=7&mode=2&n=hi") and slept.count(1.0) >= 3 and 2.0 in slept
    with pytest.raises(HttpError):
        HttpClient(lambda *a: Response(404, b"", {}), rate=0).get_bytes("http://h")
    assert HttpClient(lambda *a: Response(404, b"x", {}), rate=0).request("GET", "http://h").status == 404


def test_index_payloads(spark):
    bodies = [json.dumps({"results": [{"ntsbNumber": " a 1 ", "City": "X", "city": "y"}, {"NTSBNumber": "B2", "ProjectId": "7", "location": {"city": "Z"}}, 5, {"title": "no number"}]}), json.dumps([{"CaseNumber": "C3"}])]
    r = files.index_records(spark.createDataFrame([(b,) for b in bodies], "body string")).collect()
    assert {(x.ntsb_number, x.project_id, x.rejected) for x in r} == {("A1", None, False), ("B2", "7", False), (None, None, True), ("C3", None, False)}
    assert json.loads(next(x for x in r if x.ntsb_number == "A1").location_json) == {"city": "X"}
    with pytest.raises(Exception, match="unsupported"):
        files.index_records(spark.createDataFrame([("3",)], "body string")).collect()


RECORD = {"project_id": "p", "ntsb_number": "N", "docket_item_id": "ntsb:docket_item:N:1:s", "ordinal": 1, "title": "Factual report", "view_url": "v", "source_url": "u", "blob_sha256": "h", "blob_path": "b", "media_type": "application/pdf"}


def test_runs_from_manifest_to_claims(spark, tmp_path):
    (tmp_path / "m.jsonl").write_text("\n".join([json.dumps(RECORD), "", json.dumps(RECORD | {"docket_item_id": "ntsb:docket_item:N:2:s", "title": ""}), "[]"]))
    records, rejected = files.read_handoff(spark, f"file://{tmp_path}/m.jsonl")
    assert [r.line_no for r in records.collect()] == [1] and [r.line_no for r in rejected.collect()] == [3, 4]
    texts = spark.createDataFrame([("b", "Analysis\nIt broke because of rust. It held.", None)], "blob_path string, text string, error string")
    root = f"file://{tmp_path}/runs"
    failed = stages.ingest(Run(spark, "ingestion", root), records, rejected, texts)
    assert failed["status"] == "failed" and "failure_threshold" in failed["blocking"] and failed["records_failed"] == 2
    ok = stages.ingest(Run(spark, "ingestion", root), records, rejected.limit(0), texts)
    assert ok["status"] == "certified" and latest_certified(spark, root, "ingestion")["run_id"] == ok["run_id"]
    items = spark.read.parquet(f"{ok['run_dir']}/outputs")
    typed = stages.triage(Run(spark, "triage", root), items, upstream_root=root)
    assert typed["distributions"] == {"document_type": {"factual_report": 1}}
    with pytest.raises(RuntimeError, match="differs"):
        stages.triage(Run(spark, "triage", root), items.withColumn("title", F.lit("x")), upstream_root=root)
    picked = stages.narratives(Run(spark, "narrative", root), spark.read.parquet(f"{typed['run_dir']}/outputs"), upstream_root=root)
    assert spark.read.parquet(f"{picked['run_dir']}/outputs").first().selected_document_id == RECORD["docket_item_id"]
    documents = items.select(F.lit("d").alias("doc_id"), "docket_item_id", "ntsb_number", F.lit(None).cast("string").alias("case_number"), F.lit("completed").alias("status"), F.lit("extraction").alias("stage"), "text")
    assert stages.structures(Run(spark, "structure", root), documents)["status"] == "certified"
    spans = stages.sentence_spans(Run(spark, "sentence_spans", root), documents)
    again = stages.sentence_spans(Run(spark, "sentence_spans", root), documents)
    assert spans["status"] == again["status"] == "certified" and spans["output_digest"] == again["output_digest"] and spans["input_digest"] == again["input_digest"]
    claims = cli.main(["--data", f"file://{tmp_path}/data", "atomic-extract", "--input", f"{again['run_dir']}/outputs", "--upstream", root], spark)
    assert claims == 0


def test_command_line_tables(spark, tmp_path, capsys):
    data = f"file://{tmp_path}/data"
    (tmp_path / "payloads").mkdir()
    (tmp_path / "payloads/a.json").write_text(json.dumps([{"ntsbNumber": "A1", "title": "t"}]))
    for extra in (["init-db"], ["sync-investigations", "--payloads", f"file://{tmp_path}/payloads"], ["sync-investigations", "--payloads", f"file://{tmp_path}/payloads"], ["select"], ["export-ingestion-manifest"], ["materialize-case"], ["summarize"], ["doctor"]):
        assert cli.main(["--data", data, *extra], spark) == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert [x["changed"] for x in said if "changed" in x] == [1, 0]
    assert next(x for x in said if x["command"] == "summarize")["tables"]["investigations_current"] == 1
    assert sinks.read_latest(spark, f"{data}/exports").startswith(f"{data}/exports/manifest_")


def test_settings(tmp_path):
    (tmp_path / "s.yaml").write_text("storage:\n  root: ${ROOT}\n  raw: ${RAW:-raw}\n")
    assert cli.load_settings(str(tmp_path / "s.yaml"), {"ROOT": "/r"}) == {"storage": {"root": "/r", "raw": "raw"}}
    with pytest.raises(ValueError):
        cli.load_settings(str(tmp_path / "s.yaml"), {})
    with pytest.raises(ValueError):
        cli.load_settings(str(tmp_path / "s.yaml"), {"ROOT": "/r", "RAW": "/abs"})
    assert cli.layered(cli.parse_dotenv("# c\nexport CASELOOM_RATE='2'\nX=1"), {"CASELOOM_RATE": "3"}, {"rate": None, "limit": 5}) == {"rate": "3", "limit": 5}


def test_pdf_pages(spark):
    pages = {b"ok": ["a ", "b"], b"half": [ValueError("bad"), "b"], b"none": [ValueError("bad")]}

    def extract(content):
        if content not in pages:
            raise OSError("broken")
        return pages[content]

    df = spark.createDataFrame([(k.decode(), bytearray(k)) for k in (b"ok", b"half", b"none", b"junk")], "path string, content binary")
    got = {r.path: (r.text, len(r.warnings), r.error) for r in files.pdf_texts(df, extract).collect()}
    assert got == {"ok": ("a \n\nb", 0, None), "half": ("b", 1, None), "none": (None, 1, "page 1: bad"), "junk": (None, 0, "OSError: broken")}
    assert {r.path for r in files.pdf_texts(df, extract, strict=True).collect() if r.error} == {"half", "none", "junk"}


def test_incremental_merge(spark, tmp_path):
    from caseloom.streaming.manifests import follow

    events, folder = tmp_path / "events", f"file://{tmp_path}/tables"
    events.mkdir()
    for k, title in enumerate(("one", "two")):
        (events / f"{k}.json").write_text(json.dumps({"ntsb_number": "A", "investigation_id": "i", "title": title, "source_fingerprint": str(k)}))
        follow(spark, f"file://{events}", "investigations_current", folder, f"file://{tmp_path}/checkpoint", f"t{k}").awaitTermination()
    r = sinks.read_snapshot(spark, folder, "investigations_current", SCHEMAS["investigations_current"]).collect()
    assert [(x.title, x.first_seen_at, x.last_seen_at) for x in r] == [("two", "t0", "t1")]
    assert set(state.MATERIAL) <= set(SCHEMAS)


def test_blob_table_is_written_once(spark, tmp_path):
    d = spark.createDataFrame([("aa1", "p", bytearray(b"x")), ("aa1", "p", bytearray(b"x")), ("bb2", "q", bytearray(b"y"))], "blob_sha256 string, blob_path string, content binary")
    table = f"file://{tmp_path}/blobs"
    sinks.write_blobs(sinks.new_blobs(d, spark.createDataFrame([], "blob_sha256 string")), table)
    assert sinks.new_blobs(d, spark.read.parquet(table)).count() == 0 and spark.read.parquet(table).count() == 2
    assert "<h1>collect</h1>" in sinks.html_report("collect", {"failures": 0}, {"a": "b"})
