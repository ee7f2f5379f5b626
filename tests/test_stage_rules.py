"""Every certification rule has a case that breaks it."""

import json

import pytest
from pyspark.sql import functions as F

from caseloom.operators import atomic, certify, classify, narrative, state, structure
from caseloom.plans import stages
from caseloom.plans.runs import Run, load_summary
from caseloom.schemas import ATOMIC_RESULT
from caseloom.sources import sinks

RECORD = {"project_id": "p", "ntsb_number": "N", "docket_item_id": "ntsb:docket_item:N:1:s", "acquisition_run_id": None, "ordinal": 1, "title": "Factual report", "view_url": "v", "source_url": "u", "blob_sha256": "h", "blob_path": "b", "media_type": "application/pdf"}
HANDOFF = "project_id string, ntsb_number string, docket_item_id string, acquisition_run_id string, ordinal int, title string, view_url string, source_url string, blob_sha256 string, blob_path string, media_type string, line_no int"
REJECTED = "line_no int, line string, violations array<string>"


def records(spark, *changes):
    return spark.createDataFrame([tuple({**RECORD, **c}.values()) + (k + 1,) for k, c in enumerate(changes)], HANDOFF)


def ingest(spark, tmp_path, rows, texts=(("b", "It broke. It held.", None),), rejected=()):
    run = Run(spark, "ingest", f"file://{tmp_path}/runs")
    return stages.ingest(run, rows, spark.createDataFrame(list(rejected), REJECTED), spark.createDataFrame(list(texts), "blob_path string, text string, error string"))


def rules_of(spark, out):
    return {r["rule_id"]: r["passed"] for r in json.loads(sinks.read_small(spark, f"{out['run_dir']}/validation.json"))}


def test_ingestion_rules(spark, tmp_path):
    good = ingest(spark, tmp_path, records(spark, {}, {"docket_item_id": "ntsb:docket_item:N:2:t", "acquisition_run_id": "r"}))
    assert good["status"] == "certified" and all(rules_of(spark, good).values())
    assert good["input_count"] == 2 and good["quality"] == {"output_count": 2, "duplicate_key_count": 0, "missing_required_field_count": 0, "invalid_enum_count": 0}
    metadata = [json.loads(r[0]) for r in spark.read.parquet(f"{good['run_dir']}/outputs").select("metadata").collect()]
    assert sorted("acquisition_run_id" in m for m in metadata) == [False, True] and all("ordinal" in m for m in metadata)
    lines = [r[0] for r in spark.read.text(f"{good['run_dir']}/input_manifest").collect()]
    assert lines[0] == '{"blob_path": "b", "blob_sha256": "h", "docket_item_id": "ntsb:docket_item:N:1:s"}'

    def broken(rows, **more):
        out = ingest(spark, tmp_path, rows, **more)
        assert out["status"] == "failed"
        return {k for k, ok in rules_of(spark, out).items() if not ok}

    assert broken(records(spark, {}, {})) == {"ingestion_duplicate_keys_absent", "ingestion_output_count_matches_expected"}
    assert broken(records(spark, {"title": ""})) == {"ingestion_required_fields_present"}
    assert broken(records(spark, {"media_type": "text/html"})) == {"failure_threshold"}
    assert broken(records(spark, {}), texts=[]) == {"failure_threshold"}
    assert broken(records(spark, {}), rejected=[(9, "[]", ["not_an_object"])]) == {"failure_threshold"}


def test_text_pair_rule_reads_what_was_stored(spark, tmp_path, monkeypatch):
    whole = stages._whole
    monkeypatch.setattr(stages, "_whole", whole)
    finish = Run.finish
    monkeypatch.setattr(Run, "finish", lambda self, rows, *a, **k: finish(self, rows.withColumn("text", F.lit(None).cast("string")), *a, **k))
    out = ingest(spark, tmp_path, records(spark, {}))
    assert out["blocking"] == ["ingestion_text_pairs_exist"]


def test_triage_rules(spark, tmp_path, monkeypatch):
    schema = "docket_item_id string, ntsb_number string, title string, blob_sha256 string, text string"
    run = lambda rows: stages.triage(Run(spark, "triage", f"file://{tmp_path}/runs"), spark.createDataFrame(rows, schema))
    assert run([("i", "N", "Factual report", "h", "t")])["status"] == "certified"
    assert run([("i", "N", "Factual report", "h", "t"), ("i", "N", "Factual report", "h", "t")])["blocking"] == ["triage_output_count_matches_expected", "triage_duplicate_keys_absent"]
    assert run([("i", "N", None, "h", "t")])["blocking"] == ["triage_required_fields_present"]
    assert run([("i", "N", "T", "h", None)])["blocking"] == ["failure_threshold"]
    real = classify.triage
    monkeypatch.setattr(classify, "triage", lambda d: real(d).withColumn("inferred_document_type", F.lit("novel")))
    assert run([("i", "N", "Factual report", "h", "t")])["blocking"] == ["triage_enum_values_valid"]


def test_narrative_rules(spark, tmp_path, monkeypatch):
    schema = "docket_item_id string, ntsb_number string, title string, inferred_document_type string, text string"
    rows = [("ntsb:docket_item:N:1:a", "N", "A", "factual_report", "t"), ("ntsb:docket_item:M:1:a", "M", "A", "unknown", "t")]
    run = lambda rows: stages.narratives(Run(spark, "narrative", f"file://{tmp_path}/runs"), spark.createDataFrame(rows, schema))
    good = run(rows)
    assert good["status"] == "certified" and good["records_seen"] == 2
    assert run([*rows, ("elsewhere", "N", "A", "unknown", "t")])["blocking"] == ["failure_threshold"]
    real = narrative.primary_narrative

    def with_output(change):
        monkeypatch.setattr(narrative, "primary_narrative", lambda d: change(real(d)))
        return run(rows)["blocking"]

    assert with_output(lambda d: d.where("docket_id = 'N'")) == ["narrative_output_count_matches_expected"]
    assert with_output(lambda d: d.withColumn("selection_reason", F.lit(""))) == ["narrative_required_fields_present"]
    assert with_output(lambda d: d.unionByName(d)) == ["narrative_duplicate_keys_absent"]
    assert with_output(lambda d: d.withColumn("selected_document_id", F.lit("other"))) == ["narrative_anchor_exists_in_input_set"]
    # The document of another docket is no anchor either.
    assert with_output(lambda d: d.withColumn("selected_document_id", F.lit("ntsb:docket_item:N:1:a"))) == ["narrative_anchor_exists_in_input_set"]


DOCUMENTS = "doc_id string, docket_item_id string, ntsb_number string, case_number string, status string, stage string, text string"


def documents(spark, *rows):
    return spark.createDataFrame([(i, f"item-{i}", "N", None, "completed", "extraction", t) for i, t in rows], DOCUMENTS)


def test_span_rules_and_reproducibility(spark, tmp_path):
    root = f"file://{tmp_path}/runs"
    d = documents(spark, ("d", "It broke. It held.\n\nIt was cold."))
    first = stages.sentence_spans(Run(spark, "sentence_spans", root), d)
    assert first["status"] == "certified"
    stored = spark.read.parquet(f"{first['run_dir']}/outputs")
    assert json.loads(stored.orderBy("sentence_span_id").first().locator).keys() >= {"type", "paragraph", "sentence"}
    failing = lambda rows: [r[0].removeprefix("sentence_spans_") for r in stages.span_rules(rows) if not r[2]]
    assert failing(stored) == []
    assert failing(stored.withColumn("sentence_text", F.lit(" "))) == ["non_empty_text"]
    assert failing(stored.unionByName(stored)) == ["duplicate_ids_absent", "sequential_indexes"]
    assert failing(stored.withColumn("sentence_index", F.col("sentence_index") + 1)) == ["sequential_indexes"]
    assert failing(stored.withColumn("artifact_id", F.lit(""))) == ["trace_to_artifact"]
    assert failing(stored.withColumn("segmentation_version", F.lit(None).cast("string"))) == ["segmentation_version_present"]
    # The same input must give the same spans; other input need not.
    assert stages.sentence_spans(Run(spark, "sentence_spans", root), d)["status"] == "certified"
    p = f"{first['run_dir']}/run_summary.json"
    for x in (p, p.replace(first["run_id"].replace(":", ""), stages.latest_certified(spark, root, "sentence_spans")["run_id"].replace(":", ""))):
        told = json.loads(sinks.read_small(spark, x))
        sinks.write_atomic(spark, x, json.dumps(told | {"output_digest": "other"}))
    assert stages.sentence_spans(Run(spark, "sentence_spans", root), d)["blocking"] == ["sentence_spans_reproducible_for_same_input_digest"]
    assert stages.sentence_spans(Run(spark, "sentence_spans", root), documents(spark, ("e", "Other.")))["status"] == "certified"


def test_atomic_input_must_be_a_certified_run(spark, tmp_path):
    root = f"file://{tmp_path}/runs"
    with pytest.raises(ValueError, match="no certified"):
        stages.certified_spans(spark, root)
    good = stages.sentence_spans(Run(spark, "sentence_spans", root), documents(spark, ("d", "It broke.")))
    bad = stages.sentence_spans(Run(spark, "sentence_spans", root), documents(spark, ("d", "It."), ("d", "It.")))
    assert bad["status"] == "failed" and stages.certified_spans(spark, root)[0]["run_id"] == good["run_id"]
    assert stages.certified_spans(spark, root, f"{good['run_dir']}/outputs")[1].count() == 1
    for path, why in ((f"{good['run_dir']}/failures", "must be the outputs"), (f"file://{tmp_path}/elsewhere/x/outputs", "must be under"), (f"{bad['run_dir']}/outputs", "not certified")):
        with pytest.raises(ValueError, match=why):
            stages.certified_spans(spark, root, path)
    sinks.write_atomic(spark, f"{bad['run_dir']}/_CERTIFIED", "x")
    with pytest.raises(ValueError, match="failed run"):
        stages.certified_spans(spark, root, f"{bad['run_dir']}/outputs")


def test_stored_results_are_held_against_the_contract_again(spark):
    spans = spark.createDataFrame([("s", "It broke.")], "sentence_span_id string, sentence_text string")
    claim = ("c", "It broke", "stated", "affirmed", "statement", False)
    link = lambda kind, ids: [(kind, "x", ids)]
    cases = {
        None: ("s", "ok", [claim], link("events", ["c"]), [], []),
        "sentence_span_ids_match_input": ("t", "ok", [claim], [], [], []),
        "required_fields_present": ("s", "ok", [("c", " ", *claim[2:])], [], [], []),
        "enum_values_valid": ("s", "ok", [("c", "It broke", "sung", *claim[3:])], [], [], []),
        "duplicate_atomic_claim_ids_absent": ("s", "ok", [claim, claim], [], [], []),
        "ontology_links_reference_valid_claims": ("s", "ok", [claim], link("events", ["z"]), [], []),
        "unprocessable_contract_enforced": ("s", "unprocessable", [], [], [], []),
        "causal_candidates_require_explicit_language": ("s", "ok", [claim], link("causal_factors", ["c"]), [], []),
    }
    for broken, row in cases.items():
        found = atomic.stored_violations(spark.createDataFrame([row], ATOMIC_RESULT), spans).first().asDict()
        assert {k for k, n in found.items() if n} == ({broken} if broken else set())


def test_request_and_response_bodies(spark):
    spans = spark.createDataFrame([(f"s{i}", "Text.") for i in range(25)], "sentence_span_id string, sentence_text string")
    rows = atomic.api_requests(spans, "job", size=10).collect()
    bodies = [json.loads(r.body) for r in rows]
    assert sorted(x["sentence_span_id"] for b in bodies for x in b["items"]) == sorted(f"s{i}" for i in range(25))
    assert all(b["job_id"] == "job" and b["model_contract_version"] == "sentence-to-atomic-v1" for b in bodies) and len(rows) <= 3
    reply = json.dumps({"job_id": "job", "results": [{"sentence_span_id": "s1", "status": "unprocessable", "atomic_claims": [], "ontology_candidates": [], "unresolved": [{"reason": "r"}], "warnings": []}]})
    r = atomic.api_results(spark.createDataFrame([(reply,)], "body string")).first()
    assert (r.job_id, r.sentence_span_id, r.status, r.unresolved[0].reason) == ("job", "s1", "unprocessable", "r")


def test_files_of_a_run_are_looked_at(spark, tmp_path):
    assert [r[0] for r in certify.file_rules(["outputs"], ["failures"]) if not r[2]] == ["outputs_present", "json_parses"]
    assert [r[0] for r in certify.envelope({"records_seen": 2, "records_succeeded": 1, "records_failed": 0, "records_skipped": 0}, 1, ["a"], status="stopped") if not r[2]] == ["run_completed", "counts_reconcile", "failures_recorded"]
    out = ingest(spark, tmp_path, records(spark, {}))
    run = Run(spark, "ingest", f"file://{tmp_path}/runs")
    run.dir = out["run_dir"]
    assert run.broken(["metrics.json", "failures", "input_manifest"]) == []
    sinks.write_atomic(spark, f"{run.dir}/metrics.json", "{")
    sinks.write_atomic(spark, f"{run.dir}/failures/part-x", "{} \nnot json\n")
    assert run.broken(["metrics.json", "failures", "input_manifest"]) == ["metrics.json", "failures"]


def test_summary_of_another_name(spark, tmp_path):
    d = f"file://{tmp_path}/r"
    with pytest.raises(ValueError, match="0 run summaries"):
        load_summary(spark, d)
    sinks.write_atomic(spark, f"{d}/a_run_summary.json", '{"x": 1}')
    assert load_summary(spark, d) == {"x": 1}
    sinks.write_atomic(spark, f"{d}/b_run_summary.json", '{"x": 2}')
    with pytest.raises(ValueError, match="2 run summaries"):
        load_summary(spark, d)
    sinks.write_atomic(spark, f"{d}/run_summary.json", '{"x": 3}')
    assert load_summary(spark, d) == {"x": 3}


def test_distribution_of_many_values(spark, tmp_path):
    run = Run(spark, "many", f"file://{tmp_path}/runs")
    rows = spark.range(1500).selectExpr("cast(id as string) as k", "cast(id % 1200 as string) as v")
    none = spark.createDataFrame([], "run_id string")
    out = run.finish(rows, none, {"records_seen": 1500, "records_succeeded": 1500, "records_failed": 0, "records_skipped": 0}, F.col("k"), distributions={"v": certify.distribution(rows, "v")})
    assert len(out["distributions"]["v"]) == 1000 and out["distributions_shown_in_part"] == ["v"]
    assert spark.read.parquet(f"{run.dir}/distribution_v").count() == 1200


def test_structure_trace(spark):
    text = "A Title\nintro\nPROBABLE CAUSE\nIt broke.\nAPPENDIX\nlater"
    r = structure.trace(spark.createDataFrame([("d", text), ("e", None)], "doc_id string, text string")).orderBy("doc_id").collect()
    d = r[0]
    kinds = [x.kind for x in d.line_assignments]
    assert kinds == [x.kind for x in structure.line_assignments(spark.createDataFrame([("d", text)], "doc_id string, text string")).orderBy("line_index").collect()]
    assert [x.line_index for x in d.line_assignments] == list(range(6)) and d.title_line_index == 0
    assert d.section_order[-1] == "probable_cause" and d.sections[-1].header_line_indexes == [2] and d.sections[-1].body_line_indexes == [3]
    assert (d.line_assignments[3].active_section_before, d.line_assignments[3].active_section_after) == ("probable_cause", "probable_cause")
    assert d.line_assignments[4].active_section_after is None and d.unclassified_line_indexes == [5]
    assert r[1].line_assignments == [] and r[1].sections == []


def test_an_item_needs_a_title(spark):
    schema = "ntsb_number string, ordinal int, title string, normalized_title_slug string, docket_item_id string, is_active boolean"
    one = state.item_payloads(spark.createDataFrame([(" N ", 2, " A title ", None, None, None)], schema)).first()
    assert (one.docket_item_id, one.title, one.is_active) == ("ntsb:docket_item:N:2:a_title", "A title", True)
    for blank in ("  ", None):
        with pytest.raises(Exception, match="title is required"):
            state.item_payloads(spark.createDataFrame([("N", 2, blank, None, None, None)], schema)).collect()
