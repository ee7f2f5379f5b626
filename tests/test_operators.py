"""Evidence operators on small vectors."""

import random

import pytest
from pyspark.sql import functions as F

from caseloom.functions import rules as R
from caseloom.operators import atomic, cases, certify, classify, narrative, registry, spans, state, structure
from caseloom.schemas import SCHEMAS, empty


def docs(spark, *texts):
    return spark.createDataFrame([(f"a{i}", "c", t, "x", "v") for i, t in enumerate(texts)], "artifact_id string, case_id string, text string, artifact_checksum string, text_extraction_version string")


def test_sentences(spark):
    text = "Dr. Smith paid 3.50 today. Then U.S. officials left! (Why?) \"Yes.\" done... ok.\n\n- one. Two\n- three\n\nNOTE: x"
    rows = spans.sentence_spans(docs(spark, text, None, " ")).collect()
    assert [r.sentence_text for r in rows] == ["Dr. Smith paid 3.50 today.", "Then U.S. officials left!", "(Why?) \"Yes.\" done... ok.", "- one.", "Two", "- three", "NOTE: x"]
    assert [r.sentence_index for r in rows] == [1, 2, 3, 1, 2, 1, 1] and [r.locator.paragraph for r in rows] == [1, 1, 1, 2, 2, 3, 4]
    assert rows[1].context.preceding_text == rows[0].sentence_text and rows[2].context.following_text == ""
    assert all(r.sequential for r in spans.index_check(spans.sentence_spans(docs(spark, text))).collect())


def test_span_ids_do_not_depend_on_partitions(spark):
    df = docs(spark, *[f"One {i}. Two {i}." for i in range(20)])
    ids = lambda d: sorted(r[0] for r in spans.sentence_spans(d).select("sentence_span_id").collect())
    assert ids(df.repartition(1)) == ids(df.repartition(7))


TITLES = [
    ("Preliminary Report factual report", "preliminary_report"), ("Materials Lab report", "materials_report"), ("Emergency Preparedness", "emergency_response_report"), ("Factual Report interview", "factual_report"), ("Transcript of talks", "interview_transcript"),
    ("Agency report transcript", "unknown"), ("Investigative report", "investigation_report"), ("PAR-x", "investigation_report"), ("Final report", "investigation_report"), ("Police report final report", "regulatory_report"), ("Aviation accident report", "investigation_report"),
    ("DOT accident report pipeline", "external_reference"), ("PSR 12", "investigation_report"), ("Exhibit 4", "attachment_appendix"), ("Governor's review council report", "regulatory_report"), ("Newsletter", "external_reference"), ("", "unknown"),
]


def test_document_types(spark):
    rows = spark.createDataFrame([(i, t, None) for i, (t, _) in enumerate(TITLES)], "i int, title string, text string")
    assert [r.inferred_document_type for r in classify.triage(rows).orderBy("i").collect()] == [k for _, k in TITLES]
    texts = spark.createDataFrame([("x", "see the metallurgical study"), ("x", "an interview"), (None, "investigation report")], "title string, text string")
    assert [r.inferred_document_type for r in classify.triage(texts).collect()] == ["materials_report", "unknown", "investigation_report"]


def test_narrative_order(spark):
    rows = [("d1", "b", "factual_report", "long title", "x"), ("d1", "a", "investigation_report", "t", "x"), ("d2", "b", "unknown", "same", "short"), ("d2", "a", "unknown", "same", "longer text"), ("d3", "z", "unknown", "", "text"), ("d4", "y", "unknown", None, None), ("d4", "x", "unknown", "", None)]
    df = spark.createDataFrame(rows, "docket_id string, docket_item_id string, inferred_document_type string, title string, text string")
    got = {r.docket_id: (r.selected_document_id, r.selection_reason) for r in narrative.primary_narrative(df).collect()}
    assert got == {"d1": ("a", "selected highest-priority document_type investigation_report"), "d2": ("a", "selected fallback longest title"), "d3": ("z", "selected fallback available text"), "d4": ("x", "selected fallback first document")}


def line_kinds(flags):
    """The line rules one by one: a heading opens a section, a stop ends it, and what follows belongs to none."""
    out, key, ended = [], "abstract", False
    for f in flags:
        if f == "H":
            key, ended = "analysis", False
            out.append(("section_header", key))
        elif f == " ":
            out.append(("noise", None))
        elif f == "S":
            ended = True
            out.append(("stop_header", None))
        else:
            out.append(("unclassified", None) if ended else ("section_body", key))
    return out


def test_structure_agrees_with_the_line_by_line_rule(spark):
    rng = random.Random(1)
    texts = {"H": "ANALYSIS", " ": " ", "S": "APPENDIX B", "b": "some body words"}
    cases_ = ["".join(rng.choice("H Sb") for _ in range(rng.randrange(1, 12))) for _ in range(60)]
    long = "x " * 100  # too long for a title, so every first line is a body line
    df = spark.createDataFrame([(i, "\n".join([long, *[texts[f] for f in c]])) for i, c in enumerate(cases_)], "doc_id int, text string")
    got = {}
    for r in structure.line_assignments(df).orderBy("doc_id", "line_index").collect():
        got.setdefault(r.doc_id, []).append((r.kind, r.section_key))
    for i, c in enumerate(cases_):
        assert got[i][1:] == line_kinds(c), c


def test_structure_rejects_headings_that_stop(spark):
    with pytest.raises(ValueError):
        structure.line_assignments(spark.createDataFrame([(1, "a")], "doc_id int, text string"), {"APPENDIX": "x"})


def test_report(spark):
    text = "The title here\nintro\nFACTUAL INFORMATION\nf1\n2.1 Fire\nf2\nPROBABLE CAUSE\nold\nPROBABLE CAUSE\n\nWhat we recommended\n do it \n"
    r = structure.report_structure(spark.createDataFrame([("a", text), ("b", None), ("c", "")], "doc_id string, text string")).orderBy("doc_id").collect()
    assert r[0].title == "The title here" and [x.section_key for x in r[0].sections] == ["abstract", "what_we_recommended", "factual_information", "probable_cause"]
    assert r[0].sections[2].text == "f1\n\n2.1 Fire\nf2" and r[0].probable_cause == "old" and r[0].recommendations == "do it"
    assert r[1].sections == [] and r[2].sections == [] and r[2].title is None


def item(spark, *rows):
    """(id, ordinal, title, active)"""
    full = []
    for i, o, t, active in rows:
        d = dict.fromkeys([c.split()[0] for c in SCHEMAS["docket_items_current"].split(", ")])
        d |= {"docket_item_id": i, "ntsb_number": "N1", "ordinal": o, "normalized_title_slug": "s", "title": t, "is_active": active, "selection_selected": True, "first_seen_at": "t1", "last_seen_at": "t1", "last_run_id": "r1"}
        full.append(d)
    return spark.createDataFrame(full, SCHEMAS["docket_items_current"])


def test_item_replacement(spark):
    now = item(spark, ("i1", 1, "a", True), ("i2", 2, "b", True), ("i3", 3, "c", False), ("i5", 5, "e", True))
    seen = item(spark, ("i1", 1, "a", True), ("n2", 2, "renamed", True), ("i3", 3, "c", True), ("i4", 4, "d", True))
    merged = state.replace_items(now, seen, "t2", "r2")
    assert {r.ordinal: r.outcome for r in merged.collect()} == {1: "unchanged", 2: "updated", 3: "reactivated", 4: "inserted", 5: "deactivated"}
    assert state.replace_counts(merged).first().asDict() == {"inserted": 1, "updated": 1, "reactivated": 1, "deactivated": 1, "unchanged": 1, "replaced": 1, "active_count": 4}
    gone = merged.where("ordinal = 5").first()
    assert (gone.last_seen_at, gone.last_run_id, gone.is_active, gone.selection_selected) == ("t1", "r2", False, True)
    children = spark.createDataFrame([("i2", "blob"), ("i1", "other")], "docket_item_id string, blob string")
    assert {r.docket_item_id for r in state.cascade_ids(children, merged).collect()} == {"n2", "i1"}
    none = state.replace_items(now, seen.limit(0), "t2", "r2", enumerated=spark.createDataFrame([("N1",)], "ntsb_number string"))
    assert none.where("is_active").count() == 0
    with pytest.raises(Exception, match="duplicate ordinal"):
        state.replace_items(now, seen.unionByName(seen), "t2", "r2").collect()


def test_merge_is_idempotent(spark):
    key, material = state.MATERIAL["promotions_current"]
    schema = f"{key} string, {', '.join(c + ' string' for c in material)}, first_seen_at string, last_seen_at string, last_run_id string"
    seen = spark.createDataFrame([("k", *["v"] * len(material), None, None, None)], schema)
    one = state.merge(spark.createDataFrame([], schema), seen, key, material, "t1", "r1")
    two = state.merge(one.drop("changed"), seen, key, material, "t2", "r2").first()
    assert one.first().changed and not two.changed and (two.first_seen_at, two.last_seen_at) == ("t1", "t2")


def test_blobs_keep_their_first_download(spark):
    b = spark.createDataFrame([("h", "p", "m", 3)], "blob_sha256 string, blob_path string, media_type string, size_bytes long")
    one = state.register_blobs(empty(spark, "blobs_current"), b.unionByName(b), "t1", "r1")
    two = state.register_blobs(one, b, "t2", "r2").collect()
    assert len(two) == 1 and (two[0].first_downloaded_at, two[0].first_run_id, two[0].last_verified_at) == ("t1", "r1", "t2")


def test_downloads_are_reused_by_fingerprint_and_file(spark):
    items = item(spark, ("a", 1, "x", True), ("b", 2, "x", True), ("c", 3, "x", True))
    d = spark.createDataFrame([("a", None, "p1"), ("b", "other", "p1"), ("c", None, "gone")], "docket_item_id string, source_fingerprint string, blob_path string")
    stored = spark.createDataFrame([("p1",)], "blob_path string")
    assert {r.docket_item_id: r.reuse for r in cases.download_plan(items, d, stored).collect()} == {"a": True, "b": False, "c": False}


def test_promotion_and_case_view(spark):
    s = spark.createDataFrame([("N", "i1", 1, "slug", "http://h/x.pdf", "a" * 64, "p", "application/pdf"), ("N", "i2", 2, "slug", "http://h/y", "b" * 64, "p", "application/pdf"), ("N", "i3", 3, "slug", "http://h/z", "c" * 64, "p", None)], "ntsb_number string, docket_item_id string, ordinal int, normalized_title_slug string, source_url string, blob_sha256 string, blob_path string, media_type string")
    there = spark.createDataFrame([(f"N/i1__{'a' * 16}.pdf", "a" * 64), (f"N/i2__{'b' * 16}.pdf", "zz")], "promoted_path string, sha256 string")
    assert {r.docket_item_id: r.action for r in cases.promotion_plan(s, there).collect()} == {"i1": "reuse", "i2": "conflict", "i3": "copy"}
    assert sorted(r.file_name for r in cases.case_view(s).collect()) == ["001_slug.pdf", "002_slug.pdf", "003_slug.bin"]


def test_registration_order_of_tests(spark):
    rows = [(1, "b1", "x.pdf", "application/pdf", "/p1", "b1"), (2, "b1", "x.pdf", "application/pdf", "/p1", "b1"), (3, "b2", "x.txt", "text/plain", "/p2", "b2"), (4, "b3", "x.pdf", None, None, None), (5, "b4", "x.pdf", None, "/p4", "zz"), (6, "b5", "x.pdf", None, "/known", "b5"), (7, "b6", "x.pdf", None, "/p6", "b6")]
    r = spark.createDataFrame(rows, "line_no long, blob_sha256 string, blob_path string, media_type string, raw_path string, found_sha256 string").withColumn("file_size", F.lit(1).cast("long"))
    known = empty(spark, "documents").unionByName(spark.createDataFrame([("d", "/known", "other"), ("e", "/else", "b6")], "doc_id string, raw_path string, sha256 string"), allowMissingColumns=True)
    out = registry.registration_outcomes(r, known)
    assert {x.line_no: x.outcome for x in out.collect()} == {1: "inserted", 2: "duplicate_blob", 3: "unsupported", 4: "missing", 5: "hash_mismatch", 6: "path_conflict", 7: "backfilled_by_sha"}
    assert {x.doc_id: x.raw_path for x in registry.reconcile(known, out).collect()} == {"d": "/known", "e": "/p6"}


def test_atomic_contract(spark):
    s = spans.sentence_spans(docs(spark, "It failed because of rust. It held."))
    good = atomic.stated_claims(s)
    assert all(r.violations == [] for r in atomic.validate_results(good, s).collect())
    boom = atomic.transform(s, lambda span: 1 / 0, per_row=True).collect()
    assert {r.status for r in boom} == {"error"} and "ZeroDivisionError" in boom[0].warnings[0]
    with pytest.raises(RuntimeError):
        atomic.transform(s, None)
    claim = {"atomic_claim_id": "a", "claim_text": "x", "assertion_mode": "stated", "polarity": "maybe", "claim_type": "statement", "needs_review": False}
    bad = atomic.transform(s, lambda span: {"sentence_span_id": span["sentence_span_id"], "status": "ok", "atomic_claims": [claim], "ontology_candidates": [{"candidate_type": "causal_factors", "candidate_text": "c", "linked_claim_ids": ["a"]}], "unresolved": [], "warnings": []}, per_row=True)
    assert sorted(tuple(r.violations) for r in atomic.validate_results(bad, s).collect()) == [("polarity_invalid",), ("polarity_invalid", "causal_language_missing")]


def test_rules_and_thresholds(spark):
    rules = certify.as_rules(spark, [("a", "error", True, ""), ("b", "warning", True, ""), ("c", "error", False, "")])
    assert certify.rule_summary(rules).first().asDict() == {"evaluated": 3, "passed": 2, "failed": 1, "warnings": 1}
    ok = lambda f, n, **k: spark.range(1).select(certify.within_threshold(F.lit(f), F.lit(n), **k)).first()[0]
    assert ok(0, 0) and not ok(1, 10) and ok(1, 10, max_count=1, max_rate=0.1)


def test_rule_values_are_disjoint():
    assert not set(R.HEADINGS) & set(R.STOP_HEADINGS) and set(R.HEADINGS.values()) <= set(R.SECTION_ORDER) and len(R.DOCUMENT_TYPES) == 10
