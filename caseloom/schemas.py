"""Record schemas as DDL; ``empty`` gives a table of one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

SEEN = "first_seen_at string, last_seen_at string, last_run_id string"

SCHEMAS = {
    "investigations_current": f"ntsb_number string, investigation_id string, project_id string, mode string, event_date string, title string, case_type string, location_json string, carol_metadata_json string, source_fingerprint string, {SEEN}",
    "dockets_current": f"ntsb_number string, docket_id string, project_id string, mode string, public_url string, item_count int, creation_date string, last_modified string, public_release_at string, raw_html_path string, retrieved_at string, source_fingerprint string, {SEEN}",
    "docket_search_results_current": f"ntsb_number string, project_id string, result_url string, event_date string, city string, state_or_region string, docket_details string, accident_description string, source_fingerprint string, {SEEN}",
    "docket_items_current": f"docket_item_id string, ntsb_number string, ordinal int, normalized_title_slug string, title string, page_count int, photo_count int, display_type string, view_url string, download_url string, source_fingerprint string, selection_selected boolean, selection_rule_version string, selection_matched_rules_json string, selection_rationale string, is_active boolean, {SEEN}",
    "blobs_current": "blob_sha256 string, blob_path string, media_type string, size_bytes long, first_downloaded_at string, first_run_id string, last_verified_at string",
    "downloads_current": "docket_item_id string, ntsb_number string, source_url string, source_fingerprint string, blob_sha256 string, blob_path string, media_type string, size_bytes long, http_status int, downloaded_at string, last_run_id string",
    "promotions_current": "docket_item_id string, ntsb_number string, blob_sha256 string, promoted_path string, rule_version string, matched_rules_json string, rationale string, promoted_at string, last_run_id string",
    "documents": "doc_id string, jurisdiction string, case_number string, filing_date string, doc_type string, source_url string, project_id string, ntsb_number string, docket_item_id string, acquisition_run_id string, blob_sha256 string, blob_path string, media_type string, source_manifest_path string, raw_path string, sha256 string, file_size long, extracted_text_path string, structured_json_path string, structured_debug_path string, status string, stage string, ingested_at string, last_processed_at string, error_message string",
    "handoff": "project_id string, ntsb_number string, docket_item_id string, acquisition_run_id string, ordinal int, title string, view_url string, source_url string, blob_sha256 string, blob_path string, media_type string",
    "failures": "run_id string, stage_name string, record_id string, artifact_id string, failure_code string, failure_class string, message string, retryable boolean, blocked_output string, source_locator string, exception_type string",
}

CLAIM = "struct<atomic_claim_id:string,claim_text:string,assertion_mode:string,polarity:string,claim_type:string,needs_review:boolean>"
CANDIDATE = "struct<candidate_type:string,candidate_text:string,linked_claim_ids:array<string>>"
UNRESOLVED = "struct<reason:string,related_claim_ids:array<string>>"
ATOMIC_RESULT = f"sentence_span_id string, status string, atomic_claims array<{CLAIM}>, ontology_candidates array<{CANDIDATE}>, unresolved array<{UNRESOLVED}>, warnings array<string>"


def empty(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([], SCHEMAS[name])
