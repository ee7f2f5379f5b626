"""Atomic extraction: a pluggable transformer over sentence spans, and the contract its results are held against.

Violations are arrays of codes computed beside each result, so one pass gives accepted rows, failures and all counts.
"""

from __future__ import annotations

import importlib
import json
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import rules as R
from caseloom.functions.text import strip
from caseloom.schemas import ATOMIC_RESULT, CANDIDATE, CLAIM, UNRESOLVED


def load_transformer(name: str) -> Callable:
    """A callable by "package.module:callable"."""
    module, _, attribute = name.partition(":")
    if not module or not attribute:
        raise ValueError("a transformer is named package.module:callable")
    found = getattr(importlib.import_module(module), attribute)
    if not callable(found):
        raise TypeError(f"{name} is not callable")
    return found


def stated_claims(spans: DataFrame) -> DataFrame:
    """The stand-in transformer: every sentence is one stated claim. Pure columns."""
    claim = F.struct(F.lit("ac:01").alias("atomic_claim_id"), strip(F.col("sentence_text")).alias("claim_text"), F.lit("stated").alias("assertion_mode"), F.lit("affirmed").alias("polarity"), F.lit("statement").alias("claim_type"), F.lit(False).alias("needs_review"))
    none = lambda t: F.array().cast(f"array<{t}>")
    return spans.select("sentence_span_id", F.lit("ok").alias("status"), F.array(claim).alias("atomic_claims"), none(CANDIDATE).alias("ontology_candidates"), none(UNRESOLVED).alias("unresolved"), none("string").alias("warnings"))


def transform(spans: DataFrame, transformer: Callable[[DataFrame], DataFrame] | Callable[[dict], dict] | None, per_row: bool = False) -> DataFrame:
    """Results of ``transformer``: a function of the spans DataFrame, or with ``per_row`` of one span's mapping, which
    runs in Arrow batches. An exception of one row becomes a result with status ``error`` and its message as the only
    warning. Without a transformer the run is refused."""
    if transformer is None:
        raise RuntimeError("no transformer is configured")
    if not per_row:
        return transformer(spans)

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text in batch["span"]:
                span = json.loads(text)
                try:
                    r = transformer(span)
                    out.append({k: r.get(k) for k in ("sentence_span_id", "status", "atomic_claims", "ontology_candidates", "unresolved", "warnings")})
                except Exception as e:  # one record's failure is a row, not the end of the run
                    out.append({"sentence_span_id": span["sentence_span_id"], "status": "error", "atomic_claims": [], "ontology_candidates": [], "unresolved": [], "warnings": [f"{type(e).__name__}: {e}"]})
            yield pd.DataFrame(out)

    return spans.select(F.to_json(F.struct("*")).alias("span")).mapInPandas(run, ATOMIC_RESULT)


def _missing(value: Column, code: str) -> Column:
    return F.when(value.isNull() | (F.btrim(value) == ""), F.lit(code))


def _outside(value: Column, allowed: tuple[str, ...], code: str) -> Column:
    return F.when(value.isNull() | ~value.isin(*allowed), F.lit(code))


def _present(codes: Column) -> Column:
    return F.filter(codes, lambda c: c.isNotNull())


def causal_language(sentence: Column, claims: Column, linked: Column) -> Column:
    """Whether the sentence or a linked claim has a causal marker (lower case, as a substring)."""
    texts = F.transform(F.filter(claims, lambda c: F.array_contains(linked, c["atomic_claim_id"])), lambda c: c["claim_text"])
    whole = F.lower(F.concat(sentence, F.lit("\n"), F.array_join(texts, " ")))
    return F.exists(F.array(*[F.lit(m) for m in R.CAUSAL_MARKERS]), lambda m: F.contains(whole, m))


def result_violations(sentence: Column, claims: Column, candidates: Column, unresolved: Column, status: Column, warnings: Column) -> Column:
    """Codes of every rule a result breaks, in the order the rules are read; none for a valid result."""
    ids = F.transform(claims, lambda c: c["atomic_claim_id"])
    each = F.flatten(F.transform(claims, lambda c: F.array(_missing(c["atomic_claim_id"], "claim_id_missing"), _missing(c["claim_text"], "claim_text_missing"), _outside(c["assertion_mode"], R.ASSERTION_MODES, "assertion_mode_invalid"), _outside(c["polarity"], R.POLARITIES, "polarity_invalid"), _outside(c["claim_type"], R.CLAIM_TYPES, "claim_type_invalid"), F.when(c["needs_review"].isNull(), F.lit("needs_review_missing")))))
    linked = lambda c: F.coalesce(c["linked_claim_ids"], F.array().cast("array<string>"))
    of_candidate = F.flatten(F.transform(candidates, lambda c: F.array(_outside(c["candidate_type"], R.CANDIDATE_TYPES, "candidate_type_invalid"), _missing(c["candidate_text"], "candidate_text_missing"), F.when(F.size(F.array_except(linked(c), ids)) > 0, F.lit("unknown_claim_link")), F.when((c["candidate_type"] == "causal_factors") & ~causal_language(sentence, claims, linked(c)), F.lit("causal_language_missing")))))
    of_unresolved = F.transform(unresolved, lambda u: _missing(u["reason"], "unresolved_reason_missing"))
    lists = F.array(*[F.when(c.isNull(), F.lit(f"{n}_missing")) for n, c in (("atomic_claims", claims), ("ontology_candidates", candidates), ("unresolved", unresolved), ("warnings", warnings))])
    some = lambda c: F.coalesce(F.size(c), F.lit(0)) > 0
    none = F.array().cast("array<string>")
    whole = F.array(
        _outside(status, R.STATUSES, "status_invalid"),
        F.when(F.size(F.array_distinct(ids)) < F.size(ids), F.lit("duplicate_claim_id")),
        F.when((status == "unprocessable") & some(claims), F.lit("unprocessable_with_claims")),
        F.when((status == "unprocessable") & some(candidates), F.lit("unprocessable_with_candidates")),
        F.when((status == "unprocessable") & ~some(unresolved), F.lit("unprocessable_without_reason")),
        F.when((status == "ok") & ~some(claims), F.lit("ok_without_claims")),
    )
    return _present(F.concat(lists, whole, *[F.coalesce(x, none) for x in (each, of_candidate, of_unresolved)]))


def validate_results(results: DataFrame, spans: DataFrame) -> DataFrame:
    """Results with ``violations`` (an unknown span is one); of spans with the same id one is taken."""
    known = spans.groupBy("sentence_span_id").agg(F.max("sentence_text").alias("__sentence"))
    j = results.join(known, "sentence_span_id", "left")
    found = result_violations(F.coalesce("__sentence", F.lit("")), *[F.col(c) for c in ("atomic_claims", "ontology_candidates", "unresolved", "status", "warnings")])
    return j.withColumn("violations", F.concat(F.when(F.col("__sentence").isNull(), F.array(F.lit("unknown_span"))).otherwise(F.array().cast("array<string>")), found)).drop("__sentence")


#: Which stored-result rule counts which violations; what none names lacks a field.
_RULES = {
    "sentence_span_ids_match_input": ("unknown_span",),
    "required_fields_present": (),
    "enum_values_valid": ("assertion_mode_invalid", "polarity_invalid", "claim_type_invalid", "candidate_type_invalid", "status_invalid"),
    "duplicate_atomic_claim_ids_absent": ("duplicate_claim_id",),
    "ontology_links_reference_valid_claims": ("unknown_claim_link",),
    "unprocessable_contract_enforced": ("unprocessable_with_claims", "unprocessable_with_candidates", "unprocessable_without_reason"),
    "causal_candidates_require_explicit_language": ("causal_language_missing",),
}


def stored_violations(stored: DataFrame, spans: DataFrame) -> DataFrame:
    """Stored results against the contract again: one row with the number of results that break each rule. A result
    whose span is unknown is counted there alone, another under the first rule it breaks."""
    named = [c for codes in _RULES.values() for c in codes]
    code = validate_results(stored.drop("violations"), spans).select(F.get("violations", F.lit(0)).alias("code"))
    return code.agg(*[F.count_if(F.col("code").isin(*codes) if codes else F.col("code").isNotNull() & ~F.col("code").isin(*named)).alias(k) for k, codes in _RULES.items()])


#: Versions that a request to a model names.
CONTRACT_VERSIONS = {"model_contract_version": "sentence-to-atomic-v1", "ontology_version": "minimal-ontology-v0.2", "mapping_contract_version": "mapping-contract-v0.1"}


def api_requests(spans: DataFrame, job_id: str, size: int = 100, versions: dict[str, str] = CONTRACT_VERSIONS) -> DataFrame:
    """Request bodies of about ``size`` spans each: job_id, batch, body. Spans are dealt by a hash of their id into as
    many batches as their number calls for, so no order over all spans is needed."""
    n = max(1, -(-spans.count() // size))
    item = F.struct(*[F.col(c) for c in sorted(spans.columns)])
    dealt = spans.select(F.pmod(F.xxhash64("sentence_span_id"), F.lit(n)).alias("batch"), F.col("sentence_span_id").alias("id"), item.alias("item"))
    packed = dealt.groupBy("batch").agg(F.transform(F.array_sort(F.collect_list(F.struct("id", "item"))), lambda x: x["item"]).alias("items"))
    body = F.to_json(F.struct(F.lit(job_id).alias("job_id"), *[F.lit(v).alias(k) for k, v in versions.items()], "items"))
    return packed.select(F.lit(job_id).alias("job_id"), "batch", body.alias("body"))


def api_results(responses: DataFrame) -> DataFrame:
    """Results in response bodies (body): job_id and the result's columns."""
    kind = f"job_id string, results array<struct<sentence_span_id:string,status:string,atomic_claims:array<{CLAIM}>,ontology_candidates:array<{CANDIDATE}>,unresolved:array<{UNRESOLVED}>,warnings:array<string>>>"
    parsed = responses.select(F.from_json("body", kind).alias("r"))
    return parsed.select("r.job_id", F.explode("r.results").alias("x")).select("job_id", "x.*")


def span_violations() -> Column:
    """Codes of what a sentence span lacks."""
    texts = ("sentence_span_id", "artifact_id", "case_id", "parent_structural_span_id", "sentence_text", "segmentation_version")
    return _present(F.array(*[_missing(F.col(c), f"{c}_missing") for c in texts], F.when(F.col("sentence_index").isNull() | (F.col("sentence_index") < 1), F.lit("sentence_index_invalid")), F.when(F.col("locator").isNull(), F.lit("locator_missing")), *[_missing(F.col(f"provenance.{c}"), f"provenance_{c}_missing") for c in ("artifact_checksum", "text_extraction_version", "segmentation_version")]))


def handoff_violations() -> Column:
    """Codes of what a hand-off record lacks: required texts and an integer ordinal."""
    texts = ("project_id", "ntsb_number", "docket_item_id", "title", "view_url", "source_url", "blob_sha256", "blob_path", "media_type")
    return _present(F.array(*[_missing(F.col(c), f"{c}_missing") for c in texts], F.when(F.col("ordinal").isNull(), F.lit("ordinal_missing"))))


def violation_counts(validated: DataFrame) -> DataFrame:
    """Results per violation code."""
    return validated.select(F.explode(F.array_distinct("violations")).alias("code")).groupBy("code").agg(F.count("*").alias("n"))


def distributions(results: DataFrame) -> DataFrame:
    """(measure, value, n) over status, assertion mode, polarity, claim type and candidate type; a missing value is
    "missing". One explode of a small array a row, then map-combined counts."""
    pair = lambda m, v: F.struct(F.lit(m).alias("measure"), F.coalesce(v, F.lit("missing")).alias("value"))
    claims = F.flatten(F.transform("atomic_claims", lambda c: F.array(pair("assertion_mode", c["assertion_mode"]), pair("polarity", c["polarity"]), pair("claim_type", c["claim_type"]))))
    candidates = F.transform("ontology_candidates", lambda c: pair("candidate_type", c["candidate_type"]))
    each = F.concat(F.array(pair("status", F.col("status"))), claims, candidates)
    return results.select(F.explode(each).alias("x")).groupBy("x.measure", "x.value").agg(F.count("*").alias("n"))
