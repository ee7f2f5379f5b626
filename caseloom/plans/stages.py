"""Batch stages: hand-off to text, types, primary narratives, structure, sentence spans and atomic claims."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import rules as R
from caseloom.functions.text import strip
from caseloom.operators import atomic, certify, classify, narrative, registry, spans, structure
from caseloom.plans.runs import Run, latest_certified, load_summary
from caseloom.schemas import empty
from caseloom.sources import sinks


def _whole(rows: DataFrame) -> Column:
    return F.to_json(F.struct(*sorted(rows.columns)), {"ignoreNullFields": "false"})


def _counts(seen: int, ok: int, failed: int, skipped: int = 0) -> dict:
    return {"records_seen": seen, "records_succeeded": ok, "records_failed": failed, "records_skipped": skipped}


def _by_kind(rows: DataFrame, column: str) -> tuple[int, int]:
    """(rows without a failure kind, rows with one), in one pass."""
    r = rows.agg(F.count_if(F.col(column).isNull()).alias("ok"), F.count_if(F.col(column).isNotNull()).alias("bad")).first()
    return r.ok, r.bad


#: Fields that a stage's output may not lack.
INGESTED = ("project_id", "ntsb_number", "docket_item_id", "ordinal", "title", "view_url", "source_url", "blob_sha256", "blob_path", "media_type")
TRIAGED = ("docket_item_id", "ntsb_number", "title", "blob_sha256", "inferred_document_type", "inference_basis")
NARRATED = ("docket_id", "selected_document_id", "inferred_document_type", "selection_reason")


def ingest(run: Run, records: DataFrame, rejected: DataFrame, texts: DataFrame) -> dict:
    """Hand-off records with the text of their blob. ``texts``: blob_path, text, error. Records of another media type,
    without a blob, or whose file cannot be read become failures, as do rejected manifest lines. A record's metadata is
    output without its optional run id where that is null."""
    ok_type = registry.ok_media(F.col("media_type"), F.col("docket_item_id"))
    one = texts.groupBy("blob_path").agg(F.min(F.struct(F.col("error").isNotNull(), "text", "error")).alias("t"))
    j = records.join(one, "blob_path", "left").withColumns({"text": F.col("t.text"), "error": F.col("t.error")}).drop("t")
    j = j.withColumn("kind", F.when(~ok_type, "unsupported").when(F.col("text").isNull() & F.col("error").isNull(), "missing").when(F.col("error").isNotNull(), "unreadable"))
    rows = j.where("kind is null").withColumn("metadata", metadata_json()).drop("kind", "error", "line_no")
    bad = j.where("kind is not null").select("docket_item_id", "kind", F.coalesce("error", F.col("kind")).alias("message"))
    bad = bad.unionByName(rejected.select(F.concat(F.lit("line:"), F.col("line_no")).alias("docket_item_id"), F.lit("invalid").alias("kind"), F.array_join("violations", ",").alias("message")))
    failures = certify.failure_rows(bad, run.run_id, run.stage, F.col("docket_item_id"), F.col("docket_item_id"), F.col("kind"), F.col("message"))
    (ok, failed), lines = _by_kind(j, "kind"), rejected.count()
    quality: dict = {}

    def rules(stored: DataFrame) -> list[tuple]:
        quality.update(certify.output_measures(stored, "docket_item_id", INGESTED).first().asDict())
        return [*certify.output_rules("ingestion", quality, ok), certify.count_rule("ingestion_text_pairs_exist", "text_pair_missing_count", stored.where("text is null").count())]

    inputs = records.select("docket_item_id", "blob_sha256", "blob_path")
    return run.finish(rows, failures, _counts(records.count() + lines, ok, failed + lines), _whole(rows), rules=rules, quality=quality, inputs=inputs, distributions={"media_type": certify.distribution(rows, "media_type")})


def metadata_json() -> Column:
    """A hand-off record as JSON; the optional run id is left out where it is null, other nulls are written."""
    named = ("project_id", "ntsb_number", "docket_item_id", "ordinal", "title", "view_url", "source_url", "blob_sha256", "blob_path", "media_type")
    json = lambda *c: F.to_json(F.struct(*sorted(c)), {"ignoreNullFields": "false"})
    return F.when(F.col("acquisition_run_id").isNull(), json(*named)).otherwise(json(*named, "acquisition_run_id"))


def triage(run: Run, items: DataFrame, upstream_root: str | None = None) -> dict:
    """Document type of each item; with ``upstream_root`` the input must be what ingestion certified."""
    up = _gate(run, items, upstream_root, "ingestion")
    typed = classify.triage(items.where("text is not null")).select("docket_item_id", "ntsb_number", "title", "blob_sha256", "inferred_document_type", "inference_basis", "text")
    bad = items.where("text is null")
    failures = certify.failure_rows(bad, run.run_id, run.stage, F.col("docket_item_id"), F.col("docket_item_id"), F.lit("missing"), F.lit("no text"))
    failed, ok = _by_kind(items, "text")
    quality: dict = {}

    def rules(stored: DataFrame) -> list[tuple]:
        quality.update(certify.output_measures(stored, "docket_item_id", TRIAGED, ("inferred_document_type", R.DOCUMENT_TYPES)).first().asDict())
        return [*certify.output_rules("triage", quality, ok), certify.count_rule("triage_enum_values_valid", "invalid_enum_count", quality["invalid_enum_count"])]

    return run.finish(typed, failures, _counts(items.count(), ok, failed), _whole(typed), rules=rules, quality=quality, inputs=items.select("docket_item_id", "blob_sha256"), distributions={"document_type": certify.distribution(typed, "inferred_document_type")}, upstream=up)


def narratives(run: Run, typed: DataFrame, upstream_root: str | None = None) -> dict:
    """Primary document of each docket; an item id of another form is a failure of its own. Seen are the dockets."""
    from caseloom.functions.identity import docket_of_item

    up = _gate(run, typed, upstream_root, "triage")
    keyed = typed.withColumn("docket_id", docket_of_item(F.col("docket_item_id")))
    rows = narrative.primary_narrative(keyed.where("docket_id is not null"))
    lost = keyed.where("docket_id is null")
    failures = certify.failure_rows(lost, run.run_id, run.stage, F.col("docket_item_id"), F.col("docket_item_id"), F.lit("invalid"), F.lit("not a docket item id"))
    ok, failed = keyed.where("docket_id is not null").select("docket_id").distinct().count(), lost.count()
    quality: dict = {}

    def rules(stored: DataFrame) -> list[tuple]:
        quality.update(certify.output_measures(stored, "docket_id", NARRATED, ("inferred_document_type", R.DOCUMENT_TYPES)).first().asDict())
        candidates = keyed.select("docket_id", F.col("docket_item_id").alias("selected_document_id")).distinct()
        strange = stored.join(candidates, ["docket_id", "selected_document_id"], "left_anti").count()
        return [*certify.output_rules("narrative", quality, ok), certify.count_rule("narrative_anchor_exists_in_input_set", "anchor_missing_count", strange)]

    return run.finish(rows, failures, _counts(ok + failed, ok, failed), _whole(rows), rules=rules, quality=quality, inputs=typed.select("docket_item_id", "inferred_document_type"), distributions={"document_type": certify.distribution(rows, "inferred_document_type")}, upstream=up)


def structures(run: Run, documents: DataFrame, done: DataFrame | None = None, overwrite: bool = False, trace: bool = False) -> dict:
    """Sections of completed documents; those already parsed are reused. ``trace`` also writes every document's lines
    with what became of them, under the run's ``trace``."""
    todo, reused = (documents, None) if done is None else registry.todo(documents, done, "doc_id", overwrite)
    rows = structure.report_structure(todo.where("text is not null")).withColumn("sections", F.to_json("sections"))
    failures = certify.failure_rows(todo.where("text is null"), run.run_id, run.stage, F.col("doc_id"), F.col("doc_id"), F.lit("missing"), F.lit("no text"))
    failed, ok = _by_kind(todo, "text")
    if trace:
        structure.trace(todo.where("text is not null")).write.mode("overwrite").json(f"{run.dir}/trace", ignoreNullFields=False)
    quality: dict = {}

    def rules(stored: DataFrame) -> list[tuple]:
        quality.update(certify.output_measures(stored, "doc_id", ("doc_id",)).first().asDict())
        return certify.output_rules("structure", quality, ok)

    return run.finish(rows, failures, _counts(documents.count(), ok, failed, reused.count() if reused is not None else 0), _whole(rows), rules=rules, quality=quality, inputs=todo.select("doc_id"))


def sentence_spans(run: Run, documents: DataFrame, method: str = "unknown", ocr_engine: str = "unknown") -> dict:
    """Spans of completed documents, with the short envelope; structure does not take documents away from it. Locator,
    provenance and context are JSON texts in the output."""
    done = documents.where("status = 'completed'")
    rows = spans.sentence_spans(spans.span_inputs(done.where("text is not null"), method, ocr_engine))
    rows = rows.withColumns({c: F.to_json(c) for c in ("locator", "provenance", "context")})
    bad = done.where("text is null")
    failures = certify.failure_rows(bad, run.run_id, run.stage, F.col("doc_id"), F.col("doc_id"), F.lit("missing"), F.lit("no text"))
    failed, ok = _by_kind(done, "text")
    seen = certify.set_digest(done, F.to_json(F.struct("doc_id", F.sha2("text", 256).alias("text")))).first().digest
    quality: dict = {}
    return run.finish(rows, failures, _counts(done.count(), ok, failed), _whole(rows), rules=lambda stored: span_rules(stored, quality), quality=quality, short_envelope=True, inputs=done.select("doc_id", F.sha2("text", 256).alias("text_sha256")), input_digest=seen)


def span_rules(stored: DataFrame, quality: dict | None = None) -> list[tuple]:
    """Rules over stored spans: text, ids, indexes from one up in each parent, artifact and segmentation version. (That
    the same input gives the same spans again is the run's own rule.)"""
    blank = lambda c: F.count_if(F.col(c).isNull() | (strip(F.col(c)) == ""))
    n = stored.agg(blank("sentence_text").alias("t"), blank("artifact_id").alias("a"), blank("segmentation_version").alias("v")).first()
    twice = certify.duplicate_keys(stored, "sentence_span_id").first()[0]
    broken = spans.index_check(stored).where("not sequential").count()
    if quality is not None:
        quality.update(missing_required_field_count=n.t + n.a + n.v, invalid_enum_count=0, duplicate_key_count=twice)
    each = (("non_empty_text", "empty_sentence_count", n.t), ("duplicate_ids_absent", "duplicate_count", twice), ("sequential_indexes", "sequentiality_violations", broken), ("trace_to_artifact", "missing_artifact_count", n.a), ("segmentation_version_present", "missing_version_count", n.v))
    return [certify.count_rule(f"sentence_spans_{k}", name, x) for k, name, x in each]


def atomic_claims(run: Run, span_rows: DataFrame, transformer, per_row: bool = False, upstream_root: str | None = None) -> dict:
    """Results of the transformer that meet the contract; the others are failures with their violations. What was stored
    is held against the contract once more."""
    up = _gate(run, span_rows, upstream_root, "sentence_spans")
    results = atomic.transform(span_rows, transformer, per_row)
    results.write.mode("overwrite").parquet(f"{run.dir}/results")  # a transformer may be dear or unstable: run it once
    checked = atomic.validate_results(run.spark.read.parquet(f"{run.dir}/results"), span_rows)
    rows = checked.where(F.size("violations") == 0).drop("violations")
    bad = checked.where(F.size("violations") > 0)
    failures = certify.failure_rows(bad, run.run_id, run.stage, F.col("sentence_span_id"), F.col("sentence_span_id"), F.when(F.col("status") == "error", "transform").otherwise("contract"), F.array_join("violations", ","))
    n = checked.agg(F.count_if(F.size("violations") == 0).alias("ok"), F.count_if(F.size("violations") > 0).alias("bad")).first()
    quality: dict = {}

    def rules(stored: DataFrame) -> list[tuple]:
        found = atomic.stored_violations(stored, span_rows).first().asDict()
        quality.update(missing_required_field_count=found["required_fields_present"], invalid_enum_count=found["enum_values_valid"], duplicate_key_count=found["duplicate_atomic_claim_ids_absent"])
        return [certify.count_rule(f"atomic_{k}", "count", x) for k, x in found.items()]

    return run.finish(rows, failures, _counts(span_rows.count(), n.ok, n.bad), _whole(rows), rules=rules, quality=quality, upstream=up, inputs=span_rows.select("sentence_span_id"), distributions={"atomic": atomic.distributions(rows).select(F.concat_ws(":", "measure", "value").alias("value"), "n")})


def certified_spans(spark: SparkSession, root: str, path: str | None = None) -> tuple[dict, DataFrame]:
    """(summary, spans) of the latest certified span run under ``root``; or of the run whose outputs ``path`` names,
    which must be certified, of that stage, and under ``root``."""
    if path is None:
        up = latest_certified(spark, root, "sentence_spans")
        if up is None:
            raise ValueError(f"no certified sentence_spans run under {root}")
        return up, spark.read.parquet(f"{up['run_dir']}/outputs")
    run_dir, name = path.rstrip("/").rsplit("/", 1)
    if name != "outputs":
        raise ValueError("the input must be the outputs of a certified sentence span run")
    if run_dir.rsplit("/", 1)[0] != root.rstrip("/") or ".." in path.split("/"):
        raise ValueError(f"the input must be under {root}")
    if not sinks.exists(spark, f"{run_dir}/_CERTIFIED"):
        raise ValueError(f"{run_dir} is not certified")
    up = load_summary(spark, run_dir)
    if up["stage_name"] != "sentence_spans" or up["status"] != "certified":
        raise ValueError(f"{run_dir} is a {up['status']} run of {up['stage_name']}")
    return up, spark.read.parquet(path)


def _gate(run: Run, rows: DataFrame, root: str | None, stage: str) -> dict | None:
    if root is None:
        return None
    up = latest_certified(run.spark, root, stage)
    d = certify.set_digest(rows, _whole(rows)).first()
    certify.assert_upstream(up, d.record_count, d.digest)
    return up


def initialise(spark: SparkSession, names: tuple[str, ...]) -> dict[str, DataFrame]:
    """Empty tables of the named schemas."""
    return {n: empty(spark, n) for n in names}
