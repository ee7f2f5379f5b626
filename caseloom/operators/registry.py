"""Registration of source files as documents, and the work queue over the document table."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.identity import document_id

RECONCILED = ("source_url", "project_id", "ntsb_number", "docket_item_id", "acquisition_run_id", "blob_sha256", "blob_path", "media_type", "source_manifest_path", "raw_path", "doc_type", "jurisdiction", "file_size")


def document_kind(media_type: Column, path: Column) -> Column:
    """"pdf" by media type (parameters dropped), else the path's suffix, else "unknown"."""
    pdf = F.lower(F.btrim(F.substring_index(media_type, ";", 1))) == "application/pdf"
    suffix = F.lower(F.regexp_extract(path, r"\.([A-Za-z0-9]+)$", 1))
    return F.when(pdf, "pdf").when(suffix != "", suffix).otherwise("unknown")


def jurisdiction(relative_path: Column, has_lineage: Column) -> Column:
    """First folder under the root, else the lineage's source, else null."""
    parts = F.split(relative_path, "/")
    return F.when(F.size(parts) >= 2, F.get(parts, F.lit(0))).when(has_lineage, F.lit("ntsb"))


def ok_media(media_type: Column, item_id: Column) -> Column:
    """Exactly application/pdf (no parameters), and an id that is a bare file name."""
    return (F.lower(media_type) == "application/pdf") & ~item_id.rlike(r"[/\\]") & (item_id != "") & ~item_id.isin(".", "..")


def resolve_blobs(rows: DataFrame, listing: DataFrame, prefixes: tuple[str, ...]) -> DataFrame:
    """First existing candidate path of each row's blob, in order: the path as given, then under each prefix. One join:
    candidates are exploded with their rank and the least rank found is kept."""
    candidates = F.array_distinct(F.array(F.col("blob_path"), *[F.concat(F.lit(p.rstrip("/") + "/"), F.col("blob_path")) for p in prefixes]))
    each = rows.select("line_no", F.posexplode(candidates).alias("rank", "path"))
    hits = each.join(listing.select("path", F.col("sha256").alias("found_sha256"), F.col("file_size")), "path")
    best = hits.groupBy("line_no").agg(F.min(F.struct("rank", "path", "found_sha256", "file_size")).alias("b"))
    return rows.join(best, "line_no", "left").select(*rows.columns, F.col("b.path").alias("raw_path"), F.col("b.found_sha256").alias("found_sha256"), F.col("b.file_size").alias("file_size"))


def registration_outcomes(resolved: DataFrame, documents: DataFrame, allowed: tuple[str, ...] = ("pdf",)) -> DataFrame:
    """Outcome of every manifest row, in the fixed order of tests: unsupported type, duplicate blob (a later line of
    the manifest with the same blob), missing file, hash mismatch, known path (conflict, backfill or skip), known
    content (backfill or skip), insert. ``resolved``: hand-off columns with line_no, raw_path, found_sha256,
    file_size. The duplicate test ranks supported rows only. A blob's first line is a combined minimum, joined back by
    blob and line, so a blob shared by a third of all rows is no hot task."""
    typed = resolved.withColumn("doc_type", document_kind(F.col("media_type"), F.col("blob_path")))
    supported = F.col("doc_type").isin(*allowed)
    first = typed.where(supported).groupBy("blob_sha256").agg(F.min("line_no").alias("line_no")).withColumn("__first", F.lit(True))
    by_path = documents.select(F.col("raw_path").alias("__path"), F.col("sha256").alias("__path_sha"), F.struct(*RECONCILED).alias("__path_row"))
    by_sha = documents.select(F.col("sha256").alias("__sha"), F.struct(*RECONCILED).alias("__sha_row"))
    j = typed.join(first, ["blob_sha256", "line_no"], "left").join(by_path, F.col("raw_path") == F.col("__path"), "left").join(by_sha, F.col("found_sha256") == F.col("__sha"), "left")
    compared = [c for c in RECONCILED if c in typed.columns]
    differs = lambda row: reduce(lambda a, b: a | b, [~F.col(c).eqNullSafe(F.col(f"{row}.{c}")) for c in compared])
    outcome = (
        F.when(~supported, "unsupported")
        .when(F.col("blob_sha256").isNotNull() & F.col("__first").isNull(), "duplicate_blob")
        .when(F.col("raw_path").isNull(), "missing")
        .when(F.col("found_sha256") != F.col("blob_sha256"), "hash_mismatch")
        .when(F.col("__path").isNotNull() & (F.col("__path_sha") != F.col("found_sha256")), "path_conflict")
        .when(F.col("__path").isNotNull() & differs("__path_row"), "backfilled_by_path")
        .when(F.col("__path").isNotNull(), "skipped_by_path")
        .when(F.col("__sha").isNotNull() & differs("__sha_row"), "backfilled_by_sha")
        .when(F.col("__sha").isNotNull(), "skipped_by_sha")
        .otherwise("inserted")
    )
    return j.withColumn("outcome", outcome).withColumn("doc_id", document_id(F.col("found_sha256"))).drop("__first", "__path", "__path_sha", "__path_row", "__sha", "__sha_row")


def registration_stats(outcomes: DataFrame) -> DataFrame:
    return outcomes.groupBy("outcome").agg(F.count("*").alias("n"))


def scan_registration(files: DataFrame, documents: DataFrame) -> DataFrame:
    """Fallback over a file listing (path, sha256, file_size): outcome per file, in path order. Of files with equal
    content the first path is inserted and the others are skipped, as is content or a path already known."""
    first = files.groupBy("sha256").agg(F.min("path").alias("path")).withColumn("__first", F.lit(True))
    known = documents.select(F.col("raw_path").alias("path")).distinct().withColumn("__path", F.lit(True))
    content = documents.select("sha256").distinct().withColumn("__sha", F.lit(True))
    j = files.join(first, ["sha256", "path"], "left").join(known, "path", "left").join(content, "sha256", "left")
    outcome = F.when(F.col("__path"), "skipped_by_path").when(F.col("__sha").isNotNull() | F.col("__first").isNull(), "skipped_by_sha").otherwise("inserted")
    return j.withColumn("outcome", outcome).select("path", "sha256", "file_size", "outcome", document_id(F.col("sha256")).alias("doc_id"))


def reconcile(documents: DataFrame, outcomes: DataFrame) -> DataFrame:
    """The document table after backfills: lineage columns follow the manifest; id, hash, time, status and stage stay."""
    new = outcomes.where(F.col("outcome").startswith("backfilled"))
    cols = [c for c in RECONCILED if c in new.columns]
    n = new.groupBy(F.col("found_sha256").alias("sha256")).agg(F.min(F.struct("line_no", *cols)).alias("__n"))
    put = {c: F.when(F.col("__n").isNotNull(), F.col(f"__n.{c}")).otherwise(F.col(c)) for c in cols}
    return documents.join(n, "sha256", "left").withColumns(put).select(*documents.columns)


def pending(documents: DataFrame) -> DataFrame:
    """Registered documents that wait for extraction, oldest first."""
    return documents.where("status = 'pending' and stage = 'registration'").orderBy("ingested_at")


def claim(documents: DataFrame) -> DataFrame:
    """The document table with every waiting document marked as being extracted and its error cleared. Only rows that
    wait as they are read change; the table's one writer swaps snapshots, so no other run can claim them too."""
    waits = (F.col("status") == "pending") & (F.col("stage") == "registration")
    put = {"status": F.lit("processing"), "stage": F.lit("extraction"), "error_message": F.lit(None).cast("string")}
    return documents.withColumns({c: F.when(waits, v).otherwise(F.col(c)) for c, v in put.items()})


def completed(documents: DataFrame) -> DataFrame:
    """Documents with text, by last processing (else ingestion) time, nulls first."""
    return documents.where((F.col("status") == "completed") & F.col("stage").isin("extraction", "ocr")).orderBy(F.coalesce("last_processed_at", "ingested_at").asc_nulls_first(), F.col("ingested_at").asc_nulls_first())


def after_extraction(text: Column, threshold: int, ocr_enabled: bool) -> Column:
    """Next status and stage of an extracted document: short text waits for OCR where that is on."""
    short = (F.char_length(F.coalesce(text, F.lit(""))) < threshold) & F.lit(ocr_enabled)
    return F.when(short, F.struct(F.lit("pending").alias("status"), F.lit("ocr").alias("stage"))).otherwise(F.struct(F.lit("completed").alias("status"), F.lit("extraction").alias("stage")))


def finalise(documents: DataFrame, outcomes: DataFrame, processed_at: str) -> DataFrame:
    """Status, stage, error and output columns of the documents a stage handled; columns the table lacks are dropped."""
    puts = [c for c in outcomes.columns if c != "doc_id" and c in documents.columns]
    n = outcomes.select("doc_id", F.struct(*puts).alias("__n"))
    new = {c: F.when(F.col("__n").isNotNull(), F.col(f"__n.{c}")).otherwise(F.col(c)) for c in puts}
    if "last_processed_at" in documents.columns:
        new["last_processed_at"] = F.when(F.col("__n").isNotNull(), F.lit(processed_at)).otherwise(F.col("last_processed_at"))
    return documents.join(n, "doc_id", "left").withColumns(new).select(*documents.columns)


def first_rows(rows: DataFrame, key: str, order: str) -> DataFrame:
    """First row of each key by ``order``; a combined minimum, so a frequent key is no hot task."""
    return rows.groupBy(F.col(key).alias("__key")).agg(F.min_by(F.struct("*"), F.col(order)).alias("r")).select("r.*")


def todo(inputs: DataFrame, outputs: DataFrame, key: str, overwrite: bool = False) -> tuple[DataFrame, DataFrame]:
    """(to do, reused): inputs without and with an output; everything is to do when overwriting."""
    if overwrite:
        return inputs, inputs.limit(0)
    done = outputs.select(key).distinct()
    return inputs.join(done, key, "left_anti"), inputs.join(done, key, "left_semi")
