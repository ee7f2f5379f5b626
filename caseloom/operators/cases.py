"""Joins and summaries over the current-state tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.identity import promoted_path
from caseloom.functions.text import blank_to_null, clean_optional, file_extension, ordinal_name


def handoff(downloads: DataFrame, items: DataFrame, search: DataFrame, only_selected: bool = False) -> DataFrame:
    """Hand-off manifest rows in order of (case, ordinal, item). The case comes from the download; projects come from
    search results only and are null without one. ``only_selected`` adds the active and selected filter, which the
    plain manifest does not have."""
    i = items.where("is_active and selection_selected") if only_selected else items
    i = i.select("docket_item_id", "ordinal", "title", "view_url")
    s = search.select("ntsb_number", "project_id")
    j = downloads.join(i, "docket_item_id").join(s, "ntsb_number", "left")
    rows = j.select("project_id", "ntsb_number", "docket_item_id", F.col("last_run_id").alias("acquisition_run_id"), "ordinal", "title", "view_url", "source_url", "blob_sha256", "blob_path", "media_type")
    return rows.orderBy("ntsb_number", "ordinal", "docket_item_id")


def selected_downloads(items: DataFrame, downloads: DataFrame) -> DataFrame:
    """Active, selected items with their downloads (promotion and case views)."""
    i = items.where("is_active and selection_selected")
    return i.join(downloads.select("docket_item_id", "source_url", "blob_sha256", "blob_path", "media_type", "size_bytes"), "docket_item_id").orderBy("ntsb_number", "ordinal")


def project_ids(cases: DataFrame, investigations: DataFrame, search: DataFrame) -> DataFrame:
    """Project of each case: from investigations, else from search results; blank counts as missing. Null in both gives
    a null with ``missing``."""
    a = investigations.select("ntsb_number", F.col("project_id").alias("__a"))
    b = search.select("ntsb_number", F.col("project_id").alias("__b"))
    p = F.coalesce(clean_optional(F.col("__a")), clean_optional(F.col("__b")))
    return cases.join(a, "ntsb_number", "left").join(b, "ntsb_number", "left").select("ntsb_number", p.alias("project_id"), p.isNull().alias("missing"))


def download_plan(items: DataFrame, downloads: DataFrame, stored_blobs: DataFrame) -> DataFrame:
    """Selected items with ``reuse``: a download with an equal fingerprint (null equal to null) whose blob is stored."""
    d = downloads.select("docket_item_id", F.col("source_fingerprint").alias("__f"), F.col("blob_path").alias("__p"))
    s = stored_blobs.select(F.col("blob_path").alias("__p")).distinct().withColumn("__stored", F.lit(True))
    j = items.where("is_active and selection_selected").join(d, "docket_item_id", "left").join(s, "__p", "left")
    had = F.col("__p").isNotNull()
    return j.withColumn("reuse", had & F.col("source_fingerprint").eqNullSafe(F.col("__f")) & F.col("__stored").isNotNull()).drop("__f", "__p", "__stored")


def promotion_plan(selected: DataFrame, stored: DataFrame, portable: bool = False) -> DataFrame:
    """Where each selected download goes, and what is to be done: copy, reuse (same content is there) or conflict
    (other content is there). A conflict is a row, not an abort. ``stored``: promoted_path, sha256. ``portable`` writes
    the colons of ids as "_" in names, as Hadoop's file systems refuse them."""
    path = promoted_path(F.col("ntsb_number"), F.col("docket_item_id"), F.col("blob_sha256"))
    planned = selected.withColumn("promoted_path", F.translate(path, ":", "_") if portable else path)
    there = stored.select("promoted_path", F.col("sha256").alias("__there"))
    action = F.when(F.col("__there").isNull(), "copy").when(F.col("__there") == F.col("blob_sha256"), "reuse").otherwise("conflict")
    return planned.join(there, "promoted_path", "left").withColumn("action", action).drop("__there")


def case_view(selected: DataFrame) -> DataFrame:
    """File name of every selected document in its case's view."""
    ext = file_extension(F.col("source_url"), F.col("media_type"), F.col("blob_path"))
    return selected.select("ntsb_number", "docket_item_id", "blob_path", ordinal_name(F.col("ordinal"), F.col("normalized_title_slug"), ext).alias("file_name"))


def case_ids(*sources: DataFrame) -> DataFrame:
    """Distinct case numbers of several tables; distinct first, so the union carries one row per case and source."""
    out = sources[0].select("ntsb_number").distinct()
    for s in sources[1:]:
        out = out.unionByName(s.select("ntsb_number").distinct())
    return out.distinct()


def case_summary(cases: DataFrame, items: DataFrame, downloads: DataFrame) -> DataFrame:
    """Per case the number of docket items and downloads, 0 where there is none."""
    n = lambda d, name: d.groupBy("ntsb_number").agg(F.count("*").alias(name))
    j = cases.join(n(items, "docket_items_count"), "ntsb_number", "left").join(n(downloads, "downloads_count"), "ntsb_number", "left")
    return j.select("ntsb_number", *[F.coalesce(c, F.lit(0)).alias(c) for c in ("docket_items_count", "downloads_count")])


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its count, from one plan."""
    rows = [d.agg(F.count("*").alias("n")).select(F.lit(k).alias("table_name"), "n") for k, d in tables.items()]
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out


def text_path(stage: Column, stored: Column, doc_id: Column) -> Column:
    """Path of a document's text: the stored one, else by stage."""
    folder = F.when(stage == "ocr", "ocr").otherwise("extracted")
    return F.coalesce(blank_to_null(stored), F.concat(folder, F.lit("/"), F.regexp_replace(doc_id, ":", "_"), F.lit(".txt")))
