"""Current-state tables: set-based upserts with change detection.

A merge is one full outer join of the stored snapshot with a run's observations on the natural key, and its result is
a new snapshot: nothing is updated in place, so a rerun of the same run gives the same table. Both sides have one row
per key, so a join key is never hot; observations are reduced to the last per key by a map-combined maximum.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions.identity import SOURCE
from caseloom.functions.text import blank_to_null, slugify, strip

MATERIAL = {
    "investigations_current": ("ntsb_number", ("investigation_id", "project_id", "mode", "event_date", "title", "case_type", "location_json", "carol_metadata_json", "source_fingerprint")),
    "dockets_current": ("ntsb_number", ("docket_id", "project_id", "mode", "public_url", "item_count", "creation_date", "last_modified", "public_release_at", "raw_html_path", "retrieved_at", "source_fingerprint")),
    "docket_search_results_current": ("ntsb_number", ("project_id", "result_url", "event_date", "city", "state_or_region", "docket_details", "accident_description", "source_fingerprint")),
    "downloads_current": ("docket_item_id", ("ntsb_number", "source_url", "source_fingerprint", "blob_sha256", "blob_path", "media_type", "size_bytes", "http_status")),
    "promotions_current": ("docket_item_id", ("ntsb_number", "blob_sha256", "promoted_path", "rule_version", "matched_rules_json", "rationale")),
}
ITEM = ("docket_item_id", "normalized_title_slug", "title", "page_count", "photo_count", "display_type", "view_url", "download_url", "source_fingerprint")


def same(left: str, right: str, columns: tuple[str, ...]) -> Column:
    """All columns equal, null equal to null."""
    return reduce(lambda a, b: a & b, [F.col(f"{left}.{c}").eqNullSafe(F.col(f"{right}.{c}")) for c in columns])


def latest(observed: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """One row per key: the last by ``order`` (repeated observations collapse)."""
    rest = [c for c in observed.columns if c not in keys]
    best = observed.groupBy(*keys).agg(F.max(F.struct(*[c for c in order if c not in keys], *[c for c in rest if c not in order])).alias("__r"))
    return best.select(*[F.col(c) if c in keys else F.col(f"__r.{c}").alias(c) for c in observed.columns])


def merge(current: DataFrame, observed: DataFrame, key: str, material: tuple[str, ...], seen_at: str, run_id: str) -> DataFrame:
    """New snapshot with ``changed``: null for rows not observed, true for new rows and for any material difference.
    First-seen stays, last-seen moves on for every observed row."""
    o, n = current.alias("o"), observed.select(key, *material).alias("n")
    got, had = F.col(f"n.{key}").isNotNull(), F.col(f"o.{key}").isNotNull()
    take = [F.when(got, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in material]
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full").select(
        F.coalesce(f"n.{key}", f"o.{key}").alias(key),
        *take,
        F.coalesce("o.first_seen_at", F.lit(seen_at)).alias("first_seen_at"),
        F.when(got, F.lit(seen_at)).otherwise(F.col("o.last_seen_at")).alias("last_seen_at"),
        F.when(got, F.lit(run_id)).otherwise(F.col("o.last_run_id")).alias("last_run_id"),
        F.when(got, ~had | ~same("o", "n", material)).alias("changed"),
    )


def merge_events(current: DataFrame, observed: DataFrame, key: str, material: tuple[str, ...], time_column: str, seen_at: str, run_id: str) -> DataFrame:
    """Downloads and promotions: overwritten by every observation, the time too; ``changed`` by material columns."""
    o, n = current.alias("o"), observed.select(key, *material).alias("n")
    got, had = F.col(f"n.{key}").isNotNull(), F.col(f"o.{key}").isNotNull()
    return o.join(n, F.col(f"o.{key}") == F.col(f"n.{key}"), "full").select(F.coalesce(f"n.{key}", f"o.{key}").alias(key), *[F.when(got, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in material], F.when(got, F.lit(seen_at)).otherwise(F.col(f"o.{time_column}")).alias(time_column), F.when(got, F.lit(run_id)).otherwise(F.col("o.last_run_id")).alias("last_run_id"), F.when(got, ~had | ~same("o", "n", material)).alias("changed"))


def register_blobs(current: DataFrame, observed: DataFrame, seen_at: str, run_id: str) -> DataFrame:
    """Blobs by content hash: path, type and size follow the observation, first download and run stay."""
    o = current.alias("o")
    n = latest(observed.select("blob_sha256", "blob_path", "media_type", "size_bytes"), ["blob_sha256"], ["blob_path"]).alias("n")
    got = F.col("n.blob_sha256").isNotNull()
    keep = [F.when(got, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c) for c in ("blob_path", "media_type", "size_bytes")]
    return o.join(n, F.col("o.blob_sha256") == F.col("n.blob_sha256"), "full").select(F.coalesce("n.blob_sha256", "o.blob_sha256").alias("blob_sha256"), *keep, F.coalesce("o.first_downloaded_at", F.lit(seen_at)).alias("first_downloaded_at"), F.coalesce("o.first_run_id", F.lit(run_id)).alias("first_run_id"), F.when(got, F.lit(seen_at)).otherwise(F.col("o.last_verified_at")).alias("last_verified_at"))


def item_payloads(items: DataFrame) -> DataFrame:
    """Docket items in the form in which they are stored: number and title stripped, a blank slug made from the title,
    a blank id from case, ordinal and slug, active unless said otherwise. An item without a title is an error."""
    title = strip(F.coalesce("title", F.lit("")))
    checked = F.when(title == "", F.raise_error(F.lit("docket item title is required"))).otherwise(title)
    out = items.withColumns({"title": checked, "ntsb_number": strip(F.col("ntsb_number"))})
    out = out.withColumn("normalized_title_slug", F.coalesce(blank_to_null(strip(F.col("normalized_title_slug"))), slugify(F.col("title"))))
    built = F.concat_ws(":", F.lit(f"{SOURCE}:docket_item"), "ntsb_number", F.col("ordinal").cast("string"), "normalized_title_slug")
    return out.withColumns({"docket_item_id": F.coalesce(blank_to_null(F.col("docket_item_id")), built), "is_active": F.coalesce("is_active", F.lit(True))})


def replace_items(current: DataFrame, observed: DataFrame, seen_at: str, run_id: str, enumerated: DataFrame | None = None) -> DataFrame:
    """Items of the observed cases, matched by (case, ordinal): the new snapshot with ``outcome``.

    inserted, updated, reactivated or unchanged for observed items, deactivated for active items that are gone, kept
    for items of other cases and items already inactive; ``replaced`` is true where the ordinal's item id changed, and
    ``old_item_id`` then has the former id for the cascade. Selection columns become null on every observed item, as
    selection is evaluated anew. Two observations of one (case, ordinal) are an error. ``enumerated`` (ntsb_number) names
    the cases whose list was read, for lists that may be empty; by default the cases observed.
    """
    at = ["ntsb_number", "ordinal"]
    twice = F.count("*").over(Window.partitionBy(*at)) > 1
    checked = observed.select(*at, *ITEM).withColumn("__ok", F.when(twice, F.raise_error(F.concat(F.lit("duplicate ordinal in case "), F.col("ntsb_number")))))
    cases = (observed if enumerated is None else enumerated).select("ntsb_number").distinct().withColumn("case_seen", F.lit(True))
    o, n = current.join(cases, "ntsb_number", "left").alias("o"), checked.alias("n")
    got, had = F.col("n.ordinal").isNotNull(), F.col("o.ordinal").isNotNull()
    material = tuple(c for c in ITEM if c != "docket_item_id")
    renamed = had & got & ~F.col("o.docket_item_id").eqNullSafe(F.col("n.docket_item_id"))
    outcome = (
        F.when(got & ~had, "inserted")
        .when(got & ~F.col("o.is_active"), "reactivated")
        .when(got & (renamed | ~same("o", "n", material)), "updated")
        .when(got, "unchanged")
        .when(F.col("o.is_active") & F.col("o.case_seen"), "deactivated")
        .otherwise("kept")
    )
    gone = had & ~got & F.coalesce(F.col("o.case_seen"), F.lit(False))
    pick = lambda c: F.when(got, F.col(f"n.{c}")).otherwise(F.col(f"o.{c}")).alias(c)
    unselected = [F.when(~got, F.col(f"o.{c}")).alias(c) for c in ("selection_selected", "selection_rule_version", "selection_matched_rules_json", "selection_rationale")]
    return o.join(n, (F.col("o.ntsb_number") == F.col("n.ntsb_number")) & (F.col("o.ordinal") == F.col("n.ordinal")), "full").select(
        pick("docket_item_id"),
        F.coalesce("n.ntsb_number", "o.ntsb_number").alias("ntsb_number"),
        F.coalesce("n.ordinal", "o.ordinal").alias("ordinal"),
        *[pick(c) for c in material],
        *unselected,
        F.when(got, F.lit(True)).when(gone, F.lit(False)).otherwise(F.col("o.is_active")).alias("is_active"),
        F.coalesce("o.first_seen_at", F.lit(seen_at)).alias("first_seen_at"),
        F.when(got, F.lit(seen_at)).otherwise(F.col("o.last_seen_at")).alias("last_seen_at"),
        F.when(got | gone, F.lit(run_id)).otherwise(F.col("o.last_run_id")).alias("last_run_id"),
        F.coalesce("n.__ok", outcome).alias("outcome"),
        renamed.alias("replaced"),
        F.when(renamed, F.col("o.docket_item_id")).alias("old_item_id"),
    )


def replace_counts(merged: DataFrame) -> DataFrame:
    """Counts per outcome, items replaced and items active after the merge."""
    each = [F.count_if(F.col("outcome") == k).alias(k) for k in ("inserted", "updated", "reactivated", "deactivated", "unchanged")]
    return merged.agg(*each, F.count_if("replaced").alias("replaced"), F.count_if("is_active").alias("active_count"))


def cascade_ids(children: DataFrame, merged_items: DataFrame) -> DataFrame:
    """Downloads or promotions after item ids changed: each follows its item's new id."""
    moved = merged_items.where("old_item_id is not null").select(F.col("old_item_id").alias("__old"), F.col("docket_item_id").alias("__new"))
    joined = children.join(moved, children.docket_item_id == moved["__old"], "left")
    return joined.withColumn("docket_item_id", F.coalesce("__new", "docket_item_id")).drop("__old", "__new")


def deactivate_missing(current: DataFrame, listed: DataFrame, run_id: str) -> DataFrame:
    """Items of the listed cases whose id is not listed become inactive and take the run id, also where they were
    inactive already; last-seen stays. Others are untouched."""
    cases = listed.select("ntsb_number").distinct().withColumn("__case", F.lit(True))
    ids = listed.select("docket_item_id").distinct().withColumn("__listed", F.lit(True))
    j = current.join(cases, "ntsb_number", "left").join(ids, "docket_item_id", "left")
    gone = F.col("__case").isNotNull() & F.col("__listed").isNull()
    return j.withColumns({"is_active": F.when(gone, False).otherwise(F.col("is_active")), "last_run_id": F.when(gone, F.lit(run_id)).otherwise(F.col("last_run_id"))}).select(*current.columns)


def ordinal_stability(candidates: DataFrame, order: str = "row_index") -> DataFrame:
    """Per candidate: whether its docket's ordinals are all present, positive and distinct, the issue of its own row,
    and the ordinal in effect (document order where they are not). ``candidates``: ntsb_number, ordinal, row_index."""
    docket = Window.partitionBy("ntsb_number")
    earlier = F.row_number().over(Window.partitionBy("ntsb_number", "ordinal").orderBy(order))
    issue = F.when(F.col("ordinal").isNull(), "missing").when(F.col("ordinal") <= 0, "non_positive").when(earlier > 1, "duplicate")
    marked = candidates.withColumn("issue", issue)
    stable = F.max(F.col("issue").isNotNull()).over(docket) == F.lit(False)
    return marked.withColumns({"ordinal_stable": stable, "effective_ordinal": F.when(stable, F.col("ordinal")).otherwise(F.row_number().over(docket.orderBy(order)))})


def stable_only(items: DataFrame) -> DataFrame:
    """Items that may be merged: dockets with unstable ordinals are left as they are stored."""
    return items.where("ordinal_stable")


def apply_selection(current: DataFrame, selected: DataFrame, seen_at: str, run_id: str) -> DataFrame:
    """Selection columns of the evaluated items, with last-seen and run."""
    cols = ("selection_selected", "selection_rule_version", "selection_matched_rules_json", "selection_rationale")
    n = selected.select("docket_item_id", *[F.col(c).alias(f"__{c}") for c in cols]).withColumn("__hit", F.lit(True))
    hit = F.col("__hit").isNotNull()
    new = {c: F.when(hit, F.col(f"__{c}")).otherwise(F.col(c)) for c in cols} | {"last_seen_at": F.when(hit, F.lit(seen_at)).otherwise(F.col("last_seen_at")), "last_run_id": F.when(hit, F.lit(run_id)).otherwise(F.col("last_run_id"))}
    return current.join(n, "docket_item_id", "left").withColumns(new).select(*current.columns)
