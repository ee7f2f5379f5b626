"""Acquisition: index sync, docket search, docket pages, downloads, promotion and case views, over the tables of a root.

Pages and files come through one rate-limited client on the driver, as the source's limit of about a request a second
is for all of us together; what it fetches is written to the root at once and never gathered in memory. Everything after
that is DataFrames over what was written. Each step returns its counters.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions import identity as I
from caseloom.functions.text import normalize_case_number
from caseloom.operators import cases, classify, registry, state
from caseloom.plans.runs import Run
from caseloom.schemas import SCHEMAS
from caseloom.sources import files, html, http, sinks

#: Parser versions and actions of the event logs.
PARSERS = {"investigation_sync": "carol_v1", "docket_search_discovery": "docket_search_v1", "docket_enumeration": "docket_v1", "downloads": "download_v1"}
EVENT = ("run_id", "source", "ntsb_number", "action", "input_fingerprint", "output_path", "content_hash", "parser_version", "retrieved_at", "changed", "note")


class Store:
    """The tables, logs and files under one root, as a run sees them."""

    def __init__(self, spark: SparkSession, data: str, run: Run):
        self.spark, self.data, self.run = spark, data, run
        self.version = run.run_id.replace(":", "")
        self.step = 0

    def table(self, name: str) -> DataFrame:
        return sinks.read_snapshot(self.spark, f"{self.data}/tables", name, SCHEMAS[name])

    def put(self, df: DataFrame, name: str) -> DataFrame:
        self.step += 1
        return sinks.swap_snapshot(self.spark, df.select(*[c.split()[0] for c in SCHEMAS[name].split(", ")]), f"{self.data}/tables", name, f"{self.version}-{self.step}")

    def keep(self, df: DataFrame, label: str) -> DataFrame:
        """Write ``df`` under the run's folder and read it: observations are evaluated once."""
        self.step += 1
        path = f"{self.run.dir}/{label}-{self.step}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def log(self, rows: DataFrame, name: str) -> None:
        known = {"run_id": F.lit(self.run.run_id), "parser_version": F.lit(PARSERS[name]), "retrieved_at": F.lit(self.run.seen_at)}
        full = rows.select(*[F.col(c) if c in rows.columns else known.get(c, F.lit(None).cast("string")).alias(c) for c in EVENT])
        sinks.append_events(full, f"{self.data}/manifests/{name}", list(EVENT), sinks.ACQUISITION_RENAME)


def by_fingerprint(current: DataFrame, observed: DataFrame, key: str) -> DataFrame:
    """``observed`` with ``changed``: a key that is not stored, or whose stored fingerprint differs (null equal to null).
    Other columns do not count: this is the flag of the event logs, not that of the merge."""
    had = current.select(key, F.col("source_fingerprint").alias("__had"), F.lit(True).alias("__known"))
    j = observed.join(had, key, "left")
    return j.withColumn("changed", F.col("__known").isNull() | ~F.col("source_fingerprint").eqNullSafe(F.col("__had"))).drop("__had", "__known")


def _counts(flagged: DataFrame, first: str) -> dict:
    r = flagged.agg(F.count("*").alias("n"), F.count_if("changed").alias("c")).first()
    return {first: r.n, "changed": r.c, "unchanged": r.n - r.c}


def _observe(store: Store, observed: DataFrame, name: str, log: str, source: str, action: str, first: str) -> dict:
    """Merge one observation per key into a current-state table, log each, and count by fingerprint."""
    key, material = state.MATERIAL[name]
    one = store.keep(by_fingerprint(store.table(name), state.latest(observed.select(key, *material), [key], ["source_fingerprint"]), key), name)
    merged = state.merge(store.table(name), one, key, material, store.run.seen_at, store.run.run_id)
    store.put(merged, name)
    store.log(one.select("ntsb_number", F.lit(source).alias("source"), F.lit(action).alias("action"), F.col("source_fingerprint").alias("input_fingerprint"), "changed"), log)
    return _counts(one, first)


def sync(store: Store, payloads: DataFrame) -> dict:
    """Investigations of index payloads (body). Rows without a case number are counted, not merged."""
    rows = store.keep(files.index_records(payloads), "index")
    good = rows.where("not rejected").withColumn("location", F.from_json("location_json", "map<string,string>"))
    good = good.withColumn("source_fingerprint", I.record_fingerprint(I.INVESTIGATION_FIELDS))
    return _observe(store, good, "investigations_current", "investigation_sync", "carol", "sync_investigation", "discovered") | {"rejected": rows.where("rejected").count()}


def fetch_index(store: Store, client: http.HttpClient, url: str, limit: int | None = None) -> DataFrame:
    """The index payload, kept as fetched; ``limit`` is the server's to apply."""
    path = f"{store.run.dir}/index_payload.json"
    sinks.write_atomic(store.spark, path, http.fetch_index(client, url, limit))
    return store.spark.read.text(path, wholetext=True).withColumnRenamed("value", "body")


def discover(store: Store, client: http.HttpClient, url: str) -> dict:
    """Result rows of the public docket search."""
    path = f"{store.data}/raw_html/search/{store.version}.html"
    sinks.write_atomic(store.spark, path, http.fetch_search(client, url))
    page = store.spark.read.text(path, wholetext=True).select(F.lit(url).alias("public_url"), F.col("value").alias("html"))
    rows = html.search_results(page).withColumn("ntsb_number", normalize_case_number(F.col("ntsb_number")))
    rows = rows.withColumn("source_fingerprint", I.record_fingerprint(I.SEARCH_FIELDS))
    return _observe(store, rows, "docket_search_results_current", "docket_search_discovery", "public_docket_search", "discover_docket", "discovered") | {"raw_html_path": path}


def known_cases(store: Store, number: str | None = None) -> DataFrame:
    """Cases of the index and the search; or one of them."""
    if number is not None:
        return store.spark.createDataFrame([(number,)], "ntsb_number string").select(normalize_case_number(F.col("ntsb_number")).alias("ntsb_number"))
    return cases.case_ids(store.table("investigations_current"), store.table("docket_search_results_current"))


def enumerate_dockets(store: Store, client: http.HttpClient, base: str, wanted: DataFrame, progress: Callable[[str], None] = lambda _: None) -> dict:
    """Read every wanted case's docket page and bring dockets and items up to date. A docket with unstable ordinals
    keeps its stored items; ids that move take their downloads and promotions along. A case without a project is an
    error before anything is fetched."""
    spark, seen = store.spark, store.run.seen_at
    known = store.keep(cases.project_ids(wanted, store.table("investigations_current"), store.table("docket_search_results_current")), "cases")
    lost = known.where("missing").select("ntsb_number").first()
    if lost:
        raise ValueError(f"no project id is known for {lost[0]}")
    folder, n = f"{store.data}/raw_html/dockets/{store.version}", 0
    for r in known.orderBy("ntsb_number").toLocalIterator():
        sinks.write_atomic(spark, f"{folder}/{r.ntsb_number}.html", http.fetch_docket(client, base, r.project_id))
        n += 1
        progress(f"{n} processed")
    if not n:
        return {"enumerated": 0, "changed": 0, "total_items": 0}
    texts = spark.read.text(f"{folder}/*.html", wholetext=True).select(F.col("value").alias("html"), F.col("_metadata.file_path").alias("raw_html_path"))
    pages = texts.withColumn("ntsb_number", F.regexp_extract("raw_html_path", r"([^/]+)\.html$", 1)).join(known.select("ntsb_number", "project_id"), "ntsb_number")
    pages = pages.withColumn("public_url", F.concat(F.lit(f"{base}?ProjectID="), F.col("project_id")))
    parsed = html.docket_items(pages)
    placed = state.ordinal_stability(parsed).withColumn("ordinal", F.col("effective_ordinal"))
    placed = placed.withColumn("docket_item_id", I.docket_item_id(F.col("ntsb_number"), F.col("ordinal"), F.col("normalized_title_slug")))
    items = store.keep(placed.withColumn("source_fingerprint", I.record_fingerprint(I.ITEM_FIELDS)), "items")
    found = store.keep(html.dockets(pages, items), "dockets")
    unstable = items.where("not ordinal_stable").select("ntsb_number").distinct()
    settled = found.where("has_table").select("ntsb_number").join(unstable, "ntsb_number", "left_anti")

    marks = items.groupBy("ntsb_number").agg(F.transform(F.array_sort(F.collect_list(F.struct("ordinal", "source_fingerprint"))), lambda x: x["source_fingerprint"]).alias("ordered_item_fingerprints"))
    whole = found.join(marks, "ntsb_number", "left").join(pages.select("ntsb_number", "project_id", "raw_html_path"), "ntsb_number")
    whole = whole.withColumns({"docket_id": I.docket_id(F.col("ntsb_number")), "mode": F.lit(None).cast("string"), "retrieved_at": F.lit(seen), "ordered_item_fingerprints": F.coalesce("ordered_item_fingerprints", F.array().cast("array<string>"))})
    whole = whole.withColumn("source_fingerprint", I.record_fingerprint(I.DOCKET_FIELDS))
    counts = _observe(store, whole, "dockets_current", "docket_enumeration", "docket", "enumerate_docket", "enumerated")

    merged = store.keep(state.replace_items(store.table("docket_items_current"), state.stable_only(items), seen, store.run.run_id, enumerated=settled), "merged-items")
    for child in ("downloads_current", "promotions_current"):
        store.put(state.cascade_ids(store.table(child), merged), child)
    store.put(merged, "docket_items_current")
    return {"enumerated": counts["enumerated"], "changed": counts["changed"], "total_items": items.count()}


def download(store: Store, client: http.HttpClient, wanted: DataFrame | None = None, progress: Callable[[str], None] = lambda _: None) -> dict:
    """Select active items and fetch what is selected and not stored under its fingerprint. Selected items without a
    link are left out. A reply other than 2xx is an error, and what was fetched before it stays stored as blobs."""
    spark, run = store.spark, store.run
    items = store.table("docket_items_current")
    mine = items if wanted is None else items.join(wanted, "ntsb_number", "left_semi")
    chosen = store.keep(classify.select_items(mine).drop("selection"), "selection")
    n = chosen.agg(F.count("*").alias("n"), F.count_if("selection_selected").alias("s")).first()
    now = store.put(state.apply_selection(items, chosen, run.seen_at, run.run_id), "docket_items_current")
    decided = chosen.select(F.lit(run.run_id).alias("run_id"), "ntsb_number", "docket_item_id", F.col("selection_selected").alias("selected"), F.col("selection_rule_version").alias("rule_version"), F.col("selection_matched_rules_json").alias("matched_rules"), F.col("selection_rationale").alias("rationale"), F.lit(run.seen_at).alias("recorded_at"))
    sinks.append_events(decided, f"{store.data}/manifests/selection_decisions", decided.columns)

    mine = now if wanted is None else now.join(wanted, "ntsb_number", "left_semi")
    stored = store.table("blobs_current").select("blob_path")
    plan = store.keep(cases.download_plan(mine.where("coalesce(download_url, '') <> ''"), store.table("downloads_current"), stored), "plan")
    got, reused = [], plan.where("reuse").count()
    for r in plan.where("not reuse").orderBy("ntsb_number", "ordinal").toLocalIterator():
        reply = client.request("GET", r.download_url)
        if not 200 <= reply.status < 300:
            raise http.HttpError(reply.status, r.download_url)
        digest = hashlib.sha256(reply.body).hexdigest()
        path = f"{store.data}/blobs/sha256/{digest[:2]}/{digest[2:4]}/{digest}"
        sinks.write_bytes(spark, path, reply.body)
        kind = next((v for k, v in reply.headers.items() if k.lower() == "content-type"), None)
        got.append((r.docket_item_id, r.ntsb_number, r.download_url, r.source_fingerprint, digest, path, kind, len(reply.body), reply.status))  # a few short values a request
        progress(f"{len(got)} downloaded, {reused} reused, {n.n - n.s} rejected")
    rows = spark.createDataFrame(got, "docket_item_id string, ntsb_number string, source_url string, source_fingerprint string, blob_sha256 string, blob_path string, media_type string, size_bytes long, http_status int")
    key, material = state.MATERIAL["downloads_current"]
    if got:
        store.put(state.register_blobs(store.table("blobs_current"), rows, run.seen_at, run.run_id), "blobs_current")
        store.put(state.merge_events(store.table("downloads_current"), rows, key, material, "downloaded_at", run.seen_at, run.run_id), "downloads_current")
    had = plan.where("reuse").select("docket_item_id", "ntsb_number").join(store.table("downloads_current").select("docket_item_id", "source_fingerprint", "blob_path", "blob_sha256"), "docket_item_id")
    event = lambda d, changed: d.select("ntsb_number", F.lit("download").alias("source"), F.lit("download_selected_artifact").alias("action"), F.col("source_fingerprint").alias("input_fingerprint"), F.col("blob_path").alias("output_path"), F.col("blob_sha256").alias("content_hash"), F.lit(changed).alias("changed"), F.lit(None if changed else "reused_existing_download").cast("string").alias("note"))
    store.log(event(rows, True).unionByName(event(had, False)), "downloads")
    return {"evaluated": n.n, "selected": n.s, "rejected": n.n - n.s, "downloaded": len(got), "reused": reused}


def promote(store: Store, root: str, wanted: DataFrame | None = None) -> dict:
    """Copy selected downloads under ``root`` by case. Where a file is, its content decides: equal is reused, other
    content is a conflict, which is counted and leaves the file as it is."""
    spark, run = store.spark, store.run
    chosen = cases.selected_downloads(store.table("docket_items_current"), store.table("downloads_current"))
    chosen = chosen if wanted is None else chosen.join(wanted, "ntsb_number", "left_semi")
    there = spark.createDataFrame([], "promoted_path string, sha256 string")
    if sinks.exists(spark, root):
        there = files.raw_files(spark, root).select(F.regexp_extract("path", r"([^/]+/[^/]+)$", 1).alias("promoted_path"), "sha256")
    plan = store.keep(cases.promotion_plan(chosen, there, portable=True), "promotions")
    for r in plan.where("action = 'copy'").select("blob_path", "promoted_path").toLocalIterator():
        sinks.copy_file(spark, r.blob_path, f"{root}/{r.promoted_path}")
    done = plan.where("action <> 'conflict'")
    rows = done.select("docket_item_id", "ntsb_number", "blob_sha256", F.concat(F.lit(f"{root}/"), F.col("promoted_path")).alias("promoted_path"), F.coalesce("selection_rule_version", F.lit("selection_v1")).alias("rule_version"), F.coalesce("selection_matched_rules_json", F.lit("[]")).alias("matched_rules_json"), F.coalesce("selection_rationale", F.lit("")).alias("rationale"), F.col("blob_path").alias("source_blob_path"))
    key, material = state.MATERIAL["promotions_current"]
    store.put(state.merge_events(store.table("promotions_current"), rows, key, material, "promoted_at", run.seen_at, run.run_id), "promotions_current")
    told = rows.withColumns({"run_id": F.lit(run.run_id), "matched_rules": F.from_json("matched_rules_json", "array<string>"), "promoted_at": F.lit(run.seen_at), "downstream_registration_status": F.lit("not_attempted")}).drop("matched_rules_json")
    sinks.append_events(told, f"{store.data}/manifests/promotions", told.columns)
    n = {r.action: r.n for r in plan.groupBy("action").agg(F.count("*").alias("n")).collect()}
    return {"evaluated": sum(n.values()), "promoted": n.get("copy", 0), "reused": n.get("reuse", 0), "conflicts": n.get("conflict", 0)}


def materialize_case(store: Store, number: str, root: str) -> dict:
    """Files of one case under readable names. A file of the blob's size is reused; a blob that is missing is an error."""
    spark, wanted = store.spark, known_cases(store, number)
    chosen = cases.selected_downloads(store.table("docket_items_current"), store.table("downloads_current")).join(wanted, "ntsb_number", "left_semi")
    case, made, reused = wanted.first()[0], 0, 0
    for r in cases.case_view(chosen).toLocalIterator():
        size = sinks.size_of(spark, r.blob_path)
        if size is None:
            raise FileNotFoundError(f"{r.docket_item_id}: {r.blob_path}")
        path = f"{root}/{case}/{r.file_name}"
        if sinks.size_of(spark, path) == size:
            reused += 1
        else:
            sinks.copy_file(spark, r.blob_path, path)
            made += 1
    return {"ntsb_number": case, "output_dir": f"{root}/{case}", "materialized": made, "reused": reused}


def register(store: Store, raw_root: str, manifest: str | None = None, prefixes: tuple[str, ...] = (), allowed: tuple[str, ...] = ("pdf",)) -> dict:
    """Documents of a hand-off manifest, or of a folder of raw files where there is none: one new document for each
    new content. Counters by outcome."""
    spark, run = store.spark, store.run
    documents = store.table("documents")
    if manifest is not None and sinks.exists(spark, manifest):
        records, rejected = files.read_handoff(spark, manifest)
        listing = files.raw_files(spark, raw_root, allowed).drop("content")
        listing = listing.unionByName(spark.read.format("binaryFile").option("recursiveFileLookup", True).load(f"{store.data}/blobs").select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("file_size"))) if sinks.exists(spark, f"{store.data}/blobs") else listing
        listing = listing.withColumn("path", F.regexp_replace("path", "^file:/+", "/")).dropDuplicates(["path"])
        resolved = registry.resolve_blobs(records.withColumn("blob_path", F.regexp_replace("blob_path", "^file:/+", "/")), listing, prefixes).withColumn("source_manifest_path", F.lit(manifest))
        rows = store.keep(registry.registration_outcomes(resolved, documents, allowed), "registration")
        documents = registry.reconcile(documents, rows)
        new = rows.where("outcome = 'inserted'").withColumn("sha256", F.col("found_sha256"))
        counts = {"manifest_candidates": rows.count(), "rejected": rejected.count()}
    else:
        listing = files.raw_files(spark, raw_root, allowed)
        rows = store.keep(registry.scan_registration(listing, documents), "registration")
        new = rows.where("outcome = 'inserted'").withColumn("raw_path", F.col("path")).withColumn("doc_type", registry.document_kind(F.lit(None).cast("string"), F.col("path")))
        counts = {"raw_scan_candidates": rows.count()}
    fixed = {"status": F.lit("pending"), "stage": F.lit("registration"), "ingested_at": F.lit(run.seen_at)}
    columns = {name: kind for name, kind in (c.split(" ", 1) for c in SCHEMAS["documents"].split(", "))}
    made = new.select(*[(fixed[c] if c in fixed else F.col(c) if c in new.columns else F.lit(None)).cast(kind).alias(c) for c, kind in columns.items()])
    store.put(documents.select(*columns).unionByName(made), "documents")
    return counts | {r.outcome: r.n for r in registry.registration_stats(rows).collect()}


def extract(store: Store, extractor, threshold: int = 200, ocr_enabled: bool = False) -> dict:
    """Text of registered documents. They are claimed first, and only rows that still wait are; a file that cannot be
    read leaves its document failed, with the reason."""
    spark, run = store.spark, store.run
    claimed = store.put(registry.claim(store.table("documents")), "documents").where("status = 'processing' and stage = 'extraction'")
    named = claimed.select("doc_id", F.regexp_replace("raw_path", "^file:/+", "/").alias("path"))
    folders = [r[0] for r in named.select(F.regexp_extract("path", "^(.*)/[^/]+$", 1).alias("f")).distinct().toLocalIterator()]
    if not folders:
        return {"claimed": 0, "completed": 0, "failed": 0}
    content = spark.read.format("binaryFile").load(folders).select(F.regexp_replace("path", "^file:/+", "/").alias("path"), "content").join(named, "path")
    texts = store.keep(files.pdf_texts(content.select("path", "content"), extractor), "texts").join(named, "path", "right")
    after = registry.after_extraction(F.col("text"), threshold, ocr_enabled)
    rows = texts.withColumn("next", after).select("doc_id", "text", F.when(F.col("text").isNull(), "failed").otherwise(F.col("next.status")).alias("status"), F.when(F.col("text").isNull(), "extraction").otherwise(F.col("next.stage")).alias("stage"), F.when(F.col("text").isNull(), F.coalesce("error", F.lit("file not found"))).alias("error_message"))
    rows = store.keep(rows, "extracted")
    rows.where("text is not null").select("doc_id", "text").write.mode("append").parquet(f"{store.data}/extracted")
    store.put(registry.finalise(store.table("documents"), rows.drop("text"), run.seen_at), "documents")
    n = rows.agg(F.count("*").alias("n"), F.count_if(F.col("text").isNull()).alias("f")).first()
    return {"claimed": n.n, "completed": n.n - n.f, "failed": n.f}
