"""Sinks. Tables are written by Spark's committer; the few small files a run publishes (reports, sentinels, aliases) are
written by the driver through the cluster's file system API, so any store that Spark reaches will do."""

from __future__ import annotations

import html
import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.identity import ascii_json, canonical_json


def _path(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p, p.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    p, fs = _path(spark, path)
    return fs.exists(p)


def read_small(spark: SparkSession, path: str) -> str:
    return spark.read.text(path, wholetext=True).first()[0]


def write_atomic(spark: SparkSession, path: str, text: str) -> None:
    """Small text file: written beside its place, then renamed onto it."""
    p, fs = _path(spark, path)
    part, _ = _path(spark, path + ".part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode("utf-8")))
    out.close()
    fs.delete(p, False)
    if not fs.rename(part, p):
        raise OSError(f"cannot publish {path}")


def write_bytes(spark: SparkSession, path: str, content: bytes) -> bool:
    """Content-addressed file: written beside its place and renamed, unless it is there. True where it was written."""
    p, fs = _path(spark, path)
    if fs.exists(p):
        return False
    part, _ = _path(spark, path + ".part")
    out = fs.create(part, True)
    for at in range(0, len(content), 1 << 20):
        out.write(bytearray(content[at : at + (1 << 20)]))
    out.close()
    if not fs.rename(part, p):
        raise OSError(f"cannot publish {path}")
    return True


def copy_file(spark: SparkSession, source: str, target: str) -> None:
    """Copy beside the target, then rename onto it; the content passes through the driver's JVM in blocks."""
    (a, fs_a), (part, fs_b), (b, _) = _path(spark, source), _path(spark, target + ".part"), _path(spark, target)
    spark._jvm.org.apache.hadoop.fs.FileUtil.copy(fs_a, a, fs_b, part, False, True, spark._jsc.hadoopConfiguration())
    fs_b.delete(b, False)
    if not fs_b.rename(part, b):
        raise OSError(f"cannot publish {target}")


def size_of(spark: SparkSession, path: str) -> int | None:
    """Bytes of a file; None where there is none."""
    p, fs = _path(spark, path)
    return fs.getFileStatus(p).getLen() if fs.exists(p) else None


def spaced_json(fields: dict[str, Column]) -> Column:
    """JSON object with sorted keys and a space after each comma and colon, nulls kept. Values are scalars or arrays of
    texts. Digests of run files depend on these spaces."""

    def one(c: Column) -> Column:
        text = F.to_json(F.array(c), {"ignoreNullFields": "false"})
        return F.substring(text, F.lit(2), F.length(text) - 2)

    parts = [F.concat(F.lit(f"{json.dumps(k)}: "), one(fields[k])) for k in sorted(fields)]
    return ascii_json(F.concat(F.lit("{"), F.array_join(F.array(*parts), ", "), F.lit("}")))


def write_if_absent(spark: SparkSession, path: str, text: str, overwrite: bool = False) -> bool:
    if not overwrite and exists(spark, path):
        return False
    write_atomic(spark, path, text)
    return True


def append_events(rows: DataFrame, folder: str, fields: list[str], rename: dict[str, str] | None = None) -> None:
    """Append canonical JSON lines (sorted keys, compact, ASCII, nulls kept) to a log folder."""
    names = rename or {}
    rows.select(canonical_json({names.get(f, f): F.col(f) for f in fields}).alias("value")).write.mode("append").text(folder)


#: Event logs, and the one field that a log calls otherwise.
EVENT_LOGS = ("investigation_sync", "docket_search_discovery", "docket_enumeration", "selection_decisions", "downloads", "promotions")
ACQUISITION_RENAME = {"retrieved_at": "recorded_at"}
HANDOFF_FIELDS = ("project_id", "ntsb_number", "docket_item_id", "acquisition_run_id", "ordinal", "title", "view_url", "source_url", "blob_sha256", "blob_path", "media_type")


def handoff_lines() -> Column:
    """JSON line with the keys in their fixed order."""
    return F.to_json(F.struct(*HANDOFF_FIELDS), {"ignoreNullFields": "false"})


def export_handoff(rows: DataFrame, folder: str, run_id: str) -> str:
    """Write ``rows`` as an immutable snapshot of the run, then point ``latest`` to it. Parts keep the rows' order, so
    the snapshot may have any number of them; the alias is a small file that names the snapshot, as a copy of a large
    manifest would double it."""
    path = f"{folder}/manifest_{run_id}"
    rows.select(handoff_lines().alias("value")).write.mode("errorifexists").text(path)
    write_atomic(rows.sparkSession, f"{folder}/manifest_latest.json", json.dumps({"snapshot": f"manifest_{run_id}"}))
    return path


def read_latest(spark: SparkSession, folder: str) -> str:
    return f"{folder}/{json.loads(read_small(spark, f'{folder}/manifest_latest.json'))['snapshot']}"


def new_blobs(downloads: DataFrame, stored: DataFrame) -> DataFrame:
    """Content to write: one row per hash that is not stored. ``downloads``: blob_sha256, blob_path, content."""
    # Hashes and paths are settled first, so that contents move once at most, and only those that are new. Rows alike in
    # both have the same content; one of them is taken.
    first = downloads.groupBy("blob_sha256").agg(F.min("blob_path").alias("blob_path")).join(stored.select("blob_sha256").distinct(), "blob_sha256", "left_anti")
    return downloads.join(first, ["blob_sha256", "blob_path"], "left_semi").dropDuplicates(["blob_sha256"]).select("blob_sha256", "blob_path", "content")


def write_blobs(blobs: DataFrame, table: str) -> None:
    """Append content-addressed blobs to the blob table, partitioned by the first two digits of their hash. A rerun of
    :func:`new_blobs` against the table finds nothing to write."""
    blobs.withColumn("prefix", F.substring("blob_sha256", 1, 2)).write.mode("append").partitionBy("prefix").parquet(table)


def swap_snapshot(spark: SparkSession, df: DataFrame, folder: str, name: str, run_id: str) -> DataFrame:
    """Write a table's next snapshot and move its pointer. The snapshot being read is never overwritten."""
    path = f"{folder}/{name}/{run_id}"
    df.write.mode("errorifexists").parquet(path)
    write_atomic(spark, f"{folder}/{name}/CURRENT", path)
    return spark.read.parquet(path)


def read_snapshot(spark: SparkSession, folder: str, name: str, schema: str) -> DataFrame:
    """The table's current snapshot, or an empty table."""
    if not exists(spark, f"{folder}/{name}/CURRENT"):
        return spark.createDataFrame([], schema)
    return spark.read.parquet(read_small(spark, f"{folder}/{name}/CURRENT").strip())


def sentinel(spark: SparkSession, run_dir: str, certified: bool, text: str) -> None:
    """Exactly one of _CERTIFIED and _FAILED, after everything else of the run."""
    yes, no = ("_CERTIFIED", "_FAILED") if certified else ("_FAILED", "_CERTIFIED")
    p, fs = _path(spark, f"{run_dir}/{no}")
    fs.delete(p, False)
    write_atomic(spark, f"{run_dir}/{yes}", text)


#: Labels that are not the field's words in title case, and fields that hold a file.
LABELS = {"run_id": "Run ID", "ntsb_number": "NTSB Number", "output_dir": "Output Directory", "output_path": "Output Path", "report_path": "HTML Report"}
FILE_FIELDS = ("output_dir", "output_path", "report_path")


def label(field: str) -> str:
    return LABELS.get(field, field.replace("_", " ").title())


def shown(value) -> str:
    """A value as reports show it: "-" for none, JSON for truth values and structures."""
    if value is None:
        return "-"
    if isinstance(value, (str, int, float)) and not isinstance(value, bool):
        return str(value)
    return json.dumps(value, sort_keys=True, ensure_ascii=True)


def elapsed(seconds: float) -> str:
    """HH:MM:SS of whole seconds, not below zero."""
    whole = max(0, int(seconds))
    return f"{whole // 3600:02d}:{whole // 60 % 60:02d}:{whole % 60:02d}"


def heartbeat(phase: str, seconds: float, detail: str) -> str:
    return f"Collect | Phase: {phase} | Elapsed: {elapsed(seconds)} | {detail}"


def console_event(level: str, event: str, **fields) -> str:
    """One line of the log: compact JSON with sorted keys, ASCII."""
    return json.dumps({"event": event, "level": level.lower(), **fields}, sort_keys=True, separators=(",", ":"), ensure_ascii=True)


#: Sentences of a run's report, by command: the counters they need, and (test on them, sentence) in order.
#: A group of alternatives gives its first that holds.
_NARRATIVES = {
    "sync-investigations": (
        ("discovered", "changed", "unchanged"),
        [(lambda n: True, "This run processed CAROL investigations: {discovered} newly discovered, {changed} updated, and {unchanged} re-read with no changes.")],
        [
            (lambda n: n["changed"] > 0, "Updated records mean the latest CAROL response changed the indexed investigation state."),
            (lambda n: n["unchanged"] > 0, "Re-read and confirmed records were fetched again and matched the existing indexed state."),
        ],
    ),
    "enumerate-dockets": (
        ("enumerated", "changed", "total_items"),
        [(lambda n: True, "This run enumerated {enumerated} docket pages and indexed {total_items} docket items.")],
        [
            (lambda n: 0 < n["changed"] < n["enumerated"], "It detected docket changes for {changed} cases and re-read and confirmed {same} unchanged cases."),
            (lambda n: n["changed"] > 0, "It detected docket changes for {changed} enumerated cases."),
            (lambda n: n["enumerated"] > 0, "It re-read the docket pages and confirmed the indexed docket inventory was unchanged."),
        ],
    ),
    "download-selected": (
        ("evaluated", "selected", "rejected", "downloaded", "reused"),
        [(lambda n: True, "This run evaluated {evaluated} docket items for download selection: {selected} selected and {rejected} rejected.")],
        [
            (lambda n: n["downloaded"] > 0 and n["reused"] > 0, "It downloaded {downloaded} new files and reused {reused} previously acquired files."),
            (lambda n: n["downloaded"] > 0, "It downloaded {downloaded} new files."),
            (lambda n: n["reused"] > 0, "No new downloads were needed. The run reused {reused} previously acquired files."),
            (lambda n: True, "No new downloads were performed during this pass."),
        ],
    ),
    "materialize-case": (
        ("materialized", "reused"),
        [
            (lambda n: n["materialized"] > 0 and not n["reused"], "This run created a new materialized case view for {case} and wrote {materialized} files into the output directory."),
            (lambda n: n["materialized"] > 0, "This run added {materialized} new files to the materialized case view for {case} and reused {reused} existing files."),
            (lambda n: n["reused"] > 0, "This run found the materialized case view for {case} already complete. No new files were created, and {reused} existing files were reused."),
            (lambda n: True, "This run completed materialize-case for {case} with {materialized} newly created files and {reused} reused files."),
        ],
        [(lambda n: not n["materialized"] and n["reused"] > 0, "Why counts look this way")],
        [(lambda n: not n["materialized"] and n["reused"] > 0, "Materialized 0 means no new files needed to be created.")],
        [(lambda n: not n["materialized"] and n["reused"] > 0, "Reused {reused} means the case view already contained {reused} valid files.")],
    ),
}


def narrative_sentences(command: str, fields: dict) -> list[str]:
    """What a command did, in sentences; none for a command without any, or where a counter is missing."""
    needed, *groups = _NARRATIVES.get(command, ((),))
    whole = lambda v: int(v) if isinstance(v, int) and not isinstance(v, bool) or isinstance(v, str) and v.isdigit() else None
    n = {k: whole(fields.get(k)) for k in needed}
    if None in n.values():
        return []
    words = n | {"case": shown(fields.get("ntsb_number")), "same": n.get("enumerated", 0) - n.get("changed", 0)}
    hits = [next((text for test, text in group if test(n)), None) for group in groups]
    return [x.format(**words) for x in hits if x]


def html_report(command: str, fields: dict, files: dict[str, str] | None = None, run_id: str = "-", timestamp: str = "-") -> str:
    """Report of a run: sentences and a table of all fields; those that name a file are links, as are ``files``."""
    e, linked = html.escape, files or {}

    def cell(key: str, value) -> str:
        text = shown(value)
        if key not in FILE_FIELDS and key not in linked or text == "-":
            return e(text)
        link = text if ":" in text.split("/")[0] else "file://" + text
        return f'<a href="{e(link, quote=True)}">{e(text)}</a>'

    every = {"command": command, "run_id": run_id, "timestamp": timestamp} | fields | linked
    rows = "".join(f"<tr><th>{e(label(k))}</th><td>{cell(k, v)}</td></tr>" for k, v in every.items())
    told = "".join(f"<p>{e(x)}</p>" for x in narrative_sentences(command, fields))
    told = f"<h2>What happened</h2>{told}" if told else ""
    return f"<!doctype html><html lang='en'><head><meta charset='utf-8'><title>{e(command)} {e(run_id)}</title></head><body><h1>{e(command)}</h1>{told}<table>{rows}</table></body></html>"


def report_name(command: str, run_id: str, timestamp: str) -> str:
    return f"{timestamp.replace('-', '').replace(':', '').replace('T', '_')}_{command}_{run_id.replace(':', '')}.html"
