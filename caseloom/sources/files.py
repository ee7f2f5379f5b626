"""File sources: JSON lines with line numbers, folders of records, raw files with digests, text, PDF, index payloads."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.functions.identity import investigation_id
from caseloom.functions.text import first_text, normalize_case_number, strip
from caseloom.operators.atomic import handoff_violations
from caseloom.schemas import SCHEMAS


def text_lines(spark: SparkSession, path: str) -> DataFrame:
    """(path, line_no, line): non-blank lines with their physical number. Each file is read whole by one task, as a
    line's number needs the lines before it; use it for manifests, not for bulk data."""
    whole = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("path"), F.col("value"))
    lines = whole.select("path", F.posexplode(F.split("value", "\r\n|\n", -1)).alias("i", "line"))
    return lines.where(strip(F.col("line")) != "").select("path", (F.col("i") + 1).alias("line_no"), "line")


def read_handoff(spark: SparkSession, path: str) -> tuple[DataFrame, DataFrame]:
    """(records with line_no, rejected lines with their violations) of a hand-off manifest. Unknown keys are ignored."""
    rows = text_lines(spark, path).withColumn("r", F.from_json("line", SCHEMAS["handoff"] + ", _corrupt string", {"columnNameOfCorruptRecord": "_corrupt"}))
    flat = rows.select("line_no", "line", "r.*")
    bad = F.concat(F.when(F.col("_corrupt").isNotNull() | ~F.col("line").startswith("{"), F.array(F.lit("not_an_object"))).otherwise(F.array().cast("array<string>")), handoff_violations())
    flat = flat.withColumn("violations", bad)
    return flat.where(F.size("violations") == 0).drop("line", "_corrupt", "violations"), flat.where(F.size("violations") > 0).select("line_no", "line", "violations")


def read_records(spark: SparkSession, folder: str, schema: str) -> DataFrame:
    """``*.json`` records of a folder, one object a file, with file_name; sub-folders are not read."""
    return spark.read.schema(schema).option("multiLine", True).option("mode", "FAILFAST").option("pathGlobFilter", "*.json").json(folder).withColumn("file_name", F.col("_metadata.file_name"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """JSON lines of a known schema; a line that is no object fails the read."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def name_mismatch(file_name: Column, item_id: Column) -> Column:
    return file_name != F.concat(item_id, F.lit(".json"))


def raw_files(spark: SparkSession, root: str, extensions: tuple[str, ...] = ("pdf",)) -> DataFrame:
    """(path, sha256, file_size, content) of files under ``root`` with an allowed suffix in any case."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    kept = files.where(F.lower(F.regexp_extract("path", r"\.([A-Za-z0-9]+)$", 1)).isin(*extensions))
    return kept.select("path", F.sha2("content", 256).alias("sha256"), F.col("length").alias("file_size"), "content")


def excerpt(text: Column, limit: int = 4000) -> Column:
    """First ``limit`` characters, as triage defines it."""
    return F.substring(text, 1, limit)


def pdf_texts(files: DataFrame, extract_pages: Callable[[bytes], list[str | Exception]] | None, strict: bool = False) -> DataFrame:
    """``files`` (path, content) to path, text, warnings, error. ``extract_pages`` gives each page's text or the
    exception it raised; none is built in. Tolerant: failed pages become warnings, and a file fails only if it cannot
    be opened or no page of it can be read. Strict: any failed page fails the file."""
    if extract_pages is None:
        raise RuntimeError("no PDF extractor is configured")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for path, content in zip(batch["path"], batch["content"], strict=True):
                text, warnings, error = None, [], None
                try:
                    pages = extract_pages(content)
                    warnings = [f"page {i}: {p}" for i, p in enumerate(pages, 1) if isinstance(p, Exception)]
                    good = [p for p in pages if not isinstance(p, Exception)]
                    if warnings and (strict or not good):
                        error = warnings[0]
                    else:
                        text = "\n\n".join(good).strip()
                except Exception as e:  # a broken file is a failure row
                    error = f"{type(e).__name__}: {e}"
                out.append((path, text, warnings, error))
            yield pd.DataFrame(out, columns=["path", "text", "warnings", "error"])

    return files.select("path", "content").mapInPandas(run, "path string, text string, warnings array<string>, error string")


def index_records(payloads: DataFrame) -> DataFrame:
    """``payloads``: body (JSON text). Investigations of an index payload: a list, or the first list under results,
    investigations, items or data; elements that are no objects are dropped. A payload of another shape is an error.
    Field names come in several casings; the first that is not blank counts. Rows without a case number are kept with
    ``rejected`` set, so one bad row does not end a sync."""
    body = F.col("body")
    lists = [F.when(F.substring(strip(body), 1, 1) == "[", body), *[F.get_json_object(body, f"$.{k}") for k in ("results", "investigations", "items", "data")]]
    found = F.coalesce(*[F.when(F.substring(strip(x), 1, 1) == "[", F.from_json(x, "array<string>")) for x in lists], F.raise_error(F.lit("unsupported index payload")).cast("array<string>"))
    raw = payloads.select(F.explode(found).alias("raw")).where(F.col("raw").startswith("{"))
    get = lambda *names: first_text(*[F.get_json_object("raw", f"$.{n}") for n in names])
    nested = F.coalesce(*[F.when(F.get_json_object("raw", f"$.{n}").startswith("{"), F.get_json_object("raw", f"$.{n}")) for n in ("location", "Location")])
    flat = F.map_filter(F.create_map(*[x for k in ("city", "state", "country", "airport") for x in (F.lit(k), F.coalesce(F.get_json_object("raw", f"$.{k.capitalize()}"), F.get_json_object("raw", f"$.{k}")))]), lambda _, v: v.isNotNull())
    number = get("ntsbNumber", "NTSBNumber", "caseNumber", "CaseNumber")
    rows = raw.select(number.alias("n"), get("projectId", "ProjectId", "projectID").alias("project_id"), get("mode", "Mode", "modal", "Modal").alias("mode"), get("eventDate", "EventDate").alias("event_date"), get("title", "Title").alias("title"), get("caseType", "CaseType").alias("case_type"), F.coalesce(nested, F.to_json(flat)).alias("location_json"), F.col("raw").alias("carol_metadata_json"))
    return rows.select(normalize_case_number(F.col("n")).alias("ntsb_number"), investigation_id(F.col("n")).alias("investigation_id"), *[c for c in rows.columns if c != "n"], F.col("n").isNull().alias("rejected"))
