"""Hashes, canonical JSON and identifiers as Column expressions.

Canonical JSON has sorted keys, no spaces and ASCII escapes, so equal records have equal bytes everywhere. Spark
writes non-ASCII characters raw; the escape runs as an Arrow UDF that is handed only the values that need it.
"""

from __future__ import annotations

import re

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from caseloom.functions.text import normalize_case_number

_TOKEN = re.compile(r"\\u00[0-9A-F]{2}|\\.|[^\x00-\x7e]")


def _token(match: re.Match) -> str:
    """An escape of a control character in lower case, another escape as it is, a character beyond ASCII escaped."""
    found = match.group()
    if found[0] == "\\":
        return found.lower() if found.startswith("\\u00") else found
    raw = found.encode("utf-16-be", "surrogatepass")
    return "".join(f"\\u{raw[i]:02x}{raw[i + 1]:02x}" for i in range(0, len(raw), 2))


def _ascii(values: pd.Series) -> pd.Series:
    return values.map(lambda x: _TOKEN.sub(_token, x), na_action="ignore")


def ascii_json(json: Column) -> Column:
    return F.coalesce(F.pandas_udf(_ascii, "string")(F.when(json.rlike(r"[^\x00-\x7E]|\\u00"), json)), json)


def canonical_json(fields: dict[str, Column], ascii_only: bool = False) -> Column:
    """JSON object of ``fields`` with sorted keys; nulls stay as null. ``ascii_only`` promises printable ASCII values,
    which leaves the whole expression in the JVM."""
    json = F.to_json(F.struct(*[fields[k].alias(k) for k in sorted(fields)]), {"ignoreNullFields": "false"})
    return json if ascii_only else ascii_json(json)


def sha256(c: Column) -> Column:
    return F.sha2(c, 256)


def fingerprint(fields: dict[str, Column], ascii_only: bool = False) -> Column:
    return sha256(canonical_json(fields, ascii_only))


def ordered_digest(rows: Column) -> Column:
    """Digest of a list of canonical objects, in the order of their text: an aggregate over JSON strings."""
    return sha256(F.concat(F.lit("["), F.array_join(F.array_sort(F.collect_list(rows)), ","), F.lit("]")))


#: Identifier prefixes.
SOURCE = "ntsb"


def investigation_id(number: Column) -> Column:
    return F.concat_ws(":", F.lit(SOURCE), F.lit("investigation"), normalize_case_number(number))


def docket_id(number: Column) -> Column:
    return F.concat_ws(":", F.lit(SOURCE), F.lit("docket"), normalize_case_number(number))


def docket_item_id(number: Column, ordinal: Column, slug: Column) -> Column:
    return F.concat_ws(":", F.lit(SOURCE), F.lit("docket_item"), normalize_case_number(number), ordinal.cast("string"), slug)


def docket_of_item(item_id: Column) -> Column:
    """The case of a docket item id; null where the id has another form."""
    part = lambda k: F.get(F.split(item_id, ":"), F.lit(k))
    return F.when((part(0) == SOURCE) & (part(1) == "docket_item") & (part(2) != ""), part(2))


def document_id(digest: Column) -> Column:
    return F.concat(F.lit("doc:sha256:"), digest)


def blob_path(digest: Column) -> Column:
    return F.concat_ws("/", F.lit("sha256"), F.substring(digest, 1, 2), F.substring(digest, 3, 2), digest)


def promoted_path(number: Column, item_id: Column, digest: Column) -> Column:
    return F.concat(number, F.lit("/"), item_id, F.lit("__"), F.substring(digest, 1, 16), F.lit(".pdf"))


ITEM_FIELDS = ("ordinal", "normalized_title_slug", "title", "page_count", "photo_count", "display_type", "view_url", "download_url")
DOCKET_FIELDS = ("docket_id", "public_url", "item_count", "creation_date", "last_modified", "public_release_at", "ordered_item_fingerprints")
INVESTIGATION_FIELDS = ("investigation_id", "project_id", "mode", "event_date", "title", "case_type", "location")
SEARCH_FIELDS = ("project_id", "result_url", "event_date", "city", "state_or_region", "docket_details", "accident_description")


def record_fingerprint(names: tuple[str, ...], number: str = "ntsb_number") -> Column:
    """Fingerprint of the named columns with the normalised case number."""
    return fingerprint({number: normalize_case_number(F.col(number))} | {n: F.col(n) for n in names})


def paragraph_id(artifact: Column, paragraph: Column) -> Column:
    return F.concat(F.lit("pstruct:"), artifact, F.lit(":paragraph:"), paragraph.cast("string"))


def sentence_id(case: Column, artifact: Column, paragraph: Column, sentence: Column, ascii_only: bool = False) -> Column:
    seed = {"type": F.lit("paragraph"), "paragraph": paragraph, "parent_structural_span_id": paragraph_id(artifact, paragraph)}
    return F.concat_ws(":", F.lit("sspan"), case, artifact, F.substring(fingerprint(seed, ascii_only), 1, 12), sentence.cast("string"))
