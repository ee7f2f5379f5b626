"""Text normalisation as Column expressions.

Whitespace follows Python's Unicode notion, which Java's class only partly covers; ``WS`` is the full class. NFKC is
the one step Spark has no function for: it runs as an Arrow UDF that is handed only the values with a non-ASCII
character (ASCII is its own normal form), so ASCII columns ship nulls.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

WS = r"[\s\x0B\x1C-\x1F\x85\p{Z}]"
#: The members of ``WS``; trimming a set of characters is many times faster than a pattern that looks for the end.
WS_CHARS = "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"
LINE_BREAK = r"\r\n|[\n\x0B\f\r\x1C-\x1E\x85\u2028\u2029]"
NON_ASCII = r"[^\x00-\x7F]"


def let(value: Column, body) -> Column:
    """Evaluate ``value`` once and use it many times in ``body``."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _nfkc(values: pd.Series) -> pd.Series:
    return values.map(lambda x: unicodedata.normalize("NFKC", x), na_action="ignore")


def nfkc(c: Column) -> Column:
    return F.coalesce(F.pandas_udf(_nfkc, "string")(F.when(c.rlike(NON_ASCII), c)), c)


def strip(c: Column) -> Column:
    """Both ends, all Unicode white space (Spark's trim takes spaces only)."""
    return F.btrim(c, F.lit(WS_CHARS))


def rstrip(c: Column) -> Column:
    return F.rtrim(c, F.lit(WS_CHARS))


def squeeze(c: Column) -> Column:
    """Runs of white space to one space, ends stripped; no Unicode normal form."""
    return F.btrim(F.regexp_replace(c, f"{WS}+", " "))


def collapse_whitespace(c: Column, unicode: bool = True) -> Column:
    return squeeze(nfkc(c) if unicode else c)


def normalize_text(c: Column, unicode: bool = True) -> Column:
    return squeeze(F.lower(nfkc(c) if unicode else c))


def strip_punctuation(c: Column) -> Column:
    """Drops category P; symbols such as + $ = stay."""
    return F.regexp_replace(c, r"\p{P}", "")


def slugify(c: Column, max_length: int = 80, unicode: bool = True) -> Column:
    plain = F.regexp_replace(strip_punctuation(normalize_text(c, unicode)), f"{WS}+", "_")
    tidy = F.btrim(F.regexp_replace(plain, "_+", "_"), F.lit("_"))
    return F.coalesce(blank_to_null(F.btrim(F.substring(tidy, 1, max_length), F.lit("_"))), F.lit("item"))


def blank_to_null(c: Column) -> Column:
    """Null for the empty string."""
    return F.when(c != "", c)


def clean_optional(c: Column) -> Column:
    """Stripped text, or null when nothing is left."""
    return let(strip(c), blank_to_null)


def first_text(*cs: Column) -> Column:
    """First value that is not null or white space."""
    return F.coalesce(*[clean_optional(c) for c in cs])


def normalize_case_number(c: Column, unicode: bool = True) -> Column:
    return F.replace(F.upper(collapse_whitespace(c, unicode)), F.lit(" "), F.lit(""))


def cue_text(c: Column) -> Column:
    """Form in which classification cues are looked up; null is empty."""
    return F.btrim(F.regexp_replace(F.lower(F.coalesce(c, F.lit(""))), "[^a-z0-9]+", " "))


def normalize_heading(c: Column) -> Column:
    numbered = F.regexp_replace(squeeze(c), r"^\d+(\.\d+)*[.)]?\s*", "")
    return squeeze(F.regexp_replace(F.upper(F.btrim(numbered, F.lit(":- "))), "[^A-Z0-9 ]+", ""))


def split_lines(c: Column) -> Column:
    """Lines as Python's splitlines gives them: no empty line after a final break, none for an empty text."""
    return let(F.split(c, LINE_BREAK, -1), lambda x: F.when(F.element_at(x, -1) == "", F.slice(x, 1, F.size(x) - 1)).otherwise(x))


def count_before(c: Column, noun: str) -> Column:
    """The number in "12 pages"; null where there is none."""
    return F.try_to_number(F.regexp_extract(c, rf"(?i)(\d+)\s+{noun}s?", 1), F.lit("9999999999")).cast("int")


def is_pdf_href(c: Column) -> Column:
    low = F.lower(c)
    return low.endswith(".pdf") | low.contains(".pdf?") | low.contains("fileextension=pdf")


def query_parameter(url: Column, name: str) -> Column:
    """First non-blank value of a query parameter, its name in any case, decoded ("+" is a space) and collapsed."""
    pairs = F.split(F.coalesce(F.try_parse_url(url, F.lit("QUERY")), F.lit("")), "&")
    named = F.filter(pairs, lambda p: F.lower(F.substring_index(p, "=", 1)) == name.lower())
    values = F.transform(named, lambda p: squeeze(F.try_url_decode(F.regexp_replace(p, "^[^=]*=?", ""))))
    return F.get(F.filter(values, lambda v: v != ""), F.lit(0))


def file_extension(url: Column, media_type: Column, blob_path: Column) -> Column:
    """Extension with its dot: path of the URL, FileExtension, FileName, media type, blob path, else ".bin"."""
    suffix = lambda c: blank_to_null(F.lower(F.regexp_extract(c, r"(\.[A-Za-z0-9]+)$", 1)))
    asked = query_parameter(url, "FileExtension")
    types = F.create_map(*[F.lit(x) for kv in MEDIA_TYPES.items() for x in kv])
    return F.coalesce(
        suffix(F.try_parse_url(url, F.lit("PATH"))),
        F.when(asked.isNotNull(), F.concat(F.lit("."), F.lower(F.regexp_replace(asked, r"^\.", "")))),
        suffix(query_parameter(url, "FileName")),
        F.try_element_at(types, F.lower(F.btrim(F.substring_index(media_type, ";", 1)))),
        suffix(blob_path),
        F.lit(".bin"),
    )


def ordinal_name(ordinal: Column, slug: Column, extension: Column) -> Column:
    """007_slug.ext; an ordinal over 999 keeps all its digits."""
    return F.concat(F.format_string("%03d", ordinal), F.lit("_"), slug, extension)


#: Media types with a preferred extension.
MEDIA_TYPES = {"application/pdf": ".pdf", "text/plain": ".txt", "text/html": ".html", "image/jpeg": ".jpg", "image/png": ".png", "application/json": ".json"}
