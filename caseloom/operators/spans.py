"""Sentence spans: blocks, sentences, identifiers and neighbours, all in one narrow plan (no shuffle)."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.identity import paragraph_id, sentence_id
from caseloom.functions.text import blank_to_null, let, rstrip, split_lines, squeeze, strip

#: Abbreviations whose points end no sentence, replaced as substrings in this order.
ABBREVIATIONS = ("Mr.", "Mrs.", "Ms.", "Dr.", "Prof.", "Sr.", "Jr.", "St.", "U.S.", "U.K.", "No.", "Inc.", "Ltd.", "e.g.", "i.e.", "etc.", "a.m.", "p.m.", "Q.", "A.")
#: Fixed value: a line that starts a bullet, a number or a "LABEL:".
LIST_LINE = r"^\s*(?:[-*•]|\d+[.)]|[A-Z][A-Z0-9 .'/()-]{0,40}:)\s+"
INITIALS = r"(?<=\b[A-Z])\.(?=[A-Z]\.)|(?<=\b(?:[A-Z]\.){1,40}[A-Z])\."
#: Private-use characters stand for protected points; they cannot be mistaken for text in angle brackets.
POINT, DECIMAL, ELLIPSIS = "\ue000", "\ue001", "\ue002"
SENTENCE_GAP = r"(?<=[.!?])\s+(?=(?:[\"'(\[])?[A-Z0-9])"


def blocks(text: Column) -> Column:
    """Paragraphs; a paragraph with a list line gives one block per line."""

    def of_paragraph(p: Column) -> Column:
        lines = F.filter(F.transform(split_lines(p), rstrip), lambda x: x != "")
        return let(lines, lambda ls: F.when(F.exists(ls, lambda x: x.rlike(LIST_LINE)), F.transform(ls, squeeze)).otherwise(F.array(squeeze(F.array_join(ls, "\n")))))

    paragraphs = F.split(strip(text), r"\n\s*\n+")
    return F.filter(F.flatten(F.transform(paragraphs, of_paragraph)), lambda b: b != "")


def _protect(c: Column) -> Column:
    c = F.replace(c, F.lit("..."), F.lit(ELLIPSIS))
    c = F.regexp_replace(c, r"(?<=\d)\.(?=\d)", DECIMAL)
    c = reduce(lambda x, a: F.replace(x, F.lit(a), F.lit(a.replace(".", POINT))), ABBREVIATIONS, c)
    # The look-behind is slow, and hardly any text has two initials in a row.
    return let(c, lambda x: F.when(x.rlike(r"[A-Z]\.[A-Z]\."), F.regexp_replace(x, INITIALS, POINT)).otherwise(x))


def _restore(c: Column) -> Column:
    return F.replace(F.translate(c, POINT + DECIMAL, ".."), F.lit(ELLIPSIS), F.lit("..."))


def sentences(block: Column) -> Column:
    """Sentences of a block, never empty for a block with text."""
    parts = F.split(_protect(squeeze(block)), SENTENCE_GAP)
    return F.filter(F.transform(parts, lambda p: strip(_restore(p))), lambda s: s != "")


def sentence_spans(docs: DataFrame, segmentation: str = "sentence_spans_v1", context: bool = True, ascii_ids: bool = False, blank: bool = False) -> DataFrame:
    """``docs``: case_id, artifact_id, text, artifact_checksum, text_extraction_version. One row per sentence, indexes
    from 1. Null and blank texts have no span; with ``blank`` a blank text has one, which is empty. Two explodes and no shuffle, so it scales with the input alone."""
    # A block is only empty where its text is blank.
    empty = lambda parts: F.when(F.size(parts) == 0, F.array(F.lit(""))).otherwise(parts)
    cut = lambda c, into: let(into(c), empty) if blank else into(c)
    # Outer explodes: an inner one makes Spark filter on the array first, which would compute it twice.
    by_block = docs.select("case_id", "artifact_id", "artifact_checksum", "text_extraction_version", F.posexplode_outer(cut(F.col("text"), blocks)).alias("__b", "__block"))
    by_block = by_block.where("__block is not null").select("*", (F.col("__b") + 1).alias("paragraph"), cut(F.col("__block"), sentences).alias("__s"))
    spans = by_block.select("*", F.posexplode_outer("__s").alias("__i", "sentence_text")).where("sentence_text is not null")
    index = F.col("__i") + 1
    at = lambda k: F.coalesce(F.get("__s", k), F.lit(""))
    out = spans.select(
        sentence_id(F.col("case_id"), F.col("artifact_id"), F.col("paragraph"), index, ascii_ids).alias("sentence_span_id"),
        "artifact_id",
        "case_id",
        paragraph_id(F.col("artifact_id"), F.col("paragraph")).alias("parent_structural_span_id"),
        F.struct(F.lit("paragraph_sentence").alias("type"), F.col("paragraph"), index.alias("sentence")).alias("locator"),
        "sentence_text",
        index.alias("sentence_index"),
        F.lit(segmentation).alias("segmentation_version"),
        F.struct(F.concat(F.lit("sha256:"), F.col("artifact_checksum")).alias("artifact_checksum"), "text_extraction_version", F.lit(segmentation).alias("segmentation_version")).alias("provenance"),
        F.when(F.lit(context), F.struct(at(F.col("__i") - 1).alias("preceding_text"), at(index).alias("following_text"))).alias("context"),
    )
    return out


def span_inputs(documents: DataFrame, method: str = "unknown", ocr_engine: str = "unknown") -> DataFrame:
    """Case, artifact and version columns of an operational document table with a text column. Blank ids count as
    missing: case number, then case number of the filing, then the document."""
    full = lambda *cs: F.coalesce(*[blank_to_null(F.col(c)) for c in cs])
    version = F.when(F.col("stage") == "ocr", f"ocr:{ocr_engine}").otherwise(f"extract:{method}")
    return documents.select(full("ntsb_number", "case_number", "doc_id").alias("case_id"), full("docket_item_id", "doc_id").alias("artifact_id"), "text", F.sha2("text", 256).alias("artifact_checksum"), version.alias("text_extraction_version"))


def index_check(spans: DataFrame) -> DataFrame:
    """Per paragraph: whether sentence indexes run 1, 2, 3 ... without gap or repeat (map-combined counts only)."""
    s = spans.groupBy("parent_structural_span_id").agg(F.min("sentence_index").alias("lo"), F.max("sentence_index").alias("hi"), F.count("*").alias("n"), F.count_distinct("sentence_index").alias("d"))
    return s.select("parent_structural_span_id", "n", ((F.col("lo") == 1) & (F.col("hi") == F.col("n")) & (F.col("d") == F.col("n"))).alias("sequential"))
