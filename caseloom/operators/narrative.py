"""Primary narrative of a case: one document per docket by type, title length, text length and id."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.rules import TYPE_PRECEDENCE
from caseloom.functions.text import strip


def text_length(text: Column) -> Column:
    """Characters, a line break counting once; 0 for null."""
    return F.coalesce(F.char_length(F.regexp_replace(text, r"\r\n?", "\n")), F.lit(0))


def primary_narrative(candidates: DataFrame, precedence: tuple[str, ...] = TYPE_PRECEDENCE, strip_title: bool = True) -> DataFrame:
    """``candidates``: docket_id, docket_item_id, inferred_document_type, title, text. One row per docket.

    The pick is a minimum over a struct, so map tasks combine it and only one small row per docket and task moves:
    texts never do, and a docket with any number of documents is no hot key. Dockets with a null id form one group.
    Titles count without white space at their ends, unless ``strip_title`` is false and they are measured as given.
    """
    title = F.coalesce("title", F.lit(""))
    rank = F.lit(len(precedence))
    for k, kind in reversed(list(enumerate(precedence))):
        rank = F.when(F.col("inferred_document_type") == kind, k).otherwise(rank)
    keyed = candidates.select("docket_id", F.struct(rank.alias("rank"), (-F.char_length(strip(title) if strip_title else title)).alias("title"), (-text_length(F.col("text"))).alias("text"), F.col("docket_item_id").alias("id"), F.col("inferred_document_type").alias("kind")).alias("k"))
    best = keyed.groupBy("docket_id").agg(F.min("k").alias("k"))
    reason = F.when(F.col("k.rank") < len(precedence), F.concat(F.lit("selected highest-priority document_type "), F.col("k.kind"))).when(F.col("k.title") < 0, "selected fallback longest title").when(F.col("k.text") < 0, "selected fallback available text").otherwise("selected fallback first document")
    return best.select("docket_id", F.col("k.id").alias("selected_document_id"), F.col("k.kind").alias("inferred_document_type"), reason.alias("selection_reason"))
