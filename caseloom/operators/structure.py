"""Section structure of reports.

The line-by-line machine is restated as windows: a heading always opens a segment, so a running count of headings
numbers segments, the segment's key is its heading's, and everything after the first stop of a segment is out. All
windows share one partitioning (the document), so the whole operator is one shuffle.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.functions import rules as R
from caseloom.functions.text import clean_optional, normalize_heading, rstrip, split_lines, strip


def section_key(heading: Column, headings: dict[str, str] = R.HEADINGS) -> Column:
    """Section of a normalised heading, or null."""
    return F.try_element_at(F.create_map(*[F.lit(x) for kv in headings.items() for x in kv]), heading)


def is_stop(heading: Column) -> Column:
    hit = heading.isin(*R.STOP_HEADINGS)
    for p in R.STOP_PREFIXES:
        hit = hit | heading.startswith(p)
    return hit


def cause_stop(heading: Column, joined: Column) -> Column:
    """Fixed text that ends a probable cause, on the line or over the line and its successor; null where none."""
    hits = [F.when(c.startswith(p), F.lit(p)) for c in (heading, joined) for p in R.CAUSE_STOPS]
    return F.coalesce(*hits)


def is_noise(text: Column, heading: Column) -> Column:
    noise = (heading == "") | strip(text).rlike(r"^[\s\-_=*•·.]+$")
    for pattern in R.NOISE_PATTERNS:
        noise = noise | heading.rlike(pattern)
    return noise


def line_assignments(docs: DataFrame, headings: dict[str, str] = R.HEADINGS, blank: bool = False) -> DataFrame:
    """``docs``: doc_id, text. One row per line: doc_id, line_index, text, kind, section_key, segment, stop_prefix.

    ``headings`` maps normalised headings to section keys; none may be a stop heading, which is checked. Every line
    is assigned exactly once. Null and empty texts have no lines; with ``blank`` an empty text has one, which is empty.
    """
    clash = [h for h in headings if h in R.STOP_HEADINGS or h.startswith(R.STOP_PREFIXES)]
    if clash:
        raise ValueError(f"headings that are also stops: {clash}")
    split = F.when(F.col("text") == "", F.array(F.lit(""))).otherwise(split_lines(F.col("text"))) if blank else split_lines(F.col("text"))
    lines = docs.select("doc_id", F.posexplode_outer(split).alias("line_index", "text")).where("text is not null")
    lines = lines.withColumn("heading", normalize_heading(F.col("text")))
    doc = Window.partitionBy("doc_id")
    order = doc.orderBy("line_index")
    nonblank = strip(F.col("text")) != ""
    lines = lines.select("*", section_key(F.col("heading"), headings).alias("opens"), nonblank.alias("full"), F.lead("text").over(order).alias("next"))
    lines = lines.withColumn("first_heading", F.min(F.when(F.col("opens").isNotNull(), F.col("line_index"))).over(doc))
    before = F.col("full") & (F.col("first_heading").isNull() | (F.col("line_index") < F.col("first_heading")))
    lines = lines.withColumn("first_full", F.min(F.when(before, F.col("line_index"))).over(doc))
    plausible = (F.char_length(strip(F.col("text"))) <= 160) & (F.size(F.split(strip(F.col("text")), r"[\s\p{Z}]+")) <= 20)
    lines = lines.withColumn("is_title", F.coalesce(F.col("line_index") == F.col("first_full"), F.lit(False)) & plausible)
    title = F.max(F.when(F.col("is_title"), F.col("heading"))).over(doc)
    lines = lines.select("*", title.alias("title_heading"), F.sum(F.col("opens").isNotNull().cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)).alias("segment"))
    segment = Window.partitionBy("doc_id", "segment")
    lines = lines.withColumn("section_key", F.coalesce(F.max("opens").over(segment), F.lit("abstract")))

    joined = F.when(strip(F.col("next")) != "", normalize_heading(F.concat(strip(F.col("text")), F.lit(" "), strip(F.col("next")))))
    repeated = (F.size(F.split("title_heading", " ")) >= 3) & (F.col("heading") == F.col("title_heading"))
    cause = F.col("section_key") == "probable_cause"
    no = F.lit(False)
    flags = lines.select(
        "*",
        is_noise(F.col("text"), F.col("heading")).alias("noise"),
        (cause & (F.col("heading") != "") & (F.coalesce(repeated, no) | F.col("heading").rlike(R.REPORT_ID))).alias("bleed"),
        F.when(cause & (F.col("heading") != ""), cause_stop(F.col("heading"), joined)).alias("stop_prefix"),
        is_stop(F.col("heading")).alias("stop"),
    )
    ends = ~F.col("is_title") & ~F.col("noise") & ~F.col("bleed") & F.col("opens").isNull() & (F.col("stop_prefix").isNotNull() | F.col("stop"))
    flags = flags.withColumn("first_stop", F.min(F.when(ends, F.col("line_index"))).over(segment))
    inside = F.col("first_stop").isNull() | (F.col("line_index") < F.col("first_stop"))
    kind = (
        F.when(F.col("is_title"), "title")
        .when(F.col("opens").isNotNull(), "section_header")
        .when(F.col("noise") | (F.col("bleed") & inside), "noise")
        .when(inside, "section_body")
        .when((F.col("line_index") == F.col("first_stop")) | F.col("stop"), "stop_header")
        .otherwise("unclassified")
    )
    owned = kind.isin("section_header", "section_body")
    return flags.select("doc_id", "line_index", "text", kind.alias("kind"), F.when(owned, F.col("section_key")).alias("section_key"), "segment", F.when(kind == "stop_header", F.col("stop_prefix")).alias("stop_prefix"), F.col("heading"))


def chunks(lines: DataFrame) -> DataFrame:
    """Segments with text positions: doc_id, segment, section_key, start and end line, body (lines joined)."""
    own = lines.where(F.col("section_key").isNotNull())
    body = F.when(F.col("kind") == "section_body", F.struct("line_index", rstrip(F.col("text")).alias("t")))
    # A factual section keeps its own sub-heading as a first line.
    label = F.when((F.col("kind") == "section_header") & (F.col("section_key") == "factual_information") & (F.col("heading") != "FACTUAL INFORMATION"), strip(F.col("text")))
    g = own.groupBy("doc_id", "segment", "section_key").agg(F.min("line_index").alias("start_line"), F.max("line_index").alias("end_line"), F.array_sort(F.collect_list(body)).alias("lines"), F.max(label).alias("label"))
    text = strip(F.array_join(F.transform("lines", lambda x: x["t"]), "\n"))
    return g.select("doc_id", "segment", "section_key", "start_line", "end_line", F.size("lines").alias("body_lines"), F.array_join(F.filter(F.array("label", F.when(text != "", text)), lambda x: x.isNotNull()), "\n").alias("text"))


def sections(lines: DataFrame) -> DataFrame:
    """One row per document and section: rank in the section order and text. A probable cause is its last non-empty
    chunk; others are their non-empty chunks with a blank line between."""
    full = F.when(F.col("text") != "", F.struct("segment", "text"))
    g = chunks(lines).groupBy("doc_id", "section_key").agg(F.array_sort(F.collect_list(full)).alias("parts"), F.min("segment").alias("first_segment"))
    texts = F.transform("parts", lambda p: p["text"])
    text = F.when((F.col("section_key") == "probable_cause") & (F.size("parts") > 0), F.element_at(texts, -1)).otherwise(F.array_join(texts, "\n\n"))
    known = F.array_position(F.array(*[F.lit(k) for k in R.SECTION_ORDER]), F.col("section_key"))
    rank = F.when(known > 0, known).otherwise(len(R.SECTION_ORDER) + 1 + F.col("first_segment"))
    return g.select("doc_id", "section_key", rank.alias("section_rank"), text.alias("text"))


def trace(docs: DataFrame, headings: dict[str, str] = R.HEADINGS) -> DataFrame:
    """One row per document: what became of every line, for looking into a parse. title_line_index, section_order,
    sections (key, headings, header and body lines, first and last line), unclassified_line_indexes, line_assignments
    (with the section in effect before and after the line). Documents without lines have empty arrays."""
    lines = line_assignments(docs, headings)
    order = Window.partitionBy("doc_id").orderBy("line_index")
    # The section in effect is that of the segment until its stop.
    after = F.when(F.col("kind").isin("section_header", "section_body"), F.col("section_key")).when(F.col("kind").isin("noise", "title"), F.lit(None)).otherwise(F.lit(""))
    carried = F.nullif(F.last(after, ignorenulls=True).over(order.rowsBetween(Window.unboundedPreceding, 0)), F.lit(""))
    lines = lines.withColumn("after", carried)
    lines = lines.withColumn("before", F.lag("after").over(order))
    segment = lines.where("section_key is not null").groupBy("doc_id", "segment", "section_key").agg(
        F.array_sort(F.collect_list(F.when(F.col("kind") == "section_header", F.struct("line_index", strip(F.col("text")).alias("t"))))).alias("heads"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "section_body", F.col("line_index")))).alias("body"),
        F.min("line_index").alias("first"),
        F.max("line_index").alias("last"),
    )
    section = F.struct("segment", F.struct("section_key", F.transform("heads", lambda x: x["t"]).alias("source_headings"), F.transform("heads", lambda x: x["line_index"]).alias("header_line_indexes"), F.col("body").alias("body_line_indexes"), F.col("first").alias("start_line_index"), F.col("last").alias("end_line_index")).alias("s"))
    sections_ = segment.groupBy("doc_id").agg(F.transform(F.array_sort(F.collect_list(section)), lambda x: x["s"]).alias("sections"))
    each = lines.groupBy("doc_id").agg(
        F.min(F.when(F.col("kind") == "title", F.col("line_index"))).alias("title_line_index"),
        F.array_sort(F.collect_list(F.when(F.col("kind") == "unclassified", F.col("line_index")))).alias("unclassified_line_indexes"),
        F.array_sort(F.collect_list(F.struct("line_index", "text", "kind", "section_key", F.col("before").alias("active_section_before"), F.col("after").alias("active_section_after")))).alias("line_assignments"),
    )
    out = docs.select("doc_id").join(each, "doc_id", "left").join(sections_, "doc_id", "left")
    none = lambda c: F.coalesce(F.col(c), F.array().cast(out.schema[c].dataType)).alias(c)
    keys = F.array_distinct(F.transform("sections", lambda x: x["section_key"]))
    out = out.select("doc_id", "title_line_index", none("sections"), none("unclassified_line_indexes"), none("line_assignments"))
    return out.select("doc_id", "title_line_index", keys.alias("section_order"), "sections", "unclassified_line_indexes", "line_assignments")


def report_structure(docs: DataFrame, headings: dict[str, str] = R.HEADINGS) -> DataFrame:
    """One row per document: title, sections in their order (an array of pairs, as a map has no order), probable cause,
    recommendations, statistics. Documents without a section have none."""
    lines = line_assignments(docs, headings)
    titles = lines.where("kind = 'title'").select("doc_id", strip(F.col("text")).alias("title"))
    found = sections(lines).groupBy("doc_id").agg(F.array_sort(F.collect_list(F.struct("section_rank", "section_key", "text"))).alias("s"))
    value = lambda k: F.get(F.transform(F.filter("s", lambda x: x["section_key"] == k), lambda x: x["text"]), F.lit(0))
    named = F.coalesce(F.transform("s", lambda x: F.struct(x["section_key"].alias("section_key"), x["text"].alias("text"))), F.array().cast("array<struct<section_key:string,text:string>>"))
    out = docs.select("doc_id", F.char_length("text").alias("source_text_length")).join(titles, "doc_id", "left").join(found, "doc_id", "left")
    return out.select("doc_id", "title", named.alias("sections"), clean_optional(value("probable_cause")).alias("probable_cause"), F.coalesce(clean_optional(value("recommendations")), clean_optional(value("what_we_recommended"))).alias("recommendations"), F.struct("source_text_length", F.coalesce(F.size("s"), F.lit(0)).alias("section_count")).alias("stats"))
