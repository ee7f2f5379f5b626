"""Rule classifiers: document selection and document type. Rules are data; each is a Column over its inputs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions import rules as R
from caseloom.functions.text import cue_text, let


def found(text: Column, words: tuple[str, ...]) -> Column:
    """The listed words that occur in ``text`` as substrings, in list order."""
    return F.filter(F.array(*[F.lit(w) for w in words]), lambda w: F.contains(text, w))


def first_found(text: Column, words: tuple[str, ...]) -> Column:
    """The first of ``found`` or null, without building the array."""
    return F.coalesce(*[F.when(text.contains(w), F.lit(w)) for w in words])


def selection(title: Column, download_url: Column, display_type: Column, page_count: Column, photo_count: Column, high_value: tuple[str, ...] = R.HIGH_VALUE_TITLES, negative: tuple[str, ...] = R.NEGATIVE_TITLES) -> Column:
    """Struct selected, rule_version, matched_rules, rationale. Null texts match nothing; a page count of 0 counts as
    none, as does a photo count of 0."""
    low = F.lower(F.coalesce(title, F.lit("")))
    url, kind = F.lower(F.coalesce(download_url, F.lit(""))), F.lower(F.coalesce(display_type, F.lit("")))
    signals = F.filter(F.array(F.when(url.endswith(".pdf"), "pdf_download_url"), F.when(kind.contains("pdf"), "pdf_display_type")), lambda x: x.isNotNull())
    named = lambda label, words: F.transform(found(low, words), lambda w: F.concat(F.lit(label), w))
    photo_only = (F.coalesce(photo_count, F.lit(0)) != 0) & (F.coalesce(page_count, F.lit(0)) == 0)

    def decide(m: Column) -> Column:
        because = F.when(photo_only, "photo_only").when(F.size(m["no"]) > 0, "negative_title").when(F.size(m["pdf"]) == 0, "no_pdf").when(F.size(m["yes"]) == 0, "low_value").otherwise("selected")
        matched = F.concat(m["pdf"], m["yes"], F.when(photo_only, F.array(F.lit("reject_photo_only"))).otherwise(m["no"]))
        reasons = F.create_map(*[F.lit(x) for kv in R.SELECTION_RATIONALES.items() for x in kv])
        return let(because, lambda b: F.struct((b == "selected").alias("selected"), F.lit(R.SELECTION_VERSION).alias("rule_version"), matched.alias("matched_rules"), F.element_at(reasons, b).alias("rationale")))

    return let(F.struct(signals.alias("pdf"), named("title:", high_value).alias("yes"), named("reject_title:", negative).alias("no")), decide)


def _regulatory(text: Column, source: str) -> Column:
    """Basis text of a regulatory report, or null."""
    phrase = first_found(text, R.CUES["regulatory_report"])
    sets = [F.when(_all(text, words), F.lit(f"{source} matched " + " + ".join(f"'{w}'" for w in words))) for words in R.REGULATORY_SETS]
    return F.coalesce(_basis(source, phrase), *sets)


def _all(text: Column, words: tuple[str, ...]) -> Column:
    hit = F.lit(True)
    for w in words:
        hit = hit & text.contains(w)
    return hit


def _basis(source: str, phrase: Column) -> Column:
    return F.when(phrase.isNotNull(), F.concat(F.lit(f"{source} matched '"), phrase, F.lit("'")))


def _investigation_title(text: Column, raw: Column) -> Column:
    """Basis text of an investigation report by its title, or null: cue, code prefix, "final report", "accident report"
    in context, report code."""
    prefix = F.upper(F.regexp_extract(raw, r"(?i)\b(pir|par)-", 1))
    code = F.upper(F.regexp_extract(raw, r"(?i)\b(pir|par|pab|psr)[-/ ]\d", 1))
    final = text.contains("final report") & ~text.contains("factual report") & _regulatory(text, "title").isNull()
    accident = text.contains("accident report") & first_found(text, R.NOT_INVESTIGATION).isNull() & first_found(text, R.ACCIDENT_CONTEXT).isNotNull()
    return F.coalesce(
        _basis("title", first_found(text, R.CUES["investigation_report"])),
        F.when(prefix != "", F.concat(F.lit("title matched '"), prefix, F.lit("-'"))),
        F.when(final, "title matched 'final report'"),
        F.when(accident, "title matched 'accident report'"),
        F.when(code != "", F.concat(F.lit("title matched report code '"), code, F.lit("'"))),
    )


def document_type(title: Column, excerpt: Column) -> Column:
    """Struct document_type, basis: the first rule that matches, titles before text, else unknown. ``CASE`` stops at
    the first hit, so text rules are not evaluated for a title that tells."""

    def branches(source: str, text: Column, raw: Column | None) -> list[tuple[str, Column]]:
        cue = lambda kind: _basis(source, first_found(text, R.CUES[kind]))
        shared = [(k, cue(k)) for k in ("preliminary_report", "materials_report", "emergency_response_report", "factual_report")]
        if raw is None:
            return [*shared, ("investigation_report", cue("investigation_report"))]
        talk = F.when(first_found(text, R.INTERVIEW_GUARD).isNull(), cue("interview_transcript"))
        return [*shared, ("interview_transcript", talk), ("investigation_report", _investigation_title(text, raw)), ("attachment_appendix", cue("attachment_appendix")), ("regulatory_report", _regulatory(text, source)), ("external_reference", cue("external_reference"))]

    def pick(rows: list[tuple[str, Column]]) -> Column:
        return F.coalesce(*[F.when(basis.isNotNull(), F.struct(F.lit(kind).alias("document_type"), basis.alias("basis"))) for kind, basis in rows])

    raw = F.coalesce(title, F.lit(""))
    unknown = F.struct(F.lit("unknown").alias("document_type"), F.lit("fallback to unknown").alias("basis"))
    return F.coalesce(let(cue_text(title), lambda t: pick(branches("title", t, raw))), let(cue_text(excerpt), lambda t: pick(branches("text", t, None))), unknown)


def select_items(items: DataFrame) -> DataFrame:
    """Active items with their selection, and the rule columns of the current-state table."""
    s = selection(*[F.col(c) for c in ("title", "download_url", "display_type", "page_count", "photo_count")])
    return items.where("is_active").withColumn("selection", s).withColumns({"selection_selected": F.col("selection.selected"), "selection_rule_version": F.col("selection.rule_version"), "selection_matched_rules_json": F.to_json("selection.matched_rules"), "selection_rationale": F.col("selection.rationale")})


def triage(records: DataFrame, excerpt_chars: int = 4000) -> DataFrame:
    """``records`` with inferred_document_type and inference_basis; the excerpt is the first ``excerpt_chars``
    characters, as the rule's definition has it."""
    t = document_type(F.col("title"), F.substring("text", 1, excerpt_chars))
    return records.withColumn("__t", t).withColumns({"inferred_document_type": F.col("__t.document_type"), "inference_basis": F.col("__t.basis")}).drop("__t")
