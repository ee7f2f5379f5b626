"""Web pages as raw cells. One Arrow UDF turns a page into tables, definition lists and forms; every rule on top is a
Column expression. The parser is the standard library's, which recovers from broken markup less than a browser does.
"""

from __future__ import annotations

import re
import unicodedata
from html import unescape
from html.parser import HTMLParser
from urllib.parse import urljoin

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caseloom.functions.text import blank_to_null, count_before, is_pdf_href, let, query_parameter, slugify

ROW = "struct<cells:array<string>,heads:array<string>,hrefs:array<string>,cell_hrefs:array<array<string>>,text:string,urls:array<string>,cell_urls:array<array<string>>>"
CONTROL = "struct<name:string,value:string>"
PAGE = f"struct<tables:array<struct<id:string,rows:array<{ROW}>>>,lists:array<struct<label:string,value:string>>,forms:array<struct<action:string,method:string,controls:array<{CONTROL}>,choices:array<struct<name:string,label:string,value:string>>>>>"

_TEXTS = pa.list_(pa.string())
_ROW = pa.struct([("cells", _TEXTS), ("heads", _TEXTS), ("hrefs", _TEXTS), ("cell_hrefs", pa.list_(_TEXTS)), ("text", pa.string()), ("urls", _TEXTS), ("cell_urls", pa.list_(_TEXTS))])
_strings = lambda *names: pa.list_(pa.struct([(n, pa.string()) for n in names]))
_FORM = pa.struct([("action", pa.string()), ("method", pa.string()), ("controls", _strings("name", "value")), ("choices", _strings("name", "label", "value"))])
_PAGE = pa.struct([("tables", pa.list_(pa.struct([("id", pa.string()), ("rows", pa.list_(_ROW))]))), ("lists", _strings("label", "value")), ("forms", pa.list_(_FORM))])

#: Plain markup: text, then one tag of ``_PLAIN_TAGS`` whose attributes hold no reference, angle bracket or slash without
#: quotes. A page of nothing else is read without the standard parser, to the same calls.
_SPACE = r"[ \t\n\r\f]"
_ATTRIBUTE = rf"""{_SPACE}+([A-Za-z][A-Za-z0-9-]*)(?:=(?:'([^'<>&]*)'|"([^"<>&]*)"|([A-Za-z0-9_.-]+)))?"""
_TAG = re.compile(rf"""(([^<]*)<(?:/([A-Za-z][A-Za-z0-9]*)|([A-Za-z][A-Za-z0-9]*)((?:{re.sub(r"[(](?![?])", "(?:", _ATTRIBUTE)})*)){_SPACE}*>)""")
_ATTRIBUTES = re.compile(_ATTRIBUTE)
_PLAIN_TAGS = frozenset("html body div p span b i em strong ul ol li h1 h2 h3 h4 h5 h6 table thead tbody tfoot tr td th a dl dt dd form select option input br".split())


def node_text(parts: list[str]) -> str:
    """Text pieces joined by a space, in normal form, white space collapsed."""
    whole = " ".join(parts)
    if whole.isascii():
        return " ".join(whole.split())
    return " ".join(unicodedata.normalize("NFKC", " ".join(p.strip() for p in parts if p.strip())).split())


class _Page(HTMLParser):
    """Collects tables, definition lists and forms of one page."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.tables, self.lists, self.forms = [], [], []
        self.open_tables, self.collectors, self.open = [], [], []  # collectors: [kind, texts]; open: their kinds
        self.row = self.form = self.select = None
        self.labels, self.values = [], []

    def _collect(self, kind: str) -> None:
        self.collectors.append([kind, []])
        self.open.append(kind)

    def _finish(self, kind: str) -> str | None:
        if kind not in self.open:
            return None
        for k in range(len(self.collectors) - 1, -1, -1):
            if self.collectors[k][0] == kind:
                text = node_text(self.collectors[k][1])
                del self.collectors[k:], self.open[k:]
                return text
        return None

    def handle_starttag(self, tag, attrs):
        a = {k: v if v is not None else "" for k, v in attrs} if attrs else {}
        if tag == "table":
            self.open_tables.append({"id": a.get("id", ""), "rows": []})
            self.tables.append(self.open_tables[-1])
        elif tag == "tr" and self.open_tables:
            self._end_row()
            self.row = {"cells": [], "heads": [], "hrefs": [], "cell_hrefs": []}
            self._collect("tr")
        elif tag in ("td", "th") and self.row is not None:
            self._end_cell()
            if tag == "td":
                self.row["cell_hrefs"].append([])
            self._collect(tag)
        elif tag == "a" and "href" in a and self.row is not None:
            self.row["hrefs"].append(a["href"])
            if self.row["cell_hrefs"]:
                self.row["cell_hrefs"][-1].append(a["href"])
        elif tag in ("dt", "dd"):
            self._end_term()
            self._collect(tag)
        elif tag == "form":
            self.form = {"action": a.get("action", ""), "method": (a.get("method") or "get").upper(), "controls": [], "choices": []}
            self.forms.append(self.form)
        elif self.form is not None and tag == "input":
            kind, name = (a.get("type") or "text").lower(), " ".join(a.get("name", "").split())
            ticked = kind in ("checkbox", "radio")
            if name and "disabled" not in a and kind not in ("button", "file", "image", "reset", "submit") and not (ticked and "checked" not in a):
                self.form["controls"].append((name, a.get("value") or ("on" if ticked else "")))
        elif self.form is not None and tag == "select":
            self.select = {"name": " ".join((a.get("name") or "").split()), "key": " ".join((a.get("name") or a.get("id") or "").split()), "off": "disabled" in a, "options": []}
        elif self.select is not None and tag == "option":
            self._end_option()
            self.select["options"].append([a.get("value"), "selected" in a, ""])
            self._collect("option")
        elif self.form is not None and tag == "textarea":
            self.area = (" ".join(a.get("name", "").split()), "disabled" in a)
            self._collect("textarea")

    def handle_endtag(self, tag):
        if tag in ("td", "th"):
            self._end_cell()
        elif tag == "tr":
            self._end_row()
        elif tag == "table" and self.open_tables:
            self._end_row()
            self.open_tables.pop()
        elif tag in ("dt", "dd"):
            self._end_term()
        elif tag == "dl":
            self._end_term()
            self.lists += [(label.lower(), value) for label, value in zip(self.labels, self.values) if label]
            self.labels, self.values = [], []
        elif tag == "option":
            self._end_option()
        elif tag == "select" and self.select is not None and self.form is not None:
            self._end_option()
            s, self.select = self.select, None
            for value, _, label in s["options"]:
                self.form["choices"].append((s["key"], label, value or label))
            now = [o for o in s["options"] if o[1]] or s["options"][:1]
            if now and s["name"] and not s["off"]:
                self.form["controls"].append((s["name"], now[0][0] or now[0][2]))
        elif tag == "textarea":
            text = self._finish("textarea")
            if text is not None and self.form is not None and self.area[0] and not self.area[1]:
                self.form["controls"].append((self.area[0], text))
        elif tag == "form":
            self.form = None

    def _end_cell(self):
        for tag in ("td", "th"):
            text = self._finish(tag) if tag in self.open else None
            if text is not None and self.row is not None:
                self.row["cells" if tag == "td" else "heads"].append(text)

    def _end_row(self):
        if self.row is None:
            return
        self._end_cell()
        self.row["text"] = self._finish("tr") or ""
        if self.open_tables:
            self.open_tables[-1]["rows"].append(self.row)
        self.row = None

    def _end_term(self):
        for tag, into in (("dt", self.labels), ("dd", self.values)):
            text = self._finish(tag)
            if text is not None:
                into.append(text)

    def _end_option(self):
        text = self._finish("option")
        if text is not None and self.select is not None and self.select["options"]:
            self.select["options"][-1][2] = text

    def handle_data(self, data):
        for c in self.collectors:
            c[1].append(data)


def _tokens(html: str) -> list[tuple[str, str, str, str]] | None:
    """(text, closing tag, opening tag, attributes) of a page of plain markup, the text after its last tag with no tag; or
    null. A token has one angle bracket, so that nothing was skipped if all brackets are in tokens."""
    found = _TAG.findall(html)
    if len(found) != html.count("<") or not {t.lower() for x in found for t in x[2:4] if t} <= _PLAIN_TAGS:
        return None
    rest = html[sum(len(x[0]) for x in found) :]
    return [x[1:] for x in found] + [(rest, "", "", "")]


def _url(base: str | None, href: str) -> str | None:
    try:
        return urljoin(base or "", href)
    except ValueError:  # no address; only a row that takes the link is in error
        return None


def parse_page(html: str | None, base: str | None = None) -> dict:
    """Tables, definition lists and forms of a page; links also joined to ``base``."""
    p = _Page()
    if html:
        tokens = _tokens(html)
        if tokens is None:
            p.feed(html)
            p.close()
        else:
            for text, closing, opening, attributes in tokens:
                if text:
                    p.handle_data(unescape(text) if "&" in text else text)
                if closing:
                    p.handle_endtag(closing.lower())
                elif opening:
                    p.handle_starttag(opening.lower(), [(m[1].lower(), m[m.lastindex] if m.lastindex > 1 else None) for m in _ATTRIBUTES.finditer(attributes)] if attributes else [])
        p._end_row()
    for t in p.tables:
        for r in t["rows"]:
            urls = {h: _url(base, h) for h in r["hrefs"]}
            r["urls"] = [urls[h] for h in r["hrefs"]]
            r["cell_urls"] = [[urls[h] for h in hs] for hs in r["cell_hrefs"]]
    return {
        "tables": [{"id": t["id"], "rows": t["rows"]} for t in p.tables],
        "lists": [{"label": k, "value": v} for k, v in p.lists],
        "forms": [{"action": f["action"], "method": f["method"], "controls": [{"name": k, "value": v} for k, v in dict(f["controls"]).items()], "choices": [{"name": n, "label": x, "value": v} for n, x, v in f["choices"]]} for f in p.forms],
    }


def _pages(html: pa.Array, base: pa.Array) -> pa.Array:
    return pa.array([parse_page(x, b) for x, b in zip(html.to_pylist(), base.to_pylist(), strict=True)], _PAGE)


def parsed(html: Column, base: Column | None = None) -> Column:
    """Struct of a page's tables, definition list entries and forms; empty arrays for null. ``base`` is the page's address,
    to which links are joined in the same pass."""
    return F.arrow_udf(_pages, PAGE)(html, F.lit(None).cast("string") if base is None else base)


def _address(url: Column, href: Column) -> Column:
    """The joined link; one that is no address is an error."""
    return F.when(href.isNotNull() & url.isNull(), F.raise_error(F.concat(F.lit("no address: "), href))).otherwise(url)


def _join(base: pd.Series, href: pd.Series) -> pd.Series:
    return pd.Series([None if h is None else urljoin(b or "", h) for b, h in zip(base, href, strict=True)])


def url_join(base: Column, href: Column) -> Column:
    return F.pandas_udf(_join, "string")(base, href)


def metadata(page: Column) -> Column:
    """Definition list of a page as a map; the last of a repeated label counts."""
    entries = F.transform(page["lists"], lambda e: F.struct(e["label"], e["value"]))
    last = F.filter(entries, lambda e, i: ~F.exists(F.slice(entries, i + 2, F.size(entries)), lambda later: later["label"] == e["label"]))
    return F.map_from_entries(last)


def header_key(header: Column) -> Column:
    """Column of a search result that a table header names, or null; the first test that holds counts."""
    h = F.replace(F.lower(header), F.lit("/"), F.lit(" "))
    number = h.contains("accident id") | h.contains("accident number") | h.contains("ntsb number")
    return (
        F.when(h.contains("description"), "accident_description")
        .when(number, "ntsb_number")
        .when(h.contains("date"), "event_date")
        .when(h == "city", "city")
        .when(h.contains("state") | h.contains("region"), "state_or_region")
        .when(h.contains("docket") & h.contains("detail"), "docket_details")
    )


def search_results(pages: DataFrame) -> DataFrame:
    """``pages``: public_url, html. Rows of the table "resultTable" that link to a project from their id column."""
    p = pages.select(parsed(F.col("html"), F.col("public_url")).alias("p"))
    rows = F.get(F.filter("p.tables", lambda t: t["id"] == "resultTable"), 0)["rows"]
    first = F.get(rows, F.lit(0))
    keys = F.transform(F.when(F.size(first["heads"]) > 0, first["heads"]).otherwise(first["cells"]), header_key)
    names = ("ntsb_number", "event_date", "city", "state_or_region", "docket_details", "accident_description")

    def of_row(places: Column, r: Column) -> Column:
        # A column that the header does not have has place -1.
        cell = lambda k: F.when(places[k] >= 0, blank_to_null(F.get(r["cells"], places[k])))
        link = lambda c: F.when(places["ntsb_number"] >= 0, F.get(F.get(r[c], places["ntsb_number"]), F.lit(0)))
        return F.struct(*[cell(k).alias(k) for k in names], link("cell_hrefs").alias("href"), link("cell_urls").alias("url"))

    # Rows are cut to what they need before they part: beside each row the page's whole table would go along, which is
    # quadratic in the rows of a page. The explode is outer, as an inner one filters on the array and computes it twice.
    places = lambda ks: F.struct(*[(F.array_position(ks, F.lit(k)) - 1).cast("int").alias(k) for k in names])
    body = F.slice(rows, 2, F.greatest(F.size(rows) - 1, F.lit(0)))
    cut = let(let(keys, places), lambda at: F.transform(body, lambda r: of_row(at, r)))
    r = p.select(F.explode_outer(cut).alias("r")).select("r.*").where("href is not null and ntsb_number is not null")
    r = r.select(*names, _address(F.col("url"), F.col("href")).alias("result_url"))
    return r.withColumn("project_id", query_parameter(F.col("result_url"), "ProjectID")).where("project_id is not null")


def docket_items(pages: DataFrame) -> DataFrame:
    """``pages``: ntsb_number, public_url, html. Candidate items of each docket page, with their row number.

    The table is the first whose first row speaks of a title and which has a link, else the first of the page. A row
    needs a title (second cell, else first) and a link; a photo title needs a PDF link. Six cells or more hold counts
    and type in cells 3 to 5; with fewer they are read from the row's text."""
    p = pages.select("ntsb_number", parsed(F.col("html"), F.col("public_url")).alias("p"))
    titled = F.filter("p.tables", lambda t: (F.size(t["rows"]) > 0) & F.lower(F.array_join(F.concat(F.get(t["rows"], F.lit(0))["heads"], F.get(t["rows"], F.lit(0))["cells"]), " ")).contains("title") & F.exists(F.slice(t["rows"], 2, 1_000_000), lambda r: F.size(r["hrefs"]) > 0))
    rows = F.coalesce(F.get(titled, F.lit(0)), F.get("p.tables", F.lit(0)))["rows"]
    # Outer, as an inner explode filters on the array first, which computes it twice.
    r = p.select("ntsb_number", F.posexplode_outer(rows).alias("i", "r")).where(F.size("r.cells") > 0)
    cells, links = F.col("r.cells"), F.col("r.hrefs")
    cell = lambda k: F.get(cells, F.lit(k))
    number = lambda c: F.when(c.rlike(r"^\d+$"), F.try_to_number(c, F.lit("9999999999")).cast("int"))
    pdf = F.get(F.filter(links, is_pdf_href), F.lit(0))
    wide = F.size(cells) >= 6
    out = r.select(
        "ntsb_number",
        (F.col("i") + 1).alias("row_index"),
        number(cell(0)).alias("ordinal"),
        F.coalesce(cell(1), cell(0)).alias("title"),
        F.when(wide, number(cell(2))).otherwise(count_before(F.col("r.text"), "page")).alias("page_count"),
        F.when(wide, number(cell(3))).otherwise(count_before(F.col("r.text"), "photo")).alias("photo_count"),
        F.when(wide, blank_to_null(cell(4))).otherwise(blank_to_null(cell(2))).alias("display_type"),
        F.coalesce(pdf, F.get(links, F.lit(0))).alias("href"),
        pdf.alias("pdf"),
        F.col("r.hrefs").alias("hrefs"),
        F.col("r.urls").alias("urls"),
    )
    out = out.where((F.col("title") != "") & F.col("href").isNotNull() & ~(F.lower("title").contains("photo") & F.col("pdf").isNull()))
    url = _address(F.get("urls", F.array_position("hrefs", F.col("href")).cast("int") - 1), F.col("href"))
    # The page's texts are in normal form, so the slug needs no second pass of Python.
    return out.withColumn("view_url", url).withColumns({"download_url": F.col("view_url"), "normalized_title_slug": slugify(F.col("title"), unicode=False)}).drop("href", "pdf", "hrefs", "urls")


def dockets(pages: DataFrame, items: DataFrame) -> DataFrame:
    """One row per docket page with its dates and the number of parsed items (counted whether ordinals are stable or
    not). A page without a table counts as unstable, so that an error page cannot empty a docket."""
    p = pages.select("ntsb_number", "public_url", parsed(F.col("html")).alias("p")).select("ntsb_number", "public_url", metadata(F.col("p")).alias("m"), (F.size("p.tables") > 0).alias("has_table"))
    n = items.groupBy("ntsb_number").agg(F.count("*").cast("int").alias("n"))
    value = lambda k: blank_to_null(F.try_element_at("m", F.lit(k)))
    return p.join(n, "ntsb_number", "left").select("ntsb_number", "public_url", F.coalesce("n", F.lit(0)).alias("item_count"), value("created").alias("creation_date"), value("last modified").alias("last_modified"), value("public release").alias("public_release_at"), "has_table")


def search_form(html: str, public_url: str, choice: str = "pipeline") -> dict:
    """The form that offers ``choice``: url, method and the fields to send, with that option taken."""
    for form in parse_page(html)["forms"]:
        for c in form["choices"]:
            if c["name"] and c["label"].lower() == choice:
                fields = {x["name"]: x["value"] for x in form["controls"]} | {c["name"]: c["value"]}
                return {"url": urljoin(public_url, form["action"] or public_url), "method": form["method"], "fields": fields}
    raise ValueError(f"no form offers {choice!r}")
