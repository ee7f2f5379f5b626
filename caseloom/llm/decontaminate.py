"""Benchmark decontamination with one Aho-Corasick automaton.

Test questions and answers are normalised to words (ASCII letters lower-cased; words are runs of digits,
letters and non-ASCII characters), cut into windows, and all windows go into one automaton. A document is
normalised once and scanned once; matches come back as word ranges and, through the offsets of the words,
as character ranges of the original text.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import materialize, ship_package, small_batches, unused

WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
RESULT = "n_words long, n_hit long, n_items long, items array<string>, spans array<struct<start:int,end:int>>"
FOUND = "starts array<int>, ends array<int>, items array<string>"


def words_of(text: str | None) -> list[bytes]:
    """Normalised words of a text; null has none."""
    return WORD.findall(text.encode("utf-8", "replace").lower()) if text else []


def item_windows(text: str | None, size: int) -> set[bytes]:
    """Windows of ``size`` consecutive words; an item of fewer words (but not none) is one window."""
    words = words_of(text)
    if not words:
        return set()
    return {b" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))}


def window_blocks(items: DataFrame, id_col: str, text_col: str, size: int, max_bytes: int):
    """Yield dicts window -> item ids, each at most about ``max_bytes`` of window text.

    Items stream to the driver; a benchmark set over the limit is scanned in several blocks, one after the other, each
    against all documents, so what is broadcast and the automaton made of it stay bounded. Rows with a null id or no words have no window.
    """
    block: dict[bytes, list[str]] = {}
    used = 0
    for row in items.select(F.col(id_col).cast("string").alias("i"), F.col(text_col).alias("t")).where("i is not null").toLocalIterator():
        for window in item_windows(row.t, size):
            owners = block.setdefault(window, [])
            if row.i not in owners:
                owners.append(row.i)
            used += len(window) + len(row.i)
        if used >= max_bytes:
            yield block
            block, used = {}, 0
    yield block


class Scanner:
    """The automaton over one block of windows."""

    def __init__(self, windows: dict[bytes, list[str]]):
        import ahocorasick

        self.automaton = ahocorasick.Automaton()
        self.size = len(windows)
        # Latin-1 turns each byte into one character: the automaton then walks UTF-8 bytes.
        for key, owners in windows.items():
            self.automaton.add_word(" " + key.decode("latin-1") + " ", (key.count(b" ") + 1, tuple(owners)))
        if windows:
            self.automaton.make_automaton()

    def scan(self, words: list[bytes]) -> tuple[list[tuple[int, int]], set[str]]:
        """Merged word ranges [start, end) inside any window, and the items whose windows occur."""
        if not self.size or not words:
            return [], set()
        line = " " + b" ".join(words).decode("latin-1") + " "
        found = list(self.automaton.iter(line))
        if not found:
            return [], set()
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)  # position of the space after each word
        last = np.searchsorted(ends, [e for e, _ in found])
        ranges = _merged([(int(e) - n + 1, int(e) + 1) for e, (_, (n, _)) in zip(last, found, strict=True)])
        return ranges, {i for _, (_, owners) in found for i in owners}


_HELD: list = []  # the last broadcast of this Python worker and its automaton


def _scanner(broadcast) -> Scanner:
    """One automaton per Python worker and broadcast, however many tasks the worker runs."""
    if not _HELD or _HELD[0] is not broadcast:
        _HELD[:] = [broadcast, Scanner(broadcast.value)]
    return _HELD[1]


def _char_spans(text: str, ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Word ranges as character offsets of the original text."""
    offsets = [m.span() for m in re.finditer(r"[0-9A-Za-z\u0080-\U0010ffff]+", text)]
    return [(offsets[a][0], offsets[b - 1][1]) for a, b in ranges]


def _merged(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], b))
        else:
            out.append((a, b))
    return out


def _scan(share, first: bool, last: bool):
    """A pass over texts with the automaton of one block: word ranges and items found so far, or after the last block
    the result. All but the first pass get what the earlier ones found."""

    def scan(batches):
        scanner = _scanner(share)
        for batch in batches:
            texts, before = (batch, repeat(None)) if first else (batch[0], zip(batch[1]["starts"], batch[1]["ends"], batch[1]["items"], strict=True))
            out = []
            for text, earlier in zip(texts, before):
                words = words_of(text)
                ranges, owners = scanner.scan(words)
                if earlier is not None:
                    ranges = _merged([*ranges, *zip(*(x.tolist() for x in earlier[:2]), strict=True)])
                    owners = owners.union(earlier[2].tolist())
                if last:
                    spans = [{"start": a, "end": b} for a, b in _char_spans(text, ranges)] if ranges else []
                    out.append((len(words), sum(b - a for a, b in ranges), len(owners), sorted(owners), spans))
                else:
                    out.append(([a for a, _ in ranges], [b for _, b in ranges], sorted(owners)))
            yield pd.DataFrame(out, columns=["n_words", "n_hit", "n_items", "items", "spans"] if last else ["starts", "ends", "items"])

    scan.__annotations__ = {"batches": Iterator[pd.Series] if first else Iterator[tuple[pd.Series, pd.DataFrame]], "return": Iterator[pd.DataFrame]}
    return scan


def benchmark_hits(docs: DataFrame, items: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text", window: int = 10, max_block_bytes: int = 8 << 20, into: str = "hits") -> DataFrame:
    """Add struct column ``into`` to every row of ``docs``: word count, words hit, items, original spans.

    All input columns stay, the order of rows and repeated rows too; a column ``into`` is replaced. Null or wordless
    texts give zero words and no hit; a null, wordless or id-less item has no window; an empty benchmark hits nothing.
    No shuffle. One automaton holds the windows of up to ``max_block_bytes`` of window text (about fifty times that in
    memory). A larger benchmark takes one pass over the documents for each such block: a pass writes the rows with what
    was found so far, so a worker never holds two automata.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    blocks = window_blocks(items, item_id, item_text, window, max_block_bytes)
    so_far, now, block, first = unused(docs, "__found"), docs, next(blocks), True
    while True:
        following = next(blocks, None)
        share = spark.sparkContext.broadcast(block)
        hits = F.pandas_udf(_scan(share, first, following is None), FOUND if following else RESULT)
        hits = hits(F.col(text_col)) if first else hits(F.col(text_col), F.col(so_far))
        if following is None:
            rest = [F.col(f"`{c}`") for c in docs.columns if c.lower() != into.lower()]
            return now.select(*rest, hits.alias(into))
        now = materialize(now.withColumn(so_far, hits), "hits")
        share.destroy()
        block, first = following, False


def op9_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: per document word count, words hit, items, their digest, and the verdict."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    h = F.col("hits")
    return benchmark_hits(docs, items).select("doc_id", h.n_words.alias("n_words"), h.n_hit.alias("n_hit"), h.n_items.alias("n_items"), F.sha2(F.array_join(F.array_sort(h["items"]), ","), 256).alias("items_sha256"), (h.n_hit > 0).alias("contaminated"))


#: DuckDB for op9: windows of ten words as strings, joined by equality. Lengths are counted in words.
OP9_SQL = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') AS w FROM documents),
b AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all(regexp_replace(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+', ' ', 'g'), '[^ ]+') AS w FROM benchmark),
bw AS (
  SELECT DISTINCT item, least(len(w), 10) AS n, array_to_string(w[i:i + 9], ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT doc_id, item, dw.n, i FROM dw JOIN bw ON dw.n = bw.n AND dw.win = bw.win),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM m) GROUP BY doc_id),
its AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS s FROM (SELECT DISTINCT doc_id, item FROM m) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(s, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN its USING (doc_id)
"""
