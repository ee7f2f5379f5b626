"""Substring dedup over word sequences by difference-cover anchors.

A difference cover D of period v has, for any two positions i and j, a shift below v that brings both to positions in
D modulo v. So only windows that start at cover positions are hashed, five in twenty-one words; two equal runs of
LENGTH words at any two places share an aligned anchor: an anchor window of LENGTH - v + 1 words that lies at the same
shift in both. Anchors that occur twice are then extended: every run of LENGTH words around such an anchor is compared
by a 96-bit hash of the whole run, so what is removed does not rest on the anchor alone. Pairs of equal anchors are not
walked word by word: an anchor that n texts share has n^2 of them, while its runs are n.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import discard, integer_id, joined_id, materialize, release_shuffles, ship_package, small_batches, split_id

LENGTH = 35
#: A perfect difference set: each non-zero difference modulo 21 occurs once.
PERIOD, COVER = 21, (3, 6, 7, 12, 14)
B1, B2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def word_hashes(text: str | None) -> tuple[list[bytes], np.ndarray]:
    """Words (runs of bytes other than space and tab to carriage return) and their 64-bit hashes; null has none."""
    from xxhash import xxh3_64_intdigest

    words = text.encode("utf-8", "replace").split() if text else []
    return words, np.fromiter(map(xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def run_hashes(h: np.ndarray, size: int, base: np.uint64) -> np.ndarray:
    """Hash of every run of ``size`` hashes, by doubling: a run of 2k is two runs of k, so log2(size) passes."""
    if len(h) < size:
        return np.zeros(0, np.uint64)
    total, at, power, width, rest = None, 0, h, 1, size
    factor = base
    while True:
        if rest & 1:
            part = power[at : at + len(h) - size + 1]
            total = part if total is None else mixed(total * base + part)
            at += width
        rest >>= 1
        if not rest:
            return mixed(total + np.uint64(size))
        power = mixed(power[:-width] * factor + power[width:] + np.uint64(width))
        width *= 2


def anchors_of(texts: list[str | None], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, word position, anchor hash) of every anchor of a batch."""
    size = length - PERIOD + 1
    who, where, what = [], [], []
    for i, text in enumerate(texts):
        _, h = word_hashes(text)
        if len(h) < length:
            continue
        runs = run_hashes(h, size, B1)
        at = np.arange(len(runs))
        at = at[np.isin(at % PERIOD, COVER)]
        who.append(np.full(len(at), i))
        where.append(at)
        what.append(runs[at])
    cat = lambda x, kind: np.concatenate(x).astype(kind) if x else np.zeros(0, kind)
    return cat(who, np.int64), cat(where, np.int32), cat(what, np.uint64)


def candidate_starts(n_words: int, anchors: np.ndarray, length: int = LENGTH) -> np.ndarray:
    """Starts of runs of ``length`` words in which an anchor at one of ``anchors`` lies whole."""
    reach = PERIOD  # an anchor of length - PERIOD + 1 words fits at shifts 0 to PERIOD - 1
    if n_words < length or not len(anchors):
        return np.zeros(0, np.int64)
    mark = np.zeros(n_words + 1, np.int32)
    np.add.at(mark, np.maximum(0, anchors - reach + 1), 1)
    np.add.at(mark, anchors + 1, -1)
    return np.flatnonzero(np.cumsum(mark)[: n_words - length + 1] > 0)


def keep_words(words: list[bytes], starts: np.ndarray, length: int = LENGTH) -> tuple[int, bytes]:
    """Words covered by runs at ``starts``: how many, and the rest joined by one space."""
    mark = np.zeros(len(words) + 1, np.int32)
    np.add.at(mark, starts, 1)
    np.add.at(mark, np.minimum(starts + length, len(words)), -1)
    gone = np.cumsum(mark)[: len(words)] > 0
    return int(gone.sum()), b" ".join([w for w, g in zip(words, gone.tolist(), strict=True) if not g])


def removals(docs: DataFrame, length: int = LENGTH) -> DataFrame:
    """``docs`` (row_id, text): per row with a repeated run, row_id and the sorted starts of its repeated runs.

    1. Anchors of all rows, counted by hash with map-side sums; only hashes seen twice stay.
    2. The same anchors, joined with those hashes (Spark splits a skewed hash), grouped by row.
    3. Rows with such anchors hash the runs around them; runs are counted the same way; those seen twice come back.
    A hash that a third of all rows share is never in one task: sums are combined before they move, and the joins
    have one row per hash on one side. That side is a written table and the join an inner one: with an aggregate under
    it, which a semi join brings too, Spark could not split a skewed hash.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)

    def emit(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            who, where, what = anchors_of(batch["text"].tolist(), length)
            yield pd.DataFrame({"row_id": batch["row_id"].to_numpy()[who], "at": where, "h": what.view(np.int64)})

    def repeated(rows: DataFrame, keys: list[str]) -> DataFrame:
        return rows.groupBy(*keys).count().where("count > 1").drop("count")

    anchors = docs.select("row_id", "text").mapInPandas(emit, "row_id long, at int, h long")
    twice = materialize(repeated(anchors.select("h"), ["h"]), "anchors-twice")
    release_shuffles(spark)
    found = anchors.join(twice, "h").groupBy("row_id").agg(F.collect_list("at").alias("anchors"))
    found = materialize(found, "anchored-rows")
    discard(twice)
    release_shuffles(spark)

    def runs(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out, size = [], 0
            for row_id, text, anchors_ in zip(batch["row_id"], batch["text"], batch["anchors"], strict=True):
                _, h = word_hashes(text)
                starts = candidate_starts(len(h), np.asarray(anchors_, np.int64), length)
                one, two = run_hashes(h, length, B1), run_hashes(h, length, B2) >> np.uint64(32)
                for a in range(0, len(starts), 1 << 16):
                    s = starts[a : a + (1 << 16)]
                    out.append((np.full(len(s), row_id), s.astype(np.int32), one[s].view(np.int64), two[s].astype(np.uint32).view(np.int32)))
                    size += len(s)
                    if size >= 1 << 16:
                        yield frame(out)
                        out, size = [], 0
            if out:
                yield frame(out)

    def frame(parts: list) -> pd.DataFrame:
        return pd.DataFrame(dict(zip(("row_id", "at", "h1", "h2"), map(np.concatenate, zip(*parts, strict=True)), strict=True)))

    candidates = docs.select("row_id", "text").join(found, "row_id").mapInPandas(runs, "row_id long, at int, h1 long, h2 int")
    candidates = materialize(candidates, "runs")
    discard(found)
    release_shuffles(spark)
    again = materialize(repeated(candidates, ["h1", "h2"]), "runs-twice")
    release_shuffles(spark)
    starts = candidates.join(again, ["h1", "h2"]).groupBy("row_id").agg(F.sort_array(F.collect_list("at")).alias("starts"))
    starts = materialize(starts, "repeated-runs")
    discard(candidates)
    discard(again)
    release_shuffles(spark)
    return starts


def dedup_words(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per input row: doc_id, n_words, n_removed, kept (the words left, joined by one space).

    A word goes when a run of ``length`` words over it also starts anywhere else, in the same text too; runs are
    judged on the input. Null and empty texts have no words. Rows with the same id are different places. Ids are whole
    numbers or null. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    rows, key = numbered(docs.select(integer_id(docs, id_col).alias("doc_id"), F.col(text_col).alias("text")))
    rows = rows.withColumn("row_id", key)
    # Equal texts repeat every run they have: each goes whole. One stands for them where others' runs are looked up.
    keys = materialize(rows.select("row_id", F.sha2("text", 256).alias("digest")).where("digest is not null"), "digests")
    groups = materialize(keys.groupBy("digest").agg(F.count("*").alias("n"), F.min("row_id").alias("first")).where("n > 1"), "groups")
    copies = materialize(keys.join(groups, "digest").select("row_id", (F.col("row_id") == F.col("first")).alias("first")), "copies")
    discard(keys)
    discard(groups)
    release_shuffles(spark)
    starts = removals(rows.join(copies.where("not first"), "row_id", "left_anti").select("row_id", "text"), length)
    known = starts.join(copies.select("row_id", F.lit(True).alias("whole")), "row_id", "full")

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, at, whole in zip(batch["text"], batch["starts"], batch["whole"], strict=True):
                words = text.encode("utf-8", "replace").split() if text else []
                if whole is True and len(words) >= length:
                    n, kept = len(words), b""
                else:
                    n, kept = (0, b" ".join(words)) if at is None else keep_words(words, np.asarray(at, np.int64), length)
                out.append((len(words), n, kept.decode("utf-8", "replace")))
            yield pd.concat([pd.DataFrame({"doc_id": joined_id(batch["doc_id"], batch["no_id"])}), pd.DataFrame(out, columns=["n_words", "n_removed", "kept"])], axis=1)

    return rows.join(known, "row_id", "left").select(*split_id("doc_id"), "text", "starts", "whole").mapInPandas(finish, "doc_id long, n_words long, n_removed long, kept string")


def numbered(rows: DataFrame):
    """(rows, key): a row number that a re-read gives again. The id itself where ids are unique and none is null;
    else rows are written once with a number each."""
    ids = rows.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    if ids.isEmpty():
        return rows, F.col("doc_id")
    fixed = materialize(rows.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    return fixed, F.col("__row")


def op10_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: what run dedup leaves of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_words(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


#: DuckDB for op10: every run of 35 words as a string, counted.
OP10_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
r AS (SELECT doc_id, i, array_to_string(w[i:i + 34], ' ') AS run
      FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS i FROM d WHERE len(w) >= 35)),
t AS (SELECT run FROM r GROUP BY run HAVING count(*) > 1),
gone AS (SELECT doc_id, list_distinct(flatten(list(range(i, i + 35)))) AS p FROM r JOIN t USING (run) GROUP BY doc_id),
k AS (SELECT d.doc_id, w, coalesce(p, []) AS p FROM d LEFT JOIN gone USING (doc_id)),
words AS (SELECT doc_id, i, w[i] AS x, p FROM (SELECT doc_id, w, p, unnest(range(1, len(w) + 1)) AS i FROM k)),
kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY i) AS s FROM (SELECT w.doc_id, w.i, w.x FROM words w ANTI JOIN (SELECT doc_id, unnest(p) AS i FROM k) g ON w.doc_id = g.doc_id AND w.i = g.i) GROUP BY doc_id)
SELECT k.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(p) AS BIGINT) AS n_removed, sha256(coalesce(s, '')) AS kept_sha256
FROM k LEFT JOIN kept USING (doc_id)
"""
