"""Language identification by word-first backoff.

A word seen in training scores each language by its log frequency there. An unseen word falls back to its characters:
from each place the longest n-gram seen in training is scored, down to single characters. A document's languages are
compared by the sums over its words.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import bounded_sample, ship_package, small_batches, table, unsigned_bucket

WORD = re.compile(r"[^\W\d_]+")
LONGEST = 5
UNKNOWN = "und"


MIX, ADD = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD1B54A32D192ED03)


def gram_hashes(words: list[str]) -> tuple[np.ndarray, list[np.ndarray]]:
    """(ends, hashes): the words, each between marks, laid end to end as code points; ``ends`` is the end of each
    place's word, and ``hashes[n]`` the 64-bit hash of the n characters from each place on, right only where they end
    in the word. A hash depends on the characters alone."""
    marked = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends, hashes, rolling = np.repeat(np.cumsum(sizes), sizes), [np.zeros(0, np.uint64)], np.zeros(len(chars), np.uint64)
    for n in range(1, LONGEST + 1):
        grown = rolling.copy()
        grown[: len(chars) - n + 1] = (rolling[: len(chars) - n + 1] + chars[n - 1 :] + ADD) * MIX
        rolling = grown ^ (grown >> np.uint64(29))
        hashes.append(rolling)
    return ends, hashes


class WordBackoff:
    """Log scores per language of words and n-grams; each row is centred, so only differences count.

    Every word of the training sample is known, and every n-gram of its words: nothing is ranked away. So the model's
    size is bounded by the sample, and a language of few documents keeps its words. ``words``: word -> row; ``grams``:
    per length the sorted hashes of the n-grams, whose rows follow those of the words in this order.
    """

    def __init__(self, counts: dict[str, Counter]):
        self.languages = sorted(counts)
        k = len(self.languages)
        known = sorted(set().union(*counts.values()))
        self.words = {w: i for i, w in enumerate(known)}
        count = np.zeros((len(known), k))
        for j, lang in enumerate(self.languages):
            for w, c in counts[lang].items():
                count[self.words[w], j] = c
        rows = [self._centred(count)]
        ends, hashes = gram_hashes(known)
        owner = np.repeat(np.arange(len(known)), np.fromiter(map(len, known), np.int64, len(known)) + 2)
        self.grams: list[np.ndarray] = [np.zeros(0, np.uint64)]
        for n in range(1, LONGEST + 1):
            at = np.flatnonzero(np.arange(len(ends)) + n <= ends)
            found, which = np.unique(hashes[n][at], return_inverse=True)
            per = np.stack([np.bincount(which, weights=count[owner[at], j], minlength=len(found)) for j in range(k)], axis=1) if k else np.zeros((len(found), 0))
            rows.append(self._centred(per))
            self.grams.append(found)
        self.rows = np.concatenate(rows)
        self.first = np.cumsum([len(x) for x in rows])  # first row of the n-grams of each length, at n - 1

    @staticmethod
    def _centred(count: np.ndarray) -> np.ndarray:
        score = np.log((count + 0.1) / (count.sum(axis=0) + 1.0))
        return (score - score.mean(axis=1, keepdims=True) if score.size else score).astype(np.float32)

    def unseen(self, words: list[str]) -> np.ndarray:
        """A row for each word: from each place the longest known n-gram, then on from the next place."""
        ends, hashes = gram_hashes(words)
        sizes = np.fromiter(map(len, words), np.int64, len(words)) + 2
        total, todo = np.zeros((len(ends), len(self.languages)), np.float32), np.arange(len(ends))
        for n in range(LONGEST, 0, -1):
            if not len(self.grams[n]):
                continue
            fits = todo[todo + n <= ends[todo]]
            h = hashes[n][fits]
            at = np.minimum(np.searchsorted(self.grams[n], h), len(self.grams[n]) - 1)
            hit = self.grams[n][at] == h
            total[fits[hit]] = self.rows[self.first[n - 1] + at[hit]] / LONGEST  # overlapping n-grams tell of the same characters
            done = np.zeros(len(ends), bool)
            done[fits[hit]] = True
            todo = todo[~done[todo]]
        return np.add.reduceat(total, np.cumsum(sizes) - sizes, axis=0) if len(words) else total


class Scorer:
    """Adds up word rows. Rows of unseen words are made for a batch at once and kept in a bounded memory."""

    def __init__(self, model: WordBackoff, room: int = 200_000):
        self.model, self.base, self.room = model, len(model.words), room
        self._reset()

    def _reset(self) -> None:
        self.at, self.parts, self.rows = dict(self.model.words), [], self.model.rows[: self.base]

    def predict(self, texts: list[str | None]) -> list[tuple[str, float]]:
        split = [WORD.findall(t.lower()) if t and self.model.languages else [] for t in texts]
        new = list(set(chain.from_iterable(split)).difference(self.at))
        if len(self.at) + len(new) > self.base + self.room:
            self._reset()
            new = list(set(chain.from_iterable(split)).difference(self.at))
        if new:
            self.at.update(zip(new, range(len(self.rows), len(self.rows) + len(new)), strict=True))
            made = [self.model.unseen(new[a : a + 20_000]) for a in range(0, len(new), 20_000)]
            self.rows = np.concatenate([self.rows, *made])
        out = []
        for t, words in zip(texts, split, strict=True):
            if not t or not self.model.languages or not (words or any(map(str.isalpha, t))):
                out.append((UNKNOWN, 0.0))
                continue
            total = self.rows[np.fromiter(map(self.at.__getitem__, words), np.int64, len(words))].sum(axis=0, dtype=np.float64)
            best = int(total.argmax())
            odds = np.exp(np.maximum(total - total[best], -700))
            out.append((self.model.languages[best], float(1 / odds.sum())))
        return out


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key: str = "doc_id", max_docs: int = 1500) -> WordBackoff:
    """Fit on about ``max_docs`` whole documents of each language (a documented bound; fewer where there are fewer).
    Words are counted by Spark; one row per language and word of the sample comes back, and all of them are kept. Ties:
    languages of equal scores, the first by name wins. Repeated rows and ids count as often as they occur."""
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    sample = bounded_sample(docs.where(F.col(text_col).isNotNull()), key, lang_col, max_docs)

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        found: dict[str, Counter] = defaultdict(Counter)
        for batch in batches:
            for lang, text in zip(batch["lang"], batch["text"], strict=True):
                found[lang].update(WORD.findall(text.lower()))
        yield pd.DataFrame([(lang, w, c) for lang, ws in found.items() for w, c in ws.items()], columns=["lang", "word", "n"])

    counted = sample.select(F.col(lang_col).alias("lang"), F.col(text_col).alias("text")).mapInPandas(count, "lang string, word string, n long").groupBy("lang", "word").agg(F.sum("n").alias("n"))
    counts: dict[str, Counter] = defaultdict(Counter)
    for row in counted.toLocalIterator():
        counts[row.lang][row.word] = row.n
    return WordBackoff(counts)


_HELD: list = []


def with_language(docs: DataFrame, model: WordBackoff, text_col: str = "text", into: str = "language") -> DataFrame:
    """``docs`` with struct ``into`` (lang, score). Null texts and texts without a letter give ``und`` and 0; so does
    every text when nothing was learned. No shuffle; the model's size is bounded by the training sample's."""
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        if not _HELD or _HELD[0] is not shared:
            _HELD[:] = [shared, Scorer(shared.value)]
        for batch in texts:
            yield pd.DataFrame(_HELD[1].predict(batch.tolist()), columns=["lang", "score"])

    return docs.withColumn(into, F.pandas_udf(score, "lang string, score double")(F.col(text_col)))


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: learn outside fold 1 of 3, predict everything."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang").withColumn("held_out", F.coalesce(unsigned_bucket(F.col("doc_id"), 3) == 1, F.lit(False)))
    model = train(docs.where(~F.col("held_out")))
    return with_language(docs.drop("lang"), model).select("doc_id", "held_out", F.col("language.lang").alias("lang_pred"), F.col("language.score").alias("score"))
