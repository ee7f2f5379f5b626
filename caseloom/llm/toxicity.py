"""Toxicity by subword-bag embeddings under a linear softmax.

A word is the mean of the vectors of its character n-grams (hashed to buckets) and of itself; a text is the mean of
its words; a linear softmax reads the text vector. Vectors and softmax are trained together in numpy, so a misspelling
never seen in training still shares most n-gram vectors with the word it comes from.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import bounded_sample, ship_package, small_batches, table, unsigned_bucket

WORD = re.compile(r"[^\W_]+")
LENGTHS = (3, 4, 5)
BUCKETS = 1 << 17


def subword_buckets(words: list[str], buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Bucket ids of all words' n-grams and whole forms, word by word, and where each word's ids start."""
    marked = [f"<{w}>" for w in words]
    sizes = np.fromiter(map(len, marked), np.int64, len(marked))
    chars = np.frombuffer("".join(marked).encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    ends = np.repeat(np.cumsum(sizes), sizes)
    owner = np.repeat(np.arange(len(words)), sizes)
    prime, at = np.uint64(0x100000001B3), np.arange(len(chars))
    rolling, ids, owners = chars.copy(), [], []
    for n in range(2, max(LENGTHS) + 1):
        rolling = rolling[: len(chars) - n + 1] * prime + chars[n - 1 :] + np.uint64(1)
        if n in LENGTHS:
            fits = at[: len(rolling)] + n <= ends[: len(rolling)]
            ids.append(rolling[fits] + np.uint64(n))
            owners.append(owner[: len(rolling)][fits])
    # Whole form: hash of all characters at their places in the word.
    place = at - np.repeat(np.cumsum(sizes) - sizes, sizes)
    mixed = (chars + np.uint64(1)) * (np.uint64(2) * place.astype(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    mixed ^= mixed >> np.uint64(31)
    mixed *= np.uint64(0xBF58476D1CE4E5B9)
    starts = np.cumsum(sizes) - sizes
    ids.append(np.add.reduceat(mixed, starts) if len(words) else mixed)
    owners.append(np.arange(len(words)))
    flat, own = np.concatenate(ids), np.concatenate(owners)
    flat ^= flat >> np.uint64(29)
    flat *= np.uint64(0x94D049BB133111EB)
    flat ^= flat >> np.uint64(32)
    order = np.argsort(own, kind="stable")
    counts = np.bincount(own, minlength=len(words))
    return (flat[order] % np.uint64(buckets)).astype(np.int64), np.cumsum(counts) - counts


class Model:
    """What scoring needs of the trained network: as it is linear, each bucket's share of the logit, and the bias."""

    def __init__(self, weights: np.ndarray, bias: float):
        self.weights, self.bias = weights, bias

    def word_scores(self, words: list[str]) -> np.ndarray:
        if not words:
            return np.zeros(0)
        ids, starts = subword_buckets(words, len(self.weights))
        sizes = np.diff(np.r_[starts, len(ids)])
        return np.add.reduceat(self.weights[ids].astype(np.float64), starts) / sizes


def bag(text: str, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """(bucket ids, shares): what each bucket adds to the text's mean; at most ``buckets`` pairs, however long the text."""
    words = WORD.findall(text.lower())
    forms = Counter(words)
    names, total = list(forms), np.zeros(buckets)
    for at in range(0, len(names), 20_000):  # hashing needs many times the space of its result
        part = names[at : at + 20_000]
        grams, start = subword_buckets(part, buckets)
        size = np.diff(np.r_[start, len(grams)])
        share = np.fromiter((forms[w] for w in part), np.float64, len(part)) / (size * len(words))
        total += np.bincount(grams, weights=np.repeat(share, size), minlength=buckets)
    found = np.flatnonzero(total)
    return found.astype(np.int32), total[found].astype(np.float32)


def fit(bags: list[tuple[np.ndarray, np.ndarray]], labels: list[int], dim: int = 8, buckets: int = BUCKETS, epochs: int = 20, batch: int = 64, rate: float = 0.01, decay: float = 0.5, half: float = 6.0, power: float = 16.0, seed: int = 1) -> Model:
    """Adam on embeddings and softmax together, in mini-batches; the epoch that does best on a tenth kept back counts.

    A text is mostly words that say nothing, and a few thousand labelled texts cannot show that for every bucket. So
    inputs are standardised and weighted by how surely a bucket's presence differs between the labels: 1 / (1 +
    (``half`` / z) ^ ``power``) for a difference of z standard errors (both fold into the weights). The weight is never
    cut off: every bucket of every training text is trained. Without both labels every text gets the (smoothed) share of label 1.
    """
    y = np.array(labels, int)
    n, ones = len(y), int(y.sum())
    share = (ones + 1) / (n + 2)
    if not 0 < ones < n:
        return Model(np.zeros(buckets, np.float32), float(np.log(share / (1 - share))))
    col = np.concatenate([found for found, _ in bags])
    val = np.concatenate([value for _, value in bags])
    lengths = np.fromiter((len(found) for found, _ in bags), np.int64, n)
    first = np.r_[0, np.cumsum(lengths)]
    docs = np.bincount(col, minlength=buckets).astype(float)
    docs_1 = np.bincount(col, weights=np.repeat(y, lengths), minlength=buckets)
    common = docs / n
    z = (docs_1 / ones - (docs - docs_1) / (n - ones)) / np.sqrt(np.maximum(common * (1 - common), 1e-12) * (1 / ones + 1 / (n - ones)))
    alive = np.flatnonzero(docs)
    place = np.full(buckets, -1, np.int32)
    place[alive] = np.arange(len(alive))
    col = place[col]
    mean = np.bincount(col, weights=val, minlength=len(alive)) / n
    spread = np.sqrt(np.maximum(np.bincount(col, weights=val * val, minlength=len(alive)) / n - mean**2, 1e-12))
    scale = 1 / (1 + (half / np.maximum(np.abs(z[alive]), 1e-6)) ** power) / spread
    val, mean = (val * scale[col]).astype(np.float32), (mean * scale).astype(np.float32)

    rng = np.random.default_rng(seed)
    net = {"e": (rng.standard_normal((len(alive), dim)) * 0.01).astype(np.float32), "w": (rng.standard_normal((dim, 2)) * 0.3).astype(np.float32), "b": np.log(np.array([1 - share, share], np.float32))}
    moments = {k: (np.zeros_like(v), np.zeros_like(v)) for k, v in net.items()}
    order = rng.permutation(n)
    kept_back, training = order[: n // 10], order[n // 10 :]

    def forward(which: np.ndarray):
        k = first[which + 1] - first[which]
        off = np.cumsum(k) - k
        at = np.repeat(first[which] - off, k) + np.arange(k.sum())
        c, v = col[at], val[at]
        rows = np.concatenate((net["e"][c] * v[:, None], np.zeros((1, dim), np.float32)))
        text = np.add.reduceat(rows, off, axis=0)
        text[k == 0] = 0
        text -= mean @ net["e"]
        logits = text @ net["w"] + net["b"]
        p = np.exp(logits - logits.max(axis=1, keepdims=True))
        return c, v, k, text, p / p.sum(axis=1, keepdims=True)

    step, best, best_net = 0, np.inf, net
    for _ in range(epochs):
        for which in np.array_split(rng.permutation(training), max(1, len(training) // batch)):
            c, v, k, text, p = forward(which)
            p[np.arange(len(which)), y[which]] -= 1
            p /= len(which)
            to_text = (p @ net["w"].T).astype(np.float32)
            to_rows = np.repeat(to_text, k, axis=0) * v[:, None]
            grad_e = np.stack([np.bincount(c, weights=to_rows[:, j], minlength=len(alive)) for j in range(dim)], axis=1) - np.outer(mean, to_text.sum(axis=0))
            step += 1
            for name, g in (("e", grad_e), ("w", text.T @ p), ("b", p.sum(axis=0))):
                m, s = moments[name]
                m += 0.1 * (g.astype(np.float32) - m)
                s += 0.001 * (g.astype(np.float32) ** 2 - s)
                if name == "e":
                    net[name] *= 1 - rate * decay
                net[name] -= (rate * (m / (1 - 0.9**step)) / (np.sqrt(s / (1 - 0.999**step)) + 1e-8)).astype(np.float32)
        if len(kept_back):
            p = forward(kept_back)[4]
            loss = float(-np.log(p[np.arange(len(kept_back)), y[kept_back]] + 1e-9).mean())
        else:
            loss = -step
        if loss < best:
            best, best_net = loss, {k: x.copy() for k, x in net.items()}
    logit = best_net["e"] @ (best_net["w"][:, 1] - best_net["w"][:, 0])
    weights = np.zeros(buckets, np.float32)
    weights[alive] = logit * scale
    return Model(weights, float(best_net["b"][1] - best_net["b"][0] - mean @ logit))


class Scorer:
    """Word scores kept in a bounded memory; a text's logit is their mean plus the bias."""

    def __init__(self, model: Model, room: int = 400_000):
        self.model, self.room, self.known = model, room, {}

    def scores(self, texts: list[str | None]) -> list[float]:
        out, later, get = [0.0] * len(texts), [], self.known.get
        for i, t in enumerate(texts):
            words = WORD.findall(t.lower()) if t else []
            found = list(map(get, words))
            if None in found:
                later.append((i, words, found))
            else:
                out[i] = sum(found) / len(found) if found else 0.0
        new = list({w for _, words, found in later for w, x in zip(words, found, strict=True) if x is None})
        fresh: dict[str, float] = {}
        for at in range(0, len(new), 50_000):
            fresh.update(zip(new[at : at + 50_000], self.model.word_scores(new[at : at + 50_000]).tolist(), strict=True))
        for i, words, found in later:
            out[i] = sum(fresh[w] if x is None else x for w, x in zip(words, found, strict=True)) / len(words)
        if len(self.known) + len(fresh) > self.room:
            self.known.clear()
        self.known.update(fresh)
        return [float(1 / (1 + np.exp(-min(700.0, max(-700.0, x + self.model.bias))))) for x in out]


def train(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text_col: str = "text", label_col: str = "toxic", max_docs: int = 3000) -> Model:
    """Fit on about ``max_docs`` whole labelled documents of each label (a documented bound). Ids are drawn from the
    label table alone, so that only the drawn texts are fetched. Texts become bags of buckets where they lie; what comes
    back is bounded by the draw times the number of buckets. Rows with null text or label teach nothing; an id with
    several label rows has the largest label, one with several texts the first in order."""
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    drawn = bounded_sample(labels.where(F.col(key).isNotNull()).groupBy(key).agg(F.max(label_col).alias("__label")), key, "__label", max_docs)
    share = labels.where(F.col(label_col).isNotNull()).agg(F.avg(F.col(label_col).cast("double"))).first()[0]
    ids = drawn.collect()  # about 2 * max_docs pairs of numbers
    spark = docs.sparkSession

    def bagged(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            made = [bag(t, BUCKETS) for t in batch["text"]]
            yield pd.DataFrame({"id": batch["id"], "label": batch["label"], "ids": [a.tobytes() for a, _ in made], "shares": [b.tobytes() for _, b in made]})

    rows = []
    if ids:
        small = spark.createDataFrame([(r[0], int(r[1])) for r in ids], f"`{key}` long, __label int")
        texts = docs.where(F.col(text_col).isNotNull()).select(key, F.col(text_col).alias("__text")).join(F.broadcast(small), key).groupBy(key).agg(F.min("__text").alias("text"), F.min("__label").alias("label"))
        rows = [(r.id, r.label, np.frombuffer(r.ids, np.int32), np.frombuffer(r.shares, np.float32)) for r in texts.select(F.col(key).alias("id"), "text", "label").mapInPandas(bagged, "id long, label int, ids binary, shares binary").toLocalIterator()]
        rows.sort(key=lambda r: r[0])
    model = fit([r[2:] for r in rows], [r[1] for r in rows])
    # The draw takes labels in other shares than the table has them; the bias moves back to the table's.
    seen = (sum(r[1] for r in rows) + 1) / (len(rows) + 2)
    if share and 0 < share < 1 and 0 < seen < 1:
        model.bias += float(np.log(share / (1 - share)) - np.log(seen / (1 - seen)))
    return model


_HELD: list = []


def with_toxicity(docs: DataFrame, model: Model, text_col: str = "text", into: str = "score") -> DataFrame:
    """``docs`` with a score of 0 to 1; null, empty and wordless texts get the bias's. No shuffle."""
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def score(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        if not _HELD or _HELD[0] is not shared:
            _HELD[:] = [shared, Scorer(shared.value)]
        for batch in texts:
            yield pd.Series(_HELD[1].scores(batch.tolist()), dtype="float64")

    return docs.withColumn(into, F.pandas_udf(score, "double")(F.col(text_col)))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: learn from labels outside fold 0 of 5, score everything."""
    fold = F.coalesce(unsigned_bucket(F.col("doc_id"), 5) == 0, F.lit(False))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, table(spark, sf_dir, "labels").where(~fold))
    scored = with_toxicity(docs, model)
    return scored.select("doc_id", fold.alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
