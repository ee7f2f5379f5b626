"""Mixing to target weights by soft membership, in DataFrame functions only.

A classifier fitted on a labelled table gives every document a posterior over domains. Least squares then finds a
non-negative rate per document such that the expected tokens of each domain, summed over rates times posteriors, meet
the targets while rates stay near one. The descent is projected gradient: a round sums the gradient over all documents,
moves every rate along it and projects rates below zero to zero. A plain step raises a rare domain by one a round at
most, so the gradient is scaled by the inverse of its second derivative over the rates above zero (a few numbers).

The state of the descent is not stored per document: a document's rate is a fixed expression of its posterior and of
one multiplier per domain. So a step is one aggregate over a table of posteriors, and a lost executor has no state to
lose.
"""

from __future__ import annotations

import warnings
from functools import reduce

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import SPACE_CLASS, bounded_sample, let, materialize, table, unused

BUCKETS = 1 << 13
DOMAINS = ("clean", "low", "toxic")
#: Wanted shares of the tokens by domain; the total stays what it is.
TARGETS = {"clean": 0.97, "low": 0.02, "toxic": 0.01}


def _buckets(text: Column) -> Column:
    """Hashed words of a text: lower case, sentence marks dropped, split at white space. None for null or blank."""
    plain = F.btrim(F.translate(F.lower(F.coalesce(text, F.lit(""))), ".,;:", ""), F.lit(" \t\n\x0b\x0c\r"))
    return let(plain, lambda t: F.when(t == "", F.array().cast("array<int>")).otherwise(F.transform(F.split(t, SPACE_CLASS, -1), lambda x: F.pmod(F.xxhash64(x), F.lit(BUCKETS)).cast("int"))))


def _fenced(rows: DataFrame, value: Column, into: str) -> DataFrame:
    """Add a column behind a generator, so that it is evaluated once however often it is used."""
    return rows.select("*", F.explode(F.array(value)).alias(into))


def _adder(model: Column):
    return lambda total, b: total + F.get(model, b)


class Posteriors:
    """Per-bucket log ratios of each domain against the first, and log prior ratios."""

    def __init__(self, domains: tuple[str, ...], ratios: list[list[float]], prior: list[float], temper: float):
        self.domains, self.ratios, self.prior, self.temper = domains, ratios, prior, temper

    def column(self, buckets: Column) -> Column:
        """array<double> of posteriors, in the order of ``domains``. No words: the prior. Words of a text repeat and
        hang together, so the evidence of n words counts as that of n ** temper."""
        n = F.size(buckets).cast("double")
        weight = F.when(n > 0, F.pow(n, F.lit(self.temper - 1.0))).otherwise(0.0)
        logits = [F.lit(0.0)]
        for ratio, prior in zip(self.ratios, self.prior, strict=True):
            # A literal array: constant folding parses the text once, at planning; its size is fixed by BUCKETS.
            model = F.split(F.lit(",".join(f"{x:.5g}" for x in ratio)), ",").cast("array<double>")
            logits.append(F.lit(prior) + weight * F.aggregate(buckets, F.lit(0.0), _adder(model)))
        return let(F.array(*logits), lambda x: let(F.array_max(x), lambda top: let(F.transform(x, lambda v: F.exp(v - top)), lambda e: let(F.aggregate(e, F.lit(0.0), lambda a, v: a + v), lambda s: F.transform(e, lambda v: v / s)))))


def fit_posteriors(docs: DataFrame, labelled: DataFrame, domains: tuple[str, ...], key: str = "doc_id", text_col: str = "text", domain_col: str = "domain", max_docs: int = 4000, smooth: float = 0.5, temper: float = 1.0) -> Posteriors:
    """Naive Bayes over hashed words, from about ``max_docs`` labelled documents of each domain (a documented bound).
    The counts that come back are at most BUCKETS rows. Rows with null text, key or domain teach nothing."""
    marked = labelled.where(F.col(key).isNotNull()).groupBy(key).agg(F.min(domain_col).alias("__domain")).where(F.col("__domain").isin(*domains))
    share = {r[0]: r[1] for r in marked.groupBy("__domain").count().collect()}
    drawn = bounded_sample(marked, key, "__domain", max_docs)
    # The draw is bounded by parameters (domains x max_docs ids), so it may be broadcast.
    texts = docs.where(F.col(text_col).isNotNull()).select(key, F.col(text_col).alias("__text")).join(F.broadcast(drawn), key)
    words = _fenced(texts, _buckets(F.col("__text")), "__b").select("__domain", F.explode("__b").alias("b"))
    counts = words.groupBy("b").pivot("__domain", list(domains)).count().collect()
    totals = [sum((r[d] or 0) for r in counts) + smooth * BUCKETS for d in domains]
    rate = [[smooth / t] * BUCKETS for t in totals]
    for r in counts:
        for j, d in enumerate(domains):
            rate[j][r["b"]] = ((r[d] or 0) + smooth) / totals[j]
    from math import log

    ratios = [[log(a / b) for a, b in zip(rate[j], rate[0], strict=True)] for j in range(1, len(domains))]
    prior = [log((share.get(d, 0) + 1) / (share.get(domains[0], 0) + 1)) for d in domains[1:]]
    return Posteriors(domains, ratios, prior, temper)


class Rates:
    """A document's rate as an expression of its posteriors: one, plus one multiplier per domain times its posterior,
    never below zero; one without tokens, which no domain counts. ``residual``: each domain's expected share less its target, as part of the target; ``met`` when
    all are within the tolerance."""

    def __init__(self, multipliers: list[float], residual: list[float] | None = None, met: bool = True):
        self.multipliers, self.residual, self.met = multipliers, residual or [], met

    def column(self, p: list[Column], n_tokens: Column) -> Column:
        rate = reduce(lambda a, b: a + b, [x * F.lit(float(m)) for x, m in zip(p, self.multipliers, strict=True)], F.lit(1.0))
        return F.when(n_tokens > 0, F.greatest(F.lit(0.0), rate)).otherwise(1.0)


def fit_rates(members: DataFrame, targets: list[float], tolerance: float = 2e-3, pull: float = 1e-3, floor: float = 1e-11, max_rounds: int = 400) -> Rates:
    """Least squares on ``members`` (n_tokens, p: array of posteriors).

    Minimises half the sum over domains of (expected share - target)^2 / the larger of present share and target, plus
    ``pull`` / 2 times the token-weighted mean of (rate - 1)^2, over rates of zero or more. The minimum has one
    multiplier per domain, found by Newton steps on the dual, a convex function of the multipliers; a step is halved
    until the dual falls. Each round is one aggregate that returns a few numbers per domain pair.

    Ends when every share is within ``tolerance`` of its target. The pull itself keeps shares off targets that ask for
    large rates, so it is lowered by hundreds down to ``floor`` until they are met. Targets that no rates meet get the
    minimum at ``pull``, with a warning; what remains is in the result's ``residual``. An empty table, or one without
    tokens, keeps every rate at one.
    """
    k = len(targets)
    p = [F.get(F.col("p"), F.lit(j)) for j in range(k)]
    n = F.col("n_tokens").cast("double")
    base = members.agg(F.sum(n), *[F.sum(n * x) for x in p]).first()
    if not base[0]:
        return Rates([0.0] * k)
    goal = np.array(targets, float) / sum(targets)
    present = np.array(base[1:], float) / base[0]
    scale = np.maximum(present, goal)
    scale[scale == 0] = 1.0
    unit = np.where(goal > 0, goal, scale)  # of a target of zero, a miss counts as part of the present share
    rounds = 0

    def look(m: np.ndarray):
        """Shares, their derivatives, and the mean of half the squared rates, under the multipliers ``m``."""
        nonlocal rounds
        rounds += 1
        if rounds > max_rounds:
            raise RuntimeError(f"rates did not settle in {max_rounds} rounds")
        rows = members.select(*[x.alias(f"p{j}") for j, x in enumerate(p)], n.alias("n"), Rates(list(m)).column(p, n).alias("rate")).where("rate > 0")
        both = [(i, j) for i in range(k) for j in range(i, k)]
        got = rows.agg(*[F.sum(F.col("n") * F.col("rate") * F.col(f"p{j}")) for j in range(k)], *[F.sum(F.col("n") * F.col(f"p{i}") * F.col(f"p{j}")) for i, j in both], F.sum(F.col("n") * F.col("rate") * F.col("rate")) / 2).first()
        got = np.array([x or 0.0 for x in got]) / base[0]
        slope = np.zeros((k, k))
        for (i, j), x in zip(both, got[k:-1], strict=True):
            slope[i, j] = slope[j, i] = x
        return got[:k], slope, got[-1]

    def missed(share: np.ndarray) -> np.ndarray:
        return (share - goal) / unit

    def settle(m: np.ndarray, seen, pull: float):
        """Newton steps to the minimum under ``pull``, or to the first multipliers that meet the targets."""
        dual = lambda m, seen: pull * (scale * m * m).sum() / 2 + seen[2] - goal @ m
        while True:
            slip = pull * scale * m + seen[0] - goal
            if (abs(missed(seen[0])) <= tolerance).all() or (abs(slip) <= tolerance / 10 * unit).all():
                return m, seen
            move = np.linalg.lstsq(seen[1] + np.diag(pull * scale), -slip, rcond=None)[0]
            gain, now, part = slip @ move, dual(m, seen), 1.0
            while True:
                new = m + part * move
                then = look(new)
                if dual(new, then) <= now + 1e-4 * part * gain + 1e-12 * abs(now):
                    break
                part /= 2
                if part < 1e-9:  # no fall that doubles can tell: this is the minimum
                    return m, seen
            m, seen = new, then

    m = np.zeros(k)
    m, seen = first, first_seen = settle(m, look(m), pull)
    while (abs(missed(seen[0])) > tolerance).any() and pull > floor:
        pull /= 100
        m, seen = settle(m, seen, pull)
    met = bool((abs(missed(seen[0])) <= tolerance).all())
    if not met:
        m, seen = first, first_seen
        warnings.warn(f"no rates meet the targets {list(targets)}: expected shares are {[round(float(x), 6) for x in seen[0]]}", stacklevel=2)
    return Rates([float(x) for x in m], [float(x) for x in missed(seen[0])], met)


def copies(rate: Column, *keys: Column) -> Column:
    """Whole number of copies with the rate as its mean: rounded by a hash of the keys, so a rerun agrees."""
    draw = F.pmod(F.xxhash64(F.lit("copies"), *keys), F.lit(1 << 40)) / F.lit(float(1 << 40))
    return F.floor(rate + draw).cast("int")


def label_domains(labels: DataFrame) -> DataFrame:
    """The labelled table's domains: toxic, else low quality, else clean. Rows with a null label have none."""
    return labels.where("toxic is not null and quality is not null").select("doc_id", F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low").otherwise("clean").alias("domain"))


def mixing(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, key: str = "doc_id", text_col: str = "text", **fit) -> tuple[DataFrame, Posteriors, Rates]:
    """One row per input row: key, n_tokens, p, rate, copies; and the two models, with which a rate can be computed on
    other columns. Repeated rows weigh as often as they occur. Null and blank texts have no tokens and the prior."""
    domains = tuple(targets)
    model = fit_posteriors(docs, labelled, domains, key, text_col, **fit)
    members = members_of(docs.select(F.col(key), F.col(text_col)), model, text_col, "__m").select(key, F.col("__m.n").alias("n_tokens"), F.col("__m.p").alias("p"))
    members = materialize(members, "members")
    rates = fit_rates(members, list(targets.values()))
    p = [F.get(F.col("p"), F.lit(j)) for j in range(len(domains))]
    return members.withColumn("rate", rates.column(p, F.col("n_tokens"))).withColumn("copies", copies(F.col("rate"), F.col(key))), model, rates


def members_of(docs: DataFrame, model: Posteriors, text_col: str, into: str) -> DataFrame:
    """``docs`` with struct ``into``, a name of no column there: tokens ``n`` and posteriors ``p``."""
    return _fenced(docs, let(_buckets(F.col(text_col)), lambda b: F.struct(F.size(b).cast("long").alias("n"), model.column(b).alias("p"))), into)


def mixed_documents(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS, text_col: str = "text") -> DataFrame:
    """The documents themselves, each as often as its copies say; all columns stay, whatever their names. Two passes,
    no shuffle of texts."""
    _, model, rates = mixing(docs, labelled, targets, text_col=text_col)
    into = unused(docs, "__m")
    p = [F.get(F.col(into).p, F.lit(j)) for j in range(len(targets))]
    n = copies(rates.column(p, F.col(into).n), F.col("doc_id"))
    counted = members_of(docs, model, text_col, into).withColumn(into, n).where(F.col(into) > 0)
    return counted.withColumn(into, F.explode(F.sequence(F.lit(1), F.col(into)))).select(*[F.col(f"`{c}`") for c in docs.columns])


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's tokens, domain posteriors, rate and copies under TARGETS."""
    mixed, _, _ = mixing(table(spark, sf_dir, "documents"), label_domains(table(spark, sf_dir, "labels")))
    return mixed.select("doc_id", "n_tokens", *[F.get(F.col("p"), F.lit(j)).alias(f"p_{d}") for j, d in enumerate(DOMAINS)], "rate", "copies")
