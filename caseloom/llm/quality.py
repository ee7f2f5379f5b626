"""Quality rules under weak supervision, in DataFrame functions only.

Each rule votes good (1), bad (-1) or abstains (0) from counts of the whole text. Documents meet the rules as
at most 3**rules vote patterns, so expectation-maximisation over pattern counts, whose number does not grow with
the corpus, estimates how far each rule can be trusted. A bad document is one with some defect, and each rule
looks for one defect: on documents with that defect the rule has one set of vote rates, on all others another. So a
single rule can condemn a document when its false alarms are rare, as the good votes of rules that look elsewhere say
nothing about this defect. A document is kept when the posterior probability of having no defect is one half or more
and the base limits hold.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import SPACE_CLASS, let, materialize, table, unused

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = UPPER.lower()
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def words(text: Column) -> Column:
    """Runs of characters other than space and tab to carriage return; none for a null or blank text."""
    return let(F.btrim(F.coalesce(text, F.lit("")), F.lit(WHITE)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, SPACE_CLASS, -1)))


def _count(text: Column, characters: str) -> Column:
    return (F.char_length(text) - F.char_length(F.translate(text, characters, ""))).cast("long")


def _repeated(w: Column) -> Column:
    """Words inside a 3-word window that occurs twice or more: sort window hashes with their positions, keep equal
    neighbours, and add up what their positions cover. n log n in the words, with no pair of windows compared.
    Windows are compared by a 64-bit hash."""
    hashed = F.transform(F.sequence(F.lit(0), F.size(w) - 3), lambda i: F.struct(F.xxhash64(F.get(w, i), F.get(w, i + 1), F.get(w, i + 2)).alias("h"), i.alias("i")))

    def equal_neighbours(s: Column) -> Column:
        twice = F.filter(s, lambda x, k: F.get(s, k - 1)["h"].eqNullSafe(x["h"]) | F.get(s, k + 1)["h"].eqNullSafe(x["h"]))
        return F.sort_array(F.transform(twice, lambda x: x["i"]))

    covered = F.aggregate(
        let(F.sort_array(hashed), equal_neighbours),
        F.struct(F.lit(-3).alias("last"), F.lit(0).alias("n")),
        lambda a, p: F.struct(p.alias("last"), (a["n"] + F.least(F.lit(3), p - a["last"])).alias("n")),
        lambda a: a["n"],
    )
    return F.when(F.size(w) < 4, F.lit(0)).otherwise(covered).cast("long")


def measures(text: Column) -> Column:
    """Struct of the counts that rules read; one evaluation of the words and lines per text. Null counts as empty."""
    whole = F.coalesce(text, F.lit(""))
    lines = F.filter(F.split(whole, "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != "")
    by_word = let(words(text), lambda w: F.struct(F.size(w).cast("long").alias("n_words"), F.char_length(F.array_join(w, "")).cast("long").alias("word_chars"), _repeated(w).alias("n_repeat_words")))
    by_line = let(lines, lambda x: F.struct(F.size(x).cast("long").alias("n_lines"), (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("n_dup_lines")))
    by_char = F.struct(_count(whole, SYMBOLS).alias("n_symbols"), _count(whole, UPPER).alias("n_upper"), _count(whole, LOWER).alias("n_lower"), _count(whole, "!").alias("n_shouts"))
    return F.struct(by_word.alias("w"), by_line.alias("l"), by_char.alias("c"))


def with_measures(docs: DataFrame, text_col: str = "text", into: str = "q") -> DataFrame:
    """``docs`` with the flat measures as struct column ``into``, in place of one of that name; all other columns stay."""
    # The generator is a fence: no later projection can inline the expression and evaluate it again.
    held_in = unused(docs, "__m")
    held = docs.select("*", F.explode(F.array(measures(F.col(text_col)))).alias(held_in))
    m = F.col(held_in)
    flat = [m[g][x].alias(x) for g, xs in (("w", ("n_words", "word_chars", "n_repeat_words")), ("l", ("n_lines", "n_dup_lines")), ("c", ("n_symbols", "n_upper", "n_lower", "n_shouts"))) for x in xs]
    return held.select(*[F.col(f"`{c}`") for c in docs.columns if c != into], F.struct(*flat).alias(into))


def base_failed(q: Column) -> Column:
    return (q.n_words < 50) | (100 * q.n_repeat_words > 50 * q.n_words)


def votes(q: Column) -> dict[str, Column]:
    """The rules: name -> column of -1, 0 or 1. Thresholds are ratios, alike for every text length."""

    def vote(bad: Column, good: Column) -> Column:
        return F.when(bad, -1).when(good, 1).otherwise(0)

    letters = F.greatest(q.n_upper + q.n_lower, F.lit(1))
    return {
        "length": vote(q.n_words < 50, q.n_words >= 80),
        "repetition": vote(10 * q.n_repeat_words > 3 * q.n_words, 10 * q.n_repeat_words <= q.n_words),
        "symbols": vote(20 * q.n_symbols > q.word_chars, 100 * q.n_symbols <= q.word_chars),
        "lines": vote(10 * q.n_dup_lines > 3 * q.n_lines, 10 * q.n_dup_lines <= q.n_lines),
        "capitals": vote(2 * q.n_upper > letters, 5 * q.n_upper <= letters),
        "shouting": vote(10 * q.n_shouts > q.n_words, 50 * q.n_shouts <= q.n_words),
        "word_length": vote((q.word_chars > 15 * q.n_words) | (q.word_chars < 2 * q.n_words), (q.word_chars <= 10 * q.n_words) & (q.word_chars >= 3 * q.n_words)),
    }


#: Expected vote rates before any document is seen: of a rule on its own defect, and on all other documents.
ON_DEFECT = {-1: 0.95, 0: 0.04, 1: 0.01}
ELSEWHERE = {-1: 0.01, 0: 0.09, 1: 0.90}


class VoteModel:
    """``prior``: share of documents with no defect; ``weight``: share with each rule's defect; vote rates of each
    rule on its defect (``defect``) and elsewhere (``clean``)."""

    def __init__(self, prior: float, weight: list[float], defect: list[dict[int, float]], clean: list[dict[int, float]]):
        self.prior, self.weight, self.defect, self.clean = prior, weight, defect, clean

    def odds(self, j: int, vote: int) -> float:
        """Odds of rule j's defect against no defect, given its vote."""
        return self.weight[j] * self.defect[j][vote] / (self.prior * self.clean[j][vote])

    def posterior(self, votes_: list[Column]) -> Column:
        total = F.lit(1.0)
        for j, v in enumerate(votes_):
            total = total + F.when(v == -1, self.odds(j, -1)).when(v == 1, self.odds(j, 1)).otherwise(self.odds(j, 0))
        return 1 / total


def fit_votes(patterns: list[tuple[tuple[int, ...], int]], rules: int, rounds: int = 100, trust: float = 0.1) -> VoteModel:
    """EM over (vote pattern, count). The expected rates enter as pseudo-counts worth ``trust`` of all documents, so
    the estimate is the same for a corpus and for copies of it; an empty corpus gives the expected rates."""
    total = sum(c for _, c in patterns) or 1
    model = VoteModel(0.9, [0.1 / rules] * rules, [ON_DEFECT] * rules, [ELSEWHERE] * rules)
    for _ in range(rounds):
        good, weight = trust * total * 0.9, [trust * total * 0.1 / rules] * rules
        defect = [{k: trust * total * 0.1 * x for k, x in ON_DEFECT.items()} for _ in range(rules)]
        clean = [{k: trust * total * x for k, x in ELSEWHERE.items()} for _ in range(rules)]
        for v, c in patterns:
            odds = [model.odds(j, v[j]) for j in range(rules)]
            whole = 1 + sum(odds)
            good += c / whole
            for j in range(rules):
                share = c * odds[j] / whole
                weight[j] += share
                defect[j][v[j]] += share
                clean[j][v[j]] += c - share
        mass = good + sum(weight)
        scaled = lambda rates: [{k: x / sum(r.values()) for k, x in r.items()} for r in rates]
        new = VoteModel(good / mass, [w / mass for w in weight], scaled(defect), scaled(clean))
        moved, model = abs(new.prior - model.prior), new
        if moved < 1e-9:
            break
    return model


def learn(measured: DataFrame, into: str = "q") -> VoteModel:
    """Count vote patterns (at most 3**rules rows come back, whatever the corpus) and fit the model."""
    rules = votes(F.col(into))
    rows = measured.select(*[v.alias(k) for k, v in rules.items()]).groupBy(*rules).count().collect()
    return fit_votes([(tuple(r[:-1]), r[-1]) for r in sorted(rows)], len(rules))


def quality(docs: DataFrame, text_col: str = "text", into: str = "q") -> DataFrame:
    """Every row of ``docs`` with struct ``into``: measures, votes, ``base_failed``, ``p_good`` and ``kept``.

    Texts are measured once: the rows are written with their measures, as votes must be counted before they are
    weighed. No shuffle. Repeated rows count as often as they occur. Null and empty texts fail the base limits. An empty
    table gives no rows. A column named ``into`` is replaced.
    """
    measured = materialize(with_measures(docs, text_col, into), "quality")
    return judged(measured, learn(measured, into), into)


def judged(measured: DataFrame, model: VoteModel, into: str = "q") -> DataFrame:
    q, rules = F.col(into), votes(F.col(into))
    p = model.posterior(list(rules.values()))
    return measured.withColumn(into, F.struct(q.alias("m"), F.struct(*[v.alias(k) for k, v in rules.items()]).alias("votes"), base_failed(q).alias("base_failed"), p.alias("p_good"))).withColumn(into, F.col(into).withField("kept", ~F.col(into).base_failed & (F.col(into).p_good >= 0.5)))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: base counts, base verdict and the model's verdict for every document."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    # The counts are a few numbers a document: written once, so that texts are read once.
    measured = materialize(with_measures(docs).select("doc_id", "q"), "quality")
    q = F.col("q")
    return judged(measured, learn(measured)).select("doc_id", *[q.m[c].alias(c) for c in BASE], q.base_failed.alias("base_failed"), q.kept.alias("kept"), q.p_good.alias("p_good"))
