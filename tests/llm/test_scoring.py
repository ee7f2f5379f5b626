"""Toxicity, language, quality rules and decontamination."""

import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from caseloom.llm import common, decontaminate, language, quality, toxicity

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def test_quality_counts(docs, texts):
    for r in quality.with_measures(docs).collect():
        s = texts[r.doc_id] or ""
        w = WORD.findall(s)
        c = Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        covered = {p for i in range(len(w) - 2) if c[tuple(w[i : i + 3])] > 1 for p in (i, i + 1, i + 2)}
        lines = [x for x in s.split("\n") if WORD.search(x)]
        assert (r.q.n_words, r.q.word_chars, r.q.n_repeat_words, r.q.n_dup_lines, r.q.n_symbols) == (len(w), sum(map(len, w)), len(covered), len(lines) - len(set(lines)), len(re.findall(r"[#*$%&|<>]", s)))


def test_votes_find_single_defects_and_spare_clean_documents():
    rng = random.Random(3)
    patterns = Counter()
    for _ in range(2000):
        v = [1] * 5
        if rng.random() < 0.1:
            v[rng.randrange(5)] = -1
        elif rng.random() < 0.1:
            v[rng.randrange(5)] = 0
        patterns[tuple(v)] += 1
    model = quality.fit_votes(sorted(patterns.items()), 5)
    bad = lambda v: sum(model.odds(j, x) for j, x in enumerate(v))
    for v in patterns:
        assert (bad(v) > 1) == (-1 in v)
    assert quality.fit_votes([], 5).prior == pytest.approx(0.9)


def test_quality_edges(awkward, nothing):
    rows = quality.quality(awkward, into="verdict").collect()
    assert len(rows) == 6 and not any(r.verdict.kept for r in rows if not r.text)
    assert quality.quality(nothing, into="verdict").collect() == []


def brute_hits(texts, items, n=10):
    norm = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    windows = {k: {tuple(w[i : i + n]) for i in range(max(1, len(w) - n + 1))} if (w := norm(t)) else set() for k, t in items.items()}
    out = {}
    for i, t in texts.items():
        w, hit, found = norm(t), set(), set()
        for k, ws in windows.items():
            for x in ws:
                for p in range(len(w) - len(x) + 1):
                    if tuple(w[p : p + len(x)]) == x:
                        hit.update(range(p, p + len(x)))
                        found.add(str(k))
        out[i] = (len(w), len(hit), sorted(found))
    return out


def test_decontamination(spark, docs, texts):
    passage = texts[39].split()
    items = {1: " ".join(passage[25:45]).upper() + "!", 2: "w1, w2", 3: None, 4: " ... ", 5: "Ünï cödé ÜNÏ", 10: "ünï CÖDÉ"}
    want = brute_hits(texts, items)
    table = spark.createDataFrame(list(items.items()), "item_id long, text string")
    for block in (64 << 20, 40):  # one automaton, and many blocks
        rows = decontaminate.benchmark_hits(docs, table, max_block_bytes=block).collect()
        assert {r.doc_id: (r.hits.n_words, r.hits.n_hit, r.hits["items"]) for r in rows} == want
    spans = next(r for r in rows if r.doc_id == 39).hits.spans
    assert spans and all(texts[39][s.start : s.end].split() for s in spans)


def test_decontamination_edges(spark, awkward, nothing):
    none = spark.createDataFrame([], "item_id long, text string")
    assert all(r.hits.n_hit == 0 for r in decontaminate.benchmark_hits(awkward, none).collect())
    assert decontaminate.benchmark_hits(nothing, none).collect() == []


ENGLISH, GERMAN = "the house and the garden with children of the town that was there", "das haus und der garten mit kindern aus dieser stadt die nicht schön ist"


def test_language(spark, awkward, nothing):
    rng = random.Random(4)
    text = lambda x: " ".join(rng.choices(x.split(), k=12))
    rows = [(i, text(ENGLISH if i % 2 else GERMAN), "en" if i % 2 else "de") for i in range(200)] + [(900, None, "en"), (901, "the", None)]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    held = common.unsigned_bucket(F.col("doc_id"), 3) == 1
    model = language.train(df.where(~held))
    got = language.with_language(df.where(held), model).where("lang is not null").collect()
    assert got and all(r.language.lang == r.lang for r in got if r.text)
    odd = spark.createDataFrame([("gardening childrens",), ("gärten städte",), (None,), ("",), ("123 !!",), ("the " * 5000,)], "text string")
    assert [r.language.lang for r in language.with_language(odd, model).collect()] == ["en", "de", "und", "und", "und", "en"]
    assert all(0 <= r.language.score <= 1 for r in language.with_language(awkward, model).collect())
    empty = language.train(nothing)
    assert {r.language.lang for r in language.with_language(awkward, empty).collect()} == {"und"}


def test_toxicity_learns_misspellings(spark, awkward, nothing):
    rng = random.Random(6)
    plain = [f"{a}{b}" for a in ("ba", "ke", "lo", "mi", "tu") for b in ("ran", "sel", "tok", "vin", "zub", "dar")]
    rows, labels = [], []
    for i in range(600):
        bad = i % 3 == 0
        w = rng.choices(plain, k=30)
        if bad:
            w[rng.randrange(30)] = rng.choice(["grumpfish", "snarkhead"])
        rows.append((i, " ".join(w)))
        labels.append((i, int(bad)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    held = common.unsigned_bucket(F.col("doc_id"), 5) == 0
    model = toxicity.train(docs, spark.createDataFrame(labels, "doc_id long, toxic int").where(~held))
    scored = {r.doc_id: r.score for r in toxicity.with_toxicity(docs.where(held), model).collect()}
    truth = dict(labels)
    assert sum((s >= 0.5) == bool(truth[i]) for i, s in scored.items()) / len(scored) > 0.9
    misspelt = spark.createDataFrame([(" ".join(plain[:29]) + " grumpfishh",), (" ".join(plain),)], "text string")
    a, b = [r.score for r in toxicity.with_toxicity(misspelt, model).collect()]
    assert a > b
    assert all(0 <= r.score <= 1 for r in toxicity.with_toxicity(awkward, model).collect())
    nobody = toxicity.train(nothing, spark.createDataFrame([], "doc_id long, toxic int"))
    assert len(toxicity.with_toxicity(awkward, nobody).collect()) == 6


def test_word_hashes_do_not_depend_on_neighbours():
    a, s = toxicity.subword_buckets(["alpha", "be", "gamma"], 1 << 17)
    alone = toxicity.subword_buckets(["gamma"], 1 << 17)[0]
    assert sorted(a[s[2] :].tolist()) == sorted(alone.tolist())
