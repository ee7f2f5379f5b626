"""Near copies of the pipeline against all pairs by brute force."""

import random
import re

import pytest

import corpus_pipeline
from caseloom.llm import nearcopies, simhash
from caseloom.llm.common import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_survivors(texts):
    """Smallest id of each component of pairs at Jaccard 0.8 or more on sets of five words."""
    sets = {}
    for i, t in texts.items():
        w = WORD.findall((t or "").lower())
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))} if w else set()
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in sets:
        for j in sets:
            if i < j and (sets[i] == sets[j] or 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])):
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    return {find(i) for i in sets}


def edited(rng, text, edits):
    w = text.split()
    for at in rng.sample(range(len(w)), edits):
        w[at] = f"x{rng.randrange(10**6)}"
    return " ".join(w)


def planted():
    rng = random.Random(8)
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(rng.randrange(80, 400))) for _ in range(12)]
    texts = dict(enumerate(base))
    for b in base:  # similarity of about 0.95 to 0.7, and copies of copies
        n = len(b.split())
        for share in (0.005, 0.01, 0.015, 0.02, 0.03):
            texts[len(texts)] = edited(rng, b, max(1, round(n * share)))
        texts[len(texts)] = edited(rng, texts[len(texts) - 5], max(1, round(n * 0.015)))
    for t in (base[0].upper(), base[1], "one two", "one  two", "three words here", "", None, " \n"):
        texts[len(texts)] = t
    return texts


def test_near_copies_equal_all_pairs(spark):
    texts = planted()
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    got = simhash.one_of_each(docs, near=nearcopies.similar_roots)
    assert got.columns == docs.columns
    kept = sorted(r.doc_id for r in got.collect())
    assert kept == sorted(brute_survivors(texts))


@pytest.mark.parametrize("few", [0, 3])
def test_prefixes_find_what_pairs_find(spark, monkeypatch, few):
    """All bands, or all but the smallest, are settled by prefixes; edits of 10 to 20 % leave many pairs just below the limit."""
    monkeypatch.setattr(nearcopies, "FEW", few)
    rng = random.Random(21)
    texts = planted()
    base = " ".join(f"v{rng.randrange(3000)}" for _ in range(170))
    for _ in range(40):
        w = edited(rng, base, rng.randrange(1, 8)).split()
        texts[len(texts)] = " ".join(w[rng.randrange(12) : len(w) - rng.randrange(12)])
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string").repartition(4)
    kept = sorted(r.doc_id for r in simhash.one_of_each(docs, near=nearcopies.similar_roots).collect())
    assert kept == sorted(brute_survivors(texts))


def test_index_names_pairs_that_bands_miss(spark):
    """Two texts at similarity 21/26 that share no band are linked through SimHash's index alone; what the index names
    at 21/29 is not a link."""
    once = [f"t13738w{i}" for i in range(21)]
    further = [f"t13738x{i}" for i in range(8)]
    for times, more, kept in ((6, 5, {4}), (60, 8, {4, 7})):
        texts = {4: " ".join(once * times), 7: " ".join(once * times + further[:more])}
        assert (simhash.fingerprint(texts[4]) ^ simhash.fingerprint(texts[7])).bit_count() <= simhash.RADIUS
        if len(kept) == 1:
            assert not (nearcopies.bands(nearcopies.shingle_set(texts[4])) == nearcopies.bands(nearcopies.shingle_set(texts[7]))).any()
        out = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(list(texts.items()), "doc_id long, text string"), "")
        assert {r.doc_id for r in out.collect()} == brute_survivors(texts) == kept


def test_pipeline_stage_drops_near_copies(spark, awkward, nothing):
    rng = random.Random(9)
    base = [" ".join(f"w{rng.randrange(3000)}" for _ in range(200)) for _ in range(10)]
    rows = list(enumerate(base)) + [(100 + k, edited(rng, t, 1 + k % 4)) for k, t in enumerate(base)]  # 0.8 to 0.95
    out = corpus_pipeline.near_duplicate_stage(spark, spark.createDataFrame(rows, "doc_id long, text string"), "")
    assert sorted(r.doc_id for r in out.collect()) == list(range(10))
    assert sorted(str(r.doc_id) for r in corpus_pipeline.near_duplicate_stage(spark, awkward, "").collect()) in (["1", "3"], ["1", "3", "4"])
    assert corpus_pipeline.near_duplicate_stage(spark, nothing, "").collect() == []


def test_pipeline_with_near_copies(spark, awkward, nothing, tmp_path):
    rng = random.Random(10)
    base = [" ".join(f"word{rng.randrange(3000)}" for _ in range(120 + i)) for i in range(40)]
    rows = list(enumerate(base)) + [(100, base[3])] + [(200 + k, edited(rng, base[10 + k], 1 + k % 2)) for k in range(8)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows] + [(300, "short text", "en", "s", 1), (301, None, None, None, None)], "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(base[5].split()[:15]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept, now = {}, docs
    for name, stage in corpus_pipeline.STAGES:
        now = materialize(stage(spark, now, str(tmp_path)), "test-stage")
        kept[name] = {r.doc_id for r in now.select("doc_id").collect()}
    assert kept["quality rules"] == {i for i, _ in rows}
    assert kept["near duplicates"] == set(range(40))
    assert kept["decontamination"] == set(range(40)) - {5}
    assert kept["token ids"] == kept["mixing"]
    for odd in (awkward.select(docs.columns), nothing.select(docs.columns)):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, odd, str(tmp_path)).collect()
