"""The dealt methods against brute force, and that results come from them."""

import math
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from caseloom.llm import common, language, mixing, quality, sharding, simhash, tokenfile, toxicity


def words(rng, n, vocabulary=60):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))



# --- op1: links come from the Gray hierarchy ---------------------------------------------------------------------------


def test_node_links_equal_all_pairs_in_every_node():
    rng = random.Random(11)
    fps, node = [], []
    for k in range(300):
        size = rng.choice([2, 2, 3, 5, 8, 9, 40])
        centre, own = rng.getrandbits(64), set()
        while len(own) < size:
            x = centre
            for _ in range(rng.randrange(4)):
                x ^= 1 << rng.randrange(64)
            own.add(x)
        fps += sorted(own)
        node += [k] * size
    a, b = simhash.node_links(np.array(fps, np.uint64), np.array(node))
    got = defaultdict(set)
    groups = {}
    by_node = defaultdict(list)
    for f, k in zip(fps, node, strict=True):
        by_node[k].append(f)

    def components(members, edges):
        root = {f: f for f in members}

        def find(x):
            while root[x] != x:
                x = root[x]
            return x

        for x, y in edges:
            root[max(find(x), find(y))] = min(find(x), find(y))
        return {f: find(f) for f in members}

    home = {f: k for k, fs in by_node.items() for f in fs}
    for x, y in zip(a.tolist(), b.tolist(), strict=True):
        assert home[x] == home[y] and (x ^ y).bit_count() <= 2
        got[home[x]].add((x, y))
    for k, fs in by_node.items():
        all_pairs = [(x, y) for i, x in enumerate(fs) for y in fs[:i] if (x ^ y).bit_count() <= 2]
        groups[k] = components(fs, all_pairs)
        assert components(fs, got[k]) == groups[k]
    assert len(simhash.node_links(np.zeros(0, np.uint64), np.zeros(0, np.int64))[0]) == 0


def test_no_link_without_the_hierarchy(docs, monkeypatch):
    fps = simhash.with_fingerprint(docs).select("fp").distinct()
    assert simhash.links(fps).count() > 0
    monkeypatch.setattr(simhash, "node_links", lambda fps, node, radius=2: (fps[:0], fps[:0]))
    empty = list(simhash._links(iter([fps.toPandas().assign(mask=0, bits=0)])))
    assert sum(map(len, empty)) == 0


# --- op2: ids as the unaltered library gives them ------------------------------------------------------------------------

SPECIAL = ["<|endoftext|>", "x <|endoftext|> y", "hello<|endoftext|><|endoftext|>world", "<|endoftext| >", "é <|endoftext|> ñ", "<|ENDOFTEXT|>"]


def test_ids_equal_a_fresh_tokenizer(spark):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenfile.default_tokenizer())
    e = tokenfile.PieceEncoder(tokenfile.default_tokenizer(), max_pieces=30)
    texts = [*SPECIAL, "", " ", "don't we'll  I'm", "a" * 3000, "x²y ١٢ 漢字 🙂", "r\r\n\tTab", "one two three " * 40]
    want = [np.array(plain.encode(t, add_special_tokens=False).ids, "<u4").tobytes() for t in texts]
    assert any(50256 in np.frombuffer(x, "<u4") for x in want)
    for _ in range(2):
        assert e.encode(texts) == want
    df = spark.createDataFrame([(9 - i, t) for i, t in enumerate(SPECIAL)] + [(50, None)], "doc_id long, text string")
    start = 0
    for r in sorted(tokenfile.encode_and_read(df).collect(), key=lambda r: r.doc_id):
        t = "" if r.doc_id == 50 else SPECIAL[9 - r.doc_id]
        ids = np.array([*plain.encode(t, add_special_tokens=False).ids, 0], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    with pytest.raises(TypeError, match="whole numbers"):
        tokenfile.encode_and_read(df.withColumn("doc_id", F.col("doc_id").cast("string")))


# --- op3 -----------------------------------------------------------------------------------------------------------------


def brute_subwords(word):
    m = f"<{word}>"
    return [m[i : i + n] for n in toxicity.LENGTHS for i in range(len(m) - n + 1)] + [(m,)]


def test_scores_equal_a_plain_mean_of_subwords(spark):
    rng = np.random.default_rng(3)
    model = toxicity.Model(rng.standard_normal(toxicity.BUCKETS).astype(np.float32), -0.3)

    def bucket(word, k):  # the bucket of the word's k-th part, by the order of subword_buckets
        return toxicity.subword_buckets([word], toxicity.BUCKETS)[0][k]

    texts = ["alpha beta alpha", "Été 12 x_y", "", None, "?!", "z " * 5000]
    got = [r.score for r in toxicity.with_toxicity(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1), model).collect()]
    for t, score in zip(texts, got, strict=True):
        found = toxicity.WORD.findall((t or "").lower())
        each = []
        for w in found:
            n = len(brute_subwords(w))
            assert len(toxicity.subword_buckets([w], toxicity.BUCKETS)[0]) == n
            each.append(sum(float(model.weights[bucket(w, k)]) for k in range(n)) / n)
        logit = (sum(each) / len(each) if each else 0.0) + model.bias
        assert score == pytest.approx(1 / (1 + math.exp(-logit)), abs=1e-6)


def test_bags_are_means_and_every_bucket_is_trained():
    ids, share = toxicity.bag("good good words", 1 << 10)
    want = Counter()
    for w in ("good", "good", "words"):
        b = toxicity.subword_buckets([w], 1 << 10)[0].tolist()
        for x in b:
            want[x] += 1 / len(b) / 3
    assert dict(zip(ids.tolist(), share.tolist(), strict=True)) == pytest.approx(want)
    rng = random.Random(2)
    texts = [" ".join(rng.choices("abc def ghi jkl mno".split(), k=9)) + (" vile" if i % 2 else "") for i in range(80)]
    bags = [toxicity.bag(t, toxicity.BUCKETS) for t in texts]
    model = toxicity.fit(bags, [i % 2 for i in range(80)], epochs=3)
    seen = np.unique(np.concatenate([b for b, _ in bags]))
    assert (model.weights[seen] != 0).all() and np.count_nonzero(model.weights) == len(seen)


def test_training_with_ties_repeats_and_nulls(spark):
    docs = spark.createDataFrame([(1, "fine words"), (1, "other words"), (2, "vile words"), (2, "vile words"), (3, None), (None, "x"), (4, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 0), (2, 1), (2, 0), (3, 1), (None, 1), (4, None)], "doc_id long, toxic int")
    a, b = toxicity.train(docs, labels), toxicity.train(docs.repartition(3), labels.repartition(2))
    assert (a.weights == b.weights).all() and a.bias == b.bias


# --- op4 -----------------------------------------------------------------------------------------------------------------


def brute_language(counts, text):
    """Word-first backoff, straight from its definition."""
    langs = sorted(counts)
    grams = {n: {x: Counter() for x in langs} for n in range(1, language.LONGEST + 1)}
    for x in langs:
        for w, c in counts[x].items():
            for n in grams:
                for i in range(len(w) + 3 - n):
                    grams[n][x][f"<{w}>"[i : i + n]] += c

    def row(table, key):
        s = [math.log((table[x][key] + 0.1) / (sum(table[x].values()) + 1.0)) for x in langs]
        return [v - sum(s) / len(s) for v in s]

    total = [0.0] * len(langs)
    for w in language.WORD.findall(text.lower()):
        if any(counts[x][w] for x in langs):
            got = [row(counts, w)]
        else:
            got, m = [], f"<{w}>"
            for i in range(len(m)):
                n = next((n for n in range(min(language.LONGEST, len(m) - i), 0, -1) if any(grams[n][x][m[i : i + n]] for x in langs)), 0)
                if n:
                    got.append([v / language.LONGEST for v in row(grams[n], m[i : i + n])])
        total = [a + sum(g[j] for g in got) for j, a in enumerate(total)]
    return langs, total


def test_language_equals_its_definition():
    rng = random.Random(12)
    syllables = {"de": ["sch", "ein", "ung", "ü", "ber"], "en": ["th", "ing", "ou", "er", "w"], "es": ["ción", "el", "os", "ñ", "a"]}
    make = lambda x: "".join(rng.choices(syllables[x], k=rng.randrange(1, 4)))
    counts = {x: Counter(make(x) for _ in range(60 if x != "es" else 5)) for x in syllables}
    model = language.WordBackoff(counts)
    assert set(model.words) == set().union(*counts.values())  # nothing that was seen is unknown
    scorer = language.Scorer(model, room=12)
    texts = [" ".join(make(rng.choice("de en es".split())) for _ in range(rng.randrange(1, 9))) for _ in range(60)] + ["QQQ", "ñ!", "漢字 x", "a-b_c 12"]
    for at in range(0, len(texts), 7):
        part = texts[at : at + 7]
        for t, (lang, score) in zip(part, scorer.predict(part), strict=True):
            langs, total = brute_language(counts, t)
            odds = [math.exp(v - max(total)) for v in total]
            assert score == pytest.approx(1 / sum(odds), abs=1e-4)
            assert total[langs.index(lang)] == pytest.approx(max(total), abs=1e-4)
    assert scorer.predict([None, "", "12 !"]) == [("und", 0.0)] * 3


def test_language_training_with_ties_and_repeats(spark):
    rows = [(1, "uno dos", "es"), (1, "uno dos", "es"), (2, "one two", "en"), (None, "none", "en"), (3, None, "en"), (4, "x", None), (5, "", "de")]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.train(df)
    assert set(model.words) >= {"uno", "dos", "one", "two"} and "x" not in model.words
    assert language.Scorer(model).predict(["uno", "two"])[0][0] == "es"


# --- op5 -----------------------------------------------------------------------------------------------------------------


def brute_posteriors(spark, docs, labels, domains):
    """Naive Bayes over hashed words, in plain Python."""
    split = {i: t.lower().translate(str.maketrans("", "", ".,;:")).split() for i, t in docs.items()}
    vocabulary = sorted({w for ws in split.values() for w in ws})
    frame = spark.createDataFrame([(w,) for w in vocabulary], "w string").select("w", F.pmod(F.xxhash64("w"), F.lit(mixing.BUCKETS)).alias("b"))
    bucket = {r.w: r.b for r in frame.collect()}
    counts = {d: Counter(bucket[w] for i, x in labels.items() if x == d for w in split[i]) for d in domains}
    sizes = {d: sum(counts[d].values()) + 0.5 * mixing.BUCKETS for d in domains}
    prior = {d: sum(x == d for x in labels.values()) + 1 for d in domains}
    out = {}
    for i, ws in split.items():
        logit = [math.log(prior[d]) + sum(math.log((counts[d][bucket[w]] + 0.5) / sizes[d]) for w in ws) for d in domains]
        e = [math.exp(v - max(logit)) for v in logit]
        out[i] = (len(ws), [v / sum(e) for v in e])
    return out


def test_posteriors_and_rates_equal_brute_force(spark):
    rng = random.Random(13)
    vocabulary = {"clean": "plain good calm soft kind".split(), "low": "spam click buy now win".split(), "toxic": "vile nasty foul rude mean".split()}
    both = [w for ws in vocabulary.values() for w in ws]
    docs, labels = {}, {}
    for i in range(240):
        d = ("clean", "clean", "clean", "low", "toxic")[i % 5]
        docs[i] = " ".join(rng.choices(vocabulary[d] * 4 + both, k=rng.randrange(1, 40)))
        if i < 150:
            labels[i] = d
    frame = spark.createDataFrame(list(docs.items()), "doc_id long, text string")
    targets = {"clean": 0.5, "low": 0.3, "toxic": 0.2}
    mixed, _, rates = mixing.mixing(frame, spark.createDataFrame(list(labels.items()), "doc_id long, domain string"), targets)
    want = brute_posteriors(spark, docs, labels, tuple(targets))
    rows = {r.doc_id: r for r in mixed.collect()}
    for i, (n, p) in want.items():
        assert rows[i].n_tokens == n and list(rows[i].p) == pytest.approx(p, abs=2e-3)
    # The least squares itself: projected gradient with a stored rate for every document, small steps, many rounds.
    n = np.array([want[i][0] for i in docs], float)
    p = np.array([rows[i].p for i in docs])
    goal, rate = np.array(list(targets.values())), np.ones(len(n))
    scale = np.maximum((n[:, None] * p).sum(0) / n.sum(), goal)
    for _ in range(20_000):
        share = (n[:, None] * rate[:, None] * p).sum(0) / n.sum()
        gradient = p @ ((share - goal) / scale) + 1e-3 * (rate - 1)
        rate = np.maximum(0, rate - 0.2 * gradient)
    plain = (n[:, None] * rate[:, None] * p).sum(0) / n.sum()
    ours = np.array([rows[i].rate for i in docs])
    share = (n[:, None] * ours[:, None] * p).sum(0) / n.sum()
    assert rates.met and (ours >= 0).all()
    assert np.abs((share - goal) / goal).max() <= 2.1e-3
    assert np.abs((plain - goal) / goal).max() <= 2e-2  # the plain descent comes to the same totals
    assert np.corrcoef(ours, rate)[0, 1] > 0.99


def test_mixing_keeps_clashing_columns(spark, docs, awkward):
    labels = spark.createDataFrame([(i, "clean") for i in range(20)], "doc_id long, domain string")
    for df in (docs, awkward):
        out = mixing.mixed_documents(df, labels, {"clean": 1.0})
        assert out.columns == df.columns
        rows = out.collect()
        assert rows and all(r["__m"] == "own __m" and r.p == "own p" and r.n_tokens == "own n_tokens" for r in rows)


# --- op6 -----------------------------------------------------------------------------------------------------------------


def brute_verdicts(measured):
    """EM over single documents rather than patterns, with the same pseudo-counts."""
    rules = 7

    def vote(bad, good):
        return -1 if bad else 1 if good else 0

    def votes(q):
        letters = max(q.n_upper + q.n_lower, 1)
        w, c = q.n_words, q.word_chars
        return [
            vote(w < 50, w >= 80),
            vote(10 * q.n_repeat_words > 3 * w, 10 * q.n_repeat_words <= w),
            vote(20 * q.n_symbols > c, 100 * q.n_symbols <= c),
            vote(10 * q.n_dup_lines > 3 * q.n_lines, 10 * q.n_dup_lines <= q.n_lines),
            vote(2 * q.n_upper > letters, 5 * q.n_upper <= letters),
            vote(10 * q.n_shouts > w, 50 * q.n_shouts <= w),
            vote(c > 15 * w or c < 2 * w, c <= 10 * w and c >= 3 * w),
        ]

    cast = {k: votes(q) for k, q in measured.items()}
    n, trust = len(cast), 0.1
    prior, weight = 0.9, [0.1 / rules] * rules
    defect, clean = [dict(quality.ON_DEFECT)] * rules, [dict(quality.ELSEWHERE)] * rules
    for _ in range(100):
        good, new_weight = trust * n * 0.9, [trust * n * 0.1 / rules] * rules
        d = [{k: trust * n * 0.1 * x for k, x in quality.ON_DEFECT.items()} for _ in range(rules)]
        c = [{k: trust * n * x for k, x in quality.ELSEWHERE.items()} for _ in range(rules)]
        for v in cast.values():
            likelihood = [prior] + [weight[j] * defect[j][v[j]] / clean[j][v[j]] for j in range(rules)]
            post = [x / sum(likelihood) for x in likelihood]
            good += post[0]
            for j in range(rules):
                new_weight[j] += post[j + 1]
                d[j][v[j]] += post[j + 1]
                c[j][v[j]] += 1 - post[j + 1]
        mass = good + sum(new_weight)
        moved, prior = abs(prior - good / mass), good / mass
        weight = [x / mass for x in new_weight]
        defect = [{k: x / sum(r.values()) for k, x in r.items()} for r in d]
        clean = [{k: x / sum(r.values()) for k, x in r.items()} for r in c]
        if moved < 1e-9:
            break
    out = {}
    for k, v in cast.items():
        q = measured[k]
        likelihood = [prior] + [weight[j] * defect[j][v[j]] / clean[j][v[j]] for j in range(rules)]
        p = likelihood[0] / sum(likelihood)
        failed = q.n_words < 50 or 100 * q.n_repeat_words > 50 * q.n_words
        out[k] = (failed, p, not failed and p >= 0.5)
    return out


def test_verdicts_equal_brute_force(spark, docs):
    rng = random.Random(14)
    more = [(1000 + i, words(rng, 90, 4000) + (" ##$$%%" * 30 if i % 9 == 0 else "") + ("! " * 40 if i % 7 == 0 else "") + ("\nsame line" * 20 if i % 5 == 0 else "")) for i in range(90)]
    df = docs.select("doc_id", "text").unionByName(spark.createDataFrame([*more, (2000, words(rng, 60_000, 9000))], "doc_id long, text string"))
    want = brute_verdicts({r.doc_id: r.q for r in quality.with_measures(df).collect()})
    got = {r.doc_id: (r.q.base_failed, r.q.p_good, r.q.kept) for r in quality.quality(df).collect()}
    assert {k: (v[0], v[2]) for k, v in got.items()} == {k: (v[0], v[2]) for k, v in want.items()}
    assert all(got[k][1] == pytest.approx(want[k][1], abs=1e-6) for k in want)
    assert {v[2] for v in got.values()} == {True, False}


# --- op7 -----------------------------------------------------------------------------------------------------------------


def test_placement_equals_brute_force(spark, monkeypatch):
    rng = random.Random(15)
    rows = [(i, "hot text" if i % 3 == 0 else words(rng, rng.randrange(1, 60))) for i in range(900)] + [(None, None), (7, "hot text"), (7, "hot text"), (901, words(rng, 30_000))]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(6)
    seen = {}
    real = sharding.sampled_splitters
    monkeypatch.setattr(sharding, "sampled_splitters", lambda keys, *a, **k: seen.update(cuts=real(keys, *a, **k), keys=keys.collect()) or seen["cuts"])
    shards, ranges, per = 5, 16, 12
    got = Counter((r.doc_id, r.size, r.text_crc32, r.shard, r.slot) for r in sharding.shard_by_bytes(df, shards=shards, ranges=ranges, sample=400, pieces_a_shard=per).collect())
    # The same from the written keys, in plain Python.
    keys, cuts = seen["keys"], seen["cuts"]
    assert len(keys) == len(rows) and 5 <= len(cuts) < ranges
    total = sum(r.size for r in keys)
    limit = max(1.0, total / (shards * per))

    def parts(members, key):
        lo, hi = min(r[key] for r in members), max(r[key] for r in members)
        n = math.ceil(sum(r.size for r in members) / limit)
        out = defaultdict(list)
        for r in members:
            share = (float(r[key]) - float(lo)) / (float(hi) - float(lo)) if float(hi) > float(lo) else 0.0
            out[min(math.floor(share * n), n - 1)].append(r)
        return [out[k] for k in sorted(out)]

    by_range = defaultdict(list)
    for r in keys:
        by_range[sum((r.k1, r.k2) >= c for c in cuts)].append(r)
    line = [p2 for k in sorted(by_range) for p1 in parts(by_range[k], "k1") for p2 in parts(p1, "k2")]
    want, before, slots = Counter(), 0, Counter()
    for piece in line:
        size = sum(r.size for r in piece)
        shard = min(math.floor((before + size / 2) * shards / total), shards - 1)
        for r in sorted(piece, key=lambda r: (r.k1, r.k2)):
            want[(r.doc_id, r.size, r.text_crc32, shard, slots[shard])] += 1
            slots[shard] += 1
        before += size
    assert got == want


def test_boundaries_come_from_the_splitters(docs, monkeypatch):
    place = lambda: {r.doc_id: (r.shard, r.slot) for r in sharding.shard_by_bytes(docs, shards=4, ranges=8, sample=200, pieces_a_shard=4).collect()}
    with_them = place()
    monkeypatch.setattr(sharding, "sampled_splitters", lambda *a, **k: [])
    assert place() != with_them


# --- pipeline ------------------------------------------------------------------------------------------------------------


def test_stages_keep_clashing_columns(spark, docs, nothing, tmp_path):
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, "not in any text")], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        for df in (docs, nothing):
            out = stage(spark, df, str(tmp_path))
            assert out.columns == df.columns
            for r in out.collect():
                assert all(r[c] == f"own {c}" for c in ("p", "__m", "hits", "__key", "__QUALITY", "__copies"))
    assert corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).count() == docs.count()


def test_shared_folder_is_needed_on_a_cluster(spark):
    class Elsewhere:
        conf = {}

        class sparkContext:
            master = "spark://host:7077"

    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        common.shared_dir(Elsewhere)
    Elsewhere.sparkContext.master = "local[4]"
    assert common.shared_dir(Elsewhere).startswith("file://")


def test_sweep_deletes_what_was_written(spark):
    df = common.materialize(spark.range(5), "swept")
    assert df.count() == 5
    keep, common._WRITTEN[:] = common._WRITTEN[:-1], common._WRITTEN[-1:]
    common.sweep(spark)
    common._WRITTEN[:] = keep
    with pytest.raises(Exception, match="FILE_NOT_EXIST|FileNotFound|does not exist|PATH_NOT_FOUND"):
        spark.read.schema("id long").parquet(df.inputFiles()[0]).count()
