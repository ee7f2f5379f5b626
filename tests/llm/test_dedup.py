"""SimHash, byte-run and word-run dedup against brute force."""

import collections
import hashlib
import random
import re

import numpy as np
from xxhash import xxh64_intdigest

from caseloom.llm import bwt, simhash, substring, suffix

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute_fingerprint(t):
    w = WORD.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in t or ""))
    if not w:
        return 0
    h = [xxh64_intdigest(" ".join(w[i : i + 3]).encode(), 42) for i in range(max(1, len(w) - 2))]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute_components(fps):
    fps = sorted(set(fps))
    root = {f: f for f in fps}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, a in enumerate(fps):
        for b in fps[i + 1 :]:
            if (a ^ b).bit_count() <= 2:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {f: find(f) for f in fps}


def test_fingerprints_and_components(docs, texts):
    got = {r.doc_id: (r.fp & simhash.MASK64, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    fps = {i: brute_fingerprint(t) for i, t in texts.items()}
    assert {i: g[0] for i, g in got.items()} == fps
    roots = brute_components(fps.values())
    low = collections.defaultdict(lambda: 10**9)
    for i, f in fps.items():
        low[roots[f]] = min(low[roots[f]], i)
    assert {i: g[1] for i, g in got.items()} == {i: low[roots[f]] for i, f in fps.items()}


def test_index_splits_hot_nodes_without_losing_links(spark):
    rng, fps = random.Random(1), set()
    for _ in range(3):
        centre = rng.getrandbits(64)
        for _ in range(150):
            x = centre
            for _ in range(rng.randrange(5)):
                x ^= 1 << rng.randrange(64)
            fps.add(x)
    df = spark.createDataFrame([(x - (1 << 64) if x >> 63 else x,) for x in fps], "fp long")
    want = brute_components(fps)
    for leaf in (4, 2048):
        found = {r.node & simhash.MASK64: r.root & simhash.MASK64 for r in simhash.components(simhash.links(df, leaf)).collect()}
        groups = lambda m: sorted(sorted(g) for g in _groups(fps, m))
        assert groups(lambda f: found.get(f, f)) == groups(lambda f: want[f])


def _groups(items, key):
    out = collections.defaultdict(set)
    for x in items:
        out[key(x)].add(x)
    return out.values()


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)], "a long, b long")
    assert {r.root for r in simhash.components(edges).collect()} == {0}


def test_one_of_each(docs, awkward, nothing):
    kept = simhash.one_of_each(docs)
    assert kept.columns == docs.columns
    near = simhash.near_duplicates(docs)
    assert {r.doc_id for r in kept.collect()} == {r.component_id for r in near.collect()}
    assert sorted(r.doc_id for r in simhash.one_of_each(awkward).collect()) in ([1, 3], [1, 3, 4])
    assert simhash.one_of_each(nothing).collect() == [] and simhash.near_duplicates(nothing).collect() == []
    assert simhash.near_duplicates(awkward).count() == 6


def test_one_of_each_settles_rows_not_ids(spark):
    a, b, c, d = (" ".join(f"{w}{k}" for k in range(60)) for w in "abcd")
    keep = lambda rows: sorted((str(r.doc_id), r.text[0]) for r in simhash.one_of_each(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    # A null id beside a copy with an id takes no other null id with it; a component of null ids keeps one row.
    assert keep([(1, a), (None, a), (None, b), (None, c), (None, c)]) == [("1", "a"), ("None", "b"), ("None", "c")]
    # An id with two texts: its loss under one text is not that of the other, and no component goes as a whole.
    assert keep([(3, a), (5, a), (5, b), (7, b), (1, d), (5, d), (5, d)]) == [("1", "d"), ("3", "a"), ("5", "b")]
    assert keep([(5, a), (5, a), (6, b)]) == [("5", "a"), ("6", "b")]


def brute_bytes(texts, length=50):
    first = {}
    for i, t in sorted(texts.items()):
        b = (t or "").encode()
        for p in range(len(b) - length + 1):
            first.setdefault(b[p : p + length], i)
    out = {}
    for i, t in texts.items():
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < i:
                gone[p : p + length] = b"\1" * length
        spans = sum(1 for j in range(len(gone)) if gone[j] and (j == 0 or not gone[j - 1]))
        out[i] = (len(b), sum(gone), spans, hashlib.sha256(bytes(x for x, g in zip(b, gone, strict=True) if not g)).hexdigest())
    return out


def test_byte_runs(docs, texts, awkward, nothing):
    got = {r.doc_id: (r.n_bytes, r.n_removed, r.n_spans, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in suffix.dedup_bytes(docs).collect()}
    assert got == brute_bytes(texts)
    assert suffix.dedup_bytes(nothing).collect() == []
    rows = suffix.dedup_bytes(awkward).collect()
    assert len(rows) == 6
    assert sorted(r.n_removed for r in rows if r.doc_id == 1) == [0, 0]  # equal ids remove nothing from each other
    assert [r.n_removed == r.n_bytes for r in rows if r.doc_id is None and r.n_bytes] == [True]  # a null id is the last


def test_hot_anchor_path_agrees(docs):
    rows = docs.where("text is not null").dropDuplicates(["text"]).selectExpr("doc_id row_id", "doc_id id", "text")

    def cover(d):
        return {r.row_id: suffix.cut_spans(b"x" * 100_000, np.array([s.start for s in r.spans]), np.array([s.end for s in r.spans]))[0] for r in d.collect()}

    assert cover(suffix.spans_to_remove(rows)) == cover(suffix.spans_to_remove(rows, hot=1, block_bytes=1 << 12))


def test_bwt_merge():
    rng = random.Random(2)
    for _ in range(60):
        strings = [bytes(rng.choice(b"ab\0") for _ in range(rng.randrange(30))) for _ in range(rng.randrange(1, 12))]
        shard = bwt.Shard(strings)
        order = [tuple(x + 1 for x in strings[o][p:]) for o, p in zip(shard.owner, shard.offset, strict=True)]
        assert order == sorted(order)
        depth = rng.randrange(1, 8)
        want = collections.defaultdict(set)
        for i, s in enumerate(strings):
            for j in range(len(s) - depth + 1):
                want[s[j : j + depth]].add((i, j))
        for size in (10, 1000):
            got = collections.defaultdict(set)
            for a, b, c in zip(*(x.tolist() for x in bwt.repeated_intervals(strings, depth, size)), strict=True):
                got[c].add((a, b))
            assert sorted(map(sorted, got.values())) == sorted(sorted(v) for v in want.values() if len(v) > 1)


def brute_words(texts, length=35):
    count = collections.Counter()
    split = {i: WORD.findall(t or "") for i, t in texts.items()}
    for w in split.values():
        count.update(tuple(w[p : p + length]) for p in range(len(w) - length + 1))
    out = {}
    for i, w in split.items():
        gone = [False] * len(w)
        for p in range(len(w) - length + 1):
            if count[tuple(w[p : p + length])] > 1:
                gone[p : p + length] = [True] * length
        out[i] = (len(w), sum(gone), " ".join(x for x, g in zip(w, gone, strict=True) if not g))
    return out


def test_word_runs(docs, texts, awkward, nothing):
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept) for r in substring.dedup_words(docs).collect()} == brute_words(texts)
    assert substring.dedup_words(nothing).collect() == []
    rows = substring.dedup_words(awkward).collect()
    assert len(rows) == 6 and all(r.n_removed == r.n_words for r in rows if r.doc_id == 1)


def test_difference_cover_aligns_any_two_places():
    v = substring.PERIOD
    assert all(any((i + s) % v in substring.COVER and (j + s) % v in substring.COVER for s in range(v)) for i in range(v) for j in range(v))
