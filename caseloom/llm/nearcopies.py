"""Near copies by similarity: word shingles of five, Jaccard similarity of at least 0.8 on their sets.

Candidates come from SimHash first: every text has op1's fingerprint, and the Gray-order index of ``simhash`` names the
pairs within its radius. Fingerprints at similarity 0.8 differ in about 10 bits, so for pairs beyond that radius there
are MinHash bands beside it: 24 bands of 5 minima, so two texts at similarity s share a band with probability
1 - (1 - s^5)^24, which is 0.99993 at 0.8 and 0.999999 at 0.85. A link needs the similarity itself, counted on the two
shingle sets (of 64-bit hashes), whatever index and bands say. Texts with equal sets collapse first. A first round checks the
index's pairs and each set with one popular member of its bands, which settles most of a group of copies. Members of bands that are not one
component by then are settled by prefixes, without going through a band's pairs: with shingles in the order of their
rarity, two sets of n and m shingles that have at least t = 4/9 (n + m) in common share a shingle among the first
n - t + 1 of the one and m - t + 1 of the other. Shingles that one edit made are in no other set, so a text with more of
them than its prefix holds meets no other at all, however many texts share its band. Bands of at most eight members list
their pairs instead. No band has a cap.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import repeat

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from caseloom.llm.common import discard, materialize, ship_package, small_batches
from caseloom.llm.simhash import components, fingerprint, links

SHINGLE = 5
BANDS = 24
ROWS = 5
#: A band of so few members may list its pairs, which are fewer than their shingles.
FEW = 8
#: Least similarity of a link, as a fraction of whole numbers.
SIMILAR = (4, 5)

_draw = np.random.default_rng(20)
_SEEDS = _draw.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64)
_ODD = _draw.integers(0, 1 << 64, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None) -> np.ndarray:
    """Sorted distinct hashes of the runs of five words; words as in op1. A shorter text is one shingle; none without words."""
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return np.zeros(0, np.uint64)
    each = np.fromiter(map(xxh64_intdigest, words, repeat(42)), np.uint64, len(words))
    n = max(1, len(words) - SHINGLE + 1)
    out = np.zeros(n, np.uint64)
    for k in range(min(SHINGLE, len(words))):
        out = _mix(out + each[k : k + n])
    return np.unique(out)


def bands(shingles: np.ndarray) -> np.ndarray:
    """One key a band, of its number and its minima; no keys without shingles."""
    if not len(shingles):
        return np.zeros(0, np.uint64)
    low = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, np.uint64)
    for at in range(0, len(shingles), 1 << 12):  # bounded for very long texts
        low = np.minimum(low, ((shingles[at : at + (1 << 12), None] ^ _SEEDS) * _ODD).min(axis=0))
    low, key = low.reshape(BANDS, ROWS), _mix(np.arange(1, BANDS + 1, dtype=np.uint64))
    for r in range(ROWS):
        key = _mix(key + low[:, r])
    return key


def _signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def _signatures(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for batch in texts:
        sets = [shingle_set(t) for t in batch]
        fps = _signed(np.array([fingerprint(t) for t in batch], np.uint64))
        yield pd.DataFrame({"set": [hashlib.blake2b(s.tobytes(), digest_size=16).digest() for s in sets], "bands": [_signed(bands(s)) for s in sets], "fp": fps})


def _shingles(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series([_signed(shingle_set(t)) for t in batch])


def _index_pairs(marked: DataFrame) -> DataFrame:
    """Pairs (a, b) of different sets from SimHash's index over the fingerprints of ``marked`` (set, fp): the links of
    the index, between one set of each fingerprint, and every other set of a fingerprint with that one. They connect what
    is within the radius; a pair that they connect only through a set similar to neither is left to the bands."""
    one = materialize(marked.groupBy("fp").agg(F.min("set").alias("set")), "fingerprint-sets")
    linked = links(one.select("fp"))
    across = linked.join(one.toDF("a", "sa"), "a").join(one.toDF("b", "sb"), "b").select("sa", "sb")
    within = marked.select("fp", "set").distinct().join(one.toDF("fp", "sb"), "fp").select(F.col("set").alias("sa"), "sb")
    pairs = across.unionByName(within).where("sa <> sb").select(F.least("sa", "sb").alias("a"), F.greatest("sa", "sb").alias("b"))
    pairs = materialize(pairs.distinct(), "index-pairs")
    discard(linked)
    discard(one)
    return pairs


def _similar(pairs: DataFrame, shingles: DataFrame) -> DataFrame:
    """The pairs (a, b) of sets that are similar enough. Sizes too far apart go before the sets are read."""
    num, den = SIMILAR
    size = shingles.select("set", "n")
    pairs = pairs.join(size.toDF("a", "na"), "a").join(size.toDF("b", "nb"), "b").where(F.least("na", "nb") * den >= F.greatest("na", "nb") * num)
    full = shingles.select("set", "shingles")
    both = F.size(F.array_intersect("sa", "sb")).cast("long")
    met = pairs.join(full.toDF("a", "sa"), "a").join(full.toDF("b", "sb"), "b").select("a", "b", "na", "nb", both.alias("both"))
    return met.where(F.col("both") * (num + den) >= (F.col("na") + F.col("nb")) * num).select("a", "b")


def _prefixes(members: DataFrame) -> DataFrame:
    """(shingle, set, root, n, place): the first shingles of each member in order of rarity among ``members`` (set, root,
    n, shingles), as many as any partner could require; those that only one member has meet nobody and are left out."""
    num, den = SIMILAR
    each = materialize(members.select("set", "root", "n", F.explode("shingles").alias("shingle")), "open-shingles")
    often = materialize(each.groupBy("shingle").agg(F.count("*").alias("often")).where("often > 1"), "often")
    # A shingle that is missing in ``often`` comes first, and only the number of such ones matters.
    known = each.join(often, "shingle").groupBy("set").agg(F.first("root").alias("root"), F.first("n").alias("n"), F.sort_array(F.collect_list(F.struct("often", "shingle"))).alias("s"))
    rare = F.col("n") - F.size("s")
    most = F.col("n") + F.floor(-F.col("n") * num / den) + 1
    first = F.slice("s", 1, F.greatest(F.lit(0), most - rare).cast("int"))
    out = materialize(known.select("set", "root", "n", rare.alias("rare"), F.posexplode(first).alias("k", "x")).select("x.shingle", "set", "root", "n", (F.col("rare") + F.col("k")).alias("place")), "prefix-shingles")
    discard(each)
    discard(often)
    # A shingle of one component only joins nothing.
    roots = materialize(out.groupBy("shingle").agg(F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("shingle"), "open-prefixes")
    return out.join(roots, "shingle")


def similar_roots(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` of every row and ``root``, the smallest shingle set of its component. ``rows``: doc_id, key
    (one text each), text. Texts without words are one component."""
    spark = rows.sparkSession
    ship_package(spark)
    small_batches(spark)
    sign = F.pandas_udf(_signatures, "set binary, bands array<long>, fp long")
    signed = rows.select("doc_id", "key", sign("text").alias("s")).select("doc_id", "key", "s.set", "s.bands", "s.fp")
    marked = materialize(signed, "shingle-sets")
    indexed = _index_pairs(marked)
    # Equal sets are one member; a bucket of one member has nothing to compare.
    distinct = marked.groupBy("set").agg(F.min("key").alias("key"), F.first("bands").alias("bands"))
    members = distinct.select("set", "key", F.explode("bands").alias("bucket"))
    sizes = members.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1")
    members = materialize(members.join(sizes, "bucket"), "buckets")
    # One text of each member again, as its shingles: for members of the index's pairs and of shared buckets only.
    paired = indexed.select(F.explode(F.array("a", "b")).alias("set")).distinct()
    wanted = members.select("set", "key").unionByName(distinct.join(paired, "set").select("set", "key")).distinct()
    texts = rows.select("key", "text").join(wanted, "key").groupBy("set").agg(F.first("text").alias("text"))
    shingled = texts.select("set", F.pandas_udf(_shingles, "array<long>")("text").alias("shingles"))
    shingles = materialize(shingled.withColumn("n", F.size("shingles").cast("long")), "shingles")
    # First round: the index's pairs, and for what is beyond its radius the member with the most company in a bucket,
    # likely the text that the others were copied from.
    ranked = members.join(members.groupBy("set").agg(F.sum("n").alias("company")), "set")
    head = ranked.groupBy("bucket").agg(F.max(F.struct("company", "set")).alias("head"))
    once = members.join(head, "bucket").groupBy("set").agg(F.max("head").alias("head")).select(F.col("set").alias("a"), F.col("head.set").alias("b")).where("a <> b")
    first = indexed.unionByName(once.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))).distinct()
    edges = materialize(_similar(first, shingles), "near-edges")
    roots = components(edges)
    # Second round: members of bands that are not one component yet, by pairs in small bands and by prefixes in others.
    placed = members.select("bucket", "set").join(roots.toDF("set", "root"), "set", "left").withColumn("root", F.coalesce("root", "set"))
    placed = materialize(placed, "placed")
    split = placed.groupBy("bucket").agg(F.min("root").alias("lo"), F.max("root").alias("hi"), F.count("*").alias("n")).where("lo <> hi")
    split = materialize(split.select("bucket", "n"), "open-buckets")
    few = placed.join(split.where(F.col("n") <= FEW).select("bucket"), "bucket")
    listed = few.toDF("bucket", "a", "ra").join(few.toDF("bucket", "b", "rb"), "bucket").where("a < b and ra <> rb").select("a", "b")
    still = materialize(placed.join(split.where(F.col("n") > FEW).select("bucket"), "bucket").select("set", "root").distinct(), "open-sets")
    prefixes = materialize(_prefixes(shingles.join(still, "set")), "prefixes")
    x, y = prefixes.toDF("shingle", "a", "ra", "na", "ia"), prefixes.toDF("shingle", "b", "rb", "nb", "ib")
    num, den = SIMILAR
    least = -F.floor(-(F.col("na") + F.col("nb")) * num / (num + den))  # shingles in common, at least
    met = (F.col("a") < F.col("b")) & (F.col("ra") != F.col("rb")) & (F.col("ia") <= F.col("na") - least) & (F.col("ib") <= F.col("nb") - least)
    pairs = x.join(y, "shingle").where(met).select("a", "b").unionByName(listed).distinct()
    more = materialize(_similar(pairs, shingles), "near-edges")
    for done in (indexed, members, shingles, placed, split, still, prefixes):
        discard(done)
    roots = components(edges.unionByName(more)).toDF("set", "root")
    return marked.join(roots, "set", "left").select("doc_id", "key", F.coalesce("root", "set").alias("root"))
