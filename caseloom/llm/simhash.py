"""SimHash near-duplicates over a Gray-order hierarchical index.

A link joins fingerprints that differ in at most ``RADIUS`` bits. Documents collapse to distinct fingerprints first.
Upper nodes of the index are shared masked bit patterns: the 64 bits fall into three blocks, and two fingerprints at
two or fewer differences agree on a whole block, so each fingerprint goes under three patterns (block, bits). A node
over ``leaf_limit`` fingerprints gets a level of longer patterns, as the remaining bits again fall into three blocks;
after four levels 12 to 14 bits are free, so no node can hold more than 16,384 distinct fingerprints and none needs a
cap. Inside every node, of whatever size, the fingerprints are sorted by Gray rank; runs of the order share masked bits,
and pairs of runs whose accumulated differences on shared bits exceed the radius are pruned as whole groups. All links
come from this walk. A node passes on a spanning forest of its links, never all pairs. Components then come from star contraction over distributed edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.common import discard, materialize, release_shuffles, ship_package, small_batches, unused

RADIUS = 2
SHINGLE = 3
MASK64 = (1 << 64) - 1
FANOUT = 8


# --- fingerprints ---------------------------------------------------------------------------------------------------


def fingerprint(text: str | None) -> int:
    """64-bit SimHash: bit set when set in over half of the XXH64 hashes (seed 42) of the word shingles.

    Words are runs of bytes other than space and tab to carriage return, ASCII lower-cased; shingles of three words
    count as often as they occur; a shorter text is one shingle; null or no words give zero.
    """
    from xxhash import xxh64_intdigest

    words = text.encode("utf-8", "replace").lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    if len(words) <= SHINGLE:
        hashes = [xxh64_intdigest(line, 42)]
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - SHINGLE + 1]
        hashes = [xxh64_intdigest(line[a:b], 42) for a, b in zip(starts.tolist(), ends[SHINGLE - 1 :].tolist(), strict=True)]
    count = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 16):  # bounded for very long texts
        bits = np.unpackbits(np.array(hashes[at : at + (1 << 16)], dtype="<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        count += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * count > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for batch in texts:
        yield pd.Series(np.array([fingerprint(t) for t in batch], dtype=np.uint64).view(np.int64), dtype="int64")


def with_fingerprint(docs: DataFrame, text_col: str = "text", into: str = "fp") -> DataFrame:
    """``docs`` with its fingerprint as a signed 64-bit column; no shuffle, no change of rows."""
    ship_package(docs.sparkSession)
    small_batches(docs.sparkSession)
    return docs.withColumn(into, F.pandas_udf(_fingerprints, "long")(F.col(text_col)))


def hex_fingerprint(fp: Column) -> Column:
    """Sixteen lower-case hex digits of the unsigned value."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


# --- index ----------------------------------------------------------------------------------------------------------


def split_blocks(mask: int) -> list[int]:
    """The bits of ``mask`` in RADIUS + 1 contiguous masks of near equal size."""
    bits = [b for b in range(64) if mask >> b & 1]
    n = RADIUS + 1
    return [sum(1 << b for b in bits[len(bits) * k // n : len(bits) * (k + 1) // n]) for k in range(n)]


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _children(fp: Column, fixed: int) -> Column:
    """The patterns below a node whose mask is ``fixed``: structs of the longer mask and the bits under it."""
    masks = [fixed | m for m in split_blocks(MASK64 & ~fixed)]
    return F.array(*[F.struct(F.lit(_signed(m)).alias("mask"), fp.bitwiseAND(F.lit(_signed(m))).alias("bits")) for m in masks])


def index_nodes(fps: DataFrame, leaf_limit: int, depth: int = 4) -> DataFrame:
    """(mask, bits, fp) for every node of two or more fingerprints; nodes over ``leaf_limit`` are replaced by a level
    of longer patterns, until a pattern leaves so few bits that the node is small by itself."""
    masks, todo, parts = [0], fps.select("fp", F.lit(0).cast("long").alias("mask")), []
    for level in range(depth):
        below = F.lit(None)
        for m in masks:
            below = F.when(F.col("mask") == _signed(m), _children(F.col("fp"), m)).otherwise(below)
        nodes = todo.select("fp", F.explode(below).alias("n")).select("fp", "n.mask", "n.bits")
        if level:  # two parents may have a child in common
            nodes = nodes.distinct()
        masks = [m | b for m in masks for b in split_blocks(MASK64 & ~m)]
        sizes = nodes.groupBy("mask", "bits").count().where("count > 1")
        nodes = nodes.join(sizes, ["mask", "bits"])
        if level == depth - 1:
            parts.append(nodes.drop("count"))
            break
        nodes = materialize(nodes, "simhash-nodes")
        parts.append(nodes.where(F.col("count") <= leaf_limit).drop("count"))
        todo = nodes.where(F.col("count") > leaf_limit).select("fp", "mask")
        if todo.isEmpty():
            break
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def gray_rank(fp: np.ndarray) -> np.ndarray:
    """Position of each pattern in the reflected Gray order (prefix xor of the bits from the top)."""
    out = fp.copy()
    for s in (1, 2, 4, 8, 16, 32):
        out ^= out >> np.uint64(s)
    return out


class _Forest:
    """Union-find over positions."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def root(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.root(a), self.root(b)
        if a == b:
            return False
        self.parent[max(a, b)] = min(a, b)
        return True

    def labels(self) -> np.ndarray:
        label = np.array(self.parent)
        while (label[label] != label).any():
            label = label[label]
        return label


def node_links(fps: np.ndarray, node: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """Spanning forest of the pairs of distinct fingerprints of one node at ``radius`` or fewer differences; ``node``
    is the number of each fingerprint's node, ascending.

    Every node is a hierarchy over Gray order, and those of a batch are walked together from their tops for pairs of
    groups: a pair carries the differences that the groups' shared bits accumulate, and goes when they exceed the
    radius. Pairs are expanded depth first in chunks, so memory is bounded by the chunk, not by the number of pairs; a
    pair of groups that are one component by then is not expanded.
    """
    order = np.lexsort((gray_rank(fps), node))
    fps, node = fps[order], node[order]
    n = len(fps)
    # Of each level: the groups' first and last leaf, first and last child, bits that all have and that any has.
    levels = [(np.arange(n), np.arange(n) + 1, None, None, fps, fps)]
    while True:
        first, last, _, _, both, either = levels[-1]
        own = node[first]
        new = np.concatenate(([True], own[1:] != own[:-1]))[: len(own)]
        begin = np.flatnonzero(new)
        if len(begin) == len(own):
            break  # each node is one group
        place = np.arange(len(own)) - np.repeat(begin, np.diff(np.append(begin, len(own))))
        at = np.flatnonzero(place % FANOUT == 0)
        until = np.append(at[1:], len(own))
        levels.append((first[at], last[until - 1], at, until, np.bitwise_and.reduceat(both, at), np.bitwise_or.reduceat(either, at)))
    shared = [(x[4], ~(x[4] ^ x[5])) for x in levels]  # values and mask of shared bits
    forest, left, right = _Forest(n), [], []
    label = np.arange(n)
    tops = np.arange(len(levels[-1][0]))
    stack = [(len(levels) - 1, tops, tops)]
    while stack:
        level, a, b = stack.pop()
        if len(a) > 1 << 14:
            half = len(a) // 2
            stack += [(level, a[half:], b[half:]), (level, a[:half], b[:half])]
            continue
        value, mask = shared[level]
        apart = np.bitwise_count((value[a] ^ value[b]) & mask[a] & mask[b])
        keep = apart <= radius
        a, b = a[keep], b[keep]
        if level == 0:
            keep = (a < b) & (label[a] != label[b])
            for x, y in zip(a[keep].tolist(), b[keep].tolist(), strict=True):
                if forest.join(x, y):
                    left.append(x)
                    right.append(y)
            if keep.any():
                label = forest.labels()
            continue
        first, last, child, until = levels[level][:4]
        lo, hi = np.minimum.reduceat(label, first), np.maximum.reduceat(label, first)
        one = (lo[a] == hi[a]) & (lo[b] == hi[b]) & (lo[a] == lo[b])
        a, b = a[~one], b[~one]
        if len(a):
            x = (child[a][:, None] + np.arange(FANOUT))[:, :, None]
            y = (child[b][:, None] + np.arange(FANOUT))[:, None, :]
            ok = (x < until[a][:, None, None]) & (y < until[b][:, None, None]) & (x <= y)
            shape = ok.shape
            stack.append((level - 1, np.broadcast_to(x, shape)[ok], np.broadcast_to(y, shape)[ok]))
    return fps[np.array(left, np.int64)], fps[np.array(right, np.int64)]


def _links(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Links of the nodes of one task; rows come sorted by (mask, bits)."""

    def links(part: pd.DataFrame):
        fp = part["fp"].to_numpy(np.int64).view(np.uint64)
        mask, bits = part["mask"].to_numpy(), part["bits"].to_numpy()
        node = np.cumsum(np.r_[False, (mask[1:] != mask[:-1]) | (bits[1:] != bits[:-1])])
        a, b = node_links(fp, node)
        return pd.DataFrame({"a": a.view(np.int64), "b": b.view(np.int64)})

    held = None
    for batch in batches:
        if not len(batch):
            continue
        held = batch if held is None else pd.concat([held, batch], ignore_index=True)
        last = held.iloc[-1]
        same = (held["mask"] == last["mask"]) & (held["bits"] == last["bits"])
        cut = int((~same).sum())  # the last node may go on in the next batch
        if cut:
            yield links(held.iloc[:cut])
            held = held.iloc[cut:].reset_index(drop=True)
    if held is not None and len(held):
        yield links(held)


def links(fps: DataFrame, leaf_limit: int = 2048) -> DataFrame:
    """Edges (a, b) of distinct fingerprints, enough to connect every pair at RADIUS or fewer differences that share
    an index node; every linked pair shares one. ``fps``: one column ``fp`` of distinct values."""
    nodes = index_nodes(fps, leaf_limit)
    n = int(fps.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = nodes.repartition(n, "mask", "bits").sortWithinPartitions("mask", "bits")
    return dealt.mapInPandas(_links, "a long, b long").distinct()


# --- components -----------------------------------------------------------------------------------------------------


def components(edges: DataFrame, a: str = "a", b: str = "b", max_rounds: int = 60) -> DataFrame:
    """(node, root) for every node with an edge; root is the smallest node of its component.

    Alternates large-star and small-star steps over the edge table: each points nodes to the smallest neighbour, with
    hashed, map-combined minima only. Every round is written to the shared folder; the driver sees two numbers.
    """
    # An edge points from the larger to the smaller node.
    now = materialize(edges.select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).where("u <> v").distinct(), "edges")
    for _ in range(max_rounds):
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        # Minima are written before they are joined: Spark splits a hub's edges only if no aggregate is under the join.
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")), "least")
        large = materialize(both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct(), "large")
        low = materialize(large.groupBy("u").agg(F.min("v").alias("m")), "low")
        met = large.join(low, "u")
        new = met.select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").unionByName(low.select("u", F.col("m").alias("v"))).distinct()
        new = materialize(new, "edges")
        total = lambda d: d.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        done = total(new) == total(now)
        for old in (now, least, large, low):
            discard(old)
        now = new
        if done:
            break
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root"))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", leaf_limit: int = 2048) -> DataFrame:
    """One row per input row: ``doc_id``, ``fp`` (signed 64 bits), ``component_id``.

    Equal fingerprints are linked, null and empty texts (fingerprint zero) like any other. ``component_id`` is the
    smallest id reachable; null ids are ignored there, so it is null only where every id of the component is.
    Repeated rows come back as often as they occur. Other columns of ``docs`` are not read.
    """
    spark = docs.sparkSession
    marked = materialize(with_fingerprint(docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))).select("doc_id", "fp"), "fingerprints")
    lowest = materialize(marked.groupBy("fp").agg(F.min("doc_id").alias("low")), "fingerprint-ids")
    roots = components(links(lowest.select("fp"), leaf_limit))
    linked = materialize(lowest.join(roots.withColumnRenamed("node", "fp"), "fp", "left").withColumn("root", F.coalesce("root", "fp")), "linked")
    least = materialize(linked.groupBy("root").agg(F.min("low").alias("component_id")), "component-ids")
    known = materialize(linked.join(least, "root").select("fp", "component_id"), "known")
    for done in (lowest, linked, least):
        discard(done)
    release_shuffles(spark)
    return marked.join(known, "fp").select("doc_id", "fp", "component_id")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: fingerprint and component of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return near_duplicates(docs).select("doc_id", hex_fingerprint(F.col("fp")).alias("fingerprint"), "component_id")


def with_row_key(docs: DataFrame, id_col: str, text_col: str, into: str) -> DataFrame:
    """``docs`` with a 128-bit key of id and text; null and empty differ. Rows alike in both are one document."""
    mark = lambda c: F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-"))
    return docs.withColumn(into, F.unhex(F.md5(F.concat(mark(id_col), F.lit(" "), mark(text_col)).cast("binary"))))


def fingerprint_roots(rows: DataFrame) -> DataFrame:
    """``doc_id``, ``key`` of every row and ``root``, the smallest fingerprint of its component. ``rows``: doc_id, key, text."""
    marked = materialize(with_fingerprint(rows).select("doc_id", "key", "fp"), "fingerprints")
    roots = components(links(marked.select("fp").distinct(), 2048)).withColumnRenamed("node", "fp")
    return marked.join(roots, "fp", "left").select("doc_id", "key", F.coalesce("root", "fp").alias("root"))


def one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", near=fingerprint_roots) -> DataFrame:
    """The documents, one of each near-duplicate component: the one with the smallest id (null ids last, and of rows
    with the same id the one with the smallest key). All columns stay. ``near`` names every row's component.

    Survivors are rows, not ids: an id may be null or stand for several texts.
    """
    mark = unused(docs, "__key")
    keyed = with_row_key(docs, id_col, text_col, mark)
    rows = near(keyed.select(F.col(id_col).alias("doc_id"), F.col(mark).alias("key"), F.col(text_col).alias("text")))
    per = materialize(rows.groupBy("root", "key").agg(F.min("doc_id").alias("id"), F.count("*").alias("n")), "row-keys")
    first = materialize(per.groupBy("root").agg(F.min(F.struct(F.col("id").isNull().alias("no_id"), "id", "key")).alias("first")), "first-rows")
    settled = materialize(per.join(first, "root").select(F.col("key").alias(mark), "n", (F.col("key") == F.col("first.key")).alias("stays")), "survivors")
    discard(per)
    discard(first)
    release_shuffles(docs.sparkSession)
    kept = keyed.join(settled.where("not stays").select(mark), mark, "left_anti")
    again = settled.where("stays and n > 1").select(mark)
    if not again.isEmpty():  # only rows that occur several times move for this
        kept = kept.join(again, mark, "left_anti").unionByName(kept.join(again, mark, "left_semi").dropDuplicates([mark]))
    return kept.select(*[F.col(f"`{c}`") for c in docs.columns])
