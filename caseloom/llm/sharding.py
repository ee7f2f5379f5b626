"""Shards of near equal bytes by sampled splitters, in DataFrame functions only.

The order is by (hash of the text, hash of the id and the row). A size-weighted sample of these keys gives quantile
boundaries, and records are partitioned into the ranges between them. A range over ``piece`` bytes, ``piece`` being a
small fixed share of a shard, is overfull and is cut at equal steps of the text's hash between its ends; a piece that
is still overfull, as that of a hot text, is cut at equal steps of the second hash. A shard is a run of whole pieces:
those whose middle lies in its share of all bytes. So shard boundaries are sampled quantiles or cuts of overfull
ranges, and shards differ by about a piece or a record, whichever is larger. Equal texts lie together unless a cut by
the second hash parts them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.llm.common import materialize, table

LAW = "bytes"
OVERHEAD = 8


def sampled_splitters(keys: DataFrame, ranges: int, sample: int, seed: int = 7) -> list[tuple[int, int]]:
    """Quantile boundaries over (k1, k2) from a sample that takes a row with probability size * sample / total.

    About ``sample`` pairs of longs come to the driver, whatever the number of rows. The draw is a hash of the row's
    keys, so a lost task draws the same rows again.
    """
    total = keys.agg(F.sum("size")).first()[0] or 0
    if not total or ranges < 2:
        return []
    draw = F.abs(F.xxhash64("k1", "k2", "doc_id", F.lit(seed)) % F.lit(1 << 40)) / F.lit(float(1 << 40))
    chance = F.col("size") * F.lit(sample / total)
    # A row over one sample step stands for as many steps as it is long.
    drawn = keys.where(draw < chance).select("k1", "k2", F.greatest(F.lit(1.0), chance).alias("w"))
    rows = sorted((r.k1, r.k2, r.w) for r in drawn.collect())
    weight, cuts, run, step = sum(r[2] for r in rows), [], 0.0, 1
    for k1, k2, w in rows:
        run += w
        while step < ranges and run >= weight * step / ranges:
            cuts.append((k1, k2))
            step += 1
    return sorted(set(cuts))


def range_of(k1: Column, k2: Column, cuts: list[tuple[int, int]]) -> Column:
    """Index of the range a key falls in, by a binary decision tree: log2(ranges) comparisons a row."""

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        a, b = cuts[mid]
        return F.when((k1 < a) | ((k1 == a) & (k2 < b)), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(cuts))


def _share(x: Column, lo: Column, hi: Column) -> Column:
    """Position of a key between the ends of its range, 0 to 1."""
    x, lo, hi = (c.cast("double") for c in (x, lo, hi))
    return F.when(hi > lo, (x - lo) / (hi - lo)).otherwise(0.0)


def shard_by_bytes(docs: DataFrame, shards: int = 24, id_col: str = "doc_id", text_col: str = "text", ranges: int = 192, sample: int = 19_200, pieces_a_shard: int = 400, piece_rows: int | None = None) -> DataFrame:
    """One row per input row: doc_id, size, text_crc32, shard, slot.

    Size is the text's UTF-8 bytes (null: none) plus 8. Shards are runs of pieces of about a ``pieces_a_shard``-th of a
    shard; slots count from 0 in key order without gaps. Repeated rows are told apart by their place in a table that is
    written once. Fewer rows than shards leave shards empty; an empty table gives no rows. Texts are read once and never
    shuffled: only ids, hashes and sizes move. Other columns of ``docs`` are not read. Pieces are at most about
    ranges + shards * pieces_a_shard, whatever the number of rows; ``piece_rows`` also cuts pieces of more rows than that,
    and then Spark decides how to join the table of pieces, which grows with the rows.
    """
    whole = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keys = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(whole) + OVERHEAD).cast("long").alias("size"),
        F.crc32(whole.cast("binary")).alias("text_crc32"),
        F.xxhash64(whole).alias("k1"),
        F.xxhash64(F.col(id_col), F.monotonically_increasing_id()).alias("k2"),
    )
    keys = materialize(keys, "shard-keys")
    total = keys.agg(F.sum("size")).first()[0] or 1
    limit = max(1.0, total / (shards * pieces_a_shard))
    cuts = sampled_splitters(keys, ranges, sample)
    keys = keys.withColumn("range", range_of(F.col("k1"), F.col("k2"), cuts))

    small = F.broadcast if piece_rows is None else lambda parts: parts  # bounded by parameters, see above

    def subdivide(rows_: DataFrame, level: list[str], key: str, into: str) -> DataFrame:
        """Cut what is over ``limit`` bytes at equal steps of ``key``."""
        found = rows_.groupBy(*level).agg(F.sum("size").alias("__bytes"), F.count("*").alias("__n"), F.min(key).alias("__lo"), F.max(key).alias("__hi"))
        pieces = F.ceil(F.col("__bytes") / limit)
        pieces = pieces if piece_rows is None else F.greatest(pieces, F.ceil(F.col("__n") / piece_rows))
        place = F.least(F.floor(_share(F.col(key), F.col("__lo"), F.col("__hi")) * pieces), pieces - 1).cast("long")
        return rows_.join(small(found), level).select(*rows_.columns, place.alias(into))

    placed = subdivide(keys, ["range"], "k1", "piece1")
    placed = subdivide(placed, ["range", "piece1"], "k2", "piece2")
    placed = materialize(placed, "shard-pieces")

    piece = ["range", "piece1", "piece2"]
    line = Window.orderBy(*piece).rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(line), F.lit(0))
    per_piece = placed.groupBy(*piece).agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"))
    middle = before("bytes") + F.col("bytes") / 2
    shard = F.least(F.floor(middle * shards / total), F.lit(shards - 1)).cast("int")
    per_piece = per_piece.select(*piece, "rows", shard.alias("shard"), before("rows").alias("rows_before"))
    own = Window.partitionBy("shard")
    per_piece = per_piece.select(*piece, "shard", (F.col("rows_before") - F.min("rows_before").over(own)).alias("rows_before"))
    inside = Window.partitionBy(*piece).orderBy("k1", "k2")
    at = placed.withColumn("row", F.row_number().over(inside)).join(small(per_piece), piece)
    return at.select("doc_id", "size", "text_crc32", "shard", (F.col("rows_before") + F.col("row") - 1).alias("slot"))


def op7_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: 24 shards of near equal bytes."""
    placed = shard_by_bytes(table(spark, sf_dir, "documents"))
    return placed.select("doc_id", "size", "text_crc32", F.lit(LAW).alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
