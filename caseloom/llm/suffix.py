"""Exact byte-run dedup across documents with merged Burrows-Wheeler transforms.

A byte goes when a string of ``length`` bytes over it also starts in a document with a smaller id.

1. Equal texts are settled by their digest: all but the smallest id go whole, and only one stands for them below.
2. Each string of ``length`` bytes names an anchor: its least-hashed inner gram, the leftmost of ties. Equal strings
   name equal anchors wherever they are, so strings are compared only under anchors that two documents share.
   Neighbouring strings with one anchor make a fragment; equal fragments of all documents are one, with the smallest
   id that has it.
3. An anchor with one distinct fragment is a set of one string, which has nothing to merge. The fragments of all
   others are fetched, dealt by anchor, and repeated intervals of ``length`` bytes are read off the merged transforms
   of each block of fragments. An anchor with more fragments than ``hot`` is not merged: its single strings of
   ``length`` bytes are grouped by their bytes, so no block has to hold a hot anchor.
4. Each string's smallest id, from its interval, goes back to the documents that have the fragment.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from caseloom.llm.bwt import repeated_intervals
from caseloom.llm.common import discard, integer_id, joined_id, materialize, release_shuffles, ship_package, small_batches, split_id

LENGTH, GRAM = 50, 20
#: Bytes hashed at once; a longer text goes in overlapping pieces.
CHUNK = 1 << 21
LAST = (1 << 63) - 1
U = np.uint64
BASE = 0x9E3779B97F4A7C15
_POWERS: list[np.ndarray] = []


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE ** i and its inverse modulo 2**64, for i below n; kept per worker."""
    if not _POWERS or len(_POWERS[0]) < n:
        out = []
        for base in (BASE, pow(BASE, -1, 1 << 64)):
            x = np.full(n, base & ((1 << 64) - 1), U)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        _POWERS[:] = out
    return _POWERS[0], _POWERS[1]


def gram_hashes(b: np.ndarray) -> np.ndarray:
    """64-bit hash of every run of GRAM (20) bytes, from three 8-byte words that cover it."""
    n = len(b) - GRAM + 1
    padded = np.zeros(len(b) + 16, np.uint8)
    padded[: len(b)] = b
    word = np.empty(len(b) + 8, U)
    for r in range(8):
        v = np.frombuffer(padded.data, "<u8", (len(padded) - r) // 8, r)
        word[r::8] = v[: len(word[r::8])]
    h = word[8 : 8 + n] * U(0xC2B2AE3D27D4EB4F)
    h >>= U(7)
    h ^= word[:n] * U(BASE)
    h *= U(0xFF51AFD7ED558CCD)
    h ^= word[GRAM - 8 : GRAM - 8 + n] * U(0xD6E8FEB86659FD93)
    h ^= h >> U(29)
    h *= U(0xBF58476D1CE4E5B9)
    h ^= h >> U(32)
    return h


def fragments(b: np.ndarray, ends: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Fragments of texts laid end to end in ``b`` (their ends given): (first string's start, number of strings, anchor,
    hash of the fragment's bytes). No string crosses an end."""
    if len(b) < length:
        return (np.zeros(0, np.int64),) * 2 + (np.zeros(0, U),) * 2
    h = gram_hashes(b)
    low = U((1 << 24) - 1)
    best, width, window = (h & ~low) | np.arange(len(h), dtype=U), 1, length - GRAM + 1
    while 2 * width <= window:
        best = np.minimum(best[:-width], best[width:])
        width *= 2
    if width < window:
        best = np.minimum(best[: len(best) - (window - width)], best[window - width :])
    at = (best & low).astype(np.int64)
    over = (ends[:, None] - np.arange(1, length)).ravel()  # strings that would cross the end of their text
    at[over[(over >= 0) & (over < len(at))]] = -1
    start = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    count = np.diff(np.append(start, len(at)))
    real = at[start] >= 0
    start, count = start[real], count[real]
    power, inverse = _powers(CHUNK + length)
    total = np.concatenate((np.zeros(1, U), np.cumsum(h * power[: len(h)], dtype=U)))
    whole = (total[start + count - 1 + length - GRAM + 1] - total[start]) * inverse[start]
    whole ^= whole >> U(31)
    whole *= U(0xD6E8FEB86659FD93)
    return start, count, h[at[start]], whole ^ (whole >> U(32))


def batch_fragments(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH):
    """Yield (text number, start in the text, count, anchor, hash) arrays for texts in one buffer; ``offsets`` as in
    Arrow. Texts go together up to CHUNK bytes; a longer one in pieces that overlap by a string less a byte. A piece's
    end may cut a fragment in two, which changes no string's anchor."""
    i, n = 0, len(offsets) - 1
    while i < n:
        if offsets[i + 1] - offsets[i] > CHUNK:
            for a in range(int(offsets[i]), int(offsets[i + 1]) - length + 1, CHUNK):
                z = min(int(offsets[i + 1]), a + CHUNK + length - 1)
                start, count, anchor, whole = fragments(data[a:z], np.array([z - a]), length)
                yield np.full(len(start), i), start + a - int(offsets[i]), count, anchor, whole
            i += 1
            continue
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + CHUNK, side="right")) - 1)
        ends = offsets[i + 1 : j + 1] - offsets[i]
        start, count, anchor, whole = fragments(data[offsets[i] : offsets[j]], ends, length)
        who = np.searchsorted(ends, start, side="right")
        yield who + i, start - np.concatenate(([0], ends))[who], count, anchor, whole
        i = j


def _texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of an Arrow string column, without copying texts."""
    kind = np.int64 if pa.types.is_large_string(column.type) else np.int32
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, kind, len(column) + 1, column.offset * np.dtype(kind).itemsize).astype(np.int64)
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at


def _emit(full: bool, length: int, unique: bool):
    """Anchors of each text: (h, id) or (h, id, place, f), place = start * 256 + count; with row_id where ids repeat."""

    def emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, rows = batch.column("id").to_numpy(), batch.column("row_id").to_numpy()
            data, offsets = _texts(batch.column("text"))
            for who, start, count, anchor, whole in batch_fragments(data, offsets, length):
                out = {"h": anchor.view(np.int64), "id": ids[who]}
                if full:
                    out |= {"place": start * 256 + count, "f": whole.view(np.int64)} | ({} if unique else {"row_id": rows[who]})
                for a in range(0, len(who), 1 << 16):
                    yield pa.RecordBatch.from_arrays([pa.array(v[a : a + (1 << 16)]) for v in out.values()], names=list(out))

    return emit


def _fetch(length: int):
    """Bytes of the fragments named in ``want``."""

    def fetch(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            h, f, low, frag = [], [], [], []
            for text, want in zip(batch["text"], batch["want"], strict=True):
                data = _bytes(text)
                for x in want:
                    start, count = divmod(x["place"], 256)
                    h.append(x["h"])
                    f.append(x["f"])
                    low.append(x["low"])
                    frag.append(data[start : start + count - 1 + length])
            yield pd.DataFrame({"h": h, "f": f, "low": low, "frag": frag})

    return fetch


def _bytes(text: str | None) -> bytes:
    return text.encode("utf-8", "surrogatepass") if text else b""


def _resolve(length: int, block_bytes: int):
    """Per distinct fragment the runs of strings with one smallest id: (h, f, runs of (t, k, low))."""

    def block(part: pd.DataFrame) -> pd.DataFrame:
        frags, low = part["frag"].tolist(), part["low"].to_numpy(np.int64)
        count = np.fromiter(map(len, frags), np.int64, len(frags)) - length + 1
        first = np.cumsum(count) - count
        best = np.repeat(low, count)  # of every string of every fragment
        string, offset, interval = repeated_intervals(frags, length)
        if len(string):
            turn = np.argsort(interval, kind="stable")
            string, offset, interval = string[turn], offset[turn], interval[turn]
            start = np.flatnonzero(np.concatenate(([True], interval[1:] != interval[:-1])))
            least = np.minimum.reduceat(low[string], start)
            best[first[string] + offset] = np.repeat(least, np.diff(np.append(start, len(string))))
        owner = np.repeat(np.arange(len(frags)), count)
        cut = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (best[1:] != best[:-1]))))
        size = np.diff(np.append(cut, len(best)))
        begin = np.flatnonzero(np.concatenate(([True], owner[cut][1:] != owner[cut][:-1])))
        split = lambda x: np.split(x, begin[1:])
        return pd.DataFrame({"h": part["h"].to_numpy(), "f": part["f"].to_numpy(), "t": split((cut - first[owner[cut]]).astype(np.int32)), "k": split(size.astype(np.int32)), "low": split(best[cut])})

    def resolve(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        held, size = [], 0
        for batch in batches:
            held.append(batch)
            size += int(batch["frag"].map(len).sum())
            if size >= block_bytes:
                rows = pd.concat(held, ignore_index=True)
                # Rows come sorted by anchor; the last one may go on in the next batch.
                cut = int((rows["h"] != rows["h"].iloc[-1]).sum())
                if cut:
                    yield block(rows.iloc[:cut])
                held = [rows.iloc[cut:].reset_index(drop=True)]
                size = int(held[0]["frag"].map(len).sum())
        if held:
            rows = pd.concat(held, ignore_index=True)
            if len(rows):
                yield block(rows)

    return resolve


def spans_to_remove(rows: DataFrame, length: int = LENGTH, hot: int = 40_000, block_bytes: int = 1 << 18, unique: bool = False) -> DataFrame:
    """``rows`` (row_id, id, text; distinct texts): per row with something to remove, row_id and its [start, end).
    ``unique`` says that row_id and id are the same, which spares a column of everything that moves."""
    spark = rows.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    source = rows.select("row_id", "id", "text")
    seen = source.mapInArrow(_emit(False, length, unique), "h long, id long")
    shared = materialize(seen.groupBy("h").agg(F.min("id").alias("lo"), F.max("id").alias("hi")).where("lo < hi").select("h"), "shared-anchors")
    release_shuffles(spark)
    anchors = source.mapInArrow(_emit(True, length, unique), "h long, id long, place long, f long" + ("" if unique else ", row_id long"))
    found = materialize(anchors.join(shared, "h"), "shared-fragments")
    if unique:
        found = found.withColumn("row_id", F.col("id"))
    discard(shared)
    release_shuffles(spark)

    # Equal fragments are one. Where it lies: in the row of its smallest id.
    distinct = materialize(found.groupBy("h", "f").agg(F.min(F.struct("id", "row_id", "place")).alias("at")), "distinct-fragments")
    release_shuffles(spark)
    several = materialize(distinct.groupBy("h").count().where("count > 1"), "several")
    want = distinct.join(several.where(F.col("count") <= hot), "h").select(F.col("at.row_id").alias("row_id"), F.struct("h", "f", F.col("at.id").alias("low"), F.col("at.place").alias("place")).alias("w"))
    fetched = materialize(source.join(want.groupBy("row_id").agg(F.collect_list("w").alias("want")), "row_id").select("text", "want").mapInPandas(_fetch(length), "h long, f long, low long, frag binary"), "fetched")
    release_shuffles(spark)
    dealt = fetched.repartition(n, "h").sortWithinPartitions("h", "f")
    resolved = materialize(dealt.mapInPandas(_resolve(length, block_bytes), "h long, f long, t array<int>, k array<int>, low array<long>"), "least-ids")
    discard(fetched)
    release_shuffles(spark)
    alone = distinct.join(several, "h", "left").where("count is null")
    best = alone.select("h", "f", F.array(F.lit(0)).alias("t"), F.array((F.col("at.place") % 256).cast("int")).alias("k"), F.array("at.id").alias("low")).unionByName(resolved)
    gone = F.filter(F.arrays_zip(F.col("t"), F.col("k"), F.col("low")), lambda x: x["low"] < F.col("id"))
    start = F.floor(F.col("place") / 256)
    spans = found.join(best, ["h", "f"]).select("row_id", start.alias("start"), F.explode(gone).alias("g"))
    spans = spans.select("row_id", F.struct((F.col("start") + F.col("g.t")).alias("start"), (F.col("start") + F.col("g.t") + F.col("g.k") - 1 + length).alias("end")).alias("span"))
    heavy = several.where(F.col("count") > hot).select("h")
    if not heavy.isEmpty():
        spans = spans.unionByName(_heavy_spans(source, found.join(heavy, "h"), length))
    spans = materialize(spans.groupBy("row_id").agg(F.sort_array(F.collect_list("span")).alias("spans")), "spans")
    for done in (found, distinct, several, resolved):
        discard(done)
    release_shuffles(spark)
    return spans


def _heavy_spans(source: DataFrame, found: DataFrame, length: int) -> DataFrame:
    """Spans under anchors with too many distinct fragments for a block: their strings, one by one. Strings are grouped
    by their bytes with combined minima, so a hot anchor is spread over as many keys as it has distinct strings."""
    where = found.groupBy("row_id").agg(F.collect_list(F.struct("h", "f", F.col("id").alias("low"), "place")).alias("want"), F.min("id").alias("id"))

    def strings(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = {"row_id": [], "id": [], "start": [], "frag": []}
            for row_id, id_, text, want in zip(batch["row_id"], batch["id"], batch["text"], batch["want"], strict=True):
                data = _bytes(text)
                for x in want:
                    start, count = divmod(x["place"], 256)
                    for t in range(start, start + count):
                        out["row_id"].append(row_id)
                        out["id"].append(id_)
                        out["start"].append(t)
                        out["frag"].append(data[t : t + length])
            yield pd.DataFrame(out)

    single = materialize(source.select("row_id", "text").join(where, "row_id").select("row_id", "id", "text", "want").mapInPandas(strings, "row_id long, id long, start long, frag binary"), "hot-strings")
    low = single.groupBy("frag").agg(F.min("id").alias("low"))
    return single.join(low, "frag").where("low < id").select("row_id", F.struct("start", (F.col("start") + length).alias("end")).alias("span"))


def cut_spans(data: bytes, starts: np.ndarray, ends: np.ndarray) -> tuple[list[tuple[int, int]], bytes]:
    """Maximal removed runs (touching spans are one), and what is left."""
    if not len(starts):
        return [], data
    turn = np.argsort(starts, kind="stable")
    starts, reach = starts[turn], np.maximum.accumulate(ends[turn])
    new = np.concatenate(([True], starts[1:] > reach[:-1]))
    first = np.flatnonzero(new)
    runs = list(zip(starts[first].tolist(), reach[np.append(first[1:] - 1, len(reach) - 1)].tolist(), strict=True))
    kept, at = [], 0
    for a, b in runs:
        kept.append(data[at:a])
        at = b
    return runs, b"".join([*kept, data[at:]])


def dedup_bytes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """One row per input row: doc_id, n_bytes, n_removed, n_spans, spans (removed runs of bytes), kept (bytes left).

    Null texts are empty. A null id counts as larger than every other; rows with equal ids do not remove from each
    other. Ids are whole numbers. Other columns are not read. An empty table gives no rows.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    rows = docs.select(integer_id(docs, id_col).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    twice = rows.groupBy("doc_id").count().where("count > 1 or doc_id is null")
    unique = twice.isEmpty()
    if not unique:
        rows = materialize(rows.withColumn("row_id", F.monotonically_increasing_id()), "numbered")
    else:
        rows = rows.withColumn("row_id", F.col("doc_id"))
    rows = rows.withColumn("id", F.coalesce("doc_id", F.lit(LAST)))

    # Equal texts: the row with the smallest id stands for all.
    digest = F.sha2("text", 256)
    keys = materialize(rows.select("row_id", "id", digest.alias("digest"), F.octet_length("text").alias("size")), "digests")
    lowest = materialize(keys.groupBy("digest").agg(F.min(F.struct("id", "row_id")).alias("least")), "lowest")
    copies = keys.join(lowest, "digest").where(F.col("row_id") != F.col("least.row_id")).select("row_id", ((F.col("id") > F.col("least.id")) & (F.col("size") >= length)).alias("whole"), F.col("least.row_id").alias("like"))
    copies = materialize(copies, "copies")
    discard(keys)
    discard(lowest)
    release_shuffles(spark)
    spans = spans_to_remove(rows.join(copies, "row_id", "left_anti").select("row_id", "id", "text"), length, unique=unique)
    # A copy with the same id as its stand-in has the same strings before it: it takes the stand-in's spans.
    same = copies.where(~F.col("whole")).join(spans.withColumnRenamed("row_id", "like"), "like").select("row_id", "spans")
    known = spans.select("row_id", "spans", F.lit(False).alias("whole")).unionByName(same.withColumn("whole", F.lit(False))).unionByName(copies.where("whole").select("row_id", F.lit(None).cast(spans.schema["spans"].dataType).alias("spans"), "whole"))

    def finish(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for text, spans_, whole in zip(batch["text"], batch["spans"], batch["whole"], strict=True):
                data = _bytes(text)
                if whole is True:
                    runs, kept = [(0, len(data))], b""
                elif spans_ is None:
                    runs, kept = [], data
                else:
                    runs, kept = cut_spans(data, np.array([x["start"] for x in spans_], np.int64), np.array([x["end"] for x in spans_], np.int64))
                out.append((len(data), sum(b - a for a, b in runs), len(runs), [{"start": a, "end": b} for a, b in runs], kept))
            yield pd.concat([pd.DataFrame({"doc_id": joined_id(batch["doc_id"], batch["no_id"])}), pd.DataFrame(out, columns=["n_bytes", "n_removed", "n_spans", "spans", "kept"])], axis=1)

    return rows.join(known, "row_id", "left").select(*split_id("doc_id"), "text", "spans", "whole").mapInPandas(finish, "doc_id long, n_bytes long, n_removed long, n_spans long, spans array<struct<start:long,end:long>>, kept binary")


def op8_suffix_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: what byte-run dedup leaves of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return dedup_bytes(docs).select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


#: DuckDB for op8: every string of 50 bytes in hex, its smallest id, and the runs of removed starts as islands.
OP8_SQL = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (SELECT doc_id, i, substr(x, 2 * i + 1, 100) AS s FROM (SELECT doc_id, x, unnest(range(0, length(x) // 2 - 49)) AS i FROM d WHERE length(x) >= 100)),
m AS (SELECT s, min(doc_id) AS low FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
g AS (SELECT doc_id, i, CASE WHEN i <= lag(i) OVER (PARTITION BY doc_id ORDER BY i) + 50 THEN 0 ELSE 1 END AS new FROM w JOIN m USING (s) WHERE low < doc_id),
r AS (SELECT doc_id, min(i) AS a, max(i) + 50 AS b FROM (SELECT *, sum(new) OVER (PARTITION BY doc_id ORDER BY i) AS k FROM g) GROUP BY doc_id, k),
p AS (SELECT doc_id, a, b, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS z FROM r),
o AS (SELECT doc_id, sum(b - a) AS n_removed, count(*) AS n_spans, max(b) AS last, string_agg(substr(x, 2 * z + 1, 2 * (a - z)), '' ORDER BY a) AS head FROM p JOIN d USING (doc_id) GROUP BY doc_id)
SELECT d.doc_id, CAST(length(x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans,
  sha256(unhex(coalesce(head, '') || substr(x, 2 * coalesce(last, 0) + 1))) AS kept_sha256
FROM d LEFT JOIN o USING (doc_id)
"""
