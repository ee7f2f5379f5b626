"""Token ids of all documents in one ordered, randomly addressable binary store.

Documents are range-partitioned and sorted by id, encoded, and cut at document ends into segments of about
``segment_tokens`` ids; a segment's ids are one DAC array (see ``dac``). Segments are rows of Parquet files, so Spark's
committer publishes them on any store it can write, a lost task leaves nothing behind, and a reader that needs one
segment skips the others by their statistics. A manifest has each segment's first token on the global line.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from caseloom.llm.common import integer_id, joined_id, scratch_path, ship_package, small_batches, split_id, split_ids
from caseloom.llm.dac import DacArray, encode

SEGMENT = "part int, seq int, n_docs long, n_tokens long, doc_ids array<long>, lengths array<int>, ids binary"
LATIN = "A-Za-zÀ-ÖØ-öø-ɏ"
#: Texts of these characters only: the byte-level pre-tokenizer's classes are then exactly those of PIECE.
PLAIN = re.compile(f"[\t\n\r\x20-\x7e{LATIN[6:]}]*")
PIECE = re.compile(rf" ?[{LATIN}]+|'(?:s|t|re|ve|m|ll|d)| ?[0-9]+| ?[^\s{LATIN}0-9]+|\s+(?!\S)|\s+")


class PieceEncoder:
    """Ids of whole texts from a ``tokenizers`` file, with a bounded memory of pieces already encoded.

    A byte-level BPE encodes each pre-tokenizer piece by itself, so a text's ids are its pieces' ids in a row; words
    repeat, so most pieces are found in the memory. Texts with characters outside PLAIN or with the string of an added
    token, and tokenizers that are not plain byte-level BPE, go to the library whole.
    """

    def __init__(self, path: str, max_pieces: int = 1_000_000):
        import json

        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        spec = json.loads(self.tokenizer.to_str())
        added = [t["content"] for t in spec.get("added_tokens") or []]
        self.added = re.compile("|".join(map(re.escape, added))) if added else None
        pre = spec.get("pre_tokenizer") or {}
        self.by_piece = spec["model"]["type"] == "BPE" and not spec.get("normalizer") and pre.get("type") == "ByteLevel" and pre.get("use_regex") and not pre.get("add_prefix_space") and not spec["model"].get("dropout")
        # Pieces of letters are joined for the library: no added token may come about there.
        self.by_piece = self.by_piece and not any(re.fullmatch(r"[\w\s]*", t) for t in added)
        self.max_pieces, self.memory = max_pieces, {}

    def _library(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tokenizer.encode_batch(texts, add_special_tokens=False)]

    def _words(self, pieces: list[str], lead: str) -> list[bytes]:
        """Ids of pieces that are one space (or nothing) and letters: many go to the library as one text, in which
        each follows ``lead``, and the encoding's word numbers give them back piece by piece."""
        out: list[bytes] = []
        every = 2 if lead else 1  # a lead is a piece of its own
        for at in range(0, len(pieces), 1000):
            part = pieces[at : at + 1000]
            e = self.tokenizer.encode(lead + lead.join(part), add_special_tokens=False)
            ids = np.array(e.ids, "<u4")
            ends = np.searchsorted(np.array(e.word_ids), np.arange(every * len(part)), side="right")
            if ends[-1] != len(ids) or e.word_ids[-1] != every * len(part) - 1:
                return self._library(pieces)  # the library split them otherwise
            data, cuts = ids.tobytes(), (4 * np.r_[0, ends]).tolist()
            out += [data[cuts[j] : cuts[j + 1]] for j in range(every - 1, every * len(part), every)]
        return out

    def _pieces(self, pieces: list[str]) -> dict[str, bytes]:
        spaced = [p for p in pieces if p[0] == " " and p[1:].isalpha()]
        bare = [p for p in pieces if p.isalpha()]
        known = dict(zip(spaced, self._words(spaced, ""), strict=True)) | dict(zip(bare, self._words(bare, "\n"), strict=True))
        rest = [p for p in pieces if p not in known]
        return known | dict(zip(rest, self._library(rest), strict=True))

    def encode(self, texts: list[str]) -> list[bytes]:
        """Per text its ids as little-endian unsigned 32-bit integers."""
        if not self.by_piece:
            return self._library(texts)
        out: list = [None] * len(texts)
        whole = [i for i, t in enumerate(texts) if not PLAIN.fullmatch(t) or (self.added and self.added.search(t))]
        for i, ids in zip(whole, self._library([texts[i] for i in whole]), strict=True):
            out[i] = ids
        cut = {i: PIECE.findall(t) for i, t in enumerate(texts) if out[i] is None}
        new = list(set(chain.from_iterable(cut.values())).difference(self.memory))
        if len(self.memory) + len(new) > self.max_pieces:  # the older half goes; what is frequent comes back
            self.memory = dict(list(self.memory.items())[len(self.memory) // 2 :])
            new = list(set(chain.from_iterable(cut.values())).difference(self.memory))
        self.memory.update(self._pieces(new))
        known = self.memory.__getitem__
        for i, pieces in cut.items():
            out[i] = b"".join(map(known, pieces))
        return out


_ENCODERS: dict[str, PieceEncoder] = {}


def _encoder(path: str) -> PieceEncoder:
    """One encoder per Python worker and file."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"
    if path not in _ENCODERS:
        _ENCODERS[path] = PieceEncoder(path)
    return _ENCODERS[path]


def write_tokens(docs: DataFrame, path: str, tokenizer_path: str, id_col: str = "doc_id", text_col: str = "text", end_id: int = 0, segment_tokens: int = 1 << 20) -> None:
    """Write all documents' ids in ascending id order to ``path``/segments and the manifest to ``path``/manifest.

    Null and empty texts give the end id alone. Null ids come first. Rows with the same id are kept, ordered by the
    hash of their text, so the order is a function of the rows. An empty table gives an empty store. A document is
    never split: one longer than a segment makes a long segment. Ids are whole numbers. Other columns are not
    read.
    """
    spark = docs.sparkSession
    ship_package(spark)
    small_batches(spark)
    end = np.array([end_id], "<u4").tobytes()

    def segments(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        part, seq = TaskContext.get().partitionId(), 0
        ids: list[bytes] = []
        keys: list = []
        size = 0

        def flush() -> pd.DataFrame:
            data = np.frombuffer(b"".join(ids), "<u4")
            lengths = [len(x) // 4 for x in ids]
            return pd.DataFrame({"part": [part], "seq": [seq], "n_docs": [len(ids)], "n_tokens": [len(data)], "doc_ids": [list(keys)], "lengths": [lengths], "ids": [encode(data)]})

        encoder = _encoder(tokenizer_path)
        for batch in batches:
            coded = encoder.encode([t or "" for t in batch["text"]])
            for key, absent, x in zip(batch["doc_id"].tolist(), batch["no_id"].tolist(), coded, strict=True):
                keys.append(None if absent else key)
                ids.append(x + end)
                size += len(x) // 4 + 1
                if size >= segment_tokens:
                    yield flush()
                    ids.clear()
                    keys.clear()
                    seq, size = seq + 1, 0
        if ids:
            yield flush()

    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(integer_id(docs, id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ordered = rows.repartitionByRange(n, "doc_id").sortWithinPartitions("doc_id", F.xxhash64("text"))
    # Ids are dense bytes already; without a codec a reader of one segment has nothing to decode.
    ordered.select(*split_id("doc_id"), "text").mapInPandas(segments, SEGMENT).write.option("compression", "none").parquet(f"{path}/segments")
    manifest(spark.read.schema(SEGMENT).parquet(f"{path}/segments")).write.parquet(f"{path}/manifest")


def manifest(segments: DataFrame) -> DataFrame:
    """(part, seq, n_docs, n_tokens, first_token): running sums inside parts, plus the parts' own running sum.
    The one-task window has a row per part, so it is bounded by the number of write tasks."""
    sizes = segments.select("part", "seq", "n_docs", "n_tokens")
    before = lambda w: F.coalesce(F.sum("n_tokens").over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("n_tokens")).select("part", before(Window.orderBy("part")).alias("part_first"))
    inside = sizes.withColumn("inside", before(Window.partitionBy("part").orderBy("seq")))
    return inside.join(parts, "part").select("part", "seq", "n_docs", "n_tokens", (F.col("part_first") + F.col("inside")).alias("first_token"))


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """Read a store back: per document doc_id, start (tokens before it), n_tokens, ids_crc32 and part, seq, place."""
    ship_package(spark)

    def digest(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples(index=False):
                ids = DacArray(row.ids).slice(0, row.n_tokens).astype("<u4")
                ends = np.cumsum(np.asarray(row.lengths, np.int64))
                starts = ends - np.asarray(row.lengths, np.int64)
                crc = [zlib.crc32(ids[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                yield pd.DataFrame({"doc_id": joined_id(np.asarray(row.doc_ids, np.int64), np.asarray(row.no_ids, bool)), "start": starts + row.first_token, "n_tokens": ends - starts, "ids_crc32": np.array(crc, np.int64), "part": row.part, "seq": row.seq, "place": np.arange(len(ends))})

    # The manifest was written by itself, so its file size is known: Spark broadcasts it only while it is small.
    first = spark.read.parquet(f"{path}/manifest").select("part", "seq", "first_token")
    stored = spark.read.schema(SEGMENT).parquet(f"{path}/segments").join(first, ["part", "seq"])
    return stored.select("part", "seq", "n_tokens", "first_token", *split_ids("doc_ids"), "lengths", "ids").mapInPandas(digest, "doc_id long, start long, n_tokens long, ids_crc32 long, part int, seq int, place int")


def token_at(spark: SparkSession, path: str, position: int) -> int:
    """The token at a global position: the manifest names the segment, and where that one lies its DAC array is entered
    at the token; one number comes back."""
    at = spark.read.parquet(f"{path}/manifest").where((F.col("first_token") <= position) & (F.col("first_token") + F.col("n_tokens") > position)).first()
    if at is None:
        raise IndexError(position)
    offset = position - at.first_token

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield pd.DataFrame({"id": [DacArray(x)[offset] for x in batch["ids"]]})

    ship_package(spark)
    found = spark.read.schema(SEGMENT).parquet(f"{path}/segments").where((F.col("part") == at.part) & (F.col("seq") == at.seq))
    return found.select("ids").mapInPandas(look, "id long").first().id


def document_ids(spark: SparkSession, path: str, part: int, seq: int, place: int) -> list[int]:
    """Ids of one document (end id included), by its address from :func:`read_documents`."""
    row = spark.read.schema(SEGMENT).parquet(f"{path}/segments").where((F.col("part") == part) & (F.col("seq") == seq)).select("lengths", "ids").first()
    start = sum(row.lengths[:place])
    return DacArray(bytes(row.ids)).slice(start, start + row.lengths[place]).tolist()


def default_tokenizer() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("byte_bpe_50k.json"))


def encode_and_read(docs: DataFrame, tokenizer_path: str | None = None, path: str | None = None) -> DataFrame:
    """Write a store and read it back."""
    spark = docs.sparkSession
    path = path or scratch_path(spark, "tokens")
    write_tokens(docs, path, tokenizer_path or default_tokenizer())
    return read_documents(spark, path)


def op2_token_binary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contract query: address, length and digest of every document, read back from the store."""
    return encode_and_read(spark.read.parquet(f"{sf_dir}/documents.parquet")).select("doc_id", "start", "n_tokens", "ids_crc32")
