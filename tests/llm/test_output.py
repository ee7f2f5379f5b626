"""Token store, shards, mixing, the pipeline and the registry."""

import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from test_nearcopies import brute_survivors

import corpus_pipeline
from caseloom.llm import dac, mixing, queries, sharding, tokenfile
from caseloom.llm.common import materialize


@pytest.mark.parametrize("n", [0, 1, 511, 512, 513, 3000])
@pytest.mark.parametrize("top", [10, 300, 70_000, 2**32 - 1])
def test_dac_random_access(n, top):
    v = np.random.default_rng(n).integers(0, top + 1, n).astype(np.uint32)
    a = dac.DacArray(dac.encode(v))
    assert (a.slice(0, n) == v).all() and (a.slice(7, n - 3) == v[7 : max(7, n - 3)]).all()
    assert all(a[i] == v[i] for i in range(0, n, max(1, n // 40)))
    with pytest.raises(IndexError):
        a[n]


def test_token_store(spark, docs, texts, awkward, nothing, tmp_path):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(tokenfile.default_tokenizer())
    path = f"file://{tmp_path}/store"
    rows = sorted(tokenfile.encode_and_read(docs, path=path).collect(), key=lambda r: r.start)
    want = [np.array([*t.encode(texts[i] or "", add_special_tokens=False).ids, 0], "<u4") for i in sorted(texts)]
    assert [r.doc_id for r in rows] == sorted(texts)
    assert [r.n_tokens for r in rows] == [len(x) for x in want]
    assert [r.start for r in rows] == list(np.cumsum([0, *map(len, want)])[:-1])
    assert [r.ids_crc32 for r in rows] == [zlib.crc32(x.tobytes()) for x in want]
    flat = np.concatenate(want)
    for p in (0, 5, len(flat) // 2, len(flat) - 1):
        assert tokenfile.token_at(spark, path, p) == flat[p]
    r = rows[3]
    assert tokenfile.document_ids(spark, path, r.part, r.seq, r.place) == want[3].tolist()
    assert tokenfile.encode_and_read(nothing).collect() == []
    assert sorted(str(r.doc_id) for r in tokenfile.encode_and_read(awkward).collect()) == ["1", "1", "3", "4", "None", "None"]


def test_pieces_equal_the_library():
    e = tokenfile.PieceEncoder(tokenfile.default_tokenizer(), max_pieces=50)
    texts = ["", " ", "\n\n a  b", "don't we'll  I'm", "a" * 3000, "x²y ١٢ 漢字 🙂", "é ñandú\r\n\tTab", "<|endoftext|> a", "one two three " * 40]
    for _ in range(3):
        assert e.encode(texts) == [np.array(x.ids, "<u4").tobytes() for x in e.tokenizer.encode_batch(texts, add_special_tokens=False)]


def test_shards_are_even_and_gapless(docs, texts):
    rows = sharding.shard_by_bytes(docs, shards=4, ranges=8, sample=200, piece_rows=5).collect()
    assert sorted(r.doc_id for r in rows) == sorted(texts)
    by = defaultdict(list)
    for r in rows:
        assert r.size == len((texts[r.doc_id] or "").encode()) + 8 and r.text_crc32 == zlib.crc32((texts[r.doc_id] or "").encode())
        by[r.shard].append(r)
    assert all(sorted(r.slot for r in g) == list(range(len(g))) for g in by.values())
    total, largest = sum(r.size for r in rows), max(r.size for r in rows)
    assert all(abs(sum(r.size for r in g) - total / 4) <= largest for g in by.values())


def test_shards_of_a_hot_text_and_edges(spark, awkward, nothing):
    hot = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 > 0, "same text").otherwise(F.concat(F.lit("t"), "id")).alias("text"))
    sizes = [r.b for r in sharding.shard_by_bytes(hot, piece_rows=50).groupBy("shard").agg(F.sum("size").alias("b")).collect()]
    assert len(sizes) == 24 and max(sizes) - min(sizes) <= 40
    assert sharding.shard_by_bytes(awkward).count() == 6 and sharding.shard_by_bytes(nothing).collect() == []


@pytest.fixture(scope="module")
def labelled(spark):
    rows = [(i, ("good plain words here " if i % 4 else "bad awful nasty junk ") * 20) for i in range(200)]
    return spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(i, "clean" if i % 4 else "toxic") for i in range(150)], "doc_id long, domain string")


def test_mixing_meets_its_targets(labelled, awkward, nothing):
    docs, labels = labelled
    mixed, _, _ = mixing.mixing(docs, labels, {"clean": 0.9, "toxic": 0.1})
    rows = mixed.collect()
    total = sum(r.n_tokens for r in rows)
    share = [sum(r.n_tokens * r.rate * r.p[j] for r in rows) / total for j in (0, 1)]
    assert share == pytest.approx([0.9, 0.1], abs=0.005) and min(r.rate for r in rows) >= 0
    assert all((r.p[1] > 0.5) == (r.doc_id % 4 == 0) for r in rows)
    out = mixing.mixed_documents(docs, labels, {"clean": 0.9, "toxic": 0.1})
    assert out.columns == docs.columns and abs(out.count() - 200) < 25
    assert mixing.mixing(nothing, labels, {"clean": 0.9, "toxic": 0.1})[0].collect() == []
    assert all(r.rate <= 41 for r in mixing.mixing(awkward, labels, {"clean": 0.9, "toxic": 0.1})[0].collect())


def test_native_operators_have_no_python(spark, tmp_path):
    spark.createDataFrame([(1, "a b", "en", "s", 3)], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for name in ("op5_mixing", "op6_quality_rules", "op7_sharding"):
        plan = queries.QUERIES[name](spark, str(tmp_path))._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_pipeline(spark, awkward, nothing, tmp_path):
    good = ["word%d " % k for k in range(200)]
    rows = [(i, " ".join(good[(i * 7 + k) % 200].strip() for k in range(80 + i)), "en", "s", 1) for i in range(40)]
    rows += [(100, rows[3][1], "en", "s", 1), (101, "short text", "en", "s", 1), (102, "same same same " * 60, "en", "s", 1), (103, None, None, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, 1, 0) for i in range(20)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    spark.createDataFrame([(1, " ".join(rows[5][1].split()[:15]))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {}
    now = docs
    for name, stage in corpus_pipeline.STAGES:
        now = materialize(stage(spark, now, str(tmp_path)), "test-stage")
        kept[name] = {r.doc_id for r in now.select("doc_id").collect()}
        if name != "token ids":
            assert now.columns == docs.columns
    assert kept["quality rules"] == {*range(40), 100}
    # Neighbours are at 0.82 of each other (71 of 86 shingles), so at 0.8 the forty windows are one component.
    assert kept["near duplicates"] == brute_survivors({r[0]: r[1] for r in rows if r[0] in kept["quality rules"]})
    assert 5 not in kept["decontamination"] and kept["decontamination"] <= kept["near duplicates"]
    assert kept["token ids"] == kept["mixing"]
    for empty_or_odd in (awkward.select("doc_id", "text", "lang", "source", "n_chars"), nothing.select("doc_id", "text", "lang", "source", "n_chars")):
        for _, stage in corpus_pipeline.STAGES:
            stage(spark, empty_or_odd, str(tmp_path)).collect()


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_sql_agrees(spark, name):
    import duckdb

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    got = queries.QUERIES[name](spark, sf).toPandas()
    want = con.execute(queries.ORACLE_SQL[name]).df()[list(got.columns)]
    key = "doc_id"
    assert got.sort_values(key).reset_index(drop=True).astype(str).equals(want.sort_values(key).reset_index(drop=True).astype(str))
