"""Ids over 2**53 keep their digits beside null ids."""

from caseloom.llm import substring, suffix, tokenfile

LARGE = [2**53 + 1, 2**62 + 3, -(2**55) - 1]


def test_large_ids_beside_null_ids(spark):
    passage = " ".join(f"word{i}" for i in range(60))
    rows = [(k, f"{passage} {k}") for k in (*LARGE, None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    want = sorted(map(str, [*LARGE, None, None]))
    for got in (tokenfile.encode_and_read(docs), suffix.dedup_bytes(docs), substring.dedup_words(docs)):
        assert got.schema["doc_id"].dataType.simpleString() == "bigint"
        assert sorted(str(r.doc_id) for r in got.collect()) == want
    ordered = tokenfile.encode_and_read(docs).orderBy("start").collect()
    assert [r.doc_id for r in ordered] == [None, None, *sorted(LARGE)]
