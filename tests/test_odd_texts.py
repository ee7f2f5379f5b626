"""Queries on documents that the small tables lack, against their SQL."""

import shutil
import unicodedata

import duckdb
import pytest
from pyspark.sql import functions as F

from caseloom import queries
from caseloom.functions import text as X
from test_queries import canonical

TEXTS = ["", " ", "   ", "a b.", "One two. Three", "x\ny", "it.\n", "tail\n\n\n", "\n\n", "The line\nof it\nand", None, " lead. B ", "Nt onor. The of it.\nThintiwh is clown th and", "It shnd, the a and errentnd thhe to to.\n and more"]


@pytest.fixture(scope="module")
def tables(spark, tmp_path_factory):
    """Two sources of two documents each whose first 40 characters differ in length by a last line break, and odd texts."""
    root = tmp_path_factory.mktemp("odd")
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, 'en', ?, ?)", [(k, x, "odd" if k < len(TEXTS) - 2 else "breaks", len(x or "")) for k, x in enumerate(TEXTS)])
    con.execute("CREATE TABLE labels AS SELECT doc_id, 1 AS quality, 1 AS toxic FROM documents WHERE source = 'breaks'")
    for t in ("documents", "labels"):
        con.execute(f"COPY {t} TO '{root}/{t}.parquet' (FORMAT parquet)")
    yield str(root), con
    shutil.rmtree(root)


@pytest.mark.parametrize("name", ["atomic_fake", "primary_narrative", "sentence_index_check", "sentence_spans", "structure_headers_corpus", "structure_single_owner"])
def test_odd_texts(spark, tables, name):
    root, con = tables
    got, want = queries.QUERIES[name](spark, root).toPandas(), con.execute(queries.ORACLE_SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns) and canonical(got) == canonical(want)


def test_white_space_is_that_of_python(spark):
    """Every character alone, at both ends of a word, and in runs."""
    codes = [c for c in range(0x10000) if not 0xD800 <= c < 0xE000 and (chr(c).isspace() or unicodedata.category(chr(c)) in ("Cf", "Zs", "Zl", "Zp") or c < 0x100)]
    texts = [t for c in codes for t in (chr(c), f"{chr(c)} a{chr(c)}{chr(c)}b{chr(c)}c {chr(c)}")]
    rows = spark.createDataFrame([(x,) for x in texts], "t string").select("t", X.strip(F.col("t")).alias("s"), X.rstrip(F.col("t")).alias("r"), X.squeeze(F.col("t")).alias("q")).collect()
    assert [(x.t, x.s, x.r, x.q) for x in rows] == [(t, t.strip(), t.rstrip(), " ".join(t.split())) for t in texts]
    plan = spark.createDataFrame([("a",)], "t string").select(X.strip(F.col("t")))._jdf.queryExecution().optimizedPlan().toString()
    assert "regexp" not in plan
