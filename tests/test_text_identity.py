"""Normalisation and identities against their Python statements."""

import hashlib
import json
import unicodedata

import pytest
from pyspark.sql import functions as F

from caseloom.functions import identity as I
from caseloom.functions import text as X

ODD = ["", " a\x1cb c ", "ﬁne  Ｔｅｘｔ", "Tab\tand\nline", "é\x7f🙂\"\\", "A_b-c+d=e", "  "]


@pytest.fixture(scope="module")
def odd(spark):
    return spark.createDataFrame([(i, t) for i, t in enumerate(ODD)] + [(99, None)], "i int, t string")


def column(df, c):
    return [r[0] for r in df.orderBy("i").select(c).collect()]


def collapse(t):
    return " ".join(unicodedata.normalize("NFKC", t).split())


def test_whitespace_and_unicode(odd):
    assert column(odd, X.collapse_whitespace(F.col("t")))[:-1] == [collapse(t) for t in ODD]
    assert column(odd, X.strip(F.col("t")))[:-1] == [t.strip() for t in ODD]
    assert column(odd, X.normalize_text(F.col("t")))[-1] is None


def test_slug(odd):
    def slug(t):
        kept = "".join(c for c in collapse(t).lower() if not unicodedata.category(c).startswith("P"))
        return "_".join(kept.split()).strip("_")[:80].strip("_") or "item"

    assert column(odd, X.slugify(F.col("t")))[:-1] == [slug(t) for t in ODD]
    long = "word " * 40
    assert len(odd.sparkSession.range(1).select(X.slugify(F.lit(long))).first()[0]) <= 80


def test_lines(spark):
    for t in ("", "a", "a\n", "a\r\nb\x0bc\x1dd e\x85", "\n\n"):
        assert spark.range(1).select(X.split_lines(F.lit(t))).first()[0] == t.splitlines()


def test_canonical_json(odd):
    got = column(odd, I.canonical_json({"b": F.col("t"), "a": F.col("i")}))
    assert got[:-1] == [json.dumps({"a": i, "b": t}, sort_keys=True, separators=(",", ":")) for i, t in enumerate(ODD)]
    assert got[-1] == '{"a":99,"b":null}'
    assert column(odd, I.fingerprint({"b": F.col("t")}))[4] == hashlib.sha256(json.dumps({"b": ODD[4]}, separators=(",", ":")).encode()).hexdigest()


def test_identifiers(spark):
    row = spark.range(1).select(
        I.docket_item_id(F.lit(" abc 12 "), F.lit(3), F.lit("s")), I.docket_of_item(F.lit("ntsb:docket_item:X1:3:s")), I.docket_of_item(F.lit("ntsb:docket:X1")), I.blob_path(F.lit("abcdef")), I.document_id(F.lit("ff")), I.investigation_id(F.lit("a b")), I.docket_id(F.lit("a")), I.promoted_path(F.lit("n"), F.lit("i"), F.lit("0123456789abcdef99"))
    ).first()
    assert list(row) == ["ntsb:docket_item:ABC12:3:s", "X1", None, "sha256/ab/cd/abcdef", "doc:sha256:ff", "ntsb:investigation:AB", "ntsb:docket:A", "n/i__0123456789abcdef.pdf"]


def test_urls_and_counts(spark):
    one = lambda c: spark.range(1).select(c).first()[0]
    assert one(X.query_parameter(F.lit("http://h/p?a=1&PROJECTID=&projectId=x+%20y"), "ProjectID")) == "x y"
    assert one(X.query_parameter(F.lit("not a url"), "ProjectID")) is None
    assert one(X.count_before(F.lit("12 Pages, 3 photos"), "page")) == 12 and one(X.count_before(F.lit("none"), "photo")) is None
    none = F.lit(None).cast("string")
    ext = lambda url, media, blob: one(X.file_extension(F.lit(url), F.lit(media) if media else none, F.lit(blob)))
    assert [ext("http://h/a.PDF?x", None, "b"), ext("http://h/a?FileExtension=Pdf", None, "b"), ext("http://h/a?FileName=q.txt", None, "b"), ext("http://h/a", "text/html; charset=x", "b"), ext("http://h/a", None, "b.zip"), ext("http://h/a", None, "b")] == [".pdf", ".pdf", ".txt", ".html", ".zip", ".bin"]
    assert one(X.ordinal_name(F.lit(7), F.lit("s"), F.lit(".pdf"))) == "007_s.pdf" and one(X.ordinal_name(F.lit(1234), F.lit("s"), F.lit(".pdf"))) == "1234_s.pdf"


def test_digest_does_not_depend_on_partitions(spark):
    from caseloom.operators import certify

    df = spark.range(100).select(F.col("id").alias("k"))
    j = I.canonical_json({"k": F.col("k")}, ascii_only=True)
    assert certify.logical_digest(df.repartition(1), j).first() == certify.logical_digest(df.repartition(7), j).first()
    assert certify.set_digest(df.repartition(1), j).first() == certify.set_digest(df.repartition(7), j).first()
    assert certify.set_digest(df, j).first() != certify.set_digest(df.where("k > 0"), j).first()
