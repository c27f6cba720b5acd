import re

from pyspark.sql import functions as F

from quarry.functions import text as T

CASES = ["", "abcd", "v.2", "15.6", "5.", "..", "Hello, World!", "a.b 1.2.3 x.5 5.x ..5 5..", "Ünïcödé  ÉTÉ", "tab\tand\nnewline", "15.6\" pollici"]


def py_normalize(s):
    s = re.sub(r"[^a-z0-9.]|(?<![0-9])\.(?![0-9])", " ", s.lower())
    return re.sub(r" +", " ", s)


def test_normalize_matches_reference_regex(spark):
    df = spark.createDataFrame([(i, s) for i, s in enumerate(CASES)], "i int, s string")
    got = {r.i: r.n for r in df.select("i", T.normalize(F.col("s")).alias("n")).collect()}
    for i, s in enumerate(CASES):
        assert got[i] == py_normalize(s), s


def test_tokens_drop_empty_and_stopwords(spark):
    df = spark.createDataFrame([("The cats and the dogs",), ("",)], "s string")
    rows = df.select(T.preprocess(F.col("s")).alias("t")).collect()
    assert rows[0].t == ["cat", "dog"]
    assert rows[1].t == []


def test_stem_fast_equals_regex_rules(spark):
    words = ["caresses", "ponies", "cats", "ss", "s", "is", "running", "sing", "feed", "needed", "walked", "ing", "boxes", "bus"]
    df = spark.createDataFrame([(w,) for w in words], "w string")
    rows = df.select(T.stem(F.col("w")).alias("a"), T.stem_regex(F.col("w")).alias("b")).collect()
    assert all(r.a == r.b for r in rows)
