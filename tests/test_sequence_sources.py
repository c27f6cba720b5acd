import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from quarry.operators.sequence import previous_in_key
from quarry.session import scratch_path
from quarry.sources import delimited, postings


def test_previous_in_key_equals_plain_lag(spark):
    rnd = random.Random(4)
    base = dt.datetime(2024, 1, 1)
    rows = []
    for i in range(2000):
        user = 0 if i % 2 else rnd.randint(1, 30)  # user 0 holds half the rows
        ts = base + dt.timedelta(minutes=rnd.randint(0, 60 * 24 * 5))  # ties on ts happen
        rows.append((i, user, ts))
    df = spark.createDataFrame(rows, "event_id long, user_id long, ts timestamp_ntz")
    got = previous_in_key(df, "user_id", "ts", "event_id", ["ts", "event_id"])
    w = Window.partitionBy("user_id").orderBy("ts", "event_id")
    want = df.select("event_id", F.lag("ts").over(w).alias("prev_ts"), F.lag("event_id").over(w).alias("prev_event_id"))
    a = got.select("event_id", "prev_ts", "prev_event_id")
    assert a.exceptAll(want).count() == 0 and want.exceptAll(a).count() == 0


def test_postings_text_round_trip_with_chunked_lines(spark):
    rows = [("hot", d, 1 + d % 3) for d in range(25)] + [("cold", 7, 2), ("cold", 3, 1)]
    tf = spark.createDataFrame(rows, "word string, doc_id long, tf long")
    lines = postings.to_lines(tf, max_per_line=10)
    assert lines.where(F.col("word") == "hot").count() == 3  # 25 postings, at most 10 per line
    assert lines.where(F.col("word") == "cold").first().value == "cold: (3, 1); (7, 2)"
    path = scratch_path(spark, "postings-test")
    postings.write_text(tf, path, max_per_line=10)
    back = postings.read_text(spark, path)
    assert back.exceptAll(tf).count() == 0 and tf.exceptAll(back).count() == 0


def test_tsv_quotes_and_tabs_survive(spark):
    rows = [(1, 'plain'), (2, 'has "quotes" and\ttab'), (3, 'line\nbreak')]
    df = spark.createDataFrame(rows, "k long, s string")
    path = scratch_path(spark, "tsv-test")
    delimited.write_tsv(df, path)
    back = delimited.read_tsv(spark, path, "k long, s string", quoted_newlines=True)
    assert sorted(back.collect()) == sorted(df.collect())
    raw = delimited.read_lines_split(spark, path)
    assert raw.where(F.col("fields")[0] == "2").first() is not None


def test_postings_lines_stay_near_their_bound_for_ids_with_a_common_factor(spark):
    from quarry.sources import postings

    tf = spark.createDataFrame([("w", 3 * i, 1) for i in range(300)], "word string, doc_id long, tf long")
    lines = [r.value for r in postings.to_lines(tf, max_per_line=10).collect()]
    assert max(v.count("(") for v in lines) <= 25 and sum(v.count("(") for v in lines) == 300


def test_headerless_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5), (2, None)], "item long, mark double")
    delimited.write_tsv(df, str(tmp_path / "x"), header=False)
    assert sorted(delimited.read_tsv(spark, str(tmp_path / "x"), "item long, mark double", header=False).collect()) == sorted(df.collect())


def test_postings_are_compared_with_stored_rows(spark, tmp_path):
    """The texts are tokenised once: neither the comparison nor the result reads them again."""
    from quarry.plans.pages import postings_roundtrip, postings_text

    rows = [(i, f"alpha beta{i % 3} gamma gamma") for i in range(9)] + [(9, None), (10, "")]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    back, lines = postings_roundtrip(spark, str(tmp_path)), postings_text(spark, str(tmp_path))
    for df in (back, lines):
        assert f"{tmp_path}/documents" not in df._jdf.queryExecution().toString()
    assert {(r.word, r.doc_id): r.tf for r in back.collect()}["gamma", 4] == 2 and back.count() == 27
    assert lines.count() == 5
