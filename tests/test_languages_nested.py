import json

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.functions import languages as L
from quarry.operators import neardup as N
from quarry.sources import delimited, nested


def processed(spark, rows):
    frame = spark.createDataFrame(rows, "text string, lang string")
    return [r[0] for r in frame.select(F.array_join(L.preprocess_by_language(F.col("text"), F.col("lang")), " ")).collect()]


def test_stop_words_and_endings_follow_the_rows_language(spark):
    got = processed(spark, [
        ("Die Prüfungen für das Haus, 3.5 v.2 und.", "de"), ("Les mouvements de la ville étaient chères", "fr"), ("Las canciones más bonitas también", "es"),
        ("The walking dogs and the Cat", "en"), ("die the der", "xx"), ("Le azioni della città", "it"), (None, "de"), ("", "fr"), ("The cats", None), ("Die Katzen", "de-AT"),
    ])
    assert got == ["prüf haus 3.5 v.2", "mouv vill étaient chèr", "cancion bonit", "walk dogs cat", "die der", "azion città", None, "", "cats", "katz"]


def test_a_word_keeps_four_letters(spark):
    assert processed(spark, [("essen esse singen", "de"), ("ring bring", "en")]) == ["esse esse sing", "ring bring"]


def test_lines_are_numbered_in_file_order_over_several_splits(spark, tmp_path):
    """Every file is cut into several splits, and splits are not packed in file order."""
    want, n = [], 0
    for f in range(3):
        lines = [f"line {f} {i} " + "x" * (i * 37 % 90) for i in range(400 - 100 * f)]
        (tmp_path / f"part-{f}.txt").write_text("head\n" + "".join(x + "\n" for x in lines))
        want += [(f"part-{f}.txt", i, n + i, x) for i, x in enumerate(lines)]
        n += len(lines)
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        spark.conf.set("spark.sql.files.maxPartitionBytes", "4k")
        assert spark.read.text(str(tmp_path)).rdd.getNumPartitions() > 4
        got = delimited.read_lines_indexed(spark, str(tmp_path), skip="head").collect()
        split = delimited.read_lines_split(spark, str(tmp_path), " ", index=True).collect()
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)
    assert sorted((r.file.rsplit("/", 1)[1], r.line, r["index"], r.value) for r in got) == want
    assert sorted((r["index"], r.line) for r in split) == [(i, x) for _, _, i, x in want] and all(r.fields[0] == "line" for r in split)


def leaves(value, path="$"):
    if isinstance(value, (dict, list)):
        if not value:
            yield path, "EMPTY", None
        for k, v in value.items() if isinstance(value, dict) else enumerate(value):
            name = f"[{k}]" if isinstance(k, int) else f".{k}" if k.isidentifier() and k.isascii() else f"[{json.dumps(k, ensure_ascii=False)}]"
            yield from leaves(v, path + name)
    else:
        kind = {bool: "BOOLEAN", int: "BIGINT", str: "STRING", type(None): "VOID"}.get(type(value), "DOUBLE")
        yield path, kind, None if value is None else json.dumps(value) if not isinstance(value, str) else value


METRICS = {
    "Cora": {"accuracy": 0.8611, "auc": 1, "method": "svd"}, "Pub Med": {"runs": [{"k": 1}, {"k": 2, "ok": True}, []], "none": None, "é\"q": {}}, "deep": [[[["x"]]]], "n": -5,
}


def test_every_leaf_of_nested_json_files(spark, tmp_path):
    (tmp_path / "a" / "b").mkdir(parents=True)
    (tmp_path / "a" / "performances.json").write_text(json.dumps(METRICS, indent=2, ensure_ascii=False))
    (tmp_path / "a" / "b" / "performances.json").write_text(json.dumps([1, "two"], indent=4))
    (tmp_path / "a" / "bad.json").write_text('{"open": [1, 2')
    (tmp_path / "a" / "notes.txt").write_text("not read")
    listed = nested.list_files(spark, str(tmp_path), "*.json").collect()
    assert sorted(r.file.split("/a/")[1] for r in listed) == ["b/performances.json", "bad.json", "performances.json"] and all(r.size > 0 for r in listed)
    files = nested.read_whole_files(spark, str(tmp_path), "*.json").withColumn("name", F.element_at(F.split("file", "/a/"), -1))
    got = {}
    for r in nested.json_leaves(files, "value", ["name"]).collect():
        got.setdefault(r.name, []).append((r.path, "DOUBLE" if r.kind in ("DECIMAL", "DOUBLE", "FLOAT") else r.kind, r.value))
    assert sorted(got["performances.json"], key=str) == sorted(leaves(METRICS), key=str)
    assert sorted(got["b/performances.json"]) == [("$[0]", "BIGINT", "1"), ("$[1]", "STRING", "two")]
    assert got["bad.json"] == [("$", "MALFORMED", '{"open": [1, 2')]


def test_json_leaves_of_nothing(spark):
    frame = spark.createDataFrame([(1, None), (2, "{}"), (3, "7")], "id long, j string")
    assert sorted(tuple(r) for r in nested.json_leaves(frame, "j", ["id"]).collect()) == [(2, "$", "EMPTY", None), (3, "$", "BIGINT", "7")]
    assert nested.json_leaves(frame.limit(0), "j", ["id"]).count() == 0


def brute_signature(hashes, n):
    low = {}
    for h in hashes:
        low[h % n] = min(low.get(h % n, 1 << 62), h // n)
    out = []
    for p in range(n):
        b = p * N.stride(n) % n
        away = next(d for d in range(n) if (b + d) % n in low)
        out.append(low[(b + away) % n] + N.ROTATION * away)
    return out


@pytest.mark.parametrize("n, size", [(7800, 3), (7800, 2000), (12, 1), (50, 400)])
def test_one_permutation_signature(n, size):
    assert sorted(p * N.stride(n) % n for p in range(n)) == list(range(n))
    hashes = np.random.default_rng(n + size).integers(0, 1 << 52, size)
    assert N.densified(hashes, n).tolist() == brute_signature(hashes.tolist(), n)


def test_estimates_at_7800_positions_are_close_to_exact_similarity(spark):
    """Pairs of known similarity: the mean error of the estimate, and the candidates found."""
    rnd = np.random.default_rng(3)
    rows, share = [], {}
    for i, j in enumerate(np.linspace(0.3, 0.99, 24)):
        a = rnd.choice([chr(c) for c in range(97, 123)], 1500)
        b = a.copy()
        for at in rnd.choice(1500, max(1, int((1 - j) * 60)), replace=False):
            b[at] = "#"
        rows += [(2 * i, "".join(a)), (2 * i + 1, "".join(b))]
        sets = [{t[k:k + 10] for k in range(1491)} for t in ("".join(a), "".join(b))]
        share[(2 * i, 2 * i + 1)] = len(sets[0] & sets[1]) / len(sets[0] | sets[1])
    docs = spark.createDataFrame([*rows, (900, "short"), (901, ""), (902, None)], "doc_id long, text string").repartition(4)
    sig = N.wide_signatures(docs, 300, 26).cache()
    assert {r.doc_id for r in sig.collect()} == {i for i, _ in rows} | {900} and all(len(r["keys"]) == 300 and len(r.short) == 7800 for r in sig.collect())
    pairs = spark.createDataFrame(list(share), "doc_a long, doc_b long")
    errors = [abs(r.est - share[(r.doc_a, r.doc_b)]) for r in N.wide_estimate(pairs, sig).collect()]
    assert len(errors) == 24 and np.mean(errors) < 0.03 and max(errors) < 0.1
    found = {(r.doc_a, r.doc_b) for r in N.candidate_pairs(N.wide_buckets(sig)).collect()}
    assert found <= set(share) and {p for p, s in share.items() if s > 0.9} <= found
    assert not any(share[p] < 0.5 for p in found)
