"""Sharding, the conversation trie and spelling variants against brute force."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from quarry.llm import conversation_trie, rendezvous, spelling


# --- sharding


def test_sharding(docs, rows):
    out = rendezvous.assign(docs, {s: 1.0 for s in range(7)}, {7: 1.0}).collect()
    want = Counter((i, len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for i, t in rows)
    assert Counter((r.doc_id, r.size, r.text_crc32) for r in out) == want
    slots, of_key = defaultdict(list), defaultdict(set)
    for r in out:
        slots[r.shard].append(r.slot)
        assert r.grown_shard in (r.shard, 7)
        if r.doc_id is not None:
            of_key[r.doc_id].add((r.shard, r.grown_shard))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert all(len(s) == 1 for s in of_key.values()) and any(r.grown_shard == 7 for r in out)


def test_shares_follow_the_weights_and_only_the_changed_shard_moves_rows(spark):
    keys = spark.range(6000).select(F.col("id").alias("doc_id"), F.lit("x").alias("text"))

    def shards(weights):
        return {r.doc_id: r.shard for r in rendezvous.place(keys, weights).collect()}

    before = shards({0: 1.0, 1: 2.0, 2: 3.0})
    share = Counter(before.values())
    assert [abs(share[s] / 1000 - w) < 0.2 for s, w in ((0, 1), (1, 2), (2, 3))] == [True] * 3
    heavier = shards({0: 1.0, 1: 4.0, 2: 3.0})
    assert all(heavier[k] in (s, 1) for k, s in before.items())
    gone = shards({0: 1.0, 2: 3.0})
    assert all(gone[k] == s for k, s in before.items() if s != 1)
    assert shards({0: 1.0, 1: 2.0, 2: 3.0, 3: 0.0}) == before
    # equal weights: the logarithm makes no difference
    assert shards({0: 5.0, 1: 5.0}) == shards({0: 1.0, 1: 1.0})
    with pytest.raises(ValueError):
        rendezvous.place(keys, {0: 0.0})


def test_hot_keys_and_empty_tables(spark, empty):
    rows = spark.range(900).select(F.when(F.col("id") % 3 == 0, 5).otherwise(F.col("id")).alias("doc_id"), F.when(F.col("id") % 2 == 0, F.lit("same")).alias("text"))
    out = rendezvous.assign(rows.repartition(6), {s: 1.0 for s in range(4)}).collect()
    assert len(out) == 900 and len({r.shard for r in out if r.doc_id == 5}) == 1
    for s in range(4):
        slots = sorted(r.slot for r in out if r.shard == s)
        assert slots == list(range(len(slots)))
    nulls = spark.range(300).select(F.lit(None).cast("long").alias("doc_id"), F.concat(F.lit("t"), "id").alias("text"))
    assert len({r.shard for r in rendezvous.assign(nulls, {s: 1.0 for s in range(4)}).collect()}) == 4
    assert rendezvous.assign(empty, {0: 1.0}).count() == 0


def test_written_shards_hold_all_rows_whole(spark, docs, rows, tmp_path):
    path = str(tmp_path / "shards")
    rendezvous.write_shards(docs, path, {s: 1.0 for s in range(3)}, rows_per_file=10)
    back = spark.read.parquet(path)
    assert Counter((r.doc_id, r.text) for r in back.collect()) == Counter(rows)
    placed = {(r.doc_id, r.text_crc32): r.shard for r in rendezvous.place(docs, {s: 1.0 for s in range(3)}).collect()}
    assert all(placed[(r.doc_id, zlib.crc32((r.text or "").encode()))] == r.shard for r in back.collect())


# --- conversation trie


def brute_trie(rows, heads=True):
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            key = hashlib.sha256(f"{len(role)}:{role}{text}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0), key, (role, text)))
    own = {c: [t[2] for t in sorted(v)] for c, v in own.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 4 if heads else 0
        base = c - (c % 20 if c >= 0 else -(-c % 20))
        whole[c] = own.get(base, [])[:h] + v[h:]
    nodes = defaultdict(list)
    for c, v in whole.items():
        for d in range(len(v) + 1):
            nodes[tuple(v[:d])].append(c)
    kids = Counter(p[:-1] for p in nodes if p)
    leaves, saved = Counter(), Counter()
    for p, members in nodes.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += kids[p] == 0
            saved[p[:d]] += (len(members) - 1) * len(re.findall(r"[^\x20\x09-\x0D]+", p[-1][1])) if p else 0
    out = []
    for p, members in nodes.items():
        ends = ",".join(map(str, sorted(c for c in members if len(whole[c]) == len(p))))
        out.append((min(members), len(p), min(nodes[p[:-1]]) if p else None, len(members), kids[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return Counter(out)


CONVERSATIONS = "conv_id long, turn long, role string, text string, path string, words string, part string, kind string"


def conversation_rows(seed, n):
    rnd = random.Random(seed)
    says = ["", None, "hello there", "a b c d", "\n", "x " * 40, "was ist los", "ок да"]
    rows = []
    for c in rnd.sample(range(-60, 4 * n), n):
        if rnd.random() < 0.25:   # copies of one conversation
            turns = [("user", "hot one"), ("assistant", "hot two words"), ("user", None)]
        else:
            turns = [(rnd.choice(["user", "assistant", None, ""]), rnd.choice(says)) for _ in range(rnd.randint(1, 6))]
        if rnd.random() < 0.3:
            turns = [("system", "same start")] + turns
        rows += [(c, k if rnd.random() > 0.05 else None, r, t) for k, (r, t) in enumerate(turns)]
    rows += [(40, k, "user", f"turn {k}") for k in range(150)] + [(41, k, "user", f"turn {k}") for k in range(149)] + [(60, 0, "user", "long " * 50000)]
    rows += [(None, 0, "user", "nobody"), (None, None, None, None), rows[0], rows[0], (rows[3][0], rows[3][1], "other", "tie")]
    return rows


@pytest.mark.parametrize("seed, n, part", [(1, 400, 1 << 18), (2, 400, 20), (3, 40, 3)])
def test_trie(spark, seed, n, part):
    rows = conversation_rows(seed, n)
    frame = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], CONVERSATIONS).repartition(4)
    out = conversation_trie.prefix_trie(frame, part_turns=part)
    assert out.columns == conversation_trie.NODE
    assert Counter(map(tuple, out.collect())) == brute_trie(rows)


def test_trie_of_conversations_as_they_are(spark):
    rows = conversation_rows(4, 30)
    frame = spark.createDataFrame([(*r, None, None, None, None) for r in rows], CONVERSATIONS)
    assert Counter(map(tuple, conversation_trie.prefix_trie(frame, heads=None, part_turns=9).collect())) == brute_trie(rows, heads=False)


def test_trie_of_nothing_and_of_turnless_conversations(spark):
    frame = spark.createDataFrame([], CONVERSATIONS)
    assert conversation_trie.prefix_trie(frame).count() == 0
    rows = [(c, 0, "user", "only") for c in range(1, 20)]  # their family's first is absent
    frame = spark.createDataFrame([(*r, None, None, None, None) for r in rows], CONVERSATIONS)
    got = Counter(map(tuple, conversation_trie.prefix_trie(frame).collect()))
    assert got == brute_trie(rows) and any(r[1] == 0 and r[7] != conversation_trie.NOTHING for r in got)


# --- spelling variants


def edits(w, letters):
    yield from (w[:i] + w[i + 1:] for i in range(len(w)))
    yield from (w[:i] + c + w[i + 1:] for i in range(len(w)) for c in letters if c != w[i])
    yield from (w[:i] + c + w[i:] for i in range(len(w) + 1) for c in letters)


def brute_variants(rows, min_chars):
    count = Counter()
    for i, t in rows:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = re.sub("[A-Z]", lambda m: m[0].lower(), w)
            h = zlib.crc32(f"{i}:{w}".encode())
            if i is not None and h % 31 == 0:
                w = w[:h % len(w)] + w[h % len(w) + 1:]
            if len(w) >= min_chars:
                count[w] += 1
    count = {w: n for w, n in count.items() if n >= 2}
    letters = {c for w in count for c in w}
    near = {w: {x for x in edits(w, letters) if x in count and x != w} for w in count}
    form = {}
    for w, n in count.items():
        if near[w]:
            best = min(near[w], key=lambda x: (-count[x], x))
            if count[best] >= 10 * n:
                form[w] = best
    out = []
    for w, n in count.items():
        root = w
        while root in form:
            root = form[root]
        out.append((w, form.get(w), root, n, len(near[w]), count[form[w]] if w in form else None))
    return Counter(out)


def spelling_rows(seed):
    rnd = random.Random(seed)
    heads = ["wolke", "straße", "ÉTÉ", "aaaa", "Naïve", "abcdef"]
    base = [rnd.choice(heads) + "".join(rnd.choice("abné") for _ in range(rnd.randint(0, 6))) for _ in range(150)]
    long = "".join(rnd.choice("abc") for _ in range(70))
    base += [long[:63], long[:64], long[:65], long[:66], long[:30] + long[31:66], long[:40] + "z" + long[41:65], long[:40] + "é" + long[41:65], long[:66] + "a", "a" * 64, "a" * 65, "a" * 66, "b" + "a" * 65]
    words = base + [rnd.choice(list(edits(w, "abné")) or [w]) for w in base for _ in range(3)]
    rows = []
    for i in range(-20, 120):
        rows.append((i, " ".join(rnd.choice(words) for _ in range(rnd.randint(1, 80))) + "-" + "wolkenbruch" * (i % 3)))
    rows += [(i, "schreibung " * 250 + "schreibungs " * 16 + "schreibungsx") for i in range(500, 504)]  # a chain of forms
    rows += [(900 + k, w + " " + w) for k, w in enumerate(base[-12:])]
    rows += [rows[3], rows[3], (7, None), (8, ""), (None, "schreibung SCHREIBUNG straßen straßen"), (None, None), (9, "ßtraßen × ÷ 漢字 İstanbul Wörter1Wörter2 " * 2), (10, "lang" * 30000 + " " + "lang" * 30000)]
    return rows


@pytest.mark.parametrize("seed, min_chars", [(1, 7), (2, 3)])
def test_spelling_variants(spark, seed, min_chars):
    rows = [r for r in spelling_rows(seed) if r[0] != 10]
    cols = "doc_id long, text string, word string, n string, node string, letter string"
    frame = spark.createDataFrame([(*r, "x", "x", "x", "x") for r in rows], cols).repartition(4)
    out = spelling.variants(frame, min_chars).select("word", "form", "root", "n", "n_near", "form_n")
    want = brute_variants(rows, min_chars)
    assert any(r[1] and r[2] != r[1] for r in want) and any(len(r[0]) > 64 and r[4] for r in want)
    assert Counter(map(tuple, out.collect())) == want


def test_very_long_words_and_pieces(spark):
    frame = spark.createDataFrame(spelling_rows(3)[-1:] * 2, "doc_id long, text string")
    out = spelling.variants(frame).collect()
    assert sum(r.n for r in out) == 4 and all(len(r.word) in (120000, 119999) for r in out)
    text = "ab cde " * 7 + "fgh"
    for size in (1, 2, 3, 5, 100):
        spelling_piece, spelling.PIECE = spelling.PIECE, size
        assert [w for p in spelling.pieces(text) for w in spelling.RUN.findall(p)] == spelling.RUN.findall(text)
        spelling.PIECE = spelling_piece


def test_no_documents_no_words(empty):
    assert spelling.variants(empty).count() == 0
