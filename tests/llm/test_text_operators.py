"""Text operators against brute force over a small table of hard cases."""

import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from quarry.llm import chunks, decontaminate, language_model, line_dedup, mixing, simhash, substring_dedup

UP, LOW = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
lower = lambda s: s.translate(str.maketrans(UP, LOW))
words = lambda t: re.findall(r"[^\x20\x09-\x0D]+", t or "")
bag = lambda rows: Counter(map(tuple, rows))


@pytest.mark.parametrize("docs_each", [20, 80])
def test_rows_of_a_chunk_do_not_grow_with_the_corpus(spark, docs_each):
    """Ten regions at most answer a chunk, however many slabs there are; every key gets the
    sum over all chunks, and the numbers add up over the slabs."""
    texts = [(i, " ".join(f"k{(i * 7 + j * j) % 97}" for j in range(40))) for i in range(docs_each)]
    table = chunks.chunk_table(spark.createDataFrame(texts, "doc_id long, text string"), [F.col("doc_id"), F.col("text")], 300)
    slabs = docs_each * 3

    def keys(row):
        found = Counter(w for t in chunks.decode(row["payload"]).column(1).to_pylist() for w in t.split())
        made = sorted((xxhash.xxh64_intdigest(w), n) for w, n in found.items())
        return np.array([k for k, _ in made], np.uint64), np.array([n for _, n in made], np.uint64)

    def add(slab, arrays):
        each, place = np.unique(arrays[0], return_inverse=True)
        return [np.bincount(place, arrays[1].astype(float)).astype(np.uint64)[place]], [len(each)]

    asked = chunks.ask(table, lambda row: [(chunks.slab_of(keys(row)[0], slabs), keys(row))], add, slabs, 2, 1, 10)
    total = Counter(xxhash.xxh64_intdigest(w) for _, t in texts for w in t.split())
    found = table.join(asked, "chunk").collect()
    assert len(found) == table.count() > docs_each / 4
    for r in found:
        assert chunks.answered(r.answers).tolist() == [total[k] for k in keys(r)[0].tolist()] and len(r.answers) <= 10
    assert sum(n for r in found for a in r.answers for n in a["sums"]) == len(total)


def test_packed_integers():
    top = np.iinfo(np.uint64).max
    for values in ([], [0], [1, 0, 1], [top], [5, 5, 9, 1 << 40], [9, 5, top, 0], [0] * 9, range(1000)):
        x = np.array(values, np.uint64)
        assert chunks.unpack(chunks.pack(x), len(x)).tolist() == x.tolist()


@pytest.mark.parametrize("window, chunk, regions", [(13, 1 << 20, 1 << 14), (3, 2000, 1 << 14), (3, 2000, 4), (13, 700, 1)])
def test_substring_dedup(docs, rows, window, chunk, regions):
    first = {}
    key = lambda i: float("inf") if i is None else i
    for i, t in rows:
        w = words(t)
        for a in range(len(w) - window + 1):
            g = tuple(w[a:a + window])
            first[g] = min(first.get(g, float("inf")), key(i))
    want = []
    for i, t in rows:
        w = words(t)
        gone = {a + j for a in range(len(w) - window + 1) if first[tuple(w[a:a + window])] < key(i) for j in range(window)}
        want.append((i, len(w), len(gone), " ".join(x for p, x in enumerate(w) if p not in gone)))
    out = substring_dedup.substring_dedup(docs, window, chunk, 500, regions).select("doc_id", "n_words", "n_removed", "kept", "removed").collect()
    assert bag(r[:4] for r in out) == bag(want)
    assert all(sum(n for _, n in r.removed) == r.n_removed for r in out)


def test_line_dedup(docs, rows):
    strip = lambda x: lower(x.strip(" \t\n\x0b\f\r"))
    held = defaultdict(set)
    for i, t in rows:
        for x in (t or "").split("\n"):
            held[strip(x)].add(i)
    last = {k: max((i for i in v if i is not None), default=None) for k, v in held.items() if len(k) >= 20 and len(v) >= 3}
    want = []
    for i, t in rows:
        lines = (t or "").split("\n")
        kept = [x for x in lines if strip(x) not in last or last[strip(x)] == i]
        want.append((i, len(lines), len(lines) - len(kept), "\n".join(kept)))
    assert any(w[2] for w in want)
    maps = line_dedup.keep_bitmaps(docs)
    out = line_dedup.apply_keep(docs, maps).select("row.doc_id", "n_lines", "n_dropped", "kept", "row.fp").collect()
    assert bag(r[:4] for r in out) == bag(want) and all(r.fp == "x" for r in out)
    for m in maps.collect():
        bits = np.unpackbits(np.frombuffer(bytes(m.keep), np.uint8))
        assert len(bits) == -(-m.n_lines // 8) * 8 and bits[: m.n_lines].sum() == m.n_lines - m.n_dropped


def brute_fingerprint(t, k=3):
    w = lower(t or "").encode().split()
    grams = [b" ".join(w[a:a + k]) for a in range(len(w) - k + 1)] if len(w) >= k else [b" ".join(w)] * bool(w)
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(prints, radius):
    label = {f: f for f in prints}
    find = lambda x: x if label[x] == x else find(label[x])
    fs = sorted(prints)
    for a in fs:
        for b in fs:
            if a < b and (a ^ b).bit_count() <= radius and find(a) != find(b):
                label[find(b)] = find(a)
    return {f: find(f) for f in fs}


def test_simhash(docs, rows):
    prints = [brute_fingerprint(t) for _, t in rows]
    root = components(set(prints), 3)
    smallest = {}
    for (i, _), f in zip(rows, prints):
        if i is not None:
            smallest[root[f]] = min(smallest.get(root[f], i), i)
    want = [(i, f - (1 << 64) if f >> 63 else f, smallest.get(root[f])) for (i, _), f in zip(rows, prints)]
    assert bag(simhash.near_duplicates(docs).collect()) == bag(want)
    kept = simhash.keep_first(docs)
    assert kept.columns == docs.columns
    assert {r.doc_id for r in kept.collect()} == set(smallest.values())


def test_keep_first_keeps_one_row_of_each_group(spark):
    """Repeated rows, an id in several groups, other columns that differ, groups without ids."""
    text = {g: " ".join(f"{g}{i}" for i in range(30)) for g in "abcdef"}
    data = [(1, "a", "x")] * 3 + [(2, "a", "x"), (None, "a", "x")]      # repeated rows of the leading id
    data += [(1, "b", "x"), (0, "b", "x"), (5, "c", "x"), (1, "c", "x")]  # an id that leads elsewhere
    data += [(7, "d", "x"), (7, "d", "y"), (7, "d", None)]              # one id and text, other columns
    data += [(None, "e", "x")] * 3 + [(None, "e", None), (None, "f", "x"), (9, "f", "x")]
    docs = spark.createDataFrame([(i, text[g], s, g) for i, g, s in data], "doc_id long, text string, source string, fp string").repartition(5)
    out = simhash.keep_first(docs).collect()
    assert Counter((r.fp, r.doc_id) for r in out) == Counter({("a", 1): 1, ("b", 0): 1, ("c", 1): 1, ("d", 7): 1, ("e", None): 1, ("f", 9): 1})
    assert all(r.text == text[r.fp] for r in out)


def test_covering_masks_miss_no_pair_within_the_radius(spark):
    rnd = np.random.default_rng(3)
    for turn in (0, 1):
        masks = [m & (1 << 64) - 1 for m in simhash.masks(3, turn)]
        assert len(masks) == 15
        for _ in range(3000):
            diff = sum(1 << int(b) for b in rnd.choice(64, 3, replace=False))
            assert any(diff & m == 0 for m in masks)
    base = rnd.integers(0, 2**63, 40, dtype=np.int64)
    fps = {int(b) ^ sum(1 << int(x) for x in rnd.choice(63, k, replace=False)) for b in base for k in (0, 1, 2, 3, 5) for _ in range(3)}
    frame = spark.createDataFrame([(f,) for f in fps], "fp long")
    want = components({f & (1 << 64) - 1 for f in fps}, 3)
    for split in (50_000, 2):  # small: every bucket is covered a second time
        got = {f & (1 << 64) - 1: f & (1 << 64) - 1 for f in fps}
        find = lambda x: x if got[x] == x else find(got[x])
        for a, b in simhash.links(frame, 3, split).collect():
            a, b = find(a & (1 << 64) - 1), find(b & (1 << 64) - 1)
            got[max(a, b)] = min(a, b)
        assert Counter(Counter(find(f) for f in got).values()) == Counter(Counter(want.values()).values())


BENCH = [(1, 4), (2, 9), (3, 22), (3, 2)]


def bench_rows(rows):
    texts = [t for _, t in rows if t and len(words(t)) > 30]
    out = [(i, " ".join(words(texts[k])[:18]).upper()) for k, (i, _) in enumerate(BENCH)]
    return out + [(7, "one two"), (8, None), (9, ""), (None, "Σίσυφος Σίσυφος"), (11, "never found in any of these documents at all, not even once or twice")]


@pytest.mark.parametrize("part_bytes", [1 << 20, 60])
def test_decontamination(spark, docs, rows, part_bytes):
    split = lambda t: re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower(t or ""))
    items = bench_rows(rows)
    wins = set()
    for i, t in items:
        w = split(t)
        n = min(13, len(w))
        wins |= {(str(i) if i is not None else "null", tuple(w[a:a + n])) for a in range(len(w) - n + 1) if n}
    want = []
    for i, t in rows:
        w, hit, names = split(t), set(), set()
        for name, g in wins:
            for a in range(len(w) - len(g) + 1):
                if tuple(w[a:a + len(g)]) == g:
                    hit |= set(range(a, a + len(g)))
                    names.add(name)
        want.append((i, len(w), len(hit), ",".join(sorted(names))))
    assert sum(w[2] > 0 for w in want) > 5
    bench = spark.createDataFrame(items, "item_id long, text string")
    out = decontaminate.contamination(docs, bench, ["doc_id"], part_bytes=part_bytes).select("row.doc_id", "n_words", "n_hit", F.array_join("items", ","))
    assert bag(out.collect()) == bag(want)
    clean = decontaminate.clean_documents(docs, bench)
    assert clean.columns == docs.columns
    assert Counter(r.doc_id for r in clean.collect()) == Counter(i for i, n, h, _ in want if not (h and 20 * h >= n))


def test_longest_matches(spark):
    a = " ".join(f"a{i}" for i in range(40))
    docs = spark.createDataFrame([(1, "x y " + " ".join(f"a{i}" for i in range(5, 30)) + " z"), (2, "nothing")], "doc_id long, text string")
    bench = spark.createDataFrame([(9, a)], "item_id long, text string")
    assert [tuple(r) for r in decontaminate.longest_matches(docs, bench).collect()] == [(1, "9", 5, 2, 25)]


@pytest.mark.parametrize("chunk, regions", [(1 << 20, 1 << 14), (3000, 1 << 14), (3000, 5)])
def test_language_model(docs, rows, chunk, regions):
    train = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    out = language_model.score(docs, train, chunk, 300, regions).collect()
    tokens = [[*(w.decode() for w in (t or "").encode().translate(bytes.maketrans(UP.encode(), LOW.encode())).split()), None] for _, t in rows]
    on = [i is not None and zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    c = Counter(w for t, o in zip(tokens, on) if o for w in t)
    n, v = sum(c.values()), len(c)
    want = Counter((i, len(t), sum(c[w] > 0 for w in t), n, round(float(sum(np.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in t)), 6)) for (i, _), t in zip(rows, tokens))
    assert Counter((r.doc_id, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in out) == want
    assert all(r.score < 0 for r in out)
    seen, base = sum(r.score for r in out if r.doc_id is not None), sum(r.base_score for r in out if r.doc_id is not None)
    assert seen > base


def plain_scores(rows, on, rounds=60):
    """The model token by token: counts without the token's own text, exact estimates."""
    texts = [[*(w.decode() for w in (t or "").encode().translate(bytes.maketrans(UP.encode(), LOW.encode())).split()), None] for _, t in rows]

    def grams(t):
        padded = ["<s>", "<s>", *t]
        return [tuple(tuple(padded[k + 2 - o:k + 3]) for o in range(3)) for k in range(len(t))]

    per = [Counter(g for gs in grams(t) for g in gs) for t in texts]
    total = Counter()
    for c, o in zip(per, on):
        total.update(c if o else {})
    floor, n_docs, n = 1 / (sum(len(g) == 1 for g in total) + 1), sum(on), sum(len(t) for t, o in zip(texts, on) if o)

    def parts(d, deleted):
        own, docs, tokens = (per[d], n_docs - 1, n - len(texts[d])) if deleted else (Counter(), n_docs, n)
        get = lambda g: docs if set(g) == {"<s>"} else total[g] - own[g]
        for one, two, three in grams(texts[d]):
            c2, c3 = get(two[:1]), get(three[:2])
            octave = lambda x: min(15, int(np.log2(max(x, 1))))
            bucket = 16 + octave(c3) if c3 else octave(c2) if c2 else 0
            yield bucket, [floor, get(one) / max(1, tokens), get(two) / c2 if c2 else 0, get(three) / c3 if c3 else 0]

    held = [x for d in range(len(rows)) if on[d] for x in parts(d, True)]
    bucket, p = np.array([b for b, _ in held]), np.array([e for _, e in held])
    w = np.full((32, 4), 0.25)
    for _ in range(rounds):
        part = w[bucket] * p
        part /= part.sum(axis=1, keepdims=True)
        sums = np.stack([np.bincount(bucket, part[:, k], 32) for k in range(4)], axis=1) + 0.5
        w = sums / sums.sum(axis=1, keepdims=True)
    return [sum(float(np.log10(w[b] @ np.array(e))) for b, e in parts(d, False)) for d in range(len(rows))]


def test_language_model_scores_as_a_plain_model(docs, rows):
    """In one chunk as in many: only the rounding of estimates to eighths of an octave differs."""
    on = [i is not None and zlib.crc32(str(i).encode()) % 10 != 0 for i, _ in rows]
    size = lambda t: len((t or "").encode().split()) + 1
    want = sorted((str(i), size(t), s) for (i, t), s in zip(rows, plain_scores(rows, on)))
    train = F.crc32(F.col("doc_id").cast("string")) % 10 != 0
    for frame, chunk in ((docs.coalesce(1), 1 << 20), (docs, 3000)):
        got = sorted((str(r.doc_id), r.n_tokens, r.score) for r in language_model.score(frame, train, chunk).collect())
        assert [g[:2] for g in got] == [w[:2] for w in want]
        assert max(abs(g[2] / w[2] - 1) for g, w in zip(got, want)) < 0.01


def test_weights_recover_a_mixture():
    """EM finds the weights of the mixture whose expected counts it is given."""
    true = np.array([0.05, 0.25, 0.3, 0.4])
    steps = np.array([1, 2, 3, 4, 5, 6, 7, 7])  # a word's probability is 2^-step
    orders = [steps, np.roll(steps, 3), steps[::-1]]
    floor, cells = 1 / 8, []
    for word in range(8):
        s = [int(o[word]) for o in orders]
        p = true @ np.array([floor, *(2.0**-x for x in s)])
        cells.append(((3 << 21) | sum((x + 1) << (7 * k) for k, x in enumerate(s)), int(1e7 * p)))
    w = language_model.learn_weights(cells, floor, rounds=5000)
    assert np.allclose(w.sum(axis=1), 1) and np.abs(w[3] - true).max() < 0.02
    assert np.allclose(w[2], 0.25)  # no token has that context
    few = language_model.learn_weights(cells, floor, rounds=1)
    assert np.abs(few[3] - true).max() > np.abs(w[3] - true).max()
    assert np.allclose(language_model.learn_weights([], floor), 0.25)


def test_mixing(docs, rows):
    weights = {"src0": 5, "src1": 2, "*": 3}
    out = mixing.mix(docs, weights, block_rows=2, digits=1).select("row.doc_id", "row.source", "stream", "block", "slot", "place").collect()
    assert len(out) == len(rows) == len({r.place for r in out})
    per = defaultdict(list)
    for r in out:
        assert r.stream == (r.source if r.source in weights else "*") and r.place // 2 == r.slot
        per[r.stream].append(r.slot)
    for s in per:
        per[s] = sorted(set(per[s]))
    end = min(v[-1] for v in per.values())
    for slot in range(1, end + 1):  # before a source runs out: within less than one block of the target
        for s, a in weights.items():
            assert abs(sum(x < slot for x in per[s]) - slot * a / 10) < 1


def test_schedule_meets_all_deadlines():
    for weights in ({"a": 1}, {"a": 7, "b": 1, "c": 3}, {c: k + 1 for k, c in enumerate("abcdefghij")}, {"a": 1, "b": 1, "c": 1}):
        order, total = mixing.period(weights), sum(weights.values())
        for slot in range(1, total + 1):
            got = Counter(s for s, _ in order[:slot])
            assert all(abs(got[s] - slot * a / total) < 1 for s, a in weights.items())


def test_empty_tables(spark, empty):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert substring_dedup.substring_dedup(empty).count() == 0
    assert line_dedup.apply_keep(empty, line_dedup.keep_bitmaps(empty)).count() == 0
    assert simhash.near_duplicates(empty).count() == 0
    assert decontaminate.clean_documents(empty, bench).count() == 0
    assert language_model.score(empty, F.lit(True)).count() == 0
    assert mixing.mix(empty, {"a": 1}).count() == 0


def test_empty_benchmark(spark, docs):
    bench = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.clean_documents(docs, bench).count() == docs.count()


