import random

import pytest

CLASH = ["row", "keep", "rid", "t", "hash", "stream", "kept", "score", "n_hit", "chunk", "fp"]


def make_texts(seed=7, n=60):
    """Small prose with copies, near copies, shared passages and lines, and odd texts."""
    rnd = random.Random(seed)
    vocab = ["Wort", "été", "niño", "ÉTÉ", "I", "x"] + [f"w{i}" for i in range(120)]
    say = lambda k: " ".join(rnd.choice(vocab) for _ in range(k))
    passage, line = say(30), "A Line that several documents share " + say(4)
    texts = []
    for i in range(n):
        parts = [say(rnd.randint(1, 60))]
        if i % 5 == 0:
            parts.append(passage[: rnd.randint(60, len(passage))])
        if i % 4 == 0:
            parts.append(("  " if i % 8 else "\t") + (line if i % 3 else line.upper()) + " ")
        if i % 6 == 0:
            parts.append(line)
        parts.append(say(rnd.randint(0, 30)))
        texts.append("\n".join(parts))
    texts += [texts[3]] * 4 + [texts[5].replace("w1", "w2", 1), texts[10] + " end"]
    texts += [None, "", " \n\t ", "one", "one two", "\n\n", "Σίσυφος " * 40, "İstanbul ǅ Ⅷ Wort " * 20, "long " * 5000]
    return texts


def make_rows(seed=7):
    rows = [(i * 3 - 20, t) for i, t in enumerate(make_texts(seed))]
    rows.append(rows[8])                       # a repeated row
    rows.append((rows[12][0], rows[15][1]))    # a repeated id with another text
    rows += [(None, rows[0][1]), (None, rows[0][1]), (None, None)]
    return rows


@pytest.fixture(scope="session")
def rows():
    return make_rows()


@pytest.fixture(scope="session")
def docs(spark, rows):
    """Documents with hard cases and extra columns with names that operators use inside."""
    cols = ", ".join(f"{c} string" for c in CLASH)
    data = [(i, t, ["en", None][k % 2], ["src0", "src0", "src1", "other", None][k % 5], None if t is None else len(t), *(["x"] * len(CLASH))) for k, (i, t) in enumerate(rows)]
    return spark.createDataFrame(data, f"doc_id long, text string, lang string, source string, n_chars long, {cols}").repartition(5).cache()


@pytest.fixture(scope="session")
def empty(docs):
    return docs.limit(0)
