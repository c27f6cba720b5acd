"""Spelling variants by a relational trie frontier.

Two words are near if one inserted, deleted or replaced code point makes them equal.  All
words are searched at once in tries that are tables of edges: (node, code point, words
below, check of the rest, code points that follow).  A search state is (word, position,
node, edits); a frontier of states is joined with the edge table, level by level.  States
without an edit stand on the nodes of their own word.  There an edit is made: a code point
is replaced by any other edge of the node, or left out.  A state with an edit follows the
one edge that spells the rest of its word, until the word ends or only one word is left
below the node, whose rest is compared at once.

Every length has tries of its own, one of the words and one of the reversed words, so a
state only meets words it can end in; edits are made in the later half of either, where
nodes have few edges.  A pair with a deletion is found from the longer word, a pair with a
replacement from the smaller code point; both get each other as neighbours.  A node has at
most as many edges as there are letters, so no join multiplies rows further than that.

Words of more than ``LONG`` code points would need that many levels.  They are matched by
64-bit sums over all but one code point (each with its place, or moved up), at most as many
rows a word as it has code points, and compared code point by code point afterwards.

Defined cases
* null text: no words.  null doc_id: its words lose no code point.
* very long texts are cut into pieces between words; very long words as above.
* repeated rows and documents: every occurrence counts.
* ties for the form: larger count first, then the smaller word in code-point order.
* empty table: no rows.  Other columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.words import LOWER, POWERS
from quarry.session import materialize, release, ship_package

# Fixed values of the contract: letters, which occurrences lose a code point, word sizes.
RUN = re.compile("[a-zÀ-ÿ]+")
DROP_EVERY = 31
MIN_CHARS = 7
MIN_COUNT = 2
TIMES = 10                # a form is at least so many times as frequent
LONG = 64                 # levels of the tries
PIECE = 1 << 20           # characters of text taken at a time
HELD = 1 << 18            # distinct words a task holds before it sends their counts
ROWS = 1 << 16


def pieces(text: str) -> Iterator[str]:
    """The text in pieces that end between words."""
    begin = 0
    while begin < len(text):
        end = begin + PIECE
        inside = RUN.match(text, end) if end < len(text) else None
        end = inside.end() if inside else end
        yield text[begin:end]
        begin = end


def count_words(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT) -> DataFrame:
    """(word, n): lower-cased runs of letters, some of which lose a code point, that are long
    and frequent enough.  Tasks add up their counts before the shuffle."""
    ship_package(docs.sparkSession)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def send():
            rows = pa.RecordBatch.from_pydict({"word": pa.array(held.keys(), pa.string()), "n": pa.array(held.values(), pa.int64())})
            held.clear()
            return rows

        for batch in batches:
            for doc_id, text in zip(batch.column(0), batch.column(1)):
                if not text.is_valid:
                    continue
                start = zlib.crc32(f"{doc_id.as_py()}:".encode()) if doc_id.is_valid else None
                for piece in pieces(text.as_buffer().to_pybytes().translate(LOWER).decode()):
                    for word, n in Counter(RUN.findall(piece)).items():
                        if len(word) < min_chars:
                            continue
                        if start is not None:
                            h = zlib.crc32(word.encode(), start)
                            if h % DROP_EVERY == 0:
                                at = h % len(word)
                                word = word[:at] + word[at + 1:]
                                if len(word) < min_chars:
                                    continue
                        held[word] += n
                    if len(held) > HELD:
                        yield send()
        if held:
            yield send()

    counted = docs.select(F.col("doc_id").cast("string"), F.col("text").cast("string")).mapInArrow(count, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= min_count)


def letter(s: Column, at: Column) -> Column:
    return F.substring(s, at + 1, F.lit(1))


def rest(s: Column, at: Column) -> Column:
    return F.substring(s, at + 1, F.char_length(s))


def node(s: Column, depth: Column, way: Column, size: Column) -> Column:
    """Name of the node of a prefix, in the trie of one length and direction."""
    return F.concat(F.left(s, depth), way, size.cast("string"))


def bit(s: Column, at: Column) -> Column:
    """Of 64, for the code point at a place."""
    return F.call_function("shiftleft", F.lit(1).cast("long"), F.ascii(letter(s, at)) % 64)


def both_ways(words: DataFrame) -> DataFrame:
    """(word, n, way, s, size, low): each word as it is and reversed, and the depth from
    which edits are made; together they make one at every place."""
    size, half = F.char_length("word"), F.floor(F.char_length("word") / 2).cast("int")
    way = lambda w, s, low: F.struct(F.lit(w).alias("way"), s.alias("s"), low.alias("low"))
    ways = F.array(way(">", F.col("word"), half), way("<", F.reverse("word"), size - half))
    return words.select("word", "n", size.alias("size"), F.explode(ways).alias("w")).select("word", "n", "size", "w.*")


def unedited(ways: DataFrame) -> DataFrame:
    """The states without an edit: a word on each node of its own from ``low`` on."""
    states = ways.select("word", "n", "way", "s", "size", F.explode(F.sequence(F.col("low"), F.col("size") - 1)).alias("position"))
    return states.withColumn("node", node(F.col("s"), F.col("position"), F.col("way"), F.col("size")))


def edge_table(states: DataFrame) -> DataFrame:
    """(node, letter, below, left, follow): the edges of the tries, with the number of words
    below, the smallest check of what is left of them, and the letters that follow."""
    s, at = F.col("s"), F.col("position")
    rows = states.select("node", letter(s, at).alias("letter"), F.xxhash64(rest(s, at + 1)).alias("left"), bit(s, at + 1).alias("follow"))
    return rows.groupBy("node", "letter").agg(F.count("*").alias("below"), F.min("left").alias("left"), F.bit_or("follow").alias("follow"))


def goes_on(s: Column, at: Column) -> Column:
    """Whether the string from ``at`` on can be spelled below an edge."""
    alone = F.col("left") == F.xxhash64(rest(s, at))
    return F.when(F.col("below") == 1, alone).otherwise(F.col("follow").bitwiseAND(bit(s, at)) != 0)


def replaced(states: DataFrame, edges: DataFrame) -> DataFrame:
    """(word, n, way, aim, position, found): states after a replacement; ``aim`` is what the
    word would be."""
    s, at = F.col("s"), F.col("position")
    met = states.join(edges, "node").where((F.col("letter") > letter(s, at)) & goes_on(s, at + 1))
    aim = F.concat(F.left(s, at), F.col("letter"), rest(s, at + 1))
    return met.select("word", "n", "way", aim.alias("aim"), (at + 1).alias("position"), (F.col("below") == 1).alias("found"))


def shortened(ways: DataFrame) -> DataFrame:
    """States after a deletion, none of their node's edges taken yet.  Of equal neighbouring
    letters the last is left out."""
    s, at = F.col("s"), F.col("position")
    states = ways.select("word", "n", "way", "s", "size", F.explode(F.sequence(F.col("low"), F.col("size") - 1)).alias("position"))
    states = states.where(letter(s, at) != letter(s, at + 1))
    aim = F.concat(F.left(s, at), rest(s, at + 1))
    # without its last letter a word stands at an end: one edge back
    return states.select("word", "n", "way", aim.alias("aim"), F.least(at, F.col("size") - 2).alias("position"))


def step(frontier: DataFrame, edges: DataFrame) -> DataFrame:
    """One level: every state takes the edge with its next letter, if there is one."""
    aim, at = F.col("aim"), F.col("position")
    states = frontier.withColumn("node", node(aim, at, F.col("way"), F.char_length(aim))).withColumn("letter", letter(aim, at))
    met = states.join(edges, ["node", "letter"]).where(goes_on(aim, at + 1))
    return met.select("word", "n", "way", "aim", (at + 1).alias("position"), (F.col("below") == 1).alias("found"))


def frontier_pairs(words: DataFrame, min_chars: int) -> DataFrame:
    """(a, n_a, b): words and what they become by one edit, of at most LONG code points; b
    may still be no word (its last letters were compared by a check)."""
    short = both_ways(words.where(F.char_length("word") <= LONG))
    edges = materialize(edge_table(unedited(short)), "spelling-edges")
    longer = both_ways(words.where(F.char_length("word").between(min_chars + 1, LONG + 1)))
    rounds = [materialize(replaced(unedited(short), edges), "spelling-frontier"), materialize(step(shortened(longer), edges), "spelling-frontier")]
    frontier = rounds[0].unionByName(rounds[1]).where(~F.col("found")).drop("found")
    while not frontier.isEmpty():
        rounds.append(materialize(step(frontier, edges), "spelling-frontier"))
        frontier = rounds[-1].where(~F.col("found")).drop("found")
    release(edges)
    found = rounds[0]
    for r in rounds[1:]:
        found = found.unionByName(r)
    b = F.when(F.col("way") == ">", F.col("aim")).otherwise(F.reverse("aim"))
    return found.where("found").select(F.col("word").alias("a"), F.col("n").alias("n_a"), b.alias("b"))


def sums_but_one(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, whole, place, masked, shortened) for every place of a word: sums over its code
    points, each times a power of a number, without that place's, and with later ones moved up."""
    for batch in batches:
        for word_id, word in zip(batch.column(0).to_pylist(), batch.column(1)):
            points = np.frombuffer(word.as_py().encode("utf-32-le"), np.uint32).astype(np.uint64)
            n = len(points)
            terms = points * POWERS[0].get(n)[0]
            total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(terms, dtype=np.uint64)])
            for a in range(0, n, ROWS):
                b = min(n, a + ROWS)
                moved = total[a:b] + (total[n] - total[a + 1:b + 1]) * np.uint64(POWERS[0].inv)
                yield pa.RecordBatch.from_pydict({
                    "id": pa.array(np.full(b - a, word_id), pa.int64()), "size": pa.array(np.full(b - a, n), pa.int64()), "whole": pa.array(np.full(b - a, total[n]).view(np.int64)),
                    "place": pa.array(np.arange(a, b), pa.int64()), "masked": pa.array((total[n] - terms[a:b]).view(np.int64)), "shortened": pa.array(moved.view(np.int64)),
                })


def long_pairs(words: DataFrame) -> DataFrame:
    """(a, n_a, b) for words of more than LONG code points on both sides."""
    ship_package(words.sparkSession)
    long = words.where(F.char_length("word") > LONG).select(F.xxhash64("word").alias("id"), "word", "n")
    sums = materialize(long.select("id", "word").mapInArrow(sums_but_one, "id long, size long, whole long, place long, masked long, shortened long"), "spelling-sums")
    one = sums.select("size", "place", "masked", F.col("id").alias("a"))
    two = sums.select("size", "place", "masked", F.col("id").alias("b"))
    masked = one.join(two, ["size", "place", "masked"]).where(F.col("a") < F.col("b")).select("a", "b")
    whole = sums.select(F.col("size") + 1, "whole", F.col("id").alias("b")).where(F.col("place") == 0).toDF("size", "shortened", "b")
    less = sums.select("size", "shortened", F.col("id").alias("a")).join(whole, ["size", "shortened"]).select("a", "b")
    ids = masked.unionByName(less).distinct()
    left = long.select(F.col("id").alias("a"), F.col("word").alias("word_a"), F.col("n").alias("n_a"))
    right = long.select(F.col("id").alias("b"), F.col("word").alias("word_b"))
    both = ids.join(left, "a").join(right, "b").where(F.levenshtein("word_a", "word_b", 1) == 1)
    return both.select(F.col("word_a").alias("a"), "n_a", F.col("word_b").alias("b"))


def near_words(words: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """(word, near, near_n): every ordered pair of near words of a stored (word, n) table."""
    pairs = frontier_pairs(words, min_chars)
    if not words.where(F.char_length("word") > LONG).isEmpty():
        pairs = pairs.unionByName(long_pairs(words))
    known = words.select(F.col("word").alias("b"), F.col("n").alias("n_b"))
    pairs = pairs.distinct().join(known, "b")
    ends = lambda x, y, n: F.struct(F.col(x).alias("word"), F.col(y).alias("near"), F.col(n).alias("near_n"))
    return pairs.select(F.explode(F.array(ends("a", "b", "n_b"), ends("b", "a", "n_a"))).alias("p")).select("p.*")


def roots(forms: DataFrame) -> DataFrame:
    """(word, root) for (word, form): the last of each chain of forms.  Every round doubles
    the steps taken; a form's count is TIMES the word's at least, so chains are short."""
    at = materialize(forms.select("word", F.col("form").alias("root")), "spelling-roots")
    while True:
        on = at.select(F.col("word").alias("root"), F.col("root").alias("next"))
        moved = materialize(at.join(on, "root", "left").select("word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spelling-roots")
        release(at)
        at = moved.drop("moved")
        if moved.where("moved").isEmpty():
            return at


def variants(docs: DataFrame, min_chars: int = MIN_CHARS, min_count: int = MIN_COUNT, times: int = TIMES) -> DataFrame:
    """(word, form, root, n, n_near, form_n) for every word of ``docs``."""
    words = materialize(count_words(docs, min_chars, min_count), "spelling-words")
    best = F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best")
    near = near_words(words, min_chars).groupBy("word").agg(F.count("*").alias("n_near"), best)
    judged = words.join(near, "word", "left")
    fits = -F.col("best.less") >= times * F.col("n")
    judged = judged.select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n"))
    judged = materialize(judged, "spelling-judged")
    last = roots(judged.where(F.col("form").isNotNull()))
    return judged.join(last, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
