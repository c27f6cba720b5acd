"""The registered query of each operator: production parameters, whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quarry.llm import conversation_trie, decontaminate, language_model, line_dedup, mixing, pii, rendezvous, simhash, spelling, substring_dedup, toxicity, urls, vptree
from quarry.sources.tables import table

# Secret of the surrogates; a deployment passes its own to ``pii.replace_entities``.
PII_KEY = "a key for tests only"

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

# Target weights of the mixture, in parts, one for each source; unknown sources share OTHER.
MIX_WEIGHTS = {"src0": 4, **{f"src{i}": 3 for i in range(1, 5)}, **{f"src{i}": 2 for i in range(5, 20)}, mixing.OTHER: 1}


def query(name: str, oracle: str | None = None):
    def add(fn):
        QUERIES[name] = fn
        if oracle is not None:
            ORACLES[name] = oracle
        return fn

    return add


def mixture_oracle(weights: dict[str, int], block_rows: int) -> str:
    """The schedule of one period as a VALUES list, ranks by a window."""
    values = ", ".join(f"('{s}', {j}, {slot}, {weights[s]})" for slot, (s, j) in enumerate(mixing.period(weights)))
    named = ", ".join(f"'{s}'" for s in weights if s != mixing.OTHER)
    return f"""
WITH sched(stream, turn_block, turn_slot, weight) AS (VALUES {values}),
r AS (SELECT doc_id, source, CASE WHEN source IN ({named}) THEN source ELSE '{mixing.OTHER}' END AS stream,
             md5(coalesce(CAST(doc_id AS VARCHAR), '')) AS h, md5(text) AS t FROM documents),
k AS (SELECT *, row_number() OVER (PARTITION BY stream ORDER BY h, doc_id NULLS FIRST, t NULLS FIRST) - 1 AS rank FROM r),
b AS (SELECT *, CAST(rank // {block_rows} AS BIGINT) AS block FROM k)
SELECT doc_id, source, b.stream, block, (block // weight) * {sum(weights.values())} + turn_slot AS slot,
       ((block // weight) * {sum(weights.values())} + turn_slot) * {block_rows} + rank % {block_rows} AS place
FROM b JOIN sched s ON s.stream = b.stream AND s.turn_block = block % weight"""


SUBSTRING_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
g AS (SELECT r, doc_id, i, list_aggregate(w[i:i + {substring_dedup.WINDOW - 1}], 'string_agg', ' ') AS g
      FROM (SELECT *, unnest(generate_series(1, len(w) - {substring_dedup.WINDOW - 1})) AS i FROM d)),
m AS (SELECT g, min(doc_id) AS first_doc FROM g GROUP BY g),
gone AS (SELECT r, count(DISTINCT p) AS n, list(DISTINCT p) AS ps
         FROM (SELECT r, unnest(generate_series(i, i + {substring_dedup.WINDOW - 1})) AS p FROM g JOIN m USING (g)
               WHERE first_doc < doc_id OR doc_id IS NULL AND first_doc IS NOT NULL) GROUP BY r),
words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
kept AS (SELECT r, string_agg(word, ' ' ORDER BY p) AS kept FROM words LEFT JOIN gone USING (r) WHERE ps IS NULL OR NOT list_contains(ps, p) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN gone USING (r) LEFT JOIN kept USING (r)"""


@query("op1_substring_dedup", SUBSTRING_SQL)
def op1_substring_dedup(spark, sf):
    found = substring_dedup.substring_dedup(table(spark, sf, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query("op2_source_mixing", mixture_oracle(MIX_WEIGHTS, mixing.BLOCK_ROWS))
def op2_source_mixing(spark, sf):
    mixed = mixing.mix(table(spark, sf, "documents"), MIX_WEIGHTS, columns=["doc_id", "source"])
    return mixed.select("row.doc_id", "row.source", "stream", "block", "slot", "place")


NEAREST_SQL = f"""
WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
           WHERE vec_id IS NOT NULL AND len(embedding) > 0 AND list_count(embedding) = len(embedding)
             AND len(list_filter(embedding, lambda x: NOT isfinite(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
q AS (SELECT * FROM v WHERE vec_id % 100 = 0),
d AS (SELECT q.vec_id AS query_id, v.vec_id, list_distance(q.e, v.e) AS score FROM q JOIN v ON v.vec_id <> q.vec_id AND len(v.e) = len(q.e))
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id) AS rank FROM d) WHERE rank <= {vptree.K}"""


@query("op3_vptree", NEAREST_SQL)
def op3_vptree(spark, sf):
    return vptree.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


DECONTAMINATION_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, n, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS g
       FROM (SELECT *, unnest(generate_series(1, len(w) - n + 1)) AS i FROM (SELECT *, least({decontaminate.WINDOW}, len(w)) AS n FROM b WHERE len(w) > 0))),
sizes AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT r, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS g
       FROM (SELECT r, w, n, unnest(generate_series(1, len(w) - n + 1)) AS i FROM d, sizes WHERE len(w) >= n)),
occ AS (SELECT r, i, dw.n, item_id FROM dw JOIN bw ON bw.g = dw.g AND bw.n = dw.n),
hits AS (SELECT r, count(DISTINCT p) AS n_hit FROM (SELECT r, unnest(generate_series(i, i + n - 1)) AS p FROM occ) GROUP BY r),
its AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, coalesce(CAST(item_id AS VARCHAR), 'null') AS item FROM occ) GROUP BY r)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items,
       sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hits USING (r) LEFT JOIN its USING (r)"""


@query("op4_decontamination", DECONTAMINATION_SQL)
def op4_decontamination(spark, sf):
    judged = decontaminate.contamination(table(spark, sf, "documents"), table(spark, sf, "benchmark"), ["doc_id"])
    return judged.select(
        "row.doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontaminate.is_contaminated(F.col("n_hit"), F.col("n_words")).alias("contaminated"),
    )


@query("op5_lm_scoring")
def op5_lm_scoring(spark, sf):
    held_out = toxicity.held_out(F.col("doc_id"), 10)
    scored = language_model.score(table(spark, sf, "documents"), F.crc32(F.col("doc_id").cast("string")) % 10 != 0)
    return scored.select("doc_id", held_out.alias("held_out"), "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query("op6_simhash")
def op6_simhash(spark, sf):
    found = simhash.near_duplicates(table(spark, sf, "documents"))
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def rules_oracle(rules: list[tuple[str, str, str]]) -> str:
    """Rules alone; right where no page has redirect or canonical links, as in the tables."""
    values = ", ".join(f"('{v}', '{h}', '{p}')" for v, h, p in rules)
    return f"""
WITH rules(verdict, host, path) AS (VALUES {values}),
p AS (SELECT row_number() OVER () AS r, page_id,
             translate(regexp_extract(coalesce(url, ''), '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(coalesce(url, ''), '://[^/?#]*([^?#]*)', 1) AS path FROM pages),
m AS (SELECT p.r, rules.host || rules.path AS rule, verdict,
             row_number() OVER (PARTITION BY r ORDER BY length(rules.host || rules.path) DESC, verdict) AS nth
      FROM p JOIN rules ON (p.host = rules.host OR ends_with(p.host, '.' || rules.host)) AND starts_with(p.path, rules.path))
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict FROM p LEFT JOIN m ON m.r = p.r AND nth = 1"""


@query("op7_url_filter", rules_oracle(urls.RULES))
def op7_url_filter(spark, sf):
    return urls.judge(table(spark, sf, "pages"), urls.rule_table(spark)).select("page_id", "host", "path", "rule", "verdict")


LINE_SQL = f"""
WITH l AS (SELECT r, doc_id, unnest(lines) AS line, generate_subscripts(lines, 1) AS pos
           FROM (SELECT row_number() OVER () AS r, doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
s AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= {line_dedup.MIN_CHARS}
      GROUP BY key HAVING count(DISTINCT coalesce(CAST(doc_id AS VARCHAR), 'null')) >= {line_dedup.MIN_DOCS})
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM (SELECT k.*, s.key IS NOT NULL AND doc_id IS DISTINCT FROM keeper AS gone FROM k LEFT JOIN s USING (key)) GROUP BY r, doc_id"""


@query("op8_line_dedup", LINE_SQL)
def op8_line_dedup(spark, sf):
    docs = table(spark, sf, "documents")
    applied = line_dedup.apply_keep(docs, line_dedup.keep_bitmaps(docs))
    return applied.select("row.doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


@query("op9_pii_surrogates")
def op9_pii_surrogates(spark, sf):
    replaced = pii.replace_entities(table(spark, sf, "documents"), PII_KEY)
    return replaced.select("row.doc_id", F.col("replaced").alias("text"), "n_replaced")


@query("op10_toxicity")
def op10_toxicity(spark, sf):
    docs, labels = table(spark, sf, "documents"), table(spark, sf, "labels")
    model = toxicity.fit(docs, labels, ~toxicity.held_out(F.col("doc_id"), 5))
    scored = toxicity.score(docs.select("doc_id", "text"), model)
    return scored.select(
        "row.doc_id", toxicity.held_out(F.col("row.doc_id"), 5).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted")
    )


def crc32_sql(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a string expression, bit by bit."""
    byte = f"list_transform(regexp_extract_all(hex(encode({text})), '..'), lambda h: CAST('0x' || h AS BIGINT))"
    turned = "list_reduce(list_prepend(xor(c, y), [CAST(k AS BIGINT) for k in range(8)]), lambda x, k: xor(x >> 1, 3988292384 * (x & 1)))"
    return f"xor(list_reduce(list_prepend(CAST(4294967295 AS BIGINT), {byte}), lambda c, y: {turned}), 4294967295)"


SHARDS = 40
SHARD_SQL = f"""
WITH d AS (SELECT doc_id, row_number() OVER () AS r, text, coalesce(CAST(doc_id AS VARCHAR), 'text ' || sha256(text), 'null') AS k FROM documents),
b AS (SELECT r, s, bid FROM (SELECT r, s, substr(sha256(k || ':' || CAST(s // {rendezvous.PER_HASH} AS VARCHAR)), {rendezvous.HEX} * (s % {rendezvous.PER_HASH}) + 1, {rendezvous.HEX}) AS bid FROM d, range({SHARDS + 1}) t(s))),
w AS (SELECT r, first(s ORDER BY bid DESC, s) FILTER (s < {SHARDS}) AS shard, first(s ORDER BY bid DESC, s) AS grown FROM b GROUP BY r),
p AS (SELECT doc_id, CAST(coalesce(strlen(text), 0) + {rendezvous.PER_ROW} AS BIGINT) AS size, {crc32_sql("coalesce(text, '')")} AS text_crc32, shard, grown,
             substr(sha256(k || ':slot'), 1, {rendezvous.HEX}) AS pos FROM d JOIN w USING (r))
SELECT doc_id, size, text_crc32, 'key' AS law, CAST(shard AS INTEGER) AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY pos, doc_id NULLS FIRST, text_crc32, size) - 1 AS slot, CAST(grown AS INTEGER) AS grown_shard
FROM p"""


@query("op12_sharding", SHARD_SQL)
def op12_sharding(spark, sf):
    placed = rendezvous.assign(table(spark, sf, "documents"), {s: 1.0 for s in range(SHARDS)}, {SHARDS: 1.0})
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")


TRIE_SQL = f"""
WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
k AS (SELECT conv_id, turn, sha256(CAST(length(role) AS VARCHAR) || ':' || role || text) AS key, len(regexp_extract_all(text, '[^\\x20\\x09-\\x0D]+')) AS words FROM t),
o AS (SELECT conv_id, list(key ORDER BY turn NULLS FIRST, key) AS keys, list(words ORDER BY turn NULLS FIRST, key) AS words FROM k GROUP BY conv_id),
h AS (SELECT *, {crc32_sql("CAST(conv_id AS VARCHAR)")} % {conversation_trie.HEADS} AS h FROM o),
r AS (SELECT h.conv_id, coalesce(b.keys[1:h], []) || h.keys[h + 1:] AS keys, coalesce(b.words[1:h], []) || h.words[h + 1:] AS words
      FROM h LEFT JOIN o b ON b.conv_id = h.conv_id - h.conv_id % {conversation_trie.FAMILY}),
p AS (SELECT conv_id, d, array_to_string(keys[1:d], '') AS path, CASE WHEN d > 0 THEN words[d] ELSE 0 END AS words, d = len(keys) AS ends
      FROM (SELECT *, unnest(range(len(keys) + 1)) AS d FROM r)),
n AS (SELECT path, d AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(words) AS words,
             string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends) AS ids FROM p GROUP BY path, d),
c AS (SELECT substr(path, 1, length(path) - 64) AS path, count(*) AS n_children FROM n WHERE depth > 0 GROUP BY 1),
s AS (SELECT substr(path, 1, 64 * i) AS path, sum((n_convs - 1) * words) AS saved, count(*) FILTER (n_children IS NULL) AS n_leaves
      FROM (SELECT n.*, n_children, unnest(range(depth + 1)) AS i FROM n LEFT JOIN c USING (path)) GROUP BY 1)
SELECT n.conv_id, n.depth, u.conv_id AS parent_conv_id, n.n_convs, coalesce(n_children, 0) AS n_children, n_leaves, CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(n.ids, '')) AS ends_sha256
FROM n JOIN s USING (path) LEFT JOIN c USING (path) LEFT JOIN n u ON n.depth > 0 AND u.path = substr(n.path, 1, length(n.path) - 64)"""


@query("op11_conversation_trie", TRIE_SQL)
def op11_conversation_trie(spark, sf):
    return conversation_trie.prefix_trie(table(spark, sf, "conversations"))


SPELLING_SQL = f"""
WITH RECURSIVE o AS (
  SELECT doc_id, w, count(*) AS c
  FROM (SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS w FROM documents) GROUP BY doc_id, w),
x AS (SELECT *, {crc32_sql("CAST(doc_id AS VARCHAR) || ':' || w")} AS h FROM o),
v AS (SELECT CASE WHEN h % {spelling.DROP_EVERY} = 0 THEN substr(w, 1, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, c FROM x),
words AS (SELECT word, CAST(sum(c) AS BIGINT) AS n FROM v WHERE length(word) >= {spelling.MIN_CHARS} GROUP BY word HAVING sum(c) >= {spelling.MIN_COUNT}),
d AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS short FROM (SELECT *, unnest(range(length(word))) AS i FROM words)),
pairs AS (SELECT a.word, b.word AS near, b.n AS near_n FROM d a JOIN d b ON a.short = b.short AND a.i = b.i AND a.word <> b.word
          UNION SELECT d.word, w.word, w.n FROM d JOIN words w ON w.word = d.short
          UNION SELECT w.word, d.word, d.n FROM d JOIN words w ON w.word = d.short),
b AS (SELECT word, count(*) AS n_near, first(near ORDER BY near_n DESC, near) AS near, max(near_n) AS near_n FROM pairs GROUP BY word),
j AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= {spelling.TIMES} * n THEN near END AS form, CASE WHEN near_n >= {spelling.TIMES} * n THEN near_n END AS form_n
      FROM words LEFT JOIN b USING (word)),
chain(word, root) AS (SELECT word, word FROM j UNION ALL SELECT chain.word, j.form FROM chain JOIN j ON j.word = chain.root WHERE j.form IS NOT NULL)
SELECT j.word, j.form, root, j.n, j.n_near, j.form_n FROM j JOIN chain USING (word) JOIN j l ON l.word = root WHERE l.form IS NULL"""


@query("op13_spelling_variants", SPELLING_SQL)
def op13_spelling_variants(spark, sf):
    return spelling.variants(table(spark, sf, "documents"))
