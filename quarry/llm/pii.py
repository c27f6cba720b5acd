"""Personal data replaced by surrogates [DataFrame functions only].

Entities (mail and IP addresses, phone, card, account and social security numbers, keys,
passwords, names behind a title) are found by one pattern.  Every distinct entity gets one
surrogate for the whole corpus, derived from a secret key: the same entity always gets the
same surrogate, in whatever way a mention is written, and different entities of a type get
different ones, which is checked by grouping surrogates and against all entities found;
those that collide are derived again until none does.

Surrogates match the type: digits stay digits, letters stay letters of the same case,
separators stay, card numbers that pass the Luhn test pass it again, addresses of a private
IP range stay in it and all keep their digits per part as long as there are free ones, names
match gender and script.  The parts of first and last names are entities of their own, so
``Mrs. Anna Roe`` and ``Mrs. Roe`` keep their last name in common, and ``Roe-Smith`` its
hyphen.  A first name has one surrogate whatever title it stands behind; its gender is that
of the titles that tell one, if they agree.  A name found behind a title is replaced in the
rest of the same text without one too.  The key is read from a table, so that no plan shows it.

Defined cases
* null text stays null, empty text empty; texts without entities stay byte for byte.
* an IPv6 address is one entity for each way of writing it, but for case.
* very long texts are searched whole, in one pass of the pattern (and another one if they
  hold names); a mention is as long as the pattern allows.
* doc_id may be null or repeated: with a hash of the text it only names the row, and equal
  rows get equal results.
* empty table: no rows.  All other columns stay, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.session import materialize, release

# Patterns (Java syntax) of each entity type, in the order they are tried.
SECRET = r"""(?<![A-Za-z])(?i:(?:password|passwd|token|secret|api_?key|access_?key|private_?key)(?:[_-](?:key|token|id))?)\s{0,3}[=:]\s{0,3}["']?[A-Za-z0-9+/_-]{8,}"""
EMAIL = r"(?<![A-Za-z0-9._%+-])[A-Za-z0-9][A-Za-z0-9._%+-]*+@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)*\.[A-Za-z]{2,}"
CLOUD_KEY = r"(?<![A-Za-z0-9])(?:AKIA|ASIA)[0-9A-Z]{16}(?![A-Za-z0-9])"
IBAN = r"(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9])"
IP = r"(?<![\d.])(?:25[0-5]|2[0-4]\d|1?\d?\d)(?:\.(?:25[0-5]|2[0-4]\d|1?\d?\d)){3}(?!\.?\d)"
HEXES = "[0-9A-Fa-f]{1,4}"
IPV6 = f"(?<![0-9A-Za-z:.])(?=[0-9A-Fa-f:]*\\d)(?:(?:{HEXES}:){{7}}{HEXES}|{HEXES}(?::{HEXES}){{0,5}}::(?:{HEXES}(?::{HEXES}){{0,5}})?)(?![0-9A-Za-z:])"
CARD = r"(?<![\d-])(?:\d{4}[ -]?\d{4}[ -]?\d{4}[ -]?\d{3,4}|3[47]\d{2}[ -]?\d{6}[ -]?\d{5})(?![\d-])"
PHONE = r"(?<![\d+])\+\d{1,3}[ .-]?(?:\(\d{1,4}\)|\d{1,4})(?:[ .-]?\d{2,4}){2,4}(?!\d)|(?<![\d.-])(?:\(\d{3}\) ?|\d{3}[ .-])\d{3}[ .-]\d{4}(?![\d-])|(?<![\d.+-])0\d{2,4}[ /-]\d{5,8}(?![\d-])"
SSN = r"(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-])"
TITLE = "Mr|Mrs|Ms|Miss|Dr|Herr|Frau|[Mm]onsieur|[Mm]adame|Mme|[Ss]eñora|[Ss]eñor|Sra|Sr|[Гг]осподин|[Гг]оспожа|[Κκ]ύριος|[Κκ]υρία"
NAME_WORD = r"\p{Lu}(?:\p{L}+|(?=['-]\p{Lu}))(?:['-]\p{Lu}\p{L}+)*"
NAME = f"(?<!\\p{{L}})(?:{TITLE})\\.? {NAME_WORD}(?: {NAME_WORD})?"
KINDS = {"secret": SECRET, "email": EMAIL, "cloud_key": CLOUD_KEY, "iban": IBAN, "ip": IP, "ipv6": IPV6, "card": CARD, "phone": PHONE, "ssn": SSN, "name": NAME}
# One cheap look at a place decides which kinds are tried there.
ANY = (
    f"(?<![A-Za-z0-9])(?=[A-Za-z0-9])(?:{SECRET}|{EMAIL}|{CLOUD_KEY}|{IBAN}|{IPV6})"
    f"|(?=[0-9(+])(?:{IP}|{CARD}|{PHONE}|{SSN})"
    f"|(?<!\\p{{L}})(?=[\\p{{Lu}}msгκ]){NAME}"
)

FEMALE = ["mrs", "ms", "miss", "frau", "madame", "mme", "señora", "sra", "госпожа", "κυρία"]
MALE = ["mr", "herr", "monsieur", "señor", "sr", "господин", "κύριος"]
# Syllables of invented names and their endings (female, male, any), by script.
NAMES = {
    "latin": (["ba", "ce", "di", "fo", "lu", "ma", "ne", "pi", "ro", "sa", "te", "vi", "lo", "ka", "mi", "ra"], ["lina", "na", "ria"], ["ron", "mir", "dan"], ["del", "mer", "nor"]),
    "cyrillic": (["ба", "ве", "ди", "ко", "лу", "ма", "не", "пи", "ро", "са", "те", "ви", "ло", "ка", "ми", "ра"], ["лина", "на", "рия"], ["рон", "мир", "дан"], ["дель", "мер", "нор"]),
    "greek": (["βα", "γε", "δι", "κο", "λου", "μα", "νε", "πι", "ρο", "σα", "τε", "βι", "λο", "κα", "μι", "ρα"], ["λινα", "να", "ρια"], ["ρος", "μος", "νος"], ["δης", "μερ", "νορ"]),
}
MAX_ROUNDS = 200
PART = "[^ '-]+"              # of a name
FIRST, LAST = "first", "last"  # a name without a title: a first name, or one that ends in a last name


def kind_of(mention: Column) -> Column:
    out = None
    for kind, pattern in KINDS.items():
        test = mention.rlike(f"^(?:{pattern})$")
        out = F.when(test, kind) if out is None else out.when(test, kind)
    return out.otherwise("phone")


def name_words(mention: Column) -> Column:
    """The words of a name behind a title: the last name, or first and last name."""
    return F.split(F.regexp_replace(mention, f"^(?:{TITLE})\\.? ", F.lit("")), " ")


def units(mention: Column, bare: Column) -> Column:
    """The entities in a mention: one, or a name's parts; each (kind, norm, gender).  ``norm``
    is what mentions of one entity have in common; ``bare`` tells names without a title."""
    kind = kind_of(mention)
    digits = F.regexp_replace(mention, r"\D", "")
    one = (
        F.when(kind == "secret", F.regexp_extract(mention, r"""([A-Za-z0-9+/_-]{8,})$""", 1))
        .when(kind.isin("email", "ipv6"), F.lower(mention)).when(kind.isin("cloud_key", "ip"), mention)
        .when(kind == "iban", F.replace(mention, F.lit(" "), F.lit(""))).otherwise(digits)
    )
    title = F.lower(F.regexp_extract(mention, r"^(\p{L}+)", 1))
    gender = F.when(bare != "", None).when(title.isin(FEMALE), "f").when(title.isin(MALE), "m")
    names = F.when(bare != "", F.split(mention, " ")).otherwise(name_words(mention))
    unit = lambda k, n, g: F.struct(k.alias("kind"), n.alias("norm"), g.cast("string").alias("gender"))

    def parts(word, i):
        first = (bare == FIRST) | (i < F.size(names) - 1)
        return F.transform(F.regexp_extract_all(word, F.lit(f"({PART})"), F.lit(1)), lambda x: unit(F.when(first, "first").otherwise("last"), F.lower(x), F.when(first, gender)))

    return F.when((kind == "name") | (bare != ""), F.flatten(F.transform(names, parts))).otherwise(F.array(unit(kind, one, F.lit(None))))


def draw(key: Column, kind: Column, norm: Column, attempt: Column) -> Column:
    """256 numbers 0..255 that follow from key, kind, entity and attempt."""
    blocks = [F.sha2(F.concat_ws("\x1f", key, F.lit(str(i)), kind, attempt.cast("string"), norm), 512) for i in range(4)]
    return F.transform(F.regexp_extract_all(F.concat(*blocks), F.lit("(..)"), F.lit(1)), lambda h: F.conv(h, 16, 10).cast("int"))


def luhn_rest(digits: Column) -> Column:
    """Check sum of an array of digits, without its last one, that the last completes."""
    n = F.size(digits)
    doubled = F.transform(F.slice(digits, 1, n - 1), lambda d, i: F.when(F.pmod(n - 1 - i, F.lit(2)) == 1, F.when(d > 4, d * 2 - 9).otherwise(d * 2)).otherwise(d))
    return F.pmod(F.lit(10) - F.pmod(F.aggregate(doubled, F.lit(0), lambda a, x: a + x), F.lit(10)), F.lit(10))


def in_format(norm: Column, numbers: Column, fixed_head: Column, fixed_tail: Column) -> Column:
    """Each digit and letter between the fixed head and tail drawn anew: digits from digits
    (a leading digit of a group is never 0), letters from letters of the same case."""
    chars = F.split(norm, "")
    n = F.char_length(norm)

    def new(c, i):
        r = F.element_at(numbers, F.pmod(i, F.lit(256)) + 1)
        pick = lambda s: F.substring(F.lit(s), F.pmod(r, F.lit(len(s))) + 1, F.lit(1))
        changed = F.when(c.between("0", "9"), F.when(i == fixed_head, pick("123456789")).otherwise(pick("0123456789"))).when(c.between("a", "z"), pick("abcdefghijklmnopqrstuvwxyz")).when(c.between("A", "Z"), pick("ABCDEFGHIJKLMNOPQRSTUVWXYZ")).otherwise(c)
        return F.when((i < fixed_head) | (i >= n - fixed_tail), c).otherwise(changed)

    return F.array_join(F.transform(chars, new), "")


def surrogate(kind: Column, norm: Column, gender: Column, attempt: Column, r: Column) -> Column:
    """Surrogate of an entity, in the normal form of its kind, from the numbers ``r``; that
    must be a stored column, as it is read once per character."""
    zero = F.lit(0)
    digits = lambda s: F.transform(F.split(s, ""), lambda c: c.cast("int"))
    card = in_format(norm, r, F.lit(1), zero)
    old, new = digits(norm), digits(card)
    valid = luhn_rest(old) == F.element_at(old, -1)
    card = F.when(valid, F.concat(F.left(card, F.char_length(card) - 1), luhn_rest(new).cast("string"))).otherwise(card)

    def octet(p, i):
        x = F.element_at(r, i * 2 + 1) * 256 + F.element_at(r, i * 2 + 2)
        size = F.char_length(p)
        wide = F.pmod(x, F.lit(256))
        tight = F.when(size == 3, 100 + F.pmod(x, F.lit(156))).when(size == 2, 10 + F.pmod(x, F.lit(90))).otherwise(1 + F.pmod(x, F.lit(9)))
        return F.when(attempt > 20, wide).otherwise(tight).cast("string")  # few short addresses: widen

    private = F.when(norm.rlike(r"^(10|127)\."), 1).when(norm.rlike(r"^(192\.168|172\.(1[6-9]|2\d|3[01])|169\.254)\."), 2).otherwise(0)
    ip = F.array_join(F.transform(F.split(norm, r"\."), lambda p, i: F.when(i < private, p).otherwise(octet(p, i))), ".")
    hexes = F.transform(F.split(norm, ""), lambda c, i: F.when(c == ":", c).otherwise(F.substring(F.lit("123456789abcdef"), F.pmod(F.element_at(r, i + 1), F.lit(15)) + 1, F.lit(1))))

    def name(script, ending):
        syllables, *ends = NAMES[script]
        of = lambda xs, i: F.element_at(F.array(*(F.lit(x) for x in xs)), F.pmod(F.element_at(r, i), F.lit(len(xs))) + 1)
        more = F.transform(F.slice(r, 5, 2 + F.floor(attempt / 3).cast("int")), lambda x: F.element_at(F.array(*(F.lit(s) for s in syllables)), F.pmod(x, F.lit(len(syllables))) + 1))
        return F.concat(F.array_join(more, ""), of(ends[ending], 1))

    def scripts(ending):
        return F.when(norm.rlike(r"^\p{IsCyrillic}"), name("cyrillic", ending)).when(norm.rlike(r"^\p{IsGreek}"), name("greek", ending)).otherwise(name("latin", ending))

    tld = F.char_length(F.regexp_extract(norm, r"(\.[a-z]+)$", 1))
    country = F.when(F.char_length(norm) > 10, F.char_length(norm) - 10).otherwise(zero)
    return (
        F.when(kind == "email", in_format(norm, r, zero, tld)).when(kind == "ip", ip).when(kind == "ipv6", F.array_join(hexes, "")).when(kind == "card", card)
        .when(kind == "phone", in_format(norm, r, country, zero)).when(kind.isin("cloud_key", "iban"), in_format(norm, r, F.when(kind == "iban", 2).otherwise(4), zero))
        .when((kind == "first") & (gender == "f"), scripts(0)).when((kind == "first") & (gender == "m"), scripts(1)).when(kind.isin("first", "last"), scripts(2))
        .otherwise(in_format(norm, r, zero, zero))
    )


def any_of(words: Column) -> Column:
    return F.concat(F.lit("(?:"), F.array_join(words, "|"), F.lit(")"))


def mentions(docs: DataFrame) -> DataFrame:
    """(doc_id, rid, pattern, pos, mention, bare) of every entity mention, counted in each
    text.  A text with names behind titles has a pattern of its own, that finds them without
    titles too; names are letters, hyphens and apostrophes."""
    found = docs.select("doc_id", "text", F.xxhash64("text").alias("rid"), F.regexp_extract_all("text", F.lit(f"({ANY})"), F.lit(1)).alias("m")).where(F.size("m") > 0)
    names = F.transform(F.filter("m", lambda x: x.rlike(f"^(?:{NAME})$")), name_words)
    found = found.withColumn("names", names)
    lasts = F.array_distinct(F.transform("names", lambda w: F.element_at(w, -1)))
    firsts = F.array_distinct(F.transform(F.filter("names", lambda w: F.size(w) > 1), lambda w: w[0]))
    found = found.withColumn("firsts", firsts).withColumn("lasts", lasts)
    some = F.size("firsts") > 0
    longer = F.when(some, F.concat(F.lit("(?:"), any_of(F.col("firsts")), F.lit(" )?"))).otherwise("")
    alone = F.when(some, F.concat(F.lit("|"), any_of(F.col("firsts")))).otherwise("")
    own = F.concat(F.lit(f"{ANY}|(?<![\\p{{L}}'-])(?:"), longer, any_of(F.col("lasts")), alone, F.lit(")(?![\\p{L}-])"))
    found = found.withColumn("pattern", F.when(F.size("lasts") > 0, own))
    again = F.regexp_extract_all("text", F.concat(F.lit("("), F.col("pattern"), F.lit(")")), F.lit(1))
    found = found.select("doc_id", "rid", "pattern", "firsts", "lasts", F.posexplode(F.when(F.col("pattern").isNull(), F.col("m")).otherwise(again)).alias("pos", "mention"))
    words = F.split("mention", " ")
    both = (F.size(words) == 2) & F.array_contains("firsts", words[0]) & F.array_contains("lasts", F.element_at(words, -1))
    bare = F.when(F.array_contains("lasts", F.col("mention")) | both, LAST).when(F.array_contains("firsts", F.col("mention")), FIRST).otherwise("")
    return found.select("doc_id", "rid", "pattern", "pos", "mention", bare.alias("bare"))


def with_numbers(entities: DataFrame, key: str) -> DataFrame:
    """The numbers that entities (kind, norm, attempt) draw.  The key comes from a table, whose
    values neither explain() nor an event log shows."""
    secret = entities.sparkSession.createDataFrame([(key,)], "secret string")
    drawn = draw(F.col("secret"), F.col("kind"), F.col("norm"), F.col("attempt"))
    return entities.withColumn("secret", secret.scalar()).withColumn("numbers", drawn).drop("secret")


def surrogates(entities: DataFrame, key: str) -> DataFrame:
    """(kind, norm, surrogate) of entities (kind, norm, gender), with all surrogates of a kind distinct, and none equal to an
    entity of that kind.  In every round the smallest entity of those that drew the same
    surrogate keeps it and the others draw again; the loop ends when nobody is left."""
    spark = entities.sparkSession
    taken = entities.select("kind", F.col("norm").alias("surrogate"))
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    pending, done = materialize(entities.withColumn("attempt", F.lit(0)), "pii-pending"), None
    for _ in range(MAX_ROUNDS):
        each = pending.repartition(n, "kind", "norm")  # some numbers per character: spread the few rows
        drawn = with_numbers(each, key).withColumn("surrogate", surrogate(F.col("kind"), F.col("norm"), F.col("gender"), F.col("attempt"), F.col("numbers"))).drop("numbers")
        drawn = materialize(drawn, "pii-drawn")
        free = drawn.join(taken, ["kind", "surrogate"], "left_anti")
        if done is not None:
            free = free.join(done.select("kind", "surrogate"), ["kind", "surrogate"], "left_anti")
        won = materialize(free.groupBy("kind", "surrogate").agg(F.min("norm").alias("norm")).select("kind", "norm", "surrogate"), "pii-won")
        lost = materialize(drawn.join(won, ["kind", "norm"], "left_anti").select("kind", "norm", "gender", (F.col("attempt") + 1).alias("attempt")), "pii-pending")
        done = won if done is None else done.unionByName(won)
        release(pending)
        release(drawn)
        pending = lost
        if pending.isEmpty():
            return done
    raise RuntimeError(f"{spark.sparkContext.appName}: entities without a free surrogate after {MAX_ROUNDS} rounds")


def fill(mention: Column, alnum: Column) -> Column:
    """``mention`` with its letters and digits replaced, in order, by those of ``alnum``,
    each in the mention's case."""
    start = F.struct(F.lit(0).alias("i"), F.lit("").alias("out"))

    def step(a, c):
        s = F.substring(alnum, a["i"] + 1, F.lit(1))
        put = F.when(c.between("A", "Z"), F.upper(s)).otherwise(s)
        word = c.rlike("[A-Za-z0-9]")
        return F.struct((a["i"] + word.cast("int")).alias("i"), F.concat(a["out"], F.when(word, put).otherwise(c)).alias("out"))

    return F.aggregate(F.split(mention, ""), start, step, lambda a: a["out"])


def rendered(mention: Column, bare: Column, chosen: Column) -> Column:
    """A mention with its surrogates (in the order of its units) in its own format."""
    kind = kind_of(mention)
    s = chosen[0]
    title = F.when(bare != "", "").otherwise(F.regexp_extract(mention, f"^((?:{TITLE})\\.? )", 1))
    name = F.substring(mention, F.char_length(title) + 1, F.char_length(mention))
    shouted = (F.upper(name) == name) & (F.char_length(name) > 1)
    put = F.transform(chosen, lambda x: F.when(shouted, F.upper(x)).otherwise(F.initcap(x)))
    names = F.array_join(F.zip_with(F.split(name, PART), F.concat(put, F.array(F.lit(""))), lambda a, x: F.concat(a, x)), "")
    value = F.regexp_extract(mention, r"([A-Za-z0-9+/_-]{8,})$", 1)
    plain = F.regexp_replace(s, "[^A-Za-z0-9]", "")
    return (
        F.when((kind == "name") | (bare != ""), F.concat(title, names)).when(kind.isin("ip", "cloud_key"), s)
        .when(kind == "secret", F.concat(F.left(mention, F.char_length(mention) - F.char_length(value)), s))
        .otherwise(fill(mention, plain))
    )


def replace_entities(docs: DataFrame, key: str) -> DataFrame:
    """Every row of ``docs`` as ``row``, with (replaced, n_replaced): the text with all
    entities replaced, and how many mentions that were."""
    found = materialize(mentions(docs), "pii-mentions")
    forms = found.select("mention", "bare").distinct().select("mention", "bare", F.posexplode(units(F.col("mention"), F.col("bare"))).alias("part", "unit"))
    forms = materialize(forms.select("mention", "bare", "part", "unit.*"), "pii-forms")
    told = F.when(F.min("gender") == F.max("gender"), F.min("gender")).otherwise("n")
    given = surrogates(forms.groupBy("kind", "norm").agg(told.alias("gender")), key)
    chosen = forms.join(given, ["kind", "norm"]).groupBy("mention", "bare").agg(F.sort_array(F.collect_list(F.struct("part", "surrogate"))).alias("c"))
    chosen = chosen.select("mention", "bare", rendered(F.col("mention"), F.col("bare"), F.col("c.surrogate")).alias("put"))
    per_row = found.join(chosen, ["mention", "bare"]).groupBy(F.col("doc_id").alias("d"), F.col("rid").alias("r")).agg(F.sort_array(F.collect_set(F.struct("pos", "put"))).alias("puts"), F.max("pattern").alias("own"))

    rows = docs.select(F.struct(*(docs[c] for c in docs.columns)).alias("row"), F.col("doc_id").alias("doc_id"), F.xxhash64("text").alias("rid"))
    j = rows.join(per_row, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("rid") == F.col("r")), "left")
    between = F.split("row.text", F.coalesce("own", F.lit(ANY)), -1)
    woven = F.array_join(F.zip_with(between, F.concat(F.col("puts.put"), F.array(F.lit(""))), lambda a, b: F.concat(a, b)), "")
    return j.select("row", F.when(F.col("puts").isNull(), F.col("row.text")).otherwise(woven).alias("replaced"), F.coalesce(F.size("puts"), F.lit(0)).cast("long").alias("n_replaced"))
