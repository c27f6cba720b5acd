"""Text cleaning as native column expressions (no Python UDF).

Every function maps ``Column -> Column`` so that it stays inside whole-stage
codegen.  Each has a ``*_sql`` twin producing the same result in DuckDB SQL;
the twins are used only by the oracle queries.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values.
# Stop words: Spark ML's default English list (StopWordsRemover), in file order.
STOP_WORDS_EN = (
    "i me my myself we our ours ourselves you your yours yourself yourselves he him his himself "
    "she her hers herself it its itself they them their theirs themselves what which who whom "
    "this that these those am is are was were be been being have has had having do does did "
    "doing a an the and but if or because as until while of at by for with about against "
    "between into through during before after above below to from up down in out on off over "
    "under again further then once here there when where why how all any both each few more "
    "most other some such no nor not only own same so than too very s t can will just don "
    "should now i'll you'll he'll she'll we'll they'll i'd you'd he'd she'd we'd they'd i'm "
    "you're he's she's it's we're they're i've we've you've they've isn't aren't wasn't "
    "weren't haven't hasn't hadn't don't doesn't didn't won't wouldn't shan't shouldn't "
    "mustn't can't couldn't cannot could here's how's let's ought that's there's what's "
    "when's where's who's why's would"
).split()

# Light suffix stemmer: ordered (pattern, replacement) rules, applied one after
# the other to each token; the last rule only for tokens of 6+ characters.
STEM_RULES = (
    ("sses$", "ss"),
    ("ies$", "i"),
    ("([^s])s$", "$1"),
)
STEM_LONG_RULE = ("^(.*[aeiouy].*)(ing|ed)$", "$1")
STEM_LONG_MIN = 6
# ---------------------------------------------------------------------------


def normalize(col: Column) -> Column:
    """lower-case; every char outside [a-z0-9.] and every dot with no digit on
    either side becomes a space; runs of spaces collapse to one."""
    # Runs of other characters collapse in one step; whether a dot touches a
    # digit is unchanged by that (digits stay, everything else is a space).
    blanked = F.regexp_replace(F.lower(col), "[^a-z0-9.]+", " ")
    blanked = F.regexp_replace(blanked, r"(?<![0-9])\.(?![0-9])", " ")
    return F.regexp_replace(blanked, " {2,}", " ")


def tokens(col: Column) -> Column:
    """Whitespace tokens of already-normalised text; empty tokens are dropped."""
    return F.filter(F.split(col, " "), lambda t: t != "")


def remove_stopwords(arr: Column, stop_words=STOP_WORDS_EN) -> Column:
    return F.filter(arr, lambda t: ~t.isin(list(stop_words)))


def stem_regex(token: Column) -> Column:
    """STEM_RULES applied literally, one regexp_replace per rule."""
    out = token
    for pattern, repl in STEM_RULES:
        out = F.regexp_replace(out, pattern, repl)
    long_pattern, long_repl = STEM_LONG_RULE
    return F.when(F.length(out) >= STEM_LONG_MIN, F.regexp_replace(out, long_pattern, long_repl)).otherwise(out)


def stem(token: Column) -> Column:
    """Same result as ``stem_regex`` with suffix tests instead of regexes: at most
    one of the three plural rules can fire, and only tokens ending in -ing/-ed
    reach the vowel test of the long rule."""
    n = F.length(token)
    out = (
        F.when(token.endswith("sses") | token.endswith("ies"), F.left(token, n - 2))
        .when(token.endswith("s") & ~token.endswith("ss") & (n >= 2), F.left(token, n - 1))
        .otherwise(token)
    )
    m = F.length(out)
    cut = F.when(out.endswith("ing"), F.lit(3)).when(out.endswith("ed"), F.lit(2)).otherwise(F.lit(0))
    head = F.left(out, m - cut)
    return F.when((m >= STEM_LONG_MIN) & (cut > 0) & head.rlike("[aeiouy]"), head).otherwise(out)


def preprocess(col: Column, stop_words=STOP_WORDS_EN, stemming: bool = True) -> Column:
    """normalise → tokenise → drop stop words → stem; returns array<string>."""
    arr = remove_stopwords(tokens(normalize(col)), stop_words)
    return F.transform(arr, stem) if stemming else arr


def preprocessed_text(col: Column, **kw) -> Column:
    """The chain above joined back into one space-separated string."""
    return F.array_join(preprocess(col, **kw), " ")


# --------------------------- DuckDB twins (oracle) ---------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def normalize_sql(expr: str) -> str:
    # RE2 has no look-around: protect dots touching a digit with '~', blank the
    # remaining dots, then restore.  '~' cannot survive the first replacement.
    s = f"regexp_replace(lower({expr}), '[^a-z0-9.]', ' ', 'g')"
    s = f"regexp_replace({s}, '([0-9])\\.', '\\1~', 'g')"
    s = f"regexp_replace({s}, '\\.([0-9])', '~\\1', 'g')"
    s = f"replace(replace({s}, '.', ' '), '~', '.')"
    return f"regexp_replace({s}, ' +', ' ', 'g')"


def stop_list_sql(stop_words=STOP_WORDS_EN) -> str:
    return "[" + ", ".join(_sql_str(w) for w in stop_words) + "]"


def stem_sql(x: str) -> str:
    out = x
    for pattern, repl in STEM_RULES:
        out = f"regexp_replace({out}, {_sql_str(pattern)}, {_sql_str(repl.replace('$1', chr(92) + '1'))})"
    pattern, repl = STEM_LONG_RULE
    long = f"regexp_replace({out}, {_sql_str(pattern)}, {_sql_str(repl.replace('$1', chr(92) + '1'))})"
    return f"(CASE WHEN length({out}) >= {STEM_LONG_MIN} THEN {long} ELSE {out} END)"


def preprocess_sql(expr: str, stop_words=STOP_WORDS_EN, stemming: bool = True) -> str:
    toks = f"list_filter(string_split({normalize_sql(expr)}, ' '), lambda t: t <> '')"
    kept = f"list_filter({toks}, lambda t: NOT list_contains({stop_list_sql(stop_words)}, t))"
    return f"list_transform({kept}, lambda t: {stem_sql('t')})" if stemming else kept
