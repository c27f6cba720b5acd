"""Text cleaning by language: stop words and endings chosen row by row from a language code.

The tables are map literals of the plan, so a row's language costs a look-up in the row's own
expression and no join.  As in ``text``, every step has a DuckDB twin for the oracles.

Cleaning keeps letters of every script (``text.normalize`` keeps a-z only, which cuts words
at accents); a dot stays where it touches a digit.  Of a word's endings in the table the
longest goes that leaves ``MIN_STEM`` letters.  A language without a table, or null, is
handled as DEFAULT."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from quarry.functions.text import STOP_WORDS_EN, _sql_str, tokens

DEFAULT = "en"
MIN_STEM = 4

# Function words, and endings of inflected and derived words, by language.
STOP_WORDS = {
    "en": STOP_WORDS_EN,
    "de": (
        "aber alle allem allen aller alles als also am an andere anderen anderer anderes auch auf aus bei bin bis bist da damit dann das dass dein "
        "deine dem den denn der des dich die dies diese diesem diesen dieser dieses dir doch dort du durch ein eine einem einen einer eines er es "
        "etwas euch euer für gegen gewesen hab habe haben hat hatte hatten hier hin hinter ich ihm ihn ihnen ihr ihre ihrem ihren ihrer im in ist "
        "ja jede jedem jeden jeder jedes jene kann kein keine können man mein meine mich mir mit muss nach nicht nichts noch nun nur ob oder ohne "
        "sehr sein seine seinem seinen seiner sich sie sind so solche soll sondern um und uns unser unter viel vom von vor war waren was weil "
        "welche welcher wenn werde werden wie wieder will wir wird wo zu zum zur zwar zwischen über"
    ).split(),
    "fr": (
        "à au aux avec avoir ce ces cet cette comme d dans de des donc du elle elles en entre est et eu fait il ils j je l la le les leur leurs lui "
        "m ma mais me mes moi mon même n ne nos notre nous on ont ou où par pas plus pour qu que qui s sa sans se ses si son sont sous sur t ta te "
        "tes toi ton tu un une vos votre vous y été être"
    ).split(),
    "es": (
        "a al algo ante antes como con contra cual cuando de del desde donde durante e el ella ellas ellos en entre era es esa ese eso esta este "
        "esto estos fue ha hasta la las le les lo los me mi mis mucho muy más ni no nos nosotros o os otra otro para pero poco por porque que "
        "quien se ser si sin sobre son su sus también tan te ti todo tu tus un una uno unos y ya yo él"
    ).split(),
    "it": (
        "a ad agli ai al alla alle anche c che chi ci come con contro cui da dal dalla dalle dei del della delle di dove e ed era essere fra gli "
        "ha hanno ho i il in io l la le lei lo loro lui ma mi mia mio ne nei nel nella noi non nostro o per perché più quale quando quanto quella "
        "quello questa questo se sei si sia sono sta su sua sue sul sulla suo tra tu tutti tutto un una uno vi voi è"
    ).split(),
}
ENDINGS = {
    "en": "edly ing ies ed es ly s".split(),
    "de": "heiten keiten ungen heit keit isch lich ung ern em en er es e n s".split(),
    "fr": "issements issement ements ations ement ation euses euse ives eux ive ées ée és er es e s".split(),
    "es": "amientos amiento aciones idades ación mente idad ados adas ado ada os as es o a s".split(),
    "it": "azioni azione amenti amento mente ando endo ità ati ate ato ata are ere ire i e a o".split(),
}


def by_language(lang: Column, table: dict[str, list[str]]) -> Column:
    """The language's list, from a map literal."""
    entries = [x for code, words in table.items() for x in (F.lit(code), F.array(*(F.lit(w) for w in words)))]
    m = F.create_map(*entries)
    code = F.lower(F.left(lang, F.lit(2)))
    return F.coalesce(F.element_at(m, code), F.element_at(m, F.lit(DEFAULT)))


def normalize_letters(col: Column) -> Column:
    """Lower case; runs of anything but letters and digits become one space, but for dots
    that touch a digit."""
    blanked = F.regexp_replace(F.lower(col), r"[^\p{L}\p{N}.]+", " ")
    blanked = F.regexp_replace(blanked, r"(?<![0-9])\.(?![0-9])", " ")
    return F.regexp_replace(blanked, " {2,}", " ")


def stem_by_language(word: Column, endings: Column) -> Column:
    fits = F.filter(endings, lambda e: word.endswith(e) & (F.char_length(word) - F.char_length(e) >= MIN_STEM))
    longest = F.coalesce(F.array_max(F.transform(fits, F.char_length)), F.lit(0))
    return F.left(word, F.char_length(word) - longest)


def preprocess_by_language(col: Column, lang: Column) -> Column:
    """clean → tokenise → drop the language's stop words → cut its endings; array<string>."""
    stops, endings = by_language(lang, STOP_WORDS), by_language(lang, ENDINGS)
    kept = F.filter(tokens(normalize_letters(col)), lambda t: ~F.array_contains(stops, t))
    return F.transform(kept, lambda t: stem_by_language(t, endings))


# --------------------------- DuckDB twins (oracle) ---------------------------

def _table_sql(lang: str, table: dict[str, list[str]]) -> str:
    cases = " ".join(f"WHEN '{code}' THEN [{', '.join(_sql_str(w) for w in words)}]" for code, words in table.items() if code != DEFAULT)
    return f"CASE lower(left({lang}, 2)) {cases} ELSE [{', '.join(_sql_str(w) for w in table[DEFAULT])}] END"


def normalize_letters_sql(expr: str) -> str:
    s = f"regexp_replace(lower({expr}), '[^\\p{{L}}\\p{{N}}.]', ' ', 'g')"
    s = f"regexp_replace({s}, '([0-9])\\.', '\\1~', 'g')"
    s = f"regexp_replace({s}, '\\.([0-9])', '~\\1', 'g')"
    return f"replace(replace({s}, '.', ' '), '~', '.')"


def preprocess_by_language_sql(table: str, id_col: str, text_col: str, lang_col: str) -> str:
    """SELECT of (id, processed)."""
    return f"""SELECT {id_col}, array_to_string(list_transform(list_filter(words, lambda t: t <> '' AND NOT list_contains(stops, t)),
        lambda t: left(t, length(t) - coalesce(list_max(list_transform(list_filter(endings, lambda e: ends_with(t, e) AND length(t) - length(e) >= {MIN_STEM}), lambda e: length(e))), 0))), ' ') AS processed
    FROM (SELECT {id_col}, string_split({normalize_letters_sql(text_col)}, ' ') AS words, {_table_sql(lang_col, STOP_WORDS)} AS stops, {_table_sql(lang_col, ENDINGS)} AS endings FROM {table})"""
