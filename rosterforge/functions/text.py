"""Names, notes and numbers: Column -> Column."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rosterforge.schema import cell, filled, parts, trim

#: Endings that a name key drops (fixed values).
NAME_ENDINGS = ["protocol", "finance", "labs", "wallet", "exchange", "market", "markets", "swap", "amm", "lsd", "cdp", "cex", r"v\d+"]
#: Endings that a search term drops, each once, in this order (fixed values).
SEARCH_ENDINGS = [" Protocol", " Finance", " Network", " Labs", " DAO", " Exchange", " DEX", " Swap", " Bridge", " V2", " V3", " AMM", " DeFi"]
#: Last words that a coin key drops (fixed values).
COIN_WORDS = ["dex", "protocol", "finance", "exchange", "network", "swap", "bridge", "labs", "dao", "wallet", "amm"]
#: Code points that notes lose (fixed values; the range from 24C2 covers CJK text).
EMOJI = (
    r"[\x{1F600}-\x{1F64F}\x{1F300}-\x{1F5FF}\x{1F680}-\x{1F6FF}\x{1F700}-\x{1F77F}\x{1F780}-\x{1F7FF}"
    r"\x{1F800}-\x{1F8FF}\x{1F900}-\x{1F9FF}\x{1FA00}-\x{1FA6F}\x{1FA70}-\x{1FAFF}\x{1F1E0}-\x{1F1FF}"
    r"\x{2702}-\x{27B0}\x{24C2}-\x{1F251}\x{2600}-\x{26FF}\x{2700}-\x{27BF}\x{FE00}-\x{FE0F}\x{200D}"
    r"\x{3030}\x{A9}\x{AE}\x{2122}\x{23CF}\x{23E9}-\x{23F3}\x{23F8}-\x{23FA}\x{231A}-\x{231B}"
    r"\x{2934}-\x{2935}\x{2B05}-\x{2B07}\x{2B1B}-\x{2B1C}\x{2B50}\x{2B55}\x{203C}\x{2049}]+"
)
#: What sanitizing changes: white space other than single spaces between words, commas, ampersands.
UNTIDY = r"[,&\t-\r\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]|  |^ | \z"
#: Sources whose category prefix notes lose (fixed values).
NOTE_SOURCES = ["NEARCatalog", "AwesomeNEAR", "Generic Scraper"]


def sanitized(c: str | Column) -> Column:
    """One line, single spaces, five entities decoded (the ampersand first), no commas."""
    text = F.trim(F.regexp_replace(cell(c), r"(?U)\s+", " "))
    for entity, char in (("&amp;", "&"), ("&lt;", "<"), ("&gt;", ">"), ("&#39;", "'"), ("&quot;", '"')):
        text = F.replace(text, F.lit(entity), F.lit(char))
    # one look tells that most cells need none of this
    return F.when(cell(c).rlike(UNTIDY), F.translate(text, ",", ";")).otherwise(cell(c))


def alnum_key(c: str | Column) -> Column:
    return F.regexp_replace(F.lower(cell(c)), "[^a-z0-9]", "")


def name_key(c: str | Column) -> Column:
    """Lower-case letters and digits without any of the common endings."""
    bare = F.regexp_replace(F.lower(cell(c)), r"(?U)(\s*(" + "|".join(NAME_ENDINGS) + r"))+$", "")
    return F.regexp_replace(bare, "[^a-z0-9]", "")


def spaced_key(c: str | Column) -> Column:
    return F.regexp_replace(F.translate(F.lower(trim(c)), "-_", "  "), "[^a-z0-9 ]", "")


def coin_key(c: str | Column) -> Column:
    """The spaced key without a common last word, if another word stands before it."""
    words = F.filter(F.split(F.lower(cell(c)), r"(?U)\s+"), lambda w: w != "")
    shorter = F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), " ")
    return spaced_key(F.when((F.size(words) > 1) & F.element_at(words, -1).isin(COIN_WORDS), shorter).otherwise(cell(c)))


def search_term(c: str | Column) -> Column:
    """The name without endings that hurt a search; the name itself where under 3 characters would be left."""

    def drop(name: Column, ending: Column) -> Column:
        long_enough = F.length(name) > F.length(ending) + 2
        return F.when(F.endswith(name, ending) & long_enough, F.trim(F.substring(name, F.lit(1), F.length(name) - F.length(ending)))).otherwise(name)

    clean = F.aggregate(F.array(*map(F.lit, SEARCH_ENDINGS)), trim(c), drop)
    return F.when(F.length(clean) < 3, trim(c)).otherwise(clean)


def without_emoji(c: str | Column) -> Column:
    return F.regexp_replace(cell(c), EMOJI, "")


def clean_note(c: str | Column) -> Column:
    """The first segment without category prefix, emoji and edge punctuation; the others as they are."""
    segments = F.split(cell(c), r" \| ")
    source = "|".join(NOTE_SOURCES)
    first = F.regexp_replace(trim(F.element_at(segments, 1)), rf"(?iU)^.+?\s+from\s+(?:{source})\s*-\s*", "")
    first = F.regexp_replace(first, rf"(?iU)^.+?\s+from\s+(?:{source})\s*$", "")
    first = F.trim(F.regexp_replace(without_emoji(first), r"(?U)\s+", " "))
    first = F.btrim(first, F.lit(" -;|,."))
    rest = F.transform(F.slice(segments, F.lit(2), F.greatest(F.size(segments) - 1, F.lit(0))), trim)
    return F.when(filled(c), F.array_join(F.filter(F.concat(F.array(first), rest), lambda s: s != ""), " | ")).otherwise("")


def status_text(c: str | Column) -> Column:
    """A status without what stands before its first word."""
    return F.regexp_replace(trim(c), r"(?U)^\W+", "")


def chain_slug(c: str | Column) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(trim(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def usd(c: Column) -> Column:
    """Whole dollars with separators, ties to even."""
    return F.concat(F.lit("$"), F.format_number(c.cast("double"), 0))


def percent(part: Column, whole: Column) -> Column:
    """To one decimal, 0 of nothing.  Ties go to the even digit; a residue of 0.1
    against binary rounding is possible."""
    return F.when(whole == 0, F.lit(0.0)).otherwise(F.bround(part * F.lit(100.0) / whole, 1))


def title(c: str | Column) -> Column:
    """Capital after every non-letter."""
    return F.array_join(F.transform(F.split(F.lower(cell(c)), "(?<=[^a-z])"), F.initcap), "")


def slug_candidates(name: str | Column, domain: Column) -> Column:
    """Ordered distinct slugs of at least 3 characters: the name with underscores, with
    hyphens, the domain with underscores, its first label."""

    def squeezed(text: Column, sep: str) -> Column:
        kept = F.regexp_replace(text, f"[^a-z0-9{sep}]", "")
        return F.regexp_replace(F.regexp_replace(kept, f"{sep}+", sep), f"^{sep}|{sep}$", "")

    low = F.lower(cell(name))
    under = squeezed(F.translate(low, " -", "__"), "_")
    hyphen = squeezed(F.translate(low, " _", "--"), "-")
    dotted = F.regexp_replace(F.regexp_replace(F.translate(domain, ".-", "__"), "_+", "_"), "^_|_$", "")
    label = F.when(domain.contains("."), F.substring_index(domain, ".", 1)).otherwise("")
    return F.array_distinct(F.filter(F.array(under, hyphen, dotted, label), lambda s: F.length(s) >= 3))


def coin_keywords(symbol: Column, name: Column) -> Column:
    """The symbol, and the name where it differs and is over 5 characters; none for symbols under 3."""
    s, n = F.lower(trim(symbol)), F.lower(trim(name))
    found = F.array_compact(F.array(s, F.when((n != s) & (F.length(n) > 5), n)))
    return F.when(F.length(s) >= 3, found).otherwise(F.array().cast("array<string>"))


def distinct_ci(items: Column) -> Column:
    """Items without later repeats in another case."""
    empty = F.array().cast("array<string>")
    fresh = lambda acc, x: F.when(F.exists(acc, lambda y: F.lower(y) == F.lower(x)), acc).otherwise(F.array_append(acc, x))
    return F.aggregate(items, empty, fresh)


def category_list(c: str | Column) -> Column:
    return parts(c, ";")
