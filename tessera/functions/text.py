"""Column functions for text: keyword presence, counts, cleaning, names, money."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from .numeric import col


def keyword_hits(text, words: list[str]) -> Column:
    """How many of the words occur in the lower-cased text, as substrings."""
    t = F.lower(F.coalesce(col(text), F.lit("")))
    return reduce(lambda a, b: a + b, [F.contains(t, F.lit(w.lower())).cast("int") for w in words], F.lit(0))


def any_keyword(text, words: list[str]) -> Column:
    return keyword_hits(text, words) > 0


def occurrences(text, word: str) -> Column:
    """Non-overlapping occurrences of a substring."""
    t = F.coalesce(col(text), F.lit(""))
    return ((F.length(t) - F.length(F.replace(t, F.lit(word), F.lit("")))) / F.lit(len(word))).cast("int")


def labels(pairs: dict[str, Column]) -> Column:
    """Array of the names whose condition holds."""
    return F.array_compact(F.array(*[F.when(c, F.lit(n)) for n, c in pairs.items()]))


def collapse(text) -> Column:
    return F.trim(F.regexp_replace(col(text), r"\s+", " "))


def clean_post(text) -> Column:
    """Mentions, links, tickers and hashtags in one form each; white space collapsed."""
    t = F.regexp_replace(col(text), r"@\w+", "@user")
    t = F.regexp_replace(t, r"http\S+|www.\S+", "http")
    t = F.regexp_replace(t, r"\$([A-Z]+)", "TICKER_$1")
    return collapse(F.regexp_replace(t, r"#(\w+)", "# $1"))


#: Company suffix patterns, taken off the end in this order, once each.
SUFFIXES = [r",?\s+inc\.?$", r",?\s+incorporated$", r",?\s+corp\.?$", r",?\s+corporation$", r",?\s+llc$", r",?\s+ltd\.?$", r",?\s+limited$", r",?\s+co\.?$", r",?\s+company$", r",?\s+holdings?$"]


def company_name(name) -> Column:
    """Lower case without company suffixes, white space collapsed."""
    t = F.trim(F.lower(col(name)))
    for s in SUFFIXES:
        t = F.regexp_replace(t, s, "")
    return collapse(t)


def core_name(name, words: list[str]) -> Column:
    """Lower case, without . , ; ! ? and suffix words after a blank, without a leading article."""
    t = F.regexp_replace(F.lower(col(name)), r"[.,;!?]", "")
    t = F.regexp_replace(t, r"\s+(" + "|".join(words) + r")\b", "")
    return F.trim(F.regexp_replace(collapse(t), r"^the\s+", ""))


def spelling(text) -> Column:
    """Variants of the same name alike: & as and, no punctuation, one blank."""
    return collapse(F.regexp_replace(F.replace(F.lower(col(text)), F.lit("&"), F.lit("and")), r"[^a-z0-9\s]", ""))


def initials(text) -> Column:
    return F.array_join(F.transform(F.split(collapse(text), " "), lambda w: F.upper(F.substring(w, 1, 1))), "")


def money(text) -> Column:
    """$1.5 billion as a number; null where there is none."""
    t = F.lower(col(text))
    number = F.regexp_replace(F.regexp_extract(t, r"([0-9][0-9,]*\.?[0-9]*)", 1), ",", "").try_cast("double")
    unit = F.when(F.contains(t, F.lit("billion")), 1e9).when(F.contains(t, F.lit("million")), 1e6).when(F.contains(t, F.lit("thousand")), 1e3).otherwise(1.0)
    return number * unit


def title_case_path(url) -> Column:
    """Title from the last part of a URL's path: - and _ as blanks, words capitalised."""
    path = F.regexp_replace(F.regexp_replace(col(url), r"[?#].*$", ""), r"/+$", "")
    return F.initcap(F.regexp_replace(F.element_at(F.split(path, "/"), -1), "[-_]", " "))


def fill_template(template, values: dict[str, Column]) -> Column:
    """{Name} placeholders, whatever their case, by values; null values as nothing."""
    t = col(template)
    for name, v in values.items():
        t = F.array_join(F.split(t, r"(?i)\{" + name + r"\}"), "\u0001")
        t = F.replace(t, F.lit("\u0001"), F.coalesce(v.cast("string"), F.lit("")))
    return t


def valid_email(x) -> Column:
    return F.coalesce(col(x).rlike(r"^[^\s@]+@[^\s@]+\.[^\s@]+$"), F.lit(False))
