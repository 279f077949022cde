"""Text cleaning and text predicates."""

from __future__ import annotations

import html
import re
import string
import unicodedata
from collections.abc import Iterable
from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, functions as F, types as T

from opinionlake.fixed import BOILERPLATE, MIN_PARAGRAPH, TYPOGRAPHIC_MARKS, UNKNOWN_AUTHOR
from opinionlake.functions.lookup import let

# White space and its opposite in the sense of Unicode.
SPACE, VISIBLE = r"(?U)\s", r"(?U)\S"
_DELETED = string.punctuation + TYPOGRAPHIC_MARKS


@F.pandas_udf(T.StringType())
def _normalise_batch(texts: pd.Series) -> pd.Series:
    return texts.map(lambda t: html.unescape(unicodedata.normalize("NFKC", t)), na_action="ignore")


@lru_cache(maxsize=1)
def unstable_characters() -> str:
    """Inside of a character class: the characters that NFKC changes or joins to what stands before them."""
    found = set()
    for code in range(0x80, 0x110000):
        char = chr(code)
        parts = unicodedata.decomposition(char).split()
        if len(parts) == 2 and not parts[0].startswith("<"):
            found.add(int(parts[1], 16))
        if unicodedata.combining(char) or not 0xD800 <= code < 0xE000 and not unicodedata.is_normalized("NFKC", char):
            found.add(code)
    found |= {*range(0x1161, 0x1176), *range(0x11A8, 0x11C3)}  # Hangul vowels and finals join by rule
    codes = sorted(c for c in found if c >= 0x80)
    runs = [(codes[0], codes[0])]
    for code in codes[1:]:
        runs[-1:] = [(runs[-1][0], code)] if code == runs[-1][1] + 1 else [runs[-1], (code, code)]
    return "".join(f"\\x{{{a:x}}}-\\x{{{b:x}}}" for a, b in runs)


def rare_characters(col: Column) -> Column:
    """The text without ASCII and the letters of Latin-1, which never change.

    The long class of the others takes its time for each character it is tried on.
    """
    return F.regexp_replace(F.regexp_replace(col, r"[\x00-\x7F]+", ""), r"[\xC0-\xFF]+", "")


def nfkc_unescape(col: Column) -> Column:
    """NFKC form, then HTML entities decoded.

    Spark has neither as a built-in.  Only texts that can change (a character that
    NFKC changes, or an ampersand) are sent over Arrow; the others stay in the JVM.
    """
    may_change = F.contains(col, F.lit("&")) | (col.rlike(r"[^\x00-\x7F]") & rare_characters(col).rlike(f"[{unstable_characters()}]"))
    return F.coalesce(_normalise_batch(F.when(may_change, col)), col)


def _replace_where(col: Column, parts: Iterable[str], pattern: str, by: str) -> Column:
    """Regex replacement for the texts that hold one of the literal parts; the others are passed on."""
    def apply(text: Column) -> Column:
        hit = F.lit(False)
        for part in parts:
            hit = hit | F.contains(text, F.lit(part))
        return F.when(hit, F.regexp_replace(text, pattern, by)).otherwise(text)

    return let(col, apply)


def strip_tags(col: Column) -> Column:
    return _replace_where(col, ["<"], r"<[^>]+>", " ")


def drop_urls(col: Column) -> Column:
    return _replace_where(col, ["http", "www"], r"(?U)http\S+|www\S+", "")


def drop_social(col: Column, anchored: bool = False) -> Column:
    """Remove hashtags, user mentions and forum names.

    Unanchored by default: the two-character prefixes also match inside words.
    """
    edge = r"\b" if anchored else ""
    for mark, start in (("#", "#"), ("u/", edge + "u/"), ("r/", edge + "r/")):
        col = _replace_where(col, [mark], rf"(?U){start}\w+", "")
    return col


def drop_punct(col: Column) -> Column:
    return F.translate(col, _DELETED, "")


def squash(col: Column) -> Column:
    """Runs of white space become one blank; none at the ends."""
    return F.trim(F.regexp_replace(col, f"{SPACE}+", " "))


def strip(col: Column) -> Column:
    return F.regexp_replace(col, r"(?U)^\s+|\s+$", "")


def is_blank(col: Column) -> Column:
    """True for null and for text without a visible character."""
    return col.isNull() | ~col.rlike(VISIBLE)


def blank_if_null(col: Column) -> Column:
    return F.coalesce(col, F.lit(""))


def fill_author(col: Column) -> Column:
    return F.coalesce(col, F.lit(UNKNOWN_AUTHOR))


def clean_text(col: Column, social: bool = False, anchored: bool = False) -> Column:
    """The full cleaning chain; null and blank give an empty string."""
    text = drop_urls(F.lower(strip_tags(nfkc_unescape(col))))
    if social:
        text = drop_social(text, anchored)
    return F.when(is_blank(col), F.lit("")).otherwise(squash(drop_punct(text)))


def body_from_paragraphs(paragraphs: Column, decoded: bool = False, min_len: int = MIN_PARAGRAPH,
                         phrases: Iterable[str] = BOILERPLATE) -> Column:
    """Join the paragraphs that are long enough and hold no boilerplate; null when none is left.

    Entities are decoded first; the array travels as one delimited text so the
    decoder sees one value per row.  ``decoded`` skips that step.
    """
    mark = "\u0001"
    # the plain decoder, without NFKC: lengths are measured on the decoded text
    texts = paragraphs if decoded else F.split(unescape(F.array_join(paragraphs, mark)), mark)
    cleaned = F.transform(texts, lambda p: squash(strip_tags(p)))

    def keep(p: Column) -> Column:
        noisy = F.lit(False)
        for phrase in phrases:
            noisy = noisy | F.contains(p, F.lit(phrase))
        return (F.length(p) >= min_len) & ~noisy

    return F.nullif(F.array_join(F.filter(cleaned, keep), " "), F.lit(""))


@F.pandas_udf(T.StringType())
def _unescape_batch(texts: pd.Series) -> pd.Series:
    return texts.map(html.unescape, na_action="ignore")


def unescape(col: Column) -> Column:
    """HTML entities decoded; only texts with an ampersand cross to Python."""
    return F.coalesce(_unescape_batch(F.when(F.contains(col, F.lit("&")), col)), col)


def first_int(col: Column) -> Column:
    """First run of digits as a number; null when there is none."""
    return F.regexp_extract(col, r"(\d+)", 1).try_cast("int")


def meta_get(meta: Column, key: str) -> Column:
    return F.try_element_at(meta, F.lit(key))


def meta_from_text(col: Column) -> Column:
    """A map stored as a Python dict literal; null when it cannot be read.

    ``None`` values become JSON nulls first.
    """
    text = F.regexp_replace(col, r"(?<=[:\s])None(?=\s*[,}])", "null")
    return F.from_json(text, "map<string,string>", {"allowSingleQuotes": "true"})


def post_url(permalink: Column, url: Column, site: str) -> Column:
    return F.when(permalink != "", F.concat(F.lit(site), permalink)).otherwise(url)


def scoring_text(body: Column, title: Column) -> Column:
    """The text to score: the body, else the title, else an empty string."""
    return F.when(~is_blank(body), body).when(~is_blank(title), title).otherwise(F.lit(""))


def snippet(col: Column, n: int) -> Column:
    return strip(F.substring(col, 1, n))


def shorten(col: Column, n: int = 220) -> Column:
    return F.when(F.length(col) > n, F.concat(F.substring(col, 1, n), F.lit("..."))).otherwise(col)


def word_pattern(words: Iterable[str]) -> str:
    """A case-insensitive whole-word pattern for any of the words or phrases."""
    return r"(?iU)\b(?:" + "|".join(re.escape(w).replace(r"\ ", " ") for w in words) + r")\b"


def any_word(col: Column, words: Iterable[str]) -> Column:
    return col.rlike(word_pattern(words))


def hint_count(col: Column, hints: Iterable[str]) -> Column:
    """Non-overlapping occurrences of each padded hint in the lower-cased, padded text."""
    def counted(padded: Column) -> Column:
        total = F.lit(0)
        for hint in hints:
            total = total + (F.length(padded) - F.length(F.replace(padded, F.lit(hint), F.lit("")))) / len(hint)
        return total.cast("int")

    return let(F.concat(F.lit(" "), F.lower(col), F.lit(" ")), counted)
