"""Text normalisation as built-in column expressions: no UDF, so all of it stays in generated code.

Everything works on code points, as Spark strings do. Null in, null out.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, functions as F

# Results depend on these exact code points.
#: Letters with a circumflex and what they become.
TRANSLIT_FROM, TRANSLIT_TO = "âîûÂÎ", "aiuAI"
#: Devanagari letters and signs that make a longer word; dandas, digits and avagraha do not.
DEVANAGARI_WORD = r"\u0900-\u0903\u0905-\u0939\u093c\u093e-\u094f\u0951-\u0963\u0972-\u097f"
GUARDED_WORD, GUARDED_REPLACEMENT = r"\u0916\u093c?\u0941\u0926\u093e", "\u0905\u0932\u094d\u0932\u093e\u0939"
#: Code points that are mapped to others.
MAPPED = {"\ue003": "\u0656", "\ue004": "\u0657", "\u06aa": "\u0643", "\u06d2": "\u064a", "\u2002": " ", "\u2003": " "}
#: Code points that are removed: private-use pause signs, then format controls.
PAUSE_SIGNS = "\ue01a\ue01b\ue01c\ue01e\ue01f\ue021\ue022"
FORMAT_CONTROLS = "\u200b\u200c\u200d\u200e\u200f\ufeff\u0604"
#: A bare spelling and the one with its marks.
BARE, MARKED = "\u0644\u0644\u0647", "\u0644\u0644\u0651\u0670\u0647"
#: Marks above which no small high sign may stand, those signs, and what does not end a cluster of marks.
MADD = r"\u0653\u06e4"
SMALL_HIGH = r"\u06d6-\u06dc"
CLUSTER = r"\u0600-\u0620\u064b-\u066f\u0672-\u06d5\u06dd-\u06ff"
#: What counts as false in a flag column.
FALSE_WORDS = ("", "0", "none", "None", "false")
#: White space as str.strip() sees it: Unicode white space and the four separators of ASCII.
_WHITE = r"[\s\x1c-\x1f]"


def lower_between_hyphens(text: Column) -> Column:
    """A capital E between two hyphens becomes e."""
    return F.regexp_replace(text, "(?<=-)E(?=-)", "e")


def flatten_translit(text: Column) -> Column:
    return F.translate(text, TRANSLIT_FROM, TRANSLIT_TO)


def squeeze_spaces(text: Column) -> Column:
    """No-break spaces become spaces, runs of spaces one space; tabs and line feeds stay."""
    return F.regexp_replace(F.translate(text, "\u00a0", " "), " {2,}", " ")


def replace_guarded(text: Column, pattern: str = GUARDED_WORD, replacement: str = GUARDED_REPLACEMENT, letters: str = DEVANAGARI_WORD) -> Column:
    """pattern becomes replacement where none of `letters` stands next to it."""
    return F.regexp_replace(text, f"(?<![{letters}]){pattern}(?![{letters}])", replacement)


def strip(text: Column) -> Column:
    """Without white space at both ends, as Python's str.strip() does it."""
    return F.regexp_replace(text, rf"(?U)^{_WHITE}+|{_WHITE}+$", "")


def strip_lower(text: Column) -> Column:
    return F.lower(strip(text))


def drop_stacked_signs(text: Column) -> Column:
    """Removes small high signs that follow a madd mark within the same cluster of marks."""
    return F.regexp_replace(text, rf"((?:\G(?!^)|[{MADD}])[{CLUSTER}]*)[{SMALL_HIGH}]", "$1")


def normalise_code_points(text: Column) -> Column:
    """Maps and removes single code points, squeezes white space, then writes out marks and drops stacked signs."""
    mapped = F.translate(text, "".join(MAPPED) + PAUSE_SIGNS + FORMAT_CONTROLS, "".join(MAPPED.values()))
    spaced = strip(F.regexp_replace(mapped, f"(?U){_WHITE}+", " "))
    return drop_stacked_signs(F.replace(spaced, F.lit(BARE), F.lit(MARKED)))


def flag(value: Column) -> Column:
    """0 for the words of FALSE_WORDS, 1 for anything else, null for null."""
    return F.when(value.isNotNull(), (~strip(value.cast("string")).isin(*FALSE_WORDS)).cast("int"))


def count_in_class(text: Column, characters: str) -> Column:
    """How many characters of text are in a regular-expression class; null counts 0."""
    return F.coalesce(F.regexp_count(text, F.lit(f"[{characters}]")), F.lit(0)).cast("long")


def verse_key(chapter: Column, verse: Column) -> Column:
    return F.concat_ws(":", chapter.cast("string"), verse.cast("string"))


def parse_key(key: Column) -> tuple[Column, Column]:
    """(chapter, verse) of "c:v"; a key with other than two parts is an error."""
    parts = F.split(key.cast("string"), ":")
    good = F.when(F.size(parts) == 2, parts).otherwise(F.raise_error(F.concat(F.lit("not a chapter:verse key: "), key.cast("string"))).cast("array<string>"))
    return F.when(key.isNotNull(), strip(good[0]).cast("int")), F.when(key.isNotNull(), strip(good[1]).cast("int"))


#: Transformations that an edition can switch on, in the order in which they apply.
EDITION_FLAGS: dict[str, Callable[[Column], Column]] = {"strip_translit_diacritics": flatten_translit, "collapse_nbsp": squeeze_spaces, "khuda_to_allah": replace_guarded}


def apply_flags(text: Column, flags: set[str]) -> Column:
    return reduce(lambda c, name: EDITION_FLAGS[name](c) if name in flags else c, EDITION_FLAGS, text)
