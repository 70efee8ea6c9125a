"""Phones, names, addresses and other text cleaning, as column expressions.

Patterns carry (?U) where the input is raw text, so that blanks and digits outside ASCII (a no-break
space inside a phone number, say) count as blanks and digits.
"""

from __future__ import annotations

import sys
import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# fixed values: words that do not tell two business names apart
COMPANY_WORDS = ("ltd limited nig nigeria plc enterprises enterprise ventures venture company co and the "
                 "services service int'l international global").split()
# fixed values: words that do not tell two addresses apart
STREET_WORDS = ("street st road rd avenue ave close cl crescent cres drive dr lane ln way estate est shop "
                "suite plot block flat no").split()
# fixed values: a mobile number, a unit before the street, places that are no business
MOBILE = r"(?U)(?:\+?234|0)[\s\-]?([789]\d{2}[\s\-]?\d{3}[\s\-]?\d{4})"
UNIT_PREFIX = r"(?iU)^(shop|suite|plot|block|flat|no\.?)\s*[\w/]*\s*,?\s*"
LANDMARK = r"(?iU)\b(bus ?stop|busstop|bus-stop|roundabout|flyover|under ?bridge)\b"
BARE_STREET = r"(?iU)\b(street|crescent|close|avenue|road)\s*$"
PHONE_FORMAT = r"^\+234[0-9]{10}$|^\+2341[0-9]{7,8}$"


def column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Work out `value` once per row and use it in `body`.

    Inside a higher-order function an outer expression would be worked out again for every element.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def strip(c: Column | str) -> Column:
    """Trim every kind of blank, not only spaces."""
    return F.regexp_replace(column(c), r"(?U)^\s+|\s+$", "")


def blank(c: Column | str) -> Column:
    return F.coalesce(column(c), F.lit("")) == ""


def first_filled(*cols: Column | str) -> Column:
    """The first value that is neither NULL nor empty, else ''."""
    return F.coalesce(*[F.nullif(column(c), F.lit("")) for c in cols], F.lit(""))


@lru_cache(maxsize=1)
def _folds() -> tuple[str, str, dict[str, str]]:
    """Letters that decompose to ASCII, worked out from Unicode: one-letter folds and longer ones."""
    source, target, longer = [], [], {}
    for code in range(0x80, sys.maxunicode + 1):
        ch = chr(code)
        if 0xD800 <= code <= 0xDFFF or code > 0x1FFFF:
            continue
        plain = unicodedata.normalize("NFKD", ch).encode("ascii", "ignore").decode()
        if len(plain) == 1:
            source.append(ch)
            target.append(plain)
        elif plain:
            longer[ch] = plain
    return "".join(source), "".join(target), longer


@lru_cache(maxsize=1)
def _long_folds() -> list[tuple[str, str]]:
    """Longer folds grouped by their ASCII form: (character class, replacement)."""
    grouped: dict[str, list[str]] = {}
    for ch, plain in _folds()[2].items():
        grouped.setdefault(plain, []).append(ch)
    return [("".join(chars), plain) for plain, chars in grouped.items()]


def fold_ascii(c: Column | str) -> Column:
    """Fold accents and compatibility forms to ASCII and drop what is left outside ASCII.

    Only rows that hold such characters pay for it; Spark has no normalize(), so the folds are a
    translate() table worked out from the Unicode data. Ligatures and the like, which fold to several
    letters, go character by character through a literal map.
    """
    raw = F.coalesce(column(c), F.lit(""))
    source, target, longer = _folds()
    single = F.translate(raw, source, target)
    pairs = F.from_json(F.lit(_json(longer)), "map<string,string>")
    spelled = F.array_join(
        F.transform(F.split(single, ""), lambda ch: F.coalesce(F.try_element_at(pairs, ch), ch)), "")
    folded = F.when(single.rlike(r"[^\x00-\x7F]"), F.regexp_replace(spelled, r"[^\x00-\x7F]", "")).otherwise(single)
    return F.when(raw.rlike(r"[^\x00-\x7F]"), folded).otherwise(raw)


def _json(value: object) -> str:
    import json

    return json.dumps(value, ensure_ascii=False)


def _bare_words(c: Column | str, words: list[str]) -> Column:
    """Lower-case ASCII words without the given ones.

    Words are split first and looked up in a set, which is far cheaper than searching the text for
    twenty alternatives. An underscore joins words (as it does for a word boundary) until the end; the
    one given word with an apostrophe is taken out before the split.
    """
    text = F.lower(fold_ascii(c))
    for word in [w for w in words if "'" in w]:
        text = F.when(F.contains(text, F.lit("'")), F.regexp_replace(text, rf"\b{word}\b", " ")).otherwise(text)
    kept = F.filter(F.split(text, "[^a-z0-9_]+"), lambda w: ~w.isin(words))
    return F.trim(let(F.array_join(kept, " "), lambda t: F.when(                     # only a first or last word is empty
        F.contains(t, F.lit("_")), F.regexp_replace(t, "[ _]+", " ")).otherwise(t)))


def norm_name(c: Column | str) -> Column:
    """The name without accents, company words and punctuation: equal for spellings of one business."""
    return _bare_words(c, COMPANY_WORDS)


def norm_addr(c: Column | str) -> Column:
    return _bare_words(c, STREET_WORDS)


def clean_phone(c: Column | str) -> Column:
    """+234 and the subscriber number, or '' for anything that is no Nigerian number.

    The first mobile number found in the text wins; a landline is 1 and seven or eight digits.
    """
    raw = F.coalesce(column(c), F.lit(""))
    mobile = F.regexp_extract(raw, MOBILE, 1)
    digits = F.regexp_replace(raw, r"(?U)\D", "")
    return (
        F.when(mobile != "", F.concat(F.lit("+234"), F.regexp_replace(mobile, r"(?U)\D", "")))
        .when(digits.rlike("^0[789].{9,}$"), F.concat(F.lit("+234"), F.substring(digits, 2, 10)))
        .when(digits.rlike("^234[789].{9,}$"), F.concat(F.lit("+234"), F.substring(digits, 4, 10)))
        .when(digits.rlike("^2341.{7,8}$"), F.concat(F.lit("+"), digits))
        .when(digits.rlike("^01.{7,8}$"), F.concat(F.lit("+234"), F.substring(digits, 2, 9)))
        .otherwise(F.lit(""))
    )


def clean_phones(parts: Column) -> Column:
    """Clean every element, drop the empty ones, keep the first of equals."""
    return F.array_distinct(F.filter(F.transform(parts, clean_phone), lambda p: p != ""))


def first_of(parts: Column) -> Column:
    return F.coalesce(F.get(parts, F.lit(0)), F.lit(""))


def street_of(c: Column | str) -> Column:
    """The address before its first comma, without a unit number in front, at most 60 characters."""
    head = strip(F.substring_index(F.coalesce(column(c), F.lit("")), ",", 1))
    return F.substring(F.regexp_replace(head, UNIT_PREFIX, ""), 1, 60)


def poi_reason(name: Column | str, label: Column | str) -> Column:
    """Why a record is a landmark or a bare street and no business; '' if it is one."""
    text = strip(F.coalesce(column(name), F.lit("")))
    return (
        F.when(~blank(label), F.lit(""))
        .when(text.rlike(LANDMARK), F.lit("transport landmark, no category label"))
        .when(text.rlike(BARE_STREET), F.lit("bare street name, no category label"))
        .otherwise(F.lit(""))
    )


def month_label(c: Column | str) -> Column:
    """'Oct 2026' for an ISO date."""
    return F.date_format(F.to_date(column(c)), "MMM yyyy")


def slug(c: Column | str) -> Column:
    return F.regexp_replace(F.regexp_replace(F.lower(column(c)), "[^a-z0-9]+", "-"), "^-+|-+$", "")


def slugs(area: Column, aliases: Column) -> Column:
    """Address parts under which a directory may file an area: each half of its name, then its aliases."""
    names = F.concat(F.transform(F.split(area, "/"), strip), F.coalesce(aliases, F.array().cast("array<string>")))
    return F.array_distinct(F.transform(F.filter(names, lambda n: n != ""), slug))


def number(c: Column | str) -> Column:
    """A number where the text is one, else NULL (a plain cast would fail the job)."""
    return strip(column(c)).try_cast("double")
