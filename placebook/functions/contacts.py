"""Contacts and delivery signals out of a page's HTML."""

from __future__ import annotations

import json
from html.entities import html5

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from placebook.functions.text import MOBILE, clean_phones

# fixed values: what counts as an address, a profile, a number, a signal
EMAIL = r"[A-Za-z0-9._%+\-]+@[A-Za-z0-9.\-]+\.[A-Za-z]{2,}"
BAD_EMAIL = (r"(?i)(noreply|no-reply|donotreply|example\.(com|org)|sentry|wixpress|@\d+x\.|"
             r"\.(png|jpe?g|gif|svg|webp|css|js)$|yourdomain|domain\.com|email\.com|user@)")
MAILTO = r"""(?i)mailto:([^"'?>\s]+)"""
INSTAGRAM = r"(?i)instagram\.com/([A-Za-z0-9_.]{2,30})"
FACEBOOK = (r"(?i)facebook\.com/(?!sharer|share|dialog|plugins|tr\b)"
            r"([A-Za-z0-9.\-]{2,80}|profile\.php\?id=\d+)")
TWITTER = r"(?i)(?:twitter|x)\.com/(?!intent|share|home)([A-Za-z0-9_]{1,15})\b"
LINKEDIN = r"(?i)linkedin\.com/((?:company|in)/[A-Za-z0-9\-_%]{2,100})"
TIKTOK = r"(?i)tiktok\.com/@([A-Za-z0-9_.]{2,30})"
NO_PROFILE = ["p", "reel", "reels", "explore", "accounts", "stories", "tv", "about", "legal", "privacy", "help",
              "login", "signup", "home", "pages", "groups", "events", "watch", "search"]
WHATSAPP = r"(?i)(?:wa\.me/|api\.whatsapp\.com/send/?\?phone=|whatsapp\.com/send\?phone=)\+?(\d{10,15})"
TEL_LINK = r"""(?i)href=["']tel:([^"']+)"""
DELIVERY = (r"(?i)\b(deliver(?:y|ies)?|dispatch|bulk order|corporate order|catering|wholesale|we deliver|"
            r"free delivery)\b")
ORDER_ONLINE = r"(?i)\b(order online|order now|place an order|add to cart|checkout)\b"
SOCIAL_HOSTS = ["instagram.com", "facebook.com", "fb.com", "twitter.com", "x.com", "tiktok.com", "linkedin.com",
                "wa.me", "whatsapp.com", "google.com", "goo.gl", "g.page"]
SOCIAL_FIELDS = ["instagram", "facebook", "twitter", "linkedin", "tiktok"]
TAG = r"<[^>]+>"
SCRIPTS = r"(?is)<(script|style)\b.*?</\1>"


# what may follow an ampersand as a reference, and the names that also count without a semicolon
_REFERENCE = r"^(#[0-9]+;?|#[xX][0-9a-fA-F]+;?|[^\t\n\f <&#;]{1,32};?)"
_OPEN_NAMES = sorted((n for n in html5 if not n.endswith(";")), key=lambda n: (-len(n), n))


def _windows_1252(code: int) -> str:
    """References to the bytes 128 to 159 mean the characters that Windows has there."""
    try:
        return bytes([code]).decode("cp1252")
    except UnicodeDecodeError:
        return chr(code)


def _literal_map(pairs: dict[str, str]) -> Column:
    """A constant map, folded once into the plan."""
    return F.from_json(F.lit(json.dumps(pairs)), "map<string,string>")


def _numbered(token: Column) -> Column:
    """The character of a reference by number; '' where none is allowed, U+FFFD where there is none."""
    digits = F.regexp_extract(token, "^#[xX]?0*([0-9a-fA-F]*)", 1)
    hexadecimal = token.rlike("^#[xX]")
    most = F.when(hexadecimal, 6).otherwise(7)               # longer numbers are no characters
    code = F.when(digits == "", 0).when(F.length(digits) > most, 1 << 24).otherwise(
        F.when(hexadecimal, F.conv(digits, 16, 10)).otherwise(digits).cast("int"))
    low = F.try_element_at(F.array(*[F.lit(_windows_1252(c)) for c in range(128, 160)]), code - 127)
    nothing = (code.between(1, 8) | (code == 11) | code.between(14, 31) | (code == 127) | code.between(0xFDD0, 0xFDEF)
               | (F.pmod(code, F.lit(0x10000)) >= 0xFFFE))
    char = F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32")
    return (F.when((code == 0) | code.between(0xD800, 0xDFFF) | (code > 0x10FFFF), "\ufffd").when(code.between(128, 159), low)
            .when(nothing, "").otherwise(char))


def _decoded(part: Column) -> Column:
    """What follows an ampersand, with the reference at its start decoded."""
    token = F.regexp_extract(part, _REFERENCE, 1)
    rest = F.substr(part, F.length(token) + 1)
    named = F.try_element_at(_literal_map(html5), token)
    begun = F.get(F.filter(F.array(*[F.lit(n) for n in _OPEN_NAMES]), lambda n: F.startswith(token, n)), F.lit(0))
    prefix = F.concat(F.try_element_at(_literal_map({n: html5[n] for n in _OPEN_NAMES}), begun), F.substr(token, F.length(begun) + 1))
    value = F.when(token.startswith("#"), _numbered(token)).otherwise(F.coalesce(named, prefix, F.concat(F.lit("&"), token)))
    return F.when(token == "", F.concat(F.lit("&"), part)).otherwise(F.concat(value, rest))


def unescape(html: Column | str) -> Column:
    """HTML references, named and numbered, as characters: the text is split at its ampersands, and only what follows one is looked at."""
    html = F.col(html) if isinstance(html, str) else html
    parts = F.split(html, "&", -1)
    decoded = F.concat(F.get(parts, F.lit(0)), F.array_join(F.transform(F.slice(parts, F.lit(2), F.size(parts)), _decoded), ""))
    return F.when(F.contains(html, F.lit("&")), decoded).otherwise(html)


def emails(text: Column, words: Column) -> Column:
    """Addresses of mail links, then of the visible text; lower case, without throwaway ones."""
    # a plus sign is part of an address, not an encoded blank
    linked = F.transform(F.regexp_extract_all(text, F.lit(MAILTO), F.lit(1)),
                         lambda m: F.coalesce(F.try_url_decode(F.replace(m, F.lit("+"), F.lit("%2B"))), m))
    found = F.concat(linked, F.regexp_extract_all(words, F.lit(EMAIL), F.lit(0)))
    tidy = F.transform(found, lambda e: F.lower(F.regexp_replace(F.trim(e), r"^\.+|\.+$", "")))
    return F.array_distinct(F.filter(tidy, lambda e: e.rlike(f"^{EMAIL}$") & ~e.rlike(BAD_EMAIL)))


def _profiles(text: Column, pattern: str, prefix: str, handle=lambda h: h) -> Column:
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(1))
    real = F.filter(found, lambda h: ~F.regexp_replace(F.lower(handle(h)), r"^\.+|\.+$", "").isin(NO_PROFILE))
    return F.array_distinct(F.transform(real, lambda h: F.concat(F.lit(prefix), h)))


def socials(text: Column) -> dict[str, Column]:
    """Canonical profile addresses per network, in order of appearance."""
    instagram = F.transform(_profiles(text, INSTAGRAM, "https://www.instagram.com/"),
                            lambda u: F.regexp_replace(u, r"\.+$", ""))
    return {
        "instagram": F.array_distinct(instagram),
        "facebook": _profiles(text, FACEBOOK, "https://www.facebook.com/"),
        "twitter": _profiles(text, TWITTER, "https://x.com/"),
        "linkedin": _profiles(text, LINKEDIN, "https://www.linkedin.com/",
                              lambda h: F.substring_index(h, "/", -1)),
        "tiktok": _profiles(text, TIKTOK, "https://www.tiktok.com/@"),
    }


def delivery_signals(visible: Column) -> Column:
    words = F.transform(F.regexp_extract_all(visible, F.lit(DELIVERY), F.lit(1)), F.lower)
    return F.array_distinct(F.transform(
        words, lambda w: F.when(F.startswith(w, F.lit("deliver")), F.lit("delivery")).otherwise(w)))


def extract_contacts(pages: DataFrame, html: str = "html") -> DataFrame:
    """Add emails, phones, whatsapp, the five networks, delivery and order_online to a page table.

    All of it is expressions in the JVM.
    """
    text, words, visible = F.col("_text"), F.col("_words"), F.col("_visible")
    numbers = F.concat(F.regexp_extract_all(text, F.lit(TEL_LINK), F.lit(1)),
                       F.regexp_extract_all(words, F.lit(MOBILE), F.lit(0)))
    return (pages.withColumn("_text", unescape(html))
            .withColumn("_words", F.regexp_replace(text, TAG, " "))
            .withColumn("_visible", F.regexp_replace(F.regexp_replace(text, SCRIPTS, " "), TAG, " "))
            .withColumns({
                "emails": emails(text, words),
                **socials(text),
                "whatsapp": clean_phones(F.regexp_extract_all(text, F.lit(WHATSAPP), F.lit(1))),
                "phones": clean_phones(numbers),
                "delivery": delivery_signals(visible),
                "order_online": visible.rlike(ORDER_ONLINE),
            }).drop("_text", "_words", "_visible"))


def host_of(url: Column | str) -> Column:
    url = F.col(url) if isinstance(url, str) else url
    full = F.when(url.rlike("^http"), url).otherwise(F.concat(F.lit("http://"), url))
    return F.lower(F.regexp_extract(full, r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def is_social_site(url: Column | str) -> Column:
    """Whether a 'website' is a profile on a network: the host or a subdomain of it."""
    host = host_of(url)
    return F.exists(F.array(*[F.lit(h) for h in SOCIAL_HOSTS]),
                    lambda h: (host == h) | F.endswith(host, F.concat(F.lit("."), h)))
