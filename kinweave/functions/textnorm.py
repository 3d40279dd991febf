"""Text normalization as column expressions: case, accents, Indic scripts, legal suffixes, tokens."""

from __future__ import annotations

import unicodedata
from collections.abc import Callable
from functools import lru_cache

from pyspark.sql import Column
from pyspark.sql import functions as F

# Latin readings of Indic letters, vowel signs, signs and digits, by Unicode name.
LETTERS = """
A a, AA aa, I i, II ii, U u, UU uu, VOCALIC R ri, VOCALIC RR ri, VOCALIC L li, VOCALIC LL li,
CANDRA E e, SHORT E e, E e, EE e, AI ai, CANDRA O o, SHORT O o, O o, OO o, AU au,
SHORT A a, CANDRA A a, OE o, OOE o, AW o, UE u, UUE u,
KA k, KHA kh, GA g, GHA gh, NGA n, CA ch, CHA ch, JA j, JHA jh, NYA n,
TTA t, TTHA th, DDA d, DDHA dh, NNA n, NNNA n, TA t, THA th, DA d, DHA dh, NA n,
PA p, PHA ph, BA b, BHA bh, MA m, YA y, RA r, RRA r, LA l, LLA l, LLLA l,
VA v, SHA sh, SSA sh, SA s, HA h, QA q, KHHA kh, GHHA g, ZA z, DDDHA r, RHA r,
FA f, YYA y, GGA g, JJA j, DDDA d, BBA b, ZHA l, MARWARI DDA d, HEAVY YA y, GLOTTAL STOP -
"""
VOWEL_SIGNS = """
AA aa, I i, II ii, U u, UU uu, VOCALIC R ri, VOCALIC RR ri, VOCALIC L li, VOCALIC LL li,
E e, SHORT E e, CANDRA E e, AI ai, O o, SHORT O o, CANDRA O o, AU au,
PRISHTHAMATRA E e, AW o, OE o, OOE o, UE u, UUE u, CANDRA LONG E e
"""
SIGNS = "ANUSVARA n, CANDRABINDU -, INVERTED CANDRABINDU -, VISARGA h, NUKTA -, VIRAMA -"
DIGITS = "ZERO 0, ONE 1, TWO 2, THREE 3, FOUR 4, FIVE 5, SIX 6, SEVEN 7, EIGHT 8, NINE 9"
SCRIPTS = "DEVANAGARI GUJARATI TAMIL TELUGU KANNADA MALAYALAM ORIYA GURMUKHI BENGALI".split()
#: Legal suffixes of company names.
SUFFIXES = "inc incorporated llc llp pvt ltd limited corp corporation company co gmbh plc trust private".split()
#: Fixed value: characters that may wrap a suffix.
WRAPPERS = ".,[](){}'\""

INDIC = range(0x0900, 0x0D80)
JOINERS = "\u200c\u200d"


def _readings(text: str) -> dict[str, str]:
    pairs = (item.strip().rsplit(" ", 1) for item in text.replace("\n", " ").split(","))
    return {name: "" if value == "-" else value for name, value in pairs}


@lru_cache(maxsize=1)
def indic_table() -> dict[int, str]:
    """What each code point of the Indic blocks reads as; those without a reading are spaces."""
    kinds = {"LETTER ": _readings(LETTERS), "VOWEL SIGN ": _readings(VOWEL_SIGNS), "SIGN ": _readings(SIGNS), "DIGIT ": _readings(DIGITS)}
    table = {}
    for cp in INDIC:
        script, _, rest = unicodedata.name(chr(cp), "").partition(" ")
        kind = next((k for k in kinds if rest.startswith(k)), None)
        known = script in SCRIPTS and kind is not None
        table[cp] = kinds[kind].get(rest[len(kind) :], " ") if known else " "
    return table


def fold_text(text: str | None) -> str:
    """The definition in plain Python, from unicodedata: what ``norm_text`` must equal."""
    composed = unicodedata.normalize("NFKC", text or "")
    table = indic_table()
    read = "".join("" if c in JOINERS else table.get(ord(c), c) for c in composed).lower()
    bare = (c for c in unicodedata.normalize("NFKD", read) if unicodedata.category(c) != "Mn")
    return " ".join("".join(c if c.isascii() and c.isalnum() else " " for c in bare).split())


@lru_cache(maxsize=1)
def _tables() -> tuple[list[tuple[str, str]], str, str, list[tuple[str, str]]]:
    """Pairs to compose, translate's two strings, and the placeholders to expand.

    A character that folds to one letter or digit is translated, one that vanishes is deleted, and one
    that folds to several becomes a placeholder, one for each distinct result. Others stay and turn
    into spaces. Placeholders are upper-case or private characters, free after ``lower``.
    """
    pairs = []
    for cp in INDIC:
        parts = unicodedata.decomposition(chr(cp)).split()
        if len(parts) == 2 and "<" not in parts[0] and unicodedata.normalize("NFC", chr(cp)) == chr(cp):
            pairs.append(("".join(chr(int(p, 16)) for p in parts), chr(cp)))
    source, target, deleted, places = [], [], [*JOINERS], {}
    for cp in (*range(0x80, 0xD800), *range(0xE000, 0x110000)):
        c = chr(cp)
        plain = unicodedata.normalize("NFKD", c) == c == c.lower() and unicodedata.category(c) != "Mn" and cp not in INDIC
        if plain or c in JOINERS or unicodedata.category(c) == "Cn":
            continue  # a space, or nothing
        inner = fold_text(f"x{c}x")[1:-1]
        if inner == "":
            deleted.append(c)
        elif inner != " " and len(inner) == 1:
            source.append(c)
            target.append(inner)
        elif inner.strip():
            places.setdefault(inner, chr(0xE000 + len(places)))
            source.append(c)
            target.append(places[inner])
    # the text's own private characters are spaces, not placeholders
    source += places.values()
    target += " " * len(places)
    return pairs, "".join(source + deleted), "".join(target), [(p, text) for text, p in places.items()]


def _once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once, however often ``use`` names it."""
    return F.element_at(F.transform(F.array(value), use), 1)


def norm_text(col: Column) -> Column:
    """Lower-case ASCII letters and digits in single spaces; null becomes the empty text.

    Accents and marks vanish, Indic scripts are read as Latin. Text that is ASCII already skips the
    tables, text without Indic characters the composition, and text without placeholders their expansion.
    """
    pairs, source, target, places = _tables()

    def compose(text: Column) -> Column:
        whole = text
        for pair, one in pairs:
            whole = F.replace(whole, F.lit(pair), F.lit(one))
        return F.when(text.rlike(r"[\u0900-\u0D7F]"), whole).otherwise(text)

    def spread(text: Column) -> Column:
        held = F.split(F.lit("\n".join(f"{place}{reading}" for place, reading in places)), "\n")
        full = F.aggregate(held, text, lambda t, p: F.replace(t, F.substring(p, 1, 1), F.substr(p, F.lit(2))))
        return F.when(text.rlike(r"[\uE000-\uF8FF]"), full).otherwise(text)

    def fold(text: Column) -> Column:
        folded = F.translate(compose(text), source, target)
        return F.when(text.rlike(r"[^\x00-\x7f]"), _once(folded, spread)).otherwise(text)

    return F.trim(F.regexp_replace(_once(F.lower(F.coalesce(col, F.lit(""))), fold), "[^a-z0-9]+", " "))


def strip_suffixes(name: Column) -> Column:
    """Drop legal suffixes, alone or wrapped in punctuation, and bare punctuation from both ends of a name in single spaces."""
    wrap = "[" + "".join("\\" + c for c in WRAPPERS) + "]"
    token = f"(?:{wrap}*(?:{'|'.join(SUFFIXES)}){wrap}*|{wrap}+)"
    front = F.regexp_replace(name, f"^(?:{token}(?: |$))+", "")
    return F.regexp_replace(front, f"(?:(?:^| ){token})+$", "")


def tokens(text: Column) -> Column:
    """Tokens between single spaces; none for an empty text."""
    return F.filter(F.split(text, " "), lambda t: t != "")


def token_bag(text: Column) -> Column:
    """Distinct tokens in order, joined by spaces."""
    return F.array_join(F.array_sort(F.array_distinct(tokens(text))), " ")


def raw_tokens(text: Column) -> Column:
    """Distinct tokens between any white space of the text in lower case, punctuation kept."""
    return F.array_distinct(F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), "(?U)\\s+"), lambda t: t != ""))


def street_number(address: Column) -> Column:
    """The first token of a normalized address if it starts with a digit, else the empty text."""
    return F.regexp_extract(address, "^([0-9][a-z0-9]*)", 1)
