"""Text expressions (Column -> Column), all JVM-side.

Each function mirrors one cleaning step of the original job with built-in
Spark expressions so that it stays inside whole-stage codegen.
"""

from __future__ import annotations

import sys
import unicodedata
from functools import cache

from pyspark.sql import Column
from pyspark.sql import functions as F

from terroir.quirks import PARITY, Quirks

# ---------------------------------------------------------------------------
# Fixed values (must equal the original job's behaviour)
# ---------------------------------------------------------------------------

# Characters that Python's str.isspace() accepts: TAB LF VT FF CR, FS GS RS US,
# SPACE, NEL, NBSP, OGHAM SPACE MARK, EN QUAD .. HAIR SPACE, LINE SEP,
# PARAGRAPH SEP, NNBSP, MMSP, IDEOGRAPHIC SPACE.
WS_CHARS = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
            + "".join(chr(c) for c in range(0x2000, 0x200B)) + "\u2028\u2029\u202f\u205f\u3000")

# Characters whose presence triggers the latin1 -> UTF-8 repair.
MOJIBAKE_TRIGGERS = "ÃÂâð�"

# Whole-cell label fixes applied after title case.
LABEL_MAP = {
    "Rhone": "Rhône",
    "1Ere": "1ère",
    "2Eme": "2ème",
    "3Eme": "3ème",
    "4Eme": "4ème",
    "5Eme": "5ème",
    "6Eme": "6ème",
    "7Eme": "7ème",
    "8Eme": "8ème",
    "9Eme": "9ème",
}

# Ordinal suffix regex: "(digits)Ème" -> "(digits)ème".
ORDINAL_PATTERN = r"(\d+)Ème"
ORDINAL_REPLACEMENT = "$1ème"
# Corrected form (quirk Q9 off): both suffixes, any position.
ORDINAL_FIRST_FULL = r"(\d+)(Ere|Ère)\b"
ORDINAL_NTH_FULL = r"(\d+)(Eme|Ème)\b"

# ---------------------------------------------------------------------------


def _characters():
    return (chr(i) for i in range(sys.maxunicode + 1) if not 0xD800 <= i <= 0xDFFF)


@cache
def rare_titles() -> dict[str, str]:
    """Characters whose title form the lower-case + `initcap` route cannot
    produce: a title form of several characters ('ß' -> 'Ss', 'ﬁ' -> 'Fi'), or
    one that differs from the title form of the lower case ('İ', 'ẞ', Georgian
    capitals ...). Derived from the Unicode database on first use."""
    return {ch: ch.title() for ch in _characters() if len(ch.title()) > 1 or ch.title() != ch.lower().title()}


@cache
def ascii_forms() -> tuple[dict[str, str], dict[str, str]]:
    """Non-ASCII characters whose compatibility decomposition (NFKD) holds
    ASCII characters: those with one, those with several. Derived from the
    Unicode database on first use."""
    one, several = {}, {}
    for ch in _characters():
        if ch > "\x7f" and unicodedata.decomposition(ch):
            plain = "".join(x for x in unicodedata.normalize("NFKD", ch) if x <= "\x7f")
            if plain:
                (one if len(plain) == 1 else several)[ch] = plain
    return one, several


# Markers used during title casing: original spaces (ASCII keeps initcap on
# its fast path) and token-initial letters with a multi-character title form.
_SPACE_MARK = "\x01"
_DONE_MARK = "\x02"
_CASED = r"\p{IsLowercase}\p{IsUppercase}\p{IsTitlecase}"
_UNCASED = f"[^{_CASED}]"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip(c) -> Column:
    """remove leading/trailing whitespace as Python's str.strip() does
    (Spark's trim only removes U+0020)."""
    return F.btrim(_c(c), F.lit(WS_CHARS))


def strip_char(c, ch: str) -> Column:
    """remove a character at both ends (str.strip(ch))."""
    return F.btrim(_c(c), F.lit(ch))


def zero_pad(c, width: int) -> Column:
    """left-pad with zeros to `width` without truncating longer values
    (Python's str.zfill; a leading sign stays in front)."""
    c = _c(c)
    n = F.length(c)
    signed = c.startswith("+") | c.startswith("-")
    padded_signed = F.concat(F.substring(c, 1, 1),
                             F.lpad(c.substr(F.lit(2), n), width - 1, "0"))
    return (F.when(n >= width, c)
            .when(signed, padded_signed)
            .otherwise(F.lpad(c, width, "0")))


def safe_code(c, width: int | None = None, quirks: Quirks = PARITY) -> Column:
    """`_safe_str`: text, stripped, optionally zero-padded. With the text-null
    quirk (Q7) a missing value becomes the text 'nan' before padding."""
    c = _c(c).cast("string")
    if quirks.null_as_text:
        c = F.coalesce(c, F.lit("nan"))
    s = strip(c)
    return zero_pad(s, width) if width else s


def title_prepare(c) -> Column:
    """First half of `title_case`. Common strings are only lower-cased here.
    Strings holding one of the rare characters whose title form the `initcap`
    route cannot produce (several characters, or not the title form of the
    lower case: 'ß', 'ﬁ', 'İ', 'ẞ', Georgian capitals, polytonic Greek) are
    title-cased here exactly, character by character as Python does, and
    tagged so that `title_finish` passes them through. That per-character
    path uses a lambda, so staged plans keep this step in its own projection
    (see operators.cleaning)."""
    c = _c(c)
    chars = F.regexp_extract_all(c, F.lit("(?s)(.)"), 1)
    titles = F.create_map(*[F.lit(x) for kv in rare_titles().items() for x in kv])

    def one(ch: Column, i: Column) -> Column:
        prev_cased = F.element_at(chars, i).rlike(f"[{_CASED}]")
        title = F.coalesce(F.element_at(titles, ch), F.initcap(ch))
        return F.when((i > 0) & prev_cased, F.lower(ch)).otherwise(title)

    exact = F.concat(F.lit(_DONE_MARK), F.array_join(F.transform(chars, one), ""))
    non_ascii = F.octet_length(c) != F.length(c)
    rare = non_ascii & (F.length(F.translate(c, "".join(rare_titles()), "")) != F.length(c))
    return F.when(rare, exact).otherwise(F.lower(c))


def title_finish(c) -> Column:
    """Second half of `title_case`, on the output of `title_prepare`: strings
    already finished there lose their tag; the others get the `initcap`
    route -- park the original spaces on U+0001, put a space after every
    uncased character, `initcap`, drop the inserted spaces, restore the
    original ones (strings that already hold U+0001 remove the inserted
    spaces with a regex)."""
    s = _c(c)
    parked = F.replace(s, F.lit(" "), F.lit(_SPACE_MARK))
    fast = F.initcap(F.regexp_replace(parked, f"({_UNCASED})", "$1 "))
    fast = F.replace(F.replace(fast, F.lit(" "), F.lit("")), F.lit(_SPACE_MARK), F.lit(" "))
    slow = F.initcap(F.regexp_replace(s, f"({_UNCASED})", "$1 "))
    slow = F.regexp_replace(slow, f"({_UNCASED}) ", "$1")
    return (F.when(s.startswith(_DONE_MARK), s.substr(F.lit(2), F.length(s)))
            .when(F.instr(s, _SPACE_MARK) > 0, slow).otherwise(fast))


def title_case(c) -> Column:
    """F8: Python's str.title(): a cased letter after an uncased character
    (or at the start) is title-cased, every other cased letter lower-cased.

    `title_finish(title_prepare(c))`: built on `initcap` over a string with a
    space after every uncased character; strings with one of the rare
    characters of `rare_titles` take an exact per-character path.

    Known differences from Python (about 0.25% of random strings drawn from
    Latin, Greek and Armenian letters; none in Latin-1): characters whose
    casing differs between the JVM's and Python's Unicode versions, and the
    context rule for Greek final sigma."""
    return title_finish(title_prepare(c))


def upper(c) -> Column:
    """F9."""
    return F.upper(_c(c))


def repair_mojibake(c, quirks: Quirks = PARITY) -> Column:
    """text that was UTF-8 but decoded as latin1 is re-encoded to latin1
    (dropping what latin1 cannot hold) and decoded as UTF-8 (dropping invalid
    bytes). Blank cells and the text 'nan' become NULL."""
    s = strip(_c(c))
    latin = F.regexp_replace(s, r"[^\x{0}-\x{FF}]", "")
    as_bytes = F.encode(latin, "ISO-8859-1")
    decoded = F.make_valid_utf8(as_bytes.cast("string"))
    repaired = F.replace(decoded, F.lit("�"), F.lit(""))
    trigger = s.rlike("[" + MOJIBAKE_TRIGGERS + "]")
    if not quirks.repair_any_trigger:
        # only when the round trip is lossless
        trigger = trigger & F.is_valid_utf8(as_bytes.cast("string")) & (latin == s)
    blank = (s == "") | (F.lower(s) == "nan")
    return F.when(s.isNull() | blank, F.lit(None).cast("string")).when(trigger, repaired).otherwise(s)


def map_values(c, mapping: dict) -> Column:
    """whole-cell replacement from a small literal map; other values are
    kept. (Large maps belong in a joined table, not an expression.)"""
    m = F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    c = _c(c)
    return F.coalesce(F.element_at(m, c), c)


def regex_replace(c, pattern: str, replacement: str) -> Column:
    """regex replace, `$1` back-references (Java syntax)."""
    return F.regexp_replace(_c(c), pattern, replacement)


def strip_accents(c) -> Column:
    """NFKD decomposition, then drop every non-ASCII character.

    A character decomposes by itself, and what it leaves in ASCII is fixed:
    `translate` replaces those that leave one character, strings with one that
    leaves several take a per-character path, the rest is dropped. ASCII
    strings are passed through."""
    s = _c(c)
    one, several = ascii_forms()
    chars = F.regexp_extract_all(s, F.lit("(?s)(.)"), 1)
    forms = F.create_map(*[F.lit(x) for kv in several.items() for x in kv])
    spelled = F.array_join(F.transform(chars, lambda ch: F.coalesce(F.element_at(forms, ch), ch)), "")
    rare = F.length(F.translate(s, "".join(several), "")) != F.length(s)
    letters = F.translate(F.when(rare, spelled).otherwise(s), "".join(one), "".join(one.values()))
    return F.when(F.octet_length(s) == F.length(s), s).otherwise(F.regexp_replace(letters, "[^\\x00-\\x7F]+", ""))


def remove_substring(c, sub: str) -> Column:
    """F13."""
    return F.replace(_c(c), F.lit(sub), F.lit(""))


def sentinel_to_null(c, sentinel: str = "None") -> Column:
    """F14."""
    return F.nullif(_c(c), F.lit(sentinel))


def prefix(c, n: int) -> Column:
    """first n characters."""
    return F.substring(_c(c), 1, n)


__all__ = [
    "MOJIBAKE_TRIGGERS", "LABEL_MAP", "rare_titles", "ascii_forms",
    "strip", "strip_char", "zero_pad", "safe_code", "title_case", "title_prepare", "title_finish", "upper",
    "repair_mojibake", "map_values", "regex_replace", "strip_accents",
    "remove_substring", "sentinel_to_null", "prefix",
]
