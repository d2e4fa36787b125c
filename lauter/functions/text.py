"""Text cleaning expressions."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- fixed values -----------------------------------------------------------
NULL_SENTINELS = ("", "null", "none", "n/a", "na", "nil", "undefined", "-", "--")
MAX_LENGTHS = {
    "name": 256,
    "email": 256,
    "sku": 64,
    "phone": 32,
    "status": 32,
    "category": 128,
}
# ----------------------------------------------------------------------------

# Everything str.strip() removes; U+3000 is the last of them.
WHITESPACE = "".join(chr(code) for code in range(0x3001) if chr(code).isspace())

# Ranges in which every character is assigned, already in NFC, and never merges
# with the character before it. Text made only of these stays on the JVM.
PLAIN_RANGES = (
    (0x0000, 0x02FF),  # Latin
    (0x0388, 0x038A),  # Greek
    (0x038E, 0x03A1),
    (0x03A3, 0x03FF),
    (0x0400, 0x0482),  # Cyrillic
    (0x048A, 0x052F),
    (0x2010, 0x2027),  # punctuation
    (0x2030, 0x205E),
    (0x3041, 0x3096),  # kana
    (0x309B, 0x30FF),
    (0x4E00, 0x9FEF),  # CJK
    (0xAC00, 0xD7A3),  # Hangul syllables
)
_NOT_PLAIN = "[^" + "".join(rf"\x{{{a:x}}}-\x{{{b:x}}}" for a, b in PLAIN_RANGES) + "]"
_NOT_LATIN = r"[^\x00-\x{2ff}]"

# Category C characters inside PLAIN_RANGES, tab and newline excepted.
_PLAIN_CONTROLS = r"[\x00-\x08\x0b-\x1f\x7f-\x9f\xad]"

# Printable ASCII, of whose characters only blanks are trimmed. One greedy run over a single
# range is several times as fast as a search for what is not in it.
_PRINTABLE = r"\A[ -~]*\z"
_STRIPPED = r"(?s)\A[!-~](.*[!-~])?\z"
_LONGEST_SENTINEL = max(map(len, NULL_SENTINELS))

_WORD_RUNS = r"([\p{Lu}\p{Ll}\p{Lt}]+|[^\p{Lu}\p{Ll}\p{Lt}]+)"


def _unicode_normaliser():
    """The one Python step. Defined in a closure so that it travels to the
    executors by value and needs no installed package there."""

    class DropControls(dict):
        """``str.translate`` table that learns each character's category once."""

        def __missing__(self, code: int) -> int | None:
            keep = code in (9, 10) or unicodedata.category(chr(code))[0] != "C"
            self[code] = code if keep else None
            return self[code]

    table = DropControls()

    def normalise(values: pd.Series) -> pd.Series:
        if values.isna().all():
            return values
        return values.map(
            lambda text: unicodedata.normalize("NFC", text).translate(table), na_action="ignore"
        )

    return F.pandas_udf(normalise, T.StringType())


_normalise_unicode = _unicode_normaliser()


def _needs_python(text: Column) -> Column:
    """The cheapest test first: ASCII text has as many characters as bytes."""
    other = F.octet_length(text) != F.length(text)
    return other & text.rlike(_NOT_LATIN) & text.rlike(_NOT_PLAIN)


def fix_encoding(text: Column) -> Column:
    """NFC form without control characters.

    Only text outside PLAIN_RANGES reaches Python; every other row crosses as NULL.
    """
    normalised = _normalise_unicode(F.when(_needs_python(text), text))
    return F.coalesce(normalised, F.regexp_replace(text, _PLAIN_CONTROLS, ""))


def strip(text: Column) -> Column:
    """Unicode whitespace off both ends (C3); skipped when both ends are visible ASCII."""
    return F.when(text.rlike(_STRIPPED), text).otherwise(F.btrim(text, F.lit(WHITESPACE)))


def tidy(text: Column) -> Column:
    """``strip(fix_encoding(text))`` with one test that lets most text pass untouched."""
    tidied = F.btrim(fix_encoding(text), F.lit(WHITESPACE))
    return F.when(text.rlike(_PRINTABLE), F.trim(text)).otherwise(tidied)


def nullify(text: Column) -> Column:
    """NULL for the spellings people use for "nothing" (C4)."""
    nothing = (F.octet_length(text) <= _LONGEST_SENTINEL) & F.lower(text).isin(*NULL_SENTINELS)
    return F.when(~nothing, text)


def truncate(text: Column, name: str) -> Column:
    """At most the stored width of column ``name``; unknown names pass."""
    width = MAX_LENGTHS.get(name)
    if width is None:
        return text
    # no more bytes than that are no more characters either
    return F.when(F.octet_length(text) <= width, text).otherwise(F.substring(text, 1, width))


def title_case(text: Column) -> Column:
    """A capital after every non-letter (V5), unlike ``initcap``."""
    return F.array_join(
        F.transform(
            F.regexp_extract_all(text, F.lit(_WORD_RUNS), F.lit(1)),
            lambda run: F.concat(
                F.upper(F.substring(run, 1, 1)), F.lower(F.substr(run, F.lit(2)))
            ),
        ),
        "",
    )
