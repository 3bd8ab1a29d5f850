"""Text normalising and unit-id cleaning as JVM-side column expressions."""

from __future__ import annotations

import unicodedata
from functools import lru_cache, reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Code point ranges whose compatibility forms are folded: everything up to the
# CJK blocks, the presentation and full-width forms, and styled mathematical
# letters. Hangul syllables and ideographs stay composed.
_FOLDED_RANGES = ((0x80, 0x3400), (0xF900, 0x10000), (0x1D400, 0x1D800))

# Capitals that fold to several characters are expanded up to here (Latin
# digraphs and fractions); symbols, enclosed and Arabic forms stay as they are.
# The short list keeps the generated code small enough for the JVM to compile.
_EXPANDED_BELOW = 0x250

# Java's \s plus the separators Python also splits on (the rest folds to a space).
_SPACES = r"[\s\x1C-\x1F\x85\x{1680}\x{2028}\x{2029}]+"


@lru_cache(maxsize=1)
def _folding_rules() -> tuple[str, str, tuple[tuple[str, str], ...]]:
    """Derive, from Unicode data, how upper-cased text loses its accents.

    Returns the ``translate`` source and target (characters that fold to one, then
    the combining marks to delete) and the pairs that fold to several characters.
    """
    source, target, marks, longer = [], [], [], []
    for start, stop in _FOLDED_RANGES:
        for code in range(start, stop):
            char = chr(code)
            if 0xD800 <= code < 0xE000 or char.upper() != char:
                continue
            if unicodedata.combining(char):
                marks.append(char)
                continue
            plain = _without_marks(char).upper()
            if len(plain) == 1 and plain != char:
                source.append(char)
                target.append(plain)
            elif len(plain) > 1 and code < _EXPANDED_BELOW:
                longer.append((char, plain))
    return "".join(source + marks), "".join(target), tuple(longer)


def _without_marks(text: str) -> str:
    return "".join(c for c in unicodedata.normalize("NFKD", text) if not unicodedata.combining(c))


def normalise(text: Column) -> Column:
    """Unaccented upper case with single spaces; NULL becomes the empty string.

    Only code-generated functions. Upper-casing comes first: it already spells
    out ligatures and leaves half as many characters to fold.
    """
    source, target, longer = _folding_rules()
    upper = F.upper(F.coalesce(text, F.lit("")))
    folded = F.translate(upper, source, target)
    expanded = reduce(lambda acc, pair: F.replace(acc, F.lit(pair[0]), F.lit(pair[1])), longer, folded)
    ascii_only = F.octet_length(text) == F.length(text)
    return F.trim(F.regexp_replace(F.when(ascii_only, upper).otherwise(expanded), _SPACES, " "))


def is_foldable(text: Column) -> Column:
    """False for plain ASCII with single inner spaces, which only needs upper-casing."""
    return F.coalesce(~F.rlike(text, F.lit("^[!-~]+(?: [!-~]+)*$")), F.lit(False))


def numeric_unit_id(code: Column) -> Column:
    """``90150.0`` and ``90150`` both become ``'90150'``; text that isn't a whole number of 64 bits is NULL."""
    plain = F.trim(code.cast("string"))
    whole = F.when(F.rlike(plain, F.lit(r"^[+-]?\d+(\.0*)?$")), F.regexp_replace(plain, r"\.0*$", ""))
    return whole.try_cast("bigint").cast("string")


def name_unit_id(name: Column) -> Column:
    """A unit named by text: the stripped string, spelling kept."""
    return F.trim(name.cast("string"))


def fold(text: str | None) -> str:
    """``normalise`` for a constant or a header name on the driver."""
    return " ".join(_without_marks(text).upper().split()) if isinstance(text, str) else ""
