"""Text expressions that stay inside the JVM."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Zero-width characters, which print nothing.
ZERO_WIDTH = "\u00ad\u200b\u200c\u200d\u2060\ufeff"
#: Cyrillic and Greek capitals and small letters drawn like the Latin letter below them.
LOOKALIKE_FROM = "АВЕКМНОРСТХаеорсухіϹϲΑΒΕΖΗΙΚΜΝΟΡΤΥΧο"
LOOKALIKE_TO = "ABEKMHOPCTXaeopcyxiCcABEZHIKMNOPTYXo"
#: Full-width forms of the printable ASCII characters lie 0xFEE0 above them.
WIDE_FROM = "".join(chr(0xFF01 + i) for i in range(94)) + "\u3000\u00a0\u2002\u2009\u202f"
WIDE_TO = "".join(chr(0x21 + i) for i in range(94)) + " " * 5


def plain(col: Column) -> Column:
    """Full-width forms, look-alike letters, zero-width characters and special spaces in their plain form."""
    out = F.translate(col, WIDE_FROM + LOOKALIKE_FROM, WIDE_TO + LOOKALIKE_TO)
    return F.translate(out, ZERO_WIDTH, "")


def is_blank(col: Column) -> Column:
    """Null or nothing but white space."""
    return F.coalesce(F.trim(F.regexp_replace(col, r"[\s\p{Z}]+", " ")) == "", F.lit(True))


def folded(col: Column) -> Column:
    """Lower case without white space."""
    return F.regexp_replace(F.lower(col), r"[\s\p{Z}]+", "")


def alnum_fold(col: Column) -> Column:
    """Lower case, only ASCII letters and digits and Hangul syllables."""
    return F.regexp_replace(F.lower(col), "[^0-9a-z가-힣]+", "")


def _syllable(number: Column) -> Column:
    """The Hangul syllable of a number from 0, by the three bytes of its code point."""
    code = (number + 0xAC00).cast("bigint")
    part = lambda shift: F.shiftright(code, shift).bitwiseAND(0x3F) + 0x80
    return F.unhex(F.hex((F.shiftright(code, 12) + 0xE0) * 65536 + part(6) * 256 + part(0))).cast("string")


def composed(col: Column) -> Column:
    """Conjoining Hangul letters put together into syllables; a text without any stays as it is."""
    tail = r"[\x{11a8}-\x{11c2}]"

    def put(text: Column, pattern: str, code: Callable[[Column], Column]) -> Column:
        found = F.transform(F.regexp_extract_all(text, F.lit(f"({pattern})"), 1), lambda x: _syllable(code(x)))
        between = F.split(text, pattern, -1)
        return F.array_join(F.transform(between, lambda b, i: F.concat(b, F.coalesce(F.get(found, i), F.lit("")))), "")

    at = lambda x, i: F.ascii(F.substring(x, i, 1))
    last = lambda x: F.when(F.length(x) == 3, at(x, 3) - 0x11A7).otherwise(0)
    whole = put(col, rf"[\x{{1100}}-\x{{1112}}][\x{{1161}}-\x{{1175}}]{tail}?", lambda x: (at(x, 1) - 0x1100) * 588 + (at(x, 2) - 0x1161) * 28 + last(x))
    both = put(whole, rf"[가-힣]{tail}", lambda x: at(x, 1) - 0xAC00 + at(x, 2) - 0x11A7)
    return F.when(col.rlike(r"[\x{1100}-\x{11ff}]"), both).otherwise(col)
