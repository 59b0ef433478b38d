"""Text cleaning and text assembly."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters that count as white space, as code points from..to. Java's and
# RE2's own \s stop at ASCII, so the class is written out; both engines read this form.
WHITE_SPACE_RANGES = [
    (0x9, 0xD), (0x1C, 0x20), (0x85, 0x85), (0xA0, 0xA0), (0x1680, 0x1680), (0x2000, 0x200A),
    (0x2028, 0x2029), (0x202F, 0x202F), (0x205F, 0x205F), (0x3000, 0x3000),
]
WHITE_SPACE = "[" + "".join(rf"\x{{{first:x}}}-\x{{{last:x}}}" for first, last in WHITE_SPACE_RANGES) + "]"
WHITE_SPACE_CHARACTERS = "".join(
    chr(code) for first, last in WHITE_SPACE_RANGES for code in range(first, last + 1)
)


def _java_class(ranges: list[tuple[int, int]]) -> str:
    """A character class that Java tests fast: single Latin-1 characters make one bit set, and one
    range test keeps all other letters away from the rare characters."""
    low = "".join(rf"\x{{{code:x}}}" for first, last in ranges for code in range(first, last + 1) if code < 256)
    rare = [(first, last) for first, last in ranges if first >= 256]
    high = "".join(rf"\x{{{first:x}}}-\x{{{last:x}}}" for first, last in rare)
    return rf"[{low}[\x{{{rare[0][0]:x}}}-\x{{{rare[-1][1]:x}}}&&[{high}]]]"


# The only runs of white space that folding changes: all but one plain space on its own.
_ANY = _java_class(WHITE_SPACE_RANGES)
_NOT_PLAIN = _java_class([(0x1C, 0x1F) if r == (0x1C, 0x20) else r for r in WHITE_SPACE_RANGES])
FOLDABLE = f"{_NOT_PLAIN}{_ANY}*| {_ANY}+"


def strip(text: Column) -> Column:
    """Remove white space of any script from both ends."""
    return F.btrim(text, F.lit(WHITE_SPACE_CHARACTERS))


def description(comment: Column) -> Column:
    """A comment without surrounding white space; NULL when nothing is left."""
    return F.nullif(strip(comment), F.lit(""))


def escape_description(text: Column) -> Column:
    """Make text safe inside double quotes: escape quotes, fold white space, trim."""
    quoted = F.replace(text, F.lit('"'), F.lit('\\"'))
    return F.btrim(F.regexp_replace(quoted, FOLDABLE, " "), F.lit(" "))


def first_text(*options: Column) -> Column:
    """The first option that is neither NULL nor empty, else the empty string."""
    return F.coalesce(*[F.nullif(option, F.lit("")) for option in options], F.lit(""))


def stamp(moment: Column) -> Column:
    """A timestamp as ``yyyy-MM-dd HH:mm:ss``."""
    return F.date_format(moment, "yyyy-MM-dd HH:mm:ss")
