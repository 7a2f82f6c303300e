"""Backslash escapes in text, as in string literals."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: An escape, or text without backslashes. A backslash that begins nothing else keeps the sign behind it.
PIECE = r"(?s)\\(?:[0-7]{1,3}|x[0-9A-Fa-f]{2}|u[0-9A-Fa-f]{4}|U[0-9A-Fa-f]{8}|.)|\\$|[^\\]+"

# Signs that a letter or sign behind a backslash stands for.
SIGNS = {"a": "\x07", "b": "\b", "f": "\f", "n": "\n", "r": "\r", "t": "\t", "v": "\x0b", "\\": "\\", "'": "'", '"': '"', "\n": ""}


def from_code(hexadecimal: Column) -> Column:
    """The sign of a code point; NULL for numbers that are none, and for halves of pairs."""
    code = F.lpad(F.upper(hexadecimal), 8, "0")
    plain = (code <= "0010FFFF") & ~code.between("0000D800", "0000DFFF")
    return F.when(plain, F.decode(F.unhex(code), "UTF-32"))


def decode_piece(piece: Column) -> Column:
    """What one piece stands for; NULL if it cannot be decoded."""
    letter, rest = F.substring(piece, 2, 1), F.substring(piece, F.lit(3), F.length(piece))
    signs = F.create_map(*[F.lit(x) for pair in SIGNS.items() for x in pair])
    octal = F.lower(F.conv(F.substring(piece, F.lit(2), F.length(piece)), 8, 16))
    return (
        F.when(~F.startswith(piece, F.lit("\\")), piece)
        .when((F.length(piece) > 2) & letter.isin("x", "u", "U"), from_code(rest))
        .when(letter.between("0", "7"), from_code(octal))
        .when(letter.isin("x", "u", "U", "N", ""), F.lit(None))  # cut off, or a name of a sign
        .otherwise(F.coalesce(F.element_at(signs, letter), piece))
    )


def decode_escapes(text: Column) -> Column:
    r"""Text with its backslash escapes decoded; NULL if one of them cannot be.

    Control signs, quotes, the backslash, ``\ooo``, ``\xhh``, ``\uhhhh`` and ``\Uhhhhhhhh`` are decoded, a backslash at a
    line end joins lines, and one before any other sign stays. Cut-off codes, code points above 10FFFF, halves of
    surrogate pairs, a backslash at the end and ``\N{name}`` cannot be decoded.
    """
    pieces = F.transform(F.regexp_extract_all(text, F.lit(PIECE), F.lit(0)), decode_piece)
    whole = F.when(~F.exists(pieces, lambda p: p.isNull()), F.array_join(pieces, ""))
    return F.when(F.contains(text, F.lit("\\")), whole).otherwise(text)
