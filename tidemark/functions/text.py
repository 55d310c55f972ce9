"""String functions with Python-compatible semantics, as native Spark expressions."""

from __future__ import annotations

import string

from pyspark.sql import Column
from pyspark.sql import functions as F

# Split points: between a non-letter and a letter.  Every piece then starts with a
# letter (or is a run of non-letters), so "upper first, lower rest" per piece gives
# Python's str.title(): a letter after ANY non-letter is capitalised
# ("men's" -> "Men'S", "dri-fit" -> "Dri-Fit", "3d" -> "3D"), unlike initcap.
_WORD_START = r"(?<=\P{L})(?=\p{L})"


# In plain text every word starts after a space or at the start: ASCII, no letter right after another sign. The letters are
# listed because Java tests such a class with one look-up; ranges and \P{L} took 40 times as long.
_INNER_START = f"[^ {string.ascii_letters}][{string.ascii_letters}]"
_WHITE_SPACE = " \t\n\x0b\f\r"   # ASCII's part of \s


def _plain(c: Column) -> Column:
    return (F.char_length(c) == F.octet_length(c)) & ~F.rlike(c, F.lit(_INNER_START))


def _title_pieces(c: Column) -> Column:
    pieces = F.split(c, _WORD_START)
    return F.array_join(
        F.transform(pieces, lambda w: F.concat(F.upper(F.left(w, F.lit(1))),
                                               F.lower(F.substr(w, F.lit(2))))),
        "")


def title_case(c: Column) -> Column:
    """Python str.title(); plain text, where ``initcap`` gives the same, is not cut into pieces."""
    return F.when(_plain(c), F.initcap(c)).otherwise(_title_pieces(c))


def strip_ws(c: Column) -> Column:
    """Python str.strip(): all leading/trailing whitespace, not only spaces."""
    return F.regexp_replace(c, r"^\s+|\s+$", "")


def normalise(c: Column) -> Column:
    """Silver string normalisation: strip then title-case; NULL stays NULL."""
    return F.when(_plain(c), F.initcap(F.btrim(c, F.lit(_WHITE_SPACE)))).otherwise(_title_pieces(strip_ws(c)))


def snake_case_name(name: str) -> str:
    """Header rewrite (metadata only, runs on the driver over column names)."""
    import re
    s = name.strip().lower()
    s = re.sub(r"[\s()]+", "_", s)
    s = re.sub(r"_+", "_", s)
    return s.strip("_")
