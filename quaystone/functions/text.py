"""Text cleaning expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The characters Python's str.strip() removes (str.isspace), i.e. ASCII
# white space and separators plus U+0085, U+00A0, U+1680, U+2000-U+200A, U+2028, U+2029,
# U+202F, U+205F and U+3000. `trim()` alone only removes ASCII spaces.
WHITESPACE = ("\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680" + "".join(chr(c) for c in range(0x2000, 0x200B))
              + "\u2028\u2029\u202f\u205f\u3000")


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def strip_all(c) -> Column:
    """Strip white space at both ends like Python's str.strip() (NULL stays NULL).
    A character-set trim: no regular expression, compiled with the rest of the stage."""
    return F.btrim(_col(c).cast("string"), F.lit(WHITESPACE))


def blank_to_null(c) -> Column:
    """Trimmed text, blank -> NULL."""
    return F.nullif(strip_all(c), F.lit(""))


def text_or_empty(c) -> Column:
    """Trimmed text, NULL -> ''."""
    return F.coalesce(strip_all(c), F.lit(""))


def excel_int_text(c) -> Column:
    """A whole number read as float text ('1000012.0') back to integer text."""
    return F.regexp_replace(strip_all(c), r"^(-?\d+)\.0+$", "$1")


def pick_column(columns: Sequence[str], candidates: Iterable[str]) -> list[str]:
    """Resolve candidate names against a schema: exact names first, then case-insensitive.

    Runs on the driver over column *names* only; returns the physical names in
    candidate order (each at most once).
    """
    lower = {}
    for name in columns:
        lower.setdefault(name.lower(), name)
    picked: list[str] = []
    for cand in candidates:
        name = cand if cand in columns else lower.get(cand.lower())
        if name is not None and name not in picked:
            picked.append(name)
    return picked


def first_nonempty(df: DataFrame, *candidates: str) -> Column:
    """First non-blank value among candidate columns (blank = NULL or '').

    Candidates missing from the schema are skipped; none present -> NULL.
    """
    names = pick_column(df.columns, candidates)
    if not names:
        return F.lit(None).cast("string")
    return F.coalesce(*[F.nullif(F.col(n).cast("string"), F.lit("")) for n in names])
