"""Team-name normalisation and report-title parsing."""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from touchline.functions.casts import col

# Words that carry no identity in a club name.
CLUB_WORDS = ("fc", "cf", "ac", "sc", "ssc", "athletic", "atletico", "club")

# Fixed value: what may stand between the two teams in a report title.
TITLE_SEPARATOR = r" vs\. | vs |–"
# Fixed value: text after the away team in a report title.
TITLE_SUFFIX = " Match Report"
# Fixed value: the long English date inside a report title.
TITLE_DATE = r"([A-Za-z]+ \d{1,2}, \d{4})"


def _accent_table() -> tuple[str, str]:
    """Every precomposed Latin letter and the plain letter it is built on."""
    accented, plain = [], []
    for code in (*range(0x00C0, 0x0250), *range(0x1E00, 0x1F00)):
        parts = unicodedata.normalize("NFD", chr(code))
        base = [p for p in parts if unicodedata.category(p) != "Mn"]
        if len(parts) > 1 and len(base) == 1:
            accented.append(chr(code))
            plain.append(base[0])
    return "".join(accented), "".join(plain)


_ACCENTED, _PLAIN = _accent_table()


def fold_accents(c: str | Column) -> Column:
    """Accented Latin letters to plain ones, free combining marks removed.

    Letters that are not a base plus an accent (``ø``, ``ß``, ``Æ``) stay as they are.
    """
    return F.regexp_replace(F.translate(col(c), _ACCENTED, _PLAIN), r"\p{Mn}", "")


def _without_club_words(c: Column) -> Column:
    return F.regexp_replace(c, r"\b(" + "|".join(CLUB_WORDS) + r")\b", "")


def _squeeze(c: Column) -> Column:
    return F.regexp_replace(c, r"\s+", " ")


def normalise_name(c: str | Column, variant: str = "clean") -> Column:
    """Comparison key of a team name.

    ``inspect``  keeps letters of both cases, drops club words only where they
                 are already lower case, does not trim;
    ``build``    folds accents but then keeps lower-case letters only, so the
                 capitals of the original are lost;
    ``clean``    folds, lowers, then strips: the form that reads as intended.
    """
    name = col(c)
    if variant == "inspect":
        letters = F.regexp_replace(name, "[^a-zA-Z0-9 ]", "")
        return F.lower(_squeeze(_without_club_words(letters)))
    if variant == "build":
        letters = F.regexp_replace(fold_accents(name), "[^a-z0-9 ]", "")
        return F.lower(F.trim(_squeeze(_without_club_words(letters))))
    if variant == "clean":
        letters = F.regexp_replace(F.lower(fold_accents(name)), "[^a-z0-9 ]", "")
        return F.trim(_squeeze(_without_club_words(letters)))
    raise ValueError(f"unknown name variant: {variant}")


def _title_parts(c: str | Column) -> Column:
    title = col(c)
    return F.split(F.when(title != "", title), TITLE_SEPARATOR)


def title_home(c: str | Column) -> Column:
    """Home team of a report title; the whole title when it has no separator."""
    return F.get(_title_parts(c), F.lit(0))


def title_away(c: str | Column) -> Column:
    """Away team of a report title; NULL when it has no separator."""
    return F.substring_index(F.get(_title_parts(c), F.lit(1)), TITLE_SUFFIX, 1)


def title_date(c: str | Column) -> Column:
    """Long English date of a report title, still as text."""
    return F.nullif(F.regexp_extract(col(c), TITLE_DATE, 1), F.lit(""))
