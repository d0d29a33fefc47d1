"""Date, string and token expressions."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..schemas import TOKEN_SEPARATOR, URL_SEPARATOR

# Fixed value: the characters a plain strip() removes from both ends of a text.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005"
    "\u2006\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)

ZONE = "America/Bogota"


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def day_of(c: Column | str, lenient: bool = False) -> Column:
    """Date of a ``yyyyMMdd`` text. A bad text fails the query (ANSI mode) unless ``lenient``."""
    return (F.try_to_date if lenient else F.to_date)(_col(c), "yyyyMMdd")


def date_of_parts(c: Column | str) -> Column:
    """The same date put together from year, month and day substrings."""
    c = _col(c)
    year, month, day = (F.substring(c, a, n).cast("int") for a, n in ((1, 4), (5, 2), (7, 2)))
    return F.make_date(year, month, day)


def season_position(date: Column | str) -> Column:
    """Place in the year as (30 * month + day) / 365; the year is ignored on purpose."""
    date = _col(date)
    return (F.month(date) * 30 + F.dayofmonth(date)) / F.lit(365.0)


def day_before(instant: Column | str, zone: str = ZONE, source_zone: str = "UTC") -> Column:
    """``yyyyMMdd`` of the day before on the clock of ``zone``; ``instant`` is a wall-clock time
    (TIMESTAMP_NTZ) in ``source_zone``."""
    wall = _col(instant).cast("timestamp_ntz")
    local = F.convert_timezone(F.lit(source_zone), F.lit(zone), wall)
    return F.date_format(F.date_sub(local.cast("date"), 1), "yyyyMMdd")


def strip(c: Column | str) -> Column:
    return F.btrim(_col(c), F.lit(WHITESPACE))


def is_alpha(c: Column | str) -> Column:
    """True for a non-empty text made of Unicode letters only."""
    return _col(c).rlike(r"\A\p{L}+\z")


def pieces(c: Column | str, separator: str = TOKEN_SEPARATOR) -> Column:
    """Every piece between separators, empty and trailing ones included."""
    return F.split(_col(c), separator, -1)


def row_tokens(cols: Sequence[str], separator: str = TOKEN_SEPARATOR) -> Column:
    """All pieces of several multi-valued columns as one array; null columns are skipped."""
    if len(cols) == 1:
        return pieces(cols[0], separator)
    return F.flatten(F.array_compact(F.array(*[pieces(c, separator) for c in cols])))


def row_token_set(
    cols: Sequence[str], separator: str = TOKEN_SEPARATOR, strip_on_match: bool = False
) -> Column:
    """Distinct pieces of a row. Pieces keep their padding unless ``strip_on_match``, so a padded
    piece is counted for the vocabulary but never matches it - the behaviour to be reproduced."""
    tokens = row_tokens(cols, separator)
    if strip_on_match:
        tokens = F.transform(tokens, strip)
    return F.array_distinct(tokens)


def url_list(c: Column | str) -> Column:
    """Ordered URLs of a row, stripped; blank ones stay so that positions are kept."""
    return F.transform(F.split(_col(c), URL_SEPARATOR, -1), strip)


def first_url(c: Column | str) -> Column:
    """The first URL of the list and no other, even when it is blank."""
    return strip(F.element_at(F.split(_col(c), URL_SEPARATOR, -1), 1))


def has_terms(c: Column | str, include: Iterable[str], exclude: Iterable[str] = ()) -> Column:
    """All of ``include`` and none of ``exclude`` occur in the text."""
    c = _col(c)
    tests = [c.contains(t) for t in include] + [~c.contains(t) for t in exclude]
    return reduce(and_, tests, F.lit(True))


def path_matches(c: Column | str, folder: str, suffix: str = ".csv") -> Column:
    """True for an object name below ``folder`` that ends in ``suffix``."""
    c = _col(c)
    return c.startswith(folder) & c.endswith(suffix)


def quoted(c: Column | str) -> Column:
    """Text between the first two double quotes."""
    return F.get(F.split(_col(c), '"', -1), F.lit(1))


def folder_of(url: str) -> str:
    return url.rsplit("/", 1)[0]


def category_of(code: Column | str, categories: Mapping[str, Sequence[str]]) -> Column:
    """Name of the first category whose code list holds the code, else null."""
    code = _col(code)
    return F.coalesce(*[F.when(code.isin(*codes), F.lit(name)) for name, codes in categories.items()])


def prefixed(prefix: str, c: Column | str) -> Column:
    return F.concat(F.lit(prefix), _col(c).cast("string"))
