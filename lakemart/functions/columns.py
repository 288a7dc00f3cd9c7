"""Column -> Column scalar functions.

Each function returns a native Spark expression, so it runs inside whole-stage
codegen; none of them is a Python UDF.  Malformed text yields NULL (``try_*``)
rather than an ANSI error, which is what the legacy engine the original job
targeted did with bad cells.
"""

from __future__ import annotations

from collections.abc import Mapping
from typing import Any

from pyspark.sql import Column
from pyspark.sql import functions as F

ColumnOrName = Column | str

# Fixed values (must stay equal to the source data's code lists):
# SAS date numbers count days from 1960-01-01.
SAS_EPOCH = "1960-01-01"
# i94visa codes: 1 = Business, 2 = Pleasure, 3 = Student.
TRIP_PURPOSE_CODES = {1: "Business", 2: "Pleasure", 3: "Student"}
# i94mode code for arrivals by air.
AIR_MODE = 1
# i94port codes that are not real ports (XXX = not reported, 888 = unidentified, UNK = unknown).
INVALID_PORTS = ("XXX", "888", "UNK")
# gender code that means "not stated".
GENDER_UNKNOWN = "X"
# hemisphere letters: south and west are negative, north and east positive.
NEGATIVE_HEMISPHERES = ("S", "W")
POSITIVE_HEMISPHERES = ("N", "E")


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- casts (P2, P3) -----------------------------------------------------------

def to_double(c: ColumnOrName) -> Column:
    """Text or number -> double; blanks are trimmed, bad text gives NULL."""
    return _col(c).try_cast("double")


def to_int(c: ColumnOrName) -> Column:
    """Text or number -> int, truncating toward zero like a legacy cast.

    Going through double makes ``'4.0'`` -> 4 (ANSI ``try_cast('4.0' as int)``
    would be NULL); out-of-range or bad values give NULL.
    """
    return _col(c).try_cast("double").try_cast("int")


def to_long(c: ColumnOrName) -> Column:
    """Text or number -> bigint, exact for whole numbers of 64 bits; text with a
    fraction is truncated toward zero, bad or out-of-range values give NULL."""
    return F.coalesce(_col(c).try_cast("bigint"), _col(c).try_cast("double").try_cast("bigint"))


# --- codes and values (X1, X2, X4, X14) ----------------------------------------

def sas_to_date(days: ColumnOrName) -> Column:
    """SAS day number (days since 1960-01-01) -> date; NULL stays NULL."""
    return F.date_add(F.lit(SAS_EPOCH).cast("date"), to_int(days))


def map_codes(c: ColumnOrName, mapping: Mapping[Any, Any], default: Any = None) -> Column:
    """Code -> label through a CASE chain; unknown codes get ``default``."""
    src = _col(c)
    expr = None
    for code, label in mapping.items():
        expr = (F.when(src == F.lit(code), F.lit(label)) if expr is None
                else expr.when(src == F.lit(code), F.lit(label)))
    if expr is None:
        return F.lit(default)
    return expr.otherwise(F.lit(default))


def trip_purpose(code: ColumnOrName) -> Column:
    return map_codes(code, TRIP_PURPOSE_CODES)


def null_if(c: ColumnOrName, value: Any) -> Column:
    """``value`` -> NULL, everything else unchanged."""
    return F.when(_col(c) == F.lit(value), F.lit(None)).otherwise(_col(c))


def days_between(end: ColumnOrName, start: ColumnOrName) -> Column:
    """end - start in days (X3); negatives kept, NULL if either is NULL."""
    return F.datediff(_col(end), _col(start))


# --- text (X5, X6, X7) -----------------------------------------------------------

def split_get(c: ColumnOrName, delimiter: str, index: int) -> Column:
    """Part ``index`` (0-based) of ``c`` split on a literal delimiter.

    Out-of-range parts give NULL (``get``), not an ANSI error.
    """
    return F.get(F.split(_col(c), "\\Q" + delimiter + "\\E"), index)


def parse_date(c: ColumnOrName, fmt: str | None = None) -> Column:
    """ISO date text -> date; unparsable text gives NULL."""
    return F.try_to_date(_col(c)) if fmt is None else F.try_to_date(_col(c), F.lit(fmt))


# --- numbers (X10, X11, X12) -------------------------------------------------------

def celsius_to_fahrenheit(c: ColumnOrName) -> Column:
    """c * 9/5 + 32 in double arithmetic; NULL and bad text give NULL."""
    return to_double(c) * F.lit(1.8) + F.lit(32.0)


def round_half_up(c: ColumnOrName, digits: int = 2) -> Column:
    return F.round(_col(c), digits)


def signed_coordinate(c: ColumnOrName) -> Column:
    """``'40.99N'`` -> 40.99, ``'80.95W'`` -> -80.95 (hemisphere letter any case).

    Any other last letter, NULL, empty text or bad digits give NULL.
    """
    txt = _col(c)
    letter = F.upper(F.substring(txt, -1, 1))
    number = F.substring(txt, F.lit(1), F.length(txt) - 1).try_cast("double")
    sign = (F.when(letter.isin(*NEGATIVE_HEMISPHERES), F.lit(-1.0))
             .when(letter.isin(*POSITIVE_HEMISPHERES), F.lit(1.0)))
    return sign * number


# --- ids (X13) -----------------------------------------------------------------------

def surrogate_id(*stable_keys: ColumnOrName) -> Column:
    """Unique id per row.

    Without keys: ``monotonically_increasing_id`` (unique and increasing within
    one run, as in the original).  With keys: a 64-bit hash of the keys, stable
    between runs; unique as long as the keys are.
    """
    if not stable_keys:
        return F.monotonically_increasing_id()
    return F.xxhash64(*[_col(k) for k in stable_keys])
